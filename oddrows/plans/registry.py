"""Named queries on the given tables, each with the SQL that must return the same rows."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from oddrows.functions.columns import rounded
from oddrows.functions.lineage import shared_folder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """`t.orders` reads orders.parquet of the folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def scratch(self) -> str:
        return f"{shared_folder(self.spark)}/oddrows-{uuid.uuid4().hex}"


def query(name: str, sql: str | None = None, digits: int = 6):
    """Register a query; doubles of its result are rounded to `digits`."""
    def add(build: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = lambda spark, folder: tidy(build(Tables(spark, folder)), digits)
        if sql is not None:
            ORACLES[name] = sql
        return build
    return add


def tidy(df: DataFrame, digits: int) -> DataFrame:
    floats = [f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: rounded(F.col(c), digits) for c in floats}) if floats else df


def R(expr: str, digits: int = 6) -> str:
    """SQL counterpart of `rounded`."""
    return f"(round(({expr})::DOUBLE, {digits}) + 0.0)"


def H(text: str) -> str:
    """SQL counterpart of `hash32` on one text expression."""
    return f"('0x' || substr(md5({text}), 1, 8))::BIGINT"


def U(text: str) -> str:
    """SQL counterpart of `uniform`."""
    return f"(({H(text)} + 0.5::DOUBLE) / 4294967296.0::DOUBLE)"


def least_squares_sql(name: str, source: str, keep: list[str], xs: list[str], y: str, fit: str = "TRUE") -> str:
    """CTEs ending in `<name>`: the kept columns and `rest`, what is left of y after regressing it
    on xs with an intercept. Columns are made orthogonal one after the other on the rows of `fit`."""
    columns = [*xs, y]
    kept = ", ".join(keep)
    mean = ", ".join(f"avg({c}) AS m_{c}" for c in columns)
    centred = ", ".join(f"{c} - m_{c} AS {c}" for c in columns)
    parts = [f"{name}_s AS MATERIALIZED ({source})",
             f"{name}_0 AS MATERIALIZED (SELECT {kept}, {centred} FROM {name}_s, (SELECT {mean} FROM {name}_s WHERE {fit}))"]
    for k, q in enumerate(xs):
        left = columns[k + 1:]
        slopes = ", ".join(f"sum({q} * {c}) / nullif(sum({q} * {q}), 0) AS b_{c}" for c in left)
        taken = ", ".join(f"{c} - coalesce(b_{c}, 0) * {q} AS {c}" for c in left)
        parts.append(f"{name}_{k + 1} AS MATERIALIZED (SELECT {kept}, {taken} FROM {name}_{k}, (SELECT {slopes} FROM {name}_{k} WHERE {fit}))")
    parts.append(f"{name} AS (SELECT {kept}, {y} AS rest FROM {name}_{len(xs)})")
    return ", ".join(parts)


#: numbers of a word vector
DIM = 300


def digest(vector: str = "vec") -> Column:
    """All numbers of a vector in one: the sum of their squares, weighted by their places and signs kept."""
    v = F.col(vector).cast("array<double>")
    return F.aggregate(F.zip_with(v, F.sequence(F.lit(1), F.size(v)), lambda x, i: i * x * F.abs(x)), F.lit(0.0), lambda a, x: a + x)


def word_vector_sql(vocabulary: str) -> str:
    """word, i, x of the words of a table: what `hash_vectors` makes."""
    return f"SELECT word, i, {U("'0:' || i || ':' || word")} - 0.5 AS x FROM ({vocabulary}), range({DIM}) r(i)"


def mahalanobis_sql(source: str, keep: list[str], errors: list[str], by: str, fit: str = "TRUE") -> str:
    """CTEs ending in `scored`: the kept columns and `score`, the squared distance of the errors to those of the rows of `fit` in their group.
    Each error is cleared of the ones before it; what is left of all of them is independent."""
    kept = ", ".join([*keep, by])
    whole = " AND ".join(f"{e} IS NOT NULL" for e in errors)
    centred = ", ".join(f"{e} - avg({e}) FILTER ({fit}) OVER (PARTITION BY {by}) AS {e}" for e in errors)
    parts = [f"g_s AS MATERIALIZED (SELECT *, ({fit})::BOOL AS fit_ FROM ({source}) WHERE {whole})",
             f"g_0 AS MATERIALIZED (SELECT {kept}, fit_, {centred.replace(f'FILTER ({fit})', 'FILTER (fit_)')} FROM g_s)"]
    for k, q in enumerate(errors):
        left = errors[k + 1:]
        slopes = ", ".join([f"sum({q} * {e}) FILTER (fit_) / sum({q} * {q}) FILTER (fit_) AS b_{e}" for e in left]
                           + [f"sum({q} * {q}) FILTER (fit_) / (count(*) FILTER (fit_) - 1) AS v_"])
        taken = ", ".join([f"{e} - b_{e} * {q} AS {e}" for e in left] + [f"{q} * {q} / v_ AS s_{q}"] + [f"s_{e}" for e in errors[:k]])
        own = ", ".join(f"g_{k}.{c.split()[-1]}" for c in [*keep, by])
        parts.append(f"g_{k + 1} AS MATERIALIZED (SELECT {own}, fit_, {taken} FROM g_{k} JOIN (SELECT {by} AS by_, {slopes} FROM g_{k} GROUP BY 1) ON by_ = {by})")
    parts.append(f"scored AS (SELECT {kept}, fit_, {' + '.join(f's_{e}' for e in errors)} AS score FROM g_{len(errors)})")
    return ", ".join(parts)


def components_sql(fit: str, rows: str, keep: list[str], count: int, width: int = 64) -> str:
    """CTEs ending in `left_`: the kept columns of `rows` (x, a list of doubles) and z, what the first `count` principal components of
    `fit` (x) leave of the centred x. The largest component is any row of the covariance matrix squared 34 times over; it is
    then taken out of the matrix."""
    spots = range(1, width + 1)
    dot = lambda a, b: f"list_inner_product({a}, {b})"
    trace = "list_sum(list_transform(m, lambda r, i: r[i]))"
    parts = [f"fit_ AS MATERIALIZED ({fit})", f"mu_ AS MATERIALIZED (SELECT [{', '.join(f'avg(x[{i}])' for i in spots)}] AS mu FROM fit_)",
             "mid_ AS MATERIALIZED (SELECT list_transform(x, lambda v, i: v - mu[i]) AS c FROM fit_, mu_)",
             f"rows_ AS MATERIALIZED (SELECT i, [{', '.join(f'sum(c[i] * c[{j}])' for j in spots)}] AS r FROM mid_, range(1, {width + 1}) t(i) GROUP BY i)",
             "m0_ AS MATERIALIZED (SELECT list(r ORDER BY i) AS m FROM rows_)",
             f"z0_ AS MATERIALIZED (SELECT {', '.join(keep)}, list_transform(x, lambda v, i: v - mu[i]) AS z FROM ({rows}), mu_)"]
    for t in range(count):
        parts.append(f"""p{t}_(step, m) AS (SELECT 0, m FROM m{t}_ UNION ALL SELECT step + 1, list_transform(n, lambda r: list_transform(n, lambda s: {dot('r', 's')}))
            FROM (SELECT step, list_transform(m, lambda r: list_transform(r, lambda v: v / tr)) AS n FROM (SELECT step, m, {trace} AS tr FROM p{t}_ WHERE step < 34)))""")
        parts.append(f"""v{t}_ AS MATERIALIZED (SELECT list_transform(r, lambda v: v / size) AS v FROM (SELECT r, sqrt({dot('r', 'r')}) AS size FROM (
            SELECT m[list_position(d, list_max(d))] AS r FROM (SELECT m, list_transform(m, lambda r, i: r[i]) AS d FROM p{t}_ WHERE step = 34))))""")
        parts.append(f"""m{t + 1}_ AS MATERIALIZED (SELECT list_transform(m, lambda r, i: list_transform(r, lambda x, j: x - l * v[i] * v[j])) AS m
            FROM (SELECT m, v, {dot('v', f'list_transform(m, lambda r: {dot("r", "v")})')} AS l FROM m{t}_, v{t}_))""")
        parts.append(f"z{t + 1}_ AS MATERIALIZED (SELECT * EXCLUDE (a, v) REPLACE (list_transform(z, lambda x, i: x - a * v[i]) AS z) FROM (SELECT *, {dot('z', 'v')} AS a FROM z{t}_, v{t}_))")
    return ", ".join([*parts, f"left_ AS (SELECT * FROM z{count}_)"])
