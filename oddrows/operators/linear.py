"""Least squares and principal components from one mergeable aggregate.

Rows are reduced to cross products by Spark (one pass, map-side combined); only the small
matrices of at most a few dozen columns are solved, for all groups at once."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from oddrows.functions.columns import names, scalar
from oddrows.functions.lineage import written
from oddrows.functions.sizes import with_params

#: widest feature set whose cross products are written as JVM aggregate expressions
JVM_WIDTH = 16
#: most columns of a Gram matrix that is one aggregate expression per cell
JVM_CELLS = 5
#: groups whose partial matrices a task holds before it hands them on
GROUPS_HELD = 2_000


def gram(df: DataFrame, features: Sequence[str], target: str, by=None) -> DataFrame:
    """Per group `n`, the `mean` of (features, target) and `cells`, the flattened matrix of their
    centred cross products; rows with a null in any of them are left out. The aggregate centres as it goes, so
    values far from zero lose nothing. Beyond a few columns the products are formed in Arrow batches: an
    aggregate expression per cell would take longer to compile than to run."""
    keys, used = names(by), df.dropna(subset=[*features, target])
    z = [F.col(c).cast("double") for c in (*features, target)]
    if len(z) > JVM_CELLS:
        return _merged_gram(used.select(*keys, F.array(*z).alias("_z")), len(z), keys)
    m = range(len(z))
    sums = [F.covar_pop(z[i], z[j]).alias(f"c{i}_{j}") for i in m for j in m if i <= j]
    cells = F.array(*[F.col(f"c{min(i, j)}_{max(i, j)}") * F.col("n") for i in m for j in m])
    return used.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.array(*[F.avg(c) for c in z]).alias("mean"), *sums,
    ).select(*keys, "n", "mean", cells.alias("cells"))


def _merged_gram(rows: DataFrame, size: int, keys: list[str]) -> DataFrame:
    """`gram` of rows (keys, _z): every task centres its own rows, and the parts are put together about the common mean."""
    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, tuple[int, np.ndarray, np.ndarray]] = {}

        def out() -> pa.RecordBatch:
            kinds = [*(schema.field(k).type for k in keys)]
            columns = [pa.array([key[i] for key in held], t) for i, t in enumerate(kinds)]
            parts = list(held.values())
            return pa.RecordBatch.from_arrays(
                [*columns, pa.array([n for n, _, _ in parts], pa.int64()), pa.array([m.tolist() for _, m, _ in parts], pa.list_(pa.float64())),
                 pa.array([c.ravel().tolist() for _, _, c in parts], pa.list_(pa.float64()))], [*keys, "n", "mean", "cells"])

        schema = None
        for batch in batches:
            if not batch.num_rows:
                continue
            schema = batch.schema
            z = batch.column("_z").flatten().to_numpy(zero_copy_only=False).reshape(-1, size)
            if keys:
                table = pa.Table.from_batches([batch.select(keys)]).append_column("_i", pa.array(np.arange(batch.num_rows)))
                groups = [(tuple(g[k] for k in keys), g["_i_list"]) for g in table.group_by(keys).aggregate([("_i", "list")]).to_pylist()]
            else:
                groups = [((), slice(None))]
            for key, at in groups:
                own = z[at]
                mean = own.mean(axis=0)
                part = (len(own), mean, (own - mean).T @ (own - mean))
                held[key] = merged([held[key], part]) if key in held else part
            if len(held) > GROUPS_HELD:
                yield out()
                held.clear()
        if held:
            yield out()

    schema = rows.select(*keys, F.lit(0).cast("bigint").alias("n"), F.array(F.lit(0.0)).alias("mean"), F.array(F.lit(0.0)).alias("cells")).schema
    parts = written(rows.mapInArrow(partial, schema))
    total = parts.groupBy(*keys).agg(F.sum("n").alias("_n"), F.array(*[F.sum(F.col("n") * F.col("mean")[i]) / F.sum("n") for i in range(size)]).alias("_mean"))
    both = with_params(parts, total, keys, "inner") if keys else parts.withColumn("_t", scalar(total)).select("*", "_t.*").drop("_t")
    i, j = F.floor(F.col("at") / size).cast("int") + 1, (F.col("at") % size + 1).cast("int")
    off = lambda k: F.element_at("mean", k) - F.element_at("_mean", k)
    each = both.select(*keys, "n", "mean", "_n", "_mean", F.posexplode("cells").alias("at", "cell"))
    summed = each.groupBy(*keys, "at").agg(F.sum(F.col("cell") + F.col("n") * off(i) * off(j)).alias("cell"), F.first("_n").alias("n"), F.first("_mean").alias("mean"))
    packed = F.transform(F.array_sort(F.collect_list(F.struct("at", "cell"))), lambda c: c["cell"])  # size * size numbers
    out = summed.groupBy(*keys).agg(F.first("n").alias("n"), F.first("mean").alias("mean"), packed.alias("cells"))
    if keys:
        return out
    unknown = lambda k: F.array_repeat(F.lit(None).cast("double"), k)
    none = F.col("n").isNull()  # no row at all
    return out.select(F.coalesce("n", F.lit(0)).alias("n"), F.when(none, unknown(size)).otherwise(F.col("mean")).alias("mean"),
                      F.when(none, unknown(size * size)).otherwise(F.col("cells")).alias("cells"))


def centred(flat: Sequence[float], size: int) -> np.ndarray:
    return np.asarray(flat, dtype=float).reshape(size, size)


def merged(parts: Sequence[tuple[int, np.ndarray, np.ndarray]]) -> tuple[int, np.ndarray, np.ndarray]:
    """Count, mean and centred products of the union of disjoint parts."""
    n = sum(k for k, _, _ in parts)
    mean = sum(k * m for k, m, _ in parts) / n
    return n, mean, sum(c + k * np.outer(m - mean, m - mean) for k, m, c in parts)


def _solve(n: int, mean: np.ndarray, c: np.ndarray, keep: Sequence[int], ridge: float) -> tuple[np.ndarray, float]:
    """Coefficients (zeros outside `keep`) and residual sum of squares from centred products.

    Solved on columns scaled to length one, so features of very different size do not
    look dependent."""
    keep = list(keep)
    a, b = c[np.ix_(keep, keep)], c[keep, -1]
    lifted = a + ridge * n * np.eye(len(keep))
    size = np.sqrt(np.maximum(np.diag(lifted), 0.0))
    size[size == 0] = 1.0
    slopes = np.linalg.lstsq(lifted / np.outer(size, size), b / size, rcond=None)[0] / size if keep else np.zeros(0)
    full = np.zeros(len(mean))
    full[[i + 1 for i in keep]] = slopes
    full[0] = mean[-1] - mean[keep] @ slopes
    return full, float(max(c[-1, -1] - 2 * slopes @ b + slopes @ a @ slopes, 0.0))


def solve_subsets(
    grams: DataFrame, features: Sequence[str], subsets: Sequence[Sequence[str]], ridge: float = 0.0, by=None,
) -> DataFrame:
    """One row per group and feature subset: `model`, `coef` (intercept first, zeros for
    features left out), `rss`, `n`."""
    size = len(features) + 1
    keeps = [[list(features).index(f) for f in s] for s in subsets]

    @F.pandas_udf("array<array<double>>")
    def fit(ns: pd.Series, means: pd.Series, cells: pd.Series) -> pd.Series:
        out = []
        for n, mean, flat in zip(ns, means, cells):
            fits = [_solve(n, np.asarray(mean, dtype=float), centred(flat, size), keep, ridge) for keep in keeps]
            out.append([[*coef, rss] for coef, rss in fits])
        return pd.Series(out)

    solved = grams.select(*names(by), "n", F.posexplode(fit("n", "mean", "cells")).alias("model", "fit"))
    return solved.select(
        *names(by), "model", "n", F.slice("fit", 1, size).alias("coef"), F.col("fit")[size].alias("rss"))


def fit_linear(df: DataFrame, features: Sequence[str], target: str, by=None, ridge: float = 0.0) -> DataFrame:
    """Least squares with intercept per group: `coef` (intercept first), `rss`, `n`."""
    return solve_subsets(gram(df, features, target, by), features, [features], ridge, by).drop("model")


def linear_value(coef: Column, features: Sequence[str]) -> Column:
    """coef[0] + coef[1] * f1 + ...; null when a feature is null."""
    value = coef[0]
    for i, f in enumerate(features):
        value = value + coef[i + 1] * F.col(f)
    return value


def apply_linear(df: DataFrame, params: DataFrame, features: Sequence[str], by=None, to: str = "predicted") -> DataFrame:
    """Prediction of a fitted model: a scalar subquery for one model, a join for many."""
    if names(by):
        out = with_params(df, params.select(*names(by), F.col("coef").alias("_coef")), by)
    else:
        out = df.withColumn("_coef", params.select("coef").scalar())
    return out.withColumn(to, linear_value(F.col("_coef"), features)).drop("_coef")


def cross_validated_ridge(
    df: DataFrame, features: Sequence[str], target: str, fold: str, ridges: Sequence[float],
) -> DataFrame:
    """Held-out squared error of every ridge strength, from one Gram matrix per fold."""
    size = len(features) + 1
    keep = list(range(len(features)))
    folds = gram(df, features, target, fold)

    @F.pandas_udf("array<double>")
    def errors(packs: pd.Series) -> pd.Series:
        out = []
        for pack in packs:
            parts = [(p["n"], np.asarray(p["mean"], dtype=float), centred(p["cells"], size)) for p in pack]
            total = sum(n for n, _, _ in parts)
            row = []
            for ridge in ridges:
                rss = 0.0
                for k, (n, mean, c) in enumerate(parts):
                    rest = parts[:k] + parts[k + 1:]
                    b = _solve(*merged(rest), keep, ridge)[0] if rest else np.zeros(size)
                    miss = mean[-1] - b[0] - mean[:-1] @ b[1:]
                    rss += n * miss**2 + c[-1, -1] - 2 * b[1:] @ c[:-1, -1] + b[1:] @ c[:-1, :-1] @ b[1:]
                row.append(rss / total)
            out.append(row)
        return pd.Series(out)

    packed = folds.agg(F.array_sort(F.collect_list(F.struct("n", "mean", "cells"))).alias("packs"))  # one entry per fold
    scored = packed.select(F.posexplode(errors("packs")).alias("i", "mse"))
    return scored.select(F.element_at(F.array(*[F.lit(float(r)) for r in ridges]), F.col("i") + 1).alias("ridge"), "mse")


def mean_and_covariance(df: DataFrame, features: Sequence[Column]) -> tuple[int, np.ndarray, np.ndarray]:
    """Row count, mean and sample covariance; only the d x d result reaches the driver."""
    d = len(features)
    cols = [f.cast("double").alias(f"x{i}") for i, f in enumerate(features)]
    x = df.select(*cols).dropna()
    head = x.agg(F.count(F.lit(1)).alias("n"), *[F.avg(f"x{i}").alias(f"m{i}") for i in range(d)]).first()
    n, mean = head["n"], np.array([head[f"m{i}"] for i in range(d)], dtype=float)
    if d <= JVM_WIDTH:
        pairs = [(i, j) for i in range(d) for j in range(i, d)]
        row = x.agg(*[F.covar_samp(f"x{i}", f"x{j}").alias(f"c{i}_{j}") for i, j in pairs]).first()
        cov = np.zeros((d, d))
        for i, j in pairs:
            cov[i, j] = cov[j, i] = row[f"c{i}_{j}"]
        return n, mean, cov

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((d, d))
        for batch in batches:
            c = batch.to_numpy(dtype=float) - mean
            total += c.T @ c
        yield pd.DataFrame({"i": np.arange(d), "row": list(total)})

    parts = x.mapInPandas(partial, "i int, row array<double>")
    sums = parts.groupBy("i").agg(F.array(*[F.sum(F.col("row")[j]) for j in range(d)]).alias("row"))
    cov = np.zeros((d, d))
    for r in sums.collect():  # d rows
        cov[r["i"]] = r["row"]
    return n, mean, cov / (n - 1)


def _features(df: DataFrame, columns: str | Sequence[str], width: int | None) -> list[Column]:
    if isinstance(columns, str):
        return [F.get(F.col(columns), F.lit(i)) for i in range(width)]
    return [F.col(c) for c in columns]


def pca_fit(
    df: DataFrame, columns: str | Sequence[str], k: int | None = None, width: int | None = None,
    standardize: bool = False,
) -> DataFrame:
    """Principal components, largest variance first: `component, variance, vector, mean, scale`.

    `columns` is a list of columns or one array column with `width` elements. The sign makes
    the largest loading positive. `standardize` divides by the population std first."""
    features = _features(df, columns, width)
    n, mean, cov = mean_and_covariance(df, features)
    scale = np.ones(len(features))
    if standardize:
        std = np.sqrt(np.diag(cov) * (n - 1) / n)
        scale = np.where(std == 0, 1.0, std)
        cov = cov / np.outer(scale, scale)
    values, vectors = np.linalg.eigh(cov)
    rows = []
    for c, at in enumerate(np.argsort(-values)[: k or len(features)]):
        v = vectors[:, at]
        v = v if v[np.argmax(np.abs(v))] > 0 else -v
        rows.append((c, float(values[at]), v.tolist(), mean.tolist(), scale.tolist()))
    schema = "component int, variance double, vector array<double>, mean array<double>, scale array<double>"
    return df.sparkSession.createDataFrame(rows, schema)


def pca_project(df: DataFrame, params: DataFrame, columns: str | Sequence[str], width: int | None = None) -> DataFrame:
    """Centred projection on the fitted components: adds `pc1`, `pc2`, ..."""
    fitted = params.orderBy("component").collect()  # one row per component
    features = _features(df, columns, width)
    out = {}
    for r in fitted:
        total = F.lit(0.0)
        for f, w, m, s in zip(features, r["vector"], r["mean"], r["scale"]):
            total = total + (f.cast("double") - m) * (w / s)
        out[f"pc{r['component'] + 1}"] = total
    return df.withColumns(out)


def reconstruction_error(
    df: DataFrame, params: DataFrame, columns: str | Sequence[str], loss: str = "mse", to: str = "score",
) -> DataFrame:
    """Error of rebuilding a row from its components: mean square (`mse`) or sum of absolute
    differences (`l1`). Fit `params` on normal rows only."""
    fitted = params.orderBy("component").collect()
    basis = np.array([r["vector"] for r in fitted])
    mean, scale = np.array(fitted[0]["mean"]), np.array(fitted[0]["scale"])

    @F.pandas_udf("double")
    def error(xs: pd.Series) -> pd.Series:
        z = (np.stack(xs.to_numpy()).astype(float) - mean) / scale
        rest = z - (z @ basis.T) @ basis
        return pd.Series(np.mean(rest**2, axis=1) if loss == "mse" else np.sum(np.abs(rest), axis=1))

    row = F.col(columns) if isinstance(columns, str) else F.array(*columns)
    return df.withColumn(to, error(row.cast("array<double>")))


def ablation(
    df: DataFrame, target: str, variants: Mapping[str, Sequence[str]], train: Column, ridge: float = 0.0,
) -> DataFrame:
    """Coefficients of several feature sets from one shared Gram matrix: `variant, coef, rss, n`.

    All variants are fitted on the same rows: those with every feature present."""
    features = list(dict.fromkeys(f for v in variants.values() for f in v))
    grams = gram(df.filter(train), features, target)
    solved = solve_subsets(grams, features, list(variants.values()), ridge)
    label = F.element_at(F.array(*[F.lit(v) for v in variants]), F.col("model") + 1)
    return solved.select(label.alias("variant"), "coef", "rss", "n")
