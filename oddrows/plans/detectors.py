"""Queries: detectors and forecasts."""

from __future__ import annotations

from pyspark.sql import functions as F

from oddrows.functions.columns import rounded
from oddrows.functions.lineage import written
from oddrows.operators import clustering, forecast, forest, histogram, joins, linear, nearest, neighbours, sequence, stats, thresholds
from oddrows.operators.forest import SPARE
from oddrows.operators.scaling import zscore_apply, zscore_fit
from oddrows.plans.registry import H, R, Tables, U, components_sql, least_squares_sql, mahalanobis_sql, query
from oddrows.plans.series import HOURLY_SQL, TREND_SQL, W, daily, day_text, early, hourly, train_rows
from oddrows.operators.text import build_vocabulary, hash_vectors, pooled_text_vector
from oddrows.plans.tables import DATED_SQL, KEYED_SQL, dated_texts, keyed, vocabulary_sql, words_sql

# ---------------------------------------------------------------- fences and thresholds


@query("iqr_fence", f"""WITH q AS (SELECT quantile_cont(l_extendedprice, 0.25) AS a, quantile_cont(l_extendedprice, 0.75) AS b,
    quantile_cont(l_quantity, 0.25) AS c, quantile_cont(l_quantity, 0.75) AS d FROM lineitem),
    f AS (SELECT a - 1.5 * (b - a) AS lo1, b + 1.5 * (b - a) AS hi1, c - 1.5 * (d - c) AS lo2, d + 1.5 * (d - c) AS hi2 FROM q)
    SELECT l_orderkey, l_extendedprice, (l_extendedprice < lo1 OR l_extendedprice > hi1)::INT AS l_extendedprice_outlier,
    (l_quantity < lo2 OR l_quantity > hi2)::INT AS l_quantity_outlier,
    {R('greatest(lo1 - l_extendedprice, l_extendedprice - hi1, lo2 - l_quantity, l_quantity - hi2, 0)', 4)} AS score,
    (l_extendedprice < lo1 OR l_extendedprice > hi1 OR l_quantity < lo2 OR l_quantity > hi2)::INT AS is_outlier FROM lineitem, f""", digits=4)
def _(t: Tables):
    rows = t.lineitem.select("l_orderkey", "l_extendedprice", "l_quantity")
    fences = thresholds.fit_iqr_fence(rows, ["l_extendedprice", "l_quantity"])
    return thresholds.score_iqr_fence(rows, fences, ["l_extendedprice", "l_quantity"]).drop("l_quantity")


@query("iqr_fence_by_group", f"""WITH q AS (SELECT event_type, quantile_cont(value, 0.25) AS a, quantile_cont(value, 0.75) AS b FROM events GROUP BY 1),
    f AS (SELECT event_type, a - 1.5 * (b - a) AS lo, b + 1.5 * (b - a) AS hi FROM q)
    SELECT event_id, (value < lo OR value > hi)::INT AS value_outlier, {R('greatest(lo - value, value - hi, 0)')} AS score,
    (value < lo OR value > hi)::INT AS is_outlier FROM events JOIN f USING (event_type)""")
def _(t: Tables):
    rows = t.events.select("event_id", "event_type", "value")
    fences = thresholds.fit_iqr_fence(rows, "value", "event_type")
    return thresholds.score_iqr_fence(rows, fences, "value", "event_type").drop("event_type", "value")


@query("contamination_threshold", f"""WITH s AS (SELECT o_orderkey, abs(o_totalprice - avg(o_totalprice) OVER ()) AS score FROM orders),
    q AS (SELECT quantile_cont(score, 0.99) AS threshold FROM s)
    SELECT o_orderkey, {R('score', 4)} AS score, (score > threshold)::INT AS is_outlier FROM s, q""", digits=4)
def _(t: Tables):
    mean = t.orders.agg(F.avg("o_totalprice")).scalar()
    scored = t.orders.select("o_orderkey", F.abs(F.col("o_totalprice") - mean).alias("score"))
    return thresholds.flag_above(scored, thresholds.fit_contamination(scored, "score", 0.01))


@query("three_sigma_threshold", f"""WITH p AS (SELECT avg(value) AS m FROM events WHERE ts < TIMESTAMP '2024-01-16'),
    e AS (SELECT event_id, ts, pow(value - m, 2) AS score FROM events, p),
    h AS (SELECT avg(score) + 3 * stddev_samp(score) AS threshold FROM e WHERE ts < TIMESTAMP '2024-01-16')
    SELECT event_id, {R('score')} AS score, (score > threshold)::INT AS is_outlier FROM e, h""")
def _(t: Tables):
    m = train_rows(t).agg(F.avg("value")).scalar()
    square = lambda df: df.select("event_id", ((F.col("value") - m) * (F.col("value") - m)).alias("score"))
    return thresholds.flag_above(square(t.events), thresholds.fit_three_sigma(square(train_rows(t)), "score"))


@query("error_threshold", f"""SELECT event_id, {R('z')} AS score, (z > 2.9)::INT AS is_outlier FROM (SELECT event_id,
    abs(value - avg(value) OVER ()) / stddev_pop(value) OVER () AS z FROM events)""")
def _(t: Tables):
    z = zscore_apply(t.events.select("event_id", "value"), zscore_fit(t.events, "value"), "value")
    return thresholds.flag_above(z.select("event_id", F.abs("value").alias("score")), 2.9)


BANDS_SQL = f"""{TREND_SQL}, e AS (SELECT date, total - trend AS error, (total - trend) / total * 100 AS pc FROM r),
    b AS (SELECT *, CASE WHEN count(*) OVER w = 7 THEN avg(error) OVER w END AS m,
        CASE WHEN count(*) OVER w = 7 THEN stddev_samp(error) OVER w END AS d FROM e
        WINDOW w AS (ORDER BY date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)),
    i AS (SELECT *, CASE WHEN d IS NULL THEN NULL WHEN d = 0 THEN 3 ELSE (m - 2 * d < error)::INT + (m - 1.75 * d < error)::INT
        + (m - 1.5 * d < error)::INT + (m < error)::INT + (m + 1.5 * d < error)::INT + (m + 1.75 * d < error)::INT
        + (m + 2 * d < error)::INT END AS impact FROM b),
    v AS (SELECT *, [3, 2, 1, 0, 0, 1, 2, 3][impact + 1] AS color,
        CASE WHEN impact <= 3 THEN 'NEGATIVE' WHEN impact >= 4 THEN 'POSITIVE' END AS region FROM i)"""


def banded(t: Tables, missing_is_severe: bool = False):
    days = forecast.seasonal_forecast_residual(daily(t), "date", "total", early())
    days = days.select("date", F.col("total").alias("actuals"), F.col("trend").alias("predicted"))
    return thresholds.rolling_error_bands(days, 7, missing_is_severe=missing_is_severe, hot_rows=None)  # one row per day


@query("rolling_error_bands", f"""{BANDS_SQL} SELECT strftime(date, '%Y-%m-%d') AS date, {R('error', 4)} AS error, {R('pc', 4)} AS percentage_change,
    {R('m', 4)} AS meanval, {R('d', 2)} AS deviation, {R('m - 2 * d', 2)} AS low_1, {R('m + 1.5 * d', 2)} AS high_3,
    impact::INT AS impact, color::INT AS color, region, {R('CASE WHEN color = 3 THEN error END', 4)} AS anomaly_points FROM v""", digits=4)
def _(t: Tables):
    out = day_text(banded(t)).withColumns({c: rounded(c, 2) for c in ("deviation", "low_1", "high_3")})
    return out.select("date", "error", "percentage_change", "meanval", "deviation", "low_1", "high_3",
                      "impact", "color", "region", "anomaly_points")


SEVERE_SQL = BANDS_SQL.replace("CASE WHEN d IS NULL THEN NULL WHEN d = 0 THEN 3 ELSE", "CASE WHEN d IS NULL OR d = 0 THEN 0 ELSE")


@query("rolling_error_bands_missing", f"""{SEVERE_SQL} SELECT strftime(date, '%Y-%m-%d') AS date, {R('error', 4)} AS error, {R('m', 4)} AS meanval,
    impact::INT AS impact, color::INT AS color, region, {R('CASE WHEN color = 3 THEN error END', 4)} AS anomaly_points FROM v""", digits=4)
def _(t: Tables):
    """Days before the window is full, or without deviation, count as severe."""
    return day_text(banded(t, True)).select("date", "error", "meanval", "impact", "color", "region", "anomaly_points")


@query("severity_counts", f"{BANDS_SQL} SELECT color::INT AS color, region, count(*)::BIGINT AS n FROM v GROUP BY 1, 2")
def _(t: Tables):
    return stats.class_counts(banded(t), ["color", "region"])


@query("seasonal_forecast_residual", f"""{TREND_SQL} SELECT strftime(date, '%Y-%m-%d') AS date, {R('total - trend', 4)} AS residual FROM r""", digits=4)
def _(t: Tables):
    return day_text(forecast.seasonal_forecast_residual(daily(t), "date", "total", early())).select("date", "residual")


@query("score_new_rows", f"""WITH p AS (SELECT quantile_cont(value, 0.25) AS a, quantile_cont(value, 0.75) AS b,
    avg(value) + 3 * stddev_samp(value) AS s FROM events WHERE ts < TIMESTAMP '2024-01-16')
    SELECT event_id, (value < a - 1.5 * (b - a) OR value > b + 1.5 * (b - a))::INT AS by_fence, (value > s)::INT AS by_sigma
    FROM events, p WHERE ts >= TIMESTAMP '2024-01-16'""")
def _(t: Tables):
    train, new = train_rows(t), t.events.filter(F.col("ts") >= F.expr("TIMESTAMP_NTZ '2024-01-16'"))
    out = thresholds.score_iqr_fence(new, thresholds.fit_iqr_fence(train, "value"), "value")
    out = out.withColumnRenamed("is_outlier", "by_fence")
    out = thresholds.flag_above(out, thresholds.fit_three_sigma(train, "value"), "value", "by_sigma")
    return out.select("event_id", "by_fence", "by_sigma")


# ---------------------------------------------------------------- clustering


XY = "SELECT event_id AS id, value AS x, json_extract(props, '$.k')::DOUBLE AS y FROM events"


def converged_sql(source: str, k: int) -> str:
    """k-means on `source(id, x, y)` until no centre moves by more than 1e-9 of a column's spread: `steps` holds the
    centres of every round, `c` the last ones, `a` their assignment."""
    start = ", ".join(f"{{'cx': quantile_cont(x, {(i + 0.5) / k}), 'cy': quantile_cont(y, {(i + 0.5) / k})}}" for i in range(k))
    far = "list_transform(cs, lambda s: sqrt(pow(x - s.cx, 2) + pow(y - s.cy, 2)))"
    return f"""WITH RECURSIVE p AS MATERIALIZED ({source}), lim AS (SELECT 1e-9 * (max(x) - min(x)) AS lx, 1e-9 * (max(y) - min(y)) AS ly FROM p),
    r(step, cs, moved) AS (SELECT 0, [{start}], TRUE FROM p UNION ALL
        SELECT step + 1, list_transform(cs, lambda s, i: coalesce(m[i - 1], s)),
            len(list_filter(cs, lambda s, i: coalesce(abs(m[i - 1].cx - s.cx) > lx OR abs(m[i - 1].cy - s.cy) > ly, FALSE))) > 0
        FROM (SELECT step, cs, map_from_entries(list((c, mean))) AS m
            FROM (SELECT step, cs, c, {{'cx': avg(x), 'cy': avg(y)}} AS mean
                FROM (SELECT step, cs, x, y, list_position(ds, list_min(ds)) - 1 AS c
                    FROM (SELECT step, cs, x, y, {far} AS ds FROM p, r WHERE moved)) GROUP BY step, cs, c) GROUP BY step, cs), lim),
    steps AS (SELECT step, cs FROM r WHERE step < (SELECT max(step) FROM r)),
    l0 AS (SELECT cs FROM steps ORDER BY step DESC LIMIT 1),
    c AS (SELECT i AS c, cs[i + 1].cx AS cx, cs[i + 1].cy AS cy FROM l0, range({k}) g(i)),
    a AS (SELECT id, x, y, list_position(ds, list_min(ds)) - 1 AS c, list_min(ds) AS d FROM (SELECT id, x, y, {far} AS ds FROM p, l0))"""


@query("kmeans_distance_outliers", f"""{converged_sql(XY, 2)}, h AS (SELECT min(d) AS threshold FROM (SELECT d FROM a ORDER BY d DESC
    LIMIT (SELECT floor(count(*) * 0.13::DOUBLE)::BIGINT FROM p)))
    SELECT id AS event_id, c::INT AS cluster, {R('d')} AS score, (d >= threshold)::INT AS is_outlier FROM a, h""")
def _(t: Tables):
    rows = keyed(t).select("event_id", "value", "k")
    fitted = clustering.lloyd(rows, ["value", "k"], 2)
    return clustering.kmeans_distance_outliers(rows, fitted, 0.13).select("event_id", "cluster", "score", "is_outlier")


@query("kmeans_threshold_outliers", f"""{converged_sql(XY, 4)} SELECT id AS event_id, c::INT AS cluster, {R('d')} AS score,
    (d > 40)::INT AS is_outlier FROM a""")
def _(t: Tables):
    rows = keyed(t).select("event_id", "value", "k")
    fitted = clustering.lloyd(rows, ["value", "k"], 4)
    return clustering.kmeans_threshold_outliers(rows, fitted, 40.0).select("event_id", "cluster", "score", "is_outlier")


@query("kmeans_ml")
def _(t: Tables):
    rows = keyed(t).select("event_id", "value", "k")
    fitted = clustering.kmeans_fit(rows, ["value", "k"], 2)
    return clustering.kmeans_distance_outliers(rows, fitted, 0.13).groupBy("is_outlier").agg(F.count(F.lit(1)).alias("n"))


@query("loss_history_best", f"""{converged_sql(XY, 4)}, h AS (SELECT step, sum(list_min({"list_transform(cs, lambda s: pow(x - s.cx, 2) + pow(y - s.cy, 2))"})) AS loss
    FROM p, steps GROUP BY step)
    SELECT count(*)::BIGINT AS steps, arg_min(step, loss)::INT AS best_step, {R('min(loss)', 3)} AS best_loss FROM h""", digits=3)
def _(t: Tables):
    from oddrows.operators.evaluation import loss_history_best
    rows = keyed(t)
    return loss_history_best(clustering.lloyd(rows, ["value", "k"], 4).history_table(rows))


@query("cblof", f"""{converged_sql(XY, 8)}, s AS (SELECT c, count(*) AS n FROM a GROUP BY c),
    o AS (SELECT c, n, row_number() OVER (ORDER BY n DESC, c) AS r, sum(n) OVER (ORDER BY n DESC, c ROWS UNBOUNDED PRECEDING) AS held,
        lead(n) OVER (ORDER BY n DESC, c) AS after, sum(n) OVER () AS total FROM s),
    b AS (SELECT coalesce(min(o.r) FILTER (held >= total * 0.9 AND n / after >= 5), min(o.r) FILTER (held >= total * 0.9),
        min(o.r) FILTER (n / after >= 5), max(o.r) + 1) AS cut FROM o WHERE after IS NOT NULL),
    l AS (SELECT o.c, cx, cy FROM o JOIN b ON o.r <= cut JOIN c USING (c)),
    m AS (SELECT id, min(sqrt(pow(x - cx, 2) + pow(y - cy, 2))) AS near FROM p, l GROUP BY id)
    SELECT a.id AS event_id, a.c::INT AS cluster, {R('CASE WHEN a.c IN (SELECT c FROM l) THEN a.d ELSE near END')} AS score
    FROM a JOIN m ON a.id = m.id""")
def _(t: Tables):
    rows = keyed(t).select("event_id", "value", "k")
    fitted = clustering.lloyd(rows, ["value", "k"], 8)
    return clustering.cblof(rows, fitted).select("event_id", "cluster", "score")


# ---------------------------------------------------------------- neighbours, histogram, forest


@query("knn_distance_1d", f"""WITH s AS (SELECT o_orderkey, o_totalprice AS x, {', '.join(
    f'o_totalprice - lag(o_totalprice, {i}) OVER w AS a{i}, lead(o_totalprice, {i}) OVER w - o_totalprice AS b{i}' for i in range(1, 6))}
    FROM orders WINDOW w AS (ORDER BY o_totalprice, o_orderkey))
    SELECT o_orderkey, {R('list_sort(list_filter([a1, a2, a3, a4, a5, b1, b2, b3, b4, b5], lambda v: v IS NOT NULL))[5]', 4)} AS score FROM s""", digits=4)
def _(t: Tables):
    return neighbours.knn_distance_1d(t.orders.select("o_orderkey", "o_totalprice"), "o_totalprice", "o_orderkey", 5).select("o_orderkey", "score")


@query("knn_distance", f"""WITH p AS ({KEYED_SQL}), d AS (SELECT a.event_id, min(sqrt(pow(a.value - b.value, 2) + pow(a.k - b.k, 2)), 5) AS near
    FROM p a JOIN p b ON a.event_id <> b.event_id GROUP BY 1)
    SELECT event_id, {R('near[5]')} AS score FROM d""")
def _(t: Tables):
    return neighbours.knn_distance(keyed(t).select("event_id", "value", "k"), ["value", "k"], 5).select("event_id", "score")


@query("knn_outliers", f"""WITH p AS (SELECT p_partkey, p_retailprice AS x, p_size::DOUBLE AS y FROM part),
    d AS (SELECT a.p_partkey, min(sqrt(pow(a.x - b.x, 2) + pow(a.y - b.y, 2)), 5) AS near
    FROM p a JOIN p b ON a.p_partkey <> b.p_partkey GROUP BY 1),
    q AS (SELECT quantile_cont(near[5], 0.99) AS threshold FROM d)
    SELECT p_partkey, {R('near[5]')} AS score, (near[5] > threshold)::INT AS is_outlier FROM d, q""")
def _(t: Tables):
    rows = t.part.select("p_partkey", "p_retailprice", "p_size")
    scored = written(neighbours.knn_distance(rows, ["p_retailprice", "p_size"], 5).select("p_partkey", "score"))
    return thresholds.flag_above(scored, thresholds.fit_contamination(scored, "score", 0.01))


WIDE_SQL = """p AS (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings),
    d AS MATERIALIZED (SELECT a.vec_id, b.vec_id AS other, list_distance(a.v, b.v) AS d FROM p a JOIN p b ON a.vec_id <> b.vec_id)"""


@query("knn_distance_wide", f"""WITH {WIDE_SQL} SELECT vec_id, {R('min(d, 5)[5]')} AS score FROM d GROUP BY vec_id""")
def _(t: Tables):
    """Distance to the fifth nearest vector in all 64 columns."""
    return nearest.knn_distance(t.embeddings, "embedding", 5).select("vec_id", "score")


@query("local_outlier_factor", f"""WITH {WIDE_SQL}, kd AS (SELECT vec_id, min(d, 20)[20] AS kd FROM d GROUP BY 1),
    n AS (SELECT d.* FROM d JOIN kd USING (vec_id) WHERE d <= kd),
    r AS (SELECT n.vec_id, count(*) / (sum(greatest(kd, d)) + 1e-10 * count(*)) AS density FROM n JOIN kd ON kd.vec_id = n.other GROUP BY 1),
    f AS (SELECT n.vec_id, avg(o.density) / any_value(r.density) AS score FROM n JOIN r ON r.vec_id = n.vec_id JOIN r o ON o.vec_id = n.other GROUP BY 1),
    q AS (SELECT quantile_cont(score, 0.99) AS threshold FROM f)
    SELECT vec_id, {R('score')} AS score, (score > threshold)::INT AS is_outlier FROM f, q""")
def _(t: Tables):
    """The hundredth of the vectors that lies in the thinnest places compared with their neighbours."""
    scored = written(nearest.local_outlier_factor(t.embeddings, "embedding", 20).select("vec_id", "score"))
    return thresholds.flag_above(scored, thresholds.fit_contamination(scored, "score", 0.01))


def hbos_sql(features: list[str]) -> str:
    ends = ", ".join(f"min({f}) AS lo{i}, max({f}) AS hi{i}" for i, f in enumerate(features))
    bins = ", ".join(f"least(floor(({f} - lo{i}) * 10 / (hi{i} - lo{i})), 9) AS b{i}" for i, f in enumerate(features))
    tables = ", ".join(f"h{i} AS (SELECT b{i}, log2(count(*) / ((SELECT count(*) FROM b) * any_value((hi{i} - lo{i}) / 10)) + 0.1) AS s{i} FROM b GROUP BY 1)"
                       for i in range(len(features)))
    using = " ".join(f"JOIN h{i} USING (b{i})" for i in range(len(features)))
    total = " + ".join(f"s{i}" for i in range(len(features)))
    return f"""WITH e AS (SELECT {ends} FROM lineitem), b AS (SELECT lineitem.*, e.*, {bins} FROM lineitem, e), {tables}
        SELECT l_orderkey, l_extendedprice, {R(f'-({total})')} AS score FROM b {using}"""


@query("hbos", hbos_sql(["l_extendedprice", "l_quantity", "l_discount"]))
def _(t: Tables):
    features = ["l_extendedprice", "l_quantity", "l_discount"]
    rows = t.lineitem.select("l_orderkey", *features)
    return histogram.score_hbos(rows, histogram.fit_hbos(rows, features), features).select("l_orderkey", "l_extendedprice", "score")


def forest_sql(source: str, features: int, trees: int, sample: int, depth: int, scored: str) -> str:
    """The forest unrolled: n<i> are the sample rows before level i, s<i> the splits made there."""
    f = range(features)
    xs = ", ".join(f"x{i}" for i in f)
    gap = lambda i: f"floor(ln({U(f"'0:s:' || id || ':' || {i}")}) / ln(1 - rate))"
    parts = [f"p AS MATERIALIZED ({source})", f"rt AS (SELECT {SPARE * sample}::DOUBLE / count(*) AS rate FROM p)",
             f"""dr(id, i, pos) AS (SELECT id, 0::BIGINT, {gap('0')} FROM p, rt WHERE rate < 1
                 UNION ALL SELECT id, i + 1, pos + 1 + {gap('(i + 1)')} FROM dr, rt WHERE pos < {trees})""",
             f"""dt AS (SELECT id, pos::BIGINT AS tree FROM dr WHERE pos < {trees} UNION ALL
                 SELECT id, tree FROM p, rt, range({trees}) g(tree) WHERE rate >= 1)""",
             f"""n0 AS (SELECT tree, id, {xs}, 1::BIGINT AS node FROM (SELECT tree, p.*, row_number() OVER (PARTITION BY tree
                 ORDER BY {H("'0:' || tree || ':' || id")}, id) AS r FROM dt JOIN p USING (id)) WHERE r <= {sample})"""]
    for i in range(depth):
        spans = ", ".join(f"min(x{j}) AS lo{j}, max(x{j}) AS hi{j}" for j in f)
        live = "list_filter([" + ", ".join(f"CASE WHEN lo{j} < hi{j} THEN {j} END" for j in f) + "], lambda v: v IS NOT NULL)"
        lo = "[" + ", ".join(f"lo{j}" for j in f) + "]"
        hi = "[" + ", ".join(f"hi{j}" for j in f) + "]"
        parts.append(f"s{i} AS (SELECT tree, node, f, {lo}[f + 1] + {U(chr(39) + '0:c:' + chr(39) + ' || tree || ' + chr(39) + ':' + chr(39) + ' || node')} * ({hi}[f + 1] - {lo}[f + 1]) AS cut "
                     f"FROM (SELECT *, live[(({H(chr(39) + '0:f:' + chr(39) + ' || tree || ' + chr(39) + ':' + chr(39) + ' || node')}) % len(live)) + 1] AS f "
                     f"FROM (SELECT *, {live} AS live FROM (SELECT tree, node, {spans} FROM n{i} GROUP BY 1, 2)) WHERE len(live) > 0))")
        parts.append(f"""n{i + 1} AS (SELECT n.tree, n.id, {', '.join(f'n.x{j}' for j in f)}, CASE WHEN s.node IS NULL THEN n.node
            ELSE 2 * n.node + ([{', '.join(f'n.x{j}' for j in f)}][s.f + 1] >= s.cut)::BIGINT END AS node
            FROM n{i} n LEFT JOIN s{i} s ON s.tree = n.tree AND s.node = n.node)""")
    splits = " UNION ALL ".join(f"SELECT * FROM s{i}" for i in range(depth))
    c = lambda n: f"CASE WHEN {n} <= 1 THEN 0 WHEN {n} = 2 THEN 1 ELSE 2 * (ln({n} - 1) + 0.5772156649) - 2.0 * ({n} - 1) / {n} END"
    parts.append(f"inner_nodes AS (SELECT DISTINCT tree, node, f, cut FROM ({splits}))")
    parts.append(f"leaves AS (SELECT tree, node, count(*)::DOUBLE AS size FROM n{depth} GROUP BY 1, 2)")
    parts.append(f"q AS ({scored})")
    parts.append(f"d0 AS (SELECT tree, id, {xs}, 1::BIGINT AS node FROM q, range({trees}) g(tree))")
    for i in range(depth):
        parts.append(f"""d{i + 1} AS (SELECT d.tree, d.id, {', '.join(f'd.x{j}' for j in f)}, CASE WHEN s.node IS NULL THEN d.node
            ELSE 2 * d.node + ([{', '.join(f'd.x{j}' for j in f)}][s.f + 1] >= s.cut)::BIGINT END AS node
            FROM d{i} d LEFT JOIN inner_nodes s ON s.tree = d.tree AND s.node = d.node)""")
    parts.append(f"""scores AS (SELECT id, pow(2.0, -avg(floor(log2(d.node)) + {c('size')}) / (SELECT {c(f'm')} FROM
        (SELECT least({sample}, (SELECT count(*) FROM p))::DOUBLE AS m))) AS score
        FROM d{depth} d JOIN leaves l ON l.tree = d.tree AND l.node = d.node GROUP BY id)""")
    return "WITH RECURSIVE " + ", ".join(parts)


XYF = "SELECT event_id AS id, value AS x0, json_extract(props, '$.k')::DOUBLE AS x1 FROM events"


@query("isolation_forest", f"""{forest_sql(XYF, 2, 100, 256, 8, XYF)}, h AS (SELECT quantile_cont(score, 0.87) AS threshold FROM scores)
    SELECT id AS event_id, {R('score')} AS score, (score > threshold)::INT AS is_outlier FROM scores, h""")
def _(t: Tables):
    rows = keyed(t).select("event_id", "value", "k")
    trees = forest.fit_isolation_forest(rows, ["value", "k"], "event_id")
    scored = written(forest.score_isolation_forest(rows, trees, ["value", "k"]).select("event_id", "score"))
    return thresholds.flag_above(scored, thresholds.fit_contamination(scored, "score", 0.13))


@query("isolation_forest_100", f"{forest_sql(XYF, 2, 100, 256, 8, XYF)} SELECT id AS event_id, {R('score')} AS score FROM scores")
def _(t: Tables):
    rows = keyed(t).select("event_id", "value", "k")
    trees = forest.fit_isolation_forest(rows, ["value", "k"], "event_id")
    return forest.score_isolation_forest(rows, trees, ["value", "k"]).select("event_id", "score")


GRID = "SELECT i AS id, lo + (hi - lo) * i / 999 AS x0 FROM (SELECT min(o_totalprice) AS lo, max(o_totalprice) AS hi FROM orders), range(1000) r(i)"


@query("isolation_forest_1d", f"""{forest_sql('SELECT o_orderkey AS id, o_totalprice AS x0 FROM orders', 1, 100, 256, 8, GRID)},
    g AS (SELECT q.id, x0, score, (score > 0.5)::INT AS flag FROM q JOIN scores USING (id)),
    s AS (SELECT *, CASE WHEN flag = 1 AND coalesce(lag(flag) OVER (ORDER BY x0), 0) <> 1 THEN 1 ELSE 0 END AS st FROM g),
    r AS (SELECT *, sum(st) OVER (ORDER BY x0) AS region FROM s)
    SELECT region::BIGINT AS region, {R('min(x0)', 4)} AS lo, {R('max(x0)', 4)} AS hi, count(*)::BIGINT AS points FROM r WHERE flag = 1 GROUP BY 1""", digits=4)
def _(t: Tables):
    rows = t.orders.select("o_orderkey", "o_totalprice")
    trees = forest.fit_isolation_forest(rows, ["o_totalprice"], "o_orderkey")
    grid = joins.value_grid(rows, "o_totalprice", 1000)  # the grid bounds every later step
    scored = thresholds.flag_above(forest.score_isolation_forest(grid, trees, ["o_totalprice"]), 0.5)
    return sequence.outlier_regions(scored, "is_outlier", "o_totalprice", "o_totalprice", hot_rows=None)


# ---------------------------------------------------------------- linear models

PCA_SQL = f"""WITH p AS ({KEYED_SQL}), m AS (SELECT avg(value) AS mx, avg(k) AS my, var_samp(value) AS a, covar_samp(value, k) AS b,
    var_samp(k) AS c, stddev_pop(value) AS sx, stddev_pop(k) AS sy FROM p)"""


@query("pca_variance", f"""{PCA_SQL}, s AS (SELECT a / (sx * sx) AS a, b / (sx * sy) AS b, c / (sy * sy) AS c FROM m)
    SELECT i::INT AS component, {R('(a + c) / 2 + (1 - 2 * i) * sqrt(pow((a - c) / 2, 2) + b * b)')} AS variance FROM s, range(2) r(i)""")
def _(t: Tables):
    return linear.pca_fit(keyed(t), ["value", "k"], standardize=True).select("component", "variance")


@query("pca_project", f"""{PCA_SQL}, v AS (SELECT *, (a + c) / 2 + sqrt(pow((a - c) / 2, 2) + b * b) AS l FROM m),
    u AS (SELECT *, b / sqrt(b * b + (l - a) * (l - a)) AS ux, (l - a) / sqrt(b * b + (l - a) * (l - a)) AS uy FROM v),
    w AS (SELECT *, CASE WHEN abs(ux) >= abs(uy) THEN sign(ux) ELSE sign(uy) END AS s1,
        CASE WHEN abs(uy) >= abs(ux) THEN sign(-uy) ELSE sign(ux) END AS s2 FROM u)
    SELECT event_id, {R('s1 * ((value - mx) * ux + (k - my) * uy)', 5)} AS pc1,
    {R('s2 * ((value - mx) * -uy + (k - my) * ux)', 5)} AS pc2 FROM p, w""", digits=5)
def _(t: Tables):
    params = linear.pca_fit(keyed(t), ["value", "k"], k=2)
    return linear.pca_project(keyed(t), params, ["value", "k"]).select("event_id", "pc1", "pc2")


@query("pca_total_variance", f"""SELECT {R('sum(v)')} AS total, count(*)::BIGINT AS components FROM (SELECT i, var_samp(x) AS v FROM (
    SELECT unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS i FROM embeddings) GROUP BY i)""")
def _(t: Tables):
    """The variances of all components add up to the variance of the data."""
    return linear.pca_fit(t.embeddings, "embedding", width=64).agg(
        F.sum("variance").alias("total"), F.count(F.lit(1)).alias("components"))


@query("pca_variance_wide")
def _(t: Tables):
    return linear.pca_fit(t.embeddings, "embedding", width=64, standardize=True).select("component", "variance")


@query("window_reconstruction_error", f"""WITH p AS ({KEYED_SQL}), n AS (SELECT p.*, event_type FROM p JOIN events USING (event_id)),
    m AS (SELECT avg(value) AS mx, avg(k) AS my, var_samp(value) AS a, covar_samp(value, k) AS b, var_samp(k) AS c FROM n WHERE event_type <> 'error'),
    v AS (SELECT *, (a + c) / 2 + sqrt(pow((a - c) / 2, 2) + b * b) AS l FROM m),
    u AS (SELECT *, b / sqrt(b * b + (l - a) * (l - a)) AS ux, (l - a) / sqrt(b * b + (l - a) * (l - a)) AS uy FROM v)
    SELECT event_id, {R('pow((value - mx) * -uy + (k - my) * ux, 2) / 2', 4)} AS score FROM p, u""", digits=4)
def _(t: Tables):
    rows = keyed(t)
    params = linear.pca_fit(rows.filter("event_type <> 'error'"), ["value", "k"], k=1)
    return linear.reconstruction_error(rows, params, ["value", "k"]).select("event_id", "score")


@query("sequence_reconstruction_error", f"""WITH RECURSIVE {components_sql('SELECT embedding::DOUBLE[] AS x FROM embeddings WHERE label = 0',
    'SELECT vec_id, label, embedding::DOUBLE[] AS x FROM embeddings', ['vec_id', 'label'], 8)},
    s AS (SELECT vec_id, label, list_sum(list_transform(z, lambda v: abs(v))) AS score FROM left_),
    h AS (SELECT quantile_cont(score, 0.98) AS threshold FROM s WHERE label = 0)
    SELECT vec_id, label, {R('score')} AS score, (score > threshold)::INT AS is_outlier FROM s, h""")
def _(t: Tables):
    """64-step sequences: fit on label 0 as the normal class, L1 error, threshold from its own quantile."""
    params = linear.pca_fit(t.embeddings.filter("label = 0"), "embedding", k=8, width=64)
    scored = written(linear.reconstruction_error(t.embeddings, params, "embedding", loss="l1").select("vec_id", "label", "score"))
    limit = thresholds.fit_contamination(scored.filter("label = 0"), "score", 0.02)
    return thresholds.flag_above(scored, limit)


CHUNKS_SQL = """SELECT event_type, chunk, list(value ORDER BY p) AS x FROM (SELECT event_type, value, p, p // 64 AS chunk FROM (
    SELECT event_type, value, row_number() OVER (PARTITION BY event_type ORDER BY ts) - 1 AS p FROM events)) GROUP BY 1, 2 HAVING count(*) = 64"""


@query("chunk_reconstruction_error", f"""WITH RECURSIVE ch AS MATERIALIZED ({CHUNKS_SQL}), {components_sql('SELECT x FROM ch', 'SELECT * FROM ch', ['event_type', 'chunk'], 3)}
    SELECT event_type, chunk::BIGINT AS chunk, {R('list_inner_product(z, z) / 64', 4)} AS score FROM left_""", digits=4)
def _(t: Tables):
    """Chunks of 64 values per kind of event, squared error after 3 components."""
    chunks = written(sequence.tumbling_chunks(t.events, "value", 64, "ts", "event_type"))
    params = linear.pca_fit(chunks, "values", k=3, width=64)
    return linear.reconstruction_error(chunks, params, "values").select("event_type", "chunk", "score")


AR1_SQL = f"""WITH l AS (SELECT hour, n, lag(n) OVER (ORDER BY hour) AS x FROM ({HOURLY_SQL})),
    r AS (SELECT regr_slope(n, x) AS b, regr_intercept(n, x) AS a FROM l)"""


@query("ar_forecast", f"""{AR1_SQL} SELECT strftime(hour, '%Y-%m-%d %H') AS hour, {R('a + b * x')} AS predicted, {R('n - a - b * x')} AS residual FROM l, r""")
def _(t: Tables):
    series = hourly(t)
    params = forecast.fit_ar(series, "n", 1, "hour", hot_rows=None)
    out = forecast.ar_forecast(series, params, "n", 1, "hour", hot_rows=None)
    return out.select(F.date_format("hour", "yyyy-MM-dd HH").alias("hour"), "predicted", "residual")


@query("ar_forecast_by_series", f"""WITH l AS (SELECT event_id, user_id, value, lag(value) OVER ({W}) AS x FROM events),
    r AS (SELECT user_id, regr_slope(value, x) AS b, regr_intercept(value, x) AS a FROM l GROUP BY 1)
    SELECT event_id, {R('a + b * x')} AS predicted, {R('value - a - b * x')} AS residual FROM l JOIN r USING (user_id)""")
def _(t: Tables):
    params = forecast.fit_ar(t.events, "value", 1, "ts", "user_id")
    return forecast.ar_forecast(t.events, params, "value", 1, "ts", "user_id").select("event_id", "predicted", "residual")


TEN_LAGS = "SELECT event_id, value AS actual, value AS y, " + ", ".join(
    f"lag(value, {k}) OVER (ORDER BY ts) AS x{k}" for k in range(1, 11)) + " FROM events"


@query("ar_forecast_ten_lags", f"""WITH {least_squares_sql('l', f'SELECT * FROM ({TEN_LAGS}) WHERE x10 IS NOT NULL',
    ['event_id', 'actual'], [f'x{k}' for k in range(1, 11)], 'y')}
    SELECT e.event_id, {R('actual - rest')} AS predicted, {R('rest')} AS residual FROM events e LEFT JOIN l ON l.event_id = e.event_id""")
def _(t: Tables):
    params = forecast.fit_ar(t.events, "value", 10, "ts")
    return forecast.ar_forecast(t.events, params, "value", 10, "ts").select("event_id", "predicted", "residual")


ORDERS = [(p, q) for p in range(3) for q in range(3)]


def nine_sql() -> str:
    """CTEs ending in `aics`: all nine candidates on the differenced hourly counts, c<p><q> being what a fit leaves."""
    fits = ", ".join(least_squares_sql(f"c{p}{q}", "SELECT * FROM u", ["hour", "base", "y0"],
                                       [*[f"x{i}" for i in range(1, p + 1)], *[f"x{12 * i}" for i in range(1, q + 1)]], "y") for p, q in ORDERS)
    scores = " UNION ALL ".join(f"SELECT {p} AS p, {q} AS sp, sum(rest * rest) AS rss, count(*) AS n, count(*) * ln(sum(rest * rest) / count(*)) + {2 * (p + q + 1)} AS aic FROM c{p}{q}"
                                for p, q in ORDERS)
    return f"""WITH h AS ({HOURLY_SQL}), d AS (SELECT hour, n, n - lag(n) OVER (ORDER BY hour) AS d FROM h),
        s AS (SELECT hour, n, d - lag(d, 12) OVER (ORDER BY hour) AS y FROM d),
        l AS (SELECT hour, n - y AS base, y, y AS y0, {', '.join(f'lag(y, {k}) OVER (ORDER BY hour) AS x{k}' for k in (1, 2, 12, 24))} FROM s),
        u AS (SELECT * FROM l WHERE x24 IS NOT NULL), {fits}, aics AS MATERIALIZED ({scores})"""


def seasonal_sql() -> str:
    """The forecasts of the best of the nine candidates."""
    rows = " UNION ALL ".join(f"SELECT {p} AS p, {q} AS sp, hour, base + y0 - rest AS predict FROM c{p}{q}" for p, q in ORDERS)
    return f"""{nine_sql()}, best AS (SELECT p, sp FROM aics ORDER BY aic, p, sp LIMIT 1), f AS (SELECT hour, predict FROM ({rows}) JOIN best USING (p, sp))
        SELECT strftime(h.hour, '%Y-%m-%d %H') AS hour, n, {R('coalesce(predict, 0)', 5)} AS predict FROM h LEFT JOIN f ON f.hour = h.hour"""


@query("seasonal_ar_table", f"{nine_sql()} SELECT p::INT AS ar_order, sp::INT AS seasonal_order, {R('rss', 3)} AS rss, n::BIGINT AS n, {R('aic', 3)} AS aic FROM aics", digits=3)
def _(t: Tables):
    return forecast.seasonal_ar_table(hourly(t), "n", "hour", hot_rows=None).select("ar_order", "seasonal_order", "rss", "n", "aic")


@query("seasonal_ar_select", f"{nine_sql()} SELECT p::INT AS ar_order, sp::INT AS seasonal_order, {R('aic', 3)} AS aic FROM aics ORDER BY aic, p, sp LIMIT 1", digits=3)
def _(t: Tables):
    best = forecast.seasonal_ar_select(forecast.seasonal_ar_table(hourly(t), "n", "hour", hot_rows=None))
    return best.select("ar_order", "seasonal_order", "aic")


@query("seasonal_ar_predict")
def _(t: Tables):
    """Nine candidates per event type, the best one predicts its series."""
    series = t.events.groupBy("event_type", F.date_trunc("hour", "ts").alias("hour")).agg(F.count(F.lit(1)).cast("double").alias("n"))
    table = forecast.seasonal_ar_table(series, "n", "hour", "event_type", hot_rows=None)
    best = forecast.seasonal_ar_select(table, "event_type")
    out = forecast.seasonal_ar_predict(series, best, "n", "hour", "event_type", hot_rows=None)
    return out.select("event_type", F.date_format("hour", "yyyy-MM-dd HH").alias("hour"), "n", "predict")


@query("seasonal_ar_predict_hourly", seasonal_sql(), digits=5)
def _(t: Tables):
    series = hourly(t)
    best = forecast.seasonal_ar_select(forecast.seasonal_ar_table(series, "n", "hour", hot_rows=None))
    out = forecast.seasonal_ar_predict(series, best, "n", "hour", hot_rows=None)
    return out.select(F.date_format("hour", "yyyy-MM-dd HH").alias("hour"), "n", "predict")


STEPS = range(1, 11)
ERRORS = [f"e{h}" for h in STEPS]
ERRORS_SQL = f"""WITH o AS (SELECT event_id, user_id, event_type, ts, {', '.join(f'value - lag(value, {h}) OVER ({W}) AS e{h}' for h in STEPS)} FROM events)"""


def horizon_errors(t: Tables):
    """Errors of the naive forecasts 1 to 10 rows ahead of every event."""
    out = sequence.lag_matrix(t.events, "value", list(STEPS), "ts", "user_id")
    return out.select("event_id", "user_id", "event_type", "ts", *[(F.col("value") - F.col(f"value_lag_{h}")).alias(f"e{h}") for h in STEPS])


@query("gaussian_residual_score", f"""{ERRORS_SQL}, {mahalanobis_sql('SELECT * FROM o', ['event_id'], ERRORS, 'event_type', "ts < TIMESTAMP '2024-01-16'")}
    SELECT event_id, {R('score', 5)} AS score FROM scored""", digits=5)
def _(t: Tables):
    errors = horizon_errors(t).dropna(subset=ERRORS)
    train = errors.filter(F.col("ts") < F.expr("TIMESTAMP_NTZ '2024-01-16'"))
    params = stats.error_mean_cov(train, ERRORS, "event_type")
    return forecast.gaussian_score(errors, params, ERRORS, "event_type", ridge=0.0).select("event_id", "score")


@query("adaptive_threshold", f"""{ERRORS_SQL}, s AS (SELECT event_id, ts, abs(e1) AS score, abs(e2) AS f FROM o WHERE e1 IS NOT NULL AND e2 IS NOT NULL),
    r AS (SELECT regr_slope(score, f) AS b, regr_intercept(score, f) AS a FROM s WHERE ts < TIMESTAMP '2024-01-16')
    SELECT event_id, {R('a + b * f')} AS predicted_score, {R('score / (a + b * f + 1)')} AS relative_score FROM s, r
    WHERE ts >= TIMESTAMP '2024-01-16'""")
def _(t: Tables):
    errors = horizon_errors(t).dropna(subset=["e1", "e2"]).withColumns({"score": F.abs("e1"), "f": F.abs("e2")})
    day = F.expr("TIMESTAMP_NTZ '2024-01-16'")
    train, test = errors.filter(F.col("ts") < day), errors.filter(F.col("ts") >= day)
    out = forecast.adaptive_threshold(train, test, "score", ["f"], "event_id", ridges=(0.0,))[1]
    return out.select("event_id", "predicted_score", "relative_score")


CV_RIDGES = (0.0, 0.001, 0.1)


@query("adaptive_threshold_cv", f"""{ERRORS_SQL}, s AS (SELECT abs(e1) AS y, abs(e2) AS x, {H("'0:' || event_id")} % 5 AS fold FROM o
        WHERE e1 IS NOT NULL AND e2 IS NOT NULL),
    m AS (SELECT f, ridge, regr_sxy(y, x) / (regr_sxx(y, x) + ridge * count(*)) AS b, avg(x) AS mx, avg(y) AS my
        FROM s, range(5) g(f), (VALUES {', '.join(f'({r}::DOUBLE)' for r in CV_RIDGES)}) v(ridge) WHERE fold <> f GROUP BY f, ridge)
    SELECT ridge, {R('sum(pow(y - my - b * (x - mx), 2)) / (SELECT count(*) FROM s)')} AS mse FROM s JOIN m ON fold = f GROUP BY ridge""")
def _(t: Tables):
    errors = horizon_errors(t).dropna(subset=["e1", "e2"]).withColumns({"score": F.abs("e1"), "f": F.abs("e2")})
    return forecast.adaptive_threshold(errors, errors, "score", ["f"], "event_id", ridges=CV_RIDGES)[0]


TEXT_SQL = f"""WITH d AS (SELECT ts::DATE AS date, sum(value) AS total FROM events GROUP BY 1),
    x AS (SELECT d.date, total, (d.date IN (SELECT date FROM ({DATED_SQL})))::INT::DOUBLE AS txt FROM d),
    l AS (SELECT date, total AS l0, lead(txt) OVER (ORDER BY date) AS nxt, lead(total) OVER (ORDER BY date) AS y FROM x),
    u AS (SELECT * FROM l WHERE y IS NOT NULL AND nxt IS NOT NULL),
    m AS (SELECT count(*) AS n, avg(y) AS my, avg(l0) AS m0, avg(nxt) AS m1, regr_syy(y, l0) AS yy, regr_sxx(y, l0) AS a, regr_sxx(y, nxt) AS c,
        regr_sxy(y, l0) AS p, regr_sxy(y, nxt) AS q, regr_sxy(l0, nxt) AS b FROM u)"""


@query("text_augmented_forecast", f"""{TEXT_SQL} SELECT 'lags' AS variant, n::BIGINT AS n, {R('p / a', 4)} AS b_lag, 0.0::DOUBLE AS b_text,
    {R('(yy - p * p / a) / n', 2)} AS mse FROM m
    UNION ALL SELECT 'lags+text', n::BIGINT, {R('(p * c - q * b) / (a * c - b * b)', 4)}, {R('(q * a - p * b) / (a * c - b * b)', 4)},
    {R('(yy - (p * p * c - 2 * p * q * b + q * q * a) / (a * c - b * b)) / n', 2)} FROM m""", digits=4)
def _(t: Tables):
    days = stats.daily_sum(t.events, "ts", "value")
    days = joins.flag_event_days(days, dated_texts(t), "date", "text").withColumn("txt", F.col("txt").cast("double"))
    rows = sequence.lead_target(days, {"nxt": "txt", "y": "total"}, "date", hot_rows=None).withColumnRenamed("total", "l0")
    fits = linear.ablation(rows, "y", {"lags": ["l0"], "lags+text": ["l0", "nxt"]}, F.lit(True))
    return fits.select("variant", "n", F.col("coef")[1].alias("b_lag"), F.col("coef")[2].alias("b_text"),
                       F.round(F.col("rss") / F.col("n"), 2).alias("mse"))


VECTOR_SQL = f"""d AS (SELECT ts::DATE AS date, sum(value) AS total FROM events GROUP BY 1),
    v AS (SELECT word FROM ({vocabulary_sql('benchmark', 'item_id')}) WHERE index < 600),
    w AS (SELECT date, avg({U("'0:0:' || word")} - 0.5) AS w0, avg({U("'0:1:' || word")} - 0.5) AS w1 FROM ({words_sql('benchmark', 'item_id')})
        JOIN v USING (word) JOIN ({DATED_SQL.replace(', text FROM', ' FROM')}) USING (item_id) GROUP BY 1),
    f AS (SELECT d.date, total AS x0, lag(total, 1) OVER o AS x1, lag(total, 2) OVER o AS x2, (isodow(d.date) - 1)::DOUBLE AS dow,
        lead(total) OVER o AS y, lead(coalesce(w0, 0)) OVER o AS n0, lead(coalesce(w1, 0)) OVER o AS n1
        FROM d LEFT JOIN w ON w.date = d.date WINDOW o AS (ORDER BY d.date)),
    u AS (SELECT * FROM f WHERE x2 IS NOT NULL AND y IS NOT NULL)"""
VARIANTS = {"L": ["x0", "x1", "x2"], "L+W": ["x0", "x1", "x2", "dow"], "L+W+E": ["x0", "x1", "x2", "dow", "n0", "n1"]}


@query("text_vector_forecast", f"WITH {VECTOR_SQL}, " + ", ".join(
    least_squares_sql(f"m{i}", "SELECT * FROM u", ["date"], xs, "y") for i, xs in enumerate(VARIANTS.values())) + " " + " UNION ALL ".join(
    f"SELECT '{name}' AS variant, count(*)::BIGINT AS n, {R('sqrt(avg(rest * rest))', 4)} AS rmse FROM m{i}" for i, name in enumerate(VARIANTS)), digits=4)
def _(t: Tables):
    """Ablation: lags; lags and weekday; and the pooled word vectors of the next day's events."""
    days = stats.daily_sum(t.events, "ts", "value")
    days = joins.attach_event_text(days, dated_texts(t), "date", "text", "item_id").withColumn("dow", F.weekday("date").cast("double"))
    vectors = hash_vectors(build_vocabulary(t.benchmark, "text", 600), 2)
    days = pooled_text_vector(days, "txt_desc", vectors, "date", 2)
    days = days.withColumns({f"w{i}": F.coalesce(F.col("vec")[i], F.lit(0.0)) for i in range(2)})
    lagged = sequence.lag_matrix(days, "total", [0, 1, 2], "date", prefix="x", hot_rows=None)
    lagged = lagged.withColumnsRenamed({f"x_{k}": f"x{k}" for k in range(3)})
    rows = sequence.lead_target(lagged, {"y": "total", "n0": "w0", "n1": "w1"}, "date", hot_rows=None)
    fits = linear.ablation(rows, "y", VARIANTS, F.lit(True))
    return fits.select("variant", "n", F.sqrt(F.col("rss") / F.col("n")).alias("rmse"))
