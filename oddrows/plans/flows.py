"""Queries: whole analyses from raw rows to flags and metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oddrows.functions.lineage import written
from oddrows.operators import cleaning, clustering, evaluation, forecast, forest, joins, linear, scaling, sequence, stats, thresholds
from oddrows.plans.registry import components_sql, least_squares_sql, mahalanobis_sql, query, R, Tables, U
from oddrows.plans.scores import best_sweep, best_sweep_sql
from oddrows.plans.series import W
from oddrows.plans.tables import DATED_SQL, dated_texts

# ---------------------------------------------------------------- wide sensor table

SENSORS = ("click", "error", "purchase", "signup", "view")
WIDE_SQL = f"""SELECT date_trunc('hour', ts)::TIMESTAMP AS hour, {', '.join(
    f"avg(value) FILTER (event_type = '{s}') AS {s}" for s in SENSORS)} FROM events GROUP BY 1"""


def sensor_table(t: Tables) -> DataFrame:
    """One row per hour, one column per sensor (event type); hours without a reading are null."""
    kinds = t.events.select(F.date_trunc("hour", "ts").alias("hour"), "event_type", "value")
    return kinds.groupBy("hour").pivot("event_type", list(SENSORS)).agg(F.avg("value"))


def sensor_flow(wide: DataFrame, columns: list[str], key: str, share: float = 0.13) -> DataFrame:
    """Clean a sensor table, project it on two components and flag rows by three detectors:
    fences on each component, distance to two centres, isolation forest."""
    tidy = cleaning.impute_mean(cleaning.drop_missing_rows(wide.dropDuplicates(), after_top=7), columns)
    scores = written(linear.pca_project(tidy, linear.pca_fit(tidy, columns, k=2), columns).select(key, "pc1", "pc2"))
    axes = ["pc1", "pc2"]
    fenced = thresholds.score_iqr_fence(scores, thresholds.fit_iqr_fence(scores, axes), axes)
    fenced = fenced.drop("score").withColumnRenamed("is_outlier", "by_fence")
    near = clustering.kmeans_distance_outliers(fenced, clustering.lloyd(scores, axes, 2), share)
    near = near.drop("score", "cluster").withColumnRenamed("is_outlier", "by_centre")
    trees = forest.fit_isolation_forest(scores, axes, key)
    wooded = written(forest.score_isolation_forest(near, trees, axes))
    limit = thresholds.fit_contamination(wooded, "score", share)
    return thresholds.flag_above(wooded, limit, "score", "by_forest").drop("score")


@query("sensor_flow")
def _(t: Tables):
    out = sensor_flow(sensor_table(t), list(SENSORS), "hour")
    return out.withColumn("hour", F.date_format("hour", "yyyy-MM-dd HH"))


@query("sensor_missing_profile", f"""WITH w AS ({WIDE_SQL}), s AS ({' UNION ALL '.join(
    f"SELECT '{s}' AS \"column\", avg(({s} IS NULL)::INT) AS percent FROM w" for s in SENSORS)})
    SELECT "column", {R('percent')} AS percent FROM s WHERE percent > 0""")
def _(t: Tables):
    return cleaning.missing_profile(sensor_table(t))


@query("sensor_daily", f"""WITH w AS ({WIDE_SQL}) SELECT strftime(hour, '%Y-%m-%d') AS bucket, {', '.join(
    f"{R(f'avg({s})', 9)} AS {s}_mean, {R(f'stddev_samp({s})', 9)} AS {s}_std" for s in SENSORS)} FROM w GROUP BY 1""", digits=9)
def _(t: Tables):
    out = stats.calendar_resample(sensor_table(t), "hour", list(SENSORS))
    return out.withColumn("bucket", F.date_format("bucket", "yyyy-MM-dd"))


# ---------------------------------------------------------------- labelled channels

HORIZONS = 10
ERRORS = [f"e{h}" for h in range(1, HORIZONS + 1)]
LABELS = "(value > 60)::INT AS label"


def channel_errors(rows: DataFrame, series: str, order_by: str, value: str, steps: int = HORIZONS) -> DataFrame:
    """Errors of naive forecasts 1..steps rows ahead."""
    lagged = sequence.lag_matrix(rows, value, list(range(1, steps + 1)), order_by, series)
    return lagged.withColumns({f"e{h}": F.col(value) - F.col(f"{value}_lag_{h}") for h in range(1, steps + 1)})


def errors_sql(value: str, source: str, keep: str) -> str:
    return f"SELECT {keep}, {', '.join(f'{value} - lag({value}, {h}) OVER ({W}) AS e{h}' for h in range(1, HORIZONS + 1))} FROM {source}"


@query("channel_flow", f"""WITH l AS (SELECT *, {LABELS}, CASE WHEN ts < TIMESTAMP '2024-01-16' THEN 'train' ELSE 'test' END AS split FROM events),
    c AS (SELECT event_type, avg(value) AS m, stddev_samp(value) AS s FROM l WHERE split = 'train' GROUP BY 1),
    z AS (SELECT l.*, (value - m) / s AS z FROM l JOIN c USING (event_type)), e AS ({errors_sql('z', 'z', 'event_type, label, split')}),
    {mahalanobis_sql('SELECT * FROM e', ['label', 'split'], ERRORS, 'event_type', "split = 'train'")}
    SELECT event_type, count(*) FILTER (score > 20 AND label = 1)::BIGINT AS tp, count(*) FILTER (score > 20 AND label <> 1)::BIGINT AS fp,
    count(*) FILTER (score <= 20 AND label = 1)::BIGINT AS fn, count(*) FILTER (score <= 20 AND label <> 1)::BIGINT AS tn FROM scored WHERE split = 'test' GROUP BY 1""")
def _(t: Tables):
    """Label, split, standardise on train, errors 1 to 10 rows ahead, Gaussian score, confusion per channel."""
    split = F.when(F.col("ts") < F.expr("TIMESTAMP_NTZ '2024-01-16'"), "train").otherwise("test")
    rows = t.events.select("event_id", "user_id", "event_type", "ts", "value", split.alias("split"),
                           (F.col("value") > 60).cast("int").alias("label"))
    scaled = scaling.zscore_apply(rows, scaling.zscore_fit(rows.filter("split = 'train'"), "value", "event_type", ddof=1),
                                  "value", "event_type")
    errors = written(channel_errors(scaled, "user_id", "ts", "value").dropna(subset=ERRORS))
    params = stats.error_mean_cov(errors.filter("split = 'train'"), ERRORS, "event_type")
    scored = forecast.gaussian_score(errors.filter("split = 'test'"), params, ERRORS, "event_type", ridge=0.0)
    return evaluation.confusion_matrix(thresholds.flag_above(scored, 20.0), "is_outlier", "label", "event_type")


@query("channel_fbeta_best", f"""WITH e AS ({errors_sql('value', 'events', f'{LABELS}, 1 AS one')}), {mahalanobis_sql('SELECT * FROM e', ['label'], ERRORS, 'one')},
    {best_sweep_sql("SELECT label, score FROM scored")}""")
def _(t: Tables):
    """Best F-beta over 1,000 log-spaced thresholds of the Gaussian score of one-channel errors."""
    rows = t.events.select("event_id", "user_id", "ts", "value", (F.col("value") > 60).cast("int").alias("label"))
    errors = written(channel_errors(rows, "user_id", "ts", "value").dropna(subset=ERRORS))
    scored = forecast.gaussian_score(errors, stats.error_mean_cov(errors, ERRORS), ERRORS, ridge=0.0)
    return best_sweep(written(scored.select("score", "label")))


# ---------------------------------------------------------------- reconstruction error of labelled vectors


@query("reconstruction_flow", f"""WITH RECURSIVE e AS MATERIALIZED (SELECT vec_id, (label = 9)::INT AS abnormal, embedding::DOUBLE[] AS x,
        {U("'42:' || vec_id")} < 0.8 AS train FROM embeddings),
    {components_sql('SELECT x FROM e WHERE train AND abnormal = 0', 'SELECT * FROM e WHERE NOT train', ['vec_id', 'abnormal'], 8)},
    q AS (SELECT list_inner_product(z, z) / 64 AS score, abnormal FROM left_),
    s AS (SELECT score, count(*) FILTER (abnormal = 1) AS pos, count(*) FILTER (abnormal <> 1) AS neg FROM q GROUP BY 1),
    c AS (SELECT *, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp, sum(pos) OVER () AS p, sum(neg) OVER () AS n FROM s WINDOW w AS (ORDER BY score DESC)),
    g AS (SELECT tp / p AS y, fp / n AS x, lag(tp / p, 1, 0) OVER (ORDER BY score DESC) AS y0, lag(fp / n, 1, 0) OVER (ORDER BY score DESC) AS x0 FROM c)
    SELECT {R('sum((x - x0) * (y + y0) / 2)')} AS auc, (SELECT count(*) FROM q)::BIGINT AS rows FROM g""")
def _(t: Tables):
    """Hash split, components of the normal training rows, error of the test rows, area under the curve."""
    rows = t.embeddings.withColumn("abnormal", (F.col("label") == 9).cast("int"))
    rows = sequence.random_split(rows, "vec_id", {"train": 0.8, "test": 0.2}, seed=42)
    params = linear.pca_fit(rows.filter("split = 'train' AND abnormal = 0"), "embedding", k=8, width=64)
    test = written(linear.reconstruction_error(rows.filter("split = 'test'"), params, "embedding").select("vec_id", "abnormal", "score"))
    return evaluation.roc_auc(test, "score", "abnormal").withColumn("rows", test.agg(F.count(F.lit(1))).scalar())


FLOW_SQL = f"""WITH d AS (SELECT ts::DATE AS date, sum(value) AS total FROM events GROUP BY 1),
    k AS (SELECT date, total, (date IN (SELECT date FROM ({DATED_SQL})))::INT::DOUBLE AS txt, avg(total) OVER (PARTITION BY isodow(date)) AS trend,
        stddev_samp(total) OVER () AS std FROM d),
    z AS (SELECT *, (total - trend) / std AS z FROM k),
    f AS (SELECT date, trend, std, z AS x0, lag(z, 1) OVER o AS x1, lag(z, 2) OVER o AS x2, lead(z) OVER o AS y, lead(txt) OVER o AS e,
        row_number() OVER o - 1 AS p, count(*) OVER () AS n FROM z WINDOW o AS (ORDER BY date)),
    c AS (SELECT * EXCLUDE (p, n), row_number() OVER (ORDER BY date) - 1 AS q, count(*) OVER () AS m FROM f WHERE p >= 3 AND p < n - 1),
    u AS (SELECT *, y AS truth, CASE WHEN q < floor(m * 0.4::DOUBLE) THEN 'train' WHEN q < floor(m * 0.6::DOUBLE) THEN 'valid' ELSE 'test' END AS split
        FROM c WHERE q < m - 1)"""
FLOW_VARIANTS = {"L": ["x0", "x1", "x2"], "L+E": ["x0", "x1", "x2", "e"]}


def flow_errors_sql(table: str, variant: str) -> str:
    return f"""SELECT '{variant}' AS variant, {R('avg(abs(e))', 4)} AS mae, {R('sum(abs(e)) / sum(abs(t - m))', 4)} AS rae, {R('sqrt(avg(e * e))', 4)} AS rmse,
        {R('sqrt(sum(e * e) / sum(pow(t - m, 2)))', 4)} AS rrse, {R('avg(abs(e / t)) * 100', 4)} AS mape FROM (SELECT rest * std AS e, truth * std + trend AS t,
        avg(truth * std + trend) OVER () AS m FROM {table} WHERE split = 'test')"""


@query("event_text_flow", FLOW_SQL + ", " + ", ".join(
    least_squares_sql(f"l{i}", "SELECT * FROM u", ["split", "truth", "std", "trend"], xs, "y", "split = 'train'")
    for i, xs in enumerate(FLOW_VARIANTS.values())) + " " + " UNION ALL ".join(
    flow_errors_sql(f"l{i}", v) for i, v in enumerate(FLOW_VARIANTS)), digits=4)
def _(t: Tables):
    """Daily totals with event text: detrend, lags, next-day target, 40/20/40 split, fit with and
    without the text flag of the next day, errors on the test days in original units."""
    days = stats.daily_sum(t.events, "ts", "value")
    days = joins.flag_event_days(days, dated_texts(t), "date", "text")
    days = scaling.seasonal_detrend(days, "date", "total", F.lit(True)).withColumn("txt", F.col("txt").cast("double"))
    lags = [0, 1, 2]
    rows = sequence.lag_matrix(days, "detrended", lags, "date", hot_rows=None)
    rows = sequence.lead_target(rows, {"y": "detrended", "next_txt": "txt"}, "date", hot_rows=None)
    rows = sequence.trim_ends(rows, len(lags), 1, "date", hot_rows=None)
    rows = written(sequence.chronological_split(rows, "date", hot_rows=None))
    feats = [f"detrended_lag_{k}" for k in lags]
    variants = {"L": feats, "L+E": [*feats, "next_txt"]}
    fits = linear.ablation(rows, "y", variants, F.col("split") == "train")
    out = None
    for name, used in variants.items():
        model = fits.filter(F.col("variant") == name).select("coef")
        both = [*feats, "next_txt"]
        test = linear.apply_linear(rows.filter("split = 'test'"), model, both)
        test = test.withColumns({"truth": F.col("y") * F.col("std") + F.col("trend"),
                                 "forecast": F.col("predicted") * F.col("std") + F.col("trend")})
        part = evaluation.regression_errors(test, "truth", "forecast").withColumn("variant", F.lit(name))
        out = part if out is None else out.unionByName(part)
    return out.select("variant", "mae", "rae", "rmse", "rrse", "mape")
