"""Queries: evaluation, text features and round trips through files."""

from __future__ import annotations

from pyspark.sql import functions as F

from oddrows.operators import evaluation, forecast, sequence, stats, text, thresholds
from oddrows.functions.columns import rounded
from oddrows.plans.registry import digest, DIM, query, R, Tables, U, word_vector_sql
from oddrows.plans.series import TREND_SQL, daily, early
from oddrows.plans.tables import RANGES_SQL, SPLITS_SQL, histogram_sql, keyed, label_ranges, split_ranges, vocabulary_sql, words_sql
from oddrows.operators import joins
from oddrows.sources import readers, writers

# ---------------------------------------------------------------- evaluation

SCORES_SQL = "SELECT d.doc_id, n_chars / 100.0::DOUBLE AS score, toxic AS label, quality FROM documents d JOIN labels l ON d.doc_id = l.doc_id"


def scores(t: Tables):
    """Detector score (text length) and true label of every labelled document."""
    both = t.documents.select("doc_id", (F.col("n_chars") / 100.0).alias("score")).join(t.labels, "doc_id")
    return both.withColumnRenamed("toxic", "label")


CONFUSION = """count(*) FILTER (score > 5 AND label = 1)::BIGINT AS tp, count(*) FILTER (score > 5 AND label <> 1)::BIGINT AS fp,
    count(*) FILTER (score <= 5 AND label = 1)::BIGINT AS fn, count(*) FILTER (score <= 5 AND label <> 1)::BIGINT AS tn"""


@query("confusion_matrix", f"SELECT quality, {CONFUSION} FROM ({SCORES_SQL}) GROUP BY 1")
def _(t: Tables):
    return evaluation.confusion_matrix(thresholds.flag_above(scores(t), 5.0), "is_outlier", "label", "quality")


@query("precision_recall_f1", f"""SELECT *, {R('(tp + tn) / (tp + fp + fn + tn)')} AS accuracy, {R('tp / nullif(tp + fp, 0)')} AS precision,
    {R('tp / nullif(tp + fn, 0)')} AS recall, {R('2 * tp / nullif(2 * tp + fp + fn, 0)')} AS f1 FROM (SELECT {CONFUSION} FROM ({SCORES_SQL}))""")
def _(t: Tables):
    return evaluation.precision_recall_f1(thresholds.flag_above(scores(t), 5.0), "is_outlier", "label")


CURVE_SQL = f"""WITH s AS (SELECT score AS threshold, count(*) FILTER (label = 1) AS pos, count(*) FILTER (label <> 1) AS neg FROM ({SCORES_SQL}) GROUP BY 1),
    c AS (SELECT *, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp, sum(pos) OVER () AS p, sum(neg) OVER () AS n FROM s
        WINDOW w AS (ORDER BY threshold DESC))"""


@query("roc_curve", f"{CURVE_SQL} SELECT {R('threshold')} AS threshold, {R('fp / n')} AS fpr, {R('tp / p')} AS tpr FROM c")
def _(t: Tables):
    return evaluation.roc_curve(scores(t), "score", "label")


@query("roc_auc", f"""{CURVE_SQL}, g AS (SELECT tp / p AS y, fp / n AS x, lag(tp / p, 1, 0) OVER (ORDER BY threshold DESC) AS y0,
    lag(fp / n, 1, 0) OVER (ORDER BY threshold DESC) AS x0 FROM c) SELECT {R('sum((x - x0) * (y + y0) / 2)')} AS auc FROM g""")
def _(t: Tables):
    return evaluation.roc_auc(scores(t), "score", "label")


@query("pr_curve", f"{CURVE_SQL} SELECT {R('threshold')} AS threshold, {R('tp / (tp + fp)')} AS precision, {R('tp / p')} AS recall FROM c")
def _(t: Tables):
    return evaluation.pr_curve(scores(t), "score", "label")


@query("metric_by_threshold", f"""{CURVE_SQL} SELECT {R('threshold')} AS threshold, 'precision' AS metric, {R('tp / (tp + fp)')} AS value FROM c
    UNION ALL SELECT {R('threshold')}, 'recall', {R('tp / p')} FROM c""")
def _(t: Tables):
    return evaluation.metric_by_threshold(scores(t), "score", "label")


@query("fbeta_sweep", f"""WITH s AS ({SCORES_SQL}), g AS (SELECT j, 1 + ((SELECT max(score) FROM s) - 1) * (j::DOUBLE / 999::DOUBLE) AS threshold FROM range(1000) r(j)),
    c AS (SELECT j, threshold, count(*) FILTER (score > threshold AND label = 1) AS tp, count(*) FILTER (score > threshold AND label <> 1) AS fp,
        count(*) FILTER (label = 1) AS p FROM g, s GROUP BY 1, 2)
    SELECT j::INT AS step, {R('threshold')} AS threshold, {R('tp / nullif(tp + fp, 0)')} AS precision, {R('tp / p')} AS recall,
    {R('1.25 * tp / nullif(0.25 * p + tp + fp, 0)')} AS fbeta FROM c""")
def _(t: Tables):
    return evaluation.fbeta_sweep(scores(t), "score", "label", 1000, beta=0.5)


@query("fbeta_sweep_low_scores", f"""WITH s AS (SELECT label, score / 1000.0::DOUBLE AS score FROM ({SCORES_SQL})), t AS (SELECT max(score) AS hi FROM s),
    g AS (SELECT j, CASE WHEN j = 99 THEN hi ELSE 1 + (hi - 1) * (j::DOUBLE / 99::DOUBLE) END AS threshold FROM range(100) r(j), t),
    c AS (SELECT j, threshold, count(*) FILTER (score > threshold AND label = 1) AS tp, count(*) FILTER (score > threshold AND label <> 1) AS fp,
        count(*) FILTER (label = 1) AS p FROM g, s GROUP BY 1, 2)
    SELECT j::INT AS step, {R('threshold')} AS threshold, {R('tp / nullif(tp + fp, 0)')} AS precision, {R('tp / p')} AS recall,
    {R('2 * tp / nullif(p + tp + fp, 0)')} AS fbeta FROM c""")
def _(t: Tables):
    low = scores(t).withColumn("score", F.col("score") / 1000.0)
    return evaluation.fbeta_sweep(low, "score", "label", 100)


@query("regression_errors_null_group", f"""WITH e AS (SELECT CASE WHEN event_id % 7 = 0 THEN NULL ELSE event_type END AS grp, value AS t, value + (event_id % 5) AS p FROM events),
    m AS (SELECT *, avg(t) OVER (PARTITION BY grp) AS m FROM e)
    SELECT grp, {R('avg(abs(p - t))')} AS mae, {R('sqrt(avg((p - t) * (p - t)))')} AS rmse,
    {R('greatest(0, 1 - sum((p - t) * (p - t)) / sum((t - m) * (t - m)))')} AS r2 FROM m GROUP BY grp""")
def _(t: Tables):
    e = t.events.select(F.when(F.col("event_id") % 7 != 0, F.col("event_type")).alias("grp"), F.col("value").alias("t"),
                        (F.col("value") + F.col("event_id") % 5).alias("p"))
    return evaluation.regression_errors(e, "t", "p", "grp").select("grp", "mae", "rmse", "r2")


def best_sweep_sql(scored: str) -> str:
    """SQL for the best F1 over 1,000 log-spaced thresholds of `scored(score, label)`."""
    return f"""s AS ({scored}), g AS (SELECT j, exp(ln((SELECT max(score) FROM s)) * (j::DOUBLE / 999::DOUBLE)) AS threshold FROM range(1000) r(j)),
        k AS (SELECT j, threshold, count(*) FILTER (score > threshold AND label = 1) AS tp, count(*) FILTER (score > threshold) AS flagged,
            count(*) FILTER (label = 1) AS p FROM g, s GROUP BY 1, 2),
        f AS (SELECT *, 2 * tp / nullif(p + flagged, 0) AS fbeta FROM k)
        SELECT {R('threshold')} AS threshold, {R('tp / nullif(flagged, 0)')} AS precision, {R('tp / p')} AS recall, {R('fbeta')} AS fbeta
        FROM f WHERE fbeta IS NOT NULL ORDER BY f.fbeta DESC, j LIMIT 1"""


def best_sweep(scored):
    """The threshold with the best F1 (the lowest one of several)."""
    swept = evaluation.fbeta_sweep(scored, "score", "label", 1000, spacing="log")
    best = stats.best_by(swept.filter("fbeta is not null"), "fbeta", lowest=False, tie="step")
    return best.select("threshold", "precision", "recall", "fbeta")


@query("fbeta_best", f"WITH {best_sweep_sql(SCORES_SQL)}")
def _(t: Tables):
    return best_sweep(scores(t))


@query("precision_at_n", f"""WITH s AS ({SCORES_SQL}), n AS (SELECT count(*) FILTER (label = 1) AS p, count(*) AS n FROM s),
    o AS (SELECT list(score ORDER BY score) AS v FROM s), k AS (SELECT (1 - p / n) * (n - 1) AS at_rank FROM n),
    q AS (SELECT v[floor(at_rank)::INT + 1] + (v[ceil(at_rank)::INT + 1] - v[floor(at_rank)::INT + 1]) * (at_rank - floor(at_rank)) AS h FROM o, k)
    SELECT (SELECT p FROM n)::BIGINT AS n, {R('count(*) FILTER (label = 1) / count(*)')} AS precision_at_n FROM s, q WHERE score > h""")
def _(t: Tables):
    out = evaluation.precision_at_n(scores(t), "score", "label")
    return out.withColumn("n", F.col("n").cast("bigint"))


ERROR_COLUMNS = f"""{R('corr(p, t)', 4)} AS corr, {R('avg(abs(p - t))', 2)} AS mae, {R('avg(pow(p - t, 2))', 0)} AS mse,
    {R('sum(abs(p - t)) / sum(abs(t - m))', 4)} AS rae, {R('sqrt(avg(pow(p - t, 2)))', 2)} AS rmse"""


def fitted_days(t: Tables):
    days = forecast.seasonal_forecast_residual(daily(t), "date", "total", early())
    return days.withColumn("year", F.year("date"))


def shown(df):
    """Errors in money need fewer digits than ratios."""
    digits = {"mae": 2, "mse": 0, "rmse": 2}
    return df.withColumns({c: rounded(c, digits.get(c, 4)) for c in df.columns if c != "year"})


@query("regression_errors", f"""{TREND_SQL}, e AS (SELECT year(date) AS year, total AS t, trend AS p, avg(total) OVER (PARTITION BY year(date)) AS m FROM r)
    SELECT year::INT AS year, {ERROR_COLUMNS}, {R('sqrt(sum(pow(p - t, 2)) / sum(pow(t - m, 2)))', 4)} AS rrse,
    {R('avg(abs((p - t) / t)) * 100', 4)} AS mape, {R('greatest(0, 1 - sum(pow(p - t, 2)) / sum(pow(t - m, 2)))', 4)} AS r2 FROM e GROUP BY year""")
def _(t: Tables):
    return shown(evaluation.regression_errors(fitted_days(t), "total", "trend", "year"))


@query("regression_errors_filtered", f"""{TREND_SQL}, e AS (SELECT total AS t, trend AS p, avg(total) OVER () AS m FROM r WHERE dow < 5)
    SELECT {ERROR_COLUMNS}, {R('greatest(0, 1 - sum(pow(p - t, 2)) / sum(pow(t - m, 2)))', 4)} AS r2 FROM e""")
def _(t: Tables):
    return shown(evaluation.regression_errors_filtered(fitted_days(t), "total", "trend", F.col("dow") < 5))


@query("error_by_class", f"""SELECT label, count(score)::BIGINT AS count, {R('avg(score)')} AS mean, {R('stddev_samp(score)')} AS std, {R('min(score)')} AS min,
    {R('max(score)')} AS max, {R('quantile_cont(score, 0.25)')} AS p25, {R('quantile_cont(score, 0.5)')} AS p50,
    {R('quantile_cont(score, 0.75)')} AS p75 FROM ({SCORES_SQL}) GROUP BY 1""")
def _(t: Tables):
    return evaluation.error_by_class(scores(t), "score", "label")


@query("error_histogram_by_class", histogram_sql(f"({SCORES_SQL})", "score", 25, "label", "WHERE score < 10"))
def _(t: Tables):
    return evaluation.error_histogram_by_class(scores(t), "score", "label", 25, upper=10.0)


@query("threshold_hit_rate", f"""WITH s AS ({SCORES_SQL}), a AS (SELECT 'normal' AS part, score <= 5 AS hit FROM s WHERE label = 0
    UNION ALL SELECT 'abnormal', score > 5 FROM (SELECT * FROM s WHERE label = 1 ORDER BY doc_id LIMIT (SELECT count(*) FROM s WHERE label = 0)))
    SELECT part, count(*) FILTER (hit)::BIGINT AS hits, count(*)::BIGINT AS rows, {R('count(*) FILTER (hit) / count(*)')} AS rate FROM a GROUP BY 1""")
def _(t: Tables):
    return evaluation.threshold_hit_rate(scores(t), "score", "label", 5.0, "doc_id")


# ---------------------------------------------------------------- text


@query("build_vocabulary", f"SELECT word, count::BIGINT AS count, index::BIGINT AS index FROM ({vocabulary_sql('documents', 'doc_id')})")
def _(t: Tables):
    return text.build_vocabulary(t.documents, "text")


SEQUENCE_SQL = f"""WITH v AS (SELECT word, index FROM ({vocabulary_sql('documents', 'doc_id')}) WHERE index < 600),
    s AS (SELECT w.doc_id, list(index ORDER BY place) AS s FROM ({words_sql('documents', 'doc_id')}) w JOIN v USING (word) GROUP BY 1),
    q AS (SELECT d.doc_id, coalesce(s, []) AS s FROM documents d LEFT JOIN s USING (doc_id))"""


def sequences(t: Tables):
    vocabulary = text.build_vocabulary(t.documents, "text", 600)
    return text.texts_to_sequences(t.documents.select("doc_id", "text"), "text", vocabulary, "doc_id")


@query("texts_to_sequences", f"{SEQUENCE_SQL} SELECT doc_id, len(s)::INT AS length, array_to_string(s, ' ') AS sequence FROM q")
def _(t: Tables):
    return sequences(t).select("doc_id", F.size("sequence").alias("length"), F.array_join("sequence", " ").alias("sequence"))


@query("pad_sequences", f"""{SEQUENCE_SQL} SELECT doc_id, 350 AS length, array_to_string(CASE WHEN len(s) >= 350 THEN s[-350:] ELSE
    list_concat(list_transform(range(350 - len(s)), lambda x: 0), s) END, ' ') AS sequence FROM q""")
def _(t: Tables):
    out = text.pad_sequences(sequences(t), "sequence", 350)
    return out.select("doc_id", F.size("sequence").alias("length"), F.array_join("sequence", " ").alias("sequence"))


@query("embed_vocabulary", f"""WITH v AS MATERIALIZED (SELECT word, index FROM ({vocabulary_sql('benchmark', 'item_id')}) WHERE index < 600),
    x AS ({word_vector_sql('SELECT word FROM v')}) SELECT 0::BIGINT AS index, {DIM}::INT AS width, 0.0::DOUBLE AS digest
    UNION ALL SELECT index::BIGINT, {DIM}::INT, {R('sum((i + 1) * x * abs(x))', 4)} FROM x JOIN v USING (word) GROUP BY index""", digits=4)
def _(t: Tables):
    vocabulary = text.build_vocabulary(t.benchmark, "text", 600)
    rows = text.embed_vocabulary(vocabulary, text.hash_vectors(vocabulary, DIM), DIM, 600)
    return rows.select("index", F.size("vec").alias("width"), digest().alias("digest"))


def pooled_sql(fold: str) -> str:
    """Digest of the pooled numbers of every turn; words of the turn that are in the vocabulary count as often as they occur."""
    return f"""WITH c AS MATERIALIZED (SELECT conv_id || ':' || turn AS k, text FROM conversations),
        v AS MATERIALIZED (SELECT word FROM ({vocabulary_sql('c', 'k')}) WHERE index < 600),
        n AS MATERIALIZED (SELECT k, word, count(*) AS n FROM ({words_sql('c', 'k')}) JOIN v USING (word) GROUP BY 1, 2),
        x AS MATERIALIZED ({word_vector_sql('SELECT word FROM v')}),
        w AS (SELECT k, i, {fold} AS y FROM n JOIN x USING (word) GROUP BY k, i)
        SELECT c.k, {R('sum((i + 1) * y * abs(y))', 4)} AS digest FROM c LEFT JOIN w ON w.k = c.k GROUP BY 1"""


def pooled(t: Tables, how: str):
    turns = t.conversations.select(F.concat_ws(":", "conv_id", "turn").alias("k"), "text")
    vectors = text.hash_vectors(text.build_vocabulary(turns, "text", 600), DIM)
    return text.pooled_text_vector(turns, "text", vectors, "k", DIM, how).select("k", digest().alias("digest"))


@query("pooled_text_vector", pooled_sql("sum(n * x) / sum(n)"), digits=4)
def _(t: Tables):
    return pooled(t, "mean")


@query("pooled_text_vector_max", pooled_sql("max(x)"), digits=4)
def _(t: Tables):
    return pooled(t, "max")


@query("split_strip_cast", f"""SELECT event_id, 2 AS width, {R("json_extract(props, '$.k')::DOUBLE")} AS first, {R('value')} AS second FROM events""")
def _(t: Tables):
    line = F.concat(F.lit("  "), F.concat_ws("  ", "event_id", "k", "value"), F.lit(" "))
    out = keyed(t).select("event_id", text.split_strip_cast(line, r"\s+", 1).alias("v"))
    return out.select("event_id", F.size("v").alias("width"), F.col("v")[0].alias("first"), F.col("v")[1].alias("second"))


# ---------------------------------------------------------------- sources and sinks


@query("read_csv_table", f"SELECT o_orderkey, {R('o_totalprice', 2)} AS o_totalprice, o_orderpriority FROM orders", digits=2)
def _(t: Tables):
    path = t.scratch()
    t.orders.select("o_orderkey", "o_totalprice", "o_orderpriority").write.option("header", True).csv(path)
    return readers.read_csv_table(t.spark, path, "o_orderkey bigint, o_totalprice double, o_orderpriority string")


@query("read_tsv_events", "SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M') AS start_time, strftime(ts, '%Y-%m-%d') AS date, event_type AS title FROM events")
def _(t: Tables):
    path = t.scratch()
    t.events.select("event_id", F.date_format("ts", "yyyy-MM-dd HH:mm").alias("start_time"), F.col("event_type").alias("title")).write.option(
        "header", True).option("sep", "\t").csv(path)
    out = readers.read_tsv_events(t.spark, path, "event_id bigint, start_time string, title string")
    return out.withColumn("start_time", F.date_format("start_time", "yyyy-MM-dd HH:mm"))


@query("read_sheet_export", "SELECT c_custkey, c_acctbal FROM customer", digits=2)
def _(t: Tables):
    path = t.scratch() + ".parquet"
    t.customer.select("c_custkey", "c_acctbal").write.parquet(path)
    return readers.read_sheet_export(t.spark, path, "c_custkey bigint, c_acctbal double")


@query("read_arff", f"""SELECT {R('embedding[1]::VARCHAR', 12)} AS step1, {R('embedding[64]::VARCHAR', 12)} AS step64,
    {R('list_sum(list_transform(range(1, 65), lambda i: i * embedding[i]::VARCHAR::DOUBLE))', 8)} AS all_steps, label::VARCHAR AS target FROM embeddings""", digits=12)
def _(t: Tables):
    from oddrows.operators.cleaning import rename_last_column
    path, width = t.scratch(), 64
    head = ["% sequences", "@relation sequences", "", *[f"@attribute step{i} numeric" for i in range(1, width + 1)],
            "@attribute class {0,1,2,3,4,5,6,7,8,9}", "", "@data"]
    t.spark.createDataFrame([("\n".join(head),)], "value string").coalesce(1).write.text(path)
    t.embeddings.select(F.concat_ws(",", *[F.col("embedding")[i].cast("string") for i in range(width)], "label").alias("value")).write.mode(
        "append").text(path)
    out = rename_last_column(readers.read_arff(t.spark, path))
    total = sum((F.col(f"step{i}") * i for i in range(1, width + 1)), F.lit(0.0))
    return out.select("step1", "step64", rounded(total, 8).alias("all_steps"), "target")


@query("read_label_map", "SELECT event_type AS series, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, count(*)::BIGINT AS n FROM events GROUP BY 1, 2")
def _(t: Tables):
    stamp = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    path = t.scratch()
    per_day = t.events.groupBy("event_type", F.to_date("ts")).agg(F.collect_list(stamp).alias("stamps"))
    per_day.select(F.to_json(F.create_map("event_type", "stamps")).alias("value")).repartition(4).write.option("lineSep", "\n").text(path)
    out = readers.read_label_map(t.spark, path, "yyyy-MM-dd HH:mm:ss", by_line=True).withColumn("ts", F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
    return out.groupBy("series", "ts").agg(F.count(F.lit(1)).alias("n"))


@query("read_numeric_lines", f"SELECT count(*)::BIGINT AS lines, {R('sum(value)', 2)} AS total, 0::BIGINT AS misplaced FROM events", digits=2)
def _(t: Tables):
    """Files of consecutive ids: inside a file, id minus line number must be constant."""
    path = t.scratch()
    t.events.orderBy("event_id").select(F.concat_ws(" ", "event_id", "value").alias("value")).write.text(path)
    lines = readers.read_numeric_lines(t.spark, path)
    shift = F.col("channels")[0] - F.col("line")
    files = lines.groupBy("file").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("channels")[1]).alias("v"),
                                      (F.max(shift) - F.min(shift)).alias("spread"))
    return files.agg(F.sum("n").alias("lines"), F.sum("v").alias("total"), F.count_if(F.col("spread") != 0).alias("misplaced"))


@query("read_headerless_csv", "SELECT event_id, value FROM events", digits=2)
def _(t: Tables):
    path = t.scratch()
    t.events.select(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), "event_id", "value").write.csv(path)
    return readers.read_headerless_csv(t.spark, path, "ts string, event_id bigint, value double")


@query("read_word_vectors", f"""WITH x AS ({word_vector_sql('SELECT word FROM (' + vocabulary_sql('benchmark', 'item_id') + ')')})
    SELECT word, {DIM}::INT AS width, {R('sum((i + 1) * x::FLOAT::DOUBLE * abs(x::FLOAT::DOUBLE))', 3)} AS digest FROM x GROUP BY word""", digits=3)
def _(t: Tables):
    path = t.scratch()
    vectors = text.hash_vectors(text.build_vocabulary(t.benchmark, "text"), DIM)
    numbers = F.array_join(F.transform("vec", lambda x: x.cast("float").cast("string")), " ")
    vectors.select(F.concat_ws(" ", "word", numbers).alias("value")).write.text(path)
    return readers.read_word_vectors(t.spark, path).select("word", F.size("vec").alias("width"), digest().alias("digest"))


@query("write_metric_rows", f"""{TREND_SQL}, z AS (SELECT avg(abs(trend - total)) AS mae, sqrt(avg(pow(trend - total, 2))) AS rmse FROM r)
    SELECT 'mae' AS metric, 'trend' AS model, 'run1' AS run, {R('mae', 2)} AS value FROM z UNION ALL SELECT 'mae', 'trend', 'run2', {R('mae', 2)} FROM z
    UNION ALL SELECT 'rmse', 'trend', 'run1', {R('rmse', 2)} FROM z UNION ALL SELECT 'rmse', 'trend', 'run2', {R('rmse', 2)} FROM z""", digits=2)
def _(t: Tables):
    path = t.scratch()
    metrics = evaluation.regression_errors(fitted_days(t), "total", "trend").select("mae", "rmse")
    for run in ("run1", "run2"):
        writers.write_metric_rows(metrics, path, run, "trend")
    return t.spark.read.parquet(path).select("metric", "model", "run", "value")


@query("write_result_tables", f"SELECT event_type AS channel, event_id, value AS target, {R('abs(value - 20)')} AS score FROM events")
def _(t: Tables):
    path = t.scratch()
    rows = t.events.withColumnRenamed("event_type", "channel")
    writers.write_result_tables({"target": rows.select("channel", "event_id", F.col("value").alias("target")),
                                 "score": rows.select("channel", "event_id", F.abs(F.col("value") - 20).alias("score"))}, path)
    back = writers.read_result_tables(t.spark, path, ["target", "score"])
    return back["target"].join(back["score"], ["channel", "event_id"])


@query("write_labeled_splits", f"""SELECT event_id, value, s AS split, (EXISTS (SELECT 1 FROM ({RANGES_SQL}) r
    WHERE f = event_type AND lo < event_id AND event_id < hi))::INT AS label FROM events
    JOIN ({SPLITS_SQL}) q ON f = event_type AND lo <= event_id AND event_id < hi""")
def _(t: Tables):
    path = t.scratch()
    rows = joins.label_by_ranges(t.events.select("event_id", "event_type", "value"), label_ranges(t), "event_id", "event_type")
    writers.write_labeled_splits(joins.split_by_ranges(rows, split_ranges(t), "event_id", "event_type"), path)
    return t.spark.read.parquet(path).select("event_id", "value", "split", "label")


@query("save_load_params", f"""WITH p AS (SELECT event_type, avg(value) AS m, stddev_samp(value) AS s FROM events GROUP BY 1)
    SELECT event_id, {R('(value - m) / s')} AS value FROM events JOIN p USING (event_type)""")
def _(t: Tables):
    from oddrows.operators.scaling import zscore_apply, zscore_fit
    path = t.scratch()
    writers.save_params(zscore_fit(t.events, "value", "event_type", ddof=1), path)
    params = writers.load_params(t.spark, path)
    return zscore_apply(t.events.select("event_id", "event_type", "value"), params, "value", "event_type").select("event_id", "value")


@query("label_map_json", "SELECT event_id, event_type AS series, strftime(ts, '%Y-%m-%d %H:%M:%S') AS stamp, json_extract(props, '$.k')::INT AS k FROM events")
def _(t: Tables):
    whole = F.concat(F.lit('{"'), "event_type", F.lit('":["'), F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), F.lit('"]}'))
    rows = t.events.select("event_id", F.from_json("props", "map<string,int>")["k"].alias("k"), readers.label_map(whole).alias("m"))
    return rows.select("event_id", "k", F.explode("m").alias("series", "stamps")).select("event_id", "k", "series", F.explode("stamps").alias("stamp"))
