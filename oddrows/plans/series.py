"""Queries: order, windows, splits and scaling."""

from __future__ import annotations

from pyspark.sql import functions as F

from oddrows.operators import forecast, joins, scaling, sequence, stats
from oddrows.plans.registry import H, R, Tables, U, query
from oddrows.plans.tables import keyed

#: events of one user in time order; `ts` is unique
W = "PARTITION BY user_id ORDER BY ts"
HOURLY_SQL = "SELECT date_trunc('hour', ts)::TIMESTAMP AS hour, count(*)::DOUBLE AS n, sum(value) AS total FROM events GROUP BY 1"
DAILY_SQL = "SELECT o_orderdate::DATE AS date, sum(o_totalprice) AS total FROM orders GROUP BY 1"


def hourly(t: Tables):
    """One row per hour: the number of rows is bounded by the calendar, not by the events."""
    return t.events.groupBy(F.date_trunc("hour", "ts").alias("hour")).agg(
        F.count(F.lit(1)).cast("double").alias("n"), F.sum("value").alias("total"))


def daily(t: Tables):
    """One row per order day (bounded by the calendar)."""
    return stats.daily_sum(t.orders, "o_orderdate", "o_totalprice")


def day_text(df, column: str = "date"):
    return df.withColumn(column, F.date_format(column, "yyyy-MM-dd"))


def joined(column: str, digits: int = 2):
    """Array column as text for comparison."""
    return F.array_join(F.transform(column, lambda v: F.format_number(v, digits)), "|")


# ---------------------------------------------------------------- sequence


@query("lag_matrix", f"""SELECT event_id, value AS value_lag_0, lag(value, 1) OVER w AS value_lag_1,
    lag(value, 2) OVER w AS value_lag_2, lag(value, 9) OVER w AS value_lag_9,
    strftime(lag(ts, 1) OVER w, '%Y-%m-%d') AS day_lag_1 FROM events WINDOW w AS ({W})""")
def _(t: Tables):
    day = t.events.withColumn("day", F.date_format("ts", "yyyy-MM-dd"))
    out = sequence.lag_matrix(day, "value", [0, 1, 2, 9], "ts", "user_id")
    out = sequence.lag_matrix(out, "day", [1], "ts", "user_id")
    return out.select("event_id", "value_lag_0", "value_lag_1", "value_lag_2", "value_lag_9", "day_lag_1")


@query("lead_target", f"""SELECT event_id, lead(value) OVER w AS next_value, lead(event_type) OVER w AS next_type
    FROM events WINDOW w AS ({W})""")
def _(t: Tables):
    out = sequence.lead_target(t.events, {"next_value": "value", "next_type": "event_type"}, "ts", "user_id")
    return out.select("event_id", "next_value", "next_type")


@query("rolling_mean_std", f"""SELECT event_id, {R('CASE WHEN c = 7 THEN m END')} AS meanval,
    {R('CASE WHEN c = 7 THEN s END')} AS deviation FROM (SELECT event_id, count(*) OVER w AS c, avg(value) OVER w AS m,
    stddev_samp(value) OVER w AS s FROM events WINDOW w AS ({W} ROWS BETWEEN 6 PRECEDING AND CURRENT ROW))""")
def _(t: Tables):
    return sequence.rolling_mean_std(t.events, "value", 7, "ts", "user_id").select("event_id", "meanval", "deviation")


@query("sliding_windows", f"""SELECT event_id, array_to_string(list_transform(v[1:10], lambda x: printf('%.2f', x)), '|') AS inputs,
    v[11] AS target FROM (SELECT event_id, list(value) OVER ({W} ROWS BETWEEN CURRENT ROW AND 10 FOLLOWING) AS v,
    row_number() OVER ({W}) AS rn FROM events) WHERE len(v) = 11 AND (rn - 1) % 3 = 0""")
def _(t: Tables):
    out = sequence.sliding_windows(t.events, "value", 10, "ts", "user_id", step=3)
    return out.select("event_id", joined("inputs").alias("inputs"), "target")


@query("tumbling_chunks", f"""SELECT user_id, chunk::BIGINT AS chunk,
    string_agg(printf('%.2f', value), '|' ORDER BY ts) AS values FROM (SELECT *, (row_number() OVER ({W}) - 1) // 8 AS chunk
    FROM events) GROUP BY 1, 2 HAVING count(*) = 8""")
def _(t: Tables):
    out = sequence.tumbling_chunks(t.events, "value", 8, "ts", "user_id")
    return out.select("user_id", "chunk", joined("values").alias("values"))


@query("segment_series", f"""SELECT event_id, (p // l)::BIGINT AS segment, (p % l)::BIGINT AS pos FROM (
    SELECT event_id, row_number() OVER ({W}) - 1 AS p, count(*) OVER (PARTITION BY user_id) // 5 AS l FROM events)
    WHERE p < l * 5""")
def _(t: Tables):
    return sequence.segment_series(t.events, 5, "ts", "user_id").select("event_id", "segment", "pos")


@query("shifted_chunks", f"""SELECT event_id, value AS input, target, chunk::BIGINT AS chunk FROM (SELECT event_id, value,
    lead(value) OVER ({W}) AS target, lead(event_id) OVER ({W}) AS nxt, (row_number() OVER ({W}) - 1) // 50 AS chunk
    FROM events) WHERE nxt IS NOT NULL""")
def _(t: Tables):
    return sequence.shifted_chunks(t.events, "value", 50, "ts", "user_id").select("event_id", "input", "target", "chunk")


@query("trim_ends", f"""SELECT event_id FROM (SELECT event_id, row_number() OVER ({W}) - 1 AS p,
    count(*) OVER (PARTITION BY user_id) AS n FROM events) WHERE p >= 10 AND p < n - 1""")
def _(t: Tables):
    return sequence.trim_ends(t.events, 10, 1, "ts", "user_id").select("event_id")


@query("chronological_split", """SELECT event_id, split FROM (SELECT event_id, CASE WHEN p < floor(n * 0.4::DOUBLE) THEN 'train'
    WHEN p < floor(n * 0.6::DOUBLE) THEN 'valid' WHEN p < n - 1 THEN 'test' END AS split FROM (
    SELECT event_id, row_number() OVER (ORDER BY ts, event_id) - 1 AS p, count(*) OVER () AS n FROM events))
    WHERE split IS NOT NULL""")
def _(t: Tables):
    return sequence.chronological_split(t.events.select("event_id", "ts"), ["ts", "event_id"]).select("event_id", "split")


@query("random_split", f"""SELECT event_id, CASE WHEN {U("'42:' || event_id")} < 0.8 THEN 'train' ELSE 'test' END AS split
    FROM events""")
def _(t: Tables):
    out = sequence.random_split(t.events, "event_id", {"train": 0.8, "test": 0.2}, seed=42)
    return out.select("event_id", "split")


@query("shuffle_sample", f"""SELECT event_id, {H("'3:' || event_id")} AS place FROM events WHERE {U("'3:' || event_id")} < 0.25""")
def _(t: Tables):
    from oddrows.functions.columns import hash32
    out = sequence.sample_rows(t.events.select("event_id"), "event_id", 0.25, seed=3)
    return sequence.shuffle_rows(out, "event_id", seed=3).withColumn("place", hash32(3, "event_id"))


@query("sorted_curve", """SELECT o_orderkey, o_totalprice, row_number() OVER (ORDER BY o_totalprice, o_orderkey) - 1 AS pos
    FROM orders""", digits=2)
def _(t: Tables):
    return sequence.sorted_curve(t.orders.select("o_orderkey", "o_totalprice"), "o_totalprice", "o_orderkey")


@query("sort_rows", """SELECT strftime(date, '%Y-%m-%d') AS date, """ + R("total", 2) + f""" AS total
    FROM ({DAILY_SQL}) ORDER BY date DESC""", digits=2)
def _(t: Tables):
    return day_text(daily(t).orderBy(F.desc("date")))


TOP_SQL = """(SELECT min(value) FROM (SELECT value FROM events ORDER BY value DESC
    LIMIT (SELECT greatest(floor(count(*) * 0.13::DOUBLE), 1)::BIGINT FROM events)))"""


@query("top_fraction_threshold", f"""SELECT event_id, value, (value >= {TOP_SQL})::INT AS is_outlier, {TOP_SQL} AS threshold
    FROM events""")
def _(t: Tables):
    limit = sequence.top_fraction_threshold(t.events, "value", 0.13)
    out = sequence.flag_top_fraction(t.events.select("event_id", "value"), "value", 0.13)
    return joins.attach_scalars(out, limit)


@query("first_n", "SELECT event_id, value FROM events WHERE event_type = 'error' ORDER BY event_id LIMIT 145")
def _(t: Tables):
    return t.events.filter("event_type = 'error'").orderBy("event_id").limit(145).select("event_id", "value")


AHEAD = range(1, 11)
ALL_STEPS = " + ".join(f"p_{h}" for h in AHEAD)
HORIZON_SQL = f"""WITH o AS (SELECT user_id, value, row_number() OVER ({W}) - 1 AS p FROM events),
    h AS (SELECT user_id, p AS origin, value + 0.1 * h AS predicted, h FROM o, (VALUES {', '.join(f'({h})' for h in AHEAD)}) s(h)),
    a AS (SELECT user_id, origin + h AS target_pos, {', '.join(f'max(predicted) FILTER (h = {h}) AS p_{h}' for h in AHEAD)} FROM h GROUP BY 1, 2)
    SELECT * FROM a WHERE {' AND '.join(f'p_{h} IS NOT NULL' for h in AHEAD)}"""


def horizons(t: Tables):
    """Naive forecasts for 1..10 rows ahead: the last value and a small drift per step."""
    from oddrows.functions.ordering import with_position
    placed = with_position(t.events.select("user_id", "ts", "value"), "ts", "user_id", "origin")
    steps = placed.withColumn("horizon", F.explode(F.sequence(F.lit(1), F.lit(len(AHEAD)))))
    steps = steps.withColumn("predicted", F.col("value") + 0.1 * F.col("horizon"))
    return placed, sequence.multi_horizon_align(steps, "origin", "horizon", "predicted", len(AHEAD), "user_id")


@query("multi_horizon_align", f"""SELECT user_id, target_pos::BIGINT AS target_pos, {R(f'({ALL_STEPS}) / {len(AHEAD)}')} AS mean_prediction,
    {R('p_1')} AS one_step, {R(f'p_{len(AHEAD)}')} AS n_step FROM ({HORIZON_SQL})""")
def _(t: Tables):
    return horizons(t)[1].select("user_id", "target_pos", "mean_prediction", "one_step", "n_step")


@query("horizon_error_profile", f"""WITH a AS ({HORIZON_SQL}), o AS (SELECT user_id, value, row_number() OVER ({W}) - 1 AS p FROM events)
    SELECT a.user_id, target_pos::BIGINT AS target_pos,
    {R('(' + ' + '.join(f'abs(p_{h} - value)' for h in AHEAD) + f') / {len(AHEAD)} * (SELECT stddev_samp(value) FROM events)')} AS error_profile
    FROM a JOIN o ON a.user_id = o.user_id AND target_pos = p""")
def _(t: Tables):
    from oddrows.operators.evaluation import horizon_error_profile
    placed, aligned = horizons(t)
    truth = placed.select("user_id", F.col("origin").alias("target_pos"), "value")
    both = aligned.join(truth, ["user_id", "target_pos"])
    scale = t.events.agg(F.stddev_samp("value")).scalar()
    return horizon_error_profile(both, "value", [f"p_{h}" for h in AHEAD], scale).select("user_id", "target_pos", "error_profile")


@query("difference", f"""SELECT event_id, {R('d')} AS d1, {R('d - lag(d, 12) OVER (PARTITION BY user_id ORDER BY ts)')} AS d1_12
    FROM (SELECT event_id, user_id, ts, value - lag(value) OVER ({W}) AS d FROM events)""")
def _(t: Tables):
    one = sequence.difference(t.events, "value", "ts", "user_id", to="d1")
    return sequence.difference(one, "value", "ts", "user_id", seasonal=12, to="d1_12").select("event_id", "d1", "d1_12")


def acf_sql(lags: int) -> str:
    return f"""WITH c AS (SELECT hour, n - avg(n) OVER () AS c, row_number() OVER (ORDER BY hour) AS p FROM ({HOURLY_SQL})),
    k AS (SELECT i AS lag, (SELECT coalesce(sum(a.c * b.c), 0) FROM c a JOIN c b ON a.p = b.p + i) /
        (SELECT sum(c * c) FROM c) AS acf FROM range({lags + 1}) r(i))
    SELECT lag::INT AS lag, {R('acf')} AS acf, {R('''CASE WHEN lag = 0 THEN 0 ELSE 1.96 * sqrt((1 + 2 * coalesce(
        (SELECT sum(j.acf * j.acf) FROM k j WHERE j.lag >= 1 AND j.lag < k.lag), 0)) / (SELECT count(*) FROM c)) END''')} AS half_width
    FROM k"""


@query("autocorrelation", acf_sql(20))
def _(t: Tables):
    return sequence.autocorrelation(hourly(t), "n", 20, "hour", hot_rows=None)


@query("unit_root_test", f"""WITH d AS (SELECT n - lag(n) OVER (ORDER BY hour) AS y, lag(n) OVER (ORDER BY hour) AS x FROM ({HOURLY_SQL})),
    r AS (SELECT regr_slope(y, x) AS b, regr_syy(y, x) AS syy, regr_sxy(y, x) AS sxy, regr_sxx(y, x) AS sxx,
        regr_count(y, x) AS n FROM d)
    SELECT {R('b')} AS gamma, {R('sqrt((syy - b * sxy) / (n - 2) / sxx)')} AS std_error,
    {R('b / sqrt((syy - b * sxy) / (n - 2) / sxx)')} AS t_stat, n::BIGINT AS n, -3.43::DOUBLE AS crit_1, -2.86::DOUBLE AS crit_5,
    -2.57::DOUBLE AS crit_10 FROM r""")
def _(t: Tables):
    return forecast.unit_root_test(hourly(t), "n", "hour", hot_rows=None)


@query("unit_root_offset", f"""WITH d AS (SELECT n - lag(n) OVER (ORDER BY hour) AS y, lag(n) OVER (ORDER BY hour) AS x FROM ({HOURLY_SQL})),
    r AS (SELECT regr_slope(y, x) AS b, regr_syy(y, x) AS syy, regr_sxy(y, x) AS sxy, regr_sxx(y, x) AS sxx, regr_count(y, x) AS n FROM d)
    SELECT {R('b', 4)} AS gamma, {R('b / sqrt((syy - b * sxy) / (n - 2) / sxx)', 4)} AS t_stat FROM r""", digits=4)
def _(t: Tables):
    raised = hourly(t).withColumn("n", F.col("n") + 1e9)  # the answer does not change with the level
    return forecast.unit_root_test(raised, "n", "hour", hot_rows=None).select("gamma", "t_stat")


@query("autocorrelation_constant_series", f"""WITH v AS (SELECT user_id, ts, CASE WHEN user_id % 3 = 0 THEN 5 ELSE value END AS x FROM events),
    c AS (SELECT user_id, ts, x - avg(x) OVER (PARTITION BY user_id) AS c FROM v),
    l AS (SELECT user_id, c, lag(c) OVER (PARTITION BY user_id ORDER BY ts) AS b FROM c),
    s AS (SELECT user_id, count(*) AS n, sum(c * c) AS s0, coalesce(sum(c * b), 0) AS s1 FROM l GROUP BY 1)
    SELECT user_id, {R('CASE WHEN s0 > 0 THEN s1 / s0 END')} AS acf FROM s""")
def _(t: Tables):
    steady = t.events.select("user_id", "ts", F.when(F.col("user_id") % 3 == 0, 5.0).otherwise(F.col("value")).alias("x"))
    return sequence.autocorrelation(steady, "x", 1, "ts", "user_id").filter("lag = 1").select("user_id", "acf")


@query("outlier_regions", f"""WITH f AS (SELECT user_id, ts, value, (value > 25)::INT AS flag FROM events),
    s AS (SELECT *, CASE WHEN flag = 1 AND coalesce(lag(flag) OVER ({W}), 0) <> 1 THEN 1 ELSE 0 END AS st FROM f),
    r AS (SELECT *, sum(st) OVER ({W}) AS region FROM s)
    SELECT user_id, region::BIGINT AS region, min(value) AS lo, max(value) AS hi, count(*)::BIGINT AS points
    FROM r WHERE flag = 1 GROUP BY 1, 2""")
def _(t: Tables):
    flagged = t.events.select("user_id", "ts", "value", (F.col("value") > 25).cast("int").alias("flag"))
    return sequence.outlier_regions(flagged, "flag", "value", "ts", "user_id")


# ---------------------------------------------------------------- scaling

SPLIT = "TIMESTAMP '2024-01-16'"


def train_rows(t: Tables):
    return t.events.filter(F.col("ts") < F.expr("TIMESTAMP_NTZ '2024-01-16'"))


@query("zscore", f"""SELECT event_id, {R(f'(value - (SELECT avg(value) FROM events WHERE ts < {SPLIT})) / (SELECT stddev_pop(value) FROM events WHERE ts < {SPLIT})')} AS value
    FROM events""")
def _(t: Tables):
    params = scaling.zscore_fit(train_rows(t), "value")
    return scaling.zscore_apply(t.events.select("event_id", "value"), params, "value")


@query("channel_standardize", f"""WITH p AS (SELECT event_type, avg(value) AS m, stddev_samp(value) AS s FROM events WHERE ts < {SPLIT} GROUP BY 1)
    SELECT event_id, {R('(value - m) / s')} AS value FROM events JOIN p USING (event_type) WHERE ts >= {SPLIT}""")
def _(t: Tables):
    params = scaling.zscore_fit(train_rows(t), "value", "event_type", ddof=1)
    test = t.events.filter(F.col("ts") >= F.expr("TIMESTAMP_NTZ '2024-01-16'")).select("event_id", "event_type", "value")
    return scaling.zscore_apply(test, params, "value", "event_type").select("event_id", "value")


@query("inverse_scale", f"SELECT event_id, {R('value')} AS value FROM events")
def _(t: Tables):
    params = scaling.zscore_fit(t.events, "value", ddof=1)
    scaled = scaling.zscore_apply(t.events.select("event_id", "value"), params, "value")
    return scaling.inverse_scale(scaled, params, "value")


@query("minmax_scale", f"""SELECT c_custkey, {R('(c_acctbal - (SELECT min(c_acctbal) FROM customer)) / (SELECT max(c_acctbal) - min(c_acctbal) FROM customer)')} AS c_acctbal
    FROM customer""")
def _(t: Tables):
    return scaling.minmax_apply(t.customer.select("c_custkey", "c_acctbal"), scaling.minmax_fit(t.customer, "c_acctbal"), "c_acctbal")


TREND_SQL = f"""WITH d AS ({DAILY_SQL}), k AS (SELECT date, total, isodow(date) - 1 AS dow FROM d),
    m AS (SELECT dow, avg(total) AS trend FROM k WHERE date < DATE '1999-01-01' GROUP BY 1),
    r AS (SELECT date, total, k.dow, trend, (SELECT stddev_samp(total) FROM k) AS std FROM k LEFT JOIN m ON m.dow = k.dow)"""


def early():
    return F.col("date") < F.lit("1999-01-01").cast("date")


@query("seasonal_detrend", f"""{TREND_SQL} SELECT strftime(date, '%Y-%m-%d') AS date, dow::INT AS dow, {R('total', 4)} AS total, {R('trend', 4)} AS trend,
    {R('std', 4)} AS std, {R('(total - trend) / std', 4)} AS detrended FROM r""", digits=4)
def _(t: Tables):
    return day_text(scaling.seasonal_detrend(daily(t), "date", "total", early()))


@query("seasonal_detrend_from_year", f"""{TREND_SQL.replace("FROM d),", "FROM d WHERE date >= DATE '1996-01-01'),")} SELECT strftime(date, '%Y-%m-%d') AS date,
    {R('trend', 4)} AS trend, {R('(total - trend) / std', 4)} AS detrended FROM r""", digits=4)
def _(t: Tables):
    return day_text(scaling.seasonal_detrend(daily(t), "date", "total", early(), first_day="1996-01-01")).select("date", "trend", "detrended")


COPIES = 100


def augmented(t: Tables):
    params = scaling.zscore_fit(t.events, ["value"], ddof=1)
    return scaling.noise_augment(t.events.select("event_id", "ts", "value", (F.col("event_type") == "error").cast("int").alias("label")),
                                 ["value"], "ts", params, copies=COPIES)


@query("noise_augment_labels", f"""SELECT copy::INT AS copy, (copy * n + p)::BIGINT AS row, event_id, label FROM (SELECT event_id,
    (event_type = 'error')::INT AS label, row_number() OVER (ORDER BY ts) - 1 AS p, count(*) OVER () AS n FROM events), range({COPIES + 1}) r(copy)""")
def _(t: Tables):
    return augmented(t).select("copy", "row", "event_id", "label")


NOISE_SQL = f"""sqrt(-2.0 * ln({U("'1:0:0:' || copy || ':' || p")})) * cos(2.0 * pi() * {U("'2:0:0:' || copy || ':' || p")})"""


@query("noise_augment", f"""SELECT (copy * n + p)::BIGINT AS row, {R(f'CASE WHEN copy = 0 THEN value ELSE value + 0.05 * copy / {COPIES} * s * {NOISE_SQL} END', 5)} AS value
    FROM (SELECT value, row_number() OVER (ORDER BY ts) - 1 AS p, count(*) OVER () AS n, stddev_samp(value) OVER () AS s FROM events),
    range({COPIES + 1}) r(copy)""", digits=5)
def _(t: Tables):
    return augmented(t).select("row", "value")


@query("assemble_features", f"""SELECT event_id, len(f)::INT AS width, {R('f[1] + 2 * f[2]')} AS mix FROM (SELECT event_id,
    [value, json_extract(props, '$.k')::DOUBLE] AS f FROM events)""")
def _(t: Tables):
    out = scaling.assemble_features(keyed(t), ["value", "k"])
    return out.select("event_id", F.size("features").alias("width"), (F.col("features")[0] + 2 * F.col("features")[1]).alias("mix"))
