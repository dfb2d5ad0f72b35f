"""Queries: cleaning, joins and aggregations."""

from __future__ import annotations

from pyspark.sql import functions as F

from oddrows.functions.quantiles import quantiles
from oddrows.operators import cleaning, joins, linear, scaling, stats
from oddrows.operators.text import build_vocabulary, hash_vectors
from oddrows.plans.registry import digest, DIM, query, R, Tables, U, word_vector_sql

# ---------------------------------------------------------------- cleaning


@query("select_columns", "SELECT l_orderkey, l_quantity, l_returnflag FROM lineitem")
def _(t: Tables):
    return t.lineitem.select("l_orderkey", "l_quantity", "l_returnflag")


@query("drop_columns", "SELECT event_id, user_id, event_type, value FROM events")
def _(t: Tables):
    return t.events.drop("props", "ts")


@query("rename_last_column",
       "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment AS target FROM customer")
def _(t: Tables):
    return cleaning.rename_last_column(t.customer)


@query("filter_equals", "SELECT event_id, user_id, value FROM events WHERE event_type = 'error'")
def _(t: Tables):
    return t.events.filter(F.col("event_type") == "error").select("event_id", "user_id", "value")


@query("filter_not_equals", "SELECT event_id, user_id, value FROM events WHERE event_type <> 'error'")
def _(t: Tables):
    return t.events.filter(F.col("event_type") != "error").select("event_id", "user_id", "value")


@query("filter_compound", """SELECT o_orderkey, o_totalprice FROM orders
    WHERE o_orderstatus = 'F' AND o_totalprice < 200000
      AND o_orderdate >= TIMESTAMP '1997-01-01' AND o_orderdate < TIMESTAMP '1999-01-01'""")
def _(t: Tables):
    day = F.col("o_orderdate")
    return t.orders.filter((F.col("o_orderstatus") == "F") & (F.col("o_totalprice") < 200000)
                           & (day >= F.expr("TIMESTAMP_NTZ '1997-01-01'"))
                           & (day < F.expr("TIMESTAMP_NTZ '1999-01-01'"))).select("o_orderkey", "o_totalprice")


@query("parse_timestamp", """SELECT event_id,
    CASE WHEN event_type = 'error' THEN NULL ELSE strftime(ts, '%Y/%m/%d %H:%M') END AS stamp,
    CASE WHEN event_type = 'error' THEN NULL ELSE hour(ts)::BIGINT END AS hour FROM events""")
def _(t: Tables):
    text = F.when(F.col("event_type") == "error", F.lit("not a time")).otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm"))
    raw = t.events.select("event_id", text.alias("stamp"))
    out = cleaning.parse_timestamp(raw, "stamp", "yyyy-MM-dd HH:mm")
    return out.select("event_id", F.date_format("stamp", "yyyy/MM/dd HH:mm").alias("stamp"),
                      F.hour("stamp").cast("bigint").alias("hour"))


@query("derive_date_key", "SELECT event_id, strftime(ts, '%Y-%m-%d') AS date FROM events")
def _(t: Tables):
    return cleaning.derive_date_key(t.events, "ts").select("event_id", "date")


@query("calendar_fields", """SELECT o_orderkey, year(o_orderdate)::INT AS year,
    (isodow(o_orderdate) - 1)::INT AS dow FROM orders""")
def _(t: Tables):
    return cleaning.calendar_fields(t.orders, "o_orderdate").select("o_orderkey", "year", "dow")


@query("drop_duplicate_rows", "SELECT DISTINCT l_quantity, l_discount, l_tax FROM lineitem")
def _(t: Tables):
    return t.lineitem.select("l_quantity", "l_discount", "l_tax").dropDuplicates()


GAPS_SQL = """SELECT event_id, CASE WHEN event_id % 7 = 0 THEN NULL ELSE user_id END AS user_id,
    CASE WHEN event_id % 3 = 0 THEN NULL ELSE value END AS value, event_type,
    CASE WHEN event_id % 50 = 0 THEN NULL ELSE length(props) END AS size FROM events"""


def gaps(t: Tables):
    """Events with cells emptied by rule; the given tables have no missing cells."""
    k = F.col("event_id")
    return t.events.select(
        "event_id", F.when(k % 7 != 0, F.col("user_id")).alias("user_id"),
        F.when(k % 3 != 0, F.col("value")).alias("value"), "event_type",
        F.when(k % 50 != 0, F.length("props").cast("bigint")).alias("size"))


@query("has_missing", f"""WITH g AS ({GAPS_SQL}) SELECT 'gaps' AS source, max((event_id IS NULL OR user_id IS NULL
    OR value IS NULL OR event_type IS NULL OR size IS NULL)::INT) = 1 AS has_missing FROM g
    UNION ALL SELECT 'orders', max((o_orderkey IS NULL OR o_custkey IS NULL OR o_totalprice IS NULL
    OR o_orderstatus IS NULL OR o_orderdate IS NULL OR o_orderpriority IS NULL)::INT) = 1 FROM orders""")
def _(t: Tables):
    return cleaning.has_missing(gaps(t)).withColumn("source", F.lit("gaps")).unionByName(
        cleaning.has_missing(t.orders).withColumn("source", F.lit("orders")))


@query("missing_profile", f"""WITH g AS ({GAPS_SQL}), s AS (
    SELECT 'user_id' AS "column", avg((user_id IS NULL)::INT) AS percent FROM g
    UNION ALL SELECT 'value', avg((value IS NULL)::INT) FROM g
    UNION ALL SELECT 'event_type', avg((event_type IS NULL)::INT) FROM g
    UNION ALL SELECT 'size', avg((size IS NULL)::INT) FROM g)
    SELECT "column", {R('percent')} AS percent FROM s WHERE percent > 0""")
def _(t: Tables):
    return cleaning.missing_profile(gaps(t))


@query("drop_missing_rows", f"WITH g AS ({GAPS_SQL}) SELECT * FROM g WHERE user_id IS NOT NULL AND size IS NOT NULL")
def _(t: Tables):
    return cleaning.drop_missing_rows(gaps(t), after_top=1)


@query("drop_any_missing", f"""WITH g AS ({GAPS_SQL}) SELECT * FROM g
    WHERE user_id IS NOT NULL AND size IS NOT NULL AND value IS NOT NULL AND event_type IS NOT NULL""")
def _(t: Tables):
    return cleaning.drop_missing_rows(gaps(t))


@query("impute_mean", f"""WITH g AS ({GAPS_SQL}) SELECT event_id,
    {R('coalesce(value, (SELECT avg(value) FROM g))')} AS value,
    {R('coalesce(size, (SELECT avg(size) FROM g))')} AS size FROM g""")
def _(t: Tables):
    return cleaning.impute_mean(gaps(t), ["value", "size"]).select("event_id", "value", "size")


@query("clean_infinite", """SELECT event_id,
    CASE WHEN event_type IN ('error', 'click') THEN NULL ELSE value END AS as_null,
    CASE WHEN event_type IN ('error', 'click') THEN 0.0 ELSE value END AS as_zero FROM events""")
def _(t: Tables):
    bad = F.when(F.col("event_type") == "error", float("inf")).when(
        F.col("event_type") == "click", float("nan")).otherwise(F.col("value"))
    raw = t.events.select("event_id", bad.alias("as_null"), bad.alias("as_zero"))
    return cleaning.clean_infinite(cleaning.clean_infinite(raw, ["as_null"]), ["as_zero"], fill=0.0)


@query("cast_columns", f"""SELECT o_orderkey, {R('o_totalprice::FLOAT', 2)} AS price,
    TRY_CAST(substr(o_orderpriority, 1, 1) AS INT) AS priority, TRY_CAST(o_orderstatus AS INT) AS status,
    o_custkey::VARCHAR AS custkey FROM orders""", digits=2)
def _(t: Tables):
    raw = t.orders.select("o_orderkey", F.col("o_totalprice").alias("price"),
                          F.substring("o_orderpriority", 1, 1).alias("priority"),
                          F.col("o_orderstatus").alias("status"), F.col("o_custkey").alias("custkey"))
    out = cleaning.cast_columns(raw, {"price": "float", "priority": "int", "status": "int", "custkey": "string"})
    return out.withColumn("price", F.col("price").cast("double"))


@query("override_by_key", """SELECT c_custkey, c_name, coalesce(s_acctbal, c_acctbal) AS c_acctbal
    FROM customer LEFT JOIN supplier ON s_suppkey = c_custkey""")
def _(t: Tables):
    new = t.supplier.select(F.col("s_suppkey").alias("c_custkey"), F.col("s_acctbal").alias("c_acctbal"))
    return cleaning.override_by_key(t.customer, new, "c_custkey", "c_acctbal").select("c_custkey", "c_name", "c_acctbal")


@query("map_codes", """SELECT o_orderkey, CASE o_orderstatus WHEN 'O' THEN 'open' WHEN 'F' THEN 'done' END AS name
    FROM orders""")
def _(t: Tables):
    return t.orders.select("o_orderkey", cleaning.map_codes("o_orderstatus", {"O": "open", "F": "done"}).alias("name"))


@query("fill_gaps_with_neighbours", f"""WITH z AS (SELECT event_id, user_id,
        row_number() OVER (PARTITION BY user_id ORDER BY ts) AS p,
        CASE WHEN event_type IN ('error', 'click') THEN 0.0 ELSE value END AS x FROM events),
    n AS (SELECT *, max(CASE WHEN x <> 0 THEN p END) OVER (PARTITION BY user_id ORDER BY p) AS pp,
        min(CASE WHEN x <> 0 THEN p END) OVER (PARTITION BY user_id ORDER BY p
            ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS np FROM z)
    SELECT n.event_id, {R('''CASE WHEN n.x <> 0 OR n.pp IS NULL OR n.np IS NULL THEN n.x
        ELSE a.x / pow(2.0, n.p - n.pp) + CASE WHEN n.np = n.p + 1 THEN b.x / 2 ELSE 0 END END''', 12)} AS x
    FROM n LEFT JOIN z a ON a.user_id = n.user_id AND a.p = n.pp
           LEFT JOIN z b ON b.user_id = n.user_id AND b.p = n.np""", digits=12)
def _(t: Tables):
    x = F.when(F.col("event_type").isin("error", "click"), 0.0).otherwise(F.col("value"))
    raw = t.events.select("event_id", "user_id", "ts", x.alias("x"))
    return cleaning.fill_gaps_with_neighbours(raw, "ts", ["x"], "user_id").select("event_id", "x")


@query("flag_where", """SELECT event_id, CASE WHEN value > 50 THEN value END AS high FROM events""")
def _(t: Tables):
    return t.events.select("event_id", cleaning.flag_where("value", F.col("value") > 50).alias("high"))


@query("preview", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 5")
def _(t: Tables):
    return cleaning.preview(t.orders.select("o_orderkey", "o_custkey", "o_totalprice"), "o_orderkey", 5)


@query("row_lookup", "SELECT p_partkey, p_name, p_retailprice FROM part WHERE p_partkey IN (16, 65)")
def _(t: Tables):
    return t.part.filter(F.col("p_partkey").isin(16, 65)).select("p_partkey", "p_name", "p_retailprice")


@query("shape", "SELECT count(*)::BIGINT AS rows, 11 AS columns FROM lineitem")
def _(t: Tables):
    return cleaning.shape(t.lineitem)


# ---------------------------------------------------------------- joins

DATED_SQL = "SELECT item_id, (DATE '2024-01-01' + (item_id * 3 % 45)::INT)::DATE AS date, text FROM benchmark"


def dated_texts(t: Tables):
    day = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("item_id") * 3 % 45).cast("int"))
    return t.benchmark.select("item_id", day.alias("date"), "text")


@query("attach_event_text", f"""WITH d AS (SELECT ts::DATE AS date, sum(value) AS total FROM events GROUP BY 1),
    x AS (SELECT date, string_agg(text || ' ', '' ORDER BY item_id) AS s FROM ({DATED_SQL}) GROUP BY 1)
    SELECT strftime(d.date, '%Y-%m-%d') AS date, {R('total', 2)} AS total, (s IS NOT NULL)::INT AS txt,
    coalesce(s, 'None') AS txt_desc FROM d LEFT JOIN x ON d.date = x.date""", digits=2)
def _(t: Tables):
    days = stats.daily_sum(t.events, "ts", "value")
    out = joins.attach_event_text(days, dated_texts(t), "date", "text", "item_id")
    return out.withColumn("date", F.date_format("date", "yyyy-MM-dd"))


@query("match_label_timestamps", """SELECT event_id, event_type FROM events WHERE date_trunc('minute', ts) IN
    (SELECT date_trunc('minute', ts) FROM events WHERE event_type = 'error')""")
def _(t: Tables):
    minute = t.events.withColumn("minute", F.date_trunc("minute", "ts"))
    labels = minute.filter(F.col("event_type") == "error")
    return joins.match_label_timestamps(minute, labels, "minute").select("event_id", "event_type")


#: (lo, hi) in thousandths of the largest index of a file; two of them overlap
PARTS = [(10, 48), (45, 90), (200, 290), (700, 750), (990, 1001)]
RANGES_SQL = f"""SELECT event_type AS f, (top * a) // 1000 AS lo, (top * b) // 1000 AS hi FROM (SELECT event_type, max(event_id) AS top
    FROM events GROUP BY 1), (VALUES {', '.join(map(str, PARTS))}) p(a, b)"""
SPLITS = [("train", 0, 600), ("test", 500, 1001)]
SPLITS_SQL = f"""SELECT event_type AS f, s, (top * a) // 1000 AS lo, (top * b) // 1000 + 1 AS hi FROM (SELECT event_type, max(event_id) AS top
    FROM events GROUP BY 1), (VALUES {', '.join(map(str, SPLITS))}) p(s, a, b)"""


def label_ranges(t: Tables):
    """Label ranges of every file (event type), placed along its whole length."""
    parts = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a, b in PARTS])
    tops = t.events.groupBy("event_type").agg(F.max("event_id").alias("top")).select("*", F.inline(parts))
    return tops.select("event_type", F.expr("top * a div 1000").alias("lo"), F.expr("top * b div 1000").alias("hi"))


def split_ranges(t: Tables):
    parts = F.array(*[F.struct(F.lit(n).alias("split"), F.lit(a).alias("a"), F.lit(b).alias("b")) for n, a, b in SPLITS])
    tops = t.events.groupBy("event_type").agg(F.max("event_id").alias("top")).select("*", F.inline(parts))
    return tops.select("event_type", "split", F.expr("top * a div 1000").alias("lo"), F.expr("top * b div 1000 + 1").alias("hi"))


@query("label_by_ranges", f"""SELECT event_id, event_type, (EXISTS (SELECT 1 FROM ({RANGES_SQL}) r
    WHERE f = event_type AND lo < event_id AND event_id < hi))::INT AS label FROM events""")
def _(t: Tables):
    return joins.label_by_ranges(t.events.select("event_id", "event_type"), label_ranges(t), "event_id", "event_type")


@query("split_by_ranges", f"""SELECT event_id, event_type, s AS split FROM events
    JOIN ({SPLITS_SQL}) r ON f = event_type AND lo <= event_id AND event_id < hi""")
def _(t: Tables):
    return joins.split_by_ranges(t.events.select("event_id", "event_type"), split_ranges(t), "event_id", "event_type")


@query("broadcast_group_stat", f"""WITH d AS (SELECT o_orderdate::DATE AS date, sum(o_totalprice) AS total FROM orders GROUP BY 1),
    m AS (SELECT isodow(date) - 1 AS dow, avg(total) AS mean FROM d WHERE date < DATE '1998-01-01' GROUP BY 1)
    SELECT strftime(date, '%Y-%m-%d') AS date, {R('total', 2)} AS total, {R('mean')} AS mean
    FROM d JOIN m ON isodow(date) - 1 = dow""")
def _(t: Tables):
    days = stats.daily_sum(t.orders, "o_orderdate", "o_totalprice").withColumn("dow", F.weekday("date"))
    means = stats.group_mean_filtered(days, "dow", "total", F.col("date") < F.lit("1998-01-01").cast("date"))
    out = joins.broadcast_group_stat(days, means, "dow")
    return out.select(F.date_format("date", "yyyy-MM-dd").alias("date"), F.round("total", 2).alias("total"), "mean")


FILTER_SQL = """translate(lower(text), '!"#$%&()*+,-./:;<=>?@[\\]^_`{|}~' || chr(9) || chr(10), repeat(' ', 33))"""


def words_sql(table: str, key: str) -> str:
    """SQL for one row per word of every text, with its place."""
    return f"""SELECT {key}, word, row_number() OVER (PARTITION BY {key} ORDER BY i) AS place FROM (
        SELECT {key}, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM (
            SELECT {key}, string_split({FILTER_SQL}, ' ') AS w FROM {table})) WHERE word <> ''"""


def vocabulary_sql(table: str, key: str) -> str:
    return f"""SELECT word, n AS count, row_number() OVER (ORDER BY n DESC, word) AS index FROM (
        SELECT word, count(*) AS n FROM ({words_sql(table, key)}) GROUP BY word)"""


@query("lookup_word_vectors", f"""WITH v AS MATERIALIZED (SELECT word, index FROM ({vocabulary_sql('benchmark', 'item_id')}) WHERE index < 600),
    x AS ({word_vector_sql('SELECT word FROM v WHERE length(word) % 2 = 0')})
    SELECT v.word, index::BIGINT AS index, {DIM}::INT AS width, {R('coalesce(sum((i + 1) * x * abs(x)), 0)', 4)} AS digest
    FROM v LEFT JOIN x ON x.word = v.word GROUP BY v.word, index""", digits=4)
def _(t: Tables):
    vocabulary = build_vocabulary(t.benchmark, "text")
    vectors = hash_vectors(vocabulary.filter(F.length("word") % 2 == 0), DIM)
    out = joins.lookup_word_vectors(vocabulary, vectors, DIM, 600)
    return out.select("word", "index", F.size("vec").alias("width"), digest().alias("digest"))


@query("parameter_grid", f"""SELECT event_type, sigma::DOUBLE AS sigma, side::INT AS side, days::INT AS days,
    {R('m + sigma * side * s / sqrt(days)')} AS band
    FROM (SELECT event_type, avg(value) AS m, stddev_samp(value) AS s FROM events GROUP BY 1),
    (SELECT unnest([1.5, 1.75, 2.0]) AS sigma), (SELECT unnest([-1, 1]) AS side), (SELECT unnest([1, 7, 30]) AS days)""")
def _(t: Tables):
    base = t.events.groupBy("event_type").agg(F.avg("value").alias("m"), F.stddev_samp("value").alias("s"))
    grid = joins.parameter_grid(base, {"sigma": [1.5, 1.75, 2.0], "side": [-1, 1], "days": [1, 7, 30]})
    band = F.col("m") + F.col("sigma") * F.col("side") * F.col("s") / F.sqrt("days")
    return grid.select("event_type", "sigma", "side", "days", band.alias("band"))


@query("value_grid", f"""SELECT {R('lo + (hi - lo) * i / 99')} AS value FROM (SELECT min(value) lo, max(value) hi FROM events),
    range(100) r(i)""")
def _(t: Tables):
    return joins.value_grid(t.events, "value", 100)


@query("value_grid_2d", f"""SELECT {R('a + (b - a) * i / 99')} AS l_quantity, {R('c + (d - c) * j / 99')} AS l_extendedprice
    FROM (SELECT min(l_quantity) a, max(l_quantity) b, min(l_extendedprice) c, max(l_extendedprice) d FROM lineitem),
    range(100) r(i), range(100) s(j)""")
def _(t: Tables):
    return joins.value_grid(t.lineitem, ["l_quantity", "l_extendedprice"], 100)


@query("attach_scores", f"""WITH z AS (SELECT event_id AS k,
    abs(value - avg(value) OVER ()) / stddev_pop(value) OVER () AS score FROM events)
    SELECT event_id, event_type, {R('score')} AS score FROM events LEFT JOIN z ON k = event_id""")
def _(t: Tables):
    z = scaling.zscore_apply(t.events, scaling.zscore_fit(t.events, "value"), "value")
    scores = z.select("event_id", F.abs("value").alias("score"))
    return joins.attach_scores(t.events.select("event_id", "event_type"), scores, "event_id")


CENTRES = [[5.0, 20.0], [25.0, 50.0], [60.0, 50.0], [25.0, 90.0]]
KEYED_SQL = "SELECT event_id, value, json_extract(props, '$.k')::DOUBLE AS k FROM events"


def keyed(t: Tables):
    return t.events.select("event_id", "ts", "user_id", "event_type", "value",
                           F.get_json_object("props", "$.k").cast("double").alias("k"))


@query("assign_nearest", f"""WITH d AS (SELECT event_id, c, sqrt(pow(value - x, 2) + pow(k - y, 2)) AS dist
        FROM ({KEYED_SQL}), (VALUES {', '.join(f'({i}, {x}, {y})' for i, (x, y) in enumerate(CENTRES))}) m(c, x, y))
    SELECT event_id, arg_min(c, dist)::INT AS cluster, {R('min(dist)')} AS distance FROM d GROUP BY event_id""")
def _(t: Tables):
    return joins.assign_nearest(keyed(t), ["value", "k"], CENTRES).select("event_id", "cluster", "distance")


@query("union_rows", """SELECT l_orderkey, l_quantity FROM lineitem WHERE l_quantity < 25
    UNION ALL SELECT l_orderkey, l_quantity FROM lineitem WHERE l_quantity >= 25""")
def _(t: Tables):
    rows = t.lineitem.select("l_orderkey", "l_quantity")
    return joins.union_rows(rows.filter("l_quantity < 25"), rows.filter("l_quantity >= 25"))


# ---------------------------------------------------------------- aggregations


@query("daily_sum", f"""SELECT strftime(o_orderdate, '%Y-%m-%d') AS date, {R('sum(o_totalprice)', 2)} AS total
    FROM orders GROUP BY 1""", digits=2)
def _(t: Tables):
    return stats.daily_sum(t.orders, "o_orderdate", "o_totalprice").withColumn("date", F.date_format("date", "yyyy-MM-dd"))


@query("group_mean_filtered", f"""SELECT (isodow(o_orderdate) - 1)::INT AS dow, {R('avg(o_totalprice)')} AS mean
    FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01' GROUP BY 1""")
def _(t: Tables):
    keyed_orders = t.orders.select(F.weekday("o_orderdate").alias("dow"), "o_orderdate", "o_totalprice")
    return stats.group_mean_filtered(keyed_orders, "dow", "o_totalprice",
                                     F.col("o_orderdate") < F.expr("TIMESTAMP_NTZ '1998-01-01'"))


@query("sample_std", f"""SELECT 'all' AS part, {R('stddev_samp(o_totalprice)', 4)} AS std FROM orders UNION ALL
    SELECT year(o_orderdate)::VARCHAR, {R('stddev_samp(o_totalprice)', 4)} FROM orders GROUP BY 1""", digits=4)
def _(t: Tables):
    std = F.stddev_samp("o_totalprice").alias("std")
    return t.orders.agg(std).withColumn("part", F.lit("all")).unionByName(
        t.orders.groupBy(F.year("o_orderdate").cast("string").alias("part")).agg(std))


@query("class_counts", "SELECT event_type, count(*)::BIGINT AS n FROM events GROUP BY 1")
def _(t: Tables):
    return stats.class_counts(t.events, "event_type")


@query("distinct_values", "SELECT DISTINCT o_orderpriority, o_orderstatus FROM orders")
def _(t: Tables):
    return t.orders.select("o_orderpriority", "o_orderstatus").distinct()


@query("distinct_counts", "SELECT label, count(*)::BIGINT AS n FROM embeddings GROUP BY 1")
def _(t: Tables):
    return t.embeddings.groupBy("label").agg(F.count(F.lit(1)).alias("n"))


def describe_sql(column: str, table: str, by: str = "") -> str:
    lead = f"{by}, " if by else ""
    tail = f"GROUP BY {by}" if by else ""
    return f"""SELECT {lead}'{column}' AS "column", count({column})::BIGINT AS count, {R(f'avg({column})')} AS mean,
        {R(f'stddev_samp({column})')} AS std, {R(f'min({column})')} AS min, {R(f'max({column})')} AS max,
        {R(f'quantile_cont({column}, 0.25)')} AS p25, {R(f'quantile_cont({column}, 0.5)')} AS p50,
        {R(f'quantile_cont({column}, 0.75)')} AS p75 FROM {table} {tail}"""


@query("describe", " UNION ALL ".join(describe_sql(c, "lineitem") for c in ("l_quantity", "l_extendedprice", "l_discount")))
def _(t: Tables):
    return stats.describe(t.lineitem, ["l_quantity", "l_extendedprice", "l_discount"])


@query("describe_by_class", describe_sql("value", "events", "event_type"))
def _(t: Tables):
    return stats.describe(t.events, "value", "event_type")


@query("min_max", """SELECT min(o_totalprice) AS lo, max(o_totalprice) AS hi FROM orders""")
def _(t: Tables):
    return t.orders.agg(F.min("o_totalprice").alias("lo"), F.max("o_totalprice").alias("hi"))


@query("skewness_adj", f"SELECT event_type, {R('skewness(value)', 5)} AS skew FROM events GROUP BY 1", digits=5)
def _(t: Tables):
    return t.events.groupBy("event_type").agg(stats.skewness_adj("value").alias("skew"))


@query("kurtosis_adj", f"SELECT event_type, {R('kurtosis(value)', 5)} AS kurt FROM events GROUP BY 1", digits=5)
def _(t: Tables):
    return t.events.groupBy("event_type").agg(stats.kurtosis_adj("value").alias("kurt"))


PROBS = (0.01, 0.25, 0.5, 0.75, 0.87, 0.99)


@query("quantiles_linear", " UNION ALL ".join(
    f"SELECT l_returnflag, 'l_extendedprice' AS \"column\", {p}::DOUBLE AS prob, count(*)::BIGINT AS n, "
    f"{R(f'quantile_cont(l_extendedprice, {p})')} AS value FROM lineitem GROUP BY 1" for p in PROBS))
def _(t: Tables):
    return quantiles(t.lineitem, "l_extendedprice", PROBS, "l_returnflag")


def histogram_sql(table: str, column: str, bins: int, by: str | None = None, upper: str = "") -> str:
    g = f"{by}, " if by else ""
    on = f"AND e.{by} = c.{by}" if by else ""
    eg = f"e.{by}, " if by else ""
    return f"""WITH k AS (SELECT {g}{column}::DOUBLE AS x FROM {table} {upper}),
        e AS (SELECT {g}min(x) AS lo, max(x) AS hi FROM k {f'GROUP BY {by}' if by else ''}),
        b AS (SELECT {'k.' + by + ',' if by else ''} least(floor((x - lo) * {bins} / (hi - lo)), {bins - 1})::INT AS bin FROM k, e
              {f'WHERE k.{by} = e.{by}' if by else ''}),
        c AS (SELECT {g}bin, count(*) AS n FROM b GROUP BY {g}bin)
        SELECT {eg}i::INT AS bin, {R(f'lo + i * (hi - lo) / {bins}')} AS "left", {R(f'lo + (i + 1) * (hi - lo) / {bins}')} AS "right",
        coalesce(n, 0)::BIGINT AS count FROM e CROSS JOIN range({bins}) r(i) LEFT JOIN c ON c.bin = i {on}"""


@query("equal_width_histogram", histogram_sql("lineitem", "l_extendedprice", 40))
def _(t: Tables):
    return stats.equal_width_histogram(t.lineitem, "l_extendedprice", 40)


@query("histogram_by_class", histogram_sql("documents", "n_chars", 30, "lang", "WHERE n_chars < 2000"))
def _(t: Tables):
    return stats.equal_width_histogram(t.documents, "n_chars", 30, "lang", upper=2000)


@query("density_curve", f"""WITH h AS (SELECT count(value) AS n, min(value) AS lo, max(value) AS hi,
        stddev_samp(value) AS s, pow(count(value), -0.2) * stddev_samp(value) AS h FROM events),
    b AS (SELECT lo + (bin + 0.5) * (hi - lo) / 1024 AS x, c FROM (SELECT lo, hi,
        least(floor((value - lo) * 1024 / (hi - lo)), 1023) AS bin, count(*) AS c FROM events, h GROUP BY 1, 2, 3)),
    g AS (SELECT lo - 3 * h + (hi - lo + 6 * h) * i / 199 AS x, h, n FROM h, range(200) r(i))
    SELECT {R('g.x')} AS x, {R('sum(c * exp(-0.5 * pow((g.x - b.x) / h, 2))) / (max(n) * max(h) * sqrt(2 * pi()))', 8)} AS density
    FROM g, b GROUP BY g.x""", digits=8)
def _(t: Tables):
    return stats.density_curve(t.events, "value").withColumn("x", F.round("x", 6))


@query("concat_text_by_key", f"""SELECT strftime(date, '%Y-%m-%d') AS date, string_agg(text || ' ', '' ORDER BY item_id) AS text
    FROM ({DATED_SQL}) GROUP BY 1""")
def _(t: Tables):
    out = stats.concat_text_by_key(dated_texts(t), "date", "text", "item_id")
    return out.withColumn("date", F.date_format("date", "yyyy-MM-dd"))


@query("correlation", f"SELECT l_returnflag, {R('corr(l_quantity, l_extendedprice)')} AS corr FROM lineitem GROUP BY 1")
def _(t: Tables):
    return t.lineitem.groupBy("l_returnflag").agg(F.corr("l_quantity", "l_extendedprice").alias("corr"))


@query("linear_fit", f"""SELECT {R('regr_slope(l_extendedprice, l_quantity)', 4)} AS slope,
    {R('regr_intercept(l_extendedprice, l_quantity)', 4)} AS intercept,
    {R('regr_r2(l_extendedprice, l_quantity)', 4)} AS r2 FROM lineitem""", digits=4)
def _(t: Tables):
    return stats.linear_fit(t.lineitem, "l_quantity", "l_extendedprice")


def resample_sql(unit: str, by: str) -> str:
    return f"""WITH a AS (SELECT {by}, date_trunc('{unit}', ts)::TIMESTAMP AS b, avg(value) AS m, stddev_samp(value) AS s
        FROM events GROUP BY 1, 2),
      f AS (SELECT {by}, unnest(generate_series(min(b), max(b), INTERVAL 1 {unit})) AS b FROM a GROUP BY 1)
      SELECT {by}, strftime(f.b, '%Y-%m-%d %H') AS bucket, {R('m', 9)} AS value_mean, {R('s', 9)} AS value_std
      FROM f LEFT JOIN a USING ({by}, b)"""


@query("calendar_resample", resample_sql("day", "event_type"), digits=9)
def _(t: Tables):
    out = stats.calendar_resample(t.events, "ts", ["value"], "day", "event_type")
    return out.withColumn("bucket", F.date_format("bucket", "yyyy-MM-dd HH"))


@query("calendar_resample_hourly", resample_sql("hour", "event_type"), digits=9)
def _(t: Tables):
    out = stats.calendar_resample(t.events, "ts", ["value"], "hour", "event_type")
    return out.withColumn("bucket", F.date_format("bucket", "yyyy-MM-dd HH"))


@query("error_mean_cov", f"""SELECT event_type, n::BIGINT AS n, {R('m0')} AS m0, {R('m1')} AS m1, {R('c00')} AS c00,
    {R('c01')} AS c01, {R('c11')} AS c11 FROM (SELECT event_type, count(*) AS n, avg(value) AS m0, avg(k) AS m1,
    var_samp(value) AS c00, covar_samp(value, k) AS c01, var_samp(k) AS c11
    FROM (SELECT event_type, value, json_extract(props, '$.k')::DOUBLE AS k FROM events) GROUP BY 1)""")
def _(t: Tables):
    out = stats.error_mean_cov(keyed(t), ["value", "k"], "event_type")
    cell = lambda c, i: F.col(c)[i]
    return out.select("event_type", "n", cell("mean", 0).alias("m0"), cell("mean", 1).alias("m1"),
                      cell("cov", 0).alias("c00"), cell("cov", 1).alias("c01"), cell("cov", 3).alias("c11"))


@query("box_stats", f"""WITH q AS (SELECT event_type AS g, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS median,
        quantile_cont(value, 0.75) AS q3 FROM events GROUP BY 1),
    x AS (SELECT *, value >= q1 - 1.5 * (q3 - q1) AND value <= q3 + 1.5 * (q3 - q1) AS ok FROM events JOIN q ON g = event_type)
    SELECT event_type, {R('q1')} AS q1, {R('median')} AS median, {R('q3')} AS q3, min(value) AS min, max(value) AS max,
    min(value) FILTER (ok) AS low_whisker, max(value) FILTER (ok) AS high_whisker, count(*) FILTER (NOT ok)::BIGINT AS outside
    FROM x GROUP BY event_type, q1, median, q3""")
def _(t: Tables):
    return stats.box_stats(t.events, "value", "event_type")


@query("best_by", """SELECT event_type, event_id, value, user_id FROM (SELECT *, row_number() OVER (
    PARTITION BY event_type ORDER BY value, event_id) AS r FROM events) WHERE r = 1""")
def _(t: Tables):
    return stats.best_by(t.events.select("event_type", "event_id", "value", "user_id"), "value", "event_type", tie="event_id")


#: events whose class is null in every seventh row
HOLED_SQL = "SELECT event_id, ts, value, user_id, CASE WHEN event_id % 7 = 0 THEN NULL ELSE event_type END AS grp FROM events"


def holed(t: Tables):
    grp = F.when(F.col("event_id") % 7 != 0, F.col("event_type"))
    return t.events.select("event_id", "ts", "value", "user_id", grp.alias("grp"))


@query("best_by_null_group", f"""SELECT grp, event_id, value, user_id FROM (SELECT *, row_number() OVER (
    PARTITION BY grp ORDER BY value, event_id) AS r FROM ({HOLED_SQL})) WHERE r = 1""")
def _(t: Tables):
    return stats.best_by(holed(t).select("grp", "event_id", "value", "user_id"), "value", "grp", tie="event_id")


@query("describe_null_group", f"""SELECT grp, count(value)::BIGINT AS count, {R('avg(value)')} AS mean, {R('quantile_cont(value, 0.25)')} AS p25,
    {R('quantile_cont(value, 0.5)')} AS p50, {R('quantile_cont(value, 0.75)')} AS p75 FROM ({HOLED_SQL}) GROUP BY grp""")
def _(t: Tables):
    return stats.describe(holed(t), "value", "grp").select("grp", "count", "mean", "p25", "p50", "p75")


@query("box_stats_null_group", f"""WITH x AS ({HOLED_SQL}), q AS (SELECT grp AS g, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3
        FROM x GROUP BY 1),
    y AS (SELECT *, value >= q1 - 1.5 * (q3 - q1) AND value <= q3 + 1.5 * (q3 - q1) AS ok FROM x JOIN q ON g IS NOT DISTINCT FROM grp)
    SELECT grp, min(value) FILTER (ok) AS low_whisker, max(value) FILTER (ok) AS high_whisker, count(*) FILTER (NOT ok)::BIGINT AS outside
    FROM y GROUP BY grp""")
def _(t: Tables):
    return stats.box_stats(holed(t), "value", "grp").select("grp", "low_whisker", "high_whisker", "outside")


@query("linear_offset", f"""SELECT event_type, {R('regr_slope(y, x)')} AS slope FROM (SELECT event_type, epoch(ts) AS x,
    3 * (epoch(ts) - 1700000000) + value AS y FROM events) GROUP BY 1""")
def _(t: Tables):
    seconds = F.unix_timestamp("ts").cast("double")
    e = t.events.select("event_type", seconds.alias("x"), (3 * (seconds - 1.7e9) + F.col("value")).alias("y"))
    return linear.fit_linear(e, ["x"], "y", "event_type").select("event_type", F.col("coef")[1].alias("slope"))


@query("conditional_counts", """SELECT event_type, count(*) FILTER (value > 60)::BIGINT AS outliers,
    count(*) FILTER (value <= 60)::BIGINT AS inliers FROM events GROUP BY 1""")
def _(t: Tables):
    return t.events.groupBy("event_type").agg(F.count_if(F.col("value") > 60).alias("outliers"),
                                              F.count_if(F.col("value") <= 60).alias("inliers"))
