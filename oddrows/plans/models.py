"""Queries: seasonal ARMA models, unit roots with lag choice, score baselines."""

from __future__ import annotations

from pyspark.sql import functions as F

from oddrows.functions.lineage import written
from oddrows.operators import arma, baseline, itemsets, unitroot
from oddrows.plans.registry import H, R, Tables, least_squares_sql, query
from oddrows.plans.series import HOURLY_SQL, W, hourly

# ---------------------------------------------------------------- seasonal ARMA

OWN, SHOCKS, LONG = [1, 2, 12, 24], [1, 2, 12], 26
LEVELS = [("sp", ["d12", "d24"]), ("p", ["d1", "d2"]), ("sq", ["e12"]), ("q", ["e1", "e2"])]
SPLIT = "2024-01-21"


def shocks_sql(name: str, where: str) -> str:
    """CTEs ending in `<name>u`: hour, n, the differenced y0 and its lags and those of the innovations."""
    long = least_squares_sql(f"{name}l", f"SELECT * FROM {name}d WHERE x{LONG} IS NOT NULL", ["hour"], [f"x{k}" for k in range(1, LONG + 1)], "y")
    return f"""{name}h AS MATERIALIZED (SELECT hour, n FROM ({HOURLY_SQL}) WHERE {where}),
    {name}0 AS (SELECT hour, n, n - lag(n) OVER (ORDER BY hour) AS d FROM {name}h),
    {name}s AS MATERIALIZED (SELECT hour, n, d - lag(d, 12) OVER (ORDER BY hour) AS y FROM {name}0),
    {name}d AS MATERIALIZED (SELECT hour, y, {', '.join(f'lag(y, {k}) OVER (ORDER BY hour) AS x{k}' for k in range(1, LONG + 1))} FROM {name}s), {long},
    {name}u AS MATERIALIZED (SELECT s.hour, n, y AS y0, y, {', '.join(f'lag(y, {k}) OVER o AS d{k}' for k in OWN)},
        {', '.join(f'lag(rest, {k}) OVER o AS e{k}' for k in SHOCKS)} FROM {name}s s LEFT JOIN {name}l l ON l.hour = s.hour WINDOW o AS (ORDER BY s.hour))"""


def grid_sql(name: str) -> str:
    """CTEs ending in `<name>aic`: all 54 candidates. Their regressors are taken out one after the other, and candidates that
    begin alike share those steps."""
    columns = [c for _, cs in LEVELS for c in cs]
    centred = ", ".join(f"{c} - avg({c}) OVER () AS {c}" for c in [*columns, "y"])
    parts = [f"""{name}g AS MATERIALIZED (SELECT {centred} FROM {name}u WHERE {' AND '.join(f'{c} IS NOT NULL' for c in [*columns, 'y'])})"""]
    nodes = [(f"{name}g", {}, [])]
    for level, cs in LEVELS:
        rest = columns[columns.index(cs[-1]) + 1:]
        grown = []
        for table, orders, kept in nodes:
            grown.append((table, orders | {level: 0}, kept))
            for i, c in enumerate(cs):
                left = [*cs[i + 1:], *rest, "y"]
                slopes = ", ".join(f"sum({c} * {x}) / nullif(sum({c} * {c}), 0) AS b_{x}" for x in left)
                taken = ", ".join(f"{x} - coalesce(b_{x}, 0) * {c} AS {x}" for x in left)
                own = [f"coalesce(b_{x}, 0) AS s_{c}_{x}" for x in left] if c[0] == "e" else []  # slopes on an innovation are kept
                parts.append(f"{table}_{c} AS MATERIALIZED (SELECT {', '.join([taken, *own, *kept])} FROM {table}, (SELECT {slopes} FROM {table}))")
                table, kept = f"{table}_{c}", [*kept, *[f"s_{c}_{x}" for x in left if own]]
                grown.append((table, orders | {level: i + 1}, kept))
        nodes = grown
    def moving(kept: list[str]) -> str:
        """Sizes of the innovations' coefficients, from the last one back."""
        have, found = [e for e in ("e12", "e1", "e2") if f"s_{e}_y" in kept], {}
        for e in reversed(have):
            found[e] = f"(any_value(s_{e}_y)" + "".join(f" - any_value(s_{e}_{x}) * {found[x]}" for x in have[have.index(e) + 1:]) + ")"
        return " + ".join(f"abs({b})" for b in found.values()) or "0"

    rows = " UNION ALL ".join(
        f"SELECT {o['p']} AS p, {o['q']} AS q, {o['sp']} AS sp, {o['sq']} AS sq, sum(y * y) AS rss, count(*) AS n, "
        f"count(*) * ln(sum(y * y) / count(*)) + {2 * (sum(o.values()) + 1)} AS aic, {moving(kept)} AS moving FROM {t}" for t, o, kept in nodes)
    return ", ".join([*parts, f"{name}aic AS MATERIALIZED ({rows})"])


def fitted_sql(name: str) -> str:
    """CTEs ending in `<name>f`: hour, n and one-step predictions of the model that `best` names, fitted to `<name>u`. A
    coefficient is the slope on what the other regressors leave of its own; those not in the model are zero columns."""
    columns = [c for _, cs in LEVELS for c in cs]
    on = {c: f"({level} >= {i + 1})::INT" for level, cs in LEVELS for i, c in enumerate(cs)}
    whole = " AND ".join(f"{c} IS NOT NULL" for c in [*columns, "y"])
    parts = [f"""{name}m AS MATERIALIZED (SELECT hour, y, {', '.join(f'{c} * {on[c]} AS {c}' for c in columns)} FROM {name}u, best WHERE {whole})"""]
    for c in columns:
        others = [x for x in columns if x != c]
        parts.append(least_squares_sql(f"{name}b{c}", f"SELECT y AS y_, {c} AS own, {', '.join(others)} FROM {name}m", ["y_"], others, "own"))
    coefficients = ", ".join(f"(SELECT coalesce(sum(y_ * rest) / nullif(sum(rest * rest), 0), 0) FROM {name}b{c}) AS b_{c}" for c in columns)
    const = f"avg(y) - {' - '.join(f'any_value(b_{c}) * avg({c})' for c in columns)}"
    return ", ".join([*parts, f"""{name}k AS MATERIALIZED (SELECT {coefficients}),
    {name}c AS MATERIALIZED (SELECT {', '.join(f'any_value(b_{c}) AS b_{c}' for c in columns)}, {const} AS c0 FROM {name}m, {name}k),
    {name}z AS MATERIALIZED (SELECT * REPLACE (b_e1 * z AS b_e1, b_e2 * z AS b_e2, b_e12 * z AS b_e12) FROM (
        SELECT *, coalesce(least(1, 0.999::DOUBLE / nullif(abs(b_e1) + abs(b_e2) + abs(b_e12), 0)), 1) AS z FROM {name}c)),
    {name}t AS MATERIALIZED (SELECT row_number() OVER (ORDER BY hour) AS i, hour, n, y0 - c0 - {' - '.join(f'b_d{k} * d{k}' for k in OWN)} AS u, b_e1, b_e2, b_e12
        FROM {name}u, {name}z),
    {name}r(i, es) AS (SELECT 0::BIGINT, list_value({', '.join(['0.0::DOUBLE'] * 12)}) UNION ALL
        SELECT r.i + 1, list_prepend(CASE WHEN u IS NULL THEN 0.0 ELSE u - b_e1 * es[1] - b_e2 * es[2] - b_e12 * es[12] END, es[1:11])
        FROM {name}r r JOIN {name}t t ON t.i = r.i + 1),
    {name}f AS (SELECT hour, n, CASE WHEN u IS NULL THEN 0 ELSE n - es[1] END AS predict FROM {name}t t JOIN {name}r r ON r.i = t.i)"""])


TRAIN, VALID = f"hour < TIMESTAMP '{SPLIT}'", f"hour >= TIMESTAMP '{SPLIT}'"
BEST = "best AS MATERIALIZED (SELECT p, q, sp, sq FROM taic WHERE moving < 0.999 ORDER BY aic, p, q, sp, sq LIMIT 1)"


def halves(t: Tables):
    rows = hourly(t).select("hour", "n")
    early = F.col("hour") < F.expr(f"TIMESTAMP_NTZ '{SPLIT}'")
    return rows.filter(early), rows.filter(~early)


@query("seasonal_arma_table", f"""WITH {shocks_sql('t', TRAIN)}, {grid_sql('t')}
    SELECT p::INT AS p, q::INT AS q, sp::INT AS sp, sq::INT AS sq, {R('rss', 5)} AS rss, n::BIGINT AS n, {R('aic', 5)} AS aic,
    {R('moving', 5)} AS moving FROM taic""", digits=5)
def _(t: Tables):
    """All 54 seasonal candidates on the training hours."""
    return arma.arma_table(halves(t)[0], "n", "hour", hot_rows=None).select(*arma.ORDER, "rss", "n", "aic", "moving")


@query("seasonal_arma_predict", f"""WITH RECURSIVE {shocks_sql('t', TRAIN)}, {grid_sql('t')}, {BEST}, {fitted_sql('t')}, {shocks_sql('v', VALID)}, {fitted_sql('v')}
    SELECT part, strftime(hour, '%Y-%m-%d %H') AS hour, n, {R('predict', 4)} AS predict FROM (SELECT 'train' AS part, * FROM tf UNION ALL
    SELECT 'valid' AS part, * FROM vf)""", digits=4)
def _(t: Tables):
    """The best of the 54 candidates predicts the training hours, and refitted to the later ones it predicts those."""
    train, valid = halves(t)
    best = written(arma.arma_select(arma.arma_table(train, "n", "hour", hot_rows=None)))
    again = written(arma.arma_refit(valid, best, "n", "hour", hot_rows=None))
    out = arma.arma_predict(train, best, "n", "hour", hot_rows=None).withColumn("part", F.lit("train")).unionByName(
        arma.arma_predict(valid, again, "n", "hour", hot_rows=None).withColumn("part", F.lit("valid")))
    return out.select("part", F.date_format("hour", "yyyy-MM-dd HH").alias("hour"), "n", "predict")


# ---------------------------------------------------------------- unit root

TOP = 20
CURVE_SQL = """SELECT hour, sum(total) OVER (ORDER BY hour ROWS BETWEEN 5 PRECEDING AND CURRENT ROW) AS v FROM (SELECT * FROM hours)"""


def normal_sql(z: str) -> str:
    """Normal distribution function by its series around zero."""
    odd, terms = 1, []
    for n in range(60):
        odd *= 2 * n + 1
        terms.append(f"pow(z, {2 * n + 1}) / {float(odd)!r}::DOUBLE")
    return f"(SELECT 0.5 + exp(-z * z / 2) / sqrt(2 * pi()) * ({' + '.join(terms)}) FROM (SELECT {z} AS z))"


def unit_root_sql() -> str:
    ds = [f"d{k}" for k in range(1, TOP + 1)]
    xs = ["x", *ds]
    parts = [f"""hours AS MATERIALIZED ({HOURLY_SQL})""", f"""l AS MATERIALIZED (SELECT hour, v - lag(v) OVER o AS y, lag(v) OVER o AS x,
        {', '.join(f'lag(v, {k}) OVER o - lag(v, {k + 1}) OVER o AS d{k}' for k in range(1, TOP + 1))} FROM ({CURVE_SQL}) WINDOW o AS (ORDER BY hour))""",
             f"g AS MATERIALIZED (SELECT {', '.join(f'{c} - avg({c}) OVER () AS {c}' for c in [*xs, 'y'])} FROM l WHERE d{TOP} IS NOT NULL)"]
    table = "g"
    for i, c in enumerate(xs):
        left = [*xs[i + 1:], "y"]
        slopes = ", ".join(f"sum({c} * {v}) / nullif(sum({c} * {c}), 0) AS b_{v}" for v in left)
        parts.append(f"g{i} AS MATERIALIZED (SELECT {', '.join(f'{v} - coalesce(b_{v}, 0) * {c} AS {v}' for v in left)} FROM {table}, (SELECT {slopes} FROM {table}))")
        table = f"g{i}"
    aics = " UNION ALL ".join(f"SELECT {i} AS k, count(*) * ln(sum(y * y) / count(*)) + {2 * i} AS aic FROM g{i}" for i in range(TOP + 1))
    masked = ", ".join(f"CASE WHEN k >= {i + 1} THEN {d} ELSE 0 END AS {d}" for i, d in enumerate(ds))
    parts += [f"best AS MATERIALIZED (SELECT k FROM ({aics}) ORDER BY aic, k LIMIT 1)",
              f"m AS MATERIALIZED (SELECT hour, k, y, x, {masked} FROM l, best WHERE x IS NOT NULL AND (k = 0 OR [{', '.join(ds)}][k] IS NOT NULL))",
              least_squares_sql("ry", "SELECT * FROM m", ["hour"], ds, "y"), least_squares_sql("rx", "SELECT * FROM m", ["hour"], ds, "x")]
    return "WITH " + ", ".join(parts)


@query("unit_root_search", f"""{unit_root_sql()}, e AS (SELECT sum(a.rest * b.rest) / sum(b.rest * b.rest) AS gamma, sum(b.rest * b.rest) AS sxx,
        sum(a.rest * a.rest) AS syy, sum(a.rest * b.rest) AS sxy, count(*) AS n FROM ry a JOIN rx b USING (hour)),
    s AS (SELECT *, sqrt((syy - gamma * sxy) / (n - k - 2) / sxx) AS se FROM e, best),
    t AS (SELECT *, gamma / se AS t FROM s),
    z AS (SELECT *, CASE WHEN t <= {unitroot.T_STAR} THEN {' + '.join(f'{c} * pow(t, {i})' for i, c in enumerate(unitroot.SMALL_P))}
        ELSE {' + '.join(f'{c} * pow(t, {i})' for i, c in enumerate(unitroot.LARGE_P))} END AS q FROM t)
    SELECT k::INT AS used_lag, {R('gamma')} AS gamma, {R('se')} AS std_error, {R('t')} AS t_stat, {R(normal_sql('q'))} AS p_value, n::BIGINT AS n FROM z""")
def _(t: Tables):
    """Six-hour sums of the hourly totals: the lag count is chosen out of 0 to 20."""
    from pyspark.sql import Window
    rows = hourly(t).select("hour", F.sum("total").over(Window.orderBy("hour").rowsBetween(-5, 0)).alias("v"))  # a row per hour of the calendar
    return unitroot.unit_root_search(rows, "v", "hour", max_lag=TOP, hot_rows=None)


# ---------------------------------------------------------------- score baseline

FEATURES = ["lag_1", "lag_2", "lag_3", "recent_mean", "recent_std"]
WEIGHTS, PHASES = baseline.fourier_weights(len(FEATURES))
SCORED_SQL = f"""o AS (SELECT event_id, user_id, ts, abs(value - lag(value) OVER ({W})) AS score FROM events),
    f0 AS (SELECT event_id, ts, score, lag(score, 1) OVER ({W}) AS lag_1, lag(score, 2) OVER ({W}) AS lag_2, lag(score, 3) OVER ({W}) AS lag_3,
        count(score) OVER ({W} ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING) AS c, avg(score) OVER ({W} ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING) AS recent_mean,
        stddev_samp(score) OVER ({W} ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING) AS recent_std FROM o WHERE score IS NOT NULL),
    f AS MATERIALIZED (SELECT event_id, ts, score, {', '.join(FEATURES)}, {H("'0:' || event_id")} % 5 AS fold FROM f0 WHERE c = 5),
    tr AS MATERIALIZED (SELECT * FROM f WHERE ts < TIMESTAMP '2024-01-16'),
    sc AS MATERIALIZED (SELECT {', '.join(f'avg({c}) AS m_{c}, stddev_samp({c}) AS s_{c}' for c in FEATURES)} FROM tr)"""


def cosines_sql(name: str, source: str, gammas: str) -> str:
    """<name>: a row per event and gamma with z, its cosines and, at the end, its score."""
    x = ", ".join(f"({c} - m_{c}) / s_{c}" for c in FEATURES)
    w = "[" + ", ".join("[" + ", ".join(f"{v!r}::DOUBLE" for v in row) + "]" for row in WEIGHTS) + "]"
    b = "[" + ", ".join(f"{v!r}::DOUBLE" for v in PHASES) + "]"
    inner = " + ".join(f"r[{j + 1}] * x[{j + 1}]" for j in range(len(FEATURES)))
    return f"""{name} AS MATERIALIZED (SELECT event_id, fold, score, gamma, list_append(list_transform({w}, lambda r, i:
        sqrt(2.0::DOUBLE / {len(PHASES)}) * cos(({inner}) * sqrt(2 * gamma) + {b}[i])), score) AS z
        FROM (SELECT s.*, [{x}] AS x, gamma FROM {source} s, sc, {gammas} g(gamma)))"""


def ridge_sql(name: str, rows: str, settings: str) -> str:
    """<name>: the ridge fit `beta` (and means `mu`) of every row of `settings` (setting, gamma, fold, ridge) to the rows of its gamma outside
    its fold, by Gauss-Jordan elimination of the normal equations."""
    d = len(PHASES)
    return f"""{name}p AS MATERIALIZED (SELECT s.setting, s.ridge, z FROM {settings} s JOIN {rows} r ON r.gamma = s.gamma AND r.fold IS DISTINCT FROM s.fold),
    {name}l AS MATERIALIZED (SELECT setting, any_value(ridge) AS ridge, count(*) AS n, [{', '.join(f'avg(z[{i}])' for i in range(1, d + 2))}] AS mu FROM {name}p GROUP BY setting),
    {name}c AS MATERIALIZED (SELECT p.setting, list_transform(z, lambda v, i: v - mu[i]) AS c FROM {name}p p JOIN {name}l USING (setting)),
    {name}g AS MATERIALIZED (SELECT setting, i, [{', '.join(f'sum(c[i] * c[{j}])' for j in range(1, d + 2))}] AS row FROM {name}c, range(1, {d + 1}) t(i) GROUP BY setting, i),
    {name}m AS MATERIALIZED (SELECT setting, list(list_transform(row, lambda v, j: v + CASE WHEN j = i THEN ridge * n ELSE 0 END) ORDER BY i) AS m
        FROM {name}g JOIN {name}l USING (setting) GROUP BY setting),
    {name}e(setting, k, m) AS (SELECT setting, 1, m FROM {name}m UNION ALL
        SELECT setting, k + 1, list_transform(m, lambda r, i: CASE WHEN i = k THEN list_transform(r, lambda v: v / r[k])
            ELSE list_transform(r, lambda v, j: v - r[k] / m[k][k] * m[k][j]) END) FROM {name}e WHERE k <= {d}),
    {name} AS MATERIALIZED (SELECT setting, mu, list_transform(m, lambda r: r[{d + 1}]) AS beta FROM {name}e JOIN {name}l USING (setting) WHERE k = {d + 1})"""


NINE = ", ".join(f"({c}::DOUBLE, {g}::DOUBLE)" for c in baseline.STRENGTHS for g in baseline.GAMMAS)
GAMMAS_SQL = "(VALUES " + ", ".join(f"({g}::DOUBLE)" for g in baseline.GAMMAS) + ")"
FITTED_SQL = f"mu[{len(PHASES) + 1}] + list_sum(list_transform(beta, lambda b, i: b * (z[i] - mu[i])))"
TABLE_SQL = f"""WITH RECURSIVE {SCORED_SQL}, {cosines_sql('zt', 'tr', GAMMAS_SQL)},
    nine AS MATERIALIZED (SELECT row_number() OVER () AS setting, strength, gamma, f AS fold, {baseline.PENALTY}::DOUBLE / strength AS ridge
        FROM (VALUES {NINE}) v(strength, gamma), range(5) t(f)), {ridge_sql('cv', 'zt', 'nine')},
    judged AS MATERIALIZED (SELECT strength, s.gamma, avg(pow(score - ({FITTED_SQL}), 2)) AS mse FROM nine s JOIN cv USING (setting)
        JOIN zt ON zt.gamma = s.gamma AND zt.fold = s.fold GROUP BY 1, 2)"""


def nonlinear(t: Tables):
    out = t.events.select("event_id", "user_id", "ts", "value")
    from oddrows.operators.sequence import lag_matrix
    out = lag_matrix(out, "value", [1], "ts", "user_id").withColumn("score", F.abs(F.col("value") - F.col("value_lag_1"))).filter("score IS NOT NULL")
    rows, columns = baseline.recent_features(out, "score", "ts", "user_id")
    rows = written(rows.dropna(subset=columns))
    day = F.expr("TIMESTAMP_NTZ '2024-01-16'")
    return baseline.nonlinear_baseline(rows.filter(F.col("ts") < day), rows.filter(F.col("ts") >= day), "score", columns, "event_id")


@query("nonlinear_baseline_cv", f"""{TABLE_SQL} SELECT strength, gamma, {R('mse', 4)} AS mse FROM judged""", digits=4)
def _(t: Tables):
    """Nine settings of strength and kernel width by five folds."""
    return nonlinear(t)[0]


@query("nonlinear_baseline", f"""{TABLE_SQL}, top AS MATERIALIZED (SELECT 1 AS setting, strength, gamma, NULL::BIGINT AS fold, {baseline.PENALTY}::DOUBLE / strength AS ridge FROM judged
        ORDER BY mse, strength, gamma LIMIT 1), {ridge_sql('fin', 'zt', 'top')}, te AS (SELECT * FROM f WHERE ts >= TIMESTAMP '2024-01-16'),
    {cosines_sql('zv', 'te', '(SELECT gamma FROM top)')}, pr AS (SELECT event_id, score, {FITTED_SQL} AS p FROM zv, fin)
    SELECT event_id, {R('p', 4)} AS predicted_score, {R('score / nullif(p + 1, 0)', 4)} AS relative_score FROM pr""", digits=4)
def _(t: Tables):
    """Scores of the later half relative to what the best setting expects of them."""
    return nonlinear(t)[1].select("event_id", "predicted_score", "relative_score")


# ---------------------------------------------------------------- itemsets

BASKET_SQL = """b AS MATERIALIZED (SELECT DISTINCT user_id || '/' || ts::DATE AS basket, event_type || '@' || (hour(ts) // 8) AS item FROM events),
    t AS (SELECT count(DISTINCT basket) AS total FROM b), least AS (SELECT greatest(1, ceil(round(0.02::DOUBLE * total, 9))) AS least, total FROM t),
    s1 AS (SELECT [item] AS itemset, list(basket) AS held FROM b GROUP BY item),
    s2 AS (SELECT [a.item, b.item] AS itemset, list(a.basket) AS held FROM b a JOIN b ON a.basket = b.basket AND a.item < b.item GROUP BY 1),
    s3 AS (SELECT [a.item, b.item, c.item] AS itemset, list(a.basket) AS held FROM b a JOIN b ON a.basket = b.basket AND a.item < b.item
        JOIN b c ON c.basket = b.basket AND b.item < c.item GROUP BY 1),
    s AS MATERIALIZED (SELECT itemset, held, len(held) AS n, len(held) / total::DOUBLE AS support FROM (SELECT * FROM s1 UNION ALL SELECT * FROM s2 UNION ALL SELECT * FROM s3), least
        WHERE len(held) >= least)"""


def event_baskets(t: Tables):
    part = F.concat("event_type", F.lit("@"), F.floor(F.hour("ts") / 8).cast("string"))
    key = F.concat(F.col("user_id").cast("string"), F.lit("/"), F.to_date("ts").cast("string"))
    return itemsets.baskets(t.events.select(key.alias("basket"), part.alias("item")), ["basket"], F.col("item"))


@query("frequent_itemsets", f"""WITH {BASKET_SQL} SELECT array_to_string(itemset, '+') AS itemset, n::BIGINT AS n, {R('support')} AS support FROM s""")
def _(t: Tables):
    """Kinds of events by part of the day that a user shows on the same day."""
    return itemsets.frequent_itemsets(event_baskets(t), 0.02).select(F.concat_ws("+", "itemset").alias("itemset"), "n", "support")


@query("rare_itemset_outliers", f"""WITH {BASKET_SQL}, h AS (SELECT unnest(held) AS basket, support FROM s)
    SELECT basket, {R('1 - coalesce(sum(support), 0) / (SELECT sum(support) FROM s)')} AS score FROM (SELECT DISTINCT basket FROM b) LEFT JOIN h USING (basket) GROUP BY basket""")
def _(t: Tables):
    """Days of users that lack what other days have."""
    return itemsets.rare_itemset_outliers(event_baskets(t), "basket", min_support=0.02).select("basket", "score")
