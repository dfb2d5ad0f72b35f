"""Detector evaluation on (score, label) tables and forecast errors."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from oddrows.functions.columns import names, scalar
from oddrows.functions.lineage import written
from oddrows.functions.ordering import HOT_ROWS, prefix_sums, with_position
from oddrows.functions.quantiles import quantiles
from oddrows.functions.sizes import with_params
from oddrows.operators.stats import describe, equal_width_histogram


def confusion_matrix(df: DataFrame, predicted: str, label: str, by=None) -> DataFrame:
    p, y = F.col(predicted) == 1, F.col(label) == 1
    return df.groupBy(*names(by)).agg(
        F.count_if(p & y).alias("tp"), F.count_if(p & ~y).alias("fp"),
        F.count_if(~p & y).alias("fn"), F.count_if(~p & ~y).alias("tn"))


def precision_recall_f1(df: DataFrame, predicted: str, label: str, by=None) -> DataFrame:
    """Accuracy, precision, recall and F1; ratios without a denominator are null."""
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return confusion_matrix(df, predicted, label, by).withColumns({
        "accuracy": F.try_divide(tp + tn, tp + fp + fn + tn),
        "precision": F.try_divide(tp, tp + fp), "recall": F.try_divide(tp, tp + fn),
        "f1": F.try_divide(2 * tp, 2 * tp + fp + fn)})


def threshold_counts(df: DataFrame, score: str, label: str, hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """Per distinct score, from the top: positives and negatives at it (`pos`, `neg`) and at or
    above it (`tp`, `fp`), and the totals. Rows are combined per score before any ordering."""
    y = F.col(label) == 1
    per = written(df.filter(F.col(score).isNotNull()).groupBy(F.col(score).alias("threshold")).agg(
        F.count_if(y).alias("pos"), F.count_if(~y).alias("neg")))  # the rows are scanned once
    cum = prefix_sums(per, [F.desc("threshold")], {"tp": F.col("pos"), "fp": F.col("neg")}, hot_rows=hot_rows)
    totals = per.agg(F.sum("pos").alias("p"), F.sum("neg").alias("n"))
    return cum.withColumn("_t", scalar(totals)).select(
        "threshold", "pos", "neg", "tp", "fp", F.col("_t.p").alias("p"), F.col("_t.n").alias("n"))


def roc_curve(df: DataFrame, score: str, label: str, hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """False and true positive rate at every distinct score (the origin is not listed)."""
    return threshold_counts(df, score, label, hot_rows).select(
        "threshold", F.try_divide("fp", "n").alias("fpr"), F.try_divide("tp", "p").alias("tpr"))


def roc_auc(df: DataFrame, score: str, label: str, hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """Trapezoid area under the ROC curve, summed per distinct score."""
    t = threshold_counts(df, score, label, hot_rows)
    strip = F.col("neg") * (F.col("tp") - F.col("pos") / 2.0)
    return t.agg(F.try_divide(F.sum(strip), F.max("p").cast("double") * F.max("n")).alias("auc"))


def pr_curve(df: DataFrame, score: str, label: str, hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """Precision and recall of `score >= threshold` at every distinct score."""
    return threshold_counts(df, score, label, hot_rows).select(
        "threshold", F.try_divide(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"),
        F.try_divide("tp", "p").alias("recall"))


def metric_by_threshold(df: DataFrame, score: str, label: str, hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """Long form of the precision-recall curve: `threshold, metric, value`."""
    return pr_curve(df, score, label, hot_rows).select("threshold", F.inline(F.array(*[
        F.struct(F.lit(m).alias("metric"), F.col(m).alias("value")) for m in ("precision", "recall")])))


def fbeta_sweep(
    df: DataFrame, score: str, label: str, thresholds: int = 1000, beta: float = 1.0, start: float = 1.0,
    spacing: str = "equal",
) -> DataFrame:
    """Precision, recall and F-beta of `score > t` for thresholds from `start` to the largest
    score. Each score finds its slot by arithmetic, so the sweep costs one aggregate over the
    rows and a window over `thresholds` + 1 counts, not rows x thresholds."""
    last = thresholds - 1
    s, y = F.col(score), F.col(label) == 1
    top = df.agg(F.max(score).cast("double")).scalar()

    def at(j: Column, high: Column) -> Column:
        part = j / F.lit(float(max(last, 1)))
        if spacing == "log":
            inner = F.exp(F.log(F.lit(start)) + (F.log(high) - F.log(F.lit(start))) * part)
        else:
            inner = F.lit(start) + (high - F.lit(start)) * part
        return F.when((j == last) & (j > 0), high).otherwise(inner)  # the last one is the largest score itself

    seen = df.filter(s.isNotNull()).select(s.cast("double").alias("s"), y.alias("y")).withColumn("hi", top)
    if spacing == "log":
        place = F.try_divide(F.log(F.greatest("s", F.lit(start))) - F.log(F.lit(start)),
                             F.log("hi") - F.log(F.lit(start)))
    else:
        place = F.try_divide(F.col("s") - F.lit(start), F.col("hi") - F.lit(start))
    j = F.least(F.greatest(F.floor(F.coalesce(place, F.lit(0.0)) * last), F.lit(-1)), F.lit(last))
    seen = seen.withColumn("j", j.cast("int"))
    below = lambda k: (k >= 0) & (k <= last) & (at(k, F.col("hi")) < F.col("s"))
    # thresholds below s: the arithmetic slot, checked against its neighbours
    above = (F.when(below(F.col("j") + 1), F.col("j") + 2).when(below(F.col("j")), F.col("j") + 1)
             .when(below(F.col("j") - 1), F.col("j")).otherwise(F.greatest(F.col("j") - 1, F.lit(0))))
    # a largest score below `start` makes the thresholds fall to it: no score exceeds any of them
    above = F.when(F.col("hi") < F.lit(start), 0).otherwise(above)
    slots = seen.groupBy(above.alias("slot")).agg(F.count_if("y").alias("pos"), F.count_if(~F.col("y")).alias("neg"))
    frame = df.sparkSession.range(thresholds).select(F.col("id").cast("int").alias("slot0"))
    joined = frame.join(slots, F.col("slot0") + 1 == F.col("slot"), "left").na.fill(0, ["pos", "neg"])
    down = Window.orderBy(F.desc("slot0")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    p = df.filter(s.isNotNull()).agg(F.count_if(y)).scalar()
    tp, fp = F.sum("pos").over(down), F.sum("neg").over(down)
    out = joined.select(F.col("slot0").alias("step"), tp.alias("tp"), fp.alias("fp"), p.alias("p"),
                        at(F.col("slot0"), top).alias("threshold"))
    b2 = beta * beta
    return out.select(
        "step", "threshold", F.try_divide("tp", F.col("tp") + F.col("fp")).alias("precision"),
        F.try_divide("tp", "p").alias("recall"),
        F.try_divide((1 + b2) * F.col("tp"), b2 * F.col("p") + F.col("tp") + F.col("fp")).alias("fbeta"))


def precision_at_n(df: DataFrame, score: str, label: str) -> DataFrame:
    """Precision among the rows above the (1 - share of true outliers) quantile of the score."""
    y = F.col(label) == 1
    head = df.agg(F.count_if(y).alias("p"), F.count(F.lit(1)).alias("n")).first()  # one row
    if not head["n"]:
        return df.agg(F.count_if(y).alias("n"), F.lit(None).cast("double").alias("precision_at_n"))
    limit = quantiles(df, score, [1.0 - head["p"] / head["n"]]).select("value").scalar()
    hit = F.col(score) > limit
    return df.agg(F.lit(head["p"]).alias("n"), F.try_divide(F.count_if(hit & y), F.count_if(hit)).alias("precision_at_n"))


def regression_errors(df: DataFrame, truth: str, predicted: str, by=None) -> DataFrame:
    """corr, mae, mse, rae, rmse, rrse, mape and r2 (not below 0) of a forecast."""
    groups = names(by)
    t, p = F.col(truth).cast("double"), F.col(predicted).cast("double")
    used = df.filter(t.isNotNull() & p.isNotNull())
    if groups:
        used = with_params(used, used.groupBy(*groups).agg(F.avg(t).alias("_m")), groups)
    else:
        used = used.withColumn("_m", used.agg(F.avg(t)).scalar())
    e, c = p - t, t - F.col("_m")
    sums = used.groupBy(*groups).agg(
        F.try_divide(F.covar_pop(p, t), F.stddev_pop(p) * F.stddev_pop(t)).alias("corr"), F.avg(F.abs(e)).alias("mae"), F.avg(e * e).alias("mse"),
        F.sum(F.abs(e)).alias("_ae"), F.sum(F.abs(c)).alias("_ac"), F.sum(e * e).alias("_ee"),
        F.sum(c * c).alias("_cc"), (F.avg(F.abs(F.try_divide(e, t))) * 100).alias("mape"))
    share = F.try_divide("_ee", "_cc")
    return sums.select(
        *groups, "corr", "mae", "mse", F.try_divide("_ae", "_ac").alias("rae"), F.sqrt("mse").alias("rmse"),
        F.sqrt(share).alias("rrse"), "mape", F.greatest(F.lit(0.0), 1 - share).alias("r2"))


def regression_errors_filtered(df: DataFrame, truth: str, predicted: str, keep: Column, by=None) -> DataFrame:
    """The same on the rows of a mask: corr, mae, mse, rae, rmse, r2."""
    return regression_errors(df.filter(keep), truth, predicted, by).select(
        *names(by), "corr", "mae", "mse", "rae", "rmse", "r2")


def error_by_class(df: DataFrame, error: str, label: str) -> DataFrame:
    """Summary of the error per class."""
    return describe(df, error, label).drop("column")


def error_histogram_by_class(df: DataFrame, error: str, label: str, bins: int, upper: float | None = None) -> DataFrame:
    return equal_width_histogram(df, error, bins, label, upper)


def threshold_hit_rate(df: DataFrame, score: str, label: str, threshold: float, key: str) -> DataFrame:
    """Share of normal rows at or below the threshold and of abnormal rows above it; of the
    abnormal rows the first (by key) as many as there are normal ones are used."""
    normal, abnormal = df.filter(F.col(label) == 0), df.filter(F.col(label) == 1)
    n = normal.count()
    chosen = abnormal
    if abnormal.count() > n:
        chosen = with_position(abnormal, [key], name="_p").filter(F.col("_p") < n)
    ok = normal.agg(F.lit("normal").alias("part"), F.count_if(F.col(score) <= threshold).alias("hits"),
                    F.count(F.lit(1)).alias("rows"))
    bad = chosen.agg(F.lit("abnormal").alias("part"), F.count_if(F.col(score) > threshold).alias("hits"),
                     F.count(F.lit(1)).alias("rows"))
    return ok.unionByName(bad).withColumn("rate", F.try_divide("hits", "rows"))


def horizon_error_profile(df: DataFrame, truth: str, predictions: Sequence[str], scale: Column | float = 1.0) -> DataFrame:
    """Mean absolute error over the horizons of a row, in units of the data."""
    terms = [F.abs(F.col(p) - F.col(truth)) for p in predictions]
    factor = scale if isinstance(scale, Column) else F.lit(float(scale))
    return df.withColumn("error_profile", sum(terms, F.lit(0.0)) / len(terms) * factor)


def loss_history_best(history: DataFrame, loss: str = "loss", step: str = "step", by=None) -> DataFrame:
    """Step with the lowest loss of an iterative fit, and that loss."""
    return history.groupBy(*names(by)).agg(
        F.count(F.lit(1)).alias("steps"), F.min_by(step, F.struct(loss, step)).alias("best_step"),
        F.min(loss).alias("best_loss"))
