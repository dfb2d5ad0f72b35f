"""Frequent itemsets counted level by level, and rows that lack what most rows hold.

A basket is a row with an array of items. Baskets are never joined with each other or pivoted: an occurrence of a set is carried
along with its basket and grown by the basket's later items, as far as the grown set is a candidate. Candidates
of a level are joined from frequent sets of the level below and pruned if one of their parts is not frequent."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oddrows.functions.lineage import written
from oddrows.functions.sizes import broadcast_if_small


def baskets(df: DataFrame, by: list[str], item) -> DataFrame:
    """One row per group with `items`, the sorted distinct items of its rows (at most the number of different items)."""
    return df.groupBy(*by).agg(F.array_sort(F.collect_set(item)).alias("items"))


def _candidates(frequent: DataFrame, level: int) -> DataFrame:
    """prefix (a frequent set), item: sets of the next level (3 or more) all of whose parts are frequent."""
    start = lambda c: F.slice(c, 1, level - 2)
    a = frequent.select(start("itemset").alias("begin"), F.col("itemset").alias("prefix"))
    b = frequent.select(start("itemset").alias("begin"), F.element_at("itemset", -1).alias("item"))
    grown = a.join(b, "begin").filter(F.col("item") > F.element_at("prefix", -1)).select("prefix", "item")
    # every part without one item of the prefix has to be frequent as well
    whole = grown.withColumn("itemset", F.concat("prefix", F.array("item")))
    parts = whole.select("prefix", "item", F.posexplode("prefix").alias("at", "_")).select(
        "prefix", "item", F.concat(F.slice("prefix", F.lit(1), F.col("at")), F.slice("prefix", F.col("at") + 2, F.lit(level)), F.array("item")).alias("itemset"))
    met = parts.join(frequent.select("itemset"), "itemset").groupBy("prefix", "item").count()
    return met.filter(F.col("count") == level - 1).select("prefix", "item")


def frequent_itemsets(rows: DataFrame, min_support: float, items: str = "items", longest: int = 3) -> DataFrame:
    """itemset (sorted), n, support of the sets of up to `longest` items held by at least `min_support` of the baskets."""
    return _levels(rows.select(F.array_sort(F.array_distinct(F.array_compact(items))).alias("items")), min_support, longest)[0]


def _levels(rows: DataFrame, min_support: float, longest: int) -> tuple[DataFrame, list[DataFrame]]:
    """The frequent sets, and per level the occurrences (columns of rows, itemset) of that level's frequent sets."""
    total = rows.count()
    least = max(1, math.ceil(round(min_support * total, 9)))
    carry = rows.columns

    def counted(found: DataFrame) -> DataFrame:
        sets = found.groupBy("itemset").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= least)
        return written(sets.withColumn("support", F.col("n") / float(max(total, 1))))

    found = rows.select(*carry, F.posexplode("items").alias("at", "item")).select(*carry, "at", F.array("item").alias("itemset"))
    frequent = counted(found)
    singles = frequent.select(F.element_at("itemset", 1).alias("item"))
    every, occurrences = frequent, []
    for level in range(2, longest + 2):
        held = found.join(broadcast_if_small(frequent.select("itemset")), "itemset")
        occurrences.append(held.select(*carry, "itemset"))
        if level > longest or frequent.isEmpty():
            break
        # two frequent items are a candidate; longer ones have to be formed
        wanted = singles if level == 2 else written(_candidates(frequent, level))
        later = held.select(*carry, F.col("itemset").alias("prefix"), "at", F.posexplode("items").alias("to", "item")).filter("to > at")
        found = later.join(broadcast_if_small(wanted), wanted.columns).select(*carry, F.col("to").alias("at"), F.concat("prefix", F.array("item")).alias("itemset"))
        frequent = counted(found)
        every = every.unionByName(frequent)
    return every, occurrences


def rare_itemset_outliers(df: DataFrame, key: str, items: str = "items", min_support: float = 0.3, longest: int = 3) -> DataFrame:
    """Add `score`: the share, weighted by support, of the frequent sets that a basket does not hold (0 to 1; null if no set is frequent).

    `key` is unique. Null items are no items; an empty or null basket lacks everything."""
    sets = F.array_sort(F.array_distinct(F.array_compact(F.coalesce(items, F.array().cast(df.schema[items].dataType)))))
    rows = df.select(F.col(key).alias("_key"), sets.alias("items"))
    every, occurrences = _levels(rows, min_support, longest)
    support = broadcast_if_small(every.select("itemset", "support"))
    held = None
    for level in occurrences:  # a partial sum per level before they meet
        part = level.join(support, "itemset").groupBy("_key").agg(F.sum("support").alias("held"))
        held = part if held is None else held.unionByName(part)
    held = held.groupBy("_key").agg(F.sum("held").alias("_held"))
    total = every.agg(F.sum("support")).scalar()
    out = df.join(held, df[key].eqNullSafe(held["_key"]), "left")
    return out.withColumn("score", 1 - F.coalesce("_held", F.lit(0.0)) / total).drop("_key", "_held")
