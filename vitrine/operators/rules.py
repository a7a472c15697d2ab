"""Association rules between the categories of a basket."""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import np_round
from ..stages import stage

RULES_SCHEMA = (
    "antecedents array<string>, consequents array<string>, antecedent_support double, consequent_support double, "
    "support double, confidence double, lift double, leverage double, conviction double, zhangs_metric double"
)


def build_baskets(df: DataFrame, basket: str | None = None, item: str = "category", min_items: int = 2) -> DataFrame:
    """(basket_id, items): distinct non-null items per shop (else platform).

    Pairs are made distinct first, so a shop with a third of the rows is collapsed on the map
    side and its list is as long as its number of different items.
    """
    basket = basket or ("shop_name" if "shop_name" in df.columns else "source_platform")
    pairs = df.filter(F.col(basket).isNotNull() & F.col(item).isNotNull()).select(F.col(basket).alias("basket_id"), F.col(item).alias("item"))
    return (
        pairs.distinct()
        .groupBy("basket_id")
        .agg(F.array_sort(F.collect_list("item")).alias("items"))
        .filter(F.size("items") >= min_items)
    )


def adaptive_support(n_baskets: int) -> float:
    return max(0.3, 2 / n_baskets)


def frequent_itemsets(
    baskets: DataFrame, min_support: float | None = None, max_len: int | None = None, min_baskets: int = 3
) -> DataFrame:
    """(items, freq, n_baskets, support); min_support None means the adaptive rule.

    With ``max_len`` sets grow level by level and stop there, so longer sets are never made.
    Without it MLlib's parallel FP-growth only ships the frequent items of each basket to the
    partitions that own them. Too few baskets give an empty table.
    """
    baskets = stage(baskets.select("items"), "baskets")
    n = baskets.count()
    if n < max(1, min_baskets):
        return baskets.sparkSession.createDataFrame([], "items array<string>, freq bigint, n_baskets bigint, support double")
    wanted = adaptive_support(n) if min_support is None else min_support
    if max_len:
        found = _levelwise(baskets, n, wanted, max_len)
        return found.withColumns({"n_baskets": F.lit(n).cast("long"), "support": F.col("freq") / F.lit(n)})
    # FP-growth rounds its count threshold up; the small step back keeps exact multiples in.
    model = FPGrowth(itemsCol="items", minSupport=max(0.0, wanted - 1e-12), minConfidence=0.0).fit(baskets)
    found = model.freqItemsets.select(F.array_sort("items").alias("items"), "freq").withColumns(
        {"n_baskets": F.lit(n).cast("long"), "support": F.col("freq") / F.lit(n)}
    )
    return found.filter(F.col("support") >= wanted)


def _levelwise(baskets: DataFrame, n: int, support: float, max_len: int) -> DataFrame:
    """(items, freq) of frequent sets up to ``max_len`` items.

    A level holds (basket, set) rows of the frequent sets. Two sets of a basket that agree in all
    but the last item make the next candidate; counts are combined on the map side, and only rows
    of frequent sets go on, so a set is extended only if it is frequent itself.
    """
    numbered = stage(baskets.withColumn("basket", F.monotonically_increasing_id()), "numbered-baskets")
    rows = numbered.select("basket", F.explode(F.array_distinct("items")).alias("item")).select("basket", F.array().cast("array<string>").alias("head"), F.col("item").alias("tail"))
    result = None
    for size in range(1, max_len + 1):
        rows = stage(rows, "itemset-level")
        counts = rows.groupBy("head", "tail").agg(F.count("*").alias("freq"))
        frequent = stage(counts.filter(F.col("freq") / F.lit(n) >= support), "frequent-sets")
        sets = frequent.select(F.array_append("head", F.col("tail")).alias("items"), "freq")
        result = sets if result is None else result.unionByName(sets)
        if size == max_len or frequent.isEmpty():
            break
        rows = rows.join(frequent.select("head", "tail"), ["head", "tail"], "left_semi")
        other = rows.select("basket", "head", F.col("tail").alias("next"))
        rows = rows.join(other, ["basket", "head"]).filter("tail < next").select("basket", F.array_append("head", F.col("tail")).alias("head"), F.col("next").alias("tail"))
    return result


def _subset(items: Column, mask: Column, inside: bool) -> Column:
    """The items whose bit is set (or not set) in the mask."""
    return F.filter(items, lambda x, i: (F.getbit(mask, i) == 1) if inside else (F.getbit(mask, i) == 0))


def generate_rules(itemsets: DataFrame) -> DataFrame:
    """All antecedent/consequent splits of every itemset with their measures.

    The number of splits depends on the length of an itemset only; supports are looked up with
    two equi-joins on the sorted item list.
    """
    itemsets = stage(itemsets, "itemsets")
    known = itemsets.select("items", "support")
    one = F.lit(1).cast("long")
    # Masks are made in runs of 4096, each run a row of its own, so that no row holds 2^k of them.
    last = F.call_function("shiftleft", one, F.size("items")) - 2
    runs = F.sequence(F.lit(0).cast("long"), F.shiftright(last, 12))
    first = F.col("run") * 4096
    masks = F.sequence(F.greatest(one, first), F.least(last, first + 4095))
    split = (
        itemsets.filter(F.size("items") >= 2)
        .select("items", "support", F.explode(runs).alias("run"))
        .select("items", "support", F.explode(masks).alias("mask"))
        .select("support", _subset(F.col("items"), F.col("mask"), True).alias("antecedents"), _subset(F.col("items"), F.col("mask"), False).alias("consequents"))
    )
    joined = split.join(known.select(F.col("items").alias("antecedents"), F.col("support").alias("sa")), "antecedents").join(
        known.select(F.col("items").alias("consequents"), F.col("support").alias("sc")), "consequents"
    )
    s, sa, sc = F.col("support"), F.col("sa"), F.col("sc")
    confidence = s / sa
    leverage = s - sa * sc
    conviction = F.when(confidence >= 1, F.lit(float("inf"))).otherwise(F.try_divide(1 - sc, 1 - confidence))
    zhang = F.coalesce(F.try_divide(leverage, F.greatest(s * (1 - sa), sa * (sc - s))), F.lit(0.0))
    return joined.select(
        "antecedents", "consequents", sa.alias("antecedent_support"), sc.alias("consequent_support"), "support",
        confidence.alias("confidence"), (confidence / sc).alias("lift"), leverage.alias("leverage"),
        conviction.alias("conviction"), zhang.alias("zhangs_metric"),
    )


def filter_rules(rules: DataFrame, metric: str = "confidence", minimum: float = 0.5, top: int | None = None) -> DataFrame:
    """Rules at or above a minimum, best lift first, all of them or the first ``top``."""
    kept = rules.filter(np_round(F.col(metric), 12) >= minimum).orderBy(F.desc("lift"), F.desc("confidence"), "antecedents", "consequents")
    return kept.limit(top) if top else kept


# The three parameter sets in use.
MODES = {
    "main": dict(min_support=None, max_len=3, min_items=2, min_baskets=3, metric="confidence", minimum=0.5, top=None),
    "module": dict(min_support=0.1, max_len=None, min_items=2, min_baskets=3, metric="confidence", minimum=0.6, top=None),
    "ops": dict(min_support=0.01, max_len=None, min_items=1, min_baskets=1, metric="lift", minimum=1.0, top=100),
}


def mine_rules(df: DataFrame, mode: str = "main", basket: str | None = None, item: str = "category") -> DataFrame:
    m = MODES[mode]
    if item not in df.columns or not (basket or {"shop_name", "source_platform"} & set(df.columns)):
        return df.sparkSession.createDataFrame([], RULES_SCHEMA)
    baskets = build_baskets(df, basket, item, m["min_items"])
    itemsets = frequent_itemsets(baskets, m["min_support"], m["max_len"], m["min_baskets"])
    return filter_rules(generate_rules(itemsets), m["metric"], m["minimum"], m["top"])
