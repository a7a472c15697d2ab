"""The seven catalog tools over the published table. Every result is a bounded top-k or a
grouped summary, so plans are a pruned scan plus TakeOrdered or a partial aggregate."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import have, np_round, ordered
from . import arguments as args

FLOATING = ("float", "double")


@dataclass(frozen=True)
class Reply:
    """A tool's answer: a main frame and named side frames, or an error message."""

    ok: bool
    frame: DataFrame | None = None
    side: dict[str, DataFrame] = field(default_factory=dict)
    error: str | None = None
    details: tuple[str, ...] = ()


def _round_floats(df: DataFrame, digits: int) -> DataFrame:
    floats = [c for c, kind in df.dtypes if kind in FLOATING]
    return df.withColumns({c: np_round(F.col(c), digits) for c in floats}) if floats else df


def _best_first(df: DataFrame, column: str = "composite_score") -> DataFrame:
    ties = have(df, ["id"])
    best = [F.desc_nulls_last(column)] if column in df.columns else []
    return ordered(df, *best, *ties)


def _same_category(category: str) -> Column:
    return F.lower("category") == category.lower()


def _in_file_order(df: DataFrame) -> DataFrame:
    return ordered(df, *have(df, ["ingest_seq", "scraped_at", "id"]))


def top_products(catalog: DataFrame, a: args.TopProducts = args.TopProducts()) -> DataFrame:
    """The best-scored top products; their number is counted after the limit."""
    out = catalog
    if "is_top_product" in out.columns:
        out = out.filter("is_top_product = 1")
    if a.category and "category" in out.columns:
        out = out.filter(_same_category(a.category))
    if a.min_score is not None and "composite_score" in out.columns:
        out = out.filter(F.col("composite_score") >= a.min_score)
    shown = have(
        out,
        ["title", "price", "rating", "review_count", "composite_score", "cluster_label", "price_anomaly_flag", "category", "shop_name"],
    )
    return _round_floats(_best_first(out).limit(a.limit).select(*shown), 4)


def with_total(limited: DataFrame, name: str) -> DataFrame:
    """Add the number of rows of an already limited result (at most 200 rows, one window)."""
    return limited.withColumn(name, F.count("*").over(Window.partitionBy()))


def cluster_summary(catalog: DataFrame, a: args.ClusterSummary = args.ClusterSummary()) -> DataFrame:
    """Means per cluster and name (null keys kept), with three example titles on request."""
    means = have(catalog, ["price", "rating", "composite_score", "discount_score"])
    summary = catalog.groupBy("cluster", "cluster_label").agg(
        *[np_round(F.avg(c), 3).alias(c) for c in means], F.count("title").alias("n_products")
    )
    if not a.include_products:
        return summary
    order = have(catalog, ["ingest_seq", "scraped_at", "id"])
    first = catalog.withColumn("nth", F.row_number().over(Window.partitionBy("cluster").orderBy(*order))).filter("nth <= 3")
    examples = first.groupBy("cluster").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("nth", "title"))), lambda s: s["title"]).alias("examples")
    )
    return summary.join(F.broadcast(examples), "cluster", "left")


def _anomalous(catalog: DataFrame) -> Column:
    if "price_anomaly_flag" in catalog.columns:
        return F.col("price_anomaly_flag") == 1
    if "dbscan_cluster" in catalog.columns:
        return F.col("dbscan_cluster") == -1
    raise KeyError("no anomaly column")


def anomalies(catalog: DataFrame, a: args.Anomalies = args.Anomalies()) -> DataFrame:
    found = catalog.filter(_anomalous(catalog))
    shown = have(found, ["title", "price", "rating", "price_anomaly_score", "category", "shop_name"])
    return _round_floats(_in_file_order(found).limit(a.limit).select(*shown), 4)


def anomaly_totals(catalog: DataFrame) -> DataFrame:
    hits = F.count_if(_anomalous(catalog))
    rate = F.coalesce(F.try_divide(hits, F.count("*")) * 100, F.lit(0.0))
    return catalog.agg(hits.alias("total_anomalies"), np_round(rate, 2).alias("anomaly_rate_pct"))


def association_rules(rules: DataFrame, a: args.AssociationRules = args.AssociationRules()) -> DataFrame:
    text = [F.array_join(c, ", ").alias(c) if dict(rules.dtypes)[c].startswith("array") else F.col(c) for c in ("antecedents", "consequents")]
    kept = rules.filter(F.col("lift") >= a.min_lift).select(*text, "support", "confidence", "lift")
    return _round_floats(kept.orderBy(F.desc("lift"), F.desc("confidence"), "antecedents", "consequents").limit(a.limit), 4)


def catalog_totals(catalog: DataFrame) -> DataFrame:
    found = catalog.columns
    parts = [F.count("*").alias("total_products")]
    parts += [np_round(F.avg(c), 2).alias(f"avg_{c}") for c in ("price", "rating") if c in found]
    parts += [F.countDistinct(c).alias(n) for c, n in (("category", "n_categories"), ("shop_name", "n_shops")) if c in found]
    return catalog.agg(*parts)


def catalog_stats(catalog: DataFrame, a: args.CatalogStats = args.CatalogStats()) -> DataFrame:
    """First 20 keys in ascending order; null keys do not count."""
    key = a.group_by
    return (
        catalog.filter(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.count("title").alias("n_products"), np_round(F.avg("price"), 3).alias("avg_price"), np_round(F.avg("rating"), 3).alias("avg_rating"))
        .orderBy(key)
        .limit(20)
    )


def search_products(catalog: DataFrame, a: args.SearchProducts = args.SearchProducts()) -> DataFrame:
    """All given conditions must hold; ``query`` is a case-insensitive pattern on the title."""
    found = catalog.columns
    tests: list[Column] = []
    if a.query and "title" in found:
        tests.append(F.coalesce(F.col("title").rlike(f"(?iu){a.query}"), F.lit(False)))
    if a.category and "category" in found:
        tests.append(_same_category(a.category))
    if a.min_price is not None and "price" in found:
        tests.append(F.col("price") >= a.min_price)
    if a.max_price is not None and "price" in found:
        tests.append(F.col("price") <= a.max_price)
    if a.min_rating is not None and "rating" in found:
        tests.append(F.col("rating") >= a.min_rating)
    if a.in_stock_only and "stock" in found:
        tests.append(F.col("stock") > 0)
    elif a.in_stock_only and "is_in_stock" in found:
        tests.append(F.col("is_in_stock"))
    out = catalog
    for test in tests:
        out = out.filter(test)
    shown = have(out, ["title", "price", "rating", "composite_score", "cluster_label", "shop_name"])
    return _round_floats(_best_first(out).limit(a.limit).select(*shown), 4)


def shop_ranking(catalog: DataFrame, a: args.ShopRanking = args.ShopRanking()) -> DataFrame:
    means = have(catalog, ["composite_score", "rating", "price"])
    shops = (
        catalog.filter(F.col("shop_name").isNotNull())
        .groupBy("shop_name")
        .agg(F.count("title").alias("n_products"), *[np_round(F.avg(c), 3).alias(c) for c in means])
    )
    by = a.sort_by if a.sort_by in shops.columns else "n_products"
    return shops.orderBy(F.desc_nulls_last(by), "shop_name").limit(a.limit)


TOOLS = {
    "get_top_products": args.TopProducts,
    "get_cluster_summary": args.ClusterSummary,
    "get_anomalies": args.Anomalies,
    "get_association_rules": args.AssociationRules,
    "get_catalog_stats": args.CatalogStats,
    "search_products": args.SearchProducts,
    "get_shop_ranking": args.ShopRanking,
}


def _answer(name: str, a, catalog: DataFrame | None, rules: DataFrame | None) -> Reply:
    if name == "get_association_rules":
        if rules is None or rules.isEmpty():
            return Reply(False, error="no association rules")
        return Reply(True, association_rules(rules, a))
    if catalog is None or catalog.isEmpty():
        return Reply(False, error="no published catalog")
    if name == "get_top_products":
        return Reply(True, top_products(catalog, a))
    if name == "get_cluster_summary":
        if "cluster" not in catalog.columns:
            return Reply(False, error="the catalog has no clusters")
        return Reply(True, cluster_summary(catalog, a))
    if name == "get_anomalies":
        return Reply(True, anomalies(catalog, a), {"totals": anomaly_totals(catalog)})
    if name == "get_catalog_stats":
        if a.group_by not in catalog.columns:
            return Reply(True, None, {"global": catalog_totals(catalog)})
        return Reply(True, catalog_stats(catalog, a), {"global": catalog_totals(catalog)})
    if name == "search_products":
        return Reply(True, search_products(catalog, a))
    if "shop_name" not in catalog.columns:
        return Reply(False, error="the catalog has no shops")
    return Reply(True, shop_ranking(catalog, a))


def call_tool(name: str, values: dict | None, catalog: DataFrame | None, rules: DataFrame | None = None) -> Reply:
    """Check the arguments and build the plan; problems come back as a value, never raised."""
    if name not in TOOLS:
        return Reply(False, error=f"unknown tool: {name}")
    try:
        return _answer(name, TOOLS[name].read(values), catalog, rules)
    except args.BadArguments as bad:
        return Reply(False, error="invalid arguments", details=tuple(bad.problems))
    except (KeyError, PySparkException) as problem:
        return Reply(False, error=str(problem))
