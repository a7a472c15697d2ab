"""Data feeds of the dashboard pages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.quantiles import exact_quantiles
from ..functions.scalars import have, np_round, ordered
from ..operators.segment import number_or_zero
from ..stages import stage


def filter_catalog(
    catalog: DataFrame,
    categories: Sequence[str] = (),
    shops: Sequence[str] = (),
    platforms: Sequence[str] = (),
    price_range: tuple[float, float] | None = None,
    in_stock: bool = False,
) -> DataFrame:
    """Sidebar filter; an empty choice means no restriction."""
    out = catalog
    for column, chosen in (("category", categories), ("shop_name", shops), ("source_platform", platforms)):
        if chosen and column in out.columns:
            out = out.filter(F.col(column).isin(list(chosen)))
    if price_range is not None:
        out = out.filter(F.col("price").try_cast("double").between(*map(float, price_range)))
    if in_stock and "is_in_stock" in out.columns:
        out = out.filter("is_in_stock")
    elif in_stock and "stock" in out.columns:
        out = out.filter(number_or_zero("stock") > 0)
    return out


def filter_values(catalog: DataFrame, column: str, first: int | None = None) -> DataFrame:
    """Sorted distinct values of a filter column, the first few only for shops."""
    values = catalog.filter(F.col(column).isNotNull()).select(F.col(column).alias("value")).distinct().orderBy("value")
    return values.limit(first) if first else values


def price_bounds(catalog: DataFrame) -> DataFrame:
    """Slider ends; one single price is widened by 1 on both sides, no price gives 0..1000."""
    price = F.col("price").try_cast("double")
    ends = catalog.agg(F.min(price).alias("lo"), F.max(price).alias("hi"))
    flat = F.col("lo") >= F.col("hi")
    return ends.select(
        F.when(F.col("lo").isNull(), 0.0).when(flat, F.greatest(F.col("lo") - 1, F.lit(0.0))).otherwise(F.col("lo")).alias("min_price"),
        F.when(F.col("hi").isNull(), 1000.0).when(flat, F.col("hi") + 1).otherwise(F.col("hi")).alias("max_price"),
    )


def kpi_row(catalog: DataFrame) -> DataFrame:
    found = catalog.columns
    seller = next((c for c in ("shop_name", "source_platform") if c in found), None)
    return catalog.agg(
        F.count("*").alias("n_products"),
        np_round(F.avg("price"), 2).alias("avg_price"),
        (np_round(F.avg("rating"), 2) if "rating" in found else F.lit(None).cast("double")).alias("avg_rating"),
        (F.coalesce(F.sum("is_top_product"), F.lit(0)) if "is_top_product" in found else F.lit(0)).cast("long").alias("n_top"),
        (F.countDistinct(seller) if seller else F.lit(0).cast("long")).alias("n_shops"),
        (F.coalesce(F.sum("review_count"), F.lit(0)) if "review_count" in found else F.lit(0)).cast("long").alias("total_reviews"),
    )


def category_top(catalog: DataFrame, n: int = 10) -> DataFrame:
    return (
        catalog.filter(F.col("category").isNotNull())
        .groupBy("category")
        .agg(F.count("*").alias("n_products"))
        .orderBy(F.desc("n_products"), "category")
        .limit(n)
    )


def price_boxes(catalog: DataFrame) -> DataFrame:
    """Box statistics of the five largest categories; only their prices are ranked."""
    five = category_top(catalog, 5).select("category")
    prices = stage(catalog.select("category", "price").join(F.broadcast(five), "category", "left_semi"), "box-prices")
    ends = prices.groupBy("category").agg(F.min("price").alias("low"), F.max("price").alias("high"))
    quartiles = exact_quantiles(prices, {"price": "price"}, [0.25, 0.5, 0.75], by=["category"])
    wide = quartiles.groupBy("category").agg(
        *[F.max(F.when(F.col("prob") == p, F.col("value"))).alias(n) for p, n in ((0.25, "q1"), (0.5, "median"), (0.75, "q3"))]
    )
    return ends.join(wide, "category")


def insights_row(catalog: DataFrame) -> DataFrame:
    found = catalog.columns
    top = F.col("is_top_product") == 1 if "is_top_product" in found else F.lit(False)
    noise = F.col("dbscan_cluster") == -1 if "dbscan_cluster" in found else F.lit(False)
    stocked = F.col("is_in_stock_flag") == 1 if "is_in_stock_flag" in found else F.lit(False)

    def percent(test: Column) -> Column:
        return F.try_divide(F.count_if(test), F.count("*")) * 100

    return catalog.agg(
        F.count_if(top).alias("n_top"),
        np_round(percent(top), 1).alias("top_pct"),
        F.count_if(noise).alias("n_noise"),
        np_round(percent(noise), 1).alias("noise_pct"),
        np_round(percent(stocked), 0).alias("in_stock_pct"),
        np_round(F.coalesce(F.avg(F.when(top, F.col("price"))), F.lit(0.0)), 2).alias("avg_top_price"),
    )


def top_k(catalog: DataFrame, k: int, column: str = "composite_score") -> DataFrame:
    """The k largest; ties by id. A TakeOrdered, so only k rows per task travel."""
    return catalog.orderBy(F.desc_nulls_last(column), *have(catalog, ["id"])).limit(k)


def topk_table(top: DataFrame, categories: Sequence[str] = ()) -> DataFrame:
    shown = have(top, ["title", "price", "rating", "review_count", "composite_score", "category", "shop_name", "source_platform"])
    out = filter_catalog(top, categories=categories)
    out = out.orderBy(F.desc_nulls_last("composite_score"), *have(out, ["id"])) if "composite_score" in shown else out
    out = out.select(*shown)
    return out.withColumn("composite_score", np_round(F.col("composite_score"), 3)) if "composite_score" in shown else out


def group_summary(catalog: DataFrame, key: str) -> DataFrame:
    """Shop or platform summary: rows and means, best score first."""

    def mean(column: str, name: str) -> Column:
        return (np_round(F.avg(column), 3) if column in catalog.columns else F.count("price").cast("double")).alias(name)

    return (
        catalog.filter(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.count("title").alias("n_products"), mean("composite_score", "avg_score"), mean("price", "avg_price"), mean("rating", "avg_rating"))
        .orderBy(F.desc_nulls_last("avg_score"), key)
    )


def cluster_profile(catalog: DataFrame) -> DataFrame:
    key = "cluster_label" if "cluster_label" in catalog.columns else "cluster"
    means = have(catalog, ["price", "rating", "composite_score", "discount_score", "stock"])
    return (
        catalog.filter(F.col(key).isNotNull())
        .groupBy(key)
        .agg(*[np_round(F.avg(c), 3).alias(c) for c in means], F.count("title").alias("n_products"))
    )


def _flagged(df: DataFrame, *choices: tuple[str, int]) -> Column:
    """First available column equal to its marker."""
    for column, marker in choices:
        if column in df.columns:
            return number_or_zero(column).cast("int") == marker
    return F.lit(False)


def detector(df: DataFrame) -> Column:
    by_density = _flagged(df, ("dbscan_outlier", 1), ("dbscan_cluster", -1))
    by_isolation = _flagged(df, ("iforest_outlier", 1), ("price_anomaly_flag", 1))
    return (
        F.when(by_density & by_isolation, "DBSCAN + Isolation Forest")
        .when(by_density, "DBSCAN")
        .when(by_isolation, "Isolation Forest")
        .otherwise("Aucun")
    )


def anomaly_table(df: DataFrame) -> DataFrame:
    """Suspect rows, highest anomaly score first, with the detector that found them."""
    if "is_anomaly" in df.columns:
        suspect = _flagged(df, ("is_anomaly", 1))
    else:
        suspect = _flagged(df, ("dbscan_outlier", 1)) | _flagged(df, ("iforest_outlier", 1))
    shown = have(
        df,
        [
            "title", "price", "rating", "review_count", "cluster_label", "dbscan_outlier", "iforest_outlier",
            "price_anomaly_score", "is_anomaly", "shop_name", "source_platform",
        ],
    )
    out = df.withColumn("detector_model", detector(df)).filter(suspect)
    order = [F.desc_nulls_last("price_anomaly_score")] if "price_anomaly_score" in df.columns else []
    return ordered(out, *order, *have(df, ["id"])).select(*shown, "detector_model")


def anomaly_rate(df: DataFrame) -> DataFrame:
    hits = F.count_if(_flagged(df, ("is_anomaly", 1)))
    return df.agg(hits.alias("suspects"), np_round(F.try_divide(hits, F.count("*")) * 100, 1).alias("rate_pct"))


def density_outliers(df: DataFrame) -> DataFrame:
    return df.filter("dbscan_cluster = -1").select("title", "price", "rating", "review_count", "source_platform")


def rules_overview(rules: DataFrame) -> DataFrame:
    return rules.agg(
        F.count("*").alias("n_rules"), np_round(F.max("lift"), 4).alias("max_lift"), np_round(F.avg("confidence"), 4).alias("avg_confidence")
    )


def top_rules(rules: DataFrame, n: int = 30) -> DataFrame:
    """The ``n`` rules of greatest lift; equal ones by confidence, then by their sides."""
    return rules.select("antecedents", "consequents", "support", "confidence", "lift").orderBy(
        F.desc("lift"), F.desc("confidence"), "antecedents", "consequents"
    ).limit(n)


def scatter_feed(df: DataFrame) -> DataFrame:
    """Points of the projection plot with filled defaults."""
    found = df.columns
    if "cluster_label" in found:
        label = F.coalesce(F.col("cluster_label"), F.lit("Inconnu"))
    elif "cluster" in found:
        label = F.concat(F.lit("Cluster "), F.col("cluster").cast("string"))
    else:
        label = F.lit("Inconnu")

    def number(name: str, kind: str = "double") -> Column:
        value = F.coalesce(F.col(name).try_cast(kind), F.lit(0).cast(kind)) if name in found else F.lit(0).cast(kind)
        return value.alias(name)

    return df.select(
        *have(df, ["id", "PC1", "PC2"]),
        label.alias("cluster_label"),
        (F.coalesce("title", F.lit("")) if "title" in found else F.lit("")).alias("title"),
        number("price"),
        number("review_count"),
        number("price_anomaly_score"),
        number("is_anomaly", "int"),
        detector(df).alias("detector_model"),
    )


# Columns of the two published projections.
PROJECTION_WIDE = [
    "PC1", "PC2", "pca_variance_explained", "cluster", "cluster_label", "dbscan_outlier", "iforest_outlier", "is_anomaly",
    "price_anomaly_flag", "price_anomaly_score", "title", "category", "shop_name", "is_top_product", "price", "rating", "composite_score",
]
PROJECTION_NARROW = [
    "title", "category", "shop_name", "source_platform", "price", "rating", "composite_score", "cluster", "is_top_product", "PC1", "PC2",
]


def projection_table(df: DataFrame, wide: bool = True) -> DataFrame:
    return df.select(*have(df, PROJECTION_WIDE if wide else PROJECTION_NARROW))
