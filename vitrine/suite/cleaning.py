"""Registered queries for cleaning and features."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.scalars import np_round
from ..operators import clean, features
from ..sources.listings import ARRIVAL, listings
from . import data
from .oracle_base import rounded, with_ctes

QUERIES = {}
ORACLES = {}

QUERIES["dedup_first"] = lambda spark, sf: clean.dedup_first(listings(spark, sf), ["id"], ARRIVAL).select(
    "id", "title", "price", "rating", "ingest_seq"
)
ORACLES["dedup_first"] = with_ctes("deduped", "SELECT id, title, price, rating, ingest_seq FROM deduped")

QUERIES["dedup_without_id"] = lambda spark, sf: clean.dedup_first(
    (raw := listings(spark, sf).drop("id")), clean.dedup_keys(raw), [*ARRIVAL, "shop_name", "product_url", "price"]
).select("title", "source_platform", "ingest_seq", "shop_name")
ORACLES["dedup_without_id"] = with_ctes(
    "listings",
    """SELECT title, source_platform, ingest_seq, shop_name FROM listings
QUALIFY row_number() OVER (PARTITION BY title, source_platform
                           ORDER BY ingest_seq, scraped_at, shop_name, product_url, price NULLS FIRST) = 1""",
)

QUERIES["drop_untitled"] = lambda spark, sf: clean.drop_untitled(listings(spark, sf)).groupBy("shop_name").agg(
    F.count("*").alias("titled")
)
ORACLES["drop_untitled"] = with_ctes(
    "listings", "SELECT shop_name, count(*) AS titled FROM listings WHERE trim(replace(title, chr(160), ' ')) <> '' GROUP BY 1"
)


def _imputed(spark, sf):
    kept = clean.drop_untitled(clean.dedup_first(listings(spark, sf), ["id"], ARRIVAL))
    return clean.impute_price(kept, clean.median_price(kept)).select("id", "price")


QUERIES["impute_price"] = _imputed
ORACLES["impute_price"] = with_ctes("priced", "SELECT id, price FROM priced")

QUERIES["original_price_and_discount"] = lambda spark, sf: data.silver(spark, sf).select(
    "id", "price", "original_price", np_round(F.col("discount_percentage"), 2).alias("discount_percentage")
)
ORACLES["original_price_and_discount"] = with_ctes(
    "silver", f"SELECT id, price, original_price, {rounded(['discount_percentage'], 2)} FROM silver"
)

QUERIES["numeric_defaults"] = lambda spark, sf: clean.default_numbers(listings(spark, sf)).select(
    "id", "ingest_seq", "rating", "review_count", "stock", "is_in_stock"
)
ORACLES["numeric_defaults"] = with_ctes(
    "listings",
    """SELECT id, ingest_seq, CASE WHEN rating IS NULL OR rating < 0 THEN 0e0 WHEN rating > 5 THEN 5e0 ELSE rating END AS rating,
coalesce(review_count, 0) AS review_count, coalesce(stock, 0) AS stock, is_in_stock IS NOT FALSE AS is_in_stock FROM listings""",
)

QUERIES["category_defaults"] = lambda spark, sf: clean.default_categories(listings(spark, sf)).groupBy(
    "category", "sub_category", "brand"
).agg(F.count("*").alias("n"))
ORACLES["category_defaults"] = with_ctes(
    "listings",
    """SELECT ifnull(category, 'Inconnu') AS category, ifnull(sub_category, 'Inconnu') AS sub_category,
ifnull(brand, 'Inconnu') AS brand, count(*) AS n FROM listings GROUP BY ALL""",
)


def _flattened(spark, sf):
    variants = F.array(
        F.struct(F.col("id"), F.col("sub_category").alias("title"), F.col("stock").alias("price"), F.col("brand").alias("sku"))
    )
    raw = listings(spark, sf).withColumn("variants", F.when(F.col("stock") > 0, variants))
    return clean.flatten_arrays(raw).select("id", "ingest_seq", "tags", "variants")


QUERIES["flatten_arrays"] = _flattened
ORACLES["flatten_arrays"] = with_ctes(
    "listings",
    """SELECT id, ingest_seq, array_to_string(tags, ',') AS tags, CASE WHEN stock > 0 THEN
'[{"id":"' || id || '"' || CASE WHEN sub_category IS NULL THEN '' ELSE ',"title":"' || sub_category || '"' END
|| ',"price":' || stock || CASE WHEN brand IS NULL THEN '' ELSE ',"sku":"' || brand || '"' END || '}]'
ELSE '[]' END AS variants FROM listings""",
)

_SILVER = [
    "id", "title", "category", "sub_category", "brand", "tags", "price", "original_price", "rating", "review_count",
    "stock", "is_in_stock", "shop_name", "source_platform", "n_variants", "n_images", "scraped_at",
]
QUERIES["clean_standard"] = lambda spark, sf: data.silver(spark, sf).select(*_SILVER)
ORACLES["clean_standard"] = with_ctes("silver", f"SELECT {', '.join(_SILVER)} FROM silver")

QUERIES["clean_strict"] = lambda spark, sf: data.strict(spark, sf).select("id", "title", "price", "rating", "review_count")
ORACLES["clean_strict"] = with_ctes("strict", "SELECT id, title, price, rating, review_count FROM strict")

QUERIES["clean_strict_counts"] = lambda spark, sf: clean.clean_strict_counts(listings(spark, sf), ARRIVAL)
ORACLES["clean_strict_counts"] = with_ctes(
    ["strict"],
    """SELECT a AS initial_products, b AS cleaned_products, a - b AS duplicates_removed
FROM (SELECT (SELECT count(*) FROM listings) AS a, (SELECT count(*) FROM strict) AS b)""",
)

_SCORES = [*features.FEATURES, "log_price", "composite_score"]
for _variant in ("max", "q95"):
    QUERIES[f"features_{_variant}"] = lambda spark, sf, v=_variant: data.rounded(
        data.features(spark, sf, v).select("id", *_SCORES), _SCORES
    )
    ORACLES[f"features_{_variant}"] = with_ctes(f"features_{_variant}", f"SELECT id, {rounded(_SCORES)} FROM features_{_variant}")

_OPS = ["popularity_score", "price_rating_ratio", "review_density"]
_OPS_Z = [f"{c}_normalized" for c in features.OPS_SCALED]
QUERIES["features_ops"] = lambda spark, sf: data.rounded(
    data.features(spark, sf, "ops").select("id", *_OPS, "is_high_rated", "is_popular", "is_success", *_OPS_Z), [*_OPS, *_OPS_Z]
)
ORACLES["features_ops"] = with_ctes(
    "ops_raw",
    f"SELECT id, {rounded(_OPS)}, is_high_rated, is_popular, is_high_rated * is_popular AS is_success, {rounded(_OPS_Z)} FROM (SELECT *, "
    + ", ".join(
        f"({c} - (SELECT avg({c}) FROM ops_raw)) / (SELECT stddev_pop({c}) FROM ops_raw) AS {c}_normalized" for c in features.OPS_SCALED
    )
    + " FROM ops_raw)",
)

QUERIES["features_minimal"] = lambda spark, sf: data.rounded(
    features.add_minimal_features(data.silver(spark, sf)).select("id", "log_price", "rating_score", "popularity_score", "discount_score"),
    ["log_price", "rating_score"],
)
ORACLES["features_minimal"] = with_ctes(
    "silver",
    f"""SELECT id, {rounded(['log_price', 'rating_score'])}, CAST(review_count AS DOUBLE) AS popularity_score, 0e0 AS discount_score
FROM (SELECT *, ln(1 + price) AS log_price, rating / 5 AS rating_score FROM silver)""",
)


def _robust_normalized(spark, sf):
    raw = data.silver(spark, sf)
    top = features.quantile_scalar(raw, "price", 0.95)
    return raw.select("id", np_round(features._share_of(F.col("price"), top, 0.5), 6).alias("price_normalized"))


QUERIES["robust_normalize"] = _robust_normalized
ORACLES["robust_normalize"] = with_ctes(
    "silver",
    """SELECT id, round_even(least(price / (SELECT quantile_cont(price, 0.95) FROM silver), 1) * 1e6, 0) / 1e6 AS price_normalized
FROM silver""",
)

QUERIES["category_statistics"] = lambda spark, sf: data.rounded(
    features.category_statistics(data.silver(spark, sf)), ["category_median", "category_share"]
)
ORACLES["category_statistics"] = with_ctes(
    "silver",
    f"""SELECT category, {rounded(['category_median', 'category_share'])} FROM (SELECT category, quantile_cont(price, 0.5) AS category_median,
count(*) / CAST(sum(count(*)) OVER () AS DOUBLE) AS category_share FROM silver GROUP BY 1)""",
)

QUERIES["feature_labels"] = lambda spark, sf: (
    data.features(spark, sf)
    .select(F.explode(F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).alias("v")) for f in features.FEATURES])).alias("m"))
    .groupBy("m.feature")
    .agg(np_round(F.avg("m.v"), 6).alias("mean_value"))
    .join(F.broadcast(features.feature_labels(spark)), "feature")
)
ORACLES["feature_labels"] = with_ctes(
    "features_max",
    " UNION ALL ".join(
        f"SELECT '{f}' AS feature, round_even(avg({f}) * 1e6, 0) / 1e6 AS mean_value, '{label}' AS label FROM features_max"
        for f, label in features.FEATURE_LABELS.items()
    ),
)


def _feature_selection(spark, sf):
    table = data.features(spark, sf)
    chosen = features.select_model_features(table, leakage=features.LEAKAGE["cluster"])
    return table.agg(*[np_round(F.avg(c), 6).alias(c) for c in chosen])


QUERIES["feature_selection"] = _feature_selection
_KEPT = [
    "brand_score", "product_completeness", "has_discount_flag", "is_in_stock_flag", "shop_reputation",
    "review_rating_coherence", "title_length_norm", "category_popularity", "price_volatility", "tag_diversity",
]
ORACLES["feature_selection"] = with_ctes(
    "features_max", "SELECT " + ", ".join(f"round_even(avg({c}) * 1e6, 0) / 1e6 AS {c}" for c in _KEPT) + " FROM features_max"
)

QUERIES["top_k_composite"] = lambda spark, sf: (
    data.features(spark, sf)
    .select("id", "title", "price", np_round(F.col("composite_score"), 6).alias("composite_score"))
    .orderBy(F.desc_nulls_last("composite_score"), "id")
    .limit(20)
)
ORACLES["top_k_composite"] = with_ctes(
    "features_max",
    f"SELECT id, title, price, {rounded(['composite_score'])} FROM features_max ORDER BY composite_score DESC NULLS LAST, id LIMIT 20",
)
