"""Feature engineering: the ``max`` and ``q95`` scoring families, the ``ops`` family and the
minimal fallback.

Input is a cleaned catalog, best a stage table: statistics are one extra pass over a few
columns. Global statistics arrive as scalar subqueries. Per-category, per-brand and per-shop
statistics are stage tables joined on their key, so their measured size decides the join.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.quantiles import exact_quantiles, quantile_row, quantile_scalar
from ..functions.scalars import clip, have, with_scalars
from ..stages import stage

FEATURES = [
    "price_score", "rating_score", "popularity_score", "stock_score", "discount_score",
    "value_for_money", "price_to_median_ratio", "log_reviews", "variant_diversity", "n_images_norm",
    "brand_score", "product_completeness", "has_discount_flag", "is_in_stock_flag", "shop_reputation",
    "review_rating_coherence", "title_length_norm", "category_popularity", "price_volatility", "tag_diversity",
]

# Labels shown for each feature.
FEATURE_LABELS = {
    "price_score": "Prix compétitif",
    "rating_score": "Note client",
    "popularity_score": "Popularité (avis)",
    "stock_score": "Disponibilité stock",
    "discount_score": "Taux de remise",
    "value_for_money": "Rapport qualité/prix",
    "price_to_median_ratio": "Position vs médiane catégorie",
    "log_reviews": "Log(nb avis)",
    "variant_diversity": "Richesse variantes",
    "n_images_norm": "Richesse visuelle",
    "brand_score": "Score marque",
    "product_completeness": "Complétude données",
    "has_discount_flag": "En promotion",
    "is_in_stock_flag": "En stock",
    "shop_reputation": "Réputation boutique",
    "review_rating_coherence": "Cohérence avis/note",
    "title_length_norm": "Qualité du titre",
    "category_popularity": "Popularité catégorie",
    "price_volatility": "Volatilité prix",
    "tag_diversity": "Diversité mots-clés",
}

# Weights of the two ranking scores.
COMPOSITE = {
    "max": {
        "rating_score": 0.30, "popularity_score": 0.25, "discount_score": 0.20,
        "value_for_money": 0.15, "product_completeness": 0.10,
    },
    "q95": {
        "rating_score": 0.25, "popularity_score": 0.20, "value_for_money": 0.12, "discount_score": 0.12,
        "price_score": 0.08, "stock_score": 0.06, "shop_reputation": 0.06, "review_rating_coherence": 0.05,
        "brand_score": 0.03, "product_completeness": 0.03,
    },
}

TARGETS = ("is_top_product", "is_success")
# Columns that would leak each target into its features.
LEAKAGE = {
    "default": ("cluster", "cluster_label", "composite_score"),
    "cluster": (
        "price_score", "rating_score", "popularity_score", "stock_score", "discount_score", "value_for_money",
        "price_to_median_ratio", "log_reviews", "variant_diversity", "n_images_norm", "log_price", "composite_score",
    ),
    "top": (
        "price", "rating", "review_count", "price_score", "rating_score", "log_reviews", "popularity_score",
        "value_for_money", "review_rating_coherence", "composite_score",
    ),
    "ops": (
        "price", "rating", "review_count", "popularity_score", "price_rating_ratio", "review_density",
        "is_high_rated", "is_popular", "price_normalized", "rating_normalized", "review_count_normalized",
        "popularity_score_normalized",
    ),
}

_NUMERIC = ("tinyint", "smallint", "int", "bigint", "float", "double")


def resolve_target(df: DataFrame, preferred: Sequence[str] = TARGETS) -> str:
    for name in preferred:
        if name in df.columns:
            return name
    raise KeyError(f"none of {list(preferred)} in the table")


def select_model_features(
    df: DataFrame,
    candidates: Sequence[str] | None = None,
    target: str | None = None,
    leakage: Iterable[str] = (),
) -> list[str]:
    """Candidate columns without targets and leaking columns; numeric columns by default."""
    barred = {*LEAKAGE["default"], *TARGETS, *leakage, *([target] if target else [])}
    return [c for c in have(df, list(candidates or FEATURES)) if c not in barred]


def numeric_features(df: DataFrame, target: str) -> list[str]:
    """Every numeric column but the ops target and what leaks it."""
    return [c for c, kind in df.dtypes if kind in _NUMERIC and c not in (*LEAKAGE["ops"], target)]


def feature_labels(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(FEATURE_LABELS.items()), "feature string, label string")


def _share_of(value: Column, top: Column, otherwise: float) -> Column:
    """value / top clipped to 0..1, a constant where top is not positive."""
    return F.when(top > 0, clip(value / top, 0.0, 1.0)).otherwise(otherwise)


def _tag_count(df: DataFrame, variant: str) -> Column | None:
    """Tags per row; the max family only counts real arrays, text tags count as none."""
    kind = dict(df.dtypes).get("tags")
    if kind is None:
        return None
    if kind.startswith("array"):
        return F.coalesce(F.size("tags"), F.lit(0))
    if variant == "max":
        return F.lit(0)
    return F.when(F.coalesce(F.col("tags"), F.lit("")) == "", 0).otherwise(F.size(F.split("tags", ",")))


def category_statistics(df: DataFrame) -> DataFrame:
    """Per category: median price and share of the catalog."""
    counts = df.filter(F.col("category").isNotNull()).groupBy("category").agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n").alias("t")).select("t").scalar()
    medians = exact_quantiles(df, {"price": "price"}, [0.5], by=["category"])
    return counts.join(medians.select("category", F.col("value").alias("category_median")), "category", "left").select(
        "category", "category_median", (F.col("n") / total).alias("category_share")
    )


def brand_statistics(df: DataFrame) -> DataFrame:
    counts = df.filter(F.col("brand").isNotNull()).groupBy("brand").agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n").alias("t")).select("t").scalar()
    return counts.select("brand", (F.col("n") / total).alias("brand_share"))


def shop_statistics(df: DataFrame) -> DataFrame:
    return df.filter(F.col("shop_name").isNotNull()).groupBy("shop_name").agg(F.avg("rating").alias("shop_rating"))


def _staged_by_key(statistics: DataFrame, key: str, name: str) -> DataFrame:
    """Statistics with one row per key as a stage table, grouped by the key once more.

    The file does not say that its keys are unique, the grouping does, and so Catalyst leaves the left join
    out of every query that reads none of the statistics.
    """
    table = stage(statistics, name)
    return table.groupBy(key).agg(*[F.first(c).alias(c) for c in table.columns if c != key])


def _add_key_statistics(df: DataFrame) -> DataFrame:
    out = df.join(_staged_by_key(category_statistics(df), "category", "category-stats"), "category", "left")
    if "brand" in df.columns:
        out = out.join(_staged_by_key(brand_statistics(df), "brand", "brand-stats"), "brand", "left")
    if "shop_name" in df.columns:
        out = out.join(_staged_by_key(shop_statistics(df), "shop_name", "shop-stats"), "shop_name", "left")
    return out


def add_features(df: DataFrame, variant: str = "max") -> DataFrame:
    """Add the 20 features, log_price and composite_score (variant ``max`` or ``q95``)."""
    if variant == "ops":
        return add_ops_features(df)
    robust = variant == "q95"
    columns = df.columns
    discount = next((c for c in ("discount_pct", "discount_percentage") if c in columns), None)
    tags = _tag_count(df, variant)
    tag_cap = 10 if robust else 20
    capped = {}
    if "n_variants" in columns:
        capped["variants"] = F.least(F.col("n_variants"), F.lit(20))
    if "n_images" in columns:
        capped["images"] = F.least(F.col("n_images"), F.lit(10))
    scaled = {"price": F.col("price"), "stock": F.col("stock"), **capped}
    if discount:
        scaled["discount"] = F.col(discount)

    # One pass of maxima, and for q95 one histogram descent over all scaled columns at once.
    peaks = {"log_reviews": F.max(F.log1p("review_count"))}
    if tags is not None:
        peaks["tags"] = F.max(F.least(tags, F.lit(tag_cap)))
    if not robust:
        peaks.update({name: F.max(c) for name, c in scaled.items()})
    scalars = {"_peak": stage(df.agg(*[c.cast("double").alias(name) for name, c in peaks.items()]), "feature-peaks")}
    if robust:
        scalars["_top"] = quantile_row(df, scaled, 0.95)
    peak, top = F.col("_peak"), F.col("_top" if robust else "_peak")

    price, rating = F.col("price"), F.col("rating")
    out = with_scalars(_add_key_statistics(df), **scalars)

    price_share = clip(price / top["price"], 0.0, 1.0) if robust else price / top["price"]
    first = {
        "price_score": F.when(top["price"] > 0, clip(1 - price_share, 0.0, 1.0)).otherwise(0.5),
        "rating_score": clip(rating / 5.0, 0.0, 1.0),
        "log_reviews": F.log1p("review_count"),
        "log_price": F.log1p(F.greatest(F.coalesce(price.try_cast("double"), F.lit(0.0)), F.lit(0.0))),
        "stock_score": _share_of(F.col("stock"), top["stock"], 0.5 if robust else 0.0),
        "discount_score": _share_of(F.col(discount), top["discount"], 0.5 if robust else 0.0) if discount else F.lit(0.0),
        "variant_diversity": _share_of(capped["variants"], top["variants"], 0.5 if robust else 0.0) if "variants" in capped else F.lit(0.0),
        "n_images_norm": _share_of(capped["images"], top["images"], 0.5) if "images" in capped else F.lit(0.5),
        "_ratio": clip(price / F.when(F.col("category_median") == 0, 1.0).otherwise(F.col("category_median")), 0.0, 5.0),
    }
    out = out.withColumns(first)
    spread = clip(F.abs(F.col("_ratio") - 1), 0.0, 4.0) / 4
    complete = have(df, ["price", "rating", "review_count", "stock", "category", *(["image_url"] if robust else [])])
    filled = sum((F.col(c).isNotNull().cast("int") for c in complete), F.lit(0)) / len(complete)
    second = {
        "popularity_score": _share_of(F.col("log_reviews"), peak["log_reviews"], 0.0),
        "value_for_money": F.when(rating == 0, 0.0).otherwise(clip(F.col("rating_score") * F.col("price_score"), 0.0, 1.0)),
        "price_to_median_ratio": 1 - spread,
        "price_volatility": spread,
        "brand_score": F.coalesce(F.col("brand_share"), F.lit(0.0)) if "brand" in columns else F.lit(0.0),
        "category_popularity": F.coalesce(F.col("category_share"), F.lit(0.0)),
        "shop_reputation": clip(F.col("shop_rating") / 5.0, 0.0, 1.0) if "shop_name" in columns else F.lit(0.5),
        "product_completeness": F.when(price == 0, filled * 0.5).otherwise(filled),
        "has_discount_flag": (F.col("has_discount") if "has_discount" in columns else F.col("discount_score") > 0).cast("double"),
        "is_in_stock_flag": (F.col("is_in_stock") if "is_in_stock" in columns else F.col("stock") > 0).cast("double"),
        "title_length_norm": (clip(F.coalesce(F.char_length("title"), F.lit(0)), 10, 100) - 10) / 90 if "title" in columns else F.lit(0.5),
        "tag_diversity": _share_of(F.least(tags, F.lit(tag_cap)), peak["tags"], 0.0) if tags is not None else F.lit(0.0),
    }
    out = out.withColumns(second).withColumn(
        "review_rating_coherence", clip(F.col("popularity_score") * F.col("rating_score"), 0.0, 1.0)
    )
    score = sum((F.col(c) * w for c, w in COMPOSITE[variant].items()), F.lit(0.0))
    out = out.withColumn("composite_score", clip(score, 0.0, 1.0))
    return out.drop("_ratio", "category_median", "category_share", "brand_share", "shop_rating").select(
        *columns, *[c for c in [*FEATURES, "log_price", "composite_score"] if c not in columns]
    )


OPS_SCALED = ["price", "rating", "review_count", "popularity_score"]


def add_ops_features(df: DataFrame) -> DataFrame:
    """Features of the packaged flow: popularity, ratios, success flags, four z-scores."""
    out = df.withColumns(
        {
            "popularity_score": F.col("rating") * 0.4
            + F.log1p("review_count") * 0.3
            + (F.lit(1.0) / (F.col("price") + 1)) * 100 * 0.3,
            "price_rating_ratio": F.col("price") / (F.col("rating") + 0.1),
            "review_density": F.col("review_count") / (F.col("price") + 1),
            "is_high_rated": (F.col("rating") >= 4.5).cast("int"),
            "is_popular": (F.col("review_count") >= quantile_scalar(df, "review_count", 0.5)).cast("int"),
        }
    ).withColumn("is_success", F.col("is_popular").bitwiseAND(F.col("is_high_rated")))
    moments = F.col("_moments")
    stats = out.agg(*[f(c).alias(f"{p}_{c}") for c in OPS_SCALED for p, f in (("avg", F.avg), ("sd", F.stddev_pop))])
    return with_scalars(out, _moments=stage(stats, "ops-moments")).withColumns(
        {
            f"{c}_normalized": F.when(moments[f"sd_{c}"] > 0, (F.col(c) - moments[f"avg_{c}"]) / moments[f"sd_{c}"]).otherwise(0.0)
            for c in OPS_SCALED
        }
    ).drop("_moments")


def add_minimal_features(df: DataFrame) -> DataFrame:
    """Fallback when no feature step ran: missing price, review_count and rating are 0."""
    base = df.withColumns({c: F.lit(0.0) for c in ("price", "review_count", "rating") if c not in df.columns})
    return base.withColumns(
        {
            "log_price": F.log1p("price"),
            "rating_score": F.col("rating") / 5.0,
            "popularity_score": F.col("review_count").cast("double"),
            "discount_score": F.lit(0.0),
        }
    )
