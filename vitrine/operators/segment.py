"""Scaling, centroid segmentation, cluster naming and the scores that follow from them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import clip, have, scalar_row, with_scalars
from ..stages import stage
from .lloyd import best_of_starts

CLUSTER_FEATURES = ["log_price", "rating_score", "popularity_score", "discount_score"]
PROFILE_FEATURES = ["log_price", "rating_score", "popularity_score", "stock_score", "discount_score"]

# Naming order, weights of the four naming scores (a minus sign stands for
# 1 - value) and base ranks of the names.
NAMES = {
    "Premium": [("log_price", 0.45), ("rating_score", 0.35), ("popularity_score", 0.20)],
    "Budget": [("discount_score", 0.40), ("-log_price", 0.35), ("-rating_score", 0.25)],
    "Populaire": [("popularity_score", 0.55), ("rating_score", 0.25), ("stock_score", 0.20)],
    "Inactif": [("-popularity_score", 0.50), ("-stock_score", 0.30), ("-rating_score", 0.20)],
}
BASE_RANK = {"Premium": 0.92, "Populaire": 0.82, "Budget": 0.62, "Inactif": 0.25}
OTHER_RANK = 0.5
TOP_NAMES = ["Premium", "Populaire"]
UNNAMED = "Inconnu"


def number_or_zero(name: str) -> Column:
    value = F.col(name).cast("double")
    return F.coalesce(F.when(~F.isnan(value), value), F.lit(0.0))


# ---- scaling ---------------------------------------------------------------------------------


def fit_scaler(df: DataFrame, columns: Sequence[str]) -> dict[str, tuple[float, float]]:
    """Mean and population deviation per column, one aggregate row."""
    row = df.agg(
        *[f(number_or_zero(c)).alias(f"{p}_{c}") for c in columns for p, f in (("avg", F.avg), ("sd", F.stddev_pop))]
    ).first()
    return {c: (row[f"avg_{c}"] or 0.0, row[f"sd_{c}"] or 0.0) for c in columns}


def _scaled(value: Column, mean: Column | float, deviation: Column | float) -> Column:
    mean, deviation = (x if isinstance(x, Column) else F.lit(float(x)) for x in (mean, deviation))
    return F.when(deviation > 0, (value - mean) / deviation).otherwise(0.0)


def zscore(df: DataFrame, columns: Sequence[str], scaler: dict[str, tuple[float, float]] | None = None) -> DataFrame:
    """Add ``z_<column>``; null counts as 0, a constant column scales to 0.

    Without a fitted scaler the moments are taken once, into a stage table of one row, so that every
    pass over the result sees the same values.
    """
    if scaler is None:
        moments = df.agg(*[f(number_or_zero(c)).alias(f"{p}_{c}") for c in columns for p, f in (("avg", F.avg), ("sd", F.stddev_pop))])
        moments = stage(moments, "moments")
        m = F.col("_moments")
        scaled = {f"z_{c}": _scaled(number_or_zero(c), m[f"avg_{c}"], m[f"sd_{c}"]) for c in columns}
        return with_scalars(df, _moments=moments).withColumns(scaled).drop("_moments")
    return df.withColumns({f"z_{c}": _scaled(number_or_zero(c), *scaler[c]) for c in columns})


# ---- centroids -------------------------------------------------------------------------------


def cluster_count(rows: int, wanted: int | None = None, setting: int = 5) -> int:
    return min(max(1, wanted or min(max(3, min(setting, 4)), 4)), rows)


def fit_kmeans(df: DataFrame, columns: Sequence[str], k: int, seed: int = 42, n_init: int = 20) -> list[list[float]]:
    """Centres of the best of ``n_init`` starts, in a canonical order.

    Equal feature rows are merged into one weighted row first, which keeps the result and shrinks
    every pass; all starts share the passes (:mod:`.lloyd`).
    """
    merged = df.groupBy(*[(number_or_zero(c) + 0.0).alias(c) for c in columns]).agg(F.count("*").cast("double").alias("weight"))
    return best_of_starts(stage(merged, "merged-rows"), columns, k, seed, n_init)


def nearest_centre(df: DataFrame, columns: Sequence[str], centres: list[list[float]], name: str = "cluster") -> DataFrame:
    """Assign the nearest centre, the lowest number on ties, as one generated expression."""
    choices = [
        F.struct(
            sum(((number_or_zero(c) - F.lit(float(x))) * (number_or_zero(c) - F.lit(float(x))) for c, x in zip(columns, centre)), F.lit(0.0)).alias("d"),
            F.lit(i).alias("i"),
        )
        for i, centre in enumerate(centres)
    ]
    return df.withColumn(name, F.array_min(F.array(*choices))["i"])


def centre_table(spark: SparkSession, columns: Sequence[str], centres: list[list[float]]) -> DataFrame:
    """The k centres as rows: cluster, one column per feature."""
    schema = "cluster int, " + ", ".join(f"{c} double" for c in columns)
    return spark.createDataFrame([(i, *map(float, c)) for i, c in enumerate(centres)], schema)


def centre_bounds(columns: Sequence[str], centres: list[list[float]]) -> dict[str, dict[str, float]]:
    bounds = {c: {"min": min(v), "max": max(v)} for c, v in zip(columns, zip(*centres)) if c in PROFILE_FEATURES}
    return bounds if "stock_score" in columns else {**bounds, "stock_score": {"min": 0.0, "max": 0.0}}


def _close(a: Column, b: Column) -> Column:
    return F.abs(a - b) <= F.lit(1e-8) + F.abs(b) * 1e-5


def profile_clusters(centres: DataFrame, bounds: dict[str, dict[str, float]] | None = None) -> DataFrame:
    """Centres scaled to 0..1 per feature: stored bounds where they are a real interval,
    else the centres' own range; a constant or missing feature is 0."""
    known = have(centres, PROFILE_FEATURES)
    span = scalar_row(
        centres.agg(*[f(number_or_zero(c)).alias(f"{p}_{c}") for c in known for p, f in (("lo", F.min), ("hi", F.max))])
    )
    columns = {c: F.lit(0.0) for c in PROFILE_FEATURES if c not in known}
    for c in known:
        low, high = span[f"lo_{c}"], span[f"hi_{c}"]
        stored = (bounds or {}).get(c)
        if stored and abs(stored["min"] - stored["max"]) > 1e-8 + 1e-5 * abs(stored["max"]):
            scaled = (number_or_zero(c) - stored["min"]) / (stored["max"] - stored["min"])
        else:
            scaled = F.when(_close(low, high), 0.0).otherwise((number_or_zero(c) - low) / F.nullif(high - low, F.lit(0.0)))
        columns[c] = F.when(low == high, 0.0).otherwise(scaled)
    return centres.withColumns(columns)


def name_clusters(centres: DataFrame, bounds: dict[str, dict[str, float]] | None = None) -> DataFrame:
    """(cluster, cluster_label): each name in turn takes the best remaining cluster, the lowest
    number on ties. The k centres travel as one array, so the choices are plain expressions."""
    profile = profile_clusters(centres, bounds)

    def score(terms: list[tuple[str, float]]) -> Column:
        parts = [(1 - F.col(c[1:]) if c.startswith("-") else F.col(c)) * w for c, w in terms]
        return sum(parts, F.lit(0.0))

    table = profile.select("cluster", *[score(terms).alias(n) for n, terms in NAMES.items()]).agg(
        F.collect_list(F.struct("cluster", *NAMES)).alias("left")
    )
    for name in NAMES:
        table = table.withColumn(
            f"is_{name}", F.array_max(F.transform("left", lambda s: F.struct(s[name].alias("score"), (-s["cluster"]).alias("no"))))["no"]
        ).withColumn("left", F.filter("left", lambda s: -s["cluster"] != F.col(f"is_{name}")))
    named = F.array(*[F.struct((-F.col(f"is_{n}")).alias("cluster"), F.lit(n).alias("cluster_label")) for n in NAMES])
    rest = F.transform("left", lambda s: F.struct(s["cluster"].alias("cluster"), F.lit(UNNAMED).alias("cluster_label")))
    return table.select(F.explode(F.concat(named, rest)).alias("n")).select("n.*").filter(F.col("cluster").isNotNull())


def add_cluster_names(df: DataFrame, names: DataFrame) -> DataFrame:
    """Names onto rows. ``names`` has k rows, whatever the size of the data."""
    return (
        df.drop("cluster_label")
        .join(F.broadcast(names), "cluster", "left")
        .withColumn("cluster_label", F.coalesce("cluster_label", F.lit(UNNAMED)))
    )


# ---- scores and flags ------------------------------------------------------------------------


def add_cluster_score(df: DataFrame) -> DataFrame:
    """Ranking score from the cluster name; replaces the feature step's composite_score."""
    base = F.lit(OTHER_RANK)
    for name, rank in BASE_RANK.items():
        base = F.when(F.col("cluster_label") == name, rank).otherwise(base)
    part = {c: number_or_zero(c) if c in df.columns else F.lit(0.0) for c in ("rating_score", "popularity_score", "discount_score")}
    total = base + 0.08 * part["rating_score"] + 0.08 * part["popularity_score"] + 0.04 * part["discount_score"]
    return df.withColumn("composite_score", clip(total, 0.0, 1.0))


def add_top_flag(df: DataFrame) -> DataFrame:
    return df.withColumn("is_top_product", F.col("cluster_label").isin(TOP_NAMES).cast("int"))


def fuse_anomalies(df: DataFrame) -> DataFrame:
    either = (F.col("dbscan_outlier") == 1) | (F.col("iforest_outlier") == 1)
    return df.withColumns({"is_anomaly": either.cast("int"), "price_anomaly_flag": F.col("iforest_outlier").cast("int")})


def downweight_anomalies(df: DataFrame) -> DataFrame:
    """Training only: an anomaly keeps nine tenths of its score."""
    lowered = clip(F.col("composite_score") * 0.9, 0.0, 1.0)
    return df.withColumn("composite_score", F.when(F.col("is_anomaly") == 1, lowered).otherwise(F.col("composite_score")))


# Output columns a segmented catalog always has.
OUTPUT_DEFAULTS = {
    "cluster": 0, "cluster_label": UNNAMED, "dbscan_cluster": 0, "dbscan_outlier": 0, "iforest_outlier": 0,
    "price_anomaly_score": 0.0, "price_anomaly_flag": 0, "is_anomaly": 0, "PC1": 0.0, "PC2": 0.0,
    "pca_variance_explained": 0.0, "composite_score": 0.0, "is_top_product": 0,
}


def with_output_defaults(df: DataFrame) -> DataFrame:
    missing = {c: F.lit(v) for c, v in OUTPUT_DEFAULTS.items() if c not in df.columns}
    return df.withColumns(missing) if missing else df
