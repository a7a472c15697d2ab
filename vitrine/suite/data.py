"""Inputs of the registered queries, derived by Spark from the given tables.

The de-duplicated listings and all statistics are stage tables shared by the queries of a session. The
silver, feature and published tables are row-wise expressions on them, built once a session and not
written, so that a query reads and computes the columns it asks for and no others.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.quantiles import quantile_scalar
from ..functions.scalars import np_round, scalar_row
from ..operators import segment
from ..operators.clean import clean_standard, clean_strict
from ..operators.features import add_features
from ..operators.projection import project
from ..sources.listings import ARRIVAL, listings
from ..stages import stage

_shared: dict[tuple, DataFrame] = {}


def shared(spark: SparkSession, sf_dir: str, name: str, build: Callable[[], DataFrame], staged: bool = True) -> DataFrame:
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _shared:
        _shared[key] = stage(build(), name) if staged else build()
    return _shared[key]


def silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shared(spark, sf_dir, "silver", lambda: clean_standard(listings(spark, sf_dir), ARRIVAL), staged=False)


def strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shared(spark, sf_dir, "strict", lambda: clean_strict(listings(spark, sf_dir), ARRIVAL))


def features(spark: SparkSession, sf_dir: str, variant: str = "max") -> DataFrame:
    if variant == "ops":
        return shared(spark, sf_dir, "features-ops", lambda: add_features(strict(spark, sf_dir), "ops"), staged=False)
    return shared(spark, sf_dir, f"features-{variant}", lambda: add_features(silver(spark, sf_dir), variant), staged=False)


def rounded(df: DataFrame, columns: list[str], digits: int = 6) -> DataFrame:
    return df.withColumns({c: np_round(F.col(c), digits) for c in columns})


# A stored model for queries that must be exact: centres and projection in scaled feature space.
CENTRES = [[0.9, 0.8, 0.5, -0.2], [-0.9, -0.6, -0.3, 0.9], [0.1, 0.6, 0.9, 0.3], [-0.2, -0.9, -1.0, -0.8]]
LOADINGS = {"PC1": [0.5, 0.5, 0.5, 0.5], "PC2": [0.5, 0.5, -0.5, -0.5]}
SCALED = [f"z_{c}" for c in segment.CLUSTER_FEATURES]


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features scored with the stored model, no flags yet."""
    table = segment.zscore(features(spark, sf_dir), segment.CLUSTER_FEATURES)
    table = segment.nearest_centre(table, SCALED, CENTRES)
    names = segment.name_clusters(segment.centre_table(spark, segment.CLUSTER_FEATURES, CENTRES))
    table = segment.add_top_flag(segment.add_cluster_score(segment.add_cluster_names(table, names)))
    return project(table, SCALED, LOADINGS)


def published(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The published catalog: the stored model's scores, and simple thresholds standing in for
    the two detectors so that every catalog query has an exact counterpart in SQL."""

    def build() -> DataFrame:
        table = scored(spark, sf_dir).drop(*SCALED)
        source = features(spark, sf_dir)
        ends = scalar_row(source.agg(F.min("price").alias("lo"), F.max("price").alias("hi")))
        table = table.withColumns(
            {
                "dbscan_cluster": F.when(F.col("review_count") >= 300, -1).otherwise(0),
                "dbscan_outlier": (F.col("review_count") >= 300).cast("int"),
                "iforest_outlier": (F.col("price") > quantile_scalar(source, "price", 0.95)).cast("int"),
                "price_anomaly_score": np_round((F.col("price") - ends["lo"]) / (ends["hi"] - ends["lo"]), 6),
                "composite_score": np_round(F.col("composite_score"), 6),
                "pca_variance_explained": F.lit(75.0),
            }
        )
        return segment.fuse_anomalies(table)

    return shared(spark, sf_dir, "published", build, staged=False)
