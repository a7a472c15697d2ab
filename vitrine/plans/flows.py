"""Whole flows: standard batch, packaged (ops) batch, segmentation with stored models."""

from __future__ import annotations

import logging
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import have, np_round
from ..operators import clean, density, evaluation, features, isolation, projection, quality, rules, segment, supervised
from ..sources import files
from ..sources.models import Models, load_models, save_models
from ..stages import stage, stage_scope
from . import dashboard

log = logging.getLogger(__name__)


def train_segments(
    df: DataFrame, order: str, n_clusters: int | None = None, eps: float = 0.5, min_samples: int = 5, components: int = 2,
    contamination: float = 0.05, n_init: int = 20,
) -> tuple[DataFrame, Models | None]:
    """Segment, flag and project a feature table; also the models to reuse.

    ``order`` is a unique number giving the row order. The input should be a stage table.
    """
    rows = df.count()
    columns = have(df, segment.CLUSTER_FEATURES)
    if rows == 0:
        return segment.with_output_defaults(df), None
    if len(columns) < 2:
        return segment.with_output_defaults(segment.add_cluster_score(df.withColumns({"cluster": F.lit(0), "cluster_label": F.lit(segment.UNNAMED)}))), None
    scaler = segment.fit_scaler(df, columns)
    scaled_names = [f"z_{c}" for c in columns]
    # Staged once: five models read it, each a few of its columns.
    table = stage(segment.zscore(df.drop(*segment.OUTPUT_DEFAULTS), columns, scaler), "scaled")

    k = segment.cluster_count(rows, n_clusters)
    centres: list[list[float]] = []
    bounds: dict = {}
    if k < 2:
        table = table.withColumns({"cluster": F.lit(0), "cluster_label": F.lit(segment.UNNAMED)})
    else:
        centres = segment.fit_kmeans(table, scaled_names, k, n_init=n_init)
        bounds = segment.centre_bounds(columns, centres)
        names = segment.name_clusters(segment.centre_table(df.sparkSession, columns, centres), bounds)
        table = segment.add_cluster_names(segment.nearest_centre(table, scaled_names, centres), names)
    table = segment.add_cluster_score(table)
    table, core = density.dbscan(table, scaled_names, order, eps, min_samples)
    table = table.withColumn("dbscan_outlier", (F.col("dbscan_cluster") == density.NOISE).cast("int"))

    forest = None
    forest_columns = have(df, isolation.FOREST_FEATURES)
    if rows < 2 or len(forest_columns) < 2:
        table = table.withColumns({"iforest_outlier": F.lit(0), "price_anomaly_score": F.lit(0.0)})
    else:
        table, forest = isolation.detect_isolation(table, order, forest_columns, contamination=contamination)
    table = segment.downweight_anomalies(segment.add_top_flag(segment.fuse_anomalies(table)))
    table = stage(table, "segments")
    fitted = projection.fit_pca(table, scaled_names, max(2, components)) if rows >= 2 and scaled_names else None
    table = projection.add_projection(table, scaled_names, components, fitted) if rows >= 2 else segment.with_output_defaults(table)
    models = None
    if forest is not None and centres:
        loadings, ratios = fitted
        models = Models(tuple(columns), scaler, centres, bounds, core, eps, forest, loadings, projection.explained_percent(ratios))
    return segment.with_output_defaults(table.drop(*scaled_names)), models


def score_segments(df: DataFrame, order: str, m: Models) -> DataFrame:
    """Score new rows with stored models. Nothing is fitted; scores are not down-weighted."""
    scaled_names = [f"z_{c}" for c in m.columns]
    base = df.drop(*segment.OUTPUT_DEFAULTS)
    absent = {c: F.lit(0.0) for c in (*m.columns, *m.forest.columns) if c not in base.columns}
    table = segment.zscore(base.withColumns(absent) if absent else base, m.columns, m.scaler)
    table = segment.nearest_centre(table, scaled_names, m.centres)
    names = segment.name_clusters(segment.centre_table(df.sparkSession, m.columns, m.centres), m.bounds)
    table = segment.add_cluster_score(segment.add_cluster_names(table, names))
    table = density.dbscan_predict(stage(table, "to-score"), scaled_names, order, m.core, m.eps)
    table = table.withColumn("dbscan_outlier", (F.col("dbscan_cluster") == density.NOISE).cast("int"))
    table = isolation.add_isolation(table, m.forest)
    table = projection.project(segment.add_top_flag(segment.fuse_anomalies(table)), scaled_names, m.loadings)
    return table.withColumn("pca_variance_explained", F.lit(m.variance_percent)).drop(*scaled_names)


def segment_catalog(df: DataFrame, order: str, models_folder: str | None = None, **settings) -> DataFrame:
    """Score with the stored models when all are there, else train (and store) them."""
    stored = load_models(df.sparkSession, models_folder) if models_folder else None
    if stored is not None:
        return score_segments(df, order, stored)
    table, models = train_segments(df, order, **settings)
    if models_folder and models is not None:
        save_models(df.sparkSession, models_folder, models)
    return table


def _guarded(name: str, step: Callable[[], None]) -> tuple[str, str] | None:
    """Late steps may fail without losing the finished tables; the name and error of one that does."""
    try:
        step()
    except Exception as wrong:  # noqa: BLE001 - reported, then the flow goes on
        log.exception("step %s failed", name)
        return name, f"{type(wrong).__name__}: {wrong}"[:500]
    return None


def run_standard(raw: DataFrame, arrival: list[str], order: str, folder: str, k: int = 20, rounds: int | None = None, **settings) -> DataFrame:
    """Clean, features, segments, models, rules, publish. Returns the published catalog.

    A failure in cleaning or features stops the flow; later steps are logged, skipped and listed in
    the table failed_steps (step, error), which is empty after a run without failures.
    """
    with stage_scope(raw.sparkSession):
        return _standard(raw, arrival, order, folder, k, rounds, **settings)


def _standard(raw: DataFrame, arrival: list[str], order: str, folder: str, k: int, rounds: int | None, **settings) -> DataFrame:
    spark = raw.sparkSession
    files.write_table(clean.clean_standard(raw, arrival), folder, "products_cleaned")
    files.write_table(features.add_features(spark.read.parquet(f"{folder}/products_cleaned"), "max"), folder, "products_features")
    table = spark.read.parquet(f"{folder}/products_features")
    final = {"table": table}

    def segments() -> None:
        files.write_table(segment_catalog(table, order, **settings), folder, "products_clustered")
        final["table"] = spark.read.parquet(f"{folder}/products_clustered")

    def learn() -> None:
        columns = features.select_model_features(final["table"], leakage=features.LEAKAGE["cluster"])
        forest = supervised.train_multiclass(final["table"], columns, rounds=rounds)
        boosted = supervised.train_multiclass(final["table"], columns, boosted=True, rounds=rounds)
        files.write_table(supervised.feature_importance(forest), folder, "feature_importance")
        both = forest.metrics.withColumn("model", F.lit("forest")).unionByName(boosted.metrics.withColumn("model", F.lit("boosted")))
        files.write_table(both, folder, "metrics")

    def mine() -> None:
        files.write_table(rules.mine_rules(final["table"], "main"), folder, "association_rules")

    def publish() -> None:
        files.write_table(final["table"], folder, "products_final")
        if {"PC1", "PC2"} <= set(final["table"].columns):
            files.write_table(dashboard.projection_table(final["table"]), folder, "pca_viz")
        files.write_table(dashboard.top_k(final["table"], k), folder, "top_k_products")
        files.publish_alias(spark, folder)

    failed: list[tuple[str, str]] = []
    for name, step in (("segments", segments), ("models", learn), ("rules", mine), ("publish", publish)):
        if (failure := _guarded(name, step)) is not None:
            failed.append(failure)
    files.write_table(spark.createDataFrame(failed, "step string, error string"), folder, "failed_steps")
    return spark.read.parquet(f"{folder}/products_final")


OPS_COLUMNS = ["price", "rating", "review_count", "popularity_score"]


def segment_ops(df: DataFrame, order: str, n_init: int = 10) -> DataFrame:
    """Segmentation of the packaged flow: unscaled columns, radius 0.5 with 3 rows, a tenth of
    the rows anomalous (-1), two components."""
    rows = df.count()
    k = min(4, rows // 5) if rows > 5 else 2
    table = segment.nearest_centre(df, OPS_COLUMNS, segment.fit_kmeans(df, OPS_COLUMNS, k, n_init=n_init), "cluster_kmeans")
    table, _ = density.dbscan(table, OPS_COLUMNS, order, 0.5, 3, "cluster_dbscan")
    forest = isolation.fit_forest(df, order, OPS_COLUMNS, trees=100, contamination=0.1)
    table = table.withColumn("anomaly_score", isolation.sample_score(forest)).withColumn(
        "is_anomaly", F.when(F.col("anomaly_score") < forest.limit, -1).otherwise(1)
    )
    means = segment.fit_scaler(df, OPS_COLUMNS)
    centred = table.withColumns({f"c_{c}": segment.number_or_zero(c) - means[c][0] for c in OPS_COLUMNS})
    names = [f"c_{c}" for c in OPS_COLUMNS]
    loadings, ratios = projection.fit_pca(centred, names, 2)
    projected = projection.project(centred, names, {"pca_1": loadings["PC1"], "pca_2": loadings["PC2"]})
    return projected.drop(*names).withColumn("pca_variance_explained", F.lit(sum(ratios)))


def _long(stage_name: str, row: DataFrame) -> DataFrame:
    """One aggregate row as (stage, metric, value) rows."""
    pairs = [F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("value")) for c in row.columns]
    return row.select(F.explode(F.array(*pairs)).alias("m")).select(F.lit(stage_name).alias("stage"), "m.*")


def cleaning_metrics(raw: DataFrame, arrival: list[str]) -> DataFrame:
    return _long("clean", clean.clean_strict_counts(raw, arrival))


def feature_metrics(df: DataFrame) -> DataFrame:
    return _long("features", df.agg(F.lit(len(df.columns)).alias("features_created"), np_round(F.avg("popularity_score"), 6).alias("avg_popularity_score")))


def segment_metrics(df: DataFrame, columns: list[str], label: str = "cluster_kmeans") -> DataFrame:
    row = df.agg(
        F.countDistinct(label).alias("n_clusters_kmeans"),
        F.count_if(F.col("is_anomaly") == -1).alias("anomalies_detected"),
        F.first("pca_variance_explained").alias("pca_variance_explained"),
    )
    judged = quality.evaluate_clustering(df, columns, label).select(
        F.col("silhouette_squared").alias("silhouette_squared_kmeans"), F.col("davies_bouldin").alias("davies_bouldin_kmeans")
    )
    return _long("clustering", row).unionAll(_long("clustering", judged))


def rule_metrics(found: DataFrame) -> DataFrame:
    return _long("rules", found.agg(F.count("*").alias("rules_found")))


def run_ops(raw: DataFrame, arrival: list[str], order: Callable[[DataFrame], DataFrame], folder: str, k: int = 30, rounds: int | None = None) -> DataFrame:
    """The packaged flow; returns its (stage, metric, value) table. ``order`` adds ``row_no``."""
    with stage_scope(raw.sparkSession):
        return _packaged(raw, arrival, order, folder, k, rounds)


def _packaged(raw: DataFrame, arrival: list[str], order: Callable[[DataFrame], DataFrame], folder: str, k: int, rounds: int | None) -> DataFrame:
    spark = raw.sparkSession
    files.write_table(clean.clean_strict(raw, arrival), folder, "cleaned_data")
    files.write_table(features.add_ops_features(order(spark.read.parquet(f"{folder}/cleaned_data"))), folder, "features_data")
    table = spark.read.parquet(f"{folder}/features_data")
    files.write_table(segment_ops(table, "row_no"), folder, "clustered_data")
    clustered = spark.read.parquet(f"{folder}/clustered_data")
    files.write_table(dashboard.top_k(clustered, k, "popularity_score"), folder, "topk_data")
    files.write_table(rules.mine_rules(clustered, "ops"), folder, "rules_data")
    parts = [cleaning_metrics(raw, arrival), feature_metrics(table), segment_metrics(clustered, OPS_COLUMNS), rule_metrics(spark.read.parquet(f"{folder}/rules_data"))]
    target = features.resolve_target(table, ("is_success", "is_top_product"))
    columns = [c for c in features.numeric_features(table, target) if c != "row_no"]
    for name, boosted in (("rf", False), ("xgb", True)):
        trained = supervised.train_binary(table, columns, target, boosted=boosted, rounds=rounds or 100, rate=0.1, balanced=False)
        report = evaluation.class_report(evaluation.confusion_table(trained.scored, target, "prediction"))
        parts.append(_long("training", report.agg(F.coalesce(F.max(F.when(F.col("label") == 1, F.col("f1"))), F.lit(0.0)).alias(f"{name}_f1_score"))))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    files.write_table(out, folder, "run_metrics")
    return spark.read.parquet(f"{folder}/run_metrics")
