"""The whole flows, end to end, on a small catalog."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from vitrine import stages
from vitrine.plans import flows
from vitrine.sources.listings import ARRIVAL, listings


@pytest.fixture(scope="module")
def raw(spark, sf):
    return stages.stage(listings(spark, sf).limit(240), "raw")


def numbered(df):
    number = F.split("id", "-")
    return df.withColumn("row_no", number[0].cast("long") * (1 << 31) + number[1].cast("long"))


def test_standard_flow(spark, raw, tmp_path):
    before = len(stages._written)
    folder = f"file://{tmp_path}/standard"
    final = flows.run_standard(numbered(raw), ARRIVAL, "row_no", folder, k=20, rounds=2, n_init=1)
    read = lambda name: spark.read.parquet(f"{folder}/{name}")
    assert read("failed_steps").collect() == []
    assert final.count() == read("products_cleaned").count() == read("products_features").count() > 0
    assert {"cluster", "cluster_label", "dbscan_cluster", "iforest_outlier", "price_anomaly_score", "is_top_product", "PC1", "PC2"} <= set(final.columns)
    assert read("top_k_products").count() == 20 and read("pca_viz").count() == final.count()
    assert {r["model"] for r in read("metrics").collect()} == {"forest", "boosted"}
    assert read("metrics").filter("auc_roc IS NULL").isEmpty()
    assert len(stages._written) == before  # no stage table is left


def test_failed_steps_are_reported(spark, raw, tmp_path, monkeypatch):
    def broken(*_, **__):
        raise ValueError("no model today")

    for name in ("train_multiclass",):
        monkeypatch.setattr(flows.supervised, name, broken)
    monkeypatch.setattr(flows, "segment_catalog", broken)
    folder = f"file://{tmp_path}/broken"
    final = flows.run_standard(numbered(raw), ARRIVAL, "row_no", folder)
    assert final.count() > 0
    assert {r["step"]: r["error"] for r in spark.read.parquet(f"{folder}/failed_steps").collect()} == {
        "segments": "ValueError: no model today",
        "models": "ValueError: no model today",
    }


def test_packaged_flow(raw, tmp_path):
    metrics = flows.run_ops(raw, ARRIVAL, numbered, f"file://{tmp_path}/ops", rounds=2).collect()
    found = {(r["stage"], r["metric"]): r["value"] for r in metrics}
    assert found["clean", "initial_products"] == 240
    assert {("clustering", "n_clusters_kmeans"), ("clustering", "silhouette_squared_kmeans"), ("training", "rf_f1_score"), ("training", "xgb_f1_score"), ("rules", "rules_found")} <= set(found)
    assert all(0 <= found["training", m] <= 1 for m in ("rf_f1_score", "xgb_f1_score"))
