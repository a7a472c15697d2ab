"""The stored-model query trains on three platforms, scores everything, and carries no column its steps do not read."""

from __future__ import annotations

from vitrine.plans import flows
from vitrine.suite import data, incremental


def test_steps_carry_the_needed_columns(spark, tmp_path, monkeypatch):
    columns = ["log_price", "rating_score", "popularity_score", "discount_score", "price", "review_count", "rating"]
    rows = [(f"p{i}", i, ("ASIA", "EUROPE", "AFRICA", "AMERICA")[i % 4], *[float(i % (j + 2)) for j in range(7)], f"text {i}", 0.5) for i in range(40)]
    kinds = ", ".join(f"{c} double" for c in columns)
    points = spark.createDataFrame(rows, f"id string, row_no long, source_platform string, {kinds}, description string, stock_score double")
    seen = []

    def flow(df, order, folder):
        seen.append((set(df.columns), df.count(), df.inputFiles()))
        wanted = ["cluster", "cluster_label", "dbscan_cluster", "iforest_outlier", "price_anomaly_score", "is_anomaly", "is_top_product"]
        return df.selectExpr("id", *[f"0 AS {c}" for c in [*wanted, "composite_score", "PC1", "PC2"]])

    monkeypatch.setattr(incremental, "_catalog_points", lambda *_: points)
    monkeypatch.setattr(flows, "segment_catalog", flow)
    monkeypatch.setattr(data, "_shared", {})
    assert incremental.QUERIES["score_with_stored_models"](spark, str(tmp_path)).count() == 40
    assert [n for _, n, _ in seen] == [30, 40]
    for names, _, files in seen:
        assert names == {"id", "row_no", "source_platform", *columns}
        assert files and all("model-points" in f for f in files)
