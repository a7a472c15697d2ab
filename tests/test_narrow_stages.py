"""Tables that queries write for themselves hold what their steps read, once."""

from vitrine.operators.features import FEATURES
from vitrine.suite import data, learning


def test_ops_features_are_not_a_second_copy(spark, monkeypatch, tmp_path):
    rows = [(f"p{i}", float(i + 1), float(i % 6), float(i % 9)) for i in range(30)]
    monkeypatch.setattr(data, "_shared", {})
    monkeypatch.setattr(data, "strict", lambda *_: data.stage(spark.createDataFrame(rows, "id string, price double, rating double, review_count double"), "strict"))
    ops = data.features(spark, str(tmp_path), "ops")
    assert ops.count() == 30 and abs(ops.agg({"price_normalized": "sum"}).first()[0]) < 1e-9
    assert not any("features-ops" in f for f in ops.inputFiles())


def test_projection_stages_the_columns_it_reads(spark, monkeypatch, tmp_path):
    kinds = ", ".join(f"{c} double" for c in FEATURES)
    rows = [(f"p{i}", f"text {i}" * 50, 1.0, 0, *[float((i * (j + 3)) % (j + 5)) for j in range(len(FEATURES))]) for i in range(40)]
    table = spark.createDataFrame(rows, f"title string, description string, price double, cluster int, {kinds}")
    monkeypatch.setattr(data, "published", lambda *_: table)
    monkeypatch.setattr(data, "features", lambda *_: table)
    staged = {}
    monkeypatch.setattr(learning, "stage", lambda df, name: staged.setdefault(name, data.stage(df, name)))
    out = learning.QUERIES["pca_all_features"](spark, str(tmp_path))
    assert out.columns == ["title", "price", "cluster", "PC1", "PC2"] and out.count() == 40
    assert set(staged["scaled-features"].columns) == {"title", "price", "cluster", *[f"z_{c}" for c in FEATURES]}
