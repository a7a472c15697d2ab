"""Learning, quality, streams, files and flows on small tables."""

import json
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from vitrine.operators import evaluation, isolation, normalize, projection, quality, segment, supervised
from vitrine.plans import flows
from vitrine.schema import validate_catalog
from vitrine.sources import files
from vitrine.sources.models import load_models
from vitrine.streaming import enrichment as en


def frame(n=120, seed=5):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        price, reviews, rating = float(rng.uniform(50, 300)), int(rng.integers(10, 500)), float(rng.uniform(3, 5))
        if i == n - 1:
            price, reviews, rating = 5000.0, 1, 0.2
        rows.append((i, f"p{i}", f"t{i}", "ABC"[i % 3], f"S{i % 4}", price, reviews, rating, float(np.log1p(price)), rating / 5, float(rng.uniform(0.2, 1)), float(rng.uniform(0, 0.8))))
    return rows


COLUMNS = (
    "row_no bigint, id string, title string, category string, shop_name string, price double, review_count bigint, rating double, "
    "log_price double, rating_score double, popularity_score double, discount_score double"
)


@pytest.fixture(scope="module")
def table(spark):
    return spark.createDataFrame(frame(), COLUMNS).cache()


def test_threshold_and_auc_vectors(spark):
    df = spark.createDataFrame([(0, 0.05), (0, 0.35), (1, 0.55), (1, 0.95)], "y int, p double")
    assert tuple(evaluation.optimal_f1_threshold(df, "y", "p").first()) == (0.55, 1.0)
    assert evaluation.roc_auc(df, "y", "p").first()["auc"] == 1.0
    assert tuple(evaluation.optimal_f1_threshold(df.limit(0), "y", "p").first()) == (0.5, 0.0)
    tied = spark.createDataFrame([(0, 0.5), (1, 0.5), (1, 0.5)], "y int, p double")
    assert evaluation.roc_auc(tied, "y", "p").first()["auc"] == 0.5


def test_unknown_classes_count_as_zero(spark):
    df = spark.createDataFrame([(0, 0), (0, 1), (1, 1), (2, 1)], "y int, g int")
    row = evaluation.classifier_metrics(evaluation.confusion_table(df, "y", "g")).first()
    assert row["accuracy"] == 0.5 and row["recall"] == 0.5


def test_split_is_stratified_and_repeatable(spark):
    df = spark.range(1000).selectExpr("cast(id as string) id", "id % 10 = 0 as rare")
    split = evaluation.stratified_split(df, "rare").groupBy("rare").agg(F.avg(F.col("is_test").cast("int")).alias("s")).collect()
    assert all(abs(r["s"] - 0.2) < 0.02 for r in split)
    lonely = df.withColumn("rare", F.col("id") == "7")
    assert evaluation.stratified_split(lonely, "rare").count() == 1000


def test_quality_of_groups(spark):
    rng = np.random.default_rng(3)
    x = np.concatenate([rng.normal(c, 0.2, (10, 4)) for c in (0, 3, 6)])
    rows = [(i, *map(float, v), i // 10) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "nr bigint, a double, b double, c double, d double, label int")
    got = quality.evaluate_clustering(df, list("abcd"), "label", "nr").first()
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(2))
    lab = np.arange(30) // 10
    s = []
    for i in range(30):
        a = d[i, lab == lab[i]].sum() / 9
        b = min(d[i, lab == o].mean() for o in range(3) if o != lab[i])
        s.append((b - a) / max(a, b))
    assert got["silhouette_score"] == pytest.approx(np.mean(s), abs=1e-4) and got["n_clusters"] == 3
    single = quality.evaluate_clustering(df.withColumn("label", F.lit(0)), list("abcd"), "label", "nr").first()
    assert single["silhouette_score"] == -1.0 and single["davies_bouldin"] is None


def test_isolation_flags_the_extreme_row(spark, table):
    forest = isolation.fit_forest(table, "row_no")
    assert forest.nodes.select("tree").distinct().count() == 200
    rows = isolation.add_isolation(table, forest).collect()
    scores = {r["row_no"]: r["price_anomaly_score"] for r in rows}
    assert scores[119] == max(scores.values()) == 1.0 and min(scores.values()) == 0.0
    assert 1 <= sum(r["iforest_outlier"] for r in rows) <= 12


def test_small_table_repeats_rows_over_trees_not_within(spark, table):
    samples, size = isolation.tree_samples(table.limit(30), ["price", "rating"], "row_no", 50, 16, 1)
    per_tree = samples.groupBy("tree").agg(F.count("*").alias("n"), F.countDistinct("_order").alias("d")).collect()
    assert len(per_tree) == 50 and all(r["n"] == r["d"] == size == 16 for r in per_tree)


def test_projection_equals_eigenvectors(spark, table):
    scaled = segment.zscore(table, segment.CLUSTER_FEATURES)
    names = [f"z_{c}" for c in segment.CLUSTER_FEATURES]
    got = projection.add_projection(scaled, names, 3).select("PC1", "PC2", "PC3", "pca_variance_explained").toPandas()
    x = scaled.select(*names).toPandas().to_numpy()
    values = np.sort(np.linalg.eigvalsh(np.cov(x.T)))[::-1]
    assert got[["PC1", "PC2", "PC3"]].var().to_numpy() == pytest.approx(values[:3])
    assert got["pca_variance_explained"][0] == pytest.approx(values[:2].sum() / values.sum() * 100, abs=0.01)


def test_binary_forest_beats_chance(spark):
    rng = np.random.default_rng(1)
    rows = [(f"p{i}", float(a), float(b), int(a + 0.3 * b + rng.normal(0, 0.5) > 0.8)) for i, (a, b) in enumerate(rng.normal(0, 1, (400, 2)))]
    df = spark.createDataFrame(rows, "id string, a double, b double, y_top int")
    trained = supervised.train_binary(df, ["a", "b"], "y_top", rounds=15)
    row = trained.metrics.first()
    assert 0.5 < row["auc_roc"] < 0.999 and row["accuracy"] > 0.45 and 0 <= trained.threshold <= 1
    assert supervised.feature_importance(trained).first()["feature"] == "a"


def test_segments_are_trained_once_then_only_scored(spark, table, tmp_path):
    folder = str(tmp_path / "models")
    first = flows.segment_catalog(table, "row_no", folder, n_init=2)
    row = first.agg(F.min("price_anomaly_score").alias("lo"), F.max("price_anomaly_score").alias("hi"), F.min("composite_score").alias("c0"), F.max("composite_score").alias("c1")).first()
    assert row["lo"] == 0.0 and row["hi"] == 1.0 and 0 <= row["c0"] <= row["c1"] <= 1
    assert {"cluster_label", "dbscan_outlier", "is_anomaly", "PC1", "PC2", "is_top_product"} <= set(first.columns)
    assert load_models(spark, folder) is not None
    again = flows.segment_catalog(table, "row_no", folder).select("row_no", F.col("cluster").alias("c2"), F.col("composite_score").alias("s2"), "is_anomaly")
    both = first.select("row_no", "cluster", "composite_score").join(again, "row_no").collect()
    assert all(r["cluster"] == r["c2"] for r in both)
    # Inference does not lower the score of anomalies, training does.
    assert all(r["composite_score"] == pytest.approx(r["s2"] * (0.9 if r["is_anomaly"] else 1.0)) for r in both)
    assert load_models(spark, str(tmp_path / "none")) is None


def test_tiny_and_empty_inputs_get_defaults(spark, table):
    assert "PC1" in flows.train_segments(table.limit(0), "row_no")[0].columns
    five = flows.segment_catalog(table.limit(5), "row_no", n_init=1).collect()
    assert len(five) == 5 and all(r["dbscan_cluster"] == 0 for r in five)


def test_validation_splits_records(spark):
    df = spark.createDataFrame(
        [("1", "a", 5.0, "u", "x", None), (None, "b", 5.0, "u", "x", None), ("3", "c", -1.0, "u", "x", None), ("4", "d", 1.0, "u", "x", "?")],
        "id string, title string, price double, product_url string, source_platform string, extra string",
    )
    good, bad = validate_catalog(df)
    assert [r["id"] for r in good.collect()] == ["1"]
    assert sorted(f for r in bad.collect() for f in r["failures"]) == ["extra: unknown field", "id: missing", "price: below 0"]


def test_page_extraction_cases(spark):
    ld = '<script type="application/ld+json">%s</script>'
    pages = spark.createDataFrame(
        [
            (1, "https://a.b", ld % "{broken" + ld % '[{"@type":"Thing"},{"@type":"Product","name":"N","aggregateRating":{"ratingValue":4.5,"reviewCount":"12"},"image":["i"],"offers":{"price":9.5}}]'),
            (2, "https://a.b/", '<div data-rating="x"><i>3.5</i></div><button disabled>Ajouter</button>'),
            (3, "https://a.b/", ld % '{"@type":"Product","url":"/q","offers":{"price":"1,5"}}'),
        ],
        "page_id bigint, url string, html string",
    )
    seen = {r["page_id"]: (r["rating"], r["review_count"], r["is_in_stock"]) for r in normalize.extract_page_observations(pages).collect()}
    assert seen == {1: (4.5, 12, True), 2: (3.5, None, False), 3: (None, None, True)}
    got = {r["page_id"]: (r["price"], r["currency"], r["product_url"], r["image_url"]) for r in normalize.extract_jsonld_products(pages).collect()}
    assert got == {1: (9.5, "MAD", "", "i"), 3: (1.5, "MAD", "https://a.b/q", "")}


def test_latest_file_and_array_json(spark, tmp_path):
    for name, n in (("old.json", 1), ("new.json", 2)):
        (tmp_path / name).write_text(json.dumps([{"id": str(i), "title": "t", "price": 1.5} for i in range(n)]))
        time.sleep(1.1)
    assert files.read_latest(spark, str(tmp_path)).count() == 2
    with pytest.raises(FileNotFoundError):
        files.latest_file(spark, str(tmp_path), "*.none")


def test_published_fallbacks(spark, tmp_path):
    folder = str(tmp_path)
    assert files.read_published(spark, folder)["final"] is None
    files.write_table(spark.createDataFrame([("a", 1.0, ["x", "y"])], "title string, price double, tags array<string>"), folder, "products_processed")
    found = files.read_published(spark, folder)
    assert found["topk"].count() == 1 and found["rules"].count() == 0 and found["pca"] is None
    files.export_csv(found["final"], folder, "out.csv")
    assert spark.read.option("header", True).csv(f"{folder}/out.csv").first()["tags"] == "x,y"


def test_failed_visits_are_never_retried(spark, tmp_path):
    products = spark.createDataFrame([("1",), ("2",), ("3",)], "id string")
    done = spark.createDataFrame([("1", "success"), ("2", "error")], "id string, enrichment_status string")
    assert [r["id"] for r in en.pending_products(products, done).collect()] == ["3"]
    assert en.pending_products(products, en.read_done(spark, str(tmp_path / "gone"))).count() == 3


def test_stream_equals_batch_and_restart_adds_nothing(spark, tmp_path):
    source, out, check = (str(tmp_path / n) for n in ("in", "out", "check"))
    spark.range(1000).repartition(5).write.parquet(source)
    for _ in range(2):
        rows = en.file_stream(spark, source, "id bigint", 2).selectExpr("id", "id * 2 as twice")
        query = en.append_stream(rows, out, check)
        query.awaitTermination()
    assert spark.read.parquet(out).count() == 1000
    spark.range(1000, 1100).write.mode("append").parquet(source)
    en.append_stream(en.file_stream(spark, source, "id bigint", 2).selectExpr("id", "id * 2 as twice"), out, check).awaitTermination()
    assert spark.read.parquet(out).agg(F.sum("twice")).first()[0] == 1099 * 1100
    en.score_stream(en.file_stream(spark, source, "id bigint", 3), lambda b: b.selectExpr("id + 1 as s"), str(tmp_path / "scored"), str(tmp_path / "c2")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "scored")).count() == 1100
