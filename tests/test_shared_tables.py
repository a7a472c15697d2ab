"""Shared tables: what is written, and what a query reads of the rest."""

from datetime import datetime

from pyspark.sql import functions as F

from vitrine import stages
from vitrine.operators import clean, features, segment


def _listings(spark, rows):
    return spark.createDataFrame(
        [(f"p{i % 7}", f"title {i % 7}" if i % 5 else None, float(i % 7), 9.0, None, 3, 2, True, "c", None, "b", "s", i, datetime(2024, 1, 1)) for i in range(rows)],
        "id string, title string, price double, original_price double, rating double, review_count long, stock long, is_in_stock boolean, "
        "category string, sub_category string, brand string, shop_name string, ingest_seq long, scraped_at timestamp",
    )


def test_clean_standard_runs_its_source_once(spark):
    done = clean.clean_standard(_listings(spark, 40), ["ingest_seq", "scraped_at"])
    plan = done._jdf.queryExecution().optimizedPlan().toString()
    assert "row_number" not in plan and "kept-rows" in " ".join(done.inputFiles())
    found = {r["id"]: r["price"] for r in done.collect()}
    assert found == {"p1": 1.0, "p2": 2.0, "p3": 3.0, "p4": 4.0, "p6": 6.0}


def test_stage_restores_the_method_limit(spark):
    name = "spark.sql.codegen.hugeMethodLimit"
    before = spark.conf.get(name)
    with stages.compiled_methods(spark):
        assert spark.conf.get(name) == "8000"
    assert stages.stage(spark.range(3)).count() == 3 and spark.conf.get(name) == before


def test_moments_are_taken_once(spark):
    scaled = segment.zscore(_listings(spark, 30), ["price"])
    assert "stddev" not in scaled._jdf.queryExecution().optimizedPlan().toString().lower()
    assert abs(scaled.agg(F.avg("z_price")).first()[0]) < 1e-9


def test_unread_statistics_are_not_joined(spark):
    kept = clean.clean_standard(_listings(spark, 40), ["ingest_seq", "scraped_at"])
    done = features.add_features(kept)

    def joins(table):
        return table._jdf.queryExecution().optimizedPlan().toString().count("Join LeftOuter")

    assert joins(done.select("id", "rating_score", "log_price", "discount_score")) == 0
    assert joins(done.agg(F.avg("popularity_score"))) == 0
    every = done.select("id", *features.FEATURES).collect()
    assert joins(done.select("id", *features.FEATURES)) == 3 and sorted(r["id"] for r in every) == ["p1", "p2", "p3", "p4", "p6"]
