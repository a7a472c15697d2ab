"""Cases that earlier versions got wrong."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from vitrine.operators import evaluation, normalize, rules
from vitrine.plans import tools
from vitrine.streaming import enrichment


def page(spark, *htmls):
    return spark.createDataFrame([(i, "https://m.example.com/", h) for i, h in enumerate(htmls)], "page_id int, url string, html string")


def test_structured_data_in_any_quotes(spark):
    item = '{"@type": "Product", "name": "n", "image": [], "description": "d"}'
    pages = page(spark, *[f"<script {t}>{item}</script>" for t in ("type='application/ld+json'", 'TYPE = "application/ld+json" x', "type=application/ld+json")])
    found = normalize.extract_jsonld_products(pages).collect()
    assert [(r["title"], r["description"], r["image_url"], r["price"]) for r in found] == [("n", "d", "", 0.0)] * 3


def test_null_rating_is_no_rating(spark):
    script = '<script type="application/ld+json">[{"@type": "Product", "aggregateRating": null}, {"@type": "Product", "aggregateRating": {"ratingValue": "4"}}]</script>'
    badge = '<div class="spr-badge-caption"><div>x</div> 4.5</div>'
    found = normalize.extract_page_observations(page(spark, script, badge, badge * 2, "<div class='a'>7</div>")).orderBy("page_id").collect()
    assert [r["rating"] for r in found] == [4.0, 4.5, 4.5, None]


def test_itemsets_stop_at_the_length_limit(spark):
    items = [f"c{i:02d}" for i in range(30)]
    baskets = spark.createDataFrame([(b, items) for b in "abcdef"], "basket_id string, items array<string>")
    found = rules.frequent_itemsets(baskets, min_support=0.5, max_len=3)
    assert found.count() == 30 + 435 + 4060 and found.filter("freq != 6 OR support != 1").isEmpty()


def test_levelwise_equals_fp_growth(spark):
    rows = [(b, sorted({f"i{(b * k) % 7}" for k in range(1, 5)})) for b in range(40)]
    baskets = spark.createDataFrame(rows, "basket_id int, items array<string>")
    whole = {(tuple(r["items"]), r["freq"]) for r in rules.frequent_itemsets(baskets, 0.1).collect() if len(r["items"]) <= 3}
    assert {(tuple(r["items"]), r["freq"]) for r in rules.frequent_itemsets(baskets, 0.1, max_len=3).collect()} == whole


def test_rules_of_a_long_itemset(spark):
    items = [f"c{i:02d}" for i in range(13)]
    sets = spark.range(1, 2**13).select(F.filter(F.array(*map(F.lit, items)), lambda x, i: F.getbit("id", i) == 1).alias("items"), F.lit(0.5).alias("support"))
    assert rules.generate_rules(sets).count() == 3**13 - 2 * 2**13 + 1


def test_split_keeps_rows_without_a_class(spark):
    rows = spark.range(100).select(F.col("id").cast("string").alias("id"), F.when(F.col("id") % 10 > 0, F.col("id") % 3).alias("k"))
    assert evaluation.stratified_split(rows, "k").count() == 100


def test_unreadable_checkpoint_starts_over(spark, tmp_path):
    (tmp_path / "part-0.parquet").write_bytes(b"not parquet at all")
    assert enrichment.read_done(spark, str(tmp_path)).count() == 0


def test_bad_pattern_is_an_error_reply(spark):
    catalog = spark.createDataFrame([("a", "red")], "id string, title string")
    assert not tools.call_tool("search_products", {"query": "["}, catalog).ok


@pytest.mark.parametrize("name", ["vitrine", "vitrine.operators.isolation"])
def test_workers_import_the_package(spark, name):
    from vitrine.workers import ship_package

    ship_package(spark)

    def run(batches):
        import importlib

        importlib.import_module(name)
        yield from batches

    assert spark.range(1).mapInPandas(run, "id long").count() == 1
