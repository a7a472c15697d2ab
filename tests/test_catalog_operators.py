"""Cleaning, features, segmentation and tools: properties and exact vectors."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from vitrine.operators import clean, features, rules, segment
from vitrine.plans import arguments as args
from vitrine.plans import dashboard, tools
from vitrine.stages import stage
from vitrine.suite import data

SCHEMA = (
    "id string, title string, price double, original_price double, rating double, review_count bigint, stock bigint, "
    "category string, source_platform string, shop_name string, nr int"
)


def cleaned(df, flatten=True):
    return stage(clean.clean_standard(df, ["nr"], flatten))


def products(n=50, defects=False):
    rng = np.random.default_rng(42)
    rows = []
    for i in range(n):
        row = [
            f"p{i}", f"Produit {i}", float(rng.uniform(50, 2000)), float(rng.uniform(100, 2500)), float(rng.uniform(0, 5)),
            int(rng.integers(0, 500)), int(rng.integers(0, 100)), "ABCD"[i % 4], ["shopify", "woocommerce"][i % 2], "ShopA ShopB ShopC".split()[i % 3], i,
        ]
        if defects:
            row[2] = 0.0 if i < 5 else row[2]
            row[4] = None if 5 <= i < 10 else row[4]
            row[6] = None if 10 <= i < 15 else row[6]
            row[1] = "" if i == 15 else row[1]
        rows.append(tuple(row))
    return rows


@pytest.fixture(scope="module")
def catalog(spark):
    return spark.createDataFrame(products(defects=True), SCHEMA).cache()


def test_cleaning_properties(spark, catalog):
    doubled = catalog.unionAll(catalog.filter("nr = 0").withColumns({"nr": F.lit(99), "price": F.lit(1.0)}))
    rows = clean.clean_standard(doubled, ["nr"]).collect()
    assert len(rows) == 49 and {r["nr"] for r in rows} == set(range(50)) - {15}
    assert all(r["price"] > 0 and r["discount_percentage"] >= 0 and 0 <= r["rating"] <= 5 for r in rows)
    median = float(np.median([p[2] for p in products(defects=True) if p[2] > 0 and p[1]]))
    assert all(r["price"] == pytest.approx(median) for r in rows if r["nr"] < 5)


def test_null_ids_are_one_product(spark):
    df = spark.createDataFrame([(None, "a", 1), (None, "b", 2), ("x", "c", 3)], "id string, title string, nr int")
    assert sorted(r["title"] for r in clean.dedup_first(df, ["id"], ["nr"]).collect()) == ["a", "c"]


def test_untitled_means_unicode_blank(spark):
    df = spark.createDataFrame([("  \t",), (" a ",), (None,), ("",)], "title string")
    assert [r["title"] for r in clean.drop_untitled(df).collect()] == [" a "]


def test_strict_reads_other_names_and_bad_numbers(spark):
    df = spark.createDataFrame(
        [("1", "a", "12.5", "x", "3", 1), ("1", "b", "1", "1", "1", 2), ("2", "c", "oops", "1", "1", 3), ("3", "d", "10000", "1", "1", 4), ("4", "e", "5", "6", "1", 5)],
        "product_id string, name string, price string, rating string, review_count string, nr int",
    )
    got = clean.clean_strict(df, ["nr"]).collect()
    assert [(r["name"], r["price"], r["rating"]) for r in got] == [("a", 12.5, 0.0)]


@pytest.mark.parametrize("variant", ["max", "q95"])
def test_features_lie_in_unit_interval(spark, catalog, variant):
    table = features.add_features(cleaned(catalog), variant)
    names = [c for c in features.FEATURES if c != "log_reviews"]
    row = table.agg(*[f(c).alias(f"{p}{c}") for c in names for p, f in (("lo_", F.min), ("hi_", F.max))]).first()
    assert all(-1e-12 <= row[f"lo_{c}"] and row[f"hi_{c}"] <= 1 + 1e-12 for c in names)


def test_constant_half_when_robust_scale_is_zero(spark, catalog):
    """Without discounts the robust discount score is .5 for all, and every row is flagged."""
    flat = cleaned(catalog.withColumn("original_price", F.col("price"))).withColumn("discount_percentage", F.lit(0.0))
    got = features.add_features(flat, "q95").select("discount_score", "has_discount_flag").distinct().collect()
    assert [(r[0], r[1]) for r in got] == [(0.5, 1.0)]


def test_flattened_tags_count_as_none_in_the_max_family(spark, catalog):
    tagged = catalog.withColumn("tags", F.array(F.lit("a"), F.lit("b")))
    text = features.add_features(cleaned(tagged), "max")
    arrays = features.add_features(cleaned(tagged, False), "max")
    assert text.agg(F.max("tag_diversity")).first()[0] == 0.0 and arrays.agg(F.min("tag_diversity")).first()[0] == 1.0


def test_targets_and_leaks_never_become_features(spark, catalog):
    table = features.add_features(cleaned(catalog), "q95").withColumns({"is_top_product": F.lit(1), "cluster": F.lit(0)})
    assert features.resolve_target(table) == "is_top_product"
    chosen = features.select_model_features(table, [*features.FEATURES, "cluster", "is_top_product", "composite_score"], "is_top_product", features.LEAKAGE["top"])
    assert not set(chosen) & {"cluster", "is_top_product", "composite_score", *features.LEAKAGE["top"]}
    with pytest.raises(KeyError):
        features.resolve_target(catalog)


def test_profile_uses_stored_bounds(spark):
    centres = spark.createDataFrame([(0, 10.0, 20.0, 75.0), (1, 30.0, 40.0, 75.0)], "cluster int, log_price double, rating_score double, discount_score double")
    bounds = {c: {"min": 0.0, "max": 100.0} for c in ("log_price", "rating_score", "discount_score")}
    got = segment.profile_clusters(centres, bounds).orderBy("cluster").collect()
    assert [r["log_price"] for r in got] == [0.1, 0.3] and got[1]["rating_score"] == 0.4
    assert [r["discount_score"] for r in got] == [0.0, 0.0] and [r["stock_score"] for r in got] == [0.0, 0.0]


def test_names_are_chosen_greedily(spark):
    columns = ["log_price", "rating_score", "popularity_score", "discount_score"]
    centres = [[1, 1, 0.6, 0], [0, 0, 0.2, 1], [0.4, 0.8, 1, 0.1], [0.2, 0.1, 0, 0], [0.5, 0.5, 0.5, 0.5]]
    got = {r["cluster"]: r["cluster_label"] for r in segment.name_clusters(segment.centre_table(spark, columns, centres)).collect()}
    assert got == {0: "Premium", 1: "Budget", 2: "Populaire", 3: "Inactif", 4: "Inconnu"}


def test_zscore_of_constant_and_null(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0), (None, 5.0)], "a double, b double")
    rows = segment.zscore(df, ["a", "b"]).orderBy("a").collect()
    assert [r["z_b"] for r in rows] == [0, 0, 0] and rows[0]["z_a"] == pytest.approx((0 - 4 / 3) / np.std([1, 3, 0]))
    assert segment.zscore(df, ["a"], {"a": (1.0, 2.0)}).orderBy("a").collect()[2]["z_a"] == 1.0


def test_tool_arguments_are_strict(spark, catalog):
    bad = [("get_top_products", {"limit": 51}), ("get_top_products", {"limit": "5"}), ("get_catalog_stats", {"group_by": "brand"}), ("search_products", {"colour": 1})]
    for name, values in bad:
        reply = tools.call_tool(name, values, catalog)
        assert not reply.ok and reply.details
    assert not tools.call_tool("drop_table", {}, catalog).ok
    assert not tools.call_tool("get_anomalies", {}, catalog).ok
    assert not tools.call_tool("get_association_rules", {}, catalog, None).ok
    assert not tools.call_tool("search_products", {"query": "x"}, catalog.limit(0)).ok
    assert tools.call_tool("search_products", {"query": "PRODUIT 1", "min_price": 1}, catalog).frame.count() > 0
    with pytest.raises(args.BadArguments):
        args.Anomalies.read({"limit": True})


def test_top_products_total_counts_after_the_limit(spark, sf):
    got = tools.with_total(tools.top_products(data.published(spark, sf), args.TopProducts(limit=3)), "total").collect()
    assert len(got) == 3 and {r["total"] for r in got} == {3}


def test_price_bounds_widen(spark):
    one = spark.createDataFrame([(5.0,)], "price double")
    assert tuple(dashboard.price_bounds(one).first()) == (4.0, 6.0)
    assert tuple(dashboard.price_bounds(one.limit(0)).first()) == (0.0, 1000.0)


def test_rules_against_hand_counts(spark):
    rows = [(b, i) for b, items in enumerate(["abc", "ab", "ac", "b", "abc"]) for i in items]
    df = spark.createDataFrame(rows, "shop_name bigint, category string")
    found = rules.generate_rules(rules.frequent_itemsets(rules.build_baskets(df), 0.1)).collect()
    rule = next(r for r in found if r["antecedents"] == ["a"] and r["consequents"] == ["b", "c"])
    assert (rule["support"], rule["confidence"]) == (0.5, 0.5) and rule["lift"] == pytest.approx(1.0)
    sure = next(r for r in found if r["antecedents"] == ["b"] and r["consequents"] == ["a"])
    assert sure["confidence"] == 1.0 and sure["conviction"] == float("inf")
    assert rules.mine_rules(df.filter("shop_name < 2"), "main").count() == 0


def test_hot_shop_baskets_hold_distinct_items_only(spark):
    df = spark.range(3000).selectExpr("'one' as shop_name", "concat('c', id % 3) as category")
    assert [r["items"] for r in rules.build_baskets(df).collect()] == [["c0", "c1", "c2"]]
