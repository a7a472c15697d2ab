"""Parser vectors."""

import pytest
from pyspark.sql import functions as F

from vitrine.functions import parsing


def apply(spark, fn, values, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r["out"] for r in df.select("i", fn(F.col("v")).alias("out")).orderBy("i").collect()]


def test_price_texts(spark):
    texts = [
        "1 200,50 MAD", "15,99", "15€", "MAD 250", "Lot de 3 t-shirts pour 45.50 MAD", "Gratuit", "", None,
        "1 200,50", "1 200", "1.200,50", "3 45.50", "-5",
    ]
    assert apply(spark, parsing.parse_price, texts) == [1200.5, 15.99, 15.0, 250.0, 45.5, 0.0, 0.0, 0.0, 1200.5, 1200.0, 50.0, 345.5, 5.0]


def test_price_numbers(spark):
    assert apply(spark, lambda c: parsing.parse_price(c, "double"), [150.0, -3.0, None], "double") == [150.0, 0.0, 0.0]


def test_ratings(spark):
    texts = ["4,5/5", "4.5 stars", "N/A", None, " - ", "9", "17 sur 20", "aucune"]
    assert apply(spark, parsing.parse_rating, texts) == [4.5, 4.5, None, None, None, 4.5, None, None]
    assert apply(spark, lambda c: parsing.parse_rating(c, "double"), [4.0, 7.0, -1.0], "double") == [4.0, None, None]


def test_review_counts(spark):
    assert apply(spark, parsing.parse_review_count, ["1 234 avis", "(56)", None, "aucun"]) == [1234, 56, None, None]
    assert apply(spark, lambda c: parsing.parse_review_count(c, "bigint"), [-4, 7, None], "bigint") == [0, 7, None]


def test_page_helpers(spark):
    assert apply(spark, lambda c: parsing.page_id(c, "woo"), ["https://a.b/c/d//", "", None]) == ["woo_d", "woo_unknown", "woo_unknown"]
    assert apply(spark, parsing.stars_to_five, ["Rated 4.5 out of 5", "Rated 7 out of 10", "x", None]) == [4.5, 3.5, None, None]
    assert apply(spark, parsing.first_number, ["dès 12,5 puis 99", "rien", None]) == [12.5, 0.0, 0.0]
    assert apply(spark, parsing.strip_html, ["<p>a <b>b</b></p> ", None]) == ["a b", ""]


@pytest.mark.parametrize("positive,want", [(True, [20.0, 0.0, 0.0, 0.0]), (False, [20.0, 0.0, 0.0, 100.0])])
def test_discount(spark, positive, want):
    df = spark.createDataFrame([(0, 80.0, 100.0), (1, 100.0, 80.0), (2, 10.0, None), (3, 0.0, 5.0)], "i int, p double, o double")
    got = df.select("i", parsing.discount_percent(F.col("p"), F.col("o"), positive).alias("d")).orderBy("i").collect()
    assert [r["d"] for r in got] == want
