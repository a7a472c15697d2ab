"""The canonical product schema and its validation rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

VARIANT = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("title", T.StringType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("sku", T.StringType()),
    ]
)

PRODUCT = T.StructType(
    [
        T.StructField("id", T.StringType(), False),
        T.StructField("title", T.StringType(), False),
        T.StructField("description", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("sub_category", T.StringType()),
        T.StructField("brand", T.StringType()),
        T.StructField("tags", T.ArrayType(T.StringType())),
        T.StructField("image_url", T.StringType()),
        T.StructField("product_url", T.StringType(), False),
        T.StructField("price", T.DoubleType(), False),
        T.StructField("original_price", T.DoubleType()),
        T.StructField("currency", T.StringType()),
        T.StructField("rating", T.DoubleType()),
        T.StructField("review_count", T.LongType()),
        T.StructField("stock", T.LongType()),
        T.StructField("is_in_stock", T.BooleanType()),
        T.StructField("shop_name", T.StringType()),
        T.StructField("shop_country", T.StringType()),
        T.StructField("variants", T.ArrayType(VARIANT)),
        T.StructField("source_platform", T.StringType(), False),
        T.StructField("scraped_at", T.TimestampType()),
    ]
)

REQUIRED = ["id", "title", "product_url", "source_platform", "price"]


# Read schemas of the raw platform files.
STOREFRONT = (
    "id string, title string, handle string, body_html string, vendor string, product_type string, tags string, "
    "variants array<struct<id: string, title: string, price: string, compare_at_price: string, sku: string, "
    "inventory_quantity: bigint, available: boolean>>, images array<struct<src: string>>, store string"
)

WOO = (
    "id string, name string, slug string, permalink string, price string, regular_price string, sale_price string, "
    "manage_stock boolean, stock_quantity bigint, stock_status string, categories array<struct<name: string>>, "
    "tags array<struct<name: string>>, images array<struct<src: string>>, average_rating string, rating_count bigint, "
    "short_description string, description string"
)


def _failures(df: DataFrame) -> list[Column]:
    def rule(broken: Column, name: str) -> Column:
        return F.when(broken, F.lit(name))

    known = {f.name for f in PRODUCT.fields}
    rules = [rule(F.col(c).isNull(), f"{c}: missing") if c in df.columns else F.lit(f"{c}: missing") for c in REQUIRED]
    for name in ("price", "original_price", "review_count", "stock"):
        if name in df.columns:
            rules.append(rule(F.col(name) < 0, f"{name}: below 0"))
    if "rating" in df.columns:
        rules.append(rule(~F.col("rating").between(0, 5), "rating: outside 0..5"))
    rules += [rule(F.col(c).isNotNull(), f"{c}: unknown field") for c in df.columns if c not in known]
    return rules


def with_failures(df: DataFrame) -> DataFrame:
    """Add ``failures``: the names of the rules each record breaks."""
    return df.withColumn("failures", F.array_compact(F.array(*_failures(df))))


def validate_catalog(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid, rejected); rejected rows keep their ``failures``, the rest goes on."""
    checked = with_failures(df)
    good = F.size("failures") == 0
    return checked.filter(good).drop("failures"), checked.filter(~good)
