"""The driver's star schema seen as product listings.

One row per order line: a snapshot of an offer (part, supplier) as it was scraped. Offers recur,
so de-duplication has real work; missing and odd values follow from the line's own attributes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Order in which listings arrived; together with the id it is unique.
ARRIVAL = ["ingest_seq", "scraped_at"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _cents(value):
    return F.floor(value * 100 + 0.5) / 100.0


def listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw listings. nation and region have a fixed size (25 and 5 rows) and are broadcast;
    part and supplier grow with the data, so the optimizer picks their join from their size."""
    line = table(spark, sf_dir, "lineitem")
    part = table(spark, sf_dir, "part")
    supplier = table(spark, sf_dir, "supplier")
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    qty = F.col("l_quantity")
    unit = F.col("l_extendedprice") / qty
    stars = F.floor(F.col("l_tax") * 100 + 0.5) / 2.0 + 1.0
    words = F.split("p_name", " ")
    stock = F.when(F.col("l_linestatus") == "F", 0.0).otherwise(qty).cast("long")
    return (
        line.join(part, F.col("l_partkey") == F.col("p_partkey"))
        .join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(F.broadcast(nation), F.col("s_nationkey") == F.col("n_nationkey"))
        .join(F.broadcast(region), F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.concat_ws("-", F.col("l_partkey").cast("string"), F.col("l_suppkey").cast("string")).alias("id"),
            F.when(qty == 7, F.lit(" \u00a0 "))
            .when(qty == 11, F.lit(None))
            .otherwise(F.concat_ws(" ", "p_name", F.col("p_partkey").cast("string")))
            .alias("title"),
            F.when(F.col("l_discount") >= 0.05, F.concat(F.lit("<p>"), F.col("p_name"), F.lit("</p>")))
            .when(F.col("l_discount") >= 0.03, F.lit("  "))
            .alias("description"),
            F.when(F.col("p_size") < 50, F.col("p_type")).alias("category"),
            F.when(F.col("p_size") > 25, F.lit("large")).alias("sub_category"),
            F.when(F.col("s_acctbal") >= 500, F.col("p_brand")).alias("brand"),
            F.when(F.col("p_size") > 30, F.concat(words, F.array("p_type", "p_brand"))).otherwise(words).alias("tags"),
            F.when(F.col("p_size") >= 5, F.concat(F.lit("https://cdn.example.com/"), F.col("l_partkey").cast("string"))).alias("image_url"),
            F.concat(
                F.lit("https://shop"), F.col("l_suppkey").cast("string"), F.lit(".example.com/products/"), F.col("l_partkey").cast("string")
            ).alias("product_url"),
            F.when(qty == 17, 0.0).when(qty == 19, F.lit(None)).otherwise(_cents(unit * (1 - F.col("l_discount")))).alias("price"),
            F.when(F.col("l_discount") > 0, _cents(unit)).alias("original_price"),
            F.lit("MAD").alias("currency"),
            F.when((F.col("l_returnflag") == "N") & (F.col("l_linestatus") == "O"), F.lit(None))
            .when(F.col("l_returnflag") == "R", stars - 2.0)
            .when(F.col("l_returnflag") == "A", stars + 1.0)
            .otherwise(stars)
            .alias("rating"),
            F.when(qty != 23, (qty * F.col("l_linenumber")).cast("long")).alias("review_count"),
            F.when(qty != 29, stock).alias("stock"),
            F.when(qty != 29, stock > 0).alias("is_in_stock"),
            F.col("s_name").alias("shop_name"),
            F.col("n_name").alias("shop_country"),
            F.col("r_name").alias("source_platform"),
            F.col("l_linenumber").cast("long").alias("n_variants"),
            F.col("p_size").cast("long").alias("n_images"),
            F.col("l_shipdate").alias("scraped_at"),
            (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("ingest_seq"),
        )
    )
