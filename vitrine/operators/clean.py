"""Cleaning: the standard definition and the strict one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.parsing import discount_percent
from ..functions.quantiles import quantile_scalar
from ..functions.scalars import clip, have, is_blank
from ..stages import release, stage

UNKNOWN = "Inconnu"
CATEGORICAL = ["category", "sub_category", "brand", "shop_name"]
MOST_BITS = 1 << 27


def dedup_first(df: DataFrame, keys: list[str], arrival: list[str]) -> DataFrame:
    """Keep the first arrival per key; null keys count as equal.

    Keys are counted first, from the key and arrival columns alone. Rows whose key comes once are kept as they are
    and never shuffled. Of the others, rows whose leading arrival value is the least of their key are ranked by
    the whole order. Both choices are filters on bits, which let some other rows through to the ranking but never
    drop a first arrival; they move below joins and projections to the table that has their columns.
    """
    order = Window.partitionBy(*keys).orderBy(*arrival)
    repeated, least = _choices(df, keys, arrival[0])
    # The == 1 filter lets Spark place a WindowGroupLimit before the shuffle: a hot key does not travel whole.
    ranked = df.filter(repeated & least).withColumn("_nth", F.row_number().over(order)).filter("_nth = 1").drop("_nth")
    return df.filter(~repeated).union(ranked)


def _choices(df: DataFrame, keys: list[str], lead: str) -> tuple[Column, Column]:
    """Two conditions on a row of ``df``: its key may come more than once; and, among such rows, ``lead`` may be the
    least of the key (null is least)."""
    least = F.when(F.count_if(F.col(lead).isNull()) == 0, F.min(lead)).alias(lead)
    counts = df.groupBy(*keys).agg(least, F.count("*").alias("n"))
    counts = stage(counts.select(F.xxhash64(*keys).alias("key"), F.xxhash64(*keys, lead).alias("first"), (F.col("n") > 1).alias("again")), "key-counts")
    repeated = _bits_of(counts.filter("again").select("key"))
    first = _bits_of(counts.filter(repeated(F.col("key"))).select("first"))
    release(counts)
    return repeated(F.xxhash64(*keys)), first(F.xxhash64(*keys, lead))


def _bits_of(hashes: DataFrame) -> Callable[[Column], Column]:
    """A Bloom filter of the one column of 64-bit hashes: two bits each, at most ``MOST_BITS`` in all, as an array that
    is a scalar of the plan."""
    words = min(max(1, hashes.count() // 4), MOST_BITS >> 6)

    def places(h: Column) -> list[Column]:
        return [F.pmod(part, F.lit(words << 6)) for part in (h.bitwiseAND(0xFFFFFFFF), F.shiftright(h, 32))]

    at = hashes.select(F.explode(F.array(*places(F.col(hashes.columns[0])))).alias("at"))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("at").bitwiseAND(63).cast("int"))
    found = at.groupBy(F.shiftright("at", 6).alias("id")).agg(F.bit_or(bit).alias("bits"))
    every = hashes.sparkSession.range(words).join(found, "id", "left").select("id", F.coalesce("bits", F.lit(0).cast("long")).alias("bits"))
    bits = stage(every.agg(F.array_sort(F.collect_list(F.struct("id", "bits")))["bits"].alias("bits")), "key-bits").scalar()

    def test(h: Column) -> Column:
        one, two = [
            F.call_function("shiftright", F.get(bits, F.shiftright(at, 6).cast("int")), at.bitwiseAND(63).cast("int")).bitwiseAND(1) == 1 for at in places(h)
        ]
        return one & two

    return test


def dedup_keys(df: DataFrame) -> list[str]:
    return ["id"] if "id" in df.columns else ["title", "source_platform"]


def drop_untitled(df: DataFrame) -> DataFrame:
    return df.filter(~is_blank(F.col("title")))


def median_price(df: DataFrame) -> Column:
    """Median of the positive prices as a scalar.

    Prices are counted first: one counter per price and task crosses the network, and the
    counts are staged, so the wide rows are read once here and not once per descent step.
    """
    counts = stage(df.filter("price > 0").groupBy("price").agg(F.count("*").alias("n")), "price-counts")
    return quantile_scalar(counts, "price", 0.5, weight="n")


def impute_price(df: DataFrame, median: Column) -> DataFrame:
    missing = F.col("price").isNull() | (F.col("price") == 0)
    return df.withColumn("price", F.when(missing, median).otherwise(F.col("price")))


def default_original_price(df: DataFrame) -> DataFrame:
    known = F.col("original_price") if "original_price" in df.columns else F.lit(None).cast("double")
    return df.withColumn("original_price", F.coalesce(known, F.col("price")))


def add_discount(df: DataFrame) -> DataFrame:
    return df.withColumn("discount_percentage", discount_percent(F.col("price"), F.col("original_price"), False))


def default_numbers(df: DataFrame) -> DataFrame:
    columns = {
        "rating": clip(F.coalesce(F.col("rating"), F.lit(0.0)), 0.0, 5.0),
        "review_count": F.coalesce(F.col("review_count").cast("long"), F.lit(0).cast("long")),
        "stock": F.coalesce(F.col("stock").cast("long"), F.lit(0).cast("long")),
    }
    if "is_in_stock" in df.columns:
        columns["is_in_stock"] = F.coalesce(F.col("is_in_stock").cast("boolean"), F.lit(True))
    return df.withColumns(columns)


def default_categories(df: DataFrame) -> DataFrame:
    columns = {c: F.coalesce(F.col(c), F.lit(UNKNOWN)) for c in have(df, CATEGORICAL)}
    columns.setdefault("category", F.lit(UNKNOWN))
    return df.withColumns(columns)


def flatten_arrays(df: DataFrame) -> DataFrame:
    """Arrays to text: tags as a comma list, variants as JSON ('[]' when missing)."""
    kinds = dict(df.dtypes)
    columns = {}
    if "tags" in kinds:
        tags = F.array_join("tags", ",") if kinds["tags"].startswith("array") else F.col("tags")
        columns["tags"] = F.coalesce(tags, F.lit(""))
    if "variants" in kinds:
        text = F.to_json("variants") if kinds["variants"].startswith("array") else F.lit(None)
        columns["variants"] = F.coalesce(text, F.lit("[]"))
    return df.withColumns(columns) if columns else df


def clean_standard(df: DataFrame, arrival: list[str], flatten: bool = True) -> DataFrame:
    """De-duplicate, drop untitled rows, impute and default.

    The kept rows are a stage table, so the joins behind ``df`` and the de-duplication run once for the
    median and the result; what follows are plain expressions on it, of which a reader computes its columns.
    """
    kept = stage(drop_untitled(dedup_first(df, dedup_keys(df), arrival)), "kept-rows")
    priced = default_original_price(impute_price(kept, median_price(kept)))
    done = default_categories(default_numbers(add_discount(priced)))
    return flatten_arrays(done) if flatten else done


def strict_names(df: DataFrame) -> tuple[str, str]:
    return (
        "product_id" if "product_id" in df.columns else "id",
        "name" if "name" in df.columns else "title",
    )


def clean_strict(df: DataFrame, arrival: list[str]) -> DataFrame:
    """Reject what the packaged flow rejects: no name or price, price outside (0, 10000),
    rating outside [0, 5]. Unreadable numbers are null, then 0 for rating and review count."""
    key, name = strict_names(df)
    number = {c: F.col(c).try_cast("double") for c in ("price", "rating", "review_count")}
    return (
        dedup_first(df, [key], arrival)
        .filter(F.col(name).isNotNull() & F.col("price").isNotNull())
        .withColumns(
            {
                "price": number["price"],
                "rating": F.coalesce(number["rating"], F.lit(0.0)),
                "review_count": F.coalesce(number["review_count"], F.lit(0.0)),
            }
        )
        .filter((F.col("price") > 0) & (F.col("price") < 10000) & F.col("rating").between(0, 5))
    )


def clean_strict_counts(df: DataFrame, arrival: list[str]) -> DataFrame:
    """One row: rows before, rows after, rows removed. Two counts, no join."""
    after = clean_strict(df, arrival).agg(F.count("*").alias("n")).select("n").scalar()
    return df.agg(F.count("*").alias("initial_products")).select(
        "initial_products",
        after.alias("cleaned_products"),
        (F.col("initial_products") - after).alias("duplicates_removed"),
    )
