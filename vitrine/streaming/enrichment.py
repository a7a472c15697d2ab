"""Incremental enrichment and streaming flows."""

from __future__ import annotations

from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.scalars import np_round
from ..operators.normalize import backfill_description

OBSERVATIONS = "id string, rating double, review_count bigint, is_in_stock boolean, stock bigint, enriched_at timestamp, enrichment_status string"


def read_done(spark: SparkSession, path: str) -> DataFrame:
    """Rows already enriched; a missing or unreadable table means starting over."""
    try:
        done = spark.read.parquet(path)
        if "id" in done.columns:
            return done
    except (PySparkException, Py4JJavaError):
        pass  # no table, or files whose schema cannot be read
    return spark.createDataFrame([], "id string")


def pending_products(products: DataFrame, done: DataFrame) -> DataFrame:
    """Products not yet processed. Failed rows are in ``done`` too and are never retried."""
    return products.join(done.select("id"), "id", "left_anti")


def merge_enrichment(products: DataFrame, observations: DataFrame) -> DataFrame:
    """Overwrite rating, review count and availability with what was observed, nulls included.

    A failed observation gives nulls and in stock; exact stock falls back to 1 or 0. Products
    without a URL, and products that were not visited, stay as they are. ``observations`` has
    one row per id.
    """
    seen = observations.select(
        "id", *[F.col(c).alias(f"_{c}") for c in ("rating", "review_count", "is_in_stock", "stock", "enriched_at", "enrichment_status")]
    )
    visited = F.col("_enrichment_status").isNotNull() & (F.coalesce("product_url", F.lit("")) != "")
    failed = F.col("_enrichment_status") == "error"

    def observed(value: Column, on_error: Column, old: Column) -> Column:
        return F.when(visited & failed, on_error).when(visited, value).otherwise(old)

    nothing = F.lit(None)
    old = lambda c, kind: F.col(c) if c in products.columns else nothing.cast(kind)
    fallback = F.when(F.col("_is_in_stock"), 1).otherwise(0).cast("long")
    merged = products.join(seen, "id", "left")
    return merged.select(
        *[c for c in products.columns if c not in ("rating", "review_count", "is_in_stock", "stock", "enriched_at", "enrichment_status")],
        observed(F.col("_rating"), nothing, F.col("rating")).alias("rating"),
        observed(F.col("_review_count"), nothing, F.col("review_count")).alias("review_count"),
        observed(F.col("_is_in_stock"), F.lit(True), F.col("is_in_stock")).alias("is_in_stock"),
        observed(F.coalesce("_stock", fallback), nothing, F.col("stock")).alias("stock"),
        F.when(visited, F.col("_enriched_at")).otherwise(old("enriched_at", "timestamp")).alias("enriched_at"),
        F.when(visited, F.col("_enrichment_status")).otherwise(old("enrichment_status", "string")).alias("enrichment_status"),
    )


def enrichment_report(enriched: DataFrame) -> DataFrame:
    rated = F.count_if(F.col("rating").isNotNull())
    share = F.coalesce(F.try_divide(rated, F.count("*")) * 100, F.lit(0.0))
    return enriched.agg(
        F.count("*").alias("processed"),
        F.count_if(F.col("enrichment_status") == "success").alias("success"),
        rated.alias("with_rating"),
        np_round(share, 1).alias("with_rating_pct"),
    )


# ---- streams ---------------------------------------------------------------------------------


def file_stream(spark: SparkSession, path: str, schema, files_per_batch: int = 50, kind: str = "parquet", pattern: str | None = None) -> DataFrame:
    """New files of a folder as a stream, a bounded number per micro-batch."""
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.format(kind).load(path)


def append_stream(rows: DataFrame, path: str, checkpoint: str, name: str | None = None) -> StreamingQuery:
    """Append micro-batches to a Parquet table until the input is used up.

    Offsets and the sink's commit log in the checkpoint make every batch all or nothing, and a
    restart goes on after the last committed batch.
    """
    writer = rows.writeStream.format("parquet").outputMode("append").option("compression", "zstd").option("path", path).option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    return writer.trigger(availableNow=True).start()


def staged_flow(raw: DataFrame, normalize: Callable[[DataFrame], DataFrame], path: str, checkpoint: str) -> StreamingQuery:
    """Read, normalise, describe, collect: one streaming query. Anomaly columns get their
    defaults here; the detectors fill them in the batch step."""
    described = backfill_description(normalize(raw))
    ready = described.withColumns({"price_anomaly_flag": F.lit(0), "price_anomaly_score": F.lit(0.0)})
    return append_stream(ready, path, checkpoint)


def score_stream(raw: DataFrame, score: Callable[[DataFrame], DataFrame], path: str, checkpoint: str) -> StreamingQuery:
    """Score every micro-batch with stored models. A batch writes its own folder and overwrites
    it when it is replayed, so a failure never doubles rows."""

    def write(batch: DataFrame, number: int) -> None:
        score(batch).write.mode("overwrite").parquet(f"{path}/batch={number}")

    return raw.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
