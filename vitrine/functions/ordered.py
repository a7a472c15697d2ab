"""Global order without a global window.

Running totals over a whole table are built in two steps: totals per range bucket, then a
window inside each bucket started at the bucket's offset. Bucket borders come from
approxQuantile and only balance the work; the result is exact for any borders.
"""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

_MAX_BUCKETS = 1000


def range_buckets(df: DataFrame, column: str, rows_per_bucket: int = 200_000, name: str = "range_bucket") -> DataFrame:
    """Add a range bucket number that grows with ``column`` (no nulls allowed)."""
    rows = df.count()
    wanted = max(1, min(_MAX_BUCKETS, -(-rows // rows_per_bucket)))
    cuts: list[float] = []
    df = df.withColumn("_at", F.col(column).cast("double"))
    if wanted > 1:
        probs = [i / wanted for i in range(1, wanted)]
        cuts = sorted(set(df.approxQuantile("_at", probs, 0.25 / wanted)))
    if not cuts:
        return df.drop("_at").withColumn(name, F.lit(0))
    splits = [float("-inf"), *cuts, float("inf")]
    bucketed = Bucketizer(splits=splits, inputCol="_at", outputCol=name).transform(df)
    return bucketed.withColumn(name, F.col(name).cast("int")).drop("_at")


def running_totals(df: DataFrame, order: str, sums: list[str], rows_per_bucket: int = 200_000) -> DataFrame:
    """Add ``<s>_before`` and ``<s>_total`` for each summed column.

    ``df`` must be a stage table with distinct values of ``order``.
    """
    bucketed = range_buckets(df, order, rows_per_bucket)
    totals = bucketed.groupBy("range_bucket").agg(*[F.sum(s).alias(s) for s in sums])
    # At most _MAX_BUCKETS rows, whatever the size of the data.
    ahead = Window.orderBy("range_bucket").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    offsets = totals.select(
        "range_bucket",
        *[F.coalesce(F.sum(s).over(ahead), F.lit(0)).alias(f"{s}_offset") for s in sums],
        *[F.sum(s).over(everything).alias(f"{s}_total") for s in sums],
    )
    inside = Window.partitionBy("range_bucket").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    joined = bucketed.join(F.broadcast(offsets), "range_bucket")
    return joined.withColumns(
        {f"{s}_before": F.col(f"{s}_offset") + F.coalesce(F.sum(s).over(inside), F.lit(0)) for s in sums}
    ).drop("range_bucket", *[f"{s}_offset" for s in sums])
