"""Exact interpolated quantiles without collecting a group.

``percentile`` merges every distinct value of a group into one buffer. Here a first pass merges a rank
sketch of each group, which gives two borders around each wanted rank; a second pass counts the
rows below the lower border, on the map side, and only the values between the borders travel. The
counts prove the borders, so the result does not rest on the sketch's error.

Radix descent does the rest: weighted rows, brackets of more than ``BRACKET`` different values, and
borders that the counts refute. A double is read as its 64-bit pattern, whose order as a whole number
is the order of the values. Four passes each look at 16 bits: rows that share the bits found so far
with a wanted rank are counted by the next 16, and the counts before the rank go down with it. A group
has at most 65,536 counters in a pass, whatever its values.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..stages import stage

#: Rank error of the sketch is one in ACCURACY; the borders lie MARGIN times that to either side.
ACCURACY = 10_000
MARGIN = 4
#: A bracket with more different values than this is not sorted in one task.
BRACKET = 1_000_000

_DIGITS = 4
_BITS = 16


def order_pattern(value: Column) -> Column:
    """The bits of a double as a long in the order of the values: sign times magnitude, infinities last, NaN after them."""
    size = F.abs(value)
    guess = F.greatest(F.floor(F.log2(size)), F.lit(-1022))
    above = F.when(F.pow(F.lit(2.0), guess) > size, guess - 1).otherwise(guess)  # log2 may round up
    exponent = F.greatest(F.when(F.pow(F.lit(2.0), above + 1) <= size, above + 1).otherwise(above), F.lit(-1022))
    normal = (exponent + 1022).cast("long") * (1 << 52) + (size / F.pow(F.lit(2.0), exponent) * 2.0**52).cast("long")
    tiny = (size * 2.0**537 * 2.0**537).cast("long")  # below 2^-1022 the pattern counts steps of 2^-1074
    bits = F.when(size == 0, F.lit(0).cast("long")).when(size < 2.0**-1022, tiny).when(size == float("inf"), F.lit(2047 << 52)).otherwise(normal)
    return F.when(F.isnan(value), F.lit(2**63 - 1)).when(value < 0, -bits).otherwise(bits)


def exact_quantiles(
    df: DataFrame,
    measures: dict[str, Column | str],
    probs: list[float],
    by: list[str] | None = None,
    weight: str | None = None,
    approx: bool = False,
) -> DataFrame:
    """Rows (by..., measure, prob, value); null values, and rows with a null key, are ignored.

    ``weight`` names an integer column that repeats each row. ``approx`` trades exactness for
    a single pass with percentile_approx (unweighted input only).
    """
    by = list(by or [])
    unit = F.col(weight).cast("long") if weight else F.lit(1).cast("long")
    pairs = [
        F.struct(F.lit(name).alias("measure"), (F.col(c) if isinstance(c, str) else c).cast("double").alias("value"))
        for name, c in measures.items()
    ]
    group = [*by, "measure"]
    for key in by:
        df = df.filter(F.col(key).isNotNull())
    long = df.select(*by, unit.alias("w"), F.explode(F.array(*pairs)).alias("m")).select(*by, "w", "m.measure", "m.value").filter(F.col("value").isNotNull())

    if approx:
        if weight:
            raise ValueError("approx quantiles take unweighted rows")
        arrays = long.groupBy(*group).agg(F.percentile_approx("value", probs, ACCURACY).alias("q"))
        return arrays.select(
            *group, F.explode(F.arrays_zip(F.array(*map(F.lit, probs)).alias("prob"), F.col("q").alias("value"))).alias("z")
        ).select(*group, "z.prob", "z.value")

    # The source is read once; what follows reads this narrow table.
    long = stage(long if weight else long.drop("w"), "quantile-values")
    if weight:
        total = long.groupBy(*group).agg(F.sum("w").alias("total"))
        ranked = total.withColumn("prob", F.explode(F.array(*[F.lit(float(p)) for p in probs]))).withColumn("at", F.col("prob") * (F.col("total") - 1))
        return _descend(long, ranked.drop("total").withColumn("below", F.lit(0).cast("long")), group)

    inside = stage(_between_borders(long, probs, group), "quantile-brackets")
    spot = [*group, "prob", "at"]
    below = F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("n"))), F.lit(0).cast("long")).alias("below")
    ranked = inside.groupBy(*spot).agg(below, F.sum("n").alias("upto"), F.count("value").alias("values"))
    proven = (F.col("below") <= F.floor("at")) & (F.ceil("at") < F.col("upto"))
    seen = ranked.agg(F.min(proven).alias("proven"), F.max("values").alias("widest")).first()
    if seen["proven"] is False:
        return _descend(long.withColumn("w", F.lit(1).cast("long")), _all_ranks(long, probs, group), group)
    if (seen["widest"] or 0) > BRACKET:
        values = inside.filter(F.col("value").isNotNull()).withColumnRenamed("n", "w")
        return _descend(values, ranked.select(*spot, "below"), [*group, "prob"])
    upto = F.sum("n").over(Window.partitionBy(*spot).orderBy(F.asc_nulls_first("value")))
    placed = inside.withColumn("upto", upto).withColumn("before", F.col("upto") - F.col("n"))
    at = lambda rank: F.max(F.when((F.col("before") <= rank) & (rank < F.col("upto")), F.col("value")))
    return _interpolated(placed.groupBy(*spot).agg(at(F.floor("at")).alias("a"), at(F.ceil("at")).alias("b")), [*group, "prob"])


def _interpolated(ends: DataFrame, names: list[str]) -> DataFrame:
    return ends.select(*names, (F.col("a") + (F.col("b") - F.col("a")) * (F.col("at") - F.floor("at"))).alias("value"))


def _all_ranks(long: DataFrame, probs: list[float], group: list[str]) -> DataFrame:
    total = long.groupBy(*group).agg(F.count("*").alias("total"))
    ranked = total.withColumn("prob", F.explode(F.array(*[F.lit(float(p)) for p in probs])))
    return ranked.select(*group, "prob", (F.col("prob") * (F.col("total") - 1)).alias("at"), F.lit(0).cast("long").alias("below"))


def _between_borders(long: DataFrame, probs: list[float], group: list[str]) -> DataFrame:
    """Rows (group..., prob, at, value, n): the values between the borders, and one row without value for those below.

    Small groups have their least and greatest value as borders. The borders are a stage table of one
    row per group, joined without a hint.
    """
    step = MARGIN / ACCURACY
    asked = [max(0.0, p - step) for p in probs] + [min(1.0, p + step) for p in probs]
    sketch = long.groupBy(*group).agg(
        F.count("*").alias("total"), F.min("value").alias("least"), F.max("value").alias("most"), F.percentile_approx("value", asked, ACCURACY).alias("q")
    )
    small = F.col("total") <= ACCURACY
    spots = F.array(
        *[
            F.struct(
                F.lit(float(p)).alias("prob"),
                (F.lit(float(p)) * (F.col("total") - 1)).alias("at"),
                F.when(small, F.col("least")).otherwise(F.col("q")[i]).alias("lo"),
                F.when(small, F.col("most")).otherwise(F.col("q")[i + len(probs)]).alias("hi"),
            )
            for i, p in enumerate(probs)
        ]
    )
    borders = stage(sketch.select(*group, spots.alias("spots")), "quantile-borders")
    reached = F.filter("spots", lambda s: F.col("value") <= s["hi"])
    rows = long.join(borders, group).select(*group, "value", F.explode(reached).alias("s"))
    kept = F.when(F.col("value") >= F.col("s.lo"), F.col("value")).alias("value")
    return rows.select(*group, "s.prob", "s.at", kept).groupBy(*group, "prob", "at", "value").agg(F.count("*").alias("n"))


def _descend(long: DataFrame, ranked: DataFrame, group: list[str]) -> DataFrame:
    """Radix descent over the rows (group..., value, w): the ranks ``at`` of ``ranked``, of which ``below`` rows are not in ``long``."""
    names = [*group, *([] if "prob" in group else ["prob"])]
    ends = F.array(F.struct(F.lit(0).alias("end"), F.floor("at").alias("rank")), F.struct(F.lit(1).alias("end"), F.ceil("at").alias("rank")))
    wanted = ranked.select(*names, "at", "below", F.explode(ends).alias("e")).select(*names, "at", "e.end", (F.col("e.rank") - F.col("below")).alias("rank"))
    # ``prefix`` holds the bits found so far, ``rank`` counts inside the rows that share them. There
    # are two rows for each group and probability; as stage tables their size decides how they join.
    wanted = stage(wanted.withColumn("prefix", F.lit(0).cast("long")), "quantile-ranks")
    long = stage(long.withColumn("bits", order_pattern(F.col("value"))), "quantile-bits")
    for digit in range(_DIGITS):
        low = _BITS * (_DIGITS - 1 - digit)
        rows = long.withColumn("prefix", F.shiftright("bits", low + _BITS) if digit else F.lit(0).cast("long"))
        if digit:
            places = stage(wanted.select(*group, "prefix").distinct(), "quantile-places")
            rows = rows.join(places, [*group, "prefix"], "left_semi")
        counts = rows.groupBy(*group, "prefix", F.shiftright("bits", low).alias("next")).agg(F.sum("w").alias("n"), F.min("value").alias("least"))
        upto = F.sum("n").over(Window.partitionBy(*group, "prefix").orderBy("next"))
        counts = counts.withColumn("before", upto - F.col("n"))
        found = wanted.join(counts, [*group, "prefix"]).filter((F.col("before") <= F.col("rank")) & (F.col("rank") < F.col("before") + F.col("n")))
        keep = [*names, "at", "end", (F.col("rank") - F.col("before")).alias("rank"), F.col("next").alias("prefix")]
        wanted = found.select(*keep, "least") if digit == _DIGITS - 1 else stage(found.select(*keep), "quantile-ranks")
    end = lambda e: F.max(F.when(F.col("end") == e, F.col("least")))
    return _interpolated(wanted.groupBy(*names, "at").agg(end(0).alias("a"), end(1).alias("b")), names)


def quantile_scalar(df: DataFrame, column: Column | str, prob: float, weight: str | None = None) -> Column:
    """One global quantile as a scalar subquery (null when there is no value)."""
    return exact_quantiles(df, {"v": column}, [prob], weight=weight).select("value").scalar()


def quantile_row(df: DataFrame, measures: dict[str, Column | str], prob: float) -> DataFrame:
    """One row with a column per measure: the same quantile of each."""
    long = exact_quantiles(df, measures, [prob])
    return long.agg(*[F.max(F.when(F.col("measure") == m, F.col("value"))).alias(m) for m in measures])
