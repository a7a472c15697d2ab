"""Small column helpers shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def np_round(value: Column, digits: int = 0) -> Column:
    """Round half to even by scaling, as numpy and pandas do."""
    scale = 10.0**digits
    return F.rint(value * F.lit(scale)) / F.lit(scale)


def clip(value: Column, low: float | None = None, high: float | None = None) -> Column:
    """Clip that keeps nulls (bare greatest/least would skip them)."""
    bounded = value
    if low is not None:
        bounded = F.greatest(bounded, F.lit(low))
    if high is not None:
        bounded = F.least(bounded, F.lit(high))
    return F.when(value.isNotNull(), bounded)


def trim_unicode(text: Column) -> Column:
    """Strip every Unicode white space at both ends, not only blanks."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def is_blank(text: Column) -> Column:
    return F.coalesce(trim_unicode(text), F.lit("")) == ""


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN stands for a missing value in floating-point sources; Spark's aggregates only skip NULL."""
    floats = [name for name, kind in df.dtypes if kind in ("double", "float")]
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in floats}) if floats else df


def scalar_row(one_row: DataFrame) -> Column:
    """A one-row DataFrame as a struct-valued scalar subquery.

    Catalyst runs it once and folds the fields into generated code, so global
    statistics need no join at all.
    """
    return one_row.select(F.struct("*").alias("row")).scalar()


def with_scalars(df: DataFrame, **one_rows: DataFrame) -> DataFrame:
    """Add one-row DataFrames as struct columns; refer to a field as ``F.col("name.field")``."""
    return df.withColumns({name: scalar_row(row) for name, row in one_rows.items()})


def have(df: DataFrame, names: list[str]) -> list[str]:
    """The given columns that exist in ``df``, in the given order."""
    return [n for n in names if n in df.columns]


def ordered(df: DataFrame, *keys: Column | str) -> DataFrame:
    """Sort by the given keys; without any, the table as it is."""
    return df.orderBy(*keys) if keys else df
