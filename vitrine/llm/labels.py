"""Folds and labelled samples shared by the classifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FOLDS = 5


def fold(identifier: str) -> Column:
    """CRC-32 of the id as text, modulo 5; a null id counts as empty text. Fold 0 is held out."""
    return F.crc32(F.coalesce(F.col(identifier).cast("string"), F.lit("")).cast("binary")) % FOLDS


def spread(identifier: str) -> Column:
    """An order of rows that does not depend on where they are stored."""
    return F.xxhash64(F.col(identifier).cast("string"), F.lit(7))


def sample(rows: DataFrame, order: str, count: int) -> DataFrame:
    """The ``count`` first rows by ``spread``: a sorted limit, merged from the partitions' own firsts."""
    return rows.orderBy(spread(order)).limit(count)
