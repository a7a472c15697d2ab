"""Small helpers of the text operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: ASCII white space: the characters of [\x20\x09-\x0D].
SPACES = " \t\n\x0b\x0c\r"


def text_or_empty(column: str | Column) -> Column:
    """The text, with null read as empty."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def without(text: Column, characters: str) -> Column:
    """``text`` with every one of ``characters`` deleted."""
    for c in characters:
        text = F.replace(text, F.lit(c))
    return text


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once, however often ``use`` reads it."""
    return F.element_at(F.transform(F.array(value), use), 1)


def same(left: DataFrame, right: DataFrame, pairs: list[tuple[str, str]]) -> Column:
    """Null-safe equality of the paired columns, which Spark still joins by hash or sort."""
    condition = F.lit(True)
    for a, b in pairs:
        condition = condition & left[a].eqNullSafe(right[b])
    return condition


def kept_rows(docs: DataFrame, keep: DataFrame, keys: dict[str, Column], how: str = "left_semi") -> DataFrame:
    """(row, keys...): the rows of ``docs`` whose ``keys`` are in ``keep``, a table of columns of these names, or not in it with left_anti.

    Every row travels whole as one struct, so no name of its columns can clash with the work's own.
    """
    marked = docs.select(F.struct("*").alias("row"), *[c.alias(k) for k, c in keys.items()])
    wanted = keep.select(*[F.col(k).alias(f"kept_{k}") for k in keys])
    return marked.join(wanted, same(marked, wanted, [(k, f"kept_{k}") for k in keys]), how)


def one_of_repeats(rows: DataFrame, keys: list[str], repeated: bool) -> DataFrame:
    """The rows of ``kept_rows`` as they were, one of those with equal keys; texts are shuffled only if there are repeats."""
    return (rows.dropDuplicates(keys) if repeated else rows).select("row.*")
