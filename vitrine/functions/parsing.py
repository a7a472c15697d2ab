"""Text-to-value parsers as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .scalars import np_round, trim_unicode

# Spellings of a missing rating.
MISSING_RATING = ("n/a", "na", "-", "")
# Narrow no-break space, no-break space and blank separate digit groups.
GROUPING = "\u202f\u00a0 "


def _is_number(kind: str | None) -> bool:
    return kind in ("tinyint", "smallint", "int", "bigint", "float", "double")


def parse_price(value: Column, kind: str = "string") -> Column:
    """Any price notation to a non-negative number; the largest number of a phrase wins.

    Blanks inside the text are thousands separators, a comma is a decimal point. Null, empty
    and wordy prices are 0.
    """
    if _is_number(kind):
        return F.coalesce(F.greatest(value.cast("double"), F.lit(0.0)), F.lit(0.0))
    joined = F.translate(F.translate(value, GROUPING, ""), ",", ".")
    numbers = F.regexp_extract_all(joined, F.lit(r"(\d+\.?\d*)"), F.lit(1))
    return F.coalesce(F.array_max(F.transform(numbers, lambda n: n.try_cast("double"))), F.lit(0.0))


def parse_rating(value: Column, kind: str = "string") -> Column:
    """Rating text to 0..5: first number, a mark out of ten halved, anything else null."""
    if _is_number(kind):
        number = value.cast("double")
        return F.when(number.between(0.0, 5.0), number)
    raw = trim_unicode(value)
    first = F.regexp_extract(F.translate(raw, ",", "."), r"(\d+\.?\d*)", 1).try_cast("double")
    halved = F.when(first > 5.0, first / 2.0).otherwise(first)
    return F.when(~F.lower(raw).isin(*MISSING_RATING) & halved.between(0.0, 5.0), halved)


def parse_review_count(value: Column, kind: str = "string") -> Column:
    """Review-count text to a non-negative integer, null where no digit is found."""
    if _is_number(kind):
        return F.greatest(value.cast("long"), F.when(value.isNotNull(), F.lit(0).cast("long")))
    return F.regexp_extract(F.translate(value, "\u202f ", ""), r"(\d+)", 1).try_cast("long")


def first_number(value: Column) -> Column:
    """The first number of a price text (page rows), 0 when there is none."""
    text = F.translate(F.coalesce(value, F.lit("0")), ",", ".")
    return F.coalesce(F.regexp_extract(text, r"(\d+\.?\d*)", 1).try_cast("double"), F.lit(0.0))


def stars_to_five(label: Column) -> Column:
    """'x out of y' to a mark out of five, two digits."""
    pattern = r"(\d+\.?\d*)\s*out of\s*(\d+)"
    mark = F.regexp_extract(label, pattern, 1).try_cast("double")
    scale = F.regexp_extract(label, pattern, 2).try_cast("double")
    return np_round(F.try_divide(mark, scale) * 5, 2)


def strip_html(html: Column) -> Column:
    return trim_unicode(F.regexp_replace(F.coalesce(html, F.lit("")), "<[^>]+>", ""))


def url_slug(url: Column) -> Column:
    """Last path segment of a URL, trailing slashes ignored."""
    return F.element_at(F.split(F.regexp_replace(F.coalesce(url, F.lit("")), "/+$", ""), "/"), -1)


def page_id(url: Column, prefix: str) -> Column:
    slug = url_slug(url)
    return F.concat(F.lit(f"{prefix}_"), F.when(slug == "", F.lit("unknown")).otherwise(slug))


def url_host(url: Column) -> Column:
    """Host and port, as in a URL's authority part; null for text that is no URL."""
    return F.try_parse_url(url, F.lit("AUTHORITY"))


def discount_percent(price: Column, original: Column, need_positive_price: bool) -> Column:
    """Percent off the original price, two digits, 0 when there is no discount."""
    off = original > price
    if need_positive_price:
        off = off & (price > 0)
    return F.when(off, np_round((original - price) / original * 100, 2)).otherwise(0.0)
