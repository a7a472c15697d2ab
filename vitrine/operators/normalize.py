"""Raw platform records to the canonical schema, whole tables at a time."""

from __future__ import annotations

import logging
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import parsing
from ..functions.scalars import is_blank, trim_unicode

UNTITLED = "Produit inconnu"
# Elements that show an average mark when a page has no structured data.
BADGE_CLASSES = (
    "jdgm-prev-badge__avg-rating", "spr-badge-caption", "okeReviews-starRating--star", "stamped-badge-caption",
)
BADGE_ATTRIBUTE = "data-rating"
CART_WORDS = "add|ajouter"


def _nonempty(text: Column) -> Column:
    return F.when(text != "", text)


def _readable(text: Column) -> Column:
    return F.coalesce(text, F.lit("")).isin("") | text.try_cast("double").isNotNull()


def _number(text: Column) -> Column:
    return F.coalesce(_nonempty(text).try_cast("double"), F.lit(0.0))


def _split_tags(tags: Column, drop_empty: bool) -> Column:
    parts = F.transform(F.split(tags, ","), trim_unicode)
    return F.filter(parts, lambda t: t != "") if drop_empty else parts


def _in_stock(variant: Column) -> Column:
    quantity = F.coalesce(variant["inventory_quantity"], F.lit(0))
    return F.coalesce(variant["available"], F.lit(False)) | (quantity > 0)


def _stock_total(variants: Column) -> Column:
    zero = F.lit(0).cast("long")
    total = F.aggregate(variants, zero, lambda acc, v: acc + F.coalesce(v["inventory_quantity"], zero))
    return F.when(total > 0, total)


def normalize_storefront(raw: DataFrame, base_url: Column) -> DataFrame:
    """Storefront API records. Records with an unreadable price are dropped; a missing
    compare-at price becomes 0, as the schema's price parser makes it."""
    variants = F.coalesce("variants", F.expr("array()").cast(raw.schema["variants"].dataType))
    first = F.get(variants, F.lit(0))
    readable = F.forall(variants, lambda v: _readable(v["price"])) & F.coalesce(_readable(first["compare_at_price"]), F.lit(True))
    return raw.filter(readable).select(
        F.coalesce("id", F.lit("")).alias("id"),
        trim_unicode(F.coalesce("title", F.lit(UNTITLED))).alias("title"),
        parsing.strip_html(F.col("body_html")).alias("description"),
        _nonempty(F.col("product_type")).alias("category"),
        F.col("vendor").alias("brand"),
        F.coalesce(_split_tags(F.col("tags"), False), F.array().cast("array<string>")).alias("tags"),
        F.get("images", F.lit(0))["src"].alias("image_url"),
        F.concat(base_url, F.lit("/products/"), F.coalesce("handle", F.lit(""))).alias("product_url"),
        F.greatest(_number(first["price"]), F.lit(0.0)).alias("price"),
        F.greatest(_number(first["compare_at_price"]), F.lit(0.0)).alias("original_price"),
        F.lit("MAD").alias("currency"),
        _stock_total(variants).alias("stock"),
        F.when(F.size(variants) > 0, F.exists(variants, _in_stock)).otherwise(True).alias("is_in_stock"),
        F.col("vendor").alias("shop_name"),
        F.transform(
            variants,
            lambda v: F.struct(v["id"].alias("id"), v["title"].alias("title"), _number(v["price"]).alias("price"), v["sku"].alias("sku")),
        ).alias("variants"),
        F.lit("shopify").alias("source_platform"),
    )


def normalize_storefront_bulk(raw: DataFrame, stores: DataFrame) -> DataFrame:
    """Bulk storefront records (column ``store``) with their store dimension (name, url,
    category_hint). Blank titles are dropped, unreadable prices are 0."""
    joined = raw.filter(~is_blank(F.col("title"))).join(stores, F.col("store") == F.col("name"))
    variants = F.coalesce("variants", F.expr("array()").cast(raw.schema["variants"].dataType))
    first = F.get(variants, F.lit(0))
    tags = F.coalesce(_split_tags(F.col("tags"), True), F.array().cast("array<string>"))
    kind = _nonempty(trim_unicode(F.col("product_type")))
    base = joined.withColumns(
        {
            "_price": _number(first["price"]),
            "_original": F.nullif(_number(first["compare_at_price"]), F.lit(0.0)),
            "_tags": tags,
            "_variants": variants,
        }
    ).withColumn("discount_pct", F.coalesce(parsing.discount_percent(F.col("_price"), F.col("_original"), True), F.lit(0.0)))
    return base.select(
        F.concat_ws("_", F.lit("shopify"), F.lower(F.translate("name", " ", "_")), F.coalesce("id", F.lit(""))).alias("id"),
        trim_unicode(F.col("title")).alias("title"),
        F.col("_price").alias("price"),
        F.col("_original").alias("original_price"),
        F.lit("USD").alias("currency"),
        F.lit(None).cast("double").alias("rating"),
        F.lit(None).cast("long").alias("review_count"),
        _stock_total(F.col("_variants")).alias("stock"),
        F.exists("_variants", _in_stock).alias("is_in_stock"),
        F.coalesce(kind, F.get("_tags", F.lit(0)), F.coalesce("category_hint", F.lit("Inconnu"))).alias("category"),
        F.coalesce(_nonempty(F.col("vendor")), F.col("name")).alias("brand"),
        F.col("name").alias("shop_name"),
        F.slice("_tags", 1, 5).alias("tags"),
        F.size("_variants").cast("long").alias("n_variants"),
        F.coalesce(F.size("images"), F.lit(0)).cast("long").alias("n_images"),
        "discount_pct",
        (F.col("discount_pct") > 0).alias("has_discount"),
        F.lit(None).cast("string").alias("description"),
        F.get("images", F.lit(0))["src"].alias("image_url"),
        F.concat(F.regexp_replace("url", "/+$", ""), F.lit("/products/"), F.coalesce("handle", F.lit(""))).alias("product_url"),
        F.lit("shopify").alias("source_platform"),
    )


def normalize_woo(raw: DataFrame, base_url: Column) -> DataFrame:
    """Woo API records; a record with an unreadable number is dropped."""
    price = F.coalesce(_nonempty(F.col("price")), _nonempty(F.col("regular_price")))
    regular, sale = _nonempty(F.col("regular_price")), _nonempty(F.col("sale_price"))
    rating = _nonempty(F.col("average_rating")).try_cast("double")
    readable = _readable(price) & _readable(F.col("regular_price")) & _readable(F.col("sale_price")) & _readable(F.col("average_rating"))
    return raw.filter(readable).select(
        F.coalesce("id", F.lit("")).alias("id"),
        trim_unicode(F.coalesce("name", F.lit(UNTITLED))).alias("title"),
        F.greatest(_number(price), F.lit(0.0)).alias("price"),
        F.when(regular.try_cast("double") > sale.try_cast("double"), regular.try_cast("double")).otherwise(0.0).alias("original_price"),
        F.lit("MAD").alias("currency"),
        F.when(rating.between(0.0, 5.0) & (rating > 0), rating).alias("rating"),
        F.nullif(F.greatest("rating_count", F.lit(0).cast("long")), F.lit(0).cast("long")).alias("review_count"),
        F.when(F.col("manage_stock"), F.col("stock_quantity")).alias("stock"),
        F.coalesce(F.col("stock_status") == "instock", F.lit(False)).alias("is_in_stock"),
        F.get("categories", F.lit(0))["name"].alias("category"),
        F.get("categories", F.lit(1))["name"].alias("sub_category"),
        F.coalesce(F.transform("tags", lambda t: t["name"]), F.array().cast("array<string>")).alias("tags"),
        parsing.url_host(base_url).alias("shop_name"),
        parsing.strip_html(F.coalesce(_nonempty(F.col("short_description")), F.col("description"))).alias("description"),
        F.get("images", F.lit(0))["src"].alias("image_url"),
        F.coalesce(F.col("permalink"), base_url).alias("product_url"),
        F.lit("woocommerce").alias("source_platform"),
    )


def normalize_page_rows(raw: DataFrame, platform: str, base_url: Column | None = None) -> DataFrame:
    """Rows read off listing pages (title, price_raw, product_url, image_url, rating_raw; currency
    and description where structured data gave them).

    ``platform`` is the id prefix: ``shopify`` or ``woo``. ``base_url`` is the shop's address: its
    host names a ``woo`` shop, and a missing product_url becomes the address.
    """
    woo = platform == "woo"
    base = F.lit(None).cast("string") if base_url is None else base_url
    described = [F.col("description")] if "description" in raw.columns and not woo else []
    return raw.select(
        parsing.page_id(F.col("product_url"), platform).alias("id"),
        trim_unicode(F.coalesce("title", F.lit(UNTITLED))).alias("title"),
        parsing.first_number(F.col("price_raw")).alias("price"),
        F.col("currency") if "currency" in raw.columns and not woo else F.lit("MAD").alias("currency"),
        (parsing.stars_to_five(F.col("rating_raw")) if woo else F.lit(None).cast("double")).alias("rating"),
        (parsing.url_host(base) if woo else F.lit(None).cast("string")).alias("shop_name"),
        F.coalesce("product_url", base).alias("product_url"),
        "image_url",
        F.lit("woocommerce_playwright" if woo else "shopify_playwright").alias("source_platform"),
        *described,
    )


_LD_SCRIPT = r"""(?is)<script\b[^>]*\btype\s*=\s*["']?\s*application/ld\+json\b[^>]*>(.*?)</script\s*>"""


def _jsonld_items(pages: DataFrame) -> DataFrame:
    """One row per item of every structured-data script, in document order; malformed scripts vanish."""
    scripts = pages.select(
        "page_id", "url", F.posexplode(F.regexp_extract_all("html", F.lit(_LD_SCRIPT), F.lit(1))).alias("script_no", "script")
    ).withColumn("doc", F.try_parse_json("script"))
    items = F.coalesce(F.try_variant_get("doc", "$", "array<variant>"), F.array("doc"))
    return scripts.filter(F.col("doc").isNotNull()).select(
        "page_id", "url", "script_no", F.posexplode(items).alias("item_no", "item")
    )


def _field(path: str, kind: str = "string") -> Column:
    return F.try_variant_get("item", path, kind)


def _plain(path: str) -> Column:
    """A text field; null where the value is a list or an object."""
    value = _field(path)
    return F.when(~value.rlike(r"^[\[{]"), value)


def extract_jsonld_products(pages: DataFrame) -> DataFrame:
    """Products of a page table (page_id, url, html); ``url`` is the base of relative links."""
    link, image = F.coalesce(_field("$.url"), F.lit("")), F.coalesce(_field("$.image[0]"), _field("$.image.url"), _plain("$.image"), F.lit(""))
    absolute = F.concat(F.regexp_replace("url", "/+$", ""), F.lit("/"), F.regexp_replace(link, "^/+", ""))
    return (
        _jsonld_items(pages)
        .filter(_field("$['@type']") == "Product")
        .select(
            "page_id",
            F.col("url").alias("base_url"),
            F.coalesce(_field("$.name"), F.lit("")).alias("title"),
            F.coalesce(_field("$.description"), F.lit("")).alias("description"),
            F.coalesce(F.translate(_field("$.offers.price"), ",", ".").try_cast("double"), F.lit(0.0)).alias("price"),
            F.coalesce(_field("$.offers.priceCurrency"), F.lit("MAD")).alias("currency"),
            F.when((link != "") & ~link.startswith("http"), absolute).otherwise(link).alias("product_url"),
            image.alias("image_url"),
            F.coalesce(_field("$.sku"), F.lit("")).alias("sku"),
        )
    )


def products_from_pages(pages: DataFrame) -> DataFrame:
    """Canonical products of stored pages: structured data, normalised; one row per product found."""
    rows = extract_jsonld_products(pages).withColumn("price_raw", F.col("price").cast("decimal(30,6)").cast("string"))
    return normalize_page_rows(rows, "shopify", F.col("base_url"))


def _element_body(depth: int = 4) -> str:
    """Pattern of an element's content with up to ``depth`` nested elements of the same name (group 1)."""
    inside = r"[^<]++|<(?!/?\1\b)[^>]*+>"
    body = rf"(?:{inside})*+"
    for _ in range(depth):
        body = rf"(?:{inside}|<\1\b[^>]*+>{body}</\1\s*+>)*+"
    return body


def _leading_number(text: Column) -> Column:
    return F.regexp_extract(text, r"^\s*([+-]?\d+\.?\d*)", 1).try_cast("double")


def extract_page_observations(pages: DataFrame) -> DataFrame:
    """Rating, review count and availability per stored page.

    The first rated product of the structured data wins, otherwise the first badge element's
    number with no count. Everything happens inside the row, so pages are never shuffled.
    """
    docs = F.filter(
        F.transform(F.regexp_extract_all("html", F.lit(_LD_SCRIPT), F.lit(1)), F.try_parse_json), lambda d: d.isNotNull()
    )
    items = F.flatten(F.transform(docs, lambda d: F.coalesce(F.try_variant_get(d, "$", "array<variant>"), F.array(d))))
    rated = F.filter(
        items,
        lambda i: (F.try_variant_get(i, "$['@type']", "string") == "Product")
        & F.try_variant_get(i, "$.aggregateRating", "variant").isNotNull()
        & ~F.is_variant_null(F.try_variant_get(i, "$.aggregateRating", "variant")),
    )
    classes = "|".join(BADGE_CLASSES)
    badge = rf'(?is)<(\w+)[^>]*(?:class="[^"]*\b(?:{classes})\b[^"]*"|\b{BADGE_ATTRIBUTE}\b)[^>]*>({_element_body()})</\1\s*>'
    badge_mark = F.regexp_extract(F.regexp_replace(F.regexp_extract("html", badge, 2), "<[^>]+>", ""), r"(\d+\.?\d*)", 1)
    buttons = F.regexp_extract_all("html", F.lit(r"(?is)(<button.*?</button>)"), F.lit(1))
    cart = F.get(F.filter(buttons, lambda b: F.lower(F.regexp_replace(b, "<[^>]+>", "")).rlike(CART_WORDS)), F.lit(0))
    disabled = F.regexp_extract(cart, r"(?is)^<button([^>]*)>", 1).rlike(r"(?i)\bdisabled\b")
    return (
        pages.withColumn("_rated", F.get(rated, F.lit(0)))
        .withColumns(
            {
                "_mark": F.try_variant_get("_rated", "$.aggregateRating.ratingValue", "string"),
                "_count": F.try_variant_get("_rated", "$.aggregateRating.reviewCount", "string"),
            }
        )
        .select(
            "page_id",
            F.when(F.col("_rated").isNotNull(), _leading_number(F.col("_mark"))).otherwise(badge_mark.try_cast("double")).alias("rating"),
            _leading_number(F.col("_count")).cast("long").alias("review_count"),
            F.coalesce(~disabled, F.lit(True)).alias("is_in_stock"),
        )
    )


def union_sources(sources: Sequence[DataFrame | Callable[[], DataFrame]]) -> DataFrame:
    """All sources by column name; a source that cannot be opened contributes no rows."""
    tables = []
    for source in sources:
        try:
            tables.append(source() if callable(source) else source)
        except AnalysisException as problem:
            logging.getLogger(__name__).warning("source skipped: %s", problem.getCondition())
    if not tables:
        raise ValueError("no source could be opened")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def backfill_description(df: DataFrame) -> DataFrame:
    """A sentence made of title, category and platform where the description is blank."""
    sentence = F.concat(
        F.col("title"),
        F.lit(" est un produit de la catégorie "),
        F.coalesce(_nonempty(F.col("category")), F.lit("Inconnu")),
        F.lit(", proposé sur "),
        F.col("source_platform"),
        F.lit("."),
    )
    return df.withColumn("description", F.when(is_blank(F.col("description")), sentence).otherwise(F.col("description")))


def source_counts(df: DataFrame) -> DataFrame:
    return df.groupBy("shop_name").agg(F.count("*").alias("n_products")).orderBy(F.desc("n_products"), "shop_name")
