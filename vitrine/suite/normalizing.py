"""Registered queries for normalisation, on raw records built from the listings and on pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import parsing
from ..functions.scalars import np_round
from ..operators import normalize
from ..schema import PRODUCT, validate_catalog, with_failures
from ..sources.listings import listings, table
from .oracle_base import rounded, with_ctes

QUERIES = {}
ORACLES = {}


def _whole(column: str):
    return F.floor(F.col(column)).cast("string")


# ---- parsers ---------------------------------------------------------------------------------


def _texts(spark, sf):
    """Price, rating and review texts in the notations shops use."""
    kind = F.col("n_variants")
    return listings(spark, sf).select(
        "id",
        "ingest_seq",
        F.when(kind == 1, F.concat_ws(" ", F.lit("1"), _whole("price"), F.lit("50 MAD")))
        .when(kind == 2, F.concat(_whole("price"), F.lit(",99€")))
        .when(kind == 3, F.concat(F.lit("Lot de 3 t-shirts pour "), _whole("price"), F.lit(".50 MAD")))
        .when(kind == 4, F.lit("Gratuit"))
        .when(kind == 5, F.concat(F.lit("1.200,"), _whole("price")))
        .when(kind == 6, F.lit("  "))
        .alias("price_text"),
        F.when(kind == 1, F.concat(_whole("rating"), F.lit(",5/5")))
        .when(kind == 2, F.lit("N/A"))
        .when(kind == 3, F.concat(_whole("rating"), F.lit(" stars")))
        .when(kind == 4, F.concat(F.lit(" "), (F.floor("rating") + 5).cast("string"), F.lit(" sur 10")))
        .when(kind == 5, F.lit(" - "))
        .when(kind == 6, F.concat((F.floor("rating") * 7).cast("string"), F.lit("%")))
        .alias("rating_text"),
        F.when(kind == 1, F.concat(F.lit("1 "), F.col("review_count").cast("string"), F.lit(" avis")))
        .when(kind < 5, F.concat(F.lit("("), F.col("review_count").cast("string"), F.lit(")")))
        .when(kind == 5, F.lit("aucun avis"))
        .alias("review_text"),
    )


_TEXTS_SQL = """
SELECT id, ingest_seq,
  CASE n_variants WHEN 1 THEN concat_ws(chr(8239), '1', CAST(CAST(floor(price) AS BIGINT) AS VARCHAR), '50 MAD')
    WHEN 2 THEN CAST(floor(price) AS BIGINT) || ',99€' WHEN 3 THEN 'Lot de 3 t-shirts pour ' || CAST(floor(price) AS BIGINT) || '.50 MAD'
    WHEN 4 THEN 'Gratuit' WHEN 5 THEN '1.200,' || CAST(floor(price) AS BIGINT) WHEN 6 THEN '  ' END AS price_text,
  CASE n_variants WHEN 1 THEN CAST(floor(rating) AS BIGINT) || ',5/5' WHEN 2 THEN 'N/A' WHEN 3 THEN CAST(floor(rating) AS BIGINT) || ' stars'
    WHEN 4 THEN ' ' || (CAST(floor(rating) AS BIGINT) + 5) || ' sur 10' WHEN 5 THEN ' - '
    WHEN 6 THEN (CAST(floor(rating) AS BIGINT) * 7) || '%' END AS rating_text,
  CASE WHEN n_variants = 1 THEN '1 ' || review_count || ' avis' WHEN n_variants < 5 THEN '(' || review_count || ')'
    WHEN n_variants = 5 THEN 'aucun avis' END AS review_text
FROM listings"""
_EXTRA = {"texts": (_TEXTS_SQL, ["listings"])}

QUERIES["parse_price"] = lambda spark, sf: _texts(spark, sf).select(
    "id", "ingest_seq", "price_text", parsing.parse_price(F.col("price_text")).alias("price")
)
ORACLES["parse_price"] = with_ctes(
    "texts",
    """SELECT id, ingest_seq, price_text, coalesce(list_max(list_transform(regexp_extract_all(
replace(replace(replace(replace(price_text, chr(8239), ''), chr(160), ''), ' ', ''), ',', '.'), '\\d+\\.?\\d*'),
lambda x: TRY_CAST(x AS DOUBLE))), 0e0) AS price FROM texts""",
    _EXTRA,
)

QUERIES["parse_rating"] = lambda spark, sf: _texts(spark, sf).select(
    "id", "ingest_seq", "rating_text", parsing.parse_rating(F.col("rating_text")).alias("rating")
)
ORACLES["parse_rating"] = with_ctes(
    "texts",
    """SELECT id, ingest_seq, rating_text, CASE WHEN halved BETWEEN 0 AND 5 THEN halved END AS rating FROM (
SELECT *, CASE WHEN mark > 5 THEN mark / 2 ELSE mark END AS halved FROM (
SELECT *, CASE WHEN lower(trim(rating_text)) NOT IN ('n/a', 'na', '-', '')
  THEN TRY_CAST(regexp_extract(replace(rating_text, ',', '.'), '\\d+\\.?\\d*') AS DOUBLE) END AS mark FROM texts))""",
    _EXTRA,
)

QUERIES["parse_review_count"] = lambda spark, sf: _texts(spark, sf).select(
    "id", "ingest_seq", "review_text", parsing.parse_review_count(F.col("review_text")).alias("review_count")
)
ORACLES["parse_review_count"] = with_ctes(
    "texts",
    """SELECT id, ingest_seq, review_text, TRY_CAST(regexp_extract(replace(review_text, ' ', ''), '\\d+') AS BIGINT) AS review_count
FROM texts""",
    _EXTRA,
)

QUERIES["schema_discount"] = lambda spark, sf: listings(spark, sf).select(
    "id", "ingest_seq", parsing.discount_percent(F.col("price"), F.col("original_price"), True).alias("discount_percentage")
)
ORACLES["schema_discount"] = with_ctes(
    "listings",
    """SELECT id, ingest_seq, CASE WHEN original_price > price AND price > 0
THEN round_even((original_price - price) / original_price * 100 * 100, 0) / 100 ELSE 0e0 END AS discount_percentage FROM listings""",
)


# ---- validation ------------------------------------------------------------------------------


def _unchecked(spark, sf):
    return listings(spark, sf).drop("n_variants", "n_images").withColumnRenamed("ingest_seq", "batch_note").withColumn(
        "batch_note", F.when(F.col("batch_note") < 50, F.col("batch_note"))
    )


QUERIES["validate_catalog"] = lambda spark, sf: (
    with_failures(_unchecked(spark, sf))
    .select(F.explode_outer("failures").alias("failure"))
    .groupBy(F.coalesce("failure", F.lit("none")).alias("failure"))
    .agg(F.count("*").alias("records"))
)
ORACLES["validate_catalog"] = with_ctes(
    "listings",
    """SELECT unnest(CASE WHEN len(f) = 0 THEN ['none'] ELSE f END) AS failure, count(*) AS records FROM (
SELECT list_filter([CASE WHEN title IS NULL THEN 'title: missing' END, CASE WHEN price IS NULL THEN 'price: missing' END,
  CASE WHEN rating NOT BETWEEN 0 AND 5 THEN 'rating: outside 0..5' END,
  CASE WHEN ingest_seq < 50 THEN 'batch_note: unknown field' END], lambda x: x IS NOT NULL) AS f FROM listings) GROUP BY 1""",
)


def _accepted(spark, sf):
    good, bad = validate_catalog(_unchecked(spark, sf))
    names = [f.name for f in PRODUCT.fields if f.name in good.columns]
    return (
        good.select(*names)
        .groupBy("source_platform")
        .agg(F.count("*").alias("records"), F.min("price").alias("cheapest"))
        .withColumn("status", F.lit("valid"))
        .unionByName(
            bad.groupBy("source_platform")
            .agg(F.count("*").alias("records"), F.min("price").alias("cheapest"))
            .withColumn("status", F.lit("rejected"))
        )
    )


QUERIES["validate_split"] = _accepted
ORACLES["validate_split"] = with_ctes(
    "listings",
    """SELECT source_platform, CASE WHEN bad THEN 'rejected' ELSE 'valid' END AS status, count(*) AS records, min(price) AS cheapest
FROM (SELECT *, title IS NULL OR price IS NULL OR coalesce(rating NOT BETWEEN 0 AND 5, false) OR ingest_seq < 50 AS bad FROM listings)
GROUP BY 1, 2""",
)


# ---- platform records ------------------------------------------------------------------------


def _storefront_raw(spark, sf):
    def variant(i):
        return F.struct(
            F.concat_ws("-", F.col("id"), i.cast("string")).alias("id"),
            F.concat(F.lit("v"), i.cast("string")).alias("title"),
            F.concat((F.floor("price") * i).cast("string"), F.lit(".5")).alias("price"),
            F.coalesce(F.concat((F.floor("original_price") * i).cast("string"), F.lit(".75")), F.lit("")).alias("compare_at_price"),
            F.col("brand").alias("sku"),
            (F.col("stock") - i * 10).alias("inventory_quantity"),
            (F.col("is_in_stock") & (i == 2)).alias("available"),
        )

    return listings(spark, sf).select(
        "id",
        "ingest_seq",
        "title",
        F.col("product_url").alias("handle"),
        F.col("description").alias("body_html"),
        F.col("brand").alias("vendor"),
        F.coalesce("category", F.lit("")).alias("product_type"),
        F.array_join("tags", " , ").alias("tags"),
        F.when(F.col("n_variants") > 1, F.transform(F.sequence(F.lit(1).cast("long"), F.col("n_variants") - 1), variant)).alias("variants"),
        F.when(F.col("image_url").isNotNull(), F.array(F.struct(F.col("image_url").alias("src")))).alias("images"),
        F.col("shop_name").alias("store"),
    )


_STOREFRONT_SQL = """
SELECT id, ingest_seq, title, product_url AS handle, description AS body_html, brand AS vendor, coalesce(category, '') AS product_type,
  array_to_string(tags, ' , ') AS tags_text, tags, image_url, shop_name AS store,
  CAST(floor(price) AS BIGINT) AS p, CAST(floor(original_price) AS BIGINT) AS o, stock, is_in_stock, n_variants - 1 AS nv,
  CASE WHEN n_variants > 1 THEN stock * (n_variants - 1) - 5 * (n_variants - 1) * n_variants END AS total
FROM listings"""
_EXTRA["storefront"] = (_STOREFRONT_SQL, ["listings"])
_IN_STOCK_SQL = "coalesce(stock - 10 > 0, false) OR (nv >= 2 AND coalesce(is_in_stock, false))"

QUERIES["normalize_storefront"] = lambda spark, sf: normalize.normalize_storefront(
    _storefront_raw(spark, sf), F.lit("https://shop.example.com")
).select(
    "id", "title", "description", "category", "brand", F.array_join("tags", "|").alias("tags"), "image_url", "product_url",
    "price", "original_price", "currency", "stock", "is_in_stock", "shop_name", "source_platform",
    F.size("variants").alias("n_variants"), F.round(F.aggregate("variants", F.lit(0.0), lambda a, v: a + v["price"]), 2).alias("variant_prices"),
)
ORACLES["normalize_storefront"] = with_ctes(
    "storefront",
    f"""SELECT id, trim(replace(coalesce(title, 'Produit inconnu'), chr(160), ' ')) AS title,
  trim(regexp_replace(coalesce(body_html, ''), '<[^>]+>', '', 'g')) AS description,
  nullif(product_type, '') AS category, vendor AS brand, array_to_string(tags, '|') AS tags, image_url,
  'https://shop.example.com/products/' || handle AS product_url, CASE WHEN nv > 0 AND p IS NOT NULL THEN p + 0.5e0 ELSE 0e0 END AS price,
  CASE WHEN nv > 0 AND o IS NOT NULL THEN o + 0.75e0 ELSE 0e0 END AS original_price, 'MAD' AS currency,
  CASE WHEN total > 0 THEN total END AS stock, nv = 0 OR {_IN_STOCK_SQL} AS is_in_stock, vendor AS shop_name,
  'shopify' AS source_platform, CAST(nv AS INTEGER) AS n_variants,
  CASE WHEN p IS NULL THEN 0e0 ELSE p * nv * (nv + 1) / 2 + 0.5e0 * nv END AS variant_prices FROM storefront""",
    _EXTRA,
)


def _stores(spark, sf):
    return table(spark, sf, "supplier").select(
        F.col("s_name").alias("name"),
        F.concat(F.lit("https://shop"), F.col("s_suppkey").cast("string"), F.lit(".example.com/")).alias("url"),
        F.when(F.col("s_acctbal") > 0, F.lit("General")).alias("category_hint"),
    )


_BULK = [
    "id", "title", "price", "original_price", "currency", "rating", "review_count", "stock", "is_in_stock", "category", "brand",
    "shop_name", "n_variants", "n_images", "discount_pct", "has_discount", "image_url", "product_url", "source_platform",
]
QUERIES["normalize_storefront_bulk"] = lambda spark, sf: normalize.normalize_storefront_bulk(
    _storefront_raw(spark, sf), _stores(spark, sf)
).select(*_BULK, F.array_join("tags", "|").alias("tags"))
ORACLES["normalize_storefront_bulk"] = with_ctes(
    "storefront",
    f"""SELECT *, discount_pct > 0 AS has_discount FROM (
SELECT *, CASE WHEN original_price > price AND price > 0
  THEN round_even((original_price - price) / original_price * 100 * 100, 0) / 100 ELSE 0e0 END AS discount_pct FROM (
SELECT 'shopify_' || lower(replace(s_name, ' ', '_')) || '_' || id AS id, title,
  CASE WHEN nv > 0 AND p IS NOT NULL THEN p + 0.5e0 ELSE 0e0 END AS price, CASE WHEN nv > 0 AND o IS NOT NULL THEN o + 0.75e0 END AS original_price,
  'USD' AS currency, CAST(NULL AS DOUBLE) AS rating, CAST(NULL AS BIGINT) AS review_count, CASE WHEN total > 0 THEN total END AS stock,
  nv > 0 AND ({_IN_STOCK_SQL}) AS is_in_stock, CASE WHEN product_type <> '' THEN product_type ELSE tags[1] END AS category,
  coalesce(vendor, s_name) AS brand, s_name AS shop_name, nv AS n_variants, CAST(image_url IS NOT NULL AS BIGINT) AS n_images,
  image_url, 'https://shop' || s_suppkey || '.example.com/products/' || handle AS product_url, 'shopify' AS source_platform,
  array_to_string(tags[1:5], '|') AS tags
FROM storefront JOIN supplier ON s_name = store WHERE trim(replace(title, chr(160), ' ')) <> ''))""",
    _EXTRA,
)


def _woo_raw(spark, sf):
    name = lambda c: F.struct(c.alias("name"))
    return listings(spark, sf).select(
        "id",
        "ingest_seq",
        F.col("title").alias("name"),
        F.col("id").alias("slug"),
        F.when(F.col("n_variants") < 6, F.col("product_url")).alias("permalink"),
        F.when(F.col("n_variants") > 2, F.concat(_whole("price"), F.lit(".25"))).otherwise("").alias("price"),
        F.concat(_whole("original_price"), F.lit(".5")).alias("regular_price"),
        F.concat(_whole("price"), F.lit(".25")).alias("sale_price"),
        (F.col("n_variants") > 3).alias("manage_stock"),
        F.col("stock").alias("stock_quantity"),
        F.when(F.col("is_in_stock"), "instock").otherwise("outofstock").alias("stock_status"),
        F.when(F.col("sub_category").isNull(), F.array(name(F.col("category")))).otherwise(
            F.array(name(F.col("category")), name(F.col("sub_category")))
        ).alias("categories"),
        F.transform("tags", lambda t: name(t)).alias("tags"),
        F.when(F.col("image_url").isNotNull(), F.array(F.struct(F.col("image_url").alias("src")))).alias("images"),
        F.concat(_whole("rating"), F.lit(".5")).alias("average_rating"),
        F.col("review_count").alias("rating_count"),
        F.col("description").alias("short_description"),
        F.concat(F.lit("<b>"), F.col("brand"), F.lit("</b>")).alias("description"),
        F.concat(F.lit("https://"), F.lower(F.translate("shop_name", "#", "-")), F.lit(".example.com/boutique")).alias("base_url"),
    )


_WOO = [
    "id", "title", "price", "original_price", "currency", "rating", "review_count", "stock", "is_in_stock", "category", "sub_category",
    "shop_name", "description", "image_url", "product_url", "source_platform",
]
QUERIES["normalize_woo"] = lambda spark, sf: normalize.normalize_woo(_woo_raw(spark, sf), F.col("base_url")).select(
    *_WOO, F.array_join("tags", "|").alias("tags")
)
ORACLES["normalize_woo"] = with_ctes(
    "listings",
    """SELECT id, trim(replace(coalesce(title, 'Produit inconnu'), chr(160), ' ')) AS title,
  coalesce(CASE WHEN n_variants > 2 AND p IS NOT NULL THEN p + 0.25e0 ELSE o + 0.5e0 END, 0e0) AS price,
  CASE WHEN o + 0.5e0 > p + 0.25e0 THEN o + 0.5e0 ELSE 0e0 END AS original_price, 'MAD' AS currency,
  CASE WHEN r + 0.5e0 BETWEEN 0.1 AND 5 THEN r + 0.5e0 END AS rating, nullif(review_count, 0) AS review_count,
  CASE WHEN n_variants > 3 THEN stock END AS stock, is_in_stock IS TRUE AS is_in_stock, category, sub_category,
  lower(replace(shop_name, '#', '-')) || '.example.com' AS shop_name,
  trim(regexp_replace(coalesce(description, '<b>' || brand || '</b>', ''), '<[^>]+>', '', 'g')) AS description, image_url,
  CASE WHEN n_variants < 6 THEN product_url ELSE 'https://' || lower(replace(shop_name, '#', '-')) || '.example.com/boutique' END AS product_url,
  'woocommerce' AS source_platform, array_to_string(tags, '|') AS tags
FROM (SELECT *, CAST(floor(price) AS BIGINT) AS p, CAST(floor(original_price) AS BIGINT) AS o, CAST(floor(rating) AS BIGINT) AS r FROM listings)""",
)


def _page_rows(spark, sf):
    return listings(spark, sf).select(
        "ingest_seq",
        "title",
        F.concat(F.lit("dès "), _whole("price"), F.lit(",5 MAD au lieu de "), _whole("original_price")).alias("price_raw"),
        F.when(F.col("n_variants") < 7, F.concat("product_url", F.lit("//"))).otherwise("").alias("product_url"),
        "image_url",
        F.concat(F.lit("https://b"), (F.col("ingest_seq") % 7).cast("string"), F.lit(".example.com/shop")).alias("base_url"),
        F.when(F.col("rating") > 0, F.concat(F.lit("Rated "), F.col("rating").cast("string"), F.lit(" out of 7"))).alias("rating_raw"),
    )


for _platform in ("shopify", "woo"):
    QUERIES[f"normalize_page_rows_{_platform}"] = lambda spark, sf, p=_platform: normalize.normalize_page_rows(_page_rows(spark, sf), p, F.col("base_url"))
    ORACLES[f"normalize_page_rows_{_platform}"] = with_ctes(
        "listings",
        f"""SELECT '{_platform}_' || CASE WHEN n_variants < 7 THEN string_split(product_url, '/')[-1] ELSE 'unknown' END AS id,
  trim(replace(coalesce(title, 'Produit inconnu'), chr(160), ' ')) AS title,
  CASE WHEN price IS NULL OR original_price IS NULL THEN 0e0 ELSE floor(price) + 0.5e0 END AS price, 'MAD' AS currency,
  {"CASE WHEN rating > 0 THEN round_even(rating / 7 * 5 * 100, 0) / 100 END" if _platform == "woo" else "CAST(NULL AS DOUBLE)"} AS rating,
  {"'b' || ingest_seq % 7 || '.example.com'" if _platform == "woo" else "CAST(NULL AS VARCHAR)"} AS shop_name,
  CASE WHEN n_variants < 7 THEN product_url || '//' ELSE '' END AS product_url, image_url,
  '{"woocommerce" if _platform == "woo" else "shopify"}_playwright' AS source_platform FROM listings""",
    )

# ---- pages -----------------------------------------------------------------------------------

QUERIES["strip_html"] = lambda spark, sf: table(spark, sf, "pages").select(
    "page_id", F.md5(parsing.strip_html(F.col("html"))).alias("text_md5"), F.char_length(parsing.strip_html(F.col("html"))).alias("n_chars")
)
ORACLES["strip_html"] = """SELECT page_id, md5(t) AS text_md5, CAST(length(t) AS INTEGER) AS n_chars FROM (
SELECT page_id, regexp_replace(regexp_replace(html, '<[^>]+>', '', 'g'), '^\\s+|\\s+$', '', 'g') AS t FROM pages)"""

QUERIES["page_hosts_and_slugs"] = lambda spark, sf: table(spark, sf, "pages").select(
    "page_id", parsing.url_host(F.col("url")).alias("host"), parsing.page_id(F.col("url"), "woo").alias("slug_id")
)
ORACLES["page_hosts_and_slugs"] = """SELECT page_id, regexp_extract(url, '://([^/?#]*)', 1) AS host,
'woo_' || string_split(rtrim(url, '/'), '/')[-1] AS slug_id FROM pages"""


def _product_pages(spark, sf):
    """One stored product page per listing: structured data as an object, an array or broken, badges and buttons."""
    name = F.regexp_replace("id", "-", " ")
    mark = F.coalesce(F.col("rating").cast("string"), F.lit("0"))
    image = F.when(F.col("n_images") < 10, F.concat(F.lit('["'), F.col("image_url"), F.lit('"]'))).when(
        F.col("n_images") < 20, F.concat(F.lit('{"url": "'), F.col("image_url"), F.lit('"}'))
    ).otherwise(F.concat(F.lit('"'), F.col("image_url"), F.lit('"')))
    rating = F.when(
        F.col("n_variants") != 3,
        F.concat(F.lit(', "aggregateRating": {"ratingValue": "'), mark, F.lit('", "reviewCount": '), F.col("ingest_seq").cast("string"), F.lit("}")),
    ).otherwise("")
    product = F.concat(
        F.lit('{"@type": "Product", "name": "'), name, F.lit('", "sku": "'), F.col("id"),
        F.lit('", "url": "/p/'), F.col("id"), F.lit('", "image": '), F.coalesce(image, F.lit('""')),
        F.lit(', "offers": {'), F.coalesce(F.concat(F.lit('"price": "'), _whole("price"), F.lit(',5", ')), F.lit("")), F.lit('"priceCurrency": "EUR"}'), rating, F.lit("}"),
    )
    thing = F.lit('{"@type": "BreadcrumbList", "name": "trail"}')
    script = (
        F.when(F.col("n_variants") == 1, F.concat(F.lit("["), thing, F.lit(", "), product, F.lit("]")))
        .when(F.col("n_variants") == 2, F.lit('{"@type": "Product", '))
        .otherwise(product)
    )
    html = F.concat(
        F.lit('<html><head><script type="application/ld+json">'), script, F.lit("</script></head><body>"),
        F.lit('<span class="x spr-badge-caption"><b>'), F.col("n_images").cast("string"), F.lit(".5</b> sur 5</span>"),
        F.lit("<button>Menu</button>"),
        F.when(F.col("n_variants") == 4, F.lit("<button disabled>Add to cart</button>"))
        .when(F.col("n_variants") == 5, F.lit("<button class='b'><i>Ajouter</i></button>"))
        .otherwise(""),
        F.lit("</body></html>"),
    )
    return (
        listings(spark, sf)
        .select(F.concat_ws("/", "id", F.col("ingest_seq").cast("string")).alias("page_id"), F.lit("https://m.example.com/").alias("url"), html.alias("html"))
    )


QUERIES["extract_jsonld_products"] = lambda spark, sf: normalize.extract_jsonld_products(_product_pages(spark, sf)).drop("base_url")
ORACLES["extract_jsonld_products"] = with_ctes(
    "listings",
    """SELECT id || '/' || ingest_seq AS page_id, replace(id, '-', ' ') AS title, '' AS description, coalesce(floor(price) + 0.5e0, 0e0) AS price,
'EUR' AS currency, 'https://m.example.com/p/' || id AS product_url, coalesce(image_url, '') AS image_url, id AS sku
FROM listings WHERE n_variants <> 2""",
)

QUERIES["products_from_pages"] = lambda spark, sf: validate_catalog(normalize.products_from_pages(_product_pages(spark, sf)))[0].drop("shop_name", "rating")
ORACLES["products_from_pages"] = with_ctes(
    "listings",
    """SELECT 'shopify_' || id AS id, replace(id, '-', ' ') AS title, '' AS description, CASE WHEN price IS NULL THEN 0e0 ELSE trunc(price) + 0.5e0 END AS price,
'EUR' AS currency, 'https://m.example.com/p/' || id AS product_url, coalesce(image_url, '') AS image_url, 'shopify_playwright' AS source_platform
FROM listings WHERE n_variants <> 2""",
)

QUERIES["extract_page_observations"] = lambda spark, sf: normalize.extract_page_observations(_product_pages(spark, sf))
ORACLES["extract_page_observations"] = with_ctes(
    "listings",
    """SELECT id || '/' || ingest_seq AS page_id, CASE WHEN n_variants IN (2, 3) THEN n_images + 0.5e0 ELSE coalesce(rating, 0e0) END AS rating,
CASE WHEN n_variants NOT IN (2, 3) THEN ingest_seq END AS review_count, n_variants <> 4 AS is_in_stock FROM listings""",
)

QUERIES["page_observations"] = lambda spark, sf: normalize.extract_page_observations(table(spark, sf, "pages"))
ORACLES["page_observations"] = (
    "SELECT page_id, CAST(NULL AS DOUBLE) AS rating, CAST(NULL AS BIGINT) AS review_count, true AS is_in_stock FROM pages"
)

# ---- whole sources ---------------------------------------------------------------------------


def _all_sources(spark, sf):
    return normalize.union_sources(
        [
            normalize.normalize_storefront_bulk(_storefront_raw(spark, sf), _stores(spark, sf)),
            lambda: spark.read.parquet(f"{sf}/no_such_source.parquet"),
            lambda: normalize.normalize_woo(_woo_raw(spark, sf), F.col("base_url")),
        ]
    )


QUERIES["union_sources"] = lambda spark, sf: _all_sources(spark, sf).groupBy("source_platform").agg(
    F.count("*").alias("records"), F.count("sub_category").alias("with_sub_category"), F.count("discount_pct").alias("with_discount_pct")
)
ORACLES["union_sources"] = with_ctes(
    "listings",
    """SELECT 'woocommerce' AS source_platform, count(*) AS records, count(sub_category) AS with_sub_category, 0 AS with_discount_pct FROM listings
UNION ALL SELECT 'shopify', count(*), 0, count(*) FROM listings WHERE trim(replace(title, chr(160), ' ')) <> ''""",
)

QUERIES["backfill_description"] = lambda spark, sf: normalize.backfill_description(listings(spark, sf)).select(
    "id", "ingest_seq", "description"
)
ORACLES["backfill_description"] = with_ctes(
    "listings",
    """SELECT id, ingest_seq, CASE WHEN trim(coalesce(description, '')) = '' THEN title || ' est un produit de la catégorie '
|| coalesce(category, 'Inconnu') || ', proposé sur ' || source_platform || '.' ELSE description END AS description FROM listings""",
)

QUERIES["source_counts"] = lambda spark, sf: normalize.source_counts(listings(spark, sf))
ORACLES["source_counts"] = with_ctes("listings", "SELECT shop_name, count(*) AS n_products FROM listings GROUP BY 1")
