"""DuckDB CTEs the oracles start from, written independently of the Spark code."""

from __future__ import annotations

LISTINGS = """
SELECT concat(l_partkey, '-', l_suppkey) AS id,
  CASE WHEN l_quantity = 7 THEN ' ' || chr(160) || ' ' WHEN l_quantity = 11 THEN NULL ELSE p_name || ' ' || p_partkey END AS title,
  CASE WHEN l_discount >= 0.05 THEN '<p>' || p_name || '</p>' WHEN l_discount >= 0.03 THEN '  ' END AS description,
  CASE WHEN p_size < 50 THEN p_type END AS category,
  CASE WHEN p_size > 25 THEN 'large' END AS sub_category,
  CASE WHEN s_acctbal >= 500 THEN p_brand END AS brand,
  CASE WHEN p_size > 30 THEN list_concat(string_split(p_name, ' '), [p_type, p_brand]) ELSE string_split(p_name, ' ') END AS tags,
  CASE WHEN p_size >= 5 THEN 'https://cdn.example.com/' || l_partkey END AS image_url,
  'https://shop' || l_suppkey || '.example.com/products/' || l_partkey AS product_url,
  CASE WHEN l_quantity = 17 THEN 0e0 WHEN l_quantity = 19 THEN NULL
       ELSE floor(l_extendedprice / l_quantity * (1 - l_discount) * 100 + 0.5) / 100e0 END AS price,
  CASE WHEN l_discount > 0 THEN floor(l_extendedprice / l_quantity * 100 + 0.5) / 100e0 END AS original_price,
  'MAD' AS currency,
  CASE WHEN l_returnflag = 'N' AND l_linestatus = 'O' THEN NULL
       ELSE floor(l_tax * 100 + 0.5) / 2e0 + 1 + CASE l_returnflag WHEN 'R' THEN -2 WHEN 'A' THEN 1 ELSE 0 END END AS rating,
  CASE WHEN l_quantity <> 23 THEN CAST(l_quantity * l_linenumber AS BIGINT) END AS review_count,
  CASE WHEN l_quantity <> 29 THEN CAST(CASE l_linestatus WHEN 'F' THEN 0 ELSE l_quantity END AS BIGINT) END AS stock,
  CASE WHEN l_quantity <> 29 THEN l_linestatus <> 'F' END AS is_in_stock,
  s_name AS shop_name, n_name AS shop_country, r_name AS source_platform,
  CAST(l_linenumber AS BIGINT) AS n_variants, CAST(p_size AS BIGINT) AS n_images,
  l_shipdate AS scraped_at, l_orderkey * 10 + l_linenumber AS ingest_seq
FROM lineitem JOIN part ON p_partkey = l_partkey JOIN supplier ON s_suppkey = l_suppkey
     JOIN nation ON n_nationkey = s_nationkey JOIN region ON r_regionkey = n_regionkey"""

DEDUPED = """
SELECT * FROM listings QUALIFY row_number() OVER (PARTITION BY id ORDER BY ingest_seq, scraped_at) = 1"""

TITLED = """
SELECT * FROM deduped WHERE title IS NOT NULL AND trim(replace(title, chr(160), ' ')) <> ''"""

PRICED = """
SELECT * REPLACE (CASE WHEN price IS NULL OR price = 0
                       THEN (SELECT quantile_cont(price, 0.5) FROM titled WHERE price > 0) ELSE price END AS price)
FROM titled"""

SILVER = """
SELECT id, title, description, coalesce(category, 'Inconnu') AS category, coalesce(sub_category, 'Inconnu') AS sub_category,
  coalesce(brand, 'Inconnu') AS brand, array_to_string(tags, ',') AS tags, image_url, product_url, price,
  coalesce(original_price, price) AS original_price, currency,
  CASE WHEN rating IS NULL OR rating < 0 THEN 0e0 WHEN rating > 5 THEN 5e0 ELSE rating END AS rating,
  coalesce(review_count, 0) AS review_count, coalesce(stock, 0) AS stock, coalesce(is_in_stock, true) AS is_in_stock,
  shop_name, shop_country, source_platform, n_variants, n_images, scraped_at, ingest_seq,
  CASE WHEN original_price > price THEN round_even((original_price - price) / original_price * 100 * 100, 0) / 100 ELSE 0e0 END
    AS discount_percentage
FROM priced"""


def _scores(price_score: str, stock: str, discount: str, variants: str, images: str, tags: str, complete: str) -> str:
    return f"""
SELECT s.*, {price_score} AS price_score, rating / 5 AS rating_score, ln(1 + review_count) AS log_reviews,
  ln(1 + review_count) / (SELECT max(ln(1 + review_count)) FROM silver) AS popularity_score,
  {stock} AS stock_score, {discount} AS discount_score, {variants} AS variant_diversity, {images} AS n_images_norm,
  ln(1 + greatest(price, 0)) AS log_price,
  least(greatest(price / CASE WHEN cat_median = 0 THEN 1 ELSE cat_median END, 0), 5) AS ratio,
  brand_n / CAST((SELECT count(*) FROM silver) AS DOUBLE) AS brand_score,
  cat_n / CAST((SELECT count(*) FROM silver) AS DOUBLE) AS category_popularity,
  least(greatest(shop_avg / 5, 0), 1) AS shop_reputation,
  ({complete}) * CASE WHEN price = 0 THEN 0.5e0 ELSE 1e0 END AS product_completeness,
  CAST(is_in_stock AS DOUBLE) AS is_in_stock_flag,
  (least(greatest(length(title), 10), 100) - 10) / 90e0 AS title_length_norm, {tags} AS tag_diversity
FROM silver s
  JOIN (SELECT category AS c, quantile_cont(price, 0.5) AS cat_median, count(*) AS cat_n FROM silver GROUP BY 1) ON c = category
  JOIN (SELECT brand AS b, count(*) AS brand_n FROM silver GROUP BY 1) ON b = brand
  JOIN (SELECT shop_name AS h, avg(rating) AS shop_avg FROM silver GROUP BY 1) ON h = shop_name"""


_LATE = """
SELECT *, CASE WHEN rating = 0 THEN 0e0 ELSE rating_score * price_score END AS value_for_money,
  1 - least(abs(ratio - 1), 4) / 4 AS price_to_median_ratio, least(abs(ratio - 1), 4) / 4 AS price_volatility,
  CASE WHEN discount_score > 0 THEN 1e0 ELSE 0e0 END AS has_discount_flag,
  popularity_score * rating_score AS review_rating_coherence
FROM """


def _max_of(expr: str) -> str:
    return f"(SELECT max({expr}) FROM silver)"


def _q95_of(expr: str) -> str:
    return f"(SELECT quantile_cont(CAST({expr} AS DOUBLE), 0.95) FROM silver)"


def _robust(expr: str) -> str:
    return f"CASE WHEN {_q95_of(expr)} > 0 THEN least(greatest({expr} / {_q95_of(expr)}, 0), 1) ELSE 0.5e0 END"


CTES: dict[str, tuple[str, list[str]]] = {
    "listings": (LISTINGS, []),
    "deduped": (DEDUPED, ["listings"]),
    "titled": (TITLED, ["deduped"]),
    "priced": (PRICED, ["titled"]),
    "silver": (SILVER, ["priced"]),
    "max_scores": (
        _scores(
            f"1 - price / {_max_of('price')}",
            f"stock / CAST({_max_of('stock')} AS DOUBLE)",
            f"discount_percentage / {_max_of('discount_percentage')}",
            f"least(n_variants, 20) / CAST({_max_of('least(n_variants, 20)')} AS DOUBLE)",
            f"least(n_images, 10) / CAST({_max_of('least(n_images, 10)')} AS DOUBLE)",
            "0e0",
            "1e0",
        ),
        ["silver"],
    ),
    "max_late": (_LATE + "max_scores", ["max_scores"]),
    "features_max": (
        """SELECT *, 0.30 * rating_score + 0.25 * popularity_score + 0.20 * discount_score + 0.15 * value_for_money
  + 0.10 * product_completeness AS composite_score FROM max_late""",
        ["max_late"],
    ),
    "q95_scores": (
        _scores(
            f"1 - {_robust('price')}",
            _robust("stock"),
            _robust("discount_percentage"),
            _robust("least(n_variants, 20)"),
            _robust("least(n_images, 10)"),
            "least(len(string_split(tags, ',')), 10) / CAST((SELECT max(least(len(string_split(tags, ',')), 10)) FROM silver) AS DOUBLE)",
            "(5 + CASE WHEN image_url IS NULL THEN 0 ELSE 1 END) / 6e0",
        ),
        ["silver"],
    ),
    "q95_late": (_LATE + "q95_scores", ["q95_scores"]),
    "features_q95": (
        """SELECT *, 0.25 * rating_score + 0.20 * popularity_score + 0.12 * value_for_money + 0.12 * discount_score
  + 0.08 * price_score + 0.06 * stock_score + 0.06 * shop_reputation + 0.05 * review_rating_coherence
  + 0.03 * brand_score + 0.03 * product_completeness AS composite_score FROM q95_late""",
        ["q95_late"],
    ),
    "strict": (
        """SELECT * REPLACE (coalesce(rating, 0) AS rating, CAST(coalesce(review_count, 0) AS DOUBLE) AS review_count) FROM deduped
WHERE title IS NOT NULL AND price > 0 AND price < 10000 AND coalesce(rating, 0) BETWEEN 0 AND 5""",
        ["deduped"],
    ),
    "ops_raw": (
        """SELECT *, 0.4 * rating + 0.3 * ln(1 + review_count) + 100 / (price + 1) * 0.3 AS popularity_score,
  price / (rating + 0.1) AS price_rating_ratio, review_count / (price + 1) AS review_density,
  CASE WHEN rating >= 4.5 THEN 1 ELSE 0 END AS is_high_rated,
  CASE WHEN review_count >= (SELECT quantile_cont(review_count, 0.5) FROM strict) THEN 1 ELSE 0 END AS is_popular FROM strict""",
        ["strict"],
    ),
}


def with_ctes(wanted: str | list[str], query: str, extra: dict[str, tuple[str, list[str]]] | None = None) -> str:
    """``query`` preceded by the wanted CTEs and everything they need, in order."""
    known = {**CTES, **(extra or {})}
    order: list[str] = []

    def visit(name: str) -> None:
        if name in order:
            return
        for need in known[name][1]:
            visit(need)
        order.append(name)

    for name in [wanted] if isinstance(wanted, str) else wanted:
        visit(name)
    body = ",\n".join(f"{name} AS MATERIALIZED ({known[name][0]})" for name in order)
    return f"WITH {body}\n{query}"


def rounded(columns: list[str], digits: int = 6) -> str:
    """Select list of the columns rounded half to even."""
    scale = f"1e{digits}"
    return ", ".join(f"round_even({c} * {scale}, 0) / {scale} AS {c}" for c in columns)
