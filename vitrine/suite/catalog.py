"""Registered queries over the published catalog."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.scalars import np_round
from ..operators import segment
from ..plans import arguments as args
from ..plans import context, dashboard, tools
from . import data
from .oracle_base import rounded, with_ctes

QUERIES = {}
ORACLES = {}

_F = segment.CLUSTER_FEATURES


def _z(c: str) -> str:
    return f"({c} - (SELECT avg({c}) FROM features_max)) / (SELECT stddev_pop({c}) FROM features_max)"


def _distance(centre: list[float]) -> str:
    return " + ".join(f"(z_{c} - ({x})) * (z_{c} - ({x}))" for c, x in zip(_F, centre))


EXTRA = {
    "scaled": (f"SELECT *, {', '.join(f'{_z(c)} AS z_{c}' for c in _F)} FROM features_max", ["features_max"]),
    "assigned": (
        "SELECT * EXCLUDE (composite_score), list_position(ds, list_min(ds)) - 1 AS cluster FROM (SELECT *, ["
        + ", ".join(_distance(c) for c in data.CENTRES)
        + "] AS ds FROM scaled)",
        ["scaled"],
    ),
    # The stored centres' names, worked out by hand in DuckDB: scores, then one choice after another.
    "centres": (
        "SELECT * FROM (VALUES "
        + ", ".join(f"({i}, {', '.join(f'{x}e0' for x in c)})" for i, c in enumerate(data.CENTRES))
        + f") t(cluster, {', '.join(_F)})",
        [],
    ),
    "profiles": (
        "SELECT cluster, 0e0 AS stock_score, "
        + ", ".join(f"({c} - min({c}) OVER ()) / (max({c}) OVER () - min({c}) OVER ()) AS {c}" for c in _F)
        + " FROM centres",
        ["centres"],
    ),
    "name_scores": (
        """SELECT cluster, 0.45 * log_price + 0.35 * rating_score + 0.2 * popularity_score AS s1,
0.4 * discount_score + 0.35 * (1 - log_price) + 0.25 * (1 - rating_score) AS s2,
0.55 * popularity_score + 0.25 * rating_score + 0.2 * stock_score AS s3,
0.5 * (1 - popularity_score) + 0.3 * (1 - stock_score) + 0.2 * (1 - rating_score) AS s4 FROM profiles""",
        ["profiles"],
    ),
    "n1": ("SELECT cluster FROM name_scores ORDER BY s1 DESC, cluster LIMIT 1", ["name_scores"]),
    "n2": ("SELECT cluster FROM name_scores WHERE cluster NOT IN (FROM n1) ORDER BY s2 DESC, cluster LIMIT 1", ["n1"]),
    "n3": ("SELECT cluster FROM name_scores WHERE cluster NOT IN (FROM n1 UNION ALL FROM n2) ORDER BY s3 DESC, cluster LIMIT 1", ["n2"]),
    "n4": (
        "SELECT cluster FROM name_scores WHERE cluster NOT IN (FROM n1 UNION ALL FROM n2 UNION ALL FROM n3) ORDER BY s4 DESC, cluster LIMIT 1",
        ["n3"],
    ),
    "names": (
        """SELECT cluster, 'Premium' AS cluster_label FROM n1 UNION ALL SELECT cluster, 'Budget' FROM n2
UNION ALL SELECT cluster, 'Populaire' FROM n3 UNION ALL SELECT cluster, 'Inactif' FROM n4""",
        ["n4"],
    ),
    "scored": (
        """SELECT *, least(CASE cluster_label WHEN 'Premium' THEN 0.92e0 WHEN 'Populaire' THEN 0.82e0 WHEN 'Budget' THEN 0.62e0
  WHEN 'Inactif' THEN 0.25e0 ELSE 0.5e0 END + 0.08 * rating_score + 0.08 * popularity_score + 0.04 * discount_score, 1) AS composite_raw,
  CAST(cluster_label IN ('Premium', 'Populaire') AS INTEGER) AS is_top_product,
  0.5 * (z_log_price + z_rating_score + z_popularity_score + z_discount_score) AS PC1,
  0.5 * (z_log_price + z_rating_score - z_popularity_score - z_discount_score) AS PC2
FROM assigned JOIN names USING (cluster)""",
        ["assigned", "names"],
    ),
    "published": (
        """SELECT *, round_even(composite_raw * 1e6, 0) / 1e6 AS composite_score,
  CASE WHEN review_count >= 300 THEN -1 ELSE 0 END AS dbscan_cluster, CASE WHEN review_count >= 300 THEN 1 ELSE 0 END AS dbscan_outlier,
  CASE WHEN price > p95 THEN 1 ELSE 0 END AS iforest_outlier, CASE WHEN price > p95 THEN 1 ELSE 0 END AS price_anomaly_flag,
  CASE WHEN price > p95 OR review_count >= 300 THEN 1 ELSE 0 END AS is_anomaly, 75e0 AS pca_variance_explained,
  round_even((price - lo) / (hi - lo) * 1e6, 0) / 1e6 AS price_anomaly_score
FROM scored, (SELECT quantile_cont(price, 0.95) AS p95, min(price) AS lo, max(price) AS hi FROM silver)""",
        ["scored"],
    ),
}


def _sql(query: str, wanted="published") -> str:
    return with_ctes(wanted, query, EXTRA)


def _r(expr: str, digits: int) -> str:
    return f"round_even({expr} * 1e{digits}, 0) / 1e{digits}"


pub = data.published

# ---- stored-model scoring --------------------------------------------------------------------

QUERIES["zscore"] = lambda spark, sf: data.rounded(segment.zscore(data.features(spark, sf), _F).select("id", *data.SCALED), data.SCALED)
ORACLES["zscore"] = _sql(f"SELECT id, {rounded(data.SCALED)} FROM scaled", "scaled")

QUERIES["nearest_centre"] = lambda spark, sf: data.scored(spark, sf).select("id", "cluster")
ORACLES["nearest_centre"] = _sql("SELECT id, CAST(cluster AS INTEGER) AS cluster FROM assigned", "assigned")

QUERIES["name_clusters"] = lambda spark, sf: (
    segment.name_clusters(segment.centre_table(spark, _F, data.CENTRES)).join(
        data.scored(spark, sf).groupBy("cluster").agg(F.count("*").alias("members")), "cluster"
    )
)
ORACLES["name_clusters"] = _sql("SELECT CAST(cluster AS INTEGER) AS cluster, cluster_label, count(*) AS members FROM scored GROUP BY 1, 2", "scored")


def _group_centres(spark, sf):
    """Mean profile per platform, named as if platforms were clusters."""
    table = data.features(spark, sf).groupBy("source_platform").agg(*[np_round(F.avg(c), 6).alias(c) for c in segment.PROFILE_FEATURES])
    numbered = table.withColumn("cluster", F.ascii("source_platform") * 256 + F.ascii(F.substring("source_platform", 2, 1)))
    bounds = {c: {"min": 0.0, "max": 1.0} for c in segment.PROFILE_FEATURES[1:]}
    return numbered.join(segment.name_clusters(numbered, bounds), "cluster").select("source_platform", "cluster_label")


QUERIES["name_clusters_with_bounds"] = _group_centres
ORACLES["name_clusters_with_bounds"] = with_ctes(
    "s",
    """, w1 AS (SELECT p FROM s ORDER BY 0.45 * lp + 0.35 * rs + 0.2 * ps DESC, c LIMIT 1),
w2 AS (SELECT p FROM s WHERE p NOT IN (FROM w1) ORDER BY 0.4 * ds + 0.35 * (1 - lp) + 0.25 * (1 - rs) DESC, c LIMIT 1),
w3 AS (SELECT p FROM s WHERE p NOT IN (FROM w1 UNION ALL FROM w2) ORDER BY 0.55 * ps + 0.25 * rs + 0.2 * ss DESC, c LIMIT 1),
w4 AS (SELECT p FROM s WHERE p NOT IN (FROM w1 UNION ALL FROM w2 UNION ALL FROM w3)
       ORDER BY 0.5 * (1 - ps) + 0.3 * (1 - ss) + 0.2 * (1 - rs) DESC, c LIMIT 1)
SELECT p AS source_platform, CASE WHEN p IN (FROM w1) THEN 'Premium' WHEN p IN (FROM w2) THEN 'Budget' WHEN p IN (FROM w3) THEN 'Populaire'
WHEN p IN (FROM w4) THEN 'Inactif' ELSE 'Inconnu' END AS cluster_label FROM s""",
    {
        "m": (
            """SELECT source_platform AS p, ascii(source_platform) * 256 + ascii(source_platform[2]) AS c,
round_even(avg(log_price) * 1e6, 0) / 1e6 AS lp, round_even(avg(rating_score) * 1e6, 0) / 1e6 AS rs,
round_even(avg(popularity_score) * 1e6, 0) / 1e6 AS ps, round_even(avg(stock_score) * 1e6, 0) / 1e6 AS ss,
round_even(avg(discount_score) * 1e6, 0) / 1e6 AS ds FROM features_max GROUP BY 1, 2""",
            ["features_max"],
        ),
        "s": ("SELECT * REPLACE ((lp - min(lp) OVER ()) / (max(lp) OVER () - min(lp) OVER ()) AS lp) FROM m", ["m"]),
    },
).replace("\n,", ",", 1)

QUERIES["cluster_score_and_top_flag"] = lambda spark, sf: data.rounded(
    data.scored(spark, sf).select("id", "cluster_label", "composite_score", "is_top_product"), ["composite_score"]
)
ORACLES["cluster_score_and_top_flag"] = _sql(f"SELECT id, cluster_label, is_top_product, {_r('composite_raw', 6)} AS composite_score FROM scored", "scored")

QUERIES["anomaly_fusion_and_downweight"] = lambda spark, sf: data.rounded(
    segment.downweight_anomalies(pub(spark, sf)).select("id", "is_anomaly", "price_anomaly_flag", "composite_score"), ["composite_score"]
)
ORACLES["anomaly_fusion_and_downweight"] = _sql(
    f"""SELECT id, is_anomaly, price_anomaly_flag,
{_r('(composite_score * CASE is_anomaly WHEN 1 THEN 0.9e0 ELSE 1e0 END)', 6)} AS composite_score FROM published"""
)

QUERIES["output_defaults"] = lambda spark, sf: segment.with_output_defaults(data.silver(spark, sf)).groupBy(
    "cluster", "cluster_label", "is_anomaly", "PC1", "is_top_product", "composite_score"
).agg(F.count("*").alias("n"))
ORACLES["output_defaults"] = with_ctes(
    "silver",
    """SELECT 0 AS cluster, 'Inconnu' AS cluster_label, 0 AS is_anomaly, 0e0 AS PC1, 0 AS is_top_product, 0e0 AS composite_score,
count(*) AS n FROM silver""",
)

# ---- tools -----------------------------------------------------------------------------------

_TOP = "title, price, rating, review_count, round_even(composite_score * 1e4, 0) / 1e4 AS composite_score, cluster_label, price_anomaly_flag, category, shop_name"
QUERIES["top_products"] = lambda spark, sf: tools.with_total(tools.top_products(pub(spark, sf)), "total")
ORACLES["top_products"] = _sql(
    f"SELECT {_TOP}, count(*) OVER () AS total FROM (SELECT * FROM published WHERE is_top_product = 1 ORDER BY composite_score DESC, id LIMIT 10)"
)
QUERIES["top_products_by_category"] = lambda spark, sf: tools.with_total(
    tools.top_products(pub(spark, sf), args.TopProducts(limit=50, category="Promo", min_score=0.9)), "total"
)
ORACLES["top_products_by_category"] = _sql(
    f"""SELECT {_TOP}, count(*) OVER () AS total FROM (SELECT * FROM published WHERE is_top_product = 1 AND lower(category) = 'promo'
AND composite_score >= 0.9 ORDER BY composite_score DESC, id LIMIT 50)"""
)

_MEANS = ", ".join(f"{_r(f'avg({c})', 3)} AS {c}" for c in ("price", "rating", "composite_score", "discount_score"))
QUERIES["cluster_summary"] = lambda spark, sf: tools.cluster_summary(pub(spark, sf), args.ClusterSummary(include_products=True)).withColumn(
    "examples", F.array_join("examples", " / ")
)
ORACLES["cluster_summary"] = _sql(
    f"""SELECT CAST(cluster AS INTEGER) AS cluster, cluster_label, {_MEANS}, count(title) AS n_products, any_value(ex) AS examples FROM published
JOIN (SELECT cluster AS c, string_agg(title, ' / ' ORDER BY nth) AS ex FROM (SELECT cluster, title,
  row_number() OVER (PARTITION BY cluster ORDER BY ingest_seq, scraped_at, id) AS nth FROM published) WHERE nth <= 3 GROUP BY 1) ON c = cluster
GROUP BY 1, 2"""
)

QUERIES["anomalies"] = lambda spark, sf: tools.anomalies(pub(spark, sf), args.Anomalies(limit=20))
ORACLES["anomalies"] = _sql(
    """SELECT title, price, rating, round_even(price_anomaly_score * 1e4, 0) / 1e4 AS price_anomaly_score, category, shop_name
FROM published WHERE price_anomaly_flag = 1 ORDER BY ingest_seq, scraped_at, id LIMIT 20"""
)
QUERIES["anomaly_totals"] = lambda spark, sf: tools.anomaly_totals(pub(spark, sf))
ORACLES["anomaly_totals"] = _sql(
    f"""SELECT count(*) FILTER (price_anomaly_flag = 1) AS total_anomalies,
{_r('(count(*) FILTER (price_anomaly_flag = 1) / CAST(count(*) AS DOUBLE) * 100)', 2)} AS anomaly_rate_pct FROM published"""
)

QUERIES["catalog_totals"] = lambda spark, sf: tools.catalog_totals(pub(spark, sf))
ORACLES["catalog_totals"] = _sql(
    f"""SELECT count(*) AS total_products, {_r('avg(price)', 2)} AS avg_price, {_r('avg(rating)', 2)} AS avg_rating,
count(DISTINCT category) AS n_categories, count(DISTINCT shop_name) AS n_shops FROM published"""
)
for _key in ("category", "shop_name", "source_platform"):
    QUERIES[f"catalog_stats_{_key}"] = lambda spark, sf, k=_key: tools.catalog_stats(pub(spark, sf), args.CatalogStats(group_by=k))
    ORACLES[f"catalog_stats_{_key}"] = _sql(
        f"""SELECT {_key}, count(title) AS n_products, {_r('avg(price)', 3)} AS avg_price, {_r('avg(rating)', 3)} AS avg_rating
FROM published GROUP BY 1 ORDER BY 1 LIMIT 20"""
    )

_SEARCH = args.SearchProducts(
    query="^(red|blue) .*[0-9]$", category="economy", min_price=100.0, max_price=20000.0, min_rating=1.0, in_stock_only=True, limit=100
)
_FOUND = "title, price, rating, round_even(composite_score * 1e4, 0) / 1e4 AS composite_score, cluster_label, shop_name"
QUERIES["search_products"] = lambda spark, sf: tools.with_total(tools.search_products(pub(spark, sf), _SEARCH), "total_found")
ORACLES["search_products"] = _sql(
    f"""SELECT {_FOUND}, count(*) OVER () AS total_found FROM (SELECT * FROM published WHERE regexp_matches(title, '^(red|blue) .*[0-9]$', 'i')
AND category = 'ECONOMY' AND price BETWEEN 100 AND 20000 AND rating >= 1 AND stock > 0 ORDER BY composite_score DESC, id LIMIT 100)"""
)

for _by in ("composite_score", "rating", "n_products"):
    QUERIES[f"shop_ranking_{_by}"] = lambda spark, sf, b=_by: tools.shop_ranking(pub(spark, sf), args.ShopRanking(sort_by=b))
    ORACLES[f"shop_ranking_{_by}"] = _sql(
        f"""SELECT shop_name, count(title) AS n_products, {_r('avg(composite_score)', 3)} AS composite_score, {_r('avg(rating)', 3)} AS rating,
{_r('avg(price)', 3)} AS price FROM published GROUP BY 1 ORDER BY {_by} DESC, shop_name LIMIT 10"""
    )

# ---- dashboard -------------------------------------------------------------------------------

_CHOICE = dict(categories=["PROMO", "SMALL"], platforms=["ASIA", "EUROPE"], price_range=(50.0, 5000.0), in_stock=True)
QUERIES["filter_catalog"] = lambda spark, sf: dashboard.filter_catalog(pub(spark, sf), **_CHOICE).select("id", "title", "price", "category")
ORACLES["filter_catalog"] = _sql(
    """SELECT id, title, price, category FROM published WHERE category IN ('PROMO', 'SMALL') AND source_platform IN ('ASIA', 'EUROPE')
AND price BETWEEN 50 AND 5000 AND is_in_stock"""
)

QUERIES["filter_values"] = lambda spark, sf: (
    dashboard.filter_values(pub(spark, sf), "category").withColumn("filter", F.lit("category"))
    .unionAll(dashboard.filter_values(pub(spark, sf), "shop_name", 20).withColumn("filter", F.lit("shop")))
    .unionAll(dashboard.filter_values(pub(spark, sf), "source_platform").withColumn("filter", F.lit("platform")))
)
ORACLES["filter_values"] = _sql(
    """SELECT DISTINCT category AS value, 'category' AS filter FROM published UNION ALL SELECT DISTINCT source_platform, 'platform' FROM published
UNION ALL (SELECT DISTINCT shop_name, 'shop' FROM published ORDER BY 1 LIMIT 20)"""
)
QUERIES["price_bounds"] = lambda spark, sf: dashboard.price_bounds(pub(spark, sf))
ORACLES["price_bounds"] = _sql("SELECT min(price) AS min_price, max(price) AS max_price FROM published")

QUERIES["kpi_row"] = lambda spark, sf: dashboard.kpi_row(pub(spark, sf))
ORACLES["kpi_row"] = _sql(
    f"""SELECT count(*) AS n_products, {_r('avg(price)', 2)} AS avg_price, {_r('avg(rating)', 2)} AS avg_rating,
CAST(sum(is_top_product) AS BIGINT) AS n_top, count(DISTINCT shop_name) AS n_shops, CAST(sum(review_count) AS BIGINT) AS total_reviews FROM published"""
)
QUERIES["category_top"] = lambda spark, sf: dashboard.category_top(pub(spark, sf))
ORACLES["category_top"] = _sql("SELECT category, count(*) AS n_products FROM published GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10")

QUERIES["price_boxes"] = lambda spark, sf: data.rounded(dashboard.price_boxes(pub(spark, sf)), ["q1", "median", "q3"])
ORACLES["price_boxes"] = _sql(
    f"""SELECT category, min(price) AS low, max(price) AS high, {_r('quantile_cont(price, 0.25)', 6)} AS q1, {_r('quantile_cont(price, 0.5)', 6)} AS median,
{_r('quantile_cont(price, 0.75)', 6)} AS q3 FROM published
WHERE category IN (SELECT category FROM published GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 5) GROUP BY 1"""
)

QUERIES["insights_row"] = lambda spark, sf: dashboard.insights_row(pub(spark, sf))
ORACLES["insights_row"] = _sql(
    f"""SELECT count(*) FILTER (is_top_product = 1) AS n_top, {_r('(avg(is_top_product) * 100)', 1)} AS top_pct,
count(*) FILTER (dbscan_cluster = -1) AS n_noise, {_r('(avg(dbscan_outlier) * 100)', 1)} AS noise_pct,
{_r('(avg(is_in_stock_flag) * 100)', 0)} AS in_stock_pct, {_r('avg(price) FILTER (is_top_product = 1)', 2)} AS avg_top_price FROM published"""
)

QUERIES["topk_table"] = lambda spark, sf: dashboard.topk_table(dashboard.top_k(pub(spark, sf), 20), ["PROMO", "LARGE", "ECONOMY"])
ORACLES["topk_table"] = _sql(
    f"""SELECT title, price, rating, review_count, {_r('composite_score', 3)} AS composite_score, category, shop_name, source_platform
FROM (SELECT * FROM published ORDER BY composite_score DESC, id LIMIT 20) WHERE category IN ('PROMO', 'LARGE', 'ECONOMY')"""
)
QUERIES["top_k_popularity"] = lambda spark, sf: dashboard.top_k(
    data.rounded(data.features(spark, sf, "ops").select("id", "title", "popularity_score"), ["popularity_score"]), 30, "popularity_score"
)
ORACLES["top_k_popularity"] = with_ctes(
    "ops_raw",
    f"SELECT * FROM (SELECT id, title, {rounded(['popularity_score'])} FROM ops_raw) ORDER BY popularity_score DESC, id LIMIT 30",
)

for _key in ("shop_name", "source_platform"):
    QUERIES[f"group_summary_{_key}"] = lambda spark, sf, k=_key: dashboard.group_summary(pub(spark, sf), k)
    ORACLES[f"group_summary_{_key}"] = _sql(
        f"""SELECT {_key}, count(title) AS n_products, {_r('avg(composite_score)', 3)} AS avg_score, {_r('avg(price)', 3)} AS avg_price,
{_r('avg(rating)', 3)} AS avg_rating FROM published GROUP BY 1"""
    )

QUERIES["cluster_profile"] = lambda spark, sf: dashboard.cluster_profile(pub(spark, sf))
ORACLES["cluster_profile"] = _sql(
    f"SELECT cluster_label, {_MEANS}, {_r('avg(stock)', 3)} AS stock, count(title) AS n_products FROM published GROUP BY 1"
)

QUERIES["detector_attribution"] = lambda spark, sf: (
    pub(spark, sf).groupBy(dashboard.detector(pub(spark, sf)).alias("detector_model")).agg(F.count("*").alias("n"))
)
_DETECTOR = """CASE WHEN dbscan_outlier + iforest_outlier = 2 THEN 'DBSCAN + Isolation Forest' WHEN dbscan_outlier = 1 THEN 'DBSCAN'
WHEN iforest_outlier = 1 THEN 'Isolation Forest' ELSE 'Aucun' END"""
ORACLES["detector_attribution"] = _sql(f"SELECT {_DETECTOR} AS detector_model, count(*) AS n FROM published GROUP BY 1")
QUERIES["detector_fallback_columns"] = lambda spark, sf: (
    (bare := pub(spark, sf).drop("dbscan_outlier", "iforest_outlier")).groupBy(dashboard.detector(bare).alias("detector_model")).agg(F.count("*").alias("n"))
)
ORACLES["detector_fallback_columns"] = ORACLES["detector_attribution"]

QUERIES["anomaly_table"] = lambda spark, sf: dashboard.anomaly_table(pub(spark, sf))
ORACLES["anomaly_table"] = _sql(
    f"""SELECT title, price, rating, review_count, cluster_label, dbscan_outlier, iforest_outlier, price_anomaly_score, is_anomaly, shop_name,
source_platform, {_DETECTOR} AS detector_model FROM published WHERE is_anomaly = 1"""
)
QUERIES["anomaly_rate"] = lambda spark, sf: dashboard.anomaly_rate(pub(spark, sf))
ORACLES["anomaly_rate"] = _sql(
    f"SELECT CAST(sum(is_anomaly) AS BIGINT) AS suspects, {_r('(sum(is_anomaly) / CAST(count(*) AS DOUBLE) * 100)', 1)} AS rate_pct FROM published"
)
QUERIES["density_outliers"] = lambda spark, sf: dashboard.density_outliers(pub(spark, sf))
ORACLES["density_outliers"] = _sql("SELECT title, price, rating, review_count, source_platform FROM published WHERE review_count >= 300")

QUERIES["scatter_feed"] = lambda spark, sf: data.rounded(dashboard.scatter_feed(pub(spark, sf)), ["PC1", "PC2"])
ORACLES["scatter_feed"] = _sql(
    f"""SELECT id, {rounded(['PC1', 'PC2'])}, cluster_label, title, price, CAST(review_count AS DOUBLE) AS review_count, price_anomaly_score,
is_anomaly, {_DETECTOR} AS detector_model FROM published"""
)
QUERIES["projection_table"] = lambda spark, sf: data.rounded(dashboard.projection_table(pub(spark, sf)), ["PC1", "PC2"])
ORACLES["projection_table"] = _sql(
    "SELECT "
    + ", ".join(
        f"{_r(c, 6)} AS {c}" if c in ("PC1", "PC2") else "CAST(cluster AS INTEGER) AS cluster" if c == "cluster" else c
        for c in dashboard.PROJECTION_WIDE
    )
    + " FROM published"
)

# ---- text ------------------------------------------------------------------------------------

QUERIES["catalog_context"] = lambda spark, sf: context.catalog_context(pub(spark, sf))
ORACLES["catalog_context"] = _sql(
    f"""SELECT *, printf('Total produits : %d
Prix : min=%.2f | max=%.2f | moy=%.2f
Note moyenne : %.2f/5
Top catégories : %s
Produits Top-K : %d (%.1f%%)
Outliers DBSCAN : %d (%.1f%%)
Clusters : %d
Score composite moyen : %.3f', n_products, min_price, max_price, avg_price, avg_rating, top_categories, n_top, top_pct, n_noise, noise_pct,
n_clusters, avg_score) AS context FROM (SELECT count(*) AS n_products, min(price) AS min_price, max(price) AS max_price, {_r('avg(price)', 2)} AS avg_price,
{_r('avg(rating)', 2)} AS avg_rating, count(*) FILTER (is_top_product = 1) AS n_top, count(*) FILTER (dbscan_cluster = -1) AS n_noise,
count(DISTINCT cluster) AS n_clusters, {_r('avg(composite_score)', 3)} AS avg_score,
(SELECT string_agg(category, ', ' ORDER BY n DESC, category) FROM (SELECT category, count(*) AS n FROM published GROUP BY 1 ORDER BY n DESC, 1 LIMIT 3))
  AS top_categories, {_r('(avg(is_top_product) * 100)', 1)} AS top_pct, {_r('(avg(dbscan_outlier) * 100)', 1)} AS noise_pct FROM published)"""
)


def _competitor_pairs(spark, sf):
    """For each offer the same part at the next six suppliers, by number; most do not exist."""
    numbers = F.split("id", "-")
    return pub(spark, sf).select("id", F.posexplode(F.sequence(F.lit(1), F.lit(6))).alias("pos", "step")).select(
        "id",
        F.concat_ws("-", numbers[0], (numbers[1].cast("long") + F.col("step")).cast("string")).alias("competitor_id"),
        (F.col("pos") + 1).alias("rank"),
    )


QUERIES["competitor_context"] = lambda spark, sf: context.competitor_context(pub(spark, sf), _competitor_pairs(spark, sf))
ORACLES["competitor_context"] = _sql(
    """, lines AS (SELECT id, concat_ws(' | ', 'Titre: ' || left(nullif(title, ''), 60), 'Prix: ' || price, 'Note: ' || rating || '/5',
  'Avis: ' || review_count, 'Catégorie: ' || nullif(category, ''), printf('Score ML: %.3f', round_even(composite_score * 1e3, 0) / 1e3)) AS line FROM published),
rivals AS (SELECT l.id, string_agg('  ' || s.step || '. ' || r.line, chr(10) ORDER BY s.step) AS txt FROM lines l, range(1, 6) s(step), lines r
  WHERE r.id = split_part(l.id, '-', 1) || '-' || (CAST(split_part(l.id, '-', 2) AS BIGINT) + s.step) GROUP BY 1)
SELECT id, 'Produit analysé :' || chr(10) || line || chr(10) || 'Concurrents :' || chr(10) || coalesce(txt, '  (aucun concurrent fourni)') AS context
FROM lines LEFT JOIN rivals USING (id)"""
).replace("\n,", ",", 1)
