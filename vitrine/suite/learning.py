"""Registered queries for unsupervised and supervised models and their evaluation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import have, np_round
from ..operators import density, evaluation, isolation, projection, quality, segment, supervised
from ..operators.features import LEAKAGE, select_model_features
from ..plans import dashboard
from ..sources.listings import table
from ..stages import stage
from . import data
from .catalog import EXTRA, _sql
from .oracle_base import with_ctes

QUERIES = {}
ORACLES = {}

# ---- density on three sums over all axes of the embeddings -----------------------------------

_AXES = ["e0", "e1", "e2"]
_EPS, _MIN = 0.04, 5


def _axis_sum(k: int):
    """Every third axis from ``k`` on, summed and scaled to the spread of one axis."""
    picked = F.filter("embedding", lambda x, i: i % 3 == k)
    return F.aggregate(picked, F.lit(0.0), lambda total, x: total + x.cast("double")) / F.sqrt(F.size(picked))


def _vectors(spark, sf) -> DataFrame:
    return table(spark, sf, "embeddings").select("vec_id", "label", *[_axis_sum(k).alias(f"e{k}") for k in range(3)])


def _wide_vectors(spark, sf) -> DataFrame:
    """All axes as columns."""
    rows = table(spark, sf, "embeddings")
    return rows.select("vec_id", "label", *[F.get("embedding", F.lit(i)).cast("double").alias(f"v{i}") for i in range(AXES)])


def _axis_sum_sql(k: int) -> str:
    picked = f"list_filter(CAST(embedding AS DOUBLE[]), lambda x, i: (i - 1) % 3 = {k})"
    return f"list_sum({picked}) / sqrt(len({picked})) AS e{k}"


_V = f"SELECT vec_id, label, {_axis_sum_sql(0)}, {_axis_sum_sql(1)}, {_axis_sum_sql(2)} FROM embeddings"
_D2 = "(a.e0 - b.e0) * (a.e0 - b.e0) + (a.e1 - b.e1) * (a.e1 - b.e1) + (a.e2 - b.e2) * (a.e2 - b.e2)"
_DENSITY = f"""WITH RECURSIVE v AS MATERIALIZED ({_V}),
near AS MATERIALIZED (SELECT a.vec_id AS a, b.vec_id AS b FROM v a, v b WHERE {_D2} <= {_EPS}e0 * {_EPS}e0),
core AS MATERIALIZED (SELECT a AS id FROM near GROUP BY 1 HAVING count(*) >= {_MIN}),
edges AS MATERIALIZED (SELECT a, b FROM near WHERE a IN (FROM core) AND b IN (FROM core)),
reach(a, b) AS (SELECT a, b FROM edges UNION SELECT r.a, e.b FROM reach r JOIN edges e ON e.a = r.b),
comp AS MATERIALIZED (SELECT a AS id, min(b) AS root FROM reach GROUP BY 1),
num AS MATERIALIZED (SELECT root, CAST(row_number() OVER (ORDER BY root) - 1 AS INTEGER) AS label FROM (SELECT DISTINCT root FROM comp)),
lab AS MATERIALIZED (SELECT id, label FROM comp JOIN num USING (root)),
final AS MATERIALIZED (SELECT v.vec_id, coalesce(l.label, (SELECT min(label) FROM near JOIN lab ON lab.id = near.b WHERE near.a = v.vec_id), -1) AS dbscan_cluster
  FROM v LEFT JOIN lab l ON l.id = v.vec_id)
"""

QUERIES["dbscan"] = lambda spark, sf: density.dbscan(_vectors(spark, sf), _AXES, "vec_id", _EPS, _MIN)[0].select("vec_id", "dbscan_cluster")
ORACLES["dbscan"] = _DENSITY + "SELECT vec_id, dbscan_cluster FROM final"


def _predicted(spark, sf) -> DataFrame:
    """Vectors shifted a little, labelled by the nearest stored core vector."""
    vectors = _vectors(spark, sf)
    _, cores = density.dbscan(vectors, _AXES, "vec_id", _EPS, _MIN)
    moved = vectors.withColumns({c: F.col(c) + 0.0125 for c in _AXES})
    return density.dbscan_predict(moved, _AXES, "vec_id", cores, _EPS).select("vec_id", "dbscan_cluster")


QUERIES["dbscan_predict"] = _predicted
ORACLES["dbscan_predict"] = (
    _DENSITY
    + f"""SELECT q.vec_id, CASE WHEN n.d <= {_EPS}e0 * {_EPS}e0 THEN n.label ELSE -1 END AS dbscan_cluster FROM v q JOIN
(SELECT a.vec_id AS id, min({_D2}) AS d, arg_min(lab.label, {_D2}) AS label
 FROM (SELECT vec_id, e0 + 0.0125e0 AS e0, e1 + 0.0125e0 AS e1, e2 + 0.0125e0 AS e2 FROM v) a, v b JOIN lab ON lab.id = b.vec_id GROUP BY 1) n ON n.id = q.vec_id"""
)

QUERIES["elbow_radius"] = lambda spark, sf: _vectors(spark, sf).agg(F.count("*").alias("n_rows")).withColumn(
    "radius", np_round(F.lit(density.elbow_radius(_vectors(spark, sf), _AXES, "vec_id")), 9)
)
ORACLES["elbow_radius"] = f"""WITH v AS MATERIALIZED ({_V}),
kd AS (SELECT d, row_number() OVER (ORDER BY d) - 1 AS i FROM (SELECT sqrt(d2) AS d FROM (SELECT a.vec_id, {_D2} AS d2,
  row_number() OVER (PARTITION BY a.vec_id ORDER BY {_D2}) AS r FROM v a, v b) WHERE r = 5)),
sm AS (SELECT i, d, avg(d) OVER (ORDER BY i ROWS BETWEEN CURRENT ROW AND 4 FOLLOWING) AS s, count(*) OVER () AS n FROM kd),
bend AS (SELECT i, abs(lead(s, 2) OVER (ORDER BY i) - 2 * lead(s) OVER (ORDER BY i) + s) AS b, n FROM sm),
best AS (SELECT i FROM bend WHERE i + 6 < n ORDER BY b DESC, i LIMIT 1)
SELECT (SELECT count(*) FROM v) AS n_rows, round_even(d * 1e9, 0) / 1e9 AS radius FROM kd, best
WHERE kd.i = least(best.i + 3, (SELECT count(*) - 1 FROM kd))"""


QUERIES["detect_outliers"] = lambda spark, sf: density.detect_outliers(_vectors(spark, sf), _AXES, "vec_id").select("vec_id", "dbscan_cluster")
_RADIUS = ORACLES["elbow_radius"].split("kd AS", 1)[1].rsplit("SELECT (SELECT count(*) FROM v)", 1)[0]
ORACLES["detect_outliers"] = f"""WITH RECURSIVE w AS MATERIALIZED ({_V}),
v AS MATERIALIZED (SELECT vec_id, label, {", ".join(f"(e{k} - (SELECT avg(e{k}) FROM w)) / (SELECT stddev_pop(e{k}) FROM w) AS e{k}" for k in range(3))} FROM w),
kd AS{_RADIUS.rstrip()},
radius AS MATERIALIZED (SELECT d AS r FROM kd, best WHERE kd.i = least(best.i + 3, (SELECT count(*) - 1 FROM kd))),
near AS MATERIALIZED (SELECT a.vec_id AS a, b.vec_id AS b FROM v a, v b, radius WHERE {_D2} <= r * r),
""" + _DENSITY.split("\n", 2)[2] + "SELECT vec_id, dbscan_cluster FROM final"


# ---- density on all axes of the embeddings, and on the catalog ---------------------------------

AXES = 64
_WIDE = [f"v{i}" for i in range(AXES)]
_WIDE_EPS = 1.18
_X = "SELECT vec_id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings"
_FAR = "list_distance(a.x, b.x)"
_WIDE_ORACLE = "WITH RECURSIVE v AS MATERIALIZED (" + _X + f"""),
near AS MATERIALIZED (SELECT a.vec_id AS a, b.vec_id AS b FROM v a, v b WHERE {_FAR} <= {_WIDE_EPS}e0),
""" + _DENSITY.split("\n", 2)[2]

QUERIES["dbscan_wide"] = lambda spark, sf: density.dbscan(_wide_vectors(spark, sf), _WIDE, "vec_id", _WIDE_EPS, _MIN)[0].select("vec_id", "dbscan_cluster")
ORACLES["dbscan_wide"] = _WIDE_ORACLE + "SELECT vec_id, dbscan_cluster FROM final"


def _wide_predicted(spark, sf) -> DataFrame:
    """Vectors shifted a little on every axis, labelled by the nearest stored core vector."""
    vectors = _wide_vectors(spark, sf)
    _, cores = density.dbscan(vectors, _WIDE, "vec_id", _WIDE_EPS, _MIN)
    moved = vectors.withColumns({c: F.col(c) + 0.0125 for c in _WIDE})
    return density.dbscan_predict(moved, _WIDE, "vec_id", cores, _WIDE_EPS).select("vec_id", "dbscan_cluster")


QUERIES["dbscan_predict_wide"] = _wide_predicted
ORACLES["dbscan_predict_wide"] = (
    _WIDE_ORACLE
    + f"""SELECT q.vec_id, CASE WHEN n.d <= {_WIDE_EPS}e0 THEN n.label ELSE -1 END AS dbscan_cluster FROM v q JOIN
(SELECT a.vec_id AS id, min({_FAR}) AS d, arg_min(lab.label, {_FAR}) AS label
 FROM (SELECT vec_id, list_transform(x, lambda y: y + 0.0125e0) AS x FROM v) a, v b JOIN lab ON lab.id = b.vec_id GROUP BY 1) n ON n.id = q.vec_id"""
)

_WIDE_BEND = f"""kd AS MATERIALIZED (SELECT d, row_number() OVER (ORDER BY d) - 1 AS i FROM (SELECT a.vec_id, {_FAR} AS d,
  row_number() OVER (PARTITION BY a.vec_id ORDER BY {_FAR}) AS r FROM v a, v b) WHERE r = 5),
""" + ORACLES["elbow_radius"].split("WHERE r = 5)),\n", 1)[1].rsplit("SELECT (SELECT count(*) FROM v)", 1)[0]
QUERIES["elbow_radius_wide"] = lambda spark, sf: _wide_vectors(spark, sf).agg(F.count("*").alias("n_rows")).withColumn(
    "radius", np_round(F.lit(density.elbow_radius(_wide_vectors(spark, sf), _WIDE, "vec_id")), 9)
)
ORACLES["elbow_radius_wide"] = f"""WITH v AS MATERIALIZED ({_X}),
{_WIDE_BEND}SELECT (SELECT count(*) FROM v) AS n_rows, round_even(d * 1e9, 0) / 1e9 AS radius FROM kd, best
WHERE kd.i = least(best.i + 3, (SELECT count(*) - 1 FROM kd))"""

QUERIES["detect_outliers_wide"] = lambda spark, sf: density.detect_outliers(_wide_vectors(spark, sf), _WIDE, "vec_id").select("vec_id", "dbscan_cluster")
ORACLES["detect_outliers_wide"] = f"""WITH RECURSIVE w AS MATERIALIZED (SELECT vec_id, unnest(x) AS y, generate_subscripts(x, 1) AS i FROM ({_X})),
m AS MATERIALIZED (SELECT i, avg(y) AS mean, stddev_pop(y) AS spread FROM w GROUP BY 1),
v AS MATERIALIZED (SELECT vec_id, list((y - mean) / spread ORDER BY i) AS x FROM w JOIN m USING (i) GROUP BY 1),
{_WIDE_BEND.rstrip()},
radius AS MATERIALIZED (SELECT d AS r FROM kd, best WHERE kd.i = least(best.i + 3, (SELECT count(*) - 1 FROM kd))),
near AS MATERIALIZED (SELECT a.vec_id AS a, b.vec_id AS b FROM v a, v b, radius WHERE {_FAR} <= r),
""" + _DENSITY.split("\n", 2)[2] + "SELECT vec_id, dbscan_cluster FROM final"


def _row_number(df: DataFrame) -> DataFrame:
    """The listing's id as one number, in the order of the listings."""
    number = F.split("id", "-")
    return df.withColumn("row_no", number[0].cast("long") * (1 << 31) + number[1].cast("long"))


# No SQL: all pairs of listings are too many; tests/test_density.py has a small table against plain distances.
QUERIES["detect_outliers_catalog"] = lambda spark, sf: density.detect_outliers(
    _row_number(data.silver(spark, sf)), ["price", "rating", "review_count"], "row_no"
).select("id", "dbscan_cluster")


def _catalog_points(spark, sf) -> DataFrame:
    return _row_number(segment.zscore(data.features(spark, sf), segment.CLUSTER_FEATURES))

QUERIES["dbscan_catalog"] = lambda spark, sf: density.dbscan(_catalog_points(spark, sf), data.SCALED, "row_no")[0].select("id", "dbscan_cluster")

# ---- centroids, projection, isolation --------------------------------------------------------


def _kmeans(spark, sf) -> DataFrame:
    scaled = segment.zscore(data.features(spark, sf), segment.CLUSTER_FEATURES)
    centres = segment.fit_kmeans(scaled, data.SCALED, segment.cluster_count(scaled.count()))
    names = segment.name_clusters(segment.centre_table(spark, segment.CLUSTER_FEATURES, centres))
    return segment.add_cluster_names(segment.nearest_centre(scaled, data.SCALED, centres), names).select("id", "cluster", "cluster_label")


QUERIES["kmeans_segments"] = _kmeans

QUERIES["pca_projection"] = lambda spark, sf: projection.add_projection(
    segment.zscore(data.features(spark, sf), segment.CLUSTER_FEATURES), data.SCALED, 3
).select("id", "PC1", "PC2", "PC3", "pca_variance_explained")


def _all_features(spark, sf) -> DataFrame:
    """The narrow projection table over all model features, the cluster's name beside it."""
    published = data.published(spark, sf).drop("PC1", "PC2", "pca_variance_explained")
    names = [c for c in select_model_features(data.features(spark, sf))]
    scaled = segment.zscore(published, names).select(*have(published, dashboard.PROJECTION_NARROW), *[f"z_{c}" for c in names])
    projected = projection.add_projection(stage(scaled, "scaled-features"), [f"z_{c}" for c in names])
    return dashboard.projection_table(projected, wide=False)


QUERIES["pca_all_features"] = _all_features


def _loadings(spark, sf) -> DataFrame:
    names = [c for c in select_model_features(data.features(spark, sf))]
    scaled = segment.zscore(data.features(spark, sf), names)
    columns = [f"z_{c}" for c in names]
    loadings, _ = projection.fit_pca(scaled, columns)
    return projection.loadings_table(spark, names, loadings)


QUERIES["pca_loadings"] = _loadings


def _isolation(spark, sf) -> DataFrame:
    rows = data.silver(spark, sf)
    return isolation.detect_isolation(rows, "id")[0].select("id", "iforest_outlier", "price_anomaly_score")


QUERIES["isolation_forest"] = _isolation

# ---- clustering quality ----------------------------------------------------------------------

QUERIES["evaluate_clustering"] = lambda spark, sf: quality.evaluate_clustering(
    _wide_vectors(spark, sf), [f"v{i}" for i in range(AXES)], "label", "vec_id"
)
ORACLES["evaluate_clustering"] = """WITH v AS MATERIALIZED (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS x FROM embeddings),
c AS MATERIALIZED (SELECT label, list(m ORDER BY i) AS x FROM (SELECT label, i, avg(y) AS m FROM (SELECT label, unnest(x) AS y, generate_subscripts(x, 1) AS i FROM v) GROUP BY 1, 2) GROUP BY 1),
s AS (SELECT label, avg(list_distance(a.x, b.x)) AS s FROM v a JOIN c b USING (label) GROUP BY 1),
db AS (SELECT avg(r) AS r FROM (SELECT a.label, max((sa.s + sb.s) / list_distance(a.x, b.x)) AS r FROM c a JOIN c b ON a.label <> b.label
  JOIN s sa ON sa.label = a.label JOIN s sb ON sb.label = b.label GROUP BY 1)),
m AS (SELECT a.vec_id, a.label AS own, b.label AS other, sum(list_distance(a.x, b.x)) AS t, count(*) AS n FROM v a, v b GROUP BY 1, 2, 3),
sil AS (SELECT vec_id, max(CASE WHEN own = other THEN t / (n - 1) END) AS a, min(CASE WHEN own <> other THEN t / n END) AS b FROM m GROUP BY 1)
SELECT (SELECT count(DISTINCT label) FROM v) AS n_clusters, 0 AS n_outliers,
round_even((SELECT avg((b - a) / greatest(a, b)) FROM sil) * 1e4, 0) / 1e4 AS silhouette_score, round_even((SELECT r FROM db) * 1e4, 0) / 1e4 AS davies_bouldin"""

QUERIES["davies_bouldin_catalog"] = lambda spark, sf: data.rounded(
    quality.davies_bouldin(data.scored(spark, sf), data.SCALED, "cluster"), ["davies_bouldin"]
)
_ZD = " + ".join(f"(a.z_{c} - b.z_{c}) * (a.z_{c} - b.z_{c})" for c in segment.CLUSTER_FEATURES)
ORACLES["davies_bouldin_catalog"] = with_ctes(
    "spread",
    f"""SELECT round_even(avg(r) * 1e6, 0) / 1e6 AS davies_bouldin FROM (SELECT a.cluster, max((sa.s + sb.s) / sqrt({_ZD})) AS r
FROM mid a JOIN mid b ON a.cluster <> b.cluster JOIN spread sa ON sa.cluster = a.cluster JOIN spread sb ON sb.cluster = b.cluster GROUP BY 1)""",
    {
        **EXTRA,
        "mid": ("SELECT cluster, " + ", ".join(f"avg(z_{c}) AS z_{c}" for c in segment.CLUSTER_FEATURES) + " FROM assigned GROUP BY 1", ["assigned"]),
        "spread": (f"SELECT a.cluster, avg(sqrt({_ZD})) AS s FROM assigned a JOIN mid b USING (cluster) GROUP BY 1", ["mid"]),
    },
)

# ---- evaluation of classifiers ---------------------------------------------------------------


def _judged(spark, sf) -> DataFrame:
    """Labelled documents scored by their length: a weak but continuous classifier."""
    return table(spark, sf, "labels").join(table(spark, sf, "documents").select("doc_id", "n_chars", "lang"), "doc_id").select(
        "doc_id", "quality", "toxic", "lang", (F.col("n_chars") / (F.col("n_chars") + 500)).alias("score")
    )


_J = "SELECT doc_id, quality, toxic, lang, n_chars / CAST(n_chars + 500 AS DOUBLE) AS score FROM labels JOIN documents USING (doc_id)"

QUERIES["optimal_f1_threshold"] = lambda spark, sf: data.rounded(
    evaluation.optimal_f1_threshold(_judged(spark, sf), "quality", "score"), ["threshold", "f1"], 9
)
ORACLES["optimal_f1_threshold"] = f"""WITH j AS ({_J}), t AS (SELECT DISTINCT score AS threshold FROM j),
c AS (SELECT threshold, count(*) FILTER (quality = 1) AS tp, count(*) AS pp, (SELECT count(*) FROM j WHERE quality = 1) AS p FROM t JOIN j ON score >= threshold GROUP BY 1)
SELECT round_even(threshold * 1e9, 0) / 1e9 AS threshold, round_even(2 * tp / CAST(pp + p AS DOUBLE) * 1e9, 0) / 1e9 AS f1 FROM c
ORDER BY round(2 * tp / CAST(pp + p AS DOUBLE), 12) DESC, c.threshold LIMIT 1"""

QUERIES["threshold_curve"] = lambda spark, sf: data.rounded(
    evaluation.threshold_curve(_judged(spark, sf), "quality", "score"), ["score", "precision", "recall", "f1"], 9
)
ORACLES["threshold_curve"] = f"""WITH j AS ({_J}), t AS (SELECT DISTINCT score AS threshold FROM j),
c AS (SELECT threshold, count(*) FILTER (quality = 1) AS tp, count(*) AS pp, (SELECT count(*) FROM j WHERE quality = 1) AS p FROM t JOIN j ON score >= threshold GROUP BY 1)
SELECT round_even(threshold * 1e9, 0) / 1e9 AS score, round_even(tp / CAST(pp AS DOUBLE) * 1e9, 0) / 1e9 AS precision,
round_even(tp / CAST(p AS DOUBLE) * 1e9, 0) / 1e9 AS recall, round_even(2 * tp / CAST(pp + p AS DOUBLE) * 1e9, 0) / 1e9 AS f1 FROM c"""

QUERIES["roc_auc"] = lambda spark, sf: data.rounded(evaluation.roc_auc(_judged(spark, sf), "quality", "score"), ["auc"], 9)
ORACLES["roc_auc"] = f"""WITH j AS ({_J}) SELECT round_even(avg(CASE WHEN a.score > b.score THEN 1e0 WHEN a.score = b.score THEN 0.5e0 ELSE 0e0 END) * 1e9, 0) / 1e9 AS auc
FROM j a JOIN j b ON a.quality = 1 AND b.quality = 0"""


def _auc_by_language(spark, sf) -> DataFrame:
    judged = _judged(spark, sf)
    languages = [r["lang"] for r in judged.select("lang").distinct().orderBy("lang").collect()]
    guess = judged.withColumns({f"p_{v}": F.abs(F.col("score") - i / len(languages)) for i, v in enumerate(languages)})
    value = evaluation.roc_auc_weighted(guess, "lang", {v: f"p_{v}" for v in languages})
    return judged.agg(F.count("*").alias("n_rows")).withColumn("auc", np_round(F.lit(value), 9))


QUERIES["roc_auc_weighted"] = _auc_by_language
ORACLES["roc_auc_weighted"] = f"""WITH j AS ({_J}), l AS (SELECT lang, (row_number() OVER (ORDER BY lang) - 1) / CAST(count(*) OVER () AS DOUBLE) AS spot
  FROM (SELECT DISTINCT lang FROM j)),
g AS (SELECT l.lang, CAST(j.lang = l.lang AS INTEGER) AS y, abs(score - spot) AS p FROM j, l),
a AS (SELECT a.lang, avg(CASE WHEN a.p > b.p THEN 1e0 WHEN a.p = b.p THEN 0.5e0 ELSE 0e0 END) AS auc FROM g a JOIN g b ON a.lang = b.lang AND a.y = 1 AND b.y = 0 GROUP BY 1)
SELECT (SELECT count(*) FROM j) AS n_rows, round_even(sum(auc * n) / sum(n) * 1e9, 0) / 1e9 AS auc FROM a JOIN (SELECT lang, count(*) AS n FROM j GROUP BY 1) USING (lang)"""


def _confused(spark, sf) -> DataFrame:
    return evaluation.confusion_table(evaluation.apply_threshold(_judged(spark, sf), "score", 0.6), "quality", "prediction")


_C = f"(SELECT quality AS actual, CAST(score >= 0.6 AS INTEGER) AS predicted, count(*) AS n FROM ({_J}) GROUP BY 1, 2)"
QUERIES["confusion_table"] = _confused
ORACLES["confusion_table"] = f"SELECT * FROM {_C}"
QUERIES["class_report"] = lambda spark, sf: data.rounded(evaluation.class_report(_confused(spark, sf)), ["precision", "recall", "f1"])
_REPORT = f"""SELECT label, hit / CAST(guessed AS DOUBLE) AS precision, hit / CAST(actual AS DOUBLE) AS recall, 2 * hit / CAST(actual + guessed AS DOUBLE) AS f1, actual AS support
FROM (SELECT l AS label, CAST(sum(CASE WHEN actual = l THEN n END) AS BIGINT) AS actual, CAST(sum(CASE WHEN predicted = l THEN n END) AS BIGINT) AS guessed,
CAST(sum(CASE WHEN actual = l AND predicted = l THEN n END) AS BIGINT) AS hit FROM {_C}, (VALUES (0), (1)) v(l) GROUP BY 1)"""
ORACLES["class_report"] = f"""SELECT label, round_even(precision * 1e6, 0) / 1e6 AS precision, round_even(recall * 1e6, 0) / 1e6 AS recall,
round_even(f1 * 1e6, 0) / 1e6 AS f1, support FROM ({_REPORT})"""
QUERIES["classifier_metrics"] = lambda spark, sf: evaluation.classifier_metrics(_confused(spark, sf))
ORACLES["classifier_metrics"] = f"""SELECT round_even((SELECT sum(CASE WHEN actual = predicted THEN n ELSE 0 END) / CAST(sum(n) AS DOUBLE) FROM {_C}) * 1e4, 0) / 1e4 AS accuracy,
round_even(sum(precision * support) / CAST(sum(support) AS DOUBLE) * 1e4, 0) / 1e4 AS precision, round_even(sum(recall * support) / CAST(sum(support) AS DOUBLE) * 1e4, 0) / 1e4 AS recall,
round_even(sum(f1 * support) / CAST(sum(support) AS DOUBLE) * 1e4, 0) / 1e4 AS f1_weighted FROM ({_REPORT})"""

QUERIES["class_weights"] = lambda spark, sf: data.rounded(evaluation.class_weights(data.published(spark, sf), "cluster_label"), ["weight"])
ORACLES["class_weights"] = _sql(
    """SELECT cluster_label, count(*) AS n, round_even((SELECT count(*) / CAST(count(DISTINCT cluster_label) AS DOUBLE) FROM published) / count(*) * 1e6, 0) / 1e6
AS weight FROM published GROUP BY 1"""
)
QUERIES["positive_weight"] = lambda spark, sf: data.rounded(evaluation.positive_weight(data.published(spark, sf), "is_top_product"), ["scale_pos_weight"])
ORACLES["positive_weight"] = _sql(
    """SELECT round_even(count(*) FILTER (is_top_product = 0) / CAST(count(*) FILTER (is_top_product = 1) AS DOUBLE) * 1e6, 0) / 1e6 AS scale_pos_weight
FROM published"""
)
QUERIES["top_quantile_target"] = lambda spark, sf: evaluation.top_quantile_target(data.published(spark, sf), name="is_top").select("id", "is_top")
ORACLES["top_quantile_target"] = _sql(
    "SELECT id, CAST(composite_score >= (SELECT quantile_cont(composite_score, 0.8) FROM published) AS INTEGER) AS is_top FROM published"
)
QUERIES["stratified_split"] = lambda spark, sf: evaluation.stratified_split(data.published(spark, sf).select("id", "cluster_label"), "cluster_label")
ORACLES["stratified_split"] = _sql(
    """SELECT id, cluster_label, u <= cut AS is_test FROM (SELECT *, quantile_cont(u, 0.2) OVER (PARTITION BY cluster_label) AS cut FROM (
SELECT id, cluster_label, CAST(('0x' || substr(md5(id || ':42'), 1, 13)) AS BIGINT) / 4503599627370496e0 AS u FROM published))"""
)

# ---- trained models (checked by rows and properties) -----------------------------------------


def _model_columns(spark, sf) -> list[str]:
    return select_model_features(data.published(spark, sf), leakage=LEAKAGE["cluster"])


QUERIES["forest_multiclass"] = lambda spark, sf: supervised.train_multiclass(data.published(spark, sf), _model_columns(spark, sf)).metrics


def _binary(spark, sf, boosted: bool) -> DataFrame:
    target = evaluation.top_quantile_target(data.features(spark, sf))
    columns = select_model_features(target, target="is_top_product", leakage=LEAKAGE["top"])
    return supervised.train_binary(target, columns, "is_top_product", boosted=boosted).metrics


QUERIES["forest_binary"] = lambda spark, sf: _binary(spark, sf, False)
QUERIES["boosted_binary"] = lambda spark, sf: _binary(spark, sf, True)
QUERIES["boosted_multiclass"] = lambda spark, sf: supervised.train_multiclass(
    data.published(spark, sf), _model_columns(spark, sf), boosted=True
).metrics
QUERIES["feature_importance"] = lambda spark, sf: supervised.feature_importance(
    supervised.train_multiclass(data.published(spark, sf), _model_columns(spark, sf))
)


def _folds(spark, sf) -> DataFrame:
    mean, deviation = supervised.cross_validated_f1(data.published(spark, sf), _model_columns(spark, sf), "is_top_product")
    return data.published(spark, sf).agg(F.count("*").alias("n_rows")).withColumns({"cv_f1_mean": F.lit(mean), "cv_f1_std": F.lit(deviation)})


QUERIES["cross_validated_f1"] = _folds
