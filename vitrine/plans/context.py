"""Text facts about the catalog and about single products, as columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import np_round
from .dashboard import category_top


def catalog_context(catalog: DataFrame) -> DataFrame:
    """One row of facts and the same facts as text."""
    largest = category_top(catalog, 3).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(-F.col("n_products"), "category"))), lambda s: s["category"]), ", ").alias("t")
    )
    facts = catalog.agg(
        F.count("*").alias("n_products"),
        F.min("price").alias("min_price"),
        F.max("price").alias("max_price"),
        np_round(F.avg("price"), 2).alias("avg_price"),
        np_round(F.avg("rating"), 2).alias("avg_rating"),
        F.count_if(F.col("is_top_product") == 1).alias("n_top"),
        F.count_if(F.col("dbscan_cluster") == -1).alias("n_noise"),
        F.countDistinct("cluster").alias("n_clusters"),
        np_round(F.avg("composite_score"), 3).alias("avg_score"),
    ).withColumn("top_categories", largest.select("t").scalar())
    percent = lambda c: np_round(F.try_divide(F.col(c), F.col("n_products")) * 100, 1)
    return facts.withColumns({"top_pct": percent("n_top"), "noise_pct": percent("n_noise")}).withColumn(
        "context",
        F.format_string(
            "Total produits : %d\nPrix : min=%.2f | max=%.2f | moy=%.2f\nNote moyenne : %.2f/5\nTop catégories : %s\n"
            "Produits Top-K : %d (%.1f%%)\nOutliers DBSCAN : %d (%.1f%%)\nClusters : %d\nScore composite moyen : %.3f",
            "n_products", "min_price", "max_price", "avg_price", "avg_rating", "top_categories",
            "n_top", "top_pct", "n_noise", "noise_pct", "n_clusters", "avg_score",
        ),
    )


def product_line(prefix: str = "") -> Column:
    """One product as a line of its known facts."""
    c = lambda name: F.col(prefix + name)
    said = lambda text, value: F.when(value.isNotNull(), F.concat(F.lit(text), value))
    nonempty = lambda value: F.when(value != "", value)
    return F.concat_ws(
        " | ",
        said("Titre: ", F.left(nonempty(c("title")), F.lit(60))),
        said("Prix: ", c("price").cast("string")),
        F.concat(said("Note: ", c("rating").cast("string")), F.lit("/5")),
        said("Avis: ", c("review_count").cast("string")),
        said("Catégorie: ", nonempty(c("category"))),
        F.when(c("composite_score").isNotNull(), F.format_string("Score ML: %.3f", np_round(c("composite_score"), 3))),
    )


def competitor_context(catalog: DataFrame, pairs: DataFrame) -> DataFrame:
    """Context per product from caller-given pairs (id, competitor_id, rank): the product's line
    and at most five competitor lines, so no group ever holds more than five rows."""
    lines = catalog.select("id", product_line().alias("line"))
    rivals = (
        pairs.filter("rank <= 5")
        .join(lines.select(F.col("id").alias("competitor_id"), F.col("line").alias("rival")), "competitor_id")
        .groupBy("id")
        .agg(F.array_sort(F.collect_list(F.struct("rank", "rival"))).alias("rivals"))
    )
    numbered = F.array_join(F.transform("rivals", lambda r: F.concat(F.lit("  "), r["rank"].cast("string"), F.lit(". "), r["rival"])), "\n")
    return lines.join(rivals, "id", "left").select(
        "id",
        F.concat(
            F.lit("Produit analysé :\n"), F.col("line"), F.lit("\nConcurrents :\n"), F.coalesce(numbered, F.lit("  (aucun concurrent fourni)"))
        ).alias("context"),
    )
