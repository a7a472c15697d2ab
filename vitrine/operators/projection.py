"""Principal components of scaled columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import np_round
from ..stages import compiled_methods
from .segment import number_or_zero


def fit_pca(df: DataFrame, columns: Sequence[str], n_components: int = 2) -> tuple[dict[str, list[float]], list[float]]:
    """(loadings per component, explained variance ratios).

    The sign of each component is fixed so that its largest loading is positive, the first of loadings that are
    as large but for rounding.
    """
    k = min(max(1, n_components), len(columns))
    vectors = df.select(array_to_vector(F.array(*[number_or_zero(c) for c in columns])).alias("v"))
    with compiled_methods(df.sparkSession):
        model = PCA(k=k, inputCol="v", outputCol="p").fit(vectors)
    loadings = {}
    for i in range(k):
        column = model.pc.toArray()[:, i]
        largest = next(x for x in column if abs(x) >= (1 - 1e-9) * max(map(abs, column)))
        loadings[f"PC{i + 1}"] = [float(x if largest >= 0 else -x) for x in column]
    return loadings, [float(x) for x in model.explainedVariance]


def project(df: DataFrame, columns: Sequence[str], loadings: dict[str, Sequence[float]]) -> DataFrame:
    """Add one column per component; ``columns`` are already centred."""
    return df.withColumns(
        {
            name: sum((number_or_zero(c) * F.lit(float(w)) for c, w in zip(columns, weights)), F.lit(0.0))
            for name, weights in loadings.items()
        }
    )


def explained_percent(ratios: Sequence[float]) -> float:
    return round(sum(ratios[:2]) * 100, 2)


def loadings_table(spark: SparkSession, columns: Sequence[str], loadings: dict[str, Sequence[float]]) -> DataFrame:
    """Long table: feature, component, loading (four digits)."""
    rows = [(c, name, round(float(w), 4)) for name, weights in loadings.items() for c, w in zip(columns, weights)]
    return spark.createDataFrame(rows, "feature string, component string, loading double")


def add_projection(
    df: DataFrame, columns: Sequence[str], n_components: int = 2, fitted: tuple[dict[str, list[float]], list[float]] | None = None
) -> DataFrame:
    """PC1.. and pca_variance_explained for a scaled table; zeros when there is too little data.

    ``fitted`` is what :func:`fit_pca` gave for the same table, so that it is not fitted again.
    """
    names = [f"PC{i + 1}" for i in range(max(2, n_components))]
    if len(columns) < 2 or len(df.select(*columns).take(2)) < 2:
        return df.withColumns({**{n: F.lit(0.0) for n in names}, "pca_variance_explained": F.lit(0.0)})
    loadings, ratios = fitted or fit_pca(df, columns, max(2, n_components))
    out = project(df, columns, loadings)
    missing = {n: F.lit(0.0) for n in names if n not in loadings}
    return out.withColumns({**missing, "pca_variance_explained": F.lit(explained_percent(ratios))})


def projected_variance(df: DataFrame, components: Sequence[str]) -> DataFrame:
    """Population variance per projected component, a check on explained variance."""
    return df.agg(*[np_round(F.var_pop(c), 6).alias(f"var_{c}") for c in components])
