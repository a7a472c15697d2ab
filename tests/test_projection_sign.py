"""The sign of a component does not hang on the rounding of two opposite loadings."""

from vitrine.operators import projection


def test_first_of_equal_loadings_is_positive(spark):
    for seed in range(4):
        rows = [(((i * (seed + 3)) % 11) / 7.0, float(i % 3) / 50) for i in range(60)]
        df = spark.createDataFrame([(x, 0.1 - x, y) for x, y in rows], "a double, b double, c double").repartition(1 + seed)
        loadings, _ = projection.fit_pca(df, ["a", "b", "c"])
        assert loadings["PC1"][0] > 0.7 and abs(loadings["PC1"][0] + loadings["PC1"][1]) < 1e-6
