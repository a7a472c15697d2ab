"""k-means in shared passes against plain Lloyd steps and MLlib."""

import numpy as np
import pytest
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from vitrine.operators import lloyd, segment


def _points(n=600, seed=5):
    rng = np.random.default_rng(seed)
    return np.concatenate([rng.normal(c, 0.6, (n // 4, 3)) for c in (0, 2, 4, 7)])


def _frame(spark, x):
    return spark.createDataFrame([tuple(map(float, v)) for v in x], "a double, b double, c double")


def _cost(x, centres):
    return ((x[:, None] - np.array(centres)[None]) ** 2).sum(2).min(1).sum()


def test_equals_plain_steps_from_the_same_seeds(spark):
    x = _points()
    rows = _frame(spark, x).withColumn("weight", F.lit(1.0))
    sample, weight = lloyd.weighted_sample(rows, list("abc"), 42)
    assert len(sample) == len(x) and weight.tolist() == [1.0] * len(x)
    ends = []
    for n in range(3):
        centres = lloyd.spread_seeds(sample, weight, 4, np.random.default_rng([42, n]))
        for _ in range(lloyd.MAX_PASSES):
            best = ((x[:, None] - centres[None]) ** 2).sum(2).argmin(1)
            moved = np.array([x[best == i].mean(0) for i in range(4)])
            still = ((moved - centres) ** 2).sum(1).max() <= lloyd.TOLERANCE**2
            centres = moved
            if still:
                break
        ends.append((_cost(x, centres), sorted(centres.tolist())))
    got = segment.fit_kmeans(_frame(spark, x), list("abc"), 4, n_init=3)
    assert np.allclose(got, min(ends)[1], atol=1e-9)


def test_cost_is_not_above_mllib(spark):
    x = np.random.default_rng(1).gamma(1.0, 1.0, (800, 3))
    rows = _frame(spark, x).select(array_to_vector(F.array("a", "b", "c")).alias("features"))
    others = [KMeans(k=5, seed=s, maxIter=100).fit(rows).summary.trainingCost for s in range(4)]
    assert _cost(x, segment.fit_kmeans(_frame(spark, x), list("abc"), 5)) <= min(others) * 1.001


def test_copies_count_as_often_as_they_occur(spark):
    x = np.array([[0.0, 0, 0]] * 9 + [[1.0, 0, 0]] + [[10.0, 0, 0]] * 3)
    assert np.allclose(segment.fit_kmeans(_frame(spark, x), list("abc"), 2), [[0.1, 0, 0], [10, 0, 0]])


def test_sample_of_heavy_rows_keeps_the_total(spark):
    rng = np.random.default_rng(2)
    x, w = rng.normal(size=(5000, 3)), rng.gamma(0.5, 20.0, 5000) + 0.01
    rows = spark.createDataFrame([(*map(float, v), float(u)) for v, u in zip(x, w)], "a double, b double, c double, weight double")
    sample, weight = lloyd.weighted_sample(rows, list("abc"), 7, size=1000)
    assert len(sample) == 1000 and weight.sum() == pytest.approx(w.sum(), rel=0.05)


def test_few_rows_nulls_and_no_rows(spark):
    few = spark.createDataFrame([(None, 1.0), (0.0, 1.0), (float("nan"), 1.0), (5.0, None)], "a double, b double")
    assert segment.fit_kmeans(few, ["a", "b"], 4) == [[0.0, 1.0], [5.0, 0.0]]
    assert segment.fit_kmeans(few.limit(0), ["a", "b"], 4) == []
