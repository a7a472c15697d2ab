"""Stage tables of finished rounds are deleted; what a result reads stays."""

import numpy as np

from vitrine import stages
from vitrine.operators import density
from vitrine.operators.graph import connected_components


def _table(spark, n=120):
    x = np.random.default_rng(2).normal(0, 1, (n, 3))
    return spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x)], "rid bigint, f0 double, f1 double, f2 double")


def test_release_deletes_one_table(spark):
    first, second = stages.stage(spark.range(3)), stages.stage(spark.range(4))
    before = len(stages._written)
    stages.release(first, None, spark.range(2))
    assert len(stages._written) == before - 1 and second.count() == 4


def test_dbscan_leaves_one_stage_table(spark):
    df, before = _table(spark), len(stages._written)
    rows, cores = density.dbscan(df, ["f0", "f1", "f2"], "rid", 0.6, 4)
    assert len(stages._written) == before + 1
    assert rows.count() == 120 and cores.count() > 0


def test_components_keep_one_round(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)], "u bigint, v bigint")
    before = len(stages._written)
    parts = connected_components(spark.range(41).withColumnRenamed("id", "node"), edges)
    assert len(stages._written) == before + 1
    assert {r["component"] for r in parts.collect()} == {0}
