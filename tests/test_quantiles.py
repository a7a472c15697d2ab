import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from vitrine.functions import quantiles
from vitrine.functions.ordered import range_buckets, running_totals
from vitrine.functions.quantiles import exact_quantiles, order_pattern
from vitrine.stages import stage

PROBS = [0.0, 0.05, 0.5, 0.8, 0.95, 1.0]


@pytest.mark.parametrize("kind", ["normal", "heavy", "narrow", "ties", "negative"])
def test_quantiles_equal_numpy(spark, kind):
    rng = np.random.default_rng(1)
    x = {
        "normal": rng.normal(0, 1, 3001),
        "heavy": np.exp(rng.normal(0, 6, 2000)),
        "narrow": 1e6 + rng.uniform(0, 1e-3, 1500),
        "ties": np.concatenate([np.full(1000, 7.0), rng.integers(0, 20, 500).astype(float)]),
        "negative": -np.exp(rng.normal(0, 3, 999)),
    }[kind]
    df = spark.createDataFrame([(float(v),) for v in x], "v double")
    got = {r["prob"]: r["value"] for r in exact_quantiles(df, {"v": "v"}, PROBS).collect()}
    assert [got[p] for p in PROBS] == pytest.approx(list(np.quantile(x, PROBS)), rel=1e-12)


def test_quantiles_by_group_with_weights_and_nulls(spark):
    rows = [("a", 1.0, 3), ("a", 5.0, 1), ("b", 2.0, 1), ("b", None, 9), (None, 4.0, 2), ("c", 8.0, 1)]
    df = spark.createDataFrame(rows, "g string, v double, n int")
    got = {r["g"]: r["value"] for r in exact_quantiles(df, {"v": "v"}, [0.5], by=["g"], weight="n").collect()}
    assert got == {"a": 1.0, "b": 2.0, "c": 8.0}


def test_approximate_quantiles_are_close(spark):
    df = spark.range(10001).selectExpr("cast(id as double) v")
    got = exact_quantiles(df, {"v": "v"}, [0.5], approx=True).first()
    assert abs(got["value"] - 5000) <= 5


def test_running_totals_over_many_buckets(spark):
    values = np.random.default_rng(2).permutation(5000)
    df = stage(spark.createDataFrame([(float(v), int(v) % 7) for v in values], "v double, n int"))
    got = running_totals(df, "v", ["n"], rows_per_bucket=300).orderBy("v").collect()
    want = np.concatenate([[0], np.cumsum([v % 7 for v in range(5000)])])
    assert [r["n_before"] for r in got] == want[:-1].tolist() and got[0]["n_total"] == want[-1]
    assert range_buckets(df, "v", 300).select("range_bucket").distinct().count() > 10


def test_pattern_is_the_order_of_doubles(spark):
    values = [0.0, 5e-324, 1e-310, 2.2250738585072014e-308, 1e-12, 0.1, 1 / 3, 1.0, 4503599627370496.0, 1.7976931348623157e308, float("inf")]
    values += [float(np.nextafter(2.0**k, 0)) for k in range(-1000, 1000, 97)]
    df = spark.createDataFrame([(s * v,) for v in values for s in (1, -1)], "v double").select("v", order_pattern(F.col("v")).alias("bits"))
    for row in df.collect():
        size = struct.unpack("<q", struct.pack("<d", abs(row["v"])))[0]
        assert row["bits"] == (-size if row["v"] < 0 else size)


@pytest.mark.parametrize("kind", ["near_zero", "dominant"])
def test_quantiles_of_crowded_values(spark, kind):
    rng = np.random.default_rng(3)
    x = 10.0 ** rng.uniform(-12, -2, 20000) if kind == "near_zero" else np.concatenate([np.full(20000, 0.25), rng.normal(0, 1, 200)])
    df = spark.createDataFrame([(float(v),) for v in x], "v double")
    got = {r["prob"]: r["value"] for r in exact_quantiles(df, {"v": "v"}, PROBS).collect()}
    assert [got[p] for p in PROBS] == pytest.approx(list(np.quantile(x, PROBS)), rel=1e-12)


def _many(rng):
    return np.concatenate([rng.normal(0, 1, 40000), np.full(20000, 0.25), [np.inf, -np.inf]])


@pytest.mark.parametrize("path", ["window", "descent", "refuted"])
def test_quantiles_of_large_groups_by_every_path(spark, monkeypatch, path):
    rng = np.random.default_rng(4)
    groups = {"a": _many(rng), "b": rng.uniform(0, 1, 30), "c": 1e6 + rng.uniform(0, 1e-3, 30000)}
    if path == "descent":
        monkeypatch.setattr(quantiles, "BRACKET", 5)
    if path == "refuted":  # borders on the wrong side of the rank
        monkeypatch.setattr(quantiles, "MARGIN", -4)
    rows = [(g, float(v), i % 3) for g, x in groups.items() for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "g string, v double, k int")
    probs = [0.05, 0.2, 0.75]
    got = exact_quantiles(df, {"v": "v", "odd": F.when(F.col("k") == 1, F.col("v"))}, probs, by=["g"]).collect()
    assert len(got) == 18
    for r in got:
        x = groups[r["g"]] if r["measure"] == "v" else groups[r["g"]][1::3]
        assert r["value"] == pytest.approx(float(np.quantile(x, r["prob"])), rel=1e-12)


def test_quantiles_of_an_empty_table(spark):
    df = spark.createDataFrame([], "g string, v double")
    assert exact_quantiles(df, {"v": "v"}, [0.5], by=["g"]).collect() == []
    assert exact_quantiles(df, {"v": "v"}, [0.5]).collect() == []
