"""De-duplication shuffles repeated keys only, and picks the same rows whatever the bits let through."""

from __future__ import annotations

import random

import pytest
from vitrine.operators import clean


def _rows(n=400):
    rnd = random.Random(5)
    pick = lambda *some: rnd.choice(some)
    return [(pick(None, f"k{rnd.randrange(n)}"), pick(None, 1, 2), pick(None, -0.0, 0.0, 1.5, float("nan")), i) for i in range(n)]


@pytest.mark.parametrize("most", [64, 1 << 20])
def test_first_arrivals_equal_plain(spark, monkeypatch, most):
    monkeypatch.setattr(clean, "MOST_BITS", most)
    rows = _rows()
    rank = lambda v: (v is not None, v != v, v if v == v else 0.0) if v is not None else (False, False, 0.0)
    want = {}
    for r in rows:
        key = (r[0], r[1])
        if key not in want or (rank(r[2]), -r[3]) < (rank(want[key][2]), -want[key][3]):
            want[key] = r
    df = spark.createDataFrame([(*r, -r[3]) for r in rows], "id string, part int, at double, nr int, back int")
    got = clean.dedup_first(df, ["id", "part"], ["at", "back"]).collect()
    assert sorted(r["nr"] for r in got) == sorted(r[3] for r in want.values())


def test_only_repeated_keys_are_ranked(spark):
    df = spark.createDataFrame([(f"k{i}", i) for i in range(2000)] + [("k7", 9000), ("k8", -1)], "id string, nr int")
    repeated, least = clean._choices(df, ["id"], "nr")
    assert df.filter(repeated).count() < 60 and {"k7", "k8"} <= {r["id"] for r in df.filter(repeated).collect()}
    assert {("k7", 7), ("k8", -1)} <= {tuple(r) for r in df.filter(repeated & least).collect()}
    assert clean.dedup_first(df.limit(0), ["id"], ["nr"]).count() == 0
