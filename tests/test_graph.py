"""Connected components against a plain union of sets."""

import numpy as np

from vitrine.operators.graph import connected_components


def _plain(nodes, edges):
    root = {n: n for n in nodes}

    def top(n):
        while root[n] != n:
            n = root[n]
        return n

    for u, v in edges:
        a, b = sorted((top(u), top(v)))
        root[b] = a
    return {n: top(n) for n in nodes}


def test_chains_stars_and_loose_nodes(spark):
    rng = np.random.default_rng(8)
    chain = [(i, i + 1) for i in range(0, 40)]
    star = [(500, i) for i in range(501, 800)] + [(100, 800), (800, 500)]
    loose = [tuple(map(int, p)) for p in rng.integers(1000, 1200, (90, 2))]
    edges = chain + star + loose + [(7, 7), (3, 2)]
    nodes = sorted({n for e in edges for n in e} | {5000, 5001})
    got = connected_components(spark.createDataFrame([(n,) for n in nodes], "node bigint"), spark.createDataFrame(edges, "u bigint, v bigint")).collect()
    assert {r["node"]: r["component"] for r in got} == _plain(nodes, edges) and len(got) == len(nodes)


def test_no_edges(spark):
    nodes = spark.createDataFrame([(3,), (1,)], "node bigint")
    got = connected_components(nodes, spark.createDataFrame([], "u bigint, v bigint")).collect()
    assert sorted(map(tuple, got)) == [(1, 1), (3, 3)]
