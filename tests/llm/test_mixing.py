"""The drawn rows meet the margins."""

from __future__ import annotations

from collections import Counter

import pytest
from vitrine.llm import mixing


@pytest.mark.parametrize("no_more_rows", [False, True])
def test_drawn_rows_meet_every_margin(spark, no_more_rows):
    rows = [(i, "word " * 20, "hot" if i % 50 else "rare", "en" if i % 7 else "fr") for i in range(6000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    drawn = mixing.draw(docs, no_more_rows=no_more_rows)
    assert drawn.columns == docs.columns
    found = drawn.collect()
    for at in ("source", "lang"):
        seen, got = Counter(r[2 if at == "source" else 3] for r in rows), Counter(r[at] for r in found)
        whole = sum(n**0.5 for n in seen.values())
        for value, n in seen.items():
            assert abs(got[value] / len(found) / (n**0.5 / whole) - 1) < 0.05
    assert abs(len(found) / len(rows) - 1) < 0.05 and not (no_more_rows and len(found) > len(rows))


def test_raking_goes_on_until_the_margins_are_met(spark):
    counts = {("a", "x"): 10000, ("a", "y"): 30, ("b", "x"): 30, ("b", "y"): 10000}
    cells = spark.createDataFrame([(s, g, "t", n) for (s, g), n in counts.items()], "source string, lang string, topic string, tokens long")
    shares = {"source": {"a": 0.3, "b": 0.7}, "lang": {"x": 0.6, "y": 0.4}, "topic": {"t": 1.0}}
    targets = {m: spark.createDataFrame(list(v.items()), "value string, share double") for m, v in shares.items()}
    fitted = mixing.rake(cells, targets, rounds=60, tolerance=0.001).toPandas()
    fitted["fit"] = fitted.tokens * fitted.weight
    for margin, want in shares.items():
        got = fitted.groupby(margin).fit.sum() / fitted.fit.sum()
        assert all(abs(got[k] / v - 1) < 0.002 for k, v in want.items())
