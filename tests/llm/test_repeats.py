"""Repeats in long texts."""

from __future__ import annotations

import pyarrow as pa

from vitrine.llm import suffix_repeats

from .test_operators import words


def test_equal_rows_across_a_step_are_repeats(spark):
    text = words(77, 130000)
    assert suffix_repeats._STEP / 2 < len(text) < suffix_repeats._STEP
    rows = spark.createDataFrame([(1, text), (1, text)], "doc_id long, text string").coalesce(1)
    assert [r["n_removed"] for r in suffix_repeats.digest(rows).collect()] == [len(text)] * 2


def test_anchors_of_a_batch_come_in_bounded_pieces():
    kind = pa.list_(pa.struct([("gram", pa.int64()), ("at", pa.int64())]))
    lists = [[{"gram": 10 * r + i, "at": i} for i in range(n)] for r, n in enumerate([3, 0, 9, 1])]
    batch = pa.RecordBatch.from_arrays([pa.array([None, *lists], kind)], names=["found"]).slice(1)
    pieces = list(suffix_repeats.anchors_of(batch, 4))
    assert max(len(rows) for rows, _ in pieces) == 4
    assert [r for rows, _ in pieces for r in rows.tolist()] == [0] * 3 + [2] * 9 + [3]
    assert [g for _, f in pieces for g in f["gram"].tolist()] == [f["gram"] for found in lists for f in found]


def test_whole_texts_travel_in_small_batches(spark):
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    with suffix_repeats._small_batches(spark):
        assert int(spark.conf.get(name)) == suffix_repeats._BATCH_ROWS
    assert spark.conf.get(name) == before
