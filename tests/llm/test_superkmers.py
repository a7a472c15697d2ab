"""Repeated windows against SQL and plain Python."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from vitrine.llm import superkmer_dedup

from .test_operators import WORD, arrow, awkward_texts, oracle, sorted_rows, words


def rows_with_passages() -> list[tuple]:
    rnd, passage, texts = random.Random(3), words(50, 40), []
    for k in range(60):
        cut = rnd.randint(0, 25)
        texts.append(words(100 + k, rnd.randint(0, 30)) + " " + " ".join(passage.split()[cut : cut + rnd.randint(5, 40)]) + "\n" + words(200 + k % 7, 20))
    texts += ["again " * 80, "again " * 40, words(60, 13), words(60, 12), words(60, 14) + "\x0bé x"]
    rows = [(i, t) for i, t in enumerate(texts)]
    return [*awkward_texts(), *[(1000 + i, t) for i, t in rows], (1003, texts[3]), (1003, texts[4]), (None, texts[5]), (None, texts[5])]


def brute(rows: list[tuple], window: int = 13) -> list[tuple]:
    least: dict = {}
    split = [(i, WORD.findall(t or "")) for i, t in rows]
    for i, w in split:
        for k in range(len(w) - window + 1):
            gram = tuple(w[k : k + window])
            least[gram] = min(least.get(gram, (True, 0)), (i is None, i or 0))
    out = []
    for i, w in split:
        gone = {k + j for k in range(len(w) - window + 1) if least[tuple(w[k : k + window])] < (i is None, i or 0) for j in range(window)}
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


@pytest.fixture(scope="module")
def passages(spark):
    rows = [(i, t, *["own"] * 4) for i, t in rows_with_passages()]
    return spark.createDataFrame(rows, "doc_id long, text string, id string, key string, spans string, row string").repartition(3).cache()


@pytest.mark.parametrize("hot, bits", [(4096, 1 << 28), (3, 1 << 28), (1, 1 << 16)])
def test_digest_equals_brute_force_and_sql(passages, hot, bits):
    got = sorted_rows(superkmer_dedup.digest(passages, hot=hot, most_bits=bits).collect())
    assert got == sorted_rows(brute(rows_with_passages()))
    assert got == oracle(superkmer_dedup.oracle(), documents=arrow(passages.select("doc_id", "text")))


def test_repeats_are_cut_out_of_rows(spark, passages):
    left = superkmer_dedup.remove_repeats(passages)
    assert left.columns == passages.columns
    rows = left.collect()
    assert all(tuple(r)[2:] == ("own",) * 4 for r in rows)
    got = sorted_rows((r["doc_id"], hashlib.sha256(" ".join(WORD.findall(r["text"] or "")).encode()).hexdigest()) for r in rows)
    assert got == sorted_rows((i, s) for i, _, _, s in brute(rows_with_passages()))
    none = spark.createDataFrame([], passages.schema)
    assert superkmer_dedup.digest(none).count() == 0 and superkmer_dedup.remove_repeats(none).count() == 0


def test_parts_of_long_texts_have_all_windows():
    text = (words(9, 900) + " " + "x" * 500 + " \n" + words(10, 300)).encode()
    whole = text.split()
    for size in (40, 300, 5000, 1 << 20):
        seen = set()
        for number, part in superkmer_dedup.text_parts(text, 13, size):
            found = part.split()
            assert found == whole[number : number + len(found)]
            fresh = {number + k for k in range(len(found) - 12)}
            assert not seen & fresh
            seen |= fresh
        assert seen == set(range(len(whole) - 12))


def test_super_kmers_pack_every_window_once():
    texts = [t.encode() for t in (words(1, 300), "", "a b", "same " * 200, words(2, 13), " \n" + words(3, 50) + "\t")]
    runs = superkmer_dedup.Runs(texts, 13, 5)
    packed = runs.packed(np.arange(len(runs.text)))
    windows = []
    for text, first, count, words_ in zip(runs.text, runs.first, runs.windows, packed, strict=True):
        found = words_.split(b" ")
        assert len(found) == count + 12 and found == texts[text].split()[first : first + len(found)]
        windows += [(text, first + k) for k in range(count)]
    assert sorted(windows) == [(i, k) for i, t in enumerate(texts) for k in range(len(t.split()) - 12)]
    assert len(packed) < len(windows) / 2
    string, place, name = superkmer_dedup.window_names(packed, 13)
    grams = [tuple(packed[s].split(b" ")[p : p + 13]) for s, p in zip(string, place, strict=True)]
    assert len(grams) == len(windows) and len(set(grams)) == len(set(name.tolist())) == len(set(zip(grams, name.tolist(), strict=True)))


@pytest.mark.parametrize("size", [1, 200, 1 << 20])
def test_buckets_are_never_torn(monkeypatch, size):
    monkeypatch.setattr(superkmer_dedup, "BUCKET_BYTES", size)
    rows = [(b, i, i, 0, words(b * 10 + (i % 3), 20).encode()) for b in range(12) for i in range(1 + 7 * (b % 4))]
    table = pa.table(dict(zip(["bucket", "id", "key", "first", "packed"], map(list, zip(*rows, strict=True)), strict=True)))
    found = [r for out in superkmer_dedup._buckets(iter(table.to_batches(max_chunksize=5)), 13) for r in out.to_pylist()]
    want = [(i, 0, 20) for b, i, _, _, _ in rows if i >= 3]
    assert sorted((r["id"], r["first"], r["end"]) for r in found) == sorted(want)
