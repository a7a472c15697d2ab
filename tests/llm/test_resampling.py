"""Bit-sliced weights against feature by feature sums in plain Python."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from vitrine.llm import importance_resampling

from .test_operators import awkward_texts, sorted_rows, words

FEATURE_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def features(text: str | bytes | None) -> tuple[int, Counter]:
    raw = text.encode() if isinstance(text, str) else text or b""
    found = FEATURE_WORD.findall(bytes(b + 32 if 65 <= b <= 90 else b for b in raw))
    return len(found), Counter(zlib.crc32(b" ".join(found[i : i + n])) % 10000 for n in (1, 2, 3) for i in range(len(found) - n + 1))


def brute(rows: list[tuple], target: list) -> list[tuple]:
    bags = [features(t) for _, t in rows]
    s, t = sum((b for _, b in bags), Counter()), sum((features(x)[1] for x in target), Counter())
    s_all, t_all = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (s_all + 10000) / ((s[b] + 1) * (t_all + 10000)))) for b in range(10000)]
    out = []
    for (i, _), (n, bag) in zip(rows, bags, strict=True):
        weight = sum(c * gain[b] for b, c in bag.items())
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, sum(bag.values()), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, n])
    drawn = sorted((r for r in out if r[5] >= 20), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for rank, r in enumerate(drawn[: 5 * len(drawn) // 100], 1):
        r[4] = rank
    return [tuple(r[:5]) for r in out]


def texts() -> list[tuple]:
    rnd = random.Random(4)
    more = [(100 + k, words(rnd.randint(0, 30), rnd.randint(0, 60)) + rnd.choice(["", " ÉCOLE 12é", " x" * 300, "\x00a_b"])) for k in range(140)]
    return [*awkward_texts(), *more, (500, "Wide" * 400 + " b c " + "w" * 255 + " " + "v" * 256), (100, more[0][1])]


@pytest.fixture(scope="module")
def rows(spark):
    clash = "id string, text_hash string, n_words string, planes string, totals string, rank string, row string, place string"
    return spark.createDataFrame([(i, t, *["own"] * 8) for i, t in texts()], f"doc_id long, text string, {clash}").repartition(3).cache()


TARGET = [words(3, 40), words(7, 100), None, "", "x x x"]


def test_weights_and_ranks_equal_brute_force(spark, rows):
    target = spark.createDataFrame([(k, t) for k, t in enumerate(TARGET)], "item_id long, text string")
    got = importance_resampling.weigh(rows, target).select("doc_id", "n_features", "weight", "score", "rank").collect()
    assert sorted_rows(got) == sorted_rows(brute(texts(), TARGET))
    drawn = importance_resampling.resample(rows, target, percent=20)
    assert drawn.columns == rows.columns
    ranked = importance_resampling.weigh(rows, target, percent=20).filter("rank IS NOT NULL")
    assert drawn.count() == ranked.select("doc_id", "text_hash").distinct().count() > 10
    none = spark.createDataFrame([], rows.schema)
    assert importance_resampling.weigh(none, target).count() == 0 and importance_resampling.resample(none, target).count() == 0
    assert importance_resampling.weigh(rows, target.limit(0)).count() == len(texts())


@pytest.mark.parametrize("size, count", [(1 << 21, 2048), (50, 3), (7, 2), (900, 2)])
def test_pieces_and_planes_give_exact_weights(monkeypatch, size, count):
    monkeypatch.setattr(importance_resampling, "PIECE_BYTES", size)
    monkeypatch.setattr(importance_resampling, "PIECE_TEXTS", count)
    rnd = random.Random(1)

    def text(n: int) -> bytes:
        return b"".join(bytes(rnd.choice(b"aeiouAZ09 \n.,-\x00\xc3\xa9") for _ in range(rnd.choice([3, 8, 400 if rnd.random() < 0.02 else 5]))) + b" " for _ in range(n))

    found = [text(rnd.randint(0, 60)) for _ in range(40)] + [b"", b"a", b"x" * 600, b"y " * 900]
    gains, seen = np.array([rnd.randint(-9000, 9000) for _ in range(10000)]), 0
    for a, b, (n_words, row, bucket, counts) in importance_resampling.pieces(found):
        assert a == seen
        seen = b
        weights = importance_resampling.plane_weights(*importance_resampling.count_planes(b - a, row, bucket, counts), importance_resampling.gain_planes(gains))
        for i in range(a, b):
            n, bag = features(found[i])
            mine = row == i - a
            assert n == n_words[i - a] and bag == dict(zip(bucket[mine].tolist(), counts[mine].tolist(), strict=True))
            assert weights[i - a] == sum(c * gains[k] for k, c in bag.items())
    assert seen == len(found)
