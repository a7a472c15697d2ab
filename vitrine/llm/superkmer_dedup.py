"""Repeated word windows by super-k-mer partitioning.

A window is a fixed number of consecutive words. Its minimiser is the least hash of the shorter runs of
words in it, so equal windows have equal minimisers. Consecutive windows with one minimiser overlap in
all but one word each, and travel as one packed string, a super-k-mer, to the bucket of the minimiser.
There the strings come sorted by minimiser and document; windows are named exactly (words, then pairs,
fours, eights and so on, never hashes) and sorted by name, the least document first.

1. Count super-k-mers and windows by minimiser; combined on the map side, no text moves.
2. A minimiser met once holds no repeat. The others mark a bit map, at most ``MOST_BITS`` large and a bit
   an eighth full below that; what it does not show stays where it is. The map only saves traffic: when
   it fills up with the corpus more strings travel and the result is the same.
3. In hot buckets equal strings are first made one, with their least document,
   by partial aggregation; the windows of the different strings are then keyed by their words. What a
   string is told (its least document, and where others are earlier) is sent to the slices of its rows,
   which are the more the larger the bucket, so a line that a third of the documents share is never one task's work.
4. Covered words are merged by document and cut out of it.

A word is removed if a window over it also starts in a document with a smaller id, judged on the input.

Rows: null text has no words; a null id comes after all ids, and rows without id do not remove each
other's words; rows of one id, repeated or not, never remove each other's words either; texts with fewer
words than a window keep all; very long texts are read in pieces that share a window less a word; an
empty table gives an empty result; further columns are not read by ``digest`` and are carried whole by
``remove_repeats``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..stages import stage
from ..workers import ship_package
from .common import same, text_or_empty

WINDOW_WORDS = 13
MINIMISER_WORDS = 5
#: A bucket is hot if it holds more than HOT windows and than one in HOT_SHARE of all, so the same share of the
#: input is hot at every size; and always above MOST_HOT, which a task holds in memory.
HOT, HOT_SHARE, MOST_HOT = 4096, 2000, 1 << 18
#: The rows of hot buckets go to SLICES slices, and to 2, 4, 8, ... times as many where they are 2, 4, 8, ... times as large.
SPREAD, SLICES = 2, 4
MOST_BITS = 1 << 28
#: Windows that one packed string holds at most.
MOST_WINDOWS = 64
#: Bytes that are hashed, or named in a bucket, together.
PIECE_BYTES, BUCKET_BYTES = 1 << 21, 1 << 23

_IN_WORD = np.ones(256, dtype=bool)
_IN_WORD[[32, *range(9, 14)]] = False
with np.errstate(over="ignore"):
    _POWERS = np.cumprod(np.full(4096, 0x9E3779B97F4A7C15, dtype=np.uint64), dtype=np.uint64)


def _mixed(z: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return z ^ (z >> np.uint64(31))


def _words(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edges = np.flatnonzero(np.diff(np.concatenate([[0], _IN_WORD[data].view(np.int8), [0]])))
    return edges[::2], edges[1::2]


def text_parts(text: bytes, window: int, size: int) -> Iterator[tuple[int, bytes]]:
    """(number of the first word, bytes) of parts that share all but one word of a window."""
    at, number, step = 0, 0, size
    while len(text) - at > step:
        end = at + step
        while end < len(text) and text[end] not in b" \t\n\x0b\x0c\r":
            end += 1
        starts, _ = _words(np.frombuffer(text, dtype=np.uint8, count=end - at, offset=at))
        if len(starts) < 2 * window:
            step *= 2
            continue
        yield number, text[at:end]
        number += len(starts) - window + 1
        at += int(starts[1 - window])
        step = size
    yield number, text[at:]


class Runs:
    """The super-k-mers of some texts: text, first word, windows and bucket of each, and the packed strings."""

    def __init__(self, texts: list[bytes], window: int, minimiser: int):
        data = np.frombuffer(b"\n".join(texts) + b"\n", dtype=np.uint8)
        starts, ends = _words(data)
        begin = np.cumsum([0, *[len(t) + 1 for t in texts]])
        text = np.searchsorted(begin, starts, side="right") - 1
        n = len(starts) - window + 1
        windows = np.flatnonzero(text[: max(n, 0)] == text[window - 1 :]) if n > 0 else np.zeros(0, dtype=np.int64)
        if not len(windows):
            self.text = self.first = self.windows = np.zeros(0, dtype=np.int64)
            self.bucket = np.zeros(0, dtype=np.uint64)
            return
        sizes = ends - starts
        inside = np.flatnonzero(_IN_WORD[data])
        left = np.repeat(ends, sizes) - inside
        with np.errstate(over="ignore"):
            shares = (data[inside].astype(np.uint64) + np.uint64(1)) * _POWERS[left & 4095]
            hashes = _mixed(np.add.reduceat(shares, np.cumsum(sizes) - sizes))
            runs = np.zeros(len(hashes) - minimiser + 1, dtype=np.uint64)
            for k in range(minimiser):
                runs += hashes[k : len(hashes) - minimiser + 1 + k] * _POWERS[k]
        runs = _mixed(runs)
        least = runs[: len(runs) - (window - minimiser)].copy()
        for k in range(1, window - minimiser + 1):
            np.minimum(least, runs[k : k + len(least)], out=least)
        least = least[windows]
        # A string ends where the minimiser, the text or the row of windows does.
        new = np.concatenate([[True], (least[1:] != least[:-1]) | (windows[1:] != windows[:-1] + 1)])
        heads = np.flatnonzero(new)
        place = np.arange(len(windows)) - np.repeat(heads, np.diff(np.concatenate([heads, [len(windows)]])))
        heads = np.flatnonzero(place % MOST_WINDOWS == 0)
        self.windows = np.diff(np.concatenate([heads, [len(windows)]]))
        self._head = windows[heads]
        self.text = text[self._head]
        self.first = self._head - np.searchsorted(text, self.text)
        self.bucket = _mixed(least[heads] + np.uint64(0x632BE59BD9B4E019))
        self._data, self._starts, self._sizes, self._ends, self._window = data, starts, sizes, ends, window

    def packed(self, wanted: np.ndarray) -> list[bytes]:
        """The words of the wanted super-k-mers, joined by single spaces."""
        keep = _IN_WORD[self._data]
        keep[self._ends] = True  # the white space right after a word
        joined = np.where(_IN_WORD[self._data], self._data, 32)[keep].astype(np.uint8).tobytes()
        at = np.concatenate([[0], np.cumsum(self._sizes + 1)])
        first = self._head[wanted]
        a, b = at[first], at[first + self.windows[wanted] + self._window - 1] - 1
        return [joined[i:j] for i, j in zip(a.tolist(), b.tolist(), strict=True)]


def _runs(batch: pa.RecordBatch, window: int, minimiser: int) -> Iterator[tuple[np.ndarray, np.ndarray, Runs]]:
    """(row of each text, its first word's number, runs) of a batch whose last column is the text, by bounded pieces."""
    rows: list[int] = []
    numbers: list[int] = []
    held: list[bytes] = []
    size = 0
    for row, text in enumerate(batch.column(batch.num_columns - 1).to_pylist()):
        for number, part in text_parts(text, window, PIECE_BYTES):
            if held and size + len(part) > PIECE_BYTES:
                yield np.array(rows), np.array(numbers), Runs(held, window, minimiser)
                rows, numbers, held, size = [], [], [], 0
            rows.append(row)
            numbers.append(number)
            held.append(part)
            size += len(part)
    if held:
        yield np.array(rows), np.array(numbers), Runs(held, window, minimiser)


def _identity(id_col: str, text_col: str) -> list[Column]:
    """id, key (of id and text) and text as bytes; rows of equal id and text share a key."""
    text = text_or_empty(text_col)
    return [F.col(id_col).alias("id"), F.xxhash64(F.col(id_col).cast("string"), text).alias("key"), text.cast("binary").alias("text")]


def bucket_counts(source: DataFrame, window: int, minimiser: int) -> DataFrame:
    """Stage table (bucket, runs, windows) of buckets that more than one super-k-mer goes to."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, runs in _runs(batch, window, minimiser):
                yield pa.RecordBatch.from_arrays([pa.array(runs.bucket.view(np.int64)), pa.array(runs.windows)], names=["bucket", "windows"])

    found = source.select("text").mapInArrow(run, "bucket long, windows long")
    return stage(found.groupBy("bucket").agg(F.count("*").alias("runs"), F.sum("windows").alias("windows")).filter("runs > 1"), "buckets")


def bucket_map(counts: DataFrame, most_bits: int = MOST_BITS) -> np.ndarray:
    """Bits, by the last bits of the bucket, that are set for every bucket of ``counts``: a bit map of bounded size."""
    bits = 1 << 16
    wanted = min(8 * counts.count(), most_bits)
    while bits < wanted:
        bits *= 2
    slot = F.col("bucket").bitwiseAND(bits - 1)
    words = counts.select(F.shiftright(slot, 6).alias("word"), slot.bitwiseAND(63).cast("int").alias("bit"))
    words = words.groupBy("word").agg(F.expr("bit_or(shiftleft(1L, bit))").alias("bits"))
    found = words.toArrow()
    packed = np.zeros(bits // 64, dtype=np.uint64)
    packed[found.column("word").to_numpy()] = found.column("bits").to_numpy().view(np.uint64)
    return packed


def _shown(packed: np.ndarray, buckets: np.ndarray) -> np.ndarray:
    slot = buckets & np.uint64(len(packed) * 64 - 1)
    return (packed[(slot >> np.uint64(6)).astype(np.int64)] >> (slot & np.uint64(63)) & np.uint64(1)).astype(bool)


def window_names(packed: list[bytes], window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(string, place in it, name) of every window of the strings; windows have equal names if and only if their words are equal."""
    data = np.frombuffer(b" ".join(packed) + b" ", dtype=np.uint8)
    ends = np.flatnonzero(data == 32) + 1
    words = pa.Array.from_buffers(pa.large_binary(), len(ends), [None, pa.py_buffer(np.concatenate([[0], ends]).astype(np.int64).tobytes()), pa.py_buffer(data.tobytes())])
    single = words.dictionary_encode().indices.to_numpy().astype(np.int64)
    # Names of runs of 1, 2, 4, ... words; the window is put together from them.
    whole, length, power, size = None, 0, single, 1
    while True:
        if window & size:
            if whole is None:
                whole = power
            else:
                ahead = power[length:]
                whole = pd.factorize(whole[: len(ahead)] * (np.int64(ahead.max(initial=0)) + 1) + ahead)[0].astype(np.int64)
            length += size
        if length == window:
            break
        power = pd.factorize(power[:-size] * (np.int64(power.max(initial=0)) + 1) + power[size:])[0].astype(np.int64)
        size *= 2
    counts = np.add.reduceat(data == 32, np.cumsum([0, *[len(p) + 1 for p in packed[:-1]]])) - window + 1
    string = np.repeat(np.arange(len(packed)), counts)
    place = np.arange(len(string)) - np.repeat(np.cumsum(counts) - counts, counts)
    return string, place, whole[np.arange(len(string)) + string * (window - 1)]


def _spans_of_buckets(table: pa.Table, window: int) -> pa.RecordBatch:
    """Covered words of whole buckets whose rows are sorted by bucket and id."""
    string, place, name = window_names(table.column("packed").to_pylist(), window)
    ids = table.column("id").combine_chunks().dictionary_encode().indices.fill_null(-1).to_numpy().astype(np.int64)
    order = np.argsort(name, kind="stable")
    heads = np.flatnonzero(np.concatenate([[True], np.diff(name[order]) != 0]))
    least = np.repeat(ids[string[order[heads]]], np.diff(np.concatenate([heads, [len(order)]])))
    again = np.zeros(len(order), dtype=bool)
    again[order] = ids[string[order]] != least
    at = np.flatnonzero(again)
    new = np.concatenate([[True], (string[at][1:] != string[at][:-1]) | (place[at][1:] != place[at][:-1] + 1)]) if len(at) else np.zeros(0, dtype=bool)
    first = at[np.flatnonzero(new)]
    last = at[np.concatenate([np.flatnonzero(new)[1:], [len(at)]]) - 1] if len(at) else at
    of = pa.array(string[first])
    offset = table.column("first").combine_chunks().take(of).to_numpy()
    return pa.RecordBatch.from_arrays(
        [table.column("id").combine_chunks().take(of), table.column("key").combine_chunks().take(of), pa.array(offset + place[first]), pa.array(offset + place[last] + window)],
        names=["id", "key", "first", "end"],
    )


def _buckets(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by bucket and id; whole buckets are worked on together, about BUCKET_BYTES at a time."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        at = 0
        bucket = batch.column("bucket").to_numpy()
        ends = np.concatenate([[0], np.cumsum([len(p) for p in batch.column("packed").to_pylist()])])
        while at < len(bucket):
            # Take rows up to the size, then on to the end of the bucket.
            stop = int(np.searchsorted(ends, ends[at] + max(0, BUCKET_BYTES - size), side="right"))
            stop = min(max(stop, at + 1), len(bucket))
            while stop < len(bucket) and bucket[stop] == bucket[stop - 1]:
                stop += 1
            if held and size >= BUCKET_BYTES and bucket[at] != held[-1].column("bucket")[-1].as_py():
                yield _spans_of_buckets(pa.Table.from_batches(held), window)
                held, size = [], 0
                continue
            if held and size >= BUCKET_BYTES:  # only the rest of the bucket
                stop = at + int(np.searchsorted(bucket[at:] != bucket[at], True)) if (bucket[at:] != bucket[at]).any() else len(bucket)
            held.append(batch.slice(at, stop - at))
            size += int(ends[stop] - ends[at])
            at = stop
    if held:
        yield _spans_of_buckets(pa.Table.from_batches(held), window)


def _hot_spans(rows: DataFrame, window: int, schema: T.StructType) -> DataFrame:
    """Covered words (id, key, first, end) of the hot buckets' strings (packed, slices, id, key, first).

    Equal strings are one; their windows are keyed by their words, and what a string finds out (its least
    id, and the least ids of windows that other strings have from smaller ids) goes to its rows' slices.
    """
    value = schema["id"]
    rows = rows.withColumn("slice", F.pmod(F.xxhash64("key", "first"), "slices"))
    alike = rows.groupBy("packed").agg(F.min("id").alias("least"), F.collect_set("slice").alias("slices"), F.count("*").alias("n"))
    alike = stage(alike.withColumn("name", F.monotonically_increasing_id()), "hot-alike")

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = [p.split(b" ") for p in batch.column(0).to_pylist()]
            counts = np.array([len(w) - window + 1 for w in words], dtype=np.int64)
            of = pa.array(np.repeat(np.arange(len(words)), counts))
            texts = [b" ".join(w[k : k + window]) for w in words for k in range(len(w) - window + 1)]
            places = np.concatenate([np.arange(n) for n in counts]) if len(counts) else counts
            yield pa.RecordBatch.from_arrays([pa.array(texts, pa.binary()), batch.column(1).take(of), pa.array(places), batch.column(2).take(of)], names=["words", "name", "place", "least"])

    fields = [T.StructField("words", T.BinaryType()), T.StructField("name", T.LongType()), T.StructField("place", T.LongType()), T.StructField("least", value.dataType)]
    single = stage(alike.select("packed", "name", "least").mapInArrow(windows, T.StructType(fields)), "hot-windows")
    first = single.groupBy("words").agg(F.min("least").alias("before"), F.count("*").alias("n")).filter("n > 1 AND before IS NOT NULL")
    first = stage(first.select(F.col("words").alias("of"), "before"), "hot-least")
    earlier = single.join(first, single["words"] == first["of"]).filter("least IS NULL OR before < least")
    earlier = earlier.groupBy("name").agg(F.collect_list("place").alias("places"))  # as many as a string has windows at most

    # Rows of all slices come after the row (first -1) that tells them about their string.
    told = alike.join(earlier, "name", "left").filter("n > 1 OR places IS NOT NULL")
    told = told.select("packed", F.explode("slices").alias("slice"), F.col("least").alias("id"), F.lit(None).cast("long").alias("key"), F.lit(-1).cast("long").alias("first"), "places")
    every = rows.select("packed", "slice", "id", "key", "first", F.lit(None).cast("array<long>").alias("places"))
    dealt = every.unionAll(told).repartition("packed", "slice").sortWithinPartitions("packed", "slice", "first")
    return dealt.mapInArrow(lambda b: _told_spans(b, window), schema)


def _merged(places: list[int], window: int) -> list[tuple[int, int]]:
    """Words that windows at these places cover, as (first, end) of runs of consecutive places."""
    runs: list[tuple[int, int]] = []
    for p in places:
        first = runs.pop()[0] if runs and runs[-1][1] == p + window - 1 else p
        runs.append((first, p + window))
    return runs


def _told_spans(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    """Strings of later ids than the least are covered whole; those of the least id where other strings are earlier."""
    packed, least, places, length = None, None, None, 0
    for batch in batches:
        hits: list[tuple] = []
        for at, (of, id_, first, found) in enumerate(zip(*[batch.column(c).to_pylist() for c in ("packed", "id", "first", "places")], strict=True)):
            if first < 0:
                packed, least, places, length = of, id_, _merged(sorted(found or ()), window), of.count(b" ") + 1
            elif of != packed:
                continue
            elif least is not None and (id_ is None or id_ > least):
                hits.append((at, first, first + length))
            else:
                hits += [(at, first + a, first + b) for a, b in places]
        taken = batch.take(pa.array([h[0] for h in hits], pa.int64()))
        yield pa.RecordBatch.from_arrays(
            [taken.column("id"), taken.column("key"), pa.array([h[1] for h in hits], pa.int64()), pa.array([h[2] for h in hits], pa.int64())], names=["id", "key", "first", "end"]
        )


def covered(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW_WORDS, minimiser: int = MINIMISER_WORDS, hot: int = HOT, most_bits: int = MOST_BITS) -> DataFrame:
    """Stage table (id, key, spans): words of each row that windows of smaller ids cover, as an array first, end, first, end, ..."""
    spark = docs.sparkSession
    ship_package(spark)
    source = docs.select(*_identity(id_col, text_col))
    counts = bucket_counts(source, window, minimiser)
    shown = spark.sparkContext.broadcast(bucket_map(counts, most_bits))
    # Maps of the hot buckets, and of those SPREAD, SPREAD^2, ... times as large.
    levels, (most, total) = [], counts.agg(F.coalesce(F.max("windows"), F.lit(0)), F.coalesce(F.sum("windows"), F.lit(0))).first()
    hot = max(hot, min(total // HOT_SHARE, MOST_HOT))
    while most > hot * SPREAD ** len(levels):
        levels.append(spark.sparkContext.broadcast(bucket_map(counts.filter(F.col("windows") > hot * SPREAD ** len(levels)), most_bits)))
    any_hot = bool(levels)
    key, value = source.schema["key"], T.StructField("id", source.schema["id"].dataType)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, numbers, runs in _runs(batch, window, minimiser):
                at = np.flatnonzero(_shown(shown.value, runs.bucket) & ~(any_hot and _shown(levels[0].value, runs.bucket)))
                if len(at):
                    of = pa.array(rows[runs.text[at]])
                    first = pa.array(numbers[runs.text[at]] + runs.first[at])
                    columns = [pa.array(runs.bucket[at].view(np.int64)), batch.column(0).take(of), batch.column(1).take(of), first, pa.array(runs.packed(at), pa.binary())]
                    yield pa.RecordBatch.from_arrays(columns, names=["bucket", "id", "key", "first", "packed"])

    schema = T.StructType([T.StructField("bucket", T.LongType()), value, key, T.StructField("first", T.LongType()), T.StructField("packed", T.BinaryType())])
    dealt = source.mapInArrow(pack, schema).repartition("bucket").sortWithinPartitions("bucket", F.col("id").asc_nulls_last())
    spans_schema = T.StructType([value, key, T.StructField("first", T.LongType()), T.StructField("end", T.LongType())])
    spans = dealt.mapInArrow(lambda b: _buckets(b, window), spans_schema)

    if any_hot:

        def single(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for rows, numbers, runs in _runs(batch, window, minimiser):
                    level = sum(_shown(m.value, runs.bucket).astype(np.int64) for m in levels)
                    at = np.flatnonzero(level)
                    if len(at):
                        of, first = pa.array(rows[runs.text[at]]), pa.array(numbers[runs.text[at]] + runs.first[at])
                        columns = [pa.array(runs.packed(at), pa.binary()), pa.array(SLICES * SPREAD ** (level[at] - 1)), batch.column(0).take(of), batch.column(1).take(of), first]
                        yield pa.RecordBatch.from_arrays(columns, names=["packed", "slices", "id", "key", "first"])

        strings = T.StructType([T.StructField("packed", T.BinaryType()), T.StructField("slices", T.LongType()), value, key, T.StructField("first", T.LongType())])
        rows = stage(source.mapInArrow(single, strings), "hot-strings")
        spans = spans.unionAll(_hot_spans(rows, window, spans_schema))
    pairs = spans.distinct().groupBy("id", "key").agg(F.flatten(F.collect_list(F.array("first", "end"))).alias("spans"))
    return stage(pairs, "covered")


def _with_spans(docs: DataFrame, spans: DataFrame, id_col: str, text_col: str, kept: list[Column]) -> DataFrame:
    source = docs.select(*kept, *_identity(id_col, text_col))
    other = spans.select(F.col("id").alias("s_id"), F.col("key").alias("s_key"), "spans")
    return source.join(other, same(source, other, [("key", "s_key"), ("id", "s_id")]), "left")


def _kept_words(text: bytes, spans: np.ndarray | None) -> tuple[int, list[bytes]]:
    words = text.split()
    if spans is None or not len(spans):
        return len(words), words
    edges = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(edges, spans[::2], 1)
    np.add.at(edges, spans[1::2], -1)
    return len(words), [words[i] for i in np.flatnonzero(np.cumsum(edges[:-1]) == 0).tolist()]


def _each(batch: pa.RecordBatch) -> Iterator[tuple[int, list[bytes]]]:
    """(words, kept words) of the rows of a batch that ends in text and spans."""
    for text, spans in zip(batch.column(batch.num_columns - 2).to_pylist(), batch.column(batch.num_columns - 1), strict=True):
        yield _kept_words(text, spans.values.to_numpy() if spans.is_valid else None)


def digest(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row per input row: id_col, n_words, n_removed, kept_sha256 (of the kept words joined by single spaces)."""
    spans = covered(docs, id_col, text_col, **options)
    source = _with_spans(docs, spans, id_col, text_col, []).select("id", "text", "spans")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, removed, digests = [], [], []
            for n, kept in _each(batch):
                counts.append(n)
                removed.append(n - len(kept))
                digests.append(hashlib.sha256(b" ".join(kept)).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(digests, pa.string())], names=[id_col, "n_words", "n_removed", "kept_sha256"])

    wanted = source.select(F.col("id").alias(id_col), F.lit(0).cast("long").alias("n_words"), F.lit(0).cast("long").alias("n_removed"), F.lit("").alias("kept_sha256"))
    return source.mapInArrow(run, wanted.schema)


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with the kept words of each text, joined by single spaces; a text that loses nothing stays as it is, and so do all other columns."""
    spans = covered(docs, id_col, text_col, **options)
    source = _with_spans(docs, spans, id_col, text_col, [F.struct("*").alias("row")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [b" ".join(kept).decode() if len(kept) < n else None for n, kept in _each(batch)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["row", "cut"])

    cut = source.select("row", "text", "spans")
    found = cut.mapInArrow(run, T.StructType([cut.schema["row"], T.StructField("cut", T.StringType())]))
    return found.select(*[F.coalesce("cut", F.col("row")[c]).alias(c) if c == text_col else F.col("row")[c].alias(c) for c in docs.columns])


def oracle(window: int = WINDOW_WORDS) -> str:
    """DuckDB SQL for the query's rows."""
    return rf"""
        WITH d AS (SELECT doc_id, row_number() OVER () AS rid, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words FROM documents),
        u AS (SELECT rid, doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS i FROM d),
        g AS (SELECT rid, doc_id, i, list(word) OVER (PARTITION BY rid ORDER BY i ROWS BETWEEN CURRENT ROW AND {window - 1} FOLLOWING) AS gram FROM u),
        r AS (SELECT rid, i FROM (SELECT rid, i, doc_id, min(doc_id) OVER (PARTITION BY gram) AS least FROM g WHERE len(gram) = {window}) WHERE coalesce(doc_id > least, least IS NOT NULL)),
        c AS (SELECT DISTINCT rid, i + k AS i FROM r, range({window}) AS s(k)),
        k AS (SELECT rid, count(c.i) AS n_removed, string_agg(word, ' ' ORDER BY i) FILTER (c.i IS NULL) AS kept FROM u LEFT JOIN c USING (rid, i) GROUP BY rid)
        SELECT doc_id, len(words) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM d LEFT JOIN k USING (rid)
    """
