"""Repeated passages by a common-prefix interval tree over an enhanced suffix array.

Which bytes lie in a string of ``min_bytes`` that also starts elsewhere is decided exactly:

1. Every window of ``min_bytes`` bytes picks one short gram in it, the one with the least hash
   (leftmost of equals). Equal windows pick the same gram at the same offset, so only suffixes at
   picked places ("anchors", about one in 75 bytes) whose gram occurs twice or more are compared.
2. An anchor's context holds all windows that picked it. Equal contexts become one row with a
   count, so a passage that a third of all rows holds is a few rows.
3. Per gram the contexts are sorted by what follows the anchor: a slice of the sparse suffix array.
   A stack scan of the common-prefix lengths of neighbours gives the interval tree. In every
   interval the members are sorted again by what precedes the anchor, reversed; the same scan
   over these common lengths tests left-extension diversity and yields the maximal repeats, with
   all their occurrences. A member's repeated bytes reach from its longest left extension
   within an interval to the interval's length on the right.
4. Grams with more than ``BUCKET`` different contexts are cut into single windows, that is into the
   intervals of depth ``min_bytes``, counted by Spark: no task holds a hot gram.

Text is shuffled once and then read from a bucketed stage table. The hash of a gram only routes:
contexts are compared byte by byte. Equal contexts are recognised by a 128-bit digest.

Rows: a null text is empty; texts shorter than ``min_bytes`` are kept whole; rows with the same id
and text are repeats of each other; a null id is carried along; an empty table gives an empty
result; further columns are not read.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..stages import stage, stage_path
from ..workers import ship_package
from .common import text_or_empty

MIN_BYTES = 200
BUCKET = 4096
_STEP = 1 << 20  # window starts looked at together
_PIECE = 1 << 12  # anchors that a Python worker unpacks together
_BATCH_ROWS = 500  # whole texts that travel to a Python worker together
_BASE = 0x9E3779B97F4A7C15 | 1
_TABLE = np.random.default_rng(20240229).integers(0, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def gram_bytes(min_bytes: int) -> int:
    return max(1, min_bytes // 4)


def _powers(base: int, count: int) -> np.ndarray:
    out = np.empty(count, dtype=np.uint64)
    out[0], done, step = 1, 1, base
    with np.errstate(over="ignore"):
        while done < count:
            take = min(done, count - done)
            out[done : done + take] = out[:take] * np.uint64(step)
            done, step = done + take, step * step % 2**64 if take == done else step
    return out


_power_cache: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def gram_hashes(data: np.ndarray, size: int) -> np.ndarray:
    """A 64-bit hash of the ``size`` bytes at each place: a polynomial by prefix sums, then mixed."""
    length = len(data)
    if _STEP not in _power_cache:
        room = 2 * _STEP
        _power_cache[_STEP] = _powers(_BASE, room), _powers(pow(_BASE, -1, 2**64), room)
    up, down = _power_cache[_STEP]
    with np.errstate(over="ignore"):
        sums = np.zeros(length + 1, dtype=np.uint64)
        np.cumsum(_TABLE[data] * down[:length], out=sums[1:])
        z = (sums[size:] - sums[:-size]) * up[: length - size + 1]
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return z ^ (z >> np.uint64(31))


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` neighbours."""
    blocks = -(-len(values) // width)
    padded = np.full(blocks * width, np.iinfo(values.dtype).max, dtype=values.dtype)
    padded[: len(values)] = values
    table = padded.reshape(blocks, width)
    ahead = np.minimum.accumulate(table, axis=1).ravel()
    behind = np.minimum.accumulate(table[:, ::-1], axis=1)[:, ::-1].ravel()
    count = len(values) - width + 1
    return np.minimum(behind[:count], ahead[width - 1 : width - 1 + count])


def picked_places(data: np.ndarray, offsets: np.ndarray, min_bytes: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(hash, place, first window, last window) of the anchors of texts that lie one after another."""
    gram = gram_bytes(min_bytes)
    starts, ends = offsets[:-1], offsets[1:]
    long_enough = ends - starts >= min_bytes
    first, stop = starts[long_enough], ends[long_enough] - min_bytes + 1
    total = len(data) - min_bytes + 1
    for low in range(0, max(total, 0), _STEP):
        high = min(low + _STEP, total)
        inside = np.zeros(high - low + 1, dtype=np.int64)
        np.add.at(inside, np.clip(first, low, high) - low, 1)
        np.add.at(inside, np.clip(stop, low, high) - low, -1)
        windows = np.flatnonzero(np.cumsum(inside[:-1]))
        if not len(windows):
            continue
        hashes = gram_hashes(data[low : high + min_bytes - 1], gram)
        place_bits = np.uint64(_STEP * 2 - 1)
        keyed = (hashes & ~place_bits) | np.arange(len(hashes), dtype=np.uint64)
        picks = (sliding_least(keyed, min_bytes - gram + 1)[windows] & place_bits).astype(np.int64)
        turn = np.flatnonzero(np.r_[True, (picks[1:] != picks[:-1]) | (windows[1:] != windows[:-1] + 1)])
        last = np.r_[turn[1:], len(picks)] - 1
        yield hashes[picks[turn]].view(np.int64), picks[turn] + low, windows[turn] + low, windows[last] + low


def _pack(place: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    return place << 24 | (place - low) << 12 | (high - low)


def _bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a binary column one after another, and the offsets of its rows."""
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def _anchors(texts: DataFrame, min_bytes: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = _bytes_of(batch.column("text"))
            k1, k2 = batch.column("k1").to_numpy(), batch.column("k2").to_numpy()
            for hashes, place, low, high in picked_places(data, offsets, min_bytes):
                row = np.searchsorted(offsets, place, side="right") - 1
                base = offsets[row]
                at = _pack(place - base, low - base, high - base)
                yield pa.RecordBatch.from_arrays([pa.array(hashes), pa.array(k1[row]), pa.array(k2[row]), pa.array(at)], names=["gram", "k1", "k2", "at"])

    return texts.mapInArrow(run, "gram long, k1 long, k2 long, at long")


@contextmanager
def _small_batches(spark: SparkSession) -> Iterator[None]:
    """Inside, few whole texts are in one Arrow batch; the session's setting comes back after."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, _BATCH_ROWS)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def _stage(df: DataFrame, name: str) -> DataFrame:
    with _small_batches(df.sparkSession):
        return stage(df, name)


def anchors_of(batch: pa.RecordBatch, most: int = _PIECE) -> Iterator[tuple[np.ndarray, dict[str, np.ndarray]]]:
    """(rows, fields) of the anchors in the lists ``found``, at most ``most`` at a time, however many a text has."""
    found = batch.column("found")
    fields = found.flatten()
    row = np.repeat(np.arange(len(found)), found.value_lengths().fill_null(0).to_numpy())
    names = [f.name for f in fields.type]
    for low in range(0, len(fields), most):
        some = fields.slice(low, most)
        yield row[low : low + most], {c: a.to_numpy(zero_copy_only=False) for c, a in zip(names, some.flatten(), strict=True)}


def _spots(rows: np.ndarray, at: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchor, first and last window as places in the bytes of the batch."""
    base = offsets[rows]
    place = at >> 24
    low = place - (at >> 12 & 4095)
    return base + place, base + low, base + low + (at & 4095)


def _mark(context: bytes | memoryview, left: int) -> bytes:
    return hashlib.blake2b(context, digest_size=16, salt=left.to_bytes(8, "big")).digest()


def _halves(digests: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """128-bit digests as two columns of numbers."""
    pairs = np.frombuffer(b"".join(digests), dtype=">i8").reshape(-1, 2).astype(np.int64)
    return np.ascontiguousarray(pairs[:, 0]), np.ascontiguousarray(pairs[:, 1])


def _marked(texts: DataFrame, min_bytes: int) -> DataFrame:
    """(gram, m1, m2, k1, k2, at, times): every candidate anchor with the digest of its context."""
    names = ["gram", "m1", "m2", "k1", "k2", "at", "times"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = _bytes_of(batch.column("text"))
            view = memoryview(data)
            k1, k2, times = [batch.column(c).to_numpy() for c in ("k1", "k2", "times")]
            for rows, f in anchors_of(batch):
                spots = zip(*[x.tolist() for x in _spots(rows, f["at"], offsets)], strict=True)
                m1, m2 = _halves([_mark(view[low : high + min_bytes], place - low) for place, low, high in spots])
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in (f["gram"], m1, m2, k1[rows], k2[rows], f["at"], times[rows])], names=names)

    return texts.mapInArrow(run, "gram long, m1 long, m2 long, k1 long, k2 long, at long, times long")


def _contexts(texts: DataFrame, min_bytes: int) -> DataFrame:
    """(gram, m1, m2, n, left, context) of the first occurrence of every different context."""
    names = ["gram", "m1", "m2", "n", "left", "context"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = _bytes_of(batch.column("text"))
            for rows, f in anchors_of(batch):
                place, low, high = _spots(rows, f["at"], offsets)
                context = [data[a : b + min_bytes].tobytes() for a, b in zip(low.tolist(), high.tolist(), strict=True)]
                numbers = [pa.array(c) for c in (f["gram"], f["m1"], f["m2"], f["n"], place - low)]
                yield pa.RecordBatch.from_arrays([*numbers, pa.array(context, pa.binary())], names=names)

    return texts.mapInArrow(run, "gram long, m1 long, m2 long, n long, left long, context binary")


def _windows(texts: DataFrame, min_bytes: int) -> DataFrame:
    """(w1, w2, m1, m2, n, back): every window of the contexts, for grams with many contexts."""
    names = ["w1", "w2", "m1", "m2", "n", "back"]
    together = max(1, _PIECE * 8 // min_bytes)  # an anchor has fewer than min_bytes windows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for batch in batches:
            data, offsets = _bytes_of(batch.column("text"))
            view = memoryview(data)
            for rows, f in anchors_of(batch, together):
                place, low, high = _spots(rows, f["at"], offsets)
                count = high - low + 1
                start = np.repeat(low - np.r_[0, np.cumsum(count)[:-1]], count) + np.arange(count.sum())
                w1, w2 = _halves([xxhash.xxh3_128_digest(view[s : s + min_bytes]) for s in start.tolist()])
                repeated = [np.repeat(c, count) for c in (f["m1"], f["m2"], f["n"])]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in (w1, w2, *repeated, np.repeat(place, count) - start)], names=names)

    return texts.mapInArrow(run, "w1 long, w2 long, m1 long, m2 long, n long, back long")


# --- the interval tree -----------------------------------------------------------------------


def common_lengths(texts: list[bytes]) -> np.ndarray:
    """Common prefix length of each text with the one before it (0 for the first)."""
    sizes = np.array([len(t) for t in texts])
    width = max(int(sizes.max()), 1)
    table = np.frombuffer(b"".join([t.ljust(width, b"\0") for t in texts]), dtype=np.uint8).reshape(-1, width)
    differs = table[1:] != table[:-1]
    lengths = np.where(differs.any(axis=1), differs.argmax(axis=1), width)
    return np.r_[0, np.minimum(lengths, np.minimum(sizes[1:], sizes[:-1]))]


def intervals(lengths: list[int]) -> Iterator[tuple[int, int, int]]:
    """(common length, first, last) of every interval of the tree, by one scan with a stack.

    ``lengths[i]`` is the common length of neighbours i-1 and i, and negative between groups.
    """
    stack: list[tuple[int, int]] = []
    count = len(lengths)
    for i in range(1, count + 1):
        here = lengths[i] if i < count else -1
        first = i - 1
        while stack and stack[-1][0] > here:
            length, first = stack.pop()
            yield length, first, i - 1
        if here >= 0 and (not stack or stack[-1][0] < here):
            stack.append((here, first))


class Contexts:
    """Contexts of some grams in suffix order, with the common lengths on both sides of the anchors."""

    def __init__(self, gram: list[int], left: list[int], context: list[bytes]):
        right = [c[k:] for c, k in zip(context, left, strict=True)]
        self.order = sorted(range(len(gram)), key=lambda i: (gram[i], right[i]))
        ahead = [right[i] for i in self.order]
        self.behind = [context[i][: left[i]][::-1] for i in self.order]
        grams = np.array([gram[i] for i in self.order])
        self.lengths = common_lengths(ahead)
        self.lengths[1:][grams[1:] != grams[:-1]] = -1
        self.beside = common_lengths(self.behind)
        self.most_behind = np.array([len(b) for b in self.behind])

    def repeats(self, min_bytes: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(length ahead, members, common length behind of neighbours) of every interval that can
        reach ``min_bytes``; members are in the order of what precedes them."""
        for length, first, last in intervals(self.lengths.tolist()):
            if length + self.most_behind[first : last + 1].max() < min_bytes:
                continue
            if last == first + 1:
                yield length, np.array([first, last]), np.array([0, self.beside[last]])
            else:
                members = sorted(range(first, last + 1), key=self.behind.__getitem__)
                yield length, np.array(members), common_lengths([self.behind[m] for m in members])

    def reach(self, min_bytes: int) -> tuple[np.ndarray, np.ndarray]:
        """For each context (in the order given) how far its repeats go back and ahead of the anchor; 0, 0 if none."""
        back, ahead = np.zeros(len(self.order), dtype=np.int64), np.zeros(len(self.order), dtype=np.int64)
        for length, members, shared in self.repeats(min_bytes):
            best = np.maximum(shared, np.r_[shared[1:], 0])
            hit = best + length >= min_bytes
            at = members[hit]
            back[at] = np.maximum(back[at], best[hit])
            ahead[at] = np.maximum(ahead[at], length)
        out_back, out_ahead = np.zeros_like(back), np.zeros_like(ahead)
        out_back[self.order], out_ahead[self.order] = back, ahead
        return out_back, out_ahead

    def groups(self, min_bytes: int) -> Iterator[tuple[int, int, list[int]]]:
        """Maximal repeats as (bytes behind, bytes ahead, contexts): no more bytes are common to all
        on the left (left-diverse) nor on the right (not all in one smaller interval)."""
        for length, members, shared in self.repeats(min_bytes):
            for behind, first, last in intervals([-1, *shared[1:].tolist()]):
                inside = np.sort(members[first : last + 1])
                if behind + length >= min_bytes and self.lengths[inside[0] + 1 : inside[-1] + 1].min() == length:
                    yield behind, length, [self.order[m] for m in inside]


def _scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, list]]:
    """Whole grams from rows that come sorted by gram; a gram may go over batch borders."""
    held: pa.Table | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch]) if held is None else pa.concat_tables([held, pa.Table.from_batches([batch])])
        grams = table.column("gram").to_numpy()
        cut = int(np.searchsorted(grams, grams[-1], side="left"))
        held = table.slice(cut)
        if cut:
            yield table.slice(0, cut).to_pydict()
    if held is not None:
        yield held.to_pydict()


def _reach(contexts: DataFrame, min_bytes: int) -> DataFrame:
    """(m1, m2, back, ahead) of the contexts with repeated bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _scanned(batches):
            back, ahead = Contexts(rows["gram"], rows["left"], rows["context"]).reach(min_bytes)
            copies = np.array(rows["n"]) > 1
            left = np.array(rows["left"])
            whole = np.array([len(c) for c in rows["context"]]) - left
            back, ahead = np.where(copies, left, back), np.where(copies, whole, ahead)
            hit = ahead > 0
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.array(rows["m1"])[hit]), pa.array(np.array(rows["m2"])[hit]), pa.array(back[hit]), pa.array(ahead[hit])],
                names=["m1", "m2", "back", "ahead"],
            )

    dealt = contexts.repartition("gram").sortWithinPartitions("gram")
    return dealt.mapInArrow(run, "m1 long, m2 long, back long, ahead long")


def _groups(contexts: DataFrame, min_bytes: int) -> DataFrame:
    """(gram, number, back, ahead, m1, m2): members of the maximal repeats among different contexts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _scanned(batches):
            out = []
            found = Contexts(rows["gram"], rows["left"], rows["context"])
            repeats = list(found.groups(min_bytes))
            for i, n in enumerate(rows["n"]):  # copies of one context are a repeat of its whole length
                if n > 1:
                    repeats.append((rows["left"][i], len(rows["context"][i]) - rows["left"][i], [i]))
            for behind, ahead, members in repeats:
                first = min((rows["m1"][m], rows["m2"][m]) for m in members)
                out += [(rows["gram"][m], first[0], first[1], behind, ahead, rows["m1"][m], rows["m2"][m]) for m in members]
            if out:
                table = np.array(out, dtype=np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in table.T.copy()], names=["gram", "g1", "g2", "back", "ahead", "m1", "m2"])

    dealt = contexts.repartition("gram").sortWithinPartitions("gram")
    return dealt.mapInArrow(run, "gram long, g1 long, g2 long, back long, ahead long, m1 long, m2 long")


# --- the operator ----------------------------------------------------------------------------


class RepeatIndex:
    """Texts with repeated grams and the contexts of their anchors, as stage tables."""

    def __init__(self, docs: DataFrame, min_bytes: int = MIN_BYTES, id_col: str = "doc_id", text_col: str = "text", bucket: int = BUCKET):
        if not 4 <= min_bytes < 4096:
            raise ValueError("min_bytes must be from 4 to 4095")
        spark = docs.sparkSession
        ship_package(spark)
        self.min_bytes = min_bytes
        text = text_or_empty(text_col)
        keys = [F.xxhash64(F.col(id_col)).alias("k1"), F.xxhash64(text).alias("k2")]
        self.rows = docs.select(F.col(id_col).alias("id"), *keys, text.cast("binary").alias("text"))
        texts = self.rows.drop("id")

        anchors = _stage(_anchors(texts, min_bytes), "anchors")
        repeated = anchors.groupBy("gram").count().filter("count > 1").select("gram")
        candidates = anchors.join(repeated, "gram", "left_semi")
        # Rows with the same id and text become one text that counts as often as there are rows.
        found = F.collect_set(F.struct("gram", "at"))
        times = self.rows.groupBy("k1", "k2").agg(F.count("*").alias("times"))
        candidates = candidates.groupBy("k1", "k2").agg(found.alias("found")).join(times, ["k1", "k2"])
        self.texts = self._bucketed(texts, candidates)
        self.marked = _stage(_marked(self.texts, min_bytes), "marked")

        place = F.struct("k1", "k2", "at")
        contexts = _stage(self.marked.groupBy("gram", "m1", "m2").agg(F.sum("times").alias("n"), F.min(place).alias("first")), "contexts")
        hot = _stage(contexts.groupBy("gram").count().filter(F.col("count") > bucket).select("gram"), "hot-grams")
        self.has_hot = not hot.isEmpty()
        self.cold = self._with_text(contexts.join(hot, "gram", "left_anti") if self.has_hot else contexts)
        self.hot = self._with_text(contexts.join(hot, "gram", "left_semi"))

    def _bucketed(self, texts: DataFrame, candidates: DataFrame) -> DataFrame:
        """Texts with candidates as a stage table bucketed by its keys: later joins on them do not move the text."""
        spark = texts.sparkSession
        buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        name = f"repeats_{uuid.uuid4().hex}"
        dealt = texts.repartition(buckets, "k1", "k2").join(candidates.repartition(buckets, "k1", "k2"), ["k1", "k2"]).dropDuplicates(["k1", "k2"])
        dealt.write.bucketBy(buckets, "k1", "k2").option("path", stage_path(spark, "repeat-texts")).option("compression", "zstd").saveAsTable(name)
        table = spark.table(name)
        spark.sql(f"DROP TABLE {name}")  # an external table: the files stay
        return table

    def _with_text(self, contexts: DataFrame) -> DataFrame:
        wanted = contexts.select("first.k1", "first.k2", F.struct("gram", "m1", "m2", "n", "first.at").alias("f"))
        wanted = wanted.groupBy("k1", "k2").agg(F.collect_list("f").alias("found"))
        return self.texts.select("k1", "k2", "text").join(wanted, ["k1", "k2"]).select("text", "found")

    def reach(self) -> DataFrame:
        """(m1, m2, back, ahead): the repeated bytes around the anchor of each different context."""
        found = _reach(_contexts(self.cold, self.min_bytes), self.min_bytes)
        if self.has_hot:
            windows = _stage(_windows(self.hot, self.min_bytes), "windows")
            repeated = windows.groupBy("w1", "w2").agg(F.sum("n").alias("times")).filter("times > 1").select("w1", "w2")
            covered = windows.join(repeated, ["w1", "w2"], "left_semi").groupBy("m1", "m2")
            found = found.unionByName(covered.agg(F.max("back").alias("back"), (self.min_bytes - F.min("back")).alias("ahead")))
        return _stage(found, "reach")

    def spans(self) -> DataFrame:
        """(k1, k2, spans): disjoint sorted [start, stop) runs of repeated bytes, for texts that have some."""
        place = F.shiftright("at", 24)
        found = self.marked.select("k1", "k2", "m1", "m2", place.alias("place")).join(self.reach(), ["m1", "m2"])
        span = F.struct((F.col("place") - F.col("back")).alias("start"), (F.col("place") + F.col("ahead")).alias("stop"))
        return found.groupBy("k1", "k2").agg(F.sort_array(F.collect_list(span)).alias("spans"))

    def groups(self) -> DataFrame:
        """Maximal repeats among grams with at most ``bucket`` contexts: group (string), length, id,
        start; one row per occurrence. Repeats longer than the context of an anchor appear as the
        groups of the anchors they hold."""
        members = _groups(_contexts(self.cold, self.min_bytes), self.min_bytes)
        found = members.join(self.marked.drop("gram"), ["m1", "m2"])
        ids = self.rows.select("id", "k1", "k2")
        return found.join(ids, ["k1", "k2"]).select(
            F.concat_ws("-", "gram", "g1", "g2", "back", "ahead").alias("group"),
            (F.col("back") + F.col("ahead")).alias("length"),
            "id",
            (F.shiftright("at", 24) - F.col("back")).alias("start"),
        )


def _cut(texts: DataFrame) -> DataFrame:
    """(k1, k2, kept, n_removed, n_spans) with the repeated bytes taken out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(low, _BATCH_ROWS) for b in batches for low in range(0, b.num_rows, _BATCH_ROWS)):
            kept, removed, count = [], [], []
            for text, spans in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist(), strict=True):
                parts, at, runs, gone = [], 0, 0, 0
                end = -1
                for span in spans:
                    if span["start"] > end:
                        parts.append(text[at : span["start"]])
                        runs, end = runs + 1, span["start"]
                    if span["stop"] > end:
                        gone += span["stop"] - end
                        at = end = span["stop"]
                parts.append(text[at:])
                kept.append(b"".join(parts))
                removed.append(gone)
                count.append(runs)
            yield pa.RecordBatch.from_arrays(
                [batch.column("k1"), batch.column("k2"), pa.array(kept, pa.binary()), pa.array(removed, pa.int64()), pa.array(count, pa.int64())],
                names=["k1", "k2", "kept", "n_removed", "n_spans"],
            )

    return texts.mapInArrow(run, "k1 long, k2 long, kept binary, n_removed long, n_spans long")


def cut_repeats(docs: DataFrame, min_bytes: int = MIN_BYTES, id_col: str = "doc_id", text_col: str = "text", bucket: int = BUCKET) -> tuple[RepeatIndex, DataFrame]:
    """The index, and (k1, k2, kept, n_removed, n_spans) for every text that loses bytes."""
    index = RepeatIndex(docs, min_bytes, id_col, text_col, bucket)
    spans = _stage(index.spans(), "spans")
    return index, _cut(index.texts.select("k1", "k2", "text").join(spans, ["k1", "k2"]).select("k1", "k2", "text", "spans"))


def digest(docs: DataFrame, min_bytes: int = MIN_BYTES, id_col: str = "doc_id", text_col: str = "text", bucket: int = BUCKET) -> DataFrame:
    """One row per input row: id_col, n_bytes, n_removed, n_spans, kept_sha256."""
    index, cut = cut_repeats(docs, min_bytes, id_col, text_col, bucket)
    cut = _stage(cut.select("k1", "k2", "n_removed", "n_spans", F.sha2("kept", 256).alias("cut_sha256")), "cut")
    rows = index.rows.select("id", "k1", "k2", F.octet_length("text").cast("long").alias("n_bytes"), F.sha2("text", 256).alias("whole_sha256"))
    zero = F.lit(0).cast("long")
    return rows.join(cut, ["k1", "k2"], "left").select(
        F.col("id").alias(id_col),
        "n_bytes",
        F.coalesce("n_removed", zero).alias("n_removed"),
        F.coalesce("n_spans", zero).alias("n_spans"),
        F.coalesce("cut_sha256", "whole_sha256").alias("kept_sha256"),
    )
