"""Importance resampling towards a target distribution by bit-sliced aggregation.

A text is the bag of its runs of 1 to 3 words, hashed into 10,000 buckets. A bucket's gain is the log
ratio of its share in the target texts to its share in all documents, in thousandths; a document's
weight is the sum of the gains of its features. Gumbel noise fixed by the id is added, and the highest
scores are a sample without replacement by weight.

Bit-sliced: the bucket counts of a document are bit planes, plane i holding bit i of all 10,000 counts.
The gains are signed bit planes too, one set for positive and one for negative gains. A weight is then

    sum over i, j of 2^(i + j) * (popcount(C_i & P_j) - popcount(C_i & N_j))

so no feature is looked up a second time: the planes are written once, and everything that needs the
corpus-wide gains reads planes and not texts. The pass that writes them also adds up the counts of its
rows, a row of 10,000 sums a task; what reaches the driver are the 10,000 gains, whatever the corpus.

CRC-32 is linear, so hashes are not computed feature by feature: every byte adds its share to the
remainder of its word, and runs of words are put together from the remainders.

Ranks come from a range partitioning by score with offsets, not from a single sorted task.

Rows: null text has no words; a null id counts as empty text in the draw and comes after all ids in
ties; rows without features have weight 0 and, with fewer than ``min_words`` words, are never drawn;
repeated rows get equal scores and a rank each; very long texts are read in pieces whose features go
over the borders; an empty table gives an empty result; further columns are not read by ``weigh`` and
are carried whole by ``resample``.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..stages import stage
from ..workers import ship_package
from .common import kept_rows, one_of_repeats, text_or_empty

BUCKETS = 10_000
SIZES = 3
MIN_WORDS = 20
PERCENT = 5
SEED = 42
#: Bytes and texts that are hashed together; bounds a task's memory.
PIECE_BYTES, PIECE_TEXTS = 1 << 21, 2048
_PLANE = (BUCKETS + 63) // 64  # 64-bit words of a plane
_SHORT = 255  # words up to this many bytes are hashed by the tables

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IN_WORD = np.zeros(256, dtype=bool)
_IN_WORD[[*range(48, 58), *range(97, 123), *range(128, 256)]] = True


def _crc_tables() -> tuple[np.ndarray, np.ndarray]:
    """shifted[3 + m][b]: remainder of byte value b moved on by m zero bytes, m from -3; zeros[n]: CRC-32 of n zero bytes."""
    step = np.array([zlib.crc32(bytes([b])) ^ zlib.crc32(b"\0") for b in range(256)], dtype=np.uint32)
    rows = [np.arange(256, dtype=np.uint32) << np.uint32(8 * k) for k in (3, 2, 1, 0)]
    for _ in range(_SHORT):
        rows.append(step[rows[-1] & 255] ^ (rows[-1] >> np.uint32(8)))
    return np.array(rows), np.array([zlib.crc32(bytes(n)) for n in range(SIZES * (_SHORT + 1))], dtype=np.uint32)


_SHIFTED, _ZEROS = _crc_tables()


def _moved(remainder: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Remainders after ``count`` more zero bytes each."""
    found = _SHIFTED[count + 3, remainder & 255]
    for k in (1, 2, 3):
        found ^= _SHIFTED[count + (3 - k), remainder >> np.uint32(8 * k) & np.uint32(255)]
    return found


def run_hashes(data: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """(starts, hashes): where words begin, and for n = 1, 2, 3 the CRC-32 of every run of n words, in order, joined by spaces.

    Runs go over any gap between words: callers leave out those that go from text to text.
    """
    low = _LOWER[data]
    edges = np.flatnonzero(np.diff(np.concatenate([[0], _IN_WORD[low].view(np.int8), [0]])))
    starts, ends = edges[::2], edges[1::2]
    sizes = ends - starts
    if not len(starts):
        return starts, [np.zeros(0, dtype=np.uint32)] * SIZES
    inside = np.flatnonzero(_IN_WORD[low])
    left = np.repeat(ends, sizes) - inside  # bytes of the word from here on
    short = np.minimum(sizes, _SHORT)
    words = np.bitwise_xor.reduceat(_SHIFTED[np.minimum(left, _SHORT) + 3, low[inside]], np.concatenate([[0], np.cumsum(sizes)[:-1]]))
    rest, length, hashes = words, short, [words ^ _ZEROS[short]]
    for n in range(1, SIZES):
        rest = _SHIFTED[4, (rest[:-1] ^ np.uint32(32)) & 255] ^ (rest[:-1] >> np.uint32(8))
        rest = _moved(rest, short[n:]) ^ words[n:]
        length = length[:-1] + 1 + short[n:]
        hashes.append(rest ^ _ZEROS[length])
    for i in np.flatnonzero(sizes > _SHORT).tolist():  # long words: their runs are hashed directly
        for n in range(1, SIZES + 1):
            for first in range(max(0, i - n + 1), min(i, len(starts) - n) + 1):
                run = b" ".join(low[starts[k] : ends[k]].tobytes() for k in range(first, first + n))
                hashes[n - 1][first] = zlib.crc32(run)
    return starts, hashes


def _long_text(text: bytes) -> tuple[int, np.ndarray]:
    """(words, counts by bucket) of one long text, piece by piece; a piece starts with the last words of the one before."""
    data, at, known, counts, words = np.frombuffer(text, dtype=np.uint8), 0, 0, np.zeros(BUCKETS, dtype=np.int64), 0
    while at < len(data):
        end = min(len(data), at + PIECE_BYTES)
        while end < len(data) and _IN_WORD[_LOWER[data[end]]]:
            end += 1  # never cut a word
        starts, hashes = run_hashes(data[at:end])
        words += len(starts) - known
        for n, found in enumerate(hashes, 1):
            counts += np.bincount(found[max(0, known - n + 1) :] % BUCKETS, minlength=BUCKETS)
        if end == len(data):
            break
        carried = min(SIZES - 1, len(starts))
        at, known = (at + int(starts[-carried]), carried) if carried else (end, 0)
        if end - at >= PIECE_BYTES:  # the carried words alone fill a piece: take the rest in one go
            starts, hashes = run_hashes(data[at:])
            words += len(starts) - known
            for n, found in enumerate(hashes, 1):
                counts += np.bincount(found[max(0, known - n + 1) :] % BUCKETS, minlength=BUCKETS)
            break
    return words, counts


def _piece(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(words of each text; text, bucket and count of every bucket in use), ordered by text."""
    begin = np.cumsum([0, *[len(t) + 1 for t in texts]])
    starts, hashes = run_hashes(np.frombuffer(b"\0".join(texts) + b"\0", dtype=np.uint8))
    text = np.searchsorted(begin, starts, side="right") - 1
    keys = [text * BUCKETS + hashes[0] % BUCKETS]
    for n in range(1, SIZES):
        whole = text[n:] == text[: len(text) - n]
        keys.append((text[: len(text) - n] * BUCKETS + hashes[n] % BUCKETS)[whole])
    used, counts = np.unique(np.concatenate(keys), return_counts=True)
    return np.bincount(text, minlength=len(texts)), used // BUCKETS, used % BUCKETS, counts


def pieces(texts: list[bytes]) -> Iterator[tuple[int, int, tuple]]:
    """(first, end, counts as of ``_piece``) of runs of texts of bounded size; a long text is on its own."""
    first, size = 0, 0
    for i in range(len(texts) + 1):
        if i == len(texts) or i - first >= PIECE_TEXTS or size + len(texts[i]) > PIECE_BYTES:
            if i > first:
                yield first, i, _piece(texts[first:i])
            first, size = i, 0
            if i < len(texts) and len(texts[i]) > PIECE_BYTES:
                words, counts = _long_text(texts[i])
                used = np.flatnonzero(counts)
                yield i, i + 1, (np.array([words]), np.zeros(len(used), dtype=np.int64), used, counts[used])
                first = i + 1
                continue
        if i < len(texts):
            size += len(texts[i])


def count_planes(rows: int, row: np.ndarray, bucket: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(planes of each row, all planes one after the other): plane i of a row has the bits i of its counts."""
    most = np.zeros(rows, dtype=np.int64)
    np.maximum.at(most, row, count)
    each = np.ceil(np.log2(most + 1)).astype(np.int64)
    first = np.cumsum(each) - each
    planes = np.zeros((int(each.sum()), _PLANE), dtype=np.uint64)
    for i in range(int(each.max(initial=0))):
        on = np.flatnonzero(count >> i & 1)
        np.bitwise_or.at(planes, (first[row[on]] + i, bucket[on] >> 6), np.uint64(1) << (bucket[on] & 63).astype(np.uint64))
    return each, planes


def gain_planes(gains: np.ndarray) -> list[tuple[int, np.ndarray]]:
    """(signed power of two, plane) for every bit of the positive and of the negative gains."""
    found = []
    for sign in (1, -1):
        size = np.maximum(sign * gains, 0)
        for j in range(int(size.max(initial=0)).bit_length()):
            bits = np.zeros(_PLANE * 64, dtype=np.uint8)
            bits[: len(gains)] = size >> j & 1
            found.append((sign << j, np.packbits(bits, bitorder="little").view("<u8").astype(np.uint64)))
    return found


def plane_weights(each: np.ndarray, planes: np.ndarray, gains: list[tuple[int, np.ndarray]]) -> np.ndarray:
    """The weight of every row from its planes: counted bits of each AND, times powers of two."""
    of = np.repeat(np.arange(len(each)), each)
    power = np.arange(len(planes)) - np.repeat(np.cumsum(each) - each, each)
    sums = np.zeros(len(planes), dtype=np.int64)
    for value, plane in gains:
        sums += value * np.bitwise_count(planes & plane).sum(axis=1, dtype=np.int64)
    weights = np.zeros(len(each), dtype=np.int64)
    np.add.at(weights, of, sums << power)
    return weights


_ROW = [("n_words", T.LongType()), ("n_features", T.LongType()), ("planes", T.BinaryType()), ("totals", T.BinaryType())]


def count_table(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Stage table of id, text_hash, n_words, n_features and planes of every row, with rows of ``totals`` (a task's sums) between them."""
    ship_package(docs.sparkSession)
    text = text_or_empty(text_col)
    source = docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("text_hash"), text.cast("binary").alias("text"))
    schema = T.StructType([T.StructField("id", source.schema["id"].dataType), T.StructField("text_hash", T.LongType()), *[T.StructField(n, t) for n, t in _ROW]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals, kind = np.zeros(BUCKETS, dtype=np.int64), None
        for batch in batches:
            kind = batch.schema.field(0).type
            texts = batch.column(2).to_pylist()
            for a, b, (words, row, bucket, count) in pieces(texts):
                np.add.at(totals, bucket, count)
                each, planes = count_planes(b - a, row, bucket, count)
                ends = np.concatenate([[0], np.cumsum(each)]) * _PLANE * 8
                packed = pa.Array.from_buffers(pa.binary(), b - a, [None, pa.py_buffer(ends.astype(np.int32).tobytes()), pa.py_buffer(planes.tobytes())])
                features = np.bincount(row, weights=count, minlength=b - a).astype(np.int64)
                part = [batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a), pa.array(words.astype(np.int64)), pa.array(features), packed]
                yield pa.RecordBatch.from_arrays([*part, pa.nulls(b - a, pa.binary())], names=schema.names)
        if kind is not None:
            empty = [pa.nulls(1, kind), *[pa.nulls(1, pa.int64())] * 3, pa.nulls(1, pa.binary())]
            yield pa.RecordBatch.from_arrays([*empty, pa.array([totals.tobytes()], pa.binary())], names=schema.names)

    return stage(source.mapInArrow(run, schema), "planes")


def bucket_totals(counted: DataFrame) -> DataFrame:
    """(bucket, n): features of all rows of a ``count_table`` by bucket, from its tasks' sums."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros(BUCKETS, dtype=np.int64)
        for batch in batches:
            for part in batch.column(0).to_pylist():
                found += np.frombuffer(part, dtype=np.int64)
        used = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(found[used])], names=["bucket", "n"])

    sums = counted.filter(F.col("totals").isNotNull()).select("totals")
    return sums.mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(raw: DataFrame, target: DataFrame) -> DataFrame:
    """(bucket, gain) of all buckets, from ``bucket_totals`` of the documents and of the target."""
    spark = raw.sparkSession
    both = raw.select("bucket", F.col("n").alias("s"), F.lit(0).cast("long").alias("t")).unionAll(target.select("bucket", F.lit(0).cast("long"), "n"))
    both = both.unionAll(spark.range(BUCKETS).select("id", F.lit(0).cast("long"), F.lit(0).cast("long")))
    counts = stage(both.groupBy("bucket").agg(F.sum("s").cast("double").alias("s"), F.sum("t").cast("double").alias("t")), "bucket-counts")
    whole = counts.agg((F.sum("s") + BUCKETS).alias("s"), (F.sum("t") + BUCKETS).alias("t")).first()
    ratio = (F.col("t") + 1) * F.lit(whole["s"]) / ((F.col("s") + 1) * F.lit(whole["t"]))
    return counts.select("bucket", F.floor(1000 * F.log(ratio)).cast("long").alias("gain"))


def weigh(
    docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_col: str = "text", percent: int = PERCENT, min_words: int = MIN_WORDS, seed: int = SEED
) -> DataFrame:
    """One row per input row: id, text_hash, n_words, n_features, weight, score, rank (null where not drawn).

    ``percent`` of the rows with at least ``min_words`` words are drawn, rounded down.
    """
    counted = count_table(docs, id_col, text_col)
    aimed = count_table(target.select(F.lit(0).alias("id"), F.col(target_col).alias("text")), "id", "text")
    gains = np.zeros(BUCKETS, dtype=np.int64)
    for row in bucket_gains(bucket_totals(counted), bucket_totals(aimed)).collect():  # one row a bucket
        gains[row["bucket"]] = row["gain"]
    rows = counted.filter(F.col("totals").isNull()).drop("totals")
    schema = T.StructType([rows.schema[c] for c in ("id", "text_hash", "n_words", "n_features")]).add("weight", "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        signed = gain_planes(gains)
        for whole in batches:
            for at in range(0, whole.num_rows, PIECE_TEXTS):
                batch = whole.slice(at, PIECE_TEXTS)
                packed = [p or b"" for p in batch.column(4).to_pylist()]
                each = np.array([len(p) // (_PLANE * 8) for p in packed], dtype=np.int64)
                planes = np.frombuffer(b"".join(packed), dtype="<u8").reshape(-1, _PLANE)
                yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(plane_weights(each, planes, signed))], names=schema.names)

    weighed = rows.mapInArrow(run, schema)
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit("")))
    share = (F.conv(F.substring(F.sha2(name.cast("binary"), 256), 1, 8), 16, 10).cast("double") + 0.5) / F.lit(4294967296.0)
    noise = F.floor(F.lit(-1000.0) * F.log(-F.log(share))).cast("long")
    weighed = stage(weighed.withColumn("score", F.col("weight") + noise), "weighed")

    enough = F.col("n_words") >= min_words
    drawn = percent * weighed.filter(enough).count() // 100
    order = [F.col("score").desc(), F.col("id").asc_nulls_last(), F.col("text_hash")]
    # The number of a row in its range partition, and of the rows in the partitions before.
    placed = weighed.filter(enough).repartitionByRange(*order).sortWithinPartitions(*order).withColumn("place", F.monotonically_increasing_id())
    placed = stage(placed.withColumns({"part": F.shiftright("place", 33), "place": F.col("place").bitwiseAND((1 << 33) - 1)}), "placed")
    before = F.sum("n").over(Window.orderBy("part")) - F.col("n")  # one row a partition
    offsets = placed.groupBy("part").agg(F.count("*").alias("n")).select("part", before.alias("before"))
    rank = F.col("before") + F.col("place") + 1
    ranked = placed.join(offsets, "part").select(*weighed.columns, F.when(rank <= drawn, rank).alias("rank"))
    return ranked.unionAll(weighed.filter(~enough).withColumn("rank", F.lit(None).cast("long"))).withColumnRenamed("id", id_col)


def resample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The drawn rows of ``docs``, all their columns as they are; repeated rows are drawn once."""
    drawn = weigh(docs, target, id_col, text_col, **options).filter(F.col("rank").isNotNull())
    drawn = stage(drawn.select(F.col(id_col).alias("id"), "text_hash").distinct(), "drawn")
    keys = {"id": F.col(id_col), "text_hash": F.xxhash64(text_or_empty(text_col))}
    return one_of_repeats(kept_rows(docs, drawn, keys), list(keys), True)
