"""SimHash near-duplicates by anchor points of a covering code.

A text's fingerprint has ``lanes`` times 64 bits: the majority bit over its word shingles. Equal
fingerprints are one node. Each 32-bit block of a fingerprint lives in a space covered by the
[31, 26] Hamming code and one free bit: every 32-bit word is within 1 (the covering radius) of an
anchor. Two blocks at most 2 bits apart have a word in the middle, 1 from both, and that word's
anchor is at most 2 from both; so replicating a block to every anchor within the covering radius
plus its half of the block threshold (2 in all: 17 anchors at most, 16.5 on average) brings all
such pairs together, and fingerprints are compared per anchor only.

With 64 bits and a threshold of 4 one of the two blocks differs in 2 bits at most: nothing is
missed. With more lanes and a wider threshold the search is a filter: a pair is found if one of
its blocks differs in at most 2 bits.

Anchors with more fingerprints than ``UNIT`` are compared in units, one for each pair of slices of
the anchor's fingerprints, so no task holds a whole hot anchor; all pairs are still compared. A
unit reports links that connect what it found, not all pairs.

Rows: null and empty texts have no words and fingerprint zero, and are linked like any other;
texts with fewer words than a shingle are one shingle; repeated rows share a node; a null id is
carried, and a component has a null id only if all its ids are null; an empty table gives an empty
result; further columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.graph import connected_components
from ..stages import stage
from ..workers import ship_package
from .common import kept_rows, one_of_repeats, text_or_empty

SHINGLE_WORDS = 4
THRESHOLD = 4
SEED = 42
UNIT = 2048
RADIUS = 2
_CHUNK = 255 * 256  # shingles counted at a time: memory stays bounded for very long texts


def shingle_digests(text: bytes, words: int) -> bytes:
    """Big-endian XXH64 digests of all word shingles, one after the other."""
    import xxhash

    tokens = text.lower().split()  # bytes: lower-cases A-Z only, splits at ASCII white space
    if not tokens:
        return b""
    joined = b" ".join(tokens)
    if len(tokens) <= words:
        return xxhash.xxh64_digest(joined, seed=SEED)
    ends = list(accumulate(map(len, tokens), lambda at, n: at + 1 + n))
    starts = [0] + [e + 1 for e in ends[:-words]]
    return b"".join([xxhash.xxh64_digest(joined[a:b], seed=SEED) for a, b in zip(starts, ends[words - 1 :], strict=True)])


def lane(hashes: np.ndarray, number: int) -> np.ndarray:
    """Another 64 bits of each hash: lane 0 is the hash, the others are mixed from it."""
    if number == 0:
        return hashes
    with np.errstate(over="ignore"):
        z = hashes + np.uint64(number) * np.uint64(0x9E3779B97F4A7C15)
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return z ^ (z >> np.uint64(31))


def majority(hashes: np.ndarray) -> int:
    """The 64 bits that are set in over half of the hashes."""
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), _CHUNK):
        part = hashes[at : at + _CHUNK].astype(">u8").view(np.uint8)
        bits = np.unpackbits(part).reshape(-1, 64)
        whole = len(bits) // 255 * 255
        counts += bits[:whole].reshape(-1, 255, 64).sum(axis=1, dtype=np.uint8).sum(axis=0, dtype=np.int64)
        counts += bits[whole:].sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > len(hashes)).tobytes(), "big")


def fingerprint(text: bytes, words: int, lanes: int = 1) -> list[int]:
    hashes = np.frombuffer(shingle_digests(text, words), dtype=">u8").astype(np.uint64)
    return [majority(lane(hashes, n)) for n in range(lanes)]


def fingerprints(docs: DataFrame, words: int = SHINGLE_WORDS, lanes: int = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, text_hash and f0, f1, ... (64 bits each, as signed longs) of every row."""
    ship_package(docs.sparkSession)
    source = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_or_empty(text_col)).alias("text_hash"), text_or_empty(text_col).cast("binary").alias("text"))
    names = [f"f{n}" for n in range(lanes)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [fingerprint(t, words, lanes) for t in batch.column("text").to_pylist()]
            found = np.array(rows, dtype=np.uint64).reshape(-1, lanes).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("text_hash"), *[pa.array(found[:, n]) for n in range(lanes)]], names=["id", "text_hash", *names]
            )

    fields = [source.schema["id"], source.schema["text_hash"], *[T.StructField(n, T.LongType()) for n in names]]
    return source.mapInArrow(run, T.StructType(fields))


def _masks(radius: int) -> list[np.ndarray]:
    """For each syndrome, what to flip in a 32-bit word to reach every anchor within ``radius``."""
    found: list[list[int]] = [[] for _ in range(32)]
    for size in range(radius + 1):
        for places in combinations(range(1, 32), size):
            syndrome, mask = 0, 0
            for p in places:
                syndrome ^= p
                mask |= 1 << (p - 1)
            found[syndrome].append(mask)
            if size < radius:
                found[syndrome].append(mask | 1 << 31)  # the free bit
    return [np.array(m, dtype=np.uint32) for m in found]


def _syndromes(words: np.ndarray) -> np.ndarray:
    """XOR of the places 1..31 of the set bits."""
    total = np.zeros(len(words), dtype=np.uint8)
    for j in range(5):
        check = np.uint32(sum(1 << (p - 1) for p in range(1, 32) if p >> j & 1))
        total |= (np.bitwise_count(words & check) & 1).astype(np.uint8) << np.uint8(j)
    return total


def anchors(words: np.ndarray, radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray]:
    """(row, anchor) for every anchor within ``radius`` of each 32-bit word."""
    masks, syndromes = _masks(radius), _syndromes(words)
    rows, found = [], []
    for s in range(32):
        at = np.flatnonzero(syndromes == s)
        if len(at):
            rows.append(np.repeat(at, len(masks[s])))
            found.append((words[at][:, None] ^ masks[s][None, :]).ravel())
    if not rows:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint32)
    return np.concatenate(rows), np.concatenate(found)


def _replicas(nodes: DataFrame, lanes: int, keys_only: bool) -> DataFrame:
    """A row (key, node, f...) for every anchor of every block of every node."""
    names = [f"f{n}" for n in range(lanes)]
    out = ["key"] if keys_only else ["key", "node", *names]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            node = batch.column("node").to_numpy()
            lane_values = [batch.column(n).to_numpy() for n in names]
            for block in range(2 * lanes):
                value = lane_values[block // 2].view(np.uint64)
                word = (value >> np.uint64(32) if block % 2 else value & np.uint64(0xFFFFFFFF)).astype(np.uint32)
                rows, anchor = anchors(word)
                key = (np.int64(block) << np.int64(32)) | anchor.astype(np.int64)
                columns = [key] if keys_only else [key, node[rows], *[v[rows] for v in lane_values]]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=out)

    return nodes.select("node", *names).mapInArrow(run, T.StructType([T.StructField(n, T.LongType()) for n in out]))


def _links_of_unit(node: np.ndarray, values: np.ndarray, threshold: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Links that connect all nodes of a unit within the threshold: from each reached node to the new ones."""
    left, found = np.arange(len(node)), []
    while len(left) > 1:
        frontier, left = [left[0]], left[1:]
        while frontier and len(left):
            here = frontier.pop()
            near = np.bitwise_count(values[left] ^ values[here]).sum(axis=1, dtype=np.int64) <= threshold
            if near.any():
                hit = left[near]
                found.append((np.full(len(hit), node[here]), node[hit]))
                frontier.extend(hit.tolist())
                left = left[~near]
    return found


def _compare(batches: Iterator[pa.RecordBatch], lanes: int, threshold: int) -> Iterator[pa.RecordBatch]:
    """Links of each unit; rows come sorted by unit, and a unit may go over batch borders."""
    held: list[np.ndarray] = []

    def links(table: np.ndarray) -> pa.RecordBatch | None:
        key = table[:, :3]
        edges = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]).any(axis=1)])
        sizes = np.diff(np.r_[edges, len(table)])
        values = table[:, 4:].view(np.uint64)
        found = []
        small = np.repeat(sizes <= 8, sizes)
        for shift in range(1, 8):
            if len(table) <= shift:
                break
            at = np.flatnonzero((key[shift:] == key[:-shift]).all(axis=1) & small[shift:])
            near = at[np.bitwise_count(values[at] ^ values[at + shift]).sum(axis=1, dtype=np.int64) <= threshold]
            found.append((table[near, 3], table[near + shift, 3]))
        for start, size in zip(edges[sizes > 8], sizes[sizes > 8], strict=True):
            found += _links_of_unit(table[start : start + size, 3], values[start : start + size], threshold)
        if not found:
            return None
        u, v = (np.concatenate([f[k] for f in found]) for k in (0, 1))
        return pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=["u", "v"])

    for batch in batches:
        table = np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns])
        if not len(table):
            continue
        whole = np.concatenate([*held, table]) if held else table
        last = whole[-1, :3]
        cut = len(whole) - int((whole[:, :3] == last).all(axis=1)[::-1].argmin() or len(whole))
        held = [whole[cut:]]
        if cut and (out := links(whole[:cut])) is not None:
            yield out
    if held and (out := links(held[0])) is not None:
        yield out


def near_links(nodes: DataFrame, lanes: int, threshold: int, unit: int = UNIT) -> DataFrame:
    """Distinct links (u, v) that connect all nodes found within the threshold of each other."""
    ship_package(nodes.sparkSession)
    names = [f"f{n}" for n in range(lanes)]
    replicas = _replicas(nodes, lanes, keys_only=False)
    counts = _replicas(nodes, lanes, keys_only=True).groupBy("key").count()
    hot = stage(counts.filter(F.col("count") > unit).select("key", F.ceil(F.col("count") / unit).cast("long").alias("slices")), "hot-anchors")
    zero = F.lit(0).cast("long")
    if hot.isEmpty():
        units = replicas.select("key", zero.alias("i"), zero.alias("j"), "node", *names)
    else:
        sliced = replicas.join(hot, "key", "left").withColumn("slices", F.coalesce("slices", F.lit(1).cast("long")))
        sliced = sliced.withColumn("own", F.pmod(F.xxhash64("node"), F.col("slices")))
        other = F.explode(F.sequence(zero, F.col("slices") - 1))
        units = sliced.select("key", "own", other.alias("other"), "node", *names)
        units = units.select("key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "node", *names)
    dealt = units.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
    links = dealt.mapInArrow(lambda batches: _compare(batches, lanes, threshold), "u long, v long")
    return links.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct()


def components(
    docs: DataFrame, words: int = SHINGLE_WORDS, lanes: int = 1, threshold: int = THRESHOLD, id_col: str = "doc_id", text_col: str = "text", unit: int = UNIT
) -> DataFrame:
    """One row per input row: id, text_hash, f0.., node and component_id, the smallest id reachable over links."""
    names = [f"f{n}" for n in range(lanes)]
    rows = stage(fingerprints(docs, words, lanes, id_col, text_col), "fingerprints")
    nodes = rows.groupBy(*names).agg(F.min("id").alias("first_id"))
    nodes = stage(nodes.withColumn("node", F.monotonically_increasing_id()), "nodes")
    links = stage(near_links(nodes, lanes, threshold, unit), "links")
    reached = connected_components(nodes, links).withColumnRenamed("node", "r_node")
    named = stage(nodes.join(reached, nodes["node"] == reached["r_node"]).drop("r_node"), "reached")
    smallest = named.groupBy("component").agg(F.min("first_id").alias("component_id"))
    return rows.join(named.join(smallest, "component").select(*names, "node", "component", "component_id"), names)


def one_of_each(docs: DataFrame, words: int = SHINGLE_WORDS, threshold: int = THRESHOLD, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with one row of each component, that of the smallest id, all its columns as they are.

    Of several texts under this id the one with the smallest hash stays; a component without ids keeps one row.
    """
    found = components(docs, words, 1, threshold, id_col, text_col, **options).select("id", "text_hash", "component", "component_id")
    rows = stage(found, "decided")
    keep = rows.filter(F.col("id").eqNullSafe(F.col("component_id"))).groupBy("component").agg(F.min("id").alias("id"), F.min("text_hash").alias("text_hash"))
    keys = {"id": F.col(id_col), "text_hash": F.xxhash64(text_or_empty(text_col))}
    repeated = not rows.groupBy(*keys).count().filter("count > 1").isEmpty()
    return one_of_repeats(kept_rows(docs, keep, keys), list(keys), repeated)
