r"""Conversation prefix trie with subtree totals by time-forward processing.

Conversations that begin with the same turns share nodes: a node is a distinct sequence of first turns,
named by a chained SHA-256 digest. Every node of a conversation is a row; rows of one node are combined
on the map side, so a first turn that a third of the conversations share travels once a task.

Totals over subtrees go up by time-forward processing. The trie is cut into shards: a subtree is a shard
if at most a fixed number of rows can lie in it and its parent's subtree has more. Within a shard the
nodes come sorted by reverse level order (deepest first); a node takes its children's totals from a
priority queue ordered like the nodes, adds its own and sends the sum forward to its parent's place in
the order. The queue holds a bounded number of messages and spills sorted runs to the task's own scratch
files, which no other task reads. The shard roots' totals are then added up by parent, and the same
procedure runs over the few nodes above the shards.

The bound on a shard grows with the table, so that nodes above the shards stay below ``MOST_TOP`` for
each level; a path of any depth is a stream.

The digest of a node's final members reads their ids in order: ids are sorted over range partitions and
joined into pieces there, so a node at which a third of the conversations end is read in pieces, not rows.

Rows: turns are ordered by ``turn`` (null first), then role and text, so ties and repeated rows have one
order; null role or text is empty; rows without conv_id name no conversation and are left out; very long
texts are read once, for their digest and their number of words; one conversation's turns pass through
one task as a stream of rows, however many there are; an empty table gives an empty result; further
columns are not read.
"""

from __future__ import annotations

import hashlib
import heapq
import pickle
import tempfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..stages import stage
from ..workers import ship_package
from .common import text_or_empty
from .mixing import token_count

GROUP = 20
ROOT = bytes(16)
#: Rows below a shard's root at most, unless the table is so large that there would be more than MOST_TOP nodes of a level above.
SHARD_ROWS, MOST_TOP = 1_000, 2_000
#: Messages that a queue holds before it spills.
QUEUE = 100_000
_PIECE_IDS = 2_000


class SpillingQueue:
    """A priority queue of (key, totals) that keeps ``most`` entries in memory and the rest in sorted runs on disk."""

    def __init__(self, most: int = QUEUE, most_runs: int = 32):
        self.most, self.most_runs = most, most_runs
        self.heap: list[tuple] = []
        self.runs: list[tuple] = []  # (first entry, number, rest of the run)
        self.spilled = 0

    def push(self, key: tuple, totals: tuple) -> None:
        heapq.heappush(self.heap, (key, totals))
        if len(self.heap) > self.most:
            self._spill(iter(sorted(self.heap)))
            self.heap = []

    def _spill(self, entries: Iterator[tuple]) -> None:
        if len(self.runs) >= self.most_runs:
            entries = heapq.merge(entries, *[_chain(first, rest) for first, _, rest in self.runs])
            self.runs = []
        rest = _written(entries)
        if (first := next(rest, None)) is not None:
            self.spilled += 1
            heapq.heappush(self.runs, (first, self.spilled, rest))

    def _least(self) -> tuple | None:
        ends = [e for e in (self.heap[0] if self.heap else None, self.runs[0][0] if self.runs else None) if e is not None]
        return min(ends) if ends else None

    def take(self, key: tuple) -> list[tuple]:
        """All totals sent to ``key``, which must be the least key there is, if it is there."""
        found = []
        while (least := self._least()) is not None and least[0] == key:
            found.append(least[1])
            if self.heap and self.heap[0] == least:
                heapq.heappop(self.heap)
            else:
                first, number, rest = self.runs[0]
                following = next(rest, None)
                if following is None:
                    heapq.heappop(self.runs)
                else:
                    heapq.heapreplace(self.runs, (following, number, rest))
        return found

    def __len__(self) -> int:
        return len(self.heap) + len(self.runs)


def _chain(first: tuple, rest: Iterator[tuple]) -> Iterator[tuple]:
    yield first
    yield from rest


def _written(entries: Iterator[tuple], block: int = 1024) -> Iterator[tuple]:
    """Write sorted entries to a nameless scratch file at once; returns what reads them back block by block."""
    file, held = tempfile.TemporaryFile(prefix="vitrine-run-"), []
    for entry in entries:
        held.append(entry)
        if len(held) == block:
            pickle.dump(held, file, protocol=5)
            held = []
    if held:
        pickle.dump(held, file, protocol=5)
    file.seek(0)

    def read() -> Iterator[tuple]:
        with file:
            while True:
                try:
                    yield from pickle.load(file)
                except EOFError:
                    return

    return read()


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """conv_id, at (0, 1, ...), role and text of every turn, in order."""
    rows = conversations.filter(F.col("conv_id").isNotNull())
    rows = rows.select(F.col("conv_id").cast("long").alias("conv_id"), "turn", text_or_empty("role").alias("role"), text_or_empty("text").alias("text"))
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    return rows.withColumn("at", F.row_number().over(order) - 1).select("conv_id", "at", "role", "text")


def shared_turns(conv_id: Column) -> Column:
    """How many first turns a conversation takes from the first of its group: unsigned CRC-32 of the decimal id, modulo 4."""
    return (F.crc32(conv_id.cast("string").cast("binary")) % 4).cast("int")


def rebuilt(turns: DataFrame, group: int = GROUP) -> DataFrame:
    """``turns`` of conversations that begin with the first turns of the first conversation of their group of ids."""
    base = F.col("conv_id") - F.col("conv_id") % group
    own = turns.filter(F.col("at") >= shared_turns(F.col("conv_id")))
    heads = turns.filter((F.col("conv_id") % group == 0) & (F.col("at") < 3)).withColumnRenamed("conv_id", "base")
    takers = turns.select("conv_id").distinct().select("conv_id", base.alias("base"), shared_turns(F.col("conv_id")).alias("taken")).filter("taken > 0")
    taken = takers.join(heads, "base").filter("at < taken").select("conv_id", "at", "role", "text")
    return own.unionByName(taken)


def node_rows(turns: DataFrame) -> DataFrame:
    """Stage table (conv_id, depth, length, node, parent, n_words): every conversation's nodes, named by a chained digest."""
    ship_package(turns.sparkSession)
    counted = turns.withColumn("length", F.count("*").over(Window.partitionBy("conv_id")).cast("int")).withColumn("n_words", token_count(F.col("text")))
    sorted_rows = counted.select("conv_id", "at", "length", "n_words", "role", "text").sortWithinPartitions("conv_id", "at")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, depth, name = None, 0, ROOT
        for batch in batches:
            depths, nodes, parents = [], [], []
            for conv, role, text in zip(*[batch.column(c).to_pylist() for c in ("conv_id", "role", "text")], strict=True):
                if conv != last:
                    last, depth, name = conv, 0, ROOT
                parents.append(name)
                said = role.encode()
                name = hashlib.sha256(name + len(said).to_bytes(8, "big") + said + text.encode()).digest()[:16]
                depth += 1
                depths.append(depth)
                nodes.append(name)
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv_id"), pa.array(depths, pa.int32()), batch.column("length"), pa.array(nodes, pa.binary()), pa.array(parents, pa.binary()), batch.column("n_words")],
                names=["conv_id", "depth", "length", "node", "parent", "n_words"],
            )

    return stage(sorted_rows.mapInArrow(run, "conv_id long, depth int, length int, node binary, parent binary, n_words long"), "path-nodes")


def forward(batches: Iterator[pa.RecordBatch], queue: int = QUEUE) -> Iterator[pa.RecordBatch]:
    """Subtree totals of nodes that come sorted by shard, depth (deepest first) and name.

    Columns: shard, depth, node, parent, saved (the node's own), and the totals n_children, n_leaves, below_saved
    of children that are not among the rows. Gives node, parent, n_children, n_leaves and saved of the subtree.
    """
    shard, messages = None, SpillingQueue(queue)
    for batch in batches:
        out: list[tuple] = []
        for of, depth, node, parent, saved, children, leaves, below in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            if of != shard:
                shard, messages = of, SpillingQueue(queue)
            total = saved + below
            for more_leaves, more_saved in messages.take((-depth, node)):
                children += 1
                leaves += more_leaves
                total += more_saved
            leaves = leaves or 1
            out.append((node, parent, children, leaves, total))
            messages.push((1 - depth, parent), (leaves, total))
        kinds = [pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
        columns = [pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)] if out else [pa.array([], k) for k in kinds]
        yield pa.RecordBatch.from_arrays(columns, names=["node", "parent", "n_children", "n_leaves", "saved_tokens"])


_TOTALS = "node binary, parent binary, n_children long, n_leaves long, saved_tokens long"


def subtree_totals(rows: DataFrame, nodes: DataFrame, shard_rows: int = SHARD_ROWS, queue: int = QUEUE) -> DataFrame:
    """(node, n_children, n_leaves, saved_tokens) of every node below the root, and of the root if there are any.

    ``nodes`` has node, parent, depth, conv_id (a member), n_convs, n_words, and ``bound``, the rows in the node's subtree.
    """
    zero = F.lit(0).cast("long")
    limit = max(shard_rows, -(-rows.count() // MOST_TOP))
    own = (F.col("n_convs") - 1) * F.col("n_words")
    top = stage(nodes.filter(F.col("bound") > limit), "top-nodes")
    # The shard of a node is the first node below the top ones on the path of one of its conversations.
    reach = rows.join(top.select("node"), "node").groupBy("conv_id").agg(F.max("depth").alias("top_depth"))
    roots = rows.join(reach, "conv_id", "left").filter(F.col("depth") == F.coalesce("top_depth", F.lit(0)) + 1).select("conv_id", F.col("node").alias("shard"))
    inner = nodes.filter(F.col("bound") <= limit).join(stage(roots, "shard-roots"), "conv_id")
    inner = inner.select("shard", "depth", "node", "parent", own.alias("saved"), zero.alias("n_children"), zero.alias("n_leaves"), zero.alias("below"))
    inner = inner.repartition("shard").sortWithinPartitions("shard", F.col("depth").desc(), "node")
    shards = stage(inner.mapInArrow(lambda b: forward(b, queue), _TOTALS), "shard-totals")

    # Across shard roots: their totals are added up by parent; the nodes above them are one more shard.
    sent = shards.join(top.select(F.col("node").alias("parent")).unionAll(rows.sparkSession.createDataFrame([(ROOT,)], "parent binary")), "parent")
    sent = sent.groupBy("parent").agg(F.count("*").alias("n_children"), F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("below"))
    above = top.select("depth", "node", "parent", own.alias("saved"))
    root = rows.limit(1).select(F.lit(0).alias("depth"), F.lit(ROOT).alias("node"), F.lit(b"").alias("parent"), zero.alias("saved"))
    above = above.unionAll(root).join(sent.withColumnRenamed("parent", "node"), "node", "left")
    above = above.select(F.lit(b"").alias("shard"), "depth", "node", "parent", "saved", *[F.coalesce(c, zero).alias(c) for c in ("n_children", "n_leaves", "below")])
    above = above.repartition(1).sortWithinPartitions(F.col("depth").desc(), "node")
    return shards.unionAll(above.mapInArrow(lambda b: forward(b, queue), _TOTALS)).drop("parent")


def id_digests(ends: DataFrame, piece: int = _PIECE_IDS) -> DataFrame:
    """(node, ends_sha256) of (node, conv_id): SHA-256 of the ids in order, joined by commas."""
    spread = ends.repartitionByRange("node", "conv_id").sortWithinPartitions("node", "conv_id")

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, ids = None, []

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([node], pa.binary()), pa.array([ids[0]], pa.int64()), pa.array([",".join(map(str, ids))])], names=["node", "first", "ids"])

        for batch in batches:
            for of, conv in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if ids and (of != node or len(ids) >= piece):
                    yield out()
                    ids = []
                node = of
                ids.append(conv)
        if ids:
            yield out()

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state = None, None

        def out(found: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([n for n, _ in found], pa.binary()), pa.array([s for _, s in found], pa.string())], names=["node", "ends_sha256"])

        for batch in batches:
            found = []
            for of, ids in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True):
                if of == node:
                    state.update(b"," + ids.encode())
                    continue
                if state is not None:
                    found.append((node, state.hexdigest()))
                node, state = of, hashlib.sha256(ids.encode())
            yield out(found)
        if state is not None:
            yield out([(node, state.hexdigest())])

    pieces = stage(spread.select("node", "conv_id").mapInArrow(join, "node binary, first long, ids string"), "id-pieces")
    dealt = pieces.repartition("node").sortWithinPartitions("node", "first")
    return dealt.select("node", "first", "ids").mapInArrow(digest, "node binary, ends_sha256 string")


def trie(conversations: DataFrame, group: int = GROUP, shard_rows: int = SHARD_ROWS, queue: int = QUEUE) -> DataFrame:
    """One row per node of the rebuilt conversations' trie: conv_id (the smallest member), depth, parent_conv_id, n_convs,
    n_children, n_leaves, saved_tokens, ends_sha256."""
    turns = ordered_turns(conversations)
    rows = node_rows(rebuilt(turns, group))
    convs = stage(conversations.filter(F.col("conv_id").isNotNull()).select(F.col("conv_id").cast("long").alias("conv_id")).distinct(), "conversations")
    nodes = rows.groupBy("node").agg(
        F.min("parent").alias("parent"),
        F.min("depth").alias("depth"),
        F.min("conv_id").alias("conv_id"),
        F.count("*").alias("n_convs"),
        F.max("n_words").alias("n_words"),
        F.sum(F.col("length") - F.col("depth") + 1).alias("bound"),
    )
    nodes = stage(nodes, "nodes")
    root = convs.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs")).filter("n_convs > 0")
    root = stage(root.select(F.lit(ROOT).alias("node"), F.lit(None).cast("binary").alias("parent"), F.lit(0).alias("depth"), "conv_id", "n_convs"), "root")
    every = nodes.select("node", "parent", "depth", "conv_id", "n_convs").unionAll(root)

    # A conversation without turns ends at the root.
    turnless = convs.join(rows.filter("depth = 1").select("conv_id"), "conv_id", "left_anti").select(F.lit(ROOT).alias("node"), "conv_id")
    ends = id_digests(rows.filter("depth = length").select("node", "conv_id").unionAll(turnless))
    totals = subtree_totals(rows, nodes, shard_rows, queue)
    # Children of one node may be many: their parents' ids are a stage table, which is sent around or else split with hot keys.
    parents = stage(nodes.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id")).unionAll(root.select("node", "conv_id")), "parents")
    found = every.join(totals, "node", "left").join(ends, "node", "left").join(parents, "parent", "left")
    return found.select(
        "conv_id",
        F.col("depth").cast("long").alias("depth"),
        "parent_conv_id",
        "n_convs",
        F.coalesce("n_children", F.lit(0).cast("long")).alias("n_children"),
        F.coalesce("n_leaves", F.lit(1).cast("long")).alias("n_leaves"),
        F.coalesce("saved_tokens", F.lit(0).cast("long")).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"),
    )


def oracle(group: int = GROUP) -> str:
    """DuckDB SQL for the query's rows. Paths are whole lists of turns; CRC-32 is worked out byte by byte."""
    return rf"""
        WITH crc AS (SELECT list_transform(range(256), lambda n: list_reduce(list_prepend(n, range(8)), lambda a, k: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END)) AS tab),
        t AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
                row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) - 1 AS pos FROM conversations WHERE conv_id IS NOT NULL),
        c AS (SELECT conv_id, conv_id - conv_id % {group} AS base, xor(list_reduce(list_prepend(4294967295, list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
                lambda a, b: xor(a >> 8, tab[(xor(a, b) & 255) + 1])), 4294967295) % 4 AS h FROM (SELECT DISTINCT conv_id FROM t), crc),
        r AS (SELECT conv_id, pos, role, text FROM t JOIN c USING (conv_id) WHERE pos >= h
                UNION ALL SELECT c.conv_id, pos, role, text FROM c JOIN t ON t.conv_id = c.base WHERE pos < h),
        p AS MATERIALIZED (SELECT conv_id, row_number() OVER w AS d, list(md5(role) || md5(text)) OVER w AS path, text, count(*) OVER (PARTITION BY conv_id) AS length FROM r
                WINDOW w AS (PARTITION BY conv_id ORDER BY pos)
                UNION ALL SELECT conv_id, 0, [], '', (SELECT count(*) FROM r WHERE r.conv_id = c.conv_id) FROM c),
        n AS MATERIALIZED (SELECT path, any_value(d) AS d, min(conv_id) AS conv_id, count(*) AS n_convs,
                any_value(CASE WHEN d = 0 THEN 0 ELSE len(list_filter(string_split_regex(text, '[\x20\x09-\x0D]+'), lambda x: x <> '')) END) AS words,
                sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (d = length), '')) AS ends_sha256 FROM p GROUP BY path),
        k AS (SELECT path[:d - 1] AS path, count(*) AS n_children FROM n WHERE d > 0 GROUP BY 1),
        s AS (SELECT p.path, count(*) FILTER (k.path IS NULL) AS n_leaves, sum((n.n_convs - 1) * words)::BIGINT AS saved_tokens
                FROM n JOIN p ON p.conv_id = n.conv_id AND p.d <= n.d LEFT JOIN k ON k.path = n.path GROUP BY p.path)
        SELECT n.conv_id, n.d AS depth, CASE WHEN n.d > 0 THEN up.conv_id END AS parent_conv_id, n.n_convs, coalesce(n_children, 0) AS n_children, n_leaves, saved_tokens, n.ends_sha256
        FROM n JOIN s ON s.path = n.path LEFT JOIN k ON k.path = n.path LEFT JOIN n up ON n.d > 0 AND up.path = n.path[:n.d - 1]
    """
