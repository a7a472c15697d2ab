"""Exact de-duplication by deterministic block naming.

Texts without white space are cut into blocks of a fixed number of bytes. Distinct blocks are
sorted and numbered; adjacent numbers are then paired, distinct pairs are sorted and numbered
again, until one number is left for each document. Two documents get the same (level, name) if
and only if their blocks are equal one by one, so there are no false groups: a 64-bit hash only
routes blocks to their names, and hashes that two blocks share are found and routed by content.

The text is shuffled once (distinct blocks, combined on the map side, so a block that a third of
the rows holds travels once per task). Everything after that moves numbers; a document leaves
the recursion when one name is left, so each level handles at most half the rows of the last.

Rows: null text counts as empty, all texts without a word are one group; a null id is a value
like others, ordered after all ids; repeated rows form a group of which one row stays; an empty
table gives an empty result; further columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..stages import stage
from .common import SPACES, kept_rows, one_of_repeats, same, text_or_empty, without

BLOCK_BYTES = 4096
_NO_RIGHT = -(2**63)  # right half of a pair whose left block has no neighbour


def squeezed(text: str | Column) -> Column:
    """The text without ASCII white space."""
    return without(text_or_empty(text), SPACES)


def _blocks(squeezed_bytes: Column, size: int) -> Column:
    count = F.greatest(F.lit(1), F.ceil(F.octet_length(squeezed_bytes) / size).cast("int"))
    return F.transform(F.sequence(F.lit(0), count - 1), lambda i: F.substring(squeezed_bytes, i * size + 1, F.lit(size)))


def _numbered(distinct: DataFrame, keys: list[str]) -> DataFrame:
    """Distinct keys, sorted inside their shuffle partition, with an integer name each.

    The numbers are fixed by writing them: a stage table is never computed twice.
    """
    return stage(distinct.sortWithinPartitions(*keys).withColumn("name", F.monotonically_increasing_id()), "names")


def block_identities(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    block_bytes: int = BLOCK_BYTES,
    block_hash: Callable[[Column], Column] = F.xxhash64,
) -> DataFrame:
    """One row per input row: row, id, n_points (code points of the original text),
    text_sha256 (of the squeezed text), level, name. (level, name) is the text's identity."""
    source = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    source = source.withColumn("bytes", squeezed("text").cast("binary"))

    cut = source.select(F.explode(_blocks(F.col("bytes"), block_bytes)).alias("block"))
    cut = cut.select(block_hash(F.col("block")).cast("long").alias("hash"), "block").distinct()
    names = stage(cut.sortWithinPartitions("block").select("hash", F.monotonically_increasing_id().alias("name")), "names")
    shared = stage(names.groupBy("hash").count().filter("count > 1").select("hash"), "shared-hashes")

    rows = stage(
        source.select(
            F.monotonically_increasing_id().alias("row"),
            "id",
            F.char_length("text").alias("n_points"),
            F.sha2("bytes", 256).alias("text_sha256"),
            F.transform(_blocks(F.col("bytes"), block_bytes), lambda b: block_hash(b).cast("long")).alias("hashes"),
        ),
        "rows",
    )
    places = rows.select("row", F.size("hashes").alias("n"), F.posexplode("hashes").alias("i", "hash"))
    if shared.isEmpty():
        named = places.join(names, "hash").select("row", "n", "i", "name")
    else:
        named = _named_by_content(source, rows, places, names, shared, block_bytes, block_hash)
    named = stage(named, "level")

    finished = named.filter("n = 1").select("row", F.lit(0).alias("level"), "name")
    longest = named.agg(F.max("n")).first()[0] or 1
    level = 0
    while longest > 1:
        level, longest = level + 1, -(-longest // 2)
        pairs = (
            named.filter("n > 1")
            .groupBy("row", (F.col("i") / 2).cast("int").alias("i"))
            .agg(
                F.max(F.ceil(F.col("n") / 2)).cast("int").alias("n"),
                F.max(F.when(F.col("i") % 2 == 0, F.col("name"))).alias("left"),
                F.coalesce(F.max(F.when(F.col("i") % 2 == 1, F.col("name"))), F.lit(_NO_RIGHT)).alias("right"),
            )
        )
        pairs = stage(pairs, "pairs")
        names = _numbered(pairs.select("left", "right").distinct(), ["left", "right"])
        named = stage(pairs.join(names, ["left", "right"]).select("row", "n", "i", "name"), "level")
        finished = finished.unionByName(named.filter("n = 1").select("row", F.lit(level).alias("level"), "name"))
    return rows.drop("hashes").join(finished, "row")


def _named_by_content(source, rows, places, names, shared, block_bytes, block_hash) -> DataFrame:
    """Names where some hashes stand for several blocks: those blocks are joined by content.

    ``source`` has no row numbers, so their blocks are found by (id, digest), which is all that
    tells two rows with the same text apart from others.
    """
    texts = source.select("id", F.sha2("bytes", 256).alias("text_sha256"), F.posexplode(_blocks(F.col("bytes"), block_bytes)).alias("i", "block")).distinct()
    texts = texts.withColumn("hash", block_hash(F.col("block")).cast("long")).join(shared, "hash", "left_semi")
    own = _numbered(texts.select("hash", "block").distinct(), ["hash", "block"]).withColumn("name", -F.col("name") - 1)
    texts = stage(texts.join(own, ["hash", "block"]).select("id", "text_sha256", "i", "name"), "content-names")
    heads = rows.select("row", "id", "text_sha256", F.size("hashes").alias("n"))
    by_content = texts.join(heads, same(texts, heads, [("id", "id"), ("text_sha256", "text_sha256")])).select("row", "n", "i", "name")
    by_hash = places.join(names.join(shared, "hash", "left_anti"), "hash").select("row", "n", "i", "name")
    return by_hash.unionByName(by_content)


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row per input row: id_col, keep_id, group_size, kept, text_sha256, n_points.

    Of equal texts the row with the most code points stays, then the smallest id.
    """
    rows = stage(block_identities(docs, id_col, text_col, **options), "identities")
    best = F.struct((-F.col("n_points")).alias("p"), F.col("id").isNull().alias("u"), F.col("id").alias("id"), F.col("row").alias("row"))
    groups = rows.groupBy("level", "name").agg(F.min(best).alias("best"), F.count("*").alias("group_size"))
    # Written first, without the groups of one: a table of known size, whose join AQE can split at a hot group.
    copies = stage(groups.filter("group_size > 1").withColumn("repeated", F.lit(True)), "copy-groups")
    joined = rows.join(copies, ["level", "name"], "left")
    repeated = F.coalesce("repeated", F.lit(False))
    return joined.select(
        F.col("id").alias(id_col),
        F.when(repeated, F.col("best.id")).otherwise(F.col("id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        (~repeated | (F.col("best.row") == F.col("row"))).alias("kept"),
        "text_sha256",
        "n_points",
    )


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with one row of each group of equal texts, all its columns as they are."""
    rows = stage(exact_dedup(docs, id_col, text_col, **options).select(F.col(id_col).alias("id"), F.col("text_sha256").alias("sha"), F.col("n_points").alias("points"), "kept"), "decided")
    keep = rows.filter("kept").drop("kept")
    keys = {"id": F.col(id_col), "sha": F.sha2(squeezed(text_col).cast("binary"), 256), "points": F.char_length(text_or_empty(text_col))}
    # Rows that agree in id, text and length are repeats of one row, of which one stays.
    repeated = not rows.groupBy(*keys).count().filter("count > 1").isEmpty()
    return one_of_repeats(kept_rows(docs, keep, keys), list(keys), repeated)
