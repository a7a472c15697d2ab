"""Mixing sources to target weights by iterative proportional fitting, in DataFrame functions only.

The tokens of every (source, language, topic) cell are summed once; each round then scales the
cells to the wanted share of every source, of every language and of every topic in turn. Only the
table of cells takes part in the rounds, and each round is a stage table. Documents are joined
with the weight of their cell and drawn by it: a weight of 2.3 means two copies and a third with
probability 0.3, decided by a digest of the id, so any run draws the same documents.

A hot source is one value in a few cells: sums are combined before they travel, and the join with
the cells is a broadcast where their file is small and otherwise splits hot keys (AQE).

Rows: a null source, language or topic is a value of its own; a null text has no tokens; cells
without tokens keep weight 1; repeated rows are drawn alike, since the draw depends on the id; an
empty table gives an empty result; further columns are not read.
"""

from __future__ import annotations

import warnings

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..stages import stage
from .common import same, text_or_empty

ROUNDS = 12
#: Drawing rakes until a round moves no margin by more than TOLERANCE, in MOST_ROUNDS at most.
TOLERANCE, MOST_ROUNDS = 0.001, 60
#: So many rounds are one job.
ROUNDS_A_STAGE = 4
#: Shares of a margin are the observed ones to this power: 1 keeps them, 0 makes them equal.
TEMPERATURE = 0.5
MARGINS = ["source", "lang", "topic"]
KEYS = [*(f"key_{m}" for m in MARGINS), "n_tokens"]

#: Topic of a text for tables that have none: the first pattern it contains.
TOPIC_SQL = """CASE WHEN coalesce(text, '') LIKE '%Licen%' THEN 'licence' WHEN coalesce(text, '') LIKE '%@%' THEN 'contact'
    WHEN coalesce(text, '') LIKE '% | %' THEN 'table' ELSE 'prose' END"""


def token_count(text: Column) -> Column:
    """Words of [^\x20\x09-\x0D]+."""
    return F.size(F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda x: x != "")).cast("long")


def tempered(cells: DataFrame, margin: str, temperature: float = TEMPERATURE) -> DataFrame:
    """(value, share): the observed token shares of a margin, raised to a power and normalised."""
    seen = cells.groupBy(F.col(margin).alias("value")).agg(F.pow(F.sum("tokens").cast("double"), F.lit(temperature)).alias("s")).filter("s > 0")
    whole = seen.agg(F.sum("s")).first()[0]
    return seen.select("value", (F.col("s") / F.lit(whole)).alias("share"))


def rake(cells: DataFrame, targets: dict[str, DataFrame], rounds: int = ROUNDS, tolerance: float | None = None) -> DataFrame:
    """``cells`` (margins and ``tokens``) with ``weight``: the factor that brings every margin to its target.

    A target is a table (value, share). Values that no cell has are left out and the other shares
    scaled up; cells of values without a target get no tokens.

    With a ``tolerance`` the rounds end as soon as one has changed the weights by no more than this share
    in any margin, so all margins are then within about twice of it; a warning names what is left if
    ``rounds`` do not get there, as with targets that the cells cannot meet together.
    """
    names = cells.columns
    cells = stage(cells, "cells")
    total = cells.agg(F.sum("tokens")).first()[0] or 0
    goals = cells
    for margin, target in targets.items():
        present = cells.filter("tokens > 0").select(F.col(margin).alias("v")).distinct()
        found = target.join(present, target["value"].eqNullSafe(present["v"]), "left_semi")
        whole = found.agg(F.sum("share")).first()[0]
        wanted = found.select("value", (total * F.col("share") / F.lit(whole)).alias(f"wanted_{margin}"))
        goals = goals.join(wanted, goals[margin].eqNullSafe(wanted["value"]), "left").drop("value")
    fitted, moved = stage(goals.withColumn("weight", F.lit(1.0)), "cells"), None
    for done in range(1, rounds + 1):
        fitted = fitted.withColumn("moved", F.lit(0.0))
        for margin in targets:
            # Sums of one table by window: nothing is joined or sent around in a round.
            have = F.sum(F.col("tokens") * F.col("weight")).over(Window.partitionBy(margin))
            fitted = fitted.withColumn("have", have)
            fitted = fitted.withColumn("factor", F.when(F.col("have") > 0, F.coalesce(f"wanted_{margin}", F.lit(0.0)) / F.col("have")).otherwise(1.0))
            change = F.when((F.col("tokens") > 0) & (F.col("weight") > 0), F.abs(F.col("factor") - 1)).otherwise(0.0)
            fitted = fitted.withColumns({"weight": F.col("weight") * F.col("factor"), "moved": F.greatest("moved", change)}).drop("have", "factor")
        if done % ROUNDS_A_STAGE and done < rounds:
            continue
        fitted = stage(fitted, "raked")
        if tolerance is not None:
            moved = fitted.agg(F.max("moved")).first()[0] or 0.0
            if moved <= tolerance:
                break
    if tolerance is not None and moved is not None and moved > tolerance:
        warnings.warn(f"raking: after {rounds} rounds a margin is still moved by {moved:.2g} (tolerance {tolerance:.2g})", stacklevel=2)
    return fitted.select(*names, "weight")


def uniform(identifier: Column) -> Column:
    """A number in [0, 1) fixed by the id: the first 52 bits of its MD5."""
    return F.conv(F.substring(F.md5(F.coalesce(identifier.cast("string"), F.lit(""))), 1, 13), 16, 10).cast("double") / 2.0**52


def labelled(docs: DataFrame, topic: Column | None = None, source_col: str = "source", lang_col: str = "lang", text_col: str = "text") -> list[Column]:
    """The margins and tokens of a document as columns."""
    return [
        F.col(source_col).alias("source"),
        F.col(lang_col).alias("lang"),
        (F.expr(TOPIC_SQL) if topic is None else topic).alias("topic"),
        token_count(text_or_empty(text_col)).alias("n_tokens"),
    ]


def cell_weights(rows: DataFrame, targets: dict[str, DataFrame] | None = None, rounds: int = ROUNDS, tolerance: float | None = None) -> DataFrame:
    """(source, lang, topic, tokens, weight) of the documents' cells; tempered shares where no targets are given."""
    cells = stage(rows.groupBy(*MARGINS).agg(F.sum("n_tokens").alias("tokens")), "cells")
    return rake(cells, targets or {m: tempered(cells, m) for m in MARGINS}, rounds, tolerance)


def mix(docs: DataFrame, id_col: str = "doc_id", share: float = 1.0, targets: dict[str, DataFrame] | None = None, rounds: int = ROUNDS, **columns) -> DataFrame:
    """One row per document: id_col, source, lang, topic, n_tokens, weight, copies.

    ``share`` times the weight is the expected number of copies, so the expected tokens of every
    margin have their target shares and add up to ``share`` of all tokens.
    """
    rows = stage(docs.select(F.col(id_col), *labelled(docs, **columns)), "labelled")
    weights = cell_weights(rows, targets, rounds).drop("tokens")
    renamed = weights.select(*[F.col(m).alias(f"c_{m}") for m in MARGINS], "weight")
    joined = rows.join(renamed, same(rows, renamed, [(m, f"c_{m}") for m in MARGINS]))
    copies = F.floor(share * F.col("weight") + uniform(F.col(id_col))).cast("long")
    return joined.select(id_col, *MARGINS, "n_tokens", "weight", copies.alias("copies"))


def _weighted(docs: DataFrame, id_col: str, targets: dict[str, DataFrame] | None, rounds: int, tolerance: float | None, columns: dict) -> DataFrame:
    """(row, id, weight): the rows of ``docs``, each whole as a struct, with the weight of their cell."""
    marks = [c.alias(n) for n, c in zip(KEYS, labelled(docs, **columns), strict=True)]
    weights = cell_weights(docs.select(*marks).toDF(*MARGINS, "n_tokens"), targets, rounds, tolerance)
    renamed = weights.select(*[F.col(m).alias(f"cell_{m}") for m in MARGINS], "weight")
    marked = docs.select(F.struct("*").alias("row"), F.col(id_col).alias("id"), *marks[:3])
    return marked.join(renamed, same(marked, renamed, [(f"key_{m}", f"cell_{m}") for m in MARGINS])).select("row", "id", "weight")


def sample(docs: DataFrame, id_col: str = "doc_id", share: float = 1.0, targets: dict[str, DataFrame] | None = None, rounds: int = ROUNDS, **columns) -> DataFrame:
    """The drawn rows of ``docs``, each once at most, all their columns as they are.

    A weight above 1 is worth one copy here, so margins of rare cells fall short of their targets: ``draw`` meets them.
    """
    joined = _weighted(docs, id_col, targets, rounds, None, columns)
    return joined.filter(share * F.col("weight") + uniform(F.col("id")) >= 1).select("row.*")


def draw(
    docs: DataFrame, id_col: str = "doc_id", share: float = 1.0, targets: dict[str, DataFrame] | None = None, rounds: int = MOST_ROUNDS, tolerance: float = TOLERANCE, no_more_rows: bool = False, **columns
) -> DataFrame:
    """The drawn rows of ``docs``, each as often as its weight says, all their columns as they are.

    The expected tokens of every margin have their target shares and add up to ``share`` of all tokens.
    With ``no_more_rows`` the share is lowered, for all cells alike, until there are no more rows than in ``docs``.
    """
    joined = _weighted(docs, id_col, targets, rounds, tolerance, columns)
    if no_more_rows:
        drawn = stage(joined.select(F.col("weight").alias("w"), uniform(F.col("id")).alias("u")), "weights")
        while True:
            rows, copies = drawn.agg(F.count("*"), F.sum(F.floor(share * F.col("w") + F.col("u")))).first()
            if (copies or 0) <= rows:
                break
            share *= 0.999 * rows / copies
    copies = F.floor(share * F.col("weight") + uniform(F.col("id"))).cast("int")
    return joined.select("row", F.explode(F.array_repeat(F.lit(0), copies)).alias("copy")).select("row.*")


def oracle_steps(source: str = "documents", rounds: int = ROUNDS, temperature: float = TEMPERATURE) -> list[str]:
    """CTEs that end in mix_rows (labelled documents) and mix_cells (weights), in DuckDB SQL."""
    steps = [
        rf"""mix_rows AS MATERIALIZED (SELECT doc_id, source, lang, {TOPIC_SQL} AS topic,
            len(list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')) AS n_tokens FROM {source})""",
        "cells0 AS MATERIALIZED (SELECT source, lang, topic, sum(n_tokens)::DOUBLE AS tokens, 1::DOUBLE AS weight FROM mix_rows GROUP BY ALL)",
    ]
    for m in MARGINS:
        steps.append(f"pow_{m} AS (SELECT {m}, pow(sum(tokens), {temperature}) AS s FROM cells0 GROUP BY {m} HAVING sum(tokens) > 0)")
        steps.append(f"want_{m} AS MATERIALIZED (SELECT {m}, (SELECT sum(tokens) FROM cells0) * s / (SELECT sum(s) FROM pow_{m}) AS wanted FROM pow_{m})")
    k = 0
    for _ in range(rounds):
        for m in MARGINS:
            k += 1
            steps.append(
                f"cells{k} AS MATERIALIZED (SELECT c.source, c.lang, c.topic, c.tokens, CASE WHEN h.have > 0 THEN c.weight * coalesce(t.wanted, 0) / h.have ELSE c.weight END AS weight"
                f" FROM cells{k - 1} c JOIN (SELECT {m}, sum(tokens * weight) AS have FROM cells{k - 1} GROUP BY {m}) h ON c.{m} IS NOT DISTINCT FROM h.{m}"
                f" LEFT JOIN want_{m} t ON c.{m} IS NOT DISTINCT FROM t.{m})"
            )
    steps.append(f"mix_cells AS (SELECT * FROM cells{k})")
    return steps


UNIFORM_SQL = "('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT / pow(2, 52)"
MATCH_SQL = " AND ".join(f"r.{m} IS NOT DISTINCT FROM c.{m}" for m in MARGINS)


def oracle() -> str:
    return (
        "WITH " + ",\n".join(oracle_steps()) + "\nSELECT doc_id, r.source, r.lang, r.topic, n_tokens, round(weight, 6) AS weight,"
        f" floor(weight + {UNIFORM_SQL})::BIGINT AS copies FROM mix_rows r JOIN mix_cells c ON {MATCH_SQL}"
    )
