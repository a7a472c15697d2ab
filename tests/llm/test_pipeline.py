"""The pipeline's stages against plain Python, and what it is registered as."""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict

import corpus_pipeline
import pytest
from pyspark.sql import functions as F
import __spark_entry__
from vitrine.llm import block_names, mixing, prefix_bpe, quality_rules, queries, simhash

from .test_operators import WORD, arrow, awkward_texts, brute_fingerprint, oracle

#: Names that the operators use inside.
CLASHES = ["row", "id", "weight", "copy", "text_hash", "sha", "points", "kept", "component", "key_source", "cell_source", "kept_id", "n_tokens", "topic", "_c_weight", "_d_text", "_copy"]


def squeeze(text: str | None) -> str:
    return re.sub(r"[\x20\x09-\x0D]", "", text or "")


def near_groups(rows: list[tuple]) -> dict:
    """Smallest id of each row's component: fingerprints at most 4 bits apart are linked."""
    prints, root = [brute_fingerprint(t, 4) for _, t in rows], list(range(len(rows)))

    def top(i: int) -> int:
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 4:
                root[top(i)] = top(j)
    least: dict = {}
    for i, (k, _) in enumerate(rows):
        if k is not None:
            least[top(i)] = min(least.get(top(i), k), k)
    return {i: (top(i), least.get(top(i))) for i in range(len(rows))}


@pytest.fixture(scope="module")
def stages(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    seen = {}
    for name, step in corpus_pipeline.STAGES:
        before, docs = docs, step(spark, docs, sf).cache()
        seen[name] = (before, docs)
    return seen


def test_stages_keep_columns_and_rows(stages, spark, sf):
    columns = spark.read.parquet(f"{sf}/documents.parquet").columns
    for name, (before, after) in stages.items():
        assert after.count() <= before.count()
        if name != "bpe":
            assert after.columns == columns and after.join(before, columns, "left_anti").isEmpty()


def test_quality_stage_equals_sql(stages):
    before, after = stages["quality_rules"]
    kept = oracle(f"SELECT doc_id FROM ({quality_rules.oracle()}) WHERE kept", documents=arrow(before.select("doc_id", "text")))
    assert sorted(r["doc_id"] for r in after.collect()) == sorted(k for (k,) in kept)


def test_exact_stage_equals_brute_force(stages):
    before, after = stages["exact_dedup"]
    groups = defaultdict(list)
    for r in before.collect():
        groups[squeeze(r["text"])].append((-len(r["text"] or ""), r["doc_id"]))
    assert sorted(r["doc_id"] for r in after.collect()) == sorted(min(g)[1] for g in groups.values())


def test_near_stage_equals_brute_force(stages):
    before, after = stages["near_dedup"]
    groups = near_groups([(r["doc_id"], r["text"]) for r in before.collect()])
    assert sorted(r["doc_id"] for r in after.collect()) == sorted({least for _, least in groups.values()})


def test_mixing_stage_draws_by_weight(stages):
    """Copies of every document are its cell's weight, rounded by the digest of its id, and no margin is far from its target."""
    before, after = stages["mixing"]
    marks = [c.alias(n) for n, c in zip([*mixing.MARGINS, "n_tokens"], mixing.labelled(before), strict=True)]
    rows = before.select("doc_id", *marks, mixing.uniform(F.col("doc_id")).alias("u")).collect()
    drawn = Counter(r["doc_id"] for r in after.collect())
    tokens = Counter()
    for r in rows:
        tokens[r["source"], r["lang"], r["topic"]] += r["n_tokens"]
    weight = dict.fromkeys(tokens, 1.0)
    targets = []
    for m in range(3):
        seen = Counter()
        for cell, n in tokens.items():
            seen[cell[m]] += n
        whole = sum(math.sqrt(n) for n in seen.values())
        targets.append({v: math.sqrt(n) / whole * sum(tokens.values()) for v, n in seen.items()})
    for _ in range(200):
        for m, target in enumerate(targets):
            have = Counter()
            for cell, n in tokens.items():
                have[cell[m]] += n * weight[cell]
            weight = {cell: w * target[cell[m]] / have[cell[m]] for cell, w in weight.items()}
    share = 1.0
    while True:
        copies = {r["doc_id"]: math.floor(share * weight[r["source"], r["lang"], r["topic"]] + r["u"]) for r in rows}
        if sum(copies.values()) <= len(rows):
            break
        share *= 0.999 * len(rows) / sum(copies.values())
    assert sum(abs(drawn[k] - n) for k, n in copies.items()) <= 0.02 * len(rows) + 1


def test_bpe_stage_equals_the_library(stages):
    import public_tokenizers
    import tiktoken
    from tiktoken.load import load_tiktoken_bpe

    path, pattern = queries.byte_vocabulary()
    library = tiktoken.Encoding("check", pat_str=public_tokenizers.PATTERN, mergeable_ranks=load_tiktoken_bpe(path), special_tokens={})
    before, after = stages["bpe"]
    texts = {r["doc_id"]: r["text"] for r in before.collect()}
    rows = after.collect()
    assert len(rows) == before.count()
    for r in rows:
        assert list(r["ids"]) == library.encode_ordinary(texts[r["doc_id"]] or "") and r["n_tokens"] == len(r["ids"])


@pytest.fixture(scope="module")
def clashing(spark):
    schema = "doc_id long, text string, lang string, source string, " + ", ".join(f"{c} string" for c in CLASHES)
    rows = [(i, t, "en", "hot" if i is None or i % 3 else None, *[f"own {c} {k}" for c in CLASHES]) for k, (i, t) in enumerate(awkward_texts())]
    return spark.createDataFrame(rows, schema).repartition(3).cache(), spark.createDataFrame([], schema)


@pytest.mark.parametrize("step", [quality_rules.keep_good, block_names.drop_copies, simhash.one_of_each, mixing.draw, mixing.sample])
def test_rows_stay_as_they_are_under_clashing_names(clashing, step):
    docs, none = clashing
    left = step(docs)
    assert left.columns == docs.columns and step(none).count() == 0
    original = {tuple(r) for r in docs.collect()}
    assert all(tuple(r) in original for r in left.collect())


def test_encode_carries_any_column(clashing):
    docs, none = clashing
    path, pattern = queries.byte_vocabulary()
    keep = ["doc_id", "text", "row", "id"]
    assert sorted(map(repr, (tuple(r)[:4] for r in prefix_bpe.encode(docs, path, pattern, keep=keep).collect()))) == sorted(repr(tuple(r)) for r in docs.select(keep).collect())
    assert prefix_bpe.encode(none, path, pattern, keep=keep).count() == 0


@pytest.mark.parametrize("unit", [2048, 3])
def test_one_of_each_component(clashing, unit):
    """Null ids, ties, repeated rows and several texts under one id."""
    docs, _ = clashing
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    groups = near_groups(rows)
    left = simhash.one_of_each(docs, unit=unit).collect()
    assert sorted(map(repr, (r["doc_id"] for r in left))) == sorted(map(repr, (least for _, least in set(groups.values()))))
    found = simhash.components(docs, 4, 1, 4, unit=unit).collect()
    assert sorted(repr((r["id"], r["component_id"])) for r in found) == sorted(repr((rows[i][0], least)) for i, (_, least) in groups.items())


def test_pipeline_is_registered():
    assert "pipeline" in __spark_entry__.queries()
    assert {n.split("_")[0] for n in __spark_entry__.queries() if re.match(r"op\d+_", n)} == {f"op{k}" for k in range(1, 14)}
