"""The corpus pipeline: raw documents to token ids, stage by stage.

quality rules -> exact copies -> near copies -> mixing of sources -> byte-level BPE. ``run`` writes
every stage to the shared folder and rereads it as the next stage's documents, so a lost executor
costs one stage at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from vitrine.llm import block_names, mixing, prefix_bpe, quality_rules, simhash
from vitrine.llm.queries import byte_vocabulary
from vitrine.stages import stage

#: No SQL: fingerprints and token ids are computed in Python. tests/llm/test_pipeline.py compares
#: what each stage returns with a plain version of it over the stage's own input.
ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules' posterior keeps."""
    return quality_rules.keep_good(docs)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of texts that are equal but for white space."""
    return block_names.drop_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each group that SimHash links: four-word shingles, 4 bits at most."""
    return simhash.one_of_each(docs, words=4, threshold=4)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents, some of them repeated, whose sources, languages and topics have tempered shares of the tokens."""
    return mixing.draw(docs, no_more_rows=True)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, n_tokens and ids."""
    return prefix_bpe.encode(docs, *byte_vocabulary(), keep=["doc_id", "lang", "source"])


STAGES = [
    ("quality_rules", quality),
    ("exact_dedup", exact_copies),
    ("near_dedup", near_copies),
    ("mixing", mixture),
    ("bpe", tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (name, step) in enumerate(STAGES, 1):
        docs = step(spark, docs, sf_dir)
        if number < len(STAGES):
            docs = stage(docs, name)
    return docs
