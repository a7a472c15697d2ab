"""Toxicity by non-negative positive-unlabelled learning.

Confirmed toxic examples are the positives; everything else, labelled or not, is unlabelled. A
linear model over word presence is fitted with numpy to the non-negative risk estimator: with
class prior p, the risk is p * E_pos[loss(+)] + max(0, E_unl[loss(-)] - p * E_pos[loss(-)]). Where
the corrected negative part falls below zero, the step goes against it, so the model cannot
explain unlabelled toxic texts away. The logistic loss makes the score a probability.

The fit uses a bounded sample of the learning folds (``POSITIVES`` and ``UNLABELLED`` rows, first by
a hash of the id, whole texts) and a vocabulary of at most ``WORDS`` words: those whose share of
texts differs between both by more than ``MIN_Z`` standard errors. Word counts are made by Spark.
Scoring is one pass over all rows: the model (a few hundred kB, bounded by ``WORDS``) is sent to the
workers, nothing is shuffled.

Rows: a null text has no words and gets the score of an empty text; a null id is carried along (its
fold is that of the empty text); repeated rows get the same score; an empty table gives an empty
result, and without positives or unlabelled texts every score is the class prior; labels of
unknown documents are not used; further columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..stages import stage
from ..workers import ship_package
from .common import text_or_empty
from .labels import fold, sample

POSITIVES, UNLABELLED = 4000, 12000
WORDS = 20_000
MIN_DOCS, MIN_Z = 3, 5.0
#: Words that bound the class prior.
PRIOR_WORDS = 9
STEPS, RATE, RIDGE = 400, 0.1, 1e-6

#: A-Z lower-cased and every other ASCII character but letters and digits made a space.
_TABLE = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))


def words_of(text: bytes) -> set[bytes]:
    return set(text.translate(_TABLE).split())


def _distinct_words(texts: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [sorted(words_of(t)) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("positive"), pa.array(found, pa.list_(pa.binary()))], names=["positive", "words"])

    return texts.select("positive", F.col("text").cast("binary").alias("text")).mapInArrow(run, "positive int, words array<binary>")


def fit_nonnegative(rows: np.ndarray, columns: np.ndarray, positive: np.ndarray, features: int, prior: float) -> tuple[np.ndarray, float]:
    """Weights and bias. ``rows``/``columns`` list the present features of the examples.

    Full-batch Adam on the non-negative risk; the data decide the sign of every step.
    """
    count = len(positive)
    n_pos, n_unl = max(int(positive.sum()), 1), max(int((~positive).sum()), 1)
    weights, bias = np.zeros(features), float(np.log(prior / (1 - prior)))
    first, second = np.zeros(features + 1), np.zeros(features + 1)
    for step in range(1, STEPS + 1):
        margin = np.bincount(rows, weights[columns], count) + bias
        chance = 1 / (1 + np.exp(-np.clip(margin, -30, 30)))
        as_negative = np.logaddexp(0, margin)
        negative = as_negative[~positive].sum() / n_unl - prior * as_negative[positive].sum() / n_pos
        pull = np.where(positive, -prior * chance / n_pos, chance / n_unl)  # slope of the negative part
        slope = np.where(positive, prior * (chance - 1) / n_pos, 0.0) + pull if negative >= 0 else -pull
        gradient = np.r_[np.bincount(columns, slope[rows], features) + RIDGE * weights, slope.sum()]
        first = 0.9 * first + 0.1 * gradient
        second = 0.999 * second + 0.001 * gradient**2
        move = RATE * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-10)
        weights, bias = weights - move[:-1], bias - float(move[-1])
    return weights, bias


def prior_bound(ratios: list[float], otherwise: float) -> float:
    """The median of the bounds that the most telling words give."""
    return max(float(np.median(ratios)), 0.001) if ratios else otherwise


class Model:
    def __init__(self, weights: dict[bytes, float], bias: float):
        self.weights, self.bias = weights, bias

    def score(self, text: bytes) -> float:
        margin = self.bias + sum(map(self.weights.get, words_of(text), repeat(0.0)))
        return float(1 / (1 + np.exp(-max(-30.0, min(30.0, margin)))))


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    prior: float | None = None,
    positives: int = POSITIVES,
    unlabelled: int = UNLABELLED,
) -> Model:
    """A model from the learning folds. ``prior`` is the share of toxic texts among the unlabelled;
    where it is not given, it is the share of confirmed ones among labelled rows of these folds, or
    less where words show it: the unlabelled contain a word at least as often as the toxic texts
    among them do, so the ratio of both frequencies bounds the prior from above."""
    ship_package(docs.sparkSession)
    texts = docs.filter(fold(id_col) != 0).select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    known = labels.filter(fold(id_col) != 0).select(F.col(id_col).alias("id"), F.col(label_col).alias("label")).filter("label IS NOT NULL")
    bounded = prior is None
    if prior is None:
        share = known.agg(F.avg((F.col("label") == 1).cast("double"))).first()[0]
        prior = min(max(share or 0.0, 0.01), 0.5)
    # Ids are chosen first: at most ``positives + unlabelled`` of them are broadcast, and no text is shuffled.
    confirmed = sample(known.filter("label = 1").select("id").distinct().join(texts.select("id").distinct(), "id", "left_semi"), "id", positives)
    others = sample(texts.select("id").distinct(), "id", unlabelled)
    chosen = stage(confirmed.withColumn("positive", F.lit(1)).unionByName(others.withColumn("positive", F.lit(0))), "chosen")
    examples = stage(_distinct_words(texts.join(F.broadcast(chosen), "id")), "examples")

    sizes = {r["positive"]: r["count"] for r in examples.groupBy("positive").count().collect()}
    if not sizes.get(1) or not sizes.get(0):
        return Model({}, float(np.log(prior / (1 - prior))))
    counts = examples.select("positive", F.explode("words").alias("word")).groupBy("word")
    counts = counts.agg(F.sum("positive").alias("p"), F.count("*").alias("n")).filter(F.col("n") >= MIN_DOCS)
    gap = F.abs(F.col("p") / sizes[1] - (F.col("n") - F.col("p")) / sizes[0])
    share = (F.col("n") + 1) / (sizes[1] + sizes[0] + 1)
    counts = counts.withColumn("z", gap / F.sqrt(share * (1 - share) * (1 / sizes[1] + 1 / sizes[0]))).filter(F.col("z") >= MIN_Z)
    found = counts.orderBy(F.desc("z"), "word").limit(WORDS).collect()
    words = [bytes(r["word"]) for r in found]
    if bounded:
        prior = min(prior, prior_bound([(r["n"] - r["p"]) / sizes[0] / (r["p"] / sizes[1]) for r in found if r["p"] > 0][:PRIOR_WORDS], prior))
    index = {w: i for i, w in enumerate(words)}

    def to_numbers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [[index[w] for w in ws if w in index] for ws in batch.column("words").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("positive"), pa.array(found, pa.list_(pa.int32()))], names=["positive", "at"])

    table = examples.mapInArrow(to_numbers, "positive int, at array<int>").toArrow()
    at = table.column("at").combine_chunks()
    columns = at.flatten().to_numpy().astype(np.int64)
    rows = np.repeat(np.arange(len(at)), at.value_lengths().to_numpy())
    weights, bias = fit_nonnegative(rows, columns, table.column("positive").to_numpy() == 1, len(words), prior)
    return Model({w: float(x) for w, x in zip(words, weights, strict=True)}, bias)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id_col, held_out, score (0 to 1), predicted of every row's whole text."""
    spark = docs.sparkSession
    ship_package(spark)
    sent = spark.sparkContext.broadcast(model)
    source = docs.select(F.col(id_col), (fold(id_col) == 0).alias("held_out"), text_or_empty(text_col).cast("binary").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score_of = sent.value.score
        for batch in batches:
            scores = [score_of(t) for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(scores, pa.float64())], names=[id_col, "held_out", "score"])

    scored = source.mapInArrow(run, source.select(id_col, "held_out", F.lit(0.0).alias("score")).schema)
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
