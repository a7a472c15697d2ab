"""Quality by compression: which of two dictionaries helps a text more.

One zstandard dictionary is trained on good and one on bad labelled texts. A text is compressed
with both; the difference of the sizes, normalised by the text's length and by the sum of both, is all
that a score sees. It is calibrated to a probability by a logistic fit, piecewise linear in the two
normalised differences, on labelled rows that neither dictionary has seen.

The fit uses a bounded sample of the learning folds: ``EXAMPLES`` whole texts of at most
``EXAMPLE_BYTES`` bytes of each class for a dictionary (folds 1 and 2) and ``CALIBRATION`` rows for the
calibration (folds 3 and 4), first by a hash of the id. Scoring is one pass over all rows and whole
texts; the two dictionaries (``DICTIONARY_BYTES`` each) travel with the task, nothing is shuffled.

Rows: a null text is an empty one and has a score like it; a null id is carried along (its fold is
that of the empty text); repeated rows get the same score; an empty table gives an empty result;
with labels of one class or none at all every score is the (smoothed) share of good ones; further
columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..stages import stage
from ..workers import ship_package
from .common import text_or_empty
from .labels import fold, sample

EXAMPLES, EXAMPLE_BYTES, CALIBRATION = 1500, 32_768, 6000
DICTIONARY_BYTES = 400_000
LEVEL = 3
FEATURES = ["by_length", "by_sizes"]
#: Bends of the calibration, in deviations from the mean.
BENDS = (-1.5, -1.0, -0.5, 0.0, 0.5, 1.0)


class Sizes:
    """Compressed sizes of a text under both dictionaries."""

    def __init__(self, good: bytes, bad: bytes):
        import zstandard

        self.compressors = []
        for data in (good, bad):
            dictionary = zstandard.ZstdCompressionDict(data)
            dictionary.precompute_compress(level=LEVEL)
            self.compressors.append(zstandard.ZstdCompressor(level=LEVEL, dict_data=dictionary, write_content_size=False, write_dict_id=False))

    def features(self, text: bytes) -> list[float]:
        good, bad = (len(c.compress(text)) for c in self.compressors)
        return [(bad - good) / (len(text) + 1), (bad - good) / (good + bad)]


def expanded(features: np.ndarray) -> np.ndarray:
    """The features, what of each lies beyond every bend, and a 1."""
    beyond = [np.maximum(0.0, features - bend) for bend in BENDS]
    return np.column_stack([features, *beyond, np.ones(len(features))])


def penalised_loss(x: np.ndarray, good: np.ndarray, weights: np.ndarray, penalty: np.ndarray) -> float:
    margin = x @ weights
    return float((np.logaddexp(0, margin) - good * margin).sum() + (penalty * weights**2).sum() / 2)


def calibrate(features: np.ndarray, good: np.ndarray, ridge: float = 1.0, steps: int = 60) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(mean, scale, weights) of a logistic fit by Newton steps, halved until the loss falls."""
    mean, scale = features.mean(axis=0), features.std(axis=0) + 1e-9
    x = expanded(np.clip((features - mean) / scale, -8, 8))
    penalty = np.r_[np.full(x.shape[1] - 1, ridge), 1e-6]
    weights = np.zeros(x.shape[1])
    loss = penalised_loss(x, good, weights, penalty)
    for _ in range(steps):
        chance = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        hessian = (x * (chance * (1 - chance))[:, None]).T @ x + np.diag(penalty)
        step, part = np.linalg.solve(hessian, x.T @ (chance - good) + penalty * weights), 1.0
        while part > 1e-9 and penalised_loss(x, good, weights - part * step, penalty) > loss:
            part /= 2
        if part <= 1e-9:
            break
        weights = weights - part * step
        loss = penalised_loss(x, good, weights, penalty)
    return mean, scale, weights


class Model:
    def __init__(self, good: bytes, bad: bytes, mean: np.ndarray, scale: np.ndarray, weights: np.ndarray):
        self.good, self.bad, self.mean, self.scale, self.weights = good, bad, mean, scale, weights

    def scores(self, texts: list[bytes], sizes: Sizes) -> np.ndarray:
        found = np.array([sizes.features(t) for t in texts], dtype=float).reshape(-1, len(FEATURES))
        x = expanded(np.clip((found - self.mean) / self.scale, -8, 8))
        return 1 / (1 + np.exp(-np.clip(x @ self.weights, -30, 30)))


class Constant:
    """The model where the labels cannot tell two classes apart."""

    def __init__(self, share: float):
        self.share, self.good, self.bad = share, b"", b""

    def scores(self, texts: list[bytes], sizes: Sizes | None) -> np.ndarray:
        return np.full(len(texts), self.share)


def _measured(texts: DataFrame, good: bytes, bad: bytes) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes = Sizes(good, bad)
        for batch in batches:
            found = np.array([sizes.features(t) for t in batch.column("text").to_pylist()], dtype=float).reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays([batch.column("label"), *[pa.array(found[:, k]) for k in range(len(FEATURES))]], names=["label", *FEATURES])

    return texts.select("label", F.col("text").cast("binary").alias("text")).mapInArrow(run, "label int, " + ", ".join(f"{f} double" for f in FEATURES))


def _trained(texts: list[bytes], size: int) -> bytes:
    """A trained dictionary; with too few texts to train on, the texts themselves."""
    import zstandard

    try:
        return zstandard.train_dictionary(size, texts).as_bytes()
    except zstandard.ZstdError:
        return b"".join(texts)[:size]


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    examples: int = EXAMPLES,
    example_bytes: int = EXAMPLE_BYTES,
    calibration: int = CALIBRATION,
    dictionary_bytes: int = DICTIONARY_BYTES,
) -> Model | Constant:
    ship_package(docs.sparkSession)
    known = labels.filter(fold(id_col) != 0).select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label")).filter("label IN (0, 1)")
    texts = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    # Lengths first: the chosen ids (at most ``2 * examples + calibration``) are broadcast, and no text is shuffled.
    lengths = stage(texts.select("id", F.octet_length("text").alias("bytes")).join(known, "id"), "labelled")
    chosen = None
    for label in (1, 0):
        part = lengths.filter((F.col("label") == label) & fold("id").isin(1, 2) & (F.col("bytes") > 0) & (F.col("bytes") <= example_bytes))
        part = sample(part, "id", examples).select("id", "label", F.lit(True).alias("example"))
        chosen = part if chosen is None else chosen.unionByName(part)
    chosen = chosen.unionByName(sample(lengths.filter(fold("id").isin(3, 4)), "id", calibration).select("id", "label", F.lit(False).alias("example")))
    chosen = stage(chosen.distinct(), "chosen")
    rows = stage(texts.join(F.broadcast(chosen), "id"), "labelled")
    taken = {label: [r["text"].encode() for r in rows.filter((F.col("label") == label) & F.col("example")).select("text").collect()] for label in (1, 0)}
    if not taken[0] or not taken[1]:
        share = known.agg((F.sum("label") + 1) / (F.count("*") + 2)).first()[0]
        return Constant(share if share is not None else 0.5)
    good, bad = _trained(taken[1], dictionary_bytes), _trained(taken[0], dictionary_bytes)
    table = _measured(rows.filter(~F.col("example")), good, bad).toArrow()
    features = np.column_stack([table.column(f).to_numpy() for f in FEATURES])
    target = table.column("label").to_numpy()
    if len(set(target.tolist())) < 2:
        share = known.agg((F.sum("label") + 1) / (F.count("*") + 2)).first()[0]
        return Constant(share)
    return Model(good, bad, *calibrate(features, target))


def score(docs: DataFrame, model: Model | Constant, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id_col, held_out, score (0 to 1, the calibrated chance of good), predicted of every row's whole text."""
    ship_package(docs.sparkSession)
    source = docs.select(F.col(id_col), (fold(id_col) == 0).alias("held_out"), text_or_empty(text_col).cast("binary").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes = Sizes(model.good, model.bad) if model.good else None
        for batch in batches:
            scores = model.scores(batch.column(2).to_pylist(), sizes)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(scores, pa.float64())], names=[id_col, "held_out", "score"])

    scored = source.mapInArrow(run, source.select(id_col, "held_out", F.lit(0.0).alias("score")).schema)
    return scored.withColumn("predicted", (F.col("score") >= 0.3).cast("int"))
