"""Splits, targets, thresholds and classifier metrics as exact distributed aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.ordered import running_totals
from ..functions.quantiles import exact_quantiles, quantile_scalar
from ..functions.scalars import np_round
from ..stages import stage


def hash_share(key: str, seed: int) -> Column:
    """A number in [0, 1) from the first 13 hex digits of a key's md5."""
    digest = F.md5(F.concat_ws(":", F.col(key).cast("string"), F.lit(str(seed))))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / float(16**13)


def stratified_split(df: DataFrame, label: str, key: str = "id", share: float = 0.2, seed: int = 42, name: str = "is_test") -> DataFrame:
    """Add a boolean that is true for ``share`` of every class, chosen by hash of the key.

    The cut is a quantile of the hash per class, so a dominant class is never ranked in one
    task. Rows without a class are a class of their own. With a class below two rows the split is
    not stratified.
    """
    hashed = df.withColumn("_share", hash_share(key, seed))
    hashed = hashed.withColumn("_class", F.coalesce(F.concat(F.lit("="), F.col(label).cast("string")), F.lit("")))
    smallest = df.groupBy(label).agg(F.count("*").alias("n")).agg(F.min("n").alias("n"), F.count("*").alias("k")).first()
    if smallest["k"] < 2 or smallest["n"] < 2:
        return hashed.withColumn(name, F.col("_share") <= quantile_scalar(hashed, "_share", share)).drop("_share", "_class")
    cuts = stage(exact_quantiles(hashed, {"s": "_share"}, [share], by=["_class"]).select("_class", F.col("value").alias("_cut")), "split-cuts")
    return hashed.join(cuts, "_class").withColumn(name, F.col("_share") <= F.col("_cut")).drop("_share", "_cut", "_class").select(*df.columns, name)


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """(label, n, weight): rows / (classes x rows of the class)."""
    counts = stage(df.groupBy(label).agg(F.count("*").alias("n")), "class-counts")
    total = counts.agg((F.sum("n") / F.count("*")).alias("m")).select("m").scalar()
    return counts.select(label, "n", (total / F.col("n")).alias("weight"))


def positive_weight(df: DataFrame, label: str) -> DataFrame:
    """One row: negatives per positive, 1 without positives."""
    positives = F.count_if(F.col(label) == 1)
    return df.agg(F.coalesce(F.try_divide(F.count_if(F.col(label) == 0).cast("double"), positives), F.lit(1.0)).alias("scale_pos_weight"))


def top_quantile_target(df: DataFrame, column: str = "composite_score", prob: float = 0.8, name: str = "is_top_product") -> DataFrame:
    return df.withColumn(name, (F.col(column) >= quantile_scalar(df, column, prob)).cast("int"))


def _score_counts(df: DataFrame, truth: str, score: str) -> DataFrame:
    """Positives and negatives per distinct score with the counts below it, in global order."""
    counts = df.groupBy(F.col(score).cast("double").alias("score")).agg(
        F.sum(F.col(truth).cast("long")).alias("pos"), F.sum(1 - F.col(truth).cast("long")).alias("neg")
    )
    return running_totals(stage(counts, "score-counts"), "score", ["pos", "neg"])


def threshold_curve(df: DataFrame, truth: str, score: str) -> DataFrame:
    """(score, precision, recall, f1) for every distinct score taken as threshold."""
    hit = F.col("pos_total") - F.col("pos_before")
    alarm = F.col("neg_total") - F.col("neg_before")
    # Without any positive, recall is 1 by convention.
    curve = _score_counts(df, truth, score).select(
        "score",
        (hit / (hit + alarm)).alias("precision"),
        F.coalesce(F.try_divide(hit, F.col("pos_total")), F.lit(1.0)).alias("recall"),
    )
    both = F.col("precision") + F.col("recall")
    return curve.withColumn("f1", F.coalesce(F.try_divide(2 * F.col("precision") * F.col("recall"), both), F.lit(0.0)))


def optimal_f1_threshold(df: DataFrame, truth: str, score: str) -> DataFrame:
    """One row (threshold, f1): the best F1, the lowest threshold on ties, (0.5, 0) without rows."""
    best = threshold_curve(df, truth, score).agg(
        F.max_by(F.struct("score", "f1"), F.struct(np_round(F.col("f1"), 12), -F.col("score"))).alias("b")
    )
    return best.select(F.coalesce("b.score", F.lit(0.5)).alias("threshold"), F.coalesce("b.f1", F.lit(0.0)).alias("f1"))


def apply_threshold(df: DataFrame, score: str, threshold: float | Column, name: str = "prediction") -> DataFrame:
    limit = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
    return df.withColumn(name, (F.col(score) >= limit).cast("int"))


def roc_auc(df: DataFrame, truth: str, score: str) -> DataFrame:
    """One row (auc): rank sum with ties counted half; null when a class is missing."""
    below = F.col("pos") * (F.col("neg_before") + F.col("neg") / 2)
    return _score_counts(df, truth, score).agg(F.try_divide(F.sum(below), F.max("pos_total") * F.max("neg_total")).alias("auc"))


def roc_auc_weighted(df: DataFrame, truth: str, scores: dict[str, str]) -> float:
    """One class against the rest, weighted by class size; ``scores`` maps class to column."""
    total = weight = 0.0
    for value, column in scores.items():
        one = df.select((F.col(truth) == value).cast("int").alias("y"), F.col(column).alias("s"))
        auc = roc_auc(one, "y", "s").first()["auc"]
        size = one.agg(F.sum("y")).first()[0]
        if auc is not None:
            total, weight = total + auc * size, weight + size
    return total / weight if weight else float("nan")


def confusion_table(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    return df.groupBy(F.col(truth).alias("actual"), F.col(predicted).alias("predicted")).agg(F.count("*").alias("n"))


def class_report(confusion: DataFrame) -> DataFrame:
    """Per class: precision, recall, f1, support (0 where undefined). Works on the k x k table."""
    sides = confusion.select(
        F.explode(
            F.array(
                F.struct(F.col("actual").alias("label"), F.col("n").alias("actual"), F.lit(0).cast("long").alias("guessed"), F.lit(0).cast("long").alias("hit")),
                F.struct(
                    F.col("predicted").alias("label"), F.lit(0).cast("long").alias("actual"), F.col("n").alias("guessed"),
                    F.when(F.col("actual") == F.col("predicted"), F.col("n")).otherwise(0).alias("hit"),
                ),
            )
        ).alias("s")
    ).select("s.*")
    sums = sides.groupBy("label").agg(*[F.sum(c).alias(c) for c in ("actual", "guessed", "hit")])
    zero = F.lit(0.0)
    return sums.select(
        "label",
        F.coalesce(F.try_divide("hit", "guessed"), zero).alias("precision"),
        F.coalesce(F.try_divide("hit", "actual"), zero).alias("recall"),
        F.coalesce(F.try_divide(2 * F.col("hit"), F.col("actual") + F.col("guessed")), zero).alias("f1"),
        F.col("actual").alias("support"),
    )


def classifier_metrics(confusion: DataFrame) -> DataFrame:
    """One row: accuracy and support-weighted precision, recall and F1 (four digits)."""
    weighted = lambda c: F.sum(F.col(c) * F.col("support")) / F.sum("support")
    report = class_report(confusion).agg(
        weighted("precision").alias("precision"), weighted("recall").alias("recall"), weighted("f1").alias("f1_weighted")
    )
    correct = confusion.agg((F.sum(F.when(F.col("actual") == F.col("predicted"), F.col("n")).otherwise(0)) / F.sum("n")).alias("a"))
    return report.select(
        np_round(correct.select("a").scalar(), 4).alias("accuracy"), *[np_round(F.col(c), 4).alias(c) for c in report.columns]
    )
