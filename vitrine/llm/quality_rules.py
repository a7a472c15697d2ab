"""Quality rules as weak supervision, in DataFrame functions only.

Each rule votes keep, votes reject or abstains on a document. Expectation maximisation over the
counts of vote patterns estimates how each rule votes on good and on bad documents, and the
posterior probability of "good" replaces an all-must-pass filter. R rules have at most 3^R
patterns whatever the corpus, so a round is one small aggregate; the corpus is read once for the
measures and nothing is shuffled but partial counts of patterns.

Rows: a null text has no words; a null id is carried along; repeated rows get the same verdict;
an empty table gives an empty result; further columns are not read.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..stages import stage
from .common import SPACES, kept_rows, let, text_or_empty, without

WINDOW_WORDS = 8
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
ROUNDS = 20
#: Posterior of "good" from which a document is kept.
THRESHOLD = 0.5

MEASURES = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_stutters", "n_shouts"]


@dataclass(frozen=True)
class Rule:
    """SQL conditions over the measures; a document that meets neither gets an abstention."""

    name: str
    reject: str
    keep: str


# Whole-number comparisons, so that every engine decides alike. The first three look at one kind
# of noise, the next three at what any noise does to the text, so that every kind of bad document
# is seen by more than one rule: agreement is what the accuracies are estimated from.
_NOISE = "n_symbols + n_shouts + n_stutters"
RULES = [
    Rule("symbols", "5 * n_symbols > n_words", "50 * n_symbols <= n_words"),
    Rule("shouting", "5 * n_shouts > n_words", "50 * n_shouts <= n_words"),
    Rule("stutter", "10 * n_stutters > n_words", "50 * n_stutters <= n_words"),
    Rule("noise", f"5 * ({_NOISE}) > n_words", f"20 * ({_NOISE}) <= n_words"),
    Rule("density", f"40 * ({_NOISE}) > word_chars", f"100 * ({_NOISE}) <= word_chars"),
    Rule("repeats", "100 * n_repeat_words > 25 * n_words", "100 * n_repeat_words <= 10 * n_words"),
    Rule("word_size", "word_chars > 15 * n_words OR word_chars < 2 * n_words", "word_chars BETWEEN 3 * n_words AND 12 * n_words"),
]


def _repeat_words(hashes: Column) -> Column:
    """Words inside windows that occur twice or more; ``hashes`` has one number a word."""
    w = WINDOW_WORDS
    windows = F.transform(F.sequence(F.lit(1), F.size(hashes) - (w - 1)), lambda i: F.xxhash64(F.slice(hashes, i, w)))

    def covered(starts: Column) -> Column:
        """Words under windows of w words that begin at the sorted ``starts``."""
        steps = F.transform(starts, lambda a, k: F.least(F.lit(w), F.coalesce(F.get(starts, k + 1) - a, F.lit(w))))
        return F.aggregate(steps, F.lit(0), lambda total, step: total + step)

    def repeated(found: Column) -> Column:
        """Starts of windows whose hash has an equal neighbour in sorted order."""
        ordered = F.sort_array(F.transform(found, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        starts = let(
            ordered,
            lambda o: F.transform(F.filter(o, lambda e, j: (F.get(o, j - 1)["h"] == e["h"]) | (F.get(o, j + 1)["h"] == e["h"])), lambda e: e["i"]),
        )
        return let(F.sort_array(starts), covered)

    count = let(windows, lambda f: F.when(F.size(F.array_distinct(f)) == F.size(f), F.lit(0)).otherwise(repeated(f)))
    return F.when(F.size(hashes) < w, F.lit(0)).otherwise(count).cast("long")


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, text_hash and the measures of every whole text, each a long."""
    source = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    parts = source.select(
        "*",
        F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda x: x != "").alias("words"),
        F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("lines"),
    )
    parts = parts.withColumn("hashes", F.transform("words", lambda x: F.xxhash64(x)))
    hashes = F.col("hashes")
    return parts.select(
        "id",
        F.xxhash64("text").alias("text_hash"),
        F.size("words").cast("long").alias("n_words"),
        F.char_length(without(F.col("text"), SPACES)).cast("long").alias("word_chars"),
        (F.char_length("text") - F.char_length(without(F.col("text"), SYMBOLS))).cast("long").alias("n_symbols"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        _repeat_words(hashes).alias("n_repeat_words"),
        F.size(F.filter(hashes, lambda h, i: h == F.get(hashes, i - 1))).cast("long").alias("n_stutters"),
        ((F.char_length("text") - F.char_length(F.replace("text", F.lit("!!")))) / 2).cast("long").alias("n_shouts"),
    )


def vote(rule: Rule) -> Column:
    """0 reject, 1 keep, 2 abstain."""
    return F.expr(f"CASE WHEN {rule.reject} THEN 0 WHEN {rule.keep} THEN 1 ELSE 2 END")


def _posterior(names: list[str], share: float, good: list[list[float]], bad: list[list[float]]) -> Column:
    """Probability of "good" given the votes, from the class share and P(vote | class).

    An abstention says nothing about the class.
    """
    odds = F.lit(math.log(share) - math.log(1 - share))
    for name, g, b in zip(names, good, bad, strict=True):
        ratio = [math.log(x) - math.log(y) for x, y in zip(g, b, strict=True)]
        odds = odds + F.when(F.col(name) == 0, ratio[0]).when(F.col(name) == 1, ratio[1]).otherwise(0.0)
    return 1 / (1 + F.exp(-odds))


def _shares(rejects: float, keeps: float) -> list[float]:
    return [(rejects + 1) / (rejects + keeps + 2), (keeps + 1) / (rejects + keeps + 2)]


def fit(patterns: DataFrame, names: list[str], rounds: int = ROUNDS) -> Column:
    """The posterior as an expression over the vote columns.

    ``patterns`` has the votes and ``n``, the number of documents with them. The first round
    trusts every reject vote (0.05 against 0.95), the later ones what the data say; one document
    is added to every count of votes, so no probability is 0.
    """
    any_reject = F.lit(False)
    for name in names:
        any_reject = any_reject | (F.col(name) == 0)
    posterior = F.when(any_reject, F.lit(0.05)).otherwise(F.lit(0.95))
    for _ in range(rounds):
        scored = patterns.withColumn("p", posterior)
        sums = [F.sum(F.col("n") * F.col("p")).alias("good"), F.sum(F.col("n") * (1 - F.col("p"))).alias("bad")]
        for name in names:
            for v in range(2):
                hit = (F.col(name) == v).cast("int")
                sums += [F.sum(F.col("n") * F.col("p") * hit).alias(f"g_{name}_{v}"), F.sum(F.col("n") * (1 - F.col("p")) * hit).alias(f"b_{name}_{v}")]
        row = scored.agg(*sums).first()
        if row["good"] is None:  # no documents
            return posterior
        good = [_shares(row[f"g_{name}_0"], row[f"g_{name}_1"]) for name in names]
        bad = [_shares(row[f"b_{name}_0"], row[f"b_{name}_1"]) for name in names]
        posterior = _posterior(names, (row["good"] + 1) / (row["good"] + row["bad"] + 2), good, bad)
    return posterior


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: list[Rule] | None = None, rounds: int = ROUNDS) -> DataFrame:
    """One row per input row: id, text_hash, the measures, base_failed, posterior, kept."""
    rules = RULES if rules is None else rules
    names = [f"vote_{r.name}" for r in rules]
    measures = stage(measure(docs, id_col, text_col), "measures")
    voted = measures.withColumns({name: vote(r) for name, r in zip(names, rules, strict=True)})
    patterns = stage(voted.groupBy(*names).agg(F.count("*").alias("n")), "patterns")
    quality = fit(patterns, names, rounds)
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    judged = voted.withColumns({"base_failed": failed, "posterior": quality})
    return judged.withColumn("kept", ~F.col("base_failed") & (F.col("posterior") >= THRESHOLD)).withColumnRenamed("id", id_col)


def keep_good(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that are kept, all their columns as they are."""
    kept = judge(docs, id_col, text_col, **options).filter("kept")
    kept = kept.select(F.col(id_col).alias("id"), "text_hash").distinct()
    keys = {"id": F.col(id_col), "text_hash": F.xxhash64(text_or_empty(text_col))}
    return kept_rows(docs, kept, keys).select("row.*")


def oracle(source: str = "documents", rounds: int = ROUNDS) -> str:
    """DuckDB SQL for the query's rows; each round of expectation maximisation is two steps."""
    names = [f"vote_{r.name}" for r in RULES]
    steps = [
        rf"""d AS (SELECT doc_id, row_number() OVER () AS rid, coalesce(text, '') AS t FROM {source})""",
        r"""w AS (SELECT rid, list_filter(string_split_regex(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words,
            list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d)""",
        """u AS (SELECT rid, unnest(words) AS word, generate_subscripts(words, 1) AS i FROM w)""",
        f"""g AS (SELECT rid, i, list(word) OVER (PARTITION BY rid ORDER BY i ROWS BETWEEN CURRENT ROW AND {WINDOW_WORDS - 1} FOLLOWING) AS gram,
            word = lag(word) OVER (PARTITION BY rid ORDER BY i) AS again FROM u)""",
        f"""r AS (SELECT rid, i FROM g WHERE len(gram) = {WINDOW_WORDS} QUALIFY count(*) OVER (PARTITION BY rid, gram) > 1)""",
        f"""c AS (SELECT rid, count(DISTINCT i + k) AS n_repeat_words FROM r, range({WINDOW_WORDS}) AS s(k) GROUP BY rid)""",
        """a AS (SELECT rid, count(*) FILTER (again) AS n_stutters FROM g GROUP BY rid)""",
        rf"""m AS MATERIALIZED (SELECT doc_id, len(words) AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
            length(t) - length(regexp_replace(t, '[{SYMBOLS}]', '', 'g')) AS n_symbols, len(lines) AS n_lines,
            len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
            coalesce(n_stutters, 0) AS n_stutters, (length(t) - length(replace(t, '!!', ''))) // 2 AS n_shouts
            FROM d JOIN w USING (rid) LEFT JOIN c USING (rid) LEFT JOIN a USING (rid))""",
        "v AS MATERIALIZED (SELECT *, "
        + ", ".join(f"CASE WHEN {r.reject} THEN 0 WHEN {r.keep} THEN 1 ELSE 2 END AS {n}" for r, n in zip(RULES, names, strict=True))
        + " FROM m)",
        f"e0 AS MATERIALIZED (SELECT {', '.join(names)}, count(*) AS n, CASE WHEN {' OR '.join(f'{n} = 0' for n in names)} THEN 0.05::DOUBLE ELSE 0.95::DOUBLE END AS p"
        f" FROM v GROUP BY {', '.join(names)})",
    ]
    for k in range(1, rounds + 1):
        sums = ["sum(n * p) AS good", "sum(n * (1 - p)) AS bad"]
        odds = ["ln((good + 1) / (bad + 1))"]
        for name in names:
            for v in range(2):
                sums += [f"sum(n * p * ({name} = {v})::INT) AS g_{name}_{v}", f"sum(n * (1 - p) * ({name} = {v})::INT) AS b_{name}_{v}"]
            odds.append(f"CASE {name} " + " ".join(f"WHEN {v} THEN ln((g_{name}_{v} + 1) / (g_{name}_0 + g_{name}_1 + 2)) - ln((b_{name}_{v} + 1) / (b_{name}_0 + b_{name}_1 + 2))" for v in range(2)) + " ELSE 0 END")
        steps.append(f"s{k} AS MATERIALIZED (SELECT {', '.join(sums)} FROM e{k - 1})")
        steps.append(f"e{k} AS MATERIALIZED (SELECT {', '.join(names)}, n, 1 / (1 + exp(-({' + '.join(odds)}))) AS p FROM e{k - 1}, s{k})")
    failed = f"(n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words)"
    return (
        "WITH " + ",\n".join(steps) + f"\nSELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, {failed} AS base_failed,"
        f" NOT {failed} AND p >= {THRESHOLD} AS kept FROM v JOIN e{rounds} USING ({', '.join(names)})"
    )
