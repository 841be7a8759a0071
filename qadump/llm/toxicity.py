"""Toxicity: non-negative positive-unlabelled learning of a linear classifier.

Only confirmed toxic documents carry a label that is learned from; all else is unlabelled
text, which holds toxic documents too, in the proportion of the class prior. The risk is
prior * R+(positives) + max(0, R-(unlabelled) - prior * R-(positives)): the second part
estimates the risk on clean text, which can't be negative; where the estimate is (a sign of
overfitting), its slope is not followed. Loss: logistic. Model: weights of features, trained
in numpy by Adam.

Features: a text has so many words that hold a given part (1, 2 or 4 and more). Parts of a word, a
run of letters, are its first 4 to 10 letters, or a shorter word as a whole; those of a longer run
are also all pairs of neighbouring letters and all runs of 4 letters in it, to its last letter. So scripts
without blanks, where a sentence is one run, are read whole. All features whose share among
positives exceeds that among unlabelled texts by `least_errors` standard errors or more are
kept; the sample bounds how many there can be. Features of fewer than 3 confirmed texts, or than 0.2 % of
them, are not tried: with so few, chance alone gives such shares.

Training uses a sample of both sets, `sample_rows` each at most in expectation (a documented bound of the
fit: it keeps the training set of fixed size). Unlabelled rows are drawn row by row, confirmed
ones id by id, one row each: that of the smallest text hash where an id repeats. So no id or text with
many copies makes the sample larger. The class prior is the share of toxic ones among the labelled
ids that may be used. Scoring reads every row and the whole text, very long ones in blocks.

Null and empty texts have no words and score what the bias alone gives. Null ids are never held
out and match no label; a repeated id is toxic if any of its labels is; rows that repeat are scored each for itself.
Without positives, or without documents, nothing can be learned and all scores are 0 (an empty table has none). A
score of exactly 0.5 counts as toxic. Only id and text are read of the documents, so other columns can't clash.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from qadump.llm.common import blocks, bucket_of, draw, small_batches, staged, used_up

LETTERS = regex.compile(r"\p{L}[\p{L}\p{M}]*")


LEVELS = (1, 2, 4)
SHORTEST, LONGEST = 4, 10
#: Lengths of the runs of letters that longer words are taken apart into, all positions.
INNER = (2, 4)
#: Words kept with their parts by a scoring task.
MEMORY = 200_000


def parts(word: str) -> list[str]:
    """What features of a word are made of; a repeated run of letters counts as often."""
    if len(word) < SHORTEST:
        return [word + "$"]
    found = [word[:k] for k in range(SHORTEST, min(len(word), LONGEST) + 1)]
    if len(word) > LONGEST:
        found += ["*" + word[k : k + n] for n in INNER for k in range(len(word) - n + 1)]
    return found


def words_of(text: str | None) -> Counter:
    words: Counter = Counter()
    for block in blocks(text or ""):
        words.update(LETTERS.findall(block.lower()))
    return words


def _levels(counts: Counter) -> set[str]:
    return {f"{part}{level}" for part, times in counts.items() for level in LEVELS if times >= level}


def features(text: str | None) -> set[str]:
    """Features of a text, such as "part2" for a part that occurs twice or more."""
    counts: Counter = Counter()
    for word, times in words_of(text).items():
        for part in parts(word):
            counts[part] += times
    return _levels(counts)


class Model:
    def __init__(self, weights: dict[str, float], bias: float):
        self.weights, self.bias = weights, bias
        self.known = {f[:-1] for f in weights}
        #: Known parts of words that were seen; most words have none.
        self.seen: dict[str, tuple[str, ...]] = {}

    def margin(self, text: str | None) -> float:
        if not self.weights:
            return self.bias
        counts: Counter = Counter()
        for word, times in words_of(text).items():
            found = self.seen.get(word)
            if found is None:
                if len(self.seen) >= MEMORY:
                    self.seen.clear()
                found = self.seen[word] = tuple(p for p in parts(word) if p in self.known)
            for part in found:
                counts[part] += times
        return self.bias + sum(self.weights.get(f, 0.0) for f in sorted(_levels(counts)))


def _rows(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Feature indices of all texts behind each other, and the text of each."""
    sizes = np.fromiter(map(len, sets), dtype=np.int64, count=len(sets))
    flat = np.concatenate([*sets, np.empty(0, dtype=np.int64)]).astype(np.int64)
    return flat, np.repeat(np.arange(len(sets)), sizes)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


Texts = tuple[np.ndarray, np.ndarray, int]


def risks(theta: np.ndarray, positive: Texts, unlabelled: Texts, prior: float) -> tuple[float, float, np.ndarray, np.ndarray]:
    """The risk on toxic text, the estimated risk on clean text (can be negative), and the slopes of both.

    theta: weights of the features, then the bias. Texts: feature indices behind each other, the text
    of each, the number of texts.
    """

    def margins(flat: np.ndarray, text: np.ndarray, count: int) -> np.ndarray:
        return theta[-1] + np.bincount(text, theta[flat], count)

    def slope(texts: Texts, each: np.ndarray) -> np.ndarray:
        grad = np.bincount(texts[0], each[texts[1]], len(theta))
        grad[-1] = each.sum()
        return grad

    p_margin, u_margin = margins(*positive), margins(*unlabelled)
    # Logistic losses: log(1 + exp(-m)) for the label +1, log(1 + exp(m)) for -1.
    toxic = prior * np.logaddexp(0, -p_margin).mean()
    clean = np.logaddexp(0, u_margin).mean() - prior * np.logaddexp(0, p_margin).mean()
    up = prior * slope(positive, (_sigmoid(p_margin) - 1) / positive[2])
    down = slope(unlabelled, _sigmoid(u_margin) / unlabelled[2]) - prior * slope(
        positive, _sigmoid(p_margin) / positive[2]
    )
    return float(toxic), float(clean), up, down


def fit(
    positive: list[np.ndarray],
    unlabelled: list[np.ndarray],
    words: int,
    prior: float,
    rounds: int = 400,
    batches: int = 1,
    rate: float = 0.05,
    slack: float = 0.02,
    seed: int = 7,
) -> tuple[np.ndarray, float]:
    """Weights of the features and the bias that minimise the non-negative risk.

    slack: how far below 0 the estimated risk on clean text may fall. Weights decay the more,
    the fewer the positives.
    """
    decay = 0.5 / len(positive)
    rng = np.random.default_rng(seed)
    theta = np.zeros(words + 1)
    theta[words] = np.log(prior / (1 - prior))
    first, second, step = np.zeros(words + 1), np.zeros(words + 1), 0
    for _ in range(rounds):
        p_parts = np.array_split(rng.permutation(len(positive)), batches)
        u_parts = np.array_split(rng.permutation(len(unlabelled)), batches)
        for p_part, u_part in zip(p_parts, u_parts, strict=True):
            if not len(p_part) or not len(u_part):
                continue
            p = (*_rows([positive[i] for i in p_part]), len(p_part))
            u = (*_rows([unlabelled[i] for i in u_part]), len(u_part))
            _, clean, up, down = risks(theta, p, u, prior)
            grad = up + down if clean >= -slack else up
            grad[:words] += decay * theta[:words]
            step += 1
            first = 0.9 * first + 0.1 * grad
            second = 0.999 * second + 0.001 * grad**2
            ahead = first / (1 - 0.9**step)
            theta -= rate * ahead / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return theta[:words], float(theta[words])


def sampled(docs: DataFrame, labels: DataFrame, usable: Column, sample_rows: int) -> tuple[DataFrame, float]:
    """text, confirmed (of a sample of toxic ids) and drawn (of a sample of all rows); the class prior.

    docs: doc_id and text; labels: doc_id and toxic; usable: which ids labels are read of.
    """
    known = (
        labels.where(usable & F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.max("toxic").alias("toxic"))
    )
    counts = known.agg(F.count("*").alias("all"), F.count(F.when(F.col("toxic") == 1, 1)).alias("toxic")).first()
    # About sample_rows ids, whatever the size of the labels: these are unique.
    at = F.pmod(F.xxhash64(F.lit("toxic"), "doc_id"), F.lit(1 << 30)) / (1 << 30)
    chosen = known.where((F.col("toxic") == 1) & (at * counts["toxic"] < sample_rows)).select("doc_id")
    own = docs.where(usable)
    # One row an id, found in the map tasks: an id with a third of all rows sends one row a task.
    confirmed = (
        own.join(F.broadcast(chosen), "doc_id")
        .groupBy("doc_id")
        .agg(F.min_by("text", F.xxhash64("text")).alias("text"))
        .select("text", F.lit(True).alias("confirmed"))
    )
    drawn = own.where(draw("unlabelled") * docs.count() < sample_rows).select("text", F.lit(False).alias("confirmed"))
    return staged(confirmed.unionByName(drawn), "toxicity"), counts["toxic"] / max(1, counts["all"])


def _telling(sample: DataFrame, n_positive: int, n_unlabelled: int, least_errors: float) -> list[str]:
    """Features whose share among positives exceeds that among unlabelled texts by enough standard errors.

    Counted in Spark; only these features reach the driver, which a sample of fixed size bounds.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, most_bytes=500_000):
            positive, unlabelled = Counter(), Counter()
            for text, confirmed in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                (positive if confirmed else unlabelled).update(features(text))
            found = list(positive | unlabelled)
            counts = [pa.array([c[f] for f in found], pa.int64()) for c in (positive, unlabelled)]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.string()), *counts], names=["feature", "p", "u"])

    counted = (
        sample.select("text", "confirmed")
        .mapInArrow(run, "feature string, p long, u long")
        .groupBy("feature")
        .agg(F.sum("p").alias("p"), F.sum("u").alias("u"))
    )
    share = F.greatest(F.col("u") / n_unlabelled, F.lit(1 / n_unlabelled))
    error = F.sqrt(share * (1 / n_positive + 1 / n_unlabelled))
    excess = (F.col("p") / n_positive - F.col("u") / n_unlabelled) / error
    least_texts = max(3, n_positive // 500)
    found = counted.where((F.col("p") >= least_texts) & (excess >= least_errors)).select("feature").toArrow()
    return sorted(found.column(0).to_pylist())


def train(
    docs: DataFrame,
    labels: DataFrame,
    usable: Column,
    sample_rows: int = 3_000,
    least_errors: float = 4.0,
    **settings,
) -> Model:
    sample, prior = sampled(docs, labels, usable, sample_rows)
    sizes = {r.confirmed: r["count"] for r in sample.groupBy("confirmed").count().collect()}
    if len(sizes) < 2:
        return Model({}, -60.0)
    names = _telling(sample, sizes[True], sizes[False], least_errors)
    if not names:
        return Model({}, -60.0)
    index = {f: i for i, f in enumerate(names)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            found = [sorted(index[f] for f in features(t) if f in index) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(1), pa.array(found, pa.list_(pa.int32()))], names=["confirmed", "found"]
            )

    rows = sample.select("text", "confirmed").mapInArrow(run, "confirmed boolean, found array<int>").toArrow()
    # A sample of fixed size, sorted, as rows come back from Spark in any order.
    texts = sorted(zip(rows.column("found").to_pylist(), rows.column("confirmed").to_pylist(), strict=True))
    used_up(sample)
    positive = [np.array(t, dtype=np.int64) for t, confirmed in texts if confirmed]
    unlabelled = [np.array(t, dtype=np.int64) for t, confirmed in texts if not confirmed]
    weights, bias = fit(positive, unlabelled, len(names), min(max(prior, 1e-3), 0.9), **settings)
    return Model({f: float(w) for f, w in zip(names, weights, strict=True)}, bias)


def score_column(spark: SparkSession, model: Model, text: str) -> Column:
    """The probability of toxicity of a text column, 0 to 1."""
    shared = spark.sparkContext.broadcast(model)  # weights of the features that the sample supports

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        own = shared.value
        margins = np.fromiter((own.margin(t.as_py()) for t in texts), dtype=np.float64, count=len(texts))
        return pa.array(_sigmoid(margins))

    return score(F.col(text))


def score_texts(
    docs: DataFrame,
    labels: DataFrame,
    folds: int = 5,
    held: int = 0,
    doc_id: str = "doc_id",
    text: str = "text",
    **settings,
) -> DataFrame:
    """doc_id, held_out, score and predicted of every row; labels of held-out ids are not read."""
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    model = train(rows, labels, bucket_of("doc_id", folds) != held, **settings)
    scored = rows.withColumn("score", score_column(docs.sparkSession, model, "text"))
    return scored.select(
        "doc_id",
        (bucket_of("doc_id", folds) == held).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
