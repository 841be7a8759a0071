"""Importance resampling towards a target: hashed n-grams, log ratios, Gumbel top share.

Features of a text are its words and pairs of neighbouring words, in lower case, repeats counted;
a feature's bucket is the CRC-32 of its UTF-8 bytes modulo `buckets`. A bucket's gain is the
logarithm of how much more often the target has it than the documents do (both smoothed), in
thousandths and rounded down. A document's weight is the mean gain of its features, rounded down; its score
adds Gumbel noise that a hash of its id gives. The highest scores of a share of all documents
with enough words are drawn, which is sampling without replacement by the weights.

Head and tail. A CRC can be carried on: the state behind "word " and the bytes of the next word
give the pair's. The frequent words' own buckets and states behind a blank, and the buckets of
frequent pairs of them, are broadcast: at most `head_words` words of `HEAD_BYTES` bytes and
`head_pairs` pairs. They are looked up by array; a pair outside goes on from its first word's state,
and a word outside is hashed directly. All give the same exact buckets, so the head decides the speed
alone, never a result; that is why `head_rows` sampled rows are enough to choose it.

Buckets of every feature are staged, two bytes each, so texts are read once and totals are exact:
tasks add up arrays of `buckets` counts, and only these reach the driver. Ranks come from a sort in
ranges (`scan`), whose rows are a few numbers each.

Null texts have no features; null and empty texts have weight 0 and, having no words, are never drawn.
Very long texts are taken apart in blocks, with pairs over the seams. Ties go to the smaller id, null
ids last (their noise is that of the id ""), and repeated rows take ranks of their own. An empty table gives an
empty result; an empty target makes all gains follow from smoothing alone. Columns that are carried
travel in one struct, so names can't clash.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from qadump.llm.common import blocks, small_batches, staged
from qadump.llm.scan import ordered, running

#: A-Z to lower case, what no word holds to a blank; bytes above 127 belong to letters and stay.
_WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b > 127 else 32 for b in range(256)
)
#: Longer words are never in the head.
HEAD_BYTES = 64


def words_of(text: str | None) -> Iterator[list[bytes]]:
    """The words of a text in runs; each run but the first begins with the last word of the one before."""
    last: list[bytes] = []
    for block in blocks(text or ""):
        words = block.encode("utf-8").translate(_WORD_BYTES).split()
        if words:
            yield last + words
            last = words[-1:]


@dataclass(frozen=True)
class Head:
    """What is known of frequent words and pairs; any choice gives the same buckets."""

    index: dict[bytes, int]
    word_buckets: np.ndarray
    #: CRC state behind the word and a blank.
    states: np.ndarray
    #: first index * words + second index, ascending, and the pair's bucket
    pairs: np.ndarray
    pair_buckets: np.ndarray
    buckets: int

    @classmethod
    def of(cls, words: list[bytes], pairs: list[tuple[bytes, bytes]], buckets: int) -> Head:
        words = sorted(set(words))
        index = {word: k for k, word in enumerate(words)}
        known = sorted({(index[a], index[b]) for a, b in pairs if a in index and b in index})
        crcs = np.array([zlib.crc32(w) for w in words], dtype=np.int64)
        return cls(
            index,
            crcs % buckets,
            np.array([zlib.crc32(b" ", int(c)) for c in crcs], dtype=np.int64),
            np.array([a * len(words) + b for a, b in known], dtype=np.int64),
            np.array([zlib.crc32(words[a] + b" " + words[b]) % buckets for a, b in known], dtype=np.int64),
            buckets,
        )

    def run(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Buckets of a run's words, and of its pairs."""
        crc32, count = zlib.crc32, len(words)
        get = self.index.get
        ids = np.fromiter((get(w, -1) for w in words), dtype=np.int64, count=count)
        tail = np.flatnonzero(ids < 0)
        singles, states = np.empty(count, dtype=np.int64), np.empty(count, dtype=np.int64)
        head = np.flatnonzero(ids >= 0)
        singles[head], states[head] = self.word_buckets[ids[head]], self.states[ids[head]]
        crcs = [crc32(words[k]) for k in tail.tolist()]
        singles[tail] = np.array(crcs, dtype=np.int64) % self.buckets
        states[tail] = [crc32(b" ", c) for c in crcs]
        pairs = np.full(max(0, count - 1), -1, dtype=np.int64)
        if len(self.pairs) and count > 1:
            key = np.where((ids[:-1] < 0) | (ids[1:] < 0), -1, ids[:-1] * len(self.index) + ids[1:])
            at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
            pairs = np.where(self.pairs[at] == key, self.pair_buckets[at], -1)
        unseen = np.flatnonzero(pairs < 0)
        went_on = zip(unseen.tolist(), states[unseen].tolist(), strict=True)
        pairs[unseen] = np.array([crc32(words[k + 1], state) for k, state in went_on], dtype=np.int64) % self.buckets
        return singles, pairs

    def text(self, text: str | None) -> tuple[int, np.ndarray]:
        """The number of words, and the buckets of all features."""
        count, found = 0, []
        for words in words_of(text):
            singles, pairs = self.run(words)
            new = singles[1:] if found else singles  # the first was the run before's last
            count += len(new)
            found += [new, pairs]
        return count, np.concatenate(found) if found else np.empty(0, dtype=np.int64)


def head_of(docs: DataFrame, buckets: int, head_rows: int, head_words: int, head_pairs: int, text: str) -> Head:
    """The frequent words and pairs of about `head_rows` rows, drawn row by row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            counts: Counter = Counter()
            for body in batch.column(0).to_pylist():
                for words in words_of(body):
                    short = [w if len(w) <= HEAD_BYTES else None for w in words]
                    counts.update((w, b"") for w in short if w)
                    counts.update(p for p in zip(short, short[1:], strict=False) if p[0] and p[1])
            columns = [pa.array([k[i] for k in counts], pa.binary()) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(list(counts.values()), pa.int64())], names=["a", "b", "n"])

    share = min(1.0, head_rows / max(1, docs.count()))
    # By rows, not by a hash of them: a row with many copies counts as often as it is drawn.
    sample = docs.select(F.col(text).alias("text")).where(F.rand(7) < share)
    counted = staged(
        sample.mapInArrow(run, "a binary, b binary, n long").groupBy("a", "b").agg(F.sum("n").alias("n")), "head"
    )
    single = F.length("b") == 0
    words = counted.where(single).orderBy(F.desc("n"), "a").limit(head_words).collect()
    pairs = counted.where(~single).orderBy(F.desc("n"), "a", "b").limit(head_pairs).collect()
    return Head.of([bytes(r.a) for r in words], [(bytes(r.a), bytes(r.b)) for r in pairs], buckets)


def hashed(docs: DataFrame, head: Head, text: str, carried: Sequence[str]) -> DataFrame:
    """row (a struct of the carried columns), n_words, n_features and features (the buckets, packed), staged."""
    shared = docs.sparkSession.sparkContext.broadcast(head)  # bounded by head_words and head_pairs
    kind = "<u2" if head.buckets <= 1 << 16 else "<u4"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in small_batches(batches):
            found = [own.text(body) for body in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("row"),
                    pa.array([count for count, _ in found], pa.int64()),
                    pa.array([len(b) for _, b in found], pa.int64()),
                    pa.array([b.astype(kind).tobytes() for _, b in found], pa.binary()),
                ],
                names=["row", "n_words", "n_features", "features"],
            )

    rows = docs.select(F.struct(*carried).alias("row"), F.col(text).alias("text"))
    row_kind = rows.schema["row"].dataType.simpleString()
    return staged(rows.mapInArrow(run, f"row {row_kind}, n_words long, n_features long, features binary"), "features")


def totals(features: DataFrame, buckets: int) -> np.ndarray:
    """How many features each bucket has."""
    kind = "<u2" if buckets <= 1 << 16 else "<u4"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            for packed in batch.column(0):
                counts += np.bincount(np.frombuffer(packed.as_buffer(), dtype=kind), minlength=buckets)
        some = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(counts[some])], names=["bucket", "n"])

    counted = features.select("features").mapInArrow(run, "bucket long, n long")
    found = np.zeros(buckets, dtype=np.int64)
    for row in counted.groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # one row a bucket
        found[row.bucket] = row.n
    return found


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln((t + 1)(S + buckets) / ((s + 1)(T + buckets)))) of every bucket."""
    buckets = float(len(source))
    of_source, of_target = float(source.sum()) + buckets, float(target.sum()) + buckets
    ratios = ((t + 1.0) * of_source / ((s + 1.0) * of_target) for s, t in zip(source.tolist(), target.tolist(), strict=True))
    return np.array([math.floor(1000 * math.log(ratio)) for ratio in ratios], dtype=np.int64)


def noise(doc_id: int | None, seed: int) -> int:
    """Gumbel noise of an id, in thousandths, rounded down."""
    name = "" if doc_id is None else doc_id
    h = int(hashlib.sha256(f"{seed}:{name}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def resampled(
    docs: DataFrame,
    target: DataFrame,
    share: int = 25,
    least_words: int = 20,
    buckets: int = 10_000,
    seed: int = 7,
    head_rows: int = 2_000,
    head_words: int = 20_000,
    head_pairs: int = 50_000,
    doc_id: str = "doc_id",
    text: str = "text",
    target_text: str = "text",
    carried: Sequence[str] = (),
) -> DataFrame:
    """doc_id, n_features, weight, score, rank (null if not drawn) and row (the carried columns) of every row.

    share: per cent of the documents with `least_words` words or more that are drawn.
    """
    head = head_of(docs, buckets, head_rows, head_words, head_pairs, text)
    key = F.col(doc_id).cast("long").alias("doc_id")
    features = hashed(docs, head, text, [key, *([F.struct(*carried).alias("carried")] if carried else [])])
    wanted = hashed(target, head, target_text, [F.lit(1).alias("one")])
    shared = docs.sparkSession.sparkContext.broadcast(gains(totals(features, buckets), totals(wanted, buckets)))
    kind = "<u2" if buckets <= 1 << 16 else "<u4"

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain = shared.value
        for batch in batches:
            sums = [int(gain[np.frombuffer(b.as_buffer(), dtype=kind)].sum()) for b in batch.column("features")]
            weights = [s // n if n else 0 for s, n in zip(sums, batch.column("n_features").to_pylist(), strict=True)]
            ids = batch.column("row").field("doc_id").to_pylist()
            scores = [w + noise(i, seed) for w, i in zip(weights, ids, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*map(batch.column, ("row", "n_words", "n_features")), pa.array(weights, pa.int64()), pa.array(scores, pa.int64())],
                names=["row", "n_words", "n_features", "weight", "score"],
            )

    row_kind = features.schema["row"].dataType.simpleString()
    weighed = features.mapInArrow(weigh, f"row {row_kind}, n_words long, n_features long, weight long, score long")
    fit = F.col("n_words") >= least_words
    order = [fit.desc(), F.desc("score"), F.col("row.doc_id").asc_nulls_last()]
    parts = ordered(weighed, order, "importance")
    drawn = parts.where(fit).count() * share // 100
    placed = running(parts, {"nth": fit.cast("long")})
    return placed.select(
        "row.doc_id",
        "n_features",
        "weight",
        "score",
        F.when(fit & (F.col("nth") <= drawn), F.col("nth")).alias("rank"),
        *([F.col("row.carried").alias("row")] if carried else []),
    )
