"""Language ID: unigrams of pieces, marginalised over segmentations.

A word can be cut into pieces of a fixed public vocabulary in many ways. A language gives every
piece a probability, and a word the sum over all its segmentations of the product of their
pieces' probabilities, which a forward pass over the word's characters finds. A text's words
are independent, so its log likelihoods add up; the language with the largest wins, and the score
is its share of the likelihoods (the posterior under equal priors).

Training: expectation maximisation. A backward pass beside the forward one gives the expected
count of each piece in all segmentations of the training words, whatever their length; smoothed counts are
the next probabilities. It runs on the words of a sample of labelled rows: `sample_rows` a
language in expectation, drawn row by row (the bound is a parameter, as the pieces
are a fixed vocabulary); their words are counted by Spark. A language's counts depend on its own words alone, so
each language is fitted in a task, which returns the pieces it has seen. Every language is learned.

Scoring covers every row and the whole text. Languages go through in blocks of `block`, whose tables
are what the driver and the tasks hold; with more languages than that, each block's best and the logarithm of its
summed likelihoods are staged for every row and then joined by a sum over the blocks. The result is that of one block.

Words are letters and the letters and marks that follow, lower-cased; characters outside the
vocabulary cost as much as byte pieces. Texts that are null or have no letter are `und` with score 0. Very long
texts are read in blocks, and runs of letters of any length at about the cost of short words a letter. Of
languages that are equally likely the first in code point order wins. Null ids are never held out and
repeated rows are scored each for itself; without labelled rows all texts are `und`, and an empty
table gives an empty result. Only the id, text and lang columns are read, lang for training alone, so other columns can't clash.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import public_tokenizers
import regex
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from qadump.llm.common import blocks, bucket_of, draw, small, small_batches, staged

LETTERS = regex.compile(r"\p{L}[\p{L}\p{M}]*")
START = "▁"  # what the vocabulary writes for the blank before a word
UNDETERMINED = "und"
#: Likelihoods (words x languages) that a scoring task keeps.
MEMORY = 600_000
#: Longer words are rescaled while they are scored or learned from, so that no probability underflows.
SHORT = 24
#: Characters x languages of longer words that are learned from at a time.
LONG_CELLS = 2_000_000
#: Longer words that are scored together, and how much longer the longest may be than the shortest.
LONG_WORDS, LONG_SPREAD = 256, 1.5
#: Characters before the states of longer words are rescaled.
RESCALED = 16
#: Added to the expected count of every piece.
SMOOTHING = 0.05
_BASE = np.uint64(0x9E3779B97F4A7C15)


def words(text: str | None) -> list[str]:
    return LETTERS.findall(text.lower()) if text else []


def counted_words(text: str | None) -> Counter:
    counts: Counter = Counter()
    for block in blocks(text or ""):
        counts.update(words(block))
    return counts


def vocabulary(name: str = "piece_bpe_32k.model") -> list[str]:
    """The pieces that lower-cased letters can be cut into: no byte, control or capital pieces."""
    reader = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(name))
    pieces = (reader.id_to_piece(i) for i in range(reader.get_piece_size()) if not reader.is_control(i))
    own = {p for p in pieces if p == p.lower() and LETTERS.fullmatch(p.removeprefix(START) or "a")}
    return sorted(own | {START})


class Lattice:
    """Finds the pieces inside words by hashes of their code points.

    All prefixes of pieces are in the table, so that a search ends where no piece goes on.
    """

    def __init__(self, pieces: list[str]):
        self.none, self.longest = len(pieces), max(map(len, pieces))
        rows: dict[int, int] = {}
        for row, piece in enumerate(pieces):
            value = 0
            for c in piece:
                value = (value * int(_BASE) + ord(c) + 1) & 0xFFFFFFFFFFFFFFFF
                rows.setdefault(value, self.none)
            rows[value] = row
        hashes = np.array(list(rows), dtype=np.uint64)
        order = np.argsort(hashes)
        self.hashes, self.rows = hashes[order], np.array(list(rows.values()), dtype=np.int64)[order]

    def find(self, codes: np.ndarray) -> dict[tuple[int, int], np.ndarray]:
        """(start, end) to the piece of each word there; `none` where there is none.

        codes: words of one length, one a row, as code points.
        """
        return {
            (start, end): piece
            for start in range(codes.shape[1])
            for end, piece in self.starting(codes, start).items()
        }

    def starting(self, codes: np.ndarray, start: int) -> dict[int, np.ndarray]:
        """end to the piece of each word from start to there, as in `find`."""
        found = {}
        alive, value = np.arange(len(codes)), np.zeros(len(codes), dtype=np.uint64)
        for end in range(start + 1, min(codes.shape[1], start + self.longest) + 1):
            value = value * _BASE + codes[alive, end - 1].astype(np.uint64) + np.uint64(1)
            at = np.minimum(np.searchsorted(self.hashes, value), len(self.hashes) - 1)
            hit = self.hashes[at] == value
            alive, value, piece = alive[hit], value[hit], self.rows[at[hit]]
            if end == start + 1 or (piece != self.none).any():
                found[end] = np.full(len(codes), self.none)
                found[end][alive] = piece
            if not len(alive):
                break
        return found


def by_length(items: list[str], languages: int = 1) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows and code points of all words of one length, with the mark of a word's start."""
    sizes = np.fromiter(map(len, items), dtype=np.int64, count=len(items))
    for size in np.unique(sizes):
        rows = np.flatnonzero(sizes == size)
        step = max(1, 4_000_000 // (int(size) + 1) // max(64, 16 * languages))
        for at in range(0, len(rows), step):
            some = rows[at : at + step]
            text = "".join(START + items[i] for i in some)
            yield some, np.frombuffer(text.encode("utf-32-le"), dtype="<u4").reshape(len(some), size + 1)


def of_like_length(items: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Rows, code points and lengths of words that are about equally long, each with the mark of its start.

    Shorter ones end in zeros, which no piece has.
    """
    sizes = np.fromiter(map(len, items), dtype=np.int64, count=len(items)) + 1
    order = np.argsort(sizes, kind="stable")
    start = 0
    while start < len(order):
        most = min(start + LONG_WORDS, int(np.searchsorted(sizes[order], LONG_SPREAD * sizes[order[start]], "right")))
        rows = order[start:most]
        codes = np.zeros((len(rows), int(sizes[rows[-1]])), dtype="<u4")
        for k, row in enumerate(rows):
            codes[k, : sizes[row]] = np.frombuffer((START + items[row]).encode("utf-32-le"), dtype="<u4")
        yield rows, codes, sizes[rows]
        start = most


def byte_cost(codes: np.ndarray) -> np.ndarray:
    """Bytes of a character in UTF-8."""
    return 1 + (codes > 0x7F) + (codes > 0x7FF) + (codes > 0xFFFF)


class Model:
    """Piece probabilities by language; one more row for pieces that are not there."""

    def __init__(self, pieces: list[str] | Lattice, languages: list[str], probabilities: np.ndarray):
        self.lattice = pieces if isinstance(pieces, Lattice) else Lattice(pieces)
        self.languages = languages
        self.byte = 1e-2  # a byte piece of a character outside the vocabulary
        self.table = np.vstack([probabilities, np.zeros(probabilities.shape[1])])

    def _edges(self, codes: np.ndarray) -> dict[tuple[int, int], np.ndarray]:
        """(start, end) to words x languages: the probability of the piece there."""
        return {
            (start, end): self._chance(codes, start, end, piece)
            for (start, end), piece in self.lattice.find(codes).items()
        }

    def _chance(self, codes: np.ndarray, start: int, end: int, piece: np.ndarray) -> np.ndarray:
        chance = self.table[piece]
        if end == start + 1:
            missing = piece == self.lattice.none
            chance = np.where(missing[:, None], self.byte ** byte_cost(codes[:, start])[:, None] * 1e-2, chance)
        return chance

    def log_likelihoods(self, items: list[str]) -> np.ndarray:
        """words x languages: the log of the sum over all segmentations of each word."""
        result = np.zeros((len(items), len(self.languages)))
        short = [k for k, item in enumerate(items) if len(item) < SHORT]
        for rows, codes in by_length([items[k] for k in short], len(self.languages)):
            sums = self._sums(self._edges(codes), codes.shape[1], len(codes))
            result[np.array(short)[rows]] = np.log(sums[codes.shape[1]])
        long = [k for k, item in enumerate(items) if len(item) >= SHORT]
        for rows, codes, sizes in of_like_length([items[k] for k in long]):
            result[np.array(long)[rows]] = self._forward(codes, sizes)
        return result

    def _forward(self, codes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """The same recursion, with states that are rescaled: every edge is looked up once, at its start."""
        shape = (len(codes), len(self.languages))
        states, log_scale, result = {0: np.ones(shape)}, np.zeros(shape), np.zeros(shape)
        for start in range(codes.shape[1]):
            here = states.pop(start)
            for end, piece in self.lattice.starting(codes, start).items():
                new = here * self._chance(codes, start, end, piece)
                states[end] = states[end] + new if end in states else new
            done = start + 1
            ended = sizes == done
            if ended.any():
                result[ended] = log_scale[ended] + np.log(states[done][ended])
            if done % RESCALED == 0:
                scale = states[done]
                log_scale += np.log(scale)
                states = {end: state / scale for end, state in states.items()}
        return result

    @staticmethod
    def _sums(edges: dict, length: int, rows: int) -> list[np.ndarray]:
        languages = next(iter(edges.values())).shape[1]
        sums = [np.ones((rows, languages)), *(np.zeros((rows, languages)) for _ in range(length))]
        for start, end in sorted(edges, key=lambda e: e[1]):
            sums[end] += sums[start] * edges[start, end]
        return sums

    def expected(self, items: list[str], times: np.ndarray) -> np.ndarray:
        """pieces x languages: expected counts in all segmentations of the words.

        times: words x languages, how often each word occurs.
        """
        total = np.zeros_like(self.table)
        for rows, codes in by_length(items, len(self.languages)):
            length = codes.shape[1]
            if length > SHORT:
                step = max(1, LONG_CELLS // (length * len(self.languages)))
                for start in range(0, len(rows), step):
                    some = slice(start, start + step)
                    self._add_expected_long(total, codes[some], times[rows[some]])
                continue
            found = self.lattice.find(codes)
            edges = self._edges(codes)
            forward = self._sums(edges, length, len(rows))
            back = [np.zeros_like(forward[0]) for _ in range(length)] + [np.ones_like(forward[0])]
            for start, end in sorted(edges, key=lambda e: -e[0]):
                back[start] += edges[start, end] * back[end]
            weight = times[rows] / np.maximum(forward[length], 1e-300)
            for (start, end), chance in edges.items():
                self._add(total, found[start, end], forward[start] * chance * back[end] * weight)
        return total[:-1]

    @staticmethod
    def _add(total: np.ndarray, piece: np.ndarray, share: np.ndarray) -> None:
        for language in range(share.shape[1]):
            total[:, language] += np.bincount(piece, share[:, language], len(total))

    def _add_expected_long(self, total: np.ndarray, codes: np.ndarray, times: np.ndarray) -> None:
        """Add the expected counts of words of one length, whatever it is.

        Both passes keep the logs of their states, so nothing underflows.
        """
        length, reach = codes.shape[1], self.lattice.longest
        shape = (len(codes), len(self.languages))

        def starting(at: int) -> list[tuple[int, np.ndarray, np.ndarray]]:
            """End, piece and chance of the edges that start there."""
            found = self.lattice.starting(codes, at)
            return [(end, piece, self._chance(codes, at, end, piece)) for end, piece in found.items()]

        def log_sum(parts: list[np.ndarray], chances: list[np.ndarray]) -> np.ndarray:
            top = np.max(parts, axis=0)
            return top + np.log(sum(np.exp(p - top) * c for p, c in zip(parts, chances, strict=True)))

        forward = [np.zeros(shape)]
        coming: dict[int, tuple[list, list]] = {end: ([], []) for end in range(1, length + 1)}
        for start in range(length):
            for end, _, chance in starting(start):
                coming[end][0].append(forward[start])
                coming[end][1].append(chance)
            forward.append(log_sum(*coming.pop(start + 1)))
        back, whole = {length: np.zeros(shape)}, forward[length]
        for start in range(length - 1, -1, -1):
            edges = starting(start)
            back[start] = log_sum([back[end] for end, _, _ in edges], [chance for _, _, chance in edges])
            for end, piece, chance in edges:
                self._add(total, piece, np.exp(forward[start] + back[end] - whole) * chance * times)
            back.pop(start + reach, None)


def fit(
    pieces: list[str], languages: list[str], items: list[str], times: np.ndarray, rounds: int = 4, lattice: Lattice | None = None
) -> Model:
    """Expectation maximisation from piece probabilities that fall with the piece's length."""
    lattice = lattice or Lattice(pieces)
    start = np.array([[0.02 ** min(len(p), 4)] for p in pieces]).repeat(len(languages), axis=1)
    model = Model(lattice, languages, start / start.sum(axis=0))
    for _ in range(rounds):
        counts = model.expected(items, times) + SMOOTHING
        model = Model(lattice, languages, counts / counts.sum(axis=0))
    return model


def training_words(rows: DataFrame, sample_rows: int) -> DataFrame:
    """lang, word, n over about `sample_rows` rows of each language (all, if there are fewer)."""
    sizes = small(rows.groupBy("lang").agg(F.count("*").alias("rows")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            counts: Counter = Counter()
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for word, n in counted_words(text).items():
                    counts[lang, word] += n
            columns = [[k[0] for k in counts], [k[1] for k in counts], list(counts.values())]
            types = (pa.string(), pa.string(), pa.int64())
            arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, names=["lang", "word", "n"])

    drawn = rows.withColumn("at", draw("language")).join(sizes, "lang")
    chosen = drawn.where(F.col("at") * F.col("rows") < sample_rows)
    counted = chosen.select("lang", "text").mapInArrow(run, "lang string, word string, n long")
    return counted.groupBy("lang", "word").agg(F.sum("n").alias("n"))


def train(rows: DataFrame, sample_rows: int = 400, rounds: int = 4) -> DataFrame:
    """lang, pieces, chances and floor of every language, staged: the probabilities of the pieces that
    its sample has, and that of any other.

    rows: text and lang of the rows that may be learned from.
    """
    pieces = vocabulary()

    def fitted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = None
        now, items, times = None, [], []

        def found() -> pa.RecordBatch:
            own = fit(pieces, [now], items, np.array(times, dtype=np.float64)[:, None], rounds, lattice).table[:-1, 0]
            floor = own.min()
            seen = np.flatnonzero(own > floor)
            arrays = [
                pa.array([now], pa.string()),
                pa.array([seen.tolist()], pa.list_(pa.int32())),
                pa.array([own[seen].tolist()], pa.list_(pa.float64())),
                pa.array([floor], pa.float64()),
            ]
            return pa.RecordBatch.from_arrays(arrays, names=["lang", "pieces", "chances", "floor"])

        for batch in batches:
            for lang, word, n in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                if lang != now and now is not None:
                    lattice = lattice or Lattice(pieces)
                    yield found()
                    items, times = [], []
                now = lang
                items.append(word)
                times.append(n)
        if now is not None:
            lattice = lattice or Lattice(pieces)
            yield found()

    # Words of a language in order, so that its sums don't depend on the shuffle.
    words = training_words(rows.where("lang is not null and text is not null"), sample_rows)
    by_language = words.repartition("lang").sortWithinPartitions("lang", "word")
    kind = "lang string, pieces array<int>, chances array<double>, floor double"
    return staged(by_language.mapInArrow(fitted, kind), "languages")


def loaded(learned: DataFrame, languages: list[str], lattice: Lattice) -> Model:
    """The model of some languages, in the given order."""
    table = np.zeros((lattice.none, len(languages)))
    place = {lang: k for k, lang in enumerate(languages)}
    for row in learned.where(F.col("lang").isin(languages)).toLocalIterator():  # `block` of them at most
        column = table[:, place[row.lang]]
        column[:] = row.floor
        column[row.pieces] = row.chances
    return Model(lattice, languages, table)


def likeliest(rows: DataFrame, model: Model) -> DataFrame:
    """uid, doc_id, lang, best and total of every row: the likeliest language (`und` without a letter), its log
    likelihood, and the log of the sum of all languages' likelihoods over it."""
    # `block` languages at most.
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        known: dict[str, int] = {}
        logs = np.zeros((0, len(own.languages)))
        for batch in small_batches(batches, most_bytes=2_000_000):
            texts = [counted_words(t) for t in batch.column("text").to_pylist()]
            if len(known) * len(own.languages) > MEMORY:
                known, logs = {}, logs[:0]
            new = list({w for found in texts for w in found if w not in known})
            if new:
                known.update({w: len(known) + i for i, w in enumerate(new)})
                logs = np.vstack([logs, own.log_likelihoods(new)])
            langs, best, over = [], [], []
            for found in texts:
                if not found:
                    langs.append(UNDETERMINED)
                    best.append(None)
                    over.append(None)
                    continue
                at = np.fromiter((known[w] for w in found), dtype=np.int64, count=len(found))
                times = np.fromiter(found.values(), dtype=np.float64, count=len(found))
                total = times @ logs[at]
                winner = int(np.argmax(total))
                langs.append(own.languages[winner])
                best.append(float(total[winner]))
                over.append(float(np.log(np.exp(total - total[winner]).sum())))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("uid"),
                    batch.column("doc_id"),
                    pa.array(langs, pa.string()),
                    pa.array(best, pa.float64()),
                    pa.array(over, pa.float64()),
                ],
                names=["uid", "doc_id", "lang", "best", "over"],
            )

    return rows.select("uid", "doc_id", "text").mapInArrow(
        run, "uid long, doc_id long, lang string, best double, over double"
    )


def predict(
    docs: DataFrame, learned: DataFrame, doc_id: str = "doc_id", text: str = "text", block: int = 256
) -> DataFrame:
    """doc_id, lang_pred and score of every row, from its whole text alone. learned: of `train`."""
    rows = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"), F.monotonically_increasing_id().alias("uid")
    )
    languages = sorted(r.lang for r in learned.select("lang").collect())  # names alone
    if not languages:
        return rows.select("doc_id", F.lit(UNDETERMINED).alias("lang_pred"), F.lit(0.0).alias("score"))
    lattice = Lattice(vocabulary())
    runs = [languages[k : k + block] for k in range(0, len(languages), block)]
    if len(runs) == 1:
        found = likeliest(rows, loaded(learned, languages, lattice))
    else:
        rows = staged(rows, "language-rows")
        each = [staged(likeliest(rows, loaded(learned, run, lattice)), "language-block") for run in runs]
        # The largest likelihood, then the first name; `over` is the log of all blocks' sums over it.
        first = F.min_by("lang", F.struct(-F.col("best"), "lang"))
        merged = reduce(DataFrame.unionByName, each).groupBy("uid", "doc_id").agg(
            F.coalesce(first, F.lit(UNDETERMINED)).alias("lang"),
            F.collect_list(F.struct("best", "over")).alias("blocks"),  # one entry a block
        )
        top = F.array_max("blocks.best")
        over = F.aggregate("blocks", F.lit(0.0), lambda a, b: a + F.exp(b["best"] - top + b["over"]))
        found = merged.select("uid", "doc_id", "lang", top.alias("best"), F.log(over).alias("over"))
    undetermined = F.col("best").isNull()
    return found.select(
        "doc_id", F.col("lang").alias("lang_pred"), F.when(undetermined, 0.0).otherwise(F.exp(-F.col("over"))).alias("score")
    )


def identify(
    docs: DataFrame,
    folds: int = 4,
    held: int = 2,
    sample_rows: int = 400,
    doc_id: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    block: int = 256,
) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every row; learns from rows that are not held out."""
    rows = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"), F.col(lang).alias("lang")
    )
    learned = train(rows.where(bucket_of("doc_id", folds) != held), sample_rows)
    held_out = (bucket_of("doc_id", folds) == held).alias("held_out")
    return predict(rows, learned, block=block).select("doc_id", held_out, "lang_pred", "score")
