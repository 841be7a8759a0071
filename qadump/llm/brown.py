"""LM scoring: Brown class-based bigrams, P(w | w') = P(class(w) | class(w')) P(w | class(w)).

Words get classes by the exchange algorithm: the `exchanged` most frequent words of the training
text start in classes of their own rank, all others in one class of rare words, and each frequent word
in turn moves to the class that raises the likelihood of the training text's class bigrams most, until
few words move. Both numbers follow the vocabulary of V words (`sizes_for`): the words that move grow with
its sixth root, so their table of bigrams with its cube root, and the classes with the square root of the
words that move. Every other word that training saw twice or more then gets the class that makes
the training text likeliest next to the exchanged words' classes, all of them in one parallel round, and
the class bigrams are counted again over the classes of all words. Words seen once stay in
the rare class, as they stand for words that were never seen.

Smoothing: class transitions are interpolated with the class unigram; words of the rare
class have absolute discounting, and the discounted mass is the probability of a word that
training never saw. The probabilities of the V known words and the unknown one sum to 1.

Plan: one pass counts words, one counts bigrams of exchanged words (a table of bounded size), one
counts the classes around all other words, by word, and one finds the classes of all
tokens: frequent words are looked up in a broadcast table of fixed size, which also keeps any
hot word out of the shuffle; other words are joined with their classes, and return to their
places in their documents in one aggregation. Transitions and scores come from these
sequences, a byte a token, staged.

Words that the whole table has once need no shuffle: their class and count follow from
the row they are in. A broadcast bitmap (`Repeated`) has a bit for every word that occurs twice or
more, so a word without its bit occurs once; where words share bits, one more is joined. The
bitmap decides what is shuffled, never a result.

A null or empty text is its end token alone; a very long one is read in blocks. Words of equal count rank in code point
order, and of equally good classes a word takes the first. Null ids are never held out; repeated rows
count and score as rows of their own; an empty table gives an empty result. Without training text N = V = 0, the base score is 0 and
classes are equally likely. Only the id and text columns are read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, replace
from itertools import chain
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from qadump.llm.common import blocks, bucket_of, small_batches, staged

#: The end of a text, and what stands before its first word. No word holds a blank.
END = b" "
NEVER = " never"


def tokens(text: str | None) -> list[bytes]:
    """Lower-cased words and one end, as UTF-8: of bytes only A-Z and ASCII white space count."""
    return list(chain.from_iterable(token_runs(text)))


def token_runs(text: str | None) -> Iterator[list[bytes]]:
    """The tokens of a text in runs of bounded size."""
    for block in blocks(text or ""):
        yield block.encode("utf-8").lower().split()
    yield [END]


@dataclass(frozen=True)
class Model:
    """Everything of fixed size that scoring needs; rare words come from the count table."""

    frequent: dict[bytes, tuple[int, int]]  # word: training count, class
    transition: np.ndarray  # log10 P(class | class before); the last class is the rare one
    class_tokens: np.ndarray
    total: int  # N
    distinct: int  # V
    discount: float
    rare_types: int

    @property
    def rare(self) -> int:
        return len(self.class_tokens) - 1

    def base(self, count: float) -> float:
        return float(np.log10((count + 0.5) / (self.total + 0.5 * (self.distinct + 1))))

    def rare_emission(self) -> tuple[float, float]:
        """Tokens of the rare class, and log10 of the share of words never seen among them."""
        mass = self.class_tokens[self.rare]
        unseen = self.discount * self.rare_types / mass if self.rare_types > 0 else 1.0
        return max(1.0, float(mass)), float(np.log10(unseen))


def word_counts(docs: DataFrame) -> DataFrame:
    """word, c (in training rows) and n (in all rows), from rows of text and train."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, most_bytes=16_000_000):
            train, every = Counter(), Counter()
            for text, is_train in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for run_of in token_runs(text):
                    (train if is_train else every).update(run_of)
            every.update(train)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(list(every), pa.string()),
                    pa.array([train[w] for w in every], pa.int64()),
                    pa.array(list(every.values()), pa.int64()),
                ],
                names=["word", "c", "n"],
            )

    counted = docs.select("text", "train").mapInArrow(run, "word string, c long, n long")
    return counted.groupBy("word").agg(F.sum("c").alias("c"), F.sum("n").alias("n"))


#: Bits of the bitmap at most: 16 MB. With more words than bits most bits are set, and most words are joined.
MOST_BITS = 1 << 27
#: Bits of one part that Spark's bitmap functions make.
PART_BITS = 32_768


@dataclass(frozen=True)
class Repeated:
    """Words that may occur twice or more; one that is not among them occurs once at most."""

    bits: np.ndarray  # bytes, the lowest bit of each first

    def among(self, words: list[bytes]) -> np.ndarray:
        mask = 8 * len(self.bits) - 1  # a power of two of bits
        at = np.fromiter((crc32(w) & mask for w in words), dtype=np.int64, count=len(words))
        return (self.bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1


def repeated(counts: DataFrame, most_bits: int = MOST_BITS) -> Repeated:
    """The bitmap of words that all rows have twice or more; counts: of `word_counts`, staged."""
    often = counts.where("n > 1")
    size, wanted = PART_BITS, min(most_bits, 8 * often.count())
    while size < wanted:
        size *= 2
    at = F.crc32(F.col("word").cast("binary")).bitwiseAND(F.lit(size - 1)) + 1  # the functions count from 1
    # By parts before they are made, so that not every task sends a whole bitmap.
    parts = (
        often.select(F.bitmap_bucket_number(at).alias("part"), F.bitmap_bit_position(at).alias("bit"))
        .repartition("part")
        .groupBy("part")
        .agg(F.bitmap_construct_agg("bit").alias("bits"))
    )
    bits = np.zeros(size // 8, dtype=np.uint8)
    for row in parts.collect():  # `most_bits` at most
        start = (row.part - 1) * PART_BITS // 8
        bits[start : start + PART_BITS // 8] = np.frombuffer(row.bits, np.uint8)
    return Repeated(bits)


def bigram_counts(train: DataFrame, ids: dict[bytes, int], size: int) -> np.ndarray:
    """How often one frequent word follows another, over all rows of text: a size x size table.

    ids: word to index; the last index stands for all other words. The result has
    size x size cells at most, whatever the input.
    """
    other = size - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: Counter = Counter()
        for batch in small_batches(batches):
            words = chain.from_iterable(chain.from_iterable(map(token_runs, batch.column(0).to_pylist())))
            flat = np.fromiter((ids.get(w, other) for w in words), dtype=np.int64)
            before = np.r_[ids[END], flat[:-1]]  # a text's first word follows the end of the one before
            pair, count = np.unique(before * size + flat, return_counts=True)
            sums.update(dict(zip(pair.tolist(), count.tolist(), strict=True)))
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(sums), pa.int64()), pa.array(list(sums.values()), pa.int64())],
            names=["pair", "n"],
        )

    rows = train.select("text").mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    found = rows.toArrow()
    counts = np.zeros(size * size)
    counts[found.column("pair").to_numpy()] = found.column("n").to_numpy()
    return counts.reshape(size, size)


def _information(counts: np.ndarray) -> np.ndarray:
    return counts * np.log(np.maximum(counts, 1))


def exchange(counts: np.ndarray, classes: int, fixed: int, rounds: int = 12) -> np.ndarray:
    """Class of each word by the exchange algorithm.

    counts: word bigrams; the words are in order of frequency, the last `fixed` ones keep
    classes of their own: `classes`, `classes` + 1, ...
    """
    size = len(counts)
    movable = size - fixed
    of = np.r_[np.arange(movable) % classes, classes + np.arange(fixed)].astype(np.int64)
    k = classes + fixed
    member = np.zeros((size, k))
    member[np.arange(size), of] = 1
    right, left = counts @ member, counts.T @ member  # word x class after it, and before it
    table = member.T @ right  # class bigrams
    unigram = counts.sum(axis=1)
    both = np.diag(counts)
    for _ in range(rounds):
        moved = 0
        for w in range(movable):
            old = of[w]
            after, before, self_count = right[w], left[w], both[w]
            # Take the word out of its class, its own repeats apart.
            rest = table.copy()
            rest[old] -= after
            rest[:, old] -= before
            rest[old, old] += self_count
            out_after, out_before = after.copy(), before.copy()
            out_after[old] -= self_count
            out_before[old] -= self_count
            sums = rest.sum(axis=1)
            # Put it into each class in turn: rows and columns of that class change.
            rows = (_information(rest + out_after) - _information(rest)).sum(axis=1)
            columns = (_information(rest.T + out_before) - _information(rest.T)).sum(axis=1)
            cell = np.diag(rest)
            crossing = (
                _information(cell + out_after + out_before + self_count)
                - _information(cell + out_after)
                - _information(cell + out_before)
                + _information(cell)
            )
            size_cost = 2 * (_information(sums + unigram[w]) - _information(sums))
            gain = (rows + columns + crossing - size_cost)[:classes]
            new = int(np.argmax(gain))
            if gain[new] <= gain[old] + 1e-9:
                continue
            moved += 1
            of[w] = new
            table = rest
            table[new] += out_after
            table[:, new] += out_before
            table[new, new] += self_count
            right[:, old] -= counts[:, w]
            right[:, new] += counts[:, w]
            left[:, old] -= counts[w]
            left[:, new] += counts[w]
        if moved <= movable // 200:
            break
    return of


def _transition(bigrams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """log10 P(class | class before), and the tokens of each class."""
    class_tokens = bigrams.sum(axis=0)  # every token follows something
    share = (class_tokens + 0.5) / (class_tokens.sum() + 0.5 * len(bigrams))
    context = bigrams.sum(axis=1, keepdims=True)
    strength = 20.0
    return np.log10((bigrams + strength * share) / (context + strength)), class_tokens


def most_frequent(words: DataFrame, count: str, most: int) -> DataFrame:
    """The `most` words of the largest counts (of equal ones the first in code point order), in that order.

    Counts fall into narrow levels, whose sizes tell which levels can hold such words; only words
    of these are sorted, so that not every task sends `most` words.
    """
    level = F.floor(64 * F.log2(count))
    sizes = words.where(F.col(count) > 0).groupBy(level.alias("level")).count().collect()  # 64 levels a power of two
    seen, last = 0, 0
    for row in sorted(sizes, key=lambda r: -r.level):
        seen, last = seen + row["count"], row.level
        if seen >= most:
            break
    return words.where((F.col(count) > 0) & (level >= last)).orderBy(F.desc(count), "word").limit(most)


def sizes_for(distinct: int) -> tuple[int, int]:
    """Words that move and classes, for a vocabulary: 1,500 and 32 up to 360,000 words, 5,600 and 62 at a billion."""
    exchanged = max(1_500, round(178 * distinct ** (1 / 6)))
    return exchanged, round(32 * (exchanged / 1_500) ** 0.5)


def train(
    docs: DataFrame,
    counts: DataFrame,
    classes: int | None = None,
    exchanged: int | None = None,
    looked_up: int = 150_000,
) -> Model:
    """Classes of the words that the exchange moves; all others are in the rare class as yet.

    docs: rows of text and train; counts: of `word_counts`, staged; classes, exchanged: of `sizes_for` if None.
    """
    is_end = F.col("word") == END.decode()
    words = counts.where(~is_end)
    top = most_frequent(words, "n", looked_up)
    found = top.select(F.col("word").cast("binary"), "c").toArrow()
    frequent = dict(zip(found.column(0).to_pylist(), found.column(1).to_pylist(), strict=True))
    totals = counts.agg(
        F.coalesce(F.sum("c"), F.lit(0)).alias("total"),
        F.count(F.when(F.col("c") > 0, 1)).alias("distinct"),
        F.count(F.when(F.col("c") == 1, 1)).alias("once"),
        F.count(F.when(F.col("c") == 2, 1)).alias("twice"),
        F.coalesce(F.sum(F.when(is_end, F.col("c"))), F.lit(0)).alias("ends"),
    ).first()
    by_rule = sizes_for(totals.distinct)
    exchanged, classes = exchanged or by_rule[0], classes or by_rule[1]
    trained = most_frequent(words, "c", exchanged)
    movers = [(r.word.encode(), r.c) for r in trained.select("word", "c").collect()]
    ids = {word: k for k, (word, _) in enumerate(movers)} | {END: len(movers)}
    table = bigram_counts(docs.where("train"), ids, len(movers) + 2)
    of = exchange(table, classes, fixed=2)
    k = classes + 2
    member = np.zeros((len(of), k))
    member[np.arange(len(of)), of] = 1
    transition, class_tokens = _transition(member.T @ table @ member)
    rare_types = totals.distinct - len(movers) - (totals.ends > 0)
    discount = min(0.9, totals.once / (totals.once + 2 * totals.twice)) if totals.once else 0.5
    known = {word: (count, int(of[i])) for i, (word, count) in enumerate(movers)}
    known |= {word: (count, k - 1) for word, count in frequent.items() if word not in known}
    known[END] = (totals.ends, classes)
    return Model(known, transition, class_tokens, totals.total, totals.distinct, discount, rare_types)


def assigned(docs: DataFrame, model: Model, often: Repeated | None = None) -> DataFrame:
    """word, c and group: the class of every training word that the exchange left in the rare class.

    docs: rows of text and train; model: of `train`; often: of `repeated`, if words that occur once, all of
    the rare class, are to be left out. A word gets the class under which
    the training text is likeliest, given the classes of the exchanged words next to it, all words at once.
    Those seen once stay in the rare class: they stand for the words that were never seen.
    """
    k, rare = len(model.class_tokens), model.rare
    moved = {word: group for word, (_, group) in model.frequent.items() if group < rare}
    # `exchanged` words, and a bitmap of `MOST_BITS` at most.
    shared = docs.sparkSession.sparkContext.broadcast((moved, often))
    share = (model.class_tokens + 0.5) / (model.class_tokens.sum() + 0.5 * k)
    # class before x class after, by class of the word: the likelihood of one occurrence.
    into = model.transition - np.log10(share)
    worth = (into[:, None, : rare - 1] + model.transition.T[None, :, : rare - 1]).reshape(k * k, rare - 1)

    def around(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups, twice = shared.value
        get, kind = groups.get, _kind(k)
        for batch in small_batches(batches, most_bytes=16_000_000):
            kinds, others = [np.empty(0, dtype=kind)], [pa.array([], pa.binary())]
            for words in chain.from_iterable(token_runs(text.as_py()) for text in batch.column(0)):
                own = np.fromiter((get(w, rare) for w in words), dtype=kind, count=len(words))
                kinds.append(own)
                # As Arrow at once: a list of the batch's words would hold many times its text.
                others.append(pa.array([words[i] for i in np.flatnonzero(own == rare).tolist()], pa.binary()))
            flat = np.concatenate(kinds)
            at = np.flatnonzero(flat == rare)
            # The last token is an end: it stands before the first one too, and no word follows it.
            code = flat[at - 1].astype(np.int64) * k + flat[at + 1]
            coded = pa.concat_arrays(others).dictionary_encode()
            # Sorted in place, and nothing kept that is not needed: a task's memory is that of one batch.
            key = coded.indices.to_numpy().astype(np.int64)
            del kinds, others, flat, at
            if twice is not None:
                names, step = coded.dictionary, 50_000
                some = [twice.among(names.slice(a, step).to_pylist()) for a in range(0, max(1, len(names)), step)]
                kept = np.concatenate(some)[key]
                key, code = key[kept], code[kept]
            key *= k * k
            key += code
            key.sort()
            alike = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else key
            n, key = np.diff(np.r_[alike, len(key)]), key[alike]
            # One row a word: all its codes of the batch, each with its number.
            word = key // (k * k)
            first = np.flatnonzero(np.r_[True, word[1:] != word[:-1]]) if len(word) else word
            packed = np.stack([key % (k * k), n], axis=1).astype("<i4")
            ends = (8 * np.r_[first, len(word)]).astype(np.int32)
            cells = pa.Array.from_buffers(
                pa.binary(), len(first), [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(packed.tobytes())]
            )
            names = coded.dictionary.cast(pa.string()).take(pa.array(word[first]))
            yield pa.RecordBatch.from_arrays([names, cells], names=["word", "cells"])

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The class of each word; rows come in the order of words."""

        def chosen(words: pa.Array, cells: pa.Array) -> pa.RecordBatch:
            coded = words.dictionary_encode()
            packed = np.frombuffer(b"".join(cells.to_pylist()), "<i4").astype(np.int64).reshape(-1, 2)
            each = pa.compute.binary_length(cells).to_numpy() // 8
            row = np.repeat(coded.indices.to_numpy(), each)
            count = np.bincount(row, packed[:, 1], len(coded.dictionary)).astype(np.int64)
            total = np.zeros((len(coded.dictionary), worth.shape[1]))
            # Rows of a word are neighbours, so sums run over runs of them.
            starts = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
            for a in range(0, len(starts), 500):
                b = min(a + 500, len(starts))
                some = slice(starts[a], starts[b] if b < len(starts) else len(row))
                gains = worth[packed[some, 0]] * packed[some, 1][:, None]
                total[row[starts[a:b]]] = np.add.reduceat(gains, starts[a:b] - starts[a])
            group = np.where(count > 1, total.argmax(axis=1), rare)
            return pa.RecordBatch.from_arrays(
                [coded.dictionary, pa.array(count), pa.array(group.astype(np.int32))], names=["word", "c", "group"]
            )

        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            whole = pa.Table.from_batches(held).combine_chunks()
            words = whole.column("word").combine_chunks()
            # The last word may go on in the next batch.
            same = pa.compute.equal(words, words[-1]).to_numpy(zero_copy_only=False)
            cut = len(words) - int(same.sum())
            if cut:
                done = whole.slice(0, cut)
                yield chosen(done.column("word").combine_chunks(), done.column("cells").combine_chunks())
            held = whole.slice(cut).combine_chunks().to_batches()
        for rest in held:
            yield chosen(rest.column("word"), rest.column("cells"))

    # One shuffle, by word; a word has one row for every batch of texts that it is in.
    seen = docs.where("train").select("text").mapInArrow(around, "word string, cells binary")
    by_word = seen.repartition("word").sortWithinPartitions("word")
    return staged(by_word.mapInArrow(choose, "word string, c long, group int"), "classes")


def with_classes(model: Model, words: DataFrame) -> Model:
    """The model with the classes of `assigned` for the words of its table."""
    open_words = [w.decode() for w, (c, group) in model.frequent.items() if c and group == model.rare]
    asked = words.sparkSession.createDataFrame(pa.table({"word": pa.array(open_words, pa.string())}))
    found = words.join(F.broadcast(asked), "word").select(F.col("word").cast("binary"), "c", "group").toArrow()
    rows = zip(*(column.to_pylist() for column in found.columns), strict=True)
    return replace(model, frequent=model.frequent | {word: (c, group) for word, c, group in rows})


def refitted(model: Model, found: DataFrame, counts: DataFrame) -> Model:
    """The model with transitions counted over the classes of all training words.

    found: of `sequences`, staged; counts: of `word_counts`, staged.
    """
    k, end = len(model.class_tokens), model.rare - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(k * k, dtype=np.int64)
        for batch in batches:
            flat = np.frombuffer(b"".join(batch.column(0).to_pylist()), _kind(k)).astype(np.int64)
            sums += np.bincount(np.r_[end, flat[:-1]] * k + flat, minlength=k * k)
        pair = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(pair), pa.array(sums[pair])], names=["pair", "n"])

    rows = found.where("train").select("classes").mapInArrow(run, "pair long, n long")
    bigrams = np.zeros(k * k)
    for row in rows.groupBy("pair").agg(F.sum("n").alias("n")).collect():  # classes x classes
        bigrams[row.pair] = row.n
    transition, class_tokens = _transition(bigrams.reshape(k, k))
    return replace(
        model,
        transition=transition,
        class_tokens=class_tokens,
        # Words seen once, but for those that the exchange moved, and the end.
        rare_types=counts.where("c = 1").count()
        - sum(c == 1 and group < model.rare for c, group in model.frequent.values()),
    )


def _kind(k: int) -> type:
    """What a token's class is written as: 0 to k - 1, and k for words that training never saw."""
    return np.uint8 if k < 256 else np.uint16


def _looked_up(model: Model) -> tuple[list[bytes], np.ndarray]:
    """Words, and for each, then for any other, its class, log10 of its count (in the rare class less the
    discount), base score and whether it is known."""
    words, rows = list(model.frequent), []
    for word in words:
        count, group = model.frequent[word]
        own = count - model.discount * (group == model.rare)
        # An end without training keeps its class.
        group = group if count or word == END else model.rare + 1
        rows.append((group, np.log10(own) if count else 0.0, model.base(count), count > 0))
    return words, np.array([*rows, (len(model.class_tokens), 0.0, 0.0, 0)], dtype=np.float64)


#: Tokens of texts whose words outside the table are gathered together.
GATHERED = 500_000
#: Bits of a class next to its token's place; `_kind` has as many at most.
GROUP_BITS = 16


def _gathered(
    uids: list[int], runs: list[tuple[int, int, np.ndarray, list[bytes]]]
) -> tuple[pa.Array, pa.Array, pa.Array]:
    """uid, word and its places for all words that runs of texts miss.

    runs: the text, its tokens before the run, the places in the run, the words there.
    """
    flat = pa.array(list(chain.from_iterable(words for _, _, _, words in runs)), pa.binary()).dictionary_encode()
    sizes = [len(words) for _, _, _, words in runs]
    text = np.repeat([text for text, _, _, _ in runs], sizes)
    place = np.concatenate([start + at for _, start, at, _ in runs])
    key = text * np.int64(max(1, len(flat.dictionary))) + flat.indices.to_numpy()
    order = np.argsort(key, kind="stable")
    first = np.flatnonzero(np.r_[True, np.diff(key[order]) > 0])
    at = pa.ListArray.from_arrays(
        pa.array(np.r_[first, len(order)].astype(np.int32)), pa.array(place[order].astype(np.int32))
    )
    words = flat.dictionary.cast(pa.string()).take(flat.indices.take(pa.array(order[first])))
    return pa.array(np.array(uids, dtype=np.int64)[text[order[first]]]), words, at


def sequences(docs: DataFrame, model: Model, counts: DataFrame, often: Repeated | None = None) -> DataFrame:
    """uid, doc_id, train, classes (of all tokens, as bytes), n_tokens, n_known, base_score and
    log_counts of every row (uid, doc_id, text and, if there, train).

    counts: word, c and, if there, group; without it all words not in the model's table are rare.
    often: of `repeated` over the counts of these very rows, if there; other rows can't do with it.
    """
    # Of bounded size: `looked_up` and `exchanged` words, and a bitmap of `MOST_BITS` at most.
    shared = docs.sparkSession.sparkContext.broadcast((*_looked_up(model), often))
    rare, k = model.rare, len(model.class_tokens)
    # What a word that occurs once adds to its text, outside and inside training: log10 of its count, base score, known.
    single = np.array([[0.0, model.base(0), 0.0], [np.log10(1 - model.discount), model.base(1), 1.0]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, fields, twice = shared.value
        index = {word: i for i, word in enumerate(table)}
        get, missing = index.get, len(index)
        groups = fields[:, 0].astype(_kind(k))
        names = [field.split()[0] for field in kind.split(", ")]
        whole, real = pa.int64(), pa.float64()
        types = (whole, pa.string(), pa.list_(pa.int32()), whole, pa.bool_(), pa.binary(), whole, whole, real, real)

        def of_words(uids: list[int], runs: list[tuple]) -> pa.RecordBatch:
            found = _gathered(uids, runs)
            nothing = [pa.nulls(len(found[0]), kind_of) for kind_of in types[3:]]
            return pa.RecordBatch.from_arrays([*found, *nothing], names=names)

        for batch in small_batches(batches):
            uids, ids, texts, trains = (batch.column(column).to_pylist() for column in range(4))
            rows: list[tuple] = []
            runs, held = [], 0
            for nth, text in enumerate(texts):
                count, sums, pieces = 0, np.zeros(3), []
                for words in token_runs(text):
                    at = np.fromiter((get(w, missing) for w in words), dtype=np.int64, count=len(words))
                    own = groups[at]
                    sums += fields[at, 1:].sum(axis=0)
                    missed = np.flatnonzero(at == missing)
                    if twice is not None and len(missed):
                        again = twice.among([words[i] for i in missed.tolist()])
                        sums += single[int(trains[nth])] * (len(missed) - again.sum())
                        if trains[nth]:
                            own[missed[~again]] = rare
                        missed = missed[again]
                    pieces.append(own.tobytes())
                    if len(missed):
                        runs.append((nth, count, missed, [words[i] for i in missed.tolist()]))
                        held += len(missed)
                    count += len(words)
                    if held >= GATHERED:
                        yield of_words(uids, runs)
                        runs, held = [], 0
                rows.append((b"".join(pieces), count, int(sums[2]), sums[1], sums[0]))
            if runs:
                yield of_words(uids, runs)
            # A text's own row meets no word of the table and no other row.
            own = [uids, [f"{NEVER}{uid}" for uid in uids], [None] * len(uids), ids, trains, *zip(*rows, strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(own, types, strict=True)], names=names)

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Write the classes of joined words to their places."""
        for whole in batches:
            for batch in small_batches([whole], "classes"):
                texts = batch.column("classes").to_pylist()
                ends = np.cumsum([len(t) // _kind(k)().itemsize for t in texts])
                flat = np.frombuffer(b"".join(texts), _kind(k)).copy()
                places = batch.column("places")
                tokens = pa.compute.list_value_length(places).to_numpy()
                packed = places.flatten().to_numpy()
                at = np.repeat(np.r_[0, ends[:-1]], tokens) + (packed >> GROUP_BITS)
                flat[at] = packed & ((1 << GROUP_BITS) - 1)
                filled = [part.tobytes() for part in np.split(flat, ends[:-1])]
                names = [name for name in batch.schema.names if name != "places"]
                arrays = [pa.array(filled, pa.binary()) if n == "classes" else batch.column(n) for n in names]
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    kind = (
        "uid long, word string, at array<int>, doc_id long, train boolean, classes binary, n_tokens long, "
        "n_known long, base_score double, log_counts double"
    )
    is_train = F.col("train") if "train" in docs.columns else F.lit(False)
    parts = docs.select("uid", "doc_id", "text", is_train.alias("train")).mapInArrow(run, kind)
    group = F.col("group") if "group" in counts.columns else F.lit(rare)
    known = counts.where("c > 0").select("word", "c", group.alias("group"))
    c = F.coalesce("c", F.lit(0))

    def plus(own: str, each: Column) -> Column:
        added = F.when(F.col("place").isNotNull(), each).otherwise(F.lit(0))
        return F.sum(F.coalesce(F.col(own), F.lit(0)) + added).alias(own)

    base = F.log10((c + 0.5) / F.lit(model.total + 0.5 * (model.distinct + 1)))
    logs = F.when(c > 0, F.log10(c - F.when(F.col("group") == rare, model.discount).otherwise(0.0))).otherwise(0.0)
    # Place and class of a token in one number: a list of them shuffles as 8 bytes a token.
    packed = F.shiftleft(F.col("place").cast("long"), GROUP_BITS).bitwiseOR(F.coalesce("group", F.lit(k)).cast("long"))
    filled = "uid long, doc_id long, train boolean, classes binary, n_tokens long, n_known long, base_score double, log_counts double"
    return (
        parts.join(known, "word", "left")
        .withColumn("place", F.explode_outer("at"))
        .groupBy("uid")
        .agg(
            F.max("doc_id").alias("doc_id"),
            F.max("train").alias("train"),
            F.first("classes", ignorenulls=True).alias("classes"),
            F.max("n_tokens").alias("n_tokens"),
            plus("n_known", (c > 0).cast("int")),
            plus("base_score", base),
            plus("log_counts", logs),
            F.collect_list(packed).alias("places"),
        )
        .mapInArrow(fill, filled)
    )


def scored(found: DataFrame, model: Model) -> DataFrame:
    """uid, doc_id, train, n_tokens, n_known, base_score and score of every row of `sequences`."""
    k, rare = len(model.class_tokens), model.rare
    mass, unseen = model.rare_emission()
    # What a token's class costs: its log count is in log_counts.
    sizes = np.maximum(1, np.r_[model.class_tokens[:rare], mass])
    own = np.r_[-np.log10(sizes), unseen]
    step = model.transition[:, [*range(k), rare]]
    step = step[[*range(k), rare]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in small_batches([whole], "classes"):
                texts = batch.column("classes").to_pylist()
                ends = np.cumsum([len(t) // _kind(k)().itemsize for t in texts])
                flat = np.frombuffer(b"".join(texts), _kind(k)).astype(np.int64)
                before = np.r_[rare - 1, flat[:-1]]  # every text ends with the end
                sums = np.add.reduceat(step[before, flat] + own[flat], np.r_[0, ends[:-1]])
                names = ["uid", "doc_id", "train", "n_tokens", "n_known", "base_score"]
                score = pa.array(sums + batch.column("log_counts").to_numpy())
                yield pa.RecordBatch.from_arrays([*map(batch.column, names), score], names=[*names, "score"])

    kind = "uid long, doc_id long, train boolean, n_tokens long, n_known long, base_score double, score double"
    return found.mapInArrow(run, kind)


def scores(docs: DataFrame, model: Model, counts: DataFrame) -> DataFrame:
    """uid, doc_id, n_tokens, n_known, base_score and score of every row (uid, doc_id, text)."""
    return scored(sequences(docs, model, counts), model).drop("train")


def score_texts(
    docs: DataFrame, folds: int = 5, held: int = 1, doc_id: str = "doc_id", text: str = "text", **settings
) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every row."""
    rows = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"),
        F.col(text).alias("text"),
        F.monotonically_increasing_id().alias("uid"),
    ).withColumn("train", bucket_of("doc_id", folds) != held)
    counts = staged(word_counts(rows), "words")
    model, often = train(rows, counts, **settings), repeated(counts)
    words = assigned(rows, model, often)
    model = with_classes(model, words)
    found = staged(sequences(rows, model, words, often), "class-sequences")
    model = refitted(model, found, counts)
    return scored(found, model).select(
        "doc_id",
        (bucket_of("doc_id", folds) == held).alias("held_out"),
        F.col("n_tokens").cast("long").alias("n_tokens"),
        F.col("n_known").cast("long").alias("n_known"),
        F.lit(model.total).cast("long").alias("train_tokens"),
        "base_score",
        "score",
    )
