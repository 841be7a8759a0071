"""The forward algorithm against all segmentations written out; predictions on clear languages."""

import math
import random
import time
from itertools import product

import numpy as np
import pytest

from qadump.llm import language_id

PIECES = sorted(["▁", "a", "b", "c", "ab", "bc", "▁a", "abc", "▁ab", "ca"])


def model(languages=2):
    rng = np.random.default_rng(3)
    table = rng.random((len(PIECES), languages))
    return language_id.Model(PIECES, [f"l{k}" for k in range(languages)], table / table.sum(axis=0))


def segmentations(text):
    """All ways to write text as pieces; a character that is no piece is one by itself."""
    if not text:
        yield []
    for end in range(1, len(text) + 1):
        head = text[:end]
        if head in PIECES or end == 1:
            yield from ([head, *rest] for rest in segmentations(text[end:]))


def by_hand(own, word, language):
    def chance(piece):
        if piece in PIECES:
            return own.table[PIECES.index(piece), language]
        return own.byte ** len(piece.encode()) * 1e-2

    return math.log(sum(math.prod(map(chance, s)) for s in segmentations("▁" + word)))


def test_forward_sums_all_segmentations():
    own, items = model(), ["a", "ab", "abc", "cabcab", "bcaé", "漢ab", "zzz", "abcabcab"]
    found = own.log_likelihoods(items)
    for row, word in enumerate(items):
        for language in range(2):
            assert found[row, language] == pytest.approx(by_hand(own, word, language))


def test_long_words_are_scored_alike(monkeypatch):
    own, items = model(), ["abcab" * 6, "abc" * 7 + "é漢"]
    short = own.log_likelihoods(items)
    monkeypatch.setattr(language_id, "SHORT", 3)
    assert np.allclose(own.log_likelihoods(items), short)
    assert np.isfinite(own.log_likelihoods(["\U0001f600" * 30, "x" * 4000])).all()


def test_expected_counts_equal_all_segmentations():
    own, items = model(), ["abc", "cab", "b"]
    times = np.array([[1.0, 2.0], [3.0, 0.0], [0.5, 1.0]])
    counts = np.zeros((len(PIECES), 2))
    for row, word in enumerate(items):
        for language in range(2):
            ways = list(segmentations("▁" + word))
            weights = [math.prod(own.table[PIECES.index(p), language] for p in w) for w in ways]
            for way, weight in zip(ways, weights, strict=True):
                for piece in way:
                    counts[PIECES.index(piece), language] += times[row, language] * weight / sum(weights)
    assert np.allclose(own.expected(items, times), counts)


def test_long_words_are_learned_from_alike(monkeypatch):
    own, items = model(), ["abcab" * 4, "abc" * 6 + "é漢", "cab"]
    times = np.array([[1.0, 2.0], [3.0, 0.0], [0.5, 1.0]])
    short = own.expected(items, times)
    monkeypatch.setattr(language_id, "SHORT", 3)
    assert np.allclose(own.expected(items, times), short)


@pytest.mark.parametrize("size", [30, 200])
def test_runs_without_blanks_teach_their_language(size):
    """Two languages that write no blanks: every run is long."""
    runs = [("abc" * size)[:size], ("cab" * size)[1 : size + 1], ("b" * size), ("bbc" * size)[:size]]
    times = np.array([[5.0, 0.0], [5.0, 0.0], [0.0, 5.0], [0.0, 5.0]])
    own = language_id.fit(PIECES, ["x", "y"], runs, times)
    asked = own.log_likelihoods([("bca" * size)[: size - 5], ("bcb" * size)[: size - 5]])
    assert asked.argmax(axis=1).tolist() == [0, 1]
    long = own.expected(["\U0001f600" * 300 + "ab" * 1000], np.array([[1.0, 1.0]]))
    assert np.isfinite(long).all() and (long.sum(axis=0) > 500).all()


def likelihood(own, items, times):
    return (own.log_likelihoods(items) * times).sum()


def test_training_raises_the_likelihood():
    items, times = ["abc", "cab", "bbb"], np.array([[5.0, 1.0], [1.0, 4.0], [1.0, 1.0]])
    values = [likelihood(language_id.fit(PIECES, ["x", "y"], items, times, r), items, times) for r in (0, 1, 4)]
    assert values[0] < values[1] <= values[2] + 1e-6


def found(docs, **settings):
    return {r.doc_id: r for r in language_id.identify(docs, **settings).collect()}


def corpus():
    texts = {"en": "the house and the garden were with them", "de": "das haus und der garten waren mit ihnen", "fr": "la maison et le jardin étaient avec eux"}
    entries = []
    for k, (lang, text) in enumerate(texts.items()):
        words = text.split()
        for i in range(40):
            entries.append((100 * k + i, " ".join(words[(i + j) % len(words)] for j in range(5)), lang, "s", 0, *([7] * 8)))
    return entries


def test_held_out_rows_are_recognised(documents):
    entries = corpus()
    result = found(documents(entries))
    assert any(r.held_out for r in result.values())
    for doc_id, text, lang, *_ in entries:
        assert result[doc_id].lang_pred == lang and 0.5 < result[doc_id].score <= 1


def test_held_out_labels_are_not_read(documents):
    entries = corpus()
    result = found(documents(entries))
    other = [(i, t, "xx" if result[i].held_out else lang, *rest) for i, t, lang, *rest in entries]
    again = found(documents(other))
    assert {i: (r.lang_pred, r.score) for i, r in again.items()} == {i: (r.lang_pred, r.score) for i, r in result.items()}


def test_tricky_rows(documents, tricky):
    more = [(i + 10_000, *rest) for i, *rest in corpus()]
    result = language_id.identify(tricky.unionByName(documents(more))).collect()
    assert len(result) == tricky.count() + len(more)
    for r in result:
        assert 0 <= r.score <= 1 and (r.lang_pred == "und") == (r.score == 0)
    by_id = {r.doc_id: r for r in result if r.doc_id is not None}
    assert all(by_id[i].lang_pred == "und" for i in (3, 4, 5))
    assert all(by_id[i].lang_pred != "und" for i in (1, 6, 8, 9, 10))
    assert not any(r.held_out for r in result if r.doc_id is None)


def test_no_labels_and_no_rows(documents, nothing):
    assert found(nothing) == {}
    unlabelled = documents([(1, "some words", None, None, None, *([None] * 8))])
    assert found(unlabelled)[1].lang_pred == "und"


def made_up(languages, rows_each=12):
    """Languages that share letters; each writes its own three syllables."""
    rng = random.Random(4)
    syllables = ["".join(p) for p in product("bdfgklmnprst", "aeiou")]
    entries = []
    for k in range(languages):
        own = rng.sample(syllables, 3)
        for i in range(rows_each):
            words = ["".join(rng.choices(own, k=4)) for _ in range(25)]
            entries.append((1000 * k + i, " ".join(words), f"l{k:03}", "s", 0, *([7] * 8)))
    return entries


def test_every_language_is_learned_in_blocks_as_in_one(documents):
    entries = made_up(40)
    docs = documents(entries + [(-k, text, None, "s", 0, *([7] * 8)) for k, text in enumerate(["", None, "123", "漢字"], 1)])
    one, several = found(docs), found(docs, block=3)
    right = [one[i].lang_pred == lang for i, _, lang, *_ in entries if one[i].held_out]
    assert len(right) > 50 and sum(right) >= 0.95 * len(right)
    assert {one[i].lang_pred for i, *_ in entries} == {f"l{k:03}" for k in range(40)}
    for i, r in one.items():
        assert several[i].lang_pred == r.lang_pred and several[i].score == pytest.approx(r.score)
    assert [one[i].lang_pred for i in (-1, -2, -3)] == ["und"] * 3 and one[-4].lang_pred != "und"


def test_ties_go_to_the_first_language(documents):
    entries = [(k, "same words here", lang, "s", 0, *([7] * 8)) for k, lang in enumerate(["b", "a", "c"] * 8)]
    for block in (256, 1):
        assert {(r.lang_pred, round(r.score, 6)) for r in found(documents(entries), block=block, held=9).values()} == {("a", 0.333333)}


def test_tables_are_those_of_one_fit(documents, spark):
    """Each language by itself, in a task, as all languages in one fit."""
    entries = made_up(3)
    learned = language_id.train(documents(entries).select("text", "lang"), sample_rows=10**6)
    words = sorted({w for _, text, *_ in entries for w in text.split()})
    times = np.zeros((len(words), 3))
    for _, text, lang, *_ in entries:
        for word in text.split():
            times[words.index(word), int(lang[1:])] += 1
    pieces = language_id.vocabulary()
    whole = language_id.fit(pieces, ["l000", "l001", "l002"], words, times)
    own = language_id.loaded(learned, ["l000", "l001", "l002"], language_id.Lattice(pieces))
    assert np.allclose(own.table, whole.table)


def test_one_id_on_a_third_of_the_rows_leaves_the_sample_small(documents):
    entries = corpus()
    hot = [(5, "hot words of one id", "en", "s", 0, *([7] * 8))] * 3_000
    words = language_id.training_words(documents(entries * 50 + hot).repartition(6).select("text", "lang"), 100)
    total = {r.lang: r.n for r in words.groupBy("lang").agg({"n": "sum"}).withColumnRenamed("sum(n)", "n").collect()}
    assert all(50 * 5 <= n <= 160 * 5 for n in total.values())


def test_words_of_many_lengths_are_scored_together():
    own = model()
    items = [("abcab" * 60)[: 24 + k] + "é" * (k % 3) for k in range(120)] + ["b" * 1_000, "c"]
    alone = np.vstack([own.log_likelihoods([item]) for item in items])
    assert np.allclose(own.log_likelihoods(items), alone) and np.isfinite(alone).all()


def test_long_runs_cost_about_what_short_words_do():
    pieces = language_id.vocabulary()
    rng = random.Random(2)
    table = np.random.default_rng(0).random((len(pieces), 4))
    own = language_id.Model(pieces, list("abcd"), table / table.sum(axis=0))

    def cost(length):
        items = ["".join(rng.choices("abcdefghilmnoprstu", k=length)) for _ in range(200_000 // length)]
        best = math.inf
        for _ in range(2):
            start = time.process_time()
            own.log_likelihoods(items)
            best = min(best, time.process_time() - start)
        return best / 200_000

    assert cost(200) <= 3 * cost(9)
