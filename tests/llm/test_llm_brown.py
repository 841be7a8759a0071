"""Scores against a second computation, probabilities that sum to 1, the exchange step."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from conftest_helpers import rows

from qadump.llm import brown, common

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
SMALL = {"classes": 4, "exchanged": 12, "looked_up": 20}


def tokens(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [*WORDS.findall(lower), None]


def is_held(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 1


def sentences(n):
    rng = np.random.default_rng(6)
    nouns, verbs = [f"noun{k}" for k in range(15)], [f"verb{k}" for k in range(15)]
    return [
        (i, " ".join(f"The {nouns[rng.integers(15)]} {verbs[rng.integers(15)]} a{rng.integers(200)}" for _ in range(rng.integers(0, 12))))
        for i in range(n)
    ]


def test_base_scores_and_counts(documents, tricky):
    docs = documents(rows(sentences(60))).unionByName(tricky)
    found = sorted(brown.score_texts(docs, **SMALL).collect(), key=lambda r: (str(r.doc_id), r.n_tokens, r.base_score))
    every = [(r.doc_id, tokens(r.text)) for r in docs.collect()]
    c = Counter(t for i, words in every if not is_held(i) for t in words)
    total, distinct = sum(c.values()), len(c)
    expected = sorted(
        (
            (
                i,
                is_held(i),
                len(words),
                sum(c[t] > 0 for t in words),
                sum(math.log10((c[t] + 0.5) / (total + 0.5 * (distinct + 1))) for t in words),
            )
            for i, words in every
        ),
        key=lambda e: (str(e[0]), e[2], e[4]),
    )
    assert len(found) == len(expected)
    for r, (i, held, n, known, base) in zip(found, expected, strict=True):
        assert (r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (i, held, n, known, total)
        assert r.base_score == pytest.approx(base)
        assert r.score <= 1e-9 and math.isfinite(r.score)


def test_blocks_of_a_long_text_change_nothing(documents, monkeypatch):
    docs = documents(rows(sentences(12)))
    whole = sorted(map(tuple, brown.score_texts(docs, **SMALL).collect()))
    texts = [text for _, text in sentences(12)]
    expected = [brown.tokens(t) for t in texts]
    monkeypatch.setattr(common, "BLOCK", 9)
    assert [brown.tokens(t) for t in texts] == expected
    assert len(list(brown.token_runs(max(texts, key=len)))) > 5
    assert len(whole) == 12


def trained(docs, **settings):
    base = docs.selectExpr("doc_id", "text", "true as train", "monotonically_increasing_id() as uid")
    counts = brown.word_counts(base).cache()
    return base, counts, brown.train(base, counts, **(SMALL | settings))


def test_score_equals_the_model_s_definition(documents):
    base, counts, model = trained(documents(rows(sentences(50))))
    count = {r.word.encode(): r.c for r in counts.collect()}
    mass = sum(c for w, c in count.items() if model.frequent.get(w, (0, model.rare))[1] == model.rare)

    def emission(word):
        group = model.frequent.get(word, (0, model.rare))[1]
        if group < model.rare:
            return math.log10(count[word] / model.class_tokens[group])
        if count.get(word):
            return math.log10((count[word] - model.discount) / mass)
        return math.log10(model.discount * model.rare_types / mass)

    texts = documents(rows([*sentences(20), (77, "never seen words"), (78, None)]))
    asked = texts.selectExpr("doc_id", "text", "monotonically_increasing_id() as uid")
    for r in brown.scores(asked, model, counts).join(texts.select("doc_id", "text"), "doc_id").collect():
        expected, before = 0.0, model.frequent[brown.END][1]
        for word in brown.tokens(r.text):
            group = model.frequent.get(word, (0, model.rare))[1]
            expected += model.transition[before, group] + emission(word)
            before = group
        assert r.score == pytest.approx(expected)


def test_probabilities_sum_to_one(documents):
    _, counts, model = trained(documents(rows(sentences(50))))
    assert np.allclose((10**model.transition).sum(axis=1), 1)
    mass = Counter()
    for r in counts.collect():
        group = model.frequent.get(r.word.encode(), (0, model.rare))[1]
        discount = model.discount if group == model.rare else 0
        mass[group] += (r.c - discount) / model.class_tokens[group]
    mass[model.rare] += 10 ** model.rare_emission()[1]
    for group, tokens_of in enumerate(model.class_tokens):
        if tokens_of:
            assert mass[group] == pytest.approx(1)


def fully_trained(docs, often=lambda counts: None):
    base, counts, model = trained(docs)
    often = often(counts)
    words = brown.assigned(base, model, often)
    model = brown.with_classes(model, words)
    found = brown.sequences(base, model, words, often).cache()
    return base, counts, words, found, brown.refitted(model, found, counts)


def full(counts):
    return brown.Repeated(np.full(8, 255, np.uint8))


@pytest.mark.parametrize("often", [lambda counts: None, brown.repeated, full], ids=["none", "bitmap", "full"])
def test_every_word_seen_twice_has_a_class(documents, often):
    _, counts, words, found, model = fully_trained(documents(rows(sentences(120))), often)
    c = {r.word.encode(): r.c for r in counts.collect()}
    group = {r.word.encode(): r.group for r in words.collect()}
    group |= {w: g for w, (count, g) in model.frequent.items() if count}
    if often is brown.repeated:
        left_out = c.keys() - group.keys()
        assert left_out and all(c[w] == 1 for w in left_out)
        group |= dict.fromkeys(left_out, model.rare)
    assert group.keys() == c.keys() and any(n > 1 for w, n in c.items() if w not in model.frequent)
    assert all((group[w] < model.rare) == (n > 1) for w, n in c.items())
    # Tokens of classes and transitions follow from those classes.
    tokens_of = Counter()
    for w, n in c.items():
        tokens_of[group[w]] += n
    assert [tokens_of[k] for k in range(model.rare + 1)] == model.class_tokens.tolist()
    total = Counter()
    for w, n in c.items():
        total[group[w]] += (n - model.discount * (group[w] == model.rare)) / tokens_of[group[w]]
    total[model.rare] += 10 ** model.rare_emission()[1]
    assert all(p == pytest.approx(1) for p in total.values())
    assert np.allclose((10**model.transition).sum(axis=1), 1)
    # And scores from both.
    for r in brown.scored(found, model).join(documents(rows(sentences(120))).select("doc_id", "text"), "doc_id").collect():
        expected, before = 0.0, group[brown.END]
        for w in brown.tokens(r.text):
            own = c[w] - model.discount * (group[w] == model.rare)
            expected += model.transition[before, group[w]] + math.log10(own / tokens_of[group[w]])
            before = group[w]
        assert r.score == pytest.approx(expected)


@pytest.mark.parametrize("rows_a_batch", ["10000", "3"])
def test_assigned_classes_equal_a_loop_over_occurrences(documents, settings, rows_a_batch):
    settings(spark__sql__execution__arrow__maxRecordsPerBatch=rows_a_batch)
    docs = documents(rows(sentences(150))).repartition(5)
    base, _, model = trained(docs)
    rare, k = model.rare, len(model.class_tokens)
    moved = {w: g for w, (_, g) in model.frequent.items() if g < rare}
    share = (model.class_tokens + 0.5) / (model.class_tokens.sum() + 0.5 * k)
    value, count = {}, Counter()
    for r in base.where("train").collect():
        run = [brown.END, *brown.tokens(r.text)]
        for before, word, after in zip(run[:-1], run[1:], [*run[2:], None], strict=True):
            if word in moved:
                continue
            a, b = moved.get(before, rare), moved.get(after, rare)
            own = value.setdefault(word, np.zeros(rare - 1))
            own += [model.transition[a, g] - math.log10(share[g]) + model.transition[g, b] for g in range(rare - 1)]
            count[word] += 1
    found = {r.word.encode(): (r.c, r.group) for r in brown.assigned(base, model).collect()}
    assert found.keys() == value.keys() and len(found) > 100
    for word, (c, group) in found.items():
        assert c == count[word]
        if c > 1:
            assert value[word][group] == pytest.approx(value[word].max())
        else:
            assert group == rare


def test_the_bitmap_has_every_word_that_occurs_twice(spark):
    counts = [(f"w\u00e9{k}", 1 + k % 3 % 2) for k in range(9_000)] + [(" ", 5)]
    table = spark.createDataFrame([(w, 0, n) for w, n in counts], "word string, c long, n long").repartition(4)
    found = brown.repeated(table)
    again = dict(zip(counts, found.among([w.encode() for w, _ in counts]), strict=True))
    assert all(there for (_, n), there in again.items() if n > 1)
    # Of the others only those that share a bit: an eighth at most, as there are eight bits a word.
    assert sum(there for (_, n), there in again.items() if n == 1) < 6_000 / 6
    assert len(found.bits) * 8 == 32_768
    assert not brown.repeated(table.where("n = 1")).among([b"a", b"b"]).any() and len(found.among([])) == 0


def test_the_bitmap_s_size_is_bounded_and_changes_nothing(documents, monkeypatch):
    docs = documents(rows(sentences(60)))
    whole = sorted(brown.score_texts(docs, **SMALL).collect())
    monkeypatch.setattr(brown, "repeated", full)
    for one, two in zip(whole, sorted(brown.score_texts(docs, **SMALL).collect()), strict=True):
        assert tuple(one) == pytest.approx(tuple(two))


@pytest.mark.parametrize("most", [1, 7, 40, 500])
def test_the_most_frequent_words_are_those_of_a_sort(spark, most):
    rng = np.random.default_rng(3)
    counts = [(f"w{k}", int(c)) for k, c in enumerate(np.r_[rng.integers(0, 6, 150), rng.integers(0, 10**6, 40)])]
    found = brown.most_frequent(spark.createDataFrame(counts, "word string, c long").repartition(6), "c", most)
    expected = sorted(((w, c) for w, c in counts if c), key=lambda e: (-e[1], e[0]))[:most]
    assert [tuple(r) for r in found.collect()] == expected


def test_sizes_follow_the_vocabulary():
    sizes = [brown.sizes_for(v) for v in (0, 10, 360_000, 4_000_000, 10**9)]
    assert sizes[0] == sizes[1] == (1_500, 32) and sizes == sorted(sizes)
    assert sizes[3][0] > 2_000 and sizes[4][0] > 5_000 and sizes[4][1] > 55
    # The table of the words that move stays within what a driver holds.
    assert 8 * sizes[4][0] ** 2 < 300_000_000


def test_words_outside_the_exchange_join_their_like(documents):
    """Rare adjectives and adverbs, each between words that tell which it is."""
    rng = np.random.default_rng(9)
    texts = []
    for i in range(400):
        one, two = rng.integers(60, size=2)
        texts.append((i, " ".join(["the", f"adj{one}", "house", "sleeps", f"adv{two}", "now"] * 2)))
    _, _, words, _, model = fully_trained(documents(rows(texts)))
    found = {r.word: r.group for r in words.collect()}
    kinds = [{g for w, g in found.items() if w.startswith(k)} for k in ("adj", "adv")]
    assert all(kinds) and not kinds[0] & kinds[1]


def test_movers_are_ranked_by_training_counts(documents):
    held = [i for i in range(300) if is_held(i)][:30]
    learned = [i for i in range(300) if not is_held(i)][:30]
    docs = documents(rows([(i, " ".join(f"only{k}" for k in range(25)) * 2) for i in held] + [(i, "dog cat") for i in learned]))
    base = docs.selectExpr("doc_id", "text", "false as train", "monotonically_increasing_id() as uid")
    base = base.withColumn("train", base.doc_id.isin(learned))
    model = brown.train(base, brown.word_counts(base).cache(), **SMALL)
    assert all(model.frequent[w][1] < model.rare for w in (b"dog", b"cat"))


def likelihood(counts, of):
    member = np.eye(of.max() + 1)[of]
    table = member.T @ counts @ member
    return brown._information(table).sum() - 2 * brown._information(table.sum(axis=1)).sum()


def test_exchange_raises_the_likelihood_and_stops_at_a_local_best():
    rng = np.random.default_rng(4)
    hidden = rng.permutation(np.repeat([0, 1, 2], 8))
    chance = np.array([[1, 12, 1], [1, 1, 12], [12, 1, 1]])[hidden][:, hidden]
    counts = rng.poisson(chance).astype(float)
    counts = np.pad(counts, (0, 2))
    counts[:24, 24] = counts[24, :24] = 1
    of = brown.exchange(counts, 3, fixed=2, rounds=30)
    start = np.r_[np.arange(24) % 3, 3, 4]
    best = likelihood(counts, of)
    assert best > likelihood(counts, start)
    # Row and column sums differ a little, so the objective is one of two near ones.
    worse = 0
    for w in range(24):
        for group in range(3):
            moved = of.copy()
            moved[w] = group
            worse += likelihood(counts, moved) > best + 2.0
    assert worse == 0
    assert all(len(set(of[:24][hidden == k])) == 1 for k in range(3))


def test_held_out_text_is_likelier_than_under_the_base(documents):
    found = brown.score_texts(documents(rows(sentences(400))), **SMALL).where("held_out").collect()
    assert sum(r.score for r in found) > sum(r.base_score for r in found)


def test_empty_tables(nothing, documents):
    assert brown.score_texts(nothing).collect() == []
    lonely = brown.score_texts(documents(rows([(1, None), (2, "")]))).collect()
    assert sorted((r.n_tokens, r.train_tokens > 0) for r in lonely) in ([(1, True)] * 2, [(1, False)] * 2)
    held = next(i for i in range(100) if is_held(i))
    only_held = brown.score_texts(documents(rows([(held, "a b")]))).collect()
    assert (only_held[0].train_tokens, only_held[0].n_known) == (0, 0)
