"""Every bucket, gain, score and rank against a plain loop; any head gives the same; odd rows."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from conftest_helpers import prose, rows
from hypothesis import given
from hypothesis import settings as limits
from hypothesis import strategies as st

from qadump.llm import common, importance

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_words(text):
    return WORD.findall((text or "").translate(LOWER))


def plain_buckets(text, buckets=10_000):
    words = plain_words(text)
    features = words + [f"{a} {b}" for a, b in zip(words, words[1:], strict=False)]
    return [zlib.crc32(f.encode()) % buckets for f in features]


def plain(docs, target, share=25, least_words=20, buckets=10_000, seed=7):
    """(doc_id, n_features, weight, score, rank) of (doc_id, text) rows, in any order."""
    own = [plain_buckets(text, buckets) for _, text in docs]
    s, t = Counter(b for f in own for b in f), Counter(b for text in target for b in plain_buckets(text, buckets))
    big_s, big_t = sum(s.values()), sum(t.values())

    def gain(b):
        return math.floor(1000 * math.log((t[b] + 1) * (big_s + buckets) / ((s[b] + 1) * (big_t + buckets))))

    out = []
    for (doc_id, text), f in zip(docs, own, strict=True):
        weight = sum(map(gain, f)) // len(f) if f else 0
        h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))
        out.append((doc_id, len(f), weight, score, len(plain_words(text)) >= least_words))
    fit = sorted((r for r in out if r[4]), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    ranked = [(*r[:4], k + 1 if k < share * len(fit) // 100 else None) for k, r in enumerate(fit)]
    return ranked + [(*r[:4], None) for r in out if not r[4]]


def found(docs, target, **settings):
    result = importance.resampled(docs, target, **settings)
    return sorted(map(repr, (tuple(r) for r in result.collect())))


@pytest.fixture(scope="module")
def corpus(spark):
    texts = [(k, f"{prose(k, 5 + k % 40)} The, {prose(k % 7, 30)} Éa{k % 3}x the-end") for k in range(200)]
    target = [f"The {prose(k % 7, 30)}" for k in range(9)]
    return texts, target, spark.createDataFrame([(k, t) for k, t in enumerate(target)], "item_id long, text string")


@pytest.mark.parametrize(
    "settings",
    [
        {},
        {"share": 60, "least_words": 50, "buckets": 97, "seed": 3},
        {"buckets": 70_000},
        {"head_rows": 0},
        {"head_rows": 10, "head_words": 5, "head_pairs": 3},
    ],
)
def test_rows_equal_a_loop_whatever_the_head(corpus, documents, settings):
    texts, target, items = corpus
    own = {k: v for k, v in settings.items() if not k.startswith("head")}
    expected = sorted(map(repr, plain(texts, target, **own)))
    assert found(documents(rows(texts)), items, **settings) == expected


words = st.lists(st.sampled_from(["a", "b", "é", "the", "x" * 70, "7"]), max_size=30)


@given(words, words, st.integers(1, 70_000))
@limits(max_examples=60, deadline=None)
def test_buckets_equal_direct_crcs(text, frequent, buckets):
    head = importance.Head.of(
        [w.encode() for w in frequent], [(a.encode(), b.encode()) for a, b in zip(frequent, frequent[1:], strict=False)], buckets
    )
    body = ", ".join(text)
    count, got = head.text(body)
    assert count == len(text)
    assert sorted(got.tolist()) == sorted(plain_buckets(body, buckets))


@given(st.text(max_size=60))
def test_words_are_those_of_the_pattern(text):
    runs = list(importance.words_of(text))
    assert [w.decode() for run in runs for w in run] == plain_words(text)


def test_very_long_texts_are_read_in_blocks(monkeypatch):
    monkeypatch.setattr(common, "BLOCK", 50)
    head = importance.Head.of([b"ab"], [], 1_000)
    for text in (prose(3, 400), "x" * 300, "a\nb" * 90, " " * 200 + "a b"):
        count, got = head.text(text)
        assert count == len(plain_words(text))
        assert sorted(got.tolist()) == sorted(plain_buckets(text, 1_000))


def test_odd_rows(spark, tricky, corpus):
    _, target, items = corpus
    docs = [(r.doc_id, r.text) for r in tricky.collect()]
    assert found(tricky, items, share=100) == sorted(map(repr, plain(docs, target, share=100)))
    null = spark.createDataFrame([(1, None), (2, "")], "item_id long, text string")
    assert found(tricky, null) == sorted(map(repr, plain(docs, [])))


def test_empty_tables(nothing, spark, corpus):
    texts, _, items = corpus
    assert found(nothing, items) == []
    none = spark.createDataFrame([], "item_id long, text string")
    assert found(nothing, none) == []


def test_a_hot_row_keeps_all_its_copies_and_spreads(documents, corpus, settings):
    settings(spark__sql__shuffle__partitions="8")
    texts, target, items = corpus
    many = texts + [texts[3]] * 400
    result = importance.resampled(documents(rows(many)), items, share=100, least_words=0)
    ranks = [r.rank for r in result.collect()]
    assert sorted(ranks) == list(range(1, len(many) + 1))
    assert found(documents(rows(many)), items) == sorted(map(repr, plain(many, target)))


def test_carried_columns_come_with_the_drawn_rows(documents, corpus):
    texts, _, items = corpus
    result = importance.resampled(documents(rows(texts)), items, carried=["text", "score", "rank"])
    by_id = dict(texts)
    for r in result.collect():
        assert r.row.text == by_id[r.doc_id] and r.row.score == 7


def test_the_drawn_share_leans_towards_the_target(documents, spark):
    def from_words(seed, of):
        rng = random.Random(seed)
        return " ".join(rng.choices([f"{of}{k}" for k in range(50)], k=60))

    texts = [(k, from_words(k, "a" if k % 4 == 0 else "b")) for k in range(400)]
    items = spark.createDataFrame([(k, from_words(-1 - k, "a")) for k in range(300)], "item_id long, text string")
    drawn = [r.doc_id for r in importance.resampled(documents(rows(texts)), items).where("rank is not null").collect()]
    assert len(drawn) == 100 and sum(k % 4 == 0 for k in drawn) > 50  # 25 by chance


def test_gains_follow_the_formula():
    source, target = np.array([3, 0, 10, 0]), np.array([1, 2, 0, 0])
    for b, gain in enumerate(importance.gains(source, target)):
        assert gain == math.floor(1000 * math.log((target[b] + 1) * 17 / ((source[b] + 1) * 7)))
