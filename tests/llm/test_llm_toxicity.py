"""Risk and slopes against plain loops and differences, held-out accuracy on planted words, odd rows."""

import random
from math import exp, log

import numpy as np
import pytest
from conftest_helpers import crc, prose, rows
from pyspark.sql import functions as F

from qadump.llm import toxicity

BAD = ["scoundrel", "rascals", "blackguard"]
KIND = "doc_id long, quality int, toxic int"


def planted(n=700):
    entries, labels = [], []
    for i in range(n):
        words = prose(i, 40).split()
        toxic = i % 6 == 0
        for k in range(2 * toxic):
            words[7 * k + i % 5] = BAD[(i + k) % 3]
        entries.append((i, " ".join(words)))
        if i % 2 == 0 or i % 5 == 0:
            labels.append((i, 1, int(toxic)))
    return entries, labels


def scored(documents, spark, entries, labels):
    found = toxicity.score_texts(documents(entries), spark.createDataFrame(labels, KIND))
    return {r.doc_id: r for r in found.collect()}


def test_held_out_documents(documents, spark):
    entries, labels = planted()
    found = scored(documents, spark, rows(entries), labels)
    assert len(found) == len(entries)
    for i, r in found.items():
        assert r.held_out == (crc(i) % 5 == 0)
        assert r.predicted == (r.score >= 0.5) and 0 <= r.score <= 1
    wrong = [i for i, r in found.items() if r.predicted != (i % 6 == 0)]
    assert len(wrong) <= 7


def test_every_toxic_word_has_features(documents, spark):
    """Twenty words of ten letters make 21 features each, 420 together."""
    bad = [chr(97 + k) * 2 + "qxyzuvwj" for k in range(20)]
    entries, labels = [], []
    for i in range(1500):
        words = prose(i, 40).split()
        if i % 10 == 0:
            words[3:25:3] = [bad[i // 10 % 20]] * len(words[3:25:3])
        entries.append((i, " ".join(words)))
        labels.append((i, 1, int(i % 10 == 0)))
    found = scored(documents, spark, rows(entries), labels)
    assert [i for i, r in found.items() if r.predicted != (i % 10 == 0)] == []


def test_labels_of_held_out_rows_are_not_read(documents, spark):
    entries, labels = planted(300)
    found = scored(documents, spark, rows(entries), labels)
    other = [(i, q, 1 - t if crc(i) % 5 == 0 else t) for i, q, t in labels]
    again = scored(documents, spark, rows(entries), other)
    assert {i: r.score for i, r in again.items()} == {i: r.score for i, r in found.items()}


def test_scores_depend_on_the_text_alone(documents, spark):
    entries, labels = planted(300)
    found = scored(documents, spark, rows(entries) + rows([(5000, entries[6][1])], "other source"), labels)
    assert found[5000].score == found[6].score


def test_tricky_rows_and_labels(documents, spark, tricky, nothing):
    entries, labels = planted(300)
    odd = [(None, 1, 1), (1, None, None), (2, 1, 0), (2, 1, 1), (99999, 1, 1)]
    docs = tricky.unionByName(documents(rows([(i + 1000, t) for i, t in entries])))
    shifted = [(i + 1000, q, t) for i, q, t in labels]
    found = toxicity.score_texts(docs, spark.createDataFrame(shifted + odd, KIND)).collect()
    assert len(found) == docs.count()
    assert all(0 <= r.score <= 1 for r in found)
    assert not any(r.held_out for r in found if r.doc_id is None)
    assert toxicity.score_texts(nothing, spark.createDataFrame(labels, KIND)).collect() == []
    for none in ([], [(1, 1, 0)]):
        unlearned = toxicity.score_texts(tricky, spark.createDataFrame(none, KIND)).collect()
        assert all(r.predicted == 0 and r.score < 1e-6 for r in unlearned)


def test_features_count_words_by_stem():
    assert toxicity.features("Abcde abcdx ab") == {"abcd1", "abcd2", "abcde1", "abcdx1", "ab$1"}
    assert toxicity.features(None) == toxicity.features("1 2") == set()
    long = toxicity.features("abcdefghijklm")
    assert {"*lm1", "*jklm1", "*ab1", "abcdefghij1"} <= long and "abcdefghijk1" not in long
    assert toxicity.features("aaaaaaaaaaaa") >= {"*aa4", "*aaaa4"}
    known = toxicity.Model({"abcd2": 1.5, "ab$1": 0.25}, -1.0)
    assert known.margin("Abcde abcdx, AB! other") == 0.75
    assert known.margin("") == -1.0


def texts(rng, n, words):
    return [rng.choice(words, rng.integers(0, 4), replace=False) for _ in range(n)]


def plain_risks(theta, positive, unlabelled, prior):
    def loss(text, label):
        margin = theta[-1] + sum(theta[f] for f in text)
        return log(1 + exp(-label * margin))

    toxic = prior * sum(loss(t, 1) for t in positive) / len(positive)
    clean = sum(loss(t, -1) for t in unlabelled) / len(unlabelled)
    return toxic, clean - prior * sum(loss(t, -1) for t in positive) / len(positive)


@pytest.mark.parametrize("seed", range(4))
def test_risks_equal_a_loop_and_slopes_equal_differences(seed):
    rng = np.random.default_rng(seed)
    words, prior = 6, 0.3
    theta = rng.normal(size=words + 1) * 2
    positive, unlabelled = texts(rng, 7, words), texts(rng, 12, words)
    arrays = [(*toxicity._rows(sets), len(sets)) for sets in (positive, unlabelled)]
    toxic, clean, up, down = toxicity.risks(theta, *arrays, prior)
    assert (toxic, clean) == pytest.approx(plain_risks(theta, positive, unlabelled, prior))
    for k in range(words + 1):
        ahead, behind = theta.copy(), theta.copy()
        ahead[k] += 1e-5
        behind[k] -= 1e-5
        sides = [plain_risks(t, positive, unlabelled, prior) for t in (ahead, behind)]
        assert up[k] == pytest.approx((sides[0][0] - sides[1][0]) / 2e-5, abs=1e-6)
        assert down[k] == pytest.approx((sides[0][1] - sides[1][1]) / 2e-5, abs=1e-6)


def test_the_fit_lowers_the_non_negative_risk_and_keeps_the_clean_part_up():
    rng = np.random.default_rng(5)
    positive = [np.array([0, 1 + int(k)]) for k in rng.integers(0, 5, 40)]
    unlabelled = [np.array([1 + int(k)] + [0] * (n % 4 == 0)) for n, k in enumerate(rng.integers(0, 5, 200))]

    def risk(theta):
        toxic, clean = plain_risks(theta, positive, unlabelled, 0.25)
        return toxic + max(0.0, clean), clean

    start = np.zeros(7)
    start[6] = log(0.25 / 0.75)
    weights, bias = toxicity.fit(positive, unlabelled, 6, 0.25)
    total, clean = risk(np.append(weights, bias))
    assert total < 0.5 * risk(start)[0]
    assert clean > -0.05


def test_every_letter_of_unbroken_runs_is_read(documents, spark):
    """Each text is two runs of 50 letters; toxic ones hold a piece that begins at letter 11 or later."""
    entries, labels = [], []
    for i in range(900):
        rng = random.Random(i)
        runs = ["".join(rng.choices("abcdeilnorst", k=50)) for _ in range(2)]
        if i % 6 == 0:
            at = 10 + i % 36
            runs[i % 2] = runs[i % 2][:at] + "zzqx" + runs[i % 2][at + 4 :]
        entries.append((i, "\n".join(runs)))
        labels.append((i, 1, int(i % 6 == 0)))
    found = scored(documents, spark, rows(entries), labels)
    assert [i for i, r in found.items() if r.predicted != (i % 6 == 0)] == []


def test_runs_that_differ_late_have_other_features():
    base = "abcdefghij" * 5
    for at in range(10, 50):
        assert toxicity.features(base) != toxicity.features(base[:at] + "X" + base[at + 1 :])


def test_one_id_on_a_third_of_the_rows_leaves_the_sample_small(documents, spark):
    entries = [(k, prose(k, 12)) for k in range(6_000)] + [(7, "scoundrel " + prose(1, 5))] * 3_000
    labels = [(k, 1, int(k % 10 == 7)) for k in range(6_000)]
    docs = documents(rows(entries)).repartition(8).select("doc_id", "text")
    marks = spark.createDataFrame(labels, KIND)
    for usable in (F.lit(True), F.col("doc_id") >= 0):
        sample, prior = toxicity.sampled(docs, marks, usable, 100)
        sizes = {r.confirmed: r["count"] for r in sample.groupBy("confirmed").count().collect()}
        assert prior == 0.1 and 50 <= sizes[True] <= 160 and 50 <= sizes[False] <= 160
        hot = sample.where("confirmed and text like 'scoundrel%'").count()
        assert hot <= 1
        share = sample.where("not confirmed and text like 'scoundrel%'").count() / sizes[False]
        assert 0.15 < share < 0.55  # a third of the rows, a third of the sample


def test_the_risk_is_not_negative_and_falls():
    rng = np.random.default_rng(0)
    positive = [np.array([0, 1 + int(k)]) for k in rng.integers(0, 5, 60)]
    unlabelled = [np.array([1 + int(k)] + [0] * (n % 5 == 0), dtype=np.int64) for n, k in enumerate(rng.integers(0, 5, 400))]
    weights, bias = toxicity.fit(positive, unlabelled, 6, 0.2)
    assert weights[0] > 2 * max(0.1, np.abs(weights[1:]).max())
    margin = np.array([bias + weights[t].sum() for t in unlabelled])
    hot = np.array([0 in t for t in unlabelled])
    assert (margin[hot] > 0).all() and (margin[~hot] < 0).all()
