"""Counts against plain Python, lists learned from planted rules, plans without Python."""

import random
import re

import pytest
from conftest_helpers import prose, rows
from pyspark.sql import functions as F

from qadump.llm import rules

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def counts(text):
    text = text or ""
    words = WORDS.findall(text)
    lines, seen, dups = text.split("\n"), set(), 0
    for line in lines:
        if WORDS.search(line):
            dups += line in seen
            seen.add(line)
    windows = {}
    for i in range(len(words) - 7):
        windows.setdefault(tuple(words[i : i + 8]), []).append(i)
    covered = {j for at in windows.values() if len(at) > 1 for i in at for j in range(i, i + 8)}
    base = (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dups, len(covered))
    return (*base, len(words) < 20 or 100 * len(covered) > 30 * len(words))


def measured(docs):
    found = rules.measured(docs).select("row.text", *rules.COUNTS, "base_failed").collect()
    return sorted((tuple(r) for r in found), key=repr)


def test_counts_equal_plain_python(tricky, documents):
    rng = random.Random(1)
    texts = [
        " ".join(rng.choices("a b c d".split(), k=rng.randint(0, 60))) + "\n" * rng.randint(0, 3) + "a b\na b\n \n \n"
        for _ in range(80)
    ]
    texts += ["w " * 7, "w " * 8, "w " * 9, "w " * 40, "a#b *c* $1 100% x&y | <t> \n\n#\n#", "é😀 " * 20]
    docs = documents(rows(list(enumerate(texts)))).unionByName(tricky)
    expected = sorted(((r.text, *counts(r.text)) for r in docs.collect()), key=repr)
    assert measured(docs) == expected


def labelled(documents, spark, bad, n=400):
    entries, marks = [], []
    for i in range(n):
        text = prose(i, 30 + i % 50)
        low = i % 5 == 0
        entries.append((i, bad(text, i) if low else text))
        marks.append((i, 0 if low else 1, 0))
    labels = spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    return documents(rows(entries)), labels


def judge(docs, labels, **settings):
    judged = rules.measured(docs).drop("row").cache()
    learned = rules.learn(judged, labels, **settings)
    return learned, rules.verdicts(judged.withColumn("row", F.lit(None)), learned)


@pytest.mark.parametrize(
    ("bad", "feature"),
    [
        (lambda t, i: t.replace(" ", " ### "), "symbols_a_word"),
        (lambda t, i: t.upper(), "capitals_a_letter"),
        (lambda t, i: t.replace(" ", "!! "), "bangs_a_word"),
        (lambda t, i: t.replace(" ", "\n"), "words_a_line"),
        (lambda t, i: " ".join(f"{w} {w} {w}" for w in t.split()[::3]), "stutters_a_word"),
    ],
)
def test_planted_rule_is_found(documents, spark, bad, feature):
    docs, labels = labelled(documents, spark, bad)
    learned, judged = judge(docs, labels)
    assert any(c.feature == feature or feature == "words_a_line" for rule in learned for c in rule)
    # Narrow thresholds can leave out a few, too few to earn a rule of their own.
    wrong = judged.join(labels, "doc_id").where(F.col("kept") != (F.col("quality") == 1)).count()
    assert wrong <= 4


def test_two_kinds_need_two_rules(documents, spark):
    docs, labels = labelled(documents, spark, lambda t, i: t.upper() if i % 2 else t.replace(" ", " $ "))
    learned, judged = judge(docs, labels)
    assert len(learned) >= 2
    assert judged.join(labels, "doc_id").where(F.col("kept") != (F.col("quality") == 1)).count() == 0


def stuttered(text):
    return " ".join(f"{w} {w}" for w in text.split())


def test_a_kind_of_a_few_per_cent_gets_its_rule(documents, spark):
    """Eight stutters among 300 low rows: past the last point of a grid over all low rows."""
    bad = {i: stuttered if i % 190 == 0 else lambda t: t.replace(" ", " ### ") for i in range(0, 1500, 5)}
    assert sum(f is stuttered for f in bad.values()) == 8
    docs, labels = labelled(documents, spark, lambda t, i: bad[i](t), n=1500)
    learned, judged = judge(docs, labels)
    assert any(c.feature == "stutters_a_word" for rule in learned for c in rule)
    assert judged.join(labels, "doc_id").where(F.col("kept") != (F.col("quality") == 1)).count() == 0


def test_as_many_rules_as_there_are_kinds(documents, spark):
    """Ten kinds, each a band of symbols a word between bands of good rows."""

    def text_of(i):
        words = prose(i, 60).split()
        return " ".join(f"{w}#" if k < 3 * (i % 20) else w for k, w in enumerate(words))

    entries = [(i, text_of(i)) for i in range(1000)]
    labels = spark.createDataFrame([(i, i % 2, 0) for i, _ in entries], "doc_id long, quality int, toxic int")
    learned, judged = judge(documents(rows(entries)), labels)
    assert len(learned) >= 10
    assert judged.join(labels, "doc_id").where(F.col("kept") != (F.col("quality") == 1)).count() == 0


@pytest.mark.parametrize("feature", ["symbols_a_word", "stutters_a_word"])
def test_planted_kind_is_covered_to_the_last(documents, spark, feature):
    bad = {"symbols_a_word": lambda t, i: t.replace(" ", " ### "), "stutters_a_word": lambda t, i: stuttered(t)}
    docs, labels = labelled(documents, spark, bad[feature])
    _, judged = judge(docs, labels)
    assert judged.join(labels, "doc_id").where(F.col("kept") != (F.col("quality") == 1)).count() == 0


def test_noise_teaches_nothing(documents, spark):
    docs, labels = labelled(documents, spark, lambda t, i: t)
    learned, judged = judge(docs, labels)
    assert judged.where("not base_failed and not kept").count() <= 12


def test_a_list_is_the_first_match_in_order(spark):
    c = rules.Condition
    table = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0), (None, 9.0)], "words double, word_length double")
    listed = [(c("words", True, 2.0),), (c("word_length", True, 4.0), c("words", False, 2.0))]
    found = [r[0] for r in table.select(rules.first_match(listed)).collect()]
    assert found == ["word_length > 4 and words <= 2", "words > 2", None]


def test_labels_may_be_empty_null_repeated_or_foreign(documents, spark, tricky, nothing):
    kind = "doc_id long, quality int, toxic int"
    for docs in (tricky, nothing):
        for marks in ([], [(1, None, None), (None, 0, 0), (777, 0, 0)], [(2, 1, 0), (2, 0, 0)]):
            learned, judged = judge(docs, spark.createDataFrame(marks, kind))
            assert learned == []
            assert judged.where("kept = base_failed").count() == 0


def test_accepted_keeps_the_columns(tricky):
    kept = rules.accepted(tricky, [])
    assert kept.columns == tricky.columns
    expected = sorted((r for r in tricky.collect() if not counts(r.text)[-1]), key=repr)
    assert sorted(kept.collect(), key=repr) == expected


def test_no_python_in_the_plan(tricky):
    plan = rules.accepted(tricky, [(rules.Condition("words", True, 2.0),)])._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
