"""Fingerprints against plain Python, links against all pairs, components against union-find."""

import random
import re
from itertools import combinations

import numpy as np
import pytest
import xxhash
from conftest_helpers import prose, rows
from pyspark.sql import functions as F

from qadump.llm import common, components, simhash

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def fingerprint(text, shingle=3):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = WORDS.findall(lower)
    if not words:
        return 0
    width = min(shingle, len(words))
    shingles = [" ".join(words[i : i + width]) for i in range(len(words) - width + 1)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def union(ids, edges):
    parent = {i: i for i in ids}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in edges:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {i: root(i) for i in ids}


def near(fps, distance=3):
    return [(a, b) for a, b in combinations(fps, 2) if bin(a ^ b).count("1") <= distance]


def groups_by_hand(docs):
    """(doc_id, fingerprint, component) of every row; ids name groups, nulls never do."""
    found = [(r.doc_id, fingerprint(r.text)) for r in docs.collect()]
    root = union({f for _, f in found}, near({f for _, f in found}))
    least = {}
    for i, f in found:
        if i is not None:
            least[root[f]] = min(i, least.get(root[f], i))
    return sorted(((i, f"{f:016x}", least.get(root[f])) for i, f in found), key=repr)


def groups(docs):
    found = simhash.groups(docs).select("doc_id", simhash.hexadecimal("fp"), "component_id")
    return sorted((tuple(r) for r in found.collect()), key=repr)


def test_spark_hashes_alike(spark):
    value = spark.sql("select xxhash64('a b c') as h").first().h
    assert value % 2**64 == xxhash.xxh64_intdigest(b"a b c", seed=42)


def test_tricky_rows(tricky):
    assert groups(tricky) == groups_by_hand(tricky)


def test_empty_table(nothing):
    assert groups(nothing) == []
    assert simhash.deduplicated(nothing).collect() == []


def test_near_copies(documents):
    rng, entries = random.Random(4), []
    for i in range(120):
        words = prose(i // 4, 300).split()
        for _ in range(i % 4):
            words[rng.randrange(300)] = "changed"
        entries.append((i * 7 % 120, " ".join(words)))
    docs = documents(rows(entries))
    assert groups(docs) == groups_by_hand(docs)
    assert len({g[2] for g in groups(docs)}) < 120


@pytest.mark.parametrize("size", [1, 7, 100])
def test_blocks_of_a_long_text_change_nothing(monkeypatch, size):
    monkeypatch.setattr(common, "BLOCK", size)
    for text in (prose(3, 500), "a b", "a", "  a \n\n b  c d", "x" * 50 + " y", ""):
        assert simhash.fingerprint(text) == fingerprint(text)
        assert "".join(common.blocks(text)) == text


def test_a_linked_pair_meets_at_a_home():
    """For all places of up to 3 differing bits, on random fingerprints."""
    rng = np.random.default_rng(1)
    for _ in range(300):
        one = int(rng.integers(0, 2**64, dtype=np.uint64))
        other = one
        for bit in rng.choice(64, rng.integers(0, 4), replace=False):
            other ^= 1 << int(bit)
        pair = np.array([one, other], dtype=np.uint64).view(np.int64)
        keys, owner = simhash.anchors(pair)
        first, second = set(keys[owner == 0].tolist()), set(keys[owner == 1].tolist())
        assert len(first) <= 34
        own = {int(h) | side << 32 for side, half in enumerate(simhash.halves(pair)) for h in simhash.homes(half)[0][:1]}
        assert own & second and own <= first


def random_family(rng, members, spread):
    start = rng.getrandbits(64)
    return {start ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, spread))) for _ in range(members)}


@pytest.mark.parametrize("block", [5, 4096])
def test_links_connect_what_all_pairs_connect(spark, block):
    rng = random.Random(9)
    fps = {rng.getrandbits(64) for _ in range(200)} | {0, 2**64 - 1, 1, 2**63}
    for _ in range(12):
        fps |= random_family(rng, 30, rng.randint(1, 5))
    signed = [f - 2**64 if f >= 2**63 else f for f in fps]
    table = spark.createDataFrame([(f,) for f in signed], "fp long")
    links = [(r.a % 2**64, r.b % 2**64) for r in simhash.links(table, block=block).collect()]
    assert all(bin(a ^ b).count("1") <= 3 for a, b in links)
    assert union(fps, links) == union(fps, near(fps))


def test_one_of_each_group_stays(documents, tricky):
    kept = simhash.deduplicated(tricky)
    assert kept.columns == tricky.columns
    by_hand = groups_by_hand(tricky)
    assert kept.count() == len({g[2] for g in by_hand})
    assert {r.doc_id for r in kept.collect()} == {g[2] for g in by_hand}
    same = documents(rows([(None, "a b c")] * 3))
    assert simhash.deduplicated(same).count() == 1


@pytest.mark.parametrize("kind", ["path", "star", "random", "none"])
def test_components_equal_union_find(spark, kind):
    rng = random.Random(2)
    edges = {
        "path": [(i, i + 1) for i in range(-40, 60)],
        "star": [(50, i) for i in range(100) if i != 50],
        "random": [(rng.randrange(300), rng.randrange(300)) for _ in range(180)],
        "none": [(3, 3)],
    }[kind]
    found = {r.vertex: r.root for r in components.roots(spark.createDataFrame(edges, "a long, b long")).collect()}
    expected = union({v for e in edges for v in e}, edges)
    assert found == {v: r for v, r in expected.items() if v != r}


def test_zero_fingerprints_link_like_others(documents):
    docs = documents(rows([(5, None), (4, " "), (9, "")]))
    assert groups(docs) == [(4, "0" * 16, 4), (5, "0" * 16, 4), (9, "0" * 16, 4)]
    assert simhash.deduplicated(docs).select(F.max("doc_id")).first()[0] == 4


def test_a_fingerprint_with_a_third_of_all_rows_is_a_skewed_join(spark, documents, settings):
    """The adaptive join splits its rows, whose group has the right name in every part."""
    settings(
        spark__sql__shuffle__partitions="8",
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__coalescePartitions__enabled="false",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="4k",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="4k",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="1.5",
    )
    entries = [(k, "" if k % 3 == 0 else prose(k, 12)) for k in range(3_000)]
    found = simhash.groups(documents(rows(entries)).repartition(6))
    names = {r.doc_id: r.component_id for r in found.collect()}
    assert all(names[k] == (0 if k % 3 == 0 else k) for k, _ in entries)
    assert "skew=true" in found._jdf.queryExecution().executedPlan().toString()
