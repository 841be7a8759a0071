"""Viterbi against all paths, blocks against one pass, roles recovered from transcripts."""

import random
import zlib
from itertools import product

import numpy as np
import pytest
from conftest_helpers import prose
from pyspark.sql import functions as F

from qadump.llm import chat

KIND = "conv_id long, turn long, role string, text string, number long, line long, uid long"


def model(seed=1):
    rng = np.random.default_rng(seed)
    tables = [rng.random((chat.STATES, n)) for n in (chat.STATES, *chat.SIZES)]
    start = rng.random(chat.STATES)
    step, *emit = (np.log(t / t.sum(axis=1, keepdims=True)) for t in tables)
    return chat.Model(np.log(start / start.sum()), step, tuple(emit))


LINES = ["User: hi?", "", "some longer line of text.", "AI: 1. yes", "* b:"]


def all_paths(own, lines, before, after):
    emissions = own.emissions(lines)
    best = (-np.inf, None)
    for path in product(range(chat.STATES), repeat=len(lines)):
        if after is not None and path[-1] != after:
            continue
        score = own.start[path[0]] if before is None else own.step[before, path[0]]
        score += emissions[0, path[0]]
        for k in range(1, len(path)):
            score += own.step[path[k - 1], path[k]] + emissions[k, path[k]]
        best = max(best, (score, list(path)))
    return best


@pytest.mark.parametrize("before", [None, 2])
@pytest.mark.parametrize("after", [None, 5])
def test_viterbi_is_the_best_of_all_paths(before, after):
    own = model()
    score, path = all_paths(own, LINES, before, after)
    assert own.decode(LINES, before, after) == path
    if after is not None:
        best, opening = own.table(LINES, before is None)
        assert best[before or 0, after] == pytest.approx(score)
        assert opening[before or 0, after] == path[0]


def conversations(n, turns, seed=0):
    data = []
    for c in range(n):
        for t in range(turns):
            role = "system" if t == 0 and c % 3 == 0 else ("user" if t % 2 == (c % 3 == 0) else "assistant")
            size = {"system": 12, "user": 8, "assistant": 60}[role]
            text = prose(1000 * c + t + seed, size) + ("\n" + prose(t, 50) if role == "assistant" else "")
            data.append((c, t, role, text, 1, 1, 1))
    return data


def found(spark, data, **settings):
    result = chat.format_conversations(spark.createDataFrame(data, KIND), **settings)
    return [r.asDict() for r in result.orderBy("conv_id", "number", "line").collect()]


STYLES = (
    {"system": "System: ", "user": "User: ", "assistant": "Assistant: "},
    {"system": "### Instructions:\n", "user": "### Human:\n", "assistant": "### AI:\n"},
    {"system": "[Context] ", "user": "Q: ", "assistant": "A: "},
)


def marked(data, every=1):
    """The turns with markers in one of several styles; of every `every`th conversation none."""
    return [
        (c, t, role, (STYLES[c % 3][role] if every == 1 or c % every else "") + text, *rest)
        for c, t, role, text, *rest in data
    ]


def accuracy(turns, data):
    truth = {(c, t): role for c, t, role, *_ in data}
    right = [r["line"] == 0 and r["role"] == truth[r["conv_id"], r["number"]] for r in turns if r["held_out"]]
    expected = sum(zlib.crc32(str(c).encode()) % 4 == 0 for c, *_ in data)
    assert expected > 50
    return sum(right) / max(len(right), expected)


def test_roles_of_unmarked_turns_are_recovered(spark):
    data = conversations(60, 7)
    assert accuracy(found(spark, data), data) >= 0.95


def test_roles_of_marked_turns_are_recovered(spark):
    data = conversations(80, 7)
    turns = found(spark, marked(data, 4))
    assert accuracy(turns, data) >= 0.95
    bodies = {(c, t): text for c, t, _, text, *_ in data}
    for r in turns:
        assert r["text"] == bodies[r["conv_id"], r["number"]]  # without its marker, with its line breaks
        assert r["rendered"] == f"<|{r['role']}|>\n{r['text']}\n<|end|>\n"


@pytest.mark.parametrize("learned_from_marked", [True, False])
def test_transcripts_in_one_text_are_taken_apart_by_their_markers(spark, learned_from_marked):
    """Learned from conversations of one turn a row; asked for whole ones in one row.

    Markers on lines of their own must have been seen; "Name: text" needs no example.
    """
    data = conversations(40, 6)
    whole = {}
    for c, _, role, text, *_ in marked(conversations(30, 6, seed=99)):
        if learned_from_marked or c % 3 != 1:
            whole.setdefault(c, []).append((role, text))
    held = [c for c in range(1000, 1200) if zlib.crc32(str(c).encode()) % 4 == 0][: len(whole)]
    rows = [(k, 0, None, "\n".join(t for _, t in whole[c]), 1, 1, 1) for k, c in zip(held, whole, strict=True)]
    turns = found(spark, (marked(data) if learned_from_marked else data) + rows)
    right = 0
    for k, c in zip(held, whole, strict=True):
        own = [r["role"] for r in turns if r["conv_id"] == k]
        right += own == [role for role, _ in whole[c]]
    assert right >= 0.9 * len(held)


def test_held_out_roles_are_not_read(spark):
    for data in (conversations(40, 6), marked(conversations(40, 6), 3)):
        swap = {"user": "assistant", "assistant": "user", "system": "judge"}
        other = [(c, t, swap[role] if zlib.crc32(str(c).encode()) % 4 == 0 else role, *rest) for c, t, role, *rest in data]
        assert other != data and found(spark, data) == found(spark, other)


def test_texts_survive(spark):
    """Line breaks, and what looks like a marker in a conversation that has no others."""
    data = conversations(30, 4)
    texts = ["A: a real answer begins so", "\n\nspace around\n\n", "\n", "", "Q: what?\nA: that.", "  kept  "]
    data += [(1000 + k, t, role, text, 1, 1, 1) for k in range(9) for t, (role, text) in enumerate(
        [("user", "what is it, then?"), ("assistant", texts[k % 6]), ("user", prose(k, 9)), ("assistant", prose(k, 50))])]
    turns = found(spark, data)
    bodies = {(c, t): text for c, t, _, text, *_ in data}
    for (c, t), text in bodies.items():
        own = [r["text"] for r in turns if (r["conv_id"], r["number"]) == (c, t)]
        assert "\n".join(own) == text


def joined(turns):
    """Whole turns from their pieces, in order."""
    whole = []
    for r in turns:
        key = (r["conv_id"], r["number"], r["line"], r["role"])
        if r["continues"]:
            assert whole[-1][0][0] == r["conv_id"] and whole[-1][0][3] == r["role"]
            whole[-1] = (whole[-1][0], whole[-1][1] + r["rendered"])
        else:
            whole.append((key, r["rendered"]))
    for key, rendered in whole:
        assert rendered.startswith(f"<|{key[3]}|>\n") and rendered.endswith("\n<|end|>\n")
        assert rendered.count("<|end|>") == 1
    return whole


def test_blocks_equal_one_pass(spark):
    for data in (conversations(6, 23), marked(conversations(9, 23))):
        whole = joined(found(spark, data, block=1000))
        for size in (1, 4):
            assert joined(found(spark, data, block=size)) == whole


def test_turns_that_go_over_an_edge_are_rendered_once():
    """A model for which lines of one turn come in chunks of their own, markers too."""
    rng = np.random.default_rng(8)
    tables = [rng.random((chat.STATES, n)) for n in (chat.STATES, *chat.SIZES)]
    step, *emit = (np.log(t / t.sum(axis=1, keepdims=True)) for t in tables)
    goes_on = np.log(np.array([[0.8 if b == (a | 1) else 0.04 for b in range(chat.STATES)] for a in range(chat.STATES)]))
    own = chat.Model(step[0], goes_on, tuple(0.2 * e for e in emit))
    over = 0
    for seed in range(40):
        rng = random.Random(seed)
        lines = [rng.choice(["User:", "AI: yes", "word", "", "and so on.", "Q:", "A: x"]) for _ in range(12)]
        places = [(k, 0, None) for k in range(12)]
        opens = [True] * 12
        states = own.decode(lines, None, None, opens)
        for is_marked in (True, False):
            whole = [t[5] for t in chat.turns_of(lines, places, states, None, None, is_marked)]
            for size in (1, 3, 5):
                pieces = []
                for k in range(0, 12, size):
                    around = [None, *states, None]
                    some = slice(k, min(k + size, 12))
                    before, following = around[k], around[min(k + size, 12) + 1]
                    for turn in chat.turns_of(lines[some], places[some], states[some], before, following, is_marked):
                        if turn[3]:
                            over += 1
                            pieces[-1] += turn[5]
                        else:
                            pieces.append(turn[5])
                assert pieces == whole
    assert over > 100


def test_the_edges_of_blocks_are_those_of_one_pass():
    own = model(3)
    rng = random.Random(1)
    lines = [rng.choice(LINES) for _ in range(30)]
    opens = [rng.random() < 0.5 for _ in range(30)]
    states = own.decode(lines, None, None, opens)
    for cut in range(1, 30):
        best, opening = own.table(lines[cut:], False, opens[cut:])
        first, _ = own.table(lines[:cut], True, opens[:cut])
        ways = first[0][:, None] + best
        after = int(ways.max(axis=0).argmax())
        before = int(ways[:, after].argmax())
        assert (before, int(opening[before, after]), after) == (states[cut - 1], states[cut], states[-1])


def test_blocks_hold_repeated_and_null_numbers_in_parts(spark):
    data = conversations(6, 9)
    data += [(2, 3, "user", "the same again?", 1, 1, 1)] * 150
    data += [(2, None, "assistant", prose(k, 20) + "\n" + prose(k, 30), 1, 1, 1) for k in range(70)]
    frame = spark.createDataFrame(data, KIND).repartition(5)
    parts = chat.blocks(frame, "conv_id", "turn", "text", "role", block=4)
    cut = [r for r in parts.where("conv_id = 2").orderBy("block", "part").collect()]
    assert max(len(r.chunks) for r in cut) <= 4
    # In order they are the whole conversation.
    chunks = [tuple(c) for r in cut for c in r.chunks]
    key = lambda c: (c[0] is not None, c[0] or 0, c[1], c[2])
    assert chunks == sorted(((t, text, role) for c, t, role, text, *_ in data if c == 2), key=key)

    def turns(block):
        return sorted((r["conv_id"], str(r["number"]), r["line"], r["role"]) for r in found(spark, data, block=block) if not r["continues"])

    assert turns(4) == turns(1000)


def test_odd_rows(spark):
    data = conversations(8, 4) + [
        (None, 0, "user", "alone?", 1, 1, 1),
        (None, None, None, None, None, None, None),
        (3, None, "user", "first", 1, 1, 1),
        (4, 2, "user", "same number", 1, 1, 1),
        (4, 2, "user", "same number", 1, 1, 1),
        (5, 9, "judge", "", 1, 1, 1),
        (6, 9, "assistant", prose(1, 20_000), 1, 1, 1),
    ]
    turns = found(spark, data)
    assert {r["conv_id"] for r in turns} == {None, *range(8)}
    text = "".join(r["text"] for r in turns)
    assert "alone?" in text and text.count("same number") == 2 and prose(1, 20_000) in text
    assert not any(r["held_out"] for r in turns if r["conv_id"] is None)


def test_empty_table_and_no_roles(spark):
    assert found(spark, []) == []
    unknown = [(c, t, None, text, *rest) for c, t, _, text, *rest in conversations(3, 3)]
    assert {r["conv_id"] for r in found(spark, unknown)} == {0, 1, 2}


@pytest.mark.parametrize(
    ("line", "role"),
    [
        ("User: hello", 1), ("### Human:", 1), ("[Context] x", 0), ("Q: why", 1), ("AI: so", 2), ("System: be", 0),
        ("Note: this", 3), ("no marker here", 4), ("", 4), ("[user]", 1), ("A: yes", 2), ("A fine day: it is", 4),
    ],
)
def test_markers(line, role):
    assert chat.marker(line)[0] == role


def test_no_null_rows_are_lost(spark):
    data = conversations(5, 5)
    frame = spark.createDataFrame(data, KIND)
    lines = frame.select(F.sum(F.size(F.split("text", "\n")))).first()[0]
    turns = found(spark, data)
    assert sum(len(r["text"].split("\n")) for r in turns) == lines
