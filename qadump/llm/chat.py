"""Chat formatting: transcripts parsed by a hidden Markov model, rendered as canonical turns.

A transcript comes as numbered chunks of text, read as they are. Each line is an observation with five
features: the speaker marker at its start, its length, its last and its first character, and whether it
opens a chunk. The hidden state is the speaker's role and whether the line begins a turn. Starts,
transitions and the emissions of each feature are counted over conversations whose roles are known; the
roles of others are not read. Markers and chunk starts keep a small share (`LEAK`) of what they should mean, so that
a marker tells its speaker where the learning conversations have none, and a turn may begin inside a chunk.
Viterbi then finds the likeliest states; of equally likely ones the first, in the order of `ROLES`. Lines become turns, and each turn is
rendered as <|role|>, its text, and <|end|>.

Texts keep every character, line breaks too, but for markers, and these are taken off only where a
turn begins, the marker names the turn's role, and the conversation is one that marks its speakers: it has two markers
or more, and one for every two chunks. So "A: " at the start of a single turn is text. A marker that fills its line goes with the line.

Long conversations are cut into blocks of `block` chunks at most, repeated and null numbers included, and Viterbi
runs over blocks in parallel: each block gives the best score from every state before it to every state at its end, a
table of states x states, with the first state on the way; one pass over these small rows finds the states at the edges
of all blocks; each block is then decoded between its own edges. The result is that of
one Viterbi pass, and no task holds more text than a block. A turn that goes over an edge comes in pieces: only its
first is rendered with <|role|>, only its last with <|end|>, so the pieces in order are the turn, once.

Chunks of one number are read in the order of their texts; null numbers come first. Rows with a
null conversation are conversations of their own. Null texts are empty; a chunk without
text is one empty line. A very long text is one chunk, whose lines are held together. Repeated rows are repeated chunks. An empty table gives
an empty result. Without known roles all roles are equally likely but for markers. Only the columns named in the arguments are read, so others can't clash.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from qadump.llm.common import small, staged

ROLES = ("system", "user", "assistant")
#: State 2 * role: a line that begins a turn; 2 * role + 1: a line that goes on.
STATES = 2 * len(ROLES)
#: Names that transcripts give to speakers.
NAMES = {
    "system": ("system", "instruction", "instructions", "context"),
    "user": ("user", "human", "customer", "client", "question", "q", "me"),
    "assistant": ("assistant", "ai", "bot", "agent", "model", "answer", "a"),
}
_ROLE_OF = {name: ROLES.index(role) for role, names in NAMES.items() for name in names}
_NAME = r"(?P<name>\p{L}{1,12})"
#: "Name: text", with or without list and emphasis marks; "[Name] text"; a heading "### Name".
MARKERS = tuple(
    regex.compile(pattern)
    for pattern in (
        rf"[ \t]*(?:#{{1,6}}[ \t]*|\*{{1,2}}|[>-][ \t]*)?{_NAME}\*{{0,2}}[ \t]*:\*{{0,2}}[ \t]?",
        rf"[ \t]*[\[<(]\|?{_NAME}\|?[\])>]:?[ \t]?",
        rf"[ \t]*#{{1,6}}[ \t]*{_NAME}[ \t]*$",
    )
)
#: Number of values of each feature: marker, length, last character, first character, opens a chunk.
SIZES = (len(ROLES) + 2, 12, 5, 5, 2)
#: Share of what markers and chunk starts should mean in their emissions, beside what was counted.
LEAK = 0.05
#: Of what should be: chance of a marker that names another role, or of one inside a turn.
ODD = 0.005


def marker(line: str) -> tuple[int, int]:
    """Role of the marker a line starts with (one more: another name; two more: none), and its end."""
    found = next(filter(None, (m.match(line) for m in MARKERS)), None)
    if not found:
        return len(ROLES) + 1, 0
    role = _ROLE_OF.get(found["name"].lower())
    return (len(ROLES), 0) if role is None else (role, found.end())


def observed(line: str, opens: bool = False) -> tuple[int, ...]:
    """The features; length and characters are those of what follows the marker."""
    named, cut = marker(line)
    bare = line[cut:].strip()
    if not bare:
        return named, 0, 4, 4, int(opens)
    first, last = bare[0], bare[-1]
    start = 0 if first.isupper() else 1 if first.islower() else 2 if first.isdigit() else 3
    end = {"?": 0, ".": 1, "!": 1, ":": 2}.get(last, 3)
    return named, min(SIZES[1] - 1, len(bare).bit_length()), end, start, int(opens)


def expected_markers() -> np.ndarray:
    """states x markers: half of the turns begin with their role's marker, no other line has one."""
    table = np.full((STATES, SIZES[0]), ODD)
    for role in range(len(ROLES)):
        table[2 * role, role] = 0.5
    table[:, -1] = 0
    table[:, -1] = 1 - table.sum(axis=1)
    return table


@dataclass(frozen=True)
class Model:
    start: np.ndarray  # log probabilities
    step: np.ndarray
    emit: tuple[np.ndarray, ...]

    def emissions(self, lines: list[str], opens: list[bool] | None = None) -> np.ndarray:
        """lines x states. opens: which lines open a chunk; the first alone if None."""
        opens = opens or [k == 0 for k in range(len(lines))]
        seen = np.array([observed(line, first) for line, first in zip(lines, opens, strict=True)])
        return sum(table[:, seen[:, k]].T for k, table in enumerate(self.emit))

    def table(self, lines: list[str], first: bool, opens: list[bool] | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Best score from each state before the lines (all the same for a start) to each at the end,
        and the state of the first line on that way."""
        emissions = self.emissions(lines, opens)
        best = (np.tile(self.start, (STATES, 1)) if first else self.step) + emissions[0]
        opening = np.tile(np.arange(STATES), (STATES, 1))
        for row in emissions[1:]:
            ways = best[:, :, None] + self.step
            back = ways.argmax(axis=1)  # of equal ways the first, as in decode
            opening = np.take_along_axis(opening, back, axis=1)
            best = ways.max(axis=1) + row
        return best, opening

    def decode(self, lines: list[str], before: int | None, after: int | None, opens: list[bool] | None = None) -> list[int]:
        """Likeliest states of the lines, between the states at their edges where these are known."""
        emissions = self.emissions(lines, opens)
        score = (self.start if before is None else self.step[before]) + emissions[0]
        back = []
        for row in emissions[1:]:
            ways = score[:, None] + self.step
            back.append(ways.argmax(axis=0))
            score = ways.max(axis=0) + row
        states = [int(score.argmax()) if after is None else after]
        for pointers in reversed(back):
            states.append(int(pointers[states[-1]]))
        return states[::-1]


def blocks(
    chunks: DataFrame, conversation: str, number: str, text: str, role: str | None = None, block: int = 32
) -> DataFrame:
    """conv, conv_id, block, part and chunks (number, text, role; in order) for every block, staged.

    A block is the chunks of `block` numbers. Where repeated or null numbers give it more than
    `block` chunks, they are sorted across tasks and cut into parts of `block` chunks at most.
    """
    known = F.col(role).cast("string") if role else F.lit(None).cast("string")
    rows = chunks.select(
        F.col(conversation).cast("long").alias("conv_id"),
        F.col(number).cast("long").alias("number"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
        known.alias("role"),
        F.monotonically_increasing_id().alias("uid"),
    )
    # A null conversation is one of its own.
    of_its_own = F.concat(F.lit("r"), F.col("uid").cast("string"))
    conv = F.coalesce(F.concat(F.lit("c"), F.col("conv_id").cast("string")), of_its_own)
    before_all = F.lit(-(1 << 62))
    place = F.coalesce(F.floor(F.col("number") / block), before_all).cast("long")
    piece = F.sort_array(F.collect_list(F.struct(F.col("number"), F.col("text"), F.col("role"))))
    cell = ["conv", "block"]
    rows = rows.withColumn("conv", conv).withColumn("block", place)
    sizes = rows.where("conv_id is not null").groupBy(*cell).agg(F.count("*").alias("size"))
    crowded = staged(sizes.where(F.col("size") > block).select(*cell), "chat-crowded")
    parted = rows.withColumn("part", F.lit(0).cast("long"))
    if not crowded.isEmpty():
        some = small(crowded)
        # Staged, so that uid, which tells exact copies apart, stays what it is.
        many = staged(rows.join(some, cell), "chat-many")
        order = [*cell, "number", "text", "role", "uid"]
        placed = many.repartitionByRange(*order).sortWithinPartitions(*order)
        # Ids grow along the sort, and jump from one task to the next.
        part = F.floor(F.monotonically_increasing_id() / block).cast("long")
        parted = parted.join(some, cell, "left_anti").unionByName(placed.withColumn("part", part))
    grouped = parted.groupBy("conv", "conv_id", "block", "part").agg(piece.alias("chunks"))
    return staged(grouped, "chat")


def _lines(chunks: list[dict]) -> tuple[list[str], list[tuple[int | None, int, str | None]]]:
    """All lines of a block, and for each the chunk's number, its place there, and the chunk's role."""
    lines, places = [], []
    for chunk in chunks:
        for k, line in enumerate(chunk["text"].split("\n")):
            lines.append(line)
            places.append((chunk["number"], k, chunk["role"]))
    return lines, places


def train(parts: DataFrame) -> Model:
    """Counts over all blocks whose chunks' roles are known; a chunk is one turn."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for k in range(batch.num_rows):
                lines, places = _lines(batch.column("chunks")[k].as_py())
                before, opens = batch.column("previous")[k].as_py(), batch.column("opens")[k].as_py()
                for line, (_, nth, role) in zip(lines, places, strict=True):
                    if role not in ROLES:
                        before = None
                        continue
                    state = 2 * ROLES.index(role) + (nth > 0)
                    if before is None and opens:
                        counts["start", 0, state] += 1
                        opens = False
                    elif before is not None:
                        counts["step", before, state] += 1
                    for feature, value in enumerate(observed(line, nth == 0)):
                        counts[f"emit{feature}", state, value] += 1
                    before = state
        columns = [[key[0] for key in counts], [key[1] for key in counts], [key[2] for key in counts]]
        arrays = [pa.array(columns[0], pa.string()), *(pa.array(c, pa.int32()) for c in columns[1:])]
        yield pa.RecordBatch.from_arrays(
            [*arrays, pa.array(list(counts.values()), pa.int64())], names=["what", "a", "b", "n"]
        )

    counted = parts.select("chunks", "opens", "previous").mapInArrow(run, "what string, a int, b int, n long")
    start, step = np.ones((1, STATES)) * 0.1, np.ones((STATES, STATES)) * 0.1
    emit = [np.ones((STATES, size)) * 0.1 for size in SIZES]
    tables = {"start": start, "step": step} | {f"emit{k}": t for k, t in enumerate(emit)}
    for row in counted.groupBy("what", "a", "b").agg(F.sum("n").alias("n")).collect():  # cells of the model
        tables[row.what][row.a, row.b] += row.n
    start, step, *emit = (t / t.sum(axis=1, keepdims=True) for t in (start, step, *emit))
    emit[0] = (1 - LEAK) * emit[0] + LEAK * expected_markers()
    emit[4] = (1 - LEAK) * emit[4] + LEAK / 2
    return Model(np.log(start[0]), np.log(step), tuple(map(np.log, emit)))


def with_edges(parts: DataFrame) -> DataFrame:
    """opens, closes: whether a block is its conversation's first, its last; previous: the known
    state of the line before the block, if there is one."""
    last = F.element_at("chunks", -1)
    role = F.array_position(F.array(*map(F.lit, ROLES)), last["role"]) - 1  # -1 for other roles
    state = F.when(role >= 0, 2 * role + last["text"].contains("\n").cast("int")).cast("int")
    order = Window.partitionBy("conv").orderBy("block", "part")  # one small row a block
    edges = parts.select("conv", "block", "part", state.alias("state")).select(
        "conv",
        "block",
        "part",
        F.lag("block").over(order).isNull().alias("opens"),
        F.lead("block").over(order).isNull().alias("closes"),
        F.lag("state").over(order).alias("previous"),
    )
    return parts.join(edges, ["conv", "block", "part"])


def _markers(lines: list[str], places: list[tuple]) -> tuple[int, int]:
    """How many lines have a marker of a known role, and how many chunks there are."""
    return sum(marker(line)[0] < len(ROLES) for line in lines), sum(nth == 0 for _, nth, _ in places)


def marks_speakers(markers: int, chunks: int) -> bool:
    return markers >= 2 and 2 * markers >= chunks


EDGES = "conv string, block long, part long, before int, after int, following int, marked boolean"
TURNS = "conv_id long, number long, line int, role string, continues boolean, text string, rendered string"


def edges(several: DataFrame, model: Model) -> DataFrame:
    """EDGES of blocks of conversations that have more than one: the states before and at the end
    of a block and after it, and whether the conversation marks its speakers."""
    names = ["conv", "block", "part", "score", "opening", "markers", "chunks"]
    kind = "conv string, block long, part long, score array<double>, opening array<int>, markers long, chunks long"

    def tables(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: list[list] = [[], [], [], []]
            for chunks, first in zip(batch.column("chunks"), batch.column("opens"), strict=True):
                lines, places = _lines(chunks.as_py())
                best, opening = model.table(lines, first.as_py(), [nth == 0 for _, nth, _ in places])
                for column, value in zip(found, (best.ravel(), opening.ravel(), *_markers(lines, places)), strict=True):
                    column.append(value)
            types = (pa.list_(pa.float64()), pa.list_(pa.int32()), pa.int64(), pa.int64())
            arrays = [pa.array(c, t) for c, t in zip(found, types, strict=True)]
            yield pa.RecordBatch.from_arrays([*map(batch.column, ("conv", "block", "part")), *arrays], names=names)

    def chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """States at the edges of the blocks of each conversation; a few bytes a block are kept."""
        conv, numbers, back, openings, best, markers, chunks = None, [], [], [], None, 0, 0

        def finished() -> pa.RecordBatch:
            states = [int(best.argmax())]
            for pointers in reversed(back):
                states.append(int(pointers[states[-1]]))
            states.reverse()  # the state at the end of each block
            following = [int(o[b, a]) for o, b, a in zip(openings, states, states[1:], strict=False)]
            arrays = [
                pa.array([conv] * len(numbers), pa.string()),
                pa.array([block for block, _ in numbers], pa.int64()),
                pa.array([part for _, part in numbers], pa.int64()),
                pa.array([None, *states[:-1]], pa.int32()),
                pa.array(states, pa.int32()),
                pa.array([*following, None], pa.int32()),
                pa.array([marks_speakers(markers, chunks)] * len(numbers), pa.bool_()),
            ]
            return pa.RecordBatch.from_arrays(arrays, names=[field.split()[0] for field in EDGES.split(", ")])

        for batch in batches:
            rows = zip(*(column.to_pylist() for column in batch.columns), strict=True)
            for name, block, part, score, opening, own_markers, own_chunks in rows:
                score = np.array(score).reshape(STATES, STATES)
                if name != conv:
                    if conv is not None:
                        yield finished()
                    conv, numbers, back, openings, best, markers, chunks = name, [], [], [], score[0], 0, 0
                else:
                    ways = best[:, None] + score
                    back.append(ways.argmax(axis=0).astype(np.int8))
                    best = ways.max(axis=0)
                    openings.append(np.array(opening, dtype=np.int8).reshape(STATES, STATES))
                numbers.append((block, part))
                markers, chunks = markers + own_markers, chunks + own_chunks
        if conv is not None:
            yield finished()

    return (
        several.select("conv", "block", "part", "chunks", "opens")
        .mapInArrow(tables, kind)
        .repartition("conv")
        .sortWithinPartitions("conv", "block", "part")
        .mapInArrow(chain, EDGES)
    )


def turns_of(
    lines: list[str], places: list[tuple], states: list[int], before: int | None, following: int | None, marked: bool
) -> Iterator[tuple]:
    """number, line, role, continues, text and rendered of the turns of a block.

    before, following: the states of the lines around the block, None at the conversation's ends.
    """
    around = [before, *states, following]

    def goes_on(k: int) -> bool:
        """Whether line k belongs to the turn of the line before it; k may be the line after the block."""
        state, last = around[k + 1], around[k]
        return state is not None and last is not None and state % 2 == 1 and state // 2 == last // 2

    starts = [k for k in range(len(lines)) if k == 0 or not goes_on(k)]
    for start, end in zip(starts, [*starts[1:], len(lines)], strict=True):
        role, continues = states[start] // 2, start == 0 and goes_on(0)
        body = list(lines[start:end])
        open_end = end == len(lines) and goes_on(end)
        named, cut = marker(body[0])
        if marked and not continues and states[start] % 2 == 0 and named == role:
            rest = body[0][cut:]
            body[:1] = [rest] if rest.strip() or (len(body) == 1 and not open_end) else []
        text = "\n".join(body)
        # The next piece begins with the line break, so none follows a marker that goes with its line.
        head = "\n" if continues else f"<|{ROLES[role]}|>" + ("\n" if body else "")
        foot = "" if open_end else "\n<|end|>\n"
        number, nth, _ = places[start]
        yield number, nth, ROLES[role], continues, text, head + text + foot


def parse(parts: DataFrame, model: Model) -> DataFrame:
    """conv_id, number, line, role, continues, text, rendered: the turns of all blocks.

    parts: of `with_edges`. number and line: where the turn, or this piece of it, begins; continues: the
    turn began in a block before.
    """

    def turns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [field.split()[0] for field in TURNS.split(", ")]
        types = (pa.int64(), pa.int64(), pa.int32(), pa.string(), pa.bool_(), pa.string(), pa.string())
        for batch in batches:
            rows: list[list] = [[] for _ in names]
            wanted = ("conv_id", "chunks", "before", "after", "following", "marked")
            for conv_id, chunks, before, after, following, marked in zip(
                *(batch.column(name).to_pylist() for name in wanted), strict=True
            ):
                lines, places = _lines(chunks)
                states = model.decode(lines, before, after, [nth == 0 for _, nth, _ in places])
                if marked is None:  # the conversation is this block
                    marked = marks_speakers(*_markers(lines, places))
                for turn in turns_of(lines, places, states, before, following, marked):
                    for column, value in zip(rows, (conv_id, *turn), strict=True):
                        column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(rows, types, strict=True)], names=names)

    around = staged(edges(parts.where("not (opens and closes)"), model), "chat-edges")
    decoded = parts.join(around, ["conv", "block", "part"], "left")
    return decoded.select("conv_id", "chunks", "before", "after", "following", "marked").mapInArrow(turns, TURNS)


def format_conversations(
    chats: DataFrame, folds: int = 4, held: int = 0, conversation: str = "conv_id", number: str = "turn",
    text: str = "text", role: str = "role", block: int = 32,
) -> DataFrame:
    """The turns of all conversations, recovered from their texts, and held_out.

    Known roles are learned from in conversations that are not held out (crc32 of the id modulo
    `folds`), where a chunk is one turn; those of the others are not read.
    """
    key = F.col(conversation).cast("long")
    is_held = F.coalesce(F.crc32(key.cast("string")) % folds == held, F.lit(False))
    chunks = chats.select(
        key.alias("conv_id"),
        F.col(number).alias("number"),
        F.col(text).alias("text"),
        F.when(~is_held, F.col(role)).alias("role"),
    )
    parts = staged(with_edges(blocks(chunks, "conv_id", "number", "text", "role", block)), "chat-blocks")
    model = train(parts)
    held_out = F.coalesce(F.crc32(F.col("conv_id").cast("string")) % folds == held, F.lit(False))
    return parse(parts, model).withColumn("held_out", held_out)
