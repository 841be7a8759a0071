"""The prefix trie of conversations: who shares which first turns, with totals of all subtrees.

A node is a distinct sequence of first turns (role and text); the root has none. Its members are the
conversations that start with it. A node is named by its depth and the sum of 128-bit hashes
of its turns, each with its position. Sums run along a conversation in bands of `BAND` turns, one
row a band carried on, so a conversation with a third of all turns is no single task.

Totals of subtrees are passed up by time-forward processing. Every node belongs to its smallest
member, the only conversation that brings the node's own values. Bands of conversations are dealt
to shards. Within a shard Spark sorts the path nodes of its bands in reverse level order, deepest
first. A task reads them once: a node takes the messages that wait for it in a priority queue, adds its own
values, and sends the sum to its parent, whose turn comes later. The queue writes sorted
runs to scratch files when it holds `most` messages and merges runs of like size, so memory and open files
stay bounded whatever the shard holds. What goes out of a band's top is known beforehand, as the sum of all values further
down that conversation, and enters the band above at its lowest node. Nodes that several shards
hold, the root above all, are shard roots: their partial totals are added up across shards.

A node's hash of the ids that end there reads them in order, as SHA-256 must; they come as joined texts
of up to `ENDS` ids, made in parallel, and are hashed as a stream.

Turns are ordered by number, null first; of equal numbers by role, the text's first characters and its
digest, so repeated rows are repeated turns. Null roles and texts are empty ones. Rows with a null
conversation belong to none and take no part. An empty table gives no node, not even a root. A
very long text counts as its digest and size. Only the columns named in the arguments are read, so other columns can't clash.
"""

from __future__ import annotations

import hashlib
import heapq
import pickle
import tempfile
from collections.abc import Iterable, Iterator
from itertools import chain, islice

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from qadump.llm.common import staged
from qadump.llm.scan import latest, ordered, running

#: Turns of a conversation that one window, and one task of a shard, holds together.
BAND = 1_024
#: Ids that are joined to one text before they are hashed.
ENDS = 4_096
#: Characters of a text that take part in the order of equal turn numbers, before its digest.
TIE = 64


class SpillingQueue:
    """A priority queue of (level, node) with two sums; beyond `most` entries sorted runs go to files.

    What is pushed must come after what was last popped, as messages to parents do. `fan` runs of one size are
    merged into one of the next, so open files and the chunks in memory grow with the logarithm of what
    was pushed, and an entry is rewritten as often.
    """

    def __init__(self, most: int = 200_000, chunk: int = 1_000, fan: int = 16):
        self.most, self.chunk, self.fan = most, chunk, fan
        self.heap: list[tuple] = []
        #: First entry of each run that was spilled, with the run's number, its merges and the rest of it.
        self.runs: list[tuple] = []
        self.spilled = 0

    def push(self, entry: tuple) -> None:
        heapq.heappush(self.heap, entry)
        if len(self.heap) >= self.most:
            entries, self.heap = sorted(self.heap), []
            self._spill(entries, 0)

    def _spill(self, entries: Iterable[tuple], merges: int) -> None:
        file = tempfile.TemporaryFile()  # the task's own scratch, gone with it
        rest = iter(entries)
        while some := list(islice(rest, self.chunk)):
            pickle.dump(some, file)
        file.seek(0)
        self.spilled += 1
        self._advance(self.spilled, merges, self._read(file))
        alike = [run for run in self.runs if run[2] == merges]
        if len(alike) >= self.fan:
            self.runs = [run for run in self.runs if run[2] != merges]
            heapq.heapify(self.runs)
            self._spill(heapq.merge(*(chain([first], run) for first, _, _, run in alike)), merges + 1)

    def _read(self, file) -> Iterator[tuple]:
        with file:
            while True:
                try:
                    yield from pickle.load(file)
                except EOFError:
                    return

    def _advance(self, number: int, merges: int, run: Iterator[tuple]) -> None:
        first = next(run, None)
        if first is not None:
            heapq.heappush(self.runs, (first, number, merges, run))

    def take(self, key: tuple) -> tuple[int, int]:
        """Remove all entries of a key (level, node); their two sums."""
        one = two = 0
        while self.heap and self.heap[0][:2] == key:
            entry = heapq.heappop(self.heap)
            one, two = one + entry[2], two + entry[3]
        while self.runs and self.runs[0][0][:2] == key:
            entry, number, merges, run = heapq.heappop(self.runs)
            one, two = one + entry[2], two + entry[3]
            self._advance(number, merges, run)
        return one, two


def numbered(
    chats: DataFrame, conversation: str = "conv_id", number: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """conv_id, nth (from 0), digest (of role and text) and bytes (of the text) of every turn, staged."""
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    speaker = F.coalesce(F.col(role).cast("string"), F.lit(""))
    # The role's length in front, so that no two pairs of role and text read alike.
    whole = F.concat(F.octet_length(speaker).cast("string"), F.lit(":"), speaker, body)
    turns = chats.where(F.col(conversation).isNotNull()).select(
        F.col(conversation).cast("long").alias("conv_id"),
        F.col(number).alias("number"),
        speaker.alias("speaker"),
        F.left(body, F.lit(TIE)).alias("start"),
        F.unhex(F.left(F.sha2(whole, 256), F.lit(32))).alias("digest"),
        F.octet_length(body).cast("long").alias("bytes"),
    )
    order = ["conv_id", F.col("number").asc_nulls_first(), "speaker", "start", "digest"]
    parts = ordered(turns, order, "trie-turns", without=["number", "speaker", "start"])
    counted = running(parts, {"nth": F.lit(1).cast("long")}, ["conv_id"])
    return staged(counted.select("conv_id", (F.col("nth") - 1).alias("nth"), "digest", "bytes"), "trie-numbered")


def regrouped(turns: DataFrame, group: int = 5, most: int = 8) -> tuple[DataFrame, DataFrame]:
    """Conversations that begin with turns of the first one of their group: of the result of `numbered`.

    Conversation c gets the first h turns of c - c % group and keeps its own after its first
    h; h is the CRC-32 of c in decimal, modulo most + 1. (Remainders of negative ids are positive.)
    Returns the turns (conv_id, depth from 1, digest, bytes) and conv_id and length of all
    conversations, without turns too.
    """
    sizes = turns.groupBy("conv_id").agg(F.count("*").alias("n"))
    convs = sizes.select(
        "conv_id",
        "n",
        (F.col("conv_id") - F.pmod("conv_id", F.lit(group))).alias("base"),
        (F.crc32(F.col("conv_id").cast("string")) % (most + 1)).alias("h"),
    )
    bases = sizes.select(F.col("conv_id").alias("base"), F.col("n").alias("base_n"))
    taken = F.least("h", F.coalesce("base_n", F.lit(0)))
    convs = staged(
        convs.join(bases, "base", "left").select(
            "conv_id",
            "base",
            "n",
            "h",
            taken.alias("taken"),
            (taken + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("length"),
        ),
        "trie-convs",
    )
    # Of a base, `most` turns at most, each to the `group` conversations at most that follow it.
    starts = (
        turns.where(F.col("nth") < most)
        .withColumnRenamed("conv_id", "base")
        .join(convs, "base")
        .where("nth < h")
        .select("conv_id", (F.col("nth") + 1).alias("depth"), "digest", "bytes")
    )
    # A row for every band of a conversation, so that a long one is not joined by one key.
    bands = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / BAND)))
    own = (
        turns.withColumn("band", F.floor(F.col("nth") / BAND))
        .join(convs.select("conv_id", "h", "taken", bands.alias("band")), ["conv_id", "band"])
        .where("nth >= h")
        .select("conv_id", (F.col("nth") - F.col("h") + F.col("taken") + 1).alias("depth"), "digest", "bytes")
    )
    return starts.unionByName(own), convs.select("conv_id", "length")


def paths(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """conv_id, depth, node, parent and bytes of every node on every conversation's path, staged."""
    root = convs.select(
        "conv_id", F.lit(0).cast("long").alias("depth"), F.lit(None).cast("binary").alias("digest"), F.lit(0).cast("long").alias("bytes")
    )
    rows = turns.unionByName(root)
    hashes = [F.xxhash64(F.lit(seed), "depth", "digest") for seed in (1, 2)]
    low = (1 << 32) - 1
    # Halves of 32 bits, whose sums can't overflow before 2^31 turns.
    halves = [half for h in hashes for half in (h.bitwiseAND(F.lit(low)), F.shiftrightunsigned(h, 32))]
    cells = {f"x{k}": F.when(F.col("depth") > 0, half).otherwise(F.lit(0).cast("long")) for k, half in enumerate(halves)}
    parts = rows.withColumns(cells).withColumns({"part": F.floor(F.col("depth") / BAND), "place": F.col("depth")})
    summed = running(parts, {f"s{k}": F.col(f"x{k}") for k in range(4)}, ["conv_id"])

    def name(depth: Column, sums: list[Column]) -> Column:
        return F.unhex(F.md5(F.concat_ws(":", depth.cast("string"), *[s.cast("string") for s in sums]).cast("binary")))

    own = [F.col(f"s{k}") for k in range(4)]
    above = [F.col(f"s{k}") - F.col(f"x{k}") for k in range(4)]
    return staged(
        summed.select(
            "conv_id",
            "depth",
            name(F.col("depth"), own).alias("node"),
            F.when(F.col("depth") > 0, name(F.col("depth") - 1, above)).alias("parent"),
            "bytes",
        ),
        "trie-paths",
    )


def members(rows: DataFrame) -> DataFrame:
    """node, parent, depth, bytes, conv_id (the smallest member), n_convs and n_children of every node, staged."""
    # depth, parent and bytes follow from the node; sums are combined in the map tasks.
    nodes = rows.groupBy("node", "parent", "depth", "bytes").agg(
        F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs")
    )
    nodes = staged(nodes, "trie-members")
    children = nodes.where("parent is not null").groupBy(F.col("parent").alias("node")).agg(F.count("*").alias("n_children"))
    counted = nodes.join(children, "node", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    return staged(counted, "trie-nodes")


def totals(rows: DataFrame, nodes: DataFrame, most: int = 200_000) -> DataFrame:
    """node, n_leaves and saved_tokens: sums over the node's subtree."""
    leaf = (F.col("n_children") == 0).cast("long")
    values = nodes.select("conv_id", "depth", leaf.alias("leaves"), ((F.col("n_convs") - 1) * F.col("bytes")).alias("saved"))
    band = F.floor(F.col("depth") / BAND)
    below = Window.partitionBy("conv_id").orderBy("band").rowsBetween(1, Window.unboundedFollowing)
    # What the bands further down send to the lowest node of a band. Bands without own values count
    # too: a conversation owns the end of its path only.
    lowest = rows.where(F.col("depth") % BAND == BAND - 1).select("conv_id", "depth", band.alias("band"))
    nothing = lowest.select("conv_id", "band", F.lit(0).cast("long").alias("leaves"), F.lit(0).cast("long").alias("saved"))
    sent = (
        values.select("conv_id", band.alias("band"), "leaves", "saved")
        .unionByName(nothing)
        .groupBy("conv_id", "band")
        .agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
        .select(
            "conv_id",
            "band",
            F.sum("leaves").over(below).alias("leaves_below"),
            F.sum("saved").over(below).alias("saved_below"),
        )
    )
    from_below = lowest.join(sent.where("leaves_below is not null"), ["conv_id", "band"]).drop("band")
    zero = F.lit(0).cast("long")
    shards = (
        rows.join(values, ["conv_id", "depth"], "left")
        .join(from_below, ["conv_id", "depth"], "left")
        .select(
            "conv_id",
            band.alias("band"),
            (-F.col("depth")).alias("level"),
            "node",
            F.when(F.col("depth") % BAND > 0, F.col("parent")).alias("above"),
            (F.coalesce("leaves", zero) + F.coalesce("leaves_below", zero)).alias("leaves"),
            (F.coalesce("saved", zero) + F.coalesce("saved_below", zero)).alias("saved"),
        )
    )

    def forward(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queue, now, above, leaves, saved = SpillingQueue(most), None, None, 0, 0
        out: list[tuple] = []

        def done() -> None:
            out.append((now[1], leaves, saved))
            if above is not None:
                queue.push((now[0] + 1, above, leaves, saved))

        def found() -> pa.RecordBatch:
            kinds = (pa.binary(), pa.int64(), pa.int64())
            columns = [pa.array([row[k] for row in out], kind) for k, kind in enumerate(kinds)]
            out.clear()
            return pa.RecordBatch.from_arrays(columns, names=["node", "n_leaves", "saved_tokens"])

        for batch in batches:
            rows = zip(*(column.to_pylist() for column in batch.columns), strict=True)
            for level, node, parent, own_leaves, own_saved in rows:
                if now != (level, node):
                    if now is not None:
                        done()
                    now, above = (level, node), parent
                    leaves, saved = queue.take(now)
                leaves, saved = leaves + own_leaves, saved + own_saved
            yield found()
        if now is not None:
            done()
            yield found()

    partial = (
        shards.repartition("conv_id", "band")
        .select("level", "node", "above", "leaves", "saved")
        .sortWithinPartitions("level", "node")
        .mapInArrow(forward, "node binary, n_leaves long, saved_tokens long")
    )
    return partial.groupBy("node").agg(F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens"))


def ends(rows: DataFrame, convs: DataFrame) -> DataFrame:
    """node and ends_sha256: the hash of the ids of conversations that end there, for nodes that have any."""
    last = rows.select("conv_id", "depth", "node").join(convs.withColumnRenamed("length", "depth"), ["conv_id", "depth"])
    parts = ordered(last.select("node", "conv_id"), ["node", "conv_id"], "trie-ends")
    texts = (
        parts.groupBy("node", "part", F.floor(F.col("place") / ENDS).alias("chunk"))
        .agg(F.array_join(F.sort_array(F.collect_list("conv_id")).cast("array<string>"), ",").alias("ids"))
        .repartition("node")
        .sortWithinPartitions("node", "part", "chunk")
        .select("node", "ids")
    )

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, digest = None, None
        out: list[tuple] = []

        def found() -> pa.RecordBatch:
            columns = [pa.array([r[0] for r in out], pa.binary()), pa.array([r[1] for r in out], pa.string())]
            out.clear()
            return pa.RecordBatch.from_arrays(columns, names=["node", "ends_sha256"])

        for batch in batches:
            for node, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if node == now:
                    digest.update(b"," + ids.encode())
                    continue
                if now is not None:
                    out.append((now, digest.hexdigest()))
                now, digest = node, hashlib.sha256(ids.encode())
            yield found()
        if now is not None:
            out.append((now, digest.hexdigest()))
            yield found()

    return texts.mapInArrow(hashed, "node binary, ends_sha256 string")


def owners_of_parents(nodes: DataFrame) -> DataFrame:
    """node and parent_conv_id of every node but the root.

    Children follow their parent in the order of the parent's name and take its owner from there:
    a join in which a parent with a third of all nodes below it spreads over the parts.
    """
    no_owner, no_node = F.lit(None).cast("long"), F.lit(None).cast("binary")
    parents = nodes.where("n_children > 0").select(
        F.col("node").alias("name"), F.lit(0).alias("kind"), F.col("conv_id").alias("owner"), no_node.alias("node")
    )
    children = nodes.where("parent is not null").select(
        F.col("parent").alias("name"), F.lit(1).alias("kind"), no_owner.alias("owner"), "node"
    )
    parts = ordered(parents.unionByName(children), ["name", "kind"], "trie-parents")
    return latest(parts, F.col("owner"), "parent_conv_id").where("kind = 1").select("node", "parent_conv_id")


def prefix_trie(turns: DataFrame, convs: DataFrame, most: int = 200_000) -> DataFrame:
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens and ends_sha256 of every node.

    turns: conv_id, depth (1, 2, ...), digest and bytes; convs: conv_id and length. most: messages
    that a task's queue holds in memory.
    """
    rows = paths(turns, convs)
    nodes = members(rows)
    return (
        nodes.join(totals(rows, nodes, most), "node")
        .join(owners_of_parents(nodes), "node", "left")
        .join(ends(rows, convs), "node", "left")
        .select(
            "conv_id",
            "depth",
            "parent_conv_id",
            "n_convs",
            "n_children",
            "n_leaves",
            "saved_tokens",
            F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
        )
    )
