"""Approximate nearest neighbours: multi-index hashing over learned binary codes.

Codes: vectors are centred and rotated so that the signs of their coordinates lose as little as
possible (iterative quantisation: principal axes, then alternating between signs and the
best rotation), learned on a sample of `sample_rows` (a documented bound). 64 bits;
vectors of fewer dimensions get several rotations, those of more their 64 main axes.

Index: every row is in one of many shards of bounded size: runs of rows as they lie in the staged
table, read in place. In a shard the code is split into
substrings, each with an inverted list. By the pigeonhole principle a code within Hamming radius
r differs in at most r // m bits in one of the m substrings, so probing the lists of all values
that near retrieves every code within r. These are reranked by exact distance on the
original vectors in double precision. The radius is learned on the sample too, as the Hamming
distance that covers `goal` of the true neighbours there; the number of substrings is the one
with the fewest expected candidates. Where a shard has fewer than k codes within r, r grows
until it has, so every query gets k neighbours if there are k.

Queries are a stated part of the rows. They go out in batches of `BATCH_BYTES` at most, each a
broadcast whose size is known from the number of queries, and visit every shard; a task keeps the
k best of each query over its shards, and only those leave it. So no vector is shuffled, and tasks hold a
shard and a batch. Vectors that are null, zero, of another length than most, or hold null or
non-finite components take no part, nor do rows without id. A repeated id is a row of its
own: only the query's own row is no candidate. Equal distances go to the smaller id.
Fewer than two vectors give no rows. Only the id and vector columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.core.broadcast import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from qadump.llm.common import staged

BITS = 64
#: Vectors of a shard.
SHARD_BYTES = 64_000_000
#: Vectors of the queries that are broadcast together.
BATCH_BYTES = 64_000_000
RESULT = "query_uid long, query_id long, vec_id long, uid long, score double"


@dataclass(frozen=True)
class Codes:
    mean: np.ndarray
    axes: np.ndarray  # dimensions x 64
    radius: int

    def of(self, vectors: np.ndarray) -> np.ndarray:
        runs = (vectors[k : k + 65_536] for k in range(0, max(1, len(vectors)), 65_536))
        bits = np.concatenate([(run - self.mean) @ self.axes > 0 for run in runs])
        return np.packbits(bits, axis=1).view(">u8").astype(np.uint64).ravel()

    @property
    def substrings(self) -> int:
        """4 of 16 bits, 8 of 8 or 16 of 4: what retrieves the fewest candidates at random."""

        def expected(m: int) -> float:
            width = BITS // m
            return m * sum(comb(width, k) for k in range(min(width, self.radius // m) + 1)) / 2**width

        return min((4, 8, 16), key=expected)


def _rotation(data: np.ndarray, rng: np.random.Generator, rounds: int = 30) -> np.ndarray:
    """The rotation that brings rows nearest to their own signs."""
    turn, _ = np.linalg.qr(rng.standard_normal((data.shape[1], data.shape[1])))
    for _ in range(rounds):
        u, _, v = np.linalg.svd(data.T @ np.where(data @ turn > 0, 1.0, -1.0))
        turn = u @ v
    return turn


def learn(sample: np.ndarray, k: int, goal: float, probes: int = 200, seed: int = 5) -> Codes:
    """Axes and radius from sampled vectors, one a row."""
    rng = np.random.default_rng(seed)
    mean = sample.mean(axis=0)
    centred = sample - mean
    main = np.linalg.eigh(centred.T @ centred)[1][:, ::-1][:, :BITS]
    blocks = -(-BITS // main.shape[1])
    axes = np.hstack([main @ _rotation(centred @ main, rng) for _ in range(blocks)])[:, :BITS]
    codes = Codes(mean, axes, 0).of(sample)
    asked = rng.permutation(len(sample))[:probes]
    away = []
    for q in asked:
        distance = ((sample - sample[q]) ** 2).sum(axis=1)
        distance[q] = np.inf
        near = np.argsort(distance, kind="stable")[: min(k, len(sample) - 1)]
        away += np.bitwise_count(codes[near] ^ codes[q]).tolist()
    radius = int(np.quantile(away, goal)) + 1 if away else BITS
    return Codes(mean, axes, min(radius, BITS))


class Shard:
    """Rows with an inverted list per substring of their codes."""

    def __init__(self, codes: Codes, uid: np.ndarray, vec_id: np.ndarray, vectors: np.ndarray):
        self.codes, self.uid, self.vec_id, self.vectors = codes, uid, vec_id, vectors
        self.code = codes.of(vectors)
        self.m = codes.substrings
        self.width = BITS // self.m
        self.lists = []
        for part in range(self.m):
            value = self._part(self.code, part)
            order = np.argsort(value, kind="stable")
            values, first = np.unique(value[order], return_index=True)
            self.lists.append((order, values, np.r_[first, len(order)]))

    def _part(self, code: np.ndarray, part: int) -> np.ndarray:
        return (code >> np.uint64(part * self.width)) & np.uint64((1 << self.width) - 1)

    def within(self, code: np.uint64, radius: int) -> np.ndarray:
        """All rows whose code is within the radius."""
        found = np.zeros(len(self.code), dtype=bool)
        for part, (order, values, first) in enumerate(self.lists):
            near = np.flatnonzero(np.bitwise_count(values ^ self._part(code, part)) <= radius // self.m)
            sizes = first[near + 1] - first[near]
            at = np.repeat(first[near] - np.r_[0, np.cumsum(sizes)[:-1]], sizes) + np.arange(sizes.sum())
            found[order[at]] = True
        rows = np.flatnonzero(found)
        return rows[np.bitwise_count(self.code[rows] ^ code) <= radius]

    def nearest(self, uid: int, vector: np.ndarray, code: np.uint64, k: int) -> tuple[np.ndarray, np.ndarray]:
        radius = self.codes.radius
        while True:
            rows = self.within(code, radius)
            rows = rows[self.uid[rows] != uid]
            if len(rows) >= k or radius >= BITS:
                break
            radius = min(BITS, radius + 4)
        score = np.sqrt(((self.vectors[rows] - vector) ** 2).sum(axis=1))
        if len(rows) > k:
            few = score <= np.partition(score, k - 1)[k - 1]
            rows, score = rows[few], score[few]
        best = np.lexsort((self.uid[rows], self.vec_id[rows], score))[:k]
        return rows[best], score[best]


def usable(vectors: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """uid, vec_id and vec (doubles of one length) of all rows that take part, staged."""
    rows = vectors.select(
        F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("vec")
    ).where(
        F.col("vec_id").isNotNull()
        & F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists("vec", lambda x: x != 0)
    )
    rows = staged(rows.withColumn("uid", F.monotonically_increasing_id()), "vectors")
    common = rows.groupBy(F.size("vec").alias("length")).count().orderBy(F.desc("count"), "length").first()
    return rows.where(F.size("vec") == (common.length if common else 0))


def _matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def search(
    vectors: DataFrame,
    query_step: int = 100,
    k: int = 10,
    sample_rows: int = 10_000,
    goal: float = 0.97,
    shard_bytes: int = SHARD_BYTES,
    batch_bytes: int = BATCH_BYTES,
    vec_id: str = "vec_id",
    vector: str = "embedding",
) -> DataFrame:
    """query_id, rank, vec_id and score: the k nearest of every row whose id query_step divides."""
    spark = vectors.sparkSession
    rows = usable(vectors, vec_id, vector)
    total = rows.count()
    draw = F.pmod(F.xxhash64("vec_id", "uid"), F.lit(1 << 30)) / (1 << 30)
    sample = rows.where(draw * total < sample_rows).orderBy("vec_id", "uid").select("vec").toArrow()
    if sample.num_rows < 2:
        sample = rows.orderBy("vec_id", "uid").limit(2).select("vec").toArrow()
    if sample.num_rows < 2:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    data = _matrix(sample.column("vec"))
    codes = spark.sparkContext.broadcast(learn(data, k, goal))  # 64 axes

    row_bytes = 8 * data.shape[1] + 16
    is_query = F.pmod("vec_id", F.lit(query_step)) == 0
    asked = rows.where(is_query).select("uid", "vec_id", "vec")
    batches = max(1, -(-asked.count() * row_bytes // batch_bytes))
    found = [
        nearest_in_place(rows, asked.where(F.pmod(F.xxhash64("uid"), F.lit(batches)) == b), codes, k, shard_bytes // row_bytes)
        for b in range(batches)
    ]
    if batches > 1:  # one batch is let go before the next goes out
        found = [staged(best, "nearest") for best in found]
    order = Window.partitionBy("query_uid").orderBy("score", "vec_id", "uid")
    return (
        reduce(DataFrame.unionByName, found)
        .withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def nearest_in_place(rows: DataFrame, asked: DataFrame, codes: Broadcast, k: int, shard_rows: int) -> DataFrame:
    """RESULT: for every task over rows, the k nearest of each query among its rows.

    asked: uid, vec_id and vec of one batch of queries, which is collected and broadcast.
    """
    batch = asked.orderBy("vec_id", "uid").toArrow()
    if not batch.num_rows:
        return rows.sparkSession.createDataFrame([], RESULT)
    uids, ids = (batch.column(name).to_numpy() for name in ("uid", "vec_id"))
    shared = rows.sparkSession.sparkContext.broadcast((uids, ids, _matrix(batch.column("vec"))))

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, (query_uid, query_id, vectors) = codes.value, shared.value
        asked_codes = model.of(vectors)
        best: list[tuple] = [(np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0))] * len(query_uid)

        def ask(held: list[tuple]) -> None:
            shard = Shard(model, *(np.concatenate(column) for column in zip(*held, strict=True)))
            for q in range(len(query_uid)):
                near, score = shard.nearest(query_uid[q], vectors[q], asked_codes[q], k)
                known = best[q]
                ids, uids = np.r_[known[0], shard.vec_id[near]], np.r_[known[1], shard.uid[near]]
                score = np.r_[known[2], score]
                first = np.lexsort((uids, ids, score))[:k]
                best[q] = (ids[first], uids[first], score[first])

        held: list[tuple] = []
        count = 0
        for part in parts:
            for start in range(0, part.num_rows, shard_rows):
                some = part.slice(start, shard_rows)
                if held and count + some.num_rows > shard_rows:
                    ask(held)
                    held, count = [], 0
                held.append((some.column(0).to_numpy(), some.column(1).to_numpy(), _matrix(some.column(2))))
                count += some.num_rows
        if held:
            ask(held)
        sizes = [len(b[0]) for b in best]
        columns = [np.repeat(query_uid, sizes), np.repeat(query_id, sizes)]
        columns += [np.concatenate([b[c] for b in best]) for c in (0, 1, 2)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(column) for column in columns], names=["query_uid", "query_id", "vec_id", "uid", "score"]
        )

    return rows.select("uid", "vec_id", "vec").mapInArrow(run, RESULT)
