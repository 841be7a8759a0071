"""Sharding: a consistent-hash ring with virtual nodes and bounded loads.

Every shard owns `virtual_nodes` points of a 64-bit ring. A row sits at the hash of its
text, so equal texts sit together, and belongs to the next point clockwise. A shard takes
rows up to its capacity; rows that overflow continue clockwise to the next points whose
shards have room. With `slack` 0 the capacities are the row counts of an even split, so
the shards' counts differ by one at most. With a slack they are that much larger, fewer
rows overflow, and a change of the shard count moves fewer rows.

The driver sees one count per arc of the ring (shards x virtual nodes). It walks the
overflow over the arcs and returns, for each arc, which ranks of its rows go where; rows are
then ranked in parallel in cells of the arc. A cell with more than `cell_rows` rows (a text
with very many copies) is split by the hash of the id, so no key or group of copies lands in
one task.

Null texts count as empty ones of size 8, null ids are ordinary ids, repeated rows are
rows of their own (they take different slots), an empty table gives an empty result. Rows at one ring
position (equal texts) take slots in the order of their ids, then of size and checksum. A very long text is
hashed and measured where it is; only numbers are moved. Only the id and text columns are read, so
other columns can't clash.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from qadump.llm.common import small, staged

#: Ring positions are cut into 2^16 slices, to rank the rows of an arc in parallel.
SLICE_BITS = 48


def ring(shards: int, virtual_nodes: int) -> tuple[np.ndarray, list[int]]:
    """Ring positions of all virtual nodes in clockwise order, and their shards."""
    points = sorted(
        (int(np.uint64(xxhash.xxh64_intdigest(f"{shard}/{node}", seed=42)).astype(np.int64)), shard)
        for shard in range(shards)
        for node in range(virtual_nodes)
    )
    return np.array([p for p, _ in points], dtype=np.int64), [s for _, s in points]


def capacities(rows: int, shards: int, slack: float) -> list[int]:
    if slack:
        return [int(np.ceil((1 + slack) * rows / shards))] * shards
    return [rows // shards + (shard < rows % shards) for shard in range(shards)]


def walk(loads: list[int], owners: list[int], room: list[int]) -> dict[int, list[tuple[int, int, int]]]:
    """For each arc the runs (first rank, shard, first slot) that its rows are dealt to.

    Every arc fills its own shard first; what is left goes one point further clockwise in
    each wave.
    """
    runs: dict[int, list[tuple[int, int, int]]] = {arc: [] for arc, load in enumerate(loads) if load}
    filled, left = [0] * len(room), {arc: loads[arc] for arc in runs}
    for step in range(len(owners)):
        for arc in sorted(left):
            shard = owners[(arc + step) % len(owners)]
            take = min(left[arc], room[shard] - filled[shard])
            if take:
                runs[arc].append((loads[arc] - left[arc], shard, filled[shard]))
                filled[shard] += take
                left[arc] -= take
                if not left[arc]:
                    del left[arc]
        if not left:
            break
    return runs


#: What rows are ranked in: a slice of an arc, a part of a crowded slice, a piece of a crowded part.
CELL = ("arc", "slice", "part", "piece")


def celled(rows: DataFrame, slices: DataFrame, cell_rows: int) -> DataFrame:
    """rows with part and piece. slices: arc, slice and their n rows."""

    def split(rows: DataFrame, counted: DataFrame, key: list[str], name: str, by: Column) -> DataFrame:
        crowded = counted.select(*key, F.ceil(F.col("n") / cell_rows).alias("into"))
        return rows.join(small(crowded), key, "left").withColumn(
            name, F.coalesce(F.pmod(by, F.col("into")), F.lit(0))
        ).drop("into")

    by_id = F.xxhash64("doc_id", F.when(F.col("doc_id").isNull(), F.col("uid")))
    crowded = slices.where(F.col("n") > cell_rows)
    parted = split(rows, crowded, ["arc", "slice"], "part", by_id)
    # Only crowded slices can have crowded parts.
    again = (
        parted.join(small(crowded.drop("n")), ["arc", "slice"], "left_semi")
        .groupBy("arc", "slice", "part")
        .agg(F.count("*").alias("n"))
        .where(F.col("n") > 2 * cell_rows)
    )
    return split(parted, staged(again, "crowded-parts"), ["arc", "slice", "part"], "piece", F.xxhash64("uid"))


def assign(
    docs: DataFrame,
    shards: int = 24,
    virtual_nodes: int = 64,
    slack: float = 0.0,
    cell_rows: int = 4_096,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """doc_id, size, text_crc32, shard and slot (0, 1, ... in each shard) of every row."""
    points, owners = ring(shards, virtual_nodes)

    @F.pandas_udf("int")
    def arc_of(position: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(points, position.to_numpy()) % len(points))

    body = F.coalesce(F.col(text), F.lit(""))
    rows = staged(
        docs.select(
            F.col(doc_id).cast("long").alias("doc_id"),
            (F.octet_length(body) + 8).cast("long").alias("size"),
            F.crc32(body.cast("binary")).alias("text_crc32"),
            F.xxhash64(body).alias("position"),
        )
        .withColumn("arc", arc_of("position"))
        .withColumn("slice", F.shiftright("position", SLICE_BITS))
        .withColumn("uid", F.monotonically_increasing_id()),
        "ring",
    )
    slices = staged(rows.groupBy("arc", "slice").agg(F.count("*").alias("n")), "slices")
    counts = {r.arc: r.n for r in slices.groupBy("arc").agg(F.sum("n").alias("n")).collect()}
    loads = [counts.get(arc, 0) for arc in range(len(points))]
    runs = walk(loads, owners, capacities(sum(loads), shards, slack))

    rows = celled(rows, slices, cell_rows)
    cell = list(CELL)
    along_arc = Window.partitionBy("arc").orderBy("slice", "part", "piece")
    cells = (
        rows.groupBy(cell)
        .agg(F.count("*").alias("n"))
        .withColumn("before", F.sum("n").over(along_arc) - F.col("n"))
        .drop("n")
    )
    in_cell = Window.partitionBy(cell).orderBy("position", "doc_id", "size", "text_crc32", "uid")
    ranked = (
        rows.withColumn("nth", F.row_number().over(in_cell) - 1)
        .join(cells, cell)
        .withColumn("rank", F.col("before") + F.col("nth"))
    )

    # One row per arc at most, whatever the input: shards x virtual nodes.
    plan = F.broadcast(
        docs.sparkSession.createDataFrame(
            list(runs.items()), "arc int, runs array<struct<first: long, shard: int, slot: long>>"
        )
    )
    run = F.element_at(F.filter("runs", lambda r: r["first"] <= F.col("rank")), -1)
    return (
        ranked.join(plan, "arc")
        .withColumn("run", run)
        .select(
            "doc_id",
            "size",
            "text_crc32",
            F.col("run.shard").alias("shard"),
            (F.col("run.slot") + F.col("rank") - F.col("run.first")).alias("slot"),
        )
    )
