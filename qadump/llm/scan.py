"""Running sums and last values along a global order, without one task that reads it all.

`ordered` sorts rows into ranges and numbers them: `part` is the range, `place` the place in it.
A scan then runs inside the parts, and one small row a part (and group) carries what the parts
before it hold. Rows that are equal in all that is ordered by are told apart by a last number, so
a key with a third of all rows goes on over as many parts as it fills.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from qadump.llm.common import fresh, staged

#: Bits of monotonically_increasing_id() for the place in a partition.
PLACE_BITS = 33


def ordered(df: DataFrame, order: Sequence[Column | str], purpose: str, without: Sequence[str] = ()) -> DataFrame:
    """df with part and place along `order`, staged; ties by a hidden number, so they spread too.

    without: columns that are only there to sort by.
    """
    tie = fresh("tie", df.columns)
    keys = [*order, tie]
    ranges = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # Staged first, as the bounds of the ranges and the rows themselves come from two passes.
    rows = staged(df.withColumn(tie, F.monotonically_increasing_id()), purpose)
    numbered = (
        rows.repartitionByRange(ranges, *keys)
        .sortWithinPartitions(*keys)
        .drop(tie, *without)
        .withColumn("place", F.monotonically_increasing_id())
        .withColumn("part", F.shiftright("place", PLACE_BITS).cast("int"))
    )
    return staged(numbered, f"{purpose}-sorted")


def _attached(parts: DataFrame, before: DataFrame, by: Sequence[str]) -> DataFrame:
    # Without groups there is one row a part.
    return parts.join(before if by else F.broadcast(before), ["part", *by], "left")


def running(parts: DataFrame, values: dict[str, Column], by: Sequence[str] = ()) -> DataFrame:
    """parts with the sums of `values` up to and including each row, per group of `by`."""
    so_far = Window.partitionBy("part", *by).orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    earlier = Window.partitionBy(*by).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sums = parts.groupBy("part", *by).agg(*[F.sum(value).alias(name) for name, value in values.items()])
    before = sums.select(
        "part", *by, *[F.coalesce(F.sum(name).over(earlier), F.lit(0)).alias(f"_before_{name}") for name in values]
    )
    inside = parts.withColumns({name: F.sum(value).over(so_far) for name, value in values.items()})
    both = {name: F.col(name) + F.col(f"_before_{name}") for name in values}
    return _attached(inside, before, by).withColumns(both).drop(*[f"_before_{name}" for name in values])


def latest(parts: DataFrame, value: Column, name: str, by: Sequence[str] = ()) -> DataFrame:
    """parts with the last `value` that is not null up to each row, per group of `by`."""
    so_far = Window.partitionBy("part", *by).orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    earlier = Window.partitionBy(*by).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    known = F.when(value.isNotNull(), F.col("place"))
    ends = parts.groupBy("part", *by).agg(F.max_by(value, known).alias("_end"))
    before = ends.select("part", *by, F.last("_end", ignorenulls=True).over(earlier).alias("_before"))
    inside = parts.withColumn(name, F.last(value, ignorenulls=True).over(so_far))
    return _attached(inside, before, by).withColumn(name, F.coalesce(F.col(name), F.col("_before"))).drop("_before")
