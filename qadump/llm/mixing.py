"""Mixing sources to target weights: Pareto order sampling over documents.

A source's target is its weight's share of all words, stopped at `most` times the source's
own words; the excess is reshared by weight until no target is above. Within a source a
document's expected number of copies is proportional to the bit length of its size (longer
documents are likelier to be taken), at most `most`, and such that the expected words meet
the target. The whole part of that number is certain. The rest is an inclusion probability
p: documents are ranked by the odds of a random number over the odds of p, and the first
are taken until the source's remaining words are used up. One more document that fits the
last gap best closes it.

All of it is DataFrame work. The rows are staged once, with a number that tells repeated
ones apart, so the words are counted once and every later step sees the same rows. Random
numbers are hashes of id and text, so reruns agree. The ranking is never sorted whole: words
are summed in `bins` of the rank, and only the bins that hold a cut are sorted, in ranges that
tasks share (`scan`): neither a source nor copies of one row with a third of all rows are a
single task. Sources, one row each, are numbered and their targets found in the same way, so there may be
as many of them as there are hosts.

A null text or one without words has size 0: it can be copied, but takes no words; a very long one is
counted where it is. Null is a
source of its own, after all others. Rows with null or repeated ids are drawn each for
itself; rows of equal rank (copies of one id and text) are taken in the order of the table. An empty table gives an empty result; if there are no words, all targets are 0 and
nothing is taken. All columns travel inside one struct, so their names can't clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from qadump.llm.common import small, staged, word_count
from qadump.llm.scan import ordered, running

EPSILON = 1e-9


def _uniform(*columns: Column) -> Column:
    """A number between 0 and 1 (both excluded) from a 64-bit hash."""
    bits = F.shiftrightunsigned(F.xxhash64(F.lit("mixing"), *columns), 11)
    return (bits.cast("double") + 0.5) / F.lit(float(1 << 53))


def targets(sizes: DataFrame, weights: int = 3, most: float = 3.0) -> DataFrame:
    """source, source_size, target, from rows of source and size (one row per source at most)."""
    by_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    named = running(ordered(by_source, [F.col("source").asc_nulls_last()], "sources"), {"nth": F.lit(1)})
    weighed = named.select("source", "source_size", ((F.col("nth") - 1) % weights + 1).alias("weight"))
    ratio = F.col("source_size") / F.col("weight")
    # Sources fill up in the order of cap per weight: `level` is the share of one unit of
    # weight if all before have stopped at their caps and this one has not.
    order = [F.col("ratio"), F.col("source").asc_nulls_last()]
    parts = ordered(weighed.withColumn("ratio", ratio), order, "sources-by-ratio")
    total, all_weights = parts.agg(F.sum("source_size"), F.sum("weight")).first()
    filled = running(parts, {"sizes": F.col("source_size"), "used": F.col("weight")})
    capped = (F.col("sizes") - F.col("source_size")) * most
    level = (F.lit(total) - capped) / (F.lit(all_weights) - F.col("used") + F.col("weight"))
    free = F.col("source_size") * most >= F.col("level") * F.col("weight")
    order_key = F.struct("ratio", F.col("source").isNull().alias("last"), "source")
    first = filled.withColumn("level", level).where(free).agg(F.min_by("level", order_key)).first()[0] or 0.0
    return parts.select(
        "source",
        F.col("source_size").cast("long").alias("source_size"),
        F.least(F.col("source_size") * F.lit(float(most)), F.lit(first) * F.col("weight")).alias("target"),
    )


def allocation(sizes: DataFrame, weights: int = 3, most: float = 3.0) -> DataFrame:
    """source, bits, source_size, target, whole, chance, rest.

    For documents of a source whose size has so many bits: certain copies and the
    probability of one more; rest: the words of the source that chance has to deal out.
    """
    levels = sizes.groupBy("source", F.length(F.bin("size")).alias("bits")).agg(F.sum("size").alias("words"))
    own = Window.partitionBy("source").orderBy(F.desc("bits"))
    longer = F.coalesce(F.sum("words").over(own.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    shorter = F.sum(F.col("words") * F.col("bits")).over(own.rowsBetween(0, Window.unboundedFollowing))
    goals = targets(sizes, weights, most)
    rate = F.when(F.col("shorter") > 0, (F.col("target") - most * F.col("longer")) / F.col("shorter"))
    fits = F.col("rate") * F.col("bits") < most
    whole_source = Window.partitionBy("source")
    # Without a rate that fits, all documents have all their copies.
    copies = F.least(F.lit(float(most)), F.coalesce(F.col("rate") * F.col("bits"), F.lit(float(most))))
    return (
        levels.withColumn("longer", longer)
        .withColumn("shorter", shorter)
        .join(goals.withColumnRenamed("source", "goal_source"), F.col("source").eqNullSafe(F.col("goal_source")))
        .withColumn("rate", rate)
        .withColumn("rate", F.max_by(F.when(fits, F.col("rate")), F.when(fits, F.col("bits"))).over(whole_source))
        .withColumn("copies", F.when(F.col("target") > 0, copies).otherwise(0.0))
        .withColumn("whole", F.floor(F.col("copies") + EPSILON))
        .withColumn("chance", F.greatest(F.col("copies") - F.col("whole"), F.lit(0.0)))
        .withColumn("rest", F.col("target") - F.sum(F.col("whole") * F.col("words")).over(whole_source))
        .select("source", "bits", "source_size", "target", "whole", "chance", "rest")
    )


def _place(chance: Column, uniform: Column) -> Column:
    """The Pareto rank of a row, mapped to 0 .. 1; null for rows that chance has nothing to add to."""
    odds = (uniform / (1 - uniform)) / (chance / (1 - chance))
    return F.when(chance > EPSILON, odds / (1 + odds))


def _cuts(rows: DataFrame, bins: int) -> DataFrame:
    """For each source the place and tie number of the last row taken by chance."""
    slot = F.floor(F.col("place") * bins)
    chancy = rows.where("place is not null and size > 0").withColumn("bin", slot)
    along = Window.partitionBy("source").orderBy("bin")
    edge = (
        chancy.groupBy("source", "bin")
        .agg(F.sum("size").alias("words"), F.first("rest").alias("rest"))
        .withColumn("upto", F.sum("words").over(along))
        .withColumn("before", F.col("upto") - F.col("words"))
        .where("before <= rest")
        .groupBy("source")
        .agg(F.max_by(F.struct("bin", "before", "rest"), "bin").alias("edge"))
        .select(F.col("source").alias("edge_source"), "edge.bin", "edge.before", "edge.rest")
    )
    inside = chancy.select("source", "bin", "place", "tie", "size").join(
        edge.withColumnRenamed("bin", "edge_bin"),
        F.col("source").eqNullSafe(F.col("edge_source")) & (F.col("bin") == F.col("edge_bin")),
    )
    # A group name that is never null, as groups of a scan must be.
    name = F.concat(F.when(F.col("source").isNull(), "n").otherwise("s"), F.coalesce("source", F.lit("")))
    near = inside.select(
        name.alias("group"), "source", "edge_bin", "before", "rest", F.col("place").alias("rank"), "tie", "size"
    )
    parts = ordered(near, ["group", "rank", "tie"], "mixing-cut")
    upto = running(parts, {"words": F.col("size")}, ["group"]).withColumn("upto", F.col("before") + F.col("words"))
    cut = (
        upto.withColumn(
            "at", F.when(F.col("upto") <= F.col("rest"), F.struct(F.col("rank").alias("place"), "tie", "upto"))
        )
        .groupBy("source")
        .agg(
            F.max("at").alias("at"),
            F.first("edge_bin").alias("bin"),
            F.first("before").alias("before"),
            F.first("rest").alias("rest"),
        )
    )
    # If the bin's first row is too long already, the cut is the bin's lower edge.
    cuts = cut.select(
        F.col("source").alias("cut_source"),
        F.coalesce("at.place", F.col("bin") / bins).alias("cut_place"),
        F.coalesce("at.tie", F.lit(-1).cast("long")).alias("cut_tie"),
        (F.col("rest") - F.coalesce("at.upto", "before")).alias("gap"),
    )
    # The row that would come next is longer than the gap. One row past the cut, the one
    # that fits the gap best, is taken too if that brings the source nearer to its target.
    miss = F.abs(F.col("size") - F.col("gap"))
    closing = (
        chancy.join(cuts, F.col("source").eqNullSafe(F.col("cut_source")))
        .where(~_within() & (miss < F.col("gap")))
        .groupBy("source")
        .agg(F.min(F.struct(miss.alias("miss"), "place", "tie")).alias("row"))
        .select(
            F.col("source").alias("close_source"),
            F.col("row.place").alias("close_place"),
            F.col("row.tie").alias("close_tie"),
        )
    )
    return cuts.join(closing, F.col("cut_source").eqNullSafe(F.col("close_source")), "left").select(
        "cut_source", "cut_place", "cut_tie", "close_place", "close_tie"
    )


def _within() -> Column:
    at_cut = (F.col("place") == F.col("cut_place")) & (F.col("tie") <= F.col("cut_tie"))
    return (F.col("place") < F.col("cut_place")) | at_cut


def mix(
    docs: DataFrame,
    weights: int = 3,
    most: float = 3.0,
    bins: int = 4096,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    carried: list[str] | None = None,
) -> DataFrame:
    """row (a struct of all columns of docs, or of the carried ones), size, source_size, target
    and copies (0 .. most)."""
    drawn = staged(
        docs.select(
            F.struct(*(carried or ["*"])).alias("row"),
            F.col(source).alias("source"),
            word_count(text).alias("size"),
            _uniform(F.col(doc_id), F.col(text)).alias("uniform"),
            F.monotonically_increasing_id().alias("tie"),
        ).withColumn("bits", F.length(F.bin("size"))),
        "mixing",
    )
    slim = drawn.drop("row")
    levels = small(
        staged(allocation(slim, weights, most), "mixing-levels").withColumnsRenamed(
            {"source": "level_source", "bits": "level_bits"}
        )
    )

    def ranked(rows: DataFrame) -> DataFrame:
        same = F.col("source").eqNullSafe(F.col("level_source")) & (F.col("bits") == F.col("level_bits"))
        return rows.join(levels, same).withColumn("place", _place(F.col("chance"), F.col("uniform")))

    cuts = small(staged(_cuts(ranked(slim), bins), "mixing-cuts"))
    closes = (F.col("place") == F.col("close_place")) & (F.col("tie") == F.col("close_tie"))
    chosen = F.coalesce(_within(), F.lit(False)) | F.coalesce(closes, F.lit(False))
    return (
        ranked(drawn)
        .join(cuts, F.col("source").eqNullSafe(F.col("cut_source")), "left")
        .select(
            "row",
            "size",
            "source_size",
            "target",
            (F.col("whole") + chosen.cast("int")).cast("int").alias("copies"),
        )
    )


def repeated(mixed: DataFrame) -> DataFrame:
    """The rows of `mix`, each as often as it was allotted, with the columns they came with."""
    times = F.explode(F.array_repeat(F.lit(0), F.col("copies")))
    return mixed.where("copies > 0").select("row", times).select("row.*")
