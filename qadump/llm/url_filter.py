"""URL filters by a sort-merge range join: rules are intervals of keys, URLs points among them.

A rule (host, path, verdict) fits URLs of its host and all subdomains whose path starts with the
rule's. A host's key is its labels from last to first, each ended by a dot: "net.example.". The
keys of a host and its subdomains are then one interval, and intervals of several rules are nested
or apart. A sweep over the sorted starts, ends and points keeps the stack of intervals that are
open: the running sum of starts less ends is the stack's height, and its slot at each height
holds the interval that was last opened at that height.

Two sweeps answer a URL. The first, over hosts, yields a point for each host on the stack.
The second, over those hosts with their rules' paths behind the key, "net.example./en/", yields the top
of the stack: the longest path that fits. Of a URL's rules the longest wins (host and path together;
of equal ones that of the longer host); rules with the same host and path count as one that
blocks if any of them does. Without a rule the verdict is `otherwise`.

Sorting, sums and slots run in ranges of the order (`scan`), so a host or URL with a third of all
rows spreads over many tasks; only small rows go through the sweeps, and both ends meet by row
number. All expressions are Spark's own; rules are never gathered.

The host is what follows the first "://" up to "/", "?", "#" or the end, A-Z in lower case; the path
goes on up to "?", "#" or the end. Null URLs and those without "://" have both empty and fit no
rule, whatever its host; rules with a null host, path or verdict are left out, and so are those of an
empty host. Long URLs are read whole. Repeated rows and URLs are judged each for itself; an empty
table gives an empty result, and no rules give `otherwise` for all. Columns of the pages travel in
one struct, so names can't clash.
"""

from __future__ import annotations

from collections.abc import Iterable
from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from qadump.llm.common import staged
from qadump.llm.scan import latest, ordered, running

ALLOW, BLOCK = "allow", "block"
#: What a row of the sweep is. A point on an interval's first key comes after its start.
START, END, POINT = 0, 1, 2
#: Above every byte of UTF-8 text: a prefix with it ends the interval of what starts with the prefix.
LAST = bytearray(b"\xff")


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Both as text, empty where the URL has none."""
    url = F.coalesce(url, F.lit(""))
    at = F.instr(url, "://")
    rest = F.when(at > 0, url.substr(at + 3, F.length(url))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    return F.translate(host, ascii_uppercase, ascii_lowercase), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def host_key(host: Column) -> Column:
    """Labels from last to first, each ended by a dot."""
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit("."))


def rule_table(spark: SparkSession, rules: Iterable[tuple[str, str, str]]) -> DataFrame:
    """host, path and verdict of rules given as tuples."""
    return spark.createDataFrame(list(rules), "host string, path string, verdict string")


def _swept(points: DataFrame, intervals: DataFrame, purpose: str) -> DataFrame:
    """Points and starts of intervals in order, with the height of the stack after each.

    points: uid, key; intervals: key (a prefix; no two are equal), opened (what the slot holds).
    """
    nothing = F.lit(None).cast(intervals.schema["opened"].dataType)
    first, no_uid = F.col("key").cast("binary"), F.lit(None).cast("long").alias("uid")

    def events(of: DataFrame, at: Column, kind: int, step: int, opened: Column, uid: Column) -> DataFrame:
        return of.select(at.alias("at"), F.lit(kind).alias("kind"), F.lit(step).alias("step"), opened.alias("opened"), uid)

    starts = events(intervals, first, START, 1, F.col("opened"), no_uid)
    ends = events(intervals, F.concat(first, F.lit(LAST)), END, -1, nothing, no_uid)
    met = events(points, first, POINT, 0, nothing, F.col("uid"))
    parts = ordered(starts.unionByName(ends).unionByName(met), ["at", "kind"], purpose)
    return running(parts, {"height": F.col("step")}).where((F.col("kind") != END) & (F.col("height") > 0))


def _slots(swept: DataFrame, levels: Column) -> DataFrame:
    """uid and opened: what the stack's slots of these levels hold, for every point.

    A start fills the slot at its own height, so that slot's latest start is what is open.
    """
    own = F.when(F.col("kind") == START, F.array("height")).otherwise(levels)
    rows = swept.select("part", "place", "kind", "opened", "uid", F.explode(own).alias("level"))
    held = latest(rows, F.col("opened"), "held", ["level"])
    return held.where(F.col("kind") == POINT).select("uid", F.col("held").alias("opened"))


def judged(
    pages: DataFrame,
    rules: DataFrame,
    otherwise: str = ALLOW,
    url: str = "url",
    carried: list[str] | None = None,
) -> DataFrame:
    """row (a struct of the columns `carried`, all if None), host, path, rule and verdict of every row."""
    lowered = F.translate("host", ascii_uppercase, ascii_lowercase)
    blocks = F.max(F.col("verdict") == BLOCK)
    known = staged(
        rules.where("host <> '' and path is not null and verdict is not null")
        .groupBy(lowered.alias("host"), "path")
        .agg(F.when(blocks, BLOCK).otherwise(F.min("verdict")).alias("verdict"))
        .withColumn("key", host_key(F.col("host"))),
        "url-rules",
    )
    host, path = host_and_path(F.col(url))
    rows = staged(
        pages.select(
            F.struct(*(carried or ["*"])).alias("row"),
            host.alias("host"),
            path.alias("path"),
            F.monotonically_increasing_id().alias("uid"),
        ),
        "url-rows",
    )
    hosts = known.select("key", F.col("key").alias("opened")).distinct()
    places = rows.where("host <> ''").select("uid", host_key(F.col("host")).alias("key"))
    whole = F.sequence(F.lit(1).cast("long"), F.col("height"))
    active = _slots(_swept(places, hosts, "url-hosts"), whole)
    # No host has a slash: it parts the host's key from the path.
    below = active.join(rows.select("uid", "path"), "uid").select("uid", F.concat("opened", F.lit("/"), "path").alias("key"))
    paths = known.select(
        F.concat("key", F.lit("/"), "path").alias("key"), F.struct("host", "path", "verdict").alias("opened")
    )
    tops = _slots(_swept(below, paths, "url-paths"), F.array("height"))
    longest = F.struct(F.length("opened.host") + F.length("opened.path"), F.length("opened.host"))
    best = tops.groupBy("uid").agg(F.max_by("opened", longest).alias("fit"))
    return rows.join(best, "uid", "left").select(
        "row",
        "host",
        "path",
        F.concat("fit.host", "fit.path").alias("rule"),
        F.coalesce("fit.verdict", F.lit(otherwise)).alias("verdict"),
    )
