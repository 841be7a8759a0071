"""Activity counts per user or post.

An absent or empty key counts under null. Counts are combined inside each map
task before the shuffle, so a hot key costs one row per task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from qadump.functions.values import int_or_null
from qadump.operators.records import PERMISSIVE, records
from qadump.schemas import BADGES, COMMENTS, POST_HISTORY, POST_LINKS, Entity

# attribute -> key column
_KEY_COLUMNS = {"UserId": "user_id", "PostId": "post_id"}
# entity -> column of its counts
COUNT_COLUMNS = {
    BADGES: "number_of_badges",
    COMMENTS: "number_of_comments",
    POST_LINKS: "number_of_links",
    POST_HISTORY: "number_of_edits",
}


def typed_keys(entity: Entity) -> list[str]:
    return [f"{int_or_null(name)} as {_KEY_COLUMNS[name]}" for name in entity.attributes]


def keys(
    lines: DataFrame, entity: Entity, mode: str = PERMISSIVE, counted: Observation | None = None
) -> DataFrame:
    """The typed key columns of each record. counted: takes the counters of the pass, as in `records`."""
    return records(lines, entity, mode, counted).selectExpr(*typed_keys(entity))


def count_of(rows: DataFrame, entity: Entity) -> DataFrame:
    """Rows of typed keys, counted per key."""
    names = [_KEY_COLUMNS[name] for name in entity.attributes]
    return rows.groupBy(*names).agg(F.count("*").alias(COUNT_COLUMNS[entity]))


def badge_counts(lines: DataFrame, mode: str = PERMISSIVE) -> DataFrame:
    return count_of(keys(lines, BADGES, mode), BADGES)


def comment_counts(lines: DataFrame, mode: str = PERMISSIVE) -> DataFrame:
    return count_of(keys(lines, COMMENTS, mode), COMMENTS)


def link_counts(lines: DataFrame, mode: str = PERMISSIVE) -> DataFrame:
    return count_of(keys(lines, POST_LINKS, mode), POST_LINKS)


def history_counts(lines: DataFrame, mode: str = PERMISSIVE) -> DataFrame:
    return count_of(keys(lines, POST_HISTORY, mode), POST_HISTORY)
