"""The batch jobs: dump files to typed CSV sets, and the sets to the user table.

A source is a path, a list of paths, or a DataFrame of lines. Each extraction job
returns the counts of its pass by name, for instance `{"users": 120, "users_rejects": 1}`.

A job parses its dump once. What its sets need of each record, without bodies, and the
reason of each reject are staged as Parquet beside the target; sets, counts and, with
`rejects_target`, the rejected lines are made from that, and it is deleted at the end. So the
counts are those of the rows that were written, whatever tasks had to run twice, and a source
without any good record is counted like any other.

The targets of a job are checked before it reads its source, and written together: an existing
target stops the job at once, and a failure at any set, or at the rejects, leaves none of them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from qadump.operators import counts, entities
from qadump.operators.records import COUNTERS, PERMISSIVE, checked, parse, rejects_of
from qadump.plans.master import user_master_from_sets
from qadump.schemas import (
    BADGES,
    COMMENTS,
    POST_HISTORY,
    POST_LINKS,
    POSTS,
    USERS,
    Entity,
)
from qadump.sources.dump import read_lines
from qadump.sources.sets import read_set, write_files, write_result
from qadump.sources.staging import committed, staging_beside

Source = str | list[str] | DataFrame


@contextmanager
def _one_pass(
    spark: SparkSession,
    source: Source,
    entity: Entity,
    columns: tuple[str, ...] | list[str],
    targets: list[str],
    mode: str,
    rejects_target: str | None,
) -> Iterator[tuple[DataFrame, dict[str, int], list[str]]]:
    """The typed columns of all good records, staged, the counts of the pass, and where to write the sets."""
    wanted = [*targets, rejects_target] if rejects_target else targets
    with committed(spark, wanted) as places, staging_beside(spark, targets[0]) as path:
        parsed = parse(read_lines(spark, source), entity)
        if mode != PERMISSIVE:
            parsed = checked(parsed, entity, mode)
        line = "if(reject_reason is null, null, line)" if rejects_target else "cast(null as string)"
        staged = parsed.selectExpr(*columns, "reject_reason", f"{line} as line")
        staged.write.parquet(path)
        staged = spark.read.schema(staged.schema).parquet(path)
        found = staged.agg(*map(F.expr, COUNTERS)).first()
        yield (
            staged.where("reject_reason is null").drop("reject_reason", "line"),
            {entity.name: found["rows"], f"{entity.name}_rejects": found["rejects"]},
            places,
        )
        if rejects_target:
            rejects_of(staged, entity).write.mode("errorifexists").parquet(places[-1])


def _extraction(
    entity: Entity, columns: tuple[str, ...] | list[str], table: Callable[[DataFrame], DataFrame]
):
    def job(
        spark: SparkSession,
        source: Source,
        target: str,
        mode: str = PERMISSIVE,
        rejects_target: str | None = None,
    ) -> dict[str, int]:
        with _one_pass(spark, source, entity, columns, [target], mode, rejects_target) as (rows, found, places):
            write_files(table(rows), places[0])
        return found

    return job


def _counts(entity: Entity):
    return _extraction(entity, counts.typed_keys(entity), lambda rows: counts.count_of(rows, entity))


users_to_csv = _extraction(USERS, entities.TYPED_USER, lambda rows: rows)
questions_to_csv = _extraction(POSTS, entities.TYPED_POST, entities.questions_of)
answers_to_csv = _extraction(entities.ANSWER_POSTS, entities.TYPED_ANSWER, entities.answers_of)
badges_to_csv = _counts(BADGES)
comments_to_csv = _counts(COMMENTS)
postlinks_to_csv = _counts(POST_LINKS)
posthistory_to_csv = _counts(POST_HISTORY)


def posts_to_csv(
    spark: SparkSession,
    source: Source,
    questions_target: str,
    answers_target: str,
    mode: str = PERMISSIVE,
    rejects_target: str | None = None,
) -> dict[str, int]:
    """Questions, answers and, if wanted, rejects from one pass over the posts."""
    targets = [questions_target, answers_target]
    with _one_pass(spark, source, POSTS, entities.TYPED_POST, targets, mode, rejects_target) as (
        posts,
        found,
        places,
    ):
        write_files(entities.questions_of(posts), places[0])
        write_files(entities.answers_of(posts), places[1])
    return found


def combine_from_csv(
    spark: SparkSession,
    users: str,
    badges: str,
    comments: str,
    answers: str,
    questions: str,
    target: str,
    header: bool = True,
    single_file: bool = False,
) -> None:
    """Join the five sets to the user table and write it as CSV."""
    master = user_master_from_sets(
        read_set(spark, "users", users, header),
        read_set(spark, "badges", badges, header),
        read_set(spark, "comments", comments, header),
        read_set(spark, "answers", answers, header),
        read_set(spark, "questions", questions, header),
    )
    write_result(master, target, single_file)
