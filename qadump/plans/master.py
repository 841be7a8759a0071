"""The wide user table: every user with counts, totals and averages of their activity.

The result is users left-joined to badge counts, comment counts, the answer
summary and the question summary, all by user. As all four are keyed by user,
they are built together: what each badge, comment and post adds is one narrow row,
the rows of all sources are summed in a single aggregation, and one join
attaches the sums. So there is one shuffle for all activity and one pass over the
posts, and the rows are combined inside the map tasks before they move.

A user without, say, badges gets null, not 0: no row of theirs has a value in that
column, and a sum of nulls is null.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame

from qadump.operators import entities
from qadump.operators.counts import keys
from qadump.operators.records import PERMISSIVE
from qadump.operators.summaries import (
    ANSWER_MEASURES,
    QUESTION_MEASURES,
    sum_per_user,
    with_answer_averages,
    with_question_averages,
)
from qadump.schemas import BADGES, COMMENTS, MASTER_COLUMNS, QUESTION_POST_TYPE, USER_COLUMNS

# Every user record without an Id has id 0, and every one with an empty Id a null id, so these
# two can hold a large share of all users; they are spread over this many join keys.
SALTS = 64


def _part(rows: DataFrame, measures: dict[str, str]) -> DataFrame:
    return rows.selectExpr(
        "user_id", *[f"cast({measure} as bigint) as {name}" for name, measure in measures.items()]
    )


def _only_if(condition: str, measures: dict[str, str]) -> dict[str, str]:
    return {name: f"if({condition}, {measure}, null)" for name, measure in measures.items()}


def activity(*parts: DataFrame) -> DataFrame:
    """Sum the parts (`user_id` and any measures) to one row per user."""
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    measures = {name: name for name in rows.columns if name != "user_id"}
    totals = sum_per_user(rows.where("user_id is not null"), measures)
    return with_question_averages(with_answer_averages(totals))


def attach(users: DataFrame, user_activity: DataFrame, salts: int = SALTS) -> DataFrame:
    """Left join of users (any number per id) to their activity (one row per id).

    The salt spreads id 0 and null ids by the users' other columns; the one activity row
    of id 0 is repeated per salt, null ids match none. Other hot ids, and copies of one
    record, are left to the adaptive skew join, which can split the users' side: with the
    salt in the key, both sides come straight from a shuffle of the join.
    """
    spread = f"int(pmod(xxhash64({', '.join(USER_COLUMNS)}), {salts}))"
    salted = users.selectExpr(*USER_COLUMNS, f"if(coalesce(id, 0) = 0, {spread}, 0) as salt")
    copies = f"if(user_id = 0, sequence(0, {salts - 1}), array(0))"
    repeated = user_activity.selectExpr("*", f"explode({copies}) as salt")
    same_user = (salted.id == repeated.user_id) & (salted.salt == repeated.salt)
    return salted.join(repeated, same_user, "left_outer").select(*MASTER_COLUMNS)


def user_master_from_dump(
    user_lines: DataFrame,
    post_lines: DataFrame,
    badge_lines: DataFrame,
    comment_lines: DataFrame,
    mode: str = PERMISSIVE,
    salts: int = SALTS,
) -> DataFrame:
    """The user table straight from the dump; each file is read and parsed once."""
    is_question = f"post_type = '{QUESTION_POST_TYPE}'"
    post_measures = _only_if(f"not {is_question}", ANSWER_MEASURES) | _only_if(
        is_question, QUESTION_MEASURES
    )
    return attach(
        entities.users(user_lines, mode),
        activity(
            _part(keys(badge_lines, BADGES, mode), {"number_of_badges": "1"}),
            _part(keys(comment_lines, COMMENTS, mode), {"number_of_comments": "1"}),
            _part(entities.posts(post_lines, mode), post_measures),
        ),
        salts,
    )


def user_master_from_sets(
    users: DataFrame,
    badges: DataFrame,
    comments: DataFrame,
    answers: DataFrame,
    questions: DataFrame,
    salts: int = SALTS,
) -> DataFrame:
    """The user table from extracted sets; badges and comments hold counts per user."""
    return attach(
        users,
        activity(
            _part(badges, {"number_of_badges": "number_of_badges"}),
            _part(comments, {"number_of_comments": "number_of_comments"}),
            _part(answers, ANSWER_MEASURES),
            _part(questions, QUESTION_MEASURES),
        ),
        salts,
    )
