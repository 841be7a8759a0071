"""Typed tables of users, questions and answers."""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from qadump.functions.values import (
    epoch_or_zero,
    int_or_zero,
    length_or_zero,
    presence_flag,
)
from qadump.operators.records import PERMISSIVE, records
from qadump.schemas import (
    ANSWER_COLUMNS,
    POSTS,
    QUESTION_COLUMNS,
    QUESTION_POST_TYPE,
    USERS,
)

# Answers have no use for what only questions have.
ANSWER_POSTS = POSTS.narrowed(*POSTS.question_numbers)

TYPED_USER = (
    f"{int_or_zero('Id')} as id",
    f"{int_or_zero('Reputation')} as reputation",
    f"{epoch_or_zero('CreationDate')} as signup_date",
    f"{epoch_or_zero('LastAccessDate')} as last_access_date",
    f"{presence_flag('WebsiteUrl')} as has_website",
    f"{presence_flag('Location')} as has_location",
    f"{presence_flag('AboutMe')} as has_about_me",
    f"{int_or_zero('Views')} as profile_views",
    f"{int_or_zero('UpVotes')} as up_votes",
    f"{int_or_zero('DownVotes')} as down_votes",
    f"{int_or_zero('Age')} as age",
)
TYPED_ANSWER = (
    "PostTypeId as post_type",
    f"{int_or_zero('Id')} as id",
    f"{int_or_zero('Score')} as score",
    f"{int_or_zero('ViewCount')} as views",
    f"{int_or_zero('OwnerUserId')} as user_id",
    f"{int_or_zero('CommentCount')} as comment_count",
    f"{int_or_zero('FavoriteCount')} as favourite_count",
    f"{length_or_zero('Body')} as body_length",
)
TYPED_POST = (
    *TYPED_ANSWER,
    f"{int_or_zero('AcceptedAnswerId')} as accepted_answer_id",
    f"{int_or_zero('AnswerCount')} as answer_count",
)


def users(lines: DataFrame, mode: str = PERMISSIVE, counted: Observation | None = None) -> DataFrame:
    """One row per user record. Ids are taken as they are, not made unique.

    counted: takes the counters of the pass, as in `records`.
    """
    return records(lines, USERS, mode, counted).selectExpr(*TYPED_USER)


def posts(lines: DataFrame, mode: str = PERMISSIVE, counted: Observation | None = None) -> DataFrame:
    """Questions and answers of one pass over the posts, bodies reduced to their length.

    `post_type` tells them apart; every column is typed as in both tables. counted: takes the
    counters of the pass, as in `records`.
    """
    return records(lines, POSTS, mode, counted).selectExpr(*TYPED_POST)


def questions_of(typed_posts: DataFrame) -> DataFrame:
    return typed_posts.where(F.col("post_type") == QUESTION_POST_TYPE).select(*QUESTION_COLUMNS)


def answers_of(typed_posts: DataFrame, post_types: Collection[str] | None = None) -> DataFrame:
    """Every post that is no question, whatever its type, unless `post_types` names exact ones."""
    if post_types is None:
        wanted = F.col("post_type") != QUESTION_POST_TYPE
    else:
        wanted = F.col("post_type").isin(*post_types)
    return typed_posts.where(wanted).select(*ANSWER_COLUMNS)


def questions(lines: DataFrame, mode: str = PERMISSIVE) -> DataFrame:
    return questions_of(posts(lines, mode))


def answers(
    lines: DataFrame, mode: str = PERMISSIVE, post_types: Collection[str] | None = None
) -> DataFrame:
    return answers_of(records(lines, ANSWER_POSTS, mode).selectExpr(*TYPED_ANSWER), post_types)
