"""Post totals and averages per user.

Sums skip nulls and are null for a user whose values are all null; the post
counts skip posts without an id. Averages divide the exact totals.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from qadump.functions.values import ratio, truth_flag
from qadump.schemas import (
    ANSWER_AVERAGES,
    ANSWER_COUNT,
    ANSWER_TOTALS,
    QUESTION_AVERAGES,
    QUESTION_COUNT,
    QUESTION_TOTALS,
)


def _measures(totals: dict[str, str], count_name: str) -> dict[str, str]:
    """What one post adds to each total of its owner, as SQL text."""
    derived = {"has_accepted_answer": truth_flag("accepted_answer_id")}
    measures = {name: derived.get(column, column) for name, column in totals.items()}
    return measures | {count_name: "cast(id is not null as bigint)"}


ANSWER_MEASURES = _measures(ANSWER_TOTALS, ANSWER_COUNT)
QUESTION_MEASURES = _measures(QUESTION_TOTALS, QUESTION_COUNT)


def sum_per_user(rows: DataFrame, measures: dict[str, str]) -> DataFrame:
    return rows.groupBy("user_id").agg(
        *[F.expr(f"sum({measure}) as {name}") for name, measure in measures.items()]
    )


def _with_averages(totals: DataFrame, averages: dict[str, str], count_name: str) -> DataFrame:
    return totals.selectExpr(
        "*", *[f"{ratio(total, count_name)} as {name}" for name, total in averages.items()]
    )


def with_answer_averages(totals: DataFrame) -> DataFrame:
    return _with_averages(totals, ANSWER_AVERAGES, ANSWER_COUNT)


def with_question_averages(totals: DataFrame) -> DataFrame:
    return _with_averages(totals, QUESTION_AVERAGES, QUESTION_COUNT)


def answer_summary(answers: DataFrame) -> DataFrame:
    return with_answer_averages(sum_per_user(answers, ANSWER_MEASURES))


def question_summary(questions: DataFrame) -> DataFrame:
    return with_question_averages(sum_per_user(questions, QUESTION_MEASURES))
