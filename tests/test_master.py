"""The user table on rows made to be awkward."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from compare import rows_of
from fixtures import render
from qadump.operators import entities
from qadump.operators.summaries import answer_summary, question_summary
from qadump.plans.master import user_master_from_dump, user_master_from_sets
from qadump.schemas import MASTER_COLUMNS, SET_SCHEMAS, USER_COLUMNS


def frame(spark, name, rows):
    return spark.createDataFrame(rows, SET_SCHEMAS[name])


def user(key, **values):
    return (key, values.get("reputation", 1), *range(2, 11))


def by_four_joins(users, badges, comments, answers, questions):
    """The same table as a chain of joins, one per source."""
    result = users
    for side in (badges, comments, answer_summary(answers), question_summary(questions)):
        side = side.withColumnRenamed("user_id", "key")
        result = result.join(side, result.id == side.key, "left_outer").drop("key")
    return result.select(*MASTER_COLUMNS)


def sets(spark, users, badges=(), comments=(), answers=(), questions=()):
    return (
        frame(spark, "users", users),
        frame(spark, "badges", list(badges)),
        frame(spark, "comments", list(comments)),
        frame(spark, "answers", list(answers)),
        frame(spark, "questions", list(questions)),
    )


def answer(post_id, owner, score=1):
    return (post_id, score, 2, owner, 3, 4, 5)


def question(post_id, owner, accepted=0):
    return (post_id, accepted, 1, 2, owner, 3, 4, 5, 6)


def awkward(spark):
    return sets(
        spark,
        [user(0), user(0, reputation=9), user(1), user(1), user(2), user(3), user(None), user(-4)],
        [(0, 5), (None, 7), (2, 1), (99, 1)],
        [(1, 2), (None, 3)],
        [answer(1, 0), answer(2, 0, None), answer(3, None), answer(None, 2), answer(5, -4)],
        [question(7, 0, 5), question(8, 1, None), question(9, 1, -1), question(None, 3, 0)],
    )


def test_equals_a_chain_of_joins(spark):
    found = user_master_from_sets(*awkward(spark))
    assert rows_of(found) == rows_of(by_four_joins(*awkward(spark)))


def test_users_without_activity_have_nulls(spark):
    (row,) = user_master_from_sets(*sets(spark, [user(5)])).collect()
    assert all(row[name] is None for name in MASTER_COLUMNS[11:])


def test_averages_of_posts_without_ids_are_null(spark):
    (row,) = user_master_from_sets(*sets(spark, [user(2)], answers=[answer(None, 2)])).collect()
    assert (row.total_answers, row.total_answer_score, row.average_answer_score) == (0, 1, None)


def test_ratios_are_null_under_both_ansi_modes(spark, settings):
    for ansi in ("true", "false"):
        settings(spark__sql__ansi__enabled=ansi)
        found = user_master_from_sets(*awkward(spark))
        assert rows_of(found) == rows_of(by_four_joins(*awkward(spark)))


@pytest.mark.parametrize("hot_id", [0, 7, None])
@pytest.mark.parametrize("copies", [True, False])
def test_hot_user_id(spark, settings, hot_id, copies):
    """A third of all users share one id, as copies of one record or as different ones."""
    settings(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="20k",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="1.5",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="10k",
    )
    rows = 30_000
    hot = "null" if hot_id is None else hot_id
    reputation = "1" if copies else "id"
    users = spark.range(rows).selectExpr(
        f"int(if(id % 3 = 0, {hot}, id + 10)) as id",
        f"int({reputation}) as reputation",
        *[f"{i} as {name}" for i, name in enumerate(USER_COLUMNS[2:])],
    )
    _, badges, comments, answers, questions = awkward(spark)
    badges = badges.union(frame(spark, "badges", [(7, 3), (20, 1)]))
    found = user_master_from_sets(users, badges, comments, answers, questions)
    expected = by_four_joins(users, badges, comments, answers, questions)
    assert rows_of(found) == rows_of(expected)
    found.collect()  # the adaptive plan is final once it has run
    plan = found._jdf.queryExecution().executedPlan().toString()
    if hot_id == 7 or (hot_id == 0 and copies):
        assert "skew=true" in plan
    if hot_id in (0, None) and not copies:
        salts = users.where("coalesce(id, 0) = 0").selectExpr(
            f"pmod(xxhash64({', '.join(users.columns)}), 64) as salt"
        ).groupBy("salt").count()
        assert salts.count() == 64
        assert salts.agg(F.max("count")).first()[0] < rows / 3 / 20


@pytest.mark.parametrize("salts", [1, 5])
def test_the_number_of_salts_changes_nothing(spark, salts):
    found = user_master_from_sets(*awkward(spark), salts=salts)
    assert rows_of(found) == rows_of(by_four_joins(*awkward(spark)))


def test_rows_beyond_32_bits(spark, lines_of):
    far = 3_000_000_000
    found = user_master_from_dump(
        lines_of(f'<row Id="{far}" />'),
        lines_of(*[f'<row Id="{far + i}" PostTypeId="1" OwnerUserId="{far}" Score="2" />' for i in range(3)]),
        lines_of(f'<row UserId="{far}" />'),
        lines_of(),
    )
    (row,) = found.collect()
    assert (row.id, row.total_questions, row.total_question_score) == (far, 3, 6)
    assert (row.average_question_score, row.number_of_badges, row.number_of_comments) == (2.0, 1, None)


def test_ids_of_rendered_users_are_unique(spark):
    users = entities.users(render.users(spark, "/root/testdata/sf0.01")).where("id <> 0")
    assert users.count() == users.select("id").distinct().count() > 1000


def test_hot_owner_of_posts_moves_as_partial_sums(spark, lines_of):
    """A third of all posts belong to one owner; each task sends one row for them."""
    posts = spark.range(9_000).selectExpr(
        '''concat('<row Id="', id, '" PostTypeId="', 1 + id % 2, '" OwnerUserId="',
        if(id % 3 = 0, 0, id), '" />') as value'''
    )
    found = user_master_from_dump(
        lines_of('<row Id="0" />', '<row Id="4" />'), posts, lines_of(), lines_of()
    )
    rows = {r.id: (r.total_questions, r.total_answers) for r in found.collect()}
    assert rows == {0: (1500, 1500), 4: (1, None)}


@pytest.mark.parametrize("faulty", range(4))
def test_failfast_finds_a_fault_in_any_source(spark, lines_of, faulty):
    good = [
        '<row Id="1" />',
        '<row Id="1" PostTypeId="1" OwnerUserId="1" />',
        '<row UserId="1" />',
        '<row UserId="1" />',
    ]
    sources = [lines_of(line, *(["<row broken />"] if i == faulty else [])) for i, line in enumerate(good)]
    with pytest.raises(PySparkException, match="malformed"):
        user_master_from_dump(*sources, mode="failfast").collect()
    (row,) = user_master_from_dump(*sources).collect()
    assert (row.id, row.total_questions, row.number_of_badges, row.number_of_comments) == (1, 1, 1, 1)
