"""What Spark is going to do for the queries."""

import re

import pytest
from pyspark.sql import Observation

import __spark_entry__ as contract
from fixtures import render
from qadump.operators import counts, entities, records
from qadump.operators.summaries import answer_summary, question_summary
from qadump.plans.master import user_master_from_dump
from qadump.schemas import BADGES, COMMENTS, POST_HISTORY, POST_LINKS, POSTS, USERS
from qadump.sources.dump import read_lines

SF_DIR = contract.SMOKE_DIR


@pytest.fixture(scope="module")
def dump(spark, tmp_path_factory):
    return render.write_dump(spark, SF_DIR, str(tmp_path_factory.mktemp("dump")))


@pytest.fixture
def physical_plan(settings):
    settings(
        spark__sql__adaptive__enabled="false", spark__sql__autoBroadcastJoinThreshold="-1"
    )
    return lambda df: df._jdf.queryExecution().executedPlan().toString()


def parses(plan):
    # one generator per scan holds the parse; no other operator repeats it
    generators = [line for line in plan.splitlines() if "Generate inline" in line]
    others = [line for line in plan.splitlines() if "from_xml" in line and line not in generators]
    assert not others
    return len(generators)


CASES = {
    "users": (lambda s, d: entities.users(read_lines(s, d[USERS])), 1, 0),
    "questions": (lambda s, d: entities.questions(read_lines(s, d[POSTS])), 1, 0),
    "answers": (lambda s, d: entities.answers(read_lines(s, d[POSTS])), 1, 0),
    "badges": (lambda s, d: counts.badge_counts(read_lines(s, d[BADGES])), 1, 1),
    "links": (lambda s, d: counts.link_counts(read_lines(s, d[POST_LINKS])), 1, 1),
    "history": (lambda s, d: counts.history_counts(read_lines(s, d[POST_HISTORY])), 1, 1),
    "answer_summary": (
        lambda s, d: answer_summary(entities.answers(read_lines(s, d[POSTS]))), 1, 1,
    ),
    "question_summary": (
        lambda s, d: question_summary(entities.questions(read_lines(s, d[POSTS]))), 1, 1,
    ),
    # users, activity, and activity by join key
    "user_master": (
        lambda s, d: user_master_from_dump(
            *(read_lines(s, d[e]) for e in (USERS, POSTS, BADGES, COMMENTS))
        ), 4, 3,
    ),
}


@pytest.mark.parametrize("name", CASES)
def test_one_parse_per_scan_and_no_extra_shuffle(spark, dump, physical_plan, name):
    query, scans, shuffles = CASES[name]
    plan = physical_plan(query(spark, dump))
    assert plan.count("FileScan text") == scans
    assert parses(plan) == scans
    assert len(re.findall(r"\bExchange ", plan)) == shuffles


@pytest.mark.parametrize("name", ["history", "answer_summary", "user_master"])
def test_rows_are_combined_before_the_shuffle(spark, dump, physical_plan, name):
    plan = physical_plan(CASES[name][0](spark, dump))
    assert re.search(r"HashAggregate\(.*functions=\[partial_", plan)
    assert "SortAggregate" not in plan


@pytest.mark.parametrize(
    "name",
    [n for n in contract.own_queries() if not n.endswith(("roundtrip", "counters"))],
)
def test_no_python_no_cross_join_no_broadcast(spark, physical_plan, name):
    plan = physical_plan(contract.own_queries()[name](spark, SF_DIR))
    for unwanted in ("Python", "Arrow", "CartesianProduct", "NestedLoop", "Broadcast"):
        assert unwanted not in plan


def test_null_users_are_dropped_before_the_shuffle(spark, dump, physical_plan):
    plan = physical_plan(CASES["user_master"][0](spark, dump))
    filters = [line for line in plan.splitlines() if "Filter" in line and "isnotnull" in line]
    assert len(filters) >= 3


def test_only_wanted_attributes_are_extracted(spark, dump, physical_plan):
    plan = physical_plan(CASES["badges"][0](spark, dump))
    fields = set(re.findall(r"StructField\(@(\w+),", plan))
    assert fields <= {"UserId", "error", "a"}


def test_answers_are_read_without_what_questions_have(spark, dump, physical_plan):
    plan = physical_plan(CASES["answers"][0](spark, dump))
    fields = set(re.findall(r"StructField\(@(\w+),", plan))
    assert "Score" in fields and not fields & {"AcceptedAnswerId", "AnswerCount"}


def test_one_big_file_is_split(spark, settings, tmp_path):
    source = tmp_path / "Badges.xml"
    source.write_text("".join(f'  <row Id="{i}" UserId="{i % 7}" />\n' for i in range(40_000)))
    settings(spark__sql__files__maxPartitionBytes="131072", spark__sql__files__openCostInBytes="1")
    lines = read_lines(spark, str(source))
    assert lines.rdd.getNumPartitions() >= 8
    assert sum(r.number_of_badges for r in counts.badge_counts(lines).collect()) == 40_000


@pytest.mark.parametrize("name", ["users", "user_master"])
def test_generated_methods_are_small_enough_to_be_compiled(spark, dump, settings, capsys, name):
    settings(spark__sql__adaptive__enabled="false")
    CASES[name][0](spark, dump).explain("codegen")
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", capsys.readouterr().out)]
    assert sizes and max(sizes) < 8000  # the JVM only interprets larger ones


@pytest.mark.parametrize("entity", [USERS, POSTS, BADGES])
def test_counted_records_are_parsed_once(spark, dump, physical_plan, entity):
    counted = Observation()
    df = records.records(read_lines(spark, dump[entity]), entity, counted=counted)
    plan = physical_plan(df)
    assert plan.count("FileScan text") == 1 and parses(plan) == 1
    assert plan.count("CollectMetrics") == 1 and "Exchange" not in plan
