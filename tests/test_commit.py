"""Targets that become complete together or not at all, and results that are swapped."""

import glob
import os
import subprocess
import sys
import time

import pytest
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import functions as F

from qadump.operators import entities
from qadump.plans import jobs
from qadump.sources import staging
from qadump.sources.sets import read_set, write_result, write_set
from qadump.sources.staging import committed

POSTS = [
    "<posts>",
    '<row Id="1" PostTypeId="1" OwnerUserId="3" />',
    '<row Id="2" PostTypeId="2" OwnerUserId="3" />',
    "broken",
    "</posts>",
]


@pytest.fixture
def posts(lines_of):
    return lines_of(*POSTS)


def names(folder):
    return sorted(p.name for p in folder.iterdir())


def read(spark, path):
    return sorted(r.id for r in spark.read.option("header", True).schema("id long").csv(str(path)).collect())


def counting(spark, lines):
    """The same lines, and an accumulator of how many were read."""
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    return lines.mapInArrow(count, "value string"), seen


@pytest.mark.parametrize("there", ["q", "a", "r"])
def test_any_existing_target_stops_the_job_before_it_reads(spark, posts, tmp_path, there):
    (tmp_path / there).mkdir()
    source, seen = counting(spark, posts)
    with pytest.raises(AnalysisException, match="PATH_ALREADY_EXISTS"):
        jobs.posts_to_csv(
            spark, source, str(tmp_path / "q"), str(tmp_path / "a"), rejects_target=str(tmp_path / "r")
        )
    assert seen.value == 0
    assert names(tmp_path) == [there]
    (tmp_path / there).rmdir()
    # Nothing is in the way of the next run.
    jobs.posts_to_csv(spark, posts, str(tmp_path / "q"), str(tmp_path / "a"), rejects_target=str(tmp_path / "r"))
    assert names(tmp_path) == ["a", "q", "r"]


def test_a_set_that_exists_is_an_error_before_any_work(spark, tmp_path):
    (tmp_path / "set").mkdir()
    source, seen = counting(spark, spark.range(9).selectExpr("string(id) as value"))
    with pytest.raises(AnalysisException, match="PATH_ALREADY_EXISTS"):
        write_set(source, str(tmp_path / "set"))
    assert seen.value == 0


def failing(df):
    return df.withColumn("id", F.when(F.col("id") >= 0, F.raise_error(F.lit("planted"))).cast("long"))


@pytest.mark.parametrize("part", ["questions_of", "answers_of"])
def test_a_failure_at_any_set_leaves_none(spark, posts, tmp_path, monkeypatch, part):
    plain = getattr(entities, part)
    monkeypatch.setattr(entities, part, lambda rows: failing(plain(rows)))
    with pytest.raises(PySparkException, match="planted"):
        jobs.posts_to_csv(
            spark, posts, str(tmp_path / "q"), str(tmp_path / "a"), rejects_target=str(tmp_path / "r")
        )
    assert names(tmp_path) == []


def test_a_failure_at_the_rejects_leaves_no_set(spark, posts, tmp_path, monkeypatch):
    monkeypatch.setattr(jobs, "rejects_of", lambda rows, entity: failing(rows.withColumn("id", F.lit(1).cast("long"))))
    with pytest.raises(PySparkException, match="planted"):
        jobs.badges_to_csv(spark, posts, str(tmp_path / "b"), rejects_target=str(tmp_path / "r"))
    assert names(tmp_path) == []


@pytest.mark.parametrize("replace", [True, False])
@pytest.mark.parametrize("failed", range(4))
def test_a_failed_rename_takes_the_others_back(spark, tmp_path, monkeypatch, replace, failed):
    targets = [str(tmp_path / name) for name in ("one", "two")]
    renames = 2 if not replace else 4
    if replace:
        for target in targets:
            write_set(spark.range(3).toDF("id"), target)
    plain, done = staging._rename, []

    def rename(*args):
        done.append(args)
        if len(done) == failed + 1:
            raise OSError("planted")
        plain(*args)

    monkeypatch.setattr(staging, "_rename", rename)

    def write():
        with committed(spark, targets, replace) as places:
            for place in places:
                spark.range(5).toDF("id").write.option("header", True).csv(place)

    if failed >= renames:
        write()
    else:
        with pytest.raises(OSError, match="planted"):
            write()
    complete = failed >= renames
    assert names(tmp_path) == (["one", "two"] if complete or replace else [])
    if replace:
        assert read(spark, targets[0]) == read(spark, targets[1]) == list(range(5 if complete else 3))


def test_a_result_that_fails_leaves_the_former_one(spark, tmp_path):
    target = str(tmp_path / "result")
    write_result(spark.range(4).toDF("id"), target)
    late = spark.range(0, 100, 1, 4).select(
        F.when(F.col("id") > 90, F.raise_error(F.lit("planted")).cast("long")).otherwise(F.col("id")).alias("id")
    )
    with pytest.raises(PySparkException, match="planted"):
        write_result(late, target)
    assert read(spark, target) == [0, 1, 2, 3] and names(tmp_path) == ["result"]
    write_result(spark.range(2).toDF("id"), target)
    assert read(spark, target) == [0, 1] and names(tmp_path) == ["result"]


def test_a_result_can_replace_what_it_is_made_of(spark, tmp_path):
    target = str(tmp_path / "result")
    write_result(spark.range(4).toDF("id"), target)
    again = spark.read.option("header", True).schema("id long").csv(target)
    write_result(again.union(again), target)
    assert read(spark, target) == [0, 0, 1, 1, 2, 2, 3, 3]


def test_a_swap_that_was_cut_short_is_put_back_first(spark, tmp_path):
    target = str(tmp_path / "result [1]")
    write_result(spark.range(4).toDF("id"), target)
    os.rename(target, tmp_path / "_former-result [1]-0")
    os.rename(tmp_path / "_former-result [1]-0", tmp_path / "_former-result [1]-1")
    with pytest.raises(PySparkException, match="planted"):
        write_result(failing(spark.range(1).toDF("id")), target)
    assert names(tmp_path) == ["result [1]"]
    assert read(spark, target.replace("[", "\\[").replace("]", "\\]")) == [0, 1, 2, 3]


KILLED = """
import sys, time
sys.path.insert(0, sys.argv[1])
from pyspark.sql import SparkSession
from qadump.sources.sets import write_result
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()

marker = sys.argv[3]

def slow(batches):
    for batch in batches:
        yield batch
        open(marker, "w").close()
        time.sleep(300)

write_result(spark.range(0, 100_000, 1, 2).toDF("id").mapInArrow(slow, "id long"), sys.argv[2])
"""


def test_a_job_killed_while_it_writes_leaves_the_former_result(spark, tmp_path):
    target, marker = str(tmp_path / "result"), tmp_path / "marker"
    write_result(spark.range(4).toDF("id"), target)
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    job = subprocess.Popen(
        [sys.executable, "-c", KILLED, root, target, str(marker)], stdout=subprocess.DEVNULL, stderr=subprocess.DEVNULL
    )
    try:
        for _ in range(600):
            if marker.exists() or job.poll() is not None:
                break
            time.sleep(0.2)
        assert marker.exists()
    finally:
        job.kill()
        job.wait()
    assert read(spark, target) == [0, 1, 2, 3]
    assert glob.glob(f"{tmp_path}/_staging-result-*")
    write_result(spark.range(2).toDF("id"), target)
    assert read(spark, target) == [0, 1]


def test_targets_of_one_job_must_lie_apart(spark, posts, tmp_path):
    for second in ("q", "q/", "q/a"):
        with pytest.raises(ValueError, match="same or lie in each other"):
            jobs.posts_to_csv(spark, posts, str(tmp_path / "q"), str(tmp_path / second))
    jobs.posts_to_csv(spark, posts, str(tmp_path / "q"), str(tmp_path / "q2"))
    assert [r.id for r in read_set(spark, "answers", str(tmp_path / "q2")).collect()] == [2]


def test_a_combine_that_fails_leaves_the_former_table(spark, posts, lines_of, tmp_path):
    sets = {name: str(tmp_path / name) for name in ("users", "badges", "comments", "answers", "questions")}
    jobs.users_to_csv(spark, lines_of('<row Id="3" Reputation="5" />'), sets["users"])
    jobs.badges_to_csv(spark, lines_of('<row UserId="3" />'), sets["badges"])
    jobs.comments_to_csv(spark, lines_of('<row UserId="3" />'), sets["comments"])
    jobs.posts_to_csv(spark, posts, sets["questions"], sets["answers"])
    target = str(tmp_path / "master")
    jobs.combine_from_csv(spark, **sets, target=target)
    before = [tuple(r) for r in read_set(spark, "master", target).collect()]
    with pytest.raises(Exception, match="(?i)header|column"):
        jobs.combine_from_csv(spark, **sets, target=target, header=False)
    assert [tuple(r) for r in read_set(spark, "master", target).collect()] == before and len(before) == 1
    assert names(tmp_path) == sorted([*sets, "master"])
