"""The batch jobs on files."""

import glob
from types import SimpleNamespace

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException

from compare import rows_of
from fixtures import render
from qadump.operators import counts, entities
from qadump.plans import jobs
from qadump.plans.master import user_master_from_dump
from qadump.schemas import (
    BADGES,
    COMMENTS,
    MASTER_COLUMNS,
    POST_HISTORY,
    POST_LINKS,
    POSTS,
    USERS,
)
from qadump.sources.dump import read_lines
from qadump.sources.sets import bad_rows, read_set, write_result, write_set
from fixtures.shared import shared_folder

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def dump(spark, tmp_path_factory):
    return render.write_dump(spark, SF_DIR, str(tmp_path_factory.mktemp("dump")))


JOBS = {
    "users": (jobs.users_to_csv, USERS, entities.users),
    "questions": (jobs.questions_to_csv, POSTS, entities.questions),
    "answers": (jobs.answers_to_csv, POSTS, entities.answers),
    "badges": (jobs.badges_to_csv, BADGES, counts.badge_counts),
    "comments": (jobs.comments_to_csv, COMMENTS, counts.comment_counts),
    "postlinks": (jobs.postlinks_to_csv, POST_LINKS, counts.link_counts),
    "posthistory": (jobs.posthistory_to_csv, POST_HISTORY, counts.history_counts),
}


@pytest.mark.parametrize("name", JOBS)
def test_set_reads_back_as_written(spark, dump, tmp_path, name):
    job, entity, table = JOBS[name]
    lines = read_lines(spark, dump[entity])
    found = job(spark, dump[entity], str(tmp_path / name))
    assert found == {entity.name: lines.count() - 3, f"{entity.name}_rejects": 0}
    again = read_set(spark, name, str(tmp_path / name))
    expected = table(lines)
    assert again.dtypes == expected.dtypes
    assert rows_of(again) == rows_of(expected)


def test_existing_set_is_not_overwritten(spark, dump, tmp_path):
    target = str(tmp_path / "badges")
    jobs.badges_to_csv(spark, dump[BADGES], target)
    with pytest.raises(AnalysisException, match="PATH_ALREADY_EXISTS"):
        jobs.badges_to_csv(spark, dump[BADGES], target)


def test_posts_in_one_pass_equal_the_two_jobs(spark, dump, tmp_path):
    paths = {n: str(tmp_path / n) for n in ("questions", "answers", "questions2", "answers2")}
    jobs.posts_to_csv(spark, dump[POSTS], paths["questions"], paths["answers"])
    jobs.questions_to_csv(spark, dump[POSTS], paths["questions2"])
    jobs.answers_to_csv(spark, dump[POSTS], paths["answers2"])
    for name in ("questions", "answers"):
        one, two = (read_set(spark, name, paths[name + end]) for end in ("", "2"))
        assert rows_of(one) == rows_of(two)


@pytest.mark.parametrize("header", [True, False])
@pytest.mark.parametrize("single_file", [True, False])
def test_combine(spark, dump, tmp_path, header, single_file):
    sets = {}
    for name in ("users", "questions", "answers", "badges", "comments"):
        _, entity, table = JOBS[name]
        sets[name] = str(tmp_path / name)
        write_set(table(read_lines(spark, dump[entity])), sets[name], header)
    target = str(tmp_path / "master")
    for _ in range(2):  # an earlier result is replaced
        jobs.combine_from_csv(
            spark, **sets, target=target, header=header, single_file=single_file
        )
    master = read_set(spark, "master", target)
    expected = user_master_from_dump(
        *(read_lines(spark, dump[e]) for e in (USERS, POSTS, BADGES, COMMENTS))
    )
    assert tuple(master.columns) == MASTER_COLUMNS
    assert master.dtypes == expected.dtypes
    assert rows_of(master) == rows_of(expected)
    files = glob.glob(f"{target}/part-*")
    assert len(files) == 1 if single_file else files
    assert open(files[0]).readline().strip().split(",") == list(MASTER_COLUMNS)


def test_line_sets_of_keys_and_counts(spark, tmp_path):
    # as a plain text job leaves them: no header, empty key for absent users
    path = tmp_path / "badges"
    path.mkdir()
    (path / "part-00000").write_text("3,2\n,5\nx,1\n9999999999,1\n4\n")
    found = rows_of(read_set(spark, "badges", str(path), header=False))
    assert found == {(2, 3): 1, (5, None): 1, (1, 9999999999): 1}
    assert {r.bad_row for r in bad_rows(spark, "badges", str(path), header=False).collect()} == {"x,1", "4"}


@pytest.mark.parametrize("header", [True, False])
def test_a_wrong_header_flag_is_an_error(spark, dump, tmp_path, header):
    sets = {}
    for name in ("users", "questions", "answers", "badges", "comments"):
        _, entity, table = JOBS[name]
        sets[name] = str(tmp_path / name)
        write_set(table(read_lines(spark, dump[entity])), sets[name], header)
    with pytest.raises((PySparkException, Py4JJavaError), match="header|FAILED_READ_FILE"):
        jobs.combine_from_csv(spark, **sets, target=str(tmp_path / "master"), header=not header)


EMPTY_SOURCES = {
    "envelope": (["<badges>", "</badges>"], 0),
    "empty file": ([], 0),
    "all faulty": (["<badges>", "x", "<row", "</badges>"], 2),
}


@pytest.mark.parametrize("adaptive", ["true", "false"])
@pytest.mark.parametrize("source", [*EMPTY_SOURCES, "empty folder"])
@pytest.mark.parametrize("name", [*JOBS, "posts"])
def test_sources_without_a_good_record(spark, settings, tmp_path, adaptive, source, name):
    settings(spark__sql__adaptive__enabled=adaptive)
    entity = POSTS if name == "posts" else JOBS[name][1]
    path = tmp_path / "dump"
    path.mkdir()
    lines, rejected = EMPTY_SOURCES.get(source, ([], 0))
    if source != "empty folder":
        text = "\n".join(line.replace("badges", entity.name) for line in lines)
        (path / "part.xml").write_text(text)
    out = tmp_path / "out"
    rejects_target = str(out / "rejects")
    if name == "posts":
        found = jobs.posts_to_csv(
            spark, str(path), str(out / "q"), str(out / "a"), rejects_target=rejects_target
        )
    else:
        found = JOBS[name][0](spark, str(path), str(out / "set"), rejects_target=rejects_target)
    assert found == {entity.name: 0, f"{entity.name}_rejects": rejected}
    assert spark.read.parquet(rejects_target).count() == rejected
    assert not [p for p in out.iterdir() if p.name.startswith("_staging")]


def test_nothing_staged_is_left_behind(spark, dump, tmp_path):
    jobs.badges_to_csv(spark, dump[BADGES], str(tmp_path / "one" / "badges"))
    with pytest.raises(AnalysisException):
        jobs.badges_to_csv(spark, dump[BADGES], str(tmp_path / "one" / "badges"))
    with pytest.raises(PySparkException):
        jobs.badges_to_csv(spark, spark.range(1).selectExpr("'x' as value"), str(tmp_path / "one" / "b"), "failfast")
    assert [p.name for p in (tmp_path / "one").iterdir()] == ["badges"]


def test_a_job_with_rejects_parses_its_dump_once(spark, lines_of, tmp_path):
    """Counted by an accumulator in the source: each line is read once."""
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    source = lines_of('<row UserId="1" />', "broken", '<row UserId="2" />').coalesce(1)
    jobs.badges_to_csv(
        spark, source.mapInArrow(count, "value string"), str(tmp_path / "b"), rejects_target=str(tmp_path / "r")
    )
    assert seen.value == 3


def test_sources_can_be_several_files(spark, tmp_path):
    paths = [str(tmp_path / f"{i}.xml") for i in range(2)]
    for path in paths:
        with open(path, "w") as file:
            file.write('<badges>\n<row UserId="1" />\n</badges>\n')
    assert jobs.badges_to_csv(spark, paths, str(tmp_path / "out"))["badges"] == 2


def test_rejects_are_written_on_request(spark, tmp_path):
    source = tmp_path / "Badges.xml"
    source.write_text('<badges>\n  <row UserId="1" />\n<row\nbroken\n</badges>\n')
    target = tmp_path / "rejects"
    found = jobs.badges_to_csv(
        spark, str(source), str(tmp_path / "out"), rejects_target=str(target)
    )
    assert found == {"badges": 1, "badges_rejects": 2}
    assert {r.line for r in spark.read.parquet(str(target)).collect()} == {"<row", "broken"}


@pytest.mark.parametrize("mode", ["permissive", "failfast"])
def test_posts_and_their_rejects_come_from_one_pass(spark, tmp_path, mode):
    good = ['<row Id="1" PostTypeId="1" />', '<row Id="2" PostTypeId="2" Score="3" />']
    bad = ["<row/>", "broken", '<row Id="3" PostTypeId="1" Body="&x" />']
    lines = spark.createDataFrame(
        [(line,) for line in good + (bad if mode == "permissive" else [])], "value string"
    )
    paths = [str(tmp_path / n) for n in ("questions", "answers", "rejects")]
    found = jobs.posts_to_csv(spark, lines, *paths[:2], mode, rejects_target=paths[2])
    assert [r.id for r in read_set(spark, "questions", paths[0]).collect()] == [1]
    assert [(r.id, r.score) for r in read_set(spark, "answers", paths[1]).collect()] == [(2, 3)]
    if mode == "permissive":
        assert found == {"posts": 2, "posts_rejects": 3}
        assert {r.line for r in spark.read.parquet(paths[2]).collect()} == set(bad)
    else:
        assert found == {"posts": 2, "posts_rejects": 0}


def test_failfast_job_fails_and_leaves_no_set(spark, tmp_path):
    lines = spark.createDataFrame([("<row/>",)], "value string")
    with pytest.raises(PySparkException, match="no_post_type"):
        jobs.posts_to_csv(spark, lines, str(tmp_path / "q"), str(tmp_path / "a"), "failfast")
    assert not (tmp_path / "q").exists()


def test_single_file_keeps_the_work_before_it_parallel(spark, tmp_path):
    write_result(spark.range(1000).repartition(8), str(tmp_path / "one"), single_file=True)
    assert len(glob.glob(f"{tmp_path}/one/part-*")) == 1


def session_with(**conf):
    options = {key.replace("__", "."): value for key, value in conf.items()}
    return SimpleNamespace(conf=SimpleNamespace(get=options.get))


def test_shared_folder_follows_the_session():
    cluster = session_with(spark__master="yarn", spark__checkpoint__dir="hdfs://name/shared/")
    first, second = (shared_folder(cluster, "stage") for _ in range(2))
    assert first.startswith("hdfs://name/shared/stage-")
    assert first != second


def test_shared_folder_is_never_local_on_a_cluster():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(session_with(spark__master="yarn"), "stage")
    assert shared_folder(session_with(spark__master="local[2]"), "stage")
