"""Time the queries over a staged text dump; print one JSON line.

The dump is rendered from the tables of $BENCH_SF_DIR once, before the clock
starts, so the times are those of scanning, parsing and combining dump files.
Each query runs twice, writing to nowhere; the better time counts.
"""

from __future__ import annotations

import json
import os
import time
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession

from fixtures import render
from fixtures.shared import shared_folder
from qadump.operators import counts, entities, records, summaries
from qadump.plans import jobs, master
from qadump.schemas import BADGES, COMMENTS, POST_HISTORY, POST_LINKS, POSTS, USERS
from qadump.sources.dump import read_lines
from qadump.sources.sets import read_set

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = 2


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("qadump bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def queries(spark: SparkSession, dump: dict) -> dict:
    def lines(entity) -> DataFrame:
        return read_lines(spark, dump[entity])

    def roundtrip() -> DataFrame:
        root = shared_folder(spark, "bench-sets")
        names = ("users", "badges", "comments", "answers", "questions")
        sets = {name: f"{root}/{name}" for name in names}
        jobs.users_to_csv(spark, dump[USERS], sets["users"])
        jobs.badges_to_csv(spark, dump[BADGES], sets["badges"])
        jobs.comments_to_csv(spark, dump[COMMENTS], sets["comments"])
        jobs.posts_to_csv(spark, dump[POSTS], sets["questions"], sets["answers"])
        jobs.combine_from_csv(spark, **sets, target=f"{root}/master")
        return read_set(spark, "master", f"{root}/master")

    def set_of(name: str, job, entity):
        target = shared_folder(spark, f"bench-{name}")
        job(spark, dump[entity], target)
        return read_set(spark, name, target)

    def observed():
        found = []
        for entity in dump:
            counted = Observation()
            rows = records.records(lines(entity), entity, counted=counted)
            rows.write.format("noop").mode("overwrite").save()
            found.append((entity.name, counted.get["rows"], counted.get["rejects"]))
        return spark.createDataFrame(found, "entity string, rows bigint, rejects bigint")

    return {
        "dump_scan": lambda: records.records(lines(POSTS), POSTS),
        "dump_rejects": lambda: records.rejects(lines(POSTS), POSTS),
        "ingest_counters": lambda: reduce(
            DataFrame.union, [records.counters(lines(entity), entity) for entity in dump]
        ),
        "observed_counters": observed,
        "users_profile": lambda: entities.users(lines(USERS)),
        "questions": lambda: entities.questions(lines(POSTS)),
        "answers": lambda: entities.answers(lines(POSTS)),
        "badge_counts": lambda: counts.badge_counts(lines(BADGES)),
        "comment_counts": lambda: counts.comment_counts(lines(COMMENTS)),
        "link_counts": lambda: counts.link_counts(lines(POST_LINKS)),
        "history_counts": lambda: counts.history_counts(lines(POST_HISTORY)),
        "answer_summary": lambda: summaries.answer_summary(entities.answers(lines(POSTS))),
        "question_summary": lambda: summaries.question_summary(entities.questions(lines(POSTS))),
        "user_master": lambda: master.user_master_from_dump(
            lines(USERS), lines(POSTS), lines(BADGES), lines(COMMENTS)
        ),
        "csv_roundtrip": roundtrip,
        "questions_roundtrip": lambda: set_of("questions", jobs.questions_to_csv, POSTS),
        "answers_roundtrip": lambda: set_of("answers", jobs.answers_to_csv, POSTS),
        "links_roundtrip": lambda: set_of("postlinks", jobs.postlinks_to_csv, POST_LINKS),
        "history_roundtrip": lambda: set_of("posthistory", jobs.posthistory_to_csv, POST_HISTORY),
    }


def timed(query) -> float:
    start = time.perf_counter()
    query().write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    spark = session()
    dump = render.write_dump(spark, SF_DIR, shared_folder(spark, "bench-dump"))
    times = {
        name: round(min(timed(query) for _ in range(RUNS)), 3)
        for name, query in queries(spark, dump).items()
    }
    print(
        json.dumps(
            {
                "metric": "total time of all queries over a staged dump, better of two runs each",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
                "cpus": CPUS,
            }
        )
    )


if __name__ == "__main__":
    main()
