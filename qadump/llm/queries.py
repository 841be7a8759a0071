"""The registered queries of this subpackage, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from qadump.llm import (
    ann,
    brown,
    chat,
    importance,
    language_id,
    mixing,
    packing,
    rules,
    sharding,
    simhash,
    toxicity,
    trie,
    url_filter,
)
from qadump.llm.common import importable, staged, table
from qadump.llm.oracle import ORACLE


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(table(spark, sf_dir, "documents"), folds=4, held=2)


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.groups(table(spark, sf_dir, "documents"), shingle=3, distance=3)
    return found.select("doc_id", simhash.hexadecimal("fp").alias("fingerprint"), "component_id")


def op3_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(table(spark, sf_dir, "embeddings"), query_step=100, k=10)


def op4_brown(spark: SparkSession, sf_dir: str) -> DataFrame:
    return brown.score_texts(table(spark, sf_dir, "documents"), folds=5, held=1)


def op7_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.format_conversations(table(spark, sf_dir, "conversations"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return toxicity.score_texts(docs, labels, folds=5, held=0)


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.assign(table(spark, sf_dir, "documents"), shards=24)
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), max_tokens=1024, with_ids=False)


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"), carried=["doc_id"])
    return mixed.select(
        F.col("row.doc_id").alias("doc_id"),
        "size",
        "source_size",
        "target",
        (F.col("copies") * F.col("size")).cast("long").alias("taken"),
    )


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    judged = staged(rules.measured(docs).drop("row"), "quality").withColumn("row", F.lit(None))
    learned = rules.learn(judged, table(spark, sf_dir, "labels"))
    return rules.verdicts(judged, learned).select("doc_id", *rules.COUNTS, "base_failed", "kept", "rule")


#: host, path and verdict, as the contract of the query gives them.
URL_RULES = (
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
)


def op11_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = url_filter.rule_table(spark, URL_RULES)
    found = url_filter.judged(table(spark, sf_dir, "pages"), rules, carried=["page_id"])
    return found.select("row.page_id", "host", "path", "rule", "verdict")


def op12_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resampled(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns, convs = trie.regrouped(trie.numbered(table(spark, sf_dir, "conversations")), group=5, most=8)
    return trie.prefix_trie(turns, convs)


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {
    "pipeline": pipeline,
    "op1_language_id": op1_language_id,
    "op2_simhash": op2_simhash,
    "op3_ann": op3_ann,
    "op4_brown": op4_brown,
    "op5_sharding": op5_sharding,
    "op6_packing": op6_packing,
    "op7_chat_format": op7_chat_format,
    "op8_toxicity": op8_toxicity,
    "op9_mixing": op9_mixing,
    "op10_quality_rules": op10_quality_rules,
    "op11_url_filter": op11_url_filter,
    "op12_importance": op12_importance,
    "op13_prefix_trie": op13_prefix_trie,
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def registered(query):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            importable(spark)
            return query(spark, sf_dir)

        return run

    return {name: registered(query) for name, query in QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
