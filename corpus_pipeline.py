"""The corpus pipeline: documents in, packed training pieces out.

Each stage takes (spark, docs, sf_dir) and works on all rows that its predecessor kept. Rows
with nulls in any column pass through every stage: a null text has no words, so the quality
rules reject it. Extra columns of docs travel along, whatever their names. An empty table
gives an empty result. Very long texts are read whole, in blocks where an operator needs more than
counts. Ties are broken as each operator's module says. A repeated row is judged as a row of its own until near-dedup,
which keeps one of each group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from qadump.llm import mixing, packing, rules, simhash, toxicity
from qadump.llm.common import bucket_of, importable, shared_folder, staged, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base check and that no rule learned from the labels rejects."""
    # Measured once: staged with the rows, so that the rules learned from it choose among it.
    measured = staged(rules.measured(docs), "quality")
    return rules.kept_rows(measured, rules.learn(measured.drop("row"), table(spark, sf_dir, "labels")))


def toxic_removal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below one half."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    usable = bucket_of("doc_id", 5) != 0
    model = toxicity.train(rows, table(spark, sf_dir, "labels"), usable)
    scored = docs.select(F.struct("*").alias("row"), toxicity.score_column(spark, model, "text").alias("score"))
    return scored.where("score < 0.5").select("row.*")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: that of the smallest id."""
    return simhash.deduplicated(docs, shingle=3, distance=3)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's share of the mix gives it."""
    return mixing.repeated(mixing.mix(docs))


def token_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 1024 tokens, each with its ids and the bucket of its length."""
    return packing.pack(docs, max_tokens=1024)


STAGES = [
    ("quality_rules", quality_rules),
    ("toxicity", toxic_removal),
    ("simhash_near_dedup", near_dedup),
    ("mixing", source_mixing),
    ("packing", token_packing),
]

#: Learned rules, fingerprints and token ids are beyond SQL; tests/llm compares with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of sf_dir, each written as Parquet and read again.

    The packed pieces lie in one folder per bucket, so that a batch of equal lengths comes from one.
    """
    importable(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = shared_folder(spark, f"pipeline-{name}")
        kept = stage(spark, docs, sf_dir)
        if name == "packing":
            packing.write_buckets(kept, path)
        else:
            kept.write.parquet(path)
        docs = spark.read.schema(kept.schema).parquet(path)
    return docs
