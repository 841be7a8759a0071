"""What the operators of this subpackage share: words, held-out rows, staged tables."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from qadump.sources.staging import delete_folder

#: A word: a run of anything but ASCII white space. The same text for Java's and Python's patterns.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]"
_BLANK = re.compile(SPACE)
#: Characters of a very long text that are taken apart at a time.
BLOCK = 1_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new path below `spark.checkpoint.dir`, which all executors share.

    Only a local session may leave that setting out, as tests do.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
        root = tempfile.mkdtemp(prefix="qadump-llm-")
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def staged(df: DataFrame, purpose: str) -> DataFrame:
    """The same rows, written as a table in the shared folder and read back.

    Cuts the lineage: what follows survives lost executors without recomputing `df`. The
    folder stays, as results are lazy; `used_up` deletes it where nothing later reads it.
    """
    path = shared_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def used_up(table: DataFrame) -> None:
    """Delete the folder of a staged table that no later plan reads."""
    files = table.inputFiles()
    if files:
        delete_folder(table.sparkSession, files[0].rpartition("/")[0])


def bucket_of(doc_id: str | Column, buckets: int) -> Column:
    """crc32 of the id as text, modulo `buckets`; -1 for a null id, which is never held out."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(column.cast("string")) % buckets, F.lit(-1))


def draw(purpose: str) -> Column:
    """A number from 0 to 1 (excluded) for sampling, one for each row.

    Of the row's place in the table, not of its columns: however many rows share an id or text, a
    sample holds the share it should. Stage the sample, as another plan may number rows otherwise.
    """
    return F.pmod(F.xxhash64(F.lit(purpose), F.monotonically_increasing_id()), F.lit(1 << 30)) / (1 << 30)


def word_count(text: str | Column) -> Column:
    """Number of words; 0 for null."""
    column = F.col(text) if isinstance(text, str) else text
    return F.coalesce(F.regexp_count(column, F.lit(WORD)), F.lit(0)).cast("long")


def fresh(name: str, taken: list[str]) -> str:
    """`name`, with underscores in front until no column of `taken` has it (case aside)."""
    used = {column.lower() for column in taken}
    while name.lower() in used:
        name = f"_{name}"
    return name


def small_batches(
    batches: Iterator[pa.RecordBatch], text: str = "text", most_bytes: int = 4_000_000
) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches into runs of rows whose texts hold about `most_bytes` together.

    Rows stay whole and in order, so a task's memory follows its longest text, not its batch size.
    """
    for batch in batches:
        if batch.num_rows == 0:
            continue
        column = batch.column(batch.schema.get_field_index(text))
        sizes = pa.compute.fill_null(pa.compute.binary_length(column), 0).to_pylist()
        start = held = 0
        for row, size in enumerate(sizes):
            if held and held + size > most_bytes:
                yield batch.slice(start, row - start)
                start, held = row, 0
            held += size
        yield batch.slice(start)


def small(df: DataFrame, most: int = 20_000) -> DataFrame:
    """Sent to all executors if it has `most` rows or fewer; else left to a shuffle join."""
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df


def blocks(text: str, most: int | None = None) -> Iterator[str]:
    """The text in runs of about `most` characters, each but the first starting with a blank.

    No word crosses two runs, so work on the words of a very long text needs memory for one run's.
    """
    most, start = most or BLOCK, 0
    while len(text) - start > most and (seam := _BLANK.search(text, start + most)):
        yield text[start : seam.start()]
        start = seam.start()
    yield text[start:]


def importable(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver did.

    Only matters where that folder is neither installed nor in the workers' PYTHONPATH.
    """
    root = str(Path(__file__).resolve().parents[2])
    environment = spark.sparkContext.environment
    paths = environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])
