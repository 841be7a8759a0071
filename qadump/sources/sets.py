"""Typed CSV sets: the tables handed from the extraction jobs to the combine job."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from qadump.schemas import SET_SCHEMAS
from qadump.sources.staging import committed

BAD_ROW = "bad_row"


def _parsed(spark: SparkSession, name: str, path: str, header: bool) -> DataFrame:
    """The rows of a set, with the text of those that do not convert in `bad_row`."""
    return (
        spark.read.schema(f"{SET_SCHEMAS[name]}, {BAD_ROW} string")
        .option("header", header)
        .option("enforceSchema", False)
        .option("columnNameOfCorruptRecord", BAD_ROW)
        .option("columnPruning", False)
        .csv(path)
    )


def read_set(spark: SparkSession, name: str, path: str, header: bool = True) -> DataFrame:
    """One CSV set with its fixed schema.

    `header` must say how the set was written: sets of this package have one, plain line
    sets (`key,count`) have none. A wrong flag is an error when rows are read: without the
    header that is expected Spark finds other column names, and a header that is not expected
    is found among the rows. Rows that do not convert are left out; `bad_rows` has them.
    """
    rows = _parsed(spark, name, path, header)
    columns = [column for column in rows.columns if column != BAD_ROW]
    titles = ",".join(columns)
    message = F.lit(f"{path}: the set has a header, but is read without one")
    good = F.when(F.col(BAD_ROW).isNull(), True).when(
        F.col(BAD_ROW) == titles, F.raise_error(message).cast("boolean")
    )
    return rows.where(F.coalesce(good, F.lit(False))).select(*columns)


def bad_rows(spark: SparkSession, name: str, path: str, header: bool = True) -> DataFrame:
    """The rows of a set that do not convert to its columns, as text."""
    rows = _parsed(spark, name, path, header)
    # Spark refuses a query of the faulty text alone; this condition holds for every row.
    any_value = F.coalesce(F.col(rows.columns[0]).cast("string"), F.lit("")) != "none"
    return rows.where(F.col(BAD_ROW).isNotNull() & any_value).select(BAD_ROW)


def write_files(df: DataFrame, path: str, header: bool = True) -> None:
    """The CSV files of a set in a new folder, which has some of them if the write fails."""
    df.write.mode("errorifexists").option("header", header).csv(path)


def write_set(df: DataFrame, path: str, header: bool = True) -> None:
    """Write one CSV set, all of it or nothing; an existing path is an error before any work."""
    with committed(df.sparkSession, [path]) as [place]:
        write_files(df, place, header)


def write_result(df: DataFrame, path: str, single_file: bool = False) -> None:
    """Write a result as CSV with header, replacing an earlier one once the new one is complete.

    `single_file` is for results known to be small, as one task writes the file.
    It repartitions instead of coalescing, so that only the write, not the work
    before it, runs as one task.
    """
    if single_file:
        df = df.repartition(1)
    with committed(df.sparkSession, [path], replace=True) as [place]:
        write_files(df, place)
