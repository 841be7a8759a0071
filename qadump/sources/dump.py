"""Dump files as DataFrames of lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_lines(spark: SparkSession, source: str | list[str] | DataFrame) -> DataFrame:
    """Lines of dump files or folders, column `value`. Big files are split between tasks.

    Lines that are a DataFrame already are taken as they are.
    """
    return source if isinstance(source, DataFrame) else spark.read.text(source)
