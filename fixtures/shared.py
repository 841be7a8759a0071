"""Folder for tables that one job writes and another stage reads back."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new path below `spark.checkpoint.dir`.

    Only a local session may leave that setting out; on a cluster a folder of
    one machine would be unreadable for the other executors.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
        root = tempfile.mkdtemp(prefix="qadump-")
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
