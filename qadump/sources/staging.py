"""Folders that a job writes beside its targets: tables to read back, and results not yet complete.

The names start with an underscore, so reading the parent folder passes them over. A job that is
killed leaves them behind; they may be deleted once no job writes to the same target.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession


def _beside(target: str, purpose: str) -> str:
    parent, slash, name = target.rstrip("/").rpartition("/")
    return f"{parent}{slash}_{purpose}-{name}-{uuid.uuid4().hex}"


@contextmanager
def staging_beside(spark: SparkSession, target: str) -> Iterator[str]:
    """A new path beside `target`, on the same file system; deleted at the end, also after an error."""
    path = _beside(target, "staging")
    try:
        yield path
    finally:
        delete_folder(spark, path)


@contextmanager
def committed(spark: SparkSession, targets: Sequence[str], replace: bool = False) -> Iterator[list[str]]:
    """New paths beside the targets, which become the targets together at the end, by renaming.

    After an error in the block, or in one of the renames, every target is what it was before.
    Without `replace` an existing target is an error at once, before the block; with it the former
    result stays readable until the new one is complete. A job killed between the two renames of a swap
    leaves the former result beside its target, and the next commit to that target puts it back
    first. One killed between the renames of several targets leaves those it came to, complete, and the others,
    complete too, in their `_staging-` folders. Jobs that write to one target at the same time are not kept apart. Renames
    move no data on HDFS and local disks; object stores may copy.
    """
    names = sorted(_qualified(spark, target).rstrip("/") + "/" for target in targets)
    for first, second in zip(names, names[1:], strict=False):
        if second.startswith(first):
            raise ValueError(f"two targets of one job are the same or lie in each other: {first} {second}")
    for target in targets:
        _put_back(spark, target)
        if not replace and exists(spark, target):
            raise AnalysisException(f"[PATH_ALREADY_EXISTS] Path {target} already exists.")
    places = [_beside(target, "staging") for target in targets]
    moves: list[tuple[str, str]] = []

    def move(source: str, destination: str) -> None:
        _rename(spark, source, destination)
        moves.append((source, destination))

    former = []
    try:
        yield places
        try:
            for place, target in zip(places, targets, strict=True):
                if replace and exists(spark, target):
                    former.append(_beside(target, "former"))
                    move(target, former[-1])
                move(place, target)
        except BaseException:
            for source, destination in reversed(moves):
                _rename(spark, destination, source)
            raise
        for path in former:
            delete_folder(spark, path)
    finally:
        for place in places:
            delete_folder(spark, place)


def _put_back(spark: SparkSession, target: str) -> None:
    """Where a swap was cut short, the latest former result becomes the target again."""
    target_path = _path(spark, target)
    parent, files = target_path.getParent(), _files(spark, target_path)
    if files.exists(target_path) or not files.exists(parent):
        return
    prefix = f"_former-{target_path.getName()}-"
    found = [status for status in files.listStatus(parent) if status.getPath().getName().startswith(prefix)]
    left = sorted((status.getModificationTime(), status.getPath().toString()) for status in found)
    if left:
        _rename(spark, left[-1][1], target)


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _files(spark: SparkSession, hadoop_path):
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())


def _qualified(spark: SparkSession, path: str) -> str:
    hadoop_path = _path(spark, path)
    return _files(spark, hadoop_path).makeQualified(hadoop_path).toString()


def exists(spark: SparkSession, path: str) -> bool:
    hadoop_path = _path(spark, path)
    return _files(spark, hadoop_path).exists(hadoop_path)


def _rename(spark: SparkSession, source: str, destination: str) -> None:
    # A rename onto an existing folder would move into it.
    source_path, destination_path = _path(spark, source), _path(spark, destination)
    files = _files(spark, source_path)
    if files.exists(destination_path) or not files.rename(source_path, destination_path):
        raise OSError(f"could not rename {source} to {destination}")


def delete_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder on any file system that Spark writes to; a missing one is no error."""
    hadoop_path = _path(spark, path)
    _files(spark, hadoop_path).delete(hadoop_path, True)
