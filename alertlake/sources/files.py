"""Small control files of a workspace, on any store that Hadoop's file systems reach (driver only)."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    fs, where = _at(spark, path)
    return fs.exists(where)


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder, sorted; none if there is no such folder."""
    fs, where = _at(spark, folder)
    if not fs.exists(where):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(where))


def read_text(spark: SparkSession, path: str) -> str:
    fs, where = _at(spark, path)
    stream = fs.open(where)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def create_once(spark: SparkSession, path: str, text: str) -> bool:
    """Create a file whole, unless there is one: False then.  Of several writers exactly one succeeds.

    The text goes to a file of its own first; taking the name is one step of the store: a link on a local
    disk, a rename that refuses an existing target elsewhere."""
    fs, where = _at(spark, path)
    if fs.exists(where):
        return False
    fs.mkdirs(where.getParent())
    draft = spark._jvm.org.apache.hadoop.fs.Path(where.getParent(), f".{where.getName()}.{uuid.uuid4().hex}")
    stream = fs.create(draft, True)
    stream.write(bytearray(text.encode("utf-8")))
    stream.close()
    try:
        if fs.getScheme() == "file":
            try:
                os.link(draft.toUri().getPath(), where.toUri().getPath())
            except FileExistsError:
                return False
            return True
        return fs.rename(draft, where)
    finally:
        fs.delete(draft, False)


def delete(spark: SparkSession, path: str) -> None:
    """Remove a file or folder that nothing refers to any more; nothing if it is not there."""
    fs, where = _at(spark, path)
    fs.delete(where, True)
