"""Folders of any file system that the session can reach."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import SparkSession


def _located(spark: SparkSession, uri: str):
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(uri)
    return path, path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, uri: str) -> bool:
    path, system = _located(spark, uri)
    return system.exists(path)


def delete_folder(spark: SparkSession, uri: str) -> None:
    path, system = _located(spark, uri)
    system.delete(path, True)


def names(spark: SparkSession, uri: str) -> list[str]:
    """Names of what a folder holds, in order; none if there is no such folder."""
    path, system = _located(spark, uri)
    if not system.exists(path):
        return []
    return sorted(status.getPath().getName() for status in system.listStatus(path))


def create_file(spark: SparkSession, uri: str, content: bytes) -> bool:
    """Write a file unless one of that name exists; whether this call has made it.

    The content goes to a file beside it first, which then takes the name, so no reader sees half of
    a file. Of two writers at a time one succeeds: a local link fails if the name is taken, and so does
    a rename on HDFS. A store whose rename replaces files needs a lock of its own.
    """
    path, system = _located(spark, uri)
    if system.exists(path):
        return False
    beside = f"{path.getParent()}/.{path.getName()}.{uuid.uuid4().hex}"
    if system.getUri().getScheme() == "file":
        return _linked(path.toUri().getPath(), beside.removeprefix("file:"), content)
    beside = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(beside)
    out = system.create(beside, False)
    try:
        out.write(bytearray(content))
    finally:
        out.close()
    made = system.rename(beside, path)
    if not made:
        system.delete(beside, False)
    return made


def _linked(path: str, beside: str, content: bytes) -> bool:
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(beside, "wb") as out:
        out.write(content)
    try:
        os.link(beside, path)
    except FileExistsError:
        return False
    finally:
        os.unlink(beside)
    return True


def read_file(spark: SparkSession, uri: str) -> bytes:
    """The content of a small file."""
    path, system = _located(spark, uri)
    stream = system.open(path)
    try:
        return bytes(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(stream))
    finally:
        stream.close()
