"""Small helpers around the caller's Spark session."""

from __future__ import annotations

import re
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

_METHOD_LIMIT = "spark.sql.codegen.hugeMethodLimit"
_METHOD_LIMIT_DEFAULT = "65535"
_HOTSPOT_LIMIT = "8000"


@contextmanager
def session_conf(spark: SparkSession, settings: dict[str, str]):
    """Apply session settings for a block and put the previous ones back."""
    previous = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in previous.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def session_like(spark: SparkSession) -> SparkSession:
    """A new session of the same application with the settings of the given one, free to change its own."""
    session = spark.newSession()
    for name, value in spark.conf.getAll.items():
        if session.conf.get(name, None) != value and session.conf.isModifiable(name):
            session.conf.set(name, value)
    return session


def compile_small_methods(spark: SparkSession) -> None:
    """Let Spark leave whole-stage codegen where the JVM would not compile its method.

    HotSpot only interprets methods above 8000 bytes, which a wide generated table exceeds
    and which is ten times slower. Spark's limit defaults to 65535 and is meant to be set
    to 8000 on HotSpot. Generated frames are lazy, so this is the caller's choice for the
    session; a value chosen by the caller is kept.
    """
    if spark.conf.get(_METHOD_LIMIT) == _METHOD_LIMIT_DEFAULT:
        spark.conf.set(_METHOD_LIMIT, _HOTSPOT_LIMIT)


@contextmanager
def small_methods(spark: SparkSession):
    """The same for the actions inside the block only."""
    with session_conf(spark, {_METHOD_LIMIT: spark.conf.get(_METHOD_LIMIT)}):
        compile_small_methods(spark)
        yield


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder name under the cluster's shared checkpoint folder.

    A session that names none is refused, unless driver and executors are one process.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if base is None:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = tempfile.mkdtemp(prefix="twinloom-")
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
