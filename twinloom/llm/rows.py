"""Written intermediate tables, stable row numbers, and joins whose broadcast is checked."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from twinloom.session import shared_folder

#: Keys that a broadcast may hold: about 64 MB of two numbers each.
BROADCAST_KEYS = 4_000_000


def written(frame: DataFrame, purpose: str) -> DataFrame:
    """The frame, computed once into the shared folder, so that a lost executor costs a read only."""
    folder = shared_folder(frame.sparkSession, purpose)
    frame.write.option("compression", "zstd").parquet(folder)
    return frame.sparkSession.read.schema(frame.schema).parquet(folder)


def numbered(docs: DataFrame, name: str = "_row") -> DataFrame:
    """A written copy with a number for each row, the same in every later read."""
    return written(docs.withColumn(name, F.monotonically_increasing_id()), "numbered")


def matching(frame: DataFrame, keys: DataFrame, on: list[str], how: str = "left_semi", limit: int = BROADCAST_KEYS) -> DataFrame:
    """Rows with (or without) a partner among written ``keys``, which are sent to all tasks only if few."""
    if keys.count() <= limit:
        keys = F.broadcast(keys)
    return frame.join(keys, on, how)
