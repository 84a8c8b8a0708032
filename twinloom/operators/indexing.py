"""Dense positions of values, written once."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from twinloom.functions.draws import bigint, int_div

ROWS_PER_BUCKET = 500_000
#: Buckets whose starts are summed together; one number for each such group reaches the driver.
BUCKETS_PER_GROUP = 1_000
#: Tiles of a weighted index, or as many as it has distinct values if these are more.
TILES = 1_000
TILES_PER_PIECE = 1_000


@dataclass(frozen=True)
class DenseIndex:
    """Values by position, 0..count-1.

    In a weighted index a row of ``spans`` stands for ``n`` positions, which are never written out for a
    lookup: it goes by tiles of ``tile`` positions, each listing the spans that reach into it. There are at
    least as many tiles as spans, so a position is compared with two spans on average, and a value that has most
    positions is spread over many tiles.
    """

    spans: DataFrame  # columns: position, value; if weighted, also n
    count: int
    tile: int = 0

    @property
    def rows(self) -> DataFrame:
        """Each position and its value."""
        if not self.tile:
            return self.spans.select("position", "value")
        more = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("n") - 1))
        return self.spans.select("position", "value", more.alias("more")).select((F.col("position") + F.col("more")).alias("position"), "value")

    def look_up(self, frame: DataFrame, key: str, name: str) -> DataFrame:
        """``frame`` with the value at position ``key`` as ``name`` in place of the key; NULL where there is none."""
        if not self.tile:
            pool = self.spans.select(F.col("position").alias(key), F.col("value").alias(name))
            return frame.join(pool, key, "left").drop(key)
        at = F.col(key)  # negative positions match nothing and stay apart
        frame = frame.withColumn("__tile", F.when(at < 0, at).otherwise(int_div(at, self.tile)))
        pool = self._tiles().withColumnRenamed("value", name)
        same = (F.col("__tile") == F.col("__of")) & (at >= F.col("__from")) & (at < F.col("__to"))
        return frame.join(pool, same, "left").drop(key, "__tile", "__of", "__from", "__to")

    def _tiles(self) -> DataFrame:
        """The spans that reach into each tile; spans over very many tiles are cut and dealt over tasks before."""
        spans = self.spans.select(F.col("position").alias("__from"), (F.col("position") + F.col("n")).alias("__to"), "value")
        first, last = int_div(F.col("__from"), self.tile), int_div(F.col("__to") - 1, self.tile)
        long = last - first >= TILES_PER_PIECE
        starts = F.explode(F.sequence(first, last, bigint(TILES_PER_PIECE))).alias("__of")
        pieces = spans.where(long).select("*", starts).repartition("__of")
        most = F.least(last, F.col("__of") + (TILES_PER_PIECE - 1))
        pieces = pieces.withColumn("__of", F.explode(F.sequence("__of", most)))
        return spans.where(~long).select("*", F.explode(F.sequence(first, last)).alias("__of")).unionByName(pieces)


def dense_index(values: DataFrame, at_most: int, seed_key: int, folder: str, weighted: bool = False) -> DenseIndex:
    """Number the non-null values of the single column of ``values``, each distinct one once.

    ``weighted`` gives a value as many positions, one after the other, as it has rows. The
    values are evaluated and shuffled once: batches are thinned to distinct values before, so a
    value that fills a third of the rows travels as a few, and the hash buckets of about
    ``ROWS_PER_BUCKET`` distinct values that they travel by are also the groups in which they
    are combined and numbered. The result is written to ``folder``. The starts of the buckets are running
    sums within groups of buckets, to which the sums of the groups before are added. The order depends
    on the values only.
    """
    name = values.columns[0]
    kind = values.schema[0].dataType.simpleString()
    buckets = max(1, -(-at_most // ROWS_PER_BUCKET))
    thinned = values.select(F.col(name).alias("value")).mapInArrow(_counted, f"value {kind}, n bigint")
    hashed = F.xxhash64(bigint(seed_key), F.col("value"))
    dealt = thinned.select(F.pmod(hashed, bigint(buckets)).alias("bucket"), hashed.alias("h"), "value", "n").repartition("bucket")
    total = F.sum("n") if weighted else F.lit(1).cast("bigint")
    combined = dealt.groupBy("bucket", "h", "value").agg(total.alias("n"))
    earlier = Window.partitionBy("bucket").orderBy("h", "value").rowsBetween(Window.unboundedPreceding, -1)
    place = F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("place")
    combined.select("bucket", place, "n", "value").write.parquet(folder)
    spark = values.sparkSession
    numbered = spark.read.schema(f"bucket bigint, place bigint, n bigint, value {kind}").parquet(folder)
    sizes = numbered.groupBy("bucket").agg(F.sum("n").alias("n"), F.count("*").alias("spans"))
    starts, count, spans = _starts(sizes)
    rows = numbered.join(F.broadcast(starts) if buckets <= ROWS_PER_BUCKET else starts, "bucket")
    position = (F.col("start") + F.col("place")).alias("position")
    if not weighted:
        return DenseIndex(rows.select(position, "value"), count)
    return DenseIndex(rows.select(position, "n", "value"), count, max(1, -(-count // max(TILES, spans))))


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = pc.value_counts(batch.column(0).drop_null())
        yield pa.RecordBatch.from_arrays(found.flatten(), ["value", "n"])


def _starts(sizes: DataFrame) -> tuple[DataFrame, int, int]:
    """Where each bucket starts, the sum of all sizes, and how many spans there are."""
    sizes = sizes.withColumn("part", int_div(F.col("bucket"), BUCKETS_PER_GROUP))
    sums = sizes.groupBy("part").agg(F.sum("n"), F.sum("spans")).collect()
    before, reached, spans = [], 0, 0
    for part, n, own in sorted(sums):
        before += [F.lit(part), bigint(reached)]
        reached, spans = reached + n, spans + own
    if not before:
        return sizes.select("bucket", F.col("n").alias("start")), 0, 0
    earlier = Window.partitionBy("part").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum("n").over(earlier), F.lit(0)) + F.get(F.array(*before[1::2]), _rank_of(before[::2]))
    return sizes.select("bucket", start.alias("start")), reached, spans


def _rank_of(parts: list) -> Column:
    """The place of the row's part among the parts that occur."""
    return (F.array_position(F.array(*parts), F.col("part")) - 1).cast("int")
