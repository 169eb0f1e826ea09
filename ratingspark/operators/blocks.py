"""Two-sided rating blocks: a layout in which steps move factors, not ratings.

Ratings are written once as a table bucketed by a block number, which is
(user block, item block) of a grid.  A user's factors are needed in the blocks
that hold the user's ratings, so a table of routes lists them, bucketed by the
user; items likewise.  A step then sends each factor row along its routes and
joins it within the block.  Neither the ratings nor the routes are shuffled:
what moves is at most (rows of a side) x (blocks of a row of the grid).

An id with more ratings than a block should hold gets several salts, drawn by
the hash of the rest of the row, so its ratings spread over more blocks of the grid.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import delete_folder, fits_broadcast, scratch_folder

#: Pairs of a rating and a model that a block holds, about; most blocks of a table, a limit of Spark.
BLOCK_ROWS = 250_000
MAX_BUCKETS = 100_000
#: Ratings up to which a grid is as fine as asked; beyond, a side of it has this many strips, or as many as the
#: cluster's cores or the bytes of a strip's factors ask for: each strip is a copy of the other side's factors.
FEW_ROWS, STRIPS, STRIP_BYTES = 1_000_000, 4, 384 << 20
#: Spark's setting that lets a join keep a partitioning by some of its keys.
CO_PARTITION = "spark.sql.requireAllClusterKeysForCoPartition"


@contextmanager
def partial_keys(spark: SparkSession) -> Iterator[None]:
    """Joins on (block, id) keep the partitioning by block while this is open."""
    before = spark.conf.get(CO_PARTITION, "true")
    spark.conf.set(CO_PARTITION, "false")
    try:
        yield
    finally:
        spark.conf.set(CO_PARTITION, before)


@dataclass
class RatingBlocks:
    """Bucketed tables of ratings (``block, user, item, rating, fold``) and routes (``block, id``)."""

    spark: SparkSession
    folder: str
    name: str
    buckets: int
    grid: int

    def table(self, part: str) -> DataFrame:
        return self.spark.table(f"{self.name}_{part}")

    @property
    def ratings(self) -> DataFrame:
        return self.table("ratings")

    def routed(self, factors: DataFrame, side: str) -> DataFrame:
        """Factor rows once for each block that holds ratings of their id."""
        return factors.join(self.table(side), "id")

    def write(self, df: DataFrame, part: str, by: str) -> None:
        (df.repartition(self.buckets, by).write.bucketBy(self.buckets, by)
         .option("path", f"{self.folder}/{part}").saveAsTable(f"{self.name}_{part}"))

    def drop(self) -> None:
        """Forgets the tables and deletes their files."""
        for part in ("ratings", "user", "item"):
            self.spark.sql(f"DROP TABLE IF EXISTS {self.name}_{part}")
        delete_folder(self.spark, self.folder)


def _salts(ratings: DataFrame, col: str, heavy: int) -> DataFrame:
    """``(col, salts)`` of ids with more than ``heavy`` ratings: at most rows / heavy ids."""
    counts = ratings.groupBy(col).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > heavy)
    return counts.select(col, F.ceil(F.col("n") / heavy).cast("int").alias("salts"))


def _place(own: str, other: str, salts: str, grid: int) -> Column:
    salt = F.pmod(F.xxhash64(other, "rating", "fold"), F.coalesce(F.col(salts), F.lit(1)))
    return F.pmod(F.xxhash64(own, salt), F.lit(grid)).cast("int")


def strips(cores: int, factor_bytes: int) -> int:
    """Strips on a side of the grid of a large table."""
    return max(STRIPS, math.ceil(math.sqrt(cores)), math.ceil(factor_bytes / STRIP_BYTES))


def _labels(spark: SparkSession, buckets: int) -> list[int]:
    """A block number for each bucket: numbers that Spark's hash puts one into each."""
    numbers = spark.range(buckets * 40).select(F.col("id").cast("int").alias("n"))
    first = numbers.groupBy(F.pmod(F.hash("n"), F.lit(buckets)).alias("b")).agg(F.min("n").alias("n"))
    return sorted(r["n"] for r in first.collect())  # a number for each bucket


def write_blocks(ratings: DataFrame, block_rows: int = BLOCK_ROWS, factor_bytes: int = 0) -> RatingBlocks:
    """Writes ``ratings(user, item, rating, fold)`` as blocks of about ``block_rows`` rows, or more.

    The number of buckets follows from the counted rows; more than ``FEW_ROWS`` are
    cut by ``strips``, as a finer grid sends more copies of the factors
    (``factor_bytes``: those of the larger side).  Nulls are an id of
    their own here; joins drop them.  No ratings give one empty bucket.
    """
    spark = ratings.sparkSession
    rows = ratings.count()
    buckets = min(MAX_BUCKETS, max(1, math.ceil(rows / block_rows)))
    grid = math.ceil(math.sqrt(4 * buckets)) if buckets > 1 else 1
    labels = None
    if rows > FEW_ROWS and grid > strips(spark.sparkContext.defaultParallelism, factor_bytes):
        grid = strips(spark.sparkContext.defaultParallelism, factor_bytes)
        labels = _labels(spark, grid * grid)
        buckets = grid * grid
    blocks = RatingBlocks(spark, scratch_folder(spark, "blocks"), f"ratingspark_{uuid.uuid4().hex}", buckets, grid)
    placed = ratings
    heavy = max(1, rows // (grid * grid))
    for col in ("user", "item"):
        salts = _salts(ratings, col, heavy).withColumnRenamed("salts", f"{col}_salts")
        bounded = fits_broadcast(spark, grid * grid, 64)  # no more ids can be that heavy
        placed = placed.join(F.broadcast(salts) if bounded else salts, col, "left")
    block = _place("user", "item", "user_salts", grid) * grid + _place("item", "user", "item_salts", grid)
    if labels and len(labels) == buckets:
        block = F.element_at(F.array(*[F.lit(n) for n in labels]), block + 1)
    blocks.write(placed.select(block.alias("block"), *ratings.columns), "ratings", "block")
    for side in ("user", "item"):
        routes = blocks.ratings.where(F.col(side).isNotNull()).select("block", F.col(side).alias("id")).distinct()
        blocks.write(routes, side, "id")
    return blocks
