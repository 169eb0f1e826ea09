"""Helpers that several operators of this subpackage use."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import delete_folder, ensure_checkpoint_dir

#: ASCII space and the five control characters that count as space in texts.
SPACE = r"\x20\x09-\x0D"
WORD = f"[^{SPACE}]+"


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """Columns of one of the given tables."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet").select(*columns)


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder below the cluster's checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/ratingspark-{name}-{uuid.uuid4().hex}"


#: Settings while a table is written: the query's shuffle files are deleted when it has ended, and Python
#: workers get few texts at a time.  No result depends on them.
WRITING = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
           "spark.sql.execution.arrow.maxRecordsPerBatch": "1000"}


def written(df: DataFrame, folder: str, codec: str | None = None) -> DataFrame:
    """Write ``df`` once as Parquet and read it from there.

    This cuts the lineage: later stages, and retries after a lost executor,
    read the files.  The files' size is known, so joins with the result are
    broadcast only below ``spark.sql.autoBroadcastJoinThreshold``.  ``codec``:
    another compression than the session's, for tables of texts.
    """
    conf = df.sparkSession.conf
    before = {name: conf.get(name) for name in WRITING}
    try:
        for name, value in WRITING.items():
            conf.set(name, value)
        df.write.parquet(folder, compression=codec)
    finally:
        for name, value in before.items():
            conf.set(name, value)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def saved(df: DataFrame, name: str = "table") -> DataFrame:
    """``written`` to a new folder of the shared folder."""
    return written(df, shared_folder(df.sparkSession, name))


class Scratch:
    """Tables of an operator in one shared folder, deleted when they have been read."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.folder = spark, shared_folder(spark, name)
        self.held: list[tuple[DataFrame, str]] = []
        self.n = 0

    def write(self, df: DataFrame, name: str) -> DataFrame:
        self.n += 1
        folder = f"{self.folder}/{self.n}-{name}"
        out = written(df, folder)
        self.held.append((out, folder))
        return out

    def drop(self, *tables: DataFrame) -> None:
        """Deletes these tables; no frame that reads them is used any more."""
        for table in tables:
            for out, folder in self.held:
                if out is table:
                    delete_folder(self.spark, folder)
        self.held = [(out, folder) for out, folder in self.held if not any(out is table for table in tables)]

    def drop_all_but(self, *tables: DataFrame) -> None:
        self.drop(*[out for out, _ in self.held if not any(out is table for table in tables)])


#: Bytes of a table that may be sent to every executor.
BROADCAST_BYTES = 32 << 20


def small(df: DataFrame, row_bytes: int) -> bool:
    """Whether a written table of rows of ``row_bytes`` may be broadcast: its rows are counted."""
    return df.count() * row_bytes * 2 <= BROADCAST_BYTES


def slices(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """Arrow batches in parts, so that a worker holds few texts as Python strings."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def text_or_empty(column: str = "text"):
    """The text, null as the empty text."""
    return F.coalesce(F.col(column), F.lit(""))
