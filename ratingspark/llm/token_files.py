"""Token-ID files: flat unsigned integers, 64-bit document offsets, memory-mapped.

Documents are range-partitioned by ``doc_id`` (nulls first) and sorted within
partitions, so the shards in order hold the documents in ascending order.
Each task tokenizes its documents and streams three files into the folder:

* ``<shard>.bin``  token ids, little-endian, the narrowest of 16 or 32 bits
                   that holds the vocabulary
* ``<shard>.off``  unsigned 64-bit offsets within the shard, one per document
                   and a last one for the end
* ``<shard>.doc``  signed 64-bit document ids (the first ``n_null`` are null)

A manifest table has one row per shard: file stem, counts, and ``base``, the
number of ids in all shards before it (a prefix sum over the shards).  The
global start of a document is its shard's base plus its offset.

File names carry an id of the task attempt and the manifest names only files
of attempts that succeeded, so retried or speculative tasks do no harm.
Folders are addressed by URI: ``file:`` paths are memory-mapped, others
(``hdfs:``, ``s3:``, ``gs:``) are read by ranges.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import tokens
from .common import slices

_SHARD = "shard int, stem string, n_null long, n_docs long, n_tokens long, width int"
_DOCUMENT = "doc_id long, start long, n_tokens long, ids_crc32 long"
#: Token ids read at once from a store that cannot be memory-mapped.
_BLOCK_DOCS = 4096


def _store(folder: str) -> tuple[pafs.FileSystem, str]:
    store, path = pafs.FileSystem.from_uri(folder if ":" in folder else f"file://{folder}")
    return store, path.rstrip("/")


def write_token_files(docs: DataFrame, folder: str, tokenizer_path: str,
                      shards: int | None = None) -> DataFrame:
    """Tokenize ``docs(doc_id, text)`` into ``folder``; returns the manifest.

    Null texts are empty texts (their only id is the end id); null ``doc_id``
    come first; rows with equal ids are ordered by their texts, and equal rows
    are kept, each with its own span.  An empty table gives an empty manifest.
    Other columns are ignored.
    """
    spark = docs.sparkSession
    shards = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = TaskContext.get().partitionId()
        encoder = tokens.encoder(tokenizer_path)
        store, root = _store(folder)
        stem = f"tokens-{shard:08d}-{uuid.uuid4().hex}"
        n_null = n_docs = n_tokens = 0
        sinks = None
        for batch in slices(batches):
            if sinks is None:
                store.create_dir(root, recursive=True)
                sinks = [store.open_output_stream(f"{root}/{stem}.{x}") for x in ("bin", "off", "doc")]
            ids = encoder.documents(batch.column(1).to_pylist())
            lengths = np.array([len(x) for x in ids], np.uint64)
            for x in ids:
                sinks[0].write(x.tobytes())
            starts = np.cumsum(lengths) - lengths + np.uint64(n_tokens)
            sinks[1].write(starts.astype("<u8").tobytes())
            doc_ids = batch.column(0)
            n_null += doc_ids.null_count
            sinks[2].write(doc_ids.fill_null(0).to_numpy(zero_copy_only=False).astype("<i8").tobytes())
            n_docs += batch.num_rows
            n_tokens += int(lengths.sum())
        if sinks is not None:
            sinks[1].write(np.array([n_tokens], "<u8").tobytes())
            for sink in sinks:
                sink.close()
            yield pa.RecordBatch.from_pylist([dict(
                shard=shard, stem=stem, n_null=n_null, n_docs=n_docs, n_tokens=n_tokens,
                width=encoder.dtype.itemsize)], schema=_arrow(_SHARD))

    ordered = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
               .repartitionByRange(shards, F.col("doc_id").asc_nulls_first())
               .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), F.col("text").asc_nulls_first()))
    written = f"{folder}/shards"
    ordered.mapInArrow(write, _SHARD).write.parquet(written)
    # One row per shard: their prefix sum needs a single small task.
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    based = spark.read.schema(_SHARD).parquet(written).withColumn(
        "base", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).cast("long"))
    based.write.parquet(f"{folder}/manifest")
    return spark.read.parquet(f"{folder}/manifest")


def _arrow(ddl: str) -> pa.Schema:
    kinds = {"int": pa.int32(), "long": pa.int64(), "string": pa.string()}
    return pa.schema([(n, kinds[k]) for n, k in (x.split() for x in ddl.split(", "))])


class TokenFiles:
    """The files of one shard; ids and offsets are memory-mapped where possible."""

    def __init__(self, folder: str, stem: str, width: int):
        self.store, root = _store(folder)
        self.stem, self.dtype = f"{root}/{stem}", np.dtype(f"<u{width}")
        self.local = isinstance(self.store, pafs.LocalFileSystem)

    def read(self, kind: str, dtype: np.dtype, start: int, stop: int) -> np.ndarray:
        path = f"{self.stem}.{kind}"
        if self.local:
            return np.memmap(path, dtype, mode="r", offset=start * dtype.itemsize, shape=(stop - start,))
        with self.store.open_input_file(path) as f:
            return np.frombuffer(f.read_at((stop - start) * dtype.itemsize, start * dtype.itemsize), dtype)

    def documents(self, n_docs: int, n_null: int) -> Iterator[tuple[int | None, int, np.ndarray]]:
        """(doc_id, offset in the shard, ids) of each document."""
        for first in range(0, n_docs, _BLOCK_DOCS):
            last = min(first + _BLOCK_DOCS, n_docs)
            offsets = self.read("off", np.dtype("<u8"), first, last + 1).tolist()
            doc_ids = self.read("doc", np.dtype("<i8"), first, last).tolist()
            ids = self.read("bin", self.dtype, offsets[0], offsets[-1])
            for k, doc_id in enumerate(doc_ids):
                yield (None if first + k < n_null else doc_id, offsets[k],
                       ids[offsets[k] - offsets[0]:offsets[k + 1] - offsets[0]])


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """One row per document, read from the files: doc_id, start, n_tokens, ids_crc32.

    ``start`` counts the ids of all documents before it; the checksum is the
    crc32 of the ids as little-endian unsigned 32-bit integers.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard in batch.to_pylist():
                rows: list[tuple] = []
                files = TokenFiles(folder, shard["stem"], shard["width"])
                for doc_id, offset, ids in files.documents(shard["n_docs"], shard["n_null"]):
                    rows.append((doc_id, shard["base"] + offset, len(ids),
                                 zlib.crc32(ids.astype("<u4").tobytes())))
                    if len(rows) == _BLOCK_DOCS:
                        yield _batch(rows)
                        rows = []
                if rows:
                    yield _batch(rows)

    manifest = spark.read.parquet(f"{folder}/manifest")
    return manifest.repartition(max(1, manifest.count())).mapInArrow(read, _DOCUMENT)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    schema = _arrow(_DOCUMENT)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
