"""Packing documents into token windows by Karmarkar-Karp multiway differencing.

1. One pass over the texts (no shuffle) cuts each document's ids into pieces:
   full windows, then the rest in pieces of at most ``max_piece`` ids.  Only
   piece rows (ids, positions, checksum) leave the pass; they are written once.
2. A full window is a sequence of its own.  The other pieces are dealt into
   groups of about ``group_windows`` windows by a hash of their row number in
   the written table, so copies and long documents spread evenly.
3. Each group is packed by the largest differencing method: every piece starts
   as a partition of ``k`` windows with one filled; the two partitions with the
   largest spreads are merged, the fullest window of one with the emptiest of
   the other, until one partition is left.  ``k`` starts at the fewest windows
   that could hold the group and rises by one whenever a window exceeds the
   capacity.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import tokens
from .common import saved, slices

CAPACITY = 2048
MAX_PIECE = 512
GROUP_WINDOWS = 64

_PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
_PACKED = f"{_PIECE}, sequence_id long, offset long"
#: Windows that a group can have at most in the numbering of sequences.
_GROUP_IDS = 1 << 20


def difference(sizes: list[int], k: int) -> tuple[list[list[int]], list[int]]:
    """Deal items into ``k`` near-equal windows; returns item numbers and sums by window."""
    heap = []
    for n, size in enumerate(sizes):
        sums = np.zeros(k, np.int64)
        sums[0] = size
        heap.append((-size, n, sums, [[n]] + [[]] * (k - 1)))
    heapq.heapify(heap)
    n = len(sizes)
    while len(heap) > 1:
        _, _, a, a_items = heapq.heappop(heap)
        _, _, b, b_items = heapq.heappop(heap)
        sums = a + b[::-1]  # both run from full to empty
        order = np.argsort(-sums, kind="stable")
        sums = sums[order]
        items = [a_items[i] + b_items[k - 1 - i] for i in order.tolist()]
        heapq.heappush(heap, (-int(sums[0] - sums[-1]), n, sums, items))
        n += 1
    _, _, sums, items = heap[0]
    return items, sums.tolist()


def pack(sizes: list[int], capacity: int = CAPACITY) -> list[list[int]]:
    """Windows (lists of item numbers) of at most ``capacity`` each."""
    k = max(1, -(-sum(sizes) // capacity))
    while True:
        items, sums = difference(sizes, k)
        if sums[0] <= capacity:
            return items
        k += 1


def cut(n: int, capacity: int = CAPACITY, max_piece: int = MAX_PIECE) -> list[tuple[int, int]]:
    """(start, stop) of the pieces of a document of ``n`` ids."""
    full = n // capacity * capacity
    edges = [*range(0, full, capacity), *range(full, n, max_piece), n]
    return list(zip(edges, edges[1:]))


def pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY,
           max_piece: int = MAX_PIECE) -> DataFrame:
    """Pieces of all documents, with their checksums; each id is in exactly one."""

    def tokenize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = tokens.encoder(tokenizer_path)
        for batch in slices(batches):
            rows = []
            for doc_id, ids in zip(batch.column(0).to_pylist(), encoder.documents(batch.column(1).to_pylist())):
                wide = ids.astype("<u4")
                rows += [(doc_id, a, b - a, zlib.crc32(wide[a:b].tobytes()), len(ids))
                         for a, b in cut(len(ids), capacity, max_piece)]
            columns = list(zip(*rows)) or [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns],
                                             names=[x.split()[0] for x in _PIECE.split(", ")])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(tokenize, _PIECE)


def pack_documents(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY,
                   max_piece: int = MAX_PIECE, group_windows: int = GROUP_WINDOWS) -> DataFrame:
    """Pack ``docs(doc_id, text)``: one row per piece with its sequence and offset.

    Null texts are empty texts (one piece, the end id); null or repeated
    ``doc_id`` and equal rows are packed like any others; an empty table gives
    no rows.  Other columns are ignored.  Offsets run from 0 without gaps.
    """
    cuts = saved(pieces(docs, tokenizer_path, capacity, max_piece), "pieces")
    cuts = cuts.withColumn("_row", F.monotonically_increasing_id())
    full = F.col("length") == capacity
    rest = cuts.where(~full)
    total = rest.agg(F.sum("length")).first()[0] or 0
    groups = max(1, round(total / (group_windows * capacity)))
    order = [x.split()[0] for x in _PACKED.split(", ")]

    def pack_group(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("_row")  # the same result however the rows arrive
        sizes = group["length"].to_numpy()
        window, offset = np.zeros(len(group), np.int64), np.zeros(len(group), np.int64)
        for w, items in enumerate(pack(sizes.tolist(), capacity)):
            window[items] = w
            offset[items] = np.cumsum(sizes[items]) - sizes[items]
        return group.assign(sequence_id=key[0] * _GROUP_IDS + window, offset=offset)[order]

    whole = cuts.where(full).select(
        *[x.split()[0] for x in _PIECE.split(", ")],
        (F.lit(groups * _GROUP_IDS) + F.col("_row")).alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"))
    # Ids travel as strings: pandas would turn a column with nulls into floats.
    dealt = rest.withColumn("doc_id", F.col("doc_id").cast("string")).withColumn(
        "_group", F.pmod(F.xxhash64("_row"), F.lit(groups)))
    packed = dealt.groupBy("_group").applyInPandas(pack_group, _PACKED.replace("doc_id long", "doc_id string"))
    return whole.unionByName(packed.withColumn("doc_id", F.col("doc_id").cast("long")))
