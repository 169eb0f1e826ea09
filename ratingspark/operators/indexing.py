"""Exact dense codes without a global window.

``dense_rank() OVER (ORDER BY v)`` plans to a single partition.  Here the
distinct values are range-partitioned and sorted within partitions; each row's
position is ``offset(partition) + index within partition``.  The index comes
from ``monotonically_increasing_id`` (partition id in the upper 31 bits, row
number in the lower 33), the offsets from a per-partition count.

Range bounds are sampled, so a recomputed partition could land differently.
The sorted table is therefore written as a reliable checkpoint before the
offsets are derived: every later read sees the same partitions, even after an
executor loss.  The offsets table has one row per partition, a size fixed by
configuration rather than by the data, so it is computed on the driver and
broadcast.  The same pass counts the codes and their bytes: a join that
attaches codes to rows broadcasts them only under that proven size bound
(AQE would otherwise switch to a broadcast only after the rows were shuffled).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import fits_broadcast, reliable_checkpoint

_LOW_BITS = (1 << 33) - 1
_ROW_OVERHEAD = 64  # bytes per (value, code) row in an unsafe row / hash relation, upper bound


@dataclass
class CodeTable:
    """Dense codes ``(value, code)`` with their exact size.

    ``n`` is the number of codes and ``nbytes`` an upper bound of the table in
    a broadcast hash relation, both counted while the offsets are computed,
    so a join can broadcast the table under a proven size bound.
    """

    table: DataFrame
    n: int
    nbytes: int

    def broadcastable(self) -> bool:
        return fits_broadcast(self.table.sparkSession, 1, self.nbytes)


def dense_code_table(df: DataFrame, col: str, code_col: str = "code") -> CodeTable:
    """Sorted distinct non-null values -> 0..n-1, with the table's size."""
    spark = df.sparkSession
    distinct = df.select(col).where(F.col(col).isNotNull()).distinct()
    ordered = (
        distinct.repartitionByRange(F.col(col).asc())
        .sortWithinPartitions(F.col(col).asc())
        .withColumn("_rid", F.monotonically_increasing_id())
    )
    ordered = reliable_checkpoint(ordered)
    part = F.shiftright(F.col("_rid"), 33)
    local = F.col("_rid").bitwiseAND(F.lit(_LOW_BITS))
    # one row per partition: a size fixed by configuration, not by the data
    sizes = sorted(tuple(r) for r in ordered.groupBy(part.alias("_part")).agg(
        F.count(F.lit(1)), F.sum(F.octet_length(F.col(col).cast("string")))).collect())
    rows, total, nbytes = [], 0, 0
    for p, n, b in sizes:
        rows.append((int(p), total))
        total += int(n)
        nbytes += int(b or 0)
    offsets = spark.createDataFrame(rows or [(0, 0)], "_part bigint, _off bigint")
    table = (
        ordered.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")
        .select(F.col(col), (F.col("_off") + local).cast("bigint").alias(code_col))
    )
    return CodeTable(table, total, nbytes + total * _ROW_OVERHEAD)


def dense_codes(df: DataFrame, col: str, code_col: str = "code") -> DataFrame:
    """Dimension table ``(col, code_col)``: sorted distinct non-null values -> 0..n-1."""
    return dense_code_table(df, col, code_col).table


def encode(df: DataFrame, col: str, code_col: str,
           codes: DataFrame | CodeTable | None = None, missing: int = -1) -> DataFrame:
    """Add ``code_col`` = dense code of ``col``; null (or unknown) -> ``missing``.

    With a ``CodeTable`` (computed here when ``codes`` is None) the join
    broadcasts the codes when their counted size is under the threshold, so
    the rows of ``df`` are not shuffled; a bare DataFrame is left to the
    optimizer and AQE.
    """
    if codes is None:
        codes = dense_code_table(df, col, code_col)
    if isinstance(codes, CodeTable):
        table = F.broadcast(codes.table) if codes.broadcastable() else codes.table
    else:
        table = codes
    joined = df.join(table, on=col, how="left")
    return joined.withColumn(code_col, F.coalesce(F.col(code_col), F.lit(missing).cast("bigint")))
