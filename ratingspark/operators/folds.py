"""Seeded shuffle and k near-equal folds (L5, L6), splits (P11, U1), counts.

The reference shuffles rows at random and cuts them with ``array_split``:
the first ``n mod k`` folds get one row more.  Here the shuffle order is the
md5 of ``seed|row`` (repeatable, independent of partitioning), and the fold
of a row is a function of its position in that order.

Positions without a global window or a single-task sort:

1. identical rows are collapsed to ``(row, m)`` first (partial aggregation,
   so a group of copies holding a third of all rows costs nothing extra);
2. the leading hex digits of the md5 key form ``16**digits`` buckets, which
   are contiguous ranges of the shuffle order (md5, row) and evenly filled
   because md5 is uniform;
3. per-bucket totals give bucket offsets (a running sum over the small table
   of buckets), a running sum inside each bucket gives the row's offset;
4. a row with ``m`` copies covers positions ``[s, s+m)``; it is cut into one
   piece per fold it overlaps, and a piece of more than ``chunk_rows`` copies
   into chunks, which are dealt to tasks before they are expanded.  So a hot
   row is expanded by many tasks, and positions do not depend on the chunks.

The order is the one the DuckDB oracle's ``ntile`` uses.  Everything is a
deterministic function of the input rows, so a recomputed partition gives the
same folds.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import defaults as D
from ..functions.hashing import hex_prefix_int, row_key


def _fold_start(f: str) -> str:
    """SQL: first position of fold ``f`` when n = q*k + r (first r folds hold q+1)."""
    return f"(({f}) * _q + least({f}, _r))"


def _fold_of(i: str) -> str:
    """SQL: fold of position ``i`` (exact integer arithmetic)."""
    return (f"CAST(CASE WHEN ({i}) < _r * (_q + 1) THEN ({i}) div (_q + 1) "
            f"ELSE _r + (({i}) - _r * (_q + 1)) div greatest(_q, 1) END AS INT)")


def _cut(pieces: DataFrame, chunk_rows: int) -> DataFrame:
    """Rows of ``_cnt`` copies as rows of at most ``chunk_rows``, dealt evenly to tasks."""
    chunk = F.explode(F.expr(f"sequence(CAST(0 AS BIGINT), (_cnt - 1) div {chunk_rows})"))
    cut = pieces.withColumn("_chunk", chunk).withColumn("_cnt", F.least(
        F.lit(chunk_rows).cast("bigint"), F.col("_cnt") - F.col("_chunk") * F.lit(chunk_rows)))
    others = [c for c in pieces.columns if c != "_cnt"]
    return cut.repartition(F.xxhash64(*others, "_chunk")).drop("_chunk")


def _expand(pieces: DataFrame, cols: Sequence[str], fold_col: str) -> DataFrame:
    """Turn ``(row, fold, _cnt)`` pieces (``_cnt`` <= chunk_rows) into ``_cnt`` rows."""
    rep = F.explode(F.array_repeat(F.lit(0), F.col("_cnt").cast("int")))
    return pieces.select(*cols, fold_col, rep.alias("_x")).drop("_x")


def assign_folds(ratings: DataFrame, k: int = D.NUM_FOLDS, seed: int = 42,
                 cols: Sequence[str] | None = None, fold_col: str = "fold",
                 method: str = "exact", bucket_digits: int = 4,
                 chunk_rows: int = 1_000_000) -> DataFrame:
    """Add ``fold_col`` in ``0..k-1`` to every row.

    ``method="exact"`` reproduces ``array_split`` of the seeded shuffle:
    fold sizes differ by at most one and the larger folds come first.
    ``method="hash"`` skips the positions: each distinct row starts at
    ``md5 mod k`` and its copies go round-robin from there.  Fold sizes are
    then only near-equal in expectation; no sort is needed.  Both expand
    copies in chunks of ``chunk_rows``, which does not change the folds.
    """
    if k < 1:
        raise ValueError("k must be >= 1")
    cols = list(cols or ratings.columns)
    counted = ratings.groupBy(*cols).agg(F.count(F.lit(1)).alias("_m"))
    counted = counted.withColumn("_key", row_key(counted, cols, seed))
    if method == "hash":
        kk = F.lit(k)
        h = F.pmod(hex_prefix_int("_key", 1, 15), kk)
        pieces = counted.select(*cols, "_key", "_m", h.alias("_h"),
                                F.explode(F.sequence(F.lit(0), F.lit(k - 1))).alias(fold_col))
        # copy j of a row goes to fold (h + j) mod k: the first such j is r0
        pieces = pieces.withColumn("_r0", F.pmod(F.col(fold_col) - F.col("_h"), kk))
        cnt = F.when(F.col("_r0") < F.col("_m"), F.expr(f"(_m - 1 - _r0) div {k} + 1")).otherwise(F.lit(0))
        pieces = pieces.select(*cols, F.col(fold_col).cast("int").alias(fold_col),
                               cnt.cast("bigint").alias("_cnt")).where(F.col("_cnt") > 0)
        return _expand(_cut(pieces, chunk_rows), cols, fold_col)
    if method != "exact":
        raise ValueError(f"unknown method {method!r}")

    # non-nullable bucket: no inferred not-null filter splits the uses of ``counted``
    bucketed = counted.withColumn(
        "_b", F.coalesce(hex_prefix_int("_key", 1, bucket_digits), F.lit(0).cast("bigint"))).drop("_key")
    totals = bucketed.groupBy("_b").agg(F.sum("_m").alias("_gm"))
    before = Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    every = Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    offsets = totals.select("_b", F.coalesce(F.sum("_gm").over(before), F.lit(0)).alias("_goff"),
                            F.sum("_gm").over(every).alias("_n"))
    order = [F.col("_key").asc()] + [F.col(c).asc_nulls_first() for c in cols]
    running = Window.partitionBy("_b").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    # dealt without their keys, which are made again: a key is longer than most rows
    dealt = bucketed.repartition("_b")
    dealt = dealt.withColumn("_key", row_key(dealt, cols, seed))
    placed = (dealt.withColumn("_s", F.sum("_m").over(running) - F.col("_m")).drop("_key")
              .join(offsets, "_b"))
    placed = placed.select(*cols, (F.col("_goff") + F.col("_s")).alias("_start"),
                           (F.col("_goff") + F.col("_s") + F.col("_m")).alias("_end"),
                           F.expr(f"_n div {k}").alias("_q"), F.expr(f"_n % {k}").alias("_r"))
    first, last = F.expr(_fold_of("_start")), F.expr(_fold_of("_end - 1"))
    pieces = placed.select(*cols, "_start", "_end", "_q", "_r",
                           F.explode(F.sequence(first, last)).alias(fold_col))
    f = f"CAST({fold_col} AS BIGINT)"
    cnt = F.expr(f"least({_fold_start(f + ' + 1')}, _end) - greatest({_fold_start(f)}, _start)")
    pieces = pieces.select(*cols, F.col(fold_col).cast("int").alias(fold_col),
                           cnt.cast("bigint").alias("_cnt"))
    return _expand(_cut(pieces, chunk_rows), cols, fold_col)


def fold_split(folded: DataFrame, held_out: int, fold_col: str = "fold"
               ) -> tuple[DataFrame, DataFrame]:
    """(train, test) for one held-out fold: two filters, no union."""
    return (folded.where(F.col(fold_col) != F.lit(held_out)),
            folded.where(F.col(fold_col) == F.lit(held_out)))


def union_folds(frames: Sequence[DataFrame]) -> DataFrame:
    """Union of separately read folds (U1), matched by column name."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def label_split(folded: DataFrame, held_out: int, fold_col: str = "fold") -> DataFrame:
    """Every row tagged ``split = 'train' | 'test'`` for one held-out fold."""
    return folded.withColumn(
        "split", F.when(F.col(fold_col) == F.lit(held_out), "test").otherwise("train"))


def fold_counts(folded: DataFrame, k: int, fold_col: str = "fold") -> DataFrame:
    """``fold, n_train, n_test`` for folds 0..k-1 and any other fold of the data.

    Rows without a fold are never held out: they count as training rows.
    """
    spark = folded.sparkSession
    per = folded.groupBy(fold_col).agg(F.count(F.lit(1)).alias("n_test"))
    listed = spark.range(k).select(F.col("id").cast("int").alias(fold_col), F.lit(0).cast("bigint").alias("n_test"))
    per = per.select(F.col(fold_col).cast("int").alias(fold_col), "n_test").unionByName(listed)
    per = per.groupBy(fold_col).agg(F.sum("n_test").alias("n_test"))
    total = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return per.select(fold_col, (F.sum("n_test").over(total) - F.col("n_test")).cast("bigint").alias("n_train"),
                      "n_test").where(F.col(fold_col).isNotNull())
