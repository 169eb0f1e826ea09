"""Prepare stage: reviews -> clean ratings, dense ids, item lookup, baselines.

Input is a reviews table with (at least) the columns of ``REVIEW_COLUMNS``:
``user_name, item_id, item_name, category, rating``.  Every function returns
a DataFrame.  Some run jobs over all rows while it is built: dense codes write
a table of distinct values, ``item_lookup`` one of items, ``supported_reviews``
one of supported keys, ``rating_histogram`` one of distinct ratings, and
``prepare_dataset`` the clean rows.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import defaults as D
from ..session import Generations, reliable_checkpoint, sized_checkpoint
from ..sources import files
from .folds import assign_folds
from .indexing import CodeTable, dense_code_table, encode

#: Rows in a group of the shuffle order, about.
BUCKET_ROWS = 1_000_000
REVIEW_COLUMNS = ["user_name", "item_id", "item_name", "category", "rating"]


def drop_null_rows(df: DataFrame) -> DataFrame:
    """Drop a row when any column is null."""
    return df.na.drop(how="any")


def rating_triples(reviews: DataFrame, user_col: str = "user_name", item_col: str = "item_id",
                   rating_col: str = "rating",
                   user_codes: DataFrame | CodeTable | None = None) -> DataFrame:
    """``(user_id, item_id, rating)`` with users encoded densely in name order."""
    projected = reviews.select(user_col, item_col, rating_col)
    if user_codes is None:
        user_codes = dense_code_table(projected, user_col, "user_id")
    enc = encode(projected, user_col, "user_id", codes=user_codes)
    return enc.select("user_id", F.col(item_col).alias("item_id"), F.col(rating_col).alias("rating"))


def item_mean_rating(reviews: DataFrame, item_col: str = "item_id",
                     rating_col: str = "rating") -> DataFrame:
    """Mean rating per item (A1)."""
    return reviews.groupBy(item_col).agg(F.avg(rating_col).alias("rating"))


def item_lookup(reviews: DataFrame,
                category_codes: DataFrame | CodeTable | None = None) -> DataFrame:
    """Item lookup.

    Distinct ``(item_id, item_name, category, category_id)`` rows joined with
    the mean rating per item: an item listed under two names keeps two rows.

    One aggregate over the reviews, ``(item, name, category) -> sum, count``,
    serves all three parts: its rows are the distinct names, its categories
    feed the codes, and re-summing it per item gives the item means.  It is
    item-scale and written once as a reliable checkpoint, so the reviews are
    scanned once (column pruning would otherwise give each part its own plan
    and its own scan).
    """
    per = reliable_checkpoint(reviews.groupBy("item_id", "item_name", "category").agg(
        F.sum("rating").alias("_sum"), F.count("rating").alias("_cnt")))
    if category_codes is None:
        category_codes = dense_code_table(per, "category", "category_id")
    means = per.groupBy("item_id").agg(F.sum("_sum").alias("_sum"), F.sum("_cnt").alias("_cnt"))
    means = means.select("item_id", F.when(F.col("_cnt") > 0, F.col("_sum") / F.col("_cnt"))
                         .alias("rating"))
    names = encode(per.select("item_id", "item_name", "category"), "category", "category_id",
                   codes=category_codes)
    names = names.select("item_id", "item_name", "category", "category_id")
    return names.join(means, on="item_id", how="inner")


def item_support(reviews: DataFrame, key_col: str = "item_name", rating_col: str = "rating",
                 min_count: int = D.MIN_SUPPORT) -> DataFrame:
    """Mean and count per key, keeping keys with more than ``min_count`` reviews (A2, P5)."""
    stats = reviews.groupBy(key_col).agg(
        F.avg(rating_col).alias("mean_rating"), F.count(F.lit(1)).alias("n_reviews"))
    return stats.where(F.col("n_reviews") > F.lit(min_count))


def supported_reviews(reviews: DataFrame, key_col: str = "item_name",
                      min_count: int = D.MIN_SUPPORT,
                      columns: tuple[str, ...] = ("user_name", "item_name", "rating", "category"),
                      ) -> DataFrame:
    """Reviews of supported keys with no null column.

    The reference left-joins the per-name stats and then drops rows with any
    null, which is an inner join plus a null filter on the review columns.
    """
    rows = reviews.select(*columns).na.drop(how="any")
    support, small = sized_checkpoint(item_support(rows, key_col=key_col, min_count=min_count))
    # a small support table is broadcast (counted, not guessed): the rows are not shuffled
    return rows.join(F.broadcast(support) if small else support, on=key_col, how="inner")


def mean_predictor(ratings: DataFrame, rating_col: str = "rating") -> DataFrame:
    """Global mean and the RMSE of always predicting it (A3, A4) in one job.

    The RMSE of the constant mean predictor is the population deviation.
    """
    return ratings.agg(
        F.count(F.col(rating_col)).alias("n"),
        F.avg(rating_col).alias("mean_rating"),
        F.stddev_pop(rating_col).alias("rmse"),
    )


def rating_histogram(ratings: DataFrame, rating_col: str = "rating",
                     bins: int = D.HISTOGRAM_BINS) -> DataFrame:
    """Equal-width histogram with the pandas/numpy conventions (A5).

    ``bins`` intervals over [min, max], the last closed; when min == max the
    range is widened to [min - 0.5, max + 0.5].  Empty bins are reported with
    count 0.  The rows are read once, for the number of rows by rating; two
    scalars (min, max) of that table come to the driver.
    """
    spark = ratings.sparkSession
    values = reliable_checkpoint(ratings.where(F.col(rating_col).isNotNull()).groupBy(
        F.col(rating_col).cast("double").alias("x")).agg(F.count(F.lit(1)).alias("w")))
    lo, hi = values.agg(F.min("x"), F.max("x")).first()
    if lo is None:
        return spark.createDataFrame([], "bin int, lo double, hi double, n bigint")
    if lo == hi:
        lo, hi = lo - 0.5, hi + 0.5
    width = hi - lo
    idx = F.least(F.floor((F.col("x") - F.lit(lo)) * F.lit(float(bins)) / F.lit(width)),
                  F.lit(bins - 1)).cast("int")
    counts = values.groupBy(idx.alias("bin")).agg(F.sum("w").alias("n"))
    edges = spark.range(bins).select(
        F.col("id").cast("int").alias("bin"),
        (F.lit(lo) + F.col("id") * F.lit(width / bins)).alias("lo"),
        (F.lit(lo) + (F.col("id") + 1) * F.lit(width / bins)).alias("hi"),
    )
    return (edges.join(F.broadcast(counts), "bin", "left")
            .select("bin", "lo", "hi", F.coalesce("n", F.lit(0)).cast("bigint").alias("n")))


def entity_counts(ratings: DataFrame, user_col: str = "user_id",
                  item_col: str = "item_id") -> DataFrame:
    """Distinct users, distinct items and rows in one aggregate."""
    return ratings.agg(
        F.count_distinct(user_col).alias("n_users"),
        F.count_distinct(item_col).alias("n_items"),
        F.count(F.lit(1)).alias("n_ratings"),
    )


def distinct_ids(ratings: DataFrame, col: str) -> DataFrame:
    """Distinct ids of one side (A6), e.g. the users to give factors to."""
    return ratings.select(col).distinct()


def prepare_dataset(reviews: DataFrame, folds_path: str | None = None,
                    lookup_path: str | None = None, k: int = D.NUM_FOLDS, seed: int = 42,
                    null_columns: Sequence[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """The prepare stage end to end: clean, look up, encode, fold (and write).

    A row is dropped when any of ``null_columns`` is null; without them, any
    column of ``reviews``, so a file is to be read with all its columns.  The
    clean rows are written once to the shared checkpoint folder; the item
    lookup (P4, A1, J1) and the rating triples with dense user codes (P2, P3)
    are built from them, and the triples get exact seeded folds (L5, L6) with
    about ``BUCKET_ROWS`` rows in each group of the shuffle order.  With paths
    given, the folds (one directory per fold, S6) and the lookup (header CSV,
    S7) are written.  Returns ``(lookup, folded)``.
    """
    whole = reviews.na.drop(how="any", subset=list(null_columns or reviews.columns))
    clean = Generations(reviews.sparkSession, "reviews").write(whole.select(*REVIEW_COLUMNS))
    digits = max(1, math.ceil(math.log(max(clean.count() / BUCKET_ROWS, 1), 16)))
    lookup = item_lookup(clean)
    folded = assign_folds(rating_triples(clean), k=k, seed=seed, bucket_digits=digits)
    if lookup_path:
        files.write_lookup(lookup, lookup_path)
    if folds_path:
        files.write_folds(folded, folds_path)
    return lookup, folded
