"""Rating-shaped inputs built from the driver tables, shared by the queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import prep
from ..operators import vectors as V
from ..session import reliable_checkpoint
from ..sources import testdata

DIGITS = 6


def rnd(c: str | Column, name: str | None = None) -> Column:
    """Round a double to the comparison precision (6 digits), keep its name."""
    col = F.col(c) if isinstance(c, str) else c
    out = F.round(col, DIGITS)
    if name is None and isinstance(c, str):
        name = c
    return out.alias(name) if name else out


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    return testdata.reviews(spark, sf_dir)


def lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prep.item_lookup(reviews(spark, sf_dir))


def item_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Item data (lookup x vectors), written once as a reliable checkpoint.

    The explore queries read it several times (probe, distances, centroids),
    like the reference reads its lookup and vector files; the table is
    item-scale, so writing it is cheap next to re-joining the reviews.
    """
    return reliable_checkpoint(
        V.attach_vectors(lookup(spark, sf_dir), testdata.embeddings(spark, sf_dir)))


def triples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(user_id, item_id, rating)`` with user ids = dense codes of user names
    (the codes are attached at the customer dimension, see ``coded_triples``)."""
    return testdata.coded_triples(spark, sf_dir)


def formula_factors(ratings: DataFrame, id_col: str, d: int) -> DataFrame:
    """Start vectors ``((id*31 + k*17) % 97)/97 - 0.5`` for k = 1..d.

    A test device: exact in every engine, so the oracle can follow the
    gradient steps digit for digit (the library default is ``init_factors``).
    """
    ids = ratings.select(F.col(id_col).alias("id")).distinct()
    return ids.select("id", *[
        (F.pmod(F.col("id") * F.lit(31) + F.lit(k * 17), F.lit(97)).cast("double") / F.lit(97.0)
         - F.lit(0.5)).alias(f"f{k - 1}") for k in range(1, d + 1)])
