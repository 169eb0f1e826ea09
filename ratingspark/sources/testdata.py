"""Rating-shaped views over the driver's TPC-H-like parquet tables.

| view          | definition                                                               |
|---------------|--------------------------------------------------------------------------|
| reviews       | lineitem x orders x customer x part: user_name=c_name, user_id=o_custkey,|
|               | item_id=l_partkey, item_name=p_name, category=p_type,                    |
|               | rating=l_quantity/10                                                     |
| nullable      | reviews with category null for 'PROMO' and rating null for 5.0           |
| ratings       | (user_id, item_id, rating) of reviews                                    |
| item_vectors  | item lookup x embeddings on item_id = vec_id, features ARRAY<DOUBLE>      |

Only the columns a view needs are read (the scans prune to them), and the
joins are plain equi joins so the optimizer chooses broadcast or shuffle from
measured sizes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.indexing import dense_code_table
from ..session import Generations

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The reviews view."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type")
    joined = (li.join(orders, li.l_orderkey == orders.o_orderkey)
              .join(cust, F.col("o_custkey") == cust.c_custkey)
              .join(part, F.col("l_partkey") == part.p_partkey))
    return joined.select(
        F.col("c_name").alias("user_name"),
        F.col("o_custkey").alias("user_id"),
        F.col("l_partkey").alias("item_id"),
        F.col("p_name").alias("item_name"),
        F.col("p_type").alias("category"),
        (F.col("l_quantity") / F.lit(10.0)).alias("rating"),
    )


def coded_triples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(user_id, item_id, rating)``, user_id = dense code of the user name.

    Same result as ``prep.rating_triples(reviews(...))``, planned for scale:
    the fact table is read once, for a table of (customer key, item, rating)
    that is written to the shared folder.  The names of the customers in it
    are coded at the customer table, a dimension, and the codes are joined to
    the written rows by customer key, so fact rows never shuffle by name.
    """
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    part = table(spark, sf_dir, "part").select("p_partkey")
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    rows = Generations(spark, "triples").write(
        li.join(orders, li.l_orderkey == orders.o_orderkey)
        .join(part, F.col("l_partkey") == part.p_partkey)
        .select("o_custkey", F.col("l_partkey").alias("item_id"),
                (F.col("l_quantity") / F.lit(10.0)).alias("rating")))
    met = rows.select(F.col("o_custkey").alias("c_custkey")).distinct()
    codes = dense_code_table(cust.join(met, "c_custkey", "left_semi"), "c_name", "_code")
    named = F.broadcast(codes.table) if codes.broadcastable() else codes.table
    keyed = cust.join(named, "c_name", "left").select(
        "c_custkey", F.coalesce(F.col("_code"), F.lit(-1).cast("bigint")).alias("user_id"))
    return rows.join(keyed, F.col("o_custkey") == F.col("c_custkey")).select("user_id", "item_id", "rating")


def nullable_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reviews with value-driven nulls, to exercise null handling (P1, -1 codes)."""
    r = reviews(spark, sf_dir)
    return r.select(
        "user_name", "user_id", "item_id", "item_name",
        F.when(F.col("category") != F.lit("PROMO"), F.col("category")).alias("category"),
        F.when(F.col("rating") != F.lit(5.0), F.col("rating")).alias("rating"),
    )


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reviews(spark, sf_dir).select("user_id", "item_id", "rating")


def embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(item_id, features ARRAY<DOUBLE>)`` from the embeddings table."""
    emb = table(spark, sf_dir, "embeddings")
    return emb.select(F.col("vec_id").alias("item_id"),
                      F.col("embedding").cast("array<double>").alias("features"))
