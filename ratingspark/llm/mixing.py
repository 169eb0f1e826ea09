"""Mixing sources to target weights, by words.

Every document gets a random key, the md5 of a seed, its id and its size.  A
source's budget is ``epochs`` whole passes over the source and a rest; the
rest takes the documents with the smallest keys, cut at the exact word.

Finding the cut needs no sort of all rows.  Keys are ranged into buckets by
their leading digits; words per (source, bucket) are one aggregate, and their
prefix sums give the bucket that holds a source's cut.  Only rows of those
buckets are sorted.  A source is then described by one row (epochs, cut key,
words to take at the cut), and a document's share follows from its own key.
A hot source is spread over all buckets; the documents are never shuffled.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.indexing import dense_code_table
from .common import SPACE, WORD, saved

#: Weights of the sources in code-point order, repeating; a null source is last.
WEIGHTS = (5, 2, 1)
#: A source is taken this many times at most.
MAX_EPOCHS = 3
SEED = "mix"
#: Rows that a key bucket holds on average at most.
BUCKET_ROWS = 50_000


def word_count(text: str = "text") -> Column:
    """Number of words of a text (null: 0)."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def sized(docs: DataFrame, seed: str = SEED) -> DataFrame:
    """``docs`` with their ``_size`` and random ``_key``."""
    named = docs.withColumn("_size", word_count())
    return named.withColumn("_key", F.md5(F.concat(
        F.lit(seed + ":"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")),
        F.lit(":"), F.col("_size").cast("string"))))


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """Add ``target`` to ``sizes(source, source_size)``: one row per source.

    All sizes together are shared by weight.  A source that would exceed
    ``max_epochs`` times its size stops there and the excess is shared anew
    among the others, until none is above: each round fixes more sources, so
    the loop ends; only its sums reach the driver.
    """
    codes = dense_code_table(sizes, "source", "_code")
    place = F.coalesce(F.col("_code"), F.lit(codes.n)) % len(weights)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (place + 1).cast("int"))
    weighed = saved(sizes.join(codes.table, "source", "left")
                    .select("source", "source_size", weight.alias("_weight")), "sources")
    most = F.lit(max_epochs) * F.col("source_size")
    total = weighed.agg(F.sum("source_size")).first()[0] or 0
    level = total / (weighed.agg(F.sum("_weight")).first()[0] or 1.0)
    fixed = 0
    while True:
        above = F.lit(level) * F.col("_weight") > most
        n, held, free = weighed.agg(
            F.count(F.when(above, 1)), F.sum(F.when(above, most).otherwise(0)),
            F.sum(F.when(above, 0.0).otherwise(F.col("_weight")))).first()
        if n == fixed or not free:
            break
        fixed, level = n, (total - held) / free
    return weighed.select("source", "source_size", F.least(
        most.cast("double"), F.lit(level) * F.col("_weight")).alias("target"))


def cuts(rows: DataFrame, sources: DataFrame, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """One row per source: epochs, the key where its rest is cut, words taken there.

    ``rows(source, _size, _key)``.  Rows with the same key (repeated rows) are
    cut alike: each takes an equal whole number of words.
    """
    rest = F.floor(F.col("target")) - F.col("_epochs") * F.col("source_size")
    goals = sources.withColumn("_epochs", F.when(
        F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)) \
        .withColumn("_rest", F.greatest(rest, F.lit(0)))
    n = rows.count()
    digits = max(1, math.ceil(math.log(max(n, 1) / bucket_rows, 16))) if n > bucket_rows else 1
    bucket = F.substring("_key", 1, digits)
    sums = rows.groupBy("source", bucket.alias("_bucket")).agg(F.sum("_size").alias("_words"))
    upto = Window.partitionBy("source").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, 0)
    held = (sums.withColumn("_upto", F.sum("_words").over(upto)).withColumnRenamed("source", "_source")
            .join(goals, F.col("source").eqNullSafe(F.col("_source")))
            .where((F.col("_upto") >= F.col("_rest")) & (F.col("_upto") - F.col("_words") < F.col("_rest")))
            .select("source", F.col("_bucket").alias("_cut_bucket"), "_rest",
                    (F.col("_upto") - F.col("_words")).alias("_before")))
    held = saved(held, "held")  # one row per source
    near = rows.select(F.col("source").alias("_source"), "_size", "_key").join(
        held, F.col("source").eqNullSafe(F.col("_source")) & (bucket == F.col("_cut_bucket")))
    tied = near.groupBy("source", "_rest", "_before", "_key").agg(
        F.sum("_size").alias("_words"), F.count(F.lit(1)).alias("_copies"))
    running = Window.partitionBy("source").orderBy("_key").rowsBetween(Window.unboundedPreceding, 0)
    at = (tied.withColumn("_upto", F.col("_before") + F.sum("_words").over(running))
          .where((F.col("_upto") >= F.col("_rest")) & (F.col("_upto") - F.col("_words") < F.col("_rest")))
          .select(F.col("source").alias("_at"), F.col("_key").alias("_cut_key"),
                  F.floor((F.col("_rest") - F.col("_upto") + F.col("_words")) / F.col("_copies"))
                  .alias("_cut_words")))
    return saved(goals.join(at, F.col("source").eqNullSafe(F.col("_at")), "left")
                 .select(F.col("source").alias("_source"), "source_size", "target", "_epochs",
                         "_cut_key", "_cut_words"), "cuts")


def taken_words() -> Column:
    """Words of the rest that a document gives (without whole epochs)."""
    return (F.when(F.col("_key") < F.col("_cut_key"), F.col("_size"))
            .when(F.col("_key") == F.col("_cut_key"), F.least(F.col("_cut_words"), F.col("_size")))
            .otherwise(F.lit(0)).cast("long"))


def _planned(docs: DataFrame, weights: tuple[int, ...], max_epochs: int, seed: str) -> tuple[DataFrame, DataFrame]:
    rows = saved(sized(docs.select("doc_id", "text", "source"), seed).drop("text"), "sizes")
    sizes = saved(rows.groupBy("source").agg(F.sum("_size").alias("source_size")), "source-sizes")
    return rows, cuts(rows, targets(sizes, weights, max_epochs))


def _with_shares(rows: DataFrame, plan: DataFrame) -> DataFrame:
    kept = [F.col(c) for c in rows.columns if c not in ("_size", "_key")]
    return (rows.join(plan, F.col("source").eqNullSafe(F.col("_source")))
            .withColumn("_rest", taken_words())
            .select(*kept, F.col("_size").alias("size"), "source_size", "target",
                    F.col("_epochs").cast("long").alias("epochs"), F.col("_rest").alias("rest"),
                    (F.col("_epochs") * F.col("_size") + F.col("_rest")).cast("long").alias("taken")))


def shares(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS,
           seed: str = SEED) -> DataFrame:
    """What the mix takes of each of ``docs(doc_id, text, source)``, without texts.

    Columns: doc_id, source, size (words), source_size, target (words of its
    source), epochs (whole copies taken), rest (first words of one more copy)
    and taken = epochs * size + rest.  Null and empty texts have size 0 and
    give nothing; null sources are one source, the last; null ids are
    documents like others; rows that agree in id and size are cut alike; an
    empty table gives no rows.
    """
    return _with_shares(*_planned(docs, weights, max_epochs, seed))


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS,
        seed: str = SEED) -> DataFrame:
    """``docs`` with all their columns and those of ``shares`` (which replace clashing ones)."""
    docs = docs.drop("size", "source_size", "target", "epochs", "rest", "taken")
    _, plan = _planned(docs, weights, max_epochs, seed)
    return _with_shares(sized(docs, seed), plan)


def first_words(text: Column, n: Column) -> Column:
    """The text up to its ``n``-th word, with its own spacing."""
    runs = F.split(text, f"(?<=[{SPACE}])(?=[^{SPACE}])")
    lead = F.when(text.rlike(f"^[{SPACE}]"), F.lit(1)).otherwise(F.lit(0))
    return F.array_join(F.slice(runs, F.lit(1), (n + lead).cast("int")), "")


def materialize(mixed: DataFrame) -> DataFrame:
    """The mix itself: each document once per epoch, and the first words of a cut one.

    Documents of which nothing is taken go; all columns of ``mixed`` stay.
    """
    copies = F.col("epochs") + F.when(F.col("rest") > 0, 1).otherwise(0)
    rows = mixed.where(F.col("taken") > 0).withColumn(
        "_copy", F.explode(F.sequence(F.lit(1), copies.cast("int"))))
    part = (F.col("_copy") > F.col("epochs")) & (F.col("rest") < F.col("size"))
    return rows.withColumn("text", F.when(
        part, first_words(F.col("text"), F.col("rest"))).otherwise(F.col("text"))).drop("_copy")


def mixed_documents(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS,
                    seed: str = SEED) -> DataFrame:
    """The documents of the mix, with exactly the columns of ``docs``, whatever their names.

    Columns other than the text travel as one struct, so they cannot clash
    with those of the operator.
    """
    rest = [c for c in docs.columns if c != "text"]
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in rest]).alias("doc"), "doc_id", "text", "source")
    mixed = materialize(mix(rows, weights, max_epochs, seed))
    return mixed.select(*[F.col("text") if c == "text" else F.col("doc")[c].alias(c) for c in docs.columns])
