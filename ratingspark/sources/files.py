"""Readers and writers.

All readers take explicit schemas (no inference pass over the data) and use
Spark's file sources, so they split files across tasks and prune columns.
Writers are plain DataFrame writes; hidden files (``_SUCCESS``, ``.crc``)
are skipped by Spark's readers natively.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.vectors import to_array, vector_dim, vector_text, wide_names
from ..session import folder_exists, reliable_checkpoint

RATING_SCHEMA = "user_id INT, item_id INT, rating DOUBLE"
LOOKUP_SCHEMA = ("item_id BIGINT, item_name STRING, category STRING, category_id BIGINT, "
                 "rating DOUBLE")

#: A quote inside a quoted field is written twice, in files read and written.
CSV = {"escape": '"'}

# The columns of the raw review file that are used, their types,
# and the library's names for them.
REVIEW_FILE_COLUMNS = [
    ("review_profilename", "string", "user_name"),
    ("beer_beerid", "bigint", "item_id"),
    ("beer_name", "string", "item_name"),
    ("beer_style", "string", "category"),
    ("review_overall", "double", "rating"),
]


def read_reviews(spark: SparkSession, path: str, fmt: str = "csv",
                 columns: list[tuple[str, str, str]] | None = None,
                 others: bool = True) -> DataFrame:
    """Header CSV (or parquet) of reviews, renamed to the library's columns.

    ``columns`` is ``[(file name, type, library name), ...]``.  The file's
    other columns follow under their own names, because the prepare stage
    drops a row when any column of the file is null; a query that does not use
    them does not read them.
    """
    columns = columns or REVIEW_FILE_COLUMNS
    if fmt == "csv":
        raw = spark.read.options(**CSV).option("header", True).option("inferSchema", False).csv(path)
    else:
        raw = spark.read.format(fmt).load(path)
    named = {src for src, _, _ in columns} | {dst for _, _, dst in columns}
    rest = [F.col(f"`{c}`") for c in raw.columns if c not in named] if others else []
    return raw.select(*[F.col(src).cast(typ).alias(dst) for src, typ, dst in columns], *rest)


def read_ratings(spark: SparkSession, path: str | Sequence[str],
                 schema: str = RATING_SCHEMA) -> DataFrame:
    """Headerless ``user,item,rating`` text; a malformed row fails the job."""
    return spark.read.schema(schema).option("mode", "FAILFAST").csv(path)


#: Column that holds the text of a row that does not fit the schema.
BAD_LINE = "_bad_line"


@dataclass
class CheckedRows:
    """A file split into the rows that fit its schema and the lines that do not."""

    clean: DataFrame      # the schema's columns
    rejected: DataFrame   # line, file
    counts: DataFrame     # kind ('clean', 'rejected'), n; a row for each kind


def read_checked(spark: SparkSession, path: str | Sequence[str], schema: str, header: bool = False) -> CheckedRows:
    """CSV rows that fit ``schema``, beside those that do not.

    A line is rejected if a value is no number where one is due, or if it has
    too few or too many fields; it is kept as text with the file that holds
    it.  An empty field is a null of a clean row.  The file is parsed once, into
    a reliable checkpoint from which all three tables are read.  Where a bad
    row should fail the job, use ``read_ratings``.
    """
    fields = spark.createDataFrame([], schema).columns
    reader = spark.read.schema(f"{schema}, {BAD_LINE} string").options(**CSV).options(
        mode="PERMISSIVE", columnNameOfCorruptRecord=BAD_LINE, header=header)
    rows = reliable_checkpoint(reader.csv(path).select("*", F.col("_metadata.file_path").alias("_file")))
    bad = F.col(BAD_LINE).isNotNull()
    kinds = spark.createDataFrame([("clean",), ("rejected",)], "kind string")
    counts = rows.groupBy(F.when(bad, "rejected").otherwise("clean").alias("kind")).agg(F.count(F.lit(1)).alias("n"))
    return CheckedRows(
        rows.where(~bad).select(*fields), rows.where(bad).select(F.col(BAD_LINE).alias("line"), F.col("_file").alias("file")),
        kinds.join(counts, "kind", "left").select("kind", F.coalesce("n", F.lit(0)).cast("bigint").alias("n")))


def read_reviews_checked(spark: SparkSession, path: str, columns: list[tuple[str, str, str]] | None = None) -> CheckedRows:
    """Header CSV of reviews as ``read_reviews`` names it, split by ``read_checked``."""
    columns = columns or REVIEW_FILE_COLUMNS
    types = {src: typ for src, typ, _ in columns}
    given = spark.read.options(**CSV).option("header", True).option("inferSchema", False).csv(path).columns
    missing = [src for src in types if src not in given]
    if missing:
        raise ValueError(f"the file has no columns {missing}")
    schema = ", ".join(f"`{c}` {types.get(c, 'string')}" for c in given)
    found = read_checked(spark, path, schema, header=True)
    named = {src: dst for src, _, dst in columns}
    rest = [c for c in given if c not in named and c not in named.values()]
    found.clean = found.clean.select(*[F.col(f"`{src}`").alias(dst) for src, dst in named.items()],
                                     *[F.col(f"`{c}`") for c in rest])
    return found


def read_folds(spark: SparkSession, directory: str, num_folds: int | None = None,
               schema: str = RATING_SCHEMA, fold_col: str = "fold") -> DataFrame:
    """Files ``fold0 .. fold{k-1}`` of a directory as ONE frame with a fold column (S3).

    Without ``num_folds``, or with 1 (train on all), every fold of the
    directory is read.  Each ``fold<i>`` may be a single file, a directory of
    part files, or the ``fold=<i>`` directory that ``write_folds`` writes; a
    fold that is asked for and missing is an error.
    """
    root = directory.rstrip("/")
    names = ["[0-9]*"] if num_folds in (None, 1) else [str(i) for i in range(num_folds)]
    paths = [f"{root}/{{fold{n},fold={n}}}" for n in names]
    df = spark.read.schema(schema).options(**CSV).option("mode", "FAILFAST").csv(paths)
    fold = F.regexp_extract(F.col("_metadata.file_path"), r"/fold=?(\d+)(/[^/]*)?$", 1).cast("int")
    return df.select("*", fold.alias(fold_col))


def read_fold_table(spark: SparkSession, directory: str, schema: str = RATING_SCHEMA,
                    fold_col: str = "fold") -> DataFrame:
    """Folds written by ``write_folds`` (``fold=<k>/`` directories); the fold
    column comes from partition discovery, so a filter on it prunes files."""
    df = spark.read.schema(f"{schema}, {fold_col} INT").option("mode", "FAILFAST").csv(directory)
    return df


def read_factors(spark: SparkSession, path: str, d: int, id_type: str = "int",
                 as_array: bool = True) -> DataFrame:
    """Multi-part headerless ``id,f0,..`` files (S4, P9): ``id, features`` or wide."""
    schema = f"id {id_type}, " + ", ".join(f"f{k} double" for k in range(d))
    df = spark.read.schema(schema).option("mode", "FAILFAST").csv(path)
    if as_array:
        return df.select("id", to_array(wide_names(d)).alias("features"))
    return df


def read_lookup(spark: SparkSession, path: str, schema: str = LOOKUP_SCHEMA) -> DataFrame:
    """Item lookup CSV with header (S5); a malformed row fails the job."""
    return spark.read.schema(schema).options(**CSV).option("header", True).option("mode", "FAILFAST").csv(path)


def write_folds(folded: DataFrame, path: str, fmt: str = "csv", fold_col: str = "fold",
                mode: str = "overwrite") -> None:
    """One directory per fold, ``fold=<k>/`` (S6); headerless for CSV."""
    w = folded.write.mode(mode).partitionBy(fold_col)
    if fmt == "csv":
        w.option("header", False).csv(path)
    else:
        w.format(fmt).save(path)


def write_lookup(lookup: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Item lookup as header CSV."""
    lookup.write.mode(mode).options(**CSV).option("header", True).csv(path)


def write_factor_text(factors: DataFrame, path: str, scale: int | None = None,
                      mode: str = "overwrite") -> None:
    """``id,f0,..`` text lines (S8, V8); accepts wide ``f*`` columns or ``features``.

    Values keep all their digits (``scale`` gives a fixed number of decimals
    instead); a null element is an empty field.  Vectors of different lengths
    are an error.
    """
    if "features" in factors.columns:
        d = vector_dim(factors)
        cols = [F.col("features").getItem(k) for k in range(d)]
    else:
        cols = [F.col(c) for c in factors.columns if c.startswith("f") and c[1:].isdigit()]
    factors.select(vector_text("id", cols, scale).alias("value")).write.mode(mode).text(path)


def write_table(df: DataFrame, path: str, fmt: str = "csv", mode: str = "overwrite") -> None:
    """Result tables (distances, top items, ...)."""
    w = df.write.mode(mode)
    if fmt == "csv":
        w.options(**CSV).option("header", True).csv(path)
    else:
        w.format(fmt).save(path)


def read_table(spark: SparkSession, path: str, schema: str | None = None,
               fmt: str = "csv") -> DataFrame:
    """Read back a result table written by ``write_table``."""
    r = spark.read
    if schema:
        r = r.schema(schema)
    if fmt == "csv":
        return r.options(**CSV).option("header", True).option("mode", "FAILFAST").csv(path)
    return r.format(fmt).load(path)


#: Columns of a runs table that a run finds out; all others say which run it is.
RUN_RESULTS = ("n_train", "n_test", "n_scored", "rmse", "mae", "cv_rmse", "cv_mae", "n_folds", "train_rmse", "train_mae")


def append_runs(runs: DataFrame, path: str) -> int:
    """Appends the runs that a parquet runs table does not hold yet (S10); returns how many.

    A run is known by its setting and fold, i.e. by the columns that are no
    result; nulls are equal.  So a repeated append adds nothing.
    """
    keys = [c for c in runs.columns if c not in RUN_RESULTS]
    fresh = runs.dropDuplicates(keys)
    if folder_exists(runs.sparkSession, path):
        old = read_runs(runs.sparkSession, path).select(*[F.col(c).alias(f"_{c}") for c in keys]).distinct()
        same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in keys])
        fresh = fresh.join(old, same, "left_anti")
    fresh = reliable_checkpoint(fresh)  # counted and written from one computation
    n = fresh.count()
    if n:
        fresh.write.mode("append").parquet(path)
    return n


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
