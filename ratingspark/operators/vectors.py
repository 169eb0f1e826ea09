"""Explore stage, vector side: item data, centroids and probe vectors.

Item data is the lookup joined with learned (or given) vectors.  Centroids
are per-dimension sums in one hash aggregate over wide columns: no list of
vectors is ever collected per group, so a category holding a third of all
items is just partial sums on every map task.

A probe is ``d`` doubles.  It is computed by an aggregate and brought to the
driver as a bounded value, then inlined into distance expressions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.vectors import to_array, vector_dim


def attach_vectors(lookup: DataFrame, vectors: DataFrame, id_col: str = "item_id") -> DataFrame:
    """Item data: lookup rows inner-joined with their vectors."""
    return lookup.join(vectors, on=id_col, how="inner")


def _list_frame(spark: SparkSession, values: Sequence[int], name: str) -> DataFrame:
    """(value, position) rows for a user-given list (bounded by the list)."""
    rows = [(int(v), i) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, f"{name} bigint, position int")


def items_by_category(lookup: DataFrame, category_ids: Sequence[int], id_col: str = "item_id",
                      cat_col: str = "category_id") -> DataFrame:
    """Items of the requested categories, tagged with category and list position.

    An item listed under several requested categories takes the one listed
    last; ``position`` is the first index of that category in the list.
    The choice is a hash aggregate: (last position, index of the category in
    the requested list) is packed into one long and maximized per item, then
    decoded through the list table (bounded by the list).
    """
    spark = lookup.sparkSession
    first_pos, last_pos = {}, {}
    for i, c in enumerate(int(v) for v in category_ids):
        first_pos.setdefault(c, i)
        last_pos[c] = i
    cats = sorted(first_pos)
    width = len(cats)
    wanted = spark.createDataFrame(
        [(c, idx, first_pos[c], last_pos[c]) for idx, c in enumerate(cats)],
        f"{cat_col} bigint, _idx int, position int, _last int")
    tagged = lookup.select(id_col, cat_col).join(F.broadcast(wanted), cat_col)
    packed = F.col("_last").cast("bigint") * F.lit(width) + F.col("_idx")
    best = tagged.groupBy(id_col).agg(F.max(packed).alias("_p"))
    best = best.select(id_col, F.pmod(F.col("_p"), F.lit(width)).cast("int").alias("_idx"))
    return best.join(F.broadcast(wanted.select("_idx", cat_col, "position")), "_idx").select(
        id_col, cat_col, "position")


def vectors_by_category(vectors: DataFrame, lookup: DataFrame, category_ids: Sequence[int],
                        id_col: str = "item_id") -> DataFrame:
    """Vectors of the items of the requested categories."""
    return items_by_category(lookup, category_ids, id_col=id_col).join(vectors, on=id_col)


def centroid_sums(items: DataFrame, key_col: str, d: int, features: str = "features") -> DataFrame:
    """Per-key counts, element sums and non-null elements: ``key, n, s0.., n0..`` (hash aggregate)."""
    f = F.col(features)
    aggs = [F.count(F.lit(1)).alias("n")] + [F.sum(f.getItem(k)).alias(f"s{k}") for k in range(d)]
    aggs += [F.count(f.getItem(k)).alias(f"n{k}") for k in range(d)]
    return items.groupBy(key_col).agg(*aggs)


def _element_mean(k: int) -> Column:
    """Mean of element ``k`` over its non-null values (null without any)."""
    return F.when(F.col(f"n{k}") > 0, F.col(f"s{k}") / F.col(f"n{k}"))


def category_centroids(items: DataFrame, key_col: str = "category_id", d: int | None = None,
                       features: str = "features") -> DataFrame:
    """Element-wise mean vector per category (A8): ``key, n_items, features``."""
    d = d if d is not None else vector_dim(items, features)
    sums = centroid_sums(items, key_col, d, features)
    mean = to_array([_element_mean(k) for k in range(d)])
    return sums.select(key_col, F.col("n").alias("n_items"), mean.alias(features))


def probe_from_items_frame(items: DataFrame, item_ids: Sequence[int], d: int | None = None,
                           id_col: str = "item_id", name_col: str = "item_name",
                           features: str = "features") -> DataFrame:
    """One row ``(names, n_rows, n_found, features)``: mean vector of chosen items.

    ``n_found`` counts the requested ids that occur.  Names are joined with ", " in the order the ids were given.
    """
    if not item_ids:
        raise ValueError("no item ids given")
    d = d if d is not None else vector_dim(items, features)
    spark = items.sparkSession
    chosen = items.join(F.broadcast(_list_frame(spark, item_ids, id_col)), id_col)
    f = F.col(features)
    names = F.array_join(F.transform(
        F.array_sort(F.collect_list(F.struct(F.col("position"), F.col(name_col)))),
        lambda s: s[name_col]), ", ")
    aggs = [names.alias("names"), F.count(F.lit(1)).alias("n_rows"),
            F.size(F.collect_set(id_col)).alias("n_found")]  # at most the ids asked for
    aggs += [F.avg(f.getItem(k)).alias(f"m{k}") for k in range(d)]
    out = chosen.agg(*aggs)
    return out.select("names", "n_rows", "n_found", to_array([f"m{k}" for k in range(d)]).alias(features))


def probe_from_categories_frame(items: DataFrame, category_ids: Sequence[int],
                                d: int | None = None, key_col: str = "category_id",
                                name_col: str = "category",
                                features: str = "features") -> DataFrame:
    """One row ``(names, n_rows, n_found, features)``: mean of the chosen category centroids (A10).

    Every listed category weighs the same, whatever its item count.
    """
    if not category_ids:
        raise ValueError("no category ids given")
    d = d if d is not None else vector_dim(items, features)
    spark = items.sparkSession
    wanted = _list_frame(spark, category_ids, key_col)
    keys = [int(c) for c in set(category_ids)]
    chosen_items = items.where(F.col(key_col).isin(keys))
    # per category: element sums (hash aggregate); names come from a distinct table
    sums = centroid_sums(chosen_items, key_col, d, features)
    cents = sums.select(key_col, *[_element_mean(k).alias(f"c{k}") for k in range(d)])
    # the names of each category (one per code) travel with its centroid
    names = (chosen_items.select(key_col, F.col(name_col).alias("_name")).distinct()
             .groupBy(key_col).agg(F.collect_set("_name").alias("_names")))
    per_list = cents.join(names, key_col).join(F.broadcast(wanted), key_col)
    label = F.array_join(F.array_sort(F.array_distinct(F.flatten(F.collect_list("_names")))), ", ")
    mean = per_list.agg(label.alias("names"), F.count(F.lit(1)).alias("n_rows"),
                        F.size(F.collect_set(key_col)).alias("n_found"),
                        *[F.avg(f"c{k}").alias(f"m{k}") for k in range(d)])
    return mean.select("names", "n_rows", "n_found", to_array([f"m{k}" for k in range(d)]).alias(features))


def collect_probe(frame: DataFrame, features: str = "features",
                  expected: Sequence[int] | None = None) -> tuple[list[float], str]:
    """Bring a one-row probe frame to the driver (``d`` doubles and a label).

    With the requested ids in ``expected``, an id that was not found is an error.
    """
    row = frame.first()
    if row is None or row[features] is None or row["n_rows"] == 0:
        raise ValueError(f"none of the requested ids were found: {list(expected or [])}")
    asked = len({int(i) for i in expected or []})
    if row["n_found"] < asked:
        raise ValueError(f"only {row['n_found']} of the {asked} requested ids were found: {list(expected)}")
    if any(x is None for x in row[features]):
        raise ValueError("the probe has elements without any value")
    return [float(x) for x in row[features]], row["names"]


def check_ids_present(items: DataFrame, ids: Sequence[int], id_col: str) -> None:
    """Raise ValueError naming requested ids that do not occur (Q13)."""
    found = {r[0] for r in items.where(F.col(id_col).isin([int(i) for i in set(ids)]))
             .select(id_col).distinct().collect()}
    missing = sorted({int(i) for i in ids} - found)
    if missing:
        raise ValueError(f"unknown {id_col}: {missing}")
