"""Explore stage, answers: nearest items, nearest categories, top items.

Distances are one projection over the item data with the probe inlined; the
only sort is the final ordering (range-partitioned) or a top-k
(``TakeOrderedAndProject``: per-partition heaps, k rows per task).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import defaults as D
from ..functions.vectors import inverse_distance, l2_to_probe
from ..sources.files import write_table
from . import vectors as V


def nearest_items(items: DataFrame, probe: Sequence[float], id_col: str = "item_id",
                  name_col: str = "item_name", cat_col: str = "category",
                  features: str = "features", drop_zero: bool = True,
                  exclude_ids: Sequence[int] | None = None) -> DataFrame:
    """Items ordered by distance to the probe.

    By default zero distances are dropped, which removes the probe itself and
    exact copies of it; ``exclude_ids`` drops named ids instead.
    """
    out = items.select(id_col, name_col, cat_col, l2_to_probe(features, probe).alias("distance"))
    if drop_zero:
        out = out.where(F.col("distance") != F.lit(0.0))
    if exclude_ids:
        out = out.where(~F.col(id_col).isin([int(i) for i in exclude_ids]))
    return out.orderBy(F.col("distance").asc(), F.col(id_col).asc())


def nearest_categories(items: DataFrame, probe: Sequence[float], key_col: str = "category_id",
                       name_col: str = "category", features: str = "features",
                       drop_zero: bool = True) -> DataFrame:
    """Category centroids ordered by distance to the probe."""
    cents = V.category_centroids(items, key_col, d=len(probe), features=features)
    names = items.select(key_col, name_col).dropDuplicates()
    dist = cents.select(key_col, l2_to_probe(features, probe).alias("distance"))
    out = dist.join(names, key_col, "inner").select(key_col, name_col, "distance")
    if drop_zero:
        out = out.where(F.col("distance") != F.lit(0.0))
    return out.orderBy(F.col("distance").asc(), F.col(key_col).asc())


def top_similar(distances: DataFrame, k: int = D.TOP_SIMILAR, id_col: str = "item_id") -> DataFrame:
    """The ``k`` closest rows with similarity = 1/distance (L3, V6)."""
    top = distances.orderBy(F.col("distance").asc(), F.col(id_col).asc()).limit(k)
    return top.withColumn("similarity", inverse_distance("distance"))


def top_items(items: DataFrame, category_ids: Sequence[int], id_col: str = "item_id",
              key_col: str = "category_id", name_col: str = "item_name",
              rating_col: str = "rating") -> DataFrame:
    """Items of the chosen categories by mean rating, best first.

    Every item keeps its own name(s): names are joined back by item id, not
    de-duplicated by name.
    """
    chosen = items.where(F.col(key_col).isin([int(c) for c in category_ids]))
    means = chosen.groupBy(id_col).agg(F.avg(key_col).alias(key_col),
                                       F.avg(rating_col).alias(rating_col))
    names = items.select(id_col, name_col).dropDuplicates()
    return (means.join(names, id_col, "left")
            .orderBy(F.col(rating_col).desc(), F.col(id_col).asc()))


def similarity_report(items: DataFrame, item_ids: Sequence[int] | None = None,
                      category_ids: Sequence[int] | None = None, k: int = D.TOP_SIMILAR,
                      d: int | None = None) -> DataFrame:
    """Probe from items (preferred) or categories -> top-k items and categories.

    Returns ``kind, id, name, distance, similarity, probe`` (``kind`` is
    'item' or 'category'; ``probe`` names what the probe was built from).
    """
    if item_ids:
        V.check_ids_present(items, item_ids, "item_id")
        frame = V.probe_from_items_frame(items, item_ids, d=d)
    elif category_ids:
        V.check_ids_present(items, category_ids, "category_id")
        frame = V.probe_from_categories_frame(items, category_ids, d=d)
    else:
        raise ValueError("give item ids or category ids")
    probe, names = V.collect_probe(frame, expected=item_ids or category_ids)
    near_items = top_similar(nearest_items(items, probe), k, "item_id")
    near_cats = top_similar(nearest_categories(items, probe), k, "category_id")
    rank_items = near_items.select(
        F.lit("item").alias("kind"), F.col("item_id").alias("id"),
        F.col("item_name").alias("name"), "distance", "similarity")
    rank_cats = near_cats.select(
        F.lit("category").alias("kind"), F.col("category_id").alias("id"),
        F.col("category").alias("name"), "distance", "similarity")
    return rank_items.unionByName(rank_cats).withColumn("probe", F.lit(names))


def write_outputs(items: DataFrame, directory: str, item_ids: Sequence[int] | None = None,
                  category_ids: Sequence[int] | None = None,
                  top_categories: Sequence[int] | None = None) -> str:
    """Write the explore stage's tables (S9) and return the probe's label.

    ``item_distances`` and ``category_distances`` (all rows, by distance) for
    the probe built from ``item_ids`` (preferred) or ``category_ids``, and
    ``top_items`` of ``top_categories`` when given; header CSV, one directory
    each.
    """
    if item_ids:
        V.check_ids_present(items, item_ids, "item_id")
        frame = V.probe_from_items_frame(items, item_ids)
    elif category_ids:
        V.check_ids_present(items, category_ids, "category_id")
        frame = V.probe_from_categories_frame(items, category_ids)
    else:
        raise ValueError("give item ids or category ids")
    probe, names = V.collect_probe(frame, expected=item_ids or category_ids)
    out = directory.rstrip("/")
    write_table(nearest_items(items, probe), f"{out}/item_distances")
    write_table(nearest_categories(items, probe), f"{out}/category_distances")
    if top_categories:
        write_table(top_items(items, top_categories), f"{out}/top_items")
    return names
