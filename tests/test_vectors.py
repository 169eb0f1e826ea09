import math

import numpy as np
import pytest

from ratingspark.operators import similar
from ratingspark.operators import vectors as V

ITEM_DDL = "item_id bigint, item_name string, category string, category_id bigint, " \
           "rating double, features array<double>"

# vectors_tiny: 2-D points with whole-number distances (3-4-5) and one exact copy
TINY = [
    (1, "a", "X", 0, 4.0, [0.0, 0.0]),
    (2, "b", "X", 0, 3.0, [3.0, 0.0]),
    (3, "c", "Y", 1, 5.0, [0.0, 4.0]),
    (4, "d", "Y", 1, 2.0, [3.0, 4.0]),
    (5, "e", "Z", 2, 1.0, [6.0, 8.0]),
    (6, "f", "Z", 2, 4.5, [0.0, 0.0]),   # exact copy of item 1
]


@pytest.fixture()
def items(spark):
    return spark.createDataFrame(TINY, ITEM_DDL)


def test_nearest_items_drops_zero_and_orders(items):
    rows = similar.nearest_items(items, [0.0, 0.0]).collect()
    assert [r.item_id for r in rows] == [2, 3, 4, 5]   # 1 and its copy 6 removed
    assert [r.distance for r in rows] == [3.0, 4.0, 5.0, 10.0]


def test_exclude_ids_keeps_copies(items):
    rows = similar.nearest_items(items, [0.0, 0.0], drop_zero=False, exclude_ids=[1]).collect()
    assert [r.item_id for r in rows][0] == 6


def test_top_similar_inverse(items):
    rows = similar.top_similar(similar.nearest_items(items, [0.0, 0.0]), k=2).collect()
    assert [(r.item_id, r.similarity) for r in rows] == [(2, 1 / 3), (3, 0.25)]


def test_centroids(items):
    got = {r.category_id: (r.n_items, list(r.features))
           for r in V.category_centroids(items).collect()}
    assert got == {0: (2, [1.5, 0.0]), 1: (2, [1.5, 4.0]), 2: (2, [3.0, 4.0])}


def test_probe_from_items_order_of_names(items):
    probe, names = V.collect_probe(V.probe_from_items_frame(items, [4, 2]))
    assert probe == [3.0, 2.0] and names == "d, b"


def test_probe_from_categories_equal_weights(spark):
    rows = TINY + [(7, "g", "X", 0, 1.0, [0.0, 0.0]), (8, "h", "X", 0, 1.0, [0.0, 0.0])]
    items = spark.createDataFrame(rows, ITEM_DDL)
    probe, names = V.collect_probe(V.probe_from_categories_frame(items, [0, 2]))
    # centroid X = (0.75, 0), centroid Z = (3, 4): each weighs one half
    assert np.allclose(probe, [1.875, 2.0]) and names == "X, Z"


def test_nearest_categories(items):
    rows = similar.nearest_categories(items, [1.5, 0.0]).collect()
    assert [(r.category_id, r.category) for r in rows] == [(1, "Y"), (2, "Z")]
    assert math.isclose(rows[0].distance, 4.0) and math.isclose(rows[1].distance, math.sqrt(18.25))


def test_top_items_keep_names(items):
    rows = similar.top_items(items, [0, 2]).collect()
    assert [r.item_id for r in rows] == [6, 1, 2, 5]
    assert all(r.item_name is not None for r in rows)


def test_items_by_category_last_listed_wins(spark):
    lookup = spark.createDataFrame(
        [(1, 5), (1, 7), (2, 5), (3, 9)], "item_id bigint, category_id bigint")
    got = {r.item_id: (r.category_id, r.position)
           for r in V.items_by_category(lookup, [7, 5, 7]).collect()}
    # item 1 is in 5 and 7; 7 is listed last -> 7, first index of 7 is 0
    assert got == {1: (7, 0), 2: (5, 1)}


def test_report_requires_ids(items):
    with pytest.raises(ValueError):
        similar.similarity_report(items)
    with pytest.raises(ValueError):
        similar.similarity_report(items, item_ids=[99])


def test_report_items_win_over_categories(items):
    rows = similar.similarity_report(items, item_ids=[2], category_ids=[2], k=3).collect()
    assert rows[0].probe == "b"
    assert {r.kind for r in rows} == {"item", "category"}


def test_empty_lists(items):
    assert similar.top_items(items, []).count() == 0
    with pytest.raises(ValueError):
        V.probe_from_categories_frame(items, [])
    with pytest.raises(ValueError):
        V.probe_from_items_frame(items, [])


def test_distance_symmetric(spark):
    from ratingspark.functions.vectors import l2_between
    df = spark.createDataFrame([([1.0, 2.0, 3.0], [4.0, 0.0, -1.0])], "a array<double>, b array<double>")
    r = df.select(l2_between("a", "b", 3).alias("ab"), l2_between("b", "a", 3).alias("ba")).first()
    assert r.ab == r.ba == math.sqrt(9 + 4 + 16)


def test_write_outputs(spark, items, tmpdir_path):
    from ratingspark.sources.files import read_table
    label = similar.write_outputs(items, tmpdir_path, item_ids=[2], top_categories=[0])
    assert label == "b"
    d = read_table(spark, f"{tmpdir_path}/item_distances",
                   "item_id bigint, item_name string, category string, distance double")
    assert d.count() == 5   # item 2 itself (distance 0) is dropped
    assert read_table(spark, f"{tmpdir_path}/category_distances").count() == 3
    assert read_table(spark, f"{tmpdir_path}/top_items").count() == 2
