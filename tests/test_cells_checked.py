"""Items by cell, checked reads, runs tables without repeats, errors from factor files."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from ratingspark.operators import als, cells, evaluate, similar, tune
from ratingspark.operators.folds import assign_folds
from ratingspark.sources import files

ITEM = "item_id long, item_name string, category string, features array<double>"


@pytest.fixture(scope="module")
def clustered(spark):
    rng = np.random.default_rng(1)
    centres = rng.normal(scale=20, size=(12, 6))
    rows = [(i, f"n{i}", "c", (centres[i % 12] + rng.normal(size=6)).tolist()) for i in range(1200)]
    rows += [(5000 + i, "copy", "c", rows[3][3]) for i in range(5)]  # repeated vectors
    return rows, spark.createDataFrame(rows, ITEM)


def test_cells_equal_the_full_scan_and_read_less(spark, clustered, tmpdir_path):
    rows, items = clustered
    index = cells.write_cells(items, f"{tmpdir_path}/cells", cell_items=60)
    assert index.cells.count() > 5 and index.items.count() == len(rows)
    for probe in (rows[3][3], rows[100][3], [0.0] * 6, [500.0] * 6):
        for k, drop in ((1, True), (15, True), (15, False), (400, True), (5000, True)):
            got, read = index.nearest(probe, k, drop_zero=drop)
            want = similar.nearest_items(items, probe, drop_zero=drop).limit(k).collect()
            assert [(r.item_id, r.distance) for r in got.collect()] == [(r.item_id, r.distance) for r in want]
    _, read = index.nearest(rows[100][3], 15)
    assert read < len(rows) / 3


def test_cells_of_few_or_unusable_vectors(spark, tmpdir_path):
    bad = [(1, "a", "c", None), (2, "b", "c", [1.0, None]), (3, "c", "c", [float("nan"), 1.0]), (4, "d", "c", [1.0, 2.0])]
    index = cells.write_cells(spark.createDataFrame(bad, ITEM), f"{tmpdir_path}/few", cell_items=1)
    assert [r.item_id for r in index.nearest([0.0, 0.0], 3)[0].collect()] == [4]
    none = cells.write_cells(spark.createDataFrame([], ITEM), f"{tmpdir_path}/none")
    assert none.nearest([0.0], 2)[0].count() == 0
    with pytest.raises(ValueError, match="exists"):
        cells.write_cells(spark.createDataFrame([], ITEM), f"{tmpdir_path}/none")
    with pytest.raises(ValueError, match="lengths"):
        cells.write_cells(spark.createDataFrame([(1, "a", "c", [1.0]), (2, "b", "c", [1.0, 2.0])], ITEM), f"{tmpdir_path}/ragged")


def test_checked_reads_split_a_file(spark, tmpdir_path):
    lines = ["1,2,3.5", "1,x,3", "2,2", "3,4,5,6", ",4,1", "5,5,", "7,8,nine", "9,9,2"]
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(f"{tmpdir_path}/r")
    found = files.read_checked(spark, f"{tmpdir_path}/r", files.RATING_SCHEMA)
    assert sorted(map(tuple, found.clean.collect()), key=str) == sorted([(1, 2, 3.5), (None, 4, 1.0), (5, 5, None), (9, 9, 2.0)], key=str)
    assert sorted(r.line for r in found.rejected.collect()) == sorted(["1,x,3", "2,2", "3,4,5,6", "7,8,nine"])
    assert found.rejected.where(F.col("file").contains("/r/")).count() == 4
    assert {r.kind: r.n for r in found.counts.collect()} == {"clean": 4, "rejected": 4}
    with pytest.raises(Exception):
        files.read_ratings(spark, f"{tmpdir_path}/r").collect()


def test_checked_reviews(spark, tmpdir_path):
    path = f"{tmpdir_path}/reviews.csv"
    with open(path, "w") as f:
        f.write("review_overall,extra,review_profilename,beer_beerid,beer_name,beer_style\n")
        f.write('4.5,e,ann,7,"a ""b"", c",ipa\nbad,e,bob,8,n,ipa\n3,e,cy,ten,n,ipa\n2,,dee,9,n,\n')
    found = files.read_reviews_checked(spark, path)
    assert found.clean.columns == ["user_name", "item_id", "item_name", "category", "rating", "extra"]
    assert {tuple(r) for r in found.clean.collect()} == {("ann", 7, 'a "b", c', "ipa", 4.5, "e"), ("dee", 9, "n", None, 2.0, None)}
    assert {r.kind: r.n for r in found.counts.collect()} == {"clean": 2, "rejected": 2}
    with pytest.raises(ValueError, match="no columns"):
        files.read_reviews_checked(spark, path, [("nothing", "string", "x")])


def test_repeated_appends_add_nothing(spark, tmpdir_path):
    path = f"{tmpdir_path}/runs"
    runs = spark.createDataFrame([(0.1, None, 0, 1.0), (0.1, None, 1, 2.0)], "reg double, d int, fold int, rmse double")
    assert files.append_runs(runs, path) == 2 and files.append_runs(runs, path) == 0
    more = spark.createDataFrame([(0.1, None, 1, 9.0), (0.1, 3, 1, 4.0)], runs.schema)
    assert files.append_runs(more, path) == 1
    assert sorted(r.rmse for r in files.read_runs(spark, path).collect()) == [1.0, 2.0, 4.0]


def test_a_stopped_search_goes_on(spark, tmpdir_path):
    path, asked = f"{tmpdir_path}/search", []

    def run(setting, folds):
        asked.append((setting["a"], list(folds)))
        return spark.createDataFrame([(h, float(setting["a"] + h)) for h in folds], "fold int, rmse double")

    files.append_runs(spark.createDataFrame([(1, 1.0, 1)], "fold int, rmse double, a int"), path)
    out = tune.grid_search(spark, tune.grid(a=[1, 2]), run, path, folds=range(2))
    assert asked == [(1, [0]), (2, [0, 1])]
    assert sorted((r.a, r.fold) for r in out.collect()) == [(1, 0), (1, 1), (2, 0), (2, 1)]
    again = tune.grid_search(spark, tune.grid(a=[1, 2]), run, path, folds=range(2))
    assert len(asked) == 2 and again.count() == 4 and spark.read.parquet(path).count() == 4


def test_errors_from_factor_files_are_the_models(spark, tmpdir_path):
    rows = [(u, i, float((u * 7 + i * 3) % 5)) for u in range(40) for i in range(25) if (u + i) % 3]
    folded = assign_folds(spark.createDataFrame(rows + [(99, 3, 2.0), (5, 77, 1.0)], "user_id long, item_id long, rating double"), k=3)
    cv = {r.fold: r for r in als.cross_validate(folded, als.ALSParams(rank=3, max_iter=3, reg=0.1), 3, export_dir=tmpdir_path).collect()}
    U, V = als.read_exported(spark, tmpdir_path, 3, 3)
    again = {r.fold: r for r in evaluate.factor_errors(folded, U, V, by=["fold"]).collect()}
    assert cv.keys() == again.keys() == {0, 1, 2}
    for h in cv:
        assert cv[h].n_scored == again[h].n_scored < cv[h].n_test or cv[h].n_scored == cv[h].n_test
        assert math.isclose(cv[h].rmse, again[h].rmse, rel_tol=1e-5) and math.isclose(cv[h].mae, again[h].mae, rel_tol=1e-5)
    wrong = evaluate.factor_errors(folded, U.withColumn("fold", (F.col("fold") + 1) % 3), V, by=["fold"]).collect()
    assert any(not math.isclose(cv[r.fold].rmse, r.rmse, rel_tol=1e-3) for r in wrong)


def test_als_grid_reads_finished_runs(spark, tmpdir_path):
    rows = [(u, i, float((u + i) % 5)) for u in range(20) for i in range(15)]
    folded = assign_folds(spark.createDataFrame(rows, "user_id long, item_id long, rating double"), k=2).checkpoint()
    base, path = als.ALSParams(max_iter=2), f"{tmpdir_path}/runs"
    first = als.grid_runs(folded, [0.1], [2], 2, base=base, runs_path=path).collect()
    both = als.grid_runs(folded, [0.1, 0.5], [2], 2, base=base, runs_path=path)
    assert both.count() == 4 and files.read_runs(spark, path).count() == 4
    assert {(r.reg, r.fold, r.rmse) for r in first} <= {(r.reg, r.fold, r.rmse) for r in both.collect()}
