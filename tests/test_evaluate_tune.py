import math

import numpy as np

from ratingspark.operators import evaluate as E
from ratingspark.operators import tune as T


def test_rmse_mae(spark):
    df = spark.createDataFrame([(1.0, 2.0), (3.0, 3.0), (2.0, None), (5.0, 1.0)],
                               "rating double, prediction double")
    r = E.rmse(df).first()
    m = E.mae(df).first()
    assert r.n_scored == 3 and math.isclose(r.rmse, math.sqrt((1 + 0 + 16) / 3))
    assert math.isclose(m.mae, 5 / 3)


def test_item_mean_runs_match_loop(spark):
    rows = [(i % 4, float((i * 7) % 5), i % 3) for i in range(30)] + [(9, 2.0, 0)]
    df = spark.createDataFrame(rows, "item_id bigint, rating double, fold int")
    out = {(r.reg, r.min_count, r.fold): r
           for r in E.item_mean_runs(df, 3, [0.0, 2.0], [0, 3]).collect()}
    arr = np.array([(a, b, c) for a, b, c in rows], dtype=float)
    for h in range(3):
        tr, te = arr[arr[:, 2] != h], arr[arr[:, 2] == h]
        g = tr[:, 1].mean()
        for reg in (0.0, 2.0):
            for mc in (0, 3):
                errs = []
                for item, r, _ in te:
                    sel = tr[tr[:, 0] == item][:, 1]
                    if len(sel) == 0 and mc == 0:
                        continue
                    p = g if len(sel) < mc else (sel.sum() + reg * g) / (len(sel) + reg)
                    errs.append(p - r)
                got = out[(reg, mc, h)]
                assert got.n_scored == len(errs) and got.n_test == len(te)
                assert math.isclose(got.rmse, math.sqrt(np.mean(np.square(errs))))


def test_cv_best_curve(spark):
    # runs_tiny: 3 x 2 grid, 2 folds, one tie for the minimum
    runs = spark.createDataFrame([
        (0.1, 2, 0, 1.0), (0.1, 2, 1, 2.0), (0.1, 4, 0, 1.5), (0.1, 4, 1, 1.5),
        (0.2, 2, 0, 3.0), (0.2, 2, 1, 3.0), (0.2, 4, 0, 2.0), (0.2, 4, 1, 2.0),
        (0.3, 2, 0, 1.4), (0.3, 2, 1, 1.6), (0.3, 4, 0, 2.5), (0.3, 4, 1, 2.5),
    ], "reg double, d int, fold int, rmse double")
    cv = E.cv_error(runs, ["reg", "d"])
    assert cv.count() == 6 and {r.n_folds for r in cv.collect()} == {2}
    best = sorted((r.reg, r.d) for r in T.best_params(cv).collect())
    assert best == [(0.1, 2), (0.1, 4), (0.3, 2)]
    curve = [(r.reg, r.cv_rmse) for r in T.tuning_curve(cv, {"d": 4}, "reg").collect()]
    assert curve == [(0.1, 1.5), (0.2, 2.0), (0.3, 2.5)]


def test_grid_and_append(spark, tmpdir_path):
    settings = T.grid(a=[1, 2], b=[0.5])
    assert settings == [{"a": 1, "b": 0.5}, {"a": 2, "b": 0.5}]
    path = f"{tmpdir_path}/runs"
    out = T.grid_search(
        spark, settings,
        lambda s: spark.createDataFrame([(0, s["a"] * s["b"])], "fold int, rmse double"), path)
    assert out.count() == 2
    assert spark.read.parquet(path).count() == 2
