import numpy as np
import pytest

from ratingspark.operators import als
from ratingspark.operators.folds import assign_folds
from ratingspark.operators.project import explained_variance, pca_coords


@pytest.fixture(scope="module")
def low_rank(spark):
    # 200 users x 100 items from known rank-2 factors + small noise, 30% observed
    rng = np.random.default_rng(0)
    U, V = rng.normal(size=(200, 2)), rng.normal(size=(100, 2))
    mask = rng.random((200, 100)) < 0.3
    rows = [(int(u), int(i), float(U[u] @ V[i] + rng.normal(scale=0.05)))
            for u, i in zip(*np.nonzero(mask))]
    return spark.createDataFrame(rows, "user_id int, item_id int, rating double")


def test_als_recovers_low_rank(low_rank):
    folded = assign_folds(low_rank, k=3, seed=1)
    out = als.cross_validate(folded, als.ALSParams(rank=2, max_iter=15, reg=0.01), 3)
    rows = out.collect()
    std = np.std([r.rating for r in low_rank.collect()])
    assert all(r.rmse < 0.3 and r.rmse < std / 3 for r in rows)
    assert all(r.n_scored <= r.n_test for r in rows)


def test_cold_start_dropped(spark, low_rank):
    model = als.fit(low_rank, als.ALSParams(rank=2, max_iter=5, reg=0.05))
    test = spark.createDataFrame([(0, 0, 1.0), (999, 0, 1.0), (0, 999, 1.0), (999, 999, 1.0),
                                  (0, 0, 1.0)], "user_id int, item_id int, rating double")
    m = als.metrics(model, test).first()
    assert m.n_scored == 2  # unseen user / item / both dropped; duplicate pair scored twice
    U, V = als.factors(model)
    assert U.count() == 200 and V.count() == 100


def test_train_all_and_grid(spark, low_rank):
    _, m = als.train_all(low_rank, als.ALSParams(rank=2, max_iter=10, reg=0.01))
    assert m["train_rmse"] < 0.2 and m["n_scored"] == m["n_train"]
    runs = als.grid_runs(assign_folds(low_rank, k=2), [0.01, 0.5], [2], 2,
                         base=als.ALSParams(max_iter=5))
    assert runs.count() == 4 and set(runs.columns) >= {"reg", "rank", "fold", "rmse"}


def test_pca_centres_and_fixes_signs(spark):
    # pca_line: points on a known line, offset far from the origin
    t = np.linspace(-3, 3, 25)
    direction = np.array([3.0, 4.0, 0.0]) / 5
    pts = [(i, [float(100 + x * direction[0]), float(-50 + x * direction[1]), 7.0])
           for i, x in enumerate(t)]
    df = spark.createDataFrame(pts, "item_id int, features array<double>")
    rows = sorted(pca_coords(df, k=2).collect())
    pc1 = np.array([r.pc1 for r in rows])
    assert np.allclose(pc1, t, atol=1e-9)   # centred, and sign fixed by the largest loading
    assert np.allclose([r.pc2 for r in rows], 0, atol=1e-9)
    assert explained_variance(df, 1)[0] > 0.999


def test_dense_ids_for_large_and_string_ids(spark, low_rank):
    big = low_rank.selectExpr("concat('u', cast(user_id as string)) as user_id",
                              "cast(item_id as bigint) * 10000000000 as item_id", "rating")
    fitted = als.fit(big, als.ALSParams(rank=2, max_iter=10, reg=0.01))
    U, V = als.factors(fitted)
    assert U.count() == 200 and V.where("id >= 10000000000 or id = 0").count() == 100
    test = big.limit(5).union(spark.createDataFrame([("nobody", 1, 1.0)], big.schema))
    scored = als.score(fitted, test)
    assert scored.count() == 5 and {"user_id", "item_id", "prediction"} <= set(scored.columns)
    m = als.metrics(fitted, big).first()
    assert m.n_scored == big.count() and m.rmse < 0.2
    folded = assign_folds(big, k=2)
    out = als.cross_validate(folded, als.ALSParams(rank=2, max_iter=5, reg=0.01), 2)
    assert out.count() == 2


def test_write_factors_roundtrip(spark, low_rank, tmpdir_path):
    from ratingspark.operators import gradient
    from ratingspark.sources.files import read_factors
    fitted = als.fit(low_rank, als.ALSParams(rank=2, max_iter=3, reg=0.05))
    als.write_factors(fitted, f"{tmpdir_path}/als")
    U = read_factors(spark, f"{tmpdir_path}/als/u.csv", 2, id_type="bigint")
    assert U.count() == 200
    res = gradient.train(low_rank, gradient.GDParams(d=2, gain=0.0001, maxiter=1))
    gradient.write_factors(res, f"{tmpdir_path}/gd")
    V = read_factors(spark, f"{tmpdir_path}/gd/v.csv", 2, id_type="bigint")
    assert V.count() == 100


def test_large_fit_keeps_its_blocks_on_disk(spark, monkeypatch):
    rows = spark.createDataFrame([(u, i, float((u * i) % 5)) for u in range(8) for i in range(6)], "user_id long, item_id long, rating double")
    levels, errors, fit = [], [], als.ALS.fit
    monkeypatch.setattr(als.ALS, "fit", lambda self, df: levels.append(self.getIntermediateStorageLevel()) or fit(self, df))
    for most in (48, 47):
        monkeypatch.setattr(als, "ROWS_AT_ONCE", most)
        errors.append(als.train_all(rows, als.ALSParams(rank=2, max_iter=2))[1])
    assert levels == ["MEMORY_AND_DISK", "DISK_ONLY"] and errors[0] == errors[1]
