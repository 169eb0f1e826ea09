"""Results do not depend on sizes, chunks or hidden limits, and nothing is dropped silently."""

import pytest
from pyspark.sql import functions as F

from ratingspark.operators import als, evaluate, gradient, vectors
from ratingspark.operators.folds import assign_folds, fold_counts
from ratingspark.session import sized_checkpoint

RATING = "user_id long, item_id long, rating double"


@pytest.mark.parametrize("method", ["exact", "hash"])
def test_folds_do_not_depend_on_the_chunk_size(spark, method):
    rows = [(1, 1, 1.0)] * 40 + [(i, i, 2.0) for i in range(2, 42)]
    df = spark.createDataFrame(rows, RATING)
    for seed in range(4):
        few, many = (sorted(map(tuple, assign_folds(df, k=5, seed=seed, method=method, chunk_rows=c).collect()))
                     for c in (5, 1000))
        assert few == many and len(few) == 80


def test_folds_beyond_k_are_counted_or_refused(spark):
    df = spark.createDataFrame([(u, u % 9, float(u % 5), u % 8) for u in range(400)] + [(1, 1, 1.0, None)],
                               f"{RATING}, fold int")
    counts = fold_counts(df, 5).collect()
    assert sorted(r.fold for r in counts) == list(range(8))
    assert sum(r.n_test for r in counts) == 400 and all(r.n_train + r.n_test == 401 for r in counts)
    with pytest.raises(ValueError, match="fold"):
        evaluate.item_mean_runs(df, 5, [0.0], [1])
    with pytest.raises(ValueError, match="folds"):
        als.cross_validate(df, als.ALSParams(rank=2, max_iter=1), 5)
    with pytest.raises(ValueError, match="folds"):
        gradient.cross_validate(df, gradient.GDParams(d=2, maxiter=1), 5)
    runs = evaluate.item_mean_runs(df, 8, [0.0], [1])
    assert runs.agg(F.sum("n_test")).first()[0] == 400


def test_als_depends_on_the_order_of_ids_only(spark):
    rows = [(u, i, float((u * 7 + i * 3) % 5)) for u in range(30) for i in range(20) if (u + i) % 3]
    params = als.ALSParams(rank=2, max_iter=3, reg=0.1)
    plain = als.train_all(spark.createDataFrame(rows, RATING), params)[1]
    wide = [(u, i if i < 19 else 1 << 40, r) for u, i, r in rows]
    nulls = [(None, 1, 3.0), (1, None, 3.0), (1, 1, None)]
    other = als.train_all(spark.createDataFrame(wide + nulls, RATING), params)[1]
    assert other["n_train"] == plain["n_train"] == len(rows)
    assert other["train_rmse"] == pytest.approx(plain["train_rmse"], abs=1e-9)


def test_users_solve_their_equations(spark):
    rows = spark.createDataFrame([(u, i, float((u * 7 + i * 3) % 5)) for u in range(30) for i in range(20) if (u + i) % 3], RATING)
    fitted = als.fit(rows, als.ALSParams(rank=3, max_iter=4, reg=0.1))
    assert als.user_equations(fitted, rows, 0.1).where("ok").count() == 30
    assert als.user_equations(fitted, rows, 0.5).where("ok").count() == 0


def test_null_elements_and_missing_ids_of_vectors(spark):
    items = spark.createDataFrame([(1, "a", 7, "x", [1.0, None]), (2, "b", 7, "x", [3.0, 4.0])],
                                  "item_id long, item_name string, category_id long, category string, features array<double>")
    assert list(vectors.category_centroids(items).first().features) == [2.0, 4.0]
    assert vectors.collect_probe(vectors.probe_from_items_frame(items, [1, 2]), expected=[1, 2])[0] == [2.0, 4.0]
    with pytest.raises(ValueError, match="only 1 of the 2"):
        vectors.collect_probe(vectors.probe_from_items_frame(items, [2, 999]), expected=[2, 999])
    with pytest.raises(ValueError, match="only 1 of the 2"):
        vectors.collect_probe(vectors.probe_from_categories_frame(items, [7, 8]), expected=[7, 8])
    with pytest.raises(ValueError, match="without any value"):
        vectors.collect_probe(vectors.probe_from_items_frame(items, [1]), expected=[1])
    ragged = items.withColumn("features", F.slice("features", F.lit(1), F.col("item_id").cast("int")))
    with pytest.raises(ValueError, match="lengths"):
        vectors.category_centroids(ragged)


def test_broadcast_bound_counts_bytes(spark):
    wide = spark.createDataFrame([("\u20ac" * 1000,)] * 100, "s string")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "200000b")
        assert not sized_checkpoint(wide)[1]  # 100,000 characters are 300,000 bytes
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_a_gradient_step_reads_the_ratings_once(spark, tmpdir_path):
    spark.createDataFrame([(u, i, 1.0) for u in range(9) for i in range(9)], RATING).write.parquet(f"{tmpdir_path}/r")
    rated = spark.read.parquet(f"{tmpdir_path}/r")
    state = gradient.init_both(rated, 2, 1).checkpoint()
    fs = ["id", "f0", "f1"]
    U, V = (state.where(F.col("side") == s).select(fs) for s in (gradient.USER, gradient.ITEM))
    for small in (True, False):
        joined = gradient.join_predict(rated, U, V, 2, broadcast_u=small, broadcast_v=small)
        new = gradient.apply_step(state, gradient.both_gradients(joined, 2), 0.01, F.lit(0.1), 2, keys=("side", "id"))
        plan = new._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("Generate explode") == 1 and plan.count("] parquet") == 1


def test_fifty_steps_leave_three_generations(spark):
    rows = spark.createDataFrame([(u, i, float((u + i) % 4)) for u in range(20) for i in range(15)], RATING)
    res = gradient.train(rows, gradient.GDParams(d=2, gain=0.001, maxiter=50, epsilon=0.0))
    objectives = [h["objective"] for h in res.history]
    assert len(objectives) == 50 and objectives[-1] < objectives[0]
    assert res.U.count() == 20 and res.V.count() == 15
