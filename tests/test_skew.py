"""A key holding a third of all rows: results stay exact, work is pre-aggregated."""

import numpy as np
from pyspark.sql import functions as F

from ratingspark.operators import evaluate as E
from ratingspark.operators import gradient as G
from ratingspark.operators.folds import assign_folds


def _skewed(spark, n=3000):
    rows = [(0 if i % 3 == 0 else i, i % 50, float(i % 5 + 1)) for i in range(n)]
    return spark.createDataFrame(rows, "user_id bigint, item_id bigint, rating double"), rows


def test_hot_user_gradients_exact_and_partial(spark):
    R, rows = _skewed(spark)
    U = G.init_factors(R, "user_id", 2, 1, "user")
    V = G.init_factors(R, "item_id", 2, 1, "item")
    grads = G.both_gradients(G.join_predict(R.repartition(6), U, V, 2), 2)
    plan = grads._jdf.queryExecution().executedPlan().toString()
    assert "partial_sum" in plan   # summed before the shuffle
    u = {r.id: np.array([r.f0, r.f1]) for r in U.collect()}
    v = {r.id: np.array([r.f0, r.f1]) for r in V.collect()}
    want = np.zeros(2)
    for a, b, r in rows:
        if a == 0:
            want += (u[a] @ v[b] - r) * v[b]
    got = grads.where((F.col("side") == G.USER) & (F.col("id") == 0)).first()
    assert np.allclose([got.g0, got.g1], want, rtol=1e-12)


def test_hot_item_runs_and_folds(spark):
    R, rows = _skewed(spark)
    hot_item = R.withColumn("item_id", F.when(F.col("user_id") == 0, F.lit(7)).otherwise(F.col("item_id")))
    folded = assign_folds(hot_item, k=4, seed=5)
    sizes = sorted(r[1] for r in folded.groupBy("fold").count().collect())
    assert sizes == [750, 750, 750, 750]
    runs = E.item_mean_runs(folded, 4, [0.0], [0]).collect()
    assert sum(r.n_test for r in runs) == 3000
