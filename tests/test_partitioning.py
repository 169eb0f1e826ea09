"""Results do not depend on how the input is partitioned (1, 3 and 8 partitions)."""

import pytest

from ratingspark.operators import evaluate as E
from ratingspark.operators import gradient as G
from ratingspark.operators.folds import assign_folds
from ratingspark.operators.indexing import dense_codes

PARTS = (1, 3, 8)


@pytest.fixture(scope="module")
def ratings(spark):
    rows = [(i % 23, (i * 7) % 31, float(i % 9) / 2) for i in range(600)]
    return spark.createDataFrame(rows, "user_id bigint, item_id bigint, rating double")


def _same(results):
    assert all(r == results[0] for r in results[1:])


def test_dense_codes(ratings):
    names = ratings.selectExpr("concat('n', cast(user_id * 13 % 23 as string)) as name")
    _same([sorted(tuple(r) for r in dense_codes(names.repartition(p), "name", "c").collect())
           for p in PARTS])


def test_item_mean_runs(ratings):
    out = []
    for p in PARTS:
        folded = assign_folds(ratings.repartition(p), k=3, seed=1)
        runs = E.item_mean_runs(folded, 3, [0.0, 2.0], [0, 2]).collect()
        out.append(sorted((r.reg, r.min_count, r.fold, r.n_test, r.n_scored, round(r.rmse, 9))
                          for r in runs))
    _same(out)


def test_gradient_steps(ratings):
    p = G.GDParams(d=2, gain=0.001, maxiter=2, seed=4)
    out = []
    for n in PARTS:
        res = G.train(ratings.repartition(n), p)
        out.append(sorted((r.id, round(r.f0, 9), round(r.f1, 9)) for r in res.U.collect()))
    _same(out)
