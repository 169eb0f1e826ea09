"""What grows with the tables: grids, rows a model, keys in shuffles, cells, fits side by side."""

import numpy as np
from pyspark.sql import functions as F

from ratingspark.operators import als, blocks, cells, descent, gradient
from ratingspark.operators.folds import assign_folds

RATING = "user_id long, item_id long, rating double"


def ratings(spark, users=60, items=40):
    return spark.createDataFrame([(u, i, float((u * 7 + i * 3) % 5)) for u in range(users) for i in range(items)], RATING)


def test_a_large_table_gets_few_strips_and_a_block_a_bucket(spark, monkeypatch):
    monkeypatch.setattr(blocks, "FEW_ROWS", 100)
    wanted = blocks.strips(spark.sparkContext.defaultParallelism, 0)
    made = blocks.write_blocks(gradient._named(ratings(spark), "user_id", "item_id", "rating"), 5)
    try:
        assert made.grid == wanted and made.buckets == wanted * wanted
        assert made.table("user").groupBy("id").count().agg(F.max("count")).first()[0] <= wanted
        buckets = made.ratings.select(F.pmod(F.hash("block"), F.lit(made.buckets)).alias("b"), "block").distinct()
        assert buckets.count() == buckets.select("b").distinct().count() > wanted
        assert made.ratings.count() == 2400
    finally:
        made.drop()
    assert blocks.strips(12, 100 * blocks.STRIP_BYTES) == 100


def test_runs_of_a_bundle_share_a_row(spark):
    rows = gradient._named(assign_folds(ratings(spark), k=2), "user_id", "item_id", "rating", "fold")
    runs = [descent.Run(h, 0.1, 0.1, 2, h) for h in range(2)]
    vectors = descent.Wide(2)
    state = descent.start_state(rows, runs, vectors, lambda ids: descent.hashed_start(ids, 2, 1))
    assert state.columns == ["side", "id", "f0", "f1", "f2", "f3"] and state.count() == 100
    assert [v.d for v in descent.bundled([descent.Run(n, 0.1, 0.1, 3) for n in range(12)], 32)] == [30, 6]


def test_folds_are_dealt_without_keys(spark):
    plan = assign_folds(ratings(spark), k=3)._jdf.queryExecution().optimizedPlan().toString()
    assert "RepartitionByExpression [_key" not in plan and "RepartitionByExpression [_b" in plan


def test_cells_stay_below_the_root_of_the_items(spark, tmpdir_path):
    rng = np.random.default_rng(2)
    items = spark.createDataFrame([(i, "n", "c", rng.normal(size=3).tolist()) for i in range(100)],
                                  "item_id long, item_name string, category string, features array<double>")
    assert cells.write_cells(items, f"{tmpdir_path}/cells", cell_items=1).cells.count() <= 10


def test_large_fits_go_one_after_the_other(spark, monkeypatch):
    seen, real = [], als.run_folds
    monkeypatch.setattr(als, "run_folds", lambda f, k, p: seen.append(p) or real(f, k, p))
    monkeypatch.setattr(als, "ROWS_AT_ONCE", 2400)
    folded = assign_folds(ratings(spark), k=2)
    als.cross_validate(folded, als.ALSParams(rank=2, max_iter=1), 2, parallelism=2)
    assert seen == [1]
