import numpy as np
import pytest
from pyspark.sql import functions as F

from ratingspark.operators.folds import assign_folds, fold_counts, fold_split


def _sizes(df, k):
    got = dict(df.groupBy("fold").count().collect())
    return [got.get(i, 0) for i in range(k)]


@pytest.mark.parametrize("n", [0, 4, 5, 13, 50])
def test_exact_sizes_follow_array_split(spark, n):
    df = spark.range(n).selectExpr("cast(id as int) as user_id", "cast(id % 7 as int) as item_id",
                                   "cast(id as double) / 3 as rating")
    out = assign_folds(df, k=5, seed=7)
    want = [len(a) for a in np.array_split(np.arange(n), 5)]
    assert _sizes(out, 5) == want
    assert out.count() == n
    assert sorted(out.drop("fold").collect()) == sorted(df.collect())


def test_copies_are_kept_and_spread(spark):
    # a group of identical rows holding more than a third of all rows
    rows = [(1, 1, 5.0)] * 40 + [(i, i, 1.0) for i in range(2, 62)]
    df = spark.createDataFrame(rows, "user_id int, item_id int, rating double")
    out = assign_folds(df, k=5, seed=3, chunk_rows=7)  # small chunks: exercise the hot path
    assert out.count() == 100
    assert _sizes(out, 5) == [20] * 5
    hot = dict(out.where("user_id = 1").groupBy("fold").count().collect())
    assert sum(hot.values()) == 40


def test_independent_of_input_partitioning(spark):
    df = spark.range(200).selectExpr("cast(id % 17 as int) as user_id",
                                     "cast(id % 11 as int) as item_id",
                                     "cast(id % 5 as double) as rating")
    results = []
    for parts in (1, 3, 8):
        out = assign_folds(df.repartition(parts), k=5, seed=11)
        results.append(sorted(tuple(r) for r in out.collect()))
    assert results[0] == results[1] == results[2]


def test_hash_method_keeps_rows(spark):
    rows = [(1, 1, 5.0)] * 12 + [(i, i, 1.0) for i in range(2, 40)]
    df = spark.createDataFrame(rows, "user_id int, item_id int, rating double")
    out = assign_folds(df, k=5, seed=3, method="hash", chunk_rows=5)
    assert out.count() == 50
    hot = _sizes(out.where("user_id = 1"), 5)
    assert sorted(hot) == [2, 2, 2, 3, 3]  # copies go round-robin over the folds


def test_split_and_counts(spark):
    df = spark.range(23).selectExpr("cast(id as int) as user_id", "cast(id as int) as item_id",
                                    "1.0 as rating")
    out = assign_folds(df, k=5)
    train, test = fold_split(out, 2)
    assert train.count() + test.count() == 23
    assert test.where(F.col("fold") != 2).count() == 0
    counts = {r.fold: (r.n_train, r.n_test) for r in fold_counts(out, 5).collect()}
    assert counts[0] == (18, 5) and counts[4] == (19, 4)


def test_empty_folds_reported(spark):
    df = spark.range(2).selectExpr("cast(id as int) as user_id", "1 as item_id", "1.0 as rating")
    rows = sorted(tuple(r) for r in fold_counts(assign_folds(df, k=5), 5).collect())
    assert rows == [(0, 1, 1), (1, 1, 1), (2, 2, 0), (3, 2, 0), (4, 2, 0)]


def test_nulls_and_single_fold(spark):
    rows = [(None, 1, 2.0), (1, None, 2.0), (1, 1, None), (None, None, None), (2, 2, 2.0)]
    df = spark.createDataFrame(rows, "user_id int, item_id int, rating double")
    out = assign_folds(df, k=1)
    assert out.count() == 5 and {r.fold for r in out.collect()} == {0}
    out3 = assign_folds(df, k=3, seed=9)
    assert _sizes(out3, 3) == [2, 2, 1]
    assert sorted(map(str, out3.drop("fold").collect())) == sorted(map(str, df.collect()))


def test_fold_sizes_property(spark):
    from hypothesis import HealthCheck, given, settings
    from hypothesis import strategies as st

    @settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
    @given(n=st.integers(0, 40), k=st.integers(1, 6), dup=st.integers(1, 4),
           parts=st.integers(1, 5), seed=st.integers(0, 99))
    def check(n, k, dup, parts, seed):
        rows = [(i % 7, i % 5, float(i % 3)) for i in range(n)] * dup
        df = spark.createDataFrame(rows, "user_id int, item_id int, rating double")
        out = assign_folds(df.repartition(parts), k=k, seed=seed, chunk_rows=3)
        want = [len(a) for a in np.array_split(np.arange(len(rows)), k)]
        assert _sizes(out, k) == want
        assert sorted(out.drop("fold").collect()) == sorted(df.collect())

    check()
