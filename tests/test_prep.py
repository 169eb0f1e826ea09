import math

import numpy as np
import pytest

from ratingspark.operators import prep
from ratingspark.operators.indexing import dense_codes, encode

REVIEW_DDL = "user_name string, item_id bigint, item_name string, category string, rating double"

# reviews_tiny: nulls in each column, one item with two names, two items sharing
# a name, one item with 6 reviews and one with 5
TINY = [
    ("ann", 1, "Pale", "Ale", 4.0),
    ("bob", 1, "Pale", "Ale", 3.0),
    ("cid", 1, "Pale", "Ale", 5.0),
    ("dan", 1, "Pale", "Ale", 4.5),
    ("eve", 1, "Pale Ale", "Ale", 2.0),   # item 1 under a second name
    ("fay", 1, "Pale", "Ale", 3.5),
    ("ann", 2, "Stout", "Porter", 1.0),
    ("bob", 2, "Stout", "Porter", 2.0),
    ("cid", 2, "Stout", "Porter", 3.0),
    ("dan", 2, "Stout", "Porter", 4.0),
    ("eve", 2, "Stout", "Porter", 5.0),
    ("ann", 3, "Stout", "Porter", 3.0),   # item 3 shares the name of item 2
    (None, 4, "Lager", "Lager", 3.0),
    ("bob", 4, None, "Lager", 3.0),
    ("cid", 4, "Lager", None, 3.0),
    ("dan", 4, "Lager", "Lager", None),
]


@pytest.fixture()
def tiny(spark):
    return spark.createDataFrame(TINY, REVIEW_DDL)


def test_drop_null_rows(tiny):
    out = prep.drop_null_rows(tiny)
    assert out.count() == 12
    assert out.where("user_name is null or item_name is null or category is null "
                     "or rating is null").count() == 0


def test_dense_codes_sorted_and_dense(tiny):
    codes = {r.user_name: r.code for r in dense_codes(tiny, "user_name", "code").collect()}
    names = sorted({r[0] for r in TINY if r[0] is not None})
    assert codes == {n: i for i, n in enumerate(names)}


def test_dense_codes_many_partitions(spark):
    df = spark.range(0, 5000, 1, 7).selectExpr("concat('u', cast(id * 7919 % 5000 as string)) as v")
    got = sorted((r.v, r.code) for r in dense_codes(df, "v", "code").collect())
    want = sorted((v, i) for i, v in enumerate(sorted(f"u{i}" for i in range(5000))))
    assert got == want


def test_encode_null_is_minus_one(tiny):
    enc = encode(tiny.select("category"), "category", "cid")
    rows = enc.collect()
    assert {r.cid for r in rows if r.category is None} == {-1}
    assert {(r.category, r.cid) for r in rows if r.category} == {("Ale", 0), ("Lager", 1),
                                                                  ("Porter", 2)}


def test_item_lookup_keeps_two_names_and_mean(tiny):
    lk = prep.item_lookup(prep.drop_null_rows(tiny))
    rows = lk.where("item_id = 1").collect()
    assert sorted(r.item_name for r in rows) == ["Pale", "Pale Ale"]
    assert all(math.isclose(r.rating, np.mean([4.0, 3.0, 5.0, 4.5, 2.0, 3.5])) for r in rows)


def test_item_support_more_than_five(tiny):
    clean = prep.drop_null_rows(tiny)
    sup = {r.item_id: r.n_reviews for r in prep.item_support(clean, key_col="item_id").collect()}
    assert sup == {1: 6}   # item 2 has exactly 5: not kept
    by_name = {r.item_name: r.n_reviews for r in prep.item_support(clean).collect()}
    assert by_name == {"Stout": 6}  # items 2 and 3 share the name


def test_supported_reviews_inner_and_not_null(tiny):
    out = prep.supported_reviews(tiny)
    assert out.count() == 6
    assert {r.item_name for r in out.collect()} == {"Stout"}


def test_mean_predictor_is_population_std(tiny):
    clean = prep.drop_null_rows(tiny)
    vals = np.array([r.rating for r in clean.collect()])
    row = prep.mean_predictor(clean).first()
    assert math.isclose(row.mean_rating, vals.mean())
    assert math.isclose(row.rmse, np.sqrt(((vals - vals.mean()) ** 2).mean()))


def test_histogram_matches_numpy(spark):
    vals = [0.1, 0.5, 0.5, 1.2, 2.0, 2.45, 3.3, 4.9, 5.0, 5.0, 3.3]
    df = spark.createDataFrame([(v,) for v in vals], "rating double")
    got = [r.n for r in prep.rating_histogram(df).orderBy("bin").collect()]
    want, _ = np.histogram(vals, bins=10)
    assert got == list(want)


def test_histogram_single_value(spark):
    df = spark.createDataFrame([(3.0,), (3.0,)], "rating double")
    rows = prep.rating_histogram(df).orderBy("bin").collect()
    counts, edges = np.histogram([3.0, 3.0], bins=10)
    assert [r.n for r in rows] == list(counts)
    assert math.isclose(rows[0].lo, edges[0]) and math.isclose(rows[-1].hi, edges[-1])


def test_entity_counts(tiny):
    r = prep.entity_counts(tiny.selectExpr("user_name as user_id", "item_id")).first()
    assert (r.n_users, r.n_items, r.n_ratings) == (6, 4, 16)


def test_rating_triples_codes(tiny):
    out = prep.rating_triples(prep.drop_null_rows(tiny)).collect()
    assert len(out) == 12
    assert {r.user_id for r in out} == set(range(6))


def test_prepare_dataset_writes_and_reads_back(spark, tiny, tmpdir_path):
    from ratingspark.sources import files
    lookup, folded = prep.prepare_dataset(tiny, f"{tmpdir_path}/folds", f"{tmpdir_path}/lookup", k=3)
    back = files.read_fold_table(spark, f"{tmpdir_path}/folds")
    assert back.count() == 12 and sorted(back.collect()) == sorted(folded.collect())
    assert sorted(dict(back.groupBy("fold").count().collect()).values()) == [4, 4, 4]
    lk = files.read_lookup(spark, f"{tmpdir_path}/lookup")
    assert sorted(lk.collect()) == sorted(lookup.collect())
