import os

import pytest
from pyspark.sql import functions as F

from ratingspark.operators import prep
from ratingspark.operators.folds import assign_folds
from ratingspark.sources import files

def _small_folds(directory):
    """Five headerless files fold0..fold4 of 10 ratings each: 10 users x 10 items,
    no repeated pair, ratings spread over a wide signed range."""
    os.makedirs(directory)
    pairs = [(u, (u * 3 + j) % 10) for u in range(10) for j in range(5)]
    for k in range(5):
        with open(f"{directory}/fold{k}", "w") as fh:
            for n, (u, i) in enumerate(pairs[k * 10:(k + 1) * 10]):
                fh.write(f"{u},{i},{(n * 37.5 + k * 11.25) - 180.0}\n")
    return pairs


def test_read_folds_headerless_files(spark, tmpdir_path):
    pairs = _small_folds(f"{tmpdir_path}/small")
    df = files.read_folds(spark, f"{tmpdir_path}/small", 5)
    assert df.count() == 50
    sizes = dict(df.groupBy("fold").count().collect())
    assert sizes == {0: 10, 1: 10, 2: 10, 3: 10, 4: 10}
    r = df.agg(F.min("rating"), F.max("rating"), F.countDistinct("user_id", "item_id")).first()
    assert r[0] == -180.0 and r[1] == 202.5 and r[2] == len(set(pairs)) == 50
    assert files.read_folds(spark, f"{tmpdir_path}/small", 1).count() == 50  # 1 = "all five"
    assert df.where("fold = 3").select("user_id").distinct().count() == 2


def test_ratings_text_roundtrip(spark, tmpdir_path):
    df = spark.createDataFrame([(1, 2, 3.5), (4, 5, -1.25)], "user_id int, item_id int, rating double")
    folded = assign_folds(df, k=2)
    files.write_folds(folded, f"{tmpdir_path}/folds")
    back = files.read_fold_table(spark, f"{tmpdir_path}/folds")
    assert sorted(back.drop("fold").collect()) == sorted(df.collect())
    # the fold directories come back as a partition column
    assert sorted(tuple(r) for r in back.collect()) == sorted(tuple(r) for r in folded.collect())
    assert back.where("fold = 1").count() == 1


def test_read_folds_from_directories(spark, tmpdir_path):
    df = spark.createDataFrame([(1, 2, 3.5), (4, 5, -1.25), (6, 7, 1.0)],
                               "user_id int, item_id int, rating double")
    for k, part in enumerate([df.where("user_id < 5"), df.where("user_id >= 5")]):
        part.write.csv(f"{tmpdir_path}/d/fold{k}")
    back = files.read_folds(spark, tmpdir_path + "/d", 2)
    assert sorted(tuple(r) for r in back.collect()) == [(1, 2, 3.5, 0), (4, 5, -1.25, 0),
                                                        (6, 7, 1.0, 1)]


def test_bad_rating_row_fails(spark, tmpdir_path):
    path = f"{tmpdir_path}/bad"
    os.makedirs(path)
    with open(f"{path}/fold0", "w") as fh:
        fh.write("1,2,3.0\nx,2,1.0\n")
    with pytest.raises(Exception):
        files.read_ratings(spark, f"{path}/fold0").collect()


def test_factor_text_roundtrip(spark, tmpdir_path):
    df = spark.createDataFrame([(1, [0.5, -0.25]), (2, [1.0, 2.0])], "id bigint, features array<double>")
    files.write_factor_text(df, f"{tmpdir_path}/u.csv")
    open(f"{tmpdir_path}/u.csv/_SUCCESS.crc", "w").close()   # hidden files are skipped
    back = files.read_factors(spark, f"{tmpdir_path}/u.csv", 2, id_type="bigint")
    assert sorted((r.id, list(r.features)) for r in back.collect()) == [(1, [0.5, -0.25]),
                                                                        (2, [1.0, 2.0])]


def test_lookup_and_tables(spark, tmpdir_path):
    lk = spark.createDataFrame([(1, "a", "X", 0, 4.0)], files.LOOKUP_SCHEMA)
    files.write_lookup(lk, f"{tmpdir_path}/lookup")
    assert files.read_lookup(spark, f"{tmpdir_path}/lookup").collect() == lk.collect()
    files.write_table(lk.select("item_name", "rating"), f"{tmpdir_path}/t")
    assert files.read_table(spark, f"{tmpdir_path}/t", "item_name string, rating double").count() == 1


def test_read_reviews_csv(spark, tmpdir_path):
    path = f"{tmpdir_path}/reviews.csv"
    with open(path, "w") as fh:
        fh.write("brewery_id,review_overall,review_profilename,beer_style,beer_name,beer_abv,beer_beerid\n")
        fh.write("10,4.5,ann,Stout,Dark,5.0,7\n11,3.0,bob,Ale,Pale,,8\n")
    df = files.read_reviews(spark, path)
    names = ["user_name", "item_id", "item_name", "category", "rating"]
    assert df.columns == names + ["brewery_id", "beer_abv"]
    assert sorted(df.select(names).collect()) == [("ann", 7, "Dark", "Stout", 4.5), ("bob", 8, "Pale", "Ale", 3.0)]
    assert files.read_reviews(spark, path, others=False).columns == names


def test_prepare_drops_rows_with_a_null_in_any_column_of_the_file(spark, tmpdir_path):
    path = f"{tmpdir_path}/reviews.csv"
    with open(path, "w") as fh:
        fh.write("review_overall,review_profilename,beer_style,beer_name,beer_abv,beer_beerid\n")
        fh.write('4.5,ann,Stout,"The ""Big"", One",5.0,7\n3.0,bob,Ale,Pale,,8\n')
    reviews = files.read_reviews(spark, path)
    lookup, folded = prep.prepare_dataset(reviews, f"{tmpdir_path}/folds", f"{tmpdir_path}/lookup", k=2)
    assert [r.item_name for r in lookup.collect()] == ['The "Big", One']
    assert [tuple(r) for r in files.read_folds(spark, f"{tmpdir_path}/folds", schema="user_id long, item_id long, rating double").collect()] == [(0, 7, 4.5, 0)]
    assert files.read_lookup(spark, f"{tmpdir_path}/lookup").first().item_name == 'The "Big", One'
    kept, _ = prep.prepare_dataset(reviews, null_columns=prep.REVIEW_COLUMNS, k=2)
    assert kept.count() == 2


def test_every_fold_of_a_directory_is_read(spark, tmpdir_path):
    os.makedirs(f"{tmpdir_path}/eight")
    for k in range(8):
        with open(f"{tmpdir_path}/eight/fold{k}", "w") as fh:
            fh.write(f"{k},1,2.0\n")
    for asked in (None, 1):
        assert sorted(r.fold for r in files.read_folds(spark, f"{tmpdir_path}/eight", asked).collect()) == list(range(8))
    assert files.read_folds(spark, f"{tmpdir_path}/eight", 3).count() == 3


def test_factor_text_keeps_digits_and_places(spark, tmpdir_path):
    df = spark.createDataFrame([(7, [None, 1.5, 1e-14])], "id bigint, features array<double>")
    files.write_factor_text(df, f"{tmpdir_path}/f")
    assert spark.read.text(f"{tmpdir_path}/f").first().value == "7,,1.5,1.0E-14"
    assert list(files.read_factors(spark, f"{tmpdir_path}/f", 3).first().features) == [None, 1.5, 1e-14]
    ragged = spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0, 3.0])], df.schema)
    with pytest.raises(ValueError, match="lengths"):
        files.write_factor_text(ragged, f"{tmpdir_path}/r")


def test_vector_text_helpers(spark):
    from ratingspark.functions.vectors import parse_vector_text, vector_text
    df = spark.createDataFrame([(7, 0.5, -0.125)], "id bigint, f0 double, f1 double")
    line = df.select(vector_text("id", ["f0", "f1"], scale=3).alias("t")).first().t
    assert line == "7,0.500,-0.125"
    back = df.select(vector_text("id", ["f0", "f1"]).alias("t")).select(*parse_vector_text("t", 2))
    assert tuple(back.first()) == (7, 0.5, -0.125)


def test_union_and_label_split(spark):
    from ratingspark.operators.folds import label_split, union_folds
    a = spark.createDataFrame([(1, 1, 1.0, 0)], "user_id int, item_id int, rating double, fold int")
    b = spark.createDataFrame([(2, 2, 2.0, 1)], a.schema)
    both = union_folds([a, b])
    assert both.count() == 2
    assert {(r.fold, r.split) for r in label_split(both, 1).collect()} == {(0, "train"), (1, "test")}
