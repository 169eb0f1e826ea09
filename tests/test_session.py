from ratingspark.session import (broadcast_threshold, ensure_checkpoint_dir, fits_broadcast,
                                 sized_checkpoint)


def test_threshold_parsing_and_bound(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10MB")
        assert broadcast_threshold(spark) == 10 * 1024 * 1024
        assert fits_broadcast(spark, 1000, 100) and not fits_broadcast(spark, 10**6, 100)
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        assert not fits_broadcast(spark, 1, 1)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_sized_checkpoint(spark):
    small, ok = sized_checkpoint(spark.range(10).selectExpr("id", "cast(id as string) as s"))
    assert ok and small.count() == 10
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "100b")
        _, ok = sized_checkpoint(spark.range(1000))
        assert not ok
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_checkpoint_dir_is_kept(spark):
    d = ensure_checkpoint_dir(spark)
    assert d and ensure_checkpoint_dir(spark) == d
