import os

import pytest

from ratingspark.operators import prep
from ratingspark.sources import testdata

from .conftest import SF_SMALL

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_SMALL), reason="test tables missing")


def test_coded_triples_same_on_both_join_paths(spark):
    generic = sorted(tuple(r) for r in prep.rating_triples(testdata.reviews(spark, SF_SMALL)).collect())
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        for thr in ("10485760b", "100b"):   # broadcast codes / codes at the customer dimension
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", thr)
            got = sorted(tuple(r) for r in testdata.coded_triples(spark, SF_SMALL).collect())
            assert got == generic
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_gradient_same_with_and_without_broadcast(spark):
    from ratingspark.operators import gradient as G
    rows = testdata.ratings(spark, SF_SMALL)
    p = G.GDParams(d=2, gain=0.0005, maxiter=2, seed=3)
    a = G.train(rows, p)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        b = G.train(rows, p)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert a.broadcast_u and not b.broadcast_u
    ra = {r.id: (round(r.f0, 9), round(r.f1, 9)) for r in a.U.collect()}
    rb = {r.id: (round(r.f0, 9), round(r.f1, 9)) for r in b.U.collect()}
    assert ra == rb
    assert abs(a.history[-1]["objective"] - b.history[-1]["objective"]) < 1e-6
