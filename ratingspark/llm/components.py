"""Connected components of links that may not fit one machine.

``components`` contracts the graph: each round, every node takes the
neighbour with the smallest hash (itself included) as its new name, and the
links are renamed, made distinct and written.  Hash order makes the number of
nodes fall by a constant factor each round, whatever the ids look like, so
long chains end after a logarithmic number of rounds.  Minima are partial
aggregates and the joins are plain equi joins, so a hub's links are split
among tasks.  Only the number of links left reaches the driver.

``bucket_links`` finds the links of rows that share buckets without emitting
all pairs of a bucket.  Every row is compared with a few centres of its bucket.  Rows
that are then in one component need no further comparison; in the buckets
that still hold several components, rows of different components are joined,
each pair in the first bucket that both share, and the join's own condition
compares them: sizes and sketches first, then the whole sets, so that only links
come out.  So the components are those of all pairs.

Tables that have been read are deleted, so that a step's disk does not add to
that of the steps before.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, saved, small


#: Rows of a bucket that all its rows are compared with.
CENTRES = 6


def _rank(node: str) -> Column:
    return F.struct(F.xxhash64(node).alias("h"), F.col(node).alias("id"))


def components(links: DataFrame) -> DataFrame:
    """``(node, root)`` of all nodes in ``links(a, b)``; ``root`` is a node of the component.

    Ids are non-null longs or strings.  Loops and repeated links do no harm.
    No links give no rows.
    """
    scratch = Scratch(links.sparkSession, "components")
    edges = scratch.write(links.select("a", "b").where(F.col("a") != F.col("b")).distinct(), "links")
    if edges.isEmpty():
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    found = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        best = both.groupBy("a").agg(F.min(_rank("b")).alias("best"))
        name = scratch.write(best.select("a", F.least(_rank("a"), F.col("best"))["id"].alias("to")), "names")
        if found is None:
            renewed = name.select(F.col("a").alias("node"), F.col("to").alias("root"))
        else:
            renewed = found.join(name, F.col("root") == F.col("a"), "left").select(
                "node", F.coalesce("to", "root").alias("root"))
        found = scratch.write(renewed, "roots")
        renamed = (edges.join(name, "a").select(F.col("to").alias("x"), F.col("b").alias("a"))
                   .join(name, "a").select(F.col("x").alias("a"), F.col("to").alias("b")))
        edges = scratch.write(renamed.where(F.col("a") != F.col("b")).select(
            F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
        if edges.isEmpty():
            scratch.drop_all_but(found)
            return found
        scratch.drop_all_but(found, edges)


def bucket_links(buckets: DataFrame, items: Callable[[DataFrame], DataFrame],
                 may_link: Callable[[Column, Column], Column],
                 linked: Callable[[DataFrame], DataFrame],
                 sets: Callable[[DataFrame], DataFrame] | None = None,
                 alike: Callable[[Column, Column], Column] | None = None) -> DataFrame:
    """Links ``(a, b)`` whose components are those of all linked pairs within buckets.

    ``buckets(bucket, node)``: a node may be in many buckets, rows may repeat.
    ``items`` gives ``(node, item)`` for nodes that share a bucket, ``item``
    being a small description.  ``may_link`` tells from two descriptions that
    a pair cannot be a link, and ``linked`` keeps the links of pairs ``(a, b)``.
    ``sets`` gives ``(node, set)`` of nodes, and ``alike`` tells from two sets
    whether they are a link; without them ``may_link`` tells.  The result is a
    written table; repeated links may occur.
    """
    scratch = Scratch(buckets.sparkSession, "buckets")
    ends = buckets.groupBy("bucket").agg(F.min("node").alias("centre"), F.max("node").alias("last"))
    shared = scratch.write(ends.where(F.col("centre") != F.col("last")), "shared")
    given = F.broadcast(shared) if small(shared, 24) else shared
    rows = scratch.write(buckets.join(given, "bucket").distinct(), "rows")
    scratch.drop(shared)
    known = scratch.write(items(rows.select("node").distinct()), "items")
    a, b = (known.select(F.col("node").alias(x), F.col("item").alias(f"item_{x}")) for x in "ab")

    # Several centres, so that a group in which many pairs are links is one component by then.
    drawn = [F.min_by("node", F.xxhash64("node", F.lit(n))) for n in range(CENTRES - 2)]
    centres = rows.groupBy("bucket").agg(F.array_distinct(F.array(
        F.first("centre"), F.first("last"), *drawn)).alias("centres"))
    pairs = rows.select("bucket", "node").join(centres, "bucket").select("node", F.explode("centres").alias("c"))
    stars = pairs.where(F.col("node") != F.col("c")).select(
        F.least("node", "c").alias("a"), F.greatest("node", "c").alias("b")).distinct()
    close = stars.join(a, "a").join(b, "b").where(may_link(F.col("item_a"), F.col("item_b"))).select("a", "b")
    near = saved(linked(close), "near")

    # Buckets of two nodes are done; so are those whose nodes are in one component by now.
    several = rows.where((F.col("node") != F.col("centre")) & (F.col("node") != F.col("last"))).select("bucket").distinct()
    rest = scratch.write(rows.select("bucket", "node").join(several, "bucket", "left_semi"), "rest")
    scratch.drop(rows)
    if rest.isEmpty():
        scratch.drop_all_but()
        return near
    named = scratch.write(rest.join(components(near), "node", "left").select(
        "bucket", "node", F.coalesce("root", "node").alias("root")), "named")
    scratch.drop(rest)
    mixed = (named.groupBy("bucket").agg(F.min("root").alias("lo"), F.max("root").alias("hi"))
             .where(F.col("lo") != F.col("hi")).select("bucket"))
    left = scratch.write(named.join(mixed, "bucket", "left_semi"), "left")
    scratch.drop(named)
    whole = left.groupBy("node").agg(F.sort_array(F.collect_list("bucket")).alias("own")).join(known, "node")
    if sets:
        whole = whole.join(sets(left.select("node").distinct()), "node")
    full = scratch.write(left.join(whole, "node"), "mixed")
    scratch.drop(left, known)
    one, two = (full.select("bucket", *[F.col(c).alias(f"{c}_{x}") for c in full.columns if c != "bucket"]) for x in "ab")
    test = (F.col("root_a") < F.col("root_b")) & may_link(F.col("item_a"), F.col("item_b"))
    test = test & (F.array_intersect("own_a", "own_b")[0] == one["bucket"])
    if alike:
        test = test & alike(F.col("set_a"), F.col("set_b"))
    across = one.join(two, (one["bucket"] == two["bucket"]) & test)
    links = saved(near.unionByName(across.select(F.col("node_a").alias("a"), F.col("node_b").alias("b"))), "linked")
    scratch.drop_all_but()
    return links


def set_item(hashes: Column) -> Column:
    """Description of a set of hashes: its size and a bitmap of 256 bits, four longs."""
    def word(w: int) -> Column:
        own = F.filter(hashes, lambda h: F.shiftright(h, 6).bitwiseAND(F.lit(3)) == w)
        return F.aggregate(own, F.lit(0).cast("long"), lambda bits, h: bits.bitwiseOR(
            F.call_function("shiftleft", F.lit(1).cast("long"), h.bitwiseAND(F.lit(63)).cast("int"))))

    return F.struct(F.size(hashes).alias("n"), *[word(w).alias(f"b{w}") for w in range(4)])


def sets_may_reach(similarity: float) -> Callable[[Column, Column], Column]:
    """Whether two sets may have a Jaccard of ``similarity``, by ``set_item``.

    Bits that differ stand for elements that only one set has, and two sets
    that reach t differ in at most (1 - t) / (1 + t) of their sizes' sum.
    """
    share = (1 - similarity) / (1 + similarity)

    def test(a: Column, b: Column) -> Column:
        apart = sum((F.bit_count(a[f"b{w}"].bitwiseXOR(b[f"b{w}"])) for w in range(4)), F.lit(0))
        return apart <= share * (a["n"] + b["n"]) + 1e-9
    return test
