"""Hard-negative mining: cover trees over norm-augmented vectors.

A vector x of a block gets one more coordinate, sqrt(M^2 - |x|^2), M being the
block's largest norm.  All augmented vectors then lie on one sphere, and the
inner product with a query q, scaled to norm M and given a last coordinate of
0, is a falling function of the Euclidean distance.  So a cover tree in that
metric bounds inner products: all descendants of a node lie within its measured
covering radius, and their products with q lie in an interval that the distance
to the node's centre and the radius give.

Rows of one label are cut into blocks of bounded size and every block gets its
tree once.  A group of anchors meets the blocks one after another and keeps its
best rows so far.  In a block the nodes are opened best first, by the highest
product that any anchor of the group may still find there.  A node is skipped
for an anchor if its interval lies below the anchor's last kept row or outside
the window, and leaves that are opened are verified by exact integer products.
Positives are searched in blocks of the anchor's label, negatives in all others.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import saved, small

POSITIVES, NEGATIVES = 5, 3
#: A negative's score is at least and at most this share of the positive's, in percent.
LOW, HIGH = 50, 95
#: Rows of a block, of a leaf; children of a node; anchors of a group; blocks that one task goes through.
BLOCK_ROWS, LEAF_ROWS, CHILDREN, GROUP_ROWS, BLOCKS_PER_TASK = 4096, 64, 16, 64, 64
_LOWEST, _HIGHEST = np.iinfo(np.int64).min, np.iinfo(np.int64).max


def finite(column: str) -> Column:
    """Whether a vector has components and all are numbers."""
    good = F.forall(column, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(F.col(column).isNotNull() & (F.size(column) > 0) & good, F.lit(False))


def integer_vectors(rows: DataFrame, scale: int = 256) -> DataFrame:
    """``(vec_id, label, vector)`` of the rows that take part; a component x is floor(scale * x)."""
    given = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"),
                        F.col("embedding").cast("array<double>").alias("vector"))
    return given.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & finite("vector")).withColumn(
        "vector", F.transform("vector", lambda x: F.floor(x * F.lit(float(scale))).cast("long")))


def _exact(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Integer products of the rows of ``a`` and ``b``: by doubles while these are exact, else by whole numbers."""
    top = (int(np.abs(a).max(initial=0)) + 1) * (int(np.abs(b).max(initial=0)) + 1) * max(1, a.shape[1])
    if top < 1 << 53:
        return (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
    if top < 1 << 62:
        return a @ b.T
    whole = a.astype(object) @ b.T.astype(object)
    return np.clip(whole, _LOWEST + 1, _HIGHEST - 1).astype(np.int64)


class CoverTree:
    """Nodes in breadth-first order; the points of a node are neighbours in ``order``.

    ``centre`` is a row of the points, ``radius`` the largest distance of the
    node's points to it, ``start:end`` its points and ``first:last`` its
    children (none in a leaf).
    """

    FIELDS = ("centre", "start", "end", "first", "last")

    def __init__(self, order: np.ndarray, radius: np.ndarray, **fields: np.ndarray):
        self.order, self.radius = order, radius
        self.__dict__.update(fields)

    @staticmethod
    def augmented(points: np.ndarray) -> tuple[np.ndarray, float]:
        plain = points.astype(np.float64)
        squares = (plain * plain).sum(axis=1)
        return np.column_stack([plain, np.sqrt(np.maximum(squares.max() - squares, 0.0))]), float(np.sqrt(squares.max()))

    @classmethod
    def build(cls, points: np.ndarray, leaf_rows: int = LEAF_ROWS, children: int = CHILDREN) -> CoverTree:
        """Each level covers a node's points at half its radius, by up to ``children`` centres.

        Points beyond the last centre's reach join the nearest one; radii are
        measured afterwards, so bounds hold in any case.
        """
        x, _ = cls.augmented(points)
        order = np.arange(len(x))
        found: dict[str, list] = {name: [] for name in ("radius", *cls.FIELDS)}
        todo, at = [(0, len(x))], 0
        while at < len(todo):
            start, end = todo[at]
            at += 1
            rows = order[start:end]
            away = np.linalg.norm(x[rows] - x[rows[0]], axis=1)
            radius, parts = float(away.max()), []
            if len(rows) > leaf_rows and radius > 0:
                near, owner = away, np.zeros(len(rows), np.int64)
                for n in range(1, children):
                    far = int(near.argmax())
                    if near[far] <= radius / 2:
                        break
                    d = np.linalg.norm(x[rows] - x[rows[far]], axis=1)
                    owner[d < near] = n
                    near = np.minimum(near, d)
                for n in range(int(owner.max()) + 1):
                    own = np.flatnonzero(owner == n)
                    own = own[np.argsort(near[own], kind="stable")]  # a child's centre is its first point
                    parts.append(rows[own])
                order[start:end] = np.concatenate(parts)
            found["centre"].append(start)
            found["radius"].append(radius)
            found["start"].append(start)
            found["end"].append(end)
            found["first"].append(len(todo))
            found["last"].append(len(todo) + len(parts))
            for part in parts:
                todo.append((start, start + len(part)))
                start += len(part)
        radius = np.asarray(found.pop("radius")) * (1 + 1e-9) + 1e-6
        return cls(order, radius, **{k: np.asarray(v, np.int32) for k, v in found.items()})


class Search:
    """The best rows found so far for each window of a group of anchors.

    A window belongs to the anchor ``owner``; rows score from ``low`` to
    ``high``.  Higher scores come first, then smaller ids.
    """

    def __init__(self, anchors: np.ndarray, ids: np.ndarray, owner: np.ndarray, low: np.ndarray, high: np.ndarray, keep: int):
        self.anchors, self.ids, self.owner, self.low, self.high = anchors, ids, owner, low, high
        self.norms = np.linalg.norm(anchors.astype(np.float64), axis=1)
        self.score = np.full((len(owner), keep), _LOWEST)
        self.id = np.full((len(owner), keep), _HIGHEST)
        self.opened = 0  # rows verified

    def bounds(self, points: np.ndarray, tree: CoverTree, norm: float, lo: int, hi: int) -> tuple[np.ndarray, np.ndarray]:
        """The lowest and highest product of each anchor with the points of nodes ``lo:hi``."""
        centre = points[tree.centre[lo:hi]].astype(np.float64)
        radius = tree.radius[lo:hi]
        mid = self.anchors.astype(np.float64) @ centre.T
        reach = self.norms[:, None] * radius
        below, above = mid - reach, mid + reach
        if norm > 0:
            cosine = mid / np.maximum(self.norms[:, None] * norm, 1e-300)
            away = norm * np.sqrt(np.maximum(2 - 2 * cosine, 0.0))  # from the scaled anchor, on the sphere
            unit = self.norms[:, None] / (2 * norm)
            above = np.minimum(above, unit * (2 * norm * norm - np.maximum(away - radius, 0.0) ** 2))
            below = np.maximum(below, unit * (2 * norm * norm - (away + radius) ** 2))
        slack = 1e-6 + 1e-9 * np.abs(mid)
        return below - slack, above + slack

    def open(self, below: np.ndarray, above: np.ndarray) -> np.ndarray:
        """Windows that a node with these bounds for each anchor may still serve."""
        return (above[self.owner] >= np.maximum(self.low, self.score[:, -1])) & (below[self.owner] <= self.high)

    def block(self, ids: np.ndarray, points: np.ndarray, tree: CoverTree, norm: float) -> None:
        below, above = self.bounds(points, tree, norm, 0, 1)
        heap = [(-float(above.max()), 0, below[:, 0], above[:, 0])]
        while heap:
            _, node, below, above = heapq.heappop(heap)
            mask = self.open(below, above)
            if not mask.any():
                continue
            first, last = tree.first[node], tree.last[node]
            if first == last:
                self.leaf(mask, ids[tree.start[node]:tree.end[node]], points[tree.start[node]:tree.end[node]])
                continue
            below, above = self.bounds(points, tree, norm, first, last)
            live = np.unique(self.owner[mask])
            for n in range(last - first):
                heapq.heappush(heap, (-float(above[live, n].max()), first + n, below[:, n], above[:, n]))

    def leaf(self, mask: np.ndarray, ids: np.ndarray, points: np.ndarray) -> None:
        rows = np.flatnonzero(mask)
        own, at = np.unique(self.owner[rows], return_inverse=True)
        self.opened += len(own) * len(ids)
        scores = _exact(self.anchors[own], points)[at]
        fits = (scores >= self.low[rows, None]) & (scores <= self.high[rows, None]) & (ids != self.ids[self.owner[rows], None])
        fits &= scores >= self.score[rows, -1:]
        some = fits.any(axis=1)
        rows, scores, fits = rows[some], scores[some], fits[some]
        all_scores = np.concatenate([self.score[rows], np.where(fits, scores, _LOWEST)], axis=1)
        all_ids = np.concatenate([self.id[rows], np.where(fits, ids, _HIGHEST)], axis=1)
        best = np.lexsort((all_ids, -1 - all_scores))[:, :self.score.shape[1]]  # ~score: no overflow
        self.score[rows] = np.take_along_axis(all_scores, best, axis=1)
        self.id[rows] = np.take_along_axis(all_ids, best, axis=1)


def blocks(points: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``(label, dim, block, ids, points, norm, radius, nodes)``: every row in one block, with its cover tree."""
    key = ["label", "dim"]
    sized = points.withColumn("dim", F.size("vector"))
    parts = sized.groupBy(*key).agg(F.ceil(F.count(F.lit(1)) / block_rows).cast("int").alias("parts"))
    dealt = sized.join(parts, key).withColumn("block", F.pmod(F.xxhash64("vec_id", "vector"), "parts").cast("int"))

    def build(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        ids = group["vec_id"].to_numpy(np.int64)
        points = np.stack([np.asarray(v, np.int64) for v in group["vector"]])
        rows = np.unique(np.column_stack([ids, points]), axis=0)  # repeated rows count once
        ids, points = rows[:, 0], rows[:, 1:]
        tree = CoverTree.build(points)
        ids, points = ids[tree.order], points[tree.order]
        nodes = np.stack([getattr(tree, name) for name in CoverTree.FIELDS])
        return pd.DataFrame([dict(label=key[0], dim=key[1], block=key[2], ids=ids.tobytes(), points=points.tobytes(),
                                  norm=CoverTree.augmented(points)[1], radius=tree.radius.tobytes(), nodes=nodes.tobytes())])

    return saved(dealt.groupBy(*key, "block").applyInPandas(
        build, "label long, dim int, block int, ids binary, points binary, norm double, radius binary, nodes binary"), "blocks")


def anchor_groups(anchors: DataFrame, group_rows: int = GROUP_ROWS) -> DataFrame:
    """``(group, label, dim, anchors)``: distinct anchors of one label, ``group_rows`` or about as many."""
    key = ["label", "dim"]
    sized = anchors.withColumn("dim", F.size("vector")).distinct()
    parts = sized.groupBy(*key).agg(F.ceil(F.count(F.lit(1)) / group_rows).cast("int").alias("parts"))
    dealt = sized.join(parts, key).withColumn("part", F.pmod(F.xxhash64("vec_id"), "parts"))
    grouped = dealt.groupBy(*key, "part").agg(F.sort_array(F.collect_list(F.struct("vec_id", "vector"))).alias("anchors"))
    return saved(grouped.select(F.monotonically_increasing_id().alias("group"), "label", "dim", "anchors"), "anchors")


def _meet(groups: DataFrame, trees: DataFrame, same_label: bool, blocks_per_task: int) -> DataFrame:
    """Rows of a group beside each of its blocks, neighbours within a task.

    Blocks of a counted size are broadcast; else both sides are shuffled by
    (group, part), and the blocks come as often as there are groups.
    """
    given = trees.withColumnRenamed("label", "block_label")
    tasks = max(1, -(-trees.count() // blocks_per_task))
    parted = given.withColumn("part", F.pmod(F.xxhash64("block_label", "dim", "block"), F.lit(tasks)).cast("int"))
    split = groups.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(tasks - 1))))
    widest = trees.agg(F.max(F.length("points") + F.length("ids"))).first()[0] or 0
    labels = F.col("label") == F.col("block_label") if same_label else F.col("label") != F.col("block_label")
    if small(trees, int(widest) + 4096):
        wide = max(1, int(groups.sparkSession.conf.get("spark.sql.shuffle.partitions")))
        return split.repartition(wide, "group", "part").join(F.broadcast(parted), ["dim", "part"]).where(labels)
    met = split.join(parted, ["dim", "part"]).where(labels)
    return met.repartition("group", "part").sortWithinPartitions("group", "part")


def _searched(met: DataFrame, windows, keep: int) -> DataFrame:
    """``(group, window, score, id)``: the best rows of each window, for each part of the blocks.

    ``windows`` gives (owner, low, high) of a group's anchors and further columns.
    """
    columns = ["group", "part", "anchors", *[c for c in ("windows",) if c in met.columns],
               "ids", "points", "norm", "radius", "nodes"]

    def rows(name: tuple, search: Search) -> pa.RecordBatch:
        window, place = np.nonzero(search.score > _LOWEST)
        return pa.RecordBatch.from_arrays([
            pa.array(np.full(len(window), name[0], np.int64)), pa.array(window.astype(np.int32)),
            pa.array(search.score[window, place]), pa.array(search.id[window, place])], names=["group", "window", "score", "id"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, search = None, None
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i].as_py() for c in ("group", "part", "ids", "points", "norm", "radius", "nodes")}
                if (row["group"], row["part"]) != name:
                    if search is not None:
                        yield rows(name, search)
                    name = (row["group"], row["part"])
                    anchors = batch.column("anchors")[i].as_py()
                    given = batch.column("windows")[i].as_py() if "windows" in columns else None
                    vectors = np.array([a["vector"] for a in anchors], np.int64)
                    search = Search(vectors, np.array([a["vec_id"] for a in anchors], np.int64),
                                    *windows(len(anchors), given), keep)
                ids = np.frombuffer(row["ids"], np.int64)
                fields = np.frombuffer(row["nodes"], np.int32).reshape(len(CoverTree.FIELDS), -1)
                tree = CoverTree(None, np.frombuffer(row["radius"]), **dict(zip(CoverTree.FIELDS, fields)))
                search.block(ids, np.frombuffer(row["points"], np.int64).reshape(len(ids), -1), tree, row["norm"])
        if search is not None:
            yield rows(name, search)

    return met.select(*columns).mapInArrow(run, "group long, window int, score long, id long")


def _ranked(found: DataFrame, keep: int) -> DataFrame:
    """The first ``keep`` of the parts' rows, ranked from 1."""
    order = Window.partitionBy("group", "window").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= keep)


def mine(points: DataFrame, is_anchor: Column, positives: int = POSITIVES, negatives: int = NEGATIVES,
         low: int = LOW, high: int = HIGH, block_rows: int = BLOCK_ROWS, group_rows: int = GROUP_ROWS,
         blocks_per_task: int = BLOCKS_PER_TASK) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)``.

    ``points(vec_id, label, vector)`` hold whole numbers and no nulls (see
    ``integer_vectors``).  An anchor's positives are its ``positives`` best
    rows of its label; for each, the best ``negatives`` rows of other labels
    with low <= 100 * score / positive's score <= high.  Ties go to smaller
    ids.  Rows that repeat an id, label and vector count once; rows of the
    anchor's own id are neither positives nor negatives; vectors of different lengths
    are not compared; products beyond 63 bits count as the largest long.  An
    anchor without positives or negatives has no rows, and an empty table none.
    """
    trees = blocks(points, block_rows)
    groups = anchor_groups(points.where(is_anchor), group_rows)

    def anywhere(n: int, given) -> tuple:
        return np.arange(n), np.full(n, _LOWEST + 1), np.full(n, _HIGHEST)

    best = _ranked(_searched(_meet(groups, trees, True, blocks_per_task), anywhere, positives), positives)
    # windows of a group: a row of its (anchor, positive) pairs, at most ``positives`` an anchor
    listed = best.groupBy("group").agg(F.sort_array(F.collect_list(F.struct(
        F.col("window").alias("owner"), F.col("rank").alias("place"), F.col("id").alias("positive"), "score"))).alias("windows"))
    asked = saved(groups.join(listed, "group"), "windows")

    def between(n: int, given: list[dict]) -> tuple:
        score = [w["score"] for w in given]
        return (np.array([w["owner"] for w in given]), np.array([-(-low * s // 100) for s in score], np.int64),
                np.array([high * s // 100 for s in score], np.int64))

    found = _ranked(_searched(_meet(asked, trees, False, blocks_per_task), between, negatives), negatives)
    pairs = asked.select("group", F.posexplode("windows").alias("window", "w"), "anchors").select(
        "group", "window", F.element_at("anchors", F.col("w.owner") + 1)["vec_id"].alias("anchor_id"),
        F.col("w.positive").alias("positive_id"), F.col("w.score").alias("positive_score"))
    return found.join(pairs, ["group", "window"]).select(
        "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score",
        F.col("score").alias("negative_score"))
