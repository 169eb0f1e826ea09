"""Near-duplicate vectors: spherical k-means cells, blocked cosines within cells.

Vectors are compared only within a label.  Equal vectors of a label are one
node with a number of copies.  Per label, spherical k-means on a bounded
sample gives centres; every node's home is the cell of its nearest centre.

A partner may live in another cell, so a node is also a guest of each cell
that could hold one.  Let h be a node's home and c another centre.  A partner
x in cell c has x.(c - h) >= 0.  If the angle between node y and x is at most
t, then y.(c - h) >= -|c - h| sin t.  Cells that fail this hold no partner;
all others get y as a guest.  So no link is lost, whatever the centres are.

Within a cell the residents are cut into blocks, and so are residents plus
guests; each pair of blocks is one group of bounded size.  A group returns,
for every visitor, the number of residents it links with (each ordered link
is met once: in the cell of the partner), and links that span the group's
components, never all pairs.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import saved
from .components import components

COSINE = 0.93
#: Nodes that a cell should hold; centres per label at most; sample rows per centre; rounds.
CELL_ROWS = 2000
MAX_CELLS = 256
SAMPLE_PER_CELL = 64
ROUNDS = 10
#: Rows of a block; nodes that one assignment task holds.
BLOCK_ROWS = 2048
ASSIGN_ROWS = 20_000


def _finite(column: str) -> Column:
    good = F.forall(column, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.col(column).isNotNull() & good & F.exists(column, lambda x: x != 0)


def _unit(vectors: pd.Series) -> np.ndarray:
    rows = np.stack([np.asarray(v, np.float64) for v in vectors])
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def spherical_kmeans(points: np.ndarray, k: int, rounds: int = ROUNDS) -> np.ndarray:
    """Unit centres of ``k`` cells of unit vectors, at most one per point."""
    k = min(k, len(points))
    centres = points[np.linspace(0, len(points) - 1, k).astype(int)].copy()
    for _ in range(rounds if k > 1 else 1):
        home = (points @ centres.T).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, home, points)
        norms = np.linalg.norm(sums, axis=1, keepdims=True)
        centres = np.where(norms > 1e-12, sums / np.maximum(norms, 1e-12), centres)
    return centres


def fit_centres(nodes: DataFrame, cell_rows: int = CELL_ROWS, max_cells: int = MAX_CELLS) -> DataFrame:
    """``(label, dim, cell, centre)`` from a bounded sample of each label's nodes.

    A label with n nodes gets n / ``cell_rows`` centres, ``max_cells`` at most,
    fitted on about ``SAMPLE_PER_CELL`` nodes for each, chosen by hash.
    """
    sizes = nodes.groupBy("label", "dim").agg(F.count(F.lit(1)).alias("n"))
    wanted = sizes.withColumn("k", F.least(F.ceil(F.col("n") / cell_rows), F.lit(max_cells)).cast("int"))
    share = F.least(F.lit(1.0), F.col("k") * SAMPLE_PER_CELL / F.col("n"))
    place = F.pmod(F.xxhash64("node"), F.lit(1 << 30)) / float(1 << 30)
    sample = nodes.join(wanted, ["label", "dim"]).where((F.col("k") > 1) & (place < share))

    def fit(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("node")
        centres = spherical_kmeans(_unit(group["vector"]), int(group["k"].iloc[0]))
        return pd.DataFrame({"label": key[0], "dim": key[1], "cell": range(len(centres)),
                             "centre": [c.tolist() for c in centres]})

    return saved(sample.groupBy("label", "dim").applyInPandas(
        fit, "label long, dim int, cell int, centre array<double>"), "centres")


def assign(nodes: DataFrame, centres: DataFrame, cosine: float = COSINE) -> DataFrame:
    """``(label, dim, cell, node, copies, vector, resident)``: homes and guest cells."""
    sine = math.sqrt(max(0.0, 1.0 - cosine * cosine)) + 1e-9
    sizes = nodes.groupBy("label", "dim").agg(F.count(F.lit(1)).alias("n"))
    parts = sizes.select("label", "dim", F.ceil(F.col("n") / ASSIGN_ROWS).cast("int").alias("parts"))
    dealt = nodes.join(parts, ["label", "dim"]).withColumn("part", F.pmod(F.xxhash64("node"), "parts").cast("int")).drop("parts")
    copies = centres.join(parts, ["label", "dim"]).select(
        "label", "dim", "cell", "centre", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))

    def place(points: pd.DataFrame, given: pd.DataFrame) -> pd.DataFrame:
        out = points[["label", "dim", "node", "copies", "vector"]]
        if not len(points) or len(given) < 2:
            return out.assign(cell=0, resident=True)
        given = given.sort_values("cell")
        c = np.stack([np.asarray(x) for x in given["centre"]])
        near = _unit(points["vector"]) @ c.T
        home = near.argmax(axis=1)
        gap = np.sqrt(np.maximum(0.0, 2.0 - 2.0 * (c @ c.T)))  # |c - h| of unit centres
        inside = near[np.arange(len(points)), home][:, None] - near <= sine * gap[home] + 1e-9
        row, cell = np.nonzero(inside)
        return out.iloc[row].assign(cell=cell, resident=cell == home[row])

    keys = ["label", "dim", "part"]
    return dealt.groupBy(*keys).cogroup(copies.groupBy(*keys)).applyInPandas(
        place, "label long, dim int, node long, copies long, vector array<float>, cell int, resident boolean")


def _spanning(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest row number that links a-b reach from each of ``n`` rows."""
    low = np.arange(n)
    while True:
        new = low.copy()
        np.minimum.at(new, a, low[b])
        np.minimum.at(new, b, low[a])
        new = new[new]
        if np.array_equal(new, low):
            return low
        low = new


def compare(group: pd.DataFrame, cosine: float = COSINE) -> pd.DataFrame:
    """Links of one group: per visitor the number of partners, and a spanning link.

    A row stands as resident in one block and as visitor in one; in the group
    of both it appears twice.
    """
    homes, guests = group[group["home"]], group[~group["home"]]
    out = {"node": [], "links": [], "other": []}
    if len(homes) and len(guests):
        h, g = _unit(homes["vector"]), _unit(guests["vector"])
        h_node, g_node, copies = homes["node"].to_numpy(), guests["node"].to_numpy(), homes["copies"].to_numpy()
        names, at = np.unique(np.concatenate([h_node, g_node]), return_inverse=True)
        h_at, g_at = at[:len(h)], at[len(h):]
        found_g, found_h, links = [], [], np.zeros(len(g), np.int64)
        for i in range(0, len(g), 256):
            hit = g[i:i + 256] @ h.T >= cosine
            hit &= g_node[i:i + 256, None] != h_node[None, :]
            links[i:i + 256] = hit @ copies
            x, y = np.nonzero(hit)
            found_g.append(g_at[x + i].astype(np.int32))
            found_h.append(h_at[y].astype(np.int32))
        low = _spanning(len(names), np.concatenate(found_g), np.concatenate(found_h))
        some = links > 0
        out = {"node": g_node[some], "links": links[some], "other": names[low[g_at[some]]]}
    return pd.DataFrame(out).astype({"node": "int64", "links": "int64", "other": "int64"})


def cell_links(placed: DataFrame, cosine: float = COSINE, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``(node, links, other)`` of all blocks of all cells."""
    cell = ["label", "dim", "cell"]
    sizes = placed.groupBy(*cell).agg(
        F.count(F.when(F.col("resident"), 1)).alias("homes"), F.count(F.lit(1)).alias("all"))
    blocks = sizes.where("homes > 0").select(
        *cell, F.ceil(F.col("homes") / block_rows).cast("int").alias("hs"),
        F.ceil(F.col("all") / block_rows).cast("int").alias("gs"))
    rows = placed.join(blocks, cell)
    drawn = F.xxhash64("node", F.lit("block"))
    home = rows.where("resident").select(
        *cell, "node", "copies", "vector", F.lit(True).alias("home"),
        F.pmod(drawn, "hs").cast("int").alias("hb"),
        F.explode(F.sequence(F.lit(0), F.col("gs") - 1)).alias("gb"))
    visit = rows.select(
        *cell, "node", "copies", "vector", F.lit(False).alias("home"),
        F.explode(F.sequence(F.lit(0), F.col("hs") - 1)).alias("hb"),
        F.pmod(drawn, "gs").cast("int").alias("gb"))
    return home.unionByName(visit).groupBy(*cell, "hb", "gb").applyInPandas(
        lambda group: compare(group, cosine), "node long, links long, other long")


def near_duplicates(vectors: DataFrame, cosine: float = COSINE, cell_rows: int = CELL_ROWS,
                    block_rows: int = BLOCK_ROWS) -> DataFrame:
    """One row per row of ``vectors(vec_id, embedding, label)``.

    Columns: vec_id, n_links (other rows linked directly), component_id (the
    smallest vec_id that links reach), kept (the row's id is its component's).
    Vectors that are null, empty, zero or hold null or non-finite components,
    and rows without a label, link with nothing; vectors of different lengths
    neither.  Null ids are a component's id only if it has no other; repeated
    rows link with each other.  An empty table gives no rows.
    """
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"),
                          F.col("embedding").cast("array<float>").alias("vector"),
                          F.col("label").cast("long").alias("label"))
    able = F.col("label").isNotNull() & _finite("vector")
    nodes = saved(rows.where(able).groupBy("label", "vector").agg(
        F.count(F.lit(1)).alias("copies"), F.min("vec_id").alias("first"))
        .withColumn("dim", F.size("vector")).withColumn("node", F.monotonically_increasing_id()), "vectors")
    placed = saved(assign(nodes, fit_centres(nodes, cell_rows), cosine), "cells")
    found = saved(cell_links(placed, cosine, block_rows), "links")
    linked = found.groupBy("node").agg(F.sum("links").alias("links"))
    roots = components(found.select(F.col("node").alias("a"), F.col("other").alias("b")))
    named = nodes.join(roots, "node", "left").join(linked, "node", "left").select(
        "label", "vector", "first", F.coalesce("root", "node").alias("root"),
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"))
    named = saved(named, "named")
    smallest = named.groupBy("root").agg(F.min("first").alias("smallest"))
    known = named.join(smallest, "root").select("label", "vector", "links", "smallest")
    single = rows.where(~F.coalesce(able, F.lit(False))).select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    many = rows.where(able).join(known, ["label", "vector"]).select(
        "vec_id", F.col("links").alias("n_links"), F.col("smallest").alias("component_id"))
    return many.unionByName(single).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
