"""Items stored by cell, so that a nearest-item search skips most of them (V5, L1, L3).

Spark's k-means, fitted on a bounded hashed sample, gives the centres; every
item goes to its nearest centre's cell, and the cell's radius is measured over
all of its items.  No item of a cell can be nearer to a probe than the distance
to the centre less the radius (triangle inequality), so a search opens cells in
the order of that bound and stops when the k-th item found is nearer than every
bound that is left.  The result is that of a full scan, whatever the centres.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.vectors import l2_to_probe, vector_dim
from ..session import folder_exists

#: Items a cell should hold; cells at most; items a centre is fitted on; rounds of k-means.
CELL_ITEMS, MAX_CELLS, SAMPLE_PER_CELL, ROUNDS = 5_000, 1_024, 64, 10


@dataclass
class CellIndex:
    """Items by cell (``items/cell=<n>/``) and a small table of cells (centre, radius, n)."""

    spark: SparkSession
    folder: str

    @property
    def items(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/items")

    @property
    def cells(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/cells")

    def bounds(self, probe: Sequence[float]) -> list[tuple[float, int, int]]:
        """``(least distance of its items, cell, n)`` in ascending order: a row for each cell, ``MAX_CELLS`` at most."""
        d = l2_to_probe("centre", probe)
        least = F.greatest(d - F.col("radius") - F.lit(1e-9) * (F.lit(1.0) + d), F.lit(0.0))
        return sorted(tuple(r) for r in self.cells.select(least.alias("least"), "cell", "n").collect())

    def nearest(self, probe: Sequence[float], k: int, drop_zero: bool = True, id_col: str = "item_id",
                features: str = "features") -> tuple[DataFrame, int]:
        """The ``k`` items nearest to the probe, ties by id, with ``distance``; and how many items were read.

        Zero distances (the probe itself and its copies) are left out unless ``drop_zero`` is off.
        """
        if k < 1:
            raise ValueError("k is at least 1")
        bounds = self.bounds(probe)
        opened, reach = 0, math.inf

        def found(cells: list[int]) -> DataFrame:
            near = self.items.where(F.col("cell").isin(cells)).withColumn("distance", l2_to_probe(features, probe))
            near = near.where(F.col("distance") != 0) if drop_zero else near
            return near.drop("cell").orderBy(F.col("distance").asc(), F.col(id_col).asc()).limit(k)

        while True:
            # first enough cells to hold k items (twice as many each time), then all that may hold a nearer one
            wanted, held = opened, 0
            while wanted < len(bounds) and (held < k if reach == math.inf else bounds[wanted][0] <= reach):
                held += bounds[wanted][2]
                wanted += 1
            if wanted == opened and opened:
                break
            wanted = min(len(bounds), max(wanted, 2 * opened if reach == math.inf else wanted))
            opened = wanted
            best = found([cell for _, cell, _ in bounds[:opened]])
            kth = best.select("distance").collect()  # k numbers
            reach = max(r["distance"] for r in kth) if len(kth) == k else math.inf
            if opened == len(bounds):
                break
        return best, sum(n for _, _, n in bounds[:opened])


def write_cells(items: DataFrame, folder: str, features: str = "features", id_col: str = "item_id",
                cell_items: int = CELL_ITEMS, seed: int = 42) -> CellIndex:
    """Writes ``items`` by cell below ``folder`` and returns the index.

    Items without a vector, or with a null or non-finite element, can be near
    nothing and are left out; vectors of different lengths are an error.  Equal
    vectors share a cell.  No items give an index that finds nothing.
    """
    spark, folder = items.sparkSession, folder.rstrip("/")
    if folder_exists(spark, folder):
        raise ValueError(f"{folder} exists")
    able = F.coalesce(F.col(features).isNotNull() & F.forall(
        features, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))
    rows = items.where(able).withColumn("_v", array_to_vector(F.col(features).cast("array<double>")))
    n = rows.count()
    if n:
        vector_dim(rows, features)
    # an item is compared with every centre, so that more cells than the root of the items cost more than they spare
    k = max(1, min(MAX_CELLS, math.ceil(n / cell_items), math.ceil(math.sqrt(n))))
    if k > 1:
        share = min(1.0, k * SAMPLE_PER_CELL / n)
        place = F.pmod(F.xxhash64(id_col, F.lit(seed)), F.lit(1 << 30)) / float(1 << 30)
        model = KMeans(k=k, seed=seed, maxIter=ROUNDS, featuresCol="_v", predictionCol="cell").fit(rows.where(place < share))
        centres = spark.createDataFrame([(i, [float(x) for x in c]) for i, c in enumerate(model.clusterCenters())],
                                        "cell int, centre array<double>")
        placed = model.transform(rows).drop("_v")
    else:
        first = rows.select(features).first()
        centres = spark.createDataFrame([(0, [float(x) for x in first[0]])] if first else [], "cell int, centre array<double>")
        placed = rows.drop("_v").withColumn("cell", F.lit(0))
    # a cell in few files, and one that holds many items in several
    placed.repartitionByRange("cell", id_col).write.partitionBy("cell").parquet(f"{folder}/items")
    if not n:  # no partition was written, and so no schema
        placed.write.mode("overwrite").parquet(f"{folder}/items")
    away = F.sqrt(F.aggregate(F.zip_with(F.col(features), F.col("centre"), lambda a, b: (a - b) * (a - b)),
                              F.lit(0.0), lambda total, x: total + x))
    written = spark.read.parquet(f"{folder}/items")
    radii = written.join(F.broadcast(centres), "cell").groupBy("cell").agg(
        F.max(away).alias("radius"), F.count(F.lit(1)).alias("n"))
    radii.join(F.broadcast(centres), "cell").select("cell", "centre", "radius", "n").coalesce(1).write.parquet(f"{folder}/cells")
    return CellIndex(spark, folder)
