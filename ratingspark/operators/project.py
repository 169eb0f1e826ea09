"""Low-dimensional coordinates of vectors.

``pyspark.ml.feature.PCA`` does not centre its input, so a mean-only
``StandardScaler`` runs first (the scikit-learn convention).  Both fit by a
distributed aggregate of d x d statistics; only the d x k loadings reach the
driver.  Component signs are arbitrary in any eigen solver: each component
is flipped so that its largest-magnitude loading is positive, which makes
the output repeatable.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.ml.feature import PCA, StandardScaler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def pca_coords(vectors: DataFrame, k: int = 2, features: str = "features",
               keep: Sequence[str] = ("item_id",), prefix: str = "pc") -> DataFrame:
    """``keep..., pc1..pck``: coordinates on the first k principal components."""
    vec = vectors.select(*keep, array_to_vector(F.col(features).cast("array<double>"))
                         .alias("_v"))
    scaler = StandardScaler(withMean=True, withStd=False, inputCol="_v", outputCol="_c").fit(vec)
    centred = scaler.transform(vec)
    model = PCA(k=k, inputCol="_c", outputCol="_p").fit(centred)
    pc = model.pc.toArray()  # d x k
    signs = [1.0 if pc[int(np.argmax(np.abs(pc[:, j]))), j] >= 0 else -1.0 for j in range(k)]
    out = model.transform(centred).select(*keep, vector_to_array("_p").alias("_a"))
    return out.select(*keep, *[(F.col("_a").getItem(j) * F.lit(signs[j])).alias(f"{prefix}{j + 1}")
                               for j in range(k)])


def explained_variance(vectors: DataFrame, k: int = 2, features: str = "features") -> list[float]:
    """Share of variance of the first k components (a bounded list)."""
    vec = vectors.select(array_to_vector(F.col(features).cast("array<double>")).alias("_v"))
    centred = StandardScaler(withMean=True, withStd=False, inputCol="_v",
                             outputCol="_c").fit(vec).transform(vec)
    model = PCA(k=k, inputCol="_c", outputCol="_p").fit(centred)
    return [float(x) for x in model.explainedVariance.toArray()]
