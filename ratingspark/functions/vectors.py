"""Column expressions over feature vectors (all JVM-side, codegen friendly).

Vectors travel in two layouts:

* ``ARRAY<DOUBLE>`` for storage and for the explore stage;
* wide double columns ``f0 .. f{d-1}`` inside iterative loops, where they let
  every step plan as a hash aggregate inside whole-stage codegen.

Distances and dot products are unrolled over a known dimension instead of
using higher-order functions, which fall outside whole-stage codegen.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def col_of(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def wide_names(d: int, prefix: str = "f") -> list[str]:
    return [f"{prefix}{k}" for k in range(d)]


def to_array(cols: Sequence[str | Column]) -> Column:
    """Pack positional columns into one ``ARRAY<DOUBLE>``."""
    return F.array(*[col_of(c).cast("double") for c in cols])


def to_wide(array_col: str | Column, d: int, prefix: str = "f") -> list[Column]:
    """Unpack an array column into ``d`` double columns ``prefix0..``."""
    a = col_of(array_col)
    return [a.getItem(k).cast("double").alias(f"{prefix}{k}") for k in range(d)]


def dot(a: Sequence[str | Column], b: Sequence[str | Column]) -> Column:
    """Unrolled dot product of two equally long column lists (V1)."""
    if len(a) != len(b):
        raise ValueError("dot: vectors of different length")
    return reduce(add, [col_of(x) * col_of(y) for x, y in zip(a, b)])


def squared_norm(cols: Sequence[str | Column]) -> Column:
    return reduce(add, [col_of(c) * col_of(c) for c in cols])


def l2_to_probe(array_col: str | Column, probe: Sequence[float]) -> Column:
    """Euclidean distance of an array column to a fixed probe vector (V5).

    The probe is a bounded driver-side value (``d`` doubles) and is inlined
    as literals, so the distance is one codegen'd projection with no join.
    """
    a = col_of(array_col)
    terms = [(a.getItem(k) - F.lit(float(p))) * (a.getItem(k) - F.lit(float(p)))
             for k, p in enumerate(probe)]
    return F.sqrt(reduce(add, terms))


def l2_between(a_col: str | Column, b_col: str | Column, d: int) -> Column:
    """Euclidean distance between two array columns of dimension ``d``."""
    a, b = col_of(a_col), col_of(b_col)
    terms = [(a.getItem(k) - b.getItem(k)) * (a.getItem(k) - b.getItem(k)) for k in range(d)]
    return F.sqrt(reduce(add, terms))


def inverse_distance(distance: str | Column) -> Column:
    """Similarity = 1 / distance (V6); zero distances must be removed first."""
    return F.lit(1.0) / col_of(distance)


def vector_dim(df: DataFrame, features: str = "features") -> int:
    """Dimension of the vectors; vectors of different lengths are an error."""
    size = F.when(F.col(features).isNotNull(), F.size(features))
    low, high = df.agg(F.min(size), F.max(size)).first()
    if low is None:
        raise ValueError("no vectors to take a dimension from")
    if low != high:
        raise ValueError(f"vectors of different lengths: {low} to {high}")
    return int(low)


def vector_text(id_col: str | Column, cols: Sequence[str | Column], scale: int | None = None) -> Column:
    """``id,f0,f1,...`` text line (V8).

    Values are written with the digits that read back as the same double, or
    as fixed-point decimals with ``scale`` digits.  A null is an empty field.
    """
    kind = "double" if scale is None else f"decimal(38,{scale})"
    parts = [col_of(id_col).cast("string")] + [col_of(c).cast(kind).cast("string") for c in cols]
    return F.concat_ws(",", *[F.coalesce(p, F.lit("")) for p in parts])


def parse_vector_text(text_col: str | Column, d: int, id_type: str = "bigint") -> list[Column]:
    """Split ``id,f0,...`` text into typed columns ``id, f0..`` (V9)."""
    parts = F.split(col_of(text_col), ",")
    return [parts.getItem(0).cast(id_type).alias("id")] + [
        F.nullif(parts.getItem(k + 1), F.lit("")).cast("double").alias(f"f{k}") for k in range(d)
    ]
