"""Deterministic hashing expressions.

Randomness in the library is a pure function of (seed, row content) so that
results do not depend on partitioning, on task retries or on the engine:
the same expressions are written in DuckDB SQL for the oracle checks.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .vectors import col_of

NULL_TOKEN = "\\N"


def canonical_text(df: DataFrame, cols: Sequence[str]) -> list[Column]:
    """Engine-independent text of each column, used as hash input.

    Floating values are written as fixed-point ``DECIMAL(38,9)`` text, which
    prints the same in Spark and DuckDB; nulls become ``\\N``.
    """
    out = []
    for name in cols:
        dtype = df.schema[name].dataType
        c = F.col(name)
        if isinstance(dtype, (T.DoubleType, T.FloatType)):
            txt = c.cast("decimal(38,9)").cast("string")
        else:
            txt = c.cast("string")
        out.append(F.coalesce(txt, F.lit(NULL_TOKEN)))
    return out


def row_key(df: DataFrame, cols: Sequence[str], seed: int) -> Column:
    """md5 hex of ``seed|col1|col2|...``: a seeded, repeatable shuffle key."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *canonical_text(df, cols)))


def hex_prefix_int(hex_col: str | Column, start: int, length: int) -> Column:
    """Integer value of ``length`` hex digits starting at 1-based ``start``."""
    return F.conv(F.substring(col_of(hex_col), start, length), 16, 10).cast("bigint")


def hash_normal(seed: int, side: str | Column, id_col: str | Column, k: int | Column) -> Column:
    """Standard normal draw for (seed, side, id, k) by Box-Muller over md5 (M5).

    Two 52-bit integers are cut from the md5 hex digest and mapped to open
    uniforms ``(x + 0.5) / 2**52``; ``sqrt(-2 ln u1) * cos(2 pi u2)`` follows.
    The side name salts the stream so users and items do not share draws.
    """
    kcol = k if isinstance(k, Column) else F.lit(int(k))
    side_col = side if isinstance(side, Column) else F.lit(side)
    h = F.md5(F.concat_ws(":", F.lit(str(seed)), side_col,
                          col_of(id_col).cast("string"), kcol.cast("string")))
    scale = float(2 ** 52)
    u1 = (hex_prefix_int(h, 1, 13).cast("double") + F.lit(0.5)) / F.lit(scale)
    u2 = (hex_prefix_int(h, 14, 13).cast("double") + F.lit(0.5)) / F.lit(scale)
    return F.sqrt(F.lit(-2.0) * F.log(u1)) * F.cos(F.lit(2.0 * math.pi) * u2)
