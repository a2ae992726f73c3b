"""Deterministic rounding of floating-point outputs for cross-engine checks.

Sums, averages, ``exp``/``ln`` and ``pow`` may differ in the last bits between
Spark and another engine.  Each double is rounded to a binary significand of
24-28 bits with ``floor(x * s + 0.5) / s`` where ``s`` is a power of two picked
from a fixed ladder of magnitude bands.  Scaling by a power of two is exact,
so every engine rounds identically, and the rounding midpoints are dyadic
numbers: decimal "nice" results such as 1121 x 0.95^2 = 1011.7025 never sit on
one (they would on a decimal grid).  The same ladder is emitted as SQL for the
DuckDB twin.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# fixed values: bands [2^e, 2^(e+4)) for e = 40, 36, ..., -4 keep 24 bits below
# the band; anything smaller than 2^-4 is rounded on the absolute grid 2^-28,
# so cancellation noise (x - mean(x) = 1e-16 instead of 0) rounds to zero.
BANDS = list(range(40, -8, -4))
BITS = 24


def _scale(e: int) -> float:
    return float(2.0 ** (BITS - e))


def round_sig(x: Column) -> Column:
    ax = F.abs(x)
    s = None
    for e in BANDS:
        cond = ax >= F.lit(float(2.0 ** e))
        val = F.lit(_scale(e))
        s = F.when(cond, val) if s is None else s.when(cond, val)
    s = s.otherwise(F.lit(_scale(BANDS[-1])))
    return F.floor(x * s + F.lit(0.5)) / s


def round_sig_sql(col: str) -> str:
    parts = " ".join(f"WHEN abs({col}) >= {float(2.0 ** e)!r} THEN {_scale(e)!r}" for e in BANDS)
    s = f"(CASE {parts} ELSE {_scale(BANDS[-1])!r} END)"
    return f"(floor({col} * {s} + 0.5) / {s})"


def stabilize(df: DataFrame) -> DataFrame:
    return df.select(*[round_sig(F.col(f"`{f.name}`")).alias(f.name)
                       if isinstance(f.dataType, T.DoubleType) else F.col(f"`{f.name}`")
                       for f in df.schema.fields])


def flatten(df: DataFrame, struct_col: str, prefix: str) -> DataFrame:
    """Replace a struct column by one column per field (``prefix + field``)."""
    st = df.schema[struct_col].dataType
    cols = []
    for c in df.columns:
        if c == struct_col:
            cols += [F.col(c).getField(f.name).alias(prefix + f.name) for f in st.fields]
        else:
            cols.append(F.col(c))
    return df.select(*cols)
