"""Scalar expression helpers re-expressing the reference's SQL functions.

All of them build JVM-side Catalyst expressions; none is a Python UDF, so they
stay inside whole-stage code generation.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

__all__ = [
    "safe_div", "greater", "nullif", "safe_double", "safe_bigint", "strict_bigint",
    "parse_date_two_formats", "month_start", "flag", "bool_flag", "clamp_or_null",
    "strip_commas", "make_date_or_null", "year_quarter_parts",
    "month_to_quarter", "three_way_signal",
]

# Text shapes accepted by a strict numeric cast (no Java "1d"/"2f" suffixes).
_FLOAT_TEXT = r"^\s*[+-]?((\d+\.?\d*)|(\.\d+))([eE][+-]?\d+)?\s*$"
_SPECIAL_FLOAT_TEXT = r"(?i)^\s*[+-]?(nan|inf|infinity)\s*$"
_INT_TEXT = r"^\s*[+-]?\d+\s*$"
_INF = float("inf")


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def nullif(x, value) -> Column:
    return F.nullif(_c(x), F.lit(value))


def safe_div(a, b) -> Column:
    """SAFE_DIVIDE: NULL when the divisor is 0 or NULL, and when finite numbers
    overflow (never raises)."""
    a, b = _c(a).cast("double"), _c(b).cast("double")
    q = F.try_divide(a, b)
    return F.when((F.abs(q) == _INF) & (F.abs(a) < _INF), F.lit(None)).otherwise(q)


def greater(a, b) -> Column:
    """``a > b`` of doubles where a NaN on either side compares as false (Spark
    orders NaN above every number); NULL stays NULL."""
    a, b = _c(a), b if isinstance(b, Column) else F.lit(b)
    return (a > b) & ~F.isnan(a.cast("double")) & ~F.isnan(b.cast("double"))


def safe_double(x, dtype: T.DataType | None = None) -> Column:
    """SAFE_CAST(x AS FLOAT64).

    Numeric inputs are widened directly.  Text must look like a number: Spark's
    own cast also accepts Java suffixes such as ``1d``/``2f``, which a strict
    cast rejects, so text is checked against a numeric pattern first.
    """
    col = _c(x)
    if dtype is not None and isinstance(dtype, T.NumericType):
        return col.cast("double")
    s = col.cast("string")
    ok = s.rlike(_FLOAT_TEXT) | s.rlike(_SPECIAL_FLOAT_TEXT)
    return F.when(ok, F.trim(s).try_cast("double"))


def safe_bigint(x, dtype: T.DataType | None = None) -> Column:
    """SAFE_CAST(x AS INT64): text must be an integer literal; floats round
    half away from zero; overflow gives NULL."""
    col = _c(x)
    if dtype is not None and isinstance(dtype, (T.FloatType, T.DoubleType, T.DecimalType)):
        return F.round(col.cast("double")).try_cast("bigint")
    if dtype is not None and isinstance(dtype, T.IntegralType):
        return col.cast("bigint")
    s = col.cast("string")
    return F.when(s.rlike(_INT_TEXT), F.trim(s).try_cast("bigint"))


def strict_bigint(x, dtype: T.DataType | None = None) -> Column:
    """CAST(x AS INT64): fails the job on bad text (ANSI cast); floats round
    half away from zero first."""
    col = _c(x)
    if dtype is not None and isinstance(dtype, (T.FloatType, T.DoubleType, T.DecimalType)):
        return F.round(col.cast("double")).cast("bigint")
    return col.cast("bigint")


def strip_commas(x) -> Column:
    """REPLACE(CAST(x AS STRING), ',', '')."""
    return F.replace(_c(x).cast("string"), F.lit(","), F.lit(""))


def parse_date_two_formats(x) -> Column:
    """COALESCE(SAFE.PARSE_DATE('%Y-%m-%d', s), SAFE.PARSE_DATE('%Y%m%d', s)).

    ``y-M-d`` (not ``yyyy-MM-dd``) so one-digit months/days parse as well; the
    text is checked first, as that pattern also takes signs, year 0 and longer years.
    """
    s = _c(x).cast("string")
    dashed = F.when(s.rlike(r"^(?!0+-)\d{1,4}-\d{1,2}-\d{1,2}\z"), s)
    plain = F.when(s.rlike(r"^(?!0000)\d{8}\z"), s)
    return F.coalesce(F.try_to_date(dashed, "y-M-d"), F.try_to_date(plain, "yyyyMMdd"))


def month_start(x) -> Column:
    """PARSE_DATE('%Y-%m', s): one-digit months parse; anything else fails the job."""
    s = _c(x)
    return F.to_date(F.when(s.rlike(r"^(?!0+-)\d{1,4}-\d{1,2}\z"), s).otherwise(F.concat(F.lit("not a month: "), s)), "y-M")


def flag(cond: Column) -> Column:
    """IF(cond, 1, 0) as INT64: a NULL condition gives 0."""
    return F.when(cond, F.lit(1)).otherwise(F.lit(0)).cast("bigint")


def bool_flag(cond: Column) -> Column:
    """CASE WHEN cond THEN TRUE ELSE FALSE END."""
    return F.when(cond, F.lit(True)).otherwise(F.lit(False))


def clamp_or_null(x, lo: float, hi: float) -> Column:
    """GREATEST(lo, LEAST(hi, x)) with NULL propagation (Spark skips NULLs)."""
    col = _c(x)
    return F.when(col.isNotNull(), F.greatest(F.lit(lo), F.least(F.lit(hi), col)))


def make_date_or_null(y, m, d) -> Column:
    """DATE(y, m, d): NULL if any part is NULL."""
    return F.make_date(_c(y).cast("int"), _c(m).cast("int"), _c(d).cast("int"))


def year_quarter_parts(yq) -> tuple[Column, Column]:
    """Strictly parsed (year, quarter) of a ``YYYY-Q`` label, NULL if malformed.

    ``\\z`` instead of ``$``: Java's ``$`` also matches before a final newline.
    """
    s = _c(yq)
    year = F.regexp_extract(s, r"^(\d{4})-[1-4]\z", 1).try_cast("bigint")
    quarter = F.regexp_extract(s, r"^\d{4}-([1-4])\z", 1).try_cast("bigint")
    return year, quarter


def month_to_quarter(ym) -> Column:
    """Latest quarter whose statements are public in a given revenue month.

    Fixed values: months 01,02 -> (Y-1)-3; 03,04 -> (Y-1)-4; 05,06,07 -> Y-1;
    08,09,10 -> Y-2; 11,12 -> Y-3.
    """
    s = _c(ym)
    mm = F.substring(s, 6, 2)
    yyyy = F.substring(s, 1, 4)
    prev_year = (yyyy.cast("bigint") - 1).cast("string")
    return (F.when(mm.isin("01", "02"), F.concat(prev_year, F.lit("-3")))
             .when(mm.isin("03", "04"), F.concat(prev_year, F.lit("-4")))
             .when(mm.isin("05", "06", "07"), F.concat(yyyy, F.lit("-1")))
             .when(mm.isin("08", "09", "10"), F.concat(yyyy, F.lit("-2")))
             .when(mm.isin("11", "12"), F.concat(yyyy, F.lit("-3"))))


def three_way_signal(x, high: float, mid: float) -> Column:
    """NULL stays NULL; >= high -> 1; >= mid -> 0; else -1 (INT64)."""
    col = _c(x)
    return (F.when(col.isNull(), F.lit(None))
             .when(col >= F.lit(high), F.lit(1))
             .when(col >= F.lit(mid), F.lit(0))
             .otherwise(F.lit(-1))).cast("bigint")

