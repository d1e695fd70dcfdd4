"""Guarded text-to-number expressions (JVM-side, codegen friendly).

Spark's `try_cast` accepts spellings a strict decimal reader rejects
(`12d`, `3f`) and gives NaN for 'nan'. Every conversion here first checks the
text against a plain decimal pattern, so only ordinary numbers pass.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Plain decimal with optional exponent: 12, 1e3, .5, 5., -1.2E-3.
DECIMAL_PATTERN = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
INTEGER_PATTERN = r"^[+-]?[0-9]+$"
INFINITY_PATTERN = r"(?i)^[+-]?(inf|infinity)$"

INT32_MIN, INT32_MAX = -2147483648, 2147483647
INT64_LIMIT = 9.2233720368547758e18


def _as_col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_number(c) -> Column:
    """Text to double; anything that is not a plain number becomes null (PRJ-11)."""
    s = F.trim(_as_col(c).cast("string"))
    ok = s.rlike(DECIMAL_PATTERN) | s.rlike(INFINITY_PATTERN)
    return F.when(ok, s.try_cast("double"))


def to_int64(c) -> Column:
    """Text to a 64-bit integer through the number reading of the text (PRJ-04).

    Integer text is cast exactly; other numbers must be whole ('1.0' -> 1,
    '1e3' -> 1000). Fractional, non-finite or unparsable text gives null;
    `int64_reject` tells a fractional value from a missing one.
    """
    s = F.trim(_as_col(c).cast("string"))
    d = to_number(c)
    whole = d.isNotNull() & (d == F.floor(d)) & (F.abs(d) < F.lit(INT64_LIMIT))
    return (F.when(s.rlike(INTEGER_PATTERN), s.try_cast("bigint"))
            .when(whole, d.try_cast("bigint")))


def int64_reject(c) -> Column:
    """True where the text is a number that no 64-bit integer holds exactly."""
    d = to_number(c)
    return F.coalesce(d.isNotNull() & to_int64(c).isNull(), F.lit(False))


def int32_overflow(c) -> Column:
    """True where a 64-bit value does not fit the 32-bit table column."""
    v = _as_col(c)
    return F.coalesce((v < F.lit(INT32_MIN)) | (v > F.lit(INT32_MAX)), F.lit(False))


def nan_to_null(c) -> Column:
    """NaN becomes null on a double column (PRJ-14)."""
    v = _as_col(c)
    return F.when(~F.isnan(v), v)
