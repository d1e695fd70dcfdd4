"""Row-wise cleaning: conform, cast, sentinels, fills, keys (PRJ-*, FLT-03).

All of these are narrow projections: no shuffle, fused into the scan's
whole-stage codegen span.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattline.contracts import (
    CONSUMPTION_COLUMNS, CONSUMPTION_TEXT_COLUMNS, IDENTIFIER_COLUMNS, MISSING_SENTINEL,
)
from wattline.functions.numeric import int32_overflow, int64_reject, nan_to_null, to_int64, to_number
from wattline.functions.timefmt import floor_hour, reading_timestamp

_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType,
            T.DoubleType, T.DecimalType)


def is_numeric(dtype: T.DataType) -> bool:
    return isinstance(dtype, _NUMERIC)


def conform_positional(df: DataFrame, names: list[str]) -> DataFrame:
    """Map columns to `names` by position (PRJ-02).

    Missing trailing columns are padded with null strings, surplus ones are
    cut, then everything is renamed to `names`.
    """
    cols = df.columns
    exprs = [F.col(f"`{cols[i]}`").alias(n) if i < len(cols) else F.lit(None).cast("string").alias(n)
             for i, n in enumerate(names)]
    return df.select(*exprs)


def conform_by_name(df: DataFrame, names: list[str], source_names: list[str] | None = None) -> DataFrame:
    """Map columns to `names` by name; absent ones become null strings.

    `source_names[i]` is the frame column feeding `names[i]` (defaults to
    `names`). This is the safe default for loading: a lineage column such as
    `source_file` can neither be cut off nor shift the others.
    """
    source_names = source_names or names
    present = set(df.columns)
    exprs = [(F.col(f"`{s}`") if s in present else F.lit(None).cast("string")).alias(n)
             for s, n in zip(source_names, names)]
    return df.select(*exprs)


def cast_columns(df: DataFrame, text_columns: list[str]) -> DataFrame:
    """Text columns stay strings; every other column becomes a 64-bit integer (PRJ-04).

    Unparsable cells become null. Cells holding a fractional number also
    become null here; `reject_reasons` reports them so the row can be set aside.
    """
    text = set(text_columns)
    return df.select(*[
        (F.col(f"`{c}`").cast("string") if c in text else to_int64(F.col(f"`{c}`"))).alias(c)
        for c in df.columns
    ])



def reject_reasons(raw: DataFrame, int_columns: list[str]) -> Column:
    """Array of `column:reason` for one raw (string) row; empty when the row is valid.

    Reasons: `fraction` (a number that is not whole), `int64` (a whole number
    beyond 64 bits, or an infinity) and `int32` (does not fit the 32-bit table
    column).
    """
    checks = []
    for c in int_columns:
        v = F.col(f"`{c}`")
        number = to_number(v)
        beyond = (number % 1 == 0) | (F.abs(number) == float("inf"))
        checks.append(F.when(int64_reject(v), F.when(beyond, F.lit(f"{c}:int64")).otherwise(F.lit(f"{c}:fraction"))))
        checks.append(F.when(int32_overflow(to_int64(v)), F.lit(f"{c}:int32")))
    return F.filter(F.array(*checks), lambda x: x.isNotNull())


def sentinel_to_null(df: DataFrame, sentinel: str = MISSING_SENTINEL) -> DataFrame:
    """Whole cells equal to the sentinel become null, in every string column (PRJ-05)."""
    return df.select(*[
        F.nullif(F.col(f"`{f.name}`"), F.lit(sentinel)).alias(f.name)
        if isinstance(f.dataType, T.StringType) else F.col(f"`{f.name}`")
        for f in df.schema.fields
    ])


def with_reading_time(df: DataFrame, date_col: str = "date", time_col: str = "heures") -> DataFrame:
    """Add `datetime` (parsed, PRJ-06) and `hour_ts` (floored, PRJ-07)."""
    ts = reading_timestamp(F.col(date_col), F.col(time_col))
    return df.withColumn("datetime", ts).withColumn("hour_ts", floor_hour(F.col("datetime")))


def valid_time(df: DataFrame, col: str = "hour_ts") -> DataFrame:
    """Rows whose timestamp did not parse leave the result (FLT-03)."""
    return df.where(F.col(col).isNotNull())


def drop_identifiers(df: DataFrame, names: list[str] = IDENTIFIER_COLUMNS) -> DataFrame:
    """Drop identifier columns; absent ones are ignored (PRJ-09)."""
    return df.drop(*names)


def fill_zero(df: DataFrame) -> DataFrame:
    """Null becomes 0 in every column (PRJ-10); strings get the text '0'.

    Other types (timestamps, arrays) are left as they are.
    """
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if is_numeric(f.dataType):
            c = F.coalesce(c, F.lit(0).cast(f.dataType))
        elif isinstance(f.dataType, T.StringType):
            c = F.coalesce(c, F.lit("0"))
        cols.append(c.alias(f.name))
    return df.select(*cols)


def row_key(*cols: str, sep: str = "_") -> Column:
    """Composite text key such as `périmètre_date_heures` (PRJ-13).

    A missing part is spelled 'None', as a formatted key would show it.
    """
    return F.concat_ws(sep, *[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("None")) for c in cols])


def nan_to_null_all(df: DataFrame) -> DataFrame:
    """NaN becomes null in every floating column before writing (PRJ-14)."""
    return df.select(*[
        nan_to_null(F.col(f"`{f.name}`")).alias(f.name)
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else F.col(f"`{f.name}`")
        for f in df.schema.fields
    ])
