"""Hourly aggregation and feature table (AGG-01, 02, 03, 10).

One exchange on `hour_ts`; partial aggregation runs before it, so a hot hour
is combined map-side instead of landing whole in one task. Where the rows
carry their order as one number (`_ordinal` of a loaded frame), the columns of
the feature table are first values read as numbers: fixed-width buffers, so
Spark plans a hash aggregate and sorts no raw row.

The chain is built as three DataFrame steps (prepare, group, finish), with
output columns and types worked out from one read of the input schema: a
long chain of small steps costs analysis time on the driver for nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattline.contracts import IDENTIFIER_COLUMNS, MISSING_SENTINEL, TARGET
from wattline.functions.numeric import to_number
from wattline.functions.timefmt import calendar_columns, floor_hour, reading_timestamp
from wattline.operators.clean import is_numeric
from wattline.operators.tables import join_hourly

# Row order carried by loaded frames: one number a row, or file name, split offset, row id.
ORDINAL = "_ordinal"
ORDER_COLUMNS = ["source_file", "_block_start", "_row_id"]
_INTERNAL = {"datetime", "hour_ts"}
_KEY = "_key"
_TIMED = "_timed"        # readings of an hour whose time is known
_ORDINAL_BITS = 51       # an ordinal and the second of the hour make one long


def _q(c: str) -> Column:
    return F.col(f"`{c}`")


def _first_expr(c: str, order_cols: list[str]) -> Column:
    """First non-null value of `c` in (datetime, *order_cols) order (AGG-02).

    The minimum of struct(order..., value) over the non-null rows: the
    answer is the same however rows are partitioned, unlike `first`, which
    depends on arrival order. (Same result as `min_by(value, order)`, but
    one comparison buffer instead of two, measurably cheaper.)
    """
    keys = ", ".join(["datetime"] + [f"`{o}`" for o in order_cols] + [f"`{c}` AS v"])
    return F.expr(f"min(struct({keys})) FILTER (WHERE `{c}` IS NOT NULL)").getField("v").alias(c)


def _plan(fields: list[T.StructField], order_cols: list[str] | None, numeric: str):
    """Which columns are averaged, which take their first value, in output order."""
    names = [f.name for f in fields]
    if order_cols is None:
        order_cols = [ORDINAL] if ORDINAL in names else ORDER_COLUMNS
    order_cols = [c for c in order_cols if c in names]
    types = {f.name: f.dataType for f in fields}
    if numeric == "mean" and TARGET in types:
        types[TARGET] = T.DoubleType()
    hidden = {c for c in names if c.startswith("_")}
    numeric_cols = [c for c in names if c not in hidden and is_numeric(types[c])]
    mean = TARGET in numeric_cols
    firsts = sorted(c for c in names if c not in hidden and c not in _INTERNAL and c not in numeric_cols)
    out_types = ([(TARGET, T.DoubleType())] if mean else []) + [(c, types[c]) for c in firsts]
    return order_cols, mean, firsts, out_types


def _one_long(order_cols: list[str], fields: list[T.StructField]) -> Column | None:
    """(datetime inside its hour, order) of a parsed reading as one long; None unless the order is one integer column.

    Layouts stop at seconds, so the second of the hour and the ordinal say it all. A null comes first, as it does in
    a struct; an ordinal that does not fit is an error, never a wrong order.
    """
    kinds = {f.name: f.dataType for f in fields}
    if len(order_cols) != 1 or not isinstance(kinds[order_cols[0]], T.IntegralType):
        return None
    ordinal = F.coalesce(_q(order_cols[0]).cast("long") + 1, F.lit(0))
    second = (F.minute("datetime") * 60 + F.second("datetime")).cast("long")
    return F.when((ordinal >= 0) & (ordinal < 2 ** _ORDINAL_BITS), second * 2 ** _ORDINAL_BITS + ordinal).otherwise(
        F.raise_error(F.lit(f"{order_cols[0]} is negative or beyond {_ORDINAL_BITS} bits")).cast("long"))


def _first_number(c: str) -> Column:
    """What `to_number` reads in the first non-null value of `c` by `_key`.

    The buffers are a double and a long, so this is a hash aggregate: no sort of the raw rows. The text is read only
    where a row comes before all others seen in its hour, since `min_by` looks at the value after the order.
    """
    return F.min_by(to_number(_q(c)), F.when(_q(c).isNotNull(), F.col(_KEY))).alias(c)   # a null order takes no part


def _grouped(prepared: DataFrame, order_cols: list[str], mean: bool, firsts: list[str],
             numbers: frozenset[str] = frozenset()) -> DataFrame:
    """One row per hour; the first values of `numbers` are read as numbers (they need the column `_key`)."""
    aggs = ([F.avg(_q(TARGET)).alias(TARGET)] if mean else []) + [
        _first_number(c) if c in numbers else _first_expr(c, order_cols) for c in firsts]
    hour = floor_hour(F.col("datetime")).alias("hour_ts")
    return prepared.groupBy(hour).agg(*aggs, F.count("datetime").alias(_TIMED))


def _valid(grouped: DataFrame) -> DataFrame:
    """Without the null hour, which holds the rows whose time does not parse (FLT-03).

    Told by the count of times, not by the hour itself: a filter on the hour would be pushed below the grouping,
    where the parse of the timestamp would be inlined and run a second time for every raw row.
    """
    return grouped.where(F.col(_TIMED) > 0).drop(_TIMED)


def hourly_aggregate(df: DataFrame, order_cols: list[str] | None = None,
                     numeric: str = "auto", known_time: bool = False) -> DataFrame:
    """Group readings that already carry `datetime` by its hour (AGG-01 + AGG-02).

    A numeric `consommation` is averaged and every other numeric column is
    dropped; each non-numeric column keeps its first non-null value in
    (datetime, *order_cols) order. Output: `datetime` (the hour), then
    `consommation` when averaged, then the other columns alphabetically.
    numeric='mean' forces the mean: `consommation` is read as a number first;
    known_time=True leaves out the readings without a time (FLT-03).
    """
    order_cols, mean, firsts, _ = _plan(df.schema.fields, order_cols, numeric)
    if numeric == "mean" and TARGET in df.columns:
        df = df.withColumn(TARGET, to_number(_q(TARGET)))
    out = _grouped(df, order_cols, mean, firsts)
    out = _valid(out) if known_time else out.drop(_TIMED)
    return out.withColumnRenamed("hour_ts", "datetime")


def _prepare(df: DataFrame, numeric: str) -> tuple[DataFrame, list[T.StructField]]:
    """Sentinel -> null in text columns (PRJ-05) and the parsed `datetime` (PRJ-06), one select."""
    fields = df.schema.fields
    cleaned = {f.name: (F.nullif(_q(f.name), F.lit(MISSING_SENTINEL))
                        if isinstance(f.dataType, T.StringType) else _q(f.name)) for f in fields}
    if numeric == "mean" and TARGET in cleaned:
        cleaned[TARGET] = to_number(cleaned[TARGET])
    ts = reading_timestamp(cleaned["date"], cleaned["heures"]).alias("datetime")
    return df.select(*[e.alias(n) for n, e in cleaned.items()], ts), fields


def aggregate_hourly(df: DataFrame, order_cols: list[str] | None = None,
                     numeric: str = "auto") -> DataFrame:
    """The whole hourly operator (AGG-03): sentinel -> time -> group -> drop bad.

    Rows whose timestamp does not parse all fall in the null hour, which is
    dropped after the grouping (FLT-03).
    """
    prepared, fields = _prepare(df, numeric)
    order_cols, mean, firsts, out_types = _plan(fields, order_cols, numeric)
    grouped = _grouped(prepared, order_cols, mean, firsts)
    return (_valid(grouped)
            .select(F.col("hour_ts").alias("datetime"), *[_q(c) for c, _ in out_types]))


def _finish(grouped: DataFrame, out_types: list[tuple[str, T.DataType]], keep: dict[str, Column]) -> DataFrame:
    """Calendar (PRJ-08), drop identifiers (PRJ-09), text read as numbers (PRJ-11) and zero fill (PRJ-10), in one select."""
    cols = [e.alias(k) for k, e in keep.items()]
    for name, dtype in out_types:
        if name not in IDENTIFIER_COLUMNS:
            c = _q(name)
            cols.append((F.coalesce(c, F.lit(0).cast(dtype)) if is_numeric(dtype)
                         else F.coalesce(to_number(c), F.lit(0.0))).alias(name))
    cols += [v.alias(k) for k, v in calendar_columns(F.col("hour_ts")).items()]
    return _valid(grouped).select(*cols)


def feature_table(df: DataFrame, order_cols: list[str] | None = None, numeric: str = "auto",
                  weather: DataFrame | None = None, keep: dict[str, Column] | None = None) -> DataFrame:
    """Flagship (AGG-10 end to end): readings -> hourly features with a numeric target.

    Text columns (the target among them) are read as numbers, anything else
    -> null, and every null becomes 0 (PRJ-10, PRJ-11). `weather` (rows with
    `hour_ts` on the readings' clock and numeric columns) is averaged per hour
    and joined in (JON-02). `keep` names expressions over `hour_ts` that stand
    first and are left as they are, such as the year of a partitioned table.
    """
    prepared, fields = _prepare(df, numeric)
    order_cols, mean, firsts, out_types = _plan(fields, order_cols, numeric)
    if weather is not None and not out_types:
        raise ValueError("readings have no column to join weather to")
    key, numbers = _one_long(order_cols, fields), frozenset()
    if key is not None:
        prepared = prepared.withColumn(_KEY, key)
        firsts = [c for c in firsts if c not in IDENTIFIER_COLUMNS]      # the others are not part of the table
        numbers = frozenset(firsts)
        out_types = [(c, T.DoubleType() if c in numbers else t) for c, t in out_types if c == TARGET or c in numbers]
    grouped = _grouped(prepared, order_cols, mean, firsts, numbers)
    if weather is not None:
        grouped = join_hourly(grouped, weather)
        known = {name for name, _ in out_types} | {"hour_ts", _TIMED}
        out_types = out_types + [(f.name, f.dataType) for f in grouped.schema.fields if f.name not in known]
    return _finish(grouped, out_types, keep or {})
