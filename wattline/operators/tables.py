"""Keyed Parquet tables: lookups, not-exists, insert-if-absent, appends.

A row-at-a-time "SELECT then INSERT" becomes one set-based job:
dedupe the batch on its key, anti-join it against the stored keys, append.
Parquet enforces neither keys nor NOT NULL, so both are checked here.
"""

from __future__ import annotations

from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from wattline.operators import commits
from wattline.session import shared_root


def _c(name: str) -> Column:
    return F.col(f"`{name}`")


# ---------------------------------------------------------------------------
# Filters (FLT-01, FLT-02)
# ---------------------------------------------------------------------------

def lookup(df: DataFrame, **key_values) -> DataFrame:
    """Rows whose columns equal the given values (a conjunction of `=`).

    Plain equality: a null value matches nothing, as in SQL. Parquet gets the
    predicates pushed down, so row groups outside the key are skipped.
    """
    cond = reduce(lambda a, b: a & b, [_c(k) == F.lit(v) for k, v in key_values.items()])
    return df.where(cond)


# ---------------------------------------------------------------------------
# Set operations and joins (SET-01, JON-01, JON-02)
# ---------------------------------------------------------------------------

def union_by_name(frames: list[DataFrame]) -> DataFrame:
    """Concatenate by column name; duplicates kept, missing columns null (SET-01).

    Columns come out in first-seen order.
    """
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def key_match(left: DataFrame, right: DataFrame, key: list[str]) -> Column:
    """Null-safe equality on every key column (a null key matches a null key)."""
    return reduce(lambda a, b: a & b, [left[f"`{k}`"].eqNullSafe(right[f"`{k}`"]) for k in key])


def not_existing(incoming: DataFrame, stored: DataFrame, key: list[str]) -> DataFrame:
    """Incoming rows whose key is absent from `stored` (JON-01).

    One `left_anti` join instead of one lookup per row. Only the key columns
    of the stored side are read (column pruning reaches the scan); Spark
    picks broadcast or shuffle from measured sizes (AQE).
    """
    stored_keys = stored.select(*[_c(k) for k in key])
    return incoming.join(stored_keys, key_match(incoming, stored_keys, key), "left_anti")


def first_per_key(df: DataFrame, key: list[str], order_cols: list[str]) -> DataFrame:
    """Keep the first row of each key in `order_cols` order.

    Written as an aggregate (`min_by` of the whole row) rather than a
    `row_number` window: the partial aggregate runs before the shuffle, so a
    key holding a large share of the rows is reduced map-side instead of
    being sorted whole inside one task.
    """
    value_cols = [c for c in df.columns]
    order = F.struct(*[_c(c) for c in order_cols])
    packed = F.struct(*[_c(c) for c in value_cols])
    grouped = (df.groupBy(*[_c(k) for k in key])
               .agg(F.min_by(packed, order).alias("_first")))
    return grouped.select(*[F.col("_first").getField(c).alias(c) for c in value_cols])


def join_hourly(consumption: DataFrame, weather: DataFrame, on: str = "hour_ts") -> DataFrame:
    """Consumption features meet weather averaged over cities, per hour (JON-02).

    Weather is first reduced to one row per hour (partial + final aggregate),
    then left-joined. No broadcast hint: the hourly side is small in practice
    but its size is not fixed, so AQE decides from runtime statistics.
    """
    value_cols = [f.name for f in weather.schema.fields
                  if f.name not in (on, "city", "date") and isinstance(f.dataType, T.NumericType)]
    per_hour = weather.groupBy(on).agg(*[F.avg(_c(v)).alias(v) for v in value_cols])
    return consumption.join(per_hour, on=on, how="left")


# ---------------------------------------------------------------------------
# Table files (SNK-01..09)
# ---------------------------------------------------------------------------

def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame | None:
    """The table at `path`, or None when nothing was written there yet."""
    try:
        reader = spark.read
        if schema is not None:
            reader = reader.schema(schema)
        return reader.parquet(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e) or "Path does not exist" in str(e) or "UNABLE_TO_INFER_SCHEMA" in str(e):
            return None
        raise


def create_table_if_absent(spark: SparkSession, path: str, schema: T.StructType,
                           partition_by: list[str] | None = None) -> DataFrame:
    """Create an empty table with `schema` unless one exists (SNK-04, 05, 07).

    An existing table is left as it is and returned. Several may create it at
    once: each moves an empty file of its own into the table.
    """
    existing = read_table(spark, path)
    if existing is not None:
        return existing
    commits.Log(spark, path).add(spark.createDataFrame([], schema), partition_by)
    return spark.read.schema(schema).parquet(path)


def append(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Plain append, no duplicate check (SNK-03)."""
    writer = df.write.mode("append")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def append_counted(df: DataFrame, path: str, partition_by: list[str] | None = None) -> int:
    """Append, and the number of rows, observed while they are written."""
    seen = Observation()
    append(df.observe(seen, F.count(F.lit(1)).alias("rows")), path, partition_by)
    return seen.get["rows"]


def to_table_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Cast and order columns to the table contract."""
    return df.select(*[_c(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def _cast_columns(df: DataFrame, schema: T.StructType) -> dict[str, Column]:
    """The table's columns, null where a value cannot be cast."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    return {f.name: _c(f.name) if kinds[f.name] == f.dataType else _c(f.name).try_cast(f.dataType) for f in schema.fields}


def cast_violations(df: DataFrame, schema: T.StructType) -> Column:
    """Reasons for values that the table's types cannot hold."""
    checks = [F.when(_c(n).isNotNull() & c.isNull(), F.lit(f"{n}:cast")) for n, c in _cast_columns(df, schema).items()]
    return F.filter(F.array(*checks), lambda x: x.isNotNull())


def insert_if_absent(spark: SparkSession, path: str, batch: DataFrame, key: list[str],
                     order_cols: list[str], schema: T.StructType | None = None,
                     partition_by: list[str] | None = None,
                     return_inserted: bool = True, rejected_path: str | None = None) -> DataFrame | int:
    """Insert the batch rows whose key the table lacks (SNK-01, SNK-02).

    Inside the batch the first row of each key (by `order_cols`) wins; keys
    match null-safely. The table is created when absent. Returns the rows
    that were inserted. With `partition_by` (columns derived from the key,
    e.g. the year of the date) the table is partitioned and only the
    partitions present in the batch are read for the key check.

    The new rows are written beside the table and committed under the next
    number of its log (`wattline.operators.commits`): two loads at once leave
    each key once, a lost executor costs a task, and a load that dies leaves
    the table as it was or its commit whole. Stored files whose key ranges the
    batch does not touch are not read. With return_inserted=False the number
    of inserted rows, observed on the write, is returned.

    A value that the table's type cannot hold raises, as a cast does; with
    `rejected_path` such rows are set aside there with their reasons, and the
    rest goes in (SNK-06).
    """
    shared_root(spark)
    schema = schema or T.StructType([f for f in batch.schema.fields if f.name not in order_cols])
    if rejected_path is not None:
        batch, bad = split_valid(batch, cast_violations(batch, schema))
        commits.Log(spark, rejected_path).add(bad)
        batch = batch.select(*[f.alias(n) for n, f in _cast_columns(batch, schema).items()],
                             *[_c(o) for o in order_cols if o not in schema.names])
    create_table_if_absent(spark, path, schema, partition_by)
    first = first_per_key(batch, key, order_cols)
    ranges = commits.ranges_of(batch.agg(*commits.range_columns(key)).first(), key)
    log = commits.Log(spark, path)

    def rows(seen: DataFrame | None) -> DataFrame:
        stored = _stored_files(spark, path, schema, log.untouched(ranges, key))
        if partition_by:
            # Partition columns are determined by the key, so only stored partitions
            # that the batch touches can hold a match. The semi join lets dynamic
            # partition pruning skip the other partitions at the scan.
            # Null-safe: rows of an unknown year are looked up in the null partition.
            touched = batch.select(*[_c(p) for p in partition_by]).distinct()
            stored = stored.join(touched, key_match(stored, touched, partition_by), how="left_semi")
        return to_table_schema(not_existing(first if seen is None else seen, stored, key), schema)

    def write(frame: DataFrame, folder: str) -> tuple[int, dict]:
        observed = Observation()
        watched = frame.observe(observed, F.count(F.lit(1)).alias("rows"), *commits.range_columns(key))
        append(watched, folder, partition_by)
        found = observed.get
        return found["rows"], commits.ranges_of(found, key)

    count, added = commits.commit_rows(spark, path, key, rows, write)
    if not return_inserted:
        return count
    return added if added is not None else spark.createDataFrame([], schema)


def _stored_files(spark: SparkSession, path: str, schema: T.StructType, skipped: set[str]) -> DataFrame:
    """The table at `path` without the files in `skipped` (by their paths inside it)."""
    whole = spark.read.schema(schema).parquet(path)
    if not skipped:
        return whole
    root = path.rstrip("/") + "/"
    files = [f for f in whole.inputFiles() if unquote(f).split(root.split(":", 1)[-1].lstrip("/"), 1)[-1] not in skipped]
    if not files:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", path).parquet(*[unquote(f) for f in files])


def split_valid(df: DataFrame, reasons: Column) -> tuple[DataFrame, DataFrame]:
    """Valid rows, and rejected rows with their reasons (SNK-06).

    A bad row is reported and set aside; the rest of the run goes on.
    """
    tagged = df.withColumn("_reasons", reasons)
    valid = tagged.where(F.size("_reasons") == 0).drop("_reasons")
    rejected = tagged.where(F.size("_reasons") > 0).withColumnRenamed("_reasons", "reasons")
    return valid, rejected


def length_violations(schema_limits: list[tuple[str, int]]) -> Column:
    """Reasons for text longer than its column allows (VARCHAR(n) limits)."""
    checks = [F.when(F.length(_c(c)) > n, F.lit(f"{c}:length>{n}")) for c, n in schema_limits]
    return F.filter(F.array(*checks), lambda x: x.isNotNull())


def null_violations(columns: list[str]) -> Column:
    """Reasons for nulls in NOT NULL columns."""
    checks = [F.when(_c(c).isNull(), F.lit(f"{c}:null")) for c in columns]
    return F.filter(F.array(*checks), lambda x: x.isNotNull())
