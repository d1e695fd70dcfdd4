"""The table load: directory of readings -> consumption table.

load -> drop lineage column -> conform to the 40 table columns -> split
valid / rejected -> cast -> insert rows whose key is absent. One job per
write; rejected rows go to their own table with the reasons.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattline.contracts import (
    CONSUMPTION_COLUMNS, CONSUMPTION_INT_COLUMNS, CONSUMPTION_KEY, CONSUMPTION_TABLE_SCHEMA,
    CONSUMPTION_TEXT_COLUMNS,
)
from wattline.functions.names import clean_colname
from wattline.functions.numeric import to_int64
from wattline.functions.timefmt import reading_timestamp
from wattline.operators import clean, tables
from wattline.session import fresh_location
from wattline.sources.delimited import LOADED_ORDER, list_files, load_files


def conform_loaded(df: DataFrame, mode: str = "name") -> DataFrame:
    """Loaded frame -> the 40 table columns (strings), keeping row order columns.

    mode='name' (default) matches each table column with the loaded column
    of the same cleaned name, so the lineage column can neither be cut nor
    shift the rest. mode='position' maps by position after dropping
    `source_file` (PRJ-02). One projection either way.
    """
    order = [c for c in LOADED_ORDER if c in df.columns]
    data = [c for c in df.columns if not c.startswith("_") and c != "source_file"]
    if mode == "position":
        sources = [data[i] if i < len(data) else None for i in range(len(CONSUMPTION_COLUMNS))]
    else:
        present = set(data)
        sources = [n if n in present else None for n in (clean_colname(c) for c in CONSUMPTION_COLUMNS)]
    cols = [(F.col(f"`{s}`").cast("string") if s else F.lit(None).cast("string")).alias(t)
            for s, t in zip(sources, CONSUMPTION_COLUMNS)]
    return df.select(*cols, *[F.col(c) for c in order])


def load_table(spark: SparkSession, data_dir: str, table_path: str, rejected_path: str,
               mode: str = "name", by_year: bool = False) -> dict:
    """Run the whole load over a directory; returns counts of inserted and rejected rows.

    by_year=True partitions the table by the year of `date` (a column added to
    the 40): each load then reads only the stored years its batch touches.
    """
    return load_table_files(spark, list_files(spark, data_dir), table_path, rejected_path, mode, by_year)


def load_table_files(spark: SparkSession, paths: list[str], table_path: str, rejected_path: str,
                     mode: str = "name", by_year: bool = False) -> dict:
    """The load for an explicit list of files."""
    raw = load_files(spark, paths)
    if not raw.columns:
        tables.create_table_if_absent(spark, table_path, CONSUMPTION_TABLE_SCHEMA)
        return {"inserted": 0, "rejected": 0}
    conformed = conform_loaded(raw, mode)
    reasons = clean.reject_reasons(conformed, CONSUMPTION_INT_COLUMNS)
    # One parse: the staged rows with their reasons feed the insert, the rejected rows and the years.
    staged = fresh_location(spark, "staged-load")
    conformed.withColumn("_reasons", reasons).write.parquet(staged)
    tagged = spark.read.parquet(staged)
    valid = tagged.where(F.size("_reasons") == 0).drop("_reasons")
    rejected = tagged.where(F.size("_reasons") > 0)
    order = [c for c in LOADED_ORDER if c in conformed.columns]
    text = set(CONSUMPTION_TEXT_COLUMNS)
    typed = valid.select(*[(F.col(f"`{c}`") if c in text else to_int64(F.col(f"`{c}`"))).alias(c)
                           for c in CONSUMPTION_COLUMNS], *order)
    schema, partition_by = CONSUMPTION_TABLE_SCHEMA, None
    if by_year:
        year = F.year(reading_timestamp(F.col("date"), F.col("heures"))).alias("year")
        typed = typed.select("*", year)
        schema, partition_by = T.StructType(schema.fields + [T.StructField("year", T.IntegerType())]), ["year"]
    inserted = tables.insert_if_absent(spark, table_path, typed, CONSUMPTION_KEY, order,
                                       schema=schema, partition_by=partition_by, return_inserted=False)
    rej = rejected.select(*[F.col(f"`{k}`") for k in CONSUMPTION_KEY],
                          F.array_join("_reasons", ",").alias("reasons"), *order)
    return {"inserted": inserted, "rejected": tables.append_counted(rej, rejected_path)}
