"""Shared pieces of the operators: tables, saved intermediate results, components."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The cluster's folder for cut lineage; a temporary one only in a local session without it."""
    at = spark.conf.get("spark.checkpoint.dir", None)
    if at:
        return at.rstrip("/")
    sc = spark.sparkContext
    if not sc.master.split("[")[0] == "local":
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    at = getattr(sc, "_llm_dir", None)
    if at is None:
        at = sc._llm_dir = "file://" + tempfile.mkdtemp(prefix="llm-")
    return at


def save(df: DataFrame) -> DataFrame:
    """Write a result to the shared folder as Parquet and read it back: lost executors lose nothing."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def save_bucketed(df: DataFrame, column: str, buckets: int) -> DataFrame:
    """As `save`, as a table bucketed by a column: joins and groupings on it need no further shuffle."""
    spark = df.sparkSession
    name = f"llm_{uuid.uuid4().hex}"
    df.write.format("parquet").bucketBy(buckets, column).option("path", f"{shared_dir(spark)}/{name}").saveAsTable(name)
    return spark.table(name)


def map_slices(df: DataFrame, function: Callable[[pa.RecordBatch], pa.RecordBatch | None],
               schema: str, column: str = "text") -> DataFrame:
    """Apply a function to slices of rows that hold a bounded amount of text."""
    from wattline.llm.textbytes import slices

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, column):
                out = function(part)
                if out is not None and out.num_rows:
                    yield out

    return df.mapInArrow(run, schema)


def components(links: DataFrame) -> DataFrame:
    """Smallest node reachable from every node of `links` (a, b: long): columns node, component.

    Each round lets every node take the smallest label among its neighbours
    and then its label's label, so the rounds grow with the logarithm of the
    longest chain. A round's labels are saved; its aggregates are partial
    before the shuffle, so a node with very many links is no hot spot.
    """
    both = save(links.select("a", "b").union(links.select("b", "a")).filter("a <> b").distinct())
    labels = save(both.groupBy("a").agg(F.min("b").alias("l")).select(
        F.col("a").alias("node"), F.least("a", "l").alias("component")))
    while True:
        near = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(
            F.min("component").alias("near"))
        step = labels.join(near, "node").select("node", F.col("component").alias("was"),
                                                F.least("component", "near").alias("l"))
        root = labels.select(F.col("node").alias("l"), F.col("component").alias("root"))
        new = save(step.join(root, "l", "left").select("node", "was", F.least("l", "root").alias("component")))
        changed = new.filter("was <> component").limit(1).count()
        labels = new.select("node", "component")
        if not changed:
            return labels
