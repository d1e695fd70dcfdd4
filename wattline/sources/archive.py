"""Archive ingest (SRC-07): unpack zip archives into a landing directory.

Only names travel through Spark: tasks read each archive's directory of
members, a `left_anti` join on the member's path skips what has landed, and
the task that holds a member copies it from the archive to the landing
directory in chunks, so its memory does not depend on the archive's or the
member's size. Members keep their path inside the archive; one that would
leave the landing directory is an error.
"""

from __future__ import annotations

import posixpath
import uuid
import zipfile

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattline.session import fresh_location
from wattline.sources.files import arrow_fs

_COPY_BYTES = 1 << 20


def safe_member(name: str) -> str:
    """A member's path relative to the landing directory; absolute or upward paths are an error."""
    path = posixpath.normpath(name.replace("\\", "/"))
    if path.startswith(("/", "../")) or path == ".." or ":" in path.split("/")[0]:
        raise ValueError(f"archive member leaves the landing directory: {name}")
    return path


def _list_members(batches):
    for pdf in batches:
        for path in pdf["path"]:
            filesystem, local = arrow_fs(path)
            with filesystem.open_input_file(local) as f, zipfile.ZipFile(f) as zf:
                names = [(path, safe_member(i.filename), i.filename) for i in zf.infolist() if not i.is_dir()]
            yield pd.DataFrame(names, columns=["archive", "member", "entry"])


def _copier(landing_dir: str):
    def copy(batches):
        filesystem, root = arrow_fs(landing_dir)
        for pdf in batches:
            done = []
            for archive, rows in pdf.groupby("archive"):
                source, local = arrow_fs(archive)
                with source.open_input_file(local) as f, zipfile.ZipFile(f) as zf:
                    for member, entry in zip(rows["member"], rows["entry"]):
                        final = f"{root}/{member}"
                        folder, base = posixpath.split(final)
                        filesystem.create_dir(folder, recursive=True)
                        tmp = f"{folder}/.{base}.{uuid.uuid4().hex}.tmp"
                        with zf.open(entry) as data, filesystem.open_output_stream(tmp) as out:
                            while chunk := data.read(_COPY_BYTES):
                                out.write(chunk)
                        filesystem.move(tmp, final)
                        done.append((member, f"{landing_dir.rstrip('/')}/{member}"))
            yield pd.DataFrame(done, columns=["member", "path"])
    return copy


def archive_members(spark: SparkSession, archive_dir: str, start_year: int | None = None) -> DataFrame:
    """(archive, member, entry) for every file inside every zip of the directory; no content is read.

    With `start_year`, only yearly archives (a 4-digit year in the name) from
    that year up to the first missing year are opened (SRC-08).
    """
    paths = (spark.read.format("binaryFile").option("pathGlobFilter", "*.[zZ][iI][pP]")
             .load(archive_dir).select("path"))
    if start_year is not None:
        from wattline.sources.years import contiguous_years
        named = paths.select("path", F.regexp_extract(F.col("path"), r"((?:19|20)[0-9]{2})[^/]*$", 1)
                             .try_cast("int").alias("year"))
        run = contiguous_years(named.where(F.col("year").isNotNull()), start_year)
        paths = named.join(run, "year", "left_semi").select("path")
    return paths.mapInPandas(_list_members, "archive string, member string, entry string")


def landed_members(spark: SparkSession, landing_dir: str) -> DataFrame:
    """Paths (relative to the landing directory) of the files already there."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(landing_dir)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(path)
    root = fs.makeQualified(path).toString().rstrip("/") + "/"
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(landing_dir)
    return files.select(F.substring(F.col("path"), F.lit(len(root) + 1), F.length("path")).alias("member"))


def extract_new(spark: SparkSession, archive_dir: str, landing_dir: str, start_year: int | None = None) -> DataFrame:
    """The copy of members not yet landed, as a plan; its rows are (member, path) of those written.

    The same path in several archives is taken from the first archive by name.
    """
    members = archive_members(spark, archive_dir, start_year)
    first = members.groupBy("member").agg(F.min(F.struct("archive", "entry")).alias("m")).select(
        "member", "m.archive", "m.entry")
    new = first.join(landed_members(spark, landing_dir), on="member", how="left_anti")
    return new.repartition("archive", "member").mapInPandas(_copier(landing_dir), "member string, path string")


def download_and_extract(spark: SparkSession, archive_dir: str, landing_dir: str,
                         start_year: int | None = None) -> DataFrame:
    """Unpack archives into `landing_dir`, skipping members already there; (member, path) of what was written.

    With `start_year`, only the contiguous run of yearly archives from that year is taken.
    """
    written = fresh_location(spark, "extracted")
    extract_new(spark, archive_dir, landing_dir, start_year).write.parquet(written)
    return spark.read.parquet(written)
