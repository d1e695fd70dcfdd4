"""Directory of delimited text files -> one string DataFrame (SRC-01..06).

Files differ in separator and header, and some hold line breaks in quoted
cells. Loading keeps everything per file in DataFrames; the driver sees one
row per class of files, a class being a (separator, header) pair.

1. Sniff. The first two lines of each file are read from its start by the
   task that holds its path; every line is read once as a single Latin-1 cell
   for the widest field count per candidate separator (JVM-side counting, a
   partial hash aggregate, no sort). A candidate is ruled out for a file when
   some line is wider than both the header and the first data line. Among the
   rest the widest header wins, earlier candidates winning ties; a single
   column is an error. The decisions are a table of files, written to the
   shared folder.
2. Parse. All files are read in one pass, line by line; a line meets its
   file's class (one small row per file is broadcast; Spark's own list of the
   files is on the driver as well) and is parsed by that class's schema.
3. Files in which a line holds an odd number of quotes are read block by block
   (`wattline.sources.records`): where a block begins inside a quoted cell
   follows from a scan over what every block does to that state, so such files
   are parsed by as many tasks as they have blocks, too.
"""

from __future__ import annotations

import csv
import io
import re

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattline.contracts import NULL_TOKENS, SEPARATOR_CANDIDATES, SUPPORTED_EXTENSIONS
from wattline.functions.names import cleaned_headers
from wattline.session import fresh_location

ENCODING = "ISO-8859-1"
ORDINAL = "_ordinal"
_ROOM = 1 << 31          # more rows than a split can hold before a file's last block
_LINE_SEP = "\u0001"  # a separator no text line holds: one cell per line


def list_files(spark: SparkSession, data_dir: str,
               extensions: list[str] = SUPPORTED_EXTENSIONS) -> list[str]:
    """Files directly inside `data_dir` with a supported extension (any case).

    Uses the Hadoop file system of the session (local, HDFS, object stores);
    subdirectories are not entered. A missing directory is an error.
    """
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(data_dir)
    fs = path.getFileSystem(conf)
    if not fs.exists(path):
        raise FileNotFoundError(f"directory not found: {data_dir}")
    out = []
    for st in fs.listStatus(path):
        if st.isFile():
            name = st.getPath().getName()
            if any(name.lower().endswith(ext) for ext in extensions):
                out.append(st.getPath().toString())
    return sorted(out)


_HEAD_CHUNK = 1 << 16
_ZIP_MAGIC = b"PK\x03\x04"    # a real (zipped) spreadsheet, not delimited text
_BINARY = "\x00binary"


def _read_heads(batches):
    """First two non-blank lines of each file, read from the file's start only."""
    import pandas as pd

    from wattline.sources.files import arrow_fs
    for pdf in batches:
        out = []
        for path in pdf["path"]:
            filesystem, local = arrow_fs(path)
            lines: list[str] = []
            tail = b""
            with filesystem.open_input_stream(local) as f:
                read = 0
                while len(lines) < 2:
                    chunk = f.read(_HEAD_CHUNK)
                    if read == 0 and chunk.startswith(_ZIP_MAGIC):
                        lines = [_BINARY]
                        break
                    read += len(chunk)
                    data = tail + chunk
                    parts = re.split(rb"\r\n|\r|\n", data)
                    tail = parts.pop() if chunk else b""
                    lines += [p.decode(ENCODING) for p in parts if p]
                    if not chunk:
                        if tail:
                            lines.append(tail.decode(ENCODING))
                        break
            for rn, line in enumerate(lines[:2], start=1):
                out.append((path, rn, line, read > _HEAD_CHUNK))
        yield pd.DataFrame(out, columns=["file_path", "_rn", "value", "late"])


def _open_quote(v):
    """True for a line with an odd number of quotes: one of its cells goes on in the next line."""
    return (F.length(v) - F.length(F.replace(v, F.lit('"'), F.lit("")))) % 2 == 1


def _decoded_path():
    """The file's path as Hadoop lists it. Only percent escapes are decoded: a plus sign is a plus sign."""
    return F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))


def _width_exprs(v, candidates):
    """Field count per candidate: separators outside quotes + 1. Between quotes is every other piece of a line that
    is cut at its quotes, so the count is linear in the line."""
    plain = F.instr(v, '"') == 0
    pieces = F.filter(F.split(v, '"', -1), lambda _, i: i % 2 == 0)

    def width(s):
        count = lambda text: F.length(text) - F.length(F.replace(text, F.lit(s), F.lit("")))
        return F.when(plain, count(v) + 1).otherwise(F.aggregate(pieces, F.lit(1), lambda n, piece: n + count(piece)))

    return [width(s).alias(f"w{i}") for i, s in enumerate(candidates)]


def classify(spark: SparkSession, paths: list[str], candidates: list[str] = SEPARATOR_CANDIDATES) -> DataFrame:
    """A row per file that is not empty: file_path, size, header (its line), sep (null if none fits) and `by_block`
    (quotes left open at line ends, or a header far from the start).

    Two distributed reads: the head of each file (its first two non-blank lines, read by the task that holds the
    path), and every line once for the widest field count per candidate.
    """
    k = range(len(candidates))
    names = spark.createDataFrame([(p,) for p in paths], "path string")
    names = names.repartition(max(1, min(len(paths), spark.sparkContext.defaultParallelism)))
    heads = names.mapInPandas(_read_heads, "file_path string, _rn int, value string, late boolean")
    head_w = heads.select("file_path", "_rn", "value", "late", *_width_exprs(F.col("value"), candidates))
    per_head = head_w.groupBy("file_path").agg(
        F.max(F.when(F.col("_rn") == 1, F.col("value"))).alias("header"), F.max("late").alias("late"),
        *[F.max(F.when(F.col("_rn") == 1, F.col(f"w{i}"))).alias(f"h{i}") for i in k],
        *[F.max(F.when(F.col("_rn") == 2, F.col(f"w{i}"))).alias(f"d{i}") for i in k])
    lines = single_cells(spark, paths, header=False)
    widest = (lines.select("file_path", "size", *_width_exprs(F.col("value"), candidates), _open_quote(F.col("value")).alias("odd"))
              .groupBy("file_path").agg(F.max("size").alias("size"), *[F.max(f"w{i}").alias(f"m{i}") for i in k],
                                        F.max("odd").alias("multiline")))
    per_file = per_head.join(widest, "file_path")
    # a candidate is usable when no line is wider than both header and first data line;
    # the widest usable header wins, the earlier candidate on a tie
    # (a cell that goes on over a line break makes the widths of lines meaningless: no candidate is ruled out)
    usable = [F.col("multiline") | (F.col(f"m{i}") <= F.greatest(F.col(f"h{i}"), F.coalesce(F.col(f"d{i}"), F.col(f"h{i}"))))
              for i in k]
    score = [F.when(usable[i], F.col(f"h{i}")).otherwise(F.lit(0)) for i in k]
    best_w = F.greatest(*score)
    choice = F.lit(None).cast("string")
    for i in reversed(k):
        choice = F.when(score[i] == best_w, F.lit(candidates[i])).otherwise(choice)
    return per_file.select("file_path", "size", "header", F.when(best_w > 1, choice).alias("sep"),
                           (F.col("multiline") | F.col("late")).alias("by_block"))


def _problem():
    """Why a file of `classify` cannot be loaded, null if it can."""
    return (F.when(F.col("header").isNull(), "empty file")
            .when(F.col("header") == _BINARY, "binary spreadsheet, not delimited text")
            .when(F.col("sep").isNull(), "separator not detected"))


def _cells(header: str, sep: str) -> list[str]:
    return next(csv.reader(io.StringIO(header), delimiter=sep))


def sniff(spark: SparkSession, paths: list[str], candidates: list[str] = SEPARATOR_CANDIDATES) -> list[dict]:
    """Per file, for a look at a few files: chosen separator and header cells, or the reason it failed."""
    found = {r["file_path"]: r for r in classify(spark, paths, candidates).withColumn("error", _problem()).collect()}
    out = []
    for p in paths:
        r = found.get(p)
        error = "empty file" if r is None else r["error"]
        cells = None if error else _cells(r["header"], r["sep"])
        out.append({"path": p, "sep": None if error else r["sep"], "header": cells, "error": error})
    return out


def single_cells(spark: SparkSession, paths: list[str], header: bool) -> DataFrame:
    """Every line that is not blank as one Latin-1 cell: file_path, size, source_file, _block_start, _row_id, value.

    With header=True the first line of every file is left out.
    """
    lines = (spark.read.option("sep", _LINE_SEP).option("quote", "").option("escape", "").option("enforceSchema", "true")
             .option("encoding", ENCODING).option("header", str(header).lower())
             .schema(T.StructType([T.StructField("value", T.StringType())])).csv(paths))
    return lines.select(*place(), "value")


def place() -> list:
    """Where a line stands: its file, the split it was read in, and its number there."""
    return [_decoded_path().alias("file_path"), F.col("_metadata.file_size").alias("size"),
            F.col("_metadata.file_name").alias("source_file"), F.col("_metadata.file_block_start").alias("_block_start"),
            F.monotonically_increasing_id().alias("_row_id")]


def _unique_names(header: list[str]) -> list[str]:
    """Cleaned column names of a header, repeated ones numbered."""
    seen: dict[str, int] = {}
    unique = []
    for n in cleaned_headers(header):
        k = seen.get(n, 0)
        unique.append(n if k == 0 else f"{n}_{k}")
        seen[n] = k + 1
    return unique


def _parsed(value, sep: str, width: int):
    """A record's cells c0, c1, ... as a struct of text. In a quoted cell a doubled quote is a quote, a backslash is
    itself, and a line break belongs to the cell; surplus cells are cut, missing ones are null."""
    schema = ", ".join(f"c{i} string" for i in range(width))
    return F.from_csv(value, F.lit(schema), {"sep": sep, "escape": '"', "mode": "PERMISSIVE", "multiLine": "true"})


def _frame(records: DataFrame, classes: list[tuple[int, str, list[str]]]) -> DataFrame:
    """Records (value, class, order columns) as one frame with the columns of all classes, first seen first."""
    tokens = [t for t in NULL_TOKENS if t != ""]
    names: dict[str, list] = {}
    parsed = []
    for k, sep, header in classes:
        unique = _unique_names(header)
        parsed.append(F.when(F.col("class") == k, _parsed(F.col("value"), sep, len(unique))).alias(f"_c{k}"))
        for i, n in enumerate(unique):
            names.setdefault(n, []).append(F.col(f"_c{k}.c{i}"))
    rows = records.select("source_file", "_block_start", "_row_id", ORDINAL, *parsed)
    # A row has cells of its own class only; the reader's null spellings become null.
    cell = {n: F.coalesce(*found) if len(found) > 1 else found[0] for n, found in names.items()}
    return rows.select(*[F.when(c.isin(tokens), F.lit(None)).otherwise(c).alias(n) for n, c in cell.items()],
                       "source_file", "_block_start", "_row_id", ORDINAL)


def load_all_data(spark: SparkSession, data_dir: str) -> DataFrame:
    """Every supported file of one directory as one string frame (SRC-01).

    Missing directory -> FileNotFoundError; no matching file -> an empty
    frame; a file whose separator cannot be detected -> ValueError naming it.
    """
    return load_files(spark, list_files(spark, data_dir))


def load_files(spark: SparkSession, paths: list[str]) -> DataFrame:
    """`load_all_data` for an explicit list of files (of one directory).

    Besides the cells a row has `source_file` (SRC-06) and, hidden, its place: `_block_start`, `_row_id`, and
    `_ordinal`, one number that grows from file to file, by name, and from line to line.
    """
    paths = sorted(paths)
    if not paths:
        return spark.createDataFrame([], T.StructType([]))
    at = fresh_location(spark, "files")
    classify(spark, paths).write.parquet(at)
    files = spark.read.parquet(at)
    _refuse(spark, files, paths)
    # A file's lines take the numbers from its offset on: its bytes, and room for rows numbered before it in a split.
    by_name = Window.orderBy("file_path").rowsBetween(Window.unboundedPreceding, -1)
    files = files.withColumn("offset", F.coalesce(F.sum(F.col("size") + _ROOM).over(by_name), F.lit(0)))
    found = files.groupBy("sep", "header").agg(F.min("file_path").alias("first"), F.max("by_block").alias("by_block")).orderBy("first")
    classes = found.collect()                 # one row per (separator, header)
    known = spark.createDataFrame([(k, r["sep"], r["header"]) for k, r in enumerate(classes)], "class int, sep string, header string")
    small = files.join(F.broadcast(known), ["sep", "header"]).select("file_path", "class", "sep", "offset", "by_block")
    columns = ["source_file", "_block_start", "_row_id", "class", "offset", "value"]
    records = single_cells(spark, paths, header=True).join(
        F.broadcast(small.where(~F.col("by_block"))), "file_path").select(*columns)
    if any(r["by_block"] for r in classes):
        from wattline.sources.records import quoted_records
        records = records.unionByName(quoted_records(spark, paths, small.where("by_block")).select(*columns))
    line = F.col("_row_id").bitwiseAND(F.lit((1 << 33) - 1))
    ordered = records.withColumn(ORDINAL, F.col("offset") + F.col("_block_start") + line)
    return _frame(ordered, [(k, r["sep"], _cells(r["header"], r["sep"])) for k, r in enumerate(classes)])


def _refuse(spark: SparkSession, files: DataFrame, paths: list[str]) -> None:
    """An error that names files (a hundred at most) that cannot be loaded."""
    listed = spark.createDataFrame([(p,) for p in paths], "file_path string")
    bad = listed.join(files, "file_path", "left").select("file_path", _problem().alias("error")).where(
        F.col("error").isNotNull()).orderBy("file_path").limit(100).collect()
    if bad:
        raise ValueError("cannot load: " + "; ".join(f"{r['file_path']}: {r['error']}" for r in bad))


# Row order inside loaded files, for "first value" aggregates.
LOADED_ORDER = ["source_file", "_block_start", "_row_id"]
