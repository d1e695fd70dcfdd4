"""Records of files whose quoted cells may go over line breaks, block by block.

A reader's split (a block) begins at a line, but that line may stand inside a
quoted cell. What a block does to this one bit of state is a function of it:
a quote opens a cell only at a cell's start, so a block maps "outside" and
"inside" each to a state at its end. The functions of all blocks are found in
parallel; composed along a file (a scan) they give the state each block begins
with. Then every block is cut into records on its own. A record that spans
blocks comes out in pieces, one a block, and is put together by its first one.

Lines are split at line feeds; a carriage return before one belongs to the
line's end outside quotes, and to the cell inside, as pandas has it. Bare
carriage returns end lines outside quotes, too. Blank records are skipped, the
first other record of a file is its header.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

_WHOLE, _OPENS, _GOES_ON, _HEADER_OPENS = range(4)
_ROWS = 8192             # records of a batch


def end_state(line: str, inside: bool, sep: str) -> bool:
    """Whether a line ends inside a quoted cell."""
    at = 0
    while True:
        if inside:
            at = line.find('"', at)
            if at < 0:
                return True
            if line.startswith('""', at):
                at += 2
                continue
            inside = False                   # what follows up to the separator is part of the cell as it stands
        elif line.startswith('"', at):
            inside = True
            at += 1
            continue
        at = line.find(sep, at)
        if at < 0:
            return False
        at += 1


def _lines(value: str, inside: bool, sep: str) -> Iterator[str]:
    """A line, cut at the carriage returns that end lines of their own."""
    *ended, rest = value.split("\r")
    held = ""
    for part in ended:
        held += part
        inside = end_state(part, inside, sep)
        if inside:
            held += "\r"
        else:
            yield held
            held = ""
    if rest or held or not ended:
        yield held + rest


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(file, block, its batch's columns as lists) for every run of lines of one block in a batch."""
    for batch in batches:
        rows = batch.to_pydict()
        n, a = batch.num_rows, 0
        while a < n:
            key = rows["file_path"][a], rows["_block_start"][a]
            b = a + 1
            while b < n and (rows["file_path"][b], rows["_block_start"][b]) == key:
                b += 1
            yield key, {c: v[a:b] for c, v in rows.items()}
            a = b


def _effects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per block: the state at its end if it begins outside, and inside a quoted cell; whether a line is not blank."""
    def row(key, state) -> pa.RecordBatch:
        return pa.record_batch([pa.array([key[0]]), pa.array([key[1]], pa.int64()), *(pa.array([v]) for v in state)],
                               names=["file_path", "_block_start", "from_outside", "from_inside", "filled"])

    key, state = None, None
    for now, rows in _blocks(batches):
        if now != key:
            if key is not None:
                yield row(key, state)
            key, state = now, [False, True, False]
        sep = rows["sep"][0]
        for value in rows["value"]:
            if '"' in value:
                # Bare carriage returns matter only outside quotes, where they end a line: as a separator would a cell.
                parts = value.split("\r")
                for part in parts:
                    state[0], state[1] = end_state(part, state[0], sep), end_state(part, state[1], sep)
            state[2] = state[2] or bool(value.strip())
    if key is not None:
        yield row(key, state)


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records of every block, and the pieces of records that go over its bounds."""
    kept = ["file_path", "source_file", "_block_start", "_row_id", "class", "offset"]
    out: list[tuple] = []

    def flush() -> pa.RecordBatch:
        columns = list(zip(*out))
        out.clear()
        kinds = [pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.string(), pa.int32()]
        return pa.record_batch([pa.array(v, k) for v, k in zip(columns, kinds)], names=[*kept, "value", "kind"])

    def close(held: list[str], first: tuple, kind: int, header: bool) -> bool:
        """Put a record out; True while the file's header is still to come."""
        text = "\n".join(held)
        if kind != _GOES_ON and header and (kind == _OPENS or text.strip()):
            if kind == _OPENS:
                out.append((*first, text, _HEADER_OPENS))
            return False
        if kind != _WHOLE or text.strip():
            out.append((*first, text, kind))
        return header

    key, inside, header, held, first, went_on = None, False, False, [], None, False

    def end_block() -> None:
        if held:
            close(held, first, _GOES_ON if went_on else _OPENS, header)

    for now, rows in _blocks(batches):
        if now != key:
            end_block()
            key, inside, header = now, rows["inside"][0], rows["header_here"][0]
            if inside is None:
                raise ValueError(f"the splits of {key[0]} changed between two reads")
            held, first, went_on = [], None, inside
        sep = rows["sep"][0]
        for i, value in enumerate(rows["value"]):
            for line in _lines(value, inside, sep):
                if not held:
                    first = tuple(rows[c][i] for c in kept)
                held.append(line)
                if '"' in line:
                    inside = end_state(line, inside, sep)
                if not inside:
                    header = close(held, first, _GOES_ON if went_on else _WHOLE, header)
                    held, went_on = [], False
            if len(out) >= _ROWS:
                yield flush()
    end_block()
    if out:
        yield flush()


def quoted_records(spark: SparkSession, paths: list[str], files: DataFrame) -> DataFrame:
    """Records of the files in `files` (file_path, class, sep, offset): their text, class, offset and place."""
    from wattline.session import fresh_location
    from wattline.sources.delimited import ENCODING, place

    text = spark.read.option("lineSep", "\n").text(paths).select(
        *place(), F.decode(F.col("value").cast("binary"), ENCODING).alias("value")).join(
        F.broadcast(files.select("file_path", "class", "sep", "offset")), "file_path")
    at = fresh_location(spark, "blocks")
    text.select("file_path", "_block_start", "sep", "value").mapInArrow(
        _effects, "file_path string, _block_start long, from_outside boolean, from_inside boolean, filled boolean").write.parquet(at)
    blocks = spark.read.parquet(at)

    # A block keeps the state, turns it round, or sets it whatever it was. So a block begins with what the last
    # setting block left, turned round as often as blocks after that one do.
    earlier = Window.partitionBy("file_path").orderBy("_block_start").rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy("file_path").orderBy("_block_start").rowsBetween(Window.unboundedPreceding, 0)
    turns = F.when(F.col("from_outside") & ~F.col("from_inside"), 1).otherwise(0)
    blocks = blocks.withColumn("turned", F.sum(turns).over(upto))
    sets = F.when(F.col("from_outside") == F.col("from_inside"), F.struct(F.col("from_outside").alias("to"), "turned"))
    last = F.last(sets, ignorenulls=True).over(earlier)
    before = F.coalesce(F.sum(turns).over(earlier), F.lit(0))
    states = blocks.select(
        "file_path", "_block_start",
        (F.coalesce(last["to"], F.lit(False)).cast("int") + before - F.coalesce(last["turned"], F.lit(0))).alias("n"),
        (~F.coalesce(F.max("filled").over(earlier), F.lit(False))).alias("header_here")).select(
        "file_path", "_block_start", (F.col("n") % 2 != 0).alias("inside"), "header_here")

    order = ["file_path", "_block_start", "_row_id"]
    pieces = text.drop("size").join(states, ["file_path", "_block_start"], "left").sortWithinPartitions(*order).mapInArrow(
        _pieces, "file_path string, source_file string, _block_start long, _row_id long, class int, offset long, "
                 "value string, kind int")
    whole = pieces.where(F.col("kind") == _WHOLE).drop("file_path", "kind")
    # At most two pieces a block: a record's first one, then those of the blocks it goes on in.
    parts = pieces.where(F.col("kind") != _WHOLE)
    starts = F.sum(F.when(F.col("kind") != _GOES_ON, 1).otherwise(0)).over(
        Window.partitionBy("file_path").orderBy("_block_start", "_row_id"))
    joined = parts.withColumn("record", starts).groupBy("file_path", "record").agg(
        F.sort_array(F.collect_list(F.struct("_block_start", "_row_id", "source_file", "class", "offset", "value", "kind"))).alias("p"))
    first = F.col("p")[0]
    text_of = F.array_join(F.transform("p", lambda x: x["value"]), "\n")
    spanning = joined.where(first["kind"] != _HEADER_OPENS).select(
        first["source_file"].alias("source_file"), first["_block_start"].alias("_block_start"), first["_row_id"].alias("_row_id"),
        first["class"].alias("class"), first["offset"].alias("offset"), text_of.alias("value"))
    return whole.unionByName(spanning)
