"""Operator 12: a Merkle manifest of a dataset in van Emde Boas layout.

Every row is a leaf, the SHA-256 of its length-prefixed fields. The leaves of
a source, by doc_id, are hashed 16 at a time, level by level, to the source's
subroot; the subroots, by source, likewise to the root. Digests are hashed as
lowercase hex text, and the last run of a level may be shorter, even one.

A tree is stored as blocks: aligned subtrees of `HEIGHT` levels of runs (4096
leaves), one row each. Inside a block the digests lie in van Emde Boas order:
the levels are split at half height, the top part comes first, then the
subtrees below it from left to right, each laid out the same way. The place
of a node follows from its level and number alone (`address`), so building a
level, and fetching the siblings of any node, is address arithmetic on one
buffer that touches neighbouring bytes at every size of a cache. The roots of
the blocks are the leaves of the next blocks, until a tree has one block; so
neither a task nor a row ever holds more than a block, however large a
source is, and a proof is read block by block from the root down.

Defined cases: a null field is `-`, any other its UTF-8 byte count, `:` and
its value; within a source null doc_ids come first, rows with one doc_id
stand by their leaf, repeated rows are leaves of their own; a null source is
a source (the first); a null doc_id is never tampered with in `audit`; other
columns are no part of the leaf and are left alone; an empty table gives an
empty result.
"""

from __future__ import annotations

import hashlib
import string
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from wattline.llm.common import save

RUN = 16                 # children of a node
HEIGHT = 3               # levels of runs in a block
SPAN = RUN * RUN         # leaves whose paths are held at a time
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_HEX = 64
_PATH = "array<struct<left:string,right:string>>"


def digest(content: bytes) -> bytes:
    return hashlib.sha256(content).hexdigest().encode()


# ---------------------------------------------------------------------------
# The layout of a block
# ---------------------------------------------------------------------------

def nodes_of(levels: int) -> int:
    """Nodes of a complete tree of so many levels."""
    return (RUN ** levels - 1) // (RUN - 1)


def address(levels: int, depth: int, number: np.ndarray) -> np.ndarray:
    """Places of nodes, given by their depth and their number there, in the layout of a tree of so many levels."""
    if levels == 1:
        return np.zeros_like(number)
    top = levels // 2
    if depth < top:
        return address(top, depth, number)
    below = RUN ** (depth - top)
    return (nodes_of(top) + number // below * nodes_of(levels - top)
            + address(levels - top, depth - top, number % below))


def counts(levels: int, leaves: int) -> list[int]:
    """Nodes in use at every depth, the leaves' last."""
    out = [leaves]
    while len(out) < levels:
        out.append(-(-out[-1] // RUN))
    return out[::-1]


def levels_of(total: int, height: int) -> int:
    """Levels of the blocks that hold a tree's leaves: what they need, or a full block's if there are several."""
    levels = 1
    while levels <= height and RUN ** (levels - 1) < total:
        levels += 1
    return levels


def lay_out(leaves: np.ndarray, levels: int) -> np.ndarray:
    """Digests (rows of 64 hex bytes) of a block in their places; the root's is place 0."""
    used = counts(levels, len(leaves))
    last = max(int(address(levels, depth, np.array([n - 1]))[0]) for depth, n in enumerate(used))
    out = np.zeros((last + 1, _HEX), np.uint8)
    out[address(levels, levels - 1, np.arange(len(leaves)))] = leaves
    for depth in range(levels - 2, -1, -1):
        below = out[address(levels, depth + 1, np.arange(used[depth + 1]))].tobytes()
        hashes = [digest(below[at:at + RUN * _HEX]) for at in range(0, len(below), RUN * _HEX)]
        out[address(levels, depth, np.arange(used[depth]))] = np.frombuffer(b"".join(hashes), np.uint8).reshape(-1, _HEX)
    return out


def siblings(block: np.ndarray, levels: int, leaves: int, start: int = 0,
             stop: int | None = None) -> list[tuple[list[bytes], list[bytes]]]:
    """Of every leaf (or those from `start` to before `stop`), from its own level up: the run's digests left and right of it."""
    out = []
    used = counts(levels, leaves)
    number = np.arange(start, leaves if stop is None else stop)
    for depth in range(levels - 1, 0, -1):
        first = number // RUN * RUN
        end = np.minimum(first + RUN, used[depth])
        base = int(first[0])
        level = block[address(levels, depth, np.arange(base, int(end[-1])))].tobytes()
        first, at, end = ((x - base).tolist() for x in (first, number, end))
        out.append(([level[a * _HEX:b * _HEX] for a, b in zip(first, at)],
                    [level[(a + 1) * _HEX:b * _HEX] for a, b in zip(at, end)]))
        number = number // RUN
    return out


# ---------------------------------------------------------------------------
# Trees of blocks
# ---------------------------------------------------------------------------

@dataclass
class Check:
    """What to make of leaves and their paths (a batch: tree, position, leaf, entry, subroot, path)."""
    function: Callable[[pa.RecordBatch], pa.RecordBatch]
    schema: str


def _positions(rows: DataFrame, order: list[str]) -> DataFrame:
    """The rows (with `tree`) with their place in their tree by `order`, and their tree's size.

    Sorted ranges are written with a running number; only the number of rows of each (tree, range) is summed up, so
    a tree that holds most of the rows is numbered by as many tasks as it has ranges.
    """
    ranged = save(rows.repartitionByRange("tree", *order).sortWithinPartitions("tree", *order).withColumn(
        "__at", F.monotonically_increasing_id()).withColumn("__range", F.spark_partition_id()))
    sizes = ranged.groupBy("tree", "__range").agg(F.min("__at").alias("__first"), F.count("*").alias("__n"))
    own = Window.partitionBy("tree")
    starts = sizes.select("tree", "__range", "__first", F.sum("__n").over(own).alias("total"), (
        F.sum("__n").over(own.orderBy("__range")) - F.col("__n")).alias("__before"))
    return ranged.join(starts, ["tree", "__range"]).withColumn(
        "position", F.col("__at") - F.col("__first") + F.col("__before")).drop("__at", "__range", "__first", "__before")


def _blocks(rows: DataFrame, height: int) -> DataFrame:
    """Rows tree, position, total, leaf, entry (any struct) as blocks: one row each, saved."""
    capacity = RUN ** height
    kind = rows.schema["entry"].dataType.simpleString()

    def block(found: pa.Table) -> pa.Table:
        found = found.take(pa.array(np.argsort(found.column("position").to_numpy())))
        total = found.column("total")[0].as_py()
        levels = levels_of(total, height)
        leaves = np.frombuffer("".join(found.column("leaf").to_pylist()).encode(), np.uint8).reshape(-1, _HEX)
        laid = lay_out(leaves, levels)
        entries = found.column("entry").combine_chunks()
        return pa.table({
            "tree": [found.column("tree")[0].as_py()], "block": [found.column("block")[0].as_py()], "total": [total],
            "levels": pa.array([levels], pa.int32()), "root": [laid[0].tobytes().decode()], "nodes": [laid.tobytes()],
            "entries": pa.ListArray.from_arrays(pa.array([0, len(entries)], pa.int32()), entries)})

    grouped = rows.select("tree", F.floor(F.col("position") / capacity).alias("block"), "position", "total", "leaf", "entry")
    return save(grouped.groupBy("tree", "block").applyInArrow(
        block, f"tree string, block long, total long, levels int, root string, nodes binary, entries array<{kind}>"))


def build(rows: DataFrame, height: int = HEIGHT) -> list[DataFrame]:
    """Tables of blocks of all trees of rows (tree, position, total, leaf, entry), the lowest first."""
    capacity = RUN ** height
    tables = [_blocks(rows, height)]
    while True:
        above = tables[-1].filter(F.col("total") > capacity).select(
            "tree", F.col("block").alias("position"), F.ceil(F.col("total") / capacity).alias("total"),
            F.col("root").alias("leaf"), F.struct(F.lit(None).cast("string").alias("none")).alias("entry"))
        if above.isEmpty():
            return tables
        tables.append(_blocks(above, height))


def _roots(tables: list[DataFrame], height: int) -> DataFrame:
    """tree, root of every tree."""
    found = [t.filter(F.col("total") <= RUN ** height).select("tree", "root") for t in tables]
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def _expanded(blocks: DataFrame, check: Check | None = None) -> DataFrame:
    """Blocks with the `path` above them (and their `subroot`) as their leaves, each with its own path from the leaf up.

    With `check`, what it makes of the leaves: paths are some kB a leaf, so they are then used where they are made.
    """
    kind = blocks.schema["entries"].dataType.elementType.simpleString()

    def leaves(row: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        tree, number, levels, subroot = (row.column(c)[0].as_py() for c in ("tree", "block", "levels", "subroot"))
        entries = row.column("entries").flatten()
        nodes = np.frombuffer(row.column("nodes")[0].as_buffer(), np.uint8).reshape(-1, _HEX)
        above = row.column("path")[0].as_py()
        for at in range(0, len(entries), SPAN):
            n = min(SPAN, len(entries) - at)
            steps = siblings(nodes, levels, len(entries), at, at + n) + [
                ([s["left"].encode()] * n, [s["right"].encode()] * n) for s in above]
            flat = [pa.array([side[k] for k in range(n) for side in sides], pa.binary()).cast(pa.string())
                    for sides in ([s[0] for s in steps], [s[1] for s in steps])]
            path = pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * len(steps)),
                                            pa.StructArray.from_arrays(flat, names=["left", "right"]))
            own = nodes[address(levels, levels - 1, np.arange(at, at + n))].tobytes().decode()
            # Places in the tree follow from the block's number: all blocks before the last are full.
            first = number * RUN ** (levels - 1) + at
            yield pa.record_batch([
                pa.array([tree] * n, pa.string()), pa.array(np.arange(first, first + n)),
                pa.array([own[k:k + _HEX] for k in range(0, len(own), _HEX)], pa.string()), entries.slice(at, n),
                pa.array([subroot] * n, pa.string()), path],
                names=["tree", "position", "leaf", "entry", "subroot", "path"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                for found in leaves(batch.slice(i, 1)):
                    yield found if check is None else check.function(found)

    return blocks.select("tree", "block", "levels", "nodes", "entries", "subroot", "path").mapInArrow(
        run, f"tree string, position long, leaf string, entry {kind}, subroot string, path {_PATH}" if check is None
        else check.schema)


def paths(tables: list[DataFrame], above: DataFrame, height: int = HEIGHT, check: Check | None = None) -> DataFrame:
    """Every leaf (tree, position, leaf, entry) of trees of blocks with its path up to the root that `above` (tree,
    subroot, path) leads on from: whole tables of blocks meet the paths of their roots, from the highest down.
    With `check`, what it makes of the lowest table's leaves."""
    handed = None
    for k in range(len(tables) - 1, -1, -1):
        single = tables[k].filter(F.col("total") <= RUN ** height).join(above, "tree")
        if handed is not None:
            single = single.unionByName(tables[k].filter(F.col("total") > RUN ** height).join(
                handed.select("tree", F.col("position").alias("block"), "subroot", "path"), ["tree", "block"]))
        handed = _expanded(single, None if k else check)
        if k:
            handed = save(handed)
    return handed


# ---------------------------------------------------------------------------
# The manifest
# ---------------------------------------------------------------------------

@dataclass
class Manifest:
    sources: list[DataFrame]      # blocks of every source's tree, the lowest first
    top: list[DataFrame]          # blocks of the tree over the subroots
    root: str
    height: int


def leaf(text: Column | None = None) -> Column:
    """A row's digest, with another text in place of its own if one is given."""
    def field(value: Column) -> Column:
        value = value.cast("string")
        return F.when(value.isNull(), "-").otherwise(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value))

    values = [F.col(c) if c != "text" or text is None else text for c in FIELDS]
    return F.sha2(F.concat(*(field(v) for v in values)), 256)


def _tree(source: Column) -> Column:
    """A source's name as a key that is never null and sorts as asked: null first, then by bytes."""
    return F.when(source.isNull(), "0").otherwise(F.concat(F.lit("1"), source))


def manifest(docs: DataFrame, seen: Column | None = None, height: int = HEIGHT) -> Manifest | None:
    """The manifest of the documents (None of an empty table).

    `seen` is the digest that a row shows today; it is kept beside the leaf, for `verified`.
    """
    own = leaf()
    # Saved, so that texts are read and hashed once, not again to draw the bounds of ranges.
    rows = save(docs.select(*FIELDS).select(
        _tree(F.col("source").cast("string")).alias("tree"), own.alias("leaf"), "doc_id",
        (own if seen is None else seen).alias("seen")))
    placed = _positions(rows, ["doc_id", "leaf", "seen"])
    sources = build(placed.select("tree", "position", "total", "leaf", F.struct("doc_id", "seen").alias("entry")), height)
    names = _roots(sources, height).select(F.lit("").alias("tree"), F.col("tree").alias("name"), F.col("root").alias("leaf"))
    top = build(_positions(names, ["name"]).select("tree", "position", "total", "leaf", F.struct("name").alias("entry")), height)
    root = top[-1].select("root").first()        # one row: the only block of the highest table
    return None if root is None else Manifest(sources, top, root["root"], height)


def proofs(found: Manifest, check: Check | None = None) -> DataFrame:
    """source key, doc_id, leaf, seen, subroot and the path (siblings left and right, leaf to root) of every row.

    With `check`, what it makes of them.
    """
    spark = found.top[0].sparkSession
    start = spark.createDataFrame([("", "", [])], f"tree string, subroot string, path {_PATH}")
    subroots = save(paths(found.top, start, found.height).select(
        F.col("entry.name").alias("tree"), F.col("leaf").alias("subroot"), "path"))
    rows = paths(found.sources, subroots, found.height, check)
    return rows if check else rows.select("tree", "entry.doc_id", "leaf", "entry.seen", "subroot", "path")


def _folded(batch: pa.RecordBatch) -> pa.RecordBatch:
    """Rows (leaf, entry, subroot, path) with the digest of their proof and the root that it leads to from `seen`."""
    steps = batch.column("path").flatten()
    left, right = (c.cast(pa.binary()).to_pylist() for c in steps.flatten())
    lengths = np.concatenate(([0], np.cumsum(batch.column("path").value_lengths().to_numpy())))
    doc_id, seen = (pc.struct_field(batch.column("entry"), c) for c in ("doc_id", "seen"))
    folded, proof = [], []
    for node, a, b in zip(seen.to_pylist(), lengths.tolist(), lengths[1:].tolist()):
        node = node.encode()
        for x, y in zip(left[a:b], right[a:b]):
            node = digest(x + node + y)
        folded.append(node.decode())
        proof.append(digest(b"".join(v for s in zip(left[a:b], right[a:b]) for v in s)).decode())
    return pa.record_batch([doc_id, batch.column("leaf"), batch.column("subroot"), pa.array(proof, pa.string()),
                            pa.array(folded, pa.string())], names=["doc_id", "leaf", "subroot", "proof_sha256", "folded_root"])


def verified(found: Manifest) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root and verified of every row by its proof."""
    kind = found.sources[0].schema["entries"].dataType.elementType["doc_id"].dataType.simpleString()
    check = Check(_folded, f"doc_id {kind}, leaf string, subroot string, proof_sha256 string, folded_root string")
    return proofs(found, check).select(
        "doc_id", "leaf", "subroot", F.lit(found.root).alias("root"), "proof_sha256", "folded_root", (F.col("folded_root") == found.root).alias("verified"))


def audit(docs: DataFrame, height: int = HEIGHT) -> DataFrame:
    """The manifest's rows after every fifth document (by crc32 of its id) had its A-Z lower-cased."""
    tampered = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    lowered = F.translate("text", string.ascii_uppercase, string.ascii_lowercase)
    found = manifest(docs, F.when(tampered, leaf(lowered)).otherwise(leaf()), height)
    if found is None:
        kind = docs.schema["doc_id"].dataType.simpleString()
        return docs.sparkSession.createDataFrame([], f"doc_id {kind}, leaf string, subroot string, root string, "
                                                     "proof_sha256 string, folded_root string, verified boolean")
    return verified(found)


def _oracle(height: int = 5) -> str:
    """DuckDB SQL for trees of up to 16 ** height leaves: one step a level, first of the sources, then of the subroots."""
    def steps(name: str, key: str) -> list[str]:
        out = []
        for k in range(height):
            # A tree that is down to one node stays as it is.
            out.append(f"{name}{k + 1} AS (SELECT {key}, i // 16 AS i, CASE WHEN any_value(n) = 1 THEN any_value(h) "
                       f"ELSE sha256(string_agg(h, '' ORDER BY i)) END AS h, (any_value(n) + 15) // 16 AS n "
                       f"FROM {name}{k} GROUP BY {key}, i // 16)")
            out.append(f"{name}s{k} AS (SELECT a.{key}, a.i, any_value(a.n) AS n, "
                       f"coalesce(string_agg(b.h, '' ORDER BY b.i) FILTER (WHERE b.i < a.i), '') AS l, "
                       f"coalesce(string_agg(b.h, '' ORDER BY b.i) FILTER (WHERE b.i > a.i), '') AS r "
                       f"FROM {name}{k} a JOIN {name}{k} b ON a.{key} = b.{key} AND a.i // 16 = b.i // 16 GROUP BY a.{key}, a.i)")
        return out

    def fold(name: str, key: str, source: str, first: str) -> list[str]:
        out, last = [], source
        for k in range(height):
            new = f"{first}{k}"
            out.append(f"{new} AS (SELECT p.* REPLACE (CASE WHEN s.n = 1 THEN node ELSE sha256(s.l || node || s.r) END AS node, "
                       f"proof || CASE WHEN s.n = 1 THEN '' ELSE s.l || s.r END AS proof) "
                       f"FROM {last} p JOIN {name}s{k} s ON s.{key} = p.{key} AND s.i = p.{name}i // {16 ** k})")
            last = new
        return out

    field = lambda c: f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen(CAST({c} AS VARCHAR)) || ':' || {c} END"
    whole = lambda text: "sha256(" + " || ".join(field(c if c != "text" else text) for c in FIELDS) + ")"
    lowered = f"translate(text, '{string.ascii_uppercase}', '{string.ascii_lowercase}')"
    crc = ("4294967295 - list_reduce(list_concat([4294967295], flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), "
           "lambda x: [ascii(x), -1, -1, -1, -1, -1, -1, -1, -1]))), "
           "lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) ELSE xor(c >> 1, 3988292384 * (c & 1)) END)")
    parts = [
        f"d AS (SELECT doc_id, CASE WHEN source IS NULL THEN '0' ELSE '1' || source END AS tree, {whole('text')} AS leaf, "
        f"CASE WHEN ({crc}) % 5 = 0 THEN {whole(lowered)} ELSE {whole('text')} END AS seen FROM documents)",
        "p AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf, seen) - 1 AS ai, "
        "count(*) OVER (PARTITION BY tree) AS n FROM d)",
        "a0 AS (SELECT tree, ai AS i, leaf AS h, n FROM p)", *steps("a", "tree"),
        f"t AS (SELECT tree, h, row_number() OVER (ORDER BY tree) - 1 AS bi, count(*) OVER () AS n FROM a{height})",
        "b0 AS (SELECT 0 AS one, bi AS i, h, n FROM t)", *steps("b", "one"),
        "q AS (SELECT p.doc_id, p.leaf, p.tree, p.ai, p.seen AS node, '' AS proof, 0 AS one, t.bi, t.h AS subroot FROM p JOIN t USING (tree))",
        *fold("a", "tree", "q", "x"), *fold("b", "one", f"x{height - 1}", "y")]
    return ("WITH " + ",\n".join(parts) + f"\nSELECT doc_id, leaf, subroot, r.h AS root, sha256(proof) AS proof_sha256, "
            f"node AS folded_root, node = r.h AS verified FROM y{height - 1}, b{height} r")


ORACLE = _oracle()
