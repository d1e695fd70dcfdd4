"""Exact k-nearest-neighbour regression (ML-04): uniform mean of the k
nearest training labels, Euclidean distance, ties broken by training id.

The search is exact, yet a test row meets only the cells that may hold one of
its neighbours:

1. Rows with equal features cannot be told apart by distance. Of the training
   rows only the k smallest ids of each distinct vector can ever be a
   neighbour, and test rows with one vector share one answer, so both sides
   shrink first (a hot vector shrinks before the shuffle).
2. A kd-tree over a sample of at most `SAMPLE` training vectors cuts space
   into cells of about `block_rows` rows; the hash that draws the sample also
   tells the number of rows, so nothing is counted. A cell that holds more
   rows than that (the sample bounds the number of cells) is dealt in chunks.
3. A test vector's own cell gives a first answer and the distance of its k-th
   row. The tree then names every other cell whose box is not farther than
   that, and only those are visited. Equality counts as near enough, as a
   smaller id wins a tie. If its own cell holds less than k rows, k sample
   vectors of that cell's parents bound the distance.
4. The k best of all visits are kept per test vector (partially before the
   shuffle), and their mean goes to all test rows with that vector.

Tasks hold one chunk of training rows; test vectors stream by. Rows with a
null, NaN or infinite feature take no part: they are no neighbours, and get
no prediction.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wattline.contracts import NEIGHBOURS

SAMPLE = 16_384          # training vectors the tree is fitted on
CELL_SAMPLE = 8          # sample vectors of a cell at least
QUERY_ROWS = 256         # test vectors compared with a chunk at a time
_SLACK = 1 + 1e-9        # keeps rounding from skipping a cell

_VISIT = "qid long, x array<double>, cell int, chunk int, side int, y double"
_FOUND = "qid long, tid long, dist2 double, y double"


@dataclass(frozen=True)
class Cells:
    """A kd-tree: inner node i has the children 2i+1 and 2i+2; the leaves are the cells."""
    dims: np.ndarray         # of inner nodes
    cuts: np.ndarray
    samples: np.ndarray      # the sample vectors, ordered by leaf
    edges: np.ndarray        # where each leaf's samples begin

    @property
    def many(self) -> int:
        return len(self.dims) + 1

    def cell(self, x: np.ndarray) -> np.ndarray:
        """The leaf of each row of x."""
        node = np.zeros(len(x), np.int64)
        for _ in range(self.many.bit_length() - 1):
            right = x[np.arange(len(x)), self.dims[node]] >= self.cuts[node]
            node = 2 * node + 1 + right
        return node - len(self.dims)

    def reach(self, x: np.ndarray, cell: int, k: int) -> np.ndarray:
        """An upper bound of the squared distance to the k-th row: that to the k-th sample vector near the cell."""
        width = 1
        while True:
            first = cell // width * width
            a, b = self.edges[first], self.edges[min(first + width, self.many)]
            if b - a >= k:
                break
            if width >= self.many:
                return np.full(len(x), np.inf)
            width *= 2
        return np.partition(squared(x, self.samples[a:b]), k - 1, axis=1)[:, k - 1]

    def near(self, x: np.ndarray, reach: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows of x and the cells whose box is within reach of them, all levels of the tree pruned on the way."""
        rows, cells = [], []
        stack = [(0, np.arange(len(x)), np.zeros((len(x), x.shape[1])))]
        while stack:
            node, who, off = stack.pop()
            if not len(who):
                continue
            if node >= len(self.dims):
                rows.append(who)
                cells.append(np.full(len(who), node - len(self.dims)))
                continue
            d, cut = self.dims[node], self.cuts[node]
            gap = x[who, d] - cut
            for child, beyond in ((2 * node + 1, np.maximum(gap, 0)), (2 * node + 2, np.maximum(-gap, 0))):
                there = off.copy()
                there[:, d] = np.maximum(there[:, d], beyond)
                ok = (there * there).sum(axis=1) <= reach[who] * _SLACK
                stack.append((child, who[ok], there[ok]))
        if not rows:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate(rows), np.concatenate(cells)


def squared(q: np.ndarray, t: np.ndarray) -> np.ndarray:
    """Squared distances, summed feature by feature in a fixed order."""
    out = np.zeros((len(q), len(t)))
    for j in range(q.shape[1]):
        diff = q[:, j][:, None] - t[:, j][None, :]
        out += diff * diff
    return out


def fit_cells(sample: np.ndarray, rows: float, block_rows: int) -> Cells:
    """A tree of as many cells as `rows` fill, if the sample has CELL_SAMPLE vectors for each."""
    depth = 0
    while 2 ** depth * block_rows < rows and 2 ** (depth + 1) * CELL_SAMPLE <= len(sample):
        depth += 1
    inner = 2 ** depth - 1
    dims, cuts = np.zeros(inner, np.int64), np.zeros(inner)
    held: list[np.ndarray] = [np.arange(len(sample))]
    for node in range(inner):
        mine = sample[held[node]]
        # The widest side is cut at its middle vector; equal values stay on one side.
        dims[node] = d = int(np.argmax(np.ptp(mine, axis=0))) if len(mine) else 0
        cuts[node] = np.sort(mine[:, d])[len(mine) // 2] if len(mine) else 0.0
        right = mine[:, d] >= cuts[node]
        held += [held[node][~right], held[node][right]]
    leaves = held[inner:]
    return Cells(dims, cuts, sample[np.concatenate(leaves)] if len(sample) else sample,
                 np.concatenate(([0], np.cumsum([len(v) for v in leaves]))))


def _vectors(column: pa.Array) -> np.ndarray:
    values = column.flatten().to_numpy(zero_copy_only=False)
    return values.reshape(len(column), -1)


def _best(q: np.ndarray, tid: np.ndarray, t: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row of q, row of t and squared distance of each q's k nearest; t is in order of its ids."""
    d2 = squared(q, t)
    kk = min(k, len(t))
    kth = np.partition(d2, kk - 1, axis=1)[:, kk - 1:kk]
    r, c = np.nonzero(d2 <= kth)              # ties of the k-th included
    d = d2[r, c]
    order = np.lexsort((c, d, r))
    r, c, d = r[order], c[order], d[order]
    keep = np.arange(len(r)) - np.searchsorted(r, r) < kk
    return r[keep], c[keep], d[keep]


def _search(k: int):
    """Chunks of training rows (side 0), each followed by the test vectors that visit it (side 1)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, parts, block = None, [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            cell, chunk, side, qid, y = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("cell", "chunk", "side", "qid", "y"))
            x = _vectors(batch.column("x"))
            new = np.ones(len(cell), bool)
            new[1:] = (cell[1:] != cell[:-1]) | (chunk[1:] != chunk[:-1]) | (side[1:] != side[:-1])
            heads = np.flatnonzero(new)
            for a, b in zip(heads, np.append(heads[1:], len(cell))):
                if (cell[a], chunk[a]) != name:
                    name, parts, block = (cell[a], chunk[a]), [], None
                if side[a] == 0:
                    parts.append((qid[a:b], x[a:b], y[a:b]))
                    continue
                if block is None and parts:
                    block = [np.concatenate(p) for p in zip(*parts)]
                    order = np.argsort(block[0], kind="stable")
                    block = [v[order] for v in block]
                if block is None:
                    continue
                tid, t, ty = block
                for at in range(a, b, QUERY_ROWS):
                    to = min(b, at + QUERY_ROWS)
                    r, c, d = _best(x[at:to], tid, t, k)
                    yield pa.record_batch([pa.array(qid[at:to][r]), pa.array(tid[c]), pa.array(d), pa.array(ty[c])],
                                          names=["qid", "tid", "dist2", "y"])
    return run


def _placed(cells: Cells, chunks: int, side: int):
    """Rows qid, x, y with their cell: training rows in one of its chunks, test vectors in all."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            qid = batch.column("qid").to_numpy()
            cell = cells.cell(_vectors(batch.column("x")))
            if side:
                at, chunk = np.repeat(np.arange(len(qid)), chunks), np.tile(np.arange(chunks), len(qid))
            else:
                at, chunk = np.arange(len(qid)), _dealt(qid, chunks)
            rows = batch.take(pa.array(at))
            yield pa.record_batch([rows.column("qid"), rows.column("x"), pa.array(cell[at].astype(np.int32)),
                                   pa.array(chunk.astype(np.int32)), pa.array(np.full(len(at), side, np.int32)), rows.column("y")],
                                  names=["qid", "x", "cell", "chunk", "side", "y"])
    return run


def _dealt(ids: np.ndarray, chunks: int) -> np.ndarray:
    mixed = ids.astype(np.int64).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return ((mixed >> np.uint64(33)) % np.uint64(chunks)).astype(np.int64)


def _visits(cells: Cells, chunks: int, k: int):
    """The further cells each test vector has to visit, after the distance of its k-th row so far."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            qid, x = batch.column("qid").to_numpy(), _vectors(batch.column("x"))
            reach = batch.column("reach").to_numpy(zero_copy_only=False).copy()
            own = cells.cell(x)
            for cell in np.unique(own[np.isinf(reach)]):
                short = np.flatnonzero((own == cell) & np.isinf(reach))
                reach[short] = cells.reach(x[short], int(cell), k)
            who, cell = cells.near(x, reach)
            other = cell != own[who]
            who, cell = np.repeat(who[other], chunks), np.repeat(cell[other], chunks)
            chunk = np.tile(np.arange(chunks), int(other.sum()))
            yield pa.record_batch([
                pa.array(qid[who]), batch.column("x").take(pa.array(who)), pa.array(cell.astype(np.int32)),
                pa.array(chunk.astype(np.int32)), pa.array(np.ones(len(who), np.int32)), pa.nulls(len(who), pa.float64())],
                names=["qid", "x", "cell", "chunk", "side", "y"])
    return run


def _sides(train: DataFrame, test: DataFrame, features: list[str], label: str, id_col: str,
           k: int) -> tuple[DataFrame, DataFrame]:
    """Training rows that can be neighbours, and the test rows, as qid, x, y."""
    vector = F.array(*[F.col(f"`{f}`").cast("double") for f in features])
    whole = F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    key = F.col(f"`{id_col}`").cast("long").alias("qid")
    first = Window.partitionBy("x").orderBy("qid")
    near = train.select(key, vector.alias("x"), F.col(f"`{label}`").cast("double").alias("y")).where(whole).withColumn(
        "_n", F.row_number().over(first)).where(F.col("_n") <= k).drop("_n")
    return near, test.select(key, vector.alias("x")).where(whole)


def _k_best(found: DataFrame, k: int) -> DataFrame:
    nearest = Window.partitionBy("qid").orderBy("dist2", "tid")
    return found.withColumn("_n", F.row_number().over(nearest)).where(F.col("_n") <= k)


def nearest(train: DataFrame, queries: DataFrame, width: int, k: int, block_rows: int) -> DataFrame:
    """qid, tid, dist2, y: rows that hold the k nearest training rows of each query (both: qid, x; train: y)."""
    draw = F.xxhash64("qid", F.lit(7))
    sample = train.select("x", draw.alias("_h")).orderBy("_h").limit(SAMPLE).toPandas()   # at most SAMPLE vectors
    vectors = np.stack(sample["x"].to_numpy()).astype(float) if len(sample) else np.zeros((0, width))
    rows = float(len(sample))
    if len(sample) == SAMPLE:                 # as large a share of the hash's range as of the rows
        rows *= 2.0 ** 64 / (int(sample["_h"].iloc[-1]) + 2.0 ** 63 + 1)
    cells = fit_cells(vectors, rows, block_rows)
    chunks = max(1, round(rows / cells.many / block_rows))
    blocks = train.select("qid", "x", "y").mapInArrow(_placed(cells, chunks, 0), _VISIT)

    def search(visits: DataFrame) -> DataFrame:
        return blocks.unionByName(visits).repartition("cell", "chunk").sortWithinPartitions(
            "cell", "chunk", "side").mapInArrow(_search(k), _FOUND)

    own = search(queries.select("qid", "x", F.lit(None).cast("double").alias("y")).mapInArrow(_placed(cells, chunks, 1), _VISIT))
    if cells.many == 1:
        return own
    own = _k_best(own, k).drop("_n")          # read twice, shuffled once: its exchange is reused
    reach = own.groupBy("qid").agg(F.when(F.count("*") >= k, F.max("dist2")).otherwise(float("inf")).alias("reach"))
    further = queries.join(reach, "qid", "left").select(
        "qid", "x", F.coalesce("reach", F.lit(float("inf"))).alias("reach")).mapInArrow(_visits(cells, chunks, k), _VISIT)
    return own.unionByName(search(further))


def knn_predict(train: DataFrame, test: DataFrame, features: list[str], label: str,
                id_col: str, k: int = NEIGHBOURS, block_rows: int = 16_384) -> DataFrame:
    """Prediction per test row: `id_col`, `prediction` (mean label of the k nearest)."""
    near, rows = _sides(train, test, features, label, id_col, k)
    queries = rows.groupBy("x").agg(F.min("qid").alias("qid"))
    best = _k_best(nearest(near, queries, len(features), k, block_rows), k)
    means = best.groupBy("qid").agg(F.avg("y").alias("prediction"))
    answers = queries.join(means, "qid").select("x", "prediction")
    return rows.join(answers, "x").select(F.col("qid").alias(id_col), "prediction")
