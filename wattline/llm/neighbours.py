"""Operator 3: nearest neighbours by stable projections, a kd-tree and a chi-square stopping test.

Vectors are projected on `dims` Gaussian directions. The square of a pair's
projected distance, divided by the square of its distance, follows a
chi-square law with `dims` degrees of freedom, so a neighbour at distance d
lies within d * sqrt(q) in the projected space with the probability of the
quantile q.

The upper levels of a kd-tree over the projected vectors are fitted on a
bounded sample; its leaves are cells, and every vector is filed under its
cell (in chunks, so that a cell of any size is shared by tasks). A query
first searches the cell it falls into; its k-th distance there bounds which
other cells can still matter. Inside a chunk a smaller kd-tree opens leaves by
increasing projected distance, and the vectors of open leaves are verified in
the order of their own projected distance (a few at a time), as long as no
closed leaf is nearer. The search stops when the next vector's projected
distance exceeds the k-th best distance times sqrt(q): the stopping test.
`verified` counts the vectors whose true distance a query computed.

Defined cases: vectors that are null, zero, of another length than most, or
hold null or non-finite components take no part; so do rows without vec_id.
Repeated rows are candidates of each other; equal distances go to the smaller
vec_id; with fewer than k candidates all are found; other columns are left
alone; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, Window, functions as F

from wattline.llm.common import save

K, EVERY = 10, 100
DIMS = 48
CHI_SQUARE = 63.16       # the 0.93 quantile of chi-square with DIMS degrees of freedom
SAMPLE = 20_000          # vectors that the upper levels of the tree are fitted on
CELL_ROWS = 4096
LEAF_ROWS = 64
STEP = 16                # vectors verified between two stopping tests
_QUERIES = 4096          # queries sent along with one copy of a chunk's vectors


def _matrix(column: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Valid rows' indices and their vectors as doubles."""
    lists = column.cast(pa.large_list(pa.float64()))
    sizes = np.asarray(pa.compute.fill_null(pa.compute.list_value_length(lists), -1))
    fits = np.flatnonzero(sizes == width)
    if not len(fits) or not width:
        return np.zeros(0, np.int64), np.zeros((0, max(1, width)))
    flat = lists.take(pa.array(fits)).flatten()
    vectors = flat.to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width)     # null becomes nan
    good = np.isfinite(vectors).all(axis=1) & (vectors != 0).any(axis=1)
    return fits[good], vectors[good]


def _directions(width: int, dims: int) -> np.ndarray:
    return np.random.default_rng(12061).standard_normal((max(1, width), dims))


# --- kd-trees ---------------------------------------------------------------------

def split_boxes(points: np.ndarray, leaf: int) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Leaves of a kd-tree: lower and upper bounds of half-open boxes that tile the space, and their points' rows."""
    dims = points.shape[1]
    boxes, todo = [], [(np.arange(len(points)), np.full(dims, -np.inf), np.full(dims, np.inf))]
    while todo:
        rows, low, high = todo.pop()
        if len(rows) > leaf:
            inside = points[rows]
            axis = int(np.argmax(inside.max(axis=0) - inside.min(axis=0)))
            values = inside[:, axis]
            cut = float(np.median(values))
            if cut == values.min():
                above = values[values > cut]
                cut = float(above.min()) if len(above) else cut
            right = values >= cut
            if right.any() and not right.all():
                high_left, low_right = high.copy(), low.copy()
                high_left[axis] = low_right[axis] = cut
                todo += [(rows[right], low_right, high), (rows[~right], low, high_left)]
                continue
        boxes.append((low, high, rows))
    return np.array([b[0] for b in boxes]), np.array([b[1] for b in boxes]), [b[2] for b in boxes]


def _box_distances(point: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    gap = np.maximum(np.maximum(low - point, point - high), 0)
    return (gap * gap).sum(axis=-1)


def _cell_of(points: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    cell = np.zeros(len(points), np.int64)
    for a in range(0, len(points), 1024):
        part = points[a:a + 1024, None, :]
        cell[a:a + 1024] = np.argmax(((part >= low) & (part < high)).all(axis=2), axis=1)
    return cell


class Chunk:
    """Vectors of one task with a small kd-tree over their projections, tight boxes for the search."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray, vectors: np.ndarray, projected: np.ndarray):
        self.ids, self.rows, self.vectors, self.projected = ids, rows, vectors, projected
        leaves = split_boxes(projected, LEAF_ROWS)[2]
        self.leaves = leaves
        self.low = np.array([projected[r].min(axis=0) for r in leaves])
        self.high = np.array([projected[r].max(axis=0) for r in leaves])

    def search(self, row: int, vector: np.ndarray, point: np.ndarray, bound: float, k: int, quantile: float):
        """The k nearest found as (distance, id) by the stopping test, and how many vectors were verified.

        `bound`: a distance that k others are known to keep.
        """
        away = _box_distances(point, self.low, self.high)
        order = np.argsort(away, kind="stable")
        best_d, best_id = np.zeros(0), np.zeros(0, np.int64)
        near, gaps = np.zeros(0, np.int64), np.zeros(0)     # not yet verified, of open leaves, by projected distance
        limit, opened, step, verified = bound, 0, 2, 0
        while True:
            reach = quantile * limit * limit * (1 + 1e-12)
            closed = away[order[opened]] if opened < len(order) else np.inf
            ready = min(STEP, int(np.searchsorted(gaps, min(closed, reach), side="right")))
            if ready:
                take, near, gaps = near[:ready], near[ready:], gaps[ready:]
                gap = self.vectors[take] - vector
                best_d = np.concatenate((best_d, np.sqrt((gap * gap).sum(axis=1))))
                best_id = np.concatenate((best_id, self.ids[take]))
                first = np.lexsort((best_id, best_d))[:k]
                best_d, best_id = best_d[first], best_id[first]
                verified += ready
                if len(best_d) == k:
                    limit = min(bound, best_d[-1])
            elif opened == len(order) or closed > reach:
                return best_d, best_id, verified
            else:
                more = np.concatenate([self.leaves[x] for x in order[opened:opened + step]])
                opened, step = min(opened + step, len(order)), step * 2
                more = more[self.rows[more] != row]
                gap = self.projected[more] - point
                near, gaps = np.concatenate((near, more)), np.concatenate((gaps, (gap * gap).sum(axis=1)))
                by = np.argsort(gaps, kind="stable")
                near, gaps = near[by], gaps[by]


# --- the join ---------------------------------------------------------------------

_VECTOR = "row long, vec_id long, vector array<double>, projected array<double>"


def _lists(matrix: np.ndarray) -> pa.Array:
    n, width = matrix.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * width), pa.array(matrix.ravel()))


def _as_matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy().reshape(len(column), -1)


def _projected(vectors: DataFrame, width: int, dims: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        directions = _directions(width, dims)
        for batch in batches:
            rows, matrix = _matrix(batch.column("embedding"), width)
            if len(rows):
                at = pa.array(rows)
                # One product for each vector: equal vectors get equal projections in any batch.
                projected = np.stack([v @ directions for v in matrix])
                yield pa.record_batch([batch.column("row").take(at), batch.column("vec_id").take(at), _lists(matrix),
                                       _lists(projected)], names=["row", "vec_id", "vector", "projected"])

    return vectors.filter("vec_id IS NOT NULL").select(
        F.monotonically_increasing_id().alias("row"), F.col("vec_id").cast("long").alias("vec_id"), "embedding").mapInArrow(
        run, _VECTOR)


def _searched(chunks: DataFrame, visits: DataFrame, k: int, quantile: float) -> DataFrame:
    """query row, query id, neighbour and distance of the k nearest found in every visited chunk, and with the first of
    them how many vectors of the chunk were verified (a chunk without a verified vector gives no row)."""
    dealt = visits.withColumn("part", F.pmod(F.xxhash64("row"), F.col("parts"))).drop("parts")
    copies = visits.select("cell", "parts").distinct().select("cell", F.explode(F.sequence(
        F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"))
    base = chunks.join(copies, "cell").select(
        "cell", "chunk", "part", F.lit(0).alias("is_query"), "row", "vec_id", "vector", "projected",
        F.lit(None).cast("double").alias("bound"))
    queries = chunks.select("cell", "chunk").distinct().join(dealt, "cell").select(
        "cell", "chunk", "part", F.lit(1).alias("is_query"), "row", "vec_id", "vector", "projected", "bound")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, parts, chunk = None, [], None
        for batch in batches:
            key = np.stack([batch.column(c).to_numpy() for c in ("cell", "chunk", "part", "is_query")], 1)
            heads = np.flatnonzero(np.concatenate(([True], (key[1:] != key[:-1]).any(axis=1)))) if len(key) else []
            for a, b in zip(heads, np.append(heads[1:], len(key)) if len(heads) else []):
                here = batch.slice(a, b - a)
                if tuple(key[a][:3]) != name:
                    name, parts, chunk = tuple(key[a][:3]), [], None
                if not key[a][3]:
                    parts.append([here.column("vec_id").to_numpy(), here.column("row").to_numpy(),
                                  _as_matrix(here.column("vector")), _as_matrix(here.column("projected"))])
                    continue
                if chunk is None:
                    chunk = Chunk(*(np.concatenate(x) for x in zip(*parts)))
                vectors, points = _as_matrix(here.column("vector")), _as_matrix(here.column("projected"))
                rows, ids = here.column("row").to_numpy(), here.column("vec_id").to_numpy()
                bounds = here.column("bound").to_numpy(zero_copy_only=False)
                found = [chunk.search(rows[q], vectors[q], points[q], np.inf if np.isnan(bounds[q]) else bounds[q], k, quantile)
                         for q in range(len(rows))]
                n = [len(d) for d, _, _ in found]
                if sum(n):
                    verified = np.zeros(sum(n), np.int64)
                    some = np.flatnonzero(n)
                    verified[(np.cumsum(n) - n)[some]] = np.array([v for _, _, v in found])[some]
                    yield pa.record_batch([
                        np.repeat(rows, n), np.repeat(ids, n), np.concatenate([i for _, i, _ in found]),
                        np.concatenate([d for d, _, _ in found]), verified],
                        names=["row", "query_id", "vec_id", "score", "verified"])

    return base.unionByName(queries).repartition("cell", "chunk", "part").sortWithinPartitions(
        "cell", "chunk", "part", "is_query").mapInArrow(run, "row long, query_id long, vec_id long, score double, verified long")


def _nearest(found: DataFrame, k: int) -> DataFrame:
    """The k nearest of every query; `verified`, summed over what was found, stands with the first of them."""
    whole = Window.partitionBy("row")
    rank = F.row_number().over(whole.orderBy("score", "vec_id"))
    return found.select("row", "query_id", "vec_id", "score", rank.alias("rank"), F.sum("verified").over(whole).alias("all")).filter(
        F.col("rank") <= k).select("row", "query_id", "vec_id", "score", "rank", F.when(F.col("rank") == 1, F.col("all")).otherwise(
            0).alias("verified"))


def nearest_neighbours(vectors: DataFrame, k: int = K, every: int = EVERY, dims: int = DIMS,
                       quantile: float = CHI_SQUARE, sample: int = SAMPLE, cell_rows: int = CELL_ROWS) -> DataFrame:
    """query_id, rank, vec_id, score of the rows whose vec_id is divisible by `every`, searched among all rows; with rank 1
    also how many vectors were `verified` for the query (0 at the other ranks)."""
    sizes = vectors.groupBy(F.size("embedding").alias("n")).agg(F.count("*").alias("m")).filter("n > 0").orderBy(
        F.desc("m"), "n").first()
    width = sizes["n"] if sizes else 0
    index = save(_projected(vectors, width, dims))
    total = index.count()
    share = max(1, -(-total // sample))
    fitted = index.filter(F.pmod(F.xxhash64("vec_id", "row"), F.lit(share)) == 0).select("projected").limit(sample).toPandas()
    points = np.stack(fitted["projected"].to_numpy()) if len(fitted) else np.zeros((0, dims))
    low, high, _ = split_boxes(points, max(1, int(cell_rows * len(points) / max(1, total)))) if len(points) else (
        np.full((1, dims), -np.inf), np.full((1, dims), np.inf), None)

    def filed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                cell = _cell_of(_as_matrix(batch.column("projected")), low, high)
                yield pa.record_batch([*batch.columns, pa.array(cell)], names=[*batch.schema.names, "cell"])

    filed_index = save(index.mapInArrow(filed, _VECTOR + ", cell long"))
    parts = filed_index.groupBy("cell").agg(F.ceil(F.count("*") / F.lit(cell_rows)).alias("chunks"))
    chunks = filed_index.join(F.broadcast(parts), "cell").withColumn(       # one row for each cell
        "chunk", F.pmod(F.xxhash64("row"), F.col("chunks"))).drop("chunks")

    def with_parts(visits: DataFrame) -> DataFrame:
        crowd = visits.groupBy("cell").agg(F.ceil(F.count("*") / F.lit(_QUERIES)).alias("parts"))
        return visits.join(crowd, "cell")

    queries = filed_index.filter(F.pmod(F.col("vec_id"), F.lit(every)) == 0)
    own = queries.withColumn("bound", F.lit(None).cast("double"))
    first = save(_nearest(_searched(chunks, with_parts(own), k, quantile), k))
    bounds = first.filter(F.col("rank") == k).select("row", F.col("score").alias("bound"))

    def other_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            points_ = _as_matrix(batch.column("projected"))
            home = batch.column("cell").to_numpy()
            limit = batch.column("bound").to_numpy(zero_copy_only=False)
            limit = np.where(np.isnan(limit), np.inf, limit)
            rows, cells = [], []
            for q in range(len(points_)):
                near = np.flatnonzero(_box_distances(points_[q], low, high) <= quantile * limit[q] ** 2 * (1 + 1e-12))
                near = near[near != home[q]]
                rows.append(np.full(len(near), q)), cells.append(near)
            at = pa.array(np.concatenate(rows))
            columns = {n: c.take(at) for n, c in zip(batch.schema.names, batch.columns)}
            columns["cell"] = pa.array(np.concatenate(cells).astype(np.int64))
            yield pa.record_batch(list(columns.values()), names=list(columns))

    visits = save(queries.join(bounds, "row", "left").select("row", "vec_id", "vector", "projected", "cell", "bound").mapInArrow(other_cells, _VECTOR + ", cell long, bound double"))
    second = _searched(chunks, with_parts(visits), k, quantile)
    return _nearest(first.drop("rank").unionByName(second), k).select(
        "query_id", "rank", "vec_id", "score", "verified")

