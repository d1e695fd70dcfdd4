"""Operator 11: how filters interact, read off sorted posting lists.

Every document is measured once against five filters. What is kept per part
of the table (a language) is not the text but, for every filter, the sorted
list of the documents that fail it, cut into id ranges of at most `RANGE`
documents. Any question about an order of filters is a union or a difference
of such lists: lists of one range are merged k at a time, galloping from one
id range to the next, and the sizes of all ranges are summed by Spark. The
lists are a table of their own (`postings`), so a further order, or another
pair of filters, never reads a text again.

Failure conditions (words: runs of anything but space and 0x09-0x0D):

* A: under 200 words;
* B: 100 * distinct words < 50 * words;
* C: 100 * [A-Z] characters > 3 * code points;
* D: holds any of # $ % & * |
* E: identical to the text of any smaller doc_id of the whole table.

For a filter f and the filters P before it, `removed` is the size of f's list
less the lists of P. With five filters there are 80 such pairs (f, P); every
row of the 120 orders is one of them, so a range costs 80 differences and
the orders are only spelled out on the sums.

Defined cases: a null text is empty; a null lang is the part ''; a null
doc_id is no document's smaller one and has none; rows that repeat a doc_id
are documents of their own (equal ids are not smaller than each other); a
document is good (or toxic) when any label row of its id says so, labels of
unknown or null ids count nowhere; every part has all 600 rows, zeros
included; other columns are left alone; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from wattline.llm.common import save
from wattline.llm.textbytes import group_starts

FILTERS = "ABCDE"
RANGE = 65_536           # documents of one id range of one part
RUN = 4_096              # ids that a merge takes from a list at a time
HOT_SHARE = 1_000        # texts found in more than this fraction of all rows are broadcast: at most so many

_WORD = r"[^\x20\x09-\x0D]+"
_GOOD, _TOXIC = 1 << len(FILTERS), 2 << len(FILTERS)


# ---------------------------------------------------------------------------
# Merges of sorted lists
# ---------------------------------------------------------------------------

def gallop(ids: np.ndarray, at: int, bound: int) -> int:
    """First place from `at` on whose id is at least `bound`, by doubling steps and a search in the last one."""
    step, to = 1, at
    while to < len(ids) and ids[to] < bound:
        at, to, step = to + 1, to + step, 2 * step
    return at + int(np.searchsorted(ids[at:to], bound))


def id_ranges(lists: list[np.ndarray]) -> Iterator[list[np.ndarray]]:
    """Slices of all lists over successive id ranges; no slice is longer than `RUN`."""
    at = [0] * len(lists)
    while True:
        ahead = [ids[min(p + RUN, len(ids)) - 1] for ids, p in zip(lists, at) if p < len(ids)]
        if not ahead:
            return
        ends = [gallop(ids, p, min(ahead) + 1) for ids, p in zip(lists, at)]
        yield [ids[p:q] for ids, p, q in zip(lists, at, ends)]
        at = ends


def union(lists: list[np.ndarray]) -> np.ndarray:
    """Ids in any of the sorted lists."""
    parts = [np.unique(np.concatenate(found)) for found in id_ranges(lists)]
    return np.concatenate(parts) if parts else np.zeros(0, np.int64)


def _held(ids: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Which of the sorted ids the other sorted list holds."""
    if not len(other):
        return np.zeros(len(ids), bool)
    at = np.minimum(np.searchsorted(other, ids), len(other) - 1)
    return other[at] == ids


def difference(ids: np.ndarray, others: list[np.ndarray]) -> np.ndarray:
    """Ids of the first list that none of the others holds."""
    parts = []
    for first, *rest in id_ranges([ids, *others]):
        for other in rest:
            first = first[~_held(first, other)]
        parts.append(first)
    return np.concatenate(parts) if parts else np.zeros(0, np.int64)


def common(ids: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Ids in both lists."""
    parts = [a[_held(a, b)] for a, b in id_ranges([ids, other])]
    return np.concatenate(parts) if parts else np.zeros(0, np.int64)


# ---------------------------------------------------------------------------
# Posting lists
# ---------------------------------------------------------------------------

def _bit(condition: Column, name: str) -> Column:
    return F.when(condition, F.lit(1 << FILTERS.index(name))).otherwise(F.lit(0))


def measured(docs: DataFrame) -> DataFrame:
    """doc_id, part, bits (A to D: bit k says that filter k fails) and the text's digest of every row."""
    text = F.coalesce(F.col("text"), F.lit(""))
    words = F.regexp_extract_all(text, F.lit(_WORD), F.lit(0))
    counted = docs.select(
        "doc_id", F.coalesce(F.col("lang"), F.lit("")).alias("part"), F.size(words).alias("n_words"),
        F.size(F.array_distinct(words)).alias("n_distinct"), F.regexp_count(text, F.lit("[A-Z]")).alias("n_upper"),
        F.length(text).alias("n_chars"), text.rlike(r"[#$%&*|]").alias("has_symbol"),
        F.unhex(F.sha2(text, 256)).alias("digest"))
    long = lambda c: F.col(c).cast("long")
    return counted.select(
        "doc_id", "part", "digest",
        (_bit(F.col("n_words") < 200, "A") + _bit(100 * long("n_distinct") < 50 * long("n_words"), "B")
         + _bit(100 * long("n_upper") > 3 * long("n_chars"), "C") + _bit(F.col("has_symbol"), "D")).alias("bits"))


def _with_copies(base: DataFrame) -> DataFrame:
    """The rows of `measured`, saved, with the bit of E: the digest's smallest doc_id is smaller.

    A text in more than 1/1000 of the rows is broadcast (there are fewer than 1000 of them), so that its rows stay
    where they are; all others meet their digest's smallest id in a shuffle of groups below that size.
    """
    limit = base.count() // HOT_SHARE
    first = save(base.groupBy("digest").agg(F.min("doc_id").alias("first"), F.count("*").alias("copies")).filter("copies > 1"))
    hot = F.broadcast(first.filter(F.col("copies") > limit))
    later = F.coalesce(F.col("doc_id") > F.col("first"), F.lit(False))
    columns = ["part", "doc_id", (F.col("bits") + _bit(later, "E")).alias("bits")]
    return base.join(hot, "digest").select(*columns).unionByName(
        base.join(hot, "digest", "left_anti").join(first.filter(F.col("copies") <= limit), "digest", "left").select(*columns))


def _label_bits(labels: DataFrame) -> DataFrame:
    says = lambda column, bit: F.max(F.when(F.col(column) == 1, bit).otherwise(0))
    return labels.filter(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(
        (says("quality", _GOOD) + says("toxic", _TOXIC)).alias("label_bits"))


def postings(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part and id range: its documents and the sorted list of those failing each filter.

    Columns part, first_id, last_id, n (documents), ids and weights (distinct entries of the range and how many rows
    each stands for), then for A to E, `good` and `toxic` the sorted places in `ids`. Rows alike in part, doc_id and
    all verdicts are one entry, so a repeated doc_id is no hot key.
    """
    base = save(measured(docs.select("doc_id", "lang", "text")))
    entries = _with_copies(base).groupBy("part", "doc_id", "bits").agg(F.count("*").alias("weight")).join(
        _label_bits(labels), "doc_id", "left").select(
        "part", "doc_id", (F.col("bits") + F.coalesce("label_bits", F.lit(0))).alias("bits"), "weight")
    names = [*FILTERS, "good", "toxic"]
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = (f"part string, first_id {kind}, last_id {kind}, n long, ids array<{kind}>, weights array<long>, "
              + ", ".join(f"{name} array<int>" for name in names))

    def lists(found: pa.Table) -> pa.RecordBatch:
        bits, ids, weights = found.column("bits").to_numpy(), found.column("doc_id"), found.column("weight")
        one = lambda values, kind: pa.array([values], pa.list_(kind))
        return pa.record_batch(
            [pa.array([found.column("part")[0].as_py()], pa.string()), pa.array([ids[0].as_py()], ids.type),
             pa.array([ids[-1].as_py()], ids.type), pa.array([int(weights.to_numpy().sum())], pa.int64()),
             one(ids.to_pylist(), ids.type), one(weights.to_numpy(), pa.int64()),
             *(one(np.flatnonzero(bits & (1 << k)).astype(np.int32), pa.int32()) for k in range(len(names)))],
            names=["part", "first_id", "last_id", "n", "ids", "weights", *names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            now = pa.Table.from_batches([batch])
            now = now if held is None else pa.concat_tables([held, now])
            starts = group_starts(now.column("part").to_numpy(zero_copy_only=False))
            for x, y in zip(starts, np.append(starts[1:], now.num_rows)):
                while y - x >= RANGE:
                    yield lists(now.slice(x, RANGE))
                    x += RANGE
                held = now.slice(x, y - x) if x < y else None
                if y < now.num_rows and held is not None:
                    yield lists(held)
        if held is not None:
            yield lists(held)

    order = ["part", "doc_id", "bits"]
    return save(entries.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(run, schema))


# ---------------------------------------------------------------------------
# Sizes
# ---------------------------------------------------------------------------

def interactions(lists: DataFrame) -> DataFrame:
    """part, filter, prior (mask of the filters before), and over all id ranges n (documents), kept (by prior and
    filter), removed (by filter after prior), good and toxic among the removed."""
    def sizes(row: dict) -> Iterator[tuple]:
        weights = np.array(row["weights"], np.int64)
        as_list = lambda name: np.array(row[name], np.int64)
        fails, good, toxic = [as_list(name) for name in FILTERS], as_list("good"), as_list("toxic")
        any_of = [np.zeros(0, np.int64)]
        for mask in range(1, 1 << len(FILTERS)):
            last = mask.bit_length() - 1
            any_of.append(union([any_of[mask - (1 << last)], fails[last]]))
        for k in range(len(FILTERS)):
            for prior in range(1 << len(FILTERS)):
                if not prior >> k & 1:
                    gone = difference(fails[k], [any_of[prior]])
                    yield (row["part"], FILTERS[k], prior, row["n"], row["n"] - int(weights[any_of[prior | 1 << k]].sum()),
                           int(weights[gone].sum()), int(weights[common(gone, good)].sum()), int(weights[common(gone, toxic)].sum()))

    names = ["part", "filter", "prior", "n", "kept", "removed", "good", "toxic"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                found = list(zip(*sizes(batch.slice(i, 1).to_pylist()[0])))
                kinds = [pa.string(), pa.string(), pa.int32(), *[pa.int64()] * 5]
                yield pa.record_batch([pa.array(v, k) for v, k in zip(found, kinds)], names=names)

    wanted = lists.select("part", "n", "weights", *FILTERS, "good", "toxic")
    counts = wanted.mapInArrow(run, "part string, filter string, prior int, " + ", ".join(f"{c} long" for c in names[3:]))
    return counts.groupBy("part", "filter", "prior").agg(*(F.sum(c).alias(c) for c in names[3:]))


def orders(found: DataFrame) -> DataFrame:
    """The rows of `interactions`, spelled out for every order of the filters."""
    steps = [("".join(order), k + 1, order[k], sum(1 << FILTERS.index(f) for f in order[:k]))
             for order in permutations(FILTERS) for k in range(len(FILTERS))]
    spelled = found.sparkSession.createDataFrame(steps, "filter_order string, step int, filter string, prior int")
    own = Window.partitionBy("part", "filter")
    single = found.withColumns({
        "failing": F.max(F.when(F.col("prior") == 0, F.col("removed"))).over(own),
        "unique_fails": F.max(F.when(F.bit_count("prior") == len(FILTERS) - 1, F.col("removed"))).over(own)})
    # 600 rows are broadcast.
    return single.join(F.broadcast(spelled), ["filter", "prior"]).select(
        "part", "filter_order", "step", "kept", "removed", (F.col("failing") - F.col("removed")).alias("redundant"),
        "unique_fails", F.col("good").alias("good_lost"), F.col("toxic").alias("toxic_lost"),
        F.sum("removed").over(own).alias("shapley"))


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per part, every order of the five filters, step by step."""
    return orders(interactions(postings(docs, labels)))


ORACLE = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws, min(doc_id) OVER (PARTITION BY text) AS first FROM d),
g AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
      FROM labels GROUP BY doc_id),
b AS (SELECT r, part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
        {'A': len(ws) < 200, 'B': 100 * len(list_distinct(ws)) < 50 * len(ws),
         'C': 100 * (length(text) - length(regexp_replace(text, '[A-Z]', '', 'g'))) > 3 * length(text),
         'D': regexp_matches(text, '[#$%&*|]'), 'E': coalesce(w.doc_id > first, false)} AS fails
      FROM w LEFT JOIN g ON g.doc_id = w.doc_id),
f AS (SELECT r, part, good, toxic, unnest(['A', 'B', 'C', 'D', 'E']) AS letter,
             unnest([fails.A, fails.B, fails.C, fails.D, fails.E]) AS failed FROM b),
l AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
o AS (SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM l a, l b, l c, l d, l e
      WHERE a.x NOT IN (b.x, c.x, d.x, e.x) AND b.x NOT IN (c.x, d.x, e.x) AND c.x NOT IN (d.x, e.x) AND d.x <> e.x),
m AS (SELECT part, good, toxic, count(*) AS n, bits FROM (
        SELECT r, part, good, toxic, string_agg(letter, '' ORDER BY letter) FILTER (WHERE failed) AS bits
        FROM f GROUP BY ALL) GROUP BY ALL),
t AS (SELECT part, filter_order, step, filter_order[step] AS letter, n, good, toxic, coalesce(bits, '') AS bits,
             coalesce(len(list_filter(string_split(filter_order[1:step - 1], ''), lambda y: y <> '' AND contains(coalesce(bits, ''), y))), 0) > 0 AS gone
      FROM m, o, (SELECT unnest(range(1, 6)) AS step)),
s AS (SELECT part, filter_order, step, letter,
             sum(CASE WHEN NOT gone AND NOT contains(bits, letter) THEN n ELSE 0 END) AS kept,
             sum(CASE WHEN NOT gone AND contains(bits, letter) THEN n ELSE 0 END) AS removed,
             sum(CASE WHEN gone AND contains(bits, letter) THEN n ELSE 0 END) AS redundant,
             sum(CASE WHEN bits = letter THEN n ELSE 0 END) AS unique_fails,
             sum(CASE WHEN NOT gone AND contains(bits, letter) THEN n * good ELSE 0 END) AS good_lost,
             sum(CASE WHEN NOT gone AND contains(bits, letter) THEN n * toxic ELSE 0 END) AS toxic_lost
      FROM t GROUP BY ALL)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
       CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
       CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, letter) AS BIGINT) AS shapley
FROM s
"""
