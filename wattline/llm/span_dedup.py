"""Operator 1: remove sentences that repeat an earlier run of sentences.

A sentence ends with a word that ends in `.`, `!` or `?`, or at the end of a
line. From every sentence the shortest run of several sentences is hashed: at
least three sentences and 15 words, or at least 30 words; a text too short
for any run is one run. With `both_ends` the shortest run up to every sentence
is hashed too, so every sentence of a repeated passage that is long enough for
a run lies in one inside the passage: the last ones in the run up to its end.
Equal runs of the whole corpus meet in one shuffle,
sorted by document and place, so the first is the one with no equal row
before it, and only the others are passed on: neither a group nor its pairs
are ever collected. Rows with an earlier equal in their own slice of documents
are settled before the shuffle. A sentence goes if any run that covers it has an earlier
equal.

Defined cases: a null text stays null, a wordless text stays as it is;
documents come in the order of doc_id (null last), then of the text's hash;
rows with equal doc_id and text are one document and are cleaned alike;
other columns are left alone; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from wattline.llm.common import map_slices
from wattline.llm.textbytes import Texts, group_starts, mix, signed

SENTENCES, WORDS, ENOUGH_WORDS = 3, 15, 30

_U = np.uint64
_STOPS = np.zeros(256, bool)
_STOPS[list(b".!?")] = True


def sentences(texts: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """First byte, end, document and number of words of every sentence."""
    a, b, doc = texts.words()
    if not len(a):
        return a, b, doc, a
    closes = _STOPS[texts.data[b - 1]]
    lines = np.concatenate(([0], np.cumsum(texts.data == 0x0A)))
    closes[:-1] |= (lines[a[1:]] > lines[b[:-1]]) | (doc[1:] != doc[:-1])
    closes[-1] = True
    last = np.flatnonzero(closes)
    first = np.concatenate(([0], last[:-1] + 1))
    return a[first], b[last], doc[first], last - first + 1


def runs(texts: Texts, both_ends: bool = False):
    """Hash, first sentence and end sentence (within the document) and document of every run."""
    a, b, doc, words = sentences(texts)
    n = len(a)
    total = np.concatenate(([0], np.cumsum(words)))
    start = np.arange(n)
    # The end of the run from each sentence: by words alone, or by sentences and words.
    by_words = np.searchsorted(total, total[:-1] + ENOUGH_WORDS)
    by_both = np.maximum(np.searchsorted(total, total[:-1] + WORDS), start + SENTENCES)
    end = np.minimum(by_words, by_both)
    edges = np.searchsorted(doc, np.arange(len(texts) + 1))
    limit = edges[doc + 1]
    whole = end <= limit
    head = start == edges[doc]
    end = np.where(whole, end, limit)
    keep = whole | head
    begins, ends = start[keep], end[keep]
    if both_ends:
        # The begin of the run up to each sentence; those that are no run from their first sentence are added.
        by_words = np.searchsorted(total, total[1:] - ENOUGH_WORDS, side="right") - 1
        by_both = np.minimum(np.searchsorted(total, total[1:] - WORDS, side="right") - 1, start + 1 - SENTENCES)
        begin = np.maximum(by_words, by_both)
        more = begin >= edges[doc]
        more &= end[np.where(more, begin, 0)] != start + 1
        begins, ends = np.concatenate((begins, begin[more])), np.concatenate((ends, start[more] + 1))
    start, end = begins, ends
    hashes = texts.range_hasher()(a, b)
    # A run's hash: sum of its sentences' hashes, each turned by its place in the run.
    turned = hashes * _odd_powers(n)
    sums = np.zeros(n + 1, _U)
    np.cumsum(turned, out=sums[1:])
    run = mix((sums[end] - sums[start]) * _odd_inverses(n)[start] + (end - start).astype(_U))
    base = edges[doc[start]]
    return run, start - base, end - base, doc[start]


_ODD = 0xC2B2AE3D27D4EB4F


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n + 1, base & (2**64 - 1), _U)
    out[0] = 1
    np.multiply.accumulate(out, out=out)
    return out


def _odd_powers(n: int) -> np.ndarray:
    return _powers(_ODD, n)[:n]


def _odd_inverses(n: int) -> np.ndarray:
    return _powers(pow(_ODD, -1, 1 << 64), n)


def repeated_runs(docs: DataFrame, both_ends: bool = False) -> DataFrame:
    """doc, th, start, stop of every run that has an earlier equal; `docs` has doc_id, th and text."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def rows(part: pa.RecordBatch) -> pa.RecordBatch | None:
        texts = Texts(part.column("text"))
        run, start, end, doc = runs(texts, both_ends)
        if not len(run):
            return None
        ids = part.column("doc_id")
        place = [np.asarray(ids.is_null())[doc], np.asarray(ids.fill_null(0))[doc], part.column("th").to_numpy()[doc], start]
        order = np.lexsort((*reversed(place), run))
        heads = group_starts(run[order])
        first = order[np.repeat(heads, np.diff(np.append(heads, len(run))))]     # of each row's run in this slice
        known = np.zeros(len(run), bool)
        for column in place:
            known[order] |= column[order] != column[first]
        # A row with an earlier equal in its slice is settled: it goes anywhere, so a very frequent run is no hot key.
        run = np.where(known, mix(run + np.arange(1, len(run) + 1, dtype=_U)), run)
        at = pa.array(doc)
        return pa.record_batch([signed(run), ids.take(at), part.column("th").take(at), start.astype(np.int32),
                                end.astype(np.int32), pa.array(known)],
                               names=["run", "doc_id", "th", "start", "stop", "known"])

    def later(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = None                        # run and place of the first row of the open group
        for batch in batches:
            if not batch.num_rows:
                continue
            run = batch.column("run").to_numpy()
            place = [np.asarray(batch.column("doc_id").is_null()), np.asarray(batch.column("doc_id").fill_null(0)),
                     batch.column("th").to_numpy(), batch.column("start").to_numpy()]
            heads = np.ones(len(run), bool)
            heads[1:] = run[1:] != run[:-1]
            if before is not None and before[0] == run[0]:
                heads[0] = False
            index = np.maximum.accumulate(np.where(heads, np.arange(len(run)), -1))
            first = np.zeros(len(run), bool)
            known = index >= 0
            equal = known.copy()
            for column in place:
                equal &= column == column[np.maximum(index, 0)]
            first |= equal
            if not known.all():              # rows that go on with the group of the batch before
                same = ~known
                for column, value in zip(place, before[1]):
                    same &= column == value
                first |= same
            if index[-1] >= 0:
                before = (run[-1], [column[index[-1]] for column in place])
            out = batch.filter(pa.array(~first | np.asarray(batch.column("known"))))
            if out.num_rows:
                yield out.select(["doc_id", "th", "start", "stop"])

    found = map_slices(docs, rows, f"run long, doc_id {kind}, th long, start int, stop int, known boolean")
    return found.repartition("run").sortWithinPartitions(
        "run", F.col("doc_id").asc_nulls_last(), "th", "start").mapInArrow(
        later, f"doc_id {kind}, th long, start int, stop int")


def without_repeats(docs: DataFrame, both_ends: bool = False) -> DataFrame:
    """The documents with repeated sentences taken out of `text`, and the columns n_sentences and n_removed."""
    columns = docs.columns
    base = docs.withColumn("__th", F.xxhash64(F.coalesce("text", F.lit(""))))
    spans = repeated_runs(base.select("doc_id", F.col("__th").alias("th"), "text"), both_ends).groupBy(
        F.col("doc_id").alias("__doc"), F.col("th").alias("__of")).agg(
        F.collect_set(F.shiftleft(F.col("start").cast("long"), 32) + F.col("stop")).alias("__spans"))
    joined = base.join(spans, (F.col("__th") == F.col("__of")) & F.col("doc_id").eqNullSafe(F.col("__doc")), "left").select(
        *columns, "__spans")

    def cut(part: pa.RecordBatch) -> pa.RecordBatch:
        texts = Texts(part.column("text"))
        a, _, doc, _ = sentences(texts)
        edges = np.searchsorted(doc, np.arange(len(texts) + 1))
        lists = part.column("__spans")
        valid = np.asarray(lists.is_valid())
        offsets, values = lists.offsets.to_numpy(), lists.values.to_numpy(zero_copy_only=False)
        old = part.column("text").to_pylist()
        gone = np.zeros(len(texts), np.int64)
        new = list(old)
        for k in np.flatnonzero(valid & (np.diff(offsets) > 0)):
            n = edges[k + 1] - edges[k]
            covered = np.zeros(n + 1, np.int64)
            spans_ = values[offsets[k]:offsets[k + 1]]
            np.add.at(covered, spans_ >> 32, 1)
            np.add.at(covered, spans_ & 0xFFFFFFFF, -1)
            out = np.cumsum(covered)[:n] > 0
            gone[k] = out.sum()
            # A sentence goes with the space up to the next one.
            begins = a[edges[k]:edges[k + 1]]
            stops = np.append(begins[1:], texts.ends[k])
            raw = [texts.data[texts.starts[k]:begins[0]]] + [texts.data[x:y] for x, y, o in zip(begins, stops, out) if not o]
            new[k] = np.concatenate(raw).tobytes().decode()
        named = {"text": pa.array(new, pa.string())}
        return pa.record_batch([*(named.get(c, part.column(c)) for c in columns), pa.array(np.diff(edges)), pa.array(gone)],
                               names=[*columns, "__n", "__gone"])

    from pyspark.sql.types import LongType, StructField, StructType
    schema = StructType([*docs.schema.fields, StructField("__n", LongType()), StructField("__gone", LongType())])
    return map_slices(joined, cut, schema).withColumnsRenamed({"__n": "n_sentences", "__gone": "n_removed"})
