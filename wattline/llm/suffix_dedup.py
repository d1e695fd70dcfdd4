"""Operator 2: remove every byte covered by a long string that occurs anywhere else.

A string of `least` bytes is repeated if it starts at two places of the corpus
(the same document included). To bring equal strings together without moving
texts, every window of `least` bytes is filed under the smallest hash among
its shorter grams (its anchor); neighbouring windows with one anchor form a
segment. Equal windows have equal anchors, so only segments under a shared
anchor can hold repeated strings; all others leave at once. Segments are
collapsed by content with their count. Those whose anchor has one content
only are repeated as a whole; the contents under one anchor that differ are
laid side by side in blocks of some megabytes, and interval expansion on the
block's Burrows-Wheeler transform (`bwt.repeated_starts`) finds what repeats.

The contents of an anchor with more than `hot` of them are cut again by longer
grams, down to single windows, so that no group outgrows a task.

Defined cases: a null text counts as empty; a text shorter than `least`
loses nothing; repeated rows are occurrences of each other and lose
everything from `least` bytes on; doc_id may be null or repeated (texts are
told apart by content); other columns are left alone; an empty table gives
an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from wattline.llm.bwt import repeated_starts
from wattline.llm.common import map_slices, save
from wattline.llm.textbytes import Texts, group_starts, mix, signed

LEAST = 200
HOT = 4096               # contents under one anchor (about 1 MB) before it is cut again
BLOCK_BYTES = 1 << 20
_LONGEST_RUN = 4096      # windows in a segment
_CHUNK = 8 << 20         # windows looked at together
_PLACE = (1 << 24) - 1

_U = np.uint64


def gram_lengths(least: int) -> list[int]:
    return sorted({max(1, least * k // 25) for k in (8, 16, 22)} | {least})


def _lowest(values: np.ndarray, width: int) -> np.ndarray:
    """Position of the smallest of every `width` neighbouring values (the leftmost by their upper 40 bits)."""
    out = []
    for at in range(0, len(values) - width + 1, _CHUNK):
        part = values[at:at + _CHUNK + width - 1]
        n = len(part)
        part = (part & ~_U(_PLACE)) | np.arange(n, dtype=_U)
        rows = np.concatenate((part, np.full(-n % width, ~_U(0), _U))).reshape(-1, width)
        ahead = np.minimum.accumulate(rows, axis=1).ravel()
        back = np.ascontiguousarray(np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1]).ravel()
        low = np.minimum(back[:n - width + 1], ahead[width - 1:n])
        out.append((low & _U(_PLACE)).astype(np.int64) + at)
    return np.concatenate(out)


def _segments(texts: Texts, gram: int, least: int):
    """Anchor, first byte, end and document of every run of windows with one anchor, and a range hasher.

    A run in which the anchor occurs twice (text with a period) is split at
    its first change of place, so that its own repeats come under a shared anchor.
    """
    hasher = texts.range_hasher()
    n = len(texts.data)
    whole = texts.ends - texts.starts >= least
    if not whole.any():
        return None
    at = np.arange(n - gram + 1)
    grams = hasher(at, at + gram)
    low = _lowest(grams, least - gram + 1)
    counts = (texts.ends - texts.starts - least + 1)[whole]
    docs = np.repeat(np.flatnonzero(whole), counts)
    offset = np.arange(len(docs)) - np.repeat(np.cumsum(counts) - counts, counts)
    first = texts.starts[docs] + offset
    place = low[first]
    moves = group_starts(place, docs, offset // _LONGEST_RUN)       # few: one for each anchor
    key = grams[place[moves]]
    runs = group_starts(key, docs[moves], offset[moves] // _LONGEST_RUN)
    second = runs + 1
    second = second[second < np.append(runs[1:], len(moves))]
    heads = moves[np.sort(np.concatenate((runs, second)))]
    tails = np.append(heads[1:], len(docs)) - 1
    return grams[place[heads]], first[heads], first[tails] + least, docs[heads], hasher


_ROWS = "anchor long, seg long, key long, doc_id long, start long, size long"


def _cut(docs: DataFrame, gram: int, least: int) -> DataFrame:
    def cut(part: pa.RecordBatch) -> pa.RecordBatch | None:
        texts = Texts(part.column("text"))
        found = _segments(texts, gram, least)
        if found is None:
            return None
        anchor, a, b, doc, hasher = found
        doc = pa.array(doc)
        return pa.record_batch([
            signed(anchor), signed(hasher(a, b)), part.column("key").take(doc), part.column("doc_id").take(doc),
            a - texts.starts[doc], b - a], names=["anchor", "seg", "key", "doc_id", "start", "size"])

    return map_slices(docs.select("key", "doc_id", "text"), cut, _ROWS)


def shared(rows: DataFrame, key: str = "anchor") -> DataFrame:
    """Rows whose key occurs in another row too: one shuffle, one neighbouring row of memory."""
    names = rows.columns

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            now = pa.Table.from_batches([batch])
            if held is not None:
                now = pa.concat_tables([held, now])
            value = now.column(key).to_numpy()
            same = value[1:] == value[:-1]
            again = np.zeros(len(value), bool)
            again[1:] = same
            again[:-1] |= same
            if held is not None:      # the held row was judged by its left neighbour only
                again[0] |= held_again
            yield from now.slice(0, len(value) - 1).filter(pa.array(again[:-1])).to_batches()
            held, held_again = now.slice(len(value) - 1), bool(again[-1])
        if held is not None and held_again:
            yield from held.to_batches()

    return rows.repartition(key).sortWithinPartitions(key).mapInArrow(keep, rows.schema).select(*names)


def _take_ranges(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """anchor, seg, n and the bytes of each row's range."""
    wanted = rows.groupBy("key", F.col("doc_id").alias("id")).agg(
        F.collect_list(F.struct("anchor", "seg", "n", "start", "size")).alias("ranges"))
    texts = docs.join(wanted, (docs["key"] == wanted["key"]) & docs["doc_id"].eqNullSafe(wanted["id"])).select(
        docs["text"], "ranges")

    def take(part: pa.RecordBatch) -> pa.RecordBatch | None:
        texts = Texts(part.column("text"))
        lists = part.column("ranges")
        doc = np.repeat(np.arange(part.num_rows), np.diff(lists.offsets.to_numpy()))
        anchor, seg, n, start, size = (x.to_numpy() for x in lists.flatten().flatten())
        a = texts.starts[doc] + start
        raw = texts.data.tobytes()
        return pa.record_batch([
            pa.array(anchor), pa.array(seg), pa.array(n),
            pa.array([raw[x:y] for x, y in zip(a, a + size)], pa.binary())], names=["anchor", "seg", "n", "bytes"])

    return map_slices(texts, take, "anchor long, seg long, n long, bytes binary")


def _bytes_of(column: pa.Array) -> Texts:
    """A binary column as Texts (its cast to text would check the encoding)."""
    texts = Texts.__new__(Texts)
    column = column.cast(pa.large_binary())
    bounds = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    texts.data = (np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8))[bounds[0]:bounds[-1]]
    texts.starts, texts.ends = bounds[:-1] - bounds[0], bounds[1:] - bounds[0]
    return texts


def _cut_again(pieces: DataFrame, gram: int, least: int) -> DataFrame:
    """Contents of hot anchors cut by a longer gram; the new anchor includes the old one."""
    def cut(part: pa.RecordBatch) -> pa.RecordBatch | None:
        texts = _bytes_of(part.column("bytes"))
        found = _segments(texts, gram, least)
        if found is None:
            return None
        anchor, a, b, doc, hasher = found
        old = part.column("anchor").to_numpy().view(_U)[doc]
        raw = texts.data.tobytes()
        return pa.record_batch([
            signed(mix(old + _U(gram)) ^ anchor), signed(hasher(a, b)), part.column("anchor").take(pa.array(doc)),
            part.column("seg").take(pa.array(doc)), a - texts.starts[doc],
            pa.array([raw[x:y] for x, y in zip(a, b)], pa.binary())],
            names=["anchor", "seg", "of_anchor", "of_seg", "at", "bytes"])

    return map_slices(pieces, cut, "anchor long, seg long, of_anchor long, of_seg long, at long, bytes binary", "bytes")


def _whole(contents: DataFrame) -> DataFrame:
    """Contents that occur more than once repeat from end to end."""
    return contents.filter("m > 1").select("anchor", "seg", F.lit(0).cast("long").alias("a"), F.col("size").alias("b"))


def _resolve(pieces: DataFrame, grams: list[int], least: int, hot: int) -> DataFrame:
    """Ranges (anchor, seg, a, b) of contents that also occur in another content of the anchor, or again in their own."""
    # Under whole windows the contents of an anchor are runs of one window: few, of different lengths.
    small = pieces.filter(F.col("n") <= hot) if grams else pieces
    found = small.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(
        _expand(least), "anchor long, seg long, a long, b long")
    crowded = pieces.filter(F.col("n") > hot)
    if not grams or crowded.isEmpty():
        return found
    cut = save(_cut_again(crowded, grams[0], least))
    contents = cut.groupBy("anchor", "seg").agg(F.count("*").alias("m"), F.first("bytes").alias("bytes"))
    contents = save(contents.withColumn("size", F.length("bytes").cast("long")))
    inner = _resolve(save(_counted(contents).filter("n > 1").select("anchor", "seg", "n", "bytes")), grams[1:], least, hot)
    return found.unionByName(cut.join(_whole(contents).unionByName(inner), ["anchor", "seg"]).select(
        F.col("of_anchor").alias("anchor"), F.col("of_seg").alias("seg"),
        (F.col("a") + F.col("at")).alias("a"), (F.col("b") + F.col("at")).alias("b")))


def _counted(contents: DataFrame) -> DataFrame:
    """With the number n of contents under the anchor."""
    return contents.join(contents.groupBy("anchor").agg(F.count("*").alias("n")), "anchor")


def _expand(least: int):
    """Blocks of whole anchor groups -> repeated ranges of each content."""
    def block(parts: list[pa.Table]) -> Iterator[pa.RecordBatch]:
        now = pa.concat_tables(parts).combine_chunks()
        texts = _bytes_of(now.column("bytes").combine_chunks() if now.num_rows else pa.array([], pa.binary()))
        marks = repeated_starts(texts.data, texts.starts, texts.ends, least)
        at = np.flatnonzero(marks)
        if not len(at):
            return
        seg = texts.doc_of(at)
        far = np.ones(len(at), bool)
        far[1:] = (seg[1:] != seg[:-1]) | (at[1:] - at[:-1] > least)
        heads = np.flatnonzero(far)
        tails = np.append(heads[1:], len(at)) - 1
        seg = seg[heads]
        base = texts.starts[seg]
        yield pa.RecordBatch.from_arrays([
            now.column("anchor").to_numpy()[seg], now.column("seg").to_numpy()[seg],
            at[heads] - base, at[tails] + least - base], names=["anchor", "seg", "a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(pa.Table.from_batches([batch]))
            if sum(x.column("bytes").nbytes for x in held) < BLOCK_BYTES:
                continue
            now = pa.concat_tables(held)
            anchors = now.column("anchor").to_numpy()
            heads = group_starts(anchors)
            sizes = np.cumsum(pc.binary_length(now.column("bytes")).to_numpy())
            last = int(heads[-1])          # the last group may go on in the next batch
            at = 0
            while at < last:
                limit = (sizes[at - 1] if at else 0) + BLOCK_BYTES
                to = heads[heads <= max(int(np.searchsorted(sizes, limit)), at + 1)][-1]
                to = int(to) if to > at else int(heads[heads > at][0])
                to = min(to, last)
                yield from block([now.slice(at, to - at)])
                at = to
            held = [now.slice(last)]
        if held:
            yield from block(held)

    return run


def repeated_ranges(docs: DataFrame, least: int = LEAST, hot: int = HOT) -> DataFrame:
    """Repeated ranges (key, ranges: array of start * 2**32 + end, unordered) of each text.

    `docs` has key (hash of the text), doc_id and text.
    """
    grams = gram_lengths(least)
    rows = save(shared(_cut(docs, grams[0], least)))
    contents = save(rows.groupBy("anchor", "seg").agg(
        F.count("*").alias("m"), F.first("key").alias("key"), F.first("doc_id").alias("doc_id"),
        F.first("start").alias("start"), F.first("size").alias("size")))
    pieces = save(_take_ranges(docs, _counted(contents).filter("n > 1")))
    ranges = rows.select("anchor", "seg", "key", "start").join(
        _whole(contents).unionByName(_resolve(pieces, grams[1:], least, hot)), ["anchor", "seg"])
    return ranges.groupBy("key").agg(F.collect_set(
        F.shiftleft(F.col("start") + F.col("a"), 32) + F.col("start") + F.col("b")).alias("ranges"))


def _merged(packed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union of ranges as maximal runs."""
    packed = np.sort(packed)
    a, b = packed >> 32, np.maximum.accumulate(packed & 0xFFFFFFFF)
    new = np.ones(len(a), bool)
    new[1:] = a[1:] > b[:-1]
    heads = np.flatnonzero(new)
    return a[heads], b[np.append(heads[1:], len(a)) - 1]


def _kept(part: pa.RecordBatch) -> Iterator[tuple[bytes, int, int, int]]:
    """Remaining bytes, length, bytes removed and number of runs of each row."""
    texts = Texts(part.column("text"))
    lists = part.column("__ranges")
    offsets, packed = lists.offsets.to_numpy(), lists.values.to_numpy(zero_copy_only=False)
    valid = lists.is_valid().to_numpy(zero_copy_only=False)
    for k in range(part.num_rows):
        raw = texts.data[texts.starts[k]:texts.ends[k]].tobytes()
        if not valid[k] or offsets[k] == offsets[k + 1]:
            yield raw, len(raw), 0, 0
            continue
        a, b = _merged(packed[offsets[k]:offsets[k + 1]])
        edges = zip([0, *b.tolist()], [*a.tolist(), len(raw)])
        yield b"".join(raw[x:y] for x, y in edges), len(raw), int((b - a).sum()), len(a)


def _with_ranges(docs: DataFrame, least: int, hot: int) -> DataFrame:
    keyed = docs.withColumn("__key", F.xxhash64(F.coalesce("text", F.lit(""))))
    ranges = repeated_ranges(keyed.select(F.col("__key").alias("key"), F.col("doc_id").cast("long"), "text"), least, hot)
    return keyed.join(ranges.select(F.col("key").alias("__key"), F.col("ranges").alias("__ranges")), "__key", "left")


def removal_report(docs: DataFrame, least: int = LEAST, hot: int = HOT) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every document."""
    def report(part: pa.RecordBatch) -> pa.RecordBatch:
        rows = [(n, gone, spans, hashlib.sha256(raw).hexdigest()) for raw, n, gone, spans in _kept(part)]
        return pa.record_batch([part.column("doc_id"), *(pa.array(x) for x in zip(*rows))],
                               names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    marked = _with_ranges(docs.select("doc_id", "text"), least, hot).select("doc_id", "text", "__ranges")
    return map_slices(marked, report, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_bytes long, "
                                      "n_removed long, n_spans long, kept_sha256 string")


def remove_repeats(docs: DataFrame, least: int = LEAST, hot: int = HOT) -> DataFrame:
    """The documents with repeated bytes taken out of `text` (a character cut in two goes) and n_chars adjusted."""
    columns = docs.columns

    def cut(part: pa.RecordBatch) -> pa.RecordBatch:
        texts = [raw.decode("utf-8", "ignore") if spans else None for raw, _, _, spans in _kept(part)]
        old = part.column("text")
        new = pa.array([was if t is None else t for t, was in zip(texts, old.to_pylist())], pa.string())
        arrays = [new if c == "text" else part.column(c) for c in columns]
        return pa.record_batch(arrays, names=columns)

    out = map_slices(_with_ranges(docs, least, hot).select(*columns, "__ranges"), cut, docs.schema)
    if "n_chars" in columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(
            F.length("text").cast(kind)))
    return out
