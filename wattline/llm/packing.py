"""Operator 7: pack token pieces into as few sequences as possible by local search.

Documents become token ids; one longer than a sequence is cut into whole
sequences, its shorter rest first. Only the lengths matter to a packing, and
there are at most `capacity` of them, so the search works on the histogram of
lengths, whose size does not depend on the corpus: bins are kept as patterns
(a multiset of lengths) with a multiplicity. Starting from best fit by
decreasing length, underfull patterns trade pieces pairwise: one for one, two
for one, or a move. A trade is taken if it raises the sum of squared fills; it
is applied to as many pairs of bins at once as both patterns have. Fills drift
apart, the emptiest bins run empty and vanish. The number of bins never rises.

The patterns give every length a list of places; pieces of that length take
them in the order of a distributed numbering, so the assignment is one join
on the length with a table of at most some thousand rows.

Defined cases: a null text is empty (its closing id only); an empty table
packs into nothing; repeated rows are packed each for itself; other columns
are left alone.
"""

from __future__ import annotations

import base64
import json
import zlib
from bisect import bisect_right, insort
from collections import Counter
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from wattline.llm.common import map_slices, save

CAPACITY = 1024
CLOSING_ID = 2


# --- the packing of a histogram -------------------------------------------------

def best_fit(counts: dict[int, int], capacity: int) -> Counter:
    """Patterns (sorted tuples of lengths) with multiplicities, by best fit decreasing on whole classes."""
    open_: dict[int, Counter] = {}       # room left -> patterns
    rooms: list[int] = []
    done: Counter = Counter()

    def put(pattern: tuple, room: int, n: int) -> None:
        if not room:
            done[pattern] += n
            return
        if room not in open_:
            open_[room] = Counter()
            insort(rooms, room)
        open_[room][pattern] += n

    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            at = bisect_right(rooms, length - 1)
            if at < len(rooms):
                room = rooms[at]
                pattern, have = next(iter(open_[room].items()))
                n = min(have, left)
                open_[room][pattern] -= n
                if not open_[room][pattern]:
                    del open_[room][pattern]
                if not open_[room]:
                    del open_[room]
                    rooms.pop(at)
                put(tuple(sorted((*pattern, length), reverse=True)), room - length, n)
            else:
                per = capacity // length
                if left >= per:
                    put((length,) * per, capacity - per * length, left // per)
                    left %= per
                    n = 0
                else:
                    put((length,) * left, capacity - left * length, 1)
                    n = left
            left -= n
    for patterns in open_.values():
        done.update(patterns)
    return done


@lru_cache(maxsize=4096)
def _pairs(pattern: tuple) -> list[tuple[int, int, int]]:
    """Sum, larger and smaller length of every two pieces: few, as a bin holds few distinct lengths."""
    lengths = Counter(pattern)
    ordered = sorted(lengths, reverse=True)
    return sorted([(p + q, p, q) for i, p in enumerate(ordered) for q in ordered[i + 1:]]
                  + [(p + p, p, p) for p, n in lengths.items() if n > 1])


def _trade(a: tuple, b: tuple, capacity: int) -> tuple[tuple, tuple] | None:
    """The trade between two bins that raises the sum of squared fills most, if any.

    The fuller bin `a` gains: a move from b, one of b for a smaller one of a,
    two of b for one of a, or one of b for two of a. With a at least as full
    as b, any gain of a raises the sum.
    """
    room = capacity - sum(a)
    ones = sorted(set(b))
    best, gain = None, 0
    for y in ones:
        if gain < y <= room:
            best, gain = ((), (y,)), y
    mine = sorted(set(a))
    for x in mine:
        at = bisect_right(ones, x + room) - 1
        if at >= 0 and ones[at] - x > gain:
            best, gain = ((x,), (ones[at],)), ones[at] - x
    if gain < room:
        twos = _pairs(b)
        for x in mine:
            at = bisect_right(twos, (x + room, capacity + 1, 0)) - 1
            if at >= 0 and twos[at][0] - x > gain:
                best, gain = ((x,), twos[at][1:]), twos[at][0] - x
        for total, p, q in _pairs(a):
            at = bisect_right(ones, total + room) - 1
            if at >= 0 and ones[at] - total > gain:
                best, gain = ((p, q), (ones[at],)), ones[at] - total
    if best is None:
        return None
    gone, come = best
    new_a, new_b = list(a), list(b)
    for x in gone:
        new_a.remove(x)
        new_b.append(x)
    for y in come:
        new_b.remove(y)
        new_a.append(y)
    return tuple(sorted(new_a, reverse=True)), tuple(sorted(new_b, reverse=True))


def local_search(patterns: Counter, capacity: int) -> Counter:
    """Trade pieces between underfull bins until no trade helps: every trade raises a bounded sum, so it ends."""
    full = Counter({p: n for p, n in patterns.items() if sum(p) == capacity})
    under = Counter({p: n for p, n in patterns.items() if sum(p) < capacity})
    changed = True
    while changed:
        changed = False
        for b in sorted(under, key=lambda p: (sum(p), p)):            # the emptiest give
            for a in sorted(under, key=lambda p: (-sum(p), p)):       # the fullest take
                if not under[b]:
                    break
                if not under[a] or sum(a) < sum(b) or a == b and under[a] < 2:
                    continue
                traded = _trade(a, b, capacity)
                if traded is None:
                    continue
                n = under[a] // 2 if a == b else min(under[a], under[b])
                for p in (a, b):
                    under[p] -= n
                for p in traded:
                    if p:
                        (full if sum(p) == capacity else under)[p] += n
                changed = True
        under = +under
    return full + under


def pack(counts: dict[int, int], capacity: int = CAPACITY) -> Counter:
    return local_search(best_fit(counts, capacity), capacity)


# --- tokens ---------------------------------------------------------------------

@lru_cache(maxsize=4)
def _encoder(ranks_file: str, added_tokens: bool = False):
    """The vocabulary's merges as ranks: the ids that its tokenizer file gives, at several times the speed.

    With `added_tokens` the added tokens of the tokenizer file beside the ranks
    are matched inside texts, as its plain call does; else they are text.
    """
    import tiktoken
    from public_tokenizers import PATTERN

    with open(ranks_file, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    special = {}
    if added_tokens:
        with open(ranks_file.removesuffix(".tiktoken") + ".json", encoding="utf-8") as file:
            for token in json.load(file)["added_tokens"]:
                if token["single_word"] or token["lstrip"] or token["rstrip"]:
                    raise ValueError(f"added token {token['content']!r} is not matched as plain text")
                special[token["content"]] = token["id"]
    return tiktoken.Encoding("packing", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special)


def vocabulary_file() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def pieces(docs: DataFrame, capacity: int = CAPACITY, vocabulary: str | None = None,
           keep_ids: bool = False, added_tokens: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 (and ids, as little-endian 32-bit numbers) of every piece."""
    def rows(part: pa.RecordBatch) -> pa.RecordBatch:
        encoder = _encoder(vocabulary or vocabulary_file(), added_tokens)
        owner, number, start, length, crc, raw = [], [], [], [], [], []
        for k, text in enumerate(part.column("text").to_pylist()):
            ids = encoder.encode_to_numpy(text or "", allowed_special="all", disallowed_special=())
            ids = np.append(ids.astype("<u4"), np.uint32(CLOSING_ID))
            first = (len(ids) - 1) % capacity + 1
            for i, a in enumerate((0, *range(first, len(ids), capacity))):
                b = first if not i else a + capacity
                data = ids[a:b].tobytes()
                owner.append(k), number.append(i), start.append(a), length.append(b - a), crc.append(zlib.crc32(data))
                if keep_ids:
                    raw.append(data)
        columns = {"doc_id": part.column("doc_id").take(pa.array(owner, pa.int64())), "piece": pa.array(number, pa.int32()),
                   "start": pa.array(start, pa.int64()), "length": pa.array(length, pa.int64()),
                   "ids_crc32": pa.array(crc, pa.int64())}
        if keep_ids:
            columns["ids"] = pa.array(raw, pa.binary())
        return pa.record_batch(list(columns.values()), names=list(columns))

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_slices(docs.select("doc_id", "text"), rows, f"doc_id {kind}, piece int, start long, length long, "
                                                           "ids_crc32 long" + (", ids binary" if keep_ids else ""))


# --- places ---------------------------------------------------------------------

def places(patterns: Counter) -> list[tuple[int, int, int, int, int, int]]:
    """For every length, runs of places: length, first and last + 1 place, first sequence, places of a sequence, offset.

    Equal pieces of a pattern lie next to each other: place p of a run belongs
    to sequence first + p // each, at offset + (p % each) * length.
    """
    used: Counter = Counter()
    out, sequence = [], 0
    for pattern in sorted(patterns, reverse=True):
        n, offset = patterns[pattern], 0
        for length, each in sorted(Counter(pattern).items(), reverse=True):
            out.append((length, used[length], used[length] + n * each, sequence, each, offset))
            used[length] += n * each
            offset += each * length
        sequence += n
    return out


def numbered(rows: DataFrame, buckets: int) -> DataFrame:
    """Adds `place`, from 0 without gaps within every length. Each length is split over buckets, so none is one task."""
    from pyspark.sql import Window

    dealt = rows.withColumn("__bucket", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(buckets)))
    counts = dealt.groupBy("length", "__bucket").agg(F.count("*").alias("__n"))
    before = counts.withColumn("__before", F.sum("__n").over(
        Window.partitionBy("length").orderBy("__bucket")) - F.col("__n")).drop("__n")
    within = F.row_number().over(Window.partitionBy("length", "__bucket").orderBy("doc_id", "start", "ids_crc32"))
    return dealt.withColumn("__row", within).join(before, ["length", "__bucket"]).withColumn(
        "place", F.col("__before") + F.col("__row") - 1).drop("__before", "__row", "__bucket")


def assign(spark: SparkSession, rows: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Adds sequence_id and offset to pieces (saved rows with doc_id, start, length, ids_crc32)."""
    # At most `capacity` rows: the histogram of lengths.
    counts = {r["length"]: r["n"] for r in rows.groupBy("length").agg(F.count("*").alias("n")).collect()}
    runs = places(pack(counts, capacity))
    starts: dict[int, list] = {}
    for run in runs:
        starts.setdefault(run[0], []).append(run[1:])
    tables = {length: np.array(sorted(found), np.int64) for length, found in starts.items()}

    def place(batches):
        for batch in batches:
            length, at = batch.column("length").to_numpy(), batch.column("place").to_numpy()
            sequence, offset = np.empty(len(at), np.int64), np.empty(len(at), np.int64)
            order = np.argsort(length, kind="stable")
            edges = np.flatnonzero(np.diff(length[order], prepend=-1))
            for x, y in zip(edges, np.append(edges[1:], len(order))):
                rows_ = order[x:y]
                run = tables[int(length[rows_[0]])]
                run = run[np.searchsorted(run[:, 0], at[rows_], side="right") - 1]
                rank = at[rows_] - run[:, 0]
                sequence[rows_] = run[:, 2] + rank // run[:, 3]
                offset[rows_] = run[:, 4] + rank % run[:, 3] * length[rows_]
            keep = [c for c in batch.schema.names if c != "place"]
            yield pa.record_batch([*(batch.column(c) for c in keep), sequence, offset],
                                  names=[*keep, "sequence_id", "offset"])

    buckets = 8 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    found = numbered(rows, buckets)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in found.schema if f.name != "place")
    return found.mapInArrow(place, f"{fields}, sequence_id long, offset long")


def packed(spark: SparkSession, docs: DataFrame, capacity: int = CAPACITY, vocabulary: str | None = None,
           keep_ids: bool = False, added_tokens: bool = False) -> DataFrame:
    """Every piece with its sequence and offset."""
    rows = save(pieces(docs, capacity, vocabulary, keep_ids, added_tokens))
    return assign(spark, rows, capacity).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset", *(["ids"] if keep_ids else []))
