"""Operator 9: exact Jaccard join of five-word shingle sets, as connected groups.

Two texts link when 100 * |common shingles| >= 80 * |all their shingles|. The
join leans on relations between sets, so that no group emits all its pairs:

* Equal sets collapse to one, named by a 64-bit hash of the set.
* Index-level skipping: every set is filed under the first shingles of a
  global order (shingles in few texts first). A list is kept only if it joins
  sets that are not yet known to be connected; inside a list sets stand by
  size, so the partners of a set are one block, left as soon as the size
  bound fails, and entries whose positions leave too few shingles are skipped.
  Every entry carries the parity of its set's shingles in 256 classes: two
  sets differ in at least as many shingles as these bits, so a pair that
  differs in too many is no link and is left before anything is emitted.
  Lists of more than LIST sets are cut in chunks; pairs of chunks go to tasks.
  Before whole lists are looked at, some turns compare only neighbours among a
  list's connected groups, which connects what links to most others.
* Answer-level skipping: a set that resembles a leader (found by min-hash
  bands, verified exactly) takes over the leader's answers. Jaccard distance
  obeys the triangle inequality: with distances r(y) and r(z) to the leaders
  h and g, y and z can link only if d(h, g) <= 0.2 + r(y) + r(z). So only
  leaders are compared; members are compared where that bound leaves the
  answer open, after one comparison of each with the other leader narrows it.
* Before two sets are compared, the numbers of their shingles in 256 classes
  bound what they can have in common; contents are read from the texts only
  for pairs that pass.

Every link between different texts is thus either verified, implied by the
bound to be impossible, or inside a group already connected by verified links.

Defined cases: a null or wordless text has no shingle, links with nothing and
is its own group; one to four words are one shingle; equal sets (repeated
rows, texts that differ in space or case of A-Z) link; doc_id may repeat or
be null (a group's id is its smallest non-null doc_id); other columns are
left alone; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from wattline.llm.common import components, map_slices, save, save_bucketed
from wattline.llm.textbytes import Texts, group_starts, mix, signed, slices, windows

WIDTH = 5
FREQUENT = 262_144       # shingles whose order follows their frequency; the others follow their hash
WINDOW_BYTES = 16 << 20  # text over which a task counts before it reports what it saw three times or more
BANDS, ROWS_PER_BAND = 4, 3
BUCKETS = 256            # classes of shingles counted for each set
PARITIES = 256           # classes of shingles of which only the parity is kept
LIST = 1024              # sets of a list that a task holds twice
TURNS, FEW = 3, 64       # turns of neighbours looked at before whole lists, ended early after few links
CHUNK = 512              # sets compared with one copy of a leader
FAR = 0.2                # largest distance of a link
_SLACK = 1e-9            # keeps rounding from skipping a pair

_U = np.uint64


def shingle_sets(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """Document and hash of each distinct shingle, by document and hash."""
    a, b, doc = texts.words()
    words = texts.range_hasher(lower=True)(a, b)
    hashes, first = windows(words, doc, WIDTH)
    found, docs = [hashes], [doc[first]]
    counts = np.bincount(doc, minlength=len(texts))
    for few in range(1, WIDTH):
        whole, at = windows(words, doc, few)
        only = counts[doc[at]] == few
        found.append(mix(whole[only] + _U(few)))
        docs.append(doc[at[only]])
    hashes, docs = np.concatenate(found), np.concatenate(docs)
    order = np.argsort(hashes)
    # Numbers of 16 bits are sorted by counting.
    by_doc = docs[order].astype(np.uint16) if len(texts) <= 1 << 16 else docs[order]
    order = order[np.argsort(by_doc, kind="stable")]
    hashes, docs = hashes[order], docs[order]
    heads = group_starts(docs, hashes)
    return docs[heads], hashes[heads]


def _set_keys(doc: np.ndarray, hashes: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Size and 64-bit name of each document's set."""
    sizes = np.bincount(doc, minlength=n)
    sums = np.zeros(len(hashes) + 1, _U)
    np.cumsum(mix(hashes ^ _U(0x5851F42D4C957F2D)), out=sums[1:])
    edges = np.concatenate(([0], np.cumsum(sizes)))
    return sizes, mix(sums[edges[1:]] - sums[edges[:-1]] + sizes.astype(_U))


def parities(doc: np.ndarray, hashes: np.ndarray, n: int) -> np.ndarray:
    """PARITIES bits of each document's set: whether an odd number of its shingles is in a class (rows of words)."""
    bit = (mix(hashes ^ _U(0x2127599BF4325C37)) >> _U(20)).astype(np.int64) % PARITIES
    out = np.zeros(n * (PARITIES // 64), _U)
    np.bitwise_xor.at(out, doc * (PARITIES // 64) + bit // 64, _U(1) << (bit % 64).astype(_U))
    return out.reshape(n, -1)


def _profiles(texts: Texts) -> tuple[np.ndarray, np.ndarray, list[np.ndarray], list[bytes], np.ndarray]:
    """Set sizes, set names, min-hash bands, how many shingles fall into each of BUCKETS classes of hashes, and parities."""
    doc, hashes = shingle_sets(texts)
    sizes, keys = _set_keys(doc, hashes, len(texts))
    filled = np.flatnonzero(sizes)
    edges = np.concatenate(([0], np.cumsum(sizes)))
    bands = []
    for band in range(BANDS):
        value = np.zeros(len(texts), _U)
        for row in range(ROWS_PER_BAND):
            salt = mix(np.array([band * ROWS_PER_BAND + row + 1], _U))
            if len(filled):
                value[filled] = mix(value[filled] ^ np.minimum.reduceat(mix(hashes ^ salt), edges[filled]))
        bands.append(value)
    counts = np.bincount(doc * BUCKETS + (hashes >> _U(40)).astype(np.int64) % BUCKETS,
                         minlength=len(texts) * BUCKETS).reshape(len(texts), BUCKETS)
    packed = [row.astype(np.uint8 if row.max(initial=0) < 256 else np.uint32).tobytes() for row in counts]
    return sizes, keys, bands, packed, parities(doc, hashes, len(texts))


def _sets(docs: DataFrame) -> DataFrame:
    """doc_id, text hash, set size, set name, bands, class counts and parities of every row."""
    def rows(part: pa.RecordBatch) -> pa.RecordBatch:
        sizes, keys, bands, counts, odd = _profiles(Texts(part.column("text")))
        return pa.record_batch([part.column("doc_id"), part.column("th"), pa.array(sizes), pa.array(signed(keys)),
                                pa.ListArray.from_arrays(pa.array(np.arange(len(sizes) + 1, dtype=np.int32) * len(bands)),
                                                         pa.array(signed(np.stack(bands, 1).ravel()))),
                                pa.array(counts, pa.binary()), pa.array([row.tobytes() for row in odd], pa.binary())],
                               names=["doc_id", "th", "n", "key", "bands", "counts", "odd"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_slices(docs.select("doc_id", "th", "text"), rows,
                      f"doc_id {kind}, th long, n long, key long, bands array<long>, counts binary, odd binary")


def _frequent(docs: DataFrame) -> np.ndarray:
    """Shingles in many texts, rarest first. Every text is counted; a shingle counts where a window of text
    holds it three times or more. Only the order of the join depends on this, never its result."""
    def report(found: list[np.ndarray]) -> pa.RecordBatch:
        values = np.concatenate(found)
        values.sort()
        heads = group_starts(values)
        counts = np.diff(np.append(heads, len(values)))
        many = counts > 2
        return pa.record_batch([signed(values[heads[many]]), counts[many]], names=["shingle", "n"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, size = [], 0
        for batch in batches:
            for part in slices(batch):
                texts = Texts(part.column("text"))
                found.append(shingle_sets(texts)[1])
                size += len(texts.data)
                if size >= WINDOW_BYTES:
                    yield report(found)
                    found, size = [], 0
        if found:
            yield report(found)

    # At most FREQUENT numbers come to the driver and go out with the tasks.
    top = docs.select("text").mapInArrow(count, "shingle long, n long").groupBy("shingle").agg(
        F.sum("n").alias("n")).orderBy(F.desc("n"), "shingle").limit(FREQUENT).select("shingle").toPandas()
    return top["shingle"].to_numpy(np.int64)[::-1].copy().view(_U)


def _prefixes(docs: DataFrame, frequent: np.ndarray) -> DataFrame:
    """Shingle, set, set size and position of every set's prefix under the global order."""
    by_hash = np.argsort(frequent)
    known = frequent[by_hash]

    def rows(part: pa.RecordBatch) -> pa.RecordBatch | None:
        texts = Texts(part.column("text"))
        doc, hashes = shingle_sets(texts)
        if not len(doc):
            return None
        sizes, keys = _set_keys(doc, hashes, len(texts))
        if len(known):
            at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
            late = np.where(known[at] == hashes, by_hash[at] + 1, 0)
            order = np.argsort(doc * np.int64(len(known) + 2) + late, kind="stable")
            hashes = hashes[order]
        edges = np.concatenate(([0], np.cumsum(sizes)))
        position = np.arange(len(doc)) - edges[doc]
        size = sizes[doc]
        inside = position < size - (4 * size + 4) // 5 + 1
        return pa.record_batch([signed(hashes[inside]), signed(keys[doc[inside]]), size[inside].astype(np.int32),
                                position[inside].astype(np.int32)], names=["token", "key", "n", "pos"])

    return map_slices(docs.select("text"), rows, "token long, key long, n int, pos int")


def _shared_lists(prefixes: DataFrame) -> DataFrame:
    """Prefix entries, one a set, of shingles that different sets hold; one held row of memory."""
    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            now = pa.Table.from_batches([batch])
            if held is not None:
                now = pa.concat_tables([held, now])
            token, key = now.column("token").to_numpy(), now.column("key").to_numpy()
            heads = group_starts(token, key)
            if not len(heads):
                continue
            token, now = token[heads], now.take(pa.array(heads))
            again = np.zeros(len(token), bool)
            again[1:] = token[1:] == token[:-1]
            again[:-1] |= again[1:]
            if held is not None:
                again[0] |= held_again
            yield from now.slice(0, len(token) - 1).filter(pa.array(again[:-1])).to_batches()
            held, held_again = now.slice(len(token) - 1), bool(again[-1])
        if held is not None and held_again:
            yield from held.to_batches()

    return prefixes.repartition("token").sortWithinPartitions("token", "key").mapInArrow(keep, prefixes.schema)


def _contents(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """Sorted shingles of the sets in `wanted` (key, doc_id, th; m: rows that are equal as a whole)."""
    def rows(part: pa.RecordBatch) -> pa.RecordBatch:
        texts = Texts(part.column("text"))
        doc, hashes = shingle_sets(texts)
        sizes, keys = _set_keys(doc, hashes, len(texts))
        edges = 8 * np.concatenate(([0], np.cumsum(sizes)))
        raw = hashes.tobytes()
        return pa.record_batch([pa.array(signed(keys)), pa.array(sizes), pa.array(
            [raw[x:y] for x, y in zip(edges, edges[1:])], pa.binary())], names=["key", "n", "shingles"])

    wanted = save(wanted.select(F.col("th").alias("__th"), F.col("doc_id").alias("__id"), "m"))
    match = (docs["th"] == F.col("__th")) & docs["doc_id"].eqNullSafe(F.col("__id"))
    schema = "key long, n long, shingles binary"
    single = map_slices(docs.join(wanted.filter("m = 1"), match, "left_semi").select("text"), rows, schema)
    again = wanted.filter("m > 1")
    if again.isEmpty():
        return single
    return single.unionByName(map_slices(docs.join(again, match, "left_semi").dropDuplicates(["doc_id", "th"]).select("text"),
                                         rows, schema))


def _count_matrix(column: pa.Array) -> np.ndarray:
    raw = column.to_pylist()
    if all(len(r) == BUCKETS for r in raw):
        return np.frombuffer(b"".join(raw), np.uint8).reshape(-1, BUCKETS)
    return np.stack([np.frombuffer(r, np.uint8 if len(r) == BUCKETS else np.uint32).astype(np.uint32) for r in raw])


def _possible(pairs: DataFrame, profiles: DataFrame) -> DataFrame:
    """Pairs (a, b, reach) whose distance may be up to 0.2 + reach: the smaller of two sets' class counts,
    summed, bound their common shingles."""
    a = profiles.select(F.col("key").alias("a"), F.col("n").alias("n_a"), F.col("counts").alias("c_a"))
    b = profiles.select(F.col("key").alias("b"), F.col("n").alias("n_b"), F.col("counts").alias("c_b"))

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                common = np.minimum(_count_matrix(batch.column("c_a")), _count_matrix(batch.column("c_b"))).sum(axis=1, dtype=np.int64)
                both = batch.column("n_a").to_numpy() + batch.column("n_b").to_numpy()
                ok = 1 - common / (both - common) <= FAR + _SLACK + batch.column("reach").to_numpy()
                yield batch.select(["a", "b", "reach"]).filter(pa.array(ok))

    # The smaller set bounds the common shingles too.
    sized = pairs.join(a, "a").join(b, "b").filter(
        1 - F.least("n_a", "n_b") / F.greatest("n_a", "n_b") <= FAR + _SLACK + F.col("reach"))
    return sized.select("a", "b", "reach", "n_a", "n_b", "c_a", "c_b").mapInArrow(keep, "a long, b long, reach double")


def _verified(pairs: DataFrame, contents: DataFrame) -> DataFrame:
    """Sizes and number of common shingles of each pair (a, b), `a` the set many others are compared with.

    Sets are sent to their `a`, at most `CHUNK` (about) with one copy of it.
    """
    sets = contents.select("key", "n", "shingles")
    sizes = pairs.groupBy("a").agg(F.count("*").alias("__m"))
    dealt = pairs.join(sizes, "a").select("a", "b", F.when(F.col("__m") <= CHUNK, 0).otherwise(
        F.pmod(F.xxhash64("b"), F.ceil(F.col("__m") / CHUNK))).cast("long").alias("chunk"))
    hubs = dealt.select("a", "chunk").distinct().join(sets.withColumnRenamed("key", "a"), "a").select(
        "a", "chunk", F.lit(None).cast("long").alias("b"), "n", "shingles")
    others = dealt.join(sets.withColumnRenamed("key", "b"), "b").select("a", "chunk", "b", "n", "shingles")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, hub = None, np.zeros(0, _U)
        for batch in batches:
            a, chunk = batch.column("a").to_numpy(), batch.column("chunk").to_numpy()
            b, n = batch.column("b"), batch.column("n").to_numpy()
            raw = batch.column("shingles").cast(pa.large_binary())
            offsets = np.frombuffer(raw.buffers()[1], np.int64)[raw.offset:raw.offset + len(raw) + 1] // 8
            values = np.frombuffer(raw.buffers()[2], _U)
            is_hub = b.is_null().to_numpy(zero_copy_only=False)
            common, hub_size = np.zeros(len(a), np.int64), np.zeros(len(a), np.int64)
            for x, y in zip(heads := group_starts(a, chunk), np.append(heads[1:], len(a))):
                if is_hub[x]:
                    name, hub = (a[x], chunk[x]), values[offsets[x]:offsets[x + 1]].copy()
                    x += 1
                if x < y and name == (a[x], chunk[x]) and len(hub):
                    inside = values[offsets[x]:offsets[y]]
                    at = np.minimum(np.searchsorted(hub, inside), len(hub) - 1)
                    total = np.concatenate(([0], np.cumsum(hub[at] == inside)))
                    edges = offsets[x:y + 1] - offsets[x]
                    common[x:y], hub_size[x:y] = total[edges[1:]] - total[edges[:-1]], len(hub)
            keep = ~is_hub
            yield pa.record_batch([a[keep], b.filter(pa.array(keep)), hub_size[keep], n[keep], common[keep]],
                                  names=["a", "b", "n_a", "n_b", "common"])

    rows = hubs.unionByName(others).repartition("a", "chunk").sortWithinPartitions(
        "a", "chunk", F.col("b").asc_nulls_first())
    found = rows.mapInArrow(compare, "a long, b long, n_a long, n_b long, common long")
    return found.withColumn("d", F.lit(1.0) - F.col("common") / (F.col("n_a") + F.col("n_b") - F.col("common")))


_LINK = "100 * common >= 80 * (n_a + n_b - common)"


def _leader_pairs(profiles: DataFrame) -> DataFrame:
    """Pairs (a: leader, b): the sets that share a band's value follow the smallest of them."""
    bands = profiles.select("key", F.posexplode("bands").alias("band", "value"))
    leaders = bands.groupBy("band", "value").agg(F.min("key").alias("a"), F.max("key").alias("z")).filter("a <> z")
    return bands.join(leaders, ["band", "value"]).filter("a <> key").select("a", F.col("key").alias("b")).distinct()


def _neighbour_pairs(entries: DataFrame, about: DataFrame, turn: int) -> DataFrame:
    """Pairs of sets (a < b) to look at before whole lists are: each list's connected groups stand in one order, large
    ones first, else random, each shown by one of its sets; neighbours, and the largest group with every other, make a
    pair if the bounds allow a link.

    The order and the sets shown follow from the turn, not from the list, so lists with the same groups give the same
    pairs: about as many as there are groups, where the whole list would give their square. `about` (key, comp, odd) has
    one row a set; entries bucketed by set meet it where they lie and travel once, to their list.
    """
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None                  # of the list that a batch ends in: its largest group's set, and its last row
        for batch in batches:
            if not batch.num_rows:
                continue
            now = pa.Table.from_batches([batch])
            now = now if held is None else pa.concat_tables([held, now])
            token, comp, key, n, pos = (now.column(c).to_numpy() for c in ("token", "comp", "key", "n", "pos"))
            shown = group_starts(token, comp)
            odd = np.frombuffer(b"".join(now.column("odd").take(pa.array(shown)).to_pylist()), _U).reshape(len(shown), -1)
            first, last = int(np.searchsorted(token, token[-1])), len(token) - 1
            held = now.take(pa.array([first, last] if first < last else [first]))
            token, key, n, pos = token[shown], key[shown], n[shown].astype(np.int64), pos[shown]
            heads = group_starts(token)
            largest = np.repeat(heads, np.diff(np.append(heads, len(token))))
            j = np.flatnonzero(np.arange(len(token)) > largest)
            i, j = np.concatenate((j - 1, largest[j])), np.concatenate((j, j))
            both = n[i] + n[j]
            ok = (5 * np.minimum(n[i], n[j]) >= 4 * np.maximum(n[i], n[j])) & (
                9 * np.minimum(n[i] - pos[i], n[j] - pos[j]) >= 4 * both)
            ok &= 9 * np.bitwise_count(odd[i] ^ odd[j]).sum(axis=1, dtype=np.int64) <= both
            i, j = i[ok], j[ok]
            if len(i):
                yield pa.record_batch([np.minimum(key[i], key[j]), np.maximum(key[i], key[j])], names=["a", "b"])

    sizes = about.groupBy("comp").agg((-F.count("*")).alias("few"))
    dealt = entries.join(about.join(sizes, "comp"), "key").repartition("token")
    drawn = dealt.withColumn("at", F.xxhash64("comp", F.lit(turn))).withColumn("of", F.xxhash64("key", F.lit(turn)))
    return drawn.sortWithinPartitions("token", "few", "at", "comp", "of").select(
        "token", "comp", "key", "n", "pos", "odd").mapInArrow(scan, "a long, b long").distinct()


def _dealt(entries: DataFrame, lists: DataFrame, about: DataFrame) -> DataFrame:
    """Entries of the lists (token, m: its sets) with the part of the list they are compared in, their chunk, and what
    `about` (key, comp, home, odd) tells of their set, which joins only entries of these lists.

    A list of up to LIST sets is one part. A longer one is cut in chunks of about that many sets, and every pair of
    chunks (also a chunk with itself) is a part of its own, so that no task holds more than two chunks.
    """
    chunks = F.ceil(F.col("m") / LIST)
    placed = entries.join(lists, "token").join(about, "key").withColumn("chunks", chunks).withColumn(
        "chunk", F.pmod(F.xxhash64("key"), F.col("chunks")))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1))
    return placed.withColumn("other", other).withColumn(
        "part", F.least("chunk", "other") * F.col("chunks") + F.greatest("chunk", "other")).withColumn(
        "cross", F.col("part") % (F.col("chunks") + 1) != 0).select(
        "token", "part", "cross", "chunk", "n", "pos", "comp", "home", "odd")


def _open_leader_pairs(entries: DataFrame) -> DataFrame:
    """Pairs of leaders (a < b) of which unconnected followers meet in a list within the bounds."""
    def scan(now: pa.Table) -> Iterator[pa.RecordBatch]:
        token, part, chunk, n, pos, comp, home = (
            now.column(c).to_numpy() for c in ("token", "part", "chunk", "n", "pos", "comp", "home"))
        cross = now.column("cross").to_numpy(zero_copy_only=False)
        odd = np.frombuffer(b"".join(now.column("odd").to_pylist()), _U).reshape(len(token), -1)
        n = n.astype(np.int64)
        left = n - pos
        heads = group_starts(token, part)
        ends = np.repeat(np.append(heads[1:], len(token)), np.diff(np.append(heads, len(token))))
        alive = np.arange(len(token))
        found: list[np.ndarray] = []
        step = 0
        while len(alive):
            step += 1
            alive = alive[alive + step < ends[alive]]
            alive = alive[5 * n[alive] >= 4 * n[alive + step]]        # later ones of the block are larger still
            i, j = alive, alive + step
            # |common| >= 4/9 of both sizes; this list's shingle is the first common one.
            ok = (comp[i] != comp[j]) & (9 * np.minimum(left[i], left[j]) >= 4 * (n[i] + n[j]))
            ok &= ~cross[i] | (chunk[i] != chunk[j])                  # others of one chunk meet in that chunk's own part
            i, j = i[ok], j[ok]
            # |different| <= 1/9 of both sizes, and at least as many as parities that differ.
            differ = np.bitwise_count(odd[i] ^ odd[j]).sum(axis=1, dtype=np.int64)
            ok = 9 * differ <= n[i] + n[j]
            i, j = i[ok], j[ok]
            if len(i):
                found.append(np.unique(np.stack((np.minimum(home[i], home[j]), np.maximum(home[i], home[j])), 1), axis=0))
            if len(found) > 256:
                found = [np.unique(np.concatenate(found), axis=0)]
        if found:
            pairs = np.unique(np.concatenate(found), axis=0)
            yield pa.record_batch([np.ascontiguousarray(pairs[:, 0]), np.ascontiguousarray(pairs[:, 1])], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            now = pa.Table.from_batches([batch])
            now = now if held is None else pa.concat_tables([held, now])
            last = int(group_starts(now.column("token").to_numpy(), now.column("part").to_numpy())[-1])
            if last:
                yield from scan(now.slice(0, last))
            held = now.slice(last)
        if held is not None:
            yield from scan(held)

    return entries.repartition("token", "part").sortWithinPartitions("token", "part", "n").mapInArrow(
        run, "a long, b long").distinct()


def _relabel(labels: DataFrame, links: DataFrame) -> DataFrame:
    """Labels (key, comp) after more links between sets."""
    joined = links.select("a", "b").join(labels.select(F.col("key").alias("a"), F.col("comp").alias("ca")), "a").join(
        labels.select(F.col("key").alias("b"), F.col("comp").alias("cb")), "b")
    merged = components(joined.select(F.col("ca").alias("a"), F.col("cb").alias("b")))
    return save(labels.join(merged.withColumnRenamed("node", "comp"), "comp", "left").select(
        "key", F.coalesce("component", "comp").alias("comp")))


class _Contents:
    """Contents of sets, read from the texts when a comparison first needs them."""

    def __init__(self, docs: DataFrame, profiles: DataFrame):
        self.docs, self.profiles, self.found = docs, profiles, None

    def compare(self, pairs: DataFrame) -> DataFrame:
        """Saved comparisons of the pairs."""
        keys = pairs.select(F.explode(F.array("a", "b")).alias("key")).distinct()
        if self.found is not None:
            keys = keys.join(self.found.select("key"), "key", "left_anti")
        more = save(_contents(self.docs, keys.join(self.profiles, "key").select("key", "th", "doc_id", "m")))
        self.found = more if self.found is None else self.found.unionByName(more)
        return save(_verified(pairs, self.found))


def connected_sets(docs: DataFrame, sets: DataFrame) -> DataFrame:
    """key, comp of every set that shares prefix shingles with another (comp: the same for connected sets)."""
    lists = save(_shared_lists(_prefixes(docs, _frequent(docs))))
    # One example row of each set: a text of it, with the smallest doc_id.
    order = F.struct(F.col("th"), F.col("doc_id").isNull(), "doc_id")
    examples = sets.filter("n > 0").groupBy("key").agg(F.min(order).alias("one")).join(
        lists.select("key").distinct(), "key").select(F.col("key").alias("__key"), "one.th", "one.doc_id")
    match = (sets["key"] == examples["__key"]) & (sets["th"] == examples["th"]) & sets["doc_id"].eqNullSafe(examples["doc_id"])
    profiles = save(sets.join(examples, match, "left_semi").groupBy("key", "th", "doc_id").agg(
        F.count("*").alias("m"), F.first("n").alias("n"), F.first("bands").alias("bands"), F.first("counts").alias("counts"),
        F.first("odd").alias("odd")))
    contents = _Contents(docs, profiles)

    def compare(pairs: DataFrame) -> DataFrame:
        return contents.compare(save(_possible(pairs, profiles)))

    near = compare(_leader_pairs(profiles).withColumn("reach", F.lit(0.0))).filter(_LINK)
    leaders = near.select(F.col("a").alias("key")).distinct().withColumn("leads", F.lit(True))
    nearest = near.groupBy("b").agg(F.min(F.struct("d", "a")).alias("best"))
    alone = F.col("leads").isNotNull() | F.col("best").isNull()
    homes = save(profiles.select("key").join(leaders, "key", "left").join(
        nearest.withColumnRenamed("b", "key"), "key", "left").select(
        "key", F.when(alone, F.col("key")).otherwise(F.col("best.a")).alias("home"),
        F.when(alone, 0.0).otherwise(F.col("best.d")).alias("r")))
    labels = _relabel(homes.select("key", F.col("key").alias("comp")), near)

    def mixed(entries: DataFrame) -> DataFrame:
        """Lists that hold sets not yet connected, with their numbers of sets."""
        return entries.select("token", "key").join(labels, "key").groupBy("token").agg(
            F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count("*").alias("m")).filter("lo <> hi").select("token", "m")

    # Bucketed by set: what is known of a set joins its entries without another shuffle of them.
    buckets = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    entries = save_bucketed(lists.join(mixed(lists).select("token"), "token", "left_semi").repartition(buckets, "key"),
                            "key", buckets)
    odd = save(profiles.select("key", "odd").join(entries.select("key").distinct(), "key"))
    for turn in range(TURNS):
        met = compare(_neighbour_pairs(entries, labels.join(odd, "key"), turn).withColumn("reach", F.lit(0.0))).filter(_LINK)
        if met.limit(FEW).count() < FEW:
            labels = _relabel(labels, met)
            break
        labels = _relabel(labels, met)
    about = homes.select("key", "home").join(labels, "key").join(odd, "key")
    pairs = _open_leader_pairs(_dealt(entries, mixed(entries), about))
    reach = homes.groupBy("home").agg(F.max("r").alias("reach")).filter("reach > 0")
    pairs = save(pairs.join(reach.withColumnsRenamed({"home": "a", "reach": "reach_a"}), "a", "left").join(
        reach.withColumnsRenamed({"home": "b", "reach": "reach_b"}), "b", "left").na.fill(0.0, ["reach_a", "reach_b"]))
    compared = compare(pairs.select("a", "b", (F.col("reach_a") + F.col("reach_b")).alias("reach")))
    labels = _relabel(labels, compared.filter(_LINK))

    # Followers of two leaders too far apart to link themselves, but not too far for the bound.
    open_ = save(_apart(compared.select("a", "b", "d").join(pairs, ["a", "b"]).filter(
        (F.col("reach_a") + F.col("reach_b") > 0)
        & (F.col("d") <= FAR + F.col("reach_a") + F.col("reach_b") + _SLACK)), labels))
    if open_.isEmpty():
        return labels
    star = save(_star(open_, homes, profiles))
    met = contents.compare(star)
    labels = _relabel(labels, met.filter(_LINK))

    met = star.join(met.select("a", "b", F.col("d").alias("far")), ["a", "b"])
    left = met.select(F.col("home").alias("a"), F.col("a").alias("b"), F.col("b").alias("y"), F.col("r").alias("ry"),
                      F.col("far").alias("fy"))
    right = met.select("a", F.col("home").alias("b"), F.col("b").alias("z"), F.col("r").alias("rz"), F.col("far").alias("fz"))
    between = _apart(open_.select("a", "b"), labels)
    rest = between.join(left, ["a", "b"]).join(right, ["a", "b"]).filter(
        (F.col("fy") - F.col("rz") <= FAR + _SLACK) & (F.col("fz") - F.col("ry") <= FAR + _SLACK)).select(
        F.col("y").alias("a"), F.col("z").alias("b")).distinct()
    return _relabel(labels, compare(rest.withColumn("reach", F.lit(0.0))).filter(_LINK))


def _star(open_: DataFrame, homes: DataFrame, profiles: DataFrame) -> DataFrame:
    """Followers b (of `home`, at distance r) that the other leader a of an open pair may come within reach of.

    Followers go to tasks in chunks; the leaders to compare them with follow, and only pairs that the bound and
    the class counts leave open are emitted.
    """
    sides = open_.select(F.col("a").alias("home"), F.col("b").alias("key"), F.col("d").alias("x"), F.col("reach_b").alias("reach")).union(
        open_.select(F.col("b"), F.col("a"), "d", "reach_a"))
    followers = homes.filter("key <> home").join(sides.select("home").distinct(), "home", "left_semi")
    chunks = followers.groupBy("home").agg(F.ceil(F.count("*") / F.lit(CHUNK)).alias("chunks"))
    about = profiles.select("key", "n", "counts")
    members = followers.join(chunks, "home").select(
        "home", F.pmod(F.xxhash64("key"), F.col("chunks")).alias("chunk"), F.lit(0).alias("is_leader"), "key",
        F.col("r").alias("x"), F.lit(0.0).alias("reach")).join(about, "key")
    leaders = sides.join(chunks, "home").select(
        "home", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)).alias("chunk"),
        F.lit(1).alias("is_leader"), "key", "x", "reach").join(about, "key")

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, parts, group = None, [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            home, chunk, leads = (batch.column(c).to_numpy() for c in ("home", "chunk", "is_leader"))
            key, n, x, reach = (batch.column(c).to_numpy() for c in ("key", "n", "x", "reach"))
            found = []
            heads = group_starts(home, chunk, leads)
            for p, q in zip(heads, np.append(heads[1:], len(home))):
                if (home[p], chunk[p]) != name:
                    name, parts, group = (home[p], chunk[p]), [], None
                counts = _count_matrix(batch.column("counts").slice(p, q - p))
                if not leads[p]:
                    parts.append((key[p:q], n[p:q], x[p:q], counts.astype(np.uint32)))
                    continue
                if group is None:
                    group = [np.concatenate(column) for column in zip(*parts)]
                keys, sizes, radii, theirs = group
                for i in range(p, q):
                    near = np.flatnonzero(x[i] <= FAR + radii + reach[i] + _SLACK)
                    common = np.minimum(theirs[near], counts[i - p]).sum(axis=1, dtype=np.int64)
                    near = near[1 - common / (sizes[near] + n[i] - common) <= FAR + _SLACK + reach[i]]
                    found.append((np.full(len(near), key[i]), keys[near], np.full(len(near), home[i]), radii[near]))
            if found:
                yield pa.record_batch([np.concatenate(column) for column in zip(*found)], names=["a", "b", "home", "r"])

    rows = members.unionByName(leaders).select("home", "chunk", "is_leader", "key", "n", "counts", "x", "reach")
    return rows.repartition("home", "chunk").sortWithinPartitions("home", "chunk", "is_leader").mapInArrow(
        meet, "a long, b long, home long, r double")


def _apart(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """Pairs whose sides a and b are not connected yet."""
    return pairs.join(labels.select(F.col("key").alias("a"), F.col("comp").alias("__ca")), "a").join(
        labels.select(F.col("key").alias("b"), F.col("comp").alias("__cb")), "b").filter("__ca <> __cb").drop("__ca", "__cb")


def _grouped(docs: DataFrame) -> DataFrame:
    """doc_id, th, n and the group (its connected sets' label) of every row of doc_id, th, text."""
    sets = save(_sets(docs))
    labels = connected_sets(docs, sets)
    return sets.join(labels, "key", "left").select("doc_id", "th", "n", F.coalesce("comp", "key").alias("comp"))


def _hashed(docs: DataFrame) -> DataFrame:
    return docs.withColumn("th", F.xxhash64(F.coalesce("text", F.lit(""))))


def groups(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id of every document."""
    rows = save(_grouped(_hashed(docs.select("doc_id", "text"))))
    smallest = rows.filter("n > 0").groupBy("comp").agg(F.min("doc_id").alias("component_id"))
    linked = rows.filter("n > 0").join(smallest, "comp").select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    return linked.unionByName(rows.filter("n = 0").select(
        "doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id")))


def one_of_each_group(docs: DataFrame) -> DataFrame:
    """The document with the smallest doc_id of each group, and every document without words; columns as they were."""
    base = docs.withColumn("__th", F.xxhash64(F.coalesce("text", F.lit(""))))
    rows = save(_grouped(base.select("doc_id", F.col("__th").alias("th"), "text")))
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "th")
    chosen = rows.filter("n > 0").groupBy("comp").agg(F.min(order).alias("first")).select(
        F.col("first.doc_id").alias("__id"), F.col("first.th").alias("__keep"))
    again = rows.groupBy("doc_id", "th").agg(F.count("*").alias("m")).select(
        F.col("doc_id").alias("__id"), F.col("th").alias("__keep"), "m")
    chosen = chosen.alias("c").join(again.alias("g"), (F.col("c.__keep") == F.col("g.__keep"))
                                    & F.col("c.__id").eqNullSafe(F.col("g.__id"))).select(
        "c.__id", "c.__keep", F.col("m").alias("__m"))
    wordless = rows.filter("n = 0").select(F.col("doc_id").alias("__id"), F.col("th").alias("__keep"),
                                           F.lit(0).cast("long").alias("__m")).distinct()
    kept = base.join(chosen.unionByName(wordless), (base["__th"] == F.col("__keep"))
                     & base["doc_id"].eqNullSafe(F.col("__id")))
    repeated = kept.filter("__m > 1").dropDuplicates(["__id", "__keep"])     # rows repeated as a whole
    return kept.filter("__m <= 1").unionByName(repeated).select(*docs.columns)
