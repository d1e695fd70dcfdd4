"""Operator 6: shards of near equal bytes by a minimax contiguous partition.

Equal texts are one atomic group. Groups stand in one order (the few that are
large against a shard first, by size; the others by the digest of their
text, which mixes lengths), and each shard is a run of that order. The
smallest capacity that `shards` runs can keep is found by binary search,
with several capacities tried at once; each is checked greedily: from a cut,
the next cut is the largest cumulative size within the capacity. Cumulative
sizes come from sums within ranges of the order plus the sums of the ranges
before, and are written sorted, so a look-up reads only the row groups around
the cut. Everything is DataFrame operations; the driver handles a few integers.

Law: `bytes` (sizes near equal). Defined cases: a null text has no bytes and
goes with the empty texts; doc_id may be null or repeated (every row gets a
slot of its own); other columns are left alone; an empty table gives an
empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from wattline.llm.common import save

SHARDS = 8
_TRIED = 24              # capacities looked at in one pass
_LARGE = 64              # a group over 1 / _LARGE of a shard is placed by size


def _cumulative(groups: DataFrame, total: int, shards: int) -> DataFrame:
    """Groups with the cumulative bytes up to and with them, written in order."""
    large = F.when(F.col("bytes") * (shards * _LARGE) > F.lit(total), F.col("bytes")).otherwise(0)
    order = [F.col("large").desc(), F.col("digest")]
    ranged = save(groups.withColumn("large", large).repartitionByRange(*order).withColumn("range", F.spark_partition_id()))
    sums = ranged.groupBy("range").agg(F.sum("bytes").alias("__bytes"))
    # One row for each range: their number is that of the shuffle partitions.
    before = sums.withColumn("before", F.sum("__bytes").over(Window.orderBy("range")) - F.col("__bytes")).select("range", "before")
    within = F.sum("bytes").over(Window.partitionBy("range").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    return save(ranged.withColumn("within", within).join(F.broadcast(before), "range").select(
        "digest", "bytes", (F.col("before") + F.col("within")).alias("upto")).sortWithinPartitions("upto"))


def _greedy(sums: DataFrame, capacities: list[int], largest: int, total: int, shards: int,
            start: int) -> list[list[int]]:
    """For each capacity the cuts of the greedy walk from `start` (cumulative bytes at the end of every shard)."""
    cuts: list[list[int]] = [[] for _ in capacities]
    for _ in range(shards):
        targets = [(c[-1] if c else start) + capacity for c, capacity in zip(cuts, capacities)]
        # A cut lies less than the largest group below its target.
        near = sums.filter((F.col("upto") > min(targets) - largest) & (F.col("upto") <= max(targets)))
        found = near.agg(*(F.max(F.when(F.col("upto") <= t, F.col("upto"))) for t in targets)).first()
        for c, t, at in zip(cuts, targets, found):
            c.append(total if t >= total else at if at is not None else (c[-1] if c else start))
    return cuts


def smallest_capacity(sums: DataFrame, total: int, largest: int, shards: int, start: int = 0) -> tuple[int, list[int]]:
    """The least capacity whose greedy walk from `start` ends within `shards` shards, and its cuts."""
    even = -(-(total - start) // shards)
    low, high = max(largest, even), even + largest        # the second always suffices
    best = _greedy(sums, [high], largest, total, shards, start)[0]
    while low < high:                                      # some capacity in low..high is the least one
        step = max(1, -(-(high - low) // _TRIED))
        tried = [*range(low, high, step)]
        walks = _greedy(sums, tried, largest, total, shards, start)
        fits = [cuts[-1] >= total for cuts in walks]
        first = fits.index(True) if True in fits else len(tried)
        if first < len(tried):
            best, high = walks[first], tried[first]
        if first:
            low = tried[first - 1] + 1
        else:
            low = high
    return high, best


def cuts_of(sums: DataFrame, total: int, shards: int) -> list[int]:
    """Cumulative bytes at the end of each shard. Where one group fills the capacity, the shards after it are
    balanced anew among themselves, so a very large group does not leave others empty."""
    cuts: list[int] = []
    while len(cuts) < shards:
        start = cuts[-1] if cuts else 0
        if start >= total:
            return cuts + [total] * (shards - len(cuts))
        largest = sums.filter(F.col("upto") > start).agg(F.max("bytes")).first()[0]
        capacity, found = smallest_capacity(sums, total, largest, shards - len(cuts), start)
        cuts += found[:1] if capacity == largest else found
    return cuts


def shard_documents(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of every row."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = save(docs.select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
        F.md5(text.cast("binary")).alias("digest"), F.monotonically_increasing_id().alias("row")))
    groups = save(rows.groupBy("digest").agg(F.sum("size").alias("bytes")))
    total = groups.agg(F.sum("bytes")).first()[0]
    if total is None:
        cuts = [0] * shards
        sums = groups.select("digest", "bytes", F.lit(0).cast("long").alias("upto"))
    else:
        sums = _cumulative(groups, total, shards)
        cuts = cuts_of(sums, total, shards)
    shard = sum((F.when(F.col("upto") > cut, 1).otherwise(0) for cut in cuts[:-1]), F.lit(0)).cast("int")
    placed = save(rows.join(sums.select("digest", shard.alias("shard")), "digest").select(
        "doc_id", "size", "text_crc32", "shard", "row"))
    # Slots: rows of a shard are dealt over buckets; numbers within a bucket follow the buckets before it.
    buckets = 4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = placed.withColumn("bucket", F.pmod(F.xxhash64("row"), F.lit(buckets)))
    counts = dealt.groupBy("shard", "bucket").agg(F.count("*").alias("n"))
    before = counts.withColumn("before", F.sum("n").over(Window.partitionBy("shard").orderBy("bucket")) - F.col("n")).drop("n")
    place = F.row_number().over(Window.partitionBy("shard", "bucket").orderBy("row"))
    return dealt.withColumn("place", place).join(before, ["shard", "bucket"]).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("before") + F.col("place") - 1).alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
