"""Operator 10: a toxicity classifier with a counterfactual penalty.

A logistic model over the words a text contains is fitted to labelled texts.
For every labelled text that mentions a group, each identity term in its
sentences is swapped for another term of the same kind, and the loss adds
the squared change of the score's logit, so the terms themselves cannot
carry weight that their swap would not carry: neutral mentions of a group
stop looking toxic. Weights are fitted by proximal gradient steps (an l1
penalty keeps words without evidence at zero).

The fit takes at most `rows` labelled texts (those with the smallest hashes of
doc_id and text, so the same at every partitioning; rows alike in doc_id, text
and label are one example) and the `vocabulary` words with the
largest chi-square against the label in them; scoring runs over every text.

Words are runs of letters (anything but ASCII punctuation and white space),
A-Z in lower case. Defined cases: null and empty texts score by the intercept
alone; unlabelled or null labels take no part; without labels of both kinds
every score is the share of the label seen (0 without any); repeated rows
score alike; other columns are left alone; an empty table gives an empty
result.
"""

from __future__ import annotations

import re
import string
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from wattline.llm.common import map_slices, save
from wattline.llm.textbytes import Texts, group_starts

ROWS = 20_000
VOCABULARY = 4096
PENALTY = 4.0            # weight of the squared score change under a swap

# Terms that name groups of people; a term is swapped for the next one of its line.
IDENTITY_TERMS = (
    ("women", "men"), ("woman", "man"), ("girls", "boys"), ("girl", "boy"), ("female", "male"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("black", "white", "asian", "latino"), ("gay", "straight", "lesbian", "bisexual", "transgender"),
    ("african", "european", "american", "mexican", "chinese", "indian", "arab"),
    ("immigrants", "citizens", "refugees"), ("immigrant", "citizen", "refugee"),
    ("old", "young"), ("disabled", "blind", "deaf"),
    ("femmes", "hommes"), ("femme", "homme"), ("frauen", "männer"), ("frau", "mann"),
    ("mujeres", "hombres"), ("mujer", "hombre"),
    ("musulman", "chrétien", "juif"), ("muslime", "christen", "juden"), ("musulmán", "cristiano", "judío"),
)

_SWAP = {term: line[(k + 1) % len(line)] for line in IDENTITY_TERMS for k, term in enumerate(line)}
_TERM = re.compile(r"\b(" + "|".join(sorted(_SWAP, key=len, reverse=True)) + r")\b", re.IGNORECASE)
_BREAKS = np.zeros(256, bool)
_BREAKS[list((string.punctuation + string.whitespace).encode())] = True


@dataclass(frozen=True)
class Model:
    words: np.ndarray        # sorted word hashes
    weights: np.ndarray
    intercept: float


def swapped(text: str) -> str | None:
    """The text with every identity term exchanged, None if it has none."""
    if not _TERM.search(text):
        return None
    sentences = re.split(r"(?<=[.!?\n])", text)
    return "".join(_TERM.sub(lambda m: _SWAP[m[0].lower()], s) for s in sentences)


def _word_sets(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """Document and hash of every distinct word of each text."""
    a, b, doc = texts.words(_BREAKS)
    hashes = texts.range_hasher(lower=True)(a, b)
    order = np.lexsort((hashes, doc))
    doc, hashes = doc[order], hashes[order]
    heads = group_starts(doc, hashes)
    return doc[heads], hashes[heads]


def _packed(texts: Texts) -> list[bytes]:
    doc, hashes = _word_sets(texts)
    edges = np.searchsorted(doc, np.arange(len(texts) + 1))
    return [hashes[x:y].tobytes() for x, y in zip(edges, edges[1:])]


def remainder(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 5 (null id: as the empty text); 0 is held out."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 5


def examples(docs: DataFrame, labels: DataFrame, rows: int = ROWS) -> DataFrame:
    """label, words and words after the swap of a bounded sample of labelled texts."""
    chosen = labels.filter((remainder(F.col("doc_id")) != 0) & F.col("toxic").isin(0, 1)).select(
        "doc_id", F.col("toxic").cast("int").alias("__toxic")).distinct().orderBy(
        F.xxhash64("doc_id"), "doc_id", "__toxic").limit(rows)
    name = ["id_hash", "text_hash", "__toxic"]

    def words(part: pa.RecordBatch) -> pa.RecordBatch:
        text = part.column("text")
        other = [swapped(t) if t else None for t in text.to_pylist()]
        changed = iter(_packed(Texts(pa.array([t for t in other if t is not None], pa.string()))))
        return pa.record_batch([
            *(part.column(c) for c in name), pa.array(_packed(Texts(text)), pa.binary()),
            pa.array([None if t is None else next(changed) for t in other], pa.binary())],
            names=[*name, "words", "swapped"])

    # At most `rows` pairs, then triples, of numbers are broadcast. A doc_id may stand with many texts, so what the
    # labels let through is bounded once more; of rows alike one is kept, before the shuffle and after it.
    joined = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select(
        F.xxhash64("doc_id").alias("id_hash"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"), "__toxic", "text")
    bounded = joined.select(*name).distinct().orderBy(*name).limit(rows)
    found = map_slices(joined.join(F.broadcast(bounded), name), words,
                       "id_hash long, text_hash long, __toxic int, words binary, swapped binary")
    return found.dropDuplicates(name).select(F.col("__toxic").alias("label"), "words", "swapped")


def _counts(found: DataFrame) -> DataFrame:
    def count(batches):
        for batch in batches:
            label = np.repeat(batch.column("label").to_numpy(),
                              [len(w) // 8 for w in batch.column("words").to_pylist()])
            words = np.frombuffer(b"".join(batch.column("words").to_pylist()), np.int64)
            if len(words):
                values, at = np.unique(words, return_inverse=True)
                yield pa.record_batch([values, np.bincount(at, label, len(values)).astype(np.int64),
                                       np.bincount(at, minlength=len(values))], names=["word", "hits", "n"])

    return found.mapInArrow(count, "word long, hits long, n long").groupBy("word").agg(
        F.sum("hits").alias("hits"), F.sum("n").alias("n"))


def _fit(x: list[np.ndarray], y: np.ndarray, swaps: list[tuple[int, np.ndarray]], width: int,
         penalty: float, steps: int = 300) -> tuple[np.ndarray, float]:
    """Accelerated proximal gradient on mean log loss + penalty * mean squared logit change + l1."""
    row = np.repeat(np.arange(len(x)), [len(v) for v in x])
    col = np.concatenate(x) if len(row) else np.zeros(0, np.int64)
    # A swap's change of the logit is the sum of weights gained less those lost.
    s_row = np.repeat(np.arange(len(swaps)), [len(v) + len(x[k]) for k, v in swaps])
    s_col = np.concatenate([np.concatenate((v, x[k])) for k, v in swaps]) if swaps else np.zeros(0, np.int64)
    sign = np.concatenate([np.concatenate((np.ones(len(v)), -np.ones(len(x[k])))) for k, v in swaps]) \
        if swaps else np.zeros(0)
    n, share = len(y), float(np.mean(y))
    l1 = 0.3 / n
    w, b = np.zeros(width), float(np.log(share / (1 - share)))
    v, c, t = w.copy(), b, 1.0

    def curved(u: np.ndarray, c: float) -> tuple[np.ndarray, float]:
        """The curvature bound of the loss, applied to a direction of weights and intercept."""
        z = 0.25 / n * (np.bincount(row, u[col], n) + c)
        out = np.bincount(col, z[row], width)
        if swaps:
            out += 2 * penalty / n * np.bincount(s_col, np.bincount(s_row, u[s_col] * sign, len(swaps))[s_row] * sign, width)
        return out, z.sum()

    u, k = np.ones(width), 1.0
    for _ in range(30):                      # the largest curvature by power iteration
        u, k = curved(u, k)
        size = np.sqrt(u @ u + k * k)
        u, k = u / size, k / size
    rate = 0.9 / size
    for _ in range(steps):
        z = np.bincount(row, v[col], n) + c
        error = 1 / (1 + np.exp(-z)) - y
        grad = np.bincount(col, error[row], width) / n
        if swaps:
            change = np.bincount(s_row, v[s_col] * sign, len(swaps))
            grad += 2 * penalty / n * np.bincount(s_col, change[s_row] * sign, width)
        was_w, was_b = w, b
        w = v - rate * grad
        w = np.sign(w) * np.maximum(np.abs(w) - rate * l1, 0)
        b = c - rate * error.mean()
        t, old = (1 + np.sqrt(1 + 4 * t * t)) / 2, t
        v, c = w + (old - 1) / t * (w - was_w), b + (old - 1) / t * (b - was_b)
    return w, b


def train(docs: DataFrame, labels: DataFrame, rows: int = ROWS, vocabulary: int = VOCABULARY,
          penalty: float = PENALTY) -> Model:
    found = save(examples(docs, labels, rows))
    totals = found.agg(F.count("*").alias("n"), F.sum("label").alias("hits")).first()
    n, hits = totals["n"], totals["hits"] or 0
    if not 0 < hits < n:
        return Model(np.zeros(0, np.uint64), np.zeros(0), 60.0 if hits else -60.0)
    a, m = F.col("hits"), F.col("n")
    off = a * n - m * hits
    chosen = _counts(found).filter(m > 1).withColumn(
        "chi", off.cast("double") * off / (m.cast("double") * (n - m + 1) * hits * (n - hits))).orderBy(
        F.desc("chi"), "word").limit(vocabulary).select("word").collect()
    words = np.sort(np.array([r["word"] for r in chosen], np.int64).view(np.uint64))

    def known(raw: bytes) -> np.ndarray:
        hashes = np.frombuffer(raw, np.uint64)
        at = np.minimum(np.searchsorted(words, hashes), max(0, len(words) - 1))
        return at[words[at] == hashes] if len(words) else np.zeros(0, np.int64)

    def restrict(batches):
        for batch in batches:
            yield pa.record_batch([
                batch.column("label"),
                pa.array([known(r).astype(np.int32).tobytes() for r in batch.column("words").to_pylist()], pa.binary()),
                pa.array([None if r is None else known(r).astype(np.int32).tobytes()
                          for r in batch.column("swapped").to_pylist()], pa.binary())],
                names=["label", "words", "swapped"])

    # At most `rows` lists of vocabulary places come to the driver, in an order of their own.
    small = found.mapInArrow(restrict, found.schema).toPandas().sort_values(
        ["label", "words"], kind="stable").reset_index(drop=True)
    x = [np.frombuffer(r, np.int32).astype(np.int64) for r in small["words"]]
    swaps = [(k, np.frombuffer(r, np.int32).astype(np.int64)) for k, r in enumerate(small["swapped"]) if r is not None]
    w, b = _fit(x, small["label"].to_numpy(float), swaps, len(words), penalty)
    used = w != 0
    return Model(words[used], w[used], float(b))


def logits(model: Model, texts: Texts) -> np.ndarray:
    a, b, doc = texts.words(_BREAKS)
    out = np.full(len(texts), model.intercept)
    if len(model.words) and len(a):
        hashes = texts.range_hasher(lower=True)(a, b)
        at = np.minimum(np.searchsorted(model.words, hashes), len(model.words) - 1)
        hit = np.flatnonzero(model.words[at] == hashes)
        pairs = np.unique(doc[hit] * len(model.words) + at[hit])
        out += np.bincount(pairs // len(model.words), model.weights[pairs % len(model.words)], len(texts))
    return out


def score(docs: DataFrame, model: Model, name: str = "__score") -> DataFrame:
    """The documents with one more column (0 to 1)."""
    def rows(part: pa.RecordBatch) -> pa.RecordBatch:
        z = np.clip(logits(model, Texts(part.column("text"))), -500, 500)
        return pa.record_batch([*part.columns, pa.array(1 / (1 + np.exp(-z)))], names=[*part.schema.names, name])

    return map_slices(docs, rows, StructType([*docs.schema.fields, StructField(name, DoubleType())]))


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    scored = score(docs.select("doc_id", "text"), train(docs, labels))
    return scored.select("doc_id", (remainder(F.col("doc_id")) == 0).alias("held_out"), F.col("__score").alias("score"),
                         (F.col("__score") >= 0.5).cast("int").alias("predicted"))


def without_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents scored below 0.5, all columns as they were."""
    name = "__score"
    while name in map(str.lower, docs.columns):
        name += "_"
    return score(docs, train(docs, labels), name).filter(F.col(name) < 0.5).select(*docs.columns)
