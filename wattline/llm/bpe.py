"""Operator 4: byte-level BPE by a global shuffle of distinct words.

Texts are split into pre-tokens (every match of the pattern; together they
cover the text). A chunk of texts lists its distinct pre-tokens once and
keeps, for every position, the number of the pre-token that stands there. The
lists are dealt by the hash of the pre-token, so equal ones of the whole
corpus meet and are encoded once; their ids go back to the chunks, and every
text is reassembled by position. Decoding looks every id up in the table of
token bytes (a bounded table: one row for each id).

Numbers and word lists travel as compressed columns, one row for each chunk
and part of the hash range: a row for every single pre-token of a corpus
would take several times the space of the texts.

Defined cases: null and empty texts have no ids and decode to the empty
string; an id outside the vocabulary is an error; repeated rows are encoded
each; other columns are left alone; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from wattline.llm.common import save_bucketed
from wattline.llm.textbytes import Texts, slices

CHUNK_BYTES = 16 << 20
_DOCS_AT_ONCE = 256      # documents of one output batch

# Letters and digits that the `regex` module knows and the tiktoken library's
# character classes (an older version of Unicode) do not.
NEWER = (
    (0x558, 0x558), (0x58B, 0x58C), (0x88F, 0x88F), (0xC5C, 0xC5C), (0xCDC, 0xCDC), (0x208F, 0x208F), (0x209D, 0x209F),
    (0xA7CE, 0xA7CF), (0xA7D2, 0xA7D2), (0xA7D4, 0xA7D4), (0xA7DD, 0xA7DD), (0xA7E2, 0xA7E2), (0xA7F1, 0xA7F1),
    (0xAB6C, 0xAB6D), (0x107BB, 0x107BF), (0x10940, 0x10959), (0x10EC5, 0x10EC7), (0x10ED9, 0x10EEE),
    (0x11B0A, 0x11B0A), (0x11DB0, 0x11DDB), (0x11DE0, 0x11DE9), (0x11DF1, 0x11DF1), (0x1246F, 0x1246F),
    (0x12475, 0x1247F), (0x12550, 0x12686), (0x16EA0, 0x16EB8), (0x16EBB, 0x16ED3), (0x16FF2, 0x16FF6),
    (0x187F8, 0x187FF), (0x18CD6, 0x18CDA), (0x18D09, 0x18D20), (0x18D80, 0x18DF2), (0x18E00, 0x19191),
    (0x191A0, 0x191D2), (0x1B123, 0x1B128), (0x1B168, 0x1B168), (0x1D6A6, 0x1D6A6), (0x1DF1F, 0x1DF24),
    (0x1DF2B, 0x1DF81), (0x1DF90, 0x1DF96), (0x1DFCD, 0x1DFFF), (0x1E6C0, 0x1E6DE), (0x1E6E0, 0x1E6E2),
    (0x1E6E4, 0x1E6E5), (0x1E6E7, 0x1E6ED), (0x1E6F0, 0x1E6F4), (0x1E6FE, 0x1E6FF), (0x2B73A, 0x2B73F),
    (0x2B81E, 0x2B81E), (0x2CEA2, 0x2CEAD), (0x323B0, 0x33479), (0x3D000, 0x3FC3F))
_FIRST_NEWER_BYTE = 0xD5          # UTF-8 lead byte of the smallest of them


def vocabulary_file() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@lru_cache(maxsize=4)
def splitters():
    """The pattern's split for texts without newer letters, and for any text."""
    import regex
    from public_tokenizers import PATTERN

    newer = "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in NEWER)
    whole = PATTERN.replace(r"[^\s\p{L}\p{N}]", "@").replace(r"\p{L}", rf"[\p{{L}}--[{newer}]]").replace(
        r"\p{N}", rf"[\p{{N}}--[{newer}]]").replace("@", rf"[[^\s\p{{L}}\p{{N}}]||[{newer}]]")
    return regex.compile(PATTERN).findall, regex.compile("(?V1)" + whole).findall


@lru_cache(maxsize=4)
def token_bytes(ranks_file: str) -> list[bytes]:
    """The bytes of every id."""
    with open(ranks_file, "rb") as lines:
        ranks = {int(rank): base64.b64decode(token) for token, rank in map(bytes.split, lines)}
    return [ranks[k] for k in range(len(ranks))]


@lru_cache(maxsize=4)
def _encoder(ranks_file: str):
    import tiktoken
    from public_tokenizers import PATTERN
    ranks = {token: k for k, token in enumerate(token_bytes(ranks_file))}
    return tiktoken.Encoding(ranks_file, pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary


def _squeeze(numbers: np.ndarray) -> bytes:
    """Non-negative numbers below 2**32, byte by byte of their value, compressed."""
    planes = np.ascontiguousarray(numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def _unsqueeze(blob: bytes) -> np.ndarray:
    raw = zstandard.ZstdDecompressor().decompress(blob)
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(4, -1).T).view("<u4").ravel().astype(np.int64)


_CHUNK = "chunk long, part int, doc_ids array<{kind}>, lengths binary, numbers binary, parts binary, words binary"


def _split(docs: DataFrame, parts: int) -> DataFrame:
    """For every chunk a row of positions (part -1) and a row of distinct pre-tokens for each part of the hash range."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def finish(chunk: int, ids: list[pa.Array], lengths: list[int], numbers: list[np.ndarray],
               known: dict[str, int]) -> Iterator[pa.RecordBatch]:
        words = [w.encode() for w in known]
        part = np.fromiter((zlib.crc32(w) % parts for w in words), np.int64, len(words))
        compress = zstandard.ZstdCompressor(level=1).compress
        rows = [(chunk, -1, pa.concat_arrays(ids), _squeeze(np.array(lengths, np.int64)),
                 _squeeze(np.concatenate(numbers) if numbers else np.zeros(0, np.int64)), _squeeze(part), None)]
        order = np.argsort(part, kind="stable")
        edges = np.flatnonzero(np.diff(part[order], prepend=-1))
        for a, b in zip(edges, np.append(edges[1:], len(order))):
            mine = [words[k] for k in order[a:b]]
            rows.append((chunk, int(part[order[a]]), None, _squeeze(np.array([len(w) for w in mine])), None, None,
                         compress(b"".join(mine))))
        chunk_, part_, doc_ids, *blobs = zip(*rows)
        lists = pa.ListArray.from_arrays(
            pa.array(np.concatenate(([0], np.cumsum([0 if x is None else len(x) for x in doc_ids]))), pa.int32()), doc_ids[0])
        yield pa.record_batch([pa.array(chunk_, pa.int64()), pa.array(part_, pa.int32()), lists,
                               *(pa.array(b, pa.binary()) for b in blobs)],
                              names=["chunk", "part", "doc_ids", "lengths", "numbers", "parts", "words"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plain, exact = splitters()
        task = TaskContext.get().partitionId() << 32
        chunk, size, ids, lengths, numbers, known = 0, 0, [], [], [], {}
        for batch in batches:
            for piece in slices(batch):
                texts = Texts(piece.column("text"))
                find = exact if len(texts.data) and texts.data.max() >= _FIRST_NEWER_BYTE else plain
                number = known.setdefault
                for text in piece.column("text").to_pylist():
                    found = find(text) if text else []
                    lengths.append(len(found))
                    if found:
                        numbers.append(np.fromiter((number(w, len(known)) for w in found), np.int32, len(found)))
                ids.append(piece.column("doc_id"))
                size += len(texts.data)
                if size >= CHUNK_BYTES:
                    yield from finish(task + chunk, ids, lengths, numbers, known)
                    chunk, size, ids, lengths, numbers, known = chunk + 1, 0, [], [], [], {}
        if ids:
            yield from finish(task + chunk, ids, lengths, numbers, known)

    return docs.select("doc_id", "text").mapInArrow(run, _CHUNK.format(kind=kind))


def _encode_words(lists: DataFrame, ranks_file: str) -> DataFrame:
    """Ids of every listed pre-token; each distinct one of the corpus is encoded once, by the task of its part."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoder(ranks_file)
        small = len(token_bytes(ranks_file)) <= 1 << 16
        known: dict[bytes, np.ndarray] = {}
        for batch in batches:
            for k in range(batch.num_rows):
                raw = zstandard.ZstdDecompressor().decompress(batch.column("words")[k].as_py())
                ends = np.cumsum(_unsqueeze(batch.column("lengths")[k].as_py())).tolist()
                counts, ids = [], []
                for a, b in zip([0, *ends], ends):
                    word = raw[a:b]
                    found = known.get(word)
                    if found is None:
                        found = known[word] = np.array(encode(word.decode()), "<u2" if small else "<u4")
                    counts.append(len(found))
                    ids.append(found)
                here = batch.slice(k, 1)
                yield pa.record_batch([
                    here.column("chunk"), here.column("part"), pa.array([_squeeze(np.array(counts, np.int64))], pa.binary()),
                    pa.array([_squeeze(np.concatenate(ids))], pa.binary())], names=["chunk", "part", "counts", "ids"])

    return lists.repartition("part").mapInArrow(run, "chunk long, part int, counts binary, ids binary")


def _chunks_with_ids(docs: DataFrame, ranks_file: str, parts: int) -> DataFrame:
    """Every chunk's positions and the ids of its pre-tokens."""
    # Bucketed by chunk: the positions, the bulk of the data, are written once and join where they lie.
    buckets = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    chunks = save_bucketed(_split(docs, parts), "chunk", buckets)
    words = _encode_words(chunks.filter("part >= 0").select("chunk", "part", "lengths", "words"), ranks_file)
    found = words.groupBy("chunk").agg(F.collect_list(F.struct("part", "counts", "ids")).alias("found"))
    return chunks.filter("part = -1").select("chunk", "doc_ids", "lengths", "numbers", "parts").join(found, "chunk", "left")


def _assembled(batches: Iterator[pa.RecordBatch], parts: int) -> Iterator[pa.RecordBatch]:
    """Chunks -> doc_id and ids of their documents: every position takes the ids of the pre-token that stands there."""
    for batch in batches:
        for k in range(batch.num_rows):
            part = _unsqueeze(batch.column("parts")[k].as_py())
            order = np.argsort(part, kind="stable")
            edges = np.searchsorted(part[order], np.arange(parts + 1))
            counts, first = np.zeros(len(part), np.int64), np.zeros(len(part), np.int64)
            ids, total = [np.zeros(0, np.int32)], 0
            for row in batch.column("found")[k].as_py() or []:
                mine = order[edges[row["part"]]:edges[row["part"] + 1]]
                n = counts[mine] = _unsqueeze(row["counts"])
                first[mine] = total + np.cumsum(n) - n
                ids.append(_unsqueeze(row["ids"]).astype(np.int32))
                total += len(ids[-1])
            ids = np.concatenate(ids)
            numbers = _unsqueeze(batch.column("numbers")[k].as_py()).astype(np.int32)
            lengths = _unsqueeze(batch.column("lengths")[k].as_py())
            doc_ids = batch.column("doc_ids")[k].values
            at = np.concatenate(([0], np.cumsum(lengths)))
            for x in range(0, len(lengths), _DOCS_AT_ONCE):
                y = min(x + _DOCS_AT_ONCE, len(lengths))
                here = numbers[at[x]:at[y]]
                n = counts[here]
                ends = np.cumsum(n)
                flat = ids[np.arange(ends[-1] if len(ends) else 0) + np.repeat(first[here] - (ends - n), n)]
                edge = np.concatenate(([0], ends))[at[x:y + 1] - at[x]]
                yield pa.record_batch([doc_ids[x:y], pa.ListArray.from_arrays(
                    pa.array(edge, pa.int32()), pa.array(flat, pa.int32()))], names=["doc_id", "ids"])


def _decoded(batches: Iterator[pa.RecordBatch], ranks_file: str) -> Iterator[pa.RecordBatch]:
    """Adds the bytes of the ids: a lookup of every id in the table of token bytes."""
    table = pa.array(token_bytes(ranks_file), pa.large_binary())
    for batch in batches:
        lists = batch.column("ids")
        taken = table.take(lists.flatten())
        ends = np.frombuffer(taken.buffers()[1], np.int64)[taken.offset:taken.offset + len(taken) + 1] \
            if len(taken) else np.zeros(1, np.int64)
        edges = lists.offsets.to_numpy() - (lists.offsets[0].as_py() if len(lists) else 0)
        whole = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(lists), [
            None, pa.py_buffer(np.ascontiguousarray(ends[edges])), taken.buffers()[2]])
        yield pa.record_batch([batch.column("doc_id"), lists, whole.cast(pa.binary())], names=["doc_id", "ids", "decoded"])


def _digested(batches: Iterator[pa.RecordBatch], ranks_file: str) -> Iterator[pa.RecordBatch]:
    names = np.array([str(k) for k in range(len(token_bytes(ranks_file)))], object)
    for batch in batches:
        lists = batch.column("ids")
        edges = lists.offsets.to_numpy()
        ids = lists.values.to_numpy(zero_copy_only=False)
        sha = [hashlib.sha256(",".join(names[ids[a:b]].tolist()).encode()).hexdigest() for a, b in zip(edges, edges[1:])]
        back = [hashlib.sha256(raw.as_buffer()).hexdigest() for raw in batch.column("decoded")]
        yield pa.record_batch([batch.column("doc_id"), pa.array(np.diff(edges), pa.int64()), pa.array(sha, pa.string()),
                               pa.array(back, pa.string())], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])


def _parts(docs: DataFrame) -> int:
    return min(65_535, 4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def encode(docs: DataFrame, ranks_file: str | None = None) -> DataFrame:
    """doc_id and ids (array of int) of every document."""
    parts, kind = _parts(docs), docs.schema["doc_id"].dataType.simpleString()
    chunks = _chunks_with_ids(docs, ranks_file or vocabulary_file(), parts)
    return chunks.mapInArrow(lambda batches: _assembled(batches, parts), f"doc_id {kind}, ids array<int>")


def decode(encoded: DataFrame, ranks_file: str | None = None) -> DataFrame:
    """Adds `decoded` (binary) to rows of doc_id, ids."""
    ranks_file = ranks_file or vocabulary_file()
    kind = encoded.schema["doc_id"].dataType.simpleString()
    return encoded.mapInArrow(lambda batches: _decoded(batches, ranks_file),
                              f"doc_id {kind}, ids array<int>, decoded binary")


def report(docs: DataFrame, ranks_file: str | None = None) -> DataFrame:
    """doc_id, n_tokens and digests of ids and decoded bytes of every document: encoded, decoded and
    digested batch by batch in one Python process a task."""
    ranks_file = ranks_file or vocabulary_file()
    parts, kind = _parts(docs), docs.schema["doc_id"].dataType.simpleString()
    return _chunks_with_ids(docs, ranks_file, parts).mapInArrow(
        lambda batches: _digested(_decoded(_assembled(batches, parts), ranks_file), ranks_file),
        f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
