"""Operator 4 against the tiktoken library, and round trips."""

import base64
import hashlib

import pytest
import tiktoken
from public_tokenizers import PATTERN

from wattline.llm import bpe

SCHEMA = "doc_id long, text string, ids int, chunk string"


@pytest.fixture(scope="module")
def encoding():
    with open(bpe.vocabulary_file(), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


TEXTS = [None, "", " ", "\n\n  x", "it's we'll I'D", "a" * 50_000, "Ünïcode 文字 🎈👩‍👩‍👧 ՘֋٣٤", "tab\t\ttab  end  ",
         "<|endoftext|> </turn>", "x\x00y\x85z  　", "mixed123abc!!!??  \r\n", "words and words and words " * 400,
         "\U000323b0a\U0003fc3f1\U00011de0", "  a \x1c b"]


def test_same_as_the_library(spark, encoding, monkeypatch):
    monkeypatch.setattr(bpe, "CHUNK_BYTES", 4000)
    rows = [(i, t, 1, "x") for i, t in enumerate(TEXTS)] + [(6, TEXTS[6], 1, None), (None, "null id", None, None)]
    got = bpe.report(spark.createDataFrame(rows, SCHEMA)).collect()
    want = []
    for i, t, _, _ in rows:
        ids = encoding.encode_ordinary(t or "")
        sha = hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        want.append((i, len(ids), sha, hashlib.sha256((t or "").encode()).hexdigest()))
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


def test_split_agrees_on_every_code_point():
    """Letters, digits and the rest are the library's: pairs that it keeps in one piece are one piece here."""
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    plain, exact = bpe.splitters()
    for lead in ("a", "1", "!"):
        ranks = {bytes([i]): i for i in range(256)}
        for c in points:
            raw = lead.encode() + chr(c).encode()
            for k in range(2, len(raw) + 1):
                ranks.setdefault(raw[:k], len(ranks))
        encode = tiktoken.Encoding("probe", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        for c in points:
            find = exact if c >= 0x540 else plain
            assert (len(encode(lead + chr(c))) == 1) == (len(find(lead + chr(c))) == 1), hex(c)


def test_decode_and_empty(spark, encoding):
    rows = [(1, encoding.encode_ordinary("héllo wörld")), (2, [])]
    got = bpe.decode(spark.createDataFrame(rows, "doc_id long, ids array<int>")).orderBy("doc_id").collect()
    assert [bytes(r.decoded).decode() for r in got] == ["héllo wörld", ""]
    assert bpe.report(spark.createDataFrame([], SCHEMA)).count() == 0
