"""Operator 12 against a plain recursive tree, its layout's arithmetic, defined cases."""

import hashlib
import random
import string
import zlib
from collections import defaultdict

import numpy as np
import pytest

from wattline.llm import merkle

DOCS = "doc_id long, text string, lang string, source string, n_chars long, leaf string, tree int, path string"
LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(i, text, lang, source, n):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (i, source, lang, n, text)))


def tree(nodes):
    """Root, and of every leaf the siblings left and right, level by level."""
    paths, where = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for k, at in enumerate(where):
            first = at // 16 * 16
            paths[k].append(("".join(nodes[first:at]), "".join(nodes[at + 1:first + 16])))
            where[k] = at // 16
        nodes = [sha("".join(nodes[k:k + 16])) for k in range(0, len(nodes), 16)]
    return nodes[0], paths


def brute(docs):
    sources = defaultdict(list)
    for i, text, lang, source, n, *_ in docs:
        changed = i is not None and zlib.crc32(str(i).encode()) % 5 == 0
        now = text.translate(LOWER) if changed and text is not None else text
        sources[source].append((i, leaf(i, text, lang, source, n), leaf(i, now, lang, source, n)))
    names = sorted(sources, key=lambda s: b"" if s is None else b"+" + s.encode())
    rows, roots = [], []
    for name in names:
        mine = sorted(sources[name], key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        root, paths = tree([r[1] for r in mine])
        roots.append(root)
        rows += [(len(roots) - 1, r, root, p) for r, p in zip(mine, paths)]
    root, above = tree(roots)
    out = []
    for k, (i, own, seen), subroot, path in rows:
        node = seen
        for left, right in path + above[k]:
            node = sha(left + node + right)
        out.append((i, own, subroot, root, sha("".join(a + b for a, b in path + above[k])), node, node == root))
    return sorted(out, key=repr)


def got(spark, docs, height=merkle.HEIGHT):
    found = merkle.audit(spark.createDataFrame(docs, DOCS), height)
    assert found.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return sorted(map(tuple, found.collect()), key=repr)


def corpus(sizes):
    rng = random.Random(12)
    rows = []
    for source, n in sizes.items():
        for _ in range(n):
            text = rng.choice([None, "", "Aé日本 Z", "lower", "The Text %d" % rng.random().__hash__()])
            rows.append((rng.randrange(10**6), text, rng.choice([None, "en"]), source, rng.choice([None, 3])))
    return [(*r, "clash", 1, "clash") for r in rows]


@pytest.mark.parametrize("height", [1, 2, 3])
def test_every_proof(spark, height):
    docs = corpus({None: 1, "": 2, "hot": 700, "é": 16, "a": 17, "b": 257, "Z": 256})
    docs += [docs[40]] * 3 + [(None, "No Id", "en", "a", 5, "", 0, ""), (None, "X" * 400_000, None, None, None, "", 0, "")]
    docs += [(7, "Same Id", "en", "hot", n, "", 0, "") for n in (1, 2, None)]
    want = brute(docs)
    assert got(spark, docs, height) == want
    assert {r[-1] for r in want} == {True, False}


def test_many_sources_and_one(spark):
    many = corpus({f"s{k}": 1 + k % 3 for k in range(300)})
    assert got(spark, many, 1) == brute(many)
    one = corpus({"only": 1})
    assert got(spark, one) == brute(one)
    assert got(spark, []) == []


@pytest.mark.parametrize("levels", [1, 2, 3, 4, 5])
def test_layout_is_split_at_half_height(levels):
    """Every node has one place; the top half comes first, and each subtree below it is one run laid out alike."""
    places = [merkle.address(levels, d, np.arange(16 ** d)) for d in range(levels)]
    assert sorted(np.concatenate(places)) == list(range(merkle.nodes_of(levels)))
    top, low = levels // 2, levels - levels // 2
    if top:
        assert np.concatenate(places[:top]).max() < merkle.nodes_of(top)
        for d in range(top, levels):
            first = places[d][:16 ** (d - top)]
            assert (first == merkle.nodes_of(top) + merkle.address(low, d - top, np.arange(16 ** (d - top)))).all()


@pytest.mark.parametrize("n,levels", [(1, 1), (2, 2), (16, 2), (17, 3), (300, 4), (4096, 4), (1, 4), (4081, 4)])
def test_blocks(n, levels):
    leaves = [sha(str(k)) for k in range(n)]
    block = merkle.lay_out(np.frombuffer("".join(leaves).encode(), np.uint8).reshape(-1, 64), levels)
    level = leaves
    for _ in range(levels - 1):
        level = [sha("".join(level[k:k + 16])) for k in range(0, len(level), 16)]
    assert block[0].tobytes().decode() == level[0]
    sides = merkle.siblings(block, levels, n)
    assert len(sides) == levels - 1
    for k in {0, n // 2, n - 1}:
        node = leaves[k].encode()
        for left, right in sides:
            node = merkle.digest(left[k] + node + right[k])
        assert node.decode() == level[0]


def test_proofs_are_held_for_a_span_of_leaves(spark, monkeypatch):
    """Paths are made and checked a span at a time, and those that `proofs` gives out lead to the root."""
    docs = corpus({"hot": 700, "a": 257, "b": 1})
    frame = spark.createDataFrame(docs, DOCS)
    found = merkle.manifest(frame)
    for r in merkle.proofs(found).collect():
        node = r["seen"]
        for side in r["path"]:
            node = sha(side["left"] + node + side["right"])
        assert node == found.root
    held = spark.sparkContext.accumulator(0)
    folded = merkle._folded

    def counted(batch):
        assert batch.num_rows <= 256
        held.add(batch.num_rows)
        return folded(batch)

    monkeypatch.setattr(merkle, "_folded", counted)
    assert merkle.verified(found).filter("verified").count() == held.value == len(docs)


def test_siblings_of_a_span():
    leaves = [sha(str(k)) for k in range(700)]
    block = merkle.lay_out(np.frombuffer("".join(leaves).encode(), np.uint8).reshape(-1, 64), 4)
    whole = merkle.siblings(block, 4, 700)
    for start, stop in ((0, 256), (256, 512), (512, 700), (5, 6), (250, 300)):
        assert merkle.siblings(block, 4, 700, start, stop) == [(left[start:stop], right[start:stop]) for left, right in whole]
