"""Operator 1 as registered: runs from every sentence and up to every sentence."""

import numpy as np
from test_span_dedup import split

from wattline.llm.queries import op1_substring_dedup

number = iter(range(10**9))


def sentence(n):
    return " ".join(f"w{next(number)}" for _ in range(n)) + ". "


def cleaned(spark, tmp_path, texts):
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    return [tuple(r) for r in op1_substring_dedup(spark, str(tmp_path)).orderBy("doc_id").collect()]


def brute(texts):
    seen, out = {}, []
    for doc, text in enumerate(texts):
        parts = split(text)
        n, size = len(parts), lambda i, j: sum(p[2] for p in parts[i:j])
        enough = lambda i, j: size(i, j) >= 30 or j - i >= 3 and size(i, j) >= 15
        spans = {(i, next((j for j in range(i + 1, n + 1) if enough(i, j)), None)) for i in range(n)}
        spans |= {(next((i for i in range(j - 1, -1, -1) if enough(i, j)), None), j) for j in range(1, n + 1)}
        spans = {s for s in spans if None not in s} or ({(0, n)} if n else set())
        gone = set()
        for i, j in sorted(spans):
            if seen.setdefault(tuple(text[a:b] for a, b, _ in parts[i:j]), (doc, i)) != (doc, i):
                gone.update(range(i, j))
        starts = [p[0] for p in parts] + [len(text)]
        out.append((doc, "".join(text[starts[k]:starts[k + 1]] for k in range(n) if k not in gone), n, len(gone)))
    return out


def test_ends_of_repeats_go(spark, tmp_path):
    copy = sentence(20) + sentence(20) + sentence(5)
    long_last = sentence(66) + sentence(4)
    passage = sentence(20) + sentence(35) + sentence(20)
    greeting = "Hello all. "
    texts = [copy, copy, long_last, long_last, sentence(9) + passage + sentence(40), sentence(3) + passage + sentence(7),
             greeting + sentence(40), greeting + sentence(40)]
    got = cleaned(spark, tmp_path, texts)
    assert got == brute(texts)
    assert got[1][1:] == ("", 3, 3) and got[3][1:] == ("", 2, 2) and got[5][3] == 3
    assert [r[3] for r in got[::2]] == [0, 0, 0, 0] and got[7][3] == 0        # a shared short beginning is no run


def test_both_ends_match_plain_scan(spark, tmp_path):
    rng = np.random.default_rng(5)
    pool = [sentence(int(n)) for n in rng.integers(1, 45, 40)]
    texts = []
    for _ in range(120):
        at, n = int(rng.integers(0, 36)), int(rng.integers(1, 9))
        texts.append("".join(pool[at:at + n]) + sentence(int(rng.integers(1, 40))) + "".join(pool[n:n + at % 5]))
    texts += texts[:20]
    assert cleaned(spark, tmp_path, texts) == brute(texts)
