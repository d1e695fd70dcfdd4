"""Operator 1 against a plain ordered scan."""

import re

import numpy as np

from wattline.llm import span_dedup

SCHEMA = "doc_id long, text string, run string, stop int"


def split(text):
    out, words = [], list(re.finditer("[^\x20\x09-\x0d]+", text))
    now = []
    for k, w in enumerate(words):
        now.append(w)
        gap = text[w.end():words[k + 1].start()] if k + 1 < len(words) else "\n"
        if w[0][-1] in ".!?" or "\n" in gap:
            out.append((now[0].start(), now[-1].end(), len(now)))
            now = []
    return out


def brute(rows):
    docs = sorted({(r[0] is None, r[0] or 0, r[1] or "") for r in rows})
    # equal doc_id with different texts: by text hash, avoided in the data
    seen, removed = {}, {}
    found = []
    for null, doc, text in docs:
        parts = split(text)
        for i in range(len(parts)):
            total, end = 0, None
            for j in range(i, len(parts)):
                total += parts[j][2]
                if total >= 30 or (j - i + 1 >= 3 and total >= 15):
                    end = j + 1
                    break
            if end is None and i == 0:
                end = len(parts)
            if end is not None:
                found.append((tuple(text[a:b] for a, b, _ in parts[i:end]), (null, doc, text), i, end))
    for run, where, i, end in found:
        if run in seen and seen[run] != (where, i):
            removed.setdefault(where, set()).update(range(i, end))
        seen.setdefault(run, (where, i))
    out = []
    for r in rows:
        text = r[1]
        parts = split(text or "")
        gone = removed.get((r[0] is None, r[0] or 0, text or ""), set())
        if gone:
            starts = [p[0] for p in parts] + [len(text)]
            text = text[:starts[0]] + "".join(text[starts[k]:starts[k + 1]] for k in range(len(parts)) if k not in gone)
        out.append((r[0], text, *r[2:], len(parts), len(gone)))
    return sorted(out, key=repr)


def test_matches_plain_scan(spark):
    rng = np.random.default_rng(11)
    word = lambda: "".join(rng.choice(list("abé"), rng.integers(1, 4))) + rng.choice(["", "", ".", "!", "?", ","])
    prose = lambda n: "".join(word() + rng.choice([" ", " ", "\n", "  "]) for _ in range(n))
    passages = [prose(60) for _ in range(4)]
    rows = [(i, prose(int(rng.integers(0, 120))) + "\n" + (passages[i % 4] if i % 2 else "") + "\n" + prose(20), "x", i)
            for i in range(60)]
    rows += [(100, passages[0] + passages[0], "", 1), (101, "Short.", "", 1), (102, "Short.", "", 1), (103, None, "", 1),
             (104, "", "", 1), (105, " \n ", None, None), (None, passages[1], "", 1), (106, "A. B. C. D. E.", "", 1),
             (107, "X. A. B. C. D. E.", "", 1), (108, "long " * 60_000, "", 1), (109, "long " * 60_000, "", 1)]
    rows += [rows[5], rows[5]]
    rows = [(r[0], r[1], r[2], None if r[3] is None else int(r[3])) for r in rows]
    got = span_dedup.without_repeats(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted(map(tuple, got), key=repr) == brute(rows)


def test_empty(spark):
    out = span_dedup.without_repeats(spark.createDataFrame([], SCHEMA))
    assert out.count() == 0 and out.columns == ["doc_id", "text", "run", "stop", "n_sentences", "n_removed"]
