"""Operator 8: a ledger of quality rules, kept as bits.

Every document is measured once and every rule evaluated once; the ledger
row holds the measurements and one integer whose bit k says that rule k
failed. Policies are versioned sets of rules (masks over those bits), so a
verdict, a change of policy or an ablation never looks at a text again:
a document passes a policy when `bits & mask` is zero, and ablations count
the distinct bit patterns (at most 2**rules of them) with bitwise tests.

Words are runs of bytes other than space and 0x09-0x0D; lines are split at
\\n and count when they hold a word. `n_repeat_words` counts the words that
lie in a window of five words found at least twice in the text, `n_echoes`
the words equal to the word before them.

Defined cases: null and empty texts have all measurements 0 and fail
`too_few_words`; repeated rows are measured alike; other columns are left
alone; an empty table gives an empty ledger.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from wattline.llm.common import map_slices
from wattline.llm.textbytes import Texts, group_starts, mix, windows

_SYMBOLS = np.zeros(256, bool)
_SYMBOLS[list(b"#*$%&|<>")] = True
_WIDTH = 5

MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_echoes")

# Bit k of the ledger is the k-th rule: its name and the condition of failure.
RULES = (
    ("too_few_words", "n_words < 10"),
    ("repeated_windows", "100 * n_repeat_words > 20 * n_words"),
    ("symbol_heavy", "100 * n_symbols > 10 * n_words"),
    ("duplicate_lines", "100 * n_dup_lines > 50 * n_lines"),
    ("short_words", "word_chars < 2 * n_words"),
    ("long_words", "word_chars > 20 * n_words"),
    ("echoed_words", "100 * n_echoes > 20 * n_words"),
)

# Versioned policies: the rules whose failure rejects a document.
POLICIES = {
    "base": ("too_few_words", "repeated_windows"),
    "v1": tuple(name for name, _ in RULES),
}
CURRENT = "v1"


def mask(policy: str) -> int:
    names = [name for name, _ in RULES]
    return sum(1 << names.index(rule) for rule in POLICIES[policy])


def _equal_earlier(keys: np.ndarray, docs: np.ndarray, n: int) -> np.ndarray:
    """For each document, how many of its keys equal an earlier one."""
    if not len(keys):
        return np.zeros(n, np.int64)
    order = np.lexsort((keys, docs))
    first = group_starts(docs[order], keys[order])
    return np.bincount(docs, minlength=n) - np.bincount(docs[order][first], minlength=n)


def measure(texts: Texts) -> dict[str, np.ndarray]:
    n, data = len(texts), texts.data
    a, b, doc = texts.words()
    hasher = texts.range_hasher()
    # A character starts at every byte that is not a continuation byte.
    starts = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80, dtype=np.int64)))
    chars = np.bincount(doc, weights=starts[b] - starts[a], minlength=n).astype(np.int64)

    breaks = np.flatnonzero(data == 0x0A)
    line_a = np.unique(np.concatenate((texts.starts[texts.starts < texts.ends], breaks + 1)))
    line_a = line_a[line_a < len(data)]
    line_doc = texts.doc_of(line_a)
    at = np.searchsorted(breaks, line_a)
    line_b = np.minimum(np.append(breaks, len(data))[at], texts.ends[line_doc]) if len(line_a) else line_a
    has_word = np.searchsorted(a, line_b) > np.searchsorted(a, line_a)
    line_a, line_b, line_doc = line_a[has_word], line_b[has_word], line_doc[has_word]

    words = hasher(a, b)
    echo = np.zeros(len(a), bool)
    echo[1:] = (words[1:] == words[:-1]) & (doc[1:] == doc[:-1])
    runs, first = windows(words, doc, _WIDTH)
    covered = np.zeros(len(a) + 1, np.int64)
    if len(runs):
        key = mix(runs + doc[first].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        order = np.argsort(key)
        heads = group_starts(key[order])
        often = np.repeat(np.diff(np.append(heads, len(key))) > 1, np.diff(np.append(heads, len(key))))
        hit = first[order[often]]
        np.add.at(covered, hit, 1)
        np.add.at(covered, hit + _WIDTH, -1)
    inside = np.cumsum(covered)[:len(a)] > 0
    return {
        "n_words": np.bincount(doc, minlength=n), "word_chars": chars, "n_symbols": texts.counts(_SYMBOLS[data]),
        "n_lines": np.bincount(line_doc, minlength=n),
        "n_dup_lines": _equal_earlier(hasher(line_a, line_b), line_doc, n),
        "n_repeat_words": np.bincount(doc[inside], minlength=n),
        "n_echoes": np.bincount(doc[echo], minlength=n),
    }


def failure_bits() -> Column:
    bits = F.lit(0)
    for k, (_, fails) in enumerate(RULES):
        bits = bits.bitwiseOR(F.when(F.expr(fails), 1 << k).otherwise(0))
    return bits


def ledger(docs: DataFrame) -> DataFrame:
    """doc_id, the measurements and `fail_bits` of every document."""
    def rows(part: pa.RecordBatch) -> pa.RecordBatch:
        found = measure(Texts(part.column("text")))
        return pa.record_batch([part.column("doc_id"), *(pa.array(found[m], pa.int64()) for m in MEASURES)],
                               names=["doc_id", *MEASURES])

    kind = docs.schema["doc_id"].dataType.simpleString()
    measured = map_slices(docs.select("doc_id", "text"), rows,
                          f"doc_id {kind}, " + ", ".join(f"{m} long" for m in MEASURES))
    return measured.withColumn("fail_bits", failure_bits())


def passes(policy: str = CURRENT) -> Column:
    return F.col("fail_bits").bitwiseAND(F.lit(mask(policy))) == 0


def ablation(entries: DataFrame, policy: str = CURRENT) -> DataFrame:
    """For each rule of a policy: documents that fail it, that only it rejects, and that pass without it."""
    patterns = entries.groupBy("fail_bits").agg(F.count("*").alias("n"))
    names = [name for name, _ in RULES]
    whole = mask(policy)
    rows = []
    for rule in POLICIES[policy]:
        bit = 1 << names.index(rule)
        inside = F.col("fail_bits").bitwiseAND(F.lit(whole))
        count = lambda test: F.coalesce(F.sum(F.when(test, F.col("n"))), F.lit(0))
        rows += [F.struct(F.lit(rule).alias("rule"), count(inside.bitwiseAND(F.lit(bit)) != 0).alias("failed"),
                          count(inside == bit).alias("only_this"),
                          count(inside.bitwiseAND(F.lit(whole & ~bit)) == 0).alias("kept_without"))]
    return patterns.agg(F.array(*rows).alias("rules")).select(F.inline("rules"))


def apply_policy(docs: DataFrame, policy: str = CURRENT) -> DataFrame:
    """The documents that pass a policy, all columns as they were."""
    columns = docs.columns

    def rows(part: pa.RecordBatch) -> pa.RecordBatch:
        found = measure(Texts(part.column("text")))
        return pa.record_batch([pa.StructArray.from_arrays(part.columns, names=part.schema.names),
                                *(pa.array(found[m], pa.int64()) for m in MEASURES)], names=["row", *MEASURES])

    inner = docs.schema.simpleString()
    measured = map_slices(docs, rows, f"row {inner}, " + ", ".join(f"{m} long" for m in MEASURES))
    return measured.withColumn("fail_bits", failure_bits()).filter(passes(policy)).select(
        *(F.col("row").getField(c).alias(c) for c in columns))


def verdicts(docs: DataFrame, policy: str = CURRENT) -> DataFrame:
    """The ledger with the base verdict and the policy's."""
    return ledger(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        (~passes("base")).alias("base_failed"), (passes("base") & passes(policy)).alias("kept"),
        "n_lines", "n_echoes", "fail_bits")


ORACLE = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT r, doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws,
             list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS ls FROM d),
g AS (SELECT r, i, ws[i] || ' ' || ws[i+1] || ' ' || ws[i+2] || ' ' || ws[i+3] || ' ' || ws[i+4] AS g
      FROM (SELECT r, ws, unnest(range(1, len(ws) - 3)) AS i FROM w)),
o AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM g) WHERE n > 1),
c AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(i, i + 5)) AS p FROM o) GROUP BY r),
m AS (SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words,
             CAST(coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
             CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
             CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
             CAST(coalesce(c.n, 0) AS BIGINT) AS n_repeat_words, CAST(len(ls) AS BIGINT) AS n_lines,
             CAST(len(list_filter(range(2, len(ws) + 1), lambda i: ws[i] = ws[i - 1])) AS BIGINT) AS n_echoes
      FROM w LEFT JOIN c ON c.r = w.r),
b AS (SELECT *, (CASE WHEN n_words < 10 THEN 1 ELSE 0 END) | (CASE WHEN 100 * n_repeat_words > 20 * n_words THEN 2 ELSE 0 END)
              | (CASE WHEN 100 * n_symbols > 10 * n_words THEN 4 ELSE 0 END) | (CASE WHEN 100 * n_dup_lines > 50 * n_lines THEN 8 ELSE 0 END)
              | (CASE WHEN word_chars < 2 * n_words THEN 16 ELSE 0 END) | (CASE WHEN word_chars > 20 * n_words THEN 32 ELSE 0 END)
              | (CASE WHEN 100 * n_echoes > 20 * n_words THEN 64 ELSE 0 END) AS fail_bits FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (fail_bits & 3) <> 0 AS base_failed,
       fail_bits = 0 AS kept, n_lines, n_echoes, CAST(fail_bits AS INTEGER) AS fail_bits
FROM b
"""
