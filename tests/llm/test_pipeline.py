"""The pipeline against its stages done by brute force, and the registered queries."""

import hashlib
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__
import corpus_pipeline
from test_ngram_join import brute as brute_groups
from test_quality import brute as brute_measures
from test_suffix_dedup import brute as brute_removed
from wattline.llm import queries, toxicity
from wattline.llm.common import table

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def make_tables(spark, folder):
    rng = np.random.default_rng(4)
    words = [f"{a}{b}" for a in "bcdfglmnprst" for b in ("a", "el", "ino", "ux", "aer")]
    prose = lambda n: " ".join(rng.choice(words, n)) + "."
    passage = prose(70)
    docs = [prose(int(rng.integers(15, 90))) for _ in range(60)]
    docs += [prose(12) + " " + passage + " " + prose(12) for _ in range(8)]
    docs += [docs[3], docs[3] + " end", docs[4].upper(), "too short", "", None, "# $ % " * 30, "a b c d e " * 20]
    docs += [prose(20) + " scoundrel " + prose(10) for _ in range(30)]
    rows = [(i, t, "en", "s", None if t is None else len(t)) for i, t in enumerate(docs)]
    labels = [(i, 1, int("scoundrel" in (t or ""))) for i, t in enumerate(docs)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return rows


def test_stages_against_brute_force(spark, tmp_path):
    rows = make_tables(spark, tmp_path)
    docs = table(spark, str(tmp_path), "documents")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality rules", "toxicity", "n-gram Jaccard join", "suffix-array dedup", "best-fit packing"]

    def step(name, given):
        made = spark.createDataFrame(given, SCHEMA)
        out = stages[name](spark, made, str(tmp_path))
        assert out.columns == docs.columns
        return sorted(tuple(r) for r in out.collect())

    kept = step("quality rules", rows)
    want = []
    for r in rows:
        n, chars, symbols, dup, repeat, lines, echoes = brute_measures(r[1])
        if not (n < 10 or 100 * repeat > 20 * n or 100 * symbols > 10 * n or 100 * dup > 50 * lines
                or chars < 2 * n or chars > 20 * n or 100 * echoes > 20 * n):
            want.append(r)
    assert kept == sorted(want)

    after = step("toxicity", kept)
    assert all("scoundrel" not in r[1] for r in after) and len(after) == sum("scoundrel" not in r[1] for r in kept)

    single = step("n-gram Jaccard join", after)
    assert [r[0] for r in single] == sorted({c for _, _, c in brute_groups(after)})

    cut = step("suffix-array dedup", single)
    digest = {d: sha for d, _, _, _, sha in brute_removed(single, 200)}
    assert {r[0]: hashlib.sha256(r[1].encode()).hexdigest() for r in cut} == digest
    assert any(len(a[1]) < len(b[1]) for a, b in zip(cut, single)) and all(len(r[1]) == r[4] for r in cut)

    out = corpus_pipeline.run(spark, str(tmp_path)).toPandas()
    assert set(out.doc_id) == {r[0] for r in cut}
    for _, one in out.groupby("sequence_id"):
        one = one.sort_values("offset")
        assert one.offset.tolist() == [0, *one.length.cumsum().tolist()[:-1]] and one.length.sum() <= 1024


def test_stages_take_an_empty_table(spark, tmp_path):
    make_tables(spark, tmp_path)
    empty = spark.createDataFrame([], SCHEMA)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, str(tmp_path)).count() == 0


def test_registered_queries():
    names = set(__spark_entry__.queries())
    assert set(queries.QUERIES) | {"pipeline"} <= names
    assert sorted(int(q[2:].split("_")[0]) for q in queries.QUERIES) == list(range(1, 11))


def test_quality_query_equals_its_sql(spark):
    from check_oracle import compare, duck
    sf = "/root/testdata/sf0.001"
    got = compare(spark, duck(sf), "op8_quality_rules", queries.QUERIES["op8_quality_rules"],
                  queries.ORACLE["op8_quality_rules"], sf)
    assert got["cols_equal"] and got["spark_rows"] == got["duck_rows"] and got["rounded"], got


@pytest.mark.parametrize("doc_id", [None, 0, 7, -3])
def test_remainder_is_the_contracts(spark, doc_id):
    got = spark.createDataFrame([(doc_id,)], "d long").select(toxicity.remainder(F.col("d")).alias("r")).first().r
    assert got == zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % 5
