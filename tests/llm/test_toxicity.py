"""Operator 10: held-out accuracy, the effect of the swap penalty, defined cases."""

import zlib

import numpy as np
import pytest

from wattline.llm import toxicity
from wattline.llm.common import table

DOCS, LABELS = "doc_id long, text string, label string, words int", "doc_id long, quality int, toxic int"


def held_out(doc_id):
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % 5 == 0


def test_held_out_rows_of_the_table(spark):
    docs, labels = (table(spark, "/root/testdata/sf0.1", t) for t in ("documents", "labels"))
    found = {r.doc_id: r for r in toxicity.report(docs, labels).collect()}
    assert len(found) == docs.count()
    assert all(r.held_out == held_out(i) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for i, r in found.items())
    rows = [(found[r.doc_id], r.toxic) for r in labels.collect() if found[r.doc_id].held_out]
    assert sum(r.predicted and not t for r, t in rows) <= 0.005 * len(rows)
    assert sum(r.predicted for r, t in rows if t) >= 0.75 * sum(t for _, t in rows)


def corpus():
    """Insults make a text toxic; a group is mentioned far more often in toxic texts."""
    rng = np.random.default_rng(2)
    words = [f"w{k}" for k in range(300)]
    docs, labels = [], []
    for i in range(900):
        toxic = int(rng.random() < 0.4)
        text = list(rng.choice(words, 25))
        if toxic and rng.random() < 0.8:
            text.insert(3, "scoundrel")
        if rng.random() < (0.8 if toxic else 0.05):
            text.insert(7, "muslims")
        if rng.random() < 0.1:
            text.insert(9, "christians")
        docs.append((i, " ".join(text) + ".", "x", 0))
        labels.append((i, 1, toxic))
    return docs, labels


def test_swap_penalty_frees_neutral_mentions(spark):
    docs, labels = corpus()
    docs_, labels_ = spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS)
    neutral = spark.createDataFrame([(1, "muslims met w1 w2 w3", "", 0), (2, "christians met w1 w2 w3", "", 0)], DOCS)

    def scores(penalty):
        model = toxicity.train(docs_, labels_, penalty=penalty)
        return {r.doc_id: r["__score"] for r in toxicity.score(neutral, model).collect()}

    plain, fair = scores(0.0), scores(20.0)
    assert abs(fair[1] - fair[2]) < 0.3 * abs(plain[1] - plain[2])
    assert fair[1] < plain[1]


def test_swapped_texts():
    assert toxicity.swapped("nothing here") is None
    assert toxicity.swapped("Women met. A woman spoke.") == "men met. A man spoke."
    assert toxicity.swapped("womenfolk") is None


def test_defined_cases(spark):
    docs, labels = corpus()
    docs += [(2000, None, None, None), (2001, "", "", 1), (2002, "scoundrel " * 60_000, "", 1), (None, "scoundrel", "", 1), docs[5]]
    labels += [(3, 1, None), (None, 0, 1), (5, 1, labels[5][2])]
    docs_, labels_ = spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS)
    out = toxicity.report(docs_, labels_).collect()
    assert len(out) == len(docs) and len({r.score for r in out if r.doc_id in (2000, 2001)}) == 1
    kept = toxicity.without_toxic(docs_, labels_)
    assert kept.columns == ["doc_id", "text", "label", "words"]
    ids = [r.doc_id for r in kept.collect()]
    assert 2000 in ids and 2001 in ids and 2002 not in ids and None not in ids


@pytest.mark.parametrize("toxic,score", [(None, 0.0), (0, 0.0), (1, 1.0)])
def test_one_kind_of_label_or_none(spark, toxic, score):
    docs = spark.createDataFrame([(i, "a b", "", 0) for i in range(20)], DOCS)
    labels = spark.createDataFrame([(i, 1, toxic) for i in range(20)], LABELS)
    assert {round(r.score, 6) for r in toxicity.report(docs, labels).collect()} == {score}
    assert toxicity.report(spark.createDataFrame([], DOCS), labels).count() == 0


def test_the_sample_bounds_texts_not_only_labels(spark):
    trained = [i for i in range(100) if not held_out(i)][:3]
    docs = spark.createDataFrame([(i, f"text {k // 2} of {i}") for i in trained for k in range(100)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, k % 2) for k, i in enumerate(trained)] * 2, "doc_id long, toxic int")
    assert toxicity.examples(docs, labels, rows=1).count() == 1
    assert toxicity.examples(docs, labels, rows=3).count() == 3
    assert toxicity.examples(docs, labels, rows=1000).count() == 150     # each text stands twice
    got = [sorted(map(tuple, toxicity.examples(d, labels, rows=3).collect())) for d in (docs, docs.repartition(7))]
    assert got[0] == got[1]


def test_a_column_named_like_the_score(spark):
    docs_ = spark.createDataFrame([(1, "a good day", 7.0), (2, None, None)], "doc_id long, text string, __Score double")
    labels_ = spark.createDataFrame([], "doc_id long, toxic int")
    kept = toxicity.without_toxic(docs_, labels_)
    assert kept.columns == docs_.columns
    assert sorted(map(tuple, kept.collect())) == [(1, "a good day", 7.0), (2, None, None)]
