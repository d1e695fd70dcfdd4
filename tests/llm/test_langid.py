"""Operator 13: held-out accuracy, spans of mixed texts, Viterbi against a plain one, defined cases."""

import unicodedata
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st

from wattline.llm import langid
from wattline.llm.common import table
from wattline.llm.textbytes import Texts

DOCS = "doc_id long, text string, lang string, score string, words int"


def held_out(doc_id):
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % 3 == 1


def test_held_out_rows_of_the_table(spark):
    docs = table(spark, "/root/testdata/sf0.1", "documents")
    found = {r.doc_id: r for r in langid.report(docs).collect()}
    rows = docs.collect()
    assert len(found) == len(rows)
    assert all(r.held_out == held_out(i) and 0 <= r.score <= 1 for i, r in found.items())
    for r in rows:
        letters = any(unicodedata.category(c)[0] == "L" for c in set(r.text or ""))
        assert (found[r.doc_id].lang_pred == "und") == (not letters)
    known = [(found[r.doc_id].lang_pred, r.lang, r.text) for r in rows
             if held_out(r.doc_id) and r.lang is not None and found[r.doc_id].lang_pred != "und"]
    assert sum(a == b for a, b, _ in known) >= 0.97 * len(known)


SENTENCES = {
    "en": "the ship with their other things was there when this happened and they thought about which weather would follow",
    "fr": "les bateaux avec leurs choses étaient déjà là quand cette aventure est arrivée et nous pensions à la météo suivante",
    "ru": "корабли были там когда это случилось и они думали о погоде которая должна была наступить потом",
    "uk": "кораблі були там коли це сталося і вони думали про погоду яка мала настати потім її їжак ґанок",
    "zh": "船在那里的时候发生了这件事他们想着接下来的天气",
}


def corpus(copies=12):
    rng = np.random.default_rng(13)
    rows = []
    for lang, text in SENTENCES.items():
        units = list(text) if lang == "zh" else text.split()
        for k in range(copies):
            rows.append((len(rows), ("" if lang == "zh" else " ").join(rng.permutation(units)), lang, "", 1))
    return rows


def model_of(spark, rows):
    return langid.train(spark.createDataFrame(rows, DOCS))


def test_mixed_texts_are_cut_into_spans(spark):
    model = model_of(spark, corpus())
    order = ["fr", "en", "ru", "uk", "zh", "en"]
    mixed, want, at = "", [], 0
    for lang in order:
        mixed += SENTENCES[lang] + ", "
        want.append((at, at + len(SENTENCES[lang]), lang))
        at = len(mixed)
    docs = spark.createDataFrame([(1, mixed, None, "", 0), (2, "123", None, "", 0), (3, None, None, "", 0)], DOCS)
    spans = langid.spans(docs, model).collect()
    got = sorted((r.first_char, r.end_char, r.lang) for r in spans)
    assert {r.doc_id for r in spans} == {1} and [g[2] for g in got] == order
    assert all(abs(g[0] - w[0]) <= 12 and abs(g[1] - w[1]) <= 12 for g, w in zip(got, want))
    only = model.candidates[langid._NAMES.index("Cyrillic")]
    assert [lang for lang, ok in zip(model.languages, only) if ok] == ["ru", "uk"]
    # Half of every text one language, half another: the longer half wins, with a score of about its share.
    two = spark.createDataFrame([(1, SENTENCES["en"] + " " + SENTENCES["fr"][:40], None, "", 0)], DOCS)
    r = langid.predict(two, model).first()
    assert r.lang_pred == "en" and 0.5 < r.score < 0.95


def test_defined_cases(spark):
    rows = corpus()
    rows += [(500, None, "xx", "", 0), (501, "1234 !?", "yy", "", 0), (502, "", "zz", "", 0), (503, "words words", None, "", 0),
             (None, "nothing but words", "en", "", 0), (None, "nothing but words", "en", "", 0), rows[0],
             (504, "the weather \U0001f600 \U00020000 ̈ " * 30_000, "en", "", 0), (505, "a" * 100_000, None, "", 0),
             (506, "Ω", None, "", 0)]
    out = langid.report(spark.createDataFrame(rows, DOCS))
    assert out.columns == ["doc_id", "held_out", "lang_pred", "score"]
    got = out.collect()
    assert len(got) == len(rows) and {r.lang_pred for r in got} <= {*SENTENCES, "und"}
    by_id = {r.doc_id: r for r in got}
    assert [by_id[k].lang_pred for k in (500, 501, 502)] == ["und"] * 3 and by_id[500].score == 0
    assert by_id[504].lang_pred == by_id[None].lang_pred == "en" and not by_id[None].held_out
    assert by_id[506].lang_pred != "und" and len({r for r in got if r.doc_id == 0}) == 1
    assert langid.report(spark.createDataFrame([], DOCS)).count() == 0


def test_nothing_learned(spark):
    rows = [(i, "some words", None, "", 0) for i in range(5)]
    assert {(r.lang_pred, r.score) for r in langid.report(spark.createDataFrame(rows, DOCS)).collect()} == {("und", 0.0)}


def test_held_out_rows_teach_nothing(spark):
    rows = corpus()
    lied = [(i, t, "fr" if held_out(i) else lang, a, b) for i, t, lang, a, b in rows]
    a, b = model_of(spark, rows), model_of(spark, lied)
    assert a.languages == b.languages and (a.runs == b.runs).all() and (a.candidates == b.candidates).all()


def plain(scores, price):
    """Viterbi word by word; the best sum."""
    best = np.zeros(scores.shape[1])
    for row in scores:
        best = np.maximum(best, best.max() - price) + row
    return best.max()


def value(scores, path, price):
    return scores[np.arange(len(path)), path].sum() - price * (np.diff(path) != 0).sum()


@given(st.lists(st.integers(0, 23), min_size=1, max_size=8), st.integers(1, 5), st.integers(1, 7), st.integers(0, 10**6),
       st.booleans())
@settings(max_examples=150, deadline=None)
def test_viterbi_is_the_best_path(sizes, labels, stretch, seed, many):
    rng = np.random.default_rng(seed)
    scores = -rng.integers(0, 12, (sum(sizes), labels)).astype(np.float32)
    was, langid.MATRIX_LANGUAGES = langid.MATRIX_LANGUAGES, 0 if many else 24
    try:
        path = langid.viterbi(scores, np.array(sizes), 5.0, stretch)
    finally:
        langid.MATRIX_LANGUAGES = was
    at = 0
    for n in sizes:
        if n:
            assert value(scores[at:at + n], path[at:at + n], 5.0) == plain(scores[at:at + n], 5.0)
        at += n


@given(st.text(max_size=60))
@settings(max_examples=200, deadline=None)
def test_code_points_and_words(text):
    texts = Texts(pa.array([text, None, text]))
    points, _ = langid.code_points(texts.data)
    assert points.tolist() == [ord(c) for c in text] * 2
    words = langid.words_of(texts)
    letters = sum(unicodedata.category(c)[0] == "L" for c in text)
    assert words.letters.sum() == 2 * letters and not (words.doc == 1).any()
    inside = np.zeros(len(points), bool)
    for a, b in zip(words.first, words.last):
        assert a < b and not inside[a:b].any()
        inside[a:b] = True
    assert inside.tolist() == [unicodedata.category(c)[0] in "LM" for c in text] * 2


@pytest.mark.parametrize("character,name", [("a", "Latin"), ("é", "Latin"), ("я", "Cyrillic"), ("ω", "Greek"), ("漢", "Han"),
                                            ("𠀀", "Han"), ("ひ", "Kana"), ("한", "Hangul"), ("ع", "Arabic"), ("ท", "Thai")])
def test_scripts(character, name):
    assert langid._NAMES[langid.scripts_of(np.array([ord(character)]))[0]] == name
