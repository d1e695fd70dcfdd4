"""Operator 13: the language of every document, and of its spans.

A text is cut into words: runs of letters and marks of one script (in scripts
written without spaces every character is a word). The script, known from its
code point ranges, narrows a word to the languages that were learned with it.
Each candidate scores the word by its character runs of one to four, word ends
included. Viterbi over the words of a text, with one penalty for every change
of language, labels spans; the language with most letters is the document's.

Counts of character runs are taken over all learned rows, in a table of
`BUCKETS` hashed runs per language (fewer if there are so many languages that
`CELLS` would be passed): the model's size does not depend on the data.

Viterbi is exact and runs over all texts of a slice at once. Texts are cut
into stretches of `STRETCH` words; each stretch is first reduced to the matrix
of best scores from any entering to any leaving language, all stretches in
step; then only whole stretches are walked through text by text; at last the
words inside all stretches are labelled, again in step. With many languages
the matrices would cost more than they save, and a text is one stretch.

`score` is the share of the document's letters that carry its language, times
that language's share of the evidence of all words together.

Defined cases: a null text, or one without a letter, is `und` with score 0, as
is every text when nothing was learned; rows without lang, text or letters
teach nothing; ties go to the language whose name comes first; a null doc_id
counts as the empty text for the fold (it may teach); repeated rows are
labelled alike; other columns are left alone; an empty table gives an empty
result.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from wattline.llm.common import map_slices
from wattline.llm.textbytes import Texts, mix, slices

BUCKETS = 1 << 16        # hashed character runs counted for a language
CELLS = 1 << 24          # most numbers in a model
LONGEST = 4              # characters in a run
TEMPER = 0.3             # overlapping runs repeat each other's evidence
BACKGROUND = 0.05        # share of the mean of all languages in each one's runs
SWITCH = 8.0             # price of a change of language between two words
SCRIPT_SHARE = 0.001     # least share of a language's letters in a script it is a candidate for
STRETCH = 64             # words of a stretch
MATRIX_LANGUAGES = 24    # with more languages a text is one stretch
HELD = 16                # languages whose counts a task holds at once
UNKNOWN = "und"

# Code point ranges of scripts, first and last.
SCRIPTS = (
    ("Latin", ((0x0041, 0x024F), (0x1E00, 0x1EFF), (0x2C60, 0x2C7F), (0xA720, 0xA7FF), (0xFF21, 0xFF5A))),
    ("Greek", ((0x0370, 0x03FF), (0x1F00, 0x1FFF))),
    ("Cyrillic", ((0x0400, 0x052F), (0x1C80, 0x1C8F), (0x2DE0, 0x2DFF), (0xA640, 0xA69F))),
    ("Armenian", ((0x0530, 0x058F),)),
    ("Hebrew", ((0x0590, 0x05FF), (0xFB1D, 0xFB4F))),
    ("Arabic", ((0x0600, 0x06FF), (0x0750, 0x077F), (0x08A0, 0x08FF), (0xFB50, 0xFDFF), (0xFE70, 0xFEFE))),
    ("Devanagari", ((0x0900, 0x097F), (0xA8E0, 0xA8FF))),
    ("Bengali", ((0x0980, 0x09FF),)),
    ("Gurmukhi", ((0x0A00, 0x0A7F),)),
    ("Gujarati", ((0x0A80, 0x0AFF),)),
    ("Odia", ((0x0B00, 0x0B7F),)),
    ("Tamil", ((0x0B80, 0x0BFF),)),
    ("Telugu", ((0x0C00, 0x0C7F),)),
    ("Kannada", ((0x0C80, 0x0CFF),)),
    ("Malayalam", ((0x0D00, 0x0D7F),)),
    ("Sinhala", ((0x0D80, 0x0DFF),)),
    ("Thai", ((0x0E00, 0x0E7F),)),
    ("Lao", ((0x0E80, 0x0EFF),)),
    ("Tibetan", ((0x0F00, 0x0FFF),)),
    ("Myanmar", ((0x1000, 0x109F), (0xAA60, 0xAA7F))),
    ("Georgian", ((0x10A0, 0x10FF), (0x1C90, 0x1CBF), (0x2D00, 0x2D2F))),
    ("Hangul", ((0x1100, 0x11FF), (0x3130, 0x318F), (0xA960, 0xA97F), (0xAC00, 0xD7FF))),
    ("Ethiopic", ((0x1200, 0x139F), (0x2D80, 0x2DDF), (0xAB00, 0xAB2F))),
    ("Khmer", ((0x1780, 0x17FF),)),
    ("Mongolian", ((0x1800, 0x18AF),)),
    ("Kana", ((0x3040, 0x30FF), (0x31F0, 0x31FF), (0xFF66, 0xFF9F), (0x1B000, 0x1B16F))),
    ("Han", ((0x2E80, 0x2FDF), (0x3005, 0x3007), (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x3FFFF))),
)
WITHOUT_SPACES = ("Thai", "Lao", "Tibetan", "Myanmar", "Khmer", "Kana", "Han")
_NAMES = ["Other", *(name for name, _ in SCRIPTS)]
_SPACELESS = np.array([name in WITHOUT_SPACES for name in _NAMES])
_LETTER, _MARK = 1, 2
_NEVER = np.float32(-1e9)
_U = np.uint64


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]   # sorted
    runs: np.ndarray             # BUCKETS x languages: log shares of hashed character runs
    candidates: np.ndarray       # scripts x languages


# ---------------------------------------------------------------------------
# Words
# ---------------------------------------------------------------------------

def _kind(character: str) -> int:
    return {"L": _LETTER, "M": _MARK}.get(unicodedata.category(character)[0], 0)


def _small(character: str) -> int:
    low = character.lower()
    return ord(low) if len(low) == 1 else ord(character)


@lru_cache(maxsize=1)
def _plane() -> tuple[np.ndarray, np.ndarray]:
    """Kind and lower case of the first 65,536 code points."""
    characters = [chr(c) for c in range(0x10000)]
    return np.array([_kind(c) for c in characters], np.uint8), np.array([_small(c) for c in characters], np.uint32)


def _mapped(points: np.ndarray, table: np.ndarray, rule) -> np.ndarray:
    """A property of code points: of the first plane by its table, of the few others by its rule."""
    far = points >= 0x10000
    out = table[np.where(far, 0, points)]
    if far.any():
        values, at = np.unique(points[far], return_inverse=True)
        out[far] = np.array([rule(chr(v)) if v < 0x110000 else 0 for v in values.tolist()], out.dtype)[at]
    return out


@lru_cache(maxsize=1)
def _script_edges() -> tuple[np.ndarray, np.ndarray]:
    ranges = sorted((first, last, k + 1) for k, (_, found) in enumerate(SCRIPTS) for first, last in found)
    edges, names = [0], [0]
    for first, last, k in ranges:
        edges += [first, last + 1]
        names += [k, 0]
    return np.array(edges), np.array(names)


def scripts_of(points: np.ndarray) -> np.ndarray:
    edges, names = _script_edges()
    return names[np.searchsorted(edges, points, side="right") - 1]


def code_points(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code points of UTF-8 bytes and the byte each starts at."""
    at = np.flatnonzero((data & 0xC0) != 0x80)
    points = data[at].astype(np.uint32)
    many = np.flatnonzero(points >= 0xC0)
    if len(many):
        padded = np.concatenate((data, np.zeros(3, np.uint8)))
        lead, place = points[many], at[many]
        length = 2 + (lead >= 0xE0) + (lead >= 0xF0)
        value = lead & (np.uint32(0xFF) >> (length + 1).astype(np.uint32))
        for k in range(1, 4):
            value = np.where(length > k, value << np.uint32(6) | (padded[place + k] & 0x3F), value)
        points[many] = value
    return points, at


@dataclass(frozen=True)
class Words:
    points: np.ndarray       # lower-case code points of the slice
    first: np.ndarray        # characters of each word, from first to last
    last: np.ndarray
    doc: np.ndarray
    letters: np.ndarray
    script: np.ndarray
    same: np.ndarray         # number of the distinct word
    one: np.ndarray          # an example of each distinct word
    begins: np.ndarray       # first character of each document


def words_of(texts: Texts) -> Words:
    points, at = code_points(texts.data)
    kinds, small = _plane()
    kind = _mapped(points, kinds, _kind)
    script = scripts_of(points)
    begins = np.searchsorted(at, texts.starts)
    new_doc = np.zeros(len(points) + 1, bool)
    new_doc[begins] = True
    inside = kind > 0
    opens = inside.copy()
    if len(points):
        changes = (kind[1:] == _LETTER) & ((kind[:-1] == _LETTER) & (script[1:] != script[:-1]) | _SPACELESS[script[1:]])
        opens[1:] = inside[1:] & (~inside[:-1] | new_doc[1:-1] | changes)
    first = np.flatnonzero(opens)
    ends = ~inside
    ends |= opens
    stops = np.append(np.flatnonzero(ends), len(points))
    last = stops[np.searchsorted(stops, first, side="right")]
    doc = np.searchsorted(begins, first, side="right") - 1
    total = np.concatenate(([0], np.cumsum(kind == _LETTER)))
    edges = np.append(at, len(texts.data))
    names = texts.range_hasher(lower=True)(edges[first], edges[last])
    _, one, same = np.unique(names, return_index=True, return_inverse=True)
    return Words(_mapped(points, small, _small), first, last, doc, total[last] - total[first], script[first], same, one, begins)


def character_runs(words: Words, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct word and bucket of every run of one to LONGEST characters, word ends being characters too."""
    a, b = words.first[words.one], words.last[words.one]
    size = b - a + 2
    start = np.concatenate(([0], np.cumsum(size)))
    word = np.repeat(np.arange(len(size)), size)
    place = np.arange(start[-1]) - start[word]
    inner = (place > 0) & (place < size[word] - 1)
    value = np.where(place == 0, 1, 2).astype(_U)
    value[inner] = words.points[(a[word] + place - 1)[inner]]
    found, owner = [], []
    hashed = np.zeros(len(value), _U)
    for n in range(1, LONGEST + 1):
        hashed = hashed[:len(value) - n + 1] if n > 1 else hashed
        hashed = mix(hashed * _U(0x9E3779B97F4A7C15) + value[n - 1:] + _U(n))
        fits = inner if n == 1 else place[:len(hashed)] + n <= size[word[:len(hashed)]]
        found.append((hashed[fits] & _U(buckets - 1)).astype(np.int64))
        owner.append(word[:len(hashed)][fits])
    return np.concatenate(owner), np.concatenate(found)


# ---------------------------------------------------------------------------
# Learning
# ---------------------------------------------------------------------------

def remainder(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 3 (null id: as the empty text); 1 is held out."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 3


def counts(docs: DataFrame, buckets: int) -> DataFrame:
    """lang, bucket, n over all rows of lang, text: character runs by bucket, then letters by script."""
    width = buckets + len(_NAMES)

    def rows(held: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
        for lang, total in held.items():
            at = np.flatnonzero(total)
            yield pa.record_batch([pa.array([lang] * len(at), pa.string()), pa.array(at.astype(np.int32)),
                                   pa.array(total[at])], names=["lang", "bucket", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] = {}
        for batch in batches:
            for part in slices(batch):
                words = words_of(Texts(part.column("text")))
                if not len(words.first):
                    continue
                owner, bucket = character_runs(words, buckets)
                langs, of = np.unique(part.column("lang").to_numpy(zero_copy_only=False).astype(str), return_inverse=True)
                of = of[words.doc]
                for k, lang in enumerate(langs.tolist()):
                    mine = of == k
                    if not mine.any():
                        continue
                    if lang not in held:
                        if len(held) >= HELD:
                            yield from rows(held)
                            held = {}
                        held[lang] = np.zeros(width, np.int64)
                    times = np.bincount(words.same[mine], minlength=len(words.one))
                    seen = times[owner] > 0
                    held[lang][:buckets] += np.bincount(bucket[seen], times[owner[seen]], buckets).astype(np.int64)
                    held[lang][buckets:] += np.bincount(words.script[mine], words.letters[mine], len(_NAMES)).astype(np.int64)
        yield from rows(held)

    found = docs.select("lang", "text").mapInArrow(run, "lang string, bucket int, n long")
    return found.groupBy("lang", "bucket").agg(F.sum("n").alias("n"))


def train(docs: DataFrame) -> Model:
    """A model of the rows whose fold is not held out."""
    rows = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & (remainder(F.col("doc_id")) != 1)).select(
        F.col("lang").cast("string").alias("lang"), "text")
    many = rows.select("lang").distinct().count()
    buckets = BUCKETS
    while buckets > 256 and buckets * many > CELLS:
        buckets //= 2
    # At most `buckets` numbers a language, `CELLS` in all, come to the driver.
    found = counts(rows, buckets).toPandas()
    languages = tuple(sorted(found["lang"].unique()))
    total = np.zeros((buckets + len(_NAMES), len(languages)))
    if languages:
        total[found["bucket"], np.searchsorted(np.array(languages), found["lang"].to_numpy(str))] = found["n"]
    share = total[:buckets] / np.maximum(total[:buckets].sum(axis=0), 1)
    mean = share.mean(axis=1, keepdims=True) if languages else np.zeros((buckets, 1))
    runs = np.log((1 - BACKGROUND) * share + BACKGROUND * mean + 1e-9).astype(np.float32)
    letters = total[buckets:]
    candidates = letters >= np.maximum(SCRIPT_SHARE * letters.sum(axis=0), 1)
    candidates[~candidates.any(axis=1)] = True
    return Model(languages, runs, candidates)


# ---------------------------------------------------------------------------
# Labels
# ---------------------------------------------------------------------------

def evidence(words: Words, model: Model) -> np.ndarray:
    """Scores of every word by every language; the best one's is 0, those without the word's script are out."""
    owner, bucket = character_runs(words, len(model.runs))
    n = len(words.one)
    scores = np.stack([np.bincount(owner, model.runs[bucket, k], n) for k in range(len(model.languages))], 1) * TEMPER
    scores = np.where(model.candidates[words.script[words.one]], scores, _NEVER)
    scores = (scores - scores.max(axis=1, keepdims=True)).astype(np.float32)
    return np.maximum(scores, _NEVER)[words.same]


def _step(best: np.ndarray, price: float) -> np.ndarray:
    return np.maximum(best, best.max(axis=-1, keepdims=True) - np.float32(price))


def viterbi(scores: np.ndarray, sizes: np.ndarray, price: float = SWITCH, stretch: int = STRETCH) -> np.ndarray:
    """Best labels of words (rows of `scores`), text after text of the given sizes: the sum of scores less `price` for
    every change inside a text is largest."""
    labels = scores.shape[1]
    total = int(sizes.sum())
    if total == 0 or labels == 1:
        return np.zeros(total, np.int64)
    if labels > MATRIX_LANGUAGES:
        stretch = int(sizes.max())
    filled = np.flatnonzero(sizes)
    pieces = -(-sizes[filled] // stretch)
    base = np.concatenate(([0], np.cumsum(pieces)))           # first stretch of each text
    within = np.arange(base[-1]) - np.repeat(base[:-1], pieces)
    begins = np.repeat(np.concatenate(([0], np.cumsum(sizes[filled])))[:-1], pieces) + within * stretch
    length = np.minimum(stretch, np.repeat(sizes[filled], pieces) - within * stretch)
    # Longest first, so that the stretches still open at a step are the first ones.
    order = np.argsort(-length, kind="stable")
    open_at = np.searchsorted(-length[order], -np.arange(1, length.max() + 1), side="right")
    enter = np.zeros((len(begins), labels), np.float32)
    if base[-1] > len(filled):
        through = np.where(np.eye(labels, dtype=bool), np.float32(0), _NEVER)
        through = np.repeat(through[None], len(begins), 0)
        for t, n in enumerate(open_at):
            through[:n] = _step(through[:n], price) + scores[begins[order[:n]] + t][:, None, :]
        moved = np.empty_like(through)
        moved[order] = through
        # Walk the texts from stretch to stretch, then back: the label each stretch is entered with.
        by_size = np.argsort(-pieces, kind="stable")
        alive = np.searchsorted(-pieces[by_size], -np.arange(1, pieces.max() + 1), side="right")
        best = np.zeros((len(filled), labels), np.float32)
        for k, n in enumerate(alive):
            here = base[by_size[:n]] + k
            enter[here] = best[:n]
            best[:n] = (best[:n, :, None] + moved[here]).max(axis=1)
            best[:n] -= best[:n].max(axis=1, keepdims=True)
        leave = np.full(len(begins), -1)
        at = best.argmax(axis=1)
        for k in range(len(alive) - 1, -1, -1):
            here = base[by_size[:alive[k]]] + k
            leave[here] = at[:alive[k]]
            came = (enter[here] + moved[here, :, at[:alive[k]]]).argmax(axis=1)
            at[:alive[k]] = came
            if k:
                enter[here] = np.where(np.arange(labels) == came[:, None], np.float32(0), _NEVER)
    else:
        leave = None
    best = enter[order]
    back = np.empty((total, labels), np.int16)
    own = np.arange(labels, dtype=np.int16)
    for t, n in enumerate(open_at):
        top = best[:n].argmax(axis=1)
        switch = best[np.arange(n), top][:, None] - np.float32(price) > best[:n]
        at = begins[order[:n]] + t
        back[at] = np.where(switch, top[:, None].astype(np.int16), own)
        best[:n] = _step(best[:n], price) + scores[at]
        best[:n] -= best[:n].max(axis=1, keepdims=True)
    out = np.empty(total, np.int64)
    state = best.argmax(axis=1) if leave is None else leave[order]
    for t in range(len(open_at) - 1, -1, -1):
        n = open_at[t]
        at = begins[order[:n]] + t
        out[at] = state[:n]
        state[:n] = back[at, state[:n]]
    return out


def labelled(texts: Texts, model: Model) -> tuple[Words, np.ndarray, np.ndarray]:
    """The words of some texts, their evidence and their labels."""
    words = words_of(texts)
    if not len(words.first) or not model.languages:
        return words, np.zeros((0, 0), np.float32), np.zeros(0, np.int64)
    scores = evidence(words, model)
    return words, scores, viterbi(scores, np.bincount(words.doc, minlength=len(texts)))


def predictions(texts: Texts, model: Model) -> tuple[list[str], np.ndarray]:
    n, many = len(texts), len(model.languages)
    words, scores, label = labelled(texts, model)
    if not len(label):
        return [UNKNOWN] * n, np.zeros(n)
    letters = np.bincount(words.doc * many + label, words.letters, n * many).reshape(n, many)
    total = letters.sum(axis=1)
    best = letters.argmax(axis=1)
    whole = np.stack([np.bincount(words.doc, scores[:, k], n) for k in range(many)], 1)
    weight = np.exp(whole - whole.max(axis=1, keepdims=True))
    pick = np.arange(n), best
    score = letters[pick] / np.maximum(total, 1) * weight[pick] / weight.sum(axis=1)
    known = total > 0
    return [model.languages[k] if ok else UNKNOWN for k, ok in zip(best.tolist(), known.tolist())], np.where(known, score, 0.0)


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred, score of every document."""
    def rows(part: pa.RecordBatch) -> pa.RecordBatch:
        lang, score = predictions(Texts(part.column("text")), model)
        return pa.record_batch([part.column("doc_id"), pa.array(lang, pa.string()), pa.array(score)],
                               names=["doc_id", "lang_pred", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_slices(docs.select("doc_id", "text"), rows, f"doc_id {kind}, lang_pred string, score double")


def spans(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, first_char, end_char, lang: the labelled spans of every document, from a first word to a last one."""
    def rows(part: pa.RecordBatch) -> pa.RecordBatch:
        words, _, label = labelled(Texts(part.column("text")), model)
        new = np.ones(len(label), bool)
        new[1:] = (label[1:] != label[:-1]) | (words.doc[1:len(label)] != words.doc[:-1][:len(label) - 1])
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(label))[:len(first)] - 1
        doc = words.doc[first]
        return pa.record_batch([
            part.column("doc_id").take(pa.array(doc)), pa.array(words.first[first] - words.begins[doc]),
            pa.array(words.last[last] - words.begins[doc]), pa.array([model.languages[k] for k in label[first]], pa.string())],
            names=["doc_id", "first_char", "end_char", "lang"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_slices(docs.select("doc_id", "text"), rows, f"doc_id {kind}, first_char long, end_char long, lang string")


def report(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every document, by a model of the rows not held out."""
    return predict(docs, train(docs)).select(
        "doc_id", (remainder(F.col("doc_id")) == 1).alias("held_out"), "lang_pred", "score")
