"""Operator 5: exact round trips through the template."""

import hashlib

import pytest
from hypothesis import given, settings, strategies as st

import pyarrow as pa

from wattline.llm import chat
from wattline.llm.textbytes import Texts

SCHEMA = "conv_id long, turn long, role string, text string, formatted string, part int"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def expected(rows):
    convs = {}
    for conv, turn, role, text, *_ in rows:
        convs.setdefault(conv, []).append((turn is not None, turn, role or "", text or ""))
    out = []
    for conv, turns in convs.items():
        turns.sort(key=lambda t: (t[0], t[1] or 0, t[2].encode(), t[3].encode()))
        loss = "".join(t for _, _, r, t in turns if r == "assistant")
        out.append((conv, len(turns), sha("".join(f"{r}\n{t}\n" for _, _, r, t in turns)), len(loss), sha(loss)))
    return sorted(out, key=repr)


TRICKY = ["", "plain", "é文🎈", "\\", "###", "####", "</turn>", "<</turn></turn>\n", "### user: hi</turn>\n", "\\\\###\\",
          "a: b", chat.HOSTILE, "x" * 100_000, "<", "</tur", "#" * 7 + "\\" * 3]


@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "a:b", "\\:", "", "### x"]),
                          st.one_of(st.sampled_from(TRICKY), st.text(alphabet="\\#<>/turn:\n aé", max_size=30))),
                min_size=1, max_size=12))
@settings(max_examples=150, deadline=None)
def test_assembled_turns_read_back(turns):
    out, bounds, a, b = chat.assemble(Texts(pa.array([r for r, _ in turns])), Texts(pa.array([t for _, t in turns])))
    raw = out.tobytes()
    assert list(chat.read_back(raw.decode())) == turns
    assert [chat.unescape(raw[x:y].decode()) for x, y in zip(a, b)] == [t for _, t in turns]
    assert bounds[0] == 0 and bounds[-1] == len(raw)


@pytest.mark.parametrize("limit", [8 << 20, 50])
def test_digests(spark, monkeypatch, limit):
    monkeypatch.setattr(chat, "PART_BYTES", limit)
    rows = [(c, t, ("user", "assistant", "system")[t % 3], TRICKY[(c * 5 + t) % len(TRICKY)], "x", 0)
            for c in range(12) for t in range(c % 7 + 1)]
    rows += [(3, 0, None, None, None, None), (3, 0, "user", "tie", "", 1), (3, 0, "user", "tie", "", 1),
             (None, 0, "assistant", "null id", "", 1), (None, None, "user", "null turn", "", 1)]
    rows += [(50, k, "assistant", f"turn {k}", "", 0) for k in range(500)]
    turns = spark.createDataFrame(rows, SCHEMA)
    got = chat.digests(chat.conversations(turns)).collect()
    assert sorted([tuple(r)[:5] for r in got], key=repr) == expected(rows)
    parts = chat.conversations(turns).collect()
    whole = {}
    for r in sorted(parts, key=lambda r: r.part):
        whole[r.conv_id] = whole.get(r.conv_id, "") + r.formatted
    assert {r.conv_id: r.formatted_chars for r in got} == {k: len(v) for k, v in whole.items()}


def test_hostile_conversation_and_empty(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert chat.digests(chat.conversations(empty)).count() == 0
    only = chat.digests(chat.conversations(chat.with_hostile(spark, empty))).collect()
    assert [tuple(r)[:5] for r in only] == [
        (-7, 2, sha(f"user\n{chat.HOSTILE}\nassistant\n{chat.HOSTILE}\n"), len(chat.HOSTILE), sha(chat.HOSTILE))]


@pytest.mark.parametrize("block", [1, 2, 3, 7])
def test_blocks_do_not_cut_escapes(monkeypatch, block):
    monkeypatch.setattr(chat, "BLOCK", block)
    texts = ["\\" * 9 + "###", "a\\\\</turn>\\", "", "### x: </turn>\n", "é" * 5 + "\\", "<</turn>>"]
    out, bounds, a, b = chat.assemble(Texts(pa.array(["user"] * len(texts))), Texts(pa.array(texts)))
    raw = out.tobytes()
    assert list(chat.read_back(raw.decode())) == [("user", t) for t in texts]
    assert [chat.unescape(raw[x:y].decode()) for x, y in zip(a, b)] == texts


def test_reading_a_very_long_turn_takes_little_more_than_its_text():
    import tracemalloc
    text = "one < two \\ ### three </turn> " * 600_000
    out = chat.assemble(Texts(pa.array(["assistant"])), Texts(pa.array([text])))[0].tobytes().decode()
    tracemalloc.start()
    (turn,) = chat.read_back(out)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert turn == ("assistant", text) and peak < 8 * len(text)
