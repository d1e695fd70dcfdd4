"""Files with line breaks in quoted cells, read by many tasks, against pandas."""

import io
import os
import random

import pandas as pd
import pytest
from hypothesis import given, settings, strategies as st

from conftest import write
from wattline.sources import delimited, records
from wattline.sources.delimited import load_all_data


def pandas_rows(text, sep=";"):
    frame = pd.read_csv(io.StringIO(text, newline=""), sep=sep, dtype=str, keep_default_na=False)
    return [tuple(v if v != "" else None for v in r) for r in frame.values.tolist()]


@pytest.fixture()
def small_blocks(spark):
    """Splits of so many bytes."""
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    was = [spark.conf.get(k) for k in keys]

    def use(n):
        spark.conf.set(keys[0], str(n))
        spark.conf.set(keys[1], "1")

    yield use
    for k, v in zip(keys, was):
        spark.conf.set(k, v)


def quoted_file(seed, rows=80, end="\n"):
    rng = random.Random(seed)
    cells = ["plain", 'a "quote"', "two\nlines", "three\n\nlines\n", "semi;colon", "", 'ends "', '"', "é ü", "x" * 150, "\n" * 40]
    out = ["name;note;n"]
    for i in range(rows):
        if rng.random() < 0.1:
            out.append("")                                        # a blank line between records
        cell = rng.choice(cells).replace("\n", end)
        wrapped = '"' + cell.replace('"', '""') + '"' if rng.random() < 0.9 or any(c in cell for c in ';"\n') else cell
        name = rng.choice(["row", '"r;"'])
        out.append(f"{name};{wrapped};{i}")
    return end.join(out) + rng.choice(["", end])


@pytest.mark.parametrize("seed,block,end", [(1, 150, "\n"), (3, 400, "\r\n"), (4, 1 << 20, "\n"), (5, 197, "\r\n")])
def test_quoted_line_breaks_over_many_blocks(spark, workdir, small_blocks, seed, block, end):
    text = quoted_file(seed, end=end)
    write(os.path.join(workdir, "q.csv"), text)
    write(os.path.join(workdir, "plain.csv"), "p;q\n1;2\n3;\n")
    small_blocks(block)
    got = load_all_data(spark, workdir)
    mine = got.where("source_file = 'q.csv'").orderBy("_ordinal").collect()
    assert [(r["name"], r["note"], r["n"]) for r in mine] == pandas_rows(text)
    assert len({r["_ordinal"] for r in mine}) == len(mine)
    if block < 160:
        assert len({r["_block_start"] for r in mine}) > 10
    assert sorted(tuple(r) for r in got.where("source_file = 'plain.csv'").select("p", "q").collect()) == [("1", "2"), ("3", None)]


def test_one_stray_quote_leaves_the_file_parallel(spark, workdir, small_blocks):
    """A quote inside a cell opens nothing: later lines stay records of their own, parsed block by block."""
    text = "size;n\n" + "".join(f'{i}{chr(34) if i == 50 else ""} inch;{i}\n' for i in range(400))
    write(os.path.join(workdir, "stray.csv"), text)
    small_blocks(256)
    got = load_all_data(spark, workdir)
    rows = got.orderBy("_ordinal").collect()
    assert [(r["size"], r["n"]) for r in rows] == pandas_rows(text)
    assert got.rdd.getNumPartitions() > 10 and len({r["_block_start"] for r in rows}) > 10


def test_a_cell_and_a_header_over_several_blocks(spark, workdir, small_blocks):
    long = "\n".join(f"line {i}" for i in range(200))
    text = f'"he\n\nad";b\n1;"{long}"\n2;x\n"{long}";3\n'
    write(os.path.join(workdir, "long.csv"), text)
    small_blocks(200)
    with pytest.raises(ValueError, match="separator not detected"):
        load_all_data(spark, workdir)                 # the header is sniffed as a line
    write(os.path.join(workdir, "long.csv"), text.replace("he\n\nad", "head"))
    rows = load_all_data(spark, workdir).orderBy("_ordinal").collect()
    assert [(r["head"], r["b"]) for r in rows] == [("1", long), ("2", "x"), (long, "3")]


def test_order_over_files_and_blocks(spark, workdir, small_blocks):
    for name, sep in (("b.csv", ";"), ("a.csv", ","), ("c.xls", "\t"), ("a.b.csv", ";")):
        write(os.path.join(workdir, name), f"n{sep}m\n" + "".join(f"{i}{sep}{name}\n" for i in range(150)))
    small_blocks(200)
    rows = load_all_data(spark, workdir).orderBy("_ordinal").collect()
    names = sorted(["b.csv", "a.csv", "c.xls", "a.b.csv"])
    assert [(r["source_file"], r["n"]) for r in rows] == [(f, str(i)) for f in names for i in range(150)]
    assert len({r["_ordinal"] for r in rows}) == 600 and all(r["m"] == r["source_file"] for r in rows)


def test_one_driver_row_per_class(spark, workdir, monkeypatch):
    for i in range(60):
        write(os.path.join(workdir, f"f{i:02d}.csv"), ("a;b\n1;2\n", "a,c\n3,4\n", "a;b\n")[i % 3])
    seen = []
    was = delimited._frame
    monkeypatch.setattr(delimited, "_frame", lambda records, classes: (seen.append(classes), was(records, classes))[1])
    got = load_all_data(spark, workdir)
    assert got.count() == 40 and [c[1:] for c in seen[0]] == [(";", ["a", "b"]), (",", ["a", "c"])]


def test_errors_name_their_files(spark, workdir):
    write(os.path.join(workdir, "ok.csv"), "a;b\n1;2\n")
    write(os.path.join(workdir, "empty.csv"), "")
    write(os.path.join(workdir, "one.csv"), "only\n1\n")
    with pytest.raises(ValueError, match=r"empty.csv: empty file; .*one.csv: separator not detected"):
        load_all_data(spark, workdir)


@given(st.text('ab";\r\n', max_size=30), st.booleans())
@settings(max_examples=300, deadline=None)
def test_state_of_a_line_is_found_piece_by_piece(text, inside):
    """Cutting a text at its line ends and going on with the state gives the same as pandas' tokenizer states."""
    state = inside
    for line in text.replace("\r", "\n").split("\n"):
        state = records.end_state(line, state, ";")
    want, field = ("quoted" if inside else "start"), None
    for c in text.replace("\r", "\n") + "":
        if want == "quoted":
            want = "closing" if c == '"' else "quoted"
        elif want == "closing":
            want = "quoted" if c == '"' else "start" if c in ";\n" else "cell"
        elif want == "start":
            want = "quoted" if c == '"' else "start" if c in ";\n" else "cell"
        else:
            want = "start" if c in ";\n" else "cell"
    assert state == (want == "quoted")
