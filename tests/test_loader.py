import os

import pytest

from conftest import write
from wattline.sources.delimited import list_files, load_all_data, sniff

HEAD = "Périmètre\tNature\tDate\tHeures\tConsommation"


def _f1(path):
    rows = [HEAD,
            "France\tDéf\t2012-01-01\t00:00\t58315\t",   # trailing delimiter on the first data line
            "France\tDéf\t2012-01-01\t00:15\t",
            "France\tDéf\t2012-01-01\t00:30\tND",
            "",
            "France\tDéf\t2012-01-01\t01:00\tND",
            "France\tDéf\t2012-01-01\t01:30\t57231",
            "France\tDéf\t07/01/2012\t02:00\t1e3",
            "France\tDéf\t\t03:00\t1",
            "France\tDéf\t2012-13-01\t00:00\t1",
            "France\tDéf\t2012-01-02\t00:00",                 # short row
            "France\tDéf\t2012-01-02\t00:30\tNA"]
    write(path, "\n".join(rows) + "\n")


def test_load_f1(spark, workdir):
    _f1(os.path.join(workdir, "d", "a.xls"))
    df = load_all_data(spark, os.path.join(workdir, "d"))
    assert [c for c in df.columns if not c.startswith("_")] == \
        ["perimetre", "nature", "date", "heures", "consommation", "source_file"]
    rows = df.orderBy("_row_id").collect()
    assert len(rows) == 10                       # blank line skipped
    assert rows[0]["consommation"] == "58315"    # surplus trailing field cut
    assert rows[1]["consommation"] is None       # empty cell
    assert rows[2]["consommation"] == "ND"       # sentinel kept as text at load
    assert rows[8]["consommation"] is None       # padded
    assert rows[9]["consommation"] is None       # 'NA' null token
    assert rows[6]["date"] is None
    assert rows[0]["nature"] == "Déf"            # Latin-1 decoded
    assert {r["source_file"] for r in rows} == {"a.xls"}


def test_separator_choice_and_filters(spark, workdir):
    d = os.path.join(workdir, "d")
    write(os.path.join(d, "a.xls"), "x\ty;z\tw\n1\t2\t3\n")       # tab: 3 columns beats ';': 2
    write(os.path.join(d, "b.csv"), "p;q\n1;2\n")
    write(os.path.join(d, "c.CSV"), "p,r\n3,4\n")
    write(os.path.join(d, "tie.csv"), "a;b,c\n1;2,3\n")           # 2 columns either way: ';' wins
    write(os.path.join(d, "notes.txt"), "ignored\n")
    write(os.path.join(d, "sub", "x.csv"), "s;t\n1;2\n")
    files = [os.path.basename(p) for p in list_files(spark, d)]
    assert files == ["a.xls", "b.csv", "c.CSV", "tie.csv"]
    plan = {os.path.basename(p["path"]): p for p in sniff(spark, list_files(spark, d))}
    assert plan["a.xls"]["sep"] == "\t"
    assert plan["b.csv"]["sep"] == ";"
    assert plan["c.CSV"]["sep"] == ","
    assert plan["tie.csv"]["sep"] == ";"
    df = load_all_data(spark, d)
    assert df.count() == 4
    assert set(df.columns) >= {"x", "y_z", "w", "p", "q", "r", "a", "b_c", "source_file"}


def test_ragged_rules_out_separator(spark, workdir):
    d = os.path.join(workdir, "d")
    # ',' gives 2 header columns but a later line has 4 fields: ruled out; ';' gives 2 too but is valid
    write(os.path.join(d, "ragged.csv"), "a;b,c\n1;2\n3,4,5,6;7\n")
    plan = sniff(spark, list_files(spark, d))
    assert plan[0]["sep"] == ";"


def test_one_column_is_error(spark, workdir):
    d = os.path.join(workdir, "d")
    write(os.path.join(d, "one.csv"), "only\n1\n2\n")
    with pytest.raises(ValueError, match="separator not detected"):
        load_all_data(spark, d)


def test_duplicate_header(spark, workdir):
    d = os.path.join(workdir, "d")
    write(os.path.join(d, "dup.csv"), "a;a;\n1;2;3\n")
    df = load_all_data(spark, d)
    assert [c for c in df.columns if not c.startswith("_")][:3] == ["a", "a_1", "unnamed_2"]


def test_empty_and_missing_directory(spark, workdir):
    d = os.path.join(workdir, "empty")
    os.makedirs(d)
    assert load_all_data(spark, d).count() == 0
    with pytest.raises(FileNotFoundError):
        load_all_data(spark, os.path.join(workdir, "missing"))


def test_zipped_spreadsheet_is_reported(spark, workdir):
    import zipfile
    d = os.path.join(workdir, "d")
    os.makedirs(d)
    with zipfile.ZipFile(os.path.join(d, "real.xlsx"), "w") as z:
        z.writestr("xl/workbook.xml", "<workbook/>")
    with pytest.raises(ValueError, match="binary spreadsheet"):
        load_all_data(spark, d)


def test_quoted_cells_as_pandas_reads_them(spark, workdir):
    import pandas as pd
    cells = ['x ""y"" z', "back\\", "plain", 'a;b', "line one\nline two", "C:\\dir\\", '""', "end\\\\"]
    text = "name;note;n\n" + "".join(f'row{i};"{c}";{i}\n' for i, c in enumerate(cells))
    write(os.path.join(workdir, "a+b.csv"), text)
    write(os.path.join(workdir, "comma.csv"), 'p,q\n1,"x, y"\n2,z\n')
    got = load_all_data(spark, workdir)
    want = pd.read_csv(os.path.join(workdir, "a+b.csv"), sep=";", dtype=str, encoding="latin-1", keep_default_na=False)
    rows = got.where("source_file = 'a+b.csv'").select("name", "note", "n").collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, want.values.tolist()))
    assert sorted(map(tuple, got.where("source_file = 'comma.csv'").select("p", "q").collect())) == [("1", "x, y"), ("2", "z")]


def test_header_after_many_blank_bytes(spark, workdir):
    write(os.path.join(workdir, "late.csv"), "\n" * (17 << 20) + "a;b\n1;2\n")
    assert [tuple(r) for r in load_all_data(spark, workdir).select("a", "b").collect()] == [("1", "2")]
