from wattline.functions.names import clean_colname, cleaned_headers, simple_rename
from wattline.contracts import CONSUMPTION_COLUMNS, CONSUMPTION_HEADERS


def test_clean_pairs():
    pairs = {"Périmètre": "perimetre", "Taux de Co2": "taux_de_co2", "Prévision J-1": "prevision_j_1",
             "Fioul - TAC": "fioul_tac", "P?rim?tre": "perimetre", "  A  ": "a", "__x__": "x",
             "P�rim�tre": "perimetre", 12: "12"}
    for raw, want in pairs.items():
        assert clean_colname(raw) == want


def test_duplicate_headers_positional():
    assert cleaned_headers(["a", "a", ""]) == ["a", "a_1", "unnamed_2"]


def test_simple_rename_keeps_accents():
    assert simple_rename("Prévision_J_1") == "prévision_j_1"
    assert simple_rename(" Fioul-TAC ") == "fioul_tac"
    assert len(CONSUMPTION_COLUMNS) == len(CONSUMPTION_HEADERS) == 40
    assert CONSUMPTION_COLUMNS[0] == "périmètre"
