"""Column-name rules (schema metadata only; no rows are touched).

Both rules walk a header once and ask a table-driven rule what each
character becomes; neither touches data.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterable

# Characters that stand for an accent lost in decoding, and what they are read as.
LOST_ACCENTS = {"?": "e", "\ufffd": "e"}
# What the table layer writes for characters it does not keep.
TABLE_SPELLING = {" ": "_", "-": "_", "?": "e"}

_KEPT = frozenset("abcdefghijklmnopqrstuvwxyz0123456789")


def _plain_characters(header: str) -> Iterable[str]:
    """The ASCII characters a header is made of: accents are taken off their letters, other scripts vanish."""
    for char in header:
        yield from (c for c in unicodedata.normalize("NFKD", LOST_ACCENTS.get(char, char)) if c.isascii())


def clean_colname(name) -> str:
    """ASCII snake-case name for a raw header (PRJ-01): its words of letters and digits, joined by '_'."""
    words = [""]
    for char in _plain_characters(str(name)):
        if char.lower() in _KEPT:
            words[-1] += char.lower()
        elif words[-1]:
            words.append("")
    return "_".join(filter(None, words))


def simple_rename(name: str) -> str:
    """Table-layer name (PRJ-03): `TABLE_SPELLING` for each character, lower case, accents kept."""
    return "".join(TABLE_SPELLING.get(char, char) for char in name.strip()).lower()


def positional_headers(fields: list) -> list[str]:
    """Raw header cells to unique names, by position.

    An empty cell at position i is named 'Unnamed: i'; a repeated name gets
    '.1', '.2', ... in order of appearance (the same spelling a pandas reader
    produces), so that cleaning later yields 'a', 'a_1', 'unnamed_2'.
    """
    out: list[str] = []
    seen: dict[str, int] = {}
    for i, cell in enumerate(fields):
        base = cell if cell not in (None, "") else f"Unnamed: {i}"
        name = base
        while name in seen:
            seen[base] += 1
            name = f"{base}.{seen[base]}"
        seen.setdefault(name, 0)
        out.append(name)
    return out


def cleaned_headers(fields: list) -> list[str]:
    """`positional_headers` followed by `clean_colname`."""
    return [clean_colname(n) for n in positional_headers(fields)]
