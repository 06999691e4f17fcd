"""Folding of text for comparison."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F


def _plain_letters() -> tuple[str, str]:
    """Accented Latin letters and, at the same places, their base letters, by Unicode's decomposition."""
    pairs = [(chr(c), unicodedata.normalize("NFKD", chr(c))[0]) for c in [*range(0xC0, 0x250), *range(0x1E00, 0x1F00)]]
    pairs = [(a, b) for a, b in pairs if b != a and b.isascii() and b.isalpha()]
    return "".join(a for a, _ in pairs), "".join(b for _, b in pairs)


ACCENTED, PLAIN = _plain_letters()
COMBINING = "[\\u0300-\\u036f]"


def fold(c: Column) -> Column:
    """Lower case, without accents."""
    c = F.lower(F.translate(c, ACCENTED, PLAIN))
    for a, b in (("ß", "ss"), ("æ", "ae"), ("œ", "oe"), ("ø", "o"), ("đ", "d"), ("ł", "l")):
        c = F.replace(c, F.lit(a), F.lit(b))
    return F.regexp_replace(c, COMBINING, "")


def tokens(c: Column) -> Column:
    """The runs of letters and digits of a folded text; empty for null."""
    return F.coalesce(F.filter(F.split(c, r"[^\p{L}\p{N}]+"), lambda x: x != ""), F.array().cast("array<string>"))
