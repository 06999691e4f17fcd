"""Predicates over typed text, as Column expressions."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Texts that stand for no value; words of truth.
PLACEHOLDERS = ("null", "none", "n/a", "")
TRUE_WORDS = ("TRUE", "1", "YES", "Y")


def any_of(parts: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a | b, parts, F.lit(False))


def all_of(parts: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, parts, F.lit(True))


def not_placeholder(c: Column) -> Column:
    """More than one character and none of the texts that stand for nothing."""
    t = F.trim(c)
    return ~F.lower(t).isin(*PLACEHOLDERS) & (F.length(t) > 1)


def truthy(c: Column) -> Column:
    return F.coalesce(F.upper(F.trim(c)).isin(*TRUE_WORDS), F.lit(False))


def company_bucket(name: Column) -> Column:
    """The slice of a company by its first character: a letter, 0-9 or other."""
    first = F.upper(F.substring(F.trim(name), 1, 1))
    return F.when(first.rlike("^[A-Z]$"), first).when(first.rlike("^[0-9]$"), "0-9").otherwise("other")


def in_list(csv: Column, value: str) -> Column:
    """Membership in a text list joined by commas; blanks around items and case don't matter."""
    items = F.transform(F.split(F.lower(csv), ","), lambda x: F.trim(x))
    return F.coalesce(F.array_contains(items, value.strip().lower()), F.lit(False))


def mentions(texts: Sequence[Column], term: str) -> Column:
    """Any of the texts holds the term, whatever its case."""
    return any_of([F.coalesce(F.contains(F.lower(t), F.lit(term.lower())), F.lit(False)) for t in texts])


def has_word(text: Column, word: str) -> Column:
    """A single word as a word, a phrase as a part of the text."""
    if " " in word.strip():
        return mentions([text], word)
    return F.coalesce(F.lower(text).rlike(r"(^|[^a-z0-9])\Q" + word.strip().lower() + r"\E($|[^a-z0-9])"), F.lit(False))


def place_is(place: Column, wanted: str) -> Column:
    """A short code in capitals as a token, '' as no place, 'Location' as 'n locations', others as a part."""
    if wanted == "":
        return place.isNull() | (F.trim(place) == "")
    if wanted == "Location":
        return F.coalesce(place.rlike(r"[0-9]+\s+[Ll]ocations"), F.lit(False))
    if len(wanted) <= 3 and wanted.isupper():
        return F.coalesce(place.rlike(rf"(^|[^A-Za-z]){wanted}($|[^A-Za-z])"), F.lit(False))
    return mentions([place], wanted)


def remote_or_place(place: Column, remote: bool | None, places: Sequence[str]) -> Column:
    """remote None: the places alone; True: remote or one of the places; False: not remote and one of the places."""
    is_remote = mentions([place], "remote")
    here = any_of([place_is(place, p) for p in places]) if places else F.lit(True)
    if remote is None:
        return here
    return (is_remote | here if places else is_remote) if remote else ~is_remote & here
