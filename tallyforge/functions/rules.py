"""Ordered rewriting rules that both Spark and the SQL oracle can run.

A rule is (pattern, replacement); patterns keep to what Java and RE2 have in common, so
one list serves the Column builder and the oracle's SQL alike.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

Rule = tuple[str, str]


def rewrite(c: Column, rules: Iterable[Rule]) -> Column:
    """c with every rule applied in order; groups in replacements are written \\1."""
    return reduce(lambda x, r: F.regexp_replace(x, r[0], r[1].replace("$", "\\$").replace("\\1", "$1").replace("\\2", "$2")), rules, c)


def rewrite_sql(expr: str, rules: Iterable[Rule]) -> str:
    return reduce(lambda x, r: f"regexp_replace({x}, {quote(r[0])}, {quote(r[1])}, 'g')", rules, expr)


def replace_all(c: Column, pairs: Iterable[Rule]) -> Column:
    return reduce(lambda x, p: F.replace(x, F.lit(p[0]), F.lit(p[1])), pairs, c)


def replace_all_sql(expr: str, pairs: Iterable[Rule]) -> str:
    return reduce(lambda x, p: f"replace({x}, {quote(p[0])}, {quote(p[1])})", pairs, expr)


def first_match(c: Column, cases: Sequence[Rule], otherwise: Column) -> Column:
    """The value of the first pattern that is found in c."""
    return F.coalesce(*[F.when(c.rlike(p), F.lit(v)) for p, v in cases], otherwise)


def first_match_sql(expr: str, cases: Sequence[Rule], otherwise: str) -> str:
    return "CASE " + " ".join(f"WHEN regexp_matches({expr}, {quote(p)}) THEN {quote(v)}" for p, v in cases) + f" ELSE {otherwise} END"


def quote(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"
