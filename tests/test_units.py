"""Pay texts against hand-computed values, and the whole table against a plain Python reading."""

import re
from decimal import ROUND_HALF_UP, Decimal

import pytest

from tallyforge.operators.units import CURRENCIES, PERIODS, pay_ambiguous, pay_flagged, pay_found, pay_readings, units

S = "job_uid string, salary_min long, salary_max long, salary_currency string, salary_period string, compensation string"
F = "unit_kind string, unit_code string, factor double"
FACTORS = [("period", "year", 1.0), ("period", "hour", 2080.0), ("period", "month", 12.0), ("period", "fortnight", 26.0), ("currency", "USD", 1.0), ("currency", "CAD", 0.7315), ("currency", "INR", 0.0119), ("currency", "JPY", 0.0068), ("currency", "EUR", 1.0875)]
CASES = [
    ((47, None, "$", "annually", "from $47k per annum plus 10% bonus"), (47000, 47000)),
    ((None, None, "C$", None, "Pay: $30.50 to 42.25 per hour, 401k match"), (46406, 64284)),
    ((None, None, None, None, "$401k to 548k p.a."), (401000, 548000)),
    ((38, 44, "unknown", "year", "₹38-44.5 LPA"), (45220, 52955)),
    ((None, None, None, None, "年収900万〜1315万円"), (61200, 89420)),
    ((1810, 2090, "€", "month", "EUR 1.810 to EUR 2.090 every two weeks"), (51178, 59095)),
    ((29, 42, "EUR", "hour", "29,50-42,25 (40 hours)"), (66729, 95570)),
    ((60000, 50000, "USD", "YR", None), (50000, 60000)),
    ((None, 50000, "usd", " Annual ", "Negotiable"), (50000, 50000)),
    ((50000, 60000, "USD", "unknown", "Competitive"), None),
    ((50000, 60000, None, "year", None), None),
    ((None, None, "USD", "year", "401k and health plan"), None),
    ((None, None, "USD", "year", ""), None),
    ((58, 79, "usd", "annual", "58.000 to 79.000"), (58000, 79000)),
]


@pytest.mark.parametrize("case", range(len(CASES)))
def test_cases(make, case):
    row, want = CASES[case]
    got = pay_found(make(S, ("j", *row)), make(F, *FACTORS)).collect()
    assert [(r.min_usd_year, r.max_usd_year) for r in got] == ([want] if want else [])


def test_repeats_nulls_and_empty(make):
    f = make(F, *FACTORS)
    rows = [("a", 1, 2, "USD", "year", None)] * 2 + [(None, 1, 2, "USD", "year", None), ("b", 1, 2, "USD", "year", "x" * 50_000)]
    assert pay_found(make(S, *rows), f).count() == 2
    assert pay_found(make(S), f).count() == 0
    assert pay_found(make(S, *rows), make(F)).count() == 0


def test_other_columns_stay(make):
    df = make(S + ", _x int, lo2 string", ("a", 1, 2, "USD", "year", None, 7, "k"))
    r = pay_readings(df).first()
    assert (r["_x"], r["lo2"], r["lo"]) == (7, "k", 1)


def test_ambiguous_is_flagged(make):
    r = pay_readings(make(S, ("a", 58, 79, "usd", "annual", "58.000 to 79.000"), ("b", 58000, 79000, "usd", "annual", "58.000 to 79.000"))).collect()
    assert {x.job_uid: x.ambiguous for x in r} == {"a": True, "b": False}


@pytest.mark.parametrize(("cols", "text", "want"), [
    ((900, 1200), "$900 to 1.2k a year", (900, 1200)), ((None, None), "$900 to 1.2k a year", (900, 1200)), ((47, 58), "$47k to 58 a year", (47000, 58000)),
    ((None, None), "$47k to 58 a year", (47000, 58000)), ((47000, 58000), "$47-58k a year", (47000, 58000)), ((None, None), "$47k to 58000 a year", (47000, 58000)),
    ((900, 900000), "$900 to 900k a year", (900, 900000)), ((None, None), "$47k a year", (47000, 47000)),
])
def test_scale_of_one_side(make, cols, text, want):
    r = pay_readings(make(S, ("j", *cols, "USD", "year", text))).first()
    assert (int(r.lo), int(r.hi), r.ambiguous) == (*want, False)


def test_flagged(make):
    rows = [("a", 58, 79, "usd", "annual", "58.000 to 79.000"), ("b", 58000, 79000, "usd", "annual", None)]
    assert sorted(tuple(r) for r in pay_flagged(make(S, *rows), make(F, *FACTORS)).collect()) == [("a", 58000, 79000, True, True), ("b", 58000, 79000, False, False)]


@pytest.mark.parametrize(("row", "want"), [
    # columns by the hour though they say year; a text without a period by the hour though the columns say year
    ((50, 60, "USD", "year", "$104,000 - $124,800"), ("year", 104000, 124800, 0.0, True, False)), ((83200, 104000, "USD", "year", "$40 - $50"), ("hour", 40, 50, 0.0, True, False)),
    ((62400, 62400, "USD", "year", "$30 per hour"), ("hour", 30, 30, 0.0, False, False)), ((22, 28, "usd", "hour", "US$22.50 to 28.25 per hour"), ("hour", 22.5, 28.25, 0.0314, False, False)),
    ((40, 50, "CAD", "hour", "EUR 40 - 50 per hour"), ("hour", 40, 50, 0.0, True, False)), ((58, 79, "usd", "annual", "58.000 to 79.000"), ("year", 58000, 79000, 0.0, False, True)),
])
def test_combination_of_least_residual(make, row, want):
    r = pay_readings(make(S, ("j", *row)), units(make(F, *FACTORS))).first()
    assert (r.period, float(r.lo), float(r.hi), round(r.residual, 4) + 0.0, r.departs, r.ambiguous) == want


def test_solutions_that_are_not_unique(make):
    rows = [("a", 58, 79, "usd", "annual", "58.000 to 79.000"), ("b", 58000, 79000, "usd", "annual", "58,000 to 79,000"), ("c", 50, 60, "USD", "year", "$104,000 - $124,800"), ("d", None, None, "USD", None, "$5")]
    got = {r.job_uid: (r.departs, r.ambiguous) for r in pay_ambiguous(make(S, *rows), make(F, *FACTORS)).collect()}
    assert got == {"a": (False, True), "c": (True, False)}


def _plain(row, factors):
    """A plain reading: figures by a tokenizer, units by first mention."""
    lo, hi = row.salary_min, row.salary_max
    code = lambda ways, x: next((k for k, v in ways.items() if (x or "").strip().lower() in v), None)
    cur, per = code(CURRENCIES, row.salary_currency), code(PERIODS, row.salary_period)
    text = re.sub(r"401k (match|and)|\(40 hours\)|after \d+ months|\d+% bonus", " ", (row.compensation or "").lower())
    nums = re.findall(r"(\d{1,3}(?:[ ,.']\d{3})+(?:\.\d{1,2})?|\d+(?:[.,]\d{1,2})?)\s*(k\b|万)?", text)
    if nums:
        each = 100_000 if re.search("lakh|lpa", text) else None
        vals = []
        for n, s in nums:
            m = re.search(r"[.,](\d{1,2})$", n)
            whole = re.sub(r"\D", "", n[: m.start()] if m else n)
            vals.append(Decimal(whole + ("." + m[1] if m else "")) * (each or {"k": 1000, "万": 10_000}.get(s or nums[-1][1], 1)))
        lo, hi = vals[0], vals[-1]
        signs = re.findall(r"us\$|ca\$|au\$|mx\$|[ca]\$|[$€£₹¥]|\b(?:usd|eur|gbp|cad|aud|inr|jpy|chf|mxn|rs)\b", text)
        if signs:
            cur = cur if signs[0] == "$" and cur in ("CAD", "AUD") else code(CURRENCIES, signs[0])
        elif "万円" in text:
            cur = "JPY"
        for p, words in (("fortnight", ("every two weeks", "weekly bi", "bi-weekly", "fortnight")), ("hour", ("hour", "/hr", "p/h")), ("day", ("day", "daily")), ("week", ("week", "/wk", "p.w")), ("month", ("a month", "per month", "/month", "monthly", "pcm")), ("year", ("year", "/yr", "annum", "annually", "p.a", "lpa", "年収"))):
            if any(w in text for w in words):
                per = p
                break
    if lo is None and hi is None or not cur or not per:
        return None
    lo, hi = (lo if lo is not None else hi), (hi if hi is not None else lo)
    f = factors["period", per] * factors["currency", cur]
    usd = [int((Decimal(x) * f).quantize(Decimal(1), ROUND_HALF_UP)) for x in (lo, hi)]
    return min(usd), max(usd)


def test_whole_table_against_plain_reading(spark):
    d = "/root/testdata/sf0.01"
    jobs, factors = spark.read.parquet(f"{d}/jobs_llm_enriched.parquet"), spark.read.parquet(f"{d}/unit_factors.parquet")
    f = {(r.unit_kind, r.unit_code): Decimal(str(r.factor)) for r in factors.collect()}
    want = {r.job_uid: x for r in jobs.collect() if (x := _plain(r, f))}
    got = {r.job_uid: (r.min_usd_year, r.max_usd_year) for r in pay_found(jobs, factors).collect()}
    assert got == want
