"""Quantities recorded in different units, brought to one unit.

The physical identity here is: yearly US dollars = amount x scale x periods per year
x US dollars per currency unit. It holds for the columns and for the text alike, so both
sides must give the same pay. The unknowns of a row are how the text's figures are read (a
separator that may group thousands or mark decimals, a scale word on one side of a range
only), the scale of the columns, the periods and the currencies of text and columns. Their
combinations are enumerated, and the one of least log residual holds. A unit that is
stated may be departed from, one at a time, but that costs DEPARTURE, so that it happens
only where what is stated is off by more than that and another unit fits. Combinations
that fit equally well but give another pay are flagged, and the usual reading of the format
is taken, as it is without columns to hold against: of the scales of a range the one that
brings its sides nearest to one another. Where unit and figure stand in the text, they
outrank the columns. A period or currency that is stated nowhere is not made up.
"""

from __future__ import annotations

import math
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Ways to write a currency, a period and a scale.
CURRENCIES = {
    "USD": ("usd", "us$", "us dollar", "us dollars", "$", "dollar", "dollars"),
    "EUR": ("eur", "€", "euro", "euros"),
    "GBP": ("gbp", "£", "pound sterling", "pounds sterling", "pound", "pounds", "sterling"),
    "CAD": ("cad", "ca$", "c$", "canadian dollar", "canadian dollars"),
    "AUD": ("aud", "au$", "a$", "australian dollar", "australian dollars"),
    "INR": ("inr", "₹", "rs", "rs.", "rupee", "rupees", "indian rupee", "indian rupees"),
    "JPY": ("jpy", "¥", "yen", "japanese yen", "円"),
    "CHF": ("chf", "fr.", "fr", "sfr", "swiss franc", "swiss francs"),
    "MXN": ("mxn", "mx$", "mexican peso", "mexican pesos"),
}
PERIODS = {
    "year": ("year", "yearly", "yr", "annual", "annually", "per year", "per annum", "p.a.", "pa", "/yr", "/year", "a year"),
    "month": ("month", "monthly", "mth", "per month", "pcm", "p.m.", "pm", "/month", "/mth", "a month"),
    "fortnight": ("fortnight", "fortnightly", "biweekly", "bi-weekly", "every two weeks", "per fortnight", "a fortnight"),
    "week": ("week", "weekly", "wk", "pw", "p.w.", "per week", "/week", "/wk", "a week"),
    "day": ("day", "daily", "day rate", "daily rate", "per day", "/day", "a day", "per diem"),
    "hour": ("hour", "hourly", "hr", "/h", "/hr", "/hour", "p/h", "ph", "per hour", "an hour"),
}
#: Patterns of a period in running text, the more special first.
PERIOD_IN_TEXT = (
    ("fortnight", r"every two weeks|bi-?weekly|fortnight"),
    ("hour", r"\bhourly|(?:\b(?:per|an|a)\s+|/\s*)h(?:ou)?r\b|\bp/h\b|/h\b|時給"),
    ("day", r"\bdaily|\bday rate|(?:\b(?:per|a)\s+|/\s*)day\b|日給"),
    ("week", r"\bweekly|(?:\b(?:per|a)\s+|/\s*)w(?:ee)?k\b|\bp\.?\s?w\b"),
    ("month", r"\bmonthly|(?:\b(?:per|a)\s+|/\s*)m(?:on)?th\b|\bpcm\b|\bp\.m\.|月給"),
    ("year", r"\bannual|\byearly|(?:\b(?:per|a)\s+|/\s*)y(?:ea)?r\b|\bper annum\b|\bp\.?\s?a\b|\blpa\b|年収"),
)
#: Figures that aren't pay: hours, months until a review, shares, a pension plan.
NOT_PAY = r"401\s?\(?k\)?\s+(?:match|plan|and|matching)\b|\d+(?:[.,]\d+)?\s*%|\(\s*\d+\s*hours?\s*\)|\b\d+\s*(?:hours?|months?)\b(?!\s*[-–])"
NUMBER = "\\d{1,3}(?:[ ,.'\u2019\u00a0\u202f]\\d{3})+(?:[.,]\\d{1,2})?(?!\\d)|\\d+(?:[.,]\\d{1,3})?"
CURRENCY_IN_TEXT = r"us\$|ca\$|au\$|mx\$|c\$|a\$|\$|€|£|₹|¥|円|\b(?:usd|eur|gbp|cad|aud|inr|jpy|chf|mxn)\b|\brs\b\.?|\bfr\."
SCALE = r"k\b|万|lakhs?\b|lpa\b|crores?\b"
SCALES = (1, 1_000, 10_000, 100_000)
#: What a combination costs, as a log residual, that departs from a stated unit; residuals closer than EQUAL are equal.
DEPARTURE, EQUAL = 0.5, 1e-6


def _lookup(ways: dict[str, tuple[str, ...]]) -> Column:
    return F.create_map(*[F.lit(x) for code, names in ways.items() for n in names for x in (n, code)])


def currency_code(c: Column) -> Column:
    """The code that a currency column names, else null."""
    return F.element_at(_lookup(CURRENCIES), F.lower(F.trim(c)))


def period_code(c: Column) -> Column:
    return F.element_at(_lookup(PERIODS), F.lower(F.trim(c)))


def _period_in(text: Column) -> Column:
    return F.coalesce(*[F.when(text.rlike(p), code) for code, p in PERIOD_IN_TEXT])


def _usual(num: Column) -> Column:
    """The usual reading: a last separator before one or two digits marks decimals, any other groups."""
    whole = F.regexp_replace(F.regexp_replace(num, r"[.,]\d{1,2}$", ""), r"\D", "")
    part = F.regexp_extract(num, r"[.,](\d{1,2})$", 1)
    return F.concat(whole, F.when(part != "", F.concat(F.lit("."), part)).otherwise("")).try_cast("decimal(20,4)")


def _other(num: Column) -> Column:
    """The unusual reading of a number with one separator before three digits: decimals."""
    return F.when(num.rlike(r"^\d{1,3}[.,]\d{3}$"), F.regexp_replace(num, ",", ".").try_cast("decimal(20,4)"))


def _scale(word: Column) -> Column:
    w = F.lower(word)
    return (
        F.when(w == "k", 1_000).when(w == "万", 10_000).when(w.startswith("lakh") | (w == "lpa"), 100_000)
        .when(w.startswith("crore"), 10_000_000).otherwise(1).cast("decimal(10,0)")
    )


def units(factors: DataFrame) -> dict[str, dict[str, Decimal]]:
    """Periods per year and dollars per unit of the codes that are known here, so of no more than those."""
    known = factors.filter(F.col("unit_code").isin(*PERIODS, *CURRENCIES) & F.col("factor").isNotNull()).groupBy("unit_kind", "unit_code").agg(F.max("factor").cast("decimal(18,8)").alias("f"))
    out: dict[str, dict[str, Decimal]] = {"period": {}, "currency": {}}
    for r in known.collect():
        out.setdefault(r.unit_kind, {})[r.unit_code] = r.f
    return out


def _factor(codes: dict[str, Decimal], code: Column) -> Column:
    """The factor of a code, null for one without."""
    if not codes:
        return F.lit(None).cast("decimal(18,8)")
    return F.element_at(F.create_map(*[F.lit(x).cast("decimal(18,8)") if isinstance(x, Decimal) else F.lit(x) for cf in codes.items() for x in cf]), code)


def _logs(codes: dict[str, Decimal], code: Column) -> Column:
    """The log of a code's factor, 0 for one without."""
    return F.coalesce(F.element_at(F.create_map(*[F.lit(x) for c, f in codes.items() for x in (c, math.log(f))]), code), F.lit(0.0)) if codes else F.lit(0.0)


def _combinations(known: dict[str, dict[str, Decimal]]) -> Column:
    """Every (ln, departs, period) of a row: the log of text units over column units, whether a stated unit is departed from, and the period of the text.

    __pay_lp and __pay_lq are the logs of the periods of text and columns, __pay_lx and
    __pay_ly those of their currencies; where one side states none, it has the other's.
    """
    tp, cp, tc, cc = (F.col(f"__pay_{x}") for x in ("tp", "cp", "tc", "cc"))
    lp, lq, lx, ly = (F.col(f"__pay_l{x}") for x in "pqxy")
    p, q = F.coalesce(tp, cp), F.coalesce(cp, tp)
    one = lambda v, departs, period: F.struct(v.alias("ln"), F.lit(departs).alias("departs"), period.alias("period"))
    found = [one(lp + lx - lq - ly, False, p)]
    for code, f in known["period"].items():
        found.append(F.when(tp.isNull() & (cp != code), one(F.lit(math.log(f)) + lx - lq - ly, True, F.lit(code))))
        found.append(F.when(q != code, one(lp + lx - F.lit(math.log(f)) - ly, True, p)))
    found.append(F.when(tc != cc, one(lp - lq, True, p)))
    return F.filter(F.array(*found), lambda c: c.isNotNull())


def _residual(x: Column, y: Column, ln: Column) -> Column:
    """Least distance of the logs x and (if it's there) y, in units apart by ln, to those of the columns x scale, null without them."""
    lo, hi = F.col("__pay_llo"), F.col("__pay_lhi")
    return F.least(*[F.abs(x + ln - lo - math.log(k)) + F.coalesce(F.abs(y + ln - hi - math.log(k)), F.lit(0.0)) for k in SCALES])


def _readings() -> Column:
    """Every reading (odd, later, x, y) of the figures n1 and n2 with scale words w1 and w2; odd counts unusual separators."""
    w1, w2, two = F.col("__pay_w1").isNotNull(), F.col("__pay_w2").isNotNull(), F.col("__pay_n2").isNotNull()
    f1, f2 = F.col("__pay_f1"), F.col("__pay_f2")
    # A scale word of one side may hold for the other as well.
    scales = ((True, F.when(two & w2 & ~w1, f2).otherwise(f1), F.when(w1 & ~w2, f1).otherwise(f2)), (two & (w1 != w2), f1, f2))
    found = []
    for later, (may, k1, k2) in enumerate(scales):
        for odd1, how1 in enumerate("ab"):
            for odd2, how2 in enumerate("ab"):
                a, b = F.col(f"__pay_{how1}1"), F.col(f"__pay_{how2}2")
                # Without a second figure, b is null in both ways.
                there = a.isNotNull() & (b.isNotNull() | (~two if odd2 == 0 else F.lit(False))) & may
                amount = lambda n, k: (n * k).cast("decimal(20,4)")
                found.append(F.when(there, F.struct(F.lit(odd1 + odd2).alias("odd"), F.lit(later).alias("later"), amount(a, k1).alias("x"), amount(b, k2).alias("y"))))
    return F.filter(F.array(*found), lambda r: r.isNotNull())


#: How the names of columns begin that only the functions below see.
OWN = "__pay_"


def pay_readings(df: DataFrame, known: dict[str, dict[str, Decimal]] | None = None) -> DataFrame:
    """df with what its pay columns and text say: lo, hi, currency, period (each null if it can't be told), residual, departs (a stated unit doesn't hold), ambiguous.

    A text states a figure if a number is left once hours, months, shares and pension
    plans are taken out; 'from x' and 'up to x' state one side, the missing side takes
    the other's value.
    """
    known = known or {"period": {}, "currency": {}}
    text = F.regexp_replace(F.lower(F.col("compensation")), NOT_PAY, " ")
    one = f"({CURRENCY_IN_TEXT})?\\s*({NUMBER})\\s*({SCALE})?\\s*({CURRENCY_IN_TEXT})?"
    both = f"(?s)^.*?{one}(?:\\s*(?:to|[-\u2013\u2014\u301c~])\\s*{one})?.*$"
    parts = F.when(text.rlike(NUMBER), F.split(F.regexp_replace(text, both, "|".join(f"${n}" for n in range(1, 9))), r"\|"))
    df = df.withColumns({"__pay_text": text, "__pay_p": parts})
    t, g = F.col("__pay_text"), (lambda n: F.nullif(F.get("__pay_p", F.lit(n - 1)), F.lit("")))
    df = df.withColumns({"__pay_c": F.coalesce(g(1), g(4), g(8), g(5)), "__pay_n1": g(2), "__pay_s1": F.coalesce(g(3), g(7)), "__pay_n2": g(6), "__pay_s2": g(7)})
    df = df.withColumns({"__pay_lo": F.least("salary_min", "salary_max"), "__pay_hi": F.greatest("salary_min", "salary_max")})  # either side alone counts for both
    stated = F.col("__pay_n1").isNotNull()
    df = df.withColumns({"__pay_w1": g(3), "__pay_w2": g(7)})
    df = df.withColumns({"__pay_f1": _scale(F.col("__pay_w1")), "__pay_f2": _scale(F.col("__pay_w2"))})
    df = df.withColumns({f"__pay_{k}{n}": how(F.col(f"__pay_n{n}")) for n in (1, 2) for k, how in (("a", _usual), ("b", _other))})
    sign, col_cur = F.col("__pay_c"), F.col("__pay_cc")
    lakh = F.when(stated & F.col("__pay_s1").rlike("lakh|lpa|crore"), "INR")
    man = F.when(stated & F.col("__pay_s1").rlike("万"), "JPY")
    df = df.withColumns({"__pay_cc": currency_code(F.col("salary_currency")), "__pay_cp": period_code(F.col("salary_period")), "__pay_tp": F.when(stated, _period_in(t))})
    text_cur = F.when(sign == "$", F.when(col_cur.isin("AUD", "CAD"), col_cur).otherwise("USD")).otherwise(currency_code(sign))
    df = df.withColumn("__pay_tc", F.when(stated, F.coalesce(text_cur, F.when(col_cur.isNull(), F.coalesce(lakh, man)))))
    lo, hi = F.col("__pay_lo"), F.col("__pay_hi")
    side = lambda codes, a, b: _logs(known[codes], F.coalesce(f"__pay_{a}", f"__pay_{b}"))
    ln = lambda c: F.when(c > 0, F.ln(c.cast("double")))
    df = df.withColumns({"__pay_lp": side("period", "tp", "cp"), "__pay_lq": side("period", "cp", "tp"), "__pay_lx": side("currency", "tc", "cc"), "__pay_ly": side("currency", "cc", "tc"), "__pay_llo": ln(lo), "__pay_lhi": ln(hi)})
    df = df.withColumns({"__pay_all": F.when(stated, _readings()), "__pay_ways": F.when(stated, _combinations(known))})
    df = df.withColumn("__pay_all", F.transform("__pay_all", lambda r: F.struct(r["odd"].alias("odd"), r["later"].alias("later"), r["x"].alias("x"), r["y"].alias("y"), ln(r["x"]).alias("lx"), ln(r["y"]).alias("ly"))))

    def fit(r: Column) -> Column:
        """The least costly combination for a reading."""
        cost = lambda w: F.struct((_residual(r["lx"], r["ly"], w["ln"]) + F.when(w["departs"], DEPARTURE).otherwise(0.0)).alias("far"), w["departs"].alias("departs"), w["period"].alias("period"))
        # Without columns to hold against, units are as stated.
        ways = F.when(F.col("__pay_llo").isNull(), F.slice("__pay_ways", 1, 1)).otherwise(F.col("__pay_ways"))
        return F.array_min(F.transform(ways, cost))

    df = df.withColumn("__pay_far", F.transform("__pay_all", lambda r: F.struct(fit(r).alias("w"), r.alias("r"))))
    df = df.withColumn("__pay_least", F.array_min(F.transform("__pay_far", lambda r: r["w"]["far"])))
    df = df.withColumn("__pay_tied", F.filter("__pay_far", lambda r: F.coalesce(r["w"]["far"] <= F.col("__pay_least") + EQUAL, F.lit(True))))
    apart = lambda r: F.coalesce(F.abs(F.ln(r["x"].cast("double")) - F.ln(r["y"].cast("double"))), F.lit(0.0))
    usual = F.array_min(F.transform("__pay_tied", lambda t: F.struct(t["r"]["odd"].alias("odd"), apart(t["r"]).alias("apart"), t["r"]["later"].alias("later"), t["r"]["x"].alias("x"), t["r"]["y"].alias("y"), t["w"].alias("w"))))
    df = df.withColumn("__pay_best", usual)
    sure = F.size(F.array_distinct(F.transform("__pay_tied", lambda t: F.struct(t["r"]["x"].alias("x"), t["r"]["y"].alias("y"), t["w"]["period"].alias("p"))))) <= 1
    departs = F.coalesce(F.col("__pay_best.w.departs"), F.lit(False))
    df = df.withColumns({
        "__pay_x": F.when(stated, F.col("__pay_best.x")).otherwise(lo.cast("decimal(20,4)")),
        "__pay_y": F.when(stated, F.coalesce("__pay_best.y", "__pay_best.x")).otherwise(hi.cast("decimal(20,4)")),
        "ambiguous": stated & F.col("__pay_least").isNotNull() & ~sure, "departs": stated & departs,
        "residual": F.when(stated, F.col("__pay_least") - F.when(departs, DEPARTURE).otherwise(0.0)),
    })
    drop = [c for c in df.columns if c.startswith(OWN)]
    return df.withColumns({
        "lo": F.least("__pay_x", "__pay_y"),  # least and greatest pass over nulls
        "hi": F.greatest("__pay_x", "__pay_y"),
        "currency": F.coalesce("__pay_tc", "__pay_cc"),
        "period": F.coalesce(F.when(stated, F.col("__pay_best.w.period")), "__pay_tp", "__pay_cp"),
        "from_text": F.coalesce(stated, F.lit(False)),
    }).drop(*drop)


def yearly_usd(jobs: DataFrame, factors: DataFrame) -> DataFrame:
    """jobs with min_usd_year and max_usd_year, null where amount, currency or period can't be told.

    Nulls, empty and unknown units count as unstated. Amounts are decimals until the one
    rounding, half up. Extra columns pass through; an empty table stays empty. Of the factor
    table only the codes that are known here are read.
    """
    known = units(factors)
    r = pay_readings(jobs, known)
    rate = (_factor(known["period"], F.col("period")) * _factor(known["currency"], F.col("currency"))).cast("decimal(18,8)")
    usd = lambda c: F.round((F.col(c) * rate).cast("decimal(38,12)"), 0).cast("long")
    return r.withColumns({"min_usd_year": usd("lo"), "max_usd_year": usd("hi")})


PAY = ["job_uid", "salary_min", "salary_max", "salary_currency", "salary_period", "compensation"]


def pay_found(jobs: DataFrame, factors: DataFrame) -> DataFrame:
    """One row per job_uid whose yearly pay can be told; a posting processed again counts once (its least pay, should they differ)."""
    return _posted(jobs, factors).select("job_uid", "min_usd_year", "max_usd_year")


def _posted(jobs: DataFrame, factors: DataFrame) -> DataFrame:
    """One row per job_uid whose pay can be told, with all that its reading says."""
    r = yearly_usd(jobs.select(*PAY).filter("job_uid is not null"), factors)
    # Told or not is asked of the aggregate: a filter before it would be pushed through all that is derived here.
    told = F.col("min_usd_year").isNotNull() & F.col("max_usd_year").isNotNull()
    best = r.groupBy("job_uid").agg(F.min(F.when(told, F.struct("min_usd_year", "max_usd_year", "from_text", "residual", "departs"))).alias("m"), F.max(told & F.col("ambiguous")).alias("ambiguous"))
    return best.filter("m is not null").select("job_uid", "m.*", "ambiguous")


def pay_flagged(jobs: DataFrame, factors: DataFrame) -> DataFrame:
    """pay_found with from_text and ambiguous: whether the text was read, and whether another combination of units fits as well."""
    return _posted(jobs, factors).drop("residual", "departs")


def pay_ambiguous(jobs: DataFrame, factors: DataFrame) -> DataFrame:
    """The postings whose units have no unique solution, or only one that departs from what is stated, with the residual of the solution taken."""
    return _posted(jobs, factors).filter("ambiguous or departs").drop("from_text")
