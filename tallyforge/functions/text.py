"""Cleaning and standardising of posting texts, as Column expressions."""

from __future__ import annotations

import html
from collections.abc import Callable
from functools import reduce

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyforge.functions.rules import quote, replace_all, replace_all_sql, rewrite, rewrite_sql

BLANK = r"[\s\x{00a0}]+"
ENDS = r"^[\s\x{00a0}]+|[\s\x{00a0}]+$"

# Entities (the ampersand last, as decoding is one pass), wrongly decoded UTF-8, structure marks, boilerplate.
ENTITIES = (
    ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&#x27;", "'"), ("&apos;", "'"), ("&nbsp;", " "), ("&#160;", " "),
    ("&rsquo;", "’"), ("&lsquo;", "‘"), ("&rdquo;", "”"), ("&ldquo;", "“"), ("&ndash;", "–"), ("&mdash;", "—"),
    ("&bull;", "•"), ("&hellip;", "…"), ("&eacute;", "é"), ("&uuml;", "ü"), ("&ouml;", "ö"), ("&auml;", "ä"),
    ("&szlig;", "ß"), ("&euro;", "€"), ("&pound;", "£"), ("&amp;", "&"),
)
MOJIBAKE = (
    ("â€™", "'"), ("â€œ", '"'), ("â€¢", "•"), ("â€¦", "…"),
    ("â€˜", "'"), ("â€š", "'"), ("â€ž", '"'), ("â€º", "›"),
    ("â€¹", "‹"), ('â€"', "—"), ("â€", '"'),
    ("Ã¼", "ü"), ("Ã¡", "á"), ("Ã©", "é"), ("Ã­", "í"), ("Ã³", "ó"),
    ("Ãº", "ú"), ("Ã±", "ñ"), ("Ã§", "ç"), ("Ã ", "à"), ("Ã¨", "è"),
    ("Ã¬", "ì"), ("Ã²", "ò"), ("Ã¹", "ù"), ("Ã¤", "ä"), ("Ã«", "ë"),
    ("Ã¯", "ï"), ("Ã¶", "ö"),
)
STRUCTURE = (
    (r"(?i)<li[^>]*>", " • "), (r"(?i)</li>", ". "), (r"(?i)<p[^>]*>", "\n\n"), (r"(?i)</p>", ""), (r"(?i)<div[^>]*>", "\n"), (r"(?i)</div>", ""),
    (r"(?i)<h[1-6][^>]*>", "\n\n"), (r"(?i)</h[1-6]>", "\n"), (r"(?i)</?[uo]l[^>]*>", "\n"),
)
TAGS = ((r"(?i)<br\s*/?>", " "), (r"<[^>]+>", " "), (r"(?s)<!--.*?-->", " "))
BOILERPLATE = (
    (r"(?is)We are an equal opportunity employer.*", ""), (r"(?is)Equal opportunity employer.*", ""), (r"(?is)EOE.*", ""),
    (r"(?is)This employer participates in E-Verify.*", ""), (r"(?is)All qualified applicants will receive consideration.*", ""),
    (r"(?is)To perform this job successfully.*", ""), (r"(?is)The above statements are intended to describe.*", ""),
)
BULLETS = (("[•·▪▫‣⁃]\\s*", "• "), ("•\\s*•\\s*", "• "))
TITLE_WORDS = (
    (r"(?i)\bSr\b\.?", "Senior"), (r"(?i)\bJr\b\.?", "Junior"), (r"(?i)\bMgr\b\.?", "Manager"), (r"(?i)\bDir\b\.?", "Director"),
    (r"(?i)\bVP\b", "Vice President"), (r"(?i)\bCTO\b", "Chief Technology Officer"), (r"(?i)\bCEO\b", "Chief Executive Officer"),
    (r"(?i)\bCFO\b", "Chief Financial Officer"), (r"(?i)\bCOO\b", "Chief Operating Officer"), (r"(?i)\bEng\b\.?", "Engineer"),
    (r"(?i)\bDev\b\.?", "Developer"), (r"(?i)\bSW\b", "Software"), (r"(?i)\bHW\b", "Hardware"), (r"(?i)\bQA\b", "Quality Assurance"),
    (r"(?i)\bUI/UX\b", "UI/UX"), (r"(?i)\bFT\b", "Full-Time"), (r"(?i)\bPT\b", "Part-Time"),
)
CAPITALS = ("api", "ui", "ux", "ai", "ml", "devops", "saas", "paas", "iaas")
LEGAL_SUFFIXES = (
    (r"(?i)\s+Inc\.?$", " Inc."), (r"(?i)\s+LLC\.?$", " LLC"), (r"(?i)\s+Corp\.?$", " Corp."), (r"(?i)\s+Corporation$", " Corporation"),
    (r"(?i)\s+Ltd\.?$", " Ltd."), (r"(?i)\s+Limited$", " Limited"), (r"(?i)\s+Co\.?$", " Co."), (r"(?i)\s+Company$", " Company"),
)
REMOTE = r"(?i)\b(?:remote|work from home|wfh|telecommute|virtual|distributed|anywhere|flexible location)\b"
US_STATES = {
    "AL": "Alabama", "AK": "Alaska", "AZ": "Arizona", "AR": "Arkansas", "CA": "California", "CO": "Colorado", "CT": "Connecticut", "DE": "Delaware",
    "FL": "Florida", "GA": "Georgia", "HI": "Hawaii", "ID": "Idaho", "IL": "Illinois", "IN": "Indiana", "IA": "Iowa", "KS": "Kansas",
    "KY": "Kentucky", "LA": "Louisiana", "ME": "Maine", "MD": "Maryland", "MA": "Massachusetts", "MI": "Michigan", "MN": "Minnesota",
    "MS": "Mississippi", "MO": "Missouri", "MT": "Montana", "NE": "Nebraska", "NV": "Nevada", "NH": "New Hampshire", "NJ": "New Jersey",
    "NM": "New Mexico", "NY": "New York", "NC": "North Carolina", "ND": "North Dakota", "OH": "Ohio", "OK": "Oklahoma", "OR": "Oregon",
    "PA": "Pennsylvania", "RI": "Rhode Island", "SC": "South Carolina", "SD": "South Dakota", "TN": "Tennessee", "TX": "Texas", "UT": "Utah",
    "VT": "Vermont", "VA": "Virginia", "WA": "Washington", "WV": "West Virginia", "WI": "Wisconsin", "WY": "Wyoming", "DC": "District of Columbia",
}
EMPLOYMENT = (
    ("Full-time", ("full-time", "fulltime", "full_time", "ft")), ("Part-time", ("part-time", "parttime", "part_time", "pt")),
    ("Contract", ("contract", "contractor", "temp", "temporary")), ("Internship", ("intern", "internship", "co-op", "coop")),
)


def squeeze(c: Column) -> Column:
    """Trimmed, runs of white space as one blank; null becomes empty."""
    return rewrite(F.coalesce(c, F.lit("")), ((ENDS, ""), (BLANK, " ")))


def squeeze_sql(e: str) -> str:
    return rewrite_sql(f"coalesce({e}, '')", ((ENDS, ""), (BLANK, " ")))


def _where(c: Column, marks: tuple[str, ...], change: Callable[[Column], Column], any_case: bool = False) -> Column:
    """change(c) for texts that hold one of the marks (with any_case, marks in lower case); others need no look at each rule. c is evaluated once."""
    holds = lambda x: reduce(lambda a, b: a | b, [F.contains(x, F.lit(m)) for m in marks])
    given = lambda x: F.exists(F.array(F.lower(x)), holds) if any_case else holds(x)
    return F.transform(F.array(c), lambda x: F.when(given(x), change(x)).otherwise(x))[0]


def html_to_text(c: Column) -> Column:
    """Text of an HTML fragment: entities decoded, lists and paragraphs kept apart, tags as blanks."""
    c = _where(c, ("&",), lambda x: replace_all(x, ENTITIES))
    c = _where(c, ("â", "Ã"), lambda x: replace_all(x, MOJIBAKE))
    return squeeze(_where(c, ("<",), lambda x: rewrite(x, (*STRUCTURE, *TAGS))))


def html_to_text_sql(e: str) -> str:
    return squeeze_sql(rewrite_sql(replace_all_sql(replace_all_sql(e, ENTITIES), MOJIBAKE), (*STRUCTURE, *TAGS)))


@F.pandas_udf(T.StringType())
def unescape_every_entity(s: pd.Series) -> pd.Series:
    """Every HTML entity, numeric ones included; for texts that ENTITIES doesn't cover."""
    return s.map(html.unescape, na_action="ignore")


def description(c: Column) -> Column:
    """html_to_text without boilerplate (which is taken to reach to the end) and with one kind of bullet."""
    said = tuple(p.removeprefix("(?is)").removesuffix(".*").lower() for p, _ in BOILERPLATE)
    c = _where(html_to_text(c), said, lambda x: rewrite(x, BOILERPLATE), any_case=True)
    return squeeze(_where(c, tuple("•·▪▫‣⁃"), lambda x: rewrite(x, BULLETS)))


def description_sql(e: str) -> str:
    return squeeze_sql(rewrite_sql(html_to_text_sql(e), (*BOILERPLATE, *BULLETS)))


NOT_IN_TITLES = (r"[^\p{L}\p{N}_\s\-()/&+.]", "")


def job_title(c: Column) -> Column:
    """A title with its abbreviations written out, each word capitalised unless it's an acronym."""
    t = rewrite(html_to_text(c), (NOT_IN_TITLES, *TITLE_WORDS))

    def word(w: Column) -> Column:
        parts = F.regexp_extract_all(w, F.lit(r"(\p{L}+|\P{L}+)"), F.lit(1))
        cased = F.array_join(F.transform(parts, lambda x: F.concat(F.upper(F.substring(x, 1, 1)), F.lower(F.substr(x, F.lit(2))))), "")
        return F.when((w == F.upper(w)) & (F.lower(w) != w) & (F.length(w) > 1), w).when(F.lower(w).isin(*CAPITALS), F.upper(w)).otherwise(cased)

    return F.array_join(F.transform(F.split(squeeze(t), " "), word), " ")


def job_title_sql(e: str) -> str:
    t = squeeze_sql(rewrite_sql(html_to_text_sql(e), (NOT_IN_TITLES, *TITLE_WORDS)))
    capitals = ", ".join(quote(x) for x in CAPITALS)
    return f"""array_to_string(list_transform(string_split({t}, ' '), lambda w: CASE
        WHEN w = upper(w) AND lower(w) <> w AND length(w) > 1 THEN w WHEN lower(w) IN ({capitals}) THEN upper(w)
        ELSE array_to_string(list_transform(regexp_extract_all(w, '\\p{{L}}+|\\P{{L}}+'), lambda x: upper(x[1]) || lower(x[2:])), '') END), ' ')"""


def company_name(c: Column) -> Column:
    """A name with one way of writing its legal form."""
    return F.trim(rewrite(html_to_text(c), LEGAL_SUFFIXES))


def company_name_sql(e: str) -> str:
    return f"trim({rewrite_sql(html_to_text_sql(e), LEGAL_SUFFIXES)})"


def employment_status(c: Column) -> Column:
    v = F.lower(F.trim(c))
    return F.coalesce(*[F.when(v.isin(*ways), F.lit(name)) for name, ways in EMPLOYMENT], c)


def employment_status_sql(e: str) -> str:
    return "CASE " + " ".join(f"WHEN lower(trim({e})) IN ({', '.join(map(quote, ways))}) THEN {quote(name)}" for name, ways in EMPLOYMENT) + f" ELSE {e} END"


def url_parts(c: Column) -> Column:
    """struct(is_valid, normalized_url, domain, scheme): https is put before an address without scheme."""
    t = F.trim(F.coalesce(c, F.lit("")))
    full = F.when(t.rlike("^https?://"), t).otherwise(F.concat(F.lit("https://"), t))
    domain = F.lower(F.regexp_extract(full, r"^https?://([^/?#]*)", 1))
    ok = (t != "") & (domain != "")
    return F.struct(
        ok.alias("is_valid"), F.when(t == "", "").otherwise(full).alias("normalized_url"), F.when(ok, domain).alias("domain"),
        F.when(ok, F.regexp_extract(full, r"^(https?)://", 1)).alias("scheme"),
    )


LOCATION = r"^(.+?),\s*([A-Z]{2}|[A-Za-z\s]+)(?:,\s*(United States|USA|US))?"


def location(c: Column) -> Column:
    """struct(standardized, city, state, country, is_remote) of a typed place.

    'City, State[, United States]' first; a state is brought to its code, and the country
    is told from it only if it's a state of the United States. Other places are split at
    commas. Null and empty places are empty.
    """
    t = html_to_text(c)
    remote = t.rlike(REMOTE)
    found = t.rlike(LOCATION)
    group = lambda n: F.nullif(F.trim(F.regexp_extract(t, LOCATION, n)), F.lit(""))
    codes = F.create_map(*[F.lit(x) for k, v in US_STATES.items() for x in (v.lower(), k)], *[F.lit(x) for k in US_STATES for x in (k.lower(), k)])
    code = F.element_at(codes, F.lower(group(2)))
    parts = F.transform(F.split(t, ","), lambda x: F.nullif(F.trim(x), F.lit("")))
    n = F.size(parts)
    city = F.when(remote, None).when(found, group(1)).otherwise(parts[0])
    state = F.when(remote, None).when(found, F.coalesce(code, group(2))).when(n >= 3, F.get(parts, F.lit(1)))
    country = F.when(remote, None).when(found, F.when(group(3).isNotNull() | code.isNotNull(), "United States")).when(n >= 3, F.get(parts, F.lit(2))).when(n == 2, F.get(parts, F.lit(1)))
    whole = F.when(remote, "Remote").otherwise(F.concat_ws(", ", city, state, country))
    return F.struct(whole.alias("standardized"), city.alias("city"), state.alias("state"), country.alias("country"), remote.alias("is_remote"))


def prompt_text(c: Column, max_chars: int = 8000) -> Column:
    """A description cut to what a prompt may hold, marked if cut."""
    t = F.trim(F.coalesce(c, F.lit("")))
    return F.when(t == "", "No job description provided").when(F.length(t) > max_chars, F.concat(F.substring(t, 1, max_chars), F.lit("...[truncated]"))).otherwise(t)
