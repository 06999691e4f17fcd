import hashlib

import pytest
from pyspark.sql import functions as F

from tallyforge.functions import companies, ids, lang, predicates, salvage, text


def one(spark, value, build, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(build(F.col("x")).alias("y")).first().y


@pytest.mark.parametrize(
    ("raw", "want"),
    [
        ("<ul><li>One</li><li>Two</li></ul>", "• One. • Two."), ("<p>A &amp; B</p><p>C&nbsp;D</p>", "A & B C D"), ("a<br/>b", "a b"), ("TÃ¼rkiye â€™s", "Türkiye 's"), ("&amp;lt;", "&lt;"),
        (None, ""), ("", ""), ("x<!-- c -->y", "x y"),
    ],
)
def test_html(spark, raw, want):
    assert one(spark, raw, text.html_to_text) == want


@pytest.mark.parametrize(("raw", "want"), [("sr. dev", "Senior Developer"), ("VP of Eng", "Vice President Of Engineer"), ("QA lead", "Quality Assurance Lead"), ("full-time ai role", "Full-Time AI Role"), ("NASA pilot", "NASA Pilot"), (None, ""), ("Cook!!", "Cook")])
def test_titles(spark, raw, want):
    assert one(spark, raw, text.job_title) == want


def test_long_words_of_titles_stay_whole(spark):
    assert one(spark, "x" * 5000, text.job_title) == "X" + "x" * 4999


@pytest.mark.parametrize(
    ("raw", "want"),
    [
        ("San Francisco, CA", ("San Francisco, CA, United States", "San Francisco", "CA", "United States", False)), ("Toronto, Ontario", ("Toronto, Ontario", "Toronto", "Ontario", None, False)),
        ("Remote - anywhere", ("Remote", None, None, None, True)), ("Austin, Texas, USA", ("Austin, TX, United States", "Austin", "TX", "United States", False)), ("Berlin", ("Berlin", "Berlin", None, None, False)),
        (None, ("", None, None, None, False)),
    ],
)
def test_locations(spark, raw, want):
    assert tuple(one(spark, raw, text.location)) == want


@pytest.mark.parametrize(("raw", "want"), [("FT", "Full-time"), ("fulltime", "Full-time"), ("temp", "Contract"), ("co-op", "Internship"), ("Unknown", "Unknown"), (None, None), ("", "")])
def test_employment(spark, raw, want):
    assert one(spark, raw, text.employment_status) == want


def test_urls_and_descriptions(spark):
    assert tuple(one(spark, "Example.org/jobs", text.url_parts)) == (True, "https://Example.org/jobs", "example.org", "https")
    assert tuple(one(spark, None, text.url_parts)) == (False, "", None, None)
    assert one(spark, "Do things. We are an Equal Opportunity employer\nand more", text.description) == "Do things."
    assert one(spark, "Acme  incorporated Inc", text.company_name) == "Acme incorporated Inc."
    assert one(spark, "x &eacute; &#8364;", text.unescape_every_entity) == "x é €"
    assert one(spark, "y" * 9000, text.prompt_text).endswith("...[truncated]") and one(spark, " ", text.prompt_text) == "No job description provided"


@pytest.mark.parametrize(("size", "want"), [("1001-5000", "Medium"), ("51-200", "Small"), ("10,001+", "Startup"), (None, "Unknown"), ("5001-10,000", "Large")])
def test_sizes(spark, size, want):
    assert one(spark, size, companies.size_class) == want


def test_industries(spark):
    assert one(spark, "Soft goods development", companies.industry) == "Software Development"
    assert one(spark, " Basket  weaving ", companies.industry) == "Basket weaving"


def test_ids(spark):
    key = "JOB_ID:12|PLATFORM:workday|COMPANY:c|DATE:NULL_DATE"
    got = spark.range(1).select(ids.job_uid(F.lit(" 12 "), F.lit("Workday "), F.lit("c"), F.lit(None)).alias("y")).first().y
    assert got == hashlib.sha256(key.encode()).hexdigest()[:32]
    a, b = (spark.range(1).select(ids.company_platform_id(F.lit(n), F.lit("icims")).alias("y")).first().y for n in ("Acme  Inc", " acme inc"))
    assert a == b == hashlib.sha256(b"acme inc|icims").hexdigest()[:12]


@pytest.mark.parametrize(
    ("txt", "want"),
    [("short", "unknown"), ("The team is looking for a manager with experience", "en"), ("백엔드 개발자 채용 공고입니다 지원하세요", "ko"), ("Unternehmen sucht Erfahrung, Gehalt und Standort in Wien", "de"), (None, "unknown"), ("zzz yyy xxx www vvv uuu", "en")],
)
def test_languages(spark, txt, want):
    got = one(spark, txt, lambda c: lang.language_of(c, lang.pattern_hits(c)))
    assert got.lang == want


def test_title_in_korean_wins_over_a_broken_body(spark):
    df = spark.createDataFrame([("백엔드 개발자 경력 채용", "The role is for a manager with the team and the company")], "t string, b string")
    a = lambda c: lang.language_of(F.col(c), lang.pattern_hits(F.col(c)))
    r = df.select(lang.of_fields(a("t"), a("b"), a("b")).alias("y")).first().y
    assert (r.lang, r.source, r.is_english) == ("ko", "job_title", False)


def test_combined_detectors(spark):
    s = lambda lg, c: F.struct(F.lit(lg).alias("lang"), F.lit(c).alias("confidence"))
    row = spark.range(1).select(lang.combined(s("en", 0.9), s("ko", 0.85)).alias("a"), lang.combined(s("fr", 0.9), s("en", 0.85)).alias("b"), lang.combined(s("fr", 0.2), s("en", 0.85)).alias("c"), lang.combined(s("fr", 0.4), s("en", 0.3)).alias("d")).first()
    assert [x.lang for x in row] == ["ko", "fr", "en", "fr"] and row.d.method == "primary_unsure"


@pytest.mark.parametrize(
    ("raw", "want"),
    [('{"a": 1}', '{"a":1}'), ('Sure:\n```json\n{"a": {"b": "}"}}\n``` bye', '{"a":{"b":"}"}}'), ('so {"a": [1, 2]} it is', '{"a":[1,2]}'), ("none here", None), ("", None), (None, None), ("{" * 60 + "}" * 60, None), ("[1]", None), ('use {braces} so {"a": 1}', '{"a":1}'), ('{"a": {"b": 1}, oops', None), ("{}", "{}"), ('```\n{"q": 1,}\n``` {"z": 2}', '{"z":2}')],
)
def test_salvage(raw, want):
    assert salvage.salvage(raw) == want


def test_salvage_column(spark):
    df = spark.createDataFrame([('x {"skills": {"confidence": 0.5}, "salary_info": {"confidence": 7}} y',), (None,)], "x string").select(salvage.salvaged_json("x").alias("j"))
    got = df.select(salvage.mean_confidence(F.col("j")).alias("m"), salvage.missing_sections(F.col("j")).alias("s")).collect()
    assert got[0].m == 0.5 and got[1].m == 0.0 and len(got[0].s) == 3


def test_predicates(spark):
    p = lambda v, f: one(spark, v, f)
    assert p("a, B ,c", lambda c: predicates.in_list(c, "b")) and not p("ab", lambda c: predicates.in_list(c, "b")) and not p(None, lambda c: predicates.in_list(c, "b"))
    assert p("C++ dev", lambda c: predicates.has_word(c, "dev")) and not p("devops", lambda c: predicates.has_word(c, "dev")) and p("devops lead now", lambda c: predicates.has_word(c, "ops lead"))
    assert p("Boise, ID", lambda c: predicates.place_is(c, "ID")) and not p("MIDLAND", lambda c: predicates.place_is(c, "ID")) and p(" ", lambda c: predicates.place_is(c, "")) and p("3 Locations", lambda c: predicates.place_is(c, "Location"))
    assert p("Remote", lambda c: predicates.remote_or_place(c, True, ["X"])) and not p("Remote X", lambda c: predicates.remote_or_place(c, False, ["X"])) and p("X", lambda c: predicates.remote_or_place(c, None, ["X"]))
    assert [p(x, predicates.company_bucket) for x in (" acme", "3M", "Éclair", "", None)] == ["A", "0-9", "other", "other", "other"]
    assert p("yes", predicates.truthy) and not p(None, predicates.truthy) and not p("N/A", predicates.not_placeholder)
