import datetime as dt

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tallyforge.functions.langmodel import LanguageModel
from tallyforge.operators.store import Progress, Store
from tallyforge.plans import catalog
from tallyforge.search.request import SearchRequest, search
from tallyforge.sources import files, platforms


def test_jobs_name_queries_that_are_there():
    core = {n for m in entry._modules() if "llm" not in m.__name__ for n in m.QUERIES}
    assert len(catalog.JOBS) >= 23 and {s for j in catalog.JOBS.values() for s in j.steps} <= core


def test_schedules_over_changes_of_clocks():
    utc = lambda *a: dt.datetime(*a, tzinfo=dt.UTC)
    daily, hourly = catalog.SCHEDULES
    assert [t.isoformat() for t in daily.times(utc(2025, 3, 8, 12), utc(2025, 3, 10, 12))] == ["2025-03-09T04:00:00-04:00", "2025-03-10T04:00:00-04:00"]
    assert len(list(hourly.times(utc(2025, 1, 1, 0, 30), utc(2025, 1, 1, 3)))) == 3
    early = catalog.Schedule("x", 2, "US/Eastern")
    assert len(list(early.times(utc(2025, 3, 8, 12), utc(2025, 3, 10, 12)))) == 1  # two o'clock is left out on the 9th
    assert len(list(catalog.Schedule("x", 1, "US/Eastern").times(utc(2025, 11, 1, 12), utc(2025, 11, 2, 12)))) == 1  # one o'clock comes twice
    runs = catalog.due(utc(2025, 3, 8, 0), utc(2025, 3, 8, 12))
    assert len(runs) == 28 + 12 and len({r[2] for r in runs}) == len(runs)


def test_statements_and_retries():
    assert files.statements("SELECT 'a;''b' -- c;\n; /* x;y */ SELECT ${N} - 1/2 ;;", {"N": "5"}) == ["SELECT 'a;''b'", "SELECT 5 - 1/2"]
    with pytest.raises(KeyError):
        files.statements("SELECT ${MISSING}")
    waits, calls = [], []

    def fetch(a):
        calls.append(a)
        if len(calls) < 3:
            raise OSError("busy")
        return a.upper()

    assert files.with_retries(fetch, 3, 1.0, waits.append)("u") == "U" and waits == [1.0, 2.0]
    with pytest.raises(OSError, match="busy"):
        calls.clear()
        files.with_retries(fetch, 2, 1.0, waits.append)("u")


def test_pages_that_fail_do_not_stop_others(make):
    def make_fetch():
        def fetch(a):
            if a == "bad":
                raise ValueError("no such page")
            return f"<{a}>"

        return fetch

    got = {r.address: (r.body, r.error) for r in files.fetched(make("address string, body string", ("a", "x"), ("bad", "x"), ("b", None)), make_fetch).collect()}
    assert got == {"a": ("<a>", None), "bad": (None, "ValueError: no such page"), "b": ("<b>", None)}


def test_discovery_answers(make):
    rows = [
        ("Acme", 'Sure [really]: [{"company_name": "Acme", "ats_url": "https://a.example/x", "career_url": null}]'), ("Bolt", '[{"company_name": "Acme", "ats_url": "https://a.example"}]'),
        ("Cook", '[{"company_name": "Cook", oh well, "ats_url": "https://c.example", "career_url": "https://c.example/j"}, {"company_name": "Dorn", "ats_url": "https://d.example"}]'), ("None", None), ("E", "no list"),
    ]
    got = {r.company_name: (r.found_ats_url, r.found_career_url) for r in platforms.discovered_urls(make("company_name string, answer string", *rows)).collect()}
    assert got == {"Acme": ("https://a.example/x", None), "Bolt": (None, None), "Cook": ("https://c.example", "https://c.example/j"), "None": (None, None), "E": (None, None)}


def test_progress_survives_being_told_twice(spark, make, tmp_path):
    p = Progress(Store(spark, str(tmp_path)).table("a.done", "k long, part string", ["k", "part"]))
    work = make("k long, part string, extra int", (1, "a", 0), (2, "a", 0), (3, "b", 0), (None, "b", 0))
    left = lambda: sorted(r.k or 0 for r in p.left(work).collect())
    assert left() == [0, 1, 2, 3]
    p.finish(work.filter("part = 'a'"))
    p.finish(work.filter("k = 1"))
    assert left() == [0, 3]
    p.forget(F.col("k") == 2)
    assert left() == [0, 2, 3]


P = "title string, body string, location string, company string, posted date, skills_csv string, categories_csv string, work_type string, uid string"
ROWS = [
    ("Lead cook", "kitchen", "Boise", "Acme", dt.date(2024, 1, 3), "sql, soup", "data, food", "Remote", "1"), ("Analyst", "numbers of kitchens", "Reno", "Bolt", dt.date(2024, 1, 1), "sql", "data", "onsite", "2"),
    (None, None, None, None, None, None, None, None, "3"),
]


@pytest.mark.parametrize(
    ("request_", "want"),
    [
        ({"skill_categories": ["Food"]}, "1"), ({"skills": ["soup"], "skill_categories": ["data"]}, "12"), ({"skills": ["sql"], "exclude_skills": ["SOUP"]}, "2"), ({"exclude_skill_categories": ["food"]}, "23"),
        ({"work_types": ["remote"]}, "1"), ({"free_text": "bolt"}, "2"), ({"free_text": "boise"}, "1"), ({"days_back": 1, "as_of": dt.date(2024, 1, 4)}, "1"),
        ({"all_terms": ["numbers"], "titles": ["cook"]}, ""), ({"all_terms": ["numbers"], "titles": ["cook"], "titles_or_terms": True}, "12"),
    ],
)
def test_more_search_options(make, request_, want):
    assert sorted(r.uid for r in search(make(P, *ROWS), SearchRequest(**request_)).collect()) == sorted(want)


def test_language_model_on_held_out_texts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", F.substring(F.lower("lang"), 1, 2).alias("lang"))
    model = LanguageModel.fit(docs.filter("doc_id % 2 = 0"))
    held = docs.filter("doc_id % 2 = 1 and lang is not null and length(text) >= 100")
    got = model.detect(held, "doc_id").withColumnRenamed("lang", "found").join(held.select("doc_id", "lang"), "doc_id")
    n, right = got.count(), got.filter("found = lang").count()
    assert n > 300 and right / n > 0.9


def test_language_model_without_anything(make):
    model = LanguageModel.fit(make("text string, lang string", ("abc", "x"), (None, "y"), ("", None)))
    got = {r.k: (r.lang, r.confidence) for r in model.detect(make("k long, text string", (1, "abc"), (2, None)), "k").collect()}
    assert got == {1: ("unknown", 0.0), 2: ("unknown", 0.0)}
