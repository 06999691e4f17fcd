import datetime as dt

import pytest
from pyspark.sql import functions as F

from tallyforge.search import report
from tallyforge.search.request import SearchRequest, relevance, search
from tallyforge.sources import files, platforms
from tallyforge.streaming import streams


def test_csv(spark, tmp_path):
    (tmp_path / "a.csv").write_text("name,n\nx,1\nNULL,2\ny,bad\n")
    got = files.read_csv(spark, str(tmp_path / "a.csv"), "name string, n int").orderBy("name").collect()
    assert [(r["name"], r.n) for r in got] == [(None, 2), ("x", 1), ("y", None)] and got[0].source_file.endswith("a.csv")
    with pytest.raises(Exception, match="MALFORMED|FAILED_READ"):
        files.read_csv(spark, str(tmp_path / "a.csv"), "name string, n int", strict=True).collect()
    with pytest.raises(ValueError, match="other"):
        files.require_columns(spark.range(1), ["id", "other"])


def test_new_files_by_content(spark, make, tmp_path):
    for n, t in (("a", "1"), ("b", "2"), ("c", "1")):
        (tmp_path / f"{n}.csv").write_text(t)
    first = files.new_files(spark, str(tmp_path), make("file_hash string"))
    done = first.filter("path like '%a.csv'").select("file_hash")
    assert [r.path[-5:] for r in files.new_files(spark, str(tmp_path), done).collect()] == ["b.csv"]


def test_bodies_source(spark, tmp_path):
    (tmp_path / "p.html").write_text('<script>var jobImpressions = [{"id": "7", "title": "Cook"}];</script>')
    spark.dataSource.register(files.FetchedBodies)
    got = spark.read.format("bodies").load(str(tmp_path)).select(F.inline(platforms.icims_impressions(F.col("body")))).collect()
    assert [(r.id, r.title) for r in got] == [("7", "Cook")]


def test_platforms(make):
    g = make("job_id string, published_at string, department string, requisition_id string, extra int", ("1", "2024-01-01", "d", None, 5), ("2", None, None, "R", None))
    a, b = platforms.unified(g, "greenhouse").orderBy("job_id").collect()
    assert (a.date_posted, a.employment_status, a.platform_specific_data, a.extra) == ("2024-01-01", None, None, 5) and b.platform_specific_data == '{"requisition_id":"R"}'
    w = platforms.unified(make("job_id string, employment_type string", ("1", "ft")), "workday").first()
    assert (w.employment_status, w.department, w.job_title) == ("Full-time", None, None)
    with pytest.raises(ValueError):
        platforms.unified(g, "nowhere")


def test_address_ids(make):
    r = make("u string", ("https://acme.wd1.host.example/en-US/Careers/job/X_R-123",)).select(platforms.workday_site(F.col("u")).alias("s"), platforms.workday_id(F.col("u")).alias("i"), platforms.icims_id(F.lit("x/jobs/12/view")).alias("c"), platforms.greenhouse_id(F.lit("a?gh_jid=9")).alias("g")).first()
    assert (r.s.tenant, r.s.site, r.i, r.c, r.g) == ("acme", "Careers", "R-123", "12", "9")
    names = make("t string", ('{"company_name": "A", broken "name":"B" }',)).select(platforms.dirty_company_names(F.col("t")).alias("n")).first().n
    assert names == ["A", "B"]
    v = make("a string, b string", ("https://a.b.example/jobs", "https://www.b.example/"), ("https://a.example/x", "https://z.org/x"), ("https://a.example/x", "https://a.example/x"), (None, "x"))
    assert [r.v for r in v.select(platforms.url_verdict(F.col("a"), F.col("b")).alias("v")).collect()] == ["generic", "other_domain", "same", "invalid"]


J = "title string, body string, location string, posted date, quality double, language_confidence double, platform string, skills_csv string, uid string"
JOBS = [
    ("Lead Cook", "cooking and sales", "Boise, ID", dt.date(2024, 1, 3), 0.9, 0.95, "icims", "cook, sales", "1"), ("Sales rep", "selling", "Remote", dt.date(2024, 1, 2), 0.4, 0.5, "workday", "sales", "2"),
    ("Leader", None, None, None, None, None, None, None, "3"), ("Cook", "intern cook", "MIDLAND", dt.date(2024, 1, 1), 0.7, 0.95, "icims", "cook", "4"),
]


@pytest.mark.parametrize(
    ("request_", "want"),
    [
        ({}, "1423"), ({"keywords": ["cook"]}, "14"), ({"keywords": ["cook"], "exclude": ["intern"]}, "1"), ({"titles": ["lead"]}, "1"), ({"locations": ["ID"]}, "1"), ({"remote": True, "locations": ["ID"]}, "12"),
        ({"remote": False}, "143"), ({"platforms": ["ICIMS"]}, "14"), ({"skills": ["Sales"]}, "12"), ({"least_quality": 0.5}, "14"), ({"posted_from": dt.date(2024, 1, 2)}, "12"), ({"all_terms": ["cook", "sales"]}, "1"),
        ({"max_results": 1, "offset": 1}, "4"), ({"keywords": ["x' OR 1=1 --"]}, ""), ({"posted_to": dt.date(2024, 1, 1)}, "4"), ({"least_language_confidence": 0.9}, "14"),
    ],
)
def test_search(make, request_, want):
    df = make(J, *JOBS)
    got = "".join(r.uid for r in search(df, SearchRequest(**request_)).collect())
    assert sorted(got) == sorted(want) if request_ else got[0] == "1" and len(got) == 4


def test_relevance(make):
    df = make(J, *JOBS)
    s = lambda **k: {r.uid: r.s for r in df.select("uid", relevance(SearchRequest(**k), df).alias("s")).collect()}
    assert s(score="basic", keywords=["cook", "sales"])["1"] == 1.0 and s(score="basic")["1"] == 0.0
    assert abs(s(keywords=["cook"], titles=["lead"])["1"] - min(1, (0.4 + 0.3 + 0.09) / 0.8 * 1.05)) < 1e-9
    assert abs(s(score="advanced", keywords=["cook"], locations=["ID"])["4"] - 1.0) < 1e-9


def test_reports(make, tmp_path):
    df = make("a string, b int", ("<x>|", 1), (None, 2))
    h, m = report.as_html(df, "T"), report.as_markdown(df)
    assert "&lt;x&gt;|" in h and "<td></td>" in h and "\\|" in m
    assert "<p>2 rows</p>" in h and "<li>1: 1</li>" in report.as_html(df, "T", ["b"])
    assert report.as_text(df, "csv") == "a,b\n<x>|,1\n,2" and report.as_text(df, "json").splitlines()[1] == '{"a": null, "b": 2}'
    long = df.sparkSession.range(report.PAGE_ROWS + 7).toDF("i")
    want = f"the first {report.PAGE_ROWS} of {report.PAGE_ROWS + 7} rows"
    assert want in report.as_html(long) and report.as_markdown(long).endswith(want)
    p = report.write_report(df, f"{tmp_path}/r_{{date}}.html", "html", dt.date(2024, 5, 6))
    assert p.endswith("r_20240506.html")
    with pytest.raises(ValueError):
        report.write_report(df, "x", "pdf", dt.date(2024, 5, 6))


def test_stream_upsert_twice_is_the_same(spark, make, tmp_path):
    schema = "k long, t long, v string"
    make(schema, (1, 1, "a"), (1, 3, "c"), (2, 1, "x")).write.parquet(f"{tmp_path}/in/1")
    t = streams.VersionedTable(spark, f"{tmp_path}/t", schema, ["k"])
    run = lambda c: streams.upsert_stream(streams.file_stream(spark, f"{tmp_path}/in/*", schema), t, ["k"], [F.desc("t")], f"{tmp_path}/{c}").awaitTermination()
    run("c1")
    make(schema, (1, 2, "late"), (3, 1, "new")).write.parquet(f"{tmp_path}/in/2")
    run("c1")
    want = [(1, 3, "c"), (2, 1, "x"), (3, 1, "new")]
    assert sorted(map(tuple, t.read().collect())) == want
    run("c2")  # everything again, from a new checkpoint
    assert sorted(map(tuple, t.read().collect())) == want


def test_stream_windows_and_state(spark, make, tmp_path):
    d = lambda m: dt.datetime(2024, 1, 1, 0, m)
    schema = "k string, ts timestamp, v double"
    make(schema, ("a", d(0), 1.0), ("a", d(10), 2.0), ("a", d(50), 3.0), ("b", d(5), 4.0), ("b", d(5), 4.0)).write.parquet(f"{tmp_path}/in")
    stream = streams.file_stream(spark, f"{tmp_path}/in", schema)
    got = {}
    sink = lambda name: lambda df, _: got.setdefault(name, []).extend(map(tuple, df.collect()))
    streams.run_once(streams.tumbling_counts(stream, "ts", "k", "1 hour"), sink("tumble"), f"{tmp_path}/c1", "update")
    streams.run_once(streams.without_repeats(stream, ["k", "ts"], "ts"), sink("once"), f"{tmp_path}/c2")
    streams.run_once(streams.latest_state(stream, "k", "ts", "v"), sink("latest"), f"{tmp_path}/c3", "update")
    assert sorted(x[1:] for x in got["tumble"]) == [("a", 3), ("b", 2)] and len(got["once"]) == 4
    assert {x[0]: x[2] for x in got["latest"]} == {"a": 3.0, "b": 4.0}
    batch = spark.read.schema(schema).parquet(f"{tmp_path}/in")
    assert sorted(r.n for r in streams.session_counts(batch, "ts", "k").collect()) == [1, 2, 2]
    assert streams.sliding_counts(batch, "ts", "k", "1 hour", "30 minutes").agg(F.sum("n")).first()[0] == 10
