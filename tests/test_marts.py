import datetime as dt

from pyspark.sql import functions as F

from tallyforge.plans import dimensions, mart

W = lambda i: dt.date(2024, 1, 1) + dt.timedelta(7 * i)
P = "posting_id long, company_id long, week date, salary double, work_type string, seniority string"


def series(counts):
    rows, i = [], 0
    for w, n in enumerate(counts):
        for _ in range(n):
            rows.append((i, 1, W(w), 100.0 + w, "remote" if i % 2 else "onsite", "x"))
            i += 1
    return rows


def test_skill_series(make):
    rows = series([10, 12, 13, 10, 20])
    p = make(P, *rows)
    b = make("posting_id long, skill_id long, confidence double", *[(r[0], 7, 0.9) for r in rows], (0, 7, 0.95), (1, 8, 0.9), (2, 8, 0.5))
    out = mart.skills_demand_weekly(p, b, make("skill_id long, category string", (7, "c"), (8, "c"))).orderBy("week").collect()
    assert [r.trend for r in out] == ["NEW", "STABLE", "STABLE", "DECLINING", "GROWING"]
    assert [r.jobs_4w for r in out] == [10.0, 11.0, 11.6667, 11.25, 13.75] and {r.skill_id for r in out} == {7}
    assert all(r.penetration == 100.0 and r.category_share == 100.0 for r in out)


def test_company_series_and_intelligence(make):
    weekly = mart.company_hiring_weekly(make(P, *series([10, 13, 12, 10])))
    out = weekly.orderBy("week").collect()
    assert [r.trend for r in out] == ["New", "Accelerating", "Stable", "Declining"] and [r.wow for r in out] == [None, 30.0, -7.6923, -16.6667]
    ind = make("company_id long, industry string", (1, "i"))
    r = mart.company_intelligence(weekly, ind).first()
    assert (r.jobs, r.jobs_7, r.growth, r.competitiveness) == (10, 45, -16.6667, 0.6)
    legacy = mart.company_intelligence(weekly, ind, legacy_semantics=True).first()
    assert legacy.growth is None and legacy.jobs_7 == 10


def test_competitiveness_levels(make):
    w = make("company_id long, week date, jobs long, avg_salary double, remote_share double", *[(i, W(0), n, 1.0, 0.0) for i, n in enumerate((40, 30, 20, 10, 0))])
    got = mart.company_intelligence(w, make("company_id long, industry string", *[(i, "i") for i in range(5)])).orderBy("company_id").collect()
    assert [r.competitiveness for r in got] == [1.0, 0.8, 0.6, 0.4, 0.2] and [r.peer_rank for r in got] == [1, 2, 3, 4, 5]


def test_market_leaves_unfinished_weeks_out(make):
    out = mart.market_weekly(make(P, *series([10, 20, 30])), F.lit(W(2)), 5).orderBy("week").collect()
    assert [(r.jobs, r.jobs_growth) for r in out] == [(10, 0.0), (20, 100.0)]


def test_weights(make):
    b = make("j long, s long, c double", (1, 1, 0.95), (1, 2, 0.85), (1, 3, 0.70))
    out = mart.weighted_bridge(b, "j", [F.desc("c")], [(0.9, 1.0), (0.8, 0.9), (0, 0.8)], "c").orderBy("s").collect()
    assert [r.weight for r in out] == [0.95, 0.765, 0.56] and [r.is_primary for r in out] == [True, False, False]
    k = make("p int, c double", (1, 0.9), (2, 0.8), (5, 0.7), (1, 0.6)).select(mart.keyword_weight(F.col("p"), F.col("c")).alias("w"))
    assert [r.w for r in k.collect()] == [0.9, 0.72, 0.56, 0.42]


def test_dates(spark):
    d = mart.date_dimension(spark, "2020-01-01", "2029-12-31")
    assert d.count() == 3653
    r = d.filter("date_key = '20241230'").first()
    assert (r.week_key, r.is_weekend, str(r.week_start)) == ("2025-01", False, "2024-12-30")
    assert mart.date_dimension(spark, "2024-12-30", "2024-12-30", legacy_week_key=True).first().week_key == "2024-01"


def test_empty_marts(make):
    p = make(P)
    assert mart.company_hiring_weekly(p).count() == mart.market_weekly(p, F.current_date()).count() == 0
    assert mart.skills_demand_weekly(p, make("posting_id long, skill_id long, confidence double"), make("skill_id long, category string")).count() == 0


def test_serving_table_refresh(make):
    old, new = make("g string, items string, n_items long", ("a", "x", 1), ("b", "y", 1)), make("g string, items string, n_items long", ("a", "x, z", 2), ("c", None, 0))
    got = dimensions.refresh_denorm(old, new, ["g"], ["items"]).orderBy("g").collect()
    assert [tuple(r) for r in got] == [("a", "x, z", 2), ("c", None, 0)]
