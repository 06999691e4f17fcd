"""Weekly and monthly marts over a posting fact and its bridges.

The builders take DataFrames with the columns that their docstrings name, so that the
same mart runs over any source. Doubles are rounded to four places at the end only.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Least sizes of groups, limits of trends in percent.
LEAST_JOBS, LEAST_MARKET_JOBS, LEAST_SALARIES = 2, 100, 5
GROWING, STABLE, ACCELERATING = 25, -10, 20
POPULAR, NICHE, HOT, RISING = 20, 5, 25, 10


def week_of(ts: Column) -> Column:
    """Monday of the week, as a date."""
    return F.date_trunc("week", ts).cast("date")


def percent(a: Column, b: Column) -> Column:
    return F.try_divide(a * 100.0, b)


def change(now: Column, before: Column) -> Column:
    """Change in percent, null without a value before."""
    return F.try_divide((now - before) * 100.0, before)


def half_up(c: Column, places: int = 4) -> Column:
    """Rounded half up by plain arithmetic, which is the same in every engine."""
    return F.floor(c.cast("double") * 10**places + 0.5) / float(10**places)


def rounded(df: DataFrame, places: int = 4) -> DataFrame:
    """df with its doubles rounded."""
    return df.select(*[half_up(F.col(c), places).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


def exact_avg(c: Column, places: int = 2) -> Column:
    """Average by a decimal sum, so that it doesn't depend on the order in which partitions are added up."""
    return F.try_divide(F.sum(c.cast(f"decimal(18,{places})")).cast("double"), F.count(c))


def salary_stats(prefix: str = "") -> list[Column]:
    s = F.when(F.col("salary") > 0, F.col("salary"))
    return [exact_avg(s).alias(f"{prefix}avg_salary"), F.median(s).alias(f"{prefix}median_salary"), F.min(s).alias(f"{prefix}min_salary"), F.max(s).alias(f"{prefix}max_salary")]


def skills_demand_weekly(postings: DataFrame, bridge: DataFrame, skills: DataFrame, least_confidence: float = 0.7) -> DataFrame:
    """Demand of each skill and week: postings (posting_id, company_id, week, salary), bridge (posting_id, skill_id, confidence), skills (skill_id, category).

    Share of the week's postings, premium over the week's average salary, week over week
    change (over rows, gaps aren't filled), four-row average, trend, ranks in the week and
    in the week's category, share of the category. Weeks with fewer than two postings of a
    skill are left out before the series are formed. A posting counts once per skill.
    """
    used = bridge.filter(F.col("confidence") >= least_confidence).groupBy("posting_id", "skill_id").agg(F.max("confidence").alias("confidence"))
    rows = used.join(postings, "posting_id").join(skills, "skill_id")
    per = rows.groupBy("week", "skill_id", "category").agg(
        F.count("*").alias("jobs"), F.count_distinct("company_id").alias("companies"), *salary_stats()
    ).filter(F.col("jobs") >= LEAST_JOBS)
    base = postings.groupBy("week").agg(F.count("*").alias("week_jobs"), exact_avg(F.when(F.col("salary") > 0, F.col("salary"))).alias("week_salary"))
    per = per.join(base, "week")
    series = Window.partitionBy("skill_id").orderBy("week")
    before = F.lag("jobs").over(series)
    wow = change(F.col("jobs"), before)
    trend = F.when(before.isNull(), "NEW").when(wow > GROWING, "GROWING").when(wow > STABLE, "STABLE").otherwise("DECLINING")
    in_cat = Window.partitionBy("week", "category")
    out = per.select(
        "week", "skill_id", "category", "jobs", "companies", "avg_salary", "median_salary", "min_salary", "max_salary",
        percent(F.col("jobs"), F.col("week_jobs")).alias("penetration"), change(F.col("avg_salary"), F.col("week_salary")).alias("premium"),
        wow.alias("wow"), F.avg("jobs").over(series.rowsBetween(-3, 0)).alias("jobs_4w"), trend.alias("trend"),
        F.rank().over(Window.partitionBy("week").orderBy(F.desc("jobs"))).alias("week_rank"),
        F.rank().over(in_cat.orderBy(F.desc("jobs"))).alias("category_rank"), percent(F.col("jobs"), F.sum("jobs").over(in_cat)).alias("category_share"),
    )
    return rounded(out)


def company_hiring_weekly(postings: DataFrame, levels: Mapping[str, Sequence[str]] | None = None) -> DataFrame:
    """Hiring of each company and week: postings (posting_id, company_id, week, salary, work_type, seniority).

    levels names groups of seniorities, of each of which the share of the postings is told.
    """
    groups = {f"{name}_share": percent(F.count_if(F.col("seniority").isin(*s)), F.count("*")) for name, s in (levels or {}).items()}
    per = postings.groupBy("company_id", "week").agg(
        F.count("*").alias("jobs"), *salary_stats(), *[F.count_if(F.col("work_type") == w).alias(f"{w}_jobs") for w in ("remote", "hybrid", "onsite")],
        F.count_distinct("seniority").alias("seniorities"), *[c.alias(name) for name, c in groups.items()],
    ).filter(F.col("jobs") >= LEAST_JOBS)
    w = Window.partitionBy("company_id").orderBy("week")
    before = F.lag("jobs").over(w)
    wow = change(F.col("jobs"), before)
    trend = F.when(before.isNull(), "New").when(wow > ACCELERATING, "Accelerating").when(wow > STABLE, "Stable").otherwise("Declining")
    return rounded(per.withColumns({"remote_share": percent(F.col("remote_jobs"), F.col("jobs")), "wow": wow, "salary_change": F.col("avg_salary") - F.lag("avg_salary").over(w), "trend": trend}))


def market_weekly(postings: DataFrame, as_of: Column, least_jobs: int = LEAST_MARKET_JOBS) -> DataFrame:
    """The market of each finished week with enough postings. The unpartitioned window runs over weeks only."""
    per = postings.groupBy("week").agg(
        F.count("*").alias("jobs"), F.count_distinct("company_id").alias("companies"), *salary_stats()
    ).filter((F.col("jobs") >= least_jobs) & (F.date_add("week", 7) <= as_of))
    w = Window.orderBy("week")
    growth = lambda c: F.coalesce(change(F.col(c), F.lag(c).over(w)), F.lit(0.0))
    return rounded(per.withColumns({"jobs_growth": growth("jobs"), "salary_growth": growth("avg_salary"), "velocity": F.col("jobs") / 7.0}))


def skills_trend(weekly: DataFrame) -> DataFrame:
    """Four-row changes of a weekly skill series (week, skill_id, category, jobs, avg_salary) with the change of rank."""
    per = weekly.groupBy("week", "category").agg(F.sum("jobs").alias("jobs"), exact_avg(F.col("avg_salary"), 4).alias("avg_salary"))
    ranked = per.withColumn("rank", F.rank().over(Window.partitionBy("week").orderBy(F.desc("jobs"))))
    w = Window.partitionBy("category").orderBy("week")
    return rounded(ranked.withColumns({
        "jobs_4w_ago": F.lag("jobs", 4).over(w), "mom": change(F.col("jobs"), F.lag("jobs", 4).over(w)),
        "salary_mom": change(F.col("avg_salary"), F.lag("avg_salary", 4).over(w)), "rank_change": F.lag("rank", 4).over(w) - F.col("rank"),
    }))


def skills_trend_by_form(weekly: DataFrame, forms: DataFrame, postings: DataFrame, bridge: DataFrame, levels: Mapping[str, Sequence[str]], least_confidence: float = 0.7) -> DataFrame:
    """Four-row changes of the series of each canonical form: weekly (week, skill_id, jobs, avg_salary), forms (skill_id, form).

    The postings of a form and week are also counted by group of seniority, each posting once:
    postings (posting_id, week, seniority), bridge (posting_id, skill_id, confidence).
    """
    per = weekly.join(forms, "skill_id").groupBy("week", "form").agg(F.sum("jobs").alias("jobs"), exact_avg(F.col("avg_salary"), 4).alias("avg_salary"))
    used = bridge.filter(F.col("confidence") >= least_confidence).join(forms, "skill_id").select("posting_id", "form").distinct()
    by_level = used.join(postings.select("posting_id", "week", "seniority"), "posting_id").groupBy("week", "form").agg(*[F.count_if(F.col("seniority").isin(*s)).alias(f"{name}_jobs") for name, s in levels.items()])
    per = per.join(by_level, ["week", "form"], "left").withColumn("rank", F.rank().over(Window.partitionBy("week").orderBy(F.desc("jobs"))))
    w = Window.partitionBy("form").orderBy("week")
    return rounded(per.withColumns({
        "mom": change(F.col("jobs"), F.lag("jobs", 4).over(w)), "salary_mom": change(F.col("avg_salary"), F.lag("avg_salary", 4).over(w)),
        "rank_change": F.lag("rank", 4).over(w) - F.col("rank"),
    }))


def company_intelligence(weekly: DataFrame, industries: DataFrame, legacy_semantics: bool = False) -> DataFrame:
    """The latest week of each company (company_id, week, jobs, avg_salary, remote_share) against its peers.

    Rolling sums run over seven and thirty rows. legacy_semantics takes the latest week
    before the series are formed, as some warehouses' view did: growth is null then and
    the sums hold one row.
    """
    rows = weekly.join(industries, "company_id")
    last = Window.partitionBy("company_id")
    only_last = lambda df: df.withColumn("_last", F.max("week").over(last)).filter("week = _last").drop("_last")
    if legacy_semantics:
        rows = only_last(rows)
    w = Window.partitionBy("company_id").orderBy("week")
    peers = Window.partitionBy("industry", "week")
    rows = rows.withColumns({
        "jobs_7": F.sum("jobs").over(w.rowsBetween(-6, 0)), "jobs_30": F.sum("jobs").over(w.rowsBetween(-29, 0)),
        "growth": change(F.col("jobs"), F.lag("jobs").over(w)), "peer_jobs": F.avg("jobs").over(peers),
        "peer_rank": F.rank().over(peers.orderBy(F.desc("jobs"))),
    })
    ratio = F.try_divide(F.col("jobs").cast("double"), F.col("peer_jobs"))
    level = F.when(ratio >= 2, 1.0).when(ratio >= 1.5, 0.8).when(ratio >= 1, 0.6).when(ratio >= 0.5, 0.4).otherwise(0.2)
    policy = F.when(F.col("remote_share") >= 70, "Remote First").when(F.col("remote_share") >= 30, "Flexible").otherwise("Office")
    rows = rows.withColumns({"competitiveness": level, "remote_policy": policy})
    return rounded((rows if legacy_semantics else only_last(rows)).select(
        "company_id", "industry", "week", "jobs", "jobs_7", "jobs_30", "growth", "peer_jobs", "peer_rank", "competitiveness", "remote_policy"
    ))


def salary_intelligence(postings: DataFrame, least: int = LEAST_SALARIES, legacy_semantics: bool = False) -> DataFrame:
    """Monthly percentiles per family, seniority, metro area and country: postings (month, these, work_type, salary), with the month's change of the average.

    legacy_semantics compares with the row before of the same family, seniority and metro
    area, whatever its country (then by country).
    """
    p = lambda q: F.percentile("salary", q)
    keys = ["family", "seniority", "metro", "country"]
    per = postings.filter("salary > 0").groupBy("month", *keys).agg(
        F.count("*").alias("n"), exact_avg(F.col("salary")).alias("avg_salary"), F.median("salary").alias("median_salary"), p(0.25).alias("p25"), p(0.75).alias("p75"), p(0.9).alias("p90"),
        exact_avg(F.when(F.col("work_type") == "remote", F.col("salary"))).alias("avg_remote"), exact_avg(F.when(F.col("work_type") == "onsite", F.col("salary"))).alias("avg_onsite"),
    ).filter(F.col("n") >= least)
    w = Window.partitionBy(*keys[:3]).orderBy("month", "country") if legacy_semantics else Window.partitionBy(*keys).orderBy("month")
    return rounded(per.withColumn("mom", change(F.col("avg_salary"), F.lag("avg_salary").over(w))))


def skills_market(postings: DataFrame, bridge: DataFrame) -> DataFrame:
    """Adoption and momentum of each skill and week; the first week has no momentum and is called NEW."""
    per = bridge.select("posting_id", "skill_id").distinct().join(postings.select("posting_id", "week"), "posting_id").groupBy("week", "skill_id").agg(F.count("*").alias("jobs"))
    week = postings.groupBy("week").agg(F.count("*").alias("week_jobs"))
    w = Window.partitionBy("skill_id").orderBy("week")
    per = per.join(week, "week").withColumns({"share": percent(F.col("jobs"), F.col("week_jobs")), "mentions_share": percent(F.col("jobs"), F.sum("jobs").over(Window.partitionBy("week"))), "momentum": change(F.col("jobs"), F.lag("jobs").over(w))})
    adoption = F.when(F.col("share") > POPULAR, "POPULAR").when(F.col("share") > NICHE, "NICHE").otherwise("RARE")
    heat = F.when(F.col("momentum").isNull(), "NEW").when(F.col("momentum") > HOT, "HOT").when(F.col("momentum") > RISING, "GROWING").when(F.col("momentum") > STABLE, "STABLE").otherwise("DECLINING")
    return rounded(per.withColumns({"adoption": adoption, "heat": heat}).drop("week_jobs"))


def weighted_bridge(bridge: DataFrame, partition: str, order: list[Column], bands: list[tuple[float, float]], confidence: str) -> DataFrame:
    """bridge with a position per posting, a weight (confidence times its band's factor) and the primary row marked."""
    w = Window.partitionBy(partition).orderBy(*order)
    factor = F.coalesce(*[F.when(F.col(confidence) >= least, F.lit(f)) for least, f in bands[:-1]], F.lit(bands[-1][1]))
    b = bridge.withColumn("position", F.row_number().over(w))
    return b.withColumns({"weight": half_up(F.col(confidence) * factor), "is_primary": F.col("position") == 1})


def keyword_weight(position: Column, confidence: Column) -> Column:
    """Weight by position and confidence: the first of high confidence counts in full."""
    return half_up(confidence * F.when((position == 1) & (confidence >= 0.8), 1.0).when((position <= 3) & (confidence >= 0.7), 0.9).when(confidence >= 0.7, 0.8).otherwise(0.7))


def date_dimension(spark, first: str, last: str, legacy_week_key: bool = False) -> DataFrame:
    """One row per day. week_key joins the ISO year and week; with legacy_week_key the calendar year and the week."""
    days = spark.sql(f"SELECT explode(sequence(DATE '{first}', DATE '{last}', INTERVAL 1 DAY)) AS day")
    year = F.year("day") if legacy_week_key else F.expr("extract(YEAROFWEEK FROM day)")
    return days.select(
        F.date_format("day", "yyyyMMdd").alias("date_key"), "day", F.year("day").alias("year"), F.quarter("day").alias("quarter"), F.month("day").alias("month"),
        F.monthname("day").alias("month_name"), F.weekofyear("day").alias("week"), F.day("day").alias("day_of_month"), F.dayofweek("day").alias("day_of_week"),
        F.dayname("day").alias("day_name"), F.dayofweek("day").isin(1, 7).alias("is_weekend"), week_of(F.col("day")).alias("week_start"),
        F.date_add(week_of(F.col("day")), 6).alias("week_end"), F.concat(year.cast("string"), F.lit("-"), F.lpad(F.weekofyear("day").cast("string"), 2, "0")).alias("week_key"),
        F.date_format("day", "yyyy-MM").alias("month_key"),
    )
