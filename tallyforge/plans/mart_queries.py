"""Queries of the marts, over orders (postings), customer (companies), lineitem (posting and skill) and part (skills)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyforge.plans import mart
from tallyforge.plans.registry import registry
from tallyforge.sources.tables import table

QUERIES, ORACLE, query = registry()


def _postings(spark: SparkSession, d: str) -> DataFrame:
    work = F.when(F.col("o_orderstatus") == "F", "remote").when(F.col("o_orderstatus") == "O", "hybrid").otherwise("onsite")
    return table(spark, d, "orders").select(
        F.col("o_orderkey").alias("posting_id"), F.col("o_custkey").alias("company_id"), mart.week_of(F.col("o_orderdate")).alias("week"),
        F.col("o_totalprice").alias("salary"), work.alias("work_type"), F.col("o_orderpriority").alias("seniority"),
        F.date_trunc("month", "o_orderdate").cast("date").alias("month"),
    )


def _bridge(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lineitem").select(F.col("l_orderkey").alias("posting_id"), F.col("l_partkey").alias("skill_id"), (1 - F.col("l_discount")).alias("confidence"))


def _skills(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "part").select(F.col("p_partkey").alias("skill_id"), F.col("p_brand").alias("category"))


POSTINGS = """(SELECT o_orderkey AS posting_id, o_custkey AS company_id, CAST(date_trunc('week', o_orderdate) AS DATE) AS week, o_totalprice AS salary,
    CASE o_orderstatus WHEN 'F' THEN 'remote' WHEN 'O' THEN 'hybrid' ELSE 'onsite' END AS work_type, o_orderpriority AS seniority,
    CAST(date_trunc('month', o_orderdate) AS DATE) AS month FROM orders)"""
_AVG = "CAST(sum(CAST({0} AS DECIMAL(18, 2))) FILTER ({0} > 0) AS DOUBLE) / count(*) FILTER ({0} > 0)".format("salary")
_STATS = f"""{_AVG} AS avg_salary, median(salary) FILTER (salary > 0) AS median_salary, min(salary) FILTER (salary > 0) AS min_salary, max(salary) FILTER (salary > 0) AS max_salary"""


def _r(*cols: str) -> str:
    return ", ".join(f"round({c}, 4) AS {c}" for c in cols)


_DEMAND = f"""
WITH p AS {POSTINGS},
u AS (SELECT l_orderkey AS posting_id, l_partkey AS skill_id FROM lineitem WHERE 1 - l_discount >= 0.7 GROUP BY ALL),
a AS (SELECT p.week, u.skill_id, part.p_brand AS category, count(*) AS jobs, count(DISTINCT company_id) AS companies, {_STATS}
      FROM u JOIN p USING (posting_id) JOIN part ON part.p_partkey = u.skill_id GROUP BY ALL HAVING count(*) >= 2),
b AS (SELECT week, count(*) AS week_jobs, {_AVG} AS week_salary FROM p GROUP BY 1),
s AS (SELECT a.*, week_jobs, week_salary, lag(jobs) OVER (PARTITION BY skill_id ORDER BY a.week) AS before FROM a JOIN b USING (week))
SELECT week, skill_id, category, jobs, companies, {_r('avg_salary', 'median_salary', 'min_salary', 'max_salary')},
  round(jobs * 100.0::DOUBLE / week_jobs, 4) AS penetration, round((avg_salary - week_salary) * 100.0::DOUBLE / week_salary, 4) AS premium,
  round((jobs - before) * 100.0::DOUBLE / before, 4) AS wow,
  round(avg(jobs) OVER (PARTITION BY skill_id ORDER BY week ROWS BETWEEN 3 PRECEDING AND CURRENT ROW), 4) AS jobs_4w,
  CASE WHEN before IS NULL THEN 'NEW' WHEN (jobs - before) * 100.0::DOUBLE / before > 25 THEN 'GROWING' WHEN (jobs - before) * 100.0::DOUBLE / before > -10 THEN 'STABLE' ELSE 'DECLINING' END AS trend,
  CAST(rank() OVER (PARTITION BY week ORDER BY jobs DESC) AS INT) AS week_rank, CAST(rank() OVER (PARTITION BY week, category ORDER BY jobs DESC) AS INT) AS category_rank,
  round(jobs * 100.0::DOUBLE / sum(jobs) OVER (PARTITION BY week, category), 4) AS category_share FROM s"""


@query(_DEMAND)
def skills_demand_weekly(spark: SparkSession, d: str) -> DataFrame:
    return mart.skills_demand_weekly(_postings(spark, d), _bridge(spark, d), _skills(spark, d))


LEVELS = {"senior": ("1-URGENT", "2-HIGH"), "junior": ("5-LOW",)}
_COMPANY = f"""
SELECT company_id, week, jobs, {_r('avg_salary', 'median_salary', 'min_salary', 'max_salary')}, remote_jobs, hybrid_jobs, onsite_jobs, seniorities, {_r('senior_share', 'junior_share')},
  round(remote_jobs * 100.0::DOUBLE / jobs, 4) AS remote_share, round((jobs - before) * 100.0::DOUBLE / before, 4) AS wow,
  round(avg_salary - lag(avg_salary) OVER (PARTITION BY company_id ORDER BY week), 4) AS salary_change,
  CASE WHEN before IS NULL THEN 'New' WHEN (jobs - before) * 100.0::DOUBLE / before > 20 THEN 'Accelerating' WHEN (jobs - before) * 100.0::DOUBLE / before > -10 THEN 'Stable' ELSE 'Declining' END AS trend
FROM (SELECT *, lag(jobs) OVER (PARTITION BY company_id ORDER BY week) AS before FROM (
  SELECT company_id, week, count(*) AS jobs, {_STATS}, count(*) FILTER (work_type = 'remote') AS remote_jobs, count(*) FILTER (work_type = 'hybrid') AS hybrid_jobs,
    count(*) FILTER (work_type = 'onsite') AS onsite_jobs, count(DISTINCT seniority) AS seniorities, count(*) FILTER (seniority IN ('1-URGENT', '2-HIGH')) * 100.0::DOUBLE / count(*) AS senior_share, count(*) FILTER (seniority = '5-LOW') * 100.0::DOUBLE / count(*) AS junior_share FROM {POSTINGS} GROUP BY ALL HAVING count(*) >= 2))"""


def _monthly(spark: SparkSession, d: str) -> DataFrame:
    """Postings by month instead of week, as the test companies post too rarely for weekly groups."""
    return _postings(spark, d).withColumn("week", F.col("month"))


@query(_COMPANY.replace(POSTINGS, f"(SELECT * REPLACE (month AS week) FROM {POSTINGS})"))
def company_hiring_weekly(spark: SparkSession, d: str) -> DataFrame:
    return mart.company_hiring_weekly(_monthly(spark, d), LEVELS)


@query(f"""
WITH p AS (SELECT week, count(*) AS jobs, count(DISTINCT company_id) AS companies, {_STATS} FROM {POSTINGS} GROUP BY 1 HAVING count(*) >= 20 AND week + 7 <= DATE '2001-08-01')
SELECT week, jobs, companies, {_r('avg_salary', 'median_salary', 'min_salary', 'max_salary')},
  round(coalesce((jobs - lag(jobs) OVER w) * 100.0::DOUBLE / lag(jobs) OVER w, 0), 4) AS jobs_growth,
  round(coalesce((avg_salary - lag(avg_salary) OVER w) * 100.0::DOUBLE / lag(avg_salary) OVER w, 0), 4) AS salary_growth, round(jobs / 7.0::DOUBLE, 4) AS velocity
FROM p WINDOW w AS (ORDER BY week)""")
def market_weekly_summary(spark: SparkSession, d: str) -> DataFrame:
    return mart.market_weekly(_postings(spark, d), F.lit("2001-08-01").cast("date"), 20)


@query(f"""
WITH w AS (SELECT week, category, CAST(sum(jobs) AS BIGINT) AS jobs, CAST(sum(CAST(avg_salary AS DECIMAL(18, 4))) AS DOUBLE) / count(avg_salary) AS avg_salary FROM ({_DEMAND}) GROUP BY ALL),
r AS (SELECT *, CAST(rank() OVER (PARTITION BY week ORDER BY jobs DESC) AS INT) AS rank FROM w)
SELECT week, category, jobs, {_r('avg_salary')}, rank, lag(jobs, 4) OVER x AS jobs_4w_ago, round((jobs - lag(jobs, 4) OVER x) * 100.0::DOUBLE / lag(jobs, 4) OVER x, 4) AS mom,
  round((avg_salary - lag(avg_salary, 4) OVER x) * 100.0::DOUBLE / lag(avg_salary, 4) OVER x, 4) AS salary_mom, CAST(lag(rank, 4) OVER x - rank AS INT) AS rank_change
FROM r WINDOW x AS (PARTITION BY category ORDER BY week)""")
def skills_trend_analysis(spark: SparkSession, d: str) -> DataFrame:
    return mart.skills_trend(skills_demand_weekly(spark, d))


def _intelligence_sql(legacy: bool) -> str:
    weekly = _COMPANY.replace(POSTINGS, f"(SELECT * REPLACE (month AS week) FROM {POSTINGS})")
    last = "QUALIFY week = max(week) OVER (PARTITION BY company_id)"
    return f"""
    WITH c AS (SELECT w.company_id, w.week, w.jobs, w.remote_share, c_mktsegment AS industry FROM ({weekly}) w JOIN customer ON c_custkey = company_id {last if legacy else ''}),
    x AS (SELECT *, CAST(sum(jobs) OVER (s ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS BIGINT) AS jobs_7, CAST(sum(jobs) OVER (s ROWS BETWEEN 29 PRECEDING AND CURRENT ROW) AS BIGINT) AS jobs_30,
      (jobs - lag(jobs) OVER s) * 100.0::DOUBLE / lag(jobs) OVER s AS growth, avg(jobs) OVER (PARTITION BY industry, week) AS peer_jobs,
      CAST(rank() OVER (PARTITION BY industry, week ORDER BY jobs DESC) AS INT) AS peer_rank FROM c WINDOW s AS (PARTITION BY company_id ORDER BY week))
    SELECT company_id, industry, week, jobs, jobs_7, jobs_30, {_r('growth', 'peer_jobs')}, peer_rank,
      CASE WHEN jobs / peer_jobs >= 2 THEN 1.0::DOUBLE WHEN jobs / peer_jobs >= 1.5 THEN 0.8 WHEN jobs / peer_jobs >= 1 THEN 0.6 WHEN jobs / peer_jobs >= 0.5 THEN 0.4 ELSE 0.2 END AS competitiveness,
      CASE WHEN remote_share >= 70 THEN 'Remote First' WHEN remote_share >= 30 THEN 'Flexible' ELSE 'Office' END AS remote_policy
    FROM x {'' if legacy else last}"""


def _industries(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "customer").select(F.col("c_custkey").alias("company_id"), F.col("c_mktsegment").alias("industry"))


@query(_intelligence_sql(False))
def company_hiring_intelligence(spark: SparkSession, d: str) -> DataFrame:
    return mart.company_intelligence(company_hiring_weekly(spark, d), _industries(spark, d))


@query(_intelligence_sql(True))
def company_hiring_intelligence_legacy(spark: SparkSession, d: str) -> DataFrame:
    return mart.company_intelligence(company_hiring_weekly(spark, d), _industries(spark, d), legacy_semantics=True)


@query(f"""
WITH f AS (SELECT l_partkey % 7 AS form, p.*, u.skill_id FROM (SELECT DISTINCT l_orderkey AS posting_id, l_partkey AS skill_id, l_partkey FROM lineitem WHERE 1 - l_discount >= 0.7) u JOIN {POSTINGS} p USING (posting_id)),
l AS (SELECT week, form, count(DISTINCT posting_id) FILTER (seniority IN ('1-URGENT', '2-HIGH')) AS senior_jobs, count(DISTINCT posting_id) FILTER (seniority = '5-LOW') AS junior_jobs FROM f GROUP BY ALL),
w AS (SELECT week, skill_id % 7 AS form, CAST(sum(jobs) AS BIGINT) AS jobs, CAST(sum(CAST(avg_salary AS DECIMAL(18, 4))) AS DOUBLE) / count(avg_salary) AS avg_salary FROM ({_DEMAND}) GROUP BY ALL),
r AS (SELECT w.*, senior_jobs, junior_jobs, CAST(rank() OVER (PARTITION BY week ORDER BY jobs DESC) AS INT) AS rank FROM w LEFT JOIN l USING (week, form))
SELECT week, form, jobs, senior_jobs, junior_jobs, {_r('avg_salary')}, rank, round((jobs - lag(jobs, 4) OVER x) * 100.0::DOUBLE / lag(jobs, 4) OVER x, 4) AS mom,
  round((avg_salary - lag(avg_salary, 4) OVER x) * 100.0::DOUBLE / lag(avg_salary, 4) OVER x, 4) AS salary_mom, CAST(lag(rank, 4) OVER x - rank AS INT) AS rank_change FROM r WINDOW x AS (PARTITION BY form ORDER BY week)""")
def skills_trend_by_form(spark: SparkSession, d: str) -> DataFrame:
    """Seven canonical forms over the skills, with the levels of their postings."""
    forms = table(spark, d, "part").select(F.col("p_partkey").alias("skill_id"), (F.col("p_partkey") % 7).alias("form"))
    return mart.skills_trend_by_form(skills_demand_weekly(spark, d), forms, _postings(spark, d), _bridge(spark, d), LEVELS)


def _salary_sql(lag: str) -> str:
    return f"""
SELECT month, family, seniority, metro, country, n, {_r('avg_salary', 'median_salary', 'p25', 'p75', 'p90', 'avg_remote', 'avg_onsite')}, round((avg_salary - lag(avg_salary) OVER w) * 100.0::DOUBLE / lag(avg_salary) OVER w, 4) AS mom
FROM (SELECT month, c_mktsegment AS family, seniority, r_name AS metro, n_name AS country, count(*) AS n, {_AVG} AS avg_salary, median(salary) AS median_salary, quantile_cont(salary, 0.25) AS p25,
        quantile_cont(salary, 0.75) AS p75, quantile_cont(salary, 0.9) AS p90, {_AVG.replace('(salary > 0)', "(salary > 0 AND work_type = 'remote')")} AS avg_remote, {_AVG.replace('(salary > 0)', "(salary > 0 AND work_type = 'onsite')")} AS avg_onsite
      FROM (SELECT * REPLACE (CAST(date_trunc('year', month) AS DATE) AS month, seniority[1:1] AS seniority) FROM {POSTINGS}) JOIN customer ON c_custkey = company_id JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey WHERE salary > 0 GROUP BY ALL HAVING count(*) >= 2)
WINDOW w AS ({lag})"""


def _salary(spark: SparkSession, d: str, legacy: bool) -> DataFrame:
    """Years instead of months, as the test tables have few postings for each of the many keys."""
    c = table(spark, d, "customer").join(table(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).join(table(spark, d, "region"), F.col("r_regionkey") == F.col("n_regionkey"))
    c = c.select(F.col("c_custkey").alias("company_id"), F.col("c_mktsegment").alias("family"), F.col("r_name").alias("metro"), F.col("n_name").alias("country"))
    p = _postings(spark, d).join(c, "company_id").withColumns({"month": F.trunc("month", "year"), "seniority": F.substring("seniority", 1, 1)})
    return mart.salary_intelligence(p, 2, legacy)


@query(_salary_sql("PARTITION BY family, seniority, metro, country ORDER BY month"))
def salary_intelligence(spark: SparkSession, d: str) -> DataFrame:
    return _salary(spark, d, False)


@query(_salary_sql("PARTITION BY family, seniority, metro ORDER BY month, country"))
def salary_intelligence_legacy(spark: SparkSession, d: str) -> DataFrame:
    return _salary(spark, d, True)


@query(f"""
WITH p AS {POSTINGS}, t AS (SELECT week, count(*) AS week_jobs FROM p GROUP BY 1),
a AS (SELECT week, skill_id, count(*) AS jobs FROM (SELECT DISTINCT l_orderkey AS posting_id, l_partkey AS skill_id FROM lineitem) JOIN p USING (posting_id) GROUP BY ALL),
s AS (SELECT a.week, skill_id, jobs, jobs * 100.0::DOUBLE / week_jobs AS share, jobs * 100.0::DOUBLE / sum(jobs) OVER (PARTITION BY a.week) AS mentions_share,
      (jobs - lag(jobs) OVER (PARTITION BY skill_id ORDER BY a.week)) * 100.0::DOUBLE / lag(jobs) OVER (PARTITION BY skill_id ORDER BY a.week) AS momentum FROM a JOIN t USING (week))
SELECT week, skill_id, jobs, {_r('share', 'mentions_share', 'momentum')}, CASE WHEN share > 20 THEN 'POPULAR' WHEN share > 5 THEN 'NICHE' ELSE 'RARE' END AS adoption,
  CASE WHEN momentum IS NULL THEN 'NEW' WHEN momentum > 25 THEN 'HOT' WHEN momentum > 10 THEN 'GROWING' WHEN momentum > -10 THEN 'STABLE' ELSE 'DECLINING' END AS heat FROM s""")
def skills_market_intelligence(spark: SparkSession, d: str) -> DataFrame:
    return mart.skills_market(_postings(spark, d), _bridge(spark, d))


@query("""
SELECT posting_id, skill_id, line, round(confidence, 4) AS confidence, CAST(position AS INT) AS position, position = 1 AS is_primary,
  round(confidence * CASE WHEN confidence >= 0.95 THEN 1.0 WHEN confidence >= 0.9 THEN 0.9 ELSE 0.8 END, 4) AS weight FROM (
  SELECT l_orderkey AS posting_id, l_partkey AS skill_id, l_linenumber AS line, 1 - l_discount AS confidence,
    row_number() OVER (PARTITION BY l_orderkey ORDER BY 1 - l_discount DESC, l_partkey, l_linenumber) AS position FROM lineitem WHERE 1 - l_discount >= 0.92)""")
def skills_bridge_weighted(spark: SparkSession, d: str) -> DataFrame:
    b = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("posting_id"), F.col("l_partkey").alias("skill_id"), F.col("l_linenumber").alias("line"), (1 - F.col("l_discount")).alias("confidence"))
    order = [F.desc("confidence"), F.asc("skill_id"), F.asc("line")]
    return mart.weighted_bridge(b.filter("confidence >= 0.92"), "posting_id", order, [(0.95, 1.0), (0.9, 0.9), (0, 0.8)], "confidence").withColumn("confidence", mart.half_up(F.col("confidence")))


@query("""
SELECT job_uid, keyword_id, bridge_id, CAST(position AS INT) AS position, round(c * CASE WHEN position = 1 AND c >= 0.8 THEN 1.0 WHEN position <= 3 AND c >= 0.7 THEN 0.9 WHEN c >= 0.7 THEN 0.8 ELSE 0.7 END, 4) AS weight
FROM (SELECT job_uid, keyword_id, bridge_id, overall_confidence AS c, row_number() OVER (PARTITION BY job_uid ORDER BY overall_confidence DESC, bridge_id, keyword_id) AS position
      FROM job_keywords_bridge WHERE overall_confidence >= 0.5)""")
def keywords_bridge_weighted(spark: SparkSession, d: str) -> DataFrame:
    from pyspark.sql import Window

    w = Window.partitionBy("job_uid").orderBy(F.desc("overall_confidence"), "bridge_id", "keyword_id")
    b = table(spark, d, "job_keywords_bridge").filter("overall_confidence >= 0.5").withColumn("position", F.row_number().over(w))
    return b.select("job_uid", "keyword_id", "bridge_id", "position", mart.keyword_weight(F.col("position"), F.col("overall_confidence")).alias("weight"))


@query("""
SELECT job_uid, llm_processing_timestamp, min_years_experience, is_minimum, CAST(round(CASE WHEN is_minimum THEN 1.2 ELSE 1.0 END * c, 4) AS DOUBLE) AS weight,
  row_number() OVER (PARTITION BY job_uid ORDER BY c DESC, is_minimum DESC, coalesce(min_years_experience, 999), llm_processing_timestamp NULLS LAST) = 1 AS is_primary
FROM (SELECT DISTINCT job_uid, llm_processing_timestamp, min_years_experience, max_years_experience IS NULL AS is_minimum, llm_overall_confidence AS c FROM jobs_llm_enriched WHERE llm_overall_confidence >= 0.7)""")
def experience_bridge_primary(spark: SparkSession, d: str) -> DataFrame:
    from pyspark.sql import Window

    j = table(spark, d, "jobs_llm_enriched").filter("llm_overall_confidence >= 0.7").select(
        "job_uid", "llm_processing_timestamp", "min_years_experience", F.col("max_years_experience").isNull().alias("is_minimum"), F.col("llm_overall_confidence").alias("c")
    ).distinct()
    w = Window.partitionBy("job_uid").orderBy(F.desc("c"), F.desc("is_minimum"), F.coalesce("min_years_experience", F.lit(999)), F.asc_nulls_last("llm_processing_timestamp"))
    weight = mart.half_up(F.when(F.col("is_minimum"), 1.2).otherwise(1.0) * F.col("c"))
    return j.select("job_uid", "llm_processing_timestamp", "min_years_experience", "is_minimum", weight.alias("weight"), (F.row_number().over(w) == 1).alias("is_primary"))


@query("""
SELECT strftime(day, '%Y%m%d') AS date_key, day, CAST(year(day) AS INT) AS year, CAST(quarter(day) AS INT) AS quarter, CAST(month(day) AS INT) AS month, strftime(day, '%b') AS month_name,
  CAST(weekofyear(day) AS INT) AS week, CAST(day(day) AS INT) AS day_of_month, CAST(dayofweek(day) + 1 AS INT) AS day_of_week, strftime(day, '%a') AS day_name, dayofweek(day) IN (0, 6) AS is_weekend,
  CAST(date_trunc('week', day) AS DATE) AS week_start, CAST(date_trunc('week', day) AS DATE) + 6 AS week_end,
  isoyear(day) || '-' || lpad(CAST(weekofyear(day) AS VARCHAR), 2, '0') AS week_key, strftime(day, '%Y-%m') AS month_key
FROM (SELECT CAST(unnest(generate_series(DATE '2020-01-01', DATE '2029-12-31', INTERVAL 1 DAY)) AS DATE) AS day)""")
def date_dimension(spark: SparkSession, d: str) -> DataFrame:
    return mart.date_dimension(spark, "2020-01-01", "2029-12-31")
