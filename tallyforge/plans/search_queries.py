"""Queries of the search over postings."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyforge.plans.mart import half_up, rounded
from tallyforge.plans.registry import registry
from tallyforge.plans.star_queries import _SERVED as _SERVED_SQL
from tallyforge.plans.star_queries import _served
from tallyforge.search.request import SearchRequest, language_counts, resolve_keywords, result_metrics, search, shaped
from tallyforge.sources.tables import table

QUERIES, ORACLE, query = registry()
COLUMNS = {"title": "job_title", "body": "job_description", "posted": "posted_date"}
_BOTH = "(contains(lower(coalesce(job_title, '')), '{0}') OR contains(lower(coalesce(job_description, '')), '{0}'))"


def _has(term: str) -> str:
    return _BOTH.format(term)


def _jobs(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "icims_jobs")


@query(f"""SELECT job_id, date_retrieved, round((0.4::DOUBLE * (({_has('payroll')})::INT + ({_has('sensor')})::INT) / 2 + 0.3::DOUBLE * (contains(lower(coalesce(job_title, '')), 'analyst'))::INT + 0.2::DOUBLE * (coalesce(contains(lower(location), 'germany'), false)::INT + coalesce(contains(lower(location), 'ny'), false)::INT) / 2) / 0.9, 4) AS relevance
    FROM icims_jobs WHERE ({_has('payroll')} OR {_has('sensor')}) AND posted_date >= DATE '2024-03-01' AND NOT {_has('intern ')}""")
def search_relevance(spark: SparkSession, d: str) -> DataFrame:
    """Every match with its score; titles and places don't filter here, so they are asked in the score only."""
    r = SearchRequest(keywords=["payroll", "Sensor"], exclude=["intern "], posted_from=dt.date(2024, 3, 1), columns=COLUMNS)
    scored = SearchRequest(keywords=["payroll", "Sensor"], titles=["Analyst"], locations=["Germany", "ny"], columns=COLUMNS)
    from tallyforge.search.request import predicate, relevance

    j = _jobs(spark, d)
    return j.filter(predicate(r, j)).select("job_id", "date_retrieved", half_up(relevance(scored, j)).alias("relevance"))


@query(f"""SELECT job_id, date_retrieved FROM icims_jobs WHERE {_has('reporting')} AND {_has('customers')} AND regexp_matches(lower(coalesce(job_title, '')), '(^|[^a-z0-9])lead($|[^a-z0-9])')
    AND NOT contains(lower(coalesce(location, '')), 'remote') AND (regexp_matches(location, '(^|[^A-Za-z])NY($|[^A-Za-z])') OR contains(lower(location), 'junction'))""")
def search_predicates(spark: SparkSession, d: str) -> DataFrame:
    r = SearchRequest(all_terms=["reporting", "customers"], titles=["Lead"], locations=["NY", "Junction"], remote=False, columns=COLUMNS)
    return search(_jobs(spark, d), r).select("job_id", "date_retrieved")


@query(f"""SELECT job_id, date_retrieved FROM (SELECT * FROM icims_jobs WHERE {_has('pricing')} AND is_active ORDER BY posted_date DESC NULLS LAST, job_id, company_id, job_title, job_description, job_url, location, position_type, category, date_retrieved LIMIT 40)
    WHERE contains(lower(coalesce(job_title, '')), 'pricing')""")
def search_legacy_limit(spark: SparkSession, d: str) -> DataFrame:
    """A service that cuts its ranking before it asks for relevance (max_results is the feature)."""
    r = SearchRequest(keywords=["pricing"], max_results=40, legacy_limit=True, columns=COLUMNS)
    return search(_jobs(spark, d).filter("is_active"), r).filter(F.contains(F.lower(F.coalesce("job_title", F.lit(""))), F.lit("pricing"))).select("job_id", "date_retrieved")


@query("""SELECT p_brand FROM (SELECT p_brand, string_agg(DISTINCT p_type, ', ') AS l, list(DISTINCT lower(p_type)) AS items FROM part GROUP BY 1) WHERE list_contains(items, lower((SELECT min(p_type) FROM part)))""")
def csv_membership(spark: SparkSession, d: str) -> DataFrame:
    from tallyforge.functions.predicates import in_list

    lists = table(spark, d, "part").groupBy("p_brand").agg(F.array_join(F.array_sort(F.collect_set("p_type")), ", ").alias("l"))
    first = table(spark, d, "part").agg(F.min("p_type")).first()[0]  # one value: what a user would type
    return lists.filter(in_list(F.col("l"), str(first).upper())).select("p_brand")


@query("SELECT DISTINCT keyword_text_clean AS keyword FROM keywords_normalized WHERE lower(trim(keyword_text_clean)) IN ('team player', 'fleet revenue operations', 'asap') AND lower(trim(keyword_text_clean)) <> 'asap'")
def keyword_resolution(spark: SparkSession, d: str) -> DataFrame:
    k = table(spark, d, "keywords_normalized").select(F.col("keyword_text_clean").alias("keyword"))
    return resolve_keywords(k, ["Team Player", "fleet revenue operations", "ASAP"], ["asap"])


@query("""SELECT job_uid, llm_processing_timestamp, CASE WHEN salary_confidence >= 0.7 THEN salary_min END AS shown_min, CASE WHEN llm_overall_confidence >= 0.6 THEN technical_skills[1:2] END AS shown_skills FROM jobs_llm_enriched""")
def shaped_fields(spark: SparkSession, d: str) -> DataFrame:
    gates = {"pay": ("salary_confidence", 0.7, ["salary_min", "salary_max"]), "skills": ("llm_overall_confidence", 0.6, ["technical_skills"])}
    s = shaped(table(spark, d, "jobs_llm_enriched"), gates, list_cap=2)
    # A confidence that is not a number counts as none.
    return s.select("job_uid", "llm_processing_timestamp", F.col("pay.salary_min").alias("shown_min"), F.col("skills.technical_skills").alias("shown_skills"))


@query("""SELECT count(*) AS total, round(avg(llm_overall_confidence), 4) AS mean_quality, count(*) FILTER (llm_overall_confidence > 0.8) AS high, count(*) FILTER (llm_overall_confidence BETWEEN 0.5 AND 0.8) AS medium,
    count(*) FILTER (llm_overall_confidence < 0.5) AS low, count(*) - count(DISTINCT job_uid) AS repeated FROM jobs_llm_enriched WHERE job_family = 'energy'""")
def search_metrics(spark: SparkSession, d: str) -> DataFrame:
    return rounded(result_metrics(table(spark, d, "jobs_llm_enriched").filter("job_family = 'energy'"), "llm_overall_confidence", "job_uid"))


_TERMS = f"(({_has('payroll')})::INT + ({_has('sensor')})::INT) / 2"
_IN_TITLE, _NEAR = "(contains(lower(coalesce(job_title, '')), 'analyst'))::INT", "(coalesce(contains(lower(location), 'germany'), false)::INT + coalesce(contains(lower(location), 'ny'), false)::INT) / 2"


def _scores(spark: SparkSession, d: str, how: str) -> DataFrame:
    from tallyforge.search.request import relevance

    r = SearchRequest(keywords=["payroll", "Sensor"], titles=["Analyst"], locations=["Germany", "ny"], score=how, columns=COLUMNS)
    j = _jobs(spark, d)
    return j.select("job_id", "date_retrieved", half_up(relevance(r, j)).alias("relevance"))


@query(f"SELECT job_id, date_retrieved, round(0.5::DOUBLE * {_TERMS} + 0.3::DOUBLE * {_IN_TITLE} + 0.2::DOUBLE * {_NEAR}, 4) AS relevance FROM icims_jobs")
def search_relevance_basic(spark: SparkSession, d: str) -> DataFrame:
    return _scores(spark, d, "basic")


@query(f"SELECT job_id, date_retrieved, round(0.6::DOUBLE * {_TERMS} + 0.25::DOUBLE * {_IN_TITLE} + 0.15::DOUBLE * {_NEAR}, 4) AS relevance FROM icims_jobs")
def search_relevance_advanced(spark: SparkSession, d: str) -> DataFrame:
    return _scores(spark, d, "advanced")


@query("""SELECT job_id, job_title, posted_date FROM (SELECT * FROM (SELECT DISTINCT job_id, job_title, job_description, location, category, posted_date FROM icims_jobs WHERE is_active) WHERE contains(lower(coalesce(location, '')), 'a') AND (contains(lower(coalesce(job_title, '')), 'pricing') OR contains(lower(coalesce(category, '')), 'pricing')
    OR contains(lower(coalesce(location, '')), 'pricing') OR contains(lower(coalesce(job_description, '')), 'pricing'))) ORDER BY posted_date DESC NULLS LAST, job_id, job_title, job_description, location, category LIMIT 25""")
def site_listing(spark: SparkSession, d: str) -> DataFrame:
    """The facets of a site: a place, free text in four fields, and the first 25 (the cap is the feature)."""
    r = SearchRequest(free_text="Pricing", locations=["A part", "a"], max_results=25, columns=COLUMNS | {"company": "category"})
    j = _jobs(spark, d).filter("is_active").select("job_id", "job_title", "job_description", "location", "category", "posted_date").distinct()
    return search(j, r).select("job_id", "job_title", "posted_date")


_LISTED = "list_contains(list_transform(string_split(lower({0}), ','), lambda x: trim(x, ' ')), '{1}')"


@query(f"""SELECT posting_id FROM {_SERVED_SQL} WHERE (coalesce({_LISTED.format('skills', 'lab samples')}, false) OR coalesce({_LISTED.format('skill_categories', 'pricing')}, false)) AND NOT coalesce({_LISTED.format('skills', 'claims forms')}, false)
    AND lower(platform) IN ('icims', 'workday', 'bamboohr') AND (contains(lower(job_title_clean), 'energy') OR contains(lower(job_title_clean), 'clinical') OR contains(lower(job_title_clean), 'e') AND contains(lower(job_title_clean), 't'))""")
def search_advanced(spark: SparkSession, d: str) -> DataFrame:
    """The serving table by skills or their categories, without a skill, on some boards, with terms or titles."""
    s = _served(spark, d)
    r = SearchRequest(
        skills=["Lab samples"], skill_categories=["pricing"], exclude_skills=["claims forms"], platforms=["icims", "Workday", "bamboohr"], all_terms=["e", "t"], titles=["Energy", "clinical"], titles_or_terms=True,
        columns={"title": "job_title_clean", "body": "company_name", "categories_csv": "skill_categories", "skills_csv": "skills"},
    )
    return search(s.withColumn("company_name", F.lit("")), r).select("posting_id")


@query("SELECT coalesce(l.lang, 'none') AS lang, count(*) AS n FROM documents l GROUP BY 1")
def search_language_counts(spark: SparkSession, d: str) -> DataFrame:
    return language_counts(table(spark, d, "documents"), "lang")
