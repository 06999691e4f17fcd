"""Queries of staging, enrichment and the remaining report views."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyforge.functions import text
from tallyforge.operators.incremental import capped_per_group
from tallyforge.plans import staging
from tallyforge.plans.mart import rounded
from tallyforge.plans.registry import registry
from tallyforge.plans.text_queries import _UID, _language_sql
from tallyforge.sources.files import active_with_company
from tallyforge.sources.platforms import unified
from tallyforge.sources.tables import table

QUERIES, ORACLE, query = registry()


def _companies(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "companies").groupBy(F.col("company_id").cast("string").alias("company_id")).agg(F.max("company_name").alias("company_name"))


_NAMES = "(SELECT CAST(company_id AS VARCHAR) AS company_id, max(company_name) AS company_name FROM companies GROUP BY 1)"
_CLEAN = f"""(SELECT row_number() OVER () AS rid, {_UID} AS job_uid, job_id, i.company_id, {text.job_title_sql('job_title')} AS title, {text.description_sql('job_description')} AS body, {text.company_name_sql('company_name')} AS name,
    job_url, posted_date, date_retrieved, {text.employment_status_sql('position_type')} AS status FROM (SELECT * FROM icims_jobs) i LEFT JOIN {_NAMES} c ON c.company_id = i.company_id)""".replace("WHEN company_id IS NULL OR company_id = '' THEN 'NULL_COMPANY' ELSE trim(company_id)", "WHEN i.company_id IS NULL OR i.company_id = '' THEN 'NULL_COMPANY' ELSE trim(i.company_id)")
_LANG = """CASE WHEN t.confidence >= 0.8 AND (b.confidence < 0.8 OR (t.lang IN ('ko', 'zh', 'ja') AND t.lang <> b.lang)) THEN t.{0} WHEN b.confidence >= 0.8 THEN b.{0} WHEN tb.confidence >= 0.8 THEN tb.{0} WHEN t.confidence > b.confidence THEN t.{0} ELSE b.{0} END"""


@query(f"""WITH c AS MATERIALIZED {_CLEAN}, t AS ({_language_sql('c', 'rid', 'title')}), b AS ({_language_sql('c', 'rid', 'body')}), tb AS ({_language_sql('c', 'rid', "title || ' ' || body")})
    SELECT job_uid, job_id, company_id, title AS job_title_clean, body AS job_description_clean, name AS company_name_clean, detected_language, language_confidence, is_english, employment_status, data_quality_score FROM (
    SELECT c.*, {_LANG.format('lang')} AS detected_language, {_LANG.format('confidence')} AS language_confidence, {_LANG.format('lang')} = 'en' AND {_LANG.format('confidence')} >= 0.8 AS is_english, status AS employment_status,
      round((coalesce(job_id <> '', false)::INT + coalesce(c.company_id <> '', false)::INT + (title <> '')::INT + (body <> '')::INT + (name <> '')::INT + 1 + coalesce(job_url <> '', false)::INT + (posted_date IS NOT NULL)::INT + coalesce(status <> '', false)::INT) / 10.0, 4) AS data_quality_score,
      row_number() OVER (PARTITION BY job_uid ORDER BY date_retrieved DESC NULLS LAST, title, body) AS rn FROM c JOIN t USING (rid) JOIN b USING (rid) JOIN tb USING (rid)) WHERE rn = 1""")
def jobs_unified(spark: SparkSession, d: str) -> DataFrame:
    """Raw postings through the whole staging (places are checked by location_parse)."""
    raw = table(spark, d, "icims_jobs").withColumn("location", F.coalesce("location", F.lit("Nowhere")))
    u = staging.stage(raw, "icims", _companies(spark, d), F.lit("2025-07-01"))
    return u.select(
        "job_uid", "job_id", "company_id", "job_title_clean", "job_description_clean", "company_name_clean", "detected_language", "language_confidence", "is_english", "employment_status", "data_quality_score"
    )


BOARDS = ("bamboohr", "greenhouse", "smartrecruiters", "workday")
_BOARD = "(ascii(substr(reverse(job_id), 1, 1)) + {0}) % 4"
_ON_BOARDS = "(SELECT *, list_extract(['" + "', '".join(BOARDS) + "'], 1 + " + _BOARD.format(0) + ") AS platform FROM icims_jobs UNION ALL SELECT *, list_extract(['" + "', '".join(BOARDS) + "'], 1 + " + _BOARD.format(1) + ") FROM icims_jobs WHERE length(job_title) % 3 = 0)"
_BOARD_UID = _UID.replace("'icims'", "platform").replace("icims", "' || platform || '") if "'icims'" in _UID else _UID.replace("icims", "' || platform || '")


def _on_boards(spark: SparkSession, d: str) -> DataFrame:
    """Postings spread over four boards, some of them on two."""
    j = table(spark, d, "icims_jobs")
    names = F.array(*map(F.lit, BOARDS))
    on = lambda df, k: df.withColumn("platform", F.element_at(names, (F.expr(_BOARD.format(k)) + 1).cast("int")))
    return on(j, 0).unionByName(on(j.filter("length(job_title) % 3 = 0"), 1))


def _as_delivered(j: DataFrame, board: str) -> DataFrame:
    """Rows of one board with the columns that it has."""
    own = {
        "bamboohr": {"date_posted": "posted_date", "department": "category", "employment_status": "position_type", "work_type": "location"}, "greenhouse": {"published_at": "posted_date", "department": "category", "requisition_id": "position_type"},
        "smartrecruiters": {"published_at": "posted_date", "department": "category", "requisition_id": "position_type"}, "workday": {"published_at": "posted_date", "employment_type": "position_type", "time_type": "category"},
    }[board]
    common = ("job_id", "company_id", "job_title", "job_description", "job_url", "location", "date_retrieved", "is_active", "raw_data", "partition_key")
    return j.filter(F.col("platform") == board).select(*common, *[F.col(c).alias(n) for n, c in own.items()])


_STATUS = text.employment_status_sql("position_type")
_JSON = "CASE WHEN {0} IS NULL AND {1} IS NULL THEN NULL ELSE '{{' || concat_ws(',', '\"{2}\":\"' || {0} || '\"', '\"{3}\":\"' || {1} || '\"') || '}}' END"


@query(f"""SELECT job_id, date_retrieved, platform, strftime(posted_date, '%Y-%m-%d') AS date_posted, CASE WHEN platform <> 'workday' THEN category END AS department, CASE WHEN platform IN ('bamboohr', 'workday') THEN {_STATUS} END AS employment_status,
    CASE platform WHEN 'bamboohr' THEN {_JSON.format('position_type', 'location', 'employment_status', 'work_type')} WHEN 'workday' THEN {_JSON.format('category', 'position_type', 'time_type', 'employment_type')}
      ELSE CASE WHEN position_type IS NULL THEN NULL ELSE '{{"requisition_id":"' || position_type || '"}}' END END AS platform_specific_data FROM {_ON_BOARDS}""")
def platform_mappings(spark: SparkSession, d: str) -> DataFrame:
    """What four boards deliver, brought to one schema: a field that a board lacks is null, what only it has goes to JSON."""
    j = _on_boards(spark, d)
    parts = [unified(_as_delivered(j, b), b).withColumn("date_posted", F.date_format("date_posted", "yyyy-MM-dd")) for b in BOARDS]
    return reduce(DataFrame.unionByName, [p.select("job_id", "date_retrieved", "platform", "date_posted", "department", "employment_status", "platform_specific_data") for p in parts])


@query(f"""SELECT job_uid, job_id, platform, date_retrieved FROM (SELECT *, CASE WHEN job_id IS NULL THEN 1 ELSE row_number() OVER (PARTITION BY job_id ORDER BY date_retrieved NULLS LAST, platform, job_uid) END AS place FROM (
    SELECT job_uid, job_id, platform, date_retrieved FROM (SELECT *, row_number() OVER (PARTITION BY job_uid ORDER BY date_retrieved DESC NULLS LAST) AS rn FROM (SELECT {_BOARD_UID} AS job_uid, job_id, platform, date_retrieved FROM {_ON_BOARDS})) WHERE rn = 1)) WHERE place = 1""")
def jobs_unified_boards(spark: SparkSession, d: str) -> DataFrame:
    """Four boards staged, merged into a table that has some of the postings already, and deduplicated across boards."""
    j = _on_boards(spark, d)
    raws = {b: _as_delivered(j, b) for b in BOARDS}
    columns = ["job_uid", "job_id", "platform", "date_retrieved", "employment_status", "department", "partition_date"]
    companies, day = _companies(spark, d), F.lit("2025-07-01")
    old = staging.stage(raws["workday"].filter("is_active"), "workday", companies, F.lit("2025-06-30")).select(*columns)
    return staging.unify(raws, companies, old, day).select("job_uid", "job_id", "platform", "date_retrieved")


@query("""SELECT job_uid, salary_min, salary_max, coalesce(salary_currency, 'USD') AS salary_currency, coalesce(equity_mentioned, false) AS equity_mentioned, min_years_experience, technical_skills, work_type, job_family,
    round(llm_overall_confidence, 4) AS llm_overall_confidence, llm_overall_confidence < 0.6 AS llm_needs_manual_review FROM jobs_llm_enriched WHERE NOT isnan(llm_overall_confidence)""")
def enriched_records(spark: SparkSession, d: str) -> DataFrame:
    """Enriched columns written as a model's answer between prose, and read again."""
    j = table(spark, d, "jobs_llm_enriched").filter("llm_overall_confidence is not null and not isnan(llm_overall_confidence)")
    conf = F.col("llm_overall_confidence").alias("confidence")
    js = F.to_json(F.struct(
        F.struct("salary_min", "salary_max", "salary_currency", "equity_mentioned", conf).alias("salary_info"), F.struct("min_years_experience", conf).alias("experience_requirements"),
        F.struct("technical_skills", conf).alias("skills"), F.struct("work_type", conf).alias("work_arrangement"), F.struct("job_family", conf).alias("job_classification"),
    ))
    answers = staging.salvaged(j.select("job_uid", F.concat(F.lit("Here you are: "), js, F.lit(" That is all.")).alias("answer")))
    e = staging.enriched(answers, "job_uid", "answer")
    return rounded(e.select("job_uid", "salary_min", "salary_max", "salary_currency", "equity_mentioned", "min_years_experience", "technical_skills", "work_type", "job_family", "llm_overall_confidence", "llm_needs_manual_review"))


@query(r"""SELECT job_id, date_retrieved, coalesce(TRY_CAST(nullif(regexp_extract(b, '([0-9]{1,2})\+?\s*(?:-\s*[0-9]{1,2}\s*)?years', 1), '') AS BIGINT), TRY_CAST(nullif(regexp_extract(b, '([0-9]{1,3}) months of practice', 1), '') AS BIGINT) // 12) AS min_years_experience,
    CASE WHEN regexp_matches(b, '\bhybrid\b') THEN 'Hybrid' WHEN regexp_matches(b, '\bremote(?:ly)?\b') THEN 'Remote' WHEN regexp_matches(b, '\bon[- ]site\b') THEN 'On-site' END AS work_type
    FROM (SELECT job_id, date_retrieved, lower(coalesce(job_description, '')) AS b FROM icims_jobs)""")
def rule_extraction(spark: SparkSession, d: str) -> DataFrame:
    """The built-in extractor through the same JSON as a model's answers."""
    j = table(spark, d, "icims_jobs").withColumn("k", F.struct("job_id", "date_retrieved"))
    e = staging.enriched(staging.rule_answers(j, "k", "job_title", "job_description"), "k", "answer")
    return e.select("k.job_id", "k.date_retrieved", "min_years_experience", "work_type")


@query(f"SELECT job_id, date_retrieved, company_name FROM icims_jobs i LEFT JOIN {_NAMES} c ON c.company_id = i.company_id WHERE is_active")
def active_raw_with_company(spark: SparkSession, d: str) -> DataFrame:
    return active_with_company(table(spark, d, "icims_jobs"), _companies(spark, d)).select("job_id", "date_retrieved", "company_name")


@query("""SELECT platform, count(*) AS jobs, count(DISTINCT job_family) AS families, count(*) FILTER (salary_min IS NOT NULL) AS with_salary, round(avg((technical_skills IS NOT NULL)::INT) * 100, 4) AS skills_share,
    min(llm_processing_timestamp) AS first_seen, max(llm_processing_timestamp) AS last_seen FROM jobs_llm_enriched GROUP BY 1""")
def platform_summary(spark: SparkSession, d: str) -> DataFrame:
    return rounded(table(spark, d, "jobs_llm_enriched").groupBy("platform").agg(
        F.count("*").alias("jobs"), F.count_distinct("job_family").alias("families"), F.count("salary_min").alias("with_salary"),
        (F.avg(F.col("technical_skills").isNotNull().cast("int")) * 100).alias("skills_share"), F.min("llm_processing_timestamp").alias("first_seen"), F.max("llm_processing_timestamp").alias("last_seen"),
    ))


@query("""SELECT kind, location_standardized, n, CAST(rn AS INT) AS rank_in_group FROM (SELECT *, row_number() OVER (PARTITION BY kind ORDER BY n DESC, location_standardized) AS rn FROM (
    SELECT CASE WHEN contains(lower(location_raw), 'remote') THEN 'remote' WHEN contains(lower(location_raw), 'hybrid') THEN 'hybrid' ELSE 'office' END AS kind, location_standardized, count(*) AS n
    FROM location_mapping WHERE location_standardized IS NOT NULL GROUP BY ALL)) WHERE rn <= 15""")
def top_locations_by_type(spark: SparkSession, d: str) -> DataFrame:
    low = F.lower("location_raw")
    kind = F.when(F.contains(low, F.lit("remote")), "remote").when(F.contains(low, F.lit("hybrid")), "hybrid").otherwise("office")
    m = table(spark, d, "location_mapping").filter("location_standardized is not null").groupBy(kind.alias("kind"), "location_standardized").agg(F.count("*").alias("n"))
    return capped_per_group(m, "kind", [F.desc("n"), F.asc("location_standardized")], 15)


@query("""SELECT count(*) AS n, count(DISTINCT location_raw) AS n_raw, count(location_standardized) AS settled, round(count(location_standardized) * 100.0::DOUBLE / count(*), 4) AS settled_share, count(DISTINCT country) AS countries FROM location_mapping""")
def locations_coverage(spark: SparkSession, d: str) -> DataFrame:
    return rounded(table(spark, d, "location_mapping").agg(
        F.count("*").alias("n"), F.count_distinct("location_raw").alias("n_raw"), F.count("location_standardized").alias("settled"),
        F.try_divide(F.count("location_standardized") * 100.0, F.count("*")).alias("settled_share"), F.count_distinct("country").alias("countries"),
    ))


@query("""SELECT check_name, n, n BETWEEN low AND high AS in_range FROM (SELECT 'locations' AS check_name, (SELECT count(*) FROM ref_locations) AS n, 300 AS low, 400 AS high
    UNION ALL SELECT 'keywords', (SELECT count(*) FROM ref_keywords), 200, 300 UNION ALL SELECT 'states_without_country', (SELECT count(*) FROM ref_locations WHERE state IS NOT NULL AND country IS NULL), 0, 0)""")
def taxonomy_validation(spark: SparkSession, d: str) -> DataFrame:
    """Reference tables against the sizes that they should have."""
    places = table(spark, d, "ref_locations")
    one = lambda df, name, low, high: df.agg(F.lit(name).alias("check_name"), F.count("*").alias("n")).withColumn("in_range", F.col("n").between(low, high))
    return one(places, "locations", 300, 400).unionByName(one(table(spark, d, "ref_keywords"), "keywords", 200, 300)).unionByName(one(places.filter("state is not null and country is null"), "states_without_country", 0, 0))
