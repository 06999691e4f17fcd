"""Queries of dimensions and serving tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyforge.operators.dml import latest_per_key
from tallyforge.plans import dimensions as dim
from tallyforge.plans.mart import rounded
from tallyforge.plans.registry import registry
from tallyforge.sources.tables import table

QUERIES, ORACLE, query = registry()


def _case(cases, otherwise: str) -> str:
    return "CASE " + " ".join(f"WHEN contains(s, '{w}') THEN {n}" for w, n in cases) + f" ELSE {otherwise} END"


@query(f"""SELECT 'JF_' || md5(coalesce(job_family, '~') || '|' || coalesce(seniority_level, '~') || '|' || coalesce(work_type, '~')) AS job_family_key, job_family, seniority_level, work_type,
    CAST({_case(dim.SENIORITY, '3')} AS INT) AS seniority_order, {' OR '.join(f"contains(s, '{w}')" for w in dim.MANAGEMENT)} AS is_management
    FROM (SELECT DISTINCT job_family, seniority_level, work_type, lower(coalesce(seniority_level, '')) AS s FROM jobs_llm_enriched)""")
def job_family_dimension(spark: SparkSession, d: str) -> DataFrame:
    return dim.job_family_dimension(table(spark, d, "jobs_llm_enriched"))


@query("""SELECT platform, count(*) AS postings, avg((salary_min IS NOT NULL)::INT) >= 0.1 AS discloses_pay, round(least(greatest(avg(llm_overall_confidence), 0), 1), 4) AS richness,
    CASE WHEN count(*) >= 1000 THEN 'High' WHEN count(*) >= 100 THEN 'Medium' ELSE 'Low' END AS volume, date_diff('day', CAST(max(llm_processing_timestamp) AS DATE), DATE '2025-07-01') <= 30 AS is_active FROM jobs_llm_enriched GROUP BY 1""")
def platform_dimension(spark: SparkSession, d: str) -> DataFrame:
    j = table(spark, d, "jobs_llm_enriched").select("platform", F.col("llm_processing_timestamp").cast("date").alias("posted"), F.col("salary_min").isNotNull().alias("has_pay"), F.col("llm_overall_confidence").alias("richness"))
    return rounded(dim.platform_dimension(j, F.lit("2025-07-01").cast("date")))


@query("""SELECT location_id, city, state, country FROM ref_locations WHERE city IS NOT NULL AND country IS NOT NULL""")
def location_dimension(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "ref_locations").filter("city is not null and country is not null").select("location_id", "city", "state", "country")


@query("""SELECT salary_id, salary_min_annual_usd, salary_max_annual_usd, salary_midpoint_annual_usd FROM salary_normalized WHERE confidence_score >= 0.5 AND NOT coalesce(outlier_flag, false) AND salary_min_annual_usd > 0 AND salary_min_annual_usd <= salary_max_annual_usd""")
def salary_dimension(spark: SparkSession, d: str) -> DataFrame:
    s = dim.gated(table(spark, d, "salary_normalized"), "confidence_score", F.col("outlier_flag"))
    return s.filter("salary_min_annual_usd > 0 and salary_min_annual_usd <= salary_max_annual_usd").select("salary_id", "salary_min_annual_usd", "salary_max_annual_usd", "salary_midpoint_annual_usd")


@query("""SELECT DISTINCT keyword_id, keyword_text_clean, coalesce(keyword_category, 'General') AS category, keyword_type FROM keywords_normalized WHERE confidence_score >= 0.5""")
def keyword_dimension(spark: SparkSession, d: str) -> DataFrame:
    return dim.gated(table(spark, d, "keywords_normalized"), "confidence_score").select("keyword_id", "keyword_text_clean", F.coalesce("keyword_category", F.lit("General")).alias("category"), "keyword_type").distinct()


@query("SELECT DISTINCT job_uid, min_years_experience, max_years_experience FROM jobs_llm_enriched WHERE llm_overall_confidence >= 0.5 AND min_years_experience <= max_years_experience")
def experience_dimension(spark: SparkSession, d: str) -> DataFrame:
    return dim.gated(table(spark, d, "jobs_llm_enriched"), "llm_overall_confidence").filter("min_years_experience <= max_years_experience").select("job_uid", "min_years_experience", "max_years_experience").distinct()


@query("SELECT p_brand, p_type, string_agg(DISTINCT p_name, ', ' ORDER BY p_name) AS items, count(DISTINCT p_name) AS n_items FROM part GROUP BY ALL")
def denorm_skills(spark: SparkSession, d: str) -> DataFrame:
    return dim.denorm_list(table(spark, d, "part"), ["p_brand", "p_type"], "p_name")


@query("""WITH n AS (SELECT p_brand, string_agg(DISTINCT p_name, ', ' ORDER BY p_name) AS items, count(DISTINCT p_name) AS n_items FROM part WHERE p_size > 5 GROUP BY ALL) SELECT * FROM n""")
def denorm_skills_refresh(spark: SparkSession, d: str) -> DataFrame:
    """The serving table after a second run: what changed is replaced, what vanished is pruned."""
    p = table(spark, d, "part")
    return dim.refresh_denorm(dim.denorm_list(p.filter("p_size < 20"), ["p_brand"], "p_name"), dim.denorm_list(p.filter("p_size > 5"), ["p_brand"], "p_name"), ["p_brand"], ["items"])


@query("SELECT lower(trim(keyword_text_clean)) AS keyword, min(keyword_type) AS keyword_type FROM keywords_normalized WHERE keyword_text_clean IS NOT NULL GROUP BY 1")
def denorm_keywords(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "keywords_normalized").filter("keyword_text_clean is not null").groupBy(F.lower(F.trim("keyword_text_clean")).alias("keyword")).agg(F.min("keyword_type").alias("keyword_type"))


@query("SELECT keyword_text_clean AS skill, max(frequency_count) AS n FROM keywords_normalized WHERE keyword_text_clean IS NOT NULL GROUP BY 1 HAVING max(frequency_count) > 0")
def skill_counts(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "keywords_normalized").filter("keyword_text_clean is not null").groupBy(F.col("keyword_text_clean").alias("skill")).agg(F.max("frequency_count").alias("n")).filter("n > 0")


_J = "(SELECT job_uid, job_family, seniority_level, technical_skills FROM (SELECT *, row_number() OVER (PARTITION BY job_uid ORDER BY llm_processing_timestamp DESC NULLS LAST, last_updated DESC NULLS LAST) AS rn FROM jobs_llm_enriched) WHERE rn = 1)"


@query(f"""SELECT j.job_uid AS posting_id, job_family, seniority_level, s.skills, s.skill_categories, k.keywords FROM {_J} j
    LEFT JOIN (SELECT job_uid, string_agg(DISTINCT skill, ', ' ORDER BY skill) AS skills, string_agg(DISTINCT split_part(skill, ' ', 1), ', ' ORDER BY split_part(skill, ' ', 1)) AS skill_categories FROM (SELECT job_uid, unnest(technical_skills) AS skill FROM {_J}) WHERE skill IS NOT NULL GROUP BY 1) s USING (job_uid)
    LEFT JOIN (SELECT job_uid, string_agg(DISTINCT keyword_text_clean, ', ' ORDER BY keyword_text_clean) AS keywords FROM job_keywords_bridge b JOIN keywords_normalized n ON n.keyword_id = b.keyword_id WHERE keyword_text_clean IS NOT NULL GROUP BY 1) k USING (job_uid)""")
def denorm_postings_csv(spark: SparkSession, d: str) -> DataFrame:
    j = latest_per_key(table(spark, d, "jobs_llm_enriched"), ["job_uid"], [F.desc_nulls_last("llm_processing_timestamp"), F.desc_nulls_last("last_updated")])
    j = j.select(F.col("job_uid").alias("posting_id"), "job_family", "seniority_level", "technical_skills")
    skills = j.select("posting_id", F.explode("technical_skills").alias("skill")).filter("skill is not null").withColumn("category", F.split_part("skill", F.lit(" "), F.lit(1)))
    words = table(spark, d, "keywords_normalized").select("keyword_id", F.col("keyword_text_clean").alias("keyword")).filter("keyword is not null").distinct()
    keywords = table(spark, d, "job_keywords_bridge").select(F.col("job_uid").alias("posting_id"), "keyword_id").join(words, "keyword_id")
    return dim.denorm_postings(j.drop("technical_skills"), skills, keywords)
