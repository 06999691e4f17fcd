"""Queries of the posting star, the views over postings, the dimensions with gates, and the serving tables with their refresh."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyforge.operators.dml import latest_per_key
from tallyforge.plans import dimensions as dim
from tallyforge.plans import star
from tallyforge.plans.mart import rounded
from tallyforge.plans.registry import registry
from tallyforge.sources.tables import table

QUERIES, ORACLE, query = registry()
TODAY = "2025-05-01"


def _spread(a: int, b: int, n: int) -> tuple[str, str]:
    """A number below n from a posting's id, the same in both engines: the test tables don't say which company or place a posting has."""
    e = f"(ascii(substr(job_uid, {a}, 1)) * 31 + ascii(substr(job_uid, {b}, 1))) % {n}"
    return e, e


_COMPANY_OF, _PLACE_OF = _spread(1, 2, 300)[0], _spread(3, 4, 500)[0]
_LAST = "(SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY job_uid ORDER BY llm_processing_timestamp DESC NULLS LAST, last_updated DESC NULLS LAST) AS rn FROM jobs_llm_enriched WHERE job_uid IS NOT NULL) WHERE rn = 1)"
_JOBS = f"""(SELECT job_uid, CAST({_COMPANY_OF} AS VARCHAR) AS company_id, platform, 'Title ' || coalesce(job_family, '-') AS job_title_clean, m.location_standardized, CAST(llm_processing_timestamp AS DATE) AS date_posted, coalesce(e.validation_status, '') <> 'pending' AS is_active,
    coalesce(llm_overall_confidence > 0.3, false) AS is_english FROM {_LAST} e LEFT JOIN (SELECT mapping_id, location_standardized FROM location_mapping) m ON m.mapping_id = 1 + {_PLACE_OF})"""
_ENRICHED = f"(SELECT job_uid, job_family, CASE WHEN salary_min % 2 = 0 THEN 'Sub' END AS job_sub_family, seniority_level, work_type AS role_type, salary_min, salary_max, technical_skills FROM {_LAST})"
_COMPANIES = "(SELECT CAST(company_id AS VARCHAR) AS company_id, 'COMP_' || company_id AS company_key, company_id % 7 <> 0 AS is_current, company_name FROM (SELECT *, row_number() OVER (PARTITION BY company_id ORDER BY last_updated DESC NULLS LAST, record_id DESC) AS rn FROM companies WHERE company_id IS NOT NULL) WHERE rn = 1)"
_PLACES = "(SELECT location_name, 'LOC_' || location_id AS location_key, length(city) / 10.0::DOUBLE AS confidence FROM ref_locations UNION ALL SELECT upper(location_name), 'LOC_' || location_id || '_2', 0.1 FROM ref_locations)"
_FAMILIES = f"(SELECT DISTINCT job_family, coalesce(job_sub_family, 'General') AS job_sub_family, coalesce(seniority_level, 'Not Specified') AS seniority_level, coalesce(role_type, 'Not Specified') AS role_type FROM {_ENRICHED} WHERE job_family IS NOT NULL AND coalesce(seniority_level, '') <> 'Interim')"
_PAY = "(SELECT salary_id, 'SAL_' || salary_id AS salary_key, salary_midpoint_annual_usd AS midpoint FROM salary_normalized WHERE confidence_score >= 0.5 AND NOT coalesce(outlier_flag, false))"


def _last(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "jobs_llm_enriched").filter("job_uid is not null")
    return latest_per_key(e, ["job_uid"], [F.desc_nulls_last("llm_processing_timestamp"), F.desc_nulls_last("last_updated")])


def _jobs(spark: SparkSession, d: str) -> DataFrame:
    m = table(spark, d, "location_mapping").select((F.col("mapping_id") - 1).alias("_m"), "location_standardized")
    e = _last(spark, d).withColumn("_m", F.expr(_PLACE_OF).cast("long")).join(m, "_m", "left")
    return e.select(
        "job_uid", F.expr(_COMPANY_OF).cast("string").alias("company_id"), "platform", F.concat(F.lit("Title "), F.coalesce("job_family", F.lit("-"))).alias("job_title_clean"), "location_standardized",
        F.col("llm_processing_timestamp").cast("date").alias("date_posted"), (F.coalesce("validation_status", F.lit("")) != "pending").alias("is_active"), F.coalesce(F.col("llm_overall_confidence") > 0.3, F.lit(False)).alias("is_english"),
    )


def _enriched(spark: SparkSession, d: str) -> DataFrame:
    return _last(spark, d).select("job_uid", "job_family", F.when(F.col("salary_min") % 2 == 0, "Sub").alias("job_sub_family"), "seniority_level", F.col("work_type").alias("role_type"), "salary_min", "salary_max", "technical_skills")


def _companies(spark: SparkSession, d: str) -> DataFrame:
    c = latest_per_key(table(spark, d, "companies").filter("company_id is not null"), ["company_id"], [F.desc_nulls_last("last_updated"), F.desc("record_id")])
    key = F.concat(F.lit("COMP_"), F.col("company_id").cast("string"))
    return c.select(F.col("company_id").cast("string").alias("company_id"), key.alias("company_key"), (F.col("company_id") % 7 != 0).alias("is_current"), "company_name")


def _dims(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    ref = table(spark, d, "ref_locations")
    key, nothing = F.concat(F.lit("LOC_"), "location_id"), F.lit(None).cast("long").alias("frequency")
    places = ref.select("location_name", key.alias("location_key"), (F.length("city") / 10).alias("confidence"), nothing)
    again = ref.select(F.upper("location_name").alias("location_name"), F.concat(key, F.lit("_2")).alias("location_key"), F.lit(0.1).alias("confidence"), nothing)
    family = _enriched(spark, d).filter("job_family is not null and coalesce(seniority_level, '') <> 'Interim'")
    family = family.select(*[F.col(c) if v is None else F.coalesce(c, F.lit(v)).alias(c) for c, v in star.FAMILY.items()]).distinct()
    pay = dim.gated(table(spark, d, "salary_normalized"), "confidence_score", F.col("outlier_flag"))
    return {
        "company": _companies(spark, d), "location": places.unionByName(again), "job_family": family.withColumn("job_family_key", F.concat(F.lit("JF_"), F.md5(F.concat_ws("|", *star.FAMILY)))),
        "platform": spark.createDataFrame([("icims", "PLATFORM_1"), ("workday", "PLATFORM_2")], "platform string, platform_key string"),
        "description": _last(spark, d).filter("min_years_experience is not null").select("job_uid", F.concat(F.lit("JD_"), F.substring("job_uid", 1, 8)).alias("job_description_key")),
        "salary": pay.select("salary_id", F.concat(F.lit("SAL_"), "salary_id").alias("salary_key"), F.col("salary_midpoint_annual_usd").alias("midpoint")),
    }


_VALID = f"(SELECT * FROM {_JOBS} WHERE is_active AND is_english AND date_posted BETWEEN DATE '2020-01-01' AND DATE '{TODAY}')"


def _fact_sql(legacy: bool) -> str:
    pay = "(SELECT job_uid, salary_id, overall_confidence FROM job_salary_bridge WHERE validation_status <> 'rejected')" if legacy else """(SELECT job_uid, salary_id, overall_confidence FROM (SELECT *, row_number() OVER (PARTITION BY job_uid ORDER BY overall_confidence DESC NULLS LAST, salary_id NULLS LAST) AS rn FROM job_salary_bridge
        WHERE coalesce(validation_status, 'pending') <> 'rejected') WHERE rn = 1)"""
    return f"""SELECT j.job_uid, strftime(date_posted, '%Y%m%d') AS date_posted_key, coalesce(company_key, 'COMP_UNKNOWN') AS company_key, coalesce(location_key, 'LOC_UNKNOWN') AS location_key, coalesce(job_family_key, 'JF_UNKNOWN') AS job_family_key,
        CASE j.platform WHEN 'icims' THEN 'PLATFORM_1' WHEN 'workday' THEN 'PLATFORM_2' ELSE 'PLT_' || upper(j.platform) END AS platform_key, coalesce(salary_key, 'SAL_UNKNOWN') AS salary_key, coalesce(jd, 'JD_UNKNOWN') AS job_description_key,
        midpoint, overall_confidence AS salary_confidence, CAST(date_trunc('month', date_posted) AS DATE) AS partition_date
    FROM {_VALID} j LEFT JOIN {_ENRICHED} e ON e.job_uid = j.job_uid LEFT JOIN {_COMPANIES} c ON c.company_id = j.company_id AND c.is_current
    LEFT JOIN (SELECT *, row_number() OVER (PARTITION BY lower(location_name) ORDER BY confidence DESC NULLS LAST, location_key) AS rn FROM {_PLACES}) l ON lower(l.location_name) = lower(j.location_standardized) AND l.rn = 1
    LEFT JOIN (SELECT *, 'JF_' || md5(concat_ws('|', job_family, job_sub_family, seniority_level, role_type)) AS job_family_key FROM {_FAMILIES}) f ON f.job_family = e.job_family AND f.job_sub_family = coalesce(e.job_sub_family, 'General')
      AND f.seniority_level = coalesce(e.seniority_level, 'Not Specified') AND f.role_type = coalesce(e.role_type, 'Not Specified')
    LEFT JOIN (SELECT job_uid, 'JD_' || substr(job_uid, 1, 8) AS jd FROM {_LAST} WHERE min_years_experience IS NOT NULL) x ON x.job_uid = j.job_uid
    LEFT JOIN {pay} b ON b.job_uid = j.job_uid LEFT JOIN {_PAY} s ON s.salary_id = b.salary_id"""


def _fact(spark: SparkSession, d: str, legacy: bool) -> DataFrame:
    enriched = _enriched(spark, d).select("job_uid", *star.FAMILY)
    return star.posting_fact(_jobs(spark, d), enriched, _dims(spark, d), table(spark, d, "job_salary_bridge"), F.lit(TODAY).cast("date"), legacy)


@query(_fact_sql(False))
def posting_fact(spark: SparkSession, d: str) -> DataFrame:
    """Eight lookups, each posting once."""
    return _fact(spark, d, False)


@query(_fact_sql(True))
def posting_fact_legacy(spark: SparkSession, d: str) -> DataFrame:
    return _fact(spark, d, True)


_VIEW = "job_uid, company_id, date_posted, is_active, is_english"


@query(f"SELECT {_VIEW} FROM {_JOBS} WHERE is_english")
def jobs_english(spark: SparkSession, d: str) -> DataFrame:
    return star.english(_jobs(spark, d)).select(*_VIEW.split(", "))


@query(f"SELECT {_VIEW} FROM {_JOBS} WHERE is_active AND date_posted >= DATE '{TODAY}' - 30")
def jobs_recent(spark: SparkSession, d: str) -> DataFrame:
    return star.recent(_jobs(spark, d), F.lit(TODAY).cast("date")).select(*_VIEW.split(", "))


@query(f"SELECT j.job_uid, date_posted, e.salary_min, e.salary_max FROM {_JOBS} j JOIN jobs_llm_enriched e ON e.job_uid = j.job_uid WHERE e.salary_min IS NOT NULL OR e.salary_max IS NOT NULL")
def jobs_with_salary(spark: SparkSession, d: str) -> DataFrame:
    return star.with_salary(_jobs(spark, d), table(spark, d, "jobs_llm_enriched")).select("job_uid", "date_posted", "salary_min", "salary_max")


@query(f"SELECT {_VIEW} FROM {_VALID}")
def valid_postings(spark: SparkSession, d: str) -> DataFrame:
    """What the fact takes in: active, English, with a company, dated within range."""
    return star.valid_postings(_jobs(spark, d), F.lit(TODAY).cast("date")).select(*_VIEW.split(", "))


@query("""SELECT 'SKL_' || keyword_id AS skill_key, keyword_id AS skill_id, keyword_text_clean AS skill_name, keyword_category AS skill_category, canonical_form, CAST(NULL AS VARCHAR) AS common_aliases, frequency_count FROM
    (SELECT DISTINCT keyword_id, keyword_text_clean, keyword_category, canonical_form, frequency_count, confidence_score, approved_by_admin FROM keywords_normalized)
    WHERE confidence_score >= 0.5 AND (NOT confidence_score < 0.7 OR coalesce(approved_by_admin, false)) AND trim(canonical_form, ' ') <> '' AND trim(keyword_category, ' ') <> ''""")
def skills_dimension(spark: SparkSession, d: str) -> DataFrame:
    k = table(spark, d, "keywords_normalized").select(
        F.col("keyword_id").alias("skill_id"), F.col("keyword_text_clean").alias("skill"), F.col("keyword_category").alias("category"), "canonical_form", F.col("frequency_count").alias("frequency"),
        F.col("confidence_score").alias("confidence"), (F.col("confidence_score") < 0.7).alias("needs_review"), F.col("approved_by_admin").alias("approved"),
    ).distinct()
    return star.skills_dimension(k)


@query("""SELECT 'LOC_' || mapping_id AS location_key, city, state, country, round(c, 4) AS confidence FROM (SELECT *, length(location_raw) / 30.0::DOUBLE AS c FROM location_mapping)
    WHERE c >= 0.5 AND (location_standardized IS NOT NULL OR coalesce(cost_of_living_index > 1, false)) AND city IS NOT NULL AND country IS NOT NULL""")
def location_dimension_gated(spark: SparkSession, d: str) -> DataFrame:
    """Places with a gate of confidence and review: settled rows are reviewed, dear ones approved."""
    m = table(spark, d, "location_mapping").select(
        F.col("mapping_id").alias("location_id"), "city", "state", "country", (F.length("location_raw") / 30).alias("confidence"),
        F.col("location_standardized").isNull().alias("needs_review"), (F.col("cost_of_living_index") > 1).alias("approved"),
    )
    return rounded(star.location_dimension(m))


# Serving

_SKILLS = f"(SELECT job_uid AS posting_id, skill, CASE WHEN length(skill) % 2 = 0 THEN 'technical' ELSE 'soft' END AS kind, split_part(skill, ' ', 1) AS category, nullif(split_part(skill, ' ', 2), '') AS subcategory FROM (SELECT job_uid, unnest(technical_skills) AS skill FROM {_LAST}) WHERE skill IS NOT NULL)"
_LISTS = ", ".join(f"string_agg(DISTINCT {e}, ', ' ORDER BY {e}) AS {n}" for e, n in (("skill", "skills"), ("CASE WHEN kind = 'technical' THEN skill END", "technical_skills"), ("CASE WHEN kind = 'soft' THEN skill END", "soft_skills"), ("category", "skill_categories"), ("subcategory", "skill_subcategories")))
_SERVED = f"""(SELECT j.job_uid AS posting_id, j.platform, company_name, min_years_experience AS years, quality, job_title_clean, skills, technical_skills, soft_skills, skill_categories, skill_subcategories, keywords, is_active FROM {_JOBS} j JOIN {_COMPANIES} c ON c.company_id = j.company_id
    JOIN (SELECT job_uid, min_years_experience FROM {_LAST} WHERE min_years_experience IS NOT NULL) x ON x.job_uid = j.job_uid LEFT JOIN (VALUES ('icims', 1), ('workday', 2)) p(platform, quality) ON p.platform = j.platform
    LEFT JOIN (SELECT posting_id, {_LISTS} FROM {_SKILLS} GROUP BY 1) s ON s.posting_id = j.job_uid
    LEFT JOIN (SELECT job_uid, string_agg(DISTINCT keyword_text_clean, ', ' ORDER BY keyword_text_clean) AS keywords FROM job_keywords_bridge b JOIN keywords_normalized n ON n.keyword_id = b.keyword_id WHERE keyword_text_clean <> '' GROUP BY 1) k ON k.job_uid = j.job_uid)"""


def _served(spark: SparkSession, d: str) -> DataFrame:
    facts = _jobs(spark, d).withColumnRenamed("job_uid", "posting_id").select("posting_id", "company_id", "platform", "job_title_clean", "is_active")
    described = _last(spark, d).filter("min_years_experience is not null").select(F.col("job_uid").alias("posting_id"), F.col("min_years_experience").alias("years"))
    boards = spark.createDataFrame([("icims", 1), ("workday", 2)], "platform string, quality int")
    s = _last(spark, d).select(F.col("job_uid").alias("posting_id"), F.explode("technical_skills").alias("skill")).filter("skill is not null")
    part = lambda n: F.nullif(F.split_part("skill", F.lit(" "), F.lit(n)), F.lit(""))
    s = s.withColumns({"kind": F.when(F.length("skill") % 2 == 0, "technical").otherwise("soft"), "category": part(1), "subcategory": part(2)})
    words = table(spark, d, "keywords_normalized").select("keyword_id", F.col("keyword_text_clean").alias("keyword")).filter("keyword <> ''").distinct()
    k = table(spark, d, "job_keywords_bridge").select(F.col("job_uid").alias("posting_id"), "keyword_id").join(words, "keyword_id")
    out = star.serving_postings(facts, _companies(spark, d).select("company_id", "company_name"), described, boards, s, k)
    return out.select("posting_id", "platform", "company_name", "years", "quality", *star.WATCHED)


@query(f"SELECT * FROM {_SERVED}")
def serving_postings(spark: SparkSession, d: str) -> DataFrame:
    return _served(spark, d)


@query(f"""SELECT s.* REPLACE (CASE WHEN old AND skills IS NOT DISTINCT FROM (CASE WHEN years % 2 = 0 THEN 'old' ELSE skills END) THEN 'Was ' || company_name ELSE company_name END AS company_name) FROM (SELECT *, years % 3 <> 0 AS old FROM {_SERVED}) s""".replace("s.* REPLACE", "s.* EXCLUDE (old) REPLACE"))
def serving_postings_refresh(spark: SparkSession, d: str) -> DataFrame:
    """After a second run: rows of which a watched column changed are new (skills, here), others keep the company's name that they had; vanished postings are pruned."""
    new = _served(spark, d)
    before = new.filter("years % 3 <> 0").withColumns({"company_name": F.concat(F.lit("Was "), "company_name"), "skills": F.when(F.col("years") % 2 == 0, "old").otherwise(F.col("skills"))})
    gone = before.withColumn("posting_id", F.concat(F.lit("gone "), "posting_id"))
    return star.refresh_serving(before.unionByName(gone), new)


@query("SELECT lower(trim(keyword_text_clean)) AS keyword, min(keyword_type) AS keyword_type FROM keywords_normalized WHERE keyword_text_clean IS NOT NULL AND frequency_count >= 5 GROUP BY 1")
def denorm_keywords_refresh(spark: SparkSession, d: str) -> DataFrame:
    k = table(spark, d, "keywords_normalized").filter("keyword_text_clean is not null")
    made = lambda df: df.groupBy(F.lower(F.trim("keyword_text_clean")).alias("keyword")).agg(F.min("keyword_type").alias("keyword_type"))
    return dim.refresh_denorm(made(k.filter("frequency_count < 50")), made(k.filter("frequency_count >= 5")), ["keyword"], ["keyword_type"])


@query("SELECT keyword_text_clean AS skill, max(frequency_count) AS n FROM keywords_normalized WHERE keyword_text_clean IS NOT NULL AND confidence_score > 0.4 GROUP BY 1 HAVING max(frequency_count) > 0")
def skill_counts_refresh(spark: SparkSession, d: str) -> DataFrame:
    k = table(spark, d, "keywords_normalized").filter("keyword_text_clean is not null")
    made = lambda df: df.groupBy(F.col("keyword_text_clean").alias("skill")).agg(F.max("frequency_count").alias("n")).filter("n > 0")
    return dim.refresh_denorm(made(k.filter("confidence_score < 0.8")), made(k.filter("confidence_score > 0.4")), ["skill"], ["n"])
