"""Queries of the normalisers over enriched postings, places and companies."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyforge.functions import companies, ids, text
from tallyforge.operators import normalize
from tallyforge.operators.dml import latest_per_key
from tallyforge.plans.mart import rounded
from tallyforge.plans.registry import registry
from tallyforge.sources.tables import table

QUERIES, ORACLE, query = registry()
LISTS = {"technical_skills": "technical"}


def _taxonomy(spark: SparkSession, d: str) -> DataFrame:
    """Skills by name: the families of postings stand for categories; one in four entries is stale."""
    j = table(spark, d, "jobs_llm_enriched").select(F.explode("technical_skills").alias("name"), "job_family").filter("job_family is not null")
    t = j.groupBy(F.lower(F.trim("name")).alias("name")).agg(F.min("job_family").alias("category"))
    return t.filter(F.length("name") % 3 != 0).withColumn("latest", F.length("name") % 4 != 0)


_TAXONOMY = """(SELECT *, length(name) % 4 <> 0 AS latest FROM (SELECT lower(trim(name)) AS name, min(job_family) AS category FROM (SELECT unnest(technical_skills) AS name, job_family FROM jobs_llm_enriched WHERE job_family IS NOT NULL)
    GROUP BY 1) WHERE length(name) % 3 <> 0)"""
_RAW = """(SELECT DISTINCT job_uid, lower(trim(v)) AS raw, 'technical' AS source FROM (SELECT job_uid, unnest(technical_skills) AS v FROM jobs_llm_enriched) WHERE lower(trim(v)) NOT IN ('null', 'none', 'n/a', '') AND length(trim(v)) > 1)"""
_SKILLS = f"""(SELECT job_uid, r.raw, source, category, CASE WHEN latest THEN 1.0 ELSE 0.5 END::DOUBLE AS match_confidence FROM {_RAW} r LEFT JOIN {_TAXONOMY} t ON t.name = r.raw WHERE latest IS NULL OR latest)"""


@query(f"SELECT * FROM {_SKILLS}")
def skills_raw_extraction(spark: SparkSession, d: str) -> DataFrame:
    return normalize.skills_extraction(table(spark, d, "jobs_llm_enriched"), "job_uid", LISTS, _taxonomy(spark, d))


@query(f"SELECT raw, count(DISTINCT job_uid) AS frequency FROM {_RAW} WHERE raw NOT IN (SELECT name FROM {_TAXONOMY}) GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 100")
def orphan_skills(spark: SparkSession, d: str) -> DataFrame:
    raw = normalize.extracted(table(spark, d, "jobs_llm_enriched"), "job_uid", LISTS).distinct()
    return normalize.first_orphans(raw, "job_uid", _taxonomy(spark, d), 100)


MANUAL = [("sensor networks", "hardware", 0.4), ("lab samples", "clinical", 0.9), ("claims forms", "insurance", 0.3)]
_MANUAL = "(VALUES " + ", ".join(f"('{a}', '{b}', {c}::DOUBLE)" for a, b, c in MANUAL) + ") AS m(raw, manual_category, manual_confidence)"


def _hash(prefix: str, *parts: str) -> str:
    """SQL of a surrogate id."""
    joined = " || '|' || ".join(f"coalesce(CAST({p} AS VARCHAR), '~')" for p in parts)
    return f"'{prefix}' || substr(sha256({joined}), 1, 12)"


_MASTER = f"""(SELECT {_hash('SK_', 'raw', 'category')} AS skill_id, raw AS skill, category, frequency, sources, confidence, confidence < 0.5 AS needs_review FROM (
    SELECT raw, coalesce(category, manual_category, 'Unknown') AS category, count(DISTINCT job_uid) AS frequency, list_sort(list(DISTINCT source)) AS sources, avg(coalesce(manual_confidence, match_confidence)) AS confidence
    FROM {_SKILLS} LEFT JOIN {_MANUAL} USING (raw) GROUP BY 1, 2))"""


def _skills(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    raw = skills_raw_extraction(spark, d)
    return raw, normalize.skills_master(raw, "job_uid", spark.createDataFrame(MANUAL, "raw string, manual_category string, manual_confidence double"))


@query(f"SELECT skill_id, skill, category, frequency, sources, round(confidence, 4) AS confidence, needs_review FROM {_MASTER}")
def skills_normalized(spark: SparkSession, d: str) -> DataFrame:
    return rounded(_skills(spark, d)[1])


@query(f"""SELECT DISTINCT job_uid, skill_id, 'required' AS context, round((x.c + m.confidence) / 2, 4) AS overall FROM {_SKILLS} s JOIN {_MASTER} m ON m.skill = s.raw
    JOIN (SELECT job_uid, max(llm_overall_confidence) AS c FROM jobs_llm_enriched GROUP BY 1) x USING (job_uid)""")
def job_skills_bridge(spark: SparkSession, d: str) -> DataFrame:
    raw, master = _skills(spark, d)
    conf = table(spark, d, "jobs_llm_enriched").groupBy("job_uid").agg(F.max("llm_overall_confidence").alias("extraction_confidence"))
    return rounded(normalize.skills_bridge(raw, "job_uid", master, conf)).distinct()


RULES = [("payroll runs", "payroll", "domain", "Finance", 0.9), ("network switches", "networking", "technical", "IT", 0.8), ("design reviews", "ai design", "technical", "Design", 0.6)]
TYPES = [("quality gates", "domain", "Quality", 0.7), ("stock counts", "domain", "Logistics", 0.4), ("payroll", "industry", "Finance", 0.9)]
_RULES = "(VALUES " + ", ".join(f"('{a}', '{b}', '{c}', '{e}', {f}::DOUBLE)" for a, b, c, e, f in RULES) + ") AS r(pattern, standard, rule_type, rule_category, rule_confidence)"
_TYPES = "(VALUES " + ", ".join(f"('{a}', '{b}', '{c}', {e}::DOUBLE)" for a, b, c, e in TYPES) + ") AS t(keyword, type, type_category, type_confidence)"
_KEYWORDS = f"""(SELECT {_hash('KW_', 'keyword', 'category', 'type')} AS keyword_id, *, CASE WHEN frequency >= 100 THEN 1.0 WHEN frequency >= 50 THEN 0.7 WHEN frequency >= 10 THEN 0.5 ELSE 0.3 END::DOUBLE AS trend, confidence >= 0.5 AS approved FROM (
    SELECT k.keyword, CASE WHEN k.keyword ILIKE 'ai %' OR k.keyword ILIKE '% ai' OR k.keyword ILIKE 'ai-%' THEN 'AI' ELSE coalesce(rule_category, type_category, 'General') END AS category, coalesce(rule_type, t.type, source) AS type,
      count(DISTINCT job_uid) AS frequency, avg(coalesce(rule_confidence, type_confidence, 0.5)) AS confidence
    FROM (SELECT *, coalesce(standard, raw) AS keyword FROM {_RAW} LEFT JOIN {_RULES} ON pattern = raw) k LEFT JOIN {_TYPES} ON t.keyword = k.keyword GROUP BY 1, 2, 3))"""


def _keywords(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    raw = normalize.extracted(table(spark, d, "jobs_llm_enriched"), "job_uid", LISTS).distinct()
    rules = spark.createDataFrame(RULES, "pattern string, standard string, rule_type string, rule_category string, rule_confidence double")
    types = spark.createDataFrame(TYPES, "keyword string, type string, type_category string, type_confidence double")
    return raw, rules, normalize.keywords_master(raw, "job_uid", rules, types)


@query(f"SELECT keyword_id, keyword, category, type, frequency, round(confidence, 4) AS confidence, round(trend, 4) AS trend, approved FROM {_KEYWORDS}")
def keywords_normalized_master(spark: SparkSession, d: str) -> DataFrame:
    return rounded(_keywords(spark, d)[2])


@query(f"""SELECT DISTINCT job_uid, keyword_id, 'rule' AS how FROM {_RAW} JOIN {_RULES} ON pattern = raw JOIN {_KEYWORDS} k ON k.keyword = standard
    UNION SELECT job_uid, keyword_id, 'name' FROM {_RAW} x JOIN {_KEYWORDS} k ON k.keyword = raw WHERE raw NOT IN (SELECT pattern FROM {_RULES})""")
def job_keywords_bridge_built(spark: SparkSession, d: str) -> DataFrame:
    raw, rules, master = _keywords(spark, d)
    return normalize.keywords_bridge(raw, "job_uid", rules, master)


def _places(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    raw = table(spark, d, "location_mapping").select("mapping_id", F.col("location_raw").alias("place")).filter("place is not null")
    ref = table(spark, d, "ref_locations")
    states = ref.filter("state is not null").select(F.col("state_code").alias("code"), "state").distinct()
    return raw, normalize.places_master(raw, "mapping_id", states, ref.select("country").filter("country is not null").distinct())


_PLACES = """(SELECT strip_accents(lower(trim(place, ' '))) AS folded, city, state, c.country AS country, CASE WHEN contains(strip_accents(lower(trim(place, ' '))), 'remote') THEN 'remote' WHEN contains(strip_accents(lower(trim(place, ' '))), 'hybrid') THEN 'hybrid' ELSE 'office' END AS kind, place, mapping_id
    FROM (SELECT p.*, coalesce(a.state, b.state) AS state, lower(CASE WHEN coalesce(a.state, b.state) IS NULL THEN coalesce(third, second) ELSE third END) AS gate FROM (
      SELECT mapping_id, location_raw AS place, nullif(trim(split_part(location_raw, ',', 1), ' '), '') AS city, nullif(trim(split_part(location_raw, ',', 2), ' '), '') AS second, nullif(trim(split_part(location_raw, ',', 3), ' '), '') AS third FROM location_mapping WHERE location_raw IS NOT NULL) p
      LEFT JOIN (SELECT DISTINCT lower(state_code) AS k, state FROM ref_locations WHERE state IS NOT NULL) a ON a.k = lower(second)
      LEFT JOIN (SELECT DISTINCT lower(state) AS k, state FROM ref_locations WHERE state IS NOT NULL) b ON b.k = lower(second)) x
    LEFT JOIN (SELECT DISTINCT country FROM ref_locations WHERE country IS NOT NULL) c ON lower(c.country) = gate)"""


@query(f"""SELECT {_hash('LOC_', 'folded')} AS location_id, folded, city, state, country, kind, frequency, variant, round(c, 4) AS confidence, c < 0.5 OR frequency = 1 AS needs_review FROM (
    SELECT folded, city, state, country, kind, count(DISTINCT mapping_id) AS frequency, min(place) AS variant, CASE WHEN state IS NOT NULL AND country IS NOT NULL THEN 0.95 WHEN state IS NOT NULL OR country IS NOT NULL THEN 0.8 ELSE 0.4 END::DOUBLE AS c FROM {_PLACES} GROUP BY ALL)""")
def locations_normalized(spark: SparkSession, d: str) -> DataFrame:
    return rounded(_places(spark, d)[1])


@query(f"""SELECT DISTINCT p.mapping_id AS left_id, m.location_id AS right_id FROM (SELECT DISTINCT mapping_id, folded, place FROM {_PLACES}) p
    JOIN (SELECT {_hash('LOC_', 'folded')} AS location_id, folded, min(place) AS variant FROM {_PLACES} GROUP BY folded, city, state, country, kind) m ON m.folded = p.folded OR m.variant = p.place""")
def job_locations_bridge(spark: SparkSession, d: str) -> DataFrame:
    raw, master = _places(spark, d)
    return normalize.places_bridge(raw.withColumnRenamed("mapping_id", "left_id"), master)


_USD = "lower(trim(salary_currency)) IN ('usd', 'us$', '$', 'us dollar', 'us dollars') AND (salary_min IS NOT NULL OR salary_max IS NOT NULL) AND NOT coalesce(salary_min = salary_max, false)"
_PAY = f"(SELECT job_uid, salary_min, salary_max, lower(trim(salary_period)) AS period, CASE WHEN salary_min IS NOT NULL AND salary_max IS NOT NULL THEN 'both' WHEN salary_min IS NOT NULL THEN 'min_only' ELSE 'max_only' END AS completeness FROM jobs_llm_enriched WHERE {_USD})"
_FACTOR = "CASE WHEN period IN ('hour', 'hourly') THEN 2080 WHEN period IN ('week', 'weekly') THEN 52 WHEN period IN ('month', 'monthly') THEN 12 WHEN period IN ('year', 'yearly', 'annual', 'annually') THEN 1 END"
_RANGES = f"""(SELECT {_hash('SAL_', 'salary_min', 'salary_max', 'period')} AS salary_id, *, (lo + hi) / 2 AS midpoint, outlier OR confidence < 0.8 AS needs_review, '$' || CAST(floor(lo / 1000) AS BIGINT) || 'K-$' || CAST(floor(hi / 1000) AS BIGINT) || 'K Annual USD' AS name,
    percent_rank() OVER (ORDER BY (lo + hi) / 2) * 100 AS percentile FROM (
    SELECT *, CASE WHEN outlier THEN 0.5 ELSE 1.0 END::DOUBLE * CASE factor WHEN 1 THEN 1.0 WHEN 2080 THEN 0.9 WHEN 12 THEN 0.9 WHEN 52 THEN 0.7 ELSE 0.5 END::DOUBLE AS confidence FROM (
    SELECT *, hi > 2000000 OR lo < 15000 OR coalesce(hi / nullif(lo, 0) > 3, false) AS outlier FROM (
    SELECT *, coalesce(salary_min, salary_max) * coalesce(factor, 1) AS lo, coalesce(salary_max, salary_min) * coalesce(factor, 1) AS hi FROM (
    SELECT salary_min, salary_max, period, {_FACTOR} AS factor, count(DISTINCT job_uid) AS frequency FROM {_PAY} GROUP BY ALL)))))"""


@query(f"SELECT salary_id, salary_min, salary_max, period, lo, hi, round(midpoint, 4) AS midpoint, frequency, outlier, round(confidence, 4) AS confidence, needs_review, name, round(percentile, 4) AS percentile FROM {_RANGES}")
def salary_normalized_master(spark: SparkSession, d: str) -> DataFrame:
    return rounded(normalize.salary_master(normalize.salary_extraction(table(spark, d, "jobs_llm_enriched"))))


def _salary_bridge_sql(op: str) -> str:
    return f"""SELECT DISTINCT r.job_uid, m.salary_id, round(m.confidence * CASE WHEN completeness = 'both' THEN 1.0 ELSE 0.8 END::DOUBLE, 4) AS overall, CASE WHEN m.needs_review THEN 'needs_review' WHEN m.confidence >= 0.9 THEN 'validated' ELSE 'pending' END AS status
        FROM {_PAY} r JOIN {_RANGES} m ON r.salary_min {op} m.salary_min AND r.salary_max {op} m.salary_max AND r.period IS NOT DISTINCT FROM m.period"""


def _salary_bridge(spark: SparkSession, d: str, legacy: bool) -> DataFrame:
    raw = normalize.salary_extraction(table(spark, d, "jobs_llm_enriched"))
    return rounded(normalize.salary_bridge(raw, normalize.salary_master(raw), legacy))


@query(_salary_bridge_sql("IS NOT DISTINCT FROM"))
def salary_bridge_status(spark: SparkSession, d: str) -> DataFrame:
    return _salary_bridge(spark, d, False)


@query(_salary_bridge_sql("="))
def salary_bridge_status_legacy(spark: SparkSession, d: str) -> DataFrame:
    return _salary_bridge(spark, d, True)


YEARS = [("EXP_0_2", 0.0, 2.0), ("EXP_1_3", 1.0, 3.0), ("EXP_3_5", 3.0, 5.0), ("EXP_5_8", 5.0, 8.0), ("EXP_7_12", 7.0, 12.0), ("EXP_10", 10.0, None)]


@query("SELECT rule_id, low, high, count(DISTINCT job_uid) AS market_frequency FROM (VALUES " + ", ".join(f"('{a}', {b}::DOUBLE, {'NULL' if c is None else c}::DOUBLE)" for a, b, c in YEARS) + """) r(rule_id, low, high)
    LEFT JOIN (SELECT DISTINCT job_uid, min_years_experience AS y FROM jobs_llm_enriched WHERE min_years_experience IS NOT NULL) ON y >= low AND y <= coalesce(high, 1e9) GROUP BY ALL""")
def experience_normalized(spark: SparkSession, d: str) -> DataFrame:
    """Note: a posting processed again with other years counts per distinct value."""
    rules = spark.createDataFrame(YEARS, "rule_id string, low double, high double")
    return normalize.experience_master(table(spark, d, "jobs_llm_enriched"), "job_uid", rules)


@query(f"""SELECT company_profile_id, name, industry, size_class FROM (
    SELECT substr(sha256(regexp_replace(trim(lower(company_name)), '\\s+', ' ', 'g') || '|company_profiles'), 1, 12) AS company_profile_id, {text.company_name_sql('company_name')} AS name, {companies.industry_sql('company_industry')} AS industry,
      CASE WHEN n IS NULL THEN 'Unknown' WHEN n <= 50 THEN 'Startup' WHEN n <= 500 THEN 'Small' WHEN n <= 5000 THEN 'Medium' ELSE 'Large' END AS size_class,
      row_number() OVER (PARTITION BY regexp_replace(trim(lower(company_name)), '\\s+', ' ', 'g') ORDER BY CASE WHEN employee_count_range <> '' THEN 10 ELSE 0 END + CASE WHEN city <> '' THEN 5 ELSE 0 END + CASE WHEN company_industry <> '' THEN 3 ELSE 0 END DESC, ingested_at DESC NULLS LAST, profile_id) AS rn
    FROM (SELECT *, TRY_CAST(nullif(regexp_extract(employee_count_range, '([0-9]+)', 1), '') AS BIGINT) AS n FROM company_profiles WHERE company_name IS NOT NULL AND company_name <> '')) WHERE rn = 1""")
def company_profiles_stage(spark: SparkSession, d: str) -> DataFrame:
    """Cleaned profiles, one per name, the most complete first."""
    p = table(spark, d, "company_profiles").filter("company_name is not null and company_name <> ''")
    filled = lambda c, n: F.when(F.col(c) != "", n).otherwise(0)
    p = p.withColumns({"one": F.regexp_replace(F.trim(F.lower("company_name")), r"\s+", " "), "score": filled("employee_count_range", 10) + filled("city", 5) + filled("company_industry", 3)})
    best = latest_per_key(p, ["one"], [F.desc("score"), F.desc_nulls_last("ingested_at"), F.asc("profile_id")])
    return best.select(
        ids.company_platform_id(F.col("company_name"), F.lit("COMPANY_PROFILES")).alias("company_profile_id"), text.company_name(F.col("company_name")).alias("name"),
        companies.industry(F.col("company_industry")).alias("industry"), companies.size_class(F.col("employee_count_range")).alias("size_class"),
    )


@query("""SELECT company_id, platform, record_id, CASE WHEN names > 1 THEN 'variation' ELSE 'same' END AS duplicate_kind FROM (
    SELECT c.*, n.names, row_number() OVER (PARTITION BY c.company_id, c.platform ORDER BY coalesce(url_verified, false) DESC, (ats_url IS NOT NULL) DESC, last_updated DESC NULLS LAST, record_id DESC) AS rn
    FROM companies c JOIN (SELECT company_id, platform, count(DISTINCT lower(trim(company_name))) AS names FROM companies GROUP BY ALL) n ON n.company_id = c.company_id AND n.platform IS NOT DISTINCT FROM c.platform) WHERE rn = 1""")
def master_company_urls(spark: SparkSession, d: str) -> DataFrame:
    """The best address record of each company and platform."""
    order = [F.desc(F.coalesce("url_verified", F.lit(False))), F.desc(F.col("ats_url").isNotNull()), F.desc_nulls_last("last_updated"), F.desc("record_id")]
    return normalize.best_urls(table(spark, d, "companies"), order).select("company_id", "platform", "record_id", "duplicate_kind")


PLACE_RULES = [("new york", "New York"), ("falls", "Falls Region"), ("remote", "Remote"), ("north carolina", "North Carolina")]
_PLACE_RULES = "(VALUES " + ", ".join(f"('{a}', '{b}')" for a, b in PLACE_RULES) + ") AS r(pattern, standard)"


@query(f"""SELECT mapping_id, value, coalesce(standard, nullif(trim(value, ' '), '')) AS standard, CASE WHEN pattern IS NULL THEN 0.5 WHEN pattern = low THEN 0.8 ELSE 0.7 END::DOUBLE AS confidence, CASE WHEN pattern IS NULL THEN 'none' WHEN pattern = low THEN 'exact' ELSE 'partial' END AS how FROM (
    SELECT mapping_id, value, low, pattern, standard, row_number() OVER (PARTITION BY mapping_id ORDER BY (pattern = low) DESC NULLS LAST, length(pattern) DESC NULLS LAST, standard DESC) AS rn FROM (SELECT mapping_id, location_raw AS value, lower(trim(location_raw, ' ')) AS low FROM location_mapping)
    LEFT JOIN {_PLACE_RULES} ON contains(' ' || array_to_string(regexp_split_to_array(low, '\\s+'), ' ') || ' ', ' ' || pattern || ' ')) WHERE rn = 1""")
def rule_standardisation(spark: SparkSession, d: str) -> DataFrame:
    """Exact, partial and no rule, with their confidences."""
    rules = spark.createDataFrame(PLACE_RULES, "pattern string, standard string")
    return normalize.by_rules(table(spark, d, "location_mapping"), "mapping_id", "location_raw", rules)


ROLES = {"trainee|junior": "EXP_ENTRY", "senior|staff|lead": "EXP_SENIOR"}


@query("SELECT DISTINCT job_uid, rule_id, 'general' AS how FROM jobs_llm_enriched JOIN (VALUES " + ", ".join(f"('{a}', {b}::DOUBLE, {'NULL' if c is None else c}::DOUBLE)" for a, b, c in YEARS) + """) r(rule_id, low, high) ON min_years_experience >= low AND min_years_experience <= coalesce(high, 1e9)
    UNION SELECT job_uid, 'TECH_' || upper(unnest(technical_skills)), 'technology' FROM jobs_llm_enriched
    UNION SELECT job_uid, CASE WHEN regexp_matches(lower(seniority_level), 'trainee|junior') THEN 'EXP_ENTRY' ELSE 'EXP_SENIOR' END, 'role' FROM jobs_llm_enriched WHERE regexp_matches(lower(seniority_level), 'trainee|junior|senior|staff|lead')""")
def job_experience_bridge(spark: SparkSession, d: str) -> DataFrame:
    """Bands, technologies and levels of each posting; the skills listed stand for technologies with years."""
    j = table(spark, d, "jobs_llm_enriched")
    years = F.map_from_entries(F.transform(F.array_distinct(F.coalesce("technical_skills", F.array().cast("array<string>"))), lambda x: F.struct(x, F.lit(1.0))))
    rules = spark.createDataFrame(YEARS, "rule_id string, low double, high double")
    return normalize.experience_bridge(j.withColumn("technology_years", years), "job_uid", rules, ROLES)
