"""Queries of extractions, places, experience, taxonomy, report views and quality metrics that run over enriched postings."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyforge.functions import companies
from tallyforge.operators import dml, normalize, quality
from tallyforge.plans.mart import exact_avg, rounded
from tallyforge.plans.registry import registry
from tallyforge.session import scratch
from tallyforge.sources.tables import table

QUERIES, ORACLE, query = registry()


def _jobs(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "jobs_llm_enriched")


# Extractions


@query("""SELECT DISTINCT job_uid, lower(trim(v)) AS raw, source FROM (SELECT job_uid, unnest(technical_skills) AS v, 'primary_keywords' AS source FROM jobs_llm_enriched UNION ALL SELECT job_uid, work_type, 'role_type' FROM jobs_llm_enriched)
    WHERE lower(trim(v)) NOT IN ('null', 'none', 'n/a', '') AND length(trim(v)) > 1""")
def keywords_raw_extraction(spark: SparkSession, d: str) -> DataFrame:
    return normalize.extracted(_jobs(spark, d), "job_uid", {"technical_skills": "primary_keywords"}, {"work_type": "role_type"}).distinct()


_RAW_PLACES = """(SELECT DISTINCT mapping_id AS job_uid, lower(trim(v, ' ')) AS raw, source FROM (SELECT mapping_id, unnest(string_split(location_raw, '/')) AS v, 'office_locations' AS source FROM location_mapping UNION ALL SELECT mapping_id, location_standardized, 'location_standardized' FROM location_mapping)
    WHERE lower(trim(v, ' ')) NOT IN ('null', 'none', 'n/a', '') AND length(trim(v, ' ')) > 1)"""


def _raw_places(spark: SparkSession, d: str) -> DataFrame:
    m = table(spark, d, "location_mapping").select(F.col("mapping_id").alias("job_uid"), F.split("location_raw", "/").alias("offices"), "location_standardized")
    return normalize.extracted(m, "job_uid", {"offices": "office_locations"}, {"location_standardized": "location_standardized"}).distinct()


@query(f"SELECT * FROM {_RAW_PLACES}")
def locations_raw_extraction(spark: SparkSession, d: str) -> DataFrame:
    return _raw_places(spark, d)


_SAID = "trim({0}, ' ') <> '' AND lower(trim({0}, ' ')) NOT IN ('null', 'none', 'n/a', 'unknown')"
_TECH = "SELECT job_uid, c, unnest(list_distinct(technical_skills)) AS t, min_years_experience AS y FROM j"
_EXPERIENCE = f"""WITH j AS (SELECT DISTINCT job_uid, min_years_experience, max_years_experience, work_type, seniority_level, technical_skills, round(llm_overall_confidence, 4) AS c FROM jobs_llm_enriched)
    SELECT job_uid, c AS confidence, 'min_years' AS source, 'general' AS kind, CAST(min_years_experience AS VARCHAR) AS value, CAST(min_years_experience AS VARCHAR) AS original_text, CAST(NULL AS VARCHAR) AS technology FROM j WHERE min_years_experience > 0
    UNION ALL SELECT job_uid, c, 'max_years', 'general', CAST(max_years_experience AS VARCHAR), CAST(max_years_experience AS VARCHAR), NULL FROM j WHERE max_years_experience > 0
    UNION ALL SELECT job_uid, c, 'experience_level', 'role_level', work_type, work_type, NULL FROM j WHERE {_SAID.format('work_type')}
    UNION ALL SELECT job_uid, c, 'seniority_level', 'role_level', seniority_level, seniority_level, NULL FROM j WHERE {_SAID.format('seniority_level')}
    UNION ALL SELECT job_uid, c, 'specific_tech', 'technology_specific', CAST(y AS VARCHAR), t || ': ' || y || ' years', t FROM ({_TECH}) WHERE y > 0 AND t IS NOT NULL"""


def _experience(spark: SparkSession, d: str) -> DataFrame:
    """The skills listed, with the least years, stand for years per technology; the work type for a level."""
    j = _jobs(spark, d).select("job_uid", "min_years_experience", "max_years_experience", F.col("work_type").alias("experience_level"), "seniority_level", "technical_skills", F.col("llm_overall_confidence").alias("confidence"))
    j = rounded(j).distinct()
    entries = F.transform(F.filter(F.array_distinct("technical_skills"), lambda x: x.isNotNull()), lambda x: F.struct(x, F.col("min_years_experience")))
    return normalize.experience_extraction(j.withColumn("technology_years", F.map_from_entries(entries)))


@query(_EXPERIENCE)
def experience_raw_extraction(spark: SparkSession, d: str) -> DataFrame:
    """Least and most years, levels, seniority and years per technology in one list."""
    return _experience(spark, d)


@query(f"""SELECT 'EXP_TECH_' || upper(regexp_replace(technology, '[^A-Za-z0-9]', '_', 'g')) AS experience_id, technology, min(CAST(value AS BIGINT)) AS low, max(CAST(value AS BIGINT)) AS high, count(DISTINCT job_uid) AS market_frequency,
    round(avg(confidence), 4) AS confidence FROM ({_EXPERIENCE}) WHERE kind = 'technology_specific' GROUP BY ALL""")
def experience_technologies(spark: SparkSession, d: str) -> DataFrame:
    return rounded(normalize.experience_technologies(_experience(spark, d)))


@query("""SELECT job_uid, salary_min, salary_max, coalesce(lower(trim(salary_period)), 'unknown') AS period, coalesce(upper(trim(salary_currency)), 'USD') AS currency,
    CASE WHEN salary_min IS NOT NULL AND salary_max IS NOT NULL THEN 'complete_range' WHEN salary_min IS NOT NULL THEN 'min_only' ELSE 'max_only' END AS completeness,
    coalesce(salary_min > 1000000, false) OR coalesce(salary_max > 1000000, false) OR coalesce(salary_min < 1, false) OR coalesce(salary_max < 1, false) AS potential_outlier
    FROM jobs_llm_enriched WHERE (salary_min > 0 OR salary_max > 0) AND coalesce(salary_min, 0) <> coalesce(salary_max, 0)""")
def salary_raw_extraction(spark: SparkSession, d: str) -> DataFrame:
    return normalize.salary_statements(_jobs(spark, d))


# Places


def _ref(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "ref_locations").filter("city is not null")


_METROS = "(SELECT city, state, country, min(location_name) AS metro_area FROM ref_locations WHERE city IS NOT NULL AND length(city) % 2 = 0 GROUP BY ALL)"
_REGIONS = "(SELECT state, country, 'Region ' || upper(substr(min(state_code), 1, 1)) AS region FROM ref_locations WHERE state IS NOT NULL AND length(state) % 3 <> 0 GROUP BY ALL)"
_PARTS = "(SELECT mapping_id AS location_id, city, state, country, CASE WHEN contains(lower(coalesce(location_raw, '')), 'remote') THEN 'remote' WHEN contains(lower(coalesce(location_raw, '')), 'hybrid') THEN 'hybrid' ELSE 'office' END AS kind FROM location_mapping)"


@query(f"""SELECT location_id, p.city, p.state, p.country, kind, coalesce(metro_area, 'Other') AS metro_area, coalesce(region, 'Other') AS region, h.city IS NOT NULL AS is_hub, kind IN ('remote', 'hybrid') AS is_remote_friendly FROM {_PARTS} p
    LEFT JOIN {_METROS} m ON m.city = p.city AND m.state = p.state AND m.country = p.country LEFT JOIN {_REGIONS} r ON r.state = p.state AND r.country = p.country
    LEFT JOIN (SELECT DISTINCT city, state, country FROM ref_locations WHERE length(city) > 10) h ON h.city = p.city AND h.state = p.state AND h.country = p.country""")
def places_located(spark: SparkSession, d: str) -> DataFrame:
    """Metro area, region and hub of each place, by lookups that don't know all of them."""
    ref = _ref(spark, d)
    metros = ref.filter("length(city) % 2 = 0").groupBy("city", "state", "country").agg(F.min("location_name").alias("metro_area"))
    regions = ref.filter("state is not null and length(state) % 3 <> 0").groupBy("state", "country").agg(F.concat(F.lit("Region "), F.upper(F.substring(F.min("state_code"), 1, 1))).alias("region"))
    hubs = ref.filter("length(city) > 10").select("city", "state", "country").distinct().withColumn("is_hub", F.lit(True))
    low = F.lower(F.coalesce("location_raw", F.lit("")))
    kind = F.when(F.contains(low, F.lit("remote")), "remote").when(F.contains(low, F.lit("hybrid")), "hybrid").otherwise("office")
    return normalize.places_located(table(spark, d, "location_mapping").select(F.col("mapping_id").alias("location_id"), "city", "state", "country", kind.alias("kind")), metros, regions, hubs)


_MASTER = """(SELECT location_id, strip_accents(lower(coalesce(city, location_name))) AS folded, location_name AS name, city || ' ' || state_code AS variant, CASE WHEN country IS NULL THEN 'remote' ELSE 'office' END AS kind, CASE WHEN length(city) % 5 = 0 THEN 0.4 ELSE 0.8 END::DOUBLE AS confidence, coalesce(length(city) = 8, false) AS needs_review FROM ref_locations)"""
_WORK = "(SELECT mapping_id AS job_uid, CASE mapping_id % 4 WHEN 0 THEN 'On-site' WHEN 1 THEN 'Hybrid' WHEN 2 THEN 'Flexible' END AS work_type FROM location_mapping)"


@query(f"""SELECT DISTINCT r.job_uid, location_id, source, raw AS original, CASE source WHEN 'office_locations' THEN 'primary' WHEN 'location_standardized' THEN 'standard' ELSE 'unknown' END AS location_context,
    CASE work_type WHEN 'On-site' THEN 'on_site' WHEN 'Hybrid' THEN 'hybrid' WHEN 'Flexible' THEN 'flexible' ELSE CASE WHEN kind = 'remote' THEN 'remote' ELSE 'on_site' END END AS work_arrangement,
    round((0.9::DOUBLE + confidence) / 2, 4) AS overall, confidence < 0.5 OR needs_review AS needs_review
    FROM {_RAW_PLACES} r JOIN {_MASTER} m ON strip_accents(raw) = folded OR lower(raw) = lower(variant) OR lower(raw) = lower(name) LEFT JOIN {_WORK} w ON w.job_uid = r.job_uid""")
def job_locations_bridge_by_names(spark: SparkSession, d: str) -> DataFrame:
    """Four alternatives of equality as one hash join, with context and work arrangement."""
    from tallyforge.functions.fold import fold

    raw = _raw_places(spark, d).withColumn("original", F.col("raw"))
    conf = F.when(F.length("city") % 5 == 0, 0.4).otherwise(0.8)
    master = table(spark, d, "ref_locations").select(
        "location_id", fold(F.coalesce("city", "location_name")).alias("folded"), F.col("location_name").alias("name"), F.concat("city", F.lit(" "), "state_code").alias("variant"),
        F.when(F.col("country").isNull(), "remote").otherwise("office").alias("kind"), conf.alias("confidence"), F.coalesce(F.length("city") == 8, F.lit(False)).alias("needs_review"),
    )
    k = F.col("mapping_id") % 4
    work = table(spark, d, "location_mapping").select(F.col("mapping_id").alias("job_uid"), F.when(k == 0, "On-site").when(k == 1, "Hybrid").when(k == 2, "Flexible").alias("work_type"))
    return rounded(normalize.places_bridge_by_names(raw, master, work))


@query("""SELECT DISTINCT * FROM (SELECT upper(state_code) AS location_name, 'US_STATE' AS location_type, state, country FROM ref_locations WHERE country = 'United States' UNION ALL SELECT upper(state), 'US_STATE', state, country FROM ref_locations WHERE country = 'United States'
    UNION ALL SELECT upper(country), 'COUNTRY', NULL, country FROM ref_locations UNION ALL SELECT upper(country_code), 'COUNTRY', NULL, country FROM ref_locations) WHERE location_name IS NOT NULL""")
def location_parsing_lookup(spark: SparkSession, d: str) -> DataFrame:
    ref = table(spark, d, "ref_locations")
    return normalize.parsing_lookup(ref.filter("country = 'United States'").select(F.col("state_code").alias("code"), "state", "country"), ref.select("country", "country_code"))


# Taxonomy and companies


@query("""SELECT skill, category, confidence FROM (VALUES ('lab samples', 'clinical', 0.9::DOUBLE), ('claims forms', 'insurance', 0.7::DOUBLE)) k(skill, category, confidence)
    UNION ALL SELECT DISTINCT s, 'mapped ' || length(s), 0.5::DOUBLE FROM (SELECT lower(trim(unnest(technical_skills))) AS s FROM jobs_llm_enriched) WHERE s NOT IN ('null', 'none', 'n/a', '', 'lab samples', 'claims forms') AND length(s) > 1""")
def manual_skill_taxonomy(spark: SparkSession, d: str) -> DataFrame:
    """Skills without an entry, mapped by answers in batches, and put into the taxonomy; what is known, or was not asked for, isn't."""
    raw = normalize.extracted(_jobs(spark, d), "job_uid", {"technical_skills": "technical"}).select("raw").distinct()
    known = spark.createDataFrame([("lab samples", "clinical", 0.9), ("claims forms", "insurance", 0.7)], "skill string, category string, confidence double")
    one = F.struct(F.upper("raw").alias("skill"), F.concat(F.lit("mapped "), F.length("raw").cast("string")).alias("category"), F.lit(0.5).alias("confidence"))
    worse = F.struct(F.col("raw").alias("skill"), F.lit("another").alias("category"), F.lit(0.1).alias("confidence"))
    other = F.struct(F.lit("never asked").alias("skill"), F.lit("x").alias("category"), F.lit(1.0).alias("confidence"))
    batches = raw.groupBy(F.pmod(F.xxhash64("raw"), F.lit(20)).alias("batch")).agg(F.flatten(F.collect_list(F.array(one, worse, other))).alias("rows"))
    return normalize.skill_mappings(raw, batches.select(F.to_json("rows").alias("answer")), known)


@query("""SELECT company_id, record_id, n, kind AS duplicate_kind FROM (SELECT *, row_number() OVER (PARTITION BY company_id ORDER BY coalesce(url_verified, false) DESC, last_updated DESC NULLS LAST, ingested_at DESC NULLS LAST, record_id DESC) AS rn FROM companies WHERE company_id IS NOT NULL) JOIN (
    SELECT company_id, count(*) AS n, CASE WHEN count(*) = 1 THEN 'single' WHEN count(DISTINCT coalesce(company_name, '') || '|' || coalesce(platform, '')) = 1 THEN 'legitimate' WHEN count(DISTINCT trim(upper(coalesce(company_name, '')), ' ') || '|' || trim(upper(coalesce(platform, '')), ' ')) = 1 THEN 'variation' ELSE 'collision' END AS kind
    FROM companies GROUP BY 1) USING (company_id) WHERE rn = 1""")
def company_duplicates(spark: SparkSession, d: str) -> DataFrame:
    order = [F.desc(F.coalesce("url_verified", F.lit(False))), F.desc_nulls_last("last_updated"), F.desc_nulls_last("ingested_at"), F.desc("record_id")]
    return normalize.duplicate_companies(table(spark, d, "companies").filter("company_id is not null"), order).select("company_id", "record_id", "n", "duplicate_kind")


@query("SELECT keyword_category, max(CASE WHEN trend_score > 0.66 THEN 'high' WHEN trend_score > 0.33 THEN 'medium' ELSE 'low' END) AS relevance FROM keywords_normalized GROUP BY 1")
def greatest_relevance(spark: SparkSession, d: str) -> DataFrame:
    """The greatest of relevances as texts, by code point: 'medium' comes before 'low' and 'high' last."""
    said = F.when(F.col("trend_score") > 0.66, "high").when(F.col("trend_score") > 0.33, "medium").otherwise("low")
    return table(spark, d, "keywords_normalized").groupBy("keyword_category").agg(F.max(said).alias("relevance"))


# Sorting


_SEVERE = "CASE WHEN overall_confidence < 0.3 THEN 'HIGH' WHEN overall_confidence < 0.5 THEN 'MEDIUM' ELSE 'LOW' END"


@query(f"""SELECT bridge_id, severity, CAST(place AS INT) AS place FROM (SELECT *, row_number() OVER (ORDER BY CASE severity WHEN 'HIGH' THEN 1 WHEN 'MEDIUM' THEN 2 ELSE 3 END, overall_confidence, bridge_id) AS place FROM (
    SELECT DISTINCT bridge_id, overall_confidence, {_SEVERE} AS severity FROM job_salary_bridge WHERE needs_review)) WHERE place <= 200""")
def review_by_severity(spark: SparkSession, d: str) -> DataFrame:
    """The first 200 reviews, the severe ones first (the cap is the feature); numbered after the cut."""
    from pyspark.sql import Window

    severity = F.when(F.col("overall_confidence") < 0.3, "HIGH").when(F.col("overall_confidence") < 0.5, "MEDIUM").otherwise("LOW")
    rank = F.when(F.col("severity") == "HIGH", 1).when(F.col("severity") == "MEDIUM", 2).otherwise(3)
    order = [rank, F.asc_nulls_last("overall_confidence"), F.asc("bridge_id")]
    r = table(spark, d, "job_salary_bridge").filter("needs_review").select("bridge_id", "overall_confidence", severity.alias("severity")).distinct().orderBy(*order).limit(200)
    return r.select("bridge_id", "severity", F.row_number().over(Window.orderBy(*order)).alias("place"))


@query("SELECT source, count(*) AS n FROM (SELECT keyword_source AS source FROM (SELECT DISTINCT bridge_id, keyword_source, overall_confidence FROM job_keywords_bridge WHERE overall_confidence < 0.6) ORDER BY overall_confidence, bridge_id, keyword_source LIMIT 1000) GROUP BY 1")
def capped_review(spark: SparkSession, d: str) -> DataFrame:
    """A review that takes the 1,000 least sure rows of a bridge, in a fixed order (the cap is the feature), by source."""
    b = table(spark, d, "job_keywords_bridge").filter("overall_confidence < 0.6").select("bridge_id", "keyword_source", "overall_confidence").distinct()
    return b.orderBy("overall_confidence", "bridge_id", F.asc_nulls_last("keyword_source")).limit(1000).groupBy(F.col("keyword_source").alias("source")).agg(F.count("*").alias("n"))


@query("SELECT l_orderkey, l_linenumber, CAST(date_trunc('year', l_shipdate) AS DATE) AS year FROM lineitem WHERE l_quantity >= 49")
def clustered_insert(spark: SparkSession, d: str) -> DataFrame:
    """Rows written in order within their partitions, so that later scans can skip row groups."""
    p = scratch(spark)
    rows = table(spark, d, "lineitem").filter("l_quantity >= 49").select("l_orderkey", "l_linenumber", F.trunc("l_shipdate", "year").alias("year"))
    rows.repartition("year").sortWithinPartitions("year", "l_orderkey", "l_linenumber").write.partitionBy("year").parquet(p)
    return spark.read.parquet(p)


# Report views


@query("""SELECT keyword_text_clean AS name, n.keyword_category AS category, count(DISTINCT b.job_uid) AS frequency, list_sort(list(DISTINCT platform) FILTER (platform IS NOT NULL)) AS platforms, round(CAST(sum(CAST(b.overall_confidence AS DECIMAL(18, 4))) AS DOUBLE) / count(b.overall_confidence), 4) AS mean_confidence FROM (SELECT DISTINCT keyword_id, keyword_text_clean, keyword_category FROM keywords_normalized) n
    LEFT JOIN (SELECT job_uid, keyword_id, max(overall_confidence) AS overall_confidence FROM job_keywords_bridge WHERE NOT coalesce(isnan(overall_confidence), false) GROUP BY ALL) b USING (keyword_id) LEFT JOIN (SELECT job_uid, min(platform) AS platform FROM jobs_llm_enriched GROUP BY 1) j ON j.job_uid = b.job_uid GROUP BY ALL""")
def keywords_analysis(spark: SparkSession, d: str) -> DataFrame:
    """Each entry with how many postings use it, on which platforms and how surely."""
    n = table(spark, d, "keywords_normalized").select("keyword_id", F.col("keyword_text_clean").alias("name"), F.col("keyword_category").alias("category")).distinct()
    b = table(spark, d, "job_keywords_bridge").filter("not coalesce(isnan(overall_confidence), false)").groupBy("job_uid", "keyword_id").agg(F.max("overall_confidence").alias("c"))
    j = _jobs(spark, d).groupBy("job_uid").agg(F.min("platform").alias("platform"))
    g = n.join(b, "keyword_id", "left").join(j, "job_uid", "left").groupBy("name", "category").agg(F.count_distinct("job_uid").alias("frequency"), F.array_sort(F.collect_set("platform")).alias("platforms"), exact_avg(F.col("c"), 4).alias("mean_confidence"))
    platforms = F.when(F.size("platforms") > 0, F.col("platforms"))
    return rounded(g.withColumn("platforms", platforms))


@query("""SELECT count(*) AS total_jobs, count(n) AS covered, round(count(n) * 100.0::DOUBLE / count(*), 4) AS coverage, round(avg(n), 4) AS mean_per_job FROM (SELECT DISTINCT job_uid FROM jobs_llm_enriched) LEFT JOIN (SELECT job_uid, count(*) AS n FROM job_keywords_bridge GROUP BY 1) USING (job_uid)""")
def job_keywords_coverage(spark: SparkSession, d: str) -> DataFrame:
    """How many postings have any, and how many each of those has; the bridge is counted before it's joined."""
    n = table(spark, d, "job_keywords_bridge").groupBy("job_uid").agg(F.count("*").alias("n"))
    j = _jobs(spark, d).select("job_uid").distinct().join(n, "job_uid", "left")
    return rounded(j.agg(F.count("*").alias("total_jobs"), F.count("n").alias("covered"), (F.count("n") * 100.0 / F.count("*")).alias("coverage"), F.avg("n").alias("mean_per_job")))


@query("""SELECT keyword_category AS category, count(*) AS total, count(*) FILTER (confidence_score >= 0.8) AS high, count(*) FILTER (confidence_score < 0.5) AS low, count(*) FILTER (NOT coalesce(approved_by_admin, false)) AS to_review, round(avg(frequency_count), 4) AS mean_frequency FROM keywords_normalized GROUP BY 1""")
def keywords_quality_report(spark: SparkSession, d: str) -> DataFrame:
    return rounded(table(spark, d, "keywords_normalized").groupBy(F.col("keyword_category").alias("category")).agg(
        F.count("*").alias("total"), F.count_if(F.col("confidence_score") >= 0.8).alias("high"), F.count_if(F.col("confidence_score") < 0.5).alias("low"),
        F.count_if(~F.coalesce("approved_by_admin", F.lit(False))).alias("to_review"), F.avg("frequency_count").alias("mean_frequency"),
    ))


@query("""SELECT city, state, country, count(*) AS frequency, count(DISTINCT location_raw) AS variants, round(avg(cost_of_living_index), 4) AS mean_cost, bool_or(contains(lower(coalesce(location_raw, '')), 'remote')) AS is_remote_friendly FROM location_mapping GROUP BY ALL""")
def locations_analysis(spark: SparkSession, d: str) -> DataFrame:
    remote = F.contains(F.lower(F.coalesce("location_raw", F.lit(""))), F.lit("remote"))
    return rounded(table(spark, d, "location_mapping").groupBy("city", "state", "country").agg(F.count("*").alias("frequency"), F.count_distinct("location_raw").alias("variants"), F.avg("cost_of_living_index").alias("mean_cost"), F.bool_or(remote).alias("is_remote_friendly")))


# Quality

_COVER = "(SELECT 100.0::DOUBLE * count(*) FILTER (job_uid IN (SELECT job_uid FROM {0} WHERE job_uid IS NOT NULL)) / count(*) FROM (SELECT DISTINCT job_uid FROM jobs_llm_enriched WHERE job_uid IS NOT NULL))"
_COVERED = (("salary", "job_salary_bridge"), ("keywords", "job_keywords_bridge"))
_SURE = (("jobs", "jobs_llm_enriched", "llm_overall_confidence"), ("keywords", "keywords_normalized", "confidence_score"), ("pay", "salary_normalized", "confidence_score"))
_BRIDGES = (("salary_bridge", "job_salary_bridge", "overall_confidence"), ("keywords_bridge", "job_keywords_bridge", "overall_confidence"))
_FILLED = (("family_filled", "job_family"), ("seniority_filled", "seniority_level"))
_PARTS_SQL = [f"SELECT '{n}_coverage' AS metric, {_COVER.format(t)} AS value, 85.0 AS green, 70.0 AS yellow" for n, t in _COVERED]
_PARTS_SQL += [f"SELECT '{n}_avg_confidence', avg({c}), 0.8, 0.7 FROM {t} WHERE NOT coalesce(isnan({c}), false)" for n, t, c in (*_SURE, *_BRIDGES)]
_PARTS_SQL += [f"SELECT '{n}_high_confidence_rate', count(*) FILTER ({c} >= 0.8) * 100.0::DOUBLE / count(*), 70.0, 50.0 FROM {t} WHERE NOT coalesce(isnan({c}), false)" for n, t, c in _SURE]
_PARTS_SQL += [f"SELECT '{n}', count({c}) * 100.0::DOUBLE / count(*), 95.0, 80.0 FROM jobs_llm_enriched" for n, c in _FILLED]
_METRICS = "SELECT metric, round(value, 4) AS value, CASE WHEN value >= green THEN 'GREEN' WHEN value >= yellow THEN 'YELLOW' ELSE 'RED' END AS status FROM (" + " UNION ALL ".join(_PARTS_SQL) + ")"


@query(_METRICS)
def quality_metrics_all(spark: SparkSession, d: str) -> DataFrame:
    """Twelve metrics: coverage of bridges, mean confidences of items and bridges, shares of sure items, filled columns."""
    uids = _jobs(spark, d).select("job_uid").filter("job_uid is not null").distinct()
    parts = []
    for n, t in _COVERED:
        there = table(spark, d, t).select("job_uid").distinct().withColumn("there", F.lit(True))
        parts.append(quality.column_metrics(uids.join(there, "job_uid", "left"), {f"{n}_coverage": (F.count_if("there") * 100.0 / F.count("*"), 85.0, 70.0)}))
    parts += [quality.confidence_metrics(n, table(spark, d, t), c, rate) for group, rate in ((_SURE, True), (_BRIDGES, False)) for n, t, c in group]
    parts.append(quality.column_metrics(_jobs(spark, d), {n: (F.count(c) * 100.0 / F.count("*"), 95.0, 80.0) for n, c in _FILLED}))
    return rounded(reduce(DataFrame.unionByName, parts))


@query(f"SELECT *, unnest(['2025-05-01', '2025-05-02']) AS run_at FROM ({_METRICS})")
def quality_metrics_history(spark: SparkSession, d: str) -> DataFrame:
    """The metrics of two days as their history: each run appends."""
    p = scratch(spark)
    for day in ("2025-05-01", "2025-05-02"):
        dml.append_history(quality_metrics_all(spark, d), p, F.lit(day))
    return spark.read.parquet(p)


_YEARLY = "(coalesce((salary_min + salary_max) / 2, salary_min, salary_max) * CASE WHEN lower(salary_period) IN ('annually', 'yearly', 'year', 'per year') THEN 1 WHEN lower(salary_period) IN ('monthly', 'month', 'per month') THEN 12 WHEN lower(salary_period) IN ('weekly', 'week', 'per week') THEN 52 WHEN lower(salary_period) IN ('daily', 'day', 'per day') THEN 260 WHEN lower(salary_period) IN ('hourly', 'hour', 'per hour') THEN 2080 ELSE 1 END)"
_BAND = "CASE WHEN y <= 60000 THEN 'entry_0_60k' WHEN y <= 100000 THEN 'mid_60_100k' WHEN y <= 150000 THEN 'senior_100_150k' WHEN y <= 200000 THEN 'staff_150_200k' ELSE 'executive_200k_plus' END"
_IN = "count(*) FILTER (job_uid IN (SELECT job_uid FROM {0} WHERE job_uid IS NOT NULL))"


def _by(group: str, source: str, a: str = "job_salary_bridge", b: str = "job_keywords_bridge") -> str:
    return f"""SELECT {group}, total, with_salary, with_keywords, round(with_salary * 100.0::DOUBLE / total, 4) AS salary_coverage, round(with_keywords * 100.0::DOUBLE / total, 4) AS keywords_coverage FROM (
        SELECT {group}, count(*) AS total, {_IN.format(a)} AS with_salary, {_IN.format(b)} AS with_keywords FROM (SELECT DISTINCT job_uid, {group} FROM {source} WHERE job_uid IS NOT NULL AND {group} IS NOT NULL) GROUP BY 1) WHERE total >= 10"""


@query(_by("band", f"(SELECT job_uid, {_BAND} AS band FROM (SELECT job_uid, {_YEARLY} AS y FROM jobs_llm_enriched WHERE lower(salary_currency) = 'usd') WHERE y > 20000 AND y < 1000000)"))
def coverage_by_pay_band(spark: SparkSession, d: str) -> DataFrame:
    """Coverage by bands of yearly pay in dollars; a day counts 260 times a year here."""
    per = {1: ("annually", "yearly", "year", "per year"), 12: ("monthly", "month", "per month"), 52: ("weekly", "week", "per week"), 260: ("daily", "day", "per day"), 2080: ("hourly", "hour", "per hour")}
    low = F.lower("salary_period")
    factor = F.coalesce(*[F.when(low.isin(*names), n) for n, names in per.items()], F.lit(1))
    j = _jobs(spark, d).filter("lower(salary_currency) = 'usd'").select("job_uid", (F.coalesce((F.col("salary_min") + F.col("salary_max")) / 2, "salary_min", "salary_max") * factor).alias("y")).filter("y > 20000 and y < 1000000")
    y = F.col("y")
    band = F.when(y <= 60000, "entry_0_60k").when(y <= 100000, "mid_60_100k").when(y <= 150000, "senior_100_150k").when(y <= 200000, "staff_150_200k").otherwise("executive_200k_plus")
    return rounded(quality.coverage_by(j.select("job_uid", band.alias("band")), "band", {"salary": table(spark, d, "job_salary_bridge"), "keywords": table(spark, d, "job_keywords_bridge")}))


_SIZES = "(SELECT CAST(company_id AS VARCHAR) AS company_id, CASE WHEN n IS NULL THEN 'Unknown' WHEN n <= 50 THEN 'Startup' WHEN n <= 500 THEN 'Small' WHEN n <= 5000 THEN 'Medium' ELSE 'Large' END AS size FROM (SELECT company_id, TRY_CAST(nullif(regexp_extract(max(employee_count_range), '([0-9]+)', 1), '') AS BIGINT) AS n FROM companies GROUP BY 1))"


@query(_by("size", f"(SELECT job_id AS job_uid, size FROM icims_jobs JOIN {_SIZES} USING (company_id))", "(SELECT job_id AS job_uid FROM icims_jobs WHERE position_type IS NOT NULL)", "(SELECT job_id AS job_uid FROM icims_jobs WHERE category IS NOT NULL)"))
def coverage_by_company_size(spark: SparkSession, d: str) -> DataFrame:
    """Postings by the size class of their company; position types and categories stand for bridges."""
    sizes = table(spark, d, "companies").groupBy(F.col("company_id").cast("string").alias("company_id")).agg(F.max("employee_count_range").alias("r")).select("company_id", companies.size_class(F.col("r")).alias("size"))
    j = table(spark, d, "icims_jobs").withColumnRenamed("job_id", "job_uid")
    return rounded(quality.coverage_by(j.join(sizes, "company_id"), "size", {"salary": j.filter("position_type is not null"), "keywords": j.filter("category is not null")}))
