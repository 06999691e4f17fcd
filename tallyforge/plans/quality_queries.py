"""Queries of data quality and of the reports over normalised tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyforge.operators import quality
from tallyforge.operators.incremental import capped_per_group
from tallyforge.plans.mart import rounded
from tallyforge.plans.registry import registry
from tallyforge.sources.tables import table

QUERIES, ORACLE, query = registry()
_SEV = "CASE WHEN n_bad > 100 THEN 'HIGH' WHEN n_bad > 10 THEN 'MEDIUM' WHEN n_bad > 0 THEN 'LOW' ELSE 'OK' END AS severity"
ORPHANS = (("keyword_bridge_keyword", "job_keywords_bridge", "keywords_normalized", "keyword_id"), ("salary_bridge_salary", "job_salary_bridge", "salary_normalized", "salary_id"), ("salary_bridge_job", "job_salary_bridge", "jobs_llm_enriched", "job_uid"))


@query("SELECT *, " + _SEV + " FROM (" + " UNION ALL ".join(f"SELECT '{n}' AS check_name, count(*) AS n_rows, count(*) FILTER ({k} IS NOT NULL AND {k} NOT IN (SELECT {k} FROM {p} WHERE {k} IS NOT NULL)) AS n_bad FROM {c}" for n, c, p, k in ORPHANS) + ")")
def validation_severity(spark: SparkSession, d: str) -> DataFrame:
    return reduce(DataFrame.unionByName, [quality.orphan_check(n, table(spark, d, c), table(spark, d, p), k) for n, c, p, k in ORPHANS])


COVERAGE = (("jobs_with_salary", "jobs_llm_enriched", "job_salary_bridge", "job_uid"), ("jobs_with_keyword", "jobs_llm_enriched", "job_keywords_bridge", "job_uid"), ("keywords_used", "keywords_normalized", "job_keywords_bridge", "keyword_id"))


@query("SELECT check_name, n_rows, n_covered, round(n_covered * 100.0::DOUBLE / n_rows, 4) AS coverage, n_covered * 100.0::DOUBLE / n_rows < 85 AS below_goal FROM (" + " UNION ALL ".join(f"SELECT '{n}' AS check_name, count(DISTINCT {k}) AS n_rows, count(DISTINCT {k}) FILTER ({k} IN (SELECT {k} FROM {c} WHERE {k} IS NOT NULL)) AS n_covered FROM {p} WHERE {k} IS NOT NULL" for n, p, c, k in COVERAGE) + ")")
def coverage_report(spark: SparkSession, d: str) -> DataFrame:
    return rounded(reduce(DataFrame.unionByName, [quality.coverage_check(n, table(spark, d, p), table(spark, d, c), k) for n, p, c, k in COVERAGE]))


@query("""SELECT size, jobs, with_salary, round(with_salary * 100.0::DOUBLE / jobs, 4) AS coverage FROM (SELECT platform || ' ' || coalesce(work_type, 'none') AS size, count(DISTINCT j.job_uid) AS jobs, count(DISTINCT s.job_uid) AS with_salary
    FROM jobs_llm_enriched j LEFT JOIN (SELECT DISTINCT job_uid FROM job_salary_bridge) s ON s.job_uid = j.job_uid GROUP BY 1) WHERE jobs >= 10""")
def coverage_by_segment(spark: SparkSession, d: str) -> DataFrame:
    s = table(spark, d, "job_salary_bridge").select("job_uid").distinct().withColumn("has", F.lit(True))
    j = table(spark, d, "jobs_llm_enriched").select("job_uid", F.concat("platform", F.lit(" "), F.coalesce("work_type", F.lit("none"))).alias("size")).distinct().join(s, "job_uid", "left")
    g = j.groupBy("size").agg(F.count("*").alias("jobs"), F.count_if("has").alias("with_salary")).filter("jobs >= 10")
    return rounded(g.withColumn("coverage", F.col("with_salary") * 100.0 / F.col("jobs")))


_METRICS = (("salary_filled", "avg((salary_min IS NOT NULL)::INT) * 100", 60.0, 40.0), ("family_filled", "avg((job_family IS NOT NULL)::INT) * 100", 95.0, 80.0), ("mean_confidence", "avg(llm_overall_confidence) * 100", 80.0, 60.0),
            ("validated", "avg((coalesce(validation_status, '') = 'validated')::INT) * 100", 70.0, 40.0), ("skills_filled", "avg((technical_skills IS NOT NULL)::INT) * 100", 90.0, 75.0))


@query("SELECT metric, round(value, 4) AS value, CASE WHEN value >= green THEN 'GREEN' WHEN value >= yellow THEN 'YELLOW' ELSE 'RED' END AS status FROM (" + " UNION ALL ".join(f"SELECT '{n}' AS metric, CAST({e} AS DOUBLE) AS value, {g} AS green, {y} AS yellow FROM jobs_llm_enriched" for n, e, g, y in _METRICS) + ")")
def quality_metrics(spark: SparkSession, d: str) -> DataFrame:
    share = lambda c: F.avg(c.cast("int")) * 100
    exprs = (
        share(F.col("salary_min").isNotNull()), share(F.col("job_family").isNotNull()), F.avg("llm_overall_confidence") * 100,
        share(F.coalesce("validation_status", F.lit("")) == "validated"), share(F.col("technical_skills").isNotNull()),
    )
    return rounded(quality.column_metrics(table(spark, d, "jobs_llm_enriched"), {n: (e, g, y) for (n, _, g, y), e in zip(_METRICS, exprs, strict=True)}))


_RATING = "CASE WHEN c >= 0.9 THEN 'very high' WHEN c >= 0.8 THEN 'high' WHEN c >= 0.7 THEN 'medium' WHEN c >= 0.5 THEN 'low' ELSE 'very low' END"
_ACTION = "CASE WHEN c >= 0.8 THEN 'none' WHEN c >= 0.7 THEN 'sample' WHEN c >= 0.5 THEN 'review' ELSE 'rework' END"


@query(f"""SELECT grp, rating, action, n, round(n * 100.0::DOUBLE / sum(n) OVER (PARTITION BY grp), 4) AS share FROM (SELECT keyword_source AS grp, {_RATING} AS rating, {_ACTION} AS action, count(*) AS n
    FROM (SELECT keyword_source, overall_confidence AS c FROM job_keywords_bridge WHERE overall_confidence IS NOT NULL AND NOT isnan(overall_confidence)) GROUP BY ALL)""")
def confidence_buckets(spark: SparkSession, d: str) -> DataFrame:
    return rounded(quality.confidence_buckets(table(spark, d, "job_keywords_bridge"), F.col("keyword_source"), "overall_confidence"))


@query("""SELECT keyword_id AS item, frequency_count AS frequency, round(confidence_score, 4) AS confidence, CAST(CASE WHEN frequency_count >= 500 THEN 100 WHEN frequency_count >= 100 THEN 50 ELSE 25 END
    + CASE WHEN confidence_score < 0.3 THEN 50 WHEN confidence_score < 0.5 THEN 40 WHEN confidence_score < 0.6 THEN 35 WHEN confidence_score < 0.7 THEN 30 ELSE 10 END + least(floor(frequency_count / 10), 25) AS INT) AS priority
    FROM (SELECT DISTINCT keyword_id, frequency_count, confidence_score FROM keywords_normalized WHERE NOT coalesce(approved_by_admin, false) AND confidence_score < 0.7)""")
def review_queue(spark: SparkSession, d: str) -> DataFrame:
    k = table(spark, d, "keywords_normalized").filter("not coalesce(approved_by_admin, false) and confidence_score < 0.7").select("keyword_id", "frequency_count", "confidence_score").distinct()
    return rounded(quality.review_queue(k, "keyword_id", "confidence_score", "frequency_count", 10, 25))


@query("""SELECT (SELECT count(*) FROM (SELECT keyword_id FROM keywords_normalized WHERE keyword_id IS NOT NULL GROUP BY 1 HAVING count(*) > 1)) AS duplicate_keys, (SELECT count(*) FROM keywords_normalized WHERE keyword_id IS NULL) AS null_keys""")
def uniqueness(spark: SparkSession, d: str) -> DataFrame:
    return quality.unique_check(table(spark, d, "keywords_normalized"), ["keyword_id"])


@query("""SELECT platform, count(*) AS n, count(*) FILTER (validation_status = 'validated') AS validated, round(count(*) FILTER (validation_status = 'validated') * 100.0::DOUBLE / count(*), 4) AS success_rate,
    count(*) FILTER (llm_overall_confidence < 0.6) AS low_confidence, count(*) - count(DISTINCT job_uid) AS repeated FROM jobs_llm_enriched GROUP BY 1""")
def enrichment_stats(spark: SparkSession, d: str) -> DataFrame:
    ok = F.count_if(F.col("validation_status") == "validated")
    return rounded(table(spark, d, "jobs_llm_enriched").groupBy("platform").agg(
        F.count("*").alias("n"), ok.alias("validated"), (ok * 100.0 / F.count("*")).alias("success_rate"),
        F.count_if(F.col("llm_overall_confidence") < 0.6).alias("low_confidence"), (F.count("*") - F.count_distinct("job_uid")).alias("repeated"),
    ))


@query("""SELECT skill, n_jobs, n_families, families, CAST(rn AS INT) AS rank_in_group, family FROM (SELECT *, row_number() OVER (PARTITION BY family ORDER BY n_jobs DESC, skill) AS rn FROM (
    SELECT skill, count(DISTINCT job_uid) AS n_jobs, count(DISTINCT job_family) AS n_families, string_agg(DISTINCT job_family, ', ' ORDER BY job_family) AS families, coalesce(min(job_family), 'none') AS family
    FROM (SELECT job_uid, job_family, lower(trim(unnest(technical_skills))) AS skill FROM jobs_llm_enriched) GROUP BY 1)) WHERE rn <= 5""")
def top_skills_by_category(spark: SparkSession, d: str) -> DataFrame:
    j = table(spark, d, "jobs_llm_enriched").select("job_uid", "job_family", F.explode("technical_skills").alias("s")).withColumn("skill", F.lower(F.trim("s")))
    g = j.groupBy("skill").agg(
        F.count_distinct("job_uid").alias("n_jobs"), F.count_distinct("job_family").alias("n_families"),
        F.nullif(F.array_join(F.array_sort(F.collect_set("job_family")), ", "), F.lit("")).alias("families"), F.coalesce(F.min("job_family"), F.lit("none")).alias("family"),
    )
    return capped_per_group(g, "family", [F.desc("n_jobs"), F.asc("skill")], 5)


@query("""SELECT 'salary' AS queue, salary_id AS item, 'outlier' AS reason, CASE WHEN confidence_score < 0.5 THEN 'HIGH' WHEN confidence_score < 0.8 THEN 'MEDIUM' ELSE 'LOW' END AS level FROM salary_normalized WHERE outlier_flag
    UNION ALL SELECT DISTINCT 'keyword', keyword_id, 'low confidence', CASE WHEN confidence_score < 0.3 THEN 'HIGH' WHEN confidence_score < 0.5 THEN 'MEDIUM' ELSE 'LOW' END FROM keywords_normalized WHERE confidence_score < 0.6""")
def review_dashboard(spark: SparkSession, d: str) -> DataFrame:
    level = lambda c, hi, mid: F.when(c < hi, "HIGH").when(c < mid, "MEDIUM").otherwise("LOW").alias("level")
    s = table(spark, d, "salary_normalized").filter("outlier_flag").select(F.lit("salary").alias("queue"), F.col("salary_id").alias("item"), F.lit("outlier").alias("reason"), level(F.col("confidence_score"), 0.5, 0.8))
    k = table(spark, d, "keywords_normalized").filter("confidence_score < 0.6").select(F.lit("keyword").alias("queue"), F.col("keyword_id").alias("item"), F.lit("low confidence").alias("reason"), level(F.col("confidence_score"), 0.3, 0.5)).distinct()
    return s.unionByName(k)
