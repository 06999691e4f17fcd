"""Queries of upserts, history and incremental processing over events, companies and postings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyforge.functions.predicates import company_bucket
from tallyforge.operators import dml, incremental
from tallyforge.plans.registry import registry
from tallyforge.sources.tables import table

QUERIES, ORACLE, query = registry()
CUT, NOW = "2024-01-20 00:00:00", "2024-01-30 00:00:00"


def _users(spark: SparkSession, d: str, later: bool) -> DataFrame:
    """The last event of each user before or from the cut on."""
    e = table(spark, d, "events").filter((F.col("ts") >= CUT) if later else (F.col("ts") < CUT))
    last = dml.latest_per_key(e, ["user_id"], [F.desc("ts"), F.desc("event_id")])
    return last.select("user_id", "event_type", "value", F.when(F.col("event_type") != "error", F.col("props")).alias("props"))


def _u(later: bool) -> str:
    return f"""(SELECT user_id, event_type, value, CASE WHEN event_type <> 'error' THEN props END AS props FROM (
        SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events WHERE ts {'>=' if later else '<'} '{CUT}') WHERE rn = 1)"""


@query(f"SELECT n.* FROM {_u(True)} n UNION ALL SELECT o.* FROM {_u(False)} o WHERE user_id NOT IN (SELECT user_id FROM {_u(True)})")
def merge_upsert(spark: SparkSession, d: str) -> DataFrame:
    return dml.merge_upsert(_users(spark, d, False), _users(spark, d, True), ["user_id"])


def _changed(differs: str, prune: bool) -> str:
    cols = ", ".join(f"CASE WHEN o.user_id IS NULL OR (n.user_id IS NOT NULL AND ({differs})) THEN n.{c} ELSE o.{c} END AS {c}" for c in ("event_type", "value", "props"))
    return f"SELECT coalesce(n.user_id, o.user_id) AS user_id, {cols} FROM {_u(False)} o FULL JOIN {_u(True)} n ON o.user_id = n.user_id" + (" WHERE n.user_id IS NOT NULL" if prune else "")


@query(_changed("o.event_type IS DISTINCT FROM n.event_type OR o.props IS DISTINCT FROM n.props", True))
def merge_if_changed_prune(spark: SparkSession, d: str) -> DataFrame:
    return dml.merge_if_changed(_users(spark, d, False), _users(spark, d, True), ["user_id"], ["event_type", "props"], prune=True)


@query(_changed("coalesce(o.props <> n.props, false)", False))
def merge_if_changed_legacy(spark: SparkSession, d: str) -> DataFrame:
    return dml.merge_if_changed(_users(spark, d, False), _users(spark, d, True), ["user_id"], ["props"], null_safe=False)


@query(f"""SELECT coalesce(n.user_id, o.user_id) AS user_id, CASE WHEN n.user_id IS NOT NULL THEN n.event_type ELSE o.event_type END AS event_type, CASE WHEN n.user_id IS NOT NULL THEN n.value ELSE o.value END AS value,
    coalesce(n.props, o.props) AS props FROM {_u(False)} o FULL JOIN {_u(True)} n ON o.user_id = n.user_id""")
def merge_coalesce(spark: SparkSession, d: str) -> DataFrame:
    return dml.merge_coalesce(_users(spark, d, False), _users(spark, d, True), ["user_id"], ["props"])


@query("""SELECT record_id, CASE WHEN (city IS NULL OR trim(city, ' ') = '') AND f.c IS NOT NULL THEN f.c ELSE city END AS city, company_id FROM companies LEFT JOIN (SELECT company_id, min(city) AS c FROM companies WHERE trim(city, ' ') <> '' GROUP BY 1) f USING (company_id)""")
def fill_if_blank(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "companies").select("record_id", "city", "company_id")
    return dml.fill_if_blank(c, c, "company_id", "city")


@query("SELECT mapping_id, location_raw, CASE WHEN n IS NOT NULL THEN n ELSE 0 END AS uses FROM (SELECT mapping_id, location_raw FROM location_mapping) m LEFT JOIN (SELECT location_raw, count(*) AS n FROM location_mapping GROUP BY 1) u USING (location_raw)")
def update_from_counts(spark: SparkSession, d: str) -> DataFrame:
    m = table(spark, d, "location_mapping").select("mapping_id", "location_raw", F.lit(0).cast("long").alias("uses"))
    counts = table(spark, d, "location_mapping").groupBy("location_raw").agg(F.count("*").alias("uses"))
    return dml.update_from(m, counts, ["location_raw"], ["uses"])


@query("SELECT bridge_id, job_uid, keyword_id FROM job_keywords_bridge WHERE keyword_id IS NULL OR keyword_id NOT IN (SELECT key_value FROM deleted_keys WHERE parent_table = 'keywords_normalized' AND key_value IS NOT NULL)")
def delete_where_in(spark: SparkSession, d: str) -> DataFrame:
    gone = table(spark, d, "deleted_keys").filter("parent_table = 'keywords_normalized'").select(F.col("key_value").alias("keyword_id"))
    return dml.delete_keys(table(spark, d, "job_keywords_bridge").select("bridge_id", "job_uid", "keyword_id"), gone, ["keyword_id"])


@query(f"""SELECT CAST(ts AS DATE) AS day, event_type, event_id, value * 2 AS value FROM events WHERE ts >= '{CUT}' UNION ALL SELECT CAST(ts AS DATE), event_type, event_id, value FROM events
    WHERE (CAST(ts AS DATE), event_type) NOT IN (SELECT CAST(ts AS DATE), event_type FROM events WHERE ts >= '{CUT}')""")
def replace_partitions(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events").select(F.col("ts").cast("date").alias("day"), "event_type", "event_id", "value", "ts")
    new = e.filter(F.col("ts") >= CUT).withColumn("value", F.col("value") * 2)
    return dml.replace_partitions(e.drop("ts"), new.drop("ts"), ["day", "event_type"])


def _snapshot(spark: SparkSession, d: str, until: str) -> DataFrame:
    c = table(spark, d, "companies").filter(F.col("ingested_at") < until)
    return dml.latest_per_key(c, ["company_id"], [F.desc("ingested_at"), F.desc("record_id")]).select("company_id", "company_industry", "city", "employee_count_range")


def _snap(until: str) -> str:
    return f"(SELECT company_id, company_industry, city, employee_count_range FROM (SELECT *, row_number() OVER (PARTITION BY company_id ORDER BY ingested_at DESC, record_id DESC) AS rn FROM companies WHERE ingested_at < '{until}') WHERE rn = 1)"


@query(f"""
WITH a AS {_snap('2024-10-01')}, b AS {_snap('2026-01-01')},
m AS (SELECT b.*, a.company_id IS NOT NULL AS known FROM b LEFT JOIN a USING (company_id) WHERE a.company_id IS NULL OR a.company_industry IS DISTINCT FROM b.company_industry OR a.city IS DISTINCT FROM b.city)
SELECT company_id, company_industry, city, employee_count_range, DATE '2024-10-01' AS valid_from, CASE WHEN company_id IN (SELECT company_id FROM m WHERE known) THEN DATE '2025-06-30' ELSE DATE '9999-12-31' END AS valid_to,
  company_id NOT IN (SELECT company_id FROM m WHERE known) AS is_current, 1 AS version FROM a
UNION ALL SELECT company_id, company_industry, city, employee_count_range, DATE '2025-07-01', DATE '9999-12-31', true, CASE WHEN known THEN 2 ELSE 1 END FROM m""")
def company_scd2_apply(spark: SparkSession, d: str) -> DataFrame:
    """Two snapshots of the company table as a history; the employee range alone makes no version."""
    first = _snapshot(spark, d, "2024-10-01")
    none = spark.createDataFrame([], "company_id long, company_industry string, city string, employee_count_range string, valid_from date, valid_to date, is_current boolean, version int")
    after = dml.scd2_apply(none, first, "company_id", ["company_industry", "city"], F.lit("2024-10-01"))
    return dml.scd2_apply(after, _snapshot(spark, d, "2026-01-01"), "company_id", ["company_industry", "city"], F.lit("2025-07-01"))


@query(f"SELECT event_type, max(CASE WHEN ts >= TIMESTAMP '{NOW}' - INTERVAL 7 DAY AND ts <= TIMESTAMP '{NOW}' THEN ts END) - INTERVAL 2 HOUR AS watermark FROM events GROUP BY 1")
def high_watermark(spark: SparkSession, d: str) -> DataFrame:
    return incremental.high_watermark(table(spark, d, "events"), "event_type", "ts", F.lit(NOW).cast("timestamp_ntz"))


@query(f"SELECT event_id, e.event_type FROM events e JOIN ({ORACLE['high_watermark']}) w ON w.event_type = e.event_type WHERE watermark IS NULL OR ts > watermark")
def incremental_scan(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events")
    return incremental.since_watermark(e, high_watermark(spark, d), "event_type", "ts").select("event_id", "event_type")


@query("""SELECT count(*) AS buckets, max(n) / sum(n)::DOUBLE AS top_share, count(*) >= 15 AND max(n) / sum(n)::DOUBLE <= 0.7 AS complete FROM (
    SELECT chr(CAST(65 + user_id % 26 AS INT)) AS b, count(*) AS n FROM events WHERE ts >= TIMESTAMP '2024-01-14 22:00:00' AND ts <= TIMESTAMP '2024-01-15 01:00:00' GROUP BY 1)""")
def partition_completeness(spark: SparkSession, d: str) -> DataFrame:
    """Whether the hours around a mark look like a whole run over the slices."""
    return incremental.completeness(table(spark, d, "events"), F.char((65 + F.col("user_id") % 26).cast("int")), "ts", F.to_timestamp_ntz(F.lit("2024-01-15 00:00:00")))


@query("SELECT company_id, CAST(CASE WHEN max(posted_date) IS NULL THEN 15 ELSE least(greatest(date_diff('day', max(posted_date), DATE '2025-07-01') + 2, 2), 90) END AS INT) AS days FROM icims_jobs GROUP BY 1")
def dynamic_lookback(spark: SparkSession, d: str) -> DataFrame:
    return incremental.lookback(table(spark, d, "icims_jobs"), "company_id", "posted_date", F.lit("2025-07-01").cast("date"))


@query("SELECT job_id, company_id, date_retrieved FROM (SELECT *, row_number() OVER (PARTITION BY job_id ORDER BY date_retrieved NULLS LAST, company_id NULLS LAST) AS rn FROM icims_jobs WHERE job_id IS NOT NULL) WHERE rn = 1")
def dedup_cross_platform(spark: SparkSession, d: str) -> DataFrame:
    return incremental.across_sources(table(spark, d, "icims_jobs").select("job_id", "company_id", "date_retrieved"), "job_id", ["date_retrieved", "company_id"])


@query("SELECT company_id, count(DISTINCT source_file) AS sources FROM companies WHERE company_id IS NOT NULL GROUP BY 1 HAVING count(DISTINCT source_file) > 1")
def uid_conflicts(spark: SparkSession, d: str) -> DataFrame:
    """Ids that stand for records of more than one source."""
    return incremental.key_conflicts(table(spark, d, "companies"), "company_id", "source_file")


@query(f"SELECT avg(CASE WHEN ts >= TIMESTAMP '{NOW}' - INTERVAL 2 HOUR THEN 1.0::DOUBLE ELSE 0 END) AS recent_share, CASE WHEN avg(CASE WHEN ts >= TIMESTAMP '{NOW}' - INTERVAL 2 HOUR THEN 1.0::DOUBLE ELSE 0 END) > 0.8 THEN 'incremental' ELSE 'full' END AS mode FROM events")
def processing_mode(spark: SparkSession, d: str) -> DataFrame:
    return incremental.processing_mode(table(spark, d, "events"), "ts", F.lit(NOW).cast("timestamp_ntz"))


@query("SELECT doc_id FROM documents WHERE length(trim(text, ' ')) >= 100 AND doc_id NOT IN (SELECT doc_id FROM documents WHERE lang = 'en')")
def work_selection(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    return incremental.work_to_do(docs, docs.filter("lang = 'en'"), "doc_id", "new_only", "text", "n_chars").select("doc_id")


@query("SELECT company_id, job_id, CAST(rn AS INT) AS rank_in_group FROM (SELECT company_id, job_id, row_number() OVER (PARTITION BY company_id ORDER BY date_retrieved DESC, job_id) AS rn FROM icims_jobs) WHERE rn <= 3")
def capped_scan(spark: SparkSession, d: str) -> DataFrame:
    """A work list of three postings per company: the cap is the feature."""
    j = table(spark, d, "icims_jobs").select("company_id", "job_id", "date_retrieved")
    return incremental.capped_per_group(j, "company_id", [F.desc("date_retrieved"), F.asc("job_id")], 3).drop("date_retrieved")


@query("SELECT doc_id FROM documents WHERE length(trim(text, ' ')) >= 100 AND doc_id IN (SELECT doc_id FROM documents WHERE n_chars / 10000.0 < 0.3)")
def work_selection_failed(spark: SparkSession, d: str) -> DataFrame:
    """Work that was done with little confidence (here by the length of the text)."""
    docs = table(spark, d, "documents").withColumn("c", F.col("n_chars") / 10000)
    return incremental.work_to_do(docs, docs, "doc_id", "failed_only", "text", "c").select("doc_id")


@query("SELECT doc_id FROM documents WHERE length(trim(text, ' ')) >= 100")
def work_selection_all(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    return incremental.work_to_do(docs, docs, "doc_id", "all", "text", "n_chars").select("doc_id")


@query("""SELECT job_id, date_retrieved, coalesce(b, partition_key) AS partition_key FROM icims_jobs LEFT JOIN (SELECT CAST(company_id AS VARCHAR) AS company_id, min(CASE WHEN regexp_matches(f, '^[A-Z]$') THEN f WHEN regexp_matches(f, '^[0-9]$') THEN '0-9' ELSE 'other' END) AS b
    FROM (SELECT company_id, upper(substr(trim(company_name, ' '), 1, 1)) AS f FROM companies WHERE company_name IS NOT NULL) GROUP BY 1) USING (company_id)""")
def backfilled_partition_key(spark: SparkSession, d: str) -> DataFrame:
    """A column added later, filled from the slice of each row's company."""
    slices = table(spark, d, "companies").filter("company_name is not null").groupBy(F.col("company_id").cast("string").alias("company_id")).agg(F.min(company_bucket(F.col("company_name"))).alias("partition_key"))
    return dml.update_from(table(spark, d, "icims_jobs").select("job_id", "date_retrieved", "company_id", "partition_key"), slices, ["company_id"], ["partition_key"]).drop("company_id")
