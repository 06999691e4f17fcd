"""Queries of board schemas, ids in addresses, salvaged JSON, and event-time windows."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyforge.functions import salvage
from tallyforge.functions.text import employment_status_sql
from tallyforge.operators.versioned import VersionedTable
from tallyforge.plans import catalog
from tallyforge.plans.registry import registry
from tallyforge.session import shared_dir
from tallyforge.sources import platforms
from tallyforge.sources.tables import table
from tallyforge.streaming import streams

QUERIES, ORACLE, query = registry()


@query(f"""SELECT job_id, company_id, job_title, job_url, location, date_retrieved, is_active, strftime(posted_date, '%Y-%m-%d') AS date_posted, CAST(NULL AS VARCHAR) AS department, {employment_status_sql('position_type')} AS employment_status, 'icims' AS platform,
    CASE WHEN position_type IS NULL AND category IS NULL THEN NULL ELSE '{{' || concat_ws(',', '"position_type":"' || position_type || '"', '"category":"' || category || '"') || '}}' END AS platform_specific_data FROM icims_jobs""")
def platform_mapping(spark: SparkSession, d: str) -> DataFrame:
    u = platforms.unified(table(spark, d, "icims_jobs"), "icims").withColumn("date_posted", F.date_format("date_posted", "yyyy-MM-dd"))
    return u.select("job_id", "company_id", "job_title", "job_url", "location", "date_retrieved", "is_active", "date_posted", "department", "employment_status", "platform", "platform_specific_data")


@query(r"""SELECT job_id, date_retrieved, nullif(regexp_extract(job_url, '/jobs/([0-9]+)/', 1), '') AS icims_id, nullif(regexp_extract(job_url, '^https?://([^./]+)\.', 1), '') AS tenant FROM icims_jobs""")
def connector_ids(spark: SparkSession, d: str) -> DataFrame:
    url = F.col("job_url")
    return table(spark, d, "icims_jobs").select("job_id", "date_retrieved", platforms.icims_id(url).alias("icims_id"), platforms.workday_site(url)["tenant"].alias("tenant"))


@query(r"""SELECT record_id, CASE WHEN a = '' OR b = '' OR a IS NULL OR b IS NULL THEN 'invalid' WHEN ra <> rb THEN 'other_domain' WHEN pa <> '' AND pb = '' THEN 'generic' ELSE 'same' END AS verdict FROM (
    SELECT *, array_to_string(string_split(a, '.')[-2:], '.') AS ra, array_to_string(string_split(b, '.')[-2:], '.') AS rb FROM (
    SELECT record_id, lower(regexp_extract(ats_url, '^https?://(?:www\.)?([^/?#:]+)', 1)) AS a, lower(regexp_extract(career_url, '^https?://(?:www\.)?([^/?#:]+)', 1)) AS b,
      regexp_replace(regexp_extract(ats_url, '^https?://[^/?#]+/?([^?#]*)', 1), '/$', '') AS pa, regexp_replace(regexp_extract(career_url, '^https?://[^/?#]+/?([^?#]*)', 1), '/$', '') AS pb FROM companies))""")
def url_verdicts(spark: SparkSession, d: str) -> DataFrame:
    """The career page stands for the address that a check reached."""
    return table(spark, d, "companies").select("record_id", platforms.url_verdict(F.col("ats_url"), F.col("career_url")).alias("verdict"))


@query("""SELECT event_id, '{"skills":{"confidence":' || (event_id % 10) / 10.0::DOUBLE || '},"k":' || json_extract_string(props, '$.k') || '}' AS js, (event_id % 10) / 10.0::DOUBLE AS confidence FROM events""")
def json_salvage(spark: SparkSession, d: str) -> DataFrame:
    """Objects wrapped in prose or fences, by turns, found again in Arrow batches."""
    e = table(spark, d, "events")
    obj = F.concat(F.lit('{"skills": {"confidence": '), (F.col("event_id") % 10 / 10).cast("string"), F.lit('}, "k": '), F.get_json_object("props", "$.k"), F.lit("}"))
    turn = F.col("event_id") % 3
    fenced = F.concat(F.lit("Here it is:\n```json\n"), obj, F.lit("\n```\nDone."))
    text = F.when(turn == 0, obj).when(turn == 1, fenced).otherwise(F.concat(F.lit("The answer is "), obj, F.lit(" as asked.")))
    s = e.select("event_id", salvage.salvaged_json(text).alias("js"))
    return s.select("event_id", "js", salvage.mean_confidence(F.col("js")).alias("confidence"))


@query("""SELECT record_id, CAST(company_id AS VARCHAR) AS board_id, company_name AS title, nullif('R-' || record_id, '') AS workday_id, CAST(company_id AS VARCHAR) AS icims_id, CAST(record_id AS VARCHAR) AS greenhouse_id FROM companies WHERE company_name IS NOT NULL AND company_id IS NOT NULL""")
def page_extractions(spark: SparkSession, d: str) -> DataFrame:
    """Fields of fetched pages: the list that a script assigns, and ids in addresses."""
    c = table(spark, d, "companies").filter("company_name is not null and company_id is not null")
    item = F.to_json(F.array(F.struct(F.col("company_id").cast("string").alias("id"), F.col("company_name").alias("title"))))
    body = F.concat(F.lit("<html><script>var other = 1;\n var jobImpressions = "), item, F.lit(";</script></html>"))
    one = F.get(platforms.icims_impressions(body), F.lit(0))
    id_, rec = F.col("company_id").cast("string"), F.col("record_id").cast("string")
    return c.select(
        "record_id", one["id"].alias("board_id"), one["title"].alias("title"), platforms.workday_id(F.concat(F.lit("/job/Some-Place/Cook_R-"), rec)).alias("workday_id"),
        platforms.icims_id(F.concat(F.lit("https://x.example/jobs/"), id_, F.lit("/view"))).alias("icims_id"), platforms.greenhouse_id(F.concat(F.lit("https://x.example/a?b=1&gh_jid="), rec)).alias("greenhouse_id"),
    )


@query("SELECT 'discovery_enrichment_search' AS job, p AS part, 'discovery_enrichment_search_' || p || '_2025-03-' || lpad(CAST(day AS VARCHAR), 2, '0') AS run_key FROM (SELECT unnest([chr(CAST(c AS INT)) for c in range(65, 91)] || ['0-9', 'other']) AS p), (SELECT unnest([8, 9, 10]) AS day) UNION ALL SELECT 'schema_drift', NULL, 'schema_drift_' || strftime(t, '%Y-%m-%d_%H') FROM (SELECT unnest(generate_series(TIMESTAMP '2025-03-08 01:00:00', TIMESTAMP '2025-03-10 12:00:00', INTERVAL 1 HOUR)) AS t)")
def schedule_runs(spark: SparkSession, d: str) -> DataFrame:
    """Runs that became due over two and a half days with a change of clocks: daily for each slice, and hourly."""
    runs = catalog.due(dt.datetime(2025, 3, 8, 0, 0, tzinfo=dt.UTC), dt.datetime(2025, 3, 10, 12, 0, tzinfo=dt.UTC))
    return spark.createDataFrame(runs, "job string, part string, run_key string")


@query("SELECT date_trunc('day', ts) AS window_start, event_type, count(*) AS n FROM events GROUP BY ALL")
def tumbling_counts(spark: SparkSession, d: str) -> DataFrame:
    return streams.tumbling_counts(table(spark, d, "events"), "ts", "event_type").withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


@query("""SELECT min(ts) AS session_start, max(ts) + INTERVAL 30 MINUTE AS session_end, user_id, count(*) AS n FROM (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS s FROM (
    SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) < INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS fresh FROM events)) GROUP BY user_id, s""")
def session_counts(spark: SparkSession, d: str) -> DataFrame:
    return streams.session_counts(table(spark, d, "events"), "ts", "user_id").withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("session_start", "session_end")})


@query("SELECT user_id, event_id, ts, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1")
def stream_upsert(spark: SparkSession, d: str) -> DataFrame:
    """The whole event table streamed into an upserted table, as a micro-batch job that ends."""
    base = f"{shared_dir(spark)}/tallyforge-{spark.sparkContext.applicationId}/stream-{uuid.uuid4().hex}"
    schema = "user_id bigint, event_id bigint, ts timestamp_ntz, value double"
    target = VersionedTable(spark, f"{base}/table", schema, ["user_id"])
    events = table(spark, d, "events")
    events.select("user_id", "event_id", "ts", "value").repartitionByRange(4, "ts").write.mode("overwrite").parquet(f"{base}/in")
    stream = streams.file_stream(spark, f"{base}/in", schema, files_per_batch=2)
    streams.upsert_stream(stream, target, ["user_id"], [F.desc("ts"), F.desc("event_id")], f"{base}/checkpoint").awaitTermination()
    return target.read()
