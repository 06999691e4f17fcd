"""Queries of sources and sinks: each writes below the shared folder and gives what is read back."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyforge.operators import dml, quality
from tallyforge.operators.store import Progress, Store
from tallyforge.operators.versioned import VersionedTable
from tallyforge.plans.registry import registry
from tallyforge.search.request import availability
from tallyforge.session import scratch
from tallyforge.sources import files, platforms, schemas
from tallyforge.sources.tables import table

QUERIES, ORACLE, query = registry()

# Files


def _typed(spark: SparkSession, d: str) -> DataFrame:
    """Customers as a file has them: some segments as texts that mean null."""
    seg = F.when(F.col("c_custkey") % 7 == 0, "NULL").when(F.col("c_custkey") % 7 == 1, "null").otherwise(F.col("c_mktsegment"))
    return table(spark, d, "customer").select("c_custkey", "c_name", seg.alias("c_mktsegment"))


_TYPED = "SELECT c_custkey AS {0}, c_name AS {1}, CASE WHEN c_custkey % 7 > 1 THEN c_mktsegment END AS {2} FROM customer"


@query(_TYPED.format("id", "label", "kind"))
def csv_positional(spark: SparkSession, d: str) -> DataFrame:
    """Columns by their place, whatever the header says."""
    p = scratch(spark)
    _typed(spark, d).write.option("header", True).csv(p)
    return files.read_csv(spark, p, "id long, label string, kind string", by_position=True).drop("source_file")


@query(_TYPED.format("c_custkey", "c_name", "c_mktsegment"))
def csv_glob_strict(spark: SparkSession, d: str) -> DataFrame:
    """Several folders by a pattern, read strictly."""
    p = scratch(spark)
    t = _typed(spark, d)
    for k in (0, 1):
        t.filter(F.col("c_custkey") % 2 == k).write.option("header", True).csv(f"{p}/part{k}")
    return files.read_csv(spark, f"{p}/part*", "c_custkey long, c_name string, c_mktsegment string", strict=True).drop("source_file")


@query("SELECT c_custkey, CASE WHEN c_custkey % 5 <> 0 THEN c_nationkey END AS c_nationkey, c_name FROM customer")
def csv_tolerant(spark: SparkSession, d: str) -> DataFrame:
    """A field that doesn't parse is null, and its row stays."""
    p = scratch(spark)
    bad = F.when(F.col("c_custkey") % 5 == 0, "many").otherwise(F.col("c_nationkey").cast("string"))
    table(spark, d, "customer").select("c_custkey", bad.alias("c_nationkey"), "c_name").write.option("header", True).csv(p)
    return files.read_csv(spark, p, "c_custkey long, c_nationkey int, c_name string").drop("source_file")


@query("SELECT event_id, user_id, event_type, props FROM events")
def json_files(spark: SparkSession, d: str) -> DataFrame:
    p = scratch(spark)
    e = table(spark, d, "events").select("event_id", "user_id", "event_type", "props")
    e.write.json(p)
    return files.read_json(spark, p, "event_id long, user_id long, event_type string, props string")


@query("SELECT CAST(r_regionkey AS VARCHAR) AS folder FROM region WHERE r_regionkey >= 2")
def new_files(spark: SparkSession, d: str) -> DataFrame:
    """Files whose content the log doesn't have: those of two regions are in it under other names."""
    p, q = scratch(spark), scratch(spark)
    n = table(spark, d, "nation").select("n_name", "n_regionkey").repartition(1).sortWithinPartitions("n_regionkey", "n_name")
    n.write.partitionBy("n_regionkey").option("header", True).csv(p)
    n.filter("n_regionkey < 2").write.partitionBy("n_regionkey").option("header", True).csv(q)
    none = spark.createDataFrame([], "file_hash string")
    log = files.new_files(spark, q, none)
    return files.new_files(spark, p, log).select(F.regexp_extract("path", r"n_regionkey=(\d+)", 1).alias("folder"))


@query("""SELECT record_id, coalesce(company_industry, 'Unknown') AS company_industry, coalesce(employee_count_range, 'Unknown') AS employee_count_range, coalesce(url_verified, false) AS url_verified FROM companies""")
def taxonomy_load(spark: SparkSession, d: str) -> DataFrame:
    """Nulls as 'Unknown', texts of truth as booleans."""
    c = table(spark, d, "companies").select("record_id", "company_industry", "employee_count_range", F.when(F.col("url_verified"), "YES").otherwise("no").alias("url_verified"))
    return files.with_unknown(c, ["company_industry", "employee_count_range"], ["url_verified"])


@query("SELECT n_nationkey, n_name FROM nation")
def required_columns(spark: SparkSession, d: str) -> DataFrame:
    """A folder of files with the columns that are asked for, and more."""
    p = scratch(spark)
    table(spark, d, "nation").write.option("header", True).csv(p)
    got = spark.read.option("header", True).csv(p)
    return files.require_columns(got, ["n_nationkey", "n_name"]).select(F.col("n_nationkey").cast("int"), "n_name")


@query("SELECT n_name AS name, n_regionkey * 10 AS weight FROM nation WHERE n_regionkey > 1 UNION ALL SELECT 'semi;colon', 7")
def seed_script(spark: SparkSession, d: str) -> DataFrame:
    """A seed file of several statements with variables, comments and a semicolon within quotes."""
    text = """
        -- the parent table; a comment
        CREATE OR REPLACE TEMPORARY VIEW seeded AS SELECT n_name AS name, n_regionkey * ${FACTOR} AS weight FROM parquet.`${FOLDER}/nation.parquet`;
        /* rows; of the seed */ SELECT * FROM seeded WHERE weight > 10 UNION ALL SELECT 'semi;colon', 7;
    """
    return files.run_script(spark, text, {"FACTOR": "10", "FOLDER": d})


@query("SELECT n_regionkey AS k, n_name AS name FROM nation")
def names_in_broken_json(spark: SparkSession, d: str) -> DataFrame:
    """Company names of texts that no JSON parser reads."""
    n = table(spark, d, "nation").select("n_regionkey", F.concat(F.lit('{"company_name": "'), "n_name", F.lit('", oops ')).alias("x"))
    texts = n.groupBy("n_regionkey").agg(F.array_join(F.array_sort(F.collect_list("x")), "} ").alias("t"))
    return texts.select(F.col("n_regionkey").alias("k"), F.explode(platforms.dirty_company_names(F.col("t"))).alias("name"))


@query("SELECT unnest(['" + "', '".join(schemas.SCHEMAS) + "']) AS name, 'empty' AS state")
def provisioned_tables(spark: SparkSession, d: str) -> DataFrame:
    """Every table of the registry is made once, with its schema."""
    p = scratch(spark)
    made = schemas.ensure_tables(spark, p)
    again = schemas.ensure_tables(spark, p)
    checked = [schemas.assert_schema(spark.read.parquet(f"{p}/{n}.parquet"), n).agg(F.lit(n).alias("name"), F.when(F.count("*") == 0, "empty").otherwise("filled").alias("state")) for n in made if n not in again]
    return reduce(DataFrame.unionByName, checked)


@query("SELECT record_id, company_name, ats_url AS found_ats_url, career_url AS found_career_url FROM companies WHERE regexp_matches(ats_url, '^https?:[^\"\\\\]+$') AND regexp_matches(career_url, '^https?:[^\"\\\\]+$') AND company_name IS NOT NULL AND NOT regexp_matches(company_name, '[\"\\\\]') AND trim(company_name, ' ') <> ''")
def discovered_urls(spark: SparkSession, d: str) -> DataFrame:
    """Addresses in the answers of a model: lists between prose, every third one broken by text within it."""
    c = table(spark, d, "companies").filter(F.col("ats_url").rlike(r'^https?:[^"\\]+$') & F.col("career_url").rlike(r'^https?:[^"\\]+$') & F.col("company_name").isNotNull() & ~F.col("company_name").rlike(r'["\\]') & (F.trim("company_name") != ""))
    one = F.concat(F.lit('{"company_name": "'), F.trim("company_name"), F.lit('", "ats_url": "'), "ats_url", F.lit('", '), F.when(F.col("record_id") % 3 == 0, "(as far as I know) ").otherwise(""), F.lit('"career_url": "'), "career_url", F.lit('"}'))
    answer = F.concat(F.lit('Here is [sic] what I found:\n[{"company_name": "Some Other", "ats_url": null}, '), one, F.lit("]\nDone."))
    answer = F.regexp_replace(answer, r"\[sic\] ", "")
    return platforms.discovered_urls(c.select("record_id", "company_name", answer.alias("answer"))).drop("answer")


# Sinks


@query("SELECT n_nationkey, n_name, n_regionkey FROM nation WHERE n_regionkey <> 1")
def full_refresh(spark: SparkSession, d: str) -> DataFrame:
    """Truncate and insert, overwrite, and delete and insert are one writer: nothing of the old table stays."""
    p = scratch(spark)
    n = table(spark, d, "nation")
    dml.write_full(n.filter("n_regionkey < 3"), p, ["n_regionkey"])
    dml.write_full(n.filter("n_regionkey <> 1"), p, ["n_regionkey"])
    return spark.read.parquet(p).select("n_nationkey", "n_name", "n_regionkey")


@query("SELECT n_nationkey, CASE WHEN n_regionkey = 1 THEN upper(n_name) || '!' ELSE n_name END AS n_name, n_regionkey FROM nation")
def overwritten_partitions(spark: SparkSession, d: str) -> DataFrame:
    p = scratch(spark)
    n = table(spark, d, "nation")
    dml.write_full(n, p, ["n_regionkey"])
    dml.write_partitions(n.filter("n_regionkey = 1").withColumn("n_name", F.concat(F.upper("n_name"), F.lit("!"))), p, ["n_regionkey"])
    return spark.read.parquet(p).select("n_nationkey", "n_name", "n_regionkey")


@query("SELECT c_custkey, c_mktsegment FROM customer WHERE c_acctbal > 0")
def swapped_table(spark: SparkSession, d: str) -> DataFrame:
    """A table replaced as a whole, in one step for its readers."""
    c = table(spark, d, "customer").select("c_custkey", "c_mktsegment", "c_acctbal")
    t = VersionedTable(spark, scratch(spark), "c_custkey long, c_mktsegment string")
    t.replace(c.select("c_custkey", "c_mktsegment"))
    t.replace(c.filter("c_acctbal > 0").select("c_custkey", "c_mktsegment"))
    return t.read()


@query("SELECT r_regionkey, r_name, unnest(['first', 'second']) AS run_at FROM region")
def appended_history(spark: SparkSession, d: str) -> DataFrame:
    p = scratch(spark)
    for run in ("first", "second"):
        dml.append_history(table(spark, d, "region").select("r_regionkey", "r_name"), p, F.lit(run))
    return spark.read.parquet(p)


@query("""SELECT record_id, list_filter([CASE WHEN coalesce(trim(company_name, ' '), '') = '' THEN 'name' END, CASE WHEN company_id IS NULL OR company_id <= 0 THEN 'id' END, CASE WHEN last_updated IS NULL OR last_updated > ingested_at THEN 'clock' END], lambda x: x IS NOT NULL) AS rejected_for FROM companies
    WHERE coalesce(trim(company_name, ' '), '') = '' OR company_id IS NULL OR company_id <= 0 OR last_updated IS NULL OR last_updated > ingested_at""")
def rejected_rows(spark: SparkSession, d: str) -> DataFrame:
    """Rows that fail a check go to a table of their own, with the checks; the others are written."""
    p = scratch(spark)
    c = table(spark, d, "companies")
    clock = F.col("last_updated").isNotNull() & F.coalesce(F.col("last_updated") <= F.col("ingested_at"), F.col("last_updated").isNotNull())
    good, bad = dml.split_rejects(c, {"name": F.trim("company_name") != "", "id": F.col("company_id") > 0, "clock": clock})
    good.write.parquet(f"{p}/good")
    bad.select("record_id", "rejected_for").write.parquet(f"{p}/rejected")
    return spark.read.parquet(f"{p}/rejected")


_LATEST = "SELECT {0}, job_title FROM (SELECT *, row_number() OVER (PARTITION BY {0} ORDER BY date_retrieved DESC, job_id DESC, company_id DESC, job_title DESC) AS rn FROM icims_jobs WHERE {1}) WHERE rn = 1"


def _upserted(spark: SparkSession, d: str, keys: list[str]) -> DataFrame:
    j = table(spark, d, "icims_jobs").filter(reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys]) & F.col("date_retrieved").isNotNull())
    last = lambda x: dml.latest_per_key(x, keys, [F.desc("date_retrieved"), F.desc_nulls_first("job_id"), F.desc_nulls_first("company_id"), F.desc_nulls_first("job_title")]).select(*keys, "job_title")
    return dml.merge_upsert(last(j.filter("date_retrieved < '2025-01-01'")), last(j.filter("date_retrieved >= '2025-01-01'")), keys)


@query(_LATEST.format("job_url", "job_url IS NOT NULL AND date_retrieved IS NOT NULL"))
def upsert_by_url(spark: SparkSession, d: str) -> DataFrame:
    """Postings whose address is known are updated, the others inserted."""
    return _upserted(spark, d, ["job_url"])


@query(_LATEST.format("job_id, company_id", "job_id IS NOT NULL AND company_id IS NOT NULL AND date_retrieved IS NOT NULL"))
def upsert_by_job_and_company(spark: SparkSession, d: str) -> DataFrame:
    """What a transport to a serving database does on conflict of (job_id, company_id)."""
    return _upserted(spark, d, ["job_id", "company_id"])


@query("SELECT 'serve' AS kind, n_nationkey, n_name FROM nation UNION ALL SELECT 'missing', NULL, NULL WHERE false")
def store_tables(spark: SparkSession, d: str) -> DataFrame:
    """Tables by schema and name; one that was never saved is empty."""
    store = Store(spark, scratch(spark))
    n = table(spark, d, "nation").select("n_nationkey", "n_name")
    store.save("serve.nation", n.limit(3))
    store.save("serve.nation", n)
    load = lambda name, kind: store.load(name, n.schema).select(F.lit(kind).alias("kind"), "*")
    return load("serve.nation", "serve").unionByName(load("serve.other", "missing"))


@query("SELECT DISTINCT company_id, platform FROM companies WHERE platform = 'icims' OR platform = 'workday' AND company_id % 2 = 1")
def resumed_work(spark: SparkSession, d: str) -> DataFrame:
    """What is left for a job that stopped after some of its work; a part is then done again."""
    work = table(spark, d, "companies").select("company_id", "platform").filter("platform in ('icims', 'workday')").distinct()
    progress = Progress(Store(spark, scratch(spark)).table("work.done", "company_id long, platform string", ["company_id", "platform"]))
    progress.finish(work.filter("platform = 'workday' and company_id % 2 = 0"))
    progress.finish(work.filter("platform = 'icims'"))
    progress.forget(F.col("platform") == "icims")
    return progress.left(work)


# Governance


@query("SELECT unnest([{'view_name': 'good', 'state': 'ok'}, {'view_name': 'lost_column', 'state': 'UNRESOLVED_COLUMN.WITH_SUGGESTION'}, {'view_name': 'lost_table', 'state': 'PATH_NOT_FOUND'}], recursive := true)")
def view_drift(spark: SparkSession, d: str) -> DataFrame:
    """Views whose plan no longer holds for the tables as they are."""
    c = table(spark, d, "companies")
    seen = quality.drift({"good": lambda: c.select("company_id"), "lost_column": lambda: c.select("company_ident"), "lost_table": lambda: table(spark, d, "company_addresses")})
    return spark.createDataFrame(sorted(seen.items()), "view_name string, state string")


@query("SELECT 'companies' AS name, true AS there, (SELECT count(*) FROM companies) AS n_rows, true AS usable UNION ALL SELECT 'nothing', false, 0, false")
def availability_check(spark: SparkSession, d: str) -> DataFrame:
    """Which tables a search may use."""
    return availability(spark, {"companies": lambda: table(spark, d, "companies"), "nothing": lambda: table(spark, d, "no_such_table")})
