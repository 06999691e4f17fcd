"""Queries of joins, aggregates, windows, sorts and set operations over the test tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyforge.operators import joins
from tallyforge.operators.dml import latest_per_key
from tallyforge.operators.incremental import capped_per_group
from tallyforge.plans.mart import change, exact_avg, half_up, percent, rounded
from tallyforge.plans.registry import registry
from tallyforge.sources.tables import table

QUERIES, ORACLE, query = registry()


# Joins


@query("""
SELECT o_orderkey, coalesce(c_custkey, -1) AS company_key, coalesce(c_mktsegment, 'INDUSTRY_UNKNOWN') AS industry, coalesce(n_name, 'COUNTRY_UNKNOWN') AS country,
  coalesce(r_name, 'REGION_UNKNOWN') AS region, strftime(o_orderdate, '%Y%m%d') AS date_key, CAST(date_trunc('month', o_orderdate) AS DATE) AS partition_date, o_totalprice
FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_acctbal > 0) ON c_custkey = o_custkey LEFT JOIN nation ON n_nationkey = c_nationkey LEFT JOIN region ON r_regionkey = n_regionkey""")
def posting_fact_star(spark: SparkSession, d: str) -> DataFrame:
    """A fact with its dimension lookups; the build side is filtered first, misses get the unknown key."""
    c = table(spark, d, "customer").filter("c_acctbal > 0")
    f = table(spark, d, "orders").join(c, F.col("c_custkey") == F.col("o_custkey"), "left")
    f = f.join(table(spark, d, "nation"), F.col("n_nationkey") == F.col("c_nationkey"), "left").join(table(spark, d, "region"), F.col("r_regionkey") == F.col("n_regionkey"), "left")
    return f.select(
        "o_orderkey", F.coalesce("c_custkey", F.lit(-1)).alias("company_key"), F.coalesce("c_mktsegment", F.lit("INDUSTRY_UNKNOWN")).alias("industry"),
        F.coalesce("n_name", F.lit("COUNTRY_UNKNOWN")).alias("country"), F.coalesce("r_name", F.lit("REGION_UNKNOWN")).alias("region"),
        F.date_format("o_orderdate", "yyyyMMdd").alias("date_key"), F.trunc("o_orderdate", "month").alias("partition_date"), "o_totalprice",
    )


@query("""
SELECT j.job_uid, j.llm_processing_timestamp, coalesce(k.family_rank, 'FAMILY_UNKNOWN') AS looked_up_family_rank FROM jobs_llm_enriched j
LEFT JOIN (SELECT lower(keyword_category) AS k, 'F_' || min(keyword_id) AS family_rank FROM keywords_normalized WHERE keyword_category IS NOT NULL GROUP BY 1) k ON k.k = lower(j.seniority_level)""")
def top_one_lookup(spark: SparkSession, d: str) -> DataFrame:
    """A case-insensitive lookup against the first row of each name, so that it can't multiply rows."""
    k = table(spark, d, "keywords_normalized").select("keyword_category", "keyword_id", F.concat(F.lit("F_"), "keyword_id").alias("family_rank"))
    j = table(spark, d, "jobs_llm_enriched").select("job_uid", "llm_processing_timestamp", "seniority_level")
    return joins.lookup_top(j, k, F.lower("seniority_level"), F.lower("keyword_category"), [F.asc("keyword_id")], "family_rank", "FAMILY_UNKNOWN").drop("seniority_level")


BANDS = [("entry", 0.0, 2.0), ("junior", 1.0, 3.0), ("middle", 3.0, 5.0), ("senior", 5.0, 8.0), ("lead", 7.0, 12.0), ("principal", 10.0, None)]
_BANDS_SQL = "(VALUES " + ", ".join(f"('{n}', {a}::DOUBLE, {'NULL' if b is None else b}::DOUBLE)" for n, a, b in BANDS) + ") AS b(band, low, high)"


@query(f"SELECT job_uid, llm_processing_timestamp, band FROM (SELECT DISTINCT job_uid, llm_processing_timestamp, min_years_experience FROM jobs_llm_enriched) JOIN {_BANDS_SQL} ON min_years_experience >= low AND (high IS NULL OR min_years_experience <= high)")
def experience_range_join(spark: SparkSession, d: str) -> DataFrame:
    """Overlapping bands by a cell join: two years fall into two bands."""
    bands = spark.createDataFrame(BANDS, "band string, low double, high double")
    j = table(spark, d, "jobs_llm_enriched").select("job_uid", "llm_processing_timestamp", "min_years_experience").distinct()
    return joins.in_band(j, "min_years_experience", bands, "low", "high", 2.0).select("job_uid", "llm_processing_timestamp", "band")


@query("""
SELECT DISTINCT record_id, rule FROM companies, LATERAL (SELECT unnest(CASE WHEN regexp_matches(lower(company_name), '(tech|soft|analytics)') THEN ['R_TECH', 'R_DIGITAL'] WHEN regexp_matches(lower(company_name), '(dental|pharm|bio)') THEN ['R_HEALTH'] ELSE [] END) AS rule)""")
def pattern_join(spark: SparkSession, d: str) -> DataFrame:
    """A join by patterns, written as the rule ids that a text gives and an explode."""
    n = F.lower("company_name")
    ids = F.when(n.rlike("(tech|soft|analytics)"), F.array(F.lit("R_TECH"), F.lit("R_DIGITAL"))).when(n.rlike("(dental|pharm|bio)"), F.array(F.lit("R_HEALTH")))
    return table(spark, d, "companies").select("record_id", F.explode(ids).alias("rule")).distinct()


@query("""
SELECT DISTINCT m.mapping_id AS left_id, r.location_id AS right_id FROM location_mapping m JOIN ref_locations r
  ON lower(trim(m.location_raw)) = lower(r.location_name) OR lower(trim(m.location_raw)) = lower(r.city) OR m.location_standardized = r.location_name OR m.city = r.city""")
def or_equality_bridge(spark: SparkSession, d: str) -> DataFrame:
    """Four alternatives of equality as one hash join."""
    m = table(spark, d, "location_mapping").withColumnRenamed("mapping_id", "left_id")
    r = table(spark, d, "ref_locations").withColumnRenamed("location_id", "right_id")
    raw, tag = F.lower(F.trim("location_raw")), lambda i, c: F.concat(F.lit(f"{i}:"), c)
    left = [tag(0, raw), tag(1, raw), tag(2, F.col("location_standardized")), tag(3, F.col("city"))]
    right = [tag(0, F.lower("location_name")), tag(1, F.lower("city")), tag(2, F.col("location_name")), tag(3, F.col("city"))]
    return joins.any_key(m, r, left, right)


@query("""
SELECT keyword_id, created_timestamp, k.keyword_text_clean, r.keyword_ref_id FROM keywords_normalized k LEFT JOIN (SELECT *, keyword_ref_id < 'K0200' AS latest FROM ref_keywords) r ON lower(r.keyword_name) = lower(k.keyword_text_clean)
WHERE r.latest OR r.keyword_ref_id IS NULL""")
def stale_lookup_filter(spark: SparkSession, d: str) -> DataFrame:
    """Join first, then filter: rows that meet stale entries only are dropped, rows that meet none stay."""
    r = table(spark, d, "ref_keywords").withColumn("latest", F.col("keyword_ref_id") < "K0200")
    k = table(spark, d, "keywords_normalized").select("keyword_id", "created_timestamp", "keyword_text_clean")
    return k.join(r, F.lower("keyword_name") == F.lower("keyword_text_clean"), "left").filter("latest or keyword_ref_id is null").select("keyword_id", "created_timestamp", "keyword_text_clean", "keyword_ref_id")


@query("""
SELECT m.mapping_id, s.state, CASE WHEN s.state IS NULL THEN c.country END AS country FROM (SELECT mapping_id, trim(string_split(location_raw, ',')[-1]) AS tail FROM location_mapping) m
LEFT JOIN (SELECT state_code, min(state) AS state FROM ref_locations WHERE country = 'United States' GROUP BY 1) s ON s.state_code = m.tail
LEFT JOIN (SELECT DISTINCT country FROM ref_locations WHERE country IS NOT NULL) c ON c.country = m.tail""")
def gated_lookup(spark: SparkSession, d: str) -> DataFrame:
    """A second lookup only where the first one found nothing."""
    m = table(spark, d, "location_mapping").select("mapping_id", F.trim(F.element_at(F.split("location_raw", ","), -1)).alias("tail"))
    ref = table(spark, d, "ref_locations")
    s = ref.filter("country = 'United States'").groupBy("state_code").agg(F.min("state").alias("state"))
    c = ref.select("country").filter("country is not null").distinct()
    j = m.join(s, F.col("state_code") == F.col("tail"), "left")
    return j.join(c, F.when(F.col("state").isNull(), F.col("tail")) == F.col("country"), "left").select("mapping_id", "state", "country")


@query("""SELECT m.mapping_id, r.location_id, coalesce(r.country_code, 'Other') AS country_code FROM location_mapping m LEFT JOIN ref_locations r ON r.city = m.city AND r.state = m.state AND r.country = m.country""")
def geo_multi_key(spark: SparkSession, d: str) -> DataFrame:
    r = table(spark, d, "ref_locations").select("city", "state", "country", "location_id", "country_code")
    m = table(spark, d, "location_mapping").select("mapping_id", "city", "state", "country")
    return m.join(r, ["city", "state", "country"], "left").select("mapping_id", "location_id", F.coalesce("country_code", F.lit("Other")).alias("country_code"))


def _nullable(null_safe: bool) -> str:
    op = "IS NOT DISTINCT FROM" if null_safe else "="
    return f"""SELECT DISTINCT j.job_uid, s.salary_id FROM jobs_llm_enriched j JOIN salary_normalized s ON j.salary_min {op} s.salary_min_original AND j.salary_max {op} s.salary_max_original
        AND lower(j.salary_period) = s.salary_period_original WHERE j.salary_min IS NOT NULL OR j.salary_max IS NOT NULL"""


def _nullable_join(spark: SparkSession, d: str, null_safe: bool) -> DataFrame:
    s = table(spark, d, "salary_normalized")
    j = table(spark, d, "jobs_llm_enriched").filter("salary_min is not null or salary_max is not null")
    same = (lambda a, b: a.eqNullSafe(b)) if null_safe else (lambda a, b: a == b)
    on = same(j.salary_min, s.salary_min_original) & same(j.salary_max, s.salary_max_original) & (F.lower(j.salary_period) == s.salary_period_original)
    return j.join(s, on).select("job_uid", "salary_id").distinct()


@query(_nullable(True))
def nullable_key_join(spark: SparkSession, d: str) -> DataFrame:
    """Keys in which null equals null, so that one-sided ranges meet."""
    return _nullable_join(spark, d, True)


@query(_nullable(False))
def nullable_key_join_legacy(spark: SparkSession, d: str) -> DataFrame:
    return _nullable_join(spark, d, False)


@query("SELECT o_orderkey FROM orders o WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey AND l_returnflag = 'R')")
def anti_not_exists(spark: SparkSession, d: str) -> DataFrame:
    li = table(spark, d, "lineitem").filter("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"))
    return joins.anti(table(spark, d, "orders").select("o_orderkey"), li, ["o_orderkey"])


@query("SELECT job_uid, keyword_id, bridge_id FROM job_keywords_bridge b WHERE NOT EXISTS (SELECT 1 FROM job_keywords_bridge x WHERE x.job_uid = b.job_uid AND x.keyword_id = b.keyword_id AND x.overall_confidence < 0.5)")
def tuple_not_in(spark: SparkSession, d: str) -> DataFrame:
    """NOT IN over two columns as a hash anti-join."""
    b = table(spark, d, "job_keywords_bridge")
    return joins.anti(b.select("job_uid", "keyword_id", "bridge_id"), b.filter("overall_confidence < 0.5"), ["job_uid", "keyword_id"])


@query("SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 400000)")
def semi_in(spark: SparkSession, d: str) -> DataFrame:
    big = table(spark, d, "orders").filter("o_totalprice > 400000").select(F.col("o_custkey").alias("c_custkey"))
    return table(spark, d, "customer").select("c_custkey", "c_name").join(big, "c_custkey", "left_semi")


@query("SELECT p_partkey, CASE WHEN EXISTS (SELECT 1 FROM lineitem WHERE l_partkey = p_partkey AND l_quantity > 49) THEN true ELSE false END AS in_bulk FROM part")
def exists_flag(spark: SparkSession, d: str) -> DataFrame:
    li = table(spark, d, "lineitem").filter("l_quantity > 49").select(F.col("l_partkey").alias("p_partkey"))
    return joins.flagged(table(spark, d, "part").select("p_partkey"), li, ["p_partkey"], "in_bulk")


@query("SELECT record_id, profile_id FROM companies c LEFT JOIN (SELECT DISTINCT profile_id, upper(trim(company_name)) AS k FROM company_profiles) p ON p.k = upper(trim(c.company_name))")
def expression_key_join(spark: SparkSession, d: str) -> DataFrame:
    key = lambda df: F.upper(F.trim(df.company_name))
    c, p = table(spark, d, "companies"), table(spark, d, "company_profiles")
    p = p.select("profile_id", key(p).alias("k")).distinct()
    return c.select("record_id", key(c).alias("k")).join(p, "k", "left").select("record_id", "profile_id")


@query("""SELECT job_id, date_retrieved, n FROM (SELECT job_id, date_retrieved, count(*) OVER (PARTITION BY job_id) AS n FROM icims_jobs) WHERE n > 1""")
def duplicate_groups(spark: SparkSession, d: str) -> DataFrame:
    """A self-join to duplicate groups as one window."""
    j = table(spark, d, "icims_jobs").select("job_id", "date_retrieved")
    return j.withColumn("n", F.count("*").over(Window.partitionBy("job_id"))).filter("n > 1")


@query("SELECT DISTINCT job_uid, lower(trim(unnest(technical_skills))) AS skill FROM jobs_llm_enriched WHERE technical_skills IS NOT NULL")
def flatten_skills(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "jobs_llm_enriched").select("job_uid", F.explode("technical_skills").alias("s")).select("job_uid", F.lower(F.trim("s")).alias("skill")).distinct()


@query("""SELECT event_id, 'k' AS name, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS value FROM events WHERE props IS NOT NULL""")
def variant_flatten_props(spark: SparkSession, d: str) -> DataFrame:
    """Keys and values of JSON objects, typed before they leave the builder."""
    m = F.from_json("props", "map<string,double>")
    return table(spark, d, "events").select("event_id", F.explode(m).alias("name", "value"))


@query("""SELECT profile_id, ingested_at, json_extract_string(raw_data, '$.name') AS name FROM company_profiles WHERE raw_data IS NOT NULL""")
def json_inline(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "company_profiles").filter("raw_data is not null")
    listed = F.from_json(F.concat(F.lit("["), "raw_data", F.lit("]")), "array<struct<name:string>>")
    return p.select("profile_id", "ingested_at", F.inline(listed))


# Aggregates


@query("""
SELECT o_orderpriority, count(*) AS n, count(*) FILTER (o_orderstatus = 'F') AS n_f, median(o_totalprice) FILTER (o_orderstatus = 'F') AS median_f, max(o_totalprice) FILTER (o_orderstatus = 'O') AS max_o,
  CAST(sum(CAST(o_totalprice AS DECIMAL(18, 2))) FILTER (o_orderstatus = 'F') AS DOUBLE) / count(*) FILTER (o_orderstatus = 'F') AS avg_f FROM orders GROUP BY 1 HAVING count(*) >= 10""")
def conditional_stats(spark: SparkSession, d: str) -> DataFrame:
    price = lambda s: F.when(F.col("o_orderstatus") == s, F.col("o_totalprice"))
    return table(spark, d, "orders").groupBy("o_orderpriority").agg(
        F.count("*").alias("n"), F.count_if(F.col("o_orderstatus") == "F").alias("n_f"), F.median(price("F")).alias("median_f"), F.max(price("O")).alias("max_o"), exact_avg(price("F")).alias("avg_f")
    ).filter("n >= 10")


@query("""
SELECT count(DISTINCT j.job_uid) AS jobs, count(DISTINCT k.job_uid) AS with_keyword, count(DISTINCT s.job_uid) AS with_salary FROM jobs_llm_enriched j
LEFT JOIN (SELECT DISTINCT job_uid FROM job_keywords_bridge) k ON k.job_uid = j.job_uid LEFT JOIN (SELECT DISTINCT job_uid FROM job_salary_bridge) s ON s.job_uid = j.job_uid""")
def multi_distinct(spark: SparkSession, d: str) -> DataFrame:
    """Counts of distinct jobs over several bridges without their fan-out: each bridge is reduced to its jobs first."""
    j = table(spark, d, "jobs_llm_enriched").select("job_uid").distinct()
    for name, bridge in (("k", "job_keywords_bridge"), ("s", "job_salary_bridge")):
        j = joins.flagged(j, table(spark, d, bridge).select("job_uid"), ["job_uid"], name)
    return j.agg(F.count("*").alias("jobs"), F.count_if("k").alias("with_keyword"), F.count_if("s").alias("with_salary"))


@query("SELECT c_mktsegment, quantile_cont(o_totalprice, 0.25) AS p25, quantile_cont(o_totalprice, 0.75) AS p75, quantile_cont(o_totalprice, 0.9) AS p90, median(o_totalprice) AS p50 FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY 1")
def percentiles(spark: SparkSession, d: str) -> DataFrame:
    j = table(spark, d, "orders").join(table(spark, d, "customer"), F.col("c_custkey") == F.col("o_custkey"))
    return j.groupBy("c_mktsegment").agg(*[F.percentile("o_totalprice", q).alias(f"p{int(q * 100)}") for q in (0.25, 0.75, 0.9)], F.median("o_totalprice").alias("p50"))


@query("""SELECT category, string_agg(DISTINCT keyword, ', ' ORDER BY keyword) AS keywords, count(DISTINCT keyword) AS n FROM (SELECT coalesce(keyword_category, 'none') AS category, keyword_text_clean AS keyword FROM keywords_normalized WHERE frequency_count >= 50) GROUP BY 1""")
def csv_lists(spark: SparkSession, d: str) -> DataFrame:
    k = table(spark, d, "keywords_normalized").filter("frequency_count >= 50").select(F.coalesce("keyword_category", F.lit("none")).alias("category"), F.col("keyword_text_clean").alias("keyword"))
    return k.groupBy("category").agg(F.array_join(F.array_sort(F.collect_set("keyword")), ", ").alias("keywords"), F.count_distinct("keyword").alias("n"))


@query("SELECT l_shipmode, n, n * 100.0::DOUBLE / sum(n) OVER () AS share FROM (SELECT l_returnflag || l_linestatus AS l_shipmode, count(*) AS n FROM lineitem GROUP BY 1)")
def share_of_total(spark: SparkSession, d: str) -> DataFrame:
    g = table(spark, d, "lineitem").groupBy(F.concat("l_returnflag", "l_linestatus").alias("l_shipmode")).agg(F.count("*").alias("n"))
    return g.withColumn("share", percent(F.col("n"), F.sum("n").over(Window.partitionBy())))


@query("""SELECT CASE WHEN o_totalprice < 60000 THEN '<60K' WHEN o_totalprice < 100000 THEN '60-100K' WHEN o_totalprice < 150000 THEN '100-150K' WHEN o_totalprice < 200000 THEN '150-200K' ELSE '>=200K' END AS band, count(*) AS n, count(DISTINCT o_custkey) AS companies, max(o_orderpriority) AS top_priority, CAST(count(*) * 100.0::DOUBLE / (SELECT count(*) FROM orders) AS DOUBLE) AS share FROM orders GROUP BY 1 HAVING count(*) >= 10""")
def salary_bands(spark: SparkSession, d: str) -> DataFrame:
    p = F.col("o_totalprice")
    band = F.when(p < 60000, "<60K").when(p < 100000, "60-100K").when(p < 150000, "100-150K").when(p < 200000, "150-200K").otherwise(">=200K")
    o = table(spark, d, "orders").withColumn("band", band).groupBy("band").agg(F.count("*").alias("n"), F.count_distinct("o_custkey").alias("companies"), F.max("o_orderpriority").alias("top_priority"))
    return o.withColumn("share", percent(F.col("n"), F.sum("n").over(Window.partitionBy()))).filter("n >= 10")


@query("""SELECT keyword_id, list_min(original_variants) AS first_variant, len(original_variants) AS n_variants, created_timestamp FROM keywords_normalized WHERE len(original_variants) > 0""")
def first_of_array(spark: SparkSession, d: str) -> DataFrame:
    k = table(spark, d, "keywords_normalized").filter(F.size("original_variants") > 0)
    return k.select("keyword_id", F.array_min("original_variants").alias("first_variant"), F.size("original_variants").cast("long").alias("n_variants"), "created_timestamp")


_SCORE = """(CASE WHEN employee_count_range <> '' THEN 10 ELSE 0 END + CASE WHEN city <> '' THEN 5 ELSE 0 END + CASE WHEN company_industry <> '' THEN 3 ELSE 0 END
    + CASE WHEN regexp_matches(employee_count_range, '[0-9]') THEN least(CAST(regexp_extract(employee_count_range, '([0-9]+)', 1) AS DOUBLE) / 1000, 5) ELSE 0 END)"""


@query(f"SELECT company_id, record_id, score FROM (SELECT company_id, record_id, {_SCORE} AS score, row_number() OVER (PARTITION BY company_id ORDER BY {_SCORE} DESC, record_id) AS rn FROM companies) WHERE rn = 1")
def best_record_merge(spark: SparkSession, d: str) -> DataFrame:
    """The most complete record of each company by a score."""
    filled = lambda c, n: F.when(F.col(c) != "", n).otherwise(0)
    size = F.nullif(F.regexp_extract("employee_count_range", r"([0-9]+)", 1), F.lit("")).try_cast("double") / 1000
    score = filled("employee_count_range", 10) + filled("city", 5) + filled("company_industry", 3) + F.coalesce(F.when(size.isNotNull(), F.least(size, F.lit(5.0))), F.lit(0.0))
    c = table(spark, d, "companies").select("company_id", "record_id", score.cast("double").alias("score"))
    return latest_per_key(c, ["company_id"], [F.desc("score"), F.asc("record_id")])


@query("SELECT DISTINCT job_family, seniority_level, work_type FROM jobs_llm_enriched")
def distinct_projection(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "jobs_llm_enriched").select("job_family", "seniority_level", "work_type").distinct()


@query("""SELECT platform, count(*) AS n, grouping_id(platform) AS is_total FROM companies GROUP BY ROLLUP (platform)""")
def stats_with_total(spark: SparkSession, d: str) -> DataFrame:
    """Counts with a grand total row."""
    return table(spark, d, "companies").rollup("platform").agg(F.count("*").alias("n"), F.grouping_id().alias("is_total"))


# Windows


@query("""SELECT company_id, record_id FROM (SELECT company_id, record_id, row_number() OVER (PARTITION BY company_id ORDER BY last_updated DESC NULLS LAST, record_id DESC) AS rn FROM companies) WHERE rn = 1""")
def row_number_dedup(spark: SparkSession, d: str) -> DataFrame:
    return latest_per_key(table(spark, d, "companies").select("company_id", "record_id", "last_updated"), ["company_id"], [F.desc_nulls_last("last_updated"), F.desc("record_id")]).drop("last_updated")


@query("""SELECT salary_id, percent_rank() OVER (ORDER BY salary_midpoint_annual_usd) * 100 AS market_percentile FROM salary_normalized""")
def percent_rank_market(spark: SparkSession, d: str) -> DataFrame:
    """Global rank over a small, normalised table (the one place where an unpartitioned window is right)."""
    return table(spark, d, "salary_normalized").select("salary_id", (F.percent_rank().over(Window.orderBy("salary_midpoint_annual_usd")) * 100).alias("market_percentile"))


@query("""
SELECT day, event_type, n, round((n - lag(n) OVER w) * 100.0::DOUBLE / lag(n) OVER w, 4) AS dod, lag(n, 4) OVER w AS n_4_ago, CAST(sum(n) OVER (w ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS BIGINT) AS n_7,
  round(avg(n) OVER (w ROWS BETWEEN 3 PRECEDING AND CURRENT ROW), 4) AS ma_4, CAST(rank() OVER (PARTITION BY day ORDER BY n DESC) AS INT) AS day_rank,
  round(avg(n) OVER (PARTITION BY event_type), 4) AS type_mean FROM (SELECT CAST(ts AS DATE) AS day, event_type, count(*) AS n FROM events GROUP BY ALL) WINDOW w AS (PARTITION BY event_type ORDER BY day)""")
def event_series(spark: SparkSession, d: str) -> DataFrame:
    """Lags, rolling sums, moving averages and ranks over one series; functions of one specification share a window."""
    e = table(spark, d, "events").groupBy(F.col("ts").cast("date").alias("day"), "event_type").agg(F.count("*").alias("n"))
    w = Window.partitionBy("event_type").orderBy("day")
    return rounded(e.select(
        "day", "event_type", "n", change(F.col("n"), F.lag("n").over(w)).alias("dod"), F.lag("n", 4).over(w).alias("n_4_ago"), F.sum("n").over(w.rowsBetween(-6, 0)).alias("n_7"),
        F.avg("n").over(w.rowsBetween(-3, 0)).alias("ma_4"), F.rank().over(Window.partitionBy("day").orderBy(F.desc("n"))).alias("day_rank"), F.avg("n").over(Window.partitionBy("event_type")).alias("type_mean"),
    ))


@query("""SELECT keyword_category, keyword_text_clean, n, CAST(rn AS INT) AS rank_in_group FROM (SELECT *, row_number() OVER (PARTITION BY keyword_category ORDER BY n DESC, keyword_text_clean) AS rn
    FROM (SELECT coalesce(keyword_category, 'none') AS keyword_category, keyword_text_clean, CAST(sum(frequency_count) AS BIGINT) AS n FROM keywords_normalized GROUP BY ALL)) WHERE rn <= 10""")
def top_keywords_by_category(spark: SparkSession, d: str) -> DataFrame:
    k = table(spark, d, "keywords_normalized").groupBy(F.coalesce("keyword_category", F.lit("none")).alias("keyword_category"), "keyword_text_clean").agg(F.sum("frequency_count").alias("n"))
    return capped_per_group(k, "keyword_category", [F.desc("n"), F.asc("keyword_text_clean")], 10)


# Sorting and limits that are the feature; set operations


@query("SELECT c_custkey, c_acctbal FROM customer ORDER BY c_acctbal DESC, c_custkey LIMIT 20")
def top_n(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "customer").select("c_custkey", "c_acctbal").orderBy(F.desc("c_acctbal"), "c_custkey").limit(20)


@query("SELECT job_id, date_retrieved FROM (SELECT job_id, date_retrieved, posted_date FROM icims_jobs WHERE is_active ORDER BY posted_date DESC NULLS LAST, job_id, date_retrieved LIMIT 50 OFFSET 25)")
def offset_paging(spark: SparkSession, d: str) -> DataFrame:
    """One page of the newest active postings."""
    j = table(spark, d, "icims_jobs").filter("is_active")
    return j.orderBy(F.desc_nulls_last("posted_date"), "job_id", "date_retrieved").offset(25).limit(50).select("job_id", "date_retrieved")


@query("""SELECT 'companies' AS source, coalesce(company_industry, '') AS value, count(*) AS n FROM companies GROUP BY ALL UNION ALL SELECT 'company_profiles', coalesce(company_industry, ''), count(*) FROM company_profiles GROUP BY ALL""")
def union_of_sources(spark: SparkSession, d: str) -> DataFrame:
    one = lambda t: table(spark, d, t).groupBy(F.lit(t).alias("source"), F.coalesce("company_industry", F.lit("")).alias("value")).agg(F.count("*").alias("n"))
    return reduce(DataFrame.unionByName, [one("companies"), one("company_profiles")])


@query("""SELECT platform, metric, CAST(value AS BIGINT) AS value FROM (SELECT platform, count(*) AS records, count(DISTINCT company_id) AS companies, count(ats_url) AS with_url FROM companies GROUP BY 1) UNPIVOT (value FOR metric IN (records, companies, with_url))""")
def unpivot_metrics(spark: SparkSession, d: str) -> DataFrame:
    g = table(spark, d, "companies").groupBy("platform").agg(F.count("*").alias("records"), F.count_distinct("company_id").alias("companies"), F.count("ats_url").alias("with_url"))
    return g.unpivot("platform", ["records", "companies", "with_url"], "metric", "value")


@query("""SELECT job_uid, date_diff('day', llm_processing_timestamp, last_updated) AS days, CAST(date_trunc('month', llm_processing_timestamp) AS DATE) AS month, round(coalesce(salary_confidence, 0) * 100, 4) AS pct,
    strftime(llm_processing_timestamp, '%Y%m%d') AS day_key, md5(coalesce(job_family, '')) AS family_key FROM jobs_llm_enriched""")
def scalar_functions(spark: SparkSession, d: str) -> DataFrame:
    j = table(spark, d, "jobs_llm_enriched")
    return j.select(
        "job_uid", F.datediff("last_updated", "llm_processing_timestamp").cast("long").alias("days"), F.trunc("llm_processing_timestamp", "month").alias("month"),
        half_up(F.coalesce("salary_confidence", F.lit(0.0)) * 100).alias("pct"), F.date_format("llm_processing_timestamp", "yyyyMMdd").alias("day_key"), F.md5(F.coalesce("job_family", F.lit(""))).alias("family_key"),
    )
