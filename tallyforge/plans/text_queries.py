"""Queries of the text, id, language and company functions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyforge.functions import companies, ids, lang, predicates, text
from tallyforge.functions.rules import quote
from tallyforge.functions.langmodel import LanguageModel
from tallyforge.plans.mart import half_up
from tallyforge.plans.registry import registry
from tallyforge.sources.tables import table

QUERIES, ORACLE, query = registry()


@query(f"SELECT job_id, date_retrieved, {text.html_to_text_sql('job_description')} AS body FROM icims_jobs")
def html_to_text(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "icims_jobs").select("job_id", "date_retrieved", text.html_to_text(F.col("job_description")).alias("body"))


@query(f"SELECT job_id, date_retrieved, {text.description_sql('job_description')} AS body FROM icims_jobs")
def description_clean(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "icims_jobs").select("job_id", "date_retrieved", text.description(F.col("job_description")).alias("body"))


@query(f"SELECT job_id, date_retrieved, {text.job_title_sql('job_title')} AS title FROM icims_jobs")
def title_standardized(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "icims_jobs").select("job_id", "date_retrieved", text.job_title(F.col("job_title")).alias("title"))


@query(f"SELECT record_id, {text.company_name_sql('company_name')} AS name, {text.squeeze_sql('city')} AS city FROM companies")
def company_name_clean(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "companies").select("record_id", text.company_name(F.col("company_name")).alias("name"), text.squeeze(F.col("city")).alias("city"))


@query(f"SELECT job_id, date_retrieved, {text.employment_status_sql('position_type')} AS status FROM icims_jobs")
def employment_status(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "icims_jobs").select("job_id", "date_retrieved", text.employment_status(F.col("position_type")).alias("status"))


_URL = "CASE WHEN regexp_matches(t, '^https?://') THEN t ELSE 'https://' || t END"


@query(f"""
    SELECT record_id, t <> '' AND dom <> '' AS is_valid, CASE WHEN t = '' THEN '' ELSE u END AS normalized_url,
           CASE WHEN t <> '' AND dom <> '' THEN dom END AS domain,
           CASE WHEN t <> '' AND dom <> '' THEN regexp_extract(u, '^(https?)://', 1) END AS scheme
    FROM (SELECT record_id, t, {_URL} AS u, lower(regexp_extract({_URL}, '^https?://([^/?#]*)', 1)) AS dom
          FROM (SELECT record_id, trim(coalesce(ats_url, '')) AS t FROM companies))""")
def url_parts(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "companies").select("record_id", text.url_parts(F.col("ats_url")).alias("u")).select("record_id", "u.*")


def _location_sql() -> str:
    codes = "MAP {" + ", ".join(f"{quote(a.lower())}: {quote(k)}" for k, v in text.US_STATES.items() for a in (v, k)) + "}"
    g = lambda n: f"nullif(trim(regexp_extract(t, {quote(text.LOCATION)}, {n})), '')"
    return f"""
    SELECT mapping_id, CASE WHEN remote THEN 'Remote' ELSE concat_ws(', ', city, state, country) END AS standardized, city, state, country, remote AS is_remote
    FROM (SELECT mapping_id, remote,
            CASE WHEN remote THEN NULL WHEN found THEN g1 ELSE nullif(trim(parts[1]), '') END AS city,
            CASE WHEN remote THEN NULL WHEN found THEN coalesce(code, g2) WHEN len(parts) >= 3 THEN nullif(trim(parts[2]), '') END AS state,
            CASE WHEN remote THEN NULL WHEN found THEN CASE WHEN g3 IS NOT NULL OR code IS NOT NULL THEN 'United States' END
                 WHEN len(parts) >= 3 THEN nullif(trim(parts[3]), '') WHEN len(parts) = 2 THEN nullif(trim(parts[2]), '') END AS country
          FROM (SELECT mapping_id, t, regexp_matches(t, {quote(text.REMOTE)}) AS remote, regexp_matches(t, {quote(text.LOCATION)}) AS found,
                       {g(1)} AS g1, {g(2)} AS g2, {g(3)} AS g3, {codes}[lower({g(2)})] AS code, string_split(t, ',') AS parts
                FROM (SELECT mapping_id, {text.html_to_text_sql('location_raw')} AS t FROM location_mapping)))"""


@query(_location_sql())
def location_parse(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "location_mapping").select("mapping_id", text.location(F.col("location_raw")).alias("x")).select("mapping_id", "x.*")


@query(f"SELECT record_id, {companies.industry_sql('company_industry')} AS industry, CASE WHEN n IS NULL THEN 'Unknown' WHEN n <= 50 THEN 'Startup' WHEN n <= 500 THEN 'Small' WHEN n <= 5000 THEN 'Medium' ELSE 'Large' END AS size_class FROM (SELECT *, TRY_CAST(nullif(regexp_extract(employee_count_range, '([0-9]+)', 1), '') AS BIGINT) AS n FROM companies)")
def company_standardized(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "companies").select("record_id", companies.industry(F.col("company_industry")).alias("industry"), companies.size_class(F.col("employee_count_range")).alias("size_class"))


_UID = """substr(sha256('JOB_ID:' || CASE WHEN job_id IS NULL OR job_id = '' THEN 'NULL_JOB_ID' ELSE trim(job_id) END || '|PLATFORM:icims|COMPANY:' ||
    CASE WHEN company_id IS NULL OR company_id = '' THEN 'NULL_COMPANY' ELSE trim(company_id) END || '|DATE:' || coalesce(strftime(posted_date, '%Y-%m-%d'), 'NULL_DATE')), 1, 32)"""


def _with_uid(spark: SparkSession, d: str) -> DataFrame:
    j = table(spark, d, "icims_jobs")
    return j.withColumn("job_uid", ids.job_uid(F.col("job_id"), F.lit("iCIMS"), F.col("company_id"), F.date_format("posted_date", "yyyy-MM-dd")))


@query(f"SELECT job_id, date_retrieved, {_UID} AS job_uid FROM icims_jobs")
def job_uid(spark: SparkSession, d: str) -> DataFrame:
    return _with_uid(spark, d).select("job_id", "date_retrieved", "job_uid")


@query(f"""SELECT CAST(sum(n) AS BIGINT) AS total, count(*) AS uniques, CAST(sum(n - 1) AS BIGINT) AS duplicates, CAST(sum(CASE WHEN n > 1 THEN 1 ELSE 0 END) AS BIGINT) AS collided_ids
    FROM (SELECT {_UID} AS u, count(*) AS n FROM icims_jobs GROUP BY 1)""")
def uid_collisions(spark: SparkSession, d: str) -> DataFrame:
    return ids.uid_report(_with_uid(spark, d), "job_uid")


_ONE_WAY = "regexp_replace(trim(lower({0})), '\\s+', ' ', 'g')"


@query(f"""SELECT record_id, substr(sha256(CASE WHEN company_name IS NULL OR company_name = '' THEN 'NULL_COMPANY' ELSE {_ONE_WAY.format('company_name')} END || '|' ||
           CASE WHEN platform IS NULL OR platform = '' THEN 'NULL_PLATFORM' ELSE lower(trim(platform)) END), 1, 12) AS company_platform_id,
           substr(sha256({_ONE_WAY.format('company_name')}), 1, 8) AS short_company_id,
           substr(sha256({_ONE_WAY.format('company_name')} || '|' || {_ONE_WAY.format('city')} || coalesce('|' || strftime(date_added, '%Y-%m-%d'), '')), 1, 12) AS short_job_id FROM companies""")
def company_ids(spark: SparkSession, d: str) -> DataFrame:
    name = F.col("company_name")
    return table(spark, d, "companies").select(
        "record_id", ids.company_platform_id(name, F.col("platform")).alias("company_platform_id"), ids.short_company_id(name).alias("short_company_id"),
        ids.short_job_id(name, F.col("city"), F.date_format("date_added", "yyyy-MM-dd")).alias("short_job_id"),
    )


@query("""SELECT record_id, CASE WHEN regexp_matches(f, '^[A-Z]$') THEN f WHEN regexp_matches(f, '^[0-9]$') THEN '0-9' ELSE 'other' END AS bucket
    FROM (SELECT record_id, upper(substr(trim(company_name), 1, 1)) AS f FROM companies)""")
def company_bucket_partition(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "companies").select("record_id", predicates.company_bucket(F.col("company_name")).alias("bucket"))


def _language_sql(source: str, key: str, body: str) -> str:
    hits = lang.pattern_hits_sql(body)
    others = " + ".join(x for x in (*lang.LATIN, *lang.EAST_ASIAN))
    best = f"greatest({', '.join(lang.LATIN)})"
    share = f"CASE WHEN en + {others} = 0 THEN 0.5 ELSE CAST(en AS DOUBLE) / (en + {others}) END"
    short = f"length(trim(coalesce({body}, ''))) < {lang.LEAST_CHARS}"
    pick = lambda unknown, value, latin, low, en: " ".join([f"CASE WHEN short THEN {unknown}", *[f"WHEN {x} >= 1 THEN {value(x)}" for x in lang.EAST_ASIAN], *[f"WHEN {best} >= 2 AND {x} = {best} THEN {latin(x)}" for x in lang.LATIN], f"WHEN share <= 0.3 THEN {low} ELSE {en} END"])
    name = pick("'unknown'", lambda x: f"'{x}'", lambda x: f"'{x}'", "'unknown'", "'en'")
    conf = pick("0.0", lambda x: f"least(0.95, 0.8 + 0.05 * {x})", lambda x: f"least(0.9, 0.6 + 0.1 * {best})", "0.3", "share")
    return f"""SELECT {key}, {name} AS lang, round(CAST({conf} AS DOUBLE), 4) AS confidence FROM (SELECT *, {share} AS share FROM (
        SELECT {key}, {short} AS short, {', '.join(f'{sql} AS {x}' for x, sql in hits.items())} FROM {source}))"""


@query(_language_sql("documents", "doc_id", "text"))
def language_pattern_score(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", "text").withColumn("hits", lang.pattern_hits(F.col("text")))
    return docs.select("doc_id", lang.language_of(F.col("text"), F.col("hits")).alias("x")).select("doc_id", "x.lang", half_up(F.col("x.confidence")).alias("confidence"))


@query(f"""SELECT coalesce(d.lang, 'none') AS labelled, l.lang AS detected, count(*) AS n FROM documents d JOIN ({_language_sql('documents', 'doc_id', 'text')}) l USING (doc_id) GROUP BY ALL""")
def language_agreement(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("lang", "text").withColumn("hits", lang.pattern_hits(F.col("text")))
    detected = lang.language_of(F.col("text"), F.col("hits"))["lang"]
    return docs.groupBy(F.coalesce("lang", F.lit("none")).alias("labelled"), detected.alias("detected")).agg(F.count("*").alias("n"))


def _fields_sql() -> str:
    t, b, c = (_language_sql(f"(SELECT job_id, date_retrieved, {e} AS txt FROM icims_jobs)", "job_id, date_retrieved", "txt") for e in ("job_title", "job_description", "trim(coalesce(job_title, '') || ' ' || coalesce(job_description, ''))"))
    src = """CASE WHEN t.confidence >= 0.8 AND (b.confidence < 0.8 OR (t.lang IN ('ko', 'zh', 'ja') AND t.lang <> b.lang)) THEN 'job_title'
        WHEN b.confidence >= 0.8 THEN 'job_description' WHEN c.confidence >= 0.8 THEN 'combined' WHEN t.confidence > b.confidence THEN 'job_title_fallback' ELSE 'job_description_fallback' END"""
    pick = lambda f: f"CASE WHEN source IN ('job_title', 'job_title_fallback') THEN t{f} WHEN source = 'combined' THEN c{f} ELSE b{f} END"
    return f"""SELECT job_id, date_retrieved, lang, confidence, source, lang = 'en' AND confidence >= 0.8 AS is_english FROM (
        SELECT job_id, date_retrieved, source, {pick('lang')} AS lang, {pick('conf')} AS confidence FROM (
            SELECT DISTINCT t.job_id, t.date_retrieved, t.lang AS tlang, t.confidence AS tconf, b.lang AS blang, b.confidence AS bconf, c.lang AS clang, c.confidence AS cconf, {src} AS source
            FROM ({t}) t JOIN ({b}) b USING (job_id, date_retrieved) JOIN ({c}) c USING (job_id, date_retrieved)))"""


@query(_fields_sql())
def language_multi_field(spark: SparkSession, d: str) -> DataFrame:
    j = table(spark, d, "icims_jobs").select("job_id", "date_retrieved", F.col("job_title").alias("t"), F.col("job_description").alias("b"))
    j = j.withColumn("c", F.trim(F.concat(F.coalesce("t", F.lit("")), F.lit(" "), F.coalesce("b", F.lit("")))))
    for x in "tbc":
        j = j.withColumn(f"h{x}", lang.pattern_hits(F.col(x)))
    answers = {x: lang.language_of(F.col(x), F.col(f"h{x}")) for x in "tbc"}
    j = j.withColumns({f"a{x}": F.struct(a["lang"].alias("lang"), half_up(a["confidence"]).alias("confidence")) for x, a in answers.items()})
    return j.select("job_id", "date_retrieved", lang.of_fields(F.col("at"), F.col("ab"), F.col("ac")).alias("x")).select("job_id", "date_retrieved", "x.*").distinct()


@query("""SELECT doc_id, CASE WHEN lang IS NULL OR lang = '' THEN 'unknown' WHEN lower(lang) IN ('zh-cn', 'zh-tw', 'zh-hans', 'zh-hant') THEN 'zh' WHEN lower(lang) IN ('en-us', 'en-gb') THEN 'en'
    WHEN lower(lang) = 'ja-jp' THEN 'ja' WHEN lower(lang) = 'ko-kr' THEN 'ko' ELSE substr(lower(lang), 1, 2) END AS code FROM documents""")
def language_code(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", lang.language_code(F.col("lang")).alias("code"))


_LABEL = "CASE WHEN lang IS NULL OR lang = '' THEN 'unknown' ELSE substr(lower(lang), 1, 2) END"


@query(f"""SELECT doc_id, CASE WHEN east THEN f WHEN pc >= 0.8 THEN p WHEN fc >= 0.8 THEN f WHEN pc >= fc THEN p ELSE f END AS lang, CASE WHEN east THEN 'fallback' WHEN pc >= 0.8 THEN 'primary' WHEN fc >= 0.8 THEN 'fallback' WHEN pc >= fc THEN 'primary_unsure' ELSE 'fallback_unsure' END AS method FROM (
    SELECT doc_id, p, pc, l.lang AS f, l.confidence AS fc, l.lang IN ('ko', 'zh', 'ja') AND l.confidence >= 0.8 AS east FROM (SELECT doc_id, {_LABEL} AS p, (doc_id % 10) / 10.0::DOUBLE AS pc FROM documents) JOIN ({_language_sql('documents', 'doc_id', 'text')}) l USING (doc_id))""")
def language_combined(spark: SparkSession, d: str) -> DataFrame:
    """Two detectors' answers made one; the label, with a made-up confidence, stands for the statistical one."""
    docs = table(spark, d, "documents").select("doc_id", "text", "lang").withColumn("hits", lang.pattern_hits(F.col("text")))
    docs = docs.withColumn("fallback", lang.language_of(F.col("text"), F.col("hits")))
    docs = docs.withColumn("fallback", F.struct("fallback.lang", half_up(F.col("fallback.confidence")).alias("confidence")))
    label = F.when(F.col("lang").isNull() | (F.col("lang") == ""), "unknown").otherwise(F.substring(F.lower("lang"), 1, 2))
    primary = F.struct(label.alias("lang"), (F.col("doc_id") % 10 / 10).alias("confidence"))
    return docs.select("doc_id", lang.combined(primary, F.col("fallback")).alias("x")).select("doc_id", "x.lang", "x.method")


@query()
def language_statistical(spark: SparkSession, d: str) -> DataFrame:
    """Every text by a model of three-character runs fitted on the labelled texts. SQL has no such model; tests hold texts out."""
    docs = table(spark, d, "documents").select("doc_id", "text", "lang")
    return LanguageModel.fit(docs).detect(docs, "doc_id").select("doc_id", "lang", half_up(F.col("confidence"), 2).alias("confidence"))


_ENRICHED = ("salary_min", "salary_max", "salary_currency", "min_years_experience", "technical_skills", "work_type", "job_family", "seniority_level")


@query(f"SELECT job_uid, llm_processing_timestamp, ({' + '.join(f'({c} IS NOT NULL)::INT' for c in _ENRICHED)}) / {float(len(_ENRICHED))} AS completeness FROM jobs_llm_enriched")
def completeness_score(spark: SparkSession, d: str) -> DataFrame:
    filled = sum((F.col(c).isNotNull().cast("int") for c in _ENRICHED), F.lit(0))
    return table(spark, d, "jobs_llm_enriched").select("job_uid", "llm_processing_timestamp", (filled / len(_ENRICHED)).alias("completeness"))


@query("""SELECT doc_id, CASE WHEN text IS NULL OR trim(text, ' ') = '' THEN 0 ELSE len(string_split(trim(text, ' '), ' ')) END AS token_count,
    md5(CASE WHEN t = '' THEN 'No job description provided' WHEN length(t) > 8000 THEN substr(t, 1, 8000) || '...[truncated]' ELSE t END) AS prompt_hash
    FROM (SELECT *, trim(coalesce(text, ''), ' ') AS t FROM documents)""")
def token_count(spark: SparkSession, d: str) -> DataFrame:
    t = F.trim(F.coalesce("text", F.lit("")))
    n = F.when(t == "", 0).otherwise(F.size(F.split(t, " ")))
    return table(spark, d, "documents").select("doc_id", n.alias("token_count"), F.md5(text.prompt_text(F.col("text"))).alias("prompt_hash"))


@query("""SELECT job_uid, llm_processing_timestamp, CASE WHEN n = 0 THEN 0.0 ELSE s / n END AS mean_confidence FROM (
    SELECT job_uid, llm_processing_timestamp, list_sum(l) AS s, len(l) AS n FROM (
    SELECT job_uid, llm_processing_timestamp, list_filter([salary_confidence, llm_overall_confidence], lambda x: x BETWEEN 0 AND 1) AS l FROM jobs_llm_enriched))""")
def confidence_mean(spark: SparkSession, d: str) -> DataFrame:
    ok = F.filter(F.array("salary_confidence", "llm_overall_confidence"), lambda x: x.between(0, 1))
    mean = F.coalesce(F.try_divide(F.aggregate(ok, F.lit(0.0), lambda a, x: a + x), F.size(ok)), F.lit(0.0))
    return table(spark, d, "jobs_llm_enriched").select("job_uid", "llm_processing_timestamp", mean.alias("mean_confidence"))


@query("""SELECT record_id, lower(trim(city)) NOT IN ('null', 'none', 'n/a', '') AND length(trim(city)) > 1 AS is_value, coalesce(upper(trim(CAST(url_verified AS VARCHAR))) IN ('TRUE', '1', 'YES', 'Y'), false) AS is_true FROM companies""")
def placeholder_and_truth(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "companies").select("record_id", predicates.not_placeholder(F.col("city")).alias("is_value"), predicates.truthy(F.col("url_verified").cast("string")).alias("is_true"))
