"""Queries of the operators for training data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyforge.llm import mapping, mixture, names, neardup, spans, survivor, tokens
from tallyforge.session import stored
from tallyforge.sources.tables import table

PLACE_LIST, KEYWORD_LIST = "location_mapping", "keywords_normalized"


def _meant(spark: SparkSession, d: str, rows: DataFrame) -> DataFrame:
    """(record_id, source_table, ref_id) of rows (list, record_id, value) of both lists."""
    places, words = mapping.place_entries(table(spark, d, "ref_locations")), mapping.keyword_entries(table(spark, d, "ref_keywords"))
    entries = places.withColumn("list", F.lit(PLACE_LIST)).unionByName(words.withColumn("list", F.lit(KEYWORD_LIST)))
    found = mapping.map_lists(rows.select("list", "value"), entries, {PLACE_LIST: mapping.PLACES, KEYWORD_LIST: mapping.KEYWORDS})
    return mapping.mapped(rows.withColumn("source_table", F.col("list")), found, ("list", "value"), ("record_id", "source_table"))


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    places = table(spark, d, "location_mapping").filter("location_standardized is null and mapping_id is not null")
    places = places.groupBy(F.col("mapping_id").cast("string").alias("record_id")).agg(F.min("location_raw").alias("value"))
    words = table(spark, d, "keywords_normalized").filter("keyword_id is not null").groupBy(F.col("keyword_id").alias("record_id"))
    words = words.agg(F.max("canonical_form").alias("settled"), F.min("keyword_text").alias("value")).filter("settled is null").drop("settled")
    rows = places.withColumn("list", F.lit(PLACE_LIST)).unionByName(words.withColumn("list", F.lit(KEYWORD_LIST)))
    return _meant(spark, d, rows).select("source_table", "record_id", "ref_id")


def _postings(spark: SparkSession, d: str) -> neardup.NearDuplicates:
    return neardup.NearDuplicates(table(spark, d, "icims_jobs"), "job_id", "job_title", "job_description")


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return _postings(spark, d).pairs().select(F.col("a").alias("job_id_a"), F.col("b").alias("job_id_b"))


def p2_classes(spark: SparkSession, d: str) -> DataFrame:
    return _postings(spark, d).classes().withColumnRenamed("id", "job_id")


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return survivor.survivors(table(spark, d, "companies"), undated="last")


def p3_learned(spark: SparkSession, d: str) -> DataFrame:
    return survivor.survivors(table(spark, d, "companies"), undated="learned")


def _orgs(spark: SparkSession, d: str) -> DataFrame:
    fields = ["company_name as name", "company_industry as industry", "city"]
    a = table(spark, d, "companies").selectExpr("concat('c', cast(company_id as string)) as key", *fields)
    b = table(spark, d, "company_profiles").selectExpr("profile_id as key", *fields)
    return names.linked_names(a.unionByName(b))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return names.key_pairs(stored(_orgs(spark, d)))


def p6_organisations(spark: SparkSession, d: str) -> DataFrame:
    return _orgs(spark, d)


def p7_ids(spark: SparkSession, d: str) -> DataFrame:
    return tokens.encode_corpus(table(spark, d, "documents"))


def p8_mixture(spark: SparkSession, d: str) -> DataFrame:
    return mixture.Mixture(table(spark, d, "documents"), table(spark, d, "mix_targets")).ordered()


def p8_shares(spark: SparkSession, d: str) -> DataFrame:
    return mixture.Mixture(table(spark, d, "documents"), table(spark, d, "mix_targets")).shares()


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    return spans.shared_spans(table(spark, d, "documents"))


def p9_kept(spark: SparkSession, d: str) -> DataFrame:
    """The documents without sentences that repeat an earlier document."""
    return spans.SharedSpans(table(spark, d, "documents")).kept()


QUERIES = {"p1_found": p1_found, "p6_found": p6_found, "p6_organisations": p6_organisations, "p8_mixture": p8_mixture, "p8_shares": p8_shares, "p2_found": p2_found, "p2_classes": p2_classes, "p9_found": p9_found, "p9_kept": p9_kept, "p3_found": p3_found, "p3_learned": p3_learned, "p7_ids": p7_ids}


def _p3_sql() -> str:
    nothing = ", ".join(f"'{x}'" for x in survivor.NOTHING)
    parts = []
    for f in survivor.COMPANY_FIELDS:
        ok = f"{f.name} IS NOT NULL AND trim({f.name}, ' ' || chr(9) || chr(10) || chr(13) || chr(160)) <> '' AND lower(trim({f.name})) NOT IN ({nothing})"
        if f.url:
            ok += f" AND regexp_matches(lower({f.name}), '^https?://[^\\s/?#:.@]+(\\.[^\\s/?#:.@]+)+(:[0-9]+)?([/?#]\\S*)?$') AND NOT contains({f.name}, chr(160))"
        trust = "coalesce(url_verified, false)" if f.trusted else "false"
        parts.append(f"""
        SELECT company_id, '{f.name}' AS field_name, record_id,
               row_number() OVER (PARTITION BY company_id ORDER BY {trust} DESC,
                   CASE WHEN last_updated > ingested_at THEN NULL ELSE last_updated END DESC NULLS LAST, record_id DESC) AS rn
        FROM companies WHERE {ok}
          AND company_id IN (SELECT company_id FROM companies GROUP BY 1 HAVING count(DISTINCT record_id) > 1)""")
    return "SELECT company_id, field_name, record_id FROM (" + " UNION ALL ".join(parts) + ") WHERE rn = 1"


# The entities that the test tables hold; neither decodes to a letter or digit, so they are blanks to words.
_P2_SQL = r"""
WITH t AS (SELECT DISTINCT job_id, regexp_extract_all(lower(regexp_replace(regexp_replace(coalesce(job_title, '') || ' ' || job_description, '<[^>]*>', ' ', 'g'), '&(amp|nbsp);', ' ', 'g')), '[a-z0-9]+') AS w
  FROM icims_jobs WHERE job_id IS NOT NULL AND job_description IS NOT NULL),
r AS (SELECT row_number() OVER () AS rid, job_id, w FROM t WHERE len(w) >= 20),
s AS (SELECT DISTINCT rid, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS x FROM (SELECT rid, w, unnest(range(1, len(w) - 1)) AS i FROM r)),
n AS (SELECT rid, count(*) AS n FROM s GROUP BY 1),
p AS (SELECT a.rid AS ra, b.rid AS rb, count(*) AS common FROM s a JOIN s b ON a.x = b.x AND a.rid < b.rid GROUP BY ALL)
SELECT DISTINCT least(x.job_id, y.job_id) AS job_id_a, greatest(x.job_id, y.job_id) AS job_id_b FROM p JOIN n na ON na.rid = ra JOIN n nb ON nb.rid = rb JOIN r x ON x.rid = ra JOIN r y ON y.rid = rb
WHERE common * 2 >= na.n + nb.n - common AND x.job_id <> y.job_id"""

_P9_SQL = """
WITH w AS (SELECT doc_id, i, hash(substr(text, i, 200)) AS h FROM (SELECT doc_id, text, unnest(range(1, length(text) - 198)) AS i FROM documents WHERE length(text) >= 200)),
s AS (SELECT h FROM w GROUP BY h HAVING min(doc_id) <> max(doc_id)),
p AS (SELECT doc_id, i, lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS before FROM w JOIN s USING (h))
SELECT doc_id, CAST(sum(CASE WHEN before IS NULL THEN 200 ELSE least(200, i - before) END) AS BIGINT) AS shared_chars FROM p GROUP BY 1"""

ORACLE = {"p2_found": _P2_SQL, "p3_found": _p3_sql(), "p9_found": _P9_SQL}
