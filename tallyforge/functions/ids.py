"""Deterministic ids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _or(c: Column, missing: str, low: bool = False) -> Column:
    s = c.cast("string")
    t = F.lower(F.trim(s)) if low else F.trim(s)
    return F.when(s.isNull() | (s == ""), missing).otherwise(t)


def job_uid(job_id: Column, platform: Column, company_id: Column, posted: Column) -> Column:
    """32 hex characters from a posting's id, platform, company and date (yyyy-MM-dd)."""
    parts = (
        F.lit("JOB_ID:"), _or(job_id, "NULL_JOB_ID"), F.lit("|PLATFORM:"), _or(platform, "NULL_PLATFORM", True),
        F.lit("|COMPANY:"), _or(company_id, "NULL_COMPANY"), F.lit("|DATE:"), _or(posted, "NULL_DATE"),
    )
    return F.substring(F.sha2(F.concat(*parts), 256), 1, 32)


def company_platform_id(name: Column, platform: Column) -> Column:
    """12 hex characters from a company's name (case and blanks don't matter) and its platform."""
    n = F.when(name.isNull() | (name == ""), "NULL_COMPANY").otherwise(_one_way(name))
    return F.substring(F.sha2(F.concat(n, F.lit("|"), _or(platform, "NULL_PLATFORM", True)), 256), 1, 12)


def _one_way(c: Column) -> Column:
    """Lower case, white space as single blanks."""
    return F.regexp_replace(F.trim(F.lower(c)), r"\s+", " ")


def short_company_id(name: Column) -> Column:
    """8 hex characters from a company's name; null stays null."""
    return F.substring(F.sha2(_one_way(name), 256), 1, 8)


def short_job_id(company: Column, title: Column, posted: Column) -> Column:
    """12 hex characters from company, title and, if there is one, the date (yyyy-MM-dd)."""
    p = posted.cast("string")
    tail = F.when(p.isNull() | (p == ""), "").otherwise(F.concat(F.lit("|"), p))
    return F.substring(F.sha2(F.concat(_one_way(company), F.lit("|"), _one_way(title), tail), 256), 1, 12)


def surrogate_id(prefix: str, *parts: Column) -> Column:
    """A stable surrogate key from natural keys: no numbering over all rows is needed, and reruns agree."""
    return F.concat(F.lit(prefix), F.substring(F.sha2(F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("~")) for p in parts]), 256), 1, 12))


def uid_report(df: DataFrame, uid: str) -> DataFrame:
    """One row: total, unique and duplicate ids, and how many ids stand for several rows."""
    per = df.groupBy(uid).agg(F.count("*").alias("n"))
    return per.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total"), F.count("*").alias("uniques"), F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicates"),
        F.count_if(F.col("n") > 1).alias("collided_ids"),
    )
