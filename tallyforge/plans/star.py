"""The posting fact with its dimension lookups, the views over unified postings, and the whole serving table."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyforge.operators.dml import latest_per_key
from tallyforge.plans.dimensions import LEAST_CONFIDENCE, refresh_denorm

# Keys of what no dimension knows, defaults of a job family's parts, the first day that a posting may have.
UNKNOWN = {"company": "COMP_UNKNOWN", "location": "LOC_UNKNOWN", "job_family": "JF_UNKNOWN", "salary": "SAL_UNKNOWN", "description": "JD_UNKNOWN"}
FAMILY = {"job_family": None, "job_sub_family": "General", "seniority_level": "Not Specified", "role_type": "Not Specified"}
FIRST_DAY = "2020-01-01"
#: Columns of the serving table whose change makes a row change.
WATCHED = ("job_title_clean", "skills", "technical_skills", "soft_skills", "skill_categories", "skill_subcategories", "keywords", "is_active")


def valid_postings(jobs: DataFrame, as_of: Column) -> DataFrame:
    """Active English postings with a company and a date between the first day and today."""
    return jobs.filter("is_active and is_english and company_id is not null and trim(company_id) <> ''").filter(F.col("date_posted").between(F.lit(FIRST_DAY).cast("date"), as_of))


def english(jobs: DataFrame) -> DataFrame:
    return jobs.filter("is_english")


def recent(jobs: DataFrame, as_of: Column, days: int = 30) -> DataFrame:
    """Active postings of the last days."""
    return jobs.filter("is_active").filter(F.col("date_posted") >= F.date_sub(as_of, days))


def with_salary(jobs: DataFrame, enriched: DataFrame) -> DataFrame:
    """Postings with either side of a pay range, for each row of enriched (job_uid, salary_min, salary_max)."""
    return jobs.join(enriched.filter("salary_min is not null or salary_max is not null").select("job_uid", "salary_min", "salary_max"), "job_uid")


def posting_fact(jobs: DataFrame, enriched: DataFrame, dims: Mapping[str, DataFrame], salary_bridge: DataFrame, as_of: Column, legacy_semantics: bool = False) -> DataFrame:
    """One row per valid posting with the keys of eight dimensions.

    dims: company (company_id, company_key, is_current), location (location_name, location_key,
    confidence, frequency), job_family (the FAMILY columns, job_family_key), platform
    (platform, platform_key), description (job_uid, job_description_key), salary (salary_id,
    salary_key, midpoint). Of several locations of a name the surest counts; a family is
    looked up by its four parts, missing ones by their defaults. Of a posting's pay ranges
    that weren't rejected the surest counts. legacy_semantics takes all of them, so that a
    posting may be there several times, and none whose status is null.
    """
    j = valid_postings(jobs, as_of).join(enriched, "job_uid", "left")
    company = dims["company"].filter("is_current").select("company_id", "company_key")
    place = dims["location"].withColumn("_place", F.lower("location_name")).filter("_place is not null")
    place = latest_per_key(place, ["_place"], [F.desc_nulls_last("confidence"), F.desc_nulls_last("frequency"), F.asc("location_key")]).select("_place", "location_key")
    family = dims["job_family"].select(*[F.col(c).alias(f"_{c}") for c in FAMILY], "job_family_key")
    status = F.col("validation_status") if legacy_semantics else F.coalesce("validation_status", F.lit("pending"))
    pay = salary_bridge.filter(status != "rejected").select("job_uid", "salary_id", "overall_confidence")
    if not legacy_semantics:
        pay = latest_per_key(pay, ["job_uid"], [F.desc_nulls_last("overall_confidence"), F.asc_nulls_last("salary_id")])
    j = j.withColumns({"_place": F.lower("location_standardized")} | {f"_{c}": F.col(c) if d is None else F.coalesce(c, F.lit(d)) for c, d in FAMILY.items()})
    for dim, on in ((company, ["company_id"]), (place, ["_place"]), (family, [f"_{c}" for c in FAMILY]), (dims["platform"], ["platform"]), (dims["description"], ["job_uid"]), (pay, ["job_uid"]), (dims["salary"], ["salary_id"])):
        j = j.join(dim, on, "left")
    key = lambda name, column: F.coalesce(column, F.lit(UNKNOWN[name])).alias(column)
    return j.select(
        "job_uid", F.date_format("date_posted", "yyyyMMdd").alias("date_posted_key"), key("company", "company_key"), key("location", "location_key"), key("job_family", "job_family_key"),
        F.coalesce("platform_key", F.concat(F.lit("PLT_"), F.upper("platform"))).alias("platform_key"), key("salary", "salary_key"), key("description", "job_description_key"),
        "midpoint", F.col("overall_confidence").alias("salary_confidence"), F.trunc("date_posted", "month").alias("partition_date"),
    )


def skills_dimension(skills: DataFrame) -> DataFrame:
    """Skills (skill_id, skill, category, canonical_form, confidence, frequency, needs_review, approved) that are sure, reviewed or approved, with a form and a category; aliases aren't known."""
    said = lambda c: F.col(c).isNotNull() & (F.trim(c) != "")
    ok = skills.filter((F.col("confidence") >= LEAST_CONFIDENCE) & (~F.coalesce("needs_review", F.lit(True)) | F.coalesce("approved", F.lit(False))) & said("canonical_form") & said("category"))
    return ok.select(F.concat(F.lit("SKL_"), "skill_id").alias("skill_key"), "skill_id", F.col("skill").alias("skill_name"), F.col("category").alias("skill_category"), "canonical_form", F.lit(None).cast("string").alias("common_aliases"), F.col("frequency").alias("frequency_count"))


def location_dimension(places: DataFrame) -> DataFrame:
    """Places (location_id, city, state, country, confidence, needs_review, approved) that are sure, reviewed or approved, with city and country."""
    ok = places.filter((F.col("confidence") >= LEAST_CONFIDENCE) & (~F.coalesce("needs_review", F.lit(True)) | F.coalesce("approved", F.lit(False))) & F.col("city").isNotNull() & F.col("country").isNotNull())
    return ok.select(F.concat(F.lit("LOC_"), "location_id").alias("location_key"), "city", "state", "country", "confidence")


def serving_postings(facts: DataFrame, companies: DataFrame, descriptions: DataFrame, platforms: DataFrame, skills: DataFrame, keywords: DataFrame) -> DataFrame:
    """The whole row that a search shows: facts (posting_id, company_id, platform, ...) with company and description, the platform's columns if it's known, and six lists.

    skills: (posting_id, skill, kind, category, subcategory), kind 'technical' or 'soft';
    keywords: (posting_id, keyword). Lists are put together per posting before they are
    joined, all of the skills in one pass.
    """
    text = lambda c: F.nullif(F.array_join(F.array_sort(F.collect_set(c)), ", "), F.lit(""))
    of = lambda kind: F.when(F.col("kind") == kind, F.col("skill"))
    lists = skills.groupBy("posting_id").agg(
        text("skill").alias("skills"), text(of("technical")).alias("technical_skills"), text(of("soft")).alias("soft_skills"),
        text("category").alias("skill_categories"), text("subcategory").alias("skill_subcategories"),
    )
    words = keywords.groupBy("posting_id").agg(text("keyword").alias("keywords"))
    out = facts.join(companies, "company_id").join(descriptions, "posting_id").join(platforms, "platform", "left")
    return out.join(lists, "posting_id", "left").join(words, "posting_id", "left")


def refresh_serving(old: DataFrame, new: DataFrame) -> DataFrame:
    """The serving table after a run: rows of which a watched column changed are replaced, vanished postings pruned."""
    return refresh_denorm(old, new.select(*old.columns), ["posting_id"], [c for c in WATCHED if c in old.columns])
