"""What job boards deliver, brought to one schema; and the ids that their addresses and pages hold."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyforge.functions.text import employment_status

# The fields of the common schema and, per board, where they come from and what stays with the board.
COMMON = ("job_id", "company_id", "job_title", "job_description", "job_url", "location", "date_retrieved", "is_active", "raw_data", "partition_key")
DATE_POSTED = {"bamboohr": "date_posted", "greenhouse": "published_at", "smartrecruiters": "published_at", "workday": "published_at", "icims": "posted_date"}
DEPARTMENT = {"bamboohr": "department", "greenhouse": "department", "smartrecruiters": "department"}
EMPLOYMENT = {"bamboohr": "employment_status", "workday": "employment_type", "icims": "position_type"}
EXTRAS = {
    "bamboohr": ("employment_status", "compensation", "work_type"),
    "greenhouse": ("department_id", "updated_at", "requisition_id", "work_type", "compensation"),
    "smartrecruiters": ("requisition_id",),
    "workday": ("time_type", "employment_type", "valid_through", "work_type", "compensation"),
    "icims": ("position_type", "category"),
}


def unified(df: DataFrame, platform: str) -> DataFrame:
    """The common schema: a field that the board lacks is null, what only it has goes to JSON (nulls left out, null if nothing is left); other columns pass through."""
    if platform not in EXTRAS:
        raise ValueError(f"unknown platform: {platform}")
    have = set(df.columns)
    take = lambda c: F.col(c) if c in have else F.lit(None).cast("string")
    source = lambda m: take(m[platform]) if platform in m else F.lit(None).cast("string")
    extras = [F.col(c).cast("string").alias(c) for c in EXTRAS[platform] if c in have]
    packed = F.nullif(F.to_json(F.struct(*extras)), F.lit("{}")) if extras else F.lit(None).cast("string")
    used = {*COMMON, *EXTRAS[platform], DATE_POSTED[platform], DEPARTMENT.get(platform), EMPLOYMENT.get(platform)}
    return df.select(
        *[take(c).alias(c) for c in COMMON], source(DATE_POSTED).alias("date_posted"), source(DEPARTMENT).alias("department"),
        employment_status(source(EMPLOYMENT)).alias("employment_status"), F.lit(platform).alias("platform"), packed.alias("platform_specific_data"),
        F.lit(f"raw.{platform}_jobs").alias("source_raw_table"), *[F.col(c) for c in df.columns if c not in used],
    )


def workday_id(path: Column) -> Column:
    return F.nullif(F.regexp_extract(path, r"_([A-Z0-9\-]+)$", 1), F.lit(""))


def workday_site(url: Column) -> Column:
    """struct(tenant, site) of an address like https://tenant.host/[locale/]site."""
    host = F.regexp_extract(url, r"^https?://([^./]+)\.", 1)
    site = F.regexp_extract(url, r"^https?://[^/]+/(?:[a-z]{2}-[A-Z]{2}/)?([^/?#]+)", 1)
    return F.struct(F.nullif(host, F.lit("")).alias("tenant"), F.nullif(site, F.lit("")).alias("site"))


def icims_id(url: Column) -> Column:
    return F.nullif(F.regexp_extract(url, r"/jobs/(\d+)/", 1), F.lit(""))


def greenhouse_id(url: Column) -> Column:
    return F.nullif(F.regexp_extract(url, r"[?&]gh_jid=(\d+)", 1), F.lit(""))


IMPRESSIONS = "array<struct<id:string,title:string,location:string,category:string,positionType:string>>"


def icims_impressions(body: Column) -> Column:
    """The list that a page assigns to jobImpressions; null if there is none or it doesn't parse."""
    return F.from_json(F.nullif(F.regexp_extract(body, r"(?s)var\s+jobImpressions\s*=\s*(\[.*?\])\s*;", 1), F.lit("")), IMPRESSIONS)


def dirty_company_names(text: Column) -> Column:
    """Company names of a broken JSON text, by pattern."""
    return F.regexp_extract_all(text, F.lit(r'"(?:company_)?name"\s*:\s*"([^"\\]+)"'), F.lit(1))


def url_verdict(asked: Column, reached: Column) -> Column:
    """What a redirect says about an address: 'same', 'generic' (the host's front page), 'other_domain' or 'invalid'."""
    host = lambda c: F.lower(F.regexp_extract(c, r"^https?://(?:www\.)?([^/?#:]+)", 1))
    root = lambda c: F.array_join(F.slice(F.split(host(c), r"\."), -2, 2), ".")
    path = lambda c: F.regexp_replace(F.regexp_extract(c, r"^https?://[^/?#]+/?([^?#]*)", 1), "/$", "")
    bad = (host(asked) == "") | (host(reached) == "") | asked.isNull() | reached.isNull()
    deep = F.size(F.split(host(asked), r"\.")) >= 2
    return F.when(bad, "invalid").when(deep & (root(asked) != root(reached)), "other_domain").when((path(asked) != "") & (path(reached) == ""), "generic").otherwise("same")


ANSWERED = "array<struct<company_name:string,ats_url:string,career_url:string>>"


def discovered_urls(companies: DataFrame, answer: str = "answer") -> DataFrame:
    """companies (company_name, answer) with the addresses that the answer of a model gives for the company.

    The answer holds a JSON list somewhere in prose. Where the list doesn't parse, because text
    stands between its fields, the fields behind the company's own name are taken, up to the next
    company's. A company that the answer doesn't name has no addresses.
    """
    listed = F.from_json(F.regexp_extract(F.col(answer), r"(?s)(\[.*\])", 1), ANSWERED)
    mine = F.get(F.filter(listed, lambda x: F.trim(x["company_name"]) == F.trim("company_name")), F.lit(0))
    # What stands between the company's name and the next one's.
    parts = F.filter(F.split(F.col(answer), r'"company_name"\s*:\s*'), lambda p: F.startswith(p, F.concat(F.lit('"'), F.trim("company_name"), F.lit('"'))))
    own = F.get(parts, F.lit(0))
    field = lambda name: F.coalesce(mine[name], F.nullif(F.regexp_extract(own, rf'"{name}"\s*:\s*"(https?:[^"]+)"', 1), F.lit("")))
    return companies.select("*", field("ats_url").alias("found_ats_url"), field("career_url").alias("found_career_url"))
