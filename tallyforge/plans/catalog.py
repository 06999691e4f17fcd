"""Named jobs: which queries belong together and with which search, and when they are due."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from zoneinfo import ZoneInfo

from tallyforge.search.request import SearchRequest

PARTITIONS = (*"ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0-9", "other")
BOARDS = ("bamboohr", "greenhouse", "workday", "smartrecruiters")
COLUMNS = {"title": "job_title", "body": "job_description", "posted": "posted_date"}


@dataclass(frozen=True)
class Job:
    """Queries by name, in their order; a search comes last. A partitioned job runs once for each slice of companies."""

    name: str
    steps: Sequence[str]
    search: SearchRequest | None = None
    partitioned: bool = False


_STAGE = ("jobs_unified_boards", "jobs_english", "jobs_recent", "jobs_with_salary")
_ENRICH = ("work_selection", "rule_extraction", "enriched_records")
_NORMALISE = ("skills_normalized", "job_skills_bridge", "keywords_normalized_master", "job_keywords_bridge_built", "locations_normalized", "job_locations_bridge_by_names", "experience_normalized", "job_experience_bridge", "salary_normalized_master", "salary_bridge_status")
_DIMENSIONS = ("company_scd2_apply", "date_dimension", "location_dimension_gated", "job_family_dimension", "platform_dimension", "skills_dimension", "experience_dimension", "salary_dimension", "keyword_dimension")
_FACTS = ("posting_fact", "experience_bridge_primary", "keywords_bridge_weighted", "skills_bridge_weighted", "skills_demand_weekly", "company_hiring_weekly", "market_weekly_summary", "skills_trend_by_form")
_SERVE = ("denorm_skills_refresh", "denorm_keywords_refresh", "serving_postings_refresh", "skill_counts_refresh")
_QUALITY = ("validation_severity", "quality_metrics_history", "coverage_by_pay_band", "coverage_by_company_size", "confidence_buckets", "review_queue")
_DATA = SearchRequest(keywords=("data engineer", "analytics"), titles=("Engineer",), least_relevance=0.4, max_results=500, columns=COLUMNS)
_LEGAL = SearchRequest(keywords=("counsel", "legal"), titles=("Counsel",), least_relevance=0.4, max_results=500, columns=COLUMNS)

JOBS = {j.name: j for j in (
    Job("setup", ("provisioned_tables", "seed_script")), Job("company_profiles", ("company_profiles_stage",)), Job("company_urls", ("csv_glob_strict", "company_duplicates", "master_company_urls")),
    *[Job(f"discovery_{b}", ("new_files", "platform_mappings"), partitioned=True) for b in BOARDS], Job("discovery", ("new_files", "platform_mappings"), partitioned=True),
    Job("stage_postings", _STAGE), Job("stage_normalization", _NORMALISE), Job("stage_enriched", _ENRICH), Job("stage_enriched_unified", (*_ENRICH, "enrichment_stats")), Job("stage_quality", _QUALITY),
    Job("analytics_dimensions", _DIMENSIONS), Job("analytics_facts", _FACTS), Job("serve", _SERVE), Job("schema_drift", ("view_drift",)), Job("transport", ("upsert_by_job_and_company",)),
    Job("search_data", (), _DATA), Job("search_data_stage", ("availability_check",), _DATA), Job("search_legal", (), _LEGAL), Job("search_data_advanced", ("availability_check", "keyword_resolution"), _DATA), Job("search_legal_advanced", ("availability_check", "keyword_resolution"), _LEGAL),
    Job("discovery_search", ("new_files", "platform_mappings", *_STAGE), _DATA, partitioned=True), Job("discovery_enrichment_search", ("new_files", "platform_mappings", *_STAGE, *_ENRICH, *_NORMALISE, *_SERVE), _DATA, partitioned=True),
)}


@dataclass(frozen=True)
class Schedule:
    """A job's times: each hour, or each day at an hour, by the clock of a zone."""

    job: str
    hour: int | None
    zone: str = "UTC"

    def times(self, since: dt.datetime, until: dt.datetime) -> Iterator[dt.datetime]:
        """The times after since up to until (both with a zone). An hour that a change of clocks leaves out is skipped, one that it repeats comes once."""
        at = since.astimezone(dt.UTC).replace(minute=0, second=0, microsecond=0)
        seen: set[str] = set()
        while at <= until:
            local = at.astimezone(ZoneInfo(self.zone))
            key = local.strftime("%Y-%m-%d" if self.hour is not None else "%Y-%m-%d_%H")
            if at > since and (self.hour is None or local.hour == self.hour) and key not in seen:
                seen.add(key)
                yield local
            at += dt.timedelta(hours=1)


SCHEDULES = (Schedule("discovery_enrichment_search", 4, "US/Eastern"), Schedule("schema_drift", None))


def due(since: dt.datetime, until: dt.datetime, schedules: Sequence[Schedule] = SCHEDULES) -> list[tuple[str, str | None, str]]:
    """(job, partition, run key) of what became due; a key stands for one run, so that asking twice runs nothing twice."""
    out = []
    for s in schedules:
        for t in s.times(since, until):
            day = t.strftime("%Y-%m-%d" if s.hour is not None else "%Y-%m-%d_%H")
            parts = PARTITIONS if JOBS[s.job].partitioned else (None,)
            out += [(s.job, p, f"{s.job}_{day}" if p is None else f"{s.job}_{p}_{day}") for p in parts]
    return out
