"""From raw postings to the unified table, and from a model's answers to enriched records."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyforge.functions import ids, lang, text
from tallyforge.functions.salvage import mean_confidence, salvaged_json
from tallyforge.operators.dml import latest_per_key, merge_upsert
from tallyforge.operators.incremental import across_sources
from tallyforge.plans.mart import half_up
from tallyforge.sources.platforms import unified

SCORED = ("job_id", "company_id", "job_title_clean", "job_description_clean", "company_name_clean", "location_standardized", "job_url", "date_posted", "employment_status", "department")

#: What an answer holds; every section also has a confidence.
SECTIONS = {
    "salary_info": "salary_min bigint, salary_max bigint, salary_currency string, salary_period string, salary_type string, equity_mentioned boolean, bonus_mentioned boolean",
    "experience_requirements": "min_years_experience bigint, max_years_experience bigint, experience_level string, specific_technologies_years map<string,double>, education_requirements array<string>, certifications array<string>",
    "skills": "technical_skills array<string>, soft_skills array<string>",
    "work_arrangement": "work_type string, remote_flexibility string, travel_requirements string, office_locations array<string>, timezone_requirements string",
    "job_classification": "job_family string, job_sub_family string, seniority_level string, primary_keywords array<string>, industry_keywords array<string>, role_type string, team_size string",
}
CONFIDENCES = {"salary_info": "salary_confidence", "experience_requirements": "experience_confidence", "skills": "skills_confidence", "work_arrangement": "work_arrangement_confidence", "job_classification": "classification_confidence"}
ANSWER = "struct<" + ", ".join(f"{s}: struct<{', '.join(':'.join(f.strip().split(' ', 1)) for f in fields.split(', '))}, confidence: double>" for s, fields in SECTIONS.items()) + ">"
REVIEW_BELOW = 0.6


def stage(raw: DataFrame, platform: str, companies: DataFrame, as_of: Column) -> DataFrame:
    """Unified postings of one board: cleaned, with language, id and completeness; the latest retrieval of each id.

    companies: (company_id, company_name), one row per id. Ids are of the unified fields,
    so a posting keeps its id over runs.
    """
    u = unified(raw, platform).join(companies.select("company_id", "company_name"), "company_id", "left")
    u = u.select("*", text.job_title(F.col("job_title")).alias("job_title_clean"), text.description(F.col("job_description")).alias("job_description_clean"), text.company_name(F.col("company_name")).alias("company_name_clean"), text.location(F.col("location"))["standardized"].alias("location_standardized"))
    hits = {f"_hits_{c}": lang.pattern_hits(F.col(c)) for c in ("job_title_clean", "job_description_clean")}
    answers = [lang.language_of(F.col(c), F.col(f"_hits_{c}")) for c in ("job_title_clean", "job_description_clean")]
    u = u.withColumns(hits).withColumns({"_t": answers[0], "_b": answers[1]})
    # Title and body together are asked only where neither is sure by itself.
    unsure = (F.col("_t.confidence") < lang.THRESHOLD) & (F.col("_b.confidence") < lang.THRESHOLD)
    u = u.withColumn("_both", F.when(unsure, F.concat("job_title_clean", F.lit(" "), "job_description_clean")))
    u = u.withColumn("_hits_both", lang.pattern_hits(F.col("_both"))).withColumn("_c", lang.language_of(F.col("_both"), F.col("_hits_both")))
    u = u.withColumn("_l", lang.of_fields(F.col("_t"), F.col("_b"), F.col("_c")))
    filled = sum((F.coalesce(F.col(c).cast("string") != "", F.lit(False)).cast("int") for c in SCORED), F.lit(0))
    u = u.select(
        ids.job_uid(F.col("job_id"), F.col("platform"), F.col("company_id"), F.date_format("date_posted", "yyyy-MM-dd")).alias("job_uid"), "job_id", "company_id", "platform", "job_title_clean",
        "job_description_clean", "company_name_clean", "location_standardized", "job_url", "date_posted", "date_retrieved", "is_active", "employment_status", "department",
        F.col("_l.lang").alias("detected_language"), half_up(F.col("_l.confidence")).alias("language_confidence"), F.col("_l.is_english").alias("is_english"), "platform_specific_data",
        half_up(filled / len(SCORED)).alias("data_quality_score"), "source_raw_table", as_of.cast("date").alias("partition_date"),
    )
    return latest_per_key(u, ["job_uid"], [F.desc_nulls_last("date_retrieved"), F.asc("job_title_clean"), F.asc("job_description_clean"), F.asc("location_standardized")])


def unify(raws: dict[str, DataFrame], companies: DataFrame, old: DataFrame, as_of: Column) -> DataFrame:
    """The unified table after a run: each board staged, merged into old by id, and of a posting that several boards have the earliest retrieval, then the first board by name.

    Postings are the same if their job_id is; those without one all stay.
    """
    staged = reduce(DataFrame.unionByName, [stage(df, platform, companies, as_of).select(*old.columns) for platform, df in sorted(raws.items())])
    return across_sources(merge_upsert(old, latest_per_key(staged, ["job_uid"], [F.desc_nulls_last("date_retrieved"), F.asc("platform")]), ["job_uid"]), "job_id", ["date_retrieved", "platform", "job_uid"])


def enriched(answers: DataFrame, key: str, js: str) -> DataFrame:
    """Records from JSON answers (salvaged): all sections flattened, currency USD where unsaid, mean confidence, review flag. Answers that aren't JSON are left out."""
    a = answers.select(key, F.col(js).alias("_js")).filter("_js is not null")
    a = a.withColumns({"_a": F.from_json("_js", ANSWER), "llm_overall_confidence": mean_confidence(F.col("_js"))})
    cols: list[Column] = []
    for s, fields in SECTIONS.items():
        for f in fields.split(", "):
            name = f.strip().split(" ", 1)[0]
            c = F.col(f"_a.{s}.{name}")
            default = {"salary_currency": F.lit("USD"), "equity_mentioned": F.lit(False), "bonus_mentioned": F.lit(False)}.get(name)
            cols.append((F.coalesce(c, default) if default is not None else c).alias(name))
        cols.append(F.coalesce(F.col(f"_a.{s}.confidence"), F.lit(0.0)).alias(CONFIDENCES[s]))
    return a.select(key, *cols, "llm_overall_confidence", (F.col("llm_overall_confidence") < REVIEW_BELOW).alias("llm_needs_manual_review"), F.lit("pending").alias("validation_status"))


def rule_answers(jobs: DataFrame, key: str, title: str, body: str) -> DataFrame:
    """(key, answer): the built-in extractor, rules only and in the JVM: years asked for, work type, seniority."""
    b, t = F.lower(F.coalesce(body, F.lit(""))), F.lower(F.coalesce(title, F.lit("")))
    number = lambda p: F.nullif(F.regexp_extract(b, p, 1), F.lit("")).try_cast("bigint")
    years = F.coalesce(number(r"(\d{1,2})\+?\s*(?:-\s*\d{1,2}\s*)?years"), F.floor(number(r"(\d{1,3}) months of practice") / 12).cast("bigint"))
    work = F.when(b.rlike(r"\bhybrid\b"), "Hybrid").when(b.rlike(r"\bremote(?:ly)?\b"), "Remote").when(b.rlike(r"\bon[- ]site\b"), "On-site")
    level = F.coalesce(*[F.when(t.rlike(rf"\b{w}\b"), v) for w, v in (("trainee", "Entry"), ("junior", "Entry"), ("senior", "Senior"), ("staff", "Staff"), ("lead", "Senior"))])
    conf = lambda c: F.when(c.isNotNull(), 0.7).otherwise(0.0).alias("confidence")
    answer = F.to_json(F.struct(
        F.struct(F.lit(0.0).alias("confidence")).alias("salary_info"), F.struct(years.alias("min_years_experience"), conf(years)).alias("experience_requirements"),
        F.struct(F.lit(0.0).alias("confidence")).alias("skills"), F.struct(work.alias("work_type"), conf(work)).alias("work_arrangement"), F.struct(level.alias("seniority_level"), conf(level)).alias("job_classification"),
    ))
    return jobs.select(key, answer.alias("answer"))


def model_answers(jobs: DataFrame, key: str, body: str, make_model: Callable[[], Callable[[str], str]], retries: int = 2) -> DataFrame:
    """(key, answer, error): a model asked once per text, in Arrow batches; made once per task, so that its resources are let go with the task.

    A text that fails after the retries has a null answer and its error, and doesn't stop the others.
    """
    kind = dict(jobs.dtypes)[key]

    def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = make_model()
        for b in batches:
            out = []
            for k, t in zip(b.iloc[:, 0], b.iloc[:, 1], strict=True):
                answer, error = None, None
                for _ in range(retries + 1):
                    try:
                        answer, error = model(t), None
                        break
                    except Exception as e:  # noqa: BLE001
                        error = f"{type(e).__name__}: {e}"
                out.append((k, answer, error))
            yield pd.DataFrame(out, columns=[key, "answer", "error"])

    prompt = jobs.select(key, text.prompt_text(F.col(body)).alias("_text"))
    return prompt.mapInPandas(ask, f"{key} {kind}, answer string, error string")


def salvaged(answers: DataFrame, column: str = "answer") -> DataFrame:
    return answers.withColumn(column, salvaged_json(F.col(column)))
