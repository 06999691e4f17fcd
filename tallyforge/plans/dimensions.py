"""Dimensions of the star schema and the denormalised serving tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyforge.operators.dml import keep_keys, merge_if_changed

# Gates, ranks of seniority in the order in which they are tried, words of management.
LEAST_CONFIDENCE = 0.5
SENIORITY = (("trainee", 1), ("entry", 1), ("junior", 2), ("associate", 2), ("mid", 3), ("senior", 4), ("staff", 5), ("lead", 5), ("deputy", 5), ("interim", 5), ("director", 6), ("vp", 7))
MANAGEMENT = ("lead", "manager", "director", "head", "vp", "chief", "deputy")


def gated(df: DataFrame, confidence: str, flag: Column | None = None) -> DataFrame:
    """Rows of enough confidence that aren't under review."""
    g = df.filter(F.col(confidence) >= LEAST_CONFIDENCE)
    return g if flag is None else g.filter(~F.coalesce(flag, F.lit(False)))


def job_family_dimension(df: DataFrame) -> DataFrame:
    """Distinct (family, seniority, work type) with a hashed key, a rank of seniority and a management flag."""
    low = F.lower(F.coalesce("seniority_level", F.lit("")))
    order = F.coalesce(*[F.when(F.contains(low, F.lit(w)), F.lit(n)) for w, n in SENIORITY], F.lit(3))
    manages = F.lit(False)
    for w in MANAGEMENT:
        manages = manages | F.contains(low, F.lit(w))
    key = F.concat(F.lit("JF_"), F.md5(F.concat_ws("|", *[F.coalesce(c, F.lit("~")) for c in ("job_family", "seniority_level", "work_type")])))
    d = df.select("job_family", "seniority_level", "work_type").distinct()
    return d.select(key.alias("job_family_key"), "*", order.alias("seniority_order"), manages.alias("is_management"))


def platform_dimension(df: DataFrame, as_of: Column) -> DataFrame:
    """Per platform: postings, disclosure of pay, richness, volume class, activity: df (platform, posted, has_pay, richness)."""
    g = df.groupBy("platform").agg(F.count("*").alias("postings"), F.avg(F.col("has_pay").cast("int")).alias("pay_share"), F.avg("richness").alias("richness"), F.max("posted").alias("last_posted"))
    clamp = F.when(F.col("richness").isNull(), None).otherwise(F.least(F.greatest(F.col("richness"), F.lit(0.0)), F.lit(1.0)))
    volume = F.when(F.col("postings") >= 1000, "High").when(F.col("postings") >= 100, "Medium").otherwise("Low")
    return g.select("platform", "postings", (F.col("pay_share") >= 0.1).alias("discloses_pay"), clamp.alias("richness"), volume.alias("volume"), (F.datediff(as_of, F.col("last_posted")) <= 30).alias("is_active"))


def denorm_list(df: DataFrame, group: list[str], item: str) -> DataFrame:
    """Per group its items as one sorted text and their number."""
    return df.groupBy(*group).agg(F.array_join(F.array_sort(F.collect_set(item)), ", ").alias("items"), F.count_distinct(item).alias("n_items"))


def refresh_denorm(old: DataFrame, new: DataFrame, keys: list[str], compare: list[str]) -> DataFrame:
    """The serving table after a run: changed rows replaced, vanished keys pruned."""
    return keep_keys(merge_if_changed(old, new, keys, compare), new, keys)


def denorm_postings(facts: DataFrame, skills: DataFrame, keywords: DataFrame) -> DataFrame:
    """One row per posting with its lists: skills (posting_id, skill, category), keywords (posting_id, keyword).

    Lists are put together per posting before the join, so that nothing fans out.
    """
    lists = lambda df, c, name: df.groupBy("posting_id").agg(F.array_join(F.array_sort(F.collect_set(c)), ", ").alias(name))
    out = facts.join(lists(skills, "skill", "skills"), "posting_id", "left").join(lists(skills, "category", "skill_categories"), "posting_id", "left")
    return out.join(lists(keywords, "keyword", "keywords"), "posting_id", "left")
