"""Search over postings: a request becomes a Column predicate and a score; no text of the request ever becomes SQL."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyforge.functions.predicates import all_of, any_of, has_word, in_list, mentions, remote_or_place

# Weights of keywords, titles, places and quality in the three scores.
WEIGHTS = {"basic": (0.5, 0.3, 0.2, 0.0), "stage": (0.4, 0.3, 0.2, 0.1), "advanced": (0.6, 0.25, 0.15, 0.0)}
LANGUAGE_BOOST, BOOST_ABOVE = 1.05, 0.9


@dataclass(frozen=True)
class SearchRequest:
    """What to look for. Empty lists and None don't filter.

    skills and skill_categories are alternatives of one another. free_text stands in any of
    title, company, place and body. days_back counts from as_of. titles_or_terms takes postings
    that match the titles or the terms, as some services do, in place of both.

    legacy_limit ranks and cuts before the least relevance is asked for, as some search
    services do; otherwise relevance filters first and the limit counts what is left.
    """

    keywords: Sequence[str] = ()
    all_terms: Sequence[str] = ()
    titles: Sequence[str] = ()
    locations: Sequence[str] = ()
    remote: bool | None = None
    exclude: Sequence[str] = ()
    exclude_in_body: bool = True
    platforms: Sequence[str] = ()
    skills: Sequence[str] = ()
    skill_categories: Sequence[str] = ()
    exclude_skills: Sequence[str] = ()
    exclude_skill_categories: Sequence[str] = ()
    structured_keywords: Sequence[str] = ()
    exclude_structured_keywords: Sequence[str] = ()
    work_types: Sequence[str] = ()
    role_types: Sequence[str] = ()
    free_text: str | None = None
    employment: Sequence[str] = ()
    posted_from: dt.date | None = None
    posted_to: dt.date | None = None
    days_back: int | None = None
    as_of: dt.date | None = None
    least_quality: float | None = None
    least_language_confidence: float | None = None
    english_only: bool = False
    least_relevance: float = 0.0
    score: str = "stage"
    max_results: int | None = None
    offset: int = 0
    legacy_limit: bool = False
    titles_or_terms: bool = False
    columns: dict[str, str] = field(default_factory=dict)

    def col(self, name: str) -> Column:
        """The column that holds a role: title, body, location, company, platform, posted, quality, language_confidence, english, employment, work_type, role_type, and the lists skills_csv, categories_csv, keywords_csv."""
        return F.col(self.columns.get(name, name))

    def has(self, df: DataFrame, name: str) -> bool:
        return self.columns.get(name, name) in df.columns


def predicate(r: SearchRequest, df: DataFrame) -> Column:
    title, body, place = r.col("title"), r.col("body"), r.col("location")
    parts: list[Column] = []
    terms: list[Column] = []
    if r.keywords:
        terms.append(any_of([mentions([title, body], k) for k in r.keywords]))
    if r.all_terms:
        terms.append(all_of([mentions([title, body], k) for k in r.all_terms]))
    titles = [any_of([has_word(title, t) for t in r.titles])] if r.titles else []
    parts += [any_of([all_of(terms), *titles])] if r.titles_or_terms and terms and titles else [*terms, *titles]
    if r.free_text:
        parts.append(mentions([title, r.col("company"), place, body], r.free_text))
    if r.locations or r.remote is not None:
        parts.append(remote_or_place(place, r.remote, r.locations))
    for x in r.exclude:
        parts.append(~mentions([title, body] if r.exclude_in_body else [title], x))
    if r.platforms:
        parts.append(F.lower(r.col("platform")).isin(*[p.lower() for p in r.platforms]))
    if r.skills or r.skill_categories:
        parts.append(any_of([*[in_list(r.col("skills_csv"), s) for s in r.skills], *[in_list(r.col("categories_csv"), s) for s in r.skill_categories]]))
    for role, wanted, sign in (("keywords_csv", r.structured_keywords, True), ("skills_csv", r.exclude_skills, False), ("categories_csv", r.exclude_skill_categories, False), ("keywords_csv", r.exclude_structured_keywords, False)):
        if wanted:
            found = any_of([in_list(r.col(role), x) for x in wanted])
            parts.append(found if sign else ~found)
    for role, wanted in (("work_type", r.work_types), ("role_type", r.role_types)):
        if wanted:
            parts.append(F.lower(r.col(role)).isin(*[x.lower() for x in wanted]))
    if r.employment:
        parts.append(r.col("employment").isin(*r.employment))
    if r.posted_from:
        parts.append(r.col("posted") >= F.lit(r.posted_from))
    if r.days_back is not None:
        parts.append(r.col("posted") >= F.date_sub(F.current_date() if r.as_of is None else F.lit(r.as_of), r.days_back))
    if r.posted_to:
        parts.append(r.col("posted") <= F.lit(r.posted_to))
    if r.least_quality is not None:
        parts.append(r.col("quality") >= r.least_quality)
    if r.least_language_confidence is not None:
        parts.append(r.col("language_confidence") >= r.least_language_confidence)
    if r.english_only:
        parts.append(r.col("english"))
    return all_of([F.coalesce(p, F.lit(False)) for p in parts])


def relevance(r: SearchRequest, df: DataFrame) -> Column:
    """Share of matched terms per field, weighted, over the weights in play; 0 where nothing is asked for."""
    title, body, place = r.col("title"), r.col("body"), r.col("location")
    wk, wt, wl, wq = WEIGHTS[r.score]
    share = lambda hits: sum((h.cast("double") for h in hits), F.lit(0.0)) / len(hits)
    terms = [*r.keywords, *r.all_terms]
    parts, most = [], 0.0
    for w, hits in (
        (wk, [mentions([title, body], k) for k in terms]), (wt, [mentions([title], t) for t in r.titles]), (wl, [mentions([place], x) for x in r.locations]),
    ):
        if hits:
            parts.append(share(hits) * w)
            most += w
    if wq and r.has(df, "quality"):
        parts.append(F.coalesce(r.col("quality"), F.lit(0.0)) * wq)
        most += wq
    if not most:
        return F.lit(0.0)
    s = sum(parts[1:], parts[0]) / most
    if r.score == "stage" and r.has(df, "language_confidence"):
        s = F.when(r.col("language_confidence") > BOOST_ABOVE, F.least(F.lit(1.0), s * LANGUAGE_BOOST)).otherwise(s)
    return s


def search(df: DataFrame, r: SearchRequest) -> DataFrame:
    """The postings that match, with their relevance, best first."""
    hits = df.filter(predicate(r, df)).withColumn("relevance", relevance(r, df))
    by_quality = [F.desc_nulls_last(r.col("quality"))] if r.has(df, "quality") else []
    newest = [F.desc_nulls_last(r.col("posted"))] if r.has(df, "posted") else []
    order = [*by_quality, *newest] if r.legacy_limit else [F.desc("relevance"), *by_quality, *newest]
    tie = [F.asc(c) for c, t in df.dtypes if t in ("string", "bigint", "int", "date", "timestamp_ntz", "timestamp")]
    cut = lambda x: x if r.max_results is None else x.offset(r.offset).limit(r.max_results)
    keep = lambda x: x.filter(F.col("relevance") >= r.least_relevance) if r.least_relevance else x
    ranked = hits if r.legacy_limit else keep(hits)
    ranked = cut(ranked.orderBy(*order, *tie))
    return keep(ranked) if r.legacy_limit else ranked


def availability(spark: SparkSession, tables: dict[str, Callable[[], DataFrame]], least_rows: int = 1) -> DataFrame:
    """(name, there, n_rows, usable) of the tables that a search needs; one that can't be read isn't there."""
    parts = []
    for name, build in tables.items():
        try:
            parts.append(build().agg(F.lit(name).alias("name"), F.lit(True).alias("there"), F.count("*").alias("n_rows")))
        except AnalysisException:
            parts.append(spark.range(1).select(F.lit(name).alias("name"), F.lit(False).alias("there"), F.lit(0).cast("long").alias("n_rows")))
    return reduce(DataFrame.unionByName, parts).withColumn("usable", F.col("there") & (F.col("n_rows") >= least_rows))


def resolve_keywords(known: DataFrame, include: Sequence[str], exclude: Sequence[str]) -> DataFrame:
    """Known keywords (column keyword) that are included and not excluded, whatever their case."""
    k = known.select("keyword").distinct()
    low = F.lower(F.trim("keyword"))
    if include:
        k = k.filter(low.isin(*[x.lower().strip() for x in include]))
    return k.filter(~low.isin(*[x.lower().strip() for x in exclude])) if exclude else k


def shaped(df: DataFrame, gates: dict[str, tuple[str, float, Sequence[str]]], list_cap: int = 10) -> DataFrame:
    """Enriched fields as structs that are null below their confidence: gates maps a name to (confidence, least, fields). Arrays show their first list_cap items."""
    kinds = dict(df.dtypes)
    show = lambda c: (F.slice(c, 1, list_cap) if kinds[c].startswith("array") else F.col(c)).alias(c)
    return df.withColumns({name: F.when(F.col(conf) >= least, F.struct(*[show(f) for f in fields])) for name, (conf, least, fields) in gates.items()})


def result_metrics(df: DataFrame, quality: str = "quality", uid: str = "uid") -> DataFrame:
    """One row about a result: size, mean quality, quality bands, repeated ids."""
    q = F.col(quality)
    return df.agg(
        F.count("*").alias("total"), F.avg(q).alias("mean_quality"), F.count_if(q > 0.8).alias("high"), F.count_if(q.between(0.5, 0.8)).alias("medium"),
        F.count_if(q < 0.5).alias("low"), (F.count("*") - F.count_distinct(uid)).alias("repeated"),
    )


def language_counts(df: DataFrame, lang: str = "detected_language") -> DataFrame:
    """(lang, n) of a result; 'none' without a language."""
    return df.groupBy(F.coalesce(lang, F.lit("none")).alias("lang")).agg(F.count("*").alias("n"))
