"""Normalising extracted skills, keywords, places, experience and pay to master tables and bridges.

Ids are hashes of natural keys, so reruns agree and no numbering over all rows is needed.
Rule and reference tables are small; joins with them are left to Spark's size check.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyforge.functions.fold import fold
from tallyforge.functions.ids import surrogate_id
from tallyforge.functions.predicates import not_placeholder
from tallyforge.operators.dml import latest_per_key
from tallyforge.operators.joins import any_key
from tallyforge.session import small_or_shuffled

# Confidences, limits of frequency and trend, periods per year, pay outside which a salary is an outlier.
TAXONOMY_HIT, TAXONOMY_MISS, REVIEW_BELOW = 1.0, 0.5, 0.5
TRENDS = ((100, 1.0), (50, 0.7), (10, 0.5))
LEAST_TREND = 0.3
PER_YEAR = {"hour": 2080, "hourly": 2080, "week": 52, "weekly": 52, "month": 12, "monthly": 12, "year": 1, "yearly": 1, "annual": 1, "annually": 1}
USD_NAMES = ("usd", "us$", "$", "us dollar", "us dollars")
OUTLIER_ABOVE, OUTLIER_BELOW, OUTLIER_RATIO = 2_000_000, 15_000, 3
AI_WORDS = ("ai %", "% ai", "ai-%")
ARRANGEMENTS = (("On-site", "on_site"), ("Hybrid", "hybrid"), ("Flexible", "flexible"))
PLACE_EXTRACTION = 0.9
STATED_ABOVE = 1_000_000
TECH_ROWS = "array<struct<source:string,kind:string,value:string,original_text:string,technology:string>>"


def trend_score(frequency: Column) -> Column:
    return F.coalesce(*[F.when(frequency >= n, F.lit(s)) for n, s in TRENDS], F.lit(LEAST_TREND))


def extracted(df: DataFrame, key: str, lists: dict[str, str], scalars: dict[str, str] | None = None) -> DataFrame:
    """(key, raw, source): the values of array and scalar columns in one list, in lower case, placeholders left out."""
    from_ = lambda c, source: F.transform(F.coalesce(F.col(c), F.array()), lambda x: F.struct(x.alias("v"), F.lit(source).alias("source")))
    arrays = [from_(c, source) for c, source in lists.items()]
    singles = [F.array(F.struct(F.col(c).alias("v"), F.lit(source).alias("source"))) for c, source in (scalars or {}).items()]
    x = df.select(key, F.explode(F.concat(*arrays, *singles)).alias("x")).select(key, "x.v", "x.source").filter("v is not null")
    return x.filter(not_placeholder(F.col("v"))).select(key, F.lower(F.trim("v")).alias("raw"), "source")


def skills_extraction(df: DataFrame, key: str, lists: dict[str, str], taxonomy: DataFrame) -> DataFrame:
    """Extracted skills with their taxonomy entry (taxonomy: name, category, latest). A skill that meets stale entries only is dropped."""
    t = taxonomy.select(F.lower("name").alias("raw"), "category", "latest")
    j = extracted(df, key, lists).join(t, "raw", "left").filter(F.col("latest").isNull() | F.col("latest"))
    return j.select(key, "raw", "source", "category", F.when(F.col("latest"), TAXONOMY_HIT).otherwise(TAXONOMY_MISS).alias("match_confidence")).distinct()


def skills_master(raw: DataFrame, key: str, manual: DataFrame) -> DataFrame:
    """One row per skill: category by taxonomy, then manual mapping (raw, manual_category, manual_confidence), then 'Unknown'."""
    j = raw.join(manual, "raw", "left").withColumn("category", F.coalesce("category", "manual_category", F.lit("Unknown")))
    g = j.groupBy("raw", "category").agg(
        F.count_distinct(key).alias("frequency"), F.array_sort(F.collect_set("source")).alias("sources"), F.avg(F.coalesce("manual_confidence", "match_confidence")).alias("confidence")
    )
    return g.select(surrogate_id("SK_", F.col("raw"), F.col("category")).alias("skill_id"), F.col("raw").alias("skill"), "category", "frequency", "sources", "confidence", (F.col("confidence") < REVIEW_BELOW).alias("needs_review"))


def skills_bridge(raw: DataFrame, key: str, master: DataFrame, extraction: DataFrame) -> DataFrame:
    """(key, skill_id, context, overall): mean of the extraction's (key, extraction_confidence) and the skill's confidence."""
    j = raw.join(master.select(F.col("skill").alias("raw"), "skill_id", "confidence"), "raw").join(extraction, key)
    context = F.when(F.col("source") == "technical", "required").otherwise("preferred")
    return j.select(key, "skill_id", context.alias("context"), ((F.col("extraction_confidence") + F.col("confidence")) / 2).alias("overall")).distinct()


def keywords_master(raw: DataFrame, key: str, rules: DataFrame, types: DataFrame) -> DataFrame:
    """Keywords by rule text, else as they are; category by rule, by type mapping or by the words for AI; with trend and approval.

    rules: (pattern, standard, rule_type, rule_category, rule_confidence); types: (keyword, type, type_category, type_confidence).
    """
    j = raw.join(rules.withColumn("raw", F.lower("pattern")), "raw", "left")
    j = j.withColumn("keyword", F.coalesce(F.lower("standard"), "raw")).join(types.withColumn("keyword", F.lower("keyword")), "keyword", "left")
    ai = F.lit(False)
    for w in AI_WORDS:
        ai = ai | F.col("keyword").ilike(w)
    category = F.when(ai, "AI").otherwise(F.coalesce("rule_category", "type_category", F.lit("General")))
    j = j.select(key, "keyword", category.alias("category"), F.coalesce("rule_type", "type", "source").alias("type"), F.coalesce("rule_confidence", "type_confidence", F.lit(0.5)).alias("c"))
    g = j.groupBy("keyword", "category", "type").agg(F.count_distinct(key).alias("frequency"), F.avg("c").alias("confidence"))
    return g.select(surrogate_id("KW_", F.col("keyword"), F.col("category"), F.col("type")).alias("keyword_id"), "*", trend_score(F.col("frequency")).alias("trend"), (F.col("confidence") >= 0.5).alias("approved"))


def keywords_bridge(raw: DataFrame, key: str, rules: DataFrame, master: DataFrame) -> DataFrame:
    """(key, keyword_id, how): keywords that a rule maps, and those found by their own name."""
    r = rules.select(F.lower("pattern").alias("raw"), F.lower("standard").alias("keyword"))
    m = master.select("keyword", "keyword_id")
    by_rule = raw.join(r, "raw").join(m, "keyword").select(key, "keyword_id", F.lit("rule").alias("how"))
    by_name = raw.join(r, "raw", "left_anti").withColumn("keyword", F.col("raw")).join(m, "keyword").select(key, "keyword_id", F.lit("name").alias("how"))
    return by_rule.unionByName(by_name).distinct()


def places_master(raw: DataFrame, key: str, states: DataFrame, countries: DataFrame) -> DataFrame:
    """Places taken apart at commas: state by code or name, country only where that is no state; with kind and review flag.

    raw: (key, place); states: (code, state); countries: (country).
    """
    p = raw.withColumn("folded", fold(F.trim("place")))
    part = lambda n: F.nullif(F.trim(F.split_part("place", F.lit(","), F.lit(n))), F.lit(""))
    p = p.withColumns({"city": part(1), "second": part(2), "third": part(3)})
    by_code = states.select(F.lower("code").alias("second_key"), F.col("state").alias("state_by_code"))
    by_name = states.select(F.lower("state").alias("second_key"), F.col("state").alias("state_by_name"))
    p = p.withColumn("second_key", F.lower("second")).join(by_code, "second_key", "left").join(by_name, "second_key", "left")
    p = p.withColumn("state", F.coalesce("state_by_code", "state_by_name"))
    gate = F.lower(F.when(F.col("state").isNull(), F.coalesce("third", "second")).otherwise(F.col("third")))
    p = p.withColumn("country_key", gate).join(countries.select(F.lower("country").alias("country_key"), "country"), "country_key", "left")
    kind = F.when(F.contains("folded", F.lit("remote")), "remote").when(F.contains("folded", F.lit("hybrid")), "hybrid").otherwise("office")
    g = p.groupBy("folded", "city", "state", "country", kind.alias("kind")).agg(F.count_distinct(key).alias("frequency"), F.min("place").alias("variant"))
    sure = F.when(F.col("state").isNotNull() & F.col("country").isNotNull(), 0.95).when(F.col("state").isNotNull() | F.col("country").isNotNull(), 0.8).otherwise(0.4)
    return g.select(surrogate_id("LOC_", F.col("folded")).alias("location_id"), "*", sure.alias("confidence"), ((sure < 0.5) | (F.col("frequency") == 1)).alias("needs_review"))


def places_bridge(raw: DataFrame, master: DataFrame) -> DataFrame:
    """(left_id, right_id): rows (left_id, place) and master places that agree in the folded text, or in whose place the text stands as variant."""
    tag = lambda i, *c: F.concat(F.lit(f"{i}:"), F.concat_ws("|", *c))
    left = raw.select("left_id", "place", fold(F.trim("place")).alias("folded"))
    right = master.select(F.col("location_id").alias("right_id"), "variant", "folded")
    return any_key(left, right, [tag(0, F.col("folded")), tag(1, F.col("place"))], [tag(0, F.col("folded")), tag(1, F.col("variant"))])


def places_bridge_by_names(raw: DataFrame, master: DataFrame, enriched: DataFrame, threshold: float = 0.5) -> DataFrame:
    """One row per posting and place, with context, arrangement and confidence: raw (job_uid, raw, original, source), master (location_id, folded, name, variant, kind, confidence, needs_review), enriched (job_uid, work_type).

    The four alternatives are the folded raw text, the folded original, the original as
    variant and the original as name. A posting whose work type says nothing is remote if the
    place is, else on site.
    """
    left = raw.withColumn("left_id", F.struct("job_uid", "original", "source"))
    keys = [fold(F.trim("raw")), fold(F.trim("original")), F.lower("original"), F.lower("original")]
    tag = lambda cs: [F.concat(F.lit(f"{i}:"), c) for i, c in enumerate(cs)]
    met = any_key(left, master.withColumnRenamed("location_id", "right_id"), tag(keys), tag([F.col("folded"), F.col("folded"), F.lower("variant"), F.lower("name")]))
    met = met.select("left_id.*", F.col("right_id").alias("location_id")).join(master.select("location_id", "kind", "confidence", "needs_review"), "location_id").join(enriched.select("job_uid", "work_type"), "job_uid", "left")
    context = F.when(F.col("source") == "office_locations", "primary").when(F.col("source") == "location_standardized", "standard").when(F.col("source") == "headquarters", "secondary").otherwise("unknown")
    stated = F.coalesce(*[F.when(F.col("work_type") == t, a) for t, a in ARRANGEMENTS], F.when(F.col("kind") == "remote", "remote"), F.lit("on_site"))
    overall = (F.lit(PLACE_EXTRACTION) + F.col("confidence")) / 2
    return met.select("job_uid", "location_id", "source", "original", context.alias("location_context"), stated.alias("work_arrangement"), overall.alias("overall"), ((F.col("confidence") < threshold) | F.col("needs_review")).alias("needs_review"))


def places_located(master: DataFrame, metros: DataFrame, regions: DataFrame, hubs: DataFrame) -> DataFrame:
    """master with its metro area, region and whether it's a technology hub: metros (city, state, country, metro_area), regions (state, country, region), hubs (city, state, country, is_hub); only active rows of these, one per key."""
    out = master.join(metros, ["city", "state", "country"], "left").join(regions, ["state", "country"], "left").join(hubs, ["city", "state", "country"], "left")
    return out.withColumns({
        "metro_area": F.coalesce("metro_area", F.lit("Other")), "region": F.coalesce("region", F.lit("Other")), "is_hub": F.coalesce("is_hub", F.lit(False)),
        "is_remote_friendly": F.col("kind").isin("remote", "hybrid"),
    })


def parsing_lookup(states: DataFrame, countries: DataFrame) -> DataFrame:
    """(location_name, location_type, state, country): states (code, state, country) by code and by name, countries (country, country_code) likewise."""
    one = lambda df, name, kind, state, country: df.select(F.upper(name).alias("location_name"), F.lit(kind).alias("location_type"), state.alias("state"), country.alias("country"))
    none = F.lit(None).cast("string")
    parts = [one(states, c, "US_STATE", F.col("state"), F.col("country")) for c in ("code", "state")] + [one(countries, c, "COUNTRY", none, F.col("country")) for c in ("country", "country_code")]
    return reduce(DataFrame.unionByName, parts).filter("location_name is not null").distinct()


def experience_extraction(df: DataFrame) -> DataFrame:
    """Five kinds of statements in one list: df (job_uid, min_years_experience, max_years_experience, experience_level, seniority_level, technology_years map, confidence)."""
    says = lambda c: F.when((F.trim(c) != "") & ~F.lower(F.trim(c)).isin("null", "none", "n/a", "unknown"), F.col(c))
    years = lambda c: F.when(F.col(c) > 0, F.col(c).cast("string"))
    row = lambda source, kind, value, original, tech: F.struct(F.lit(source).alias("source"), F.lit(kind).alias("kind"), value.alias("value"), original.alias("original_text"), tech.alias("technology"))
    none = F.lit(None).cast("string")
    plain = [
        row("min_years", "general", years("min_years_experience"), years("min_years_experience"), none), row("max_years", "general", years("max_years_experience"), years("max_years_experience"), none),
        row("experience_level", "role_level", says("experience_level"), says("experience_level"), none), row("seniority_level", "role_level", says("seniority_level"), says("seniority_level"), none),
    ]
    number = lambda v: v.cast("string")
    tech = F.transform(F.map_entries("technology_years"), lambda e: row("specific_tech", "technology_specific", F.when(e["value"] > 0, number(e["value"])), F.concat(e["key"], F.lit(": "), number(e["value"]), F.lit(" years")), e["key"]))
    return df.select("job_uid", "confidence", F.explode(F.concat(F.array(*plain), F.coalesce(tech, F.array().cast(TECH_ROWS)))).alias("x")).select("job_uid", "confidence", "x.*").filter("value is not null")


def experience_technologies(extracted: DataFrame) -> DataFrame:
    """Per technology the least and most years asked for, how many postings ask, and the mean confidence."""
    t = extracted.filter("kind = 'technology_specific'").withColumn("years", F.col("value").try_cast("double").cast("long")).filter("years > 0")
    name = F.concat(F.lit("EXP_TECH_"), F.upper(F.regexp_replace("technology", "[^A-Za-z0-9]", "_")))
    return t.groupBy(name.alias("experience_id"), "technology").agg(F.min("years").alias("low"), F.max("years").alias("high"), F.count_distinct("job_uid").alias("market_frequency"), F.avg("confidence").alias("confidence"))


def salary_statements(df: DataFrame) -> DataFrame:
    """Pay as stated: either side above 0 and the sides different, with completeness and a first flag for outliers."""
    zero = lambda c: F.coalesce(c, F.lit(0))
    s = df.filter((F.col("salary_min").isNotNull() | F.col("salary_max").isNotNull()) & ((zero("salary_min") > 0) | (zero("salary_max") > 0)) & (zero("salary_min") != zero("salary_max")))
    kind = F.when(F.col("salary_min").isNotNull() & F.col("salary_max").isNotNull(), "complete_range").when(F.col("salary_min").isNotNull(), "min_only").otherwise("max_only")
    far = F.coalesce((F.greatest("salary_min", "salary_max") > STATED_ABOVE) | (F.least("salary_min", "salary_max") < 1), F.lit(False))
    return s.select("job_uid", "salary_min", "salary_max", F.coalesce(F.lower(F.trim("salary_period")), F.lit("unknown")).alias("period"), F.coalesce(F.upper(F.trim("salary_currency")), F.lit("USD")).alias("currency"), kind.alias("completeness"), far.alias("potential_outlier"))


def skill_mappings(orphans: DataFrame, answers: DataFrame, known: DataFrame) -> DataFrame:
    """known (skill, category, confidence) with the rows that answers (JSON lists of such objects in column answer) give for orphans (raw); a skill that is known or isn't asked for adds nothing, the surest answer counts."""
    rows = answers.select(F.inline(F.from_json("answer", "array<struct<skill:string,category:string,confidence:double>>")))
    rows = rows.withColumn("skill", F.lower(F.trim("skill"))).join(orphans.select(F.col("raw").alias("skill")).distinct(), "skill", "left_semi").join(known.select("skill"), "skill", "left_anti")
    return known.unionByName(latest_per_key(rows, ["skill"], [F.desc_nulls_last("confidence"), F.asc("category")]).select(*known.columns))


def duplicate_companies(df: DataFrame, order: Sequence[Column]) -> DataFrame:
    """One record per company id with what its duplicates are: 'single', 'legitimate' (one name and platform), 'variation' (they differ in case or outer blanks only) or 'collision' (in more)."""
    pair = lambda *c: F.concat_ws("|", *c)
    kinds = df.groupBy("company_id").agg(
        F.count("*").alias("n"), F.count_distinct(pair(F.coalesce("company_name", F.lit("")), F.coalesce("platform", F.lit("")))).alias("typed"),
        F.count_distinct(pair(F.trim(F.upper(F.coalesce("company_name", F.lit("")))), F.trim(F.upper(F.coalesce("platform", F.lit("")))))).alias("pairs"),
    )
    kind = F.when(F.col("n") == 1, "single").when(F.col("typed") == 1, "legitimate").when(F.col("pairs") == 1, "variation").otherwise("collision")
    return latest_per_key(df, ["company_id"], order).join(kinds.select("company_id", "n", kind.alias("duplicate_kind")), "company_id")


def salary_extraction(df: DataFrame) -> DataFrame:
    """Pay rows in dollars with a completeness class; ranges of one value are no ranges and left out."""
    s = df.filter(F.lower(F.trim("salary_currency")).isin(*USD_NAMES) & (F.col("salary_min").isNotNull() | F.col("salary_max").isNotNull()))
    s = s.filter(~F.coalesce(F.col("salary_min") == F.col("salary_max"), F.lit(False)))
    kind = F.when(F.col("salary_min").isNotNull() & F.col("salary_max").isNotNull(), "both").when(F.col("salary_min").isNotNull(), "min_only").otherwise("max_only")
    return s.withColumns({"completeness": kind, "period": F.lower(F.trim("salary_period"))})


def salary_master(raw: DataFrame) -> DataFrame:
    """Distinct ranges per year in dollars with outlier flag, confidence, review flag, name and market percentile."""
    factor = F.element_at(F.create_map(*[F.lit(x) for kv in PER_YEAR.items() for x in kv]), F.col("period"))
    lo, hi = F.coalesce("salary_min", "salary_max"), F.coalesce("salary_max", "salary_min")
    g = raw.groupBy("salary_min", "salary_max", "period").agg(F.count_distinct("job_uid").alias("frequency"))
    g = g.withColumns({"factor": factor, "lo": (lo * F.coalesce(factor, F.lit(1))).cast("long"), "hi": (hi * F.coalesce(factor, F.lit(1))).cast("long")})
    outlier = (F.col("hi") > OUTLIER_ABOVE) | (F.col("lo") < OUTLIER_BELOW) | F.coalesce(F.try_divide(F.col("hi"), F.col("lo")) > OUTLIER_RATIO, F.lit(False))
    base = F.when(F.col("factor") == 1, 1.0).when(F.col("factor").isin(2080, 12), 0.9).when(F.col("factor") == 52, 0.7).otherwise(0.5)
    g = g.withColumns({"outlier": outlier, "confidence": base * F.when(outlier, 0.5).otherwise(1.0)})
    name = F.concat(F.lit("$"), F.floor(F.col("lo") / 1000).cast("string"), F.lit("K-$"), F.floor(F.col("hi") / 1000).cast("string"), F.lit("K Annual USD"))
    # The market percentile is a global rank over distinct ranges, by first and last rank within a value.
    per = g.groupBy("hi", "lo").agg(F.count("*").alias("n"))
    w = Window.orderBy((F.col("lo") + F.col("hi")) / 2)
    rank = per.groupBy("lo", "hi").agg(F.sum("n").alias("n")).withColumn("below", F.coalesce(F.sum("n").over(w.rangeBetween(Window.unboundedPreceding, Window.currentRow)) - F.sum("n").over(Window.partitionBy((F.col("lo") + F.col("hi")) / 2)), F.lit(0)))
    total = F.sum("n").over(Window.partitionBy())
    rank = rank.withColumn("percentile", F.coalesce(F.try_divide(F.col("below") * 100.0, total - 1), F.lit(0.0))).select("lo", "hi", "percentile")
    return g.join(rank, ["lo", "hi"]).select(
        surrogate_id("SAL_", F.col("salary_min"), F.col("salary_max"), F.col("period")).alias("salary_id"), "salary_min", "salary_max", "period", "lo", "hi",
        ((F.col("lo") + F.col("hi")) / 2).alias("midpoint"), "frequency", "outlier", "confidence", (outlier | (F.col("confidence") < 0.8)).alias("needs_review"),
        name.alias("name"), "percentile",
    )


def salary_bridge(raw: DataFrame, master: DataFrame, legacy_semantics: bool = False) -> DataFrame:
    """(job_uid, salary_id, overall, status): each pay row with its range. One-sided ranges meet too, unless legacy_semantics compares with =."""
    m = master.select("salary_id", "salary_min", "salary_max", "period", "confidence", "needs_review")
    same = (lambda a, b: a == b) if legacy_semantics else (lambda a, b: a.eqNullSafe(b))
    on = same(raw.salary_min, m.salary_min) & same(raw.salary_max, m.salary_max) & raw.period.eqNullSafe(m.period)
    status = F.when(m.needs_review, "needs_review").when(m.confidence >= 0.9, "validated").otherwise("pending")
    overall = m.confidence * F.when(raw.completeness == "both", 1.0).otherwise(0.8)
    return raw.join(m, on).select(raw.job_uid, "salary_id", overall.alias("overall"), status.alias("status")).distinct()


def experience_master(df: DataFrame, key: str, rules: DataFrame) -> DataFrame:
    """Rule bands (rule_id, low, high) with how many postings ask for them; bands overlap on purpose."""
    v = df.select(key, "min_years_experience").filter("min_years_experience is not null").distinct()
    # The rule table is a handful of bands; the values are reduced to counts per year first.
    per_year = v.groupBy("min_years_experience").agg(F.count("*").alias("n"))
    hits = per_year.join(small_or_shuffled(rules, 10_000), (F.col("min_years_experience") >= F.col("low")) & (F.col("min_years_experience") <= F.coalesce("high", F.lit(1e9))))
    counts = hits.groupBy("rule_id").agg(F.sum("n").alias("market_frequency"))
    return rules.join(counts, "rule_id", "left").fillna(0, ["market_frequency"])


def by_rules(df: DataFrame, key: str, column: str, rules: DataFrame) -> DataFrame:
    """(key, value, standard, confidence, how) by rules (pattern, standard): 'exact' 0.8, 'partial' 0.7 (the pattern is a run of words of the value), else the value itself, 0.5.

    Runs of as many words as some pattern has are joined by equality, and so are whole values,
    so that no rule is compared with every value; of several partial rules the longest, then the last standard by code point, holds.
    Null and blank values stay, without a standard.
    """
    v = df.select(key, F.col(column).alias("value"), F.lower(F.trim(F.col(column))).alias("low"))
    r = rules.groupBy(F.lower(F.trim("pattern")).alias("pattern")).agg(F.min("standard").alias("standard"))
    words = F.split("low", r"\s+")
    sizes = r.agg(F.collect_set(F.size(F.split("pattern", r"\s+"))).alias("sizes"))
    runs = F.flatten(F.transform("sizes", lambda n: F.transform(F.sequence(F.lit(1), F.greatest(F.size(words) - n + 1, F.lit(1))), lambda i: F.array_join(F.slice(words, i, n), " "))))
    part = v.select("low").distinct().crossJoin(F.broadcast(sizes)).select("low", F.explode(F.array_distinct(F.concat(F.array("low"), runs))).alias("pattern")).distinct().join(r, "pattern")
    best = part.groupBy("low").agg(F.max(F.struct((F.col("pattern") == F.col("low")).alias("exact"), F.length("pattern").alias("n"), "standard")).alias("b"))
    out = v.join(best, "low", "left")
    how = F.when(F.col("b").isNull(), "none").when(F.col("b.exact"), "exact").otherwise("partial")
    conf = F.when(how == "exact", 0.8).when(how == "partial", 0.7).otherwise(0.5)
    return out.select(key, "value", F.coalesce("b.standard", F.nullif(F.trim("value"), F.lit(""))).alias("standard"), conf.alias("confidence"), how.alias("how"))


def experience_bridge(df: DataFrame, key: str, rules: DataFrame, roles: dict[str, str]) -> DataFrame:
    """(key, rule_id, how): bands that hold the years asked for, technologies by name, and levels by the words of the seniority (roles: pattern to rule id).

    df has min_years_experience, seniority_level and technology_years, a map; a technology's
    id is TECH_ and its name.
    """
    years = df.select(key, "min_years_experience").filter("min_years_experience is not null")
    per_year = years.select("min_years_experience").distinct()
    # Distinct years and a rule table of a handful of bands: compared directly.
    bands = per_year.join(small_or_shuffled(rules, 10_000), (F.col("min_years_experience") >= F.col("low")) & (F.col("min_years_experience") <= F.coalesce("high", F.lit(1e9))))
    general = years.join(bands.select("min_years_experience", "rule_id"), "min_years_experience").select(key, "rule_id", F.lit("general").alias("how"))
    tech = df.select(key, F.explode("technology_years").alias("tech", "years")).select(key, F.concat(F.lit("TECH_"), F.upper("tech")).alias("rule_id"), F.lit("technology").alias("how"))
    low = F.lower(F.coalesce("seniority_level", F.lit("")))
    named = F.filter(F.array(*[F.when(low.rlike(p), F.lit(r)) for p, r in roles.items()]), lambda x: x.isNotNull())
    role = df.select(key, F.explode(named).alias("rule_id"), F.lit("role").alias("how"))
    return general.unionByName(tech).unionByName(role).distinct()


def first_orphans(raw: DataFrame, key: str, taxonomy: DataFrame, n: int) -> DataFrame:
    """The most frequent values without a taxonomy entry, as work for a mapping by hand or model (a top-n report)."""
    o = raw.join(taxonomy.select(F.lower("name").alias("raw")), "raw", "left_anti").groupBy("raw").agg(F.count_distinct(key).alias("frequency"))
    return o.orderBy(F.desc("frequency"), "raw").limit(n)


def best_urls(df: DataFrame, order: Sequence[Column]) -> DataFrame:
    """One record per company and platform by the given order, marked if names under one id differ."""
    keys = ["company_id", "platform"]
    # Names are counted beside the window, so that no task holds the names of a large company.
    names = df.groupBy(*keys).agg(F.count_distinct(F.lower(F.trim("company_name"))).alias("names"))
    ranked = latest_per_key(df, keys, order).join(names.withColumnsRenamed({k: f"_{k}" for k in keys}), F.col("company_id").eqNullSafe(F.col("_company_id")) & F.col("platform").eqNullSafe(F.col("_platform")))
    return ranked.withColumn("duplicate_kind", F.when(F.col("names") > 1, "variation").otherwise("same")).drop("_company_id", "_platform")
