"""What to process next: watermarks, look-back, modes, and duplicates across sources. Every function takes its 'now'."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyforge.operators.dml import latest_per_key

# Hours of overlap, days a watermark holds, look-back in days, completeness limits.
OVERLAP_HOURS, MAX_DAYS = 2, 7
CUSHION, LEAST_BACK, MOST_BACK, DEFAULT_BACK = 2, 2, 90, 15
LEAST_BUCKETS, MOST_SHARE = 15, 0.7
INCREMENTAL_SHARE = 0.8


def high_watermark(df: DataFrame, source: str, ts: str, now: Column) -> DataFrame:
    """(source, watermark): the latest time within MAX_DAYS before now, less the overlap; null asks for a full refresh."""
    recent = F.when((F.col(ts) >= now - F.expr(f"INTERVAL {MAX_DAYS} DAYS")) & (F.col(ts) <= now), F.col(ts))
    return df.groupBy(source).agg((F.max(recent) - F.expr(f"INTERVAL {OVERLAP_HOURS} HOURS")).alias("watermark"))


def since_watermark(df: DataFrame, marks: DataFrame, source: str, ts: str) -> DataFrame:
    """Rows later than their source's watermark, or all where there's none. marks has one row per source."""
    return df.join(marks, source, "left").filter(F.col("watermark").isNull() | (F.col(ts) > F.col("watermark"))).select(*df.columns)


def completeness(df: DataFrame, bucket: Column, ts: str, mark: Column) -> DataFrame:
    """One row: buckets seen around the mark, the largest bucket's share, and whether that looks like a complete run."""
    near = df.filter((F.col(ts) >= mark - F.expr("INTERVAL 2 HOURS")) & (F.col(ts) <= mark + F.expr("INTERVAL 1 HOUR")))
    per = near.select(bucket.alias("b")).filter("b is not null").groupBy("b").agg(F.count("*").alias("n"))
    all_ = per.agg(F.count("*").alias("buckets"), F.coalesce(F.try_divide(F.max("n"), F.sum("n")), F.lit(0.0)).alias("top_share"))
    return all_.withColumn("complete", (F.col("buckets") >= LEAST_BUCKETS) & (F.col("top_share") <= MOST_SHARE))


def lookback(df: DataFrame, key: str, day: str, as_of: Column) -> DataFrame:
    """(key, days): days to look back, from the age of a key's latest row; the default where it has no date."""
    age = F.datediff(as_of, F.max(day))
    return df.groupBy(key).agg(F.when(age.isNotNull(), F.least(F.greatest(age + CUSHION, F.lit(LEAST_BACK)), F.lit(MOST_BACK))).otherwise(DEFAULT_BACK).cast("int").alias("days"))


def processing_mode(df: DataFrame, ts: str, now: Column) -> DataFrame:
    """One row: 'incremental' if most rows are of the last two hours, else 'full'."""
    share = F.coalesce(F.try_divide(F.count_if(F.col(ts) >= now - F.expr("INTERVAL 2 HOURS")), F.count("*")), F.lit(0.0))
    return df.agg(share.alias("recent_share")).withColumn("mode", F.when(F.col("recent_share") > INCREMENTAL_SHARE, "incremental").otherwise("full"))


def across_sources(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """One row per key: the earliest, then of the smallest source. Rows with a null key all stay."""
    return latest_per_key(df.filter(F.col(key).isNotNull()), [key], [F.col(c).asc_nulls_last() for c in order]).unionByName(df.filter(F.col(key).isNull()))


def key_conflicts(df: DataFrame, key: str, source: str) -> DataFrame:
    """(key, sources): keys that occur in more than one source."""
    return df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count_distinct(source).alias("sources")).filter("sources > 1")


def work_to_do(jobs: DataFrame, done: DataFrame, key: str, mode: str, body: str, confidence: str, least_chars: int = 100) -> DataFrame:
    """Jobs to enrich: 'new_only' those not done, 'failed_only' those done with a confidence below 0.3, 'all'."""
    j = jobs.filter(F.length(F.trim(F.col(body))) >= least_chars)
    if mode == "new_only":
        return j.join(done.select(key), key, "left_anti")
    if mode == "failed_only":
        return j.join(done.filter(F.col(confidence) < 0.3).select(key), key, "left_semi")
    if mode != "all":
        raise ValueError(mode)
    return j


def capped_per_group(df: DataFrame, group: str, order: Sequence[Column], n: int) -> DataFrame:
    """The first n rows of each group (a report's cap; the window keeps only n per task before the shuffle)."""
    w = Window.partitionBy(group).orderBy(*order)
    return df.withColumn("rank_in_group", F.row_number().over(w)).filter(F.col("rank_in_group") <= n)
