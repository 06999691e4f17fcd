"""Data quality: expectations, metrics, coverage, confidence, review queue, drift. Results are long tables of checks."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Buckets of confidence, limits of severity and of metrics, points of the review queue.
BUCKETS = ((0.9, "very high", "none"), (0.8, "high", "none"), (0.7, "medium", "sample"), (0.5, "low", "review"))
LOWEST = ("very low", "rework")
COVERAGE_GOAL = 85.0
IMPACT = ((500, 100), (100, 50))
LEAST_IMPACT = 25
REASON_POINTS = ((0.3, 50), (0.5, 40), (0.6, 35), (0.7, 30))
LEAST_REASON = 10


def severity(n: Column, high: int, medium: int) -> Column:
    return F.when(n > high, "HIGH").when(n > medium, "MEDIUM").when(n > 0, "LOW").otherwise("OK")


def status(value: Column, green: float, yellow: float) -> Column:
    """Traffic light of a value of which more is better."""
    return F.when(value >= green, "GREEN").when(value >= yellow, "YELLOW").otherwise("RED")


def orphan_check(name: str, child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """One row: rows of child, and those whose key isn't in parent (null keys are no orphans)."""
    p = parent.select(key).filter(F.col(key).isNotNull()).distinct().withColumn("_there", F.lit(True))
    j = child.select(key).join(p, key, "left")
    bad = F.count_if(F.col(key).isNotNull() & F.col("_there").isNull())
    return j.agg(F.lit(name).alias("check_name"), F.count("*").alias("n_rows"), bad.alias("n_bad")).withColumn("severity", severity(F.col("n_bad"), 100, 10))


def coverage_check(name: str, parent: DataFrame, child: DataFrame, key: str) -> DataFrame:
    """One row: keys of parent and how many child covers, in percent."""
    c = child.select(key).distinct().withColumn("_there", F.lit(True))
    j = parent.select(key).filter(F.col(key).isNotNull()).distinct().join(c, key, "left")
    g = j.agg(F.lit(name).alias("check_name"), F.count("*").alias("n_rows"), F.count_if("_there").alias("n_covered"))
    g = g.withColumn("coverage", F.coalesce(F.try_divide(F.col("n_covered") * 100.0, F.col("n_rows")), F.lit(0.0)))
    return g.withColumn("below_goal", F.col("coverage") < COVERAGE_GOAL)


def column_metrics(df: DataFrame, metrics: dict[str, tuple[Column, float, float]]) -> DataFrame:
    """(metric, value, status) from one pass over df: each metric is an aggregate with its green and yellow limits."""
    one = df.agg(*[m[0].cast("double").alias(name) for name, m in metrics.items()])
    rows = F.array(*[F.struct(F.lit(n).alias("metric"), F.col(n).alias("value"), status(F.col(n), g, y).alias("status")) for n, (_, g, y) in metrics.items()])
    return one.select(F.inline(rows))


def confidence_bucket(c: Column) -> Column:
    """struct(bucket, rating action) of a confidence."""
    pick = lambda i: F.coalesce(*[F.when(c >= b[0], F.lit(b[i])) for b in BUCKETS], F.lit(LOWEST[i - 1]))
    return F.struct(pick(1).alias("rating"), pick(2).alias("action"))


def confidence_buckets(df: DataFrame, group: Column, confidence: str) -> DataFrame:
    """Rows per group and confidence bucket with their share of the group; null confidences are left out."""
    g = df.filter(F.col(confidence).isNotNull() & ~F.isnan(confidence)).select(group.alias("grp"), confidence_bucket(F.col(confidence)).alias("b"))
    g = g.groupBy("grp", "b.rating", "b.action").agg(F.count("*").alias("n"))
    total = g.groupBy("grp").agg(F.sum("n").alias("total"))
    return g.join(total, "grp").select("grp", "rating", "action", "n", (F.col("n") * 100.0 / F.col("total")).alias("share"))


def review_queue(df: DataFrame, item: str, confidence: str, frequency: str, per_point: int, most_points: int) -> DataFrame:
    """Items to review with a priority: impact of their frequency, reason by confidence, capped frequency."""
    f, c = F.col(frequency), F.col(confidence)
    impact = F.coalesce(*[F.when(f >= n, F.lit(p)) for n, p in IMPACT], F.lit(LEAST_IMPACT))
    reason = F.coalesce(*[F.when(c < limit, F.lit(p)) for limit, p in REASON_POINTS], F.lit(LEAST_REASON))
    capped = F.least(F.floor(f / per_point), F.lit(most_points)).cast("int")
    return df.select(F.col(item).alias("item"), f.alias("frequency"), c.alias("confidence"), (impact + reason + capped).alias("priority"))


def unique_check(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: how many keys occur more than once, how many rows have a null in them."""
    null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    g = df.groupBy(*keys).agg(F.count("*").alias("n"), F.first(null).alias("_null"))
    return g.agg(F.count_if((F.col("n") > 1) & ~F.col("_null")).alias("duplicate_keys"), F.coalesce(F.sum(F.when(F.col("_null"), F.col("n"))), F.lit(0)).alias("null_keys"))


def expect(df: DataFrame, message: str) -> None:
    """Raises if df, a table of violations, has a row."""
    if bad := df.take(1):
        raise ValueError(f"{message}: {bad[0].asDict()}")


def coverage_by(df: DataFrame, group: str, bridges: dict[str, DataFrame], key: str = "job_uid", least: int = 10) -> DataFrame:
    """Per value of a column: distinct keys and, for each bridge, how many of them it covers, in percent; groups of fewer than least keys are left out.

    Bridges are reduced to their distinct keys before they are joined.
    """
    j = df.select(key, group).filter(F.col(key).isNotNull() & F.col(group).isNotNull()).distinct()
    for name, b in bridges.items():
        j = j.join(b.select(key).distinct().withColumn(f"_{name}", F.lit(True)), key, "left")
    g = j.groupBy(group).agg(F.count("*").alias("total"), *[F.count_if(F.col(f"_{name}")).alias(f"with_{name}") for name in bridges]).filter(F.col("total") >= least)
    return g.withColumns({f"{name}_coverage": F.col(f"with_{name}") * 100.0 / F.col("total") for name in bridges})


def confidence_metrics(name: str, df: DataFrame, confidence: str, rate: bool = True) -> DataFrame:
    """(metric, value, status): the mean confidence and, with rate, the share of confidences of 0.8 or more in percent; each with its own limits."""
    c = F.col(confidence)
    metrics = {f"{name}_avg_confidence": (F.avg(c), 0.8, 0.7)}
    if rate:
        metrics[f"{name}_high_confidence_rate"] = (F.count_if(c >= 0.8) * 100.0 / F.count("*"), 70.0, 50.0)
    return column_metrics(df.filter(~F.isnan(c) | c.isNull()), metrics)


def drift(builders: dict[str, Callable[[], DataFrame]]) -> dict[str, str]:
    """What each view's plan says today: 'ok', or the class of the error that its analysis raises. Nothing is run."""
    out = {}
    for name, build in builders.items():
        try:
            _ = build().schema
            out[name] = "ok"
        except AnalysisException as e:
            out[name] = e.getCondition() or "analysis error"
    return out
