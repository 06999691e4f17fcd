"""Joins that need more than an equality, kept hashable."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyforge.operators.dml import latest_per_key
from tallyforge.session import small_or_shuffled


def any_key(left: DataFrame, right: DataFrame, left_keys: Sequence[Column], right_keys: Sequence[Column]) -> DataFrame:
    """Pairs of rows of which any of several key pairs agrees, each pair once.

    The alternatives are exploded to tagged keys on both sides, so an OR of equalities is
    one hash join and no nested loop. Both sides need a unique column named left_id, right_id.
    """
    tag = lambda ks: F.explode(F.array(*[F.struct(F.lit(i).alias("i"), k.cast("string").alias("k")) for i, k in enumerate(ks)])).alias("x")
    a = left.select("left_id", tag(left_keys)).filter("x.k is not null")
    b = right.select("right_id", tag(right_keys)).filter("x.k is not null")
    return a.join(b, "x").select("left_id", "right_id").distinct()


def in_band(df: DataFrame, value: str, bands: DataFrame, low: str, high: str, width: float) -> DataFrame:
    """Rows with every band that holds their value (low <= value <= high; a null high is open).

    Bands are exploded to cells of a width, the value falls into one cell, and the join is
    on the cell, so neither side is looped over. Open bands are joined by a last cell that
    every value reaches from its own side.
    """
    cell = lambda c: F.floor(c / width).cast("long")
    closed = bands.filter(F.col(high).isNotNull()).withColumn("_cell", F.explode(F.sequence(cell(F.col(low)), cell(F.col(high)))))
    v = df.withColumn("_cell", cell(F.col(value)))
    out = v.join(closed, "_cell").filter(F.col(value).between(F.col(low), F.col(high)))
    # Open bands are compared directly; as bands are a rule table they are few, which is counted before they are broadcast.
    open_ = small_or_shuffled(bands.filter(F.col(high).isNull()), 10_000)
    return out.unionByName(v.join(open_, F.col(value) >= F.col(low))).drop("_cell")


def lookup_top(df: DataFrame, ref: DataFrame, df_key: Column, ref_key: Column, order: Sequence[Column], take: str, default: str) -> DataFrame:
    """df with take from the first reference row of its key, or the default: a lookup that can't multiply rows."""
    r = latest_per_key(ref.select(ref_key.alias("_k"), "*").filter("_k is not null"), ["_k"], order).select("_k", F.col(take).alias(f"looked_up_{take}"))
    return df.withColumn("_k", df_key).join(r, "_k", "left").withColumn(f"looked_up_{take}", F.coalesce(f"looked_up_{take}", F.lit(default))).drop("_k")


def anti(df: DataFrame, other: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key isn't in other: NOT EXISTS for one or several columns, by hash."""
    return df.join(other.select(*keys).distinct(), list(keys), "left_anti")


def flagged(df: DataFrame, other: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """df with a boolean: its key is in other."""
    o = other.select(*keys).distinct().withColumn(name, F.lit(True))
    return df.join(o, list(keys), "left").withColumn(name, F.coalesce(F.col(name), F.lit(False)))
