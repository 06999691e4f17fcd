"""Upserts, deletes and history as pure functions from old and new rows to the table after.

Files have no MERGE; each function returns the rows that the table holds afterwards,
and the writers at the end put them in place. Keys compare by equality: a row with a
null in its key matches nothing, so an old one stays and a new one is inserted.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

FAR_END = dt.date(9999, 12, 31)


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key in the given order (which should be total)."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def merge_upsert(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """All new rows, and the old ones whose key isn't among them. new holds one row per key."""
    return new.select(*old.columns).unionByName(old.join(new.select(*keys), list(keys), "left_anti").select(*old.columns))


def _matched(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    rest = [c for c in old.columns if c not in keys]
    o = old.select(*keys, F.struct(*rest).alias("_o"))
    n = new.select(*keys, F.struct(*rest).alias("_n"))
    return o.join(n, list(keys), "full_outer")


def _unpack(df: DataFrame, old: DataFrame, keys: Sequence[str], value) -> DataFrame:
    rest = [c for c in old.columns if c not in keys]
    return df.select(*keys, *[value(c).alias(c) for c in rest]).select(*old.columns)


def merge_if_changed(
    old: DataFrame, new: DataFrame, keys: Sequence[str], compare: Sequence[str], null_safe: bool = True, prune: bool = False
) -> DataFrame:
    """Matched rows are replaced only if a compared column differs; with prune, old keys that vanished are dropped.

    null_safe=False compares as SQL's <> does, so that a change from or to null isn't seen.
    """
    differs = [(~F.col(f"_o.{c}").eqNullSafe(F.col(f"_n.{c}")) if null_safe else F.coalesce(F.col(f"_o.{c}") != F.col(f"_n.{c}"), F.lit(False))) for c in compare]
    changed = reduce(lambda a, b: a | b, differs)
    m = _matched(old, new, keys)
    if prune:
        m = m.filter("_n is not null")
    take_new = F.col("_o").isNull() | (F.col("_n").isNotNull() & changed)
    return _unpack(m, old, keys, lambda c: F.when(take_new, F.col(f"_n.{c}")).otherwise(F.col(f"_o.{c}")))


def merge_coalesce(old: DataFrame, new: DataFrame, keys: Sequence[str], coalesced: Sequence[str]) -> DataFrame:
    """Upsert in which a null of the new row leaves the old value of the coalesced columns."""
    m = _matched(old, new, keys)
    value = lambda c: F.coalesce(F.col(f"_n.{c}"), F.col(f"_o.{c}")) if c in coalesced else F.when(F.col("_n").isNotNull(), F.col(f"_n.{c}")).otherwise(F.col(f"_o.{c}"))
    return _unpack(m, old, keys, value)


def fill_if_blank(df: DataFrame, source: DataFrame, key: str, column: str) -> DataFrame:
    """Null or blank values of a text column from the source row with the same key, where that has one."""
    s = source.select(key, F.col(column).alias("_fill")).filter("trim(_fill) <> ''")
    s = s.groupBy(key).agg(F.min("_fill").alias("_fill"))
    blank = F.col(column).isNull() | (F.trim(F.col(column)) == "")
    return df.join(s, key, "left").withColumn(column, F.when(blank & F.col("_fill").isNotNull(), F.col("_fill")).otherwise(F.col(column))).select(*df.columns)


def update_from(df: DataFrame, source: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Columns set from the one source row with the same key; rows without one keep theirs."""
    s = source.select(*keys, F.struct(*columns).alias("_s"))
    return df.join(s, list(keys), "left").withColumns({c: F.when(F.col("_s").isNotNull(), F.col(f"_s.{c}")).otherwise(F.col(c)) for c in columns}).select(*df.columns)


def delete_keys(df: DataFrame, gone: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.join(gone.select(*keys), list(keys), "left_anti").select(*df.columns)


def keep_keys(df: DataFrame, there: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Prunes the rows whose key has vanished."""
    return df.join(there.select(*keys), list(keys), "left_semi").select(*df.columns)


def replace_partitions(old: DataFrame, new: DataFrame, parts: Sequence[str]) -> DataFrame:
    """The partitions that occur in new come from new as a whole."""
    return new.select(*old.columns).unionByName(old.join(new.select(*parts).distinct(), list(parts), "left_anti").select(*old.columns))


def scd2_apply(current: DataFrame, snapshot: DataFrame, key: str, tracked: Sequence[str], as_of: Column) -> DataFrame:
    """History after a snapshot: changed keys get their open version closed the day before and a new one; new keys get version 1.

    current has key, tracked columns, valid_from, valid_to (9999-12-31 if open), is_current
    and version; snapshot has one row per key. Other columns of the snapshot are taken over
    but don't make a version. Vanished keys stay open.
    """
    extra = [c for c in snapshot.columns if c != key and c not in tracked]
    fields = [*tracked, *extra]
    open_ = current.filter("is_current").select(F.col(key), F.struct(*tracked, "version").alias("_c"))
    j = snapshot.select(key, F.struct(*fields).alias("_s")).join(open_, key, "left")
    same = reduce(lambda a, b: a & b, [F.col(f"_s.{c}").eqNullSafe(F.col(f"_c.{c}")) for c in tracked])
    moved = j.filter(F.col("_c").isNull() | ~same)
    fresh = moved.select(
        key, *[F.col(f"_s.{c}").alias(c) for c in fields], as_of.cast("date").alias("valid_from"), F.lit(FAR_END).alias("valid_to"),
        F.lit(True).alias("is_current"), (F.coalesce(F.col("_c.version"), F.lit(0)) + 1).cast("int").alias("version"),
    )
    closing = moved.filter("_c is not null").select(key).withColumn("_closed", F.lit(True))
    hit = F.col("is_current") & F.coalesce("_closed", F.lit(False))
    closed = current.join(closing, key, "left").withColumns({"valid_to": F.when(hit, F.date_sub(as_of.cast("date"), 1)).otherwise(F.col("valid_to")), "is_current": F.col("is_current") & ~hit})
    return closed.select(*current.columns).unionByName(fresh, allowMissingColumns=True)


def write_full(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def write_partitions(df: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    """Overwrites the partitions that df holds and no others."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).parquet(path)


def append_history(df: DataFrame, path: str, run_at: Column) -> None:
    df.withColumn("run_at", run_at).write.mode("append").parquet(path)


def split_rejects(df: DataFrame, checks: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """(good rows, rejected rows with the names of the checks they fail): one bad row doesn't stop a batch."""
    failed = F.filter(F.array(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in checks.items()]), lambda x: x.isNotNull())
    marked = df.withColumn("rejected_for", failed)
    return marked.filter(F.size("rejected_for") == 0).drop("rejected_for"), marked.filter(F.size("rejected_for") > 0)
