"""References to records that do not exist, or not yet.

A distributed anti-join of the distinct non-null foreign keys against the parent
keys. The anti-join is written as a left outer join on the pre-aggregated keys, as
the same pass also yields the parent's earliest time, which late references need.
Only the keys that can be at fault are joined back to the rows: they are stored,
counted, and broadcast if few, so a hot key or a large bridge isn't shuffled.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyforge.session import small_or_shuffled, stored

# Blanks around a key that don't count, and texts that are no reference.
BLANKS = " \t\n\r\x0b\x0c\u00a0\u3000"
NO_REFERENCE = ("", "n/a")

#: Keys at fault up to which they are broadcast (about 40 bytes each).
MAX_BROADCAST_KEYS = 500_000


def loose_key(c: Column) -> Column:
    """The key without outer blanks and case; null if it's no reference."""
    k = F.lower(F.btrim(c, F.lit(BLANKS)))
    return F.when(~k.isin(*NO_REFERENCE), k)


@dataclass(frozen=True)
class Reference:
    bridge_table: str
    bridge_id: str
    ref_field: str
    created: str
    parent_table: str
    parent_key: str
    parent_time: str


REFERENCES = (
    Reference("job_salary_bridge", "bridge_id", "job_uid", "created_timestamp", "jobs_llm_enriched", "job_uid", "llm_processing_timestamp"),
    Reference("job_salary_bridge", "bridge_id", "salary_id", "created_timestamp", "salary_normalized", "salary_id", "created_timestamp"),
    Reference("job_keywords_bridge", "bridge_id", "keyword_id", "created_timestamp", "keywords_normalized", "keyword_id", "created_timestamp"),
)


def keys_at_fault(bridge: DataFrame, parent: DataFrame, deleted: DataFrame, r: Reference) -> DataFrame:
    """One row per distinct foreign key that has no parent row, or that some row used before its parent was there."""
    used = (
        bridge.select(loose_key(F.col(r.ref_field)).alias("k"), F.col(r.created).alias("at"))
        .filter("k is not null").groupBy("k").agg(F.min("at").alias("first_use"))
    )
    there = (
        parent.select(loose_key(F.col(r.parent_key)).alias("k"), F.col(r.parent_time).alias("at"))
        .filter("k is not null").groupBy("k").agg(F.min("at").alias("earliest"), F.lit(True).alias("there"))
    )
    gone = (
        deleted.filter(F.col("parent_table") == r.parent_table)
        .select(loose_key(F.col("key_value")).alias("k")).filter("k is not null").distinct().withColumn("gone", F.lit(True))
    )
    kind = (
        F.when(F.col("there") & (F.col("first_use") < F.col("earliest")), "late")
        .when(F.col("there"), None).when(F.col("gone"), "deleted").otherwise("missing")
    )
    return used.join(there, "k", "left").join(gone, "k", "left").select("k", "earliest", kind.alias("kind")).filter("kind is not null")


def orphans_of(bridge: DataFrame, parent: DataFrame, deleted: DataFrame, r: Reference) -> DataFrame:
    """Rows of bridge whose reference r is 'missing', 'deleted' or 'late', with their month.

    Nulls: a null, blank or 'N/A' key is no reference; a null row time gives the period
    'unknown' and is never late; parents without any time make nothing late. A row
    loaded several times comes out once. An empty bridge gives no rows, an empty
    parent makes every reference an orphan. Other columns are ignored.
    """
    faults = small_or_shuffled(stored(keys_at_fault(bridge, parent, deleted, r)), MAX_BROADCAST_KEYS)
    rows = bridge.select(
        F.col(r.bridge_id).alias("bridge_id"), loose_key(F.col(r.ref_field)).alias("k"), F.col(r.created).alias("at")
    ).filter("k is not null")
    return (
        rows.join(faults, "k")
        .filter((F.col("kind") != "late") | (F.col("at") < F.col("earliest")))
        .select(
            F.lit(r.bridge_table).alias("bridge_table"), "bridge_id", F.lit(r.ref_field).alias("ref_field"), "kind",
            F.coalesce(F.date_format("at", "yyyy-MM"), F.lit("unknown")).alias("period"),
        )
        .distinct()
    )


def orphan_references(tables: dict[str, DataFrame], deleted: DataFrame, references=REFERENCES) -> DataFrame:
    """The orphans of all references, one row per bridge row, field, kind and period."""
    return reduce(DataFrame.unionByName, [orphans_of(tables[r.bridge_table], tables[r.parent_table], deleted, r) for r in references])


def orphan_counts(orphans: DataFrame) -> DataFrame:
    """Orphan rows per bridge table, field, kind and month."""
    return orphans.groupBy("bridge_table", "ref_field", "kind", "period").agg(F.count("*").alias("n_rows"))
