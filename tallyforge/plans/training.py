"""Queries of the general data-quality operators (problems 4 and 5)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallyforge.operators.orphans import REFERENCES, orphan_counts, orphan_references
from tallyforge.operators.units import pay_ambiguous, pay_flagged, pay_found
from tallyforge.sources.tables import table


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    names = {r.bridge_table for r in REFERENCES} | {r.parent_table for r in REFERENCES}
    return orphan_references({n: table(spark, d, n) for n in names}, table(spark, d, "deleted_keys"))


def p4_orphan_counts(spark: SparkSession, d: str) -> DataFrame:
    return orphan_counts(p4_found(spark, d))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return pay_found(table(spark, d, "jobs_llm_enriched"), table(spark, d, "unit_factors"))


def p5_flagged(spark: SparkSession, d: str) -> DataFrame:
    return pay_flagged(table(spark, d, "jobs_llm_enriched"), table(spark, d, "unit_factors"))


def p5_ambiguous(spark: SparkSession, d: str) -> DataFrame:
    return pay_ambiguous(table(spark, d, "jobs_llm_enriched"), table(spark, d, "unit_factors"))


QUERIES = {"p4_found": p4_found, "p4_orphan_counts": p4_orphan_counts, "p5_found": p5_found, "p5_flagged": p5_flagged, "p5_ambiguous": p5_ambiguous}


def _key(c: str) -> str:
    return f"lower(trim({c}, ' ' || chr(9) || chr(10) || chr(13) || chr(160)))"


def _orphans_sql() -> str:
    parts = []
    for r in REFERENCES:
        parts.append(f"""
        SELECT '{r.bridge_table}' AS bridge_table, b.bridge_id, '{r.ref_field}' AS ref_field,
               CASE WHEN p.k IS NOT NULL THEN 'late' WHEN x.k IS NOT NULL THEN 'deleted' ELSE 'missing' END AS kind,
               coalesce(strftime(b.{r.created}, '%Y-%m'), 'unknown') AS period
        FROM {r.bridge_table} b
        LEFT JOIN (SELECT {_key(r.parent_key)} AS k, min({r.parent_time}) AS earliest FROM {r.parent_table} GROUP BY 1) p
               ON p.k = {_key('b.' + r.ref_field)}
        LEFT JOIN (SELECT DISTINCT {_key('key_value')} AS k FROM deleted_keys WHERE parent_table = '{r.parent_table}') x
               ON x.k = {_key('b.' + r.ref_field)}
        WHERE b.{r.ref_field} IS NOT NULL AND {_key('b.' + r.ref_field)} NOT IN ('', 'n/a')
          AND (p.k IS NULL OR b.{r.created} < p.earliest)""")
    return "SELECT DISTINCT * FROM (" + " UNION ALL ".join(parts) + ")"


ORACLE = {
    "p4_found": _orphans_sql(),
    "p4_orphan_counts": f"SELECT bridge_table, ref_field, kind, period, count(*) AS n_rows FROM ({_orphans_sql()}) GROUP BY ALL",
}
