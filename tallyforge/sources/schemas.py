"""Schemas as code: what tables look like, checks against it, empty tables on demand, and small seed tables."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyforge.operators.quality import expect, unique_check

SCHEMAS = {
    "raw_jobs": "job_id string, company_id string, job_title string, job_description string, job_url string, location string, date_retrieved timestamp_ntz, is_active boolean, raw_data string, partition_key string",
    "jobs_unified": (
        "job_uid string, job_id string, company_id string, platform string, job_title_clean string, job_description_clean string, company_name_clean string, location_standardized string, job_url string, "
        "date_posted date, date_retrieved timestamp_ntz, is_active boolean, employment_status string, department string, detected_language string, language_confidence double, is_english boolean, "
        "platform_specific_data string, data_quality_score double, source_raw_table string, partition_date date"
    ),
    "skills_normalized": "skill_id string, skill string, category string, frequency bigint, sources array<string>, confidence double, needs_review boolean",
    "keyword_standardization_rules": "pattern string, standard string, rule_type string, rule_category string, rule_confidence double",
    "experience_standardization_rules": "rule_id string, low double, high double",
    "countries_mapping": "country string, country_code string",
    "us_states_mapping": "code string, state string",
}


def schema_of(name: str) -> T.StructType:
    """Parsed without a session's help, so that tables can be described before one is there."""
    return T.StructType.fromDDL(SCHEMAS[name])


def assert_schema(df: DataFrame, name: str) -> DataFrame:
    """df in the order of the schema; raises if a column is missing, too many, or of another type."""
    want = [(f.name, f.dataType.simpleString()) for f in schema_of(name)]
    if sorted(want) != sorted(df.dtypes):
        raise ValueError(f"{name}: missing {sorted(set(want) - set(df.dtypes))}, unexpected {sorted(set(df.dtypes) - set(want))}")
    return df.select(*[n for n, _ in want])


def expect_unique(df: DataFrame, keys: Sequence[str]) -> None:
    expect(unique_check(df, keys).filter("duplicate_keys > 0"), f"{', '.join(keys)} repeat")


def expect_fk(child: DataFrame, parent: DataFrame, key: str) -> None:
    expect(child.filter(F.col(key).isNotNull()).select(key).join(parent.select(key), key, "left_anti"), f"{key} has no parent")


def ensure_tables(spark: SparkSession, root: str, names: Iterable[str] = SCHEMAS) -> list[str]:
    """Makes the tables that aren't there, empty; gives their names."""
    jvm, made = spark.sparkContext._jvm, []
    for n in names:
        p = jvm.org.apache.hadoop.fs.Path(f"{root}/{n}.parquet")
        if not p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p):
            spark.createDataFrame([], schema_of(n)).write.parquet(f"{root}/{n}.parquet")
            made.append(n)
    return made


def view_version(sql: str) -> str:
    """Hash of a view's text without comments and extra blanks: it changes only if the view does."""
    bare = re.sub(r"/\*.*?\*/", " ", re.sub(r"--[^\n]*", " ", sql), flags=re.DOTALL)
    return hashlib.md5(" ".join(bare.split()).encode(), usedforsecurity=False).hexdigest()


def seed(spark: SparkSession, name: str, rows: Sequence[tuple]) -> DataFrame:
    """A small rule or lookup table from rows in code."""
    return spark.createDataFrame(list(rows), schema_of(name))
