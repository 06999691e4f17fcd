"""Reading files: tolerant and strict CSV, JSON, work lists of new files, writers' counterparts, and a Python data source."""

from __future__ import annotations

import re
import time
from collections.abc import Callable, Iterator, Mapping, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

# Texts that mean null in files.
NULL_TEXTS = ("NULL", "null", "")


def nulled(df: DataFrame) -> DataFrame:
    """Text columns with the texts that mean null made null."""
    return df.select(*[F.when(~F.trim(F.col(c)).isin(*NULL_TEXTS), F.col(c)).alias(c) if t == "string" else F.col(c) for c, t in df.dtypes])


def read_csv(spark: SparkSession, path: str | Sequence[str], schema: str, strict: bool = False, by_position: bool = False) -> DataFrame:
    """CSV with a header and a file column. Tolerant reading keeps what parses; strict reading fails on a bad row.

    by_position ignores the header's names, as positional copies do.
    """
    r = spark.read.schema(schema).option("header", True).option("mode", "FAILFAST" if strict else "PERMISSIVE").option("enforceSchema", by_position or not strict)
    return nulled(r.csv(path)).withColumn("source_file", F.input_file_name())


def read_json(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).json(path)


def require_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    if missing := sorted(set(names) - set(df.columns)):
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df


def new_files(spark: SparkSession, folder: str, log: DataFrame, pattern: str = "*.csv") -> DataFrame:
    """(path, file_hash) of the files whose content isn't in the log (column file_hash)."""
    f = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder)
    f = f.select("path", F.sha2("content", 256).alias("file_hash"))
    return f.join(log.select("file_hash").distinct(), "file_hash", "left_anti").select("path", "file_hash")


def with_unknown(df: DataFrame, columns: Sequence[str], booleans: Sequence[str] = ()) -> DataFrame:
    """Nulls as 'Unknown', texts of truth as booleans."""
    from tallyforge.functions.predicates import truthy

    return df.withColumns({c: F.coalesce(F.col(c), F.lit("Unknown")) for c in columns} | {c: truthy(F.col(c)) for c in booleans})


def active_with_company(raw: DataFrame, companies: DataFrame, key: str = "company_id") -> DataFrame:
    """Active raw rows with their company's name, if it's known; companies has one row per key."""
    return raw.filter("is_active").join(companies.select(key, "company_name"), key, "left")


def statements(text: str, variables: Mapping[str, str] | None = None) -> list[str]:
    """The statements of a SQL text: ${NAME} replaced by its variable, comments left out, cut at semicolons outside quotes.

    A name without a variable raises, so that no half-filled statement runs.
    """
    filled = re.sub(r"\$\{(\w+)\}", lambda m: (variables or {})[m.group(1)], text)
    parts = re.findall(r"'(?:[^']|'')*'|\"[^\"]*\"|--[^\n]*|/\*.*?\*/|;|[^'\";/-]+|.", filled, re.DOTALL)
    out = [""]
    for p in parts:
        if p == ";":
            out.append("")
        elif not p.startswith(("--", "/*")):
            out[-1] += p
    return [x.strip() for x in out if x.strip()]


def run_script(spark: SparkSession, text: str, variables: Mapping[str, str] | None = None) -> DataFrame | None:
    """Runs the statements of a seed file in their order; the result of the last one."""
    result = None
    for s in statements(text, variables):
        result = spark.sql(s)
    return result


def with_retries(fetch: Callable[[str], str], tries: int = 3, first_wait: float = 1.0, wait: Callable[[float], None] = time.sleep) -> Callable[[str], str]:
    """fetch, tried again after a wait that doubles each time; the last failure is raised."""

    def fetched(address: str) -> str:
        for n in range(tries):
            try:
                return fetch(address)
            except Exception:  # noqa: BLE001
                if n == tries - 1:
                    raise
                wait(first_wait * 2**n)
        raise ValueError("tries must be one or more")

    return fetched


def fetched(addresses: DataFrame, make_fetch: Callable[[], Callable[[str], str]]) -> DataFrame:
    """(address, body, error) of each row's address: a fetcher is made once a task; an address that fails doesn't stop the others."""

    def pages(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        get = make_fetch()
        for b in batches:
            rows = []
            for a in b.iloc[:, 0]:
                try:
                    rows.append((a, get(a), None))
                except Exception as e:  # noqa: BLE001
                    rows.append((a, None, f"{type(e).__name__}: {e}"))
            yield pd.DataFrame(rows, columns=["address", "body", "error"])

    return addresses.select("address").mapInPandas(pages, "address string, body string, error string")


class Bodies(DataSourceReader):
    def __init__(self, folder: str) -> None:
        self.folder = folder

    def partitions(self) -> list[InputPartition]:
        import os

        names = sorted(n for n in os.listdir(self.folder) if n.endswith((".html", ".json")))
        return [InputPartition(f"{self.folder}/{n}") for n in names]

    def read(self, partition: InputPartition) -> Iterator[tuple[str, str]]:
        with open(partition.value, encoding="utf-8") as f:
            yield partition.value, f.read()


class FetchedBodies(DataSource):
    """Fetched pages of a folder that all executors share, one partition each: spark.read.format('bodies').load(folder).

    Fetching itself needs a network and is another reader's business; this is its hook.
    """

    @classmethod
    def name(cls) -> str:
        return "bodies"

    def schema(self) -> str:
        return "path string, body string"

    def reader(self, schema) -> DataSourceReader:
        return Bodies(self.options["path"])
