"""Named tables below one folder, and the record of what a job has done, so that it can go on where it stopped."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession

from tallyforge.operators.versioned import VersionedTable


@dataclass(frozen=True)
class Store:
    """Tables by schema and name: <root>/<schema>/<name>. Readers see a whole table while it's written anew."""

    spark: SparkSession
    root: str

    def table(self, name: str, schema, keys: Sequence[str] = ()) -> VersionedTable:
        return VersionedTable(self.spark, f"{self.root}/{name.replace('.', '/')}", schema, keys)

    def save(self, name: str, df: DataFrame) -> None:
        """Makes the table, or replaces it."""
        self.table(name, df.schema).replace(df)

    def load(self, name: str, schema) -> DataFrame:
        """The table; empty if it isn't there."""
        return self.table(name, schema).read()


@dataclass(frozen=True)
class Progress:
    """What a job has finished: a table of keys. A job that stops loses at most the step it was in."""

    done: VersionedTable

    def left(self, work: DataFrame) -> DataFrame:
        """The rows of work that aren't done; rows with a null key are always left."""
        return work.join(self.done.read().select(*self.done.keys), self.done.keys, "left_anti").select(*work.columns)

    def finish(self, rows: DataFrame) -> None:
        """Records rows as done; recording them twice changes nothing."""
        self.done.merge(rows.select(*self.done.keys).distinct(), self.done.keys)

    def forget(self, which: Column) -> None:
        """Takes rows out of the record, to be done again."""
        self.done.replace(self.done.read().filter(~which))
