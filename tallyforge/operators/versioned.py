"""Parquet tables with versions, for writers without a table format.

A table is a folder of data folders and of numbered manifests. A manifest names, per
bucket of the key, the folder that holds the bucket's rows; the table is what the manifest
of the greatest number names. A change writes new data folders, then a manifest under
another name, and renames that to the next number. Nothing that a reader may look at is
ever renamed away or overwritten, so a writer that stops anywhere leaves the old table or
the new one. The version before the last stays for readers that have begun.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyforge.operators.dml import latest_per_key, merge_upsert

#: Versions that are kept; older folders go with the next change.
KEPT = 2
BUCKET = "_bucket"


class VersionedTable:
    """A table of the given schema; with keys its rows are spread over buckets by a hash of the keys.

    One writer at a time: a second one that finds its number taken fails, and changes nothing.
    """

    def __init__(self, spark: SparkSession, path: str, schema: str | T.StructType, keys: Sequence[str] = (), buckets: int = 16) -> None:
        self.spark, self.path, self.schema, self.keys, self.buckets = spark, path, schema, list(keys), buckets if keys else 1
        jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _versions(self) -> list[int]:
        here = self._path(self.path)
        names = [s.getPath().getName() for s in self._fs.listStatus(here)] if self._fs.exists(here) else []
        return sorted(int(n.removeprefix("manifest-")) for n in names if n.startswith("manifest-"))

    def _manifest(self, version: int) -> dict[str, str]:
        return json.loads(self.spark.read.text(f"{self.path}/manifest-{version:012d}", wholetext=True).first()[0])

    def current(self) -> dict[str, str]:
        """The folder of each bucket, empty without a table."""
        v = self._versions()
        return self._manifest(v[-1]) if v else {}

    def _rows(self, folders: Sequence[str]) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*[f"{self.path}/{f}" for f in folders])

    def read(self) -> DataFrame:
        return self._rows(sorted(set(self.current().values())))

    def _bucket(self):
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)) if self.keys else F.lit(0)

    def _write(self, df: DataFrame) -> dict[str, str]:
        """Writes rows to a new folder; the folder of each bucket that got any."""
        folder = f"data-{uuid.uuid4().hex}"
        df.withColumn(BUCKET, self._bucket()).write.partitionBy(BUCKET).parquet(f"{self.path}/{folder}")
        parts = [s.getPath().getName() for s in self._fs.listStatus(self._path(f"{self.path}/{folder}"))]
        return {p.split("=")[1]: f"{folder}/{p}" for p in parts if p.startswith(f"{BUCKET}=")}

    def _publish(self, manifest: dict[str, str]) -> None:
        version = max(self._versions(), default=0) + 1
        tmp, to = self._path(f"{self.path}/_new-{uuid.uuid4().hex}"), self._path(f"{self.path}/manifest-{version:012d}")
        out = self._fs.create(tmp, False)
        out.write(bytearray(json.dumps(manifest).encode()))
        out.close()
        if self._fs.exists(to) or not self._fs.rename(tmp, to):
            self._fs.delete(tmp, False)
            raise RuntimeError(f"{self.path} has another writer")

    def _tidy(self) -> None:
        """Drops what only versions before the kept ones name. A folder without a version is a failed writer's and goes as well."""
        versions = self._versions()
        used = {f.split("/")[0] for v in versions[-KEPT:] for f in self._manifest(v).values()}
        for v in versions[:-KEPT]:
            self._fs.delete(self._path(f"{self.path}/manifest-{v:012d}"), False)
        for s in self._fs.listStatus(self._path(self.path)):
            name = s.getPath().getName()
            if name.startswith("data-") and name not in used:
                self._fs.delete(s.getPath(), True)

    def replace(self, df: DataFrame) -> None:
        """The whole table anew."""
        self._publish(self._write(df))
        self._tidy()

    def merge(self, batch: DataFrame, order: Sequence) -> None:
        """Upserts rows by the keys, the first of a key in the order staying, be it new or old; only buckets that batch touches are written again.

        The batch is read twice. Merging it again changes nothing.
        """
        old = self.current()
        touched = [str(r[0]) for r in batch.select(self._bucket()).distinct().collect()]  # no more than there are buckets
        there = self._rows([old[b] for b in touched if b in old])
        same_keys = there.join(batch.select(*self.keys).distinct(), self.keys, "left_semi")
        best = latest_per_key(batch.select(*there.columns).unionByName(same_keys), self.keys, order)
        self._publish(old | self._write(merge_upsert(there, best, self.keys)))
        self._tidy()
