"""Session defaults and the few helpers that need the session itself."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


_folders: set[str] = set()


def local_session(cpus: int | str = 8, memory: str = "8g", **conf: str) -> SparkSession:
    """A session for tests and the bench; a cluster brings its own."""
    b = SparkSession.builder.master(f"local[{cpus}]").config("spark.driver.memory", memory)
    b = b.config("spark.sql.shuffle.partitions", str(cpus))
    for k, v in (DEFAULTS | conf).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir of the session.

    Only where the cluster names none (tests, local mode) a temporary folder is
    made and set.
    """
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not d:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="tallyforge-")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(d)
    return d


def _cleared_at_end(folder: str) -> None:
    if folder not in _folders:
        _folders.add(folder)
        if folder.startswith(("/", "file:/")):
            atexit.register(shutil.rmtree, "/" + folder.removeprefix("file:").lstrip("/"), ignore_errors=True)


def stored(df: DataFrame) -> DataFrame:
    """Writes df to the shared folder as a Parquet table and goes on from there: lineage is cut, executors may be lost, later reads prune columns and know sizes.

    The tables of one application lie in one folder, which is removed at its end where
    it is a folder of this machine; elsewhere the cluster's cleaning of its checkpoint
    folder does that.
    """
    spark = df.sparkSession
    path = scratch(spark)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.stored_at = path
    return out


def release(*tables: DataFrame) -> None:
    """Deletes tables that stored() made, once nothing reads them any more: what was made from them must be stored itself."""
    for t in tables:
        jvm = t.sparkSession.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(t.stored_at)
        p.getFileSystem(t.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def scratch(spark: SparkSession) -> str:
    """A new folder below the shared folder, for tables that a job writes and reads again."""
    folder = f"{shared_dir(spark)}/tallyforge-{spark.sparkContext.applicationId}"
    _cleared_at_end(folder)
    return f"{folder}/{uuid.uuid4().hex}"


def small_or_shuffled(df: DataFrame, max_rows: int) -> DataFrame:
    """df marked for broadcast if it holds at most max_rows rows, unmarked (a shuffled join) otherwise.

    df should be cheap to count: a stored table or a scan of a small file.
    """
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df
