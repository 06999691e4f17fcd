"""Structured Streaming front-ends of the batch operators, and windows over event time.

The windows, sessions and stateful latest row go beyond what batch pipelines of this
kind have; they are extensions.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyforge.operators.versioned import VersionedTable


def file_stream(spark: SparkSession, folder: str, schema, fmt: str = "parquet", files_per_batch: int = 100, **options: str) -> DataFrame:
    """Files of a folder as they arrive; the checkpoint remembers which were read."""
    r = spark.readStream.schema(schema).format(fmt).option("maxFilesPerTrigger", files_per_batch)
    for k, v in options.items():
        r = r.option(k, v)
    return r.load(folder)


def upsert_stream(stream: DataFrame, target: VersionedTable, keys: Sequence[str], order: Sequence, checkpoint: str):
    """Merges a stream into a table, the latest row of each key winning; runs until what is there is read, then stops.

    A late row loses against a newer one already in the table, as both compete by the order.
    Batches may be delivered twice; a merge of the same batch leaves the same table. A batch
    writes only the buckets of its keys.
    """
    if target.keys != list(keys):
        raise ValueError(f"the table is bucketed by {target.keys}")

    def batch(df: DataFrame, _: int) -> None:
        df.persist()
        try:
            target.merge(df, order)
        finally:
            df.unpersist()

    return stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def tumbling_counts(df: DataFrame, ts: str, by: str, width: str = "1 day", late: str = "2 hours") -> DataFrame:
    """Rows per window and value; on a stream, rows later than the watermark are dropped."""
    w = df.withWatermark(ts, late) if df.isStreaming else df
    return w.groupBy(F.window(ts, width).alias("w"), by).agg(F.count("*").alias("n")).select(F.col("w.start").alias("window_start"), by, "n")


def sliding_counts(df: DataFrame, ts: str, by: str, width: str, step: str, late: str = "2 hours") -> DataFrame:
    w = df.withWatermark(ts, late) if df.isStreaming else df
    return w.groupBy(F.window(ts, width, step).alias("w"), by).agg(F.count("*").alias("n")).select(F.col("w.start").alias("window_start"), by, "n")


def session_counts(df: DataFrame, ts: str, by: str, gap: str = "30 minutes", late: str = "2 hours") -> DataFrame:
    """Sessions of each value: runs of rows no further apart than the gap."""
    w = df.withWatermark(ts, late) if df.isStreaming else df
    return w.groupBy(F.session_window(ts, gap).alias("w"), by).agg(F.count("*").alias("n")).select(F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), by, "n")


def without_repeats(df: DataFrame, keys: Sequence[str], ts: str, late: str = "2 hours") -> DataFrame:
    """The first delivery of each key; on a stream within the watermark, so that state is let go."""
    return df.withWatermark(ts, late).dropDuplicatesWithinWatermark(list(keys)) if df.isStreaming else df.dropDuplicates(list(keys))


def latest_state(stream: DataFrame, key: str, ts: str, value: str) -> DataFrame:
    """(key, ts, value) of each key whenever a newer row arrives; one row of state per key. ts is a timestamp, value a double."""
    from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

    def update(k: tuple, pdfs: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        best = state.get if state.exists else None
        before = best
        for pdf in pdfs:
            for t, v in zip(pdf["ts"].astype("int64"), pdf["value"], strict=True):
                if best is None or t > best[0]:
                    best = (int(t), float(v))
        if best is not None and best != before:
            state.update(best)
            yield pd.DataFrame({"key": [k[0]], "ts": pd.to_datetime([best[0]]), "value": [best[1]]})

    s = stream.select(F.col(key).cast("string").alias("key"), F.col(ts).cast("timestamp").alias("ts"), F.col(value).cast("double").alias("value"))
    return s.groupBy("key").applyInPandasWithState(update, "key string, ts timestamp, value double", "ts long, value double", "update", GroupStateTimeout.NoTimeout)


def run_once(stream: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append") -> None:
    """Feeds everything that is there to a sink and waits."""
    stream.writeStream.outputMode(mode).foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
