"""Samples as a file stream: each file is taken once, whenever it arrives."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery


def stream_samples(spark: SparkSession, root: str, schema: T.StructType, files_per_trigger: int | None = None,
                   columns: Sequence[str] | None = None, ignore_corrupt: bool = False) -> DataFrame:
    """The hourly folders under `root` as a stream.

    Row-wise operators (cleaning, labels, sampling by key, bucketing, encoding) apply to
    it unchanged.
    """
    reader = spark.readStream.schema(schema).option("ignoreCorruptFiles", ignore_corrupt)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    df = reader.parquet(root)
    return df.select(*columns) if columns is not None else df


def write_available(df: DataFrame, path: str, checkpoint: str, partitions: Sequence[str] = ()) -> StreamingQuery:
    """Take what is there now, append it to a table, and stop; the checkpoint remembers the files."""
    writer = df.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
    if partitions:
        writer = writer.partitionBy(*partitions)
    return writer.trigger(availableNow=True).start()


def for_each_batch(df: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """Run a batch job, such as extending a vocabulary, on the rows that have newly arrived."""
    return df.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
