"""Vocabularies, scores and model versions on storage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankflow.operators.layout import rebalanced
from rankflow.operators.vocab import VOCAB_SCHEMA, empty_vocab


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def write_feature_map(vocab: DataFrame, path: str) -> None:
    """One folder per vocabulary, so that reading one reads only its files."""
    rebalanced(vocab, "emb_name").write.mode("errorifexists").partitionBy("emb_name").parquet(path)


def read_feature_map(spark: SparkSession, path: str) -> DataFrame:
    """The vocabulary at `path`, or an empty one when there is none."""
    if not path_exists(spark, path):
        return empty_vocab(spark)
    return spark.read.schema(VOCAB_SCHEMA).parquet(path).select("emb_name", "value", "id")


def write_scores(scores: DataFrame, path: str, *partitions: str) -> None:
    out = rebalanced(scores, *partitions) if partitions else scores
    writer = out.write.mode("errorifexists")
    (writer.partitionBy(*partitions) if partitions else writer).parquet(path)


def ready_partitions(spark: SparkSession, root: str, marker: str = "_SUCCESS") -> DataFrame:
    """Days under `root` (folders `dt=...`) with whether their marker file is there.

    Only file names are read; the list has a row per day.
    """
    jvm = spark.sparkContext._jvm
    base = jvm.org.apache.hadoop.fs.Path(root)
    fs = base.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    days = [s.getPath() for s in fs.listStatus(base) if s.isDirectory() and s.getPath().getName().startswith("dt=")]
    rows = [(d.getName().removeprefix("dt="), fs.exists(jvm.org.apache.hadoop.fs.Path(d, marker))) for d in days]
    return spark.createDataFrame(rows, "dt string, ready boolean")


def list_ready_partitions(manifest: DataFrame) -> DataFrame:
    """The days of a manifest whose input is complete."""
    return manifest.where(F.coalesce("has_input", F.lit(False))).select("dt")


def version_of(path_col: str):
    """The step number after `ckpt-` in a path, null when there is none."""
    return F.nullif(F.regexp_extract(path_col, r"ckpt-(\d+)", 1), F.lit("")).try_cast("bigint")


def latest_version(manifest: DataFrame, *by: str) -> DataFrame:
    return manifest.groupBy(*by).agg(F.max(version_of("path")).alias("version"))
