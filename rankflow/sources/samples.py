"""Reading and writing samples and typed example records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rankflow.operators.layout import rebalanced
from rankflow.registry import INT_SPARSE, LABELS, Registry

PARTITIONS = ["dt", "hour", "scene_id"]

# Texts that the reader of raw tab-separated samples takes for missing.
MISSING = ["", "\\N", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
           "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null"]


def write_samples(df: DataFrame, root: str, mode: str = "overwrite") -> None:
    """Partitioned by day, hour and scene; a large hour is split over several files."""
    rebalanced(df, *PARTITIONS).write.mode(mode).partitionBy(*PARTITIONS).parquet(root)


def sample_schema(spark: SparkSession, root: str) -> T.StructType:
    """The schema of stored samples, with the partition columns as text: hour 07 stays 07 whatever the session infers."""
    found = spark.read.parquet(root).schema
    return T.StructType([T.StructField(f.name, T.StringType()) if f.name in PARTITIONS else f for f in found])


def read_samples(spark: SparkSession, root: str, dt: str | None = None, hours: Sequence[str] | None = None,
                 scene: str | None = None, columns: Sequence[str] | None = None, schema: T.StructType | None = None,
                 ignore_corrupt: bool = False) -> DataFrame:
    """Samples of a day, of some hours of it, of a scene; only the wanted files and columns are read.

    With `ignore_corrupt`, files that cannot be read are skipped, as are files that vanish.
    Give the schema then, or it may be looked for in such a file.
    """
    reader = spark.read.option("ignoreCorruptFiles", ignore_corrupt).option("ignoreMissingFiles", ignore_corrupt)
    df = reader.schema(schema if schema is not None else sample_schema(spark, root)).parquet(root)
    if dt is not None:
        df = df.where(F.col("dt") == dt)
    if hours is not None:
        df = df.where(F.col("hour").isin(list(hours)))
    if scene is not None:
        df = df.where(F.col("scene_id") == scene)
    return df.select(*columns) if columns is not None else df


def read_many(spark: SparkSession, paths: Sequence[str], suffix: str = ".parquet", schema: T.StructType | None = None) -> DataFrame:
    """All files with a name ending in `suffix` under several paths, read side by side."""
    reader = spark.read.option("pathGlobFilter", f"*{suffix}").option("recursiveFileLookup", True)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.parquet(*paths)


def read_tsv(spark: SparkSession, path: str, columns: Sequence[str] | T.StructType, missing: Sequence[str] = MISSING) -> DataFrame:
    r"""Headerless tab-separated text without quoting; `\N` and the other `missing` texts are null.

    Names alone mean strings.
    """
    schema = columns if isinstance(columns, T.StructType) else T.StructType([T.StructField(c, T.StringType()) for c in columns])
    raw = T.StructType([T.StructField(f.name, T.StringType()) for f in schema])
    lines = spark.read.schema(raw).option("sep", "\t").option("quote", "").option("escape", "").csv(path)
    return lines.select(*[
        F.when(~F.col(f.name).isin(list(missing)), F.col(f.name)).try_cast(f.dataType).alias(f.name) for f in schema])


def write_tsv(df: DataFrame, path: str) -> None:
    text = [F.coalesce(F.col(c).cast("string"), F.lit("\\N")) for c in df.columns]
    df.select(F.concat_ws("\t", *text).alias("value")).write.text(path)


def _typed(col: Column, kind: str) -> Column:
    if kind == "int":
        return F.coalesce(col.try_cast("bigint"), F.lit(0).cast("bigint"))
    if kind == "list":
        return F.coalesce(col.cast("array<bigint>"), F.array().cast("array<bigint>"))
    return F.coalesce(col.cast("string"), F.lit(""))


def example_types(registry: Registry, int_only: bool = False, labels: Sequence[str] = LABELS) -> dict[str, str]:
    """Column -> int, text or list.

    With `int_only`, every scalar but the user id is an int.
    """
    whole = {n.lower() for n in INT_SPARSE}
    kinds: dict[str, str] = {}
    for f in registry.features:
        if f.group == "sequence":
            kinds[f.name] = "list"
        elif f.group in ("dense", "position"):
            kinds[f.name] = "int"
        elif f.name == "userid":
            kinds[f.name] = "text"
        else:
            kinds[f.name] = "int" if int_only or f.name.lower() in whole else "text"
    return kinds | {name: "int" for name in labels}


def project_examples(df: DataFrame, kinds: dict[str, str], keep: Sequence[str] = ()) -> DataFrame:
    """Typed records with 0, "" and the empty list for what is missing, also for columns `df` lacks."""
    have = {c.lower(): c for c in df.columns}
    empty = {"list": F.lit(None).cast("array<bigint>")}
    return df.select(*keep, *[
        _typed(F.col(have[n.lower()]) if n.lower() in have else empty.get(k, F.lit(None)), k).alias(n)
        for n, k in kinds.items()])
