"""Large state tables (user rows, optimizer state) kept bucketed by key, so that daily joins do not move them.

A bucketed table is written once with its rows dealt by the hash of the key; joins and updates on that key then read each bucket
where it lies, and only the facts or the day's changes are shuffled.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankflow.operators.layout import hot_keys, hot_share
from rankflow.session import new_path, written

# As many rows as a task should hold of a bucket, to choose their number by.
BUCKET_ROWS = 1_000_000


def buckets_for(rows: int, least: int = 8) -> int:
    """Buckets for a table of so many rows: a power of two, so that a table that grew divides evenly into another."""
    return max(least, 1 << max(0, (rows // BUCKET_ROWS).bit_length()))


def write_bucketed(state: DataFrame, key: str, buckets: int, name: str = "state", path: str | None = None, dealt: bool = False) -> str:
    """Write `state` bucketed and sorted by `key`; returns the name of the table.

    Rows are dealt by key before the write, so each bucket is one file; `dealt` says that each task holds one bucket's rows already.  The files lie
    in `path` (default: the shared folder); the table's entry is in the session's catalog.
    """
    spark = state.sparkSession
    table = f"{name}_{uuid.uuid4().hex}"
    rows = state if dealt else state.repartition(buckets, key)
    rows.write.bucketBy(buckets, key).sortBy(key).option("path", path or new_path(spark, name)).format("parquet").saveAsTable(table)
    return table


def register_bucketed(spark: SparkSession, path: str, schema: str, key: str, buckets: int, name: str = "state") -> str:
    """Enter a folder that `write_bucketed` filled, in an earlier session, in this session's catalog."""
    table = f"{name}_{uuid.uuid4().hex}"
    spark.sql(f"CREATE TABLE {table} ({schema}) USING parquet CLUSTERED BY (`{key}`) SORTED BY (`{key}`) INTO {int(buckets)} BUCKETS "
              f"LOCATION '{path}'")
    return table


def bucketed_lookup(facts: DataFrame, table: str, key: str, column: str | None = None, share: float | None = None) -> DataFrame:
    """Left join of facts to a bucketed table with one row per key; the table is read bucket by bucket and not moved.

    `column` names the facts' key column.  The rows of hot keys, few by definition, are broadcast and joined where the facts lie, as one
    bucket would receive all facts of such a key; facts without a key stay there too.  Only the other facts are shuffled.
    """
    spark = facts.sparkSession
    column = column or key
    state = spark.table(table)
    kind = state.schema[key].dataType
    values = [c for c in state.columns if c != key]
    packed = state.select(F.col(key).alias("__key"), F.struct(*values).alias("__state"))
    facts = facts.withColumn("__key", F.col(column).cast(kind))
    # written, as it is used three times: for the facts on either side and for the table's rows
    hot = written(hot_keys(facts, ["__key"], share or hot_share(facts)), "hot").withColumn("__is_hot", F.lit(True))
    marked = facts.join(F.broadcast(hot), "__key", "left")
    settled = F.col("__is_hot").isNotNull() | F.col("__key").isNull()
    hot_state = packed.join(F.broadcast(hot.select("__key")), "__key", "left_semi")
    near = marked.where(settled).join(F.broadcast(hot_state), "__key", "left")
    # sort-merge keeps the table's side where it is, whatever its size is thought to be
    far = marked.where(~settled).join(packed.hint("merge"), "__key", "left")
    columns = [F.col(c) for c in facts.columns if c != "__key"]
    out = [*columns, *[F.col(f"__state.{v}").alias(v) for v in values]]
    return far.select(*out).unionByName(near.select(*out))


def updated_rows(table: str, changes: DataFrame, key: str) -> DataFrame:
    """The rows of a bucketed table with those of `changes` (same columns, one row per key, no null key) in place of the old ones,
    new keys added.

    The table is read bucket by bucket, twice: whole for its own keys and the key alone for the new ones.  Only the changes are shuffled, and
    every task of the result holds rows of one bucket.
    """
    old = changes.sparkSession.table(table)
    values = [c for c in old.columns if c != key]
    after = changes.select(F.col(key).cast(old.schema[key].dataType).alias(key), F.struct(*values).alias("__new"))
    kept = old.select(F.col(key), F.struct(*values).alias("__old")).join(after.hint("merge"), key, "left")
    now = F.coalesce("__new", "__old")
    fresh = after.join(old.select(key).hint("merge"), key, "left_anti")
    return kept.select(key, *[now[v].alias(v) for v in values]).unionByName(
        fresh.select(key, *[F.col("__new")[v].alias(v) for v in values]))


def update_bucketed(table: str, changes: DataFrame, key: str, buckets: int, name: str = "state", path: str | None = None) -> str:
    """Write `updated_rows` as a new bucketed table, two files a bucket; `buckets` is the old table's number.  Returns its name."""
    return write_bucketed(updated_rows(table, changes, key), key, buckets, name, path, dealt=True)


def bucket_files(spark: SparkSession, table: str) -> int:
    """How many files hold the table; one per bucket if it was dealt by key before the write."""
    return len(spark.table(table).inputFiles())
