"""Row numbering and joins that stay spread out when one key holds much of the data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rankflow.session import written

# A side is broadcast only when the caller can bound its rows by this.
BROADCAST_ROWS = 200_000
# A key is hot from this part of an even partition on, and no more than so many keys are.
HOT_PART = 0.1
HOT_KEYS = 20_000


def _partitions(df: DataFrame, partitions: int | None) -> int:
    return partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def row_index(df: DataFrame, order: Sequence[str], partitions: int | None = None, name: str = "row_index",
              total: str | None = None) -> DataFrame:
    """Number the rows from 0 in the order of `order`, which must be unique; `total` names a column for their number.

    Range partitions are sorted and numbered on their own, the result is written
    once, and the few per-partition counts give each partition its offset.  No
    step puts all rows into one task.
    """
    n = _partitions(df, partitions)
    local = (df.repartitionByRange(n, *order).sortWithinPartitions(*order)
             .withColumns({"__part": F.spark_partition_id(),
                           "__pos": F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))}))
    local = written(local, name)
    # one row per partition: n rows at most
    counts = local.groupBy("__part").agg((F.max("__pos") + 1).alias("__n"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    whole = before.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    offsets = counts.select("__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__offset"),
                            *([F.sum("__n").over(whole).alias(total)] if total else []))
    return (local.join(F.broadcast(offsets), "__part")
            .withColumn(name, F.col("__offset") + F.col("__pos"))
            .drop("__part", "__pos", "__offset"))


def sums_above(df: DataFrame, order: str, sums: Sequence[str], partitions: int | None = None) -> DataFrame:
    """For each row, the sums over all rows with a greater `order` value, as `<col>_above`.

    `order` must be unique.  Works on range partitions like `row_index`.
    """
    n = _partitions(df, partitions)
    ranged = written(df.repartitionByRange(n, order).withColumn("__part", F.spark_partition_id()), "sums_above")
    totals = ranged.groupBy("__part").agg(*[F.sum(c).alias(f"__t_{c}") for c in sums])
    later = Window.orderBy(F.desc("__part")).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("__part", *[F.coalesce(F.sum(f"__t_{c}").over(later), F.lit(0)).alias(f"__o_{c}") for c in sums])
    inside = Window.partitionBy("__part").orderBy(F.desc(order)).rowsBetween(Window.unboundedPreceding, -1)
    return (ranged.join(F.broadcast(offsets), "__part")
            .withColumns({f"{c}_above": F.coalesce(F.sum(c).over(inside), F.lit(0)) + F.col(f"__o_{c}") for c in sums})
            .drop("__part", *[f"__o_{c}" for c in sums]))


def hot_share(df: DataFrame) -> float:
    """The share of the rows from which on a key is hot: a part of what one shuffle partition should hold.

    There are at most 1 / share such keys, which bounds what is broadcast.
    """
    return max(HOT_PART / _partitions(df, None), 1 / HOT_KEYS)


def hot_keys(facts: DataFrame, keys: Sequence[str], share: float) -> DataFrame:
    """Keys that hold at least `share` of the rows: never more than 1 / share rows."""
    counts = facts.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).where(
        " AND ".join(f"`{k}` IS NOT NULL" for k in keys))
    total = counts.agg(F.sum("__n").alias("t")).scalar()
    return counts.where(F.col("__n") >= total * share).select(*keys)


def lookup_join(facts: DataFrame, state: DataFrame, keys: Sequence[str], bound: int | None,
                spread_by: Sequence[str], share: float | None = None, counted: DataFrame | None = None) -> DataFrame:
    """Left join of facts to a state table with at most one row per key.

    `bound` is what the caller can prove about the rows of `state` (a vocabulary's
    capacity, say).  Within BROADCAST_ROWS the state is broadcast.  Otherwise the
    state rows of hot keys, which are few by definition, are broadcast, and the
    facts that hold them are spread over the shuffle by `spread_by`, so that no
    task receives a hot key's rows together.

    Hot keys are counted in `counted`, a frame with the same keys; give the frame before
    earlier joins, so that a chain of joins does not repeat them in every count.
    """
    keys = list(keys)
    if bound is not None and bound <= BROADCAST_ROWS:
        return facts.join(F.broadcast(state), keys, "left")
    values = [c for c in state.columns if c not in keys]
    hot = hot_keys(facts if counted is None else counted, keys, share or hot_share(facts))
    hot_state = state.join(F.broadcast(hot), keys, "left_semi").select(*keys, F.struct(*values).alias("__hot"))
    marks = hot.select(*[F.col(k).alias(f"__h_{k}") for k in keys])
    seen = facts.join(F.broadcast(marks), [facts[k] == marks[f"__h_{k}"] for k in keys], "left")
    # Rows that are answered without the shuffle join, or cannot match, must not meet in one
    # task either: their key is null and they are placed by `spread_by`.  The others are
    # placed by a hash of the key; it is part of the join key on both sides, as a constant
    # would be dropped from it.  Hot keys meet their state rows after the shuffle, which so
    # carries no values.
    typed = {k: F.col(k).cast(state.schema[k].dataType) for k in keys}
    settled = F.col(f"__h_{keys[0]}").isNotNull()
    for k in keys:
        settled = settled | typed[k].isNull()
    place = F.when(settled, F.xxhash64(*spread_by)).otherwise(F.xxhash64(*typed.values()))
    seen = seen.withColumns({"__place": place, **{f"__k_{k}": F.when(~settled, c) for k, c in typed.items()}}).drop(*[f"__h_{k}" for k in keys])
    cold = state.select(*[F.col(k).alias(f"__k_{k}") for k in keys], F.xxhash64(*keys).alias("__place"),
                        F.struct(*values).alias("__cold"))
    joined = seen.join(cold, ["__place", *[f"__k_{k}" for k in keys]], "left").join(F.broadcast(hot_state), keys, "left")
    found = F.coalesce("__hot", "__cold")
    return joined.select(*[F.col(c) for c in facts.columns], *[found[v].alias(v) for v in values])


def for_heavy_work(df: DataFrame) -> DataFrame:
    """At least one partition per core, for steps whose cost lies in the work per row and not in reading.

    For frames that only scan and project: asking others for their partitions would run
    their shuffles.  Data of any size has more partitions than cores and stays as it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)


def rebalanced(df: DataFrame, *cols: str) -> DataFrame:
    """Group rows by `cols` for writing; adaptive execution splits a group that is too large."""
    return df.hint("rebalance", *[F.col(c) for c in cols]) if cols else df.hint("rebalance")



def as_of_join(facts: DataFrame, states: DataFrame, keys: Sequence[str], time: str, state_time: str, strict: bool = False,
               partitions: int | None = None) -> DataFrame:
    """Add to every fact the values of the latest state of its key that is not later than the fact (`strict`: earlier).

    Both sides are range-partitioned together by key and time and written once; states are carried forward inside a partition, and
    the few that a partition takes over from those before it, one at most, come from a row per partition.  A key with much of
    the data is cut by time like any other, so no task sees all of its rows.  Facts without a state, key or time get nulls.  Of
    several states of one key and time the one with the greatest values counts.  The states' columns must be new
    to the facts, but for the keys.
    """
    keys, values = list(keys), [c for c in states.columns if c not in (*keys, state_time)]
    n = _partitions(facts, partitions)
    kind = facts.schema[time].dataType
    fact_side = facts.select(*[F.col(k) for k in keys], F.col(time).alias("__time"), F.lit(0 if strict else 1).alias("__side"),
                             F.struct(*facts.columns).alias("__fact"), F.lit(None).cast(_struct_type(states, values)).alias("__state"))
    known = states.where(" AND ".join(f"`{c}` IS NOT NULL" for c in (*keys, state_time)))
    state_side = known.select(*[F.col(k).cast(facts.schema[k].dataType).alias(k) for k in keys], F.col(state_time).cast(kind).alias("__time"),
                              F.lit(1 if strict else 0).alias("__side"), F.lit(None).cast(fact_side.schema["__fact"].dataType).alias("__fact"),
                              F.struct(*values).alias("__state"))
    # rows of one key and moment are told apart by a hash, so they need not share a partition
    both = fact_side.unionByName(state_side).withColumn("__tie", F.xxhash64("__fact"))
    order = [*keys, "__time", "__side", "__tie"]
    laid = written(both.repartitionByRange(n, *order).withColumn("__part", F.spark_partition_id()), "as_of")
    whole = F.struct(*keys)
    ends = laid.groupBy("__part").agg(F.min(whole).alias("first"), F.max(whole).alias("last"))
    # the state that the last key of a partition hands on: the group of that key only
    handed = (laid.join(F.broadcast(ends.select("__part", "last")), "__part").where(F.col("__state").isNotNull() & (whole == F.col("last")))
              .groupBy("__part").agg(F.max(F.struct("__time", "__state")).alias("handed")))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    latest = F.last(F.when(F.col("handed").isNotNull(), F.struct("last", "handed.__state")), ignorenulls=True).over(before)
    carried = (ends.join(handed, "__part", "left").withColumn("__from", latest).where(F.col("__from.last") == F.col("first"))
               .select("__part", "first", F.col("__from.__state").alias("__carried")))
    inside = Window.partitionBy("__part", *keys).orderBy("__time", "__side", "__state").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    filled = laid.withColumn("__here", F.last("__state", ignorenulls=True).over(inside)).where("__fact IS NOT NULL")
    found = filled.join(F.broadcast(carried), "__part", "left")
    # a fact without a time sorts before all states of its key
    usable = F.col("__time").isNotNull()
    state = F.coalesce(F.col("__here"), F.when(whole == F.col("first"), F.col("__carried")))
    return found.select("__fact.*", *[F.when(usable, state[v]).alias(v) for v in values])


def _struct_type(df: DataFrame, columns: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(c, df.schema[c].dataType) for c in columns])
