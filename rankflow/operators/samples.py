"""Cleaning, labelling, sampling, shuffling and batching of impression samples."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rankflow.functions.hashing import keep_share, md5_number
from rankflow.functions.text import cross, rename_map
from rankflow.operators.layout import lookup_join, row_index
from rankflow.registry import LABELS, Registry, crossed_features
from rankflow.session import written

LAST_POSITION = 60
ACCIDENT_SECONDS = 60
SKIPPED_SHARE = 0.1
FINISHED_SHARE = 0.9


def _certain(condition: Column) -> Column:
    """A comparison with a missing value counts as false, also under negation."""
    return F.coalesce(condition, F.lit(False))


def canonical_names(df: DataFrame, registry: Registry) -> DataFrame:
    """Rename lower-cased columns to the registry's spelling."""
    return df.withColumnsRenamed(rename_map(df.columns, registry.names()))


def _no_reaction(*labels: str) -> Column:
    quiet = F.col("play_ratio") < SKIPPED_SHARE
    for label in labels:
        quiet = quiet & (F.col(label) == 0)
    return quiet


def is_accidental() -> Column:
    """A short impression that led to nothing."""
    gap = F.col("mtime_gap")
    return _certain((gap >= 0) & (gap < ACCIDENT_SECONDS) & _no_reaction("ctr_label", "cvr_label", "unlock_label"))


def drop_accidental(df: DataFrame) -> DataFrame:
    return df.where(~is_accidental())


def finish_view_label(play_ratio: Column) -> Column:
    return _certain(play_ratio > FINISHED_SHARE).cast("int")


def vip_label(vip_type: Column) -> Column:
    text = F.nullif(F.trim(vip_type.cast("string")), F.lit(""))
    return F.coalesce(text.try_cast("int"), F.lit(0))


def clamp_position(book_pos: Column) -> Column:
    return F.least(F.coalesce(book_pos.try_cast("int"), F.lit(LAST_POSITION)), F.lit(LAST_POSITION))


def request_hour(reqtime: Column) -> Column:
    hour = F.substring(reqtime, 12, 2).try_cast("int")
    return F.coalesce(F.when(F.length(reqtime) >= 13, hour), F.lit(-1))


def is_negative() -> Column:
    """No label set and hardly played; needs `finish_view_label`."""
    return _certain(_no_reaction("ctr_label", "cvr_label", "finish_view_label", "unlock_label"))


def split_negatives(df: DataFrame) -> DataFrame:
    return df.withColumn("is_negative", is_negative())


def downsample_negatives(df: DataFrame, key: str, frac: float = 0.5, seed: int = 42) -> DataFrame:
    """Keep every positive and a repeatable share of the negatives, chosen by a hash of `key`.

    One filter does it, so nothing is shuffled and no union is needed.
    """
    return df.where(~is_negative() | keep_share(F.col(key), frac, seed))


def downsample_by_union(df: DataFrame, key: str, frac: float = 0.5, seed: int = 42) -> DataFrame:
    """The same rows as `downsample_negatives`, for callers who treat both parts differently."""
    negatives = df.where(is_negative()).where(keep_share(F.col(key), frac, seed))
    return df.where(~is_negative()).unionByName(negatives)


_BUCKET_BITS = 16


def exact_sample(df: DataFrame, frac: float, by: str, key: str, seed: int = 42) -> DataFrame:
    """Exactly round(frac * n) rows of each group: those with the lowest hash of `key`, which must be unique.

    Rows with a null in `by` are a group like any other.  A group may hold much of the data, so it is never ranked as a whole.  Counts per
    (group, leading hash bits) find the bits at which the quota is reached; rows below
    are kept as they are, and only the one bucket at the edge is ranked, a 65536th of
    the group.
    """
    columns = df.columns
    number = md5_number(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))
    # a text that no null hides in, as joins match no nulls
    hashed = df.withColumn("__group", F.coalesce(F.concat(F.lit("="), F.col(by).cast("string")), F.lit("")))
    hashed = hashed.withColumn("__hash", number).withColumn("__bucket", F.shiftright("__hash", 60 - _BUCKET_BITS))
    per_bucket = written(hashed.groupBy("__group", "__bucket").agg(F.count(F.lit(1)).alias("__n")), "buckets")
    group = Window.partitionBy("__group")
    running = group.orderBy("__bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cut = (per_bucket.withColumns({"__seen": F.sum("__n").over(running),
                                   "__quota": F.bround(F.sum("__n").over(group) * F.lit(float(frac))).cast("bigint")})
           .where((F.col("__seen") - F.col("__n") < F.col("__quota")) & (F.col("__seen") >= F.col("__quota")))
           .select("__group", F.col("__bucket").alias("__edge"),
                   (F.col("__quota") - (F.col("__seen") - F.col("__n"))).alias("__rest")))
    # one row per group; how many there are decides how they meet the rows
    groups = per_bucket.select("__group").distinct().count()
    placed = lookup_join(hashed, written(cut, "cut"), ["__group"], groups, [key]).where(F.col("__bucket") <= F.col("__edge"))
    below = placed.where(F.col("__bucket") < F.col("__edge"))
    rank = F.row_number().over(Window.partitionBy("__group").orderBy("__hash", key))
    edge = placed.where(F.col("__bucket") == F.col("__edge")).withColumn("__rank", rank).where(
        F.col("__rank") <= F.col("__rest"))
    return below.select(*columns).unionByName(edge.select(*columns))


def shuffle_rows(df: DataFrame, key: str, seed: int = 42, partitions: int | None = None) -> DataFrame:
    """Put the rows in a repeatable random order: spread by a hash of `key`, sorted by it within each task."""
    draw = F.xxhash64(F.lit(seed), F.col(key))
    args = [partitions] if partitions else []
    return (df.withColumn("__draw", draw).repartitionByRange(*args, "__draw", key)
            .sortWithinPartitions("__draw", key).drop("__draw"))


def fixed_batches(df: DataFrame, size: int, order: Sequence[str], drop_remainder: bool = False,
                  partitions: int | None = None) -> DataFrame:
    """Add `batch_id`: consecutive groups of `size` rows in the order of `order`, which must be unique.

    The last one holds what is left, unless `drop_remainder` leaves it out.
    """
    indexed = row_index(df, order, partitions, "__row", "__total")
    if drop_remainder:
        indexed = indexed.where(F.col("__row") < F.col("__total") - F.pmod("__total", F.lit(size)))
    return indexed.withColumn("batch_id", F.floor(F.col("__row") / F.lit(size))).drop("__row", "__total")


def repeat_epochs(df: DataFrame, epochs: int) -> DataFrame:
    """Every row once per epoch."""
    return df.withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(epochs - 1)))) if epochs > 0 else df.withColumn(
        "epoch", F.lit(0)).where(F.lit(False))


def plan_steps(counts: DataFrame, batch: int = 256, base: int = 0) -> DataFrame:
    """From `dt, n` to the steps of each day and the step count to reach after it."""
    days = Window.orderBy("dt").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    steps = counts.withColumn("steps", F.floor(F.col("n") / F.lit(batch)))
    return steps.withColumn("max_steps", F.sum("steps").over(days) + F.lit(base))


def label_samples(df: DataFrame) -> DataFrame:
    """Derive the labels and request fields of cleaned samples."""
    return df.withColumns({
        "finish_view_label": finish_view_label(F.col("play_ratio")),
        "vip_label": vip_label(F.col("vip_type")),
        "book_pos": clamp_position(F.col("book_pos")),
        "hour": request_hour(F.col("reqtime")),
        "gap_day": F.lit("0"),
    })


def split_malformed(df: DataFrame, kinds: Mapping[str, str]) -> tuple[DataFrame, DataFrame]:
    """Rows whose filled columns all read as their type, and the others, to be set aside and looked at.

    `kinds` maps columns to Spark types.  Missing and blank values are no faults.
    """
    fault = F.lit(False)
    for name, kind in kinds.items():
        text = F.trim(F.col(name).cast("string"))
        fault = fault | F.coalesce((text != "") & text.try_cast(kind).isNull(), F.lit(False))
    return df.where(~fault), df.where(fault)


def split_holdout(df: DataFrame, key: str, share: float, seed: int = 7) -> tuple[DataFrame, DataFrame]:
    """Rows to fit on, and a fixed share of keys to evaluate on."""
    held = keep_share(F.col(key), share, seed)
    return df.where(~held), df.where(held)


def with_crosses(df: DataFrame) -> DataFrame:
    """Add every crossed feature whose three columns are there; one projection."""
    have = {c.lower() for c in df.columns}
    return df.withColumns({name: cross([F.col(p) for p in parts]) for name, parts in crossed_features().items()
                           if all(p in have for p in parts)})


def select_features(df: DataFrame, registry: Registry, keep: Sequence[str] = ()) -> DataFrame:
    """The registry's features that `df` has, in slot order, after the columns in `keep`."""
    return canonical_names(df, registry).select(*keep, *registry.present_in(df.columns).names())


def split_labels(df: DataFrame, labels: Sequence[str] = LABELS, key: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Features without labels, and labels alone; `key` goes with both."""
    features = df.drop(*labels)
    return features, df.select(*([key] if key else []), *labels)


def labels_as_struct(df: DataFrame, labels: Sequence[str] = LABELS) -> DataFrame:
    """One frame with a `features` and a `labels` struct, which avoids a second scan."""
    rest = [c for c in df.columns if c not in set(labels)]
    return df.select(F.struct(*rest).alias("features"), F.struct(*labels).alias("labels"))


def select_by_name_pattern(state: DataFrame, include: Sequence[str] = (), exclude: Sequence[str] = (),
                           skip_global_step: bool = True, column: str = "name") -> DataFrame:
    """State rows whose name matches any `include` pattern (all, if none given) and no `exclude` pattern."""
    exclude = [*exclude, "global_step"] if skip_global_step else list(exclude)
    keep = F.lit(not include)
    for pattern in include:
        keep = keep | F.col(column).rlike(pattern)
    for pattern in exclude:
        keep = keep & ~F.col(column).rlike(pattern)
    return state.where(keep)
