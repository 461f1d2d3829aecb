"""Quantiles and frequent values over many days, from one small sketch per day and column.

Each day's rows are read once and leave a row per column; boundaries and rank maps for any run of days come from merging those rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed limits of the two kinds of sketches.
LARGEST_QUANTILE_SIZE = 65_535
LARGEST_TRACKED = 1_000_000


def rank_error(size: int) -> float:
    """The largest expected distance, as a share of the rows, of a boundary's rank from the rank that was asked for, at 99 % confidence.

    The published bound of the quantile sketch, 2.296 / size ** 0.9021.  Columns with fewer rows than `size` are exact.
    """
    return 2.296 / size ** 0.9021


def daily_quantile_sketches(df: DataFrame, day: str, cols: Sequence[str], size: int = 2_000) -> DataFrame:
    """Per day and column a sketch of its values: `day, name, sketch`.  Missing values are left out.

    All columns go through one aggregation, partly done before the shuffle, so a day with much of the data is no hot key.
    """
    if not 8 <= size <= LARGEST_QUANTILE_SIZE:
        raise ValueError(f"size must be between 8 and {LARGEST_QUANTILE_SIZE}")
    value = {c: F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double")) for c in cols}
    wide = df.groupBy(day).agg(*[F.kll_sketch_agg_double(v, size).alias(f"__{i}") for i, v in enumerate(value.values())])
    rows = F.array(*[F.struct(F.lit(c).alias("name"), F.col(f"__{i}").alias("sketch")) for i, c in enumerate(cols)])
    return wide.select(day, F.explode(rows).alias("r")).select(day, "r.name", "r.sketch")


def merged_boundaries(sketches: DataFrame, parts: int) -> DataFrame:
    """`name, n, boundaries`: the cuts of each column into `parts` groups of about equal size over all days given, ascending and distinct.

    A column without values has none.  Sketches larger than their size are thinned at random, so write the result and use that: two
    evaluations differ within the error.
    """
    probs = F.array(*[F.lit(i / parts) for i in range(1, parts)])
    merged = sketches.groupBy("name").agg(F.kll_merge_agg_double("sketch").alias("s"))
    n = F.kll_sketch_get_n_double("s")
    counted = merged.select("name", n.alias("n"), "s")
    none = F.array().cast("array<double>")
    return counted.select("name", "n", F.when(F.col("n") > 0, F.array_distinct(F.kll_sketch_get_quantile_double("s", probs))).otherwise(none).alias("boundaries"))


def registry_boundaries(boundaries: DataFrame, first_slot: int) -> list[tuple[int, str, list[float]]]:
    """The boundaries as a spec for `Registry.with_dense`; one row per column, a few hundred at most."""
    rows = sorted((r.name, r.boundaries) for r in boundaries.where(F.size("boundaries") > 0).collect())
    return [(first_slot + i, name, list(cuts)) for i, (name, cuts) in enumerate(rows)]


def _accumulate(value: Column, tracked: int) -> Column:
    return F.call_function("approx_top_k_accumulate", value, F.lit(tracked))


def count_error(tracked: int) -> float:
    """How far a count from a sketch may be off, as a share of the rows: the published bound for a table of that size.

    With fewer than three quarters of `tracked` different values the counts are exact.
    """
    return 3.5 / (1 << (tracked - 1).bit_length())


def daily_top_sketches(df: DataFrame, day: str, cols: Sequence[str], tracked: int = 10_000) -> DataFrame:
    """Per day and column a sketch of its most frequent non-empty values: `day, name, sketch`."""
    if not 1 <= tracked <= LARGEST_TRACKED:
        raise ValueError(f"tracked must be between 1 and {LARGEST_TRACKED}")
    text = {c: F.when(F.col(c).cast("string") != "", F.col(c).cast("string")) for c in cols}
    wide = df.groupBy(day).agg(*[_accumulate(t, tracked).alias(f"__{i}") for i, t in enumerate(text.values())])
    rows = F.array(*[F.struct(F.lit(c).alias("name"), F.col(f"__{i}").alias("sketch")) for i, c in enumerate(cols)])
    return wide.select(day, F.explode(rows).alias("r")).select(day, "r.name", "r.sketch")


def merged_counts(sketches: DataFrame, tops: Mapping[str, int], tracked: int = 10_000) -> DataFrame:
    """`feature, value, cnt` of the most frequent values over all days given, as `rank_vocab` takes them.

    Twice the wanted number is kept of each column, so that ties at the edge are ranked by value as usual.
    """
    merged = sketches.where(F.col("name").isin(list(tops))).groupBy("name").agg(
        F.call_function("approx_top_k_combine", F.col("sketch"), F.lit(tracked)).alias("s"))
    most = min(tracked, 2 * max(tops.values()))
    items = merged.select("name", F.explode(F.call_function("approx_top_k_estimate", F.col("s"), F.lit(most))).alias("i"))
    return items.select(F.col("name").alias("feature"), F.col("i.item").alias("value"), F.col("i.count").alias("cnt")).where("value IS NOT NULL")
