"""Sketches kept per day and merged: errors over a month, exactness for few values, and the forms that use them."""

import bisect

import pytest
from pyspark.sql import functions as F

from rankflow.operators import sketches, vocab
from rankflow.registry import default_registry
from rankflow.session import new_path, written

DAYS = 30


@pytest.fixture(scope="module")
def month(spark):
    """300,000 rows of 30 days; one day has a third of them."""
    skew = F.when(F.col("id") % 3 == 0, 4).otherwise(F.pmod(F.xxhash64("id"), F.lit(DAYS)))
    u = F.pmod(F.xxhash64(F.col("id") + 1), F.lit(1 << 30)) / float(1 << 30)
    df = spark.range(300_000).select(skew.alias("day"), (F.exp(4 * u) * 100).alias("price"), F.floor(u * 50).alias("few"),
                                     F.floor(F.pow(u, F.lit(6.0)) * 200_000).cast("string").alias("item"),
                                     F.when(F.col("id") % 7 == 0, "").when(F.col("id") % 11 == 0, None).otherwise(F.concat(F.lit("m"), (F.col("id") % 40).cast("string"))).alias("model"))
    return written(df, "month")


def day_by_day(df, make, spark, name):
    """Each day's table written on its own, as daily runs do."""
    path = new_path(spark, name)
    for d in range(DAYS):
        make(df.where(F.col("day") == d)).write.mode("append").parquet(path)
    return spark.read.parquet(path)


def test_boundaries_of_a_month(spark, month):
    size = 500
    days = day_by_day(month, lambda df: sketches.daily_quantile_sketches(df, "day", ["price", "few"], size), spark, "quantiles")
    assert days.count() == 2 * DAYS
    cuts = written(sketches.merged_boundaries(days, 20), "cuts")
    got = {r["name"]: r for r in cuts.collect()}
    values = sorted(r.price for r in month.select("price").collect())
    assert got["price"].n == 300_000 and len(got["price"].boundaries) == 19
    for i, b in enumerate(got["price"].boundaries, 1):
        assert abs(bisect.bisect_left(values, b) / len(values) - i / 20) <= sketches.rank_error(size) + 1e-5
    assert got["few"].boundaries == sorted(set(got["few"].boundaries)) and len(got["few"].boundaries) <= 19
    registry = default_registry().with_dense(sketches.registry_boundaries(cuts, 9000))
    assert list(registry["price"].boundaries) == got["price"].boundaries


def test_some_days_and_missing_values(spark):
    df = spark.createDataFrame([(1, 1.0, None), (1, float("nan"), None), (2, 3.0, None), (2, 2.0, None), (3, 100.0, None)], "day int, a double, b double")
    days = sketches.daily_quantile_sketches(df, "day", ["a", "b"])
    got = {r["name"]: (r.n, r.boundaries) for r in sketches.merged_boundaries(days.where("day < 3"), 3).collect()}
    assert got == {"a": (3, [1.0, 2.0]), "b": (0, [])}
    assert sketches.daily_quantile_sketches(df.where("false"), "day", ["a"]).count() == 0
    for wrong in (3, 10**6):
        with pytest.raises(ValueError):
            sketches.daily_quantile_sketches(df, "day", ["a"], wrong)


def test_frequent_values_of_a_month(spark, month):
    tracked = 2048
    days = day_by_day(month, lambda df: sketches.daily_top_sketches(df, "day", ["item", "model"], tracked), spark, "tops")
    assert days.count() == 2 * DAYS
    counts = {(r.feature, r.value): r.cnt for r in sketches.merged_counts(days, {"item": 50, "model": 60}, tracked).collect()}
    exact = {(r.feature, r.value): r.cnt for r in vocab.count_values(month, ["item", "model"]).collect()}
    # the few models are counted exactly, without blank and missing ones
    assert {k: n for k, n in counts.items() if k[0] == "model"} == {k: n for k, n in exact.items() if k[0] == "model"}
    slack = sketches.count_error(tracked) * 300_000
    items = sorted((-n, v) for (f, v), n in exact.items() if f == "item")
    assert len(items) > 10 * tracked
    assert all(abs(n - exact[k]) <= slack for k, n in counts.items())
    # no value is missed whose count is above the fiftieth's by more than the error
    kept = {v for f, v in counts if f == "item"}
    assert all(v in kept for n, v in items if -n > -items[49][0] + 2 * slack)


def test_rank_maps_from_sketches(spark, month):
    tops = {"model": 10}
    days = sketches.daily_top_sketches(month, "day", ["model"])
    ranks = vocab.rank_vocab(sketches.merged_counts(days, tops), tops)
    assert {tuple(r) for r in ranks.collect()} == {tuple(r) for r in vocab.rank_vocab(vocab.count_values(month, ["model"]), tops).collect()}
