"""Counts of the last hours, as a batch or as a stream with late rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def hourly_counts(events: DataFrame, keys: Sequence[str], time: str, user: str | None = None, late: str | None = None,
                  precision: int = 12) -> DataFrame:
    """Per hour (a window) and key, the number of events `pv` and, with `user`, a sketch `users` of the different users.

    For a stream, `late` says how long rows of an hour may still arrive; later ones are dropped, and that is all the state
    Spark keeps: one row per open hour and key.  Rows without a time are left out.
    """
    timed = events.where(F.col(time).isNotNull()).withColumn(time, F.col(time).cast("timestamp"))
    if late is not None:
        timed = timed.withWatermark(time, late)
    sketch = [F.hll_sketch_agg(user, precision).alias("users")] if user else []
    return timed.groupBy(F.window(time, "1 hour").alias("hour"), *keys).agg(F.count(F.lit(1)).alias("pv"), *sketch)


def recent_window_counts(hourly: DataFrame, keys: Sequence[str], hours: Sequence[int] = (1, 6, 12, 24)) -> DataFrame:
    """Per key and full hour `as_of`, the events `pv_<h>h` and estimated users `uv_<h>h` of the last h hours.

    There is a row for each hour at which the longest window holds an event.  Each hourly row goes to the sliding windows that
    hold it, and all lengths are read from the longest one by the age of the hours in it.  The same expression serves a batch and a stream:
    there it is a second aggregate behind the hourly one, and both are final (append mode) once the watermark has passed.
    """
    longest = max(hours)
    placed = hourly.withColumn("__end", F.window_time("hour"))
    placed = placed.withColumn("__span", F.window("__end", f"{longest} hours", "1 hour"))
    age = (F.unix_timestamp("__span.end") - F.unix_timestamp("hour.end")) / 3600
    sums = [F.sum(F.when(age < h, F.col("pv")).otherwise(0)).alias(f"pv_{h}h") for h in hours]
    sketches = [h for h in hours if "users" in hourly.columns]
    sums += [F.hll_union_agg(F.when(age < h, F.col("users"))).alias(f"__u_{h}") for h in sketches]
    out = placed.groupBy("__span", *keys).agg(*sums)
    return out.select(*keys, F.col("__span.end").alias("as_of"), *[f"pv_{h}h" for h in hours],
                      *[F.coalesce(F.hll_sketch_estimate(f"__u_{h}"), F.lit(0)).alias(f"uv_{h}h") for h in sketches])
