"""The daily run as tables: which days to fit, and whether a run moved on."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def pending_days(calendar: DataFrame, manifest: DataFrame) -> DataFrame:
    """Days of the calendar with complete input and no finished model that moved on from the day before."""
    done = advanced(manifest).where("has_model AND advanced").select("dt")
    ready = manifest.where("has_input").select("dt")
    return calendar.join(ready, "dt", "left_semi").join(done, "dt", "left_anti")


def advanced(manifest: DataFrame) -> DataFrame:
    """Manifest rows with whether the version exceeds the previous day's; a missing version counts as none.

    A manifest has one row per day.
    """
    before = F.lag("version").over(Window.orderBy("dt"))
    return manifest.withColumn("advanced", F.coalesce(F.col("version") > F.coalesce(before, F.lit(-1)), F.lit(False)))
