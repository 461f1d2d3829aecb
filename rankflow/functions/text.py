"""String, date and list column functions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

GAP_LIMIT = 190
_DATE_TIME = r"^\d{4}-\d{1,2}-\d{1,2} \d{1,2}:\d{1,2}:\d{1,2}$"
_DAY_SECONDS = 86_400


def extract_tags(col: Column) -> Column:
    """Drop each comma item's prefix up to its first underscore; 'unknown' if any item has none."""
    bare_item = col.rlike(r"(^|,)[^,_]*(,|\z)")
    stripped = F.regexp_replace(col, r"(^|,)[^,_]*_", "$1")
    return F.when(F.coalesce(bare_item, F.lit(True)), F.lit("unknown")).otherwise(stripped)


def _moment(col: Column) -> Column:
    text = col.cast("string")
    return F.when(text.rlike(_DATE_TIME), text.try_cast("timestamp_ntz"))


def elapsed_days(later: Column, earlier: Column) -> Column:
    """Whole days between two 'yyyy-MM-dd HH:mm:ss' texts, rounded down; -1 if either is unusable."""
    seconds = F.timestamp_diff("SECOND", _moment(earlier), _moment(later))
    return F.coalesce(F.floor(seconds / F.lit(_DAY_SECONDS)), F.lit(-1)).cast("int")


def date_range(spark: SparkSession, start: str, end: str) -> DataFrame:
    """Every day from start to end as `dt` text; only start if end is not later."""
    days = F.sequence(F.to_date(F.lit(start)), F.greatest(F.to_date(F.lit(start)), F.to_date(F.lit(end))))
    return spark.range(1).select(F.explode(days).alias("d")).select(F.date_format("d", "yyyy-MM-dd").alias("dt"))


def days_between(start: Column, end: Column) -> Column:
    """Array form of `date_range` for two date columns."""
    return F.sequence(start, F.greatest(start, end))


def parse_flag(col: Column, strict: bool = True) -> Column:
    """yes/true/t/1 and no/false/f/0 as boolean; anything else fails, or is null if not strict."""
    word = F.lower(col)
    parsed = F.when(word.isin("yes", "true", "t", "1"), F.lit(True)).when(
        word.isin("no", "false", "f", "0"), F.lit(False))
    if not strict:
        return parsed
    message = F.concat(F.lit("not a flag: "), F.coalesce(col, F.lit("null")))
    return F.coalesce(parsed, F.raise_error(message).cast("boolean"))


def normalise_category(col: Column) -> Column:
    return F.lower(F.coalesce(col.cast("string"), F.lit("unknown")))


def cross(parts: Sequence[Column]) -> Column:
    """Several categories as one: their normalised texts joined by underscores, a missing one as 'unknown'."""
    return F.concat_ws("_", *[normalise_category(p) for p in parts])


def parse_id_list(col: Column) -> Column:
    return F.split(F.translate(col.cast("string"), "_", ","), ",")


def clamp_gap(items: Column, limit: int = GAP_LIMIT) -> Column:
    """Cap the whole numbers in a list of texts; blanks stay, anything else becomes null."""
    def capped(x: Column) -> Column:
        number = x.try_cast("int")
        return F.when(x == "", x).when(number > limit, F.lit(str(limit))).otherwise(number.cast("string"))
    return F.transform(items, capped)


def pad_truncate(items: Column, length: int, fill: Column | None = None) -> Column:
    """The first `length` items, padded on the right; a null list is all padding."""
    pad = F.array_repeat(F.lit(0) if fill is None else fill, length)
    return F.slice(F.concat(F.coalesce(items, F.slice(pad, 1, 0)), pad), 1, length)


def boundaries_text(spec: DataFrame) -> DataFrame:
    """Feature spec rows with their boundaries as one comma-separated text."""
    return spec.where(F.size("boundaries") > 0).select(
        F.col("name"), F.array_join(F.col("boundaries").cast("array<string>"), ",").alias("boundaries_text"))


def rename_map(columns: Sequence[str], wanted: Sequence[str]) -> dict[str, str]:
    """Columns whose spelling differs from a wanted name only by case."""
    by_lower = {w.lower(): w for w in wanted}
    return {c: by_lower[c.lower()] for c in columns if by_lower.get(c.lower(), c) != c}
