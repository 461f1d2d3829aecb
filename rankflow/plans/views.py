"""Impression samples as a view over the `events` table.

The expressions are plain SQL that Spark and DuckDB read alike, so that a query and
its SQL twin start from the same rows.  Columns have the lower-cased names in which
samples are stored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

SAMPLE_COLUMNS = {
    "sample_id": "event_id",
    "userid": "cast(user_id as string)",
    "book_id": "concat('B', cast(k as string))",
    "mbid": "case when k % 19 = 0 then null when k % 23 = 0 then '  ' else concat('b', cast((k * 3) % 120 as string)) end",
    "gender": "case k % 4 when 0 then 'M' when 1 then 'F' when 2 then null else 'f' end",
    "language": "case user_id % 5 when 0 then 'en' when 1 then 'EN' when 2 then 'es' when 3 then null else 'pt' end",
    "dt": "substr(tss, 1, 10)",
    "hr": "substr(tss, 12, 2)",
    "reqtime": "case when event_id % 211 = 0 then '2024' else substr(tss, 1, 19) end",
    "lastwatchtime": "case when event_id % 53 = 0 then '' when event_id % 59 = 0 then 'soon' else concat('2024-01-', case when k % 30 < 9 then '0' else '' end, cast(k % 30 + 1 as string), ' 06:30:15') end",
    "ctr_label": "case when event_type in ('click', 'purchase', 'signup') then 1 else 0 end",
    "cvr_label": "case when event_type = 'purchase' then 1 else 0 end",
    "unlock_label": "case when event_type = 'signup' then 1 else 0 end",
    "play_ratio": "case when event_id % 97 = 0 then null else least(value / cast(100 as double), cast(1 as double)) end",
    "mtime_gap": "case when event_id % 89 = 0 then null else (event_id * 7) % 180 end",
    "vip_type": "case event_id % 5 when 0 then '' when 1 then null when 2 then '0' when 3 then '1' else '2' end",
    "book_pos": "case when k % 13 = 0 then null else k end",
    "mchid": "case when user_id % 37 = 0 then '' else concat('ch', cast((user_id * 31) % 40 as string)) end",
    "model": "case when k % 41 = 0 then null else concat('m', cast((k * 7) % 60 as string)) end",
    "tag_set": "case when k % 29 = 0 then null when k % 23 = 0 then 'plain' else concat('1_t', cast(k % 7 as string), ',2_t', cast(k % 11 as string)) end",
    "userclickbooklistlatestbookid": "case when k % 31 = 0 then null when k % 37 = 0 then '' when k % 11 = 0 then repeat(concat('B', cast(k as string), ',B', cast((k * 7) % 100 as string), '_'), 12) else concat('B', cast((k * 3) % 100 as string), ',B', cast((k + 17) % 100 as string), '_X', cast(k % 5 as string)) end",
    "userclickbooklistlatestgapday": "case when k % 31 = 0 then null else concat(cast(k as string), '_', cast(k * 3 as string), ',') end",
    "userclickbooklistlatestgender": "case when k % 31 = 0 then null when k % 2 = 0 then 'M,F_M' else 'F' end",
    "total_chapter_num": "case when k % 17 = 0 then null else cast(k * 2 as double) end",
    "shelf_days": "cast(event_id % 400 as double)",
    "useritemwatchleftforpay": "value - cast(5 as double)",
}

_FROM_EVENTS = ("SELECT *, cast(regexp_extract(props, '[0-9]+', 0) as int) AS k, "
                "cast(ts as string) AS tss FROM events")

SAMPLES_SQL = ("SELECT " + ", ".join(f"{e} AS {n}" for n, e in SAMPLE_COLUMNS.items())
               + f" FROM ({_FROM_EVENTS}) AS e")

# Head scores as ratios of whole numbers, so that both engines agree to the last bit.
SCORE_COLUMNS = {
    "ctr": "cast((sample_id * 37) % 1009 + 300 * ctr_label as double) / cast(1400 as double)",
    "fvtr": "cast((sample_id * 53) % 997 + 200 * finish_view_label as double) / cast(1300 as double)",
    "unlock": "cast((sample_id * 71) % 991 + 250 * unlock_label as double) / cast(1350 as double)",
    "cvr": "cast((sample_id * 89) % 983 + 350 * cvr_label as double) / cast(1500 as double)",
    "pos": "cast(100 - least(coalesce(book_pos, 60), 60) as double) / cast(100 as double)",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def samples_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sample columns over `events`; unused ones are pruned down to the scan."""
    events = table(spark, sf_dir, "events").selectExpr(
        "*", "cast(regexp_extract(props, '[0-9]+', 0) as int) AS k", "cast(ts as string) AS tss")
    return events.selectExpr(*[f"{e} AS {n}" for n, e in SAMPLE_COLUMNS.items()])
