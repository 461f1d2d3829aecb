"""Queries over the sample operators: reading, cleaning, sampling, batching."""

from __future__ import annotations

from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rankflow.functions.text import days_between
from rankflow.operators import metrics, samples
from rankflow.operators.metrics import label_summary
from rankflow.plans import daily, prepare
from rankflow.plans.catalog import NEGATIVE_SQL, md5_sql, on, query
from rankflow.plans.views import samples_view, table
from rankflow.registry import default_registry
from rankflow.session import new_path
from rankflow.sources import samples as source
from rankflow.sources import state
from rankflow.streaming import hourly

REGISTRY = default_registry()


def cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return samples.drop_accidental(samples_view(spark, sf_dir))


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return samples.label_samples(cleaned(spark, sf_dir))


def sampled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return samples.downsample_negatives(labelled(spark, sf_dir), "sample_id")


_SCENE = "concat('scene', cast(sample_id % 2 AS VARCHAR(9)))"


@cache
def stored(spark: SparkSession, sf_dir: str) -> str:
    """The samples as a partitioned table, as a log pipeline would leave them."""
    root = new_path(spark, "samples")
    rows = samples_view(spark, sf_dir).withColumns({"hour": F.col("hr"), "scene_id": F.expr(_SCENE)})
    source.write_samples(rows, root)
    return root


# --- flagship ------------------------------------------------------------------------

@query("label_rates_by_hour_and_bucket", on("sampled", """
SELECT hour, len(list_filter([20, 30, 40, 50, 60, 70, 80, 90, 100, 120, 150, 200], lambda b: b <= coalesce(total_chapter_num, 0))) AS total_chapter_num,
       len(list_filter([0, 1, 2, 3, 5, 10, 15, 19, 32, 44, 76, 119, 140, 166, 265], lambda b: b <= coalesce(shelf_days, 0))) AS shelf_days,
       count(*) AS n, round(avg(ctr_label), 6) AS ctr_rate, round(avg(cvr_label), 6) AS cvr_rate,
       round(avg(unlock_label), 6) AS unlock_rate, round(avg(finish_view_label), 6) AS finish_view_rate
FROM sampled GROUP BY 1, 2, 3"""))
def label_rates_by_hour_and_bucket(spark, sf_dir):
    df = prepare.bucketed(samples.downsample_negatives(prepare.clean(samples_view(spark, sf_dir), REGISTRY), "sample_id"), REGISTRY)
    labels = ["ctr_label", "cvr_label", "unlock_label", "finish_view_label"]
    out = label_summary(df, ["hour", "total_chapter_num", "shelf_days"], labels)
    return out.select("hour", "total_chapter_num", "shelf_days", "n",
                      *[F.round(c, 6).alias(c) for c in ("ctr_rate", "cvr_rate", "unlock_rate", "finish_view_rate")])


# --- A: sources and sinks --------------------------------------------------------------

@query("a1_read_samples", on("samples", f"SELECT sample_id, userid, play_ratio, dt, hr AS hour, {_SCENE} AS scene_id FROM samples"))
def read_all_samples(spark, sf_dir):
    return source.read_samples(spark, stored(spark, sf_dir),
                               columns=["sample_id", "userid", "play_ratio", "dt", "hour", "scene_id"])


@query("a1_read_samples_of_a_day", on("samples", f"""
SELECT sample_id, book_id, ctr_label, hr AS hour FROM samples
WHERE dt = '2024-01-09' AND hr IN ('07', '12') AND {_SCENE} = 'scene1'"""))
def read_day(spark, sf_dir):
    return source.read_samples(spark, stored(spark, sf_dir), "2024-01-09", ["07", "12"], "scene1",
                               ["sample_id", "book_id", "ctr_label", "hour"])


@query("a2_stream_samples", on("cleaned", f"SELECT sample_id, reqtime, ctr_label, mtime_gap, dt, hr AS hour FROM cleaned"))
def stream(spark, sf_dir):
    root = stored(spark, sf_dir)
    schema = source.sample_schema(spark, root)
    live = samples.drop_accidental(hourly.stream_samples(spark, root, schema, files_per_trigger=50))
    out = new_path(spark, "streamed")
    wanted = live.select("sample_id", "reqtime", "ctr_label", "mtime_gap", "dt", "hour")
    hourly.write_available(wanted, out, new_path(spark, "stream_checkpoint")).awaitTermination()
    return spark.read.schema(wanted.schema).parquet(out)


@query("a3_skip_corrupt_files", on("samples", "SELECT sample_id, gender, value_at FROM (SELECT sample_id, gender, shelf_days AS value_at FROM samples)"))
def skip_corrupt(spark, sf_dir):
    root = new_path(spark, "with_corrupt")
    good = samples_view(spark, sf_dir).select("sample_id", "gender", F.col("shelf_days").alias("value_at"))
    good.write.parquet(root)
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root + "/broken.parquet")
    out = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(path)
    out.write(bytearray(b"this is not a parquet file"))
    out.close()
    return source.read_samples(spark, root, schema=good.schema, ignore_corrupt=True)


_TSV = "sample_id long, reqtime string, gender string, vip_type string, tag_set string, play_ratio double"


@query("a4_read_tsv", on("samples", """
SELECT sample_id, reqtime, gender, nullif(vip_type, '') AS vip_type, tag_set, round(play_ratio, 6) + 0.0::DOUBLE AS play_ratio FROM samples"""))
def tsv(spark, sf_dir):
    path, schema = new_path(spark, "tsv"), T.StructType.fromDDL(_TSV)
    source.write_tsv(samples_view(spark, sf_dir).select(*schema.names), path)
    back = source.read_tsv(spark, path, schema)
    return back.withColumn("play_ratio", F.round("play_ratio", 6) + F.lit(0.0))


@query("a5_project_examples", on("labelled", """
SELECT sample_id, coalesce(book_id, '') AS book_id, cast(hour AS BIGINT) AS hour, 0 AS week_day, coalesce(userid, '') AS userid,
       coalesce(mchid, '') AS mchid, coalesce(model, '') AS model, cast(coalesce(trunc(total_chapter_num), 0) AS BIGINT) AS total_chapter_num,
       0 AS page, cast(book_pos AS BIGINT) AS book_pos, concat(CASE WHEN tag_set IS NULL THEN '' ELSE concat(sample_id, ',', sample_id % 7) END, '|') AS ids_text,
       cast(ctr_label AS BIGINT) AS ctr_label, cast(vip_label AS BIGINT) AS vip_label FROM labelled"""))
def examples(spark, sf_dir):
    kinds = source.example_types(REGISTRY)
    ids = F.when(F.col("tag_set").isNotNull(), F.array("sample_id", F.col("sample_id") % 7))
    rows = labelled(spark, sf_dir).withColumn("tag_set", ids).drop(*[c for c in REGISTRY.names("sequence") if c != "tag_set"])
    out = source.project_examples(rows, kinds, ["sample_id"])
    lists = F.concat_ws("|", *[F.array_join(F.col(n).cast("array<string>"), ",") for n in ("tag_set", "search_click_seq")])
    return out.select("sample_id", "book_id", "hour", "week_day", "userid", "mchid", "model", "total_chapter_num", "page",
                      "book_pos", lists.alias("ids_text"), "ctr_label", "vip_label")


@query("a6_read_many", """
SELECT event_id AS id, 'events' AS origin FROM events UNION ALL SELECT o_orderkey AS id, 'orders' AS origin FROM orders""")
def many(spark, sf_dir):
    paths = [new_path(spark, "part_a"), new_path(spark, "part_b")]
    table(spark, sf_dir, "events").select(F.col("event_id").alias("id"), F.lit("events").alias("origin")).write.parquet(paths[0])
    table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.lit("orders").alias("origin")).write.parquet(paths[1])
    return source.read_many(spark, paths)


_MANIFEST = """SELECT dt, count(*) AS n, count(*) % 4 > 0 AS has_input, count(*) % 3 > 0 AS has_model,
    concat('model/', dt, '/model.ckpt-', cast(sum(ctr_label) % 50 AS VARCHAR)) AS path FROM samples GROUP BY dt"""


def manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run manifest with a row per day, made up from the day's counts."""
    days = samples_view(spark, sf_dir).groupBy("dt").agg(F.count(F.lit(1)).alias("n"), F.sum("ctr_label").alias("clicks"))
    return days.select("dt", "n", (F.col("n") % 4 > 0).alias("has_input"), (F.col("n") % 3 > 0).alias("has_model"),
                       F.concat(F.lit("model/"), "dt", F.lit("/model.ckpt-"), (F.col("clicks") % 50).cast("string")).alias("path"))


_VERSION = "cast(nullif(regexp_extract(path, 'ckpt-([0-9]+)', 1), '') AS BIGINT)"


@query("a9_list_ready_partitions", on("samples", "SELECT dt FROM manifest WHERE has_input", manifest=_MANIFEST))
def ready(spark, sf_dir):
    return state.list_ready_partitions(manifest(spark, sf_dir))


@query("a9_ready_partitions", on("samples", "SELECT DISTINCT dt, sample_id_hash AS ready FROM (SELECT dt, count(*) % 2 = 0 AS sample_id_hash FROM samples GROUP BY dt)"))
def marked(spark, sf_dir):
    """Days whose folder holds a marker file; the days with an even number of rows get one."""
    root = new_path(spark, "marked")
    rows = samples_view(spark, sf_dir).select("sample_id", "dt")
    rows.write.partitionBy("dt").option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(root)
    jvm = spark.sparkContext._jvm
    fs = jvm.org.apache.hadoop.fs.Path(root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for r in rows.groupBy("dt").count().where("count % 2 = 0").collect():  # a row per day
        fs.create(jvm.org.apache.hadoop.fs.Path(f"{root}/dt={r.dt}", "_SUCCESS")).close()
    return state.ready_partitions(spark, root)


@query("a10_latest_version", on("samples", f"SELECT has_input, max({_VERSION}) AS version FROM manifest GROUP BY has_input", manifest=_MANIFEST))
def newest(spark, sf_dir):
    return state.latest_version(manifest(spark, sf_dir), "has_input")


# --- B: projections, filters, labels ---------------------------------------------------

@query("b1_canonical_names", on("samples", """
SELECT sample_id, useritemwatchleftforpay AS "userItemWatchLeftForPay",
       userclickbooklistlatestgender AS "userClickBookListLatestGender", gender FROM samples"""))
def names(spark, sf_dir):
    df = samples.canonical_names(samples_view(spark, sf_dir), REGISTRY)
    return df.select("sample_id", "userItemWatchLeftForPay", "userClickBookListLatestGender", "gender")


@query("b2_drop_accidental", on("cleaned", "SELECT sample_id, mtime_gap, play_ratio, ctr_label FROM cleaned"))
def drop(spark, sf_dir):
    return cleaned(spark, sf_dir).select("sample_id", "mtime_gap", "play_ratio", "ctr_label")


@query("b3_b7_labels_and_request_fields", on("labelled", """
SELECT sample_id, finish_view_label, vip_label, book_pos, hour, gap_day FROM labelled"""))
def label_fields(spark, sf_dir):
    return labelled(spark, sf_dir).select("sample_id", "finish_view_label", "vip_label", "book_pos", "hour", "gap_day")


@query("b8_select_features", on("labelled", """
SELECT sample_id, book_id, gender, cast(hour AS INT) AS hour, mbid, language, vip_type, gap_day, userid, total_chapter_num, shelf_days,
       useritemwatchleftforpay AS "userItemWatchLeftForPay", tag_set, userclickbooklistlatestbookid AS "userClickBookListLatestBookId",
       userclickbooklistlatestgapday AS "userClickBookListLatestGapDay", userclickbooklistlatestgender AS "userClickBookListLatestGender",
       mchid, model, book_pos FROM labelled"""))
def features(spark, sf_dir):
    return samples.select_features(labelled(spark, sf_dir), REGISTRY, ["sample_id"])


@query("b9_split_labels", on("labelled", """
SELECT sample_id, ctr_label, cvr_label, vip_label, unlock_label, finish_view_label FROM labelled"""))
def only_labels(spark, sf_dir):
    return samples.split_labels(labelled(spark, sf_dir), key="sample_id")[1]


@query("b10_select_by_name_pattern", """
SELECT vec_id, name FROM (SELECT vec_id, CASE WHEN vec_id % 50 = 0 THEN 'global_step'
    ELSE concat(CASE vec_id % 3 WHEN 0 THEN 'emb' WHEN 1 THEN 'expert' ELSE 'gate' END, '/', cast(label AS VARCHAR), '/w') END AS name FROM embeddings)
WHERE (regexp_matches(name, '^emb/') OR regexp_matches(name, 'gate|global')) AND NOT regexp_matches(name, '/[13]/') AND NOT regexp_matches(name, 'global_step')""")
def by_pattern(spark, sf_dir):
    kind = F.when(F.col("vec_id") % 3 == 0, "emb").when(F.col("vec_id") % 3 == 1, "expert").otherwise("gate")
    name = F.when(F.col("vec_id") % 50 == 0, "global_step").otherwise(F.concat(kind, F.lit("/"), F.col("label").cast("string"), F.lit("/w")))
    rows = table(spark, sf_dir, "embeddings").select("vec_id", name.alias("name"))
    return samples.select_by_name_pattern(rows, ["^emb/", "gate|global"], ["/[13]/"])


@query("b11_gate_and_history_features", on("samples", """
SELECT sample_id, language, vip_type, shelf_days, userclickbooklistlatestbookid AS "userClickBookListLatestBookId",
       userclickbooklistlatestgapday AS "userClickBookListLatestGapDay", userclickbooklistlatestgender AS "userClickBookListLatestGender" FROM samples"""))
def subsets(spark, sf_dir):
    df = samples.canonical_names(samples_view(spark, sf_dir), REGISTRY)
    wanted = REGISTRY.gate_features() + REGISTRY.history_features()
    return df.select("sample_id", *[n for n in wanted if n in df.columns])


# --- C: sampling, shuffling, batching -----------------------------------------------------

@query("c1_split_negatives", on("labelled", f"SELECT sample_id, {NEGATIVE_SQL} AS is_negative FROM labelled"))
def negatives(spark, sf_dir):
    return samples.split_negatives(labelled(spark, sf_dir)).select("sample_id", "is_negative")


@query("c2_downsample_negatives", on("sampled", "SELECT sample_id, ctr_label, play_ratio FROM sampled"))
def downsample(spark, sf_dir):
    return sampled(spark, sf_dir).select("sample_id", "ctr_label", "play_ratio")


@query("c3_exact_sample", on("labelled", f"""
SELECT sample_id, event_day FROM (
  SELECT sample_id, event_day, row_number() OVER (PARTITION BY event_day ORDER BY {md5_sql("concat('42:', cast(sample_id AS VARCHAR))")}, sample_id) AS rn,
         count(*) OVER (PARTITION BY event_day) AS n FROM (SELECT sample_id, CASE WHEN dt <> '2024-01-05' THEN dt END AS event_day FROM labelled))
WHERE rn <= round_even(n * 0.5, 0)"""))
def exact(spark, sf_dir):
    df = labelled(spark, sf_dir).select("sample_id", F.when(F.col("dt") != "2024-01-05", F.col("dt")).alias("event_day"))
    return samples.exact_sample(df, 0.5, "event_day", "sample_id")


@query("c4_union_back", on("sampled", "SELECT sample_id, unlock_label FROM sampled"))
def union_back(spark, sf_dir):
    return samples.downsample_by_union(labelled(spark, sf_dir), "sample_id").select("sample_id", "unlock_label")


@query("c5_shuffle", on("labelled", "SELECT sample_id, userid FROM labelled"))
def shuffled(spark, sf_dir):
    return samples.shuffle_rows(labelled(spark, sf_dir).select("sample_id", "userid"), "sample_id")


@query("c6_fixed_batches", on("labelled", """
SELECT sample_id, cast(floor((row_number() OVER (ORDER BY sample_id) - 1) / 512) AS BIGINT) AS batch_id FROM labelled"""))
def batches(spark, sf_dir):
    return samples.fixed_batches(labelled(spark, sf_dir).select("sample_id"), 512, ["sample_id"])


@query("c7_repeat_epochs", on("labelled", "SELECT sample_id, ctr_label, unnest([0, 1, 2]) AS epoch FROM labelled"))
def epochs(spark, sf_dir):
    return samples.repeat_epochs(labelled(spark, sf_dir).select("sample_id", "ctr_label"), 3)


@query("c8_plan_steps", on("labelled", """
SELECT dt, n, steps, cast(sum(steps) OVER (ORDER BY dt) + 1000 AS BIGINT) AS max_steps
FROM (SELECT dt, count(*) AS n, count(*) // 256 AS steps FROM labelled GROUP BY dt)"""))
def steps(spark, sf_dir):
    return samples.plan_steps(metrics.daily_counts(labelled(spark, sf_dir)), 256, 1000)


# --- L: daily run ---------------------------------------------------------------------------

_DAILY = {"manifest": _MANIFEST, "versions": f"SELECT *, {_VERSION} AS version FROM manifest",
          "moved": "SELECT *, coalesce(version > coalesce(lag(version) OVER (ORDER BY dt), -1), false) AS advanced FROM versions"}


def versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest(spark, sf_dir).withColumn("version", state.version_of("path"))


@query("l1_pending_days", on("samples", """
SELECT cast(d AS DATE)::VARCHAR AS dt FROM (SELECT unnest(generate_series(min(dt)::DATE, max(dt)::DATE + 3, INTERVAL 1 DAY)) AS d FROM samples)
WHERE cast(d AS DATE)::VARCHAR IN (SELECT dt FROM moved WHERE has_input)
  AND cast(d AS DATE)::VARCHAR NOT IN (SELECT dt FROM moved WHERE has_model AND advanced)""", **_DAILY))
def pending(spark, sf_dir):
    ends = samples_view(spark, sf_dir).agg(F.min(F.to_date("dt")).alias("a"), F.date_add(F.max(F.to_date("dt")), 3).alias("b"))
    calendar = ends.select(F.explode(days_between(F.col("a"), F.col("b"))).alias("d")).select(F.date_format("d", "yyyy-MM-dd").alias("dt"))
    return daily.pending_days(calendar, versions(spark, sf_dir))


@query("l2_advanced", on("samples", "SELECT dt, version, advanced FROM moved", **_DAILY))
def moved_on(spark, sf_dir):
    return daily.advanced(versions(spark, sf_dir)).select("dt", "version", "advanced")
