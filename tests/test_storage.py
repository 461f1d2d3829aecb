"""Sources, sinks, the file stream, the daily tables and plan shapes."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rankflow.operators import samples, vocab
from rankflow.plans import daily
from rankflow.registry import default_registry
from rankflow.session import new_path, written
from rankflow.sources import samples as source
from rankflow.sources import state
from rankflow.streaming import hourly


def hours(spark):
    return spark.range(96).select(
        F.col("id").alias("sample_id"), F.when(F.col("id") % 2 == 0, "2024-01-01").otherwise("2024-01-02").alias("dt"),
        F.lpad((F.col("id") % 4).cast("string"), 2, "0").alias("hour"), F.concat(F.lit("s"), (F.col("id") % 3).cast("string")).alias("scene_id"),
        (F.col("id") % 7).alias("mtime_gap"), F.lit(0.05).alias("play_ratio"), F.lit(0).alias("ctr_label"), F.lit(0).alias("cvr_label"),
        (F.col("id") % 5 == 0).cast("int").alias("unlock_label"), F.lit("x").alias("wide"))


def test_partitions_and_columns_are_pruned(spark):
    root = new_path(spark, "t")
    source.write_samples(hours(spark), root)
    df = source.read_samples(spark, root, "2024-01-01", ["00"], "s1", ["sample_id"])
    assert sorted(r.sample_id for r in df.collect()) == [i for i in range(96) if i % 4 == 0 and i % 3 == 1]
    plan = df._jdf.queryExecution().executedPlan().toString()
    filters = plan.split("PartitionFilters: [")[1].split("]")[0]
    assert all(c in filters for c in ("dt#", "hour#", "scene_id#"))
    assert plan.split("ReadSchema: ")[1].startswith("struct<sample_id:bigint>")


def test_tsv(spark):
    path = new_path(spark, "tsv")
    spark.createDataFrame([('1\t"a"b\t\\N\t2.5',), ("2\t\tNaN\t\\N",)], "value string").coalesce(1).write.text(path)
    rows = source.read_tsv(spark, path, T.StructType.fromDDL("a int, b string, c string, d double")).orderBy("a").collect()
    assert [tuple(r) for r in rows] == [(1, '"a"b', None, 2.5), (2, None, None, None)]


def test_examples_have_defaults(spark):
    df = spark.createDataFrame([("5", None, [1, 2], "u1"), ("x", "b", None, None)], "WEEK_DAY string, book_id string, tag_set array<int>, userid string")
    kinds = source.example_types(default_registry())
    rows = source.project_examples(df, kinds).collect()
    assert [(r.week_day, r.book_id, r.tag_set, r.userid, r.shelf_days, r.ctr_label) for r in rows] == [
        (5, "", [1, 2], "u1", 0, 0), (0, "b", [], "", 0, 0)]
    ints = source.example_types(default_registry(), int_only=True)
    assert ints["book_id"] == "int" and ints["userid"] == "text" and ints["tag_set"] == "list"


def test_feature_map_and_ready_days(spark):
    path = new_path(spark, "map")
    assert state.read_feature_map(spark, path).count() == 0
    words = spark.createDataFrame([("a", "x", 1), ("b", "y", 0)], vocab.VOCAB_SCHEMA)
    state.write_feature_map(words, path)
    assert {tuple(r) for r in state.read_feature_map(spark, path).collect()} == {("a", "x", 1), ("b", "y", 0)}
    root = new_path(spark, "days")
    spark.range(1).write.parquet(f"{root}/dt=2024-01-01")
    spark.range(1).write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(f"{root}/dt=2024-01-02")
    assert {r.dt: r.ready for r in state.ready_partitions(spark, root).collect()} == {"2024-01-01": True, "2024-01-02": False}


def test_stream_takes_each_file_once_and_equals_batch(spark):
    root, out, checkpoint = (new_path(spark, n) for n in ("in", "out", "check"))
    day = lambda d: hours(spark).where(F.col("dt") == d)
    source.write_samples(day("2024-01-01"), root)
    schema = source.sample_schema(spark, root)

    def run():
        live = samples.drop_accidental(hourly.stream_samples(spark, root, schema, 3))
        hourly.write_available(live, out, checkpoint).awaitTermination()
        return sorted(r.sample_id for r in spark.read.parquet(out).collect())

    batch = lambda: sorted(r.sample_id for r in samples.drop_accidental(source.read_samples(spark, root)).collect())
    assert run() == batch()
    source.write_samples(day("2024-01-02"), root, mode="append")
    assert run() == batch() and len(batch()) == 20
    assert run() == batch()


def test_stream_extends_a_vocabulary(spark):
    root, checkpoint = new_path(spark, "in"), new_path(spark, "check")
    spark.createDataFrame([("a", "x", 1), ("a", "y", 2)], "emb_name string, value string, first_seen long").coalesce(1).write.parquet(root)
    versions = [vocab.empty_vocab(spark)]
    grow = lambda df, _: versions.append(written(vocab.extend_vocab(df, versions[-1], {"a": 10}), "vocab"))
    values = lambda: hourly.stream_samples(spark, root, T.StructType.fromDDL("emb_name string, value string, first_seen long"))
    hourly.for_each_batch(values(), grow, checkpoint).awaitTermination()
    spark.createDataFrame([("a", "x", 1), ("a", "b", 3)], "emb_name string, value string, first_seen long").coalesce(1).write.mode("append").parquet(root)
    hourly.for_each_batch(values(), grow, checkpoint).awaitTermination()
    assert {r.value: r.id for r in versions[-1].collect()} == {"x": 1, "y": 2, "b": 3}


def test_daily_tables(spark):
    days = spark.createDataFrame([(f"2024-01-0{i}",) for i in range(1, 7)], "dt string")
    manifest = spark.createDataFrame([
        ("2024-01-01", True, True, "m/ckpt-10"), ("2024-01-02", True, True, "m/ckpt-10"), ("2024-01-03", True, True, "m/ckpt-30"),
        ("2024-01-04", False, False, None), ("2024-01-05", True, False, "m/none")], "dt string, has_input boolean, has_model boolean, path string")
    manifest = manifest.withColumn("version", state.version_of("path"))
    moved = {r.dt[-1]: r.advanced for r in daily.advanced(manifest).collect()}
    assert moved == {"1": True, "2": False, "3": True, "4": False, "5": False}
    assert [r.dt[-1] for r in daily.pending_days(days, manifest).orderBy("dt").collect()] == ["2", "5"]
    assert sorted(r.dt[-1] for r in state.list_ready_partitions(manifest).collect()) == ["1", "2", "3", "5"]
    assert state.latest_version(manifest).first().version == 30


def test_cleaning_does_not_shuffle(spark):
    from rankflow.operators import samples
    from rankflow.plans import prepare
    from rankflow.plans.views import samples_view
    registry = default_registry()
    df = prepare.bucketed(samples.downsample_negatives(prepare.clean(samples_view(spark, "/root/testdata/sf0.001"), registry), "sample_id"), registry)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan


def test_shared_folder_is_required_on_a_cluster(spark):
    from types import SimpleNamespace

    from rankflow import session
    conf = SimpleNamespace(get=lambda *a: None)
    context = SimpleNamespace(master="yarn", getConf=lambda: conf, applicationId="x")
    cluster = SimpleNamespace(conf=conf, sparkContext=context)
    with pytest.raises(RuntimeError):
        session.shared_folder(cluster)
    conf.get = lambda *a: "hdfs:///shared/"
    assert session.shared_folder(cluster) == "hdfs:///shared/rankflow/x"


def test_written_tables_can_be_dropped():
    """In a process of its own, as other tests go on using their tables."""
    import subprocess
    import sys
    code = """
import os, sys
from rankflow.session import drop_written, local_session, shared_folder, written
spark = local_session("1", 2)
assert written(spark.range(3), "t").count() == 3 and os.listdir(shared_folder(spark))
drop_written(spark)
assert not os.path.exists(shared_folder(spark))
spark.stop()
"""
    import os
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    subprocess.run([sys.executable, "-c", code], check=True, timeout=200, cwd=root)
