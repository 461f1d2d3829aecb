"""State tables that are joined and updated without being moved."""

import re

import pytest
from pyspark.sql import functions as F

from rankflow.session import new_path
from rankflow.sources import bucketed

BUCKETS = 16


@pytest.fixture(scope="module")
def table(spark):
    """Ten million rows, as many as there are user ids."""
    rows = spark.range(10_000_000).select("id", (F.col("id") * 2).alias("v"))
    return bucketed.write_bucketed(rows, "id", BUCKETS)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def above_scans(plan, table):
    """For each scan of the table, the names of the operators between it and the root, and the scan itself."""
    lines = plan.split("\n")
    out = []
    for i, line in enumerate(lines):
        if "FileScan" in line and table in line:
            depth, path = re.search(r"\w", line).start(), []
            for above in reversed(lines[:i]):
                at = re.search(r"\w", above)
                if at and at.start() < depth:
                    depth = at.start()
                    path.append(above[at.start():].split(" ")[0])
            out.append((path, line))
    return out


def facts_of(spark, n=50_000):
    hot = F.when(F.col("row") % 3 == 0, 7).when(F.col("row") % 101 == 0, None).otherwise(F.pmod(F.xxhash64("row"), F.lit(12_000_000)))
    return spark.range(n).withColumnRenamed("id", "row").withColumn("user", hot)


def test_lookup_does_not_move_the_table(spark, table):
    facts = facts_of(spark)
    df = bucketed.bucketed_lookup(facts, table, "id", "user")
    moved = [path for path, line in above_scans(plan_of(df), table) if "Bucketed: true" in line]
    # a sort-merge join of the buckets as they lie: no exchange between the scan and the root
    assert len(moved) == 1 and "SortMergeJoin" in moved[0] and "Exchange" not in moved[0]
    row = df.agg(F.count(F.lit(1)), F.count("v"), F.sum((F.col("v") != F.col("user") * 2).cast("int")), F.count_distinct("row")).first()
    known = facts.where("user < 10000000").count()
    assert tuple(row) == (50_000, known, 0, 50_000)


def test_hot_and_missing_keys_do_not_meet(spark, table):
    """A third of the facts share a key: the shuffled part holds none of them, nor those without a key."""
    df = bucketed.bucketed_lookup(facts_of(spark), table, "id", "user")
    df.collect()
    plan = plan_of(df)
    assert "BroadcastHashJoin" in plan
    far = plan.split("SortMergeJoin")[1].split("Union")[0]
    assert "isnull(__is_hot" in far


def test_update_moves_the_changes_only(spark, table):
    changes = spark.createDataFrame([(5, -1), (9_999_999, -2), (20_000_000, -3)], "id long, v long")
    rows = bucketed.updated_rows(table, changes, "id")
    paths = above_scans(plan_of(rows), table)
    assert len(paths) == 2 and all("Exchange" not in path and "BroadcastExchange" not in path for path, _ in paths)
    new = bucketed.update_bucketed(table, changes, "id", BUCKETS)
    got = spark.table(new)
    assert got.count() == 10_000_001 and {tuple(r) for r in got.where("v < 0").collect()} == {(5, -1), (9_999_999, -2), (20_000_000, -3)}
    # every task wrote one bucket, so the next join finds the table as this one did
    assert bucketed.bucket_files(spark, new) <= 2 * BUCKETS
    again = bucketed.bucketed_lookup(facts_of(spark, 1000), new, "id", "user")
    assert any("SortMergeJoin" in path and "Exchange" not in path for path, _ in above_scans(plan_of(again), new))


def test_a_written_folder_can_be_registered_again(spark):
    path = new_path(spark, "kept")
    bucketed.write_bucketed(spark.range(1000).select("id", F.lit("x").alias("v")), "id", 4, path=path)
    table = bucketed.register_bucketed(spark, path, "id long, v string", "id", 4)
    df = bucketed.bucketed_lookup(spark.range(990, 1010).toDF("k"), table, "id", "k")
    assert df.where("v IS NULL").count() == 10 and df.count() == 20
    assert any("Bucketed: true" in line for _, line in above_scans(plan_of(df), table))


def test_bucket_numbers_and_empty_tables(spark):
    assert [bucketed.buckets_for(n) for n in (0, 10**6, 10**7, 10**9)] == [8, 8, 16, 1024]
    none = bucketed.write_bucketed(spark.createDataFrame([], "id long, v int"), "id", 4)
    facts = spark.createDataFrame([(1, 2), (None, 3)], "id long, w int")
    assert {tuple(r) for r in bucketed.bucketed_lookup(facts, none, "id").collect()} == {(1, 2, None), (None, 3, None)}
    assert bucketed.updated_rows(none, spark.createDataFrame([(1, 5)], "id long, v int"), "id").count() == 1
