"""Cleaning, sampling and batching on edge tables."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from rankflow.operators import layout, samples
from rankflow.registry import BEHAVIOURS, Registry, default_registry, dense_feature

SCHEMA = ("id long, mtime_gap int, play_ratio double, ctr_label int, cvr_label int, unlock_label int, finish_view_label int")


def edge_null_logic(spark):
    base = [10, 0.05, 0, 0, 0, 0]
    rows = [(0, *base)]
    for i in range(5):
        row = list(base)
        row[i] = None
        rows.append((i + 1, *row))
    rows += [(6, 60, 0.05, 0, 0, 0, 0), (7, -1, 0.05, 0, 0, 0, 0), (8, 10, 0.1, 0, 0, 0, 0), (9, 10, 0.05, 1, 0, 0, 0)]
    return spark.createDataFrame(rows, SCHEMA)


def ids(df):
    return sorted(r.id for r in df.select("id").collect())


def test_drop_accidental_keeps_rows_with_missing_values(spark):
    # only row 0 fulfils the whole condition for certain
    assert ids(samples.drop_accidental(edge_null_logic(spark))) == [1, 2, 3, 4, 5, 6, 7, 8, 9]


def test_negatives_need_certainty(spark):
    df = samples.split_negatives(edge_null_logic(spark))
    assert ids(df.where("is_negative")) == [0, 1, 6, 7]
    assert df.where("is_negative IS NULL").count() == 0


def test_labels(spark):
    df = spark.createDataFrame([(0.95, "", 3.0, "2024-01-01 07:00:00"), (0.9, None, 99.0, "2024"), (None, "2", None, None),
                                (0.1, "x", 60.0, "2024-01-01 xx")], "play_ratio double, vip_type string, book_pos double, reqtime string")
    got = samples.label_samples(df).select("finish_view_label", "vip_label", "book_pos", "hour").collect()
    assert [tuple(r) for r in got] == [(1, 0, 3, 7), (0, 0, 60, -1), (0, 2, 60, -1), (0, 0, 60, -1)]


def test_downsampling_does_not_depend_on_partitions(spark):
    df = spark.range(4000).withColumns({"play_ratio": F.lit(0.0), **{c: F.when(F.col("id") % 10 == 0, 1).otherwise(0) for c in
                                        ("ctr_label", "cvr_label", "unlock_label", "finish_view_label")}})
    a = ids(samples.downsample_negatives(df, "id"))
    assert a == ids(samples.downsample_negatives(df.repartition(7, "ctr_label"), "id"))
    assert a == ids(samples.downsample_by_union(df, "id"))
    kept = Counter(i % 10 == 0 for i in a)
    assert kept[True] == 400 and abs(kept[False] - 1800) < 120


@pytest.mark.parametrize("frac", [0.0, 0.3, 0.5, 1.0])
def test_exact_sample_with_a_hot_group(spark, frac):
    group = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("g"), (F.col("id") % 7).cast("string")))
    df = spark.range(3000).withColumn("g", group)
    sizes = {r.g: r["count"] for r in df.groupBy("g").count().collect()}
    picked = samples.exact_sample(df, frac, "g", "id")
    got = {r.g: r["count"] for r in picked.groupBy("g").count().collect()}
    assert got == {g: round(n * frac) for g, n in sizes.items() if round(n * frac)}
    assert picked.distinct().count() == picked.count()


def test_row_index_is_a_global_order(spark):
    df = spark.range(1000).withColumn("k", F.expr("(id * 7919) % 1000")).repartition(5)
    got = layout.row_index(df, ["k"], partitions=6).collect()
    assert sorted((r.k, r.row_index) for r in got) == [(i, i) for i in range(1000)]


def test_fixed_batches(spark):
    df = spark.range(1050)
    full = samples.fixed_batches(df, 100, ["id"], drop_remainder=True)
    assert {r["count"] for r in full.groupBy("batch_id").count().collect()} == {100} and full.count() == 1000
    assert samples.fixed_batches(df, 100, ["id"]).count() == 1050
    assert samples.fixed_batches(spark.range(50), 100, ["id"], drop_remainder=True).count() == 0


def test_shuffle_is_repeatable_and_complete(spark):
    df = spark.range(500)
    a = [r.id for r in samples.shuffle_rows(df, "id", 1).collect()]
    assert a == [r.id for r in samples.shuffle_rows(df.repartition(3), "id", 1).collect()]
    assert a != [r.id for r in samples.shuffle_rows(df, "id", 2).collect()]
    assert sorted(a) == list(range(500)) and a != sorted(a)


def test_epochs_and_steps(spark):
    assert samples.repeat_epochs(spark.range(5), 3).count() == 15
    assert samples.repeat_epochs(spark.range(5), 0).count() == 0
    counts = spark.createDataFrame([("2024-01-02", 600), ("2024-01-01", 255), ("2024-01-03", 512)], "dt string, n long")
    got = samples.plan_steps(counts, 256, 10).orderBy("dt").collect()
    assert [(r.steps, r.max_steps) for r in got] == [(0, 10), (2, 12), (2, 14)]


def test_name_patterns(spark):
    df = spark.createDataFrame([("emb/a",), ("emb/b",), ("dense/a",), ("global_step",)], "name string")
    pick = lambda *a, **k: sorted(r.name for r in samples.select_by_name_pattern(df, *a, **k).collect())
    assert pick() == ["dense/a", "emb/a", "emb/b"]
    assert pick(["emb"], ["/b$"]) == ["emb/a"]
    assert pick(["step"], skip_global_step=False) == ["global_step"]


@pytest.mark.parametrize("bound", [10, None])
def test_lookup_join_with_hot_and_missing_keys(spark, bound):
    key = F.when(F.col("id") % 3 == 0, 1).when(F.col("id") % 3 == 1, None).otherwise(F.col("id") % 50)
    facts = spark.range(6000).withColumn("k", key.cast("long"))
    state = spark.createDataFrame([(i, f"v{i}") for i in range(10)], "k long, v string")
    got = layout.lookup_join(facts, state, ["k"], bound, ["id"])
    assert got.columns == ["id", "k", "v"] or bound
    rows = {r.id: (r.k, r.v) for r in got.collect()}
    assert len(rows) == 6000
    assert all(v == (f"v{k}" if k is not None and k < 10 else None) for k, v in rows.values())


def test_large_lookup_spreads_the_hot_key(spark):
    facts = spark.range(8000).withColumn("k", F.when(F.col("id") % 2 == 0, 1).otherwise(F.col("id")).cast("long"))
    state = spark.range(9000).select(F.col("id").alias("k"), F.col("id").alias("v"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = layout.lookup_join(facts, state, ["k"], None, ["id"])
        sizes = [r.n for r in joined.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()]
        assert max(sizes) < 8000 * 0.3
        assert joined.where("v <> k OR v IS NULL").count() == 0
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_registry():
    r = default_registry()
    assert [len(r.group(g)) for g in ("sparse", "sequence", "rank", "position")] == [49, 49, 2, 1]
    assert len(r.gate_features()) == 12 and len(r.history_features()) == 3 * len(BEHAVIOURS) == 36
    assert len(r.pooled_sequences()) == 13
    assert r["USERITEMWATCHLEFTFORPAY"].name == "userItemWatchLeftForPay"
    assert r.names()[:2] == ["book_id", "gender"] and r.names()[-1] == "book_pos"
    assert r.capacities()["gap_day"] == 201 and r.capacities()["bid"] == 10001
    with pytest.raises(KeyError):
        r["no_such_feature"]
    with pytest.raises(ValueError):
        dense_feature(1, "x", [2, 1])
    more = r.with_dense([(1005, "ad_last_days", [0, 1, 2]), (1000, "chapter_number", [5])])
    assert more["chapter_number"].vocab_size == 2 and more["ad_last_days"].boundaries == (0.0, 1.0, 2.0)
    assert isinstance(more, Registry) and len(more.group("dense")) == len(r.group("dense")) + 1


def test_malformed_rows_are_set_aside(spark):
    df = spark.createDataFrame([(1, "1", "0.5"), (2, "x", "0.5"), (3, "", None), (4, None, "high"), (5, " 2 ", "1e3")], "id long, vip_type string, play_ratio string")
    good, bad = samples.split_malformed(df, {"vip_type": "int", "play_ratio": "double"})
    assert ids(good) == [1, 3, 5] and ids(bad) == [2, 4]


def test_holdout_splits_by_key(spark):
    df = spark.range(5000)
    fit, held = samples.split_holdout(df, "id", 0.1)
    assert sorted(ids(fit) + ids(held)) == list(range(5000)) and 400 < held.count() < 600
    assert ids(held) == ids(samples.split_holdout(df.repartition(3), "id", 0.1)[1])


def test_a_null_group_is_sampled_like_any_other(spark):
    df = spark.range(200).withColumn("g", F.when(F.col("id") >= 100, "a"))
    got = {r.g: r["count"] for r in samples.exact_sample(df, 0.5, "g", "id").groupBy("g").count().collect()}
    assert got == {None: 50, "a": 50}


def test_small_shares_differ(spark):
    from rankflow.functions.hashing import keep_share
    df = spark.range(1_000_000)
    counts = [df.where(keep_share(F.col("id"), f, 1)).count() for f in (1e-5, 1e-4, 1e-3)]
    assert counts[0] < 30 and 60 < counts[1] < 140 and 880 < counts[2] < 1120


def test_chained_large_joins_grow_linearly(spark):
    facts = spark.range(1000).withColumns({f"k{i}": F.col("id") % (7 + i) for i in range(4)})
    states = [spark.range(50).select(F.col("id").alias(f"k{i}"), (F.col("id") * 2).alias(f"v{i}")) for i in range(4)]
    df, sizes = facts, []
    for i, state in enumerate(states):
        df = layout.lookup_join(df, state, [f"k{i}"], None, ["id"], counted=facts.select(f"k{i}"))
        sizes.append(df._jdf.queryExecution().optimizedPlan().toString().count("Range"))
    steps = [b - a for a, b in zip(sizes, sizes[1:])]
    assert max(steps) <= min(steps) + 1
    assert df.where("v0 = 2 * k0 AND v3 = 2 * k3").count() == 1000
