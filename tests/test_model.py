"""Embeddings, optimizer, scoring, fitting and metrics against plain loops."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from rankflow.operators import embed, fit, metrics, optimizer, score
from rankflow.registry import Feature, Registry, dense_feature

DIM = 4


def emb_rows(spark, n=6):
    return spark.createDataFrame([("f", i, [float(i + j) for j in range(DIM)]) for i in range(n)], "feature string, id long, vec array<float>")


LISTS = {1: [1, 2, 2], 2: [], 3: None, 4: [0, 5], 5: [99, 98], 6: [-1, 3, 0]}


def list_rows(spark):
    rows = [(k, v, None if v is None else [1.0 / (i + 1) for i in range(len(v))]) for k, v in LISTS.items()]
    return spark.createDataFrame(rows, "key long, ids array<long>, w array<double>")


def expected_pool(ids, weights, combiner, mask_zero):
    pairs = [(np.arange(DIM) + i, w) for i, w in zip(ids or [], weights or []) if (1 if mask_zero else 0) <= i < 6 and w > 0]
    if not pairs:
        return np.zeros(DIM)
    total = sum(v * w for v, w in pairs)
    return total / {"sum": 1, "mean": sum(w for _, w in pairs), "sqrtn": math.sqrt(sum(w * w for _, w in pairs))}[combiner]


@pytest.mark.parametrize("combiner", embed.COMBINERS)
@pytest.mark.parametrize("mask_zero", [False, True])
def test_pooling_in_tasks_and_by_join(spark, combiner, mask_zero):
    df, emb = list_rows(spark), emb_rows(spark)
    inside = df.select("key", embed.safe_pool(F.col("ids"), emb, "f", 10, combiner, F.col("w"), mask_zero).alias("vec"))
    for r in inside.collect():
        ids = LISTS[r.key]
        weights = [1.0 / (i + 1) for i in range(len(ids or []))]
        assert r.vec == pytest.approx(expected_pool(ids, weights, combiner, mask_zero))
    for bound in (10, None):
        joined = {r.key: r.vec for r in embed.pool(df, "ids", emb, "f", "key", combiner, "w", bound, mask_zero, DIM).collect()}
        for key, ids in LISTS.items():
            weights = [1.0 / (i + 1) for i in range(len(ids or []))]
            assert joined.get(key, [0.0] * DIM) == pytest.approx(expected_pool(ids, weights, combiner, mask_zero))


def test_pooling_ignores_item_order(spark):
    emb = emb_rows(spark)
    df = spark.createDataFrame([(1, [1, 2, 3]), (2, [3, 1, 2])], "key long, ids array<long>")
    a, b = [r.vec for r in df.select(embed.safe_pool(F.col("ids"), emb, "f", 10).alias("vec")).collect()]
    assert a == pytest.approx(b)


def test_lookups(spark):
    emb = emb_rows(spark)
    df = spark.createDataFrame([(1, 2), (2, 77), (3, None)], "key long, id2 long")
    for bound in (10, None):
        got = {r.key: r.vec for r in embed.lookup(df, emb, "f", "id2", "vec", bound, "key", DIM).collect()}
        assert got == {1: [2.0, 3.0, 4.0, 5.0], 2: [0.0] * DIM, 3: [0.0] * DIM}
    vecs = {r.key: r.v for r in list_rows(spark).select("key", embed.lookup_sequence(F.col("ids"), emb, "f", 10).alias("v")).collect()}
    assert vecs[2] == [] and vecs[3] == [] and vecs[5] == [[0.0] * DIM] * 2
    assert [v[0] for v in vecs[1]] == [1.0, 2.0, 2.0]
    joined = {r.key: r.vecs for r in embed.lookup_sequence_by_join(list_rows(spark), "ids", emb, "f", "key", dim=DIM).collect()}
    assert all(joined.get(k, []) == v for k, v in vecs.items())
    with pytest.raises(ValueError):
        embed.load_matrices(emb, {"f": 3})
    with pytest.raises(ValueError):
        embed.load_matrices(emb, {"f": 10_000_000})


def test_shards(spark):
    for shards, buckets in ((5, 23), (4, 8), (7, 3)):
        got = [r.s for r in spark.range(buckets).orderBy("id").select(embed.shard_of(F.col("id"), shards, buckets).alias("s")).collect()]
        assert got == [i for i, part in enumerate(np.array_split(np.arange(buckets), shards)) for _ in part]
    assert embed.shard_count(10_000_000, 16, 5) == 5 and embed.shard_count(10_000, 16, 5) == 1
    assert embed.shard_count(3_000_000, 16, 5) == 2


def test_initial_vectors_are_a_function_of_feature_and_id(spark):
    df = spark.range(3000).select(F.lit("f").alias("feature"), "id")
    vec = embed.init_vector(F.col("feature"), F.col("id"), 16).alias("v")
    a = {r.id: r.v for r in df.select("id", vec).collect()}
    assert a == {r.id: r.v for r in df.repartition(5).select("id", vec).collect()}
    values = np.array(list(a.values()))
    assert values.shape == (3000, 16) and np.abs(values).max() <= 0.5 and abs(values.mean()) < 0.01
    assert 0.2 < values.std() < 0.25


def state_rows(spark):
    return spark.createDataFrame([("f", i, [1.0 + i] * DIM, [0.1] * DIM, [0.2] * DIM) for i in range(3)],
                                 "feature string, id long, vec array<double>, m array<double>, v array<double>")


@pytest.mark.parametrize("kind", ["lazy", "constant", "all"])
def test_adam(spark, kind):
    grads = spark.createDataFrame([("f", 1, [0.5] * DIM), ("f", 1, [0.25] * DIM), ("f", 7, [1.0] * DIM)], "feature string, id long, g array<double>")
    args = dict(step=4, lr=0.1, dim=DIM, seed=3)
    run = optimizer.adam_step if kind == "all" else optimizer.lazy_adam_step
    if kind == "constant":
        args["bias_correction"] = "constant"
    got = {r.id: r for r in run(state_rows(spark), grads, **args).collect()}
    rate = optimizer.step_rate(0.1, 0.9, 0.999, 1 if kind == "constant" else 4)
    start7 = spark.range(1).select(embed.init_vector(F.lit("f"), F.lit(7).cast("bigint"), DIM, 3).alias("v")).first().v
    start = {i: (np.full(DIM, 1.0 + i), 0.1, 0.2) for i in range(3)} | {7: (np.array(start7), 0.0, 0.0)}
    for i, (w, m, v) in start.items():
        g = {1: 0.75, 7: 1.0}.get(i, 0.0)
        if kind == "all" or g:
            m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
            w = w - rate * m / (math.sqrt(v) + 1e-8)
        assert got[i].vec == pytest.approx(w) and got[i].m == pytest.approx([m] * DIM) and got[i].v == pytest.approx([v] * DIM)
    assert len(got) == 4


def test_warm_start(spark):
    fresh = optimizer.fresh_state(emb_rows(spark), DIM)
    assert optimizer.warm_start(fresh, None) is fresh
    old = fresh.where("id < 2").withColumn("m", F.transform("m", lambda x: x + 1))
    got = {r.id: r.m[0] for r in optimizer.warm_start(fresh, old).collect()}
    assert got == {0: 1.0, 1: 1.0, 2: 0.0, 3: 0.0, 4: 0.0, 5: 0.0}
    assert {r.m[0] for r in optimizer.warm_start(fresh, old, exclude=["f"]).collect()} == {0.0}


# --- scoring --------------------------------------------------------------------------

@pytest.mark.parametrize("combiner", embed.COMBINERS)
def test_forms_for_small_and_large_tables_agree(spark, combiner):
    df, emb = list_rows(spark), emb_rows(spark)
    for name in ("with_safe_pool", "with_sequence"):
        args = (combiner, "w") if name == "with_safe_pool" else ()
        small, large = ({r.key: r.out for r in getattr(embed, name)(df, "ids", emb, "f", "key", "out", bound, *args, dim=DIM).collect()}
                        for bound in (10, None))
        assert small.keys() == large.keys() == LISTS.keys()
        for k in small:
            assert np.allclose(small[k], large[k])


def test_attention_forms_agree(spark):
    df, emb = list_rows(spark).withColumn("q", F.array(*[F.col("key") * 0.1 + i for i in range(DIM)])), emb_rows(spark)
    small, large = ({r.key: r.out for r in score.with_attention(df, "q", "ids", emb, "f", "key", "out", bound, DIM).collect()}
                    for bound in (10, None))
    for k, ids in LISTS.items():
        vecs = [np.arange(DIM) + i for i in ids or [] if 0 < i < 6]
        want = np.zeros(DIM)
        if vecs:
            s = np.array([(k * 0.1 + np.arange(DIM)) @ v for v in vecs]) / 2
            e = np.exp(s - s.max())
            want = (np.array(vecs) * (e / e.sum())[:, None]).sum(axis=0)
        assert small[k] == pytest.approx(want) and large[k] == pytest.approx(want)


def test_weights_and_ids_of_unequal_length(spark):
    df = spark.createDataFrame([(1, [1, 2, 3], [1.0]), (2, [4], [0.5, 9.0]), (3, None, [1.0]), (4, [2], None)],
                               "key long, ids array<long>, w array<double>")
    emb = emb_rows(spark)
    inside, joined = ({r.key: r.out for r in embed.with_safe_pool(df, "ids", emb, "f", "key", "out", bound, "mean", "w", dim=DIM).collect()}
                      for bound in (10, None))
    assert inside == joined == {1: [1.0, 2.0, 3.0, 4.0], 2: [4.0, 5.0, 6.0, 7.0], 3: [0.0] * DIM, 4: [0.0] * DIM}


def test_gates_experts_and_heads(spark):
    rng = np.random.default_rng(0)
    x, fields = rng.normal(size=5), rng.normal(size=(3, 2))
    w, b, out = rng.normal(size=(4, 5)), rng.normal(size=4), rng.normal(size=(3, 4))
    squash = lambda v: 1 / (1 + np.exp(-v))
    lit = lambda a: F.lit(np.asarray(a).tolist())
    row = spark.range(1)
    gated = row.select(score.feature_gate(lit(x), lit(fields), lit(w), lit(b), lit(out)).alias("v")).first().v
    assert np.allclose(gated, fields * squash(out @ np.maximum(w @ x + b, 0))[:, None])
    w2, b2, gate = rng.normal(size=(2, 4)), rng.normal(size=2), rng.normal(size=(3, 5))
    one = score.expert(lit(x), [(lit(w), lit(b)), (lit(w2), lit(b2))])
    plain = np.maximum(w2 @ np.maximum(w @ x + b, 0) + b2, 0)
    assert np.allclose(row.select(one.alias("v")).first().v, plain)
    outs = rng.normal(size=(3, 2))
    share = np.exp(gate @ x) / np.exp(gate @ x).sum()
    mixed = row.select(score.expert_mix(lit(x), [lit(o) for o in outs], lit(gate), 2).alias("v")).first().v
    assert np.allclose(mixed, share @ outs)
    assert row.select(score.task_head(lit(x), lit(w[0])).alias("v")).first().v == pytest.approx(squash(w[0] @ x))


def test_baseline_fits(spark):
    df = spark.range(400).select("id", (F.col("id") % 5).cast("string").alias("a"), (F.col("id") % 7).cast("string").alias("b"),
                                 ((F.col("id") % 5 + F.col("id") % 7) % 2).cast("int").alias("y"))
    models = fit.fit_tasks(df, ["a", "b"], {"ctr": "y"}, hash_bits=8)
    assert set(fit.predict_tasks(df, models).columns) == {"id", "a", "b", "y", "ctr"}
    tower = fit.fit_two_tower(df, "a", "b", "y", factors=4, hash_bits=8, max_iter=60)
    assert metrics.auc_exact(fit.predict_two_tower(df, tower), "y", "score").first().auc > 0.7


# --- metrics ----------------------------------------------------------------------------------

def threshold_auc(rows, n=1001, eps=1e-6):
    """AUC from the confusion counts at each threshold."""
    t = [-1e-7] + [i / (n - 1) for i in range(1, n - 1)] + [1 + 1e-7]
    pos, neg = sum(w * y for y, p, w in rows), sum(w * (1 - y) for y, p, w in rows)
    tpr = [(sum(w * y for y, p, w in rows if p > x) + eps) / (pos + eps) for x in t]
    fpr = [sum(w * (1 - y) for y, p, w in rows if p > x) / (neg + eps) for x in t]
    return sum((fpr[i] - fpr[i + 1]) * (tpr[i] + tpr[i + 1]) / 2 for i in range(n - 1))


RNG = np.random.default_rng(7)
EDGE_AUC = {
    "mixed": [(int(RNG.integers(0, 2)), float(RNG.random()), float(RNG.integers(0, 3))) for _ in range(60)],
    "ties": [(i % 2, 0.5, 1.0) for i in range(10)], "perfect": [(0, 0.1, 1.0), (0, 0.2, 1.0), (1, 0.8, 1.0)],
    "reversed": [(1, 0.1, 1.0), (0, 0.9, 1.0)], "ends": [(0, 0.0, 1.0), (1, 1.0, 1.0), (0, 1.0, 1.0), (1, 0.0, 1.0)],
    "one class": [(1, 0.3, 1.0), (1, 0.7, 1.0)], "no weight": [(1, 0.3, 0.0), (0, 0.7, 0.0)],
}


@pytest.mark.parametrize("case", EDGE_AUC)
def test_auc(spark, case):
    rows = EDGE_AUC[case]
    df = spark.createDataFrame([(y, p, w) for y, p, w in rows], "y int, p double, w double")
    for n in (1001, 11):
        assert metrics.auc(df, "y", "p", "w", n).first().auc == pytest.approx(threshold_auc(rows, n), abs=1e-9)


def test_binned_auc_approaches_the_exact_one(spark):
    rows = [(int(RNG.random() < p), p) for p in map(float, RNG.random(800))]
    df = spark.createDataFrame(rows, "y int, p double")
    exact = metrics.auc_exact(df, "y", "p").first().auc
    wins = np.mean([(a > b) + (a == b) / 2 for y, a in rows if y for z, b in rows if not z])
    assert exact == pytest.approx(wins)
    assert metrics.auc(df, "y", "p", thresholds=100_001).first().auc == pytest.approx(exact, abs=1e-4)


def test_log_loss(spark):
    df = spark.createDataFrame([(1, 0.8, 2.0), (0, 0.3, 1.0), (1, 0.0, 0.0), (0, 1.0, 1.0)], "y int, p double, w double")
    got = df.agg(metrics.log_loss(F.col("y"), F.col("p"), F.col("w")).alias("l")).first().l
    parts = [-2 * math.log(0.8 + 1e-7), -math.log(0.7 + 1e-7), -math.log(1e-7)]
    assert got == pytest.approx(sum(parts) / 3)
    none = df.agg(metrics.log_loss(F.col("y"), F.col("p"), F.lit(0.0)).alias("l")).first().l
    assert none == 0.0
    clipped = df.agg(metrics.log_loss(F.col("y"), F.col("p"), clip=True).alias("l")).first().l
    assert clipped == pytest.approx((-math.log(0.8) - math.log(0.7) - 2 * math.log(1e-7)) / 4, rel=1e-6)


def test_two_tower_scores_by_the_plain_formula(spark):
    """A bias per id, the product of their vectors and the intercept, from the stored weights."""
    rows = [(f"a{i % 5}", f"b{i % 7}", int((i % 5) * (i % 7) % 3 == 0)) for i in range(300)]
    df = spark.createDataFrame(rows, "a string, b string, y int")
    model = fit.fit_two_tower(df, "a", "b", "y", factors=3, hash_bits=6, max_iter=10)
    fm = model.stages[1]
    factors, linear = fm.factors.toArray(), fm.linear.toArray()
    scored = model.stages[0].transform(fit.predict_two_tower(df, model)).select("pair", "score").distinct().collect()
    assert len(scored) == 35
    for r in scored:
        places = r["pair"].indices
        raw = fm.intercept + sum(linear[i] * v for i, v in zip(places, r["pair"].values))
        raw += sum(factors[i] @ factors[j] * r["pair"][int(i)] * r["pair"][int(j)] for i in places for j in places if i < j)
        assert abs(r.score - 1 / (1 + np.exp(-raw))) < 1e-9


# --- what lookups in tables of any size shuffle -------------------------------------------------

@pytest.fixture
def no_small_tables(spark):
    """Only tables that are marked for it are broadcast, as if the others were large."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def shuffled_bytes(df) -> int:
    """Bytes of the rows that the shuffles of a collected frame took in."""
    df.collect()

    def walk(node) -> int:
        name = node.nodeName()
        if name.startswith("AdaptiveSparkPlan"):
            return walk(node.executedPlan())
        if "QueryStage" in name:
            return walk(node.plan())
        children = node.children()
        own = node.metrics().apply("dataSize").value() if name == "Exchange" else 0
        return own + sum(walk(children.apply(i)) for i in range(children.size()))

    return walk(df._jdf.queryExecution().executedPlan())


WIDE = 64


def wide_rows(spark, n=6000):
    """Rows of six ids each, of ten in all; vectors and queries are floats."""
    emb = spark.range(10).select(F.lit("f").alias("feature"), "id", F.transform(F.sequence(F.lit(0), F.lit(WIDE - 1)), lambda i: (
        F.rand(5) + i).cast("float")).alias("vec"))
    emb = spark.createDataFrame(emb.collect(), emb.schema)
    rows = spark.range(n).select(F.col("id").alias("key"), F.transform(F.sequence(F.lit(1), F.lit(6)), lambda i: (F.col("id") + i) % 9 + 1).alias("ids"))
    return rows, emb


def test_pooling_large_tables_shuffles_no_vector_per_item(spark, no_small_tables):
    rows, emb = wide_rows(spark)
    pooled = embed.with_safe_pool(rows, "ids", emb, "f", "key", "out", None, "mean", None, True, WIDE)
    assert shuffled_bytes(pooled) < rows.count() * WIDE * 8


def test_attention_over_large_tables_shuffles_no_vector_per_item(spark, no_small_tables):
    rows, emb = wide_rows(spark)
    query = F.transform(F.sequence(F.lit(0), F.lit(WIDE - 1)), lambda i: (F.col("key") % 7 + i) * 0.0625)
    out = score.with_attention(rows.withColumn("q", query), "q", "ids", emb, "f", "key", "out", None, WIDE)
    assert shuffled_bytes(out) < 2 * rows.count() * WIDE * 8
    inside = score.with_attention(rows.withColumn("q", query), "q", "ids", emb, "f", "key", "out", 10, WIDE)
    both = out.join(inside.select("key", F.col("out").alias("inside")), "key").orderBy("key").limit(50).collect()
    assert len(both) == 50 and all(np.allclose(r.out, r.inside) and r.q == [(r.key % 7 + i) * 0.0625 for i in range(WIDE)] for r in both)


def test_sequences_from_large_tables_shuffle_no_vector_per_item(spark, no_small_tables):
    rows, emb = wide_rows(spark)
    lists = embed.lookup_sequence_by_join(rows, "ids", emb, "f", "key", dim=WIDE)
    assert shuffled_bytes(lists) < rows.count() * WIDE * 8


def test_lookup_join_shuffles_no_values_of_hot_keys(spark, no_small_tables):
    rows, emb = wide_rows(spark)
    found = embed.lookup(rows.withColumn("k", F.col("key") % 10), emb, "f", "k", "out", None, "key", WIDE)
    assert shuffled_bytes(found.select("key", F.col("out")[0])) < rows.count() * WIDE * 4


ODD_VECS = [("f", 1, [1.0, 2.0, None, 4.0]), ("f", 2, [8.0] * 4), ("f", 2, [4.0] * 4), ("f", 3, None), ("f", 4, [2.0, 2.0]), ("f", None, [9.0] * 4), ("g", 1, [7.0] * 4)]
ODD_LISTS = [(1, [1]), (2, [2, 1]), (2, [2]), (None, [2, 2]), (None, [1]), (3, [3, 77, None]), (4, [4, 2]), (5, []), (6, None), (7, [1, 1])]


def odd_frames(spark):
    return (spark.createDataFrame(ODD_LISTS, "key long, ids array<long>").repartition(3),
            spark.createDataFrame(ODD_VECS, "feature string, id long, vec array<double>"))


def test_pooling_large_tables_with_repeated_and_missing_keys(spark):
    """Rows of one key are pooled together, an id that the table repeats counts as often, missing elements count for nothing."""
    df, emb = odd_frames(spark)
    got = {r.key: r.vec for r in embed.pool(df, "ids", emb, "f", "key", "sum", dim=DIM).collect()}
    assert got == {1: [1.0, 2.0, None, 4.0], 2: [25.0, 26.0, 24.0, 28.0], None: [25.0, 26.0, 24.0, 28.0], 4: [14.0, 14.0, 12.0, 12.0], 7: [2.0, 4.0, None, 8.0]}
    whole = embed.with_safe_pool(df, "ids", emb, "f", "key", "out", None, "sum", dim=DIM)
    assert whole.columns == ["key", "ids", "out"]
    want = sorted([str((k, x, [0.0] * DIM if k is None else got.get(k, [0.0] * DIM))) for k, x in ODD_LISTS])
    assert sorted(str((r.key, r.ids, r.out)) for r in whole.collect()) == want


def test_sequences_from_large_tables_with_repeated_and_missing_keys(spark):
    df, emb = odd_frames(spark)
    got = {r.key: r.vecs for r in embed.lookup_sequence_by_join(df, "ids", emb, "f", "key", dim=DIM).collect()}
    one, none = ODD_VECS[0][2], [0.0] * DIM
    assert got == {1: [one], 2: [[4.0] * 4, [4.0] * 4, [8.0] * 4, [8.0] * 4, one], None: [one, [4.0] * 4, [8.0] * 4, [4.0] * 4, [8.0] * 4],
                   3: [none] * 3, 4: [[2.0, 2.0], [4.0] * 4, [8.0] * 4], 7: [one, one]}
    whole = embed.with_sequence(df, "ids", emb, "f", "key", "out", None, DIM)
    want = sorted(str((k, x, [] if k is None else got.get(k, []))) for k, x in ODD_LISTS)
    assert sorted(str((r.key, r.ids, r.out)) for r in whole.collect()) == want


def test_attention_over_large_tables_with_repeated_and_missing_keys(spark):
    """Items of all rows of a key share one softmax, each weighed by its own row's query; a score over a missing element is missing."""
    df, emb = odd_frames(spark)
    df = df.withColumn("q", F.when(~F.col("key").eqNullSafe(7), F.array(*[F.size("ids") * 0.1 + i / 3 for i in range(DIM)])))
    rows = score.with_attention(df.where("key IS NULL OR key <> 2"), "q", "ids", emb, "f", "key", "out", None, DIM).collect()
    got = {r.key: r.out for r in rows}
    assert got[None] == got[3] == got[5] == got[6] == [0.0] * DIM and got[1] == got[4] == got[7] == [None] * DIM
    df = spark.createDataFrame([(2, [2], [0.1, 0.7, 0.3, 0.01]), (2, [5], [1.0, 0.2, 0.1, 0.3])], "key long, ids array<long>, q array<double>")
    emb = spark.createDataFrame([("f", 2, [8.0, 1.0, 2.0, 3.0]), ("f", 2, [4.0] * 4), ("f", 5, [0.5, 1.5, 2.5, 3.5])], "feature string, id long, vec array<double>")
    got = score.with_attention(df, "q", "ids", emb, "f", "key", "out", None, DIM).orderBy("ids").collect()
    vecs = np.array([[8.0, 1.0, 2.0, 3.0], [4.0] * 4, [0.5, 1.5, 2.5, 3.5]])
    e = np.exp([vecs[0] @ got[0].q / 2, vecs[1] @ got[0].q / 2, vecs[2] @ got[1].q / 2])
    assert all(r.out == pytest.approx((vecs * (e / e.sum())[:, None]).sum(0)) for r in got) and [r.q[3] for r in got] == [0.01, 0.3]
