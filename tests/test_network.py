"""Layers, towers and projected attention against plain numpy, at small and at full width."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from rankflow.operators import network
from rankflow.operators.score import TASK_NAMES
from rankflow.plans import scoring
from rankflow.registry import default_registry
from rankflow.session import written

ACT = {"none": lambda x: x, "relu": lambda x: np.maximum(x, 0), "sigmoid": lambda x: 1 / (1 + np.exp(-x)),
       "softmax": lambda x: np.exp(x) / np.exp(x).sum()}


def plain_layer(net, name, x):
    w, b = (a.astype(np.float64) for a in net.weights[name])
    return ACT[net.layers[name].activation](np.array([sum(x[j] * w[j, i] for j in range(len(x))) + b[i] for i in range(w.shape[1])]) if len(x) < 40 else x @ w + b)


def plain_scores(net, fields, gate_input, extra, dim, depth, shared=3):
    """One row through the graph, step by step."""
    def tower(n):
        g = plain_layer(net, f"{n}_gate_out", plain_layer(net, f"{n}_gate", gate_input))
        return np.concatenate([(fields.reshape(-1, dim) * g[:, None]).ravel(), extra])

    def expert(e, x):
        for k in range(depth):
            x = plain_layer(net, f"{e}_{k}", x)
        return x
    common = [expert(f"shared_{i}", tower("share")) for i in range(shared)]
    out = {}
    for t in TASK_NAMES:
        x = tower(t)
        outs = [*common, expert(f"{t}_expert", x)]
        share = plain_layer(net, f"{t}_mix", x)
        out[t] = plain_layer(net, f"{t}_out", sum(s * o for s, o in zip(share, outs)))[0]
    return out


def random_rows(n, **widths):
    random = np.random.default_rng(3)
    return [(i, *[random.normal(0, 1, w).astype(np.float32).astype(float).tolist() for w in widths.values()]) for i in range(n)]


@pytest.mark.parametrize("fields,gates,extra,units,experts,dtype,tolerance,rows", [
    (3, 6, 2, 5, (7, 4), np.float64, 1e-12, 40),
    # the widths of the whole model: 292 fields, 12 gate inputs, 128 from the attention
    (292, 192, 128, network.GATE_UNITS, network.EXPERT_UNITS, np.float32, 1e-4, 8)])
def test_scores(spark, monkeypatch, fields, gates, extra, units, experts, dtype, tolerance, rows):
    monkeypatch.setattr(network, "BLOCK_ROWS", 16)
    dim = 16 if fields > 10 else 4
    layers = network.task_layers(fields, gates, extra, dim, gate_units=units, expert_units=experts)
    net = network.Network(network.generated_weights(spark, layers), layers, dtype)
    data = random_rows(rows, f=fields * dim, g=gates, e=extra)
    df = spark.createDataFrame(data, "id int, f array<double>, g array<double>, e array<double>").repartition(3)
    got = {r["id"]: r for r in network.score_tasks(df, net, "f", "g", "e", dim=dim).collect()}
    assert len(got) == rows and got[0].asDict().keys() == {"id", "f", "g", "e", *TASK_NAMES}
    for i, f, g, e in data:
        want = plain_scores(net, *map(np.array, (f, g, e)), dim, len(experts))
        assert all(abs(got[i][t] - want[t]) < tolerance for t in TASK_NAMES)
    assert network.score_tasks(df.where("false"), net, "f", "g", "e", dim=dim).count() == 0


def test_two_passes_serve_all_tasks(spark):
    layers = network.task_layers(3, 6, 2, 4, gate_units=5, expert_units=(7, 4))
    net = network.Network(network.generated_weights(spark, layers), layers)
    df = spark.createDataFrame(random_rows(3, f=12, g=6, e=2), "id int, f array<double>, g array<double>, e array<double>")
    plan = network.score_tasks(df, net, "f", "g", "e", dim=4)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 2 and "Exchange" not in plan


def test_mixing_and_heads_are_no_work_per_element_in_rows(spark):
    """Towers leave Python as one number per task; element by element, mixing in row expressions took most of the score's time."""
    layers = network.task_layers(3, 6, 2, 4, gate_units=5, expert_units=(7, 4))
    net = network.Network(network.generated_weights(spark, layers), layers)
    df = spark.createDataFrame(random_rows(3, f=12, g=6, e=2), "id int, f array<double>, g array<double>, e array<double>")
    plan = network.score_tasks(df, net, "f", "g", "e", dim=4)._jdf.queryExecution().executedPlan().toString()
    assert "lambda" not in plan and "zip_with" not in plan


def test_weights_must_fit_their_declaration(spark):
    layer = network.Layer("a", 3, 2)
    rows = [("a", 0, [1.0, 2.0, 3.0], 0.5), ("a", 1, [0.0, 0.0, 1.0], 0.0)]
    table = spark.createDataFrame(rows, "layer string, place int, weights array<double>, bias double")
    w, b = network.Network(table, [layer], np.float64).weights["a"]
    assert w.T.tolist() == [[1, 2, 3], [0, 0, 1]] and b.tolist() == [0.5, 0]
    for wrong in (network.Layer("a", 2, 2), network.Layer("a", 3, 3), network.Layer("b", 3, 2), network.Layer("a", 3, 1)):
        with pytest.raises(ValueError):
            network.Network(table, [wrong])
    with pytest.raises(ValueError):
        network.Network(table, [network.Layer("a", 10**6, 10**6)])


def test_projected_attention(spark, monkeypatch):
    monkeypatch.setattr(network, "BLOCK_ROWS", 4)
    random, dim, width = np.random.default_rng(5), 4, 6
    emb = {(f, i): random.normal(0, 1, dim) for f in ("item", "gap") for i in range(0, 9)}
    layers = [network.Layer("query", 2 * dim, width, "none"), network.Layer("key", 2 * dim, width, "none"), network.Layer("value", 2 * dim, width, "none")]
    weights = [(n.name, p, random.normal(0, 1, 2 * dim).tolist(), float(random.normal())) for n in layers for p in range(width)]
    net = network.Network(spark.createDataFrame(weights, "layer string, place int, weights array<double>, bias double"), layers, np.float64)
    table = spark.createDataFrame([(f, i, v.tolist()) for (f, i), v in emb.items()], "feature string, id long, vec array<double>")
    parts = network.parts_of([("item", "item"), ("gap", "gap")], dim)
    projected = network.project_table(table, net, "query", parts, dim)
    for n in ("key", "value"):
        projected = projected.unionByName(network.project_table(table, net, n, parts, dim))
    assert projected.count() == 3 * len(emb)
    rows = [(0, 1, 2, [1, 2, 3], [4, 5, 6]), (1, 3, 99, [0, 4, 0], [0, 0, 0]), (2, None, 1, [1], None), (3, 1, 1, None, None), (4, 1, 1, [], []),
            (5, 2, 2, [0, 0], [0, 0]), (6, 2, 3, [5, 99, None, 7], [1, 0, 3]), (7, 2, 3, [99], [0]), *[(i, i % 9, i % 5, [i % 9] * (i % 4), [1, 2]) for i in range(8, 30)]]
    df = spark.createDataFrame(rows, "row int, item int, gap int, items array<int>, gaps array<int>").repartition(2)
    out = network.projected_attention(net, written(projected, "projected"), dict.fromkeys([f"{n}/{p}" for n in ("query", "key", "value") for p in ("item", "gap")], 9),
                                      {"item": F.col("item"), "gap": F.col("gap")}, {"item": F.col("items"), "gap": F.col("gaps")})
    got = {r["row"]: r["out"] for r in df.select("row", out.alias("out")).collect()}

    def side_by_side(a, b, positive):
        zero = np.zeros(dim)
        pick = lambda f, i: emb.get((f, i), zero) if i is not None and (not positive or i > 0) else zero
        return np.concatenate([pick("item", a), pick("gap", b)])
    for row, item, gap, items, gaps in rows:
        items, gaps = items or [], gaps or []
        q = net.weights["query"][0].T @ side_by_side(item, gap, False) + net.weights["query"][1]
        at = lambda xs, t: xs[t] if t < len(xs) else None
        pairs = [(at(items, t), at(gaps, t)) for t in range(max(len(items), len(gaps)))]
        pairs = [(a, b) for a, b in pairs if any(x is not None and 0 < x < 9 for x in (a, b))]
        want = np.zeros(width)
        if pairs:
            k, v = ([net.weights[n][0].T @ side_by_side(a, b, True) + net.weights[n][1] for a, b in pairs] for n in ("key", "value"))
            e = np.exp(np.array([q @ x for x in k]) / np.sqrt(width))
            want = sum(s * x for s, x in zip(e / e.sum(), v))
        assert np.allclose(got[row], want), row


def test_projected_attention_over_large_tables_holds_none_of_them(spark, monkeypatch):
    """Tables beyond the limit reach the rows through blocks, with the result of tables that are held; keys may repeat or be missing."""
    random, dim, width = np.random.default_rng(6), 4, 6
    layers = [network.Layer("query", dim, width, "none"), network.Layer("key", 2 * dim, width, "none"), network.Layer("value", 2 * dim, width, "none")]
    weights = [(n.name, p, random.normal(0, 1, n.inputs).tolist(), float(random.normal())) for n in layers for p in range(width)]
    net = network.Network(spark.createDataFrame(weights, "layer string, place int, weights array<double>, bias double"), layers, np.float64)
    table = spark.createDataFrame([("item", i, random.normal(0, 1, dim).tolist()) for i in range(12)], "feature string, id long, vec array<double>")
    one, two = network.parts_of([("item", "item")], dim), network.parts_of([("item", "item"), ("after", "item")], dim)
    projected = network.project_table(table, net, "query", one, dim)
    for n in ("key", "value"):
        projected = projected.unionByName(network.project_table(table, net, n, two, dim))
    projected = written(projected, "projected")
    rows = [(0, 1, [1, 2, 3]), (0, 99, [0, 4, 0, 99]), (None, None, [1]), (None, 1, None), (4, 1, []), (5, 2, [-3, None, 12]),
            *[(i, i % 15, [i % 13] * (i % 4) + [2]) for i in range(8, 200)]]
    df = spark.createDataFrame(rows, "key int, item int, items array<int>").repartition(3)
    limits = dict.fromkeys(["query/item", "key/item", "key/after", "value/item", "value/after"], 12)
    args = (net, projected, limits, {"item": F.col("item")}, {"item": F.col("items"), "after": F.transform("items", lambda x: x + 1)}, "key", "out")
    inside = network.with_projected_attention(df, *args)
    want = sorted((str(r["item"]), str(r["items"]), r["key"] or -1, r["out"]) for r in inside.collect())
    monkeypatch.setattr(network, "HELD_BYTES", 1000)
    monkeypatch.setattr(network, "load_matrices", lambda *a: pytest.fail("a large table was fetched"))
    joined = network.with_projected_attention(df, *args)
    got = sorted((str(r["item"]), str(r["items"]), r["key"] or -1, r["out"]) for r in joined.collect())
    assert joined.columns == inside.columns and len(got) == len(rows) and all(a[:3] == b[:3] and np.allclose(a[3], b[3]) for a, b in zip(got, want))
    assert any(np.any(r[3]) for r in got)


def test_gathered_fields(spark):
    emb = spark.createDataFrame([(f, i, [float(i), float(len(f))]) for f in ("a", "bb", "ccc") for i in range(5)], "feature string, id long, vec array<float>")
    df = spark.createDataFrame([(1, 2, [1, 3, 0, 99]), (None, 99, None), (0, 4, [])], "a int, bb int, ccc array<int>")
    out = df.coalesce(1).select(network.gather_fields(emb, {"a": F.col("a"), "bb": F.col("bb")}, {"ccc": F.col("ccc")}, dict.fromkeys(["a", "bb", "ccc"], 5)).alias("x"))
    assert [r.x for r in out.collect()] == [[1, 1, 2, 2, pytest.approx(4 / 3), 2], [0, 0, 0, 0, 0, 0], [0, 1, 4, 2, 0, 0]]


def test_the_whole_model_has_the_stated_size():
    """All layers of the default registry with its scalar, dense and list features."""
    layers = {x.name: x for x in scoring.model_layers(default_registry())}
    have = scoring.model_features(default_registry())
    assert len(have["history"]) == 36 and len(have["query"]) == 3 and len(have["gates"]) == 12
    assert (layers["key"].inputs, layers["query"].outputs) == (36 * 16, 128)
    assert [layers[f"ctr_expert_{k}"].outputs for k in range(4)] == [512, 256, 128, 64]
    assert sum(x.parameters for x in layers.values()) < network.MAX_PARAMETERS
