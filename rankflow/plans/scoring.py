"""Encoded samples to probabilities: the whole graph of the model as one chain of operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankflow.operators import embed, network
from rankflow.operators.layout import BROADCAST_ROWS
from rankflow.registry import BEHAVIOUR_PARTS, BEHAVIOURS, EMBEDDING_DIM, GATES, LABELS, QUERY, Registry
from rankflow.session import written

# Widths of the position term's layers.
POSITION_UNITS = (512, 64)


def model_features(registry: Registry) -> dict[str, list[str]]:
    """Which of the registry's features are fields, pooled fields, gate inputs, attention queries and attention keys."""
    keys = {(b + p).lower() for b in BEHAVIOURS for p in BEHAVIOUR_PARTS}
    lists = registry.names("sequence")
    return {"fields": registry.names("sparse", "dense", "rank"), "pooled": [n for n in lists if n.lower() not in keys],
            "gates": [registry[n].name for n in GATES if n in registry], "query": [registry[n].name for n in QUERY if n in registry],
            "history": [n for n in lists if n.lower() in keys]}


def model_layers(registry: Registry, dim: int = EMBEDDING_DIM) -> list[network.Layer]:
    """All layers that `score_rows` uses for the features of a registry, at the model's widths."""
    have = model_features(registry)
    attention = network.ATTENTION_UNITS
    layers = network.task_layers(len(have["fields"]) + len(have["pooled"]), len(have["gates"]) * dim, attention, dim)
    layers += [network.Layer("query", len(have["query"]) * dim, attention, "none"), network.Layer("key", len(have["history"]) * dim, attention, "none"),
               network.Layer("value", len(have["history"]) * dim, attention, "none")]
    sizes = (dim, *POSITION_UNITS)
    layers += [network.Layer(f"pos_{i}", a, b) for i, (a, b) in enumerate(zip(sizes, sizes[1:]))]
    return [*layers, network.Layer("pos_out", sizes[-1], 1, "sigmoid", bias=False)]


def start_table(spark: SparkSession, registry: Registry, words: DataFrame, large: str = "userid") -> DataFrame:
    """Start vectors of every id of the small features, and of the known ids of the large one."""
    small = embed.initial_embeddings(registry.spec_df(spark).where(F.col("name") != large))
    users = words.where((F.col("emb_name") == large) & (F.col("id") > 0)).select(F.lit(large).alias("feature"), "id")
    vec = embed.init_vector(F.col("feature"), F.col("id")).cast("array<float>")
    return written(small.unionByName(users.select("feature", "id", vec.alias("vec"))), "embeddings")


def score_rows(rows: DataFrame, registry: Registry, emb: DataFrame, weights: DataFrame, key: str, dim: int = EMBEDDING_DIM) -> DataFrame:
    """Encoded rows with `ctr, fvtr, unlock, cvr` and the position term `pos`; `key` and labels are kept.

    Features within the broadcast limit are gathered from tables held per executor, larger ones (user ids) are joined first.  History
    lists meet tables that are projected once, before any row is read.
    """
    have = model_features(registry)
    net = network.Network(weights, model_layers(registry, dim))
    bounds = {f.name: f.vocab_size for f in registry.features}
    joined = [n for n in have["fields"] if bounds[n] > BROADCAST_ROWS]
    df, first = rows, rows
    for n in joined:
        df = embed.lookup(df, emb, n, n, f"__vec_{n}", bounds[n], key, dim, counted=first)
    near = [n for n in have["fields"] if n not in joined]
    fields = network.gather_fields(emb, {n: F.col(n) for n in near}, {n: F.col(n) for n in have["pooled"]}, bounds)
    gates = network.gather_fields(emb, {n: F.col(n) for n in have["gates"]}, {}, bounds)
    position = registry.names("position")[0]
    place = network.gather_fields(emb, {position: F.col(position)}, {}, bounds)

    q_parts = network.parts_of([(n, n) for n in have["query"]], dim)
    h_parts = network.parts_of([(n, n) for n in have["history"]], dim)
    tables = network.project_table(emb, net, "query", q_parts, dim)
    for layer in ("key", "value"):
        tables = tables.unionByName(network.project_table(emb, net, layer, h_parts, dim))
    limits = {f"{layer}/{p.name}": bounds[p.feature] for layer, ps in (("query", q_parts), ("key", h_parts), ("value", h_parts)) for p in ps}
    attention = network.projected_attention(net, written(tables, "projected"), limits, {n: F.col(n) for n in have["query"]},
                                            {n: F.col(n) for n in have["history"]})
    df = df.withColumns({"__near": fields, "__gates": gates, "__attention": attention, "__place": place})
    far = [F.col(f"__vec_{n}").cast("array<float>") for n in joined]
    df = df.withColumn("__fields", F.concat(F.col("__near"), *far))
    scored = network.score_tasks(df, net, "__fields", "__gates", "__attention", dim=dim)
    pos = network.stack_block(net, [[*[f"pos_{i}" for i in range(len(POSITION_UNITS))], "pos_out"]], F.col("__place"))
    labels = [c for c in LABELS if c in rows.columns]
    return scored.withColumn("pos", F.get(pos, F.lit(0)).cast("double")).select(key, *labels, "ctr", "fvtr", "unlock", "cvr", "pos")
