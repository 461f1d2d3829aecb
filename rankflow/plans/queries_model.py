"""Queries over scoring, losses, evaluation and fitting."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankflow.operators import embed, fit, metrics, network, samples, score, vocab
from rankflow.operators.layout import for_heavy_work
from rankflow.plans import prepare, scoring
from rankflow.plans.catalog import digest, digest_sql, md5_sql, on, query
from rankflow.plans.queries_samples import REGISTRY, labelled
from rankflow.plans.queries_state import _CLICKS, _V, _ZERO, DIM, clicks, vector_bound, vectors
from rankflow.plans.views import SCORE_COLUMNS, samples_view, table
from rankflow.session import new_path, written
from rankflow.sources import state


def raw_scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labelled(spark, sf_dir).selectExpr("*", *[f"{e} AS {n}" for n, e in SCORE_COLUMNS.items()])


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.with_chain(raw_scored(spark, sf_dir))


def rounded(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) + F.lit(0.0) for c in cols})


# --- G5, G6 -----------------------------------------------------------------------------------

@query("g5_label_summary", on("labelled", """
SELECT dt, gender, n, round(a, 6) AS ctr_rate, round(b, 6) AS finish_view_rate FROM (
  SELECT dt, gender, count(*) AS n, avg(ctr_label) AS a, avg(finish_view_label) AS b FROM labelled GROUP BY ROLLUP (dt, gender))"""))
def summary(spark, sf_dir):
    out = metrics.label_summary(labelled(spark, sf_dir), ["dt", "gender"], ["ctr_label", "finish_view_label"], subtotals=True)
    return rounded(out, "ctr_rate", "finish_view_rate")


_ROW_LOSS = "-(y * ln(p + 1e-7) + (1 - y) * ln(1 - p + 1e-7))"
_BATCHES = {"batched": "SELECT *, cast(floor((row_number() OVER (ORDER BY sample_id) - 1) / 100) AS BIGINT) AS batch_id FROM raw_scored",
            "losses": f"SELECT batch_id, avg({_ROW_LOSS.replace('y', 'ctr_label').replace('p +', 'ctr +').replace('p)', 'ctr)').replace('- p', '- ctr')}) AS loss FROM batched GROUP BY batch_id"}


def losses(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = raw_scored(spark, sf_dir).select("sample_id", "ctr_label", "ctr")
    return metrics.batch_losses(samples.fixed_batches(rows, 100, ["sample_id"], drop_remainder=False), "ctr_label", "ctr")


@query("g6_batch_metric_mean", on("raw_scored", "SELECT batch_id // 20 AS report, round(avg(loss), 6) AS mean_loss, count(*) AS batches FROM losses GROUP BY 1", **_BATCHES))
def report(spark, sf_dir):
    return rounded(metrics.batch_metric_mean(losses(spark, sf_dir), 20), "mean_loss")


@query("g6_batch_metric_mean_overall", on("raw_scored", "SELECT round(avg(loss), 6) AS mean_loss, count(*) AS batches FROM losses", **_BATCHES))
def report_overall(spark, sf_dir):
    return rounded(metrics.batch_metric_mean(losses(spark, sf_dir)), "mean_loss")


# --- I -------------------------------------------------------------------------------------------

_ATTENTION_SQL = on("samples", f"""
SELECT clicks.sample_id, round(coalesce(s, 0), 6) + 0.0::DOUBLE AS attended FROM clicks LEFT JOIN (
  SELECT sample_id, sum(exp(score) * d) / sum(exp(score)) AS s FROM (
    SELECT sample_id, list_dot_product(coalesce(q.vec, {_ZERO}), v.vec) / 8.0 AS score, list_sum(list_transform(v.vec, lambda x, i: x * i)) AS d
    FROM (SELECT sample_id, k, unnest(ids) AS id FROM clicks) c JOIN v ON v.id = c.id LEFT JOIN v q ON q.id = c.k WHERE c.id > 0)
  GROUP BY sample_id) USING (sample_id)""", clicks=_CLICKS, v=_V)


def _attention(spark: SparkSession, sf_dir: str, bound: int | None) -> DataFrame:
    emb = vectors(spark, sf_dir)
    rows = embed.lookup(clicks(spark, sf_dir), emb, "item", "k", "q", vector_bound(spark, sf_dir), "sample_id", DIM)
    out = score.with_attention(rows, "q", "ids", emb, "item", "sample_id", "vec", bound, DIM)
    return out.select("sample_id", digest(F.col("vec")).alias("attended"))


@query("i1_attention_pool", _ATTENTION_SQL)
def attention(spark, sf_dir):
    return _attention(spark, sf_dir, vector_bound(spark, sf_dir))


@query("i1_attention_pool_large_table", _ATTENTION_SQL)
def attention_large(spark, sf_dir):
    return _attention(spark, sf_dir, None)


@query("i5_position_debias", on("raw_scored", "SELECT sample_id, round(ctr * pos, 6) AS debiased, round(ctr, 6) AS bare FROM raw_scored"))
def debias(spark, sf_dir):
    ctr, pos = F.col("ctr"), F.col("pos")
    return raw_scored(spark, sf_dir).select("sample_id", F.round(score.position_debias(ctr, pos), 6).alias("debiased"),
                                            F.round(score.position_debias(ctr, pos, False), 6).alias("bare"))


@query("i6_chain_probabilities", on("raw_scored", """
SELECT sample_id, round(ctr * fvtr, 6) AS ctfvtr, round(ctr * unlock, 6) AS ctunlock, round(ctr * cvr, 6) AS ctcvr FROM raw_scored"""))
def chain(spark, sf_dir):
    heads = {t: F.col(t) for t in ("fvtr", "unlock", "cvr")}
    products = score.chain_probabilities(F.col("ctr"), heads)
    return raw_scored(spark, sf_dir).select("sample_id", *[F.round(c, 6).alias(n) for n, c in products.items()])


_DOT_SQL = on("samples", f"""
SELECT sample_id, round(a[64], 6) + 0.0::DOUBLE AS actor_bias, round(1 / (1 + exp(-(a[64] + b[64] + list_dot_product(a[1:63], b[1:63]) + play))), 6) AS score
FROM (SELECT sample_id, coalesce(a.vec, {_ZERO}) AS a, coalesce(b.vec, {_ZERO}) AS b, play
  FROM (SELECT sample_id, cast(userid AS BIGINT) AS u, cast(substr(book_id, 2) AS BIGINT) * 31 AS k, coalesce(play_ratio, 0) AS play FROM samples) s
  LEFT JOIN v a ON a.id = s.u LEFT JOIN v b ON b.id = s.k)""", v=_V)


def _dot(spark: SparkSession, sf_dir: str, bound: int | None) -> DataFrame:
    rows = samples_view(spark, sf_dir).select("sample_id", F.col("userid").cast("bigint").alias("u"),
                                              (F.substring("book_id", 2, 20).cast("bigint") * 31).alias("k"),
                                              F.coalesce("play_ratio", F.lit(0.0)).alias("play"))
    out = score.dot_score(rows, vectors(spark, sf_dir), ("u", "item"), ("k", "item"), (bound, bound), "sample_id", DIM, ["play"])
    return rounded(out, "actor_bias", "score").select("sample_id", "actor_bias", "score")


@query("i7_dot_score", _DOT_SQL)
def dot(spark, sf_dir):
    return _dot(spark, sf_dir, vector_bound(spark, sf_dir))


@query("i7_dot_score_large_tables", _DOT_SQL)
def dot_large(spark, sf_dir):
    return _dot(spark, sf_dir, None)


# Weights that both engines can compute: each is a function of its place.
def _weight(i: str, j: str, salt: int) -> str:
    return f"(cast(({i} * 31 + {j} * 17 + {salt}) % 101 as double) - 50) / 200"


def _matrix(rows: int, cols: int, salt: int) -> F.Column:
    return F.expr(f"transform(sequence(0, {rows - 1}), i -> transform(sequence(0, {cols - 1}), j -> {_weight('i', 'j', salt)}))")


def _vector(n: int, salt: int) -> F.Column:
    return F.expr(f"transform(sequence(0, {n - 1}), i -> {_weight('i', '0', salt)})")


def _dense_sql(x: str, rows: int, cols: int, salt: int, bias: int | None = None, act: str = "{}") -> str:
    value = (f"list_sum(list_transform(range(0, {cols}), lambda j: {_weight('i', 'j', salt)} * {x}[j + 1]))"
             + (f" + {_weight('i', '0', bias)}" if bias is not None else ""))
    return f"list_transform(range(0, {rows}), lambda i: {act.format(value)})"


_RELU, _SIGMOID = "greatest({}, 0.0)", "1 / (1 + exp(-({})))"
_GATED = {"x": "SELECT vec_id, embedding::DOUBLE[] AS x FROM embeddings",
          "hidden": f"SELECT *, {_dense_sql('x', 12, 64, 1, 2, _RELU)} AS h FROM x",
          "gates": f"SELECT *, {_dense_sql('h', 4, 12, 3, None, _SIGMOID)} AS g FROM hidden",
          "gated": "SELECT vec_id, x, list_transform(range(0, 64), lambda i: x[i + 1] * g[i // 16 + 1]) AS y FROM gates"}
_MIXED = _GATED | {
    "first": "SELECT vec_id, y" + "".join(f", {_dense_sql('y', 8, 64, 10 + e, 20 + e, _RELU)} AS a{e}" for e in range(4)) + " FROM gated",
    "second": "SELECT vec_id, y" + "".join(f", {_dense_sql(f'a{e}', 6, 8, 30 + e, 40 + e, _RELU)} AS b{e}" for e in range(4)) + " FROM first",
    "raw": f"SELECT *, {_dense_sql('y', 4, 64, 50, 51)} AS r FROM second",
    "shares": "SELECT *, list_transform(r, lambda v: exp(v)) AS e FROM raw",
    "mixed": "SELECT vec_id, list_transform(range(0, 6), lambda i: (" + " + ".join(f"b{e}[i + 1] * e[{e + 1}]" for e in range(4))
             + ") / list_sum(e)) AS m FROM shares"}


def _with(ctes: dict[str, str], sql: str) -> str:
    return "WITH " + ",\n".join(f"{n} AS ({q})" for n, q in ctes.items()) + "\n" + sql


def gated_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector as four fields of 16, gated by itself, and the gated fields side by side."""
    rows = table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("x"))
    fields = F.array(*[F.slice("x", 16 * i + 1, 16) for i in range(4)])
    gated = score.feature_gate(F.col("x"), fields, _matrix(12, 64, 1), _vector(12, 2), _matrix(4, 12, 3))
    return rows.select("vec_id", F.flatten(gated).alias("y"))


def mixed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three shared experts and one of the task's own, of two layers each, mixed by a gate."""
    y = F.col("y")
    experts = [score.expert(y, [(_matrix(8, 64, 10 + e), _vector(8, 20 + e)), (_matrix(6, 8, 30 + e), _vector(6, 40 + e))]) for e in range(4)]
    return gated_rows(spark, sf_dir).select("vec_id", score.expert_mix(y, experts, _matrix(4, 64, 50), 6, _vector(4, 51)).alias("m"))


@query("i2_feature_gate", _with(_GATED, f"SELECT vec_id, {digest_sql('y')} AS gated FROM gated"))
def gate(spark, sf_dir):
    return gated_rows(spark, sf_dir).select("vec_id", digest(F.col("y")).alias("gated"))


@query("i3_expert_mix", _with(_MIXED, f"SELECT vec_id, {digest_sql('m')} AS mixed FROM mixed"))
def mix(spark, sf_dir):
    return mixed_rows(spark, sf_dir).select("vec_id", digest(F.col("m")).alias("mixed"))


@query("i4_task_heads", _with(_MIXED, "SELECT vec_id" + "".join(
    f", round({_SIGMOID.format(f'list_sum(list_transform(range(0, 6), lambda j: {_weight(str(t), chr(106), 60)} * m[j + 1]))')}, 6) AS {n}"
    for t, n in enumerate(score.TASK_NAMES)) + " FROM mixed"))
def task_heads(spark, sf_dir):
    heads = _matrix(4, 6, 60)
    return mixed_rows(spark, sf_dir).select("vec_id", *[
        F.round(score.task_head(F.col("m"), F.get(heads, F.lit(t))), 6).alias(n) for t, n in enumerate(score.TASK_NAMES)])


# The whole graph with small layers: five gates, three shared and four own experts, four mixing gates and heads.
_EXTRA, _GATE_UNITS, _EXPERT_UNITS = 4, 12, (8, 6)
_LAYERS = {layer.name: (layer, 100 + 3 * i) for i, layer in enumerate(network.task_layers(4, 64, _EXTRA, 16, gate_units=_GATE_UNITS, expert_units=_EXPERT_UNITS))}


def weight_table(spark: SparkSession, layers: dict[str, tuple[network.Layer, int]]) -> DataFrame:
    """The weights that the SQL twin computes as well: a function of a weight's place and its layer's salt."""
    one = spark.range(1)
    parts = [one.select(F.lit(n).alias("layer"), F.posexplode(_matrix(layer.outputs, layer.inputs, salt)).alias("place", "weights"))
             .select("layer", "place", "weights", F.expr(_weight("place", "0", salt + 1)).alias("bias")) for n, (layer, salt) in layers.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _layer_sql(name: str, x: str, layers=_LAYERS) -> str:
    layer, salt = layers[name]
    act = {"relu": _RELU, "sigmoid": _SIGMOID, "softmax": "exp({})", "none": "{}"}[layer.activation]
    return _dense_sql(x, layer.outputs, layer.inputs, salt, salt + 1 if layer.bias else None, act)


_NAMED = ("share", *score.TASK_NAMES)
_EXPERTS = {**{f"shared_{i}": "share" for i in range(network.SHARED_EXPERTS)}, **{f"{t}_expert": t for t in score.TASK_NAMES}}
_GRAPH = {
    "v0": "SELECT vec_id, embedding::DOUBLE[] AS x FROM embeddings",
    "v1": "SELECT *" + "".join(f", {_layer_sql(f'{n}_gate', 'x')} AS h_{n}" for n in _NAMED) + " FROM v0",
    "v2": "SELECT vec_id, x" + "".join(f", {_layer_sql(f'{n}_gate_out', f'h_{n}')} AS g_{n}" for n in _NAMED) + " FROM v1",
    "v3": "SELECT vec_id" + "".join(f", list_concat(list_transform(range(0, 64), lambda i: x[i + 1] * g_{n}[i // 16 + 1]), x[1:{_EXTRA}]) AS in_{n}"
                                    for n in _NAMED) + " FROM v2",
    "v4": "SELECT *" + "".join(f", {_layer_sql(f'{e}_0', f'in_{n}')} AS a_{e}" for e, n in _EXPERTS.items())
          + "".join(f", {_layer_sql(f'{t}_mix', f'in_{t}')} AS m_{t}" for t in score.TASK_NAMES) + " FROM v3",
    "v5": "SELECT vec_id" + "".join(f", {_layer_sql(f'{e}_1', f'a_{e}')} AS b_{e}" for e in _EXPERTS) + "".join(f", m_{t}" for t in score.TASK_NAMES) + " FROM v4",
    "v6": "SELECT vec_id" + "".join(f", list_transform(range(0, {_EXPERT_UNITS[-1]}), lambda i: (" + " + ".join(
        f"b_{e}[i + 1] * m_{t}[{k + 1}]" for k, e in enumerate((*[f"shared_{i}" for i in range(network.SHARED_EXPERTS)], f"{t}_expert")))
        + f") / list_sum(m_{t})) AS z_{t}" for t in score.TASK_NAMES) + " FROM v5"}


@query("i2_i4_score_small_layers", _with(_GRAPH, "SELECT vec_id" + "".join(
    f", round(({_layer_sql(f'{t}_out', f'z_{t}')})[1], 6) AS {t}" for t in score.TASK_NAMES) + " FROM v6"))
def scored_small(spark, sf_dir):
    net = network.Network(weight_table(spark, _LAYERS), [layer for layer, _ in _LAYERS.values()], "float64")
    rows = table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("x"))
    out = network.score_tasks(rows.withColumn("few", F.slice("x", 1, _EXTRA)), net, "x", "x", "few")
    return out.select("vec_id", *[F.round(t, 6).alias(t) for t in score.TASK_NAMES])


@query("i2_i4_score")
def scored_whole(spark, sf_dir):
    """Samples from raw columns to the four probabilities and the position term, all layers at full width, weights as at the start."""
    df = prepare.clean(for_heavy_work(samples_view(spark, sf_dir)), REGISTRY)
    registry = REGISTRY.present_in(df.columns)
    words = written(vocab.extend_vocab(vocab.vocab_values(df, registry, "sample_id"), vocab.empty_vocab(spark), registry.capacities()), "vocab")
    tops = {f.name: f.vocab_size - 1 for f in registry.group("rank")}
    ranks = written(vocab.rank_vocab(vocab.count_values(df, list(tops)), tops), "ranks")
    rows = prepare.model_rows(prepare.encode(prepare.bucketed(df, registry), registry, words, ranks, "sample_id", tops), registry, "sample_id")
    rows = for_heavy_work(written(rows, "encoded"))
    emb = scoring.start_table(spark, registry, words)
    out = scoring.score_rows(rows, registry, emb, network.generated_weights(spark, scoring.model_layers(registry)), "sample_id")
    return rounded(out, "ctr", "fvtr", "unlock", "cvr", "pos").select("sample_id", "ctr_label", "ctr", "fvtr", "unlock", "cvr", "pos")


# Queries, keys and values of 128 elements, a key being two vectors side by side: the item and another one after it.
_PROJECTED = {n: (network.Layer(n, inputs, network.ATTENTION_UNITS, "none"), salt) for n, inputs, salt in (("query", DIM, 7), ("key", 2 * DIM, 11), ("value", 2 * DIM, 13))}


def _projected_sql(name: str, vec: str, start: int = 0) -> str:
    layer, salt = _PROJECTED[name]
    return f"list_transform(range(0, {layer.outputs}), lambda i: list_sum(list_transform(range(0, {DIM}), lambda j: {_weight('i', f'(j + {start})', salt)} * {vec}[j + 1])))"


def _bias_sql(name: str) -> str:
    layer, salt = _PROJECTED[name]
    return f"(SELECT list_transform(range(0, {layer.outputs}), lambda i: {_weight('i', '0', salt + 1)}))"


_SUMMED = "list_transform(list_zip({0}, {1}), lambda p: p[1] + p[2])"
_NONE = f"list_transform(range(0, {network.ATTENTION_UNITS}), lambda i: 0.0::DOUBLE)"


@query("i1_projected_attention", on("samples", f"""
SELECT clicks.sample_id, round(coalesce(s, 0), 6) + 0.0::DOUBLE AS attended FROM clicks LEFT JOIN (
  SELECT sample_id, sum(exp(score) * d) / sum(exp(score)) AS s FROM (
    SELECT sample_id, list_dot_product({_SUMMED.format(f"coalesce(q.q, {_NONE})", _bias_sql('query'))}, {_SUMMED.format(_SUMMED.format("a.k1", f"coalesce(b.k2, {_NONE})"), _bias_sql('key'))}) / sqrt(128) AS score,
      list_sum(list_transform({_SUMMED.format(_SUMMED.format("a.v1", f"coalesce(b.v2, {_NONE})"), _bias_sql('value'))}, lambda x, i: x * i)) AS d
    FROM (SELECT sample_id, k, unnest(ids) AS id FROM clicks) c JOIN p a ON a.id = c.id LEFT JOIN p b ON b.id = c.id + 1 LEFT JOIN p q ON q.id = c.k WHERE c.id > 0)
  GROUP BY sample_id) USING (sample_id)""", clicks=_CLICKS, v=_V,
    p="SELECT id, " + ", ".join(f"{_projected_sql(n, 'vec', start)} AS {c}" for n, start, c in (
        ("query", 0, "q"), ("key", 0, "k1"), ("key", DIM, "k2"), ("value", 0, "v1"), ("value", DIM, "v2"))) + " FROM v"))
def projected_attention(spark, sf_dir):
    layers = [layer for layer, _ in _PROJECTED.values()]
    net = network.Network(weight_table(spark, _PROJECTED), layers, "float64")
    emb, bound = vectors(spark, sf_dir), vector_bound(spark, sf_dir)
    one, two = network.parts_of([("item", "item")], DIM), network.parts_of([("item", "item"), ("after", "item")], DIM)
    tables = written(network.project_table(emb, net, "query", one, DIM).unionByName(network.project_table(emb, net, "key", two, DIM)).unionByName(
        network.project_table(emb, net, "value", two, DIM)), "projected")
    rows = clicks(spark, sf_dir)
    ids = F.col("ids").cast("array<bigint>")
    # an id without a row is padding to its part; the item beside it decides whether the position counts
    real = F.transform(ids, lambda x: F.when(x > 0, x).otherwise(0))
    after = F.transform(ids, lambda x: F.when(x > 0, x + 1).otherwise(0))
    known = network.with_projected_attention(rows, net, tables, dict.fromkeys(["query/item", "key/item", "key/after", "value/item", "value/after"], bound),
                                             {"item": F.col("k")}, {"item": real, "after": after}, "sample_id", "known")
    return known.select("sample_id", digest(F.col("known")).alias("attended"))


@query("a8_write_scores", on("raw_scored", """
SELECT sample_id, dt, round(ctr, 6) AS ctr, round(fvtr, 6) AS fvtr, round(unlock, 6) AS unlock, round(cvr, 6) AS cvr FROM raw_scored"""))
def write_scores(spark, sf_dir):
    path = new_path(spark, "scores")
    out = rounded(raw_scored(spark, sf_dir).select("sample_id", "dt", "ctr", "fvtr", "unlock", "cvr"), "ctr", "fvtr", "unlock", "cvr")
    state.write_scores(out, path, "dt")
    return spark.read.schema(out.schema).parquet(path)


# --- K -------------------------------------------------------------------------------------------

def _loss_sql(label: str, pred: str, weight: str = "1.0", loss: str = "") -> str:
    row = loss or f"-({label} * ln({pred} + 1e-7) + (1 - {label}) * ln(1 - {pred} + 1e-7))"
    return f"round(coalesce(sum({weight} * ({row})) / nullif(count(*) FILTER ({weight} <> 0), 0), 0), 6)"


_TASK_SQL = {"ctr": ("ctr_label", "ctr_debiased", "ctr_debiased", "1.0"), "fvtr": ("finish_view_label", "fvtr", "ctfvtr", "1.0"),
             "unlock": ("unlock_label", "unlock", "ctunlock", "1.0"), "cvr": ("cvr_label", "cvr", "ctcvr", "non_member")}


@query("k1_log_loss", on("scored", f"""
SELECT gender, {_loss_sql('ctr_label', 'ctr')} AS added, {_loss_sql('cvr_label', 'cvr', 'non_member')} AS weighted,
       {_loss_sql('ctr_label', 'ctr', loss='-(ctr_label * ln(least(greatest(ctr, 1e-7), 1 - 1e-7)) + (1 - ctr_label) * ln(1 - least(greatest(ctr, 1e-7), 1 - 1e-7)))')} AS clipped
FROM scored GROUP BY gender"""))
def log_losses(spark, sf_dir):
    out = scored(spark, sf_dir).groupBy("gender").agg(
        metrics.log_loss(F.col("ctr_label"), F.col("ctr")).alias("added"),
        metrics.log_loss(F.col("cvr_label"), F.col("cvr"), F.col("non_member")).alias("weighted"),
        metrics.log_loss(F.col("ctr_label"), F.col("ctr"), clip=True).alias("clipped"))
    return rounded(out, "added", "weighted", "clipped")


@query("k2_non_member_weight", on("scored", "SELECT sample_id, vip_label, cast(non_member AS DOUBLE) AS non_member FROM scored"))
def non_member(spark, sf_dir):
    return scored(spark, sf_dir).select("sample_id", "vip_label", "non_member")


def _auc_sql(view: str, task: str, label: str, pred: str, weight: str, thresholds: int = 1001, by: str = "") -> str:
    """AUC from the confusion counts at every threshold: a spine of thresholds, sums above each, trapezoids."""
    n = thresholds - 1
    return f"""SELECT {by}'{task}' AS task, round(sum((fpr - next_fpr) * (tpr + next_tpr) / 2), 6) AS auc FROM (
  SELECT *, lead(fpr) OVER (ORDER BY i) AS next_fpr, lead(tpr) OVER (ORDER BY i) AS next_tpr FROM (
    SELECT i, (sum(pos) FILTER (bin > i OR i = 0 ) + 1e-6) / (sum(pos) + 1e-6) AS tpr, coalesce(sum(neg) FILTER (bin > i OR i = 0), 0) / (sum(neg) + 1e-6) AS fpr
    FROM (SELECT unnest(range(0, {n})) AS i) CROSS JOIN (SELECT ceil({pred} * {n}) AS bin, sum({weight} * {label}) AS pos, sum({weight} * (1 - {label})) AS neg FROM {view} GROUP BY 1) GROUP BY i
    UNION ALL SELECT {n}, 1e-6 / (sum({weight} * {label}) + 1e-6), 0 FROM {view})) WHERE i < {n}"""


@query("k4_auc", on("scored", f"{_auc_sql('scored', 'cvr', 'cvr_label', 'cvr', 'non_member')} UNION ALL {_auc_sql('scored', 'ctr', 'ctr_label', 'ctr', '1.0', 200)}"))
def aucs(spark, sf_dir):
    rows = scored(spark, sf_dir)
    wide = metrics.auc(rows, "cvr_label", "cvr", "non_member").select(F.lit("cvr").alias("task"), "auc")
    coarse = metrics.auc(rows, "ctr_label", "ctr", thresholds=200).select(F.lit("ctr").alias("task"), "auc")
    return rounded(wide.unionByName(coarse), "auc")


@query("k5_auc_exact", on("scored", """
SELECT round(sum(neg * (above + pos / 2)) / (sum(pos) * sum(neg)), 6) AS auc FROM (
  SELECT pos, neg, coalesce(sum(pos) OVER (ORDER BY ctr DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS above FROM (
    SELECT ctr, sum(non_member * ctr_label)::DOUBLE AS pos, sum(non_member * (1 - ctr_label))::DOUBLE AS neg FROM scored GROUP BY ctr))"""))
def exact_auc(spark, sf_dir):
    return rounded(metrics.auc_exact(scored(spark, sf_dir), "ctr_label", "ctr", "non_member"), "auc")


@query("k5_auc_of_labels", """
SELECT round(sum(neg * (above + pos / 2)) / (sum(pos) * sum(neg)), 6) AS auc FROM (
  SELECT pos, neg, coalesce(sum(pos) OVER (ORDER BY p DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS above FROM (
    SELECT n_chars::DOUBLE AS p, sum(quality)::DOUBLE AS pos, sum(1 - quality)::DOUBLE AS neg FROM labels JOIN documents USING (doc_id) GROUP BY 1))""")
def labels_auc(spark, sf_dir):
    rows = table(spark, sf_dir, "labels").join(table(spark, sf_dir, "documents").select("doc_id", F.col("n_chars").cast("double").alias("p")), "doc_id")
    return rounded(metrics.auc_exact(rows, "quality", "p"), "auc")


_EVALUATED = {f"auc_{t}": _auc_sql("scored", t, label, ranked, w) for t, (label, ranked, _, w) in _TASK_SQL.items()}
_EVALUATED["evaluated"] = " UNION ALL ".join(
    f"SELECT '{t}' AS task, {_loss_sql(label, in_loss, w)} AS loss, (SELECT auc FROM auc_{t}) AS auc, count(*) AS rows FROM scored"
    for t, (label, _, in_loss, w) in _TASK_SQL.items())


@query("k6_evaluate", on("scored", "SELECT task, loss, auc, rows FROM evaluated", **_EVALUATED))
def evaluated(spark, sf_dir):
    return rounded(metrics.evaluate(scored(spark, sf_dir)), "loss", "auc")


@query("k3_total_loss", on("scored", "SELECT round(" + " + ".join(
    f"(SELECT {_loss_sql(label, in_loss, w).replace(', 6)', ', 9)')} FROM scored)" for label, _, in_loss, w in _TASK_SQL.values()) + ", 6) AS total_loss"))
def total(spark, sf_dir):
    return rounded(metrics.total_loss(metrics.evaluate(scored(spark, sf_dir))), "total_loss")


# --- J: fitting --------------------------------------------------------------------------------------

_HELD = f"{md5_sql("concat('7:', cast(sample_id AS VARCHAR))")} < {round(0.2 * (1 << 60))}"
_FITTED = ", ".join(f"round(r_{t}, 3) + 0.0::DOUBLE AS {t}" for t in fit.TASK_LABELS)
_RATES = ", ".join(f"avg({label}) AS r_{t}" for t, label in fit.TASK_LABELS.items())


@query("j1_fit_tasks", on("labelled", f"""
SELECT h.gender, n, {_FITTED} FROM (SELECT gender, count(*) AS n FROM labelled WHERE gender IS NOT NULL AND {_HELD} GROUP BY gender) h
JOIN (SELECT gender, {_RATES} FROM labelled WHERE NOT {_HELD} GROUP BY gender) k ON h.gender = k.gender"""))
def tasks(spark, sf_dir):
    """Scores of held-out rows, from a fit on the others: with one text as feature, the rates of its values there."""
    rows = written(labelled(spark, sf_dir), "labelled")
    kept, held = samples.split_holdout(rows, "sample_id", 0.2)
    out = fit.predict_tasks(held, fit.fit_tasks(kept, ["gender"], max_iter=200))
    parts = out.where("gender IS NOT NULL").groupBy("gender").agg(F.count(F.lit(1)).alias("n"), *[F.avg(t).alias(t) for t in fit.TASK_LABELS])
    return parts.select("gender", "n", *[(F.round(t, 3) + F.lit(0.0)).alias(t) for t in fit.TASK_LABELS])


@query("j2_fit_two_tower", on("labelled", f"SELECT count(*) AS n, true AS inside, true AS learnt FROM labelled WHERE {_HELD}"))
def two_tower(spark, sf_dir):
    """Held-out rows, whether their scores are probabilities, and whether the fitted rows' loss is below the base rate's."""
    rows = written(labelled(spark, sf_dir).select("sample_id", "userid", "book_id", "ctr_label"), "pairs")
    kept, held = samples.split_holdout(rows, "sample_id", 0.2)
    model = fit.fit_two_tower(kept, "userid", "book_id", "ctr_label", max_iter=60)
    out, own = fit.predict_two_tower(held, model), fit.predict_two_tower(kept, model)
    y, p, rate = F.col("ctr_label"), F.col("score"), kept.agg(F.avg("ctr_label")).first()[0]
    loss = lambda p: F.avg(-(y * F.ln(p + 1e-7) + (1 - y) * F.ln(1 - p + 1e-7)))
    learnt = own.agg((loss(p) < loss(F.lit(rate))).alias("x")).first().x
    return out.agg(F.count(F.lit(1)).alias("n"), ((F.min(p) >= 0) & (F.max(p) <= 1)).alias("inside"), F.lit(learnt).alias("learnt"))
