"""Dense layers at full width: one matrix product per Arrow batch and layer, the graph in Spark columns.

A weight table is `layer string, place int, weights array<double>, bias double`, a row per output of a layer.  The layers that a
score uses are fetched once, checked against their declared sizes, and held per executor.  Each block below is a column function, so
Spark plans the graph, prunes what is not used and spreads the rows; a row's result depends on that row only.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rankflow.operators.embed import as_lists, blocks_of, in_blocks, list_rows, load_matrices, wanted_by
from rankflow.operators.layout import BROADCAST_ROWS
from rankflow.operators.score import TASK_NAMES
from rankflow.registry import EMBEDDING_DIM

# Parameters of all layers together that an executor may be asked to hold.
MAX_PARAMETERS = 100_000_000
# Bytes of projected tables that a worker may be asked to hold.
HELD_BYTES = 64 << 20
# Rows that pass through the layers of a block together.
BLOCK_ROWS = 1024
# The widths of the reference's layers, and its shared experts.
GATE_UNITS = 512
EXPERT_UNITS = (512, 256, 128, 64)
SHARED_EXPERTS = 3
ATTENTION_UNITS = 128

ACTIVATIONS = {
    "none": lambda x: x,
    "relu": lambda x: np.maximum(x, 0),
    "sigmoid": lambda x: 1 / (1 + np.exp(-x)),
    "softmax": lambda x: (e := np.exp(x - x.max(1, keepdims=True))) / e.sum(1, keepdims=True),
}


@dataclass(frozen=True)
class Layer:
    name: str
    inputs: int
    outputs: int
    activation: str = "relu"
    bias: bool = True

    @property
    def parameters(self) -> int:
        return self.outputs * (self.inputs + self.bias)


class Network:
    """The weights of some layers, fetched once and held per executor."""

    def __init__(self, table: DataFrame, layers: Sequence[Layer], dtype=np.float32):
        """A layer whose rows or widths differ from its declaration is an error, as are more than MAX_PARAMETERS."""
        total = sum(layer.parameters for layer in layers)
        if total > MAX_PARAMETERS:
            raise ValueError(f"{total} parameters are more than an executor should hold")
        self.layers = {layer.name: layer for layer in layers}
        self.dtype = np.dtype(dtype)
        self.kind = "float" if self.dtype == np.float32 else "double"
        rows = (table.where(F.col("layer").isin(list(self.layers))).select(
            "layer", "place", F.col("weights").cast(f"array<{self.kind}>").alias("weights"), F.col("bias").cast("double").alias("bias"))
            .limit(sum(layer.outputs for layer in layers) + 1).toArrow())
        names = rows.column("layer").to_numpy()
        self.weights = {}
        for layer in layers:
            mine = rows.filter(pa.array(names == layer.name)).combine_chunks()
            order = np.argsort(mine.column("place").to_numpy())
            if not np.array_equal(mine.column("place").to_numpy()[order], np.arange(layer.outputs)):
                raise ValueError(f"layer {layer.name} should have the outputs 0 to {layer.outputs - 1}")
            values = mine.column("weights").combine_chunks().flatten().to_numpy(zero_copy_only=False)
            if len(values) != layer.outputs * layer.inputs:
                raise ValueError(f"layer {layer.name} should have {layer.inputs} inputs")
            bias = mine.column("bias").to_numpy(zero_copy_only=False)[order] if layer.bias else np.zeros(layer.outputs)
            self.weights[layer.name] = (np.ascontiguousarray(values.reshape(layer.outputs, layer.inputs)[order].T.astype(dtype)),
                                        bias.astype(dtype))
        self.shared = table.sparkSession.sparkContext.broadcast({n: (w, b, self.layers[n].activation) for n, (w, b) in self.weights.items()})

    def width(self, stack: Sequence[str]) -> int:
        return self.layers[stack[-1]].outputs


def run_stack(x: np.ndarray, held: Mapping, stack: Sequence[str]) -> np.ndarray:
    for name in stack:
        weights, bias, activation = held[name]
        x = x @ weights
        x += bias
        x = np.maximum(x, 0, out=x) if activation == "relu" else ACTIVATIONS[activation](x)
    return x


def _matrix(column: pa.Array, dtype) -> np.ndarray:
    """Equally long lists as a matrix, rows of a slice included."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1).astype(dtype, copy=False)


def _blocks(n: int) -> Iterator[slice]:
    return (slice(a, min(a + BLOCK_ROWS, n)) for a in range(0, n, BLOCK_ROWS))


def stack_block(net: Network, stacks: Sequence[Sequence[str]], x: Column) -> Column:
    """Stacks of layers over one input, their outputs side by side in one array."""
    shared, dtype, width = net.shared, net.dtype, sum(net.width(s) for s in stacks)

    @F.arrow_udf(f"array<{net.kind}>")
    def block(x: pa.Array) -> pa.Array:
        held = shared.value
        rows = _matrix(x, dtype)
        out = np.empty((len(x), width), dtype)
        for part in _blocks(len(x)):
            out[part] = np.hstack([run_stack(rows[part], held, s) for s in stacks])
        return as_lists(out)

    return block(x.cast(f"array<{net.kind}>"))


def tower_scores(net: Network, common: Sequence[Sequence[str]], own: Mapping[str, tuple[Sequence[str], str, str]], fields: Column,
                 gates: Column, extra: Column, dim: int = EMBEDDING_DIM) -> Column:
    """A probability per task: stacks over gated fields, mixed by a gate of the task's own, and a sigmoid over one inner product.

    `fields` holds vectors of `dim` elements side by side; a tower scales each by its gate and puts `extra` behind them.  `gates`
    holds the gates of the tower that the `common` stacks share, then those of each task's.  `own` gives a task's stack, mixing layer and
    head.  The towers and what the stacks give exist inside the block only.
    """
    shared, dtype, steps = net.shared, net.dtype, list(own.values())

    @F.arrow_udf("array<double>")
    def block(fields: pa.Array, gates: pa.Array, extra: pa.Array) -> pa.Array:
        held = shared.value
        f, g, e = (_matrix(c, dtype) for c in (fields, gates, extra))
        out = np.empty((len(f), len(steps)))
        for part in _blocks(len(f)):
            n = part.stop - part.start
            vecs, gate = f[part].reshape(n, -1, dim), g[part].reshape(n, 1 + len(steps), -1, 1)
            x = np.empty((n, f.shape[1] + e.shape[1]), dtype)
            x[:, f.shape[1]:] = e[part]

            def tower(k: int) -> np.ndarray:
                x[:, :f.shape[1]] = (vecs * gate[:, k]).reshape(n, -1)
                return x

            outs = [run_stack(tower(0), held, s).astype(np.float64) for s in common]
            for k, (stack, mix, head) in enumerate(steps):
                x = tower(1 + k)
                share = run_stack(x, held, [mix]).astype(np.float64)
                mixed = sum(o * share[:, i:i + 1] for i, o in enumerate([*outs, run_stack(x, held, stack)]))
                out[part, k] = 1 / (1 + np.exp(-(mixed @ held[head][0][:, 0].astype(np.float64))))
        return as_lists(out)

    kind = f"array<{net.kind}>"
    return block(fields.cast(kind), gates.cast(kind), extra.cast(kind))


def task_layers(fields: int, gate_inputs: int, extra: int, dim: int = EMBEDDING_DIM, tasks: Sequence[str] = TASK_NAMES,
                gate_units: int = GATE_UNITS, expert_units: Sequence[int] = EXPERT_UNITS, shared: int = SHARED_EXPERTS) -> list[Layer]:
    """The layers of the whole graph: a gate for the shared experts and for each task, the experts, a mixing gate and a head per task."""
    width, out = fields * dim + extra, []
    for name in ("share", *tasks):
        out += [Layer(f"{name}_gate", gate_inputs, gate_units), Layer(f"{name}_gate_out", gate_units, fields, "sigmoid", bias=False)]
    for name in (*[f"shared_{i}" for i in range(shared)], *[f"{t}_expert" for t in tasks]):
        sizes = [width, *expert_units]
        out += [Layer(f"{name}_{k}", a, b) for k, (a, b) in enumerate(zip(sizes, sizes[1:]))]
    for t in tasks:
        out += [Layer(f"{t}_mix", width, shared + 1, "softmax"), Layer(f"{t}_out", expert_units[-1], 1, "sigmoid", bias=False)]
    return out


def score_tasks(df: DataFrame, net: Network, fields: str, gate_input: str, extra: str, tasks: Sequence[str] = TASK_NAMES,
                dim: int = EMBEDDING_DIM) -> DataFrame:
    """Add a probability per task: gated fields through shared and own experts, mixed by a gate of the task's own.

    `fields` and `extra` are arrays of fixed width without nulls.  Two passes through Python, whatever the number of tasks: the gates, then the towers with
    mixing and heads, each input sent once.
    """
    depth = sum(1 for n in net.layers if n.startswith("shared_0_"))
    shared = sum(1 for n in net.layers if n.startswith("shared_") and n.endswith("_0"))

    def expert(name: str) -> list[str]:
        return [f"{name}_{k}" for k in range(depth)]

    gated = df.withColumn("__gates_of_towers", stack_block(net, [[f"{n}_gate", f"{n}_gate_out"] for n in ("share", *tasks)], F.col(gate_input)))
    scores = tower_scores(net, [expert(f"shared_{i}") for i in range(shared)], {t: (expert(f"{t}_expert"), f"{t}_mix", f"{t}_out") for t in tasks},
                          F.col(fields), F.col("__gates_of_towers"), F.col(extra), dim)
    return gated.withColumn("__scores", scores).select(*[F.col(c) for c in df.columns], *[F.get("__scores", F.lit(i)).alias(t) for i, t in enumerate(tasks)])


def gather_fields(emb: DataFrame, scalars: Mapping[str, Column], lists: Mapping[str, Column], bounds: Mapping[str, int],
                  dtype=np.float32) -> Column:
    """The vectors of many features side by side, in one pass: one per id of `scalars`, the mean of the positive ids per list of `lists`.

    Keys are embedding features.  Ids without a vector and empty lists give zeros.  The tables are held per executor; `bounds` gives their most rows.
    """
    matrices = load_matrices(emb, {f: bounds[f] for f in (*scalars, *lists)}, dtype)
    dim, kind = next(iter(matrices.values())).dim, "float" if np.dtype(dtype) == np.float32 else "double"
    scalar_names, list_names = list(scalars), list(lists)

    def one(matrix, ids: np.ndarray) -> np.ndarray:
        out = np.zeros((len(ids), dim), dtype)
        vecs, found = matrix.rows(ids)
        out[found] = vecs
        return out

    def mean(matrix, flat: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
        flat, rows = flat[flat > 0], rows[flat > 0]
        vecs, found = matrix.rows(flat)
        out = np.zeros((n, dim), dtype)
        np.add.at(out, rows[found], vecs)
        return out / np.maximum(np.bincount(rows, minlength=n), 1).astype(dtype)[:, None]

    @F.arrow_udf(f"array<{kind}>")
    def gathered(ids: pa.Array, items: pa.Array) -> pa.Array:
        n = len(ids)
        out = np.empty((n, (len(scalar_names) + len(list_names)) * dim), dtype)
        for i, (f, column) in enumerate(zip(scalar_names, ids.flatten())):
            out[:, i * dim:(i + 1) * dim] = one(matrices[f], column.to_numpy(zero_copy_only=False))
        for i, (f, column) in enumerate(zip(list_names, items.flatten()), len(scalar_names)):
            flat, rows = list_rows(column)
            out[:, i * dim:(i + 1) * dim] = mean(matrices[f], flat.astype(np.int64), rows, n)
        return as_lists(out)

    none = F.lit(0).alias("none")  # a struct needs a field
    return gathered(F.struct(*[_whole(c).alias(f"s{i}") for i, c in enumerate(scalars.values())], none),
                    F.struct(*[_whole_list(c).alias(f"l{i}") for i, c in enumerate(lists.values())], none))


def _whole(ids: Column) -> Column:
    """A missing id as one that no table has."""
    return F.coalesce(ids.cast("bigint"), F.lit(-1).cast("bigint"))


def _whole_list(ids: Column) -> Column:
    return F.transform(F.coalesce(ids, F.array()).cast("array<bigint>"), _whole)


# --- attention over projected tables -----------------------------------------------------------------

@dataclass(frozen=True)
class Part:
    """One of the vectors side by side that a projection reads: an embedding feature, and where its elements start."""
    name: str
    feature: str
    start: int


def parts_of(features: Sequence[tuple[str, str]], dim: int = EMBEDDING_DIM) -> list[Part]:
    """Parts from (name, embedding feature), `dim` elements each, in order."""
    return [Part(name, feature, i * dim) for i, (name, feature) in enumerate(features)]


def project_table(emb: DataFrame, net: Network, layer: str, parts: Sequence[Part], dim: int = EMBEDDING_DIM) -> DataFrame:
    """The embedding table `feature, id, vec` times a layer's weights: `feature` is then `<layer>/<part>`.

    A layer over vectors side by side is the sum of what each vector gives alone, so every embedding row is multiplied once, by
    the weights of each part that it can stand in, and not again for every list position.  The bias is left out.  Nothing is shuffled.
    """
    names: dict[str, list[int]] = {}
    for i, p in enumerate(parts):
        names.setdefault(p.feature, []).append(i)
    shared, dtype, starts = net.shared, net.dtype, [p.start for p in parts]
    of_feature = F.create_map(*[x for f, places in names.items() for x in (F.lit(f), F.array(*[F.lit(i) for i in places]))])

    @F.arrow_udf(f"array<{net.kind}>")
    def product(vecs: pa.Array, places: pa.Array) -> pa.Array:
        weights = shared.value[layer][0]
        rows, which = _matrix(vecs, dtype), places.to_numpy(zero_copy_only=False)
        out = np.empty((len(rows), weights.shape[1]), dtype)
        for i in np.unique(which):
            mine = which == i
            out[mine] = rows[mine] @ weights[starts[i]:starts[i] + dim]
        return as_lists(out)

    placed = emb.where(F.col("feature").isin(list(names))).withColumn("__place", F.explode(F.get(F.array(of_feature), F.lit(0))[F.col("feature")]))
    label = F.get(F.array(*[F.lit(f"{layer}/{p.name}") for p in parts]), F.col("__place"))
    return placed.select(label.alias("feature"), "id", product(F.col("vec").cast(f"array<{net.kind}>"), F.col("__place")).alias("vec"))


def projected_attention(net: Network, projected: DataFrame, bounds: Mapping[str, int], query: Mapping[str, Column], lists: Mapping[str, Column],
                        layers: tuple[str, str, str] = ("query", "key", "value")) -> Column:
    """Attention over the positions of some lists with projected queries, keys and values.

    `query` and `lists` give the ids of each part; a position's key and value are the sums over the lists' parts there, plus the
    bias.  Positions without a positive, known id in any list are padding and masked; a row of padding only gives the zero vector.
    `projected` is the union of `project_table` for the three layers, `bounds` the most rows of each of its features; it is held per executor.
    """
    q_layer, k_layer, v_layer = layers
    matrices = load_matrices(projected, {f: bounds[f] for f in _projected_features(query, lists, layers)}, net.dtype)
    dtype, width, attend = net.dtype, net.layers[q_layer].outputs, _attention(net, list(query), list(lists), layers)

    @F.arrow_udf(f"array<{net.kind}>")
    def attended(ids: pa.Array, items: pa.Array) -> pa.Array:
        return as_lists(_by_parts(attend, lambda feature, some: matrices[feature].rows(some), ids, items, width, dtype))

    return attended(*_id_structs(query, lists))


def with_projected_attention(df: DataFrame, net: Network, projected: DataFrame, bounds: Mapping[str, int], query: Mapping[str, Column],
                             lists: Mapping[str, Column], key: str, out: str, layers: tuple[str, str, str] = ("query", "key", "value")) -> DataFrame:
    """Add the attention over projected queries, keys and values, see `projected_attention`, for tables of any size.

    Tables that take up to HELD_BYTES together are held per executor, from larger ones vectors are sent to blocks of rows, see
    `embed.in_blocks`; the result is the same.
    """
    features = _projected_features(query, lists, layers)
    dtype, width = net.dtype, net.layers[layers[0]].outputs
    rows_held = [bounds[f] for f in features]
    if sum(rows_held) * width * dtype.itemsize <= HELD_BYTES and max(rows_held) <= BROADCAST_ROWS:
        return df.withColumn(out, projected_attention(net, projected, bounds, query, lists, layers))
    ids, items = _id_structs(query, lists)
    kept = [c for c in df.columns if c != out]
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = df.select(*[F.col(c) for c in kept], ids.alias("__ids"), items.alias("__items"), blocks_of(F.col(key), partitions, F.xxhash64(ids, items)).alias("__block"))
    # a part's id is wanted once, whatever the number of tables that it stands in
    one = lambda part: lambda i: F.struct(F.lit(part).alias("part"), i.alias("id"))
    needs = F.concat(F.array(*[one(i)(F.col(f"__ids.q{i}")) for i in range(len(query))]),
                     *[F.transform(F.filter(F.col(f"__items.l{i}"), lambda x: x > 0), one(len(query) + i)) for i in range(len(lists))])
    tables = [[f"{layers[0]}/{p}"] for p in query] + [[f"{layer}/{p}" for layer in layers[1:]] for p in lists]
    of_part = F.array(*[F.array(*map(F.lit, t)) for t in tables])
    wanted = wanted_by(rows, needs).select("__to", F.explode(F.get(of_part, F.col("part"))).alias("feature"), "id")
    attend = _attention(net, list(query), list(lists), layers)

    def answer(some: pa.Table, sent: pa.Table) -> pa.Table:
        names, known, vecs = sent.column("feature").to_numpy(), sent.column("id").to_numpy(), _matrix(sent.column("vec").combine_chunks(), dtype)
        places = {f: (at := np.flatnonzero(names == f))[np.argsort(known[at], kind="stable")] for f in features}

        def find(feature: str, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            place = places[feature]
            if not len(place):
                return np.zeros((0, width), dtype), np.zeros(len(ids), bool)
            at = np.minimum(np.searchsorted(known[place], ids), len(place) - 1)
            found = known[place[at]] == ids
            return vecs[place[at[found]]], found

        given, listed = (some.column(c).combine_chunks() for c in ("__ids", "__items"))
        return pa.table([*(some.column(c) for c in kept), as_lists(_by_parts(attend, find, given, listed, width, dtype))], names=[*kept, out])

    schema = T.StructType([*(df.schema[c] for c in kept), T.StructField(out, T.ArrayType(T.FloatType() if net.kind == "float" else T.DoubleType()))])
    vectors = projected.where(F.col("vec").isNotNull()).select("feature", F.col("id").cast("bigint").alias("id"), "vec")
    return in_blocks(rows, wanted, vectors, schema, answer)


def _projected_features(query: Mapping[str, Column], lists: Mapping[str, Column], layers: tuple[str, str, str]) -> list[str]:
    return [f"{layer}/{p}" for layer, parts in zip(layers, (query, lists, lists)) for p in parts]


def _id_structs(query: Mapping[str, Column], lists: Mapping[str, Column]) -> tuple[Column, Column]:
    return (F.struct(*[_whole(c).alias(f"q{i}") for i, c in enumerate(query.values())]),
            F.struct(*[_whole_list(c).alias(f"l{i}") for i, c in enumerate(lists.values())]))


def _by_parts(attend: Callable, find: Callable, ids: pa.StructArray, items: pa.StructArray, width: int, dtype) -> np.ndarray:
    columns = [c.to_numpy(zero_copy_only=False) for c in ids.flatten()]
    out = np.empty((len(ids), width), dtype)
    for part in _blocks(len(ids)):
        some = items.slice(part.start, part.stop - part.start).flatten()
        out[part] = attend(find, [c[part] for c in columns], [tuple(a.astype(np.int64) for a in list_rows(c)) for c in some], part.stop - part.start)
    return out


def _attention(net: Network, query_parts: Sequence[str], list_parts: Sequence[str], layers: tuple[str, str, str]) -> Callable:
    """A function of `find` (a feature's vectors of some ids, and which ids have one), the query ids per part, the list items and
    their rows per part, and the number of rows.  Only positions that are no padding take up memory.
    """
    q_layer, k_layer, v_layer = layers
    shared, dtype, width = net.shared, net.dtype, net.layers[q_layer].outputs

    def attend(find: Callable, ids: list[np.ndarray], flats: list[tuple[np.ndarray, np.ndarray]], n: int) -> np.ndarray:
        held = shared.value
        q = np.tile(held[q_layer][1], (n, 1))
        for part, column in zip(query_parts, ids):
            vecs, found = find(f"{q_layer}/{part}", column)
            q[found] += vecs
        lengths = np.max([np.bincount(rows, minlength=n) for _, rows in flats], axis=0)
        begins = np.cumsum(lengths) - lengths
        real, hits = np.zeros(lengths.sum(), bool), []
        for part, (flat, rows) in zip(list_parts, flats):
            at = (begins[rows] + np.arange(len(rows)) - np.searchsorted(rows, rows))[flat > 0]
            for layer in (k_layer, v_layer):
                vecs, found = find(f"{layer}/{part}", flat[flat > 0])
                hits.append((layer, at[found], vecs))
                real[at[found]] = True
        out, owner = np.zeros((n, width), dtype), np.repeat(np.arange(n), lengths)[real]
        if not len(owner):
            return out
        slot = np.cumsum(real) - 1
        sums = {layer: np.tile(held[layer][1], (len(owner), 1)) for layer in (k_layer, v_layer)}
        for layer, at, vecs in hits:
            sums[layer][slot[at]] += vecs
        scores = np.einsum("pd,pd->p", q[owner], sums[k_layer]) / np.sqrt(width).astype(dtype)
        starts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
        sizes = np.diff(np.r_[starts, len(owner)])
        e = np.exp(scores - np.repeat(np.maximum.reduceat(scores, starts), sizes))
        # totals run over a row's whole list, so that a score does not depend on how padding is left out
        spread = np.zeros((n, lengths.max()), dtype)
        spread[owner, (np.arange(len(real)) - np.repeat(begins, lengths))[real]] = e
        share = e / np.maximum(spread.sum(1), np.finfo(dtype).tiny)[owner]
        # rows with about as many positions are summed together
        place, sort = np.arange(len(owner)) - np.repeat(starts, sizes), np.ceil(np.log2(sizes)).astype(np.int64)
        for some in np.unique(sort):
            mine = sort == some
            chosen, row = np.repeat(mine, sizes), np.repeat(np.arange(mine.sum()), sizes[mine])
            shares, values = np.zeros((mine.sum(), 1 << some), dtype), np.zeros((mine.sum(), 1 << some, width), dtype)
            shares[row, place[chosen]], values[row, place[chosen]] = share[chosen], sums[v_layer][chosen]
            out[owner[starts[mine]]] = np.einsum("nt,ntd->nd", shares, values)
        return out

    return attend


def generated_weights(spark: SparkSession, layers: Sequence[Layer], seed: int = 42) -> DataFrame:
    """A start weight table: uniform within the bounds that keep a layer's variance (sqrt(6 / (inputs + outputs))), zero biases.

    Each weight is a function of its layer, place and the seed; rows are made on the executors.
    """
    spec = spark.createDataFrame([(x.name, x.inputs, x.outputs, (6 / (x.inputs + x.outputs)) ** 0.5) for x in layers],
                                 "layer string, inputs int, outputs int, reach double")
    rows = spec.repartition(len(layers), "layer").select("*", F.explode(F.sequence(F.lit(0), F.col("outputs") - 1)).alias("place"))
    draw = F.transform(F.sequence(F.lit(0), F.col("inputs") - 1), lambda j: (
        (F.pmod(F.xxhash64(F.lit(seed), "layer", "place", j), F.lit(1 << 30)) * (2.0 / (1 << 30)) - 1) * F.col("reach")).cast("float"))
    return rows.select("layer", "place", draw.cast("array<double>").alias("weights"), F.lit(0.0).alias("bias"))
