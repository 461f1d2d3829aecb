"""Scoring: feature gates, expert mix, task heads, attention, position term, two towers.

All but the attention over small tables are column expressions, so Spark plans and spreads the
whole score; a row's score depends on that row only.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rankflow.functions.numeric import sigmoid
from rankflow.functions.vectors import as_vector, dot, relu_vector, softmax, zero_vector
from rankflow.operators.embed import as_lists, key_parts, list_answers, list_rows, load_matrices, lookup, masked_lists, matches, padded
from rankflow.operators.layout import BROADCAST_ROWS
from rankflow.registry import EMBEDDING_DIM

TASK_NAMES = ("ctr", "fvtr", "unlock", "cvr")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is computed once, however often the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def dense(x: Column, weights: Column, bias: Column | None = None) -> Column:
    """A layer: one inner product per row of `weights` (an array of arrays), plus `bias`."""
    out = let(x, lambda v: F.transform(weights, lambda row: dot(row, v)))
    return out if bias is None else F.zip_with(out, bias, lambda a, b: a + b)


def feature_gate(x: Column, fields: Column, hidden: Column, hidden_bias: Column, out: Column) -> Column:
    """`fields` (an array of vectors), each scaled by its gate: a hidden layer and a sigmoid per field, over the gate input `x`."""
    gates = F.transform(dense(relu_vector(dense(x, hidden, hidden_bias)), out), sigmoid)
    return F.zip_with(fields, gates, lambda field, gate: F.transform(field, lambda v: v * gate))


def expert(x: Column, layers: Sequence[tuple[Column, Column]]) -> Column:
    """A stack of layers, each cut at zero."""
    for weights, bias in layers:
        x = relu_vector(dense(x, weights, bias))
    return x


def expert_mix(x: Column, experts: Sequence[Column], gate: Column, width: int, gate_bias: Column | None = None) -> Column:
    """The experts' outputs, each of `width` elements, weighted by a softmax over `x`."""
    return let(softmax_of(dense(x, gate, gate_bias)), lambda share: let(F.array(*experts), lambda outs: F.transform(
        F.sequence(F.lit(0), F.lit(width - 1)), lambda i: F.aggregate(
            F.zip_with(outs, share, lambda o, s: F.get(o, i) * s), F.lit(0.0), lambda total, v: total + v))))


def softmax_of(v: Column) -> Column:
    return let(v, softmax)


def task_head(mixed: Column, weights: Column) -> Column:
    """Probability of one task: a sigmoid over one inner product, without bias."""
    return sigmoid(dot(mixed, weights))


def position_debias(ctr: Column, pos: Column, debias: bool = True) -> Column:
    """Click score times the position term while fitting and evaluating; the bare score when predicting."""
    return ctr * pos if debias else ctr


def chain_probabilities(ctr: Column, heads: Mapping[str, Column]) -> dict[str, Column]:
    """Probability of a click followed by each later action."""
    return {f"ct{name}": ctr * p for name, p in heads.items()}


def attention_pool(query: Column, ids: Column, emb: DataFrame, feature: str, bound: int) -> Column:
    """Attention of a query vector over the vectors of a list of ids, id 0 left out."""
    matrix = load_matrices(emb, {feature: bound})[feature]

    @F.arrow_udf("array<double>")
    def attended(queries: pa.Array, lists: pa.Array) -> pa.Array:
        flat, rows = list_rows(lists)
        vecs, found = matrix.rows(flat.astype(np.int64))
        used = found.copy()
        used[found] = flat[found] > 0
        vecs, rows = vecs[flat[found] > 0], rows[used]
        n = len(lists)
        q = queries.flatten().to_numpy(zero_copy_only=False).reshape(n, -1)
        scores = np.einsum("id,id->i", q[rows], vecs) / np.sqrt(q.shape[1])
        out = np.zeros((n, matrix.dim))
        if len(rows):
            starts = np.flatnonzero(np.r_[True, rows[1:] != rows[:-1]])
            lengths = np.diff(np.r_[starts, len(rows)])
            e = np.exp(scores - np.repeat(np.maximum.reduceat(scores, starts), lengths))
            share = e / np.repeat(np.add.reduceat(e, starts), lengths)
            out[rows[starts]] = np.add.reduceat(vecs * share[:, None], starts)
        return as_lists(out)

    return attended(as_vector(query), F.coalesce(ids, F.array()).cast("array<bigint>"))


def with_attention(df: DataFrame, query: str, ids: str, emb: DataFrame, feature: str, key: str, out: str, bound: int | None,
                   dim: int = EMBEDDING_DIM) -> DataFrame:
    """Add the attention of a query vector over a list of ids, for tables of any size; an empty list gives the zero vector.

    Tables within the broadcast limit are held per executor.  From larger ones vectors are sent to blocks of rows, see `embed.in_blocks`;
    a row's items are weighted against the row's highest score.
    """
    if bound is not None and bound <= BROADCAST_ROWS:
        return df.withColumn(out, attention_pool(F.col(query), F.col(ids), emb, feature, bound))
    items = F.filter(F.transform(F.col(ids), lambda x: F.struct(x.cast("bigint").alias("id"))), lambda i: i["id"] > 0)
    # queries travel with their rows, once, and as floats where that loses nothing
    whole, half = as_vector(F.col(query)), F.col(query).cast("array<float>")
    same = F.coalesce(as_vector(half) == whole, F.lit(False))
    rows = df.select(*[F.col(c) for c in df.columns if c != query], F.when(same, half).alias("__half"), F.when(~same, whole).alias("__whole"))

    def answer(rows: pa.Table, owners: np.ndarray, keys: np.ndarray, n: int, sent: pa.Table) -> pa.Array:
        vecs, there = padded(sent.column("vec").combine_chunks(), dim)
        parts = [padded(rows.column(c).combine_chunks(), dim) for c in ("__half", "__whole")]
        q, q_there = parts[0][0] + parts[1][0], np.logical_or(*[np.ones_like(v, bool) if t is None else t for v, t in parts]).all(1)
        ids = rows.column("__items").combine_chunks().flatten().field("id").to_numpy(zero_copy_only=False)
        item, at = matches(sent.column("id").combine_chunks().to_numpy(zero_copy_only=False), ids)
        order = np.argsort(keys[item], kind="stable")
        at, row, key_of = at[order], owners[item][order], keys[item][order]
        out, seen, filled = np.zeros((n, dim)), np.ones((n, dim), bool), np.zeros(n, bool)
        usable = q_there[row] if there is None else q_there[row] & there.all(1)[at]
        for part, some, starts in key_parts(key_of):
            found = vecs[at[part]]
            scores = np.einsum("id,id->i", q[row[part]], found) / np.sqrt(dim)
            lengths = np.diff(np.r_[starts, len(scores)])
            e = np.exp(scores - np.repeat(np.maximum.reduceat(scores, starts), lengths))
            share = e / np.repeat(np.add.reduceat(e, starts), lengths)
            out[some] = np.add.reduceat(found * share[:, None], starts)
            seen[some] = np.logical_and.reduceat(usable[part], starts)[:, None]  # a missing element leaves no score
            filled[some] = True
        return masked_lists(out, seen, filled)

    vectors = emb.where(F.col("feature") == feature).where("vec IS NOT NULL").select(F.col("id").cast("bigint").alias("id"), "vec")
    answered = list_answers(rows, key, items, vectors, out, T.ArrayType(T.DoubleType()), True, answer)
    again = F.coalesce(as_vector(F.col("__half")), F.col("__whole")).cast(df.schema[query].dataType).alias(query)
    columns = [key, *(c for c in df.columns if c not in (key, out))]
    return answered.select(*[again if c == query else F.col(c) for c in columns], F.coalesce(out, zero_vector(dim)).alias(out))


def dot_score(df: DataFrame, emb: DataFrame, left: tuple[str, str], right: tuple[str, str], bounds: tuple[int | None, int | None],
              key: str, dim: int = EMBEDDING_DIM, biases: Sequence[str] = ()) -> DataFrame:
    """Two-tower score: the last element of each vector is a bias, the others multiply.

    `left` and `right` are (column, embedding feature).  Adds the parts and `score`.
    """
    rows = df
    for (column, feature), bound, side in zip((left, right), bounds, ("actor", "receiver")):
        df = lookup(df, emb, feature, column, f"{side}_vec", bound, key, dim, counted=rows)
    a, r = F.col("actor_vec"), F.col("receiver_vec")
    last = F.lit(dim - 1)
    df = df.withColumns({"actor_bias": F.get(a, last), "receiver_bias": F.get(r, last),
                         "bias": sum((F.col(b).cast("double") for b in biases), F.lit(0.0))})
    total = F.col("actor_bias") + F.col("receiver_bias") + dot(a, r, dim - 1) + F.col("bias")
    return df.withColumn("score", sigmoid(total)).withColumns(
        {"actor_vec": F.slice(a, 1, dim - 1), "receiver_vec": F.slice(r, 1, dim - 1)})
