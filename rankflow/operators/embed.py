"""Embedding tables: lookup, pooling, sharding and assembly.

An embedding table is `feature, id, vec`.  Ids without a row have no vector.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rankflow.functions.vectors import as_vector, zero_vector
from rankflow.operators.layout import BROADCAST_ROWS, lookup_join
from rankflow.registry import EMBEDDING_DIM

COMBINERS = ("mean", "sum", "sqrtn")
# Blocks of rows per shuffle partition, for lookups that send vectors to blocks.
BLOCKS = 16
# Items of lists whose vectors are in memory together.
BLOCK_ITEMS = 16_384


def of_feature(emb: DataFrame, feature: str) -> DataFrame:
    return emb.where(F.col("feature") == feature).select("id", as_vector(F.col("vec")).alias("vec"))


def lookup(df: DataFrame, emb: DataFrame, feature: str, column: str, out: str, bound: int | None, key: str,
           dim: int = EMBEDDING_DIM, counted: DataFrame | None = None) -> DataFrame:
    """Add the vector of the id in `column`; an id without one gets the zero vector.  `counted` as in `lookup_join`."""
    part = of_feature(emb, feature).select(F.col("id").alias(column), F.col("vec").alias("__vec"))
    found = lookup_join(df, part, [column], bound, [key], counted=None if counted is None else counted.select(column))
    return found.select(*[F.col(c) for c in df.columns], F.coalesce("__vec", zero_vector(dim)).alias(out))


class Matrix:
    """The rows of one small embedding table, held once per executor."""

    def __init__(self, spark: SparkSession, ids: np.ndarray, vecs: np.ndarray):
        order = np.argsort(ids)
        self.dim = vecs.shape[1]
        self._shared = spark.sparkContext.broadcast((ids[order], vecs[order]))

    def rows(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Vectors of the ids that have one, and which those are."""
        known, vecs = self._shared.value
        if not len(known):
            return vecs, np.zeros(len(ids), bool)
        at = np.minimum(np.searchsorted(known, ids), len(known) - 1)
        found = known[at] == ids
        return vecs[at[found]], found


def vectors_of(column: pa.ChunkedArray) -> np.ndarray:
    """A column of equally long lists as a matrix."""
    items = column.combine_chunks()
    return items.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(items), -1)


def load_matrices(emb: DataFrame, bounds: Mapping[str, int], dtype=np.float64) -> dict[str, Matrix]:
    """Small embedding tables by feature, fetched together.

    `bounds` gives the most rows each may have.  A bound beyond the broadcast limit and
    a table beyond its bound are errors.
    """
    large = [f for f, n in bounds.items() if n > BROADCAST_ROWS]
    if large:
        raise ValueError(f"too large to hold per executor, join instead: {large}")
    wanted = emb.where(F.col("feature").isin(list(bounds))).select("feature", "id", "vec")
    table = wanted.limit(sum(bounds.values()) + 1).toArrow()
    features = table.column("feature").to_numpy()
    ids, vecs = table.column("id").to_numpy(), vectors_of(table.column("vec")).astype(dtype)
    out = {}
    for feature, bound in bounds.items():
        mine = features == feature
        if mine.sum() > bound:
            raise ValueError(f"{feature} has more than {bound} rows")
        out[feature] = Matrix(emb.sparkSession, ids[mine], vecs[mine])
    return out


def list_rows(lists: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Items of a list column and the row each belongs to."""
    sizes = np.nan_to_num(lists.value_lengths().to_numpy(zero_copy_only=False)).astype(np.int64)
    return lists.flatten().to_numpy(zero_copy_only=False), np.repeat(np.arange(len(lists)), sizes)


def as_lists(matrix: np.ndarray) -> pa.Array:
    n, dim = matrix.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(0, (n + 1) * dim, dim, dtype=np.int32)), pa.array(matrix.ravel()))


def _combine(vecs: np.ndarray, weights: np.ndarray, rows: np.ndarray, n: int, combiner: str) -> np.ndarray:
    """Weighted sums of vectors per row; `rows` is ascending.  Rows without vectors stay zero."""
    out = np.zeros((n, vecs.shape[1]))
    if len(rows):
        starts = np.flatnonzero(np.r_[True, rows[1:] != rows[:-1]])
        out[rows[starts]] = np.add.reduceat(vecs * weights[:, None], starts)
    if combiner != "sum":
        total = np.bincount(rows, weights if combiner == "mean" else weights ** 2, n)
        total = total if combiner == "mean" else np.sqrt(total)
        out /= np.where(total == 0, 1.0, total)[:, None]
    return out


def safe_pool(ids: Column, emb: DataFrame, feature: str, bound: int, combiner: str = "mean",
              weights: Column | None = None, mask_zero: bool = False) -> Column:
    """Pool the vectors of a list of ids without a shuffle; an empty list gives the zero vector.

    Negative ids and weights that are not positive are dropped, and id 0 too with
    `mask_zero`, which is right for lists that were padded.  Ids without a weight and
    weights without an id count for nothing.
    """
    if combiner not in COMBINERS:
        raise ValueError(f"unknown combiner {combiner!r}")
    matrix = load_matrices(emb, {feature: bound})[feature]
    lowest = 1 if mask_zero else 0

    @F.arrow_udf("array<double>")
    def pooled(lists: pa.Array, shares: pa.Array) -> pa.Array:
        flat, rows = list_rows(lists)
        given, owners = list_rows(shares)
        w = np.zeros(len(flat))
        if np.array_equal(rows, owners):
            w = given.astype(np.float64)
        else:
            # the n-th weight of a row belongs to its n-th id
            weight_of = dict(zip(zip(owners.tolist(), (np.arange(len(owners)) - np.searchsorted(owners, owners)).tolist()), given))
            place = np.arange(len(rows)) - np.searchsorted(rows, rows)
            w = np.array([weight_of.get(at, 0.0) for at in zip(rows.tolist(), place.tolist())], np.float64)
        if flat.dtype.kind == "f":  # a null among the ids
            flat = np.nan_to_num(flat, nan=-1).astype(np.int64)
        keep = (flat >= lowest) & (np.nan_to_num(w) > 0)
        flat, rows, w = flat[keep], rows[keep], w[keep]
        vecs, found = matrix.rows(flat)
        return as_lists(_combine(vecs, w[found], rows[found], len(lists), combiner))

    ones = F.transform(ids, lambda x: F.lit(1.0))
    clean = F.coalesce(ids, F.array()).cast("array<bigint>")
    return pooled(clean, F.coalesce(weights if weights is not None else ones, F.array()).cast("array<double>"))


# --- lists against tables of any size ------------------------------------------------------------------
#
# Rows are dealt into blocks by a hash of their key.  An id is looked up once per block, however often the block's lists
# hold it, and its vector is sent to the block once: rows travel without vectors, and no id has more than one row per block.

def blocks_of(key: Column, partitions: int, spread: Column | None = None) -> Column:
    """The block of a row: all rows of a key share one.  `spread` deals out rows without a key, if they need not meet."""
    rest = [] if spread is None else [F.when(key.isNull(), spread)]
    return F.pmod(F.xxhash64(key, *rest), F.lit(partitions * BLOCKS))


def wanted_by(rows: DataFrame, needs: Column) -> DataFrame:
    """Which keys the rows of each block need, each once: `needs` are a row's keys, an array of structs with the key columns' names."""
    return rows.select(F.col("__block").alias("__to"), F.explode(needs).alias("n")).select("__to", "n.*").distinct()


def in_blocks(rows: DataFrame, wanted: DataFrame, vectors: DataFrame, schema: T.StructType,
              answer: Callable[[pa.Table, pa.Table], pa.Table]) -> DataFrame:
    """`answer` for every block of `rows` (column `__block`), given its rows and the rows of `vectors` that it wants (`__to` and keys)."""
    sent = wanted.join(vectors, [c for c in wanted.columns if c != "__to"])
    return rows.groupBy("__block").cogroup(sent.groupBy("__to")).applyInArrow(answer, schema)


def list_answers(df: DataFrame, key: str, items: Column, vectors: DataFrame, out: str, kind: T.DataType, whole: bool,
                 answer: Callable[[pa.Table, np.ndarray, np.ndarray, int, pa.Table], pa.Array]) -> DataFrame:
    """What `answer` makes of each key's items and their vectors, as column `out`.

    `items` is an array of structs with the field `id`; the items of all rows of a key belong together.  `answer` gets the
    block's rows, the items' rows and keys (numbered), the number of keys, and the vectors (`id, vec`), and gives a value per key, null for a key that has none.
    With `whole` the rows of `df` are kept and get their key's value, without it there is one row per key with a value.
    """
    kept = [key, *(c for c in df.columns if c not in (key, out))] if whole else [key]
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    block = blocks_of(F.col(key), partitions, F.xxhash64(items) if whole else None)
    # a missing key meets no other when rows are kept, so its rows have no value
    items = F.when(F.col(key).isNotNull(), items) if whole else items
    rows = df.select(*[F.col(c) for c in kept], items.alias("__items"), block.alias("__block"))
    needs = F.transform(F.filter("__items", lambda i: i["id"].isNotNull()), lambda i: F.struct(i["id"].alias("id")))
    schema = T.StructType([*(df.schema[c] for c in kept), T.StructField(out, kind)])

    def block_answer(some: pa.Table, sent: pa.Table) -> pa.Table:
        keys = some.column(key).combine_chunks().dictionary_encode("encode")
        codes = keys.indices.to_numpy(zero_copy_only=False)
        lists = some.column("__items").combine_chunks()
        sizes = np.nan_to_num(lists.value_lengths().to_numpy(zero_copy_only=False)).astype(np.int64)
        owners = np.repeat(np.arange(len(codes)), sizes)
        values = answer(some, owners, codes[owners], len(keys.dictionary), sent)
        if not whole:
            first = np.unique(codes, return_index=True)[1]
            some = some.take(pa.array(first))
        elif not np.array_equal(codes, np.arange(len(codes))):
            values = values.take(keys.indices)
        return pa.table([*(some.column(c) for c in kept), values], names=[*kept, out])

    answered = in_blocks(rows, wanted_by(rows, needs), vectors, schema, block_answer)
    return answered if whole else answered.where(F.col(out).isNotNull())


def _items_of(table: pa.Table) -> pa.StructArray:
    return table.column("__items").combine_chunks().flatten()


def _numbers(column: pa.Array, missing) -> np.ndarray:
    return column.fill_null(missing).to_numpy(zero_copy_only=False)


def padded(vecs: pa.Array, dim: int) -> tuple[np.ndarray, np.ndarray | None]:
    """Lists as a matrix of `dim` columns, and which elements there are, if not all; the others are 0."""
    lengths, flat = vecs.value_lengths().to_numpy(zero_copy_only=False), vecs.flatten()
    values = _numbers(flat, 0).astype(np.float64)
    if not flat.null_count and len(values) == len(vecs) * dim and (lengths == dim).all():
        return values.reshape(len(vecs), dim), None
    lengths = np.nan_to_num(lengths).astype(np.int64)
    rows = np.repeat(np.arange(len(vecs)), lengths)
    at = np.arange(len(values)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    out, there = np.zeros((len(vecs), dim)), np.zeros((len(vecs), dim), bool)
    inside = at < dim
    out[rows[inside], at[inside]] = values[inside]
    there[rows[inside], at[inside]] = flat.is_valid().to_numpy(zero_copy_only=False)[inside]
    return out, there


def matches(known: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of places in `ids` and in `known` that hold the same id, in the order of `ids`; both may repeat ids."""
    order = np.argsort(known, kind="stable")
    low, high = (np.searchsorted(known[order], ids, side) for side in ("left", "right"))
    item = np.repeat(np.arange(len(ids)), high - low)
    step = np.arange(len(item)) - np.repeat(np.cumsum(high - low) - (high - low), high - low)
    return item, order[low[item] + step]


def key_parts(keys: np.ndarray) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
    """Ascending `keys` in parts of about BLOCK_ITEMS that hold whole keys: the part, its different keys and where they start in it."""
    starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, np.int64)
    at = 0
    while at < len(starts):
        to = max(at + 1, int(np.searchsorted(starts, starts[at] + BLOCK_ITEMS)))
        begin, end = starts[at], starts[to] if to < len(starts) else len(keys)
        yield slice(begin, end), keys[starts[at:to]], starts[at:to] - begin
        at = to


def masked_lists(matrix: np.ndarray, there: np.ndarray, filled: np.ndarray) -> pa.Array:
    """Rows of a matrix as lists: null where not `filled`, with null elements where not `there`."""
    sizes = np.where(filled, matrix.shape[1], 0)
    kept = matrix if filled.all() else matrix[filled]
    mask = None if there is None or there.all() else ~(there if filled.all() else there[filled]).ravel()
    offsets = pa.array(np.r_[0, np.cumsum(sizes)].astype(np.int32))
    nulls = None if filled.all() else pa.array(~filled)
    return pa.ListArray.from_arrays(offsets, pa.array(kept.ravel(), mask=mask), mask=nulls)


def _pooled(df: DataFrame, ids: str, emb: DataFrame, feature: str, key: str, out: str, combiner: str, weights: str | None, mask_zero: bool,
            dim: int, whole: bool) -> DataFrame:
    if combiner not in COMBINERS:
        raise ValueError(f"unknown combiner {combiner!r}")
    weight = F.col(weights) if weights else F.transform(F.col(ids), lambda x: F.lit(1.0))
    pairs = F.arrays_zip(F.col(ids).alias("id"), weight.cast("array<double>").alias("w"))
    typed = F.transform(pairs, lambda i: F.struct(i["id"].cast("bigint").alias("id"), i["w"].alias("w")))
    items = F.filter(typed, lambda i: (i["id"] >= (1 if mask_zero else 0)) & (i["w"] > 0))

    def answer(rows: pa.Table, owners: np.ndarray, keys: np.ndarray, n: int, sent: pa.Table) -> pa.Array:
        flat = _items_of(rows)
        vecs, there = padded(sent.column("vec").combine_chunks(), dim)
        item, at = matches(_numbers(sent.column("id").combine_chunks(), 0), _numbers(flat.field("id"), 0))
        w = _numbers(flat.field("w"), 0)[item]
        order = np.argsort(keys[item], kind="stable")
        at, w, key_of = at[order], w[order], keys[item][order]
        sums, seen, filled = np.zeros((n, dim)), None if there is None else np.zeros((n, dim), bool), np.zeros(n, bool)
        for part, some, starts in key_parts(key_of):
            share = w[part]
            sums[some] = np.add.reduceat(vecs[at[part]] * share[:, None], starts)
            if there is not None:
                seen[some] = np.logical_or.reduceat(there[at[part]], starts)
            if combiner != "sum":
                total = np.add.reduceat(share if combiner == "mean" else share ** 2, starts)
                sums[some] /= (total if combiner == "mean" else np.sqrt(total))[:, None]
            filled[some] = True
        return masked_lists(sums, seen, filled)

    vectors = emb.where(F.col("feature") == feature).where("vec IS NOT NULL").select(F.col("id").cast("bigint").alias("id"), "vec")
    return list_answers(df, key, items, vectors, out, T.ArrayType(T.DoubleType()), whole, answer)


def pool(df: DataFrame, ids: str, emb: DataFrame, feature: str, key: str, combiner: str = "mean",
         weights: str | None = None, bound: int | None = None, mask_zero: bool = False,
         dim: int = EMBEDDING_DIM) -> DataFrame:
    """Pool for tables of any size: `key, vec` for the rows with at least one vector.

    Vectors are sent to blocks of rows, see `in_blocks`; what is shuffled of a row is its key, ids and weights.  `bound` changes nothing.
    """
    return _pooled(df, ids, emb, feature, key, "vec", combiner, weights, mask_zero, dim, False)


def with_safe_pool(df: DataFrame, ids: str, emb: DataFrame, feature: str, key: str, out: str, bound: int | None, combiner: str = "mean",
                   weights: str | None = None, mask_zero: bool = False, dim: int = EMBEDDING_DIM) -> DataFrame:
    """Add the pooled vector of a list of ids, the zero vector for none, for tables of any size.

    Tables within the broadcast limit are held per executor, from larger ones vectors are sent to blocks of rows; the result is the same.
    """
    if bound is not None and bound <= BROADCAST_ROWS:
        vec = safe_pool(F.col(ids), emb, feature, bound, combiner, F.col(weights) if weights else None, mask_zero)
        return df.withColumn(out, vec)
    pooled = _pooled(df, ids, emb, feature, key, out, combiner, weights, mask_zero, dim, True)
    return pooled.withColumn(out, F.coalesce(out, zero_vector(dim)))


def with_sequence(df: DataFrame, ids: str, emb: DataFrame, feature: str, key: str, out: str, bound: int | None,
                  dim: int = EMBEDDING_DIM) -> DataFrame:
    """Add one vector per list position, for tables of any size; a missing list has none."""
    if bound is not None and bound <= BROADCAST_ROWS:
        return df.withColumn(out, lookup_sequence(F.col(ids), emb, feature, bound))
    lists = _sequences(df, ids, emb, feature, key, out, dim, True)
    return lists.withColumn(out, F.coalesce(out, F.array().cast("array<array<double>>")))


def lookup_sequence(ids: Column, emb: DataFrame, feature: str, bound: int) -> Column:
    """One vector per list position, in order; ids without a vector give the zero vector."""
    matrix = load_matrices(emb, {feature: bound})[feature]

    @F.arrow_udf("array<array<double>>")
    def vectors(lists: pa.Array) -> pa.Array:
        flat, rows = list_rows(lists)
        vecs, found = matrix.rows(flat.astype(np.int64))
        out = np.zeros((len(flat), matrix.dim))
        out[found] = vecs
        offsets = np.searchsorted(rows, np.arange(len(lists) + 1)).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), as_lists(out))

    return vectors(F.coalesce(ids, F.array()).cast("array<bigint>"))


def _sequences(df: DataFrame, ids: str, emb: DataFrame, feature: str, key: str, out: str, dim: int, whole: bool) -> DataFrame:
    items = F.transform(F.col(ids), lambda x: F.struct(x.cast("bigint").alias("id")))

    def answer(rows: pa.Table, owners: np.ndarray, keys: np.ndarray, n: int, sent: pa.Table) -> pa.Array:
        flat = _items_of(rows).field("id")
        vecs = sent.column("vec").combine_chunks().cast(pa.list_(pa.float64()))
        item, at = matches(_numbers(sent.column("id").combine_chunks(), 0), np.where(flat.is_valid(), _numbers(flat, 0), 0))
        there = flat.is_valid().to_numpy(zero_copy_only=False)[item]
        item, at = item[there], at[there]
        # an id without a row gets the zero vector, which stands behind the others
        none = np.setdiff1d(np.arange(len(flat)), item)
        item, at = np.r_[item, none], np.r_[at, np.full(len(none), len(vecs))]
        place = np.arange(len(flat)) - np.searchsorted(owners, owners)
        order = np.lexsort((item, place[item], keys[item]))
        item, at = item[order], at[order]
        spot = np.stack([keys[item], place[item]])
        if (spot[:, 1:] == spot[:, :-1]).all(0).any():  # a key or an id that repeats: vectors of one position are in their own order
            values = padded(pa.concat_arrays([vecs, as_lists(np.zeros((1, dim)))]), dim)[0][at]
            order = np.lexsort((*values.T[::-1], place[item], keys[item]))
            item, at = item[order], at[order]
        counts = np.bincount(keys[item], minlength=n)
        inner = pa.concat_arrays([vecs, as_lists(np.zeros((1, dim)))]).take(pa.array(at))
        offsets = pa.array(np.r_[0, np.cumsum(counts)].astype(np.int32))
        return pa.ListArray.from_arrays(offsets, inner, mask=pa.array(counts == 0) if (counts == 0).any() else None)

    zero = zero_vector(dim).cast(emb.schema["vec"].dataType)
    vectors = emb.where(F.col("feature") == feature).select(F.col("id").cast("bigint").alias("id"), F.coalesce("vec", zero).alias("vec"))
    kind = T.ArrayType(T.ArrayType(T.DoubleType()))
    return list_answers(df, key, items, vectors, out, kind, whole, answer)


def lookup_sequence_by_join(df: DataFrame, ids: str, emb: DataFrame, feature: str, key: str,
                            bound: int | None = None, dim: int = EMBEDDING_DIM) -> DataFrame:
    """As `lookup_sequence` for tables of any size: `key, vecs`.  Vectors are joined to blocks of rows, see `in_blocks`; `bound` changes nothing."""
    return _sequences(df, ids, emb, feature, key, "vecs", dim, False)


def shard_of(id_col: Column, shards: int, buckets: int) -> Column:
    """Contiguous shards of 0..buckets-1; the first `buckets % shards` of them hold one id more."""
    size, extra = divmod(buckets, shards)
    border = extra * (size + 1)
    beyond = F.floor((id_col - border) / F.lit(max(size, 1))) + extra
    return F.when(id_col < border, F.floor(id_col / F.lit(size + 1))).otherwise(beyond).cast("int")


def shard_count(buckets: int, dim: int, max_shards: int, min_bytes: int = 64 << 20, item_bytes: int = 4) -> int:
    """Shards such that none is smaller than `min_bytes`."""
    return max(1, min(max_shards, buckets, buckets * dim * item_bytes // min_bytes))


def sharded(emb: DataFrame, shards: int, buckets: int) -> DataFrame:
    """Embedding rows with their shard, one range of ids per partition."""
    return emb.withColumn("shard", shard_of(F.col("id"), shards, buckets)).repartitionByRange(shards, "shard")


def assemble(columns: Sequence[str | Column]) -> Column:
    """Vectors side by side in one array."""
    return F.concat(*[F.col(c) if isinstance(c, str) else c for c in columns])


def init_vector(feature: Column, id_col: Column, dim: int = EMBEDDING_DIM, seed: int = 42,
                stddev: float | None = None) -> Column:
    """Start values of an embedding row, a function of feature, id and seed alone.

    Normal with deviation 1/sqrt(dim), cut at two deviations.  Being a function, it
    needs no table: a row that was never touched is known without being stored.
    """
    scale = stddev if stddev is not None else dim ** -0.5

    def uniform(salt: str):
        return lambda i: (F.pmod(F.xxhash64(F.lit(f"{seed}{salt}"), feature, id_col, i), F.lit(1 << 52)) + 0.5) / F.lit(float(1 << 52))

    def draw(i: Column) -> Column:
        z = F.sqrt(-2 * F.ln(uniform("r")(i))) * F.cos(2 * np.pi * uniform("a")(i))
        return F.least(F.greatest(z, F.lit(-2.0)), F.lit(2.0)) * scale

    return F.transform(F.sequence(F.lit(0), F.lit(dim - 1)), draw)


def initial_embeddings(spec: DataFrame, dim: int = EMBEDDING_DIM, seed: int = 42) -> DataFrame:
    """A full start table from the feature spec: one row per feature and id."""
    ids = spec.select(F.col("name").alias("feature"), F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("vocab_size").cast("bigint") - 1)).alias("id"))
    return ids.select("feature", "id", init_vector(F.col("feature"), F.col("id"), dim, seed).cast("array<float>").alias("vec"))
