"""Exact top-k by inner product through a pivot-distance index.

A vector v gets one more component, sqrt(M^2 - |v|^2), where M is the largest norm; a query gets a zero.  Among vectors that all
have norm M then, a larger inner product is a smaller distance, and the triangle inequality bounds it.  Vectors are keyed by their
nearest pivot and their distance to it; runs of neighbours in that order (annuli) are searched from the closest bound on, and the
search stops where the bound cannot reach the k-th best score any more.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankflow.session import written

SAMPLE = 2048
PIVOTS = 64
ANNULUS = 512
SHELF = 4096


def integer_vectors(embeddings: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 64) -> DataFrame:
    """Distinct (vec_id, v) with v = floor(scale * x); rows with a null id, a null vector or a null or non-finite component are
    left out."""
    vector = F.col(vector_col)
    whole = vector.isNotNull() & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return (embeddings.where(F.col(id_col).isNotNull() & F.coalesce(whole, F.lit(False)))
            .select(F.col(id_col).cast("long").alias("vec_id"),
                    F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("long")).alias("v")).distinct())


def _matrix(lists: pa.Array, dim: int) -> np.ndarray:
    """Rows of longs, shorter ones filled up with zeros."""
    flat, ends = lists.flatten().to_numpy(zero_copy_only=False), np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))
    out = np.zeros((len(lists), dim), np.int64)
    sizes = np.diff(np.r_[0, ends]).astype(int)
    row = np.repeat(np.arange(len(lists)), sizes)
    out[row, np.arange(len(flat)) - np.repeat(ends - sizes, sizes)] = flat
    return out


def _products(a: np.ndarray, b: np.ndarray, largest: int) -> np.ndarray:
    """a @ b.T in the narrowest type that holds every partial sum exactly."""
    bound = largest * largest * max(a.shape[1], 1)
    if bound < 1 << 24:
        return (a.astype(np.float32) @ b.T.astype(np.float32)).astype(np.int64)
    if bound < 1 << 53:
        return (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
    if bound < 1 << 63:
        return a @ b.T
    raise OverflowError("an inner product may exceed a long")


def _pivots(sample: np.ndarray, n: int) -> np.ndarray:
    """Up to `n` rows that are far from one another (farthest first)."""
    x = sample.astype(float)
    chosen = [0]
    near = ((x - x[0]) ** 2).sum(axis=1)
    while len(chosen) < min(n, len(x)) and near.max() > 0:
        chosen.append(int(near.argmax()))
        near = np.minimum(near, ((x - x[chosen[-1]]) ** 2).sum(axis=1))
    return sample[chosen]


def _to_pivots(x: np.ndarray, pivots: np.ndarray, m2: float, augmented: bool) -> np.ndarray:
    """Distances of rows to the pivots, all in the space with one more component."""
    v, p = x.astype(float), pivots.astype(float)
    norms, own = (v * v).sum(axis=1), (p * p).sum(axis=1)
    squared = norms[:, None] + m2 - 2 * v @ p.T
    if augmented:
        squared += (m2 - norms)[:, None] - 2 * np.sqrt(np.maximum(m2 - norms, 0))[:, None] * np.sqrt(np.maximum(m2 - own, 0))
    return np.sqrt(np.maximum(squared, 0))


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Per row the k highest scores, ties to smaller ids."""
    order = np.lexsort((ids, -scores), axis=1)[:, :k]
    return np.take_along_axis(scores, order, 1), np.take_along_axis(ids, order, 1)


def top_k(embeddings: DataFrame, is_query, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 64,
          pivots: int = PIVOTS, sample: int = SAMPLE, annulus: int = ANNULUS, shelf: int = SHELF) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row for which the column `is_query` (over `vec_id`) holds, its k best others.

    Exact.  The pivots come from a bounded sample of `sample` rows, chosen by a hash of their id; every row is indexed.  The sample
    also gives each query a first lower bound for its k-th score.  Rows are sorted by pivot and distance into annuli of
    `annulus` rows, and these onto shelves of about `shelf` rows; each group of queries meets each shelf in a task of its own, so a
    task's memory does not grow with the table.

    Repeated rows count once, rows with the query's own id never.  Shorter vectors count as filled up with zeros.  With fewer than
    k others all are returned; without queries or vectors the result is empty.
    """
    vectors = written(integer_vectors(embeddings, id_col, vector_col, scale), "vectors")
    spark = vectors.sparkSession
    norm = F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    n, dim, largest, m2 = vectors.agg(F.count(F.lit(1)), F.max(F.size("v")), F.max(F.array_max(F.transform("v", F.abs))),
                                      F.max(norm)).first()
    schema = "query_id long, rank int, vec_id long, score long"
    if not n:
        return spark.createDataFrame([], schema)
    dim, largest, m2 = dim or 0, largest or 0, m2 or 0.0
    few = vectors.orderBy(F.xxhash64("vec_id"), "vec_id", "v").limit(sample).toArrow().combine_chunks()
    few_ids, few_rows = few["vec_id"].to_numpy(), _matrix(few["v"].combine_chunks(), dim)
    centres = _pivots(few_rows, pivots)
    low = -np.iinfo(np.int64).max  # its negative is a long too

    def key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column(1), dim)
            far = _to_pivots(x, centres, m2, True)
            nearest = far.argmin(axis=1)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(nearest.astype(np.int32)),
                 pa.array(far[np.arange(len(x)), nearest])], names=["vec_id", "v", "pivot", "r"])

    shelves = max(1, -(-n // shelf))
    keyed = vectors.mapInArrow(key, "vec_id long, v array<long>, pivot int, r double")
    sorted_rows = (keyed.repartitionByRange(shelves, "pivot", "r", "vec_id").sortWithinPartitions("pivot", "r", "vec_id")
                   .withColumn("shelf", F.spark_partition_id()))

    def rings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def ring(rows: pa.Table) -> pa.RecordBatch:
            order = np.argsort(rows["vec_id"].to_numpy(), kind="stable")
            r = rows["r"].to_numpy()
            x = _matrix(rows["v"].combine_chunks(), dim)[order]
            return pa.RecordBatch.from_arrays(
                [rows["shelf"].combine_chunks()[:1], rows["pivot"].combine_chunks()[:1], pa.array([r.min()]), pa.array([r.max()]),
                 pa.array([rows["vec_id"].to_numpy()[order].tobytes()], pa.binary()), pa.array([x.tobytes()], pa.binary())],
                names=["shelf", "pivot", "inner", "outer", "ids", "rows"])

        waiting = None
        for batch in batches:
            whole = pa.Table.from_batches(([] if waiting is None else waiting.to_batches()) + [batch]).combine_chunks()
            pivot = whole["pivot"].to_numpy()
            edges = np.flatnonzero(np.r_[True, pivot[1:] != pivot[:-1], True])
            cuts = sorted({int(c) for a, b in zip(edges, edges[1:]) for c in range(a, b, annulus)} | {len(pivot)})
            for a, b in zip(cuts[:-2], cuts[1:-1]):
                yield ring(whole.slice(a, b - a))
            waiting = whole.slice(cuts[-2]) if len(cuts) > 1 else None
        if waiting is not None and len(waiting):
            yield ring(waiting)

    index = written(sorted_rows.mapInArrow(rings, "shelf int, pivot int, inner double, outer double, ids binary, rows binary"), "rings")

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                some = batch.slice(at, 1024)
                ids, x = some.column(0).to_numpy(zero_copy_only=False), _matrix(some.column(1), dim)
                seen = _products(x, few_rows, largest)
                seen[ids[:, None] == few_ids[None, :]] = low
                floor = np.sort(seen, axis=1)[:, -k] if seen.shape[1] >= k else np.full(len(ids), low)
                yield pa.RecordBatch.from_arrays([pa.array([a.tobytes()], pa.binary()) for a in (ids, x, floor)],
                                                 names=["q_ids", "q_rows", "floor"])

    groups = max(1, -(-n // (20 * shelf)))
    questions = (vectors.where(is_query).repartition(groups).mapInArrow(ask, "q_ids binary, q_rows binary, floor binary")
                 .withColumn("g", F.spark_partition_id()))
    # every group of queries with every shelf: blocks against blocks, joined on their numbers
    left = index.withColumn("g", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    right = questions.withColumn("shelf", F.explode(F.sequence(F.lit(0), F.lit(shelves - 1))))

    def search(rings: pa.Table, asked: pa.Table) -> pa.Table:
        found = {"query_id": [], "vec_id": [], "score": []}
        held = [(p, a, b, np.frombuffer(i, np.int64), np.frombuffer(x, np.int64).reshape(-1, dim) if dim else
                 np.zeros((len(i) // 8, 0), np.int64)) for p, a, b, i, x in
                zip(*[rings[c].to_pylist() for c in ("pivot", "inner", "outer", "ids", "rows")], strict=True)]
        for q_ids, q_rows, floor in zip(*[asked[c].to_pylist() for c in ("q_ids", "q_rows", "floor")], strict=True):
            ids, kth = np.frombuffer(q_ids, np.int64), np.frombuffer(floor, np.int64).copy()
            x = np.frombuffer(q_rows, np.int64).reshape(len(ids), dim)
            away = _to_pivots(x, centres, m2, False)
            reach = (x.astype(float) ** 2).sum(axis=1) + m2
            bounds = np.array([np.maximum(np.maximum(away[:, p] - b, a - away[:, p]), 0) for p, a, b, *_ in held]).reshape(len(held), -1)
            best = np.full((len(ids), k), low), np.full((len(ids), k), np.iinfo(np.int64).max)
            for i in np.argsort(bounds.min(axis=1, initial=np.inf), kind="stable"):
                *_, ring_ids, ring_rows = held[i]
                # the highest score the annulus may hold, with room for rounding
                top = (reach - bounds[i] ** 2) / 2
                active = np.flatnonzero(top + 1 + 1e-9 * reach >= kth)
                if not len(active):
                    continue
                scores = _products(x[active], ring_rows, largest)
                scores[(ids[active][:, None] == ring_ids[None, :]) | (scores < kth[active][:, None])] = low
                some = np.flatnonzero(scores.max(axis=1) > low)
                if not len(some):
                    continue
                at = active[some]
                new = _best(scores[some], np.broadcast_to(ring_ids, (len(some), len(ring_ids))), k)
                merged = _best(np.concatenate([best[0][at], new[0]], axis=1), np.concatenate([best[1][at], new[1]], axis=1), k)
                best[0][at], best[1][at] = merged
                kth[at] = np.maximum(kth[at], merged[0][:, -1])
            row, col = np.nonzero(best[0] > low)
            found["query_id"].append(ids[row])
            found["vec_id"].append(best[1][row, col])
            found["score"].append(best[0][row, col])
        return pa.table({c: np.concatenate(v) if v else np.empty(0, np.int64) for c, v in found.items()})

    close = left.groupBy("shelf", "g").cogroup(right.groupBy("shelf", "g")).applyInArrow(
        search, "query_id long, vec_id long, score long")
    from pyspark.sql import Window
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return close.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
