"""Near-duplicate vectors by sorted projection passes.

In each pass vectors are ordered lexicographically by concatenated random hashes (the signs of random projections), and each is
compared with a bounded window of its successors.  Pairs verified in any pass are united across passes.  What the windows leave out is
then compared block against block within each label, so no link is lost at any size.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankflow.llm.components import connected_components
from rankflow.llm.simhash import _forest
from rankflow.session import written

PASSES = 8
WINDOW = 64
SIGNS = 32
CHUNK = 1024
# Vectors of one label that are compared with as many others in one task.
BLOCK = 8192
# Radians kept free on either side of a bound, far above the rounding of a cosine.
MARGIN = 1e-6


def _vectors(column: pa.Array) -> np.ndarray:
    """Rows of equal length as doubles."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else np.empty((0, 0))


def _units(column: pa.Array) -> np.ndarray:
    x = _vectors(column)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _projection_edges(nodes: DataFrame, threshold: float, passes: int, window: int, seed: int) -> DataFrame:
    """Spanning links (a, b) found in the windows of all passes; `nodes` has grp, node, v."""
    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes: dict[int, np.ndarray] = {}
        for batch in batches:
            sizes = batch.column(2).value_lengths().to_numpy(zero_copy_only=False)
            for dim in np.unique(sizes):
                rows = batch.filter(pa.array(sizes == dim))
                if dim not in planes:
                    planes[dim] = np.random.default_rng([seed, int(dim)]).standard_normal((int(dim), passes * SIGNS))
                signs = (_vectors(rows.column(2)) @ planes[dim] > 0).reshape(rows.num_rows, passes, SIGNS)
                key = signs @ (1 << np.arange(SIGNS - 1, -1, -1))
                for p in range(passes):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(rows.num_rows, p, np.int32)), rows.column(0), pa.array(key[:, p]), rows.column(1),
                         rows.column(2)], names=["pass", "grp", "key", "node", "v"])

    spark = nodes.sparkSession
    order = ["pass", "grp", "key", "node"]
    dealt = (nodes.select("grp", "node", "v").mapInArrow(keys, "pass int, grp string, key long, node long, v array<double>")
             .repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), *order).sortWithinPartitions(*order))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def links(rows: pa.Table) -> pa.RecordBatch:
            node = rows["node"].to_numpy()
            tag = rows["pass"].to_numpy(), rows["grp"].combine_chunks().dictionary_encode().indices.to_numpy()
            edges = np.flatnonzero(np.r_[True, (tag[0][1:] != tag[0][:-1]) | (tag[1][1:] != tag[1][:-1]), True])
            a, b = [], []
            for lo, hi in zip(edges, edges[1:]):  # one label, and so one length of vectors, in one pass
                u = _units(rows["v"].combine_chunks()[int(lo):int(hi)])
                for s in range(1, min(window, hi - lo - 1) + 1):
                    close = np.flatnonzero(np.einsum("ij,ij->i", u[:-s], u[s:]) >= threshold)
                    a.append(lo + close)
                    b.append(lo + close + s)
            root = _forest(len(node), iter([(np.concatenate(a), np.concatenate(b))] if a else []))
            leaf = np.flatnonzero(root != np.arange(len(root)))
            return pa.RecordBatch.from_arrays([pa.array(node[leaf]), pa.array(node[root[leaf]])], names=["a", "b"])

        tail = None  # the last rows of a batch meet the first of the next
        for batch in batches:
            rows = pa.Table.from_batches(([] if tail is None else tail.to_batches()) + [batch]).combine_chunks()
            yield links(rows)
            tail = rows.slice(max(len(rows) - window, 0))

    return dealt.mapInArrow(compare, "a long, b long")


def _left_out(nodes: DataFrame, threshold: float, block: int, tile: int = CHUNK) -> DataFrame:
    """Links (a, b) between components that the passes have not joined; `nodes` has grp, node, v, component.

    Labels are dealt into blocks by a hash, and each pair of blocks is compared in a group of its own, tile by tile.  Every pair
    of a label is compared, so the work grows with the square of a label's size.
    """
    n = F.count(F.lit(1))
    # a middling label is dealt into up to eight blocks all the same, so that it is not one task
    sizes = nodes.groupBy("grp").agg(F.greatest(F.ceil(n / block), F.least(F.ceil(n / 512), F.lit(8))).cast("int").alias("blocks"))
    rows = nodes.join(sizes, "grp").withColumn("c", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    rows = rows.withColumn("d", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "grp", F.least("c", "d").alias("i"), F.greatest("c", "d").alias("j"), (F.col("c") > F.col("d")).alias("right"), "node",
        "component", "v")

    def compare(part: pa.Table) -> pa.Table:
        u, component = _units(part["v"].combine_chunks()), part["component"].to_numpy()
        right = part["right"].to_numpy()
        one = part["i"][0].as_py() == part["j"][0].as_py()
        a = np.arange(len(u)) if one else np.flatnonzero(~right)
        b = a if one else np.flatnonzero(right)

        def pairs() -> Iterator[tuple[np.ndarray, np.ndarray]]:
            for x in range(0, len(a), tile):
                for y in range(x if one else 0, len(b), tile):
                    p, q = a[x:x + tile], b[y:y + tile]
                    m, n = np.nonzero(u[p] @ u[q].T >= threshold)
                    apart = component[p[m]] != component[q[n]]
                    yield p[m[apart]], q[n[apart]]

        root = _forest(len(u), pairs())
        leaf = np.flatnonzero(root != np.arange(len(root)))
        return pa.table({"a": component[leaf], "b": component[root[leaf]]})

    return rows.groupBy("grp", "i", "j").applyInArrow(compare, "a long, b long").where("a <> b").distinct()


def _link_counts(members: DataFrame, threshold: float, chunk: int) -> DataFrame:
    """(node, links) for members (component, node, m, v) of components with several nodes.

    Members within half the threshold's angle of their component's centre are linked with one another for certain, which is counted
    without comparing them.  The others, the fringe, are compared with all members of their component, chunk by chunk.
    """
    half = math.acos(threshold) / 2 - MARGIN
    length = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))
    units = members.select("component", "node", "m", "v", F.transform("v", lambda x: x / length).alias("u"))
    # sums per place are added up before the shuffle
    places = units.select("component", F.posexplode("u").alias("i", "x")).groupBy("component", "i").agg(F.sum("x").alias("x"))
    centres = written(places.groupBy("component").agg(F.sort_array(F.collect_list(F.struct("i", "x"))).alias("c"))
                      .select("component", F.transform("c", lambda s: s["x"]).alias("c")), "centres")
    size = F.sqrt(F.aggregate("c", F.lit(0.0), lambda s, x: s + x * x))
    dot = F.aggregate(F.zip_with("u", "c", lambda a, b: a * b), F.lit(0.0), lambda s, x: s + x)
    placed = written(units.join(centres, "component").select(
        "component", "node", "m", "v", F.coalesce(dot / size >= math.cos(half), F.lit(False)).alias("core")), "placed")
    totals = placed.groupBy("component").agg(F.sum(F.when(F.col("core"), F.col("m")).otherwise(0)).alias("core_rows"),
                                             F.count(F.lit(1)).alias("n"), F.sum((~F.col("core")).cast("int")).alias("fringe"))
    totals = written(totals, "totals")
    base = placed.join(totals.select("component", "core_rows"), "component").select(
        "node", (F.when(F.col("core"), F.col("core_rows")).otherwise(F.col("m")) - 1).alias("links"))
    open_ = totals.where("fringe > 0").select("component", F.ceil(F.col("n") / chunk).cast("int").alias("cn"),
                                              F.ceil(F.col("fringe") / chunk).cast("int").alias("cf"))
    rows = placed.join(open_, "component")
    deal = lambda n: F.pmod(F.xxhash64("node"), F.col(n)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    all_side = rows.withColumn("i", deal("cn")).withColumn("j", each("cf")).select("component", "i", "j", "node", "m", "core", "v")
    fringe = rows.where("NOT core").withColumn("j", deal("cf")).withColumn("i", each("cn")).select(
        *[F.col(c).alias(f"f_{c}") for c in ("component", "i", "j", "node", "m", "v")])

    def count(part: pa.Table, edge: pa.Table) -> pa.Table:
        if not len(part) or not len(edge):
            return pa.table({"node": pa.array([], pa.int64()), "links": pa.array([], pa.int64())})
        a, b = part["node"].to_numpy(), edge["f_node"].to_numpy()
        hit = (_units(part["v"].combine_chunks()) @ _units(edge["f_v"].combine_chunks()).T >= threshold) & (a[:, None] != b[None, :])
        core = part["core"].to_numpy()
        return pa.table({"node": np.concatenate([b, a[core]]),
                         "links": np.concatenate([part["m"].to_numpy() @ hit, hit[core] @ edge["f_m"].to_numpy()]).astype(np.int64)})

    more = all_side.groupBy("component", "i", "j").cogroup(fringe.groupBy("f_component", "f_i", "f_j")).applyInArrow(count, "node long, links long")
    return base.union(more).groupBy("node").agg(F.sum("links").alias("links"))


def embedding_components(embeddings: DataFrame, threshold: float = 0.93, passes: int = PASSES, window: int = WINDOW,
                         chunk: int = CHUNK, seed: int = 42, block: int = BLOCK) -> DataFrame:
    """(vec_id, n_links, component_id, kept) per row; vectors link at a cosine of `threshold` or more if their labels are equal.

    Equal vectors of a label are one node, however many rows hold them.  Passes find most links between nodes; pairs of a label
    that they left in different components are then compared block against block, so components are exact.  Links inside a
    component are counted exactly.

    Rows whose label, vector or any component is null, whose vector is zero or not finite, or whose length differs do not
    link; alone they are their own component.  A null vec_id has no links, a null component and is kept.  Rows that repeat a
    vec_id count as rows, and share links.
    """
    if not 0 < threshold <= 1:
        raise ValueError("the threshold must lie above 0 and not above 1")
    vector = F.col("embedding")
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = (F.col("vec_id").isNotNull() & F.col("label").isNotNull() & vector.isNotNull() & finite
              & F.exists(vector, lambda x: x != 0))
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"),
                             F.when(F.coalesce(usable, F.lit(False)), F.concat_ws(":", F.col("label").cast("string"), F.size(vector)
                                                                                .cast("string"))).alias("grp"),
                             F.transform(vector, lambda x: x.cast("double")).alias("v"))
    good = rows.where("grp IS NOT NULL")
    nodes = written(good.groupBy("grp", "v").agg(F.min("vec_id").alias("node"), F.count(F.lit(1)).alias("m")), "nodes")
    found = written(connected_components(_projection_edges(nodes, threshold, passes, window, seed)), "components")
    state = written(nodes.join(found, "node", "left").select("grp", "node", "v", F.coalesce("component", "node").alias("component")), "state")
    more = written(_left_out(state, threshold, block), "left_out")
    if more.head(1):
        found = written(connected_components(more.union(found.select("node", "component"))), "components")
    members = nodes.join(found, "node")
    counted = _link_counts(members.select("component", "node", "m", "v"), threshold, chunk)
    known = found.join(counted, "node", "left").select("node", "component", "links")
    by_vector = (nodes.join(known, "node", "left")
                 .select("grp", "v", F.coalesce("component", "node").alias("component"),
                         F.coalesce("links", F.col("m") - 1).alias("links")))
    joined = good.join(by_vector, ["grp", "v"]).select("vec_id", "links", "component")
    alone = rows.where("grp IS NULL").select("vec_id", F.lit(0).cast("long").alias("links"), F.col("vec_id").alias("component"))
    return joined.union(alone).select("vec_id", F.col("links").alias("n_links"), F.col("component").alias("component_id"),
                                      F.coalesce(F.col("vec_id") == F.col("component"), F.lit(True)).alias("kept"))
