"""Connected components of a distributed graph."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankflow.session import written

# A node with very many neighbours is spread over so many join keys.
SALTS = 16


def _to_minimum(edges: DataFrame, u: str, v: str) -> DataFrame:
    """Each edge (u, v) with `m`, the smallest node among u and its neighbours in `edges`.

    The minimum is aggregated before the shuffle.  The join is salted on both sides, so a centre with very many
    neighbours is not one join key.
    """
    minima = edges.groupBy(u).agg(F.min(v).alias("__m")).select(
        F.col(u), F.least(u, "__m").alias("m"), F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("__salt"))
    return edges.withColumn("__salt", F.pmod(F.xxhash64(v), F.lit(SALTS)).cast("int")).join(minima, [u, "__salt"])


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    return (_to_minimum(both, "a", "b").where("b > a AND b <> m")
            .select(F.col("b").alias("a"), F.col("m").alias("b")).distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    # edges run from the larger node to the smaller one
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    near = _to_minimum(down, "a", "b")
    return (near.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
            .union(near.where("b = m").select("a", F.col("m").alias("b"))).distinct())


def connected_components(edges: DataFrame, max_rounds: int = 64) -> DataFrame:
    """(node, component) for every node of the edges (a, b); a component is named after its smallest node.

    Alternates the large-star and small-star steps until every component is a star around its smallest node, which
    takes a number of rounds logarithmic in its size.  Each round is written to the shared folder; only a count and a
    checksum reach the driver.  Loops and repeated edges are allowed, null ends are not.
    """
    now = written(edges.select("a", "b").where("a <> b").distinct(), "edges")
    state = None
    for _ in range(max_rounds):
        n, check = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if n == 0 or state == (n, check):
            return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
                now.select("b", "b")).distinct()
        state = (n, check)
        now = written(_small_star(_large_star(now)), "edges")
    raise RuntimeError(f"no fixed point after {max_rounds} rounds")
