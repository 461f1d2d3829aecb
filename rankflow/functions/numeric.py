"""Numeric column functions."""

from __future__ import annotations

import math
from bisect import bisect_left
from collections.abc import Mapping, Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rankflow.session import written

MAX_QUANTILES = 10_000
# Sketches are asked for ranks within one in so many rows; a finer accuracy is met by counting.
SKETCHED = 10_000


def zero_if_missing(col: Column) -> Column:
    """Null and NaN become 0.0."""
    return F.coalesce(F.nanvl(col.cast("double"), F.lit(0.0)), F.lit(0.0))


def bucketize(df: DataFrame, boundaries: Mapping[str, Sequence[float]]) -> DataFrame:
    """Replace each column by the number of its boundaries that are <= its value.

    All columns go through one multi-column `Bucketizer`, so a few hundred of
    them stay in a single projection.  Bucketizer wants distinct splits: a list
    that repeats a boundary is cut on the distinct ones and the bucket index is
    mapped back to the count of original boundaries.
    """
    if not boundaries:
        return df
    names = list(boundaries)
    splits, counts = [], {}
    for name in names:
        cuts = [float(b) for b in boundaries[name]]
        distinct = sorted(set(cuts))
        splits.append([float("-inf"), *distinct, float("inf")])
        if len(distinct) < len(cuts):
            counts[name] = [0, *(sum(b <= d for b in cuts) for d in distinct)]
    tmp = [f"__bucket_{n}" for n in names]
    filled = df.withColumns({n: zero_if_missing(F.col(n)) for n in names})
    cut = Bucketizer(splitsArray=splits, inputCols=names, outputCols=tmp,
                     handleInvalid="keep").transform(filled)
    index = {}
    for name, t in zip(names, tmp):
        j = F.col(t).cast("int")
        if name in counts:
            j = F.get(F.array(*[F.lit(c) for c in counts[name]]), j)
        index[name] = j
    return cut.select(*[index[c].alias(c) if c in index else F.col(c) for c in df.columns])


def bucket_index(col: Column, boundaries: Sequence[float]) -> Column:
    """Column form of `bucketize`, for use inside a larger expression."""
    cuts = F.array(*[F.lit(float(b)) for b in boundaries])
    return F.size(F.filter(cuts, lambda b: b <= zero_if_missing(col)))


def min_max(col: Column, lo, hi) -> Column:
    return (col.cast("double") - lo) / (F.lit(hi) - F.lit(lo))


def fit_min_max(df: DataFrame, cols: Sequence[str]) -> dict[str, tuple[float, float]]:
    """Lowest and highest value of each column, in one pass."""
    aggs = [f(c).cast("double").alias(f"{p}_{c}") for c in cols for p, f in (("lo", F.min), ("hi", F.max))]
    row = df.agg(*aggs).first()
    return {c: (row[f"lo_{c}"], row[f"hi_{c}"]) for c in cols}


def quantile_scale(col: Column, boundaries: Sequence[float]) -> Column:
    """Bucket index as a share of the number of boundaries."""
    return bucket_index(col, boundaries) / F.lit(float(len(boundaries)))


def fit_quantiles(df: DataFrame, cols: Sequence[str], parts: int, accuracy: int = 10_000) -> dict[str, list[float]]:
    """Boundaries that cut each column into `parts` groups of about equal size.

    Ranks are off by one in `accuracy` rows at most: one pass with a sketch.  An accuracy beyond SKETCHED gives the exact ranks,
    in two passes, for any number of rows.
    """
    if not 2 <= parts <= MAX_QUANTILES:
        raise ValueError(f"parts must be between 2 and {MAX_QUANTILES}")
    probs = [i / parts for i in range(1, parts)]
    if accuracy > SKETCHED:
        return _exact_quantiles(df, list(cols), probs)
    row = df.agg(*[F.percentile_approx(F.col(c).cast("double"), F.array(*map(F.lit, probs)), accuracy).alias(c) for c in cols]).first()
    return {c: sorted(set(row[c] or [])) for c in cols}


def _exact_quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float]) -> dict[str, list[float]]:
    """The values at the ranks ceil(prob * rows) of each column, missing values left out and NaN last.

    A sketch gives values below and above each rank.  They cut a column into zones; rows are counted per zone, and per value in
    the zones around the ranks, a few in SKETCHED of all rows each.  Should a rank lie in another zone, its values are counted as well.
    """
    # adding 0.0 turns -0.0 into 0.0
    values = df.select(*[(F.col(c).cast("double") + 0.0).alias(f"__{i}") for i, c in enumerate(cols)])
    reach = 2 / SKETCHED
    ends = F.array(*[F.lit(min(max(p + d, 0.0), 1.0)) for p in probs for d in (-reach, reach)])
    sketch = values.agg(*[F.percentile_approx(f"__{i}", ends, SKETCHED).alias(f"s{i}") for i in range(len(cols))],
                        *[F.count(f"__{i}").alias(f"n{i}") for i in range(len(cols))]).first()
    zones, close, wanted = {}, {}, {}
    for i in range(len(cols)):
        if not sketch[f"n{i}"]:
            continue
        pairs = [(lo + 0.0, math.inf if math.isnan(hi) else math.nextafter(hi, math.inf))
                 for lo, hi in zip(sketch[f"s{i}"][::2], sketch[f"s{i}"][1::2]) if not math.isnan(lo)]
        cuts = sorted({x for pair in pairs for x in pair if math.isfinite(x)}) or [0.0]
        zones[i] = [-math.inf, *cuts, math.inf]
        # NaN has a zone of its own behind the others
        close[i] = {len(cuts) + 1}
        for lo, hi in pairs:
            first = min(bisect_left(zones[i], lo), len(cuts))
            close[i].update(range(first, max(bisect_left(zones[i], hi), first + 1)))
        wanted[i] = [max(1, math.ceil(p * sketch[f"n{i}"])) for p in probs]
    found: dict[int, set[float]] = {i: set() for i in range(len(cols))}
    while any(wanted.values()):
        mine = [i for i, ranks in wanted.items() if ranks]
        cut = Bucketizer(splitsArray=[zones[i] for i in mine], inputCols=[f"__{i}" for i in mine], outputCols=[f"z{i}" for i in mine],
                         handleInvalid="keep").transform(values)
        entries = F.explode(F.array(*[F.struct(F.lit(i).alias("c"), F.col(f"z{i}").cast("int").alias("zone"),
                                               F.when(_among(f"z{i}", close[i]), F.col(f"__{i}")).alias("value")) for i in mine]))
        counts = cut.select(entries.alias("e")).select("e.*").where("zone IS NOT NULL").groupBy("c", "zone", "value").agg(F.count(F.lit(1)).alias("n"))
        counts = written(counts, "quantiles")
        totals = {(r.c, r.zone): r.n for r in counts.groupBy("c", "zone").agg(F.sum("n").alias("n")).collect()}
        targets, left = [], {}
        for i in mine:
            below, zone, left[i] = 0, 0, []
            for rank in wanted[i]:
                while below + totals.get((i, zone), 0) < rank:
                    below, zone = below + totals.get((i, zone), 0), zone + 1
                if zone in close[i]:
                    targets.append((i, zone, rank - below))
                else:
                    left[i].append((rank, zone))
        if targets:
            inside = Window.partitionBy("c", "zone").orderBy("value").rowsBetween(Window.unboundedPreceding, Window.currentRow)
            at = df.sparkSession.createDataFrame(targets, "c int, zone int, rank long")
            ranked = counts.join(F.broadcast(at.select("c", "zone").distinct()), ["c", "zone"], "left_semi").withColumn("__to", F.sum("n").over(inside))
            hit = ranked.join(F.broadcast(at), ["c", "zone"]).where((F.col("rank") <= F.col("__to")) & (F.col("rank") > F.col("__to") - F.col("n")))
            for r in hit.select("c", "value").distinct().collect():
                found[r.c].add(r.value)
        close = {i: {zone for _, zone in rest} for i, rest in left.items()}
        wanted = {i: [rank for rank, _ in rest] for i, rest in left.items()}
    return {c: sorted(found[i]) for i, c in enumerate(cols)}


def _among(zone: str, wanted: set[int]) -> Column:
    """Whether a zone is one of those wanted; their number may go to tens of thousands."""
    return F.col(zone).cast("int").isin(sorted(wanted))


def inverse_scale(col: Column, divisor: float = 222106) -> Column:
    """1 for values up to 0, falling towards 0 as the value grows."""
    return 1 / (relu(col.cast("double")) / F.lit(float(divisor)) + 1)


def sigmoid(col: Column) -> Column:
    return 1 / (1 + F.exp(-col))


def relu(col: Column) -> Column:
    return F.when(col.isNotNull(), F.greatest(col, F.lit(0.0)))
