"""Adam updates as joins of a state table with summed gradients.

State is `feature, id, vec, m, v`; gradients are `feature, id, g` and may repeat an id.
Rows missing from the state stand for their start values with empty moments.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankflow.functions.vectors import collected_sums, sum_vectors, zero_vector
from rankflow.operators.embed import init_vector
from rankflow.operators.samples import select_by_name_pattern
from rankflow.registry import EMBEDDING_DIM

KEYS = ["feature", "id"]


def step_rate(lr: float, beta1: float, beta2: float, step: int) -> float:
    """Learning rate with the correction for the moments' start at zero."""
    return lr * (1 - beta2 ** step) ** 0.5 / (1 - beta1 ** step)


def sum_gradients(grads: DataFrame, dim: int = EMBEDDING_DIM) -> DataFrame:
    """One gradient per id.  The sums combine before the shuffle, so a frequent id costs no more than a rare one."""
    return grads.groupBy(*KEYS).agg(*sum_vectors(F.col("g"), dim)).select(*KEYS, collected_sums(dim).alias("g"))


def _joined(state: DataFrame, sums: DataFrame, dim: int, seed: int) -> DataFrame:
    both = state.join(sums, KEYS, "full_outer")
    vec = F.coalesce(F.col("vec").cast("array<double>"), init_vector(F.col("feature"), F.col("id"), dim, seed))
    return both.select(*KEYS, vec.alias("vec"), F.coalesce("m", zero_vector(dim)).alias("m"),
                       F.coalesce("v", zero_vector(dim)).alias("v"), "g")


def _decayed(slot: Column, g: Column, beta: float) -> Column:
    return F.zip_with(slot, g, lambda s, x: s * beta + x * (1 - beta))


def _update(rows: DataFrame, g: Column, touched: Column, rate: float, beta1: float, beta2: float, epsilon: float) -> DataFrame:
    squares = F.transform(g, lambda x: x * x)
    moved = rows.withColumns({"m": F.when(touched, _decayed(F.col("m"), g, beta1)).otherwise(F.col("m")),
                              "v": F.when(touched, _decayed(F.col("v"), squares, beta2)).otherwise(F.col("v"))})
    steps = F.zip_with("m", "v", lambda m, v: m * rate / (F.sqrt(v) + epsilon))
    vec = F.zip_with("vec", steps, lambda w, s: w - s)
    return moved.select(*KEYS, F.when(touched, vec).otherwise(F.col("vec")).alias("vec"), "m", "v")


def lazy_adam_step(state: DataFrame, grads: DataFrame, step: int, lr: float = 0.001, beta1: float = 0.9,
                   beta2: float = 0.999, epsilon: float = 1e-8, bias_correction: str = "step",
                   dim: int = EMBEDDING_DIM, seed: int = 42) -> DataFrame:
    """Update only the ids with a gradient; all other rows stay as they are.

    `bias_correction="constant"` uses the first step's rate for ever.
    """
    if bias_correction not in ("step", "constant"):
        raise ValueError(f"unknown bias_correction {bias_correction!r}")
    rate = step_rate(lr, beta1, beta2, step if bias_correction == "step" else 1)
    rows = _joined(state, sum_gradients(grads, dim), dim, seed)
    return _update(rows, F.col("g"), F.col("g").isNotNull(), rate, beta1, beta2, epsilon)


def adam_step(state: DataFrame, grads: DataFrame, step: int, lr: float = 0.001, beta1: float = 0.9,
              beta2: float = 0.999, epsilon: float = 1e-8, dim: int = EMBEDDING_DIM, seed: int = 42) -> DataFrame:
    """Dense update, and the sparse one in which the moments of all ids decay: a missing gradient is zero."""
    rows = _joined(state, sum_gradients(grads, dim), dim, seed)
    g = F.coalesce("g", zero_vector(dim))
    return _update(rows, g, F.lit(True), step_rate(lr, beta1, beta2, step), beta1, beta2, epsilon)


def fresh_state(emb: DataFrame, dim: int = EMBEDDING_DIM) -> DataFrame:
    return emb.select(*KEYS, F.col("vec").cast("array<double>").alias("vec"), zero_vector(dim).alias("m"), zero_vector(dim).alias("v"))


def warm_start(fresh: DataFrame, previous: DataFrame | None, include: Sequence[str] = (), exclude: Sequence[str] = (),
               skip_global_step: bool = True) -> DataFrame:
    """The fresh state with the rows the previous run has under a wanted name taken from there.

    Without a previous run, the fresh state as it is.
    """
    if previous is None:
        return fresh
    old = select_by_name_pattern(previous, include, exclude, skip_global_step, "feature")
    slots = [c for c in fresh.columns if c not in KEYS]
    old = old.select(*KEYS, F.struct(*slots).alias("__old"))
    return fresh.join(old, KEYS, "left").select(
        *KEYS, *[F.when(F.col("__old").isNotNull(), F.col("__old")[c]).otherwise(F.col(c)).alias(c) for c in slots])
