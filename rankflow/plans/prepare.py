"""Raw samples to encoded training rows: the whole preparation as one chain of operators."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankflow.functions.numeric import bucketize
from rankflow.operators import samples, vocab
from rankflow.operators.layout import BROADCAST_ROWS
from rankflow.registry import LABELS, Registry


def clean(raw: DataFrame, registry: Registry) -> DataFrame:
    """Drop accidental impressions and add labels.  Row by row: nothing is shuffled.

    Negatives are thinned out for fitting only, by `samples.downsample_negatives`; scores and losses cover all rows.
    """
    return samples.label_samples(samples.drop_accidental(samples.canonical_names(raw, registry)))


def bucketed(df: DataFrame, registry: Registry) -> DataFrame:
    """Cut every dense column that `df` has at its boundaries."""
    dense = registry.present_in(df.columns).group("dense")
    return bucketize(df, {f.name: f.boundaries for f in dense})


def encode(df: DataFrame, registry: Registry, vocabulary: DataFrame, ranks: DataFrame, key: str,
           tops: Mapping[str, int]) -> DataFrame:
    """Ids for all scalar, list and rank columns from finished maps."""
    have = registry.present_in(df.columns)
    small = [f for f in have.group("sparse") if f.vocab_size <= BROADCAST_ROWS]
    large = [f for f in have.group("sparse") if f.vocab_size > BROADCAST_ROWS]
    df = vocab.encode_scalar(df, vocabulary, small, key)
    df = vocab.encode_list(df, vocabulary, have.group("sequence"), key)
    df = vocab.encode_rank(df, ranks, {f: n for f, n in tops.items() if f in have})
    # the joins come last, when every other text has become a number
    return vocab.encode_scalar_by_join(df, vocabulary, large, key)


def model_rows(df: DataFrame, registry: Registry, key: str) -> DataFrame:
    """Key, labels and features in slot order."""
    return df.select(key, *LABELS, *[F.col(n) for n in registry.present_in(df.columns).names()])
