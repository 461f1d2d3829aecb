"""Vocabularies and rank maps as tables.

A vocabulary is `emb_name, value, id`.  Ids start at 1; id 0 is unknown, missing
and padding.  A value that found its vocabulary full is kept with id 0.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rankflow.functions.text import clamp_gap, normalise_category, pad_truncate, parse_id_list
from rankflow.operators.layout import BROADCAST_ROWS, lookup_join, row_index
from rankflow.registry import GAP_VOCABULARIES, Feature, Registry

VOCAB_SCHEMA = T.StructType([
    T.StructField("emb_name", T.StringType()),
    T.StructField("value", T.StringType()),
    T.StructField("id", T.LongType()),
])


def empty_vocab(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], VOCAB_SCHEMA)


def list_items(col: Column, emb_name: str) -> Column:
    """The values of a list column, in order, as its vocabulary spells them."""
    items = parse_id_list(col)
    return clamp_gap(items) if emb_name in GAP_VOCABULARIES else items


def _filled() -> Column:
    """Neither missing nor all white space.  Most values tell by their first character: beyond the space nothing is white to the pattern."""
    return (F.ascii("value") > 32) | F.col("value").rlike(r"\S")


def vocab_values(df: DataFrame, registry: Registry, first_seen: str) -> DataFrame:
    """Distinct values of every vocabulary member with the earliest `first_seen`.

    All members of all vocabularies go through one aggregation, so a vocabulary shared
    by many columns has one set of values.  Equal values are combined before the shuffle.
    """
    registry = registry.present_in(df.columns)
    words: dict[str, list[Column]] = {}
    scalars: dict[str, list[Column]] = {}
    for f in registry.group("sparse"):
        scalars.setdefault(f.emb_name, []).append(normalise_category(F.col(f.name)))
    for emb, texts in scalars.items():
        words[emb] = [F.array(*texts)]
    for f in registry.group("sequence"):
        items = list_items(F.col(f.name), f.emb_name)
        words.setdefault(f.emb_name, []).append(F.coalesce(items, F.array().cast("array<string>")))
    # the number of its vocabulary stands beside every value, so that one step opens all lists and few bytes are grouped
    numbered = [(i, items) for i, lists in enumerate(words.values()) for items in lists]
    lists = df.select(F.col(first_seen).alias("first_seen"), *[items.alias(f"__{k}") for k, (_, items) in enumerate(numbered)])
    numbers = F.concat(*[F.array_repeat(F.lit(i), F.size(f"__{k}")) for k, (i, _) in enumerate(numbered)])
    values = F.concat(*[F.col(f"__{k}") for k in range(len(numbered))])
    pairs = lists.select("first_seen", F.explode(F.arrays_zip(numbers.alias("number"), values.alias("value"))).alias("v")).select("first_seen", "v.*")
    found = pairs.where(_filled()).groupBy("number", "value").agg(F.min("first_seen").alias("first_seen"))
    return found.select(F.get(F.array(*map(F.lit, words)), F.col("number")).alias("emb_name"), "value", "first_seen")


def extend_vocab(values: DataFrame, existing: DataFrame, capacities: Mapping[str, int],
                 retry_overflow: bool = False) -> DataFrame:
    """The whole vocabulary after adding the new ones of `values` (emb_name, value, first_seen).

    New values get the next ids in the order (first_seen, value) while the id is below
    the vocabulary's capacity; later ones get 0.  Existing ids never change.  With
    `retry_overflow` refused values of `values` are tried again, and the other refused
    ones stay as they are.  A vocabulary without a capacity is an error.
    """
    spark = values.sparkSession
    known = existing
    if retry_overflow:
        known = existing.where("id > 0")
    wanted = (values.where(_filled())
              .groupBy("emb_name", "value").agg(F.min("first_seen").alias("first_seen")))
    fresh = wanted.join(known, ["emb_name", "value"], "left_anti")
    indexed = row_index(fresh, ["emb_name", "first_seen", "value"], name="row")
    limits = spark.createDataFrame(list(capacities.items()), "emb_name string, capacity long")
    # one row per vocabulary in each of these
    start = indexed.groupBy("emb_name").agg(F.min("row").alias("start"))
    highest = known.groupBy("emb_name").agg(F.max("id").alias("highest"))
    room = start.join(limits, "emb_name", "left").join(highest, "emb_name", "left")
    next_id = F.coalesce("highest", F.lit(0)) + F.col("row") - F.col("start") + 1
    unlimited = F.raise_error(F.concat(F.lit("no capacity is given for the vocabulary "), "emb_name")).cast("bigint")
    new = indexed.join(F.broadcast(room), "emb_name").select(
        "emb_name", "value", F.when(next_id < F.coalesce(F.col("capacity"), unlimited), next_id).otherwise(F.lit(0)).alias("id"))
    whole = known.select("emb_name", "value", "id").unionByName(new)
    if not retry_overflow:
        return whole
    refused = existing.where("id = 0").join(wanted, ["emb_name", "value"], "left_anti")
    return whole.unionByName(refused.select("emb_name", "value", "id"))


def oov_report(vocab: DataFrame) -> DataFrame:
    """Per vocabulary, how many values found no room."""
    return vocab.where("id = 0").groupBy("emb_name").agg(F.count(F.lit(1)).alias("refused"))


def scalar_text(f: Feature, lowercase: bool = True) -> Column:
    return normalise_category(F.col(f.name)) if lowercase else F.coalesce(F.col(f.name).cast("string"), F.lit("unknown"))


def encode_scalar(df: DataFrame, vocab: DataFrame, members: Sequence[Feature], key: str,
                  lowercase: bool = True) -> DataFrame:
    """Replace scalar columns by their ids; unknown, blank and overflowed values become 0.

    Vocabularies within the broadcast limit are probed inside the task: one projection
    serves all their columns, however many, and nothing is shuffled.  Large ones (user
    ids) are joined, see `encode_scalar_by_join`, and last, when the rows are smallest.
    """
    small = [f for f in members if f.vocab_size <= BROADCAST_ROWS]
    large = [f for f in members if f.vocab_size > BROADCAST_ROWS]
    df = _probe_scalars(df, vocab, {f.name: (f.emb_name, scalar_text(f, lowercase)) for f in small}, Registry(small).capacities())
    return encode_scalar_by_join(df, vocab, large, key, lowercase)


def _probe_scalars(df: DataFrame, vocab: DataFrame, texts: Mapping[str, tuple[str, Column]],
                   capacities: Mapping[str, int]) -> DataFrame:
    """Ids of scalar columns, given per column its vocabulary and its text; one probe per vocabulary."""
    if not texts:
        return df
    probes = load_probes(vocab, capacities)
    by_vocabulary: dict[str, list[str]] = {}
    for name, (emb_name, _) in texts.items():
        by_vocabulary.setdefault(emb_name, []).append(name)
    found = df.withColumns({f"__ids_{emb}": probes[emb](F.array(*[texts[n][1] for n in names]))
                            for emb, names in by_vocabulary.items()})
    ids = {n: F.get(f"__ids_{emb}", F.lit(i)).alias(n) for emb, names in by_vocabulary.items() for i, n in enumerate(names)}
    return found.select(*[ids.get(c, F.col(c)) for c in df.columns])


def encode_scalar_by_join(df: DataFrame, vocab: DataFrame, members: Sequence[Feature], key: str,
                          lowercase: bool = True) -> DataFrame:
    """As `encode_scalar`, one join per column, for vocabularies of any size."""
    columns, first = df.columns, df
    usable = vocab.where("id > 0")
    for f in members:
        part = usable.where(F.col("emb_name") == f.emb_name).select(F.col("value").alias("__value"), F.col("id").alias("__id"))
        keyed = df.withColumn("__value", scalar_text(f, lowercase))
        # the column's texts are those of the first frame, so its hot keys are counted before any join
        found = lookup_join(keyed, part, ["__value"], f.vocab_size, [key], counted=first.select(scalar_text(f, lowercase).alias("__value")))
        df = found.withColumn(f.name, F.coalesce("__id", F.lit(0))).select(*columns)
    return df


def encode_list(df: DataFrame, vocab: DataFrame, members: Sequence[Feature], key: str) -> DataFrame:
    """Replace list columns by arrays of `maxlen` ids, 0 for unknown items and padding.

    Vocabularies within the broadcast limit are probed inside the task, which needs no
    shuffle.  Larger ones are joined, see `encode_list_by_join`.
    """
    small = [f for f in members if f.vocab_size <= BROADCAST_ROWS]
    large = [f for f in members if f.vocab_size > BROADCAST_ROWS]
    capacities = Registry(small).capacities()
    probes = load_probes(vocab, capacities) if small else {}
    df = df.withColumns({f.name: pad_truncate(probes[f.emb_name](list_items(F.col(f.name), f.emb_name)), f.maxlen,
                                              F.lit(0).cast("bigint")) for f in small})
    return encode_list_by_join(df, vocab, large, key) if large else df


def load_probes(vocab: DataFrame, capacities: Mapping[str, int]) -> dict[str, Callable[[Column], Column]]:
    """Per vocabulary, an Arrow function from lists of values to lists of ids.

    The vocabularies are fetched together; one with more ids than its capacity is an error.
    """
    wanted = vocab.where(F.col("emb_name").isin(list(capacities)) & (F.col("id") > 0)).select("emb_name", "value", "id")
    table = wanted.limit(sum(capacities.values()) + 1).toArrow()
    out = {}
    for emb_name, capacity in capacities.items():
        mine = table.filter(pc.field("emb_name") == emb_name).select(["value", "id"]).combine_chunks()
        if mine.num_rows > capacity:
            raise ValueError(f"vocabulary {emb_name} has more than {capacity} ids")
        out[emb_name] = _probe(vocab.sparkSession, mine)
    return out


def _probe(spark: SparkSession, table: pa.Table) -> Callable[[Column], Column]:
    shared = spark.sparkContext.broadcast({"table": table})

    @F.arrow_udf("array<bigint>")
    def probe(lists: pa.Array) -> pa.Array:
        held = shared.value
        if "index" not in held:  # once per worker process, which keeps the broadcast value
            held["index"] = dict(zip(held["table"].column("value").to_pylist(), held["table"].column("id").to_pylist(), strict=True))
        index = held["index"]
        coded = lists.flatten().dictionary_encode()
        found = pa.array([index.get(v, 0) for v in coded.dictionary.to_pylist()], pa.int64())
        ids = pc.fill_null(pc.take(found, coded.indices), 0)
        # offsets that match the flattened items: a null list has length 0
        sizes = pc.fill_null(pc.list_value_length(lists), 0).cast(pa.int32())
        offsets = pa.concat_arrays([pa.array([0], pa.int32()), pc.cumulative_sum(sizes)])
        return pa.ListArray.from_arrays(offsets, ids)

    return probe


def encode_list_by_join(df: DataFrame, vocab: DataFrame, members: Sequence[Feature], key: str) -> DataFrame:
    """As `encode_list`, for vocabularies too large to hold in a task.

    Every item of every list becomes one row, is joined, and goes back to its row `key`,
    which must be unique.
    """
    if not members:
        return df
    tagged = []
    for i, f in enumerate(members):
        items = F.coalesce(list_items(F.col(f.name), f.emb_name), F.array().cast("array<string>"))
        tagged.append(F.transform(F.slice(items, 1, f.maxlen), _positioned(i, f.emb_name)))
    items = df.select(F.col(key).alias("__row"), F.explode(F.concat(*tagged)).alias("i")).select("__row", "i.*")
    usable = vocab.where("id > 0")
    bound = sum({f.emb_name: f.vocab_size for f in members}.values())
    coded = lookup_join(items, usable, ["emb_name", "value"], bound, ["__row", "pos"]).where("id > 0")
    lists = coded.groupBy("__row").agg(*[
        F.map_from_entries(F.collect_list(F.when(F.col("feature") == i, F.struct("pos", "id")))).alias(f"__ids_{i}")
        for i in range(len(members))]).withColumnRenamed("__row", key)
    joined = df.join(lists, key, "left")
    return joined.select(*[_dense_list(members, c) for c in df.columns])


def _positioned(feature: int, emb_name: str):
    return lambda x, pos: F.struct(F.lit(feature).alias("feature"), F.lit(emb_name).alias("emb_name"),
                                   pos.alias("pos"), x.alias("value"))


def _dense_list(members: Sequence[Feature], column: str) -> Column:
    for i, f in enumerate(members):
        if f.name == column:
            at = F.col(f"__ids_{i}")
            return F.transform(F.sequence(F.lit(0), F.lit(f.maxlen - 1)),
                               lambda p: F.coalesce(F.try_element_at(at, p), F.lit(0).cast("bigint"))).alias(column)
    return F.col(column)


def feature_meta(registry: Registry, spark: SparkSession) -> DataFrame:
    """Per feature: its vocabulary, the set it belongs to and its list length.

    A feature is `bucket` when it is cut at boundaries, `sequence` when it is a list and
    `category` otherwise.
    """
    spec = registry.spec_df(spark)
    kind = F.when(F.col("kind") == "dense", "bucket").when(F.col("kind") == "sequence", "sequence").otherwise("category")
    return spec.select("name", "emb_name", kind.alias("feature_set"),
                       F.when(F.col("kind") == "sequence", F.col("maxlen")).alias("seq_size"))


def count_values(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Counts of the non-empty values of each feature as `feature, value, cnt`."""
    pairs = df.select(F.explode(F.array(*[
        F.struct(F.lit(n).alias("feature"), F.col(n).cast("string").alias("value")) for n in features])).alias("p"))
    return (pairs.select("p.*").where((F.col("value") != "") & F.col("value").isNotNull())
            .groupBy("feature", "value").agg(F.count(F.lit(1)).alias("cnt")))


def add_counts(*counts: DataFrame) -> DataFrame:
    """Totals of several count tables, such as yesterday's and today's."""
    both = counts[0]
    for c in counts[1:]:
        both = both.unionByName(c)
    return both.groupBy("feature", "value").agg(F.sum("cnt").alias("cnt"))


def rank_vocab(counts: DataFrame, tops: Mapping[str, int]) -> DataFrame:
    """The most frequent values of each feature, ranked from 1; ties go by value.

    Each feature is a distributed top-n, so the ranking itself sees n rows only.
    """
    ranked = None
    for feature, n in tops.items():
        top = (counts.where(F.col("feature") == feature).orderBy(F.desc("cnt"), "value").limit(n)
               .withColumn("id", F.row_number().over(Window.partitionBy("feature").orderBy(F.desc("cnt"), "value")).cast("bigint"))
               .select("feature", "value", "id"))
        ranked = top if ranked is None else ranked.unionByName(top)
    return ranked


def encode_rank(df: DataFrame, previous: DataFrame, tops: Mapping[str, int]) -> DataFrame:
    """Replace each column by its rank in the previous run's map, 0 when it has none.

    A map has as many rows as ranks are kept, so it is probed like a small vocabulary.
    """
    texts = {feature: (feature, F.col(feature).cast("string")) for feature in tops}
    return _probe_scalars(df, previous.withColumnRenamed("feature", "emb_name"), texts, tops)
