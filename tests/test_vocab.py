"""Vocabularies, ranks and list encoding."""

import random

import pytest
from pyspark.sql import functions as F

from rankflow.operators import vocab
from rankflow.registry import Feature, Registry, default_registry

VALUES = "emb_name string, value string, first_seen long"


def table(df):
    return {(r.emb_name, r.value): r.id for r in df.collect()}


def ids_one_by_one(pairs, known, capacity):
    """Ids by feeding the values one by one, in the declared order."""
    ids = dict(known)
    for emb, value, _ in sorted(pairs, key=lambda p: (p[0], p[2], p[1] or "")):
        if not value or not value.strip() or (emb, value) in ids:
            continue
        used = sum(1 for (e, _), i in ids.items() if e == emb)
        ids[emb, value] = used + 1 if used < capacity[emb] - 1 else 0
    return ids


def test_extend_vocab_over_capacity_and_twice(spark):
    capacity = {"a": 5, "b": 100}
    day1 = [("a", "x", 3), ("a", "y", 1), ("a", "", 1), ("a", None, 1), ("a", " \t\n", 2), ("b", "x", 9), ("a", "x", 7)]
    day2 = [("a", v, 10) for v in ("p", "q", "r", "s", "y")] + [("b", "w", 11), ("b", "x", 1)]
    first = vocab.extend_vocab(spark.createDataFrame(day1, VALUES), vocab.empty_vocab(spark), capacity)
    expected = ids_one_by_one(day1, {}, capacity)
    assert table(first) == expected == {("a", "y"): 1, ("a", "x"): 2, ("b", "x"): 1}
    second = vocab.extend_vocab(spark.createDataFrame(day2, VALUES), first, capacity)
    expected = ids_one_by_one(day2, expected, capacity)
    assert table(second) == expected
    assert sorted(i for (e, _), i in expected.items() if e == "a") == [0, 0, 1, 2, 3, 4]
    assert {(r.emb_name, r.refused) for r in vocab.oov_report(second).collect()} == {("a", 2)}
    again = vocab.extend_vocab(spark.createDataFrame(day2, VALUES), second, capacity)
    assert table(again) == expected
    # refused values stay refused when the capacity grows, unless they are to be tried again
    grown = {"a": 50, "b": 100}
    assert table(vocab.extend_vocab(spark.createDataFrame(day2, VALUES), second, grown)) == expected
    retried = table(vocab.extend_vocab(spark.createDataFrame(day2, VALUES), second, grown, retry_overflow=True))
    assert {k: v for k, v in retried.items() if expected[k]} == {k: v for k, v in expected.items() if v}
    assert sorted(v for (e, _), v in retried.items() if e == "a") == [1, 2, 3, 4, 5, 6]


def test_extend_vocab_in_two_runs_is_one_run_over_both(spark):
    rng = random.Random(5)
    rows = [(rng.choice("ab"), f"v{rng.randrange(300)}", t) for t in range(2000)]
    capacity = {"a": 120, "b": 1000}
    df = spark.createDataFrame(rows, VALUES)
    early = vocab.extend_vocab(df.where("first_seen < 700").repartition(5), vocab.empty_vocab(spark), capacity)
    both = vocab.extend_vocab(df.repartition(3), early, capacity)
    once = vocab.extend_vocab(df, vocab.empty_vocab(spark), capacity)
    assert table(both) == table(once)


def small_registry():
    return Registry([Feature(0, "book_id", "sparse", "bid", 50), Feature(1, "mbid", "sparse", "bid", 50),
                     Feature(2, "clicks", "sequence", "bid", 50, maxlen=4), Feature(3, "gaps", "sequence", "gap_day", 20, maxlen=3)])


def rows(spark):
    return spark.createDataFrame([
        (1, "B1", None, "b1,B2_B3", "1_200,"), (2, " ", "b9", "B1_B2,B3,B4,B5", "500"), (3, None, "B1", None, None),
        (4, "b1", "B2", "", "x,7"), (5, "new", "new", "zz,zz", "200,200,200,200")],
        "id long, book_id string, mbid string, clicks string, gaps string")


def test_values_of_shared_vocabulary(spark):
    got = {(r.emb_name, r.value): r.first_seen for r in vocab.vocab_values(rows(spark), small_registry(), "id").collect()}
    assert got["bid", "b1"] == 1 and got["bid", "unknown"] == 1 and got["bid", "B1"] == 2
    assert got["gap_day", "190"] == 1 and got["gap_day", "1"] == 1 and ("gap_day", "") not in got and ("bid", " ") not in got
    # items beyond the list length count as values too
    assert got["bid", "B5"] == 2


def test_encoding_by_probe_equals_encoding_by_join(spark):
    registry = small_registry()
    words = vocab.extend_vocab(vocab.vocab_values(rows(spark).where("id < 5"), registry, "id"), vocab.empty_vocab(spark), registry.capacities())
    ids = table(words)
    probed = vocab.encode_list(rows(spark), words, registry.group("sequence"), "id").orderBy("id").collect()
    joined = vocab.encode_list_by_join(rows(spark), words, registry.group("sequence"), "id").orderBy("id").collect()
    assert [r.asDict() for r in probed] == [r.asDict() for r in joined]
    assert probed[0].clicks == [ids["bid", "b1"], ids["bid", "B2"], ids["bid", "B3"], 0]
    assert probed[1].clicks == [ids["bid", v] for v in ("B1", "B2", "B3", "B4")]
    assert probed[2].clicks == [0, 0, 0, 0] and probed[2].gaps == [0, 0, 0]
    assert probed[4].clicks == [0, 0, 0, 0]
    assert probed[3].gaps == [0, ids["gap_day", "7"], 0] and probed[4].gaps == [ids["gap_day", "190"]] * 3
    by_join = vocab.encode_scalar_by_join(rows(spark), words, registry.group("sparse"), "id").orderBy("id").collect()
    scalars = vocab.encode_scalar(rows(spark), words, registry.group("sparse"), "id").orderBy("id").collect()
    assert [r.asDict() for r in scalars] == [r.asDict() for r in by_join]
    assert [r.book_id for r in scalars] == [ids["bid", "b1"], 0, ids["bid", "unknown"], ids["bid", "b1"], 0]


def test_case_can_be_kept(spark):
    registry = small_registry()
    words = spark.createDataFrame([("bid", "B1", 1)], vocab.VOCAB_SCHEMA)
    kept = vocab.encode_scalar(rows(spark), words, registry.group("sparse")[:1], "id", lowercase=False)
    assert {r.id: r.book_id for r in kept.collect()} == {1: 1, 2: 0, 3: 0, 4: 0, 5: 0}


def test_probe_refuses_a_table_beyond_its_bound(spark):
    words = spark.createDataFrame([("bid", f"v{i}", i + 1) for i in range(60)], vocab.VOCAB_SCHEMA)
    with pytest.raises(ValueError):
        vocab.load_probes(words, {"bid": 50})


def test_ranks(spark):
    df = spark.createDataFrame([(i, v) for i, v in enumerate("aaabbccd")] + [(90, ""), (91, None)], "id long, mchid string")
    counts = vocab.count_values(df, ["mchid"])
    total = vocab.add_counts(counts, counts)
    ranks = vocab.rank_vocab(total, {"mchid": 3})
    assert {r.value: r.id for r in ranks.collect()} == {"a": 1, "b": 2, "c": 3}
    coded = vocab.encode_rank(df, ranks, {"mchid": 3}).orderBy("id").collect()
    assert [r.mchid for r in coded] == [1, 1, 1, 2, 2, 3, 3, 0, 0, 0]


def test_feature_meta(spark):
    meta = {r.name: r for r in vocab.feature_meta(default_registry(), spark).collect()}
    assert meta["mbid"].emb_name == "bid" and meta["mbid"].feature_set == "category"
    assert meta["shelf_days"].feature_set == "bucket" and meta["book_pos"].feature_set == "category"
    assert meta["userLatestVideoListId"].seq_size == 50 and meta["mchid"].seq_size is None


def test_refused_values_that_do_not_occur_today_stay(spark):
    old = spark.createDataFrame([("a", "x", 1), ("a", "gone", 0), ("a", "back", 0)], "emb_name string, value string, id long")
    today = spark.createDataFrame([("a", "back", 1)], VALUES)
    got = table(vocab.extend_vocab(today, old, {"a": 9}, retry_overflow=True))
    assert got == {("a", "x"): 1, ("a", "back"): 2, ("a", "gone"): 0}


def test_a_vocabulary_without_capacity_is_an_error(spark):
    with pytest.raises(Exception, match="no capacity"):
        vocab.extend_vocab(spark.createDataFrame([("b", "x", 1)], VALUES), vocab.empty_vocab(spark), {"a": 9}).collect()


def test_values_of_white_space_only_are_left_out(spark):
    """As the pattern says it, whatever the first character is."""
    texts = ["", " ", "  \t", "\n\x0b\f\r", "a", " a", "\ta ", "\u00a0", " \u00a0", "\x1f", "\x00", "\u3000", "\u4f60", "!", None]
    df = spark.createDataFrame([(t,) for t in texts], "value string")
    kept = {r.value for r in df.where(vocab._filled()).collect()}
    assert kept == {r.value for r in df.where(F.col("value").rlike(r"\S")).collect()} and {"a", " a", "\u00a0", "\x1f", "!"} <= kept
