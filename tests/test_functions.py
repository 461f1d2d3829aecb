"""Column functions against plain Python on small edge tables."""

import bisect
import itertools
import math
import random
from datetime import datetime

import pytest
import xxhash
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from rankflow.functions import hashing, numeric, text, vectors

BOUNDS = [-1.0, 0.0, 2.5, 2.5, 7.0, 7.0, 7.0, 34.0]


def column(df, expr):
    return [r[0] for r in df.select(expr.alias("x")).collect()]


def test_bucketize_edges(spark):
    values = [-5.0, -1.0, -0.5, 0.0, 2.5, 3.0, 7.0, 34.0, 99.0, None, float("nan"), float("inf"), float("-inf")]
    df = spark.createDataFrame([(i, v, v) for i, v in enumerate(values)], "i int, a double, b double")
    cut = numeric.bucketize(df, {"a": BOUNDS, "b": [1.0, 2.0]})
    assert cut.columns == ["i", "a", "b"]
    for row in cut.collect():
        x = values[row.i]
        x = 0.0 if x is None or math.isnan(x) else x
        assert row.a == bisect.bisect_right(BOUNDS, x)
        assert row.b == bisect.bisect_right([1.0, 2.0], x)
    by_column = column(df, numeric.bucket_index(F.col("a"), BOUNDS))
    assert by_column == [r.a for r in cut.orderBy("i").collect()]


@settings(max_examples=8, deadline=None)
@given(cuts=st.lists(st.floats(-50, 50), min_size=1, max_size=12), values=st.lists(st.floats(-60, 60), min_size=1, max_size=30))
def test_bucketize_is_bisect_right(spark, cuts, values):
    cuts = sorted(c + 0.0 for c in cuts)
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double")
    for row in numeric.bucketize(df, {"v": cuts}).collect():
        assert row.v == bisect.bisect_right(cuts, values[row.i])


def test_wide_bucketize_is_one_projection(spark):
    names = [f"c{i}" for i in range(228)]
    df = spark.range(20).select("id", *[(F.col("id") * i).alias(n) for i, n in enumerate(names)])
    cut = numeric.bucketize(df, {n: [1.0, 10.0, 100.0] for n in names})
    row = cut.where("id = 7").first()
    assert [row[n] for n in names] == [bisect.bisect_right([1.0, 10.0, 100.0], 7 * i) for i in range(228)]


def test_scaling(spark):
    df = spark.createDataFrame([(-3.0,), (0.0,), (222106.0,)], "x double")
    assert column(df, numeric.inverse_scale(F.col("x"))) == [1.0, 1.0, 0.5]
    assert numeric.fit_min_max(df, ["x"]) == {"x": (-3.0, 222106.0)}
    assert column(df, numeric.quantile_scale(F.col("x"), [0.0, 1.0])) == [0.0, 0.5, 1.0]
    cuts = numeric.fit_quantiles(spark.range(1000).withColumn("x", F.col("id").cast("double")), ["x"], 4)["x"]
    assert [round(c / 250) for c in cuts] == [1, 2, 3]

def test_exact_quantiles(spark):
    """Against sorted values: ties, missing values, NaN and infinities, a constant and an empty column, as the finest sketch gives them."""
    rng = random.Random(3)
    rows = [(rng.gauss(0, 100), rng.choice([1, 1, 1, 2, None]), rng.choice([0.0, -0.0, 5.5, float("inf"), float("-inf"), None]),
             float("nan") if i % 5 == 0 else float(i), 7.0, None) for i in range(5000)]
    df = spark.createDataFrame(rows, "a double, b int, c double, d double, e double, f double").repartition(7)
    for parts in (2, 10, 997):
        got = numeric.fit_quantiles(df, list("abcdef"), parts, accuracy=100_000_000)
        for i, c in enumerate("abcdef"):
            values = sorted((float(r[i]) for r in rows if r[i] is not None), key=lambda x: (x != x, x))
            want = [values[max(1, math.ceil(k / parts * len(values))) - 1] for k in range(1, parts)] if values else []
            seen = [x for x, _ in itertools.groupby(map(str, sorted((x + 0.0 for x in want), key=lambda x: (x != x, x))))]
            assert sorted(map(str, got[c])) == sorted(seen), (c, parts)


def test_exact_quantiles_keep_few_values_in_a_task(spark, monkeypatch):
    """No task holds the values of a column: the only sketches asked for are coarse ones, and ranks are exact even where those miss."""
    asked = []
    real = F.percentile_approx
    monkeypatch.setattr(F, "percentile_approx", lambda col, probs, accuracy: asked.append(accuracy) or real(col, probs, 20))
    df = spark.range(20000).select((F.col("id") * 7919 % 20000).cast("double").alias("x"))
    got = numeric.fit_quantiles(df, ["x"], 8, accuracy=100_000_000)["x"]
    assert got == [i * 2500.0 - 1 for i in range(1, 8)] and asked and max(asked) <= 10_000


def test_elapsed_days_floors(spark):
    cases = [("2024-01-02 00:00:00", "2024-01-02 00:00:00"), ("2024-01-02 00:00:00", "2024-01-02 00:00:01"),
             ("2024-01-03 00:00:00", "2024-01-02 00:00:00"), ("2024-03-31 12:00:00", "2024-03-30 13:00:00"),
             ("2024-1-3 1:2:3", "2024-01-01 00:00:00"), ("", "2024-01-01 00:00:00"), ("soon", "2024-01-01 00:00:00"),
             (None, "2024-01-01 00:00:00"), ("2024-02-30 00:00:00", "2024-01-01 00:00:00")]

    def expected(a, b):
        try:
            return (datetime.strptime(a, "%Y-%m-%d %H:%M:%S") - datetime.strptime(b, "%Y-%m-%d %H:%M:%S")).days
        except (ValueError, TypeError):
            return -1

    df = spark.createDataFrame(cases, "a string, b string")
    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")  # a day with 23 hours must not matter
    try:
        assert column(df, text.elapsed_days(F.col("a"), F.col("b"))) == [expected(a, b) for a, b in cases]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_extract_tags(spark):
    cases = {"1_a,2_b_c": "a,b_c", "1_a,zz": "unknown", "zz,1_a": "unknown", "": "unknown", None: "unknown", "_x": "x",
             "1_": "", "1_a,": "unknown", "a__b": "_b"}
    df = spark.createDataFrame([(k,) for k in cases], "t string")
    assert column(df, text.extract_tags(F.col("t"))) == list(cases.values())


def test_date_range(spark):
    days = lambda a, b: sorted(r.dt for r in text.date_range(spark, a, b).collect())
    assert days("2024-02-28", "2024-03-01") == ["2024-02-28", "2024-02-29", "2024-03-01"]
    assert days("2024-02-28", "2024-02-28") == ["2024-02-28"]
    assert days("2024-02-28", "2024-01-01") == ["2024-02-28"]


def test_flags(spark):
    df = spark.createDataFrame([("Yes",), ("0",), ("T",), ("No",)], "f string")
    assert column(df, text.parse_flag(F.col("f"))) == [True, False, True, False]
    bad = spark.createDataFrame([("maybe",)], "f string")
    assert column(bad, text.parse_flag(F.col("f"), strict=False)) == [None]
    with pytest.raises(PySparkException):
        column(bad, text.parse_flag(F.col("f")))


def test_lists(spark):
    df = spark.createDataFrame([("12_400,",), ("",), (None,), ("x,-3",)], "l string")
    items = text.parse_id_list(F.col("l"))
    assert column(df, items) == [["12", "400", ""], [""], None, ["x", "-3"]]
    assert column(df, text.clamp_gap(items)) == [["12", "190", ""], [""], None, [None, "-3"]]
    sizes = F.transform(items, lambda x: F.length(x))
    assert column(df, text.pad_truncate(sizes, 2)) == [[2, 3], [0, 0], [0, 0], [1, 2]]


def test_hash_buckets(spark):
    df = spark.createDataFrame([("a", 12), ("b", -1), (None, None)], "s string, n int")
    for method in ("xxhash64", "md5"):
        text_ids = column(df, hashing.hash_bucket(F.col("s"), 1000, method))
        assert text_ids[2] is None and all(0 <= i < 1000 for i in text_ids[:2])
    same = df.select(hashing.hash_bucket(F.col("n"), 97).alias("a"), hashing.hash_bucket(F.col("n").cast("string"), 97).alias("b")).first()
    assert same.a == same.b
    assert column(df, hashing.identity_bucket(F.col("n"), 12, 0)) == [0, 0, 0]
    with pytest.raises(PySparkException):
        column(df, hashing.identity_bucket(F.col("n"), 100))


def test_vector_functions(spark):
    df = spark.createDataFrame([([1.0, -2.0, 3.0],)], "v array<double>")
    v = F.col("v")
    assert column(df, vectors.dot(v, v)) == column(df, vectors.dot(v, v, 3)) == [14.0]
    assert column(df, vectors.relu_vector(v)) == [[1.0, 0.0, 3.0]]
    assert sum(column(df, vectors.softmax(v))[0]) == pytest.approx(1.0)


@given(st.lists(st.one_of(st.none(), st.text(max_size=40)), min_size=1, max_size=20), st.integers(1, 10**7))
@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
def test_fast_buckets_are_those_of_the_published_hash(spark, texts, buckets):
    """The 64-bit xxHash of the text's UTF-8 bytes with seed 42, read as signed, modulo the buckets."""
    texts = [None if t is None else t.encode("utf-8", "ignore").decode() for t in texts]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, s string")
    got = [r.b for r in df.select("i", hashing.hash_bucket(F.col("s"), buckets).alias("b")).orderBy("i").collect()]
    for text, bucket in zip(texts, got):
        want = None if text is None else xxhash.xxh64(text.encode(), seed=42).intdigest()
        assert bucket == (None if want is None else (want - (1 << 64) * (want >> 63)) % buckets)
