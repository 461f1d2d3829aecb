"""Features of the past: plain versions, incremental runs, late rows, skewed keys and plan shapes."""

import collections
import datetime
import random

import pytest
from pyspark.sql import functions as F

from rankflow.operators import history, samples
from rankflow.operators.layout import as_of_join
from rankflow.registry import crossed_features
from rankflow.session import new_path, written
from rankflow.streaming import recent


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


# --- N1 ---

def visits(spark, n=600, days=40):
    random.seed(3)
    rows = [(random.choice(["a", "b", "c", None]), random.choice([*range(30), None]), random.choice([*range(1, days), None])) for _ in range(n)]
    rows += [("hot", i % 7, 5 + i % 3) for i in range(3000)]
    return rows, spark.createDataFrame(rows, "item string, user int, day int").repartition(4)


def plain_trailing(rows, windows, last=None):
    rows = [r for r in rows if r[2] is not None]
    last = max(d for *_, d in rows) if last is None else last
    out = {}
    for item, day in {(i, d + o) for i, _, d in rows for o in range(max(windows)) if d + o <= last}:
        held = [[u for i, u, d in rows if i == item and day - w < d <= day] for w in windows]
        out[item, day] = tuple(map(len, held)) + tuple(len({u for u in us if u is not None}) for us in held)
    return out


@pytest.mark.parametrize("last", [None, 20])
def test_trailing_counts(spark, last):
    rows, df = visits(spark)
    got = history.trailing_counts(df, ["item"], "day", (1, 3, 7), "user", last=last).collect()
    assert {(r.item, r.day): tuple(r)[2:] for r in got} == plain_trailing(rows, (1, 3, 7), last)
    assert len(got) == len({(r.item, r.day) for r in got})


def test_trailing_counts_without_rows_or_users(spark):
    _, df = visits(spark)
    assert history.trailing_counts(df.where("false"), ["item"], "day", (1, 3), "user").count() == 0
    assert history.trailing_counts(df, ["item"], "day", (2,), names={"pv": "click"}).columns == ["item", "day", "click_2"]


def test_a_hot_key_is_counted_before_the_shuffle(spark):
    """Windows over a key's events would meet in one task; counts per step do not need one."""
    _, df = visits(spark)
    plan = plan_of(history.trailing_counts(df, ["item"], "day", (1, 3, 7), "user"))
    assert "Window" not in plan and "partial_count" in plan


def test_sketches_merge_day_by_day(spark):
    """Tables of single days, written apart, give what one pass over all days gives; users within the stated error."""
    days, users = 9, 40_000
    events = spark.range(users * 3).select((F.col("id") % 2).alias("item"), (F.xxhash64("id") % users).alias("user"),
                                           F.pmod(F.xxhash64(F.col("id") + 7), F.lit(days)).alias("day"))
    parts = [written(history.step_sketches(events.where(F.col("day") == d), ["item"], "day", "user"), "day") for d in range(days)]
    merged = parts[2]
    for p in parts[3:]:
        merged = merged.unionByName(p)
    got = history.trailing_from_sketches(merged, ["item"], "day", (1, 7), first=8).collect()
    exact = {(r.item, r.day): r for r in history.trailing_counts(events, ["item"], "day", (1, 7), "user").collect()}
    assert {r.day for r in got} == {8} and len(got) == 2
    for r in got:
        want = exact[r.item, r.day]
        assert (r.pv_1, r.pv_7) == (want.pv_1, want.pv_7)
        # three standard errors of 1.6 %
        assert abs(r.uv_7 - want.uv_7) < 0.05 * want.uv_7 and abs(r.uv_1 - want.uv_1) < 0.05 * want.uv_1


# --- N2 ---

START = datetime.datetime(2024, 3, 1, tzinfo=datetime.timezone.utc)


def clicks(n=400, hours=60):
    random.seed(11)
    return [(random.choice("abc"), random.randrange(25), START + datetime.timedelta(seconds=random.randrange(hours * 3600))) for _ in range(n)]


def test_recent_counts(spark):
    rows = clicks()
    df = spark.createDataFrame([*rows, ("a", 1, None)], "item string, user int, ts timestamp")
    got = recent.recent_window_counts(recent.hourly_counts(df, ["item"], "ts", "user"), ["item"], (1, 6, 24))
    found = {(r[0], r[1]): tuple(r)[2:] for r in got.withColumn("as_of", F.unix_timestamp("as_of")).collect()}
    want = {}
    moments = [(i, u, int(t.timestamp())) for i, u, t in rows]
    for item, at in {(i, (t // 3600 + 1 + o) * 3600) for i, _, t in moments for o in range(24)}:
        held = [[u for i, u, t in moments if i == item and at - h * 3600 <= t < at] for h in (1, 6, 24)]
        want[item, at] = tuple(map(len, held)) + tuple(len(set(u)) for u in held)
    assert found == want


def test_late_rows_in_a_stream_give_the_batch_result(spark):
    """Rows arrive file by file in random order, up to their lateness; rows later than that are dropped."""
    rows, schema = clicks(), "item string, user int, ts timestamp"
    folder, target, state = (new_path(spark, n) for n in ("in", "out", "state"))
    random.seed(5)
    shuffled = random.sample(rows, len(rows))
    for k in range(8):  # one file each, later rows of all hours in each of them
        spark.createDataFrame(shuffled[k::8], schema).coalesce(1).write.mode("append").parquet(folder)
    flush = [("z", 0, START + datetime.timedelta(days=30))]
    stream = lambda: spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)

    def run():
        hourly = recent.hourly_counts(stream(), ["item"], "ts", "user", late="3 days")
        out = recent.recent_window_counts(hourly, ["item"], (1, 6, 24))
        q = out.writeStream.format("parquet").option("path", target).option("checkpointLocation", state).outputMode("append").trigger(
            availableNow=True).start()
        q.awaitTermination()
        assert q.exception() is None
    run()
    # the watermark passes with a much later row; what is older than it then counts no more
    spark.createDataFrame(flush, schema).coalesce(1).write.mode("append").parquet(folder)
    run()
    spark.createDataFrame([("a", 99, START)], schema).coalesce(1).write.mode("append").parquet(folder)
    run()
    batch = recent.recent_window_counts(recent.hourly_counts(spark.createDataFrame(rows, schema), ["item"], "ts", "user"), ["item"], (1, 6, 24))
    got = collections.Counter(map(tuple, spark.read.parquet(target).where("item <> 'z'").collect()))
    assert got == collections.Counter(map(tuple, batch.collect())) and len(got) > 100


# --- N3 ---

def plain_as_of(facts, states, strict):
    out = []
    for i, key, t in facts:
        best = [(s, v) for k, s, v in states if key is not None and k == key and t is not None and s is not None and (s < t or (s == t and not strict))]
        out.append((i, key, t, max(best)[1] if best else None))
    return collections.Counter(out)


@pytest.mark.parametrize("strict", [False, True])
def test_as_of_join(spark, strict):
    random.seed(7)
    key = lambda: random.choice(["hot"] * 6 + ["a", "b", "c", None])
    facts = [(i, key(), random.choice([*range(200), None])) for i in range(1500)]
    states = [(key(), random.choice([*range(0, 200, 3), None]), random.randrange(9)) for _ in range(200)] + [("early", 1, 5)]
    f = spark.createDataFrame([*facts, (9999, "early", 10**6), (9998, "none", 5)], "i int, key string, t int").repartition(5)
    s = spark.createDataFrame(states, "key string, at int, v int").repartition(3)
    got = as_of_join(f, s, ["key"], "t", "at", strict, partitions=16)
    assert got.columns == ["i", "key", "t", "v"]
    assert collections.Counter(map(tuple, got.collect())) == plain_as_of([*facts, (9999, "early", 10**6), (9998, "none", 5)], states, strict)
    assert as_of_join(f.where("false"), s, ["key"], "t", "at").count() == 0
    assert {r.v for r in as_of_join(f, s.where("false"), ["key"], "t", "at").collect()} == {None}


def test_a_hot_key_is_cut_by_time(spark, monkeypatch):
    """All facts of one key: no partition of the layout gets much more than its share."""
    from rankflow.operators import layout
    laid = {}
    monkeypatch.setattr(layout, "written", lambda df, name: laid.setdefault(name, written(df, name)))
    facts = spark.range(40_000).select("id", F.lit("hot").alias("key"), (F.col("id") % 5).alias("t"))
    states = spark.createDataFrame([("hot", 0, 1), ("hot", 3, 2)], "key string, at long, v int")
    got = as_of_join(facts, states, ["key"], "t", "at", partitions=8)
    assert {(r.t, r.v): r["count"] for r in got.groupBy("t", "v").count().collect()} == {(t, 1 if t < 3 else 2): 8000 for t in range(5)}
    sizes = [r["count"] for r in laid["as_of"].groupBy("__part").count().collect()]
    assert len(sizes) == 8 and max(sizes) < 2 * 40_002 / 8


def test_rates(spark):
    df = spark.createDataFrame([("a", 1, 1), ("a", 1, 0), ("a", 3, 1), ("b", 2, 0)], "item string, day int, hit int")
    counts = history.cumulative_counts(df, ["item"], "day", {"shows": F.lit(1), "hits": F.col("hit")})
    assert {tuple(r) for r in counts.collect()} == {("a", 1, 2, 1), ("a", 3, 3, 2), ("b", 2, 1, 0)}
    rows = spark.createDataFrame([(1, 2), (0, 0), (None, None)], "a int, b int").select(history.rate(F.col("a"), F.col("b")).alias("r")).collect()
    assert [r.r for r in rows] == [0.5, 0.0, 0.0]


# --- N4 ---

def watched(n=900):
    random.seed(13)
    rows = [(random.choice(["u1", "u2", None]), random.choice([f"b{i}" for i in range(40)] + [None]), random.choice([*range(300), None]), random.choice("MF"))
            for _ in range(n)]
    return rows + [("hot", f"b{i % 90}", i % 500, "M") for i in range(5000)]


def plain_items(rows, k):
    latest = {}
    for u, b, t, g in rows:
        if None not in (u, b, t):
            latest[u, b] = max(latest.get((u, b), (t, g)), (t, g))
    out = set()
    for user in {u for u, _ in latest}:
        mine = sorted(((-t, b, g) for (u, b), (t, g) in latest.items() if u == user))[:k]
        out |= {(user, b, -t, g, i + 1) for i, (t, b, g) in enumerate(mine)}
    return out


ARGS = ("user", "book", "t", 20, ["gender"])
WATCHED = "user string, book string, t int, gender string"


def test_last_items_day_by_day(spark):
    rows = watched()
    df = spark.createDataFrame(rows, WATCHED).repartition(6)
    once = {tuple(r) for r in history.last_items(df, *ARGS).select("user", "book", "t", "gender", "place").collect()}
    assert once == plain_items(rows, 20)
    state = history.last_items(df.where("t < 100"), *ARGS)
    for a, b in ((100, 250), (250, 500)):
        state = history.merged_items(written(state, "state"), df.where(f"t >= {a} AND t < {b}"), *ARGS)
    assert {tuple(r) for r in state.select("user", "book", "t", "gender", "place").collect()} == once
    assert history.last_items(df.where("false"), *ARGS).count() == 0


def test_a_users_history_does_not_meet_in_one_task(spark):
    plan = plan_of(history.last_items(spark.createDataFrame(watched(), WATCHED), *ARGS))
    assert "WindowGroupLimit" in plan and "Partial" in plan.split("WindowGroupLimit", 1)[1] and "collect_list" not in plan


def test_item_lists(spark):
    days = [("u", "b", datetime.date(2024, 1, 9), "M"), ("u", "a", datetime.date(2023, 1, 1), "F"), ("u", "c", datetime.date(2024, 1, 12), "F")]
    state = history.last_items(spark.createDataFrame(days, "user string, book string, t date, gender string"), "user", "book", "t", 20, ["gender"])
    rows = history.item_lists(state, "user", "book", "t", F.to_date(F.lit("2024-01-10")), ["gender"]).collect()
    assert [tuple(r) for r in rows] == [("u", ["c", "b", "a"], [0, 1, 190], ["F", "M", "F"])]


# --- N6 ---

def test_bitmaps_day_by_day(spark):
    random.seed(17)
    rows = [(random.choice([1, 2, 3, None]), random.randrange(1, 120)) for _ in range(300)] + [(4, 1), (5, 100), (5, 100)]
    df = spark.createDataFrame(rows, "user int, day int").repartition(3)
    once = {r.user: r.bits for r in history.day_bitmaps(df, "user", "day", 110).collect()}
    want = {u: sum(1 << (110 - d) for d in {d for v, d in rows if v == u and 110 - 63 < d <= 110}) for u in (1, 2, 3, 5)}
    assert {u: b for u, b in once.items() if b} == want
    state = history.day_bitmaps(df, "user", "day", 40)
    for then, now in ((40, 41), (41, 90), (90, 110)):
        state = history.advanced_bitmaps(written(state, "bits"), df.where((F.col("day") > then) & (F.col("day") <= now)), "user", "day", now - then, now)
    assert {r.user: r.bits for r in state.collect()} == want
    gone = history.advanced_bitmaps(state, df.where("false"), "user", "day", 63, 173)
    assert gone.count() == 0
    days = {r.user: (r.a, r.b) for r in state.select("user", history.active_days(F.col("bits"), 7).alias("a"), history.active_days(F.col("bits"), 63).alias("b")).collect()}
    assert days == {u: ((b & 127).bit_count(), b.bit_count()) for u, b in want.items()}
    with pytest.raises(ValueError):
        history.active_days(F.col("bits"), 64)


# --- N5 ---

def test_crosses(spark):
    assert len(crossed_features()) == 20 and crossed_features()["osMbMaketypeBGender"] == ("os", "mb_maketype", "b_gender")
    df = spark.createDataFrame([("iOS", "M", None)], "os string, mb_gender string, b_gender string")
    rows = samples.with_crosses(df).collect()
    assert [r.asDict() for r in rows] == [{"os": "iOS", "mb_gender": "M", "b_gender": None, "osMbGenderBGender": "ios_m_unknown"}]
