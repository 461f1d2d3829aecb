"""Features of the past: counts over trailing days or hours, last items, active days, rates as of a moment.

All of them are built from small mergeable parts (counts per key and step, sketches, last rows, bitmaps), which are kept as
tables per day and merged; a later day does not read earlier events again.  `step` columns are whole numbers of days or hours.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rankflow.functions.text import GAP_LIMIT

# A day bitmap has one bit per day in a long; the sign bit is not used.
BITMAP_DAYS = 63


# --- counts over trailing steps ------------------------------------------------------------------

def _offsets(reach: Column | int) -> Column:
    return F.explode(F.sequence(F.lit(0), (F.lit(reach) if isinstance(reach, int) else reach) - 1))


def trailing_counts(events: DataFrame, keys: Sequence[str], step: str, windows: Sequence[int], user: str | None = None,
                    names: Mapping[str, str] | None = None, last: Column | int | None = None) -> DataFrame:
    """Per key and step, the events (`pv_<w>`) and different users (`uv_<w>`) of the last w steps, that step included.

    There is a row for each step at which the longest window holds an event, up to `last` (default: the last step of the events).
    Events are counted per key and step first; each count is then added to the steps whose windows hold it, so a key's history
    never meets in one task.  A user counts once in a window: each of their steps speaks for the following ones only
    up to their next step, so distinct users are plain sums.  A null key is a key; a null user is counted in pv only; a null
    step is left out.  `names` renames pv and uv.
    """
    named = {"pv": "pv", "uv": "uv", **(names or {})}
    widest = max(windows)
    events = events.where(F.col(step).isNotNull())
    end = F.lit(last) if isinstance(last, int) else events.agg(F.max(step)).scalar() if last is None else last
    daily = events.groupBy(*keys, step).agg(F.count(F.lit(1)).alias("__n"))
    parts = daily.select(*keys, step, F.col("__n"), F.lit(0).cast("long").alias("__u"), _offsets(widest).alias("__offset"))
    if user is not None:
        # the steps of one key and user are as many as there are days at most
        visits = (events.where(F.col(user).isNotNull()).groupBy(*keys, user)
                  .agg(F.sort_array(F.collect_set(step)).alias("__steps")))
        spans = F.transform("__steps", lambda s, i: F.struct(
            s.alias("step"), F.least(F.coalesce(F.get("__steps", i + 1) - s, F.lit(widest)), F.lit(widest)).cast("int").alias("reach")))
        spans = visits.select(*keys, F.explode(spans).alias("__s"))
        parts = parts.unionByName(spans.select(*keys, F.col("__s.step").alias(step), F.lit(0).cast("long").alias("__n"),
                                               F.lit(1).cast("long").alias("__u"), _offsets(F.col("__s.reach")).alias("__offset")))
    moved = parts.withColumn(step, F.col(step) + F.col("__offset")).where(F.col(step) <= end)

    def within(value: str, w: int) -> Column:
        return F.sum(F.when(F.col("__offset") < w, F.col(value)).otherwise(0))

    sums = [within("__n", w).alias(f"{named['pv']}_{w}") for w in windows]
    if user is not None:
        sums += [within("__u", w).alias(f"{named['uv']}_{w}") for w in windows]
    return moved.groupBy(*keys, step).agg(*sums)


def step_sketches(events: DataFrame, keys: Sequence[str], step: str, user: str, precision: int = 12) -> DataFrame:
    """Per key and step, the number of events `pv` and a sketch `users` of the different users: the table to keep per day.

    The sketches are HyperLogLog ones of 2 ** precision registers: estimates from them have a relative standard error of
    1.04 / sqrt(2 ** precision) (1.6 % at 12), and hardly any while there are few users.
    """
    return events.where(F.col(step).isNotNull()).groupBy(*keys, step).agg(
        F.count(F.lit(1)).alias("pv"), F.hll_sketch_agg(user, precision).alias("users"))


def trailing_from_sketches(sketches: DataFrame, keys: Sequence[str], step: str, windows: Sequence[int], first: int | None = None,
                           last: Column | int | None = None) -> DataFrame:
    """`trailing_counts` from the tables of `step_sketches`, with estimated users; only steps from `first` to `last`.

    For a new day, give the tables of the last days only: the longest window's.
    """
    widest = max(windows)
    end = F.lit(last) if isinstance(last, int) else sketches.agg(F.max(step)).scalar() if last is None else last
    moved = sketches.withColumn("__offset", _offsets(widest)).withColumn(step, F.col(step) + F.col("__offset")).where(F.col(step) <= end)
    if first is not None:
        moved = moved.where(F.col(step) >= first)
    held = {w: F.col("__offset") < w for w in windows}
    out = moved.groupBy(*keys, step).agg(
        *[F.sum(F.when(h, F.col("pv")).otherwise(0)).alias(f"pv_{w}") for w, h in held.items()],
        *[F.hll_union_agg(F.when(h, F.col("users"))).alias(f"__u_{w}") for w, h in held.items()])
    return out.select(*keys, step, *[f"pv_{w}" for w in windows],
                      *[F.coalesce(F.hll_sketch_estimate(f"__u_{w}"), F.lit(0)).alias(f"uv_{w}") for w in windows])


# --- last items ------------------------------------------------------------------------------------

def last_items(events: DataFrame, user: str, item: str, time: str, k: int = 20, attributes: Sequence[str] = ()) -> DataFrame:
    """The k items each user met last: user, item, time, attributes, place (1 for the last; ties: the smaller item).

    An item counts at the user's last meeting with it, with the attributes it had then (ties: the greatest).  Both steps merge: the first is an aggregate
    by user and item, and Spark cuts every task's rows to k per user before the second shuffle, so a user with much of the data does not
    meet in one task.  Rows without user, item or time are left out.  The result is the state to keep:
    `last_items` of yesterday's state and today's events together is that of all events.
    """
    met = events.where(" AND ".join(f"`{c}` IS NOT NULL" for c in (user, item, time)))
    latest = met.groupBy(user, item).agg(F.max(F.struct(time, *attributes)).alias("__last"))
    latest = latest.select(user, item, *[F.col(f"__last.{c}").alias(c) for c in (time, *attributes)])
    place = F.row_number().over(Window.partitionBy(user).orderBy(F.desc(time), F.asc(item)))
    return latest.withColumn("place", place).where(F.col("place") <= k)


def merged_items(state: DataFrame, events: DataFrame, user: str, item: str, time: str, k: int = 20,
                 attributes: Sequence[str] = ()) -> DataFrame:
    """Yesterday's `last_items` and today's events as today's `last_items`."""
    columns = [user, item, time, *attributes]
    return last_items(state.select(*columns).unionByName(events.select(*columns)), user, item, time, k, attributes)


def item_lists(state: DataFrame, user: str, item: str, time: str, as_of: Column, attributes: Sequence[str] = ()) -> DataFrame:
    """Per user the lists that samples carry, latest first: `items`, `gap_days` (capped, see `clamp_gap`) and one list per attribute.

    A list is as long as the state keeps items of a user.
    """
    gap = F.least(F.greatest(F.datediff(as_of, F.col(time)), F.lit(0)), F.lit(GAP_LIMIT))
    rows = F.array_sort(F.collect_list(F.struct("place", F.col(item).alias("items"), gap.alias("gap_days"), *attributes)))
    lists = state.groupBy(user).agg(rows.alias("__rows"))
    return lists.select(user, *[F.col(f"__rows.{c}").alias(c) for c in ("items", "gap_days", *attributes)])


# --- active days --------------------------------------------------------------------------------------

def _bit(days_ago: Column) -> Column:
    """The bitmap of one day; nothing for days out of its range."""
    return F.when((days_ago >= 0) & (days_ago < BITMAP_DAYS), F.call_function("shiftleft", F.lit(1).cast("long"), days_ago.cast("int"))
                  ).otherwise(F.lit(0).cast("long"))


def day_bitmaps(events: DataFrame, user: str, day: str, as_of: int) -> DataFrame:
    """Per user, `bits`: bit i is set if the user was active i days before `as_of`; only the last 63 days count."""
    seen = events.where(F.col(user).isNotNull() & (F.col(day) <= as_of) & (F.col(day) > as_of - BITMAP_DAYS))
    return seen.groupBy(user).agg(F.bit_or(_bit(F.lit(as_of) - F.col(day))).alias("bits"))


def advanced_bitmaps(state: DataFrame, events: DataFrame, user: str, day: str, days: int, as_of: int) -> DataFrame:
    """The bitmaps `days` after those of `state`, now as of `as_of`, with the events since; users without a day left go."""
    kept = F.lit((1 << BITMAP_DAYS) - 1)
    moved = F.call_function("shiftleft", F.col("bits"), F.lit(days)).bitwiseAND(kept) if days < BITMAP_DAYS else F.lit(0).cast("long")
    older = state.select(user, moved.alias("bits"))
    both = older.unionByName(day_bitmaps(events, user, day, as_of))
    return both.groupBy(user).agg(F.bit_or("bits").alias("bits")).where("bits <> 0")


def active_days(bits: Column, window: int) -> Column:
    """How many of the last `window` days, today included, a bitmap has set."""
    if not 1 <= window <= BITMAP_DAYS:
        raise ValueError(f"a bitmap holds {BITMAP_DAYS} days")
    return F.bit_count(bits.bitwiseAND(F.lit((1 << window) - 1)))


# --- rates ----------------------------------------------------------------------------------------------

def cumulative_counts(events: DataFrame, keys: Sequence[str], step: str, counts: Mapping[str, Column]) -> DataFrame:
    """Per key and step, what `counts` (0 or 1 per event) add up to until the end of the step.

    Counted per key and step before the running sum, whose groups hold a row per step only.
    """
    daily = events.where(F.col(step).isNotNull()).groupBy(*keys, step).agg(*[F.sum(c).alias(n) for n, c in counts.items()])
    so_far = Window.partitionBy(*keys).orderBy(step).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return daily.withColumns({n: F.sum(n).over(so_far) for n in counts})


def rate(part: Column, whole: Column) -> Column:
    """part / whole; 0 without a whole."""
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))
