"""Registered queries and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rankflow.plans.views import SAMPLES_SQL, SCORE_COLUMNS

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

# Building blocks of the SQL twins.
_ACCIDENT = ("coalesce(mtime_gap >= 0 AND mtime_gap < 60 AND ctr_label = 0 AND cvr_label = 0 "
             "AND unlock_label = 0 AND play_ratio < 0.1, false)")
NEGATIVE_SQL = ("coalesce(ctr_label = 0 AND cvr_label = 0 AND finish_view_label = 0 AND unlock_label = 0 "
                "AND play_ratio < 0.1, false)")


def md5_sql(text: str) -> str:
    return f"cast(concat('0x', substr(md5({text}), 1, 15)) AS BIGINT)"


_CTES = {
    "samples": SAMPLES_SQL,
    "cleaned": f"SELECT * FROM samples WHERE NOT {_ACCIDENT}",
    "labelled": """SELECT * EXCLUDE (book_pos),
        CASE WHEN coalesce(play_ratio > 0.9, false) THEN 1 ELSE 0 END AS finish_view_label,
        coalesce(try_cast(nullif(trim(vip_type), '') AS INT), 0) AS vip_label,
        least(coalesce(book_pos, 60), 60) AS book_pos,
        CASE WHEN length(reqtime) >= 13 THEN coalesce(try_cast(substr(reqtime, 12, 2) AS INT), -1) ELSE -1 END AS hour,
        '0' AS gap_day FROM cleaned""",
    "sampled": f"""SELECT * FROM labelled WHERE NOT {NEGATIVE_SQL}
        OR {md5_sql("concat('42:', cast(sample_id AS VARCHAR))")} < 576460752303423488""",
    "raw_scored": "SELECT *, " + ", ".join(f"{e} AS {n}" for n, e in SCORE_COLUMNS.items()) + " FROM labelled",
    "scored": """SELECT *, ctr * pos AS ctr_debiased, CASE WHEN vip_label > 0 THEN 0.0 ELSE 1.0 END AS non_member,
        ctr * pos * fvtr AS ctfvtr, ctr * pos * unlock AS ctunlock, ctr * pos * cvr AS ctcvr FROM raw_scored""",
}


def on(view: str, sql: str, **more: str) -> str:
    """SQL over one of the views above, with the views it builds on and any `more`."""
    names = list(_CTES)
    ctes = [f"{n} AS ({_CTES[n]})" for n in names[: names.index(view) + 1]]
    ctes += [f"{n} AS ({s})" for n, s in more.items()]
    return "WITH " + ",\n".join(ctes) + "\n" + sql


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return add


def digest(vec: Column) -> Column:
    """One number that every element of a vector enters with its own weight."""
    weighted = F.transform(vec, lambda x, i: x * (i + 1))
    # adding 0.0 turns a rounded -0.0 into 0.0
    return F.round(F.aggregate(weighted, F.lit(0.0), lambda s, x: s + x), 6) + F.lit(0.0)


def digest_sql(vec: str) -> str:
    return f"round(list_sum(list_transform({vec}, lambda x, i: x * i)), 6) + 0.0::DOUBLE"
