"""Hash buckets and identity buckets."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def md5_number(col: Column) -> Column:
    """The first 60 bits of the md5 of a string, as a non-negative bigint."""
    return F.conv(F.substring(F.md5(col.cast("string")), 1, 15), 16, 10).cast("bigint")


def hash_bucket(col: Column, buckets: int, method: str = "xxhash64") -> Column:
    """Bucket 0..buckets-1 of a string or integer; integers hash by their decimal text.  Null stays null.

    `xxhash64` is the fast one, `md5` the one other engines can repeat.
    """
    text = col.cast("string")
    if method == "xxhash64":
        bucket = F.pmod(F.xxhash64(text), F.lit(buckets).cast("bigint"))
    elif method == "md5":
        bucket = F.pmod(md5_number(text), F.lit(buckets).cast("bigint"))
    else:
        raise ValueError(f"unknown hash method {method!r}")
    return F.when(text.isNotNull(), bucket)


def hash_bucket_list(col: Column, buckets: int, method: str = "xxhash64") -> Column:
    """Buckets of a list's items."""
    return F.transform(col, lambda x: hash_bucket(x, buckets, method))


def identity_bucket(col: Column, buckets: int, default: int | None = None) -> Column:
    """The value itself as id.  Out of range: `default` when given, else an error."""
    inside = col.between(0, buckets - 1)
    if default is not None:
        return F.when(inside, col).otherwise(F.lit(default)).cast("bigint")
    message = F.concat(F.lit("id out of range: "), F.coalesce(col.cast("string"), F.lit("null")))
    return F.when(inside, col).otherwise(F.raise_error(message).cast("bigint")).cast("bigint")


def keep_share(key: Column, frac: float, seed: int) -> Column:
    """True for a fixed `frac` of keys, the same whatever the partitioning."""
    return md5_number(F.concat(F.lit(f"{seed}:"), key.cast("string"))) < F.lit(round(frac * (1 << 60)))
