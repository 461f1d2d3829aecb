"""Small helpers the operators share."""

from __future__ import annotations

import ctypes
from collections.abc import Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(name: str, columns: Sequence[str]) -> str:
    """`name`, with underscores before it until no column is called so (names are compared as Spark does, without case)."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def crc_remainder(id_col: str | Column, modulus: int) -> Column:
    """crc32 of the id's decimal text, modulo `modulus`; null for a null id."""
    col = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.crc32(col.cast("string").cast("binary")) % modulus


def held_out(id_col: str | Column, modulus: int, remainder: int) -> Column:
    """True for ids that no model may learn from; a null id is never held out."""
    return F.coalesce(crc_remainder(id_col, modulus) == remainder, F.lit(False))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, modulus: int, remainder: int, rows: int,
                    id_col: str = "doc_id") -> DataFrame:
    """At most `rows` labelled documents that are not held out, chosen by a hash of their id, as (id, text, label).

    Only ids pass through the driver, and never more than `rows` of them.  A document with several label rows counts as
    positive if one of them is.
    """
    usable = (labels.where(F.col(label).isNotNull() & F.col(id_col).isNotNull() & ~held_out(id_col, modulus, remainder))
              .groupBy(id_col).agg(F.max(label).cast("int").alias("label")))
    chosen = usable.orderBy(F.xxhash64(id_col), id_col).limit(rows).collect()
    spark = docs.sparkSession
    ids = spark.createDataFrame([(r[0], r[1]) for r in chosen], "id long, label int")
    return docs.select(F.col(id_col).alias("id"), "text").join(F.broadcast(ids), "id")


def by_bytes(values: Iterable[bytes], limit: int) -> Iterator[tuple[int, int]]:
    """Ranges (start, end) of consecutive values that hold `limit` bytes at most; a longer value stands alone."""
    start = size = i = 0
    for i, v in enumerate(values):
        if size and size + len(v) > limit:
            yield start, i
            start, size = i, 0
        size += len(v)
    if size or start <= i:
        yield start, i + 1


def give_back() -> None:
    """Returns a worker's free memory to the system, Arrow's and that of the C library where it can; workers live on between tasks."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def appended(df: DataFrame, inputs: Sequence[str], outputs: Sequence[tuple[str, str]], make) -> DataFrame:
    """`df` with more columns that a function of Arrow arrays makes, batch by batch.

    `make()` is called once per task and returns a function of the input arrays that gives one array per output.  All
    columns of `df` pass through; an output whose name `df` has already replaces it.
    """
    names = [n for n, _ in outputs]
    lower = {n.lower() for n in names}
    kept = [f for f in df.schema.fields if f.name.lower() not in lower]
    kept_names = [f.name for f in kept]
    source = df.select(*[F.col(f"`{n}`") for n in kept_names],
                       F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(inputs)]).alias(
                           inner := fresh("__in", kept_names + names)))
    from pyspark.sql.types import StructField, StructType, _parse_datatype_string
    schema = StructType(kept + [StructField(n, _parse_datatype_string(t)) for n, t in outputs])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fn = None
        give_back()  # what the worker's earlier tasks left
        for batch in batches:
            if fn is None:
                fn = make()
            made = fn(*batch.column(batch.schema.get_field_index(inner)).flatten())
            yield pa.RecordBatch.from_arrays([batch.column(i) for i in range(len(kept_names))] + list(made),
                                             names=kept_names + names)

    return source.mapInArrow(run, schema)
