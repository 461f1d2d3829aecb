"""SimHash near-duplicates: fingerprints of word shingles, compared bit-sliced inside blocks that share some bits."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankflow.llm.common import appended, fresh
from rankflow.llm.components import connected_components
from rankflow.session import written

BITS = 64
# Shingles counted at once, so that a very long text takes no more memory than a short one.
SLICE = 1 << 15
# Fingerprints of one block that are compared in one piece; larger blocks are compared chunk by chunk.
BLOCK = 1024
# Average block size from which more, narrower tables are used.
CROWDED = 4096
# (fingerprint, word of 64 lanes) pairs compared in one numpy step.
PAIRS = 1 << 18
ALL = np.uint64(0xFFFFFFFFFFFFFFFF)


def fingerprint(text: str | None, words: int = 4, seed: int = 42, distinct: bool = False) -> int:
    """The 64-bit SimHash of a whole text; 0 without words.

    A-Z are lower-cased, words are runs without ASCII white space, shingles are `words` words joined by one space (all
    words, if there are fewer), repeats included unless `distinct`; a bit is 1 if it is set in over half the shingles' XXH64 values.
    """
    parts = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not parts:
        return 0
    joined = b" ".join(parts)
    n = max(len(parts) - words + 1, 1)
    ends = np.cumsum([len(p) + 1 for p in parts])
    starts = np.concatenate(([0], ends[:-1]))[:n]
    stops = ends[min(words, len(parts)) - 1:] - 1
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(BITS, np.int64)
    seen: set[int] = set()
    for i in range(0, n, SLICE):
        values = [digest(joined[a:b], seed) for a, b in zip(starts[i:i + SLICE].tolist(), stops[i:i + SLICE].tolist())]
        if distinct:
            values = list(set(values) - seen)
            seen.update(values)
        hashes = np.array(values, dtype="<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    n = len(seen) if distinct else n
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def with_fingerprint(docs: DataFrame, words: int = 4, seed: int = 42, name: str = "fingerprint") -> DataFrame:
    """`docs` with the fingerprint of each text as a long (the same 64 bits, signed).  Nothing is shuffled."""
    def make():
        def fn(texts: pa.Array):
            values = np.array([fingerprint(t.as_py(), words, seed) for t in texts], dtype=np.uint64)
            return [pa.array(values.view(np.int64), pa.int64())]
        return fn
    return appended(docs, ["text"], [(name, "long")], make)


def block_masks(n: int, radius: int, crowded: int = CROWDED) -> list[int]:
    """Bit masks such that any two fingerprints within `radius` agree under one of them.

    The 64 bits are cut into radius + k pieces; two fingerprints that differ in at most `radius` bits agree in k whole
    pieces, so every choice of k pieces gives a mask.  k grows until a block holds `crowded` fingerprints on average at
    most.  The result is complete for every k; only the work differs.
    """
    for k in range(1, BITS - radius + 1):
        pieces = radius + k
        if n <= crowded * 2 ** (BITS * k / pieces) or k == 4:
            break
    edges = [round(i * BITS / pieces) for i in range(pieces + 1)]
    part = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edges, edges[1:])]
    return [sum(part[i] for i in chosen) for chosen in combinations(range(pieces), k)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _exceeds(counter: list[np.ndarray], over: np.ndarray, radius: int) -> np.ndarray:
    """Lanes whose bit-sliced count is above `radius`, or has overflowed."""
    above, equal = over, ~over
    for i in reversed(range(len(counter))):
        if radius >> i & 1:
            equal = equal & counter[i]
        else:
            above = above | (equal & counter[i])
            equal = equal & ~counter[i]
    return above


def close_pairs(fps: np.ndarray, run: np.ndarray, side: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of positions in the same run whose fingerprints differ in at most `radius` bits.

    `run` is sorted.  Within a run whose rows are all of side 0, all pairs are compared, otherwise only pairs of side 0
    with side 1.  Bits are stored vertically: bit b of 64 neighbouring fingerprints is one word.  A fingerprint is
    compared with such a word by 64 xors whose results a carry-save counter adds up in all 64 lanes at once, and the word is
    abandoned as soon as all its lanes exceed the radius.
    """
    n = len(fps)
    if not n:
        return
    starts = np.flatnonzero(np.r_[True, run[1:] != run[:-1]])
    sizes = np.diff(np.r_[starts, n])
    words = -(-sizes // 64)
    first_word = np.r_[0, np.cumsum(words)[:-1]]
    which = np.repeat(np.arange(len(starts)), sizes)
    place = np.arange(n) - starts[which]
    lane = first_word[which] * 64 + place
    total = int(words.sum())
    held = np.full(total * 64, -1, np.int64)
    held[lane] = np.arange(n)
    laid = np.zeros(total * 64, np.uint64)
    laid[lane] = fps
    valid = np.packbits(held >= 0, bitorder="little").view("<u8")
    right = np.packbits((held >= 0) & (side[held] == 1), bitorder="little").view("<u8")
    bits = np.unpackbits(laid.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    planes = np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little").view("<u8")
    mixed = np.zeros(len(starts), bool)
    np.logical_or.at(mixed, which, side == 1)
    # in a one-sided run a fingerprint meets the words from its own on
    from_word = np.where(mixed[which], first_word[which], lane // 64)
    count = first_word[which] + words[which] - from_word
    count[mixed[which] & (side == 1)] = 0
    digits = max(radius.bit_length(), 1)
    begin = 0
    ends = np.cumsum(count)
    while begin < n:
        stop = max(begin + 1, int(np.searchsorted(ends, (ends[begin - 1] if begin else 0) + PAIRS, side="right")))
        c = count[begin:stop]
        query = np.repeat(np.arange(begin, stop), c)
        word = from_word[query] + np.arange(len(query)) - np.repeat(np.cumsum(c) - c, c)
        counter = [np.zeros(len(query), np.uint64) for _ in range(digits)]
        over = np.zeros(len(query), np.uint64)
        for b in range(BITS):
            carry = planes[b][word] ^ (np.uint64(0) - ((fps[query] >> np.uint64(b)) & np.uint64(1)))
            for i in range(digits):
                counter[i], carry = counter[i] ^ carry, counter[i] & carry
            over |= carry
            if b % 8 == 7:
                keep = np.flatnonzero((_exceeds(counter, over, radius) & valid[word]) != valid[word])
                if len(keep) < len(query):
                    query, word, over = query[keep], word[keep], over[keep]
                    counter = [x[keep] for x in counter]
                    if not len(query):
                        break
        if len(query):
            close = ~_exceeds(counter, over, radius) & np.where(mixed[which[query]], right[word], valid[word])
            hit = np.unpackbits(close.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            row, bit = np.nonzero(hit)
            a, b = query[row], held[word[row] * 64 + bit]
            ordered = mixed[which[a]] | (a < b)
            yield a[ordered], b[ordered]
        begin = stop


def _forest(n: int, pairs: Iterator[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """For each position the smallest position linked to it, from pairs that come in pieces."""
    root = np.arange(n)
    for a, b in pairs:
        while True:
            low = np.minimum(root[a], root[b])
            before = root.copy()
            np.minimum.at(root, root[a], low)
            np.minimum.at(root, root[b], low)
            root = root[root]
            if np.array_equal(before, root):
                break
    while not np.array_equal(root, root[root]):
        root = root[root]
    return root


def _blocks(prints: DataFrame, masks: list[int], block: int) -> DataFrame:
    """Rows (t, key, i, j, side, fp, node): the chunks of every block that are compared with one another.

    A block of up to `block` fingerprints is one chunk.  A larger one is dealt into chunks by a hash, and each pair of chunks is
    compared in a group of its own, so that no task holds the whole block and no pair is lost.
    """
    tables = F.array(*[F.struct(F.lit(t).alias("t"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("key"))
                       for t, m in enumerate(masks)])
    rows = prints.select("fp", "node", F.explode(tables).alias("k")).select("fp", "node", "k.t", "k.key")
    # blocks to split; Spark broadcasts their table only if its written size allows
    large = written(rows.groupBy("t", "key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > block)
                    .select("t", "key", F.ceil(F.col("n") / block).cast("int").alias("chunks")), "large_blocks")
    rows = rows.join(large, ["t", "key"], "left")
    chunk = F.pmod(F.xxhash64("fp", "t"), F.col("chunks")).cast("int")
    rows = rows.withColumn("c", F.when(F.col("chunks").isNull(), 0).otherwise(chunk))
    other = F.explode(F.sequence(F.lit(0), F.coalesce(F.col("chunks"), F.lit(1)) - 1))
    rows = rows.withColumn("d", other)
    return rows.select("t", "key", F.least("c", "d").alias("i"), F.greatest("c", "d").alias("j"),
                       (F.col("c") > F.col("d")).cast("int").alias("side"), "fp", "node")


def _in_runs(blocks: DataFrame, found, schema: str) -> DataFrame:
    """Runs `found(fps, run, rows)`, which gives pieces of arrays, over whole groups of blocks, a batch of rows at a time."""
    group = ["t", "key", "i", "j"]
    dealt = blocks.repartition(int(blocks.sparkSession.conf.get("spark.sql.shuffle.partitions")), *group)
    names = [c.split()[0] for c in schema.split(", ")]

    def work(tab: pa.Table) -> Iterator[pa.RecordBatch]:
        fps = tab["fp"].to_numpy().view(np.uint64)
        keys = [tab[c].to_numpy() for c in group]
        change = np.zeros(len(fps), bool)
        for k in keys:
            change[1:] |= k[1:] != k[:-1]
        for out in found(fps, np.cumsum(change), tab):
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in out], names=names)

    def run_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.RecordBatch] = []  # the last group may go on in the next batch
        for batch in batches:
            if not batch.num_rows:
                continue
            waiting.append(batch)
            whole = pa.Table.from_batches(waiting).combine_chunks()
            same = np.ones(len(whole), bool)
            for c in group:
                v = whole[c].to_numpy()
                same &= v == v[-1]
            cut = int(np.flatnonzero(~same)[-1]) + 1 if not same.all() else 0
            if cut:
                yield from work(whole.slice(0, cut))
                waiting = whole.slice(cut).to_batches()
        if waiting:
            yield from work(pa.Table.from_batches(waiting).combine_chunks())

    return dealt.sortWithinPartitions(*group).mapInArrow(run_task, schema)


def _edges(blocks: DataFrame, radius: int) -> DataFrame:
    """A spanning forest of the links in each group of a block, as (a, b) of nodes."""
    def forest(fps, run, rows):
        node = rows["node"].to_numpy()
        root = _forest(len(fps), close_pairs(fps, run, rows["side"].to_numpy(), radius))
        leaf = np.flatnonzero(root != np.arange(len(root)))
        yield node[leaf], node[root[leaf]]

    return _in_runs(blocks, forest, "a long, b long")


def simhash_components(docs: DataFrame, words: int = 4, radius: int = 4, seed: int = 42, block: int = BLOCK,
                       crowded: int = CROWDED) -> DataFrame:
    """(doc_id, fingerprint, component_id) per row of `docs`; near copies share a component, named after its smallest doc_id.

    Fingerprints link at `radius` or fewer differing bits.  Equal fingerprints (copies, and all texts without words) are one
    node however many rows share them; distinct ones meet in every block whose bits they share, and no link is lost.  A null
    text counts as empty.  A row with a null doc_id takes part in no link and has a null component.  Repeated ids count
    as one document per fingerprint; links go through both.
    """
    fp = written(with_fingerprint(docs.select("doc_id", "text"), words, seed, "fp").select("doc_id", "fp"), "fingerprints")
    prints = fp.where("doc_id IS NOT NULL").groupBy("fp").agg(F.min("doc_id").alias("node"))
    # rows that share an id tie their fingerprints together
    same_id = (fp.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.min("fp").alias("lo"), F.max("fp").alias("hi"),
               F.count_distinct("fp").alias("n")).where("n > 1").select("doc_id"))
    prints = written(prints, "prints")
    tied = (fp.join(same_id, "doc_id").join(prints, "fp").select(F.col("doc_id").alias("a"), F.col("node").alias("b")))
    masks = block_masks(prints.count(), radius, crowded)
    near = _edges(_blocks(prints, masks, block), radius)
    found = connected_components(near.union(tied))
    nodes = (prints.join(found, prints["node"] == found["node"], "left")
             .select("fp", F.coalesce(found["component"], prints["node"]).alias("component_id")))
    return (fp.join(nodes, "fp", "left")
            .select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
                    F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id")))


def drop_near_copies(docs: DataFrame, **options) -> DataFrame:
    """The rows of `docs` whose doc_id is the smallest of its component in `simhash_components`; rows without an id stay.

    Of rows that repeat a kept id, all stay: they are the same document.  All columns pass through; `options` are those of
    `simhash_components`.
    """
    name = fresh("__lead", docs.columns)
    leads = simhash_components(docs, **options).where("doc_id = component_id").select(F.col("doc_id").alias(name)).distinct()
    return docs.join(leads, docs["doc_id"] == leads[name], "left_semi").union(docs.where(docs["doc_id"].isNull()))
