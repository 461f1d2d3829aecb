"""Repeated passages across documents, found by suffix sorting with a difference cover.

Equal strings of `length` bytes always meet: each is filed under the smallest hash of the shorter grams it holds, so the text
falls into runs of neighbouring strings under one key.  Keys that only one document has are settled by that; the runs of the
others are brought together by key, and their suffixes sorted by the difference-cover algorithm: triples at two of three positions
are named in sorted order, the string of names is sorted the same way, the remaining suffixes are merged in, and neighbours
whose prefixes agree are the same string.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from rankflow.llm.common import by_bytes, give_back
from rankflow.session import written

LENGTH = 50
GRAM = 16
# Bytes hashed at once, and bytes of texts that are worked on together; a longer text stands alone.
SLICE = 1 << 16
TEXTS = 4 << 20
# Documents of such a slice; their numbers in it take two bytes.
TEXT_ROWS = 1 << 16
# Runs that one hash bucket holds on average, and the least number of buckets.
BUCKET_RUNS = 1_000_000
LEAST_BUCKETS = 64
# Bytes whose suffixes are sorted together, and distinct pieces of one key beyond which its strings are dealt out one by one.
BLOCK = 1 << 18
CROWD = 16_384
# Intervals that a task collects before it sends them by document.
SPANS = 1 << 19
# Bits of a least gram's hash that travel as the key of a run, and of those of the grams beside it.  Strings of equal keys are compared, so a
# chance match costs work only.
KEY_BITS, SIDE_BITS = 48, 16
# A run: its key, where its first string starts, how many strings it holds, the hashes beside its gram.
_RUN = np.dtype([("key", "<u8"), ("first", "<i4"), ("count", "u1"), ("before", "<u2"), ("after", "<u2")])
_MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)]
_CODES = np.random.default_rng(2024).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _powers() -> list[np.uint64]:
    out, x = [], int(_MIX[0])
    for _ in range(4):
        out.append(np.uint64(x))
        x = x * x % (1 << 64)
    return out


_POWERS = _powers()


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """A hash of every 16-byte gram."""
    h = _CODES[data]
    for i, p in enumerate(_POWERS):
        s = 1 << i
        h = h[:-s] * p + h[s:]
    h ^= h >> np.uint64(29)
    h *= _MIX[1]
    h ^= h >> np.uint64(32)
    return h


def least_places(h: np.ndarray, width: int) -> np.ndarray:
    """For every `width` neighbouring hashes the place of the smallest, the first one of equal ones."""
    place, reach = np.arange(len(h)), 1

    def halves(step: int) -> None:
        nonlocal h, place
        later = h[step:] < h[:-step]
        h = np.where(later, h[step:], h[:-step])
        place = np.where(later, place[step:], place[:-step])

    while reach * 2 <= width:
        halves(reach)
        reach *= 2
    if reach < width:
        halves(width - reach)
    return place


def runs(raw: bytes, length: int = LENGTH) -> np.ndarray:
    """Runs of neighbouring strings of `length` bytes with the same least gram, as _RUN.

    Equal strings hold their least gram at the same place.  Either the 16 bytes before that gram or those after it lie in the string as well, so
    of two equal strings' runs not only the keys agree but also one of the hashes beside the gram (0: the text ends before).  Works slice by
    slice, so that a long text takes little memory.
    """
    data = np.frombuffer(raw, np.uint8)
    n = len(data) - length + 1
    width = length - GRAM + 1
    found = []
    for a in range(0, n, SLICE):
        b, low = min(a + SLICE, n), max(a - GRAM, 0)
        h = gram_hashes(data[low:b + length - 1 + 2 * GRAM])
        place = least_places(h[a - low:b - low + width - 1], width)
        first = np.flatnonzero(np.r_[True, place[1:] != place[:-1]])
        gram = place[first] + (a - low)
        # the least of many hashes is small; mixed, keys spread over all buckets
        key = (h[gram] * _MIX[2]) >> np.uint64(64 - KEY_BITS)
        side = np.zeros(len(h) + 2 * GRAM, np.uint16)
        side[GRAM:-GRAM] = (h >> np.uint64(20)).astype(np.uint16) | np.uint16(1)
        out = np.empty(len(first), _RUN)
        out["key"], out["first"], out["count"] = key, first + a, np.diff(np.r_[first, len(place)])
        out["before"], out["after"] = side[gram], side[gram + 2 * GRAM]
        found.append(out)
    return np.concatenate(found) if found else np.empty(0, _RUN)


def _met(key: np.ndarray, side: np.ndarray, who: np.ndarray, told: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(shared, head) per run: whether its key and side occur with several owners, or with one that is `told` to; and whether it is the first such."""
    both = key << np.uint64(SIDE_BITS) | side
    order = np.argsort(both, kind="stable")
    sorted_both, sorted_who = both[order], who[order]
    heads = np.flatnonzero(np.r_[True, sorted_both[1:] != sorted_both[:-1]])
    found = np.minimum.reduceat(sorted_who, heads) < np.maximum.reduceat(sorted_who, heads)
    if told is not None:
        found |= np.maximum.reduceat(told[order], heads)
    shared, head = np.empty(len(both), bool), np.zeros(len(both), bool)
    shared[order] = np.repeat(found, np.diff(np.r_[heads, len(both)]))
    head[order[heads]] = True
    return shared, head


def _order(key: np.ndarray) -> np.ndarray:
    """The places of keys in their order; narrow ones are sorted with their places, which is several times faster."""
    bits = len(key).bit_length()
    if int(key.max()) >> (62 - bits):
        return np.argsort(key)
    return np.sort(key << bits | np.arange(len(key))) & ((1 << bits) - 1)


def _smaller(keys: np.ndarray, than: np.ndarray) -> np.ndarray:
    """How many keys are smaller than each of `than`, in ascending order."""
    marked = np.sort(np.concatenate([keys << 1 | 1, than << 1]))
    return np.flatnonzero(marked & 1 == 0) - np.arange(len(than))


def suffix_order(s: np.ndarray, depth: int = LENGTH, cover: int = 1) -> np.ndarray:
    """Positions of `s` in the order of their suffixes, compared over `depth` bytes at least (each sign stands for `cover`).

    Difference cover modulo 3.  Recursion ends when the names are unique or reach `depth`.
    """
    n = len(s)
    if n < 3:
        return np.array(sorted(range(n), key=lambda i: s[i:].tolist()), np.int64)
    if int(s.max()) >= 1 << 20:
        s = np.unique(s, return_inverse=True)[1] + 1
    padded = np.zeros(n + 3, np.int64)
    padded[:n] = s
    base = int(padded.max()) + 1
    # a position past the end closes the string of names where it would run on into the other residue
    ones, twos = np.arange(1, n + (n % 3 == 1), 3), np.arange(2, n, 3)
    sampled = np.concatenate([ones, twos])
    triple = (padded[sampled] * base + padded[np.minimum(sampled + 1, n + 2)]) * base + padded[np.minimum(sampled + 2, n + 2)]
    by_triple = _order(triple)
    ordered = triple[by_triple]
    fresh_name = np.r_[True, ordered[1:] != ordered[:-1]]
    if fresh_name.all() or 3 * cover >= depth:
        order = by_triple
    else:
        names = np.empty(len(sampled), np.int64)
        names[by_triple] = np.cumsum(fresh_name)
        order = suffix_order(names, depth, 3 * cover)
    rank = np.zeros(n + 4, np.int64)
    rank[sampled[order]] = np.arange(1, len(sampled) + 1)
    most = len(sampled) + 1
    rest = np.arange(0, n, 3)
    one = padded[rest] * most + rank[rest + 1]
    rest_order = _order(one)
    rest, one = rest[rest_order], one[rest_order]
    two = (padded[rest] * base + padded[rest + 1]) * most + rank[rest + 2]
    ones = ones[ones < n]
    # both ascend with `rest`, but for suffixes that agree in `depth` bytes, whose order is open
    before = (_smaller(padded[ones] * most + rank[ones + 1], one)
              + _smaller((padded[twos] * base + padded[twos + 1]) * most + rank[twos + 2], two))
    inside = sampled[order]
    out, merged = np.empty(n, np.int64), np.zeros(n, bool)
    place = before + np.arange(len(rest))
    out[place], merged[place] = rest, True
    out[~merged] = inside[inside < n]
    return out


def string_minima(pieces: pa.BinaryArray, owners: np.ndarray, length: int = LENGTH) -> np.ndarray:
    """The smallest owner of each string of `length` bytes over all pieces; the strings of one piece after those of the other."""
    sizes = pc.binary_length(pieces).to_numpy().astype(np.int64)
    data = np.frombuffer(b"".join(pieces.to_pylist()) + bytes(length + 8), np.uint8)
    counts = sizes - length + 1
    start = _ranges(np.cumsum(sizes) - sizes, counts)
    which = np.full(len(data), -1, np.int64)
    which[start] = np.arange(len(start))
    order = which[suffix_order(data.astype(np.int64) + 1, length)]
    order = order[order >= 0]
    at = start[order]
    words = np.ndarray(len(data) - 7, "<u8", buffer=data.tobytes(), strides=(1,))
    same = np.ones(max(len(at) - 1, 0), bool)
    for o in sorted({*range(0, length - 7, 8), length - 8}):
        w = words[at + o]
        same &= w[1:] == w[:-1]
    heads = np.flatnonzero(np.r_[True, ~same])
    least = np.minimum.reduceat(np.repeat(owners, counts)[order], heads)
    out = np.empty(len(start), np.int64)
    out[order] = np.repeat(least, np.diff(np.r_[heads, len(order)]))
    return out


def _ranges(begins: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """begin, begin + 1, ... of each count, one after the other."""
    return np.repeat(begins - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())


def _intervals(flags: np.ndarray) -> np.ndarray:
    """Starts and ends of the runs of true flags, in rows."""
    return np.flatnonzero(np.diff(np.r_[False, flags, False].astype(np.int8))).reshape(-1, 2)


def _text_slices(batch: pa.RecordBatch, text: pa.Array) -> Iterator[pa.RecordBatch]:
    """The batch in slices of at most TEXTS bytes of texts, or one text, and TEXT_ROWS rows."""
    sizes = pc.fill_null(pc.binary_length(text), 0).to_pylist()
    for a, b in by_bytes(map(range, sizes), TEXTS):
        for at in range(a, b, TEXT_ROWS):
            yield batch.slice(at, min(TEXT_ROWS, b - at))


def _shared_runs(keyed: DataFrame, text_of, length: int, buckets: int) -> DataFrame:
    """(doc_id, body, runs): which of a text's runs, as numbers of four bytes, have a key that occurs in several documents with the same gram
    before or after it.

    One pass over the texts.  Each slice of texts tells the buckets of its keys each pair of key and side that several of its documents share
    once; runs it knows to be shared travel beside, through any bucket.  So a key that very many documents hold sends few entries per slice.
    Runs that no other document of the slice shares are all told, those that one document repeats too.
    """
    def rows_of(ids, bodies, doc, number) -> pa.RecordBatch:
        order = np.lexsort((number, doc))
        doc = doc[order]
        heads = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]][:len(doc)])
        packed = number[order].astype("<u4")
        return pa.RecordBatch.from_arrays(
            [pa.array(ids[doc[heads]]), pa.array(bodies[doc[heads]]),
             pa.array([packed[a:b].tobytes() for a, b in zip(heads, np.r_[heads[1:], len(doc)])], pa.binary())],
            names=["doc_id", "body", "runs"])

    # narrow columns of their own, which compress better; the highest bit of `far` says that a run is known to be shared already
    kept = {"low": "<u4", "high": "<u2", "before": "<u2", "after": "<u2", "near": "<u2", "far": "<u2", "doc": "<u2", "ids": "<i8", "bodies": "<i4"}
    names = ["bucket", "known", *kept]

    def told(ids: np.ndarray, bodies: np.ndarray, texts: list) -> list[dict]:
        parts = [runs(t.encode("utf-8", "surrogatepass"), length) for t in texts]
        sizes = np.array([len(p) for p in parts])
        doc = np.repeat(np.arange(len(ids)), sizes)
        if not len(doc):
            return []
        number = np.arange(len(doc)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        found = np.concatenate(parts)
        del parts
        key, who = found["key"].copy(), ids[doc]
        by_before, by_after = (_met(key, found[side].astype(np.uint64), who) for side in ("before", "after"))
        settled = by_before[0] | by_after[0]
        # a run of one document's only is told as often as it occurs there: each occurrence may have to go
        sent = by_before[1] | by_after[1] | ~settled
        bucket = (key >> np.uint64(KEY_BITS - 32)).astype(np.int64) * buckets >> 32

        def row(place: int, known: bool, of: np.ndarray) -> dict:
            used, local = np.unique(doc[of], return_inverse=True)
            columns = {"near": number[of] & 0xFFFF, "far": number[of] >> 16 | settled[of] << 15, "doc": local, "ids": ids[used], "bodies": bodies[used]}
            if not known:
                columns |= {"low": key[of] & np.uint64(0xFFFFFFFF), "high": key[of] >> np.uint64(32), "before": found["before"][of],
                            "after": found["after"][of]}
            return {"bucket": place, "known": known, **{c: x.astype(kept[c]).tobytes() for c, x in columns.items()}}

        rows = [row(int(who[settled][0] % buckets), True, np.flatnonzero(settled))] if settled.any() else []
        order = np.flatnonzero(sent)
        order = order[np.argsort(bucket[order], kind="stable")]
        cuts = np.flatnonzero(np.r_[True, bucket[order][1:] != bucket[order][:-1]])
        return rows + [row(int(bucket[order[a]]), False, order[a:b]) for a, b in zip(cuts, np.r_[cuts[1:], len(order)])]

    def tell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_back()  # what the worker's earlier tasks left
        for batch in batches:
            for part in _text_slices(batch, text_of(batch)):
                rows = told(part.column("doc_id").to_numpy(), part.column("body").to_numpy(), text_of(part).to_pylist())
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array([r.get(c) for r in rows], k) for c, k in zip(
                        names, [pa.int32(), pa.bool_()] + [pa.binary()] * len(kept))], names=names)

    def numbers(part: dict) -> np.ndarray:
        return (part["far"] & np.uint16(0x7FFF)).astype(np.int64) << 16 | part["near"]

    def meet(tab: pa.Table) -> pa.Table:
        out = [pa.RecordBatch.from_arrays([pa.array([], pa.int64()), pa.array([], pa.int32()), pa.array([], pa.binary())], names=["doc_id", "body", "runs"])]
        for r in tab.filter(tab["known"]).to_pylist():
            part = {c: np.frombuffer(r[c], kept[c]) for c in ("near", "far", "doc", "ids", "bodies")}
            out.append(rows_of(part["ids"], part["bodies"], part["doc"], numbers(part)))
        tab = tab.filter(pc.invert(tab["known"]))
        if len(tab):
            lists = {c: [np.frombuffer(x, t) for x in tab[c].to_pylist()] for c, t in kept.items()}
            shift = np.cumsum([0] + [len(x) for x in lists["ids"]][:-1])
            doc = np.concatenate([d.astype(np.int64) + s for d, s in zip(lists.pop("doc"), shift)])
            part = {c: np.concatenate(x) for c, x in lists.items()}
            key = part.pop("high").astype(np.uint64) << np.uint64(32) | part.pop("low")
            who, settled = part["ids"][doc], part["far"] >> 15 > 0
            shared = _met(key, part.pop("before").astype(np.uint64), who, settled)[0] | _met(key, part.pop("after").astype(np.uint64), who, settled)[0]
            hit = shared & ~settled
            if hit.any():
                out.append(rows_of(part["ids"], part["bodies"], doc[hit], numbers(part)[hit]))
        return pa.Table.from_batches(out)

    rows = keyed.mapInArrow(tell, ", ".join([f"{names[0]} int", f"{names[1]} boolean", *[f"{n} binary" for n in kept]]))
    return rows.groupBy("bucket").applyInArrow(meet, "doc_id long, body int, runs binary")


class _Rows:
    """Rows of pieces as arrays: `which` piece each row holds, and the smallest document of each piece."""

    def __init__(self, batches: list[pa.RecordBatch]):
        rows = pa.Table.from_batches(batches)
        self.key, self.doc, self.body, self.first = (rows[c].to_numpy() for c in ("key", "doc_id", "body", "first"))
        self.more = pa.concat_arrays(rows["more"].chunks)
        numbered = pa.concat_arrays(rows["piece"].chunks).dictionary_encode()
        self.which, self.pieces = numbered.indices.to_numpy(), numbered.dictionary
        self.owner = np.full(len(self.pieces), np.iinfo(np.int64).max)
        np.minimum.at(self.owner, self.which, self.doc)
        self.later = self.owner[self.which] < self.doc

    def placed(self, row: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, ...]:
        """(doc_id, body, start, end) of intervals of the rows' pieces, at each place where the document holds the piece."""
        shift = self.first[row]
        again = np.flatnonzero(self.more.is_valid().to_numpy(zero_copy_only=False)[row])
        if len(again):
            places = [np.frombuffer(x, "<i4") for x in self.more.take(pa.array(row[again])).to_pylist()]
            back = np.r_[np.arange(len(row)), np.repeat(again, [len(x) for x in places])]
            shift = np.concatenate([shift, *places])
            row, start, end = row[back], start[back], end[back]
        return self.doc[row], self.body[row], start + shift, end + shift

    def settled(self, rows: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
        """The same of all strings of rows that a smaller document holds as the same piece."""
        return self.placed(rows, np.zeros(len(rows), np.int64), self.strings(length)[self.which[rows]])

    def strings(self, length: int) -> np.ndarray:
        """How many strings each piece holds."""
        return pc.binary_length(self.pieces).to_numpy().astype(np.int64) - (length - 1)


def _settle(batches: list[pa.RecordBatch], length: int) -> list[tuple[np.ndarray, ...]]:
    """(doc_id, body, start, end) of removed strings among rows of whole keys, in arrays."""
    rows = _Rows(batches)
    key = np.empty(len(rows.pieces), np.int64)
    key[rows.which] = rows.key  # equal pieces have equal keys
    _, of, count = np.unique(key, return_inverse=True, return_counts=True)
    several = count[of] > 1
    out = [rows.settled(np.flatnonzero(rows.later & ~several[rows.which]), length)]
    mixed = np.flatnonzero(several)
    if len(mixed):
        counts = rows.strings(length)[mixed]
        begins = np.cumsum(counts) - counts
        least = string_minima(rows.pieces.take(pa.array(mixed)), rows.owner[mixed], length)
        place = np.full(len(rows.pieces), -1, np.int64)
        place[mixed] = np.arange(len(mixed))
        place = place[rows.which]
        lost = np.flatnonzero((place >= 0) & (np.minimum.reduceat(least, begins)[place] < rows.doc))
        place, counts = place[lost], counts[place[lost]]
        row = np.repeat(np.arange(len(lost)), counts)
        flags = least[_ranges(begins[place], counts)] < rows.doc[lost][row]
        new = np.r_[True, row[1:] != row[:-1]][:len(row)]
        starts = np.flatnonzero(flags & (new | ~np.r_[False, flags[:-1]][:len(row)]))
        ends = np.flatnonzero(flags & np.r_[new[1:] | ~flags[1:], True][:len(row)]) + 1
        base = (np.cumsum(counts) - counts)[row[starts]]
        out.append(rows.placed(lost[row[starts]], starts - base, ends - base))
    return out


def _body() -> Column:
    """Tells rows of one id and different texts apart."""
    return F.shiftright(F.xxhash64("text"), 32).cast("int")


def _keyed(docs: DataFrame) -> DataFrame:
    """(doc_id, body, row, part): every row with its id and a hash of its text, dealt by both.

    All that follows reads this one shuffle of the texts.  Spark finds it again if every user asks for the same columns, and the partition's
    number keeps filters and joins from being moved to the other side of it.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    dealt = docs.select(F.col("doc_id").cast("long").alias("doc_id"), _body().alias("body"), row.alias("row")).repartition("doc_id", "body")
    return dealt.withColumn("part", F.spark_partition_id())


def repeated_strings(docs: DataFrame, keyed: DataFrame, length: int = LENGTH, crowd: int = CROWD, block: int = BLOCK) -> DataFrame:
    """(doc_id, body, starts): per document the starts of strings of `length` bytes that a document with a smaller id holds too.

    `keyed` are the same rows from `_keyed`.
    `body` is half of the xxhash64 of the text; `starts` are arrays of half-open intervals as pairs of longs, possibly overlapping.  Work is
    proportional to the text; suffixes are sorted in blocks of at most `block` bytes and one key.  A key with over `crowd`
    different pieces is not sorted in one task: its strings are grouped by their bytes instead.
    """
    spark = docs.sparkSession
    usable = docs.where("doc_id IS NOT NULL AND text IS NOT NULL")
    total = usable.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(LEAST_BUCKETS, -(-total // (18 * BUCKET_RUNS)))
    # later copies of a text go whole; only its first document is looked at piece by piece
    texts = usable.select(F.col("doc_id").cast("long").alias("doc_id"), _body().alias("body"), F.octet_length("text").alias("n"),
                          F.sha2("text", 256).alias("sha"))
    copied = written(texts.groupBy("sha").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most")).where("least < most")
                     .select("sha", "least"), "copied")
    copies = written(texts.join(copied, "sha").where("least < doc_id").select("doc_id", "body", "n").distinct(), "copies")
    first = keyed.where("doc_id IS NOT NULL AND row.text IS NOT NULL").join(copies.select("doc_id", "body"), ["doc_id", "body"], "left_anti")

    def text_of(batch: pa.RecordBatch) -> pa.Array:
        return batch.column("row").field("text")

    shared = (_shared_runs(first, text_of, length, buckets).groupBy("doc_id", "body").agg(F.collect_list("runs").alias("runs")))
    with_text = first.join(shared, ["doc_id", "body"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Pieces of text (kind 0) by key; of equal pieces in a slice only the smallest document's, the others are settled (1).

        A piece that its document repeats goes once, with the places behind the first as numbers of four bytes in `more`.
        """
        give_back()
        for batch in (p for b in batches for p in _text_slices(b, text_of(b))):
            ids, bodies = batch.column("doc_id").to_numpy(), batch.column("body").to_numpy()
            number: dict[bytes, int] = {}  # equal pieces have equal keys
            found, which = [], []
            for text, lists in zip(text_of(batch).to_pylist(), batch.column("runs").to_pylist(), strict=True):
                raw = text.encode("utf-8", "surrogatepass")
                at = runs(raw, length)[np.unique(np.concatenate([np.frombuffer(x, "<u4") for x in lists]))]
                found.append(at)
                which.append(np.array([number.setdefault(raw[a:a + c], len(number)) for a, c in zip(
                    at["first"].tolist(), (at["count"].astype(np.int64) + (length - 1)).tolist())], np.int64))
            doc = np.repeat(np.arange(len(ids)), [len(f) for f in found])
            at, which = np.concatenate(found), np.concatenate(which)
            owner = np.full(len(number), np.iinfo(np.int64).max)
            np.minimum.at(owner, which, ids[doc])
            goes = owner[which] < ids[doc]
            pieces = list(number)
            sent = np.flatnonzero(~goes)
            pair = doc[sent] * len(number) + which[sent]
            order = np.argsort(pair, kind="stable")
            sent, pair = sent[order], pair[order]
            places = at["first"][sent]
            heads = np.flatnonzero(np.r_[True, pair[1:] != pair[:-1]][:len(sent)])
            ends = np.r_[heads[1:], len(sent)]
            more = [None] * len(heads)
            for i in np.flatnonzero(ends - heads > 1).tolist():
                more[i] = places[heads[i] + 1:ends[i]].tobytes()
            sent = sent[heads]
            gone = np.flatnonzero(goes)  # in the order of the documents
            spans = np.stack([at["first"][gone], at["first"][gone] + at["count"][gone]], 1).astype("<i4")
            heads = np.flatnonzero(np.r_[True, doc[gone][1:] != doc[gone][:-1]][:len(gone)])
            lost = doc[gone][heads]
            columns = [
                pa.array(np.repeat([0, 1], [len(sent), len(lost)]).astype(np.int32)),
                pa.array(np.r_[at["key"][sent].astype(np.int64), bodies[lost].astype(np.int64)]), pa.array(np.r_[ids[doc[sent]], ids[lost]]),
                pa.array(np.r_[bodies[doc[sent]], bodies[lost]]), pa.array(np.r_[at["first"][sent].astype(np.int64), np.zeros(len(lost), np.int64)]),
                pa.array([pieces[i] for i in which[sent].tolist()] + [spans[a:b].tobytes() for a, b in zip(heads, np.r_[heads[1:], len(gone)])],
                         pa.binary()),
                pa.array(more + [None] * len(lost), pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["kind", "key", "doc_id", "body", "first", "piece", "more"])

    pieces = with_text.select("doc_id", "body", "row", "runs", "part").mapInArrow(
        cut, "kind int, key long, doc_id long, body int, first long, piece binary, more binary")
    dealt = (pieces.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "kind", "key")
             .sortWithinPartitions("kind", "key"))

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_back()
        names = ["kind", "doc_id", "body", "first", "piece", "more"]
        ready: list[pa.RecordBatch] = []  # whole keys
        current: list[pa.RecordBatch] = []  # rows of the key that is being read
        ready_bytes = current_rows = 0
        last, crowded, limit = None, False, crowd
        found: list[tuple[np.ndarray, ...]] = []

        def packed() -> pa.RecordBatch:
            """All that was found, one row per document."""
            doc, body, start, end = (np.concatenate(x) for x in zip(*found))
            order = np.lexsort((body, doc))
            doc, body = doc[order], body[order]
            heads = np.flatnonzero(np.r_[True, (doc[1:] != doc[:-1]) | (body[1:] != body[:-1])][:len(doc)])
            spans = np.stack([start[order], end[order]], 1).astype("<i4")
            spans = [spans[a:b].tobytes() for a, b in zip(heads.tolist(), [*heads[1:].tolist(), len(doc)])]
            none = pa.nulls(len(heads), pa.binary())
            found.clear()
            return pa.RecordBatch.from_arrays([pa.array(np.full(len(heads), 1, np.int32)), pa.array(doc[heads]), pa.array(body[heads]),
                                               pa.array(np.zeros(len(heads), np.int64)), pa.array(spans, pa.binary()), none], names=names)

        def one_by_one(part: pa.RecordBatch) -> pa.RecordBatch:
            rows = [(2, doc, body, first + i, piece[i:i + length], None if more is None else (np.frombuffer(more, "<i4") + i).astype("<i4").tobytes())
                    for doc, body, first, piece, more in zip(*[part.column(c).to_pylist() for c in names[1:]]) for i in range(len(piece) - length + 1)]
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(
                (pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.binary()))], names=names)

        def thinned() -> Iterator[pa.RecordBatch]:
            """Deals the current key's strings out if it has very many pieces; else settles the rows that a smaller document's equal piece does."""
            nonlocal current, current_rows, crowded, limit
            rows = _Rows(current)
            crowded = crowded or len(rows.pieces) >= crowd
            if crowded:
                for part in current:
                    for at in range(0, len(part), 1000):
                        yield one_by_one(part.slice(at, 1000))
                current = []
            else:
                found.append(rows.settled(np.flatnonzero(rows.later), length))
                current = pa.Table.from_batches(current).filter(pa.array(~rows.later)).to_batches()
            current_rows = sum(map(len, current))
            limit = current_rows + crowd

        def closed() -> Iterator[pa.RecordBatch]:
            nonlocal current, current_rows, ready_bytes, crowded, limit
            if current_rows >= crowd:
                yield from thinned()
            ready.extend(current)
            ready_bytes += sum(pc.sum(pc.binary_length(p.column("piece"))).as_py() for p in current)
            current, current_rows, crowded, limit = [], 0, False, crowd

        def flushed(least: int) -> Iterator[pa.RecordBatch]:
            """Settles the whole keys if they hold `least` bytes, and sends what is found if that is much or the last."""
            nonlocal ready_bytes
            if ready and ready_bytes >= least:
                found.extend(_settle(ready, length))
                ready.clear()
                ready_bytes = 0
            if found and (not least or sum(len(f[0]) for f in found) >= SPANS):
                yield packed()

        for batch in batches:
            n = int(np.count_nonzero(batch.column("kind").to_numpy() == 0))  # sorted by kind
            if n < len(batch):
                yield batch.slice(n).select(names)
            key = batch.column("key").to_numpy()[:n]
            heads = np.flatnonzero(np.r_[True, key[1:] != key[:-1]][:n])
            size = pc.binary_length(batch.column("piece")).to_numpy()[:n].astype(np.int64)
            full = np.diff((np.cumsum(size) - size)[heads] // block, prepend=0) > 0
            # the first and the last key may go on in other batches; keys of very many rows are read alone too
            alone = np.diff(np.r_[heads, n]) >= crowd
            alone[:1] = alone[-1:] = True
            cuts = np.flatnonzero(full | alone | np.r_[True, alone[:-1]][:len(alone)])
            for a, b, single in zip(heads[cuts].tolist(), np.r_[heads[cuts[1:]], n].tolist(), alone[cuts].tolist()):
                part = batch.slice(a, b - a)
                if key[a] != last:
                    yield from closed()
                    last = key[a]
                if single:
                    current.append(part)
                    current_rows += b - a
                    if crowded or current_rows >= limit:
                        yield from thinned()
                else:
                    ready.append(part)
                    ready_bytes += int(size[a:b].sum())
                yield from flushed(block)
        yield from closed()
        yield from flushed(0)

    # strings dealt out one by one meet at their bytes, in the order of the documents; cut sends each once per slice, so none is hot
    place = F.when(F.col("kind") == 2, F.xxhash64("piece")).otherwise(F.xxhash64("doc_id", "body"))
    settled = (dealt.mapInArrow(settle, "kind int, doc_id long, body int, first long, piece binary, more binary").withColumn("place", place)
               .repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "place").sortWithinPartitions("place", "kind", "piece", "doc_id"))

    def later(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Intervals of starts per document: those found already, and those of single strings behind the first document that holds them."""
        give_back()
        last, least = None, 0
        for batch in batches:
            kind, ids, bodies, first = (batch.column(c).to_numpy() for c in ("kind", "doc_id", "body", "first"))
            spans: list[np.ndarray] = [np.empty((0, 2), np.int64)]
            owner: list[np.ndarray] = [np.empty(0, np.int64)]
            alone = []
            for i, (k, piece, more) in enumerate(zip(kind.tolist(), batch.column("piece").to_pylist(), batch.column("more").to_pylist(), strict=True)):
                if k == 1:
                    spans.append(np.frombuffer(piece, "<i4").reshape(-1, 2).astype(np.int64))
                    owner.append(np.full(len(spans[-1]), i))
                elif piece != last:
                    last, least = piece, ids[i]
                elif ids[i] > least:
                    alone.append(i)
                    if more is not None:
                        spans.append(np.frombuffer(more, "<i4").astype(np.int64)[:, None] + [0, 1])
                        owner.append(np.full(len(spans[-1]), i))
            spans.append(np.stack([first[alone], first[alone] + 1], 1))
            owner.append(np.array(alone, np.int64))
            at, row = np.concatenate(spans), np.concatenate(owner)
            order = np.lexsort((bodies[row], ids[row]))
            at, row = at[order], row[order]
            heads = np.flatnonzero(np.r_[True, (ids[row][1:] != ids[row][:-1]) | (bodies[row][1:] != bodies[row][:-1])][:len(row)])
            ends = np.r_[heads, len(row)].astype(np.int32) * 2
            yield pa.RecordBatch.from_arrays([pa.array(ids[row[heads]]), pa.array(bodies[row[heads]]),
                                              pa.ListArray.from_arrays(pa.array(ends), pa.array(at.ravel()))], names=["doc_id", "body", "starts"])

    found = settled.mapInArrow(later, "doc_id long, body int, starts array<long>")
    gone = copies.where(F.col("n") >= length).select("doc_id", "body", F.array(F.lit(0).cast("long"), (F.col("n") - length + 1).cast("long"))
                                                     .alias("starts"))
    return found.union(gone).groupBy("doc_id", "body").agg(F.collect_list("starts").alias("starts"))


def remove_repeats(docs: DataFrame, length: int = LENGTH, crowd: int = CROWD, block: int = BLOCK) -> DataFrame:
    """`docs` with `kept` (the remaining bytes), `n_bytes`, `n_removed` and `n_spans` (maximal removed runs).

    Texts are UTF-8 bytes, a null text is empty.  A byte goes if a string of `length` bytes over it starts in a document with a
    smaller doc_id too; all is judged on the input.  Rows with a null doc_id neither lose nor remove anything; rows that share an id
    do not remove one another.  Columns of the result's names are replaced, all others pass through.
    """
    if not 3 * GRAM - 1 <= length < GRAM + 128:
        raise ValueError(f"strings must be {3 * GRAM - 1} to {GRAM + 127} bytes long")
    docs = docs.drop("kept", "n_bytes", "n_removed", "n_spans")
    columns = docs.columns
    keyed = _keyed(docs)
    found = repeated_strings(docs, keyed, length, crowd, block)
    joined = keyed.join(found, ["doc_id", "body"], "left").select("row", "starts", "part")
    schema = StructType(list(docs.schema.fields) + [StructField("kept", BinaryType())]
                        + [StructField(n, LongType()) for n in ("n_bytes", "n_removed", "n_spans")])
    place = [c.lower() for c in columns].index("text")

    def drop(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_back()
        batch = part = None
        for batch in batches:
            for part in _text_slices(batch, batch.column("row").flatten()[place]):
                yield dropped(part)
        batch = part = None
        give_back()

    def dropped(batch: pa.RecordBatch) -> pa.RecordBatch:
        kept, sizes, removed, spans = [], [], [], []
        given = batch.column("row").flatten()
        for text, lists in zip(given[place], batch.column("starts"), strict=True):
            raw = (text.as_py() or "").encode("utf-8", "surrogatepass")
            sizes.append(len(raw))
            if not lists.is_valid or not len(lists):
                kept.append(raw)
                removed.append(0)
                spans.append(0)
                continue
            gone = _united(np.concatenate([x.values.to_numpy() for x in lists]).reshape(-1, 2), length)
            kept.append(b"".join(raw[a:b] for a, b in zip([0, *gone[:, 1].tolist()], [*gone[:, 0].tolist(), len(raw)])))
            removed.append(int((gone[:, 1] - gone[:, 0]).sum()))
            spans.append(len(gone))
        return pa.RecordBatch.from_arrays([*given, pa.array(kept, pa.binary()), *[pa.array(x, pa.int64()) for x in (sizes, removed, spans)]],
                                          names=[*columns, "kept", "n_bytes", "n_removed", "n_spans"])

    return joined.mapInArrow(drop, schema)


def _united(starts: np.ndarray, length: int) -> np.ndarray:
    """The maximal runs of bytes (start, end) that strings of `length` bytes cover whose starts lie in the half-open intervals given."""
    starts = starts[np.argsort(starts[:, 0], kind="stable")]
    ends = np.maximum.accumulate(starts[:, 1] + (length - 1))
    heads = np.flatnonzero(np.r_[True, starts[1:, 0] > ends[:-1]])
    return np.stack([starts[heads, 0], np.r_[ends[heads[1:] - 1], ends[-1]]], 1)


def brute_force(docs: list[tuple[int, bytes]], length: int = LENGTH) -> dict[int, tuple[int, int, int, str]]:
    """The same on a few documents with distinct ids, string by string, for tests: id -> (bytes, removed, spans, sha256 of the rest)."""
    least: dict[bytes, int] = {}
    for i, raw in docs:
        for p in range(len(raw) - length + 1):
            s = raw[p:p + length]
            least[s] = min(least.get(s, i), i)
    out = {}
    for i, raw in docs:
        gone = np.zeros(len(raw), bool)
        for p in range(len(raw) - length + 1):
            if least[raw[p:p + length]] < i:
                gone[p:p + length] = True
        rest = bytes(b for b, g in zip(raw, gone) if not g)
        out[i] = (len(raw), int(gone.sum()), len(_intervals(gone)), hashlib.sha256(rest).hexdigest())
    return out
