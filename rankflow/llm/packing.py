"""Packing of token sequences: bounded-space best-fit, task by task, and a merge of what stays open."""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankflow.llm.common import give_back
from rankflow.llm.words import SLICE, Remembered, assembled, distinct, slices
from rankflow.session import written

SIZE = 4096
OPEN = 64
MIN_CUT = 32
FAN_IN = 16
END_ID = 2
# Bytes of words remembered per worker; a cache only.
MEMORY = 96 << 20
WIDTH = 4
SCHEMA = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()),
                    ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()), ("ids", pa.binary()),
                    ("task", pa.int64())])
DDL = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids binary, "
       "task long")


class WordEncoder:
    """Token ids of whole texts as little-endian unsigned 32-bit bytes, through a tokenizers file.

    The vocabulary lower-cases and its splitting never lets a token cross a space or a line feed, nor join a letter with the
    punctuation behind it.  A text's ids are then those of its words, in lower case and without the signs at their end, and of
    these signs; each distinct one is encoded once and remembered, in `memory` bytes for parts and for words each.
    """

    def __init__(self, path: str, memory: int = MEMORY):
        import os
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, normalizers, pre_tokenizers
        self.tokenizer, self.plain = Tokenizer.from_file(path), Tokenizer.from_file(path)
        # words of a-z need no normalising, and are split by the blanks between them alone
        self.plain.normalizer, self.plain.pre_tokenizer = normalizers.Sequence([]), pre_tokenizers.WhitespaceSplit()
        self.parts, self.words = Remembered(memory), Remembered(memory)  # between blanks; without the signs at the end
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True

    def _encode(self, words: list[bytes]) -> None:
        simple, letters, others = [], [], []
        for w in self.words.unknown(words):
            t = w.decode("utf-8", "replace")
            (simple if w.isalpha() else letters if t.isalpha() else others).append((w, t))
        # a word of letters ends with its only word end, so many can be encoded as one text
        for tokenizer, some in ((self.plain, simple), (self.tokenizer, letters)):
            groups = [some[i:i + 1024] for i in range(0, len(some), 1024)]
            found = tokenizer.encode_batch_fast([" ".join(t for _, t in g) for g in groups], add_special_tokens=False)
            for group, encoded in zip(groups, found, strict=True):
                ids = np.array(encoded.ids, "<u4")
                cuts = (np.flatnonzero(self.ends[ids]) + 1).tolist()
                if len(cuts) == len(group):
                    raw = ids.tobytes()
                    self.words.add([w for w, _ in group], [raw[a * WIDTH:b * WIDTH] for a, b in zip([0, *cuts], cuts)])
                else:
                    others += group
        for i in range(0, len(others), 4096):
            some = others[i:i + 4096]
            found = self.tokenizer.encode_batch_fast([t for _, t in some], add_special_tokens=False)
            self.words.add([w for w, _ in some], [np.array(e.ids, "<u4").tobytes() for e in found])

    def __call__(self, texts: list[str]) -> list[bytes]:
        # every text starts with a blank, so every part does; only A-Z are lowered here, which changes no id
        raw = [b" " + t.encode("utf-8", "replace").lower().replace(b"\n", b" ") for t in texts]
        data = np.frombuffer(b"".join(raw), np.uint8)
        starts = np.flatnonzero(data == 32)
        if not len(starts):
            return []
        parts, places = distinct(data, starts)
        new = self.parts.unknown(parts)
        heads = [p.rstrip(b".,;:!?%&*#$") for p in new]
        heads = [h if h[-1:].isalpha() else p for p, h in zip(new, heads)]
        tails = [p[len(h):] for p, h in zip(new, heads)]
        heads = [h[1:] for h in heads]
        self._encode(list({*heads, *tails}))
        known = self.words.used
        self.parts.add(new, [known[h] + known[t] for h, t in zip(heads, tails)])
        bounds = np.searchsorted(starts, np.cumsum([0, *map(len, raw)]))
        return assembled(list(map(self.parts.used.__getitem__, parts)), places, bounds)


class _Packer:
    """Open windows of one task.  A piece goes to the window it fills best; when none has room and all `open_windows` are
    taken, the fullest one is topped up with the head of the piece (if head and rest are at least `min_cut` long) and
    emitted."""

    def __init__(self, size: int, open_windows: int, min_cut: int, first_id: int, keep_ids: bool):
        self.size, self.most, self.min_cut, self.next_id, self.keep_ids = size, open_windows, min_cut, first_id, keep_ids
        self.windows: dict[int, list] = {}  # number -> pieces
        self.gaps: list[tuple[int, int]] = []  # (room left, number), sorted
        self.count = 0
        self.out: list[tuple] = []

    def emit(self, pieces: list) -> None:
        offset = 0
        for doc, start, ids, total in pieces:
            n = len(ids) // WIDTH
            self.out.append((doc, start, n, zlib.crc32(ids), total, self.next_id, offset, ids if self.keep_ids else None, None))
            offset += n
        self.next_id += 1

    def add(self, doc, start: int, ids: bytes, total: int) -> None:
        n = len(ids) // WIDTH
        while n >= self.size:
            self.emit([(doc, start, ids[:self.size * WIDTH], total)])
            start, ids, n = start + self.size, ids[self.size * WIDTH:], n - self.size
        while n:
            at = bisect_left(self.gaps, (n, -1))
            if at < len(self.gaps):
                gap, number = self.gaps.pop(at)
                self.windows[number].append((doc, start, ids, total))
                if gap == n:
                    self.emit(self.windows.pop(number))
                else:
                    insort(self.gaps, (gap - n, number))
                return
            if len(self.gaps) < self.most:
                self.count += 1
                self.windows[self.count] = [(doc, start, ids, total)]
                insort(self.gaps, (self.size - n, self.count))
                return
            gap, number = self.gaps.pop(0)
            pieces = self.windows.pop(number)
            if gap >= self.min_cut and n - gap >= self.min_cut:
                pieces.append((doc, start, ids[:gap * WIDTH], total))
                start, ids, n = start + gap, ids[gap * WIDTH:], n - gap
            self.emit(pieces)

    def left(self, task: int) -> list[tuple]:
        """The pieces of the windows that are still open, with their ids."""
        return [(doc, start, len(ids) // WIDTH, 0, total, None, None, ids, task)
                for number in sorted(self.windows) for doc, start, ids, total in self.windows[number]]

    def fill_left(self) -> None:
        """Emit all that is left, cutting pieces so that every sequence but the last is full."""
        pieces, room = [], self.size
        for number in sorted(self.windows):
            for doc, start, ids, total in self.windows[number]:
                while ids:
                    head = ids[:room * WIDTH]
                    pieces.append((doc, start, head, total))
                    taken = len(head) // WIDTH
                    start, ids, room = start + taken, ids[taken * WIDTH:], room - taken
                    if not room:
                        self.emit(pieces)
                        pieces, room = [], self.size
        if pieces:
            self.emit(pieces)
        self.windows, self.gaps = {}, []


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(SCHEMA)], schema=SCHEMA)


def _task(level: int) -> tuple[int, int]:
    """This task's partition and the first of its sequence ids; levels and partitions never share ids."""
    part = TaskContext.get().partitionId()
    return part, level << 56 | part << 28


def pack(docs: DataFrame, encoder: Callable[[], Callable[[list[str]], list[bytes]]], size: int = SIZE, open_windows: int = OPEN,
         min_cut: int = MIN_CUT, fan_in: int = FAN_IN, end_id: int = END_ID, keep_ids: bool = True, slice_bytes: int = SLICE) -> DataFrame:
    """Pack all documents into sequences of at most `size` tokens, one row per piece.

    A document's ids are those of `encoder` (made once per worker process) and `end_id`; a null text is empty, so every row has at
    least one id.  Returns doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset and, with `keep_ids`, the piece's
    ids as little-endian unsigned 32-bit bytes.

    Each task keeps `open_windows` windows, whatever it reads, and emits full ones as it goes.  What is open at its
    end is written with the rest; `fan_in` tasks' leftovers are packed together again, round by round, until one task holds the last
    of them, cut to fill every sequence but the last.  Each round is computed once and written, so a lost executor cannot make
    two rounds disagree.  Repeated rows are packed as often as they occur; equal ids do not matter.

    Texts are encoded `slice_bytes` at a time (a longer one alone); fewer take less memory and more time, the result is the same.
    """
    # each worker process keeps its copy, and with it the encoder, from task to task
    held = docs.sparkSession.sparkContext.broadcast({})

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, first_id = _task(0)
        packer = _Packer(size, open_windows, min_cut, first_id, keep_ids)
        end = np.array([end_id], "<u4").tobytes()
        give_back()  # what the worker's earlier tasks left
        for batch in batches:
            encode = held.value.get("encode") or held.value.setdefault("encode", encoder())
            for a, b in slices(batch.column(1), slice_bytes):
                some = batch.slice(a, b - a)
                for doc, ids in zip(some.column(0).to_pylist(), encode([t or "" for t in some.column(1).to_pylist()]), strict=True):
                    ids += end
                    packer.add(doc, 0, ids, len(ids) // WIDTH)
                if len(packer.out) > 4096:
                    yield _batch(packer.out)
                    packer.out = []
        yield _batch(packer.out + packer.left(part))
        packer = batch = some = None
        give_back()

    def again(level: int, last: bool) -> Callable:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            groups: dict[int, _Packer] = {}
            part, first_id = _task(level)
            for batch in batches:
                for r in batch.to_pylist():
                    packer = groups.get(r["task"])
                    if packer is None:
                        # groups of one task share its ids, a sixteenth of a task's range each is far more than they need
                        packer = groups[r["task"]] = _Packer(size, open_windows, min_cut, first_id + (len(groups) << 18), keep_ids)
                    packer.add(r["doc_id"], r["start"], r["ids"], r["doc_tokens"])
            for number, packer in groups.items():
                if last:
                    packer.fill_left()
                yield _batch(packer.out + packer.left(number))
        return run

    spark = docs.sparkSession
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    whole = written(source.mapInArrow(first, DDL), "packed")
    done = [whole.where("sequence_id IS NOT NULL")]
    left = whole.where("sequence_id IS NULL")
    most = left.agg(F.max("task")).first()[0]
    tasks, level = (0 if most is None else most + 1), 0
    while tasks:
        level += 1
        groups = -(-tasks // fan_in)
        dealt = (left.withColumn("task", F.floor(F.col("task") / fan_in))
                 .repartition(min(groups, int(spark.conf.get("spark.sql.shuffle.partitions"))), "task")
                 .sortWithinPartitions("task", "doc_id", "start", "length"))
        whole = written(dealt.mapInArrow(again(level, groups == 1), DDL), "packed")
        done.append(whole.where("sequence_id IS NOT NULL"))
        left = whole.where("sequence_id IS NULL")
        tasks = 0 if groups == 1 else groups
    result = done[0]
    for more in done[1:]:
        result = result.union(more)
    return result.drop("task") if keep_ids else result.drop("task", "ids")


def word_encoder(path: str, memory: int = MEMORY) -> Callable[[], WordEncoder]:
    """A maker of encoders for `pack`; `path` is a tokenizers file, or its name among the installed public vocabularies.

    `memory` bounds the bytes of words each remembers; with fewer it encodes words again that it has forgotten.
    """
    def make() -> WordEncoder:
        import os
        if os.sep in path:
            return WordEncoder(path, memory)
        import public_tokenizers
        return WordEncoder(public_tokenizers.path(path), memory)
    return make
