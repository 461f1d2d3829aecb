"""Texts as sequences of words that repeat: cut, looked up once per distinct word and put together again, in arrays."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE = 8 << 20
# What a remembered entry takes beside its key and value, about.
ENTRY = 150


def slices(texts: pa.Array, limit: int = SLICE) -> Iterator[tuple[int, int]]:
    """Ranges (start, end) of consecutive rows that hold `limit` bytes and 4,096 rows at most; a longer text stands alone."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_pylist()
    start = size = 0
    for i, n in enumerate(sizes):
        if i > start and (size + n > limit or i - start == 4096):
            yield start, i
            start, size = i, 0
        size += n
    if sizes:
        yield start, len(sizes)


def distinct(data: np.ndarray, starts: np.ndarray) -> tuple[list[bytes], pa.Array]:
    """The distinct words of `data` cut at `starts` (from 0, ascending), and each word's place among them."""
    offsets = np.append(starts, len(data)).astype(np.int64)
    cut = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data)])
    coded = cut.dictionary_encode()
    return coded.dictionary.to_pylist(), coded.indices


def assembled(values: Sequence[bytes], places: pa.Array, bounds: np.ndarray) -> list[bytes]:
    """For each pair of neighbouring `bounds`, the values of the words between them, one after the other."""
    taken = pa.array(values, pa.large_binary()).take(places)
    _, offsets, data = taken.buffers()
    at = np.frombuffer(offsets, np.int64, len(taken) + 1)[bounds].tolist()
    raw = data.to_pybytes() if data is not None else b""
    return [raw[a:b] for a, b in zip(at, at[1:])]


class Remembered:
    """Values by key in `limit` bytes or so: once half of them are taken, what was not used since the last time goes."""

    def __init__(self, limit: int):
        self.limit, self.size = limit, 0
        self.used: dict = {}
        self.older: dict = {}

    def unknown(self, keys: list) -> list:
        """The keys without a value; all others can be read from `used` until the next call."""
        if self.size > self.limit // 2:
            self.used, self.older, self.size = {}, self.used, 0
        used, older = self.used, self.older
        out = [k for k in keys if k not in used]
        if older:
            again = [k for k in out if k in older]
            out = [k for k in out if k not in older]
            self.add(again, [older[k] for k in again])
        return out

    def add(self, keys: list, values: list) -> None:
        self.used.update(zip(keys, values, strict=True))
        self.size += sum(map(len, keys)) + sum(map(len, values)) + ENTRY * len(keys)
