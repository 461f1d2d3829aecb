"""Quality classifier: logistic regression on hashed word n-grams, trained with follow-the-regularised-leader updates."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from rankflow.llm.common import appended, labelled_sample

# A word is a run of letters, digits and underscores, or a run of other visible characters.
WORD = re.compile(r"\w+|[^\w\s]+")
# Words remembered per task; a cache only.
CACHE = 200_000
_PRIME = np.uint64(0x9E3779B97F4A7C15)


class _Codes(dict):
    """Word -> 64-bit code, computed once per word."""

    def __missing__(self, word: str) -> int:
        raw = word.encode("utf-8", "surrogatepass")
        code = (zlib.crc32(raw) << 32 | zlib.crc32(raw, 0x5BD1E995)) & 0xFFFFFFFFFFFFFFFF
        if len(self) >= CACHE:
            self.clear()
        self[word] = code
        return code


def _features(text: str | None, codes: _Codes, orders: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket numbers and values of a whole text's 1- to `orders`-grams; the values have length 1 together.

    The value of a bucket grows with the logarithm of its count, so neither repetition nor length decides alone.
    """
    words = WORD.findall(text or "")
    if not words:
        return np.empty(0, np.int64), np.empty(0)
    unit = np.fromiter(map(codes.__getitem__, words), np.uint64, len(words))
    parts, gram = [], unit
    for n in range(orders):
        if n:
            gram = gram[:-1] * _PRIME + unit[n:]
        mixed = gram ^ (gram >> np.uint64(31))
        mixed = mixed * np.uint64(0xBF58476D1CE4E5B9) + np.uint64(n)
        parts.append(mixed >> np.uint64(64 - bits))
        if len(gram) < 2:
            break
    buckets, counts = np.unique(np.concatenate(parts).astype(np.int64), return_counts=True)
    values = np.log1p(counts)
    return buckets, values / np.sqrt(values @ values)


@dataclass
class Ftrl:
    """Follow-the-regularised-leader state for logistic loss: one pair of sums per weight."""

    bits: int
    alpha: float = 3.0
    beta: float = 1.0
    l1: float = 0.01
    l2: float = 0.0

    def __post_init__(self):
        self.z = np.zeros((1 << self.bits) + 1)
        self.n = np.zeros((1 << self.bits) + 1)

    def weights(self, at) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        shrunk = np.sign(z) * np.maximum(np.abs(z) - self.l1, 0)
        return -shrunk / ((self.beta + np.sqrt(n)) / self.alpha + self.l2)

    def update(self, at: np.ndarray, x: np.ndarray, label: int) -> None:
        w = self.weights(at)
        p = 1 / (1 + np.exp(-np.clip(w @ x, -35, 35)))
        g = (p - label) * x
        sigma = (np.sqrt(self.n[at] + g * g) - np.sqrt(self.n[at])) / self.alpha
        self.z[at] += g - sigma * w
        self.n[at] += g * g


def train_quality(docs: DataFrame, labels: DataFrame, label: str = "quality", modulus: int = 5, remainder: int = 0,
                  orders: int = 2, bits: int = 18, sample_rows: int = 20_000, updates: int = 30_000, seed: int = 42) -> dict:
    """A model from labelled rows whose crc32(doc_id) modulo `modulus` is not `remainder`.

    At most `sample_rows` labelled documents are read (the documented bound of the sample); their features are made in
    tasks and only those reach the driver.  They are passed over in random order until about `updates` updates are made, three
    times at least and forty at most.  The weights end as one float vector of 2^bits + 1 entries, the last one the bias.
    Without labelled rows the model scores 0.5 throughout.
    """
    sample = labelled_sample(docs, labels, label, modulus, remainder, sample_rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = _Codes()
        for batch in batches:
            made = [_features(t, codes, orders, bits) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array([a.astype(np.int32).tobytes() for a, _ in made], pa.binary()),
                 pa.array([x.astype(np.float32).tobytes() for _, x in made], pa.binary())], names=["id", "label", "at", "x"])

    rows = (sample.select("id", "text", "label").mapInArrow(run, "id long, label int, at binary, x binary").toArrow()
            .sort_by([("id", "ascending"), ("label", "ascending"), ("at", "ascending")]))
    data = [(np.r_[np.frombuffer(a, np.int32), 1 << bits], np.r_[np.frombuffer(x, np.float32), 1.0].astype(float), y)
            for a, x, y in zip(rows["at"].to_pylist(), rows["x"].to_pylist(), rows["label"].to_pylist(), strict=True)]
    model = Ftrl(bits)
    random = np.random.default_rng(seed)
    for _ in range(min(max(-(-updates // max(len(data), 1)), 3), 40)):
        for i in random.permutation(len(data)):
            model.update(*data[i])
    return {"orders": orders, "bits": bits, "weights": model.weights(slice(None)).astype(np.float32)}


def score_quality(docs: DataFrame, model: dict, score: str = "score") -> DataFrame:
    """`docs` with the probability of label 1 for each whole text, as a sparse dot product.

    Null and empty texts, and texts without words, get the bias's probability.  Row by row: nothing is shuffled.  Other
    columns pass through; a column that is called like the score already is replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        m = shared.value
        codes, w, orders, bits = _Codes(), m["weights"].astype(np.float64), m["orders"], m["bits"]

        def fn(texts: pa.Array):
            out = np.empty(len(texts))
            for i, t in enumerate(texts):
                at, x = _features(t.as_py(), codes, orders, bits)
                out[i] = w[at] @ x + w[-1]
            return [pa.array(1 / (1 + np.exp(-np.clip(out, -35, 35))), pa.float64())]

        return fn

    return appended(docs, ["text"], [(score, "double")], make)
