"""Language identification: a bidirectional gated recurrent network over bytes, in numpy.

Every byte's position gets a distribution over the languages; a document's probabilities are the mean over all its positions.
A text is cut into segments, each read from both of its ends, so a network's state spans a segment.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rankflow.llm.common import appended, held_out

UND = "und"
PAD = 256
SEGMENT = 96
# Segments that run through the network together.
TOGETHER = 1024
_LETTER = re.compile(r"[^\W\d_]")  # a few signs of this kind, such as ², are no letters


def has_letter(text: str) -> bool:
    return any(m.group().isalpha() for m in _LETTER.finditer(text))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


def segments(raw: bytes, length: int = SEGMENT) -> np.ndarray:
    """A text's bytes in rows of `length`, the last one filled up."""
    data = np.frombuffer(raw, np.uint8)
    out = np.full((-(-len(data) // length), length), PAD, np.int16)
    out.reshape(-1)[:len(data)] = data
    return out


def new_network(languages: int, hidden: int, seed: int) -> dict[str, np.ndarray]:
    random = np.random.default_rng(seed)
    p = {}
    for d in "fb":
        p[f"x{d}"] = random.normal(0, 0.3, (PAD + 1, 3 * hidden))
        p[f"u{d}"] = random.normal(0, 1 / np.sqrt(hidden), (hidden, 3 * hidden))
    p["w"] = random.normal(0, 1 / np.sqrt(hidden), (2 * hidden, languages))
    p["c"] = np.zeros(languages)
    return {k: v.astype(np.float32) for k, v in p.items()}


def _read(p: dict, d: str, text: np.ndarray, keep: list | None = None) -> np.ndarray:
    """States of one direction, (time, row, hidden); `keep` collects what the backward pass needs."""
    n, t = text.shape
    x, u = p[f"x{d}"], p[f"u{d}"]
    k = u.shape[0]
    states = np.empty((t, n, k), np.float32)
    h = np.zeros((n, k), np.float32)
    for i in range(t) if d == "f" else range(t - 1, -1, -1):
        own = x[text[:, i]]
        hu = h @ u
        gates = _sigmoid(own[:, :2 * k] + hu[:, :2 * k])
        z, r = gates[:, :k], gates[:, k:]
        new = np.tanh(own[:, 2 * k:] + r * hu[:, 2 * k:])
        there = (text[:, i] != PAD)[:, None]
        after = np.where(there, new + z * (h - new), 0)
        if keep is not None:
            keep.append((i, h, hu, z, r, new, there))
        states[i] = h = after
    return states


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def positions(p: dict, text: np.ndarray) -> np.ndarray:
    """Probabilities of every position, (time, language, row).

    The same network as `_read`, with the rows of the text along the last axis, where numpy is fastest.
    """
    n, t = text.shape
    k = p["uf"].shape[0]
    steps = np.ascontiguousarray(text.T).astype(np.intp)
    there = (steps != PAD).astype(np.float32)
    whole = there.all(axis=1)
    total = np.zeros((t, len(p["c"]), n), np.float32) + p["c"][:, None]
    for d, w in (("f", p["w"][:k]), ("b", p["w"][k:])):
        x, u, w = (np.ascontiguousarray(a.T) for a in (p[f"x{d}"], p[f"u{d}"], w))
        h = np.zeros((k, n), np.float32)
        for i in range(t) if d == "f" else range(t - 1, -1, -1):
            own = x.take(steps[i], axis=1)
            hu = u @ h
            gates = own[:2 * k] + hu[:2 * k]
            np.negative(gates, gates)
            np.exp(gates, gates)
            gates += 1
            np.reciprocal(gates, gates)
            new = hu[2 * k:] * gates[k:]
            new += own[2 * k:]
            np.tanh(new, new)
            h -= new
            h *= gates[:k]
            h += new
            if not whole[i]:
                h *= there[i]
            total[i] += w @ h
    total -= total.max(axis=1, keepdims=True)
    np.exp(total, total)
    total /= total.sum(axis=1, keepdims=True)
    return total


def gradients(p: dict, text: np.ndarray, label: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
    """Mean cross-entropy over all positions and its gradients, by backpropagation through time."""
    k = p["uf"].shape[0]
    kept = {"f": [], "b": []}
    states = {d: _read(p, d, text, kept[d]) for d in "fb"}
    both = np.concatenate([states["f"], states["b"]], axis=2)
    prob = _softmax(both @ p["w"] + p["c"])
    there = (text != PAD).T
    total = max(int(there.sum()), 1)
    rows = np.arange(len(label))
    loss = -np.log(np.maximum(prob[:, rows, label], 1e-12))[there].sum() / total
    error = prob.copy()
    error[:, rows, label] -= 1
    error *= there[:, :, None] / total
    g = {"w": np.einsum("tni,tnl->il", both, error), "c": error.sum(axis=(0, 1))}
    out = error @ p["w"].T
    for d, part in (("f", out[:, :, :k]), ("b", out[:, :, k:])):
        u = p[f"u{d}"]
        gx, gu = np.zeros_like(p[f"x{d}"]), np.zeros_like(u)
        dh = np.zeros_like(part[0])
        for i, h, hu, z, r, new, seen in reversed(kept[d]):
            dh = (dh + part[i]) * seen
            dn = dh * (1 - z) * (1 - new * new)
            dz = dh * (h - new) * z * (1 - z)
            dr = dn * hu[:, 2 * k:] * r * (1 - r)
            dgate = np.concatenate([dz, dr, dn * r], axis=1)
            np.add.at(gx, text[:, i], np.concatenate([dz, dr, dn], axis=1))
            gu += h.T @ dgate
            dh = dh * z + dgate @ u.T
        g[f"x{d}"], g[f"u{d}"] = gx, gu
    return float(loss), g


def train_network(texts: np.ndarray, labels: np.ndarray, languages: int, hidden: int = 8, steps: int = 400, batch: int = 128,
                  rate: float = 0.02, seed: int = 42) -> dict[str, np.ndarray]:
    """Adam on batches of segments; `steps` and `batch` fix the work."""
    p = new_network(languages, hidden, seed)
    m, v = ({k: np.zeros_like(x) for k, x in p.items()} for _ in range(2))
    random = np.random.default_rng(seed)
    for step in range(1, steps + 1):
        some = random.integers(0, len(texts), batch)
        _, g = gradients(p, texts[some], labels[some])
        scale = min(1.0, 1.0 / (np.sqrt(sum(float((x * x).sum()) for x in g.values())) + 1e-9))
        pace = rate * min(1.0, 2 * (1 - step / (steps + 1)))
        for k in p:
            x = g[k] * scale
            m[k] = 0.9 * m[k] + 0.1 * x
            v[k] = 0.99 * v[k] + 0.01 * x * x
            p[k] = (p[k] - pace * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v[k] / (1 - 0.99 ** step)) + 1e-8)).astype(np.float32)
    return p


def train_langid(docs: DataFrame, modulus: int = 4, remainder: int = 2, rows_per_language: int = 500, per_document: int = 4,
                 length: int = 64, hidden: int = 8, steps: int = 400, seed: int = 42) -> dict:
    """A model from text and non-null lang of documents whose crc32(doc_id) modulo `modulus` is not `remainder`.

    The sample is bounded: at most `rows_per_language` documents of each language, chosen by a hash of their id, and of each `per_document` segments of `length` bytes, chosen by a hash as well.  Without labelled texts there is no language and every
    prediction is `und`.
    """
    usable = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull()
                        & ~held_out("doc_id", modulus, remainder))
    # one pass for all languages; Spark keeps the first of each language in every task, so no task gets all rows of a frequent one
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id"))
    first = usable.select("lang", "doc_id").withColumn("place", place).where(F.col("place") <= rows_per_language)
    ids = [r.doc_id for r in first.select("doc_id").collect()]
    chosen = docs.sparkSession.createDataFrame([(i,) for i in sorted(set(ids))], "doc_id long")
    taught = usable.join(F.broadcast(chosen), "doc_id", "left_semi").select("doc_id", "lang", "text")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc, lang, text in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                raw = text.encode("utf-8", "surrogatepass")
                random = np.random.default_rng([seed, doc & 0xFFFFFFFF])
                if has_letter(text):
                    out += [(doc, lang, raw[a:a + length]) for a in
                            sorted({int(a) for a in random.integers(0, max(len(raw) - length, 0) + 1, per_document)})]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in out], pa.int64()), pa.array([r[1] for r in out], pa.string()),
                                              pa.array([r[2] for r in out], pa.binary())], names=["doc_id", "lang", "part"])

    rows = (taught.mapInArrow(cut, "doc_id long, lang string, part binary").toArrow()
            .sort_by([("doc_id", "ascending"), ("lang", "ascending"), ("part", "ascending")]))
    langs = sorted(set(rows["lang"].to_pylist()))
    if not langs:
        return {"langs": []}
    texts = np.concatenate([segments(x, length) for x in rows["part"].to_pylist()])
    labels = np.array([langs.index(x) for x in rows["lang"].to_pylist()])
    # every language is drawn as often as any other
    random = np.random.default_rng(seed)
    most = np.bincount(labels).max()
    even = np.concatenate([random.choice(np.flatnonzero(labels == i), most) for i in range(len(langs))])
    return {"langs": langs, **train_network(texts[even], labels[even], len(langs), hidden, steps, seed=seed)}


def label_documents(docs: DataFrame, model: dict, pred: str = "lang_pred", score: str = "score", name: str | None = None) -> DataFrame:
    """`docs` with the most likely language of each whole text and its pooled probability (0 to 1; 0 for `und`).

    Null texts and texts without a letter are `und`; equal probabilities go to the first language by name.  With `name`, one
    more column holds the number of positions of each language, the labels of all positions summed up.  A long text is read segment
    by segment, whole.  Nothing is shuffled; other columns pass through, columns of the same names are replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    outputs = [(pred, "string"), (score, "double")] + ([(name, "map<string,bigint>")] if name else [])

    def make():
        m = shared.value
        langs = m["langs"]

        def fn(texts: pa.Array):
            n = len(texts)
            sums, counts, sizes = np.zeros((n, len(langs))), np.zeros((n, len(langs)), np.int64), np.zeros(n, np.int64)
            waiting: list[tuple[np.ndarray, int]] = []
            held = 0

            def work() -> None:
                nonlocal waiting, held
                text = np.concatenate([a for a, _ in waiting])
                owner = np.concatenate([np.full(len(a), i) for a, i in waiting])
                waiting, held = [], 0
                for at in range(0, len(text), TOGETHER):
                    part, own = text[at:at + TOGETHER], owner[at:at + TOGETHER]
                    prob = positions(m, part)
                    there = (part != PAD).T
                    np.add.at(sums, own, np.einsum("tln,tn->nl", prob, there.astype(np.float32)))
                    np.add.at(sizes, own, there.sum(axis=0))
                    if name:
                        best = prob.argmax(axis=1)
                        for i in range(len(langs)):
                            np.add.at(counts[:, i], own, ((best == i) & there).sum(axis=0))

            for i, t in enumerate(texts):
                text = t.as_py()
                if not langs or text is None or not has_letter(text):
                    continue
                raw = text.encode("utf-8", "surrogatepass")
                for at in range(0, len(raw), SEGMENT * TOGETHER):  # a very long text goes through in several pieces
                    waiting.append((segments(raw[at:at + SEGMENT * TOGETHER]), i))
                    held += len(waiting[-1][0])
                    if held >= TOGETHER:
                        work()
            if waiting:
                work()
            read = sizes > 0
            share = sums / np.maximum(sizes, 1)[:, None]
            best = share.argmax(axis=1) if langs else np.zeros(n, int)
            out = [pa.array([langs[b] if r else UND for b, r in zip(best, read)], pa.string()),
                   pa.array([min(float(share[i, b]), 1.0) if r else 0.0 for i, (b, r) in enumerate(zip(best, read))], pa.float64())]
            if name:
                out.append(pa.array([list(zip(langs, map(int, c))) for c in counts], pa.map_(pa.string(), pa.int64())))
            return out

        return fn

    return appended(docs, ["text"], outputs, make)
