"""Toxicity: disguised words are restored by a noisy-channel decoder, then the restored text is scored.

A disguised word is seen as a character lattice: every sign may stand for itself, for the letters it resembles, for nothing (a
separator) or, in a run, for one or two of its kind.  Viterbi decoding picks the path that is most likely under a
character trigram model of the corpus and the prices of the channel.
"""

from __future__ import annotations

import math
import re
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankflow.llm.common import appended, give_back, labelled_sample
from rankflow.llm.quality import Ftrl
from rankflow.session import written

# Signs that resemble letters (fixed values of the channel).
LOOKS_LIKE = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g", "@": "a",
              "$": "s", "!": "il", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l"}
SUBSTITUTE, DROP_SIGN, DROP_DIGIT, SHORTEN, SPLIT = 1.0, 2.5, 8.0, 0.5, 4.0
# Letter codes: 0 is a word's edge, a-z are 1-26, all other letters share the rest.
CODES = 64
# Words remembered per task; a cache only.
CACHE = 200_000
_ENDS = ".,;:?%&*#\"'`()[]{}<>=~^/\\-_…«»“”„"
# what stands at a word's edge and resembles no letter
_MUTE = "".join(c for c in _ENDS if c not in LOOKS_LIKE)
_LETTERS = re.compile(r"[^\W\d_]+")
_SEPARATED = re.compile(r"(?:[^\W_]|[@$!|+(€£])(?:[.\-_*~](?:[^\W_]|[@$!|+(€£]))+")
_RUN = re.compile(r"(.)\1\1")
_SIGNS = re.compile("[" + re.escape("".join(LOOKS_LIKE)) + "]")
_SPLIT = re.compile(r"[.,;:?%&*#\"'`)\[\]{}<>=~^/\\\-_…«»“”„]+")
_TAIL = re.compile(r"([^\w\s])\1+$|[!|+]$")


def letter_code(c: str) -> int:
    if "a" <= c <= "z":
        return ord(c) - 96
    return 27 + ord(c) % 37 if c.isalpha() else 0


_TABLE = np.array([letter_code(chr(i).lower()) if len(chr(i).lower()) == 1 else 27 for i in range(0x250)], np.int64)


def _slices(texts: list[str | None], size: int = 1 << 18) -> Iterator[str]:
    """All texts, each after two blanks, in strings of about `size` signs; neighbours cut from one text share two signs."""
    held, n = [], 0
    for text in texts:
        for at in range(0, len(text or ""), size):
            held.append(("  " if at == 0 else text[at - 2:at]) + text[at:at + size])
            n += len(held[-1])
            if n >= size:
                yield "".join(held)
                held, n = [], 0
    if held:
        yield "".join(held)


def letter_counts(docs: DataFrame) -> np.ndarray:
    """Trigram counts of letter codes over all whole texts; each task sends its non-zero sums, which are added up before they
    reach the driver.  The result has 64^3 entries whatever the input."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(CODES ** 3, np.int64)
        give_back()  # what the worker's earlier tasks left
        for texts in (b.column(0)[at:at + 256] for b in batches for at in range(0, b.num_rows, 256)):
            for some in _slices(texts.to_pylist()):
                signs = np.frombuffer(some.encode("utf-32-le", "surrogatepass"), np.uint32)
                c = np.where(signs < len(_TABLE), _TABLE[np.minimum(signs, len(_TABLE) - 1)], 27 + signs % 37)
                total += np.bincount(c[:-2] * 4096 + c[1:-1] * 64 + c[2:], minlength=CODES ** 3)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["gram", "n"])

    rows = (docs.select("text").mapInArrow(run, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n")).toArrow())
    counts = np.zeros(CODES ** 3, np.int64)
    counts[rows["gram"].to_numpy()] = rows["n"].to_numpy()
    return counts


def letter_costs(counts: np.ndarray) -> np.ndarray:
    """-log P(c | a, b), smoothed by the bigram and unigram shares."""
    tri = counts.reshape(CODES, CODES, CODES).astype(float)
    bi = tri.sum(axis=0)
    uni = bi.sum(axis=0) + 1
    p1 = uni / uni.sum()
    p2 = (bi + 20 * p1) / (bi.sum(axis=1, keepdims=True) + 20)
    p3 = (tri + 20 * p2) / (tri.sum(axis=2, keepdims=True) + 20)
    return -np.log(p3)


class Decoder:
    """Most likely reading of a disguised word, or of letters that stand one by one."""

    def __init__(self, costs: np.ndarray):
        self.costs = costs.reshape(-1).tolist()

    def _choices(self, seen: str) -> list[list[tuple[str, float]]]:
        steps, i = [], 0
        while i < len(seen):
            c, j = seen[i], i
            while j < len(seen) and seen[j] == c:
                j += 1
            n, i = j - i, j
            if not c.isalnum() and c not in LOOKS_LIKE:
                # a separator stands for nothing, or for the edge between two words
                steps.append([("", DROP_SIGN), (" ", 0.0)])
                continue
            letters = [(c, 0.0)] if c.isalpha() else [(x, SUBSTITUTE) for x in LOOKS_LIKE.get(c, "")]
            if n <= 2:
                step = [(x, p) for x, p in letters]
                if not c.isalpha():
                    step.append(("", DROP_DIGIT if c.isdigit() else DROP_SIGN))
                steps.extend([step] * n)
            else:
                step = [(x * k, p + SHORTEN) for x, p in letters for k in (1, 2)]
                if not c.isalpha():
                    step.append(("", DROP_SIGN))
                steps.append(step)
        return steps

    def __call__(self, seen: str, one_by_one: bool = False) -> str:
        return self.best(seen, one_by_one)[1]

    def best(self, seen: str, one_by_one: bool = False) -> tuple[float, str]:
        """Cost and text of the best reading that has letters; an empty one without a price if there is none."""
        costs = self.costs
        # state: the last two codes -> (cost, reading)
        paths = {0: (0.0, "")}
        for at, step in enumerate(self._choices(seen)):
            after: dict[int, tuple[float, str]] = {}
            if one_by_one and at:
                for state, (cost, text) in list(paths.items()):
                    if text and text[-1] != " ":
                        split = (cost + SPLIT + costs[state * 64], text + " ")
                        if 0 not in paths or split[0] < paths[0][0]:
                            paths[0] = split
            for state, (cost, text) in paths.items():
                for letters, price in step:
                    s, total = state, cost + price
                    for x in letters:
                        code = letter_code(x)
                        total += costs[s * 64 + code]
                        s = (s % 64) * 64 + code
                    if s not in after or total < after[s][0]:
                        after[s] = (total, text + letters)
            paths = after
        return min(((cost + costs[state * 64], text) for state, (cost, text) in paths.items() if text.strip()), default=(0.0, ""))


class Restorer:
    """Distinct restored words of a text, in lower case."""

    def __init__(self, costs: np.ndarray):
        self.decode = Decoder(costs)

    def words(self, part: str) -> tuple[str, ...]:
        """Restored words of one part without white space."""
        whole = part.strip(_MUTE)
        if whole.isalpha():
            return (self.decode(whole) if _RUN.search(whole) else whole,)
        out = self.whole(whole)
        core = _TAIL.sub("", part.strip(_ENDS)).strip(_ENDS)
        if core != whole or _SPLIT.search(core):
            out += self.pieces(core)
        return tuple(dict.fromkeys(out))

    def whole(self, seen: str) -> list[str]:
        """The most likely reading of all signs of a part, edges and separators included; numbers stay numbers if that costs less."""
        if not any(c in LOOKS_LIKE or not (c.isalpha() or unicodedata.combining(c) or unicodedata.category(c)[0] == "M") for c in seen):
            return _LETTERS.findall(seen)
        cost, text = self.decode.best(seen)
        if all(c.isdigit() or not c.isalnum() and c not in LOOKS_LIKE for c in seen) and cost >= self.decode.costs[0] * (len(seen) + 1):
            return []
        return text.split()

    def pieces(self, core: str) -> list[str]:
        """The readings of a part without the signs at its edges, piece by piece between separators."""
        if core.isalpha():
            return [self.decode(core) if _RUN.search(core) else core]
        if _SEPARATED.fullmatch(core):
            return list(self.letters(re.sub(r"[.\-_*~]", "", core)))
        out = []
        for piece in _SPLIT.split(core):
            if not any(map(str.isalpha, piece)):
                continue
            if piece.isalpha() and not _RUN.search(piece):
                out.append(piece)
            elif _SIGNS.search(piece) or _RUN.search(piece):
                out.extend(self.decode(piece).split())
            else:
                out.extend(_LETTERS.findall(piece))
        return out

    def letters(self, joined: str) -> tuple[str, ...]:
        """Readings of letters that stood one by one: as one word, and as the words it most likely was."""
        return tuple(dict.fromkeys([self.decode(joined), *self.decode(joined, True).split()]))

    def spaced(self, parts: list[str]) -> list[str]:
        """Words spelled with white space after each letter: three or more parts of one sign in a row, punctuation aside."""
        return [w for run in _single_runs(parts) for w in self.letters("".join(map(_trimmed, parts[run[0]:run[1]])))]


def _trimmed(part: str) -> str:
    return part if len(part) == 1 else part.strip(_ENDS + "!|+")


def _single_runs(parts: list[str]) -> list[tuple[int, int]]:
    at = [i for i, p in enumerate(parts) if len(p) == 1 or len(p) <= 4 and len(_trimmed(p)) == 1]
    runs, i = [], 0
    while i < len(at):
        j = i
        while j + 1 < len(at) and at[j + 1] == at[j] + 1:
            j += 1
        if j - i >= 2:
            runs.append((at[i], at[j] + 1))
        i = j + 1
    return runs


def word_grams(words: list[str], bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features of many words and the word each belongs to: the word itself and its 4- and 5-byte pieces, edges
    included."""
    raw = [b"^%s$" % w.encode("utf-8", "surrogatepass") for w in words]
    sizes = np.array([len(r) for r in raw], np.int64)
    x = np.frombuffer(b"".join(raw) + bytes(4), np.uint8).astype(np.uint64)
    owner = np.repeat(np.arange(len(raw)), sizes)
    left = np.repeat(np.cumsum(sizes), sizes) - np.arange(len(owner))  # bytes from here to the word's end
    n = len(owner)
    four = x[:n] | x[1:n + 1] << np.uint64(8) | x[2:n + 2] << np.uint64(16) | x[3:n + 3] << np.uint64(24)
    five = four | x[4:n + 4] << np.uint64(32)
    shift = np.uint64(64 - bits)
    out, who = [], []
    for size, value in ((4, four), (5, five)):
        there = left >= size
        mixed = (value[there] + np.uint64(size)) * np.uint64(0x9E3779B97F4A7C15)
        out.append((mixed ^ mixed >> np.uint64(29)) * np.uint64(0xBF58476D1CE4E5B9) >> shift)
        who.append(owner[there])
    out.append(np.array([zlib.crc32(r) >> (32 - bits) for r in raw], np.uint64))
    who.append(np.arange(len(raw)))
    return np.concatenate(out).astype(np.int64), np.concatenate(who)


def feature_scales(made: DataFrame, bits: int) -> np.ndarray:
    """The scale of each feature from rows (label, at): its log-ratio where it speaks for label 1, else 0.

    Documents of either label with each feature are counted in tasks and added up before they reach the driver; of features
    that no document of label 1 has, nothing does.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        having = np.zeros((2, 1 << bits), np.int32)
        docs_of = [0, 0]
        for batch in batches:
            for label_of, at in zip(batch.column(0).to_pylist(), batch.column(1)):
                having[label_of, np.unique(np.frombuffer(at.as_buffer(), np.int32))] += 1
                docs_of[label_of] += 1
        at = np.flatnonzero(having.any(axis=0))
        # the last row counts the documents themselves
        yield pa.RecordBatch.from_arrays([pa.array(np.r_[at, 1 << bits].astype(np.int32)), pa.array(np.r_[having[0, at], docs_of[0]].astype(np.int64)),
                                          pa.array(np.r_[having[1, at], docs_of[1]].astype(np.int64))], names=["at", "n0", "n1"])

    rows = (made.select("label", "at").mapInArrow(run, "at int, n0 long, n1 long").groupBy("at")
            .agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")).where(f"n1 > 0 OR at = {1 << bits}").toArrow())
    at, n0, n1 = (rows[c].to_numpy() for c in ("at", "n0", "n1"))
    total = at == 1 << bits
    all0, all1 = int(n0[total].sum()), int(n1[total].sum())
    at, n0, n1 = at[~total], n0[~total].astype(float), n1[~total].astype(float)
    ratio = np.log((n1 + 0.5) / (all1 + 1)) - np.log((n0 + 0.5) / (all0 + 1))
    # what speaks for label 1, and how often it was seen, scales a feature: a small sample then learns from few of them
    scale = np.zeros(1 << bits)
    scale[at] = np.maximum(ratio, 0) * np.sqrt(n1 / (all1 + 1))
    return scale


def used_features(made: DataFrame, used: np.ndarray, bits: int) -> pa.Table:
    """Rows (id, label, at, n): each document's distinct features among `used`, in order, and how often it has them, in a byte
    each if the document has none more often than that holds, else in four (see `counts_of`)."""
    shared = made.sparkSession.sparkContext.broadcast(used.astype(np.int32))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        there = np.zeros(1 << bits, bool)
        there[shared.value] = True
        for batch in batches:
            found = []
            for at in batch.column(2):
                at = np.frombuffer(at.as_buffer(), np.int32)
                found.append(np.unique(at[there[at]], return_counts=True))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([a.tobytes() for a, _ in found], pa.binary()),
                 pa.array([n.astype(np.uint8 if n.max(initial=0) < 256 else np.int32).tobytes() for _, n in found], pa.binary())],
                names=["id", "label", "at", "n"])

    return made.select("id", "label", "at").mapInArrow(run, "id long, label int, at binary, n binary").toArrow()


def counts_of(at: bytes, n: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Features and counts of one row of `used_features`."""
    at = np.frombuffer(at, np.int32)
    return at, np.frombuffer(n, np.uint8 if len(n) == len(at) else np.int32)


def train_toxicity(docs: DataFrame, labels: DataFrame, label: str = "toxic", modulus: int = 3, remainder: int = 1, bits: int = 20,
                   sample_rows: int = 6_000, updates: int = 12_000, seed: int = 42) -> dict:
    """Channel and word model from labelled rows whose crc32(doc_id) modulo `modulus` is not `remainder`.

    Letter statistics cover all texts.  Features that speak for label 1 are scaled by their log-ratio (a
    naive Bayes prior), the others are left out.  The labelled sample is bounded by `sample_rows` documents; features are made in tasks,
    one list of bucket numbers per document reaches the driver.  A text's log-odds are the bias plus the weights of its
    distinct restored words.  Without labelled rows every score is 0.5.
    """
    costs = letter_costs(letter_counts(docs))
    shared = docs.sparkSession.sparkContext.broadcast(costs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer = Restorer(shared.value)
        for batch in batches:
            made = []
            for text in batch.column(1).to_pylist():
                parts = (text or "").lower().split()
                words = {w for p in set(parts) for w in restorer.words(p)} | set(restorer.spaced(parts))
                made.append(word_grams(sorted(words), bits)[0].astype(np.int32).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(made, pa.binary())],
                                             names=["id", "label", "at"])

    made = written(labelled_sample(docs, labels, label, modulus, remainder, sample_rows).select("id", "text", "label")
                   .mapInArrow(run, "id long, label int, at binary"), "toxicity_features")
    scale = feature_scales(made, bits)
    used = np.flatnonzero(scale)
    rows = used_features(made, used, bits).sort_by([("id", "ascending"), ("label", "ascending"), ("at", "ascending"), ("n", "ascending")])
    data = []
    for at, n, label_of in zip(rows["at"], rows["n"], rows["label"].to_pylist(), strict=True):
        at, n = counts_of(at.as_buffer(), n.as_buffer())
        data.append((np.r_[at, np.int32(1 << bits)], np.r_[n * scale[at], 1.0].astype(np.float32), label_of))
    del rows
    give_back()
    model = Ftrl(bits, alpha=0.5, l1=1.0, l2=0.0)
    random = np.random.default_rng(seed)
    for _ in range(min(max(-(-updates // max(len(data), 1)), 3), 40)):
        for i in random.permutation(len(data)):
            model.update(*data[i])
    weights = model.weights(slice(None))
    bias = float(weights[-1])
    weights = weights[:-1] * scale
    used = np.flatnonzero(weights)
    return {"bits": bits, "costs": costs, "bias": bias, "at": used, "weights": weights[used]}


def score_toxicity(docs: DataFrame, model: dict, score: str = "score") -> DataFrame:
    """`docs` with the probability of label 1 for each whole text; null and empty texts get the bias's probability.

    Row by row: nothing is shuffled.  Other columns pass through; a column called like the score is replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        m = shared.value
        restorer, bits, bias = Restorer(m["costs"]), m["bits"], m["bias"]
        weights = np.zeros(1 << bits)
        weights[m["at"]] = m["weights"]
        # words and weights of the parts that weigh anything, which few do
        plain: dict[str, tuple] = {}

        def learn(parts: set[str], extra: list[str]) -> dict[str, float]:
            """Fills `plain` for new parts; the weights of all words in question."""
            if len(plain) > CACHE:
                plain.clear()
                parts = parts_of_batch
            read = {p: restorer.words(p) for p in parts if p not in plain}
            words = list({w for ws in read.values() for w in ws}.union(extra))
            found = {}
            if words:
                at, who = word_grams(words, bits)
                found = {w: x for w, x in zip(words, np.bincount(who, weights[at], len(words)).tolist()) if x}
            for p, ws in read.items():
                plain[p] = tuple((w, found[w]) for w in ws if w in found)
            return found

        def score_some(texts: list[str | None]) -> list[float]:
            nonlocal parts_of_batch
            split = [(t or "").lower().split() for t in texts]
            distinct = [set(ps) for ps in split]
            parts_of_batch = set().union(*distinct)
            spaced = [restorer.spaced(ps) for ps in split]
            found = learn(parts_of_batch.difference(plain), [w for ws in spaced for w in ws])
            out = []
            for parts, extra in zip(distinct, spaced, strict=True):
                words = dict(x for p in parts if (xs := plain[p]) for x in xs)
                words.update((w, found[w]) for w in extra if w in found)
                total = bias + math.fsum(words.values())
                out.append(1 / (1 + math.exp(-min(max(total, -35), 35))))
            return out

        parts_of_batch: set[str] = set()

        def fn(texts: pa.Array):
            return [pa.array([x for at in range(0, len(texts), 256) for x in score_some(texts[at:at + 256].to_pylist())], pa.float64())]

        return fn

    return appended(docs, ["text"], [(score, "double")], make)


def restore(docs: DataFrame, model: dict, name: str = "restored") -> DataFrame:
    """`docs` with the words of each whole text in order, as the scorer reads them."""
    shared = docs.sparkSession.sparkContext.broadcast(model["costs"])

    def make():
        restorer = Restorer(shared.value)

        def one(text: str | None) -> str:
            parts = (text or "").lower().split()
            out, at = [], 0
            for a, b in [*_single_runs(parts), (len(parts), len(parts))]:
                out += [w for p in parts[at:a] for w in restorer.words(p)]
                out += restorer.letters("".join(parts[a:b]))[:1] if b > a else []
                at = b
            return " ".join(out)

        return lambda texts: [pa.array([one(t.as_py()) for t in texts], pa.string())]

    return appended(docs, ["text"], [(name, "string")], make)
