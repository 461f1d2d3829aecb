"""SentencePiece models on the tokenizers library: encoding, decoding and a check against the original library."""

from __future__ import annotations

import os
import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from rankflow.llm.common import appended
from rankflow.llm.words import Remembered, assembled, distinct, slices

MARK = "▁"
# Fixed numbers of the model format.
UNIGRAM, BPE = 1, 2
NORMAL, UNKNOWN, CONTROL, USER, BYTE = 1, 2, 3, 4, 6
# Bytes of words remembered per worker, for encoding and for decoding each; a cache only.
MEMORY = 96 << 20


def fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(field number, value) of a protobuf message; numbers come as ints, all else as bytes."""
    def varint(at: int) -> tuple[int, int]:
        value = shift = 0
        while True:
            byte = data[at]
            value |= (byte & 127) << shift
            at, shift = at + 1, shift + 7
            if byte < 128:
                return value, at

    at = 0
    while at < len(data):
        key, at = varint(at)
        kind = key & 7
        if kind == 0:
            value, at = varint(at)
        else:
            size, at = varint(at) if kind == 2 else ({1: 8, 5: 4}[kind], at)
            value, at = data[at:at + size], at + size
        yield key >> 3, value


def parse_model(data: bytes) -> dict:
    """Pieces, model type, byte fallback and normaliser of a model file."""
    model = {"pieces": [], "type": UNIGRAM, "byte_fallback": False, "charsmap": b"", "dummy_prefix": True, "squeeze": True,
             "escape": True}
    for number, value in fields(data):
        if number == 1:
            piece = {"text": "", "score": 0.0, "type": NORMAL}
            for n, v in fields(value):
                if n == 1:
                    piece["text"] = v.decode("utf-8")
                elif n == 2:
                    piece["score"] = struct.unpack("<f", v)[0]
                elif n == 3:
                    piece["type"] = v
            model["pieces"].append(piece)
        elif number == 2:
            for n, v in fields(value):
                if n == 3:
                    model["type"] = v
                elif n == 35:
                    model["byte_fallback"] = bool(v)
        elif number == 3:
            names = {2: "charsmap", 3: "dummy_prefix", 4: "squeeze", 5: "escape"}
            for n, v in fields(value):
                if n in names:
                    model[names[n]] = v if n == 2 else bool(v)
    return model


def build_tokenizer(model: dict):
    """A tokenizers object with the model's normaliser, marker, scores or merges, and byte fallback."""
    from tokenizers import AddedToken, Regex, Tokenizer, decoders, models, normalizers
    pieces = model["pieces"]
    unknown = next(i for i, p in enumerate(pieces) if p["type"] == UNKNOWN)
    if model["type"] == UNIGRAM:
        core = models.Unigram([(p["text"], p["score"]) for p in pieces], unknown, model["byte_fallback"])
    elif model["type"] == BPE:
        vocab = {p["text"]: i for i, p in enumerate(pieces)}
        usable = {p["text"]: p["score"] for p in pieces if p["type"] in (NORMAL, USER)}
        merges = []
        for text, score in usable.items():
            for i in range(1, len(text)):
                left, right = text[:i], text[i:]
                if left in usable and right in usable:
                    merges.append((-score, vocab[text], vocab[left], vocab[right], left, right))
        merges.sort(key=lambda m: m[:4])
        core = models.BPE(vocab, [(m[4], m[5]) for m in merges], unk_token=pieces[unknown]["text"], fuse_unk=True,
                          byte_fallback=model["byte_fallback"])
    else:
        raise ValueError("only unigram and BPE models have a counterpart")
    tokenizer = Tokenizer(core)
    steps = [normalizers.Precompiled(model["charsmap"])] if model["charsmap"] else []
    if model["squeeze"]:
        steps += [normalizers.Replace(Regex(" {2,}"), " "), normalizers.Strip()]
    if model["dummy_prefix"]:
        steps.append(normalizers.Prepend(MARK if model["escape"] else " "))
    if model["escape"]:
        steps.append(normalizers.Replace(" ", MARK))
    tokenizer.normalizer = normalizers.Sequence(steps)
    user = [AddedToken(p["text"], normalized=False) for p in pieces if p["type"] == USER]
    if user:
        tokenizer.add_tokens(user)
    back = [decoders.Replace(MARK, " "), decoders.ByteFallback(), decoders.Fuse()]
    if model["dummy_prefix"]:
        back.append(decoders.Strip(" ", 1, 0))
    tokenizer.decoder = decoders.Sequence(back)
    return tokenizer


class Codec:
    """Encoder and decoder of one task.

    Where no piece holds a marker after another sign, pieces never cross the start of a word, so a normalised text is encoded
    and decoded word by word, each distinct word once, thousands of them in one call.  A text's parity then says that the
    original library normalises the whole text alike and gives the same ids for each of its words.  Other models are encoded,
    decoded and compared text by text.
    """

    def __init__(self, data: bytes, threads: int, memory: int = MEMORY):
        os.environ["TOKENIZERS_PARALLELISM"] = "true" if threads > 1 else "false"
        os.environ.setdefault("RAYON_NUM_THREADS", str(threads))
        import sentencepiece
        from tokenizers import decoders, normalizers, pre_tokenizers
        self.threads, self.model = threads, parse_model(data)
        self.tokenizer, self.plain, self.alone = (build_tokenizer(self.model) for _ in range(3))
        self.original = sentencepiece.SentencePieceProcessor(model_proto=data)
        pieces = [p["text"] for p in self.model["pieces"]]
        crossing = re.compile(f"[^{MARK}]{MARK}")
        self.by_word = (self.model["dummy_prefix"] and self.model["escape"] and not self.model["squeeze"]
                        and not any(crossing.search(p) for p in pieces)
                        and not any(p["type"] == USER for p in self.model["pieces"]))
        # for words: texts come normalised, are split before each marker (but in words with several) and keep their first
        # blank when decoded
        self.plain.normalizer = self.alone.normalizer = normalizers.Sequence([])
        self.plain.pre_tokenizer = pre_tokenizers.Split(MARK, "merged_with_next")
        self.plain.decoder = decoders.Sequence([decoders.Replace(MARK, " "), decoders.ByteFallback(), decoders.Fuse()])
        self.starts = np.array([p.startswith(MARK) for p in pieces])
        # markers in a piece; two stand for pieces whose text may hold blanks of another kind
        self.marks = np.array([p["text"].count(MARK) if p["type"] == NORMAL else 0 if p["type"] == BYTE and p["text"] != "<0x20>"
                               else 2 for p in self.model["pieces"]])
        self.known, self.read, self.wrong = Remembered(memory), Remembered(memory), set()

    def _normal(self, texts: list[str]) -> list[str]:
        if self.model["charsmap"]:
            return [self.tokenizer.normalizer.normalize_str(t) if t else "" for t in texts]
        return [MARK + t.replace(" ", MARK) if t else "" for t in texts]

    def _ids(self, words: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        """Ids of words one by one, by both libraries; each starts with markers."""
        own = [e.ids for e in self.alone.encode_batch_fast(words, add_special_tokens=False)]
        there = []
        for w in words:
            if w.strip(MARK):
                # the original adds the first marker itself
                there.append(self.original.encode(w[1:].replace(MARK, " ")))
            else:
                # and drops the one of an empty text, so markers alone are read behind a letter
                there.append(self.original.encode("a" + w.replace(MARK, " "))[len(self.original.encode("a")):])
        return own, there

    def _learn(self, new: list[bytes]) -> None:
        texts = [w.decode("utf-8") for w in new]
        simple = [(w, t) for w, t in zip(new, texts) if len(t) > 1 and t.count(MARK) == 1]
        others = [(w, t) for w, t in zip(new, texts) if len(t) == 1 or t.count(MARK) > 1]
        # a few groups at a time, as the libraries' results take many times the ids
        for i in range(0, len(simple), 16_384):
            groups = [simple[j:j + 512] for j in range(i, min(i + 16_384, len(simple)), 512)]
            runs = ["".join(t for _, t in g) for g in groups]
            found = self.plain.encode_batch_fast(runs, add_special_tokens=False)
            there = self.original.encode([r[1:].replace(MARK, " ") for r in runs], num_threads=self.threads)
            for group, encoded, other in zip(groups, found, there, strict=True):
                ids = np.array(encoded.ids, "<u4")
                cuts = np.append(np.flatnonzero(self.starts[ids]), len(ids)).tolist()
                if len(cuts) == len(group) + 1 and encoded.ids == other:
                    raw = ids.tobytes()
                    self.known.add([w for w, _ in group], [raw[x * 4:y * 4] for x, y in zip(cuts, cuts[1:])])
                else:
                    others += group
        for i in range(0, len(others), 4096):
            some = others[i:i + 4096]
            own, there = self._ids([t for _, t in some])
            self.known.add([w for w, _ in some], [np.array(x, "<u4").tobytes() for x in own])
            self.wrong.update(w for (w, _), x, y in zip(some, own, there, strict=True) if x != y)

    def encode(self, texts: list[str]) -> tuple[list[bytes], list[bool]]:
        """Ids as little-endian unsigned 32-bit bytes, and whether the original library gives the same ones."""
        if not any(texts):
            return [b""] * len(texts), [True] * len(texts)
        if not self.by_word:
            ids = [e.ids for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]
            same = [a == b for a, b in zip(ids, self.original.encode(texts, num_threads=self.threads), strict=True)]
            return [np.array(a if t else [], "<u4").tobytes() for a, t in zip(ids, texts)], [s or not t for s, t in zip(same, texts)]
        normal = self._normal(texts)
        same = [not t or n == self.original.normalize(t) for t, n in zip(texts, normal, strict=True)]
        raw = [n.encode("utf-8") for n in normal]
        data = np.frombuffer(b"".join(raw), np.uint8)
        at = np.cumsum([0, *map(len, raw)])
        # a word starts at a marker that no other one precedes in its text
        marks = np.flatnonzero((data[:-2] == 0xE2) & (data[1:-1] == 0x96) & (data[2:] == 0x81))
        begins = np.zeros(len(data), bool)
        begins[marks[np.diff(marks, prepend=-9) != 3]] = True
        begins[at[:-1][np.diff(at) > 0]] = True
        starts = np.flatnonzero(begins)
        words, places = distinct(data, starts)
        self._learn(self.known.unknown(words))
        bounds = np.searchsorted(starts, at)
        if not self.wrong.isdisjoint(words):
            bad = np.array([w in self.wrong for w in words])[places.to_numpy()]
            same = [s and not bad[a:b].any() for s, a, b in zip(same, bounds, bounds[1:])]
        return assembled(list(map(self.known.used.__getitem__, words)), places, bounds), same

    def decode(self, ids: list[np.ndarray]) -> list[str]:
        """Texts of id lists.  Where words can be encoded one by one they can be decoded so too, and each is decoded once."""
        sizes = np.cumsum([0, *map(len, ids)])
        flat = np.concatenate(ids) if sizes[-1] else np.zeros(0, np.int64)
        if not len(flat):
            return [""] * len(ids)
        if not self.by_word or not 0 <= flat.min() <= flat.max() < len(self.starts):
            return self.tokenizer.decode_batch([a.tolist() for a in ids], skip_special_tokens=False)
        firsts = self.starts[flat]
        firsts[sizes[:-1][np.diff(sizes) > 0]] = True
        starts = np.flatnonzero(firsts)
        words, places = distinct(flat.astype("<u4").view(np.uint8), starts * 4)
        new = self.read.unknown(words)
        whole = np.frombuffer(b"".join(new), "<u4")
        heads = np.cumsum([0, *map(len, new)])[:-1] // 4
        # words with one marker, their first sign, can be told apart in a common text
        single = ((np.add.reduceat(self.marks[whole], heads) == 1) & self.starts[whole[heads]]).tolist() if new else []
        simple = [w for w, s in zip(new, single) if s]
        others = [w for w, s in zip(new, single) if not s]
        for i in range(0, len(simple), 16_384):
            groups = [simple[j:j + 512] for j in range(i, min(i + 16_384, len(simple)), 512)]
            found = self.plain.decode_batch([np.frombuffer(b"".join(g), "<u4").tolist() for g in groups], skip_special_tokens=False)
            for group, text in zip(groups, found, strict=True):
                parts = text.encode("utf-8").split(b" ")
                if len(parts) == len(group) + 1 and not parts[0]:
                    self.read.add(group, [b" " + p for p in parts[1:]])
                else:
                    others += group
        found = self.plain.decode_batch([np.frombuffer(w, "<u4").tolist() for w in others], skip_special_tokens=False) if others else []
        self.read.add(others, [t.encode("utf-8") for t in found])
        raw = assembled(list(map(self.read.used.__getitem__, words)), places, np.searchsorted(starts, sizes))
        return [r.removeprefix(b" ").decode("utf-8") for r in raw]


def _load(path: str) -> bytes:
    if os.sep not in path:
        import public_tokenizers
        path = public_tokenizers.path(path)
    with open(path, "rb") as f:
        return f.read()


def _codec(held, path: str, threads: int) -> Codec:
    """The worker process's codec: it keeps its copy of the broadcast value, and with it the codec, from task to task."""
    if "codec" not in held.value:
        held.value["codec"] = Codec(_load(path), threads)
    return held.value["codec"]


def _encoded(codec: Codec, texts: pa.Array, decoded: bool) -> list[pa.Array]:
    raw, same, back = [], [], []
    for a, b in slices(texts):
        r, s = codec.encode([t or "" for t in texts[a:b].to_pylist()])
        raw += r
        same += s
        if decoded:
            back += codec.decode([np.frombuffer(x, "<u4") for x in r])
    offsets = np.cumsum([0, *[len(r) // 4 for r in raw]]).astype(np.int32)
    values = np.frombuffer(b"".join(raw), "<u4").astype(np.int32)
    out = [pa.ListArray.from_arrays(pa.array(offsets), pa.array(values)), pa.array(same, pa.bool_())]
    return [*out, pa.array(back, pa.string())] if decoded else out


def encode(docs: DataFrame, path: str, ids: str = "ids", parity: str = "parity", threads: int = 2,
           decoded: str | None = None) -> DataFrame:
    """`docs` with the ids of each whole text (array of ints) and whether the original library gives the same ones.

    `path` is a model file, or its name among the installed public vocabularies; each worker process loads it.  A null or empty
    text has no ids.  With `decoded`, a column of that name holds the ids read back as text, in the same pass and by the same
    worker.  Nothing is shuffled; other columns pass through, columns of the same names are replaced.
    """
    held = docs.sparkSession.sparkContext.broadcast({})

    def make():
        codec = _codec(held, path, threads)
        return lambda texts: _encoded(codec, texts, decoded is not None)

    back = [(decoded, "string")] if decoded is not None else []
    return appended(docs, ["text"], [(ids, "array<int>"), (parity, "boolean"), *back], make)


def decode(df: DataFrame, path: str, ids: str = "ids", text: str = "decoded", threads: int = 2) -> DataFrame:
    """`df` with the text of each id list; a null list gives a null text, an empty one an empty text."""
    held = df.sparkSession.sparkContext.broadcast({})

    def make():
        codec = _codec(held, path, threads)

        def fn(lists: pa.Array):
            out: list[str | None] = []
            for at in range(0, len(lists), 512):
                some = lists[at:at + 512].to_pylist()
                texts = iter(codec.decode([np.array(x, np.int64) for x in some if x is not None]))
                out += [None if x is None else next(texts) for x in some]
            return [pa.array(out, pa.string())]

        return fn

    return appended(df, [ids], [(text, "string")], make)
