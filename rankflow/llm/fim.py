"""Fill-in-middle transformation: texts are cut in three and their parts put in the order that a model learns to fill in.

The bytes of a whole batch are moved at once.  A scan finds where units start and where the cuts fall; every part of a text
then has one displacement, so a difference array over the batch, summed up, gives every byte its place in the outputs, and a
scatter writes them.  The inverse reads the outputs alone: it finds the markers, forms the same displacements and gathers.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from rankflow.llm.common import by_bytes, fresh

# The markers before each part, and the codes of the three forms.
MARKERS = {"P": b"<P>", "S": b"<S>", "M": b"<M>"}
FORMS = ("plain", "psm", "spm")
PLAIN, PSM, SPM = range(3)
# The parts (0 prefix, 1 middle, 2 suffix) in the order of the output.
ORDER = {PSM: (0, 2, 1), SPM: (2, 0, 1)}

CHUNK = 1 << 20  # bytes whose places are worked out together
SLICE = 4 << 20  # bytes of texts that become outputs together; a longer text stands alone


class Buffer(NamedTuple):
    """Texts one after another: `data` holds their bytes, text i lies at offsets[i]:offsets[i + 1]."""
    data: np.ndarray
    offsets: np.ndarray


def as_buffer(texts: pa.Array) -> Buffer:
    """The bytes of an Arrow array of strings, without a copy; a null takes no bytes."""
    texts = texts.cast(pa.large_binary())
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return Buffer(data[offsets[0]:offsets[-1]], offsets - offsets[0])


def as_strings(buffer: Buffer) -> pa.Array:
    return pa.LargeStringArray.from_buffers(len(buffer.offsets) - 1, pa.py_buffer(np.ascontiguousarray(buffer.offsets)),
                                            pa.py_buffer(buffer.data)).cast(pa.string())


def _chunks(buffer: Buffer) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first byte, last byte, whether a unit starts there, whether a code point does) for chunk after chunk.

    A unit is a run of A-Z and a-z, or one other code point.
    """
    data, offsets = buffer
    before = False  # whether the byte before the chunk is a letter
    for a in range(0, len(data), CHUNK):
        b = min(a + CHUNK, len(data))
        part = data[a:b]
        letter = ((part | 32) - np.uint8(97)) < 26
        follows = np.empty(b - a, bool)
        follows[0], follows[1:] = before, letter[:-1]
        first = offsets[np.searchsorted(offsets, a):np.searchsorted(offsets, b)]
        follows[first - a] = False  # a text's first byte follows nothing
        point = (part & 0xC0) != 0x80
        before = bool(letter[-1])
        yield a, b, point & ~(letter & follows), point


def _before(buffer: Buffer, places: np.ndarray, points: bool = False) -> np.ndarray:
    """How many units (or code points) of the batch start before each of the sorted `places`."""
    out = np.zeros(len(places), np.int64)
    total = 0
    for a, b, unit, point in _chunks(buffer):
        counted = np.cumsum(point if points else unit, dtype=np.int64)
        i, j = np.searchsorted(places, a, "right"), np.searchsorted(places, b, "right")
        out[i:j] = total + counted[places[i:j] - a - 1]
        total += int(counted[-1])
    return out


def _starts(buffer: Buffer, ranks: np.ndarray) -> np.ndarray:
    """The place where the unit with each of the sorted `ranks` (from 0, over the batch) starts; the end for ranks beyond."""
    out = np.full(len(ranks), len(buffer.data), np.int64)
    total = 0
    for a, _, unit, _ in _chunks(buffer):
        at = np.flatnonzero(unit)
        i, j = np.searchsorted(ranks, total), np.searchsorted(ranks, total + len(at))
        out[i:j] = a + at[ranks[i:j] - total]
        total += len(at)
    return out


def _places(starts: np.ndarray, shifts: np.ndarray, size: int) -> Iterator[tuple[int, int, np.ndarray]]:
    """(first byte, last byte, place of every byte in the output) for chunk after chunk.

    `starts` are the sorted first bytes of parts, empty ones too, and `shifts` their displacements: the differences are
    filed at the starts and summed up.
    """
    change = np.diff(shifts, prepend=0)
    carry = 0
    for a in range(0, size, CHUNK):
        b = min(a + CHUNK, size)
        i, j = np.searchsorted(starts, a), np.searchsorted(starts, b)
        step = np.ones(b - a, np.int64)  # a byte without a change lies one further than the byte before
        step[0] = a + carry
        np.add.at(step, starts[i:j] - a, change[i:j])
        carry += int(change[i:j].sum())
        yield a, b, np.cumsum(step)


def count_units(buffer: Buffer) -> np.ndarray:
    return np.diff(_before(buffer, buffer.offsets))


class Cut(NamedTuple):
    """Transformed texts, and the code points of their prefixes and middles."""
    output: Buffer
    prefix: np.ndarray
    middle: np.ndarray


def _layout(sizes: np.ndarray, form: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first byte of every part in the outputs, of every marker, offsets of the outputs) from the parts' sizes.

    The markers of a plain text lie at -1.
    """
    parts = np.zeros(sizes.shape, np.int64)
    marks = np.full(sizes.shape, -1, np.int64)
    marker = len(MARKERS["P"])
    total = sizes.sum(1) + np.where(form == PLAIN, 0, 3 * marker)
    offsets = np.concatenate(([0], np.cumsum(total)))
    plain = form == PLAIN
    parts[plain] = offsets[:-1][plain, None] + np.cumsum(sizes[plain], 1) - sizes[plain]
    for code, order in ORDER.items():
        rows = form == code
        at = offsets[:-1][rows]
        for k in order:
            marks[rows, k] = at
            parts[rows, k] = at + marker
            at = at + marker + sizes[rows, k]
    return parts, marks, offsets


def transform(buffer: Buffer, form: np.ndarray, low: np.ndarray, high: np.ndarray) -> Cut:
    """The outputs: prefix up to `low` units, middle up to `high`, both counted from the start of the text."""
    first, last = buffer.offsets[:-1], buffer.offsets[1:]
    base = _before(buffer, buffer.offsets)[:-1]
    ranks = np.stack([base + low, base + high], 1).reshape(-1)
    # a cut after all units of a text would find the next text's first unit, past an empty one too: it ends this text
    cuts = np.minimum(_starts(buffer, ranks).reshape(-1, 2), last[:, None])
    bounds = np.column_stack([first, cuts, last])
    sizes = np.diff(bounds, axis=1)
    parts, marks, offsets = _layout(sizes, form)
    data = np.zeros(offsets[-1], np.uint8)
    starts = bounds[:, :3].reshape(-1)
    for a, b, place in _places(starts, parts.reshape(-1) - starts, len(buffer.data)):
        data[place] = buffer.data[a:b]
    for k, name in enumerate("PMS"):
        at = marks[form != PLAIN, k]
        for i, byte in enumerate(MARKERS[name]):
            data[at + i] = byte
    points = np.diff(_before(buffer, bounds.reshape(-1), points=True).reshape(-1, 4), axis=1)
    return Cut(Buffer(data, offsets), points[:, 0], points[:, 1])


def restore(output: Buffer, form: np.ndarray) -> Buffer:
    """The texts, from the outputs and their forms alone."""
    marker = len(MARKERS["P"])
    first, last = output.offsets[:-1], output.offsets[1:]
    bounds = np.column_stack([first, first, first, first])  # where P, M, S lie in the output
    for k, name in enumerate("PMS"):
        at = _find(output, MARKERS[name], form != PLAIN)
        bounds[form != PLAIN, k] = at
    starts, sizes = np.zeros((len(form), 3), np.int64), np.zeros((len(form), 3), np.int64)
    plain = form == PLAIN
    starts[plain], sizes[plain, 0] = first[plain, None], (last - first)[plain]
    for code, order in ORDER.items():
        rows = form == code
        ends = [bounds[rows, k] for k in order[1:]] + [last[rows]]
        for k, end in zip(order, ends):
            starts[rows, k] = bounds[rows, k] + marker
            sizes[rows, k] = end - starts[rows, k]
    total = sizes.sum(1)
    offsets = np.concatenate(([0], np.cumsum(total)))
    targets = offsets[:-1, None] + np.cumsum(sizes, 1) - sizes
    data = np.empty(offsets[-1], np.uint8)
    targets = targets.reshape(-1)
    for a, b, place in _places(targets, starts.reshape(-1) - targets, len(data)):
        data[a:b] = output.data[place]
    return Buffer(data, offsets)


def _find(buffer: Buffer, marker: bytes, wanted: np.ndarray) -> np.ndarray:
    """The first place of `marker` in each of the `wanted` texts, which must hold it."""
    data, found, size = buffer.data, [], len(marker)
    for a in range(0, len(data) - size + 1, CHUNK):
        b = min(a + CHUNK, len(data) - size + 1)
        hit = np.ones(b - a, bool)
        for i, byte in enumerate(marker):
            hit &= data[a + i:b + i] == byte
        found.append(a + np.flatnonzero(hit))
    places = np.concatenate(found) if found else np.zeros(0, np.int64)
    first, last = buffer.offsets[:-1][wanted], buffer.offsets[1:][wanted]
    if not len(places):
        places = np.zeros(1, np.int64) - 1
    at = places[np.minimum(np.searchsorted(places, first), len(places) - 1)]
    if ((at < first) | (at + size > last)).any():
        raise ValueError(f"an output lacks its marker {marker.decode()}")
    return at


def hash_group(id_col: str, group: int, prefix: str = "1:") -> Column:
    """8-digit group number `group` (from 1) of the hex sha256 of the prefix and the decimal id, unsigned; a null id has no digits."""
    text = F.concat(F.lit(prefix), F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")))
    return F.conv(F.substring(F.sha2(text, 256), 8 * group - 7, 8), 16, 10).cast("long")


def fill_in_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", plain_percent: int = 10,
                   spm_percent: int = 20) -> DataFrame:
    """`docs` with `n`, `form`, `prefix_chars`, `middle_chars`, `output` and `restored` (columns of these names are replaced).

    n counts the units of the text, a null text counts as empty.  Cuts and form follow from the sha256 of the id, so repeated
    rows and retries give the same outputs and rows of equal id are cut by the same numbers; a null id is hashed as no digits.
    An empty text, a text that holds a marker, and `plain_percent` of all ids stay plain, with null lengths; `spm_percent` of the
    others put the suffix first.  `restored` is made from output and form alone.  No shuffle; outputs are built from at most
    SLICE bytes of texts together, and a longer text, which stands alone, is worked through in chunks.
    """
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    made = ("n", "form", "prefix_chars", "middle_chars", "output", "restored")
    passed = [f for f in docs.schema.fields if f.name.lower() not in made]
    names = [f.name for f in passed]
    h1, h2, h3, h4 = (hash_group(id_col, g) for g in (1, 2, 3, 4))
    plain = (text == "") | text.rlike("<[PSM]>") | (h3 % 100 >= 100 - plain_percent)
    code = F.when(plain, PLAIN).when(h4 % 100 < spm_percent, SPM).otherwise(PSM)
    given = fresh("__in", names + list(made))
    source = docs.select(*[F.col(f"`{n}`") for n in names],
                         F.struct(text.alias("text"), code.cast("int").alias("form"), h1.alias("h1"), h2.alias("h2")).alias(given))
    schema = StructType(passed + [StructField("n", LongType()), StructField("form", StringType()),
                                  StructField("prefix_chars", LongType()), StructField("middle_chars", LongType()),
                                  StructField("output", StringType()), StructField("restored", StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            texts = batch.column(batch.schema.get_field_index(given)).field("text")
            sizes = np.diff(as_buffer(texts).offsets)
            for i, j in by_bytes(map(range, sizes.tolist()), SLICE):
                part = batch.slice(i, j - i)
                yield pa.RecordBatch.from_arrays(
                    [part.column(k) for k in range(len(names))] + _columns(part.column(part.schema.get_field_index(given))),
                    names=names + list(made))

    return source.mapInArrow(run, schema)


def _columns(given: pa.StructArray) -> list[pa.Array]:
    texts, form, h1, h2 = given.flatten()
    form = form.to_numpy(zero_copy_only=False)
    buffer = as_buffer(texts)
    n = count_units(buffer)
    a, b = (h.to_numpy(zero_copy_only=False) % (n + 1) for h in (h1, h2))
    cut = transform(buffer, form, np.minimum(a, b), np.maximum(a, b))
    back = restore(cut.output, form)
    plain = form == PLAIN
    return [pa.array(n), pa.array(np.array(FORMS, object)[form], pa.string()), pa.array(cut.prefix, mask=plain),
            pa.array(cut.middle, mask=plain), as_strings(cut.output), as_strings(back)]
