"""Spelling variants: words one edit apart, each with the more frequent form that it stands for.

Asymmetric chunks.  Of two words one edit apart, the one that is not longer contributes two disjoint chunks, its halves; the other
contributes its positional grams of the chunks' lengths.  One edit leaves one chunk whole, and it stands in the other word at the
same place or, after an insertion before it, one further: these are the grams that can join, and no others are written.  What
lies beside the preserved chunk is one edit apart as well, so it is cut into two chunks again, and a key holds the chunk together with
the part of the rest that is preserved: about three quarters of a word.  Words that share a key differ in a quarter of their length only,
so a common half, such as an ending, never gathers all its words in one group.  Every joined pair is verified.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankflow.session import written

# Runs of letters, read as Latin-1 with A-Z in lower case: one byte per code point.
_RUN = re.compile(rb"[a-z\xC0-\xFF]+")
_BETWEEN = re.compile(rb"[^a-z\xC0-\xFF]")
SLICE = 1 << 20  # code points of a text that are counted together
HELD_WORDS = 200_000  # different words that a task holds before it passes their counts on
HELD_POINTS = 32 << 20  # code points that they may come from


def _slices(text: bytes) -> Iterator[bytes]:
    """Consecutive parts of a text that cut no run of letters."""
    at = 0
    while len(text) - at > SLICE:
        found = _BETWEEN.search(text, at + SLICE)
        end = found.start() if found else len(text)
        yield text[at:end]
        at = end
    yield text[at:] if at else text


def _misspelt(run: bytes, seed: int, modulus: int) -> bytes:
    """The run; if `modulus` divides its crc32, without the code point at crc32 % length."""
    h = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), seed)
    if h % modulus:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1:]


def count_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_points: int = 5, min_count: int = 3,
                typo_modulus: int | None = None) -> DataFrame:
    """(word, n): the runs of `[A-Za-z\\u00C0-\\u00FF]` of all texts, A-Z in lower case, of at least `min_points` code points that occur
    `min_count` times or more.

    With `typo_modulus` misspellings are planted, the same in every run and retry: where it divides the crc32 of
    `<id>:<run>`, the run loses the code point at crc32 % length.  A null id counts as an empty one.  Null and empty texts hold no words;
    repeated rows count each.  A task counts slices of texts and passes on partial counts before it holds too many words; these are
    summed before and after the shuffle, so a word in every text is no hot key.
    """
    source = docs.select(F.col(f"`{id_col}`").cast("string").alias("id"), F.col(f"`{text_col}`").alias("text")).where("text IS NOT NULL")

    def rows(total: Counter) -> pa.RecordBatch:
        words = [w for w in total if len(w) >= min_points]
        return pa.RecordBatch.from_arrays([pa.array([w.decode("latin-1") for w in words], pa.string()),
                                           pa.array([total[w] for w in words], pa.int64())], names=["word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        points = 0
        for batch in batches:
            for i, text in zip(batch.column(0), batch.column(1)):
                # code points beyond U+00FF become question marks, which are no letters either
                folded = text.as_py().encode("latin-1", "replace").lower()
                seed = zlib.crc32(f"{i.as_py() or ''}:".encode())
                for part in _slices(folded):
                    found = _RUN.findall(part)
                    if typo_modulus:
                        for word, n in Counter(found).items():
                            total[_misspelt(word, seed, typo_modulus)] += n
                    else:
                        total.update(found)
                    points += len(part)
                    if len(total) > HELD_WORDS or points > HELD_POINTS:
                        yield rows(total)
                        total, points = Counter(), 0
        yield rows(total)

    return source.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


def _key(length: Column, kind: int, *parts: Column) -> Column:
    return F.xxhash64(length, F.lit(kind), *parts)


def _keys(word: Column, length: Column, insertion: int) -> Column:
    """Four keys, one for each quarter in which the edit may lie, of a word against words of `length` code points.

    The quarters are those of the shorter word.  `insertion` is 0 for words of equal length, 1 for a word with one code point more: what stands
    after the edit is then read one place further on.
    """
    half = F.floor(length / 2).cast("int")
    cuts = [F.lit(0), F.floor(half / 2).cast("int"), half, (half + F.floor((length - half) / 2)).cast("int"), length]

    def gram(a: int, b: int, shift: int) -> Column:
        return F.substr(word, cuts[a] + (shift + 1), cuts[b] - cuts[a])

    # the preserved chunk, and the preserved part of the other half; substr reads nothing where a part is empty
    return F.array(_key(length, 0, gram(2, 4, insertion), gram(1, 2, insertion)), _key(length, 1, gram(2, 4, insertion), gram(0, 1, 0)),
                   _key(length, 2, gram(0, 2, 0), gram(3, 4, insertion)), _key(length, 3, gram(0, 2, 0), gram(2, 3, 0)))


def near_pairs(words: DataFrame) -> DataFrame:
    """(a, a_n, b, b_n): every two of the distinct `words` (word, n) that differ by exactly one inserted, deleted or replaced code point,
    once, the one that is not longer first (of equal length: the smaller in code-point order).

    Words shorter than four code points have empty quarters: their keys are shorter, the result is the same.
    """
    size = F.length("word")
    chunks = words.select(F.col("word").alias("a"), F.col("n").alias("a_n"), F.explode(_keys(F.col("word"), size, 0)).alias("key"))
    grams = words.select(F.col("word").alias("b"), F.col("n").alias("b_n"),
                         F.explode(F.concat(_keys(F.col("word"), size, 0), _keys(F.col("word"), size - 1, 1))).alias("key"))
    ordered = (F.length("a") < F.length("b")) | ((F.length("a") == F.length("b")) & (F.col("a") < F.col("b")))
    joined = chunks.hint("shuffle_merge").join(grams, "key").where(ordered & (F.levenshtein("a", "b", 1) == 1))
    # a letter inserted beside its like can be seen in two quarters
    return joined.select("a", "a_n", "b", "b_n").distinct()


def spelling_variants(words: DataFrame, ratio: int = 2) -> DataFrame:
    """(word, n, n_near, form, form_n, root) for distinct `words` (word, n).

    n_near counts the words one edit away.  The form is the most frequent of them (ties: the smallest in code-point order) if it
    occurs at least `ratio` times as often, else null; root is where the chain of forms ends, the word itself without a form.
    """
    words = written(words.select("word", "n"), "words")
    pairs = near_pairs(words)
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("near"), F.col("b_n").alias("near_n")).union(
        pairs.select("b", "a", "a_n"))
    best = both.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("order"), "near")).alias("best"))
    found = words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(-F.col("best.order") >= ratio * F.col("n"), F.col("best.near")).alias("form"),
        F.when(-F.col("best.order") >= ratio * F.col("n"), -F.col("best.order")).alias("form_n"))
    found = written(found, "forms")
    return found.join(_roots(found), "word", "left").withColumn("root", F.coalesce("root", "word"))


def _roots(found: DataFrame) -> DataFrame:
    """(word, root) for words with a form: each round every word jumps to where its target points, so chains halve.

    Counts grow along a chain, so it has no loop.  Few words can have one form, as one edit leads to few words, so no target is a hot key.
    """
    jump = written(found.where("form IS NOT NULL").select("word", F.col("form").alias("root")), "roots")
    while True:
        on = jump.select(F.col("word").alias("root"), F.col("root").alias("next"))
        jump = written(jump.join(on, "root", "left").select("word", F.coalesce("next", "root").alias("root"),
                                                            F.col("next").isNotNull().alias("moved")), "roots")
        if jump.where("moved").isEmpty():
            return jump.select("word", "root")
        jump = jump.select("word", "root")
