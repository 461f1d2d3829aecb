"""Secret scans with column functions only: three fixed patterns, and two character Markov models compared by log-likelihood ratio."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankflow.llm.common import fresh

# Fixed patterns: (kind, pattern, group whose length counts, least length).
BASE = (
    ("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    ("access", r"AKIA[A-Z0-9]+", 0, 18),
    ("hex", r"[0-9a-f]+", 0, 16),
)
# A run of one class as long as that contains all matches that count, so short ones need not be listed.
LONG_ENOUGH = {"access": r"AKIA[A-Z0-9]{14,}", "hex": r"(?<![0-9a-f])[0-9a-f]{16,}"}
MODEL = "markov"
CANDIDATE = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{16,}"
ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-"
CLASSES = len(ALPHABET) + 1  # 0 is any other sign
_CLASS_OF = [ALPHABET.find(chr(i)) + 1 for i in range(128)]
SPAN = "array<struct<start:bigint,kind:int,end:bigint>>"


def _classes(text: Column) -> Column:
    """The class of each sign of a string."""
    table = F.lit(_CLASS_OF)
    return F.transform(F.split(text, ""), lambda c: F.coalesce(F.get(table, F.ascii(c)), F.lit(0)))


def labelled_samples(docs: DataFrame, rows: int = 2000, digests: int = 4) -> DataFrame:
    """(text, label) to train on, from at most `rows` documents chosen by a hash of their id.

    Label 0 are the documents' words of 4 to 15 letters as ordinary identifiers use them: lower and upper case, capitalised and
    joined by a sign or by case.  Label 1 are random strings: `digests` digests of each word in base 64 and in letters and
    digits.  Hexadecimal digits are the fixed patterns' business.
    """
    chosen = docs.where("doc_id IS NOT NULL").select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    words = F.regexp_extract_all("text", F.lit(r"(?<![A-Za-z])[A-Za-z]{4,15}(?![A-Za-z])"), F.lit(0))
    word = docs.join(F.broadcast(chosen), "doc_id", "left_semi").select(F.explode(F.array_distinct(words)).alias("w")).distinct()
    low = F.lower("w")
    other = F.lower(F.reverse("w"))
    n = F.pmod(F.xxhash64("w"), F.lit(6))
    name = (F.when(n == 0, F.concat(low, F.lit("_"), low)).when(n == 1, F.upper("w"))
            .when(n == 2, F.concat(F.upper("w"), F.lit("_"), F.upper("w"))).when(n == 3, F.concat(low, F.initcap(low)))
            .when(n == 4, F.concat(low, F.lit("/"), low, F.lit("-"), low)).otherwise(low))
    digest = F.base64(F.unhex(F.sha2(F.concat("w", other, F.col("k").cast("string")), 256)))
    drawn = word.withColumn("k", F.explode(F.sequence(F.lit(1), F.lit(digests))))
    return word.select(name.alias("text"), F.lit(0).alias("label")).union(
        drawn.select(F.when(n < 3, digest).otherwise(F.regexp_replace(digest, "[+/=]", "")).alias("text"), F.lit(1).alias("label")))


def train_markov(samples: DataFrame, smoothing: float = 0.5) -> list[float]:
    """log P(b | a, random) - log P(b | a, ordinary) for every pair of sign classes, as one flat list.

    The counts are aggregated in Spark; at most classes^2 rows per label reach the driver, whatever the samples.  Null and one-sign
    samples teach nothing; without samples every ratio is 0.
    """
    codes = samples.where("text IS NOT NULL AND label IS NOT NULL").select("label", _classes(F.col("text")).alias("c"))
    pairs = codes.select("label", F.explode(F.zip_with(F.slice("c", 1, F.greatest(F.size("c") - 1, F.lit(0))),
                                                       F.slice("c", 2, F.greatest(F.size("c") - 1, F.lit(0))),
                                                       lambda a, b: a * CLASSES + b)).alias("p"))
    counts = {(r.label, r.p): r.n for r in pairs.groupBy("label", "p").agg(F.count(F.lit(1)).alias("n")).collect()}
    logs = []
    for label in (0, 1):
        rows = []
        for a in range(CLASSES):
            row = [counts.get((label, a * CLASSES + b), 0) + smoothing for b in range(CLASSES)]
            total = math.log(sum(row))
            rows.extend(math.log(x) - total for x in row)
        logs.append(rows)
    return [round(r - o, 6) for o, r in zip(*logs, strict=True)]


def log_ratio(token: Column, model: list[float]) -> Column:
    """Log-likelihood ratio of a string under the two models, random against ordinary."""
    table = F.lit(model)
    codes = _classes(token)
    pairs = F.zip_with(F.slice(codes, 1, F.size(codes) - 1), F.slice(codes, 2, F.size(codes) - 1), lambda a, b: a * CLASSES + b)
    return F.aggregate(pairs, F.lit(0.0), lambda s, p: s + F.get(table, p))


def _spans(found: Column, gaps: Column, kind: int, keep: Column) -> Column:
    """Spans of the matches `found` that `keep` (an array of booleans) marks; `gaps` are the pieces of text between them."""
    pieces = F.zip_with(F.zip_with(found, F.slice(gaps, 1, F.size(found)), lambda m, g: F.struct(
        F.length(m).cast("long").alias("m"), F.length(g).cast("long").alias("g"))), keep,
        lambda x, k: F.struct(x["m"].alias("m"), x["g"].alias("g"), k.alias("k")))
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(SPAN).alias("out"))

    def add(acc: Column, x: Column) -> Column:
        begin, end = acc["at"] + x["g"], acc["at"] + x["g"] + x["m"]
        span = F.array(F.struct(begin.alias("start"), F.lit(kind).alias("kind"), end.alias("end")))
        return F.struct(end.alias("at"), F.when(x["k"], F.concat(acc["out"], span)).otherwise(acc["out"]).alias("out"))

    return F.when(F.size(found) > 0, F.aggregate(pieces, start, add, lambda acc: acc["out"])).otherwise(F.array().cast(SPAN))


def _at_least(n: int):
    return lambda value: F.length(value) >= n


def find_secrets(docs: DataFrame, model: list[float], least_ratio: float = 12.0, least_mean: float = 0.6) -> DataFrame:
    """`docs` with `base` and `spans`: arrays of (start, kind, end), sorted; offsets in code points, end exclusive.

    Kinds 0 to 2 are the fixed patterns, leftmost and not overlapping within a kind; kind 3 are runs of 16 or more signs of the
    base-64 alphabets whose log-likelihood ratio reaches `least_ratio` in all and `least_mean` per step, unless a base span
    overlaps them.  A null text is empty and has no spans.  Row by row, in column functions; nothing is shuffled.  Columns called
    `base` or `spans` already are replaced, all others pass through.
    """
    docs = docs.drop("base", "spans")
    columns = docs.columns
    name = lambda n: fresh(f"__{n}", columns)
    text = F.coalesce(F.col("text"), F.lit(""))
    df = docs
    for i, (kind, pattern, group, least) in enumerate(BASE):
        listed = LONG_ENOUGH.get(kind, pattern)
        f, g, k = name(f"found{i}"), name(f"gaps{i}"), name(f"value{i}")
        df = df.withColumn(f, F.regexp_extract_all(text, F.lit(listed), F.lit(0)))
        some = F.size(F.col(f)) > 0
        df = df.withColumns({g: F.when(some, F.split(text, listed, -1)),
                             k: F.when(some, F.regexp_extract_all(text, F.lit(listed), F.lit(group))) if group else F.col(f)})
        keep = F.transform(F.col(k), _at_least(least))
        df = df.withColumn(name(f"spans{i}"), _spans(F.col(f), F.col(g), i, keep)).drop(f, g, k)
    df = df.withColumn("base", F.array_sort(F.concat(*[F.col(name(f"spans{i}")) for i in range(len(BASE))])))
    df = df.drop(*[name(f"spans{i}") for i in range(len(BASE))])
    f, g, r, s = name("found"), name("gaps"), name("ratios"), name("model")
    df = df.withColumn(f, F.regexp_extract_all(text, F.lit(CANDIDATE), F.lit(0)))
    df = df.withColumn(g, F.when(F.size(F.col(f)) > 0, F.split(text, CANDIDATE, -1)))
    df = df.withColumn(r, F.transform(F.col(f), lambda t: F.struct(log_ratio(t, model).alias("x"), F.length(t).alias("n"))))
    random = F.transform(F.col(r), lambda x: (x["x"] >= least_ratio) & (x["x"] >= least_mean * (x["n"] - 1)))
    df = df.withColumn(s, _spans(F.col(f), F.col(g), len(BASE), random)).drop(f, g, r)
    free = F.filter(F.col(s), lambda m: ~F.exists(F.col("base"), lambda b: (b["start"] < m["end"]) & (m["start"] < b["end"])))
    return df.withColumn("spans", F.array_sort(F.concat("base", free))).drop(s).select(*[F.col(f"`{c}`") for c in columns], "base",
                                                                                      "spans")


def listed(spans: str) -> Column:
    """kind:start:end of each span, joined by commas."""
    names = F.array(*[F.lit(k) for k in (*[b[0] for b in BASE], MODEL)])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"),
                                                                 s["end"].cast("string"))), ",")


def redact(docs: DataFrame, model: list[float], mark: str = "[SECRET]") -> DataFrame:
    """`docs` with every span of the text replaced by `mark`; overlapping spans become one mark.

    All rows stay; texts without spans, null ones included, stay as they are.
    """
    columns = docs.columns
    inner = docs.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"), F.col("text"))
    found = find_secrets(inner, model)
    empty = F.array().cast("array<struct<start:bigint,end:bigint>>")

    def join(acc: Column, s: Column) -> Column:
        last = F.element_at(acc, -1)
        own = F.array(F.struct(s["start"].alias("start"), s["end"].alias("end")))
        grown = F.array(F.struct(last["start"].alias("start"), F.greatest(last["end"], s["end"]).alias("end")))
        return F.when((F.size(acc) > 0) & (s["start"] < last["end"]),
                      F.concat(F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))), grown)).otherwise(F.concat(acc, own))

    merged = found.withColumn("merged", F.when(F.size("spans") > 0, F.aggregate("spans", empty, join)))
    nothing = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<string>").alias("out"))
    cut = lambda begin, n: F.substring(F.col("text"), begin + 1, n)
    kept = F.aggregate("merged", nothing, lambda acc, s: F.struct(
        s["end"].alias("at"), F.concat(acc["out"], F.array(cut(acc["at"].cast("int"), (s["start"] - acc["at"]).cast("int")), F.lit(mark))
                                       ).alias("out")),
        lambda acc: F.array_join(F.concat(acc["out"], F.array(cut(acc["at"].cast("int"), F.lit(2147483647)))), ""))
    clean = F.when(F.size("spans") > 0, kept).otherwise(F.col("text"))
    return merged.select(*[clean.alias(c) if c == "text" else F.col(f"row.`{c}`").alias(c) for c in columns])
