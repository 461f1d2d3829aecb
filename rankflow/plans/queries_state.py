"""Queries over vocabularies, rank maps, embedding tables and optimizer state."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankflow.functions.text import boundaries_text
from rankflow.operators import embed, optimizer, samples, vocab
from rankflow.operators.layout import for_heavy_work
from rankflow.operators.metrics import daily_counts
from rankflow.plans.catalog import digest, digest_sql, on, query
from rankflow.plans.queries_samples import REGISTRY, labelled
from rankflow.plans.views import samples_view, table
from rankflow.registry import Registry
from rankflow.session import new_path, written
from rankflow.sources import bucketed, state

SCALARS = ["book_id", "mbid", "gender", "language", "vip_type", "gap_day", "userid"]
LISTS = ["tag_set", "userClickBookListLatestBookId", "userClickBookListLatestGapDay", "userClickBookListLatestGender"]
# Smaller capacities than the default ones, so that some vocabularies overflow.
LIMITS = {"bid": 150, "gap_day": 60, "userid": 120, "gender": 4, "tagv3": 1001, "language": 201, "is_vip": 4}


def small_registry() -> Registry:
    wanted = [REGISTRY[n] for n in SCALARS + LISTS]
    return Registry(replace(f, vocab_size=min(f.vocab_size, LIMITS[f.emb_name])) for f in wanted)


def member_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = samples.canonical_names(labelled(spark, sf_dir), REGISTRY)
    return for_heavy_work(df.select("sample_id", "dt", *SCALARS, *LISTS))


def vocabulary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Built in two runs: the days up to the tenth first, then everything."""
    registry, rows = small_registry(), member_rows(spark, sf_dir)
    capacities = registry.capacities()
    first = vocab.vocab_values(rows.where("dt <= '2024-01-10'"), registry, "sample_id")
    known = written(vocab.extend_vocab(first, vocab.empty_vocab(spark), capacities), "vocab")
    return vocab.extend_vocab(vocab.vocab_values(rows, registry, "sample_id"), known, capacities)


def _scalar_sql(col: str, emb: str) -> str:
    return f"SELECT sample_id, dt, '{emb}' AS emb_name, lower(coalesce(cast({col} AS VARCHAR), 'unknown')) AS value FROM labelled"


def _item_sql(emb: str) -> str:
    clamped = "CASE WHEN x = '' THEN '' ELSE cast(least(try_cast(x AS INT), 190) AS VARCHAR) END"
    return clamped if emb == "gap_day" else "x"


def _list_sql(col: str, emb: str) -> str:
    return (f"SELECT sample_id, dt, '{emb}' AS emb_name, {_item_sql(emb)} AS value FROM "
            f"(SELECT sample_id, dt, unnest(string_split(replace({col}, '_', ','), ',')) AS x FROM labelled)")


_MEMBERS = " UNION ALL ".join([_scalar_sql(c, REGISTRY[c].emb_name) for c in SCALARS]
                              + [_list_sql(c.lower(), REGISTRY[c].emb_name) for c in LISTS])
_CAPACITY = "CASE emb_name " + " ".join(f"WHEN '{e}' THEN {n}" for e, n in small_registry().capacities().items()) + " END"
_VOCAB = {
    "members": _MEMBERS,
    "pairs": "SELECT emb_name, value, min(sample_id) AS seen, min(CASE WHEN dt <= '2024-01-10' THEN sample_id END) AS early "
             "FROM members WHERE trim(value) <> '' GROUP BY 1, 2",
    "numbered": "SELECT *, early IS NULL AS late, row_number() OVER (PARTITION BY emb_name ORDER BY early IS NULL, early, seen, value) AS rn FROM pairs",
    "firsts": f"SELECT emb_name, max(rn) AS highest FROM numbered WHERE NOT late AND rn < {_CAPACITY} GROUP BY 1",
    # after an overflow in the first run there is no room in the second, so one numbering serves both
    "vocab": f"SELECT emb_name, value, CASE WHEN rn < {_CAPACITY} THEN rn ELSE 0 END AS id FROM numbered",
}


@query("f1_extend_vocab", on("labelled", "SELECT emb_name, value, id FROM vocab", **_VOCAB))
def extended(spark, sf_dir):
    return vocabulary(spark, sf_dir)


@query("f2_shared_vocab_values", on("labelled", "SELECT emb_name, value, seen AS first_seen FROM pairs", **_VOCAB))
def shared_values(spark, sf_dir):
    return vocab.vocab_values(member_rows(spark, sf_dir), small_registry(), "sample_id")


_IDS = ", ".join(f"coalesce((SELECT id FROM vocab v WHERE v.emb_name = '{REGISTRY[c].emb_name}' AND v.value = lower(coalesce(cast({c} AS VARCHAR), 'unknown'))), 0) AS {c}"
                 for c in SCALARS)


@query("f3_encode_scalar", on("labelled", f"SELECT sample_id, {_IDS} FROM labelled", **_VOCAB))
def scalar_ids(spark, sf_dir):
    words = written(vocabulary(spark, sf_dir), "vocab")
    rows = member_rows(spark, sf_dir).select("sample_id", *SCALARS)
    return vocab.encode_scalar(rows, words, small_registry().group("sparse"), "sample_id")


@query("f3_encode_scalar_by_join", on("labelled", f"SELECT sample_id, {_IDS} FROM labelled", **_VOCAB))
def scalar_ids_by_join(spark, sf_dir):
    words = written(vocabulary(spark, sf_dir), "vocab")
    rows = member_rows(spark, sf_dir).select("sample_id", *SCALARS)
    return vocab.encode_scalar_by_join(rows, words, small_registry().group("sparse"), "sample_id")


def _list_ids_sql() -> str:
    parts = []
    for c in LISTS:
        emb, n = REGISTRY[c].emb_name, REGISTRY[c].maxlen
        parts.append(f"""SELECT sample_id, '{c}' AS feature, array_to_string(list_transform(range(1, {n + 1}), lambda i: coalesce(ids[i], 0)), ',') AS ids
          FROM (SELECT l.sample_id, list(coalesce(v.id, 0) ORDER BY pos) FILTER (pos IS NOT NULL) AS ids FROM labelled l
            LEFT JOIN (SELECT sample_id, {_item_sql(emb)} AS value, pos FROM (SELECT sample_id, unnest(xs) AS x, unnest(range(1, len(xs) + 1)) AS pos
              FROM (SELECT sample_id, string_split(replace({c.lower()}, '_', ','), ',') AS xs FROM labelled))) e USING (sample_id)
            LEFT JOIN vocab v ON v.emb_name = '{emb}' AND v.value = e.value GROUP BY l.sample_id)""")
    return " UNION ALL ".join(parts)


def _list_texts(df: DataFrame) -> DataFrame:
    pairs = F.array(*[F.struct(F.lit(c).alias("feature"), F.array_join(F.col(c).cast("array<string>"), ",").alias("ids")) for c in LISTS])
    return df.select("sample_id", F.explode(pairs).alias("p")).select("sample_id", "p.*")


@query("f4_encode_list", on("labelled", _list_ids_sql(), **_VOCAB))
def list_ids(spark, sf_dir):
    words = written(vocabulary(spark, sf_dir), "vocab")
    rows = member_rows(spark, sf_dir).select("sample_id", *LISTS)
    return _list_texts(vocab.encode_list(rows, words, small_registry().group("sequence"), "sample_id"))


@query("f4_encode_list_by_join", on("labelled", _list_ids_sql(), **_VOCAB))
def list_ids_by_join(spark, sf_dir):
    words = written(vocabulary(spark, sf_dir), "vocab")
    rows = member_rows(spark, sf_dir).select("sample_id", *LISTS)
    return _list_texts(vocab.encode_list_by_join(rows, words, small_registry().group("sequence"), "sample_id"))


@query("f5_oov_report", on("labelled", "SELECT emb_name, count(*) AS refused FROM vocab WHERE id = 0 GROUP BY 1", **_VOCAB))
def refused(spark, sf_dir):
    return vocab.oov_report(vocabulary(spark, sf_dir))


_META = " UNION ALL ".join(
    f"SELECT '{f.name}' AS name, '{f.emb_name}' AS emb_name, '{'sequence' if f.group == 'sequence' else 'category'}' AS feature_set, "
    f"{f.maxlen if f.group == 'sequence' else 'NULL'} AS seq_size" for f in small_registry().features)


@query("f6_feature_meta", on("labelled", """SELECT m.name, m.emb_name, m.feature_set, cast(m.seq_size AS INT) AS seq_size, c.words
FROM meta m JOIN (SELECT emb_name, count(*) AS words FROM pairs GROUP BY 1) c USING (emb_name)""", meta=_META, **_VOCAB))
def meta(spark, sf_dir):
    values = vocab.vocab_values(member_rows(spark, sf_dir), small_registry(), "sample_id")
    words = values.groupBy("emb_name").agg(F.count(F.lit(1)).alias("words"))
    return vocab.feature_meta(small_registry(), spark).join(words, "emb_name").select("name", "emb_name", "feature_set", "seq_size", "words")


@query("a7_feature_map", on("labelled", "SELECT emb_name, value, id FROM vocab", **_VOCAB))
def feature_map(spark, sf_dir):
    path = new_path(spark, "feature_map")
    missing = state.read_feature_map(spark, path)
    state.write_feature_map(missing.unionByName(vocabulary(spark, sf_dir)), path)
    return state.read_feature_map(spark, path)


# --- G: counts and ranks -------------------------------------------------------------------------

RANKED = {"mchid": 12, "model": 25}
_COUNTS = {"counts": " UNION ALL ".join(
    f"SELECT '{c}' AS feature, {c} AS value, count(*) AS cnt FROM labelled WHERE {c} IS NOT NULL AND {c} <> '' GROUP BY 2" for c in RANKED)}
_RANKS = {**_COUNTS, "ranks": "SELECT feature, value, rn AS id FROM (SELECT *, row_number() OVER (PARTITION BY feature ORDER BY cnt DESC, value) AS rn FROM counts) "
          "WHERE rn <= CASE feature " + " ".join(f"WHEN '{f}' THEN {n}" for f, n in RANKED.items()) + " END"}


def counted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts added up from two halves of the month, as two runs would."""
    rows = labelled(spark, sf_dir)
    early = vocab.count_values(rows.where("dt <= '2024-01-15'"), list(RANKED))
    return vocab.add_counts(early, vocab.count_values(rows.where("dt > '2024-01-15'"), list(RANKED)))


@query("g1_count_values", on("labelled", "SELECT feature, value, cnt FROM counts", **_COUNTS))
def counts(spark, sf_dir):
    return counted(spark, sf_dir)


@query("g2_rank_vocab", on("labelled", "SELECT feature, value, id FROM ranks", **_RANKS))
def ranks(spark, sf_dir):
    return vocab.rank_vocab(counted(spark, sf_dir), RANKED)


@query("g3_encode_rank", on("labelled", """
SELECT sample_id, coalesce((SELECT id FROM ranks r WHERE r.feature = 'mchid' AND r.value = l.mchid), 0) AS mchid,
       coalesce((SELECT id FROM ranks r WHERE r.feature = 'model' AND r.value = l.model), 0) AS model FROM labelled l""", **_RANKS))
def rank_ids(spark, sf_dir):
    previous = vocab.rank_vocab(counted(spark, sf_dir), RANKED)
    return vocab.encode_rank(labelled(spark, sf_dir).select("sample_id", "mchid", "model"), previous, RANKED)


@query("g4_daily_counts", on("labelled", "SELECT dt, count(*) AS n FROM labelled GROUP BY dt"))
def per_day(spark, sf_dir):
    return daily_counts(labelled(spark, sf_dir))


# --- E9: boundaries next to the rows they cut -------------------------------------------------------

@query("e9_boundaries_text", on("samples", "SELECT bucketed, n, CASE bucketed " + " ".join(
    f"WHEN '{n}' THEN '{','.join(str(b) for b in REGISTRY[n].boundaries)}'" for n in ("total_chapter_num", "shelf_days")) + """ END AS boundaries_text
FROM (SELECT 'total_chapter_num' AS bucketed, count(total_chapter_num) AS n FROM samples UNION ALL SELECT 'shelf_days', count(shelf_days) FROM samples)"""))
def boundary_texts(spark, sf_dir):
    filled = samples_view(spark, sf_dir).agg(*[F.count(c).alias(c) for c in ("total_chapter_num", "shelf_days")])
    filled = filled.unpivot([], ["total_chapter_num", "shelf_days"], "bucketed", "n")
    texts = boundaries_text(REGISTRY.spec_df(spark)).withColumnRenamed("name", "bucketed")
    return filled.join(F.broadcast(texts), "bucketed").select("bucketed", "n", "boundaries_text")


# --- H: embeddings -----------------------------------------------------------------------------------

DIM = 64


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(
        F.lit("item").alias("feature"), F.col("vec_id").alias("id"), F.col("embedding").alias("vec"))


def vector_bound(spark: SparkSession, sf_dir: str) -> int:
    """Rows of the vector table, read off its footer: the bound that decides between broadcast and join."""
    return table(spark, sf_dir, "embeddings").count()


_V = "SELECT vec_id AS id, embedding::DOUBLE[] AS vec FROM embeddings"
# vectors of unknown ids
_ZERO = f"list_transform(range(0, {DIM}), lambda i: 0.0::DOUBLE)"
# ids from the click list: 31 times the number in the item, so that many are unknown; 0 (not kept) for items that are no number
_CLICKS = ("SELECT sample_id, k, list_transform(string_split(replace(coalesce(userclickbooklistlatestbookid, ''), '_', ','), ','), "
           "lambda x: coalesce(try_cast(substr(x, 2) AS BIGINT) * 31, 0)) AS ids FROM (SELECT *, cast(substr(book_id, 2) AS BIGINT) * 31 AS k FROM samples)")


def clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = F.split(F.translate(F.coalesce("userclickbooklistlatestbookid", F.lit("")), "_", ","), ",")
    ids = F.transform(items, lambda x: F.coalesce(F.substring(x, 2, 20).try_cast("bigint") * 31, F.lit(0)))
    k = F.substring("book_id", 2, 20).cast("bigint") * 31
    rows = samples_view(spark, sf_dir).select("sample_id", k.alias("k"), ids.alias("ids"))
    return for_heavy_work(rows)


_LOOKUP_SQL = on("samples", f"SELECT sample_id, {digest_sql(f'coalesce(vec, {_ZERO})')} AS item FROM clicks LEFT JOIN v ON v.id = clicks.k", clicks=_CLICKS, v=_V)


@query("h1_lookup", _LOOKUP_SQL)
def lookup(spark, sf_dir):
    found = embed.lookup(clicks(spark, sf_dir), vectors(spark, sf_dir), "item", "k", "vec", vector_bound(spark, sf_dir), "sample_id", DIM)
    return found.select("sample_id", digest(F.col("vec")).alias("item"))


@query("h1_lookup_large_table", _LOOKUP_SQL)
def lookup_large(spark, sf_dir):
    found = embed.lookup(clicks(spark, sf_dir), vectors(spark, sf_dir), "item", "k", "vec", None, "sample_id", DIM)
    return found.select("sample_id", digest(F.col("vec")).alias("item"))


def _pool_sql(weight: str, divisor: str, keep: str = "true") -> str:
    """Pooling in SQL: per row and element, the weighted sum over the items."""
    return on("samples", f"""
SELECT clicks.sample_id, round(coalesce(s, 0), 6) + 0.0::DOUBLE AS pooled FROM clicks LEFT JOIN (
  SELECT sample_id, sum(w * d) / {divisor} AS s FROM (
    SELECT sample_id, {weight} AS w, id, pos FROM (SELECT sample_id, unnest(ids) AS id, unnest(range(1, len(ids) + 1)) AS pos FROM clicks))
  JOIN (SELECT id, list_sum(list_transform(vec, lambda x, i: x * i)) AS d FROM v) USING (id) WHERE {keep} GROUP BY sample_id) USING (sample_id)""",
              clicks=_CLICKS, v=_V)


_POSITION_WEIGHT = "1.0 / pos - 0.125"


def _weighted(df: DataFrame) -> DataFrame:
    """Weights that fall with the position and end below zero."""
    return df.withColumn("w", F.transform("ids", lambda x, i: F.lit(1.0) / (i + 1) - 0.125))


@query("h2_pool_mean", _pool_sql("1.0", "sum(w)"))
def pool_mean(spark, sf_dir):
    rows = clicks(spark, sf_dir)
    pooled = embed.pool(rows, "ids", vectors(spark, sf_dir), "item", "sample_id", "mean", bound=vector_bound(spark, sf_dir), dim=DIM)
    joined = rows.select("sample_id").join(pooled, "sample_id", "left")
    return joined.select("sample_id", F.coalesce(digest(F.col("vec")), F.lit(0.0)).alias("pooled"))


@query("h2_pool_sqrtn_large_table", _pool_sql(_POSITION_WEIGHT, "sqrt(sum(w * w))", "w > 0"))
def pool_sqrtn(spark, sf_dir):
    rows = _weighted(clicks(spark, sf_dir))
    pooled = embed.pool(rows, "ids", vectors(spark, sf_dir), "item", "sample_id", "sqrtn", weights="w", dim=DIM)
    joined = rows.select("sample_id").join(pooled, "sample_id", "left")
    return joined.select("sample_id", F.coalesce(digest(F.col("vec")), F.lit(0.0)).alias("pooled"))


def _safe(spark: SparkSession, sf_dir: str, combiner: str, weighted: bool, mask_zero: bool, bound: int | None) -> DataFrame:
    rows = _weighted(clicks(spark, sf_dir))
    out = embed.with_safe_pool(rows, "ids", vectors(spark, sf_dir), "item", "sample_id", "vec", bound, combiner, "w" if weighted else None,
                               mask_zero, DIM)
    return out.select("sample_id", digest(F.col("vec")).alias("pooled"))


@query("h3_safe_pool_mean_masked", _pool_sql("1.0", "sum(w)", "id > 0"))
def safe_mean(spark, sf_dir):
    return _safe(spark, sf_dir, "mean", False, True, vector_bound(spark, sf_dir))


@query("h3_safe_pool_sum_weighted", _pool_sql(_POSITION_WEIGHT, "1", "w > 0"))
def safe_sum(spark, sf_dir):
    return _safe(spark, sf_dir, "sum", True, False, vector_bound(spark, sf_dir))


@query("h3_safe_pool_sqrtn_weighted", _pool_sql(_POSITION_WEIGHT, "sqrt(sum(w * w))", "w > 0"))
def safe_sqrtn(spark, sf_dir):
    return _safe(spark, sf_dir, "sqrtn", True, False, vector_bound(spark, sf_dir))


@query("h3_safe_pool_mean_masked_large_table", _pool_sql("1.0", "sum(w)", "id > 0"))
def safe_mean_large(spark, sf_dir):
    return _safe(spark, sf_dir, "mean", False, True, None)


@query("h3_safe_pool_sqrtn_weighted_large_table", _pool_sql(_POSITION_WEIGHT, "sqrt(sum(w * w))", "w > 0"))
def safe_sqrtn_large(spark, sf_dir):
    return _safe(spark, sf_dir, "sqrtn", True, False, None)


_SEQUENCE_SQL = on("samples", """
SELECT sample_id, pos, round(coalesce(d, 0), 6) + 0.0::DOUBLE AS item FROM (SELECT sample_id, unnest(ids) AS id, unnest(range(0, len(ids))) AS pos FROM clicks)
LEFT JOIN (SELECT id, list_sum(list_transform(vec, lambda x, i: x * i)) AS d FROM v) USING (id)""", clicks=_CLICKS, v=_V)


@query("h4_lookup_sequence", _SEQUENCE_SQL)
def sequence(spark, sf_dir):
    lists = embed.with_sequence(clicks(spark, sf_dir), "ids", vectors(spark, sf_dir), "item", "sample_id", "vecs", vector_bound(spark, sf_dir), DIM)
    rows = lists.select("sample_id", F.posexplode("vecs").alias("pos", "vec"))
    return rows.select("sample_id", F.col("pos").cast("bigint").alias("pos"), digest(F.col("vec")).alias("item"))


@query("h4_lookup_sequence_by_join", _SEQUENCE_SQL)
def sequence_by_join(spark, sf_dir):
    lists = embed.lookup_sequence_by_join(clicks(spark, sf_dir), "ids", vectors(spark, sf_dir), "item", "sample_id", dim=DIM)
    rows = lists.select("sample_id", F.posexplode("vecs").alias("pos", "vec"))
    return rows.select("sample_id", F.col("pos").cast("bigint").alias("pos"), digest(F.col("vec")).alias("item"))


@query("h5_shard_of", """
SELECT vec_id AS id, cast(CASE WHEN vec_id < (n % 7) * (n // 7 + 1) THEN vec_id // (n // 7 + 1)
  ELSE (vec_id - (n % 7) * (n // 7 + 1)) // (n // 7) + n % 7 END AS INT) AS shard FROM embeddings, (SELECT count(*) AS n FROM embeddings)""")
def shards(spark, sf_dir):
    return embed.sharded(vectors(spark, sf_dir), 7, vector_bound(spark, sf_dir)).select("id", "shard")


def bucketed_vectors(spark: SparkSession, sf_dir: str) -> str:
    return bucketed.write_bucketed(vectors(spark, sf_dir).select("id", "vec"), "id", 16)


@query("h1_lookup_bucketed", on("samples", f"""
SELECT sample_id, u, coalesce(d, 0) AS found FROM (SELECT sample_id, CASE WHEN sample_id % 7 <> 0 THEN cast(userid AS BIGINT) END AS u FROM samples)
LEFT JOIN (SELECT vec_id AS u, {digest_sql('embedding::DOUBLE[]')} AS d FROM embeddings) USING (u)"""))
def lookup_bucketed(spark, sf_dir):
    """The state table stays in its buckets; hot and missing keys are answered where the rows lie."""
    rows = samples_view(spark, sf_dir).select("sample_id", F.when(F.col("sample_id") % 7 != 0, F.col("userid").cast("bigint")).alias("u"))
    found = bucketed.bucketed_lookup(rows, bucketed_vectors(spark, sf_dir), "id", "u", share=0.02)
    return found.select("sample_id", "u", F.coalesce(digest(F.col("vec").cast("array<double>")), F.lit(0.0)).alias("found"))


@query("h5_update_bucketed", f"""
SELECT id, {digest_sql('vec')} AS vec FROM (
  SELECT coalesce(c.user_id, e.vec_id) AS id, CASE WHEN c.user_id IS NULL THEN e.embedding::DOUBLE[] ELSE [c.s, c.n] END AS vec
  FROM embeddings e FULL JOIN (SELECT CASE WHEN user_id % 3 = 0 THEN user_id + 1000000 ELSE user_id END AS user_id, sum(value) AS s, count(*)::DOUBLE AS n
                               FROM events GROUP BY 1) c ON c.user_id = e.vec_id)""")
def update_bucketed(spark, sf_dir):
    """A day's changed and new rows merged into the buckets of the table, which is not shuffled."""
    changes = table(spark, sf_dir, "events").groupBy(F.expr("if(user_id % 3 = 0, user_id + 1000000, user_id)").alias("id")).agg(
        F.array(F.sum("value"), F.count(F.lit(1)).cast("double")).alias("vec"))
    old = bucketed.write_bucketed(vectors(spark, sf_dir).select("id", F.col("vec").cast("array<double>").alias("vec")), "id", 16)
    return spark.table(bucketed.update_bucketed(old, changes, "id", 16)).select("id", digest(F.col("vec")).alias("vec"))


@query("h6_assemble", on("samples", f"""
SELECT sample_id, 192 AS width, {digest_sql('list_concat(a, b, a)')} AS assembled FROM (
  SELECT sample_id, coalesce(a.vec, {_ZERO}) AS a, coalesce(b.vec, {_ZERO}) AS b FROM clicks
  LEFT JOIN v a ON a.id = clicks.k LEFT JOIN v b ON b.id = clicks.k + 1)""", clicks=_CLICKS, v=_V))
def assembled(spark, sf_dir):
    emb, bound = vectors(spark, sf_dir), vector_bound(spark, sf_dir)
    rows = clicks(spark, sf_dir).withColumn("next", F.col("k") + 1)
    rows = embed.lookup(rows, emb, "item", "k", "va", bound, "sample_id", DIM)
    rows = embed.lookup(rows, emb, "item", "next", "vb", bound, "sample_id", DIM)
    both = rows.select("sample_id", embed.assemble(["va", "vb", "va"]).alias("vec"))
    return both.select("sample_id", F.size("vec").alias("width"), digest(F.col("vec")).alias("assembled"))


# --- J: optimizer state ----------------------------------------------------------------------------------

def optimizer_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = vectors(spark, sf_dir).select("feature", "id", F.col("vec").cast("array<double>").alias("vec"))
    return rows.withColumns({"m": F.transform("vec", lambda x: x * 0.1), "v": F.transform("vec", lambda x: x * x)})


def event_gradients(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One gradient per event for its user's row; a user has many events, so ids repeat."""
    g = F.transform(F.sequence(F.lit(1), F.lit(DIM)), lambda i: (F.col("value") - 5.0) * i / 640.0)
    return table(spark, sf_dir, "events").select(F.lit("item").alias("feature"), F.col("user_id").alias("id"), g.alias("g"))


def _adam_sql(rate: float, touched_only: bool) -> str:
    moved = f"""SELECT id, vec, m, v, w, list_transform(range(1, 65), lambda i: vec[i] - {rate!r} * m[i] / (sqrt(v[i]) + 1e-8)) AS moved FROM (
      SELECT id, vec, g IS NOT NULL AS w, list_transform(range(1, 65), lambda i: 0.9::DOUBLE * 0.1::DOUBLE * vec[i] + 0.1::DOUBLE * coalesce(g, 0) * i / 640) AS m,
             list_transform(range(1, 65), lambda i: 0.999::DOUBLE * vec[i] * vec[i] + 0.001::DOUBLE * (coalesce(g, 0) * i / 640) * (coalesce(g, 0) * i / 640)) AS v
      FROM (SELECT vec_id AS id, embedding::DOUBLE[] AS vec FROM embeddings) LEFT JOIN (SELECT user_id AS id, sum(value - 5) AS g FROM events GROUP BY 1) USING (id))"""
    pick = lambda new, old: f"CASE WHEN w THEN {new} ELSE {old} END" if touched_only else new
    return f"""SELECT id, {digest_sql(pick('moved', 'vec'))} AS vec, {digest_sql(pick('m', 'list_transform(vec, lambda x: x * 0.1::DOUBLE)'))} AS m,
      {digest_sql(pick('v', 'list_transform(vec, lambda x: x * x)'))} AS v FROM ({moved})"""


def _digested(df: DataFrame) -> DataFrame:
    return df.select("id", digest(F.col("vec")).alias("vec"), digest(F.col("m")).alias("m"), digest(F.col("v")).alias("v"))


@query("j3_j5_adam_step_all_rows", _adam_sql(optimizer.step_rate(0.05, 0.9, 0.999, 3), False))
def adam_all(spark, sf_dir):
    return _digested(optimizer.adam_step(optimizer_state(spark, sf_dir), event_gradients(spark, sf_dir), 3, 0.05, dim=DIM))


@query("j4_lazy_adam_step", _adam_sql(optimizer.step_rate(0.05, 0.9, 0.999, 3), True))
def adam_lazy(spark, sf_dir):
    return _digested(optimizer.lazy_adam_step(optimizer_state(spark, sf_dir), event_gradients(spark, sf_dir), 3, 0.05, dim=DIM))


@query("j4_lazy_adam_step_constant_rate", _adam_sql(optimizer.step_rate(0.05, 0.9, 0.999, 1), True))
def adam_constant(spark, sf_dir):
    return _digested(optimizer.lazy_adam_step(optimizer_state(spark, sf_dir), event_gradients(spark, sf_dir), 3, 0.05,
                                              bias_correction="constant", dim=DIM))


@query("j6_warm_start", """
WITH named AS (SELECT concat('emb/', cast(label AS VARCHAR)) AS feature, vec_id AS id, embedding::DOUBLE[] AS vec FROM embeddings)
SELECT feature, id, CASE WHEN vec[1] > 0 AND regexp_matches(feature, '^emb') AND NOT regexp_matches(feature, '/[27]$')
  THEN round(2 * list_sum(list_transform(vec, lambda x, i: x * i)), 6) + 0.0::DOUBLE ELSE round(list_sum(list_transform(vec, lambda x, i: x * i)), 6) + 0.0::DOUBLE END AS vec FROM named""")
def warm(spark, sf_dir):
    named = table(spark, sf_dir, "embeddings").select(
        F.concat(F.lit("emb/"), F.col("label").cast("string")).alias("feature"), F.col("vec_id").alias("id"), F.col("embedding").alias("vec"))
    fresh = optimizer.fresh_state(named, DIM)
    # the previous run knows the rows that start above zero, with doubled vectors
    previous = fresh.where("vec[0] > 0").withColumn("vec", F.transform("vec", lambda x: x * 2))
    started = optimizer.warm_start(fresh, previous, ["^emb"], ["/[27]$"])
    return started.select("feature", "id", digest(F.col("vec")).alias("vec"))
