"""The operators as registered queries over the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankflow.llm import (embed_dedup, fim, html, langid, packing, quality, secrets, sentencepiece, simhash, spelling, suffix_dedup,
                          topk, toxicity)
from rankflow.llm.common import held_out, table

QUERIES = {}
ORACLE = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return add


@query("op4_packing")
def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), packing.word_encoder("word_bpe_49k.json"), keep_ids=False)


@query("op8_simhash")
def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_components(table(spark, sf_dir, "documents"))


@query("op10_quality")
def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.train_quality(docs, table(spark, sf_dir, "labels"))
    return (quality.score_quality(docs.select("doc_id", "text"), model)
            .select("doc_id", held_out("doc_id", 5, 0).alias("held_out"), "score",
                    (F.col("score") >= 0.3).cast("int").alias("predicted")))


@query("op7_toxicity")
def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train_toxicity(docs, table(spark, sf_dir, "labels"))
    return (toxicity.score_toxicity(docs, model)
            .select("doc_id", held_out("doc_id", 3, 1).alias("held_out"), "score",
                    (F.col("score") >= 0.7).cast("int").alias("predicted")))


@query("op1_topk", """
    WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS v FROM embeddings
               WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
                 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
    s AS (SELECT q.vec_id AS query_id, e.vec_id, CAST(list_inner_product(q.v, e.v) AS BIGINT) AS score
          FROM v q JOIN v e ON q.vec_id % 20 = 0 AND e.vec_id <> q.vec_id),
    r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INT) AS rank FROM s)
    SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20""")
def op1_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


@query("op5_embedding_dedup", """
    WITH RECURSIVE v AS (SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
               WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
                 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
                 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
    l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
          AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.93),
    r AS (SELECT vec_id AS node, vec_id AS reached FROM embeddings UNION SELECT r.node, l.b FROM r JOIN l ON l.a = r.reached),
    c AS (SELECT node, min(reached) AS component_id FROM r GROUP BY node),
    n AS (SELECT a, count(*) AS n FROM l GROUP BY a)
    SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, vec_id = component_id AS kept
    FROM embeddings JOIN c ON node = vec_id LEFT JOIN n ON a = vec_id""")
def op5_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed_dedup.embedding_components(table(spark, sf_dir, "embeddings"))


@query("op3_secrets")
def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = secrets.find_secrets(docs, secrets.train_markov(secrets.labelled_samples(docs)))
    n = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    return found.select("doc_id", n(0).alias("n_assign"), n(1).alias("n_access"), n(2).alias("n_hex"),
                        F.sha2(secrets.listed("base"), 256).alias("base_sha256"), secrets.listed("spans").alias("spans"))


@query("op2_sentencepiece")
def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = "piece_bpe_32k.model"
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    back = sentencepiece.encode(docs, model, decoded="decoded")
    return back.select("doc_id", F.size("ids").cast("long").alias("n_ids"), F.xxhash64("ids").alias("ids_hash"), "parity",
                       (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("round_trip"))


@query("op6_langid")
def op6_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return (langid.label_documents(docs.select("doc_id", "text"), langid.train_langid(docs))
            .select("doc_id", held_out("doc_id", 4, 2).alias("held_out"), "lang_pred", "score"))


@query("op9_suffix_dedup", """
    WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, octet_length(encode(coalesce(text, ''))) AS n FROM documents),
    c AS (SELECT doc_id, n, f, substr(h, 2 * f + 1, 612) AS part FROM (SELECT doc_id, n, h, unnest(range(0, n - 49, 256)) AS f FROM d WHERE n >= 50)),
    w AS (SELECT doc_id, f + q AS p, substr(part, 2 * q + 1, 100) AS s
          FROM (SELECT doc_id, f, part, unnest(range(0, least(256, n - 49 - f))) AS q FROM c)),
    m AS (SELECT s, min(doc_id) AS least FROM w GROUP BY s),
    g AS (SELECT doc_id, p FROM w JOIN m USING (s) WHERE least < doc_id),
    i AS (SELECT doc_id, p, lag(p) OVER (PARTITION BY doc_id ORDER BY p) AS before FROM g),
    r AS (SELECT doc_id, p, sum(CASE WHEN before IS NULL OR p > before + 50 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY p) AS run FROM i),
    x AS (SELECT doc_id, min(p) AS a, max(p) + 50 AS b FROM r GROUP BY doc_id, run),
    y AS (SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS c FROM x),
    k AS (SELECT doc_id, sum(b - a) AS removed, count(*) AS spans, max(b) AS last,
                 string_agg(substr(h, 2 * c + 1, 2 * (a - c)), '' ORDER BY a) AS head FROM y JOIN d USING (doc_id) GROUP BY doc_id)
    SELECT doc_id, n::BIGINT AS n_bytes, coalesce(removed, 0)::BIGINT AS n_removed, coalesce(spans, 0)::BIGINT AS n_spans,
           sha256(unhex(concat(coalesce(head, ''), substr(h, 2 * coalesce(last, 0) + 1)))) AS kept_sha256
    FROM d LEFT JOIN k USING (doc_id)""")
def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return suffix_dedup.remove_repeats(docs).select("doc_id", "n_bytes", "n_removed", "n_spans",
                                                    F.sha2("kept", 256).alias("kept_sha256"))


@query("op11_spelling", """
    WITH RECURSIVE crc AS (SELECT list(c ORDER BY i) AS t FROM (SELECT i, list_reduce(list_prepend(i, range(8)),
        lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c FROM range(256) AS r(i))),
    runs AS (SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-z\\x{C0}-\\x{FF}]+')),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS w FROM documents),
    per_doc AS (SELECT doc_id, w, count(*) AS n FROM runs GROUP BY doc_id, w),
    points AS (SELECT *, flatten(list_transform(string_split(concat(doc_id, ':', w), ''), lambda x:
        CASE WHEN unicode(x) < 128 THEN [unicode(x)::BIGINT] ELSE [192 + (unicode(x) >> 6)::BIGINT, 128 + (unicode(x) & 63)::BIGINT] END)) AS b
        FROM per_doc),
    hashed AS (SELECT w, n, xor(list_reduce(list_prepend(4294967295, b), lambda c, x: xor(c >> 8, t[xor(c & 255, x) + 1])), 4294967295) AS h
               FROM points, crc),
    seen AS (SELECT CASE WHEN h % 97 = 0 THEN concat(substr(w, 1, h % length(w)), substr(w, h % length(w) + 2)) ELSE w END AS word, n FROM hashed),
    words AS (SELECT word, sum(n)::BIGINT AS n FROM seen WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
    less AS (SELECT word, n, -1 AS place, word AS v FROM words
             UNION ALL SELECT word, n, i, concat(substr(word, 1, i), substr(word, i + 2)) FROM (SELECT word, n, unnest(range(length(word))) AS i FROM words)),
    near AS (SELECT DISTINCT a.word, b.word AS near, b.n AS near_n FROM less a JOIN less b ON a.v = b.v AND a.word <> b.word
             AND (a.place = b.place OR a.place = -1 OR b.place = -1)),
    best AS (SELECT word, count(*) AS n_near, arg_min(near, (-near_n, encode(near))) AS near, max(near_n) AS near_n FROM near GROUP BY word),
    found AS (SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN near_n >= 2 * n THEN near END AS form,
              CASE WHEN near_n >= 2 * n THEN near_n END AS form_n FROM words LEFT JOIN best USING (word)),
    chain AS (SELECT word AS start, word AS last, form AS next FROM found
              UNION ALL SELECT start, found.word, found.form FROM chain JOIN found ON found.word = chain.next)
    SELECT word, form, last AS root, n, n_near::BIGINT AS n_near, form_n FROM found JOIN chain ON start = word AND next IS NULL""")
def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = spelling.count_words(table(spark, sf_dir, "documents"), typo_modulus=97)
    return spelling.spelling_variants(words).select("word", "form", "root", "n", "n_near", "form_n")


@query("op12_html")
def op12_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.main_texts(table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")


@query("op13_fim", """
    WITH d AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u,
                      sha256(concat('1:', doc_id)) AS s FROM documents),
    h AS (SELECT doc_id, text, u, len(u) AS n, list_transform([1, 9, 17, 25], lambda i: concat('0x', substr(s, i, 8))::BIGINT) AS h FROM d),
    c AS (SELECT *, least(h[1] % (n + 1), h[2] % (n + 1)) AS a, greatest(h[1] % (n + 1), h[2] % (n + 1)) AS b,
                 CASE WHEN text = '' OR regexp_matches(text, '<[PSM]>') OR h[3] % 100 >= 90 THEN 'plain'
                      WHEN h[4] % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM h),
    p AS (SELECT *, array_to_string(u[1:a], '') AS pre, array_to_string(u[a + 1:b], '') AS mid, array_to_string(u[b + 1:], '') AS suf FROM c)
    SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN length(pre) END AS prefix_chars,
           CASE WHEN form <> 'plain' THEN length(mid) END AS middle_chars,
           sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN concat('<P>', pre, '<S>', suf, '<M>', mid)
                  ELSE concat('<S>', suf, '<P>', pre, '<M>', mid) END) AS output_sha256, sha256(text) AS restored_sha256 FROM p""")
def op13_fim(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return fim.fill_in_middle(docs).select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                                           F.sha2("restored", 256).alias("restored_sha256"))


@query("pipeline")
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf_dir)
