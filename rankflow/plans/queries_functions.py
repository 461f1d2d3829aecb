"""Queries over the numeric, text and hash functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from rankflow.functions import hashing, numeric, text, vectors
from rankflow.plans import prepare
from rankflow.plans.catalog import digest, digest_sql, md5_sql, on, query
from rankflow.plans.views import samples_view, table
from rankflow.registry import default_registry, load_dense_spec
from rankflow.session import new_path

REGISTRY = default_registry()


def _cut_sql(col: str, feature: str) -> str:
    cuts = ", ".join(repr(b) for b in REGISTRY[feature].boundaries)
    return f"len(list_filter([{cuts}]::DOUBLE[], lambda b: b <= coalesce({col}, 0)))"


# --- D: numeric ------------------------------------------------------------------------------

@query("d1_bucketize", on("samples", f"""
SELECT sample_id, {_cut_sql('total_chapter_num', 'total_chapter_num')} AS total_chapter_num,
       {_cut_sql('shelf_days', 'shelf_days')} AS shelf_days,
       {_cut_sql('useritemwatchleftforpay', 'userItemWatchLeftForPay')} AS useritemwatchleftforpay FROM samples"""))
def bucketize(spark, sf_dir):
    columns = ["total_chapter_num", "shelf_days", "useritemwatchleftforpay"]
    df = samples_view(spark, sf_dir).select("sample_id", *columns)
    return numeric.bucketize(df, {c: REGISTRY[c].boundaries for c in columns})


_LINE_CUTS = {"l_quantity": [1, 2, 3, 5, 8, 8, 13, 21, 34, 34, 34, 50], "l_discount": [0.0, 0.02, 0.05, 0.1],
              "l_extendedprice": [-1, 1000, 5000, 10000, 20000, 30000, 40000, 50000, 75000, 100000]}


@query("d1_bucketize_lineitem", "SELECT " + ", ".join(
    f"len(list_filter({list(map(float, cuts))}, lambda b: b <= {c})) AS {c}" for c, cuts in _LINE_CUTS.items())
    + ", count(*) AS n FROM lineitem GROUP BY 1, 2, 3")
def bucketize_lines(spark, sf_dir):
    cut = numeric.bucketize(table(spark, sf_dir, "lineitem").select(*_LINE_CUTS), _LINE_CUTS)
    return cut.groupBy(*_LINE_CUTS).agg(F.count(F.lit(1)).alias("n"))


# 228 features over the numbers of a line, each with 19 boundaries of its own.
_WIDE = {f"f{i}": (f"l_extendedprice * {1 + i % 7} + l_quantity * {i}", [1000.0 * (i % 5 + 1) * (k + 1) for k in range(19)]) for i in range(228)}


@query("d1_bucketize_wide", "SELECT l_orderkey, l_linenumber, cast(" + " + ".join(
    f"{i + 1} * len(list_filter({cuts}, lambda b: b <= {e}))" for i, (e, cuts) in enumerate(_WIDE.values())) + " AS BIGINT) AS cut FROM lineitem")
def bucketize_wide(spark, sf_dir):
    """All dense columns at full width in one projection, with boundaries from a stored spec."""
    path = new_path(spark, "dense_spec")
    spec = [(5000 + i, name, cuts) for i, (name, (_, cuts)) in enumerate(_WIDE.items())]
    spark.createDataFrame(spec, "slot_id int, name string, boundaries array<double>").coalesce(1).write.option(
        "ignoreNullFields", "false").json(path)
    registry = REGISTRY.with_dense(load_dense_spec(spark, path))
    rows = table(spark, sf_dir, "lineitem").selectExpr("l_orderkey", "l_linenumber", *[f"{e} AS {n}" for n, (e, _) in _WIDE.items()])
    cut = prepare.bucketed(rows, registry)
    return cut.select("l_orderkey", "l_linenumber", sum((F.col(n) * (i + 1) for i, n in enumerate(_WIDE)), F.lit(0)).cast("bigint").alias("cut"))


@query("d2_min_max", """
SELECT o_orderkey, round((o_totalprice - (SELECT min(o_totalprice) FROM orders)) / (SELECT max(o_totalprice) - min(o_totalprice) FROM orders), 6) AS scaled FROM orders""")
def min_max(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    lo, hi = numeric.fit_min_max(orders, ["o_totalprice"])["o_totalprice"]
    return orders.select("o_orderkey", F.round(numeric.min_max(F.col("o_totalprice"), lo, hi), 6).alias("scaled"))


_PRICES = [1000.0, 10000.0, 50000.0, 100000.0, 200000.0, 300000.0, 400000.0]


@query("d3_quantile_scale", f"SELECT o_orderkey, round(len(list_filter({_PRICES}, lambda b: b <= o_totalprice)) / 7.0, 6) AS scaled FROM orders")
def quantile_scale(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", F.round(numeric.quantile_scale(F.col("o_totalprice"), _PRICES), 6).alias("scaled"))


_TENTHS = [i / 10 for i in range(1, 10)]


@query("d3_fit_quantiles", " UNION ALL ".join(
    f"SELECT '{c}' AS name, unnest(range(1, 10))::INT AS part, unnest(quantile_disc({c}::DOUBLE, {_TENTHS})) AS boundary FROM lineitem"
    for c in ("l_extendedprice", "l_partkey")))
def fit_quantiles(spark, sf_dir):
    """The tenths of two columns; the accuracy is finer than a row, so they are exact."""
    cuts = numeric.fit_quantiles(table(spark, sf_dir, "lineitem"), ["l_extendedprice", "l_partkey"], 10, accuracy=100_000_000)
    return spark.createDataFrame([(c, i, v) for c, vs in cuts.items() for i, v in enumerate(vs, 1)], "name string, part int, boundary double")


@query("d4_inverse_scale", """
SELECT c_custkey, round(1 / (greatest(c_acctbal, 0) / 222106 + 1), 6) AS scaled, round(1 / (greatest(c_acctbal, 0) / 5000 + 1), 6) AS steeper FROM customer""")
def inverse_scale(spark, sf_dir):
    balance = F.col("c_acctbal")
    return table(spark, sf_dir, "customer").select(
        "c_custkey", F.round(numeric.inverse_scale(balance), 6).alias("scaled"),
        F.round(numeric.inverse_scale(balance, 5000), 6).alias("steeper"))


@query("d5_hash_bucket", on("samples", f"""
SELECT sample_id, {md5_sql('userid')} % 10000000 AS userid, CASE WHEN model IS NOT NULL THEN {md5_sql('model')} % 1001 END AS model FROM samples"""))
def hash_text(spark, sf_dir):
    return samples_view(spark, sf_dir).select(
        "sample_id", hashing.hash_bucket(F.col("userid"), 10_000_000, "md5").alias("userid"),
        hashing.hash_bucket(F.col("model"), 1001, "md5").alias("model"))


@query("d5_hash_bucket_fast", on("samples", "SELECT model, count(*) AS n, CASE WHEN model IS NULL THEN 0 ELSE 1 END AS buckets, model IS NOT NULL AS inside FROM samples GROUP BY model"))
def hash_fast(spark, sf_dir):
    """Per model its rows, how many buckets they have, and whether those lie in range."""
    rows = samples_view(spark, sf_dir).select("model", hashing.hash_bucket(F.col("model"), 1001).alias("bucket"))
    return rows.groupBy("model").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("bucket").cast("int").alias("buckets"),
                                     F.coalesce((F.min("bucket") >= 0) & (F.max("bucket") < 1001), F.lit(False)).alias("inside"))


@query("d6_hash_bucket_integers", on("samples", f"""
SELECT sample_id, CASE WHEN book_pos IS NOT NULL THEN {md5_sql('cast(book_pos AS VARCHAR)')} % 61 END AS book_pos,
       array_to_string(list_transform([sample_id, sample_id % 7, -sample_id], lambda x: {md5_sql('cast(x AS VARCHAR)')} % 10001), ',') AS ids FROM samples"""))
def hash_numbers(spark, sf_dir):
    key = F.col("sample_id")
    ids = hashing.hash_bucket_list(F.array(key, key % 7, -key), 10_001, "md5")
    return samples_view(spark, sf_dir).select("sample_id", hashing.hash_bucket(F.col("book_pos"), 61, "md5").alias("book_pos"),
                                              F.array_join(ids.cast("array<string>"), ",").alias("ids"))


@query("d7_identity_bucket", on("samples", """
SELECT sample_id, CASE WHEN book_pos BETWEEN 0 AND 60 THEN book_pos ELSE 0 END AS bounded, sample_id % 31 AS strict FROM samples"""))
def identity(spark, sf_dir):
    return samples_view(spark, sf_dir).select("sample_id", hashing.identity_bucket(F.col("book_pos"), 61, 0).alias("bounded"),
                                              hashing.identity_bucket(F.col("sample_id") % 31, 31).alias("strict"))


@query("d8_activations", f"""
SELECT vec_id, round(1 / (1 + exp(-list_sum(v))), 6) AS squashed, round(list_dot_product(v, list_reverse(v)), 6) AS product,
       {digest_sql('list_transform(v, lambda x: greatest(x, 0))')} AS positive,
       {digest_sql('list_transform(v, lambda x: exp(x) / list_sum(list_transform(v, lambda y: exp(y))))')} AS shares
FROM (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings)""")
def activations(spark, sf_dir):
    df = table(spark, sf_dir, "embeddings").select("vec_id", vectors.as_vector(F.col("embedding")).alias("v"))
    v = F.col("v")
    total = F.aggregate(v, F.lit(0.0), lambda s, x: s + x)
    return df.select("vec_id", F.round(numeric.sigmoid(total), 6).alias("squashed"),
                     F.round(vectors.dot(v, F.reverse(v)), 6).alias("product"),
                     digest(vectors.relu_vector(v)).alias("positive"), digest(vectors.softmax(v)).alias("shares"))


# --- E: text, dates, lists ---------------------------------------------------------------------

@query("e1_extract_tags", on("samples", """
SELECT sample_id, CASE WHEN tag_set IS NULL OR len(list_filter(string_split(tag_set, ','), lambda t: NOT contains(t, '_'))) > 0 THEN 'unknown'
  ELSE array_to_string(list_transform(string_split(tag_set, ','), lambda t: substr(t, strpos(t, '_') + 1)), ',') END AS tags FROM samples"""))
def tags(spark, sf_dir):
    return samples_view(spark, sf_dir).select("sample_id", text.extract_tags(F.col("tag_set")).alias("tags"))


@query("e2_elapsed_days", on("samples", """
SELECT sample_id, coalesce(cast(floor((epoch(try_cast(CASE WHEN length(reqtime) = 19 THEN reqtime END AS TIMESTAMP))
  - epoch(try_cast(nullif(lastwatchtime, '') AS TIMESTAMP))) / 86400) AS INT), -1) AS days FROM samples"""))
def elapsed(spark, sf_dir):
    return samples_view(spark, sf_dir).select("sample_id", text.elapsed_days(F.col("reqtime"), F.col("lastwatchtime")).alias("days"))


@query("e3_date_range", on("samples", """
SELECT userid, cast(unnest(generate_series(a, greatest(a, b), INTERVAL 1 DAY)) AS DATE)::VARCHAR AS dt
FROM (SELECT userid, min(dt)::DATE AS a, max(CASE WHEN ctr_label = 1 THEN dt ELSE '2024-01-01' END)::DATE AS b FROM samples GROUP BY userid)"""))
def dates(spark, sf_dir):
    last = F.max(F.to_date(F.when(F.col("ctr_label") == 1, F.col("dt")).otherwise("2024-01-01")))
    spans = samples_view(spark, sf_dir).groupBy("userid").agg(F.min(F.to_date("dt")).alias("a"), last.alias("b"))
    days = spans.select("userid", F.explode(text.days_between(F.col("a"), F.col("b"))).alias("d"))
    return days.select("userid", F.date_format("d", "yyyy-MM-dd").alias("dt"))


@query("e4_parse_flag", on("samples", """
SELECT sample_id, CASE WHEN lower(w) IN ('yes', 'true', 't', '1') THEN true WHEN lower(w) IN ('no', 'false', 'f', '0') THEN false END AS flag
FROM (SELECT sample_id, CASE WHEN vip_type IN ('0', '1') THEN vip_type WHEN ctr_label = 1 THEN 'Yes' WHEN gender = 'f' THEN 'F' ELSE language END AS w FROM samples)"""))
def flags(spark, sf_dir):
    word = (F.when(F.col("vip_type").isin("0", "1"), F.col("vip_type")).when(F.col("ctr_label") == 1, "Yes")
            .when(F.col("gender") == "f", "F").otherwise(F.col("language")))
    return samples_view(spark, sf_dir).select("sample_id", text.parse_flag(word, strict=False).alias("flag"))


@query("e5_normalise_category", on("samples", """
SELECT sample_id, lower(coalesce(gender, 'unknown')) AS gender, lower(coalesce(language, 'unknown')) AS language,
       lower(coalesce(cast(book_pos AS VARCHAR), 'unknown')) AS book_pos FROM samples"""))
def categories(spark, sf_dir):
    return samples_view(spark, sf_dir).select("sample_id", *[text.normalise_category(F.col(c)).alias(c) for c in ("gender", "language", "book_pos")])


@query("e6_parse_id_list", on("samples", """
SELECT sample_id, len(l) AS n, array_to_string(l, '|') AS ids FROM (
  SELECT sample_id, string_split(replace(userclickbooklistlatestbookid, '_', ','), ',') AS l FROM samples)"""))
def id_lists(spark, sf_dir):
    ids = text.parse_id_list(F.col("userclickbooklistlatestbookid"))
    return samples_view(spark, sf_dir).select("sample_id", F.size(ids).alias("n"), F.array_join(ids, "|").alias("ids")).withColumn(
        "n", F.when(F.col("ids").isNotNull(), F.col("n")))


_GAPS = "string_split(replace(userclickbooklistlatestgapday, '_', ','), ',')"


@query("e7_clamp_gap", on("samples", f"""
SELECT sample_id, array_to_string(list_transform({_GAPS}, lambda x: CASE WHEN x = '' THEN '' ELSE cast(least(try_cast(x AS INT), 190) AS VARCHAR) END), '|') AS gaps FROM samples"""))
def gaps(spark, sf_dir):
    clamped = text.clamp_gap(text.parse_id_list(F.col("userclickbooklistlatestgapday")))
    return samples_view(spark, sf_dir).select("sample_id", F.array_join(clamped, "|").alias("gaps"))


@query("e8_pad_truncate", on("samples", """
SELECT sample_id, array_to_string(list_transform(range(1, 21), lambda i: coalesce(l[i], 0)), ',') AS ids
FROM (SELECT sample_id, list_transform(string_split(replace(userclickbooklistlatestbookid, '_', ','), ','), lambda x: length(x)) AS l FROM samples)"""))
def padded(spark, sf_dir):
    sizes = F.transform(text.parse_id_list(F.col("userclickbooklistlatestbookid")), lambda x: F.length(x))
    return samples_view(spark, sf_dir).select(
        "sample_id", F.array_join(text.pad_truncate(sizes, 20).cast("array<string>"), ",").alias("ids"))
