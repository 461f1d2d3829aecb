"""The pipeline's stages, each on its own input, and the registered queries as a whole."""


import numpy as np
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from rankflow.llm.queries import ORACLE, QUERIES
from rankflow.llm.suffix_dedup import brute_force
from rankflow.session import written
from tests.compare import compare, duck
from tests.llm.test_operators import plain_fingerprint


@pytest.fixture(scope="module")
def stages(spark, sf_dir):
    """The rows before and after every stage."""
    rows = [spark.read.parquet(f"{sf_dir}/documents.parquet")]
    for name, stage in corpus_pipeline.STAGES:
        rows.append(written(stage(spark, rows[-1], sf_dir), name))
    return [r.toPandas() for r in rows]


def test_columns_stay(stages):
    for rows in stages[1:-1]:
        assert list(rows.columns) == list(stages[0].columns)


def test_toxic_documents_go(stages, spark, sf_dir):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").toPandas().set_index("doc_id").toxic
    kept = set(stages[1].doc_id)
    clean = labels[labels == 0].index
    assert np.mean([i in kept for i in clean]) > 0.98


def test_one_of_each_group_stays(stages):
    """Fingerprints of four-word shingles that differ in four bits at most are links."""
    prints = {i: plain_fingerprint(t) for i, t in zip(stages[1].doc_id, stages[1].text)}
    root = {i: i for i in prints}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for a, x in prints.items():
        for b, y in prints.items():
            if a < b and (x ^ y).bit_count() <= 4:
                low, high = sorted((find(a), find(b)))
                root[high] = low
    assert set(stages[2].doc_id) == {i for i in prints if find(i) == i}


def test_repeats_are_cut(stages):
    want = brute_force([(i, t.encode()) for i, t in zip(stages[2].doc_id, stages[2].text)])
    after = dict(zip(stages[3].doc_id, stages[3].text))
    assert len(after) == len(stages[2])
    for i, (size, removed, _, _) in want.items():
        left = len(after[i].encode())
        assert size - removed - 6 * want[i][2] <= left <= size - removed
    assert (stages[3].text.str.len() == stages[3].n_chars).all()


def test_all_documents_are_packed(stages):
    assert set(stages[5].doc_id) == set(stages[4].doc_id)
    totals = stages[5].groupby("doc_id").agg(n=("length", "sum"), of=("doc_tokens", "first"))
    assert (totals.n == totals.of).all()


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_against_its_sql_twin(spark, sf_dir, name):
    assert compare(spark, duck(sf_dir), sf_dir, QUERIES[name], ORACLE[name]) == ""


@pytest.mark.parametrize("name,columns", [
    ("op2_sentencepiece", {"parity", "round_trip"}), ("op3_secrets", {"n_assign", "n_access", "n_hex", "base_sha256", "spans"}),
    ("op4_packing", {"start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"}),
    ("op8_simhash", {"fingerprint", "component_id"}), ("op10_quality", {"held_out", "score", "predicted"})])
def test_query_covers_all_documents(spark, sf_dir, name, columns):
    got = QUERIES[name](spark, sf_dir).toPandas()
    assert columns | {"doc_id"} <= set(got.columns)
    assert set(got.doc_id) == set(spark.read.parquet(f"{sf_dir}/documents.parquet").toPandas().doc_id)
    if name == "op2_sentencepiece":
        assert got.parity.all() and got.round_trip.all()


def test_queries_are_registered():
    assert {f"op{n}_" for n in range(1, 14)} == {k.split("_")[0] + "_" for k in QUERIES if k.startswith("op")}
    assert set(QUERIES) <= set(entry.queries()) and "pipeline" in QUERIES
