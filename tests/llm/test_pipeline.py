"""The pipeline over a given table, against the operators' brute-force versions."""

import os
import string
import sys
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

sys.path.insert(0, os.path.dirname(__file__))

from oracle_check import compare, connect  # noqa: E402
from test_duplicates import brute_components, brute_fingerprint  # noqa: E402
from test_packing import PATH, check  # noqa: E402
from test_pii import base  # noqa: E402

import __spark_entry__ as entry_point  # noqa: E402
import corpus_pipeline  # noqa: E402
from reportmart.llm import packing, toxicity  # noqa: E402
from reportmart.llm.oracle import ORACLE  # noqa: E402
from reportmart.llm.queries import QUERIES  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return connect(SF_DIR)


def test_registered():
    assert {*QUERIES, "pipeline"} <= entry_point.queries().keys()
    assert ORACLE.keys() <= entry_point.oracle_sql().keys()


@pytest.mark.parametrize("name", ORACLE)
def test_query_against_sql(spark, connection, name):
    assert compare(QUERIES[name](spark, SF_DIR), connection, ORACLE[name]) is None


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in ORACLE and n != "op12_whitening"])
def test_other_queries_return_every_document(spark, name):
    found = {r.doc_id for r in QUERIES[name](spark, SF_DIR).select("doc_id").collect()}
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    assert found == {r.doc_id for r in docs.select("doc_id").collect()}


def test_simhash_query(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()
    fps = [(d.doc_id, brute_fingerprint(d.text)) for d in docs]
    want = {i: (f"{fp:016x}", c) for (i, fp), c in zip(fps, brute_components(fps))}
    found = QUERIES["op2_simhash"](spark, SF_DIR).collect()
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in found} == want


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    kept = [docs.collect()]
    for number, (name, apply) in enumerate(corpus_pipeline.STAGES):
        out = apply(spark, docs, SF_DIR)
        if name != "packing":
            assert out.columns == docs.columns and out.schema.simpleString() == docs.schema.simpleString()
        out.write.parquet(str(tmp_path / str(number)))
        docs = spark.read.parquet(str(tmp_path / str(number)))
        kept.append(docs.collect())
    given, clean, single, near, masked, packed = kept

    model = toxicity.train(spark.createDataFrame(given), labels)
    scores = toxicity.score(spark.createDataFrame(given), model).collect()
    assert {r.doc_id for r in clean} == {r.doc_id for r in scores if not r.predicted}

    lower = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
    last = {}
    for r in sorted(clean, key=lambda r: r.doc_id):
        last[r.text.translate(lower)] = r.doc_id
    assert {r.doc_id for r in single} == set(last.values())

    fps = [(r.doc_id, brute_fingerprint(r.text)) for r in single]
    assert {r.doc_id for r in near} == set(brute_components(fps))

    before = {r.doc_id: r.text for r in near}
    assert before.keys() == {r.doc_id for r in masked}
    for r in masked:
        assert r.n_chars == len(r.text) and not base(r.text)
        assert base(before[r.doc_id]) or r.text == before[r.doc_id]

    library = Tokenizer.from_file(PATH)
    whole = {
        r.doc_id: np.array(library.encode(r.text, add_special_tokens=False).ids + [1], "<u4").tobytes()
        for r in masked
    }
    pieces = []
    for r in packed:
        ids = whole[r.doc_id][4 * r.start : 4 * (r.start + r.length)]
        assert zlib.crc32(ids) == r.ids_crc32
        pieces.append((r.doc_id, r.start, ids, r.loss_tokens, r.sequence_id, r.offset))
    padding, _ = check(pieces, whole, 2048, 256, 2048)
    assert padding == 0


def test_run_gives_what_the_stages_give(spark):
    found = corpus_pipeline.run(spark, SF_DIR)
    assert found.columns == packing.pack(
        spark.read.parquet(f"{SF_DIR}/documents.parquet"), PATH, keep_ids=False
    ).columns
    assert found.count() > 0
