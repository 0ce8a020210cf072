"""The registered queries on the smoke tables: their contract's columns and whole results."""

import hashlib
import re
import zlib

import numpy as np
import pytest
from conftest import SMOKE_DIR
from test_html import main_text
from test_lexical import brute as lexical_brute
from test_near_dedup import brute as near_brute
from test_sharding import check as check_shards
from test_tokens import BYTE, WORD, check_packing
from test_warc import brute as warc_brute
from test_whitening import brute as whitening_brute
from tokenizers import Tokenizer

import corpus_pipeline
from quarry.llm.queries import ORACLES, QUERIES


@pytest.fixture(scope="module")
def docs(spark):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMOKE_DIR}/documents.parquet").collect()]


def rows_of(spark, name, columns):
    df = QUERIES[name](spark, SMOKE_DIR)
    kinds = dict(df.dtypes)
    assert [(c, kinds[c]) for c, _ in columns] == columns
    return df.collect()


def test_one_query_per_operator_and_the_pipeline():
    numbers = sorted(int(re.match(r"op(\d+)_", n)[1]) for n in QUERIES if n.startswith("op"))
    assert numbers == list(range(1, 14)) and "pipeline" in QUERIES
    assert set(ORACLES) == {"op1_exact_dedup", "op8_exact_topk", "op11_warc", "op13_lexical_search"}
    assert corpus_pipeline.ORACLE_SQL is None and len(corpus_pipeline.STAGES) == 5


def test_op2(spark, docs):
    word = Tokenizer.from_file(WORD)
    rows = rows_of(spark, "op2_token_counts", [("doc_id", "bigint"), ("n_bytes", "bigint"), ("n_tokens", "bigint"), ("over_limit", "boolean")])
    want = [(i, len(t.encode()), n := len(word.encode(t, add_special_tokens=False).ids), n > 2048) for i, t in docs]
    assert sorted(map(tuple, rows)) == sorted(want)


@pytest.mark.parametrize("name,predict_at", [("op3_quality", 0.3), ("op4_toxicity", 0.5)])
def test_op3_op4(spark, docs, name, predict_at):
    rows = rows_of(spark, name, [("doc_id", "bigint"), ("held_out", "boolean"), ("score", "double"), ("predicted", "int")])
    assert sorted(r.doc_id for r in rows) == sorted(i for i, _ in docs)
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= predict_at)


def test_op5(spark, docs):
    columns = [("doc_id", "bigint"), ("piece", "int"), *[(c, "bigint") for c in ("start", "length", "ids_crc32", "sequence_id", "offset")]]
    rows = rows_of(spark, "op5_best_fit_packing", columns)
    check_packing(rows, docs, Tokenizer.from_file(BYTE))
    assert len({r.sequence_id for r in rows}) <= 1.02 * -(-sum(r.length for r in rows) // 2048) + 1


def test_op6(spark):
    pages = spark.read.parquet(f"{SMOKE_DIR}/pages.parquet").collect()
    rows = rows_of(spark, "op6_html_main_text", [("page_id", "bigint"), ("url", "string"), ("text", "string"), ("n_chars", "bigint")])
    want = [(p.page_id, p.url, t := main_text(p.html or ""), len(t)) for p in pages]
    assert sorted(map(tuple, rows)) == sorted(want)


def test_op7(spark, docs):
    word = Tokenizer.from_file(WORD)
    rows = rows_of(spark, "op7_bpe_roundtrip", [("doc_id", "bigint"), ("n_tokens", "bigint"), ("ids_sha256", "string"), ("decoded_sha256", "string")])
    want = []
    for i, t in docs:
        ids = word.encode(t, add_special_tokens=False).ids
        digests = hashlib.sha256(np.array(ids, "<u4").tobytes()), hashlib.sha256(word.decode(ids, skip_special_tokens=False).encode())
        want.append((i, len(ids), *[d.hexdigest() for d in digests]))
    assert sorted(map(tuple, rows)) == sorted(want)


def test_op9(spark, docs):
    rows = rows_of(spark, "op9_near_dedup", [("doc_id", "bigint"), ("n_shingles", "bigint"), ("component_id", "bigint"), ("kept", "boolean")])
    assert sorted(map(tuple, rows), key=repr) == near_brute(docs)


def test_op10(spark, docs):
    columns = [("doc_id", "bigint"), ("size", "bigint"), ("text_crc32", "bigint"), ("law", "string"), ("shard", "int"), ("slot", "bigint"), ("grown_shard", "int")]
    check_shards(rows_of(spark, "op10_sharding", columns), docs, 24)


def test_op11(spark):
    columns = [("page_id", "bigint"), ("payload_bytes", "bigint"), ("payload_digest", "string"), ("record_type", "string"), ("refers_to", "bigint")]
    pages = [(p.page_id, p.url, p.html) for p in spark.read.parquet(f"{SMOKE_DIR}/pages.parquet").collect()]
    assert sorted(map(tuple, rows_of(spark, "op11_warc", columns)), key=repr) == warc_brute(pages)


def test_op12(spark):
    columns = [("vec_id", "bigint"), ("component", "int"), ("n", "bigint"), ("deviation", "bigint"), ("whitened", "double"), ("explained", "double"), ("identity_error", "double")]
    rows = rows_of(spark, "op12_whitening", columns)
    vectors = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SMOKE_DIR}/embeddings.parquet").collect()]
    ids, n, deviation, centred, v = whitening_brute(vectors)
    assert sorted((r.vec_id, r.deviation) for r in rows if r.component == 8) == sorted(zip(ids, deviation, strict=True))
    z = np.zeros((n, 8))
    at = {i: k for k, i in enumerate(ids)}
    for r in rows:
        z[at[r.vec_id], r.component - 1] = r.whitened
    assert np.abs(z.T @ z / n - np.eye(8)).max() < 1e-9 and rows[0].identity_error < 1e-9
    # a component is an eigenvector: its variance is the eigenvalue, and it takes the covariance to itself
    for c in range(8):
        q = centred.T @ z[:, c]
        q /= np.linalg.norm(q)
        e = q @ v @ q
        assert np.linalg.norm(v @ q - e * q) < 1e-9 * e
        (explained,) = {r.explained for r in rows if r.component == c + 1}
        assert explained == pytest.approx(e / np.trace(v), rel=1e-9)


def test_op13(spark, docs):
    rows = rows_of(spark, "op13_lexical_search", [("item_id", "bigint"), ("rank", "int"), ("doc_id", "bigint"), ("score", "bigint")])
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SMOKE_DIR}/benchmark.parquet").collect()]
    assert sorted(map(tuple, rows), key=repr) == lexical_brute(items, docs)
