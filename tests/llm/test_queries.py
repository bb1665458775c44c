"""Every named query over the shared tables: against its SQL twin, or for what its contract fixes."""

import hashlib
import re

import duckdb
import numpy as np
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as contract
from curbsight.llm.common import read
from curbsight.llm.oracle import ORACLES
from curbsight.llm.queries import BYTE_VOCABULARY, QUERIES, vocabulary

TABLES = "documents embeddings pages benchmark labels conversations".split()


def ordered(rows):
    return sorted(rows, key=lambda r: tuple((v is None, str(v)) for v in r))


def test_all_are_registered_once():
    names = [n for n in contract.queries() if re.match(r"op\d+_", n)]
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in names) == list(range(1, 14))
    assert "pipeline" in contract.queries() and set(ORACLES) <= set(contract.oracle_sql())


@pytest.mark.parametrize("scale", ["sf0.001", "sf0.01"])
@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows_as_the_twin(spark, sf_dir, name, scale):
    data = sf_dir.replace("sf0.001", scale)
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{data}/{table}.parquet'")
    df = QUERIES[name](spark, data)
    columns = sorted(df.columns)
    cursor = con.execute(ORACLES[name])
    at = {d[0]: i for i, d in enumerate(cursor.description)}
    assert sorted(at) == columns
    expected = ordered(tuple(row[at[c]] for c in columns) for row in cursor.fetchall())
    assert ordered(tuple(r[c] for c in columns) for r in df.collect()) == expected and expected


def test_tokens_and_texts_of_all_documents(spark, sf_dir):
    library = Tokenizer.from_str(vocabulary(BYTE_VOCABULARY))
    texts = {r.doc_id: r.text or "" for r in read(spark, sf_dir, "documents").collect()}
    found = QUERIES["op10_bpe_round_trip"](spark, sf_dir).collect()
    assert len(found) == len(texts)
    for r in found:
        ids = library.encode(texts[r.doc_id], add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest()


def test_classes_of_all_documents(spark, sf_dir):
    from llm.test_near_dedup import expected_fast

    rows = [(r.doc_id, r.text) for r in read(spark, sf_dir, "documents").collect()]
    found = {r.doc_id: r.class_id for r in QUERIES["op5_order_minhash"](spark, sf_dir).collect()}
    assert found == expected_fast(rows)


def test_lines_of_all_documents(spark, sf_dir):
    from llm.test_line_dedup import expected

    rows = [(r.doc_id, r.text) for r in read(spark, sf_dir, "documents").collect()]
    found = {r.doc_id: (r.text, r.removed_lines) for r in QUERIES["op9_line_dedup"](spark, sf_dir).collect()}
    assert found == expected(rows, 50)


def test_sequences_of_all_documents(spark, sf_dir):
    from llm.test_packing import check

    rows = [(r.doc_id, r.text) for r in read(spark, sf_dir, "documents").collect()]
    check(rows, QUERIES["op7_best_fit_packing"](spark, sf_dir).collect())


def test_mixed_sequences_of_all_documents(spark, sf_dir):
    from llm.test_mixture import check

    rows = [(r.doc_id, r.text, r.source) for r in read(spark, sf_dir, "documents").collect()]
    check(rows, QUERIES["op13_mixture_packing"](spark, sf_dir).collect())


def test_whitening_of_all_vectors(spark, sf_dir):
    from llm.test_whitening import check

    rows = [(r.vec_id, r.embedding) for r in read(spark, sf_dir, "embeddings").collect()]
    check(rows, QUERIES["op11_whitening"](spark, sf_dir).collect())
