import re

import duckdb
import pytest

import __spark_entry__ as entry
from rill.llm import queries

SF = "/root/testdata/sf0.001"


def test_every_operator_is_registered():
    names = entry.queries()
    assert {int(m[1]) for n in names if (m := re.match(r"op(\d+)_", n))} == set(range(1, 14)) and "pipeline" in names
    assert set(queries.ORACLE) <= set(names)


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_oracle(spark, name):
    db = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "labels"):
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    want = db.execute(queries.ORACLE[name]).df()
    got = queries.QUERIES[name](spark, SF).toPandas()
    cols = sorted(want.columns)
    assert sorted(got.columns) == cols
    assert sorted(map(tuple, got[cols].values.tolist())) == sorted(map(tuple, want[cols].values.tolist()))


@pytest.mark.parametrize("name, columns", [
    ("op1_quality", "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept"),
    ("op2_simhash", "doc_id fingerprint component_id"),
    ("op4_toxicity", "doc_id held_out score predicted"),
    ("op5_topk", "query_id rank vec_id score"),
    ("op6_licences", "doc_id n_words n_base first_word last_word base_labels labels score"),
    ("op7_bpe", "doc_id n_tokens ids_sha256 decoded_sha256"),
    ("op8_mainpaths", "page_id url text n_chars"),
    ("op9_secrets", "doc_id n_assign n_access n_hex base_sha256 spans"),
    ("op10_tokenfiles", "doc_id start n_tokens ids_crc32"),
    ("op11_alignment", "doc_id n_a n_b n_groups n_links n_best count_sum groups_sha256"),
    ("op12_clusters", "vec_id cluster distance cluster_inertia inertia centroid_sha256"),
    ("op13_subwords", "doc_id held_out score predicted"),
])
def test_contract_columns(spark, name, columns):
    df = queries.QUERIES[name](spark, SF)
    assert df.columns[:len(columns.split())] == columns.split() and df.count() > 0
