"""Registered queries: names, columns, types and rows."""

import duckdb
import pytest

import __spark_entry__ as entry
from readloom.llm import queries

SF = "/root/testdata/sf0.001"
#: First columns of each query and their types.
SHAPES = {
    "op1_merge_dropout": "doc_id bigint, ids array<int>, n_ids int, lossless boolean",
    "op2_toxicity": "doc_id bigint, held_out boolean, score double, predicted int",
    "op3_block_topk": "query_id bigint, rank int, vec_id bigint, score bigint",
    "op4_pitman_yor": "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double",
    "op5_secrets": "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string",
    "op6_quality_rules": "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, base_failed boolean, kept boolean",
    "op7_quality_qda": "doc_id bigint, held_out boolean, score double, predicted int",
    "op8_packing": "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint",
    "op9_licenses": "doc_id bigint, n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, labels string, score double",
    "op10_jaccard_join": "doc_id bigint, class_id bigint, n_links bigint",
}


def test_every_number_has_one_query():
    numbered = [n for n in queries.queries() if n.startswith("op")]
    assert sorted(numbered) == sorted(SHAPES) and set(queries.queries()) - set(numbered) <= set(queries.oracle_sql()) and set(SHAPES) | {"pipeline"} <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", list(SHAPES))
def test_shape(spark, name):
    df = queries.queries()[name](spark, SF)
    assert ", ".join(f"{c} {t}" for c, t in df.dtypes).startswith(SHAPES[name])
    ids = {r[0] for r in df.select(df.columns[0]).collect()}
    if name != "op3_block_topk":
        assert ids == {r.doc_id for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


def test_topk_equals_sql(spark):
    con = duckdb.connect()
    con.sql(f"create view embeddings as select * from '{SF}/embeddings.parquet'")
    got = sorted(tuple(r) for r in queries.queries()["op3_block_topk"](spark, SF).collect())
    assert got == sorted(con.sql(queries.OP3_SQL).fetchall()) and got


@pytest.mark.parametrize("name", ["merge_dropout_decoded", "language_model_base", "secret_base", "rules_base", "license_base"])
def test_what_sql_can_express_equals_it(spark, name):
    con = duckdb.connect()
    con.sql(f"create view documents as select * from '{SF}/documents.parquet'")
    df = queries.queries()[name](spark, SF)
    want = con.sql(queries.oracle_sql()[name])
    assert sorted(df.columns) == sorted(want.columns)
    at = [want.columns.index(c) for c in df.columns]
    assert sorted(map(tuple, df.collect()), key=repr) == sorted((tuple(r[k] for k in at) for r in want.fetchall()), key=repr)
