"""Registered text queries: names, SQL of those that have it, columns of those that have none."""

from __future__ import annotations

import pytest
from parity import connect, difference

import __spark_entry__ as entry_points
from flowledger.llm.queries import ORACLES, QUERIES

SMALL = "/root/testdata/sf0.001"
# Columns that must come back.
COLUMNS = {
    "op2_byte_bpe": "doc_id n_tokens ids_sha256 decoded_sha256",
    "op4_ann": "query_id rank vec_id score",
    "op5_quality": "doc_id held_out score predicted",
    "op6_license_scan": "doc_id n_words n_base first_word last_word base_labels labels score",
    "op7_ctw": "doc_id held_out n_tokens n_known train_tokens base_score score",
    "op8_packing": "doc_id start length ids_crc32 doc_tokens sequence_id offset",
    "op9_embedding_dedup": "vec_id n_links component_id kept",
    "op10_minhash_dedup": "doc_id n_shingles component_id kept",
    "op11_decontamination": "doc_id n_words n_hit n_items items_sha256 contaminated",
    "op12_importance_resampling": "doc_id n_features weight score rank",
    "op13_spelling_variants": "word form root n n_near form_n",
}


def test_all_are_registered():
    names = {*QUERIES, "pipeline"}
    assert names <= set(entry_points.queries()) and set(ORACLES) <= set(entry_points.oracle_sql())
    assert {n.split("_")[0] for n in QUERIES} == {f"op{i}" for i in range(1, 14)}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_sql(spark, name):
    want = connect(SMALL).execute(ORACLES[name]).df()
    assert difference(QUERIES[name](spark, SMALL).toPandas(), want) is None


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_columns(spark, name):
    got = QUERIES[name](spark, SMALL)
    assert set(COLUMNS[name].split()) <= set(got.columns) and got.count() > 0
