"""The corpus queries that SQL can express, against it; and the columns of the others."""

import pytest

from ledgerline.llm import queries
from tests import oracle

SF = "/root/testdata/sf0.001"

COLUMNS = {
    "op1_bpe": ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
    "op2_toxicity": ["doc_id", "held_out", "score", "predicted"],
    "op3_exact_dedup": ["doc_id", "keep_id", "group_size", "kept", "text_sha256"],
    "op4_simhash": ["doc_id", "fingerprint", "component_id"],
    "op5_lm": ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
    "op6_embed": ["vec_id", "n_links", "component_id", "kept"],
    "op8_token_store": ["doc_id", "start", "n_tokens", "ids_crc32"],
    "op10_token_count": ["doc_id", "n_bytes", "n_tokens", "over_limit"],
    "op12_importance": ["doc_id", "n_features", "weight", "score", "rank"],
    "op13_decontaminate": ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"],
}


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_against_sql(spark, name):
    oracle.check(queries.queries()[name](spark, SF), oracle.connect(SF), queries.oracle_sql()[name])


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_columns_and_rows(spark, name):
    got = queries.queries()[name](spark, SF)
    table = "embeddings" if name == "op6_embed" else "documents"
    assert got.columns == COLUMNS[name]
    assert got.count() == spark.read.parquet(f"{SF}/{table}.parquet").count()
