"""Every registered query of this part: contract columns, whole tables, and its statement where it has one."""

import pytest
from compare import connect, duck_bag, spark_bag

from tidemark.llm import queries as Q

FOLDER = "/root/testdata/sf0.001"

#: Columns that the contract names, with their types.
CONTRACT = {
    "op1_toxicity": "doc_id bigint, held_out boolean, score double, predicted int",
    "op2_line_rules": "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, "
    "n_repeat_words bigint, base_failed boolean, kept boolean",
    "op3_chat_format": "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, "
    "formatted_chars bigint",
    "op4_recurrent_lm": "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, "
    "base_score double, score double",
    "op5_secret_scan": "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string",
    "op6_jaccard_join": "doc_id bigint, n_shingles bigint, component_id bigint",
    "op7_quality_neighbours": "doc_id bigint, held_out boolean, score double, predicted int",
    "op8_language_centroids": "doc_id bigint, held_out boolean, lang_pred string, score double",
    "op9_byte_bpe": "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string",
    "op10_string_tiling": "doc_id bigint, item_id bigint, coverage double",
    "op11_structure_repair": "conv_id bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, "
    "illegal bigint, cost bigint, audit string, repaired_sha256 string",
    "op12_substring_dedup": "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string",
    "op13_source_divergence": "lang string, source string, part string, item string, value bigint, rank int",
}


def test_all_are_registered():
    import __spark_entry__ as contract

    assert set(Q.QUERIES) == set(CONTRACT)
    assert set(Q.QUERIES) | {"pipeline"} <= set(contract.queries())
    assert set(Q.ORACLES) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", sorted(CONTRACT))
def test_columns_and_rows(spark, name):
    df = Q.QUERIES[name](spark, FOLDER)
    types = dict(df.dtypes)
    for field in CONTRACT[name].split(", "):
        column, kind = field.split()
        assert types[column] == kind
    rows = df.collect()
    if "doc_id" in types and name != "op10_string_tiling":
        ids = [r["doc_id"] for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id").collect()]
        assert sorted(r["doc_id"] for r in rows) == sorted(ids)
    if name in Q.ORACLES:
        con = connect(FOLDER)
        assert spark_bag(df) == duck_bag(con, Q.ORACLES[name])
        con.close()
