"""The registered queries: one per operator and the pipeline, and the mix against its SQL."""

import __spark_entry__ as contract
from riskbook.llm.queries import ORACLE_SQL, QUERIES
from tests.conftest import SF_SMALL
from tests.oracle_harness import compare, duck_connect


def test_every_operator_is_registered():
    names = contract.queries()
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(names)
    assert set(ORACLE_SQL) <= set(contract.oracle_sql())


def test_oracles_are_sql_text():
    sql = contract.oracle_sql()
    assert set(sql) <= set(contract.queries())
    assert all(isinstance(v, str) and v.strip().lower().startswith(("select", "with")) for v in sql.values())


def test_mix_matches_its_sql(spark):
    name = "op4_source_mixing"
    r = compare(spark, name, SF_SMALL, contract.queries()[name], contract.oracle_sql()[name], duck_connect(SF_SMALL))
    assert r["status"] == "match", r


def test_result_columns(spark):
    expected = {
        "op2_genetic_packing": ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
        "op3_toxicity_mil": ["doc_id", "held_out", "score", "predicted"],
        "op5_suffix_dedup": ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
        "op6_language_id": ["doc_id", "held_out", "lang_pred", "score"],
        "op8_pii_crf": ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"],
        "op10_scaled_sketch": ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
    }
    for name, columns in expected.items():
        df = contract.queries()[name](spark, SF_SMALL)
        assert df.columns[: len(columns)] == columns
        assert df.count() >= spark.read.parquet(f"{SF_SMALL}/documents.parquet").count()
