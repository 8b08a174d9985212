"""Every catalogue key against its DuckDB oracle (rows-only for model keys)."""

import pytest

import __spark_entry__ as contract
from riskbook.plans.catalog import QUERIES as CATALOG
from tests.conftest import SF_SMALL
from tests.oracle_harness import compare, duck_connect

QUERIES = {k: v for k, v in contract.queries().items() if k in CATALOG}
SQL = {k: v for k, v in contract.oracle_sql().items() if k in CATALOG}
MODEL_KEYS = {"gbt_scores", "feature_importance", "contributions", "cv_metrics", "daily_scores"}


@pytest.fixture(scope="module")
def con():
    return duck_connect(SF_SMALL)


def test_every_key_has_oracle_or_is_model():
    assert set(SQL) | MODEL_KEYS == set(QUERIES)
    assert not (set(SQL) & MODEL_KEYS)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - MODEL_KEYS))
def test_matches_oracle(spark, con, name):
    r = compare(spark, name, SF_SMALL, QUERIES[name], SQL[name], con)
    assert r["status"] == "match", r


def test_entry_smoke(spark):
    df = contract.entry(spark)
    assert "flag_bloqueio" in df.columns and len(df.columns) == 60
    assert df.count() > 0


def test_model_keys_rows(spark):
    scores = QUERIES["gbt_scores"](spark, SF_SMALL)
    assert scores.columns == ["nr_cpf_cnpj", "probabilidade_inadimplente", "flag_predito"]
    rows = scores.collect()
    assert rows and all(0.0 <= r[1] <= 1.0 and r[2] in (0, 1) for r in rows)
    # one row per customer
    assert len({r[0] for r in rows}) == len(rows)
    imp = QUERIES["feature_importance"](spark, SF_SMALL).collect()
    assert len(imp) == 58 and abs(sum(r.importance for r in imp) - (1.0 if any(r.n_splits for r in imp) else 0.0)) < 1e-6
