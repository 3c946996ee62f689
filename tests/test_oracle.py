"""Every query with a SQL form equals its DuckDB oracle at sf0.01 (order-insensitive)."""

import pytest

from conftest import SF01
from convaudit.oracle_queries import SQL
from convaudit.registry import QUERIES
from convaudit.testing import compare

KEYS = sorted(SQL)


def test_every_query_has_oracle_or_is_ml():
    ml = {"lr_neg_prob", "rf_neg_prob", "gbt_neg_prob", "regress_score",
          "predict_label_lr", "ensemble_neg_prob", "model_report", "chat_audit_lr", "speech_audit_lr"}
    assert set(QUERIES) - set(SQL) == ml


@pytest.mark.parametrize("name", KEYS)
def test_matches_oracle(spark, duck01, name):
    r = compare(spark, name, SF01, duck01)
    assert r["cols_match"], r
    assert r["match"], r
    assert not r["type_diffs"], r
