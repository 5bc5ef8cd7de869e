import hashlib

import pytest

from flowlog.operators import privacy
from flowlog.plans.policies import POLICIES


def test_emergency_policy_drop_hash_generalise(spark):
    df = spark.createDataFrame([("p1", "123", "Ana", "01/02/1990", "x"), (None, "124.0", "Bia", "bad", "y")],
                               "CD_PACIENTE string, CD_ATENDIMENTO string, NM_PACIENTE string, DT_NASC string, "
                               "OTHER string")
    out = privacy.apply_policy(df, POLICIES["atendimento_emergencia"], "s", "2026-02-01", date_format="dd/MM/yyyy")
    assert "NM_PACIENTE" not in out.columns and "DT_NASC" not in out.columns
    rows = out.collect()
    assert rows[0].CD_PACIENTE == hashlib.sha256(b"s.p1").hexdigest() and rows[1].CD_PACIENTE is None
    assert rows[0].CD_ATENDIMENTO == hashlib.sha256(b"s.123").hexdigest()
    assert rows[1].CD_ATENDIMENTO == hashlib.sha256(b"s.124").hexdigest()
    assert rows[0].IDADE_CALCULADA == 36 and rows[1].IDADE_CALCULADA is None


def test_missing_salt_raises_and_unknown_dataset_skipped(spark):
    df = spark.createDataFrame([("1",)], "ATEND string")
    with pytest.raises(ValueError):
        privacy.apply_policy(df, POLICIES["movimentacoes_limpo"], None, "2026-01-01")
    out = privacy.apply_policies({"movimentacoes_limpo": df, "unknown": df}, POLICIES, "s", "2026-01-01")
    assert set(out) == {"movimentacoes_limpo"}
    assert len(POLICIES) == 10
