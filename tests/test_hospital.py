"""The hospital Silver/Gold plan on small generated bronze tables."""

from flowlog.plans import hospital as h, pipeline
from flowlog.streaming.ingest import RESCUE_COL


def _bronze(spark, cols, rows):
    cols = list(cols) + [RESCUE_COL, "_source_file", "_ingestion_timestamp"]
    data = [tuple(r) + (None, "f.csv", None) for r in rows]
    schema = ", ".join(f"`{c}` string" for c in cols[:-1]) + ", `_ingestion_timestamp` timestamp"
    return spark.createDataFrame(data, schema)


def _emergency(spark):
    cols = ["CD_ATENDIMENTO", "EMPRESA", "LOCAL_PROCED", "PRESTADOR", "ESPECIALIDADE", "COR_CLASSIF", "SEXO",
            "CONVENIO", "CID", "MOTIVO_ALTA", "DT_HR_TOTEM_RECEP", "INICIO_CLASSIFICACAO", "DT_HR_CLASSIF_RISCO",
            "DH_CADASTRO_RECEPCAO", "FIM_CAD_RECEP", "INI_ATD_MEDICO", "FIM_ATD_MEDICO", "DT_HR_ALTA",
            "DT_ATENDIMENTO", "IDADE", "IDADE_CALCULADA"]
    base = ["P1", "Dr A", "Clinica", "AMARELO1", "F", "SUS", "X1", "alta"]
    t = ["2026-03-01 10:00:00", "2026-03-01 10:05:00", "2026-03-01 10:10:00", "2026-03-01 10:20:00",
         "2026-03-01 10:25:00", "2026-03-01 11:00:00", "2026-03-01 11:30:00", "2026-03-01 12:00:00"]
    rows = [["e1", "HSR", *base, *t, "2026-03-01", "40", "40"],
            ["e1", "HSR", *base, *t[:2], "2026-03-01 09:00:00", *t[3:], "2026-03-01", "40", "40"],  # dup, earlier classif
            ["e2", "HSR", *base, "2026-03-01 10:30:00", "2026-03-01 10:00:00", *t[2:7], "", "2026-03-01", "12.0", "33"],
            ["e3", "OTHER", *base, *t, "2026-03-01", "1", "1"]]
    return _bronze(spark, cols, rows)


def _moves(spark):
    cols = ["ATEND", "HORA", "TIPO", "UNIDADE", "DATA"]
    rows = [["i1", "08:00:00", "INTERNACAO", "1Âº Andar", "2026-03-01"],
            ["i1", "08:00:00", "INTERNACAO", "1Âº Andar", "2026-03-01"],
            ["i1", "09:00:00", "ALTA", "1Âº Andar", "2026-03-02"]]
    return _bronze(spark, cols, rows)


def _inpatient(spark):
    cols = ["ATENDIMENTO", "DT_HR_ATENDIMENTO", "DT_HR_ALTA", "UNIDADE", "PRESTADOR", "ESPECIALID_ATEND",
            "IDADE", "CD_ORIGEM", "CD_LEITO"]
    rows = [["i1", "2026-03-01 07:00:00", "2026-03-02 10:00:00", "U1", "Dr B", "Cardio", "70", "1", "L1"],
            ["i1", "2026-03-01 06:00:00", "2026-03-02 10:00:00", "U1", "Dr B", "Cardio", "70", "1", "L1"]]
    return _bronze(spark, cols, rows)


def test_emergency_silver(spark):
    s = h.build_silver(_emergency(spark), h.SILVER["silver_atendimento_emergencia"])
    rows = {r.CD_ATENDIMENTO: r for r in s.collect()}
    assert set(rows) == {"e1", "e2"}                       # EMPRESA filter
    assert rows["e1"].DT_HR_CLASSIF_RISCO.hour == 9         # earliest classification kept
    assert rows["e1"].COR_CLASSIF == "AMARELO"              # repair
    assert rows["e2"].flag_totem_classif is True and rows["e1"].flag_totem_classif is False
    assert rows["e2"].DT_HR_ALTA is None                    # '' -> null under ANSI
    assert "IDADE" not in s.columns and "EMPRESA" not in s.columns
    m = {r.rule: r.failed for r in h.silver_metrics(s, h.SILVER["silver_atendimento_emergencia"]).collect()}
    assert m["flag_totem_classif"] == 1


def test_gold_log_from_silver(spark):
    ctx = pipeline.run(spark, {"bronze_atendimento_emergencia_raw": _emergency(spark),
                               "bronze_movimentacoes_raw": _moves(spark),
                               "bronze_internacoes_raw": _inpatient(spark)},
                       as_of="2026-03-31", skip_absent=True,
                       only={"silver_atendimento_emergencia", "silver_movimentacoes", "silver_internacoes",
                             "gold_event_log", "gold_data_quality", "gold_variant_analysis", "gold_bottleneck",
                             "gold_sna_handover"})
    log = ctx["gold_event_log"]
    assert log.columns[-1] == "duration_minutes" and "event_seq" in log.columns
    by_src = {r.source: r["count"] for r in log.groupBy("source").count().collect()}
    assert by_src == {"silver_atendimento_emergencia": 16, "silver_movimentacoes": 2, "silver_internacoes": 2}
    moves = ctx["silver_movimentacoes"]
    assert moves.count() == 2 and moves.first().UNIDADE == "1º Andar"
    inp = ctx["silver_internacoes"].first()
    assert inp.DT_HR_ATENDIMENTO.hour == 6 and inp.flag_atendimento_alta is True
    dq = {(r.level, r.activity): r for r in ctx["gold_data_quality"].collect()}
    assert dq[("activity", "Alta da Emergência")].without_timestamp == 1
    case_i1 = {r.duration_minutes for r in log.filter("case_id = 'i1'").collect()}
    assert case_i1 == {28 * 60}  # 03-01 06:00 (earliest admission) to 03-02 10:00


def test_gold_sources_have_38_literal_activities(spark):
    specs = h.gold_sources()
    literal = sum(len(s.events) for s in specs.values())
    assert literal == 38


def test_pipeline_writes_and_rereads_every_stage(spark, tmp_path):
    out = str(tmp_path / "tables")
    ctx = pipeline.run(spark, {"bronze_atendimento_emergencia_raw": _emergency(spark),
                               "bronze_movimentacoes_raw": _moves(spark),
                               "bronze_internacoes_raw": _inpatient(spark)},
                       as_of="2026-03-31", skip_absent=True, out_root=out)
    import os
    written = set(os.listdir(out))
    assert {"silver_atendimento_emergencia", "gold_event_log", "gold_data_quality", "gold_variant_analysis",
            "gold_bottleneck", "gold_performance_spectrum", "gold_conformance", "gold_sna_handover",
            "gold_sna_subcontracting"} <= written
    assert "gold_case_attributes" not in written  # its epidemiology input is absent
    assert ctx["gold_event_log"].count() == 20
    assert ctx["gold_conformance"].filter("fitness = 1.0").count() == ctx["gold_conformance"].count()
    assert pipeline.silver_expectations(ctx).count() > 0


def test_csv_files_to_gold_end_to_end(spark, tmp_path):
    """Landing CSV (';') -> availableNow stream -> bronze -> Silver -> Gold log."""
    import os

    from flowlog.session import checkpoint_dir

    import uuid
    root = os.path.join(checkpoint_dir(spark), "e2e", uuid.uuid4().hex)
    land_in = os.path.join(root, "landing", "internacoes")
    land_mv = os.path.join(root, "landing", "movimentacoes")
    os.makedirs(land_in)
    os.makedirs(land_mv)
    with open(os.path.join(land_in, "2026-03.csv"), "w", encoding="utf-8") as fh:
        fh.write("ATENDIMENTO;DT_HR_ATENDIMENTO;DT_HR_ALTA;UNIDADE;PRESTADOR;ESPECIALID_ATEND;IDADE;CD_ORIGEM\n"
                 "i9;2026-03-01 06:00:00;2026-03-03 06:00:00;U1;Dr C;Orto;55;2\n")
    with open(os.path.join(land_mv, "2026-03.csv"), "w", encoding="utf-8") as fh:
        fh.write("ATEND;HORA;TIPO;UNIDADE;DATA\ni9;07:00:00;INTERNACAO;2Âº Andar;2026-03-01\n"
                 "i9;07:00:00;INTERNACAO;2Âº Andar;2026-03-01\nbroken line\n")
    bronze = h.ingest_hospital(spark, os.path.join(root, "landing"), os.path.join(root, "bronze"),
                               os.path.join(root, "_ck"), skip_absent=True)
    assert set(bronze) == {"bronze_internacoes_raw", "bronze_movimentacoes_raw"}
    ctx = pipeline.run(spark, bronze, as_of="2026-03-31", skip_absent=True,
                       only={"silver_internacoes", "silver_movimentacoes", "gold_event_log"})
    log = ctx["gold_event_log"]
    acts = sorted((r.activity, r.location) for r in log.filter("case_id = 'i9'").collect())
    assert acts == [("Alta da Internacao", "U1"), ("INTERNACAO", "2º Andar"), ("Internacao", "U1")]
    assert {r.duration_minutes for r in log.filter("case_id = 'i9'").collect()} == {2 * 24 * 60}
    # the malformed line survives in bronze (rescued), and yields a null-key row that Silver keeps
    assert bronze["bronze_movimentacoes_raw"].filter("_rescued_data IS NOT NULL").count() == 1
