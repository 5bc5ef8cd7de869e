"""The hospital configuration: eight Silver tables and the Gold event log.

Each Silver table is a :class:`SilverSpec` run by one generic builder
(filter, rename, repair, sentinel -> null, typed parsing, temporal flags,
expectations, deduplication, drops); each Gold source is a
:class:`~flowlog.config.SourceSpec` turned into canonical events with one
unpivot.  Column names and activity names below are fixed values: they are
the schema of the source exports and the event vocabulary of the log.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, functions as F

from flowlog.config import EventSpec, Rule, SkewConfig, SourceSpec
from flowlog.functions import (
    combine_date_time, nullify, ok_flag, parse_date, parse_int, parse_timestamp, respace_datetime,
    violation_flag,
)
from flowlog.functions._util import apart
from flowlog.operators import cleanse, eventlog as el, quality as dq

WIDE = 8        # parsed columns that one generated method holds without growing past what the JVM compiles
INGEST_COLUMNS = ("_rescued_data", "_source_file", "_ingestion_timestamp")


@dataclass(frozen=True)
class SilverSpec:
    """Typed, cleaned, flagged and deduplicated view of one bronze table."""

    name: str
    bronze: str
    filters: tuple[tuple[str, str], ...] = ()          # (column, required value)
    renames: tuple[tuple[str, str], ...] = ()
    repairs: tuple[tuple[str, str, str], ...] = ()     # (column, pattern, replacement)
    sentinels: tuple[str, ...] = ()                    # '//' -> null
    respace: tuple[str, ...] = ()                      # glued dd/MM/yyyyHH:mm
    combine: tuple[tuple[str, str, str, str | None], ...] = ()  # (out, date, time, fmt)
    derive: tuple[tuple[str, str, str | None], ...] = ()       # (out, text column, fmt)
    timestamps: tuple[tuple[str | None, tuple[str, ...]], ...] = ()  # (fmt, columns)
    dates: tuple[tuple[str | None, tuple[str, ...]], ...] = ()
    ints: tuple[str, ...] = ()
    violation_flags: tuple[tuple[str, str, str], ...] = ()  # (flag, a, b): a > b
    ok_flags: tuple[tuple[str, str, str], ...] = ()         # (flag, a, b): a <= b, null-aware
    rules: tuple[Rule, ...] = ()
    dedup_keys: tuple[str, ...] = ()
    dedup_order: str | None = None
    dedup_ascending: bool = True
    drops: tuple[str, ...] = field(default=INGEST_COLUMNS)
    optional: tuple[str, ...] = ()                     # columns that an export may lack

    def needed(self) -> list[str]:
        """Columns (renamed) that the export must hold: all that the spec reads, but the optional ones."""
        read = [dict(self.renames).get(c, c) for c, _ in self.filters] + [c for _, c in self.renames]
        read += [c for c, _, _ in self.repairs]
        read += [*self.sentinels, *self.respace, *self.ints, *self.dedup_keys]
        read += [c for _, d, t, _ in self.combine for c in (d, t)] + [c for _, c, _ in self.derive]
        read += [c for _, names in (*self.timestamps, *self.dates) for c in names]
        read += [c for _, a, b in (*self.violation_flags, *self.ok_flags) for c in (a, b)]
        read += [self.dedup_order] if self.dedup_order else []
        made = {out for out, *_ in (*self.combine, *self.derive)}
        return [c for c in dict.fromkeys(read) if c not in made and c not in self.optional]


def build_silver(bronze: DataFrame, spec: SilverSpec, case_col: str | None = None) -> DataFrame:
    """Apply a :class:`SilverSpec`; ``drop`` rules remove rows, ``warn`` rules only report.

    With ``case_col``, a text column, the table is dealt to tasks by it and has one more, ``CASE``, for passes by
    case that follow; for tables without hot cases (:func:`has_hot_cases`).

    A column that the spec reads and the export lacks is an error, unless the
    spec lists it as optional; then its steps are left out (a flag over it sees null).
    """
    df = bronze
    if spec.renames:
        df = df.withColumnsRenamed(dict(spec.renames))
    present = set(df.columns)
    absent = [c for c in spec.needed() if c not in present]
    if absent:
        raise ValueError(f"{spec.bronze} lacks {', '.join(absent)}")
    for c, v in spec.filters:
        df = df.filter(F.col(dict(spec.renames).get(c, c)) == v)

    def col(c):
        return F.col(f"`{c}`")

    cols: dict = {}
    for c, pattern, repl in spec.repairs:
        if c in present:
            cols[c] = F.regexp_replace(cols.get(c, col(c)), pattern, repl)
    for c in spec.sentinels:
        if c in present:
            cols[c] = nullify(cols.get(c, col(c)))
    if cols:
        df = df.withColumns(cols)
    typed: dict = {}
    for out, d, t, fmt in spec.combine:
        if d in present:
            typed[out] = combine_date_time(col(d), col(t) if t in present else F.lit(None), fmt)
    for out, src, fmt in spec.derive:
        if src in present:
            typed[out] = parse_timestamp(col(src), fmt)
    for fmt, names in spec.timestamps:
        for c in names:
            if c in present:
                src = respace_datetime(col(c)) if c in spec.respace else col(c)
                typed[c] = parse_timestamp(src, fmt)
    for fmt, names in spec.dates:
        for c in names:
            if c in present:
                typed[c] = parse_date(col(c), fmt)
    for c in spec.ints:
        if c in present:
            typed[c] = parse_int(col(c))
    if len(typed) > WIDE:
        typed = {c: apart(v) for c, v in typed.items()}
    if typed:
        df = df.withColumns(typed)
    have = set(df.columns)

    def ts(c):
        return col(c) if c in have else F.lit(None).cast("timestamp")

    flags = {n: violation_flag(ts(a), ts(b)) for n, a, b in spec.violation_flags}
    flags.update({n: ok_flag(ts(a), ts(b)) for n, a, b in spec.ok_flags})
    dropping = [r for r in spec.rules if r.action == "drop"]
    # a flag follows from columns that the deduplication orders by, so it is made of the rows that stay
    late = not ({w for r in dropping for w in _identifiers(r.predicate)} | have) & set(flags)
    if flags and not late:
        df = df.withColumns(flags)
    df = dq.apply_expectations(df, dropping)
    keys, by, order = list(spec.dedup_keys), None, df.columns
    keyed = case_col and (case_col in keys or not keys)
    if keyed:
        # the case travels once
        df = df.withColumn(el.CASE, el.case_key(col(case_col))).drop(case_col)
    if case_col in keys:
        # one row a case: that is dealt by case without more, and combined before; else rows are dealt as they are
        keys = [k for k in keys if k != case_col]
        keys, by = (keys, el.CASE) if keys else ([el.CASE], None)
    if spec.dedup_keys:
        # dropped columns behind the last kept one decide between rows that are alike in all that is kept
        read = {c for _, a, b in (*spec.violation_flags, *spec.ok_flags) for c in (a, b)}
        for c in reversed([c for c in df.columns if c not in (*spec.dedup_keys, spec.dedup_order, el.CASE)]):
            if c in read or c not in spec.drops:
                break
            df = df.drop(c)
        df = cleanse.keep_one(df, keys, spec.dedup_order, spec.dedup_ascending, by=by)
    if case_col and not keyed:
        df = df.withColumn(el.CASE, el.case_key(col(case_col))).drop(case_col)
    if case_col and case_col not in spec.dedup_keys:
        df = cleanse.deal(df.drop(*[c for c in spec.drops if c not in {w for f in (*spec.violation_flags, *spec.ok_flags) for w in f}]), el.CASE)
    if case_col:
        df = df.withColumn(case_col, el.case_of_key(F.col(el.CASE))).select(*[f"`{c}`" for c in order if c == case_col or c in df.columns], el.CASE)
    if flags and late:
        df = df.withColumns(flags)
    return df.drop(*[c for c in spec.drops if c in df.columns])


def silver_metrics(silver: DataFrame, spec: SilverSpec) -> DataFrame:
    """Expectation results of one Silver table (computed on its output, after dedup).

    Rules over optional columns that the table lacks are skipped.
    """
    cols = set(silver.columns)
    rules = [r for r in spec.rules
             if all(tok in cols for tok in _identifiers(r.predicate))]
    return dq.expectation_metrics(silver, spec.name, rules)


def _identifiers(predicate: str) -> list[str]:
    import re
    words = re.findall(r"[A-Za-z_][A-Za-z0-9_]*", predicate)
    return [w for w in words if w.upper() not in {"IS", "NOT", "NULL", "OR", "AND", "TRUE", "FALSE"}]


def _flag_rule(flag: str, a: str, b: str, polarity: str) -> Rule:
    if polarity == "violation":
        return Rule(flag, f"{a} <= {b} OR {a} IS NULL OR {b} IS NULL")
    return Rule(flag, f"{flag} IS NULL OR {flag} = true")


# Timestamp layouts of the exports.
BR_MINUTES = "dd/MM/yyyy HH:mm"
BR_SECONDS = "dd/MM/yyyy HH:mm:ss"
ISO_SECONDS = "yyyy-MM-dd HH:mm:ss"

# Export columns, flags and keys of the eight Silver tables.
_EMERG_FLAGS = (
    ("flag_totem_classif", "DT_HR_TOTEM_RECEP", "INICIO_CLASSIFICACAO"),
    ("flag_classif_recep", "DT_HR_CLASSIF_RISCO", "DH_CADASTRO_RECEPCAO"),
    ("flag_recep_atend", "FIM_CAD_RECEP", "INI_ATD_MEDICO"),
    ("flag_atend_alta", "FIM_ATD_MEDICO", "DT_HR_ALTA"),
)
_SURGERY_FLAGS = (
    ("flag_entrada_anestesia", "DT_HR_ENTRADA_SALA_CIRURG", "INICIO_ANESTESIA"),
    ("flag_anestesia_cirurgia", "INICIO_ANESTESIA", "DT_INICIO_CIRURGIA"),
    ("flag_cirurgia_fim", "DT_INICIO_CIRURGIA", "DT_FIM_CIRURGIA"),
    ("flag_fim_anestesia", "DT_FIM_CIRURGIA", "FIM_ANESTESIA"),
    ("flag_anestesia_saida", "FIM_ANESTESIA", "DT_HR_SAIDA_SALA_CIRURG"),
)
_IMAGING_FLAGS = (
    ("flag_prescricao_admissao", "DATA_HORA_PRESCRICAO", "STATUS_ADMITIDO"),
    ("flag_admissao_inicio", "STATUS_ADMITIDO", "STATUS_INICIO_EXAME"),
    ("flag_inicio_termino", "STATUS_INICIO_EXAME", "STATUS_TERMINO_EXAME"),
    ("flag_termino_liberado", "STATUS_TERMINO_EXAME", "STATUS_LIBERADO"),
)
_LAB_FLAGS = (
    ("flag_pedido_coleta", "HR_PED_LAB", "DT_COLETA"),
    ("flag_coleta_laudo", "DT_COLETA", "HR_LAUDO_LAB"),
)
_INPATIENT_FLAGS = (("flag_atendimento_alta", "DT_HR_ATENDIMENTO", "DT_HR_ALTA"),)
_IMAGING_STATUS = (
    "DATA_DITADO", "DATA_LAUDO", "STATUS_A_REVISAR", "STATUS_A_TRANSCREVER", "STATUS_ADMITIDO",
    "STATUS_APROVADO", "STATUS_CANCELADO_RIS", "STATUS_EDITAR_LAUDO", "STATUS_FIM_PREPARO",
    "STATUS_INICIO_EXAME", "STATUS_INICIO_PREPARO", "STATUS_LIBERADO", "STATUS_PACIENTE_RECONVOCADO",
    "STATUS_PAUSA_EXAME", "STATUS_PENDENCIA", "STATUS_PENDENCIA_ANDAMENTO", "STATUS_PRELIMINAR",
    "STATUS_PRONTO_RETIRAR", "STATUS_RETIRADO", "STATUS_TERMINO_EXAME", "STATUS_WETREAD",
)

SILVER: dict[str, SilverSpec] = {
    "silver_altas": SilverSpec(
        name="silver_altas", bronze="bronze_altas_raw",
        repairs=(("UNID_INT", r"\?", "o"),),
        combine=(("DT_HR_ATENDIMENTO", "DT_ATENDIMENTO", "HR_ATENDIMENTO", None),
                 ("DT_HR_ALTA_MEDICA", "DT_ALTA_MEDICA", "HR_ALTA_MEDICA", None),
                 ("DT_HR_ALTA_FINAL", "DT_ALTA_FINAL", "HR_ALTA_FINAL", None)),
        derive=(("DT_HR_PRE_MED", "HR_PRE_MED", None),),
        ints=("COD_CONVENIO", "QTD_DIARIAS_UTI", "QTD_DIARIAS_UNID_ABERTA"),
        rules=(Rule("atendimento_valido", "ATENDIMENTO IS NOT NULL", "drop"),),
        dedup_keys=("ATENDIMENTO",), dedup_order="DT_HR_PRE_MED", dedup_ascending=False,
        drops=("DT_ATENDIMENTO", "HR_ATENDIMENTO", "DT_ALTA_MEDICA", "HR_ALTA_MEDICA", "DT_ALTA_FINAL",
               "HR_ALTA_FINAL", "HR_PRE_MED", "FREQUENCIA", *INGEST_COLUMNS),
    ),
    "silver_atendimento_emergencia": SilverSpec(
        name="silver_atendimento_emergencia", bronze="bronze_atendimento_emergencia_raw",
        filters=(("EMPRESA", "HSR"),),
        repairs=(("COR_CLASSIF", "AMARELO1", "AMARELO"),),
        timestamps=((None, ("DT_HR_TOTEM_RECEP", "CHAMADA_CLASSIFICACAO", "INICIO_CLASSIFICACAO",
                            "DT_HR_CLASSIF_RISCO", "CHAMADA_CAD_RECEP", "DH_CADASTRO_RECEPCAO",
                            "FIM_CAD_RECEP", "DH_ATEND_MEDICO", "INI_ATD_MEDICO", "FIM_ATD_MEDICO",
                            "DT_HR_TRANF_LEITO", "DT_HR_SAIDA_LEITO", "DT_HR_ALTA")),),
        dates=((None, ("DT_ATENDIMENTO",)),),
        ints=("IDADE", "COD_TRIAGEM", "REGISTRO_ANS", "IDADE_CALCULADA"),
        violation_flags=_EMERG_FLAGS,
        rules=tuple(_flag_rule(n, a, b, "violation") for n, a, b in _EMERG_FLAGS),
        dedup_keys=("CD_ATENDIMENTO",), dedup_order="DT_HR_CLASSIF_RISCO", dedup_ascending=True,
        drops=("CONTA", "TOTAL_CONTA", "CONTA_FECHADA", "CD_LEITO", "ENCAMINHADO_LEITO",
               "DT_HR_TRANF_LEITO", "DT_HR_SAIDA_LEITO", "DT_ATENDIMENTO_FILTRO", "IDADE", "EMPRESA",
               *INGEST_COLUMNS),
        # read by no flag, key, event or case attribute
        optional=("CHAMADA_CLASSIFICACAO", "CHAMADA_CAD_RECEP", "DH_ATEND_MEDICO", "DT_HR_TRANF_LEITO",
                  "DT_HR_SAIDA_LEITO", "COD_TRIAGEM", "REGISTRO_ANS"),
    ),
    "silver_cirurgias": SilverSpec(
        name="silver_cirurgias", bronze="bronze_cirurgias_raw",
        repairs=(("SEXO", "MASCULIN0", "MASCULINO"), ("TIPO_ATENDIMENTO", r"INTERNAC\?O", "INTERNACAO")),
        timestamps=((None, ("DT_AVISO_CIRURGIA", "DT_AGENDA_CIR", "INICIO_PROGRAMADO_CIRURGIA",
                            "FINAL_PROGRAMADO_CIRURGIA", "DATA_INICIO_CIRURGIA", "DT_HR_ENTRADA_SALA_CIRURG",
                            "DT_HR_SAIDA_SALA_CIRURG", "INICIO_ANESTESIA", "FIM_ANESTESIA", "INICIO_LIMPEZA",
                            "FIM_LIMPEZA", "DT_INICIO_CIRURGIA", "DT_FIM_CIRURGIA")),),
        ints=("IDADE", "CD_AVISO_CIRURGIA", "CD_CIRURGIA_AVISO", "CODIGO_CIRURGIA", "COD_FATURAMENTO"),
        violation_flags=_SURGERY_FLAGS,
        rules=tuple(_flag_rule(n, a, b, "violation") for n, a, b in _SURGERY_FLAGS),
        drops=("data", "hora", "Dia", "tempo", "tempo_acesso", "Tempo_permanencia", "ATRASO_CIRURGIA",
               "GIRO_SALA", "HORÁRIO_ADM_ATB", "TEMPO ATB", "ATB < 60min?", "DT_HR_ENTRADA_RPA",
               "DT_HR_SAIDA_RPA", "LOCAL_TRANSF_POS_CIRURGIA", "UNID_INT_POS_CIR", "LEITO_POS_CIR",
               "DT_CHEGADA_RPA", "DT_ALTA_ANESTESIA", "ANESTESISTA", "DT_SAIDA_RPA", "USU_CONF_REGISTRO",
               *INGEST_COLUMNS),
    ),
    "silver_epidemio": SilverSpec(
        name="silver_epidemio", bronze="bronze_epidemio_raw",
        combine=(("dt_hr_alta", "dt_alta", "hr_alta", BR_SECONDS),),
        timestamps=((BR_MINUTES, ("dt_atendimento",)), (BR_SECONDS, ("hr_pre_med",)),
                    (None, ("previsao_alta", "dtsumario"))),
        dates=(("dd/MM/yyyy", ("entrada_uti", "dt_saida")), ("dd/MM/yy", ("dt_proc_1", "dt_proc_2"))),
        ints=("idade", "registro_ans", "nr_dias", "cod_proc_1", "cod_proc_2", "cd_cirurgia_1",
              "cd_cirurgia_2", "qtd_diarias_uti", "qtd_uco", "qtd_uco_retag", "qtd_uti_geral",
              "qtd_uti_cirurgica_2", "qtd_uti_geral_3", "qtd_uti_neo", "qtd_uti_ped", "qtd_uti_alerta",
              "qtd_passagens_uti"),
        rules=(Rule("atendimento_valido", "atendimento IS NOT NULL", "drop"),),
        drops=("dt_alta", "hr_alta", "vl_conta", "vl_honorario", "saps3_admissao", "saps3_obito",
               "peso_nascer", "sn_fechada", "CAPÍTULO BREVE", "GRUPO", *INGEST_COLUMNS),
    ),
    "silver_exames_imagem": SilverSpec(
        name="silver_exames_imagem", bronze="bronze_exames_imagem_raw",
        filters=(("Unidade", "HSR"),),
        sentinels=("DATA_HORA_PRESCRICAO", *_IMAGING_STATUS),
        respace=("DATA_HORA_PRESCRICAO",),
        timestamps=((BR_MINUTES, (*_IMAGING_STATUS, "DATA_HORA_PRESCRICAO")),
                    (ISO_SECONDS, ("DH_MAX", "DH_MIN"))),
        ints=("CODIGO_PROCEDIMENTO",),
        ok_flags=_IMAGING_FLAGS,
        rules=tuple(_flag_rule(n, a, b, "ok") for n, a, b in _IMAGING_FLAGS),
        dedup_keys=("CD_ATENDIMENTO", "CODIGO_PROCEDIMENTO"), dedup_order="DH_MIN",
        drops=("DIA", "MES", "MES_ANO", "NUMERO_ATENDIMENTO", "Contagem Linhas", *INGEST_COLUMNS),
    ),
    "silver_exames_laboratoriais": SilverSpec(
        name="silver_exames_laboratoriais", bronze="bronze_exames_laboratoriais_raw",
        renames=(("ATEND", "CD_ATENDIMENTO"),),
        timestamps=((ISO_SECONDS, ("HR_PED_LAB", "DT_COLETA", "HR_LAUDO_LAB", "HR_CHAM_MED")),),
        ok_flags=_LAB_FLAGS,
        rules=tuple(_flag_rule(n, a, b, "ok") for n, a, b in _LAB_FLAGS),
        dedup_keys=("CD_ATENDIMENTO", "CD_EXAME"), dedup_order="HR_PED_LAB",
    ),
    "silver_internacoes": SilverSpec(
        name="silver_internacoes", bronze="bronze_internacoes_raw",
        renames=(("ATENDIMENTO", "CD_INTERNACAO"),),
        timestamps=((ISO_SECONDS, ("DT_HR_ATENDIMENTO", "DT_HR_ALTA")),),
        ints=("IDADE", "CD_ORIGEM"),
        ok_flags=_INPATIENT_FLAGS,
        rules=tuple(_flag_rule(n, a, b, "ok") for n, a, b in _INPATIENT_FLAGS),
        dedup_keys=("CD_INTERNACAO",), dedup_order="DT_HR_ATENDIMENTO",
        drops=("CD_LEITO", *INGEST_COLUMNS),
    ),
    "silver_movimentacoes": SilverSpec(
        name="silver_movimentacoes", bronze="bronze_movimentacoes_raw",
        renames=(("ATEND", "CD_INTERNACAO"),),
        repairs=(("UNIDADE", "Âº", "º"),),
        combine=(("DT_HR_MOVIMENTACAO", "DATA", "HORA", ISO_SECONDS),),
        dedup_keys=("CD_INTERNACAO", "DT_HR_MOVIMENTACAO", "TIPO"), dedup_order="DT_HR_MOVIMENTACAO",
        drops=("DATA", "HORA", *INGEST_COLUMNS),
    ),
}


# The event vocabulary, in the order events happen inside each source.
EVENT_SOURCES = {
    "silver_movimentacoes": SourceSpec(
        name="silver_movimentacoes", case_col="CD_INTERNACAO", event_type="movimentacao",
        case_type="internacao", location_col="UNIDADE", activity_col="TIPO",
        ts_col="DT_HR_MOVIMENTACAO"),
    "silver_internacoes": SourceSpec(
        name="silver_internacoes", case_col="CD_INTERNACAO", event_type="internacao",
        case_type="internacao", specialty_col="ESPECIALID_ATEND", resource_col="PRESTADOR",
        location_col="UNIDADE",
        events=(EventSpec("DT_HR_ATENDIMENTO", "Internacao"),
                EventSpec("DT_HR_ALTA", "Alta da Internacao"))),
    "silver_altas": SourceSpec(
        name="silver_altas", case_col="ATENDIMENTO", event_type="alta", case_type="alta",
        specialty_col="DS_ESPECIALID", location_col="UNID_INT",
        events=(EventSpec("DT_HR_PRE_MED", "Prescricao de alta", "PREST_ALTA"),
                EventSpec("DT_HR_ALTA_MEDICA", "Alta médica"),
                EventSpec("DT_HR_ALTA_FINAL", "Alta Hospitalar"))),
    "silver_cirurgias": SourceSpec(
        name="silver_cirurgias", case_col="ATENDIMENTO", event_type="cirurgia", case_type="cirurgico",
        specialty_col="ESPECIALIDADE", location_col="SALA_CIRURGIA",
        events=(EventSpec("DT_AVISO_CIRURGIA", "Aviso de Cirurgia"),
                EventSpec("DT_AGENDA_CIR", "Agendamento de Cirurgia"),
                EventSpec("INICIO_PROGRAMADO_CIRURGIA", "Inicio Programado da Cirurgia"),
                EventSpec("FINAL_PROGRAMADO_CIRURGIA", "Fim Programado da Cirurgia"),
                EventSpec("DT_HR_ENTRADA_SALA_CIRURG", "Entrada na Sala Cirurgica"),
                EventSpec("INICIO_ANESTESIA", "Inicio da Anestesia", "ANESTESISTA_01"),
                EventSpec("DT_INICIO_CIRURGIA", "Inicio da Cirurgia", "CIRURGIAO_01"),
                EventSpec("DT_FIM_CIRURGIA", "Fim da Cirurgia", "CIRURGIAO_01"),
                EventSpec("FIM_ANESTESIA", "Fim da Anestesia", "ANESTESISTA_01"),
                EventSpec("DT_HR_SAIDA_SALA_CIRURG", "Saida da Sala Cirurgica"),
                EventSpec("INICIO_LIMPEZA", "Inicio da Limpeza da Sala"),
                EventSpec("FIM_LIMPEZA", "Fim da Limpeza da Sala"))),
    "silver_atendimento_emergencia": SourceSpec(
        name="silver_atendimento_emergencia", case_col="CD_ATENDIMENTO", event_type="emergencia",
        case_type="emergencia", specialty_col="ESPECIALIDADE", resource_col="PRESTADOR",
        location_col="LOCAL_PROCED",
        events=(EventSpec("DT_HR_TOTEM_RECEP", "Chegada ao Pronto-Socorro"),
                EventSpec("INICIO_CLASSIFICACAO", "Início da Triagem"),
                EventSpec("DT_HR_CLASSIF_RISCO", "Classificação de Risco"),
                EventSpec("DH_CADASTRO_RECEPCAO", "Início do Cadastro"),
                EventSpec("FIM_CAD_RECEP", "Fim do Cadastro"),
                EventSpec("INI_ATD_MEDICO", "Início da Consulta Médica"),
                EventSpec("FIM_ATD_MEDICO", "Fim da Consulta Médica"),
                EventSpec("DT_HR_ALTA", "Alta da Emergência"))),
    "silver_exames_imagem": SourceSpec(
        name="silver_exames_imagem", case_col="CD_ATENDIMENTO", event_type="exames de imagem",
        case_type="", specialty_col="ESPECIALIDADE_MEDICO",
        events=(EventSpec("DATA_HORA_PRESCRICAO", "Prescrição do Exame de Imagem", "MEDICO_SOLICITANTE"),
                EventSpec("STATUS_ADMITIDO", "Admissão no RIS"),
                EventSpec("STATUS_LIBERADO", "Liberação para Início do Exame"),
                EventSpec("STATUS_INICIO_PREPARO", "Início do Preparo"),
                EventSpec("STATUS_FIM_PREPARO", "Fim do Preparo"),
                EventSpec("STATUS_INICIO_EXAME", "Início do Exame"),
                EventSpec("STATUS_TERMINO_EXAME", "Término do Exame de Imagem"),
                EventSpec("DATA_DITADO", "Ditado do Laudo"),
                EventSpec("DATA_LAUDO", "Laudo Registrado no Sistema"),
                EventSpec("STATUS_APROVADO", "Laudo Aprovado"))),
    "silver_exames_laboratoriais": SourceSpec(
        name="silver_exames_laboratoriais", case_col="CD_ATENDIMENTO",
        event_type="exames laboratoriais", case_type="emergencia",
        events=(EventSpec("HR_PED_LAB", "Pedido de Exame Laboratorial"),
                EventSpec("DT_COLETA", "Coleta do Exame Laboratorial"),
                EventSpec("HR_LAUDO_LAB", "Laudo do Exame Laboratorial"))),
}
IMAGING_CASE_TYPE = "TIPO_ATENDIMENTO"      # of imaging rows, the case type is a column


def gold_sources() -> dict[str, SourceSpec]:
    """Event mapping of the seven event-bearing Silver tables (needs an active session)."""
    imaging = replace(EVENT_SOURCES["silver_exames_imagem"], case_type=F.col(IMAGING_CASE_TYPE))
    return {**EVENT_SOURCES, imaging.name: imaging}


def gold_event_log(silver: dict[str, DataFrame]) -> DataFrame:
    """Union of the seven event tables with ``duration_minutes`` (EL1-EL5).

    The duration is joined to the Silver rows, before they are spread into events. Tables that
    :func:`build_silver` has dealt by case are not moved again.
    """
    specs = {name: spec for name, spec in gold_sources().items() if name in silver}
    rows = el.gather_events([(silver[name], spec) for name, spec in specs.items()])
    return el.spread_events(el.with_case_duration(rows), list(specs.values()))


def sampled_events(bronze: dict[str, DataFrame], fraction: float) -> DataFrame | None:
    """Events of a sample of the exports (by Silver table) that may hold many rows of a case, before deduplication.

    Deduplication only takes rows away, so a hot case of the log is hot here too: what
    :func:`~flowlog.operators.eventlog.with_hot_cases` needs, without building the log. Tables that keep one row a case are
    left out; None if there are no others.
    """
    parts = []
    for name, spec in gold_sources().items():
        if name in bronze and SILVER[name].dedup_keys != (spec.case_col,):
            rows = bronze[name].sample(fraction=fraction, seed=17)
            parts.append(el.to_events(build_silver(rows, replace(SILVER[name], dedup_keys=())), spec))
    return el.union_logs(parts) if parts else None


def has_hot_cases(bronze: dict[str, DataFrame], skew: SkewConfig = SkewConfig()) -> bool:
    """Whether a case (null counts as one) is estimated to have ``hot_rows`` rows or more in the exports (by Silver table).

    From a sample of their case columns; deduplication only takes rows away.
    """
    if skew.mode != "detect":
        return skew.mode == "all"
    parts = []
    for name, spec in gold_sources().items():
        if name in bronze:
            raw = {new: old for old, new in SILVER[name].renames}.get(spec.case_col, spec.case_col)
            parts.append(bronze[name].sample(fraction=skew.sample_fraction, seed=17).select(el.case_key(F.col(f"`{raw}`")).alias(el.CASE)))
    sizes = el.union_logs(parts).groupBy(el.CASE).agg(F.count(F.lit(1)).alias("n"))
    return not sizes.where(F.col("n") >= skew.hot_rows * skew.sample_fraction).isEmpty()


CASE_ATTRIBUTES = {
    "case_id": "string", "case_type": "string", "idade": "int", "sexo": "string", "convenio": "string",
    "especialidade": "string", "cid_principal": "string", "motivo_alta": "string",
    "classificacao_risco": "string", "tipo_internacao": "string", "nr_dias": "int",
    "qtd_passagens_uti": "int", "complexidade": "string", "grupo_diagnostico": "string",
    "teve_cirurgia": "string",
}


def gold_case_attributes(epidemio: DataFrame, emergency: DataFrame) -> DataFrame:
    """Inpatient attributes from epidemiology plus emergency attributes (EL6)."""
    inpatient = epidemio.select(
        F.col("atendimento").alias("case_id"), F.col("tp_atendimento").alias("case_type"), "idade",
        "sexo", "convenio", "especialidade", F.col("cid_1_principal").alias("cid_principal"),
        "motivo_alta", "tipo_internacao", "nr_dias", "qtd_passagens_uti",
        F.col("PREVISAO_COMPLEXIDADE").alias("complexidade"),
        F.col("PREVISAO_GRUPO").alias("grupo_diagnostico"), F.col("cirurgia").alias("teve_cirurgia"))
    emerg = emergency.select(
        F.col("CD_ATENDIMENTO").alias("case_id"), F.lit("emergencia").alias("case_type"),
        F.col("IDADE_CALCULADA").alias("idade"), F.col("SEXO").alias("sexo"),
        F.col("CONVENIO").alias("convenio"), F.col("ESPECIALIDADE").alias("especialidade"),
        F.col("CID").alias("cid_principal"), F.col("MOTIVO_ALTA").alias("motivo_alta"),
        F.col("COR_CLASSIF").alias("classificacao_risco"))
    return el.case_attributes([inpatient, emerg], CASE_ATTRIBUTES)


def gold_data_quality(log: DataFrame, as_of: _dt.date | str | None = None) -> DataFrame:
    """Timestamp coverage per (source, activity) and per case (DQ5-DQ7)."""
    return dq.coverage_table(log, as_of)


# Landing folder of each export and the bronze table it feeds.
BRONZE_TABLES = {
    "altas": "bronze_altas_raw",
    "atendimento_emergencia": "bronze_atendimento_emergencia_raw",
    "cirurgias": "bronze_cirurgias_raw",
    "epidemio": "bronze_epidemio_raw",
    "exames_imagem": "bronze_exames_imagem_raw",
    "exames_laboratoriais": "bronze_exames_laboratoriais_raw",
    "movimentacoes": "bronze_movimentacoes_raw",
    "internacoes": "bronze_internacoes_raw",
}


def bronze_sources(landing_root: str, columns: dict[str, tuple[str, ...]] | None = None):
    """One :class:`~flowlog.streaming.IngestSource` per landing folder (IO2).

    ``columns`` optionally declares the header of a folder (for schema
    evolution); otherwise each stream takes the header of the folder's files.
    """
    import os

    from flowlog.streaming.ingest import IngestSource

    columns = columns or {}
    return [IngestSource(folder=os.path.join(landing_root, folder), table=table,
                         columns=tuple(columns.get(folder, ())))
            for folder, table in BRONZE_TABLES.items()]


def ingest_hospital(spark, landing_root: str, bronze_root: str, checkpoint_root: str,
                    columns: dict[str, tuple[str, ...]] | None = None,
                    skip_absent: bool = False) -> dict[str, DataFrame]:
    """Stream every landing folder into its bronze table, wait for all, and
    return the bronze tables by name (EP-A). An absent folder is an error
    unless ``skip_absent``; folders may be in any store that Spark reads. Folders whose
    header is declared in ``columns`` are held to it; in all others every file is read
    by the names of its own header."""
    from flowlog.streaming.evolving import BATCH_COL, ingest_evolving, read_evolving
    from flowlog.streaming.ingest import folder_exists, ingest_to_bronze, read_bronze

    wanted = bronze_sources(landing_root, columns)
    present = [s for s in wanted if folder_exists(spark, s.folder)]
    if len(present) < len(wanted) and not skip_absent:
        raise FileNotFoundError(f"no landing folder {', '.join(s.folder for s in wanted if s not in present)}")
    ingest = {s.table: ingest_to_bronze if s.columns else ingest_evolving for s in present}
    for query in [ingest[s.table](spark, s, bronze_root, checkpoint_root, await_termination=False) for s in present]:
        query.awaitTermination()
    return {s.table: read_bronze(spark, bronze_root, s.table) if s.columns
            else read_evolving(spark, bronze_root, checkpoint_root, s.table).drop(BATCH_COL) for s in present}
