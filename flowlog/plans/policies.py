"""Pseudonymisation policies of the hospital exports (AN4).

Apply with :func:`flowlog.operators.privacy.apply_policies`; a dataset
without a policy is skipped.  Birth dates named in ``generalize_columns``
become ``IDADE_CALCULADA`` (age in years at an explicit reference date).
"""

from __future__ import annotations

from flowlog.config import ColumnPolicy

# Per export, the identifier columns to hash, the personal columns
# to drop, and the birth-date columns to generalise, as declared for the exports.
POLICIES: dict[str, ColumnPolicy] = {p.name: p for p in [
    ColumnPolicy(
        name="atendimento_emergencia",
        hash_columns=("CD_PACIENTE", "CD_ATENDIMENTO", "PRESTADOR", "USUARIO_CLASSIF",
                      "USUARIO_CAD_RECEPCAO", "USUARIO_ALTA"),
        drop_columns=("NM_PACIENTE", "CEP", "ENDERECO", "BAIRRO", "CIDADE", "UF"),
        generalize_columns=("DT_NASC",)),
    ColumnPolicy(
        name="internacoes",
        hash_columns=("COD_PACIENTE", "ATENDIMENTO", "CD_PRESTADOR", "PRESTADOR"),
        drop_columns=("PACIENTE",)),
    ColumnPolicy(
        name="movimentacoes",
        hash_columns=("Atend.", "Paciente"),
        drop_columns=("Nome Social",)),
    ColumnPolicy(
        name="cirurgias",
        hash_columns=("CD_PACIENTE", "ATENDIMENTO", "CD_AVISO_CIRURGIA", "CIRURGIAO_01", "CIRURGIAO_02",
                      "ASSISTENTE_01", "ASSISTENTE_02", "ANESTESISTA_01", "ANESTESISTA_02", "CRM", "CRM_01",
                      "CRM_02", "USUARIO_CONFIRMA_CIRURGIA"),
        drop_columns=("NOME_PACIENTE", "DATA_NASCIMENTO")),
    ColumnPolicy(
        name="exames_imagem",
        hash_columns=("CD_ATENDIMENTO", "CD_PRONTUARIO", "NUMERO_ATENDIMENTO", "MEDICO_EXECUTANTE",
                      "MEDICO_LAUDO_DEFINITIVO", "MEDICO_LAUDO_DITADO", "MEDICO_LAUDO_PRELIMINAR",
                      "MEDICO_LAUDO_ULTIMAMODIFICACAO", "MEDICO_LAUDO_WETREAD", "MEDICO_SOLICITANTE",
                      "DIGITADOR_LAUDO_TRANSCRITO"),
        drop_columns=("NOME_PACIENTE", "PATIENT_PERSON_KEY")),
    ColumnPolicy(
        name="atendimentos_box",
        hash_columns=("CD_PACIENTE", "CD_ATENDIMENTO"),
        drop_columns=("NM_PACIENTE",)),
    ColumnPolicy(
        name="altas",
        hash_columns=("ATENDIMENTO", "PREST_ADMISSAO", "PRESC_MED", "PREST_ALTA", "USUARIO_ALTA_MEDICA",
                      "NM_USUARIO_ALTA_HOSPITALAR"),
        drop_columns=("PACIENTE",)),
    ColumnPolicy(
        name="epidemio",
        hash_columns=("prontuario", "atendimento", "crm_prestador", "medico_sumario_alta", "cod_conselho",
                      "ds_codigo_conselho", "medico_resp_atend", "liberacao_alta", "resp_alta",
                      "nm_med_presc", "prestador1", "prestador2"),
        drop_columns=("nome_paciente", "nr_cpf", "data_nascimento", "cep", "endereco", "bairro",
                      "municipio", "uf")),
    ColumnPolicy(
        name="exames_laboratoriais_limpo",
        hash_columns=("ATEND",),
        drop_columns=("NM_PACIENTE",)),
    ColumnPolicy(
        name="movimentacoes_limpo",
        hash_columns=("ATEND",),
        drop_columns=("NM_PACIENTE",)),
]}
