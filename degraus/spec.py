"""Tables, fixed values and quality rules, all as data.

Table and column names are those of the published indicator datasets, so that stored
tables keep their names.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# --- Fixed values ---------------------------------------------------------------------

# Network code -> label.
NETWORK_LABELS = {
    0: "Total",
    1: "Federal",
    2: "Estadual",
    3: "Municipal",
    4: "Privada",
    5: "Pública",
}

# Which network stands for an entity when several are published, best first.
NETWORK_PRIORITY = ["Pública", "Municipal", "Estadual", "Privada", "Total", "Federal"]

# Network scope in which targets are set.
CITY_TARGET_SCOPE = "Municipal"
STATE_TARGET_SCOPE = "Pública"

# Half-open bands [low, high) of the rate, and the label of everything else.
RISK_BANDS = [
    (0.0, 50.0, "Crítico"),
    (50.0, 70.0, "Atenção"),
    (70.0, 90.0, "Adequado"),
    (90.0, 100.01, "Meta próxima/atingida"),
]
RISK_DEFAULT = "Não classificado"

# Census vintage used for enrichment, proficiency cut-off, smallest group that is ranked.
HDI_YEAR = 2010
PROFICIENCY_CUTOFF = 743
MIN_STUDENTS = 300
TARGET_PATH_FROM = 2024
TARGET_PATH_END = 2030

# Proficiency histogram: first edge, last edge, width.
PROFICIENCY_BINS = (560, 920, 20)

TARGET_PREFIX = "meta_alfabetizacao_"

# Federation units, by code.
STATES = [
    "AC", "AL", "AM", "AP", "BA", "CE", "DF", "ES", "GO",
    "MA", "MG", "MS", "MT", "PA", "PB", "PE", "PI", "PR",
    "RJ", "RN", "RO", "RR", "RS", "SC", "SE", "SP", "TO",
]

# Texts a CSV reader takes for a missing value (the usual dataframe defaults).
MISSING_TEXTS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

# Event topics and the keys an event of the topic must carry.
TOPIC_INDICATORS = "alfabetizacao.indicadores"
TOPIC_TARGETS = "alfabetizacao.metas"
REQUIRED_KEYS = {
    TOPIC_INDICATORS: [
        "evento", "timestamp", "id_municipio", "sigla_uf", "ano",
        "indicador_alfabetizacao", "total_alunos_avaliados", "ponto_corte_saeb", "fonte",
    ],
    TOPIC_TARGETS: [
        "evento", "timestamp", "sigla_uf", "ano", "meta_percentual", "revisao", "fonte",
    ],
}

# Types of event values in Silver; Bronze keeps them as text.
EVENT_TYPES = {
    TOPIC_INDICATORS: {
        "ano": "int", "indicador_alfabetizacao": "double", "total_alunos_avaliados": "int", "ponto_corte_saeb": "int",
    },
    TOPIC_TARGETS: {"ano": "int", "meta_percentual": "double"},
}
EVENT_TABLES = {TOPIC_INDICATORS: "streaming_indicadores", TOPIC_TARGETS: "streaming_metas"}
REJECTED_TABLE = "streaming_rejeitados"

# --- Source tables --------------------------------------------------------------------
# File, table and column names of the published datasets, and the partition columns of the stored tables.


@dataclass(frozen=True)
class SourceTable:
    """Where a Bronze table comes from; ``types`` lists columns that are not text. A name that ends
    in ``*`` stands for all columns with that beginning, such as a target column per year.

    ``utf8`` states the encoding where it is known and spares the check of the whole file; ``multiline`` reads quoted
    line breaks, at the price of one task per file."""

    file: str
    warehouse: str | None
    types: dict[str, str] = field(default_factory=dict)
    partitions: tuple[str, ...] = ()
    mandatory: bool = True
    utf8: bool | None = None
    multiline: bool = False


_RESULT = {
    "ano": "int", "rede": "int", "taxa_alfabetizacao": "double", "media_portugues": "double",
    "proporcao_aluno_nivel_*": "double",
}
_TARGET = {
    "ano": "int", "taxa_alfabetizacao": "double", "percentual_participacao": "double", f"{TARGET_PREFIX}*": "double",
}
_DATASET = "br_inep_avaliacao_alfabetizacao"
_DIRECTORY = "br_bd_diretorios_brasil"

SOURCES = {
    "indicador_municipio": SourceTable(
        f"{_DATASET}_municipio.csv", f"{_DATASET}.municipio", _RESULT, ("ano",)),
    "indicador_uf": SourceTable(f"{_DATASET}_uf.csv", f"{_DATASET}.uf", _RESULT, ("ano",)),
    "meta_brasil": SourceTable(
        f"{_DATASET}_meta_alfabetizacao_brasil.csv", f"{_DATASET}.meta_alfabetizacao_brasil", _TARGET, ("ano",)),
    "meta_uf": SourceTable(
        f"{_DATASET}_meta_alfabetizacao_uf.csv", f"{_DATASET}.meta_alfabetizacao_uf", _TARGET, ("ano",)),
    "meta_municipio": SourceTable(
        f"{_DATASET}_meta_alfabetizacao_municipio.csv", f"{_DATASET}.meta_alfabetizacao_municipio",
        {**_TARGET, "nivel_alfabetizacao": "int"}, ("ano",)),
    "alunos": SourceTable(
        f"{_DATASET}_alunos.csv", f"{_DATASET}.alunos",
        {"ano": "int", "rede": "int", "presenca": "flag", "preenchimento_caderno": "flag",
         "alfabetizado": "flag", "proficiencia": "double", "peso_aluno": "double"}, ("ano",)),
    "diretorio_municipio": SourceTable(
        f"{_DIRECTORY}_municipio.csv", f"{_DIRECTORY}.municipio",
        {"amazonia_legal": "int", "capital_uf": "int"}),
    "diretorio_uf": SourceTable(f"{_DIRECTORY}_uf.csv", f"{_DIRECTORY}.uf"),
    # Optional enrichment, CSV only; the indexes stay text because they may use a decimal comma.
    "idhm_municipio": SourceTable(
        "atlas_desenvolvimento_humano_municipio.csv", None, {"ANO": "int"}, (), False),
}

# Partition columns of the stored Silver and Gold tables.
SILVER_PARTITIONS = {
    "indicador_municipio": ("ano",),
    "indicador_uf": ("ano",),
    "indicador_brasil": ("ano",),
    "meta_brasil": ("ano_meta",),
    "meta_uf": ("ano_meta",),
    "meta_municipio": ("ano_meta",),
    "diretorio_municipio": (),
    "diretorio_uf": (),
    "alunos": ("ano",),
    # Rows with one key have one time, so a day is merged by itself.
    "indicador_streaming": ("ano", "data"),
    "meta_streaming": ("ano", "data"),
    "idhm_municipio": ("ano",),
    "alfabetizacao_integrado": ("ano",),
}
GOLD_PARTITIONS = {
    "indicador_alfabetizacao_municipio": ("ano",),
    "comparacao_metas_resultados": ("ano",),
    # Written per (level, year), so a run limited to some years keeps the other years.
    "evolucao_temporal": ("nivel", "ano"),
    "monitoramento_streaming": ("topico",),
}

# --- Quality rules --------------------------------------------------------------------


@dataclass(frozen=True)
class Rule:
    """What a stored table must satisfy."""

    keys: tuple[str, ...]
    required: tuple[str, ...]
    max_null_pct: float
    ranges: dict[str, tuple[float, float]] = field(default_factory=dict)
    domains: dict[str, list[str]] = field(default_factory=dict)
    references: dict[str, tuple[str, str]] = field(default_factory=dict)
    mandatory: bool = True
    # Many wide rows: look for repeated keys on their hashes first.
    large: bool = False


def _rule(keys, required, max_null_pct, *, state=True, **kw) -> Rule:
    domains = {"sigla_uf": STATES} if state else {}
    return Rule(keys, required, max_null_pct, domains=domains, **kw)


# Keys, required columns and highest share of nulls (percent) per table.
RULES: dict[str, dict[str, Rule]] = {
    "bronze": {
        "indicador_municipio": _rule(("ano", "id_municipio", "serie", "rede"), ("ano", "id_municipio", "rede", "taxa_alfabetizacao"), 40.0),
        "indicador_uf": _rule(("ano", "sigla_uf", "serie", "rede"), ("ano", "sigla_uf", "rede", "taxa_alfabetizacao"), 40.0),
        "meta_brasil": _rule(("ano", "rede"), ("ano", "rede"), 5.0),
        "meta_uf": _rule(("ano", "sigla_uf", "rede"), ("ano", "sigla_uf", "rede"), 15.0),
        "meta_municipio": _rule(("ano", "id_municipio", "rede"), ("ano", "id_municipio", "rede"), 5.0),
        "alunos": _rule(("ano", "id_municipio", "id_escola", "id_aluno"), ("ano", "id_municipio", "id_aluno", "alfabetizado"), 10.0, large=True),
        "diretorio_municipio": _rule(("id_municipio",), ("id_municipio", "nome", "sigla_uf"), 15.0),
        "diretorio_uf": _rule(("sigla",), ("sigla", "nome", "regiao"), 0.0),
        "streaming_indicadores": _rule(
            ("id_municipio", "ano", "timestamp"), ("id_municipio", "sigla_uf", "ano", "indicador_alfabetizacao"), 0.0, mandatory=False),
        "streaming_metas": _rule(
            ("sigla_uf", "ano", "timestamp"), ("sigla_uf", "ano", "meta_percentual"), 0.0, mandatory=False),
        "idhm_municipio": _rule(
            ("ANO", "Codmun7"), ("ANO", "Codmun7", "IDHM"), 0.0, mandatory=False,
            ranges={c: (0.0, 1.0) for c in ("IDHM", "IDHM_E", "IDHM_L", "IDHM_R")}),
    },
    "silver": {
        "indicador_municipio": _rule(
            ("ano", "id_municipio", "serie", "rede"), ("ano", "id_municipio", "rede_label", "taxa_alfabetizacao"), 40.0),
        "indicador_uf": _rule(("ano", "sigla_uf", "serie", "rede"), ("ano", "sigla_uf", "rede_label", "taxa_alfabetizacao"), 40.0),
        "indicador_brasil": _rule(("ano",), ("ano", "taxa_alfabetizacao"), 0.0),
        "meta_brasil": _rule(("ano_meta",), ("ano_meta", "valor_meta"), 0.0),
        "meta_uf": _rule(("sigla_uf", "ano_meta"), ("sigla_uf", "ano_meta", "valor_meta"), 0.0),
        "meta_municipio": _rule(("id_municipio", "ano_meta"), ("id_municipio", "ano_meta", "valor_meta"), 0.0),
        "diretorio_municipio": _rule(("id_municipio",), ("id_municipio", "nome_municipio", "sigla_uf"), 5.0),
        "diretorio_uf": _rule(("sigla_uf",), ("sigla_uf", "nome_uf", "regiao"), 0.0),
        "alunos": _rule(("ano", "id_municipio", "id_escola", "id_aluno"), ("ano", "id_municipio", "id_aluno"), 10.0, large=True),
        "alfabetizacao_integrado": _rule(
            ("ano", "id_municipio"), ("ano", "id_municipio", "sigla_uf", "taxa_alfabetizacao"), 40.0,
            references={"sigla_uf": ("diretorio_uf", "sigla_uf")},
            ranges={"taxa_alfabetizacao": (0.0, 100.0)}),
        "indicador_streaming": _rule(
            ("id_municipio", "ano", "timestamp"), ("id_municipio", "sigla_uf", "ano", "indicador_alfabetizacao"), 0.0, mandatory=False),
        "meta_streaming": _rule(("sigla_uf", "ano", "timestamp"), ("sigla_uf", "ano", "meta_percentual"), 0.0, mandatory=False),
        "idhm_municipio": _rule(
            ("ano", "id_municipio"), ("ano", "id_municipio", "idhm"), 0.0, mandatory=False,
            ranges={c: (0.0, 1.0) for c in ("idhm", "idhm_educacao", "idhm_longevidade", "idhm_renda")}),
    },
    "gold": {
        "indicador_alfabetizacao_municipio": _rule(
            ("ano", "id_municipio"), ("ano", "id_municipio", "sigla_uf", "taxa_alfabetizacao"), 40.0,
            ranges={"taxa_alfabetizacao": (0.0, 100.0)}),
        "comparacao_metas_resultados": _rule(
            ("ano", "sigla_uf"), ("ano", "sigla_uf", "taxa_alfabetizacao", "meta_alfabetizacao"), 0.0),
        "evolucao_temporal": _rule(("nivel", "referencia", "ano"), ("nivel", "referencia", "ano", "indicador"), 0.0),
        "monitoramento_streaming": _rule(
            ("topico",), ("topico", "total_eventos", "cobertura_distinta"), 0.0, mandatory=False),
    },
}
