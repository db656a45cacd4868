"""The same results in plain SQL over the given tables.

Shared steps are named fragments; ``_sql`` puts those a query needs in front of it.
"""

from __future__ import annotations

import re

YEARS = range(1996, 2002)


def _r(expr: str, digits: int = 6) -> str:
    """Half-to-even on the scaled value."""
    return f"(round_even(({expr}) * 1e{digits}, 0) / 1e{digits})"


_NETWORK = (
    "CASE rede WHEN 0 THEN 'Total' WHEN 1 THEN 'Federal' WHEN 2 THEN 'Estadual' "
    "WHEN 3 THEN 'Municipal' WHEN 4 THEN 'Privada' WHEN 5 THEN 'Pública' END"
)


def _band(rate: str) -> str:
    return (
        f"CASE WHEN {rate} >= 0 AND {rate} < 50 THEN 'Crítico' WHEN {rate} >= 50 AND {rate} < 70 THEN 'Atenção' "
        f"WHEN {rate} >= 70 AND {rate} < 90 THEN 'Adequado' WHEN {rate} >= 90 AND {rate} < 100.01e0 "
        "THEN 'Meta próxima/atingida' ELSE 'Não classificado' END"
    )


def _goals(source: str, columns: str, base: str, missing: str) -> str:
    return " UNION ALL ".join(
        f"SELECT {columns}, CAST(ano AS INTEGER) AS ano_referencia, CAST({y} AS INTEGER) AS ano_meta, "
        f"CASE WHEN NOT ({missing}) THEN {base} + CAST({(y - 1996) * 1.5} AS DOUBLE) "
        f"+ CAST(ano - 1995 AS DOUBLE) * 0.25e0 END AS valor_meta FROM {source}"
        for y in YEARS
    )


def _latest_goal(keys: str, source: str) -> str:
    return (
        f"SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY ano_referencia DESC) "
        f"AS rn FROM {source} WHERE valor_meta IS NOT NULL) z WHERE rn = 1"
    )


def _lists(source: str, lists: list[tuple[str, str, bool]], key: str, size: int) -> str:
    """Ranked lists with name, position and tie-break by key."""
    return " UNION ALL ".join(
        f"SELECT * FROM (SELECT *, '{name}' AS lista, CAST(row_number() OVER (ORDER BY {col} {'ASC' if asc else 'DESC'}, {key}) "
        f"AS INTEGER) AS posicao FROM {source} WHERE {col} IS NOT NULL) q_{i} WHERE posicao <= {size}"
        for i, (name, col, asc) in enumerate(lists)
    )


FRAGMENTS = {
    "city_raw": """
        SELECT CAST(year(o_orderdate) AS INTEGER) AS ano, CAST(o_custkey AS VARCHAR) AS id_municipio, '2' AS serie,
               CAST(substr(o_orderpriority, 1, 1) AS TINYINT) AS rede, o_totalprice / 5000.0e0 AS taxa_alfabetizacao,
               o_orderkey AS ordem FROM orders""",
    "city": f"""
        SELECT ano, id_municipio, serie, rede, {_NETWORK} AS rede_label, taxa_alfabetizacao,
               coalesce(taxa_alfabetizacao < 0 OR taxa_alfabetizacao > 100, false) AS flag_taxa_invalida
        FROM (SELECT *, row_number() OVER (PARTITION BY ano, id_municipio, serie, rede ORDER BY ordem DESC) AS rn
              FROM city_raw) z WHERE rn = 1""",
    "headline": """
        SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY ano, id_municipio ORDER BY
            CASE rede WHEN 5 THEN 0 WHEN 3 THEN 1 WHEN 2 THEN 2 WHEN 4 THEN 3 WHEN 0 THEN 4 WHEN 1 THEN 5 ELSE 6 END) AS rn
            FROM city) z WHERE rn = 1""",
    "states": """
        SELECT n_nationkey, n_name AS sigla_uf, r_name AS nome_regiao
        FROM nation LEFT JOIN region ON n_regionkey = r_regionkey""",
    "directory": """
        SELECT CAST(c_custkey AS VARCHAR) AS id_municipio, c_name AS nome_municipio, sigla_uf, sigla_uf AS nome_uf, nome_regiao
        FROM customer LEFT JOIN states ON c_nationkey = n_nationkey""",
    "vintages": """
        SELECT c.*, v.ano FROM customer c, (VALUES (1995), (1997)) v(ano)
        WHERE v.ano = 1995 OR c.c_mktsegment <> 'BUILDING'""",
    "goals_long": _goals(
        "vintages", "CAST(c_custkey AS VARCHAR) AS id_municipio, 'Municipal' AS rede", "c_acctbal / 100.0e0", "c_acctbal < 0"),
    "goals": _latest_goal("id_municipio, rede, ano_meta", "goals_long"),
    "state_vintages": "SELECT s.*, v.ano FROM states s, (VALUES (1995), (1997)) v(ano)",
    "state_goals_long": _goals(
        "state_vintages", "sigla_uf, 'Pública' AS rede", "CAST(n_nationkey AS DOUBLE) + 35.0e0", "nome_regiao = 'MIDDLE EAST'"),
    "state_goals": _latest_goal("sigla_uf, rede, ano_meta", "state_goals_long"),
    "state_results": f"""
        SELECT ano, sigla_uf, rede, {_NETWORK} AS rede_label, taxa_alfabetizacao FROM (
            SELECT ano, sigla_uf, rede, {_r('avg(taxa_alfabetizacao)', 2)} AS taxa_alfabetizacao
            FROM city_raw JOIN directory USING (id_municipio) GROUP BY ano, sigla_uf, rede) z""",
    "national": f"""
        SELECT ano, {_r('avg(taxa_alfabetizacao)', 2)} AS taxa_alfabetizacao FROM city_raw GROUP BY ano""",
    "national_goals_long": " UNION ALL ".join(
        f"SELECT 'Pública' AS rede, ano AS ano_referencia, CAST({y} AS INTEGER) AS ano_meta, "
        f"CASE WHEN {y} > ano THEN taxa_alfabetizacao + CAST({y} - ano AS DOUBLE) * 2.0e0 END AS valor_meta FROM national"
        for y in YEARS
    ),
    "national_goals": _latest_goal("rede, ano_meta", "national_goals_long"),
    "comparison": """
        SELECT c.ano, c.id_municipio, c.taxa_alfabetizacao AS taxa_alfabetizacao_municipal,
               t.valor_meta AS meta_alfabetizacao_municipal, c.taxa_alfabetizacao - t.valor_meta AS gap_meta_municipal,
               coalesce(c.taxa_alfabetizacao - t.valor_meta >= 0, false) AS atingiu_meta_municipal
        FROM city c JOIN goals t ON t.id_municipio = c.id_municipio AND t.ano_meta = c.ano
        WHERE c.rede_label = 'Municipal' AND t.rede = 'Municipal'""",
    "integrated": """
        SELECT h.ano, h.id_municipio, h.rede, h.rede_label, h.taxa_alfabetizacao, d.nome_municipio, d.sigla_uf, d.nome_uf,
               d.nome_regiao, m.taxa_alfabetizacao_municipal, m.meta_alfabetizacao_municipal, m.gap_meta_municipal,
               m.atingiu_meta_municipal
        FROM headline h LEFT JOIN directory d ON d.id_municipio = h.id_municipio
        LEFT JOIN comparison m ON m.ano = h.ano AND m.id_municipio = h.id_municipio""",
    "gold_city": f"""
        SELECT i.ano, id_municipio, nome_municipio, sigla_uf, nome_uf, nome_regiao, rede_label AS escopo_rede_headline,
               i.taxa_alfabetizacao, taxa_alfabetizacao_municipal, meta_alfabetizacao_municipal, gap_meta_municipal,
               atingiu_meta_municipal, n.taxa_alfabetizacao AS indicador_nacional,
               i.taxa_alfabetizacao - n.taxa_alfabetizacao AS gap_indicador_nacional,
               {_band('i.taxa_alfabetizacao')} AS faixa_risco
        FROM integrated i LEFT JOIN national n ON n.ano = i.ano""",
    "rollup_uf": f"""
        SELECT *, {_r('CAST(municipios_meta_atingida AS DOUBLE) / nullif(municipios_avaliados_meta, 0) * 100e0', 2)}
               AS pct_municipios_meta_atingida
        FROM (SELECT ano, sigla_uf, count(DISTINCT id_municipio) AS total_municipios,
                     count(atingiu_meta_municipal) AS municipios_avaliados_meta,
                     count(CASE WHEN atingiu_meta_municipal THEN 1 END) AS municipios_meta_atingida
              FROM integrated WHERE ano IS NOT NULL AND sigla_uf IS NOT NULL GROUP BY ano, sigla_uf) z""",
    "compared_uf": f"""
        SELECT c.ano, c.sigla_uf, c.taxa_alfabetizacao, c.meta_alfabetizacao, c.gap, coalesce(c.gap >= 0, false) AS atingiu_meta,
               r.total_municipios, r.municipios_avaliados_meta, r.municipios_meta_atingida, r.pct_municipios_meta_atingida
        FROM (SELECT s.ano, s.sigla_uf, s.taxa_alfabetizacao, t.valor_meta AS meta_alfabetizacao,
                     {_r('s.taxa_alfabetizacao - t.valor_meta', 2)} AS gap
              FROM state_results s JOIN state_goals t ON t.sigla_uf = s.sigla_uf AND t.ano_meta = s.ano
              WHERE s.rede_label = 'Pública' AND t.rede = 'Pública') c
        LEFT JOIN rollup_uf r ON r.ano = c.ano AND r.sigla_uf = c.sigla_uf""",
    "series": """
        SELECT 'BR' AS referencia, ano, taxa_alfabetizacao AS indicador, 'brasil' AS nivel FROM national
        UNION ALL SELECT sigla_uf, ano, taxa_alfabetizacao, 'uf' FROM state_results WHERE rede_label = 'Pública'""",
    "evolution": f"""
        SELECT referencia, ano, indicador, nivel,
               {_r('indicador - lag(indicador) OVER (PARTITION BY nivel, referencia ORDER BY ano)', 2)} AS variacao_yoy
        FROM series""",
    "overview": f"""
        SELECT e.sigla_uf, {_r('e.fim')} AS indicador_atual, c.meta_alfabetizacao, c.gap, c.atingiu_meta,
               c.pct_municipios_meta_atingida, {_r('e.fim - e.inicio')} AS delta
        FROM (SELECT referencia AS sigla_uf,
                     avg(CASE WHEN ano = (SELECT min(ano) FROM evolution WHERE nivel = 'uf') THEN indicador END) AS inicio,
                     avg(CASE WHEN ano = (SELECT max(ano) FROM evolution WHERE nivel = 'uf') THEN indicador END) AS fim
              FROM evolution WHERE nivel = 'uf' AND (ano = (SELECT min(ano) FROM evolution WHERE nivel = 'uf')
                   OR ano = (SELECT max(ano) FROM evolution WHERE nivel = 'uf')) GROUP BY referencia) e
        LEFT JOIN (SELECT * FROM compared_uf WHERE ano = (SELECT max(ano) FROM compared_uf)) c ON c.sigla_uf = e.sigla_uf""",
    "moves": "SELECT referencia, variacao_yoy FROM evolution WHERE nivel = 'uf' AND ano = 1998",
    "current_city": """
        SELECT id_municipio, nome_municipio, sigla_uf, nome_regiao, taxa_alfabetizacao, faixa_risco, CAST(NULL AS DOUBLE) AS idhm
        FROM gold_city WHERE ano = (SELECT max(ano) FROM gold_city)""",
    "city_change": """
        SELECT e.id_municipio, e.taxa_inicial, e.taxa_atual, e.taxa_atual - e.taxa_inicial AS delta,
               c.nome_municipio, c.sigla_uf, c.nome_regiao
        FROM (SELECT id_municipio,
                     avg(CASE WHEN ano = (SELECT min(ano) FROM gold_city) THEN taxa_alfabetizacao END) AS taxa_inicial,
                     avg(CASE WHEN ano = (SELECT max(ano) FROM gold_city) THEN taxa_alfabetizacao END) AS taxa_atual
              FROM gold_city GROUP BY id_municipio) e LEFT JOIN current_city c ON c.id_municipio = e.id_municipio
        WHERE e.taxa_inicial IS NOT NULL AND e.taxa_atual IS NOT NULL""",
    "students": f"""
        SELECT *, {_NETWORK} AS rede_label,
               CASE WHEN l_tax > 0 THEN coalesce(proficiencia, 0.0e0) >= 743 END AS alfabetizado
        FROM (SELECT CAST(year(l_shipdate) AS INTEGER) AS ano, CAST(l_suppkey AS VARCHAR) AS id_municipio,
                     CAST(l_partkey AS VARCHAR) AS id_escola, CAST(l_orderkey AS VARCHAR) AS id_aluno,
                     CASE l_returnflag WHEN 'A' THEN 2 WHEN 'N' THEN 3 WHEN 'R' THEN 4 END AS rede,
                     l_linestatus = 'F' AS presenca,
                     CASE WHEN l_discount > 0 THEN 560.0e0 + l_quantity * 7.0e0 END AS proficiencia, lineitem.*
              FROM lineitem) z""",
    "present": "SELECT * FROM students WHERE presenca",
    "supplier_states": """
        SELECT DISTINCT CAST(s_suppkey AS VARCHAR) AS id_municipio, sigla_uf
        FROM supplier LEFT JOIN states ON s_nationkey = n_nationkey""",
    "student_states": f"""
        SELECT ano, sigla_uf, count(id_aluno) AS total_avaliados, {_r('avg(CAST(alfabetizado AS INTEGER)) * 100e0')} AS pct_alfabetizado,
               {_r('avg(proficiencia)')} AS proficiencia_media, avg(proficiencia) AS media
        FROM present LEFT JOIN supplier_states USING (id_municipio)
        WHERE ano IS NOT NULL AND sigla_uf IS NOT NULL GROUP BY ano, sigla_uf""",
    "student_rank": """
        SELECT sigla_uf, total_avaliados, pct_alfabetizado, proficiencia_media FROM student_states
        WHERE ano = (SELECT max(ano) FROM present) AND total_avaliados >= 30""",
    "student_change": f"""
        SELECT a.sigla_uf, a.proficiencia_media AS proficiencia_inicial, z.proficiencia_media AS proficiencia_atual,
               {_r('z.media - a.media')} AS delta
        FROM student_states a JOIN student_states z ON a.sigla_uf = z.sigla_uf
        WHERE a.ano = (SELECT min(ano) FROM present) AND z.ano = (SELECT max(ano) FROM present)
          AND a.total_avaliados >= 30 AND z.total_avaliados >= 30""",
    "hdi": """
        SELECT ano, CAST(c_custkey AS VARCHAR) AS id_municipio, c_acctbal / 10000.0e0 AS idhm, c_acctbal / 9000.0e0 AS idhm_educacao,
               c_acctbal / 12000.0e0 AS idhm_longevidade, c_acctbal / 11000.0e0 AS idhm_renda
        FROM customer, (VALUES (1991), (2000), (2010)) v(ano)""",
    "student_records": f"""
        SELECT CAST(year(o_orderdate) AS INTEGER) AS ano, CAST(o_custkey AS VARCHAR) AS id_municipio,
               CAST(l_linenumber AS VARCHAR) AS id_escola, CAST(l_orderkey AS VARCHAR) AS id_aluno,
               {_NETWORK.replace('rede', "CASE l_returnflag WHEN 'A' THEN 2 WHEN 'N' THEN 3 WHEN 'R' THEN 4 END", 1)} AS rede_label,
               l_linestatus = 'F' AS presenca,
               CASE WHEN l_tax > 0 THEN coalesce(CASE WHEN l_discount > 0 THEN 560.0e0 + l_quantity * 7.0e0 END, 0.0e0) >= 743 END
               AS alfabetizado,
               CASE WHEN l_discount > 0 THEN 560.0e0 + l_quantity * 7.0e0 END AS proficiencia,
               row_number() OVER (PARTITION BY year(o_orderdate), o_custkey, l_linenumber, l_orderkey ORDER BY l_shipdate DESC,
                   l_partkey DESC, l_suppkey DESC, l_extendedprice DESC, l_quantity DESC, l_discount DESC, l_tax DESC,
                   l_returnflag DESC, l_linestatus DESC) AS rn
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "event_rows": """
        SELECT event_id, event_type, user_id, value, CAST(props->>'$.k' AS INTEGER) AS k, date_trunc('hour', ts) AS hora,
               'U' || CAST(user_id % 27 AS VARCHAR) AS sigla_uf, CAST(year(ts) AS INTEGER) AS ano,
               CASE WHEN event_type = 'purchase' THEN 'alfabetizacao.metas' ELSE 'alfabetizacao.indicadores' END AS topico,
               CASE WHEN event_type = 'purchase' AND user_id < 10 THEN 'revisao'
                    WHEN event_type = 'error' THEN 'indicador_alfabetizacao' ELSE '' END AS ausentes FROM events""",
    "city_events": """
        SELECT * EXCLUDE (rn) FROM (SELECT CAST(user_id AS VARCHAR) AS id_municipio, ano, hora AS timestamp, event_type AS evento,
               CASE WHEN event_type <> 'signup' THEN value END AS indicador_alfabetizacao,
               row_number() OVER (PARTITION BY user_id, ano, hora ORDER BY event_id DESC) AS rn
        FROM event_rows WHERE ausentes = '' AND topico = 'alfabetizacao.indicadores') z WHERE rn = 1""",
    "target_events": """
        SELECT * EXCLUDE (rn) FROM (SELECT sigla_uf, ano, hora AS timestamp, value AS meta_percentual, value > 50 AS revisao,
               row_number() OVER (PARTITION BY sigla_uf, ano, hora ORDER BY event_id DESC) AS rn
        FROM event_rows WHERE ausentes = '' AND topico = 'alfabetizacao.metas') z WHERE rn = 1""",
}


def _null_check(column: str, source: str, limit: str, test: str | None = None) -> str:
    test = test or f"{column} IS NULL"
    nulls = f"count(CASE WHEN {test} THEN 1 END)"
    pct = _r(f"CAST({nulls} AS DOUBLE) / count(*) * 100e0", 2)
    return (
        f"SELECT 'NULOS_ACIMA_LIMITE' AS tipo, '{column}' AS coluna, {nulls} AS medida, {pct} AS pct, "
        f"CAST({limit} AS DOUBLE) AS limite, count(*) AS registros, {pct} > {limit} AS falhou, '' AS exemplos FROM {source}"
    )


def _row(kind: str, column: str, measure: str, source: str, failed: str, count: str = "count(*)", examples: str = "''") -> str:
    return (
        f"SELECT '{kind}' AS tipo, '{column}' AS coluna, {measure} AS medida, CAST(NULL AS DOUBLE) AS pct, "
        f"CAST(0 AS DOUBLE) AS limite, {count} AS registros, {failed} AS falhou, {examples} AS exemplos FROM {source}"
    )


def _missing(column: str, source: str) -> str:
    return (
        f"SELECT 'COLUNA_AUSENTE' AS tipo, '{column}' AS coluna, CAST(NULL AS BIGINT) AS medida, CAST(NULL AS DOUBLE) AS pct, "
        f"CAST(NULL AS DOUBLE) AS limite, count(*) AS registros, true AS falhou, '' AS exemplos FROM {source}"
    )


_NO_COUNT = "CAST(NULL AS BIGINT)"


def _dup(keys: str, source: str) -> str:
    extra = "CAST(coalesce(sum(n - 1), 0) AS BIGINT)"
    return _row("DUPLICATAS", keys, extra, f"(SELECT count(*) AS n FROM {source} GROUP BY {keys}) g", f"{extra} > 0", _NO_COUNT)


def _count_if(test: str) -> str:
    return f"count(CASE WHEN {test} THEN 1 END)"


_STUDENT_NULLS = [_null_check(c, "students", "5.0") for c in ("ano", "id_municipio", "alfabetizado", "proficiencia")]
_OUT = _count_if("proficiencia < 580 OR proficiencia > 900")
_CITY_OUT = _count_if("taxa_alfabetizacao < 0 OR taxa_alfabetizacao > 100")

FRAGMENTS["bad_regions"] = """
        SELECT DISTINCT upper(nome_regiao) AS v FROM integrated WHERE upper(nome_regiao) NOT IN ('AFRICA', 'AMERICA', 'ASIA', 'EUROPE')"""
FRAGMENTS["orphan_states"] = """
        SELECT DISTINCT sigla_uf FROM integrated i WHERE sigla_uf IS NOT NULL AND NOT EXISTS (
            SELECT 1 FROM states s WHERE s.sigla_uf = i.sigla_uf AND s.nome_regiao <> 'ASIA')"""
FRAGMENTS["report"] = " UNION ALL ".join(
    f"SELECT '{layer}' AS camada, '{table}' AS tabela, * FROM ({part}) p_{i}"
    for i, (layer, table, part) in enumerate(
        [("silver", "alfabetizacao_integrado", p) for p in (
            *(_null_check(c, "integrated", "40.0") for c in ("ano", "id_municipio", "sigla_uf", "taxa_alfabetizacao")),
            _row("DOMINIO_NUMERICO_INVALIDO", "taxa_alfabetizacao", _CITY_OUT, "integrated", f"{_CITY_OUT} > 0"),
            _row("VALOR_ILEGIVEL", "taxa_alfabetizacao", "CAST(0 AS BIGINT)", "integrated", "false"),
            _row("DOMINIO_INVALIDO", "nome_regiao", "count(*)", "bad_regions", "count(*) > 0", _NO_COUNT,
                 "coalesce(string_agg(v, ',' ORDER BY v), '')"),
            _dup("ano,id_municipio", "integrated"),
            _row("INTEGRIDADE_REFERENCIAL", "sigla_uf", "count(*)", "orphan_states", "count(*) > 0", _NO_COUNT,
                 "(SELECT coalesce(string_agg(sigla_uf, ',' ORDER BY sigla_uf), '') FROM (SELECT sigla_uf FROM orphan_states "
                 "ORDER BY sigla_uf LIMIT 5) f)"),
        )]
        + [("bronze", "alunos", p) for p in (
            *_STUDENT_NULLS,
            _missing("peso_aluno", "students"),
            _row("DOMINIO_NUMERICO_INVALIDO", "proficiencia", _OUT, "students", f"{_OUT} > 0"),
            _row("VALOR_ILEGIVEL", "proficiencia", "CAST(0 AS BIGINT)", "students", "false"),
            _dup("ano,id_escola,id_aluno", "students"),
        )]
        + [("silver", "indicador_brasil", p) for p in (
            _null_check("ano", "national", "0.0"), _null_check("taxa_alfabetizacao", "national", "0.0"),
            _dup("ano", "national"),
        )]
    )
)
FRAGMENTS["tables_checked"] = """
        SELECT camada, tabela, max(registros) AS registros, count(CASE WHEN falhou THEN 1 END) AS alertas,
               CASE WHEN count(CASE WHEN falhou THEN 1 END) > 0 THEN 'ALERTA' ELSE 'OK' END AS status
        FROM report GROUP BY camada, tabela"""

_NAMES = "|".join(sorted(FRAGMENTS, key=len, reverse=True))


def _uses(text: str) -> list[str]:
    """Fragments read by a statement: the names behind FROM, JOIN and commas of table lists."""
    found = re.findall(rf"(?:FROM|JOIN)\s+({_NAMES})\b", text)
    return list(dict.fromkeys(found))


def _sql(select: str) -> str:
    """Put the fragments a statement needs in front of it, each after those it uses itself."""
    ordered: list[str] = []

    def visit(text: str) -> None:
        for name in _uses(text):
            if name not in ordered:
                visit(FRAGMENTS[name])
                ordered.append(name)

    visit(select)
    if not ordered:
        return select
    return "WITH " + ", ".join(f"{n} AS ({FRAGMENTS[n].strip()})" for n in ordered) + " " + select


_HIST_BINS = "(SELECT CAST(range AS INTEGER) AS faixa FROM range({n})) b"

ORACLE = {
    "scan_project": "SELECT l_orderkey, l_linenumber, l_extendedprice AS valor FROM lineitem",
    "scan_filter": "SELECT l_orderkey, l_returnflag, l_linenumber, l_quantity FROM lineitem "
                   "WHERE l_returnflag = 'R' AND l_linenumber = 1",
    "filter_years": "SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS ano FROM orders WHERE year(o_orderdate) IN (1996, 1998)",
    "cast_lenient": "SELECT o_orderkey, TRY_CAST(o_orderpriority AS INTEGER) AS inteiro, "
                    "CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS codigo, "
                    "CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END AS preco FROM orders",
    "key_normalise": "SELECT c_custkey, upper(c_name) AS chave FROM customer",
    "decode_label": f"SELECT o_orderkey, rede, {_NETWORK} AS rede_label FROM (SELECT o_orderkey, "
                    "CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS rede FROM orders) z",
    "unmapped_codes": "SELECT DISTINCT p_size AS rede FROM part WHERE p_size NOT BETWEEN 0 AND 5",
    "decimal_comma": "SELECT s_suppkey, CASE WHEN s_acctbal >= 0 THEN s_acctbal END AS valor FROM supplier",
    "ts_parse": "SELECT event_id, CASE WHEN event_type <> 'error' THEN ts END AS instante FROM events",
    "range_flag": "SELECT o_orderkey, coalesce(o_orderstatus <> 'P' AND (o_totalprice / 4000.0e0 < 0 OR "
                  "o_totalprice / 4000.0e0 > 100), false) AS flag_taxa_invalida FROM orders",
    "multi_range_count": "SELECT count(*) AS fora_do_dominio FROM hdi WHERE idhm < 0 OR idhm > 1 OR idhm_educacao < 0 OR "
                         "idhm_educacao > 1 OR idhm_longevidade < 0 OR idhm_longevidade > 1 OR idhm_renda < 0 OR idhm_renda > 1",
    "risk_band": f"SELECT o_orderkey, {_band('taxa')} AS faixa_risco FROM (SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' "
                 "THEN o_totalprice / 4800.0e0 END AS taxa FROM orders) z",
    "sample_seeded": "SELECT o_orderkey, o_custkey FROM orders ORDER BY md5(concat_ws('|', '42', o_orderkey)), o_orderkey LIMIT 5",
    "sample_limit": "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem "
                    "ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey LIMIT 1000",
    "latest_year": "SELECT ano, ordem AS o_orderkey FROM city_raw WHERE ano = (SELECT max(ano) FROM city_raw)",
    "years_available": "SELECT DISTINCT ano FROM city_raw WHERE ano IS NOT NULL",
    "unpivot_latest": "SELECT id_municipio, rede, ano_referencia, ano_meta, valor_meta FROM goals",
    "state_targets": "SELECT sigla_uf, rede, ano_referencia, ano_meta, valor_meta FROM state_goals",
    "national_targets": "SELECT rede, ano_referencia, ano_meta, valor_meta FROM national_goals",
    "pivot_years": "SELECT id_municipio, " + ", ".join(
        _r(f"avg(CASE WHEN ano = {y} THEN taxa_alfabetizacao END)") + f" AS taxa_alfabetizacao_{y}" for y in (1995, 2001)
    ) + " FROM city_raw GROUP BY id_municipio",
    "dedup_last": "SELECT ano, id_municipio, rede, rede_label, taxa_alfabetizacao, flag_taxa_invalida FROM city",
    "dedup_removed": "SELECT CAST(sum(n - 1) AS BIGINT) AS removidos FROM (SELECT count(*) AS n FROM city_raw "
                     "GROUP BY ano, id_municipio, serie, rede) z",
    "headline_pick": "SELECT ano, id_municipio, rede, taxa_alfabetizacao FROM headline",
    "bool_cast": "SELECT ano, id_municipio, id_escola, id_aluno, rede_label, presenca, alfabetizado, proficiencia "
                 "FROM student_records WHERE rn = 1",
    "directory_clean": "SELECT id_municipio, nome_municipio, sigla_uf, nome_regiao FROM directory",
    "integrated": "SELECT * EXCLUDE (nome_uf) FROM integrated",
    "static_enrich": "SELECT c.ano, c.id_municipio, c.rede, h.idhm, h.idhm_educacao, h.idhm_longevidade, h.idhm_renda FROM city c "
                     "LEFT JOIN (SELECT * FROM hdi WHERE ano = 2010) h ON h.id_municipio = c.id_municipio",
    "enrich_coverage": "SELECT count(*) AS registros, count(atingiu_meta_municipal) AS com_meta, count(h.idhm) AS com_idhm "
                       "FROM integrated i LEFT JOIN (SELECT * FROM hdi WHERE ano = 2010) h ON h.id_municipio = i.id_municipio",
    "national_gap": "SELECT c.ano, c.id_municipio, c.rede, c.taxa_alfabetizacao, n.taxa_alfabetizacao AS indicador_nacional, "
                    "c.taxa_alfabetizacao - n.taxa_alfabetizacao AS gap_indicador_nacional FROM city c LEFT JOIN national n ON n.ano = c.ano",
    "dict_decode": "SELECT o_orderkey, o_custkey, CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS rede, "
                   "CASE o_orderstatus WHEN 'F' THEN 'Fechado' WHEN 'O' THEN 'Aberto' END AS situacao, "
                   "CASE WHEN substr(o_orderpriority, 1, 1) <> '4' THEN substr(o_orderpriority, 3) END AS rede_texto, "
                   "c_name AS nome FROM orders LEFT JOIN customer ON c_custkey = o_custkey",
    "ref_integrity": "SELECT DISTINCT l_orderkey FROM lineitem WHERE l_orderkey IS NOT NULL AND NOT EXISTS "
                     "(SELECT 1 FROM orders WHERE o_orderkey = l_orderkey AND o_orderstatus <> 'P')",
    "distinct_dim": "SELECT DISTINCT sigla_uf, nome_regiao FROM directory",
    "domain_set": "SELECT DISTINCT upper(event_type) AS event_type FROM events "
                  "WHERE upper(event_type) NOT IN ('CLICK', 'VIEW', 'PURCHASE')",
    "union_levels": "SELECT * FROM series",
    "gold_entity": "SELECT * FROM gold_city",
    "uf_rollup": "SELECT * FROM rollup_uf",
    "uf_comparison": "SELECT * FROM compared_uf",
    "yoy_change": "SELECT * FROM evolution",
    "national_series": "SELECT ano, indicador, variacao_yoy FROM evolution WHERE nivel = 'brasil'",
    "national_target_path": "SELECT ano_meta AS ano, valor_meta AS meta FROM national_goals WHERE ano_meta >= 1997",
    "national_headline": "SELECT max(ano) AS ano_atual, max_by(indicador, ano) AS indicador_atual, "
                         "(SELECT variacao_yoy FROM evolution WHERE nivel = 'brasil' ORDER BY ano DESC LIMIT 1) AS variacao_yoy, "
                         "(SELECT max(valor_meta) FROM national_goals WHERE ano_meta = 2001) AS meta_final, "
                         "(SELECT max(valor_meta) FROM national_goals WHERE ano_meta = 2001) - max_by(indicador, ano) AS gap_meta_final, "
                         "max_by(indicador, ano) - min_by(indicador, ano) AS delta_periodo, min(ano) AS ano_inicial "
                         "FROM evolution WHERE nivel = 'brasil'",
    "series_by_uf": "SELECT referencia AS sigla_uf, ano, indicador FROM evolution WHERE nivel = 'uf'",
    "uf_overview": "SELECT * FROM overview",
    "uf_ranking": _lists("overview", [
        ("melhores", "indicador_atual", False), ("piores", "indicador_atual", True),
        ("mais_melhoraram", "delta", False), ("mais_pioraram", "delta", True)], "sigla_uf", 5),
    "uf_moves": _lists("moves", [("altas", "variacao_yoy", False), ("quedas", "variacao_yoy", True)], "referencia", 6),
    "muni_rank": _lists("current_city", [
        ("melhores", "taxa_alfabetizacao", False), ("piores", "taxa_alfabetizacao", True)], "id_municipio", 10),
    "muni_delta": _lists("city_change", [("mais_melhoraram", "delta", False), ("mais_pioraram", "delta", True)], "id_municipio", 10),
    "attainment_summary": "SELECT max(ano) AS ano, count(DISTINCT id_municipio) AS total_municipios_avaliados, "
                          "count(atingiu_meta_municipal) AS total_com_meta, count(CASE WHEN atingiu_meta_municipal THEN 1 END) AS atingiram, "
                          + _r("CAST(count(CASE WHEN atingiu_meta_municipal THEN 1 END) AS DOUBLE) / "
                               "nullif(count(atingiu_meta_municipal), 0) * 100e0", 2)
                          + " AS pct_atingiram FROM gold_city WHERE ano = (SELECT max(ano) FROM gold_city)",
    "worst_gap": "SELECT id_municipio, nome_municipio, sigla_uf, taxa_alfabetizacao_municipal, meta_alfabetizacao_municipal, "
                 "gap_meta_municipal FROM gold_city WHERE ano = 1998 AND gap_meta_municipal IS NOT NULL "
                 "ORDER BY gap_meta_municipal, id_municipio LIMIT 10",
    "micro_history": f"SELECT ano, count(*) AS total_avaliados, {_r('avg(CAST(alfabetizado AS INTEGER)) * 100e0')} AS pct_alfabetizado, "
                     f"{_r('avg(proficiencia)')} AS proficiencia_media FROM present WHERE ano IS NOT NULL GROUP BY ano",
    "micro_by_group": f"SELECT rede_label AS rede, count(*) AS total_avaliados, {_r('avg(CAST(alfabetizado AS INTEGER)) * 100e0')} "
                      f"AS pct_alfabetizado, {_r('avg(proficiencia)')} AS proficiencia_media FROM present "
                      "WHERE ano = (SELECT max(ano) FROM present) AND rede_label IS NOT NULL GROUP BY rede_label",
    "micro_by_uf": "SELECT * EXCLUDE (media) FROM student_states",
    "micro_uf_rank": _lists("student_rank", [
        ("melhores", "proficiencia_media", False), ("piores", "proficiencia_media", True)], "sigla_uf", 5),
    "micro_uf_delta": _lists("student_change", [("mais_melhoraram", "delta", False), ("mais_pioraram", "delta", True)], "sigla_uf", 5),
    "histogram_fixed": "SELECT CAST(560 + 20 * faixa AS INTEGER) AS faixa_min, CAST(580 + 20 * faixa AS INTEGER) AS faixa_max, "
                       "count(proficiencia) AS contagem FROM " + _HIST_BINS.format(n=18) +
                       " LEFT JOIN (SELECT proficiencia FROM present WHERE ano = (SELECT max(ano) FROM present)) p "
                       "ON (proficiencia >= 560 + 20 * faixa AND proficiencia < 580 + 20 * faixa) OR (faixa = 17 AND proficiencia = 920) "
                       "GROUP BY faixa",
    "histogram_range": "SELECT faixa, count(x) AS contagem FROM " + _HIST_BINS.format(n=30) + " LEFT JOIN (SELECT taxa_alfabetizacao AS x, "
                       "(SELECT min(taxa_alfabetizacao) FROM city_raw) AS lo, (SELECT max(taxa_alfabetizacao) FROM city_raw) AS hi FROM city_raw) d "
                       "ON (x >= lo + CAST(faixa AS DOUBLE) * ((hi - lo) / 30e0) AND "
                       "(faixa = 29 OR x < lo + CAST(faixa + 1 AS DOUBLE) * ((hi - lo) / 30e0))) GROUP BY faixa",
    "value_counts": "SELECT substr(o_orderpriority, 3) AS rotulo, count(*) AS contagem, "
                    + _r("count(*) / CAST((SELECT count(*) FROM orders) AS DOUBLE)") + " AS proporcao FROM orders GROUP BY 1",
    "value_counts_listed": "SELECT faixa_risco, CAST(ordem AS INTEGER) AS ordem, contagem, " + _r("contagem / CAST(total AS DOUBLE)")
                           + " AS proporcao FROM (VALUES ('Crítico', 0), ('Atenção', 1), ('Adequado', 2), ('Meta próxima/atingida', 3)) "
                           "c(faixa_risco, ordem) LEFT JOIN (SELECT faixa_risco, count(*) AS contagem, sum(count(*)) OVER () AS total FROM "
                           f"(SELECT {_band('(o_totalprice / 6000.0e0)')} AS faixa_risco FROM orders) z GROUP BY faixa_risco) n USING (faixa_risco)",
    "median": "SELECT median(l_extendedprice) AS mediana FROM lineitem",
    "corr_matrix": None,
    "null_profile": None,
    "table_profile": None,
    "dq_completeness": " UNION ALL ".join(
        f"SELECT tipo, coluna, medida, pct, limite, registros, falhou FROM ({p}) p_{i}"
        for i, p in enumerate([*_STUDENT_NULLS, _missing("peso_aluno", "students")])),
    "dq_uniqueness_large": f"SELECT tipo, coluna, medida, falhou FROM ({_dup('ano,id_escola,id_aluno', 'students')}) p",
    "dq_uniqueness": f"SELECT tipo, coluna, medida, falhou FROM ({_dup('ano,id_escola,id_aluno', 'students')}) p",
    "dq_range": f"SELECT 'DOMINIO_NUMERICO_INVALIDO' AS tipo, 'proficiencia' AS coluna, {_OUT} AS medida, CAST(580 AS DOUBLE) AS minimo, "
                f"CAST(900 AS DOUBLE) AS maximo, count(*) AS registros, {_OUT} > 0 AS falhou FROM students UNION ALL "
                "SELECT 'VALOR_ILEGIVEL', 'proficiencia', CAST(0 AS BIGINT), CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE), count(*), false FROM students",
    "dq_domain": "SELECT 'DOMINIO_INVALIDO' AS tipo, 'event_type' AS coluna, count(*) AS medida, count(*) > 0 AS falhou, "
                 "string_agg(v, ',' ORDER BY v) AS exemplos FROM (SELECT DISTINCT upper(event_type) AS v FROM events "
                 "WHERE upper(event_type) NOT IN ('CLICK', 'VIEW', 'PURCHASE')) z",
    "dq_report": "SELECT camada, tabela, tipo, coluna, medida, pct, limite, falhou, exemplos FROM report",
    "dq_tables": "SELECT * FROM tables_checked",
    "dq_summary": "SELECT coalesce(camada, 'total') AS camada, count(*) AS tabelas_verificadas, "
                  "count(CASE WHEN status = 'OK' THEN 1 END) AS tabelas_ok, count(CASE WHEN status = 'ALERTA' THEN 1 END) AS tabelas_com_alerta, "
                  "CAST(sum(alertas) AS BIGINT) AS total_alertas FROM tables_checked GROUP BY ROLLUP (camada)",
    "dq_alerts": "SELECT camada, tabela, tipo, coluna, CASE tipo WHEN 'NULOS_ACIMA_LIMITE' THEN medida || ' (' || pct || '%)' "
                 "WHEN 'DUPLICATAS' THEN medida || ' registros duplicados' "
                 "WHEN 'DOMINIO_NUMERICO_INVALIDO' THEN medida || ' registros fora de [580.0, 900.0]' "
                 "WHEN 'INTEGRIDADE_REFERENCIAL' THEN medida || ' valores órfãos: ' || replace(exemplos, ',', ', ') "
                 "WHEN 'DOMINIO_INVALIDO' THEN medida || ' valores fora do domínio: ' || replace(exemplos, ',', ', ') "
                 "ELSE 'Coluna obrigatória não encontrada na tabela' END AS valor, "
                 "CASE tipo WHEN 'NULOS_ACIMA_LIMITE' THEN limite || '%' WHEN 'DOMINIO_NUMERICO_INVALIDO' THEN '[580.0, 900.0]' ELSE '0' END "
                 "AS limite FROM report WHERE falhou",
    "stream_valid": "SELECT event_type AS evento, strftime(hora, '%Y-%m-%dT%H:%M:%S') AS timestamp, CAST(user_id AS VARCHAR) AS id_municipio, "
                    "sigla_uf, ano, CASE WHEN event_type <> 'signup' THEN value END AS indicador_alfabetizacao, k AS total_alunos_avaliados, "
                    "743 AS ponto_corte_saeb, 'eventos' AS fonte FROM event_rows WHERE ausentes = '' AND topico = 'alfabetizacao.indicadores'",
    "stream_reject": "SELECT topico, ausentes AS campos_ausentes, event_type AS evento, count(*) AS eventos FROM event_rows "
                     "WHERE ausentes <> '' GROUP BY 1, 2, 3",
    "stream_counts": "SELECT topico, count(CASE WHEN ausentes = '' THEN 1 END) AS processados, "
                     "count(CASE WHEN ausentes <> '' THEN 1 END) AS invalidos FROM event_rows GROUP BY topico",
    "stream_dedup": "SELECT id_municipio, ano, timestamp, evento, indicador_alfabetizacao FROM city_events",
    "stream_dedup_targets": "SELECT sigla_uf, ano, timestamp, meta_percentual, revisao FROM target_events",
    "stream_monitor": "SELECT *, " + _r("total_eventos / nullif(janela_segundos, 0)", 3) + " AS eventos_por_segundo FROM ("
                      "SELECT topico, count(*) AS total_eventos, count(DISTINCT entidade) AS cobertura_distinta, min(timestamp) AS primeiro_evento, "
                      "max(timestamp) AS ultimo_evento, (epoch_us(max(timestamp)) - epoch_us(min(timestamp))) / 1e6 AS janela_segundos FROM ("
                      "SELECT 'indicadores' AS topico, id_municipio AS entidade, timestamp FROM city_events UNION ALL "
                      "SELECT 'metas', sigla_uf, timestamp FROM target_events) u GROUP BY topico) z",
}

_VARIABLES = {
    "quantidade": "CASE WHEN l_discount > 0 THEN l_quantity END",
    "preco": "l_extendedprice",
    "imposto": "CASE WHEN l_tax > 0 THEN l_quantity + l_tax * 100e0 END",
}
ORACLE["corr_matrix"] = " UNION ALL ".join(
    f"SELECT '{x}' AS variavel_a, '{y}' AS variavel_b, {_r(f'corr({_VARIABLES[x]}, {_VARIABLES[y]})')} AS correlacao FROM lineitem"
    for x in _VARIABLES for y in _VARIABLES
)
_STUDENT_COLUMNS = ["ano", "id_municipio", "id_escola", "id_aluno", "rede", "presenca", "alfabetizado", "proficiencia", "rede_label"]
ORACLE["null_profile"] = "SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT '{c}' AS coluna, {_count_if(f'{c} IS NULL')} AS nulos, "
    f"{_r(f'CAST({_count_if(f'{c} IS NULL')} AS DOUBLE) / count(*) * 100e0', 1)} AS pct_nulos FROM students"
    for c in _STUDENT_COLUMNS
) + ") z WHERE pct_nulos > 0"
_PROFILED = [c for c in _STUDENT_COLUMNS if c not in ("id_escola", "id_aluno")]
_NULLS = " + ".join(_count_if(f"{c} IS NULL") for c in _PROFILED)
ORACLE["table_profile"] = (
    f"SELECT 'alunos' AS tabela, count(*) AS registros, {len(_PROFILED)} AS colunas, CAST({_NULLS} AS BIGINT) AS nulos_total, "
    + _r(f"CAST({_NULLS} AS DOUBLE) / (count(*) * {len(_PROFILED)}) * 100e0", 2)
    + " AS pct_nulos, count(*) - (SELECT count(*) FROM (SELECT DISTINCT "
    + ", ".join(_PROFILED) + " FROM students) d) AS duplicatas FROM students"
)


def oracle_sql() -> dict[str, str]:
    return {name: _sql(text) for name, text in ORACLE.items()}
