from degraus.quality import checks as q
from degraus.spec import RULES, STATES, Rule


def failed(report):
    return [(r.tipo, r.coluna) for r in report.where("falhou").collect()]


def test_completeness_within_limit(frame):
    df = frame([(1,), (2,), (None,), (4,)], "a INT")
    assert failed(q.column_checks(df, ["a"], 30.0)) == []


def test_completeness_over_limit(frame):
    df = frame([(1,), (None,), (None,), (None,)], "a INT")
    report = q.column_checks(df, ["a"], 10.0)
    assert failed(report) == [("NULOS_ACIMA_LIMITE", "a")]
    row = report.first()
    assert (row.medida, row.pct, row.registros) == (3, 75.0, 4)


def test_required_column_missing(frame):
    assert failed(q.column_checks(frame([(1,), (2,)], "a INT"), ["b"], 10.0)) == [("COLUNA_AUSENTE", "b")]


def test_empty_table_has_no_nulls(frame):
    row = q.column_checks(frame([], "a INT"), ["a"], 0.0).first()
    assert (row.pct, row.registros, row.falhou) == (0.0, 0, False)


def test_uniqueness(frame):
    assert failed(q.uniqueness_check(frame([(1,), (2,), (3,)], "id INT"), ["id"])) == []
    report = q.uniqueness_check(frame([(1,), (1,), (2,), (None,), (None,)], "id INT"), ["id", "absent"])
    assert failed(report) == [("DUPLICATAS", "id")]
    assert report.first().medida == 2


def test_state_domain(frame):
    good = frame([("SP",), ("rj",), (None,)], "sigla_uf STRING")
    assert failed(q.domain_check(good, "sigla_uf", STATES)) == []
    bad = frame([("SP",), ("XX",), ("xx",)], "sigla_uf STRING")
    report = q.domain_check(bad, "sigla_uf", STATES)
    assert failed(report) == [("DOMINIO_INVALIDO", "sigla_uf")]
    assert report.first().medida == 1 and report.first().exemplos == ["XX"]


def test_numeric_range(frame):
    unit = {"idhm": (0.0, 1.0)}
    assert failed(q.column_checks(frame([(0.5,), (0.9,)], "idhm DOUBLE"), ranges=unit)) == []
    report = q.column_checks(frame([(50.0,), (105.0,), (-3.0,)], "taxa DOUBLE"), ranges={"taxa": (0.0, 100.0)})
    assert failed(report) == [("DOMINIO_NUMERICO_INVALIDO", "taxa")]
    assert report.where("falhou").first().medida == 2
    assert failed(q.column_checks(frame([(1,)], "outra INT"), ranges=unit)) == []


def test_decimal_commas_are_in_the_range_and_unreadable_text_fails(frame):
    unit = {"idhm": (0.0, 1.0)}
    assert failed(q.column_checks(frame([("0,5",), ("0.5",), (None,)], "idhm STRING"), ranges=unit)) == []
    assert failed(q.column_checks(frame([("1,5",)], "idhm STRING"), ranges=unit)) == [("DOMINIO_NUMERICO_INVALIDO", "idhm")]
    report = q.column_checks(frame([("0,5",), ("meio",)], "idhm STRING"), ranges=unit)
    assert failed(report) == [("VALOR_ILEGIVEL", "idhm")]
    assert report.where("tipo = 'VALOR_ILEGIVEL'").first().medida == 1


def test_referential_integrity(frame):
    known = frame([("SP",), ("RJ",)], "sigla_uf STRING")
    assert failed(q.reference_check(frame([("SP",), ("RJ",)], "sigla_uf STRING"), "sigla_uf", known, "sigla_uf")) == []
    report = q.reference_check(frame([("SP",), ("ZZ",)], "sigla_uf STRING"), "sigla_uf", known, "sigla_uf")
    assert failed(report) == [("INTEGRIDADE_REFERENCIAL", "sigla_uf")]
    assert report.first().exemplos == ["ZZ"]


def test_many_orphans_are_counted_in_full_with_few_examples(spark):
    df = spark.range(100).selectExpr("lpad(cast(id as string), 3, '0') as k")
    row = q.reference_check(df, "k", df.limit(0), "k").first()
    assert row.medida == 100 and row.exemplos == ["000", "001", "002", "003", "004"]


def test_table_report_and_alert_texts(frame):
    df = frame([(2024, "1", "SP", 50.0), (2024, "1", "ZZ", 105.0), (2024, "2", None, None)],
               "ano INT, id_municipio STRING, sigla_uf STRING, taxa_alfabetizacao DOUBLE")
    states = frame([("SP",)], "sigla_uf STRING")
    report = q.check_table(df, "alfabetizacao_integrado", RULES["silver"]["alfabetizacao_integrado"], "silver", lambda _: states)
    texts = {(r.tipo, r.coluna): (r.valor, r.limite) for r in q.alerts(report).collect()}
    assert texts == {
        ("DUPLICATAS", "ano,id_municipio"): ("1 registros duplicados", "0"),
        ("DOMINIO_NUMERICO_INVALIDO", "taxa_alfabetizacao"): ("1 registros fora de [0.0, 100.0]", "[0.0, 100.0]"),
        ("DOMINIO_INVALIDO", "sigla_uf"): ("1 valores fora do domínio: ZZ", "0"),
        ("INTEGRIDADE_REFERENCIAL", "sigla_uf"): ("1 valores órfãos: ZZ", "0"),
    }
    summary = q.summarise(report).first()
    assert (summary.registros, summary.alertas, summary.status) == (3, 4, "ALERTA")


def test_roll_up(frame):
    good, bad = frame([(1,)], "a INT"), frame([(1,), (1,)], "a INT")
    rule = Rule(("a",), ("a",), 0.0)
    report = q.check_table(good, "x", rule, "bronze").unionByName(q.check_table(bad, "y", rule, "gold"))
    got = {r.camada: tuple(r)[1:] for r in q.roll_up(report).collect()}
    assert got == {"bronze": (1, 1, 0, 0), "gold": (1, 0, 1, 1), "total": (2, 1, 1, 1)}


def test_rule_sets_cover_all_tables():
    assert [len(RULES[layer]) for layer in ("bronze", "silver", "gold")] == [11, 13, 4]
    assert len(STATES) == len(set(STATES)) == 27
