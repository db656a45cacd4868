"""Check a table against its rule.

Every check yields one report row with the measured count and the verdict:
camada, tabela, tipo, coluna, medida, pct, minimo, maximo, limite, registros, falhou, exemplos.
Nulls, ranges and the row count come from one aggregate over the table, or from the write of the table if that took it;
uniqueness needs a grouping by key, each domain the distinct values of one column, each reference an anti join on
distinct keys.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from degraus.functions import decimal_comma, out_of_range, round_even
from degraus.operators.lookups import orphan_keys, outside_domain
from degraus.operators.selection import count_removed, count_removed_of_few
from degraus.spec import Rule

EXAMPLES = 5

REPORT_COLUMNS = [
    "camada", "tabela", "tipo", "coluna", "medida", "pct", "minimo", "maximo", "limite", "registros",
    "falhou", "exemplos",
]


def _line(kind: str, column: str, **cells: Column | float | int | bool | None) -> Column:
    """One report row as a struct; cells that are not given are null."""
    kinds = {
        "medida": "bigint", "pct": "double", "minimo": "double", "maximo": "double", "limite": "double",
        "falhou": "boolean", "exemplos": "array<string>",
    }
    fields = [F.lit(kind).alias("tipo"), F.lit(column).alias("coluna")]
    for name, sql_type in kinds.items():
        value = cells.get(name)
        value = value if isinstance(value, Column) else F.lit(value)
        fields.append(value.cast(sql_type).alias(name))
    return F.struct(*fields)


def _lines(row: DataFrame, lines: Sequence[Column]) -> DataFrame:
    return row.select("registros", F.inline(F.array(*lines)))


def column_measures(
    columns: Sequence[str], required: Sequence[str] = (), ranges: Mapping[str, tuple[float, float]] | None = None
) -> list[Column]:
    """Aggregates for completeness and ranges: rows, nulls per required column, numbers out of range, unreadable texts."""
    aggs = [F.count("*").alias("registros")]
    aggs += [F.count_if(F.col(c).isNull()).alias(f"nulos_{i}") for i, c in enumerate(required) if c in columns]
    for i, (column, (low, high)) in enumerate((ranges or {}).items()):
        if column in columns:
            text = F.col(column).cast("string")
            number = decimal_comma(text)
            aggs.append(F.count_if(out_of_range(number, low, high)).alias(f"fora_{i}"))
            aggs.append(F.count_if(text.isNotNull() & number.isNull()).alias(f"ilegivel_{i}"))
    return aggs


def column_lines(
    row: DataFrame,
    columns: Sequence[str],
    required: Sequence[str] = (),
    max_null_pct: float = 5.0,
    ranges: Mapping[str, tuple[float, float]] | None = None,
) -> DataFrame:
    """Report rows from one row of ``column_measures``."""
    lines = []
    for i, column in enumerate(required):
        if column not in columns:
            lines.append(_line("COLUNA_AUSENTE", column, falhou=True))
            continue
        nulls = F.col(f"nulos_{i}")
        pct = F.coalesce(round_even(F.try_divide(nulls, F.col("registros")) * 100.0, 2), F.lit(0.0))
        lines.append(_line("NULOS_ACIMA_LIMITE", column, medida=nulls, pct=pct, limite=max_null_pct,
                           falhou=pct > max_null_pct))
    for i, (column, (low, high)) in enumerate((ranges or {}).items()):
        if column not in columns:
            continue
        lines.append(_line("DOMINIO_NUMERICO_INVALIDO", column, medida=F.col(f"fora_{i}"), minimo=low, maximo=high,
                           limite=0.0, falhou=F.col(f"fora_{i}") > 0))
        # Text that is no number cannot be in the range.
        lines.append(_line("VALOR_ILEGIVEL", column, medida=F.col(f"ilegivel_{i}"), limite=0.0,
                           falhou=F.col(f"ilegivel_{i}") > 0))
    if not lines:
        return row.select("registros", F.inline(F.array(_line("REGISTROS", "", falhou=False)))).limit(0)
    return _lines(row, lines)


def column_checks(
    df: DataFrame,
    required: Sequence[str] = (),
    max_null_pct: float = 5.0,
    ranges: Mapping[str, tuple[float, float]] | None = None,
) -> DataFrame:
    """Completeness and numeric ranges in a single pass."""
    return column_lines(df.agg(*column_measures(df.columns, required, ranges)), df.columns, required, max_null_pct, ranges)


def measured_checks(df: DataFrame, measured: Mapping[str, int], rule: Rule) -> DataFrame:
    """``column_checks`` of a table from what was measured while it was written; the table is not read."""
    # One row of constants, which Spark evaluates without a job.
    cells = [F.lit(value).cast("bigint").alias(n) for n, value in measured.items() if isinstance(value, int)]
    row = df.sparkSession.sql("SELECT 1").select(*cells)
    return column_lines(row, df.columns, rule.required, rule.max_null_pct, rule.ranges)


def uniqueness_check(df: DataFrame, keys: Sequence[str], large: bool = False) -> DataFrame:
    """Rows beyond the first per key; null keys are equal to each other."""
    present = [c for c in keys if c in df.columns]
    count = count_removed_of_few if large else count_removed
    row = count(df, present).withColumn("registros", F.lit(None).cast("bigint"))
    extra = F.col("removidos")
    return _lines(row, [_line("DUPLICATAS", ",".join(present), medida=extra, limite=0.0, falhou=extra > 0)])


def _with_examples(kind: str, column: str, values: DataFrame) -> DataFrame:
    """Number of offending values and the first few of them in order."""
    few = values.select(F.col(column).cast("string").alias("valor")).orderBy("valor").limit(EXAMPLES)
    examples = few.agg(F.sort_array(F.collect_list("valor"))).scalar()
    row = values.agg(F.count("*").alias("n")).select(
        "n", F.lit(None).cast("bigint").alias("registros"), examples.alias("lista")
    )
    return _lines(row, [_line(kind, column, medida=F.col("n"), limite=0.0, falhou=F.col("n") > 0,
                              exemplos=F.col("lista"))])


def reference_check(df: DataFrame, column: str, reference: DataFrame, reference_column: str) -> DataFrame:
    """Keys that the referenced table does not know."""
    return _with_examples("INTEGRIDADE_REFERENCIAL", column, orphan_keys(df, column, reference, reference_column))


def domain_check(df: DataFrame, column: str, domain: Sequence[str]) -> DataFrame:
    """Distinct values outside a domain, with examples."""
    return _with_examples("DOMINIO_INVALIDO", column, outside_domain(df, column, domain))


def check_table(
    df: DataFrame,
    name: str,
    rule: Rule,
    layer: str = "",
    read: Callable[[str], DataFrame | None] | None = None,
    measured: Mapping[str, int] | None = None,
) -> DataFrame:
    """The full report of a table. References whose table is absent are skipped. With ``measured``, what the write of
    the table counted, completeness and ranges need no scan."""
    expected = {f"nulos_{i}" for i, c in enumerate(rule.required) if c in df.columns} | {
        f"fora_{i}" for i, c in enumerate(rule.ranges) if c in df.columns
    }
    if measured is not None and expected <= measured.keys():
        parts = [measured_checks(df, measured, rule)]
    else:
        parts = [column_checks(df, rule.required, rule.max_null_pct, rule.ranges)]
    if any(k in df.columns for k in rule.keys):
        parts.append(uniqueness_check(df, rule.keys, rule.large))
    parts += [domain_check(df, c, domain) for c, domain in rule.domains.items() if c in df.columns]
    for column, (table, reference_column) in rule.references.items():
        reference = read(table) if read else None
        if column in df.columns and reference is not None and reference_column in reference.columns:
            parts.append(reference_check(df, column, reference, reference_column))
    report = reduce(DataFrame.unionByName, parts)
    return report.select(F.lit(layer).alias("camada"), F.lit(name).alias("tabela"), "*").select(*REPORT_COLUMNS)


def described(report: DataFrame) -> DataFrame:
    """Add readable texts of the measured value (``valor``) and of the limit (``limite``)."""
    measured = F.col("medida").cast("string")
    span = F.concat(F.lit("["), F.col("minimo").cast("string"), F.lit(", "), F.col("maximo").cast("string"), F.lit("]"))
    value = (
        F.when(F.col("tipo") == "NULOS_ACIMA_LIMITE",
               F.concat(measured, F.lit(" ("), F.col("pct").cast("string"), F.lit("%)")))
        .when(F.col("tipo") == "VALOR_ILEGIVEL", F.concat(measured, F.lit(" valores que não são números")))
        .when(F.col("tipo") == "DUPLICATAS", F.concat(measured, F.lit(" registros duplicados")))
        .when(F.col("tipo") == "DOMINIO_NUMERICO_INVALIDO", F.concat(measured, F.lit(" registros fora de "), span))
        .when(F.col("tipo") == "INTEGRIDADE_REFERENCIAL",
              F.concat(measured, F.lit(" valores órfãos: "), F.array_join("exemplos", ", ")))
        .when(F.col("tipo") == "DOMINIO_INVALIDO",
              F.concat(measured, F.lit(" valores fora do domínio: "), F.array_join("exemplos", ", ")))
        .when(F.col("tipo") == "COLUNA_AUSENTE", F.lit("Coluna obrigatória não encontrada na tabela"))
    )
    limit = (
        F.when(F.col("tipo") == "NULOS_ACIMA_LIMITE", F.concat(F.col("limite").cast("string"), F.lit("%")))
        .when(F.col("tipo") == "DOMINIO_NUMERICO_INVALIDO", span)
        .otherwise(F.lit("0"))
    )
    return report.withColumn("valor", value).withColumn("limite", limit)


def alerts(report: DataFrame) -> DataFrame:
    """Failed checks with their texts."""
    return described(report.where("falhou")).select("camada", "tabela", "tipo", "coluna", "valor", "limite")


def summarise(report: DataFrame) -> DataFrame:
    """Per table: rows, failed checks, status."""
    return report.groupBy("camada", "tabela").agg(
        F.max("registros").alias("registros"),
        F.count_if("falhou").alias("alertas"),
    ).withColumn("status", F.when(F.col("alertas") > 0, F.lit("ALERTA")).otherwise(F.lit("OK")))


def roll_up(report: DataFrame) -> DataFrame:
    """Per layer and in total: tables checked, fine, failing, and failed checks."""
    return (
        summarise(report)
        .rollup("camada")
        .agg(
            F.count("*").alias("tabelas_verificadas"),
            F.count_if(F.col("status") == "OK").alias("tabelas_ok"),
            F.count_if(F.col("status") == "ALERTA").alias("tabelas_com_alerta"),
            F.sum("alertas").alias("total_alertas"),
        )
        .select(F.coalesce("camada", F.lit("total")).alias("camada"), "tabelas_verificadas", "tabelas_ok",
                "tabelas_com_alerta", "total_alertas")
    )
