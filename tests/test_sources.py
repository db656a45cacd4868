from pathlib import Path

import pytest
from lake import FILES, write_sources
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, In, InputPartition, IsNotNull

from degraus.sources import csv, external, tables
from degraus.sources.export import export_json
from degraus.spec import SOURCES


@pytest.fixture(scope="module")
def raw(tmp_path_factory):
    return write_sources(tmp_path_factory.mktemp("raw"))


def read(spark, raw, name, **kw):
    return csv.read_csv(spark, f"{raw}/{SOURCES[name].file}", SOURCES[name].types, **kw)


def test_encoding_is_found_per_file(spark, raw):
    assert csv.is_utf8(spark, f"{raw}/{SOURCES['diretorio_uf'].file}")
    assert not csv.is_utf8(spark, f"{raw}/{SOURCES['diretorio_municipio'].file}")


def test_windows_1252_text(spark, raw):
    names = [r.nome for r in read(spark, raw, "diretorio_municipio").collect()]
    assert "Águas da Prata – SP" in names and any("Bagé" in n for n in names)


def test_types_and_leading_zeros(spark, raw):
    df = read(spark, raw, "alunos")
    assert dict(df.dtypes)["proficiencia"] == "double" and dict(df.dtypes)["ano"] == "int"
    assert {r.id_aluno for r in df.collect()} == {"0001", "0002", "0003"}


def test_header_decides_the_order(spark, raw):
    row = read(spark, raw, "meta_brasil").where("ano = 2025").first()
    assert (row.rede, row.taxa_alfabetizacao, row.meta_alfabetizacao_2030, row.observacao) == ("Pública", 66.0, 80.0, "revisada")
    assert read(spark, raw, "meta_brasil").where("ano = 2023").first().observacao is None


def test_origin_follows_the_file(spark, raw):
    rates = [r.taxa_alfabetizacao for r in read(spark, raw, "indicador_municipio").orderBy(csv.ORIGIN).collect()]
    assert rates == [float(line.split(",")[4]) for line in FILES["indicador_municipio"][1:]]


def test_origin_follows_a_file_read_in_many_pieces(spark, tmp_path):
    (tmp_path / "x.csv").write_text("n\n" + "\n".join(str(i) for i in range(20000)) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", 8192)
    try:
        df = csv.read_csv(spark, str(tmp_path / "x.csv"), {"n": "int"})
        assert df.rdd.getNumPartitions() > 3
        assert [r.n for r in df.orderBy(csv.ORIGIN).collect()] == list(range(20000))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_years_filter(spark, raw):
    assert {r.ano for r in read(spark, raw, "indicador_uf", years=[2024]).collect()} == {2024}


def test_failed_casts_are_counted(spark, tmp_path):
    (tmp_path / "x.csv").write_text("ano,taxa\n2024,1.5\nx,\n2023,abc\n")
    got = csv.failed_casts(spark, str(tmp_path / "x.csv"), {"ano": "int", "taxa": "double", "z": "int"})
    assert {r.coluna: r.falhas for r in got.collect()} == {"ano": 1, "taxa": 1}


def test_only_partitions_present_are_replaced(spark, frame, tmp_path):
    path = str(tmp_path / "t")
    tables.write_table(frame([(2023, 1), (2024, 2)], "ano INT, x INT"), path, ["ano"])
    tables.write_table(frame([(2024, 3)], "ano INT, x INT"), path, ["ano"])
    assert sorted((r.ano, r.x) for r in tables.read_table(spark, path).collect()) == [(2023, 1), (2024, 3)]
    tables.write_table(frame([(2024, 4)], "ano INT, x INT"), path, ["ano"], full_refresh=True)
    assert sorted((r.ano, r.x) for r in tables.read_table(spark, path).collect()) == [(2024, 4)]


def test_missing_partition_column_means_full_replace(spark, frame, tmp_path):
    path = str(tmp_path / "t")
    tables.write_table(frame([(1,)], "x INT"), path, ["ano"])
    tables.write_table(frame([(2,)], "x INT"), path, ["ano"])
    assert [r.x for r in tables.read_table(spark, path).collect()] == [2]


def test_filters_prune_and_are_pushed_down(spark, frame, tmp_path):
    path = str(tmp_path / "t")
    tables.write_table(frame([(2023, 1, 2), (2024, 2, 3)], "ano INT, x INT, y INT"), path, ["ano"])
    df = tables.read_table(spark, path, {"ano": 2024, "x": 2, "absent": 0}).select("x")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ano" in plan and "PushedFilters: [IsNotNull(x), EqualTo(x,2)]" in plan
    assert "ReadSchema: struct<x:int>" in plan
    assert [r.x for r in df.collect()] == [2]


def test_absent_table(spark, tmp_path):
    assert tables.read_if_present(spark, str(tmp_path / "nada")) is None
    (tmp_path / "vazia").mkdir()
    assert tables.read_if_present(spark, str(tmp_path / "vazia")) is None


def test_warehouse_with_year_filter_and_fallback(spark, frame, tmp_path):
    path = str(tmp_path / "w")
    tables.write_table(frame([(2023, 1), (2024, 2)], "ano INT, x INT"), path, ["ano"])
    df = external.read_warehouse(spark, "parquet", path, [2024], option="path")
    assert [r.x for r in df.collect()] == [2]
    assert "PartitionFilters: [isnotnull(ano" in df._jdf.queryExecution().executedPlan().toString()

    def broken():
        raise FileNotFoundError("x")

    assert external.first_available(("warehouse", broken), ("raw", lambda: df))[1] == "raw"
    with pytest.raises(FileNotFoundError):
        external.first_available(("a", broken))

    def corrupt():
        raise ValueError("x")

    heard = []
    with pytest.raises(external.SourceError):
        external.first_available(("a", corrupt), ("b", broken), on_failure=lambda tag, error: heard.append(tag))
    assert heard == ["a"]


def warehouse():
    """A source with a thousand rows a year. It notes in a folder which years it produces. The classes are local, so they
    travel to the workers by value."""
    all_years = (2021, 2022, 2023, 2024)

    class Reader(DataSourceReader):
        def __init__(self, options):
            self.options, self.years = options, all_years

        def pushFilters(self, filters):
            for f in filters:
                if isinstance(f, In) and f.attribute == ("ano",):
                    self.years = tuple(y for y in all_years if y in f.value)
                elif isinstance(f, EqualTo) and f.attribute == ("ano",):
                    self.years = tuple(y for y in all_years if y == f.value)
                elif not isinstance(f, IsNotNull):
                    yield f

        def partitions(self):
            return [InputPartition(year) for year in self.years]

        def read(self, partition):
            (Path(self.options["notes"]) / f"{self.options['table']}-{partition.value}").touch()
            for x in range(1000):
                yield partition.value, x

    class Warehouse(DataSource):
        @classmethod
        def name(cls):
            return "armazem"

        def schema(self):
            return "ano INT, x INT"

        def reader(self, schema):
            return Reader(self.options)

    return Warehouse, set(all_years)


def test_the_year_filter_reaches_the_warehouse(spark, tmp_path):
    """The source itself is told the years, and never produces a row of another one."""
    source, all_years = warehouse()
    spark.dataSource.register(source)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    options = {"notes": str(tmp_path)}
    for years in ([2022, 2024], [2023], None):
        table = "-".join(map(str, years or ["all"]))
        df = external.read_warehouse(spark, "armazem", table, years, options=options)
        assert df.count() == 1000 * len(years or all_years)
        made = {int(f.name.rsplit("-", 1)[1]) for f in tmp_path.glob(f"{table}-*")}
        assert made == set(years or all_years)
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert not years or "Filter (" not in plan


def test_partitions_with_other_columns_are_read_whole(spark, frame, tmp_path):
    path = str(tmp_path / "p")
    tables.write_table(frame([(2023, 1)], "ano INT, x INT"), path, ["ano"])
    tables.write_table(frame([(2024, 2, "y")], "ano INT, x INT, novo STRING"), path, ["ano"])
    got = {r.ano: r.novo for r in tables.read_table(spark, path).collect()}
    assert got == {2023: None, 2024: "y"}


def test_quoted_line_breaks(spark, tmp_path):
    file = tmp_path / "q.csv"
    file.write_text('a,b\n1,"two\nlines"\n2,one\n', encoding="utf-8")
    got = csv.read_csv(spark, str(file), {"a": "int"}, multiline=True)
    assert [(r.a, r.b) for r in got.orderBy("a").collect()] == [(1, "two\nlines"), (2, "one")]


def test_broker_reader_needs_its_connector(spark):
    with pytest.raises(Exception, match="[kK]afka"):
        external.read_broker(spark, "broker:9092", ["t"], per_batch=10)


def test_json_export(spark, frame, tmp_path):
    export_json({"v": frame([(1, None)], "a INT, b STRING")}, str(tmp_path))
    row = spark.read.json(str(tmp_path / "v")).select(F.col("a"), F.col("b")).first()
    assert (row.a, row.b) == (1, None)
