import numpy as np
import pytest
from pyspark.sql import functions as F

from degraus import functions as fn


@pytest.mark.parametrize(
    "given, expected",
    [(" Nome Coluna ", "nome_coluna"), ("Município", "municipio"), ("JÁ_OK", "ja_ok"), ("IDHM-E", "idhm_e")],
)
def test_names(given, expected):
    assert fn.normalise_name(given) == expected


def test_columns_are_renamed_in_place(frame):
    df = fn.normalise_columns(frame([(1, 2)], "`Município` INT, ` a b` INT"))
    assert df.columns == ["municipio", "a_b"]


def test_codes_become_labels(frame):
    df = frame([(3,), (5,), (2,), (99,), (None,)], "rede INT").select(fn.code_label(F.col("rede")).alias("r"))
    assert [r.r for r in df.collect()] == ["Municipal", "Pública", "Estadual", None, None]


def test_lenient_cast_is_per_cell_and_skips_absent_columns(frame):
    df = fn.try_cast_columns(frame([("1",), ("x",), (None,)], "a STRING"), {"a": "int", "b": "int"})
    assert [r.a for r in df.collect()] == [1, None, None]


def test_nan_becomes_null(frame):
    df = fn.try_cast_columns(frame([("NaN",), ("1.5",)], "a STRING"), {"a": "double"})
    assert [r.a for r in df.collect()] == [None, 1.5]


def test_decimal_comma(frame):
    df = frame([("0,712",), ("0.5",), ("x",), (None,)], "a STRING").select(fn.decimal_comma(F.col("a")).alias("a"))
    assert [r.a for r in df.collect()] == [0.712, 0.5, None, None]


def test_booleans(frame):
    df = frame([("1",), ("0",), ("2x",), (None,)], "a STRING").select(fn.as_boolean(F.col("a")).alias("a"))
    assert [r.a for r in df.collect()] == [True, False, None, None]


def test_event_time(frame):
    df = frame([("2024-05-01T10:00:00.5",), ("ontem",), (None,)], "t STRING")
    got = [r.t for r in df.select(fn.parse_event_time(F.col("t")).alias("t")).collect()]
    assert got[0].microsecond == 500000 and got[1:] == [None, None]


def test_range_and_target_flags_treat_null_as_false(frame):
    df = frame([(-1.0,), (0.0,), (100.0,), (100.5,), (None,)], "x DOUBLE")
    row = df.select(fn.out_of_range(F.col("x"), 0, 100).alias("fora"), fn.at_least_zero(F.col("x")).alias("ok")).collect()
    assert [r.fora for r in row] == [True, False, False, True, False]
    assert [r.ok for r in row] == [False, True, True, True, False]


def test_bands(frame):
    values = [-1.0, 0.0, 49.999, 50.0, 70.0, 90.0, 100.0, 100.01, None]
    df = frame([(v,) for v in values], "x DOUBLE").select(fn.band(F.col("x")).alias("b"))
    assert [r.b for r in df.collect()] == [
        "Não classificado", "Crítico", "Crítico", "Atenção", "Adequado", "Meta próxima/atingida",
        "Meta próxima/atingida", "Não classificado", "Não classificado",
    ]


def test_rounding_equals_numpy(frame):
    values = [0.125, 0.375, 2.675, -2.675, 1.005, 33.333333, -0.125, 1e7 + 0.005]
    df = frame([(v,) for v in values], "x DOUBLE").select(fn.round_even(F.col("x"), 2).alias("x"))
    assert [r.x for r in df.collect()] == list(np.round(np.array(values), 2))


def test_percentage_of_nothing_is_null(frame):
    df = frame([(1, 3), (0, 0)], "a INT, b INT").select(fn.percentage(F.col("a"), F.col("b")).alias("p"))
    assert [r.p for r in df.collect()] == [33.33, None]


def test_select_present(frame):
    df = fn.select_present(frame([(1, 2)], "a INT, b INT"), ["b", "z", "a"], {"b": "bb"})
    assert df.columns == ["bb", "a"]


def test_missing_texts(frame):
    df = frame([("NA",), ("",), ("x",), (None,)], "a STRING").select(fn.missing_to_null(F.col("a")).alias("a"))
    assert [r.a for r in df.collect()] == [None, None, "x", None]


def test_whole_numbers_and_flags_as_text(frame):
    df = frame([("2.0", "1.0"), ("2", "True"), ("2.5", "0"), ("x", "talvez"), (None, None)], "n STRING, f STRING")
    got = fn.try_cast_columns(df, {"n": "int", "f": "flag"}).collect()
    assert [(r.n, r.f) for r in got] == [(2, 1), (2, 1), (None, 0), (None, None), (None, None)]
    flags = df.select(fn.as_boolean(F.col("f")).alias("f")).collect()
    assert [r.f for r in flags] == [True, True, False, None, None]
