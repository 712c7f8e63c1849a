import math
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from litmark import fixed_values as V
from litmark.functions import labels, numbers, text, times
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T


def column(spark, values, kind, expression):
    rows = [(i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, f"n int, x {kind}")
    return [r[0] for r in df.orderBy("n").select(expression(F.col("x"))).collect()]


def test_strip_removes_what_python_strips(spark):
    values = ["\t a b \n", " x　", "\x1cx\x1f", "", None, "é  ", "a​"]
    assert column(spark, values, "string", text.strip) == [v if v is None else v.strip() for v in values]


def test_clean_nulls_tokens_case_sensitively(spark):
    values = [" nan ", "NaN", "None", "none", "null", "NULL", "  ", "x"]
    assert column(spark, values, "string", text.clean) == [None, "NaN", None, "none", None, "NULL", None, "x"]


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=30))
def test_snake_name(name):
    step = re.sub(r"[^a-z0-9_]+", "_", name.strip().lower())
    assert text.snake_name(name) == re.sub(r"_+", "_", step).strip("_")


def test_try_int_reads_numbers_in_text(spark):
    values = ["3", " 3.0 ", "2.5", "1e1", "x", "", None, "99999999999", "-2.5", "NaN"]
    expected = [3, 3, 3, 10, None, None, None, None, -3, None]
    assert column(spark, values, "string", lambda c: numbers.try_int(c, T.StringType())) == expected
    assert column(spark, [2.7, 2.5, 3.5], "double", lambda c: numbers.try_int(c, T.DoubleType())) == [3, 2, 4]


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_strict_casts_fail_on_bad_text_in_both_modes(spark, ansi):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        ok = column(spark, ["7", None], "string", lambda c: numbers.strict_int(c, T.StringType(), "x"))
        assert ok == [7, None]
        with pytest.raises(PySparkException):
            column(spark, ["seven"], "string", lambda c: numbers.strict_int(c, T.StringType(), "x"))
        with pytest.raises(PySparkException):
            column(spark, ["seven"], "string", lambda c: numbers.strict_double(c, T.StringType(), "x"))
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_coercion_turns_bad_values_into_null(spark):
    values = ["1", "1.5", "x", "NaN", None]
    assert column(spark, values, "string", numbers.coerce_long) == [1, None, None, None, None]
    assert column(spark, values, "string", numbers.coerce_double) == [1.0, 1.5, None, None, None]


def test_round2_scales_before_rounding(spark):
    values = [1.005, 2.675, -1.005, 0.125, 33.335]
    expected = [math.copysign(math.floor(abs(v * 100) + 0.5), v) / 100 for v in values]
    assert column(spark, values, "double", numbers.round2) == expected


def test_readable_bytes(spark):
    values = [0, 1023, 1024, 1152, 1536 * 1024, 5 * 1024**4, 5 * 1024**5, None]

    def plain(value, units):
        for unit in units:
            if value < 1024 or unit == units[-1]:
                return f"{value:.2f} {unit}"
            value /= 1024

    for units in (V.BINARY_UNITS, V.SHORT_UNITS):
        expected = [v if v is None else plain(float(v), units) for v in values]
        expected = [e for e in expected]
        got = column(spark, values, "long", lambda c, units=units: numbers.readable_bytes(c, units))
        assert [g and g.replace(",", "") for g in got] == expected


def test_ranges_and_domains(spark):
    assert column(spark, [None, -1.0, 0.0, 100.0, 100.1], "double", numbers.out_of_range) == [False, True, False, False, True]
    assert column(spark, [None, 1, 5], "int", lambda c: numbers.out_of_domain(c, [1, 2])) == [True, False, True]
    assert column(spark, [-5.0, 50.0, 500.0], "double", numbers.clamp) == [0.0, 50.0, 100.0]


def test_network_codes_and_labels(spark):
    values = ["0", " 5 ", "3.0", "Total geral", " ESTADUAL ", "municipal", "privada", "federal", "pública", "9", None]
    expected = [0, 5, 3, 0, 2, 3, 4, 1, None, 9, None]
    assert column(spark, values, "string", lambda c: labels.network_code(c, T.StringType())) == expected
    labelled = column(spark, [0, 6, 9, None], "int", labels.network_label)
    assert labelled == ["Total", "Pública (Federal, Estadual e Municipal)", "Não identificado", "Não identificado"]


def test_status_and_trend(spark):
    rows = [(None, 1.0), (1.0, None), (2.0, 2.0), (1.0, 2.0), (3.0, 2.0)]
    df = spark.createDataFrame(rows, "a double, b double")
    got = df.select(labels.target_status(F.col("a"), F.col("b")), labels.trend(F.col("a"), F.col("b"))).collect()
    assert [tuple(r) for r in got] == [
        ("Sem resultado", "Sem comparação"),
        ("Sem meta", "Sem comparação"),
        ("Meta atingida", "Estável"),
        ("Abaixo da meta", "Evolução positiva"),
        ("Meta atingida", "Queda"),
    ]


def test_iso_timestamps(spark):
    values = [
        "2026-07-12T10:00:00+00:00",
        "2026-07-12T07:00:00-03:00",
        "2026-07-12 10:00:00",
        "2026-07-12T10:00:00.000001Z",
        "2026-07-12",
        "12/07/2026",
        "2026-13-01",
        "10:00",
        "",
        None,
    ]
    base = 1783850400000000
    expected = [base, base, base, base + 1, base - 36_000_000_000, None, None, None, None, None]
    assert column(spark, values, "string", lambda c: F.unix_micros(times.iso_timestamp(c))) == expected


def test_short_iso_forms(spark):
    from litmark.functions.times import iso_timestamp

    good = {
        "20240101T100000Z": "2024-01-01 10:00:00", "2024-01-01T10Z": "2024-01-01 10:00:00", "2024-01-01T10:30:00z": "2024-01-01 10:30:00",
        "20240101": "2024-01-01 00:00:00", "2024-01-01T1030+0200": "2024-01-01 08:30:00", "20240101T10-03": "2024-01-01 13:00:00",
        "2024-01-01 10:00:00.5": "2024-01-01 10:00:00.5", "2024-01-01T10:00:00-03:00": "2024-01-01 13:00:00",
    }
    bad = ["2024-0101", "202401-01", "2024-13-01T10Z", "20240101T", "2024-01-01T1", "12/07/2026", "", "2024-01-01T10:00:00 x", None]
    df = spark.createDataFrame([(t,) for t in [*good, *bad]], "t string")
    found = {r.t: r.x for r in df.select("t", iso_timestamp(F.col("t")).cast("string").alias("x")).collect()}
    assert {t: found[t] for t in good} == good
    assert {t: found[t] for t in bad} == dict.fromkeys(bad)
