"""Single rules and standard forms on literal rows."""

import datetime

import pytest
from pyspark.sql import functions as F

from tabulint.functions import InRange, Matches, NotNull
from tabulint.operators import checks, profile, standardize
from tabulint.operators.validity import keep_valid
from tabulint.plans import presets

NAN = float("nan")


def column(spark, values, kind, name="x"):
    return spark.createDataFrame([(v,) for v in values], f"{name} {kind}")


def answers(df, expression):
    return [row[0] for row in df.select(expression).collect()]


@pytest.mark.parametrize("code", ["A00", "B15.2", "C34.1A", "A00.1234"])
def test_good_codes(spark, code):
    df = column(spark, [code], "string", "icd10_code")
    assert answers(df, presets.CODE.status()) == ["VALID"]
    assert keep_valid(df, presets.CODE).count() == 1


@pytest.mark.parametrize(
    "code",
    ["123", "XYZ", "A1", "ABCDE", "Z999999", "A0B", "a00", "A00.", "A00.12345", "A00x1B", "", " A00", *presets.MALFORMED_CODES],
)
def test_bad_codes(spark, code):
    df = column(spark, [code], "string", "icd10_code")
    assert answers(df, presets.CODE.status()) == ["INVALID_FORMAT"]
    assert keep_valid(df, presets.CODE).count() == 0
    assert profile.malformed_count(df, presets.CODE).first()[0] == 1


def test_missing_code_is_dropped_but_not_malformed(spark):
    df = column(spark, [None], "string", "icd10_code")
    assert answers(df, presets.CODE.status()) == ["MISSING"]
    assert keep_valid(df, presets.CODE).count() == 0
    assert profile.malformed_count(df, presets.CODE).first()[0] == 0


def test_pattern_accepts_final_newline(spark):
    # Java's $ also matches before a final line break
    df = column(spark, ["A00\n"], "string", "icd10_code")
    assert answers(df, presets.CODE.status()) == ["VALID"]


def test_optional_pattern_keeps_null(spark):
    rule = Matches("x", "^a$", null_ok=True)
    df = column(spark, ["a", "b", None], "string")
    assert answers(df, rule.violation()) == [False, True, False]
    assert [r.x for r in keep_valid(df, rule).collect()] == ["a", None]


@pytest.mark.parametrize("rule", presets.VITALS, ids=lambda r: r.name)
def test_range_ends_are_inside(spark, rule):
    kind = presets.ADMISSIONS_SCHEMA[rule.column].dataType.simpleString()
    step = 1 if kind == "int" else 0.001
    values = [rule.lo, rule.hi, rule.lo - step, rule.hi + step, None]
    values = [v if v is None else (int(v) if kind == "int" else float(v)) for v in values]
    df = column(spark, values, kind, rule.column)
    assert answers(df, rule.violation()) == [False, False, True, True, False]
    assert answers(df, rule.failure()) == [None, None, rule.name, rule.name, None]
    assert keep_valid(df, rule).count() == 3


def test_nan_is_out_of_range(spark):
    df = column(spark, [NAN, 100.0], "double", "heart_rate_bpm")
    rule = presets.VITALS[0]
    assert answers(df, rule.violation()) == [True, False]
    assert keep_valid(df, rule).count() == 1
    assert profile.out_of_range_counts(df, (rule,)).first()[0] == 1


def test_nan_in_parquet_is_found(spark, tmp_path):
    # a block whose statistics leave out NaN must not be skipped
    import pyarrow as pa
    import pyarrow.parquet as pq

    pq.write_table(pa.table({"id": [1, 2], "x": [1.0, NAN]}), tmp_path / "nan.parquet")
    df = spark.read.parquet(str(tmp_path / "nan.parquet"))
    rule = InRange("x", 0, 10, label="x")
    assert [r.id for r in checks.range_failures(df, (rule,), ("id",)).collect()] == [2]
    assert [r.id for r in keep_valid(df, rule).collect()] == [1]


def test_strict_range_rejects_null(spark):
    rule = InRange("x", 0, 10, null_ok=False)
    df = column(spark, [5.0, None, 11.0], "double")
    assert answers(df, rule.violation()) == [False, True, True]
    assert keep_valid(df, rule).count() == 1


def test_text_numbers(spark):
    rule = InRange("x", 30, 220, label="pulse", text=True)
    df = column(spark, ["120.0", "12", "fast", None, ""], "string")
    assert answers(df, rule.violation()) == [False, True, True, False, True]
    assert answers(df, rule.failure()) == [None, "pulse", "pulse: not_numeric", None, "pulse: not_numeric"]
    assert [r.x for r in keep_valid(df, rule).collect()] == ["120.0", None]


def test_not_null(spark):
    df = column(spark, ["a", None], "string")
    assert answers(df, NotNull("x").violation()) == [False, True]
    assert answers(df, NotNull("x", label="needed").failure()) == [None, "needed"]
    assert keep_valid(df, NotNull("x")).count() == 1


def test_label_list(spark):
    row = (90.0 * 10, 120.0, 80, 37.0, 98, 1.0)
    names = [r.column for r in presets.VITALS]
    df = spark.createDataFrame([("p", *row)], ["patient_id", *names])
    found = checks.range_failures(df, presets.VITALS, ("patient_id",)).first()
    assert found.flagged_fields == "heart_rate, weight"


def test_guard_hides_rows_without_heart_rate(spark):
    df = spark.createDataFrame([(None, 30.0)], "heart_rate_bpm double, systolic_bp_mmhg double")
    rules = presets.VITALS[:2]
    guard = F.col("heart_rate_bpm").isNotNull()
    assert profile.out_of_range_counts(df, rules, guard).first().bad_systolic == 0
    assert profile.out_of_range_counts(df, rules).first().bad_systolic == 1
    assert profile.out_of_range_nonzero(df, rules, guard).count() == 0


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_bad_dates_become_null(spark, ansi):
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        df = column(spark, ["2020-13-45", "", None, "2020-02-29"], "string", "d")
        result = [r.d for r in standardize.standardize_dates(df, "d").collect()]
        assert result == [None, None, None, datetime.date(2020, 2, 29)]
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


@pytest.mark.parametrize(
    "start, end, days",
    [("2020-02-28", "2020-03-01", 2), ("2020-01-05", "2020-01-01", -4), ("2020-01-05", None, None)],
)
def test_length_of_stay(spark, start, end, days):
    df = spark.createDataFrame([(start, end)], "a string, b string")
    assert standardize.add_day_span(df, "days", "a", "b").first().days == days


@pytest.mark.parametrize(
    "raw, tidy",
    [
        ("  mary ann ", "Mary Ann"),
        ("O'NEIL-smith mcDONALD", "O'neil-smith Mcdonald"),
        ("\ta ", "\ta"),
        (None, None),
    ],
)
def test_names(spark, raw, tidy):
    df = column(spark, [raw], "string", "n")
    assert standardize.standardize_names(df, "n").first().n == tidy


def test_codes(spark):
    df = column(spark, [" a00.1b "], "string", "c")
    assert standardize.standardize_codes(df, "c").first().c == "A00.1B"
