"""The physical plans stay the ones we want: pruned scans, no surprise shuffles, no Python."""

import re

import pytest
from pyspark.sql import functions as F

from tabulint.catalog.records import records
from tabulint.operators import checks, inject, profile
from tabulint.operators.dedup import keep_latest, latest_grade
from tabulint.operators.validity import keep_valid
from tabulint.plans import cleaning, presets
from tabulint.sources import tables

import __spark_entry__ as driver
from tabulint.catalog import QUERIES

RULES = presets.ADMISSIONS


@pytest.fixture(scope="module")
def stored(spark, sf_small, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("plans") / "records.parquet")
    tables.write_table(records(spark, sf_small), path)
    return tables.read_table(spark, path)


def plan(df, capsys):
    capsys.readouterr()
    df.explain()
    return capsys.readouterr().out


def read_columns(text):
    """The columns of every scan of a plan."""
    return [
        re.findall(r"([a-z_0-9]+)#", scan) for scan in re.findall(r"FileScan parquet \[([^\]]*)\]", text)
    ]


@pytest.fixture(scope="module", autouse=True)
def long_plans(spark):
    spark.conf.set("spark.sql.debug.maxToStringFields", 200)
    spark.conf.set("spark.sql.maxMetadataStringLength", 5000)
    yield
    spark.conf.unset("spark.sql.debug.maxToStringFields")
    spark.conf.unset("spark.sql.maxMetadataStringLength")


def test_dedup_prunes_before_its_only_shuffle(stored, capsys):
    text = plan(cleaning.clean(stored, RULES), capsys)
    lines = text.splitlines()
    limits = [i for i, line in enumerate(lines) if "WindowGroupLimit" in line]
    (shuffle,) = [i for i, line in enumerate(lines) if "Exchange" in line]
    assert len(limits) == 2 and limits[0] < shuffle < limits[1]


def test_validation_stays_above_the_dedup(stored, capsys):
    lines = plan(cleaning.clean(stored, RULES), capsys).splitlines()
    filters = [i for i, line in enumerate(lines) if re.search(r"[-+ ] Filter", line)]
    (window,) = [i for i, line in enumerate(lines) if re.search(r"[-+ ] Window \[", line)]
    assert filters and all(i < window for i in filters)


def test_patterns_are_matched_once(stored, capsys):
    assert plan(cleaning.clean(stored, RULES), capsys).count("RLIKE") == 1


def test_funnel_reads_only_what_it_needs(stored, capsys):
    text = plan(cleaning.funnel(stored, RULES), capsys)
    (columns,) = read_columns(text)
    assert set(columns) == {"patient_id", "admission_date", "icd10_code", *(r.column for r in presets.VITALS)}
    assert "SortAggregate" not in text and "Window" not in text
    assert text.count("Exchange hashpartitioning") == 1


def test_profile_measures_are_single_narrow_scans(stored, capsys):
    cases = {
        "rows": (profile.row_count(stored), set()),
        "nulls": (profile.null_counts(stored), set(stored.columns)),
        "surplus": (profile.surplus_rows(stored, ("patient_id",)), {"patient_id"}),
        "malformed": (profile.malformed_count(stored, presets.CODE), {"icd10_code"}),
        "ranges": (profile.out_of_range_counts(stored, presets.VITALS), {r.column for r in presets.VITALS}),
        "years": (profile.year_counts(stored, "admission_date"), {"admission_date"}),
    }
    for name, (df, wanted) in cases.items():
        (columns,) = read_columns(plan(df, capsys))
        assert set(columns) == wanted, name


def test_duplicate_keys_are_combined_before_the_shuffle(stored, capsys):
    text = plan(checks.duplicate_keys(stored, presets.PATIENT_KEY, ordered=False), capsys)
    assert text.count("HashAggregate") == 2 and text.count("Exchange") == 1
    assert "SortAggregate" not in text


def test_row_filters_need_no_shuffle_and_reach_the_scan(stored, capsys):
    text = plan(keep_valid(stored, *presets.VITALS), capsys)
    assert "Exchange" not in text
    pushed = re.search(r"PushedFilters: \[(.*?)\], ReadSchema", text).group(1)
    for rule in presets.VITALS:
        assert f"IsNull({rule.column})" in pushed and f"GreaterThanOrEqual({rule.column}" in pushed
    text = plan(keep_valid(stored, presets.CODE), capsys)
    assert "IsNotNull(icd10_code)" in text.split("PushedFilters")[1]


def test_unordered_reports_need_no_shuffle(stored, capsys):
    ids = ("patient_id",)
    assert "Exchange" not in plan(checks.format_failures(stored, presets.CODE, ids, ordered=False), capsys)
    assert "Exchange" not in plan(checks.range_failures(stored, presets.VITALS, ids, ordered=False), capsys)


def test_ordered_reports_are_sorted(stored):
    rows = checks.format_failures(stored, presets.CODE, ("patient_id",)).collect()
    order = [(r.status, r.patient_id) for r in rows]
    assert order == sorted(order) and len(order) == 53


def test_injections_are_one_scan_without_shuffle(stored, capsys):
    number = F.substring("patient_id", 2, 20).cast("bigint")
    hit = inject.one_in(number, 10)
    for df in (
        inject.inject_duplicates(stored, hit),
        inject.inject_nulls(stored, hit, number, ["icd10_code"]),
        inject.inject_invalid_codes(stored, hit, number, "icd10_code", presets.MALFORMED_CODES),
        inject.inject_out_of_range(stored, hit, number, presets.VITALS),
    ):
        text = plan(df, capsys)
        assert "Exchange" not in text and text.count("FileScan") == 1


def test_flags_shuffle_whole_rows_once(stored, capsys):
    text = plan(cleaning.flag_rows(stored, RULES), capsys)
    assert sum("Exchange hashpartitioning(patient_id" in line and "slice" in line for line in text.splitlines()) == 1
    assert "CartesianProduct" not in text and "NestedLoop" not in text


def test_bucketed_table_needs_no_shuffle(spark, stored, capsys):
    stored.write.bucketBy(4, "patient_id").sortBy("patient_id").mode("overwrite").saveAsTable("bucketed_records")
    try:
        bucketed = spark.table("bucketed_records")
        assert "Exchange" not in plan(keep_latest(bucketed, RULES.key), capsys)
        assert "Exchange" not in plan(latest_grade(bucketed, RULES.key, F.lit(0), 1), capsys)
    finally:
        spark.sql("DROP TABLE bucketed_records")


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_and_no_cross_join_anywhere(spark, sf_small, capsys, name):
    text = plan(QUERIES[name](spark, sf_small), capsys)
    for unwanted in ("Python", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert unwanted not in text


def test_entry(spark):
    df = driver.entry(spark)
    assert df.count() == 1396
    assert dict(df.dtypes)["length_of_stay_days"] == "int"
    assert len(df.columns) == 15
