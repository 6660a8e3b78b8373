"""CSV and Parquet round trips, lenient reading, views, scratch paths."""

import pytest
from pyspark.sql import types as T

from tabulint.catalog.records import records
from tabulint.functions import RuleSet, Stage
from tabulint.operators.standardize import standardize
from tabulint.operators.validity import keep_valid
from tabulint.plans import cleaning, presets
from tabulint.sources import tables
from tests.oracle import _rows


def bag(df):
    return _rows(df.columns, df.collect())


@pytest.fixture
def folder(tmp_path):
    return str(tmp_path / "out")


def test_csv_round_trip_is_exact(spark, sf_small, folder):
    df = records(spark, sf_small)
    tables.write_csv(df, folder)
    assert bag(tables.read_csv(spark, folder, presets.ADMISSIONS_SCHEMA)) == bag(df)


def test_csv_keeps_null_blank_and_quotes_apart(spark, folder):
    values = [None, "", " x ", 'say "hi"', "a,b", "back\\slash", 'end\\"', "tab\t", "NULL", '"', "\\"]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    tables.write_csv(df, folder)
    back = tables.read_csv(spark, folder, df.schema).orderBy("i")
    assert [r.v for r in back.collect()] == values


def test_csv_line_breaks_need_multi_line(spark, folder):
    df = spark.createDataFrame([(1, "two\nlines"), (2, "one")], "i int, v string")
    tables.write_csv(df, folder)
    assert bag(tables.read_csv(spark, folder, df.schema, multi_line=True)) == bag(df)


def test_csv_every_task_writes_a_part(spark, folder, tmp_path):
    tables.write_csv(spark.range(100).repartition(4), folder)
    parts = [p for p in (tmp_path / "out").iterdir() if p.name.endswith(".csv")]
    assert len(parts) == 4
    assert all(p.read_text().startswith("id\n") for p in parts)
    assert tables.read_csv(spark, folder, spark.range(1).schema).count() == 100


def test_unfitting_fields_become_null_and_are_kept_aside(spark, tmp_path):
    (tmp_path / "in.csv").write_text("a,b\n1,2.5\n2,fast\n")
    schema = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.DoubleType())])
    rows = tables.read_csv(spark, str(tmp_path), schema, keep_corrupt=True).orderBy("a").collect()
    assert [(r.a, r.b, r._corrupt_record) for r in rows] == [(1, 2.5, None), (2, None, "2,fast")]
    assert [r.b for r in tables.read_csv(spark, str(tmp_path), schema).orderBy("a").collect()] == [2.5, None]


def test_text_preset_rejects_what_is_no_number(spark, tmp_path):
    names = [f.name for f in presets.ADMISSIONS_TEXT_SCHEMA.fields]
    good = ["P1", "a", "b", "1950-01-01", "2020-01-01", "2020-01-03", "A00", "d", "80.0", "120", "80.0", "37.0", "97.0", "70"]
    rows = [good, *([f"P{i}", *good[1:]] for i in range(2, 8))]
    rows[1][8], rows[2][10], rows[3][12], rows[4][12], rows[5][8] = "fast", "200.0", "130.0", "97.5", ""
    lines = [",".join(names), *(",".join(r) for r in rows), "P8,a,b"]
    (tmp_path / "in.csv").write_text("\n".join(lines) + "\n")
    df = tables.read_csv(spark, str(tmp_path), presets.ADMISSIONS_TEXT_SCHEMA, keep_corrupt=True)
    kept = cleaning.clean(df, presets.ADMISSIONS_TEXT).drop(tables.CSV_CORRUPT)
    assert sorted(r.patient_id for r in kept.collect()) == ["P1", "P6", "P7"]
    typed = cleaning.clean(spark.createDataFrame([], presets.ADMISSIONS_SCHEMA), presets.ADMISSIONS)
    assert kept.dtypes == typed.dtypes
    rejected = {r.patient_id: (r.first_failed_stage, r.failed_rules) for r in cleaning.rejected_rows(df, presets.ADMISSIONS_TEXT).collect()}
    assert rejected.pop("P8")[0] == "2_readable"
    assert rejected == {
        "P2": ("4_vitals", ["heart_rate: not_numeric"]),
        "P3": ("4_vitals", ["diastolic_bp"]),
        "P4": ("4_vitals", ["oxygen_sat"]),
        "P5": ("4_vitals", ["oxygen_sat: not_numeric"]),
    }


def test_scratch_path_needs_a_shared_folder_on_a_cluster():
    class Context:
        master = "spark://host:7077"

    class Session:
        sparkContext = Context
        conf = {}

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        tables.scratch_path(Session, "t")
    Context.master = "local[2]"
    assert "run-" in tables.scratch_path(Session, "t")


def test_inference_is_a_fallback(spark, tmp_path):
    (tmp_path / "in.csv").write_text("a,b,d\n1,2.5,2020-01-01\n")
    assert dict(tables.read_csv(spark, str(tmp_path)).dtypes) == {"a": "int", "b": "double", "d": "date"}


def test_text_vitals(spark, tmp_path):
    """Vitals read as text: unreadable ones fail instead of turning into missing values."""
    (tmp_path / "in.csv").write_text(
        "patient_id,admission_date,heart_rate_bpm\nP1,2020-01-01,80.0\nP2,2020-01-01,fast\nP3,2020-01-01,\nP4,2020-01-01,900\n"
    )
    schema = T.StructType([T.StructField(c, T.StringType()) for c in ("patient_id", "admission_date", "heart_rate_bpm")])
    df = tables.read_csv(spark, str(tmp_path), schema)
    rules = RuleSet(
        presets.PATIENT_KEY, (Stage("vitals", presets.as_text(presets.VITALS[:1])),)
    )
    assert sorted(r.patient_id for r in cleaning.clean(df, rules).collect()) == ["P1", "P3"]
    rejected = {r.patient_id: r.failed_rules for r in cleaning.rejected_rows(df, rules).collect()}
    assert rejected == {"P2": ["heart_rate: not_numeric"], "P4": ["heart_rate"]}


def test_clean_and_rejects_from_one_partitioned_table(spark, sf_small, folder):
    df = records(spark, sf_small)
    flagged = cleaning.flag_rows(df, presets.ADMISSIONS)
    tables.write_table(flagged, folder, partition_by=("first_failed_stage",))
    stored = tables.read_table(spark, folder)
    assert stored.filter("first_failed_stage = '4_kept'").count() == 1396
    assert stored.filter("first_failed_stage != '4_kept'").count() == 48 + 53 + 51


def test_view_is_visible_to_sql(spark, sf_small):
    tables.register_view(records(spark, sf_small), "records")
    sql = "SELECT count(*) FROM records WHERE heart_rate_bpm NOT BETWEEN 30 AND 220"
    assert spark.sql(sql).first()[0] == 14


def test_scratch_path_lies_in_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    first, second = (tables.scratch_path(spark, "t") for _ in range(2))
    assert first.startswith(shared) and first != second


def test_empty_table_survives_csv(spark, folder):
    df = spark.createDataFrame([], presets.ADMISSIONS_SCHEMA)
    tables.write_csv(df, folder)
    back = tables.read_csv(spark, folder, presets.ADMISSIONS_SCHEMA)
    assert back.count() == 0 and back.schema == df.schema


def test_filters_and_forms_accept_a_stream(spark, sf_small, folder):
    df = records(spark, sf_small)
    tables.write_table(df, folder)
    stream = spark.readStream.schema(presets.ADMISSIONS_SCHEMA).parquet(folder)
    sound = standardize(keep_valid(stream, *presets.ADMISSIONS.rules), presets.ADMISSIONS.standards)
    running = sound.writeStream.format("memory").queryName("sound").trigger(availableNow=True).start()
    try:
        running.processAllAvailable()
        expected = standardize(keep_valid(df, *presets.ADMISSIONS.rules), presets.ADMISSIONS.standards)
        assert bag(spark.table("sound")) == bag(expected)
    finally:
        running.stop()
