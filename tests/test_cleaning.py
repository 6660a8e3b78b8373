"""Dedup, cleaning runs, funnel and rejects: literal cases, invariants, expected counts, skew."""

import datetime

import pytest
from pyspark.sql import functions as F

from tabulint.catalog.records import records
from tabulint.functions import InRange, RuleSet, Stage, UniqueKey
from tabulint.operators import checks, profile
from tabulint.operators.dedup import keep_latest, mark_superseded
from tabulint.operators.standardize import standardize_codes
from tabulint.operators.validity import keep_valid
from tabulint.plans import cleaning, presets
from tabulint.plans.profiling import profile_report
from tests.oracle import _rows

RULES = presets.ADMISSIONS
KEY = UniqueKey(("k",), order_by="d", tiebreak=("t",), order_as_date=True)


def bag(df):
    return _rows(df.columns, df.collect())


@pytest.fixture(scope="module")
def admissions(spark, sf_medium):
    df = records(spark, sf_medium).cache()
    yield df
    df.unpersist()


# --- dedup ---------------------------------------------------------------------------------------


def test_latest_date_wins_and_null_is_last(spark):
    df = spark.createDataFrame(
        [("a", "2020-01-01", 1), ("a", "2021-01-01", 2), ("a", None, 3), ("a", "not a date", 4), ("b", None, 5)],
        "k string, d string, t int",
    )
    assert {r.k: r.t for r in keep_latest(df, KEY).collect()} == {"a": 2, "b": 5}


def test_dates_are_compared_as_dates(spark):
    df = spark.createDataFrame([("a", "2020-9-1", 1), ("a", "2020-10-01", 2)], "k string, d string, t int")
    assert keep_latest(df, KEY).first().t == 2


def test_tiebreak_decides(spark):
    df = spark.createDataFrame([("a", "2020-01-01", i) for i in (3, 9, 4)], "k string, d string, t int")
    assert keep_latest(df, KEY).first().t == 9


def test_ties_without_tiebreak_are_decided_by_the_other_columns(spark):
    key = UniqueKey(("k",), order_by="d")
    rows = [("a", "2020-01-01", "x", None), ("a", "2020-01-01", "y", 1), ("a", "2020-01-01", "y", 2)]
    for order in (rows, rows[::-1]):
        df = spark.createDataFrame(order, "k string, d string, u string, v int")
        assert [tuple(r) for r in keep_latest(df, key).collect()] == [("a", "2020-01-01", "y", 2)]


def test_three_notions_of_duplicate_on_null_keys(spark):
    df = spark.createDataFrame([(None, "2020-01-01", 1), (None, "2020-01-02", 2)], "k string, d string, t int")
    assert profile.surplus_rows(df, ("k",)).first()[0] == 2
    group = checks.duplicate_keys(df, KEY).collect()
    assert [(g.k, g.occurrence_count) for g in group] == [(None, 2)]
    assert keep_latest(df, KEY).count() == 1
    marked = mark_superseded(df, KEY, "dup", hot_rows=0, slice_rows=1)
    assert sorted((r.t, r.dup) for r in marked.collect()) == [(1, True), (2, False)]


def test_input_column_named_rn_survives(spark):
    df = spark.createDataFrame([("a", "2020-01-01", 1, 7)], "k string, d string, t int, rn int")
    assert keep_latest(df, KEY).first().rn == 7


def test_map_columns_are_carried(spark):
    df = spark.createDataFrame([("a", "2020-01-01", 1, {"x": 1})] * 2, "k string, d string, t int, m map<string,int>")
    assert keep_latest(df, KEY).first().m == {"x": 1}
    assert mark_superseded(df, KEY, "dup", hot_rows=0).filter("dup").count() == 1


def test_duplicate_keys_order_and_span(spark):
    df = spark.createDataFrame(
        [("b", "2020-01-01", 1), ("b", "2020-01-03", 2), ("a", "2020-01-01", 1), ("a", "2020-01-01", 2)]
        + [("c", "2020-01-01", i) for i in range(3)]
        + [("d", "2020-01-01", 1)],
        "k string, d string, t int",
    )
    found = checks.duplicate_keys(df, KEY, earliest="first", latest="last").collect()
    assert [(r.k, r.occurrence_count) for r in found] == [("c", 3), ("a", 2), ("b", 2)]
    assert (found[2]["first"], found[2]["last"]) == (datetime.date(2020, 1, 1), datetime.date(2020, 1, 3))


def test_estimated_surplus(spark, admissions):
    exact = profile.surplus_rows(admissions, ("patient_id",)).first()[0]
    rows = admissions.count()
    for keys in (("patient_id",), ("patient_id", "primary_diagnosis")):
        estimate = profile.surplus_rows(admissions, keys, relative_error=0.01).first()[0]
        assert abs(estimate - exact) < 0.05 * rows


# --- expected numbers of the derived admissions table ---------------------------------------------


@pytest.mark.parametrize(
    "folder, rows, removed, clean_rows",
    [("sf0.001", 1548, (48, 53, 51), 1396), ("sf0.01", 15470, (470, 512, 485), 14003), ("sf0.1", 154688, (4688, 5102, 4900), 139998)],
)
def test_expected_counts(spark, sf_small, folder, rows, removed, clean_rows):
    df = records(spark, sf_small.replace("sf0.001", folder))
    steps = {r.stage: r for r in cleaning.funnel(df, RULES).collect()}
    assert list(steps) == ["1_dedup", "2_icd10", "3_vitals", "4_kept"]
    assert steps["1_dedup"].before == rows
    assert tuple(steps[s].removed for s in ("1_dedup", "2_icd10", "3_vitals")) == removed
    assert steps["4_kept"].after == clean_rows == cleaning.clean(df, RULES).count()


def test_mutants_are_told_apart(spark, admissions):
    """Wrong orders of the steps give other row counts, so the counts above would catch them."""
    key, stages = RULES.key, RULES.stages
    filter_first = keep_latest(keep_valid(admissions, *RULES.rules), key)
    assert filter_first.count() == 14112
    assert cleaning.clean(admissions, RULES, normalize_first=True).count() == 14169
    strict = tuple(InRange(r.column, r.lo, r.hi, null_ok=False) for r in presets.VITALS)
    assert cleaning.clean(admissions, RuleSet(key, (stages[0], Stage("vitals", strict)))).count() == 13894


def test_invalid_latest_row_takes_its_key_along(spark):
    rows = [("P1", "2020-01-01", "A00"), ("P1", "2021-01-01", "bad"), ("P2", "2020-01-01", "A00")]
    df = spark.createDataFrame(rows, "patient_id string, admission_date string, icd10_code string")
    rules = RuleSet(RULES.key, RULES.stages[:1])
    assert [r.patient_id for r in cleaning.clean(df, rules).collect()] == ["P2"]


# --- invariants ----------------------------------------------------------------------------------


def test_funnel_steps_connect(admissions):
    steps = cleaning.funnel(admissions, RULES).collect()
    for step, following in zip(steps, steps[1:]):
        assert step.after == following.before
        assert step.removed == step.before - step.after


def test_kept_and_rejected_make_up_the_input(admissions):
    flagged = cleaning.flag_rows(admissions, RULES)
    rejected = cleaning.rejected_rows(admissions, RULES)
    kept = flagged.filter("first_failed_stage = '4_kept'")
    assert bag(flagged.drop("first_failed_stage", "failed_rules")) == bag(admissions)
    assert kept.count() + rejected.count() == admissions.count()
    assert kept.filter(F.size("failed_rules") > 0).count() == 0
    assert rejected.filter(F.size("failed_rules") == 0).count() == 0
    standardized = cleaning.standardize(kept.drop("first_failed_stage", "failed_rules"), RULES.standards)
    assert bag(standardized) == bag(cleaning.clean(admissions, RULES))


def test_funnel_agrees_with_flags(admissions):
    removed = {r.stage: r.removed for r in cleaning.funnel(admissions, RULES).collect()}
    counted = cleaning.flag_rows(admissions, RULES).groupBy("first_failed_stage").count().collect()
    counted = {r[0]: r[1] for r in counted if r[0] != "4_kept"}
    assert counted == {s: n for s, n in removed.items() if n}


def test_clean_twice_is_clean_once(admissions):
    once = cleaning.clean(admissions, RULES)
    texts = {c: F.col(c).cast("string") for c in RULES.standards.dates}
    again = cleaning.clean(once.drop("length_of_stay_days").withColumns(texts), RULES)
    assert bag(again) == bag(once)


def test_dedup_keeps_one_row_per_key(admissions):
    kept = keep_latest(admissions, RULES.key)
    assert kept.count() == admissions.select("patient_id").distinct().count()


def test_codes_tidied_first_equals_tidied_input(admissions):
    tidied = standardize_codes(admissions, "icd10_code")
    assert bag(cleaning.clean(tidied, RULES)) == bag(cleaning.clean(admissions, RULES, normalize_first=True))


def test_empty_table(spark):
    df = spark.createDataFrame([], presets.ADMISSIONS_SCHEMA)
    assert cleaning.clean(df, RULES).count() == 0
    assert cleaning.rejected_rows(df, RULES).count() == 0
    assert [tuple(r)[1:] for r in cleaning.funnel(df, RULES).collect()] == [(0, 0, 0)] * 4
    assert [r.n_null for r in profile.null_counts(df).collect()] == [0] * 14
    assert profile.null_rates(df).count() == 0
    assert profile.surplus_rows(df, ("patient_id",)).first()[0] == 0
    assert list(profile.out_of_range_counts(df, presets.VITALS).first()) == [0] * 6
    report = {(r.section, r.metric): r.value for r in profile_report(df, RULES).collect()}
    assert report == {
        ("shape", "rows"): 0,
        ("shape", "columns"): 14,
        ("duplicates", "patient_id"): 0,
        ("invalid_format", "icd10_code"): 0,
    }


def test_report_counts_unparsable_dates(spark):
    rows = [("P1", "2020-01-01", "A00"), ("P2", "soon", "A00"), ("P3", None, "A00")]
    df = spark.createDataFrame(rows, "patient_id string, admission_date string, icd10_code string")
    rules = RuleSet(RULES.key, RULES.stages[:1], presets.Standards(dates=("admission_date",)))
    report = {(r.section, r.metric): r.value for r in profile_report(df, rules).collect()}
    assert report["unparsable_date", "admission_date"] == 1
    assert report["rows_per_year", "2020"] == 1
    assert report["rows_per_year", "unknown"] == 2
    assert report["null_rate", "admission_date"] == pytest.approx(1 / 3)


# --- partitioning and skew ------------------------------------------------------------------------


@pytest.mark.parametrize("partitions", [1, 4, 64])
def test_results_do_not_depend_on_partitioning(spark, admissions, partitions):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    expected = bag(cleaning.clean(admissions, RULES)), bag(cleaning.funnel(admissions, RULES))
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        moved = admissions.repartition(partitions)
        assert (bag(cleaning.clean(moved, RULES)), bag(cleaning.funnel(moved, RULES))) == expected
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


@pytest.fixture(scope="module")
def skewed(spark, sf_small, tmp_path_factory):
    """A third of all rows share one patient, a good part of them as exact copies; stored in several files."""
    df = records(spark, sf_small)
    one = F.when(F.xxhash64("patient_id") % 3 == 0, F.lit("P0000001")).otherwise(F.col("patient_id"))
    hot = df.withColumn("patient_id", one)
    copies = hot.filter("patient_id = 'P0000001'").orderBy("admission_date", *hot.columns).limit(1)
    many = copies.withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(300)))).drop("n")
    path = str(tmp_path_factory.mktemp("skew") / "hot.parquet")
    hot.unionByName(many).repartition(7).write.parquet(path)
    return spark.read.parquet(path)


def test_hot_key_holds_a_third(skewed):
    assert skewed.filter("patient_id = 'P0000001'").count() * 3 > skewed.count()


@pytest.mark.parametrize("options", [{}, {"hot_rows": 100}, {"hot_rows": 0}, {"hot_rows": 100, "slice_rows": 50}])
def test_hot_keys_in_slices_equal_one_window(skewed, options):
    flagged = cleaning.flag_rows(skewed, RULES, **options)
    assert bag(flagged.drop("first_failed_stage", "failed_rules")) == bag(skewed)
    kept = flagged.filter("first_failed_stage != '1_dedup'").drop("first_failed_stage", "failed_rules")
    graded = skewed.withColumn("passed", cleaning.stages_passed(RULES))
    assert bag(kept) == bag(keep_latest(graded, RULES.key, leading=("passed",)).drop("passed"))
    counts = {r.stage: r.after for r in cleaning.funnel(skewed, RULES).collect()}
    assert counts["1_dedup"] == kept.count()


def test_hot_key_is_spread_over_slices(spark, skewed):
    from tabulint.functions.row_hash import row_hash, sortable_columns, with_origin

    hot = with_origin(skewed, "file").filter("patient_id = 'P0000001'")
    slices = hot.groupBy(F.pmod(row_hash([*sortable_columns(skewed), "file"]), F.lit(64))).count().collect()
    assert len(slices) > 32


def test_flags_on_a_joined_input(spark, skewed):
    """Spark cannot name the file of a joined row; contents alone then spread the hot key."""
    joined = skewed.join(skewed.select("patient_id").distinct(), "patient_id")
    assert bag(cleaning.flag_rows(joined, RULES, hot_rows=10)) == bag(cleaning.flag_rows(skewed, RULES).select(*joined.columns, "first_failed_stage", "failed_rules"))


def test_a_key_with_nine_tenths_of_the_rows(spark, skewed, tmp_path):
    """Slices follow the key's count, and whole rows are shuffled once beside the search for winners."""
    most = F.when(F.xxhash64("patient_id", "admission_date") % 10 != 0, F.lit("P0000001")).otherwise(F.col("patient_id"))
    skewed.withColumn("patient_id", most).write.parquet(str(tmp_path / "most"))
    df = spark.read.parquet(str(tmp_path / "most"))
    assert df.filter("patient_id = 'P0000001'").count() > 0.85 * df.count()
    for slice_rows in (10, 400):
        flagged = cleaning.flag_rows(df, RULES, hot_rows=100, slice_rows=slice_rows)
        kept = flagged.filter("first_failed_stage != '1_dedup'").drop("first_failed_stage", "failed_rules")
        graded = df.withColumn("passed", cleaning.stages_passed(RULES))
        assert bag(kept) == bag(keep_latest(graded, RULES.key, leading=("passed",)).drop("passed"))
    plan = flagged._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert sum("Exchange hashpartitioning(patient_id" in line and "__dq_slice#" in line for line in plan.splitlines()) == 1
