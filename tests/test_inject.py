"""Planted defects are found, whole and nothing else."""

import hashlib

import pytest
from pyspark.sql import functions as F

from tabulint.catalog.queries import patient_number
from tabulint.catalog.records import records
from tabulint.functions import InRange, RuleSet
from tabulint.operators import checks, inject, profile
from tabulint.operators.validity import keep_valid
from tabulint.plans import cleaning, presets
from tabulint.sources.tables import read_table

@pytest.fixture(scope="module")
def sound(spark, sf_medium):
    """Admissions without any defect: unique patients, valid codes and vitals, no NULL."""
    raw = records(spark, sf_medium).dropna()
    df = cleaning.clean(raw, RuleSet(presets.PATIENT_KEY, presets.ADMISSIONS.stages)).cache()
    yield df
    df.unpersist()


def ids(df):
    return sorted(r.patient_id for r in df.select("patient_id").collect())


def test_duplicates_are_exactly_the_selected(sound):
    hit = inject.one_in(patient_number(), 50, seed=1)
    planted = inject.inject_duplicates(sound, hit, copies=2)
    chosen = ids(sound.filter(hit))
    assert planted.count() == sound.count() + 2 * len(chosen)
    found = checks.duplicate_keys(planted, presets.PATIENT_KEY).collect()
    assert sorted(r.patient_id for r in found) == chosen
    assert {r.occurrence_count for r in found} == {3}
    assert profile.surplus_rows(planted, ("patient_id",)).first()[0] == 2 * len(chosen)
    assert planted.dropDuplicates().exceptAll(sound).count() == 0


def test_nulls_blank_one_field_each(sound):
    fields = ("icd10_code", "heart_rate_bpm", "systolic_bp_mmhg", "weight_kg")
    hit = inject.one_in(patient_number(), 40, seed=2)
    planted = inject.inject_nulls(sound, hit, patient_number(), fields)
    n_null = sum((F.col(c).isNull().cast("int") for c in fields), F.lit(0))
    assert planted.groupBy(n_null).count().count() == 2
    assert ids(planted.filter(n_null == 1)) == ids(sound.filter(hit))
    missing = checks.format_failures(planted, presets.CODE, ("patient_id",))
    assert ids(missing) == ids(sound.filter(hit & (F.pmod(patient_number(), F.lit(4)) == 0)))
    # a missing vital is not a fault
    assert keep_valid(planted, *presets.VITALS).count() == sound.count()


def test_invalid_codes_are_all_found(sound):
    hit = inject.one_in(patient_number(), 30, seed=3)
    planted = inject.inject_invalid_codes(sound, hit, patient_number(), "icd10_code", presets.MALFORMED_CODES)
    found = checks.format_failures(planted, presets.CODE, ("patient_id",))
    assert ids(found) == ids(sound.filter(hit))
    assert {r.icd10_code for r in found.collect()} == set(presets.MALFORMED_CODES)


@pytest.mark.parametrize("distance", [1, 0.5])
def test_out_of_range_values_are_all_found(sound, distance):
    hit = inject.one_in(patient_number(), 30, seed=4)
    rules = presets.VITALS
    planted = inject.inject_out_of_range(sound, hit, patient_number(), rules, distance)
    assert planted.schema == sound.schema
    found = checks.range_failures(planted, presets.VITALS, ("patient_id",))
    assert ids(found) == ids(sound.filter(hit))
    assert {r.flagged_fields for r in found.collect()} == {", ".join(r.name for r in rules)}
    for rule in rules:
        values = {r[0] for r in found.select(rule.column).distinct().collect()}
        step = 1 if rule.column in presets.WHOLE_VITALS else distance  # whole numbers move to the next one
        assert values == {rule.lo - step, rule.hi + step}


def test_injection_is_the_same_on_any_partitioning(sound):
    def defects(df):
        return inject.inject_invalid_codes(df, inject.one_in(patient_number(), 30), patient_number(), "icd10_code", presets.MALFORMED_CODES)

    assert defects(sound.repartition(13)).exceptAll(defects(sound)).count() == 0


@pytest.mark.parametrize("k", [0, 1, 800, 10**6])
def test_exactly_k_rows(spark, sf_small, k):
    df = read_table(spark, f"{sf_small}/orders.parquet")
    chosen = inject.select_k_rows(df, k, "o_orderkey", seed=7)
    assert chosen.count() == min(k, df.count())
    assert chosen.select("o_orderkey").distinct().count() == chosen.count()


def test_one_in_picks_the_right_share(spark):
    df = spark.range(100_000)
    share = df.filter(inject.one_in(F.col("id"), 100, seed=3)).count() / 100_000
    assert 0.008 < share < 0.012


def test_large_and_negative_keys_do_not_overflow(spark):
    df = spark.createDataFrame([(2**63 - 1,), (-(2**63),), (-1,)], "k bigint")
    values = [r[0] for r in df.select(inject.scramble(F.col("k"), 5)).collect()]
    assert all(0 <= v < inject.NUMBERS for v in values)


def number(key, seed=0):
    text = f"{'NULL' if key is None else key}:{seed}".encode()
    return int(hashlib.md5(text).hexdigest()[: inject.DIGITS], 16)


def test_k_rows_equal_brute_force(spark):
    keys = [None, -3, -1, 0, 2**63 - 1, *(i * 1_000_003 for i in range(1, 9)), *range(10, 30)]
    df = spark.createDataFrame([(k, f"row {k}") for k in keys], "k bigint, v string").repartition(3)
    for k in (*range(0, len(keys) + 2, 4), 1, len(keys), len(keys) + 1):
        chosen = [r.k for r in inject.select_k_rows(df, k, "k", seed=2).collect()]
        assert sorted(chosen, key=number) == sorted(sorted(keys, key=lambda x: number(x, 2))[:k], key=number)


def test_k_rows_refuse_to_cut_between_equal_keys(spark):
    df = spark.createDataFrame([(1,), (1,), (2,)], "k bigint")
    first = min((1, 2), key=number)
    whole = 2 if first == 1 else 1
    assert {r.k for r in inject.select_k_rows(df, whole, "k").collect()} == {first}
    with pytest.raises(Exception, match="share the key"):
        inject.select_k_rows(df, 1 if first == 1 else 2, "k").collect()


def test_k_rows_move_no_whole_rows_into_one_task(spark, sf_small):
    df = read_table(spark, f"{sf_small}/orders.parquet")
    plan = inject.select_k_rows(df, 700, "o_orderkey")._jdf.queryExecution().executedPlan().toString()
    main = plan.split("Subqueries")[0]
    assert "Exchange" not in main.split("Subquery")[0] and "o_comment" not in "".join(
        line for line in plan.splitlines() if "SinglePartition" in line
    )


@pytest.mark.parametrize("every", [10**6, 10**7, 10**9])
def test_one_in_has_no_limit(every):
    """By arithmetic: the numbers that are picked are spread over the whole range, 1 in ``every``."""
    assert inject.NUMBERS // every > 10**8
    picked = len(range(0, inject.NUMBERS, every)) / inject.NUMBERS
    assert abs(picked * every - 1) < 1e-8


@pytest.mark.parametrize("kind", ["tinyint", "smallint", "int", "bigint", "decimal(5,1)", "decimal(20,6)", "float", "double"])
@pytest.mark.parametrize("lo,hi,distance", [(0, 100, 0.01), (0, 100, 1), (-3.5, 99.5, 0.25), (0, 100, 20)])
def test_every_planted_value_is_out_of_range_in_any_type(spark, kind, lo, hi, distance):
    rule = InRange("a.b", lo, hi)
    df = spark.range(40).select("id", F.lit(50).cast(kind).alias("a.b"))
    moved = inject.inject_out_of_range(df, F.col("id") % 2 == 0, F.when(F.col("id") > 5, F.col("id") / 2).cast("long"), [rule], distance)
    assert moved.schema["a.b"].dataType == df.schema["a.b"].dataType
    assert keep_valid(moved, rule).count() == 20
    values = {float(r[0]) for r in moved.filter("id % 2 = 0").select("`a.b`").collect()}
    assert len(values) == 2 and min(values) < lo and max(values) > hi
    assert min(values) > lo - distance - 1.1 and max(values) < hi + distance + 1.1


@pytest.mark.parametrize("kind,lo,hi", [("float", 1e8, 2e8), ("float", -1e30, 1e30), ("double", 1e17, 1e18), ("double", 0.1, 0.3)])
def test_values_next_to_a_range_whose_ends_swallow_the_distance(spark, kind, lo, hi):
    rule = InRange("x", lo, hi)
    df = spark.range(10).select(F.lit((lo + hi) / 2).cast(kind).alias("x"), "id")
    assert keep_valid(inject.inject_out_of_range(df, F.lit(True), F.col("id"), [rule], 1e-3), rule).count() == 0


@pytest.mark.parametrize("kind,distance", [("tinyint", 100), ("decimal(3,0)", 900), ("smallint", 1e6)])
def test_types_that_cannot_hold_the_value_are_refused(spark, kind, distance):
    df = spark.range(3).select(F.lit(1).cast(kind).alias("x"), "id")
    with pytest.raises(ValueError, match="x has no values"):
        inject.inject_out_of_range(df, F.lit(True), F.col("id"), [InRange("x", 0, 120)], distance)
    with pytest.raises(ValueError, match="above 0"):
        inject.inject_out_of_range(df, F.lit(True), F.col("id"), [InRange("x", 0, 120)], 0)


def test_null_variants_and_names_with_dots(spark):
    df = spark.createDataFrame([(i, None if i % 2 else i, "A00.1") for i in range(8)], "id int, v int, `c.d` string")
    coded = inject.inject_invalid_codes(df, F.lit(True), F.col("v"), "c.d", ["bad", "worse"])
    assert {r["c.d"] for r in coded.collect()} == {"bad"} and coded.columns == df.columns
    blank = inject.inject_nulls(df, F.lit(True), F.col("v"), ["c.d", "id"])
    assert blank.filter("`c.d` IS NULL").count() == 8
