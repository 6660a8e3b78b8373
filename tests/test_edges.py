"""Empty rule lists, odd column names, reserved names, odd types."""

import pytest
from pyspark.sql import functions as F

from tabulint.functions import InRange, Matches, NotNull, RuleSet, Stage, UniqueKey
from tabulint.functions.row_hash import sortable_columns
from tabulint.operators import checks, profile
from tabulint.operators.validity import keep_valid
from tabulint.plans import cleaning


def test_no_rules_keep_everything(spark):
    df = spark.createDataFrame([(1, "x"), (2, None)], "k int, v string")
    assert keep_valid(df).count() == 2
    rules = RuleSet(UniqueKey(("k",), order_by="v"), (Stage("none", ()),))
    assert cleaning.clean(df, rules).count() == 2
    assert cleaning.rejected_rows(df, rules).count() == 0
    assert checks.range_failures(df, (), ("k",)).count() == 0


def test_names_with_dots_and_backticks(spark):
    df = spark.createDataFrame([(1, 5, "A"), (2, None, "b"), (2, 900, "C")], "`a.b` int, `n``u.m` int, `c.d` string")
    assert {r["column"]: r.n_null for r in profile.null_counts(df).collect()} == {"a.b": 0, "n`u.m": 1, "c.d": 0}
    rules = (NotNull("n`u.m"), InRange("n`u.m", 0, 10), Matches("c.d", "^[A-Z]$"))
    assert [r["a.b"] for r in keep_valid(df, *rules).collect()] == [1]
    assert checks.duplicate_keys(df, UniqueKey(("a.b",), order_by="n`u.m")).count() == 1
    whole = RuleSet(UniqueKey(("a.b",), order_by="n`u.m"), (Stage("all", rules),))
    assert cleaning.clean(df, whole).count() == 1
    assert cleaning.flag_rows(df, whole, hot_rows=1, hot_share=0.0, slice_rows=1).count() == 3
    assert cleaning.funnel(df, whole).count() == 3


def test_reserved_names_are_refused(spark):
    df = spark.createDataFrame([(1, 2)], "k int, __dq_passed int")
    with pytest.raises(ValueError, match="__dq_passed"):
        cleaning.clean(df, RuleSet(UniqueKey(("k",), order_by="k"), ()))


def test_types_are_walked_not_searched(spark):
    df = spark.sql("SELECT 1 AS k, named_struct('variant_id', 'x') AS s, map('a', 1) AS m, array(map('a', 1)) AS am")
    assert sortable_columns(df) == ["k", "s"]


def test_digest_of_any_key_type_and_estimates_not_below_zero(spark):
    df = spark.range(1000).withColumn("id", F.col("id").cast("bigint"))
    assert profile.surplus_rows(df, ("id",), digest=True).first()[0] == 0
    assert profile.surplus_rows(df, ("id",), relative_error=0.05).first()[0] >= 0


def test_step_by_step_equals_one_run_on_ties(spark):
    df = spark.createDataFrame([(1, "2020-01-01", 5, "z"), (1, "2020-01-01", 500, "zz")], "k int, d string, n int, t string")
    rules = RuleSet(UniqueKey(("k",), order_by="d"), (Stage("n", (InRange("n", 0, 10),)),))
    steps = keep_valid(cleaning.latest(df, rules), *rules.rules)
    assert steps.collect() == cleaning.clean(df, rules).collect() and steps.count() == 1


def test_grade_with_a_whole_number_tie_break_is_a_hash_aggregate(spark):
    df = spark.sql(
        "SELECT * FROM VALUES (1, DATE'2020-01-01', 5L, 1), (1, DATE'2020-01-01', 9L, 500), (1, NULL, 99L, 1), (2, NULL, NULL, 1) AS t(k, d, o, n)"
    )
    rules = RuleSet(UniqueKey(("k",), order_by="d", tiebreak=("o",)), (Stage("n", (InRange("n", 0, 10),)),))
    found = cleaning.funnel(df, rules)
    assert [(r.stage, r.after) for r in found.collect()] == [("1_dedup", 2), ("2_n", 1), ("3_kept", 1)]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "ObjectHashAggregate" not in plan
