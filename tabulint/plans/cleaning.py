"""A cleaning run: one row per key, then the filter stages in order, then standard forms.

Dedup comes before validation: when the latest row of a key is invalid the key is gone, and no older
valid row takes its place. Only among rows that tie on everything the key declares does the row that
gets through more stages win; that makes the choice repeatable and lets the funnel work on narrow rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabulint.functions.row_hash import quoted, refuse_reserved
from tabulint.functions.rules import RuleSet
from tabulint.operators.dedup import GRADE, ROWS, keep_latest, latest_grade, mark_superseded
from tabulint.operators.standardize import standardize, standardize_codes

DEDUP_STAGE = "dedup"
KEPT_STAGE = "kept"
PASSED = "__dq_passed"
SUPERSEDED = "__dq_superseded"


def stage_names(rules: RuleSet) -> list[str]:
    """Numbered stage names in order of execution, the last being the rows that are kept."""
    names = [DEDUP_STAGE, *(stage.name for stage in rules.stages), KEPT_STAGE]
    return [f"{i}_{name}" for i, name in enumerate(names, start=1)]


def stages_passed(rules: RuleSet) -> Column:
    """How many filter stages a row gets through before one drops it."""
    passed = F.lit(len(rules.stages))
    for i, stage in reversed(list(enumerate(rules.stages))):
        passed = F.when(stage.violation(), i).otherwise(passed)
    return passed


def _normalized(df: DataFrame, rules: RuleSet, normalize_first: bool) -> DataFrame:
    refuse_reserved(df, PASSED, SUPERSEDED)
    return standardize_codes(df, *rules.standards.codes) if normalize_first else df


def latest(df: DataFrame, rules: RuleSet) -> DataFrame:
    """The rows that the dedup of ``clean`` keeps, unfiltered: on ties the row that gets through more stages.

    ``latest``, ``keep_valid`` with the rules and ``standardize`` in turn give what ``clean`` gives.
    """
    graded = _normalized(df, rules, False).withColumn(PASSED, stages_passed(rules))
    return keep_latest(graded, rules.key, leading=(PASSED,)).drop(PASSED)


def clean(df: DataFrame, rules: RuleSet, *, normalize_first: bool = False) -> DataFrame:
    """The clean table, as one lazy plan with a single shuffle.

    Every rule is evaluated once, before the shuffle, to the number of stages passed; the filter after
    the dedup only reads that number. ``normalize_first`` tidies the codes before they are checked,
    which repairs codes that are only untidy. It is off by default: an untidy code is an invalid code.
    """
    graded = _normalized(df, rules, normalize_first).withColumn(PASSED, stages_passed(rules))
    newest = keep_latest(graded, rules.key, leading=(PASSED,))
    kept = newest.filter(F.col(PASSED) == len(rules.stages)).drop(PASSED)
    return standardize(kept, rules.standards)


def funnel(df: DataFrame, rules: RuleSet, *, normalize_first: bool = False) -> DataFrame:
    """(stage, before, after, removed) for every stage of ``clean``, in one pass over the table.

    It reads only the key, the order value and the ruled columns; the shuffle carries one narrow row
    per key and map task. Stages that remove nothing are listed too, also on an empty table.
    """
    names = stage_names(rules)
    df = _normalized(df, rules, normalize_first)
    best = latest_grade(df, rules.key, stages_passed(rules), grades=len(rules.stages) + 1)
    totals = best.agg(
        F.coalesce(F.sum(ROWS), F.lit(0)).alias("left_0"),
        *(F.count_if(F.col(GRADE) >= i).alias(f"left_{i + 1}") for i in range(len(rules.stages) + 1)),
    )

    last = len(names) - 1
    steps = [
        F.struct(
            F.lit(name).alias("stage"),
            F.col(f"left_{i}").alias("before"),
            F.col(f"left_{min(i + 1, last)}").alias("after"),
        )
        for i, name in enumerate(names)
    ]
    return totals.select(F.inline(F.array(*steps))).withColumn("removed", F.col("before") - F.col("after"))


def flag_rows(df: DataFrame, rules: RuleSet, *, normalize_first: bool = False, **hot_key_options) -> DataFrame:
    """Every input row, unchanged (with ``normalize_first`` its codes tidied), plus ``first_failed_stage`` and ``failed_rules``.

    ``first_failed_stage`` is the stage of ``clean`` that drops the row, or the kept stage. ``failed_rules``
    lists all rules the row breaks, so it can name rules of later stages too. To store the clean rows
    and the rejects of one run, write this frame once, partitioned by ``first_failed_stage``.
    Options are those of ``mark_superseded``.
    """
    names = stage_names(rules)
    df = _normalized(df, rules, normalize_first)
    graded = df.withColumn(PASSED, stages_passed(rules))
    marked = mark_superseded(graded, rules.key, SUPERSEDED, leading=(PASSED,), **hot_key_options)

    stage = F.when(F.col(SUPERSEDED), names[0])
    for i, name in enumerate(names[1:]):
        stage = stage.when(F.col(PASSED) == i, name)
    labels = F.array_compact(
        F.array(F.when(F.col(SUPERSEDED), F.lit("superseded")), *(rule.failure() for rule in rules.rules))
    )
    faultless = ~F.col(SUPERSEDED) & (F.col(PASSED) == len(rules.stages))
    broken = F.when(faultless, F.array().cast("array<string>")).otherwise(labels)
    return marked.select(
        *map(quoted, df.columns),
        stage.alias("first_failed_stage"),
        broken.alias("failed_rules"),
    )


def rejected_rows(df: DataFrame, rules: RuleSet, *, normalize_first: bool = False, **hot_key_options) -> DataFrame:
    """The rows ``clean`` drops, with the stage that drops them and all rules they break."""
    flagged = flag_rows(df, rules, normalize_first=normalize_first, **hot_key_options)
    return flagged.filter(F.col("first_failed_stage") != stage_names(rules)[-1])
