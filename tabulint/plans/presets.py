"""Ready rule sets: hospital admissions, and order tables as a second, unrelated example."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import types as T

from tabulint.functions.rules import InRange, IsNull, Matches, RuleSet, Stage, Standards, UniqueKey
from tabulint.sources.tables import CSV_CORRUPT

# The code pattern, the vital ranges (inclusive) with their report labels and counter
# names, and the malformed example codes.
CODE_PATTERN = r"^[A-Z][0-9]{2}(\.[0-9A-Z]{1,4})?$"

VITALS = (
    InRange("heart_rate_bpm", 30, 220, label="heart_rate", counter="bad_heart_rate"),
    InRange("systolic_bp_mmhg", 60, 220, label="systolic_bp", counter="bad_systolic"),
    InRange("diastolic_bp_mmhg", 30, 140, label="diastolic_bp", counter="bad_diastolic"),
    InRange("temp_celsius", 33, 42, label="temperature", counter="bad_temp"),
    InRange("oxygen_sat_pct", 50, 100, label="oxygen_sat", counter="bad_oxygen"),
    InRange("weight_kg", 3, 250, label="weight", counter="bad_weight"),
)

MALFORMED_CODES = ("123", "XYZ", "A1", "99B", "ABCDE", "Z999999", "00A", "!23", "A0B", "11Z")


def as_text(rules: tuple[InRange, ...]) -> tuple[InRange, ...]:
    """The same ranges for columns that hold numbers as text."""
    return tuple(replace(rule, text=True) for rule in rules)


CODE = Matches("icd10_code", CODE_PATTERN)
PATIENT_KEY = UniqueKey(("patient_id",), order_by="admission_date", order_as_date=True)

ADMISSIONS = RuleSet(
    key=PATIENT_KEY,
    stages=(Stage("icd10", (CODE,)), Stage("vitals", VITALS)),
    standards=Standards(
        dates=("dob", "admission_date", "discharge_date"),
        day_spans={"length_of_stay_days": ("admission_date", "discharge_date")},
        codes=("icd10_code",),
        names=("first_name", "last_name"),
    ),
)

ADMISSIONS_SCHEMA = T.StructType(
    [
        T.StructField("patient_id", T.StringType()),
        T.StructField("first_name", T.StringType()),
        T.StructField("last_name", T.StringType()),
        T.StructField("dob", T.StringType()),
        T.StructField("admission_date", T.StringType()),
        T.StructField("discharge_date", T.StringType()),
        T.StructField("icd10_code", T.StringType()),
        T.StructField("primary_diagnosis", T.StringType()),
        T.StructField("heart_rate_bpm", T.DoubleType()),
        T.StructField("systolic_bp_mmhg", T.DoubleType()),
        T.StructField("diastolic_bp_mmhg", T.IntegerType()),
        T.StructField("temp_celsius", T.DoubleType()),
        T.StructField("oxygen_sat_pct", T.IntegerType()),
        T.StructField("weight_kg", T.DoubleType()),
    ]
)

# The same table as CSV holds it: all text, so that a value that is no number can be told from a missing
# one, with the line itself where a line does not fit the columns.
ADMISSIONS_TEXT_SCHEMA = T.StructType([T.StructField(f.name, T.StringType()) for f in ADMISSIONS_SCHEMA.fields])
WHOLE_VITALS = tuple(f.name for f in ADMISSIONS_SCHEMA.fields if f.dataType == T.IntegerType())
TEXT_VITALS = tuple(replace(rule, text=True, whole=rule.column in WHOLE_VITALS) for rule in VITALS)
ADMISSIONS_TEXT = RuleSet(
    key=PATIENT_KEY,
    stages=(Stage("readable", (IsNull(CSV_CORRUPT, label="corrupt_line"),)), Stage("icd10", (CODE,)), Stage("vitals", TEXT_VITALS)),
    standards=replace(
        ADMISSIONS.standards,
        numbers=tuple(rule.column for rule in VITALS if rule.column not in WHOLE_VITALS),
        integers=WHOLE_VITALS,
    ),
)

# Latest order per customer; several orders of one customer can share a date, hence the tie-break.
LATEST_ORDERS = RuleSet(
    key=UniqueKey(("o_custkey",), order_by="o_orderdate", tiebreak=("o_orderkey",)),
    stages=(
        Stage("priority", (Matches("o_orderpriority", r"^[1-4]-[A-Z ]+$", label="priority"),)),
        Stage("price", (InRange("o_totalprice", 2_000, 400_000, label="price"),)),
    ),
    standards=Standards(dates=("o_orderdate",), names=("o_orderpriority",)),
)

# Orders by status share their latest date in great numbers, and some of these are faulty: ties that
# the stages decide.
TIED_ORDERS = replace(LATEST_ORDERS, key=UniqueKey(("o_orderstatus",), order_by="o_orderstatus"))

LINE_KEY = UniqueKey(("l_orderkey", "l_linenumber"), order_by="l_shipdate")
EVENT_VALUE = InRange("value", 1, 400, label="value")
CUSTOMER_NAME = Matches("c_name", r"^Customer#[0-9]{9}$")
