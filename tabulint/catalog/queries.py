"""The registered queries: every operator over whole tables of a data folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabulint.catalog.records import records, text_records
from tabulint.functions import InRange
from tabulint.operators import checks, inject, profile, standardize
from tabulint.operators.dedup import keep_latest
from tabulint.operators.validity import keep_valid
from tabulint.plans import cleaning, presets
from tabulint.plans.profiling import profile_report
from tabulint.sources import tables

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[name] = function
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return tables.read_table(spark, f"{sf_dir}/{name}.parquet")


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = table(spark, sf_dir, "orders")
    return df.withColumn("o_orderdate", F.col("o_orderdate").cast("date"))


def lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = table(spark, sf_dir, "lineitem")
    return df.withColumn("l_shipdate", F.col("l_shipdate").cast("date"))


def patient_number() -> Column:
    """The integer inside a patient id, as the key of defect injection."""
    return F.substring("patient_id", 2, 20).cast("bigint")


def heart_rate_known() -> Column:
    return F.col("heart_rate_bpm").isNotNull()


def joined_labels(df: DataFrame) -> DataFrame:
    return df.withColumn("failed_rules", F.concat_ws(", ", "failed_rules"))


# --- sources and sinks ---------------------------------------------------------------------------


@query("scan_csv")
def scan_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records written as CSV and read back with the declared schema."""
    path = tables.scratch_path(spark, "scan_csv")
    tables.write_csv(records(spark, sf_dir), path)
    return tables.read_csv(spark, path, presets.ADMISSIONS_SCHEMA)


@query("sink_csv")
def sink_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The clean table written as CSV and read back."""
    path = tables.scratch_path(spark, "sink_csv")
    cleaned = cleaning.clean(records(spark, sf_dir), presets.ADMISSIONS)
    tables.write_csv(cleaned, path)
    return tables.read_csv(spark, path, T.StructType(cleaned.schema.fields))


@query("register_view")
def register_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A user's own SQL text over the registered view."""
    tables.register_view(records(spark, sf_dir), "records")
    return spark.sql(
        """
        SELECT primary_diagnosis, count(*) AS n_rows, count(DISTINCT patient_id) AS n_patients
        FROM records
        GROUP BY primary_diagnosis
        """
    )


# --- profiling -----------------------------------------------------------------------------------


@query("profile_row_count")
def profile_row_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.row_count(records(spark, sf_dir))


@query("profile_column_count")
def profile_column_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.shape(records(spark, sf_dir))


@query("profile_null_counts")
def profile_null_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.null_counts(records(spark, sf_dir))


@query("profile_null_rates")
def profile_null_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.null_rates(records(spark, sf_dir))


@query("profile_duplicate_rows")
def profile_duplicate_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.surplus_rows(records(spark, sf_dir), presets.PATIENT_KEY.columns)


@query("profile_invalid_format")
def profile_invalid_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.malformed_count(records(spark, sf_dir), presets.CODE)


@query("profile_out_of_range")
def profile_out_of_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.out_of_range_counts(records(spark, sf_dir), presets.VITALS, guard=heart_rate_known())


@query("profile_out_of_range_unguarded")
def profile_out_of_range_unguarded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.out_of_range_counts(records(spark, sf_dir), presets.VITALS)


@query("profile_out_of_range_nonzero")
def profile_out_of_range_nonzero(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.out_of_range_nonzero(records(spark, sf_dir), presets.VITALS, guard=heart_rate_known())


@query("profile_year_distribution")
def profile_year_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.year_counts(records(spark, sf_dir), "admission_date")


@query("profile_report")
def profile_report_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile_report(records(spark, sf_dir), presets.ADMISSIONS, guard=heart_rate_known())


# --- checks --------------------------------------------------------------------------------------


@query("detect_duplicates")
def detect_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.duplicate_keys(
        records(spark, sf_dir), presets.PATIENT_KEY, earliest="earliest_admission", latest="latest_admission"
    )


@query("validate_code_format")
def validate_code_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.format_failures(records(spark, sf_dir), presets.CODE, ("patient_id",), status="icd10_status")


@query("code_status_all")
def code_status_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.format_status(records(spark, sf_dir), presets.CODE, status="icd10_status")


@query("validate_ranges")
def validate_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.range_failures(records(spark, sf_dir), presets.VITALS, ("patient_id",))


# --- cleaning ------------------------------------------------------------------------------------


@query("dedup_latest")
def dedup_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keep_latest(records(spark, sf_dir), presets.PATIENT_KEY)


@query("drop_invalid_code")
def drop_invalid_code(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keep_valid(records(spark, sf_dir), presets.CODE)


@query("drop_out_of_range")
def drop_out_of_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keep_valid(records(spark, sf_dir), *presets.VITALS)


@query("standardize_dates")
def standardize_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return standardize.standardize_dates(records(spark, sf_dir), "dob", "admission_date", "discharge_date")


@query("length_of_stay")
def length_of_stay(spark: SparkSession, sf_dir: str) -> DataFrame:
    return standardize.add_day_span(
        records(spark, sf_dir), "length_of_stay_days", "admission_date", "discharge_date"
    )


@query("standardize_code")
def standardize_code(spark: SparkSession, sf_dir: str) -> DataFrame:
    return standardize.standardize_codes(records(spark, sf_dir), "icd10_code")


@query("standardize_names")
def standardize_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return standardize.standardize_names(records(spark, sf_dir), "first_name", "last_name")


@query("standardize")
def standardize_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return standardize.standardize(records(spark, sf_dir), presets.ADMISSIONS.standards)


@query("clean_records")
def clean_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.clean(records(spark, sf_dir), presets.ADMISSIONS)


@query("clean_records_normalize_first")
def clean_records_normalize_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.clean(records(spark, sf_dir), presets.ADMISSIONS, normalize_first=True)


def text_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The text records written as CSV to the session's scratch folder, where they stay, and read back."""
    path = tables.scratch_path(spark, "text_csv")
    tables.write_csv(text_records(spark, sf_dir), path)
    return tables.read_csv(spark, path, presets.ADMISSIONS_TEXT_SCHEMA, keep_corrupt=True)


@query("clean_text_records")
def clean_text_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A CSV file cleaned with nothing turned into a missing value unseen; the types are those of the table."""
    return cleaning.clean(text_csv(spark, sf_dir), presets.ADMISSIONS_TEXT).drop(tables.CSV_CORRUPT)


@query("rejected_text_records")
def rejected_text_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    rejected = cleaning.rejected_rows(text_csv(spark, sf_dir), presets.ADMISSIONS_TEXT)
    return joined_labels(rejected).drop(tables.CSV_CORRUPT)


@query("clean_funnel_normalize_first")
def clean_funnel_normalize_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.funnel(records(spark, sf_dir), presets.ADMISSIONS, normalize_first=True)


@query("rejected_rows_normalize_first")
def rejected_rows_normalize_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return joined_labels(cleaning.rejected_rows(records(spark, sf_dir), presets.ADMISSIONS, normalize_first=True))


@query("flagged_rows_normalize_first")
def flagged_rows_normalize_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return joined_labels(cleaning.flag_rows(records(spark, sf_dir), presets.ADMISSIONS, normalize_first=True))


@query("orders_tied_step_by_step")
def orders_tied_step_by_step(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dedup, filters and standard forms one by one, over keys with many ties of good and bad rows."""
    rules = presets.TIED_ORDERS
    kept = cleaning.latest(orders(spark, sf_dir), rules)
    return standardize.standardize(keep_valid(kept, *rules.rules), rules.standards)


@query("orders_tied_clean")
def orders_tied_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same in one run."""
    return cleaning.clean(orders(spark, sf_dir), presets.TIED_ORDERS)


@query("clean_funnel")
def clean_funnel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.funnel(records(spark, sf_dir), presets.ADMISSIONS)


@query("rejected_rows")
def rejected_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return joined_labels(cleaning.rejected_rows(records(spark, sf_dir), presets.ADMISSIONS))


@query("flagged_rows")
def flagged_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return joined_labels(cleaning.flag_rows(records(spark, sf_dir), presets.ADMISSIONS))


# --- defect injection ----------------------------------------------------------------------------


@query("inject_duplicates")
def inject_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inject.inject_duplicates(orders(spark, sf_dir), inject.one_in(F.col("o_orderkey"), 64, seed=1))


@query("inject_nulls")
def inject_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    number = patient_number()
    fields = ("icd10_code", "heart_rate_bpm", "systolic_bp_mmhg", "weight_kg")
    return inject.inject_nulls(records(spark, sf_dir), inject.one_in(number, 170, seed=2), number, fields)


@query("inject_invalid_codes")
def inject_invalid_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    number = patient_number()
    return inject.inject_invalid_codes(
        records(spark, sf_dir), inject.one_in(number, 85, seed=3), number, "icd10_code", presets.MALFORMED_CODES
    )


@query("inject_out_of_range")
def inject_out_of_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    number = patient_number()
    return inject.inject_out_of_range(
        records(spark, sf_dir), inject.one_in(number, 127, seed=4), number, presets.VITALS, distance=2
    )


@query("inject_out_of_range_decimal")
def inject_out_of_range_decimal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prices as decimals, a hundredth being the least that one can lie beyond its range."""
    df = orders(spark, sf_dir).withColumn("o_totalprice", F.col("o_totalprice").cast("decimal(12,2)"))
    rule = InRange("o_totalprice", 2_000, 400_000)
    moved = inject.inject_out_of_range(df, inject.one_in(F.col("o_orderkey"), 50, seed=7), F.col("o_custkey"), [rule], distance=0.001)
    return moved.withColumn("o_totalprice", F.col("o_totalprice").cast("double"))


@query("select_k_rows")
def select_k_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inject.select_k_rows(orders(spark, sf_dir), 800, "o_orderkey", seed=5)


@query("select_k_rows_by_threshold")
def select_k_rows_by_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A large share of the table, chosen in the same way."""
    return inject.select_k_rows(orders(spark, sf_dir), 7000, "o_orderkey", seed=6)


# --- the same operators with other rules ---------------------------------------------------------


@query("orders_latest_per_customer")
def orders_latest_per_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keep_latest(orders(spark, sf_dir), presets.LATEST_ORDERS.key)


@query("orders_clean")
def orders_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.clean(orders(spark, sf_dir), presets.LATEST_ORDERS)


@query("orders_funnel")
def orders_funnel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.funnel(orders(spark, sf_dir), presets.LATEST_ORDERS)


@query("orders_rejected")
def orders_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    return joined_labels(cleaning.rejected_rows(orders(spark, sf_dir), presets.LATEST_ORDERS))


@query("orders_profile_report")
def orders_profile_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile_report(orders(spark, sf_dir), presets.LATEST_ORDERS)


@query("lineitem_duplicate_rows")
def lineitem_duplicate_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.surplus_rows(lineitem(spark, sf_dir), presets.LINE_KEY.columns)


@query("lineitem_duplicate_keys")
def lineitem_duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.duplicate_keys(lineitem(spark, sf_dir), presets.LINE_KEY)


@query("lineitem_dedup_latest")
def lineitem_dedup_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keep_latest(lineitem(spark, sf_dir), presets.LINE_KEY)


@query("documents_duplicate_texts")
def documents_duplicate_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.surplus_rows(table(spark, sf_dir, "documents"), ("text",), digest=True)


@query("events_out_of_range")
def events_out_of_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.range_failures(table(spark, sf_dir, "events"), (presets.EVENT_VALUE,), ("event_id",))


@query("events_year_distribution")
def events_year_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.year_counts(table(spark, sf_dir, "events"), "ts")


@query("customer_name_status")
def customer_name_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.format_status(table(spark, sf_dir, "customer"), presets.CUSTOMER_NAME)

