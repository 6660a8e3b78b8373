"""For each registered query the same result in ANSI-style SQL, written independently of the operators."""

from __future__ import annotations

from tabulint.catalog.records import KEYS_BY_UNION, RECORDS_SQL, TEXT_VITALS

# Fixed values, as in the presets; spelled again here so that the oracle does not lean on the library.
CODE_OK = r"regexp_matches(icd10_code, '^[A-Z][0-9]{2}(\.[0-9A-Z]{1,4})?$')"
VITAL_BOUNDS = {
    "heart_rate_bpm": ("heart_rate", "bad_heart_rate", 30, 220),
    "systolic_bp_mmhg": ("systolic_bp", "bad_systolic", 60, 220),
    "diastolic_bp_mmhg": ("diastolic_bp", "bad_diastolic", 30, 140),
    "temp_celsius": ("temperature", "bad_temp", 33, 42),
    "oxygen_sat_pct": ("oxygen_sat", "bad_oxygen", 50, 100),
    "weight_kg": ("weight", "bad_weight", 3, 250),
}
BAD_CODES = ("123", "XYZ", "A1", "99B", "ABCDE", "Z999999", "00A", "!23", "A0B", "11Z")
COLUMNS = (
    "patient_id", "first_name", "last_name", "dob", "admission_date", "discharge_date", "icd10_code",
    "primary_diagnosis", "heart_rate_bpm", "systolic_bp_mmhg", "diastolic_bp_mmhg", "temp_celsius",
    "oxygen_sat_pct", "weight_kg",
)


def bad(column: str) -> str:
    """Present and outside its bounds; false for NULL."""
    _, _, lo, hi = VITAL_BOUNDS[column]
    return f"coalesce({column} < {lo} OR {column} > {hi}, false)"


ANY_BAD = "(" + " OR ".join(bad(c) for c in VITAL_BOUNDS) + ")"
CODE_BAD = f"(icd10_code IS NULL OR NOT {CODE_OK})"
LABELS = ", ".join(f"CASE WHEN {bad(c)} THEN '{label}' END" for c, (label, *_) in VITAL_BOUNDS.items())


def joined(items: str) -> str:
    return f"array_to_string(list_filter([{items}], lambda x: x IS NOT NULL), ', ')"


RECORDS = RECORDS_SQL.replace("{keys}", KEYS_BY_UNION)


def over_records(*ctes: str, select: str) -> str:
    views = [f"records AS ({RECORDS})", *ctes]
    return "WITH " + ",\n".join(views) + "\n" + select


def replaced(columns: tuple[str, ...], **new: str) -> str:
    """A select list of ``columns`` with some of them replaced or added."""
    kept = [f"{new[c]} AS {c}" if c in new else c for c in columns]
    added = [f"{expr} AS {c}" for c, expr in new.items() if c not in columns]
    return ", ".join([*kept, *added])


def ranked(source: str, keys: str, order: str) -> str:
    return f"ranked AS (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY {order}) AS pos FROM {source})"


BY_DATE = "CAST(admission_date AS DATE) DESC NULLS LAST"
BY_PASSED = f"CASE WHEN {CODE_BAD} THEN 0 WHEN {ANY_BAD} THEN 1 ELSE 2 END DESC"
BY_REST = ", ".join(f"{c} DESC NULLS LAST" for c in COLUMNS if c != "patient_id")
LATEST = f"{BY_DATE}, {BY_PASSED}, {BY_REST}"
RANKED = ranked("records", "patient_id", LATEST)
LATEST_ORDER = "o_orderdate DESC NULLS LAST, o_orderkey DESC NULLS LAST"
ORDERS = """orders_d AS (
  SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate, o_orderpriority
  FROM orders)"""
LINEITEM = "lines AS (SELECT * REPLACE (CAST(l_shipdate AS DATE) AS l_shipdate) FROM lineitem)"


def title(column: str) -> str:
    words = f"string_split(lower(trim({column})), ' ')"
    return f"array_to_string(list_transform({words}, lambda w: upper(w[1]) || w[2:]), ' ')"


DATES = {c: f"CAST({c} AS DATE)" for c in ("dob", "admission_date", "discharge_date")}
STAY = "CAST(date_diff('day', CAST(admission_date AS DATE), CAST(discharge_date AS DATE)) AS INT)"
TIDY_CODE = "upper(trim(icd10_code))"
NAMES = {c: title(c) for c in ("first_name", "last_name")}
STANDARD = replaced(COLUMNS, **DATES, icd10_code=TIDY_CODE, **NAMES, length_of_stay_days=STAY)
CLEAN = f"SELECT {STANDARD} FROM ranked WHERE pos = 1 AND NOT {CODE_BAD} AND NOT {ANY_BAD}"

STAGE = f"""CASE WHEN pos > 1 THEN '1_dedup' WHEN {CODE_BAD} THEN '2_icd10'
     WHEN {ANY_BAD} THEN '3_vitals' ELSE '4_kept' END"""
BROKEN = joined(f"CASE WHEN pos > 1 THEN 'superseded' END, CASE WHEN {CODE_BAD} THEN 'icd10_code' END, {LABELS}")
FLAGGED = f"flagged AS (SELECT {', '.join(COLUMNS)}, {STAGE} AS first_failed_stage, {BROKEN} AS failed_rules FROM ranked)"

PRIORITY_BAD = "(o_orderpriority IS NULL OR NOT regexp_matches(o_orderpriority, '^[1-4]-[A-Z ]+$'))"
PRICE_BAD = "coalesce(o_totalprice < 2000 OR o_totalprice > 400000, false)"
ORDERS_RANKED = ranked("orders_d", "o_custkey", LATEST_ORDER)
ORDER_COLUMNS = ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")


def funnel(ctes: str, second: str, third: str, bad_second: str, bad_third: str) -> str:
    return f"""WITH {ctes},
steps AS (
  SELECT CASE WHEN pos > 1 THEN 1 WHEN {bad_second} THEN 2 WHEN {bad_third} THEN 3 ELSE 4 END AS step FROM ranked),
names AS (SELECT * FROM (VALUES (1, '1_dedup'), (2, '2_{second}'), (3, '3_{third}'), (4, '4_kept')) t(step, stage)),
counts AS (
  SELECT stage, n.step, (SELECT count(*) FROM steps s WHERE s.step >= n.step) AS before,
         (SELECT count(*) FROM steps s WHERE s.step >= n.step AND (s.step > n.step OR n.step = 4)) AS after
  FROM names n)
SELECT stage, before, after, before - after AS removed FROM counts"""


def null_count_rows() -> str:
    return "\nUNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(*) - count({c}) AS n_null FROM records" for c in COLUMNS
    )


def range_counts(where: str = "") -> str:
    sums = ", ".join(
        f"count(*) FILTER (WHERE {bad(c)}) AS {counter}" for c, (_, counter, *_) in VITAL_BOUNDS.items()
    )
    return f"SELECT {sums} FROM records {where}"


def range_rows(where: str) -> str:
    return "\nUNION ALL ".join(
        f"SELECT '{counter}' AS field, count(*) AS n_out_of_range FROM records WHERE {where} AND {bad(c)}"
        for c, (_, counter, *_) in VITAL_BOUNDS.items()
    )


def scrambled(key: str, seed: int) -> str:
    return f"CAST('0x' || substr(md5(CAST({key} AS VARCHAR) || ':{seed}'), 1, 15) AS BIGINT)"


NUMBER = "CAST(substr(patient_id, 2) AS BIGINT)"
NULLED = ("icd10_code", "heart_rate_bpm", "systolic_bp_mmhg", "weight_kg")


def picked(every: int, seed: int) -> str:
    return f"{scrambled(NUMBER, seed)} % {every} = 0"


MOVED = {
    c: f"CASE WHEN NOT ({picked(127, 4)}) THEN {c} WHEN ({NUMBER} + {i}) % 2 = 0 THEN {lo - 2} ELSE {hi + 2} END"
    for i, (c, (_, _, lo, hi)) in enumerate(VITAL_BOUNDS.items())
}
MOVED = {c: f"CAST({e} AS {'INT' if c in ('diastolic_bp_mmhg', 'oxygen_sat_pct') else 'DOUBLE'})" for c, e in MOVED.items()}

# Text vitals: what is no number, or a fraction in a whole number, is bad; so is what is out of bounds.
WHOLE = ("diastolic_bp_mmhg", "oxygen_sat_pct")


def unreadable(column: str) -> str:
    number = f"TRY_CAST({column} AS DOUBLE)"
    fraction = f" OR {number} <> floor({number})" if column in WHOLE else ""
    return f"({column} IS NOT NULL AND ({number} IS NULL{fraction}))"


def text_bad(column: str) -> str:
    _, _, lo, hi = VITAL_BOUNDS[column]
    number = f"TRY_CAST({column} AS DOUBLE)"
    return f"({unreadable(column)} OR coalesce({number} < {lo} OR {number} > {hi}, false))"


TEXT_ANY_BAD = "(" + " OR ".join(text_bad(c) for c in VITAL_BOUNDS) + ")"
TEXT_LABELS = ", ".join(
    f"CASE WHEN {unreadable(c)} THEN '{label}: not_numeric' WHEN {text_bad(c)} THEN '{label}' END"
    for c, (label, *_) in VITAL_BOUNDS.items()
)
TEXT_RECORDS = (
    "texts AS (SELECT "
    + ", ".join(f"{TEXT_VITALS.get(c, c)} AS {c}" for c in COLUMNS)
    + f" FROM (SELECT *, {NUMBER} AS n FROM records))"
)
TEXT_PASSED = f"CASE WHEN {CODE_BAD} THEN 0 WHEN {TEXT_ANY_BAD} THEN 1 ELSE 2 END DESC"
TEXT_RANKED = ranked("texts", "patient_id", f"{BY_DATE}, {TEXT_PASSED}, {BY_REST}")
TEXT_NUMBERS = {c: f"CAST(CAST({c} AS DOUBLE) AS {'INT' if c in WHOLE else 'DOUBLE'})" for c in VITAL_BOUNDS}
TEXT_STANDARD = replaced(COLUMNS, **DATES, icd10_code=TIDY_CODE, **NAMES, **TEXT_NUMBERS, length_of_stay_days=STAY)
TEXT_STAGE = f"CASE WHEN pos > 1 THEN '1_dedup' WHEN {CODE_BAD} THEN '3_icd10' ELSE '4_vitals' END"
TEXT_BROKEN = joined(f"CASE WHEN pos > 1 THEN 'superseded' END, CASE WHEN {CODE_BAD} THEN 'icd10_code' END, {TEXT_LABELS}")

TIDIED = f"tidied AS (SELECT {replaced(COLUMNS, icd10_code=TIDY_CODE)} FROM records)"
TIDIED_RANKED = ranked("tidied", "patient_id", LATEST)
TIED = ranked(
    "orders_d",
    "o_orderstatus",
    f"CASE WHEN {PRIORITY_BAD} THEN 0 WHEN {PRICE_BAD} THEN 1 ELSE 2 END DESC, o_orderkey DESC NULLS LAST",
)
TIED_CLEAN = f"""WITH {ORDERS}, {TIED}
SELECT {replaced(ORDER_COLUMNS, o_orderpriority=title('o_orderpriority'))}
FROM ranked WHERE pos = 1 AND NOT {PRIORITY_BAD} AND NOT {PRICE_BAD}"""

KNOWN = "heart_rate_bpm IS NOT NULL"

ORACLES: dict[str, str] = {
    # sources and sinks
    "scan_csv": over_records(select="SELECT * FROM records"),
    "sink_csv": over_records(RANKED, select=CLEAN),
    "register_view": over_records(
        select="""SELECT primary_diagnosis, count(*) AS n_rows, count(DISTINCT patient_id) AS n_patients
FROM records GROUP BY primary_diagnosis"""
    ),
    # profiling
    "profile_row_count": over_records(select="SELECT count(*) AS n_rows FROM records"),
    "profile_column_count": over_records(
        select=f"SELECT count(*) AS n_rows, CAST({len(COLUMNS)} AS INT) AS n_columns FROM records"
    ),
    "profile_null_counts": over_records(select=null_count_rows()),
    "profile_null_rates": over_records(
        f"counts AS ({null_count_rows()})",
        select="""SELECT "column", n_null, n_null / (SELECT count(*) FROM records) AS null_rate
FROM counts WHERE n_null > 0""",
    ),
    "profile_duplicate_rows": over_records(
        select="SELECT count(*) - count(DISTINCT patient_id) AS duplicate_rows FROM records"
    ),
    "profile_invalid_format": over_records(
        select=f"SELECT count(*) AS n_invalid FROM records WHERE icd10_code IS NOT NULL AND NOT {CODE_OK}"
    ),
    "profile_out_of_range": over_records(select=range_counts(f"WHERE {KNOWN}")),
    "profile_out_of_range_unguarded": over_records(select=range_counts()),
    "profile_out_of_range_nonzero": over_records(
        f"counts AS ({range_rows(KNOWN)})", select="SELECT * FROM counts WHERE n_out_of_range > 0"
    ),
    "profile_year_distribution": over_records(
        select="""SELECT CAST(year(CAST(admission_date AS DATE)) AS INT) AS year, count(*) AS n_rows
FROM records GROUP BY 1 ORDER BY 1 NULLS FIRST"""
    ),
    "profile_report": over_records(
        f"nulls AS ({null_count_rows()})",
        f"ranges AS ({range_rows(KNOWN)})",
        "total AS (SELECT count(*) AS n FROM records)",
        f"""cells AS (
  SELECT 'shape' AS section, 'rows' AS metric, n AS value FROM total
  UNION ALL SELECT 'shape', 'columns', {len(COLUMNS)}
  UNION ALL SELECT 'null_count', "column", n_null FROM nulls WHERE n_null > 0
  UNION ALL SELECT 'null_rate', "column", n_null / (SELECT n FROM total) FROM nulls WHERE n_null > 0
  UNION ALL SELECT 'duplicates', 'patient_id', count(*) - count(DISTINCT patient_id) FROM records
  UNION ALL SELECT 'invalid_format', 'icd10_code', count(*) FROM records WHERE icd10_code IS NOT NULL AND NOT {CODE_OK}
  UNION ALL SELECT 'out_of_range', field, n_out_of_range FROM ranges WHERE n_out_of_range > 0
  UNION ALL SELECT 'rows_per_year', coalesce(CAST(year(CAST(admission_date AS DATE)) AS VARCHAR), 'unknown'), count(*)
            FROM records GROUP BY 2)""",
        select="SELECT section, metric, CAST(value AS DOUBLE) AS value FROM cells",
    ),
    # checks
    "detect_duplicates": over_records(
        select="""SELECT * FROM (
  SELECT patient_id, count(*) AS occurrence_count, min(CAST(admission_date AS DATE)) AS earliest_admission,
         max(CAST(admission_date AS DATE)) AS latest_admission
  FROM records GROUP BY patient_id)
WHERE occurrence_count > 1 ORDER BY occurrence_count DESC, patient_id"""
    ),
    "validate_code_format": over_records(
        select=f"""SELECT patient_id, icd10_code, if(icd10_code IS NULL, 'MISSING', 'INVALID_FORMAT') AS icd10_status
FROM records WHERE {CODE_BAD} ORDER BY icd10_status, patient_id"""
    ),
    "code_status_all": over_records(
        select=f"""SELECT if(icd10_code IS NULL, 'MISSING', if({CODE_OK}, 'VALID', 'INVALID_FORMAT')) AS icd10_status,
       count(*) AS n_rows FROM records GROUP BY 1"""
    ),
    "validate_ranges": over_records(
        select=f"""SELECT patient_id, {', '.join(VITAL_BOUNDS)}, {joined(LABELS)} AS flagged_fields
FROM records WHERE {ANY_BAD} ORDER BY patient_id"""
    ),
    # cleaning
    "dedup_latest": over_records(
        ranked("records", "patient_id", f"{BY_DATE}, {BY_REST}"),
        select=f"SELECT {', '.join(COLUMNS)} FROM ranked WHERE pos = 1",
    ),
    "drop_invalid_code": over_records(select=f"SELECT * FROM records WHERE NOT {CODE_BAD}"),
    "drop_out_of_range": over_records(select=f"SELECT * FROM records WHERE NOT {ANY_BAD}"),
    "standardize_dates": over_records(select=f"SELECT {replaced(COLUMNS, **DATES)} FROM records"),
    "length_of_stay": over_records(select=f"SELECT *, {STAY} AS length_of_stay_days FROM records"),
    "standardize_code": over_records(select=f"SELECT {replaced(COLUMNS, icd10_code=TIDY_CODE)} FROM records"),
    "standardize_names": over_records(select=f"SELECT {replaced(COLUMNS, **NAMES)} FROM records"),
    "standardize": over_records(select=f"SELECT {STANDARD} FROM records"),
    "clean_records": over_records(RANKED, select=CLEAN),
    "clean_records_normalize_first": over_records(TIDIED, TIDIED_RANKED, select=CLEAN),
    "clean_funnel_normalize_first": funnel(
        f"records AS ({RECORDS}), {TIDIED}, {TIDIED_RANKED}", "icd10", "vitals", CODE_BAD, ANY_BAD
    ),
    "rejected_rows_normalize_first": over_records(
        TIDIED, TIDIED_RANKED, FLAGGED, select="SELECT * FROM flagged WHERE first_failed_stage <> '4_kept'"
    ),
    "flagged_rows_normalize_first": over_records(TIDIED, TIDIED_RANKED, FLAGGED, select="SELECT * FROM flagged"),
    "clean_text_records": over_records(
        TEXT_RECORDS,
        TEXT_RANKED,
        select=f"SELECT {TEXT_STANDARD} FROM ranked WHERE pos = 1 AND NOT {CODE_BAD} AND NOT {TEXT_ANY_BAD}",
    ),
    "rejected_text_records": over_records(
        TEXT_RECORDS,
        TEXT_RANKED,
        select=f"""SELECT {', '.join(COLUMNS)}, {TEXT_STAGE} AS first_failed_stage, {TEXT_BROKEN} AS failed_rules
FROM ranked WHERE pos > 1 OR {CODE_BAD} OR {TEXT_ANY_BAD}""",
    ),
    "orders_tied_step_by_step": TIED_CLEAN,
    "orders_tied_clean": TIED_CLEAN,
    "clean_funnel": funnel(
        f"records AS ({RECORDS}), {RANKED}", "icd10", "vitals", CODE_BAD, ANY_BAD
    ),
    "rejected_rows": over_records(RANKED, FLAGGED, select="SELECT * FROM flagged WHERE first_failed_stage <> '4_kept'"),
    "flagged_rows": over_records(RANKED, FLAGGED, select="SELECT * FROM flagged"),
    # defect injection
    "inject_duplicates": f"""WITH {ORDERS}
SELECT * FROM orders_d
UNION ALL SELECT * FROM orders_d WHERE {scrambled('o_orderkey', 1)} % 64 = 0""",
    "inject_nulls": over_records(
        select="SELECT "
        + replaced(
            COLUMNS,
            **{c: f"CASE WHEN {picked(170, 2)} AND {NUMBER} % 4 = {i} THEN NULL ELSE {c} END" for i, c in enumerate(NULLED)},
        )
        + " FROM records"
    ),
    "inject_invalid_codes": over_records(
        select="SELECT "
        + replaced(
            COLUMNS, icd10_code=f"CASE WHEN {picked(85, 3)} THEN ({list(BAD_CODES)})[{NUMBER} % 10 + 1] ELSE icd10_code END"
        )
        + " FROM records"
    ),
    "inject_out_of_range": over_records(select=f"SELECT {replaced(COLUMNS, **MOVED)} FROM records"),
    "inject_out_of_range_decimal": f"""WITH {ORDERS}
SELECT * REPLACE (CASE WHEN {scrambled('o_orderkey', 7)} % 50 = 0 THEN CASE WHEN o_custkey % 2 = 0 THEN 1999.99 ELSE 400000.01 END
                       ELSE CAST(CAST(o_totalprice AS DECIMAL(12, 2)) AS DOUBLE) END::DOUBLE AS o_totalprice)
FROM orders_d""",
    "select_k_rows": f"""WITH {ORDERS}
SELECT * FROM orders_d ORDER BY {scrambled('o_orderkey', 5)}, o_orderkey LIMIT 800""",
    "select_k_rows_by_threshold": f"""WITH {ORDERS}
SELECT * FROM orders_d ORDER BY {scrambled('o_orderkey', 6)}, o_orderkey LIMIT 7000""",
    # the same operators with other rules
    "orders_latest_per_customer": f"""WITH {ORDERS}, {ORDERS_RANKED}
SELECT {', '.join(ORDER_COLUMNS)} FROM ranked WHERE pos = 1""",
    "orders_clean": f"""WITH {ORDERS}, {ORDERS_RANKED}
SELECT {replaced(ORDER_COLUMNS, o_orderpriority=title('o_orderpriority'))}
FROM ranked WHERE pos = 1 AND NOT {PRIORITY_BAD} AND NOT {PRICE_BAD}""",
    "orders_funnel": funnel(f"{ORDERS}, {ORDERS_RANKED}", "priority", "price", PRIORITY_BAD, PRICE_BAD),
    "orders_rejected": f"""WITH {ORDERS}, {ORDERS_RANKED}
SELECT {', '.join(ORDER_COLUMNS)},
       CASE WHEN pos > 1 THEN '1_dedup' WHEN {PRIORITY_BAD} THEN '2_priority' ELSE '3_price' END AS first_failed_stage,
       {joined(f"CASE WHEN pos > 1 THEN 'superseded' END, CASE WHEN {PRIORITY_BAD} THEN 'priority' END, CASE WHEN {PRICE_BAD} THEN 'price' END")} AS failed_rules
FROM ranked WHERE pos > 1 OR {PRIORITY_BAD} OR {PRICE_BAD}""",
    "orders_profile_report": f"""WITH {ORDERS}
SELECT section, metric, CAST(value AS DOUBLE) AS value FROM (
  SELECT 'shape' AS section, 'rows' AS metric, count(*) AS value FROM orders_d
  UNION ALL SELECT 'shape', 'columns', 6
  UNION ALL SELECT 'duplicates', 'o_custkey', count(*) - count(DISTINCT o_custkey) FROM orders_d
  UNION ALL SELECT 'invalid_format', 'o_orderpriority', count(*) FROM orders_d
            WHERE o_orderpriority IS NOT NULL AND {PRIORITY_BAD}
  UNION ALL SELECT 'out_of_range', 'bad_price', count(*) FROM orders_d WHERE {PRICE_BAD} HAVING count(*) > 0
  UNION ALL SELECT 'rows_per_year', CAST(year(o_orderdate) AS VARCHAR), count(*) FROM orders_d GROUP BY 2)""",
    "lineitem_duplicate_rows": """SELECT count(*) - (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem))
       AS duplicate_rows FROM lineitem""",
    "lineitem_duplicate_keys": f"""WITH {LINEITEM}
SELECT l_orderkey, l_linenumber, count(*) AS occurrence_count, min(l_shipdate) AS earliest, max(l_shipdate) AS latest
FROM lines GROUP BY ALL HAVING count(*) > 1 ORDER BY occurrence_count DESC, l_orderkey, l_linenumber""",
    "lineitem_dedup_latest": f"""WITH {LINEITEM}, {ranked('lines', 'l_orderkey, l_linenumber',
    'l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC, l_extendedprice DESC, l_discount DESC, l_tax DESC, l_returnflag DESC, l_linestatus DESC')}
SELECT * EXCLUDE (pos) FROM ranked WHERE pos = 1""",
    "documents_duplicate_texts": "SELECT count(*) - count(DISTINCT text) AS duplicate_rows FROM documents",
    "events_out_of_range": """SELECT event_id, value, 'value' AS flagged_fields FROM events
WHERE value < 1 OR value > 400 ORDER BY event_id""",
    "events_year_distribution": "SELECT CAST(year(ts) AS INT) AS year, count(*) AS n_rows FROM events GROUP BY 1",
    "customer_name_status": """SELECT if(c_name IS NULL, 'MISSING',
    if(regexp_matches(c_name, '^Customer#[0-9]{9}$'), 'VALID', 'INVALID_FORMAT')) AS status, count(*) AS n_rows
FROM customer GROUP BY 1""",
}
