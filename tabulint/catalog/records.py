"""The admissions table of the checks, derived from the whole ``orders`` table by one SQL text.

The text runs unchanged in Spark and in the oracle, but for the keys: Spark makes exact copies and
later versions of rows in one scan, the oracle by a union.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tabulint.sources.tables import read_table

RECORDS_SQL = r"""
WITH k AS ({keys})
SELECT
  'P' || lpad(CAST(i + 1 AS STRING), 7, '0') AS patient_id,
  CASE WHEN i % 4 = 0 THEN '  mary ' WHEN i % 4 = 1 THEN 'JOHN' WHEN i % 4 = 2 THEN 'linda ann' ELSE 'Thomas' END AS first_name,
  CASE WHEN c % 3 = 0 THEN 'smith ' WHEN c % 3 = 1 THEN 'O''NEIL-Jones' ELSE 'Garcia' END AS last_name,
  CAST(DATE '1930-01-01' + CAST((c * 37) % 27000 AS INT) AS STRING) AS dob,
  CAST(adm AS STRING) AS admission_date,
  CAST(adm + CAST(1 + i % 30 AS INT) AS STRING) AS discharge_date,
  CASE WHEN copy_no = 1 AND i % 128 = 73 THEN 'ABCDE'
       WHEN i % 340 = 5 THEN NULL
       WHEN i % 85 = 3 AND i % 2 = 0 THEN 'Z999999'
       WHEN i % 85 = 3 THEN 'A0B'
       WHEN i % 85 = 4 THEN ' a00'
       WHEN i % 2 = 0 THEN 'E11'
       ELSE 'C34.' || CAST(i % 10 AS STRING) || chr(CAST(65 + i % 26 AS INT)) END AS icd10_code,
  'Diagnosis ' || CAST(i % 24 AS STRING) AS primary_diagnosis,
  CASE WHEN i % 400 = 11 THEN NULL WHEN i % 127 = 13 THEN 250.0E0 ELSE CAST(45 + i % 136 AS DOUBLE) END AS heart_rate_bpm,
  CASE WHEN i % 400 = 12 THEN NULL WHEN i % 127 IN (13, 14) THEN 30.0E0 ELSE CAST(80 + i % 111 AS DOUBLE) END AS systolic_bp_mmhg,
  CAST(CASE WHEN i % 127 = 13 THEN 150 ELSE 45 + i % 76 END AS INT) AS diastolic_bp_mmhg,
  CASE WHEN i % 127 = 15 THEN 43.5E0 ELSE CAST(36 + i % 4 AS DOUBLE) END AS temp_celsius,
  CAST(CASE WHEN i % 127 = 16 THEN 50 WHEN i % 127 = 17 THEN 101 ELSE 88 + i % 13 END AS INT) AS oxygen_sat_pct,
  CASE WHEN i % 400 IN (11, 13) THEN NULL WHEN i % 400 = 14 THEN 2.0E0 ELSE CAST(40 + i % 121 AS DOUBLE) END AS weight_kg
FROM k
"""


KEYS_BY_UNION = """
  SELECT o_orderkey AS i, CAST(o_orderdate AS DATE) AS adm, o_custkey AS c, 0 AS copy_no FROM orders
  UNION ALL
  SELECT o_orderkey, CAST(o_orderdate AS DATE), o_custkey, 0 FROM orders WHERE o_orderkey % 64 = 7
  UNION ALL
  SELECT o_orderkey, CAST(o_orderdate AS DATE) + 45, o_custkey, 1 FROM orders WHERE o_orderkey % 64 = 9
"""
KEYS_IN_ONE_SCAN = """
  SELECT i, date_add(day, 45 * copy_no) AS adm, c, copy_no FROM (
    SELECT o_orderkey AS i, CAST(o_orderdate AS DATE) AS day, o_custkey AS c,
           explode(CASE o_orderkey % 64 WHEN 7 THEN array(0, 0) WHEN 9 THEN array(0, 1) ELSE array(0) END) AS copy_no
    FROM {orders})
"""


# Vitals as a CSV file may hold them: no number, a fraction's dot in a whole number, out of range, nothing.
TEXT_VITALS = {
    "heart_rate_bpm": "CASE WHEN n % 211 = 5 THEN 'fast' ELSE CAST(heart_rate_bpm AS STRING) END",
    "systolic_bp_mmhg": "CAST(systolic_bp_mmhg AS STRING)",
    "diastolic_bp_mmhg": "CASE WHEN n % 211 = 6 THEN '200.0' WHEN n % 3 = 0 THEN CAST(CAST(diastolic_bp_mmhg AS DOUBLE) AS STRING) "
    "ELSE CAST(diastolic_bp_mmhg AS STRING) END",
    "temp_celsius": "CAST(temp_celsius AS STRING)",
    "oxygen_sat_pct": "CASE WHEN n % 211 = 7 THEN '130.0' WHEN n % 211 = 8 THEN NULL WHEN n % 211 = 9 THEN '97.5' "
    "ELSE CAST(oxygen_sat_pct AS STRING) END",
    "weight_kg": "CAST(weight_kg AS STRING)",
}


def text_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The admissions with all vitals as text, some of them unreadable or written as fractions."""
    numbered = records(spark, sf_dir).selectExpr("*", "CAST(substr(patient_id, 2) AS BIGINT) AS n")
    return numbered.selectExpr(*[f"{TEXT_VITALS.get(c, c)} AS {c}" for c in numbered.columns if c != "n"])


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The admissions table of one data folder."""
    return spark.sql(RECORDS_SQL.replace("{keys}", KEYS_IN_ONE_SCAN), orders=read_table(spark, f"{sf_dir}/orders.parquet"))
