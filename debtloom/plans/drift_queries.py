"""Queries of problem 5: schemas of the appointment files that drift over time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from debtloom.functions.canon import acn_canon, date_canon, present
from debtloom.operators.schema_drift import column_profiles, schema_changes, unified_table
from debtloom.session import table


def _date(c: Column) -> Column:
    """A date; five digits are days of a spreadsheet, counted from 1899-12-30."""
    return F.when(c.rlike(r"^\d{5}$"), F.date_add(F.lit("1899-12-30").cast("date"), F.when(c.rlike(r"^\d{5}$"), c).cast("int"))).otherwise(date_canon(c))


FIELDS = {
    "company_name": present, "acn": acn_canon, "appointment_type": present, "appointment_date": _date, "practitioner": present, "industry": present,
    "state": present, "postcode": lambda c: F.lpad(F.nullif(F.regexp_replace(c, "[^0-9]", ""), F.lit("")), 4, "0"), "first_appointment": lambda c: F.lower(present(c)).isin("1", "1.0", "y", "yes", "true"),
    "period": lambda c: F.nullif(F.regexp_replace(c, "[^0-9]", ""), F.lit("")), "employees": lambda c: c.try_cast("int"), "court": present, "remarks": present,
}


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = schema_changes(table(spark, sf_dir, "sheet_record"), "feed_id", "file_no", ["file_date"], "payload")
    return found.select("file_no", "column_name", "change_kind").distinct()


def p5_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The schema of each file."""
    return column_profiles(table(spark, sf_dir, "sheet_record"), "file_no", "payload").select("file_no", "fold", "shown", "json_type", "n_rows", "n_values")


def p5_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row of every file in one consistent matter table."""
    return unified_table(table(spark, sf_dir, "sheet_record"), ["file_no", "row_no"], "file_no", "payload", FIELDS)


def queries() -> dict:
    return {"p5_found": p5_found, "p5_columns": p5_columns, "p5_table": p5_table}


def oracle_sql() -> dict[str, str]:
    return {
        "p5_columns": r"""
WITH c AS (
  SELECT file_no, j.key AS k, regexp_replace(lower(j.key), '[\s_\x{00a0}]+', '', 'g') AS fold,
         CASE j.type WHEN 'VARCHAR' THEN 'string' WHEN 'BOOLEAN' THEN 'boolean' WHEN 'OBJECT' THEN 'object' WHEN 'ARRAY' THEN 'array' WHEN 'NULL' THEN NULL ELSE 'number' END AS kind
  FROM sheet_record, json_each(payload) AS j),
shown AS (SELECT file_no, fold, arg_min(k, (-n, k)) AS shown FROM (SELECT file_no, fold, k, count(*) AS n FROM c GROUP BY ALL) GROUP BY ALL),
types AS (SELECT file_no, fold, arg_min(kind, (-n, kind)) AS json_type FROM (SELECT file_no, fold, kind, count(*) AS n FROM c WHERE kind IS NOT NULL GROUP BY ALL) GROUP BY ALL),
n AS (SELECT file_no, fold, count(*) AS n_rows, count(kind) AS n_values FROM c GROUP BY ALL)
SELECT file_no, fold, shown, json_type, n_rows, n_values FROM n JOIN shown USING (file_no, fold) LEFT JOIN types USING (file_no, fold)"""
    }
