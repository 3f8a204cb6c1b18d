"""Queries of problem 1: what changed between full snapshots of the matter list."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from debtloom.functions.canon import acn_canon, date_or_text, type_canon
from debtloom.operators.snapshots import snapshot_changes
from debtloom.session import table


def matter_changes(snapshots: DataFrame) -> DataFrame:
    """Changes of ``acn``, ``appointment_date`` and ``appointment_type`` between deliveries, by meaning only."""
    return snapshot_changes(
        snapshots,
        "matter_id",
        "snapshot_no",
        {
            "acn": acn_canon(F.col("acn")),
            "appointment_date": date_or_text(F.col("appointment_date")),
            "appointment_type": type_canon(F.col("appointment_type")),
        },
        prefer=[F.col("loaded_at")],
    )


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matter_changes(table(spark, sf_dir, "matter_snapshot")).select("snapshot_no", "matter_id", "change_kind")


def p1_change_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changes by snapshot, kind and column."""
    found = matter_changes(table(spark, sf_dir, "matter_snapshot"))
    return (
        found.select("snapshot_no", "change_kind", F.explode_outer("changed_columns").alias("column_name"))
        .groupBy("snapshot_no", "change_kind", F.coalesce("column_name", F.lit("")).alias("column_name"))
        .agg(F.count("*").alias("n_changes"))
    )


_SPACES = r"[\s\x{00a0}\x{1680}\x{2000}-\x{200b}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}\x{feff}]+"
_SQL = f"""
WITH said AS (
  SELECT snapshot_no, matter_id, loaded_at,
         nullif(regexp_replace(coalesce(acn, ''), '[^0-9]', '', 'g'), '') AS d,
         trim(regexp_replace(coalesce(appointment_date, ''), '{_SPACES}', ' ', 'g')) AS a,
         nullif(regexp_replace(lower(appointment_type), '{_SPACES}|[''’‘ʼ′`´＇]', '', 'g'), '') AS t
  FROM matter_snapshot WHERE matter_id IS NOT NULL AND snapshot_no IS NOT NULL),
canon AS (
  SELECT snapshot_no, matter_id, loaded_at, CASE WHEN length(d) <= 9 THEN lpad(d, 9, '0') ELSE d END AS acn, t,
         coalesce(CAST(CASE WHEN regexp_matches(a, '^\\d{{4}}-\\d{{1,2}}-\\d{{1,2}}') THEN try_cast(regexp_extract(a, '^\\d{{4}}-\\d{{1,2}}-\\d{{1,2}}') AS DATE)
              WHEN regexp_matches(a, '^\\d{{1,2}}[-/.]\\d{{1,2}}[-/.]\\d{{4}}') THEN try_strptime(replace(replace(a, '-', '/'), '.', '/'), '%d/%m/%Y')::DATE
              ELSE try_strptime(a, '%d %b %Y')::DATE END AS VARCHAR), nullif(lower(a), '')) AS d
  FROM said),
one AS (
  SELECT snapshot_no, matter_id, acn, d, t FROM canon
  QUALIFY row_number() OVER (PARTITION BY snapshot_no, matter_id ORDER BY loaded_at DESC NULLS LAST, acn DESC NULLS LAST, d DESC NULLS LAST, t DESC NULLS LAST) = 1),
deliveries AS (SELECT snapshot_no, lead(snapshot_no) OVER (ORDER BY snapshot_no) AS later FROM (SELECT DISTINCT snapshot_no FROM one)),
olds AS (SELECT o.*, later FROM one o JOIN deliveries USING (snapshot_no) WHERE later IS NOT NULL),
news AS (SELECT * FROM one WHERE snapshot_no > (SELECT min(snapshot_no) FROM one)),
merged AS (
  SELECT coalesce(n.snapshot_no, o.later) AS snapshot_no, coalesce(n.matter_id, o.matter_id) AS matter_id,
         o.matter_id IS NULL AS came, n.matter_id IS NULL AS went,
         o.acn IS DISTINCT FROM n.acn AS c1, o.d IS DISTINCT FROM n.d AS c2, o.t IS DISTINCT FROM n.t AS c3
  FROM olds o FULL OUTER JOIN news n ON n.snapshot_no = o.later AND n.matter_id = o.matter_id),
kinds AS (
  SELECT snapshot_no, matter_id, CASE WHEN came THEN 'added' WHEN went THEN 'removed' WHEN c1 OR c2 OR c3 THEN 'changed' END AS change_kind, c1, c2, c3
  FROM merged)
"""


def queries() -> dict:
    return {"p1_found": p1_found, "p1_change_report": p1_change_report}


def oracle_sql() -> dict[str, str]:
    return {
        "p1_found": _SQL + "SELECT snapshot_no, matter_id, change_kind FROM kinds WHERE change_kind IS NOT NULL",
        "p1_change_report": _SQL
        + """SELECT snapshot_no, change_kind, column_name, count(*) AS n_changes FROM (
  SELECT snapshot_no, change_kind, '' AS column_name FROM kinds WHERE change_kind IN ('added', 'removed')
  UNION ALL SELECT snapshot_no, change_kind, 'acn' FROM kinds WHERE change_kind = 'changed' AND c1
  UNION ALL SELECT snapshot_no, change_kind, 'appointment_date' FROM kinds WHERE change_kind = 'changed' AND c2
  UNION ALL SELECT snapshot_no, change_kind, 'appointment_type' FROM kinds WHERE change_kind = 'changed' AND c3)
GROUP BY ALL""",
    }
