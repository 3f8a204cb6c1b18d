import datetime as dt
import json

from pyspark.sql import functions as F

from debtloom.operators.schema_drift import column_profiles, schema_changes, unified_table

SCHEMA = "file_no bigint, feed_id string, file_date string, row_no int, payload string"


def files(*contents):
    return [(n, "f", f"2026-01-{n:02d}", i, p if isinstance(p, str) or p is None else json.dumps(p)) for n, rows in enumerate(contents, 1) for i, p in enumerate(rows)]


def found(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    return {(r.file_no, r.column_name, r.change_kind) for r in schema_changes(df, "feed_id", "file_no", ["file_date"], "payload").collect()}


NAMES = ["Larkspur Timber Pty Ltd", "Finch Foods Pty Ltd", "Mallow Steel Pty Ltd", "Sorrel Glass Pty Ltd"]


def test_kinds(spark):
    one = [{"company_name": n, "acn": str(100000000 + i), "n": i} for i, n in enumerate(NAMES)]
    two = [{"COMPANY NAME": n, "acn": str(200000000 + i), "n": i, "court": "FC 1/2026"} for i, n in enumerate(NAMES)]
    three = [{"debtor": n, "acn": 300000000 + i, "n": i} for i, n in enumerate(NAMES)]
    assert found(spark, files(one, two, three)) == {(2, "court", "added"), (3, "court", "removed"), (3, "debtor", "renamed"), (3, "acn", "retyped")}


def test_order_nulls_and_stray_values(spark):
    a = [{"x": "1", "y": None}, {"x": "2"}, {"x": 3}]
    b = [{"x": "4", "y": 5}]
    assert found(spark, files(a, b)) == set()  # most of x are strings; y had no type before
    assert found(spark, []) == set()
    assert found(spark, [(None, "f", "d", 1, "{}"), (1, None, "d", 1, '{"a": 1}'), (2, "f", "d", 1, "no json"), (3, "f", "e", 1, None)]) == set()


def test_profiles(spark):
    df = spark.createDataFrame(files([{"Ab c": 1}, {"ab_c": "x"}, {"Ab c": "y"}, {"k": {"a": [1]}}]), SCHEMA)
    got = {r.fold: (r.shown, r.json_type, r.n_rows) for r in column_profiles(df, "file_no", "payload").collect()}
    assert got == {"abc": ("Ab c", "string", 3), "k": ("k", "object", 1)}


def test_one_table(spark):
    one = [{"company_name": n, "date": "2026-02-01"} for n in NAMES]
    two = [{"Company Name": [n], "date": {"y": 2026, "m": 2, "d": 1}} for n in NAMES]
    df = spark.createDataFrame(files(one, two), SCHEMA)
    got = unified_table(df, ["file_no", "row_no"], "file_no", "payload", {"company_name": F.trim, "date": lambda c: c.try_cast("date")}).collect()
    assert sorted((r.file_no, r.company_name, r.date) for r in got) == sorted((n, x, dt.date(2026, 2, 1)) for n in (1, 2) for x in NAMES)
