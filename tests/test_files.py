import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from debtloom.sources.files import SchemaAlarm, csv_table, describe_headers, document_status, find_header, inbox, json_map, json_rows, pick_sheet, sheets_of, write_state, xlsx_table
from debtloom.sources.workbook import write_workbook
from debtloom.streaming.incremental import StateTable, file_feed, first_seen, run_feed, windowed_counts

ALIASES = {"company name": "company_name", "acn": "acn", "policy name": "company_name"}


def test_json(spark, tmp_path):
    schema = T.StructType([T.StructField("a", T.StringType()), T.StructField("n", T.IntegerType())])
    assert json_rows(spark, str(tmp_path / "none.json"), schema).count() == 0
    (tmp_path / "m.json").write_text(json.dumps({"k1": {"a": "x", "n": 1}, "k2": {"a": None}}))
    assert sorted(map(tuple, json_map(spark, str(tmp_path / "m.json"), "key", schema).collect())) == [("k1", "x", 1), ("k2", None, None)]
    assert json_map(spark, str(tmp_path / "no.json"), "key", schema).count() == 0
    write_state(spark.createDataFrame([("x", 1)], schema), str(tmp_path / "s"))
    write_state(json_rows(spark, str(tmp_path / "s"), schema).unionByName(spark.createDataFrame([("y", 2)], schema)), str(tmp_path / "s"))
    assert json_rows(spark, str(tmp_path / "s"), schema).count() == 2


def test_broken_records_are_not_lost(spark, tmp_path):
    schema = T.StructType([T.StructField("a", T.StringType())])
    (tmp_path / "b.json").write_text('[{"a": "x"}, {"a": ')
    with pytest.raises(Exception):
        json_rows(spark, str(tmp_path / "b.json"), schema).collect()
    assert any(r.broken for r in json_rows(spark, str(tmp_path / "b.json"), schema, "broken").collect())
    assert json_rows(spark, str(tmp_path / "no.json"), schema, "broken").columns == ["a", "broken"]


def test_name_columns_of_a_policy_list(spark, tmp_path):
    from debtloom.sources.files import name_columns, policy_names

    assert name_columns(["Policy_Name", "Contact name", "client name"]) == [0, 2] and name_columns(["Name of insured name", "Contact name", None]) == [0] and name_columns(["x"]) == []
    (tmp_path / "p.csv").write_text("List of May,,\nPolicy Name,Client Name,Contact Name\nLarkspur,Finch,Ada\n , Mallow ,\n", encoding="utf-8")
    assert sorted(r[0] for r in policy_names(spark, str(tmp_path / "p.csv")).collect()) == ["Finch", "Larkspur", "Mallow"]
    (tmp_path / "q.csv").write_text("a,b\n1,2\n")
    with pytest.raises(SchemaAlarm):
        policy_names(spark, str(tmp_path / "q.csv"))


def test_settings(tmp_path, monkeypatch):
    from debtloom.sources import config

    (tmp_path / "r.yml").write_text("tax:\n  reason: Office\n  patterns: [agl, '^state\\b']\nnone: {}\n")
    assert config.rules(config.load(str(tmp_path / "r.yml"))) == [(r"\bagl\b", "tax", "Office"), (r"^state\b", "tax", "Office")]
    monkeypatch.setenv("DEBTLOOM_X", " ")
    assert config.secret("DEBTLOOM_X") is None
    with pytest.raises(KeyError):
        config.secret("DEBTLOOM_X", required=True)


def test_long_tables_go_on_in_further_sheets(spark, tmp_path, monkeypatch):
    from debtloom.sources import workbook

    monkeypatch.setattr(workbook, "SHEET_ROWS", 4)
    assert write_workbook(str(tmp_path / "l.xlsx"), {"Long": spark.range(7).toDF("n"), "Short": spark.range(1).toDF("n")}) == {"Long": 7, "Short": 1}
    book = sheets_of((tmp_path / "l.xlsx").read_bytes())
    assert {n: [r[0] for r in rows[1:]] for n, rows in book.items()} == {"Long": ["0", "1", "2"], "Long (2)": ["3", "4", "5"], "Long (3)": ["6"], "Short": ["0"]}


def test_csv_with_a_title(spark, tmp_path):
    (tmp_path / "p.csv").write_text("﻿List of policies,,\nPolicy Name,ACN,Phone\nLarkspur,1,555\nFinch,2,556\n", encoding="utf-8")
    assert sorted(map(tuple, csv_table(spark, str(tmp_path / "p.csv"), ALIASES, "company_name").collect())) == [("Finch", "2"), ("Larkspur", "1")]
    with pytest.raises(SchemaAlarm):
        find_header([["a", "b"]], ALIASES, "company_name")


def test_workbook_round_trip(spark, tmp_path):
    rows = spark.createDataFrame([("Larkspur & Co", 5, True), (None, None, False)], "`Company Name` string, ACN int, flag boolean")
    assert write_workbook(str(tmp_path / "b.xlsx"), {"Notes": rows.limit(0), "Data": rows}) == {"Notes": 0, "Data": 2}
    assert list(sheets_of((tmp_path / "b.xlsx").read_bytes())) == ["Notes", "Data"]
    got = xlsx_table(spark, str(tmp_path), ALIASES, "company_name").select("company_name", "acn").collect()
    assert [tuple(r) for r in got] == [("Larkspur & Co", "5")]
    assert pick_sheet(["x", "My Data"], ["a"]) == "My Data"
    with pytest.raises(SchemaAlarm):
        pick_sheet(["x"], ["a"])
    assert {(r.heading, r.field) for r in describe_headers(rows, ALIASES).collect()} == {("Company Name", "company_name"), ("ACN", "acn"), ("flag", None)}


def test_inbox_and_status(spark, tmp_path):
    (tmp_path / "m1__a.pdf").write_bytes(b"x")
    (tmp_path / "m2.pdf").write_bytes(b"")
    assert sorted((r.matter_id, r.status) for r in inbox(spark, str(tmp_path)).collect()) == [("m1", "present"), ("m2", "missing")]
    pages = spark.createDataFrame([("a", "", False, 0), ("b", "t", False, 0), ("c", "t", True, 0), ("d", "t", True, 2), ("d", None, None, None)], "doc string, text string, l boolean, n int")
    assert sorted(map(tuple, document_status(pages, "doc", "text", "l", "n").collect())) == [("a", "scanned", 0), ("b", "no-section", 0), ("c", "table-unreadable", 0), ("d", "ok", 2)]


def test_feed_into_state(spark, tmp_path):
    schema = T.StructType([T.StructField("k", T.StringType()), T.StructField("v", T.StringType()), T.StructField("t", T.TimestampType())])
    kept = T.StructType([T.StructField("k", T.StringType()), T.StructField("v", T.StringType()), T.StructField("last_seen", T.StringType())])
    feed, state = str(tmp_path / "feed"), StateTable(spark, str(tmp_path / "state"), kept, "k")

    def land(rows):
        spark.createDataFrame(rows, "k string, v string, t string").withColumn("t", F.col("t").cast("timestamp")).write.mode("append").parquet(feed)

    land([("a", "", "2026-01-01 00:00:00"), ("b", "x", "2026-01-01 00:10:00")])
    run_feed(file_feed(spark, feed, schema), state, str(tmp_path / "c1"), "t", "d1")
    land([("a", "late", "2026-01-01 00:20:00"), ("b", "y", "2026-01-01 00:20:00"), (None, "z", "2026-01-01 00:20:00")])
    run_feed(file_feed(spark, feed, schema), state, str(tmp_path / "c1"), "t", "d2")
    run_feed(file_feed(spark, feed, schema), state, str(tmp_path / "c1"), "t", "d3")  # nothing new has come
    assert sorted(map(tuple, state.read().collect())) == [("a", "late", "d2"), ("b", "x", "d2")]

    counts = windowed_counts(file_feed(spark, feed, schema), "t", "15 minutes", "1 hour", "k").writeStream.format("memory").queryName("counts").outputMode("complete").trigger(availableNow=True).start()
    counts.awaitTermination()
    assert spark.table("counts").agg(F.sum("n")).first()[0] == 5
    once = first_seen(file_feed(spark, feed, schema).where("k is not null"), "k", "t", "1 hour").writeStream.format("memory").queryName("once").trigger(availableNow=True).start()
    once.awaitTermination()
    assert spark.table("once").count() == 2
