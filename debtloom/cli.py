"""Commands over landed tables: collect, watch, ingest, report, run, schema, probe."""

from __future__ import annotations

import argparse
import datetime as dt
import json
import os
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from debtloom.functions.canon import date_canon
from debtloom.functions.listing import is_listing, listing_rows, page_counts
from debtloom.functions.markup import link_targets, title
from debtloom.functions.text import matter_key
from debtloom.operators.desk import CONCLUSIVE
from debtloom.operators.name_match import key_list
from debtloom.operators.rollup import admissible, qualify, roll_up, scored
from debtloom.operators.state import first_by, merge_state, open_rows, replace_by_key
from debtloom.session import settle, table
from debtloom.sources import config
from debtloom.sources.files import describe_headers, document_status
from debtloom.sources.workbook import write_workbook

MATTER = ("source", "company_name", "acn", "appointment_type", "appointment_date", "practitioner", "industry", "state", "postcode")


def collect(spark: SparkSession, tables: str, sources: list[str] | None, as_of: str) -> DataFrame:
    """Notices of the wanted sources merged into the known matters."""
    known = first_by(table(spark, tables, "matter").where("matter_id is not null").select("matter_id", *MATTER, "last_seen", "matter_row"), ["matter_id"], [F.col("matter_row")]).drop("matter_row")
    found = table(spark, tables, "matter_batch")
    if sources:
        found = found.where(F.col("source").isin(*sources))
    keyed = found.withColumn("industry", F.lit(None).cast("string")).withColumn("matter_id", matter_key(F.col("source"), F.col("acn"), F.col("company_name")))
    return merge_state(known, first_by(keyed.select("matter_id", *MATTER, "arrival_id"), ["matter_id"], [F.col("arrival_id")]).drop("arrival_id"), "matter_id", F.lit(as_of))


def watch(spark: SparkSession, tables: str, as_of: str, limit: int) -> DataFrame:
    """The open matters to look at next: the longest unchecked first."""
    m = open_rows(table(spark, tables, "matter"), "creditors_captured", date_canon(F.col("first_seen")), F.lit(as_of).cast("date"), 120, "document_status", ("no-section", "scanned"))
    return m.orderBy(F.coalesce("last_checked", F.lit("")), F.desc_nulls_first("first_seen"), "matter_row").limit(limit)


def ingest(spark: SparkSession, tables: str, pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Creditor rows of landed pages (``matter_id, page, text``) in place of those of the same matters, and the status of each document."""
    text = F.coalesce("text", F.lit(""))
    gate = pages.select("matter_id", "page", "text", is_listing(page_counts(text)).alias("is_listing"))
    rows = settle(listing_rows(gate.select(F.to_json(F.struct("matter_id", "page")).alias("id"), "text"), "id", "text").withColumn("matter_id", F.get_json_object("id", "$.matter_id")), "ingested")
    per = rows.groupBy("id").agg(F.count("*").alias("n"))
    status = document_status(gate.withColumn("id", F.to_json(F.struct("matter_id", "page"))).join(per, "id", "left"), "matter_id", "text", "is_listing", "n")
    read_again = status.where(F.col("status").isin(*CONCLUSIVE)).select("matter_id")
    new = rows.select("matter_id", "creditor_name", "address", "related_party", "amount_aud", "amount_known")
    return replace_by_key(table(spark, tables, "creditor"), new, "matter_id", read_again), status


def report(spark: SparkSession, tables: str, floor: float, rules: list[tuple[str, str, str]] = (), policies: str | None = None) -> dict[str, DataFrame]:
    """The sheets of the report, by name. ``policies`` is a parquet table of the policy list; without it clients are not told apart."""
    listed = key_list(spark.read.parquet(policies).withColumn("policy_no", F.coalesce("policy_no", F.lit(""))), ["policy_name", "client_name"], ["policy_no"]) if policies else None
    prospects = scored(roll_up(admissible(table(spark, tables, "creditor")), "creditor_id"))
    judged = settle(qualify(prospects, floor, rules, listed).withColumn("debtor_industries", F.array_join("debtor_industries", "; ")), "report")
    m = table(spark, tables, "matter")
    due = F.coalesce("form_5604_lodged", F.lit(False)) & ~F.coalesce("creditors_captured", F.lit(False)) if "form_5604_lodged" in m.columns else F.lit(False)
    order = [F.desc("score"), F.desc("total_exposure_aud"), F.asc("name_key")]
    return {
        "Prospects": judged.where("qualified").orderBy(*order), "Repeat Exposure": judged.where("qualified and matter_count > 1").orderBy(*order),
        "Purchase Queue": m.where(due).select("matter_id", "company_name", "acn", "appointment_type").orderBy("matter_id"),
        "Excluded": judged.where("not qualified").select("display_name", "total_exposure_aud", "matter_count", "disqualified_reason").orderBy("disqualified_reason", "display_name"),
        "Matters": m.orderBy(F.coalesce("company_name", F.lit("")), "matter_row").select("matter_id", "company_name", "acn", "appointment_type"),
    }


def due(marker: str, now: dt.datetime, weekday: int = 1, hour: int = 10) -> bool:
    """Whether the weekly run is due by a local clock and the day of the last run."""
    last = open(marker).read().strip() if os.path.exists(marker) else ""
    return now.isoweekday() == weekday and now.hour >= hour and last != now.date().isoformat()


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="debtloom")
    p.add_argument("command", choices=["collect", "watch", "ingest", "report", "run", "schema", "probe"])
    p.add_argument("--tables", required=True, help="folder of the parquet tables")
    p.add_argument("--sources", help="names of feeds, comma-separated")
    p.add_argument("--limit", type=int, default=150)
    p.add_argument("--inbox", help="parquet of landed pages: matter_id, page, text")
    p.add_argument("--out", help="where the result goes: a parquet folder, or a workbook for report")
    p.add_argument("--floor", type=float, default=5000.0)
    p.add_argument("--rules", help="YAML of rules against prospects: category, reason, patterns")
    p.add_argument("--policylist", help="parquet of the policy list")
    p.add_argument("-v", "--verbose", action="store_true")
    p.add_argument("--as-of", default=dt.date.today().isoformat())
    p.add_argument("--table", help="the table that schema or probe looks at")
    p.add_argument("--respect-schedule", action="store_true")
    a = p.parse_args(argv)
    spark = SparkSession.builder.appName("debtloom").getOrCreate()
    if a.verbose:
        spark.sparkContext.setLogLevel("INFO")
    marker = f"{(a.out or a.tables).rstrip('/')}.last-run"
    if a.command == "run" and a.respect_schedule and not due(marker, dt.datetime.now()):
        print("not due")
        return 0
    keep = lambda df: df.write.mode("overwrite").parquet(a.out) if a.out else df.show(20, False)
    if a.command == "collect":
        keep(collect(spark, a.tables, a.sources.split(",") if a.sources else None, a.as_of))
    elif a.command == "watch":
        keep(watch(spark, a.tables, a.as_of, a.limit))
    elif a.command == "ingest":
        if not a.inbox:
            print("ingest needs --inbox", file=sys.stderr)
            return 1
        rows, status = ingest(spark, a.tables, spark.read.parquet(a.inbox))
        keep(rows)
        status.groupBy("status").count().show()
    elif a.command in ("report", "run"):
        if not os.path.exists(f"{a.tables}/creditor.parquet"):
            print("no creditor table", file=sys.stderr)
            return 1
        sheets = report(spark, a.tables, a.floor, config.rules(config.load(a.rules)) if a.rules else (), a.policylist)
        print(json.dumps(write_workbook(a.out, sheets) if a.out else {n: d.count() for n, d in sheets.items()}))
        if a.command == "run":
            with open(marker, "w") as f:
                f.write(dt.date.today().isoformat())
    elif a.command == "schema":
        describe_headers(table(spark, a.tables, a.table or "matter"), {"company name": "company_name", "acn": "acn"}).show(100, False)
    else:
        html = table(spark, a.tables, a.table or "documents")
        html.select(title(F.col("text")).alias("title"), F.size(link_targets(F.col("text"))).alias("links"), F.length("text").alias("length")).show(20, False)
    return 0


if __name__ == "__main__":
    sys.exit(main())
