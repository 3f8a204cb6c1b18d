"""What a desk works through: harvested files, register checks, numbers resolved, organisations and notes, queues."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from debtloom.functions.text import acn_or_null, identifier, name_key
from debtloom.operators.name_match import match_names, org_identifiers, org_names
from debtloom.operators.state import first_by, ordinal_in

#: Outcomes of a document after which it need not be read again.
CONCLUSIVE = ("ok", "no-section", "table-unreadable")


def first_only(df: DataFrame, flag: str, is_set: Column) -> DataFrame:
    """First appointments only, where the table has the flag's column; all rows where it has not."""
    return df.where(is_set) if flag in df.columns else df


def filled(record: DataFrame, panel: DataFrame, key: str, fields: Sequence[str], number: str = "acn") -> DataFrame:
    """Records with what a detail panel adds: a field that has a value stays; a number is taken with nine digits at most, padded."""
    p = panel.alias("p")
    value = lambda f: acn_or_null(F.col(f"p.{f}")) if f == number else F.nullif(F.trim(f"p.{f}"), F.lit(""))
    joined = record.alias("r").join(p, F.col(f"r.{key}") == F.col(f"p.{key}"), "left")
    return joined.select(*[(F.coalesce(F.nullif(F.col(f"r.{c}"), F.lit("")), value(c)) if c in fields else F.col(f"r.{c}")).alias(c) for c in record.columns])


def harvest_choice(documents: DataFrame, matter: str, order: Sequence[Column], status: str, most: int = 2) -> DataFrame:
    """Of each matter's ``most`` best documents the first that gives rows, else the first of all; kept to ``most`` before anything is chosen."""
    best = ordinal_in(documents, [matter], order, "place").where(F.col("place") <= most)
    return first_by(best, [matter], [F.when(F.col(status) == "ok", 0).otherwise(1), F.col("place")])


def checked(records: DataFrame, answers: DataFrame, key: str, stamp: Column) -> DataFrame:
    """Records after a register check: what was reached is stamped and takes the answer's document; a failed lookup is no answer and changes nothing."""
    r, a = records.alias("r"), answers.where("reached").alias("a")
    joined = r.join(a, F.col(f"r.{key}") == F.col(f"a.{key}"), "left")
    reached, lodged = F.col(f"a.{key}").isNotNull(), F.coalesce(F.col("a.doc_number"), F.lit("")) != ""
    new = {"last_checked": F.when(reached, stamp), "form_5604_lodged": F.when(lodged, True), "form_5604_doc_number": F.when(lodged, F.col("a.doc_number"))}
    return joined.select(*[(F.coalesce(new[c], F.col(f"r.{c}")) if c in new else F.col(f"r.{c}")).alias(c) for c in records.columns])


def resolved(rows: DataFrame, key: str, number: Column, name: Column, known: DataFrame) -> DataFrame:
    """``key, abn``: eleven digits from a landed list (``name_key, abn``), by the last nine where a row has a number, else by name; a number's first entry counts."""
    ids = known.where("length(abn) = 11")
    by_number = ids.groupBy(F.expr("right(abn, 9)").alias("acn")).agg(F.min("abn").alias("abn"))
    by_name = ids.where("length(name_key) > 0").groupBy("name_key").agg(F.min("abn").alias("other"))
    each = rows.select(key, acn_or_null(number).alias("acn"), name_key(name).alias("name_key"))
    found = each.join(by_number, "acn", "left").join(by_name, "name_key", "left")
    return found.select(key, F.when(F.col("acn").isNotNull(), F.col("abn")).otherwise(F.col("other")).alias("abn")).where("abn is not null")


def matched_organisations(prospects: DataFrame, orgs: DataFrame) -> DataFrame:
    """``prospect_id, org_id, by``: the organisation of a prospect by its business number or the nine digits in it, which is decisive, else by the rungs of a name match."""
    want = prospects.select("prospect_id", identifier(F.col("abn")).alias("d")).where("d != ''")
    numbers = want.select("prospect_id", F.expr("right(d, 9)").alias("number"))
    by_number = numbers.join(org_identifiers(orgs), "number").groupBy("prospect_id").agg(F.min("org_id").alias("org_id"))
    rest = prospects.join(by_number, "prospect_id", "left_anti").select("prospect_id", name_key(F.col("display_name")).alias("key")).where("length(key) > 0")
    named = org_names(orgs)
    listed = named.select("key", F.col("key").alias("original"), F.struct("org_id").alias("pos"))
    hits = match_names(rest.select("key"), listed).join(named.select(F.col("key").alias("original"), "org_id"), "original")
    by_name = rest.join(hits.select("key", "org_id", "rung"), "key").select("prospect_id", "org_id", F.col("rung").alias("by"))
    return by_number.select("prospect_id", "org_id", F.lit("number").alias("by")).unionByName(by_name)


def unnoted(notes: DataFrame, existing: DataFrame, key: str, debtors: str, marker: str) -> DataFrame:
    """Notes to write: none of the organisation's notes has the marker and every debtor in it already."""
    n, e = notes.alias("n"), existing.where(F.col("content").contains(marker)).alias("e")
    has_all = F.forall(F.col(f"n.{debtors}"), lambda d: F.col("e.content").contains(d))
    return n.join(e, (F.col(f"n.{key}") == F.col(f"e.{key}")) & has_all, "left_anti")


def missing_files(listed: DataFrame, present: DataFrame, name: str) -> DataFrame:
    """Listed files that are not there yet."""
    return listed.join(present.select(name).distinct(), name, "left_anti")


def queue_order(queue: DataFrame, purchased: str, queued_at: Column, limit: int | None = None) -> DataFrame:
    """Outstanding rows first, then the newest; with ``limit`` a top-k."""
    order = queue.orderBy(F.col(purchased).isNotNull(), queued_at.desc_nulls_last(), "matter_id")
    return order.limit(limit) if limit else order


def stale_feeds(feed: DataFrame, source: str, date: Column, as_of: Column, days: int) -> DataFrame:
    """``source, newest, lag_days, in_window, stale``: a feed whose window is empty although it has dated rows is stale, not quiet."""
    per = feed.groupBy(source).agg(F.max(date).alias("newest"), F.count_if(date >= F.date_sub(as_of, days)).alias("in_window"))
    return per.select(source, "newest", F.datediff(as_of, "newest").alias("lag_days"), "in_window", ((F.col("in_window") == 0) & F.col("newest").isNotNull()).alias("stale"))


