"""Queries over matters, snapshots, documents and events: state, windows, listings, work lists; with their SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from debtloom.functions.canon import present, squeeze
from debtloom.functions.listing import tab_rows
from debtloom.functions.markup import label_values, link_targets
from debtloom.functions.text import absolute_url, acn_or_null, file_stem, html_escape, local_gate, matter_key, money
from debtloom.operators.state import first_by, merge_state, open_rows, ordinal_in, prune, replace_by_key, upsert, within
from debtloom.session import table

#: The day on which the queries look at the data; a run passes its own.
AS_OF = "2026-06-30"
_STATE = ("source", "source_id", "company_name", "acn", "appointment_type", "practitioner", "industry", "state", "postcode")


def _as_of() -> Column:
    return F.lit(AS_OF).cast("date")


def _day(c: str) -> Column:
    return F.substring(c, 1, 10).try_cast("date")


def _snapshot(spark: SparkSession, sf_dir: str, last: bool) -> DataFrame:
    """The rows of the first or last delivery, one per matter; its number is one row, joined and not fetched."""
    s = table(spark, sf_dir, "matter_snapshot")
    no = s.agg((F.max if last else F.min)("snapshot_no").alias("snapshot_no"))
    text = F.concat_ws("|", *[F.coalesce(c, F.lit("")) for c in _STATE])
    return first_by(s.join(F.broadcast(no), "snapshot_no", "left_semi").select("matter_id", *_STATE, "loaded_at"), ["matter_id"], [F.col("loaded_at"), text])


def ledger_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first delivery as known state, merged with the last one."""
    known = _snapshot(spark, sf_dir, False).drop("loaded_at")
    return merge_state(known, _snapshot(spark, sf_dir, True).drop("loaded_at"), "matter_id", F.lit(AS_OF))


def _ledger_sql(last: str) -> str:
    text = ", ".join(f"coalesce({c}, '')" for c in _STATE)
    return f"SELECT * FROM matter_snapshot WHERE snapshot_no = (SELECT {last}(snapshot_no) FROM matter_snapshot) QUALIFY row_number() OVER (PARTITION BY matter_id ORDER BY loaded_at, concat_ws('|', {text})) = 1"


def replace_by_matter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Debts of one feed, those of matters in the other feed replaced."""
    c = table(spark, sf_dir, "creditor").select("matter_id", "creditor_id", "source", "amount_aud")
    kept = replace_by_key(c.where("source = 'asic'"), c.where("source <> 'asic'"), "matter_id")
    return kept.groupBy("source").agg(F.count("*").alias("n"), F.count_distinct("matter_id").alias("n_matters"), F.sum(F.col("amount_aud").cast("decimal(18,2)")).cast("double").alias("total"))


def open_matters(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = table(spark, sf_dir, "matter")
    return open_rows(m, "creditors_captured", _day("first_seen"), _as_of(), 120, "document_status", ("no-section", "scanned")).select("matter_row", "matter_id", "source", "first_seen", "document_status")


def purchase_queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = table(spark, sf_dir, "matter")
    due = F.coalesce("form_5604_lodged", F.lit(False)) & ~F.coalesce("form_5604_purchased", F.lit(False)) & ~F.coalesce("creditors_captured", F.lit(False))
    return m.where(due).select("matter_row", "matter_id", "company_name", acn_or_null(F.col("acn")).alias("acn"), "form_5604_doc_number")


def check_order_capped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 150 matters to look at next: liquidations first, the longest unchecked, the newest; a top-k, no full sort."""
    m = table(spark, sf_dir, "matter")
    likely = F.coalesce(F.lower(F.col("appointment_type")).contains("liquidation"), F.lit(False))
    top = m.withColumn("likely", likely).orderBy(F.desc("likely"), F.coalesce("last_checked", F.lit("")), F.desc_nulls_first("first_seen"), "matter_row").limit(150)
    return top.select("matter_row", "likely", "last_checked", "first_seen")


def queue_upsert_prune(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A queue of earlier matters brought up to date by later ones; what is neither queued nor answered goes."""
    m = table(spark, sf_dir, "matter").where("matter_id is not null")
    one = first_by(m.select("matter_id", "matter_row", "company_name", "practitioner", "form_5604_doc_number", "form_5604_lodged", "document_status"), ["matter_id"], [F.col("matter_row")])
    known = one.where("document_status is not null").select("matter_id", "company_name", "practitioner", F.when(F.col("document_status") == "ok", F.col("document_status")).alias("uploaded_key"))
    queued = one.where("form_5604_lodged").select("matter_id", F.upper("company_name").alias("company_name"), "practitioner")
    return prune(upsert(known, queued, "matter_id", ["company_name"]), F.col("uploaded_key").isNotNull()).select("matter_id", "company_name", "practitioner", "uploaded_key", "is_queued")


def _steps(m: DataFrame) -> Column:
    kind, day = F.lower(F.coalesce("appointment_type", F.lit(""))), _day("first_seen")
    return (
        F.when(F.col("company_name").isNull() | (F.trim("company_name") == ""), "blank").when(kind.contains("restructuring"), "solvent").when(~within(day, _as_of(), 365), "old").otherwise("kept")
    )


def feed_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What becomes of each row of the feeds, the first reason counts; and the newest day of each."""
    m = table(spark, sf_dir, "matter")
    return m.groupBy("source", _steps(m).alias("outcome")).agg(F.count("*").alias("n"), F.max(_day("first_seen")).alias("newest"))


def feed_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Types of appointment with their share."""
    kind = F.coalesce(F.nullif(F.lower(squeeze(F.col("appointment_type"))), F.lit("")), F.lit("none"))
    counts = table(spark, sf_dir, "matter").groupBy(kind.alias("kind")).agg(F.count("*").alias("n"))
    return counts.select("kind", "n", F.round(F.col("n") / F.sum("n").over(Window.partitionBy()), 6).alias("share"))


def feed_industries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The eight most frequent industries of the feeds; fillers are none."""
    of = F.lower(present(F.col("industry")))
    counts = table(spark, sf_dir, "matter").select(of.alias("of_industry")).where("of_industry is not null").groupBy("of_industry").agg(F.count("*").alias("n"))
    return counts.orderBy(F.desc("n"), "of_industry").limit(8)


def feed_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first and last day of each feed, and the rows without one."""
    day = _day("first_seen")
    return table(spark, sf_dir, "matter").groupBy("source").agg(F.min(day).alias("oldest"), F.max(day).alias("newest"), F.count_if(day.isNull()).alias("undated"))


def ledger_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many matters the last delivery found, how many of them are new, and how many are tracked in all."""
    m = ledger_merge(spark, sf_dir)
    return m.agg(F.count_if(F.col("last_seen").isNotNull()).alias("found"), F.count_if("is_new").alias("new"), F.count("*").alias("tracked"))


def month_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    months = table(spark, sf_dir, "matter").select(F.date_format(_day("first_seen"), "yyyy-MM").alias("month")).where("month is not null").groupBy("month").agg(F.count("*").alias("n"))
    return months.orderBy(F.desc("month")).limit(8)


def lookback_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many rows, and how many liquidations, each of five windows would take: one pass, no join."""
    m, day = table(spark, sf_dir, "matter"), _day("first_seen")
    windows = (14, 30, 60, 90, 180)
    liq = F.coalesce(F.lower(F.col("appointment_type")).contains("liquidation"), F.lit(False))
    sums = m.agg(*[F.count_if(within(day, _as_of(), w)).alias(f"n{w}") for w in windows], *[F.count_if(within(day, _as_of(), w) & liq).alias(f"l{w}") for w in windows])
    return sums.select(F.explode(F.array(*[F.struct(F.lit(w).alias("days"), F.col(f"n{w}").alias("n"), F.col(f"l{w}").alias("n_liquidations")) for w in windows])).alias("x")).select("x.*")


def notice_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Types of notices that hold, or are held in, a wanted one; an empty type is held in all."""
    wanted = F.array(*[F.lit(w) for w in ("court liquidation", "creditors' voluntary liquidation", "voluntary administration", "receiver")])
    t = F.trim(F.lower(F.coalesce("appointment_type", F.lit(""))))
    kinds = table(spark, sf_dir, "matter").groupBy(t.alias("notice")).agg(F.count("*").alias("n"))
    return kinds.where(F.exists(wanted, lambda w: w.contains(F.col("notice")) | F.col("notice").contains(w)))


def union_feeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All feeds in one table: matters, notices and snapshots, with what each has."""
    m = table(spark, sf_dir, "matter").select(F.lit("matter").alias("feed"), "source", "company_name", "acn", "abn")
    b = table(spark, sf_dir, "matter_batch").select(F.lit("batch").alias("feed"), "source", "company_name", "acn", "received_at")
    s = table(spark, sf_dir, "matter_snapshot").select(F.lit("snapshot").alias("feed"), "source", "company_name", "acn")
    every = m.unionByName(b, allowMissingColumns=True).unionByName(s, allowMissingColumns=True)
    return every.groupBy("feed", "source").agg(F.count("*").alias("n"), F.count("abn").alias("n_abn"), F.count("received_at").alias("n_received"), F.count_distinct(acn_or_null(F.col("acn"))).alias("n_acn"))


def first_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first matter row of each source id."""
    m = table(spark, sf_dir, "matter").where("source_id is not null").select("source_id", "matter_row", "company_name")
    return first_by(m, ["source_id"], [F.col("matter_row")])


def matter_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = table(spark, sf_dir, "matter")
    return m.select("matter_row", matter_key(F.col("source"), acn_or_null(F.col("acn")), F.col("company_name")).alias("id"))


def status_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outcomes by source, and whether a source gave none in more than half of its rows."""
    m = table(spark, sf_dir, "matter")
    return m.groupBy("source").agg(
        F.count("*").alias("attempted"), F.count("document_status").alias("reached"), (F.count_if(F.col("document_status").isNull()) > F.floor(F.count("*") / 2)).alias("alarm"), F.max(_day("last_checked")).alias("newest")
    )


def listing_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tab_rows(table(spark, sf_dir, "documents"), "doc_id", "text").select("doc_id", "line_no", "creditor_name", "address", "related_party", F.col("amount_aud").cast("double").alias("amount_aud"), "amount_known")


def panel_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Matters written as a panel of labels and values, and read back."""
    m = table(spark, sf_dir, "matter")
    fields = {"Company": "company_name", "Practitioner": "practitioner", "Industry": "industry"}
    html = F.concat(*[F.concat(F.lit(f"<p><b>{k}:</b> "), html_escape(F.coalesce(F.col(c), F.lit("-"))), F.lit("</p>")) for k, c in fields.items()])
    values = label_values(html, list(fields))
    return m.select("matter_row", *[present(F.try_element_at(values, F.lit(k))).alias(c) for k, c in fields.items()])


def page_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links of made pages, absolute, the first of each target."""
    m = table(spark, sf_dir, "matter").where("source_url is not null")
    page = F.concat(F.lit('<a href="/docs/'), F.coalesce("source_id", F.lit("none")), F.lit('.pdf">Report</a> <a href="'), F.col("source_url"), F.lit('">Source</a>'))
    links = m.select("matter_row", F.lit("https://portal.invalid/list/1").alias("base"), F.posexplode(link_targets(page)).alias("pos", "href"))
    return links.select("matter_row", "pos", absolute_url(F.col("base"), F.col("href")).alias("url"))


def document_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The two best documents of each matter: reports, then circulars, then the rest, then the lowest id. Kept to two per task before the shuffle."""
    d = table(spark, sf_dir, "documents").where("matter_id is not null").select("matter_id", "doc_id", "doc_type")
    rank = F.when(F.col("doc_type") == "report", 1).when(F.col("doc_type") == "circular", 2).otherwise(3)
    return ordinal_in(d, ["matter_id"], [rank, F.col("doc_id")], "place").where("place <= 2")


def weekly_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether a run is due at each event's time, the last run being that of the same day after clicks, of the day before after errors, and none else."""
    e = table(spark, sf_dir, "events")
    day = F.to_date(F.from_utc_timestamp("ts", "Australia/Adelaide"))
    last = F.when(F.col("event_type") == "click", day).when(F.col("event_type") == "error", F.date_sub(day, 1))
    return e.select("event_id", local_gate(F.col("ts"), "Australia/Adelaide", 1, 10, last).alias("due"))


def inbox_review(spark: SparkSession, sf_dir: str) -> DataFrame:
    """File names whose stem is no known matter."""
    m = table(spark, sf_dir, "matter")
    files = m.select(F.concat(F.lit("inbox/"), F.when(F.col("matter_row") % 5 == 0, F.concat(F.lit("x"), F.col("matter_row").cast("string"))).otherwise(F.col("matter_id")), F.lit("__list.pdf")).alias("file")).distinct()
    named = files.select("file", file_stem(F.col("file")).alias("matter_id"))
    return named.join(m.select("matter_id").distinct(), "matter_id", "left_anti")


def debts_by_industry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Debts with the industry of their matter where they have none: matters are put to one row before the join."""
    m = first_by(table(spark, sf_dir, "matter").where("industry is not null").select("matter_id", "matter_row", "industry"), ["matter_id"], [F.col("matter_row")])
    c = table(spark, sf_dir, "creditor").select("matter_id", "debtor_industry", "amount_aud", "amount_known")
    joined = c.join(m.select("matter_id", "industry"), "matter_id", "left")
    top = joined.groupBy(F.coalesce(F.nullif("debtor_industry", F.lit("")), F.col("industry"), F.lit("none")).alias("of_industry")).agg(F.count("*").alias("n"), F.sum(F.when(F.col("amount_known"), F.col("amount_aud").cast("decimal(18,2)"))).cast("double").alias("total"))
    return top.select("of_industry", "n", "total", F.coalesce(money(F.col("total")), F.lit("TBC")).alias("shown"))


def debts_by_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Debts with the state of their matter where they have none."""
    m = first_by(table(spark, sf_dir, "matter").where("length(trim(state)) > 0").select("matter_id", "matter_row", "state"), ["matter_id"], [F.col("matter_row")])
    c = table(spark, sf_dir, "creditor").select("matter_id", "debtor_state").join(m.select("matter_id", "state"), "matter_id", "left")
    return c.groupBy(F.coalesce(F.nullif("debtor_state", F.lit("")), F.trim("state"), F.lit("none")).alias("of_state")).agg(F.count("*").alias("n"))


def queries() -> dict:
    fs = (
        ledger_merge, replace_by_matter, open_matters, purchase_queue, check_order_capped, queue_upsert_prune, feed_window, feed_profile, feed_industries, feed_range, ledger_counts, month_histogram, lookback_sweep, notice_filter, union_feeds, first_wins,
        matter_ids, status_counts, listing_rows, panel_details, page_links, document_rank, weekly_gate, inbox_review, debts_by_industry, debts_by_state,
    )
    return {f.__name__: f for f in fs}


def oracle_sql() -> dict[str, str]:
    from debtloom.plans.roll_queries import _MONEY
    from debtloom.plans.sql import SPACES as spaces
    from debtloom.plans.sql import key_sql

    day = lambda c: f"try_cast(substr({c}, 1, 10) AS DATE)"
    acn = "CASE WHEN length(regexp_replace(acn, '[^0-9]', '', 'g')) BETWEEN 1 AND 9 THEN lpad(regexp_replace(acn, '[^0-9]', '', 'g'), 9, '0') END"
    fill = ", ".join(f"CASE WHEN coalesce(k.{c}, '') = '' THEN coalesce(f.{c}, k.{c}) ELSE k.{c} END AS {c}" for c in _STATE)
    fillers = "('', '-', '--', 'n/a', 'na', 'none', 'null', 'nil', 'unknown', 'not stated', 'not known', 'not available', 'tba', 'tbc', 'tbd', '?', '.')"
    said = lambda c: f"CASE WHEN lower(trim(regexp_replace({c}, {spaces}, ' ', 'g'))) NOT IN {fillers} THEN trim(regexp_replace({c}, {spaces}, ' ', 'g')) END AS {c}"
    liq = "coalesce(contains(lower(appointment_type), 'liquidation'), false)"
    in_days = lambda w: f"({day('first_seen')} IS NULL OR {day('first_seen')} >= DATE '{AS_OF}' - {w})"
    return {
        "ledger_merge": f"""WITH k AS ({_ledger_sql('min')}), f AS ({_ledger_sql('max')})
SELECT coalesce(k.matter_id, f.matter_id) AS matter_id, {fill}, CASE WHEN f.matter_id IS NOT NULL THEN '{AS_OF}' END AS last_seen, k.matter_id IS NULL AS is_new FROM k FULL OUTER JOIN f ON k.matter_id = f.matter_id""",
        "replace_by_matter": """WITH w AS (SELECT * FROM creditor WHERE source <> 'asic'), r AS (SELECT * FROM creditor WHERE source = 'asic' AND (matter_id IS NULL OR matter_id NOT IN (SELECT matter_id FROM w WHERE matter_id IS NOT NULL)) UNION ALL SELECT * FROM w)
SELECT source, count(*) AS n, count(DISTINCT matter_id) AS n_matters, CAST(sum(CAST(amount_aud AS DECIMAL(18, 2))) AS DOUBLE) AS total FROM r GROUP BY 1""",
        "open_matters": f"""SELECT matter_row, matter_id, source, first_seen, document_status FROM matter WHERE NOT coalesce(creditors_captured, false) AND {in_days(120)} AND coalesce(document_status, '') NOT IN ('no-section', 'scanned')""",
        "purchase_queue": f"SELECT matter_row, matter_id, company_name, {acn} AS acn, form_5604_doc_number FROM matter WHERE coalesce(form_5604_lodged, false) AND NOT coalesce(form_5604_purchased, false) AND NOT coalesce(creditors_captured, false)",
        "check_order_capped": f"SELECT matter_row, {liq} AS likely, last_checked, first_seen FROM matter ORDER BY likely DESC, coalesce(last_checked, ''), first_seen DESC NULLS FIRST, matter_row LIMIT 150",
        "queue_upsert_prune": """WITH one AS (SELECT * FROM matter WHERE matter_id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY matter_id ORDER BY matter_row) = 1),
k AS (SELECT matter_id, company_name, practitioner, CASE WHEN document_status = 'ok' THEN document_status END AS uploaded_key FROM one WHERE document_status IS NOT NULL),
q AS (SELECT matter_id, upper(company_name) AS company_name, practitioner FROM one WHERE form_5604_lodged)
SELECT coalesce(k.matter_id, q.matter_id) AS matter_id, coalesce(q.company_name, k.company_name) AS company_name, coalesce(k.practitioner, q.practitioner) AS practitioner, uploaded_key, q.matter_id IS NOT NULL AS is_queued
FROM k FULL OUTER JOIN q ON k.matter_id = q.matter_id WHERE q.matter_id IS NOT NULL OR uploaded_key IS NOT NULL""",
        "feed_window": f"""SELECT source, CASE WHEN coalesce(trim(company_name), '') = '' THEN 'blank' WHEN contains(lower(coalesce(appointment_type, '')), 'restructuring') THEN 'solvent' WHEN NOT {in_days(365)} THEN 'old' ELSE 'kept' END AS outcome,
  count(*) AS n, max({day('first_seen')}) AS newest FROM matter GROUP BY 1, 2""",
        "feed_profile": f"SELECT kind, n, round(n / sum(n) OVER (), 6) AS share FROM (SELECT coalesce(nullif(lower(trim(regexp_replace(appointment_type, {spaces}, ' ', 'g'))), ''), 'none') AS kind, count(*) AS n FROM matter GROUP BY 1)",
        "feed_industries": f"SELECT of_industry, count(*) AS n FROM (SELECT lower(i) AS of_industry FROM (SELECT {said('industry').replace(' AS industry', ' AS i')} FROM matter)) WHERE of_industry IS NOT NULL GROUP BY 1 ORDER BY n DESC, of_industry LIMIT 8",
        "feed_range": f"SELECT source, min({day('first_seen')}) AS oldest, max({day('first_seen')}) AS newest, count(*) FILTER ({day('first_seen')} IS NULL) AS undated FROM matter GROUP BY 1",
        "ledger_counts": f"WITH k AS ({_ledger_sql('min')}), f AS ({_ledger_sql('max')}) SELECT count(f.matter_id) AS found, count(*) FILTER (k.matter_id IS NULL) AS new, count(*) AS tracked FROM k FULL OUTER JOIN f ON k.matter_id = f.matter_id",
        "debts_by_state": "WITH m AS (SELECT matter_id, arg_min(state, matter_row) AS state FROM matter WHERE length(trim(state)) > 0 GROUP BY 1) SELECT coalesce(nullif(debtor_state, ''), trim(state), 'none') AS of_state, count(*) AS n FROM creditor LEFT JOIN m USING (matter_id) GROUP BY 1",
        "month_histogram": f"SELECT strftime({day('first_seen')}, '%Y-%m') AS month, count(*) AS n FROM matter WHERE {day('first_seen')} IS NOT NULL GROUP BY 1 ORDER BY 1 DESC LIMIT 8",
        "lookback_sweep": " UNION ALL ".join(f"SELECT {w} AS days, count(*) FILTER ({in_days(w)}) AS n, count(*) FILTER ({in_days(w)} AND {liq}) AS n_liquidations FROM matter" for w in (14, 30, 60, 90, 180)),
        "notice_filter": """WITH k AS (SELECT trim(lower(coalesce(appointment_type, ''))) AS notice, count(*) AS n FROM matter GROUP BY 1)
SELECT * FROM k WHERE len(list_filter(['court liquidation', 'creditors'' voluntary liquidation', 'voluntary administration', 'receiver'], lambda w: contains(w, notice) OR contains(notice, w))) > 0""",
        "union_feeds": f"""SELECT feed, source, count(*) AS n, count(abn) AS n_abn, count(received_at) AS n_received, count(DISTINCT {acn}) AS n_acn FROM (
SELECT 'matter' AS feed, source, acn, abn, NULL AS received_at FROM matter UNION ALL SELECT 'batch', source, acn, NULL, received_at FROM matter_batch UNION ALL SELECT 'snapshot', source, acn, NULL, NULL FROM matter_snapshot) GROUP BY 1, 2""",
        "first_wins": "SELECT source_id, min(matter_row) AS matter_row, arg_min((company_name,), matter_row)[1] AS company_name FROM matter WHERE source_id IS NOT NULL GROUP BY 1",
        "matter_ids": f"SELECT matter_row, substr(sha256(concat_ws('|', source, coalesce({acn}, {key_sql('company_name')}))), 1, 16) AS id FROM matter",
        "status_counts": f"SELECT source, count(*) AS attempted, count(document_status) AS reached, count(*) FILTER (document_status IS NULL) > count(*) // 2 AS alarm, max({day('last_checked')}) AS newest FROM matter GROUP BY 1",
        "listing_rows": r"""WITH l AS (SELECT doc_id, unnest(string_split_regex(text, '\r?\n')) AS line, CAST(generate_subscripts(string_split_regex(text, '\r?\n'), 1) - 1 AS INTEGER) AS line_no FROM documents),
c AS (SELECT doc_id, line_no, string_split(line, chr(9)) AS c FROM l WHERE contains(line, chr(9))),
r AS (SELECT doc_id, line_no, trim(c[1]) AS creditor_name, nullif(trim(c[2]), '') AS address, lower(trim(c[3])) AS r, coalesce(try_cast(regexp_replace(trim(c[4]), '[$,\s]', '', 'g') AS DECIMAL(18, 2)), 0) AS a FROM c WHERE len(c) = 4)
SELECT doc_id, line_no, creditor_name, address, r = 'yes' AS related_party, CAST(a AS DOUBLE) AS amount_aud, a > 0 AS amount_known FROM r WHERE r IN ('yes', 'no') AND length(creditor_name) > 0""",
        "panel_details": f"SELECT matter_row, {said('company_name')}, {said('practitioner')}, {said('industry')} FROM matter",
        "page_links": """SELECT matter_row, 0 AS pos, 'https://portal.invalid/docs/' || coalesce(source_id, 'none') || '.pdf' AS url FROM matter WHERE source_url IS NOT NULL
UNION ALL SELECT matter_row, 1, CASE WHEN regexp_matches(source_url, '^https?://') THEN source_url WHEN starts_with(source_url, '/') THEN 'https://portal.invalid' || source_url ELSE 'https://portal.invalid/list/' || source_url END FROM matter WHERE source_url IS NOT NULL""",
        "document_rank": """SELECT * FROM (SELECT matter_id, doc_id, doc_type, CAST(row_number() OVER (PARTITION BY matter_id ORDER BY CASE doc_type WHEN 'report' THEN 1 WHEN 'circular' THEN 2 ELSE 3 END, doc_id) AS INTEGER) AS place FROM documents WHERE matter_id IS NOT NULL) WHERE place <= 2""",
        "weekly_gate": """SELECT event_id, isodow(t) = 1 AND hour(t) >= 10 AND event_type <> 'click' AS due FROM (SELECT event_id, event_type, timezone('Australia/Adelaide', timezone('UTC', ts)) AS t FROM events)""",
        "inbox_review": """SELECT matter_id, file FROM (SELECT DISTINCT 'inbox/' || m || '__list.pdf' AS file, m AS matter_id FROM (SELECT CASE WHEN matter_row % 5 = 0 THEN 'x' || matter_row ELSE matter_id END AS m FROM matter)) WHERE matter_id NOT IN (SELECT matter_id FROM matter WHERE matter_id IS NOT NULL)""",
        "debts_by_industry": f"""WITH m AS (SELECT matter_id, arg_min(industry, matter_row) AS industry FROM matter WHERE industry IS NOT NULL GROUP BY 1),
s AS (SELECT coalesce(nullif(debtor_industry, ''), industry, 'none') AS of_industry, count(*) AS n, CAST(sum(CASE WHEN amount_known THEN CAST(amount_aud AS DECIMAL(18, 2)) END) AS DOUBLE) AS total FROM creditor LEFT JOIN m USING (matter_id) GROUP BY 1)
SELECT *, coalesce({_MONEY.format('total')}, 'TBC') AS shown FROM s""",
    }
