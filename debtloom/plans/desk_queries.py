"""Queries over register pages, portal links, the CRM and the queue, with their SQL. Pages are written from the tables with the clutter of real ones."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from debtloom.functions.canon import date_canon, present, squeeze
from debtloom.functions.listing import is_listing, page_counts
from debtloom.functions.markup import LOGIN_SIGNS, asks_to_log_in, document_links, file_links, form_rows, headed_rows, label_values
from debtloom.functions.text import acn_or_null, file_url, html_escape, money, organisation_url, search_url
from debtloom.operators.desk import CONCLUSIVE, checked, filled, harvest_choice, matched_organisations, missing_files, queue_order, resolved, stale_feeds, unnoted
from debtloom.operators.state import first_by
from debtloom.plans.roll_queries import _MONEY, matched_sql
from debtloom.plans.sql import SPACES, key_sql
from debtloom.session import table

#: What headings of a notices table mean, the first that is found counts; document kinds that carry listings, best first; panel labels.
NOTICE_HEADINGS = (
    ("organisation", "company_name"), ("company", "company_name"), ("name", "company_name"), ("acn", "acn"), ("abn", "acn"), ("notice type", "appointment_type"), ("type", "appointment_type"),
    ("published", "appointment_date"), ("date", "appointment_date"), ("practitioner", "practitioner"), ("appointee", "practitioner"), ("firm", "practitioner_firm"),
)
LISTING_KINDS = ("notice of plan", "initial advice", "2nd advice", "first advice")
PANEL = {"ACN/Estate#": "acn", "Admin Type": "appointment_type", "Start Date": "appointment_date", "Industry": "industry", "Appointee": "practitioner"}
AS_OF = "2026-06-30"


def _cell(c: Column) -> Column:
    return F.concat(F.lit("<td>"), html_escape(c), F.lit("</td>"))


def _text(c: str) -> Column:
    return squeeze(F.coalesce(F.col(c), F.lit("")))


def _page(rows: DataFrame, key: str, order: str, row: Column, top: str, bottom: str) -> DataFrame:
    lines = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(order, row.alias("r")))), lambda x: x["r"]), "")
    return rows.groupBy(key).agg(F.concat(F.lit(top), lines, F.lit(bottom)).alias("html"))


def notices_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Notices read from tables by their headings; where the number's cell is empty it is found in the row's text."""
    m = table(spark, sf_dir, "matter").withColumn("page", F.floor(F.col("matter_row") / 50))
    hidden = F.length(_text("company_name")) % 3 == 0
    number = F.coalesce(acn_or_null(F.col("acn")), F.lit(""))
    who = F.when(hidden & (number != ""), F.concat(_text("practitioner"), F.lit(" (ACN "), F.regexp_replace(number, r"(\d{3})(\d{3})(\d{3})", "$1 $2 $3"), F.lit(")"))).otherwise(_text("practitioner"))
    link = F.concat(F.lit('<td><a href="/notice/'), F.col("matter_row").cast("string"), F.lit('">view</a></td>'))
    row = F.concat(F.lit("<tr>"), _cell(_text("company_name")), _cell(F.when(hidden, "").otherwise(number)), _cell(_text("appointment_type")), _cell(_text("appointment_date")), _cell(who), link, F.lit("</tr><tr><td> </td></tr>"))
    pages = _page(m, "page", "matter_row", row, "<html><table><tr><td>Home</td></tr></table><table><tr><th>Organisation name</th><th>ACN / ABN</th><th>Notice type</th><th>Date published</th><th>Appointee</th></tr>", "</table></html>")
    rows = headed_rows(pages, "page", "html", NOTICE_HEADINGS, "company_name")
    acn = F.coalesce(F.col("acn"), F.nullif(F.regexp_replace(F.regexp_extract("row_text", r"\b(\d{3}\s?\d{3}\s?\d{3})\b", 1), r"\s", ""), F.lit("")))
    return rows.select(F.regexp_extract("href", r"(\d+)$", 1).cast("bigint").alias("matter_row"), "company_name", acn.alias("acn"), "appointment_type", date_canon(F.col("appointment_date")).alias("day"))


def portal_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files behind the links of list pages: those with an id and a name, each once."""
    m = table(spark, sf_dir, "matter").withColumn("page", F.floor(F.col("matter_row") / 50)).withColumn("id", F.md5(F.coalesce("source_id", F.lit("none"))))
    row = F.concat(
        F.lit('<a class="x" href="/FileInformation/'), F.col("id"), F.lit('"><img></a> <a href="/FileInformation/'), F.col("id"), F.lit('?v=1">'), html_escape(_text("company_name")), F.lit('</a><a href="/other/'), F.col("id"), F.lit('">Not this</a>')
    )
    return file_links(_page(m, "page", "matter_row", row, "<p>", "</p>"), "page", "html", "fileinformation")


def portal_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PDF links of each matter's page with their rank by kind, only those that carry listings."""
    d = table(spark, sf_dir, "documents").where("matter_id is not null")
    kind = F.when(F.col("doc_type") == "report", "Initial Advice to creditors").when(F.col("doc_type") == "circular", "2nd advice").when(F.col("doc_type") == "minutes", "Minutes").otherwise("FIRST ADVICE")
    href = F.concat(F.lit("/WebDocuments/"), F.col("doc_id").cast("string"), F.when(F.col("doc_type") == "letter", ".html").otherwise(".PDF?v=2"))
    row = F.concat(F.lit("<li><a href='"), href, F.lit("'>"), kind, F.lit(" <b>&amp; more</b></a></li>"))
    return document_links(_page(d, "matter_id", "doc_id", row, "<ul>", "</ul>"), "matter_id", "html", LISTING_KINDS, True).select("matter_id", "href", "name", "rank")


def register_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lodged form of each organisation's page: the first row that names it, its number and day."""
    m = first_by(table(spark, sf_dir, "matter").where("matter_id is not null").select("matter_id", "matter_row", "form_5604_lodged", "form_5604_doc_number", "form_5604_date"), ["matter_id"], [F.col("matter_row")])
    lodged = F.coalesce("form_5604_lodged", F.lit(False))
    rows = F.concat(F.lit("<table><tr><th>Form</th><th>Number</th></tr><tr><td>205A</td><td>123456789</td></tr>"), F.when(lodged, F.concat(F.lit("<tr><td>Form 5604</td>"), _cell(_text("form_5604_date")), _cell(_text("form_5604_doc_number")), F.lit("</tr><tr><td>5604</td><td>999999999</td></tr>"))).otherwise(""), F.lit("</table>"))
    return form_rows(m.select("matter_id", rows.alias("html")), "matter_id", "html", "5604")


def panel_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Matters with what the detail panels of their later rows add to the fields that the first row lacks."""
    m = table(spark, sf_dir, "matter").where("matter_id is not null").select("matter_id", "matter_row", *PANEL.values())
    first = first_by(m, ["matter_id"], [F.col("matter_row")])
    last = first_by(m, ["matter_id"], [-F.col("matter_row")])
    html = F.concat(*[F.concat(F.lit(f"<span>{k}:</span> "), html_escape(F.coalesce(present(F.col(c)), F.lit("-"))), F.lit(" ")) for k, c in PANEL.items()])
    read = last.select("matter_id", label_values(html, list(PANEL)).alias("v")).select("matter_id", *[present(F.try_element_at("v", F.lit(k))).alias(c) for k, c in PANEL.items()])
    return filled(first, read, "matter_id", list(PANEL.values()))


def register_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = table(spark, sf_dir, "matter")
    base = F.lit("https://register.invalid/search")
    return m.select("matter_row", search_url(base, _text("company_name")).alias("search"), organisation_url(base, F.col("acn")).alias("organisation"), file_url(F.lit("https://portal.invalid/file/"), F.col("source_id")).alias("file"))


def login_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages of documents, of which those of letters are behind a login."""
    d = table(spark, sf_dir, "documents")
    page = F.concat(F.when(F.col("doc_type") == "letter", '<form><input TYPE="password"> <b>Sign in</b></form>').otherwise(""), F.coalesce("text", F.lit("")))
    return d.select("doc_id", asks_to_log_in(page).alias("login"))


def line_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What lines each document has."""
    d = table(spark, sf_dir, "documents")
    text = F.replace(F.coalesce("text", F.lit("")), F.lit("\t"), F.lit("\n"))
    counts = page_counts(text)
    return d.select("doc_id", F.size(F.filter(F.split(text, r"\r?\n"), lambda x: x.rlike(r"\S"))).alias("n_lines"), counts["n_yes_no"].alias("n_yes_no"), counts["n_money"].alias("n_money"), F.size(F.regexp_extract_all(text, F.lit(r"\$\s*\d{1,3}(?:,\d{3})*(?:\.\d{2})?"), F.lit(0))).alias("n_inline_money"))


def _queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = table(spark, sf_dir, "matter").where("matter_id is not null and form_5604_lodged")
    one = first_by(m.select("matter_id", "matter_row", "company_name", "acn", "abn", "form_5604_doc_number", "form_5604_date", "appointment_type", "form_5604_purchased", "first_seen"), ["matter_id"], [F.col("matter_row")])
    return one.withColumn("purchased_at", F.when(F.lower("form_5604_purchased").isin("1", "1.0", "y", "yes", "true"), F.col("first_seen")))


def queue_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hundred first rows of the queue: outstanding first, then the newest."""
    return queue_order(_queue(spark, sf_dir), "purchased_at", F.col("first_seen"), 100).select("matter_id", "first_seen", F.col("purchased_at").isNull().alias("outstanding"))


def newest_liquidations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five newest creditors' voluntary liquidations with a number."""
    m = table(spark, sf_dir, "matter").where(F.lower("appointment_type").contains("creditors") & F.lower("appointment_type").contains("voluntary") & acn_or_null(F.col("acn")).isNotNull())
    return m.select("matter_row", acn_or_null(F.col("acn")).alias("acn"), date_canon(F.col("appointment_date")).alias("day")).orderBy(F.desc_nulls_last("day"), "matter_row").limit(5)


def watch_routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Matters by route (a portal's own, or the register), by whether the last outcome is conclusive, and those that still need a number."""
    m = table(spark, sf_dir, "matter")
    need = F.coalesce("form_5604_lodged", F.lit(False)) & ~F.coalesce(F.lower("form_5604_purchased").isin("1", "1.0", "y", "yes", "true"), F.lit(False)) & F.col("abn").isNull() & ~F.coalesce("creditors_captured", F.lit(False))
    return m.groupBy(F.when(F.col("source") == "worrells", "portal").otherwise("register").alias("route"), F.coalesce(F.col("document_status").isin(*CONCLUSIVE), F.lit(False)).alias("conclusive")).agg(F.count("*").alias("n"), F.count_if(need).alias("n_need_number"))


def stale_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stale_feeds(table(spark, sf_dir, "matter"), "source", F.substring("first_seen", 1, 10).try_cast("date"), F.lit("2027-03-01").cast("date"), 60)


def crm_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The organisation of each prospect, and by what: its number, an equal, a near or a longer name."""
    return matched_organisations(table(spark, sf_dir, "prospect"), table(spark, sf_dir, "crm_org"))


def crm_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many prospects are in the CRM, by what, and how many that the CRM was linked to before are not found again."""
    found = crm_match(spark, sf_dir)
    p = table(spark, sf_dir, "prospect").select("prospect_id", "pipedrive_org_id").join(found, "prospect_id", "left")
    return p.groupBy(F.coalesce("by", F.lit("none")).alias("by")).agg(F.count("*").alias("n"), F.count_if(F.col("pipedrive_org_id").isNotNull()).alias("n_linked"), F.count_if(F.col("pipedrive_org_id") == F.col("org_id")).alias("n_same"))


def notes_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prospects of an organisation whose notes do not name all their debtors yet; of each organisation the first prospect's note is there."""
    p = table(spark, sf_dir, "prospect").where("pipedrive_org_id is not null").select("prospect_id", F.col("pipedrive_org_id").alias("org_id"), F.transform(F.coalesce("matters", F.array()), lambda m: F.coalesce(m["debtor_company"], F.lit(""))).alias("debtors"))
    there = first_by(p, ["org_id"], [F.col("prospect_id")]).select("org_id", F.concat(F.lit("[debtloom] "), F.array_join("debtors", "; ")).alias("content"))
    return unnoted(p, there, "org_id", "debtors", "[debtloom]").select("prospect_id", "org_id")


def files_to_pull(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Source documents of debts that are not among those of the other feed."""
    c = table(spark, sf_dir, "creditor").where("source_document is not null").select("source", F.col("source_document").alias("file"))
    return missing_files(c.where("source = 'asic'").select("file").distinct(), c.where("source <> 'asic'"), "file")


def harvested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of each matter's two best documents the first that is a listing."""
    d = table(spark, sf_dir, "documents").where("matter_id is not null")
    ok = is_listing(page_counts(F.replace(F.coalesce("text", F.lit("")), F.lit("\t"), F.lit("\n"))))
    each = d.select("matter_id", "doc_id", "doc_type", F.when(ok, "ok").otherwise("no-section").alias("status"))
    rank = F.when(F.col("doc_type") == "report", 1).when(F.col("doc_type") == "circular", 2).otherwise(3)
    return harvest_choice(each, "matter_id", [rank, F.col("doc_id")], "status").select("matter_id", "doc_id", "status")


def register_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First rows of matters after a check whose answers are their later rows; those without a status were not reached."""
    cols = ("matter_row", "last_checked", "form_5604_lodged", "form_5604_doc_number", "document_status")
    m = table(spark, sf_dir, "matter").where("matter_id is not null").select("matter_id", *cols)
    first, last = first_by(m, ["matter_id"], [F.col("matter_row")]), first_by(m, ["matter_id"], [-F.col("matter_row")])
    answers = last.select("matter_id", F.col("form_5604_doc_number").alias("doc_number"), F.col("document_status").isNotNull().alias("reached"))
    return checked(first.drop("document_status", "matter_row"), answers, "matter_id", F.lit(AS_OF))


def numbers_resolved(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Business numbers of matters from those that prospects and matters are known by."""
    digits = lambda c: F.regexp_replace(F.coalesce(c, F.lit("")), "[^0-9]", "")
    m, p = table(spark, sf_dir, "matter"), table(spark, sf_dir, "prospect")
    known = p.select("name_key", digits("abn").alias("abn")).unionByName(m.select(F.lit("").alias("name_key"), digits("abn").alias("abn")))
    return resolved(m, "matter_row", F.col("acn"), F.col("company_name"), known)


def workbook_queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The queue's sheet."""
    q = _queue(spark, sf_dir)
    return q.select("matter_id", "company_name", acn_or_null(F.col("acn")).alias("acn"), "abn", F.lit("5604").alias("form"), F.col("form_5604_doc_number").alias("document_number"), F.col("form_5604_date").alias("lodged"), "appointment_type", organisation_url(F.lit("https://register.invalid/org"), F.col("acn")).alias("link"), F.col("first_seen").alias("queued"))


def workbook_matters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The matters' sheet, answers as yes or no."""
    yes = lambda c: F.when(F.coalesce(c, F.lit(False)), "Yes").otherwise("No")
    m = table(spark, sf_dir, "matter")
    plain = ("company_name", "acn", "source", "appointment_type", "appointment_date", "industry", "industry_subdivision", "state", "postcode", "practitioner", "form_5604_date", "form_5604_doc_number", "last_checked")
    return m.select("matter_row", *plain, yes(F.col("form_5604_lodged")).alias("lodged"), yes(F.lower("form_5604_purchased").isin("1", "1.0", "y", "yes", "true")).alias("purchased"), yes(F.col("creditors_captured")).alias("captured"))


def kpi_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The summary of a run as lines of a table: counts, then the ten largest repeat exposures."""
    p, m = table(spark, sf_dir, "prospect"), table(spark, sf_dir, "matter")
    k = p.agg(F.count_if("qualified").alias("q"), F.count_if(F.col("qualified") & (F.col("matter_count") > 1)).alias("r"), F.count_if(F.col("qualified") & F.col("pipedrive_org_id").isNotNull()).alias("c"), F.count_if(~F.col("qualified")).alias("x"))
    t = m.agg(F.count_distinct("matter_id").alias("t"), F.count_distinct(F.when(F.col("creditors_captured"), F.col("matter_id"))).alias("d"))
    labels = (("Matters tracked", "t"), ("Listings captured", "d"), ("Qualified prospects", "q"), ("Repeat exposure", "r"), ("Already in the CRM", "c"), ("Excluded", "x"))
    lines = t.crossJoin(k).select(F.posexplode(F.array(*[F.concat(F.lit(f"| {name} | "), F.col(c).cast("string"), F.lit(" |")) for name, c in labels])).alias("line_no", "line"))
    top = p.where("qualified and matter_count > 1").orderBy(F.desc("total_exposure_aud"), "name_key").limit(10).select(F.lit(99).alias("line_no"), F.concat(F.lit("| "), F.col("display_name"), F.lit(" | "), money(F.col("total_exposure_aud")), F.lit(" | "), F.col("matter_count").cast("string"), F.lit(" |")).alias("line"))
    return lines.unionByName(top)


def queries() -> dict:
    fs = (
        notices_table, portal_files, portal_documents, register_forms, panel_fill, register_urls, login_pages, line_profile, queue_view, newest_liquidations, watch_routes, stale_feed, crm_match, crm_hits,
        notes_missing, files_to_pull, harvested, register_check, numbers_resolved, workbook_queue, workbook_matters, kpi_lines,
    )
    return {f.__name__: f for f in fs}


def oracle_sql() -> dict[str, str]:
    from debtloom.plans.listing_queries import _LISTED, _gate_sql

    text = lambda c: f"trim(regexp_replace(coalesce({c}, ''), {SPACES}, ' ', 'g'))"
    digits = lambda c: f"regexp_replace(coalesce({c}, ''), '[^0-9]', '', 'g')"
    acn = f"CASE WHEN length({digits('acn')}) BETWEEN 1 AND 9 THEN lpad({digits('acn')}, 9, '0') END"
    fillers = "('', '-', '--', 'n/a', 'na', 'none', 'null', 'nil', 'unknown', 'not stated', 'not known', 'not available', 'tba', 'tbc', 'tbd', '?', '.')"
    said = lambda c: f"CASE WHEN lower({text(c)}) NOT IN {fillers} THEN {text(c)} END"
    day = lambda a: f"CASE WHEN regexp_matches({a}, '^\\d{{4}}-\\d{{1,2}}-\\d{{1,2}}') THEN try_cast(regexp_extract({a}, '^\\d{{4}}-\\d{{1,2}}-\\d{{1,2}}') AS DATE) WHEN regexp_matches({a}, '^\\d{{1,2}}[-/.]\\d{{1,2}}[-/.]\\d{{4}}') THEN try_strptime(replace(replace({a}, '-', '/'), '.', '/'), '%d/%m/%Y')::DATE ELSE try_strptime({a}, '%d %b %Y')::DATE END"
    seen = "try_cast(substr(first_seen, 1, 10) AS DATE)"
    bought = "coalesce(lower(CAST(form_5604_purchased AS VARCHAR)) IN ('1', '1.0', 'y', 'yes', 'true'), false)"
    first, last = ("SELECT * FROM matter WHERE matter_id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY matter_id ORDER BY matter_row{}) = 1".format(o) for o in ("", " DESC"))
    queue = f"queue AS (SELECT *, CASE WHEN {bought} THEN first_seen END AS purchased_at FROM (SELECT * FROM matter WHERE matter_id IS NOT NULL AND form_5604_lodged QUALIFY row_number() OVER (PARTITION BY matter_id ORDER BY matter_row) = 1))"
    doc_lines = r"string_split_regex(replace(coalesce(text, ''), chr(9), chr(10)), '\r?\n')"
    gated = f"g AS (SELECT doc_id, matter_id, doc_type, {_gate_sql(doc_lines)}, regexp_matches(lower(coalesce(text, '')), 'listing of known creditors|list of creditors|schedule of debts and claims') AS has_heading FROM documents)"
    kept = lambda c: (f"coalesce(nullif(f.{c}, ''), CASE WHEN length({digits('l.' + c)}) BETWEEN 1 AND 9 AND {said('l.' + c)} IS NOT NULL THEN lpad({digits('l.' + c)}, 9, '0') END)" if c == "acn" else f"coalesce(nullif(f.{c}, ''), {said('l.' + c)})") + f" AS {c}"
    orgs = f"""ids AS (SELECT org_id, right(d, 9) AS number FROM (SELECT org_id, {digits('f')} AS d FROM (SELECT org_id, unnest(custom_fields) AS f FROM crm_org)) WHERE length(d) IN (9, 11)),
by_number AS (SELECT prospect_id, min(org_id) AS org_id FROM (SELECT prospect_id, right({digits('abn')}, 9) AS number FROM prospect WHERE length({digits('abn')}) IN (9, 11)) JOIN ids USING (number) GROUP BY 1),
each AS (SELECT org_id, 0 AS place, org_name AS original FROM crm_org UNION ALL SELECT org_id, place, f FROM (SELECT org_id, unnest(custom_fields) AS f, generate_subscripts(custom_fields, 1) AS place FROM crm_org)
  WHERE NOT contains(f, '@') AND NOT regexp_matches(f, '(?i)^(https?://|www\\.)') AND NOT (length({digits('f')}) IN (9, 11)) AND regexp_matches(f, '[A-Za-z]{{3}}')),
named AS (SELECT {key_sql('original')} AS key, min(org_id) AS org_id FROM each WHERE original IS NOT NULL GROUP BY 1 HAVING length(key) > 0),
keys AS (SELECT DISTINCT {key_sql('display_name')} AS key FROM prospect WHERE prospect_id NOT IN (SELECT prospect_id FROM by_number)),
listed AS (SELECT key, key AS original, CAST(org_id AS VARCHAR) AS p1, 0 AS p2, org_id AS p0 FROM named)"""
    matched = f"{orgs}, {matched_sql('keys', 'listed')}, found AS (SELECT prospect_id, org_id, 'number' AS by FROM by_number UNION ALL SELECT prospect_id, n.org_id, rung FROM (SELECT prospect_id, {key_sql('display_name')} AS key FROM prospect WHERE prospect_id NOT IN (SELECT prospect_id FROM by_number)) JOIN matched USING (key) JOIN named n ON n.key = matched.original)"
    lower_text = "lower(CASE WHEN doc_type = 'letter' THEN '<form><input TYPE=\"password\"> <b>Sign in</b></form>' ELSE '' END || coalesce(text, ''))"
    signs = " + ".join("CAST(contains({}, '{}') AS INTEGER)".format(lower_text, s.replace("'", "''")) for s in LOGIN_SIGNS)
    yes = lambda c: f"CASE WHEN coalesce({c}, false) THEN 'Yes' ELSE 'No' END"
    return {
        "notices_table": f"SELECT matter_row, {text('company_name')} AS company_name, {acn} AS acn, nullif({text('appointment_type')}, '') AS appointment_type, {day(text('appointment_date'))} AS day FROM matter WHERE {text('company_name')} <> ''",
        "portal_files": f"SELECT file_id, arg_min(name, (page, matter_row)) AS name, min(page) AS page FROM (SELECT md5(coalesce(source_id, 'none')) AS file_id, {text('company_name')} AS name, CAST(floor(matter_row / 50) AS BIGINT) AS page, matter_row FROM matter) WHERE name <> '' GROUP BY 1",
        "portal_documents": """SELECT matter_id, '/WebDocuments/' || doc_id || '.PDF?v=2' AS href, CASE doc_type WHEN 'report' THEN 'Initial Advice to creditors' WHEN 'circular' THEN '2nd advice' ELSE 'FIRST ADVICE' END || ' & more' AS name,
  CASE doc_type WHEN 'report' THEN 1 WHEN 'circular' THEN 2 ELSE 3 END AS rank FROM documents WHERE matter_id IS NOT NULL AND coalesce(doc_type, '') NOT IN ('letter', 'minutes')""",
        "register_forms": f"WITH f AS ({first}) SELECT matter_id, coalesce(nullif(regexp_extract(form_5604_date, '\\b(\\d{{9,12}})\\b', 1), ''), regexp_extract(coalesce(form_5604_doc_number, ''), '\\b(\\d{{9,12}})\\b', 1)) AS doc_number, {day(text('form_5604_date'))} AS lodged FROM f WHERE form_5604_lodged",
        "panel_fill": f"WITH f AS ({first}), l AS ({last}) SELECT f.matter_id, f.matter_row, {', '.join(kept(c) for c in PANEL.values())} FROM f JOIN l ON l.matter_id = f.matter_id",
        "register_urls": f"""SELECT matter_row, 'https://register.invalid/search?SearchText=' || replace(replace(url_encode({text('company_name')}), '%20', '+'), '~', '%7E') AS search, 'https://register.invalid/search?acn=' || {digits('acn')} AS organisation,
  CASE WHEN regexp_matches(source_id, '[0-9A-Fa-f]{{32}}') THEN 'https://portal.invalid/file/' || regexp_extract(source_id, '[0-9A-Fa-f]{{32}}') END AS file FROM matter""",
        "login_pages": f"SELECT doc_id, ({signs}) >= 2 AS login FROM documents",
        "line_profile": rf"""SELECT doc_id, CAST(len(list_filter({doc_lines}, lambda x: regexp_matches(x, '\S'))) AS INTEGER) AS n_lines, n_yes_no, n_money, CAST(len(regexp_extract_all(replace(coalesce(text, ''), chr(9), chr(10)), '\$\s*\d{{1,3}}(?:,\d{{3}})*(?:\.\d{{2}})?')) AS INTEGER) AS n_inline_money
FROM (SELECT doc_id, text, {_gate_sql(doc_lines)} FROM documents)""",
        "queue_view": f"WITH {queue} SELECT matter_id, first_seen, purchased_at IS NULL AS outstanding FROM queue ORDER BY purchased_at IS NOT NULL, first_seen DESC NULLS LAST, matter_id LIMIT 100",
        "newest_liquidations": f"SELECT matter_row, {acn} AS acn, {day(text('appointment_date'))} AS day FROM matter WHERE contains(lower(appointment_type), 'creditors') AND contains(lower(appointment_type), 'voluntary') AND {acn} IS NOT NULL ORDER BY day DESC NULLS LAST, matter_row LIMIT 5",
        "watch_routes": f"""SELECT CASE WHEN source = 'worrells' THEN 'portal' ELSE 'register' END AS route, coalesce(document_status IN {CONCLUSIVE}, false) AS conclusive, count(*) AS n,
  count(*) FILTER (coalesce(form_5604_lodged, false) AND NOT {bought} AND abn IS NULL AND NOT coalesce(creditors_captured, false)) AS n_need_number FROM matter GROUP BY 1, 2""",
        "stale_feed": f"SELECT source, max({seen}) AS newest, CAST(DATE '2027-03-01' - max({seen}) AS INTEGER) AS lag_days, count(*) FILTER ({seen} >= DATE '2027-03-01' - 60) AS in_window, count(*) FILTER ({seen} >= DATE '2027-03-01' - 60) = 0 AND max({seen}) IS NOT NULL AS stale FROM matter GROUP BY 1",
        "crm_match": f"WITH RECURSIVE {matched} SELECT * FROM found",
        "crm_hits": f"WITH RECURSIVE {matched} SELECT coalesce(f.by, 'none') AS by, count(*) AS n, count(p.pipedrive_org_id) AS n_linked, count(*) FILTER (p.pipedrive_org_id = f.org_id) AS n_same FROM prospect p LEFT JOIN found f USING (prospect_id) GROUP BY 1",
        "notes_missing": """WITH p AS (SELECT prospect_id, pipedrive_org_id AS org_id, list_transform(coalesce(matters, []), lambda m: coalesce(m.debtor_company, '')) AS debtors FROM prospect WHERE pipedrive_org_id IS NOT NULL),
t AS (SELECT org_id, array_to_string(arg_min(debtors, prospect_id), '; ') AS content FROM p GROUP BY 1) SELECT p.prospect_id, p.org_id FROM p JOIN t USING (org_id) WHERE len(list_filter(debtors, lambda d: NOT contains('[debtloom] ' || content, d))) > 0""",
        "files_to_pull": "SELECT DISTINCT source_document AS file FROM creditor WHERE source = 'asic' AND source_document IS NOT NULL AND source_document NOT IN (SELECT source_document FROM creditor WHERE source <> 'asic' AND source_document IS NOT NULL)",
        "harvested": f"""WITH {gated}, r AS (SELECT *, {_LISTED} AS ok, row_number() OVER (PARTITION BY matter_id ORDER BY CASE doc_type WHEN 'report' THEN 1 WHEN 'circular' THEN 2 ELSE 3 END, doc_id) AS place FROM g WHERE matter_id IS NOT NULL)
SELECT matter_id, doc_id, CASE WHEN ok THEN 'ok' ELSE 'no-section' END AS status FROM r WHERE place <= 2 QUALIFY row_number() OVER (PARTITION BY matter_id ORDER BY CASE WHEN ok THEN 0 ELSE 1 END, place) = 1""",
        "register_check": f"""WITH f AS ({first}), l AS ({last}) SELECT f.matter_id, CASE WHEN l.document_status IS NOT NULL THEN '{AS_OF}' ELSE f.last_checked END AS last_checked,
  CASE WHEN l.document_status IS NOT NULL AND coalesce(l.form_5604_doc_number, '') <> '' THEN true ELSE f.form_5604_lodged END AS form_5604_lodged,
  CASE WHEN l.document_status IS NOT NULL AND coalesce(l.form_5604_doc_number, '') <> '' THEN l.form_5604_doc_number ELSE f.form_5604_doc_number END AS form_5604_doc_number FROM f JOIN l USING (matter_id)""",
        "numbers_resolved": f"""WITH k AS (SELECT name_key, {digits('abn')} AS abn FROM prospect UNION ALL SELECT '', {digits('abn')} FROM matter), w AS (SELECT * FROM k WHERE length(abn) = 11),
n AS (SELECT right(abn, 9) AS acn, min(abn) AS abn FROM w GROUP BY 1), x AS (SELECT name_key, min(abn) AS abn FROM w WHERE length(name_key) > 0 GROUP BY 1), m AS (SELECT matter_row, {acn} AS acn, {key_sql('company_name')} AS name_key FROM matter)
SELECT matter_row, CASE WHEN m.acn IS NOT NULL THEN n.abn ELSE x.abn END AS abn FROM m LEFT JOIN n ON n.acn = m.acn LEFT JOIN x ON x.name_key = m.name_key WHERE CASE WHEN m.acn IS NOT NULL THEN n.abn ELSE x.abn END IS NOT NULL""",
        "workbook_queue": f"WITH {queue} SELECT matter_id, company_name, {acn} AS acn, abn, '5604' AS form, form_5604_doc_number AS document_number, form_5604_date AS lodged, appointment_type, 'https://register.invalid/org?acn=' || {digits('acn')} AS link, first_seen AS queued FROM queue",
        "workbook_matters": f"""SELECT matter_row, company_name, acn, source, appointment_type, appointment_date, industry, industry_subdivision, state, postcode, practitioner, form_5604_date, form_5604_doc_number, last_checked, {yes('form_5604_lodged')} AS lodged, {yes(bought)} AS purchased,
  {yes('creditors_captured')} AS captured FROM matter""",
        "kpi_lines": f"""WITH k AS (SELECT (SELECT count(DISTINCT matter_id) FROM matter) AS t, (SELECT count(DISTINCT matter_id) FROM matter WHERE creditors_captured) AS d, count(*) FILTER (qualified) AS q, count(*) FILTER (qualified AND matter_count > 1) AS r,
  count(*) FILTER (qualified AND pipedrive_org_id IS NOT NULL) AS c, count(*) FILTER (NOT qualified) AS x FROM prospect)
SELECT unnest([0, 1, 2, 3, 4, 5]) AS line_no, unnest(['| Matters tracked | ' || t || ' |', '| Listings captured | ' || d || ' |', '| Qualified prospects | ' || q || ' |', '| Repeat exposure | ' || r || ' |', '| Already in the CRM | ' || c || ' |', '| Excluded | ' || x || ' |']) AS line FROM k
UNION ALL SELECT 99, '| ' || display_name || ' | ' || {_MONEY.format('total_exposure_aud')} || ' | ' || matter_count || ' |' FROM (SELECT * FROM prospect WHERE qualified AND matter_count > 1 ORDER BY total_exposure_aud DESC, name_key LIMIT 10)""",
    }
