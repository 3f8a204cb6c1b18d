"""Queries over creditors, prospects, the policy list and the CRM, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from debtloom.functions.canon import date_canon
from debtloom.functions.people import BUSINESS_WORDS, TITLES, is_person
from debtloom.functions.text import (
    abn_print, abn_valid, acn_or_null, distinctive, exposure_score, header_key, html_escape, identifier, money, name_key, safe_file_name, short_id, truthy,
)
from debtloom.operators.name_match import key_list, longer_key, match_names, near_keys, org_identifiers, org_names
from debtloom.operators.rollup import admissible, first_rule, qualify, ranked, roll_up, scored
from debtloom.plans.sql import key_sql
from debtloom.session import table

FLOOR = 5000.0


def _prospects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored(roll_up(admissible(table(spark, sf_dir, "creditor")), "creditor_id"))


def prospect_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _prospects(spark, sf_dir).withColumn("debtor_industries", F.array_join("debtor_industries", "; "))


_ROLL = f"""
WITH k AS (SELECT *, {key_sql('creditor_name')} AS nk FROM creditor WHERE NOT coalesce(related_party, false)),
roll AS (
  SELECT nk AS name_key, arg_max(trim(creditor_name), (length(trim(creditor_name)), -creditor_id)) AS display_name,
         CAST(coalesce(sum(CASE WHEN coalesce(amount_known, true) THEN CAST(amount_aud AS DECIMAL(18, 2)) END), 0) AS DOUBLE) AS total_exposure_aud,
         coalesce(bool_or(coalesce(amount_known, true)), false) AS exposure_known, count(DISTINCT matter_id) AS matter_count,
         coalesce(string_agg(DISTINCT nullif(debtor_industry, ''), '; ' ORDER BY nullif(debtor_industry, '')), '') AS debtor_industries, count(*) AS n_rows
  FROM k WHERE length(nk) > 0 GROUP BY nk),
p AS (SELECT *, CAST(trunc(least(100.0, greatest(0.0, (matter_count - 1) * 25 + CASE WHEN exposure_known AND total_exposure_aud > 0 THEN log10(total_exposure_aud) * 10 ELSE 0 END))) AS INTEGER) AS score FROM roll)
"""


def prospect_matters_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The debts behind each prospect, one row each in input order by ``creditor_id``."""
    rows = admissible(table(spark, sf_dir, "creditor"))
    return rows.select("name_key", "creditor_id", "matter_id", "debtor_company", "amount_aud", "amount_known", "source", "source_document", "debtor_industry", "debtor_state")


def normalise_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = table(spark, sf_dir, "creditor").select("creditor_name").where("creditor_name is not null").distinct()
    return names.select("creditor_name", name_key(F.col("creditor_name")).alias("key"), short_id(F.lit("asic"), name_key(F.col("creditor_name"))).alias("id"))


def header_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = table(spark, sf_dir, "sheet_record").select(F.explode(F.json_object_keys("payload")).alias("heading")).distinct()
    return keys.select("heading", header_key(F.col("heading")).alias("folded"))


def flag_truthy(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = table(spark, sf_dir, "matter").select("matter_row", F.explode(F.array(*[F.col(c).cast("string") for c in ("form_5604_purchased", "creditors_captured", "form_5604_lodged", "document_status")])).alias("cell"))
    return cells.groupBy(F.coalesce("cell", F.lit("null")).alias("cell")).agg(F.count("*").alias("n"), F.bool_or(truthy(F.col("cell"))).alias("is_true"))


def acn_padding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "matter").select("matter_row", acn_or_null(F.col("acn")).alias("acn"), identifier(F.col("abn")).alias("abn"))


def multi_format_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "matter").select("matter_row", date_canon(F.col("appointment_date")).alias("day"))


def abn_checksum_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Business numbers as matters and prospects have them, short, spaced or missing, and made ones, of which some hold."""
    made = F.lpad(((F.col("o_orderkey") * 104729) % 100000000000).cast("string"), 11, "0")
    given = [table(spark, sf_dir, t).select(F.lit(t).alias("of"), F.col(i).alias("id"), F.col("abn").alias("number")) for t, i in (("matter", "matter_row"), ("prospect", "prospect_id"))]
    every = table(spark, sf_dir, "orders").select(F.lit("orders").alias("of"), F.col("o_orderkey").alias("id"), made.alias("number")).unionByName(given[0]).unionByName(given[1])
    return every.select("of", "id", "number", abn_valid(F.col("number")).alias("valid"), abn_print(F.col("number")).alias("printed")).distinct()


def score_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "prospect")
    return p.select("prospect_id", exposure_score(F.col("matter_count"), F.col("total_exposure_aud"), F.col("exposure_known")).alias("points"))


#: Rules of an example: pattern, category, reason. A project brings its own.
RULES = (
    (r"\bcommissioner\b|\blevies\b", "tax", "Tax office"),
    (r"\bcouncil\b|\bcity of\b|\bshire\b", "council", "Local government"),
    (r"\blibrary\b|\buniversity\b", "public", "Public body"),
    (r"\bwater corporation\b", "utility", "Utility"),
)


def non_trade_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = table(spark, sf_dir, "creditor").select("creditor_name").where("creditor_name is not null").distinct()
    category, reason = first_rule(F.col("creditor_name"), RULES)
    return names.select("creditor_name", category.alias("category"), reason.alias("reason")).where("category is not null")


_RULE_SQL = " ".join(f"WHEN regexp_matches(creditor_name, '(?i){p}') THEN '{{}}'" for p, *_ in RULES)


def person_or_business(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = table(spark, sf_dir, "creditor").select("creditor_name").where("creditor_name is not null").distinct()
    return names.select("creditor_name", is_person(F.col("creditor_name")).alias("is_person"))


def _policies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return key_list(table(spark, sf_dir, "policy_list").withColumn("policy_no", F.coalesce("policy_no", F.lit(""))), ["policy_name", "client_name"], ["policy_no"])


_POLICY = f"""
pol AS (
  SELECT key, arg_min(original, (policy_no, col, original)) AS original, min((policy_no, col)) AS p FROM (
    SELECT coalesce(policy_no, '') AS policy_no, 0 AS col, trim(policy_name) AS original, {key_sql('policy_name')} AS key FROM policy_list
    UNION ALL SELECT coalesce(policy_no, ''), 1, trim(client_name), {key_sql('client_name')} FROM policy_list)
  WHERE length(key) > 0 GROUP BY key)
"""


def matched_sql(keys: str, listed: str) -> str:
    """``matched``: keys with the list's spelling (``key, original, p1, p2``) by the first rung that gives one; the common subsequence by a row of the table at a time."""
    return f"""
exact AS (SELECT k.key, l.original FROM (SELECT DISTINCT key FROM {keys} WHERE length(key) > 0) k JOIN {listed} l USING (key)),
open_keys AS (SELECT DISTINCT key FROM {keys} WHERE length(key) > 0 AND key NOT IN (SELECT key FROM exact)),
sorted_keys AS (SELECT key, array_to_string(list_sort(string_split(key, ' ')), ' ') AS s FROM open_keys),
sorted_list AS (SELECT key AS candidate, array_to_string(list_sort(string_split(key, ' ')), ' ') AS t FROM {listed}),
near_pairs AS (SELECT * FROM sorted_keys JOIN sorted_list ON abs(length(s) - length(t)) <= 0.08 * (length(s) + length(t)) AND levenshtein(s, t) <= 0.08 * (length(s) + length(t)) + 1e-9),
lcs AS (
  SELECT key, candidate, s, t, 0 AS i, list_transform(range(length(t) + 1), lambda x: 0) AS r FROM near_pairs
  UNION ALL
  SELECT key, candidate, s, t, i + 1, list_transform(range(1, length(t) + 2), lambda j: list_max(list_transform(range(1, j + 1), lambda q: CASE WHEN q = 1 THEN 0 WHEN s[i + 1] = t[q - 1] THEN greatest(r[q - 1] + 1, r[q]) ELSE r[q] END))) FROM lcs WHERE i < length(s)),
near_scored AS (SELECT key, candidate, 200.0 * r[length(t) + 1] / (length(s) + length(t)) AS score FROM lcs WHERE i = length(s)),
near_best AS (SELECT n.key, arg_min(l.original, (-score, l.p1, l.p2)) AS original FROM near_scored n JOIN {listed} l ON l.key = n.candidate WHERE score >= 92 GROUP BY 1),
longer AS (SELECT k.key, min(l.original) AS original FROM open_keys k JOIN {listed} l ON starts_with(l.key, k.key || ' ') WHERE length(k.key) >= 9 AND NOT regexp_matches(k.key, '^[0-9]+$') GROUP BY 1 HAVING count(*) = 1),
matched AS (SELECT key, original, 'exact' AS rung FROM exact UNION ALL SELECT key, original, 'near' FROM near_best UNION ALL SELECT key, original, 'longer' FROM longer WHERE key NOT IN (SELECT key FROM near_best))"""


def person_sql(name: str) -> str:
    """Whether a name is that of a person, as ``is_person`` has it."""
    bare = rf"regexp_replace(regexp_replace(regexp_replace({name}, '(?i)\bc/[o-].*$', ''), '\([^)]*\)', ' ', 'g'), '\s+\d{{1,4}}$', '')"
    bare = f"regexp_replace(regexp_replace(trim(regexp_replace({bare}, ' +', ' ', 'g')), '^[ .,-]+|[ .,-]+$', '', 'g'), ' +', ' ', 'g')"
    words = ", ".join(f"'{w}'" for w in BUSINESS_WORDS)
    titles = ", ".join(f"'{w}'" for w in TITLES)
    fine = f"regexp_matches(w, '^[A-Za-z]\\.?$') OR (regexp_matches(w, '^[A-Z][A-Za-z''-]*$') AND NOT regexp_matches(w, '^[A-Z]{{2,}}$') AND lower(w) NOT IN ({words}))"
    part = f"len(list_filter(string_split(p, ' '), lambda w: w <> '')) BETWEEN 2 AND 4 AND len(list_filter(string_split(p, ' '), lambda w: w <> '' AND NOT ({fine}))) = 0"
    return f"""coalesce((SELECT CASE WHEN b = '' OR regexp_matches(b, '[0-9&]') THEN false WHEN lower(replace(string_split(b, ' ')[1], '.', '')) IN ({titles}) THEN true
  ELSE len(list_filter(string_split_regex(b, '(?i) and '), lambda p: NOT ({part}))) = 0 END FROM (SELECT {bare} AS b)), false)"""


def qualify_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prospects with the first reason against each: a small exposure, a rule, a person, a client by an equal, near or longer name."""
    # Without the columns that no reason needs, as the lists of industries.
    prospects = _prospects(spark, sf_dir).select("name_key", "display_name", "total_exposure_aud", "exposure_known", "score")
    return qualify(prospects, FLOOR, RULES, _policies(spark, sf_dir)).select("name_key", "display_name", "total_exposure_aud", "score", "disqualified_reason", "qualified")


_LISTED = "listed AS (SELECT key, original, p[1] AS p1, p[2] AS p2 FROM pol)"
_CASCADE = f"""{_ROLL.replace("WITH k AS", "WITH RECURSIVE k AS")}, {_POLICY}, {_LISTED}, {matched_sql("(SELECT name_key AS key FROM p)", "listed")},
judged AS (
  SELECT name_key, display_name, total_exposure_aud, score, matter_count, exposure_known,
         CASE WHEN exposure_known AND total_exposure_aud < {FLOOR} THEN 'Exposure $' || format('{{:,}}', CAST(round_even(total_exposure_aud, 0) AS BIGINT)) || ' is below $5,000'
              {' '.join(f"WHEN regexp_matches(display_name, '(?i){p}') THEN '{r}'" for p, _, r in RULES)}
              WHEN {person_sql('display_name')} THEN 'Individual'
              WHEN m.original IS NOT NULL THEN 'Client: ' || m.original END AS disqualified_reason
  FROM p LEFT JOIN matched m ON m.key = p.name_key)
"""


def excluded_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many prospects each kind of reason excludes, and what they are owed."""
    kind = F.regexp_extract(F.coalesce("disqualified_reason", F.lit("qualified")), "^([A-Za-z ]+?)(:| \\$|$)", 1)
    rows = qualify_cascade(spark, sf_dir).groupBy(kind.alias("kind"))
    return rows.agg(F.count("*").alias("n"), F.sum(F.col("total_exposure_aud").cast("decimal(18,2)")).cast("double").alias("total"))


def repeat_exposure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten largest exposures over more than one matter."""
    rows = _prospects(spark, sf_dir).where("matter_count > 1").select("name_key", "display_name", "matter_count", "total_exposure_aud")
    return rows.orderBy(F.desc("total_exposure_aud"), "name_key").limit(10)


def ranked_prospects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hundred first prospects in order, with their rank."""
    top = ranked(qualify_cascade(spark, sf_dir), 100)
    return top.select("name_key", "score", "qualified", "total_exposure_aud")


def _keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "prospect").select(name_key(F.col("display_name")).alias("key")).where("length(key) > 0").distinct()


def policy_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _keys(spark, sf_dir).join(_policies(spark, sf_dir).select("key", "original"), "key")


def policy_fuzzy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys of prospects with every policy key of a token-sorted ratio of 92 or more."""
    return near_keys(_keys(spark, sf_dir), _policies(spark, sf_dir)).select("key", "candidate", F.round("score", 6).alias("score"))


def policy_prefix_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    return longer_key(_keys(spark, sf_dir), _policies(spark, sf_dir))


def name_match_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    return match_names(_keys(spark, sf_dir), _policies(spark, sf_dir))


def crm_identifier_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Matters whose ACN is an organisation's identifier; the first organisation counts."""
    acns = table(spark, sf_dir, "matter").select(acn_or_null(F.col("acn")).alias("number")).where("number is not null").distinct()
    return acns.join(org_identifiers(table(spark, sf_dir, "crm_org")), "number").groupBy("number").agg(F.min("org_id").alias("org_id"))


def crm_name_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prospects' keys that are an organisation's name or a name among its custom fields."""
    return _keys(spark, sf_dir).join(org_names(table(spark, sf_dir, "crm_org")).select("key", "org_id", "original"), "key")


def crm_owner(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "crm_org").select("org_id", F.coalesce("org_owner.label", F.col("org_owner.id").cast("string")).alias("owner"))


def notes_to_post(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The note of every prospect with an organisation: its exposure and its debtors."""
    p = table(spark, sf_dir, "prospect").where("pipedrive_org_id is not null")
    line = F.transform("matters", lambda m: F.concat(F.lit("- "), F.coalesce(m["debtor_company"], F.lit("")), F.when(m["amount_known"], F.concat(F.lit(" ("), money(m["amount_aud"]), F.lit(")"))).otherwise(" (TBC)")))
    return p.select("prospect_id", F.col("pipedrive_org_id").alias("org_id"), F.concat_ws("\n", F.concat(F.lit("Owed by "), F.col("matter_count").cast("string"), F.lit(" debtors")), F.array_join(line, "\n")).alias("note"))


def workbook_prospects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The prospect sheet: its sixteen columns as they are written, and which rows are highlighted."""
    p = table(spark, sf_dir, "prospect")
    debtors = F.array_join(F.transform("matters", lambda m: F.concat(F.coalesce(m["debtor_company"], F.lit("")), F.lit(" ("), F.when(m["amount_known"], money(m["amount_aud"])).otherwise("TBC"), F.lit(")"))), "; ")
    contact = ("abn", "state", "contact_name", "contact_title", "contact_email", "contact_phone", "contact_source", "pipedrive_org_name", "pipedrive_owner", "pipedrive_url")
    return p.select(
        "prospect_id", "display_name", "score", F.when(F.col("exposure_known"), money(F.col("total_exposure_aud"))).otherwise("TBC").alias("exposure"), "matter_count", debtors.alias("debtors"), F.when(F.col("qualified"), "Yes").otherwise("No").alias("qualified"),
        F.array_join("debtor_industries", ", ").alias("industries"), *contact, (F.col("matter_count") > 1).alias("highlighted"), F.col("pipedrive_org_id").isNotNull().alias("in_crm"),
    )


def run_kpis(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "prospect")
    return p.agg(
        F.count("*").alias("tracked"), F.count_if("qualified").alias("n_qualified"), F.count_if(F.col("matter_count") > 1).alias("n_repeat"),
        F.count_if(F.col("pipedrive_org_id").isNotNull()).alias("n_in_crm"), F.count_if(~F.col("qualified")).alias("n_excluded"),
    )


def written_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names as they go into markup and file names."""
    return table(spark, sf_dir, "prospect").select("prospect_id", html_escape(F.col("display_name")).alias("escaped"), safe_file_name(F.col("display_name")).alias("file"), distinctive(F.col("name_key")).alias("distinctive"))


_MONEY = "'$' || format('{{:,}}', CAST(round_even({}, 0) AS BIGINT))"


def queries() -> dict:
    fs = (
        prospect_rollup, prospect_matters_flat, normalise_names, header_fold, flag_truthy, acn_padding, multi_format_dates, abn_checksum_format, score_only, non_trade_rules, person_or_business,
        qualify_cascade, excluded_audit, repeat_exposure, ranked_prospects, policy_exact, policy_fuzzy, policy_prefix_unique, name_match_cascade, crm_identifier_match, crm_name_match, crm_owner,
        notes_to_post, workbook_prospects, run_kpis, written_names,
    )
    return {f.__name__: f for f in fs}


def oracle_sql() -> dict[str, str]:
    keys = f"keys AS (SELECT DISTINCT {key_sql('display_name')} AS key FROM prospect)"
    squeeze = r"trim(regexp_replace(appointment_date, '\s+', ' ', 'g'))"
    weights = "[10, 1, 3, 5, 7, 9, 11, 13, 15, 17, 19]"
    return {
        "prospect_rollup": _ROLL + "SELECT * FROM p",
        "prospect_matters_flat": _ROLL + "SELECT nk AS name_key, creditor_id, matter_id, debtor_company, amount_aud, amount_known, source, source_document, debtor_industry, debtor_state FROM k WHERE length(nk) > 0",
        "normalise_names": f"SELECT creditor_name, key, substr(sha256('asic|' || key), 1, 16) AS id FROM (SELECT DISTINCT creditor_name, {key_sql('creditor_name')} AS key FROM creditor WHERE creditor_name IS NOT NULL)",
        "header_fold": "SELECT DISTINCT heading, trim(regexp_replace(lower(heading), '[^a-z0-9]+', ' ', 'g')) AS folded FROM (SELECT unnest(json_keys(payload)) AS heading FROM sheet_record)",
        "flag_truthy": """SELECT coalesce(cell, 'null') AS cell, count(*) AS n, bool_or(coalesce(lower(trim(cell)) IN ('1', '1.0', 'y', 'yes', 'true'), false)) AS is_true
FROM (SELECT unnest([CAST(form_5604_purchased AS VARCHAR), CAST(creditors_captured AS VARCHAR), CAST(form_5604_lodged AS VARCHAR), document_status]) AS cell FROM matter) GROUP BY 1""",
        "acn_padding": """SELECT matter_row, CASE WHEN length(d) BETWEEN 1 AND 9 THEN lpad(d, 9, '0') END AS acn, CASE WHEN length(b) IN (9, 11) THEN b ELSE '' END AS abn
FROM (SELECT matter_row, regexp_replace(acn, '[^0-9]', '', 'g') AS d, coalesce(regexp_replace(abn, '[^0-9]', '', 'g'), '') AS b FROM matter)""",
        "multi_format_dates": f"""SELECT matter_row, CASE WHEN regexp_matches(a, '^\\d{{4}}-\\d{{1,2}}-\\d{{1,2}}') THEN try_cast(regexp_extract(a, '^\\d{{4}}-\\d{{1,2}}-\\d{{1,2}}') AS DATE)
  WHEN regexp_matches(a, '^\\d{{1,2}}[-/.]\\d{{1,2}}[-/.]\\d{{4}}') THEN try_strptime(replace(replace(a, '-', '/'), '.', '/'), '%d/%m/%Y')::DATE ELSE try_strptime(a, '%d %b %Y')::DATE END AS day
FROM (SELECT matter_row, {squeeze} AS a FROM matter)""",
        "abn_checksum_format": f"""WITH e AS (SELECT 'orders' AS "of", o_orderkey AS id, lpad(CAST((o_orderkey * 104729) % 100000000000 AS VARCHAR), 11, '0') AS number FROM orders UNION ALL SELECT 'matter', matter_row, abn FROM matter UNION ALL SELECT 'prospect', prospect_id, abn FROM prospect),
d AS (SELECT *, regexp_replace(coalesce(number, ''), '[^0-9]', '', 'g') AS digits FROM e)
SELECT DISTINCT "of", id, number, length(digits) = 11 AND (list_sum(list_transform(list_zip(list_transform(string_split(digits, ''), lambda x: CAST(nullif(x, '') AS INTEGER)), {weights}), lambda z: z[1] * z[2])) - 10) % 89 = 0 AS valid,
  CASE WHEN length(digits) = 11 THEN regexp_replace(digits, '^(..)(...)(...)(...)$', '\\1 \\2 \\3 \\4') ELSE number END AS printed FROM d""",
        "score_only": """SELECT prospect_id, CAST(trunc(least(100.0, greatest(0.0, (matter_count - 1) * 25 + CASE WHEN exposure_known AND total_exposure_aud > 0 THEN log10(total_exposure_aud) * 10 ELSE 0 END))) AS INTEGER) AS points FROM prospect""",
        "non_trade_rules": f"SELECT * FROM (SELECT creditor_name, CASE {_RULE_SQL.format(*[c for _, c, _ in RULES])} END AS category, CASE {_RULE_SQL.format(*[r for *_, r in RULES])} END AS reason FROM (SELECT DISTINCT creditor_name FROM creditor)) WHERE category IS NOT NULL",
        "qualify_cascade": _CASCADE + "SELECT name_key, display_name, total_exposure_aud, score, disqualified_reason, disqualified_reason IS NULL AS qualified FROM judged",
        "excluded_audit": _CASCADE + r"SELECT regexp_extract(coalesce(disqualified_reason, 'qualified'), '^([A-Za-z ]+?)(:| \$|$)', 1) AS kind, count(*) AS n, CAST(sum(CAST(total_exposure_aud AS DECIMAL(18, 2))) AS DOUBLE) AS total FROM judged GROUP BY 1",
        "repeat_exposure": _ROLL + "SELECT name_key, display_name, matter_count, total_exposure_aud FROM p WHERE matter_count > 1 ORDER BY total_exposure_aud DESC, name_key LIMIT 10",
        "ranked_prospects": _CASCADE + "SELECT name_key, score, disqualified_reason IS NULL AS qualified, total_exposure_aud FROM judged ORDER BY qualified DESC, score DESC, total_exposure_aud DESC, name_key LIMIT 100",
        "policy_exact": f"WITH {_POLICY}, {keys} SELECT key, original FROM keys JOIN pol USING (key)",
        "person_or_business": f"SELECT creditor_name, {person_sql('creditor_name')} AS is_person FROM (SELECT DISTINCT creditor_name FROM creditor WHERE creditor_name IS NOT NULL)",
        "name_match_cascade": f"WITH RECURSIVE {_POLICY}, {_LISTED}, {keys}, {matched_sql('keys', 'listed')} SELECT key, original, rung FROM matched",
        "policy_fuzzy": f"""WITH RECURSIVE {_POLICY}, {keys}, k AS (SELECT key, array_to_string(list_sort(string_split(key, ' ')), ' ') AS s FROM keys WHERE length(key) > 0), l AS (SELECT key AS candidate, array_to_string(list_sort(string_split(key, ' ')), ' ') AS t FROM pol),
near_pairs AS (SELECT * FROM k JOIN l ON abs(length(s) - length(t)) <= 0.08 * (length(s) + length(t)) AND levenshtein(s, t) <= 0.08 * (length(s) + length(t)) + 1e-9),
lcs AS (SELECT key, candidate, s, t, 0 AS i, list_transform(range(length(t) + 1), lambda x: 0) AS r FROM near_pairs UNION ALL
  SELECT key, candidate, s, t, i + 1, list_transform(range(1, length(t) + 2), lambda j: list_max(list_transform(range(1, j + 1), lambda q: CASE WHEN q = 1 THEN 0 WHEN s[i + 1] = t[q - 1] THEN greatest(r[q - 1] + 1, r[q]) ELSE r[q] END))) FROM lcs WHERE i < length(s))
SELECT key, candidate, round(200.0 * r[length(t) + 1] / (length(s) + length(t)), 6) AS score FROM lcs WHERE i = length(s) AND 200.0 * r[length(t) + 1] / (length(s) + length(t)) >= 92""",
        "policy_prefix_unique": f"""WITH {_POLICY}, {keys} SELECT keys.key, min(pol.key) AS candidate FROM keys JOIN pol ON starts_with(pol.key, keys.key || ' ')
WHERE length(keys.key) >= 9 AND NOT regexp_matches(keys.key, '^[0-9]+$') GROUP BY 1 HAVING count(*) = 1""",
        "crm_identifier_match": """WITH ids AS (SELECT org_id, right(d, 9) AS number FROM (SELECT org_id, regexp_replace(unnest(custom_fields), '[^0-9]', '', 'g') AS d FROM crm_org) WHERE length(d) IN (9, 11)),
acns AS (SELECT DISTINCT lpad(d, 9, '0') AS number FROM (SELECT regexp_replace(acn, '[^0-9]', '', 'g') AS d FROM matter) WHERE length(d) BETWEEN 1 AND 9)
SELECT number, min(org_id) AS org_id FROM acns JOIN ids USING (number) GROUP BY 1""",
        "crm_name_match": f"""WITH {keys}, each AS (
  SELECT org_id, 0 AS pos, org_name AS original FROM crm_org UNION ALL
  SELECT org_id, pos, f FROM (SELECT org_id, unnest(custom_fields) AS f, generate_subscripts(custom_fields, 1) AS pos FROM crm_org)
  WHERE NOT contains(f, '@') AND NOT regexp_matches(f, '(?i)^(https?://|www\\.)') AND NOT (length(regexp_replace(f, '[^0-9]', '', 'g')) IN (9, 11)) AND regexp_matches(f, '[A-Za-z]{{3}}')),
named AS (SELECT org_id, pos, original, {key_sql('original')} AS key FROM each WHERE original IS NOT NULL),
first AS (SELECT key, arg_min((org_id, original), (org_id, pos)) AS r FROM named WHERE length(key) > 0 GROUP BY key)
SELECT key, r[1] AS org_id, r[2] AS original FROM keys JOIN first USING (key)""",
        "crm_owner": "SELECT org_id, coalesce(org_owner.label, CAST(org_owner.id AS VARCHAR)) AS owner FROM crm_org",
        "notes_to_post": f"""SELECT prospect_id, pipedrive_org_id AS org_id, 'Owed by ' || matter_count || ' debtors' || chr(10) || array_to_string(list_transform(matters,
  lambda m: '- ' || coalesce(m.debtor_company, '') || CASE WHEN m.amount_known THEN ' (' || {_MONEY.format('m.amount_aud')} || ')' ELSE ' (TBC)' END), chr(10)) AS note FROM prospect WHERE pipedrive_org_id IS NOT NULL""",
        "workbook_prospects": f"""SELECT prospect_id, display_name, score, matter_count, abn, state, contact_name, contact_title, contact_email, contact_phone, contact_source, pipedrive_org_name, pipedrive_owner, pipedrive_url,
  matter_count > 1 AS highlighted, pipedrive_org_id IS NOT NULL AS in_crm, CASE WHEN exposure_known THEN {_MONEY.format('total_exposure_aud')} ELSE 'TBC' END AS exposure,
  array_to_string(list_transform(matters, lambda m: coalesce(m.debtor_company, '') || ' (' || CASE WHEN m.amount_known THEN {_MONEY.format('m.amount_aud')} ELSE 'TBC' END || ')'), '; ') AS debtors,
  CASE WHEN qualified THEN 'Yes' ELSE 'No' END AS qualified, array_to_string(debtor_industries, ', ') AS industries FROM prospect""",
        "run_kpis": """SELECT count(*) AS tracked, count(*) FILTER (qualified) AS n_qualified, count(*) FILTER (matter_count > 1) AS n_repeat, count(*) FILTER (pipedrive_org_id IS NOT NULL) AS n_in_crm,
  count(*) FILTER (NOT qualified) AS n_excluded FROM prospect""",
        "written_names": """SELECT prospect_id, replace(replace(replace(replace(replace(display_name, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '"', '&quot;'), '''', '&#39;') AS escaped,
  substr(trim(regexp_replace(display_name, '[^A-Za-z0-9 ._-]', '', 'g')), 1, 60) AS file, length(name_key) >= 9 AND NOT regexp_matches(name_key, '^[0-9]+$') AS distinctive FROM prospect""",
    }
