"""Queries over creditor listings: pages written from the debts, with all that surrounds rows in real ones, and read back; with their SQL.

The SQL parses the same pages by positions of lines, so both sides read, not only one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from debtloom.functions.canon import squeeze
from debtloom.functions.listing import HEADER_WORDS, HEADINGS, NO_CREDITOR, PROSE_ENDS, SECTION_LABELS, SKIPPED_LINES, UNKNOWN_AMOUNTS, cell_rows, is_listing, line_rows, page_counts
from debtloom.functions.listing import listing_rows as rows_of_listings
from debtloom.functions.text import name_key
from debtloom.plans.sql import SPACES, key_sql
from debtloom.session import table

#: Debts on a page, and the lines above and below them.
PAGE = 40
TOP = ("12", "B.", "List of creditors", "Name of creditor", "Address", "Related Party (Yes/No)", "ROCAP /", "Identified", "Amount")
BOTTOM = ("Annexure C", "Total", "No", "$99.00")


def _debts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Debts with their page, cells and amounts as they are printed."""
    c = table(spark, sf_dir, "creditor").where("matter_id is not null and length(trim(creditor_name)) > 0")
    debtor = F.coalesce(squeeze(F.col("debtor_company")), F.lit(""))
    known = F.coalesce("amount_known", F.lit(True)) & (F.col("amount_aud") > 0)
    rows = c.select(
        "creditor_id", "matter_id", debtor.alias("debtor"), squeeze(F.col("creditor_name")).alias("name"), F.nullif(squeeze(F.coalesce("address", F.lit(""))), F.lit("")).alias("addr"),
        F.when(F.coalesce("related_party", F.lit(False)), "Yes").otherwise("No").alias("flag"), F.when(known, F.format_number(F.col("amount_aud").cast("decimal(18,2)"), 2)).alias("amount"),
    )
    place = F.row_number().over(Window.partitionBy("matter_id", "debtor").orderBy("creditor_id")) - 1
    return rows.withColumn("page", F.floor(place / PAGE))


def _pages(debts: DataFrame, lines: Column, top: tuple[str, ...], bottom: tuple[str, ...]) -> DataFrame:
    text = F.array_join(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("creditor_id", lines.alias("l")))), lambda x: x["l"])), "\n")
    pages = debts.groupBy("matter_id", "debtor", "page").agg(text.alias("rows"))
    return pages.select(F.concat_ws("|", "matter_id", "debtor", "page").alias("id"), "debtor", F.concat_ws("\n", F.lit("\n".join(top)), "rows", F.lit("\n".join(bottom))).alias("text"))


def _cell_lines() -> Column:
    """A debt's lines, a cell each; which of five shapes, by the length of its name; the running header with the debtor's name before some."""
    amount = F.coalesce(F.concat(F.lit("$"), F.col("amount")), F.lit("TBC"))
    shape = F.length("name") % 5
    name = F.when(shape == 2, F.concat("name", F.lit(" C/-"))).otherwise(F.col("name"))
    behind = F.when(shape == 1, F.array(F.lit("$0.00"), amount)).when(shape == 2, F.array(F.lit(""), amount)).when(shape == 3, F.array(F.lit("see note"), amount)).when(shape == 4, F.array(amount, F.lit("TBC"))).otherwise(F.array(amount))
    header = (F.length("name") % 7 == 0) & (F.length(name_key(F.col("debtor"))) > 0)
    above = F.when(header, F.array(F.concat(F.lit("Report for "), F.col("debtor")), F.lit("No"), F.lit("$10.00"))).otherwise(F.array().cast("array<string>"))
    return F.concat(above, F.array_compact(F.array(name, F.col("addr"), F.col("flag"))), behind)


def _row_lines() -> Column:
    """A debt on one line; shapes without an amount, with leaders, of a fee and of prose are no rows."""
    shape = F.length("name") % 6
    amount = F.coalesce("amount", F.lit("TBC"))
    line = (
        F.when(shape == 0, F.concat_ws(" ", "name", "addr", "flag", amount)).when(shape == 1, F.concat("name", F.lit(" "), "flag", F.lit(" $"), amount)).when(shape == 2, F.concat("name", F.lit(" .......... "), amount))
        .when(shape == 3, F.concat(F.lit("Fees: "), amount)).when(shape == 4, F.concat_ws(" ", "name", "addr", "flag", F.lit("|"), amount)).otherwise(F.concat(F.lit("the creditor "), "name", F.lit(" claims the sum of "), amount))
    )
    return F.array(line)


def _summed(rows: DataFrame, *more: str) -> DataFrame:
    keys = ("creditor_name", "address", "related_party", "amount_known", *more)
    return rows.groupBy(*keys).agg(F.count("*").alias("n"), F.sum(F.col("amount_aud").cast("decimal(18,2)")).cast("double").alias("total"))


def parse_cells_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Debts read from pages with a cell per line, with furniture, headings, two amounts, stray cells, care-of marks and the debtor's own name."""
    return _summed(cell_rows(_pages(_debts(spark, sf_dir), _cell_lines(), TOP, BOTTOM), "id", "text", "debtor"))


def parse_lines_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Debts read from pages with a row per line, among leaders, fees, prose and totals."""
    return _summed(line_rows(_pages(_debts(spark, sf_dir), _row_lines(), TOP[2:3], ("Total 1,234.00",)), "id", "text", "debtor"))


def layout_choice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of pages of both layouts, those that pass as listings, and by which layout they were read."""
    d = _debts(spark, sf_dir)
    by_cell = F.length("debtor") % 2 == 0
    pages = _pages(d.where(by_cell), _cell_lines(), TOP, BOTTOM).unionByName(_pages(d.where(~by_cell), _row_lines(), TOP[2:3], ("Total 1,234.00",)))
    return _summed(rows_of_listings(pages, "id", "text", "debtor"), "layout")


def page_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The evidence of a creditor listing in each document, taken as one page with a cell per line."""
    d = table(spark, sf_dir, "documents")
    counts = page_counts(F.replace(F.coalesce("text", F.lit("")), F.lit("\t"), F.lit("\n")))
    return d.select("doc_id", *[c.alias(n) for n, c in counts.items()], is_listing(counts).alias("is_listing"))


def document_survey(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many documents of each type hold a listing, and the most answers and amounts in one."""
    d = table(spark, sf_dir, "documents")
    counts = page_counts(F.replace(F.coalesce("text", F.lit("")), F.lit("\t"), F.lit("\n")))
    pages = d.select("doc_type", *[c.alias(n) for n, c in counts.items()], is_listing(counts).alias("is_listing"))
    return pages.groupBy("doc_type").agg(
        F.count("*").alias("n"), F.count_if("is_listing").alias("n_listing"), F.max("n_yes_no").alias("most_answers"), F.max("n_money").alias("most_amounts"), F.round(F.count_if("is_listing") / F.count("*") * 100, 4).alias("percent")
    )


_AMOUNT = r"\$?\s*\d{1,3}(?:,\d{3})*(?:\.\d{2})?"
_UNKNOWN = ", ".join(f"'{u}'" for u in UNKNOWN_AMOUNTS)
_WORDS = ", ".join(f"'{w}'" for w in HEADER_WORDS)
_DEBTS = f"""
debts AS (
  SELECT creditor_id, matter_id, trim(regexp_replace(coalesce(debtor_company, ''), {SPACES}, ' ', 'g')) AS debtor, trim(regexp_replace(creditor_name, {SPACES}, ' ', 'g')) AS name,
         nullif(trim(regexp_replace(coalesce(address, ''), {SPACES}, ' ', 'g')), '') AS addr, CASE WHEN coalesce(related_party, false) THEN 'Yes' ELSE 'No' END AS flag,
         CASE WHEN coalesce(amount_known, true) AND amount_aud > 0 THEN format('{{:,}}', CAST(floor(CAST(amount_aud AS DECIMAL(18, 2))) AS BIGINT)) || '.' || right(CAST(CAST(amount_aud AS DECIMAL(18, 2)) AS VARCHAR), 2) END AS amount
  FROM creditor WHERE matter_id IS NOT NULL AND length(trim(creditor_name)) > 0),
placed AS (SELECT *, (row_number() OVER (PARTITION BY matter_id, debtor ORDER BY creditor_id) - 1) // {PAGE} AS page FROM debts)
"""


def _list(cells: tuple[str, ...]) -> str:
    return "[" + ", ".join(f"'{c}'" for c in cells) + "]"


def _page_sql(name: str, debts: str, lines: str, top: tuple[str, ...], bottom: tuple[str, ...]) -> str:
    return f"""{name} AS (SELECT concat_ws('|', matter_id, debtor, page) AS id, debtor, {_list(top)} || flatten(list({lines} ORDER BY creditor_id)) || {_list(bottom)} AS lines FROM {debts} GROUP BY matter_id, debtor, page)"""


_CELL_LINES = f"""((CASE WHEN length(name) % 7 = 0 AND length({key_sql('debtor')}) > 0 THEN ['Report for ' || debtor, 'No', '$10.00'] ELSE [] END)
  || list_filter([CASE WHEN length(name) % 5 = 2 THEN name || ' C/-' ELSE name END, addr, flag], lambda x: x IS NOT NULL)
  || (CASE length(name) % 5 WHEN 1 THEN ['$0.00', coalesce('$' || amount, 'TBC')] WHEN 2 THEN ['', coalesce('$' || amount, 'TBC')] WHEN 3 THEN ['see note', coalesce('$' || amount, 'TBC')]
      WHEN 4 THEN [coalesce('$' || amount, 'TBC'), 'TBC'] ELSE [coalesce('$' || amount, 'TBC')] END))"""
_ROW_LINES = """[CASE length(name) % 6 WHEN 0 THEN concat_ws(' ', name, addr, flag, coalesce(amount, 'TBC')) WHEN 1 THEN name || ' ' || flag || ' $' || coalesce(amount, 'TBC') WHEN 2 THEN name || ' .......... ' || coalesce(amount, 'TBC')
  WHEN 3 THEN 'Fees: ' || coalesce(amount, 'TBC') WHEN 4 THEN concat_ws(' ', name, addr, flag, '|', coalesce(amount, 'TBC')) ELSE 'the creditor ' || name || ' claims the sum of ' || coalesce(amount, 'TBC') END]"""
_LIKE_NAME = r"'^(\p{Lu}|\p{Nd}|[a-z]+[A-Z])'"


def _no_debtor(name: str) -> str:
    return f"NOT (length({key_sql('debtor')}) > 0 AND contains({key_sql(name)}, {key_sql('debtor')}))"


def _cells_sql(pages: str) -> str:
    """The rows of pages with a cell per line, by the positions of answers and amounts."""
    return rf"""
cells AS (SELECT id, debtor, unnest(lines) AS raw, generate_subscripts(lines, 1) AS pos FROM {pages}),
kinds AS (SELECT id, debtor, pos, trim(raw) AS cell, CASE WHEN trim(raw) = '' THEN 'B' WHEN lower(trim(raw)) IN ('yes', 'no') THEN 'F' WHEN regexp_matches(trim(raw), '^{_AMOUNT}$') THEN 'M'
    WHEN lower(trim(raw)) IN ({_UNKNOWN}) THEN 'U' WHEN regexp_matches(raw, '\.{{4,}}') THEN 'L' ELSE 'T' END AS kind FROM cells),
solid AS (SELECT *, lead(pos) OVER (PARTITION BY id ORDER BY pos) AS next_pos, lead(kind) OVER (PARTITION BY id ORDER BY pos) AS next_kind, lead(cell) OVER (PARTITION BY id ORDER BY pos) AS next_cell FROM kinds WHERE kind <> 'B'),
answers AS (SELECT f.id, f.debtor, f.pos, f.cell = 'Yes' AS related, min(a.pos) AS a1 FROM kinds f LEFT JOIN kinds a ON a.id = f.id AND a.kind IN ('M', 'U') AND a.pos BETWEEN f.pos + 1 AND f.pos + 4 WHERE f.kind = 'F' GROUP BY ALL),
priced AS (SELECT r.*, s.cell AS c1, CASE WHEN s.next_kind IN ('M', 'U') THEN s.next_cell END AS c2, CASE WHEN r.a1 IS NULL THEN r.pos WHEN s.next_kind IN ('M', 'U') THEN s.next_pos ELSE r.a1 END AS stop
  FROM answers r LEFT JOIN solid s ON s.id = r.id AND s.pos = r.a1),
spans AS (SELECT *, coalesce(lag(stop) OVER (PARTITION BY id ORDER BY pos), 0) AS start, row_number() OVER (PARTITION BY id ORDER BY pos) AS row_no FROM priced),
held AS (SELECT s.id, s.pos AS place, k.pos, k.cell FROM spans s JOIN kinds k ON k.id = s.id AND k.pos > s.start AND k.pos < s.pos AND k.kind IN ('T', 'U')
  WHERE s.a1 IS NOT NULL AND NOT (k.cell IN ('$', '#') OR (regexp_matches(k.cell, '[A-Za-z]') AND len(list_filter(regexp_extract_all(lower(k.cell), '[a-z]+'), lambda w: w NOT IN ({_WORDS}))) = 0))
    AND NOT (s.row_no = 1 AND regexp_matches(k.cell, '^(\d{{1,4}}|[A-Z]\.?|[ivxlc]+\.?|Page \d+.*)$')) AND NOT regexp_matches(lower(k.cell), '{"|".join(HEADINGS)}') AND NOT regexp_matches(k.cell, '(?i)^({SECTION_LABELS})\b')),
named AS (SELECT id, place, list(cell ORDER BY pos) AS c FROM held GROUP BY ALL),
amounts AS (SELECT s.*, trim(regexp_replace(n.c[1], '(?i)[\s,]*\bc/[-o]\s*$', '')) AS creditor_name, nullif(array_to_string(n.c[2:], ' '), '') AS address,
    coalesce(try_cast(regexp_replace(c1, '[$,\s]', '', 'g') AS DECIMAL(18, 2)), 0) AS v1, coalesce(try_cast(regexp_replace(c2, '[$,\s]', '', 'g') AS DECIMAL(18, 2)), 0) AS v2 FROM spans s JOIN named n ON n.id = s.id AND n.place = s.pos),
cell_found AS (SELECT id, creditor_name, address, related AS related_party, CASE WHEN v2 > 0 THEN v2 ELSE v1 END AS amount, v1 > 0 OR v2 > 0 AS amount_known FROM amounts
  WHERE regexp_matches(creditor_name, '[A-Za-z]{{3}}') AND NOT regexp_matches(creditor_name, '(?i)^({NO_CREDITOR})') AND NOT ends_with(creditor_name, ':') AND regexp_matches(creditor_name, {_LIKE_NAME}) AND {_no_debtor('creditor_name')})
"""


def _lines_sql(pages: str) -> str:
    """The rows of pages with a row per line, each judged by itself."""
    amount = r"\$?\s*(\d{1,3}(?:,\d{3})+(?:\.\d{2})?|\d+\.\d{2})\s*$"
    return rf"""
raws AS (SELECT id, debtor, trim(regexp_replace(unnest(lines), '\s+', ' ', 'g')) AS line FROM {pages}),
heads AS (SELECT id, debtor, try_cast(replace(regexp_extract(line, '{amount}', 1), ',', '') AS DECIMAL(18, 2)) AS amount, regexp_replace(regexp_replace(regexp_replace(line, '{amount}', ''), '^[ .|-]+', ''), '[ .|-]+$', '') AS head FROM raws
  WHERE regexp_matches(line, '{amount}') AND NOT regexp_matches(line, '\.{{4,}}') AND NOT regexp_matches(line, '(?i)^({SKIPPED_LINES})')),
rows_only AS (SELECT * FROM heads WHERE length(head) <= 90 AND length(head) - length(replace(head, ' ', '')) <= 12 AND NOT regexp_matches(regexp_replace(head, '[ .,;:]+$', ''), '(?i)\b({PROSE_ENDS})$')
  AND NOT regexp_matches(head, '(?i)^({NO_CREDITOR})|:\s*$') AND regexp_matches(head, {_LIKE_NAME}) AND regexp_matches(head, '[A-Za-z]{{3}}')),
bare AS (SELECT id, debtor, amount, lower(regexp_extract(head, '(?i)\b(yes|no)\b', 1)) = 'yes' AS related_party, regexp_replace(regexp_replace(regexp_replace(head, '(?i)\b(yes|no)\b', '', 'g'), '^[ .|,-]+', ''), '[ .|,-]+$', '') AS head FROM rows_only),
cut AS (SELECT *, CASE WHEN regexp_matches(head, '\s\d+[/-]?\d*\s+[A-Z]') THEN length(regexp_extract(head, '^(.*?)\s\d+[/-]?\d*\s+[A-Z]', 1)) ELSE 0 END AS cut_at FROM bare),
parted AS (SELECT id, debtor, amount, related_party, trim(regexp_replace(CASE WHEN cut_at > 3 THEN trim(substr(head, 1, cut_at)) ELSE head END, '(?i)[\s,]*\bc/[-o]\s*$', '')) AS creditor_name, CASE WHEN cut_at > 3 THEN trim(substr(head, cut_at + 1)) END AS address FROM cut),
line_found AS (SELECT id, creditor_name, address, related_party, amount, true AS amount_known FROM parted WHERE length(creditor_name) >= 3 AND {_no_debtor('creditor_name')})
"""


def _gate_sql(lines: str) -> str:
    count = lambda p: f"CAST(len(list_filter({lines}, lambda x: regexp_matches(x, '{p}'))) AS INTEGER)"
    return rf"""{count(r'^\s*(?i:yes|no)\s*$')} AS n_yes_no, {count(rf'^\s*{_AMOUNT}\s*$')} AS n_money, {count(rf'^\s*\S.*?\b(?i:yes|no)\b[\s.|-]*{_AMOUNT}\s*$')} AS n_inline"""


_LISTED = "(has_heading AND n_yes_no >= 2) OR (n_yes_no >= 2 AND n_money >= 2) OR (has_heading AND n_inline >= 2)"


def queries() -> dict:
    fs = (parse_cells_pages, parse_lines_pages, layout_choice, page_gate, document_survey)
    return {f.__name__: f for f in fs}


def oracle_sql() -> dict[str, str]:
    summed = lambda source, more="": f"SELECT creditor_name, address, related_party, amount_known, {more} count(*) AS n, CAST(sum(amount) AS DOUBLE) AS total FROM {source} GROUP BY ALL"
    heading = "|".join(HEADINGS)
    doc_lines = r"string_split_regex(replace(coalesce(text, ''), chr(9), chr(10)), '\r?\n')"
    gate = f"WITH g AS (SELECT doc_id, doc_type, {_gate_sql(doc_lines)}, regexp_matches(lower(coalesce(text, '')), '{heading}') AS has_heading FROM documents), l AS (SELECT *, {_LISTED} AS is_listing FROM g)"
    cell_pages, row_pages = _page_sql("cell_pages", "placed WHERE length(debtor) % 2 = 0", _CELL_LINES, TOP, BOTTOM), _page_sql("row_pages", "placed WHERE length(debtor) % 2 = 1", _ROW_LINES, TOP[2:3], ("Total 1,234.00",))
    listed = lambda pages: f"{pages}_gated AS (SELECT *, {_gate_sql('lines')}, true AS has_heading FROM {pages}), {pages}_listed AS (SELECT * FROM {pages}_gated WHERE {_LISTED})"
    return {
        "parse_cells_pages": f"WITH {_DEBTS}, {_page_sql('pages', 'placed', _CELL_LINES, TOP, BOTTOM)}, {_cells_sql('pages')} {summed('cell_found')}",
        "parse_lines_pages": f"WITH {_DEBTS}, {_page_sql('pages', 'placed', _ROW_LINES, TOP[2:3], ('Total 1,234.00',))}, {_lines_sql('pages')} {summed('line_found')}",
        "layout_choice": f"""WITH {_DEBTS}, {cell_pages}, {row_pages}, {listed('cell_pages')}, {listed('row_pages')}, {_cells_sql('cell_pages_listed')}, {_lines_sql('row_pages_listed')},
mixed AS (SELECT *, 'cells' AS layout FROM cell_found UNION ALL SELECT *, 'lines' AS layout FROM line_found) {summed('mixed', 'layout,')}""",
        "page_gate": f"{gate} SELECT doc_id, n_yes_no, n_money, n_inline, has_heading, is_listing FROM l",
        "document_survey": f"{gate} SELECT doc_type, count(*) AS n, count(*) FILTER (is_listing) AS n_listing, max(n_yes_no) AS most_answers, max(n_money) AS most_amounts, round(count(*) FILTER (is_listing) / count(*) * 100, 4) AS percent FROM l GROUP BY 1",
    }
