"""Creditor listings out of the text of pages: the gate, both layouts, and what is no creditor."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from debtloom.functions.text import cut_address, looks_like_name, name_key, trailing_amount

#: Phrases that head a listing, and cells that stand for an amount nobody knows.
HEADINGS = ("listing of known creditors", "list of creditors", "schedule of debts and claims")
UNKNOWN_AMOUNTS = ("tbc", "t.b.c", "t.b.c.", "unknown", "unquantified", "n/a", "na", "nil", "-", "–", "—")
#: Words of column headings; a cell of nothing else is a heading.
HEADER_WORDS = (
    "rocap identified estimated claimed stated amount amounts owed name names address related party parties creditor creditors type return balance total subtotal value debt claim yes no and or of "
    "debit credit gst net nett date ref reference code days aged current opening closing movement invoice unsecured secured priority employee employees entitlement entitlements description particulars details"
).split()
#: How rows begin that are no creditors, labels above the first row, lines that are skipped, and words on which prose breaks off.
NO_CREDITOR = (
    "fees?|gst|total|sub-?total|balance|amount|remuneration|disbursements?|petty cash|interest|adjustment|opening|closing|less\\b|add\\b|net\\b|estimated|surplus|deficiency|dividend|distribution|"
    "realisations?|receipts?|payments?|asset|liabilit"
)
SECTION_LABELS = "annexure|schedule|section|appendix|part"
SKIPPED_LINES = r"page \d+|total|sub-?total|continued|annexure|schedule|name\b.*amount"
PROSE_ENDS = "of|to|in|on|at|by|for|from|with|and|or|the|a|an|is|are|was|were|that|this|as|per|under|dated"

_AMOUNT = r"\$?\s*\d{1,3}(?:,\d{3})*(?:\.\d{2})?"
_YES_NO = r"^\s*(?i:yes|no)\s*$"
_MONEY = rf"^\s*{_AMOUNT}\s*$"
_INLINE = rf"^\s*\S.*?\b(?i:yes|no)\b[\s.|-]*{_AMOUNT}\s*$"
_RE_YES_NO, _RE_MONEY, _LEADERS = re.compile(_YES_NO), re.compile(_MONEY), re.compile(r"\.{4,}")
_FURNITURE = re.compile(r"(?:\d{1,4}|[A-Z]\.?|[ivxlc]+\.?|Page \d+.*)")
_LABEL = re.compile(rf"(?:{SECTION_LABELS})\b", re.I)
#: An amount is looked for in so many lines behind an answer, and a row has so many amounts at most.
REACH, MOST_AMOUNTS = 4, 2


def page_counts(text: Column) -> dict[str, Column]:
    """The evidence of a listing: lines that are only yes or no, only an amount, a whole row, and a heading phrase anywhere."""
    lines = F.split(text, r"\r?\n")
    count = lambda p: F.size(F.filter(lines, lambda x: x.rlike(p)))
    return {"n_yes_no": count(_YES_NO), "n_money": count(_MONEY), "n_inline": count(_INLINE), "has_heading": F.lower(text).rlike("|".join(HEADINGS))}


def is_listing(c: dict[str, Column]) -> Column:
    """A heading with two answers, two answers with two amounts, or a heading with two whole rows."""
    return (c["has_heading"] & (c["n_yes_no"] >= 2)) | ((c["n_yes_no"] >= 2) & (c["n_money"] >= 2)) | (c["has_heading"] & (c["n_inline"] >= 2))


def tab_rows(documents: DataFrame, doc_id: str, text: str) -> DataFrame:
    """``doc_id, line_no, creditor_name, address, related_party, amount_aud, amount_known`` of lines of four cells parted by tabs.

    Heading lines are left out; an amount that is no number is unknown and 0. Stays in the JVM; nothing is shuffled.
    """
    lines = documents.select(F.col(doc_id).alias(doc_id), F.posexplode(F.split(text, r"\r?\n")).alias("line_no", "line")).where(F.col("line").contains("\t"))
    cells = lines.select(doc_id, "line_no", F.split("line", "\t").alias("c")).where("size(c) = 4")
    cell = lambda i: F.trim(F.get("c", F.lit(i)))
    amount = F.regexp_replace(cell(3), r"[$,\s]", "").try_cast("decimal(18,2)")
    rows = cells.select(doc_id, "line_no", cell(0).alias("creditor_name"), F.nullif(cell(1), F.lit("")).alias("address"), F.lower(cell(2)).alias("r"), amount.alias("a"))
    return rows.where(F.col("r").isin("yes", "no") & (F.length("creditor_name") > 0)).select(doc_id, "line_no", "creditor_name", "address", (F.col("r") == "yes").alias("related_party"), F.coalesce("a", F.lit(0).cast("decimal(18,2)")).alias("amount_aud"), (F.coalesce("a", F.lit(0)) > 0).alias("amount_known"))


def is_heading_cell(cell: str) -> bool:
    """Whether a cell has nothing but words of column headings, or a lone sign."""
    words = re.findall("[A-Za-z]+", cell)
    return cell in ("$", "#") or (bool(words) and all(w.lower() in HEADER_WORDS for w in words))


def _cell_amount(cell: str) -> float | None:
    """The amount of a cell, 0 for a stated unknown, None for anything else."""
    if _RE_MONEY.match(cell):
        return float(re.sub(r"[$,\s]", "", cell))
    return 0.0 if cell.lower() in UNKNOWN_AMOUNTS else None


def parse_cells(lines: Sequence[str]) -> list[tuple[str, str | None, bool, float, bool]]:
    """Rows of a page with one cell per line: ``(name, address, related, amount, known)``, before it is asked whether they are creditors.

    A yes or no closes the cells of a row. Its amounts stand behind: the first within REACH lines, a second right after it; the last one that isn't zero
    counts, and a row of nothing but zeros and unknowns has no known amount. Without an amount the cells are dropped. Headings and section
    labels are no cells, and neither is the page's furniture above its first row.
    """
    cells = [line.strip() for line in lines]
    rows: list[tuple[str, str | None, bool, float, bool]] = []
    held: list[str] = []
    first, at = True, 0
    while at < len(cells):
        cell, at = cells[at], at + 1
        if not _RE_YES_NO.match(cell):
            if cell and not _RE_MONEY.match(cell) and not _LEADERS.search(cell):
                held.append(cell)
            continue
        start = next((i for i in range(at, min(at + REACH, len(cells))) if _cell_amount(cells[i]) is not None), None)
        if start is not None:
            amounts = [_cell_amount(cells[start])]
            at = start + 1
            while at < len(cells) and len(amounts) < MOST_AMOUNTS and (not cells[at] or _cell_amount(cells[at]) is not None):
                if cells[at]:
                    amounts.append(_cell_amount(cells[at]))
                at += 1
            named = [c for c in held if not (is_heading_cell(c) or (first and _FURNITURE.fullmatch(c)) or any(h in c.lower() for h in HEADINGS) or _LABEL.match(c))]
            if named:
                stated = [a for a in amounts if a]
                rows.append((named[0], " ".join(named[1:]) or None, cell.lower() == "yes", stated[-1] if stated else 0.0, bool(stated)))
        held, first = [], False
    return rows


def without_care_of(name: Column) -> Column:
    """A name without a care-of mark at its end."""
    return F.trim(F.regexp_replace(name, r"(?i)[\s,]*\bc/[-o]\s*$", ""))


def names_debtor(name: Column, debtor: Column) -> Column:
    """Whether a name holds the debtor's own."""
    key = name_key(debtor)
    return (F.length(key) > 0) & name_key(name).contains(key)


def _creditors(rows: DataFrame, debtor: str | None) -> DataFrame:
    """Rows whose name could be a creditor's: letters, a beginning like a name's, no label, no total, not the debtor."""
    name = F.col("creditor_name")
    fine = name.rlike("[A-Za-z]{3}") & ~name.rlike(rf"(?i)^(?:{NO_CREDITOR})") & ~name.endswith(":") & looks_like_name(name)
    return rows.where(fine & ~names_debtor(name, F.col("debtor")) if debtor else fine).drop("debtor")


_ROW = "row_no int, creditor_name string, address string, related_party boolean, amount_aud double, amount_known boolean"


def cell_rows(pages: DataFrame, page_id: str, text: str, debtor: str | None = None) -> DataFrame:
    """Creditors of pages with one cell per line (``parse_cells``), with ``row_no``; pages stream through in Arrow batches.

    ``debtor`` names the column of the insolvent company, whose own name is no creditor's. Null texts have no rows.
    """
    only = pages.select(F.col(page_id).alias("p"), F.coalesce(text, F.lit("")).alias("t"), (F.col(debtor) if debtor else F.lit(None)).cast("string").alias("d"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, rows = [], []
            for i, page in enumerate(batch.column(1).to_pylist()):
                for n, row in enumerate(parse_cells(page.split("\n"))):
                    at.append(i)
                    rows.append((n, *row))
            cols = list(zip(*rows)) if rows else [[] for _ in range(6)]
            kinds = (pa.int32(), pa.string(), pa.string(), pa.bool_(), pa.float64(), pa.bool_())
            places = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(places), batch.column(2).take(places), *[pa.array(list(c), k) for c, k in zip(cols, kinds)]], ["p", "debtor", "row_no", "creditor_name", "address", "related_party", "amount_aud", "amount_known"])

    found = only.mapInArrow(run, f"p {only.schema['p'].dataType.simpleString()}, debtor string, {_ROW}")
    return _creditors(found.withColumn("creditor_name", without_care_of(F.col("creditor_name"))), debtor).withColumnRenamed("p", page_id)


def line_rows(pages: DataFrame, page_id: str, text: str, debtor: str | None = None) -> DataFrame:
    """Creditors of pages with a whole row per line, as in ``cell_rows``: a name, an address from a street number on, an answer, an amount at the end.

    Stays in the JVM: every line is judged by itself. Leaders, totals, labels, prose (a sentence, a small beginning, a broken end) are no rows.
    """
    one = pages.select(F.col(page_id).alias("p"), (F.col(debtor) if debtor else F.lit(None)).cast("string").alias("debtor"), F.posexplode(F.split(text, r"\r?\n")).alias("row_no", "raw"))
    line = one.withColumn("line", F.trim(F.regexp_replace("raw", r"\s+", " "))).withColumn("amount_aud", trailing_amount(F.col("line")))
    line = line.where(F.col("amount_aud").isNotNull() & ~F.col("line").rlike(r"\.{4,}") & ~F.col("line").rlike(rf"(?i)^(?:{SKIPPED_LINES})"))
    bare = lambda c, signs: F.regexp_replace(F.regexp_replace(c, f"^[{signs}]+", ""), f"[{signs}]+$", "")
    head = line.withColumn("head", bare(F.regexp_replace("line", r"\$?\s*(?:\d{1,3}(?:,\d{3})+(?:\.\d{2})?|\d+\.\d{2})\s*$", ""), r" .|\-"))
    prose = (F.length("head") > 90) | (F.regexp_count("head", F.lit(" ")) > 12) | bare(F.col("head"), " .,;:").rlike(rf"(?i)\b(?:{PROSE_ENDS})$")
    head = head.where(~prose & ~F.col("head").rlike(rf"(?i)^(?:{NO_CREDITOR})|:\s*$") & looks_like_name(F.col("head")) & F.col("head").rlike("[A-Za-z]{3}"))
    answer = F.lower(F.regexp_extract("head", r"(?i)\b(yes|no)\b", 1))
    head = head.withColumn("related_party", answer == "yes").withColumn("head", bare(F.regexp_replace("head", r"(?i)\b(?:yes|no)\b", ""), r" .|\-,"))
    name, address = cut_address(F.col("head"))
    rows = head.select("p", "debtor", "row_no", without_care_of(name).alias("creditor_name"), address.alias("address"), "related_party", F.col("amount_aud").cast("double").alias("amount_aud"), F.lit(True).alias("amount_known"))
    rows = rows.where(F.length("creditor_name") >= 3)
    return (rows.where(~names_debtor(F.col("creditor_name"), F.col("debtor"))) if debtor else rows).drop("debtor").withColumnRenamed("p", page_id)


def listing_rows(pages: DataFrame, page_id: str, text: str, debtor: str | None = None) -> DataFrame:
    """Creditors of the pages that are listings: by cells, or by lines where a page's cells give none; ``layout`` tells which.

    Page ids must be unique. What cells give is told by a semi join of ids, so no page is sent twice.
    """
    gated = pages.where(is_listing(page_counts(F.coalesce(text, F.lit("")))))
    cells = cell_rows(gated, page_id, text, debtor).withColumn("layout", F.lit("cells"))
    rest = gated.join(cells.select(page_id).distinct(), page_id, "left_anti")
    return cells.unionByName(line_rows(rest, page_id, text, debtor).withColumn("layout", F.lit("lines")))
