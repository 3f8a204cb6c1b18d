"""Links, labels, titles and tables out of markup, as Columns; tables by a parser in Arrow batches."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from debtloom.functions.canon import date_canon
from debtloom.functions.text import abn_valid, html_text


def link_targets(html: Column) -> Column:
    """The targets of a page's links in order."""
    return F.regexp_extract_all(html, F.lit(r"""(?i)<a\b[^>]*?\bhref\s*=\s*["']([^"']*)["']"""), F.lit(1))


def title(html: Column) -> Column:
    return F.nullif(html_text(F.regexp_extract(html, r"(?is)<title[^>]*>(.*?)</title>", 1)), F.lit(""))


def business_number(html: Column) -> Column:
    """An eleven-digit number in the title, else the first in the text whose checksum holds."""
    candidates = lambda t: F.transform(F.regexp_extract_all(t, F.lit(r"(\d{2}\s?\d{3}\s?\d{3}\s?\d{3})(?!\d)"), F.lit(1)), lambda x: F.regexp_replace(x, r"\s", ""))
    return F.coalesce(F.get(candidates(title(html)), F.lit(0)), F.get(F.filter(candidates(html_text(html)), abn_valid), F.lit(0)))


def label_values(html: Column, labels: Sequence[str]) -> Column:
    """A map of each label to the text behind it, up to the next known label or the end."""
    text = html_text(html)
    known = "|".join(re.escape(x) for x in labels)
    value = lambda x: F.trim(F.regexp_extract(text, rf"(?s)\b{re.escape(x)}:\s*(.*?)\s*(?=\b(?:{known}):|$)", 1))
    return F.map_from_arrays(F.lit(list(labels)), F.array(*[value(x) for x in labels]))


class _Tables(HTMLParser):
    """Rows of tables: ``[table, cells, is_header, href]``."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.rows: list[list] = []
        self.table, self.cell = -1, None

    def handle_starttag(self, tag, attrs):
        if tag == "table":
            self.table += 1
        elif tag == "tr":
            self.rows.append([max(self.table, 0), [], False, None])
        elif tag in ("td", "th") and self.rows:
            self.rows[-1][1].append("")
            self.rows[-1][2] |= tag == "th"
            self.cell = True
        elif tag == "a" and self.cell and self.rows[-1][3] is None:
            self.rows[-1][3] = dict(attrs).get("href")

    def handle_endtag(self, tag):
        if tag in ("td", "th"):
            self.cell = None

    def handle_data(self, data):
        if self.cell and self.rows and self.rows[-1][1]:
            self.rows[-1][1][-1] += data


def table_rows(pages: DataFrame, page_id: str, html: str) -> DataFrame:
    """``page_id, table_no, row_no, cells, is_header, href`` of every table row of every page; ``href`` is the row's first link."""
    only = pages.select(F.col(page_id).alias("p"), F.coalesce(html, F.lit("")).alias("h"))
    kinds = {"table_no": pa.int32(), "row_no": pa.int32(), "cells": pa.list_(pa.string()), "is_header": pa.bool_(), "href": pa.string()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, rows = [], []
            for i, page in enumerate(batch.column(1).to_pylist()):
                parser = _Tables()
                parser.feed(page)
                for n, (table, cells, header, href) in enumerate(parser.rows):
                    at.append(i)
                    rows.append((table, n, [re.sub(r"\s+", " ", x).strip() for x in cells], header, href))
            cols = list(zip(*rows)) if rows else [[] for _ in kinds]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at, pa.int64())), *[pa.array(list(c), k) for c, k in zip(cols, kinds.values())]], ["p", *kinds])

    return only.mapInArrow(run, f"p {only.schema['p'].dataType.simpleString()}, table_no int, row_no int, cells array<string>, is_header boolean, href string").withColumnRenamed("p", page_id)


def headed_rows(pages: DataFrame, page_id: str, html: str, needles: Sequence[tuple[str, str]], required: str) -> DataFrame:
    """``page_id, table_no, row_no``, a column per field, ``row_text`` and ``href``: rows of tables whose heading cells tell what is in a column.

    A heading means the field of the first of ``needles`` (text, field) that it holds; of columns that mean one field the first with a value counts. Tables
    without a column for ``required``, and rows without a value in it, are left out.
    """
    rows = table_rows(pages, page_id, html)
    means = lambda h: F.coalesce(*[F.when(F.lower(h).contains(n), F.lit(f)) for n, f in needles], F.lit(""))
    heads = rows.where("is_header").groupBy(page_id, "table_no").agg(F.transform(F.min_by("cells", "row_no"), means).alias("fields")).where(F.array_contains("fields", required))
    body = rows.where("not is_header").join(heads, [page_id, "table_no"])
    value = lambda f: F.get(F.filter(F.zip_with("fields", "cells", lambda k, c: F.when((k == f) & (c != ""), c)), lambda c: c.isNotNull()), F.lit(0))
    fields = list(dict.fromkeys(f for _, f in needles))
    return body.select(page_id, "table_no", "row_no", *[value(f).alias(f) for f in fields], F.array_join("cells", " ").alias("row_text"), "href").where(F.col(required).isNotNull())


def links(html: Column) -> Column:
    """The links of a page in order, as ``href`` and ``name``, the text between the tags."""
    tags = F.regexp_extract_all(html, F.lit(r"(?is)<a\b[^>]*?\bhref\s*=\s*[\"'][^\"']*[\"'][^>]*>.*?</a>"), F.lit(0))
    return F.transform(tags, lambda t: F.struct(F.regexp_extract(t, r"""(?is)\bhref\s*=\s*["']([^"']*)["']""", 1).alias("href"), F.coalesce(html_text(t), F.lit("")).alias("name")))


def file_links(pages: DataFrame, page_id: str, html: str, path: str) -> DataFrame:
    """``file_id, name, page_id``: files that links with ``path`` in them lead to, by their 32 hex digits; the first named link of a file counts."""
    each = pages.select(F.col(page_id), F.posexplode(links(F.col(html))).alias("pos", "link"))
    found = each.select(page_id, "pos", F.lower(F.regexp_extract("link.href", "([0-9A-Fa-f]{32})", 1)).alias("file_id"), F.col("link.name").alias("name"), F.lower("link.href").contains(path).alias("wanted"))
    named = found.where("wanted and file_id != '' and name != ''")
    return named.groupBy("file_id").agg(F.min(F.struct(page_id, "pos", "name")).alias("m")).select("file_id", "m.name", F.col(f"m.{page_id}").alias(page_id))


def document_links(pages: DataFrame, page_id: str, html: str, kinds: Sequence[str], only_kinds: bool = False) -> DataFrame:
    """``page_id, href, name, rank, pos``: links to PDF files; ``rank`` is the first of ``kinds`` in the name, their number for none; with ``only_kinds`` those of a kind."""
    each = pages.select(F.col(page_id), F.posexplode(links(F.col(html))).alias("pos", "link")).select(page_id, "pos", "link.href", "link.name")
    pdf = each.where(F.split_part("href", F.lit("?"), F.lit(1)).rlike(r"(?i)/.+\.pdf$"))
    rank = F.coalesce(*[F.when(F.lower("name").contains(k), F.lit(i)) for i, k in enumerate(kinds)], F.lit(len(kinds)))
    ranked = pdf.select(page_id, "href", "name", rank.alias("rank"), "pos")
    return ranked.where(F.col("rank") < len(kinds)) if only_kinds else ranked


def form_rows(pages: DataFrame, page_id: str, html: str, form: str) -> DataFrame:
    """``page_id, doc_number, lodged``: of each page the first row that names a form, with the first run of nine to twelve digits and the first cell that is a date."""
    rows = table_rows(pages, page_id, html).where(F.array_join("cells", " ").rlike(rf"\b{form}\b"))
    first = rows.groupBy(page_id).agg(F.min_by("cells", "row_no").alias("cells"))
    numbers = F.transform("cells", lambda c: F.nullif(F.regexp_extract(c, r"\b(\d{9,12})\b", 1), F.lit("")))
    dates = F.transform("cells", date_canon)
    return first.select(page_id, F.coalesce(F.get(F.array_compact(numbers), F.lit(0)), F.lit("")).alias("doc_number"), F.get(F.array_compact(dates), F.lit(0)).alias("lodged"))


#: Signs of a page that asks to log in.
LOGIN_SIGNS = ('type="password"', "type='password'", "sign in", "log in", "login", "forgot your password")


def asks_to_log_in(html: Column) -> Column:
    """Whether a page has two signs or more of a login."""
    low = F.lower(F.coalesce(html, F.lit("")))
    return sum((low.contains(s).cast("int") for s in LOGIN_SIGNS), F.lit(0)) >= 2
