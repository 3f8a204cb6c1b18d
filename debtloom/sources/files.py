"""Landed files as tables: JSON state, CSV with a header to be found, spreadsheets, an inbox of documents."""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator, Mapping, Sequence
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from debtloom.functions.text import file_stem, header_key


class SchemaAlarm(ValueError):
    """A file that doesn't have the columns it must have; what was there instead is in the message."""


def json_rows(spark: SparkSession, path: str, schema: T.StructType, broken: str | None = None) -> DataFrame:
    """A JSON array of records under an explicit schema; an absent path is an empty table.

    A broken record raises; with ``broken`` it stays as a row of nulls whose text is in the column of that name, so that nothing is lost unseen.
    """
    reader = spark.read.option("multiLine", True)
    try:
        if broken is None:
            return reader.schema(schema).option("mode", "FAILFAST").json(path)
        return reader.schema(T.StructType([*schema, T.StructField(broken, T.StringType())])).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", broken).json(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e):
            return spark.createDataFrame([], T.StructType([*schema, T.StructField(broken, T.StringType())]) if broken else schema)
        raise


def json_map(spark: SparkSession, path: str, key: str, schema: T.StructType) -> DataFrame:
    """A JSON object of records by key, one row per key; an absent path is an empty table."""
    wanted = T.StructType([T.StructField(key, T.StringType())] + [f for f in schema if f.name != key])
    try:
        text = spark.read.text(path, wholetext=True)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e):
            return spark.createDataFrame([], wanted)
        raise
    each = text.select(F.explode(F.from_json("value", T.MapType(T.StringType(), schema))).alias("__k", "__v"))
    return each.select(F.col("__k").alias(key), *[F.col(f"__v.{f.name}").alias(f.name) for f in schema if f.name != key])


def write_state(df: DataFrame, path: str) -> None:
    """State overwritten whole; written beside first, since its input may be the same path."""
    from debtloom.session import settle

    settle(df, "state").write.mode("overwrite").json(path)


def find_header(rows: Sequence[Sequence[str | None]], aliases: Mapping[str, str], required: str, least: int = 2) -> tuple[int, dict[str, int]]:
    """The first row with ``least`` known headings, the ``required`` one among them: its number and the column of each field, the first wins."""
    for n, row in enumerate(rows):
        found: dict[str, int] = {}
        for i, cell in enumerate(row):
            field = aliases.get(re.sub(r"[^a-z0-9]+", " ", (cell or "").lower()).strip())
            if field and field not in found:
                found[field] = i
        if len(found) >= least and required in found:
            return n, found
    raise SchemaAlarm(f"no heading row among {[list(r)[:8] for r in rows[:5]]}")


def csv_table(spark: SparkSession, path: str, aliases: Mapping[str, str], required: str, within: int = 5) -> DataFrame:
    """A CSV whose heading is among its first rows, as the fields of ``aliases`` (folded heading -> field); other columns are ignored."""
    raw = spark.read.option("header", False).option("multiLine", True).option("encoding", "UTF-8").csv(path)
    top = [[None if c is None else str(c).lstrip("﻿") for c in r] for r in raw.limit(within).collect()]
    at, found = find_header(top, aliases, required)
    heading = top[at]
    same = [F.coalesce(F.regexp_replace(F.col(raw.columns[i]), "^﻿", ""), F.lit("")) == F.lit(heading[i] or "") for i in found.values()]
    is_heading = same[0]
    for s in same[1:]:
        is_heading &= s
    before = [tuple(r) for r in top[:at]]
    rows = raw.where(~is_heading)
    for r in before:  # titles above the heading
        cond = F.lit(True)
        for c, v in zip(raw.columns, r):
            cond &= F.regexp_replace(F.col(c), "^﻿", "").eqNullSafe(F.lit(v))
        rows = rows.where(~cond)
    return rows.select(*[F.col(raw.columns[i]).alias(f) for f, i in found.items()])


#: Headings of columns that hold a company's name, and words of those that only seem to.
NAME_HEADINGS = ("client name", "policy name", "company name", "insured", "insured name", "policy holder", "policyholder", "policy holder name", "name", "client")
NO_NAMES = ("contact", "first", "surname", "email")


def name_columns(heading: Sequence[str | None], known: Sequence[str] = NAME_HEADINGS, barred: Sequence[str] = NO_NAMES) -> list[int]:
    """The columns that hold names: those headed exactly so, else those whose heading has such words and none that is barred."""
    folded = [(h or "").strip().lower().replace("_", " ").lstrip("\ufeff") for h in heading]
    exact = [i for i, h in enumerate(folded) if h in known]
    return exact or [i for i, h in enumerate(folded) if any(k in h for k in known) and not any(b in h for b in barred)]


def policy_names(spark: SparkSession, path: str, within: int = 5) -> DataFrame:
    """``original``: the names in every name column of a policy list in CSV, whose heading is one of its first rows; blanks are left out."""
    raw = spark.read.option("header", False).option("multiLine", True).option("encoding", "UTF-8").csv(path)
    top = [tuple(r) for r in raw.limit(within).collect()]
    for at, row in enumerate(top):
        found = name_columns(list(row))
        if found:
            rows = raw
            for above in top[: at + 1]:  # titles and the heading itself
                same = F.lit(True)
                for c, v in zip(raw.columns, above):
                    same &= F.col(c).eqNullSafe(F.lit(v))
                rows = rows.where(~same)
            return rows.select(F.explode(F.array(*[F.trim(raw.columns[i]) for i in found])).alias("original")).where("length(original) > 0")
    raise SchemaAlarm(f"no column of names in the first {within} rows")


_NS = {"m": "http://schemas.openxmlformats.org/spreadsheetml/2006/main"}


def sheets_of(content: bytes) -> dict[str, list[list[str | None]]]:
    """The cells of every sheet of a workbook as text, by sheet name in order."""
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        shared: list[str] = []
        if "xl/sharedStrings.xml" in z.namelist():
            shared = ["".join(t.text or "" for t in si.iter(f"{{{_NS['m']}}}t")) for si in ElementTree.fromstring(z.read("xl/sharedStrings.xml")).findall("m:si", _NS)]
        rels = {r.get("Id"): r.get("Target") for r in ElementTree.fromstring(z.read("xl/_rels/workbook.xml.rels"))}
        out: dict[str, list[list[str | None]]] = {}
        for sheet in ElementTree.fromstring(z.read("xl/workbook.xml")).iter(f"{{{_NS['m']}}}sheet"):
            target = rels[sheet.get("{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id")].lstrip("/")
            root = ElementTree.fromstring(z.read(target if target.startswith("xl/") else f"xl/{target}"))
            rows: list[list[str | None]] = []
            for row in root.iter(f"{{{_NS['m']}}}row"):
                cells: list[str | None] = []
                for c in row.findall("m:c", _NS):
                    col = 0
                    for ch in re.match("[A-Z]+", c.get("r", "A"))[0]:
                        col = col * 26 + ord(ch) - 64
                    cells += [None] * (col - 1 - len(cells))
                    v = c.find("m:v", _NS)
                    text = "".join(t.text or "" for t in c.iter(f"{{{_NS['m']}}}t")) if c.get("t") == "inlineStr" else (None if v is None else v.text)
                    cells.append(shared[int(text)] if c.get("t") == "s" and text is not None else text)
                rows.append(cells)
            out[sheet.get("name")] = rows
        return out


def pick_sheet(names: Sequence[str], wanted: Sequence[str]) -> str:
    """The first wanted name, else the first name with "data" in it."""
    for w in wanted:
        for n in names:
            if n.strip().lower() == w.lower():
                return n
    for n in names:
        if "data" in n.lower():
            return n
    raise SchemaAlarm(f"no sheet of {list(wanted)} among {list(names)}")


def xlsx_table(spark: SparkSession, path: str, aliases: Mapping[str, str], required: str, sheets: Sequence[str] = (), within: int = 25) -> DataFrame:
    """Spreadsheets under ``path`` as one table of text: ``file`` and the fields; each file's heading is found by its content."""
    fields = sorted(set(aliases.values()))
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.xlsx").load(path).select("path", "content")

    def read(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for file, content in zip(part["path"], part["content"]):
                book = sheets_of(content)
                rows = book[pick_sheet(list(book), sheets)]
                at, found = find_header(rows[:within], aliases, required)
                out = [[file, *[(r[found[f]] if f in found and found[f] < len(r) else None) for f in fields]] for r in rows[at + 1 :]]
                yield pd.DataFrame([r for r in out if any(x is not None for x in r[1:])], columns=["file", *fields])

    return files.mapInPandas(read, "file string, " + ", ".join(f"`{f}` string" for f in fields))


def describe_headers(df: DataFrame, aliases: Mapping[str, str]) -> DataFrame:
    """Which headings of a table are mapped to which field, and which to none."""
    spark = df.sparkSession
    heads = spark.createDataFrame([(c,) for c in df.columns], "heading string").withColumn("folded", header_key(F.col("heading")))
    known = spark.createDataFrame(list(aliases.items()), "folded string, field string") if aliases else spark.createDataFrame([], "folded string, field string")
    return heads.join(known, "folded", "left").select("heading", "field")


#: Names that an inbox is listed for at most.
MAX_INBOX = 1_000_000


def inbox(spark: SparkSession, path: str, glob: str = "*.pdf") -> DataFrame:
    """``path, matter_id, length, status`` of an inbox's documents in the order of their names, from its listing; no content is read.

    A scan of contents would pass over empty files, which are ``missing`` here.
    """
    where = spark._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/{glob}")
    listed = where.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(where) or []
    if len(listed) > MAX_INBOX:
        raise ValueError(f"more than {MAX_INBOX} documents")
    rows = sorted((f.getPath().toString(), f.getLen()) for f in listed if f.isFile())
    files = spark.createDataFrame(rows, "path string, length bigint")
    return files.select("path", file_stem(F.col("path")).alias("matter_id"), "length", F.when(F.col("length") == 0, "missing").otherwise("present").alias("status"))


def document_status(pages: DataFrame, doc: str, text: str, is_listing: str, rows: str) -> DataFrame:
    """One status a document from its pages: ``scanned`` without text, ``no-section`` without a listing, ``table-unreadable`` without rows, else ``ok``."""
    per = pages.groupBy(doc).agg(F.max(F.length(F.trim(F.coalesce(text, F.lit(""))))).alias("n"), F.bool_or(is_listing).alias("l"), F.sum(F.coalesce(rows, F.lit(0))).alias("r"))
    return per.select(doc, F.when(F.col("n") == 0, "scanned").when(~F.coalesce("l", F.lit(False)), "no-section").when(F.col("r") == 0, "table-unreadable").otherwise("ok").alias("status"), F.col("r").alias("n_rows"))
