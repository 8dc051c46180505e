"""Workbook feeds (blacklist, terminals): XLSX files read as a Spark job.

Spark has no XLSX source, so each file arrives whole through ``binaryFile``
and ``mapInPandas`` turns its first sheet into rows inside an executor task,
with the standard library's ``zipfile`` and ``xml.etree``. Files spread
over tasks; typing and naming of columns then happen in Spark expressions.
"""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fraudlake.functions.expr import base_name, file_date

NS = {"m": "http://schemas.openxmlformats.org/spreadsheetml/2006/main"}
ROWS_SCHEMA = "file_name string, row_idx int, cells array<string>, error string"
# Fixed value: day 0 of workbook date serials (1900 date system).
SERIAL_EPOCH = "1899-12-30"


def _col_index(ref: str) -> int:
    letters = re.match(r"[A-Z]+", ref).group(0)
    n = 0
    for ch in letters:
        n = n * 26 + (ord(ch) - 64)
    return n - 1


def _text(el) -> str:
    return "".join(t.text or "" for t in el.iter(f"{{{NS['m']}}}t"))


def _first_sheet(z: zipfile.ZipFile, names: list[str]) -> str:
    """Part name of the workbook's first sheet, by its own list of sheets; a
    file without that list: the sheet part with the lowest number."""
    rel = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"
    if "xl/workbook.xml" in names and "xl/_rels/workbook.xml.rels" in names:
        first = ElementTree.fromstring(z.read("xl/workbook.xml")).find("m:sheets/m:sheet", NS)
        targets = {r.get("Id"): r.get("Target")
                   for r in ElementTree.fromstring(z.read("xl/_rels/workbook.xml.rels"))}
        target = targets.get(first.get(rel)) if first is not None else None
        if target:
            part = target.lstrip("/") if target.startswith("/") else f"xl/{target}"
            if part in names:
                return part
    parts = [n for n in names if re.match(r"xl/worksheets/sheet\d+\.xml$", n)]
    return min(parts, key=lambda n: int(re.search(r"\d+", n.rsplit("/", 1)[1]).group(0)))


def iter_sheet_rows(content: bytes) -> Iterator[list[str | None]]:
    """Cell texts of the first worksheet, row by row (numbers as written).

    The sheet XML is parsed as a stream and each row's cells are freed once
    read; what stays is one empty element a row.
    """
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        names = z.namelist()
        shared: list[str] = []
        if "xl/sharedStrings.xml" in names:
            root = ElementTree.fromstring(z.read("xl/sharedStrings.xml"))
            shared = [_text(si) for si in root.findall("m:si", NS)]
        sheet = _first_sheet(z, names)
        row_tag = f"{{{NS['m']}}}row"
        with z.open(sheet) as f:
            for _, row in ElementTree.iterparse(f, events=("end",)):
                if row.tag != row_tag:
                    continue
                cells: dict[int, str | None] = {}
                at = -1
                for c in row.findall("m:c", NS):
                    at = _col_index(c.get("r")) if c.get("r") else at + 1   # the place may be left out
                    kind, v = c.get("t"), c.find("m:v", NS)
                    if kind == "s" and v is not None:
                        val = shared[int(v.text)]
                    elif kind == "inlineStr":
                        val = _text(c)
                    else:
                        val = v.text if v is not None else None
                    cells[at] = val
                row.clear()
                width = max(cells) + 1 if cells else 0
                yield [cells.get(i) for i in range(width)]


def sheet_rows(content: bytes) -> list[list[str | None]]:
    return list(iter_sheet_rows(content))


def _decode(batches: Iterator[pd.DataFrame], chunk: int = 10_000) -> Iterator[pd.DataFrame]:
    cols = ["file_name", "row_idx", "cells", "error"]
    for b in batches:
        for path, content in zip(b["path"], b["content"]):
            name = path.rsplit("/", 1)[-1]
            recs = []
            try:
                for i, cells in enumerate(iter_sheet_rows(bytes(content))):
                    recs.append((name, i, cells, None))
                    if len(recs) >= chunk:
                        yield pd.DataFrame(recs, columns=cols)
                        recs = []
            except (zipfile.BadZipFile, ElementTree.ParseError, KeyError, IndexError, ValueError) as e:
                recs.append((name, -1, None, f"{type(e).__name__}: {e}"[:200]))   # the file is refused as a whole
            if recs:
                yield pd.DataFrame(recs, columns=cols)


def read_rows(spark: SparkSession, path_glob: str) -> DataFrame:
    """``file_name, row_idx, cells, error`` for every row of every matching
    workbook; a file that cannot be read has a row with ``error``."""
    files = spark.read.format("binaryFile").load(path_glob).select("path", "content")
    return files.mapInPandas(_decode, ROWS_SCHEMA)


def cell_date(c) -> F.Column:
    """A date cell: a workbook serial number or ``yyyy-MM-dd`` text."""
    serial = c.try_cast("double")
    from_serial = F.date_add(F.lit(SERIAL_EPOCH).cast("date"), F.floor(serial).cast("int"))
    from_text = F.try_to_date(F.substring(c, 1, 10), "yyyy-MM-dd")
    return F.when(serial.isNotNull(), from_serial).otherwise(from_text).cast("timestamp_ntz")


def _split(rows: DataFrame, names: list[str], reason) -> tuple[DataFrame, DataFrame]:
    """``(good, rejects)``: rows bound to ``names``, and ``(file_name, reason,
    raw)`` of rows that ``reason`` refuses and of unreadable files."""
    x = rows.filter((F.col("row_idx") > 0) | F.col("error").isNotNull()).select(
        "file_name", "error", F.concat_ws(";", "cells").alias("raw"),
        *[F.trim(F.get("cells", F.lit(i))).alias(n) for i, n in enumerate(names)])
    x = x.withColumn("reason", F.when(F.col("error").isNotNull(), F.concat(F.lit("unreadable file: "), F.col("error")))
                     .when(F.col("raw") != "", reason))
    broken = x.filter(F.col("error").isNotNull()).select("file_name").distinct()
    bad = x.filter(F.col("reason").isNotNull()).select("file_name", "reason", "raw")
    good = x.filter(F.col("reason").isNull() & (F.col("raw") != "")).join(broken, "file_name", "left_anti")
    return good.select("file_name", *names), bad


def split_blacklist(spark: SparkSession, path_glob: str) -> tuple[DataFrame, DataFrame]:
    """``(entry_dt, passport, file_name)`` and the refused rows."""
    blank = lambda n: F.coalesce(F.col(n), F.lit("")) == ""
    reason = F.when(blank("passport"), "missing passport").when(cell_date(F.col("date")).isNull(), "bad date")
    good, bad = _split(read_rows(spark, path_glob), ["date", "passport"], reason)
    return good.select(cell_date(F.col("date")).alias("entry_dt"), "passport", "file_name"), bad


def read_blacklist(spark: SparkSession, path_glob: str) -> DataFrame:
    """``entry_dt, passport`` (+ ``file_name``) from blacklist workbooks."""
    return split_blacklist(spark, path_glob)[0]


def split_terminals(spark: SparkSession, path_glob: str) -> tuple[DataFrame, DataFrame]:
    """The terminal slice, with ``update_dt`` from the file name's date, and
    the refused rows."""
    reason = F.when(F.coalesce(F.col("terminal_id"), F.lit("")) == "", "missing terminal_id")
    good, bad = _split(read_rows(spark, path_glob),
                       ["terminal_id", "terminal_type", "terminal_city", "terminal_address"], reason)
    return good.select("terminal_id", "terminal_type", "terminal_city", "terminal_address",
                       file_date(base_name("file_name")).alias("update_dt"), "file_name"), bad


def read_terminals(spark: SparkSession, path_glob: str) -> DataFrame:
    return split_terminals(spark, path_glob)[0]
