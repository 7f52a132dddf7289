"""Order-line CSV ingest: ';'-separated, header, UTF-8, quoted fields, decimal
comma or point, 'd/M/yyyy H:mm' dates, a folder of files read as one table.

* Columns are bound by name: files are grouped by their header, each group is
  read with its own columns, and the groups are unioned by name. A file without
  a required column fails.
* Fields may be quoted (a doubled quote is a quote) and may hold separators and
  line breaks. Reading line breaks means that one file is one task; pass
  ``multi_line=False`` for deliveries that are known to have none, which then
  split.
* Everything is read as text and converted here, so nothing turns into NULL
  unseen: ``strict`` (the default) fails on a row with a wrong number of fields
  or a price, quantity or customer id that is no number; lenient reads leave
  NULL, and :func:`reject_report` counts the rows by reason.
* Dates are parsed leniently (one-digit day, month and hour accepted); what does
  not parse is NULL in either mode, and counted by the report.
"""

from __future__ import annotations

import csv
import io
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.schemas import CSV_COLUMNS, ORDER_COLUMNS

CORRUPT = "_corrupt_record"
#: Files opened at a time for their headers.
HEADER_READERS = 32
REASONS = ["wrong_fields", "bad_price", "bad_quantity", "bad_customer", "bad_date"]


def reader(spark_reader, columns: Sequence[str], multi_line: bool):
    """A CSV reader of text columns. An unquoted empty field is NULL, a quoted one is empty."""
    schema = ", ".join(f"`{c}` string" for c in [*columns, CORRUPT])
    return (
        spark_reader.schema(schema)
        .option("sep", ";")
        .option("header", True)
        .option("enforceSchema", False)
        .option("encoding", "UTF-8")
        .option("quote", '"')
        .option("escape", '"')
        .option("multiLine", multi_line)
        .option("nullValue", "\u0000")
        .option("emptyValue", "")
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("pathGlobFilter", "*.csv")
    )


def read_raw(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """All CSV files under ``path`` with the required columns as text, and the
    corrupt record if any. An empty or missing folder fails (no silent success)."""
    files = list_files(spark, path, ".csv")
    if not files:
        raise FileNotFoundError(f"no CSV file under {path}")
    by_header: dict[tuple[str, ...], list[str]] = {}
    for f, header in zip(files, read_headers(spark, files)):
        by_header.setdefault(header, []).append(f)
    out = None
    for header, same in sorted(by_header.items()):
        missing = [c for c in CSV_COLUMNS if c not in header]
        if missing:
            raise ValueError(f"missing required columns: {missing} in {same[0]}")
        part = reader(spark.read, header, multi_line).csv(same).select(*(F.col(f"`{c}`") for c in [*CSV_COLUMNS, CORRUPT]))
        out = part if out is None else out.unionByName(part)
    return out


def read_headers(spark: SparkSession, files: Sequence[str]) -> list[tuple[str, ...]]:
    """Column names of each file; many are opened at a time, and only their first
    record is read."""
    with ThreadPoolExecutor(max_workers=HEADER_READERS) as pool:
        return list(pool.map(lambda f: read_header(spark, f), files))


def read_header(spark: SparkSession, file: str) -> tuple[str, ...]:
    """Column names of a file, from its first record (line breaks in quoted names included)."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(file)
    stream = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).open(hpath)
    lines = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8"))
    record = []
    while (line := lines.readLine()) is not None:
        record.append(line)
        if sum(x.count('"') for x in record) % 2 == 0:  # no quote is open
            break
    lines.close()
    text = "\n".join(record).removeprefix("﻿")
    names = next(csv.reader(io.StringIO(text, newline=""), delimiter=";"), [])
    return tuple(n.strip() for n in names)


def list_files(spark: SparkSession, path: str, suffix: str) -> list[str]:
    """File names under ``path`` (sorted), via the cluster file system."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(hpath):
        return []
    out = [s.getPath().toString() for s in fs.listStatus(hpath) if s.isFile()]
    return sorted(p for p in out if p.endswith(suffix))


def _filled(text: Column) -> Column:
    """Trimmed text; blank is NULL."""
    t = F.trim(text)
    return F.when(t != "", t)


def _parsed() -> dict[str, tuple[Column, Column]]:
    """(text, value) of each column that must be a number: the price with a decimal
    comma or point, the quantity, the customer id (also written ``13085.0``)."""
    price, quantity, customer = (_filled(F.col(f"`{c}`")) for c in ("Price", "Quantity", "Customer ID"))
    whole = F.regexp_replace(customer, r"\.0+$", "")
    return {
        "price": (price, F.regexp_replace(price, ",", ".").try_cast("decimal(18,4)")),
        "quantity": (quantity, F.regexp_replace(quantity, r"\.0+$", "").try_cast("int")),
        "customer": (customer, F.when(whole.rlike(r"^[+-]?\d+$"), whole).try_cast("long")),
    }


def to_orders(raw: DataFrame, strict: bool = True) -> DataFrame:
    """Raw CSV text columns -> the order-line shape (works on batch and stream frames)."""
    value = {}
    for name, (text, parsed) in _parsed().items():
        bad = text.isNotNull() & parsed.isNull()
        if strict:
            parsed = F.when(bad, F.raise_error(F.concat(F.lit(f"unparsable {name}: "), text))).otherwise(parsed)
        value[name] = parsed
    invoice = F.col("Invoice")
    if strict and CORRUPT in raw.columns:
        wrong = F.raise_error(F.concat(F.lit("wrong number of fields: "), F.col(CORRUPT)))
        invoice = F.when(F.col(CORRUPT).isNotNull(), wrong).otherwise(invoice)
    return raw.select(
        invoice.alias("invoice"),
        F.col("StockCode").alias("stock_code"),
        F.col("Description").alias("description"),
        value["quantity"].alias("quantity"),
        parse_day_first(F.col("InvoiceDate")).alias("invoice_date"),
        value["price"].alias("price"),
        value["customer"].alias("customer_id"),
        F.col("Country").alias("country"),
    ).select(*ORDER_COLUMNS)


def reject_report(raw: DataFrame) -> DataFrame:
    """(reason, rows) of what a lenient read leaves NULL, in one pass."""
    parsed = _parsed()
    date = _filled(F.col("InvoiceDate"))
    bad = [F.col(CORRUPT).isNotNull()]
    bad += [parsed[n][0].isNotNull() & parsed[n][1].isNull() for n in ("price", "quantity", "customer")]
    bad.append(date.isNotNull() & parse_day_first(date).isNull())
    counts = raw.agg(*(F.count_if(b).alias(r) for r, b in zip(REASONS, bad)))
    return counts.select(F.inline(F.array(*(F.struct(F.lit(r).alias("reason"), F.col(r).alias("rows")) for r in REASONS))))


# 'd/M/yyyy H:mm' with one- or two-digit day, month and hour.
DAY_FIRST = r"^\s*(\d{1,2})/(\d{1,2})/(\d{4})\s+(\d{1,2}):(\d{2})\s*$"


def parse_day_first(text: Column) -> Column:
    """'d/M/yyyy H:mm' -> TIMESTAMP_NTZ built from its fields (no time zone is
    involved, so a wall-clock time inside a DST gap is kept as written);
    anything that does not parse, or is not a real date, is NULL."""
    part = [F.regexp_extract(text, DAY_FIRST, k).try_cast("int") for k in range(1, 6)]
    day, month, year, hour, minute = part
    return F.try_make_timestamp_ntz(year, month, day, hour, minute, F.lit(0))


def read_orders(spark: SparkSession, path: str, strict: bool = True, multi_line: bool = True) -> DataFrame:
    return to_orders(read_raw(spark, path, multi_line), strict)


def sample_files(spark: SparkSession, path: str, n: int = 100) -> DataFrame:
    """The first ``n`` rows of every file, unioned by name, columns that only some
    files have included (a sampling scan: the limit is the feature). Loops over
    the file list, not over data."""
    files = list_files(spark, path, ".csv")
    if not files:
        raise FileNotFoundError(f"no CSV file under {path}")
    out = None
    for f in files:
        part = reader(spark.read, read_header(spark, f), True).csv(f).limit(n).drop(CORRUPT).withColumn("source_file", F.lit(f))
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out
