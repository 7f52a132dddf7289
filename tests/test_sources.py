import datetime as dt
import os
import tempfile
from decimal import Decimal

import pytest

from tillroll.sources import csv_orders, export, tables
from tillroll.streaming import folder_ingest

HEADER = "Invoice;StockCode;Description;Quantity;InvoiceDate;Price;Customer ID;Country\n"


def _folder(rows, files=1):
    d = tempfile.mkdtemp(prefix="tillroll-csv-")
    per = max(1, len(rows) // files)
    for i in range(files):
        chunk = rows[i * per:(i + 1) * per] if i < files - 1 else rows[i * per:]
        with open(os.path.join(d, f"part{i}.csv"), "w", encoding="utf-8") as f:
            f.write(HEADER + "".join(r + "\n" for r in chunk))
    return d


ROWS = [
    "489434;85048;LAMPE ÉTOILE;12;1/12/2009 7:45;6,95;13085;United Kingdom",
    "C489449;22087;PAPER BUNTING;-12;01/12/2009 10:33;2,95;16321;Australia",
    "489450;21523;;3;32/12/2009 07:45;1,25;;France",
    "489451;21524;MAT;1;1/2/2010 7:45;10;12345;",
]


def test_decimal_comma_and_lenient_dates(spark):
    d = _folder(ROWS, files=2)
    out = {r.invoice: r for r in csv_orders.read_orders(spark, d).collect()}
    assert out["489434"].price == Decimal("6.9500")
    assert out["489434"].invoice_date == dt.datetime(2009, 12, 1, 7, 45)
    assert out["C489449"].quantity == -12
    assert out["489450"].invoice_date is None  # day 32 -> NULL
    assert out["489450"].customer_id is None and out["489450"].description is None
    assert out["489451"].invoice_date == dt.datetime(2010, 2, 1, 7, 45)
    assert out["489451"].country is None


def test_numbers_in_either_notation(spark):
    d = _folder(["1;S;X;1;1/1/2010 0:00;6,95;13085.0;UK", "2;S;X;2.0;1/1/2010 0:00;6.95; 7 ;UK", "3;S;X;;1/1/2010 0:00;;;UK"])
    out = {r.invoice: (r.price, r.quantity, r.customer_id) for r in csv_orders.read_orders(spark, d).collect()}
    assert out == {"1": (Decimal("6.9500"), 1, 13085), "2": (Decimal("6.9500"), 2, 7), "3": (None, None, None)}


BAD = [
    ("1;S;X;1;1/1/2010 0:00;abc;1;UK", "bad_price"),
    ("2;S;X;two;1/1/2010 0:00;1,0;1;UK", "bad_quantity"),
    ("3;S;X;1;1/1/2010 0:00;1,0;13x;UK", "bad_customer"),
    ("4;S;X;1;1/1/2010 0:00;1,0", "wrong_fields"),
    ("5;S;X;1;1/1/2010 0:00;1,0;1;UK;more", "wrong_fields"),
]


@pytest.mark.parametrize("row,reason", BAD)
def test_strict_read_fails_and_lenient_read_counts(spark, row, reason):
    d = _folder([ROWS[0], row])
    with pytest.raises(Exception, match="unparsable|wrong number of fields"):
        csv_orders.read_orders(spark, d).collect()
    assert csv_orders.read_orders(spark, d, strict=False).count() == 2
    report = {r.reason: r.rows for r in csv_orders.reject_report(csv_orders.read_raw(spark, d)).collect()}
    assert report.pop(reason) == 1 and set(report.values()) == {0}


def test_bad_dates_are_null_and_counted(spark):
    d = _folder(ROWS)
    report = {r.reason: r.rows for r in csv_orders.reject_report(csv_orders.read_raw(spark, d)).collect()}
    assert report["bad_date"] == 1


def test_columns_are_bound_by_name(spark):
    d = _folder(ROWS[:1])
    with open(os.path.join(d, "swapped.csv"), "w", encoding="utf-8") as f:
        f.write("\ufeffStockCode;Extra;Invoice;Customer ID;Country;Price;InvoiceDate;Quantity;Description\n")
        f.write("85;x;77;5;UK;1,5;2/3/2010 4:05;9;MAT\n")
    out = {r.invoice: r for r in csv_orders.read_orders(spark, d).collect()}
    r = out["77"]
    assert (r.stock_code, r.quantity, r.price, r.customer_id, r.country) == ("85", 9, Decimal("1.5000"), 5, "UK")
    assert set(out) == {"489434", "77"}
    sample = csv_orders.sample_files(spark, d)
    assert "Extra" in sample.columns and sample.count() == 2
    with open(os.path.join(d, "short.csv"), "w", encoding="utf-8") as f:
        f.write("Invoice;StockCode;Description;Quantity;InvoiceDate;Price;Country\n1;2;3;4;1/1/2010 0:00;1;UK\n")
    with pytest.raises(ValueError, match="Customer ID"):
        csv_orders.read_orders(spark, d)


def test_quotes_separators_line_breaks_and_empty_texts(spark):
    d = _folder(['1;S;"HEART ""T"" LIGHT; RED";1;1/1/2010 0:00;1,00;13085;UK', '2;S;"TWO\nLINES";1;1/1/2010 0:00;1,00;1;UK', '3;S;"";1;1/1/2010 0:00;1,00;1;UK'])
    out = {r.invoice: r for r in csv_orders.read_orders(spark, d).collect()}
    assert out["1"].description == 'HEART "T" LIGHT; RED' and out["1"].customer_id == 13085
    assert out["2"].description == "TWO\nLINES" and out["3"].description == ""


def test_missing_folder_fails(spark):
    with pytest.raises(FileNotFoundError):
        csv_orders.read_orders(spark, tempfile.mkdtemp(prefix="tillroll-empty-"))


def test_sample_files_takes_first_rows_of_each_file(spark):
    d = _folder(ROWS, files=2)
    s = csv_orders.sample_files(spark, d, n=1)
    assert s.count() == 2
    assert s.select("source_file").distinct().count() == 2


def test_export_round_trip(spark, make_orders):
    from tests.conftest import line

    orders = make_orders([line("1", "A", 3, "2010-05-04 09:30", 6.95, 7, "France"),
                          line("C2", "B", -1, "2010-05-05 23:59", 1234.5, None, "UK", 'A "B"; C\nD'),
                          line("3", "B", 1, "2010-05-05 23:59", 1.5, 4, None, ""), line("4", "B", 1, None, 1.5, 4, "UK", None)])
    d = tempfile.mkdtemp(prefix="tillroll-exp-")
    export.export_raw_orders(orders, d + "/out")
    back = csv_orders.read_orders(spark, d + "/out")
    assert sorted(back.collect(), key=str) == sorted(orders.collect(), key=str)


def test_streaming_ingest_only_takes_new_files(spark):
    landing = _folder(ROWS[:2])
    base = tempfile.mkdtemp(prefix="tillroll-stream-")
    first = folder_ingest.ingest_available(spark, landing, base + "/bronze", base + "/ckpt").count()
    assert first == 2
    with open(os.path.join(landing, "later.csv"), "w", encoding="utf-8") as f:
        f.write(HEADER + ROWS[3] + "\n")
    second = folder_ingest.ingest_available(spark, landing, base + "/bronze", base + "/ckpt").count()
    assert second == 3


def test_table_versions(spark):
    base = tempfile.mkdtemp(prefix="tillroll-tab-") + "/t"
    assert tables.read_current(spark, base) is None
    tables.write_version(spark.range(3), base)
    tables.write_version(spark.range(5), base)
    assert tables.versions(spark, base) == [1, 2]
    assert tables.read_current(spark, base).count() == 5


def test_day_first_parse_ignores_session_time_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        d = _folder(["1;S;X;1;14/3/2010 2:30;1,00;1;UK", "2;S;X;1;29/2/2010 10:00;1,00;1;UK"])
        got = {r.invoice: r.invoice_date for r in csv_orders.read_orders(spark, d).collect()}
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got == {"1": dt.datetime(2010, 3, 14, 2, 30), "2": None}  # DST-gap time kept; Feb 29 2010 invalid


def test_headers_of_many_files_and_quoted_line_breaks(spark, tmp_path):
    from tillroll.sources import csv_orders

    names = csv_orders.CSV_COLUMNS
    odd = ['"Note\nof ""two"" lines; and a mark"', *names]
    for i in range(120):
        head = odd if i % 3 == 0 else names if i % 3 == 1 else names[::-1]
        values = dict(zip(names, [f"I{i}", "S", "d", "1", "1/2/2010 7:45", "6,95", "7", "UK"]))
        row = ['"a\nb"' if c == odd[0] else values[c] for c in head]
        (tmp_path / f"f{i:03d}.csv").write_text(("\ufeff" if i % 5 == 0 else "") + ";".join(head) + "\n" + ";".join(row) + "\n", encoding="utf-8")
    files = csv_orders.list_files(spark, str(tmp_path), ".csv")
    headers = csv_orders.read_headers(spark, files)
    assert headers[0][0] == 'Note\nof "two" lines; and a mark' and headers[1] == tuple(names) and headers[2] == tuple(names[::-1])
    got = csv_orders.read_orders(spark, str(tmp_path)).collect()
    assert sorted(r.invoice for r in got) == sorted(f"I{i}" for i in range(120)) and {str(r.price) for r in got} == {"6.9500"}
