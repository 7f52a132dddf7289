"""Fixed schemas. Nothing is inferred at read time."""

from pyspark.sql import types as T

# Order lines, the shape every analysis consumes ("raw_orders").
ORDERS = T.StructType(
    [
        T.StructField("invoice", T.StringType()),
        T.StructField("stock_code", T.StringType()),
        T.StructField("description", T.StringType()),
        T.StructField("quantity", T.IntegerType()),
        T.StructField("invoice_date", T.TimestampNTZType()),
        T.StructField("price", T.DecimalType(18, 4)),
        T.StructField("customer_id", T.LongType()),
        T.StructField("country", T.StringType()),
    ]
)
ORDER_COLUMNS = [f.name for f in ORDERS.fields]

# Raw order-line CSV as delivered: ';'-separated, header, decimal comma,
# 'd/M/yyyy H:mm' dates (one- or two-digit fields). Dates arrive as text and
# are parsed from their fields (sources/csv_orders.parse_day_first); all columns
# are read as text.
CSV_COLUMNS = [
    "Invoice",
    "StockCode",
    "Description",
    "Quantity",
    "InvoiceDate",
    "Price",
    "Customer ID",
    "Country",
]
