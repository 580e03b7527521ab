"""Column contracts of the raw input and of the three stored tables."""

from __future__ import annotations

from pyspark.sql import types as T

# The ten input columns every source must have.
REQUIRED_COLUMNS = [
    "order_id",
    "order_date",
    "customer_name",
    "region",
    "product_category",
    "product_name",
    "quantity",
    "unit_price",
    "discount",
    "payment_method",
]

# Input columns by kind, and those a row must have a value in.
TEXT_COLUMNS = ["region", "product_category", "product_name", "payment_method", "customer_name"]
NUMBER_COLUMNS = ["quantity", "unit_price", "discount"]

MANDATORY_VALUES = ["order_date", "customer_name", "unit_price"]

# Columns of the transactions table that the load supplies, in table order.
LOAD_COLUMNS = REQUIRED_COLUMNS + ["total_amount", "order_year", "order_month"]

# Field texts of a CSV file that mean "no value".
NA_TOKENS = [
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
]

# Names of the stored tables.
TRANSACTIONS = "sales_transactions"
SUMMARY = "monthly_region_summary"
RUN_LOG = "etl_run_log"

# Partition columns stand last, as Spark stores them.
TRANSACTIONS_SCHEMA = T.StructType(
    [
        T.StructField("order_id", T.StringType()),
        T.StructField("order_date", T.DateType()),
        T.StructField("customer_name", T.StringType()),
        T.StructField("region", T.StringType()),
        T.StructField("product_category", T.StringType()),
        T.StructField("product_name", T.StringType()),
        T.StructField("quantity", T.IntegerType()),
        T.StructField("unit_price", T.DecimalType(10, 2)),
        T.StructField("discount", T.DecimalType(5, 4)),
        T.StructField("payment_method", T.StringType()),
        T.StructField("total_amount", T.DecimalType(12, 2)),
        T.StructField("loaded_at", T.TimestampType()),
        T.StructField("order_year", T.IntegerType()),
        T.StructField("order_month", T.IntegerType()),
    ]
)

# Counts are BIGINT and revenue has 22 digits: a month of a large source outgrows INT and 14 digits.
SUMMARY_SCHEMA = T.StructType(
    [
        T.StructField("region", T.StringType()),
        T.StructField("total_orders", T.LongType()),
        T.StructField("total_quantity", T.LongType()),
        T.StructField("total_revenue", T.DecimalType(22, 2)),
        T.StructField("avg_order_value", T.DecimalType(12, 2)),
        T.StructField("refreshed_at", T.TimestampType()),
        T.StructField("order_year", T.IntegerType()),
        T.StructField("order_month", T.IntegerType()),
    ]
)

RUN_LOG_SCHEMA = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("source_file", T.StringType()),
        T.StructField("rows_read", T.LongType()),
        T.StructField("rows_cleaned", T.LongType()),
        T.StructField("rows_rejected", T.LongType()),
        T.StructField("rows_loaded", T.LongType()),
        T.StructField("status", T.StringType()),
        T.StructField("error_message", T.StringType()),
        T.StructField("started_at", T.TimestampType()),
        T.StructField("finished_at", T.TimestampType()),
        T.StructField("duration_seconds", T.DecimalType(10, 2)),
    ]
)

MONTH_KEYS = ["order_year", "order_month"]

TABLE_SCHEMAS = {TRANSACTIONS: TRANSACTIONS_SCHEMA, SUMMARY: SUMMARY_SCHEMA, RUN_LOG: RUN_LOG_SCHEMA}
TABLE_PARTITIONS = {TRANSACTIONS: MONTH_KEYS, SUMMARY: MONTH_KEYS, RUN_LOG: []}

# Longest text each stored column admits.
TEXT_LIMITS = {
    "order_id": 50,
    "customer_name": 150,
    "region": 100,
    "product_category": 100,
    "product_name": 150,
    "payment_method": 50,
}

# Smallest magnitude each stored number no longer admits.
NUMBER_LIMITS = {
    "quantity": 2147483648,
    "unit_price": 100000000,
    "discount": 10,
    "total_amount": 10000000000,
}

# Outcomes of a run, and the longest source name its log row admits.
RUN_STATUSES = ["SUCCESS", "FAILED", "PARTIAL"]
LONGEST_SOURCE = 255

# Rows refused by the transactions table, as texts; beside the three tables, for runs that set them apart.
REJECTS = "rejected_orders"
REJECTS_SCHEMA = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("rejected_at", T.TimestampType()),
        T.StructField("reasons", T.ArrayType(T.StringType())),
        *[T.StructField(name, T.StringType()) for name in LOAD_COLUMNS],
    ]
)

# The collation under which a store that ignores case, accents and trailing blanks compares texts.
LENIENT_COLLATION = "UNICODE_CI_AI_RTRIM"

# Which files a folder has brought; beside the three tables, for recurring runs.
TAKEN_FILES = "taken_files"
TAKEN_FILES_SCHEMA = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("length", T.LongType()),
        T.StructField("modified", T.TimestampType()),
        T.StructField("outcome", T.StringType()),
        T.StructField("run_id", T.StringType()),
    ]
)
