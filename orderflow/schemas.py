"""Declared contracts: column order, type, nullability, default and maximum length."""

from __future__ import annotations

from typing import Any

from pyspark.sql import types as T

# The raw order layout, every column text.
RAW_COLUMNS = [
    "order_id",
    "customer_id",
    "order_date",
    "order_status",
    "order_priority",
    "ship_date",
    "ship_mode",
    "product_id",
    "product_category",
    "product_name",
    "quantity",
    "unit_price",
    "discount",
    "shipping_cost",
    "region",
    "country",
    "city",
    "postal_code",
    "sales_rep_id",
    "channel",
]

# Landing-zone partition columns, and the ones staged files are split by.
LANDING_PARTITIONS = ["year", "month", "day"]
STAGED_PARTITIONS = ["order_year", "order_month"]

RAW = T.StructType([T.StructField(c, T.StringType()) for c in RAW_COLUMNS])
RAW_LANDING = T.StructType(
    RAW.fields + [T.StructField(c, T.IntegerType()) for c in LANDING_PARTITIONS]
)

_SIMPLE = {t.simpleString(): t for t in (
    T.StringType(), T.ShortType(), T.IntegerType(), T.LongType(), T.BooleanType(), T.DateType(),
    T.TimestampType())}


def _type(name: str) -> T.DataType:
    if name.startswith("decimal("):
        precision, scale = name[8:-1].split(",")
        return T.DecimalType(int(precision), int(scale))
    return _SIMPLE[name]


# Money keeps more places than the target until after the revenue arithmetic.
PRICE = "decimal(18,6)"
RATE = "decimal(7,6)"
AMOUNT = "decimal(14,2)"

_CLEAN_TYPES = {
    "order_date": "date",
    "ship_date": "date",
    "quantity": "int",
    "unit_price": PRICE,
    "discount": RATE,
    "shipping_cost": PRICE,
}

# Columns the transform adds to the raw ones, in output order.
DERIVED_COLUMNS = [
    ("gross_revenue", AMOUNT),
    ("net_revenue", AMOUNT),
    ("days_to_ship", "int"),
    ("is_late_shipment", "boolean"),
    ("order_year", "int"),
    ("order_month", "int"),
    ("order_quarter", "int"),
]
AUDIT_COLUMNS = [
    ("_source_file", "string"),
    ("_job_name", "string"),
    ("_run_id", "string"),
    ("_processed_at", "timestamp"),
]


def _struct(columns: list[tuple[str, str]]) -> T.StructType:
    return T.StructType([T.StructField(n, _type(t)) for n, t in columns])


CLEAN = _struct(
    [(c, _CLEAN_TYPES.get(c, "string")) for c in RAW_COLUMNS] + DERIVED_COLUMNS + AUDIT_COLUMNS
)


def _field(name: str, dtype: str, length: int | None = None, *,
           required: bool = False, default: Any = None) -> T.StructField:
    metadata: dict[str, Any] = {}
    if length is not None:
        metadata["max_length"] = length
    if required:
        metadata["required"] = True
    if default is not None:
        metadata["default"] = default
    # Files make every column nullable, so the contract keeps "required" as metadata.
    return T.StructField(name, _type(dtype), True, metadata)


# The order fact, in column order.
FACT = T.StructType([
    _field("order_line_sk", "string", 32, required=True),
    _field("customer_sk", "bigint", required=True, default=-1),
    _field("product_sk", "bigint", required=True, default=-1),
    _field("order_date_sk", "int", required=True, default=-1),
    _field("ship_date_sk", "int"),
    _field("order_id", "string", 100, required=True),
    _field("customer_id", "string", 50, required=True),
    _field("product_id", "string", 50),
    _field("sales_rep_id", "string", 50),
    _field("order_status", "string", 30, required=True),
    _field("order_priority", "string", 20),
    _field("ship_mode", "string", 30),
    _field("product_category", "string", 100),
    _field("product_name", "string", 500),
    _field("region", "string", 50),
    _field("country", "string", 100),
    _field("city", "string", 100),
    _field("postal_code", "string", 20),
    _field("channel", "string", 30),
    _field("order_date", "date", required=True),
    _field("ship_date", "date"),
    _field("order_year", "smallint", required=True),
    _field("order_month", "smallint", required=True),
    _field("order_quarter", "smallint", required=True),
    _field("quantity", "int", required=True),
    _field("unit_price", "decimal(12,2)", required=True),
    _field("discount", "decimal(5,4)", required=True, default=0),
    _field("shipping_cost", "decimal(12,2)"),
    _field("gross_revenue", "decimal(14,2)", required=True),
    _field("net_revenue", "decimal(14,2)", required=True),
    _field("discount_amount", "decimal(12,2)"),
    _field("days_to_ship", "smallint"),
    _field("is_late_shipment", "boolean", required=True, default=False),
    _field("_source_file", "string", 1000),
    _field("_job_name", "string", 200),
    _field("_run_id", "string", 36),
    _field("_processed_at", "timestamp", required=True),
])

# The dimensions.
DIM_CUSTOMER = T.StructType([
    _field("customer_sk", "bigint", required=True),
    _field("customer_id", "string", 50, required=True),
    _field("customer_name", "string", 200, required=True),
    _field("email", "string", 254),
    _field("customer_segment", "string", 50),
    _field("account_tier", "string", 20),
    _field("region", "string", 50),
    _field("country", "string", 100),
    _field("city", "string", 100),
    _field("postal_code", "string", 20),
    _field("registered_date", "date"),
    _field("is_active", "boolean", required=True, default=True),
    _field("effective_from", "date", required=True),
    _field("effective_to", "date", required=True),
    _field("is_current", "boolean", required=True),
    _field("_scd_id", "string", 32),
    _field("_loaded_at", "timestamp", required=True),
])

DIM_PRODUCT = T.StructType([
    _field("product_sk", "bigint", required=True),
    _field("product_id", "string", 50, required=True),
    _field("product_name", "string", 500, required=True),
    _field("product_category", "string", 100),
    _field("product_sub_category", "string", 100),
    _field("brand", "string", 100),
    _field("manufacturer", "string", 100),
    _field("unit_cost", "decimal(12,2)"),
    _field("retail_price", "decimal(12,2)"),
    _field("is_active", "boolean", required=True, default=True),
    _field("_loaded_at", "timestamp", required=True),
])

DIM_DATE = T.StructType([
    _field("date_sk", "int", required=True),
    _field("full_date", "date", required=True),
    _field("calendar_year", "smallint", required=True),
    _field("calendar_quarter", "smallint", required=True),
    _field("calendar_month", "smallint", required=True),
    _field("month_name", "string", 10, required=True),
    _field("month_name_short", "string", 3, required=True),
    _field("week_of_year", "smallint", required=True),
    _field("day_of_year", "smallint", required=True),
    _field("day_of_month", "smallint", required=True),
    _field("day_of_week", "smallint", required=True),
    _field("day_name", "string", 10, required=True),
    _field("day_name_short", "string", 3, required=True),
    _field("is_weekend", "boolean", required=True),
    _field("is_weekday", "boolean", required=True),
    _field("fiscal_year", "smallint", required=True),
    _field("fiscal_quarter", "smallint", required=True),
    _field("fiscal_month", "smallint", required=True),
    _field("is_current_month", "boolean", required=True),
    _field("is_current_year", "boolean", required=True),
    _field("year_month", "string", 7, required=True),
    _field("quarter_label", "string", 10, required=True),
    _field("fiscal_quarter_label", "string", 12, required=True),
])

AUDIT = T.StructType([
    _field("audit_id", "bigint"),
    _field("run_id", "string", 36, required=True),
    _field("job_name", "string", 200, required=True),
    _field("target_table", "string", 200, required=True),
    _field("partition_date", "date"),
    _field("rows_read", "bigint"),
    _field("rows_rejected", "bigint"),
    _field("rows_inserted", "bigint"),
    _field("rows_updated", "bigint"),
    _field("manifest_uri", "string", 1000),
    _field("status", "string", 20, required=True),
    _field("error_message", "string", 4000),
    _field("started_at", "timestamp", required=True),
    _field("completed_at", "timestamp"),
    _field("duration_seconds", "int"),
])


MANIFEST_ENTRY = _struct([("url", "string"), ("mandatory", "boolean"), ("length", "bigint")])


def max_length(field: T.StructField) -> int | None:
    return field.metadata.get("max_length")


def is_required(field: T.StructField) -> bool:
    return bool(field.metadata.get("required"))
