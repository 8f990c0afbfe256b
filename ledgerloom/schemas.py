"""Explicit schemas of every table the library reads or writes."""

from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DataType,
    DateType,
    DecimalType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
    TimestampType,
    VariantType,
)

TEXT, LONG, INT, FLAG = StringType(), LongType(), IntegerType(), BooleanType()
DAY, TIME, INSTANT, JSON = DateType(), TimestampNTZType(), TimestampType(), VariantType()
PRICE, METRIC, CREDITS = DecimalType(10, 2), DecimalType(10, 4), DecimalType(10, 6)


def struct(**columns: DataType) -> StructType:
    return StructType([StructField(name, kind) for name, kind in columns.items()])


PRODUCTS = struct(
    product_id=TEXT, model_name=TEXT, theme=TEXT, finish=TEXT, base_price=PRICE, sku=TEXT,
    stock_quantity=LONG, launch_date=DAY,
)
CUSTOMERS = struct(
    customer_id=TEXT, first_name=TEXT, last_name=TEXT, email=TEXT, registration_date=TIME
)
ORDERS = struct(
    order_id=TEXT, customer_id=TEXT, order_date=TIME, order_status=TEXT, sales_channel=TEXT,
    store_id=TEXT,
)
ORDER_ITEMS = struct(
    order_id=TEXT, product_id=TEXT, quantity=LONG, price_at_purchase=PRICE, rfid=TEXT
)

ADDRESS = struct(street_address=TEXT, city=TEXT, state=TEXT, postalcode=TEXT)
CONTACT = struct(name=TEXT, phone=TEXT)


def _support(address: DataType, contact: DataType) -> StructType:
    return struct(
        txid=TEXT, rfid=TEXT, item=TEXT, purchase_time=TIME, expiration_time=DAY, days=LONG,
        name=TEXT, address=address, phone=TEXT, email=TEXT, emergency_contact=contact,
    )


SUPPORT_ORDERS = _support(JSON, JSON)
# The same records as newline JSON before the nested columns become variants.
SUPPORT_ORDERS_RAW = _support(ADDRESS, CONTACT)

CARD_JSON = struct(
    element=LONG,
    object=TEXT,
    transaction=struct(
        id=LONG, type=TEXT, amount=DoubleType(), currency=TEXT, timestamp=TEXT, approved=FLAG
    ),
    card=struct(number=LONG),
    merchant=struct(id=LONG),
)
CARD_TRANSACTIONS = struct(
    element=LONG, object_type=TEXT, transaction_id=LONG, transaction_type=TEXT, amount=PRICE,
    currency=TEXT, transaction_timestamp=TIME, approved=FLAG, card_number=LONG, merchant_id=LONG,
    loaded_at=INSTANT,
)

ENVELOPE = struct(id=TEXT, timestamp=TEXT, data=TEXT, topic=TEXT)
_NESTED_ITEM = struct(product_id=TEXT, quantity=LONG, price_at_purchase=PRICE, rfid=TEXT)
NESTED_MESSAGE = struct(
    products=ArrayType(PRODUCTS),
    customers=ArrayType(CUSTOMERS),
    orders=ArrayType(
        StructType([*ORDERS.fields, StructField("order_items", ArrayType(_NESTED_ITEM))])
    ),
)

QUALITY_METRICS = struct(
    metric_name=TEXT, metric_category=TEXT, metric_value=METRIC, total_records=LONG,
    measurement_timestamp=TIME, table_name=TEXT,
)
PII_CLASSIFICATION = struct(
    field_name=TEXT, data_type=TEXT, sensitivity_level=TEXT, pii_category=TEXT,
    masking_required=FLAG, retention_period_days=LONG, regulatory_requirement=TEXT,
)
RETENTION_POLICY = struct(
    table_name=TEXT, retention_period_days=LONG, last_cleanup_date=DAY, next_cleanup_date=DAY
)
LINEAGE = struct(
    lineage_id=TEXT, source_object=TEXT, target_object=TEXT, transformation_type=TEXT,
    transformation_logic=TEXT, dependency_level=INT, created_timestamp=TIME, last_updated=TIME,
)
ALERT_CONFIG = struct(
    alert_id=TEXT, alert_name=TEXT, alert_type=TEXT, threshold_value=LONG, comparison_operator=TEXT,
    target_table=TEXT, target_column=TEXT, alert_frequency_minutes=LONG, notification_method=TEXT,
    is_active=FLAG, created_date=TIME,
)
ALERT_HISTORY = struct(
    alert_id=TEXT, alert_name=TEXT, alert_value=DecimalType(38, 0), threshold_value=LONG,
    alert_timestamp=TIME, alert_message=TEXT, resolved_timestamp=TIME, resolved_by=TEXT,
)
USAGE = struct(
    warehouse_name=TEXT, credits_used=CREDITS, query_count=LONG, avg_execution_time=LONG,
    total_bytes_scanned=LONG, start_time=TIME,
)
COST_METRICS = struct(
    metric_date=DAY, warehouse_name=TEXT, credits_used=CREDITS, query_count=LONG,
    avg_execution_time_seconds=LONG, total_bytes_scanned=LONG, cost_per_query=CREDITS,
    optimization_opportunities=TEXT,
)
LOAD_LOG = struct(
    table_name=TEXT, file_name=TEXT, status=TEXT, row_parsed=LONG, row_count=LONG, error_count=LONG,
    bytes_loaded=LONG, last_load_time=INSTANT, first_error_message=TEXT,
)
RUN_HISTORY = struct(task_name=TEXT, state=TEXT, scheduled_time=INSTANT, completed_time=INSTANT)
PROGRESS = struct(
    run_id=TEXT, name=TEXT, event=TEXT, batch_id=LONG, input_rows=LONG, duration_ms=LONG, state_rows=LONG,
    noted_at=INSTANT, error=TEXT,
)
