"""Declared schemas of the bronze documents and of the tables built from them."""

from __future__ import annotations

from pyspark.sql.types import ArrayType, DataType, StructType


def struct(**fields: str | DataType) -> StructType:
    """Schema from column names and types; needs no running session."""
    schema = StructType()
    for name, data_type in fields.items():
        schema = schema.add(name, data_type)
    return schema


# Prices arrive as numbers or as text, so they are read as text and cast later.
BRONZE_PRODUCTS = struct(
    id="long",
    title="string",
    price="string",
    description="string",
    category="string",
    image="string",
    rating=struct(rate="double", count="long"),
)

# ``country`` is optional in the documents; declaring it keeps it addressable.
BRONZE_CUSTOMERS = struct(
    id="long",
    email="string",
    username="string",
    password="string",
    name=struct(firstname="string", lastname="string"),
    address=struct(
        city="string",
        street="string",
        number="long",
        zipcode="string",
        geolocation=struct(lat="string", long="string"),
        country="string",
    ),
    phone="string",
)

BRONZE_ORDERS = struct(
    id="long",
    userId="long",
    date="string",
    products=ArrayType(struct(productId="long", quantity="long")),
    status="string",
)

BRONZE_EVENTS = struct(
    event_id="string",
    event_type="string",
    timestamp="string",
    user_id="long",
    session_id="string",
    product_id="long",
    page_url="string",
    referrer="string",
    device="string",
)

BRONZE = {
    "products": BRONZE_PRODUCTS,
    "customers": BRONZE_CUSTOMERS,
    "orders": BRONZE_ORDERS,
    "events": BRONZE_EVENTS,
}

DIM_PRODUCTS = struct(
    product_key="long",
    product_id="string",
    product_name="string",
    category="string",
    price="decimal(10,2)",
    rating="decimal(3,2)",
    review_count="integer",
    product_description="string",
    image_url="string",
    effective_date="date",
    expiration_date="date",
    is_current="boolean",
    load_timestamp="timestamp",
)

DIM_CUSTOMERS = struct(
    customer_key="long",
    customer_id="string",
    full_name="string",
    first_name="string",
    last_name="string",
    email="string",
    phone="string",
    street="string",
    city="string",
    zipcode="string",
    country="string",
    segment="string",
    lifetime_value="decimal(10,2)",
    effective_date="date",
    expiration_date="date",
    is_current="boolean",
    load_timestamp="timestamp",
)

FACT_ORDERS = struct(
    order_id="string",
    order_date="date",
    customer_key="long",
    customer_id="string",
    product_key="long",
    product_id="string",
    category="string",
    quantity="integer",
    revenue="decimal(10,2)",
    cost="decimal(10,2)",
    profit="decimal(10,2)",
    discount="decimal(10,2)",
    year="integer",
    month="integer",
    day="integer",
    load_timestamp="timestamp",
    status="string",
)

EVENTS = struct(
    event_id="string",
    event_type="string",
    event_time="timestamp",
    event_date="date",
    customer_id="string",
    session_id="string",
    product_id="string",
    page_url="string",
    referrer="string",
    device="string",
)

DIM_DATE = struct(
    date="date",
    year="integer",
    quarter="integer",
    month="integer",
    month_name="string",
    week="integer",
    day="integer",
    day_of_week="integer",
    day_name="string",
    is_weekend="boolean",
    is_holiday="boolean",
    date_key="integer",
)

# The gold tables. Their consumers know these names, in this order.
DAILY_SALES = struct(
    order_date="date",
    date_key="integer",
    year="integer",
    quarter="integer",
    month="integer",
    month_name="string",
    day="integer",
    day_name="string",
    is_weekend="boolean",
    total_revenue="decimal(20,2)",
    total_profit="decimal(20,2)",
    total_cost="decimal(20,2)",
    profit_margin="decimal(27,2)",
    total_quantity="long",
    total_orders="long",
    total_items="long",
    unique_customers="long",
    unique_products="long",
    avg_order_value="decimal(14,6)",
    avg_items_per_order="double",
    load_timestamp="timestamp",
)

PRODUCT_PERFORMANCE = struct(
    product_id="string",
    product_name="string",
    category="string",
    price="decimal(10,2)",
    rating="decimal(3,2)",
    total_revenue="decimal(20,2)",
    total_profit="decimal(20,2)",
    profit_margin="decimal(27,2)",
    total_quantity_sold="long",
    total_orders="long",
    unique_customers="long",
    avg_revenue_per_order="decimal(14,6)",
    avg_revenue_per_unit="decimal(21,2)",
    revenue_rank_overall="long",
    revenue_rank_in_category="long",
    load_timestamp="timestamp",
)

CUSTOMER_360 = struct(
    customer_key="long",
    customer_id="string",
    full_name="string",
    email="string",
    country="string",
    segment="string",
    lifetime_revenue="decimal(20,2)",
    lifetime_profit="decimal(20,2)",
    total_orders="long",
    total_items_purchased="long",
    unique_products_bought="long",
    avg_order_value="decimal(14,6)",
    first_order_date="date",
    last_order_date="date",
    days_since_last_order="integer",
    days_as_customer="integer",
    recency_score="integer",
    frequency_score="integer",
    monetary_score="integer",
    rfm_score="string",
    customer_segment="string",
    load_timestamp="timestamp",
)

CATEGORY_ANALYSIS = struct(
    category="string",
    year="integer",
    month="integer",
    total_revenue="decimal(20,2)",
    total_profit="decimal(20,2)",
    total_quantity="long",
    unique_products="long",
    unique_customers="long",
    total_orders="long",
    profit_margin="decimal(27,2)",
    revenue_per_product="decimal(21,2)",
    load_timestamp="timestamp",
)

COHORT_ANALYSIS = struct(
    cohort_year="integer",
    cohort_month="integer",
    months_since_first_purchase="integer",
    active_customers="long",
    cohort_revenue="decimal(20,2)",
    avg_revenue_per_customer="decimal(14,6)",
    cohort_period="string",
    load_timestamp="timestamp",
)

WATERMARKS = struct(
    pipeline_name="string",
    last_run_date="date",
    last_run_timestamp="timestamp",
    status="string",
)

LOADED_FILES = struct(
    pipeline="string",
    file="string",
    bytes="long",
    modified="timestamp",
    ingest_date="date",
    loaded_at="timestamp",
)

# A version of what is known of a table's columns; ``change`` is kept, added, missing or retyped.
KNOWN_COLUMNS = struct(
    table_name="string",
    version="integer",
    position="integer",
    column_name="string",
    data_type="string",
    found_type="string",
    change="string",
    noted_at="timestamp",
)

# The delivery that the rows of a key come from, and the day they are stored under.
DELIVERED = struct(
    key="string",
    day="date",
    ingest_date="date",
    source_file="string",
)

# All items of the orders of which some item is rejected; of the rejected ones the reason.
REJECTED_ORDERS = StructType(
    [*FACT_ORDERS, *struct(reason="string", ingest_date="date", source_file="string")]
)

LOADED_BATCHES = struct(
    stream="string",
    batch_id="long",
    loaded_at="timestamp",
)

# What gold is kept up to date from: sums of each customer and product by month, and of
# each customer by month; and totals over all months.
PAIR_MONTHS = struct(
    customer_id="string",
    product_id="string",
    category="string",
    revenue="decimal(20,2)",
    profit="decimal(20,2)",
    quantity="long",
    priced_items="long",
    orders="long",
    year="integer",
    month="integer",
)

CUSTOMER_MONTHS = struct(
    customer_id="string",
    revenue="decimal(20,2)",
    profit="decimal(20,2)",
    quantity="long",
    priced_items="long",
    orders="long",
    first_date="date",
    last_date="date",
    year="integer",
    month="integer",
)

CUSTOMER_TOTALS = struct(
    customer_id="string",
    lifetime_revenue="decimal(20,2)",
    lifetime_profit="decimal(20,2)",
    total_items_purchased="long",
    avg_order_value="decimal(14,6)",
    last_order_date="date",
    first_order_date="date",
    total_orders="long",
    unique_products_bought="long",
)

PRODUCT_TOTALS = struct(
    product_id="string",
    category="string",
    total_revenue="decimal(20,2)",
    total_profit="decimal(20,2)",
    total_quantity_sold="long",
    avg_revenue_per_order="decimal(14,6)",
    total_orders="long",
    unique_customers="long",
)

CHANGED_MONTHS = struct(
    change="string",
    year="integer",
    month="integer",
    refreshed="boolean",
)

# Silver and gold tables: name -> the columns their folders are split by.
PARTITIONING = {
    "dim_products": ("category",),
    "dim_customers": ("country",),
    "fact_orders": ("year", "month"),
    "rejected_orders": ("year", "month"),
    "dim_date": (),
    "events": ("event_date",),
    "daily_sales_summary": ("year", "month"),
    "product_performance": ("category",),
    "customer_360": ("country",),
    "category_analysis": ("year", "month"),
    "cohort_analysis": (),
    "pair_months": ("year", "month"),
    "customer_months": ("year", "month"),
    "customer_totals": (),
    "product_totals": (),
}
