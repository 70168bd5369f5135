"""Table schemas and the value domains that belong to them."""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    BooleanType,
    DoubleType,
    IntegerType,
    LongType,
    MapType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)


def _struct(**fields) -> StructType:
    return StructType([StructField(name, kind, True) for name, kind in fields.items()])


_S, _D, _L, _I, _T = StringType(), DoubleType(), LongType(), IntegerType(), TimestampType()

ENVELOPE = _struct(key=BinaryType(), value=BinaryType(), topic=_S, partition=_I, offset=_L, timestamp=_T)

# The producer's click event. ``timestamp`` arrives as ISO-8601 text.
CLICK = _struct(
    event_id=_S, timestamp=_S, schema_version=_S, source_system=_S,
    user_id=_S, session_id=_S, event_type=_S, device_type=_S,
    product_id=_S, product_name=_S, category=_S, subcategory=_S, price=_D,
    search_query=_S, search_results_count=_I, cart_total=_D, cart_item_count=_I,
    os=_S, browser=_S, screen_resolution=_S, country=_S, region=_S, city=_S, ip_address=_S,
    referrer_url=_S, utm_source=_S, utm_medium=_S, utm_campaign=_S,
    page_load_time_ms=_I, user_agent=_S, ab_test_variant=_S,
)

ITEM = _struct(product_id=_S, product_name=_S, category=_S, quantity=_I, price_cents=_L)
ADDRESS = _struct(street=_S, city=_S, state=_S, zip=_S, country=_S)

ORDER = _struct(
    event_id=_S, timestamp=_S, schema_version=_S, source_system=_S,
    transaction_id=_S, order_id=_S, user_id=_S, customer_tier=_S,
    subtotal_cents=_L, tax_cents=_L, shipping_cents=_L, discount_cents=_L, total_cents=_L,
    total_items=_I, payment_method=_S, order_status=_S, currency=_S, items=ArrayType(ITEM),
    payment_processor=_S, payment_processor_transaction_id=_S, shipping_method=_S,
    shipping_address=ADDRESS, estimated_delivery_date=_S, promo_codes=ArrayType(_S),
    discount_percentage=_D, discount_reason=_S, session_id=_S, device_type=_S, country=_S,
    order_created_at=_S, payment_completed_at=_S,
)

REPORT = _struct(
    timestamp=_S,
    total_suites=_I,
    suites=ArrayType(_struct(
        suite_name=_S,
        expectations=ArrayType(_struct(name=_S, passed=BooleanType(), details=_S)),
        passed=_I, failed=_I,
    )),
    summary=_struct(total_expectations=_I, total_passed=_I, total_failed=_I, suites_passed=_I, suites_failed=_I),
    run_id=_S,
    written_at=_S,
)

METRIC = _struct(metric_name=_S, metric_value=_D, metric_unit=_S, tags=MapType(_S, _S), recorded_at=_T)

RUN = _struct(
    pipeline_name=_S, run_id=_S, status=_S, started_at=_T, completed_at=_T, duration_seconds=_L,
    events_processed=_L, events_failed=_L, error_message=_S, metadata=_S,
)

PROGRESS = _struct(query_name=_S, batch_id=_L, input_rows=_L, trigger_ms=_L, recorded_at=_T)

# --- fixed values: the contract's domains -------------------------------------
EVENT_TYPES = (
    "search", "page_view", "add_to_cart", "remove_from_cart", "checkout_started",
    "checkout_completed", "wishlist_add", "review_submitted", "filter_applied", "sort_changed",
)
DEVICE_TYPES = ("mobile", "desktop", "tablet")
PAYMENT_METHODS = ("credit_card", "debit_card", "paypal", "apple_pay", "google_pay", "bank_transfer")
ORDER_STATUSES = ("pending", "confirmed", "shipped", "delivered", "cancelled", "returned")
RUN_STATUSES = ("running", "success", "failed", "timeout")
CHECK_STATUSES = ("passed", "warning", "failed")
SEVERITIES = ("critical", "warning", "info")
ALERT_STATUSES = ("firing", "resolved")

# --- fixed values: funnel stages and the event type of each; the stages that have a figure of their own.
FUNNEL_STAGES = {
    "viewed": "page_view",
    "searched": "search",
    "added_cart": "add_to_cart",
    "started_checkout": "checkout_started",
    "purchased": "checkout_completed",
}
KPI_STAGES = ("page_view", "add_to_cart", "checkout_started", "checkout_completed")

# --- fixed values: topics by table name, as <domain>.<entity>.<version>; inventory is reserved.
TOPICS = {
    "clickstream": "ecommerce.clickstream.v1",
    "transactions": "ecommerce.transactions.v1",
    "inventory": "ecommerce.inventory.v1",
}

# --- fixed values: category -> subcategories, in the order in which a search text is tried.
CATEGORIES = {
    "Electronics": ("Laptops", "Phones", "Tablets", "Accessories", "Smart Home"),
    "Clothing": ("Men", "Women", "Kids", "Shoes", "Accessories"),
    "Home & Garden": ("Furniture", "Kitchen", "Decor", "Garden", "Tools"),
    "Books": ("Fiction", "Non-Fiction", "Textbooks", "Comics", "Magazines"),
    "Sports & Outdoors": ("Fitness", "Camping", "Cycling", "Water Sports", "Team Sports"),
    "Beauty & Health": ("Skincare", "Makeup", "Haircare", "Vitamins", "Personal Care"),
    "Toys & Games": ("Action Figures", "Board Games", "Educational", "Outdoor", "Video Games"),
}

# --- fixed values: order value multiplier per customer tier.
TIER_MULTIPLIERS = {"new": "0.8", "regular": "1.0", "vip": "2.0"}
