"""Orders: assembly from sessions, pricing, nesting of lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillmark.functions.columns import cents
from rillmark.functions.lookup import lookup_join
from rillmark.functions.ordered import with_running
from rillmark.schemas import TIER_MULTIPLIERS

# --- fixed values: tax rate, free-shipping limit and shipping rates in cents.
TAX_PER_MILLE = 70
FREE_SHIPPING_CENTS = 10000
DOMESTIC_COUNTRY, DOMESTIC_CENTS, FOREIGN_CENTS = "US", 500, 1500


def completed_carts(events: DataFrame) -> DataFrame:
    """Sessions with a cart add and a completed checkout, one header row each."""
    adds = F.col("event_type") == "add_to_cart"
    done = F.col("event_type") == "checkout_completed"
    sessions = events.where(adds | done).groupBy("session_id").agg(
        F.count_if(adds).alias("total_items"),
        F.max(F.when(done, F.col("timestamp"))).alias("completed_at"),
        F.max_by("user_id", F.when(done, F.col("timestamp"))).alias("user_id"),
        F.max_by("device_type", F.when(done, F.col("timestamp"))).alias("device_type"),
    )
    return sessions.where((F.col("total_items") > 0) & F.col("completed_at").isNotNull() & F.col("session_id").isNotNull())


def assemble_orders(events: DataFrame) -> DataFrame:
    """Order lines of completed sessions: the cart adds, numbered in time order.

    Lines stay rows. A session of any size is spread over tasks by hour when it
    is numbered, and is salted when it meets its header.
    """
    adds = events.where(F.col("event_type") == "add_to_cart").select(
        "session_id", "timestamp", "event_id", "product_id", cents(F.col("price")).alias("price_cents"), F.lit(1).alias("quantity")
    )
    numbered = with_running(adds, ["session_id"], "timestamp", ["event_id"], {"line_no": ("sum", "quantity")})
    header = completed_carts(events)
    return lookup_join(numbered, header, ["session_id"], "inner", keys_from=adds)


def nest_items(lines: DataFrame, key: str, line_no: str, item: list[str], max_items: int = 100) -> DataFrame:
    """Lines to ``items`` arrays for messages: one row per order and page of at most ``max_items`` lines.

    Pages bound the size of a message; ``whole_orders`` puts the counts of an order's pages together.
    """
    page = F.floor((F.col(line_no) - 1) / max_items).cast("int")
    packed = lines.groupBy(key, page.alias("page")).agg(F.sort_array(F.collect_list(F.struct(line_no, *item))).alias("_items"))
    return packed.select(key, "page", F.transform("_items", lambda i: F.struct(*[i[c].alias(c) for c in item])).alias("items"))


def whole_orders(pages: DataFrame, key: str) -> DataFrame:
    """One row per order from its pages: the order's own columns, and ``item_count`` over all pages."""
    own = [c for c in pages.columns if c not in (key, "page", "items")]
    return pages.groupBy(key).agg(*[F.max(c).alias(c) for c in own], F.sum(F.size("items")).alias("item_count"))


def price_orders(lines: DataFrame, users: DataFrame, key: str = "order_id") -> DataFrame:
    """Subtotal, tax, shipping, discount and total in cents, one row per order.

    Lines carry ``user_id, country, price`` (decimal) and ``discount_pct`` (a
    fraction, null for none). Every step truncates to whole cents.
    """
    cart = lines.groupBy(key, "user_id", "country").agg(
        F.sum(F.floor(F.col("price") * 100).cast("bigint")).alias("_cart_cents"),
        F.count("*").alias("total_items"),
        F.max("discount_pct").alias("discount_pct"),
    )
    known = lookup_join(cart, users.select("user_id", "tier"), ["user_id"], "left")
    factor = tier_multiplier(F.col("tier"))
    subtotal = F.floor(F.col("_cart_cents") * factor).cast("bigint")
    priced = known.withColumn("subtotal_cents", subtotal)
    sub = F.col("subtotal_cents")
    shipping = (
        F.when(sub >= FREE_SHIPPING_CENTS, 0)
        .when(F.col("country") == DOMESTIC_COUNTRY, DOMESTIC_CENTS)
        .otherwise(FOREIGN_CENTS)
    )
    rate = F.coalesce(F.col("discount_pct").cast("decimal(4,2)"), F.lit(0).cast("decimal(4,2)"))
    parts = priced.select(
        key,
        "user_id",
        "country",
        F.col("tier").alias("customer_tier"),
        "total_items",
        "subtotal_cents",
        F.floor(sub * TAX_PER_MILLE / F.lit(1000)).cast("bigint").alias("tax_cents"),
        shipping.cast("bigint").alias("shipping_cents"),
        F.floor(sub * rate).cast("bigint").alias("discount_cents"),
    )
    total = F.col("subtotal_cents") - F.col("discount_cents") + F.col("tax_cents") + F.col("shipping_cents")
    return parts.withColumn("total_cents", total)


def tier_multiplier(tier: Column) -> Column:
    """Order value multiplier of a tier; unknown tiers count as regular."""
    out = F.lit("1.0").cast("decimal(3,1)")
    for name, factor in TIER_MULTIPLIERS.items():
        out = F.when(tier == name, F.lit(factor).cast("decimal(3,1)")).otherwise(out)
    return out
