"""Star schema: date, customer (with history) and product dimensions, facts, daily aggregates."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rillmark.functions.columns import date_key, date_parts, line_total, margin_pct
from rillmark.functions.lookup import lookup_join
from rillmark.operators.links import with_dim_as_of, with_dim_current


def dim_date(spark: SparkSession, start: date = date(2024, 1, 1), end: date = date(2026, 12, 31)) -> DataFrame:
    """One row per day, both ends included."""
    days = spark.range(1).select(F.explode(F.sequence(F.lit(start), F.lit(end))).alias("day"))
    return days.select(*date_parts(F.col("day")))


def dim_date_of(df: DataFrame, ts: str) -> DataFrame:
    """Date dimension over the span of a table."""
    span = df.agg(F.to_date(F.min(ts)).alias("a"), F.to_date(F.max(ts)).alias("b")).where("a is not null")
    return span.select(F.explode(F.sequence("a", "b")).alias("day")).select(*date_parts(F.col("day")))


def surrogate_key(*parts: str) -> Column:
    """Key that is the same in every run: 128 bits of a digest of the natural key, as hexadecimal text.

    Among 10^12 keys the chance of any collision is below 10^-14. A null part differs from every text.
    """
    return F.md5(F.concat_ws("\x1f", *[F.coalesce(F.concat(F.lit("="), F.col(p).cast("string")), F.lit("")) for p in parts]))


def open_versions(rows: DataFrame, key: str, effective: Column) -> DataFrame:
    """First versions of a customer dimension."""
    versions = rows.withColumns(
        {"effective_date": effective, "expiration_date": F.lit(None).cast("date"), "is_current": F.lit(True)}
    )
    return versions.select(surrogate_key(key, "effective_date").alias("customer_key"), "*")


def scd2_upsert(
    dim: DataFrame, incoming: DataFrame, key: str, tracked: list[str], effective: Column, order: list[str] | None = None
) -> DataFrame:
    """Type 2 upsert: changed versions are closed and new ones opened.

    Of several arrivals of a key in one batch the last by ``order`` counts; without it they must be equal.
    Only current versions meet the incoming rows (one row per key on both
    sides); closed history passes through without a join. A change on the day a
    version began replaces that version. Customers that do not arrive stay as they are.
    """
    history, current = dim.where(~F.col("is_current")), dim.where("is_current")
    attributes = [c for c in incoming.columns if c != key and c in dim.columns]
    old = current.select(key, F.struct(*[c for c in dim.columns if c != key]).alias("_old"), F.struct(*tracked).alias("_was"))
    both = _side_by_side(old, _arrivals(incoming, key, attributes, order), key, ["_old", "_was"], order)
    both = both.withColumn("_tracked", F.struct(*[F.col(f"_new.{c}").alias(c) for c in tracked]))

    arrived, known = F.col("_new").isNotNull(), F.col("_old").isNotNull()
    changed = arrived & known & ~F.col("_tracked").eqNullSafe(F.col("_was"))
    replaces = changed & (F.col("_old.effective_date") >= effective)
    old_fields = {c: F.col(f"_old.{c}") for c in dim.columns if c != key}
    opened = {c: F.col(f"_new.{c}") for c in attributes}
    opened |= {
        "customer_key": surrogate_key(key, "_effective"),
        "effective_date": F.col("_effective"),
        "expiration_date": F.lit(None).cast("date"),
        "is_current": F.lit(True),
    }
    closed = old_fields | {"expiration_date": F.col("_effective"), "is_current": F.lit(False)}

    def version(fields: dict[str, Column]) -> Column:
        return F.struct(*[fields[c].alias(c) for c in dim.columns if c != key])

    versions = F.array_compact(
        F.array(
            F.when(known & ~changed, version(old_fields)),
            F.when(changed & ~replaces, version(closed)),
            F.when(changed | ~known, version(opened)),
        )
    )
    merged = both.withColumn("_effective", effective).select(key, F.explode(versions).alias("_v"))
    return history.unionByName(merged.select(key, "_v.*").select(*dim.columns))


def _arrivals(incoming: DataFrame, key: str, attributes: list[str], order: list[str] | None) -> DataFrame:
    """Incoming rows as a struct that compares by ``order`` first."""
    return incoming.select(key, F.struct(*[F.col(c).alias(f"_by_{c}") for c in order or []], *attributes).alias("_new"))


def _side_by_side(left: DataFrame | None, right: DataFrame, key: str, left_cols: list[str], order: list[str] | None) -> DataFrame:
    """Full join of a table with one row per key and the arrivals of a batch, as one grouping.

    Both sides go through a single shuffle, and the size estimate of the result
    is their sum rather than the product a full join is given. Arrivals of one key that
    differ, without an order to tell which counts, end the job with an error that names the key.
    """
    both = right if left is None else left.unionByName(right, allowMissingColumns=True)
    single = [F.max(c).alias(c) for c in left_cols]
    grouped = both.groupBy(key).agg(*single, F.max("_new").alias("_new"), *([] if order else [F.min("_new").alias("_least")]))
    if order:
        return grouped
    clash = F.raise_error(F.concat(F.lit("different rows arrive for one key: "), F.col(key).cast("string")))
    kept = F.when(F.col("_least").eqNullSafe(F.col("_new")), F.col("_new")).otherwise(clash.cast(right.schema["_new"].dataType))
    return grouped.withColumn("_new", kept).drop("_least")


def dim_product(dim: DataFrame | None, incoming: DataFrame, order: list[str] | None = None) -> DataFrame:
    """Type 1 upsert of products by id, with margin and surrogate key; several arrivals of an id as in ``scd2_upsert``."""
    columns = ["product_name", "category", "brand", "unit_price", "cost"]
    new = _arrivals(incoming, "product_id", columns, order)
    old = None if dim is None else dim.select("product_id", F.struct(*columns).alias("_old"))
    merged = _side_by_side(old, new, "product_id", [] if dim is None else ["_old"], order)
    last = F.struct(*[F.col(f"_new.{c}").alias(c) for c in columns])
    found = last if dim is None else F.when(F.col("_new").isNotNull(), last).otherwise(F.col("_old"))
    return merged.select("product_id", found.alias("_r")).select("product_id", "_r.*").select(
        surrogate_key("product_id").alias("product_key"), "*", margin_pct(F.col("unit_price"), F.col("cost")).alias("margin_percent")
    )


def fact_measures(lines: DataFrame, *more: str) -> DataFrame:
    """Order lines with the key of their day and the line total: the sales fact without dimension keys; ``more`` columns stay."""
    return lines.select(
        "transaction_id",
        date_key(F.col("sold_at")).alias("date_key"),
        "customer_id",
        "product_id",
        "quantity",
        "unit_price",
        "discount_amount",
        "tax_amount",
        line_total(F.col("quantity"), F.col("unit_price"), F.col("discount_amount"), F.col("tax_amount")).alias("total_amount"),
        F.col("sold_at").alias("transaction_timestamp"),
        *more,
    )


def with_customer_key(rows: DataFrame, customers: DataFrame, moment: str, attributes: tuple[str, ...] = ()) -> DataFrame:
    """``customer_key`` and ``attributes`` of the customer version of the day; of orders this is one look for all their lines."""
    versions = customers.select("customer_id", "customer_key", "effective_date", "expiration_date", *attributes)
    return with_dim_as_of(rows, versions, "customer_id", moment).drop("effective_date", "expiration_date")


def with_product_key(rows: DataFrame, products: DataFrame, keys_from: DataFrame | None = None) -> DataFrame:
    return lookup_join(rows, products.select("product_id", "product_key"), ["product_id"], "left", keys_from=keys_from)


def key_known(rows: DataFrame, of: str) -> DataFrame:
    """``<of>_known`` in the place of ``<of>_key``, for those who need no more: 32 digits a row that no later shuffle carries."""
    return rows.withColumn(f"{of}_known", F.col(f"{of}_key").isNotNull()).drop(f"{of}_key")


def fact_sales(lines: DataFrame, customers: DataFrame, products: DataFrame, more: tuple[str, ...] = ()) -> DataFrame:
    """Sales fact: order lines with dimension keys of their day and the line total.

    A key that was looked up before lines met their orders (``with_customer_key``, ``with_product_key``,
    or ``key_known`` of it) is taken as it is. ``more`` are further columns of the lines to keep.
    """
    found = {of: next((c for c in (f"{of}_key", f"{of}_known") if c in lines.columns), None) for of in ("customer", "product")}
    rows = fact_measures(lines, *[c for c in found.values() if c], *more)
    if not found["customer"]:
        rows = with_customer_key(rows, customers, "transaction_timestamp")
    if not found["product"]:
        rows = with_product_key(rows, products, keys_from=lines)
    return rows.select(
        "transaction_id", "date_key", found["customer"] or "customer_key", "customer_id", found["product"] or "product_key", "product_id", "quantity",
        "unit_price", "discount_amount", "tax_amount", "total_amount", "transaction_timestamp", *more,
    )


def fact_clicks(events: DataFrame, customers: DataFrame, products: DataFrame) -> DataFrame:
    """Click fact with the current customer and product keys."""
    current = customers.select("customer_id", "customer_key", "is_current")
    rows = events.withColumnRenamed("user_id", "customer_id")
    placed = with_dim_current(rows, current, "customer_id")
    keyed = lookup_join(placed, products.select("product_id", "product_key"), ["product_id"], "left", keys_from=events)
    return keyed.select(
        "event_id",
        "session_id",
        date_key(F.col("timestamp")).alias("date_key"),
        "customer_key",
        "customer_id",
        "product_key",
        "product_id",
        "event_type",
        "device_type",
        F.col("timestamp").alias("event_timestamp"),
    )


def daily_sales(fact: DataFrame) -> DataFrame:
    """Sales per day. Lines shrink to orders first, so only customers need a distinct count."""
    orders = fact.groupBy("date_key", "transaction_id", "customer_id").agg(
        F.sum("total_amount").alias("amount"), F.sum("quantity").alias("quantity")
    )
    total = F.sum("amount")
    return orders.groupBy("date_key").agg(
        total.cast("decimal(18,2)").alias("total_sales"),
        F.count("*").alias("total_orders"),
        F.countDistinct("customer_id").alias("total_customers"),
        F.sum("quantity").cast("bigint").alias("total_products_sold"),
        F.round(F.try_divide(total.cast("decimal(18,2)"), F.count("*")), 2).cast("decimal(18,2)").alias("average_order_value"),
    )


def product_performance(fact: DataFrame) -> DataFrame:
    """Units, revenue and distinct customers per day and product."""
    return fact.groupBy("date_key", "product_id").agg(
        F.sum("quantity").cast("bigint").alias("units_sold"),
        F.sum("total_amount").cast("decimal(18,2)").alias("revenue"),
        F.countDistinct("customer_id").alias("num_customers"),
    )
