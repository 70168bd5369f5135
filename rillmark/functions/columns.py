"""Scalar expressions. All of them stay inside Catalyst."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def cents(amount: Column) -> Column:
    """Money as whole cents, so that sums do not depend on row order."""
    return F.round(amount * 100).cast("bigint")


def money_sum(amount: Column) -> Column:
    """Order-independent sum of a money column, as double."""
    return F.sum(cents(amount)).cast("double") / 100


def money_avg(amount: Column) -> Column:
    """Order-independent mean of a money column; null when there is nothing to average."""
    return F.try_divide(F.sum(cents(amount)).cast("double") / 100, F.count(amount))


def exact_sum(value: Column) -> Column:
    """Order-independent sum of a fractional column, exact to ten decimals."""
    return F.sum(value.cast("decimal(28,10)")).cast("double")


def exact_mean(value: Column) -> Column:
    return F.try_divide(exact_sum(value), F.count(value))


def percent(part: Column, whole: Column) -> Column:
    """``part / whole * 100``, null for a zero denominator."""
    return F.try_divide(part.cast("double"), whole.cast("double")) * 100


def event_time(text: Column) -> Column:
    """ISO-8601 text to a UTC timestamp; bad text becomes null."""
    return F.try_to_timestamp(text)


def tag(tags: Column, key: str) -> Column:
    """Value of one tag of a map column; null when absent."""
    return F.try_element_at(tags, F.lit(key))


def json_tag(text: Column, key: str) -> Column:
    """Value of one top-level key of a JSON text column."""
    return F.get_json_object(text, f"$.{key}")


def strip_prefix(name: Column, prefix: str) -> Column:
    """The part behind the prefix; names without it are left as they are."""
    return F.when(F.startswith(name, F.lit(prefix)), F.substr(name, F.lit(len(prefix) + 1))).otherwise(name)


def normalise_text(text: Column, default: str = "unknown") -> Column:
    return F.coalesce(F.trim(F.lower(text)), F.lit(default))


def age_seconds(moment: Column, as_of: datetime) -> Column:
    return F.timestamp_diff("SECOND", moment, F.lit(as_of))


def run_duration(start: Column, end: Column) -> Column:
    """Whole seconds between start and end; null while a run is open."""
    return F.timestamp_diff("SECOND", start, end)


def later_than(moment: Column, as_of: datetime, keep: timedelta) -> Column:
    """True for rows younger than ``keep`` at ``as_of``."""
    return moment > F.lit(as_of) - F.lit(keep)


def since(df: DataFrame, ts_col: str, keep: timedelta, as_of: datetime) -> DataFrame:
    """Rows of the trailing interval that ends at ``as_of``."""
    return df.where(later_than(F.col(ts_col), as_of, keep))


def date_key(moment: Column) -> Column:
    """``yyyyMMdd`` as an integer."""
    return (F.year(moment) * 10000 + F.month(moment) * 100 + F.dayofmonth(moment)).cast("int")


def date_parts(day: Column) -> list[Column]:
    """Attributes of a calendar day, weeks and weekdays by ISO rules."""
    weekday = (F.weekday(day) + 1).cast("int")
    return [
        date_key(day).alias("date_key"),
        day.alias("date_actual"),
        weekday.alias("day_of_week"),
        F.date_format(day, "EEEE").alias("day_name"),
        F.dayofmonth(day).alias("day_of_month"),
        F.dayofyear(day).alias("day_of_year"),
        F.weekofyear(day).alias("week_of_year"),
        F.month(day).alias("month_actual"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.quarter(day).alias("quarter_actual"),
        F.year(day).alias("year_actual"),
        (weekday >= 6).alias("is_weekend"),
    ]


def margin_pct(price: Column, cost: Column) -> Column:
    """Margin as a percentage of the price; null for a price of zero."""
    return (F.try_divide(price - cost, price) * 100).cast("decimal(5,2)")


def line_total(quantity: Column, unit_price: Column, discount: Column, tax: Column) -> Column:
    return (quantity * unit_price - discount + tax).cast("decimal(18,2)")


def all_present(*names: str) -> Column:
    """True when none of the columns is null."""
    result = F.lit(True)
    for name in names:
        result = result & F.col(name).isNotNull()
    return result


def has_columns(df: DataFrame, *names: str) -> bool:
    return not missing_columns(df, names)


def missing_columns(df: DataFrame, required) -> list[str]:
    """Required names that the frame does not have, in the order asked for."""
    present = set(df.columns)
    return [name for name in required if name not in present]
