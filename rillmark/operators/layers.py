"""Raw messages to typed events: lineage, parsing, splits, deduplication."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from rillmark.functions.columns import all_present, event_time, has_columns
from rillmark.schemas import CLICK, DEVICE_TYPES, EVENT_TYPES
from rillmark.session import cut_lineage

CORRUPT = "_corrupt_record"
REQUIRED = ("event_id", "user_id", "session_id", "event_type", "device_type", "event_ts")

# Named predicates of a valid event; a row that breaks one carries the name as a reason.
EVENT_RULES: dict[str, Column | str] = {
    "missing_required": "event_id is not null and user_id is not null and session_id is not null",
    "bad_time": "event_ts is not null",
    "unknown_event_type": "event_type in ({})".format(", ".join(f"'{v}'" for v in EVENT_TYPES)),
    "unknown_device_type": "device_type in ({})".format(", ".join(f"'{v}'" for v in DEVICE_TYPES)),
}


def with_lineage(df: DataFrame) -> DataFrame:
    """Raw message plus where and when it was read."""
    now = F.current_timestamp()
    return df.select(
        "*",
        now.alias("ingestion_timestamp"),
        F.col("topic").alias("source_topic"),
        F.col("partition").alias("kafka_partition"),
        F.col("offset").alias("kafka_offset"),
        F.col("timestamp").alias("kafka_timestamp"),
        F.date_format(now, "yyyy-MM-dd").alias("ingestion_date"),
    )


def land_raw(df: DataFrame) -> DataFrame:
    """Raw landing rows: the message text and its arrival time."""
    return df.select(F.col("value").cast("string").alias("event_data"), F.current_timestamp().alias("received_at"))


def parse_events(raw: DataFrame, schema: StructType = CLICK, keep_corrupt: bool = True) -> DataFrame:
    """One typed row per message: parsed fields, lineage, event time and event date.

    Text that is not valid JSON gives a row of nulls; with ``keep_corrupt`` the
    text itself is kept in ``_corrupt_record`` for the quarantine.
    """
    if keep_corrupt:
        schema = StructType([*schema.fields, StructField(CORRUPT, StringType(), True)])
    data = F.from_json(
        F.col("value").cast("string"), schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    )
    lineage = [c for c in ("ingestion_timestamp", "kafka_partition", "kafka_offset") if c in raw.columns]
    # Each text must be parsed once. As plain projected fields, every later filter on a
    # parsed field would be pushed below the parse and repeat it; a generator stops that.
    parsed = raw.select(F.inline(F.array(data)), *lineage)
    return with_event_time(parsed).withColumn("processed_at", F.current_timestamp())


def with_event_time(df: DataFrame, ts: str = "timestamp") -> DataFrame:
    """Typed UTC event time, and the date, hour and month taken from that one value."""
    moment = event_time(F.col(ts)) if dict(df.dtypes)[ts] == "string" else F.col(ts)
    return df.withColumn("event_ts", moment).select(
        "*",
        F.to_date("event_ts").alias("event_date"),
        F.hour("event_ts").alias("event_hour"),
        F.to_date(F.date_trunc("month", "event_ts")).alias("event_month"),
    )


def split_malformed(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(well-formed, quarantined) by the corrupt-text column."""
    good = parsed.where(F.col(CORRUPT).isNull()).drop(CORRUPT)
    return good, parsed.where(F.col(CORRUPT).isNotNull())


def with_reasons(df: DataFrame, rules: dict[str, Column | str]) -> DataFrame:
    """Add ``reasons``: the names of the rules a row breaks. An unknown verdict counts as broken."""
    broken = [
        F.when(~F.coalesce(F.expr(rule) if isinstance(rule, str) else rule, F.lit(False)), F.lit(name))
        for name, rule in rules.items()
    ]
    return df.withColumn("reasons", F.array_compact(F.array(*broken)))


def split_invalid(df: DataFrame, rules: dict[str, Column | str] = EVENT_RULES) -> tuple[DataFrame, DataFrame]:
    """(valid rows, rejected rows with ``reasons``)."""
    judged = with_reasons(df, rules)
    return judged.where(F.size("reasons") == 0).drop("reasons"), judged.where(F.size("reasons") > 0)


def split_late(df: DataFrame, ts: str, arrival: str, limit: timedelta) -> tuple[DataFrame, DataFrame]:
    """(on time, late): late rows reached us more than ``limit`` after their event time."""
    late = F.coalesce(F.col(arrival) > F.col(ts) + F.lit(limit), F.lit(False))
    return df.where(~late), df.where(late)


def dedupe(df: DataFrame, keys: list[str], order: list[str] | None = None, watermark: str | None = None) -> DataFrame:
    """One row per key. Streams drop copies within the watermark.

    In a batch the first row by ``order`` is kept. The minimum is taken on the
    map side, so a key with very many copies never meets in one task as rows.
    """
    if df.isStreaming:
        return (df.withWatermark("event_ts", watermark) if watermark else df).dropDuplicatesWithinWatermark(keys)
    if not order:
        return df.dropDuplicates(keys)
    rest = [c for c in df.columns if c not in keys]
    first = F.min_by(F.struct(*rest), F.struct(*order)).alias("_first")
    return df.groupBy(*keys).agg(first).select(*keys, "_first.*").select(*df.columns)


#: Repeated keys up to this number go to every task as 64-bit hashes.
BROADCAST_KEYS = 500_000


def dedupe_stored(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """As ``dedupe``, for a stored table in which few keys repeat.

    Key hashes are counted first, in a narrow pass with partial sums. Rows whose hash
    occurs once pass through where they are, without a shuffle or a sort; only the others
    are grouped by key. The repeated hashes are broadcast if they are few, else joined.
    """
    name = "_key_hash"
    hashed = df.withColumn(name, F.xxhash64(*keys))
    counts = hashed.groupBy(name).agg(F.count("*").alias("_n"))
    repeated = cut_lineage(counts.where("_n > 1").select(name))
    if repeated.count() <= BROADCAST_KEYS:
        repeated = F.broadcast(repeated)
    single = hashed.join(repeated, name, "left_anti").select(*df.columns)
    return single.unionByName(dedupe(hashed.join(repeated, name, "left_semi").select(*df.columns), keys, order))


def filter_type(df: DataFrame, event_type: str) -> DataFrame:
    return df.where(F.col("event_type") == event_type)


def drop_nulls(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows without a null in the given columns; columns the frame lacks are not looked at."""
    present = [c for c in columns if has_columns(df, c)]
    return df.where(all_present(*present)) if present else df


def sample_rows(df: DataFrame, columns: list[str], order: list[str], n: int) -> DataFrame:
    """The first ``n`` complete rows in a stated order."""
    return drop_nulls(df.select(*columns), columns).orderBy(*order).limit(n)


def explode_items(orders: DataFrame, keys: list[str]) -> DataFrame:
    """Order lines of the nested ``items`` array, with their 1-based position."""
    exploded = orders.select(*keys, F.posexplode("items").alias("_pos", "item"))
    return exploded.select(*keys, (F.col("_pos") + 1).alias("line_no"), "item.*")


def categorise_queries(df: DataFrame, query: str, categories: dict[str, tuple[str, ...]]) -> DataFrame:
    """Category of a search text: the first category whose name occurs in it, else the first by subcategory."""
    text = F.col("_text")  # lowered once per row, not once per word
    tries = [(name, name) for name in categories]
    tries += [(sub, name) for name, subs in categories.items() for sub in subs]
    found = [F.when(F.contains(text, F.lit(word.lower())), F.lit(name)) for word, name in tries]
    lowered = df.withColumn("_text", F.lower(F.col(query)))
    return lowered.withColumn("search_category", F.coalesce(*found)).drop("_text")
