"""Mixing sources to target weights by pivotal dependent rounding.

Each source gets a share of the words of the mix. A document of a source with share
``target`` and ``source_size`` words should appear ``target / source_size`` times; the
whole part is taken as it is and the fraction is rounded. Rounding is dependent: two
fractional documents of a source meet, words move from one to the other in a random
direction until one of them is out or fully in, and the other goes on to meet the next.
The expected number of copies of each document stays what it was, the words taken stay
the same at each meeting, and one undecided document is left. Buckets of the documents of
a source do this in parallel; what is left of each bucket meets in a tree of fixed fan-in, so at the
end a source's words differ from its target by less than one document. Larger documents
meet first, so it is a small one as a rule.

Defined results: a null text has size 0 and takes 0 words; a null source is a source,
ranked last; repeated rows are documents of their own, rounded separately; an empty
table gives an empty mix. The draws depend on the seed and on the document and not on
the layout of the table, so reruns agree. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillmark.functions.ranking import with_global_rank
from rillmark.llm.frames import stored

#: Words between blanks, as counted for sizes.
WORD = r"[^\x20\x09-\x0D]+"
BUCKET_ROWS = 50_000
FAN_IN = 32


def sized(docs: DataFrame) -> DataFrame:
    """(doc_id, source, size): number of words of each whole text."""
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("bigint")
    return docs.select("doc_id", "source", size.alias("size"))


def weighted_sources(sizes: DataFrame, weights: Sequence[float]) -> DataFrame:
    """(source, weight, source_size): weights repeat along the sources by code point, null last."""
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = with_global_rank(totals, [F.col("source").asc_nulls_last()])
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((F.col("rank") - 1) % len(weights) + 1).cast("int"))
    return ranked.select("source", "source_size", weight.alias("weight"))


def with_targets(sources: DataFrame, share: float, most: float) -> DataFrame:
    """Adds ``target``: ``share`` of all sizes by weight, none above ``most`` times its source.

    The excess of capped sources is shared again by weight. Each round is one aggregate;
    a source once capped stays capped, so the level only rises until it settles.
    """
    sources = stored(sources, "mix-weights")
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    level, cap = 0.0, F.lit(float(most)) * F.col("source_size")
    while total:
        capped = F.lit(level) * F.col("weight") >= cap
        fixed, weight = sources.agg(F.sum(F.when(capped, cap)), F.sum(F.when(~capped, F.col("weight")))).first()
        raised = (share * total - (fixed or 0.0)) / weight if weight else level
        if raised <= level:
            break
        level = raised
    return sources.withColumn("target", F.least(F.lit(level) * F.col("weight"), cap))


def _uniform(keys: np.ndarray, seed: int) -> np.ndarray:
    from rillmark.llm.words import mixed

    with np.errstate(over="ignore"):
        return (mixed(keys.astype(np.uint64) + np.uint64(seed) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(11)) / float(1 << 53)


ROUNDED = pa.schema([("doc_id", pa.int64()), ("source", pa.string()), ("source_size", pa.int64()), ("target", pa.float64()), ("size", pa.int64()), ("chance", pa.float64()), ("bucket", pa.int64()), ("key", pa.int64()), ("whole", pa.int64())])


def _round(seed: int, last: bool):
    """Meetings along rows sorted by (bucket, source). Streams: one undecided row is held."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list | None = None  # the undecided row, as column values

        def settled(row: list) -> list:
            if last:
                row = list(row)
                row[5] = float(_uniform(np.array([row[7]]), seed + 1)[0] < row[5])
            return row

        for batch in batches:
            columns = [batch.column(name).to_pylist() for name in ROUNDED.names]
            draws = _uniform(np.asarray(columns[7], np.int64), seed)
            out = []
            for row, draw in zip(zip(*columns), draws.tolist()):
                if not 0.0 < row[5] < 1.0 or row[4] == 0:
                    out.append(row)
                    continue
                if held is None or held[6] != row[6] or held[1] != row[1]:
                    if held is not None:
                        out.append(settled(held))
                    held = list(row)
                    continue
                a, b, v, w = held[5], row[5], held[4], row[4]
                up, down = min((1 - a) * v, b * w), min(a * v, (1 - b) * w)
                row = list(row)
                if draw * (up + down) < down:  # words move to the held row
                    if (1 - a) * v <= b * w:
                        held[5], row[5] = 1.0, b - up / w
                    else:
                        held[5], row[5] = a + up / v, 0.0
                elif a * v <= (1 - b) * w:
                    held[5], row[5] = 0.0, b + down / w
                else:
                    held[5], row[5] = a - down / v, 1.0
                open_rows = [r for r in (held, row) if 1e-12 < r[5] < 1 - 1e-12]
                for r in (held, row):
                    if not 1e-12 < r[5] < 1 - 1e-12:
                        r[5] = float(round(r[5]))
                        out.append(r)
                held = open_rows[0] if open_rows else None
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), ROUNDED)], schema=ROUNDED)
        if held is not None:
            yield pa.RecordBatch.from_arrays([pa.array([c], f.type) for c, f in zip(settled(held), ROUNDED)], schema=ROUNDED)

    return run


def mix_sources(
    docs: DataFrame, weights: Sequence[float] = (3, 1, 2), share: float = 1.5, most: float = 2.0, seed: int = 17
) -> DataFrame:
    """(doc_id, source, size, source_size, target, copies, taken) for every document."""
    sizes = stored(sized(docs), "mix-sizes")
    sources = with_targets(weighted_sources(sizes, weights), share, most)
    n = max(1, -(-sizes.count() // BUCKET_ROWS))
    copies = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    key = F.xxhash64("doc_id", "source", "size")
    sources = sources.select(F.col("source").alias("s"), "source_size", "target")
    # few rows per source and many per document: the join is by value, and a hot source is split by adaptive execution
    rows = sizes.join(sources, F.col("source").eqNullSafe(F.col("s"))).drop("s")
    rows = rows.select(
        F.col("doc_id").cast("bigint"), F.col("source").cast("string"), F.col("source_size").cast("bigint"), "target", "size",
        F.when(copies >= most, 0.0).otherwise(copies - F.floor(copies)).alias("chance"),
        F.pmod(key, F.lit(n)).alias("bucket"), key.alias("key"),
        F.when(copies >= most, F.lit(int(most))).otherwise(F.floor(copies)).cast("bigint").alias("whole"),
    )
    done = None
    undecided = F.col("chance").between(1e-12, 1 - 1e-12) & (F.col("size") > 0)
    while True:
        spread = rows.repartition(F.col("bucket"), F.col("source")).sortWithinPartitions("bucket", "source", F.desc("size"), "key", "doc_id")
        rounded = stored(spread.mapInArrow(_round(seed, n == 1), _ddl()), "mix-round")
        if n == 1:
            done = rounded if done is None else done.unionByName(rounded)
            break
        settled = rounded.where(~undecided)
        done = settled if done is None else done.unionByName(settled)
        n = -(-n // FAN_IN)
        rows = rounded.where(undecided).withColumn("bucket", F.floor(F.col("bucket") / FAN_IN).cast("bigint"))
        seed += 2
    times = F.col("whole") + F.when(F.col("size") > 0, F.round("chance").cast("bigint")).otherwise(0)
    return done.select("doc_id", "source", "size", "source_size", "target", times.alias("copies"), (times * F.col("size")).alias("taken"))


def _ddl() -> str:
    kinds = {pa.int64(): "bigint", pa.string(): "string", pa.float64(): "double"}
    return ", ".join(f"{f.name} {kinds[f.type]}" for f in ROUNDED)
