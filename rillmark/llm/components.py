"""Connected components of links between ids, by alternating star contraction.

Links are first contracted to stars within parts of a bounded number of links. Beyond one
part they never meet in one task or on the driver: every round is two shuffled steps over
(larger, smaller) pairs, written to the shared folder, and a chain of n links settles
in about log n rounds. Links of a node with very many neighbours are summed before the
shuffle, and their joins can be split by adaptive execution.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillmark.llm.frames import forget, stored

#: Links that one task contracts.
PART = 100_000


def roots(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nodes of the links (a, b) and the smallest node that each reaches."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    left, right = at[: len(a)], at[len(a) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[left], label[right])
        new = label.copy()
        np.minimum.at(new, label[left], low)
        np.minimum.at(new, label[right], low)
        new = new[new]
        if np.array_equal(new, label):
            return nodes, nodes[label]
        label = new


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of a partition as stars: fewer links, same reach."""
    nodes = root = np.zeros(0, np.int64)
    for batch in batches:
        u, v = (batch.column(k).to_numpy() for k in (0, 1))
        nodes, root = roots(np.concatenate([nodes, u]), np.concatenate([root, v]))
    far = nodes != root
    for a in range(0, int(far.sum()), 1 << 16):
        yield pa.RecordBatch.from_arrays([pa.array(x[far][a : a + (1 << 16)]) for x in (nodes, root)], names=["u", "v"])


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """(id, component): for every id of ``links`` (two bigint columns) the smallest id that it reaches."""
    a, b = links.columns
    first = stored(links.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u <> v"), "links")
    parts = max(1, -(-first.count() // PART))
    links = stored(first.coalesce(parts).mapInArrow(_forest, "u bigint, v bigint"), "links")
    forget(first)
    before = _state(links)
    while before[0] and parts > 1:  # the stars of a single part are the components
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u > v")
        large = stored(large.distinct().coalesce(parts), "links")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = stored(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct().coalesce(parts), "links")
        forget(links)
        forget(large)
        links, after = small, _state(small)
        if after == before:
            break
        before = after
    ids = links.select(F.col("u").alias("id"), F.col("v").alias("component"))
    return ids.unionByName(links.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())
