"""Exact Jaccard self-join of word shingles, size-aware: light sets by subsets, heavy sets by lists.

Two sets of sizes a and b link when they share at least o(a, b) shingles, the smallest
whole number that reaches the threshold. Sets up to a boundary size are light: for every
size that could link, a set enumerates its subsets of exactly o(a, b) shingles, and equal
subsets are links at once. All other pairs have a heavy set and are found by scanning
inverted lists. Shingles are ordered from rare to frequent; two linked sets share one of
their first |s| - ceil(t |s|) + 1 shingles, so only those are listed. The boundary is the
size at which the rows of both ways together are fewest, from the counts of all sizes.

Frequencies for the order come from a count sketch of fixed size over all texts. Any
order gives the same links; a good one keeps the lists of common passages out.

A group of near copies would fill its lists with all its pairs. So lists are scanned
twice: first only pairs with a list's smallest id are verified, which joins nearly every
group; then, in lists that still hold several components, every pair between different
components. Pairs inside a component need no test, as they cannot change it.

Defined results: words lie between blanks, A-Z lower-cased. A null or blank text has no
shingles and no links; a text with fewer words than a shingle has its whole sequence as
one. Rows with the same doc_id are one document, linked by any of its texts, with the
largest of their sizes; rows without doc_id are returned without a component. Other
columns are not read. An empty table gives an empty result. Equality of shingles is that
of 64-bit hashes.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from fractions import Fraction
from functools import lru_cache
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rillmark.llm.components import components
from rillmark.llm.frames import forget, free_name, row_chunks, stored
from rillmark.llm.words import mixed, shingles, words_of

SLOTS = 1 << 20
SLICES = 1 << 10
#: Rows of work that a listed shingle counts for, with its share of verifying.
LIST_COST = 6
#: Largest size that may be light, and the most shingles a subset may leave out.
LIGHT_LIMIT, LEFT_OUT = 48, 3
#: Members of a list that one task scans.
SCAN = 50_000
#: Classes of equal sets with more than this share of the rows are known to every task.
LARGE_CLASSES = 100_000

LISTED = "key bigint, doc_id bigint, n bigint, place bigint, other bigint, head boolean"
NAMES = ["key", "doc_id", "n", "place", "other", "head"]


def needed(a: int, b: int, t: Fraction) -> int:
    """Shared shingles that make sets of these sizes link."""
    return -(-t.numerator * (a + b) // (t.numerator + t.denominator))


def listed(n, t: Fraction):
    """Length of the prefix of a set that is listed."""
    return n + (-t.numerator * n // t.denominator) + 1


@lru_cache(maxsize=None)
def subset_plan(s: int, most: int, t: Fraction) -> tuple[tuple[int, int], ...]:
    """(partner size, shingles left out) for a light set of size s; equal sets need none."""
    plan = []
    for p in range(1, most + 1):
        o = needed(s, p, t)
        if o <= min(s, p) and not o == s == p:
            plan.append((p, s - o))
    return tuple(plan)


def boundary(sizes: dict[int, int], t: Fraction) -> int:
    """Largest light size: fewest rows in all. ``sizes``: number of sets by size up to LIGHT_LIMIT."""
    best, fewest = 0, None
    for x in range(LIGHT_LIMIT + 1):
        plans = {s: subset_plan(s, x, t) for s in range(1, x + 1)}
        if any(left > LEFT_OUT for plan in plans.values() for _, left in plan):
            break
        light = sum(n * sum(comb(s, left) for _, left in plans[s]) for s, n in sizes.items() if s <= x)
        lists = sum(n * LIST_COST * listed(s, t) for s, n in sizes.items() if s > x or needed(s, x + 1, t) <= s)
        if fewest is None or light + lists < fewest:
            best, fewest = x, light + lists
    return best


def _of_ids(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("doc_id").to_numpy(zero_copy_only=False).astype(np.int64)


def _with_id(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").where("doc_id is not null")


def _sizes(n_words: int):
    """Size, 128-bit sum and parity bits of every set, and at the end of a partition its counts of hash slots."""
    names = ["doc_id", "n", "f1", "f2", "bits", "slice", "counts"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(SLOTS, np.uint32)
        for batch in row_chunks(batches, "text"):
            row, value, n = shingles(words_of(batch.column("text")), n_words)
            counts += np.bincount((value & np.uint64(SLOTS - 1)).astype(np.int64), minlength=SLOTS).astype(np.uint32)
            f1, f2 = np.zeros(len(n), np.uint64), np.zeros(len(n), np.uint64)
            np.add.at(f1, row, value)
            np.add.at(f2, row, mixed(value))
            edges = np.concatenate([[0], np.cumsum(n)])
            bits = pa.array([parity(value[a:b]) for a, b in zip(edges[:-1], edges[1:])], pa.binary())
            sums = [pa.array(n, pa.int64()), pa.array(f1.view(np.int64)), pa.array(f2.view(np.int64))]
            none = [pa.nulls(len(n), pa.int32()), pa.nulls(len(n), pa.binary())]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *sums, bits, *none], names=names)
        if counts.any():
            parts = counts.reshape(SLICES, -1)
            some = np.flatnonzero(parts.any(axis=1))
            packed = [zlib.compress(parts[k].tobytes(), 1) for k in some]
            none = [*[pa.nulls(len(some), pa.int64())] * 4, pa.nulls(len(some), pa.binary())]
            yield pa.RecordBatch.from_arrays([*none, pa.array(some, pa.int32()), pa.array(packed, pa.binary())], names=names)

    return run


def parity(values: np.ndarray) -> bytes:
    """As many bits as the next power of two of the size, 64 at least: whether an odd number of shingles falls on each."""
    width = 1 << max(6, (len(values) - 1).bit_length())
    odd = np.bincount((values & np.uint64(width - 1)).astype(np.int64), minlength=width) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def least_difference(x: bytes, y: bytes) -> int:
    """Shingles in just one of two sets, at least: a difference in parity needs one. Wider bits are folded to the other's."""
    a, b = sorted((np.frombuffer(x, np.uint8), np.frombuffer(y, np.uint8)), key=len)
    while len(b) > len(a):
        b = b[: len(b) // 2] ^ b[len(b) // 2 :]
    return int(np.bitwise_count(a ^ b).sum())


def _levels(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums the counts of each slice as they stream by; result as eighths of powers of two."""
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for k, packed in zip(batch.column("slice").to_pylist(), batch.column("counts").to_pylist()):
            part = np.frombuffer(zlib.decompress(packed), np.uint32)
            sums[k] = sums[k] + part if k in sums else part.astype(np.uint64)
    levels = [np.minimum(255, np.round(8 * np.log2(1.0 + s))).astype(np.uint8).tobytes() for s in sums.values()]
    yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array(levels, pa.binary())], names=["slice", "levels"])


def frequency_levels(sized: DataFrame) -> np.ndarray:
    """SLOTS bytes, whatever the size of the corpus."""
    slices = sized.where("slice is not null").select("slice", "counts").repartition("slice")
    out = np.zeros((SLICES, SLOTS // SLICES), np.uint8)
    for row in slices.mapInArrow(_levels, "slice int, levels binary").collect():
        out[row["slice"]] = np.frombuffer(row["levels"], np.uint8)
    return out.reshape(-1)


def _chosen(batch: pa.RecordBatch, n_words: int, keep: np.ndarray):
    """Ids and shingles of the kept rows of a batch."""
    part = batch.filter(pa.array(keep))
    return _of_ids(part), *shingles(words_of(part.column("text")), n_words)


def _signatures(n_words: int, t: Fraction, light: int, levels: np.ndarray, large: dict[int, int]):
    """List rows of all sets that can link with a heavy one, and subset rows of light sets.

    List rows: key (a shingle), id, size, place in the order, and the part of the list that
    the row is scanned in, from 1, or 0 for lists that are not split. Subset rows: key, id,
    size, partner size, and -1.
    """
    names = ["key", "doc_id", "n", "place", "part"]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in row_chunks(batches, "text"):
            ids = _of_ids(batch)
            row, value, n = shingles(words_of(batch.column("text")), n_words)
            if large:  # of a large class of equal sets only the representative goes on
                f = np.zeros(len(n), np.uint64)
                np.add.at(f, row, value)
                keep = np.array([large.get(x, i) == i for x, i in zip(f.view(np.int64).tolist(), ids.tolist())], bool)
                row, value = row[keep[row]], value[keep[row]]
                n = np.where(keep, n, 0)
            level = levels[(value & np.uint64(SLOTS - 1)).astype(np.int64)]
            order = np.lexsort((value, level, row))
            row, value, level = row[order], value[order], level[order]
            place = np.arange(len(row)) - np.searchsorted(row, row)
            size = n[row]
            listing = (place < listed(size, t)) & (-(-t.numerator * (size + light + 1) // (t.numerator + t.denominator)) <= size)
            expected = np.exp2(level[listing] / 8.0)
            parts = (expected // SCAN).astype(np.int64) + 1
            part = np.where(parts > 1, mixed(ids[row[listing]].astype(np.uint64)).astype(np.int64) % parts, 0)
            out = [value[listing].view(np.int64), ids[row[listing]], size[listing], place[listing], np.where(parts > 1, part + 1, 0)]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], names=names)
            small = np.flatnonzero((n > 0) & (n <= light))
            if len(small):
                made = [_subsets(value[np.searchsorted(row, k) : np.searchsorted(row, k, "right")], light, t) for k in small.tolist()]
                count = [len(m) for m in made]
                keys = np.concatenate([m[:, 0] for m in made])
                partner = np.concatenate([m[:, 1] for m in made]).astype(np.int64)
                own = np.repeat(n[small], count)
                out = [keys.view(np.int64), np.repeat(ids[small], count), own, partner, np.full(len(keys), -1)]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], names=names)

    return run


@lru_cache(maxsize=None)
def _left_out(s: int, k: int) -> np.ndarray:
    return np.array(list(combinations(range(s), k)), np.int64).reshape(comb(s, k), k)


def _subsets(values: np.ndarray, light: int, t: Fraction) -> np.ndarray:
    """(key, partner size): sums of hashes of all subsets, mixed with both sizes."""
    s, out = len(values), []
    with np.errstate(over="ignore"):
        total = values.sum(dtype=np.uint64)
        for p, left in subset_plan(s, light, t):
            sums = total - values[_left_out(s, left)].sum(axis=1, dtype=np.uint64)
            keys = mixed(sums + np.uint64(min(s, p) * 4096 + max(s, p)) * np.uint64(0x9E3779B97F4A7C15))
            out.append(np.stack([keys, np.full(len(keys), p, np.uint64)], axis=1))
    return np.concatenate(out) if out else np.zeros((0, 2), np.uint64)


def _subset_links(rows: DataFrame) -> DataFrame:
    """Links of light sets: equal subsets of sets of both sizes that the key is made for."""
    sizes = F.struct(F.least("n", "place").alias("a"), F.greatest("n", "place").alias("b"))
    keyed = rows.select("key", "doc_id", "n", sizes.alias("sizes"))
    groups = keyed.groupBy("key", "sizes").agg(F.min("doc_id").alias("v"), F.min("n").alias("low"), F.max("n").alias("high"), F.max("doc_id").alias("last"))
    groups = groups.where((F.col("low") == F.col("sizes.a")) & (F.col("high") == F.col("sizes.b")) & (F.col("v") < F.col("last")))
    linked = keyed.join(groups.select("key", "sizes", "v"), ["key", "sizes"])
    return linked.select(F.col("doc_id").alias("u"), "v").where("u <> v").distinct()


class Scan:
    """Along rows sorted by (key, part, id): members of lists of two or more, each with the list's first one where the pair may link.

    Near copies share most of their lists and so have the same few first ones: the pairs
    of a group are about as many as its members. Holds two rows between batches. The
    first member of a part of a long list is marked, so that the parts can be joined.
    """

    def __init__(self, t: Fraction):
        self.t, self.lead, self.last, self.shown = t, None, None, False

    def step(self, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        columns = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("key", "part", "n", "doc_id", "place")]
        if not batch.num_rows:
            return
        shown = self.shown
        if self.last is not None:
            columns = [np.concatenate([[x], c]) for x, c in zip(self.last, columns)]
        key, part, n, ids, place = columns
        same = (key[1:] == key[:-1]) & (part[1:] == part[:-1])
        # a row shown before was in a list already; an unshown first row has nothing before it
        follows = np.concatenate([[shown], same])
        in_list = follows | np.concatenate([same, [False]])
        # the first member of each row's list; of the list that the batch begins in, it may be in a batch before
        at = np.maximum.accumulate(np.where(np.concatenate([[True], ~same]), np.arange(len(key)), 0))
        lead_n, lead_id, lead_place = n[at], ids[at], place[at]
        if shown and self.lead is not None:
            lead_n[at == 0], lead_id[at == 0], lead_place[at == 0] = self.lead
        has = follows & (ids != lead_id) & possible(n, lead_n, place, lead_place, self.t)
        long = part > 0
        give = in_list | long
        give[0] &= not shown
        self.last, self.lead = tuple(c[-1] for c in columns), (lead_n[-1], lead_id[-1], lead_place[-1])
        self.shown = bool(give[-1]) or (shown and len(key) == 1)
        columns = [key[give], ids[give], n[give], place[give], pa.array(lead_id[give], mask=~has[give]), long[give] & ~follows[give]]
        yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns], names=NAMES)


def _scan(t: Fraction):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scan = Scan(t)
        for batch in batches:
            yield from scan.step(batch)

    return run


def possible(a, b, i, j, t: Fraction):
    """Length and place bounds of a pair whose first common shingle is at places i and j."""
    o = -(-t.numerator * (a + b) // (t.numerator + t.denominator))
    return (o <= np.minimum(a, b)) & (np.minimum(a - i, b - j) >= o)


def _slots(ids: DataFrame, bits: int) -> np.ndarray:
    """A filter of 2**bits places, set for every id; ids that are not in it may pass."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filled = np.zeros(1 << bits, bool)
        for batch in batches:
            filled[(mixed(_of_ids(batch).astype(np.uint64)) >> np.uint64(64 - bits)).astype(np.int64)] = True
        parts = np.packbits(filled).reshape(-1, 1 << 12)
        some = np.flatnonzero(parts.any(axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array([parts[k].tobytes() for k in some], pa.binary())], names=["slice", "bits"])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merged: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, part in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                part = np.frombuffer(part, np.uint8)
                merged[k] = merged[k] | part if k in merged else part
        yield pa.RecordBatch.from_arrays([pa.array(list(merged), pa.int32()), pa.array([m.tobytes() for m in merged.values()], pa.binary())], names=["slice", "bits"])

    kind = "slice int, bits binary"
    out = np.zeros((1 << bits) // 8, np.uint8).reshape(-1, 1 << 12)
    for row in ids.mapInArrow(run, kind).repartition("slice").mapInArrow(merge, kind).collect():
        out[row["slice"]] = np.frombuffer(row["bits"], np.uint8)
    return out.reshape(-1)


def plausible(pairs: DataFrame, sizes: DataFrame, t: Fraction) -> DataFrame:
    """The pairs (u, v) that the parity bits of their sets do not rule out."""

    def test(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, x, y = (batch.column(c).to_pylist() for c in ("a", "b", "x", "y"))
            can = [least_difference(p, q) <= m + n - 2 * needed(m, n, t) for m, n, p, q in zip(a, b, x, y)]
            yield batch.select(["u", "v"]).filter(pa.array(can, pa.bool_()))

    first = sizes.select(F.col("doc_id").alias("u"), F.col("n").alias("a"), F.col("bits").alias("x"))
    second = sizes.select(F.col("doc_id").alias("v"), F.col("n").alias("b"), F.col("bits").alias("y"))
    both = pairs.join(first, "u").join(second, "v").select("u", "v", "a", "b", "x", "y")
    return stored(both.mapInArrow(test, "u bigint, v bigint").distinct(), "jaccard-pairs")


def verified(docs: DataFrame, pairs: DataFrame, n_words: int, t: Fraction) -> DataFrame:
    """The pairs (u, v) whose texts reach the threshold. Sets are built again from the texts, for the ids in pairs only."""
    ids = stored(pairs.select(F.explode(F.array("u", "v")).alias("doc_id")).distinct(), "jaccard-ids")
    bits = min(27, max(18, (64 * ids.count()).bit_length()))
    filled = _slots(ids, bits)

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in row_chunks(batches, "text"):
            at = (mixed(_of_ids(batch).astype(np.uint64)) >> np.uint64(64 - bits)).astype(np.int64)
            keep = (filled[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 == 1
            if keep.any():
                own, row, value, n = _chosen(batch, n_words, keep)
                edges = np.concatenate([[0], np.cumsum(n)])
                packed = [value[a:b].tobytes() for a, b in zip(edges[:-1], edges[1:])]
                yield pa.RecordBatch.from_arrays([pa.array(own), pa.array(packed, pa.binary())], names=["doc_id", "shingles"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            links = []
            for x, y in zip(batch.column("x"), batch.column("y")):
                a, b = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                if len(a) > len(b):
                    a, b = b, a
                at = np.searchsorted(b, a)
                shared = int((b[np.minimum(at, len(b) - 1)] == a).sum()) if len(a) else 0
                links.append(shared > 0 and shared >= needed(len(a), len(b), t))
            yield pa.RecordBatch.from_arrays([batch.column("u"), batch.column("v")], names=["u", "v"]).filter(pa.array(links, pa.bool_()))

    built = _with_id(docs).mapInArrow(sets, "doc_id bigint, shingles binary")  # shuffled once for both sides
    first = built.select(F.col("doc_id").alias("u"), F.col("shingles").alias("x"))
    second = built.select(F.col("doc_id").alias("v"), F.col("shingles").alias("y"))
    links = stored(pairs.join(first, "u").join(second, "v").select("u", "v", "x", "y").mapInArrow(compare, "u bigint, v bigint").distinct(), "jaccard-links")
    forget(ids)
    return links


def jaccard_components(docs: DataFrame, n_words: int = 4, threshold: Fraction = Fraction(85, 100)) -> DataFrame:
    """(doc_id, n_shingles, component_id): component_id is the smallest doc_id that a document reaches by links."""
    t = Fraction(threshold)
    sized = stored(_with_id(docs).mapInArrow(_sizes(n_words), "doc_id bigint, n bigint, f1 bigint, f2 bigint, bits binary, slice int, counts binary"), "jaccard-sizes")
    sizes = sized.where("slice is null").select("doc_id", "n", "f1", "f2", "bits")
    levels = frequency_levels(sized)

    # equal sets link; of the large classes only the smallest id is compared further
    full = sizes.where("n > 0")
    classes = stored(full.groupBy("f1", "f2").agg(F.min("doc_id").alias("v"), F.count("*").alias("members")).where("members > 1"), "jaccard-classes")
    equal = full.join(classes.select("f1", "f2", "v"), ["f1", "f2"]).select(F.col("doc_id").alias("u"), "v").where("u <> v").distinct()
    total = sizes.count()
    large = {r["f1"]: r["v"] for r in classes.where(F.col("members") > max(2, total // LARGE_CLASSES)).select("f1", "v").collect()}

    by_size = full.groupBy(F.least("n", F.lit(LIGHT_LIMIT + 1)).alias("s")).agg(F.count("*").alias("c")).collect()
    light = boundary({r["s"]: r["c"] for r in by_size if r["s"] <= LIGHT_LIMIT}, t)

    kind = "key bigint, doc_id bigint, n bigint, place bigint, part int"
    signatures = _with_id(docs).mapInArrow(_signatures(n_words, t, light, levels, large), kind)
    # both kinds of rows come out of one pass over the texts and are split behind the shuffle
    lists, subsets = stored_by_key(signatures, t)
    near = lists.where("other is not null").select(F.greatest("doc_id", "other").alias("u"), F.least("doc_id", "other").alias("v"))
    heads = lists.where("head").select("key", "doc_id", "n", "place", F.lit(0).alias("part"))
    across = heads.repartition("key").sortWithinPartitions("key", "part", "doc_id").mapInArrow(_scan(t), LISTED)
    across = across.where("other is not null").select(F.greatest("doc_id", "other").alias("u"), F.least("doc_id", "other").alias("v"))
    pairs = stored(near.unionByName(across).distinct(), "jaccard-pairs")
    links = verified(docs, plausible(pairs, sizes, t), n_words, t)
    found = components(equal.unionByName(_subset_links(subsets)).unionByName(links))

    # lists that still hold several components: all pairs between them
    members = lists.select("key", "doc_id", "n", "place").join(found.withColumnRenamed("id", "doc_id"), "doc_id", "left")
    members = stored(members.withColumn("component", F.coalesce("component", "doc_id")), "jaccard-members")
    several = members.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo < hi").select("key")
    open_rows = members.join(several, "key")
    one, two = open_rows.alias("a"), open_rows.alias("b")
    share = F.lit(t.numerator) * (F.col("a.n") + F.col("b.n"))
    enough = lambda shared: F.lit(t.numerator + t.denominator) * shared >= share
    can_link = enough(F.least(F.col("a.n"), F.col("b.n"))) & enough(F.least(F.col("a.n") - F.col("a.place"), F.col("b.n") - F.col("b.place")))
    cross = one.join(two, (F.col("a.key") == F.col("b.key")) & (F.col("a.component") < F.col("b.component")) & can_link)
    cross = cross.select(F.greatest("a.doc_id", "b.doc_id").alias("u"), F.least("a.doc_id", "b.doc_id").alias("v")).distinct()
    cross = stored(cross.join(pairs, ["u", "v"], "left_anti"), "jaccard-pairs")
    more = verified(docs, plausible(cross, sizes, t), n_words, t)
    if more.head(1):
        before = found.select(F.col("id").alias("u"), F.col("component").alias("v"))
        found = components(before.unionByName(more))
    for table in (lists, members, cross):
        forget(table)

    known = sizes.groupBy("doc_id").agg(F.max("n").alias("n_shingles"))
    out = known.join(found.withColumnRenamed("id", "doc_id"), "doc_id", "left")
    out = out.select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))
    nameless = docs.where("doc_id is null").select(F.lit(None).cast("bigint").alias("doc_id"), "text")
    nameless = nameless.mapInArrow(_nameless(n_words), "doc_id bigint, n_shingles bigint, component_id bigint")
    return out.unionByName(nameless)


def stored_by_key(signatures: DataFrame, t: Fraction) -> tuple[DataFrame, DataFrame]:
    """List rows after the scan, and subset rows, both from one shuffle by key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scan = Scan(t)
        for batch in batches:
            subset = pc.equal(batch.column("part"), -1)
            chosen = batch.filter(subset)
            none = [pa.nulls(chosen.num_rows, pa.int64()), pa.nulls(chosen.num_rows, pa.bool_())]
            yield pa.RecordBatch.from_arrays([*[chosen.column(c) for c in NAMES[:4]], *none], names=NAMES)
            yield from scan.step(batch.filter(pc.invert(subset)))

    spread = signatures.repartition("key", "part").sortWithinPartitions("key", "part", "doc_id")
    rows = stored(spread.mapInArrow(run, LISTED), "jaccard-lists")
    return rows.where("head is not null"), rows.where("head is null")


def _nameless(n_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in row_chunks(batches, "text"):
            n = shingles(words_of(batch.column("text")), n_words)[2]
            none = pa.nulls(len(n), pa.int64())
            yield pa.RecordBatch.from_arrays([none, pa.array(n, pa.int64()), none], names=["doc_id", "n_shingles", "component_id"])

    return run


def one_of_each_group(docs: DataFrame, n_words: int, threshold: Fraction) -> DataFrame:
    """``docs`` with only the smallest doc_id of each component, once; rows without doc_id stay."""
    found = jaccard_components(docs, n_words, threshold)
    own, nth = free_name(docs, "kept"), free_name(docs, "nth")
    kept = stored(found.where("doc_id = component_id").select(F.col("doc_id").alias(own)), "jaccard-kept")
    single = docs.join(kept, F.col("doc_id").cast("bigint") == F.col(own), "left_semi")
    single = single.withColumn(nth, F.row_number().over(Window.partitionBy("doc_id").orderBy("text"))).where(F.col(nth) == 1).drop(nth)
    return single.unionByName(docs.where("doc_id is null"))
