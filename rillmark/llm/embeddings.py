"""Exact cosine self-join of vectors by the subspace pigeonhole.

Unit vectors with cosine c are 2 - 2c apart in square. After a fixed random rotation the
coordinates are split into blocks of ``BLOCK`` dimensions, and each block gets a share of
that squared distance in proportion to its dimensions. Two vectors within the whole are
within the share in one block at least, so a range join in every block yields all
candidates. A block's range join lays a grid over its first two coordinates: a vector is
at home in its cell and visits the neighbouring cells ahead that it could have a partner
in, so a pair meets in one cell. Cells with many members are dealt into chunks, and every
two chunks meet in a group of their own, which bounds what a task holds.

Floats are kept as floats and doubles as doubles. Every vector is scaled by a power of two
before any norm, so its length is no matter. Only rotated unit coordinates are rounded to
floats, for the search of candidates, with room for that.

Within a group, block distances are matrix products; candidates that an earlier block
has as well are left to it, and the others are verified by cosine in double precision.
A group gives each of its vectors the number of links found and one smaller vector that
it reaches, never the pairs, so dense groups do not blow up. Equal vectors are joined
before and weigh as many as they are.

Defined results: vectors that are null, empty, zero, or hold a null or non-finite
component link with nothing. Vectors of different lengths do not link. Of rows with one
vec_id the one with the smallest embedding counts; rows without vec_id are returned
without a component and as kept. Other columns are not read. An empty table gives an
empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import FloatType

from rillmark.llm.components import components, roots
from rillmark.llm.frames import forget, stored

BLOCK = 16
CHUNK = 16_384
TILE = 256
SLACK = 1e-9


@lru_cache(maxsize=8)
def rotation(dim: int) -> np.ndarray:
    """A random orthogonal matrix, the same everywhere."""
    q, r = np.linalg.qr(np.random.default_rng(dim).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def block_edges(dim: int) -> np.ndarray:
    return np.linspace(0, dim, max(1, round(dim / BLOCK)) + 1).astype(int)


def scaled(vectors: np.ndarray) -> np.ndarray:
    """Vectors in double precision, each by a power of two so that its largest component is about 1: exact, and squares neither vanish nor overflow."""
    vectors = vectors.astype(np.float64)
    _, exponent = np.frexp(np.abs(vectors).max(axis=1))
    return np.ldexp(vectors, -exponent[:, None])


def rotated(vectors: np.ndarray) -> np.ndarray:
    """Rotated unit vectors, in double precision, each computed alone so that it is the same in every group."""
    unit = vectors / np.sqrt(np.einsum("ij,ij->i", vectors, vectors))[:, None]
    return np.einsum("ij,jk->ik", unit, rotation(vectors.shape[1]))


def _by_length(batch: pa.RecordBatch, kind: type) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Row numbers and scaled vectors of each length; ``kind`` is the type of the stored components."""
    packed = batch.column("vector").to_pylist()
    sizes = np.array([len(p) // np.dtype(kind).itemsize for p in packed], np.int64)
    for dim in np.unique(sizes).tolist():
        rows = np.flatnonzero(sizes == dim)
        yield dim, rows, scaled(np.frombuffer(b"".join(packed[i] for i in rows.tolist()), kind).reshape(len(rows), dim))


def _places(vectors: np.ndarray, distance: float) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(block, row, cell x, cell y, at home) for every place of every vector."""
    y, dim = rotated(vectors), vectors.shape[1]
    edges = block_edges(dim)
    everyone = np.arange(len(y))
    for b, (lo, hi) in enumerate(zip(edges[:-1], edges[1:])):
        reach = np.sqrt(distance * (hi - lo) / dim) * (1 + 1e-6) + 1e-12
        width = 2 * reach
        point = np.stack([y[:, lo], y[:, lo + 1] if hi - lo > 1 else np.zeros(len(y))], axis=1)
        cell = np.floor(point / width).astype(np.int64)
        yield b, everyone, cell[:, 0], cell[:, 1], np.ones(len(y), bool)
        above = (cell + 1) * width - point  # distance to the next cell along each axis
        below = point - cell * width
        for dx, dy in ((1, -1), (1, 0), (1, 1), (0, 1)):
            gap = (above[:, 0] if dx else 0.0) ** 2 + (above[:, 1] if dy > 0 else below[:, 1] if dy < 0 else 0.0) ** 2
            near = np.flatnonzero(gap <= reach * reach)
            yield b, near, cell[near, 0] + dx, cell[near, 1] + dy, np.zeros(len(near), bool)


def _cell_sizes(distance: float, kind: type):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dim, _, vectors in _by_length(batch, kind):
                for b, _, x, y, _ in _places(vectors, distance):
                    cells, n = np.unique(np.stack([x, y], axis=1), axis=0, return_counts=True)
                    same = [pa.array(np.full(len(n), v)) for v in (dim, b)]
                    yield pa.RecordBatch.from_arrays([*same, pa.array(cells[:, 0]), pa.array(cells[:, 1]), pa.array(n)], names=["dim", "block", "x", "y", "n"])

    return run


PLACED = "dim bigint, block bigint, x bigint, y bigint, i bigint, j bigint, id bigint, weight bigint, home boolean, chunk bigint, vector binary"


def _placed(distance: float, chunks: dict[tuple, int], kind: type):
    """A row for each group that a vector takes part in: cell, and the two chunks (i <= j) that meet."""
    names = [f.split(" ")[0] for f in PLACED.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            slot = batch.column("slot").to_numpy()
            for dim, rows, vectors in _by_length(batch, kind):
                for b, near, x, y, home in _places(vectors, distance):
                    count = np.array([chunks.get(key, 1) for key in zip([dim] * len(x), [b] * len(x), x.tolist(), y.tolist())], np.int64)
                    own = slot[rows[near]] % np.maximum(count, 1)
                    if not len(near):
                        continue
                    place = np.repeat(np.arange(len(near)), count)
                    other = np.arange(len(place)) - np.repeat(np.cumsum(count) - count, count)
                    mine = own[place]
                    out = [np.full(len(place), dim), np.full(len(place), b), x[place], y[place], np.minimum(mine, other), np.maximum(mine, other)]
                    source = pa.array(rows[near][place])
                    columns = [pa.array(c) for c in out]
                    columns += [batch.column("id").take(source), batch.column("weight").take(source), pa.array(home[place]), pa.array(mine), batch.column("vector").take(source)]
                    for a in range(0, len(place), 8192):
                        yield pa.RecordBatch.from_arrays([c.slice(a, 8192) for c in columns], names=names)

    return run


def _packed_rows(column: pa.ChunkedArray, dim: int, kind: type) -> np.ndarray:
    """A binary column of equally long vectors as a matrix."""
    size = dim * np.dtype(kind).itemsize
    return np.concatenate([np.frombuffer(c.buffers()[2], kind, len(c) * dim, c.offset * size) for c in column.chunks if len(c)]).reshape(-1, dim)


def _near(part: np.ndarray, left: np.ndarray, right: np.ndarray, ahead: bool, share: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows within a block's share, by products of small tiles; with ``ahead`` of right rows behind the left one only."""
    square = np.einsum("ij,ij->i", part, part)[:, None]
    ones = np.ones_like(square)
    a = np.concatenate([-2 * part[left], square[left], ones[left]], axis=1)
    b = np.ascontiguousarray(np.concatenate([part[right], ones[right], square[right]], axis=1).T)
    for i in range(0, len(left), TILE):
        for j in range(i if ahead else 0, len(right), 8 * TILE):
            near = a[i : i + TILE] @ b[:, j : j + 8 * TILE] <= share
            if near.any():
                u, v = np.divmod(np.flatnonzero(near), near.shape[1])
                keep = u + i < v + j if ahead else slice(None)
                yield left[u[keep] + i], right[v[keep] + j]


def _join(distance: float, cosine: float, kind: type):
    """Links within one group: (id, links, root) for its vectors that have any."""

    def run(table: pa.Table) -> pa.Table:
        dim, block, i, j = (table.column(c)[0].as_py() for c in ("dim", "block", "i", "j"))
        ids, weight = table.column("id").to_numpy(), table.column("weight").to_numpy()
        home, chunk = table.column("home").to_numpy().astype(bool), table.column("chunk").to_numpy()
        vectors = scaled(_packed_rows(table.column("vector"), dim, kind))
        edges = block_edges(dim)
        shares = distance * np.diff(edges) / dim * (1 + SLACK)
        unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
        part = (unit @ rotation(dim)[:, edges[block] : edges[block + 1]]).astype(np.float32)
        of = lambda where: np.flatnonzero(where)
        if i == j:
            meetings = [(of(home), of(home), True), (of(home), of(~home), False)]
        else:
            first, second = chunk == i, chunk == j
            meetings = [(of(first & home), of(second), False), (of(first & ~home), of(second & home), False)]
        links = np.zeros(len(ids), np.int64)
        found: list[tuple[np.ndarray, np.ndarray]] = []
        for left, right, ahead in meetings:
            for u, v in _near(part, left, right, ahead, shares[block] + 1e-5):
                for k in range(0, len(u), 1 << 15):
                    p, q = u[k : k + (1 << 15)], v[k : k + (1 << 15)]
                    turn = ids[p] > ids[q]  # by id, so that rounding is the same in every group
                    p, q = np.where(turn, q, p), np.where(turn, p, q)
                    rows, at = np.unique(np.concatenate([p, q]), return_inverse=True)
                    exact = vectors[rows]
                    x, y = at[: len(p)], at[len(p) :]
                    points = rotated(exact)
                    apart = np.add.reduceat((points[x] - points[y]) ** 2, edges[:-1], axis=1) <= shares
                    lengths = np.sqrt(np.einsum("ij,ij->i", exact, exact))
                    linked = np.einsum("ij,ij->i", exact[x], exact[y]) / (lengths[x] * lengths[y]) >= cosine
                    linked &= apart[:, block] & ~apart[:, :block].any(axis=1)
                    p, q = p[linked], q[linked]
                    np.add.at(links, p, weight[q])
                    np.add.at(links, q, weight[p])
                    if len(p):
                        found.append(roots(p, q))
        nodes, root = np.zeros(0, np.int64), np.zeros(0, np.int64)
        if found:
            nodes, root = roots(np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found]))
        return pa.table({"id": ids[nodes], "links": links[nodes], "root": ids[root]})

    return run


def _is_usable(vector: Column) -> Column:
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))
    return vector.isNotNull() & F.forall(vector, finite) & F.exists(vector, lambda x: x != 0)


def cosine_links(vectors: DataFrame, cosine: float = 0.9) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every vector: links of cosine or more, smallest vec_id reached by them."""
    distance = 2 - 2 * cosine
    # floats are stored as floats; any other number as a double, so that nothing is rounded
    kind, name = (np.float32, "float") if vectors.schema["embedding"].dataType.elementType == FloatType() else (np.float64, "double")
    rows = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("embedding").cast(f"array<{name}>").alias("embedding"))
    rows = rows.where("vec_id is not null").groupBy("vec_id").agg(F.min("embedding").alias("embedding"))
    usable = F.coalesce(_is_usable(F.col("embedding")), F.lit(False))
    same = [F.xxhash64("embedding").alias("f1"), F.xxhash64(F.lit(1), F.reverse("embedding")).alias("f2")]
    rows = stored(rows.select("vec_id", F.when(usable, F.col("embedding")).alias("embedding")).select("*", *same), "vectors")
    good = rows.where("embedding is not null")

    classes = good.groupBy("f1", "f2").agg(F.min("vec_id").alias("id"), F.count("*").alias("weight"))
    classes = stored(classes, "vector-classes")
    whole = good.select(F.col("vec_id").alias("id"), "embedding").join(classes.select("id", "weight"), "id")
    whole = stored(whole.mapInArrow(_packed(kind), "id bigint, weight bigint, slot bigint, vector binary"), "vector-bytes")

    sizes = whole.mapInArrow(_cell_sizes(distance, kind), "dim bigint, block bigint, x bigint, y bigint, n bigint")
    # at most a few cells per block, as coordinates of unit vectors are within -1 and 1
    sizes = sizes.groupBy("dim", "block", "x", "y").agg(F.sum("n").alias("n")).where(F.col("n") > CHUNK).collect()
    chunks = {(r["dim"], r["block"], r["x"], r["y"]): -(-r["n"] // CHUNK) for r in sizes}
    groups = whole.mapInArrow(_placed(distance, chunks, kind), PLACED).groupBy("dim", "block", "x", "y", "i", "j")
    found = stored(groups.applyInArrow(_join(distance, cosine, kind), "id bigint, links bigint, root bigint"), "vector-links")

    counted = found.groupBy("id").agg(F.sum("links").alias("links"))
    reached = components(found.select("id", "root"))
    known = classes.join(counted, "id", "left").join(reached, "id", "left")
    known = known.select("f1", "f2", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"), F.coalesce("component", "id").alias("component_id"))
    known = stored(known, "vector-classes-linked")
    forget(whole)
    linked = good.select("vec_id", "f1", "f2").join(known, ["f1", "f2"]).select("vec_id", "n_links", "component_id")
    single = rows.where("embedding is null").select("vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"))
    nothing = F.lit(None).cast("bigint")
    nameless = vectors.where("vec_id is null").select(nothing.alias("vec_id"), F.lit(0).cast("bigint").alias("n_links"), nothing.alias("component_id"))
    out = linked.unionByName(single).unionByName(nameless)
    return out.select("vec_id", "n_links", "component_id", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)).alias("kept"))


def _packed(kind: type):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from rillmark.llm.words import mixed

        for batch in batches:
            vectors = [np.asarray(v, kind).tobytes() for v in batch.column("embedding").to_pylist()]
            slot = (mixed(batch.column("id").to_numpy().astype(np.uint64)) >> np.uint64(1)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("weight"), pa.array(slot), pa.array(vectors, pa.binary())], names=["id", "weight", "slot", "vector"])

    return run
