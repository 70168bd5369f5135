"""Merkle manifest of a table: a tree per source, a tree over the sources, and proofs.

Checkpoint and recompute: of all levels of a tree only every ``STEPS``-th is stored, as rows
of aligned subtrees (at most ``FAN ** STEPS`` consecutive nodes of one stored level).
Building folds each subtree to its top and stores nothing in between. A proof is extracted
from above: a subtree takes the siblings of its top from the stored level over it,
regenerates its own interior nodes from its stored nodes, emits the siblings of each of
them and discards the interior again. Documents never carry a path of their own.

Places within a source are positions in a range-sorted table plus the sizes of the parts
before, so one source may hold nearly all rows; no task orders a source, and a group is
one subtree. A table of many sources has its sources ranked the same way.

Defined results: a null is written `-`, any other value as its UTF-8 byte count, `:` and the
value. Leaves of a source stand by doc_id (nulls first), ties by leaf; repeated rows are
leaves each. A null source is a source of its own and stands first. A lone leaf is its
subroot, a lone subroot the root. Rows without doc_id are never tampered with. An empty
table gives no rows. Extra columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rillmark.llm.frames import stored
from rillmark.llm.labelled import crc_of

FAN = 3
#: Levels from one stored level to the next.
STEPS = 4
_POSITION_BITS = 33  # monotonically_increasing_id: partition number above, row number below

Path = list[tuple[str, str]]


def digest(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(column: str | Column) -> Column:
    """A value as the leaf digest takes it."""
    text = (F.col(column) if isinstance(column, str) else column).cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_digest(text: Column) -> Column:
    return F.sha2(F.concat(field("doc_id"), field("source"), field("lang"), field("n_chars"), field(text)), 256)


def document_leaves(docs: DataFrame, tampered: Column, changed: Column) -> DataFrame:
    """(tree, doc_id, node, tampered): leaf of each row, and the leaf of its ``changed`` text where ``tampered``."""
    return docs.select(
        F.col("source").cast("string").alias("tree"), F.col("doc_id").cast("bigint").alias("doc_id"), leaf_digest(F.col("text")).alias("node"),
        F.when(tampered, leaf_digest(changed)).alias("tampered"),
    )


# ---- nodes of one subtree, in a task


def level_above(nodes: list[str]) -> list[str]:
    return [digest(*nodes[i : i + FAN]) for i in range(0, len(nodes), FAN)]


def height(n: int) -> int:
    """Levels over ``n`` nodes until one is left."""
    levels = 0
    while n > 1:
        n, levels = -(-n // FAN), levels + 1
    return levels


def interior(nodes: list[str], levels: int) -> list[list[str]]:
    """The given nodes and the ``levels`` levels over them."""
    out = [nodes]
    for _ in range(levels):
        out.append(level_above(out[-1]))
    return out


def siblings(levels: list[list[str]], i: int) -> Path:
    """For node ``i`` of the lowest level: what stands before and behind it in its run, level by level, without the top."""
    path = []
    for nodes in levels[:-1]:
        first = i - i % FAN
        path.append(("".join(nodes[first:i]), "".join(nodes[i + 1 : first + FAN])))
        i //= FAN
    return path


def folded(node: str, path: Path) -> str:
    for before, behind in path:
        node = digest(before, node, behind)
    return node


# ---- trees as tables


def placed(items: DataFrame, order: list[str]) -> DataFrame:
    """``items`` (tree, node, ...) with ``pos``, the place from 0 in its tree by ``order``, and ``n``, the nodes of its tree."""
    items = items.withColumn("_row", F.monotonically_increasing_id())  # splits repeated rows; the input is a stored table
    by = [F.asc_nulls_first(c) for c in ("tree", *order, "_row")]
    located = stored(items.repartitionByRange(*by).sortWithinPartitions(*by).drop("_row").withColumn("_slot", F.monotonically_increasing_id()), "merkle-placed")
    part = F.shiftright("_slot", _POSITION_BITS)
    parts = located.groupBy(part.alias("_part"), F.col("tree").alias("_tree")).agg(F.count("*").alias("_rows"), F.min("_slot").alias("_first"))
    tree = Window.partitionBy("_tree")
    before = tree.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("_part", "_tree", "_first", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_skip"), F.sum("_rows").over(tree).alias("n"))
    met = located.join(parts, (part == F.col("_part")) & F.col("tree").eqNullSafe(F.col("_tree")))
    return met.withColumn("pos", F.col("_skip") + F.col("_slot") - F.col("_first")).drop("_slot", "_part", "_tree", "_first", "_skip")


def subtrees(nodes: DataFrame) -> DataFrame:
    """(tree, block, n, items): rows of at most ``FAN ** STEPS`` nodes with consecutive places, stored."""
    rest = [c for c in nodes.columns if c not in ("tree", "n")]
    item = F.struct("pos", *[c for c in rest if c != "pos"])
    blocks = nodes.groupBy("tree", F.expr(f"pos div {FAN**STEPS}").alias("block")).agg(F.max("n").alias("n"), F.sort_array(F.collect_list(item)).alias("items"))
    return stored(blocks, "merkle-level")


def tops(blocks: DataFrame) -> DataFrame:
    """(tree, pos, n, node): the top of every subtree, as nodes of the next stored level."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.column("n").to_pylist()
            nodes = batch.column("nodes").to_pylist()
            top = [interior(x, min(STEPS, height(k)))[-1][0] for x, k in zip(nodes, n)]
            left = [-(-k // FAN**STEPS) for k in n]
            yield pa.RecordBatch.from_arrays([batch.column("tree"), batch.column("block"), pa.array(left, pa.int64()), pa.array(top, pa.string())], names=["tree", "pos", "n", "node"])

    return blocks.select("tree", "block", "n", F.col("items.node").alias("nodes")).mapInArrow(run, "tree string, pos bigint, n bigint, node string")


def forest(items: DataFrame, order: list[str]) -> tuple[list[DataFrame], DataFrame]:
    """Stored levels of the trees of ``items`` (tree, node, ...), lowest first, and their roots (tree, node)."""
    nodes = placed(items, order)
    levels, roots = [], []
    while True:
        levels.append(subtrees(nodes))
        above = stored(tops(levels[-1]), "merkle-tops")
        roots.append(above.where("n = 1").select("tree", "node"))
        nodes = above.where("n > 1")
        if nodes.isEmpty():
            break
    done = roots[0]
    for more in roots[1:]:
        done = done.unionByName(more)
    return levels, done


PATH = "array<struct<before:string,behind:string>>"


def _emitted(blocks: DataFrame, outer: DataFrame, above: DataFrame | None, carried: list[str]) -> DataFrame:
    """``blocks`` with ``path``, the path of their top, and the ``carried`` columns.

    The top of a tree's only subtree goes on by the path ``outer`` has for the tree, any
    other top by the path of the node that it is one level up.
    """
    last = blocks.where(F.col("n") <= FAN**STEPS)
    out = outer.withColumnRenamed("tree", "_tree")
    met = last.join(out, F.col("tree").eqNullSafe(F.col("_tree"))).select(*blocks.columns, "path", *carried)
    if above is not None:
        up = above.select(F.col("tree").alias("_tree"), F.col("pos").alias("_pos"), "path", *carried)
        more = blocks.where(F.col("n") > FAN**STEPS).join(up, F.col("tree").eqNullSafe(F.col("_tree")) & (F.col("block") == F.col("_pos")))
        met = met.unionByName(more.select(*blocks.columns, "path", *carried))
    return met


def opened(met: DataFrame, keep: list[str], carried: list[str], digests: bool, paths: bool) -> DataFrame:
    """One row per stored node of the subtrees ``met``: tree, pos, node, ``keep`` and ``carried`` columns, and on demand
    ``path`` (siblings from the node to the root) and the digests (proof_sha256, folded_root, verified)."""
    item = {f.name: f.dataType.simpleString() for f in met.schema["items"].dataType.elementType.fields}
    kinds = [("tree", "string"), ("pos", "bigint"), ("node", "string")] + [(k, item[k]) for k in keep] + [(c, "string") for c in carried]
    kinds += [("path", PATH)] if paths else []
    kinds += [("proof_sha256", "string"), ("folded_root", "string"), ("verified", "boolean")] if digests else []
    arrow = {"string": pa.string(), "bigint": pa.int64(), "boolean": pa.bool_(), PATH: pa.list_(pa.struct([("before", pa.string()), ("behind", pa.string())]))}
    schema = pa.schema([(k, arrow[t]) for k, t in kinds])

    def rows_of(block: dict) -> Iterator[dict]:
        items = block["items"]
        levels = interior([x["node"] for x in items], min(STEPS, height(block["n"])))
        up = [(x["before"], x["behind"]) for x in block["path"]]
        over = "".join(a + b for a, b in up)
        for i, x in enumerate(items):
            own = siblings(levels, i)
            row = {"tree": block["tree"], "pos": x["pos"], "node": x["node"]} | {k: x[k] for k in keep} | {c: block[c] for c in carried}
            if paths:
                row["path"] = [{"before": a, "behind": b} for a, b in own + up]
            if digests:
                row["proof_sha256"] = digest(*(a + b for a, b in own), over)
                row["folded_root"] = folded(x["tampered"] or x["node"], own + up)
                row["verified"] = row["folded_root"] == block["root"]
            yield row

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = []
            for k in range(batch.num_rows):
                held += rows_of(batch.slice(k, 1).to_pylist()[0])
                if len(held) >= 2000:
                    yield pa.RecordBatch.from_pylist(held, schema)
                    held = []
            if held:
                yield pa.RecordBatch.from_pylist(held, schema)

    return met.mapInArrow(run, ", ".join(f"`{k}` {t}" for k, t in kinds))


@dataclass
class Manifest:
    """Stored levels of the trees of all sources and of the tree over them, and the root (tree, root)."""

    documents: list[DataFrame]
    sources: list[DataFrame]
    root: DataFrame


def build(leaves: DataFrame) -> Manifest:
    """Manifest of ``leaves`` (tree, doc_id, node, ...)."""
    documents, subroots = forest(stored(leaves, "merkle-leaves"), ["doc_id", "node"])
    over = stored(subroots.select(F.lit("").alias("tree"), F.col("tree").alias("source"), "node"), "merkle-subroots")
    sources, root = forest(over, ["source"])
    return Manifest(documents, sources, root.withColumnRenamed("node", "root"))


def _from_above(levels: list[DataFrame], outer: DataFrame, carried: list[str]) -> DataFrame:
    """The lowest subtrees of a forest, each with the path of its top; paths of the levels between are stored."""
    above = None
    for level in reversed(levels[1:]):
        above = stored(opened(_emitted(level, outer, above, carried), [], carried, digests=False, paths=True), "merkle-paths")
    return _emitted(levels[0], outer, above, carried)


def proofs(manifest: Manifest, digests: bool = True, paths: bool = False) -> DataFrame:
    """(doc_id, leaf, source, pos, subroot, root) with digests of the proofs, with the paths, or both."""
    nothing = manifest.root.select("tree", "root", F.expr(f"cast(array() as {PATH})").alias("path"))
    over = opened(_from_above(manifest.sources, nothing, ["root"]), ["source"], ["root"], digests=False, paths=True)
    outer = stored(over.select(F.col("source").alias("tree"), F.col("node").alias("subroot"), "root", "path"), "merkle-outer")
    met = _from_above(manifest.documents, outer, ["subroot", "root"])
    out = opened(met, ["doc_id"], ["subroot", "root"], digests, paths)
    return out.withColumnsRenamed({"tree": "source", "node": "leaf"})


def verified_manifest(docs: DataFrame) -> DataFrame:
    """Manifest of ``docs`` and the check of every proof, where rows with an even crc32 of doc_id have lost their line feeds."""
    even = F.col("doc_id").isNotNull() & (crc_of("doc_id") % 2 == 0)
    return proofs(build(document_leaves(docs, even, F.replace(F.col("text"), F.lit("\n"), F.lit("")))))
