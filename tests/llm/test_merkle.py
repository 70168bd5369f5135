import hashlib
import random
import zlib

import pytest

from rillmark.llm import merkle
from rillmark.llm.frames import stored
from rillmark.llm.merkle import build, document_leaves, folded, proofs, verified_manifest

KIND = "doc_id bigint, text string, lang string, source string, n_chars bigint, leaf string, root string, pos int"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row, text):
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (row[0], row[3], row[2], row[4], text)))


def tree(nodes):
    """All levels and, for each lowest node, its runs of (before, behind)."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([h(*levels[-1][i : i + 3]) for i in range(0, len(levels[-1]), 3)])
    paths = []
    for i in range(len(nodes)):
        path = []
        for level in levels[:-1]:
            run = i // 3 * 3
            path.append(("".join(level[run:i]), "".join(level[i + 1 : run + 3])))
            i //= 3
        paths.append(path)
    return levels[-1][0], paths


def expected(rows):
    by = {}
    for r in rows:
        by.setdefault(r[3], []).append(r)
    sources = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    subs, paths = {}, {}
    for s in sources:
        by[s].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r, r[1])))
        subs[s], paths[s] = tree([leaf_of(r, r[1]) for r in by[s]])
    if not rows:
        return []
    root, over = tree([subs[s] for s in sources])
    out = []
    for s, upper in zip(sources, over):
        for r, path in zip(by[s], paths[s]):
            path = path + upper
            even = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0
            node = leaf_of(r, None if r[1] is None else r[1].replace("\n", "")) if even else leaf_of(r, r[1])
            for a, b in path:
                node = h(a, node, b)
            out.append((r[0], leaf_of(r, r[1]), subs[s], root, h(*(a + b for a, b in path)), node, node == root))
    return sorted(out, key=str)


def found(spark, rows):
    df = verified_manifest(spark.createDataFrame(rows, KIND).repartition(3))
    return sorted(map(tuple, df.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect()), key=str)


def row(k, text, source="a", lang="en", n=None):
    return (k, text, lang, source, n, "x", "y", 1)


@pytest.mark.parametrize("sizes", [[1], [1, 1], [3, 1, 81, 82], [2, 243, 7, 1, 1, 1], [700, 5]])
def test_against_plain_trees(spark, sizes, monkeypatch):
    monkeypatch.setattr(merkle, "STEPS", 2)
    rows = [row(1000 * j + 7 * i, f"text {i}\nline é" if i % 3 else f"one line {i}", f"s{j}", None if i % 5 == 0 else "de", i) for j, n in enumerate(sizes) for i in range(n)]
    random.Random(1).shuffle(rows)
    out = found(spark, rows)
    assert out == expected(rows)
    changed = {r[0] for r in rows if "\n" in r[1] and zlib.crc32(str(r[0]).encode()) % 2 == 0}
    assert {r[0] for r in out if not r[-1]} == changed


def test_many_sources(spark, monkeypatch):
    monkeypatch.setattr(merkle, "STEPS", 1)
    rows = [row(i, f"t\n{i}", f"site{i // 2}é") for i in range(60)]
    assert found(spark, rows) == expected(rows)


def test_edges(spark):
    rows = [
        row(4, None), row(None, "no id\n"), row(None, "no id, again"), row(3, "", None), row(3, "", None), row(8, "\n\n", None, None, 2), row(9, "x\n" * 200_000, ""),
        row(2, "same"), row(2, "same"), row(2, "Same"), row(5, "-", "-"), row(1, "\n", "é"), row(1, "\n", "z"),
    ]
    assert found(spark, rows) == expected(rows)
    assert found(spark, []) == []
    assert found(spark, [row(6, "only\n")]) == expected([row(6, "only\n")])


def test_paths_lead_to_the_root(spark):
    from pyspark.sql import functions as F

    rows = [row(i, f"t{i}", f"s{i % 4}") for i in range(300)]
    docs = spark.createDataFrame(rows, KIND)
    manifest = build(document_leaves(docs, F.lit(False), F.col("text")))
    assert len(manifest.documents) == 1 and len(manifest.sources) == 1
    out = proofs(manifest, digests=False, paths=True).collect()
    assert len(out) == 300 and len({r["root"] for r in out}) == 1
    for r in out:
        path = [(x["before"], x["behind"]) for x in r["path"]]
        assert folded(r["leaf"], path) == r["root"] and folded(h("other"), path) != r["root"]


def test_stored_levels(spark, monkeypatch):
    """One level in STEPS is stored, and no row holds more than a subtree."""
    monkeypatch.setattr(merkle, "STEPS", 2)
    leaves = stored(spark.range(1000).selectExpr("'a' tree", "id doc_id", "sha2(string(id), 256) node", "string(null) tampered"), "t")
    levels, roots = merkle.forest(leaves, ["doc_id"])
    assert [level.selectExpr("sum(size(items))").first()[0] for level in levels] == [1000, 112, 13, 2]
    assert max(level.selectExpr("max(size(items))").first()[0] for level in levels) == 9
    assert roots.first()["node"] == tree([h(str(i)) for i in range(1000)])[0]
