import numpy as np
import pytest

from rillmark.llm import embeddings
from rillmark.llm.embeddings import cosine_links


def brute(rows, cosine, kind=np.float32):
    good = {}
    for k, v in sorted((r for r in rows if r[0] is not None), key=lambda r: r[0]):
        if v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v):
            good[k] = np.asarray(v, kind).astype(np.float64)
            good[k] /= np.abs(good[k]).max()
    ids = sorted({r[0] for r in rows if r[0] is not None})
    links = {k: set() for k in ids}
    for a in good:
        for b in good:
            if a != b and len(good[a]) == len(good[b]) and good[a] @ good[b] / np.sqrt(good[a] @ good[a]) / np.sqrt(good[b] @ good[b]) >= cosine:
                links[a].add(b)
    label = {k: k for k in ids}
    for _ in ids:
        for a in ids:
            label[a] = min([label[a], *(label[b] for b in links[a])])
    return {k: (len(links[k]), label[k], label[k] == k) for k in ids}


def found(spark, rows, cosine=0.9, kind="float"):
    frame = spark.createDataFrame([(k, v, 1, "x") for k, v in rows], f"vec_id bigint, embedding array<{kind}>, label int, id string").repartition(4)
    return {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in cosine_links(frame, cosine).collect()}


def vectors(seed, dim, groups=8, spread=0.1):
    draw = np.random.default_rng(seed)
    out, k = [], 0
    for _ in range(groups):
        centre = draw.standard_normal(dim)
        for _ in range(int(draw.integers(1, 14))):
            v = (centre + spread * np.linalg.norm(centre) * draw.standard_normal(dim) / np.sqrt(dim) * draw.integers(0, 6)) * draw.uniform(0.1, 9)
            out += [(k, v.astype(np.float32).tolist())]
            k += 1
    return out


@pytest.mark.parametrize("dim, cosine, chunk", [(64, 0.9, 16_384), (64, 0.9, 7), (10, 0.9, 16_384), (1, 0.9, 16_384), (40, 0.7, 5)])
def test_links_equal_brute_force(spark, monkeypatch, dim, cosine, chunk):
    monkeypatch.setattr(embeddings, "CHUNK", chunk)
    rows = vectors(dim + chunk, dim)
    assert found(spark, rows, cosine) == brute(rows, cosine)


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, None), (2, []), (3, [0.0, 0.0]), (4, [nan, 1.0]), (5, [inf, 1.0]), (6, [None, 1.0]), (7, [1.0, 0.0]), (8, [2.0, 0.0]), (9, [1.0, 0.0]),
        (10, [1.0, 0.0, 0.0]), (11, [-1.0, 0.0]), (12, [0.9, 0.43588989]), (13, [1e-20, 0.0]),
    ]
    got = found(spark, [*rows, (None, [1.0, 0.0])])
    assert {k: v for k, v in got.items() if k is not None} == brute(rows, 0.9)
    assert got[None] == (0, None, True)
    assert found(spark, [(1, [1.0, 0.0]), (1, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [0.0, 3.0])]) == {1: (1, 1, True), 2: (1, 1, False)}
    assert found(spark, []) == {}


def test_equal_vectors_count_each(spark):
    rows = [(k, [1.0, 2.0, 3.0]) for k in range(5, 25)] + [(1, [1.0, 2.0, 3.1])]
    assert found(spark, rows) == brute(rows, 0.9)


def test_vectors_of_any_length(spark):
    """Copies of one vector by factors that would vanish or overflow when squared, as floats and as doubles."""
    draw = np.random.default_rng(5)
    one = draw.standard_normal(64)
    for kind, factors in (("float", [1, 1e-32, 1e-38, 1e20, 1e30]), ("double", [1, 1e-60, 1e60, 1e-200, 1e300])):
        rows = [(k, (one * f).tolist()) for k, f in enumerate(factors)] + [(9, draw.standard_normal(64).tolist())]
        got = found(spark, rows, kind=kind)
        assert got == {**{k: (4, 0, k == 0) for k in range(5)}, 9: (0, 9, True)}


def test_doubles_are_not_rounded(spark):
    rows = [(0, [1.0, 0.0])]
    for k, off in enumerate((1e-9, -1e-9, 1e-12, -1e-12), 1):
        c = 0.9 + off
        rows.append((k, [c, (1 - c * c) ** 0.5 * (-1) ** k]))
    got = found(spark, rows, kind="double")
    assert got == brute(rows, 0.9, np.float64) and got[0][0] == 2
