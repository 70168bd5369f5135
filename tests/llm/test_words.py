import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from rillmark.llm.components import components, roots
from rillmark.llm.words import ALPHANUMERIC, BETWEEN_BLANKS, shingles, word_hash, words_of

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="aB9 \t\n,;é中", max_size=60)), max_size=8)


def spelled(words):
    return [(int(r), bytes(words.data[a:b]).decode()) for r, a, b in zip(words.row, words.begin, words.end)]


@settings(max_examples=80, deadline=None)
@given(TEXTS)
def test_words_equal_regular_expressions(texts):
    column = pa.array(texts, pa.string())
    for inside, pattern in ((BETWEEN_BLANKS, r"[^\x20\x09-\x0D]+"), (ALPHANUMERIC, r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")):
        expected = [(i, w) for i, t in enumerate(texts) for w in re.findall(pattern, t or "")]
        words = words_of(column, inside)
        assert spelled(words) == expected
        assert [int(h) for h in words.hash] == [int(word_hash(w.translate(LOWER))) for _, w in expected]


@settings(max_examples=60, deadline=None)
@given(TEXTS, st.integers(1, 5))
def test_shingles_equal_sets(texts, n):
    row, value, sizes = shingles(words_of(pa.array(texts, pa.string())), n)
    lists = [(t or "").translate(LOWER).split() for t in texts]
    lists = [re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOWER)) for t in texts]
    sets = [{tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))} if w else set() for w in lists]
    assert sizes.tolist() == [len(s) for s in sets]
    for i, a in enumerate(sets):
        for j, b in enumerate(sets):
            assert len(np.intersect1d(value[row == i], value[row == j])) == len(a & b)


def test_words_longer_than_a_segment_hash_alike(monkeypatch):
    text = "ab " + "Xy9" * 5000 + " c " + "z" * 4096
    whole = words_of(pa.array([text])).hash
    from rillmark.llm import words as module

    monkeypatch.setattr(module, "SEGMENT", 64)
    assert words_of(pa.array([text])).hash.tolist() == whole.tolist()


def test_long_words_in_pieces():
    words = words_of(pa.array(["a " + "b" * 25 + " cc", "d" * 10]), longest=10)
    assert spelled(words) == [(0, "a"), (0, "b" * 10), (0, "b" * 10), (0, "b" * 5), (0, "cc"), (1, "d" * 10)]


def test_chunks_are_bounded_in_rows_and_bytes():
    from rillmark.llm.frames import row_chunks

    batch = pa.RecordBatch.from_arrays([pa.array(["x" * (k % 50) for k in range(1000)] + [None, "y" * 5000])], names=["text"])
    parts = list(row_chunks(iter([batch, batch.slice(0, 0)]), "text", 600, 100))
    assert pa.Table.from_batches(parts).column(0).to_pylist() == batch.column(0).to_pylist()
    sizes = [sum(len(t or "") for t in p.column(0).to_pylist()) for p in parts]
    assert all(p.num_rows <= 100 for p in parts) and sorted(sizes)[-1] == 5000 and sorted(sizes)[-2] <= 600


def test_long_words_and_slices():
    texts = pa.array(["a", "x" * 700_000 + " y", None, "z"], pa.string())
    assert len(words_of(texts).row) == 4
    assert spelled(words_of(texts.slice(2, 2))) == [(1, "z")]
    assert len(words_of(pa.array([], pa.string())).row) == 0


def brute(edges):
    label = {x: x for e in edges for x in e}
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            low = min(label[a], label[b])
            changed |= label[a] != low or label[b] != low
            label[a] = label[b] = low
    return label


@pytest.mark.parametrize("seed, part", [(0, 100_000), (1, 30), (2, 7)])
def test_components(spark, monkeypatch, seed, part):
    from rillmark.llm import components as module

    monkeypatch.setattr(module, "PART", part)
    draw = np.random.default_rng(seed)
    edges = [(int(a), int(b)) for a, b in draw.integers(0, 120, (70, 2))] + [(k, k + 1) for k in range(200, 240)] + [(300, k) for k in range(301, 330)]
    nodes, root = roots(np.array([e[0] for e in edges]), np.array([e[1] for e in edges]))
    assert dict(zip(nodes.tolist(), root.tolist())) == brute(edges)
    found = {r["id"]: r["component"] for r in components(spark.createDataFrame(edges, "u bigint, v bigint").repartition(5)).collect()}
    assert found == {k: v for k, v in brute(edges).items() if k in found}
    assert set(found) >= {x for a, b in edges if a != b for x in (a, b)}


def test_no_links(spark):
    assert components(spark.createDataFrame([], "u bigint, v bigint")).count() == 0
