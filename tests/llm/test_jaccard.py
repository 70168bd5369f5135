from fractions import Fraction

import numpy as np
import pytest

from rillmark.llm import jaccard
from rillmark.llm.jaccard import boundary, jaccard_components, least_difference, listed, needed, one_of_each_group, parity, subset_plan


def sets_of(rows, n):
    out = {}
    for k, text, *_ in rows:
        if k is None:
            continue
        w = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")).split()
        out.setdefault(k, []).append({tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))} if w else set())
    return out


def brute(rows, n, t):
    sets = sets_of(rows, n)
    label = {k: k for k in sets}
    linked = [(a, b) for a in sets for b in sets if a < b and any(x and y and len(x & y) >= t * len(x | y) for x in sets[a] for y in sets[b])]
    for _ in sets:
        for a, b in linked:
            label[a] = label[b] = min(label[a], label[b])
    return {k: (max(map(len, sets[k])), label[k]) for k in sets}


def found(docs, n, t):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_components(docs, n, t).collect()}


def near_copies(seed, words=300, bases=14):
    """Texts of 1 to 90 words in groups of copies with a few edits, a passage that many share, and very short texts."""
    draw = np.random.default_rng(seed)
    vocabulary = [f"w{k}" for k in range(words)]
    passage = list(draw.choice(vocabulary, 12))
    rows, k = [], 0
    for _ in range(bases):
        size = int(draw.integers(1, 90))
        base = list(draw.choice(vocabulary, size))
        for _ in range(int(draw.integers(1, 14))):
            text = list(base)
            for _ in range(int(draw.integers(0, 4))):
                at = int(draw.integers(len(text)))
                text[at : at + int(draw.integers(0, 2))] = [str(draw.choice(vocabulary))] * int(draw.integers(0, 2))
            if draw.random() < 0.3:
                text = text + passage
            rows.append((k, " ".join(text).upper() if k % 7 == 0 else " ".join(text)))
            k += 1
    return [rows[i] for i in draw.permutation(len(rows))]


@pytest.mark.parametrize("seed, n, t", [(1, 4, Fraction(85, 100)), (2, 5, Fraction(8, 10)), (3, 1, Fraction(7, 10)), (4, 2, Fraction(1))])
def test_components_equal_brute_force(documents, seed, n, t):
    rows = near_copies(seed, words=40 if n == 1 else 300)
    assert found(documents(rows), n, t) == brute(rows, n, t)


@pytest.mark.parametrize("light", [0, 12, 30])
def test_any_boundary_gives_the_same(documents, monkeypatch, light):
    rows = near_copies(9)
    monkeypatch.setattr(jaccard, "boundary", lambda sizes, t: light)
    assert found(documents(rows), 4, Fraction(85, 100)) == brute(rows, 4, Fraction(85, 100))


def test_long_lists_are_split(documents, monkeypatch):
    monkeypatch.setattr(jaccard, "LARGE_CLASSES", 10)
    rows = [(k, f"{'a b c d e f g h i j k l m n o p q r s t u v w x y z ' * 1}{k % 40} {k % 3}") for k in range(120)]
    real = jaccard._signatures
    monkeypatch.setattr(jaccard, "_signatures", lambda n, t, light, levels, large: real(n, t, light, np.full_like(levels, 160), large))  # 2**20 members expected
    assert found(documents(rows), 4, Fraction(8, 10)) == brute(rows, 4, Fraction(8, 10))


def test_plans():
    t = Fraction(85, 100)
    for s in range(1, 30):
        for p, left in subset_plan(s, 40, t):
            o = needed(s, p, t)
            assert s - left == o and Fraction(o, s + p - o) >= t > (Fraction(o - 1, s + p - o + 1) if o else 0)
        assert listed(s, t) == s - -(-85 * s // 100) + 1
    assert boundary({}, t) == 0 and boundary({3: 1000}, t) >= 3 and boundary({40: 10**6}, t) < 40


def test_parity_is_a_lower_bound():
    draw = np.random.default_rng(0)
    for _ in range(50):
        pool = draw.integers(0, 1 << 63, 400, dtype=np.uint64)
        a, b = (np.unique(draw.choice(pool, int(draw.integers(1, 300)))) for _ in "ab")
        assert least_difference(parity(a), parity(b)) <= len(np.setxor1d(a, b))


def test_edges(documents):
    t = Fraction(85, 100)
    assert jaccard_components(documents([]), 4, t).collect() == []
    rows = [(5, None), (1, ""), (2, " \t\n"), (3, "a b"), (9, "A\nB"), (4, "a b c"), (7, "long " * 60_000), (8, "long " * 50_000), (None, "a b"), (None, None)]
    got = found(documents(rows), 4, t)
    assert got == {5: (0, 5), 1: (0, 1), 2: (0, 2), 3: (1, 3), 9: (1, 3), 4: (1, 4), 7: (1, 7), 8: (1, 7), None: got[None]}
    repeated = [(1, "a b c d e"), (1, "a b c d e"), (2, "a b c d e"), (2, "p q r s t u v"), (3, "p q r s t u v")]
    assert found(documents(repeated), 4, t) == brute(repeated, 4, t) == {1: (2, 1), 2: (4, 1), 3: (4, 1)}
    assert jaccard_components(documents(rows), 4, t).where("doc_id is null").count() == 2


def test_one_of_each_group(documents):
    rows = [*near_copies(4), (None, "x"), (None, None), (1000, "z z"), (1000, "y")]
    docs = documents(rows)
    kept = one_of_each_group(docs, 5, Fraction(8, 10))
    assert kept.schema == docs.schema
    expected = sorted(k for k, (_, c) in brute(rows, 5, Fraction(8, 10)).items() if k == c)
    assert sorted(r["doc_id"] for r in kept.collect() if r["doc_id"] is not None) == expected
    assert kept.where("doc_id is null").count() == 2
