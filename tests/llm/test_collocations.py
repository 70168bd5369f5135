import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from rillmark.llm import collocations as c
from rillmark.llm.collocations import collocations, heavy_prefixes, phrase_counts, scored

KIND = "doc_id bigint, text string, lang string, phrase string, n int, rank int, f bigint"
VOCABULARY = ["the", "of", "The", "new", "york", "é", "Éa", "city", "a b", "x1", "don't", "zé", "A", "state", "île"]
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def make(spark, rows):
    return spark.createDataFrame([(i, t, lang, "p", 1, 2, 3) for i, (t, lang) in enumerate(rows)], KIND).repartition(4)


def counts(rows, depth):
    f, n = Counter(), Counter()
    for text, lang in rows:
        lang = lang or "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\n-\r]", (text or "").translate(str.maketrans(UPPER, LOWER))):
            words = re.findall(r"[^ \t]+", piece)
            n[lang] += len(words)
            for i in range(len(words)):
                for k in range(1, depth + 1):
                    if i + k <= len(words):
                        f[lang, tuple(words[i : i + k])] += 1
    return f, n


def expected(rows, least, depth=5, top=2000, covered=100):
    f, n = counts(rows, depth)
    candidates = {p: a for p, a in f.items() if len(p[1]) > 1 and a >= least}
    out = {}
    for (lang, p), a in candidates.items():
        inside = lambda q: any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))
        if any(x == lang and len(q) > len(p) and 100 * b >= covered * a and inside(q) for (x, q), b in candidates.items()):
            continue
        low = min((1000 * a * n[lang] // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p)))
        out.setdefault(lang, []).append((-low[0], -a, " ".join(p).encode(), f[lang, p[: low[1]]], f[lang, p[low[1] :]], low[1]))
    return sorted(
        (lang, i + 1, p.decode(), -a, left, right, n[lang], -s, k) for lang, found in out.items() for i, (s, a, p, left, right, k) in enumerate(sorted(found)[:top])
    )


def found(spark, rows, **how):
    return sorted(map(tuple, collocations(make(spark, rows), **how).collect()))


def corpus(seed, n=150, hot=False):
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        words = rng.choices(VOCABULARY, [9, 7, 3, 5, 5, 2, 1, 3, 1, 1, 1, 1, 2, 2, 1], k=rng.randrange(1, 60))
        text = "".join(w + rng.choice([" "] * 8 + ["  ", "\t", ", ", ". ", "\r\n", "!", "\x0b"]) for w in words)
        rows.append(("New York city state of the " * rng.randrange(3, 40) if hot and rng.random() < 0.4 else text, rng.choice(["en", "en", "en", "de", None, "und", ""])))
    return rows


@pytest.mark.parametrize("seed,least,ranges,hot", [(0, 5, 10**6, False), (1, 5, 200, False), (2, 12, 60, True), (3, 3, 25, True)])
def test_against_brute_force(spark, monkeypatch, seed, least, ranges, hot):
    monkeypatch.setattr(c, "SAMPLE_SHARE", 0.5)
    rows = corpus(seed, hot=hot)
    assert found(spark, rows, least=least, range_words=ranges) == expected(rows, least)


def test_limits_and_cover(spark, monkeypatch):
    monkeypatch.setattr(c, "SAMPLE_SHARE", 0.5)
    rows = corpus(9, hot=True)
    assert found(spark, rows, least=4, depth=3, top=7, covered=60, range_words=300) == expected(rows, 4, 3, 7, 60)


def test_all_counts_for_any_number_of_ranges(spark, monkeypatch):
    monkeypatch.setattr(c, "SAMPLE_SHARE", 1.0)
    rows = corpus(5, 60, hot=True)
    f, n = counts(rows, 5)
    want = {(lang, " ".join(p), len(p), k) for (lang, p), k in f.items() if k >= 6}
    for words in (10**6, 500, 20, 3):
        phrases, totals = phrase_counts(make(spark, rows), least=6, range_words=words)
        assert {tuple(r) for r in phrases.collect()} == want
        assert dict(map(tuple, totals.collect())) == dict(n)


def test_equal_hashes(spark, monkeypatch):
    """Words that share a hash, in routing and in slots, are still counted apart."""
    import inspect

    source = inspect.getsource(c.hashes).replace("zlib.crc32", "lambda w: len(w) % 2")
    scope = {"np": np}
    exec(source.replace("from __future__ import annotations", ""), scope)
    monkeypatch.setattr(c, "SAMPLE_SHARE", 1.0)
    # workers import the module anew, so the pieces are called here
    plain = c.hashes
    rng = random.Random(4)
    lines = [rng.choices(["aa", "bb", "c", "d"], k=rng.randrange(1, 6)) for _ in range(3000)]
    data = b"".join(" ".join(x).encode() + b"\n" for x in lines)
    want = Counter(tuple(x[:k]) for x in lines for k in range(1, len(x) + 1))
    try:
        c.hashes = scope["hashes"]
        cut = np.array([1, 1, 1, 1, 1])
        got = {(p, n): k for p, n, k in c.range_counts(data, np.ones(3000, np.int64), [cut, cut], 50, 5)}
    finally:
        c.hashes = plain
    assert got == {(" ".join(p).encode(), len(p)): k for p, k in want.items()}


def test_spans(monkeypatch):
    monkeypatch.setattr(c, "COPIED", 7)
    rng = np.random.default_rng(1)
    data = rng.integers(0, 255, 200).astype(np.uint8)
    for n in (1, 5, 60):
        starts, sizes = rng.integers(0, 150, n), rng.integers(1, 40, n)
        got = c.spans(data, starts, np.concatenate([[0], np.cumsum(sizes)]))
        assert got.tolist() == [x for a, k in zip(starts, sizes) for x in data[a : a + k].tolist()]


def test_quicksort():
    rng = np.random.default_rng(0)
    columns = [rng.zipf(1.5, 5000).clip(max=50) for _ in range(3)]
    columns[1][rng.random(5000) < 0.2] = 0
    columns[2][columns[1] == 0] = 0
    weights = rng.integers(1, 5, 5000)
    want = Counter()
    for i in range(5000):
        for d in range(3):
            if columns[d][i] == 0:
                break
            want[tuple(int(x[i]) for x in columns[: d + 1])] += int(weights[i])
    got = {tuple(int(x[p]) for x in columns[:d]): w for p, d, w in heavy_prefixes(columns, weights, 40)}
    assert got == {k: w for k, w in want.items() if w >= 40}


def test_exact_beyond_64_bits(spark):
    big = 4 * 10**12
    phrases = spark.createDataFrame([("en", "a b", 2, big - 1), ("en", "a", 1, big + 7), ("en", "b", 1, big + 1)], "lang string, phrase string, n_words int, f bigint")
    totals = spark.createDataFrame([("en", 9 * 10**17)], "lang string, n bigint")
    assert scored(phrases, totals).first()["score"] == 1000 * (big - 1) * 9 * 10**17 // ((big + 7) * (big + 1))


def test_edges(spark):
    assert found(spark, [], least=1) == []
    rows = [(None, "en"), ("", None), (" \t,.;", "en"), ("one", None), ("a a a a a a a", "fr")] + [("same words here", "en")] * 3 + [("x " * 100_000, "de"), ("y" * 300_000 + " z", None)]
    assert found(spark, rows, least=1) == expected(rows, 1)
    found_in = collocations(make(spark, rows), least=1)
    assert dict(found_in.dtypes) == {"lang": "string", "rank": "bigint", "phrase": "string", "a": "bigint", "l": "bigint", "r": "bigint", "n": "bigint", "score": "bigint", "k": "int"}
    assert found_in.agg(F.max("rank")).first()[0] <= 2000
