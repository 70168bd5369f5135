import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from rillmark.llm import quality as q
from rillmark.llm import toxicity as x
from rillmark.llm.recurrent import STRIDE, WINDOW, Network, distinct_words, window_ids, window_starts, windows_beside
from rillmark.llm.words import ALPHANUMERIC, word_hash, words_of

BAD = "grok blem snarf".split()


def texts(seed, n=260):
    """(doc_id, text, toxic, quality): toxic texts hold a bad word somewhere, poor ones are loud."""
    draw = np.random.default_rng(seed)
    vocabulary = [f"w{k}" for k in range(400)]
    rows = []
    for k in range(n):
        words = list(draw.choice(vocabulary, int(draw.integers(5, 150))))
        toxic, good = int(draw.random() < 0.3), int(draw.random() < 0.8)
        if toxic:
            words.insert(int(draw.integers(len(words) + 1)), str(draw.choice(BAD)))
        text = " ".join(words)
        rows.append((k, text if good else text.upper().replace(" ", "!! "), toxic, good))
    return rows


def labels(spark, rows):
    return spark.createDataFrame([(k, g, t, "x") for k, _, t, g in rows], "doc_id bigint, quality int, toxic int, text string")


@pytest.mark.parametrize("module, score, column, remainder, modulus", [(x, x.toxicity, 2, 2, 4), (q, q.quality, 3, 0, 5)])
def test_held_out_accuracy(spark, documents, module, score, column, remainder, modulus):
    rows = texts(1, 700)
    found = {r["doc_id"]: r for r in score(documents([r[:2] for r in rows]), labels(spark, rows)).collect()}
    assert len(found) == len(rows)
    out = [r for r in rows if found[r[0]]["held_out"]]
    assert {r[0] for r in out} == {r[0] for r in rows if zlib.crc32(str(r[0]).encode()) % modulus == remainder}
    assert np.mean([found[r[0]]["predicted"] == r[column] for r in out]) >= 0.95
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in found.values())


@pytest.mark.parametrize("score", [x.toxicity, q.quality])
def test_held_out_labels_do_not_matter(spark, documents, score):
    rows = texts(2, 200)
    modulus, remainder = (4, 2) if score is x.toxicity else (5, 0)
    turned = [(k, t, 1 - a, 1 - g) if zlib.crc32(str(k).encode()) % modulus == remainder else (k, t, a, g) for k, t, a, g in rows]
    one, two = (sorted((r["doc_id"], r["score"]) for r in score(documents([r[:2] for r in rows]), labels(spark, y)).collect()) for y in (rows, turned))
    assert one == two


@pytest.mark.parametrize("score", [x.toxicity, q.quality])
def test_edges(spark, documents, score):
    rows = texts(3, 150)
    docs = documents([*[r[:2] for r in rows], (7, "again"), (900, None), (901, ""), (902, " \t"), (None, "w1 w2"), (903, "w1 " * 60_000 + "grok")])
    nulls = spark.createDataFrame([(5, None, None, "x"), (None, 1, 1, "x"), (6, 7, 7, "x"), (0, 1, 0, "x")], "doc_id bigint, quality int, toxic int, text string")
    found = score(docs, labels(spark, rows).unionByName(nulls)).collect()
    assert len(found) == docs.count() and all(r["score"] is not None for r in found)
    assert score(documents([]), labels(spark, rows)).count() == 0
    one_kind = {r["score"] for r in score(docs, nulls.limit(0)).collect()}
    assert one_kind == {0.0}
    only_ones = spark.createDataFrame([(k, 1, 1, "x") for k in range(30)], nulls.schema)
    assert {r["score"] for r in score(docs, only_ones).where("doc_id is not null and doc_id not in (900, 901, 902)").collect()} == {1.0}


def test_without_toxic_keeps_columns(spark, documents):
    rows = texts(1, 700)
    docs = documents([*[r[:2] for r in rows], (900, None)]).withColumn("toxicity", F.lit("clash"))
    kept = x.without_toxic(docs, labels(spark, rows))
    assert kept.schema == docs.schema
    stay = {r["doc_id"] for r in kept.collect()}
    assert 900 in stay and np.mean([(r[0] in stay) == (r[2] == 0) for r in rows]) >= 0.97


def test_windows_overlap_and_cover():
    for n in (0, 1, 31, 32, 33, 47, 48, 49, 100, 1000):
        words = words_of(pa.array([" ".join(["w"] * n), "tail"]), ALPHANUMERIC)
        row, start, length = window_starts(words.first())
        own = row == 0
        assert set(np.concatenate([np.arange(a, a + k) for a, k in zip(start[own], length[own])] or [[]])) == set(range(n))
        assert (length[own] <= WINDOW).all() and (np.diff(start[own]) == STRIDE).all()


def test_windows_beside_are_all_full_ones_around():
    sizes = [0, 1, 32, 33, 40, 64, 0, 200, 0]
    first = words_of(pa.array([" ".join(["w"] * n) for n in sizes]), ALPHANUMERIC).first()
    _, start, _ = window_starts(first)
    for near in (start, start[::3], start[:0]):
        row, beside, length = windows_beside(first, near)
        expected = set()
        for a in near.tolist():
            i = max(k for k in range(len(sizes)) if first[k] <= a and sizes[k])
            expected |= {b for b in range(max(first[i], a - STRIDE + 1), min(a + STRIDE, first[i + 1] - WINDOW + 1)) if (b - first[i]) % STRIDE}
        assert beside.tolist() == sorted(expected)
        assert (length == WINDOW).all() and (first[row] <= beside).all() and (beside + WINDOW <= first[row + 1]).all()


def test_passages_cut_by_windows_score_as_in_all_windows(spark, documents):
    """Toxic passages of 17 to 32 words, each toxic by several words, at every offset of a clean text."""
    draw = np.random.default_rng(5)
    clean = lambda n: [f"w{k}" for k in draw.integers(0, 400, n)]
    passage = lambda n: [str(draw.choice(BAD)) if draw.random() < 0.15 else w for w in clean(n)]
    rows = [(k, " ".join([*clean(60), *(passage(24) if k % 3 == 0 else clean(24)), *clean(60)]), int(k % 3 == 0), 1) for k in range(600)]
    net = x.fit(documents([r[:2] for r in rows]), labels(spark, rows), F.lit(True))
    planted = [" ".join([*clean(40 + k % STRIDE), *passage(17 + k % 16), *clean(90)]) for k in range(160)] + [" ".join(clean(150)) for _ in range(160)]
    words = words_of(pa.array(planted), ALPHANUMERIC)
    every, near = x.worst_windows(net, words, 0.0), x.worst_windows(net, words)
    assert ((near >= x.FLAGGED) == (every >= x.FLAGGED)).mean() >= 0.99 and (near <= every + 1e-6).all()
    single = x.worst_windows(net, words_of(pa.array([planted[3]]), ALPHANUMERIC), 0.0)[0]
    text = planted[3].split()
    alone = max(x.worst_windows(net, words_of(pa.array([" ".join(text[a : a + WINDOW])]), ALPHANUMERIC))[0] for a in range(len(text) - WINDOW + 1))
    assert single >= alone - 1e-6


def test_gradients_equal_differences():
    words = words_of(pa.array(["ab cd ef gh ij " * 4, "xx yy zz"]), ALPHANUMERIC)
    distinct, number = distinct_words(words)
    _, start, length = window_starts(words.first())
    ids = window_ids(number, start, length, len(distinct.hash))
    net = Network(distinct.hash[:4])
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    target, weight = np.array([1.0, 0.0]), np.array([1.0, 2.0])

    def loss():
        s = net.score(distinct, number, start, length)
        return -(weight * (target * np.log(s) + (1 - target) * np.log(1 - s))).sum() / weight.sum()

    grads = net.gradients(distinct, ids, target, weight)
    for name, value in net.p.items():
        at = {"word": (1, 2), "char": (int(distinct.trigrams[0]), 1)}.get(name, tuple(0 for _ in value.shape))
        before = value[at]
        value[at] = before + 1e-2
        up = loss()
        value[at] = before - 1e-2
        down = loss()
        value[at] = before
        assert abs((up - down) / 2e-2 - grads[name][at]) < 1e-3, name


def test_padding_changes_nothing():
    words = words_of(pa.array(["ab cd ef", "ab cd ef " + "gh " * 40]), ALPHANUMERIC)
    distinct, number = distinct_words(words)
    _, start, length = window_starts(words.first())
    net = Network(np.array([word_hash("ab")]))
    together = net.score(distinct, number, start, length)
    assert np.allclose(together[:1], net.score(distinct, number, start[:1], length[:1]))


def test_nearest_votes_equal_brute_force():
    draw = np.random.default_rng(0)
    counts = draw.poisson(0.3, (40, 2 * q.TERMS + 1)).astype(np.float32)
    counts[3] = 0
    directions = np.linalg.qr(draw.standard_normal((counts.shape[1], 8)))[0].astype(np.float32)
    vectors = q._unit(draw.standard_normal((90, 8)).astype(np.float32))
    y = draw.integers(0, 2, 90).astype(np.float32)
    model = q.Model(np.ones(counts.shape[1], np.float32), directions, vectors, y, np.ones(90, np.float32), 0.7)
    for row, score in zip(counts, q.votes(model, counts, block=7)):
        v = np.log1p(row) @ directions
        near = vectors @ (v / max(np.linalg.norm(v), 1e-9))
        top = np.argsort(-near)[: q.NEIGHBOURS]
        w = np.maximum(near[top], 0) ** q.SHARPNESS
        assert abs(score - ((w * y[top]).sum() / w.sum() if w.sum() > 1e-9 else 0.7)) < 1e-4
