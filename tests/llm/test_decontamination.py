import numpy as np
import pyarrow as pa
import pytest

from rillmark.llm import decontamination
from rillmark.llm.decontamination import best_distances, build, contaminated, edits, without_contaminated
from rillmark.llm.words import ALPHANUMERIC, words_of

WORDS = [f"{a}{b}" for a in "bcdfghjklm" for b in ("an", "er", "ing", "o", "us", "et")]


def text_of(draw, n):
    return " ".join(draw.choice(WORDS, n))


def fewest_edits(item, text):
    row = [0] * (len(text) + 1)
    for i, w in enumerate(item, 1):
        new = [i]
        for j, x in enumerate(text, 1):
            new.append(min(row[j - 1] + (w != x), row[j] + 1, new[-1] + 1))
        row = new
    return min(row)


@pytest.fixture
def benchmark(spark):
    def make(rows):
        return spark.createDataFrame([(k, t, "x") for k, t in rows], "item_id bigint, text string, doc_id string")

    return make


def corpus(seed, per_item=6):
    draw = np.random.default_rng(seed)
    items = [(k, text_of(draw, int(draw.integers(5, 60)))) for k in range(20)]
    rows = [(k, text_of(draw, int(draw.integers(0, 300)))) for k in range(60)]
    for k, item in items:
        for _ in range(per_item):
            words = item.split()
            for _ in range(int(draw.integers(0, edits(len(words), 0.1) + 1))):
                at = int(draw.integers(len(words)))
                words[at : at + int(draw.integers(0, 2))] = list(draw.choice(WORDS, int(draw.integers(0, 2))))
            rows.append((len(rows), f"{text_of(draw, int(draw.integers(0, 80)))}. {', '.join(words).title()}! {text_of(draw, int(draw.integers(0, 80)))}"))
    return rows, items


def test_edited_passages_are_found_and_no_others(documents, benchmark):
    rows, items = corpus(1)
    found = {(r["doc_id"], r["item_id"]): r["distance"] for r in contaminated(documents(rows), benchmark(items)).collect()}
    true = {}
    for k, text in rows:
        words = text.lower().replace(",", "").replace(".", "").replace("!", "").split()
        for i, item in items:
            fewest = fewest_edits(item.split(), words)
            if fewest <= edits(len(item.split()), 0.1):
                true[k, i] = fewest
    assert {k: true[k] for k in found} == found  # each is right
    assert len(found) >= 0.97 * len(true) and all(k in found for k, d in true.items() if d == 0)


def test_distance_equals_brute_force():
    draw = np.random.default_rng(4)
    for _ in range(40):
        item, windows = draw.integers(1, 6, int(draw.integers(1, 9))).astype(np.uint64), draw.integers(1, 6, (5, int(draw.integers(1, 14)))).astype(np.uint64)
        assert best_distances(item, windows).tolist() == [fewest_edits(item.tolist(), w.tolist()) for w in windows]


def test_item_groups_and_filter(documents, benchmark, monkeypatch):
    rows, items = corpus(2, per_item=1)
    whole = sorted(map(tuple, contaminated(documents(rows), benchmark(items)).select("doc_id", "item_id", "distance").collect()))
    docs = documents(rows)
    kept = without_contaminated(docs, benchmark(items))
    assert kept.schema == docs.schema
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted({r[0] for r in rows} - {w[0] for w in whole})
    monkeypatch.setattr(decontamination, "GROUP_WORDS", 100)
    grouped = {(r["doc_id"], r["item_id"]) for r in contaminated(documents(rows), benchmark(items)).collect()}
    assert grouped >= {w[:2] for w in whole if w[2] == 0}


def test_edges(documents, benchmark):
    item = "one two three four five six seven"
    rows = [(1, None), (2, ""), (3, item), (3, item), (None, item.upper()), (4, "w " * 200_000 + item), (5, "one two three")]
    items = [(1, item), (2, item), (3, None), (4, "one two"), (5, ""), (None, item)]
    found = [(r["doc_id"], r["item_id"]) for r in contaminated(documents(rows), benchmark(items)).collect()]
    assert sorted(found, key=str) == sorted([(d, i) for d in (3, 3, None, 4) for i in (1, 2, None)], key=str)
    assert contaminated(documents([]), benchmark(items)).count() == contaminated(documents(rows), benchmark([])).count() == 0
    assert without_contaminated(documents(rows), benchmark([])).count() == len(rows)


def test_repetitions_follow_the_recall():
    words = words_of(pa.array([" ".join(WORDS)]), ALPHANUMERIC).hash
    items = [words[k : k + 40] for k in range(12)]
    few, many = (len(build(list(range(12)), items, recall=r).repetitions) for r in (0.5, 0.99))
    assert 1 <= few < many <= decontamination.MOST_REPETITIONS


@pytest.mark.parametrize("place", ["front", "middle", "end", "anywhere"])
def test_recall_wherever_the_edits_are(place):
    draw = np.random.default_rng(7)
    names = [f"{w}{k}" for w in WORDS for k in range(40)]
    lengths = (5, 9, 10, 14, 19, 20, 25, 30, 39, 40, 60, 100, 150, 200)
    items = [list(draw.choice(names, n)) for n in lengths for _ in range(15)]
    index = build(list(range(len(items))), [words_of(pa.array([" ".join(x)]), ALPHANUMERIC).hash for x in items])
    texts = []
    for item in items:
        words, n = list(item), edits(len(item), 0.1)
        wide = max(n, len(item) // 5)
        low = {"front": 0, "middle": (len(item) - wide) // 2, "end": len(item) - wide, "anywhere": 0}[place]
        for _ in range(n):
            at = min(low + int(draw.integers(len(item) if place == "anywhere" else wide)), len(words) - 1)
            words[at : at + int(draw.integers(0, 2))] = list(draw.choice(names, int(draw.integers(0, 2))))
        texts.append(" ".join([*draw.choice(names, int(draw.integers(0, 30))), *words, *draw.choice(names, int(draw.integers(0, 30)))]))
    found = {(row, item) for row, item, *_ in decontamination.matches(index, words_of(pa.array(texts), ALPHANUMERIC), 0.1)}
    caught = [(k, k) in found for k in range(len(items))]
    for a in range(0, len(items), 15 * len(lengths) // 2):
        part = caught[a : a + 15 * len(lengths) // 2]
        assert sum(part) >= 0.95 * len(part)


def test_a_recall_out_of_reach_is_an_error(monkeypatch):
    words = words_of(pa.array([" ".join(WORDS)]), ALPHANUMERIC).hash
    monkeypatch.setattr(decontamination, "MOST_REPETITIONS", 1)
    with pytest.raises(ValueError, match="recall"):
        build([1], [words[:20]], recall=1.0)
