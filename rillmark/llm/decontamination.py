"""Benchmark decontamination: random-walk embeddings of word windows, bit sampling, exact edit verification.

A document is contaminated by an item when some stretch of it is within ``rate`` word
edits per word of the item. The CGK embedding walks along a sequence: step j puts out the
word under the walk and moves on if a random bit of that word and j says so. Two
sequences a few edits apart fall back in step, so their outputs differ in few places.
Sampling a few output places gives a hash that near sequences share with fair
probability, and repetitions with other bits and places raise the recall. An item is
walked from several anchors spread over its whole length, so edits that crowd one end leave
the others alone. For every item length class the number of repetitions is set on the
driver, by the recall of items edited anywhere, in front, in the middle or at the end,
each of which has to reach ``recall``; where ``MOST_REPETITIONS`` do not, it is an error.

Every word of every text starts a window. A walk only reads what its places need: a
window whose first sampled word is no item's is given up there. Windows that share a
hash with an item are verified by the edit distance of the item to its best stretch of
the window and its margins.

Words are runs of letters and digits, A-Z lower-cased. Defined results: null texts count
as empty; items that are null or shorter than ``SHORTEST`` words identify no passage and
match nothing; repeated documents, and items with one text, are reported each; texts are
scanned whole. Items are looked up by every task in groups of at most ``GROUP_WORDS``
words, one pass over the documents for each group. Other columns are not read, whatever
their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rillmark.llm.frames import free_name, row_chunks
from rillmark.llm.words import ALPHANUMERIC, Words, mixed, words_of

RATE, RECALL = 0.1, 0.995
SHORTEST = 5
#: Length classes, each walked from its anchors for as many steps as its shortest item has words.
CLASSES = (5, 10, 20)
PLACES, MOST_REPETITIONS = 3, 64
#: Parts of an item that its trial edits fall on, edited copies for each, and the most words of all of them.
PARTS = ((0.0, 1.0), (0.0, 0.2), (0.4, 0.6), (0.8, 1.0))
TRIALS, TRIAL_WORDS = 400, 1_000_000
GROUP_WORDS = 2_000_000
STARTS = 1 << 19
MARGIN = 32


class Repetition(NamedTuple):
    seed: int
    places: tuple[int, ...]
    passes: list[np.ndarray]  # for each place, which low 16 bits an item's word (then its hash so far) may have
    keys: np.ndarray  # sorted hashes of the items' words at all places, from every anchor
    items: np.ndarray  # the item of each key
    anchors: np.ndarray  # and where in the item its walk began


class Index(NamedTuple):
    ids: list[int]
    items: list[np.ndarray]
    repetitions: list[Repetition]


def edits(n: int, rate: float) -> int:
    return int(rate * n + 1e-9)


def _bits(hashes: np.ndarray, seed: int) -> np.ndarray:
    """32 random bits of each word, and of the words of the margin."""
    with np.errstate(over="ignore"):
        return (mixed(hashes + np.uint64(seed) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)).astype(np.uint32)


def _padded(hashes: np.ndarray) -> np.ndarray:
    return np.concatenate([hashes, np.zeros(MARGIN, np.uint64)])


def _walk(bits: np.ndarray, at: np.ndarray, first: int, last: int) -> np.ndarray:
    """Positions of walks before step ``last`` that stood at ``at`` before step ``first``.

    ``bits`` has MARGIN more places than there are words. A walk that leaves its text reads
    words of the next one; what it hashes to there is refuted by the verification.
    """
    for j in range(first, last):
        moves = ((bits >> np.uint32(j)) & np.uint32(1)).astype(np.uint8) if len(at) > len(bits) // 4 else None
        at = at + (moves[at] if moves is not None else ((bits[at] >> np.uint32(j)) & np.uint32(1)).astype(np.int32))
    return at


def _folded(key: np.ndarray, word: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mixed(key * np.uint64(0x9E3779B97F4A7C15) + word)


def anchors_of(n: int, steps: int, rate: float) -> np.ndarray:
    """Where walks of an item of ``n`` words begin. A walk moves on at every other step or so, hence the last one."""
    if edits(n, rate) == 0:
        return np.zeros(1, np.int64)
    return np.unique(np.linspace(0, n - steps // 2, max(2, n // steps)).astype(np.int64))


def _hashes(words: np.ndarray, at: np.ndarray, seed: int, places: tuple[int, ...]) -> list[np.ndarray]:
    """For walks from ``at``: the word at the first place, and the hash of the words at the places so far for each further one."""
    words, at = _padded(words), at.astype(np.int32)
    bits = _bits(words, seed)
    key, out, step = np.zeros(len(at), np.uint64), [], 0
    for place in places:
        at, step = _walk(bits, at, step, place), place
        key = _folded(key, words[at])
        out.append(key if out else words[at])
    return out


def _low(hashes: np.ndarray) -> np.ndarray:
    return (hashes & np.uint64(0xFFFF)).astype(np.uint16)


def _edited(item: np.ndarray, n: int, draw: np.random.Generator, part: tuple[float, float] = (0.0, 1.0)) -> np.ndarray:
    """The item after n random substitutions, deletions and insertions of words within a part of it."""
    out = item.tolist()
    low = int(part[0] * len(out))
    wide = max(1, n, int(part[1] * len(out)) - low)
    for _ in range(n):
        kind, at = draw.integers(3), min(low + int(draw.integers(wide)), len(out) - 1)
        new = int(draw.integers(1 << 62))
        if kind == 0:
            out[at] = new
        elif kind == 1 and len(out) > 1:
            del out[at]
        else:
            out.insert(at, new)
    return np.array(out, np.uint64)


def _of_item(keys: np.ndarray, items: np.ndarray) -> np.ndarray:
    return _folded(keys, items.astype(np.uint64))


def build(ids: list[int], items: list[np.ndarray], rate: float = RATE, recall: float = RECALL, seed: int = 3) -> Index:
    """Hashes of all items from all anchors, with as many repetitions per length class as the recall of edited items needs."""
    draw = np.random.default_rng(seed)
    repetitions = []
    for k, steps in enumerate(CLASSES):
        longest = CLASSES[k + 1] if k + 1 < len(CLASSES) else None
        own = [i for i, x in enumerate(items) if len(x) >= steps and (longest is None or len(x) < longest)]
        if not own:
            continue
        first = np.cumsum([0, *[len(items[i]) for i in own]])
        words = np.concatenate([items[i] for i in own])
        anchors = [anchors_of(len(items[i]), steps, rate) for i in own]
        of, anchor = np.repeat(np.array(own), [len(x) for x in anchors]), np.concatenate(anchors)
        begin = np.repeat(first[:-1], [len(x) for x in anchors]) + anchor

        tried = [own[i] for i in draw.integers(len(own), size=TRIALS)]
        within = np.cumsum([len(items[i]) for i in tried]) <= TRIAL_WORDS // len(PARTS)
        tried = [i for i, fits in zip(tried, within) if fits] or [min(own, key=lambda i: len(items[i]))]
        near = [_edited(items[i], edits(len(items[i]), rate), draw, part) for part in PARTS for i in tried]
        copy = np.repeat(np.arange(len(near)), [len(x) for x in near])
        item, near = np.array(tried * len(PARTS)), np.concatenate(near)
        missed = np.ones((len(PARTS), len(tried)), bool)
        for r in range(MOST_REPETITIONS):
            places = tuple(sorted(draw.choice(steps, PLACES, replace=False).tolist()))
            salt = 1 + k * 1000 + r
            so_far = _hashes(words, begin, salt, places)
            keys, passes = so_far[-1], [np.zeros(1 << 16, bool) for _ in places]
            for table, hashes in zip(passes, so_far):
                table[_low(hashes)] = True
            order = np.argsort(keys, kind="stable")
            repetitions.append(Repetition(salt, places, passes, keys[order], of[order], anchor[order]))
            # texts are walked from every word, and so are the edited copies
            hit = np.isin(_of_item(_hashes(near, np.arange(len(near)), salt, places)[-1], item[copy]), _of_item(keys, of))
            missed.ravel()[copy[hit]] = False
            if missed.mean(axis=1).max() <= 1 - recall:
                break
        else:
            raise ValueError(f"a recall of {recall} at {rate} edits a word is not reached for items of {steps} words and more: {1 - missed.mean(axis=1).max():.3f}")
    return Index(ids, items, repetitions)


def _candidates(index: Index, words: Words) -> np.ndarray:
    """Distinct (word where the item would start, item, text), sorted, of walks that share a hash with one of the item's.

    That word may lie before the text's first one, or be off by the edits in front of the anchor.
    """
    found = []
    hashes = _padded(words.hash)
    low = _low(hashes)
    for r in index.repetitions:
        bits = _bits(hashes, r.seed)
        for a in range(0, len(words.row), STARTS):
            start = np.arange(a, min(a + STARTS, len(words.row)), dtype=np.int32)
            at = _walk(bits[a : a + STARTS + MARGIN], start - a, 0, r.places[0]) + np.int32(a)
            alive = np.flatnonzero(r.passes[0][low[at]])
            start, at = start[alive], at[alive]
            key, step = _folded(np.zeros(len(at), np.uint64), hashes[at]), r.places[0]
            for place, table in zip(r.places[1:], r.passes[1:]):
                at, step = _walk(bits, at, step, place), place
                key = _folded(key, hashes[at])
                alive = np.flatnonzero(table[_low(key)])
                start, at, key = start[alive], at[alive], key[alive]
            lowest = np.searchsorted(r.keys, key)
            count = np.searchsorted(r.keys, key, "right") - lowest
            hit = np.flatnonzero(count)
            if len(hit):
                n = count[hit]
                nth = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                key, begin = np.repeat(lowest[hit], n) + nth, np.repeat(start[hit], n)
                found.append(np.stack([begin - r.anchors[key], r.items[key], words.row[begin]], axis=1))
    return np.unique(np.concatenate(found), axis=0) if found else np.zeros((0, 3), np.int64)


def best_distances(item: np.ndarray, windows: np.ndarray) -> np.ndarray:
    """Edit distance of the item to the best stretch of each window (rows of equal length, 0 for no word)."""
    steps = np.arange(windows.shape[1] + 1)
    row = np.zeros((len(windows), len(steps)), np.int64)
    for word in item:
        down = row + 1
        down[:, 1:] = np.minimum(down[:, 1:], row[:, :-1] + (windows != word))
        row = np.minimum.accumulate(down - steps, axis=1) + steps  # words of the window that the item lacks
    return row.min(axis=1)


def matches(index: Index, words: Words, rate: float) -> list[tuple[int, int, int, int, int]]:
    """(text, item, fewest edits, first window, number of windows) of verified candidates."""
    pairs = _candidates(index, words)
    first = words.first()
    out: dict[tuple[int, int], tuple[int, int, int]] = {}
    pairs = pairs[np.argsort(pairs[:, 1], kind="stable")]
    items, at = np.unique(pairs[:, 1], return_index=True)
    for item, begin, end in zip(items.tolist(), at.tolist(), [*at[1:].tolist(), len(pairs)]):
        sequence = index.items[item]
        most = edits(len(sequence), rate)
        starts, texts = pairs[begin:end, 0], pairs[begin:end, 2]
        width, known_words = len(sequence) + 2 * most, np.unique(sequence)
        for a in range(0, len(starts), 4096):
            own, rows = starts[a : a + 4096], texts[a : a + 4096]
            low, high = first[rows], first[rows + 1]
            at = own[:, None] - most + np.arange(width)
            inside = (at >= low[:, None]) & (at < high[:, None])
            windows = np.where(inside, words.hash[np.clip(at, 0, len(words.hash) - 1)], np.uint64(0))
            # all but ``most`` words of the item must stand in the window
            place = np.minimum(np.searchsorted(known_words, windows), len(known_words) - 1)
            enough = (known_words[place] == windows).sum(axis=1) >= len(sequence) - most
            own, rows, windows = own[enough], rows[enough], windows[enough]
            for start, row, distance in zip(own.tolist(), rows.tolist(), best_distances(sequence, windows).tolist()):
                if distance <= most:
                    key = (row, item)
                    where = max(0, start - int(first[row]))
                    known = out.get(key, (distance, where, 0))
                    out[key] = (min(known[0], distance), min(known[1], where), known[2] + 1)
    return [(row, item, *rest) for (row, item), rest in sorted(out.items())]


def indexes(benchmark: DataFrame, rate: float = RATE, recall: float = RECALL) -> Iterator[Index]:
    """One index for each group of items; a group is bounded in words."""
    items = benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), "text").where("text is not null")
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    groups = max(1, -(-total // (4 * GROUP_WORDS)))
    for g in range(groups):
        own = items if groups == 1 else items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(groups)) == g)
        rows = sorted(own.collect(), key=lambda r: (r["item_id"] is None, r["item_id"], r["text"]))
        if rows:
            words = words_of(pa.array([r["text"] for r in rows], pa.large_string()), ALPHANUMERIC)
            first = words.first()
            long = [i for i in range(len(rows)) if first[i + 1] - first[i] >= SHORTEST]
            yield build([rows[i]["item_id"] for i in long], [words.hash[first[i] : first[i + 1]] for i in long], rate, recall)


def contaminated(docs: DataFrame, benchmark: DataFrame, rate: float = RATE, recall: float = RECALL) -> DataFrame:
    """(doc_id, item_id, distance, first_word, n_windows) for every document and item that it contains within ``rate``."""
    rows = docs.select("doc_id", "text")
    kind = rows.schema["doc_id"].dataType.simpleString()
    fields = f"doc_id {kind}, item_id bigint, distance int, first_word bigint, n_windows bigint"

    def scan(index: Index):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in row_chunks(batches, "text"):
                found = matches(index, words_of(batch.column("text"), ALPHANUMERIC), rate)
                source = pa.array([f[0] for f in found], pa.int64())
                columns = [batch.column("doc_id").take(source), pa.array([index.ids[f[1]] for f in found], pa.int64())]
                columns += [pa.array([f[k] for f in found], t) for k, t in ((2, pa.int32()), (3, pa.int64()), (4, pa.int64()))]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "item_id", "distance", "first_word", "n_windows"])

        return run

    out = None
    for index in indexes(benchmark, rate, recall):
        part = rows.mapInArrow(scan(index), fields)
        out = part if out is None else out.unionByName(part)
    return docs.sparkSession.createDataFrame([], fields) if out is None else out


def without_contaminated(docs: DataFrame, benchmark: DataFrame, rate: float = RATE, recall: float = RECALL) -> DataFrame:
    """``docs`` without the documents that contain an item; each is judged where it is, without a join."""
    name = free_name(docs, "item")

    def mark(index: Index):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in row_chunks(batches, "text"):
                hit = np.zeros(batch.num_rows, bool)
                hit[[f[0] for f in matches(index, words_of(batch.column("text"), ALPHANUMERIC), rate)]] = True
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(hit)], names=[*batch.schema.names, name])

        return run

    for index in indexes(benchmark, rate, recall):
        docs = docs.mapInArrow(mark(index), T.StructType([*docs.schema.fields, T.StructField(name, T.BooleanType())])).where(~F.col(name)).drop(name)
    return docs
