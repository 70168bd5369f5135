"""Toxicity scores by a bidirectional gated recurrent network over all overlapping windows.

The network (``recurrent``) is fitted on the driver on windows of a bounded sample of
labelled documents and then scores windows of every document where the document is; a
document's score is that of its worst window. Windows that overlap by half are scored first; wherever
one of them scores ``NEAR`` or more, the windows beside it are scored from every word on
(three quarters of any window's words stand together in one of the first kind).
``near=0`` scores all overlapping windows everywhere, at five times the time.

Defined results: a null text counts as empty, and a text without words scores 0; repeated
rows are scored each and alike; texts of any length are scored whole; labels that are
null or not 0 or 1 are ignored; without labelled rows of both kinds every text with words
scores the share of label 1 (0 without any). Only doc_id and text are read for a score.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rillmark.llm.frames import free_name, row_chunks
from rillmark.llm.labelled import crc_of, labelled_sample
from rillmark.llm.recurrent import WINDOW, Network, distinct_words, train, window_starts, windows_beside
from rillmark.llm.words import ALPHANUMERIC, Words, words_of

#: Bounds of the training sample: documents of each label, windows of each document, bytes of each window.
PER_CLASS, WINDOWS_PER_DOC, WINDOW_BYTES = 2000, 48, 2048
#: A word has a vector of its own if it stands in one of so many sampled texts, and in so many at least.
FREQUENT, LEAST_TEXTS = 150, 5
FLAGGED = 0.3
#: Around windows of this score and above, every overlapping window is scored.
NEAR = 0.005
#: Words of more bytes are read as several.
LONGEST = 512


def held_out() -> Column:
    return crc_of("doc_id") % 4 == 2


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Windows of sampled documents as texts, at most WINDOWS_PER_DOC each, spread evenly."""
    for batch in row_chunks(batches, "text"):
        words = words_of(batch.column("text"), ALPHANUMERIC, hashed=False, longest=LONGEST)
        row, start, length = window_starts(words.first())
        out = []
        for k, (doc, y) in enumerate(zip(batch.column("doc_id").to_pylist(), batch.column("y").to_pylist())):
            own = np.flatnonzero(row == k)
            if len(own) > WINDOWS_PER_DOC:
                own = own[np.linspace(0, len(own) - 1, WINDOWS_PER_DOC).astype(int)]
            for i in own.tolist():
                a, b = words.begin[start[i]], words.end[start[i] + length[i] - 1]
                if b - a <= WINDOW_BYTES:
                    out.append((doc, y, i, words.data[a:b].tobytes().decode()))
        columns = zip(*out) if out else [[]] * 4
        kinds = (pa.int64(), pa.int32(), pa.int64(), pa.string())
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["doc_id", "y", "nth", "text"])


def fit(docs: DataFrame, labels: DataFrame, usable: Column | None = None, label: str = "toxic", per_class: int = PER_CLASS) -> Network | float:
    """The fitted network, or the share of label 1 where there are not labels of both kinds."""
    sample, counts = labelled_sample(docs, labels, label, ~held_out() if usable is None else usable, per_class)
    rows = sample.select(F.col("doc_id").cast("bigint"), "y", "text").mapInArrow(_windows, "doc_id bigint, y int, nth bigint, text string").toArrow()
    rows = rows.sort_by([("doc_id", "ascending"), ("nth", "ascending")])
    label_of = rows.column("y").to_numpy()
    if len(np.unique(label_of)) < 2:
        return counts.get(1, 0) / max(1, sum(counts.values()))
    text, at, row = np.unique(rows.column("doc_id").to_numpy(), return_index=True, return_inverse=True)
    words = words_of(rows.column("text").combine_chunks(), ALPHANUMERIC, longest=LONGEST)
    del rows
    distinct, number = distinct_words(words)
    first = words.first()
    starts, sizes = first[:-1], np.minimum(np.diff(first), WINDOW)
    target = label_of[at].astype(np.float64)
    of_text = row[words.row]
    del words
    weight = np.where(target == 1, counts[1] / (target == 1).sum(), counts[0] / (target == 0).sum())
    spread = np.bincount(np.unique(of_text * len(distinct.hash) + number) % len(distinct.hash), minlength=len(distinct.hash))
    del of_text
    return train(distinct, number, (row, starts, sizes), target, weight / weight.mean(), distinct.hash[spread >= max(LEAST_TEXTS, len(text) // FREQUENT)])


def worst_windows(net: Network, words: Words, near: float = NEAR) -> np.ndarray:
    """Score of the worst window of each text, 0 for texts without words."""
    first = words.first()
    worst = np.zeros(len(first) - 1)
    if not len(words.row):
        return worst
    distinct, number = distinct_words(words)
    row, start, length = window_starts(first)
    score = net.score(distinct, number, start, length)
    np.maximum.at(worst, row, score)
    row, start, length = windows_beside(first, start[score >= near])
    np.maximum.at(worst, row, net.score(distinct, number, start, length))
    return worst


def scored(docs: DataFrame, model: Network | float, near: float = NEAR) -> DataFrame:
    """All columns of ``docs`` and ``toxicity``, the score of the worst window of the whole text.

    Where ``docs`` has a column of that name, the new one gets underscores behind.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in row_chunks(batches, "text"):
            words = words_of(batch.column("text"), ALPHANUMERIC, longest=LONGEST)
            worst = np.where(np.diff(words.first()) > 0, model, 0.0) if isinstance(model, float) else worst_windows(model, words, near)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(worst)], names=[*batch.schema.names, name])

    name = free_name(docs, "toxicity")
    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(name, T.DoubleType())]))


def toxicity(docs: DataFrame, labels: DataFrame, flagged: float = FLAGGED) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every document."""
    found = scored(docs.select("doc_id", "text"), fit(docs, labels))
    return found.select("doc_id", held_out().alias("held_out"), F.col("toxicity").alias("score"), (F.col("toxicity") >= flagged).cast("int").alias("predicted"))


def without_toxic(docs: DataFrame, labels: DataFrame, flagged: float = FLAGGED) -> DataFrame:
    """``docs`` without the documents that score ``flagged`` or more."""
    model = fit(docs, labels)
    name = free_name(docs, "toxicity")
    return scored(docs, model).where(F.col(name) < flagged).drop(name)
