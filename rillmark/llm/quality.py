"""Quality scores by a vote of nearest labelled neighbours in a latent-semantic space.

Terms are hashed words and hashed trigrams of character classes (letters by case, digits,
blanks, line ends, each punctuation mark), plus the count of words said twice in a row.
Term counts are damped, weighted by rarity among the sampled documents, and projected on
the leading singular directions of the sample. The labelled vectors are small (their
number is a parameter) and go to every task; each document's cosines with all of them are
computed exactly, block by block, and the nearest vote with a power of their similarity.

Defined results: a null text counts as empty; a text without terms, or without a
neighbour of positive similarity, scores the share of label 1; repeated rows score alike;
labels that are null or not 0 or 1 are ignored; with labels of one kind or none, every
text scores the share of label 1 (0 without labels). Texts are read whole. Only doc_id
and text are read for a score.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillmark.llm.frames import row_chunks
from rillmark.llm.labelled import crc_of, labelled_sample
from rillmark.llm.words import ALPHANUMERIC, mixed, words_of

#: Bounds of the labelled sample and the size of the space.
PER_CLASS, TERMS, DIMENSIONS = 2000, 1024, 48
NEIGHBOURS, SHARPNESS = 15, 4.0
ACCEPTED = 0.3

#: Character classes: blank, line end, lower, upper, digit, above ASCII, and one for each mark.
CLASSES = np.zeros(256, np.int64)
CLASSES[:] = np.arange(256) % 50 + 14
CLASSES[97:123], CLASSES[65:91], CLASSES[48:58], CLASSES[128:] = 2, 3, 4, 5
CLASSES[[32, 9]], CLASSES[[10, 13]] = 0, 1


class Model(NamedTuple):
    rarity: np.ndarray
    directions: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    weights: np.ndarray
    share: float


def held_out() -> Column:
    return crc_of("doc_id") % 5 == 0


def term_counts(column: pa.Array) -> np.ndarray:
    """(texts, 2 * TERMS + 1) counts of hashed terms over whole texts."""
    words = words_of(column, ALPHANUMERIC)
    n, size = len(words.bounds) - 1, 2 * TERMS + 1
    out = np.zeros(n * size, np.float32)
    out += np.bincount(words.row * size + (words.hash % np.uint64(TERMS)).astype(np.int64), minlength=n * size)
    classes = CLASSES[words.data]
    if len(classes) > 2:
        code = (classes[:-2] << 12) | (classes[1:-1] << 6) | classes[2:]
        row = np.repeat(np.arange(n), np.diff(words.bounds))
        same = row[:-2] == row[2:]
        out += np.bincount(row[:-2][same] * size + TERMS + BUCKET[code[same]], minlength=n * size)
    if len(words.row) > 1:
        again = (words.hash[1:] == words.hash[:-1]) & (words.row[1:] == words.row[:-1])
        out += np.bincount(words.row[1:][again] * size + 2 * TERMS, minlength=n * size)
    return out.reshape(n, size)


BUCKET = (mixed(np.arange(1 << 18, dtype=np.uint64)) % np.uint64(TERMS)).astype(np.int64)


def _unit(x: np.ndarray) -> np.ndarray:
    length = np.linalg.norm(x, axis=1, keepdims=True)
    return np.divide(x, length, out=np.zeros_like(x), where=length > 0)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in row_chunks(batches, "text"):
        counts = term_counts(batch.column("text"))
        packed = pa.array([row.tobytes() for row in counts], pa.binary())
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("y"), packed], names=["doc_id", "y", "counts"])


def fit(docs: DataFrame, labels: DataFrame, usable: Column | None = None, label: str = "quality", per_class: int = PER_CLASS) -> Model | float:
    """The labelled vectors and their space, or the share of label 1 where there are not labels of both kinds."""
    sample, counts = labelled_sample(docs, labels, label, ~held_out() if usable is None else usable, per_class)
    rows = sample.select(F.col("doc_id").cast("bigint"), "y", "text").mapInArrow(_count, "doc_id bigint, y int, counts binary").toPandas()
    rows = rows.sort_values("doc_id", ignore_index=True)
    share = counts.get(1, 0) / max(1, sum(counts.values()))
    if rows["y"].nunique() < 2:
        return share
    terms = np.log1p(np.stack([np.frombuffer(x, np.float32) for x in rows["counts"]]))
    rarity = (np.log((1 + len(terms)) / (1 + (terms > 0).sum(axis=0))) + 1).astype(np.float32)
    terms = _unit(terms * rarity)
    basis = np.random.default_rng(5).standard_normal((terms.shape[1], DIMENSIONS + 16)).astype(np.float32)
    for _ in range(6):  # subspace iteration
        basis = np.linalg.qr(terms.T @ (terms @ basis))[0].astype(np.float32)
    values, turn = np.linalg.eigh(basis.T @ (terms.T @ (terms @ basis)))
    directions = basis @ turn[:, ::-1][:, :DIMENSIONS].astype(np.float32)
    y = rows["y"].to_numpy()
    weights = np.where(y == 1, counts[1] / (y == 1).sum(), counts[0] / (y == 0).sum())
    return Model(rarity, directions, _unit(terms @ directions), y.astype(np.float32), (weights / weights.mean()).astype(np.float32), share)


def votes(model: Model, counts: np.ndarray, block: int = 1024) -> np.ndarray:
    """Similarity-weighted share of label 1 among the nearest labelled vectors."""
    out = np.full(len(counts), model.share)
    k = min(NEIGHBOURS, len(model.vectors))
    for a in range(0, len(counts), block):
        near = _unit(_unit(np.log1p(counts[a : a + block]) * model.rarity) @ model.directions) @ model.vectors.T
        nearest = np.argpartition(near, len(model.vectors) - k, axis=1)[:, -k:]
        weight = np.maximum(np.take_along_axis(near, nearest, axis=1), 0) ** SHARPNESS * model.weights[nearest]
        total = weight.sum(axis=1)
        out[a : a + block] = np.where(total > 1e-9, (weight * model.labels[nearest]).sum(axis=1) / np.maximum(total, 1e-9), model.share)
    return out


def quality(docs: DataFrame, labels: DataFrame, accepted: float = ACCEPTED) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every document."""
    model = fit(docs, labels)
    rows = docs.select("doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in row_chunks(batches, "text"):
            if isinstance(model, Model):
                score = votes(model, term_counts(batch.column("text")))
            else:
                score = np.full(batch.num_rows, model)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(score, pa.float64())], names=["doc_id", "score"])

    found = rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, score double")
    score = F.least(F.greatest("score", F.lit(0.0)), F.lit(1.0))
    return found.select("doc_id", held_out().alias("held_out"), score.alias("score"), (score >= accepted).cast("int").alias("predicted"))
