"""Token ids of documents as Parquet lists, for selective reads of ids and metadata.

A folder holds ``data``, one file per task in ascending doc_id order, and ``index``, one row
per file. A row of ``data`` is a document: doc_id, part (its file), start_in_part (ids
before it in its file), n_tokens, tokens. Ids are dictionary encoded (the vocabulary fits a
page), doc_id, start_in_part and n_tokens are delta encoded, row groups and pages are kept
small and every column has a page index. So metadata reads skip the ids altogether, and a
range of documents or of ids (``read_documents``, ``read_span``) opens the files that the
index names, the row groups by their statistics, and the pages by the page index.

Texts are encoded by the tokenizer unit by unit, each distinct unit of a batch once, and
units are kept between batches. A cut between two units is exact for this kind of
tokenizer: it drops white space, so no id reaches over an ASCII space or line feed, and it
splits a run of letters from the punctuation behind it. ``units`` cuts nowhere else;
texts pass whole, and a long one is one row as before.

Writing is a range partition by (doc_id, hash of the text, row), a sort and a write through
Spark's committer, so a lost task leaves nothing behind. Rows without doc_id stand first,
repeated ids by the hash of their text. Defined results: a null or empty text has only the
end id. An empty table gives an empty folder. Extra columns are not read.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rillmark.llm.frames import row_chunks, text_column
from rillmark.session import scratch_path

ROW_GROUP_BYTES = 16 << 20
PAGE_BYTES = 256 << 10
PAGE_ROWS = 2_000
IDS = "tokens.list.element"
FORMAT = {
    "compression": "zstd", "parquet.writer.version": "PARQUET_2_0", "parquet.block.size": str(ROW_GROUP_BYTES), "parquet.page.size": str(PAGE_BYTES),
    "parquet.page.row.count.limit": str(PAGE_ROWS), "parquet.page.size.row.check.min": "10", "parquet.block.size.row.check.min": "10",
    # version 2 without a dictionary is delta encoding
    "parquet.enable.dictionary": "false", f"parquet.enable.dictionary#{IDS}": "true",
}
#: A worker that keeps more units or bytes of ids than these forgets them before the next batch.
KEPT_UNITS, KEPT_BYTES = 1_000_000, 32 << 20
#: Bytes of text that meet the tokenizer at once.
BATCH = 4 << 20
ROW = "doc_id bigint, part int, start_in_part bigint, n_tokens bigint, tokens array<int>"

_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True
_MARK = np.zeros(256, bool)
_MARK[[ord(c) for c in ",.;:!?"]] = True
_BLANK = np.zeros(256, bool)
_BLANK[[0x20, 0x0A]] = True


def units(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The texts cut into units, and for each text the number of units before it.

    A unit begins with a text, at a blank or line feed, or at one of ``,.;:!?`` behind an ASCII letter.
    """
    ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[ends[0] : ends[-1]]
    ends = ends - ends[0]
    cut = _BLANK[data]
    cut[1:] |= _MARK[data[1:]] & _LETTER[data[:-1]]
    cut[ends[:-1][ends[:-1] < len(data)]] = True
    starts = np.flatnonzero(cut).astype(np.int64)
    offsets = np.append(starts, len(data))
    array = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(offsets.tobytes()), pa.py_buffer(np.ascontiguousarray(data)))
    return array, np.searchsorted(starts, ends)


class Encoder:
    """Ids of units: those met before are looked up, the others encoded at once and kept.

    Units of Latin letters alone skip the tokenizer's normaliser and splitter: they are
    composed already, one pre-token each, and lower-cased here. Its model still makes the ids.
    """

    LETTERS = "^[A-Za-zÀ-ÖØ-öø-ÿ]+$"

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        parts = json.loads(self.whole.to_str())
        bytes_only = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}
        self.letters = Tokenizer.from_str(json.dumps(parts | {"normalizer": None, "pre_tokenizer": bytes_only, "added_tokens": []}))
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.first, self.size, self.table = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int32)

    def of(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(first, size, table): the ids of word k are ``table[first[k] : first[k] + size[k]]``."""
        if len(self.known) > KEPT_UNITS or self.table.nbytes > KEPT_BYTES:
            self.forget()
        plain = pc.match_substring_regex(words, self.LETTERS)
        same = pc.if_else(plain, pc.utf8_lower(words), words).dictionary_encode()
        keys = same.dictionary
        texts = keys.to_numpy(zero_copy_only=False).tolist()
        at = np.fromiter((self.known.get(w, -1) for w in texts), np.int64, len(texts))
        new = at < 0
        if new.any():
            plain = pc.match_substring_regex(keys, self.LETTERS).to_numpy(zero_copy_only=False)
            for tokenizer, where in ((self.letters, np.flatnonzero(new & plain)), (self.whole, np.flatnonzero(new & ~plain))):
                at[where] = np.arange(len(self.size), len(self.size) + len(where))
                self._learn(tokenizer, [texts[k] for k in where])
        at = at[same.indices.to_numpy()]
        return self.first[at], self.size[at], self.table

    def _learn(self, tokenizer, words: list[str], at_once: int = 20_000) -> None:
        for k in range(0, len(words), at_once):
            some = words[k : k + at_once]
            found = tokenizer.encode(some, is_pretokenized=True, add_special_tokens=False)
            size = np.bincount(np.array(found.word_ids, np.int64), minlength=len(some))
            self.known.update(zip(some, range(len(self.size), len(self.size) + len(some))))
            self.first = np.concatenate([self.first, len(self.table) + np.cumsum(size) - size])
            self.size, self.table = np.concatenate([self.size, size]), np.concatenate([self.table, np.array(found.ids, np.int32)])


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The encoder of this worker process."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def encoded(texts: pa.Array, path: str, end_id: int | None) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts one after the other, and for each text the number of ids before it."""
    array, first = units(texts)
    coded = array.dictionary_encode()
    at, sizes, table = encoder(path).of(pc.utf8_trim(coded.dictionary, " \n"))
    codes = coded.indices.to_numpy()
    long = sizes[codes]
    behind = np.concatenate([[0], np.cumsum(long)])
    ids = table[np.repeat(at[codes] - behind[:-1], long) + np.arange(behind[-1])]
    ends = behind[first]
    if end_id is None:
        return ids, ends
    return np.insert(ids, ends[1:], end_id), ends + np.arange(len(ends))


def write_tokens(docs: DataFrame, folder: str, path: str, end_id: int | None = 1) -> None:
    """Encode ``docs`` (doc_id, text) by the tokenizer file ``path`` into ``folder``."""
    spark = docs.sparkSession

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, before = TaskContext.get().partitionId(), 0
        for batch in row_chunks(batches, "text", BATCH):
            ids, ends = encoded(text_column(batch.column("text")), path, end_id)
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids, pa.int32()))
            starts = pa.array(before + ends[:-1], pa.int64())
            columns = [batch.column("doc_id"), pa.array(np.full(len(lists), part, np.int32)), starts, pa.array(np.diff(ends), pa.int64()), lists]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "part", "start_in_part", "n_tokens", "tokens"])
            before += int(ends[-1])

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = rows.withColumns({"_same": F.xxhash64("text"), "_row": F.monotonically_increasing_id()})  # the row splits repeated rows
    by = [F.asc_nulls_first(c) for c in ("doc_id", "_same", "_row")]
    ordered = rows.repartitionByRange(*by).sortWithinPartitions(*by).select("doc_id", "text")
    ordered.mapInArrow(run, ROW).write.options(**FORMAT).parquet(f"{folder}/data")
    metadata = spark.read.schema(ROW).parquet(f"{folder}/data").select("doc_id", "part", "n_tokens")
    parts = metadata.groupBy("part").agg(F.min("doc_id").alias("first_doc"), F.max("doc_id").alias("last_doc"), F.count("*").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))
    # one row per file, so the window is as small as the list of files
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts.withColumn("first_id", F.coalesce(F.sum("n_tokens").over(before), F.lit(0))).write.parquet(f"{folder}/index")


def read_index(spark: SparkSession, folder: str) -> DataFrame:
    """(part, first_doc, last_doc, n_docs, n_tokens, first_id), a row per file."""
    return spark.read.parquet(f"{folder}/index")


def read_documents(spark: SparkSession, folder: str, first_doc: int | None = None, last_doc: int | None = None, tokens: bool = True) -> DataFrame:
    """(doc_id, start, n_tokens[, tokens]) of all documents or of those with ``first_doc <= doc_id <= last_doc``.

    Without ``tokens`` the ids are not read. ``start`` is the number of ids of all documents before.
    """
    rows = spark.read.schema(ROW).parquet(f"{folder}/data")
    if first_doc is not None:
        rows = rows.where(F.col("doc_id") >= first_doc)
    if last_doc is not None:
        rows = rows.where(F.col("doc_id") <= last_doc)
    place = read_index(spark, folder).select("part", "first_id")
    met = rows.drop(*([] if tokens else ["tokens"])).join(place, "part")
    return met.select("doc_id", (F.col("first_id") + F.col("start_in_part")).alias("start"), "n_tokens", *(["tokens"] if tokens else []))


def read_span(spark: SparkSession, folder: str, first: int, last: int) -> DataFrame:
    """(doc_id, start, tokens): the pieces of documents that make up the ids ``first`` to ``last`` (exclusive) of the whole corpus."""
    hit = read_index(spark, folder).where((F.col("first_id") < last) & (F.col("first_id") + F.col("n_tokens") > first)).collect()  # files of the span
    rows = spark.read.schema(ROW).parquet(f"{folder}/data")
    found = None
    for part in hit:
        a, b = first - part["first_id"], last - part["first_id"]
        inside = rows.where((F.col("part") == part["part"]) & (F.col("start_in_part") < b) & (F.col("start_in_part") + F.col("n_tokens") > a))
        begin = F.greatest(F.lit(a) - F.col("start_in_part"), F.lit(0))
        end = F.least(F.lit(b) - F.col("start_in_part"), F.col("n_tokens"))
        cut = F.slice("tokens", (begin + 1).cast("int"), (end - begin).cast("int"))
        piece = inside.select("doc_id", (F.lit(part["first_id"]) + F.col("start_in_part") + begin).alias("start"), cut.alias("tokens"))
        found = piece if found is None else found.unionByName(piece)
    return rows.selectExpr("doc_id", "start_in_part as start", "tokens").limit(0) if found is None else found


def with_checksums(documents: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32): crc32 of the ids as little-endian 32-bit integers."""
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("tokens")
            ids = np.asarray(lists.values).astype("<u4")
            ends = np.asarray(lists.offsets)
            sums = [zlib.crc32(ids[a:b].data) for a, b in zip(ends, ends[1:])]
            columns = [batch.column("doc_id"), batch.column("start"), pa.array(np.diff(ends), pa.int64()), pa.array(sums, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return documents.mapInArrow(run, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def written_and_read(docs: DataFrame, path: str, end_id: int = 1) -> DataFrame:
    """Writes all documents, reads the files back: a row per document, from the files alone."""
    folder = scratch_path(docs.sparkSession, "tokens")
    write_tokens(docs, folder, path, end_id)
    return with_checksums(read_documents(docs.sparkSession, folder))
