import random
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from public_tokenizers import path
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from rillmark.llm import tokens
from rillmark.llm.tokens import encoded, read_documents, read_index, read_span, with_checksums, write_tokens, written_and_read
from rillmark.session import scratch_path

WORDS = path("word_bpe_49k.json")
KIND = "doc_id bigint, text string, part int, tokens string, n_tokens int"
PARTS = [
    "word", "Word's", "don't,", "we'LL.", "J̌", "éx", "Kelvin", "a b", " ", "x̸", "≠", ";", "...", "a.b,c;d!e?f:g", "<|endoftext|>", "<|STARTOFTEXT|>",
    "<|endoftext|>.x", "12,5", "3.14", "\t", "\n", "\n\n", "  ", "\r\n", "\x0b", "\x00", "\x01", "x\x01,y", "日本語,テキスト", "İstanbul", "ΣΑΣ.", "ﬁn", "ﷺ", "🙂!", "🙂", "'s", "'", "́y", "é,", "q" * 90, "don’t", "​", "!'s",
]


def plain(texts, end_id=1):
    whole = Tokenizer.from_file(WORDS)
    return [whole.encode(t or "", add_special_tokens=False).ids + ([] if end_id is None else [end_id]) for t in texts]


@pytest.mark.parametrize("seed", range(4))
def test_units_give_the_ids_of_whole_texts(seed):
    rng = random.Random(seed)
    texts = ["".join(rng.choice(PARTS) + rng.choice(["", "", " ", " "]) for _ in range(rng.randrange(60))) for _ in range(300)]
    for end_id in (1, None):
        ids, ends = encoded(pa.array(texts, pa.large_string()), WORDS, end_id)
        assert [list(ids[a:b]) for a, b in zip(ends, ends[1:])] == plain(texts, end_id)


def test_kept_units_are_bounded(monkeypatch):
    monkeypatch.setattr(tokens, "KEPT_UNITS", 70)
    coder = tokens.Encoder(WORDS)
    for k in range(5):
        words = [f"w{i}x" for i in range(k, 60 + k)] + ["", "a\x01b", "z" * 100, "\x01", "a\x01b"]
        first, size, table = coder.of(pa.array(words, pa.large_string()))
        assert [list(table[a : a + n]) for a, n in zip(first, size)] == plain(words, None)
        assert len(coder.known) <= 70 + len(words)


def expected(rows):
    ids = plain([r[1] for r in rows])
    out, before = [], 0
    for r, x in sorted(zip(rows, ids), key=lambda z: (z[0][0] is not None, z[0][0] or 0)):
        out.append((r[0], before, len(x), zlib.crc32(np.array(x, "<u4").tobytes())))
        before += len(x)
    return out


def test_round_trip(spark):
    rng = random.Random(7)
    rows = [(3 * i - 50, None if i % 17 == 0 else " ".join(rng.choice(PARTS) for _ in range(rng.randrange(40))), 1, "x", 2) for i in range(400)]
    rows += [(5000, "long text, " * 60_000, 1, "x", 2), (5001, "", 1, "x", 2), (None, "no id", 1, "x", 2)]
    found = written_and_read(spark.createDataFrame(rng.sample(rows, len(rows)), KIND).repartition(5), WORDS)
    assert [tuple(r) for r in found.orderBy("start").collect()] == expected(rows)


def test_edges(spark):
    assert written_and_read(spark.createDataFrame([], KIND), WORDS).collect() == []
    rows = [(7, "same text", 1, "x", 2)] * 3 + [(7, "other", 1, "x", 2)] * 2 + [(None, None, 1, "x", 2)] * 2
    found = written_and_read(spark.createDataFrame(rows, KIND).repartition(3), WORDS).orderBy("start").collect()
    assert [r["start"] for r in found] == list(np.cumsum([0] + [r["n_tokens"] for r in found])[:-1])
    assert sorted((str(r["doc_id"]), r["n_tokens"], r["ids_crc32"]) for r in found) == sorted((str(a), n, c) for a, _, n, c in expected(rows))


@pytest.fixture(scope="module")
def folder(spark):
    rng = random.Random(3)
    rows = [(i, " ".join(f"w{rng.randrange(3000)}" for _ in range(rng.randrange(80, 200))), 1, "x", 2) for i in range(30_000)]
    out = scratch_path(spark, "tokens")
    write_tokens(spark.createDataFrame(rows, KIND).repartition(4), out, WORDS)
    return out


def test_file_format(spark, folder):
    """Encodings, row groups and page indexes as the module promises."""
    files = sorted({f.removeprefix("file:") for f in spark.read.parquet(f"{folder}/data").inputFiles()})
    groups = 0
    for name in files:
        meta = pq.ParquetFile(name).metadata
        groups += meta.num_row_groups
        for g in range(meta.num_row_groups):
            columns = {meta.row_group(g).column(c).path_in_schema: meta.row_group(g).column(c) for c in range(meta.num_columns)}
            assert meta.row_group(g).total_byte_size <= 2 * tokens.ROW_GROUP_BYTES
            assert all(c.has_offset_index for c in columns.values()) and columns["doc_id"].has_column_index
            ids = columns["tokens.list.element"]
            assert ids.has_dictionary_page and "RLE_DICTIONARY" in ids.encodings and ids.total_uncompressed_size < 2.6 * ids.num_values
            for c in ("doc_id", "start_in_part", "n_tokens"):
                assert not columns[c].has_dictionary_page and "DELTA_BINARY_PACKED" in columns[c].encodings
    assert groups >= len(files)
    order = [r["doc_id"] for r in spark.read.parquet(f"{folder}/data").orderBy("part", "start_in_part").select("doc_id").collect()]
    assert order == list(range(30_000))


def test_selective_reads(spark, folder):
    whole = {r["doc_id"]: r for r in read_documents(spark, folder).where("doc_id % 997 = 0 or doc_id between 1200 and 1210").collect()}
    some = read_documents(spark, folder, 1200, 1210)
    assert {r["doc_id"]: r for r in some.collect()} == {k: r for k, r in whole.items() if 1200 <= k <= 1210}
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(doc_id,1200)" in plan and "LessThanOrEqual(doc_id,1210)" in plan
    metadata = read_documents(spark, folder, tokens=False)
    assert "tokens:" not in metadata._jdf.queryExecution().executedPlan().toString().replace("n_tokens:", "")
    assert metadata.agg(F.sum("n_tokens")).first()[0] == read_index(spark, folder).agg(F.sum("n_tokens")).first()[0]


def test_span(spark, folder):
    rows = read_documents(spark, folder).orderBy("start").collect()
    ids = [i for r in rows for i in r["tokens"]]
    bounds = read_index(spark, folder).orderBy("first_id").select("first_id").collect()
    places = [(0, 1), (5, 5), (len(ids) - 3, len(ids) + 9), (1000, 1777)] + [(b["first_id"] - 40, b["first_id"] + 500) for b in bounds[1:]]
    for a, b in places:
        pieces = read_span(spark, folder, a, b).orderBy("start").collect()
        assert [i for p in pieces for i in p["tokens"]] == ids[max(a, 0) : b]
        assert all(ids[p["start"] : p["start"] + len(p["tokens"])] == p["tokens"] for p in pieces)
    sums = {r["doc_id"]: r["ids_crc32"] for r in with_checksums(read_documents(spark, folder, 0, 20)).collect()}
    assert sums == {r["doc_id"]: zlib.crc32(np.array(r["tokens"], "<u4").tobytes()) for r in rows[:21]}
