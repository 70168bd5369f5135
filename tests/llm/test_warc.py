import base64
import gzip
import hashlib
import os

import pytest

from rillmark.llm import warc
from rillmark.llm.warc import archived, read_archives, record_table, records_of, write_archives
from rillmark.session import scratch_path

PAGES = [
    (5, "http://a/", "same é"), (3, "http://b/\r\nx y", "same é"), (9, None, "same é"), (4, "u", None), (6, "u", ""), (7, "u", "long " * 90_000),
    (8, "u", "line\r\n\r\nWARC/1.1\r\n\r\n"), (3, "http://b/", "same é"), (None, "u", "same é"), (None, "u", "only here"), (11, "u", "only here 2"),
]


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x") for r in rows], "page_id bigint, url string, html string, chunk string").repartition(3)


def expected(rows, least):
    first = {}
    for k, _, html in rows:
        if k is not None:
            first[html or ""] = min(first.get(html or "", k), k)
    out = []
    for k, _, html in rows:
        payload = (html or "").encode()
        lead = first.get(html or "")
        again = len(payload) >= least and lead is not None and k != lead and sum((r[2] or "") == (html or "") for r in rows) > 1
        out.append((k, len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode(), "revisit" if again else "response", lead if again else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("least", [0, 5])
def test_round_trip(spark, least):
    found = archived(frame(spark, PAGES), least).drop("record_id")
    assert sorted(map(tuple, found.collect()), key=str) == expected(PAGES, least)


def test_chunks_and_files(spark, monkeypatch):
    folder = scratch_path(spark, "warc")
    records = record_table(frame(spark, PAGES), chunk=1000)
    manifest = write_archives(records, folder, file_bytes=200)
    assert manifest.count() > 3 and sum(r["records"] for r in manifest.collect()) == len(PAGES)
    rows = read_archives(manifest, folder, chunk=777).collect()
    payloads = {}
    for r in sorted(rows, key=lambda r: (r["record_id"], r["chunk_no"])):
        before = payloads.get(r["record_id"], b"")
        assert len(r["chunk"]) <= 777 and r["bytes_so_far"] == len(before) + len(r["chunk"])
        payloads[r["record_id"]] = before + r["chunk"]
        assert r["digest_so_far"] == base64.b32encode(hashlib.sha1(payloads[r["record_id"]]).digest()).decode()
    full = {r["record_id"]: r for r in rows if r["last"]}
    assert len(full) == len(PAGES)
    assert sorted(payloads[k].decode() for k, r in full.items() if r["record_type"] == "response") == sorted(
        [html or "" for k, _, html in PAGES if (html or "") not in ("same é", "")] + ["same é"] * 2 + [""]
    )
    path = manifest.first()["path"]
    assert gzip.open(path).read(8) == b"WARC/1.1"


def test_broken_archives_are_errors(spark):
    folder = scratch_path(spark, "warc")
    path = write_archives(record_table(frame(spark, [(1, "u", "payload")])), folder).first()["path"]
    data = gzip.open(path).read()
    import io

    assert [r["payload_bytes"] for r in records_of(io.BytesIO(data), 3, True) if r["last"]] == [7]
    for bad in (data.replace(b"payload\r", b"paYload\r"), data[:-8], data.replace(b"payload\r\n", b"payload\r\r"), b"HTTP" + data):
        with pytest.raises(ValueError):
            list(records_of(io.BytesIO(bad), 3, True))


def test_empty(spark):
    assert archived(frame(spark, [])).count() == 0
    assert os.path.isabs(warc._filesystem("file:/tmp/x")[1])
