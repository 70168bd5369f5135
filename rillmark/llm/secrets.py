"""Secrets in whole texts: fixed patterns, and novelty measured with a primed zstandard compressor.

Fixed patterns find assignments, access keys and long hex strings. The method adds
strings that stand close behind a sensitive word and that the compressor cannot
shorten: a candidate's novelty is the number of bytes by which the compressed
surroundings grow when the candidate is put back, per byte of the candidate, with the
compressor primed by a dictionary of identifiers. Other copies of the candidate are
blanked in the surroundings, so a secret that is said twice is found twice. Words, paths
and placeholders are in the dictionary or in the surroundings and cost few bytes; random
strings cost nearly their entropy. Every string that starts within the reach behind a
sensitive word is measured, also behind one that was rejected or is part of a fixed span;
a string with assignments in it is measured whole, then value by value. The body of a private key
block is measured as one string, whatever its length.

Defined results: a null text counts as empty and has no spans; repeated rows are scanned
each; texts of any length are scanned whole; offsets are code points, end exclusive;
spans are ordered by start, then by kind (assign, access, hex, novel). A novel span never
overlaps a fixed one. Other columns, whatever their names, pass through ``redacted``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillmark.llm.frames import row_chunks
from rillmark.llm.words import FOLD, utf8, words_of

# Fixed patterns. Bytes, so that letters fold in ASCII only.
ASSIGN = re.compile(rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE)
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
ASSIGN_WORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
KINDS = ("assign", "access", "hex", "novel")
HEX = np.zeros(256, bool)
HEX[48:58] = HEX[97:103] = True

#: Sensitive words; a candidate starts at most 32 bytes behind one, on the same line.
SENSITIVE = (
    b"password", b"passwd", b"passphrase", b"pwd", b"secret", b"token", b"apikey", b"api_key", b"api-key", b"api key", b"access_key",
    b"access key", b"private_key", b"private key", b"credential", b"bearer", b"authorization", b"signing", b"client_id", b"session_id",
    b"accesskey", b"access-key", b"privatekey", b"private-key", b"clientid", b"sessionid", b"key",
)
#: Before and behind a word: no letter, or a change of case (secretKey, AWSSecret, AWSsecret).
EDGE = rb"|(?<=[a-z])(?=[A-Z])|(?<=[A-Z])(?=[A-Z][a-z])|(?<=[A-Z][A-Z])(?=[a-z])"
WORD = re.compile(rb"(?:(?<![A-Za-z])%s)(?i:(?:%s)s?)(?:(?![A-Za-z])%s)" % (EDGE, b"|".join(map(re.escape, SENSITIVE)), EDGE))
REACH, LEAST = 32, 16
RUN = re.compile(rb"(?<![A-Za-z0-9+/_.=-])[A-Za-z0-9+/_.=-]{%d}" % LEAST)
#: A value in the run that holds the word itself: privateKey=...; and up to the next name of that run.
VALUE = re.compile(rb"[A-Za-z0-9+/_.-]{0,%d}=+([A-Za-z0-9+/_.-][A-Za-z0-9+/_.=-]{%d,})" % (REACH - 1, LEAST - 1))
PART = re.compile(rb"[A-Za-z0-9+/_.-]{0,%d}=+([A-Za-z0-9+/_.-]{%d,}=*)" % (REACH - 1, LEAST))
#: The name of the next value of a run, behind a mark that may stand in values too.
NEXT_NAME = re.compile(rb"[+/.-][A-Za-z_]{2,40}=+\Z")
#: The lines of a private key in its usual armour.
BLOCK = re.compile(rb"-----BEGIN [A-Z0-9 ]{0,40}PRIVATE KEY(?: BLOCK)?-----\s*+([A-Za-z0-9+/=]{%d,}+(?:\s++[A-Za-z0-9+/=]++)*+)" % LEAST)
RUN_REST = re.compile(rb"[A-Za-z0-9+/_.=-]*")
MARK = "[SECRET]"
NOVELTY = 0.6
AROUND = 256

#: Identifiers that the compressor knows beforehand.
IDENTIFIERS = """
abstract account action active address admin alias allow amount append application argument array assert async attribute await
backend base64 batch begin boolean branch broken buffer builder button bytes cache callback cancel catch certificate channel char
class client cluster collection column command comment commit common component config configuration connect connection const
constant constructor container content context controller cookie count create created credentials current custom database data
date debug default define delete deploy description destination development dictionary directory disable display document domain
double download duration element email empty enable encode endpoint enum environment error event example exception execute exists
export extends extension factory false field file filter final finally float folder format function gateway generate getattr
global group handler header height hidden host https identifier image implements import include index info initial input insert
instance integer interface internal invalid item iterator javascript join json key lambda language length level library license
limit link list listener local location localhost logger login main manager mapping master maximum message method minimum model
module monitor mutable name namespace network node none notification null number object offset option order output override owner
package parameter parent parse password path pattern payload permission placeholder platform plugin pointer port position post
postgres prefix primary private process production profile project property protected provider proxy public publish python query
queue random range read readonly record redirect reference region register release remote remove render replace repository request
required reset resource response result return role route runtime sample schedule schema scope script search secret section
security select self sequence server service session setting shared signature size source static status storage stream string
struct subject submit suffix super switch system table target task template terminal test text thread throw timeout timestamp
title token total trace transaction transform true type undefined union unique unsigned update upload url user username uuid
valid validate value variable vector verify version view virtual void volume warning widget width window worker workspace write
your_password_here your_token_here your_api_key_here changeme example_secret xxxxxxxxxxxxxxxx 0000000000000000 1234567890abcdef
ABCDEFGHIJKLMNOPQRSTUVWXYZ abcdefghijklmnopqrstuvwxyz 0123456789
"""


@lru_cache(maxsize=1)
def _compressor():
    import zstandard

    known = zstandard.ZstdCompressionDict(IDENTIFIERS.encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    return zstandard.ZstdCompressor(level=9, dict_data=known, write_checksum=False, write_content_size=False, write_dict_id=False)


def novelty(text: bytes, start: int, end: int) -> float:
    """Compressed bytes that text[start:end] adds to its surroundings, per byte."""
    before, after = text[max(0, start - AROUND) : start], text[end : end + AROUND]
    size = lambda x: len(_compressor().compress(x))
    return (size(before + text[start:end] + after) - size(before + after)) / (end - start)


def novelty_alone(text: bytes, start: int, end: int) -> float:
    """``novelty`` with all other copies of text[start:end] blanked, also those that the edge of the surroundings cuts.

    Copies may differ in the marks around them and in a name with ``=`` before them.
    """
    whole = text[start:end]
    core = max(whole.strip(b"=./_+-").split(b"="), key=len)
    core = core if len(core) >= 8 else whole
    wide, blank = AROUND + len(core) - 1, b" " * len(core)
    before = text[max(0, start - wide) : start].replace(core, blank)[-AROUND:]
    after = text[end : end + wide].replace(core, blank)[:AROUND]
    return novelty(before + whole + after, len(before), len(before) + len(whole))


def _fixed(text: bytes, runs: list[tuple[int, int]]) -> list[tuple[int, int, int]]:
    """(start, kind, end) in bytes; ``runs``: hex runs of this text."""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    return found + [(a, 2, b) for a, b in runs]


def _candidates(text: bytes) -> list[tuple[int, int]]:
    """All runs, and values behind ``=`` in the run of the word, that start within the reach behind a sensitive word, on its line; key blocks."""
    found = {m.start(1): m.end(1) for m in BLOCK.finditer(text)}
    run_end = 0
    for word in WORD.finditer(text):
        at = word.end()
        line = text.find(b"\n", at, at + REACH + 1)
        if at >= run_end and (m := VALUE.match(text, at)):
            run_end = found[m.start(1)] = m.end(1)
        elif at < run_end and (m := PART.match(text, at, run_end)):
            name = NEXT_NAME.search(text, max(m.start(1) + LEAST, m.end(1) - 48), m.end(1)) if m.end(1) < run_end else None
            found[m.start(1)] = name.start() if name else m.end(1)
        last = at + REACH if line < 0 else line - 1  # where a run may start
        while at <= last and (m := RUN.search(text, at, last + LEAST)):
            at = found.get(m.start()) or RUN_REST.match(text, m.end()).end()
            found[m.start()] = at
    return sorted(found.items())


def _novel(text: bytes, found: list[tuple[int, int, int]], threshold: float) -> list[tuple[int, int, int]]:
    out, fixed, k, reach = [], sorted((a, b) for a, _, b in found), 0, 0
    for a, b in _candidates(text):
        while k < len(fixed) and fixed[k][0] < b:
            reach = max(reach, fixed[k][1])
            k += 1
        if reach <= a and novelty_alone(text, a, b) >= threshold:
            out.append((a, 3, b))
            reach = b
    return out


def spans_of(column: pa.Array, threshold: float = NOVELTY) -> dict[int, list[tuple[int, int, int]]]:
    """Row -> (start, kind number, end) in bytes, ordered, for rows that have any."""
    data, bounds = utf8(column)
    low = FOLD[data].tobytes()
    rows: dict[int, list[tuple[int, int]]] = {}

    def mark(word: bytes, text: bytes) -> None:
        at = text.find(word)
        while at >= 0:
            row = int(np.searchsorted(bounds, at, "right")) - 1
            rows.setdefault(row, [])
            at = text.find(word, max(at + 1, int(bounds[row + 1]) - len(word) + 1))

    for word in sorted({*ASSIGN_WORDS, *SENSITIVE}):
        mark(word, low)
    mark(b"akia", low)
    runs = words_of(column, HEX, hashed=False)
    long = np.flatnonzero(runs.end - runs.begin >= 24)
    for k in long.tolist():
        row = int(runs.row[k])
        base = int(bounds[row])
        rows.setdefault(row, []).append((int(runs.begin[k]) - base, int(runs.end[k]) - base))
    out = {}
    for row, hexes in rows.items():
        text = data[bounds[row] : bounds[row + 1]].tobytes()
        found = _fixed(text, hexes)
        found = sorted(found + _novel(text, found, threshold))
        if found:
            out[row] = found
    return out


def in_points(text: bytes, found: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Byte offsets as code points."""
    points = np.concatenate([[0], np.cumsum((np.frombuffer(text, np.uint8) & 0xC0) != 0x80)])
    return [(int(points[a]), kind, int(points[b])) for a, kind, b in found]


def find_secrets(docs: DataFrame, threshold: float = NOVELTY) -> DataFrame:
    """(doc_id, spans): all spans of every document as an array of (kind, start, end)."""
    rows = docs.select("doc_id", "text")
    kind = "spans array<struct<kind: string, start: bigint, end: bigint>>"
    key = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in row_chunks(batches, "text"):
            column = batch.column("text")
            data, bounds = utf8(column)
            found = spans_of(column, threshold)
            spans = [
                [{"kind": KINDS[k], "start": a, "end": b} for a, k, b in in_points(data[bounds[i] : bounds[i + 1]].tobytes(), found[i])] if i in found else []
                for i in range(batch.num_rows)
            ]
            item = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(spans, pa.list_(item))], names=["doc_id", "spans"])

    return rows.mapInArrow(run, f"doc_id {key}, {kind}")


def with_digests(found: DataFrame) -> DataFrame:
    """Counts per fixed kind, a digest of the fixed spans, and all spans as text."""
    as_text = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    of = lambda kind: F.filter("spans", lambda s: s["kind"] == kind)
    fixed = F.filter("spans", lambda s: s["kind"] != "novel")
    return found.select(
        "doc_id", *[F.size(of(kind)).cast("bigint").alias(f"n_{kind}") for kind in KINDS],
        F.sha2(as_text(fixed), 256).alias("base_sha256"), as_text("spans").alias("spans"),
    )


def redacted(docs: DataFrame, threshold: float = NOVELTY, mark: str = MARK) -> DataFrame:
    """``docs`` with every span replaced by ``mark``; texts without spans, and all other columns, stay as they are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in row_chunks(batches, "text"):
            column = batch.column("text")
            found = spans_of(column, threshold)
            if found:
                texts = column.to_pylist()
                for row, spans in found.items():
                    text, out, at = texts[row].encode(), [], 0
                    for a, _, b in spans:
                        if a >= at:
                            out += [text[at:a], mark.encode()]
                        at = max(at, b)
                    texts[row] = b"".join([*out, text[at:]]).decode()
                where = batch.schema.get_field_index("text")
                batch = batch.set_column(where, batch.schema.field("text"), pa.array(texts, column.type))
            yield batch

    return docs.mapInArrow(run, docs.schema)

