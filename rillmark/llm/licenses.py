"""License scans: ordered signature rules behind a keyword prefilter.

A rule is a hand-written regular expression over the words of a text (letters and
digits, lower case, one blank between), with keywords that every match holds, a
priority and a confidence. Rules are written per license and per form: tag, expression
(members of an SPDX expression beside the first or beside a name with a version), notice (sentences of the license's own text),
grant, reference, title, mention, identifier (an SPDX name with a version, standing alone). Keywords are looked up by word hash for all words of a batch
at once, so a regular expression only runs on texts that can match it. Signs beyond ASCII are part
of a word but, as for the expressions, not of a keyword ("MIT license" in curly marks). Detections that
lie inside another one of the same or a higher priority are suppressed; of two with the
same interval the first rule in order stays.

Besides, every place of a base phrase is counted on the words themselves.

Defined results: a null text counts as empty: no words, no labels, score 0; repeated rows
are scanned each; whole texts are scanned whatever their length; only doc_id and text are
read, so other columns may have any name.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillmark.llm.frames import row_chunks
from rillmark.llm.words import ALPHANUMERIC, FOLD, Words, word_hash, words_of

#: Base phrases and their labels, fixed.
PHRASES = (
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
)

#: label, SPDX tag as words, name as a regular expression over words, keywords of the name (| between words of which one is enough).
LICENSES = (
    ("gpl-3.0", r"gpl 3 0(?: only| or later)?", r"(?:gnu )?(?:general public license|gpl)(?:(?: v| version)? ?3| version v3| ?v3)(?: 0)?", ("license|license3|licensev3|gpl|gpl3|gplv3", "3|v3|version3|gpl3|gplv3|license3|licensev3")),
    ("gpl-2.0", r"gpl 2 0(?: only| or later)?", r"(?:gnu )?(?:general public license|gpl)(?:(?: v| version)? ?2| version v2| ?v2)(?: 0)?", ("license|license2|licensev2|gpl|gpl2|gplv2", "2|v2|version2|gpl2|gplv2|license2|licensev2")),
    ("gpl-any", r"gpl", r"(?:gnu general public license|gnu gpl)", ("gnu",)),
    ("lgpl-3.0", r"lgpl 3 0(?: only| or later)?", r"(?:gnu )?(?:lesser general public license|lgpl)(?:(?: v| version)? ?3| version v3| ?v3)(?: 0)?", ("3|v3|version3|lgpl3|lgplv3|license3|licensev3",)),
    ("lgpl-2.1", r"lgpl 2 1(?: only| or later)?", r"(?:gnu )?(?:lesser general public license|lgpl)(?:(?: v| version)? ?2| version v2| ?v2) 1", ("2|v2|version2|lgpl2|lgplv2|license2|licensev2", "1")),
    ("agpl-3.0", r"agpl 3 0(?: only| or later)?", r"(?:gnu )?(?:affero general public license|agpl)(?:(?:(?: v| version)? ?3| version v3| ?v3)(?: 0)?| v| version)?", ()),
    ("gfdl", r"gfdl 1 [123]", r"gnu free documentation license", ("documentation",)),
    ("apache-2.0", r"apache 2 0", r"apache (?:license|software license)(?: v| version)? v?2(?: 0)?", ("apache", "2|v2")),
    ("apache-1.1", r"apache 1 1", r"apache software license(?: version)? v?1 1", ("apache", "1")),
    ("mit", r"mit", r"mit (?:license|licence|x11 license)", ("mit",)),
    ("mit-0", r"mit 0", r"mit no attribution(?: license)?", ("mit", "attribution")),
    ("bsd-2-clause", r"bsd 2 clause", r"(?:bsd (?:2|two) clause|(?:2|two) clause bsd|simplified bsd|freebsd)(?: licen[cs]e)?", ("bsd|freebsd",)),
    ("bsd-3-clause", r"bsd 3 clause", r"(?:bsd (?:3|three) clause|(?:3|three) clause bsd|new bsd|modified bsd)(?: licen[cs]e)?", ("bsd",)),
    ("bsd-any", r"bsd", r"bsd (?:style )?licen[cs]e", ("bsd",)),
    ("mpl-2.0", r"mpl 2 0", r"mozilla public license(?: v| version)? v?2(?: 0)?", ("mozilla", "2|v2")),
    ("mpl-1.1", r"mpl 1 1", r"mozilla public license(?: v| version)? v?1 1", ("mozilla", "1")),
    ("epl-2.0", r"epl 2 0", r"eclipse public license(?: v| version)? v?2(?: 0)?", ("eclipse", "2|v2")),
    ("epl-1.0", r"epl 1 0", r"eclipse public license(?: v| version)? v?1(?: 0)?", ("eclipse", "1|v1")),
    ("cddl-1.0", r"cddl 1 0", r"common development and distribution license", ("distribution",)),
    ("cpl-1.0", r"cpl 1 0", r"common public license", ("common",)),
    ("isc", r"isc", r"isc licen[cs]e", ("isc",)),
    ("zlib", r"zlib", r"zlib (?:libpng )?licen[cs]e", ("zlib",)),
    ("boost-1.0", r"bsl 1 0", r"boost software license", ("boost",)),
    ("unlicense", r"unlicense", r"(?:the )?unlicense", ("unlicense",)),
    ("wtfpl", r"wtfpl", r"(?:wtfpl|do what the fuck you want to public license)", ()),
    ("artistic-2.0", r"artistic 2 0", r"artistic license(?: version)?(?: v?2(?: 0)?)?", ("artistic",)),
    ("python-2.0", r"psf 2 0", r"(?:python software foundation|psf) license", ("license",)),
    ("postgresql", r"postgresql", r"postgresql licen[cs]e", ("postgresql",)),
    ("openssl", r"openssl", r"openssl licen[cs]e", ("openssl",)),
    ("ofl-1.1", r"ofl 1 1", r"(?:sil )?open font license(?: version)?(?: v?1 1)?", ("font",)),
    ("eupl-1.2", r"eupl 1 2", r"european union public licen[cs]e", ("european",)),
    ("odbl-1.0", r"odbl 1 0", r"open (?:data commons open )?database license", ("database",)),
    ("cc0-1.0", r"cc0 1 0", r"(?:cc0(?: v?1 0)?|creative commons zero)", ()),
    ("cc-by-4.0", r"cc by 4 0", r"(?:cc by|creative commons attribution)(?: v?4 0)(?: international)?", ("4|v4",)),
    ("cc-by-3.0", r"cc by 3 0", r"(?:cc by|creative commons attribution)(?: v?3 0)(?: unported)?", ("3|v3",)),
    ("cc-by-sa", r"cc by sa [234] [05]", r"(?:cc by sa|creative commons attribution share ?alike)(?: v?[234] [05])?", ()),
    ("cc-by-nc", r"cc by nc [234] [05]", r"(?:cc by nc|creative commons attribution non ?commercial)(?: v?[234] [05])?", ()),
    ("cc-by-nd", r"cc by nd [234] [05]", r"(?:cc by nd|creative commons attribution no ?deriv(?:ative|ate)s)(?: v?[234] [05])?", ()),
    ("cc-by-nc-sa", r"cc by nc sa [234] [05]", r"(?:cc by nc sa|creative commons attribution non ?commercial share ?alike)(?: v?[234] [05])?", ()),
    ("cc-by-nc-nd", r"cc by nc nd [234] [05]", r"(?:cc by nc nd|creative commons attribution non ?commercial no ?deriv(?:ative|ate)s)(?: v?[234] [05])?", ()),
    ("public-domain", r"pddl 1 0", r"public domain(?: dedication)?", ("public", "domain")),
    ("proprietary", r"licenseref proprietary", r"all rights reserved", ("rights", "reserved")),
)

#: form, regular expression around the name (or tag), its keywords, priority, confidence.
FORMS = (
    ("tag", r"spdx licen[cs]e identifier {tag}", ("spdx", "identifier"), 5, 1.0),
    ("grant", r"(?:licensed|released|distributed|redistributed|published|available|provided) under (?:the )?(?:terms of )?(?:the )?{name}", ("under",), 4, 0.95),
    ("grant", r"subject to (?:the )?(?:terms(?: and conditions)? of )?(?:the )?{name}", ("subject",), 4, 0.9),
    ("reference", r"(?:see|read|copy of|accept|terms of|conditions of) (?:the )?{name}", (), 3, 0.8),
    ("title", r"{name} (?:terms and conditions|copyright|permission is hereby granted)", (), 3, 0.8),
    ("mention", r"(?:this|the|a|an) {name}", (), 2, 0.6),
    ("mention", r"{name}", (), 1, 0.5),
)


#: label, sentence of the license's own text or of its notice as a regular expression over words, keywords. Fixed values.
NOTICES = (
    ("mit", r"permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", ("hereby", "charge")),
    ("boost-1.0", r"permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation", ("hereby", "organization")),
    ("isc", r"permission to use copy modify and(?: or)? distribute this software for any purpose with or without fee is hereby granted", ("hereby", "fee")),
    ("postgresql", r"permission to use copy modify and distribute this software and its documentation for any purpose without fee and without a written agreement is hereby granted", ("hereby", "agreement")),
    ("bsd-any", r"redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", ("redistribution",)),
    ("bsd-3-clause", r"may be used to endorse or promote products derived from this software without specific prior written permission", ("endorse",)),
    ("zlib", r"in no event will the authors be held liable for any damages arising from the use of this software", ("liable", "arising")),
    ("apache-2.0", r"unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis", ("applicable", "basis")),
    ("gpl-3.0", r"redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3", ("redistribute", "gnu")),
    ("gpl-2.0", r"redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2", ("redistribute", "gnu")),
    ("lgpl-3.0", r"modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 3", ("lesser", "gnu")),
    ("lgpl-2.1", r"modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 2 1", ("lesser", "gnu")),
    ("agpl-3.0", r"modify it under the terms of the gnu affero general public license as published by the free software foundation", ("affero", "gnu")),
    ("mpl-2.0", r"this source code form is subject to the terms of the mozilla public license v 2 0", ("mozilla",)),
    ("epl-2.0", r"made available under the terms of the eclipse public license(?: v)? 2 0", ("eclipse",)),
    ("unlicense", r"this is free and unencumbered software released into the public domain", ("unencumbered",)),
    ("cc0-1.0", r"(?:has|have) waived all copyright and related or neighboring rights", ("waived",)),
    ("wtfpl", r"everyone is permitted to copy and distribute verbatim or modified copies of this license document and changing it is allowed as long as the name is changed", ("verbatim",)),
    ("python-2.0", r"psf is making python available to licensee on an as is basis", ("licensee",)),
)


class Rule(NamedTuple):
    label: str
    form: str
    pattern: re.Pattern
    keywords: tuple[frozenset[str], ...]
    priority: int
    confidence: float


def _rule(label: str, form: str, text: str, keys: tuple[str, ...], priority: int, confidence: float) -> Rule:
    return Rule(label, form, re.compile(rf"\b(?:{text})\b"), tuple(frozenset(k.split("|")) for k in keys), priority, confidence)


@lru_cache(maxsize=1)
def rules() -> tuple[Rule, ...]:
    """All rules in order of priority, then as written."""
    made = [
        _rule(label, form, text.format(tag=tag, name=name), (*needs, *(keys if form != "tag" else ())), priority, confidence)
        for form, text, needs, priority, confidence in FORMS
        for label, tag, name, keys in LICENSES
    ]
    any_tag = "|".join(tag for _, tag, _, _ in LICENSES)
    versioned = "|".join(tag for label, tag, _, _ in LICENSES if label not in NOT_ALONE and " " in tag)
    for label, tag, _, _ in LICENSES:
        keys = ("or|and", tag.split()[0])
        made.append(_rule(label, "expression", rf"spdx licen[cs]e identifier (?:{any_tag}) (?:or|and) {tag}", ("spdx", "identifier", *keys), 4, 1.0))
        made.append(_rule(label, "expression", rf"(?:{versioned}) (?:or|and) {tag}|{tag} (?:or|and) (?:{versioned})", keys, 0, 0.8))
    made += [_rule(label, "notice", text, keys, 4, 0.95) for label, text, keys in NOTICES]
    made += [_rule(label, "identifier", tag, (tag.split()[0],), 1, 0.5) for label, tag, _, _ in LICENSES if label not in NOT_ALONE and " " in tag]
    return tuple(sorted(made, key=lambda r: -r.priority))


#: Their SPDX names are plain words in some language, or say nothing alone.
NOT_ALONE = ("mit-0", "proprietary")
#: A rule can only match where one of these words occurs.
ANCHORS = (
    "license licence licensed gpl lgpl agpl spdx cc cc0 mit bsd unlicense freebsd wtfpl reserved domain creative apache mozilla gnu "
    "gpl2 gpl3 gplv2 gplv3 lgpl2 lgpl3 lgplv2 lgplv3 agpl3 agplv3 license2 license3 licensev2 licensev3 "
    "hereby redistribution endorse liable applicable unencumbered waived licensee eclipse gfdl mpl epl cddl cpl bsl artistic psf ofl eupl odbl pddl"
).split()
ANCHOR = re.compile(r"\b(?:%s)\b" % "|".join(ANCHORS))


def _phrase_places(words: Words, text: str) -> np.ndarray:
    """Indexes of words at which the phrase stands, inside one text."""
    parts = text.split()
    n = len(words.hash) - len(parts) + 1
    at = np.flatnonzero(words.hash[: max(n, 0)] == word_hash(parts[0]))
    for k, part in enumerate(parts[1:], 1):
        at = at[(words.hash[at + k] == word_hash(part)) & (words.row[at + k] == words.row[at])]
    spelled = [b" ".join(FOLD[words.data[words.begin[i + k] : words.end[i + k]]].tobytes() for k in range(len(parts))) for i in at]
    return at[[s == text.encode() for s in spelled]] if len(at) else at


def _rows_of_mixed(words: Words) -> np.ndarray:
    """Rows with an anchor beside a sign beyond ASCII, in one word."""
    above = np.concatenate([[0], np.cumsum(words.data >= 0x80)])
    n = above[words.end] - above[words.begin]
    mixed = np.flatnonzero((n > 0) & (n < words.end - words.begin))
    _, first, number = np.unique(words.hash[mixed], return_index=True, return_inverse=True)
    spelled = (FOLD[words.data[words.begin[i] : words.end[i]]].tobytes().decode() for i in mixed[first].tolist())
    holds = np.fromiter((ANCHOR.search(word) is not None for word in spelled), bool, len(first))
    return words.row[mixed[holds[number]]]


def detections(text: str) -> list[tuple[int, int, Rule]]:
    """Detections of a text of words, (first character, end, rule), after suppression."""
    present = set(text.split()) if text.isascii() else {*text.split(), *re.findall(r"\w+", text)}
    found = []
    for order, rule in enumerate(rules()):
        if not any(present.isdisjoint(words) for words in rule.keywords):
            found += [(m.start(), m.end(), order, rule) for m in rule.pattern.finditer(text)]
    kept: list[tuple[int, int, Rule]] = []
    reach = [0] * 8  # by priority: the furthest end of an interval of that priority or a higher one, so far
    for a, b, _, rule in sorted(found, key=lambda d: (d[0], -d[1], -d[3].priority, d[2])):
        if reach[rule.priority] < b:
            kept.append((a, b, rule))
            reach[: rule.priority + 1] = [max(b, x) for x in reach[: rule.priority + 1]]
    return kept



FOUND = (
    "n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels array<string>, labels array<string>, score double, "
    "detections array<struct<label: string, form: string, first_word: bigint, n_words: bigint>>"
)


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    anchors = np.array(sorted(int(word_hash(w)) for w in ANCHORS), np.uint64)
    possible = np.zeros(1 << 16, bool)
    possible[(anchors & np.uint64(0xFFFF)).astype(np.int64)] = True
    item = pa.struct([("label", pa.string()), ("form", pa.string()), ("first_word", pa.int64()), ("n_words", pa.int64())])
    for batch in row_chunks(batches, "text"):
        words = words_of(batch.column("text"), ALPHANUMERIC)
        first, n = words.first(), batch.num_rows
        base: list[list[tuple[int, str]]] = [[] for _ in range(n)]
        for phrase, label in PHRASES:
            for i in _phrase_places(words, phrase).tolist():
                base[words.row[i]].append((i - int(first[words.row[i]]), label))
        hit = np.flatnonzero(possible[(words.hash & np.uint64(0xFFFF)).astype(np.int64)])
        hit = hit[np.isin(words.hash[hit], anchors)]
        gated = {*words.row[hit].tolist(), *_rows_of_mixed(words).tolist()}
        out: list[tuple] = []
        for row in range(n):
            places = [at for at, _ in base[row]]
            plain = sorted({label for _, label in base[row]})
            made, score = [], 0.4 if places else 0.0
            if row in gated:
                spelled = [FOLD[words.data[a:b]].tobytes() for a, b in zip(words.begin[first[row] : first[row + 1]], words.end[first[row] : first[row + 1]])]
                text = b" ".join(spelled).decode()
                before, upto = 0, 0  # detections stand by their start, so blanks are counted once
                for a, b, rule in detections(text):
                    before, upto = before + text.count(" ", upto, a), a
                    made.append({"label": rule.label, "form": rule.form, "first_word": before, "n_words": text.count(" ", a, b) + 1})
                    score = max(score, rule.confidence)
            labels = sorted({*plain, *(d["label"] for d in made)})
            size = int(first[row + 1] - first[row])
            out.append((size, len(places), min(places, default=None), max(places, default=None), plain, labels, score, made))
        kinds = [pa.int64()] * 4 + [pa.list_(pa.string())] * 2 + [pa.float64(), pa.list_(item)]
        columns = [pa.array(c, k) for c, k in zip(zip(*out), kinds)]
        names = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "detections"]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], names=names)


def scan_licenses(docs: DataFrame) -> DataFrame:
    """One row per document: word count, places of base phrases, labels, score and detections."""
    rows = docs.select("doc_id", "text")
    return rows.mapInArrow(_scan, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, {FOUND}")


def with_joined_labels(found: DataFrame) -> DataFrame:
    """Label arrays as comma-joined text."""
    joined = {c: F.array_join(c, ",") for c in ("base_labels", "labels")}
    return found.withColumns(joined).withColumn("n_detections", F.size("detections")).drop("detections")
