import re
from re import _parser

from rillmark.llm.licenses import ANCHORS, PHRASES, detections, rules, scan_licenses, with_joined_labels

TEXTS = [
    None, "", "plain words only", "Licensed under the Apache License, Version 2.0.", "CC BY-NC 4.0 and cc\nby, cc-by; ccby cc, x by",
    "This work is licensed under the GNU General Public License, version 3. GNU general public license",
    "MIT-License! the mit license (MIT LICENSE)", "SPDX-License-Identifier: BSD-3-Clause", "Émile's GNU General\tPublic  License é",
    "w " * 100_000 + "released under the MIT License.", "cc by cc by cc by", "gnu general public", "İ MIT license",
]
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    places = [(i, label) for phrase, label in PHRASES for i in range(len(words)) if words[i : i + len(phrase.split())] == phrase.split()]
    starts = [i for i, _ in places]
    return len(words), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in places}))


def test_base_places_equal_brute_force(documents):
    rows = list(enumerate(TEXTS))
    found = {r["doc_id"]: r for r in with_joined_labels(scan_licenses(documents(rows))).collect()}
    for k, text in rows:
        r = found[k]
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == brute(text), text
        assert set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(",")) | {""}
        assert r["labels"].split(",") == sorted(set(r["labels"].split(","))) and 0 <= r["score"] <= 1
    assert found[7]["labels"] == "bsd-3-clause" and found[7]["score"] == 1.0
    assert found[3]["labels"] == "apache,apache-2.0" and found[9]["labels"] == "mit" and found[2]["score"] == 0


def test_suppression_is_containment_by_priority():
    found = detections("licensed under the gnu general public license version 3 or the mit license")
    assert [(d[2].label, d[2].form) for d in found] == [("gpl-3.0", "grant"), ("mit", "mention")]
    every = [(m.start(), m.end(), r.priority, k) for k, r in enumerate(rules()) for m in r.pattern.finditer("see the mit license terms of the mit license")]
    text = "see the mit license terms of the mit license"
    kept = {(a, b) for a, b, _ in detections(text)}
    for a, b, p, _ in every:
        inside = any(x <= a and b <= y and q >= p and (x, y) != (a, b) for x, y, q, _ in every)
        assert inside or (a, b) in kept


def test_rules_are_hundreds_and_keywords_are_needed():
    assert len(rules()) > 200 and len({(r.label, r.form, r.pattern.pattern) for r in rules()}) == len(rules())
    assert list(rules()) == sorted(rules(), key=lambda r: -r.priority)


def test_empty_and_repeated(documents):
    assert scan_licenses(documents([])).count() == 0
    rows = scan_licenses(documents([(1, "mit license"), (1, "mit license"), (None, None)])).collect()
    assert len(rows) == 3 and sum(r["n_base"] for r in rows) == 2


def written(tree):
    """All texts that a parsed expression without unbounded repeats can match."""
    out = [""]
    for op, arg in tree:
        kind = str(op)
        if kind == "AT":
            continue
        if kind == "LITERAL":
            parts = [chr(arg)]
        elif kind == "IN":
            parts = [chr(a) for o, a in arg if str(o) == "LITERAL"]
        elif kind == "BRANCH":
            parts = [w for branch in arg[1] for w in written(branch)]
        elif kind == "SUBPATTERN":
            parts = written(arg[3])
        else:
            assert kind == "MAX_REPEAT" and arg[:2] == (0, 1)
            parts = ["", *written(arg[2])]
        out = [a + b for a in out for b in parts]
    return out


def test_every_match_passes_its_own_gate_and_the_anchors():
    for rule in rules():
        for text in set(written(_parser.parse(rule.pattern.pattern))):
            assert rule.pattern.fullmatch(text)
            words = set(text.split())
            assert all(words & set(keys) for keys in rule.keywords) and words & set(ANCHORS), (rule.label, rule.form, text)


def test_versions_and_signs_beside_words(documents):
    texts = {
        "Licensed under the GPL v3": "gpl-3.0", "GPL v3.0": "gpl-3.0", "General Public License v2": "gpl-2.0", "GPL3": "gpl-3.0", "GPLv2": "gpl-2.0",
        "GPLv3": "gpl-3.0", "LGPL v2.1": "lgpl-2.1", "LGPLv3": "lgpl-3.0", "AGPLv3": "agpl-3.0", "Apache License v2.0": "apache-2.0",
        "Mozilla Public License, v2.0": "mpl-2.0", "Eclipse Public License v1.0": "epl-1.0", "CC BY v4.0": "cc-by-4.0", "FreeBSD license": "bsd-2-clause",
        "\u201cMIT license\u201d \u00e9": "mit", "\u2014gplv3\u2014": "gpl-3.0",
    }
    found = {r["doc_id"]: r for r in scan_licenses(documents(list(enumerate(texts)))).collect()}
    for k, (text, label) in enumerate(texts.items()):
        assert label in found[k]["labels"] and found[k]["score"] >= 0.5, text


def test_identifiers_expressions_and_notices(documents):
    texts = {
        "Apache-2.0": ["apache-2.0"], "BSL-1.0": ["boost-1.0"], "EPL-2.0, see NOTICE": ["epl-2.0"], "3-clause BSD license": ["bsd-3-clause"], "two-clause BSD": ["bsd-2-clause"],
        "SPDX-License-Identifier: Apache-2.0 OR MIT": ["apache-2.0", "mit"], "SPDX-License-Identifier: (MIT AND ISC OR BSD-2-Clause)": ["bsd-2-clause", "isc", "mit"],
        "Permission is hereby granted, free of charge, to any person obtaining a copy\nof this software and associated documentation files": ["mit"],
        "Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided that the following conditions are met:": ["bsd-any"],
        "redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3": ["gpl-3.0"],
        "This is free and unencumbered software released into the public domain.": ["unlicense"],
        "Mit 0 Fehlern, 2 oder mit 3": [], "one or mit": [], "the fee is hereby granted": [],
    }
    found = {r["doc_id"]: r for r in scan_licenses(documents(list(enumerate(texts)))).collect()}
    for k, (text, labels) in enumerate(texts.items()):
        own = [x for x in found[k]["labels"] if x not in found[k]["base_labels"]]
        assert own == labels and (found[k]["score"] >= 0.5) == bool(labels), text


def test_a_text_of_many_mentions(spark, documents):
    """100,000 mentions in one text: places are right, and found in seconds."""
    import time

    from pyspark.sql import functions as F

    n = 100_000
    text = "mit license word " * n
    started = time.perf_counter()
    row = scan_licenses(documents([(1, text)])).select("n_words", "n_base", "last_word", F.size("detections").alias("d"), F.element_at("detections", -1).alias("last")).first()
    assert time.perf_counter() - started < 60
    assert (row["n_words"], row["n_base"], row["last_word"]) == (3 * n, n, 3 * (n - 1))
    assert row["d"] >= n and row["last"]["first_word"] == 3 * (n - 1)
