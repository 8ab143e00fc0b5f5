"""License scan: the base phrases against a plain version, suppression."""

import re

from pyspark.sql import functions as F

from starmart.llm import licenses
from tests.llm.helpers import awkward, documents

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}


def brute(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    places = [(i, label) for phrase, label in PHRASES.items() for p in [phrase.split(" ")]
              for i in range(len(words)) if words[i:i + len(p)] == p]
    at = [i for i, _ in places]
    return (len(words), len(places), min(at, default=None), max(at, default=None),
            ",".join(sorted({label for _, label in places})))


TEXTS = ["CC-BY cc by, CC BY-SA 4.0 accby", "All rights\nreserved. all rights reserved",
         "GNU General Public License v3; general public license", "éCC by cc\x00by", "cc", "",
         None, "Licensed under the Apache License, Version 2.0.", "mit license und mit",
         "Permission is hereby granted, free of charge, to any person obtaining a copy",
         "SPDX-License-Identifier: MIT License", "all rights reserved " * 20000]


def test_base_places(spark):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + awkward()
    got = licenses.digest(licenses.scan(documents(spark, rows))).collect()
    want = sorted(((i, *brute(t)) for i, t in rows), key=str)
    assert sorted(((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels)
                   for r in got), key=str) == want
    assert all(0 <= r.score <= 1 for r in got)
    for r in got:
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(","))


def test_added_labels(spark):
    rows = [(i, t) for i, t in enumerate(TEXTS)]
    got = {r.doc_id: r for r in licenses.digest(licenses.scan(documents(spark, rows))).collect()}
    assert got[0].labels == "cc-by,cc-by-sa-4.0"
    assert got[2].labels == "gpl,gpl-3.0"
    assert got[7].labels == "apache-2.0" and got[7].score == 1.0
    assert got[9].labels == "mit" and got[10].labels == "mit"
    assert got[8].labels == "mit" and got[5].score == 0.0


def test_contained_detections_are_suppressed():
    n, found = licenses.scan_text(b"licensed under the apache license version 2 0 today")
    assert n == 9 and [(a, z, label) for a, z, label, _ in found] == [(0, 7, "apache-2.0")]
    # Overlapping without containment: both stay.
    _, found = licenses.scan_text(b"gnu lesser general public license version 2 1")
    assert [(label, p) for _, _, label, p in found] == [("lgpl-2.1", 50), ("gpl", 0)]


def test_spdx_identifiers():
    labels = lambda tag: [d[2] for d in licenses.scan_text(
        f"// SPDX-License-Identifier: {tag}\nint main".encode())[1] if d[3]]
    for entry in licenses.SPDX.split():
        name, _, label = entry.partition("=")
        assert labels(name) == [label or name.lower()], name
    assert labels("GPL-2.0-only") == ["gpl-2.0"] and labels("BSL-1.0") == ["boost-1.0"]
    assert labels("(MIT OR Apache-2.0) AND ISC") == ["mit", "apache-2.0", "isc"]
    assert labels("GPL-2.0-or-later WITH Classpath-exception-2.0") == [
        "gpl-2.0-or-later", "classpath-exception-2.0"]
    assert labels("GPL-2.0 OR MIT-0 OR LGPL-2.1-or-later") == ["gpl-2.0", "mit-0", "lgpl-2.1-or-later"]
    assert labels("LicenseRef-my-own OR EUPL-1.2") == ["spdx-tag", "eupl-1.2"]
    assert labels("nothing known") == ["spdx-tag"]


def test_rules_are_ordered_and_many():
    rules = licenses.rules()
    assert len(rules) > 200 and [r[0] for r in rules] == sorted(r[0] for r in rules)
    for _, _, keyword, rx in rules:  # the prefilter never hides a match
        assert keyword.split()[0].decode()[:3] in rx.pattern.decode().replace("(?:", "")


def test_empty_and_clashing(spark):
    docs = documents(spark, [(1, "cc by")]).withColumns(
        {c: F.lit(1) for c in ("n_words", "detections", "labels")})
    assert licenses.digest(licenses.scan(docs)).first().n_base == 1
    assert licenses.scan(docs.limit(0)).count() == 0


BODIES = {
    "Eclipse Public License - v 2.0": "epl-2.0",
    "Eclipse Public License - v 1.0": "epl-1.0",
    "THE ACCOMPANYING PROGRAM IS PROVIDED UNDER THE TERMS OF THIS ECLIPSE PUBLIC LICENSE "
    "(\"AGREEMENT\").": "epl",
    "GNU LESSER GENERAL PUBLIC LICENSE, v. 2.1": "gpl,lgpl-2.1",
    "This library is free software; you can redistribute it and/or modify it": "lgpl",
    "each Contributor that first makes Original Software available under this License.": "cddl",
    "such that the Copyright Holder maintains some semblance of artistic control over the "
    "development of the package": "artistic-1.0",
    "This license establishes the terms under which a given free software Package may be copied":
        "artistic-2.0",
    "THE WORK IS PROVIDED UNDER THE TERMS OF THIS CREATIVE COMMONS PUBLIC LICENSE": "cc",
    "conditions of this Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International "
    "Public License": "cc-by-nc-sa-4.0",
    "Permission is hereby granted, free of charge, to any person obtaining a copy of the Font "
    "Software": "ofl-1.1",
}


def test_license_bodies(spark):
    rows = list(enumerate(BODIES))
    got = {r.doc_id: r.labels for r in
           licenses.digest(licenses.scan(documents(spark, rows))).collect()}
    assert got == {i: BODIES[t] for i, t in rows}


def plain_scan(text):
    """Labels and score without gates or indexes: every rule, every pair of detections."""
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    norm = " " + " ".join(words) + " "
    found = set()
    for priority, label, _, rx in licenses.rules():
        for m in re.compile(rx.pattern.decode()).finditer(norm):
            found.add((priority, *m.span(rx.groups), label))
    found = sorted(found, key=lambda d: (d[0], d[1] - d[2], d[1], d[3]))
    kept = []
    for d in found:
        if d[0] == 0 or not any(k[0] and k[1] <= d[1] and d[2] <= k[2] for k in kept):
            kept.append(d)
    covered = set()
    for _, s, e, _ in kept:
        first = norm[:s].count(" ") - 1
        covered |= set(range(first, first + norm[s:e].count(" ") + 1))
    return (",".join(sorted({d[3] for d in kept})), len(covered) / len(words) if words else 0.0)


def test_labels_and_score_as_plain(spark):
    notices = [n for t in TEXTS + list(BODIES) if t and len(t) < 500 for n in (t, t.upper())]
    mixed = [" ".join(notices[(i * 7 + k * k) % len(notices)] for k in range(5)) for i in range(40)]
    rows = list(enumerate(notices + mixed + ["", "no license here"]))
    got = {r.doc_id: (r.labels, r.score) for r in
           licenses.digest(licenses.scan(documents(spark, rows))).collect()}
    for i, t in rows:
        labels, score = plain_scan(t)
        assert got[i][0] == labels and abs(got[i][1] - score) < 1e-12, t
