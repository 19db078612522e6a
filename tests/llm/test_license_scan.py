"""License scans against the same rules in plain Python."""

import re
import string

import pytest

from tilewright.llm import common, license_scan
from tilewright.llm.license_rules import rules

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
RULES = [(r, re.compile(r.pattern, re.ASCII)) for r in rules()]
NOTICES = [
    "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License.",
    "SPDX-License-Identifier: GPL-3.0-or-later\nmore\nSPDX-License-Identifier:  MIT",
    "licensed under CC BY-NC 4.0 and cc by. CC, by the way, CC BY CC BY",
    "This work is licensed under the GNU General Public License, version 3. All rights reserved. all  Rights\nReserved",
    "https://creativecommons.org/licenses/by-sa/4.0/ mit license MIT License released under the MIT\nLicense",
    "Copyright (c) 2020 Someone. All rights reserved.",
    "gplv3 gplv2+ lgpl-2.1 AGPLv3 GPL reservedx all rights",
    "The MIT License. " * 200,
]


def brute(text):
    text = (text or "").translate(LOWER)
    words = WORD.findall(text)
    at, base = [], set()
    weights = []
    for phrase, (label, weight) in license_scan.PHRASES.items():
        parts = phrase.split(" ")
        hits = [i for i in range(len(words)) if words[i : i + len(parts)] == parts]
        at += hits
        if hits:
            base.add(label)
            weights.append(weight)
    found = []
    for place, (rule, pattern) in enumerate(RULES):
        if all(w in text for w in rule.keyword.split(" ")):
            found += [(m.start(), -m.end(), rule.priority, place, rule.label, rule.weight) for m in pattern.finditer(text)]
    kept = []
    for d in sorted(found):
        if not any(e[2] <= d[2] and e[1] <= d[1] for e in kept):
            kept.append(d)
    labels = base | {d[4] for d in kept}
    weights += [d[5] for d in kept]
    spans = [(d[0], -d[1], d[2], d[4]) for d in kept]
    return (len(words), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(base)), ",".join(sorted(labels)), max(weights, default=0.0)), spans


@pytest.fixture(scope="module")
def notices(spark):
    rows = [(i, t, "en") for i, t in enumerate(NOTICES)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string")


def test_against_plain_python(spark, sf, awkward, notices):
    for docs in (common.read_table(spark, sf, "documents"), awkward, notices):
        text = {r.doc_id: r.text for r in docs.collect()}
        got = license_scan.license_scan(docs).collect()
        assert len(got) == docs.count()
        for r in got:
            want, spans = brute(text[r.doc_id])
            assert (tuple(r)[1:8]) == want, r.doc_id
            assert [(d.start, d.end, d.priority, d.label) for d in r.detections] == spans
    assert license_scan.license_scan(awkward.limit(0)).count() == 0


def test_expected_labels(notices):
    labels = {r.doc_id: r.labels.split(",") for r in license_scan.license_scan(notices).collect()}
    assert "apache-2.0" in labels[0] and {"gpl-3.0-or-later", "mit"} <= set(labels[1])
    assert {"cc-by", "cc-by-nc-4.0"} <= set(labels[2]) and {"gpl", "gpl-3.0", "reserved"} <= set(labels[3])
    assert {"cc-by-sa-4.0", "mit"} <= set(labels[4]) and "agpl-3.0" in labels[6]


def test_hundreds_of_rules_and_no_python_in_the_plan(awkward):
    assert len(rules()) > 200
    plan = license_scan.license_scan(awkward)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


WRAPPED = [
    ("gpl-3.0-or-later", "it under the terms of the GNU General Public License as published by\nthe Free Software Foundation, either version 3 of the License, or\n(at your option) any later version."),
    ("gpl-2.0-or-later", "GNU General Public License\nas published by the Free Software Foundation; either version 2\nof the License, or (at your option) any later version."),
    ("bsd-3-clause", "Neither the name of the University of California, Berkeley, and its laboratories nor the names of its\n  contributors may be used to endorse or promote products derived"),
    ("bsd", 'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND\nCONTRIBUTORS "AS IS" AND ANY EXPRESS'),
    ("proprietary", "Unauthorized copying of this file,\nvia any medium is strictly prohibited"),
    ("no-derivatives", "may not be reproduced, distributed, or transmitted in any form or by any means, including photocopying, recording,\nor other electronic or mechanical methods, without the prior\nwritten permission of the publisher"),
    ("reserved", "Copyright 2020 Someone\nAll rights reserved."),
    ("gpl-3.0", "Released under GPLv3."),
    ("gpl-2.0", "It is GPL-2.0. See below."),
    ("lgpl-3.0", "under the LGPLv3."),
    ("lgpl-2.1", "under LGPL-2.1."),
    ("agpl-3.0", "under the AGPL-3.0."),
]


def test_wrapped_notices_and_names_that_end_a_sentence(spark):
    rows = [(i, t) for i, (_, t) in enumerate(WRAPPED)] + [(99, "gpl-3.1 lgpl-2.1.5 gplv2.0.1")]
    got = {r.doc_id: r for r in license_scan.license_scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, (label, text) in enumerate(WRAPPED):
        assert label in [d.label for d in got[i].detections], text
        want, spans = brute(text)
        assert tuple(got[i])[1:8] == want and [(d.start, d.end, d.priority, d.label) for d in got[i].detections] == spans
    assert set(got[99].labels.split(",")) == {"gpl", "lgpl"}
