"""Licence scan: base places against brute force, priority and containment."""

import re

from martstar.llm.license_rules import BASE, BODIES, FAMILIES, JOINED, WEIGHTS, rules
from martstar.llm.license_scan import license_scan
from tests.llm.helpers import SCHEMA, awkward, table

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(t):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))


def brute(t):
    w = words(t)
    places, labels = [], set()
    for phrase, label in BASE:
        p = phrase.split()
        at = [i for i in range(len(w) - len(p) + 1) if w[i:i + len(p)] == p]
        places += at
        labels |= {label} if at else set()
    return (len(w), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels)))


TEXTS = [
    "Released under the MIT License.", "MIT license mit LICENSE mit license", "the Apache License, Version 2.0 applies",
    "GNU General Public License v3 or later", "GNU Lesser General Public License version 2.1", "cc by sa 4.0 and CC-BY 4.0",
    "submit licenses", "mit licenses", "CC-BY", "ccby", "", None, "licence", "SPDX-License-Identifier: MPL-2.0",
    "this work is licensed under the GNU Affero General Public License version 3",
    "BSD-3-Clause new bsd license", "Kmit license", "İmit license", "all rights reserved", "é mit license é",
]


def scan(spark, texts):
    return {r.doc_id: r for r in license_scan(table(spark, list(enumerate(texts)))).collect()}


def test_base_columns_are_brute_force(spark):
    texts = TEXTS + [t for _, t in awkward()]
    got = scan(spark, texts)
    for i, t in enumerate(texts):
        r = got[i]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == brute(t), t
        assert set(r.base_labels.split(",")) <= set(r.labels.split(",")) | {""}
        assert 0 <= r.score <= 1


def test_priority_and_containment(spark):
    got = scan(spark, TEXTS)
    label = lambda i: got[i].labels.split(",")
    # "general public license" lies inside the lesser and affero names, which win
    assert label(4) == ["lgpl"] and label(14) == ["agpl"]
    assert label(3) == ["gpl"] and got[3].score == 0.8 and got[3].n_found == 1
    assert label(0) == ["mit"] and got[0].score == 0.9  # the grant contains the bare name
    assert label(1) == ["mit"] and got[1].score == 1.0  # "license mit license" reads as a tag
    assert label(6) == [""] and got[7].score == 0.0
    assert label(13) == ["mpl"] and got[13].score == 1.0
    assert label(15) == ["bsd-3-clause"]
    assert label(6) == [""] and got[6].n_found == 0
    assert label(5) == ["cc-by", "cc-by-sa"]


def test_rules_are_many_and_gated():
    rs = rules()
    assert len(rs) > 300 and [r[0] for r in rs] == list(range(len(rs)))
    assert [r[1] for r in rs] == sorted(r[1] for r in rs)
    for _, _, _, kw, rx in rs:
        re.compile(rx)
        assert re.fullmatch("[a-z0-9]+", kw)
    assert len(FAMILIES) > 80 and len(BODIES) > 10


def test_every_keyword_gates_its_own_pattern():
    """No alternative of a name can match without the rule's keyword."""
    for label, kw, name, _ in FAMILIES:
        sample = re.sub(r"\(\?: ([^()]*)\)\?", "", name)  # leave optional tails out
        for alt in re.split(r"\|(?![^(]*\))", sample):
            plain = alt.replace("licen[sc]e", "license").replace(" ?", " ")
            plain = re.sub(r"\(\?:([^()|]*)[^()]*\)\??", r"\1", plain).strip()
            assert kw in re.findall("[a-z0-9]+", plain) or kw in plain, (label, kw, plain)


def test_long_text_of_licences(spark):
    r = scan(spark, ["mit license and apache license " * 2000])[0]
    assert (r.n_base, r.first_word, r.last_word, r.labels) == (4000, 0, 9998, "apache,mit")


def brute_rules(t):
    """(labels, score, surviving matches) by looking at every pair of matches."""
    w = words(t)
    line, found = f" {' '.join(w)} ", []
    for i, tier, label, kw, rx in rules():
        if kw in w:
            for m in re.finditer(f"(?<= ){rx}(?= )", line):
                at = line[:m.start()].count(" ") - 1
                found.append((at, at + m[0].count(" ") + 1, tier, i, label))
    stay = [a for a in found if not any(
        b[0] <= a[0] and a[1] <= b[1] and b[2] <= a[2] and b != a and (b[:2] != a[:2] or (b[2], b[3]) < (a[2], a[3])) for b in found)]
    base = set(brute(t)[4].split(",")) - {""}
    labels = base | {a[4] for a in stay}
    score = WEIGHTS[min(a[2] for a in stay)] if stay else WEIGHTS[-1] if base else 0.0
    return ",".join(sorted(labels)), score, len(stay)


def test_labels_and_scores_are_brute_force(spark):
    import random

    r = random.Random(8)
    bits = ["mit license", "Apache-2.0", "GPLv3", "or later", "licensed under the", "BSD 3-Clause", "version 2", "lesser general public license",
            "cc by sa 4.0", "SPDX-License-Identifier:", "and", "Mozilla Public License", "LGPLv2.1", "all rights reserved", "apache2"]
    texts = TEXTS + [body for _, _, body in BODIES] + [" ".join(r.choice(bits) for _ in range(r.randint(1, 8))) for _ in range(120)]
    got = scan(spark, texts)
    for i, t in enumerate(texts):
        assert (got[i].labels, got[i].score, got[i].n_found) == brute_rules(t), t


def test_joined_spellings(spark):
    cases = {"GPLv3": "gpl", "Apache2 LGPLv2.1": "apache,lgpl", "AGPLv3 only": "agpl", "CC-BY4": "cc-by", "licensed under GPLv2 or later": "gpl",
             "MPLv2.0, BSD3": "bsd-3-clause,mpl", "gplv33": "", "ApacheV2": "apache"}
    got = scan(spark, list(cases))
    assert {t: got[i].labels for i, t in enumerate(cases)} == cases
    assert got[4].score == WEIGHTS[1] and got[0].score == WEIGHTS[2]
    for _, kw, rx in JOINED:
        assert kw in rx and re.fullmatch("[a-z0-9]+", kw)


def test_many_matches_take_linear_time(spark):
    import time

    times = []
    for n in (10_000, 40_000):
        d = table(spark, [(1, "mit license, " * n)])
        t0 = time.perf_counter()
        r = license_scan(d).first()
        times.append(time.perf_counter() - t0)
        assert (r.n_base, r.last_word, r.n_found) == (n, 2 * n - 2, n)
    assert times[1] < 20


def test_empty(spark):
    assert license_scan(spark.createDataFrame([], SCHEMA)).count() == 0
