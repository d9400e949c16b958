import re

import pytest

from wardline.llm import licenses

PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}


def base(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    places = []
    for phrase, label in PHRASES.items():
        p = phrase.split()
        places += [(k, label) for k in range(len(words)) if words[k : k + len(p)] == p]
    at = [k for k, _ in places]
    return len(words), len(at), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in places}))


TEXTS = [
    "MIT License", "the mit-license, (MIT LICENSE) mit license mit license", "smit license", "mit  licenses",
    "Licensed under CC BY-NC 4.0.", "cc by cc by", "GNU General Public License, version 3", "apache licenseé", "Ämit license",
    "Apache License, Version 2.0\nSPDX-License-Identifier: MIT OR GPL-2.0-only WITH Classpath-exception-2.0", "\x00cc\x7fby\x1f",
    "All rights reserved.", "mit", "license mit license",
]


def test_documents_match_brute_force(make_docs, odd_rows, clash):
    rows = [(100 + i, t) for i, t in enumerate(TEXTS)] + odd_rows + [(99, "cc by, " * 20_000)]
    got = licenses.scan(clash(make_docs(rows))).collect()
    assert len(got) == len(rows)
    want = sorted(((d, *base(t)) for d, t in rows), key=repr)
    assert sorted(((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in got), key=repr) == want
    by = {r.doc_id: r for r in got}
    for r in got:
        labels = r.labels.split(",") if r.labels else []
        assert labels == sorted(set(labels)) and set(filter(None, r.base_labels.split(","))) <= set(labels)
        assert 0 <= r.score <= 1 and (r.score == 0 or labels)
    assert by[104].labels == "cc-by,cc-by-nc" and by[104].score == 0.1
    assert by[109].labels == "apache,apache-2.0,gpl-2.0-only,mit" and by[109].score == 1.0
    assert licenses.scan(make_docs([])).collect() == []


@pytest.mark.parametrize(
    "expression, labels, value",
    [
        ("MIT", ["mit"], 1.0),
        ("MIT AND GPL-3.0", ["mit", "gpl-3.0"], 0.3),
        ("MIT OR GPL-3.0 AND AGPL-3.0", ["mit", "gpl-3.0", "agpl-3.0"], 1.0),
        ("(MIT OR GPL-3.0) AND AGPL-3.0", ["mit", "gpl-3.0", "agpl-3.0"], 0.2),
        ("GPL-2.0 WITH Classpath-exception-2.0", ["gpl-2.0"], 0.5),
        ("GPL-2.0 WITH x AND MIT", ["gpl-2.0", "mit"], 0.5),
        ("gpl-2.0+", ["gpl-2.0+"], 0.3),
        ("Something-Else", ["something-else"], 0.5),
        ("MIT OR", ["mit"], 0.0),
        ("OR MIT", [], 0.0),
        ("(MIT", ["mit"], 0.0),
        ("MIT) OR GPL", ["mit"], 1.0),
        ("MIT and more words", ["mit", "more"], 0.5),
        ("", [], 0.0),
        ("()", [], 0.0),
    ],
)
def test_expressions(expression, labels, value):
    assert licenses.evaluate(expression) == (labels, pytest.approx(value))


def test_many_phrases_cost_no_more_than_a_long_text():
    import time

    text = "mit license, " * 300_000
    start = time.time()
    found = licenses.judge_text(text, licenses._automaton(), licenses.word_table())
    assert found[:4] == (600_000, 300_000, 0, 599_998) and time.time() - start < 20
