"""Licence scan: one Aho-Corasick automaton finds identifier tags and notice phrases in the words
of a text, and a shunting-yard parser evaluates the and / or / with expression behind each tag.

Words are runs of ASCII letters and digits (A-Z lower-cased) and of any non-ASCII characters. A
phrase is found where its words stand consecutively. Base phrases carry base labels; further
phrases and the identifiers of tag expressions add labels.

Each licence has a degree of freedom from 0 to 1 (table below, 0.5 if unknown). An expression is
worth the larger side of `or`, the smaller side of `and`, and an exception (`with`) adds 0.2, up to
1. A document is worth the least of its tags and phrases, and 0 where nothing is found. A malformed
expression is worth 0; its identifiers still count as labels. Null text counts as empty.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bound_batches, pick

# Base phrases and their labels.
BASE_PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
# Further notices and their labels.
NOTICES = {
    "gnu general public license version 2": "gpl-2.0",
    "gnu general public license version 3": "gpl-3.0",
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "apache license version 2 0": "apache-2.0",
    "mozilla public license": "mpl",
    "bsd license": "bsd",
    "cc by nc": "cc-by-nc",
    "cc by nd": "cc-by-nd",
    "cc by sa": "cc-by-sa",
    "creative commons zero": "cc0",
    "all rights reserved": "reserved",
}
TAG = "spdx license identifier"
# Degree of freedom by licence family; the longest name that starts the label counts.
FREEDOM = {
    "mit": 1.0, "bsd": 1.0, "isc": 1.0, "apache": 1.0, "cc0": 1.0, "unlicense": 1.0, "zlib": 1.0,
    "cc-by": 0.9, "mpl": 0.7, "epl": 0.7, "lgpl": 0.6, "cc-by-sa": 0.5, "gpl": 0.3, "agpl": 0.2,
    "cc-by-nd": 0.1, "cc-by-nc": 0.1, "proprietary": 0.0, "reserved": 0.0,
}
UNKNOWN = 0.5
EXCEPTION = 0.2
TAG_TEXT = re.compile(r"(?i)spdx-license-identifier[ \t]*:[ \t]*([^\r\n]*)")
TOKEN = re.compile(r"[()]|[A-Za-z0-9][A-Za-z0-9.+:-]*")
STRENGTH = {"or": 1, "and": 2, "with": 3}

RESULT = (
    "doc_id long, n_words long, n_base long, first_word long, last_word long,"
    " base_labels string, labels string, score double"
)


def freedom(label: str) -> float:
    names = [n for n in FREEDOM if label == n or label.startswith((n + "-", n + "+"))]
    return FREEDOM[max(names, key=len)] if names else UNKNOWN


def evaluate(expression: str) -> tuple[list[str], float]:
    """(identifiers, degree of freedom) of a licence expression, by a shunting yard: `with` binds
    closest, then `and`, then `or`; text after the expression's end is not read."""
    values: list[float] = []
    waiting: list[str] = []
    labels: list[str] = []

    def apply():
        sign = waiting.pop()
        right, left = values.pop(), values.pop()
        if sign == "with":
            values.append(min(1.0, left + EXCEPTION))
        else:
            values.append(max(left, right) if sign == "or" else min(left, right))

    operand_next = True
    try:
        for token in TOKEN.findall(expression):
            word = token.lower()
            if word == "(":
                if not operand_next:
                    break
                waiting.append(word)
            elif word == ")":
                if operand_next or "(" not in waiting:
                    break
                while waiting[-1] != "(":
                    apply()
                waiting.pop()
            elif word in STRENGTH:
                if operand_next:
                    return labels, 0.0
                while waiting and waiting[-1] != "(" and STRENGTH[waiting[-1]] >= STRENGTH[word]:
                    apply()
                waiting.append(word)
                operand_next = True
            else:
                if not operand_next:
                    break
                word = word.rstrip(".:")
                if not (waiting and waiting[-1] == "with"):
                    labels.append(word)
                values.append(freedom(word))
                operand_next = False
        while waiting:
            if waiting[-1] == "(":
                return labels, 0.0
            apply()
    except IndexError:
        return labels, 0.0
    return labels, values[0] if len(values) == 1 else 0.0


def _automaton():
    import ahocorasick

    found = ahocorasick.Automaton()
    every = {**NOTICES, **BASE_PHRASES, TAG: ""}
    for phrase in every:
        found.add_word(f" {phrase} ", phrase)
    found.make_automaton()
    return found


def word_table():
    """Byte table: A-Z to lower case, other ASCII that is no letter or digit to a space."""
    table = bytearray(range(256))
    for code in range(128):
        sign = chr(code)
        if not sign.isalnum():
            table[code] = 32
        elif sign.isupper():
            table[code] = ord(sign.lower())
    return bytes(table)


def judge_text(text, automaton, table):
    """(n_words, n_base, first word, last word, base labels, labels, score) of one text."""
    words = text.encode("utf-8", "replace").translate(table).split()
    flat = f" {b' '.join(words).decode('utf-8')} "
    base, labels, starts, worth, tagged = set(), set(), [], [], False
    for end, phrase in automaton.iter(flat):
        if phrase == TAG:
            tagged = True
        elif phrase in BASE_PHRASES:
            base.add(BASE_PHRASES[phrase])
            starts.append(end - len(phrase))
        else:
            labels.add(NOTICES[phrase])
    # A more exact label says how free the text is, not the family it belongs to.
    exact = labels | {b for b in base if not any(x.startswith(b + "-") for x in labels)}
    worth += [freedom(x) for x in exact]
    if tagged:
        for expression in TAG_TEXT.findall(text):
            names, value = evaluate(expression)
            labels.update(names)
            worth.append(value)
    every = sorted(labels | base)
    # Words before a place: the spaces before it, less the one at the front.
    first, last = (flat.count(" ", 0, f(starts)) - 1 if starts else None for f in (min, max))
    return (
        len(words), len(starts), first, last,
        ",".join(sorted(base)), ",".join(every), min(worth, default=0.0),
    )


def scan(docs: DataFrame) -> DataFrame:
    """RESULT for documents (doc_id, text). Whole texts, one pass, no shuffle."""
    bound_batches(docs.sparkSession)
    plain = pick(docs, "doc_id", "text").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))

    def judged(batches):
        import pyarrow as pa

        automaton, table = _automaton(), word_table()
        names = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
        kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64()]
        for batch in batches:
            rows = [judge_text(t, automaton, table) for t in batch.column("text").to_pylist()]
            columns = list(zip(*rows, strict=True)) or [[]] * len(names)
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *arrays], ["doc_id", *names])

    return plain.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(judged, RESULT)
