import zlib
from collections import defaultdict

import numpy as np
import pytest

from wardline.llm import packing
from wardline.llm.queries import END_ID, load_tokenizer

WINDOW = 64


def checked(frame, rows, **options):
    """Packs, checks every piece against the tokenizer itself, and returns the pieces."""
    pieces = packing.pack(frame, load_tokenizer, END_ID, WINDOW, width="<u2", **options).collect()
    tokenizer = load_tokenizer()
    want = defaultdict(list)
    for row in rows:
        ids = tokenizer.encode(row[1] or "", add_special_tokens=False).ids + [END_ID]
        want[row[0]].append(ids)
    got = defaultdict(list)
    for p in pieces:
        got[p.doc_id].append(p)
    assert set(got) == set(want)
    for doc, texts in want.items():
        if len(texts) > 1:  # repeated rows: their pieces together
            assert sum(p.length for p in got[doc]) == sum(map(len, texts))
            continue
        at = 0
        for p in sorted(got[doc], key=lambda p: p.start):
            part = np.array(texts[0][at : at + p.length], "<u4")
            assert (p.start, p.doc_tokens, p.ids_crc32) == (at, len(texts[0]), zlib.crc32(part.tobytes()))
            at += p.length
        assert at == len(texts[0])
    sequences = defaultdict(list)
    for p in pieces:
        sequences[p.sequence_id].append(p)
    assert sorted(sequences) == list(range(len(sequences)))
    for number, own in sequences.items():
        at = 0
        for p in sorted(own, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at == WINDOW or at & (at - 1) == 0
    return pieces


def test_every_token_once_and_windows_hold_the_mixture(make_docs):
    rows = [(i, f"some text number {i} " * (i % 9 + 1), f"src{i % 3 if i % 2 else 0}") for i in range(120)]
    pieces = checked(make_docs(rows).repartition(5), rows)
    total = defaultdict(int)
    for p in pieces:
        total[p.source] += p.length
    n = sum(total.values())
    given = defaultdict(int)
    for number in range(n // WINDOW):
        for p in pieces:
            if p.sequence_id == number:
                given[p.source] += p.length
        for source, all_of_it in total.items():  # deficits never reach a token for each queue
            assert abs(given[source] - (number + 1) * WINDOW * all_of_it / n) < len(total)


def test_weights_hold_until_a_queue_runs_dry(make_docs):
    rows = [(i, "word " * 50, "a" if i % 2 else "b") for i in range(40)]
    pieces = checked(make_docs(rows), rows, weights={"a": 3, "b": 1})
    first = [p for p in pieces if p.sequence_id < 10]
    assert abs(sum(p.length for p in first if p.source == "a") - 10 * WINDOW * 0.75) < 2


def test_odd_rows(make_docs, odd_rows, clash, spark):
    rows = [(*r, None if n % 3 else f"s{n}") for n, r in enumerate(odd_rows) if r[0] not in (4, 5, 7)]
    checked(clash(make_docs(rows)), rows)
    assert packing.pack(make_docs([]), load_tokenizer, END_ID).collect() == []


def test_very_long_text(make_docs, odd_rows):
    rows = [r for r in odd_rows if r[0] == 7] + [(4, "word, " * 20_000)]
    checked(make_docs(rows), rows)


@pytest.mark.parametrize("sent", [100_000, 0])
def test_any_number_of_sources_keeps_names_and_shares(make_docs, monkeypatch, sent):
    """A tree of several levels, sent whole or by path; each source keeps its share in every window."""
    monkeypatch.setattr(packing, "FAN", 4)
    monkeypatch.setattr(packing, "SENT_SOURCES", sent)
    rows = [(i, "text " * (1 + i % 7), None if i % 50 == 0 else f"src{i % 50}") for i in range(300)]
    pieces = checked(make_docs(rows).repartition(3), rows)
    total = defaultdict(int)
    for p in pieces:
        total[p.source] += p.length
    assert len(total) == 50
    n, given = sum(total.values()), defaultdict(int)
    for number in range(n // WINDOW):
        for p in pieces:
            given[p.source] += p.length if p.sequence_id == number else 0
        for source, own in total.items():
            assert abs(given[source] - (number + 1) * WINDOW * own / n) < 4
    weighted = packing.pack(make_docs(rows), load_tokenizer, END_ID, WINDOW, weights={"src7": 9}, width="<u2").collect()
    first = [p for p in weighted if p.sequence_id < 2]
    # 49 others have the weight 1.
    assert abs(sum(p.length for p in first if p.source == "src7") - min(2 * WINDOW * 9 / 58, total["src7"])) < 4


def test_both_ways_of_sending_the_tree_give_the_same_pieces(make_docs, monkeypatch):
    monkeypatch.setattr(packing, "FAN", 3)
    rows = [(i, f"text {i} " * (i % 5), f"src{i % 20}") for i in range(100)]
    found = []
    for sent in (100_000, 0):
        monkeypatch.setattr(packing, "SENT_SOURCES", sent)
        frame = make_docs(rows).repartition(2, "doc_id")
        found.append(sorted(map(tuple, packing.pack(frame, load_tokenizer, END_ID, WINDOW, width="<u2").collect())))
    assert found[0] == found[1]


def test_a_rare_source_costs_its_own_length():
    """One document, alone in its source, among a thousand sources and ten million windows."""
    import time

    totals = [40_000_000] * 1000 + [20_000]
    tree, sequences = packing.whole_tree(totals, totals), packing.Sequences(sum(totals), 4096)
    start, seen = time.time(), 0
    for held in packing._windows_of(np, tree, sequences, 1000, 0, 20_000):
        taken, _ = tree.taken(1000, sequences.first_token(held))
        after, _ = tree.taken(1000, sequences.first_token(held + 1))
        assert (after > taken).all()
        seen += int((after - taken).sum())
    assert seen == 20_000 and time.time() - start < 30


def test_ids_of_odd_texts():
    import pyarrow as pa

    texts = [
        "don't it's WE'RE", "a—!! b́e É İI Σας ΣΑΣ", "x\x1cy \x85 a b　c", "", "   ", None,
        "<|startoftext|> <|STARTOFTEXT|>x", "é" * 700, "ab1234.56,,7$$ A_b __", "日本語 text۱۲", "K K ſ ẞ ß",
    ]
    words, tokenizer = packing.WordTokenizer(load_tokenizer, "<u4"), load_tokenizer()
    for _ in range(2):  # new pieces, then remembered ones
        flat, at = words.ids(pa.array(texts))
        for i, text in enumerate(texts):
            assert flat[at[i] : at[i + 1]].tolist() == tokenizer.encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("seed", range(40))
def test_schedule_is_the_order_of_due_tokens(seed):
    rng = np.random.default_rng(seed)
    totals = [int(x) for x in rng.integers(1, 300, rng.integers(1, 12))]
    weights = totals if seed % 3 == 0 else rng.uniform(0.1, 5, len(totals)).tolist()
    node = packing.Node(totals, weights)
    order = sorted(((t + 0.5) / weights[q], q, t) for q in range(len(totals)) for t in range(totals[q]))
    taken, counts, ranks = [np.zeros(len(totals), int)], np.zeros(len(totals), int), {}
    for rank, (_, q, t) in enumerate(order):
        counts[q] += 1
        ranks[q, t] = rank
        taken.append(counts.copy())
    wanted = np.arange(0, sum(totals) + 1, 7)
    assert (node.taken_at(wanted) == np.array(taken)[wanted]).all()
    for q, n in enumerate(totals):
        assert node.rank(q, np.arange(n)).tolist() == [ranks[q, t] for t in range(n)]
    sequences = packing.Sequences(sum(totals), WINDOW)
    starts = sequences.first_token(np.arange(sequences.count + 1))
    assert starts[-1] == sum(totals)
    assert (sequences.sequence_of(starts[:-1]) == np.arange(sequences.count)).all()
    assert (sequences.sequence_of(starts[1:] - 1) == np.arange(sequences.count)).all()
