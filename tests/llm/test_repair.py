import hashlib
import random
import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from rulspark.llm import repair as r


def slow_runs(words):
    """Every maximal run, from the definition."""
    n, found = len(words), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(6, 4 * q):
                found.setdefault((i, j + q - i), q)
            i = j
    return sorted((s, length, q) for (s, length), q in found.items())


def repetitive(rng, size):
    out, letters = [], rng.choice([1, 2, 3, 9, 40])
    while len(out) < size:
        root = [rng.randrange(letters) for _ in range(rng.choice([1, 1, 2, 3, 5, 8, 13, 30]))]
        out += root * rng.randrange(1, 8) + root[: rng.randrange(len(root) + 1)]
        if rng.random() < 0.1:
            out += out[-rng.randrange(1, 60) :]
    return out


def found_in(texts):
    bounds = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    return r.runs(np.array([x for t in texts for x in t], np.int64), bounds)


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 10**6))
def test_runs_are_those_of_the_definition(seed):
    rng = random.Random(seed)
    texts = [repetitive(rng, rng.choice([3, 20, 90, 300])) for _ in range(8)] + [[]]
    assert found_in(texts) == [sorted(slow_runs(t), key=lambda x: (x[0], x[2])) for t in texts]
    assert [[(a, b - a, q) for a, b, q in r._scan(np.array(t, np.int64))] for t in texts] == [slow_runs(t) for t in texts]


def test_periods_are_tried_in_parts(monkeypatch):
    monkeypatch.setattr(r, "AT_ONCE", 7)
    rng = random.Random(3)
    texts = [repetitive(rng, 120) for _ in range(4)]
    assert found_in(texts) == [slow_runs(t) for t in texts]


def test_words_whose_hashes_collide_do_not_make_runs():
    """Two halves of the sequence below agree in every polynomial hash of 64 bits."""
    thue = [bin(i).count("1") % 2 for i in range(1 << 13)]
    assert found_in([thue]) == [slow_runs(thue)]


def test_grammar_derives_the_text():
    rng = random.Random(5)
    text = repetitive(rng, 500)
    found = r.grammar(np.array(text), np.zeros(len(text), np.int64))
    by_symbol = {}
    for symbol, start, middle, end in zip(*[x.tolist() for x in (found.symbol, found.start, found.middle, found.end)]):
        derived = (tuple(text[start:end]), middle - start)
        assert by_symbol.setdefault(symbol, derived) == derived and start < middle < end
    assert (0, len(text)) in zip(found.start.tolist(), found.end.tolist())


def test_equal_pairs_that_overlap_are_taken_from_the_left():
    assert r._pairs_taken(np.array([2, 2, 2, -1, 5, 3, 3, 1])).tolist() == [0, 2, 4]
    assert r._pairs_taken(np.array([-1, -1])).tolist() == []


def slow_row(doc, text):
    words = (text or "").encode().split()
    h, n = zlib.crc32(str(doc).encode()), len(words)
    if doc is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    found = sorted(slow_runs(words), key=lambda x: (x[0], x[2]))
    dropped = {i for s, length, q in found for i in range(s + q, s + length)}
    best = (None, None, None)
    for s, length, q in found:
        if best[0] is None or length * best[2] > best[1] * q:
            best = (s, length, q)
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in found)
    rest = b" ".join(w for i, w in enumerate(words) if i not in dropped)
    milli = None if best[0] is None else 1000 * best[1] // best[2]
    return (doc, len(found), *best, milli, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(rest).hexdigest())


def test_query(spark, sf_dir, texts):
    rows = [tuple(x) for x in r.op12_repair_runs(spark, sf_dir).collect()]
    assert sorted(rows) == sorted(slow_row(d, t) for d, t in texts.items())
    assert any(x[1] for x in rows)


def test_awkward_rows(spark, awkward, no_docs):
    rows = r.runs_and_text(awkward).collect()
    assert len(rows) == awkward.count()
    by_id = {x.doc_id: x for x in rows}
    for empty in (1, 2, 3):
        assert by_id[empty].runs == [] and by_id[empty].collapsed == ""
    assert [tuple(x) for x in by_id[5].runs] == [(0, 16000, 4)] and by_id[5].collapsed == "word and another one,"
    assert by_id[None].collapsed == "No id has this row."
    assert r.runs_and_text(no_docs).count() == 0
