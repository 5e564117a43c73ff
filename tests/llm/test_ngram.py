import math
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from rulspark.llm import ngram as g
from rulspark.llm import trie as t
from rulspark.llm import words as w


def flat(texts):
    raw = [x.encode() for x in texts]
    return np.frombuffer(b"".join(raw), np.uint8), np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text(alphabet="aB \n\té\x0b", max_size=12), min_size=1, max_size=6))
def test_words_are_those_of_the_bytes(texts):
    data, bounds = flat(texts)
    got = w.words_of(data, bounds)
    want = [(i, x) for i, s in enumerate(texts) for x in s.encode().lower().split()]
    found = [(int(i), bytes(data[a:b]).lower()) for i, a, b in zip(got.text, got.starts, got.ends)]
    assert found == want
    by_hash = {}
    for h, (_, x) in zip(got.hashes.tolist(), want):
        assert by_hash.setdefault(x, h) == h
    assert len(set(by_hash.values())) == len(by_hash)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 1 << 40), max_size=300), st.lists(st.integers(0, 1 << 41), min_size=1, max_size=50))
def test_elias_fano_finds_values_and_successors(values, keys):
    values = np.sort(np.array(values, np.uint64))
    n, bits, low, high, ones = t.EliasFano.parts(values)
    coded = t.EliasFano(n, bits, low, high, ones)
    if n:
        np.testing.assert_array_equal(coded.get(np.arange(n)), values)
    keys = np.array([*keys, *values.tolist()[:20]], np.uint64)
    at, equal = coded.successor(keys, np.zeros(len(keys), np.int64), np.full(len(keys), n))
    np.testing.assert_array_equal(at, np.searchsorted(values, keys))
    np.testing.assert_array_equal(equal, np.isin(keys, values))


def test_trie_from_a_file_map(tmp_path):
    import mmap

    rng = np.random.default_rng(1)
    words = np.unique(rng.integers(3, 1 << 63, 500).astype(np.uint64))
    pairs = sorted({(int(a), int(b)) for a, b in zip(rng.integers(0, len(words), 4000), rng.integers(0, 1 << 32, 4000)) if a % 3})
    owners, contexts = np.array([p[0] for p in pairs]), np.array([p[1] for p in pairs], np.uint32)
    logs, pair_logs = -rng.random(len(words)) * 9, -rng.random(len(pairs)) * 9
    raw = t.Trie.build(words, np.arange(len(words)), logs, owners, contexts, pair_logs)
    # Smaller than the plain arrays it stands for.
    assert len(raw) < len(words) * (8 + 8 + 8 + 8) + len(pairs) * (4 + 8)
    (tmp_path / "trie").write_bytes(raw)
    with open(tmp_path / "trie", "rb") as f:
        trie = t.Trie(mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ))
        at = trie.find_words(np.concatenate([words, words + np.uint64(1)]))
        known = set(words.tolist())
        assert at.tolist() == [*range(len(words)), *[-1 if x + 1 not in known else words.tolist().index(x + 1) for x in words.tolist()]]
        np.testing.assert_array_equal(trie.find_pairs(owners, contexts), np.arange(len(pairs)))
        other = trie.find_pairs(owners, contexts ^ np.uint32(1))
        have = set(pairs)
        assert [(o, int(c)) in have for o, c in zip(owners.tolist(), contexts ^ np.uint32(1))] == (other >= 0).tolist()
        np.testing.assert_allclose(t.restored(trie.pair_logs), pair_logs, atol=1 / t.STEPS)


def brute(rows):
    """Counts by dictionaries; the model's formula without hashes, shards or quantised steps."""
    texts = [(d, x or "") for d, x in rows]
    held = {d: zlib.crc32(str(d).encode()) % 7 == 2 for d, _ in texts}
    tokens = [(d, [*(v.decode() for v in x.encode().lower().split()), None]) for d, x in texts]
    learned = [v for d, v in tokens if d is not None and not held[d]]
    count = Counter(x for v in learned for x in v)
    pairs = Counter(p for v in learned for p in zip(["<s>", *v], v))
    total, distinct = sum(count.values()), len(count)
    heavy = {x for x, n in count.items() if n * g.HEAVY >= total} | {None, "<s>"}

    def context(u):
        return len(learned) if u == "<s>" else count[u]

    def mass(u):
        return g.PRIOR + (g.SHARE * context(u) if u in heavy else 0)

    out = []
    for d, v in tokens:
        p1 = [(count[x] + 1) / (total + distinct + 1) for x in v]
        score = sum(
            math.log10((pairs[(u, x)] + mass(u) * p) / (context(u) + mass(u))) for u, x, p in zip(["<s>", *v], v, p1)
        )
        out.append((d, held[d] and d is not None, len(v), sum(count[x] > 0 for x in v), total, sum(map(math.log10, p1)), score))
    return out


def compare(got, rows):
    want = sorted(brute(rows), key=repr)
    found = sorted((tuple(r) for r in got.collect()), key=repr)
    assert len(found) == len(want)
    for a, b in zip(sorted(found, key=lambda r: (repr(r[0]), r[2], r[5])), sorted(want, key=lambda r: (repr(r[0]), r[2], r[5]))):
        assert a[:5] == b[:5]
        assert a[5] == pytest.approx(b[5], rel=1e-9)
        assert a[6] == pytest.approx(b[6], abs=a[2] / t.STEPS + 1e-9)


def test_query_against_counting(spark, sf_dir, texts):
    got = g.op3_elias_fano_lm(spark, sf_dir)
    compare(got, list(texts.items()))
    held = [r for r in got.collect() if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


@pytest.mark.parametrize("shards", [1, 5])
def test_awkward_rows(spark, awkward, shards):
    rows = [(r.doc_id, r.text) for r in awkward.select("doc_id", "text").collect()]
    compare(g.score_texts(awkward, shards), rows)


def test_no_rows(spark, no_docs):
    assert g.score_texts(no_docs, 3).count() == 0
