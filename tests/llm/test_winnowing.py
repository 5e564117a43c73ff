import hashlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from rulspark.llm import winnowing as w


def brute(text, k, window):
    hashes = w.gram_hashes(w.codes_of(text), k).tolist()
    out = []
    for i in range(max(1, len(hashes) - window + 1)) if hashes else []:
        part = hashes[i : i + window]
        at = max(j for j, h in enumerate(part) if h == min(part)) + i
        if not out or out[-1] != (hashes[at], at):
            out.append((hashes[at], at))
    return out


@settings(max_examples=80, deadline=None)
@given(st.text(alphabet="ab é", max_size=120), st.integers(1, 9), st.integers(1, 12))
def test_kept_hashes_are_window_minima(text, k, window):
    hashes, positions = w.winnow(w.codes_of(text), k, window)
    assert list(zip(hashes.tolist(), positions.tolist())) == brute(text, k, window)


@settings(max_examples=40, deadline=None)
@given(st.text(alphabet="abcd", max_size=60), st.text(alphabet="abcd", max_size=60), st.text(alphabet="abcdefgh", min_size=23, max_size=40))
def test_a_shared_run_is_found(before, after, run):
    k, window = 8, 16
    a, b = w.Fingerprint(before + run, k, window), w.Fingerprint(run + after, k, window)
    assert a.kinds & b.kinds


def test_rolling_hash_depends_on_the_gram_alone():
    codes = w.codes_of("abcabcabc")
    for k in (1, 2, 3, 5, 7):
        hashes = w.gram_hashes(codes, k)
        assert len(hashes) == len(codes) - k + 1
        for i in range(len(hashes) - 3):
            assert hashes[i] == hashes[i + 3]


def test_query_against_brute_force(spark, sf_dir, texts):
    rows = {r.doc_id: r for r in w.op1_winnowing(spark, sf_dir).collect()}
    ids = sorted(texts, reverse=True)
    assert sorted(rows) == sorted(texts)
    for i, doc in enumerate(ids):
        own, following = texts[doc], texts[ids[(i + 1) % len(ids)]]
        changed = w.edited(own, following)
        row = rows[doc]
        assert row.n_chars == len(own)
        assert row.edited_sha256 == hashlib.sha256(changed.encode()).hexdigest()
        sets = [{h for h, _ in brute(t, w.K, w.WINDOW)} for t in (own, changed, following)]
        assert np.isclose(row.near_edited, len(sets[0] & sets[1]) / len(sets[0] | sets[1]))
        assert np.isclose(row.near_next, len(sets[0] & sets[2]) / len(sets[0] | sets[2]))


def test_awkward_rows(spark, awkward, no_docs):
    rows = w.against_next(awkward).collect()
    assert len(rows) == awkward.count()
    by_id = {r.doc_id: r for r in rows}
    assert by_id[1].n_chars == by_id[2].n_chars == 0
    assert by_id[1].fingerprint == by_id[2].fingerprint
    assert by_id[6].fingerprint == by_id[7].fingerprint and by_id[7].near_next == 1.0
    assert by_id[2].near_next == 1.0  # followed by the null text of document 1
    # After the last row, one without an id, comes the first: document 10, "One id".
    last = [r for r in rows if r.doc_id is None]
    text = "No id has this row."
    found = {r.edited_sha256 for r in last}
    assert found == {hashlib.sha256(w.edited(text, t).encode()).hexdigest() for t in (text, "One id")}
    assert w.against_next(no_docs).count() == 0
    assert w.fingerprints(awkward).count() == awkward.count()


def test_one_row_follows_itself(spark):
    df = spark.createDataFrame([(1, "abcdef")], "doc_id long, text string")
    row = w.against_next(df).first()
    assert row.near_next == 1.0 and row.edited_sha256 == hashlib.sha256(b"abcdab").hexdigest()
