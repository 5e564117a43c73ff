"""Language models of byte counts against brute force, and what the pipeline drops by them."""

import zlib
from collections import Counter
from math import ceil, log2

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import corpus_pipeline as c
from rulspark.llm import bytecounts, langid
from rulspark.llm.arrow import filled, flat
from rulspark.llm.shared import fold

SCHEMA = "doc_id long, text string, lang string"


def arrow(texts):
    return filled(pa.array(texts, pa.large_string()))


def triples(text):
    raw = b"  " + text.encode().lower()
    return [raw[i : i + 3] for i in range(len(raw) - 2)]


def bits(text, learned):
    """Bits per byte by counts of triples in dictionaries."""
    seen = [t for x in learned for t in triples(x)]
    three, before = Counter(seen), Counter(t[:2] for t in seen)
    two, one, last = Counter(t[1:] for t in seen), Counter(t[1:2] for t in seen), Counter(t[2:] for t in seen)
    total, prior = 0.0, bytecounts.PRIOR
    for t in triples(text):
        p = (last[t[2:]] + 1) / (len(seen) + 256)
        p = (two[t[1:]] + prior * p) / (one[t[1:2]] + prior)
        total -= log2((three[t] + prior * p) / (before[t[:2]] + prior))
    return total / max(len(text.encode()), 1)


def counts(**texts):
    found = {lang: bytecounts.counted(*flat(arrow(own))) for lang, own in sorted(texts.items())}
    keys = {lang: np.flatnonzero(n) for lang, n in found.items()}
    return bytecounts.Counts(tuple(found), tuple(keys.values()), tuple(found[k][v] for k, v in keys.items()))


TEXTS = st.lists(st.text(alphabet="abX é", max_size=30), min_size=1, max_size=6)


@settings(max_examples=60, deadline=None)
@given(TEXTS, TEXTS, TEXTS, st.integers(2, 40))
def test_costs_are_those_of_plain_counts_in_pieces_of_any_size(texts, one, two, size):
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(bytecounts, "SLICE_BYTES", size)
        got = bytecounts.Model(counts(a=one, b=two)).cost(*flat(arrow(texts)))
    np.testing.assert_allclose(got, [[bits(t, one), bits(t, two)] for t in texts], rtol=1e-4, atol=1e-4)


def test_every_labelled_row_is_counted(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").repartition(7)
    learned = bytecounts.learned(langid.learning_rows(docs))
    want: dict[str, list[str]] = {}
    for r in docs.collect():
        if zlib.crc32(str(r.doc_id).encode()) % 4 != 2 and r.lang and r.text:
            want.setdefault(r.lang, []).append(r.text)
    whole = counts(**want)
    assert learned.langs == whole.langs
    for j in range(len(whole.langs)):
        order = np.argsort(learned.keys[j])
        assert (learned.keys[j][order] == whole.keys[j]).all() and (learned.counts[j][order] == whole.counts[j]).all()


def test_more_languages_than_a_task_counts_at_once(spark):
    n = 2 * bytecounts.AT_ONCE + 3
    rows = [(i, f"text of {i % n}", f"l{i % n:03}") for i in range(3 * n)]
    rows += [(None, "no id", "l000"), (9000, "no label", None), (9001, None, "l000"), (9002, "12", "none")]
    learned = bytecounts.learned(spark.createDataFrame(rows, SCHEMA).coalesce(1))
    assert learned.langs == tuple(f"l{i:03}" for i in range(n))
    for j, own in enumerate(learned.counts):
        assert own[learned.keys[j] < bytecounts.PAIRS].sum() == 3 * len(f"text of {j}")


def test_languages_are_told_apart(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    learned = bytecounts.learned(langid.learning_rows(docs))
    rows = bytecounts.identify(docs, learned, ["doc_id", "lang"]).where(fold(F.col("doc_id"), 4) == 2).collect()
    assert rows and sum(r.lang == r.lang_pred for r in rows) / len(rows) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "½ 12"), (4, "the one")], "doc_id long, text string")
    assert [r.lang_pred for r in sorted(bytecounts.identify(odd, learned).collect())][:3] == ["und"] * 3


def test_what_is_ordinary_is_told_by_all_held_out_rows(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    learned, held = bytecounts.learned(langid.learning_rows(docs)), docs.where(fold(F.col("doc_id"), 4) == 2)
    costs: dict[str, list[float]] = {}
    for r in bytecounts.identify(held, learned).where("lang IS NOT NULL").collect():
        if len(r.text.encode()) >= langid.FOREIGN_BYTES:
            costs.setdefault(r.lang, []).append(ceil(r.bits_per_byte * 100) / 100)
    marks = [sorted(x)[ceil(bytecounts.ORDINARY * len(x)) - 1] for x in costs.values()]
    assert bytecounts.ordinary(held, learned) == max(marks)
    assert bytecounts.ordinary(held.where("lang = 'no'"), learned) is None


def prose(rng, syllables, words=60):
    return " ".join("".join(rng.choice(syllables, rng.integers(1, 4))) for _ in range(words))


def dialects(spark):
    """4,000 labelled texts, 40 of them in a dialect that shares no letter with the rest."""
    rng = np.random.default_rng(5)
    common, rare = ["an", "the", "or", "in", "er", "st"], ["жа", "ку", "зо", "лы", "мя", "гэ"]
    rows = [(i, prose(rng, rare if i % 100 == 7 else common), "xx") for i in range(4000)]
    noise = "".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz0123456789   "), 900))
    more = [(10_000 + i, prose(rng, rare), None) for i in range(20)] + [(20_000, noise, None), (20_001, noise[:99], None)]
    return spark.createDataFrame(rows + more, SCHEMA)


def test_rows_that_a_sample_would_miss_are_learned_from(spark, sf_dir):
    docs = dialects(spark)
    left = {r.doc_id for r in c.language(spark, docs, sf_dir).collect()}
    assert left == {r.doc_id for r in docs.collect()} - {20_000}


def test_a_few_wrong_labels_do_not_let_foreign_texts_pass(spark, sf_dir):
    """Four held-out texts of random letters in 1,000 raise no bound."""
    rng = np.random.default_rng(6)
    held = [i for i in range(8000) if zlib.crc32(str(i).encode()) % 4 == 2][:1000]
    noise = lambda: "".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz0123456789   "), 600))
    bad = set(held[::250])
    rows = [(i, noise() if i in bad else prose(rng, ["an", "the", "or", "in", "er", "st"]), "xx") for i in range(max(held) + 1)]
    docs = spark.createDataFrame([*rows, (10_000, noise(), None)], SCHEMA)
    gone = {r[0] for r in rows} | {10_000}
    gone -= {r.doc_id for r in c.language(spark, docs, sf_dir).collect()}
    assert gone == bad | {10_000}
