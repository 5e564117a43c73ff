import hashlib

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from rulspark.llm import bpe

ENC = bpe.encoding(public_tokenizers.path(bpe.RANKS), public_tokenizers.PATTERN)


def check(df, rows, **params):
    got = sorted(((r.doc_id, bytes(r.ids), bytes(r.decoded)) for r in bpe.encode(df, **params).collect()), key=repr)
    want = [(d, bpe.little_endian(ENC.encode_ordinary(x or "")), (x or "").encode()) for d, x in rows]
    assert got == sorted(want, key=repr)


@pytest.mark.parametrize("chunk,overlap", [(32_768, 1_024), (120, 40)])
def test_chunks_give_the_ids_of_the_whole_text(spark, awkward, chunk, overlap):
    hard = [
        (100, "x" * 700), (101, " " * 500 + "end"), (102, "a\n" * 300), (103, "it's we'll they've " * 40),
        (104, "1234567890" * 60), (105, "日本語テキスト" * 80), (106, "😀👩‍👩‍👧 " * 120), (107, ("word " * 30 + "\n\n\n   ") * 8),
        (108, "!?" * 400), (109, "mixed ÄÖ ü\t\t tabs \r\n" * 40),
    ]
    df = awkward.select("doc_id", "text").unionByName(spark.createDataFrame(hard, "doc_id long, text string"))
    check(df, [tuple(r) for r in df.collect()], chunk=chunk, overlap=overlap)


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="ab'sl \n\t1é!", min_size=200, max_size=700))
def test_boundaries_after_the_first_shared_one_agree(text):
    chunk, overlap = 120, 50
    import regex

    true = {m.start() for m in regex.finditer(public_tokenizers.PATTERN, text)}
    for start in range(chunk, len(text), chunk):
        _, tail = bpe.boundaries(text[start - chunk : start + overlap], public_tokenizers.PATTERN, chunk, overlap)
        head, _ = bpe.boundaries(text[start : start + chunk + overlap], public_tokenizers.PATTERN, chunk, overlap)
        if start == chunk:  # the first chunk's boundaries are those of the text
            whole = len(text) <= start + overlap
            assert whole or {start - chunk + p for p in tail} <= true
            shared = {start - chunk + p for p in tail} & {start + p for p in head}
            assert whole or shared <= true


def test_query(spark, sf_dir, texts):
    rows = {r.doc_id: r for r in bpe.op4_byte_bpe(spark, sf_dir).collect()}
    assert set(rows) == set(texts)
    for doc, text in texts.items():
        ids = ENC.encode_ordinary(text or "")
        row = rows[doc]
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(bpe.little_endian(ids)).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256((text or "").encode()).hexdigest()


def test_no_rows(no_docs):
    assert bpe.encode(no_docs).count() == 0
