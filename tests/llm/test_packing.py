import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from rulspark.llm import packing as p

LIBRARY = Tokenizer.from_file(public_tokenizers.path(p.VOCABULARY))


def ids_of(text):
    return np.array([*LIBRARY.encode(text or "", add_special_tokens=False).ids, p.END], "<u4")


def check(rows, texts, length):
    """Every document's ids once, in order; sequences full and gapless but for the last."""
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    assert sorted(by_sequence) == list(range(len(by_sequence)))
    for k, pieces in by_sequence.items():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at and r.length > 0
            at += r.length
        assert at == length or k == len(by_sequence) - 1
    copies = {}
    for doc, text in texts:
        copies.setdefault(doc, []).append(ids_of(text))
    assert set(by_doc) == set(copies)
    for doc, wanted in copies.items():
        assert sum(r.length for r in by_doc[doc]) == sum(map(len, wanted))
        if len(wanted) == 1:
            at = 0
            for r in sorted(by_doc[doc], key=lambda r: r.start):
                part = wanted[0][at : at + r.length].tobytes()
                assert (r.start, r.doc_tokens, r.ids_crc32) == (at, len(wanted[0]), zlib.crc32(part))
                at += r.length


def test_query(spark, sf_dir, texts):
    rows = p.op8_curve_packing(spark, sf_dir).collect()
    check(rows, list(texts.items()), p.LENGTH)


def test_awkward_rows(awkward, no_docs):
    texts = [tuple(r) for r in awkward.select("doc_id", "text").collect()]
    check(p.pieces_of(awkward).collect(), texts, p.LENGTH)
    assert p.pieces_of(no_docs).count() == 0


@pytest.mark.parametrize(
    "text",
    ["", " ", "  ", "a", " a", "a ", "a  b", "a\n b", "a b\n", "\n\n", "a  b", "it's  fine ", "<|endoftext|> x", "é ü\t ö", "\x1c a \x1d b", "a  b"],
)
def test_segments_give_the_ids_of_the_library(text):
    coder = p.Coder(public_tokenizers.path(p.VOCABULARY), public_tokenizers.path(p.RANKS), public_tokenizers.PATTERN)
    for _ in range(2):
        assert np.frombuffer(coder.ids(text), np.uint16).tolist() == ids_of(text)[:-1].tolist()


def test_hilbert_keys_are_a_walk_over_the_grid():
    for n, bits in ((2, 3), (3, 2), (4, 2)):
        grid = np.stack(np.meshgrid(*[np.arange(1 << bits)] * n, indexing="ij"), axis=-1).reshape(-1, n)
        keys = p.hilbert_key(grid, bits)
        assert sorted(keys.tolist()) == list(range(len(grid)))
        walk = grid[np.argsort(keys)]
        assert (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()


def test_equal_texts_lie_together(spark):
    rows = [(i, f"some text about topic {i % 5} " * 6) for i in range(100)]
    pieces = p.pieces_of(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    order = [r.doc_id % 5 for r in sorted(pieces, key=lambda r: (r.sequence_id, r.offset)) if r.start == 0]
    assert sum(a != b for a, b in zip(order, order[1:])) == 4
