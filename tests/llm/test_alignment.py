import hashlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer, pre_tokenizers

from rulspark.llm import alignment as a

BYTE_OF = {}


def byte_of():
    """The byte that each letter of the byte-level vocabulary stands for."""
    if not BYTE_OF:
        letters = pre_tokenizers.ByteLevel.alphabet()
        plain = {chr(b): b for b in range(256) if chr(b) in letters and (33 <= b <= 126 or 161 <= b <= 172 or b >= 174)}
        rest = sorted(set(letters) - set(plain))
        others = [b for b in range(256) if chr(b) not in plain]
        BYTE_OF.update(plain | dict(zip(rest, others)))
    return BYTE_OF


@pytest.fixture(scope="module")
def libraries():
    byte_level = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    byte_level.encode_special_tokens = True
    return byte_level, sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


def slow_groups(text, libraries):
    if not text:
        return None
    first, second = libraries
    ids_a, ids_b = first.encode(" " + text, add_special_tokens=False).ids, second.encode(text)
    tokens_a = [bytes(byte_of()[c] for c in first.id_to_token(i)) for i in ids_a]
    tokens_b = [
        bytes([int(second.id_to_piece(i)[3:5], 16)]) if second.is_byte(i) else second.id_to_piece(i).replace("▁", " ").encode()
        for i in ids_b
    ]
    if not b"".join(tokens_a) == b"".join(tokens_b) == (" " + text).encode():
        return None
    ends_a, ends_b = (set(np.cumsum([len(t) for t in tokens]).tolist()) for tokens in (tokens_a, tokens_b))
    groups, at = [], 0
    for end in sorted(ends_a & ends_b):
        sides = []
        for ids, tokens in ((ids_a, tokens_a), (ids_b, tokens_b)):
            place, side = 0, []
            for i, t in zip(ids, tokens):
                if at <= place < end:
                    side.append(i)
                place += len(t)
            sides.append(side)
        groups.append(sides)
        at = end
    return ids_a, ids_b, groups


def slow(rows, libraries):
    found = [(d, slow_groups(t, libraries) or ([], [], [])) for d, t in rows]
    links = [[(x, y) for left, right in g for x in left for y in right] for _, (_, _, g) in found]
    docs = Counter(p for one in links for p in set(one))
    best = defaultdict(int)
    for (x, _), n in docs.items():
        best[x] = max(best[x], n)
    out = []
    for (d, (ids_a, ids_b, groups)), one in zip(found, links):
        lines = ";".join("|".join(",".join(map(str, side)) for side in g) for g in groups)
        digest = hashlib.sha256(lines.encode()).hexdigest() if groups else ""
        out.append(
            (d, len(ids_a), len(ids_b), len(groups), len(one), sum(docs[p] == best[p[0]] for p in one), sum(docs[p] for p in one), digest)
        )
    return sorted(out, key=repr), docs, Counter(p for one in links for p in one)


def test_query(spark, sf_dir, texts, libraries):
    short = {d: t for d, t in texts.items()}
    rows = [tuple(r) for r in a.op13_pair_bitmaps(spark, sf_dir).collect()]
    assert sorted(rows, key=repr) == slow(short.items(), libraries)[0]


ODD = [
    None, "", " ", "  ", "a ", "a  ", "  a", "\n a", "a\n b", "a \n b", "▁x", "a▁ b", "<|endoftext|> x <0x0A> </s>",
    "é　x\xa0y", "\x00 \x1c b", "it's don't 'S", "日本語 テキスト", "x" * 300, "a\t b", " " * 50 + "x", "😀 😀😀",
    "same same same same same same same same same", "one\r\n two\x85 three", "ﬁ ①Ａ",
]


def test_odd_texts_counts_and_links(spark, libraries):
    rows = [*enumerate(ODD), (21, ODD[21]), (21, ODD[21]), (None, "a b"), (None, "a b")]
    index = a.PairIndex(spark.createDataFrame(rows, "doc_id long, text string"))
    want, docs, links = slow(rows, libraries)
    assert sorted(map(tuple, index.scored().collect()), key=repr) == want
    got = index.counts.collect()
    assert {divmod(r.pair, a.WIDTH): r.docs for r in got} == docs
    assert {divmod(r.pair, a.WIDTH): r.links for r in got} == links


def test_a_worker_with_little_room_gives_the_same(libraries):
    known = a.Segments(public_tokenizers.path(a.RANKS), public_tokenizers.path(a.PIECES), public_tokenizers.PATTERN)
    assert known.apart
    texts = [t or "" for t in ODD]
    rows = np.arange(len(texts))
    first, postings = a.one_slice(known, texts, rows)
    known.held_bytes = a.SEGMENT_BYTES + 1
    again, others = a.one_slice(known, texts, rows)
    known.clear()
    known.apart = False
    whole, uncut = a.one_slice(known, texts, rows)
    for other, more in ((again, others), (whole, uncut)):
        assert all(first[k].equals(other[k]) for k in first)
        assert all(np.array_equal(x, y) for x, y in zip(postings, more))


def test_bitmaps_open_as_they_were_made():
    rng = np.random.default_rng(1)
    sets = [np.sort(rng.choice(a.CHUNK, n, replace=False)) for n in (1, 7, 4095, 4096, 65536, 3)]
    bounds = np.concatenate([[0], np.cumsum([len(s) for s in sets])])
    made = a.containers(np.concatenate(sets), bounds)
    assert [len(x.as_py()) for x in made] == [2, 14, 8190, 8192, 8192, 6]
    for bitmaps in (made, made.slice(1, 4)):
        which, offset = a.opened(bitmaps)
        lone = sets[1:5] if len(bitmaps) == 4 else sets
        assert np.array_equal(offset, np.concatenate(lone))
        assert np.array_equal(which, np.repeat(np.arange(len(lone)), [len(s) for s in lone]))
    assert a.opened(pa.array([], pa.binary()))[0].size == 0


def test_merging_keeps_planes_and_splits_of_a_pair(spark):
    """Partial bitmaps of 9,000 documents in two chunks, with up to nine links."""
    rng = np.random.default_rng(2)
    parts, want, total = [], Counter(), Counter()
    for low in range(0, 90_000, 5_000):
        row = np.arange(low, low + 5_000, 10)
        pair = rng.integers(0, 3, len(row))
        links = rng.integers(1, 10, len(row))
        parts.append(a.bitmaps_of(pair, row, links))
        want.update(pair.tolist())
        for p, n in zip(pair.tolist(), links.tolist()):
            total[p] += n
    table = pa.concat_tables([pa.table(p) for p in parts])
    index = a.merged(spark.createDataFrame(table.to_pandas(), a.POSTING).repartition(6))
    counts = {r.pair: r for r in a.pair_counts(index).collect()}
    assert {p: r.docs for p, r in counts.items()} == want and {p: r.links for p, r in counts.items()} == total
    assert index.groupBy("pair", "chunk", "plane").count().where("count > 1").isEmpty()


def test_awkward_rows(spark, awkward, no_docs):
    rows = a.PairIndex(awkward).scored().collect()
    assert len(rows) == awkward.count()
    by_id = {r.doc_id: r for r in rows}
    assert by_id[1].n_a == by_id[2].count_sum == 0 and by_id[1].groups_sha256 == "" and by_id[3].n_a > 0
    assert a.PairIndex(no_docs).scored().count() == 0


@pytest.mark.parametrize("rows", [2, 1000])
def test_bitmaps_of_one_key_and_of_several_tasks_merge(spark, rows):
    """Single keys, a key over several batches, a dense one, pieces of few bits."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    rng = np.random.default_rng(3)
    want, parts = {}, []
    for pair, chunk, copies, size in [(1, 0, 1, 9), (2, 0, 7, 50), (2, 1, 1, 5000), (3, 0, 3, 6000), (4, 5, 2, 1), (9, 9, 1, 1)]:
        for _ in range(copies):
            offsets = np.unique(rng.integers(0, a.CHUNK, size))
            want.setdefault((pair, chunk), set()).update(offsets.tolist())
            bits = a.containers(offsets, np.array([0, len(offsets)]))[0].as_py()
            parts.append((pair, chunk, 0, bits, len(offsets)))
    spark.conf.set(key, str(rows))
    try:
        postings = spark.createDataFrame(parts, a.POSTING).repartition(3).where("pair IS NOT NULL")
        got = a.merged(postings).collect()
    finally:
        spark.conf.set(key, before)
    assert len(got) == len(want)
    for r in got:
        _, offsets = a.opened(pa.array([bytes(r.bits)], pa.binary()))
        assert set(offsets.tolist()) == want[r.pair, r.chunk] and r.docs == len(offsets)
