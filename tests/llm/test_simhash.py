import random

import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from rulspark.llm import simhash as s


def slow_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(x, 42) for x in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(values):
    """Smallest member of each value's group under at most two differing bits."""
    values, root = sorted(values), {}
    for v in values:
        near = {root[u] for u in root if (u ^ v).bit_count() <= 2}
        root[v] = min([v, *near])
        for u in root:
            if root[u] in near:
                root[u] = root[v]
    return root


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="aB \n\té", max_size=60))
def test_fingerprint(text):
    assert s.fingerprint(text) == slow_fingerprint(text)


def crowd(n, seed):
    rng = random.Random(seed)
    out, base = set(), rng.getrandbits(64)
    for _ in range(n):
        value = rng.getrandbits(64) if rng.random() < 0.2 else base
        for _ in range(rng.randrange(4)):
            value ^= 1 << rng.randrange(64)
        out.add(s.signed(value))
        if rng.random() < 0.05:
            base = value
    return out


@settings(max_examples=20, deadline=None)
@given(st.integers(0, 1000))
def test_tree_links_join_what_is_near(seed):
    values = crowd(120, seed)
    parent = {v: v for v in values}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    found = list(s.tree_links(list(values), 2))
    assert len(found) < len(values)
    for a, b in found:
        parent[max(find(a), find(b))] = min(find(a), find(b))
    unsigned = slow_components(v & (1 << 64) - 1 for v in values)
    groups = {}
    for v in values:
        groups.setdefault(unsigned[v & (1 << 64) - 1], set()).add(find(v))
    assert all(len(g) == 1 for g in groups.values()) and len({find(v) for v in values}) == len(groups)


def test_distributed_links_whatever_the_bucket(spark):
    values = crowd(700, 5)
    df = spark.createDataFrame([(v,) for v in values], "fp long")
    unsigned = slow_components(v & (1 << 64) - 1 for v in values)
    want = {}
    for v in values:
        want.setdefault(unsigned[v & (1 << 64) - 1], set()).add(v)
    for bucket in (1024, 3):
        roots = {r.node: r.root for r in s.components(s.links(df, bucket=bucket)).collect()}
        got = {}
        for v in values:
            got.setdefault(roots.get(v, v), set()).add(v)
        assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))
        assert all(root == min(group) for root, group in got.items())


def test_a_long_chain_is_one_component(spark):
    edges = [(i, i + 1) for i in range(60)] + [(200, 201), (150, 201)]
    roots = {r.node: r.root for r in s.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert roots == {**{i: 0 for i in range(1, 61)}, 200: 150, 201: 150}


def test_query(spark, sf_dir, texts):
    rows = {r.doc_id: r for r in s.op10_simhash(spark, sf_dir).collect()}
    want = {d: slow_fingerprint(t) for d, t in texts.items()}
    roots = slow_components(set(want.values()))
    least = {}
    for d, fp in want.items():
        least[roots[fp]] = min(d, least.get(roots[fp], d))
    assert set(rows) == set(texts)
    for d, fp in want.items():
        assert rows[d].fingerprint == f"{fp:016x}" and rows[d].component_id == least[roots[fp]]


def test_awkward_rows(spark, awkward, no_docs):
    rows = s.near_duplicates(awkward).collect()
    assert len(rows) == awkward.count()
    by_id = {r.doc_id: r for r in rows}
    assert by_id[1].fp == by_id[2].fp == by_id[3].fp == 0 and by_id[3].component_id == 1
    assert by_id[7].component_id == 6 and by_id[None].component_id is None
    assert s.near_duplicates(no_docs).count() == 0
    kept = s.one_of_each(awkward)
    assert kept.columns == awkward.columns
    ids = sorted((r.doc_id for r in kept.collect()), key=repr)
    # One of each: the empty texts, the repeated row, equal texts, rows without id; both texts of id 10.
    assert ids == sorted([1, 4, 5, 6, None, 8, 9, 10, 10], key=repr)
    assert s.one_of_each(no_docs).count() == 0
