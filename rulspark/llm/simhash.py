"""SimHash near-duplicates: fingerprints, BK-trees, connected components.

A fingerprint has 64 bits; bit b is set if it is set in more than half of the XXH64 hashes
of the text's word shingles. Fingerprints link at ``distance`` or fewer differing bits.

Finding links. Cut the 64 bits into ``distance + 2`` blocks: two fingerprints that link
differ in at most ``distance`` of them, so they agree on two whole blocks. Each distinct
fingerprint goes once to every pair of blocks, keyed by their values; keys held by a single
fingerprint are dropped by an aggregate. A key that more than ``BUCKET`` fingerprints share
is cut again in the same way over its other bits, which leaves few bits free and so bounds a
bucket by 2 to the number of free bits. A task reads its buckets one after the other, builds
a BK-tree of each (children keyed by their Hamming distance to the parent) and follows only
edges within the radius. Trees go to the tasks that hold their queries instead of to every
executor, because all trees together grow with the corpus.

A bucket gives one link per fingerprint that is not the smallest of its group there, not all
pairs. Components come from hooking every fingerprint to its smallest neighbour, following
the hooks to their ends and contracting, until no link is left; rounds are stored in the
shared folder.

Cases: a null or empty text, or one of white space alone, has fingerprint zero and links
like any other; fewer words than a shingle make one shingle; a row with a null id gets the
component of its fingerprint and is never its smallest id (null where a component has no
id); repeated rows are kept; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rulspark.llm.arrow import filled, slices, strings
from rulspark.llm.shared import fixed, free_names, ready, table

SHINGLE, DISTANCE, SEED = 3, 2, 42
# Fingerprints of one bucket that go to a tree as they are.
BUCKET = 1024
BITS = 64


def fingerprint(text: str, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """Unsigned 64-bit SimHash of a text."""
    words = text.encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        digests = xxhash.xxh64_digest(joined, seed)
    else:
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
        starts = np.concatenate([[0], ends[:-1]])[: len(words) - shingle + 1].tolist()
        stops = (ends[shingle - 1 :] - 1).tolist()
        digest = xxhash.xxh64_digest
        digests = b"".join([digest(joined[a:b], seed) for a, b in zip(starts, stops)])
    n = len(digests) // 8
    bits = np.unpackbits(np.frombuffer(digests, np.uint8)).reshape(n, BITS)
    set_in = bits.sum(axis=0, dtype=np.int64) * 2 > n
    return int.from_bytes(np.packbits(set_in).tobytes(), "big")


def signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def fingerprints(
    df: DataFrame, shingle: int = SHINGLE, seed: int = SEED, keep: tuple[str, ...] = ("doc_id",), name: str = "fp"
) -> DataFrame:
    """``name`` (the 64 bits as a long) beside the columns ``keep``."""
    fields = ", ".join(f"`{k}` {df.schema[k].dataType.simpleString()}" for k in keep)

    def run(batches):
        for batch in batches:
            column = filled(batch.column("text"))
            for start, stop in slices(column):
                got = [signed(fingerprint(t, shingle, seed)) for t in strings(column.slice(start, stop - start))]
                yield pa.RecordBatch.from_arrays(
                    [*[batch.column(k).slice(start, stop - start) for k in keep], pa.array(got, pa.int64())],
                    [*keep, name],
                )

    return df.select(*dict.fromkeys([*keep, "text"])).mapInArrow(run, f"{fields}, `{name}` long")


class BKTree:
    """Fingerprints by Hamming distance to their parents."""

    def __init__(self):
        self.values: list[int] = []
        self.children: list[dict[int, int]] = []

    def add(self, value: int, radius: int) -> list[int]:
        """Insert; returns the places of earlier values within ``radius``."""
        values, children = self.values, self.children
        found, here = [], len(values)
        if values:
            stack = [0]
            while stack:
                at = stack.pop()
                d = (values[at] ^ value).bit_count()
                if d <= radius:
                    found.append(at)
                edges = children[at]
                for edge in range(max(d - radius, 0), d + radius + 1):
                    if edge in edges:
                        stack.append(edges[edge])
            at = 0
            while True:
                d = (values[at] ^ value).bit_count()
                if d not in children[at]:
                    children[at][d] = here
                    break
                at = children[at][d]
        values.append(value)
        children.append({})
        return found


def tree_links(values: list[int], radius: int) -> Iterator[tuple[int, int]]:
    """(smallest member of its group, member) for groups of distinct values linked within ``radius``."""
    tree, parent = BKTree(), []

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    # In rising order, so that a group's first member is its smallest.
    for value in sorted(values):
        near = tree.add(value & ((1 << 64) - 1), radius)
        here = len(parent)
        parent.append(here)
        if near:
            roots = {root(i) for i in near}
            first = min(roots)
            for r in (*roots, here):
                parent[r] = first
    ordered = sorted(values)
    for i, value in enumerate(ordered):
        r = root(i)
        if r != i:
            yield ordered[r], value


def _blocks(low: int, high: int, n: int) -> list[tuple[int, int]]:
    """Bits low..high-1 in ``n`` runs of about the same length: (first bit, mask)."""
    cuts = [low + (high - low) * i // n for i in range(n + 1)]
    return [(a, ((1 << (b - a)) - 1) << a) for a, b in zip(cuts, cuts[1:])]


def masks(distance: int) -> tuple[list[int], dict[int, list[int]]]:
    """Masks of the first keys, and for each the masks of the keys that cut it again."""
    blocks = _blocks(0, BITS, distance + 2)
    first, again = [], {}
    for pair in combinations(blocks, 2):
        mask = pair[0][1] | pair[1][1]
        first.append(signed(mask))
        free = [b for b in range(BITS) if not mask >> b & 1]
        runs = _blocks(0, len(free), distance + 2)
        parts = [sum(1 << free[b] for b in range(len(free)) if run >> b & 1) for _, run in runs]
        again[len(first) - 1] = [signed(mask | a | b) for a, b in combinations(parts, 2)]
    return first, again


def links(distinct: DataFrame, distance: int = DISTANCE, bucket: int = BUCKET) -> DataFrame:
    """``a`` < ``b``: links that connect what is within ``distance``, from distinct ``fp``."""
    first, again = masks(distance)
    keyed = distinct.select(
        "fp",
        F.explode(
            F.array(*[F.struct(F.lit(i).alias("cut"), F.col("fp").bitwiseAND(F.lit(m)).alias("key")) for i, m in enumerate(first)])
        ).alias("at"),
    ).select("fp", "at.cut", "at.key")
    sizes = keyed.groupBy("cut", "key").agg(F.count("*").alias("n")).where("n > 1")
    shared = keyed.join(sizes, ["cut", "key"])
    cool = shared.where(F.col("n") <= bucket).select("cut", "key", "fp")
    # A crowded key is told apart by two more blocks of its other bits.
    finer = F.lit(None)
    for i, cuts in again.items():
        options = F.array(
            *[F.struct(F.lit((i + 1) * 100 + j).alias("cut"), F.col("fp").bitwiseAND(F.lit(m)).alias("key")) for j, m in enumerate(cuts)]
        )
        finer = F.when(F.col("cut") == i, options).otherwise(finer)
    hot = shared.where(F.col("n") > bucket).select("fp", F.explode(finer).alias("at")).select("at.cut", "at.key", "fp")
    buckets = cool.unionByName(hot).repartition("cut", "key").sortWithinPartitions("cut", "key")

    def run(batches):
        group: list[int] = []
        name = None

        def close():
            if len(group) > 1:
                yield from tree_links(group, distance)

        for batch in batches:
            found = []
            for cut, key, fp in zip(*[batch.column(c).to_pylist() for c in ("cut", "key", "fp")]):
                if (cut, key) != name:
                    found.extend(close())
                    group.clear()
                    name = (cut, key)
                group.append(fp)
            yield _pairs(found)
        yield _pairs(list(close()))

    return buckets.mapInArrow(run, "a long, b long").distinct()


def _pairs(found: list[tuple[int, int]]) -> pa.RecordBatch:
    a, b = zip(*found) if found else ((), ())
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root`` for every node of ``a`` < ``b`` that is not a root itself.

    The root is the component's smallest node. Each round hooks nodes to their smallest
    neighbour, so the number of components falls at least by half.
    """
    edges = fixed(edges)
    mapping = None
    while not edges.isEmpty():
        hooks = fixed(edges.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("root")))
        while True:
            ends = hooks.select(F.col("node").alias("root"), F.col("root").alias("_next"))
            jumped = fixed(
                hooks.join(ends, "root", "left").select(
                    "node", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("_moved")
                )
            )
            hooks = jumped.select("node", "root")
            if jumped.where("_moved").isEmpty():
                break
        if mapping is None:
            mapping = hooks
        else:
            ends = hooks.select(F.col("node").alias("root"), F.col("root").alias("_next"))
            moved = mapping.join(ends, "root", "left").select("node", F.coalesce("_next", "root").alias("root"))
            mapping = fixed(moved.unionByName(hooks))
        left, right = (hooks.select(F.col("node").alias(c), F.col("root").alias(f"_{c}")) for c in "ab")
        ends = edges.join(left, "a", "left").join(right, "b", "left")
        a, b = F.coalesce("_a", "a"), F.coalesce("_b", "b")
        edges = fixed(
            ends.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).where("a < b").distinct()
        )
    if mapping is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return mapping


def near_duplicates(
    df: DataFrame,
    shingle: int = SHINGLE,
    distance: int = DISTANCE,
    seed: int = SEED,
    bucket: int = BUCKET,
) -> DataFrame:
    """``doc_id``, ``fp``, the smallest linked ``root`` fingerprint and ``component_id`` for
    every row of ``df``."""
    ready(df.sparkSession)
    marked = fixed(fingerprints(df, shingle, seed))
    distinct = fixed(marked.groupBy("fp").agg(F.min("doc_id").alias("least")))
    roots = components(links(distinct, distance, bucket)).withColumnRenamed("node", "fp")
    # Most fingerprints have no link; only the others need a second aggregate.
    placed = distinct.join(roots, "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    least = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    named = placed.select("fp", "root").join(least, "root").select("fp", "root", "component_id")
    return marked.join(named, "fp").select("doc_id", "fp", "root", "component_id")


def one_of_each(df: DataFrame) -> DataFrame:
    """The rows of ``df`` with one document left of each component: that with the smallest id.

    Rows that their id does not tell apart (null or repeated) are compared by fingerprint;
    the others move once, to meet the narrow list of ids that stay.
    """
    found = fixed(near_duplicates(df))
    repeated = found.where("doc_id IS NOT NULL").groupBy("doc_id").count().where("count > 1").select("doc_id")
    stay = found.where("doc_id = component_id").select("doc_id").join(repeated, "doc_id", "left_anti")
    plain = df.join(stay, "doc_id", "left_semi").select(*df.columns)
    odd = df.where("doc_id IS NULL").unionByName(df.join(repeated, "doc_id", "left_semi").select(*df.columns))
    # Names that no column of the documents has.
    mark, fp, root, component = free_names(df, "_print", "_fp", "_root", "_component")
    renamed = found.select(
        F.col("fp").alias(fp), F.col("root").alias(root), F.col("component_id").alias(component)
    ).distinct()
    marked = fingerprints(odd, keep=tuple(df.columns), name=mark).join(renamed, F.col(mark) == F.col(fp))
    kept = marked.where(F.col("doc_id").eqNullSafe(F.col(component))).dropDuplicates([root])
    return plain.unionByName(kept.select(*df.columns))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
