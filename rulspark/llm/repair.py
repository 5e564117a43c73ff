"""Periodic runs of words, found on a Re-Pair grammar.

A run is a stretch of words with smallest period q, at least ``LEAST`` words and ``TIMES``
periods long, that no neighbouring word extends.

* **Grammar.** The word ids of a slice of texts are compressed by Re-Pair: the most frequent
  pair of neighbours becomes a nonterminal, until no pair repeats. A round replaces the most
  frequent pair everywhere, and at the same time every other repeated pair wherever it
  outranks the pairs it overlaps (ties by a fixed shuffle, which keeps derivations shallow).
  What is left of a text is joined in a balanced way, so that a text is one nonterminal.
* **Boundaries.** A run lies across the boundary of the lowest nonterminal that derives it
  whole, and half of it, two periods or more, lies on one side. So for each nonterminal, once,
  every period is tried whose square could begin or end at its boundary, and the stretch is
  measured by common extensions in the nonterminal's derivation.
* **Positions.** Each stretch is moved to all derivation positions of its nonterminal, and
  stretches of one period that lie in a longer one are merged into it.

All steps are array operations over a slice of texts, and every run is compared word by word
at the end; a text with a run that fails this (hashes that collide) is searched period by
period. There is no shuffle.

Cases: a null or empty text, or one of white space alone, has no words and no runs; repeated
rows give repeated results; other columns are ignored; an empty table gives an empty table.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rulspark.llm.arrow import filled, slices, strings
from rulspark.llm.shared import table
from rulspark.llm.words import mix, powers

# The shortest run in words, and in periods.
LEAST, TIMES = 6, 4
# Words of context that a longer period must share before it is measured.
GRAM = 4
# Periods that are tried at once.
AT_ONCE = 1 << 20
# Rounds end when one shortens the texts by less than this share.
GAIN = 1 / 256
# An odd factor that shuffles pairs of one frequency.
SHUFFLE = 0x9E3779B1


@dataclass
class Grammar:
    """Nodes of all derivations: nonterminal, first word, first word of the right child, end."""

    symbol: np.ndarray
    start: np.ndarray
    middle: np.ndarray
    end: np.ndarray


def _pairs_taken(rank: np.ndarray) -> np.ndarray:
    """Places of pairs that outrank the pairs they overlap. ``rank`` is -1 where a pair may
    not be taken; of overlapping equal pairs every other one is taken, from the left."""
    n = len(rank)
    change = np.flatnonzero(rank[1:] != rank[:-1]) + 1
    first = np.concatenate([[0], change])
    length = np.diff(np.append(first, n))
    value = rank[first]
    around = np.concatenate([[-1], value, [-1]])
    peak = (value >= 0) & (value > around[:-2]) & (value > around[2:])
    first, length = first[peak], (length[peak] + 1) // 2
    step = np.arange(length.sum()) - np.repeat(np.cumsum(length) - length, length)
    return np.repeat(first, length) + 2 * step


def grammar(ids: np.ndarray, text: np.ndarray) -> Grammar:
    """Re-Pair over texts laid end to end; ``text`` is non-decreasing and tells them apart."""
    symbols, owner = ids.astype(np.int64), text
    starts = np.arange(len(ids), dtype=np.int64)
    ends = starts + 1
    free = int(ids.max()) + 1 if len(ids) else 0
    nodes = []
    repeated = True
    while len(symbols) > 1:
        joined = owner[1:] == owner[:-1]
        at = np.flatnonzero(joined)
        if not len(at):
            break
        if repeated:
            _, pair, counts = np.unique(symbols[at] * free + symbols[at + 1], return_inverse=True, return_counts=True)
            bits = int(len(counts)).bit_length()
            shuffled = np.arange(len(counts)) * SHUFFLE & ((1 << bits) - 1)
            place = np.where(counts > 1, counts << bits | shuffled, -1)
            rank = np.full(len(joined), -1, np.int64)
            rank[at] = place[pair]
            taken = _pairs_taken(rank)
            if len(taken) < GAIN * len(symbols):
                repeated = False
                continue
            which = np.zeros(len(joined), np.int64)
            which[at] = pair
            which = which[taken]
            used = np.zeros(len(counts), np.int64)
            used[which] = 1
            names = (np.cumsum(used) - 1)[which]
        else:
            # Neighbours of one text, two and two.
            new = np.concatenate([[True], ~joined])
            begin = np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))[:-1]
            taken = np.flatnonzero(joined & ((np.arange(len(joined)) - begin) % 2 == 0))
            names = np.arange(len(taken))
        made = free + names
        free = int(made.max()) + 1
        nodes.append((made, starts[taken], starts[taken + 1], ends[taken + 1]))
        symbols[taken] = made
        ends[taken] = ends[taken + 1]
        keep = np.ones(len(symbols), np.bool_)
        keep[taken + 1] = False
        symbols, owner, starts, ends = symbols[keep], owner[keep], starts[keep], ends[keep]
    if not nodes:
        none = np.zeros(0, np.int64)
        return Grammar(none, none, none, none)
    return Grammar(*[np.concatenate(c) for c in zip(*nodes)])


class Extensions:
    """Longest common extensions of two places, by hashes of ranges."""

    PRIME = (1 << 31) - 1

    def __init__(self, ids: np.ndarray):
        n = len(ids)
        mixed = mix(ids.astype(np.uint64) + np.uint64(1))
        up, self.down = powers(n + 1)
        self.wide = np.zeros(n + 1, np.uint64)
        np.cumsum(mixed * up[:-1], out=self.wide[1:])
        self.gram = np.zeros(n + 1, np.uint64)
        if n >= GRAM:
            self.gram[: n - GRAM + 1] = self._wide(np.arange(n - GRAM + 1), GRAM)
        # Powers of a prime's root: sums of products of a power of two length stay comparable
        # in the wide hash for some inputs, never in this one as well.
        power = np.ones(1, np.int64)
        while len(power) < n + 1:
            step = pow(48271, len(power), self.PRIME)
            power = np.concatenate([power, power * step % self.PRIME])
        self.power = power[: n + 1]
        self.small = np.zeros(n + 1, np.int64)
        np.cumsum((mixed >> np.uint64(34)).astype(np.int64) * self.power[:-1] % self.PRIME, out=self.small[1:])

    def _wide(self, at, length):
        return (self.wide[at + length] - self.wide[at]) * self.down[at]

    def same(self, a: np.ndarray, b: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Whether the ranges from ``a`` and from ``b`` (``a`` <= ``b``) agree."""
        small = (self.small[a + length] - self.small[a]) % self.PRIME * self.power[b - a] % self.PRIME
        return (self._wide(a, length) == self._wide(b, length)) & (
            small == (self.small[b + length] - self.small[b]) % self.PRIME
        )

    def right(self, a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
        """How far the words from ``a`` and from ``b`` agree, at most ``most``."""
        low, high = np.zeros_like(most), np.maximum(most, 0)
        while (open_ := low < high).any():
            middle = (low + high + 1) // 2
            good = self.same(a, b, middle)
            low = np.where(open_ & good, middle, low)
            high = np.where(open_ & ~good, middle - 1, high)
        return low

    def left(self, a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
        """How far the words before ``a`` and before ``b`` agree, at most ``most``."""
        low, high = np.zeros_like(most), np.maximum(most, 0)
        while (open_ := low < high).any():
            middle = (low + high + 1) // 2
            good = self.same(a - middle, b - middle, middle)
            low = np.where(open_ & good, middle, low)
            high = np.where(open_ & ~good, middle - 1, high)
        return low


def _periods(most: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rule, period) for periods from 1 to ``most`` of each rule, some at a time."""
    total = np.cumsum(most)
    done = 0
    while done < len(most):
        before = total[done - 1] if done else 0
        until = max(int(np.searchsorted(total, before + AT_ONCE, side="right")), done + 1)
        part = most[done:until]
        # One rule alone may have more: it is cut too.
        for low in range(0, max(int(part.max()), 1), AT_ONCE):
            here = np.clip(part - low, 0, AT_ONCE)
            rule = np.repeat(np.arange(done, until), here)
            yield rule, low + 1 + np.arange(len(rule)) - np.repeat(np.cumsum(here) - here, here)
        done = until


def boundary_runs(ids: np.ndarray, found: Grammar) -> tuple[np.ndarray, ...]:
    """``symbol``, ``start``, ``length`` and ``period`` of the stretches that cross the boundary
    of a nonterminal, once for each, from the start of its derivation."""
    _, at = np.unique(found.symbol, return_index=True)
    at = at[found.end[at] - found.start[at] >= LEAST]
    start, middle, end = found.start[at], found.middle[at], found.end[at]
    whole = (end - start) // TIMES
    reach = Extensions(ids)
    gram = reach.gram
    out = []
    for to_right in (True, False):
        side = end - middle if to_right else middle - start
        for rule, q in _periods(np.minimum(side // 2, whole)):
            m = middle[rule]
            near, far = (m, m + q) if to_right else (m - 1, m - 1 - q)
            hit = ids[near] == ids[far]
            rule, q, m, near, far = (x[hit] for x in (rule, q, m, near, far))
            if not to_right:
                near, far = near - GRAM + 1, far - GRAM + 1
            hit = (q < GRAM) | (gram[near] == gram[far])
            rule, q, m = rule[hit], q[hit], m[hit]
            s, e = start[rule], end[rule]
            a, b = (m, m + q) if to_right else (m - q, m)
            r = reach.right(a, b, e - b)
            left = reach.left(a, b, a - s)
            good = (r if to_right else left) >= q
            first, last = (a - left)[good], (b + r)[good]
            rule, q = rule[good], q[good]
            good = last - first >= np.maximum(LEAST, TIMES * q)
            out.append((rule[good], first[good], last[good], q[good]))
    rule, first, last, q = (np.concatenate(x) for x in zip(*out))
    # Multiples of a period give the same stretch.
    order = np.lexsort((q, last, first, rule))
    rule, first, last, q = (x[order] for x in (rule, first, last, q))
    new = np.ones(len(rule), np.bool_)
    new[1:] = (rule[1:] != rule[:-1]) | (first[1:] != first[:-1]) | (last[1:] != last[:-1])
    rule, first, last, q = (x[new] for x in (rule, first, last, q))
    return found.symbol[at][rule], first - start[rule], last - first, q


def _merged(first: np.ndarray, last: np.ndarray, q: np.ndarray) -> tuple[np.ndarray, ...]:
    """Stretches without those inside another one of the same period, by place."""
    order = np.lexsort((-last, first, q))
    first, last, q = first[order], last[order], q[order]
    # A period's stretches reach beyond all of a smaller period's after the shift.
    shift = np.cumsum(np.concatenate([[0], q[1:] != q[:-1]])) * (int(last.max()) + 1 if len(last) else 1)
    reached = np.maximum.accumulate(last + shift) if len(last) else last
    keep = np.ones(len(first), np.bool_)
    keep[1:] = (last + shift)[1:] > reached[:-1]
    first, last, q = first[keep], last[keep], q[keep]
    order = np.lexsort((q, last, first))
    return first[order], last[order], q[order]


def _scan(ids: np.ndarray) -> list[tuple[int, int, int]]:
    """Runs of one text, period by period."""
    found: dict[tuple[int, int], int] = {}
    for q in range(1, len(ids) // TIMES + 1):
        same = np.concatenate([[False], ids[q:] == ids[:-q], [False]])
        edges = np.flatnonzero(same[1:] != same[:-1])
        for a, b in zip(edges[0::2].tolist(), edges[1::2].tolist()):
            if b + q - a >= max(LEAST, TIMES * q):
                found.setdefault((a, b + q), q)
    return [(a, b, q) for (a, b), q in sorted(found.items())]


def runs(ids: np.ndarray, bounds: np.ndarray) -> list[list[tuple[int, int, int]]]:
    """Per text its runs as (start, length, period), by start, then period.

    ``ids`` are the word ids of texts laid end to end; ``bounds`` tell where each begins.
    """
    out: list[list[tuple[int, int, int]]] = [[] for _ in range(len(bounds) - 1)]
    if len(ids) < LEAST:
        return out
    text = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    with np.errstate(over="ignore"):
        found = grammar(ids, text)
        symbol, offset, length, q = boundary_runs(ids, found)
    if not len(symbol):
        return out
    by_symbol = np.argsort(found.symbol, kind="stable")
    ordered = found.symbol[by_symbol]
    low, high = np.searchsorted(ordered, symbol), np.searchsorted(ordered, symbol, side="right")
    times = high - low
    step = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
    place = found.start[by_symbol[np.repeat(low, times) + step]]
    first = place + np.repeat(offset, times)
    first, last, q = _merged(first, first + np.repeat(length, times), np.repeat(q, times))
    wrong = set()
    for a, b, p in zip(first.tolist(), last.tolist(), q.tolist()):
        t = int(text[a])
        low, high = bounds[t], bounds[t + 1]
        whole = np.array_equal(ids[a : b - p], ids[a + p : b])
        if not whole or (a > low and ids[a - 1] == ids[a - 1 + p]) or (b < high and ids[b] == ids[b - p]):
            wrong.add(t)
        out[t].append((a - int(low), b - a, p))
    for t in wrong:
        out[t] = [(a, b - a, p) for a, b, p in _scan(ids[bounds[t] : bounds[t + 1]])]
    return [sorted(r, key=lambda x: (x[0], x[2])) for r in out]


def numbered(texts: Sequence[Sequence[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all words, equal for equal words, and where each text's words begin."""
    names: defaultdict[bytes, int] = defaultdict()
    names.default_factory = names.__len__
    bounds = np.concatenate([[0], np.cumsum([len(w) for w in texts], dtype=np.int64)])
    ids = np.fromiter(map(names.__getitem__, chain.from_iterable(texts)), np.int64, int(bounds[-1]))
    return ids, bounds


def collapsed(words: Sequence[bytes], found: Sequence[tuple[int, int, int]]) -> bytes:
    """The words without those that repeat a run's first period, joined by spaces."""
    if not found:
        return b" ".join(words)
    depth = np.zeros(len(words) + 1, np.int64)
    for start, length, q in found:
        depth[start + q] += 1
        depth[start + length] -= 1
    kept = np.flatnonzero(np.cumsum(depth[:-1]) == 0)
    return b" ".join([words[i] for i in kept.tolist()])


def strongest(found: Sequence[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run with the greatest length in periods; ties by start, then period."""
    best = None
    for run in found:
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


Edit = Callable[[object, list], list]


def runs_and_text(df: DataFrame, edit: Edit | None = None) -> DataFrame:
    """``doc_id``, ``runs`` (start, length, period) and the ``collapsed`` text of every row.

    ``edit`` may change a document's words, given its id, before they are searched.
    """
    kind = dict(df.dtypes)["doc_id"]
    fields = [pa.field(n, pa.int64()) for n in ("start", "length", "period")]

    def run(batches):
        for batch in batches:
            column = filled(batch.column("text"))
            ids_of = batch.column("doc_id")
            for low, high in slices(column):
                docs = ids_of.slice(low, high - low)
                texts = [t.encode().split() for t in strings(column.slice(low, high - low))]
                if edit:
                    texts = [edit(d, w) for d, w in zip(docs.to_pylist(), texts)]
                ids, bounds = numbered(texts)
                found = runs(ids, bounds)
                ends = np.concatenate([[0], np.cumsum([len(r) for r in found])])
                flat_runs = np.array([x for r in found for x in r], np.int64).reshape(-1, 3)
                structs = pa.StructArray.from_arrays([pa.array(flat_runs[:, i]) for i in range(3)], fields=fields)
                yield pa.RecordBatch.from_arrays(
                    [
                        docs,
                        pa.ListArray.from_arrays(pa.array(ends, pa.int32()), structs),
                        pa.array([collapsed(w, r) for w, r in zip(texts, found)], pa.binary()).cast(pa.string()),
                    ],
                    ["doc_id", "runs", "collapsed"],
                )

    return df.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, runs array<struct<start:long,length:long,period:long>>, collapsed string"
    )


def planted(doc_id: object, words: list) -> list:
    """A tenth of the documents, chosen by their id, turn periodic from some word on."""
    h = zlib.crc32(str(doc_id).encode())
    n = len(words)
    if doc_id is None or h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + i % p] for i in range(n - a)]


def op12_repair_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of every document: their number, the strongest, and digests of all and of the rest."""
    found = runs_and_text(table(spark, sf_dir, "documents"), planted)
    # The greatest length in periods, compared as whole numbers.
    best = F.expr(
        "aggregate(runs, cast(null as struct<start:bigint,length:bigint,period:bigint>), (best, r) -> "
        "CASE WHEN best IS NULL OR r.length * best.period > best.length * r.period THEN r ELSE best END)"
    )
    lines = F.expr("concat_ws('', transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\n')))")
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("best.start").alias("start"),
        F.col("best.length").alias("length"),
        F.col("best.period").alias("period"),
        F.expr("best.length * 1000 div best.period").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
