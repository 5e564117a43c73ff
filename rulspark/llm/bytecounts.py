"""Language models of byte counts, learned from every labelled row.

Per language, how often each byte follows each pair of bytes, each byte each other one, and each
pair occurs, over all learning rows; a text's cost in a language is the mean of -log2 of the
probability of each of its bytes after the two before it (a space before the first). A triple
that was seldom seen leans on its last pair, a pair on its last byte (Dirichlet smoothing). The
cheapest language wins.

Tasks count their own rows and Spark adds the counts by language and key, so a model is as large
for ten rows as for all: triples share ``BUCKETS`` counters by hash, and a triple never counts
more often than its first two bytes. Letters A-Z count as a-z.

Beyond which cost a text is foreign is told by all labelled rows of the held-out fold, counted
by hundredths of a bit.

Cases: as in ``langid``; rows without a label, an id or a letter are not learned from.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rulspark.llm import langid
from rulspark.llm.arrow import SLICE_BYTES, by_text, filled, flat, held, slices
from rulspark.llm.shared import ready

BUCKET_BITS = 18
BUCKETS, PAIRS = 1 << BUCKET_BITS, 1 << 16
# Keys of a language's counters: pairs before a byte, pairs that end in it, triples.
BEFORE, ENDING, TRIPLE = 0, PAIRS, 2 * PAIRS
KEYS = 2 * PAIRS + BUCKETS
# How many occurrences the shorter context weighs.
PRIOR = 8.0
# Languages that a task counts at once before it hands its counts on.
AT_ONCE = 32
# Share of a language's held-out texts that cost no more than an ordinary text, and than the
# usual one.
ORDINARY, USUAL = 0.99, 0.5

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def places(data: np.ndarray, bounds: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Piece by piece of the texts: the pair before each byte, the pair that ends in it, the
    bucket of its triple, and where each text lies in the piece."""
    for start in range(0, len(data), SLICE_BYTES):
        stop = min(start + SLICE_BYTES, len(data))
        first = max(start - 2, 0)
        # Two bytes more before the piece; those before a text are spaces.
        byte = np.concatenate([np.full(2 - (start - first), 32, np.uint8), LOWER[data[first:stop]]]).astype(np.uint32)
        here, one, two = byte[2:], byte[1:-1].copy(), byte[:-2].copy()
        opens = bounds[:-1][np.diff(bounds) > 0] - start
        one[opens[(opens >= 0) & (opens < len(one))]] = 32
        for at in (opens, opens + 1):
            two[at[(at >= 0) & (at < len(two))]] = 32
        before, ending = two << 8 | one, one << 8 | here
        bucket = ((two << 16 | ending) * np.uint32(0x9E3779B1)) >> np.uint32(32 - BUCKET_BITS)
        yield before, ending, bucket, np.clip(bounds - start, 0, stop - start)


def counted(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The counters of some texts of one language."""
    out = np.zeros(KEYS, np.int64)
    for before, ending, bucket, _ in places(data, bounds):
        out[BEFORE:ENDING] += np.bincount(before, minlength=PAIRS)
        out[ENDING:TRIPLE] += np.bincount(ending, minlength=PAIRS)
        out[TRIPLE:] += np.bincount(bucket, minlength=BUCKETS)
    return out


@dataclass(frozen=True)
class Counts:
    """Keys and counts above zero of each language, in order."""

    langs: tuple[str, ...]
    keys: tuple[np.ndarray, ...]
    counts: tuple[np.ndarray, ...]
    name: str = field(default_factory=lambda: uuid.uuid4().hex)


class Model:
    """Each language's counters as tables."""

    def __init__(self, learned: Counts):
        self.langs = list(learned.langs)
        self.tables = [self._tables(keys, counts) for keys, counts in zip(learned.keys, learned.counts)]

    @staticmethod
    def _tables(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        table = np.zeros(KEYS)
        table[keys] = counts
        pairs = table[ENDING:TRIPLE].reshape(256, 256)
        single = pairs.sum(axis=0)
        alone = (single + 1) / (single.sum() + 256)
        after = (pairs + PRIOR * alone) / (pairs.sum(axis=1, keepdims=True) + PRIOR)
        return tuple(t.astype(np.float32) for t in (table[BEFORE:ENDING], PRIOR * after.reshape(-1), table[TRIPLE:]))

    def cost(self, data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Bits per byte of each text in each language."""
        bits = np.zeros((len(bounds) - 1, len(self.langs)))
        for before, ending, bucket, inside in places(data, bounds):
            for j, (seen_before, leaning, triples) in enumerate(self.tables):
                seen = seen_before[before]
                known = np.minimum(triples[bucket], seen) + leaning[ending]
                bits[:, j] += by_text(np.log2((seen + np.float32(PRIOR)) / known), inside)
        return bits / np.maximum(np.diff(bounds), 1)[:, None]


def learned(labelled: DataFrame) -> Counts | None:
    """The counters of every language over all its lettered rows; None if there are none."""
    ready(labelled.sparkSession)
    rows = lettered(labelled).select("lang", "text")

    def run(batches):
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            texts, langs = filled(batch.column("text")), batch.column("lang").to_numpy(zero_copy_only=False)
            for lang in dict.fromkeys(langs):
                own = texts.take(pa.array(np.flatnonzero(langs == lang)))
                for start, stop in slices(own):
                    if lang not in totals and len(totals) == AT_ONCE:
                        yield from handed(totals)
                        totals.clear()
                    total = totals.setdefault(lang, np.zeros(KEYS, np.int64))
                    total += counted(*flat(own.slice(start, stop - start)))
        yield from handed(totals)

    parts = rows.mapInArrow(run, "lang string, key int, n long")
    found = parts.groupBy("lang", "key").agg(F.sum("n").alias("n")).toArrow()
    lang, key, n = (found.column(c).to_numpy() for c in ("lang", "key", "n"))
    langs = tuple(sorted(set(lang)))
    if not langs:
        return None
    own = [lang == x for x in langs]
    return Counts(langs, tuple(key[o] for o in own), tuple(n[o] for o in own))


def handed(totals: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
    for lang, total in totals.items():
        keys = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(keys), pa.string()), pa.array(keys.astype(np.int32)), pa.array(total[keys])],
            ["lang", "key", "n"],
        )


def lettered(labelled: DataFrame) -> DataFrame:
    """Rows with a label, an id and a text with a letter."""
    return labelled.where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & F.col("text").rlike(r"\p{L}"))


def judging(spark: SparkSession, learned: Counts, made: tuple[str, str, str]) -> tuple[Callable, tuple[str, str, str]]:
    """The model as ``langid.judged`` takes it."""
    sent, name = spark.sparkContext.broadcast(learned), learned.name
    return (lambda: held(("counts", name), lambda: Model(sent.value))), made


def identify(
    df: DataFrame, learned: Counts, keep: list[str] | None = None, made: tuple[str, str, str] = langid.MADE
) -> DataFrame:
    """``lang_pred``, ``score`` and ``bits_per_byte`` as ``langid.identify`` adds them."""
    return langid.judged(df, [judging(df.sparkSession, learned, made)], keep)


def ordinary(
    held_out: DataFrame, learned: Counts | dict[str, bytes], told_by: Callable = identify, share: float = ORDINARY
) -> float | None:
    """Bits per byte that ``share`` of the held-out texts of every language need not exceed;
    of texts long enough to be judged where there are some. None without such texts. ``told_by``
    is ``identify``, or that of ``langid`` for its samples."""
    langs = learned.langs if isinstance(learned, Counts) else tuple(learned)
    rows = lettered(held_out).where(F.col("lang").isin(*langs))
    long = (F.octet_length("text") >= langid.FOREIGN_BYTES).alias("long")
    costs = told_by(rows.select("lang", "text", long), learned, ["lang", "long"])
    hundredths = F.ceil(F.col("bits_per_byte") * 100).alias("hundredths")
    found = costs.groupBy("lang", "long", hundredths).agg(F.count("*").alias("n")).collect()
    found = [r for r in found if r["long"]] or found
    most = []
    for lang in {r["lang"] for r in found}:
        own = sorted((r["hundredths"], r["n"]) for r in found if r["lang"] == lang)
        reached = np.cumsum([n for _, n in own])
        most.append(own[int(np.searchsorted(reached, share * reached[-1]))][0] / 100)
    return max(most, default=None)
