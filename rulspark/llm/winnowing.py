"""Document fingerprints by winnowing.

Every ``K`` code points are hashed; of each ``WINDOW`` neighbouring hashes the smallest is
kept, the rightmost one among equals, with its position. Two texts that share a run of
``K + WINDOW - 1`` code points share a kept hash, whatever stands around it; the positions
say where. The likeness of two fingerprints is the Jaccard index of their hashes.

``against_next`` compares every text with an edited copy whose end comes from the document
that follows in descending order of ids, and with that document. Documents are dealt into
runs of ids whose upper ends are ids of the table (approximate quantiles); the top document
of a run is also sent to the run above it, so every task sees the follower of its last
document and each text is moved once.

Cases: a null text is empty; an empty text has an empty fingerprint and a text shorter than
``K`` one hash; two empty fingerprints are alike (1), an empty and another one are not (0).
Null ids come after all others; rows with equal ids are ordered by text (null first), and
equal rows follow each other; a single row follows itself. Other columns are ignored; an
empty table gives an empty table.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rulspark.llm.arrow import filled, slices, strings
from rulspark.llm.shared import partitions, table
from rulspark.llm.words import BASE, mix

K, WINDOW = 16, 64


def gram_hashes(codes: np.ndarray, k: int) -> np.ndarray:
    """Rolling 32-bit hashes of every ``k`` values; the whole where there are fewer."""
    if not len(codes):
        return np.zeros(0, np.uint64)
    k = min(k, len(codes))
    with np.errstate(over="ignore"):
        value = (codes.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)
        # Hashes of runs of 1, 2, 4, ... values, joined to runs of k.
        out, size, run = None, 0, 1
        while True:
            if k & run:
                if out is None:
                    out, size = value, run
                else:
                    out = _joined(out, size, value, run)
                    size += run
            run *= 2
            if run > k:
                break
            value = _joined(value, run // 2, value, run // 2)
        return mix(out[: len(codes) - k + 1]) >> np.uint64(32)


def _joined(first: np.ndarray, n: int, second: np.ndarray, m: int) -> np.ndarray:
    """Hashes of runs of n + m values from those of n and the following m."""
    after = second[n:]
    size = min(len(first), len(after))
    return first[:size] * np.uint64(pow(BASE, m, 1 << 64)) + after[:size]


def winnow(codes: np.ndarray, k: int = K, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """Kept hashes and their positions, by position."""
    hashes = gram_hashes(codes, k)
    n = len(hashes)
    if n == 0:
        return np.zeros(0, np.uint32), np.zeros(0, np.int64)
    # The smallest of these is the smallest hash, and the rightmost among equals.
    low = np.uint64(0xFFFFFFFF)
    keys = (hashes << np.uint64(32)) | (low - np.arange(n, dtype=np.uint64))
    if n <= window:
        kept = keys.min(keepdims=True)
    else:
        blocks = -(-n // window)
        padded = np.full(blocks * window, np.uint64(0xFFFFFFFFFFFFFFFF))
        padded[:n] = keys
        grid = padded.reshape(blocks, window)
        ahead = np.minimum.accumulate(grid, axis=1).reshape(-1)
        behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].reshape(-1)
        least = np.minimum(behind[: n - window + 1], ahead[window - 1 : n])
        change = np.ones(len(least), bool)
        change[1:] = least[1:] != least[:-1]
        kept = least[change]
    return (kept >> np.uint64(32)).astype(np.uint32), (low - (kept & low)).astype(np.int64)


def codes_of(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def likeness(a: set[int], b: set[int]) -> float:
    if not a and not b:
        return 1.0
    both = len(a & b)
    return both / (len(a) + len(b) - both)


class Fingerprint:
    """A text's kept hashes and positions, their digest and the set of hashes."""

    def __init__(self, text: str, k: int, window: int):
        self.hashes, self.positions = winnow(codes_of(text), k, window)
        self.kinds = set(self.hashes.tolist())

    def digest(self) -> str:
        raw = self.hashes.astype("<u4").tobytes() + self.positions.astype("<u8").tobytes()
        return hashlib.sha256(raw).hexdigest()


def fingerprints(df: DataFrame, k: int = K, window: int = WINDOW) -> DataFrame:
    """``doc_id``, ``hashes`` and their ``positions`` in code points, for every row."""
    kind = df.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            column = filled(batch.column("text"))
            for start, stop in slices(column):
                got = [winnow(codes_of(t), k, window) for t in strings(column.slice(start, stop - start))]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(start, stop - start),
                        pa.array([h.tolist() for h, _ in got], pa.list_(pa.int64())),
                        pa.array([p.tolist() for _, p in got], pa.list_(pa.int64())),
                    ],
                    ["doc_id", "hashes", "positions"],
                )

    return df.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, hashes array<long>, positions array<long>")


def _upper_ends(df: DataFrame, runs: int) -> list[int]:
    """Ids that end runs of about equal size, ascending; the last is the largest id."""
    shares = [(i + 1) / runs for i in range(runs - 1)] + [1.0]
    got = df.agg(F.percentile_approx("doc_id", shares, 10 * max(1000, runs)).alias("ends"), F.max("doc_id").alias("top")).first()
    return sorted({*(got["ends"] or []), *([got["top"]] if got["top"] is not None else [])})


def in_runs(df: DataFrame) -> DataFrame:
    """Rows by ``run``, each run followed by the rows (``halo``) that come next."""
    ends = _upper_ends(df, partitions(df.sparkSession))
    at_ends = np.array(ends, np.int64)
    count = max(len(ends), 1)

    def deal(batches):
        for batch in batches:
            ids = batch.column("doc_id")
            known = ids.is_valid().to_numpy(zero_copy_only=False)
            values = ids.fill_null(0).to_numpy()
            run = np.where(known, np.searchsorted(at_ends, values), 0)
            again = np.flatnonzero(known & (at_ends[np.minimum(run, count - 1)] == values)) if len(ends) else np.zeros(0, np.int64)
            rows = np.concatenate([np.arange(len(values)), again])
            halo = np.arange(len(rows)) >= len(values)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate([run, (run[again] + 1) % count]), pa.int32()),
                    pa.array(halo),
                    ids.take(pa.array(rows)),
                    batch.column("text").take(pa.array(rows)),
                ],
                ["run", "halo", "doc_id", "text"],
            )

    dealt = df.select("doc_id", "text").mapInArrow(deal, "run int, halo boolean, doc_id long, text string")
    order = [F.col("run"), F.col("halo"), F.col("doc_id").desc_nulls_last(), F.col("text").asc_nulls_first()]
    return dealt.repartitionById(count, F.col("run")).sortWithinPartitions(*order)


def edited(text: str, following: str) -> str:
    """``text`` with its last third replaced by the start of ``following``."""
    n = len(text) // 3
    return text[: len(text) - n] + following[:n]


def against_next(df: DataFrame, k: int = K, window: int = WINDOW) -> DataFrame:
    """Every text's fingerprint, its edited text's, and their likenesses."""
    names = ("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "kept")

    def row(doc, text, own, following, its):
        changed = edited(text, following)
        other = Fingerprint(changed, k, window)
        return (
            doc, len(text), hashlib.sha256(changed.encode("utf-8", "surrogatepass")).hexdigest(),
            own.digest(), other.digest(), likeness(own.kinds, other.kinds), likeness(own.kinds, its.kinds), len(own.hashes),
        )

    def run(batches):
        # The row that waits for its follower, and the first row of the run.
        waiting = first = None
        for batch in batches:
            out = []
            for number, halo, doc, text in zip(
                batch.column("run").to_pylist(), batch.column("halo").to_pylist(),
                batch.column("doc_id").to_pylist(), strings(batch.column("text")),
            ):
                if first is not None and number != first[0]:
                    if waiting is not None:
                        out.append(row(*waiting, *first[1:]))
                    waiting = first = None
                if halo and waiting is None:
                    continue
                own = Fingerprint(text, k, window)
                if waiting is not None:
                    out.append(row(*waiting, text, own))
                if first is None:
                    first = (number, text, own)
                waiting = None if halo else (doc, text, own)
            yield _table(out, names)
        if waiting is not None:
            yield _table([row(*waiting, *first[1:])], names)

    return in_runs(df).mapInArrow(
        run,
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double, kept long",
    )


def _table(rows: list[tuple], names: tuple[str, ...]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64(), pa.int64()]
    columns = list(zip(*rows)) if rows else [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], list(names))


def op1_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited text."""
    return against_next(table(spark, sf_dir, "documents"))
