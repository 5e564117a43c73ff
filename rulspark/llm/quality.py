"""Quality classifier: random Fourier features over document statistics.

Statistics of the whole text (shares of character kinds, word lengths, repetition) are
standardised and mapped to ``sqrt(2 / D) * cos(x W + b)``, whose inner products approximate
a Gaussian kernel. Ridge scores come from normal equations that every partition sums for its
own rows; partition sums are added row by row of the matrix, so what reaches the driver is
D by D numbers however many rows there are. An isotonic step function, fitted to binned
scores of rows that the ridge has not seen, turns scores into probabilities.

Cases: a null or empty text has all statistics zero and is scored as such; without labels
of both kinds every score is the share of ones (one half if there are none); a null id is
scored but never learned from; several labels of one document count as their majority;
repeated rows are scored each; other columns are ignored; an empty table gives an empty one.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rulspark.llm.arrow import filled, flat, slices
from rulspark.llm.shared import fixed, fold, one_label, table
from rulspark.llm.words import pair_hash, words_of

FEATURES, WIDTH, RIDGE, SEED = 192, 5.0, 1e-3, 11
THRESHOLD = 0.7
HELD_OUT = 2
# One in so many labelled rows calibrates instead of fitting the ridge.
CALIBRATE = 5
BINS, LOW, HIGH = 512, -0.5, 1.5

KINDS = ("lower", "upper", "digit", "space", "newline", "plain", "loud", "symbol", "pipe", "beyond")
STATISTICS = (
    *[f"share_{k}" for k in KINDS],
    "log_bytes", "log_words", "mean_word", "log_longest", "long_words", "capital_words",
    "distinct_words", "distinct_pairs", "repeated_next", "words_per_line", "top_byte",
)


def _kinds() -> np.ndarray:
    """Which kind each byte is of, as one column per kind."""
    out = np.zeros((256, len(KINDS)))
    at = {k: i for i, k in enumerate(KINDS)}
    for b in range(256):
        c = chr(b)
        if b >= 128:
            kind = "beyond"
        elif c.islower():
            kind = "lower"
        elif c.isupper():
            kind = "upper"
        elif c.isdigit():
            kind = "digit"
        elif c == "\n":
            kind = "newline"
        elif c.isspace():
            kind = "space"
        elif c in ".,;:'\"-()?":
            kind = "plain"
        elif c == "!":
            kind = "loud"
        elif c in "|<>{}[]=":
            kind = "pipe"
        else:
            kind = "symbol"
        out[b, at[kind]] = 1
    return out


KIND_OF = _kinds()


def statistics(texts: pa.Array) -> np.ndarray:
    """One row of ``STATISTICS`` per text."""
    data, bounds = flat(texts)
    n, sizes = len(texts), np.diff(bounds)
    owner = np.repeat(np.arange(n, dtype=np.int64) * 256, sizes)
    histogram = np.bincount(owner + data, minlength=n * 256).reshape(n, 256)
    size = np.maximum(sizes, 1)[:, None]
    shares = histogram @ KIND_OF / size
    words = words_of(data, bounds)
    count = np.diff(words.bounds)
    some = np.maximum(count, 1)
    length = words.ends - words.starts

    def total(values):
        return np.bincount(words.text, weights=values, minlength=n)

    def distinct(hashes, text):
        # Sorted by hash within a text, counted where the value changes.
        order = np.lexsort((hashes, text))
        h, t = hashes[order], text[order]
        new = np.ones(len(h), bool)
        new[1:] = (h[1:] != h[:-1]) | (t[1:] != t[:-1])
        return np.bincount(t[new], minlength=n)

    same_text = words.text[1:] == words.text[:-1]
    pairs = pair_hash(words.hashes[:-1], words.hashes[1:])[same_text]
    repeated = (words.hashes[1:] == words.hashes[:-1]) & same_text
    next_text = words.text[1:]
    longest = np.zeros(n)
    np.maximum.at(longest, words.text, length)
    capital = KIND_OF[data[words.starts], KINDS.index("upper")] * (length > 1)
    second = np.minimum(words.starts + 1, max(len(data) - 1, 0))
    capital = capital * (KIND_OF[data[second], KINDS.index("upper")] if len(data) else 0)
    n_pairs = np.maximum(count - 1, 1)
    return np.column_stack(
        [
            shares,
            np.log1p(sizes),
            np.log1p(count),
            total(length.astype(float)) / some,
            np.log1p(longest),
            total((length > 24).astype(float)) / some,
            total(capital) / some,
            distinct(words.hashes, words.text) / some,
            distinct(pairs, next_text[same_text]) / n_pairs,
            np.bincount(next_text[repeated], minlength=n) / some,
            np.log1p(count / (histogram[:, 10] + 1)),
            np.where(sizes > 0, np.delete(histogram, 32, axis=1).max(axis=1), 0) / size[:, 0],
        ]
    )


def with_statistics(df: DataFrame, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``stats`` beside the columns ``keep``."""
    fields = ", ".join(f"`{k}` {df.schema[k].dataType.simpleString()}" for k in keep)

    def run(batches):
        for batch in batches:
            column = filled(batch.column("text"))
            for start, stop in slices(column):
                rows = statistics(column.slice(start, stop - start))
                yield pa.RecordBatch.from_arrays(
                    [*[batch.column(k).slice(start, stop - start) for k in keep], arrays(rows)],
                    [*keep, "stats"],
                )

    return df.select(*dict.fromkeys([*keep, "text"])).mapInArrow(run, f"{fields}, stats array<double>")


def arrays(rows: np.ndarray) -> pa.Array:
    ends = np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1]
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.ascontiguousarray(rows).reshape(-1)))


def matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width)


@dataclass(frozen=True)
class Ridge:
    """A fitted scorer: standardisation, random features, weights, calibration."""

    mean: np.ndarray
    deviation: np.ndarray
    weights: np.ndarray | None
    edges: np.ndarray
    levels: np.ndarray
    seed: int = SEED

    def features(self, stats: np.ndarray) -> np.ndarray:
        x = np.clip((stats - self.mean) / self.deviation, -6, 6)
        draw = np.random.default_rng(self.seed)
        directions = draw.standard_normal((x.shape[1], FEATURES)) / WIDTH
        shift = draw.uniform(0, 2 * np.pi, FEATURES)
        z = np.sqrt(2 / FEATURES) * np.cos(x @ directions + shift)
        return np.column_stack([z, np.ones(len(z))])

    def raw(self, stats: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.zeros(len(stats))
        return self.features(stats) @ self.weights

    def score(self, stats: np.ndarray) -> np.ndarray:
        return np.clip(np.interp(self.raw(stats), self.edges, self.levels), 0.0, 1.0)


def constant(value: float, width: int) -> Ridge:
    zero = np.zeros(width)
    return Ridge(zero, zero + 1, None, np.array([0.0]), np.array([value]))


def moments(rows: DataFrame, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Mean and deviation of every statistic, from one aggregate."""
    at = [F.col("stats")[i] for i in range(width)]
    got = rows.agg(*[F.avg(a) for a in at], *[F.stddev_pop(a) for a in at]).first()
    deviation = np.array(got[width:], float)
    return np.array(got[:width], float), np.where(deviation > 1e-9, deviation, 1.0)


def normal_equations(rows: DataFrame, model: Ridge) -> np.ndarray:
    """Z'Z with Z'y as its last row, summed over all rows with ``stats`` and ``_label``."""
    width = len(model.mean)

    def sums(batches):
        total = np.zeros((FEATURES + 2, FEATURES + 1))
        for batch in batches:
            if batch.num_rows:
                z = model.features(matrix(batch.column("stats"), width))
                total[:-1] += z.T @ z
                total[-1] += batch.column("_label").to_numpy() @ z
        yield pa.RecordBatch.from_arrays([pa.array(range(len(total)), pa.int32()), arrays(total)], ["i", "values"])

    def add(pdf):
        out = pdf.iloc[:1].copy()
        out["values"] = [np.sum(np.stack(pdf["values"]), axis=0)]
        return out

    summed = rows.select("stats", "_label").mapInArrow(sums, "i int, values array<double>")
    # A group holds one row per partition.
    got = summed.groupBy("i").applyInPandas(add, "i int, values array<double>").collect()
    return np.array([r["values"] for r in sorted(got)])


def isotonic(scores: np.ndarray, ones: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators over ascending ``scores``: places and rising levels."""
    blocks: list[list[float]] = []
    for s, one, n in zip(scores, ones, counts):
        blocks.append([s, s, one, n])
        while len(blocks) > 1 and blocks[-2][2] * blocks[-1][3] >= blocks[-1][2] * blocks[-2][3]:
            _, last, one2, n2 = blocks.pop()
            blocks[-1][1] = last
            blocks[-1][2] += one2
            blocks[-1][3] += n2
    edges, levels = [], []
    for first, last, one, n in blocks:
        for edge in dict.fromkeys((first, last)):
            edges.append(edge)
            levels.append(one / n)
    return np.array(edges), np.array(levels)


def fit(rows: DataFrame, width: int) -> Ridge:
    """A scorer from rows with ``doc_id``, ``stats`` and ``_label`` (0 or 1)."""
    kinds = {r["_label"]: r["n"] for r in rows.groupBy("_label").agg(F.count("*").alias("n")).collect()}
    total = sum(kinds.values())
    if len(kinds) < 2:
        return constant(kinds.get(1.0, 0) / total if total else 0.5, width)
    lot = F.pmod(F.xxhash64(F.col("doc_id"), F.lit("calibration")), F.lit(CALIBRATE))
    part = rows.withColumn("_lot", lot)
    learn = part.where("_lot > 0")
    mean, deviation = moments(learn, width)
    if not np.isfinite(mean).all():
        return constant(kinds.get(1.0, 0) / total, width)
    model = Ridge(mean, deviation, None, np.array([0.0]), np.array([0.5]))
    system = normal_equations(learn, model)
    square, right = system[:-1], system[-1]
    n = square[-1, -1]
    penalty = np.full(len(square), RIDGE * n)
    penalty[-1] = 1e-9
    model = Ridge(mean, deviation, np.linalg.solve(square + np.diag(penalty), right), model.edges, model.levels)

    def bins(batches):
        for batch in batches:
            raw = np.clip(model.raw(matrix(batch.column("stats"), width)), LOW, HIGH)
            at = np.floor((raw - LOW) / (HIGH - LOW) * BINS).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(at), batch.column("_label")], ["bin", "_label"])

    binned = part.where("_lot = 0").select("stats", "_label").mapInArrow(bins, "bin int, _label double")
    held = sorted(binned.groupBy("bin").agg(F.sum("_label").alias("ones"), F.count("*").alias("n")).collect())
    if not held:
        return Ridge(mean, deviation, model.weights, np.array([0.0, 1.0]), np.array([0.0, 1.0]))
    at = LOW + (np.array([r["bin"] for r in held]) + 0.5) * (HIGH - LOW) / BINS
    edges, levels = isotonic(at, np.array([r["ones"] for r in held], float), np.array([r["n"] for r in held], float))
    return Ridge(mean, deviation, model.weights, edges, levels)


def judge(df: DataFrame, model: Ridge, keep: tuple[str, ...], name: str = "score") -> DataFrame:
    """``name`` beside the columns ``keep``, from texts, in one step."""
    fields = ", ".join(f"`{k}` {df.schema[k].dataType.simpleString()}" for k in keep)

    def run(batches):
        for batch in batches:
            column = filled(batch.column("text"))
            for start, stop in slices(column):
                got = model.score(statistics(column.slice(start, stop - start)))
                yield pa.RecordBatch.from_arrays(
                    [*[batch.column(k).slice(start, stop - start) for k in keep], pa.array(got, pa.float64())], [*keep, name]
                )

    return df.select(*dict.fromkeys([*keep, "text"])).mapInArrow(run, f"{fields}, `{name}` double")


def score(rows: DataFrame, model: Ridge) -> DataFrame:
    """``score`` in place of ``stats``."""
    width = len(model.mean)
    keep = [c for c in rows.columns if c != "stats"]
    fields = ", ".join(f"`{k}` {rows.schema[k].dataType.simpleString()}" for k in keep)

    def run(batches):
        for batch in batches:
            got = model.score(matrix(batch.column("stats"), width))
            yield pa.RecordBatch.from_arrays([*[batch.column(k) for k in keep], pa.array(got, pa.float64())], [*keep, "score"])

    return rows.mapInArrow(run, f"{fields}, score double")


def learned(stats: DataFrame, labels: DataFrame) -> Ridge:
    """A scorer from all labelled rows outside the held-out fold."""
    taught = stats.where(fold(F.col("doc_id"), 4) != HELD_OUT).join(one_label(labels, "quality"), "doc_id")
    return fit(fixed(taught.select("doc_id", "stats", "_label")), len(STATISTICS))


def op5_fourier_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document, learned from three quarters of the labelled ones."""
    stats = fixed(with_statistics(table(spark, sf_dir, "documents")))
    scored = score(stats, learned(stats, table(spark, sf_dir, "labels")))
    return scored.select(
        "doc_id",
        (fold(F.col("doc_id"), 4) == HELD_OUT).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
