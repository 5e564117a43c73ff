"""Toxicity: averaged subword embeddings into a linear softmax, trained jointly in numpy.

A word is a bag of its byte n-grams, with its borders as spaces; n-grams are hashed into
buckets, each with a vector, so an unseen misspelling shares most vectors with the word it
came from. A passage of ``PASSAGE`` words is the average of its vectors, and a linear
softmax gives its class. A document is as toxic as its worst passage, so that a few words in
a long text are not averaged away.
Vectors and softmax are trained together, first on all passages of a labelled
document, then on its worst one.

Since the softmax is linear, a bucket's vector enters a score through one number, its
product with the difference of the two class weights; scoring sums that number over the
whole text. Training reads a bounded sample of labelled rows of any length, drawn by hashed
id until a class has its rows or its bytes; calibration
weights both classes back to all their labelled rows, so that a score means the same however
many rows were drawn.

Cases: a null or empty text has no n-gram and gets the score of the bias alone; without
labels of both kinds every score is the share of ones (0 if there are none); rows with a
null id are scored but never learned from; several labels of one document count as their
majority; repeated rows are scored each; other columns are ignored; an empty table gives an
empty table.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rulspark.llm.arrow import filled, flat, slices
from rulspark.llm.shared import fixed, fold, one_label, ready, table
from rulspark.llm.words import word_spans

NGRAMS = (4, 5, 6)
BUCKET_BITS, DIMENSIONS = 17, 8
PASSAGE = 8
THRESHOLD = 0.7
HELD_OUT = 1
# Bound of the labelled sample: rows of each class, and bytes of all their texts.
TOXIC_ROWS, CLEAN_ROWS = 1_500, 3_500
TOXIC_BYTES, CLEAN_BYTES = 6_000_000, 14_000_000
EPOCHS, WARM_UP, BATCH, SEED = 6, 2, 50, 5
CALIBRATE = 5
# Step size of the vectors and, as a share of it, of the softmax; averages are multiplied by
# GAIN, so that a few words of a passage can decide it.
RATE, HEAD, GAIN = 80.0, 0.001, float(PASSAGE)
# N-grams whose vectors a gradient step holds at a time.
HELD_GRAMS = 1_000_000
# Log odds before any word is seen, and how fast vectors shrink.
PRIOR, DECAY = -3.0, 3e-5


def _folded() -> np.ndarray:
    out = np.arange(256, dtype=np.uint8)
    out[65:91] += 32
    out[[9, 10, 11, 12, 13]] = 32
    return out


FOLDED = _folded()


@dataclass
class Grams:
    """N-grams of many texts. ``passages``: where each text's passages begin (one more at
    the end); ``starts``: where each passage begins in the padded bytes."""

    data: np.ndarray
    passages: np.ndarray
    starts: np.ndarray

    def buckets(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Bucket of the window at each place, and whether it lies in one word."""
        data, size = self.data, len(self.data) - n + 1
        if size <= 0:
            return np.zeros(0, np.uint32), np.zeros(0, bool)
        h = np.full(size, n * 0x9E3779B1 & 0xFFFFFFFF, np.uint32)
        inner = np.ones(size, bool)
        space = data == 32
        for i in range(n):
            h *= np.uint32(0x01000193)
            h ^= data[i : i + size]
            if 0 < i < n - 1:
                inner &= ~space[i : i + size]
        h ^= h >> np.uint32(15)
        h *= np.uint32(0x85EBCA6B)
        h ^= h >> np.uint32(13)
        h *= np.uint32(0xC2B2AE35)
        return h >> np.uint32(32 - BUCKET_BITS), inner

    def sums(self, values: np.ndarray) -> np.ndarray:
        """Sum of ``values`` (one per place) in each passage."""
        total = np.zeros(len(values) + 1)
        np.cumsum(values, out=total[1:])
        ends = np.minimum(np.append(self.starts[1:], len(values)), len(values))
        return total[ends] - total[np.minimum(self.starts, len(values))]


def grams(texts: pa.Array) -> Grams:
    data, bounds = flat(texts)
    n, sizes = len(texts), np.diff(bounds)
    # One space before every text and one after the last.
    padded = np.full(len(data) + n + 1, 32, np.uint8)
    padded[np.arange(len(data)) + np.repeat(np.arange(1, n + 1), sizes)] = FOLDED[data]
    edges = bounds + np.arange(n + 1)
    first, _ = word_spans(padded, np.array([0, len(padded)]))
    words = np.searchsorted(first, edges)
    count = np.diff(words)
    per_text = np.maximum(-(-count // PASSAGE), 1)
    passages = np.concatenate([[0], np.cumsum(per_text)])
    inside = np.arange(passages[-1]) - np.repeat(passages[:-1], per_text)
    places = np.repeat(words[:-1], per_text) + inside * PASSAGE
    # A passage begins at the space before its first word; a text's first one at its edge.
    starts = np.where(inside == 0, np.repeat(edges[:-1], per_text), first[np.minimum(places, len(first) - 1)] - 1 if len(first) else 0)
    return Grams(padded, passages, starts)


@dataclass(frozen=True)
class Classifier:
    weight: np.ndarray
    bias: float

    def logits(self, texts: pa.Array) -> np.ndarray:
        """Log odds of each text's worst passage."""
        if not len(texts):
            return np.zeros(0)
        got = grams(texts)
        total, count = np.zeros(len(got.starts)), np.zeros(len(got.starts))
        for n in NGRAMS:
            bucket, inside = got.buckets(n)
            total += got.sums(self.weight[bucket] * inside)
            count += got.sums(inside)
        logit = total / np.maximum(count, 1) + self.bias
        return np.maximum.reduceat(logit, got.passages[:-1])

    def score(self, texts: pa.Array) -> np.ndarray:
        """Probability of the toxic class."""
        return 1 / (1 + np.exp(-np.clip(self.logits(texts), -60, 60)))

    def calibrated(self, texts: pa.Array, labels: np.ndarray, stands: np.ndarray | None = None) -> "Classifier":
        """Log odds moved along a line that fits texts which training has not seen.
        ``stands``: for how many labelled rows each text stands, one unless given."""
        x = self.logits(texts)
        each = np.ones(len(x)) if stands is None else stands / stands.mean()
        ones, zeros = labels.sum(), (1 - labels).sum()
        if not ones or not zeros:
            return self
        # Platt's targets keep the line finite where the classes do not overlap.
        y = np.where(labels > 0, (ones + 1) / (ones + 2), 1 / (zeros + 2))
        # The best line is found in steps that never raise the loss, over logits of spread one.
        middle, spread = x.mean(), max(float(x.std()), 1e-9)
        design = np.column_stack([(x - middle) / spread, np.ones(len(x))])
        share = np.average(y, weights=each)
        line = np.array([0.0, np.log(share / (1 - share))])

        def loss(at):
            return (each * (np.logaddexp(0, design @ at) - y * (design @ at))).sum() + 5e-7 * at[0] ** 2

        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(design @ line, -60, 60)))
            curve = design.T @ (design * (each * p * (1 - p))[:, None]) + 1e-6 * np.eye(2)
            step = np.linalg.solve(curve, design.T @ (each * (p - y)) + [1e-6 * line[0], 0.0])
            while loss(line - step) > loss(line) and np.abs(step).max() > 1e-9:
                step = step / 2
            line = line - step
        slope = line[0] / spread
        if not np.isfinite(line).all() or slope <= 0:
            # No order to learn from: only the classes' ratio is put right.
            ratio = np.average(labels > 0, weights=each) / np.average(labels > 0)
            rest = np.average(labels <= 0, weights=each) / np.average(labels <= 0)
            return Classifier(self.weight, float(self.bias + np.log(ratio / rest)))
        return Classifier((self.weight * slope).astype(np.float32), float(self.bias * slope + line[1] - middle * slope))


def train(texts: list[str], labels: np.ndarray) -> Classifier:
    """Vectors and softmax from whole texts and their classes (0 or 1)."""
    got = grams(filled(pa.array(texts, pa.large_string())))
    # For every passage its buckets, one passage after the other; within it by length of the
    # n-gram. Placed rather than sorted, which would take several times the memory.
    counts = []
    for n in NGRAMS:
        _, inside = got.buckets(n)
        counts.append(got.sums(inside).astype(np.int64))
    bounds = np.concatenate([[0], np.cumsum(np.sum(counts, axis=0))])
    buckets = np.empty(bounds[-1], np.int32)
    begins = bounds[:-1].copy()
    for n, count in zip(NGRAMS, counts):
        bucket, inside = got.buckets(n)
        shift = (begins - np.concatenate([[0], np.cumsum(count)[:-1]])).astype(np.int32)
        buckets[np.arange(count.sum(), dtype=np.int32) + np.repeat(shift, count)] = bucket[inside]
        begins += count

    draw = np.random.default_rng(SEED)
    size = 1 << BUCKET_BITS
    vectors = (draw.uniform(-1, 1, (size, DIMENSIONS)) / DIMENSIONS).astype(np.float32)
    softmax = draw.normal(0, 0.5, (DIMENSIONS, 2)).astype(np.float32)
    bias = np.array([-PRIOR / 2, PRIOR / 2], np.float32)
    docs = np.arange(len(texts))
    for epoch in range(EPOCHS):
        draw.shuffle(docs)
        for begin in range(0, len(docs), BATCH):
            # Falls to zero over all steps. Plain gradient steps: a bucket moves as often as
            # it is seen, so rare ones keep near their start.
            rate = RATE * (1 - (epoch + begin / len(docs)) / EPOCHS)
            chosen = docs[begin : begin + BATCH]
            rows = [np.arange(got.passages[d], got.passages[d + 1]) for d in chosen]
            sizes = np.array([len(r) for r in rows])
            passage = np.concatenate(rows)
            sums = bounds[passage + 1] - bounds[passage]
            # Long texts are averaged, and their vectors moved, in several parts.
            parts = np.flatnonzero(np.diff(np.cumsum(sums) // HELD_GRAMS, prepend=0)) if sums.sum() > HELD_GRAMS else []
            parts = np.split(np.arange(len(passage)), parts)
            hidden = np.concatenate([_average(vectors, buckets, bounds, passage[part])[0] for part in parts])
            logits = hidden @ softmax + bias
            toxic = logits[:, 1] - logits[:, 0]
            firsts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
            weight = np.zeros(len(passage), np.float32)
            if epoch < WARM_UP:
                weight[:] = np.repeat(1 / sizes, sizes)
            else:
                top = np.maximum.reduceat(toxic, firsts)
                worst = np.flatnonzero(toxic == np.repeat(top, sizes))
                # Every passage of a clean text is clean; of a toxic one the worst is toxic.
                weight[:] = np.repeat((1 - labels[chosen]) / sizes, sizes)
                weight[worst[np.searchsorted(worst, firsts)]] += 1
            target = np.repeat(labels[chosen], sizes)
            toxic_share = 1 / (1 + np.exp(-np.clip(toxic, -60, 60)))
            slope = ((toxic_share - target) * weight / len(chosen)).astype(np.float32)
            towards = np.column_stack([-slope, slope])
            back = towards @ softmax.T * GAIN
            vectors *= 1 - rate * DECAY
            for part in parts:
                part = part[weight[part] > 0]
                counts, which = _places(buckets, bounds, passage[part])
                each = np.repeat(back[part] / np.maximum(counts, 1)[:, None], counts, axis=0)
                for d in range(DIMENSIONS):
                    vectors[:, d] -= rate * np.bincount(which, weights=each[:, d], minlength=size).astype(np.float32)
            softmax -= rate * HEAD * (hidden.T @ towards)
            bias -= rate * HEAD * towards.sum(axis=0)
    weight = (vectors @ (softmax[:, 1] - softmax[:, 0]) * GAIN).astype(np.float32)
    return Classifier(weight, float(bias[1] - bias[0]))


def _places(buckets, bounds, passage):
    """How many buckets each passage has, and these."""
    counts = bounds[passage + 1] - bounds[passage]
    begins = np.cumsum(counts) - counts
    return counts, buckets[np.arange(counts.sum()) + np.repeat(bounds[passage] - begins, counts)]


def _average(vectors, buckets, bounds, passage):
    """Mean vector of each passage times ``GAIN``, its buckets, and how many each has."""
    counts, idx = _places(buckets, bounds, passage)
    begins = np.cumsum(counts) - counts
    out = np.zeros((len(passage), vectors.shape[1]), np.float32)
    some = counts > 0
    if some.any():
        out[some] = np.add.reduceat(vectors[idx], begins[some], axis=0) * (GAIN / counts[some, None])
    return out, idx, counts


def sample(
    docs: DataFrame, labels: DataFrame, rows: dict[int, int] | None = None, size: dict[int, int] | None = None
) -> tuple[list[tuple[str, int]], dict[int, float]]:
    """(text, label) of a bounded number of rows and bytes of each class, outside the held-out
    fold, and for how many labelled rows each of a class stands.

    Rows are taken whole by hashed id, whatever their length; only a text that is longer than
    the bytes of its class is cut there, and it comes alone.
    """
    want, most = rows or {1: TOXIC_ROWS, 0: CLEAN_ROWS}, size or {1: TOXIC_BYTES, 0: CLEAN_BYTES}
    taught = one_label(labels, "toxic").where(fold(F.col("doc_id"), 3) != HELD_OUT)
    ticket = F.pmod(F.xxhash64("doc_id", F.lit("toxicity sample")), F.lit(1 << 30))
    texts = docs.where("text IS NOT NULL").select("doc_id", "text")
    lengths = texts.select("doc_id", F.octet_length("text").alias("bytes"))
    known = fixed(lengths.join(taught, "doc_id").select("doc_id", "_label", "bytes", ticket.alias("ticket")))
    have = {int(r["_label"]): r["n"] for r in known.groupBy("_label").agg(F.count("*").alias("n")).collect()}
    if len(have) < 2:
        return [("", k) for k in have], {k: float(n) for k, n in have.items()}
    bar = F.lit(0)
    for k, n in have.items():
        # A quarter more than wanted, so that hardly ever fewer are found.
        bar = F.when(F.col("_label") == k, F.lit(int(min(1.0, (1.25 * want[k] + 50) / n) * (1 << 30)))).otherwise(bar)
    # At most about as many ids and sizes as the bar lets through.
    drawn = known.where(F.col("ticket") < bar).select("_label", "ticket", "doc_id", "bytes").collect()
    chosen, stands = [], {}
    for k in (1, 0):
        mine = sorted((r["ticket"], r["doc_id"], r["bytes"]) for r in drawn if int(r["_label"]) == k)[: want[k]]
        within = int(np.searchsorted(np.cumsum([m[2] for m in mine]), most[k], side="right"))
        mine = mine[: max(within, 1)]
        chosen += [(t, d, k, most[k]) for t, d in dict.fromkeys(m[:2] for m in mine)]
        stands[k] = have[k] / max(len(mine), 1)
    kind = docs.schema["doc_id"].dataType.simpleString()
    ids = docs.sparkSession.createDataFrame(chosen, f"ticket long, doc_id {kind}, k int, most int")
    whole = F.when(F.octet_length("text") > F.col("most"), F.substring("text", F.lit(1), F.col("most"))).otherwise(F.col("text"))
    found = texts.join(F.broadcast(ids), "doc_id").select("k", "ticket", whole.alias("text")).collect()
    return [(text, k) for k, _, text in sorted(found, key=lambda r: (-r["k"], r["ticket"], r["text"]))], stands


def learned(
    docs: DataFrame, labels: DataFrame, rows: dict[int, int] | None = None, size: dict[int, int] | None = None
) -> Classifier:
    drawn, stands = sample(docs, labels, rows, size)
    kinds = {k for _, k in drawn}
    if len(kinds) < 2:
        share = 1.0 if kinds == {1} else 0.0
        return Classifier(np.zeros(1 << BUCKET_BITS, np.float32), 60.0 if share else -60.0)
    # Every fifth row of a class calibrates.
    place = {1: 0, 0: sum(k for _, k in drawn)}
    held, taught = [], []
    for i, (text, k) in enumerate(drawn):
        (taught if (i - place[k]) % CALIBRATE else held).append((text, k))
    if len({k for _, k in taught}) < 2:
        taught = drawn
    model = train([t for t, _ in taught], np.array([k for _, k in taught], np.float32))
    texts, classes = filled(pa.array([t for t, _ in held], pa.large_string())), np.array([k for _, k in held], np.float32)
    # A class stands for its rows here, not for its share of those held back.
    count = {k: sum(c == k for _, c in drawn) / max(sum(c == k for _, c in held), 1) for k in kinds}
    return model.calibrated(texts, classes, np.array([stands[k] * count[k] for _, k in held]))


def score(df: DataFrame, model: Classifier, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``score`` beside the columns ``keep``. The model is one number per bucket."""
    spark = df.sparkSession
    ready(spark)
    sent = spark.sparkContext.broadcast(model)
    fields = ", ".join(f"`{k}` {df.schema[k].dataType.simpleString()}" for k in keep)

    def run(batches):
        for batch in batches:
            column = filled(batch.column("text"))
            for start, stop in slices(column):
                got = sent.value.score(column.slice(start, stop - start))
                yield pa.RecordBatch.from_arrays(
                    [*[batch.column(k).slice(start, stop - start) for k in keep], pa.array(got, pa.float64())],
                    [*keep, "score"],
                )

    return df.select(*dict.fromkeys([*keep, "text"])).mapInArrow(run, f"{fields}, score double")


def op6_subword_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learned from two thirds of the labelled ones."""
    docs = table(spark, sf_dir, "documents")
    scored = score(docs, learned(docs, table(spark, sf_dir, "labels")))
    return scored.select(
        "doc_id",
        (fold(F.col("doc_id"), 3) == HELD_OUT).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
