"""Packing along a space-filling curve.

Every document's token ids are hashed into buckets, the bucket counts projected to a few
dimensions, the coordinates put on a grid by the corpus' own mean and deviation, and the
grid cell turned into a Hilbert key. Documents are range-sorted by that key and laid end to
end; every ``length`` ids make a sequence, so neighbours on the curve share sequences and
only the very last sequence has room left. A document that crosses an end is cut there.

The ids are stored once, next to their document's place in the input; only ids of rows,
keys and lengths are sorted. Partition totals (one row per task) give every row its place.

Cases: a null or empty text is its end mark alone; equal texts have equal keys and lie next
to each other, ordered by id; null ids sort first; repeated rows are packed once each; an
empty table gives no pieces.
"""

from __future__ import annotations

import json
import re
import zlib
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from tokenizers import Tokenizer

from rulspark.llm.arrow import binaries, filled, held, slices, strings
from rulspark.llm.bpe import load_ranks
from rulspark.llm.shared import fixed, ready, table
from rulspark.session import scratch_path

VOCABULARY, RANKS = "byte_bpe_50k.json", "byte_bpe_50k.tiktoken"
LENGTH, END = 2048, 1
DIMENSIONS, BITS = 4, 8
BUCKETS = 4096
# Segments whose ids one worker remembers; others are encoded anew each time.
REMEMBERED = 200_000
SPACE_BEFORE_SPACE = re.compile(r"\s ")
ASCII_SPACES = tuple(c + " " for c in "\t\n\v\f\r ")


class Segments(dict):
    """Ids of text segments as bytes. A segment is a space and what follows up to the next
    space; no pre-token crosses such a border unless white space stands on both sides."""

    def __init__(self, enc):
        self.enc = enc

    def __missing__(self, segment: str) -> bytes:
        ids = np.array(self.enc.encode_ordinary(" " + segment), np.uint16).tobytes()
        if len(self) < REMEMBERED:
            self[segment] = ids
        return ids


class Coder:
    """Ids of ``tokenizers`` for a vocabulary file, by its rank file where that is the same.

    The rank file knows no special tokens, so a text that spells one goes to the library.
    """

    def __init__(self, vocabulary: str, ranks: str, pattern: str):
        self.vocabulary, self.library = vocabulary, None
        with open(vocabulary, encoding="utf-8") as file:
            self.special = [t["content"] for t in json.load(file)["added_tokens"]]
        self.enc = load_ranks(ranks, pattern)
        self.segments = Segments(self.enc)

    def ids(self, text: str) -> bytes:
        """Unsigned 16-bit ids."""
        for mark in self.special:
            if mark in text:
                self.library = self.library or Tokenizer.from_file(self.vocabulary)
                return np.array(self.library.encode(text, add_special_tokens=False).ids, np.uint16).tobytes()
        if text.isascii():
            plain = not any(before in text for before in ASCII_SPACES)
        else:
            plain = not SPACE_BEFORE_SPACE.search(text)
        if not plain:
            return np.array(self.enc.encode_ordinary(text), np.uint16).tobytes()
        first, *rest = text.split(" ")
        known = self.segments
        head = np.array(self.enc.encode_ordinary(first), np.uint16).tobytes()
        return head + b"".join([known[s] for s in rest])


def coder(vocabulary: str, ranks: str, pattern: str) -> Coder:
    return held(("coder", vocabulary, ranks, pattern), lambda: Coder(vocabulary, ranks, pattern))


@lru_cache(maxsize=1)
def directions(seed: int = 7) -> np.ndarray:
    """Coordinates of every 16-bit id: its bucket's row of a random projection."""
    rows = np.random.default_rng(seed).standard_normal((BUCKETS, DIMENSIONS)).astype(np.float32)
    ids = np.arange(1 << 16, dtype=np.uint32)
    return rows[(ids * np.uint32(2654435761)) >> np.uint32(20)]


def hilbert_key(cells: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Place along the Hilbert curve of grid cells (rows of integers below 2**bits)."""
    x = cells.astype(np.int64).T.copy()
    n = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        p = q - 1
        for i in range(n):
            high = (x[i] & q) != 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & p)
            x[0] = np.where(high, x[0] ^ p, x[0] ^ swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    t = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        t = np.where((x[n - 1] & q) != 0, t ^ (q - 1), t)
        q >>= 1
    x ^= t
    key = np.zeros_like(x[0])
    for bit in range(bits - 1, -1, -1):
        for i in range(n):
            key = (key << 1) | ((x[i] >> bit) & 1)
    return key


def tokenise(df: DataFrame, vocabulary: str, ranks: str, pattern: str) -> DataFrame:
    """``row``, ``doc_id``, ``ids`` (unsigned 16-bit, with the end mark), their number, and
    the projected coordinates."""
    points = [f"p{i}" for i in range(DIMENSIONS)]
    id_type = dict(df.dtypes)["doc_id"]

    def run(batches):
        code, table_of = coder(vocabulary, ranks, pattern), directions()
        end = np.array([END], np.uint16).tobytes()
        for batch in batches:
            column = filled(batch.column("text"))
            for start, stop in slices(column):
                ids = [code.ids(t) + end for t in strings(column.slice(start, stop - start))]
                sizes = np.array([len(i) // 2 for i in ids])
                flat = np.frombuffer(b"".join(ids), np.uint16)
                begins = np.concatenate([[0], np.cumsum(sizes)[:-1]])
                # Divided by the root of the length, so that deviations do not shrink with it.
                spots = [
                    np.add.reduceat(table_of[:, i][flat].astype(np.float64), begins) / np.sqrt(sizes)
                    for i in range(DIMENSIONS)
                ]
                keep = [batch.column(c).slice(start, stop - start) for c in ("row", "doc_id")]
                yield pa.RecordBatch.from_arrays(
                    [*keep, binaries(ids), pa.array(sizes, pa.int64()), *[pa.array(s) for s in spots]],
                    ["row", "doc_id", "ids", "doc_tokens", *points],
                )

    rows = df.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
    fields = ", ".join(f"{p} double" for p in points)
    return rows.mapInArrow(run, f"row long, doc_id {id_type}, ids binary, doc_tokens long, {fields}")


def curve_keys(coded: DataFrame) -> DataFrame:
    """``row``, ``doc_id``, ``doc_tokens`` and Hilbert ``key``."""
    points = [f"p{i}" for i in range(DIMENSIONS)]
    spread = coded.agg(
        *[F.avg(p).alias(f"m{p}") for p in points], *[F.stddev_pop(p).alias(f"s{p}") for p in points]
    ).first()
    cells = 1 << BITS

    def cell(p: str):
        mean, deviation = spread[f"m{p}"] or 0.0, spread[f"s{p}"] or 1.0
        z = (F.col(p) - F.lit(mean)) / F.lit(deviation if deviation > 0 else 1.0)
        # A logistic curve close to the normal distribution's fills the grid evenly.
        share = F.lit(1.0) / (F.lit(1.0) + F.exp(-1.702 * z))
        return F.least(F.floor(share * cells), F.lit(cells - 1)).cast("long")

    @pandas_udf("long")
    def key(a, b, c, d):
        import pandas as pd

        return pd.Series(hilbert_key(np.stack([x.to_numpy() for x in (a, b, c, d)], axis=1)))

    return coded.select("row", "doc_id", "doc_tokens", key(*[cell(p) for p in points]).alias("key"))


def places(keys: DataFrame) -> DataFrame:
    """``row`` and ``place``: the tokens before each row along the curve."""
    spark = keys.sparkSession

    def run(batches):
        before = 0
        for batch in batches:
            sizes = batch.column("doc_tokens").to_numpy()
            ends = before + np.cumsum(sizes)
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(ends - sizes), pa.array(sizes)], ["row", "inside", "doc_tokens"]
            )
            before = int(ends[-1]) if len(ends) else before

    order = [F.col("key"), F.col("doc_id"), F.col("row")]
    sorted_rows = fixed(
        keys.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .mapInArrow(run, "row long, inside long, doc_tokens long")
        .withColumn("piece", F.spark_partition_id())
    )
    # One row per task: as many as there are shuffle partitions.
    totals = sorted(sorted_rows.groupBy("piece").agg(F.sum("doc_tokens").alias("n")).collect())
    ahead, before = [], 0
    for piece, n in totals:
        ahead.append((piece, before))
        before += n
    firsts = spark.createDataFrame(ahead, "piece int, ahead long")
    return sorted_rows.join(F.broadcast(firsts), "piece").select("row", (F.col("inside") + F.col("ahead")).alias("place"))


def pack(
    df: DataFrame,
    length: int = LENGTH,
    vocabulary: str | None = None,
    ranks: str | None = None,
    pattern: str = public_tokenizers.PATTERN,
) -> DataFrame:
    """Pieces of documents in sequences of ``length`` ids.

    Needs ``doc_id`` and ``text``. Returns ``doc_id``, ``start``, ``length``, ``ids``
    (unsigned 32-bit little-endian), ``doc_tokens``, ``sequence_id`` and ``offset``.
    """
    spark = df.sparkSession
    ready(spark)
    path = scratch_path(spark, "ids")
    tokenise(
        df,
        vocabulary or public_tokenizers.path(VOCABULARY),
        ranks or public_tokenizers.path(RANKS),
        pattern,
    ).write.option("compression", "zstd").parquet(path)
    coded = spark.read.parquet(path)
    placed = places(curve_keys(coded))
    id_type = dict(coded.dtypes)["doc_id"]

    def cut(batches):
        for batch in batches:
            out = {k: [] for k in ("start", "length", "sequence_id", "offset")}
            source, ids = [], []
            for i, (place, raw) in enumerate(zip(batch.column("place").to_pylist(), batch.column("ids"))):
                flat = np.frombuffer(raw.as_buffer(), np.uint16).astype("<u4")
                done = 0
                while done < len(flat):
                    offset = (place + done) % length
                    take = min(length - offset, len(flat) - done)
                    source.append(i)
                    ids.append(flat[done : done + take].tobytes())
                    for k, v in zip(out, (done, take, (place + done) // length, offset)):
                        out[k].append(v)
                    done += take
            at = pa.array(source, pa.int64())
            made = {k: pa.array(v, pa.int64()) for k, v in out.items()}
            kept = {k: batch.column(k).take(at) for k in ("doc_id", "doc_tokens")}
            columns = {
                "doc_id": kept["doc_id"], "start": made["start"], "length": made["length"],
                "ids": binaries(ids), "doc_tokens": kept["doc_tokens"],
                "sequence_id": made["sequence_id"], "offset": made["offset"],
            }
            yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    joined = coded.select("row", "doc_id", "doc_tokens", "ids").join(placed.hint("shuffle_hash"), "row")
    return joined.select("doc_id", "doc_tokens", "ids", "place").mapInArrow(
        cut,
        f"doc_id {id_type}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long",
    )


def op8_curve_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of every document, with the checksum of its ids."""
    return pieces_of(table(spark, sf_dir, "documents"))


def pieces_of(docs: DataFrame) -> DataFrame:
    return pack(docs.select("doc_id", "text")).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )
