"""Alignment of two tokenizers' vocabularies by inverted bitmaps of id pairs.

Tokenizer A is a byte-level BPE rank file, B a SentencePiece model. Byte offsets of a text
(with a space before it) where tokens of both end cut it into groups; every A and B token of
a group are linked.

* **Documents.** Neither tokenizer has a token that runs from visible characters into a
  following space, so a text is cut there into segments whose tokens, groups and links do not
  depend on their neighbours; a worker keeps those it met. A SentencePiece model with such a
  piece is used on whole texts.
* **Inverted bitmaps.** For each pair and each chunk of 65,536 document numbers there is a
  compressed bitmap of the documents that hold the pair linked: sorted 16-bit offsets, or
  8,192 bytes of bits from 4,096 documents on. Beside it lie multiplicity planes: plane k
  holds the documents where bit k - 1 of the number of links beyond the first is set.
* **Counts.** Bitmaps of one pair, chunk and plane from different tasks are OR-merged. Their
  popcounts give a pair's documents, and, weighted by plane, its links. A pair that is in
  every document is many chunks, so no task gathers a pair.
* **Scores.** The merged postings, each with its pair's count and whether that count is the
  highest of its A id, go to the task of their chunk, which adds them up for its documents.

Cases: a null or empty text, and one that a tokenizer does not give back byte for byte, has
no tokens and counts zero; repeated rows are documents of their own; ids may be null; other
columns are ignored; an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rulspark.llm.arrow import by_text, filled, held, release, slices, strings
from rulspark.llm.bpe import load_ranks
from rulspark.llm.shared import table
from rulspark.session import scratch_path

RANKS, PIECES = "byte_bpe_50k.tiktoken", "piece_bpe_32k.model"
# A pair's number is the A id times this, plus the B id.
WIDTH = 1 << 20
CHUNK_BITS = 16
CHUNK = 1 << CHUNK_BITS
# Documents of a chunk from which bits are smaller than offsets.
DENSE = 4096
DENSE_BYTES = CHUNK // 8
# Segments that a worker keeps, and bytes of their links and groups.
SEGMENTS, SEGMENT_BYTES = 400_000, 48 << 20
# Postings that a task gathers before it writes their bitmaps.
POSTINGS = 1_000_000
# Bits that are opened at once.
OPEN_BITS = 1 << 20
BORDER = re.compile(r"(?<=\S)(?= )")
PLACEHOLDER = "▁"


class Segments:
    """Tokens, groups and links of segments, by number, as flat arrays."""

    def __init__(self, ranks: str, pieces: str, pattern: str):
        self.enc = load_ranks(ranks, pattern)
        self.sizes = {i: len(self.enc.decode_single_token_bytes(i)) for i in range(self.enc.n_vocab) if self._known(i)}
        self.model = sentencepiece.SentencePieceProcessor(model_file=pieces)
        n = self.model.get_piece_size()
        if max(n, self.enc.n_vocab) > WIDTH:
            raise ValueError(f"vocabularies of more than {WIDTH} ids")
        self.bytes_of = [self._bytes(i) for i in range(n)]
        self.lengths = [len(x) for x in self.bytes_of]
        names = [self.model.id_to_piece(i) for i in range(n)]
        self.apart = not any(PLACEHOLDER in name.lstrip(PLACEHOLDER) for name in names)
        self.lone_space = self.model.piece_to_id(PLACEHOLDER)
        self.clear()

    def _known(self, i: int) -> bool:
        try:
            self.enc.decode_single_token_bytes(i)
        except KeyError:
            return False
        return True

    def _bytes(self, i: int) -> bytes:
        name = self.model.id_to_piece(i)
        if self.model.is_byte(i):
            return bytes([int(name[3:5], 16)])
        return name.replace(PLACEHOLDER, " ").encode()

    def clear(self) -> None:
        self.numbers: dict[str, int] = {}
        self.counts = array("q")  # A tokens, B tokens, groups, links, whether bytes agree
        self.groups: list[bytes] = []
        self.pairs, self.ends = array("q"), array("q", [0])
        self.held_bytes = 0

    def make_room(self) -> None:
        if len(self.numbers) > SEGMENTS or self.held_bytes > SEGMENT_BYTES:
            self.clear()

    def cut(self, text: str) -> list[str]:
        """Segments of a space and the text."""
        text = " " + text
        return BORDER.split(text) if self.apart else [text]

    def numbered(self, parts: list[list[str]]) -> list[list[int]]:
        """Numbers of segments; those not met before are tokenised together."""
        known = self.numbers
        new = dict.fromkeys(s for part in parts for s in part if s not in known)
        if new:
            # The model puts a space before what it gets.
            pieces = self.model.encode([s[1:] for s in new], num_threads=1)
            for segment, b in zip(new, pieces):
                known[segment] = len(self.groups)
                self._align(segment, self.enc.encode_ordinary(segment), b if segment != " " else [self.lone_space])
        return [[known[s] for s in part] for part in parts]

    def _align(self, segment: str, a: list[int], b: list[int]) -> None:
        before = len(self.pairs)
        if b"".join([self.bytes_of[y] for y in b]) != segment.encode():
            self.counts.extend((0, 0, 0, 0, 0))
            self.groups.append(b"")
            self.ends.append(before)
            return
        sizes_a, sizes_b, pairs = self.sizes, self.lengths, self.pairs
        lines, left, right = [], [], []
        i = j = at_a = at_b = 0
        # Whichever side is behind takes its next token; where both end, a group ends.
        while i < len(a) or j < len(b):
            if at_a <= at_b:
                left.append(a[i])
                at_a += sizes_a[a[i]]
                i += 1
            else:
                right.append(b[j])
                at_b += sizes_b[b[j]]
                j += 1
            if at_a == at_b:
                if len(left) == 1 and len(right) == 1:
                    lines.append(f"{left[0]}|{right[0]}")
                    pairs.append(left[0] * WIDTH + right[0])
                else:
                    lines.append(f"{','.join(map(str, left))}|{','.join(map(str, right))}")
                    pairs.extend([x * WIDTH + y for x in left for y in right])
                left, right = [], []
        links = len(pairs) - before
        self.counts.extend((len(a), len(b), len(lines), links, 1))
        self.groups.append(";".join(lines).encode())
        self.ends.append(len(pairs))
        self.held_bytes += len(self.groups[-1]) + 8 * links + len(segment)


def containers(offsets: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """Bitmaps of sorted, distinct offsets below 65,536; ``bounds`` tell where each begins."""
    low = offsets.astype("<u2")
    sizes = np.diff(bounds)
    if not (dense := np.flatnonzero(sizes >= DENSE)).size:
        at = pa.py_buffer((bounds * 2).astype(np.int32).tobytes())
        return pa.Array.from_buffers(pa.binary(), len(sizes), [None, at, pa.py_buffer(low.tobytes())])
    bits = set(dense.tolist())
    out = []
    for i in range(len(sizes)):
        part = low[bounds[i] : bounds[i + 1]]
        if i in bits:
            plain = np.zeros(CHUNK, np.uint8)
            plain[part] = 1
            out.append(np.packbits(plain, bitorder="little").tobytes())
        else:
            out.append(part.tobytes())
    return pa.array(out, pa.binary())


def opened(bitmaps: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(number of the bitmap, offset) of all set bits."""
    bitmaps = bitmaps.cast(pa.large_binary())
    bounds = np.frombuffer(bitmaps.buffers()[1], np.int64)[bitmaps.offset : bitmaps.offset + len(bitmaps) + 1]
    sizes = np.diff(bounds)
    if not len(sizes) or not bitmaps.buffers()[2]:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    raw = np.frombuffer(bitmaps.buffers()[2], np.uint8)[bounds[0] : bounds[-1]]
    dense = np.flatnonzero(sizes == DENSE_BYTES)
    if not len(dense):
        return np.repeat(np.arange(len(sizes)), sizes // 2), raw.view("<u2").astype(np.int64)
    which, offsets = [], []
    at = bounds - bounds[0]
    bits = set(dense.tolist())
    for i in range(len(sizes)):
        part = raw[at[i] : at[i + 1]]
        found = np.flatnonzero(np.unpackbits(part, bitorder="little")) if i in bits else part.view("<u2").astype(np.int64)
        which.append(np.full(len(found), i))
        offsets.append(found)
    return np.concatenate(which), np.concatenate(offsets)


def bits_at_most(bitmaps: pa.Array) -> np.ndarray:
    """An upper bound of the set bits of each bitmap, which is not opened."""
    sizes = pc.binary_length(bitmaps).to_numpy(zero_copy_only=False).astype(np.int64)
    return np.where(sizes == DENSE_BYTES, CHUNK, sizes // 2)


POSTING = "pair long, chunk long, plane int, bits binary, docs long"


def _posting_batch(keys: list[np.ndarray], rows: np.ndarray) -> dict[str, pa.Array]:
    """Columns of ``POSTING`` from rows sorted by their keys (pair, chunk, plane), then number."""
    new = np.ones(len(rows), np.bool_)
    new[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
    first = np.flatnonzero(new)
    bounds = np.append(first, len(rows))
    pair, chunk, plane = (k[first] for k in keys)
    return {
        "pair": pa.array(pair, pa.int64()), "chunk": pa.array(chunk, pa.int64()), "plane": pa.array(plane, pa.int32()),
        "bits": containers(rows & (CHUNK - 1), bounds), "docs": pa.array(np.diff(bounds), pa.int64()),
    }


def bitmaps_of(pair: np.ndarray, row: np.ndarray, links: np.ndarray) -> dict[str, pa.Array]:
    """Columns of ``POSTING`` from distinct (pair, document number) and the number of links."""
    order = np.lexsort((row, pair))
    pair, row, more = pair[order], row[order], links[order] - 1
    planes = [(pair, row, np.zeros(len(row), np.int64))]
    for k in range(int(more.max()).bit_length() if len(more) else 0):
        has = (more >> k & 1).astype(np.bool_)
        planes.append((pair[has], row[has], np.full(int(has.sum()), k + 1)))
    pair, row, plane = (np.concatenate(x) for x in zip(*planes))
    return _posting_batch([pair, row >> CHUNK_BITS, plane], row)


DOCUMENT = ("n_a", "n_b", "n_groups", "n_links")


def aligned(df: DataFrame, ranks: str, pieces: str, pattern: str) -> DataFrame:
    """Two kinds of rows: documents (``row``, ``doc_id``, counts, ``groups_sha256``; ``pair``
    is null) and the bitmaps of the pairs of a task's documents (``row`` is null)."""
    kind = dict(df.dtypes)["doc_id"]
    fields = [
        *[(c, pa.int64()) for c in ("row", *DOCUMENT)], ("groups_sha256", pa.string()),
        ("pair", pa.int64()), ("chunk", pa.int64()), ("plane", pa.int32()), ("bits", pa.binary()), ("docs", pa.int64()),
    ]

    def full(columns: dict[str, pa.Array], id_type) -> pa.RecordBatch:
        n = len(next(iter(columns.values())))
        names = ["doc_id", *[f for f, _ in fields]]
        kinds = {"doc_id": id_type, **dict(fields)}
        return pa.RecordBatch.from_arrays([columns.get(c, pa.nulls(n, kinds[c])) for c in names], names)

    def run(batches):
        known = held(("segments", ranks, pieces, pattern), lambda: Segments(ranks, pieces, pattern))
        waiting, size, id_type = [], 0, None

        def flush():
            if waiting:
                yield full(bitmaps_of(*[np.concatenate(x) for x in zip(*waiting)]), id_type)
                waiting.clear()

        for batch in batches:
            column = filled(batch.column("text"))
            id_type = batch.column("doc_id").type
            for low, high in slices(column):
                rows = batch.column("row").slice(low, high - low).to_numpy()
                columns, postings = one_slice(known, strings(column.slice(low, high - low)), rows)
                columns["row"] = batch.column("row").slice(low, high - low)
                columns["doc_id"] = batch.column("doc_id").slice(low, high - low)
                yield full(columns, id_type)
                waiting.append(postings)
                size += len(postings[0])
                if size >= POSTINGS:
                    yield from flush()
                    size = 0
        yield from flush()

    rows = df.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
    counts = ", ".join(f"{c} long" for c in ("row", *DOCUMENT))
    return rows.mapInArrow(run, f"doc_id {kind}, {counts}, groups_sha256 string, {POSTING}")


def one_slice(known: Segments, texts: list[str], rows: np.ndarray) -> tuple[dict[str, pa.Array], tuple]:
    """Counts and digest of each text; (pair, row, links) of all."""
    known.make_room()
    parts = known.numbered([known.cut(t) if t else [] for t in texts])
    bounds = np.concatenate([[0], np.cumsum([len(p) for p in parts], dtype=np.int64)])
    flat = np.fromiter((n for p in parts for n in p), np.int64, int(bounds[-1]))
    # Views: an array that a view is of cannot grow, so none outlives this call.
    counts = np.asarray(known.counts).reshape(-1, 5)[flat]
    good = by_text(1 - counts[:, 4], bounds) == 0
    sums = [np.where(good, by_text(counts[:, i], bounds), 0) for i in range(4)]
    digests = [
        hashlib.sha256(b";".join([known.groups[n] for n in p])).hexdigest() if p and ok else ""
        for p, ok in zip(parts, good.tolist())
    ]
    # The links of all segments, each with its text.
    text = np.repeat(np.arange(len(texts)), np.diff(bounds))
    keep = good[text]
    flat, text = flat[keep], text[keep]
    ends = np.asarray(known.ends)
    length = ends[flat + 1] - ends[flat]
    step = np.arange(length.sum()) - np.repeat(np.cumsum(length) - length, length)
    pair = np.asarray(known.pairs)[np.repeat(ends[flat], length) + step]
    # Texts of a slice are fewer than 2**20, pairs below 2**40.
    both, links = np.unique(pair << 20 | np.repeat(text, length), return_counts=True)
    columns = {name: pa.array(v, pa.int64()) for name, v in zip(DOCUMENT, sums)}
    columns["groups_sha256"] = pa.array(digests, pa.string())
    return columns, (both >> 20, rows[both & ((1 << 20) - 1)], links)


def merged(postings: DataFrame) -> DataFrame:
    """OR of the bitmaps of each pair, chunk and plane, with its popcount ``docs``."""
    by = ["pair", "chunk", "plane"]
    columns = [*by, "bits", "docs"]
    ordered = postings.select(*columns).repartition("pair", "chunk").sortWithinPartitions(*by)

    def run(batches):
        release()
        rest: pa.RecordBatch | None = None

        def joined(part: pa.RecordBatch, first: np.ndarray) -> pa.RecordBatch:
            which, offset = opened(part.column("bits"))
            group = np.searchsorted(first, which, side="right") - 1
            both = np.unique(group << CHUNK_BITS | offset)
            group, offset = both >> CHUNK_BITS, both & (CHUNK - 1)
            bounds = np.searchsorted(group, np.arange(len(first) + 1))
            kept = [part.column(c).take(pa.array(first)) for c in by]
            return pa.RecordBatch.from_arrays([*kept, containers(offset, bounds), pa.array(np.diff(bounds), pa.int64())], columns)

        def merge(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            keys = [batch.column(c).to_numpy() for c in by]
            new = np.ones(batch.num_rows, np.bool_)
            new[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
            first = np.flatnonzero(new)
            sizes = np.diff(np.append(first, batch.num_rows))
            # A bitmap without another one of its key stays closed.
            alone = sizes == 1
            if alone.any():
                yield batch.take(pa.array(first[alone]))
            if alone.all():
                return
            several = batch.take(pa.array(np.flatnonzero(np.repeat(~alone, sizes))))
            sizes = sizes[~alone]
            first = np.cumsum(sizes) - sizes
            piece = np.cumsum(np.add.reduceat(bits_at_most(several.column("bits")), first)) // OPEN_BITS
            edges = [0, *(np.flatnonzero(np.diff(piece)) + 1).tolist(), len(sizes)]
            for low, high in zip(edges, edges[1:]):
                at, end = int(first[low]), int(first[high - 1] + sizes[high - 1])
                yield joined(several.slice(at, end - at), first[low:high] - at)

        for batch in batches:
            # Without Spark's notes on nulls, so that all batches have one schema.
            batch = pa.RecordBatch.from_arrays(batch.columns, columns)
            if rest is not None:
                batch = pa.Table.from_batches([rest, batch]).combine_chunks().to_batches()[0]
            if not batch.num_rows:
                continue
            # The last key may go on in the next batch.
            keys = [batch.column(c).to_numpy() for c in by]
            last = np.logical_and.reduce([k == k[-1] for k in keys])
            cut = int(np.flatnonzero(~last)[-1]) + 1 if not last.all() else 0
            if cut:
                yield from merge(batch.slice(0, cut))
            rest = batch.slice(cut)
            if cut == 0 and rest.num_rows > 1:
                rest = joined(rest, np.zeros(1, np.int64))
        if rest is not None and rest.num_rows:
            yield from merge(rest)

    return ordered.mapInArrow(run, POSTING)


def pair_counts(index: DataFrame) -> DataFrame:
    """``pair``, how many documents hold it (``docs``), its ``links``, and whether no pair of
    its A id is in more documents (``best``)."""
    weight = F.when(F.col("plane") == 0, F.col("docs")).otherwise(
        F.col("docs") * F.call_function("shiftleft", F.lit(1).cast("long"), F.col("plane") - 1)
    )
    counts = index.groupBy("pair").agg(
        F.sum(F.when(F.col("plane") == 0, F.col("docs"))).alias("docs"), F.sum(weight).alias("links")
    ).withColumn("a", F.expr(f"pair div {WIDTH}"))
    most = counts.groupBy("a").agg(F.max("docs").alias("most"))
    return counts.join(most, "a").select("pair", "docs", "links", (F.col("docs") == F.col("most")).alias("best"))


def scores(index: DataFrame, counts: DataFrame) -> DataFrame:
    """Per document number ``row``: ``n_best`` and ``count_sum`` over its links."""
    priced = index.select("pair", "chunk", "plane", "bits").join(
        counts.select("pair", F.col("docs").alias("count"), "best"), "pair"
    )
    ordered = priced.select("chunk", "plane", "bits", "count", "best").repartition("chunk").sortWithinPartitions("chunk")

    def run(batches):
        release()
        chunk, best, total, seen = None, None, None, None

        def closed():
            at = np.flatnonzero(seen)
            return pa.RecordBatch.from_arrays(
                [pa.array(at + (chunk << CHUNK_BITS)), pa.array(best[at]), pa.array(total[at])],
                ["row", "n_best", "count_sum"],
            )

        for batch in batches:
            chunks = batch.column("chunk").to_numpy()
            edges = np.flatnonzero(np.diff(chunks)) + 1
            for low, high in zip([0, *edges.tolist()], [*edges.tolist(), len(chunks)]):
                if low == high:
                    continue
                if chunk != chunks[low]:
                    if chunk is not None:
                        yield closed()
                    chunk = int(chunks[low])
                    best, total = np.zeros(CHUNK, np.int64), np.zeros(CHUNK, np.int64)
                    seen = np.zeros(CHUNK, np.bool_)
                piece = np.cumsum(bits_at_most(batch.column("bits").slice(low, high - low))) // OPEN_BITS
                cuts = [low, *(np.flatnonzero(np.diff(piece)) + 1 + low).tolist(), high]
                for start, stop in zip(cuts, cuts[1:]):
                    part = batch.slice(start, stop - start)
                    plane = part.column("plane").to_numpy().astype(np.int64)
                    weight = np.left_shift(1, np.maximum(plane - 1, 0))
                    which, offset = opened(part.column("bits"))
                    np.add.at(total, offset, (weight * part.column("count").to_numpy())[which])
                    np.add.at(best, offset, (weight * part.column("best").to_numpy(zero_copy_only=False))[which])
                    seen[offset] = True
        if chunk is not None:
            yield closed()

    return ordered.mapInArrow(run, "row long, n_best long, count_sum long")


class PairIndex:
    """Alignment of a table's texts: ``documents``, ``postings`` and ``counts``, all stored."""

    def __init__(
        self,
        df: DataFrame,
        ranks: str | None = None,
        pieces: str | None = None,
        pattern: str = public_tokenizers.PATTERN,
    ):
        spark: SparkSession = df.sparkSession
        path = scratch_path(spark, "aligned")
        aligned(
            df, ranks or public_tokenizers.path(RANKS), pieces or public_tokenizers.path(PIECES), pattern
        ).write.option("compression", "zstd").parquet(path)
        both = spark.read.parquet(path)
        self.documents = both.where("pair IS NULL").select("row", "doc_id", *DOCUMENT, "groups_sha256")
        path = scratch_path(spark, "postings")
        merged(both.where("pair IS NOT NULL")).write.option("compression", "zstd").parquet(path)
        self.postings = spark.read.parquet(path)
        self.counts = pair_counts(self.postings)

    def scored(self) -> DataFrame:
        """Every document with its counts, digest of groups, ``n_best`` and ``count_sum``."""
        found = scores(self.postings, self.counts)
        zero = F.lit(0).cast("long")
        return self.documents.join(found, "row", "left").select(
            "doc_id", *DOCUMENT, F.coalesce("n_best", zero).alias("n_best"),
            F.coalesce("count_sum", zero).alias("count_sum"), "groups_sha256",
        )


def op13_pair_bitmaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links of every document and what their pairs count over all documents."""
    return PairIndex(table(spark, sf_dir, "documents")).scored()
