"""Byte-level BPE: long texts are cut into overlapping chunks, pre-tokenised in parallel,
stitched where the chunks' pre-token boundaries meet again, and the pieces encoded.

A match of the pre-token pattern depends only on what follows its start, so two chunks that
share one boundary agree from there on. Chunk k therefore takes over from chunk k-1 at the
first boundary that both see in their overlap; where they share none (one run longer than
the overlap) the chunks are joined and encoded as one. Ids of the pieces are the ids of the
whole text. Decoding concatenates the raw bytes of the ids, so a piece may end inside a
character.

Cases: a null or empty text has no ids; repeated rows give repeated results; other columns
are ignored; an empty table gives an empty table; ids of the documents may be null.
"""

from __future__ import annotations

import base64
from array import array

import public_tokenizers
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rulspark.llm.arrow import binaries, filled, held, slices, strings
from rulspark.llm.shared import table

RANKS = "byte_bpe_multi_50k.tiktoken"
# Code points of a chunk, and how far it reaches into the next one.
CHUNK, OVERLAP = 32_768, 1_024
# Pre-tokens ending this close to a chunk's end may go on in the next chunk.
MARGIN = 16


def encoding(path: str, pattern: str) -> tiktoken.Encoding:
    return held(("ranks", path, pattern), lambda: load_ranks(path, pattern))


def load_ranks(path: str, pattern: str) -> tiktoken.Encoding:
    """A tokenizer from a rank file; nothing is trained or downloaded."""
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def little_endian(ids: list[int]) -> bytes:
    return array("I", ids).tobytes()


def encode(
    df: DataFrame,
    path: str | None = None,
    pattern: str = public_tokenizers.PATTERN,
    doc_id: str = "doc_id",
    text: str = "text",
    chunk: int = CHUNK,
    overlap: int = OVERLAP,
) -> DataFrame:
    """``doc_id``, ``ids`` (unsigned 32-bit little-endian) and ``decoded`` bytes per row."""
    if overlap <= 2 * MARGIN or chunk <= overlap:
        raise ValueError("a chunk must be longer than its overlap, and that than the margin")
    path = path or public_tokenizers.path(RANKS)
    rows = df.select(
        F.col(doc_id).alias("doc_id"),
        F.col(text).alias("text"),
        F.monotonically_increasing_id().alias("row"),
    )
    size = F.coalesce(F.length("text"), F.lit(0))
    short = rows.where(size <= chunk).select("doc_id", "text")
    id_type = dict(df.select(F.col(doc_id).alias("doc_id")).dtypes)["doc_id"]
    schema = f"doc_id {id_type}, ids binary, decoded binary"

    def whole(batches):
        enc = encoding(path, pattern)
        for batch in batches:
            column = batch.column("text")
            for start, stop in slices(filled(column)):
                ids, raw = [], []
                for one in strings(column.slice(start, stop - start)):
                    got = enc.encode_ordinary(one)
                    ids.append(little_endian(got))
                    raw.append(enc.decode_bytes(got))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(start, stop - start), binaries(ids), binaries(raw)],
                    ["doc_id", "ids", "decoded"],
                )

    direct = short.mapInArrow(whole, schema)
    long = rows.where(size > chunk)
    return direct.unionByName(_encode_long(long, path, pattern, id_type, chunk, overlap))


def _encode_long(long, path, pattern, id_type, chunk, overlap) -> DataFrame:
    """The same for long texts: chunks in parallel, stitched, encoded in parallel, joined."""

    def cut(batches):
        for batch in batches:
            for doc, row, one in zip(batch.column("doc_id").to_pylist(), batch.column("row").to_pylist(), strings(batch.column("text"))):
                for part, start in enumerate(range(0, len(one), chunk)):
                    piece = one[start : start + chunk + overlap]
                    last = start + chunk + overlap >= len(one)
                    yield pa.RecordBatch.from_pydict(
                        {"doc_id": [doc], "row": [row], "part": [part], "start": [start], "text": [piece]},
                        schema=arrow_cut,
                    )
                    if last:
                        break

    def pre_tokenise(batches):
        for batch in batches:
            heads, tails = [], []
            for part, start, one in zip(batch.column("part").to_pylist(), batch.column("start").to_pylist(), strings(batch.column("text"))):
                head, tail = boundaries(one, pattern, chunk, overlap)
                heads.append([start + p for p in head] if part else [])
                tails.append([start + p for p in tail])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(heads, pa.list_(pa.int64())), pa.array(tails, pa.list_(pa.int64()))],
                [*batch.schema.names, "head", "tail"],
            )

    arrow_id = pa.int64() if id_type == "bigint" else pa.int32() if id_type == "int" else pa.string()
    arrow_cut = pa.schema([("doc_id", arrow_id), ("row", pa.int64()), ("part", pa.int64()), ("start", pa.int64()), ("text", pa.string())])
    fields = f"doc_id {id_type}, row long, part long, start long, text string"
    chunks = long.select("doc_id", "row", "text").mapInArrow(cut, fields).repartition("row", "part")
    seen = chunks.mapInArrow(pre_tokenise, f"{fields}, head array<long>, tail array<long>")
    order = Window.partitionBy("row").orderBy("part")
    shared = F.array_min(F.array_intersect("head", F.lag("tail").over(order)))
    stitched = (
        seen.withColumn("sync", F.when(F.col("part") == 0, F.lit(0)).otherwise(shared))
        .withColumn("island", F.count("sync").over(order))
        .withColumn("until", F.lead("sync").over(order))
        .drop("head", "tail")
    )

    def encode_island(pdf):
        pdf = pdf.sort_values("part")
        starts, texts = pdf["start"].tolist(), pdf["text"].tolist()
        joined = "".join(t[: b - a] for t, a, b in zip(texts, starts, [*starts[1:], starts[-1] + len(texts[-1])]))
        end = pdf["until"].iloc[-1]
        begin = int(pdf["sync"].iloc[0]) - starts[0]
        stop = len(joined) if end != end or end is None else int(end) - starts[0]
        enc = encoding(path, pattern)
        ids = enc.encode_ordinary(joined[begin:stop])
        out = pdf.iloc[:1][["doc_id", "row", "island"]].copy()
        out["ids"], out["raw"] = [little_endian(ids)], [enc.decode_bytes(ids)]
        return out

    pieces = stitched.groupBy("row", "island").applyInPandas(
        encode_island, f"doc_id {id_type}, row long, island long, ids binary, raw binary"
    )

    def join_pieces(pdf):
        pdf = pdf.sort_values("island")
        out = pdf.iloc[:1][["doc_id"]].copy()
        out["ids"], out["decoded"] = [b"".join(pdf["ids"])], [b"".join(pdf["raw"])]
        return out

    return pieces.groupBy("row").applyInPandas(join_pieces, f"doc_id {id_type}, ids binary, decoded binary")


def boundaries(one: str, pattern: str, chunk: int, overlap: int) -> tuple[list[int], list[int]]:
    """Pre-token starts in a chunk's first ``overlap`` code points, and the certain ones
    after its first ``chunk``.

    Preferred are those between a visible ASCII character and a space, on which every
    version of the Unicode tables agrees; others serve where a chunk has none of these.
    """
    end = len(one) - MARGIN
    while end > 0 and one[end - 1].isspace():
        end -= 1
    found = [m.start() for m in regex.finditer(pattern, one)]
    return _preferred(one, found, 1, overlap), _preferred(one, found, chunk, end)


def _preferred(one: str, found: list[int], low: int, high: int) -> list[int]:
    inside = [p for p in found if low <= p < high]
    clear = [p for p in inside if one[p] == " " and "!" <= one[p - 1] <= "~"]
    return clear or inside


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids and decoded bytes of every document, as digests."""
    coded = encode(table(spark, sf_dir, "documents"))
    return coded.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
