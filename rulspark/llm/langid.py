"""Language ID by cross-parsing entropy.

Per language, a suffix automaton of a bounded sample of labelled text. A text is parsed from
left to right into the longest phrases that occur in the sample; c phrases over n bytes
against a sample of m bytes give the cross entropy c * log2(m) / n. The language that needs
the fewest normalised phrases wins.

Texts are read whole, in blocks of ``BLOCK`` bytes that are parsed side by side: an
automaton is a table (state, byte class) -> (next state, did a phrase begin), so one table
look-up per byte and language advances thousands of blocks at once. A phrase ends at a
block's end, for every language alike. Workers build the automata from the samples, which
are a few kilobytes each, so nothing that grows with the corpus is sent to them.

Cases: a null text and one without a letter is ``und`` with score 0; so is every text if no
row has a label; ties go to the alphabetically first language; other columns are ignored;
rows with a null id take no part in learning; an empty table gives an empty table.
"""

from __future__ import annotations

from array import array

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rulspark.llm.arrow import filled, flat, held, slices
from rulspark.llm.shared import fold, ready, table

UNKNOWN = "und"
# Bound of the labelled sample per language: passages, and bytes of each.
PASSAGES, PASSAGE_BYTES = 48, 1_000
BLOCK = 1_024
# A letter, for learning and for judging alike: Unicode's categories L, not its numbers.
LETTER = regex.compile(r"\p{L}")
# Texts from this many bytes on are foreign if they cost so many times what the dearest
# held-out passage of a known language costs.
FOREIGN_BYTES, FOREIGN_TIMES = 256, 1.5
# Rows drawn by hash before the exact choice, over the number wanted.
SPARE = 4


def samples(labelled: DataFrame, passages: int = PASSAGES, passage_bytes: int = PASSAGE_BYTES) -> dict[str, bytes]:
    """For each language a bounded sample of its labelled texts, drawn by hashed id.

    Reads one aggregate per language, then only rows whose hash falls under the share that
    the language needs, so what reaches the driver does not grow with the corpus. Where a
    language has fewer texts than passages are wanted, each gives several, from places that
    do not overlap.
    """
    known = labelled.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull())
    letters = known.where(F.col("text").rlike(r"\p{L}"))
    sizes = {r["lang"]: r["n"] for r in letters.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return {}
    bar, each = F.lit(0), F.lit(1)
    for lang, n in sizes.items():
        own = F.col("lang") == lang
        bar = F.when(own, F.lit(int(min(1.0, SPARE * passages / n) * (1 << 30)))).otherwise(bar)
        each = F.when(own, F.lit(-(-passages // n))).otherwise(each)
    ticket = F.pmod(F.xxhash64(F.col("doc_id").cast("string"), F.lit("language sample")), F.lit(1 << 30))
    drawn = letters.select("lang", ticket.alias("ticket"), "text", each.alias("each")).where(F.col("ticket") < bar)
    # A text is cut into parts of at least a passage; each part gives the passage at a place
    # that the hash chooses.
    step = F.greatest(F.expr("length(text) div each"), F.lit(passage_bytes))
    parts = drawn.withColumn("step", step).withColumn(
        "part", F.explode(F.expr("sequence(0, least(each, greatest(length(text) div step, 1)) - 1)"))
    )
    inside = F.pmod(F.col("ticket"), F.greatest(F.least("step", F.length("text")) - passage_bytes, F.lit(1)))
    at = (F.col("part") * F.col("step") + inside + 1).cast("int")
    rows = parts.select("part", "lang", "ticket", F.substring("text", at, F.lit(passage_bytes)).alias("piece")).collect()
    out: dict[str, list[bytes]] = {}
    for _, lang, _, piece in sorted(rows):
        got = out.setdefault(lang, [])
        if len(got) < passages:
            got.append(piece.encode()[:passage_bytes])
    return {lang: b"\n".join(pieces) for lang, pieces in sorted(out.items())}


def suffix_automaton(symbols: list[int], width: int) -> np.ndarray:
    """Transitions (state, symbol) -> state, -1 for none, of the smallest automaton that reads
    every substring of ``symbols``. A flat array: n symbols give at most 2n states."""
    moves = array("i", [-1]) * (2 * width * (len(symbols) + 1))
    link, length = [-1], [0]
    last = 0
    for c in symbols:
        here = len(link)
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and moves[p * width + c] < 0:
            moves[p * width + c] = here
            p = link[p]
        if p >= 0:
            q = moves[p * width + c]
            if length[p] + 1 == length[q]:
                link[here] = q
            else:
                copy = len(link)
                moves[copy * width : (copy + 1) * width] = moves[q * width : (q + 1) * width]
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and moves[p * width + c] == q:
                    moves[p * width + c] = copy
                    p = link[p]
                link[q] = link[here] = copy
        last = here
    return np.frombuffer(moves, np.int32).reshape(-1, width)[: len(link)]


class Parser:
    """All languages' automata as look-up tables over common byte classes."""

    def __init__(self, texts: tuple[tuple[str, bytes], ...]):
        self.langs = [lang for lang, _ in texts]
        folded = [text.lower() for _, text in texts]
        seen = sorted(set(b"".join(folded)))
        # The last two classes: a byte that no sample holds, and no byte at all.
        self.width = len(seen) + 2
        self.classes = np.full(256, len(seen), np.uint8 if self.width < 256 else np.int16)
        for i, b in enumerate(seen):
            self.classes[b] = i
        self.classes[65:91] = self.classes[97:123]
        self.none = len(seen) + 1
        index = np.zeros(256, np.int64)
        index[seen] = np.arange(len(seen))
        self.tables = [self._table(index[np.frombuffer(text, np.uint8)].tolist(), len(seen)) for text in folded]
        self.bits = np.array([np.log2(max(len(text), 2)) for text in folded])

    def _table(self, symbols: list[int], seen: int) -> np.ndarray:
        moves, width = suffix_automaton(symbols, seen), self.width
        root = np.zeros(width, np.int32)
        root[:seen] = np.maximum(moves[0], 0)
        # Where a phrase cannot go on, the byte begins the next one at the root.
        out = np.tile(((root * width) << 1) | 1, (len(moves), 1))
        out[:, self.none] = (np.arange(len(moves), dtype=np.int32) * width) << 1
        goes = moves >= 0
        goes[0] = False
        out[:, :seen][goes] = (moves[goes] * width) << 1
        return out.reshape(-1)

    def cost(self, data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Bits per byte of each text in each language."""
        return self.phrases(data, bounds) * self.bits / np.maximum(np.diff(bounds), 1)[:, None]

    def phrases(self, data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Phrases that each text needs in each language."""
        sizes = np.diff(bounds)
        blocks = -(-sizes // BLOCK)
        lanes = int(blocks.sum())
        if not lanes:
            return np.zeros((len(sizes), len(self.langs)), np.int64)
        # Every text is padded to whole blocks.
        first = np.concatenate([[0], np.cumsum(blocks)])
        padded = np.full(lanes * BLOCK, self.none, self.classes.dtype)
        shift = np.repeat(first[:-1] * BLOCK - bounds[:-1], sizes)
        padded[np.arange(len(data)) + shift] = self.classes[data]
        steps = np.ascontiguousarray(padded.reshape(lanes, BLOCK).T)
        states = [np.zeros(lanes, np.int32) for _ in self.langs]
        counts = [np.zeros(lanes, np.int32) for _ in self.langs]
        at, got = np.empty(lanes, np.int32), np.empty(lanes, np.int32)
        for row in steps:
            byte = row.astype(np.int32)
            for table_of, state, count in zip(self.tables, states, counts):
                np.add(state, byte, out=at)
                np.take(table_of, at, out=got, mode="clip")
                np.bitwise_and(got, 1, out=at)
                np.add(count, at, out=count)
                np.right_shift(got, 1, out=state)
        out = np.empty((len(sizes), len(self.langs)), np.int64)
        for j, count in enumerate(counts):
            total = np.concatenate([[0], np.cumsum(count, dtype=np.int64)])
            out[:, j] = total[first[1:]] - total[first[:-1]]
        return out


def parser(texts: tuple[tuple[str, bytes], ...]) -> Parser:
    return held(("parser", texts), lambda: Parser(texts))


MADE = ("lang_pred", "score", "bits_per_byte")


def identify(
    df: DataFrame, learned: dict[str, bytes], keep: list[str] | None = None, made: tuple[str, str, str] = MADE, also=()
) -> DataFrame:
    """``lang_pred``, ``score`` and ``bits_per_byte`` (or the names ``made``) beside the columns
    of ``df`` (or ``keep``); columns of these names are replaced.

    ``score`` is the share of the second best language's phrases in those of the best two:
    one half where they tie, towards 1 the clearer the choice; 0 for ``und``. ``also`` are models
    with their names, as ``judged`` takes them, that judge in the same pass.
    """
    texts = tuple(sorted(learned.items()))
    return judged(df, [(lambda: parser(texts) if texts else None, made), *also], keep)


def judged(df: DataFrame, models, keep: list[str] | None) -> DataFrame:
    """``identify`` by each of ``models``: a function that gives a worker the model, with ``langs``
    and ``cost``, the bits per byte of texts in each; and the three names."""
    ready(df.sparkSession)
    made = [n for _, three in models for n in three]
    names = [n for n in (df.columns if keep is None else keep) if n not in made]
    fields = [f"`{n}` {df.schema[n].dataType.simpleString()}" for n in names]
    fields += [f"`{n}` {kind}" for _, three in models for n, kind in zip(three, ("string", "double", "double"))]

    def run(batches):
        built = [model_of() for model_of, _ in models]
        for batch in batches:
            column = filled(batch.column("text"))
            for start, stop in slices(column):
                part = column.slice(start, stop - start)
                found = []
                for model in built:
                    lang, score, bits = judge(model, part)
                    found += [pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(bits, pa.float64())]
                yield pa.RecordBatch.from_arrays(
                    [*[batch.column(n).slice(start, stop - start) for n in names], *found], [*names, *made]
                )

    return df.mapInArrow(run, ", ".join(fields))


def judge(model, texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    lettered = np.array([LETTER.search(t) is not None for t in texts.to_pylist()], bool)
    if model is None:
        zero = np.zeros(len(texts))
        return [UNKNOWN] * len(texts), zero, zero
    data, bounds = flat(texts)
    cost = model.cost(data, bounds)
    best = cost.argmin(axis=1)
    lowest = cost[np.arange(len(cost)), best]
    if cost.shape[1] > 1:
        second = np.partition(cost, 1, axis=1)[:, 1]
        score = second / np.maximum(lowest + second, 1e-12)
    else:
        score = np.ones(len(cost))
    lang = [model.langs[b] if ok else UNKNOWN for b, ok in zip(best, lettered)]
    return lang, np.where(lettered, np.clip(score, 0.0, 1.0), 0.0), lowest


def dearest(learned: dict[str, bytes], held: dict[str, bytes], passage_bytes: int = PASSAGE_BYTES) -> float | None:
    """Bits per byte beyond which no passage of ``held``, samples of other texts, goes; None
    where there is nothing to compare."""
    known = {lang: text for lang, text in held.items() if lang in learned}
    if not known:
        return None
    model = Parser(tuple(sorted(learned.items())))
    pieces = [t[i : i + passage_bytes] for t in known.values() for i in range(0, len(t), passage_bytes + 1)]
    pieces = [p for p in pieces if len(p) >= FOREIGN_BYTES] or pieces
    data, bounds = np.frombuffer(b"".join(pieces), np.uint8), np.cumsum([0, *map(len, pieces)])
    return float(model.cost(data, bounds).min(axis=1).max())


def rejected(lang: Column, bits: Column, text: Column, most: float | None) -> Column:
    """Whether a text has no letter, or is long enough to judge and far from every language."""
    none = lang == UNKNOWN
    if most is None:
        return none
    return none | ((F.octet_length(text) >= FOREIGN_BYTES) & (bits > FOREIGN_TIMES * most))


HELD_OUT = 2


def learning_rows(docs: DataFrame) -> DataFrame:
    return docs.where(fold(F.col("doc_id"), 4) != HELD_OUT)


def op7_cross_parsing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from three quarters of the labelled ones."""
    docs = table(spark, sf_dir, "documents")
    judged = identify(docs.select("doc_id", "text"), samples(learning_rows(docs)), ["doc_id"])
    return judged.select(
        "doc_id", (fold(F.col("doc_id"), 4) == HELD_OUT).alias("held_out"), "lang_pred", "score"
    )
