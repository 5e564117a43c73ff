"""LM scoring with a bigram model in Elias-Fano tries, one per shard.

Tokens are the words of the text with A-Z lower-cased, then one end. The model smooths with
the unigram estimate p1(t) = (c(t) + 1) / (N + V + 1) as prior:

    p(t | u) = (c(u, t) + m(u) * p1(t)) / (c(u) + m(u))

with m(u) = ``PRIOR`` for most contexts and ``PRIOR + SHARE * c(u)`` for heavy ones. This sums
to 1 over the words and one unknown word, and its logarithm falls into a numerator, which
needs what is known where the *word* is stored, and a denominator, which needs the count of
the *context* as a word. So one pass sends every token to the shard of its word, and no
model, table or count of the corpus is ever gathered in one place:

1. Training words are counted by shard (packed arrays of distinct words per batch); the
   shards report N, V and the heavy tokens, at most ``HEAVY`` + 1 of them.
2. Pairs of two heavy tokens are counted in a table of at most (HEAVY + 2) squared numbers,
   which is sent to all tasks; such pairs are scored where the text is. This keeps a word or
   word pair that is everywhere out of the shuffle and out of any single shard.
3. All other tokens go, packed by batch, to the shard of their word (of their context if the
   word is heavy). A shard counts those of training documents, builds its trie over an
   anonymous memory map, looks up all its tokens, and returns sums per document.
4. Sums per document are added up.

Cases: a null or empty text is one end token; a row with a null id is scored but not learned
from and not held out; repeated rows are learned from and scored each; without any training
token p1 is 1; other columns are ignored; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rulspark.llm.arrow import filled, flat, slices
from rulspark.llm.shared import fixed, fold, partitions, ready, table
from rulspark.llm.trie import Trie, mapped, restored
from rulspark.llm.words import words_of

FOLDS, HELD_OUT = 7, 2
PRIOR, SHARE = 1_000.0, 0.5
# A token is heavy from 1 / HEAVY of all training tokens on, so there are at most so many.
HEAVY = 512
# The end of a text, and what stands before its first word.
END, BEGIN = np.uint64(1), np.uint64(2)
# Bytes of text whose tokens are packed together.
BATCH_BYTES = 12_000_000


def tokens_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, context hash and text number of every token, in order."""
    data, bounds = flat(texts)
    words = words_of(data, bounds)
    n = len(texts)
    per_text = np.diff(words.bounds) + 1
    tokens = np.full(len(words.hashes) + n, END, np.uint64)
    tokens[np.arange(len(words.hashes)) + words.text] = np.maximum(words.hashes, np.uint64(3))
    contexts = np.empty_like(tokens)
    contexts[1:] = tokens[:-1]
    contexts[np.cumsum(per_text) - per_text] = BEGIN
    return tokens, contexts, np.repeat(np.arange(n), per_text)


@dataclass
class Batch:
    """Tokens of some documents. ``doc`` numbers them; the first ``taught`` are learned from."""

    ids: pa.Array
    tokens: np.ndarray
    contexts: np.ndarray
    doc: np.ndarray
    taught: int
    lengths: np.ndarray


def batches_of(batches, only_taught: bool = False) -> Iterator[Batch]:
    """Documents in batches of bounded size, those to learn from first."""
    held, size = [], 0
    for batch in batches:
        texts = filled(batch.column("text"))
        for start, stop in slices(texts):
            part = texts.slice(start, stop - start)
            held.append((batch.column("doc_id").slice(start, stop - start), batch.column("taught").slice(start, stop - start), tokens_of(part)))
            size += len(flat(part)[0])
            if size >= BATCH_BYTES:
                yield _one_batch(held, only_taught)
                held, size = [], 0
    if held:
        yield _one_batch(held, only_taught)


def _one_batch(held, only_taught: bool) -> Batch:
    ids = pa.concat_arrays([h[0] for h in held])
    taught = np.concatenate([h[1].to_numpy(zero_copy_only=False) for h in held]).astype(bool)
    shift = np.cumsum([0, *[len(h[0]) for h in held[:-1]]])
    tokens = np.concatenate([h[2][0] for h in held])
    contexts = np.concatenate([h[2][1] for h in held])
    doc = np.concatenate([h[2][2] + s for h, s in zip(held, shift)])
    order = np.argsort(~taught, kind="stable")
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    doc, n = place[doc], int(taught.sum())
    lengths = np.bincount(doc, minlength=len(order))
    if only_taught:
        keep = doc < n
        tokens, contexts, doc = tokens[keep], contexts[keep], doc[keep]
    return Batch(ids.take(pa.array(order)), tokens, contexts, doc, n, lengths)


def shard_of(hashes: np.ndarray, shards: int) -> np.ndarray:
    return ((hashes >> np.uint64(20)) % np.uint64(shards)).astype(np.int64)


@dataclass(frozen=True)
class Common:
    """What every task knows: totals, and counts of heavy tokens and of pairs of them."""

    total: int
    distinct: int
    keys: np.ndarray
    counts: np.ndarray
    pairs: np.ndarray | None

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Number of each heavy token, -1 for any other."""
        if not len(hashes):
            return np.zeros(0, np.int64)
        at = np.minimum(np.searchsorted(self.keys, hashes), len(self.keys) - 1)
        return np.where(self.keys[at] == hashes, at, -1)

    def mass(self) -> np.ndarray:
        """m(u) of every heavy context. The begin counts as often as the end."""
        return PRIOR + SHARE * self.contexts()

    def contexts(self) -> np.ndarray:
        counts = self.counts.astype(float)
        counts[self.keys == BEGIN] = self.counts[self.keys == END][0]
        counts[self.keys == END] = 0
        return counts

    def base(self, counts: np.ndarray) -> np.ndarray:
        return (counts + 1.0) / (self.total + self.distinct + 1.0)


def _ready_rows(docs: DataFrame) -> DataFrame:
    taught = F.coalesce(fold(F.col("doc_id"), FOLDS) != HELD_OUT, F.lit(False))
    return docs.select("doc_id", taught.alias("taught"), "text")


def totals(rows: DataFrame, shards: int) -> Common:
    """N, V and the heavy tokens with their exact counts; pairs are counted later."""

    def count(batches):
        for batch in batches_of(batches, only_taught=True):
            kinds, n = np.unique(batch.tokens, return_counts=True)
            yield _packed(shard_of(kinds, shards), shards, {"words": kinds, "n": n.astype(np.uint32)})

    def merge(batches):
        words, n = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint32)]
        for batch in batches:
            words += [np.frombuffer(v.as_buffer(), np.uint64) for v in batch.column("words")]
            n += [np.frombuffer(v.as_buffer(), np.uint32) for v in batch.column("n")]
        kinds, where = np.unique(np.concatenate(words), return_inverse=True)
        counts = np.bincount(where, weights=np.concatenate(n), minlength=len(kinds)).astype(np.int64)
        # Heavy among all tokens is heavy in its shard too; so few can be.
        keep = (counts * HEAVY >= counts.sum()) | (kinds == END)
        yield pa.RecordBatch.from_pydict(
            {
                "total": pa.array([int(counts.sum())]), "distinct": pa.array([len(kinds)]),
                "keys": pa.array([kinds[keep].view(np.int64).tolist()], pa.list_(pa.int64())),
                "counts": pa.array([counts[keep].tolist()], pa.list_(pa.int64())),
            }
        )

    packed = rows.mapInArrow(count, "shard int, words binary, n binary").repartitionById(shards, F.col("shard"))
    merged = fixed(packed.mapInArrow(merge, "total long, distinct long, keys array<long>, counts array<long>"))
    size = merged.agg(F.sum("total").alias("total"), F.sum("distinct").alias("distinct")).first()
    total, distinct = size["total"] or 0, size["distinct"] or 0
    each = merged.select(F.explode(F.arrays_zip("keys", "counts")).alias("x")).select("x.keys", "x.counts")
    found = {int(BEGIN): 0, int(END): 0}
    # At most HEAVY rows and the end.
    for key, n in each.where((F.col("counts") * HEAVY >= total) | (F.col("keys") == int(END))).collect():
        found[key & ((1 << 64) - 1)] = n
    keys = np.array(sorted(found), np.uint64)
    return Common(total, distinct, keys, np.array([found[int(k)] for k in keys], np.int64), None)


def pair_counts(rows: DataFrame, common: Common, shards: int) -> np.ndarray:
    """How often each heavy token follows each heavy context in training documents."""
    n = len(common.keys)

    def count(batches):
        seen = np.zeros(n * n, np.int64)
        for batch in batches_of(batches, only_taught=True):
            word, context = common.find(batch.tokens), common.find(batch.contexts)
            both = (word >= 0) & (context >= 0)
            seen += np.bincount(context[both] * n + word[both], minlength=n * n)
        at = np.flatnonzero(seen)
        yield _packed(at % shards, shards, {"pair": at.astype(np.uint32), "n": seen[at]})

    def merge(batches):
        seen = np.zeros(n * n, np.int64)
        for batch in batches:
            for pair, count_of in zip(batch.column("pair"), batch.column("n")):
                seen[np.frombuffer(pair.as_buffer(), np.uint32)] += np.frombuffer(count_of.as_buffer(), np.int64)
        at = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int64)), pa.array(seen[at])], ["pair", "n"])

    packed = rows.mapInArrow(count, "shard int, pair binary, n binary").repartitionById(shards, F.col("shard"))
    out = np.zeros(n * n, np.int64)
    # At most (HEAVY + 2) squared rows.
    got = packed.mapInArrow(merge, "pair long, n long").toArrow()
    out[got.column("pair").to_numpy()] = got.column("n").to_numpy()
    return out.reshape(n, n)


def _packed(shard: np.ndarray, shards: int, columns: dict[str, np.ndarray]) -> pa.RecordBatch:
    """Arrays cut by shard into one binary row per shard that has any."""
    order = np.argsort(shard, kind="stable")
    bounds = np.searchsorted(shard[order], np.arange(shards + 1))
    some = np.flatnonzero(np.diff(bounds))
    out = {"shard": pa.array(some, pa.int32())}
    for name, values in columns.items():
        values = values[order]
        out[name] = pa.array([values[bounds[s] : bounds[s + 1]].tobytes() for s in some], pa.binary())
    return pa.RecordBatch.from_pydict(out)


def _sums(doc: np.ndarray, n: int, values: np.ndarray) -> np.ndarray:
    return np.bincount(doc, weights=values, minlength=n)


def send(rows: DataFrame, sent, shards: int, id_type: str) -> DataFrame:
    """Tokens packed by shard, and one row per batch with what needs no shard."""

    def run(batches):
        common = sent.value
        context_counts, mass = common.contexts(), common.mass()
        number = 0
        for batch in batches_of(batches):
            task = TaskContext.get().partitionId()
            name, home = (task << 32) | number, (task + number * 7919) % shards
            number += 1
            n = len(batch.ids)
            word, context = common.find(batch.tokens), common.find(batch.contexts)
            heavy, after = word >= 0, context >= 0
            counts = common.counts[word[heavy]]
            base = _sums(batch.doc[heavy], n, np.log10(counts + 1.0))
            known = _sums(batch.doc[heavy], n, (counts > 0).astype(float))
            bottom = np.log10(context_counts + mass)
            score = -_sums(batch.doc[after], n, bottom[context[after]])
            both = heavy & after
            u, t = context[both], word[both]
            top = common.pairs[u, t] + mass[u] * common.base(common.counts[t])
            score += _sums(batch.doc[both], n, np.log10(top))
            yield _row(
                shard=[home], batch=[name], taught=[batch.taught], ids=[batch.ids.to_pylist()], lengths=[batch.lengths.tolist()],
                doc=[np.arange(n, dtype=np.uint32).tobytes()], base=[base.tobytes()], known=[known.tobytes()], score=[score.tobytes()],
            )
            rest = ~both
            tokens, contexts, doc = batch.tokens[rest], batch.contexts[rest], batch.doc[rest]
            # A heavy context by its number, any other by 31 bits of its hash.
            at = context[rest]
            code = np.where(at >= 0, (at << 1) | 1, (contexts >> np.uint64(33)).astype(np.int64) << 1).astype(np.uint32)
            shard = shard_of(np.where(heavy[rest], contexts, tokens), shards)
            order = np.argsort((shard.astype(np.uint64) << np.uint64(48)) | (tokens >> np.uint64(16)))
            tokens, code, shard = tokens[order], code[order], shard[order]
            doc = doc[order].astype(np.uint16 if n <= 1 << 16 else np.uint32)
            change = np.ones(len(tokens), bool)
            change[1:] = (tokens[1:] != tokens[:-1]) | (shard[1:] != shard[:-1])
            runs = np.flatnonzero(change)
            sizes = np.diff(np.append(runs, len(tokens))).astype(np.uint32)
            kinds = np.unique(shard)
            cuts, run_cuts = np.searchsorted(shard, [*kinds, shards]), np.searchsorted(shard[runs], [*kinds, shards])
            for k, a, b, c, d in zip(kinds.tolist(), cuts, cuts[1:], run_cuts, run_cuts[1:]):
                yield _row(
                    shard=[k], batch=[name], taught=[batch.taught], words=[tokens[runs[c:d]].tobytes()], runs=[sizes[c:d].tobytes()],
                    contexts=[code[a:b].tobytes()], doc=[doc[a:b].tobytes()],
                )

    columns = _columns(id_type)
    kinds = {name: arrow for name, (arrow, _) in columns.items()}

    def _row(**values):
        return pa.RecordBatch.from_arrays([pa.array(values.get(c, [None]), k) for c, k in kinds.items()], list(kinds))

    return rows.mapInArrow(run, ", ".join(f"{c} {sql}" for c, (_, sql) in columns.items()))


def _columns(id_type: str) -> dict[str, tuple[pa.DataType, str]]:
    arrow_id = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[id_type]
    raw = (pa.binary(), "binary")
    return {
        "shard": (pa.int32(), "int"), "batch": (pa.int64(), "long"), "taught": (pa.int32(), "int"),
        "words": raw, "runs": raw, "contexts": raw, "doc": raw,
        "ids": (pa.list_(arrow_id), f"array<{id_type}>"), "lengths": (pa.list_(pa.int64()), "array<long>"),
        "base": raw, "known": raw, "score": raw,
    }


OUT = ("batch", "doc", "ids", "lengths", "base", "known", "score")


def score_shards(packed: DataFrame, sent, id_type: str) -> DataFrame:
    """Each shard's sums per document, beside the rows that need no shard."""
    columns = {c: _columns(id_type)[c] for c in OUT}

    def run(batches):
        held = []
        for batch in batches:
            own = np.array([v.is_valid for v in batch.column("ids")], bool) if batch.num_rows else np.zeros(0, bool)
            done = batch.filter(pa.array(own))
            if done.num_rows:
                yield pa.RecordBatch.from_arrays([done.column(c) for c in OUT], list(OUT))
            rest = batch.filter(pa.array(~own))
            names = ("words", "runs", "contexts", "doc")
            for i in range(rest.num_rows):
                raw = {c: rest.column(c)[i].as_buffer() for c in names}
                code = np.frombuffer(raw["contexts"], np.uint32)
                doc = np.frombuffer(raw["doc"], np.uint16 if len(raw["doc"]) == 2 * len(code) else np.uint32)
                held.append(
                    (rest.column("batch")[i].as_py(), rest.column("taught")[i].as_py(),
                     np.frombuffer(raw["words"], np.uint64), np.frombuffer(raw["runs"], np.uint32), code, doc)
                )
        if held:
            yield from _answers(sent.value, held, columns)

    return packed.mapInArrow(run, ", ".join(f"{c} {sql}" for c, (_, sql) in columns.items()))


def _answers(common: Common, held: list, columns: dict) -> Iterator[pa.RecordBatch]:
    words, where = np.unique(np.concatenate([h[2] for h in held]), return_inverse=True)
    word = np.repeat(where, np.concatenate([h[3] for h in held])).astype(np.int64)
    code = np.concatenate([h[4] for h in held])
    taught = np.concatenate([h[5] < h[1] for h in held])
    pairs, pair = np.unique((word.astype(np.uint64) << np.uint64(32)) | code, return_inverse=True)
    seen = np.bincount(pair, weights=taught, minlength=len(pairs)).astype(np.int64)
    number = common.find(words)
    heavy = number >= 0
    counts = np.bincount(word, weights=taught, minlength=len(words)).astype(np.int64)
    counts[heavy] = common.counts[number[heavy]]
    pair_word, pair_code = (pairs >> np.uint64(32)).astype(np.int64), pairs.astype(np.uint32)
    mass = common.mass()
    prior = np.where(pair_code & 1, mass[np.minimum(pair_code >> 1, len(mass) - 1)], PRIOR)

    # The trie holds what training documents hold.
    kept = np.flatnonzero((counts > 0) | heavy)
    place = np.full(len(words), -1)
    place[kept] = np.arange(len(kept))
    taken = seen > 0
    tops = np.log10(seen[taken] + prior[taken] * common.base(counts[pair_word[taken]]))
    trie: Trie = mapped(
        Trie.build(words[kept], counts[kept], np.log10(common.base(counts[kept])), place[pair_word[taken]], pair_code[taken], tops)
    )
    del taken, tops, seen, counts

    at = trie.find_words(words)
    counts = np.where(at >= 0, trie.counts[np.maximum(at, 0)], 0) if len(trie.counts) else np.zeros(len(words))
    own = np.where(at >= 0, restored(trie.word_logs[np.maximum(at, 0)]), np.log10(common.base(0))) if len(trie.counts) else np.full(len(words), np.log10(common.base(0)))
    found = trie.find_pairs(at[pair_word], pair_code)
    top = np.log10(prior) + own[pair_word]
    hit = found >= 0
    top[hit] = restored(trie.pair_logs[found[hit]])
    # A light word also stands as the context of the token after it.
    light = ~heavy
    base = np.where(light, np.log10(counts + 1.0), 0.0)
    known = np.where(light & (counts > 0), 1.0, 0.0)
    below = np.where(light, np.log10(counts + PRIOR), 0.0)
    # The end is never a context, and it is always heavy.
    begin = 0
    for name, _, _, _, codes, doc in held:
        part = slice(begin, begin + len(codes))
        begin += len(codes)
        docs, small = np.unique(doc, return_inverse=True)
        w = word[part]
        values = {
            "batch": [name], "doc": [docs.astype(np.uint32).tobytes()],
            "base": [_sums(small, len(docs), base[w]).tobytes()],
            "known": [_sums(small, len(docs), known[w]).astype(np.uint32).tobytes()],
            "score": [_sums(small, len(docs), top[pair[part]] - below[w]).tobytes()],
        }
        yield pa.RecordBatch.from_arrays([pa.array(values.get(c, [None]), k) for c, (k, _) in columns.items()], list(columns))


def add_up(sums: DataFrame, common: Common, id_type: str) -> DataFrame:
    """One row per document from its batch's row and the shards' rows."""
    total, size = common.total, np.log10(common.total + common.distinct + 1.0)
    names = ("doc_id", "n_tokens", "n_known", "base_score", "score")
    arrow_id = _columns(id_type)["ids"][0].value_type

    def finish(parts):
        head = next(p for p in parts if p["ids"] is not None)
        n = len(head["ids"])
        base, known, score = np.zeros(n), np.zeros(n), np.zeros(n)
        for p in parts:
            doc = np.frombuffer(p["doc"], np.uint32)
            base[doc] += np.frombuffer(p["base"], np.float64)
            known[doc] += np.frombuffer(p["known"], np.float64 if p["ids"] is not None else np.uint32)
            score[doc] += np.frombuffer(p["score"], np.float64)
        lengths = np.array(head["lengths"], np.int64)
        return pa.RecordBatch.from_arrays(
            [pa.array(head["ids"], arrow_id), pa.array(lengths), pa.array(known.astype(np.int64)), pa.array(base - lengths * size), pa.array(score)],
            list(names),
        )

    def run(batches):
        name, parts = None, []
        for batch in batches:
            for row in batch.to_pylist():
                if row["batch"] != name and parts:
                    yield finish(parts)
                    parts = []
                name = row["batch"]
                parts.append(row)
        if parts:
            yield finish(parts)

    grouped = sums.repartition("batch").sortWithinPartitions("batch")
    rows = grouped.mapInArrow(run, f"doc_id {id_type}, n_tokens long, n_known long, base_score double, score double")
    held = F.coalesce(fold(F.col("doc_id"), FOLDS) == HELD_OUT, F.lit(False))
    return rows.select(
        "doc_id", held.alias("held_out"), "n_tokens", "n_known", F.lit(total).cast("long").alias("train_tokens"), "base_score", "score"
    )


def score_texts(docs: DataFrame, shards: int | None = None) -> DataFrame:
    """Base-10 log probabilities of every text, by the unigram base and by the model."""
    spark = docs.sparkSession
    ready(spark)
    shards = shards or partitions(spark)
    rows = _ready_rows(docs)
    id_type = dict(docs.dtypes)["doc_id"]
    common = totals(rows, shards)
    common = replace(common, pairs=pair_counts(rows, common, shards))
    # Two numbers per heavy token and one per pair of them: bounded by HEAVY.
    sent = spark.sparkContext.broadcast(common)
    packed = send(rows, sent, shards, id_type).repartitionById(shards, F.col("shard"))
    return add_up(score_shards(packed, sent, id_type), common, id_type)


def op3_elias_fano_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score of every document, learned from six sevenths of them."""
    return score_texts(table(spark, sf_dir, "documents"))
