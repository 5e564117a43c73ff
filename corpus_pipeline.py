"""From raw documents to packed sequences, one operator a stage.

Every stage takes all its predecessor kept and returns the same columns; the last returns
pieces of sequences. What a stage decides takes effect: language ID drops texts without a
language, the quality classifier drops texts that are probably bad, near-duplicates leave
one document of each group, and packing lays the rest along a space-filling curve.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rulspark.llm import bytecounts, langid, packing, quality, simhash
from rulspark.llm.shared import fold, free_names, ready, table
from rulspark.session import scratch_path

# A text is dropped when it is less likely good than this, that is, more likely bad than good.
LEAST_QUALITY = 0.5


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops texts that are null or have no letter, and texts of some length that are far from
    every language that a label names; without labels only the former.

    Every lettered text is parsed against the languages' samples, as ``op7_cross_parsing`` does,
    and costed by byte counts of all labelled rows outside the held-out fold; all labelled rows
    inside it tell what is far. A text goes if its bytes cost far more than those of nearly all
    texts of a language, and its phrases far more than those of the usual one: what the samples
    miss the counts know, and a text of known phrases stays whatever its bytes cost."""
    ready(spark)
    lettered = docs.where(F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)))
    learning = langid.learning_rows(docs)
    counts, phrases = bytecounts.learned(learning), langid.samples(learning)
    if counts is None or not phrases:
        return lettered
    held_out = docs.where(fold(F.col("doc_id"), 4) == langid.HELD_OUT)
    names = free_names(lettered, *2 * ("_lang", "_score", "_bits"))
    # In one pass, so that a task has one worker.
    judged = langid.identify(lettered, phrases, made=names[:3], also=[bytecounts.judging(spark, counts, names[3:])])
    far = F.lit(True)
    for (lang, _, bits), learned, told_by, share in (
        (names[:3], phrases, langid.identify, bytecounts.USUAL),
        (names[3:], counts, bytecounts.identify, bytecounts.ORDINARY),
    ):
        most = bytecounts.ordinary(held_out, learned, told_by, share)
        far &= langid.rejected(F.col(lang), F.col(bits), F.col("text"), most)
    return judged.where(~far).select(*docs.columns)


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops texts whose calibrated quality is under ``LEAST_QUALITY``."""
    (score,) = free_names(docs, "_score")
    stats = quality.with_statistics(docs.select("doc_id", "text"))
    model = quality.learned(stats, table(spark, sf_dir, "labels"))
    scored = quality.judge(docs, model, tuple(docs.columns), score)
    return scored.where(F.col(score) >= LEAST_QUALITY).select(*docs.columns)


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Leaves the document with the smallest id of each group of near-duplicates."""
    return simhash.one_of_each(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of neighbouring documents."""
    return packing.pieces_of(docs)


STAGES = [
    ("language_id", language),
    ("quality", good),
    ("simhash_dedup", distinct),
    ("packing", packed),
]

# The stages learn and compare by methods that SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each but the last is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
