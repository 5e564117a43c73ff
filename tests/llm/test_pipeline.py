"""The pipeline against its stages' brute-force parts, and on awkward tables."""

import zlib

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as c
from rulspark.llm import langid, packing, quality, simhash
from test_packing import check


@pytest.fixture(scope="module")
def kept(spark, sf_dir):
    """What each stage kept, by name."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = {"": docs}
    for name, stage in c.STAGES[:-1]:
        docs = stage(spark, docs, sf_dir)
        out[name] = docs
    return {k: {r.doc_id: r.text for r in v.collect()} for k, v in out.items()}


def test_stage_names():
    assert [n for n, _ in c.STAGES] == ["language_id", "quality", "simhash_dedup", "packing"]
    assert c.ORACLE_SQL is None


def test_each_stage_keeps_a_part_and_its_columns(spark, sf_dir, kept):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in c.STAGES[:-1]:
        assert stage(spark, docs, sf_dir).columns == docs.columns
    names = ["", *[n for n, _ in c.STAGES[:-1]]]
    for before, after in zip(names, names[1:]):
        assert kept[after].items() <= kept[before].items()
    assert len(kept["language_id"]) == len([t for t in kept[""].values() if t and langid.LETTER.search(t)])


def test_clean_documents_stay_and_bad_ones_go(spark, sf_dir, kept):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    good = [d for d in kept["language_id"] if labels.get(d) == 1]
    assert sum(d in kept["quality"] for d in good) / len(good) > 0.97


def test_one_document_of_each_group_stays(kept):
    left, stays = kept["quality"], set(kept["simhash_dedup"])
    fps = {d: simhash.fingerprint(t) for d, t in left.items()}
    for a in left:
        near = [b for b in left if (fps[a] ^ fps[b]).bit_count() <= 2]
        assert any(b in stays for b in near)
        if a in stays:
            assert a == min(near)


def test_run_packs_what_is_left(spark, sf_dir, kept):
    check(c.run(spark, sf_dir).collect(), list(kept["simhash_dedup"].items()), packing.LENGTH)


def test_awkward_documents(spark, awkward, no_docs, sf_dir):
    docs = awkward.select("doc_id", "text", "lang", "source", "n_chars")
    for name, stage in c.STAGES:
        out = stage(spark, docs, sf_dir)
        if name == "language_id":
            assert {r.doc_id for r in out.collect()} == {4, 5, 6, 7, 8, 10, None}
        if name == "simhash_dedup":
            assert out.where("doc_id IN (6, 7)").count() == 1 and out.where("doc_id = 5").count() == 1
        if name != "packing":
            assert out.columns == docs.columns
            docs = out if out.count() else docs
    for _, stage in c.STAGES:
        assert stage(spark, no_docs, sf_dir).count() == 0


def test_bad_documents_go_and_good_ones_stay_among_held_out_ones(spark):
    sf_dir = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    held = [d for d in labels if zlib.crc32(str(d).encode()) % 4 == quality.HELD_OUT]
    stays = {r.doc_id for r in c.good(spark, docs, sf_dir).select("doc_id").collect()}
    bad, good = [d for d in held if labels[d] == 0], [d for d in held if labels[d] == 1]
    assert sum(d not in stays for d in bad) / len(bad) > 0.95
    assert sum(d in stays for d in good) / len(good) > 0.99


def test_without_labels_no_lettered_text_is_dropped(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").withColumn("lang", F.lit(None).cast("string"))
    left = {r.doc_id for r in c.language(spark, docs, sf_dir).collect()}
    assert left == {r.doc_id for r in docs.collect() if langid.LETTER.search(r.text or "")} and left


def test_language_stage_parses_every_lettered_text_and_counts_its_bytes(spark, sf_dir, monkeypatch):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    lettered = {r.doc_id for r in docs.collect() if langid.LETTER.search(r.text or "")}
    seen, real = [], langid.identify

    def identify(df, learned, keep=None, made=langid.MADE, also=()):
        out = real(df, learned, keep, made, also)
        if keep is None:
            seen.append(({r.doc_id for r in df.select("doc_id").collect()}, len(out.columns) - len(df.columns)))
        return out

    monkeypatch.setattr(langid, "identify", identify)
    assert c.language(spark, docs, sf_dir).count() == len(lettered)
    assert seen == [(lettered, 6)]


CLASHING = ("_lang", "_score", "_bits", "_print", "_fp", "_root", "_component", "_LABEL", "stats", "place", "ids", "key")


def test_columns_of_any_name_pass_through_unchanged(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    marked = docs.withColumns({n: F.concat(F.lit(n), F.col("doc_id").cast("string")) for n in CLASHING})
    for name, stage in c.STAGES[:-1]:
        plain, out = stage(spark, docs, sf_dir), stage(spark, marked, sf_dir)
        assert out.columns == marked.columns
        rows = out.collect()
        assert {r.doc_id for r in rows} == {r.doc_id for r in plain.select("doc_id").collect()}, name
        assert all(r[n] == f"{n}{r.doc_id}" for r in rows for n in CLASHING)
    assert c.STAGES[-1][1](spark, marked, sf_dir).count() == c.STAGES[-1][1](spark, docs, sf_dir).count()
