import hashlib
from collections import defaultdict
from pathlib import Path

import pytest
from oracle import differences, duck

from rulspark.llm import streamdedup as s
from rulspark.session import scratch_path


def slow(rows):
    """(id, text) rows: sorted (id, keep_id, size, digest) and the number kept, which is one a group."""
    groups = defaultdict(list)
    for doc, text in rows:
        text = text or ""
        groups["".join(c for c in text if c not in " \t\n\v\f\r")].append((-len(text), doc is None, doc or 0, doc))
    out = []
    for norm, members in groups.items():
        keep = min(members)[3]
        digest = hashlib.sha256(norm.encode()).hexdigest()
        out.extend((doc, keep, len(members), digest) for *_, doc in members)
    return sorted(out, key=repr), len(groups)


def judged(df):
    rows = df.collect()
    found = sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in rows), key=repr)
    assert all(r.doc_id == r.keep_id for r in rows if r.kept)
    return found, sum(r.kept for r in rows)


def landed(spark, df, path):
    df.write.mode("append").parquet(path)


@pytest.mark.parametrize("digest_bytes", [32, 1])
def test_awkward_rows_and_colliding_digests(spark, awkward, digest_bytes):
    """With a digest of one byte, or of eight bits, different texts meet under one key."""
    path = scratch_path(spark, "source")
    many = spark.createDataFrame([(1000 + i, f"text {i % 700} {' ' * (i % 3)}") for i in range(1500)], "doc_id long, text string")
    landed(spark, awkward.drop("source").unionByName(many, allowMissingColumns=True), path)
    dedup = s.StreamDedup(spark, path, scratch_path(spark, "home"), digest_bytes)
    dedup.take_in()
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(path).collect()]
    assert judged(dedup.result()) == slow(rows)
    assert dedup._stored("collisions").where("digest IS NOT NULL").isEmpty() == (digest_bytes == 32)


@pytest.mark.parametrize("digest_bytes", [32, 1])
def test_later_arrivals_meet_earlier_ones(spark, digest_bytes):
    path, home = scratch_path(spark, "source"), scratch_path(spark, "home")
    arrivals = [
        [(5, "a b"), (6, "c"), (7, None)],
        [(4, "ab"), (3, "a  b"), (8, "d"), (None, "c")],
        [(2, "a  b"), (1, " "), (9, "c")],
    ]
    so_far = []
    for part in arrivals:
        landed(spark, spark.createDataFrame(part, "doc_id long, text string").coalesce(1), path)
        so_far += part
        # A new object: all that is known lies in the folder.
        dedup = s.StreamDedup(spark, path, home, digest_bytes)
        dedup.take_in()
        assert judged(dedup.result()) == slow(so_far)
    state = spark.read.format("statestore").load(f"{home}/state")
    if digest_bytes == 32:
        assert state.count() == 4
    dedup.take_in()  # nothing new
    assert judged(dedup.result()) == slow(so_far)


def test_small_batches_give_the_same(spark, sf_dir, texts):
    path = scratch_path(spark, "source")
    rows = [(str(d), t) for d, t in texts.items()]
    landed(spark, spark.createDataFrame(rows, "doc_id string, text string").repartition(5), path)
    dedup = s.StreamDedup(spark, path, scratch_path(spark, "home"), batch_bytes=1)
    dedup.take_in()
    assert len(list(Path(f"{dedup.home}/intake/commits".removeprefix("file:")).glob("[0-9]*"))) == 5
    assert judged(dedup.result()) == slow(rows)


def test_a_hot_text_reaches_its_state_as_few_rows(spark):
    path = scratch_path(spark, "source")
    landed(spark, spark.range(6000).selectExpr("id AS doc_id", "IF(id % 3 = 0, 'hot text', concat('t', id)) AS text"), path)
    dedup = s.StreamDedup(spark, path, scratch_path(spark, "home"))
    made = s.bundles(dedup.rows())
    assert made.count() < 4000 + 50
    dedup.take_in()
    found = {r.group_size: r.n for r in dedup.result().groupBy("group_size").agg(s.F.count("*").alias("n")).collect()}
    assert found == {2000: 2000, 1: 4000}


def test_empty_table(spark, no_docs):
    path = scratch_path(spark, "source")
    landed(spark, no_docs, path)
    dedup = s.StreamDedup(spark, path, scratch_path(spark, "home"))
    dedup.take_in()
    assert dedup.result().count() == 0


def test_settings_are_put_back(spark):
    name = f"{s.STATE}.providerClass"
    before = spark.conf.get(name)
    with s.settings(spark, s.SETTINGS):
        assert "RocksDB" in spark.conf.get(name)
    assert spark.conf.get(name) == before


def test_query(spark, sf_dir):
    assert differences(s.op11_stream_dedup(spark, sf_dir), duck(sf_dir), s.ORACLE) == []
