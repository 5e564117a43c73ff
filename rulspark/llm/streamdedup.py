"""Exact deduplication as a stream with disk-backed keyed state that never expires.

Texts are equal when they are identical after deleting every space, tab, line feed, vertical
tab, form feed and carriage return. Of equal texts the row with the most code points in its
original text stays, then the one with the smallest id, then the first by place.

* **Bundles.** Inside a task, equal texts of an Arrow batch are compared by their whole bytes
  and become one row: digest, number of members, and the member that would stay. So a group
  that holds a third of all rows reaches its state as one narrow row per batch, not per copy.
* **State.** A streaming aggregation keyed by digest, kept by RocksDB and saved to the
  checkpoint in the shared folder: group size, number of bundles, stable identifier of the
  row that stays, and the locator (file, row in the file) of its content. Nothing expires; a
  later arrival meets all earlier ones. Bundles are added up before they are shuffled.
* **Hits.** A digest with more than one bundle has hits. The bytes of its new bundles and
  those behind the retained locator are fetched and compared whole; digests whose texts
  differ are written to a list of collisions, and their rows are grouped by their bytes when
  the result is made. So the result does not rest on the digest, however short it is.

Progress (source files seen, bundles, state, verdicts per batch, collisions per arrival)
lives in ``home``: what was broken off goes on from there, and the verdicts of a batch that
runs twice are overwritten.

Cases: a null text counts as empty, and all texts without other characters are one group;
null ids come last among ties and stay null; of repeated rows, ids included, one stays;
other columns are ignored; an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
from contextlib import contextmanager

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rulspark.llm.arrow import filled, slices, strings
from rulspark.llm.shared import ready
from rulspark.session import scratch_path

DELETED = b" \t\n\v\f\r"
DELETED_CLASS = r"[\x20\x09-\x0D]+"
DIGEST_BYTES = 32
STATE = "spark.sql.streaming.stateStore"
SETTINGS = {
    f"{STATE}.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    f"{STATE}.rocksdb.changelogCheckpointing.enabled": "true",
    # All stores of an executor share one bound, and write buffers start small: a process
    # may hold a hundred stores.
    f"{STATE}.rocksdb.boundedMemoryUsage": "true",
    f"{STATE}.rocksdb.maxMemoryUsageMB": "256",
    f"{STATE}.rocksdb.writeBufferSizeMB": "4",
    # Small stores would claim more disk than they use.
    f"{STATE}.rocksdb.allowFAllocate": "false",
}


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]):
    """A stream copies the session's settings when it starts; afterwards they are put back."""
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def located(rows: DataFrame) -> DataFrame:
    """Id, text and the content's locator of rows that come from Parquet files."""
    return rows.select(
        "doc_id", "text", F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("place")
    )


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), DELETED_CLASS, "")


def _filled_ids(ids: pa.Array) -> pa.Array:
    """Ids without nulls, as a batch of the state's input needs them."""
    return pc.fill_null(ids, "" if pa.types.is_string(ids.type) or pa.types.is_large_string(ids.type) else 0)


def digests(rows: DataFrame, size: int = DIGEST_BYTES) -> DataFrame:
    """``doc_id``, ``file``, ``place``, ``text_sha256`` (hex) and ``digest`` of every located row."""
    kind = dict(rows.dtypes)["doc_id"]

    def run(batches):
        for batch in batches:
            column = filled(batch.column("text"))
            for start, stop in slices(column):
                found = [
                    hashlib.sha256(t.encode().translate(None, DELETED)).digest()
                    for t in strings(column.slice(start, stop - start))
                ]
                kept = [batch.column(c).slice(start, stop - start) for c in ("doc_id", "file", "place")]
                yield pa.RecordBatch.from_arrays(
                    [*kept, pa.array([d.hex() for d in found]), pa.array([d[:size] for d in found], pa.binary())],
                    ["doc_id", "file", "place", "text_sha256", "digest"],
                )

    return rows.mapInArrow(run, f"doc_id {kind}, file string, place long, text_sha256 string, digest binary")


def bundles(rows: DataFrame, size: int = DIGEST_BYTES) -> DataFrame:
    """One row per distinct text of an Arrow batch: ``digest``, ``members``, and of the member
    that would stay ``n_chars``, ``no_id``, ``doc_id`` (filled where null), ``file``, ``place``."""
    kind = dict(rows.dtypes)["doc_id"]

    def run(batches):
        for batch in batches:
            best: dict[bytes, list] = {}
            ids = batch.column("doc_id")
            columns = [c.to_pylist() for c in (_filled_ids(ids), batch.column("file"), batch.column("place"))]
            empty = ids.is_null().to_pylist()
            for text, doc, file, place, no_id in zip(strings(batch.column("text")), *columns, empty):
                # The dictionary compares whole bytes, not hashes alone.
                key = text.encode().translate(None, DELETED)
                order = (-len(text), no_id, doc, file, place)
                if (known := best.get(key)) is None:
                    best[key] = [1, order]
                else:
                    known[0] += 1
                    known[1] = min(known[1], order)
            if best:
                chars, no_ids, docs, files, places = zip(*[b[1] for b in best.values()])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([hashlib.sha256(k).digest()[:size] for k in best], pa.binary()),
                        pa.array([b[0] for b in best.values()], pa.int64()),
                        pa.array([-c for c in chars], pa.int64()),
                        pa.array(no_ids, pa.bool_()),
                        pa.array(docs, ids.type),
                        pa.array(files, pa.string()),
                        pa.array(places, pa.int64()),
                    ],
                    ["digest", "members", "n_chars", "no_id", "doc_id", "file", "place"],
                )

    return rows.mapInArrow(
        run,
        f"digest binary, members long, n_chars long, no_id boolean, doc_id {kind}, file string, place long",
    )


def _order() -> Column:
    """Least for the row that stays."""
    return F.struct((-F.col("n_chars")).alias("chars"), "no_id", "doc_id", "file", "place")


class StreamDedup:
    """Deduplicates the Parquet files of ``source`` as they arrive.

    ``home`` is a folder that all executors share; it holds the stream's checkpoint with the
    state, the verdicts and the collisions. ``digest_bytes`` may be small: collisions cost
    time, not correctness. ``batch_bytes`` bounds the files of one batch.
    """

    def __init__(
        self, spark: SparkSession, source: str, home: str, digest_bytes: int = DIGEST_BYTES, batch_bytes: int = 100 << 30
    ):
        ready(spark)
        self.spark, self.source, self.home = spark, source, home.rstrip("/")
        self.digest_bytes, self.batch_bytes = digest_bytes, batch_bytes
        self.schema = spark.read.parquet(source).select("doc_id", "text").schema
        self.id_type = self.schema["doc_id"].dataType.simpleString()

    def rows(self) -> DataFrame:
        return located(self.spark.read.schema(self.schema).parquet(self.source))

    def take_in(self) -> None:
        """All files that have not been seen yet."""
        stream = self.spark.readStream.schema(self.schema).option("maxBytesPerTrigger", str(self.batch_bytes))
        # A stream reads a folder or a pattern; the pattern for one file matches that file.
        one_file = self._status(self.source).isFile()
        stream = located(stream.parquet(f"{self.source[:-1]}[{self.source[-1]}]" if one_file else self.source))
        arrival = 1 if self._status(f"{self.home}/bundles") is None else self._last_arrival() + 1
        found = bundles(stream, self.digest_bytes).withColumn("arrival", F.lit(arrival).cast("long"))
        self._run(
            found.writeStream.format("parquet").outputMode("append").option("path", f"{self.home}/bundles"), "intake"
        )
        if self._status(f"{self.home}/bundles") is None:
            return  # there was no file
        members = self.spark.readStream.schema(found.schema).parquet(f"{self.home}/bundles")
        state = members.groupBy("digest").agg(
            F.sum("members").alias("size"), F.count("*").alias("bundles"), F.min(_order()).alias("best")
        )
        self._run(state.writeStream.outputMode("update").foreachBatch(self._store), "state")
        self._check()

    def _run(self, writer, name: str) -> None:
        with settings(self.spark, SETTINGS):
            query = writer.option("checkpointLocation", f"{self.home}/{name}").trigger(availableNow=True).start()
        query.awaitTermination()

    def _store(self, batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{self.home}/verdicts/batch={number}")

    def _status(self, path: str):
        """The file or folder at ``path``; None where there is none."""
        hadoop = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        files = hadoop.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        return files.getFileStatus(hadoop) if files.exists(hadoop) else None

    def _last_arrival(self) -> int:
        return self.spark.read.parquet(f"{self.home}/bundles").agg(F.max("arrival")).first()[0] or 0

    def _checked(self) -> int:
        """The last arrival whose hits were compared."""
        if self._status(f"{self.home}/collisions") is None:
            return 0
        return self._stored("collisions").agg(F.max("arrival")).first()[0] or 0

    def _check(self) -> None:
        """Stores the digests of which a new bundle is not equal, byte for byte, to what is retained."""
        checked, last = self._checked(), self._last_arrival()
        if last == checked:
            return
        new = self.spark.read.parquet(f"{self.home}/bundles").where(F.col("arrival") > checked)
        hits = new.select("digest", "file", "place").join(self.groups().where("bundles > 1"), "digest")
        both = F.array(F.struct("file", "place"), F.struct(F.col("keep_file").alias("file"), F.col("keep_place").alias("place")))
        wanted = hits.select("digest", F.explode(both).alias("at")).select("digest", "at.*").distinct()
        # The least and the greatest of a digest's texts are the same only if all are; copies
        # are compared inside the tasks that read them first.
        texts = self.rows().join(wanted, ["file", "place"]).select("digest", normalised(F.col("text")).alias("bytes"))
        differ = texts.groupBy("digest").agg(F.min("bytes").alias("least"), F.max("bytes").alias("most"))
        found = differ.where("least != most").select("digest", F.lit(last).cast("long").alias("arrival"))
        # A row without a digest says that the arrival was compared.
        mark = self.spark.createDataFrame([(None, last)], "digest binary, arrival long")
        found.unionByName(mark).write.mode("overwrite").parquet(f"{self.home}/collisions/upto={last}")

    def groups(self) -> DataFrame:
        """Per digest its last verdict: ``size``, ``bundles``, ``keep_id``, ``keep_file``, ``keep_place``."""
        last = self._stored("verdicts").groupBy("digest").agg(
            F.max_by(F.struct("size", "bundles", "best"), "size").alias("last")
        )
        return last.select(
            "digest", "last.size", "last.bundles",
            F.col("last.best.file").alias("keep_file"), F.col("last.best.place").alias("keep_place"),
            F.when(~F.col("last.best.no_id"), F.col("last.best.doc_id")).alias("keep_id"),
        )

    def _stored(self, name: str) -> DataFrame:
        return self.spark.read.option("recursiveFileLookup", "true").parquet(f"{self.home}/{name}")

    def result(self) -> DataFrame:
        """``doc_id``, ``keep_id``, ``group_size``, ``kept`` and ``text_sha256`` of every row."""
        members = digests(self.rows(), self.digest_bytes)
        if self._status(f"{self.home}/collisions") is None:
            # No file held a row; ``take_in`` compares the hits of every arrival that has rows.
            return members.select(
                "doc_id", F.col("doc_id").alias("keep_id"), F.lit(0).cast("long").alias("group_size"),
                F.lit(True).alias("kept"), "text_sha256",
            )
        collisions = self._stored("collisions").where("digest IS NOT NULL").select("digest").distinct()
        if collisions.isEmpty():
            return _told(members.join(self.groups(), "digest"))
        # Texts that share a digest with another text are grouped by their bytes.
        plain = members.join(collisions, "digest", "left_anti").join(self.groups(), "digest")
        shared = members.join(collisions, "digest", "left_semi").join(self.rows().drop("doc_id"), ["file", "place"])
        shared = shared.withColumn("bytes", normalised(F.col("text")))
        measured = shared.withColumns({"n_chars": F.coalesce(F.length("text"), F.lit(0)), "no_id": F.col("doc_id").isNull()})
        exact = measured.groupBy("bytes").agg(F.count("*").alias("size"), F.min(_order()).alias("best")).select(
            "bytes", "size", F.col("best.doc_id").alias("keep_id"),
            F.col("best.file").alias("keep_file"), F.col("best.place").alias("keep_place"),
        )
        return _told(plain).unionByName(_told(shared.join(exact, "bytes")))


def _told(rows: DataFrame) -> DataFrame:
    stays = (F.col("file") == F.col("keep_file")) & (F.col("place") == F.col("keep_place"))
    return rows.select(
        "doc_id", "keep_id", F.col("size").alias("group_size"), stays.alias("kept"), "text_sha256"
    )


def op11_stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Group and keeper of every document, from a stream over all files of the table."""
    stream = StreamDedup(spark, f"{sf_dir}/documents.parquet", scratch_path(spark, "dedup"))
    stream.take_in()
    return stream.result()


ORACLE = r"""WITH t AS (
  SELECT doc_id, length(coalesce(text, '')) AS chars,
    regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm FROM documents),
g AS (
  SELECT doc_id, norm, first_value(doc_id) OVER (PARTITION BY norm ORDER BY chars DESC, doc_id) AS keep_id,
    count(*) OVER (PARTITION BY norm) AS group_size FROM t)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256 FROM g"""
