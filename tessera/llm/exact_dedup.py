"""Exact deduplication as a stateful stream with disk-backed state (built-in expressions only, no Python workers).

The table is read as a stream. Per SHA-256 digest of the white-space-normalised text, a RocksDB state store keeps,
without expiry: the stable identifier (smallest doc_id), a content locator (file and row of that document) and the
number of rows. Each micro-batch hands on the entries that changed; a restarted stream goes on from its checkpoint.

Every row then looks its digest up, in one more scan that writes (doc_id, file, row, digest) and, of hits only, i.e. digests with several
rows, the normalised text. The hits are broadcast if there are at most ``broadcast_hits`` (counted first); beyond that rows and hits
meet in a shuffle. Full bytes are compared on hits: the smallest and the largest text of a digest must be the same
bytes. Both are aggregates over salted parts of a digest first, so a third of all rows under one digest is spread over
tasks. Where bytes differ, those digests are regrouped by their texts.

Defined results: null text counts as empty, and all empty or blank texts are handled like any other text (a blank
text of one or more white space characters is one space and not equal to the empty one). Of rows with equal doc_id and
equal text, the one first by file and row stays. A null doc_id stays only where a group has no other. Only the two columns
named are read, so others may have any name. A row whose digest the state does not know (a file that the stream passed over) raises.
"""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tessera.llm.common import discard, shared_dir, written

_STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "128",
    "spark.sql.streaming.stateStore.rocksdb.writeBufferSizeMB": "4",
    # An executor holds only the stores of its running tasks in memory, not those of all its state partitions.
    "spark.sql.streaming.stateStore.unloadOnCommit": "true",
}


@contextmanager
def _settings(spark: SparkSession, conf: dict[str, str]):
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def normalised(text) -> F.Column:
    """White space runs (0x20, 0x09 to 0x0D) as one space each; null as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), "[\\x20\\x09-\\x0D]+", " ")


def sha256_digest(text: F.Column) -> F.Column:
    return F.sha2(text, 256)


def _rows(frame: DataFrame, id_col: str, text_col: str, digest) -> DataFrame:
    text = normalised(F.col(text_col))
    return frame.select(F.col(id_col).cast("long").alias("doc_id"), F.col("_metadata.file_path").alias("file"),
                        F.col("_metadata.row_index").alias("row"), text.alias("text")).withColumn("digest", F.unhex(digest(F.col("text"))))


def _streamable(spark: SparkSession, path: str) -> str:
    """A file source takes folders or patterns; a table that is one file becomes a pattern that matches it alone."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    status = where.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(where)
    return f"{path[:-1]}[{path[-1]}]" if status.isFile() else path


_SALTS = 16
_FIRST = ("doc_id IS NULL", "doc_id", "file", "row")


def _first() -> F.Column:
    return F.min(F.struct(*[F.expr(x).alias(f"k{i}") for i, x in enumerate(_FIRST)]))


def run_state(spark: SparkSession, path: str, schema: StructType, folder: str, id_col: str = "doc_id", text_col: str = "text",
              digest=sha256_digest, max_files_per_trigger: int | None = None) -> DataFrame:
    """Feed what is new under ``path`` through the keyed state kept in ``folder``; returns the state's entries:
    digest, first (locator, smallest doc_id first), n."""
    changes = f"{folder}/changes"

    def keep(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{changes}/batch={number}")

    reader = spark.readStream.schema(schema).option("maxFileAge", "36500d")  # no file is too old
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = _rows(reader.parquet(_streamable(spark, path)), id_col, text_col, digest).drop("text")
    state = stream.groupBy("digest").agg(_first().alias("first"), F.count(F.lit(1)).alias("n"))
    with _settings(spark, _STATE_CONF):
        query = (state.writeStream.outputMode("update").foreachBatch(keep).trigger(availableNow=True)
                 .option("checkpointLocation", f"{folder}/state").start())
        query.awaitTermination()
    kept = "digest binary, first struct<k0:boolean,k1:bigint,k2:string,k3:bigint>, n bigint, batch int"
    entries = spark.read.schema(kept).parquet(changes)
    last = entries.agg(F.max("batch")).first()[0]  # one number
    if not last:
        return entries.drop("batch")
    return entries.groupBy("digest").agg(F.max(F.struct("batch", "first", "n")).alias("e")).select("digest", "e.first", "e.n")


def exact_duplicates(spark: SparkSession, path: str, id_col: str = "doc_id", text_col: str = "text", digest=sha256_digest,
                     folder: str | None = None, max_files_per_trigger: int | None = None, broadcast_hits: int = 1_000_000) -> DataFrame:
    """One row per row of the parquet table at ``path``: doc_id, keep_id, group_size, kept, text_sha256.

    ``folder``: where state and its checkpoint lie; give the same one again to go on with new files. By default a new
    folder in the shared one, deleted at the end. ``digest`` maps a text to a hex string.
    """
    own = folder is None
    folder = folder or f"{shared_dir(spark).rstrip('/')}/exact-{uuid.uuid4().hex}"
    whole = spark.read.parquet(path).schema
    schema = StructType([f for f in whole if f.name in (id_col, text_col)])
    table = spark.read.schema(schema).parquet(path)
    if table.limit(1).count() == 0:
        empty = table.select(F.col(id_col).cast("long").alias("doc_id"))
        return empty.select("doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), F.lit("").alias("text_sha256"))
    state = run_state(spark, path, schema, folder, id_col, text_col, digest, max_files_per_trigger)
    rows = _rows(table, id_col, text_col, digest)
    if digest is not sha256_digest:
        rows = rows.withColumn("sha", F.unhex(sha256_digest(F.col("text"))))
    hits = state.where("n > 1").select("digest", F.lit(True).alias("hit"))
    if hits.count() <= broadcast_hits:  # 32 bytes each
        hits = F.broadcast(hits)
    looked = written(rows.join(hits, "digest", "left").withColumn("text", F.when(F.col("hit"), F.col("text"))).drop("hit"), "looked")
    salt = F.pmod(F.xxhash64("file", "row"), F.lit(_SALTS)).alias("salt")
    part = looked.where("text IS NOT NULL").groupBy("digest", salt).agg(F.min("text").alias("lo"), F.max("text").alias("hi"))
    unlike = part.groupBy("digest").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).where("lo <> hi").select("digest")
    sha = F.lower(F.hex("digest" if digest is sha256_digest else "sha")).alias("text_sha256")
    known = looked.drop("text").join(state, "digest", "left")
    n = F.coalesce("n", F.raise_error(F.lit("a row's digest is not in the state: its file was not streamed")).cast("long"))
    out = known.withColumn("n", n)
    if unlike.limit(1).count():
        unlike.write.mode("overwrite").parquet(f"{folder}/unlike")
        unlike = spark.read.parquet(f"{folder}/unlike")
        apart = looked.join(unlike, "digest", "left_semi")
        groups = apart.groupBy("digest", "text").agg(_first().alias("first"), F.count(F.lit(1)).alias("n"))
        out = out.join(unlike, "digest", "left_anti").unionByName(apart.join(groups, ["digest", "text"]).drop("text"))
    here = (F.col("file") == F.col("first.k2")) & (F.col("row") == F.col("first.k3"))
    out = out.select("doc_id", F.col("first.k1").alias("keep_id"), F.col("n").alias("group_size"), here.alias("kept"), sha)
    if not own:
        return out
    out = written(out, "exact")
    discard(looked)
    where = spark._jvm.org.apache.hadoop.fs.Path(folder)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
    return out
