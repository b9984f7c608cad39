"""Incremental runs: new files or chunks are taken in micro-batches, merged into keyed tables, and never taken twice."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators import graph


class Deltas:
    """Keyed rows as a log of changes: each batch is a part of its own, so what a batch writes depends on its own rows only.

    The rows are the merge over the latest base and the parts after it, made when they are read. Every ``compact`` parts the merge is written as a new base. A part or base counts once it is whole
    (its ``_SUCCESS`` is the last file written), so a crash at any point leaves what was there before, and a batch that is run again replaces its own part. Parts and bases that a newer base covers are deleted after it.
    """

    def __init__(self, spark: SparkSession, folder: str, merge: Callable[[DataFrame], DataFrame], compact: int = 16):
        self.spark, self.folder, self.merge, self.compact = spark, folder.rstrip("/"), merge, compact

    def _whole(self, kind: str) -> list[int]:
        """Numbers of the parts or bases that were written to their end."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{kind}-*/_SUCCESS")
        found = path.getFileSystem(self.spark._jsc.hadoopConfiguration()).globStatus(path)
        return sorted(int(f.getPath().getParent().getName().rsplit("-", 1)[1]) for f in found or [])

    def _path(self, kind: str, number: int) -> str:
        return f"{self.folder}/{kind}-{number:012d}"

    def version(self) -> int:
        """The number of the last batch, -1 before the first."""
        return max(self._whole("base") + self._whole("part"), default=-1)

    def _current(self) -> list[str]:
        base = max(self._whole("base"), default=-1)
        return ([self._path("base", base)] if base >= 0 else []) + [self._path("part", k) for k in self._whole("part") if k > base]

    def read(self) -> DataFrame | None:
        paths = self._current()
        if not paths:
            return None
        rows = self.spark.read.parquet(*paths)
        return self.merge(rows) if len(paths) > 1 else rows  # a part or base by itself is merged already

    def append(self, rows: DataFrame, version: int) -> None:
        """The rows of batch ``version``; nothing where it is there already."""
        if self.version() >= version:
            return
        self.merge(rows).write.mode("overwrite").parquet(self._path("part", version))
        if len(self._current()) > self.compact:
            self.read().write.mode("overwrite").parquet(self._path("base", version))
            for kind in ("part", "base"):
                for k in self._whole(kind):
                    if k < version or kind == "part":
                        path = self.spark._jvm.org.apache.hadoop.fs.Path(self._path(kind, k))
                        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def run_available(stream: DataFrame, checkpoint: str, step: Callable[[DataFrame, int], None]) -> None:
    """Process all input there is, then stop; the checkpoint remembers what was taken."""
    stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def accumulate_graph(spark: SparkSession, chunk_edges: str, schema: str, folder: str, checkpoint: str, files_per_batch: int = 100) -> DataFrame:
    """Merge edges (ord, subject, predicate, object, source_chunks, chunk_id) that arrive as parquet files into one edge table."""
    table = Deltas(spark, folder, graph.edge_upsert)
    start = table.version() + 1
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(chunk_edges)

    def step(batch: DataFrame, number: int) -> None:
        table.append(graph.valid_edges(batch).select("ord", "subject", "predicate", "object", "source_chunks"), start + number)

    run_available(stream, checkpoint, step)
    return table.read()


def windowed_counts(events: DataFrame, size: str = "1 hour", late: str = "30 minutes") -> DataFrame:
    """Counts and sums per window and event type; late events within the watermark still count."""
    return events.withWatermark("ts", late).groupBy(F.window("ts", size), "event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))


def resumed(inputs: DataFrame, outputs: DataFrame, key: str = "path") -> tuple[DataFrame, DataFrame]:
    """(to do, done): inputs without and with a non-empty output, by full path, so equal stems don't collide."""
    done = outputs.where("length > 0").select(key).distinct()
    return inputs.join(done, key, "left_anti"), inputs.join(done, key, "left_semi")
