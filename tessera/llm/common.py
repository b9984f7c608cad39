"""Shared distributed steps: durable cuts of the lineage, gapless global positions, running sums, components."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share (spark.checkpoint.dir). Without one a cluster raises; a single machine gets one, as in tests."""
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not path:
        current = spark.sparkContext._jsc.sc().getCheckpointDir()
        if current.isDefined():
            return current.get()
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        path = tempfile.mkdtemp(prefix="tessera-")
        spark.sparkContext.setCheckpointDir(path)
    return path


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Arrow batches of at most ``rows`` rows from here on in this session (the setting stays, as plans run later), so that a Python
    worker holds few texts at once."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key, "10000")) <= rows:
        spark.conf.set(key, str(rows))


def written(df: DataFrame, label: str = "t") -> DataFrame:
    """``df`` as a table in the shared folder, read again: the plan above it is cut and a lost executor costs no rerun."""
    path = f"{shared_dir(df.sparkSession).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    schema = df.schema
    df.write.parquet(path)
    out = df.sparkSession.read.schema(schema).parquet(path)
    out._written_at = path
    for tables in _open:
        tables.append(out)
    return out


_open: list[list[DataFrame]] = []


@contextmanager
def scratch():
    """Gives a function that marks a table from :func:`written` as kept; the other tables written inside are deleted at the end. For
    callers that write a result within, so that no plan needs the tables any more."""
    tables: list[DataFrame] = []
    kept: list[DataFrame] = []
    _open.append(tables)

    def keep(df: DataFrame) -> DataFrame:
        kept.append(df)
        return df

    try:
        yield keep
    finally:
        _open.remove(tables)
        discard(*[t for t in tables if all(t is not k for k in kept)])


def packed(df: DataFrame, names: list[str]) -> tuple[DataFrame, Callable[[DataFrame, list], DataFrame]]:
    """``df`` with columns ``names`` and all others in one struct, so that no step meets a clashing name; and a function that selects the
    original columns and some new ones (a new one replaces one of its name) from a frame made of that."""
    others = [c for c in df.columns if c not in names]
    here = lambda c: F.col("`" + c.replace("`", "``") + "`")
    box = F.struct(*[here(c) for c in others]) if others else F.lit(None).cast("string")
    rows = df.select(*[here(c) for c in names], box.alias("_others"))

    def opened(made: DataFrame, new: list[str]) -> DataFrame:
        fields = [here(c) if c in names else F.col("_others").getField(c).alias(c) for c in df.columns if c.lower() not in {n.lower() for n in new}]
        return made.select(*fields, *[here(n) for n in new])

    return rows, opened


def discard(*frames: DataFrame) -> None:
    """Delete tables from :func:`written` that no plan needs any more."""
    for df in frames:
        spark = df.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(df._written_at)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names that ``df`` does not have, made from ``names``."""
    have, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in have:
            name += "_"
        have.add(name.lower())
        out.append(name)
    return out


#: A bitmap has at most 2 ** _WORD_BITS rows of 64 bits, whatever it is made of.
_WORD_BITS = 19


def with_hits(rows: DataFrame, wanted: DataFrame, column: str, hit: str) -> DataFrame:
    """``rows`` with ``hit``: false where the 64-bit hash in ``column`` is certainly none of ``wanted``'s.

    A bitmap of the wanted hashes is broadcast, of bounded size. Over some ten million hashes it tells less and less apart, and never wrongly: what it hits is still to be joined.
    """
    word = lambda c: F.shiftrightunsigned(c, 64 - _WORD_BITS)
    bit = lambda c: F.expr(f"shiftleft(1L, cast(`{c}` & 63 AS int))")
    at, bits, key = fresh(rows, "_word", "_bits", "_at")
    bitmap = wanted.groupBy(word(column).alias(key)).agg(F.bit_or(bit(column)).alias(bits))
    out = rows.withColumn(at, word(column)).join(F.broadcast(bitmap), F.col(at) == F.col(key), "left")
    return out.withColumn(hit, F.coalesce(F.col(bits).bitwiseAND(bit(column)) != 0, F.lit(False))).drop(at, bits, key)


_LOCAL_BITS = 33


def ordered(df: DataFrame, keys: list, mid: str = "_mid") -> DataFrame:
    """``df`` sorted globally by ``keys`` over range partitions and written, with ``mid`` = partition and row in it.

    The sort is a range partitioning, so a key that holds a third of the rows is fine as long as the later keys tell
    its rows apart.
    """
    return written(df.orderBy(*keys).withColumn(mid, F.monotonically_increasing_id()), "sorted")


def partition_of(mid: str) -> F.Column:
    return F.shiftright(F.col(mid), _LOCAL_BITS)


def with_position(srt: DataFrame, position: str, by: list[str] | None = None, mid: str = "_mid") -> DataFrame:
    """A gapless 0-based ``position`` over a frame from :func:`ordered`.

    Only one count per range partition meets in one place: as many rows as there are partitions.
    """
    per = srt.groupBy(partition_of(mid).alias("_pid")).agg(F.count(F.lit(1)).alias("_n"))
    w = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per.select("_pid", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_before"))
    return (srt.join(F.broadcast(offsets), partition_of(mid) == F.col("_pid"))
            .withColumn(position, F.col("_before") + F.col(mid).bitwiseAND(F.lit((1 << _LOCAL_BITS) - 1)))
            .drop("_pid", "_before"))


def running_sum(srt: DataFrame, value: str, out: str, by: list[str] | None = None, mid: str = "_mid") -> DataFrame:
    """The inclusive running sum of ``value`` in the order of :func:`ordered`, within ``by`` (leading sort keys).

    Blocks of 4096 consecutive rows are summed by hash aggregation, the block sums are accumulated partition by
    partition, and rows add up within their block. No task gets all rows of a group.
    """
    by = by or []
    keys = [F.col(k).alias(f"_k{i}") for i, k in enumerate(by)]
    names = [f"_k{i}" for i in range(len(by))]
    srt = srt.withColumn("_blk", F.shiftright(F.col(mid), 12))
    sums = srt.select(*keys, F.col("_blk").alias("_b"), F.col(value).alias("_v")).groupBy(*names, "_b").agg(F.sum("_v").alias("_s"))
    sums = sums.withColumn("_pid", F.shiftright(F.col("_b"), _LOCAL_BITS - 12))
    before = Window.rowsBetween(Window.unboundedPreceding, -1)
    parts = sums.groupBy(*names, "_pid").agg(F.sum("_s").alias("_p"))
    outer = before.partitionBy(*(names or [F.lit(0)])).orderBy("_pid")
    parts = parts.select(*[F.col(n).alias(f"_p{n}") for n in names], F.col("_pid").alias("_p_pid"), F.coalesce(F.sum("_p").over(outer), F.lit(0)).alias("_bp"))
    inner = before.partitionBy(*names, "_pid").orderBy("_b")
    sums = sums.withColumn("_bb", F.coalesce(F.sum("_s").over(inner), F.lit(0)))
    on = [F.col(n).eqNullSafe(F.col(f"_p{n}")) for n in names] + [F.col("_pid") == F.col("_p_pid")]
    sums = sums.join(parts, on).select(*names, "_b", (F.col("_bb") + F.col("_bp")).alias("_off"))
    rows = Window.partitionBy(*by, "_blk").orderBy(mid).rowsBetween(Window.unboundedPreceding, 0)
    on = [F.col(k).eqNullSafe(F.col(n)) for k, n in zip(by, names, strict=True)] + [F.col("_blk") == F.col("_b")]
    return (srt.withColumn("_in", F.sum(value).over(rows)).join(sums, on)
            .withColumn(out, F.col("_in") + F.col("_off")).drop("_blk", "_b", "_in", "_off", *names))


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component): the smallest node each node of ``edges`` (a, b: long) can reach.

    Every round takes the minimum over neighbours (partial aggregation, so a node with very many neighbours is no
    bottleneck) and then jumps to the label's own label, which halves distances. Each round's labels are a written
    table. ``max_rounds`` only guards against an endless loop: it raises, nothing is cut.
    """
    edges = written(edges.where(F.col("a") != F.col("b")).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    last = labels = written(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.min("a")).alias("label")), "labels")
    for _ in range(max_rounds):
        reach = both.join(labels, F.col("b") == F.col("node")).groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        step = labels.join(reach, "node").select("node", "label", F.least("label", "near").alias("next"))
        own = labels.select(F.col("node").alias("next"), F.col("label").alias("jump"))
        step = written(step.join(own, "next", "left").select("node", "label", F.least(F.col("next"), F.col("jump")).alias("next")), "labels")
        moved = step.where(F.col("label") != F.col("next")).limit(1).count()
        discard(last)
        last, labels = step, step.select("node", F.col("next").alias("label"))
        if not moved:
            discard(edges)
            return labels.select("node", F.col("label").alias("component"))
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
