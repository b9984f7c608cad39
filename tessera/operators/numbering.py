"""Gapless numbers over a global order without a single-partition window."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.durable import discard_at, new_folder, table_at, written


def numbered_globally(rows: DataFrame, order: list[str | Column], out: str, start: int = 1) -> DataFrame:
    """``rows`` with ``out`` = start, start + 1, ... in the given order.

    The rows are range-partitioned, sorted and written once to the shared folder; only one count per partition meets in one place.
    """
    srt = written(rows.orderBy(*order).withColumn("_mid", F.monotonically_increasing_id()), "numbered")
    counts = srt.groupBy(F.shiftright("_mid", 33).alias("_pid")).agg(F.count(F.lit(1)).alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = counts.select("_pid", before.alias("_before"))
    joined = srt.join(F.broadcast(offsets), F.shiftright("_mid", 33) == F.col("_pid"))  # as many rows as partitions
    return joined.withColumn(out, F.col("_before") + F.col("_mid").bitwiseAND(F.lit((1 << 33) - 1)) + start).drop("_mid", "_pid", "_before")


def in_batches(rows: DataFrame, order: list[str | Column], work: Callable[[DataFrame], DataFrame], folder: str, size: int, tasks: int) -> None:
    """``work`` over ``rows`` in batches of ``size`` for each of ``tasks`` parallel tasks, each batch's result a table below ``folder``.

    A run that ends in the middle loses the batch it was at; what it finished is there for the next run, which is given the rows that are still open.
    """
    spark = rows.sparkSession
    run, open_ = new_folder(spark, "batches").rsplit("-", 1)[1], new_folder(spark, "open")
    # A folder for each batch, so that a batch reads its own rows and no more, however many batches there are.
    numbered_globally(rows, order, "_no", 0).withColumn("_batch", F.floor(F.col("_no") / (size * tasks))).write.partitionBy("_batch").parquet(open_)
    count = spark.read.schema("_no long").parquet(open_).count()
    schema = T.StructType([*rows.schema, T.StructField("_no", T.LongType())])

    def planned(first: int) -> DataFrame:
        return work(spark.read.schema(schema).parquet(f"{open_}/_batch={first // (size * tasks)}").repartition(tasks, "_no").drop("_no"))

    with ThreadPoolExecutor(1) as ahead:  # the next batch is planned, not run, while one runs
        plan = ahead.submit(planned, 0) if count else None
        for first in range(0, count, size * tasks):
            batch = plan.result()
            if first + size * tasks < count:
                plan = ahead.submit(planned, first + size * tasks)
            table_at(batch, f"{folder}/{run}-{first:012d}")
    discard_at(spark, open_)
