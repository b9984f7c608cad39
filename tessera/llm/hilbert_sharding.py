"""Sharding along a Hilbert curve over several metadata dimensions.

Each dimension is quantised to ``2**bits`` cells: a categorical one by the running share of rows of its sorted values
(so cells hold about equal numbers of rows and neighbouring values stay together), a size by its logarithm. Rows are
sorted by the index of their cell on the Hilbert curve and cut into runs, so that each run, and each file of a run,
covers a compact box in every dimension at once and min/max statistics can skip it.

Law ``rows``: the runs are cut by position, so the numbers of rows of any two shards differ by one at most.

Defined results: a null text has no bytes (size 1) and the CRC of the empty text; null values of a dimension form one
cell range before all others; equal texts of equal metadata lie next to each other; rows that repeat are placed one by
one; an empty table gives an empty result. Other columns are carried along; ``curve``, ``shard`` and ``slot`` replace
columns of these names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import ordered, packed, running_sum, with_position, written


def hilbert_index(coords: np.ndarray, bits: int) -> np.ndarray:
    """Index on the Hilbert curve of integer points, shape (dimensions, points), each coordinate below 2**bits.

    Skilling's transform: undo the curve's exchanges and inversions from the highest bit down, Gray-encode, and
    interleave the bits.
    """
    x = [c.astype(np.int64).copy() for c in coords]
    n, q = len(x), 1 << (bits - 1)
    while q > 1:
        p = q - 1
        for i in range(n):
            high = (x[i] & q) != 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & p)
            x[0] = np.where(high, x[0] ^ p, x[0] ^ swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    t = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        t = np.where((x[n - 1] & q) != 0, t ^ (q - 1), t)
        q >>= 1
    out = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            out = (out << 1) | (((x[i] ^ t) >> b) & 1)
    return out


def curve_table(cells: DataFrame, dimensions: int, bits: int) -> DataFrame:
    """(_cell, curve) of distinct packed cells; 2**(dimensions * bits) rows at most, a few tasks."""
    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed = batch.column(0).to_numpy()
            coords = np.stack([(packed >> (bits * (dimensions - 1 - i))) & ((1 << bits) - 1) for i in range(dimensions)])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(hilbert_index(coords, bits))], ["_cell", "curve"])

    return written(cells.distinct().coalesce(4).mapInArrow(index, "_cell long, curve long"), "curve")


def value_cells(df: DataFrame, name: str, bits: int) -> DataFrame:
    """(v, cell): the cell of each value of ``name``, by the share of rows before it in sorted order."""
    counts = df.groupBy(F.col(name).alias("v")).agg(F.count(F.lit(1)).alias("n"))
    srt = running_sum(ordered(counts, [F.col("v").asc_nulls_first()]), "n", "upto")
    total = srt.agg(F.sum("n")).first()[0] or 1
    cell = F.floor((F.col("upto") - F.col("n")) * F.lit(1 << bits) / F.lit(total)).cast("long")
    return srt.select("v", F.least(cell, F.lit((1 << bits) - 1)).alias("cell"))


def hilbert_shards(docs: DataFrame, shards: int = 8, categories: tuple[str, ...] = ("lang", "source"), size: str = "size",
                   ties: tuple[str, ...] = ("text_crc32", "doc_id"), bits: int = 6) -> DataFrame:
    """``docs`` with curve (long), shard (int) and slot (long). ``size`` and ``ties`` name columns of ``docs``."""
    docs, opened = packed(docs, list(dict.fromkeys([*categories, size, *ties])))
    cells = []
    for i, name in enumerate(categories):
        v = value_cells(docs, name, bits).select(F.col("v").alias(f"_v{i}"), F.col("cell").alias(f"_c{i}"))
        v = written(v, "cells")
        docs = docs.join(v, docs[name].eqNullSafe(v[f"_v{i}"]), "left").drop(f"_v{i}")
        cells.append(F.col(f"_c{i}"))
    log = F.floor(F.log2(F.greatest(F.col(size), F.lit(1))) * F.lit((1 << bits) / 40.0))
    cells.append(F.least(F.greatest(log, F.lit(0)), F.lit((1 << bits) - 1)))
    cell = F.lit(0).cast("long")
    for c in cells:
        cell = F.shiftleft(cell, bits).bitwiseOR(c.cast("long"))
    docs = docs.withColumn("_cell", cell).drop(*[f"_c{i}" for i in range(len(categories))])
    # As many rows as cells are in use, at most 2**(dimensions * bits): of fixed size however many rows there are.
    curve = curve_table(docs.select("_cell"), len(cells), bits)
    placed = docs.join(F.broadcast(curve) if len(cells) * bits <= 20 else curve, "_cell").drop("_cell")
    srt = ordered(placed, ["curve", size, *ties])
    rows = with_position(srt, "_pos")
    total = srt.count()
    first = F.floor((F.col("shard").cast("long") * F.lit(total) + F.lit(shards - 1)) / F.lit(shards))
    out = rows.withColumn("shard", F.floor(F.col("_pos") * F.lit(shards) / F.lit(max(total, 1))).cast("int")).withColumn("slot", F.col("_pos") - first)
    return opened(out, ["curve", "shard", "slot"])


def measured(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with size (UTF-8 bytes of the text plus 1) and text_crc32 (unsigned), in place of columns of these names."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.withColumn("size", F.octet_length(text).cast("long") + 1).withColumn("text_crc32", F.crc32(text.cast("binary")))


def write_shards(placed: DataFrame, path: str, rows_per_file: int = 100_000) -> None:
    """Files of consecutive slots, in a folder per shard, sorted along the curve."""
    part = F.floor(F.col("slot") / F.lit(rows_per_file))
    (placed.withColumn("_part", part).repartitionByRange("shard", "_part").sortWithinPartitions("shard", "slot").drop("_part")
     .write.option("maxRecordsPerFile", rows_per_file).partitionBy("shard").parquet(path))
