"""Substring deduplication by content-defined chunking.

A gear hash rolls over the bytes: h = 2h + G[byte] modulo 2^32, so it depends on the last 32 bytes only. A chunk ends
where the hash is the smallest of the ``reach`` bytes on either side (the first of equals). Where there is no such place for
3 * ``reach`` bytes it ends at the last of equals within them (so that chunks of a word said over and over are whole rounds
of it), and without any after ``most`` bytes. Cuts fall between characters. Whether a byte is such a place depends on 32 + 2 * ``reach`` bytes
around it and on no earlier cut, so in two copies of a passage the chunks fall into step at the first of them, and an
insertion moves only the chunks around it. Chunks are deduplicated by a 128-bit digest: the occurrence with the smallest
(doc_id, text hash) stays, every later one is a repeat. Runs of consecutive repeats are one span. A span counts when it has at
least ``least_words`` words. Repeats of a document's own chunks are no repeats across documents and stay.

A span ends at cuts: at either edge of a passage the chunk that also covers bytes beside it, or whose end depends on them,
is not in the span. The README has the measured share of short passages that are found.

Defined results: null and empty texts have no chunk; a repeated row's chunks repeat those of the first; a text shorter
than a chunk is one chunk; a whole copy of a document of fewer than ``least_words`` words is no span; null doc_ids are kept and come last in the order.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm import textscan as ts
from tessera.llm.common import discard, small_batches, written

_GEAR = (ts.mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95)) >> np.uint64(32)).astype(np.uint32)


def gear_hashes(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The rolling hash at each byte, restarted at each document: sum of G[b[i-j]] << j over the last 32 bytes."""
    h = _GEAR[data]
    room = np.arange(len(data), dtype=np.int64) - np.repeat(offsets[:-1], np.diff(offsets))  # bytes before, within the document
    for step in (1, 2, 4, 8, 16):
        moved = np.zeros_like(h)
        moved[step:] = h[:-step] << np.uint32(step)
        moved[room < step] = 0
        h = h + moved
    return h


def chunk_ends(data: np.ndarray, offsets: np.ndarray, bits: int, least: int, most: int) -> tuple[np.ndarray, np.ndarray]:
    """End (exclusive) of every chunk, and its document; cuts where the top ``bits`` of the hash are zero."""
    after = _between_characters(data)
    cuts = np.flatnonzero(((gear_hashes(data, offsets) >> np.uint32(32 - bits)) == 0) & after) + 1
    return _ends(cuts, np.flatnonzero(after), offsets, least, most)


def local_ends(data: np.ndarray, offsets: np.ndarray, reach: int, most: int) -> tuple[np.ndarray, np.ndarray]:
    """End (exclusive) of every chunk, and its document; cuts where the hash is the smallest within ``reach`` bytes."""
    after = _between_characters(data)
    # Each document's hashes, then ``reach`` largest values, so that no document sees the next one's.
    top = np.uint32(0xFFFFFFFF)
    at = np.arange(len(data)) + reach * (1 + np.repeat(np.arange(len(offsets) - 1), np.diff(offsets)))
    h = np.full(len(data) + reach * len(offsets), top)
    h[at] = np.where(after, gear_hashes(data, offsets), top)
    low, width = h, 1  # low[i]: smallest of h[i:i + width]
    while width < reach:
        step = min(width, reach - width)
        low = np.concatenate([np.minimum(low[:-step], low[step:]), low[-step:]])
        width += step
    here = h[at]
    before = low[at - reach]
    equals = (here <= before) & (here <= low[np.minimum(at + 1, len(h) - 1)]) & (here < top)
    return _ends(np.flatnonzero(equals & (here < before)) + 1, np.flatnonzero(after), offsets, 1, most, np.flatnonzero(equals) + 1, 3 * reach)


def _between_characters(data: np.ndarray) -> np.ndarray:
    """Whether a cut may follow each byte: none before a continuation byte."""
    after = np.ones(len(data), bool)
    after[:-1] = (data[1:] & 0xC0) != 0x80
    return after


def _ends(cuts: np.ndarray, free: np.ndarray, offsets: np.ndarray, least: int, most: int, spare: np.ndarray | None = None, some: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """The cuts taken; a chunk that would exceed ``some`` bytes ends at its last spare cut within them, if there is one."""
    ends, docs = [], []
    bound = np.searchsorted(cuts, offsets)
    cuts_list = cuts.tolist()
    for d in range(len(offsets) - 1):
        at, stop = int(offsets[d]), int(offsets[d + 1])
        k, last = int(bound[d]), int(bound[d + 1])
        while at < stop:
            while k < last and cuts_list[k] < at + least:
                k += 1
            nxt = cuts_list[k] if k < last else stop
            if spare is not None and nxt - at > some and (j := np.searchsorted(spare, at + some, "right")) and spare[j - 1] > at:
                nxt = int(spare[j - 1])
            if nxt - at > most:
                nxt = int(free[np.searchsorted(free, at + most - 1, "right") - 1]) + 1
            at = min(nxt, stop)
            ends.append(at)
            docs.append(d)
    return np.array(ends, np.int64), np.array(docs, np.int64)


def chunk_batches(batches: Iterator[pa.RecordBatch], reach: int, most: int) -> Iterator[pa.RecordBatch]:
    """One row per chunk: place = its number in the document * 2**24 + its words, span = start * 2**32 + end in characters; and per
    document a row with place = -1 and its characters as the span's end."""
    for batch in batches:
        ids, row_keys, prints = batch.column(0), batch.column(2), batch.column(3)
        for lo, hi, data, offsets in ts.slices(batch.column(1)):
            e, doc = local_ends(data, offsets, reach, most)
            s = np.concatenate([[0], e[:-1]]).astype(np.int64)[:len(e)]
            no = np.arange(len(doc)) - np.searchsorted(doc, doc, "left")
            a = ts.span_hash(data, s, e)
            b = ts.span_hash(data ^ np.uint8(0x5A), s, e) ^ ts.mix64((e - s).astype(np.uint64))
            chars = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
            base = chars[offsets[:-1]][doc]
            ws, _, _ = ts.white_words(data, offsets)
            words = np.searchsorted(ws, e) - np.searchsorted(ws, s)
            n = hi - lo
            none = np.zeros(n, np.int64)
            at = pa.array(lo + np.concatenate([np.arange(n), doc]))
            cols = [(none, a.view(np.int64)), (none, b.view(np.int64)), (none - 1, (no << 24) + words), (np.diff(chars[offsets]), ((chars[s] - base) << 32) + chars[e] - base)]
            yield pa.RecordBatch.from_arrays([ids.take(at), row_keys.take(at), prints.take(at), *(pa.array(np.concatenate(c).astype(np.int64)) for c in cols)],
                                             ["doc_id", "row", "print", "digest_a", "digest_b", "place", "span"])


def repeated_spans(docs: DataFrame, reach: int = 21, most: int = 128, least_words: int = 16,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_chars, n_chunks, n_repeated (chunks in spans), spans (start, end, words),
    n_removed (characters in spans)."""
    small_batches(docs.sparkSession)
    text = F.col(text_col).cast("string")
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"), F.monotonically_increasing_id().alias("row"), F.xxhash64(text).alias("print"))
    schema = "doc_id long, row long, print long, digest_a long, digest_b long, place long, span long"
    every = written(texts.mapInArrow(ts.tidy(lambda it: chunk_batches(it, reach, most)), schema), "chunks")
    chunks = every.where("place >= 0")
    key = ["digest_a", "digest_b"]
    # Both written, so that the joins read both sides from shuffles and the rows of a very common chunk can be split.
    twice = written(chunks.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"), "twice")
    shared = written(chunks.join(twice, key, "left_semi"), "shared")
    # By content: among rows of one doc_id the text decides, so that reruns on other files mark the same texts.
    order = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "print", "row")
    first = written(shared.groupBy(*key).agg(F.min(order).alias("first")), "first")
    again = shared.join(first, key).where(F.col("row") != F.col("first.row"))
    again = again.select("row", F.shiftright("place", 24).alias("no"), F.col("place").bitwiseAND((1 << 24) - 1).alias("words"),
                         F.shiftright("span", 32).cast("int").alias("start"), F.col("span").bitwiseAND((1 << 32) - 1).cast("int").alias("end"))
    runs = again.withColumn("run", F.col("no") - F.row_number().over(Window.partitionBy("row").orderBy("no")))
    spans = (runs.groupBy("row", "run").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.sum("words").alias("words"), F.count(F.lit(1)).alias("n"))
             .where(F.col("words") >= least_words))
    spans = spans.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("start", "end", "words"))).alias("spans"), F.sum("n").alias("n"), F.sum(F.col("end") - F.col("start")).alias("cut"))
    whole = every.groupBy("row").agg(F.max("doc_id").alias("doc_id"), F.max(F.when(F.col("place") < 0, F.col("span"))).alias("n_chars"), F.count_if(F.col("place") >= 0).alias("n_chunks"))
    out = whole.join(spans, "row", "left")
    none = F.expr("cast(array() as array<struct<start:int,end:int,words:bigint>>)")
    out = out.select("doc_id", F.col("n_chars").cast("long").alias("n_chars"), "n_chunks", F.coalesce("n", F.lit(0)).cast("long").alias("n_repeated"),
                      F.coalesce("spans", none).alias("spans"), F.coalesce("cut", F.lit(0)).cast("long").alias("n_removed"))
    out = written(out, "spans")
    discard(every, twice, shared, first)
    return out


def without_spans(text: F.Column, spans: F.Column) -> F.Column:
    """The text with the character spans cut out (spans sorted and apart, as :func:`repeated_spans` gives them)."""
    starts = F.concat(F.array(F.lit(0)), F.transform(spans, lambda s: s["end"]))
    ends = F.concat(F.transform(spans, lambda s: s["start"]), F.array(F.length(text)))
    return F.concat_ws("", F.zip_with(starts, ends, lambda s, e: F.substring(text, s + 1, e - s)))
