"""Near-duplicate documents by fast similarity sketching, banding and exact verification.

Sketch: every shingle of a document is thrown, round after round, into one of ``t`` bins chosen by a hash of the round;
a bin keeps the smallest (round, hash) it has seen. Rounds go on until every bin of the document is filled, and from
round ``t`` on round ``t + k`` puts all shingles into bin ``k``, so that after at most ``2t`` rounds every coordinate is
filled, for a set of one shingle too. Two sets agree in a coordinate with the probability of their Jaccard similarity,
with the concentration of independent minima, and a large set costs little more than one pass.

Banding: ``bands`` groups of ``rows`` coordinates. At similarity 0.85 a pair shares none of 40 bands of 5 rows with
probability (1 - 0.85^5)^40, below 1e-10. Documents of equal sets are one class first, so thousands of copies count once.

Linking: in each bucket of a band, a leader is compared with the other members (a bucket of m gives m - 1 pairs).
Then the documents of every bucket that still holds several components are joined by prefix: two sets that reach the similarity share
one of the rarest shingles of each (as many as may be missing, and one more). Only shingles that documents of different components have
make pairs, so a bucket's members are never all paired, and no link that any bucket offers is lost. Every link is
confirmed on the full sets of 64-bit shingle hashes.

Everything is keyed by the set (128 bits), not by doc_id: rows that repeat a doc_id with another text are documents of their own.

Defined results: null or blank text has an empty set, links with nothing and stays. A text of fewer words than a
shingle is one shingle. Rows of equal sets are one class, so rows that repeat get equal results. A null doc_id stays and links
nothing; it shows the component of its set, if rows with a doc_id have that. Extra columns are passed over. Reruns agree. Arrow batches hold 1000 rows at most
from here on in the session.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm import textscan as ts
from tessera.llm.common import components, discard, small_batches, written

_U = np.uint64
_PARTS = 64
_WORD_BITS = 19
_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes, sorted within each document, and their number per document."""
    n = len(offsets) - 1
    low = ts.LOWER[data]
    s, e, doc = ts.white_words(low, offsets)
    words = ts.counts_per_doc(doc, n)
    h = ts.span_hash(low, s, e)
    q = _U(0xD6E8FEB86659FD93)
    total = h.copy()
    if len(h) >= width:  # polynomial over the words of a window, window by window
        window = np.zeros(len(h) - width + 1, np.uint64)
        for k in range(width):
            window = window * q + h[k:len(h) - width + 1 + k]
        inside = doc[:len(window)] == doc[width - 1:]
        full, full_doc = ts.mix64(window[inside]), doc[:len(window)][inside]
    else:
        full, full_doc = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    short = np.flatnonzero((words > 0) & (words < width))
    if len(short):
        first = np.cumsum(words) - words
        acc = np.zeros(len(short), np.uint64)
        for k in range(width - 1):
            has = words[short] > k
            acc[has] = acc[has] * q + total[first[short[has]] + k]
        full = np.concatenate([full, ts.mix64(acc ^ words[short].astype(np.uint64))])
        full_doc = np.concatenate([full_doc, short])
    if not len(full):
        return full, np.zeros(n, np.int64)
    order = np.lexsort((full, full_doc))
    full, full_doc = full[order], full_doc[order]
    new = np.ones(len(full), bool)
    new[1:] = (full[1:] != full[:-1]) | (full_doc[1:] != full_doc[:-1])
    return full[new], ts.counts_per_doc(full_doc[new], n)


def sketches(elements: np.ndarray, counts: np.ndarray, t: int) -> np.ndarray:
    """(documents, t) coordinates by rounds of hashed bin placement; rows of empty sets are all ones."""
    n = len(counts)
    coords = np.full(n * t, _EMPTY, np.uint64)
    doc = np.repeat(np.arange(n), counts)
    h = elements
    for i in range(2 * t):
        if not len(h):
            break
        x = ts.mix64(h + _U((i + 1) * 0xA0761D6478BD642F % (1 << 64)))
        place = ((x >> _U(32)) * _U(t) >> _U(32)).astype(np.int64) if i < t else np.full(len(h), i - t)
        np.minimum.at(coords, doc * t + place, (_U(i) << _U(32)) | (x & _U(0xFFFFFFFF)))
        open_ = (coords.reshape(n, t) == _EMPTY).any(axis=1)
        keep = open_[doc]
        if not keep.all():
            h, doc = h[keep], doc[keep]
    return coords.reshape(n, t)


def band_hashes(coords: np.ndarray, bands: int, rows: int) -> np.ndarray:
    acc = np.zeros((coords.shape[0], bands), np.uint64) + np.arange(1, bands + 1, dtype=np.uint64)
    cut = coords[:, :bands * rows].reshape(-1, bands, rows)
    for k in range(rows):
        acc = ts.mix64(acc * _U(0x9FB21C651E98DF25) + cut[:, :, k])
    return acc


def sketch_batches(batches: Iterator[pa.RecordBatch], width: int, bands: int, rows: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, prints = batch.column(0), batch.column(1)
        for lo, hi, data, offsets in ts.slices(batch.column(2), 1_000_000):
            sets, counts = shingle_sets(data, offsets, width)
            doc = np.repeat(np.arange(hi - lo), counts)
            sums = np.zeros((2, hi - lo), np.uint64)
            np.add.at(sums[0], doc, ts.mix64(sets + _U(1)))
            np.bitwise_xor.at(sums[1], doc, ts.mix64(sets ^ _U(0x5851F42D4C957F2D)))
            full = np.flatnonzero(counts)
            marks = band_hashes(sketches(sets, counts[full], bands * rows), bands, rows)
            per = np.zeros(hi - lo, np.int64)
            per[full] = bands
            yield pa.RecordBatch.from_arrays(
                [ids.slice(lo, hi - lo), prints.slice(lo, hi - lo), pa.array(counts), pa.array(sums[0].view(np.int64)), pa.array(sums[1].view(np.int64)), ts.long_array(marks.ravel(), per)],
                ["doc_id", "print", "n_shingles", "set_a", "set_b", "marks"])


def set_batches(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column(0)
        for lo, hi, data, offsets in ts.slices(batch.column(1)):
            sets, counts = shingle_sets(data, offsets, width)
            yield pa.RecordBatch.from_arrays([ids.slice(lo, hi - lo), ts.long_array(sets, counts)], ["id", "shingles"])


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Of distinct ``pairs`` (a, b), those whose full sets reach the similarity."""
    left = sets.select(F.col("id").alias("a"), F.col("shingles").alias("sa"))
    right = sets.select(F.col("id").alias("b"), F.col("shingles").alias("sb"))
    both = pairs.join(right, "b").join(left, "a")
    common = F.size(F.array_intersect("sa", "sb"))
    both = both.select("a", "b", common.alias("common"), (F.size("sa") + F.size("sb") - common).alias("union"))
    return both.where(F.lit(100) * F.col("common") >= F.lit(percent) * F.col("union")).select("a", "b")


def _open_pairs(member: DataFrame, sets: DataFrame, label: DataFrame, fits, percent: int) -> DataFrame:
    """Pairs of documents from buckets that hold several components, in different components, that can still reach the similarity.

    A pair at the similarity shares one of the n - ceil(percent * n / 100) + 1 rarest shingles of each set of n; of the smaller set
    even one of the n - ceil(2 * percent * n / (100 + percent)) + 1 rarest. Exact bounds keep the number low: a shingle that only one of these documents has cannot be common to any two, so the rest of a document's set (its
    core) bounds each overlap, and so do the sums of the smaller core counts over parts of the hash range. A document with so many
    shingles of its own that it reaches the similarity with smaller sets only (a heavy one) makes no pair with another such one.
    """
    tagged = member.join(label, F.col("id") == F.col("node"), "left").select("mark", "id", "size", F.coalesce("component", "id").alias("component"))
    mixed = tagged.groupBy("mark").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.count(F.lit(1)).alias("n")).where("lo < hi AND n > 2").select("mark")
    open_ = written(tagged.join(mixed, "mark", "left_semi").select("id", "size", "component").distinct(), "open")
    each = sets.join(open_, "id").select("id", "size", "component", F.explode("shingles").alias("x"))
    each = written(each.join(each.groupBy("x").agg(F.count(F.lit(1)).alias("df")), "x"), "each")
    part = F.pmod("x", F.lit(_PARTS)).cast("int")
    core = each.where("df > 1").groupBy("id", part.alias("part")).agg(F.count(F.lit(1)).cast("int").alias("n"))
    core = core.groupBy("id").agg(F.sum("n").alias("core"), F.map_from_entries(F.collect_list(F.struct("part", "n"))).alias("by"))
    core = core.select("id", "core", F.transform(F.sequence(F.lit(0), F.lit(_PARTS - 1)), lambda k: F.coalesce(F.try_element_at("by", k), F.lit(0))).alias("parts"))
    # Rarest shingles first; those that no other document has fill places of the prefix, but make no pair.
    rank = F.row_number().over(Window.partitionBy("id").orderBy("df", "x"))
    n = F.col("size")
    prefix = each.withColumn("rank", rank).where(F.col("rank") <= n - F.ceil(F.lit(percent) * n / F.lit(100)) + 1).where("df > 1")
    # The smaller of a pair (or both of equal size) needs the overlap of two sets of its own size at least: a shorter prefix.
    short = F.col("rank") <= n - F.ceil(F.lit(2 * percent) * n / F.lit(100 + percent)) + 1
    heavy = F.lit(100 + percent) * F.col("core") < F.lit(2 * percent) * n
    posts = prefix.withColumn("short", short).join(core, "id").where(F.lit(100) * F.col("core") >= F.lit(percent) * n)
    posts = posts.select("x", "id", "size", "component", "core", "parts", heavy.alias("heavy"), "short")
    of_x = posts.groupBy("x").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.min(F.when(F.col("short"), n)).alias("least"), F.max("size").alias("most"))
    # Written, so that the joins read both sides from shuffles and the rows of a very common shingle can be split.
    posts = written(posts.join(of_x.where("lo < hi").select("x", "least", "most"), "x"), "posts")
    names = {"id": "", "size": "n", "component": "c", "core": "k", "parts": "p", "heavy": "h"}
    side = lambda rows, s: rows.select("x", *[F.col(c).alias(p + s) for c, p in names.items()])
    short = side(posts.where("short"), "b")
    enough = lambda overlap: F.lit(100 + percent) * overlap >= F.lit(percent) * (F.col("na") + F.col("nb"))
    shares = enough(F.aggregate(F.zip_with("pa", "pb", lambda x, y: F.least(x, y)), F.lit(0), lambda acc, x: acc + x))
    reach = (F.col("ca") != F.col("cb")) & fits(F.col("na"), F.col("nb")) & enough(F.least("ka", "kb")) & shares
    larger = (F.col("na") < F.col("nb")) & reach
    some = side(posts.where("short AND size < most"), "a")
    more = side(posts.where("size > least"), "b")
    pairs = [side(posts.where("short AND NOT heavy"), "a").join(short.withColumnRenamed("x", "y"), (F.col("x") == F.col("y")) & (F.col("na") == F.col("nb")) & (F.col("hb") | (F.col("a") < F.col("b"))) & reach),
             some.where("NOT ha").join(more.withColumnRenamed("x", "y"), (F.col("x") == F.col("y")) & larger),
             some.where("ha").join(more.where("NOT hb").withColumnRenamed("x", "y"), (F.col("x") == F.col("y")) & larger)]
    pairs = [p.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")) for p in pairs]
    out = written(pairs[0].union(pairs[1]).union(pairs[2]).distinct(), "rest")
    discard(open_, each, posts)
    return out


def near_duplicates(docs: DataFrame, percent: int = 85, width: int = 5, bands: int = 40, rows: int = 5,
                    id_col: str = "doc_id", text_col: str = "text", prints: bool = False) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, kept; with ``prints`` also print, a hash of the text, and component, which tells components apart
    where rows of one doc_id lie in several (null for an empty set).

    ``percent``: least similarity of a link, in hundredths. ``kept`` marks the smallest doc_id of each component.
    """
    small_batches(docs.sparkSession)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    schema = "doc_id long, print long, n_shingles long, set_a long, set_b long, marks array<long>"
    printed = texts.select("doc_id", F.xxhash64("text").alias("print"), "text")
    drawn = written(printed.mapInArrow(ts.tidy(lambda it: sketch_batches(it, width, bands, rows)), schema), "sketch")
    # One class per distinct set, with a number of its own; it has the smallest doc_id of its rows.
    classes = (drawn.where("n_shingles > 0 AND doc_id IS NOT NULL").groupBy("set_a", "set_b")
               .agg(F.max("n_shingles").alias("size"), F.min(F.struct("doc_id", "print", "marks")).alias("m")))
    classes = classes.select("set_a", "set_b", "size", F.col("m.doc_id").alias("rep"), F.col("m.print").alias("print"), F.col("m.marks").alias("marks"))
    classes = written(classes.withColumn("id", F.monotonically_increasing_id()), "classes")
    rows_ = classes.select("id", "set_a", "set_b", "size", F.posexplode("marks").alias("band", "mark"))
    shared = rows_.groupBy("mark").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    member = drawn_members = written(rows_.join(shared, "mark"), "members")
    # A leader per bucket: in half of the bands the member whose buckets are the largest, which is the most central of a group of
    # edited copies; in the others one drawn by one of two orders, so that a large group is not tied to one leader.
    weigh = member.groupBy("id").agg(F.sum("n").alias("weight"))
    member = written(member.join(weigh, "id"), "members")
    discard(drawn_members)
    chance = F.xxhash64("set_a", "set_b", F.col("band") % 4)
    draw = F.struct(F.when(F.col("band") % 2 == 0, -F.col("weight")).otherwise(F.lit(0)), chance, "set_a", "set_b")
    # Written, so that the join reads both sides from shuffles and the rows of a very large bucket can be split.
    leads = written(member.groupBy("mark").agg(F.min_by("id", draw).alias("lead"), F.min_by("size", draw).alias("lead_size")), "leads")
    # |A| / |B| bounds the similarity: sizes too far apart need no comparison.
    fits = lambda x, y: F.lit(100) * F.least(x, y) >= F.lit(percent) * F.greatest(x, y)
    first = (member.join(leads, "mark").where((F.col("id") != F.col("lead")) & fits(F.col("size"), F.col("lead_size")))
             .select(F.least("id", "lead").alias("a"), F.greatest("id", "lead").alias("b")).distinct())
    first = written(first, "pairs")
    # One text per class that shares a bucket, found by doc_id and a hash of the text.
    wanted = written(classes.join(member.select("id").distinct(), "id", "left_semi").select("id", F.col("rep").alias("doc_id"), "print"), "wanted")
    # Only texts whose hash may be wanted are dealt out: a bitmap of wanted hashes, of at most 2 ** _WORD_BITS rows, comes first. The join is the same at every size.
    word, bit = F.shiftrightunsigned("print", 64 - _WORD_BITS), F.expr("shiftleft(1L, cast(print & 63 AS int))")
    bitmap = wanted.groupBy(word.alias("word")).agg(F.bit_or(bit).alias("bits"))
    likely = printed.withColumn("word", word).join(F.broadcast(bitmap), "word").where(F.col("bits").bitwiseAND(bit) != 0)
    picked = likely.join(wanted.hint("merge"), ["doc_id", "print"]).select("id", "text").dropDuplicates(["id"])
    sets = written(picked.mapInArrow(ts.tidy(lambda it: set_batches(it, width)), "id long, shingles array<long>"), "sets")
    links = written(_verified(first, sets, percent), "links")
    rest = _open_pairs(member, sets, components(links), fits, percent)
    more = written(_verified(rest.join(first, ["a", "b"], "left_anti"), sets, percent), "links")
    discard(member, leads, wanted, first, rest, sets)
    label = components(links.union(more))
    named = classes.join(label, F.col("id") == F.col("node"), "left").select("set_a", "set_b", "rep", F.coalesce("component", "id").alias("component"))
    smallest = named.groupBy("component").agg(F.min("rep").alias("component_id"))
    named = named.join(smallest, "component").select("set_a", "set_b", "component_id", "component")
    out = drawn.select("doc_id", "print", "n_shingles", "set_a", "set_b").join(named, ["set_a", "set_b"], "left")
    out = out.withColumn("component_id", F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component_id")))
    kept = (F.col("doc_id").isNull() | (F.col("doc_id") == F.col("component_id"))).alias("kept")
    out = written(out.select("doc_id", "n_shingles", "component_id", kept, *(["print", "component"] if prints else [])), "components")
    discard(drawn, classes, links, more)
    return out
