"""Conversation prefix trie with a pointer-jumping rollup.

A node is a distinct sequence of first turns. It is keyed by the digest of its prefix, the exclusive or of the digests of (depth, role, text) of its turns: 128 bits, so a parent's key
is the node's own without its last turn, and prefix digests are running sums over blocks of rows. A conversation that holds a third of all turns is spread over tasks like any other.

Rollup: every node points to its parent's digest. In round k each node adds what the nodes that point to it have gathered, which lie exactly 2^k below, and then takes over
the pointer of the node it points to. After the logarithm of the greatest depth all subtree sums are there. A node with very many children is a partial aggregate, never a list.

Ends: the ids of the conversations that end at a node are sorted by range over all tasks and joined to pieces of at most 1024 ids. SHA-256 is a chain, so one task streams a node's pieces
through it, one piece at a time; nothing else of a group meets in one place.

Defined results: a null role or text is the empty string; turns of a null number come first; turns that share a number are ordered by role, then text; repeated rows are turns of their own. Rows without a conv_id belong to
no conversation. An empty table has no node, not even the root. Extra columns are passed over. Arrow batches hold 1000 rows at most from here on in the session.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm import textscan as ts
from tessera.llm.common import discard, partition_of, small_batches, with_position, written

_BLOCK_BITS = 12
_LOCAL_BITS = 33
_PIECE_BITS = 10
_KEY = ["a", "b"]


def _mark(depth: str) -> list[F.Column]:
    """128 bits of a turn at its depth, from the two digests of role and text."""
    return [F.xxhash64(F.lit(k), F.col(depth), "ta", "tb") for k in (1, 2)]


def _xor(*columns) -> F.Column:
    out = columns[0]
    for c in columns[1:]:
        out = out.bitwiseXOR(c)
    return out


def _running_xor(srt: DataFrame, by: str, values: list[str], outs: list[str]) -> DataFrame:
    """The inclusive running exclusive or of ``values`` within ``by``, over rows in the order of ``_mid`` (partition and row in it). Blocks of 4096 consecutive rows are folded by hash
    aggregation, block results partition by partition, and rows within their block."""
    srt = srt.withColumn("_blk", F.shiftright("_mid", _BLOCK_BITS))
    fold = lambda names, w=None: [(F.bit_xor(n) if w is None else F.coalesce(F.bit_xor(n).over(w), F.lit(0))) for n in names]
    named = lambda columns, stem: [c.alias(f"_{stem}{i}") for i, c in enumerate(columns)]
    at = lambda stem: [f"_{stem}{i}" for i in range(len(values))]
    before = Window.rowsBetween(Window.unboundedPreceding, -1)
    sums = srt.groupBy(F.col(by).alias("_by"), F.col("_blk").alias("_b")).agg(*named(fold(values), "s")).withColumn("_pid", F.shiftright("_b", _LOCAL_BITS - _BLOCK_BITS))
    parts = sums.groupBy("_by", "_pid").agg(*named(fold(at("s")), "p"))
    outer = before.partitionBy("_by").orderBy("_pid")
    parts = parts.select(F.col("_by").alias("_pby"), F.col("_pid").alias("_ppid"), *named(fold(at("p"), outer), "q"))
    inner = before.partitionBy("_by", "_pid").orderBy("_b")
    sums = sums.select("_by", "_b", "_pid", *named(fold(at("s"), inner), "i"))
    sums = sums.join(parts, (F.col("_by") == F.col("_pby")) & (F.col("_pid") == F.col("_ppid")))
    sums = sums.select("_by", "_b", *named([_xor(F.col(x), F.col(y)) for x, y in zip(at("i"), at("q"), strict=True)], "o"))
    rows = Window.partitionBy(by, "_blk").orderBy("_mid").rowsBetween(Window.unboundedPreceding, 0)
    srt = srt.select("*", *named([F.bit_xor(v).over(rows) for v in values], "in"))
    out = srt.join(sums, (F.col(by) == F.col("_by")) & (F.col("_blk") == F.col("_b")))
    out = out.withColumns({o: _xor(F.col(x), F.col(y)) for o, x, y in zip(outs, at("in"), at("o"), strict=True)})
    return out.drop("_blk", "_by", "_b", *at("in"), *at("o"))


def numbered_turns(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns (conv_id, at from 0, ta, tb, size, _mid) without their texts, and conversations (conv_id, n); both are written tables."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    rows = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text")).where("conv_id IS NOT NULL")
    rows = rows.orderBy("conv_id", F.col("turn").asc_nulls_first(), "role", "text")
    srt = written(rows.select("conv_id", F.xxhash64(F.lit(1), "role", "text").alias("ta"), F.xxhash64(F.lit(2), "text", "role").alias("tb"),
                              F.octet_length("text").cast("long").alias("size"), F.monotonically_increasing_id().alias("_mid")), "turns")
    placed = written(with_position(srt, "place", mid="_mid"), "placed")
    convs = written(placed.groupBy("conv_id").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("n")), "convs")
    rows = written(placed.join(convs.select("conv_id", "first"), "conv_id").select("conv_id", (F.col("place") - F.col("first")).alias("at"), "ta", "tb", "size", "_mid"), "turns")
    discard(srt, placed)
    return rows, convs


def spliced_prefixes(turns: DataFrame, every: int = 5, most: int = 9) -> tuple[DataFrame, DataFrame]:
    """Prefixes (conv_id, depth, a, b, pa, pb, size) and conversations (conv_id, length) after each conversation c got the first h turns of conversation c - c % ``every`` in place
    of its own, h = crc32(c) % ``most``. (pa, pb) is the prefix without its last turn, size the bytes of that turn's text. ``every`` = 1 leaves conversations as they are."""
    rows, convs = numbered_turns(turns)
    head = F.crc32(F.col("conv_id").cast("string")) % most
    base = F.col("conv_id") - F.col("conv_id") % every
    plan = convs.select("conv_id", "n", base.alias("base"), head.alias("head"))
    plan = plan.join(convs.select(F.col("conv_id").alias("base"), F.col("n").alias("has")), "base", "left").withColumn("lent", F.least("head", F.coalesce("has", F.lit(0))))
    plan = written(plan.withColumn("length", F.col("lent") + F.greatest(F.col("n") - F.col("head"), F.lit(0))), "plan")
    # Heads: at most most - 1 turns of a base, so a window over them is small.
    first = rows.where(F.col("at") < most - 1).withColumn("depth", F.col("at") + 1)
    first = first.select("conv_id", "depth", "size", *[m.alias(k) for m, k in zip(_mark("depth"), ("ma", "mb"), strict=True)])
    upto = Window.partitionBy("conv_id").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    first = written(first.select(F.col("conv_id").alias("base"), "depth", "size", "ma", "mb", F.bit_xor("ma").over(upto).alias("a"), F.bit_xor("mb").over(upto).alias("b")), "heads")
    before = lambda k, m: _xor(F.col(k), F.col(m)).alias("p" + k)
    heads = plan.select("conv_id", "base", "lent").join(first, "base").where("depth <= lent").select("conv_id", "depth", "a", "b", before("a", "ma"), before("b", "mb"), "size")
    # Tails: a conversation's own later turns, on top of the digest of its head.
    lead = first.select("base", F.col("depth").alias("lent"), F.col("a").alias("ha"), F.col("b").alias("hb"))
    plan_ = plan.join(lead, ["base", "lent"], "left").select("conv_id", "head", "lent", F.coalesce("ha", F.lit(0)).alias("ha"), F.coalesce("hb", F.lit(0)).alias("hb"))
    tail = rows.join(written(plan_, "leads"), "conv_id").where("at >= head").withColumn("depth", F.col("at") - F.col("head") + F.col("lent") + 1)
    tail = written(tail.select("conv_id", "depth", "size", "_mid", "ha", "hb", *[m.alias(k) for m, k in zip(_mark("depth"), ("ma", "mb"), strict=True)]), "tails")
    tail = _running_xor(tail, "conv_id", ["ma", "mb"], ["ra", "rb"]).withColumns({"a": _xor(F.col("ra"), F.col("ha")), "b": _xor(F.col("rb"), F.col("hb"))})
    tails = tail.select("conv_id", "depth", "a", "b", before("a", "ma"), before("b", "mb"), "size")
    out = written(heads.unionByName(tails), "prefixes")
    discard(rows, convs, first)
    return out, plan.select("conv_id", "length")


def _streamed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The SHA-256 of each key's pieces, joined by commas. Pieces come in order, a key's one after another."""
    key, digest, out = None, None, []
    for batch in batches:
        for a, b, piece in zip(*(batch.column(k).to_pylist() for k in ("a", "b", "piece")), strict=True):
            if (a, b) != key:
                if digest is not None:
                    out.append((*key, digest.hexdigest()))
                key, digest = (a, b), hashlib.sha256(piece.encode())
            else:
                digest.update(b"," + piece.encode())
        if len(out) >= 10_000:
            yield pa.RecordBatch.from_pylist([dict(zip(("a", "b", "ends_sha256"), x, strict=True)) for x in out])
            out = []
    if digest is not None:
        out.append((*key, digest.hexdigest()))
    if out:
        yield pa.RecordBatch.from_pylist([dict(zip(("a", "b", "ends_sha256"), x, strict=True)) for x in out])


def end_digests(ends: DataFrame) -> DataFrame:
    """(a, b, ends_sha256) from ends (a, b, conv_id)."""
    srt = written(ends.orderBy("a", "b", "conv_id").withColumn("_mid", F.monotonically_increasing_id()), "ends")
    pieces = srt.groupBy("a", "b", F.shiftright("_mid", _PIECE_BITS).alias("nr")).agg(F.sort_array(F.collect_list("conv_id")).alias("ids"))  # at most 1024 ids
    pieces = pieces.select("a", "b", "nr", F.array_join(F.transform("ids", lambda x: x.cast("string")), ",").alias("piece"))
    pieces = pieces.repartition("a", "b").sortWithinPartitions("a", "b", "nr")
    out = written(pieces.mapInArrow(ts.tidy(_streamed), "a long, b long, ends_sha256 string"), "digests")
    discard(srt)
    return out


def rolled_up(nodes: DataFrame, values: list[str], deepest: int) -> DataFrame:
    """Subtree sums of ``values`` by pointer jumping. ``nodes``: a, b, pa, pb (null at the root) and the values; returns a, b and the sums."""
    state = written(nodes.select("a", "b", F.col("pa").alias("ua"), F.col("pb").alias("ub"), *values), "rollup")
    reach = 1
    while reach <= deepest:
        # Written, so that joins read both sides from shuffles and the rows of a node with many below it can be split.
        gain = written(state.where("ua IS NOT NULL").groupBy(F.col("ua").alias("ga"), F.col("ub").alias("gb")).agg(*[F.sum(v).alias(f"g_{v}") for v in values]), "gain")
        up = state.select(F.col("a").alias("ja"), F.col("b").alias("jb"), F.col("ua").alias("na"), F.col("ub").alias("nb"))
        summed = written(state.join(gain, (F.col("a") == F.col("ga")) & (F.col("b") == F.col("gb")), "left")
                         .select("a", "b", "ua", "ub", *[(F.col(v) + F.coalesce(f"g_{v}", F.lit(0))).alias(v) for v in values]), "gained")
        step = written(summed.join(up, (F.col("ua") == F.col("ja")) & (F.col("ub") == F.col("jb")), "left").select("a", "b", F.col("na").alias("ua"), F.col("nb").alias("ub"), *values), "rollup")
        discard(state, gain, summed)
        state, reach = step, 2 * reach
    return state.select("a", "b", *values)


def prefix_trie(prefixes: DataFrame, convs: DataFrame) -> DataFrame:
    """One row per node: conv_id (its smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    ``prefixes`` and ``convs`` as from :func:`spliced_prefixes`. ``saved_tokens``: bytes that the members of the node and of those below it need not repeat.
    """
    small_batches(prefixes.sparkSession)
    zero, none = F.lit(0).cast("long"), F.lit(None).cast("long")
    root = convs.agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")).where("n_convs > 0")
    root = root.select(zero.alias("a"), zero.alias("b"), zero.alias("depth"), none.alias("pa"), none.alias("pb"), "conv_id", "n_convs", zero.alias("size"))
    below = prefixes.groupBy("a", "b").agg(F.max("depth").cast("long").alias("depth"), F.min("pa").alias("pa"), F.min("pb").alias("pb"), F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.max("size").alias("size"))
    nodes = written(root.unionByName(below), "nodes")
    kids = written(nodes.where("depth > 0").groupBy(F.col("pa").alias("ka"), F.col("pb").alias("kb")).agg(F.count(F.lit(1)).alias("n_children")), "kids")
    nodes_ = nodes.join(kids, (F.col("a") == F.col("ka")) & (F.col("b") == F.col("kb")), "left").withColumn("n_children", F.coalesce("n_children", zero))
    own = nodes_.withColumns({"n_leaves": F.when(F.col("n_children") == 0, 1).otherwise(0).cast("long"), "saved_tokens": (F.col("n_convs") - 1) * F.col("size")})
    own = written(own.drop("ka", "kb"), "nodes")
    deepest = own.agg(F.max("depth")).first()[0] or 0
    sums = rolled_up(own, ["n_leaves", "saved_tokens"], deepest)
    ends = prefixes.join(convs, "conv_id").where("depth = length").select("a", "b", "conv_id").unionByName(convs.where("length = 0").select(zero.alias("a"), zero.alias("b"), "conv_id"))
    digests = end_digests(ends)
    parent = own.select(F.col("a").alias("pa"), F.col("b").alias("pb"), F.col("conv_id").alias("parent_conv_id"))
    named = written(own.drop("n_leaves", "saved_tokens").join(parent, ["pa", "pb"], "left"), "named")
    out = named.join(sums, _KEY).join(digests, _KEY, "left")
    out = out.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"))
    out = written(out, "trie")
    discard(nodes, kids, own, digests, named)
    return out
