"""Near-duplicate documents by SimHash fingerprints and a binary trie self-join.

Fingerprint: each shingle of ``width`` lower-cased words, repeats included, is hashed (XXH64, seed 42); a bit of the fingerprint is 1 if it is set in over half of
the hashes. Texts are scanned whole, in slices, and shingles are counted in chunks of bounded size.

Join: equal fingerprints are one class. Two tries over the distinct fingerprints are joined with themselves, one over their bits in order, one with the halves
swapped. A pair of nodes goes down together, adding up the bits that differ, and is pruned when they exceed the budget. Of ``bits`` differing bits one
half holds few: the first trie allows bits // 2 in its upper 32 levels, the second bits - bits // 2 - 1, both ``bits`` in all. Every pair within the budget is met in one of them.

Spread: the upper part of a trie, down to nodes of at most ``most`` fingerprints (the cut), is walked level by level as joins of node pairs with their children. A pair of
cut nodes is one group with the fingerprints below both, and the rest of the walk is arrays over a sorted list, in chunks of bounded size. A crowded prefix is cut deeper, so
no group grows with the data.

Only connection matters. A first walk with a budget of one bit joins what is closest: at most 32 pairs for a fingerprint. The second walk prunes two nodes whose fingerprints are all of one
component already, and a group keeps only links that join two of its components. Such a prune loses no link between components, and no group emits all its pairs.

Defined results: null, empty or blank text has fingerprint zero and links like any other. A text of fewer words than a shingle is one shingle. Rows of one fingerprint are one class, so repeated
rows get equal results. A null doc_id is never a component's id: where no row reached has another, the component is null. Rows that repeat a doc_id with another text are documents of their own. Extra
columns are passed over. An empty table gives an empty result. Reruns agree. Arrow batches hold 1000 rows at most from here on in the session.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm import textscan as ts
from tessera.llm.common import components, discard, small_batches, written

_U = np.uint64
_CHUNK = 40_000  # shingles counted at once
_FRONT = 200_000  # node pairs taken down at once
_LEAVES = 24  # a pair of nodes with so few leaf pairs is compared leaf by leaf


def _spaced(low: np.ndarray, s: np.ndarray, e: np.ndarray) -> tuple[bytes, np.ndarray, np.ndarray]:
    """The words one after another, each with one space behind it, and their places there."""
    size = e - s + 1
    end = np.cumsum(size)
    start = end - size
    out = np.full(int(end[-1]) if len(end) else 0, 0x20, np.uint8)
    letter = np.ones(len(out), bool)
    letter[end - 1] = False
    place = np.flatnonzero(letter)
    out[place] = low[place + np.repeat(s - start, e - s)]
    return out.tobytes(), start, end - 1


def fingerprints(data: np.ndarray, offsets: np.ndarray, width: int) -> np.ndarray:
    """The 64-bit fingerprint of each document of a slice."""
    n = len(offsets) - 1
    low = ts.LOWER[data]
    s, e, doc = ts.white_words(low, offsets)
    words = ts.counts_per_doc(doc, n)
    if not len(s):
        return np.zeros(n, _U)
    text, start, end = _spaced(low, s, e)
    last = np.cumsum(words)[doc] - 1  # the last word of each word's document
    first_word = np.cumsum(words) - words
    index = np.arange(len(s))
    begins = np.flatnonzero((index + width - 1 <= last) | ((words[doc] < width) & (index == first_word[doc])))
    stop = end[np.minimum(begins + width - 1, last[begins])]
    owner = doc[begins]
    ones, digest = np.zeros((n, 64), np.int64), xxhash.xxh64_intdigest
    for k in range(0, len(begins), _CHUNK):
        part = slice(k, k + _CHUNK)
        h = np.fromiter((digest(text[a:z], 42) for a, z in zip(start[begins[part]].tolist(), stop[part].tolist(), strict=True)), _U)
        bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        own = owner[part]
        heads = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
        ones[own[heads]] += np.add.reduceat(bits, heads, axis=0, dtype=np.int64)
    total = ts.counts_per_doc(owner, n)
    return np.packbits(ones * 2 > total[:, None], axis=1, bitorder="little").reshape(-1).view(_U)


def print_batches(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo, hi, data, offsets in ts.slices(batch.column(1)):
            prints = fingerprints(data, offsets, width)
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), pa.array(prints.view(np.int64))], ["doc_id", "print"])


class _Union:
    """Components of numbered groups while links come in."""

    def __init__(self, n: int):
        self.up = np.arange(n)

    def roots(self) -> np.ndarray:
        while True:
            higher = self.up[self.up]
            if (higher == self.up).all():
                return self.up
            self.up = higher

    def join(self, a: int, b: int) -> bool:
        up = self.up
        while up[a] != a:
            up[a] = up[up[a]]
            a = up[a]
        while up[b] != b:
            up[b] = up[up[b]]
            b = up[b]
        up[max(a, b)] = min(a, b)
        return a != b


def joined(prints: np.ndarray, group: np.ndarray, u: tuple[int, int], v: tuple[int, int], depth: int, upper: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links between the leaves of two nodes (ranges of the sorted ``prints``; the same range joins with itself) that join components.

    ``group`` numbers the component of each print. From ``depth`` on the walk takes a bit a step; up to level 32 ``upper`` bits may differ, in all ``bits``.
    """
    union = _Union(int(group.max()) + 1 if len(group) else 0)
    links: list[tuple[int, int]] = []
    lead = lambda x, d: x >> _U(64 - d) if d else x * _U(0)
    start = np.array([[*u, *v]], np.int64).T
    stack = [(depth, start, np.bitwise_count(lead(prints[start[0]], depth) ^ lead(prints[start[2]], depth)).astype(np.int64))]
    own = group
    change = np.concatenate([[0], np.cumsum(own[1:] != own[:-1])])
    while stack:
        depth, pairs, err = stack.pop()
        limit = upper if depth <= 32 else bits
        a, az, b, bz = pairs
        # one component on both sides already: nothing to join
        done = (change[a] == change[az - 1]) & (change[b] == change[bz - 1]) & (own[a] == own[b])
        few = (az - a) * (bz - b) <= _LEAVES
        now = (err <= limit) & ~done
        leaf, deep = now & (few | (depth == 64)), now & ~few & (depth < 64)
        if leaf.any():
            x, y = _leaf_pairs(*pairs[:, leaf])
            diff = prints[x] ^ prints[y]
            near = (np.bitwise_count(diff) <= bits) & (np.bitwise_count(diff >> _U(32)) <= upper) & (own[x] != own[y])
            x, y = x[near], y[near]
            if len(x):
                _, once = np.unique(np.minimum(own[x], own[y]) * len(union.up) + np.maximum(own[x], own[y]), return_index=True)
                for i in once.tolist():
                    if union.join(int(own[x[i]]), int(own[y[i]])):
                        links.append((int(x[i]), int(y[i])))
                own = union.roots()[group]
                change = np.concatenate([[0], np.cumsum(own[1:] != own[:-1])])
        if deep.any():
            a, az, b, bz = pairs[:, deep]
            cost, bit = err[deep], _U(1) << _U(63 - depth)
            middle = lambda lo, hi: np.clip(np.searchsorted(prints, lead(prints[lo], depth) * (_U(2) * bit if depth else _U(0)) | bit), lo, hi)
            am, bm = middle(a, az), middle(b, bz)
            self_ = (a == b) & (az == bz)
            kids = np.concatenate([np.array([a, am, b, bm]), np.array([am, az, bm, bz]), np.array([a, am, bm, bz]), np.array([am, az, b, bm])[:, ~self_]], axis=1)
            cost = np.concatenate([cost, cost, cost + 1, (cost + 1)[~self_]])
            real = (kids[0] < kids[1]) & (kids[2] < kids[3]) & (cost <= (upper if depth < 32 else bits))
            kids, cost = kids[:, real], cost[real]
            for k in range(0, len(cost), _FRONT):
                stack.append((depth + 1, kids[:, k:k + _FRONT], cost[k:k + _FRONT]))
    at = np.array(links, np.int64).reshape(-1, 2)
    return prints[at[:, 0]], prints[at[:, 1]]


def _leaf_pairs(a: np.ndarray, az: np.ndarray, b: np.ndarray, bz: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All leaf pairs of node pairs that have few."""
    wide = bz - b
    count = (az - a) * wide
    inner = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
    wide = np.repeat(wide, count)
    return np.repeat(a, count) + inner // wide, np.repeat(b, count) + inner % wide


_PAIR = ["side", "da", "pa", "db", "pb"]


def _cut(prints: DataFrame, most: int, step: int) -> DataFrame:
    """Each print with its cut node: (depth, prefix) with at most ``most`` prints below it. Starts at the depth that an even spread would need."""
    total = prints.count() / 2
    depth = 0
    while depth < 64 and total / 2 ** depth > most:
        depth += step
    left, out, tables = prints, None, []
    while True:
        prefix = F.lit(0).cast("long") if depth == 0 else F.shiftrightunsigned("print", 64 - depth)
        left = left.withColumn("prefix", prefix)
        counts = written(left.groupBy("side", "prefix").agg(F.count(F.lit(1)).alias("n")), "counts")  # written, so that a crowded prefix can be split
        here = written(left.join(counts, ["side", "prefix"]).withColumn("depth", F.lit(depth)), "cut")
        tables += [counts, here]
        fits = (F.col("n") <= most) | (F.col("depth") == 64)
        out = here.where(fits).drop("n") if out is None else out.unionByName(here.where(fits).drop("n"))
        left = here.where(~fits).drop("n", "depth", "prefix")
        depth = min(depth + step, 64)
        if here.where(~fits).limit(1).count() == 0:
            break
    done = written(out, "cut")
    discard(*tables)
    return done


def _node_pairs(leaves: DataFrame, step: int, budget: dict[int, tuple[int, int]]) -> DataFrame:
    """Pairs of cut nodes whose prefixes differ within the budget: node pairs with their children, level by level from the roots."""
    cut = written(leaves.groupBy("side", "depth", "prefix").agg(F.min("own").alias("lo"), F.max("own").alias("hi")), "nodes")
    deepest = cut.agg(F.max("depth")).first()[0] or 0
    spark = cut.sparkSession
    pairs = spark.createDataFrame([(s, 0, 0, 0, 0) for s in budget], "side int, da int, pa long, db int, pb long")
    tables = [cut]
    for level in range(step, deepest + step, step):
        up = lambda d: f"CASE WHEN least(depth, {d}) = 0 THEN 0L ELSE shiftrightunsigned(prefix, depth - least(depth, {d})) END"
        kids = cut.selectExpr("side", f"least(depth, {level - step}) AS d0", f"{up(level - step)} AS p0", f"least(depth, {level}) AS d", f"{up(level)} AS p", "lo", "hi")
        kids = kids.groupBy("side", "d0", "p0", "d", "p").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
        one = lambda s: kids.selectExpr("side", f"d0 AS d{s}", f"p0 AS p{s}", f"d AS n{s}", f"p AS q{s}", f"lo AS lo{s}", f"hi AS hi{s}")  # noqa: E731, B023
        both = pairs.join(one("a"), ["side", "da", "pa"]).join(one("b"), ["side", "db", "pb"])
        common = "least(na, nb)"
        cut_to = lambda s: f"CASE WHEN {common} = 0 THEN 0L ELSE shiftrightunsigned(q{s}, n{s} - {common}) END"  # noqa: E731, B023
        allowed = F.coalesce(*[F.when((F.col("side") == s) & F.expr(f"{common} <= 32"), first).when(F.col("side") == s, every) for s, (first, every) in budget.items()])
        both = both.withColumn("err", F.expr(f"bit_count(({cut_to('a')}) ^ ({cut_to('b')}))")).where(F.col("err") <= allowed)
        both = both.where("NOT (loa = hia AND lob = hib AND loa = lob)")  # one component already
        both = both.where("NOT (da = db AND pa = pb) OR na < nb OR (na = nb AND qa <= qb)")  # a node with itself gives each pair of its children once
        pairs = written(both.selectExpr("side", "na AS da", "qa AS pa", "nb AS db", "qb AS pb"), "walk")
        tables.append(pairs)
    out = written(pairs, "pairs")
    discard(*tables)
    return out


def _links(prints: DataFrame, bits: int, most: int, step: int) -> DataFrame:
    """Links (a, b) of prints at ``bits`` or fewer differing bits that join the components ``own`` of ``prints`` (print, own)."""
    budget = {0: (bits // 2, bits), 1: (bits - bits // 2 - 1, bits)}
    swapped = F.shiftleft("print", 32).bitwiseOR(F.shiftrightunsigned("print", 32))
    sides = prints.select(F.lit(0).alias("side"), "print", "own").union(prints.select(F.lit(1), swapped, "own"))
    leaves = _cut(sides, most, step)
    pairs = _node_pairs(leaves, step, budget)
    at = lambda s: leaves.select("side", F.col("depth").alias(f"d{s}"), F.col("prefix").alias(f"p{s}"), F.lit(s).alias("end"), "print", "own")
    rows = pairs.join(at("a"), ["side", "da", "pa"]).select(*_PAIR, "end", "print", "own")
    other = pairs.where("NOT (da = db AND pa = pb)").join(at("b"), ["side", "db", "pb"]).select(*_PAIR, "end", "print", "own")
    rows = written(rows.union(other), "walk")

    def walk(key: tuple, table: pa.Table) -> pa.Table:
        side, da, pa_, db, pb = (x.as_py() for x in key)
        values = table.column("print").to_numpy().view(_U)
        order = np.argsort(values)
        values = values[order]
        group = np.unique(table.column("own").to_numpy()[order], return_inverse=True)[1]
        if (da, pa_) == (db, pb):
            u = v = (0, len(values))
        else:  # one node's prints all lie before the other's
            split = int(np.count_nonzero(np.asarray(table.column("end").to_pylist()) == "a"))
            first = table.column("end")[int(order[0])].as_py() == "a"
            split = split if first else len(values) - split
            u, v = (0, split), (split, len(values))
        a, b = joined(values, group, u, v, min(da, db), *budget[side])
        if side:
            a, b = (x << _U(32) | x >> _U(32) for x in (a, b))
        out = pa.table({"a": a.view(np.int64), "b": b.view(np.int64)})
        ts.release()
        return out

    links = written(rows.groupBy(*_PAIR).applyInArrow(walk, "a long, b long"), "links")
    discard(leaves, pairs, rows)
    return links


def simhash_components(docs: DataFrame, bits: int = 4, width: int = 4, most: int = 20_000, step: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, fingerprint (16 hex digits), component_id.

    ``bits``: most differing bits of a link (2 or more); ``width``: words of a shingle; ``most``: fingerprints of a cut node; ``step``: levels of a round.
    """
    small_batches(docs.sparkSession)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    drawn = written(texts.mapInArrow(ts.tidy(lambda it: print_batches(it, width)), "doc_id long, print long"), "prints")
    classes = written(drawn.groupBy("print").agg(F.min("doc_id").alias("rep")), "classes")
    near = _links(classes.select("print", F.col("print").alias("own")), 1, most, step)
    label = components(near)
    joined_ = classes.join(label, F.col("print") == F.col("node"), "left").select("print", F.coalesce("component", "print").alias("own"))
    joined_ = written(joined_, "own")
    far = _links(joined_, bits, most, step)
    label = components(near.union(far))
    named = classes.join(label, F.col("print") == F.col("node"), "left").select("print", "rep", F.coalesce("component", "print").alias("component"))
    named = classes_named = written(named, "named")
    smallest = written(named.groupBy("component").agg(F.min("rep").alias("component_id")), "smallest")  # written, so that a large component can be split
    named = written(named.join(smallest, "component").select("print", "component_id"), "named")
    out = drawn.join(named, "print").select("doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id")
    out = written(out, "components")
    discard(drawn, classes, near, far, joined_, classes_named, smallest, named)
    return out
