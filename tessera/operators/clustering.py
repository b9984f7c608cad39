"""Buckets under a token limit: repeated bisection of average-linkage clusters, per class.

Similarities are sparse: a pair that is not given has similarity 0. The average similarity of two clusters is then the sum of the given ones between them over the product of their sizes, and the sums of a merged
cluster are the sums of its parts, so average linkage is exact on the edges that exist.

A group (at first a class) that exceeds the limit is cut in two where its dendrogram was joined last; where the two highest joins are equally high, no height separates two clusters and it is halved by order. All groups of a
round are cut together. Large groups shrink by reciprocal nearest pairs: two clusters that are each other's nearest are joined in every dendrogram, and average linkage never brings a merged cluster
nearer than its parts were, so all such pairs of a round merge at once. When few clusters are left, one task ends the group; a group that is small to begin with is cut down to its buckets in one task. No task holds more than
``small`` rows of a side of a matrix, whatever a class holds.

Units that are alike (copies) are at distance 0 from each other and equally far from all others, so every dendrogram joins them first, at height 0: they start as one cluster of their number, and pairs are given between
one of each kind only. What is stored and compared grows with the kinds, not with the pairs of their copies.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.durable import discard, written
from tessera.operators.numbering import numbered_globally


def average_linkage_halves(distance: np.ndarray, sizes: np.ndarray | None = None, highest: float = -np.inf) -> np.ndarray:
    """0/1 side of each item when average linkage is cut into two clusters; all 0 when the two highest merges tie, as then
    no height separates two clusters. Items may be clusters already, of ``sizes``, whose own highest join is ``highest``."""
    n = len(distance)
    if n < 2:
        return np.zeros(n, int)
    d = distance.astype(float).copy()
    np.fill_diagonal(d, np.inf)
    size = np.ones(n) if sizes is None else sizes.astype(float).copy()
    members, heights = [[i] for i in range(n)], [highest]
    last: tuple[list[int], list[int]] = ([], [])
    for _ in range(n - 1):
        i, j = np.unravel_index(np.argmin(d), d.shape)
        i, j = min(i, j), max(i, j)
        heights.append(d[i, j])
        last = (members[i], members[j])
        row = (size[i] * d[i] + size[j] * d[j]) / (size[i] + size[j])
        d[i], d[:, i] = row, row
        d[i, i] = np.inf
        d[j], d[:, j] = np.inf, np.inf
        members[i] = members[i] + members[j]
        size[i] += size[j]
    sides = np.zeros(n, int)
    if max(heights[:-1]) >= heights[-1]:
        return sides
    first = last[0] if 0 in last[0] else last[1]
    sides[[k for k in range(n) if k not in set(first)]] = 1
    return sides


def bisect(tokens: np.ndarray, similarity: np.ndarray, limit: int, kinds: np.ndarray | None = None) -> list[list[int]]:
    """Positions of each bucket, left halves first. A bucket has at most ``limit`` tokens, or one item. ``kinds``: the row of each item in ``similarity``, which
    then is that of kinds; items of one kind are alike."""
    out: list[list[int]] = []
    kinds = np.arange(len(tokens)) if kinds is None else kinds
    todo = [np.arange(len(tokens))]
    while todo:
        at = todo.pop()
        if tokens[at].sum() <= limit or len(at) <= 1:
            out.append(at.tolist())
            continue
        found, first, kind, n = np.unique(kinds[at], return_index=True, return_inverse=True, return_counts=True)
        order = np.argsort(first)  # kinds by their first items
        found, n = found[order], n[order]
        d = 1 - np.clip(similarity[np.ix_(found, found)], 0, 1)
        side = average_linkage_halves(d, n, 0.0 if n.max() > 1 else -np.inf)[np.argsort(order)][kind]
        left, right = at[side == 0], at[side == 1]
        if not len(left) or not len(right):
            left, right = at[:len(at) // 2], at[len(at) // 2:]
        todo += [right, left]
    return out


def _linked(edges: DataFrame, clusters: DataFrame, small: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Merge reciprocal nearest clusters round by round until each group has at most ``small`` of them or nothing is left to merge.

    ``edges``: group, a, b, s (sum of similarities of two clusters). ``clusters``: group, c (smallest item in it), n, high (its highest join). Returns edges, clusters and (group, item, c) of all items.
    """
    places = clusters.select("group", F.col("c").alias("item"), "c")
    while True:
        counts = clusters.groupBy("group").agg(F.count(F.lit(1)).alias("_k")).where(F.col("_k") > small).select("group")
        active = edges.join(counts, "group", "left_semi")
        size = lambda s: clusters.select("group", F.col("c").alias(s), F.col("n").alias("n" + s), F.col("high").alias("h" + s))
        near = active.join(size("a"), ["group", "a"]).join(size("b"), ["group", "b"]).withColumn("mean", F.col("s") / (F.col("na") * F.col("nb")))
        near = written(near, "near")
        # A total order of pairs (nearest, then smallest numbers), so that at least one pair of each group is reciprocal.
        rank = F.struct("mean", (-F.col("a")).alias("x"), (-F.col("b")).alias("y"))
        ends = near.select("group", F.col("a").alias("c"), rank.alias("r")).union(near.select("group", "b", rank))
        best = ends.groupBy("group", "c").agg(F.max("r").alias("r"))
        pair = best.select("group", (-F.col("r.x")).alias("a"), (-F.col("r.y")).alias("b")).groupBy("group", "a", "b").agg(F.count(F.lit(1)).alias("votes")).where("votes = 2")
        merges = written(near.join(pair, ["group", "a", "b"]).select("group", "a", "b", (F.col("na") + F.col("nb")).alias("n"), F.greatest("ha", "hb", 1 - F.col("mean")).alias("high")), "merges")
        if merges.isEmpty():
            discard(near, merges)
            return edges, clusters, places
        moved = merges.select("group", F.col("b").alias("was"), F.col("a").alias("now"))
        places = written(places.join(moved, (places["group"] == moved["group"]) & (places["c"] == moved["was"]), "left").select(places["group"], "item", F.coalesce("now", "c").alias("c")), "places")
        kept = clusters.join(moved.select("group", F.col("was").alias("c")), ["group", "c"], "left_anti")
        new = merges.select("group", F.col("a").alias("c"), F.col("n").alias("_n"), F.col("high").alias("_high"))
        clusters = written(kept.join(new, ["group", "c"], "left").select("group", "c", F.coalesce("_n", "n").alias("n"), F.coalesce("_high", "high").alias("high")), "clusters")
        for s in ("a", "b"):
            to = moved.select("group", F.col("was").alias(s), F.col("now").alias("_to"))
            edges = edges.join(to, ["group", s], "left").withColumn(s, F.coalesce("_to", s)).drop("_to")
        edges = edges.where("a <> b").select("group", F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "s")
        edges = written(edges.groupBy("group", "a", "b").agg(F.sum("s").alias("s")), "edges")
        discard(near)


def _matrix(items: pd.DataFrame, sims: pd.DataFrame, key: str) -> np.ndarray:
    place = pd.Series(np.arange(len(items)), index=items[key])
    m = np.zeros((len(items), len(items)))
    a, b = (place.reindex(sims[c]).to_numpy().astype(np.int64) for c in ("a", "b"))
    m[a, b] = m[b, a] = sims["s"].to_numpy()
    return m


def _sides(edges: DataFrame, clusters: DataFrame, small: int) -> DataFrame:
    """(group, c, side) of each cluster: where the last join of its group's dendrogram lies; side null where the group is to be halved by order."""
    counts = clusters.groupBy("group").agg(F.count(F.lit(1)).alias("_k"))
    few = counts.where(F.col("_k") <= small).select("group")

    def cut(key, items: pd.DataFrame, sims: pd.DataFrame) -> pd.DataFrame:
        items = items.sort_values("c").reset_index(drop=True)
        n = items["n"].to_numpy()
        mean = _matrix(items, sims, "c") / np.outer(n, n)
        sides = average_linkage_halves(1 - np.clip(mean, 0, 1), n, float(items["high"].max()))
        out = items[["group", "c"]].copy()
        out["side"] = pd.array(sides if sides.any() else [None] * len(items), dtype="Int32")
        return out

    near = edges.join(few, "group", "left_semi").select(F.col("group").alias("of"), "a", "b", "s")
    done = clusters.join(few, "group", "left_semi").groupBy("group").cogroup(near.groupBy("of")).applyInPandas(cut, "group string, c long, side int")
    # Many clusters and nothing to merge: they all join at similarity 0, so no height separates two.
    rest = clusters.join(few, "group", "left_anti").select("group", "c", F.lit(None).cast("int").alias("side"))
    return done.unionByName(rest)


def buckets(units: DataFrame, pairs: DataFrame, limit: int = 100_000, small: int = 1000, alike: str | None = None, most: int = 100_000) -> DataFrame:
    """Units (sku_id, classification, ord, token_count) with bucket_id, from pair similarities (a, b, similarity); a class of one bucket is numbered 001, and so on in the order of the cuts.

    Buckets hold ``limit`` tokens at most, or one unit. Units of a class with equal values of the column ``alike`` are copies, similar by 1, and a pair of two of them holds for all copies of both. Groups of at most
    ``small`` kinds and ``most`` units end in one task.
    """
    rows = units.select("sku_id", F.col("classification").alias("class"), "ord", F.col("token_count").cast("long").alias("token_count"), *([F.col(alike).alias("_like")] if alike else []))
    items = numbered_globally(rows, ["class", "ord", "sku_id"], "item", 0).drop("ord")
    if alike:
        items = written(items, "numbers")
        first = items.where("_like IS NOT NULL").groupBy("class", "_like").agg(F.min("item").alias("_kind"))
        items = items.join(first, ["class", "_like"], "left").withColumn("kind", F.coalesce("_kind", "item")).drop("_like", "_kind")
    else:
        items = items.withColumn("kind", F.col("item"))
    items = written(items, "items")
    at = lambda s: items.select(F.col("sku_id").alias(s), F.col("class").alias(f"class_{s}"), F.col("kind").alias(f"kind_{s}"))
    links = pairs.where("a <> b AND similarity > 0").join(at("a"), "a").join(at("b"), "b").where("class_a = class_b AND kind_a <> kind_b")
    links = links.groupBy(F.col("class_a").alias("class"), F.least("kind_a", "kind_b").alias("a"), F.greatest("kind_a", "kind_b").alias("b")).agg(F.least(F.max("similarity"), F.lit(1.0)).alias("s"))
    links = written(links, "links")
    # A group is its class and the path of its cuts: 0 left, 1 right. Paths in order are buckets in order.
    state = items.select("class", F.lit("").alias("path"), "item", "kind", "token_count")
    ended = []
    while True:
        group = F.concat_ws("|", "path", "class")
        kinds = state.groupBy("class", "path", "kind").agg(F.sum("token_count").alias("_t"), F.count(F.lit(1)).alias("n"), F.min("item").alias("c"))
        kinds = written(kinds.withColumn("group", group), "kinds")
        sums = kinds.groupBy("class", "path").agg(F.sum("_t").alias("_t"), F.sum("n").alias("_n"), F.count(F.lit(1)).alias("_k"))
        state = written(state.join(sums, ["class", "path"]).withColumn("group", group), "groups")
        final = (F.col("_t") <= limit) | (F.col("_n") == 1)
        one_task = (F.col("_k") <= small) & (F.col("_n") <= most)
        fits, few, many = state.where(final), state.where(~final & one_task), state.where(~final & ~one_task)
        kinds = kinds.drop("_t").join(sums, ["class", "path"])

        def sub(where):
            """Links of the kinds in the groups of ``where``."""
            end = lambda s: kinds.where(where).select("class", "group", F.col("kind").alias(s), F.col("c").alias(f"c{s}"), F.col("n").alias(f"n{s}"))
            return links.join(end("a"), ["class", "a"]).join(end("b"), ["class", "group", "b"])

        def split(key, items: pd.DataFrame, sims: pd.DataFrame) -> pd.DataFrame:
            items = items.sort_values("item").reset_index(drop=True)
            m = _matrix(items[["kind"]].drop_duplicates(), sims, "kind")
            np.fill_diagonal(m, 1)
            bucket = np.empty(len(items), object)
            for path, where in _paths(items["token_count"].to_numpy(), m, limit, pd.factorize(items["kind"])[0]):
                bucket[where] = items["path"].iloc[0] + path
            return pd.DataFrame({"class": items["class"], "path": bucket, "item": items["item"]})

        near = sub(~final & one_task).select(F.col("group").alias("of"), "a", "b", "s")
        small_ones = few.groupBy("group").cogroup(near.groupBy("of")).applyInPandas(split, "class string, path string, item long")
        ended.append(written(fits.select("class", "path", "item").unionByName(small_ones), "buckets"))
        if many.isEmpty():
            break
        rest = ~final & ~one_task
        clusters = written(kinds.where(rest).select("group", "c", "n", F.when(F.col("n") > 1, 0.0).otherwise(float("-inf")).alias("high")), "clusters")
        edges = sub(rest).select("group", F.least("ca", "cb").alias("a"), F.greatest("ca", "cb").alias("b"), (F.col("s") * F.col("na") * F.col("nb")).alias("s"))
        edges, clusters, places = _linked(written(edges, "edges"), clusters, small)
        sides = written(_sides(edges, clusters, small), "sides")
        first = kinds.where(rest).select("group", "kind", F.col("c").alias("item"))
        parts = many.join(first.join(places.withColumnRenamed("c", "_c"), ["group", "item"]).drop("item"), ["group", "kind"]).join(sides.withColumnRenamed("c", "_c"), ["group", "_c"])
        parts = written(numbered_globally(parts.drop("_c"), ["group", "item"], "_no", 0), "parts")
        parts = parts.join(parts.groupBy("group").agg(F.min("_no").alias("_start")), "group")
        half = (F.col("_no") - F.col("_start") >= F.floor(F.col("_n") / 2)).cast("int")
        state = written(parts.withColumn("path", F.concat("path", F.coalesce("side", half).cast("string"))).select("class", "path", "item", "kind", "token_count"), "state")
    done = ended[0]
    for more in ended[1:]:
        done = done.unionByName(more)
    # Paths of different depth: a bucket's path is no prefix of another's, so their order is that of the cuts.
    names = done.select("class", "path").distinct()
    number = F.row_number().over(Window.partitionBy("class").orderBy("path"))
    names = names.select("class", "path", F.format_string("%s_bucket_%03d", "class", number).alias("bucket_id"))
    return items.join(done.join(names, ["class", "path"]), ["class", "item"]).select("sku_id", "token_count", "bucket_id")


def _paths(tokens: np.ndarray, similarity: np.ndarray, limit: int, kinds: np.ndarray) -> list[tuple[str, list[int]]]:
    """The buckets of :func:`bisect` with paths that order them."""
    found = bisect(tokens, similarity, limit, kinds)
    width = max(len(found) - 1, 1).bit_length()
    return [(f"{k:0{width}b}", at) for k, at in enumerate(found)]


def bucket_totals(members: DataFrame) -> DataFrame:
    return members.groupBy("bucket_id").agg(F.sum("token_count").alias("total_tokens"), F.count(F.lit(1)).alias("sku_count"))
