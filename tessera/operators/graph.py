"""Label forests, typed edges and glossaries as keyed upserts over rows with an explicit order (``ord``)."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.operators.components import connected

#: The predicates an edge may have.
PREDICATES = ("is-a", "has-a", "part-of", "causes", "caused-by", "requires", "enables", "contradicts", "related-to", "depends-on", "regulates", "implements", "example-of")


def first_seen(value: str, order: str = "ord") -> Column:
    """Distinct values in the order in which they were seen first (rows of (ord, array) of a group)."""
    rows = F.array_sort(F.collect_list(F.struct(order, value)))
    return F.array_distinct(F.flatten(F.transform(rows, lambda r: r[value])))


def label_nodes(paths: DataFrame) -> DataFrame:
    """The forest of label paths (ord, path): node_key, parent_key, name, depth, ord, path, is_leaf.

    A node is its lower-cased path; the first spelling and place win. The node keys are arrays, so a label may hold any
    character.
    """
    prefix = F.explode(F.transform(F.sequence(F.lit(1), F.size("path")), lambda n: F.slice(F.col("path"), 1, n)))
    rows = paths.where(F.size("path") > 0).select("ord", prefix.alias("path"))
    key = F.transform("path", lambda x: F.lower(x))
    rows = rows.withColumn("node_key", key)
    nodes = rows.groupBy("node_key").agg(F.min_by("path", "ord").alias("spelled"), F.min("ord").alias("ord"))
    nodes = nodes.select("node_key", F.when(F.size("node_key") > 1, F.slice("node_key", 1, F.size("node_key") - 1)).alias("parent_key"),
                         F.element_at("spelled", -1).alias("name"), F.size("node_key").alias("depth"), "ord")
    parents = nodes.where("parent_key IS NOT NULL").select(F.col("parent_key").alias("node_key")).distinct().withColumn("_inner", F.lit(True))
    return nodes.join(parents, "node_key", "left").withColumn("is_leaf", F.col("_inner").isNull()).drop("_inner")


def leaf_paths(nodes: DataFrame) -> DataFrame:
    """(path, ord): root-to-leaf paths in their first spellings, in depth-first order (place, from 0).

    A leaf collects the (ord, name) of its ancestors by an equi-join on the prefixes of its key; the array of these ords
    is the depth-first order, as siblings are ordered by first appearance.
    """
    leaves = nodes.where("is_leaf").select(F.col("node_key").alias("leaf"), F.posexplode(F.transform(F.sequence(F.lit(1), F.size("node_key")), lambda n: F.slice(F.col("node_key"), 1, n))).alias("level", "node_key"))
    rows = leaves.join(nodes.select("node_key", "name", "ord"), "node_key").groupBy("leaf").agg(F.array_sort(F.collect_list(F.struct("level", "ord", "name"))).alias("steps"))
    return rows.select(F.transform("steps", lambda s: s["name"]).alias("path"), F.transform("steps", lambda s: s["ord"]).alias("ord"))


def merge_forests(old: DataFrame, new: DataFrame) -> DataFrame:
    """Paths (ord, path) of two forests as one input: the old ones come first."""
    return old.select(F.col("ord").cast("long").alias("ord"), "path").unionByName(new.select((F.col("ord") + F.lit(1 << 40)).cast("long").alias("ord"), "path"))


def edge_upsert(edges: DataFrame) -> DataFrame:
    """Edges (ord, subject, predicate, object, source_chunks) merged without regard to case of subject and object: the first
    spelling stays, source chunks are appended."""
    # Equal rows are one first, where their place is all that is kept of them: that is merged in memory, before the shuffle.
    equal = edges.groupBy("subject", "predicate", "object", "source_chunks").agg(F.min("ord").alias("ord"))
    keyed = equal.withColumn("_s", F.lower("subject")).withColumn("_o", F.lower("object"))
    return (keyed.groupBy("_s", "predicate", "_o").agg(F.min_by("subject", "ord").alias("subject"), F.min_by("object", "ord").alias("object"), F.min("ord").alias("ord"), first_seen("source_chunks").alias("source_chunks"))
            .select("ord", "subject", "predicate", "object", "source_chunks"))


def valid_edges(edges: DataFrame) -> DataFrame:
    """Per chunk (chunk_id, ord, ...): unknown predicates become ``related-to``; the first edge without subject or object ends
    the chunk's list."""
    bad = F.col("subject").isNull() | F.col("object").isNull()
    stop = edges.where(bad).groupBy(F.col("chunk_id").alias("_c")).agg(F.min("ord").alias("_stop"))
    rows = edges.join(stop, edges["chunk_id"].eqNullSafe(stop["_c"]), "left").where(F.col("_stop").isNull() | (F.col("ord") < F.col("_stop"))).drop("_c", "_stop")
    return rows.withColumn("predicate", F.when(F.col("predicate").isin(*PREDICATES), F.col("predicate")).otherwise("related-to"))


def edges_by(edges: DataFrame, subject: str | None = None, object: str | None = None, predicate: str | None = None) -> DataFrame:
    if subject is not None:
        edges = edges.where(F.lower("subject") == subject.lower())
    if object is not None:
        edges = edges.where(F.lower("object") == object.lower())
    return edges if predicate is None else edges.where(F.col("predicate") == predicate)


def glossary_upsert(terms: DataFrame) -> DataFrame:
    """Glossary entries (ord, term, definition, labels, source_chunks, aliases, related_terms) merged by term, ignoring case.

    The fast path, for input in which no term is an alias of another entry: the longest definition (the first of
    equals) wins, lists keep first-seen order, aliases other than the term are kept once per spelling in lower case.
    Use :func:`glossary_fold` where aliases meet terms.
    """
    keyed = terms.withColumn("_k", F.lower("term"))
    best = F.max_by("definition", F.struct(F.length("definition"), -F.col("ord")))
    out = keyed.groupBy("_k").agg(F.min("ord").alias("ord"), F.min_by("term", "ord").alias("term"), best.alias("definition"), first_seen("labels").alias("labels"),
                                  first_seen("source_chunks").alias("source_chunks"), first_seen("aliases").alias("aliases"), first_seen("related_terms").alias("related_terms"))
    low = F.transform("aliases", lambda a: F.lower(a))
    kept = F.filter(F.col("aliases"), lambda a, i: (a != "") & (F.lower(a) != F.col("_k")) & (F.array_position(low, F.lower(a)) == i + 1))
    return out.withColumn("aliases", kept).drop("_k")


def alias_components(terms: DataFrame) -> DataFrame:
    """``terms`` with ``component``, equal for entries whose terms and aliases hang together, ignoring case.

    Names meet as 64-bit hashes. Two names of one hash would only put two components into one, and a fold compares the names themselves.
    """
    name = F.xxhash64(F.lower("term"))
    links = terms.select(name.alias("a"), F.explode("aliases").alias("alias")).select("a", F.xxhash64(F.lower("alias")).alias("b"))
    found = connected(links)
    return terms.withColumn("_name", name).join(found, F.col("_name") == F.col("node"), "left").withColumn("component", F.coalesce("component", "_name")).drop("_name", "node")


_ENTRY = "ord long, term string, definition string, labels array<string>, source_chunks array<string>, aliases array<string>, related_terms array<string>"
_LISTS = ("labels", "source_chunks", "aliases", "related_terms")


class _Fold:
    """The entries of one component so far, found by any of their names."""

    def __init__(self):
        self.kept: list[dict] = []
        self.names: dict[str, int] = {}  # the first entry that has a name

    def add(self, e: dict) -> None:
        name = e["term"].lower()
        lists = {k: list(e[k]) if e[k] is not None else [] for k in _LISTS}
        at = self.names.get(name)
        if at is None:
            at = len(self.kept)
            self.kept.append({"ord": e["ord"], "term": e["term"], "definition": e["definition"] or "", **lists, "_low": {a.lower() for a in lists["aliases"]}, "_seen": {k: set(lists[k]) for k in _LISTS}})
            for n in (name, *(a.lower() for a in lists["aliases"])):
                self.names.setdefault(n, at)
            return
        hit = self.kept[at]
        if len(e["definition"] or "") > len(hit["definition"]):
            hit["definition"] = e["definition"]
        for k in ("labels", "source_chunks", "related_terms"):
            new = [x for x in dict.fromkeys(lists[k]) if x not in hit["_seen"][k]]
            hit[k] += new
            hit["_seen"][k].update(new)
        for a in lists["aliases"]:
            if a and a.lower() != hit["term"].lower() and a.lower() not in hit["_low"]:
                hit["aliases"].append(a)
                hit["_low"].add(a.lower())
                self.names[a.lower()] = min(at, self.names.get(a.lower(), at))


def glossary_fold(terms: DataFrame) -> DataFrame:
    """Like :func:`glossary_upsert`, also when a term is an alias of an earlier entry: an order-dependent fold within each connected component of terms and aliases.

    A task folds many components one after another, from rows sorted by component and order; it holds the entries of one component at a time.
    """
    names = [c.split()[0] for c in _ENTRY.split(", ")]

    def fold(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, state, out = None, _Fold(), []
        frame_of = lambda rows: pd.DataFrame(rows, columns=names)
        for frame in frames:
            for e in frame.to_dict("records"):
                if e["component"] != now:
                    out += state.kept
                    now, state = e["component"], _Fold()
                state.add(e)
            if len(out) >= 1000:
                yield frame_of(out)
                out = []
        if out or state.kept:
            yield frame_of(out + state.kept)

    rows = alias_components(terms).select("component", *names)
    return rows.repartition("component").sortWithinPartitions("component", "ord").mapInPandas(fold, _ENTRY)


def glossary_lookup(glossary: DataFrame, name: str) -> DataFrame:
    """The first entry whose term or alias is the name, ignoring case."""
    low = name.lower()
    hit = glossary.where((F.lower("term") == low) | F.exists("aliases", lambda a: F.lower(a) == low))
    return hit.orderBy("ord").limit(1)


def terms_by_label(glossary: DataFrame, label: str) -> DataFrame:
    return glossary.where(F.exists("labels", lambda x: F.lower(x) == label.lower()))
