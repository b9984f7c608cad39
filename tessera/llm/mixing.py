"""Mixing sources to target weights by weighted fair queueing.

Within its source every document gets a place by a seeded hash of its id. Its virtual finish time is the source's
tokens up to and including it, divided by the source's weight; a source may run through its documents ``repeats``
times, the later runs going on from the source's size. All runs are sorted globally by finish time and the mix takes
them in this order until the token budget is reached. As in a fair queue, a source that is exhausted leaves its share
to the others in proportion to their weights, which is how the targets are defined too.

Source sums come from a range sort by (source, place) and running sums over blocks of rows, so a source with a third of
all rows is spread over many tasks.

Defined results: null or blank text has size 0 and is taken with 0 words; null is a source of its own and the last;
rows that repeat are queued one by one; an empty table gives an empty mix; reruns agree, as places depend on doc_id
and seed only. Other columns are carried along.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import discard, ordered, packed, running_sum, with_position, written


def word_count(text: Column) -> Column:
    """Runs of characters other than 0x20 and 0x09 to 0x0D; null: 0."""
    return F.coalesce(F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]+")), F.lit(0)).cast("long")


def source_targets(sources: DataFrame, budget: int, repeats: int) -> DataFrame:
    """``sources`` (source, source_size, weight, ...) with target: shares of the budget by weight, none above ``repeats`` times its
    size, the excess reshared until none is above.

    In closed form: targets are min(cap, level * weight) for the level at which they add up to the budget. With the sources sorted
    by cap / weight, those below the level are full, so running sums of caps and weights give the level.
    """
    cap = (F.col("source_size") * repeats).cast("double")
    srt = ordered(sources.select("source", cap.alias("cap"), F.col("weight").cast("double").alias("weight"), (cap / F.col("weight")).alias("ratio")), ["ratio", F.col("source").asc_nulls_last()])
    total = srt.agg(F.sum("weight")).first()[0] or 1.0
    run = running_sum(running_sum(srt, "cap", "caps"), "weight", "weights")
    filled = F.col("caps") + F.col("ratio") * (F.lit(total) - F.col("weights"))
    level = (F.lit(float(budget)) - (F.col("caps") - F.col("cap"))) / (F.lit(total) - (F.col("weights") - F.col("weight")))
    first = run.where(filled >= F.lit(float(budget))).agg(F.min(F.struct("ratio", "caps", level.alias("level")))).first()[0]  # one row
    discard(srt)
    target = F.least(cap, F.lit(first["level"]) * F.col("weight")) if first else cap
    return sources.withColumn("target", target)


def fair_mix(docs: DataFrame, weights: tuple[float, ...] = (5, 2, 1), repeats: int = 3, share: float = 1.0, seed: int = 17) -> DataFrame:
    """``docs`` must have doc_id, source, size. Adds source_size, target, runs (times taken) and taken (words), in place of columns
    of these names.

    ``weights`` repeat over the sources in code point order, null last; ``share`` of all tokens is the budget.
    """
    docs, opened = packed(docs, ["doc_id", "source", "size"])
    place = F.xxhash64(F.coalesce(F.col("doc_id"), F.lit(-1)), F.lit(seed))
    sized = written(docs.withColumn("_place", place), "sizes")  # else the range sort's sampling counts the words a second time
    srt = ordered(sized, [F.col("source").asc_nulls_last(), "_place", "doc_id", "size"])
    discard(sized)
    by = srt.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = with_position(ordered(by, [F.col("source").asc_nulls_last()]), "rank")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    ranked = written(ranked.select("source", "source_size", "rank", weight.alias("weight")), "sources")
    budget = int((ranked.agg(F.sum("source_size")).first()[0] or 0) * share)
    ranked = source_targets(ranked, budget, repeats).select(F.col("source").alias("_src"), "source_size", "rank", "weight", "target")
    run = running_sum(srt.select("source", "_mid", "_place", "doc_id", "size"), "size", "upto", ["source"])
    run = run.join(ranked, run["source"].eqNullSafe(ranked["_src"]))
    queue = run.where("size > 0").withColumn("run", F.explode(F.sequence(F.lit(0), F.lit(repeats - 1))))
    finish = (F.col("upto") + F.col("run") * F.col("source_size")).cast("double") / F.col("weight")
    queue = queue.select("_mid", "size", "rank", "run", "_place", "doc_id", finish.alias("finish"))
    queue = ordered(queue.withColumnRenamed("_mid", "_row"), ["finish", "rank", "run", "_place", "doc_id"], "_mid")
    taken = running_sum(queue, "size", "served").where(F.col("served") <= F.lit(budget)).groupBy("_row").agg(F.count(F.lit(1)).cast("int").alias("runs"))
    taken = written(taken, "taken")
    discard(queue)
    out = srt.join(taken, srt["_mid"] == taken["_row"], "left")
    out = out.join(ranked, out["source"].eqNullSafe(ranked["_src"]))
    runs = F.coalesce(F.col("runs"), F.lit(0))
    keep = [out[c] for c in docs.columns]
    out = out.select(*keep, "source_size", "target", runs.alias("runs"), (runs * out["size"]).cast("long").alias("taken"))
    return opened(out, ["source_size", "target", "runs", "taken"])
