"""Resolution of flagged duplicates, scoring and the knowledge-unit index."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.operators.numbering import numbered_globally

ACTIONS = ("delete", "rewrite", "merge", "keep", "contradiction")


def scan_batches(members: DataFrame, size: int = 80) -> DataFrame:
    """Members (bucket_id, sku_id, ord) of buckets with more than one, with batch (from 0) in entry order."""
    w = Window.partitionBy("bucket_id")
    rows = members.withColumn("_n", F.count("*").over(w)).where("_n > 1").drop("_n")
    return rows.withColumn("batch", F.floor((F.row_number().over(w.orderBy("ord")) - 1) / size).cast("int"))


def valid_pairs(flagged: DataFrame, members: DataFrame) -> DataFrame:
    """Flagged pairs (bucket_id, sku_a, sku_b, ...) whose ids are both in their bucket."""
    ids = members.select("bucket_id", "sku_id").distinct()
    out = flagged.join(ids.withColumnRenamed("sku_id", "sku_a"), ["bucket_id", "sku_a"], "left_semi")
    return out.join(ids.withColumnRenamed("sku_id", "sku_b"), ["bucket_id", "sku_b"], "left_semi")


def pair_contents(pairs: DataFrame, contents: DataFrame) -> DataFrame:
    """Pairs with both contents; pairs of which one is missing go."""
    left = contents.select(F.col("sku_id").alias("sku_a"), F.col("content").alias("content_a"))
    right = contents.select(F.col("sku_id").alias("sku_b"), F.col("content").alias("content_b"))
    return pairs.join(left, "sku_a").join(right, "sku_b")


def known_action(action: Column) -> Column:
    return F.when(action.isin(*ACTIONS), action).otherwise("keep")


def effects(actions: DataFrame) -> DataFrame:
    """(sku_id, op, content, ord) of actions (ord, sku_a, sku_b, action, deleted_skus, rewritten_skus, new_content, merged_content).

    Ids that are not of the pair are passed over; a merge writes to sku_b where sku_a is deleted, else to sku_a.
    """
    none = F.expr("cast(array() as array<struct<sku_id:string,op:string,content:string>>)")
    of_pair = lambda x: (x == F.col("sku_a")) | (x == F.col("sku_b"))
    void = F.lit(None).cast("string")
    made = lambda ids, op, content: F.transform(F.filter(F.coalesce(ids, F.expr("cast(array() as array<string>)")), of_pair), lambda x: F.struct(x.alias("sku_id"), F.lit(op).alias("op"), content.alias("content")))
    has = lambda c: F.col(c).isNotNull() & (F.col(c) != "")
    drops = made(F.col("deleted_skus"), "delete", void)
    survivor = F.when(F.array_contains("deleted_skus", F.col("sku_a")), F.col("sku_b")).otherwise(F.col("sku_a"))
    write = F.when(has("merged_content"), F.array(F.struct(survivor.alias("sku_id"), F.lit("write").alias("op"), F.col("merged_content").alias("content")))).otherwise(none)
    rewrite = F.when(has("new_content"), made(F.col("rewritten_skus"), "write", F.col("new_content"))).otherwise(none)
    each = F.when(F.col("action") == "delete", drops).when(F.col("action") == "rewrite", rewrite).when(F.col("action") == "merge", F.concat(write, drops)).otherwise(none)
    return actions.select("ord", F.explode(each).alias("e")).select("e.sku_id", "e.op", "e.content", "ord")


def applied(units: DataFrame, actions: DataFrame) -> DataFrame:
    """``units`` (sku_id, content, ...) after all actions: deleted ones go, the last write of each id stays."""
    e = effects(actions)
    gone = e.where("op = 'delete'").select("sku_id").distinct()
    writes = e.where("op = 'write'").groupBy("sku_id").agg(F.max_by("content", "ord").alias("_new"))
    out = units.join(gone, "sku_id", "left_anti").join(writes, "sku_id", "left")
    return out.withColumn("content", F.coalesce("_new", "content")).drop("_new")


def live_actions(actions: DataFrame, bucket: str = "bucket_id") -> DataFrame:
    """Actions which are reached when they are applied in order: a pair of which a unit was deleted before is skipped.

    The order matters inside a bucket only, as ids are compared within their bucket; each bucket is folded by itself.
    """
    schema = actions.schema

    def fold(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("ord")
        gone: set[str] = set()
        keep = []
        for a, b, action, deleted in zip(frame["sku_a"], frame["sku_b"], frame["action"], frame["deleted_skus"], strict=True):
            live = a not in gone and b not in gone
            keep.append(live)
            if live and action in ("delete", "merge") and deleted is not None:
                gone |= {x for x in deleted if x in (a, b)}
        return frame[keep]

    return actions.groupBy(bucket).applyInPandas(fold, schema)


def dedup_report(actions: DataFrame) -> DataFrame:
    """Counters of resolved pairs. Deleted and rewritten count the ids listed; effective_* count those of the pair."""
    is_ = lambda *x: F.col("action").isin(*x)
    listed = lambda c: F.coalesce(F.size(F.coalesce(F.col(c), F.expr("cast(array() as array<string>)"))), F.lit(0))
    valid = lambda c: F.size(F.filter(F.coalesce(F.col(c), F.expr("cast(array() as array<string>)")), lambda x: (x == F.col("sku_a")) | (x == F.col("sku_b"))))
    total = lambda cond, n: F.coalesce(F.sum(F.when(cond, n).otherwise(0)), F.lit(0)).cast("long")
    return actions.agg(F.count(F.lit(1)).alias("pairs_resolved"), total(is_("keep"), F.lit(1)).alias("total_kept"), total(is_("delete", "merge"), listed("deleted_skus")).alias("total_deleted"),
                       total(is_("rewrite"), listed("rewritten_skus")).alias("total_rewritten"), total(is_("merge"), F.lit(1)).alias("total_merged"), total(is_("contradiction"), F.lit(1)).alias("total_contradictions"),
                       total(is_("delete", "merge"), valid("deleted_skus")).alias("effective_deleted"), total(is_("rewrite"), valid("rewritten_skus")).alias("effective_rewritten"))


def confidence(web: Column, fallback: Column, penalty: Column) -> tuple[Column, Column]:
    """(confidence, penalty): web confidence (else the plain one, else a half) in 0..1 less a penalty in 0..0.5."""
    clamp = lambda c, lo, hi: F.greatest(F.lit(lo), F.least(F.lit(hi), c))
    w = clamp(F.coalesce(F.coalesce(web, fallback).try_cast("double"), F.lit(0.5)), 0.0, 1.0)
    p = clamp(F.coalesce(penalty.try_cast("double"), F.lit(0.0)), 0.0, 0.5)
    return clamp(w - p, 0.0, 1.0), p


def reasoning(text: Column, penalty: Column, source_available: Column, web_available: Column) -> Column:
    return F.concat(F.coalesce(text, F.lit("")), F.when(penalty > 0, F.format_string(" [Source penalty: -%.2f]", penalty)).otherwise(""),
                    F.when(source_available, "").otherwise(" [Source chunk unavailable]"), F.when(web_available, "").otherwise(" [Web search unavailable]"))


def confidence_report(scores: DataFrame) -> DataFrame:
    return scores.agg(F.count("confidence").alias("total_scored"), F.coalesce(F.avg("confidence"), F.lit(0.0)).alias("average_confidence"))


def source_lookup(wanted: DataFrame, chunks: DataFrame, longest: int = 8000) -> DataFrame:
    """Source chunk of each unit (sku_id, source_chunk): the chunk of this id, else the first (by id) whose id contains it.

    Exact ids are an equi-join. Only for distinct misses, a containing id is looked for: every suffix of an id starts with
    the text iff the id contains it, so misses meet suffixes cut to their own length by an equi-join on (length, text).
    """
    exact = wanted.join(chunks.select(F.col("chunk_id").alias("source_chunk"), F.lit(True).alias("_e")).distinct(), "source_chunk", "left")
    misses = exact.where("_e IS NULL").select("source_chunk").where("source_chunk IS NOT NULL").distinct()
    lengths = misses.select(F.length("source_chunk").alias("n")).distinct()
    ids = chunks.select("chunk_id").distinct().select("chunk_id", F.explode(F.sequence(F.lit(1), F.length("chunk_id") + 1)).alias("p"))
    grams = ids.join(lengths, F.col("p") + F.col("n") - 1 <= F.length("chunk_id")).select(F.substr("chunk_id", "p", "n").alias("source_chunk"), "chunk_id")
    near = misses.join(grams, "source_chunk").groupBy("source_chunk").agg(F.min("chunk_id").alias("_near"))
    found = exact.join(near, "source_chunk", "left").withColumn("chunk_id", F.when(F.col("_e"), F.col("source_chunk")).otherwise(F.col("_near"))).drop("_e", "_near")
    texts = chunks.groupBy("chunk_id").agg(F.min(F.left("content", F.lit(longest))).alias("source_text"))
    return found.join(texts, "chunk_id", "left")


# The index of knowledge units.

def index_totals(units: DataFrame) -> DataFrame:
    each = lambda c: F.count_if(F.col("classification") == c).alias(f"{c}_count")
    return units.agg(F.count(F.lit(1)).alias("total_skus"), F.coalesce(F.sum("character_count"), F.lit(0)).cast("long").alias("total_characters"),
                     each("factual"), each("relational"), each("procedural"), each("meta"), F.countDistinct("sku_id").alias("distinct_skus"))


def index_summary() -> Column:
    kinds = [F.concat(F.lit(f"  - {c.capitalize()}: "), F.col(f"{c}_count")) for c in ("factual", "relational", "procedural", "meta")]
    return F.concat_ws("\n", F.lit("SKUs Index Summary"), F.lit("=================="), F.concat(F.lit("Total SKUs: "), F.col("total_skus")), F.concat(F.lit("Total Characters: "), F.format_number("total_characters", 0)),
                       F.lit(""), F.lit("By Type:"), *kinds)


def relational_lines(labels: DataFrame, edges: DataFrame, glossary: DataFrame) -> DataFrame:
    """The relational knowledge as JSON lines: (file, ord, line), a line for each label path, edge and entry. Lines, not one document a file, so that no task holds a whole file."""
    paths = labels.select(F.lit("label_tree").alias("file"), F.col("ord").cast("string").alias("ord"), F.to_json(F.struct("path")).alias("line"))
    rows = edges.select(F.lit("relationships").alias("file"), F.col("ord").cast("string").alias("ord"), F.to_json(F.struct("subject", "predicate", "object", "source_chunks")).alias("line"))
    entries = glossary.select(F.lit("glossary").alias("file"), F.col("ord").cast("string").alias("ord"), F.to_json(F.struct("term", "definition", "labels", "source_chunks", "aliases", "related_terms")).alias("line"))
    return paths.unionByName(rows).unionByName(entries)


def relational_header(lines: DataFrame, language: str = "en") -> DataFrame:
    """(character_count, header) of the relational knowledge: all characters of the three files, line ends included; without lines the header as it is written first."""
    total = lines.agg(F.coalesce(F.sum(F.length("line") + 1), F.lit(0)).cast("long").alias("character_count"))
    row = total.select("character_count", F.lit("relational-knowledge").alias("name"), F.lit("relational").alias("classification"), F.lit("aggregated").alias("source_chunk"), F.lit(None).cast("double").alias("confidence"),
                       F.expr("cast(array() as array<string>)").alias("related_skus"), F.lit("Label tree, glossary and relationships").alias("description"))
    return row.select("character_count", header_markdown(language).alias("header"))


def unprocessed(chunks: DataFrame, processed: DataFrame) -> DataFrame:
    return chunks.join(processed.select("chunk_id").distinct(), "chunk_id", "left_anti")


def next_number(ids: DataFrame, id_col: str = "sku_id") -> DataFrame:
    from tessera.functions.text import number_suffix

    return ids.agg((F.coalesce(F.max(number_suffix(F.col(id_col))), F.lit(0)) + 1).alias("next_number"))


def content_of(units: DataFrame, files: DataFrame) -> DataFrame:
    """Content of each unit from its files (sku_id, name, content): content.md before content.json before SKILL.md."""
    rank = F.array_position(F.array(F.lit("content.md"), F.lit("content.json"), F.lit("SKILL.md")), F.col("name"))
    best = files.withColumn("_r", rank).where("_r > 0").groupBy("sku_id").agg(F.min_by("content", "_r").alias("content"))
    return units.drop("content").join(best, "sku_id", "left")


def snippet(content: Column, name: Column, n: int = 500) -> Column:
    return F.coalesce(F.left(content, F.lit(n)), name)


_LABELS = {"en": ("Classification", "Source", "Characters", "Confidence", "Related SKUs"), "zh": ("分类", "来源", "字符数", "置信度", "相关SKU")}


def header_markdown(language: str = "en") -> Column:
    """Header of a unit (name, classification, source_chunk, character_count, confidence, related_skus, description)."""
    kind, source, chars, conf, related = (F.lit(f"- **{x}**: ") for x in _LABELS[language])
    return F.concat_ws("\n", F.concat(F.lit("# "), F.col("name")), F.lit(""), F.concat(kind, F.col("classification")), F.concat(source, F.col("source_chunk")), F.concat(chars, F.format_number("character_count", 0)),
                       F.when(F.col("confidence").isNotNull(), F.concat(conf, F.format_string("%.2f", "confidence"))),
                       F.when(F.size("related_skus") > 0, F.concat(related, F.array_join("related_skus", ", "))), F.lit(""), F.col("description"), F.lit(""))


def with_confidence(header: Column, value: Column, language: str = "en") -> Column:
    """A header text with its confidence line replaced, put after the characters line or, without one, at the end, where trailing white space goes; a heading
    without a name keeps its blank."""
    line = F.concat(F.lit(f"- **{_LABELS[language][3]}**: "), F.format_string("%.2f", value))
    plain = F.regexp_replace(header, "- \\*\\*(Confidence|置信度)\\*\\*:.*\\n?", "")
    chars = "(?d)(- \\*\\*(?:Characters|字符数)\\*\\*:.*)"
    placed = F.regexp_replace(plain, F.lit(chars), F.concat(F.lit("$1\n"), line))
    return F.when(F.regexp_like(plain, F.lit(chars)), placed).otherwise(F.concat(F.regexp_replace(plain, "((?:^|\\n)#+ )?\\s*$", "$1"), F.lit("\n"), line, F.lit("\n")))


def list_line() -> Column:
    return F.concat(F.lit("- ["), F.col("classification"), F.lit("] "), F.col("path"), F.lit(": "), F.col("description"))


def unit_list(units: DataFrame, order: str = "ord") -> DataFrame:
    """All units as one text of lines in order, a fixed message when there is none. The result is one value by nature."""
    rows = units.agg(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), list_line().alias("l")))).alias("r"))
    return rows.select(F.when(F.size("r") == 0, F.lit("*No SKUs extracted yet.*")).otherwise(F.array_join(F.transform("r", lambda x: x["l"]), "\n")).alias("listing"))


def factual_units(facts: DataFrame, start: int = 1) -> DataFrame:
    """Facts (ord, chunk_id, name, description, content) as units with running ids."""
    rows = numbered_globally(facts, ["ord"], "_no", start)
    return rows.select(F.format_string("sku_%03d", "_no").alias("sku_id"), F.coalesce("name", F.format_string("fact_%d", "_no")).alias("name"), F.lit("factual").alias("classification"),
                       F.col("chunk_id").alias("source_chunk"), F.length("content").alias("character_count"), "description", "content")


def skill_markdown(name: Column, description: Column, body: Column) -> Column:
    return F.concat(F.lit("---\nname: "), name, F.lit("\ndescription: "), description, F.lit("\n---\n\n"), body, F.lit("\n"))


def skill_description(text: Column) -> Column:
    return F.left(F.translate(text, "<>", ""), F.lit(200))


def accepts_notes(old: Column, new: Column, updated: Column) -> Column:
    """New notes replace old ones unless they shrink them to less than half (old notes under 100 characters may shrink)."""
    return updated & ((F.length(new) >= 0.5 * F.length(old)) | (F.length(old) < 100))
