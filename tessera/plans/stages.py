"""The four stages end to end: files to texts, texts to chunks, chunks to knowledge units, units to a workspace.

Each stage is a function from frames to frames; storage is left to the caller (or to the command line).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.config import DEFAULTS, Settings
from tessera.durable import complete, new_folder, table_at
from tessera.functions.text import flatten_path, hyphen_case, needs_ocr, rough_tokens, suffix, url_to_name
from tessera.operators import clustering, graph, resolution, routing, segmentation, similarity, workspace
from tessera.operators.numbering import numbered_globally
from tessera.sources import providers, readers


def parse(spark: SparkSession, root: str, converters: dict[str, Callable[[bytes], str]] | None = None, done: DataFrame | None = None, settings: Settings = DEFAULTS) -> DataFrame:
    """Parse results of all files below ``root``: source_path, output_name, status, text, ... ``done`` (path, length): finished
    outputs, whose inputs are skipped. PDF texts with too few valid characters are marked for OCR."""
    files = readers.list_files(spark, root, content=True)
    if done is not None:
        files = files.join(done.where("length > 0").select("path").distinct(), "path", "left_anti")
    rows = providers.parsed_files(routing.routed_files(files), converters or providers.text_converters(), settings.retry_count)
    low = (suffix(F.col("source_path")) == ".pdf") & (F.col("status") == "success") & needs_ocr(F.coalesce("text", F.lit("")), settings.min_valid_chars)
    return rows.withColumn("output_name", flatten_path(F.col("source_path"), root)).withColumn("needs_ocr", low)


def parse_urls(urls: DataFrame, parsers: dict[str, Callable[[str], str | None]], settings: Settings = DEFAULTS, pause: float = 0.6, tasks: int = 8) -> DataFrame:
    """Parse results of an address list (url), with the columns of :func:`parse`: routed by address, read by the plug-in of the parser's name, paced over all tasks, tried again as files are."""
    routed = urls.select("url", routing.url_parser(F.col("url")).alias("parser"))
    rows = providers.parsed_urls(routed, parsers, settings.retry_count, pause, tasks).drop("asked_at")
    return rows.withColumn("output_name", url_to_name(F.col("source_path"))).withColumn("needs_ocr", F.lit(False))


def parse_all(spark: SparkSession, root: str, converters: dict[str, Callable[[bytes], str]] | None = None, parsers: dict[str, Callable[[str], str | None]] | None = None, settings: Settings = DEFAULTS, pause: float = 0.6) -> DataFrame:
    """Files below ``root``, then the addresses of its ``urls.txt``, as one table of results. Every result counts, failed ones too."""
    lines = readers.read_url_list(spark, f"{root.rstrip('/')}/urls.txt")
    return parse(spark, root, converters, settings=settings).unionByName(parse_urls(lines, parsers or {}, settings, pause))


#: A post-processing step: units in, units out.
Step = Callable[[DataFrame], DataFrame]


def postprocess(units: DataFrame, steps: list[tuple[str, Step]], folder: str | None = None) -> DataFrame:
    """``units`` after all plug-in steps in turn. Each step's result is a table of the run's folder, so a run started again goes on behind the last one that is whole."""
    folder = folder or new_folder(units.sparkSession, "post")
    for n, (name, step) in enumerate(steps):
        path = f"{folder}/{n:03d}-{name}"
        units = units.sparkSession.read.parquet(path) if complete(units.sparkSession, path) else table_at(step(units), path)
    return units


def chunk(results: DataFrame, settings: Settings = DEFAULTS, finder: segmentation.CutFinder | None = None) -> DataFrame:
    """Chunks of parsed texts with ids; ids that would collide get a suffix from their full path."""
    docs = results.where("status = 'success' AND text IS NOT NULL").select(F.col("source_path").alias("doc_id"), "text", F.element_at(F.split("output_name", "/"), -1).alias("name"), "output_name")
    rows = segmentation.chunks(docs, settings.max_token_length, finder, name_col="name")
    flat = docs.select("doc_id", F.regexp_replace("output_name", "/", "_").alias("flat"))
    twins = flat.groupBy("flat").agg(F.count(F.lit(1)).alias("n"))
    flat = flat.join(twins, "flat").withColumn("flat", F.when(F.col("n") > 1, F.concat("flat", F.lit("_"), F.left(F.sha2("doc_id", 256), F.lit(8)))).otherwise(F.col("flat"))).drop("n")
    rows = rows.join(flat, "doc_id").withColumn("source_file", F.element_at(F.split("doc_id", "/"), -1))
    return rows.withColumn("chunk_id", F.concat("flat", F.format_string("_chunk_%03d", F.col("chunk_index") + 1))).drop("flat")


_FACTS = "facts array<struct<name:string,description:string,content_type:string,content:string>>"
_SKILLS = "procedures array<struct<name:string,description:string,body:string>>"
_RELATIONS = ("label_paths array<array<string>>, relationships array<struct<subject:string,predicate:string,object:string>>, "
              "glossary array<struct<term:string,definition:string,labels:array<string>,aliases:array<string>,related_terms:array<string>>>")

#: Prompts of our own; callers may give others with the same placeholder.
PROMPTS = {
    "factual": "List the facts of this text as JSON with a key facts (name, description, content_type, content).\n\n{content}",
    "procedural": "List the procedures of this text as JSON with a key procedures (name, description, body).\n\n{content}",
    "relational": "List label_paths, relationships (subject, predicate, object) and glossary entries (term, definition, labels, aliases, related_terms) of this text as JSON.\n\n{content}",
}


@dataclass
class Knowledge:
    units: DataFrame
    labels: DataFrame
    edges: DataFrame
    glossary: DataFrame


def extract(chunks: DataFrame, provider: providers.Provider, processed: DataFrame | None = None, first_sku: int = 1, first_skill: int = 1) -> Knowledge:
    """Knowledge units of chunks (chunk_id, content) which are not processed yet. Answers that fail give nothing."""
    todo = chunks if processed is None else resolution.unprocessed(chunks, processed)

    def ask(kind: str, schema: str) -> DataFrame:
        prompt = F.replace(F.lit(PROMPTS[kind]), F.lit("{content}"), F.col("content"))
        got = providers.answers(todo.select("chunk_id", prompt.alias("prompt")), provider, "chunk_id", "prompt")
        return got.where("answer IS NOT NULL").select("chunk_id", F.from_json("answer", T._parse_datatype_string(schema)).alias("a"))

    order = lambda *c: F.struct(*c)
    facts = ask("factual", _FACTS).select("chunk_id", F.posexplode("a.facts").alias("pos", "f")).select(order("chunk_id", "pos").alias("ord"), "chunk_id", "f.*")
    skills = ask("procedural", _SKILLS).select("chunk_id", F.posexplode("a.procedures").alias("pos", "p")).select(order("chunk_id", "pos").alias("ord"), "chunk_id", "p.*")
    units = resolution.factual_units(facts, first_sku)
    skills = numbered_globally(skills, ["ord"], "_no", first_skill).withColumn("name", hyphen_case(F.coalesce("name", F.format_string("skill-%d", "_no"))))
    skills = skills.withColumn("description", resolution.skill_description(F.coalesce("description", F.lit(""))))
    skills = skills.withColumn("content", resolution.skill_markdown(F.col("name"), F.col("description"), F.coalesce("body", F.lit(""))))
    skills = skills.select(F.format_string("skill_%03d", "_no").alias("sku_id"), "name", F.lit("procedural").alias("classification"), F.col("chunk_id").alias("source_chunk"),
                           F.length("content").alias("character_count"), "description", "content")
    rel = ask("relational", _RELATIONS)
    place = lambda c: F.concat_ws("|", "chunk_id", F.format_string("%06d", c))
    labels = graph.label_nodes(rel.select("chunk_id", F.posexplode("a.label_paths").alias("pos", "path")).select(place("pos").alias("ord"), "path"))
    edges = rel.select("chunk_id", F.posexplode("a.relationships").alias("pos", "e")).select(place("pos").alias("ord"), "chunk_id", "e.*", F.array("chunk_id").alias("source_chunks"))
    terms = rel.select("chunk_id", F.posexplode("a.glossary").alias("pos", "g")).select(place("pos").alias("o"), "chunk_id", "g.*").where("term IS NOT NULL")
    none = F.expr("cast(array() as array<string>)")
    terms = numbered_globally(terms, ["o"], "ord").select(F.col("ord").cast("long").alias("ord"), "term", F.coalesce("definition", F.lit("")).alias("definition"), F.coalesce("labels", none).alias("labels"),
                         F.array("chunk_id").alias("source_chunks"), F.coalesce("aliases", none).alias("aliases"), F.coalesce("related_terms", none).alias("related_terms"))
    return Knowledge(units.select(*skills.columns).unionByName(skills), labels, graph.edge_upsert(graph.valid_edges(edges)), graph.glossary_fold(terms))


def save_relational(knowledge: Knowledge, folder: str, settings: Settings = DEFAULTS) -> int:
    """Write label paths, edges and glossary as JSON lines in folders of ``folder`` and their header; returns the characters."""
    paths = graph.leaf_paths(knowledge.labels).select(F.array_join(F.transform("ord", lambda o: o.cast("string")), "/").alias("ord"), "path")
    lines = resolution.relational_lines(paths, knowledge.edges, knowledge.glossary)
    lines.repartitionByRange("file", "ord").sortWithinPartitions("file", "ord").select("file", F.col("line").alias("value")).write.mode("overwrite").partitionBy("file").text(f"{folder}/relational")
    header = resolution.relational_header(lines, settings.language).first()
    readers.write_texts(knowledge.edges.sparkSession.createDataFrame([("relational/header.md", header.header)], "target string, content string"), folder)
    return header.character_count


def bucket(units: DataFrame, leaf_paths: DataFrame | None = None, settings: Settings = DEFAULTS) -> DataFrame:
    """Units with bucket_id by literal and (where leaf paths are given) label similarity, per class."""
    rows = units.withColumn("text", similarity.compared_text(F.col("name"), F.coalesce("description", F.lit(""))))
    block = rows.select(F.col("sku_id").alias("id"), F.col("classification").alias("block"))
    weights = similarity.effective_weights(settings.similarity_weight_literal, settings.similarity_weight_label, settings.similarity_weight_vector, leaf_paths is not None, False)
    literal = similarity.tfidf_pairs(similarity.tfidf(rows), block)
    label = similarity.label_pairs(similarity.label_scores(rows, leaf_paths)) if leaf_paths is not None else None
    pairs = similarity.weighted_pairs(literal, label, None, weights)
    items = rows.select("sku_id", "classification", F.col("sku_id").alias("ord"), rough_tokens(F.col("character_count")).cast("long").alias("token_count"))
    return clustering.buckets(items, pairs, settings.max_bucket_tokens)


def resolve(units: DataFrame, actions: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(units after all live actions, report)."""
    live = resolution.live_actions(actions)
    return resolution.applied(units, live), resolution.dedup_report(live)


def assemble(files: DataFrame, language: str = "en") -> tuple[DataFrame, DataFrame, DataFrame]:
    """(files with their workspace paths, manifest, readme)."""
    out = workspace.assembled(files)
    counts = workspace.manifest(out)
    return out, counts, workspace.readme(counts, language=language)
