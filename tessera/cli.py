"""Command line: init, parse, parse-file, parse-url, chunk, chunk-file, estimate-tokens, show-index, bucket, assemble."""

from __future__ import annotations

import argparse
import sys
from dataclasses import replace

from pyspark.sql import functions as F

from tessera.config import DEFAULTS
from tessera.functions import bpe
from tessera.functions.text import Estimate
from tessera.operators import resolution, routing, segmentation
from tessera.plans import stages
from tessera.session import session
from tessera.sources import providers, readers
from tessera.sources.markup import markdown_of

#: Folders of a new project.
FOLDERS = ("input", "output", "output/chunks", "output/skus", "workspace")


def main(args: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="tessera", description=__doc__)
    sub = parser.add_subparsers(dest="command", required=True)
    for name, needs in (("parse", ("input", "output")), ("chunk", ("input", "output")), ("estimate-tokens", ("input",)), ("show-index", ("input",)), ("bucket", ("input", "output")), ("assemble", ("input", "output")),
                        ("init", ("output",)), ("parse-file", ("input", "output")), ("parse-url", ("input", "output")), ("chunk-file", ("input", "output"))):
        p = sub.add_parser(name)
        for n in needs:
            p.add_argument(n)
        p.add_argument("--master")
        p.add_argument("--max-tokens", type=int)
        p.add_argument("--ranks", help="rank table of a tokenizer, for exact token counts")
    a = parser.parse_args(args)
    spark = session(master=a.master)
    s = DEFAULTS if a.max_tokens is None else replace(DEFAULTS, max_token_length=a.max_tokens, max_bucket_tokens=a.max_tokens)
    measure = bpe.Tokens(spark, bpe.ranks_at(spark, a.ranks)) if a.ranks else Estimate
    if a.command == "init":
        readers.write_texts(spark.createDataFrame([(f"{f}/.gitkeep", "") for f in FOLDERS] + [("input/urls.txt", "# one address a line\n")], "target string, content string"), a.output)
        return 0
    if a.command in ("parse-file", "parse-url"):
        if a.command == "parse-file":
            one = spark.read.format("binaryFile").load(a.input).select(F.regexp_replace("path", "^file:/+", "/").alias("path"), "length", "content")
            rows = providers.parsed_files(routing.routed_files(one), providers.text_converters(), s.retry_count)
        else:
            page = lambda url: None if (text := providers.HttpProvider().fetch(url)) is None else markdown_of(text)
            rows = stages.parse_urls(spark.createDataFrame([(a.input,)], "url string"), {"firecrawl": page}, s, pause=0.0001, tasks=1)
        got = rows.select("source_path", "status", "text", "error_message").first()
        print({"status": got.status, "characters": len(got.text or ""), "error": got.error_message})
        if got.status != "success":
            return 1
        readers.write_texts(spark.createDataFrame([(a.output.rsplit("/", 1)[-1], got.text)], "target string, content string"), a.output.rsplit("/", 1)[0] if "/" in a.output else ".")
        return 0
    if a.command == "chunk-file":
        name = F.regexp_replace(F.element_at(F.split("path", "/"), -1), "[.][^.]+$", "")
        docs = readers.read_texts(spark, a.input).select(F.col("path").alias("doc_id"), "text", name.alias("name"))
        rows = segmentation.chunks(docs, s.max_token_length, name_col="name", measure=measure).withColumn("source_file", F.element_at(F.split("doc_id", "/"), -1))
        files = rows.select(F.concat(segmentation.chunk_id(F.col("source_file")), F.lit(".md")).alias("target"), segmentation.front_matter(rows).alias("content"))
        readers.write_texts(files, a.output)
        print(rows.agg(F.count(F.lit(1)).alias("chunks"), F.sum("estimated_tokens").alias("tokens")).first().asDict())
        return 0
    if a.command == "parse":
        stages.parse(spark, a.input, settings=s).write.mode("overwrite").parquet(a.output)
        counts = {r.status: r["count"] for r in spark.read.parquet(a.output).groupBy("status").count().collect()}
        print(counts)
        return 1 if counts.get("failed") else 0
    if a.command == "chunk":
        stages.chunk(spark.read.parquet(a.input), s).write.mode("overwrite").parquet(a.output)
        print(spark.read.parquet(a.output).agg(F.count(F.lit(1)).alias("chunks"), F.sum("estimated_tokens").alias("tokens")).first().asDict())
    elif a.command == "estimate-tokens":
        r = readers.read_texts(spark, a.input).agg(F.sum(F.length("text")).alias("chars"), F.sum(measure.count(F.col("text"))).alias("tokens")).first()
        print({"characters": r.chars, "tokens": r.tokens, "characters_per_token": round(r.chars / r.tokens, 2) if r.tokens else None, "within_limit": (r.tokens or 0) <= s.max_token_length})
    elif a.command == "show-index":
        print(resolution.index_totals(spark.read.parquet(a.input)).select(resolution.index_summary()).first()[0])
    elif a.command == "bucket":
        stages.bucket(spark.read.parquet(a.input), settings=s).write.mode("overwrite").parquet(a.output)
    else:
        root = a.input.rstrip("/")
        files = readers.read_texts(spark, [r.path for r in readers.list_files(spark, root).select("path").toLocalIterator()])
        files = files.select(F.substring("path", len(root) + 2, 1 << 30).alias("path"), F.col("text").alias("content"))
        out, counts, readme = stages.assemble(files)
        readers.write_texts(out.select("target", "content").unionByName(readme.select(F.lit("README.md").alias("target"), F.col("readme").alias("content"))), a.output)
        print(counts.first().asDict())
    return 0


if __name__ == "__main__":
    sys.exit(main())
