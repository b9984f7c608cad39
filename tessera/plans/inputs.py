"""Derived inputs: deterministic tables built from the base tables, the same rule here and in the oracles' SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.functions.text import hyphen_case, rough_tokens

EXTENSIONS = ("pdf", "PPTX", "docx", "html", "md", "txt", "csv", "xlsx", "png", "mp3", "zip")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def files(spark: SparkSession, sf_dir: str) -> DataFrame:
    ext = F.element_at(F.array(*[F.lit(e) for e in EXTENSIONS]), (F.col("doc_id") % 11 + 1).cast("int"))
    path = F.concat(F.lit("input/"), F.col("source"), F.lit("/"), F.col("lang"), F.lit("/doc_"), F.col("doc_id"), F.lit("."), ext)
    return table(spark, sf_dir, "documents").select("doc_id", path.alias("path"), F.col("n_chars").alias("length"))


def urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    p, n = F.col("page_id"), F.col("page_id").cast("string")
    kinds = [F.concat(F.lit("https://www.YouTube.com/watch?v=vid"), n, F.lit("&t=1")), F.concat(F.lit("https://www.bilibili.com/video/BV"), n), F.concat(F.lit("https://github.com/owner/repo-"), n),
             F.concat(F.lit("https://github.com/owner/re.po"), n), F.concat(F.lit("https://github.com/owner/repo"), n, F.lit("/issues/"), n), F.concat(F.lit("https://github.com/owner/repo"), n, F.lit(".git"))]
    made = kinds[-1]
    for k, c in enumerate(kinds[:-1]):
        made = F.when(p % 6 == k, c).otherwise(made)
    pages = table(spark, sf_dir, "pages")
    return pages.select((p * 2).alias("url_id"), "url").unionByName(pages.select((p * 2 + 1).alias("url_id"), made.alias("url")))


def md_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One Markdown document per conversation: a title, user turns as second level, others as third; a preamble for even ids."""
    c = F.col("conv_id").cast("string")
    head = F.concat(F.when(F.col("role") == "user", "## Turn ").otherwise("### Turn "), F.col("turn"), F.lit(" ("), F.col("role"), F.lit(")\n\n"), F.col("text"), F.lit("\n\n"))
    rows = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", head.alias("md")))).alias("turns"))
    pre = F.when(F.col("conv_id") % 2 == 0, F.concat(F.lit("Preamble of "), c, F.lit("\n\n"))).otherwise("")
    return rows.select(F.col("conv_id").alias("doc_id"), F.concat(pre, F.lit("# Conversation "), c, F.lit("\n\n"), F.array_join(F.transform("turns", lambda t: t["md"]), "")).alias("text"))


def skus(spark: SparkSession, sf_dir: str) -> DataFrame:
    factual = F.col("doc_id") % 3 < 2
    d = table(spark, sf_dir, "documents")
    first_line = F.element_at(F.split("text", "\n", 2), 1)
    words = F.array_join(F.slice(F.split(F.col("text"), "[ \n]+", 6), 1, 5), " ")
    sid = F.when(factual, F.format_string("sku_%03d", "doc_id")).otherwise(F.format_string("skill_%03d", "doc_id"))
    cls = F.when(factual, "factual").otherwise("procedural")
    return d.select(F.col("doc_id").alias("ord"), sid.alias("sku_id"), hyphen_case(words).alias("name"), cls.alias("classification"), F.concat(F.lit("/data/out/"), cls, F.lit("/"), sid).alias("path"),
                    F.col("source").alias("source_chunk"), F.col("n_chars").alias("character_count"), first_line.alias("description"), F.col("text").alias("content"), "lang")


def parse_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_type")
    status = F.when(kind == "error", "failed").when(kind == "click", "skipped").otherwise("success")
    return table(spark, sf_dir, "events").select(F.col("event_id"), status.alias("status"), F.floor("value").cast("long").alias("character_count"), F.col("ts").alias("started_at"), F.col("props").alias("metadata"))


def responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    s, i = F.col("source"), F.col("doc_id").cast("string")
    j = F.concat(F.lit('{"id": '), i, F.lit(', "source": "'), s, F.lit('"}'))
    k = F.col("doc_id") % 6
    text = (F.when(k == 0, F.concat(F.lit("  "), j, F.lit("\n"))).when(k == 1, F.concat(F.lit("```json\n"), j, F.lit("\n```"))).when(k == 2, F.concat(F.lit("```\n"), j, F.lit("\n```")))
            .when(k == 3, F.replace(j, F.lit('"'), F.lit("'"))).when(k == 4, F.concat(F.lit('{"id": '), i, F.lit(', "source": "'), s)).otherwise(F.concat(F.lit("Here it is: "), j, F.lit(" done"))))
    return table(spark, sf_dir, "documents").select("doc_id", text.alias("text"))


def cut_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    s, i = F.col("source"), F.col("doc_id").cast("string")
    before, after = F.concat(F.lit("alpha "), i), F.concat(F.lit("beta "), i)
    ordered = F.concat(F.lit('{"tokens_before": "'), before, F.lit('", "tokens_after": "'), after, F.lit('", "chunk_title": "'), s, F.lit('"}'))
    other = F.concat(F.lit('{"chunk_title": "'), s, F.lit('", "tokens_before": "'), before, F.lit('", "tokens_after": "'), after, F.lit('"}'))
    k = F.col("doc_id") % 4
    text = (F.when(k == 0, F.concat(F.lit('{"cut_points": ['), ordered, F.lit("]}"))).when(k == 1, F.concat(F.lit("cut_points: ["), ordered, F.lit(","))).when(k == 2, F.concat(F.lit("cut_points: ["), other, F.lit(",")))
            .otherwise(F.lit("no cut points")))
    return table(spark, sf_dir, "documents").select("doc_id", text.alias("text"))


def label_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Region > nation > market segment of each customer, the nation in upper or lower case by customer."""
    c, n, r = (table(spark, sf_dir, t) for t in ("customer", "nation", "region"))
    rows = c.join(n, c["c_nationkey"] == n["n_nationkey"]).join(r, n["n_regionkey"] == r["r_regionkey"])
    nation = F.when(F.col("c_custkey") % 2 == 0, F.col("n_name")).otherwise(F.lower("n_name"))
    return rows.select(F.col("c_custkey").alias("ord"), F.array("r_name", nation, "c_mktsegment").alias("path"))


def part_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = table(spark, sf_dir, "part").groupBy("p_type", "p_brand").agg(F.min("p_partkey").alias("ord"))
    return pairs.select("ord", F.array("p_type", "p_brand").alias("path"))


def terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    word = F.element_at(F.split("p_name", " "), -1)
    word = F.when(F.col("p_partkey") % 3 == 0, F.upper(word)).otherwise(word)
    none = F.expr("cast(array() as array<string>)")
    return table(spark, sf_dir, "part").select(F.col("p_partkey").alias("ord"), word.alias("term"), F.concat_ws(" ", "p_name", "p_type").alias("definition"), F.array("p_type").alias("labels"),
                                               F.array("p_brand").alias("source_chunks"), none.alias("aliases"), F.array(F.element_at(F.split("p_name", " "), 1)).alias("related_terms"))


def edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    li, p, s = (table(spark, sf_dir, t) for t in ("lineitem", "part", "supplier"))
    rows = li.join(p, li["l_partkey"] == p["p_partkey"]).join(s, li["l_suppkey"] == s["s_suppkey"])
    pred = F.when(F.col("l_returnflag") == "A", "part-of").when(F.col("l_returnflag") == "N", "requires").otherwise("supplied-by")
    upper = F.col("l_linenumber") % 2 == 0
    return rows.select((F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("ord"), F.when(upper, F.upper("p_name")).otherwise(F.col("p_name")).alias("subject"), pred.alias("predicate"),
                       F.col("s_name").alias("object"), F.array("l_linestatus").alias("source_chunks"), F.col("p_brand").alias("chunk_id"))


def dedup_actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One scripted action for each pair of an even id and the next one."""
    u = skus(spark, sf_dir)
    a = u.where("ord % 2 = 0").select(F.col("ord"), F.col("sku_id").alias("sku_a"))
    b = u.where("ord % 2 = 1").select((F.col("ord") - 1).alias("ord"), F.col("sku_id").alias("sku_b"))
    k = F.floor(F.col("ord") / 2) % 5
    void = F.expr("cast(array() as array<string>)")
    return a.join(b, "ord").select("ord", "sku_a", "sku_b", F.element_at(F.array(*[F.lit(x) for x in ("delete", "rewrite", "merge", "keep", "contradiction")]), (k + 1).cast("int")).alias("action"),
                                   F.when(k == 0, F.array("sku_b", F.lit("sku_x"))).when(k == 2, F.array("sku_a")).otherwise(void).alias("deleted_skus"),
                                   F.when(k == 1, F.array("sku_a")).otherwise(void).alias("rewritten_skus"), F.when(k == 1, F.concat(F.lit("rewritten "), F.col("sku_a"))).alias("new_content"),
                                   F.when(k == 2, F.concat(F.lit("merged "), F.col("sku_a"))).alias("merged_content"), F.lit("b").alias("bucket_id"))


def bucket_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Units in buckets by source and class."""
    return skus(spark, sf_dir).select(F.concat_ws("_", "classification", "source_chunk").alias("bucket_id"), "sku_id", "ord", rough_tokens(F.col("character_count")).cast("long").alias("token_count"))


def chat_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations; the last user message of every fourth one is a confirmation."""
    c = table(spark, sf_dir, "conversations")
    last = F.max(F.when(F.col("role") == "user", F.col("turn"))).over(Window.partitionBy("conv_id"))
    text = F.when((F.col("conv_id") % 4 == 0) & (F.col("role") == "user") & (F.col("turn") == last), F.lit(" /Confirm ")).otherwise(F.col("text"))
    return c.select(F.col("conv_id").alias("session_id"), F.col("turn").alias("seq"), "role", text.alias("content"))
