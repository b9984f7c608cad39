"""Workspace assembly, chat replay, transcripts and skill checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.text import rewrite_paths, strip

#: Fixed value: sentence ends that close a transcript paragraph.
SENTENCE_ENDS = (".", "!", "?", "...", "。", "！", "？")
SKILL_KEYS = ("name", "description", "license", "allowed-tools", "metadata")


def assembled(files: DataFrame, folders: tuple[str, ...] = ("factual", "procedural", "relational", "postprocessing")) -> DataFrame:
    """Files (path below the units' folder, content) of the copied folders with their workspace path, and the two meta
    files, which move to the top."""
    top = F.element_at(F.split("path", "/"), 1)
    meta = F.col("path").isin("meta/mapping.md", "meta/eureka.md")
    target = F.when(meta, F.element_at(F.split("path", "/"), -1)).otherwise(F.concat(F.lit("skus/"), F.col("path")))
    out = files.where(top.isin(*folders) | meta | (F.col("path") == "skus_index.json")).withColumn("target", target)
    rewritten, count = rewrite_paths(F.col("content"))
    changed = F.col("path").isin("meta/mapping.md", "meta/eureka.md", "skus_index.json")
    return out.withColumn("paths_rewritten", F.when(changed, count).otherwise(0)).withColumn("content", F.when(changed, rewritten).otherwise(F.col("content")))


def manifest(files: DataFrame) -> DataFrame:
    """One row of counts over :func:`assembled` files."""
    part = lambda n: F.element_at(F.split("path", "/"), n)
    units = lambda c: F.countDistinct(F.when((F.element_at(F.split("path", "/"), 1) == c) & (F.size(F.split("path", "/")) > 2), F.element_at(F.split("path", "/"), 2)))
    some = lambda c: F.coalesce(F.bool_or(c), F.lit(False))
    return files.agg(units("factual").alias("factual_count"), units("procedural").alias("procedural_count"), some(part(1) == "relational").alias("has_relational"),
                     some(F.col("target") == "mapping.md").alias("has_mapping"), some(F.col("target") == "eureka.md").alias("has_eureka"),
                     F.count(F.lit(1)).alias("total_files_copied"), F.coalesce(F.sum("paths_rewritten"), F.lit(0)).cast("long").alias("paths_rewritten"))


_README = {"en": ("# Workspace", "Factual SKUs", "Procedural SKUs", "Relational knowledge", "Total files", "yes", "no"), "zh": ("# 工作区", "事实性 SKU", "程序性 SKU", "关系型知识", "文件总数", "有", "无")}


def readme(row: DataFrame, title: str | None = None, language: str = "en") -> DataFrame:
    head, factual, procedural, relational, total, yes, no = _README.get(language, _README["en"])
    line = lambda name, value: F.concat(F.lit(f"- **{name}**: "), value)
    lines = F.concat_ws("\n", F.lit(title or head), F.lit(""), line(factual, F.col("factual_count")), line(procedural, F.col("procedural_count")), line(relational, F.when(F.col("has_relational"), yes).otherwise(no)),
                        line(total, F.col("total_files_copied")))
    return row.select(lines.alias("readme"))


def chat_rounds(messages: DataFrame, max_rounds: int = 5) -> DataFrame:
    """Replay of chat sessions (session_id, seq, role, content): rounds_used, confirmed, finalized.

    A user message that is not blank is a round; ``/confirm`` ends the session without being one; so does the round limit.
    Messages after the end do not count.
    """
    said = F.lower(strip(F.col("content")))
    rows = messages.withColumn("_user", (F.col("role") == "user") & (said != "")).withColumn("_ok", F.col("_user") & (said == "/confirm"))
    w = Window.partitionBy("session_id").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("_before", F.coalesce(F.sum((F.col("_user") & ~F.col("_ok")).cast("int")).over(w), F.lit(0))).withColumn("_done", F.coalesce(F.max("_ok").over(w), F.lit(False)))
    live = F.col("_user") & ~F.col("_done") & (F.col("_before") < max_rounds)
    out = rows.groupBy("session_id").agg(F.count_if(live & ~F.col("_ok")).cast("int").alias("rounds_used"), F.bool_or(live & F.col("_ok")).alias("confirmed"))
    return out.withColumn("finalized_by", F.when(F.col("confirmed"), "confirm").when(F.col("rounds_used") >= max_rounds, "limit").otherwise("end"))


def transcript_paragraphs(segments: DataFrame, id_col: str = "video_id") -> DataFrame:
    """Paragraphs of transcript segments (id, seq, text): a segment that ends a sentence ends its paragraph."""
    t = strip(F.col("text"))
    rows = segments.withColumn("_t", t).where("_t <> ''")
    ends = F.lit(False)
    for e in SENTENCE_ENDS:
        ends = ends | F.endswith("_t", F.lit(e))
    w = Window.partitionBy(id_col).orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("paragraph", F.coalesce(F.sum(ends.cast("int")).over(w), F.lit(0)).cast("int"))
    return rows.groupBy(id_col, "paragraph").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("seq", "_t"))), lambda r: r["_t"]), " ").alias("text"))


def transcript_markdown(paragraphs: DataFrame, meta: DataFrame, id_col: str = "video_id", site: str = "YouTube") -> DataFrame:
    """(id, markdown): a head with address, id and, where given, title; then the paragraphs."""
    text = paragraphs.groupBy(id_col).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("paragraph", "text"))), lambda r: r["text"]), "\n\n").alias("_body"))
    head = F.concat_ws("\n", F.lit(f"# {site} Video Transcript"), F.lit(""), F.concat(F.lit("**Video URL:** "), F.col("url")), F.concat(F.lit("**Video ID:** "), F.col(id_col)),
                       F.when(F.col("title").isNotNull(), F.concat(F.lit("**Title:** "), F.col("title"))), F.lit(""), F.lit("---"), F.lit(""), F.lit("## Transcript"), F.lit(""))
    return meta.join(text, id_col).select(id_col, F.concat(head, F.lit("\n"), F.col("_body")).alias("markdown"))


def page_markdown(pages: DataFrame, by: str, order: str, sep: str, limit: int | None = None) -> DataFrame:
    """Non-empty pages (by, order, piece) joined in order; ``limit`` keeps the first pages of each."""
    rows = pages.where(F.coalesce("piece", F.lit("")) != "")
    if limit is not None:
        rows = rows.withColumn("_r", F.row_number().over(Window.partitionBy(by).orderBy(order))).where(F.col("_r") <= limit)
    return rows.groupBy(by).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(order, "piece"))), lambda r: r["piece"]), sep).alias("markdown"), F.count(F.lit(1)).alias("pages"))


def crawl_markdown(pages: DataFrame, limit: int = 50) -> DataFrame:
    """Crawled pages (site, ord, url, md) as one text per site."""
    piece = F.when(F.coalesce("md", F.lit("")) != "", F.concat(F.lit("# "), F.col("url"), F.lit("\n\n"), F.col("md")))
    return page_markdown(pages.withColumn("piece", piece), "site", "ord", "\n\n---\n\n", limit)


def ocr_markdown(pages: DataFrame) -> DataFrame:
    """OCR pages (source_path, page, text, done): failed pages and pages without a result are marked."""
    text = (F.when(~F.coalesce("done", F.lit(False)), F.format_string("<!-- OCR missing: page %d -->", F.col("page") + 1))
            .when(F.col("text").isNull(), F.format_string("<!-- OCR failed: page %d -->", F.col("page") + 1)).otherwise(F.col("text")))
    out = page_markdown(pages.withColumn("piece", text), "source_path", "page", "\n\n---\n\n")
    failed = pages.groupBy("source_path").agg(F.count_if(F.coalesce("done", F.lit(False)) & F.col("text").isNull()).alias("failed_pages"))
    return out.join(failed, "source_path")


def split_markdown(parts: DataFrame) -> DataFrame:
    """Parts (source_path, part from 1, md) of a split document, headed from the second part on."""
    piece = F.when(F.col("part") == 1, F.col("md")).otherwise(F.concat(F.lit("\n\n---\n\n# Part "), F.col("part"), F.lit("\n\n"), F.col("md")))
    return page_markdown(parts.withColumn("piece", piece), "source_path", "part", "")


def skill_message(text: Column, name: Column, description: Column, keys: Column) -> Column:
    """The first rule a skill file breaks, or that it is valid. ``name``, ``description`` and ``keys`` come from its front matter
    (null where missing)."""
    extra = F.array_sort(F.array_except(keys, F.array(*[F.lit(k) for k in SKILL_KEYS])))
    return (F.when(~text.startswith("---"), "No YAML frontmatter found")
            .when(~F.regexp_like(text, F.lit("(?s)\\A---\\n.*?\\n---")), "Invalid frontmatter format")
            .when(F.size(extra) > 0, F.concat(F.lit("Unexpected key(s) in SKILL.md frontmatter: "), F.array_join(extra, ", "), F.lit(". Allowed properties are: " + ", ".join(sorted(SKILL_KEYS)))))
            .when(name.isNull(), "Missing 'name' in frontmatter")
            .when(description.isNull(), "Missing 'description' in frontmatter")
            .when(~F.regexp_like(name, F.lit("\\A[a-z0-9-]*\\z")), F.concat(F.lit("Name '"), name, F.lit("' should be hyphen-case (lowercase letters, digits, and hyphens only)")))
            .when(name.startswith("-") | name.endswith("-") | name.contains("--"), F.concat(F.lit("Name '"), name, F.lit("' cannot start/end with hyphen or contain consecutive hyphens")))
            .when(F.length(name) > 64, F.concat(F.lit("Name is too long ("), F.length(name), F.lit(" characters). Maximum is 64 characters.")))
            .when(description.contains("<") | description.contains(">"), "Description cannot contain angle brackets (< or >)")
            .when(F.length(description) > 1024, F.concat(F.lit("Description is too long ("), F.length(description), F.lit(" characters). Maximum is 1024 characters."))).otherwise("Skill is valid!"))


def front_matter_fields(text: Column) -> Column:
    """Front matter with one ``key: value`` per line as a map."""
    block = F.regexp_extract(text, "(?s)\\A---\\n(.*?)\\n---", 1)
    lines = F.filter(F.split(block, "\n"), lambda x: F.regexp_like(x, F.lit("^[A-Za-z0-9_-]+\\s*:")))
    return F.map_from_entries(F.transform(lines, lambda x: F.struct(F.trim(F.regexp_extract(x, "^([A-Za-z0-9_-]+)\\s*:", 1)).alias("k"), F.trim(F.regexp_replace(x, "^[A-Za-z0-9_-]+\\s*:", "")).alias("v"))))
