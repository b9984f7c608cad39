"""Routing and selection of files and addresses."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.text import REPO, REPO_PAGES, VIDEO_A, VIDEO_B, suffix, tokens

#: Which reader takes which suffix, and which suffixes are skipped.
MARKUP = (".pdf", ".ppt", ".pptx", ".doc", ".docx", ".html", ".htm", ".epub", ".md", ".txt")
TABULAR = (".xlsx", ".xls", ".csv")
SKIPPED = (".png", ".jpg", ".jpeg", ".gif", ".bmp", ".svg", ".ico", ".webp", ".tiff", ".mp3", ".mp4", ".wav", ".avi", ".mov", ".flv", ".wmv",
           ".css", ".js", ".hhc", ".hhk")
IGNORED_NAMES = ("urls.txt", ".gitkeep", ".DS_Store", ".env", ".env.example")
RESERVED_FOLDERS = ("chunks", "passthrough", "skus")


def file_parser(name: Column) -> Column:
    s = suffix(name)
    return F.when(s.isin(*MARKUP), "markitdown").when(s.isin(*TABULAR), "tabular")


def routed_files(files: DataFrame) -> DataFrame:
    """``files`` (path, ...) with ext, parser, status (pending or skipped) and message."""
    s = suffix(F.col("path"))
    out = files.withColumn("ext", s).withColumn("parser", file_parser(F.col("path")))
    message = F.when(s.isin(*SKIPPED), F.concat(F.lit("Skipped non-text file: "), s)).when(F.col("parser").isNull(), F.concat(F.lit("Unsupported file type: "), s))
    return out.withColumn("message", message).withColumn("status", F.when(message.isNull(), "pending").otherwise("skipped"))


def url_parser(url: Column) -> Column:
    low = F.lower(url)
    some = lambda patterns: F.lit(False) if not patterns else _any([F.regexp_like(low, F.lit(p)) for p in patterns])
    page = _any([F.contains(low, F.lit(p)) for p in REPO_PAGES])
    return F.when(some(VIDEO_A), "youtube").when(some(VIDEO_B), "bilibili").when(some(tuple("(?U)" + p for p in REPO)) & ~page, "repomix").otherwise("firecrawl")


def _any(conditions: list[Column]) -> Column:
    out = conditions[0]
    for c in conditions[1:]:
        out = out | c
    return out


def visible_files(files: DataFrame, root: str) -> DataFrame:
    """Files below ``root`` which are neither hidden, in a hidden folder, nor in the list of ignored names."""
    prefix = root.rstrip("/") + "/"
    parts = F.split(F.substring(F.col("path"), len(prefix) + 1, 1 << 30), "/")
    return files.where(F.col("path").startswith(prefix) & ~F.exists(parts, lambda p: p.startswith(".")) & ~F.element_at(parts, -1).isin(*IGNORED_NAMES))


def url_list(lines: DataFrame) -> DataFrame:
    """Addresses of a list (value): trimmed, no blank and no ``#`` lines; duplicates stay."""
    t = F.trim(F.col("value"))
    return lines.select(t.alias("url")).where((F.col("url") != "") & ~F.col("url").startswith("#"))


def size_mb(length: Column) -> Column:
    return length / F.lit(1024 * 1024)


def exceeds_size(length: Column, max_mb: float = 10.0) -> Column:
    return size_mb(length) > max_mb


def should_chunk(name: Column) -> Column:
    return suffix(name) == ".md"


def chunk_inputs(files: DataFrame, root: str) -> DataFrame:
    """Inputs of the chunker below ``root``: no reserved folder in the path, Markdown before JSON."""
    prefix = root.rstrip("/") + "/"
    parts = F.split(F.substring(F.col("path"), len(prefix) + 1, 1 << 30), "/")
    kind = suffix(F.col("path"))
    rows = files.where(~F.arrays_overlap(parts, F.array(*[F.lit(x) for x in RESERVED_FOLDERS])) & kind.isin(".md", ".json"))
    rows = rows.where(~F.col("path").endswith("parse_results_index.json"))  # the stage's own index is no input
    return rows.withColumn("chunked", kind == ".md").withColumn("ord", F.when(kind == ".md", 0).otherwise(1))


def has_headers(text: Column) -> Column:
    return F.regexp_like(text, F.lit("(?md)^#{1,6}\\s+.+$"))


def chunk_method(text: Column, budget: int, count=tokens) -> Column:
    """single, header or window, as the text's size (tokens by ``count``) and headers decide."""
    return F.when(count(text) <= budget, "single").when(has_headers(text), "header").otherwise("window")


def pdf_split(pages: Column, mb: Column, most_pages: int = 400, most_mb: float = 2.0) -> Column:
    """Pages per part of a large PDF, null where it needs no split."""
    fit = F.greatest(F.lit(50), F.least(F.floor(pages / mb * most_mb * 0.8), F.lit(most_pages)))
    return F.when((pages > most_pages) | (mb > most_mb), F.when(mb > most_mb, fit).otherwise(F.lit(most_pages)))


def page_ranges(pdfs: DataFrame, pages: str = "pages", per: str = "per") -> DataFrame:
    """A row per part: part from 1, first page (0-based) and end."""
    part = F.explode(F.sequence(F.lit(0), F.greatest(F.ceil(F.col(pages) / F.col(per)).cast("int") - 1, F.lit(0)))).alias("_k")
    rows = pdfs.select("*", part)
    return rows.select(*pdfs.columns, (F.col("_k") + 1).alias("part"), (F.col("_k") * F.col(per)).alias("first"), F.least((F.col("_k") + 1) * F.col(per), F.col(pages)).alias("end"))
