"""Markdown segmentation as set operations: sections, section tree, subtree sums, header chunks, window chunks.

A document's sections are rows in preorder, so a subtree is a run of rows: it ends before the next section of the same
or a smaller level. That turns the recursive walk over the tree into windows within a document.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.config import DEFAULTS, Settings
from tessera.durable import new_folder, table_at
from tessera.functions.edit_distance import cut_position_of
from tessera.functions.responses import cleaned, cut_points
from tessera.functions.text import Estimate, paragraph_cut, strip
from tessera.operators import prompts
from tessera.operators.routing import chunk_method
from tessera.sources.providers import Provider, completions

_HEADER = "(?md)^(#{1,6})\\s+(.+)$"


def sections(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", measure=Estimate) -> DataFrame:
    """doc_id, seq, level, title, content, start_pos, end_pos, token_count; blank texts have none, a blank preamble is dropped.

    Splitting before each header line keeps all characters, so positions are running lengths within the array.
    """
    parts = F.split(F.col(text_col), "(?md)(?=^#{1,6}\\s+.+$)", -1)
    rows = docs.where(strip(F.col(text_col)) != "").select(F.col(id_col).alias("doc_id"), parts.alias("_parts"))
    starts = F.aggregate("_parts", F.array(F.lit(0)), lambda acc, p: F.concat(acc, F.array(F.element_at(acc, -1) + F.length(p))))
    rows = rows.withColumn("_starts", starts).select("doc_id", F.posexplode(F.arrays_zip("_parts", "_starts")).alias("_no", "_s"))
    rows = rows.select("doc_id", "_no", F.col("_s._parts").alias("content"), F.col("_s._starts").alias("start_pos"))
    rows = rows.withColumn("level", F.length(F.regexp_extract("content", _HEADER, 1))).withColumn("title", strip(F.regexp_extract("content", _HEADER, 2)))
    header_first = F.regexp_like("content", F.lit("(?d)\\A#{1,6}\\s+.+"))
    rows = rows.withColumn("level", F.when(header_first, F.col("level")).otherwise(0)).withColumn("title", F.when(header_first, F.col("title")).otherwise(""))
    rows = rows.where((F.col("level") > 0) | (strip(F.col("content")) != ""))
    w = Window.partitionBy("doc_id").orderBy("_no")
    return rows.select("doc_id", F.row_number().over(w).alias("seq"), "level", "title", "content", "start_pos",
                       (F.col("start_pos") + F.length("content")).alias("end_pos"), measure.count(F.col("content")).alias("token_count"))


def section_tree(rows: DataFrame) -> DataFrame:
    """``sections`` with parent_seq, subtree_end_seq (exclusive), subtree_end_pos, subtree_tokens and has_children.

    The parent is the last earlier section of a smaller level (but not a preamble). The subtree ends at the next section
    of the same or a smaller level; a preamble is its own subtree and ends no other. Positions and running sums grow with seq, so the values where a subtree ends are least values
    over the later sections of each level: no row holds another row's list.
    """
    doc = Window.partitionBy("doc_id")
    w = doc.orderBy("seq")
    before, after = w.rowsBetween(Window.unboundedPreceding, -1), w.rowsBetween(1, Window.unboundedFollowing)
    upto = F.coalesce(F.sum("token_count").over(before), F.lit(0)).cast("long")
    out = rows.withColumn("_upto", upto).withColumns({"_all": F.sum("token_count").over(doc).cast("long"), "_size": F.count("*").over(doc), "_last": F.max("end_pos").over(doc)})
    of_level = lambda k, c: F.when(F.col("level") == k, F.col(c))
    levels = range(1, 7)
    out = out.withColumns({f"_l{k}": F.max(of_level(k, "seq")).over(before) for k in levels}
                          | {f"_{n}{k}": F.min(of_level(k, c)).over(after) for k in levels for n, c in (("n", "seq"), ("p", "start_pos"), ("t", "_upto"))})

    def first_end(n: str, whole: Column, own: Column) -> Column:
        end = own
        for level in levels:
            end = F.when(F.col("level") == level, F.least(*[F.col(f"_{n}{k}") for k in range(1, level + 1)], whole)).otherwise(end)
        return end

    parent = F.lit(None).cast("int")
    for level in levels[1:]:
        parent = F.when(F.col("level") == level, F.greatest(*[F.col(f"_l{k}") for k in range(1, level)], F.lit(None).cast("int"))).otherwise(parent)
    out = out.withColumns({"parent_seq": parent, "subtree_end_seq": first_end("n", F.col("_size") + 1, F.col("seq") + 1).cast("int"), "subtree_end_pos": first_end("p", F.col("_last"), F.col("end_pos")),
                           "subtree_tokens": first_end("t", F.col("_all"), F.col("_upto") + F.col("token_count")) - F.col("_upto")})
    out = out.withColumn("has_children", F.col("subtree_end_seq") > F.col("seq") + 1)
    return out.drop("_upto", "_all", "_size", "_last", *[f"_{n}{k}" for n in "lnpt" for k in levels])


def header_chunks(docs: DataFrame, budget: int, id_col: str = "doc_id", text_col: str = "text", name_col: str | None = None, measure=Estimate) -> DataFrame:
    """Chunks of documents that have headers and exceed the budget, by peeling the section tree.

    A node whose subtree fits is a chunk if its parent does not fit (sums only shrink downwards, so then no ancestor
    fits). A node that does not fit gives its own content as an introduction if it has children, else an oversized chunk.
    """
    name = F.col(name_col) if name_col else F.col(id_col).cast("string")
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("_text"), name.alias("_name"))
    tree = section_tree(sections(source, "doc_id", "_text", measure))
    fits = tree.select("*", (F.col("subtree_tokens") <= budget).alias("_fits"))
    # Whether the parent fits: the last earlier section of each smaller level, seq first, so the greatest is the parent.
    before = Window.partitionBy("doc_id").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    fits = fits.withColumns({f"_l{k}": F.max(F.when(F.col("level") == k, F.struct("seq", "_fits"))).over(before) for k in range(1, 6)})
    up = F.lit(False)
    for level in range(2, 7):
        up = F.when(F.col("level") == level, F.coalesce(F.greatest(*[F.col(f"_l{k}") for k in range(1, level)], F.lit(None).cast("struct<seq:int,_fits:boolean>"))["_fits"], F.lit(False))).otherwise(up)
    fits = fits.withColumn("_up", up).withColumn("_end", F.col("subtree_end_pos")).drop(*[f"_l{k}" for k in range(1, 6)])
    whole, intro = F.col("_fits") & ~F.col("_up"), ~F.col("_fits") & F.col("has_children")
    rows = fits.where(whole | ~F.col("_fits")).join(source, "doc_id")
    content = F.when(whole, F.substr("_text", F.col("start_pos") + 1, F.col("_end") - F.col("start_pos"))).otherwise(F.col("content"))
    titled = F.col("title") != ""
    title = (F.when(whole, F.when(titled, F.col("title")).otherwise(F.col("_name")))
             .when(intro, F.when(titled, F.concat("title", F.lit(" (Introduction)"))).otherwise("Introduction"))
             .otherwise(F.when(titled, F.col("title")).otherwise("Oversized Section")))
    rows = rows.select("doc_id", "seq", title.alias("title"), content.alias("content"), F.when(F.col("level") > 0, F.col("level")).alias("header_level"), intro.alias("_intro"))
    rows = rows.where(~F.col("_intro") | (strip(F.col("content")) != "")).drop("_intro")
    return numbered(rows.withColumn("chunking_method", F.lit("header")), "seq", measure=measure)


def numbered(rows: DataFrame, *order: str, measure=Estimate) -> DataFrame:
    """Chunk index from 0 and total per document, sizes and token estimates."""
    w = Window.partitionBy("doc_id")
    return (rows.withColumn("chunk_index", F.row_number().over(w.orderBy(*order)) - 1).withColumn("total_chunks", F.count("*").over(w).cast("int"))
            .withColumn("character_count", F.length("content")).withColumn("estimated_tokens", measure.count(F.col("content"))).drop(*order))


_ALL = (1 << 31) - 1
CutFinder = Callable[[str], "tuple[int, str] | None"]


def window_parts(text: str, budget_chars: int, find: CutFinder | None = None, least: int = 100) -> Iterator[tuple[str, str | None]]:
    """(content, title or None) of a long text cut window by window.

    ``find`` looks at what is left and may give a cut and a title; without it, or when it gives none, or one below
    ``least``, the cut is at the last paragraph, line or sentence end inside the budget.
    """
    def boundary(rest: str) -> int:
        head = rest[:budget_chars]
        for sep in ("\n\n", "\n", ". ", "! ", "? "):
            at = head.rfind(sep)
            if at > least:
                return at + len(sep)
        return len(head)

    rest, no = text, 0
    while rest:
        # the budget holds when a quarter of the characters, rounded down, does not exceed it
        if max(1, len(rest) // 4) <= budget_chars // 4:
            yield rest, None if no == 0 else f"Part {no + 1}"
            return
        found = find(rest) if find else None
        if found is None:
            cut = boundary(rest)
            yield rest[:cut], f"Part {no + 1}"
        else:
            cut, title = found
            if cut is None or cut < least:
                cut, title = boundary(rest), f"Part {no + 1}"
            yield rest[:cut].rstrip(), title
        rest, no = rest[cut:].lstrip(), no + 1


def window_chunks(docs: DataFrame, budget: int, finder: CutFinder | None = None, id_col: str = "doc_id", text_col: str = "text", name_col: str | None = None) -> DataFrame:
    """Chunks of texts without headers: sequential within a document, documents in parallel."""
    name = F.col(name_col) if name_col else F.col(id_col).cast("string")
    kind = docs.schema[id_col].dataType.simpleString()

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = [(i, n, t if t is not None else name_, c) for i, text, name_ in frame.itertuples(index=False) for n, (c, t) in enumerate(window_parts(text or "", budget * 4, finder))]
            yield pd.DataFrame(rows, columns=["doc_id", "seq", "title", "content"])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), name.alias("name")).mapInPandas(cut, f"doc_id {kind}, seq int, title string, content string")
    return numbered(rows.withColumn("header_level", F.lit(None).cast("int")).withColumn("chunking_method", F.lit("llm")), "seq")


def requested_chunks(docs: DataFrame, budget: int, provider: Provider, measure=Estimate, folder: str | None = None, settings: Settings = DEFAULTS,
                     id_col: str = "doc_id", text_col: str = "text", name_col: str | None = None) -> DataFrame:
    """Chunks of texts without headers, cut where a model says: all open documents take one step a round.

    A round takes the window of ``budget`` tokens at the place each document has come to, asks for cut points, reads the answer tolerantly and looks for the first cut point in what is left of the text. An answer
    without a cut point, one that is not found, or one below ``settings.least_cut`` characters gives a cut at the last paragraph, line or sentence end of the window. A chunk that ends where the model says loses its trailing
    white space, one that ends elsewhere keeps it. What is left goes on in the next round, without its leading white space; a rest within the budget is the last chunk. There are as many rounds as the longest document has chunks.

    Each round is a table in ``folder`` with places only, no texts. A run started again over the folder asks only for the rounds that are not there. A null or empty text has no chunk.
    """
    folder = folder or new_folder(docs.sparkSession, "cuts")
    name = F.col(name_col) if name_col else F.col(id_col).cast("string")
    base = table_at(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), name.alias("name")).where("text <> ''"), f"{folder}/texts")
    open_, rounds, part = base.select("doc_id", F.lit(0).alias("at")), [], 0
    while True:
        rest = base.join(open_, "doc_id").select("doc_id", "name", "at", F.substring(F.col("text"), F.col("at") + 1, F.length("text")).alias("rest"))
        rest = rest.withColumn("_n", measure.count(F.col("rest")))
        last = F.when(F.col("_n") <= budget, True).otherwise(False)
        head = rest.select("*", last.alias("last"), F.when(~last, measure.truncated(F.col("rest"), budget)).alias("window"))
        prompt = F.when(~F.col("last"), prompts.rendered("cuts", {"k": F.lit(str(settings.k_nearest_tokens)), "window": F.col("window")}, settings.language))
        keyed = head.select(F.struct("doc_id", "name", "at", "rest", "window", "last").alias("key"), prompt.alias("prompt"))
        got = completions(keyed, provider, "key", "prompt", temperature=0.3, max_tokens=2000).select("key.*", F.try_element_at(cut_points(cleaned(F.col("answer"))), F.lit(1)).alias("cut"))
        found = cut_position_of(F.col("cut.tokens_before"), F.col("cut.tokens_after"), F.col("rest"))
        got = got.withColumn("found", F.when(~F.col("last") & F.col("cut").isNotNull(), found))
        good = F.coalesce(F.col("found") >= settings.least_cut, F.lit(False))
        size = F.when(F.col("last"), F.length("rest")).when(good, F.col("found")).otherwise(paragraph_cut(F.col("window"), _ALL, settings.least_cut))
        title = F.when(F.col("last") & F.lit(part == 0), F.col("name")).when(good, F.coalesce("cut.chunk_title", F.lit(f"Part {part + 1}"))).otherwise(f"Part {part + 1}")
        step = got.select("doc_id", F.lit(part).alias("seq"), title.alias("title"), F.col("at").alias("first"), size.cast("int").alias("size"), (~F.col("last") & good).alias("trimmed"), "rest")
        tail = F.substring(F.col("rest"), F.col("size") + 1, F.length("rest"))
        gap = F.length(tail) - F.length(F.regexp_replace(tail, "(?U)^\\s+", ""))
        step = table_at(step.withColumn("next", F.when(F.length(tail) > gap, F.col("first") + F.col("size") + gap)).drop("rest"), f"{folder}/round-{part:05d}")
        rounds.append(step)
        open_, part = step.where("next IS NOT NULL").select("doc_id", F.col("next").alias("at")), part + 1
        if open_.isEmpty():
            break
    cuts = rounds[0].sparkSession.read.schema(rounds[0].schema).parquet(*[f"{folder}/round-{k:05d}" for k in range(part)])
    content = F.substring(F.col("text"), F.col("first") + 1, F.col("size"))
    rows = cuts.join(base, "doc_id").withColumn("content", F.when(F.col("trimmed"), F.regexp_replace(content, "(?U)\\s+$", "")).otherwise(content))
    rows = rows.select("doc_id", "seq", "title", "content", F.lit(None).cast("int").alias("header_level"), F.lit("llm").alias("chunking_method"))
    return numbered(rows, "seq", measure=measure)


def window_first_cut(text: Column, budget: int) -> Column:
    return paragraph_cut(text, budget * 4)


_COLUMNS = ("doc_id", "chunk_index", "total_chunks", "title", "content", "header_level", "chunking_method", "character_count", "estimated_tokens")


def chunks(docs: DataFrame, budget: int, finder: CutFinder | None = None, id_col: str = "doc_id", text_col: str = "text", name_col: str | None = None, measure=Estimate, provider: Provider | None = None,
           settings: Settings = DEFAULTS) -> DataFrame:
    """All documents chunked: whole when they fit, by headers, else by windows; oversized header chunks are cut again
    and the chunks of a document are numbered anew. With a ``provider``, windows are cut where it says. ``measure`` counts tokens: the estimate, or a rank table's (:class:`tessera.functions.bpe.Tokens`)."""
    name = F.col(name_col) if name_col else F.col(id_col).cast("string")
    base = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), name.alias("name"))
    base = base.withColumn("_method", chunk_method(F.col("text"), budget, measure.count))
    plain = ("doc_id", "_a", "_b", "title", "content", "header_level", "chunking_method")
    one = base.where("_method = 'single'").select("doc_id", F.lit(0).alias("_a"), F.lit(0).alias("_b"), F.col("name").alias("title"), F.col("text").alias("content"),
                                                   F.lit(None).cast("int").alias("header_level"), F.lit("single").alias("chunking_method"))
    heads = header_chunks(base.where("_method = 'header'"), budget, name_col="name", measure=measure)
    good = heads.where(F.col("estimated_tokens") <= budget).withColumn("_a", F.col("chunk_index")).withColumn("_b", F.lit(0)).select(*plain)
    big = heads.where(F.col("estimated_tokens") > budget).select(F.struct("doc_id", "chunk_index", "title").alias("key"), "content")
    if provider is None:
        parts = recut(big, budget, finder)
    else:
        parts = requested_chunks(big.select("key", "content", "key.title"), budget, provider, measure, settings=settings, id_col="key", text_col="content", name_col="title")
        parts = parts.select(F.col("doc_id").alias("key"), F.col("chunk_index").alias("seq"), "content")
    again = parts.select("key.doc_id", F.col("key.chunk_index").alias("_a"), F.col("seq").alias("_b"),
                         F.concat(F.col("key.title"), F.lit(" (Part "), F.col("seq") + 1, F.lit(")")).alias("title"), "content", F.lit(None).cast("int").alias("header_level"), F.lit("llm").alias("chunking_method"))
    open_ = base.where("_method = 'window'")
    window = window_chunks(open_, budget, finder, name_col="name") if provider is None else requested_chunks(open_, budget, provider, measure, settings=settings, name_col="name")
    window = window.withColumn("_a", F.col("chunk_index")).withColumn("_b", F.lit(0)).select(*plain)
    return numbered(one.unionByName(good).unionByName(again).unionByName(window), "_a", "_b", measure=measure).select(*_COLUMNS)


def recut(rows: DataFrame, budget: int, finder: CutFinder | None = None) -> DataFrame:
    """(key, seq, content) parts of oversized contents."""
    kind = rows.schema["key"].dataType

    def cut(frames):
        for batch in frames:
            import pyarrow as pa

            at, seq, out = [], [], []
            for i, text in enumerate(batch.column(1).to_pylist()):
                for n, (c, _) in enumerate(window_parts(text or "", budget * 4, finder)):
                    at.append(i)
                    seq.append(n)
                    out.append(c)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at, pa.int64())), pa.array(seq, pa.int32()), pa.array(out, pa.string())], ["key", "seq", "content"])

    return rows.select("key", "content").mapInArrow(cut, f"key {kind.simpleString()}, seq int, content string")


def front_matter(rows: DataFrame, source_col: str = "source_file") -> Column:
    """A chunk as a file: YAML front matter (chunk number from 1; quotes in titles are not escaped) and content."""
    return F.concat(F.lit('---\ntitle: "'), F.col("title"), F.lit('"\nsource: "'), F.col(source_col), F.lit('"\nchunk: '), F.col("chunk_index") + 1, F.lit("\ntotal: "), F.col("total_chunks"),
                    F.lit("\ntokens: "), F.col("estimated_tokens"), F.lit('\nmethod: "'), F.col("chunking_method"), F.lit('"\n---\n\n'), F.col("content"))


def chunk_id(source: Column) -> Column:
    """Id of a chunk: flattened source path and the number from 1, three digits at least."""
    flat = F.regexp_replace(F.regexp_replace(source, "(?<=[^./])\\.[^./]+$", ""), "[/\\\\]", "_")
    return F.concat(flat, F.format_string("_chunk_%03d", F.col("chunk_index") + 1))
