"""Queries over runs that ask a model step by step (judgement, scoring, cutting), exact tokens, whole-class buckets and glossary chains.

The models are scripted: their answers follow from the prompt alone, so SQL can tell what a run has to give.
"""

from __future__ import annotations

import json
import re
from dataclasses import dataclass

from pyspark.sql import Window
from pyspark.sql import functions as F

from tessera.durable import new_folder, written
from tessera.functions import bpe, text
from tessera.operators import chat, clustering, graph, judgement, resolution, segmentation
from tessera.plans import inputs, stages
from tessera.plans.catalog import SKUS, URLS, query
from tessera.plans.inputs import table
from tessera.sources import subtitles
from tessera.sources.providers import NullProvider, page_ledger
from tessera.streaming import incremental, knowledge

#: The rank table of the exact token counts; a parameter, the file is no part of this repository.
RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"


@query(None)
def token_count_exact(spark, sf_dir):
    """Exact tokens of every document, what 40 tokens of it say, and whether it needs chunks."""
    exact = bpe.Tokens(spark, bpe.ranks_at(spark, RANKS))
    d = table(spark, sf_dir, "documents").select("doc_id", exact.count(F.col("text")).alias("tokens"), text.tokens(F.col("text")).alias("estimate"), exact.truncated(F.col("text"), 40).alias("head"))
    return d.withColumn("over_budget", F.col("tokens") > 1000)


@query("""SELECT p_partkey * 4 AS ord, 'T' || p_partkey AS term, 'a longer text of ' || p_type AS definition, 'c,' || p_type AS labels, 'A' || p_partkey || ',Z' || p_partkey AS aliases, 'x,' || p_brand AS related_terms FROM part
UNION ALL SELECT p_partkey * 4 + 1, 'B' || p_partkey, 'two', p_type, 'a' || p_partkey || ',Q' || p_partkey, '' FROM part""")
def glossary_chains(spark, sf_dir):
    """Four entries a part: two of them share an alias, a third is that alias and brings another, which the fourth is. The first entry takes both."""
    p, k = table(spark, sf_dir, "part"), F.col("p_partkey")
    none, tag = F.expr("cast(array() as array<string>)"), lambda x: F.concat(F.lit(x), F.col("p_partkey"))

    def entry(place, term, definition, labels, aliases, related):
        return p.select((k * 4 + place).cast("long").alias("ord"), tag(term).alias("term"), definition.alias("definition"), labels.alias("labels"), F.array(F.lit(f"s{place}")).alias("source_chunks"), aliases.alias("aliases"), related.alias("related_terms"))

    rows = entry(0, "T", F.lit("one"), F.array(F.lit("c")), F.array(tag("A")), F.array(F.lit("x"))).unionByName(
        entry(1, "B", F.lit("two"), F.array("p_type"), F.array(tag("a"), tag("Q")), none)).unionByName(
        entry(2, "a", F.concat(F.lit("a longer text of "), "p_type"), F.array("p_type"), F.array(tag("Z"), tag("t")), none)).unionByName(
        entry(3, "z", F.lit("end"), none, none, F.array(F.lit("x"), F.col("p_brand"))))
    out = graph.glossary_fold(rows)
    return out.select("ord", "term", "definition", *[F.array_join(c, ",").alias(c) for c in ("labels", "aliases", "related_terms")])


# Judgement of pairs, front by front.

#: Pairs within each group of six units: a cycle of three, and a star.
_GROUP_PAIRS = ((0, 1), (1, 2), (2, 0), (3, 4), (3, 5))


@dataclass
class PairJudge(NullProvider):
    """Deletes, rewrites, merges or keeps by the lengths of both contents."""

    def complete(self, prompt, system="", temperature=0.3, max_tokens=4000, json_mode=False):
        found = re.search(r"A = (\S+) \((\d+) characters\): .*?\n(.{0,10}).*\n\nB = (\S+) \((\d+) characters\): .*?\n(.{0,10})", prompt, re.S)
        a, size_a, head_a, b, size_b, head_b = found.groups()
        k = (int(size_a) + int(size_b)) % 5
        answer = [{"action": "delete", "delete_sku": b}, {"action": "rewrite", "rewrite_sku": a, "new_content": f"rewritten {head_a.strip()}"},
                  {"action": "merge", "delete_sku": b, "merged_content": f"merged {head_a.strip()} {head_b.strip()}"}, {"action": "keep"}, {"action": "contradiction"}][k]
        return json.dumps(answer, ensure_ascii=False)


def _judged_sql() -> str:
    """One step a pair over the contents of a group of six; null is deleted or not there."""
    head = lambda c: f"trim(left({c}, 10), ' ' || chr(10))"
    steps = [f"WITH {SKUS}, g AS (SELECT ord // 6 AS g, " + ", ".join(f"max(CASE WHEN ord % 6 = {k} THEN content END) AS c{k}" for k in range(6)) + " FROM skus GROUP BY 1)"]
    last = "g"
    for n, (a, b) in enumerate(_GROUP_PAIRS):
        ca, cb = f"c{a}", f"c{b}"
        steps.append(f"k{n} AS (SELECT *, CASE WHEN {ca} IS NOT NULL AND {cb} IS NOT NULL THEN (length({ca}) + length({cb})) % 5 END AS act FROM {last})")
        steps.append(f"s{n} AS (SELECT * EXCLUDE (act) REPLACE (CASE act WHEN 1 THEN 'rewritten ' || {head(ca)} WHEN 2 THEN 'merged ' || {head(ca)} || ' ' || {head(cb)} ELSE {ca} END AS {ca}, "
                     f"CASE WHEN act IN (0, 2) THEN NULL ELSE {cb} END AS {cb}) FROM k{n})")
        last = f"s{n}"
    rows = " UNION ALL ".join(f"SELECT g * 6 + {k} AS ord, c{k} AS content FROM {last} WHERE c{k} IS NOT NULL" for k in range(6))
    return ",\n".join(steps) + f" SELECT ord, content FROM ({rows})"


@query(_judged_sql())
def dedup_rounds(spark, sf_dir):
    """Units after the judgement of cycles and stars of pairs, each pair after the earlier ones of its units."""
    units = inputs.skus(spark, sf_dir).select("ord", "sku_id", "name", F.lit("").alias("description"), "content").where("content IS NOT NULL")
    pairs = None
    for n, (a, b) in enumerate(_GROUP_PAIRS):
        one = lambda k, s: units.where(F.col("ord") % 6 == k).select(F.floor(F.col("ord") / 6).alias("g"), F.col("sku_id").alias(s))
        these = one(a, "sku_a").join(one(b, "sku_b"), "g").select((F.col("g") * len(_GROUP_PAIRS) + n).cast("long").alias("ord"), "sku_a", "sku_b")
        pairs = these if pairs is None else pairs.unionByName(these)
    kept, _ = judgement.judged(pairs, units, PairJudge())
    return kept.select("ord", "content")


# Scores with resume.

@dataclass
class Scorer(NullProvider):
    """Scores by the length of the name; ``deaf`` to every third unit; finds nothing on the web for ids that end in 5."""

    deaf: bool = False

    def complete(self, prompt, system="", temperature=0.3, max_tokens=4000, json_mode=False):
        number = int(re.search(r"\n\n(?:sku|skill)_(\d+): ", prompt)[1])
        if self.deaf and number % 3 == 0:
            return None
        return json.dumps({"web_confidence": (number % 10) / 10, "source_penalty": 0.25 if number % 2 else "none", "reasoning": "deaf" if self.deaf else "again"})

    def search(self, query, limit=5):
        return None if len(query) % 2 else [{"title": "t", "url": f"https://example.org/{len(query)}", "snippet": query}] * 9


@query(f"""WITH {SKUS}, t AS (SELECT *, ord % 10 / 10.0::DOUBLE AS web, CASE WHEN ord % 2 = 1 THEN 0.25 ELSE 0 END::DOUBLE AS pen, length(concat_ws(' ', coalesce(name, ''), coalesce(description, ''))) % 2 = 0 AS found FROM skus WHERE ord % 4 <> 0 AND content <> '')
SELECT sku_id, round(greatest(0, web - pen), 6) AS confidence, pen AS source_penalty,
CASE WHEN ord % 3 = 0 THEN 'again' ELSE 'deaf' END || CASE WHEN pen > 0 THEN ' [Source penalty: -0.25]' ELSE '' END || CASE WHEN ord % 5 = 0 THEN ' [Source chunk unavailable]' ELSE '' END || CASE WHEN found THEN '' ELSE ' [Web search unavailable]' END AS reasoning,
CASE WHEN found THEN 5 ELSE 0 END AS n_references FROM t""")
def confidence_resume(spark, sf_dir):
    """Scores of units without one, from two runs over one folder: the first provider fails on every third unit, the second is asked for these only."""
    u = inputs.skus(spark, sf_dir)
    units = u.select("sku_id", "name", "description", "content", F.when(F.col("ord") % 5 == 0, "nowhere").otherwise(F.col("source_chunk")).alias("source_chunk"), F.when(F.col("ord") % 4 == 0, 0.9).alias("confidence"))
    chunks = u.select(F.col("source_chunk").alias("chunk_id"), F.concat(F.lit("all of "), "source_chunk").alias("content")).distinct()
    folder = new_folder(spark, "confidence")
    judgement.scored(units, chunks, Scorer(deaf=True), folder, batch=1000, tasks=8)
    out = judgement.scored(units, chunks, Scorer(), folder, batch=1000, tasks=8)
    return out.select("sku_id", F.round("confidence", 6).alias("confidence"), "source_penalty", "reasoning", F.size("web_references").alias("n_references"))


# Windows cut where a model says.

@dataclass
class CutGiver(NullProvider):
    """Cuts behind the first sentence end after 7000 characters, told by the 40 characters before it; says nothing on windows whose length is a multiple of 7, and answers in broken JSON where it is one of 5."""

    def complete(self, prompt, system="", temperature=0.3, max_tokens=4000, json_mode=False):
        window = prompt.split("CONTENT:\n", 1)[1]
        at = window.find(". ", 7000)
        if len(window) % 7 == 0 or at < 0:
            return None
        cut = {"tokens_before": window[at - 38:at + 2], "tokens_after": "", "chunk_title": f"to {at}"}
        whole = json.dumps({"cut_points": [cut]}, ensure_ascii=False)
        return f"```json\n{whole}\n```"


@query("""WITH RECURSIVE w AS (
  SELECT doc_id, 0 AS seq, text AS rest, NULL::VARCHAR AS content, NULL::VARCHAR AS title, false AS ended FROM documents WHERE text <> ''
  UNION ALL SELECT doc_id, seq + 1, CASE WHEN last THEN '' ELSE ltrim(substr(rest, cut + 1), blanks) END, CASE WHEN last THEN rest WHEN asked THEN rtrim(left(rest, cut), blanks) ELSE left(rest, cut) END,
    CASE WHEN last AND seq = 0 THEN doc_id::VARCHAR WHEN asked AND NOT last THEN told ELSE 'Part ' || (seq + 1) END, last OR ltrim(substr(rest, cut + 1), blanks) = '' FROM (
    SELECT *, CASE WHEN asked THEN pos + 39 WHEN para > 100 THEN para + 2 WHEN nl > 100 THEN nl + 1 WHEN dot > 100 THEN dot + 2 WHEN ex > 100 THEN ex + 2 WHEN qu > 100 THEN qu + 2 ELSE length(head) END AS cut FROM (
      SELECT *, hit >= 0 AND length(head) % 7 <> 0 AND pos + 39 >= 100 AS asked, 'to ' || hit AS told,
        CASE WHEN contains(head, chr(10)) THEN length(head) - instr(reverse(head), chr(10)) ELSE -1 END AS nl, CASE WHEN contains(head, chr(10) || chr(10)) THEN length(head) - instr(reverse(head), chr(10) || chr(10)) - 1 ELSE -1 END AS para,
        CASE WHEN contains(head, '. ') THEN length(head) - instr(reverse(head), ' .') - 1 ELSE -1 END AS dot, CASE WHEN contains(head, '! ') THEN length(head) - instr(reverse(head), ' !') - 1 ELSE -1 END AS ex,
        CASE WHEN contains(head, '? ') THEN length(head) - instr(reverse(head), ' ?') - 1 ELSE -1 END AS qu FROM (
        SELECT *, CASE WHEN hit >= 0 THEN instr(rest, substr(head, hit - 37, 40)) END AS pos FROM (
          SELECT *, CASE WHEN instr(substr(head, 7001), '. ') > 0 THEN instr(substr(head, 7001), '. ') + 6999 ELSE -1 END AS hit FROM (
            SELECT doc_id, seq, rest, left(rest, 8000) AS head, greatest(1, length(rest) // 4) <= 2000 AS last, ' ' || chr(10) || chr(9) || chr(13) || chr(11) || chr(12) || chr(133) || chr(160) || chr(8195) AS blanks FROM w WHERE NOT ended AND rest <> '')))))
)
SELECT doc_id, (seq - 1)::INT AS chunk_index, title, content FROM w WHERE content IS NOT NULL""")
def window_cut_requests(spark, sf_dir):
    """Every document cut where a scripted model says, in windows of 2000 tokens."""
    out = segmentation.requested_chunks(table(spark, sf_dir, "documents"), 2000, CutGiver())
    return out.select("doc_id", "chunk_index", "title", "content")


# Buckets of whole classes.

@query(None)
def class_buckets(spark, sf_dir):
    """Parts of one brand in buckets of at most 4000 tokens. Parts are similar by the Jaccard similarity of their name words where they share two or more."""
    p = table(spark, sf_dir, "part").select(F.col("p_partkey").cast("string").alias("sku_id"), F.col("p_partkey").alias("ord"), F.col("p_brand").alias("classification"), F.array_distinct(F.split("p_name", " ")).alias("words"))
    # Parts of the same two or more words are copies; a single word shares no two with anything.
    p = p.withColumn("alike", F.when(F.size("words") > 1, F.array_sort("words")))
    units = p.select("sku_id", "ord", "classification", (F.col("ord") % 40 + 10).cast("long").alias("token_count"), "alike")
    p = p.where("alike IS NOT NULL").groupBy("classification", F.col("alike").alias("words")).agg(F.min("sku_id").alias("sku_id"))
    two = F.flatten(F.transform("words", lambda x: F.transform(F.filter("words", lambda y: y > x), lambda y: F.concat_ws(" ", x, y))))
    post = p.select("classification", "sku_id", "words", F.explode(two).alias("two"))
    side = lambda s: post.select("classification", "two", F.col("sku_id").alias(s), F.col("words").alias(f"w{s}"))
    both = side("a").join(side("b"), ["classification", "two"]).where("a < b").dropDuplicates(["a", "b"])
    common = F.size(F.array_intersect("wa", "wb"))
    pairs = both.select("a", "b", (common / (F.size("wa") + F.size("wb") - common)).alias("similarity"))
    return clustering.buckets(units, pairs, 4000, alike="alike")


# Chunks in order, with what came before in each prompt.

@dataclass
class Reader(NullProvider):
    """Answers by the lengths of what the prompt shows; every fourth chunk's mapping fails."""

    def complete(self, prompt, system="", temperature=0.3, max_tokens=4000, json_mode=False):
        if prompt.startswith("Update the map"):
            number = int(prompt[prompt.rindex("\n\nNew chunk: c") + 14:])
            if number % 4 == 1:
                return None
            lines = prompt.count("\n", prompt.index("\n\nUnits:\n") + 9, prompt.rindex("\n\nMap:\n")) + 1  # counted in place: the list is most of the prompt
            return json.dumps({"mapping_content": f"# {lines} units"})
        if prompt.startswith("Does this chunk"):
            number = int(re.search(r"\n\nChunk c(\d+):\n", prompt)[1])
            return json.dumps({"updated": number % 3 > 0, "notes_content": "n" * (number * 37 % 400 + 1)})
        size = len(prompt.split("\n\nText:\n", 1)[1])
        return json.dumps({"label_paths": [[f"L{size % 7}", "x"], [f"l{size % 7}", "X"]], "glossary": [{"term": f"T{size % 11}"}, {"definition": "no term"}]})


@query(f"""WITH RECURSIVE c AS (SELECT source AS base, doc_id, length(coalesce(text, '')) AS size, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS n FROM documents),
d AS (SELECT *, row_number() OVER (PARTITION BY base, size % 7 ORDER BY doc_id) = 1 AS new_label, row_number() OVER (PARTITION BY base, size % 11 ORDER BY doc_id) = 1 AS new_term FROM c),
f AS (SELECT DISTINCT base, 0::BIGINT AS n, {len(knowledge.FIRST_NOTES["en"])}::BIGINT AS notes, false AS changed, false AS refused FROM c
  UNION ALL SELECT f.base, f.n + 1, CASE WHEN c.doc_id % 3 > 0 AND (2 * (c.doc_id * 37 % 400 + 1) >= f.notes OR f.notes < 100) THEN c.doc_id * 37 % 400 + 1 ELSE f.notes END,
    c.doc_id % 3 > 0 AND (2 * (c.doc_id * 37 % 400 + 1) >= f.notes OR f.notes < 100), c.doc_id % 3 > 0 AND NOT (2 * (c.doc_id * 37 % 400 + 1) >= f.notes OR f.notes < 100)
  FROM f JOIN c ON c.base = f.base AND c.n = f.n + 1)
SELECT d.base, d.doc_id AS place, sum(new_label::INT) OVER w AS n_labels, sum(new_term::INT) OVER w AS n_terms, d.n AS n_units, doc_id % 4 <> 1 AS mapping_changed, f.changed AS notes_changed, f.refused AS notes_refused,
  CASE WHEN doc_id % 4 <> 1 THEN '# ' || d.n || ' units' END AS mapping FROM d JOIN f ON f.base = d.base AND f.n = d.n WINDOW w AS (PARTITION BY d.base ORDER BY d.doc_id)""")
def knowledge_fold(spark, sf_dir):
    """Documents of each source as the chunks of a knowledge base, folded in order by a stateful stream; prompts show the labels, terms, units, mapping and notes so far."""
    name = F.concat(F.lit("c"), "doc_id")
    chunks = table(spark, sf_dir, "documents").select(F.col("source").alias("base"), F.col("doc_id").alias("place"), name.alias("chunk_id"), F.col("text").alias("content"), F.array(F.concat(F.lit("- unit of "), name)).alias("units"))
    arrived = written(chunks, "chunks")  # a folder that a stream can watch
    stream = spark.readStream.schema(arrived.schema).parquet(arrived._written_at)
    log = knowledge.fold_chunks(spark, stream, Reader(), new_folder(spark, "knowledge"))
    return log.select("base", "place", "n_labels", "n_terms", "n_units", "mapping_changed", "notes_changed", "notes_refused", "mapping")


# Pages and addresses.

@dataclass
class PageReader(NullProvider):
    """Reads the length of a page; fails on every page whose length is a multiple of ``fails``."""

    name: str = ""
    fails: int = 0

    def ocr(self, image):
        return None if self.fails and len(image) % self.fails == 0 else f"{self.name} {len(image)}"


@query("""SELECT page_id, CASE WHEN page_id % 2 = 1 THEN 'second ' || strlen(html) WHEN strlen(html) % 3 > 0 THEN 'first ' || strlen(html) END AS text, CASE WHEN page_id % 2 = 0 AND strlen(html) % 3 = 0 THEN 2 ELSE 1 END AS attempts FROM pages""")
def ocr_resume(spark, sf_dir):
    """A run that ended after half of the pages, and the run that goes on: no page is asked for again, not even one that failed twice."""
    pages = table(spark, sf_dir, "pages").select(F.regexp_extract("url", "^https?://([^/?#]*)", 1).alias("doc_id"), F.col("page_id").alias("page"), F.col("html").cast("binary").alias("image"))
    folder = new_folder(spark, "ledger")
    page_ledger(pages.where("page % 2 = 0"), PageReader(name="first", fails=3), folder, batch=500, tasks=8)
    out = page_ledger(pages, PageReader(name="second"), folder, batch=500, tasks=8)
    return out.select(F.col("page").alias("page_id"), "text", "attempts")


def _video(url: str) -> str | None:
    return None if len(url) % 2 else f"transcript of {url}"


def _repository(url: str) -> str:
    if url.endswith(".git"):
        raise RuntimeError("unreachable")
    return f"files of {url}"


@query(f"""WITH {URLS}, r AS (SELECT *, CASE parser WHEN 'youtube' THEN length(url) % 2 = 0 WHEN 'repomix' THEN NOT url LIKE '%.git' WHEN 'firecrawl' THEN true ELSE false END AS ok FROM urls)
SELECT url AS source_path, parser AS parser_used, CASE WHEN ok THEN 'success' ELSE 'failed' END AS status, CASE WHEN ok THEN CASE parser WHEN 'youtube' THEN 'transcript of ' WHEN 'repomix' THEN 'files of ' ELSE 'page ' END || url END AS text,
CASE WHEN NOT ok THEN CASE parser WHEN 'youtube' THEN 'no content' WHEN 'repomix' THEN 'unreachable' ELSE 'no parser plug-in for ' || parser END END AS error_message, CASE WHEN ok OR parser = 'bilibili' THEN 0 ELSE 1 END AS retry_count FROM r""")
def url_stage(spark, sf_dir):
    """Addresses read by the plug-in of their kind, once more where that fails; a kind without a plug-in fails at once."""
    parsers = {"youtube": _video, "repomix": _repository, "firecrawl": lambda url: f"page {url}"}
    out = stages.parse_urls(inputs.urls(spark, sf_dir).select("url"), parsers, pause=0.0005)
    return out.select("source_path", "parser_used", "status", "text", "error_message", "retry_count")


@query("""WITH e AS (SELECT l_orderkey * 8 + l_linenumber AS ord, CASE WHEN l_linenumber % 2 = 0 THEN upper(p_name) ELSE p_name END AS subject, CASE l_returnflag WHEN 'A' THEN 'part-of' WHEN 'N' THEN 'requires' ELSE 'supplied-by' END AS predicate, s_name AS object
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey)
SELECT min(ord) AS ord, arg_min(subject, ord) AS subject, predicate, arg_min(object, ord) AS object FROM e GROUP BY lower(subject), predicate, lower(object)""")
def edge_deltas(spark, sf_dir):
    """Edges that come in seven batches, kept as a log of changes that is compacted on the way."""
    rows = inputs.edges(spark, sf_dir).select("ord", "subject", "predicate", "object", "source_chunks")
    table_ = incremental.Deltas(spark, new_folder(spark, "edges"), graph.edge_upsert, compact=3)
    for k in range(7):
        table_.append(rows.where(F.pmod(F.floor(F.col("ord") / 8), F.lit(7)) == k), k)
    return table_.read().select("ord", "subject", "predicate", "object")


# Chats.

@dataclass
class Drafter(NullProvider):
    """Replies with the number of messages so far; no greeting for sessions whose number ends in 7, no reply to messages of a length that 5 divides."""

    def chat(self, messages, temperature=0.4, max_tokens=8000):
        last = messages[-1]
        if last["role"] == "system":
            return None if last["content"].endswith("7") else "hello"
        if last["content"].startswith("Write the final"):
            return f"Here it is:\n```markdown\n# Spec after {len(messages)} messages\n```\nDone."
        return None if len(last["content"]) % 5 == 0 else f"reply {len(messages)}"


@query("""WITH u AS (SELECT conv_id, turn, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS n, count(*) OVER (PARTITION BY conv_id) AS total FROM conversations WHERE role = 'user'),
s AS (SELECT *, conv_id % 4 = 0 AND n = total AS confirm FROM u WHERE n <= 5), r AS (SELECT conv_id, count(*) FILTER (NOT confirm) AS rounds, count(*) FILTER (NOT confirm AND length(text) % 5 <> 0) AS replies, bool_or(confirm) AS confirmed FROM s GROUP BY conv_id),
c AS (SELECT DISTINCT conv_id FROM conversations)
SELECT c.conv_id AS session_id, CASE WHEN c.conv_id % 10 = 7 THEN 0 ELSE coalesce(rounds, 0) END::INT AS rounds_used, c.conv_id % 10 <> 7 AND coalesce(confirmed, false) AS confirmed,
CASE WHEN c.conv_id % 10 = 7 THEN '' ELSE '# Spec after ' || (3 + coalesce(rounds, 0) + coalesce(replies, 0)) || ' messages' END AS spec FROM c LEFT JOIN r USING (conv_id)""")
def spec_chat(spark, sf_dir):
    """Conversations as specification chats with a scripted model, up to the final text."""
    said = inputs.chat_messages(spark, sf_dir)
    sessions = said.select("session_id").distinct().withColumn("system_prompt", F.concat(F.lit("Session "), "session_id"))
    return chat.spec_sessions(sessions, said, Drafter()).select("session_id", "rounds_used", "confirmed", "spec")


@query("""WITH t AS (SELECT p_partkey * 2 AS ord, '{"term":"T' || p_partkey || '","definition":"' || p_type || '","labels":["' || p_brand || '"],"source_chunks":["c1"],"aliases":[],"related_terms":[]}' AS line FROM part),
l AS (SELECT '{"path":["' || p_type || '","' || p_brand || '"]}' AS line FROM part GROUP BY p_type, p_brand), e AS (SELECT '{"subject":"T' || p_partkey || '","predicate":"is-a","object":"' || p_type || '","source_chunks":["' || p_brand || '"]}' AS line FROM part),
a AS (SELECT line FROM t UNION ALL SELECT line FROM l UNION ALL SELECT line FROM e)
SELECT sum(length(line) + 1)::BIGINT AS character_count, '# relational-knowledge' || chr(10) || chr(10) || '- **Classification**: relational' || chr(10) || '- **Source**: aggregated' || chr(10) || '- **Characters**: ' || format('{:,}', sum(length(line) + 1)::BIGINT) AS head FROM a""")
def relational_files(spark, sf_dir):
    """All characters of label paths, edges and glossary as files, and how their header begins."""
    p = table(spark, sf_dir, "part")
    none, tag = F.expr("cast(array() as array<string>)"), F.concat(F.lit("T"), "p_partkey")
    glossary = graph.glossary_upsert(p.select((F.col("p_partkey") * 2).cast("long").alias("ord"), tag.alias("term"), F.col("p_type").alias("definition"), F.array("p_brand").alias("labels"), F.array(F.lit("c1")).alias("source_chunks"), none.alias("aliases"), none.alias("related_terms")))
    edges = graph.edge_upsert(p.select(F.col("p_partkey").alias("ord"), tag.alias("subject"), F.lit("is-a").alias("predicate"), F.col("p_type").alias("object"), F.array("p_brand").alias("source_chunks")))
    labels = graph.leaf_paths(graph.label_nodes(inputs.part_paths(spark, sf_dir)))
    out = resolution.relational_header(resolution.relational_lines(labels, edges, glossary))
    return out.select("character_count", F.array_join(F.slice(F.split("header", "\n"), 1, 5), "\n").alias("head"))


@query("""WITH t AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS no, trim(replace(text, chr(10), ' '), ' ') AS line FROM conversations)
SELECT conv_id AS video_id, line AS text, no + 0.25::DOUBLE AS start FROM t WHERE line <> ''""")
def structured_segments(spark, sf_dir):
    """Segments of subtitles in the three JSON forms and in XML, made of the turns of conversations."""
    no = F.row_number().over(Window.partitionBy("conv_id").orderBy("turn")) - 1
    rows = table(spark, sf_dir, "conversations").select("conv_id", no.alias("no"), F.trim(F.replace("text", F.lit("\n"), F.lit(" "))).alias("line"))
    start, kind = F.col("no") + F.lit(0.25), F.col("conv_id") % 4
    plain = F.replace(F.replace("line", F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))
    piece = (F.when(kind == 0, F.to_json(F.struct((F.col("no") * 1000 + 250).alias("tStartMs"), F.array(F.struct(F.col("line").alias("utf8"))).alias("segs"))))
             .when(kind == 1, F.to_json(F.struct(F.col("line").alias("content"), start.alias("from")))).when(kind == 2, F.to_json(F.struct(F.col("line").alias("text"), start.alias("start"))))
             .otherwise(F.concat(F.lit('<p t="'), F.col("no") * 1000 + 250, F.lit('">'), plain, F.lit("</p>"))))
    whole = rows.groupBy("conv_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("no", piece.alias("p")))), lambda r: r["p"]).alias("p"))  # a transcript
    inner = F.when(kind == 3, F.array_join("p", "")).otherwise(F.array_join("p", ","))
    data = (F.when(kind == 0, F.concat(F.lit('{"events":['), inner, F.lit("]}"))).when(kind == 1, F.concat(F.lit('{"body":['), inner, F.lit("]}"))).when(kind == 2, F.concat(F.lit("["), inner, F.lit("]")))
            .otherwise(F.concat(F.lit("<timedtext><body>"), inner, F.lit("</body></timedtext>"))))
    ext = F.element_at(F.array(*[F.lit(x) for x in ("json3", "json", "json", "srv3")]), (kind + 1).cast("int"))
    out = whole.select(F.col("conv_id").alias("video_id"), F.explode(subtitles.structured_segments(data, ext)).alias("s"))
    return out.select("video_id", "s.text", "s.start")
