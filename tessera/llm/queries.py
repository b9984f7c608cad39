"""The registered queries of the training-data operators: name -> (spark, sf_dir) -> DataFrame, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

WHITE = "[\\x20\\x09-\\x0D]+"
WORD = "[^\\x20\\x09-\\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessera.llm.minhash_dedup import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"), percent=85)


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessera.llm.exact_dedup import exact_duplicates

    out = exact_duplicates(spark, f"{sf_dir}/documents.parquet")
    return out.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op3_hilbert_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessera.llm.hilbert_sharding import hilbert_shards, measured

    docs = measured(table(spark, sf_dir, "documents")).select("doc_id", "lang", "source", "size", "text_crc32")
    placed = hilbert_shards(docs, shards=8)
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "curve")


def op4_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessera.llm.decontamination import benchmark_hits

    hits = benchmark_hits(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), width=10)
    return hits.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                       F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
                       F.size("spans").cast("long").alias("n_spans"))


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessera.llm.substring_dedup import repeated_spans

    out = repeated_spans(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_chars", "n_chunks", "n_repeated", "n_removed", (F.col("n_removed") > 0).alias("has_repeat"),
                      F.transform("spans", lambda s: s["start"]).alias("span_starts"), F.transform("spans", lambda s: s["end"]).alias("span_ends"))


def op6_weighted_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessera.llm.mixing import fair_mix, word_count

    docs = table(spark, sf_dir, "documents").select("doc_id", "source", word_count(F.col("text")).alias("size"))
    return fair_mix(docs, weights=(5, 2, 1), repeats=3, share=1.0).select("doc_id", "size", "source_size", "target", "taken")


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessera.llm.quality import quality_scores

    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), max_fit_rows=6000)


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessera.llm.language_id import language_columns

    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    out = language_columns(docs, host=F.col("source"), keep_text=False)
    return out.select("doc_id", F.col("lang").alias("declared"), "language", "text_language", "posterior", F.col("accepted").alias("kept"))


def op9_chat_perspectives(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessera.llm.chat_format import perspectives

    return perspectives(table(spark, sf_dir, "conversations"))


def op10_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessera.llm.html_extract import main_texts

    return main_texts(table(spark, sf_dir, "pages"))


def op11_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessera.llm.prefix_trie import prefix_trie, spliced_prefixes

    return prefix_trie(*spliced_prefixes(table(spark, sf_dir, "conversations"), every=5, most=9))


def op12_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessera.llm.simhash_dedup import simhash_components

    return simhash_components(table(spark, sf_dir, "documents"), bits=4, width=4)


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessera.llm.fill_in_middle import fill_in_middle, restored

    out = fill_in_middle(table(spark, sf_dir, "documents").select("doc_id", "text"), fim_percent=90, spm_percent=20)
    return out.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                      F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"))


QUERIES = {f.__name__: f for f in (op1_minhash_near_dedup, op2_exact_dedup, op3_hilbert_sharding, op4_benchmark_decontamination, op5_substring_dedup, op6_weighted_mixing,
                                 op7_quality_classifier, op8_language_id, op9_chat_perspectives, op10_html_extraction,
                                 op11_conversation_trie, op12_simhash_near_dedup, op13_fill_in_middle)}

ORACLES = {
    "op2_exact_dedup": rf"""
WITH d AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '{WHITE}', ' ', 'g')) AS h FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY h) AS keep_id, count(*) OVER (PARTITION BY h) AS group_size,
       doc_id = min(doc_id) OVER (PARTITION BY h) AS kept, h AS text_sha256
FROM d""",
    "op9_chat_perspectives": r"""
WITH base AS (SELECT conv_id, turn, coalesce(role, 'unknown') AS role, replace(coalesce(text, ''), '<|', '< |') AS text FROM conversations),
sp AS (SELECT DISTINCT conv_id, role AS perspective FROM base WHERE role <> 'system'),
r AS (SELECT base.*, perspective,
        '<|im_start|>' || CASE WHEN role = 'system' THEN 'system' WHEN role = perspective THEN 'assistant' ELSE 'user name=' || replace(regexp_replace(role, '[\x00-\x1F]+', ' ', 'g'), '<|', '< |') END || chr(10) AS head
      FROM base JOIN sp ON base.conv_id IS NOT DISTINCT FROM sp.conv_id),
s AS (SELECT *, head || text || '<|im_end|>' || chr(10) AS segment FROM r),
o AS (SELECT *, sum(length(segment)) OVER (PARTITION BY conv_id, perspective ORDER BY turn, role, text ROWS UNBOUNDED PRECEDING)::BIGINT AS char_end FROM s)
SELECT conv_id, perspective, turn, role, segment, char_end - length(segment) AS char_start, char_end,
       CASE WHEN role = perspective THEN char_end - length(segment) + length(head) END AS target_start,
       CASE WHEN role = perspective THEN char_end END AS target_end
FROM o""",
    # crc32 bit by bit over the decimal digits; a node is the list of its turns; a node's ancestors are the prefixes of its smallest member.
    "op11_conversation_trie": r"""
WITH t AS (SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
                  row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) - 1 AS p
           FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT c, count(*) AS n, c - c % 5 AS base FROM t GROUP BY c),
h AS (SELECT c, n, base, xor(list_reduce(list_transform(range(8 * length(c::VARCHAR)), lambda i: CASE WHEN i % 8 = 0 THEN ascii(substr(c::VARCHAR, (i // 8 + 1)::INT, 1))::BIGINT ELSE 0 END),
        lambda x, e: xor(xor(x, e) >> 1, 3988292384 * (xor(x, e) & 1)), 4294967295::BIGINT), 4294967295) AS raw FROM c),
-- each step above takes a byte in before its first shift, so eight steps a byte end with the register itself
m AS (SELECT h.c, h.n, h.base, h.raw % 9 AS h, least(h.raw % 9, coalesce(b.n, 0)) AS lent FROM h LEFT JOIN c b ON b.c = h.base),
r AS (SELECT m.c, t.p + 1 AS d, role, text FROM m JOIN t ON t.c = m.base AND t.p < m.h
      UNION ALL SELECT m.c, t.p - m.h + m.lent + 1, role, text FROM m JOIN t ON t.c = m.c AND t.p >= m.h),
x AS (SELECT c, d, list(struct_pack(role := role, text := text)) OVER (PARTITION BY c ORDER BY d) AS k, strlen(text) AS size FROM r),
l AS (SELECT m.c, coalesce(max(x.d), 0) AS len FROM m LEFT JOIN x USING (c) GROUP BY m.c),
p AS (SELECT c, d, k, size FROM x UNION ALL SELECT c, 0, [], 0 FROM m),
nodes AS (SELECT k, p.d, min(p.c) AS c, count(*) AS n, (count(*) - 1) * any_value(size) AS own,
                 coalesce(string_agg(CASE WHEN l.len = p.d THEN p.c::VARCHAR END, ',' ORDER BY p.c), '') AS ends
          FROM p JOIN l ON l.c = p.c GROUP BY k, p.d),
kids AS (SELECT up.k, count(*) AS n FROM nodes JOIN p up ON up.c = nodes.c AND up.d = nodes.d - 1 GROUP BY up.k),
sums AS (SELECT up.k, sum(nodes.own) AS saved, count(*) FILTER (WHERE kids.n IS NULL) AS leaves
         FROM nodes LEFT JOIN kids ON kids.k = nodes.k JOIN p up ON up.c = nodes.c AND up.d <= nodes.d GROUP BY up.k)
SELECT nodes.c AS conv_id, nodes.d::BIGINT AS depth, par.c AS parent_conv_id, nodes.n AS n_convs, coalesce(kids.n, 0) AS n_children, sums.leaves AS n_leaves,
       sums.saved::BIGINT AS saved_tokens, sha256(nodes.ends) AS ends_sha256
FROM nodes JOIN sums ON sums.k = nodes.k LEFT JOIN kids ON kids.k = nodes.k
LEFT JOIN p up ON up.c = nodes.c AND up.d = nodes.d - 1 LEFT JOIN nodes par ON par.k = up.k""",
    "op13_fill_in_middle": r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, ''))::BIGINT AS n, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS s FROM documents),
h AS (SELECT *, ('0x' || substr(s, 1, 8))::BIGINT AS h1, ('0x' || substr(s, 9, 8))::BIGINT AS h2, ('0x' || substr(s, 17, 8))::BIGINT AS h3, ('0x' || substr(s, 25, 8))::BIGINT AS h4 FROM d),
f AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
        CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM h),
o AS (SELECT *, substr(t, 1, a) AS pre, substr(t, a + 1, b - a) AS mid, substr(t, b + 1, n - b) AS suf FROM f)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
       sha256(CASE form WHEN 'plain' THEN t ELSE pre || mid || suf END) AS restored_sha256
FROM o""",
}
