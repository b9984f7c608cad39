"""A corpus pipeline over ``documents``: language, near duplicates, benchmark passages, source mix, shards.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the docs
of the next one. All but the last return the columns of ``documents``. A doc_id names a document.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import discard, fresh, scratch, with_hits, written
from tessera.llm.decontamination import decontaminated
from tessera.llm.hilbert_sharding import hilbert_shards, measured
from tessera.llm.language_id import language_columns
from tessera.llm.minhash_dedup import near_duplicates
from tessera.llm.mixing import fair_mix, word_count

#: No SQL: sketches, the automaton, seeded places and the curve are not expressible; tests hold the rows against brute force.
ORACLE_SQL = None


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text is in one of the known languages; text without a letter goes."""
    return language_columns(docs, host=F.col("source")).where("accepted").select(*docs.columns)


def _one_of_each(docs: DataFrame, keys: list[F.Column], wanted: DataFrame, times: str | None = None) -> DataFrame:
    """One row (the least) of ``docs`` for each key of ``wanted`` (its first columns), ``times`` over where given. For keys that several rows share: a hot key is one row a task."""
    names = fresh(docs, *[f"_k{i}" for i in range(len(keys))], "_row", "_times", "_copy")
    ids, row, many, copy = names[:-3], *names[-3:]
    rows = docs.withColumns(dict(zip(ids, keys, strict=True)))
    sought = wanted.select(*[F.col(c).alias(k) for c, k in zip(wanted.columns, ids, strict=False)], F.col(times).cast("int").alias(many) if times else F.lit(1).alias(many))
    on = [rows[k].eqNullSafe(sought[k]) for k in ids]
    found = rows.join(sought, on).groupBy(*[rows[k] for k in ids]).agg(F.min(F.struct(*[rows[c] for c in docs.columns])).alias(row), F.max(many).alias(many))
    return found.where(F.col(many) > 0).select(F.col(row), F.explode(F.sequence(F.lit(1), F.col(many))).alias(copy)).select(F.col(row + ".*"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of similar documents (0.85 or more on five-word shingles): the smallest doc_id. Where several rows have it, that of the smallest text hash stays, once."""
    found = written(near_duplicates(docs, prints=True).where("doc_id IS NOT NULL"), "near")
    stays = found.where("kept AND component IS NOT NULL").groupBy("component", "doc_id").agg(F.min("print").alias("first"), F.count(F.lit(1)).alias("n"))
    shared = written(stays.where("n > 1").select("doc_id", "first", "component"), "shared")  # components in which several rows stay
    others = found.where("kept").join(shared, ["component", "doc_id"]).where("print <> first").select("doc_id", "print")
    shared = shared.select("doc_id", "first")
    gone = written(found.where("NOT kept").select("doc_id", "print").union(others).distinct(), "gone")
    # Texts that are certainly kept are not dealt out: only those whose hash may be in the lists meet them.
    printed, hit = fresh(docs, "_print", "_hit")
    named = gone.union(shared)
    rows = with_hits(docs.withColumn(printed, F.xxhash64(docs["text"].cast("string"))), named.select(F.col("print").alias(printed)), printed, hit)
    sure, maybe = (rows.where(c).drop(hit) for c in (~F.col(hit), F.col(hit)))
    left = maybe.join(named.hint("merge"), maybe["doc_id"].eqNullSafe(named["doc_id"]) & (maybe[printed] == named["print"]), "left_anti").select(*[maybe[c] for c in docs.columns])
    once = _one_of_each(maybe, [maybe["doc_id"], maybe[printed]], shared).drop(printed)
    return sure.select(*docs.columns).unionByName(left).unionByName(once)


def drop_benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any ten-word window of a benchmark item."""
    return decontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it (0 to 3 times), weights 5, 2, 1 repeating over the sources."""
    mark = F.xxhash64(*[docs[c] for c in docs.columns])  # rows that are equal throughout are taken together
    sizes = docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), mark.alias("mark"))
    took = fair_mix(sizes).groupBy("doc_id", "mark").agg(F.sum("runs").alias("runs"), F.count(F.lit(1)).alias("rows"))
    took = written(took.where("runs > 0"), "runs")
    key, marked, times, run = fresh(docs, "_id", "_mark", "_runs", "_run")
    once = took.where("rows = 1").select(F.col("doc_id").alias(key), F.col("mark").alias(marked), F.col("runs").cast("int").alias(times))
    rows = docs.join(once.hint("merge"), docs["doc_id"].eqNullSafe(F.col(key)) & (mark == F.col(marked)))
    rows = rows.withColumn(run, F.explode(F.sequence(F.lit(1), F.col(times)))).select(*[docs[c] for c in docs.columns])
    several = written(took.where("rows > 1").select("doc_id", "mark", "runs"), "several")
    return rows.unionByName(_one_of_each(docs, [docs["doc_id"], mark], several, "runs"))


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rows with their place: curve, shard (0 to 7) and slot; plus size and text_crc32. These replace columns of their names."""
    return hilbert_shards(measured(docs), shards=8)


STAGES = [
    ("language ID", identify_language),
    ("MinHash near-dedup", drop_near_duplicates),
    ("benchmark decontamination", drop_benchmark_passages),
    ("mixing sources", mix_sources),
    ("sharding", shard),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    last = None
    for name, stage in STAGES[:-1]:
        with scratch() as keep:  # a stage's own tables go when its result is written, and so does what it read
            docs = keep(written(stage(spark, docs, sf_dir), name.split()[0]))
        if last is not None:
            discard(last)
        last = docs
    return STAGES[-1][1](spark, docs, sf_dir)
