"""Duplicate scan and judgement, and confidence scoring, as runs of model requests that can be started again.

**Wavefront.** Judgements of pairs depend on each other: a unit that an earlier pair deleted is judged no more, and one that was rewritten is judged as rewritten. A pair is ready when it is the first
open pair of both its units. All ready pairs share no unit, so they are asked together, in parallel over all buckets, and what they change is applied before the next front. That is exactly the
result of one pair after another; there are as many fronts as the longest chain of pairs that hang together, not as many as there are pairs.

**Durable steps.** The answers of each front and the scores of each batch are tables in the run's folder. A run that is started again over the same folder reads them instead of asking.

Units are (sku_id, name, description, content, ...); a unit's bucket is bounded by its token limit, so a batch of headers is small.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.config import DEFAULTS, Settings
from tessera.durable import exists, new_folder, table_at
from tessera.operators import prompts, resolution
from tessera.operators.numbering import in_batches, numbered_globally
from tessera.sources import providers
from tessera.sources.providers import Provider

_PAIR = "sku_a string, sku_b string, reason string"


def flagged(members: DataFrame, provider: Provider, settings: Settings = DEFAULTS) -> DataFrame:
    """Pairs (bucket_id, ord, sku_a, sku_b, reason) that the provider flags in the headers of each bucket of two units or more; ``members``: bucket_id, sku_id, ord, name, description.

    ``ord`` numbers pairs by bucket, batch and place in the answer. Batches whose answer fails flag nothing; so do entries without two ids.
    """
    batches = resolution.scan_batches(members, settings.scan_batch)
    lines = F.array_sort(F.collect_list(F.struct("ord", prompts.pair_headers().alias("line"))))
    asked = batches.groupBy("bucket_id", "batch").agg(F.array_join(F.transform(lines, lambda x: x["line"]), "\n").alias("headers"))  # a batch has scan_batch lines at most
    asked = asked.select(F.struct("bucket_id", "batch").alias("key"), prompts.rendered("scan", {"headers": F.col("headers")}, settings.language).alias("prompt"))
    got = providers.answers(asked, provider, "key", "prompt", temperature=0.2)
    rows = got.select("key.bucket_id", "key.batch", F.posexplode(prompts.flagged_pairs(F.col("answer"))).alias("place", "p")).select("bucket_id", "batch", "place", "p.*")
    return numbered_globally(rows, ["bucket_id", "batch", "place"], "ord", 0).select("bucket_id", "ord", "sku_a", "sku_b", F.coalesce("reason", F.lit("")).alias("reason"))


def _text(value: Column, path: str) -> Column:
    """A field of an answer: a string as it is, a list or object as JSON, else null."""
    field = F.try_variant_get(value, path, "variant")
    kind = F.schema_of_variant(field)
    return F.when(kind == "STRING", F.try_variant_get(value, path, "string")).when(kind.rlike("^(ARRAY|OBJECT)"), F.to_json(field))


def actions_of(answered: DataFrame) -> DataFrame:
    """Actions (ord, sku_a, sku_b, action, detail, deleted_skus, rewritten_skus, new_content, merged_content) of judged pairs (ord, sku_a, sku_b, answer: JSON text as from :func:`providers.answers`). Unknown
    actions are ``keep``; a pair without an answer, or whose answer is no object or an empty one, has no action."""
    rows = answered.where("answer LIKE '{%' AND answer <> '{}'").withColumn("_v", F.try_parse_json("answer"))
    field = lambda name: _text(F.col("_v"), "$." + name)
    listed = lambda name: F.when(F.length(field(name)) > 0, F.array(field(name))).otherwise(F.expr("cast(array() as array<string>)"))
    return rows.select("ord", "sku_a", "sku_b", resolution.known_action(F.coalesce(field("action"), F.lit("keep"))).alias("action"), F.coalesce(field("reasoning"), F.lit("")).alias("detail"),
                       listed("delete_sku").alias("deleted_skus"), listed("rewrite_sku").alias("rewritten_skus"), field("new_content").alias("new_content"), field("merged_content").alias("merged_content"))


def current(units: DataFrame, changes: DataFrame | None) -> DataFrame:
    """``units`` after ``changes`` (sku_id, op, content, ord): without the deleted ones, with the last content written."""
    if changes is None:
        return units
    last = changes.groupBy("sku_id").agg(F.max(F.when(F.col("op") == "delete", 1).otherwise(0)).alias("_gone"), F.max_by(F.when(F.col("op") == "write", F.col("content")), F.when(F.col("op") == "write", F.col("ord"))).alias("_new"))
    return units.join(last, "sku_id", "left").where("coalesce(_gone, 0) = 0").withColumn("content", F.coalesce("_new", "content")).drop("_gone", "_new")


def ready(pairs: DataFrame) -> DataFrame:
    """The pairs (ord, sku_a, sku_b) that are the first of both their units."""
    ends = pairs.select("ord", F.explode(F.array("sku_a", "sku_b")).alias("sku_id"))
    first = ends.groupBy("sku_id").agg(F.min("ord").alias("ord"))
    met = ends.distinct().join(first, ["sku_id", "ord"], "left_semi").groupBy("ord").agg(F.count(F.lit(1)).alias("n"))
    return pairs.join(met, "ord").where(F.col("n") == F.when(F.col("sku_a") == F.col("sku_b"), 1).otherwise(2)).drop("n")


def judged(pairs: DataFrame, units: DataFrame, provider: Provider, folder: str | None = None, settings: Settings = DEFAULTS) -> tuple[DataFrame, DataFrame]:
    """(units after all judgements, actions in order) of flagged ``pairs`` (ord, sku_a, sku_b).

    A pair of which a unit has no content, or has been deleted, is passed over. ``folder``: where the fronts lie; given again, its answers are not asked for again.
    """
    folder = folder or new_folder(units.sparkSession, "fronts")
    left = table_at(pairs.select("ord", "sku_a", "sku_b"), f"{folder}/pairs")
    units_ = units.select("sku_id", "name", "description", "content")
    changes, actions, front = None, None, 0
    while True:
        now = current(units_, changes).where("content IS NOT NULL")
        ids = now.select("sku_id")
        left = left.join(ids.withColumnRenamed("sku_id", "sku_a"), "sku_a", "left_semi").join(ids.withColumnRenamed("sku_id", "sku_b"), "sku_b", "left_semi")
        left = table_at(left.select("ord", "sku_a", "sku_b"), f"{folder}/open-{front}")
        if left.isEmpty():
            break
        asked = ready(left)
        for side in ("a", "b"):
            asked = asked.join(now.select(*[F.col(c).alias(f"{c}_{side}" if c != "sku_id" else f"sku_{side}") for c in now.columns]), f"sku_{side}")
        values = {f"{k}_{s}": F.col(f"{k}_{s}") for s in ("a", "b") for k in ("name", "description", "content")} | {f"id_{s}": F.col(f"sku_{s}") for s in ("a", "b")}
        values |= {f"chars_{s}": F.length(f"content_{s}").cast("string") for s in ("a", "b")}
        asked = asked.select(F.struct("ord", "sku_a", "sku_b").alias("key"), prompts.rendered("judge", values, settings.language).alias("prompt"))
        got = table_at(providers.answers(asked, provider, "key", "prompt").select("key.ord", "key.sku_a", "key.sku_b", "answer"), f"{folder}/answers-{front}")
        done = actions_of(got.where("answer IS NOT NULL"))
        actions = done if actions is None else actions.unionByName(done)
        made = resolution.effects(done)
        changes = made if changes is None else changes.unionByName(made)
        changes = table_at(changes, f"{folder}/changes-{front}")
        left = left.join(got.select("ord"), "ord", "left_anti")
        front += 1
    kept = current(units, changes)
    if actions is None:
        none = units.sparkSession.createDataFrame([], f"ord long, {_PAIR.rsplit(',', 1)[0]}, answer string")
        actions = actions_of(none)
    return kept, actions


def deduplicated(members: DataFrame, units: DataFrame, provider: Provider, folder: str | None = None, settings: Settings = DEFAULTS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(units that stay, actions, report): scan of headers, check that both ids are of the bucket, judgement of what is left. The report has one row: buckets_scanned, pairs_flagged and the counters."""
    folder = folder or new_folder(units.sparkSession, "dedup")
    pairs = table_at(flagged(members, provider, settings), f"{folder}/flagged")
    kept, actions = judged(resolution.valid_pairs(pairs, members), units, provider, f"{folder}/fronts", settings)
    scanned = members.groupBy("bucket_id").agg(F.count(F.lit(1)).alias("n")).agg(F.count_if(F.col("n") > 1).alias("buckets_scanned"))
    report = scanned.crossJoin(pairs.agg(F.count(F.lit(1)).alias("pairs_flagged"))).crossJoin(resolution.dedup_report(actions))  # one row each
    return kept, actions, report


def scored(units: DataFrame, chunks: DataFrame, provider: Provider, folder: str, settings: Settings = DEFAULTS, batch: int = 10, tasks: int = 64) -> DataFrame:
    """Scores (sku_id, confidence, source_penalty, reasoning, web_references) of units (sku_id, name, description, content, source_chunk, confidence) that have none yet.

    ``folder`` keeps the scores: a unit that has one there, or a confidence of its own, is never asked about again; one whose request fails, or without content, is asked for in the next run. A batch is
    ``batch`` units for each of ``tasks`` parallel tasks and one table, written as a whole: a run that ends in the middle loses that batch at most. ``chunks``:
    chunk_id, content.
    """
    spark = units.sparkSession
    kept = scores_at(spark, folder)
    open_ = units.where("sku_id IS NOT NULL AND confidence IS NULL AND coalesce(content, '') <> ''").join(kept.select("sku_id"), "sku_id", "left_anti")
    open_ = open_.select("sku_id", "name", "description", "content", "source_chunk")
    sources = resolution.source_lookup(open_.select("sku_id", "source_chunk"), chunks).drop("source_chunk")
    in_batches(open_.join(sources, "sku_id", "left"), ["sku_id"], lambda part: _scores(part, provider, settings), f"{folder}/scores", batch, tasks)
    return scores_at(spark, folder)


_SCORE = "sku_id string, confidence double, source_penalty double, reasoning string, web_references array<string>"


def scores_at(spark, folder: str) -> DataFrame:
    """All scores of a folder; of a unit that was scored twice (a batch that was cut off and run again) one."""
    if not exists(spark, f"{folder}/scores"):
        return spark.createDataFrame([], _SCORE)
    return spark.read.schema(_SCORE).option("recursiveFileLookup", "true").parquet(f"{folder}/scores").dropDuplicates(["sku_id"])


def _scores(part: DataFrame, provider: Provider, settings: Settings) -> DataFrame:
    # The whole unit is the key of its search, so that its results need no join.
    query = F.concat_ws(" ", F.coalesce("name", F.lit("")), F.coalesce("description", F.lit("")))
    rows = providers.searched(part.select(F.struct(*part.columns).alias("unit"), query.alias("query")), provider, "unit", "query").select("unit.*", "results")
    web = F.when(F.col("results").isNull(), "(Web search unavailable)").otherwise(providers.web_results_text(F.col("results")))
    source = F.coalesce("source_text", F.lit("(Original source chunk not available)"))
    values = {"id": F.col("sku_id"), "name": F.col("name"), "description": F.col("description"), "content": F.col("content"), "source_chunk": source, "web_results": web}
    urls = F.filter(F.transform(F.coalesce("results", F.expr(f"cast(array() as {providers.RESULTS})")), lambda r: r["url"]), lambda u: F.length(u) > 0)
    keyed = rows.select(F.struct("sku_id", F.col("results").isNotNull().alias("web"), F.col("source_text").isNotNull().alias("source"), urls.alias("urls")).alias("key"),
                        prompts.rendered("proofread", values, settings.language).alias("prompt"))
    got = providers.answers(keyed, provider, "key", "prompt", temperature=0.1).where("answer IS NOT NULL").withColumn("_v", F.try_parse_json("answer")).where("_v IS NOT NULL")

    def number(name: str, other: float) -> Column:
        """A number; ``other`` where the key holds something else, null where it is not there."""
        field = F.try_variant_get(F.col("_v"), "$." + name, "variant")
        is_number = F.schema_of_variant(field).rlike("^(BIGINT|DOUBLE|FLOAT|DECIMAL|BOOLEAN)")
        return F.when(is_number, F.try_variant_get(F.col("_v"), "$." + name, "double")).when(field.isNotNull(), F.lit(other))

    value, penalty = resolution.confidence(number("web_confidence", 0.5), number("confidence", 0.5), number("source_penalty", 0.0))
    why = resolution.reasoning(F.try_variant_get(F.col("_v"), "$.reasoning", "string"), penalty, F.col("key.source"), F.col("key.web"))
    return got.select("key.sku_id", value.alias("confidence"), penalty.alias("source_penalty"), why.alias("reasoning"), F.col("key.urls").alias("web_references"))
