"""Knowledge that the next chunk's prompt reads: a keyed state machine over chunks in order.

A knowledge base (``base``) is a key. Its chunks are taken one after another, as each prompt shows what the chunks before it gave: known label paths, terms and units, the mapping and the notes. Bases run in parallel. The state
of a base lives in the state store of a stateful stream, so a run that stops goes on with the chunk after its last batch; chunks that were taken already are passed over. What a chunk did is a
row of a replay log: folding the log again gives the state without asking anyone.

A request that fails leaves what it would have changed and does not keep the others from running. New notes replace the old ones only if they don't shrink them to less than half (notes under 100 characters may
shrink); the mapping is replaced by any text that is not empty.

Defined results: a null content is the empty text; of the chunks of one place the first by id and content is taken; a chunk at or before the last place taken is passed over, so repeated rows change nothing. Memory of a task: one base's state and the rows of a
batch that belong to it.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tessera.config import DEFAULTS, Settings
from tessera.operators.prompts import BUDGETS, template
from tessera.sources.providers import Provider, complete_json

CHUNKS = "base string, place long, chunk_id string, content string, units array<string>"
LOG = ("base string, place long, chunk_id string, n_labels long, n_terms long, n_units long, mapping_changed boolean, notes_changed boolean, notes_refused boolean, "
       "mapping string, notes string, new_labels array<string>, new_terms array<string>, new_units array<string>")

#: How both files begin, by language.
FIRST_MAPPING = {"en": "# Map of knowledge units\n\n---\n\n*Nothing mapped yet.*\n", "zh": "# 知识单元地图\n\n---\n\n*尚无内容。*\n"}
FIRST_NOTES = {"en": "# Notes\n\n---\n\n*No notes yet.*\n", "zh": "# 笔记\n\n---\n\n*尚无笔记。*\n"}
_NO_UNITS = {"en": "*No units yet.*", "zh": "*尚无单元。*"}


def first_state(language: str = "en") -> dict[str, Any]:
    return {"place": None, "labels": [], "terms": [], "units": [], "listed": "", "mapping": FIRST_MAPPING[language], "notes": FIRST_NOTES[language]}


def notes_fit(old: str, new: str) -> bool:
    return 2 * len(new) >= len(old) or len(old) < 100


def _asked(provider: Provider, key: str, values: dict[str, str], settings: Settings, **options) -> dict:
    """The answer to a prompt as a dictionary, empty where it fails in any way."""
    pieces = re.split(r"\{(\w+)\}", template(key, settings.language))  # text and names in turn, so that braces within a value stay as they are
    prompt = "".join(values[x] if k % 2 else x for k, x in enumerate(pieces))
    try:
        got = complete_json(provider, prompt, retries=settings.json_retries, **options)
    except Exception:  # noqa: BLE001  (one request that fails does not end the chunk)
        return {}
    return got if isinstance(got, dict) else {}


def taken(state: dict[str, Any], place: int, chunk_id: str, content: str, units: list[str], provider: Provider, settings: Settings = DEFAULTS) -> dict[str, Any]:
    """What a chunk gives on top of a state, as an entry of the log."""
    relations = _asked(provider, "relations", {"labels": "\n".join(state["labels"]), "terms": ", ".join(state["terms"]), "content": content}, settings, max_tokens=8000)
    paths = [" / ".join(map(str, p)) for p in relations.get("label_paths") or [] if isinstance(p, list) and p]
    terms = [str(g["term"]) for g in relations.get("glossary") or [] if isinstance(g, dict) and g.get("term")]
    known = {x.lower() for x in state["labels"]}, {x.lower() for x in state["terms"]}
    new = [[x for x in {v.lower(): v for v in reversed(found)}.values() if x.lower() not in old][::-1] for found, old in zip((paths, terms), known, strict=True)]
    entry = {"place": place, "chunk_id": chunk_id, "new_labels": new[0], "new_terms": new[1], "new_units": list(units), "mapping": None, "notes": None, "notes_refused": False}
    listed = "\n".join([state["listed"], *units] if state["listed"] else units) or _NO_UNITS[settings.language]
    mapping = _asked(provider, "mapping", {"unit_list": listed, "mapping": state["mapping"], "chunk_id": chunk_id}, settings, temperature=0.2, max_tokens=8000).get("mapping_content")
    if isinstance(mapping, str) and mapping:
        entry["mapping"] = mapping
    answer = _asked(provider, "notes", {"notes": state["notes"], "chunk_id": chunk_id, "content": content[:BUDGETS["source_chunk"]]}, settings, temperature=0.7, max_tokens=3000)
    notes = answer.get("notes_content")
    if answer.get("updated") and isinstance(notes, str) and notes:
        if notes_fit(state["notes"], notes):
            entry["notes"] = notes
        else:
            entry["notes_refused"] = True
    return entry


def applied(state: dict[str, Any], entry: dict[str, Any]) -> dict[str, Any]:
    """A state after an entry of its log. What the given state lists grows on in the new one, so the given one is used up."""
    for key in ("labels", "terms", "units"):
        state[key].extend(entry[f"new_{key}"])
    listed = state.pop("listed")
    if entry["new_units"]:
        listed += ("\n" if listed else "") + "\n".join(entry["new_units"])  # in place, as nothing else holds the text
    return {"place": entry["place"], "labels": state["labels"], "terms": state["terms"], "units": state["units"], "listed": listed,
            "mapping": state["mapping"] if entry["mapping"] is None else entry["mapping"], "notes": state["notes"] if entry["notes"] is None else entry["notes"]}


class ChunkFold(StatefulProcessor):
    """The state of a base as JSON in the state store; a row of the log for each chunk taken."""

    def __init__(self, provider: Provider, settings: Settings):
        self.provider, self.settings = provider, settings

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.kept = handle.getValueState("kept", "json string")

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        state = json.loads(self.kept.get()[0]) if self.kept.exists() else first_state(self.settings.language)
        state["listed"] = "\n".join(state["units"])  # not kept, as it follows from the units
        chunks = pd.concat(list(rows)).sort_values(["place", "chunk_id", "content"])
        out = []
        for c in chunks.itertuples(index=False):
            if state["place"] is not None and c.place <= state["place"]:
                continue
            entry = taken(state, int(c.place), c.chunk_id, c.content or "", [] if c.units is None else list(c.units), self.provider, self.settings)
            state = applied(state, entry)
            out.append({"base": key[0], "n_labels": len(state["labels"]), "n_terms": len(state["terms"]), "n_units": len(state["units"]), "mapping_changed": entry["mapping"] is not None, "notes_changed": entry["notes"] is not None, **entry})
        self.kept.update((json.dumps({k: v for k, v in state.items() if k != "listed"}, ensure_ascii=False),))
        yield pd.DataFrame(out, columns=[c.split()[0] for c in LOG.split(", ")])

    def close(self) -> None:
        pass


def fold_chunks(spark: SparkSession, chunks: DataFrame, provider: Provider, folder: str, settings: Settings = DEFAULTS) -> DataFrame:
    """The log of all chunks of a stream with the columns of ``CHUNKS``, so far. ``folder`` keeps the log and the checkpoint with the states: called again, it takes what has come since."""
    providers_key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(providers_key, None)
    spark.conf.set(providers_key, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        entries = chunks.groupBy("base").transformWithStateInPandas(ChunkFold(provider, settings), LOG, "Append", "None")
        entries.writeStream.format("parquet").option("path", f"{folder}/log").option("checkpointLocation", f"{folder}/checkpoint").outputMode("append").trigger(availableNow=True).start().awaitTermination()
    finally:
        if before is None:
            spark.conf.unset(providers_key)
        else:
            spark.conf.set(providers_key, before)
    return spark.read.schema(LOG).parquet(f"{folder}/log")


def files_of(log: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """The two files of each base and their characters (base, mapping, notes, total_characters), from its log: the last text that was accepted of each, or the first one."""
    last = lambda c: F.max_by(c, F.when(F.col(c).isNotNull(), F.col("place")))
    out = log.groupBy("base").agg(F.coalesce(last("mapping"), F.lit(FIRST_MAPPING[settings.language])).alias("mapping"), F.coalesce(last("notes"), F.lit(FIRST_NOTES[settings.language])).alias("notes"))
    return out.withColumn("total_characters", F.length("mapping") + F.length("notes"))
