"""Specification chats as rounds over all open sessions: greeting, a reply to each user message, and the final specification.

A round asks for the reply to the next message of every session that has one, in parallel; the messages of all sessions so far are a table in the run's folder. There are at most as many rounds as the limit allows and two
more, whatever the number of sessions, and a run started again over its folder asks only for the rounds that are not there.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.config import DEFAULTS, Settings
from tessera.durable import new_folder, table_at
from tessera.functions.text import extract_spec, strip
from tessera.operators.prompts import template
from tessera.sources.providers import Provider

_MESSAGES = "array<struct<role:string,content:string>>"


def _replies(rows: DataFrame, provider: Provider) -> DataFrame:
    """(session_id, reply) to rows (session_id, messages); null where the provider fails or says nothing."""
    kind = rows.schema["session_id"].dataType.simpleString()

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [provider.chat(m) or None for m in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(got, pa.string())], ["session_id", "reply"])

    return rows.select("session_id", "messages").mapInArrow(ask, f"session_id {kind}, reply string")


def _said(role: str, content: F.Column) -> F.Column:
    return F.array(F.struct(F.lit(role).alias("role"), content.alias("content")))


def live_messages(messages: DataFrame, max_rounds: int) -> DataFrame:
    """(session_id, round, content, confirm) of user messages (session_id, seq, role, content) that count: blank ones are passed over, ``/confirm`` is the last, and so is the one that fills the limit."""
    rows = messages.where((F.col("role") == "user") & (strip(F.coalesce("content", F.lit(""))) != ""))
    rows = rows.withColumn("round", F.row_number().over(Window.partitionBy("session_id").orderBy("seq"))).where(F.col("round") <= max_rounds)
    confirm = F.lower(strip(F.col("content"))) == "/confirm"
    upto = F.max(confirm).over(Window.partitionBy("session_id").orderBy("round").rowsBetween(Window.unboundedPreceding, -1))
    rows = rows.withColumn("confirm", confirm).withColumn("_over", F.coalesce(upto, F.lit(False))).where(~F.col("_over"))
    return rows.select("session_id", "round", "content", "confirm")


def spec_sessions(sessions: DataFrame, messages: DataFrame, provider: Provider, folder: str | None = None, settings: Settings = DEFAULTS) -> DataFrame:
    """(session_id, rounds_used, confirmed, messages, spec) of ``sessions`` (session_id, system_prompt) and what their users said.

    A session whose greeting fails ends with an empty specification. A reply that fails leaves the user's message unanswered; the talk goes on. A session that ends, by confirmation, by the limit or because nothing more is said,
    is asked for the final text; where that fails, the specification is empty.
    """
    folder = folder or new_folder(sessions.sparkSession, "chat")
    live = table_at(live_messages(messages, settings.max_chat_rounds), f"{folder}/live")
    start = sessions.select("session_id", _said("system", F.col("system_prompt")).alias("messages"))
    state = start.join(_replies(start, provider), "session_id").select("session_id", F.when(F.col("reply").isNotNull(), F.concat("messages", _said("assistant", F.col("reply")))).alias("messages"), F.lit(0).alias("rounds_used"))
    state = table_at(state.select("*", F.lit(False).alias("confirmed")), f"{folder}/round-0")
    for n in range(1, settings.max_chat_rounds + 1):
        now = live.where(F.col("round") == n).select("session_id", "content", "confirm")
        rows = state.where("messages IS NOT NULL").join(now, "session_id").withColumn("messages", F.when(~F.col("confirm"), F.concat("messages", _said("user", F.col("content")))).otherwise(F.col("messages")))
        replies = _replies(rows.where(~F.col("confirm")), provider)
        told = rows.join(replies, "session_id", "left").select("session_id", F.when(F.col("reply").isNotNull(), F.concat("messages", _said("assistant", F.col("reply")))).otherwise(F.col("messages")).alias("_m"), F.col("confirm").alias("_c"))
        state = state.join(told, "session_id", "left").select("session_id", F.coalesce("_m", "messages").alias("messages"), (F.col("rounds_used") + F.when(F.col("_c") == False, 1).otherwise(0)).alias("rounds_used"),  # noqa: E712
                                                              (F.col("confirmed") | F.coalesce("_c", F.lit(False))).alias("confirmed"))
        state = table_at(state, f"{folder}/round-{n}")
    final = state.where("messages IS NOT NULL").withColumn("messages", F.concat("messages", _said("user", F.lit(template("finalize", settings.language)))))
    out = state.join(_replies(final, provider), "session_id", "left")
    spec = F.when(F.col("reply").isNotNull(), extract_spec(F.col("reply"))).otherwise("")
    return table_at(out.select("session_id", "rounds_used", "confirmed", F.coalesce(F.size("messages"), F.lit(0)).alias("messages"), spec.alias("spec")), f"{folder}/specs")
