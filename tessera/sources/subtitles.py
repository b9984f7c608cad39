"""Subtitles: track choice and the text formats, as column expressions where the format allows."""

from __future__ import annotations

import json
import re
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.text import clock_seconds, strip

#: Preferences of languages and formats.
LANGUAGES_A = ("en", "zh", "zh-Hans", "zh-Hant", "zh-CN", "zh-TW")
LANGUAGES_B = ("zh-Hans", "zh", "zh-CN", "en", "ai-zh")
FORMATS = ("json3", "srv3", "vtt", "srt", "json")


def _rank(value: Column, order: tuple[str, ...]) -> Column:
    at = F.array_position(F.array(*[F.lit(x) for x in order]), value)
    return F.when(at > 0, at).otherwise(len(order) + 1)


def chosen_transcripts(tracks: DataFrame) -> DataFrame:
    """The track of each video (video_id, language, generated, ...): preferred languages, each manual before generated, else any."""
    w = Window.partitionBy("video_id").orderBy(F.when(F.col("language").isin(*LANGUAGES_A), 0).otherwise(1), "generated", _rank(F.col("language"), LANGUAGES_A), "language")
    return tracks.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")


def chosen_subtitles(tracks: DataFrame) -> DataFrame:
    """The track of each video (video_id, tier, language, ext, ...): lower tiers, then preferred languages, then preferred formats."""
    w = Window.partitionBy("video_id").orderBy("tier", _rank(F.col("language"), LANGUAGES_B), "language", _rank(F.col("ext"), FORMATS), "ext")
    return tracks.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")


def srt_segments(texts: DataFrame, id_col: str = "video_id", text_col: str = "data") -> DataFrame:
    """(id, seq, text, start) of SRT texts: blocks of three lines at least."""
    blocks = texts.select(id_col, F.posexplode(F.split(strip(F.col(text_col)), "\n\n+")).alias("seq", "b"))
    lines = F.split("b", "\n")
    body = F.regexp_replace(F.array_join(F.slice(lines, 3, F.greatest(F.size(lines) - 2, F.lit(0))), " "), "<[^>]+>", "")
    return blocks.where(F.size(lines) >= 3).select(id_col, "seq", strip(body).alias("text"), clock_seconds(lines[1], ",").alias("start")).where("text <> ''")


def vtt_segments(texts: DataFrame, id_col: str = "video_id", text_col: str = "data") -> DataFrame:
    """(id, seq, text, start) of VTT texts: blocks with a time line."""
    blocks = texts.select(id_col, F.posexplode(F.split(strip(F.col(text_col)), "\n\n+")).alias("seq", "b"))
    lines = F.split("b", "\n")
    at = F.array_position(F.transform(lines, lambda x: x.contains("-->")), True)
    body = F.regexp_replace(F.array_join(F.slice(lines, F.greatest(at + 1, F.lit(1)).cast("int"), F.size(lines)), " "), "<[^>]+>", "")
    return blocks.where(at > 0).select(id_col, "seq", strip(body).alias("text"), clock_seconds(F.element_at(lines, at.cast("int")), "\\.").alias("start")).where("text <> ''")


_SRT_BLOCK = re.compile(r"\n\n+")


def parse_subtitle(data: str, ext: str) -> list[dict] | None:
    """Segments (text, start) of the JSON and XML formats; broken data gives None."""
    try:
        if ext in ("json3", "json"):
            doc = json.loads(data)
            if isinstance(doc, dict) and "events" in doc:
                rows = [("".join(s.get("utf8", "") for s in e.get("segs", [])), e.get("tStartMs", 0) / 1000) for e in doc["events"]]
            elif isinstance(doc, dict) and "body" in doc:
                rows = [(e.get("content", ""), e.get("from", 0)) for e in doc["body"]]
            else:
                rows = [(e.get("text", ""), e.get("start", 0)) for e in doc]
        elif ext.startswith("srv"):
            rows = [("".join(p.itertext()), float(p.get("t", 0)) / 1000 if p.tag == "p" else float(p.get("start", 0))) for p in ElementTree.fromstring(data).iter() if p.tag in ("p", "text")]
        else:
            return None
    except (ValueError, AttributeError, TypeError, ElementTree.ParseError):
        return None
    return [{"text": t.strip(), "start": float(s or 0)} for t, s in rows if t.strip()]


def structured_segments(data: Column, ext: Column) -> Column:
    """array<struct<text, start>> of JSON and XML subtitles."""
    @F.arrow_udf("array<struct<text:string,start:double>>")
    def parse(data: pa.Array, ext: pa.Array) -> pa.Array:
        kind = pa.list_(pa.struct([("text", pa.string()), ("start", pa.float64())]))
        return pa.array([parse_subtitle(d or "", e or "") for d, e in zip(data.to_pylist(), ext.to_pylist(), strict=True)], kind)

    return parse(data, ext)
