"""Prompt rendering: templates by language, budgets, excerpts and the system prompt of the specification chat."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.functions.text import compress_mapping

#: Our own templates; both languages have the same placeholders.
TEMPLATES = {
    "spec_chat": {
        "en": "Help the user to write a specification. Ask about goals, users and features, draft spec.md and revise it until they confirm.\n\nKnowledge map:\n{mapping_summary}\n\nNotes:\n{eureka_snippet}\n",
        "zh": "请协助用户撰写规格说明。询问目标、用户和功能，起草 spec.md，并修改到用户确认为止。\n\n知识地图：\n{mapping_summary}\n\n笔记：\n{eureka_snippet}\n",
    },
    "finalize": {"en": "Write the final spec.md as one markdown block.", "zh": "请以一个 markdown 代码块写出最终的 spec.md。"},
    "scan": {"en": "Which of these units may be duplicates? Answer with JSON, key flagged_pairs (sku_a, sku_b, reason).\n\n{headers}", "zh": "下列单元中哪些可能重复？以 JSON 回答，键为 flagged_pairs（sku_a, sku_b, reason）。\n\n{headers}"},
    "judge": {
        "en": "Resolve this pair: keep, delete, rewrite, merge or contradiction. Where in doubt, keep. Answer with JSON, keys action, reasoning, delete_sku, rewrite_sku, new_content, merged_content.\n\n"
              "A = {id_a} ({chars_a} characters): {name_a}. {description_a}\n{content_a}\n\nB = {id_b} ({chars_b} characters): {name_b}. {description_b}\n{content_b}",
        "zh": "处理这一对：keep、delete、rewrite、merge 或 contradiction；不确定时选 keep。以 JSON 回答，键为 action、reasoning、delete_sku、rewrite_sku、new_content、merged_content。\n\n"
              "A = {id_a}（{chars_a} 字符）：{name_a}。{description_a}\n{content_a}\n\nB = {id_b}（{chars_b} 字符）：{name_b}。{description_b}\n{content_b}",
    },
    "confidence": {"en": "Rate how well this is supported.\n\n{content}\n\nSource: {source_chunk}\n\nWeb: {web_results}", "zh": "评估其可信度。\n\n{content}\n\n来源：{source_chunk}\n\n网络：{web_results}"},
    "proofread": {
        "en": "Rate from 0 to 1 how well the web supports this unit (web_confidence), and from 0 to 0.5 how far it departs from its source (source_penalty). Answer with JSON, with reasoning.\n\n"
              "{id}: {name}. {description}\n{content}\n\nSource: {source_chunk}\n\nWeb: {web_results}",
        "zh": "评估网络资料对该单元的支持程度（web_confidence，0 到 1）以及它偏离来源的程度（source_penalty，0 到 0.5）。以 JSON 回答，并给出 reasoning。\n\n"
              "{id}：{name}。{description}\n{content}\n\n来源：{source_chunk}\n\n网络：{web_results}",
    },
    "relations": {
        "en": "List label_paths, relationships (subject, predicate, object) and glossary entries (term, definition, labels, aliases, related_terms) of the text as JSON. Use what is known where it fits.\n\n"
              "Known labels:\n{labels}\n\nKnown terms: {terms}\n\nText:\n{content}",
        "zh": "以 JSON 列出文本的 label_paths、relationships（subject, predicate, object）和 glossary（term, definition, labels, aliases, related_terms）。尽量沿用已知内容。\n\n"
              "已知标签：\n{labels}\n\n已知术语：{terms}\n\n文本：\n{content}",
    },
    "mapping": {
        "en": "Update the map so that it says when to use which unit. Name only units of the list. Answer with JSON: mapping_content, the whole new map.\n\nUnits:\n{unit_list}\n\nMap:\n{mapping}\n\nNew chunk: {chunk_id}",
        "zh": "更新地图，说明何时使用哪个单元，只可列出下列单元。以 JSON 回答：mapping_content，即完整的新地图。\n\n单元：\n{unit_list}\n\n地图：\n{mapping}\n\n新片段：{chunk_id}",
    },
    "notes": {
        "en": "Does this chunk add an insight that reaches beyond it? Most do not. Answer with JSON: updated (true or false), notes_content (all notes, where updated).\n\nNotes:\n{notes}\n\nChunk {chunk_id}:\n{content}",
        "zh": "该片段是否带来超出自身的洞察？多数没有。以 JSON 回答：updated（true 或 false）、notes_content（若更新，给出全部笔记）。\n\n笔记：\n{notes}\n\n片段 {chunk_id}：\n{content}",
    },
    "cuts": {
        "en": "Find 1 to 3 places where this text can be cut. Copy about {k} tokens before and after each place exactly, and give the part that ends there a title. Answer with JSON only: "
              "cut_points, a list of tokens_before, tokens_after, chunk_title; the best first.\n\nCONTENT:\n{window}",
        "zh": "找出 1 到 3 处可以切分该文本的位置。原样复制每处前后约 {k} 个 token，并为到此为止的部分拟标题。仅以 JSON 回答：cut_points，元素含 tokens_before、tokens_after、chunk_title，最佳者在前。\n\nCONTENT:\n{window}",
    },
}
#: Characters of each part of a prompt.
BUDGETS = {"content": 6000, "source_chunk": 8000, "web_results": 4000, "pair": 8000, "notes": 5000, "snippet": 300}


def template(key: str, language: str = "en") -> str:
    return TEMPLATES[key].get(language, TEMPLATES[key]["en"])


def rendered(key: str, values: dict[str, Column], language: str = "en") -> Column:
    """A template with its placeholders filled by columns, each cut to its budget; null counts as empty."""
    def filled(name: str) -> Column:
        if name not in values:
            return F.lit("{" + name + "}")
        limit = BUDGETS.get(name, BUDGETS["pair"] if name.startswith("content_") else None)
        value = F.coalesce(values[name], F.lit(""))
        return F.left(value, F.lit(limit)) if limit else value

    pieces = re.split(r"\{(\w+)\}", template(key, language))  # text and names in turn, so that braces within a value stay as they are
    return F.concat(*[filled(x) if k % 2 else F.lit(x) for k, x in enumerate(pieces)])


def system_prompt(mapping: Column, notes: Column, language: str = "en") -> Column:
    """The chat's system prompt over the compressed mapping and the first notes, with texts for missing ones."""
    cut = F.when(F.length(notes) > BUDGETS["notes"], F.concat(F.left(notes, F.lit(BUDGETS["notes"])), F.lit("\n... (truncated)"))).otherwise(notes)
    some = lambda c, other: F.coalesce(F.nullif(c, F.lit("")), F.lit(other))
    out = F.replace(F.lit(template("spec_chat", language)), F.lit("{mapping_summary}"), some(compress_mapping(mapping), "(no mapping available)"))
    return F.replace(out, F.lit("{eureka_snippet}"), some(cut, "(no eureka notes available)"))


def glossary_excerpt(entries: Column, longest: int = 6000, first: int = 20) -> Column:
    """A glossary as JSON for a prompt: all entries (an array of structs), or the first ones where the JSON is too long."""
    return F.when(F.length(F.to_json(entries)) > longest, F.to_json(F.slice(entries, 1, first))).otherwise(F.to_json(entries))


def pair_headers() -> Column:
    """One line per unit of a scan batch (sku_id, name, description)."""
    return F.concat(F.lit("- "), F.col("sku_id"), F.lit(": "), F.col("name"), F.lit(" - "), F.col("description"))


def flagged_pairs(answer: Column) -> Column:
    """Pairs of a scan answer (JSON text); entries without both ids go."""
    pairs = F.from_json(answer, "flagged_pairs array<struct<sku_a:string,sku_b:string,reason:string>>")["flagged_pairs"]
    return F.filter(F.coalesce(pairs, F.expr("cast(array() as array<struct<sku_a:string,sku_b:string,reason:string>>)")), lambda p: p["sku_a"].isNotNull() & p["sku_b"].isNotNull())
