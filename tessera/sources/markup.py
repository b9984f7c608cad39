"""Markup to Markdown: an Arrow function over the standard HTML parser."""

from __future__ import annotations

from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

_SLICE = 64
_SKIP = {"script", "style", "noscript", "template", "head"}
_BREAK = {"p", "div", "section", "article", "ul", "ol", "table", "tr", "blockquote", "header", "footer", "nav", "main", "aside", "figure"}


class _Markdown(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.out: list[str] = []
        self.skip = 0
        self.href: list[str] = []

    def handle_starttag(self, tag, attrs):
        if tag in _SKIP:
            self.skip += 1
        elif tag[0] == "h" and tag[1:].isdigit():
            self.out.append("\n\n" + "#" * int(tag[1:]) + " ")
        elif tag == "li":
            self.out.append("\n* ")
        elif tag == "br":
            self.out.append("  \n")
        elif tag in ("b", "strong"):
            self.out.append("**")
        elif tag in ("i", "em"):
            self.out.append("*")
        elif tag == "a":
            self.href.append(dict(attrs).get("href") or "")
            self.out.append("[")
        elif tag in _BREAK:
            self.out.append("\n\n")

    def handle_endtag(self, tag):
        if tag in _SKIP:
            self.skip = max(0, self.skip - 1)
        elif tag in ("b", "strong"):
            self.out.append("**")
        elif tag in ("i", "em"):
            self.out.append("*")
        elif tag == "a" and self.href:
            self.out.append(f"]({self.href.pop()})")
        elif tag in _BREAK or (tag[0] == "h" and tag[1:].isdigit()):
            self.out.append("\n\n")

    def handle_data(self, data):
        if not self.skip:
            self.out.append(" ".join(data.split()) if data.strip() else " ")


def markdown_of(page: str | None) -> str | None:
    if page is None:
        return None
    parser = _Markdown()
    parser.feed(page)
    parser.close()
    lines = [x.strip() for x in "".join(parser.out).split("\n")]
    out: list[str] = []
    for line in lines:
        if line or (out and out[-1]):
            out.append(line)
    return "\n".join(out).strip()


def html_to_markdown(pages: Column) -> Column:
    @F.arrow_udf("string")
    def convert(pages: pa.Array) -> pa.Array:
        # Pages become Python strings a few at a time, so that a batch is held in Arrow only.
        made = [pa.array([markdown_of(p) for p in pages.slice(k, _SLICE).to_pylist()], pa.string()) for k in range(0, len(pages), _SLICE)]
        return pa.concat_arrays(made) if made else pa.array([], pa.string())

    return convert(pages)
