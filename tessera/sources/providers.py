"""Providers of remote services as plug-ins: the call is theirs; rendering, parsing, checks and retries are ours.

A provider is any object with the methods below; it is pickled to the workers. Every method returns None on failure.
"""

from __future__ import annotations

import json
import math
import time
import urllib.request
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from typing import Protocol

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.durable import exists
from tessera.functions.responses import parse_response


class Provider(Protocol):
    def complete(self, prompt: str, system: str = "", temperature: float = 0.3, max_tokens: int = 4000, json_mode: bool = False) -> str | None: ...

    def chat(self, messages: list[dict[str, str]], temperature: float = 0.4, max_tokens: int = 8000) -> str | None: ...

    def embed(self, texts: list[str]) -> list[list[float]] | None: ...

    def ocr(self, image: bytes) -> str | None: ...

    def search(self, query: str, limit: int = 5) -> list[dict] | None: ...

    def fetch(self, url: str) -> str | None: ...


@dataclass
class NullProvider:
    """Fails always, so every fallback is taken."""

    def complete(self, prompt, system="", temperature=0.3, max_tokens=4000, json_mode=False):
        return None

    def chat(self, messages, temperature=0.4, max_tokens=8000):
        return None

    def embed(self, texts):
        return None

    def ocr(self, image):
        return None

    def search(self, query, limit=5):
        return None

    def fetch(self, url):
        return None


@dataclass
class ScriptedProvider(NullProvider):
    """Answers from a table of (part of the prompt, answers in turn); calls are recorded."""

    script: dict[str, list[str | None]] = field(default_factory=dict)
    calls: list[dict] = field(default_factory=list)

    def complete(self, prompt, system="", temperature=0.3, max_tokens=4000, json_mode=False):
        self.calls.append({"prompt": prompt, "temperature": temperature, "json_mode": json_mode})
        for part, answers in self.script.items():
            if part in prompt:
                return answers.pop(0) if len(answers) > 1 else answers[0]
        return None

    def chat(self, messages, temperature=0.4, max_tokens=8000):
        return self.complete(messages[-1]["content"], temperature=temperature)


@dataclass
class HttpProvider(NullProvider):
    """Fetches pages over HTTP with pacing; no vendor and no key is assumed."""

    timeout: float = 30.0
    pause: float = 0.6
    _last: float = 0.0

    def fetch(self, url):
        wait = self._last + self.pause - time.monotonic()
        if wait > 0:
            time.sleep(wait)
        self._last = time.monotonic()
        try:
            with urllib.request.urlopen(url, timeout=self.timeout) as r:  # noqa: S310
                return r.read().decode("utf-8", "replace")
        except (OSError, ValueError):  # ValueError: a malformed address
            return None


@dataclass
class EndpointProvider(HttpProvider):
    """Completions and vectors from an endpoint that takes and gives JSON in the common chat form (messages in, choices out). Address, model and key are the user's; without a key, or where anything fails, the answer is None."""

    base: str = ""
    model: str = ""
    vector_model: str = ""
    key: str = field(default="", repr=False)

    def _post(self, path: str, body: dict) -> dict | None:
        if not self.key or not self.base:
            return None
        request = urllib.request.Request(f"{self.base.rstrip('/')}/{path}", json.dumps(body).encode(), {"Content-Type": "application/json", "Authorization": f"Bearer {self.key}"})  # noqa: S310
        try:
            with urllib.request.urlopen(request, timeout=self.timeout) as r:  # noqa: S310
                return json.loads(r.read())
        except (OSError, ValueError):
            return None

    def _said(self, messages: list[dict[str, str]], **more) -> str | None:
        got = self._post("chat/completions", {"model": self.model, "messages": messages, **more})
        try:
            return got["choices"][0]["message"]["content"]
        except (TypeError, KeyError, IndexError):
            return None

    def complete(self, prompt, system="", temperature=0.3, max_tokens=4000, json_mode=False):
        messages = ([{"role": "system", "content": system}] if system else []) + [{"role": "user", "content": prompt}]
        return self._said(messages, temperature=temperature, max_tokens=max_tokens, **({"response_format": {"type": "json_object"}} if json_mode else {}))

    def chat(self, messages, temperature=0.4, max_tokens=8000):
        return self._said(messages, temperature=temperature, max_tokens=max_tokens)

    def embed(self, texts):
        got = self._post("embeddings", {"model": self.vector_model, "input": texts})
        try:
            return [d["embedding"] for d in sorted(got["data"], key=lambda d: d["index"])]
        except (TypeError, KeyError):
            return None


def complete_json(provider: Provider, prompt: str, system: str = "", temperature: float = 0.3, max_tokens: int = 4000, retries: int = 2):
    """A parsed JSON answer: JSON mode first; on broken JSON asks again, colder and with the error; once without JSON mode
    where there is no answer at all."""
    ask, warm = prompt, temperature
    for attempt in range(retries + 1):
        answer = provider.complete(ask, system, warm, max_tokens, json_mode=True)
        if answer is None:
            answer = provider.complete(ask, system, warm, max_tokens, json_mode=False)
            if answer is None:
                return None
        value = parse_response(answer)
        if value is not None:
            return value
        ask = f"{prompt}\n\nThe last answer was not valid JSON: {answer[:300]}\nAnswer with valid JSON only."
        warm = max(0.1, warm - 0.1)
    return None


def retried(call: Callable, retries: int = 1, pause: float = 0.0, fatal: tuple[type[Exception], ...] = ()):
    """(result, error, retries used): failures become values."""
    for attempt in range(retries + 1):
        try:
            return call(), None, attempt
        except fatal as e:
            return None, str(e), attempt
        except Exception as e:  # noqa: BLE001
            if attempt == retries:
                return None, str(e), attempt
            time.sleep(pause)
    return None, None, retries


def answers(rows: DataFrame, provider: Provider, key: str, prompt: str, batch: int = 64, **options) -> DataFrame:
    """(key, answer): a JSON text per row, null where the provider fails."""
    kind = rows.schema[key].dataType.simpleString()

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows_ in batches:
            got = [complete_json(provider, p, **options) for p in rows_.column(1).to_pylist()]
            texts = [json.dumps(v, ensure_ascii=False) if v is not None else None for v in got]
            yield pa.RecordBatch.from_arrays([rows_.column(0), pa.array(texts, pa.string())], [key, "answer"])

    return rows.select(key, prompt).mapInArrow(ask, f"{key} {kind}, answer string")


def completions(rows: DataFrame, provider: Provider, key: str, prompt: str, **options) -> DataFrame:
    """(key, answer): the answer as it came, null where the provider fails or nothing is asked (a null prompt)."""
    kind = rows.schema[key].dataType.simpleString()

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows_ in batches:
            got = [None if p is None else provider.complete(p, **options) for p in rows_.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([rows_.column(0), pa.array(got, pa.string())], [key, "answer"])

    return rows.select(key, prompt).mapInArrow(ask, f"{key} {kind}, answer string")


#: Search results as a column.
RESULTS = "array<struct<title:string,url:string,snippet:string>>"


def searched(rows: DataFrame, provider: Provider, key: str, query: str, limit: int = 5, longest: int = 1000) -> DataFrame:
    """(key, results): web search results with snippets cut to ``longest`` characters; null where the search fails."""
    kind = rows.schema[key].dataType.simpleString()

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows_ in batches:
            out = []
            for text in rows_.column(1).to_pylist():
                got = provider.search(text, limit)
                out.append(None if got is None else [{"title": r.get("title"), "url": r.get("url"), "snippet": (r.get("snippet") or "")[:longest]} for r in got[:limit]])
            result = pa.array(out, pa.list_(pa.struct([(n, pa.string()) for n in ("title", "url", "snippet")])))
            yield pa.RecordBatch.from_arrays([rows_.column(0), result], [key, "results"])

    return rows.select(key, query).mapInArrow(ask, f"{key} {kind}, results {RESULTS}")


class Pace:
    """Requests of all tasks together never closer than ``pause`` seconds: task k of n owns the moments start + (k + n * j) * pause and waits for its next one, so no task needs to know what the others do.

    The clocks of the machines have to agree to less than the pause.
    """

    def __init__(self, pause: float, tasks: int):
        self.pause, self.tasks, self.start, self.last = pause, tasks, time.time(), -1

    def wait(self, task: int) -> float:
        """Sleeps until the task's next moment and returns it."""
        rounds = max(math.ceil(((time.time() - self.start) / self.pause - task) / self.tasks), self.last + 1)
        self.last = rounds
        moment = self.start + (task + self.tasks * rounds) * self.pause
        time.sleep(max(0.0, moment - time.time()))
        return moment


#: How address results look, as file results do.
_URL_RESULT = "source_path string, parser_used string, status string, text string, character_count long, error_message string, retry_count int, asked_at double"


def parsed_urls(urls: DataFrame, parsers: dict[str, Callable[[str], str | None]], retries: int = 1, pause: float = 0.6, tasks: int = 8, delay: float = 0.0) -> DataFrame:
    """Parse results of routed addresses (url, parser): a plug-in per parser name, called with the address and paced over all tasks; ``retries`` more attempts. A plug-in that is missing, raises, or gives
    nothing makes a failed row. Rows as of :func:`parsed_files`, and ``asked_at``, when the last attempt was due."""
    pace = Pace(pause, tasks)

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()

        def call(parser: str, url: str) -> str:
            if parser not in parsers:
                raise LookupError(f"no parser plug-in for {parser}")
            moments.append(pace.wait(task))
            text = parsers[parser](url)
            if text is None:
                raise ValueError("no content")
            return text

        for batch in batches:
            out = []
            for url, parser in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                moments: list[float] = []
                text, error, used = retried(lambda p=parser, u=url: call(p, u), retries, delay, (LookupError,))
                out.append({"source_path": url, "parser_used": parser, "status": "failed" if error is not None else "success", "text": text, "character_count": len(text or ""), "error_message": error,
                            "retry_count": used, "asked_at": moments[-1] if moments else None})
            yield pa.RecordBatch.from_pylist(out, schema=kinds)

    names = [c.split() for c in _URL_RESULT.split(", ")]
    kinds = pa.schema([(n, {"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "double": pa.float64()}[t]) for n, t in names])
    return urls.select("url", "parser").repartition(tasks, "url").mapInArrow(parse, _URL_RESULT)


def page_ledger(pages: DataFrame, provider: Provider, folder: str, attempts: int = 2, batch: int = 10, tasks: int = 64) -> DataFrame:
    """The ledger (doc_id, page, text, attempts) of recognised pages (doc_id, page, image) in ``folder``: text is null where all attempts failed or gave nothing.

    A page with an entry is never asked for again, whatever the run that wrote it came to; a page whose entry is there twice counts once. Batches are written as a whole.
    """
    from tessera.operators.numbering import in_batches

    spark = pages.sparkSession
    schema = f"doc_id {pages.schema['doc_id'].dataType.simpleString()}, page {pages.schema['page'].dataType.simpleString()}, text string, attempts int"

    def entries() -> DataFrame:
        if not exists(spark, folder):
            return spark.createDataFrame([], schema)
        return spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(folder).dropDuplicates(["doc_id", "page"])

    def recognise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            texts, tried = [], []
            for image in rows.column(2).to_pylist():
                text, n = None, 0
                while text is None and n < attempts:
                    text, n = retried(lambda i=image: provider.ocr(i), 0)[0] or None, n + 1
                texts.append(text)
                tried.append(n)
            yield pa.RecordBatch.from_arrays([rows.column(0), rows.column(1), pa.array(texts, pa.string()), pa.array(tried, pa.int32())], ["doc_id", "page", "text", "attempts"])

    done = entries().select("doc_id", "page")
    todo = pages.select("doc_id", "page", "image").join(done, ["doc_id", "page"], "left_anti").dropDuplicates(["doc_id", "page"])
    in_batches(todo, ["doc_id", "page"], lambda part: part.mapInArrow(recognise, schema), folder, batch, tasks)
    return entries()


def embeddings(rows: DataFrame, provider: Provider, key: str, text: str, batch: int = 64) -> DataFrame:
    """(key, v): vectors in batches of ``batch``; a batch that fails gives nulls."""
    kind = rows.schema[key].dataType.simpleString()

    def embed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for lo in range(0, len(frame), batch):
                part = frame.iloc[lo:lo + batch]
                got = provider.embed(list(part[text]))
                yield pd.DataFrame({key: part[key], "v": got if got is not None else [None] * len(part)})

    return rows.select(key, text).mapInPandas(embed, f"{key} {kind}, v array<double>")


def parsed_files(files: DataFrame, converters: dict[str, Callable[[bytes], str]], retries: int = 1) -> DataFrame:
    """Parse results of routed files (path, parser, status, message, content): a converter per parser name, one retry,
    failures as rows. Files that were skipped stay skipped."""
    def parse(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for path, parser, status, message, content in frame[["path", "parser", "status", "message", "content"]].itertuples(index=False):
                if status == "skipped":
                    out.append((path, parser, status, None, 0, message, 0))
                    continue
                convert = converters.get(parser)
                text, error, used = retried(lambda c=convert, b=content: c(bytes(b)), retries) if convert else (None, f"no converter for {parser}", 0)
                ok = error is None
                out.append((path, parser, "success" if ok else "failed", text, len(text or ""), error, used))
            yield pd.DataFrame(out, columns=["source_path", "parser_used", "status", "text", "character_count", "error_message", "retry_count"])

    schema = "source_path string, parser_used string, status string, text string, character_count long, error_message string, retry_count int"
    return files.select("path", "parser", "status", "message", "content").mapInPandas(parse, schema)


#: How PDF, zipped (office, EPUB) and old office files begin.
BINARY_STARTS = (b"%PDF", b"PK\x03\x04", b"\xd0\xcf\x11\xe0")


def text_converters() -> dict[str, Callable[[bytes], str]]:
    """Converters for what needs no extra library: plain text, Markdown and HTML by content, and tables as JSON records. A binary
    document is an error here, as it needs a converter of its own; so is a workbook where no library reads it."""
    from tessera.sources.markup import markdown_of

    def plain(content: bytes) -> str:
        if content.startswith(BINARY_STARTS) or b"\0" in content[:8192]:
            raise ValueError("binary document: give a converter for it")
        text = content.decode("utf-8", "replace")
        return markdown_of(text) if text.lstrip()[:200].lower().startswith(("<!doctype html", "<html")) else text

    def records(content: bytes) -> str:
        import io

        read = pd.read_excel if content.startswith(BINARY_STARTS) else pd.read_csv
        return read(io.BytesIO(content)).to_json(orient="records", indent=2, force_ascii=False)

    return {"markitdown": plain, "tabular": records}


def web_results_text(results: F.Column) -> F.Column:
    """Search results (array of title, url, snippet) as numbered text."""
    line = F.transform(results, lambda r, i: F.concat(F.lit("["), i + 1, F.lit("] "), F.coalesce(r["title"], F.lit("No title")), F.lit("\n    URL: "), F.coalesce(r["url"], F.lit("")), F.lit("\n    "), F.left(F.coalesce(r["snippet"], F.lit("")), F.lit(300))))
    return F.when(F.coalesce(F.size(results), F.lit(0)) <= 0, "(No web results found)").otherwise(F.array_join(line, "\n\n"))
