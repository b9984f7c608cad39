"""Exact tokens: byte-pair merging by rank, from a rank table that the user gives.

A text falls into words by the tokenizer's pattern; a word's bytes are merged by the lowest rank until no pair has one. Merges of a word run on a heap of pairs over a linked list, so a word
of n bytes costs n log n, also where white space runs over thousands of characters. The words of a batch are made distinct first, and a worker keeps what it has merged, up to a bound: most
words are merged once a worker, and no shuffle is needed.

Ranks are broadcast: a table has as many entries as the vocabulary and is checked against ``MOST_RANKS``.

Defined results: null and empty text have no tokens. A byte without a rank of its own is an error of the table and raises. Decoded parts that end within a character show U+FFFD for it.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
import regex
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

#: A vocabulary has at most so many entries (some 30 MB as a broadcast).
MOST_RANKS = 1_000_000
#: Words that a worker keeps merged.
_KEPT_WORDS = 500_000
#: Fixed value: how the byte-level vocabularies split a text into words.
WORDS = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def read_ranks(lines: Iterable[bytes]) -> dict[bytes, int]:
    """Ranks from lines of a base64 token and its rank."""
    ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}
    if len(ranks) > MOST_RANKS:
        raise ValueError(f"{len(ranks)} ranks are too many to broadcast")
    return ranks


def ranks_at(spark: SparkSession, path: str) -> dict[bytes, int]:
    """The rank table of a file that Spark can read."""
    return read_ranks(bytes(spark.read.format("binaryFile").load(path).select("content").first()[0]).splitlines())


def merged(word: bytes, ranks: dict[bytes, int]) -> list[bytes]:
    """The tokens of a word."""
    if word in ranks:
        return [word]
    n = len(word)
    end = list(range(1, n + 1))  # where the part that begins at i ends; 0: merged away
    before = list(range(-1, n - 1))
    heap: list[tuple[int, int, int]] = []

    def offer(i: int) -> None:
        """The pair of the part at i and the next one, where it has a rank. An entry is stale when its pair no longer spans the same bytes."""
        middle = end[i]
        if middle < n:
            rank = ranks.get(word[i:end[middle]])
            if rank is not None:
                heapq.heappush(heap, (rank, i, end[middle]))

    for i in range(n - 1):
        offer(i)
    while heap:
        _, i, stop = heapq.heappop(heap)
        middle = end[i]
        if not middle or middle >= n or end[middle] != stop:
            continue
        end[i], end[middle] = stop, 0
        if stop < n:
            before[stop] = i
            offer(i)
        if before[i] >= 0:
            offer(before[i])
    parts, i = [], 0
    while i < n:
        parts.append(word[i:end[i]])
        i = end[i]
    return parts


class Tokenizer:
    """Tokens of texts; picklable, with what it has merged left behind."""

    def __init__(self, ranks: dict[bytes, int], pattern: str = WORDS):
        self.ranks, self.pattern = ranks, pattern
        self._known: dict[str, tuple[bytes, ...]] = {}
        self._words = None
        self._by_id: dict[int, bytes] | None = None

    def __getstate__(self):
        return {"ranks": self.ranks, "pattern": self.pattern, "_known": {}, "_words": None, "_by_id": None}

    def each_word(self, text: str) -> Iterator[str]:
        self._words = self._words or regex.compile(self.pattern)
        return (m[0] for m in self._words.finditer(text))

    def parts(self, word: str) -> tuple[bytes, ...]:
        found = self._known.get(word)
        if found is None:
            if len(self._known) >= _KEPT_WORDS:
                self._known.clear()
            found = self._known[word] = tuple(merged(word.encode("utf-8", "replace"), self.ranks))
        return found

    def tokens(self, text: str | None) -> list[bytes]:
        return [t for w in self.each_word(text or "") for t in self.parts(w)]

    def by_id(self) -> dict[int, bytes]:
        if self._by_id is None:
            self._by_id = {i: t for t, i in self.ranks.items()}
        return self._by_id

    def count(self, text: str | None) -> int:
        return sum(len(self.parts(w)) for w in self.each_word(text or ""))

    def ids(self, text: str | None) -> list[int]:
        return [self.ranks[t] for t in self.tokens(text)]

    def head(self, text: str, n: int) -> str:
        """The first n tokens as text; no word beyond them is looked at."""
        out: list[bytes] = []
        for word in self.each_word(text):
            parts = self.parts(word)
            if len(out) + len(parts) > n:
                return b"".join([*out, *parts[:max(n - len(out), 0)]]).decode("utf-8", "replace")
            out += parts
        return text


class Tokens:
    """Column functions over one rank table."""

    def __init__(self, spark: SparkSession, ranks: dict[bytes, int], pattern: str = WORDS):
        self.tokenizer = Tokenizer(ranks, pattern)
        self._shared = shared = spark.sparkContext.broadcast(self.tokenizer)

        def each(work: Callable[[Tokenizer, str], object], kind: str, arrow: pa.DataType):
            @F.arrow_udf(kind)
            def column(texts: pa.Array) -> pa.Array:
                tokenizer = shared.value
                return pa.array([None if t is None else work(tokenizer, t) for t in texts.to_pylist()], arrow)

            return column.asNondeterministic()  # else the planner repeats it for each use

        self._each = each
        self._count = each(Tokenizer.count, "long", pa.int64())

    def count(self, text: Column) -> Column:
        return F.coalesce(self._count(text), F.lit(0)).cast("int")

    def ids(self, text: Column) -> Column:
        return self._each(Tokenizer.ids, "array<int>", pa.list_(pa.int32()))(text)

    def truncated(self, text: Column, n: int) -> Column:
        return self._each(lambda t, x: t.head(x, n), "string", pa.string())(text)

    def window(self, text: Column, start: int, n: int) -> Column:
        """Tokens [start, start + n) as text and their number."""
        def cut(t: Tokenizer, x: str) -> dict:
            got = t.tokens(x)[max(start, 0):max(start, 0) + max(n, 0)]
            return {"text": b"".join(got).decode("utf-8", "replace"), "tokens": len(got)}

        return self._each(cut, "struct<text:string,tokens:int>", pa.struct([("text", pa.string()), ("tokens", pa.int32())]))(text)

    def text_of(self, ids: Column) -> Column:
        """The text of ids; null where an id is no token's."""
        shared = self._shared

        @F.arrow_udf("string")
        def joined(rows: pa.Array) -> pa.Array:
            tokens = shared.value.by_id()
            out = [None if r is None or any(i not in tokens for i in r) else b"".join(tokens[i] for i in r).decode("utf-8", "replace") for r in rows.to_pylist()]
            return pa.array(out, pa.string())

        return joined(ids)
