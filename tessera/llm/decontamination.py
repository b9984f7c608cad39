"""Benchmark decontamination with one Aho-Corasick automaton over words.

The words of all benchmark items (questions and answers alike) are numbered, and every window of ``width`` words (an item of
fewer words is one window) is a pattern over these numbers. The automaton is built once, level by level: a state is a distinct
prefix of windows, its number is the place of its edge (parent, word) in one sorted array, so a step is a binary search.
Beside the edges there are failure links, the length of the longest window that ends in each state, and links to the next
shorter one. Some 17 bytes a state and at most ``width`` states a benchmark word: about 30 bytes for each byte of benchmark text.

Documents' words are found and numbered in whole slices, and the automaton reads a slice in lanes side by side. As its state depends
on no more than the last ``width`` words, a lane that starts ``width`` words early is in the state of the one automaton that reads
from the start. Hit words are known by their byte positions, hence as spans of the original text. Words are compared by 64-bit hashes
first; in documents with hits they are compared in full.

The items' size is measured first. Texts of more than ``automaton_bytes`` together are dealt to several automata; documents
are read once for each, all hits of equal texts are put together by key, and no case is left out. Memory stays bounded on the driver and in
workers, and no automaton is built twice.

Defined results: null text has no words; an item without words has no window; items of equal id count once, and a null id
is the id ""; documents are judged by their text, so repeated rows get equal results. An empty benchmark hits nothing. Extra
columns are passed over by :func:`benchmark_hits` and kept by :func:`decontaminated`.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm import textscan as ts
from tessera.llm.common import discard, fresh, small_batches, written

#: Bytes other than letters, digits and those of non-ASCII characters part words; A-Z are lower-cased.
_WORD = np.array([b >= 0x80 or 48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122 for b in range(256)])
_LANE = 64
_SLICE = 1_000_000


def _words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased bytes; start, end and document of each word."""
    return ts.LOWER[data], *ts.spans(_WORD[data], offsets)


class Automaton:
    """The automaton over the windows of some items: (id, UTF-8 text) each."""

    def __init__(self, items: list[tuple[str, bytes]], width: int):
        self.width, self.names = width, sorted({name for name, _ in items})
        number = {name: i for i, name in enumerate(self.names)}
        lens = np.array([len(t) for _, t in items], np.int64)
        low, s, e, doc = _words(np.frombuffer(b"".join(t for _, t in items), np.uint8), np.concatenate([[0], np.cumsum(lens)]).astype(np.int64))
        hashes = ts.span_hash(low, s, e)
        self.vocabulary, first, word = np.unique(hashes, return_index=True, return_inverse=True)
        self.spelt = [low[s[i]:e[i]].tobytes() for i in first]
        # Windows: where they start, how many words they have, whose they are.
        count = ts.counts_per_doc(doc, len(items))
        begin = np.cumsum(count) - count
        per = np.where(count >= width, count - width + 1, np.minimum(count, 1))
        owner = np.repeat(np.arange(len(items)), per)
        start = np.arange(len(owner)) - np.repeat(np.cumsum(per) - per, per) + begin[owner]
        length = np.minimum(count[owner], width)
        # States by depth; their edges (parent, word) are sorted over all depths, as parents' numbers grow with depth.
        state = np.zeros(len(owner), np.int64)
        keys, level, total = [], [0], 0
        for k in range(int(length.max(initial=0))):
            more = np.flatnonzero(length > k)
            key, place = np.unique((state[more] << 32) | word[start[more] + k], return_inverse=True)
            state[more] = total + 1 + place
            keys.append(key)
            total += len(key)
            level.append(total)
        self.keys = np.concatenate(keys) if keys else np.zeros(0, np.int64)
        self.root = np.zeros(len(self.vocabulary), np.int32)
        if keys:
            self.root[keys[0] & 0xFFFFFFFF] = np.arange(1, len(keys[0]) + 1)
        self.fail = np.zeros(total + 1, np.int32)
        terminal = np.zeros(total + 1, bool)
        terminal[state] = len(owner) > 0
        terminal[0] = False
        self.longest, self.shorter = np.zeros(total + 1, np.int16), np.zeros(total + 1, np.int32)
        for d in range(1, len(level)):
            own = np.arange(level[d - 1] + 1, level[d] + 1)
            if d > 1:
                key = self.keys[own - 1]
                self.fail[own] = self.step(self.fail[key >> 32].astype(np.int64), key & 0xFFFFFFFF)
            f = self.fail[own]
            self.longest[own] = np.where(terminal[own], d, self.longest[f])
            self.shorter[own] = np.where(terminal[f], f, self.shorter[f])
        pair = np.unique((state << 32) | np.array([number[name] for name, _ in items], np.int64)[owner]) if len(owner) else np.zeros(0, np.int64)
        self.ends, at = np.unique(pair >> 32, return_index=True)
        self.owner_at, self.owners = np.append(at, len(pair)), (pair & 0xFFFFFFFF).astype(np.int32)

    def step(self, state: np.ndarray, word: np.ndarray) -> np.ndarray:
        """The states after reading one word each; below 0 stands for a word that no item has."""
        out = np.zeros(len(state), np.int64)
        at = np.flatnonzero(word >= 0)
        s, w = state[at], word[at]
        while len(at):
            deep = s > 0
            key = (s << 32) | w
            place = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            found = np.where(deep, np.where(self.keys[place] == key, place + 1, 0), self.root[w])
            out[at] = found
            again = np.flatnonzero(deep & (found == 0))
            at, s, w = at[again], self.fail[s[again]].astype(np.int64), w[again]
        return out

    def states(self, word: np.ndarray) -> np.ndarray:
        """The state after each word of a sequence, by lanes of ``_LANE`` words that start ``width`` words early."""
        n = len(word)
        lanes = -(-n // _LANE)
        padded = np.full(self.width + lanes * _LANE, -1, np.int64)
        padded[self.width:self.width + n] = word
        out = np.zeros((lanes, _LANE), np.int64)
        start = np.arange(lanes) * _LANE
        state = np.zeros(lanes, np.int64)
        for t in range(self.width + _LANE):
            state = self.step(state, padded[start + t])
            if t >= self.width:
                out[:, t - self.width] = state
        return out.ravel()[:n]

    def items(self, state: int) -> set[str]:
        """Ids of all items with a window that ends in ``state``."""
        out: set[str] = set()
        while state:
            k = int(np.searchsorted(self.ends, state))
            if k < len(self.ends) and self.ends[k] == state:
                out.update(self.names[i] for i in self.owners[self.owner_at[k]:self.owner_at[k + 1]])
            state = int(self.shorter[state])
        return out

    def numbered(self, low: np.ndarray, s: np.ndarray, e: np.ndarray) -> np.ndarray:
        h = ts.span_hash(low, s, e)
        at = np.minimum(np.searchsorted(self.vocabulary, h), max(len(self.vocabulary) - 1, 0))
        return np.where(self.vocabulary[at] == h, at, -1) if len(self.vocabulary) else np.full(len(h), -1)

    def spans(self, word: np.ndarray, low: np.ndarray, s: np.ndarray, e: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """State after each word and whether a window covers it; ``word`` has -1 where documents meet as well."""
        state = self.states(word)
        end = np.flatnonzero(self.longest[state])
        if len(end):  # equal hashes are equal words?
            cover = np.unique(np.concatenate([end[self.longest[state[end]] > k] - k for k in range(self.width)]))
            cover = cover[word[cover] >= 0]
            unlike = [i for i in cover.tolist() if self.spelt[word[i]] != low[s[i]:e[i]].tobytes()]
            if unlike:
                word = word.copy()
                word[unlike] = -1
                return self.spans(word, low, s, e)
        mark = np.zeros(len(word) + 1, np.int64)
        np.add.at(mark, end - self.longest[state[end]] + 1, 1)
        np.add.at(mark, end + 1, -1)
        return state, np.cumsum(mark)[:-1] > 0


def scan_batches(batches: Iterator[pa.RecordBatch], machine: Automaton) -> Iterator[pa.RecordBatch]:
    """(key..., text) -> (key..., n_words, n_hit, items, spans)."""
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    for batch in batches:
        for lo, hi, data, offsets in ts.slices(batch.column(batch.num_columns - 1), _SLICE):
            n = hi - lo
            low, s, e, doc = _words(data, offsets)
            n_words = ts.counts_per_doc(doc, n)
            items: list[list[str]] = [[] for _ in range(n)]
            spans: list[list[dict]] = [[] for _ in range(n)]
            n_hit = np.zeros(n, np.int64)
            if len(s) and len(machine.keys):
                # One word that no item has between any two documents.
                place = np.arange(len(s)) + doc
                word = np.full(place[-1] + 1, -1, np.int64)
                word[place] = machine.numbered(low, s, e)
                first, last = np.zeros(len(word), np.int64), np.zeros(len(word), np.int64)
                first[place], last[place] = s, e
                state, hit = machine.spans(word, low, first, last)
                state, hit = state[place], hit[place]
                n_hit = ts.counts_per_doc(doc[hit], n)
                if hit.any():
                    chars = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
                    ends = np.flatnonzero(machine.longest[state])
                    names: dict[int, set[str]] = {}
                    for d, q in np.unique(np.stack([doc[ends], state[ends]]), axis=1).T.tolist():
                        names.setdefault(d, set()).update(machine.items(q))
                    for d in names:
                        items[d] = sorted(names[d])
                    edge = np.flatnonzero(hit & ~np.concatenate([[False], hit[:-1] & (doc[:-1] == doc[1:])]))
                    stop = np.flatnonzero(hit & ~np.concatenate([hit[1:] & (doc[:-1] == doc[1:]), [False]]))
                    for a, b in zip(edge.tolist(), stop.tolist(), strict=True):
                        base = chars[offsets[doc[a]]]
                        spans[doc[a]].append({"start": int(chars[s[a]] - base), "end": int(chars[e[b]] - base)})
            keys = [batch.column(i).slice(lo, n) for i in range(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*keys, pa.array(n_words), pa.array(n_hit), pa.array(items, pa.list_(pa.string())), pa.array(spans, kind)],
                                             [*batch.schema.names[:-1], "n_words", "n_hit", "items", "spans"])


def _automata(benchmark: DataFrame, width: int, item_col: str, item_text: str, automaton_bytes: int) -> Iterator[Automaton]:
    """One automaton if the items' texts have at most ``automaton_bytes`` together, else one for each part of about that size."""
    items = benchmark.where(F.col(item_text).isNotNull()).select(F.coalesce(F.col(item_col).cast("string"), F.lit("")).alias("id"), F.col(item_text).cast("string").alias("text")).distinct()
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    if size <= automaton_bytes:
        yield Automaton(sorted((r.id, r.text.encode()) for r in items.toLocalIterator()), width)
        return
    parts = int(-(-size // automaton_bytes))
    dealt = written(items.withColumn("part", F.pmod(F.xxhash64("id", "text"), F.lit(parts)).cast("int")).repartition(parts, "part"), "items")
    for k in range(parts):
        mine = sorted((r.id, r.text.encode()) for r in dealt.where(F.col("part") == k).toLocalIterator())
        if mine:
            yield Automaton(mine, width)
    discard(dealt)


_HITS = "n_words long, n_hit long, items array<string>, spans array<struct<start:bigint,end:bigint>>"


def _scanned(rows: DataFrame, machine: Automaton, key: str) -> DataFrame:
    shared = rows.sparkSession.sparkContext.broadcast(machine)  # bounded by automaton_bytes, see above
    return rows.mapInArrow(ts.tidy(lambda it: scan_batches(it, shared.value)), f"{key}, {_HITS}")


def _hits_of_parts(texts: DataFrame, machines: Iterator[Automaton]) -> DataFrame:
    """(a, b, items, spans) of texts (a, b: their digest) hit by any of several automata. Spans may overlap."""
    parts = [written(_scanned(texts, m, "a long, b long").where("n_hit > 0").select("a", "b", "items", "spans").dropDuplicates(["a", "b"]), "hits") for m in machines]
    every = parts[0]
    for p in parts[1:]:
        every = every.unionByName(p)
    out = written(every.groupBy("a", "b").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"), F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans")), "hits")
    discard(*parts)
    return out


def _digest(text: F.Column) -> list[F.Column]:
    return [F.xxhash64(text).alias("a"), F.xxhash64(F.lit(7), F.octet_length(text), F.reverse(text)).alias("b")]


def benchmark_hits(docs: DataFrame, benchmark: DataFrame, width: int = 10, id_col: str = "doc_id", text_col: str = "text",
                   item_col: str = "item_id", item_text: str = "text", automaton_bytes: int = 8_000_000) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, n_hit, items (sorted ids), spans (of the original text)."""
    small_batches(docs.sparkSession)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    machines = _automata(benchmark, width, item_col, item_text, automaton_bytes)
    machine, second = next(machines, None), next(machines, None)
    if second is None:
        return _scanned(texts, machine, "doc_id long")
    found = _hits_of_parts(texts.select(*_digest(F.col("text")), "text"), (m for some in ([machine, second], machines) for m in some))
    counted = _scanned(texts.select("doc_id", *_digest(F.col("text")), "text"), Automaton([], width), "doc_id long, a long, b long").select("doc_id", "a", "b", "n_words")
    rows = counted.join(found, ["a", "b"], "left")
    # Overlapping spans of several automata become one; a word covered is counted once, in the text of the joined spans.
    hit_texts = texts.select(*_digest(F.col("text")), "text").join(found, ["a", "b"]).dropDuplicates(["a", "b"]).select("a", "b", "spans", "text")
    merged = hit_texts.mapInArrow(ts.tidy(_joined_spans), "a long, b long, n_hit long, joined array<struct<start:bigint,end:bigint>>")
    out = rows.join(merged, ["a", "b"], "left")
    none, no_span = F.expr("cast(array() as array<string>)"), F.expr("cast(array() as array<struct<start:bigint,end:bigint>>)")
    return out.select("doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"), F.coalesce("items", none).alias("items"), F.coalesce("joined", no_span).alias("spans"))


def _joined_spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(a, b, spans, text) -> (a, b, words in the spans, spans made of runs of such words)."""
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    for batch in batches:
        counts, joined = [], []
        for spans, text in zip(batch.column(2), batch.column(3), strict=True):
            b = np.frombuffer(text.as_py().encode(), np.uint8)
            _, s, e, _ = _words(b, np.array([0, len(b)]))
            chars = np.concatenate([[0], np.cumsum((b & 0xC0) != 0x80)])
            hit = np.zeros(len(s) + 1, bool)
            for x in spans.as_py():
                hit[np.searchsorted(chars[s], x["start"]):np.searchsorted(chars[s], x["end"])] = True
            edge = np.diff(np.concatenate([[0], hit[:-1].astype(np.int8), [0]]))
            counts.append(int(hit.sum()))
            joined.append([{"start": int(chars[s[f]]), "end": int(chars[e[g - 1]])} for f, g in zip(np.flatnonzero(edge == 1), np.flatnonzero(edge == -1), strict=True)])
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(counts, pa.int64()), pa.array(joined, kind)], ["a", "b", "n_hit", "joined"])


def decontaminated(docs: DataFrame, benchmark: DataFrame, width: int = 10, text_col: str = "text", automaton_bytes: int = 8_000_000) -> DataFrame:
    """The rows of ``docs`` with no hit, all columns; without a shuffle where there is one automaton."""
    small_batches(docs.sparkSession)
    machines = _automata(benchmark, width, "item_id", "text", automaton_bytes)
    machine, second = next(machines, None), next(machines, None)
    if second is not None:
        a, b = fresh(docs, "_digest_a", "_digest_b")
        texts = docs.select(F.col(text_col).cast("string").alias("text"))
        found = _hits_of_parts(texts.select(*_digest(F.col("text")), "text"), (m for some in ([machine, second], machines) for m in some))
        left, right = _digest(F.col(text_col).cast("string"))
        marked = docs.withColumn(a, left).withColumn(b, right)
        return marked.join(found, (F.col(a) == found["a"]) & (F.col(b) == found["b"]), "left_anti").select(*docs.columns)
    shared = docs.sparkSession.sparkContext.broadcast(machine)

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = pa.RecordBatch.from_arrays([batch.column(batch.schema.get_field_index(text_col))], ["text"])
            hit = np.concatenate([b.column(1).to_numpy() for b in scan_batches(iter([rows]), shared.value)])
            yield batch.filter(pa.array(hit == 0))

    return docs.mapInArrow(ts.tidy(clean), docs.schema)


def item_digest(items) -> str:
    """SHA-256 of the comma-joined sorted ids, as the query's SQL functions compute it."""
    return hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()
