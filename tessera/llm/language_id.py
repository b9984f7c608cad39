"""Language identification by Bayesian fusion of evidence.

For each language, and for none of them (an unknown language), the log posterior of a document adds up
* the text likelihood: a byte-trigram model (hashed, additively smoothed), tempered so that a long text counts as
  ``effective`` trigrams, since neighbouring trigrams are not independent. The unknown language gives every trigram the
  same likelihood, halfway (in logs) between the fit sample's mean trigram and one that the fit sample never had;
* the declared markup language: correct with probability ``trust``;
* the address suffix: a country suffix points to its languages;
* the host prior: shares of languages among the host's documents, smoothed towards those of its parent domain, which
  are smoothed towards all documents' shares. The shares are sums of text posteriors by grouped aggregation, over all rows.

The trigram models are fitted on at most ``fit_rows`` rows per language that declare it (a documented bound; the rows
with the smallest hashes). A document is accepted if its text has a letter and its language's posterior reaches ``least``;
where an unknown language is likelier it is rejected, and ``language`` is the nearest known one. What a declaration or
suffix says of an unknown language is the same for all languages.

Defined results: null or empty text, and text without any letter, has no text evidence and is rejected; an unknown or
null declaration, suffix or host is no evidence; repeated rows count in the priors as often as they come; a language without fit rows
takes every trigram as one never seen; with an empty table nothing is fitted and the result is empty. Ties go to the language that comes first.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm import textscan as ts
from tessera.llm.common import discard, fresh, small_batches, written

_BITS = 14
LANGUAGES = ("en", "de", "fr", "es")
#: Languages that a country suffix points to.
SUFFIXES = {"de": "de", "at": "de", "ch": "de", "fr": "fr", "es": "es", "mx": "es", "ar": "es", "uk": "en", "us": "en", "au": "en"}
#: Letters in lower case, all other ASCII as a space.
_FOLD = np.where((ts.LOWER >= 0x80) | ((ts.LOWER >= 97) & (ts.LOWER <= 122)), ts.LOWER, np.uint8(32)).astype(np.uint32)
_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = _LETTER[0xC2:] = True


def trigram_slots(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash slot of each byte trigram within a document (letters in lower case, other ASCII as a space), and its document."""
    low = _FOLD[data]
    if len(low) < 3:
        return np.zeros(0, np.int32), np.zeros(0, np.int32)
    key = low[:-2] * np.uint32(0x9E3779B1) + low[1:-1] * np.uint32(0x85EBCA77) + low[2:] * np.uint32(0xC2B2AE3D)
    key ^= key >> np.uint32(15)
    key *= np.uint32(0x2C1B3C6D)
    slot = (key >> np.uint32(32 - _BITS)).astype(np.int32)
    doc = np.repeat(np.arange(len(offsets) - 1, dtype=np.int32), np.diff(offsets))
    inside = (doc[:-2] == doc[2:]) & ~((low[:-2] == 32) & (low[1:-1] == 32))
    return slot[inside], doc[:-2][inside]


def likelihood_column(tables: np.ndarray, effective: int):
    """arrow function: text -> array<double>: tempered log-likelihood per row of ``tables``, then 1 if there is a letter else 0."""
    rows = np.ascontiguousarray(tables.T.astype(np.float32))  # the languages' values of a slot lie together
    width = len(tables) + 1

    def work(batches):
        for texts in batches:
            parts = []
            for _, _, data, offsets in ts.slices(texts):
                n = len(offsets) - 1
                slot, doc = trigram_slots(data, offsets)
                count = np.bincount(doc, minlength=n)
                out = np.zeros((n, width))
                if len(doc):
                    first = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]]))
                    out[doc[first], :-1] = np.add.reduceat(rows[slot], first, axis=0, dtype=np.float64)
                out[:, :-1] *= (np.minimum(count, effective) / np.maximum(count, 1))[:, None]
                letters = np.concatenate([[0], np.cumsum(_LETTER[data])])
                out[:, -1] = (letters[offsets[1:]] - letters[offsets[:-1]]) > 0
                parts.append(out)
            x = np.vstack(parts) if parts else np.zeros((0, width))
            yield pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1]), pa.array(x.ravel()))

    @F.arrow_udf("array<double>")
    def likelihood(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        return ts.tidy(work)(batches)

    return likelihood.asNondeterministic()  # else the planner repeats it below a filter on its result


def _count_batches(batches, languages):
    total = np.zeros((len(languages), 1 << _BITS), np.int64)
    for batch in batches:
        names = np.array(batch.column(0).to_pylist(), dtype=object)
        for lo, hi, data, offsets in ts.slices(batch.column(1)):
            slot, doc = trigram_slots(data, offsets)
            for k, name in enumerate(languages):
                mine = (names[lo:hi] == name)[doc]
                total[k] += np.bincount(slot[mine], minlength=1 << _BITS)
    yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["sums"])


def fit_trigrams(docs: DataFrame, text_col: str, declared_col: str, key_col: str, languages: tuple[str, ...], fit_rows: int) -> np.ndarray:
    """(languages + 1, slots) log probabilities from at most ``fit_rows`` rows per declared language; the last row is the
    unknown language's."""
    keyed = docs.select(F.lower(F.col(declared_col)).alias("l"), F.xxhash64(F.col(key_col), F.lit(3)).alias("k"))
    bounds = [keyed.where(F.col("l") == name).select("k").distinct().orderBy("k").limit(fit_rows) for name in languages]
    keys = bounds[0].withColumn("l", F.lit(languages[0]))
    for name, b in zip(languages[1:], bounds[1:], strict=True):
        keys = keys.unionByName(b.withColumn("l", F.lit(name)))
    keys = written(keys, "fit")  # at most fit_rows for each language, so it may be broadcast
    rows = docs.select(F.lower(F.col(declared_col)).alias("l"), F.xxhash64(F.col(key_col), F.lit(3)).alias("k"), F.col(text_col).alias("t"))
    rows = written(rows.join(F.broadcast(keys), ["l", "k"], "left_semi").select("l", "t"), "fit")
    sums = np.zeros((len(languages), 1 << _BITS))
    for r in rows.coalesce(8).mapInArrow(ts.tidy(lambda it: _count_batches(it, languages)), "sums binary").toLocalIterator():  # fixed size per task
        sums += np.frombuffer(r.sums, np.int64).reshape(sums.shape)
    discard(keys, rows)
    return with_unknown(sums)


def with_unknown(sums: np.ndarray) -> np.ndarray:
    """Smoothed log probabilities from trigram counts, and those of the unknown language as a last row."""
    tables = np.log((sums + 0.5) / (sums.sum(1, keepdims=True) + 0.5 * sums.shape[1]))
    fitted = sums.sum(1) > 0
    if not fitted.any():
        return np.vstack([tables, tables[:1]])
    never = np.log(0.5 / (sums.sum(1) + 0.5 * sums.shape[1]))
    seen = (sums * tables).sum(1)[fitted] / sums.sum(1)[fitted]
    tables[~fitted] = never[fitted].min()
    return np.vstack([tables, np.full(sums.shape[1], ((seen + never[fitted]) / 2).mean())])


def _softmax(logs: list[Column]) -> list[Column]:
    top = F.greatest(*logs)
    exps = [F.exp(c - top) for c in logs]
    total = exps[0]
    for e in exps[1:]:
        total = total + e
    return [e / total for e in exps]


def parent_domain(host: Column) -> Column:
    """The last two labels of a host of more than two; null otherwise."""
    return F.when(F.size(F.split(host, "\\.")) > 2, F.substring_index(host, ".", -2))


def host_priors(evidence: DataFrame, shares: list[str], strength: float) -> DataFrame:
    """(host, prior array) smoothed host < parent domain < all, from rows (host, shares...)."""
    sums = [F.sum(s).alias(s) for s in shares]
    by_host = written(evidence.where("host IS NOT NULL").groupBy("host").agg(F.count(F.lit(1)).alias("n"), *sums), "hosts")
    total = evidence.agg(F.count(F.lit(1)).alias("n"), *sums).first()
    k = len(shares)
    overall = [((total[s] or 0.0) + 1.0) / (total["n"] + k) for s in shares]
    parents = by_host.withColumn("parent", parent_domain(F.col("host"))).where("parent IS NOT NULL").groupBy("parent").agg(F.sum("n").alias("pn"), *[F.sum(s).alias(f"p{s}") for s in shares])
    joined = by_host.withColumn("parent", parent_domain(F.col("host"))).join(parents, "parent", "left")
    n, pn = F.col("n"), F.coalesce("pn", F.lit(0))
    prior = []
    for s, g in zip(shares, overall, strict=True):
        up = (F.coalesce(f"p{s}", F.lit(0.0)) + strength * g) / (pn + strength)
        prior.append((F.col(s) + strength * up) / (n + strength))
    return written(joined.select("host", F.array(*prior).alias("prior")), "priors"), overall


def language_columns(docs: DataFrame, text_col: str = "text", declared_col: str = "lang", host: Column | None = None, suffix: Column | None = None,
                     key_col: str = "doc_id", languages: tuple[str, ...] = LANGUAGES, fit_rows: int = 1000, effective: int = 60, trust: float = 0.9,
                     strength: float = 20.0, least: float = 0.5, broadcast_hosts: int = 100_000, keep_text: bool = True) -> DataFrame:
    """``docs`` with language, text_language, posterior, accepted added (replacing columns of these names).

    ``host`` and ``suffix`` are columns over ``docs``: the host name, and the address's last label. Texts are scanned
    once and written with their likelihoods; without ``keep_text`` neither that table nor the result has the text.
    """
    small_batches(docs.sparkSession)
    docs = docs.drop("language", "text_language", "posterior", "accepted")
    k = len(languages)
    tables = fit_trigrams(docs, text_col, declared_col, key_col, languages, fit_rows)
    seen = likelihood_column(tables, effective)
    ll, hcol, pcol, ccol, known_host = fresh(docs, "_ll", "_host", "_prior", "_post", "_known_host")
    host = F.lower(host) if host is not None else F.lit(None).cast("string")
    with_ll = docs.withColumn(hcol, host).withColumn(ll, seen(F.col(text_col)))
    if not keep_text:
        with_ll, docs = with_ll.drop(text_col), docs.drop(text_col)
    with_ll = written(with_ll, "evidence")  # the texts are scanned once, for the priors and for the result
    text_post = _softmax([F.col(ll)[i] for i in range(k + 1)])
    has = F.col(ll)[k + 1] > 0
    evidence = with_ll.where(has).select(F.col(hcol).alias("host"), *[p.alias(f"s{i}") for i, p in enumerate(text_post)])
    priors, overall = host_priors(evidence, [f"s{i}" for i in range(k + 1)], strength)
    priors = priors.select(F.col("host").alias(known_host), F.col("prior").alias(pcol))
    if priors.count() <= broadcast_hosts:  # rows of fixed size; beyond that a shuffled join
        priors = F.broadcast(priors)
    rows = with_ll.join(priors, F.col(hcol) == F.col(known_host), "left").drop(known_host)
    declared = F.lower(F.col(declared_col))
    points = F.lit(None).cast("string")
    if suffix is not None:
        for s, name in SUFFIXES.items():
            points = F.when(F.lower(suffix) == s, F.lit(name)).otherwise(points)
    logs = []
    for i, name in enumerate([*languages, None]):
        match = lambda c, p: F.when(c == name, F.lit(p)).otherwise(F.lit((1 - p) / max(k - 1, 1))) if name else F.lit(1 / k)  # noqa: E731, B023
        says = lambda c, p: F.when(c.isin(*languages), F.log(match(c, p))).otherwise(F.lit(0.0))  # noqa: E731, B023
        logs.append(F.col(ll)[i] + says(declared, trust) + says(points, 0.8) + F.log(F.coalesce(F.col(pcol)[i], F.lit(overall[i]))))
    pick = lambda arr: F.element_at(F.array(*[F.lit(x) for x in languages]), F.array_position(arr, F.array_max(arr)).cast("int"))
    rows = rows.withColumn(ccol, F.array(*logs))
    # The best known language's posterior is exp(its log - largest log) / sum(exp(log - largest log)).
    known = F.slice(F.col(ccol), 1, k)
    total = F.aggregate(F.zip_with(F.col(ccol), F.array_repeat(F.array_max(ccol), k + 1), lambda x, top: F.exp(x - top)), F.lit(0.0), lambda acc, x: acc + x)
    best = F.exp(F.array_max(known) - F.array_max(ccol)) / total
    return rows.select(*docs.columns, F.when(has, pick(known)).alias("language"), F.when(has, pick(F.slice(F.col(ll), 1, k))).alias("text_language"),
                       F.when(has, best).otherwise(F.lit(0.0)).alias("posterior"), (has & (best >= least)).alias("accepted"))
