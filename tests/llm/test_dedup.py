"""Near, exact and substring deduplication against brute force, and their edge cases."""

import hashlib
import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tessera.llm import exact_dedup, minhash_dedup, substring_dedup
from tessera.llm import textscan as ts
from tessera.llm.queries import QUERIES
from tests.conftest import SMALL

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t or "")


def shingles(t):
    w = WORD.findall(lower(t))
    return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def brute_components(docs, percent=85):
    sets = {i: shingles(t) for i, t in docs}
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for k, i in enumerate(ids):
        for j in ids[k + 1:]:
            common = len(sets[i] & sets[j])
            if common and 100 * common >= percent * len(sets[i] | sets[j]):
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), root(i)) for i in ids}


def variants(rng):
    """Chains of edited copies, exact copies, blanks, short and unusual texts."""
    docs = []
    for _ in range(12):
        words = [rng.choice("abcdefghijklmnop") + str(rng.randint(0, 99)) for _ in range(rng.randint(1, 120))]
        for _ in range(rng.randint(1, 8)):
            docs.append(" ".join(words))
            for _ in range(rng.randint(0, 2)):
                words[rng.randrange(len(words))] = "edit" + str(rng.randint(0, 9999))
    docs += [None, "", " \n\t", "one", "ONE", "one two", "é É ü", "a b c d e", "A  B\nC\tD E", "x " * 500]
    rng.shuffle(docs)
    return list(enumerate(docs))


@pytest.mark.parametrize("seed", [1, 2])
def test_near_duplicates_match_brute_force(spark, seed):
    docs = variants(random.Random(seed))
    out = minhash_dedup.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string").repartition(3))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in out.collect()}
    assert got == brute_components(docs)
    assert all(r.kept == (r.doc_id == r.component_id) for r in out.collect())


def test_near_duplicates_query_matches_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in QUERIES["op1_minhash_near_dedup"](spark, SMALL).collect()}
    assert got == brute_components(docs)


def test_near_duplicates_dense_cloud_of_edits(spark):
    """A large group around one text in which links are sparse: all links must be found."""
    rng = random.Random(7)
    base = [f"w{i}" for i in range(120)]
    docs = []
    for i in range(120):
        words = list(base)
        for k in rng.sample(range(120), rng.randint(0, 5)):
            words[k] = f"e{i}x{k}"
        docs.append((i, " ".join(words)))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash_dedup.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got == brute_components(docs)


def test_near_duplicates_of_repeated_ids(spark):
    """A doc_id that repeats with another text: both texts link."""
    words = lambda c: " ".join(f"{c}{i}" for i in range(40))
    rows = [(5, words("a")), (5, words("b")), (9, words("b") + " more"), (11, words("a") + " more"), (3, words("c"))]
    for order in (rows, rows[::-1]):
        out = minhash_dedup.near_duplicates(spark.createDataFrame(order, "doc_id long, text string").repartition(4)).collect()
        assert sorted((r.doc_id, r.component_id, r.kept) for r in out) == [(3, 3, True), (5, 5, True), (5, 5, True), (9, 5, False), (11, 5, False)]
    import corpus_pipeline

    docs = spark.createDataFrame([*rows, (9, words("d"))], "doc_id long, text string")
    assert sorted((r.doc_id, r.text[0]) for r in corpus_pipeline.drop_near_duplicates(spark, docs, SMALL).collect()) == [(3, "c"), (5, "a"), (5, "b"), (9, "d")]


def test_near_duplicates_of_groups_just_apart(spark):
    """Two large groups of edited copies whose texts are nearly, but not quite, similar enough across, with a few links between them."""
    rng = random.Random(9)
    base = [f"w{i}" for i in range(100)]
    other = base[:94] + [f"v{i}" for i in range(6)]
    docs = []
    for i in range(160):
        words = list(base if i % 2 else other)
        for k in rng.sample(range(90), rng.randint(0, 3)):
            words[k] = f"e{rng.randint(0, 3)}x{k}"
        docs.append((i, " ".join(words)))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash_dedup.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got == brute_components(docs)


def test_near_duplicates_edge_cases(spark):
    schema = "doc_id long, text string, label string, n string"
    rows = [(1, "a b c d e f", "x", None), (1, "a b c d e f", "x", None), (None, "a b c d e f", None, None), (2, None, None, None), (3, "", None, None)]
    out = [(r.doc_id, r.component_id, r.kept) for r in minhash_dedup.near_duplicates(spark.createDataFrame(rows, schema)).collect()]
    assert sorted(out, key=str) == sorted([(1, 1, True), (1, 1, True), (None, 1, True), (2, 2, True), (3, 3, True)], key=str)
    assert minhash_dedup.near_duplicates(spark.createDataFrame([], schema)).count() == 0


def test_sketch_fills_and_estimates():
    rng = np.random.default_rng(1)
    for n in (1, 3, 50, 2000):
        both = rng.integers(0, 1 << 63, (1, n), dtype=np.int64).view(np.uint64).ravel()
        assert (minhash_dedup.sketches(both, np.array([n]), 200) != minhash_dedup._EMPTY).all()
    common, a, b = (rng.integers(0, 1 << 63, k, dtype=np.int64).view(np.uint64) for k in (800, 100, 100))
    m = minhash_dedup.sketches(np.concatenate([common, a, common, b]), np.array([900, 900]), 2000)
    assert abs((m[0] == m[1]).mean() - 0.8) < 0.03


@settings(max_examples=80, deadline=None)
@given(st.lists(st.text("aB é\n\t", max_size=30), min_size=1, max_size=6))
def test_word_spans(texts):
    import pyarrow as pa

    got = []
    for _, _, data, offsets in ts.slices(pa.array(texts), 20):
        s, e, doc = ts.white_words(data, offsets)
        for d in range(len(offsets) - 1):
            got.append([bytes(data[i:j]).decode() for i, j, k in zip(s, e, doc) if k == d])
    assert got == [WORD.findall(t) for t in texts]


# --- exact


def brute_exact(docs):
    groups = {}
    for i, t in docs:
        groups.setdefault(re.sub("[\x20\x09-\x0d]+", " ", t or ""), []).append(i)
    return sorted((i, min(ids), len(ids), i == min(ids), hashlib.sha256(t.encode()).hexdigest()) for t, ids in groups.items() for i in ids)


DOCS = [(5, "a b"), (3, "a  b"), (9, "a\nb"), (4, "c"), (7, None), (6, ""), (8, " "), (10, "\t\n"), (11, "é x"), (12, "é x"), (13, "long " * 5000), (14, "long  " * 5000)]


def exact(spark, tmp_path, docs, name="t", **options):
    path = str(tmp_path / name)
    spark.createDataFrame(docs, "doc_id long, text string").repartition(3).write.parquet(path)
    return exact_dedup.exact_duplicates(spark, path, **options)


def rows_of(df):
    return sorted((r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in df.collect())


def test_exact_matches_brute_force(spark, tmp_path):
    assert rows_of(exact(spark, tmp_path, DOCS)) == brute_exact(DOCS)


def test_exact_checks_bytes_when_digests_collide(spark, tmp_path):
    weak = lambda text: F.substring(F.sha2(text, 256), 1, 2)  # noqa: E731  one byte: unlike texts meet
    docs = [(i, f"text {i % 400}") for i in range(900)]
    assert rows_of(exact(spark, tmp_path, docs, digest=weak)) == brute_exact(docs)


def test_exact_state_goes_on_with_new_files(spark, tmp_path):
    folder, path = str(tmp_path / "state"), str(tmp_path / "docs")
    spark.createDataFrame([(5, "a"), (6, "b")], "doc_id long, text string").write.parquet(path)
    assert rows_of(exact_dedup.exact_duplicates(spark, path, folder=folder)) == brute_exact([(5, "a"), (6, "b")])
    spark.createDataFrame([(2, "a"), (7, "c"), (8, "c")], "doc_id long, text string").coalesce(1).write.mode("append").parquet(path)
    got = exact_dedup.exact_duplicates(spark, path, folder=folder, max_files_per_trigger=1)
    assert rows_of(got) == brute_exact([(5, "a"), (6, "b"), (2, "a"), (7, "c"), (8, "c")])


def test_exact_edge_cases(spark, tmp_path):
    assert exact(spark, tmp_path, []).count() == 0
    got = rows_of(exact(spark, tmp_path, [(1, "x"), (1, "x"), (2, "x")], "same"))
    assert [r[:3] for r in got] == [(1, 1, 3), (1, 1, 3), (2, 1, 3)] and sum(r[3] for r in got) == 1
    none = exact(spark, tmp_path, [(None, "y"), (4, "y"), (None, "z")], "none").collect()
    assert {(r.doc_id, r.keep_id, r.kept) for r in none} == {(None, 4, False), (4, 4, True), (None, None, True)}


def test_exact_main_path_has_no_python(spark, tmp_path):
    plan = exact(spark, tmp_path, DOCS)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


# --- substrings


def model_chunks(raw, bits, least, most):
    """Byte by byte."""
    out, at, h, n = [], 0, [], len(raw)
    for i in range(n):
        v = 0
        for j in range(min(32, i + 1)):
            v += int(substring_dedup._GEAR[raw[i - j]]) << j
        h.append(v & 0xFFFFFFFF)
    while at < n:
        end = next((i + 1 for i in range(at + least - 1, n) if h[i] >> (32 - bits) == 0 and (i + 1 == n or raw[i + 1] & 0xC0 != 0x80)), n)
        if end - at > most:
            end = at + most
            while end < n and raw[end] & 0xC0 == 0x80:
                end -= 1
        out.append((at, end))
        at = end
    return out


@settings(max_examples=40, deadline=None)
@given(st.lists(st.text("abcé€ \n", max_size=300), min_size=1, max_size=4))
def test_chunks_match_model(texts):
    raws = [t.encode() for t in texts]
    offsets = np.concatenate([[0], np.cumsum([len(r) for r in raws])])
    ends, docs = substring_dedup.chunk_ends(np.frombuffer(b"".join(raws), np.uint8), offsets, 3, 8, 40)
    for d, raw in enumerate(raws):
        mine = [int(e - offsets[d]) for e, k in zip(ends, docs) if k == d]
        assert mine == [e for _, e in model_chunks(raw, 3, 8, 40)]


@settings(max_examples=40, deadline=None)
@given(st.lists(st.text("abcé€ \n", max_size=300), min_size=1, max_size=4))
def test_local_chunks_match_model(texts):
    raws = [t.encode() for t in texts]
    offsets = np.concatenate([[0], np.cumsum([len(r) for r in raws])])
    ends, docs = substring_dedup.local_ends(np.frombuffer(b"".join(raws), np.uint8), offsets, 7, 40)
    for d, raw in enumerate(raws):
        h = [sum(int(substring_dedup._GEAR[raw[i - j]]) << j for j in range(min(32, i + 1))) & 0xFFFFFFFF for i in range(len(raw))]
        free = [i + 1 == len(raw) or raw[i + 1] & 0xC0 != 0x80 for i in range(len(raw))]
        h = [x if f else 1 << 32 for x, f in zip(h, free)]
        equals = [i + 1 for i in range(len(raw)) if free[i] and all(h[i] <= x for x in h[max(0, i - 7):i + 8])]
        cuts = [c for c in equals if all(h[c - 1] < x for x in h[max(0, c - 8):c - 1])]
        want, at = [], 0
        while at < len(raw):
            end = next((c for c in cuts if c > at), len(raw))
            if end - at > 21:
                end = max([c for c in equals if at < c <= at + 21] or [end])
            if end - at > 40:
                end = max(i + 1 for i in range(at, at + 40) if free[i])
            want.append(end)
            at = end
        assert [int(e - offsets[d]) for e, k in zip(ends, docs) if k == d] == want


def test_short_passages_in_two_documents_are_found(spark):
    """Passages of 51 words, each in two documents between unlike words."""
    rng = random.Random(8)
    words = sorted({w for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("text").collect() for w in (r.text or "").split()})
    prose = lambda n: " ".join(rng.choices(words, k=n))
    docs, places = [], {}
    for k in range(1000):
        passage = prose(51)
        for i in (2 * k, 2 * k + 1):
            before = prose(rng.randint(5, 40))
            docs.append((i, f"{before} {passage} {prose(30)}"))
            places[i] = (len(before), len(before) + len(passage) + 2)
    out = {r.doc_id: r.spans for r in substring_dedup.repeated_spans(spark.createDataFrame(docs, "doc_id long, text string").repartition(4)).collect()}
    found = sum(any(s.start >= places[i][0] and s.end <= places[i][1] for s in out[i]) for i in range(1, 2000, 2))
    assert found == 1000 and not any(out[i] for i in range(0, 2000, 2))


def test_repeated_passages_are_found_and_clean_texts_left(spark):
    rng = random.Random(5)
    prose = lambda n: " ".join("".join(rng.choices("abcdefghij", k=rng.randint(2, 9))) for _ in range(n))
    passage = prose(70)
    docs = [(i, prose(60)) for i in range(40)]
    planted = [(100 + i, f"{prose(rng.randint(5, 50))} {passage} {prose(30)}") for i in range(12)]
    out = {r.doc_id: r for r in substring_dedup.repeated_spans(spark.createDataFrame(docs + planted, "doc_id long, text string").repartition(4)).collect()}
    assert all(out[i].n_removed == 0 for i, _ in docs)
    assert out[100].n_removed == 0  # the first occurrence stays
    texts = dict(planted)
    for i in range(101, 112):
        lo = texts[i].index(passage)
        span = out[i].spans[0]
        assert len(out[i].spans) == 1 and span.start < lo + 150 and span.end > lo + len(passage) - 150


def test_spans_are_cut_out_exactly(spark):
    df = spark.createDataFrame([("abcdefgh", [(1, 3, 1), (5, 6, 1)]), ("abc", []), ("éüx", [(0, 2, 1)])], "text string, spans array<struct<start:int,end:int,words:bigint>>")
    assert [r[0] for r in df.select(substring_dedup.without_spans(F.col("text"), F.col("spans"))).collect()] == ["adegh", "abc", "x"]


def test_substring_edge_cases(spark):
    schema = "doc_id long, text string, row string, start string"
    same = "some words " * 40 + "that end here"
    rows = [(1, same, None, None), (1, same, None, None), (2, None, None, None), (3, "", None, None), (4, "x", None, None), (5, "x", None, None), (None, same, None, None)]
    out = substring_dedup.repeated_spans(spark.createDataFrame(rows, schema)).collect()
    assert len(out) == 7 and sum(r.n_removed > 0 for r in out) == 2
    assert all(r.n_chunks == 0 and r.n_chars == 0 and r.spans == [] for r in out if r.doc_id in (2, 3))
    assert all(r.n_removed > 0 for r in out if r.doc_id is None)
    assert substring_dedup.repeated_spans(spark.createDataFrame([], schema)).count() == 0
