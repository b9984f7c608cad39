"""Prefix trie, SimHash join and fill-in-the-middle against brute force, and their edge cases."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tessera.llm import fill_in_middle, prefix_trie, simhash_dedup
from tessera.llm.queries import ORACLES, QUERIES
from tests import oracle
from tests.conftest import SMALL

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.mark.parametrize("name", ["op11_conversation_trie", "op13_fill_in_middle"])
def test_oracle(spark, name):
    assert oracle.spark_rows(QUERIES[name](spark, SMALL)) == oracle.sql_rows(ORACLES[name], SMALL)


# ---- prefix trie ----


def brute_trie(rows, every=5, most=9):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [x[2:] for x in sorted(v)] for c, v in own.items()}
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % most
        base = c - (abs(c) % every if c >= 0 else -(abs(c) % every))
        built[c] = own.get(base, [])[:h] + turns[h:]
    members = defaultdict(list)
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children = defaultdict(list)
    for k in members:
        if k:
            children[k[:-1]].append(k)
    out = set()

    def subtree(k):
        yield k
        for x in children[k]:
            yield from subtree(x)

    for k, m in members.items():
        below = list(subtree(k))
        ends = ",".join(str(c) for c in sorted(c for c in m if len(built[c]) == len(k)))
        saved = sum((len(members[x]) - 1) * len(x[-1][1].encode()) for x in below if x)
        out.add((min(m), len(k), min(members[k[:-1]]) if k else None, len(m), len(children[k]), sum(not children[x] for x in below), saved, hashlib.sha256(ends.encode()).hexdigest()))
    assert len(out) == len(members)
    return out


def trie_rows(spark, rows):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("a", F.lit(1)).repartition(3)
    got = prefix_trie.prefix_trie(*prefix_trie.spliced_prefixes(df)).collect()
    names = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    out = [tuple(r[n] for n in names) for r in got]
    assert len(out) == len(set(out))
    return set(out)


def conversations(rng, n=90):
    rows = []
    for c in [*range(n), -7, -3, -5, 10**12 + 3, None]:
        deep = rng.choice([1, 2, 3, 5, 9, 14, 40])
        for t in range(deep):
            role, text = rng.choice([("user", "a"), ("user", "a"), ("user", "é"), ("bot", "a"), (None, "a"), ("user", None), ("usera", "")])
            rows.append((c, rng.choice([t, t, t, t, None, t // 2]), role, text))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_trie_matches_brute_force(spark, seed):
    rows = conversations(random.Random(seed))
    assert trie_rows(spark, rows) == brute_trie(rows)


def test_trie_of_a_hot_conversation_and_hot_ends(spark, monkeypatch):
    """One conversation with most of the turns, and one sequence that thousands of conversations are."""
    monkeypatch.setattr(prefix_trie, "_PIECE_BITS", 4)
    monkeypatch.setattr(prefix_trie, "_BLOCK_BITS", 4)
    rows = [(5, t, "user", f"x{t % 7}") for t in range(600)] + [(c, t, "user", "same") for c in range(100, 900) for t in range(2)]
    assert trie_rows(spark, rows) == brute_trie(rows)


def test_trie_edge_cases(spark):
    assert trie_rows(spark, []) == set()
    assert trie_rows(spark, [(None, 1, "user", "x")]) == set()
    # crc32("2") % 9 turns are cut from conversation 2 and there is no conversation 0 to lend any
    for rows in ([(2, 0, None, None)], [(0, None, "a", "b"), (0, None, "a", "b")], [(4, 1, "u", "x" * 100_000), (0, 1, "u", "y")]):
        assert trie_rows(spark, rows) == brute_trie(rows)


# ---- SimHash ----


def lower(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t or "")


def brute_print(text, width=4):
    w = WORD.findall(lower(text))
    parts = [" ".join(w[i:i + width]) for i in range(len(w) - width + 1)] if len(w) >= width else [" ".join(w)] if w else []
    h = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << k for k in range(64) if 2 * sum(x >> k & 1 for x in h) > len(h))


def brute_labels(prints, bits):
    """The smallest index that each print reaches."""
    up = list(range(len(prints)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    p = np.array(prints, np.uint64)
    for i in range(len(p)):
        for j in np.flatnonzero(np.bitwise_count(p[i + 1:] ^ p[i]) <= bits).tolist():
            a, b = root(i), root(i + 1 + j)
            up[max(a, b)] = min(a, b)
    return [root(i) for i in range(len(p))]


def test_fingerprints_match_brute_force(spark):
    rng = random.Random(3)
    texts = ["", None, " \n\t", "one", "ONE", "one  two\tthree", "a b c d", "A\nB  c\x0bd", "é É ü ñ", "x " * 300, "word " * 3 + "\x00 z"]
    texts += [" ".join(rng.choice(["alpha", "Beta", "gamma", "ß", "日本"]) for _ in range(rng.randint(0, 200))) + rng.choice(["", " ", "\n"]) for _ in range(60)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {r.doc_id: r.fingerprint for r in simhash_dedup.simhash_components(df).collect()}
    assert got == {i: f"{brute_print(t):016x}" for i, t in enumerate(texts)}
    one = spark.createDataFrame([("alpha beta gamma ß",)], "t string").select(F.xxhash64("t")).first()[0] % 2**64
    assert brute_print("alpha beta gamma ß") == one  # one shingle: its own hash, as Spark has it


def test_long_texts_are_counted_in_chunks(monkeypatch):
    monkeypatch.setattr(simhash_dedup, "_CHUNK", 7)
    rng = random.Random(5)
    texts = [" ".join(rng.choice("abcdef") for _ in range(n)) for n in (0, 1, 3, 4, 5, 50, 300)]
    raw = "".join(texts).encode()
    got = simhash_dedup.fingerprints(np.frombuffer(raw, np.uint8), np.cumsum([0, *map(len, texts)]), 4)
    assert got.tolist() == [brute_print(t) for t in texts]


def cloud(rng, n):
    """Random prints, chains of single flips, and a crowd of prints around one."""
    out = {0, 2**64 - 1, 2**63}
    while len(out) < n:
        x = rng.getrandbits(64)
        for _ in range(rng.choice([1, 1, 5, 40])):
            out.add(x)
            for _ in range(rng.randint(1, 7)):
                x ^= 1 << rng.randrange(64)
    centre = rng.getrandbits(64)
    for _ in range(n):
        x = centre
        for k in rng.sample(range(64), rng.randint(0, 5)):
            x ^= 1 << k
        out.add(x)
    return sorted(out)


@pytest.mark.parametrize("front,leaves", [(200_000, 24), (50, 1)])
def test_walk_matches_brute_force(monkeypatch, front, leaves):
    """Both tries of one task: the links they give connect what brute force connects."""
    monkeypatch.setattr(simhash_dedup, "_FRONT", front)
    monkeypatch.setattr(simhash_dedup, "_LEAVES", leaves)
    prints = cloud(random.Random(front), 400)
    links = []
    for side, upper in ((0, 2), (1, 1)):
        p = np.array(prints, np.uint64)
        p = np.sort(p << np.uint64(32) | p >> np.uint64(32)) if side else p
        a, b = simhash_dedup.joined(p, np.arange(len(p)), (0, len(p)), (0, len(p)), 0, upper, 4)
        assert len(a) < len(p) and (np.bitwise_count(a ^ b) <= 4).all()
        if side:
            a, b = (x << np.uint64(32) | x >> np.uint64(32) for x in (a, b))
        links += list(zip(a.tolist(), b.tolist(), strict=True))
    index, up = {x: i for i, x in enumerate(prints)}, list(range(len(prints)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in links:
        x, y = root(index[a]), root(index[b])
        up[max(x, y)] = min(x, y)
    assert [root(i) for i in range(len(prints))] == brute_labels(prints, 4)


@pytest.mark.parametrize("most,step", [(30, 4), (5, 8)])
def test_links_over_many_nodes(spark, most, step):
    """The distributed walk, with cuts at all depths, finds what brute force connects."""
    prints = cloud(random.Random(most), 300)
    signed = np.array(prints, np.uint64).view(np.int64).tolist()
    df = spark.createDataFrame([(p, p) for p in signed], "print long, own long")
    near = simhash_dedup._links(df, 1, most, step)
    label = simhash_dedup.components(near)
    own = df.join(label, F.col("print") == F.col("node"), "left").select("print", F.coalesce("component", "print").alias("own"))
    far = simhash_dedup._links(own, 4, most, step)
    got = {r.node: r.component for r in simhash_dedup.components(near.union(far)).collect()}
    want = brute_labels(prints, 4)
    groups = defaultdict(set)
    for p, w in zip(signed, want, strict=True):
        groups[w].add(p)
    found = defaultdict(set)
    for p in signed:
        found[got.get(p, p)].add(p)
    assert {frozenset(x) for x in groups.values()} == {frozenset(x) for x in found.values()}


def test_simhash_query_matches_brute_force(spark):
    rows = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    rows.sort(key=lambda r: r.doc_id)
    prints = [brute_print(r.text) for r in rows]
    want = {r.doc_id: (f"{p:016x}", rows[k].doc_id) for r, p, k in zip(rows, prints, brute_labels(prints, 4), strict=True)}
    got = QUERIES["op12_simhash_near_dedup"](spark, SMALL)
    assert got.columns == ["doc_id", "fingerprint", "component_id"]
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in got.collect()} == want


def test_simhash_edge_cases(spark):
    kind = "doc_id long, text string, print string, component_id string"
    assert simhash_dedup.simhash_components(spark.createDataFrame([], kind)).collect() == []
    rows = [(3, None, "p", "c"), (1, "", "p", "c"), (None, " ", "p", "c"), (9, "one two", None, None), (9, "one two", None, None), (None, "alone here", "", "")]
    got = simhash_dedup.simhash_components(spark.createDataFrame(rows, kind)).collect()
    got = sorted(((r.doc_id, r.component_id) for r in got), key=str)
    assert got == sorted([(3, 1), (1, 1), (None, 1), (9, 9), (9, 9), (None, None)], key=str)


# ---- fill in the middle ----


def brute_fim(i, text):
    text = text or ""
    h = hashlib.sha256(f"1:{'' if i is None else i}".encode()).hexdigest()
    h = [int(h[8 * k:8 * k + 8], 16) for k in range(4)]
    n = len(text)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = text[:a], text[a:b], text[b:]
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    return (n, "spm", a, b - a, f"<S>{s}<P>{p}<M>{m}") if h[3] % 100 < 20 else (n, "psm", a, b - a, f"<P>{p}<S>{s}<M>{m}")


def test_fill_in_middle_matches_brute_force(spark):
    rng = random.Random(6)
    texts = [None, "", "a", "é", "日本語", "😀" * 700, "<P>", "x <S> y", "<M", "<", "<<P", "a" * 5000] + ["".join(rng.choice("ab é日😀<PSM>\n") for _ in range(rng.randint(0, 2000))) for _ in range(150)]
    rows = [(i if i % 40 else None, t, f"x{i}", i) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, output string, n int").repartition(4)
    out = fill_in_middle.fill_in_middle(df)
    assert sorted(out.columns) == sorted(["doc_id", "text", "form", "n", "prefix_chars", "middle_chars", "output"])
    out = out.withColumn("again", fill_in_middle.restored(F.col("output"), F.col("form"))).collect()
    got = sorted(((r.doc_id, r.text, (r.n, r.form, r.prefix_chars, r.middle_chars, r.output)) for r in out), key=str)
    assert got == sorted(((i, t, brute_fim(i, t)) for i, t, _, _ in rows), key=str)
    assert all(r.again == (r.text or "") for r in out)
    assert {r.form for r in out} == {"plain", "psm", "spm"}
    assert fill_in_middle.fill_in_middle(df.limit(0)).collect() == []


def test_rank_and_select():
    rng = random.Random(7)
    for size in (0, 1, 63, 64, 65, 511, 512, 513, 5000):
        text = "".join(rng.choice("aé日😀") for _ in range(size))
        raw = np.frombuffer(text.encode(), np.uint8)
        bits = fill_in_middle.Boundaries(raw)
        starts = np.array([len(text[:k].encode()) for k in range(size + 1)], np.int64)
        assert bits.before[-1] == size
        assert (bits.select(np.arange(size + 1)) == starts).all()
        assert (bits.rank(starts) == np.arange(size + 1)).all()


def test_bytes_that_are_no_text_come_back(spark):
    raw = [bytearray(b"\xff\xfeabc\x80\x80 def"), bytearray(b"\x80\x80"), bytearray(b"ok \xc3")]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(raw * 20)], "doc_id long, raw binary").select("doc_id", F.col("raw").cast("string").alias("text"))
    out = fill_in_middle.fill_in_middle(df)
    same = out.select((fill_in_middle.restored(F.col("output"), F.col("form")).cast("binary") == F.col("text").cast("binary")).alias("same"))
    assert same.where("NOT same").count() == 0
