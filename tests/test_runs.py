"""Runs that ask a model step by step, exact tokens, buckets of large classes and durable tables, against plain models."""

import json
import random
import re
from collections import Counter, defaultdict
from dataclasses import dataclass, field

import numpy as np
import pytest
import tiktoken
from pyspark.sql import functions as F

from tessera.config import Settings
from tessera.durable import complete, new_folder, shared_dir, table_at, written
from tessera.functions import bpe
from tessera.operators import clustering, components, graph, judgement, segmentation
from tessera.plans import runs
from tessera.sources.providers import NullProvider
from tests.conftest import SMALL

# --- exact tokens


@pytest.fixture(scope="module")
def exact(spark):
    return bpe.Tokens(spark, bpe.ranks_at(spark, runs.RANKS))


@pytest.fixture(scope="module")
def reference(exact):
    return tiktoken.Encoding("own", pat_str=bpe.WORDS, mergeable_ranks=exact.tokenizer.ranks, special_tokens={})


def test_whole_documents_have_the_exact_tokens(spark, exact, reference):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    for r in runs.token_count_exact(spark, SMALL).collect():
        ids = reference.encode_ordinary(texts[r.doc_id] or "")
        assert r.tokens == len(ids) and r.over_budget == (len(ids) > 1000)
        assert r.head == (texts[r.doc_id] if len(ids) <= 40 else reference.decode(ids[:40]))


def test_ids_windows_and_texts(spark, exact, reference):
    rng = random.Random(1)
    texts = [None, "", " ", "\n\n  x", "don't  stop", "日本語 ünïcode 😀😀", "x" * 3000, " " * 5000, "a<|endoftext|>b"]
    texts += ["".join(rng.choice(["the", " of", "é", "日", " ", "\n", "12", "'ll", "!?", "Zz"]) for _ in range(rng.randint(1, 80))) for _ in range(80)]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string").withColumn("ids", exact.ids(F.col("t")))
    out = df.select("i", "t", "ids", exact.text_of(F.col("ids")).alias("back"), exact.window(F.col("t"), 2, 3).alias("w"), exact.count(F.col("t")).alias("n"), exact.truncated(F.col("t"), 4).alias("cut")).collect()
    for r in out:
        if r.t is None:
            assert r.ids is None and r.n == 0
            continue
        ids = reference.encode_ordinary(r.t)
        assert r.ids == ids and r.back == r.t and r.n == len(ids)
        assert (r.w.text, r.w.tokens) == (reference.decode(ids[2:5]), len(ids[2:5]))
        assert r.cut == (r.t if len(ids) <= 4 else reference.decode(ids[:4]))
    assert spark.createDataFrame([([10 ** 9],)], "ids array<int>").select(exact.text_of(F.col("ids"))).first()[0] is None


def test_too_many_ranks_are_refused(monkeypatch):
    monkeypatch.setattr(bpe, "MOST_RANKS", 1)
    with pytest.raises(ValueError, match="too many"):
        bpe.read_ranks([b"YQ== 0", b"Yg== 1"])


def test_chunks_by_exact_tokens(spark, exact, reference):
    text = "# One\n\n" + "word " * 50 + "\n\n# Two\n\n" + "日本語 " * 60 + "\n\n## Deep\n\n" + "tail " * 10
    docs = spark.createDataFrame([("a", text), ("b", "plain " * 400), ("c", "short")], "doc_id string, text string")
    out = segmentation.chunks(docs, 120, measure=exact, provider=NullProvider()).collect()
    assert all(r.estimated_tokens == len(reference.encode_ordinary(r.content)) for r in out)
    assert all(r.estimated_tokens <= 120 for r in out if r.doc_id != "a")
    whole = "".join(r.content for r in sorted((r for r in out if r.doc_id == "b"), key=lambda r: r.chunk_index))
    assert whole.replace(" ", "") == "plain" * 400  # white space before a cut's rest goes


# --- judgement of pairs


@dataclass
class Judge(NullProvider):
    """An answer by the pair's ids and contents."""

    def complete(self, prompt, system="", temperature=0.3, max_tokens=4000, json_mode=False):
        a, text_a, b, text_b = re.search(r"A = (\S+) \(\d+ characters\): .*?\n(.*)\n\nB = (\S+) \(\d+ characters\): .*?\n(.*)", prompt, re.S).groups()
        return self.verdict(a, text_a, b, text_b)

    @staticmethod
    def verdict(a, text_a, b, text_b):
        k = sum(map(ord, a + text_a + b + text_b)) % 9
        return [json.dumps({"action": "delete", "delete_sku": b}), json.dumps({"action": "delete", "delete_sku": "other"}), json.dumps({"action": "rewrite", "rewrite_sku": a, "new_content": text_a + "!"}),
                json.dumps({"action": "rewrite", "rewrite_sku": b, "new_content": {"k": text_b[:5]}}), json.dumps({"action": "merge", "delete_sku": a, "merged_content": f"{text_a[:9]}+{text_b[:9]}"}),
                json.dumps({"action": "merge", "delete_sku": None, "merged_content": "m"}), json.dumps({"action": "what"}), None, "{}"][k]


def one_after_another(pairs, contents):
    contents, actions = dict(contents), []
    for o, a, b in sorted(pairs):
        if contents.get(a) is None or contents.get(b) is None:
            continue
        answer = Judge.verdict(a, contents[a], b, contents[b])
        parsed = json.loads(answer) if answer else None
        if not parsed:
            continue
        action = parsed["action"] if parsed["action"] != "what" else "keep"
        actions.append((o, action))
        drop = [parsed["delete_sku"]] if parsed.get("delete_sku") else []
        if action == "rewrite":
            new = parsed["new_content"]
            contents[parsed["rewrite_sku"]] = json.dumps(new, separators=(",", ":")) if isinstance(new, dict) else new
        if action == "merge":
            contents[b if a in drop else a] = parsed["merged_content"]
        if action in ("delete", "merge"):
            for x in drop:
                if x in (a, b):
                    contents[x] = None
    return {k: v for k, v in contents.items() if v is not None}, actions


def random_pairs(rng):
    """Chains, stars, cycles, repeated pairs and a unit with itself."""
    ids = [f"u{i}" for i in range(30)]
    pairs = [(i, i + 1) for i in range(8)] + [(10, k) for k in range(11, 18)] + [(20, 21), (21, 22), (22, 20), (20, 21), (23, 23)]
    pairs += [(rng.randrange(30), rng.randrange(30)) for _ in range(12)]
    rng.shuffle(pairs)
    return [(o, ids[a], ids[b]) for o, (a, b) in enumerate(pairs)] + [(999, "u1", "nobody")], {u: f"text of {u} {rng.random()}" for u in ids} | {"u29": None}


@pytest.mark.parametrize("seed", [1, 2])
def test_fronts_give_the_sequential_result(spark, seed):
    pairs, contents = random_pairs(random.Random(seed))
    units = spark.createDataFrame([(u, "n", "d", c) for u, c in contents.items()], "sku_id string, name string, description string, content string")
    kept, actions = judgement.judged(spark.createDataFrame(pairs, "ord long, sku_a string, sku_b string"), units, Judge())
    want, acts = one_after_another(pairs, contents)
    assert {r.sku_id: r.content for r in kept.where("content IS NOT NULL").collect()} == want
    assert sorted((r.ord, r.action) for r in actions.collect()) == acts


def test_answers_are_not_asked_for_again(spark):
    """A run over the folder of an earlier one reads its answers, so a provider that would say otherwise changes nothing."""
    pairs, contents = random_pairs(random.Random(3))
    units = spark.createDataFrame([(u, "n", "d", c) for u, c in contents.items()], "sku_id string, name string, description string, content string")
    rows = spark.createDataFrame(pairs, "ord long, sku_a string, sku_b string")
    folder = new_folder(spark, "test")
    first = {r.sku_id: r.content for r in judgement.judged(rows, units, Judge(), folder)[0].collect()}
    again = {r.sku_id: r.content for r in judgement.judged(rows, units, NullProvider(), folder)[0].collect()}
    assert first == again


@dataclass
class Scanner(Judge):
    """Flags neighbours in a batch of headers, one pair with a stranger and one entry without an id."""

    def complete(self, prompt, system="", temperature=0.3, max_tokens=4000, json_mode=False):
        if "flagged_pairs" not in prompt:
            return super().complete(prompt, system, temperature, max_tokens, json_mode)
        ids = re.findall(r"^- (\S+): ", prompt, re.M)
        return json.dumps({"flagged_pairs": [{"sku_a": a, "sku_b": b, "reason": "near"} for a, b in zip(ids, ids[1:])] + [{"sku_a": ids[0], "sku_b": "stranger"}, {"sku_a": ids[0]}]})


def test_whole_deduplication(spark):
    contents = {f"u{i:02d}": f"text {i}" for i in range(20)}
    members = [("b1" if i < 12 else "b2" if i < 19 else "b3", u, i, "n", "d") for i, u in enumerate(contents)]
    units = spark.createDataFrame([(u, "n", "d", c) for u, c in contents.items()], "sku_id string, name string, description string, content string")
    frame = spark.createDataFrame(members, "bucket_id string, sku_id string, ord int, name string, description string")
    kept, actions, report = judgement.deduplicated(frame, units, Scanner(), settings=Settings(scan_batch=5))
    batches = [list(contents)[0:5], list(contents)[5:10], list(contents)[10:12], list(contents)[12:17], list(contents)[17:19]]
    pairs = [p for b in batches for p in zip(b, b[1:])]
    want, acts = one_after_another([(o, *p) for o, p in enumerate(pairs)], contents)
    assert {r.sku_id: r.content for r in kept.collect()} == want
    assert [r.action for r in actions.orderBy("ord").collect()] == [a for _, a in acts]
    r = report.first()
    assert (r.buckets_scanned, r.pairs_flagged, r.pairs_resolved) == (2, len(pairs) + len(batches), len(acts))
    empty = judgement.deduplicated(frame.limit(0), units, Scanner())
    assert empty[0].count() == 20 and empty[1].collect() == [] and empty[2].first().pairs_flagged == 0


# --- scores


@dataclass
class Counting(NullProvider):
    """Writes down whom it is asked about; fails on ids in ``fails``."""

    log: str = ""
    fails: tuple = ()

    def complete(self, prompt, system="", temperature=0.3, max_tokens=4000, json_mode=False):
        sku = re.search(r"\n\n(s\d+): ", prompt)[1]
        with open(self.log, "a") as f:
            f.write(sku + "\n")
        return None if sku in self.fails else json.dumps({"web_confidence": 0.8, "source_penalty": 0.9, "reasoning": "r"})


def test_scored_units_are_never_asked_again(spark, tmp_path):
    rows = [(f"s{i}", "n", "d", None if i == 7 else "c", "src", 0.4 if i == 5 else None) for i in range(30)]
    units = spark.createDataFrame(rows, "sku_id string, name string, description string, content string, source_chunk string, confidence double")
    chunks = spark.createDataFrame([("src", "source text")], "chunk_id string, content string")
    folder, log = new_folder(spark, "test"), tmp_path / "log"
    first = judgement.scored(units, chunks, Counting(str(log), ("s3", "s4")), folder, batch=3, tasks=2)
    assert {r.sku_id for r in first.collect()} == {f"s{i}" for i in range(30)} - {"s3", "s4", "s5", "s7"}
    assert all(r.confidence == pytest.approx(0.3) and r.source_penalty == 0.5 and "[Web search unavailable]" in r.reasoning for r in first.collect())
    asked = set(log.read_text().split())
    log.write_text("")
    again = judgement.scored(units, chunks, Counting(str(log)), folder, batch=3, tasks=2)
    assert set(log.read_text().split()) == {"s3", "s4"} and again.count() == 28 and "s5" not in asked and "s7" not in asked


# --- cuts


@dataclass
class Cutter(NullProvider):
    answers: dict = field(default_factory=dict)

    def complete(self, prompt, system="", temperature=0.3, max_tokens=4000, json_mode=False):
        window = prompt.split("CONTENT:\n", 1)[1]
        return next((a for start, a in self.answers.items() if window.startswith(start)), None)


def test_cuts_follow_the_answers(spark):
    cut = lambda before, title: json.dumps({"cut_points": [{"tokens_before": before, "tokens_after": "", "chunk_title": title}, {"tokens_before": "never", "tokens_after": "", "chunk_title": "x"}]})
    one = "alpha " * 40 + "stop here.  \n \n" + "beta " * 60 + "the end. " + "gamma " * 50
    docs = [("a", one), ("b", "delta " * 100), ("c", ""), ("d", None), ("e", "short"), ("f", "early " * 90)]
    answers = {"alpha": "```json\n" + cut("stop here.", "First") + "\n```", "beta": "{" + cut("the end.", "Second")[1:-1], "delta": cut("nowhere to be found", "X"), "early": cut("early", "too early")}
    out = segmentation.requested_chunks(spark.createDataFrame(docs, "doc_id string, text string"), 75, Cutter(answers)).orderBy("doc_id", "chunk_index").collect()
    got = defaultdict(list)
    for r in out:
        got[r.doc_id].append((r.title, r.content, r.total_chunks))
    assert got["a"] == [("First", "alpha " * 40 + "stop here.", 3), ("Second", "beta " * 60 + "the end.", 3), ("Part 3", "gamma " * 50, 3)]
    assert [t for t, *_ in got["b"]] == ["Part 1", "Part 2"] and " ".join(c.strip() for _, c, _ in got["b"]) == ("delta " * 100).strip()
    assert got["e"] == [("e", "short", 1)] and "c" not in got and "d" not in got and [t for t, *_ in got["f"]] == ["Part 1", "Part 2"]


def test_rounds_are_taken_up_again(spark):
    docs = spark.createDataFrame([(i, "word. " * (200 * i)) for i in range(1, 4)], "doc_id long, text string")
    folder = new_folder(spark, "test")
    first = segmentation.requested_chunks(docs, 100, NullProvider(), folder=folder).collect()
    again = segmentation.requested_chunks(docs, 100, Cutter({"word": "must not be asked"}), folder=folder).collect()
    assert sorted(first) == sorted(again) and max(r.total_chunks for r in first) > 3


# --- buckets


def sparse(rng, n, share):
    m = np.eye(n)
    for i in range(n):
        for j in range(i):
            if rng.random() < share:
                m[i, j] = m[j, i] = rng.random()
    return m


@pytest.mark.parametrize("n,share,limit", [(40, 0.9, 110), (60, 0.08, 120)])
def test_large_classes_are_cut_as_small_ones(spark, n, share, limit):
    """Distributed rounds, cut after cut, against bisection of the dense matrix."""
    rng = random.Random(n)
    m, tokens = sparse(rng, n, share), [rng.randint(1, 20) for _ in range(n)]
    units = spark.createDataFrame([(f"s{i:02d}", "k", i, tokens[i]) for i in range(n)] + [("alone", "other", 0, 5)], "sku_id string, classification string, ord int, token_count long")
    pairs = [(f"s{i:02d}", f"s{j:02d}", float(m[i, j])) for i in range(n) for j in range(i) if m[i, j] > 0] + [("s00", "alone", 0.9)]
    out = clustering.buckets(units, spark.createDataFrame(pairs, "a string, b string, similarity double"), limit, small=12).collect()
    got = {r.sku_id: r.bucket_id for r in out}
    want = {f"s{i:02d}": f"k_bucket_{k:03d}" for k, at in enumerate(clustering.bisect(np.array(tokens), m, limit), 1) for i in at} | {"alone": "other_bucket_001"}
    assert got == want and len(set(want.values())) > 4


def test_class_buckets_cover_parts(spark):
    rows = runs.class_buckets(spark, SMALL).collect()
    total = Counter()
    for r in rows:
        total[r.bucket_id] += r.token_count
    assert len(rows) == spark.read.parquet(f"{SMALL}/part.parquet").count() and max(total.values()) <= 4000


# --- glossary, components, tables


def plain_fold(entries):
    kept = []
    for e in sorted(entries, key=lambda e: e[0]):
        o, term, definition, aliases, related = e
        hit = next((k for k in kept if k["term"].lower() == term.lower() or term.lower() in {a.lower() for a in k["aliases"]}), None)
        if hit is None:
            kept.append({"ord": o, "term": term, "definition": definition, "aliases": list(aliases), "related": list(related)})
            continue
        if len(definition) > len(hit["definition"]):
            hit["definition"] = definition
        hit["related"] += [x for x in dict.fromkeys(related) if x not in hit["related"]]
        for a in aliases:
            if a and a.lower() != hit["term"].lower() and a.lower() not in {x.lower() for x in hit["aliases"]}:
                hit["aliases"].append(a)
    return {k["ord"]: (k["term"], k["definition"], k["aliases"], k["related"]) for k in kept}


@pytest.mark.parametrize("names", [8, 60, 400])
def test_folds_match_a_plain_loop(spark, names):
    rng = random.Random(names)
    name = lambda: rng.choice("aA") + str(rng.randrange(names))
    rows = [(o, name(), "d" * rng.randint(0, 9), [name() if rng.random() < 0.9 else "" for _ in range(rng.randint(0, 2))], [name() for _ in range(rng.randint(0, 3))]) for o in range(300)]
    df = spark.createDataFrame([(o, t, d, [], [], a, r) for o, t, d, a, r in rows], graph._ENTRY).repartition(5)
    got = {r.ord: (r.term, r.definition, r.aliases, r.related_terms) for r in graph.glossary_fold(df).collect()}
    assert got == plain_fold(rows)


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(300)] + [(1000, 1001), (2000, 2000)], "a long, b long")
    got = {r.node: r.component for r in components.connected(links).collect()}
    assert got == {i: 0 for i in range(301)} | {1000: 1000, 1001: 1000}
    assert components.connected(links.limit(0)).collect() == []


def test_tables_are_written_once(spark):
    path = new_folder(spark, "test")
    table_at(spark.range(3).toDF("x"), path)
    assert complete(spark, path) and table_at(spark.range(9).toDF("x"), path).count() == 3
    assert written(spark.range(2).toDF("x")).count() == 2 and path.startswith(shared_dir(spark))
