"""Segmentation, graph, clustering, resolution, workspace, sources and incremental runs on small inputs and plain models."""

import json
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import clustering, graph, resolution, routing, segmentation, similarity, workspace
from tessera.sources import providers, readers, subtitles
from tessera.streaming import incremental

# --- segmentation against a recursive walk


def model_sections(t):
    if not t.strip():
        return []
    found = list(re.finditer(r"^(#{1,6})\s+(.+)$", t, re.M))
    if not found:
        return [(0, "", t)]
    out = []
    if found[0].start() > 0 and t[:found[0].start()].strip():
        out.append((0, "", t[:found[0].start()]))
    for m, n in zip(found, [*found[1:], None]):
        out.append((len(m[1]), m[2].strip(), t[m.start():n.start() if n else len(t)]))
    return out


def tok(t):
    return 0 if not t else max(1, len(t) // 4)


def model_chunks(t, budget, name):
    secs = model_sections(t)
    tree, stack = [], []
    for s in secs:
        node = (s, [])
        if s[0] == 0:
            tree.append(node)
            continue
        while stack and stack[-1][0][0] >= s[0]:
            stack.pop()
        (stack[-1][1] if stack else tree).append(node)
        stack.append(node)
    size = lambda n: tok(n[0][2]) + sum(map(size, n[1]))
    text = lambda n: n[0][2] + "".join(map(text, n[1]))
    out = []

    def walk(nodes):
        for n in nodes:
            if size(n) <= budget:
                out.append((n[0][1] or name, text(n)))
            elif n[1]:
                if n[0][2].strip():
                    out.append((n[0][1] + " (Introduction)", n[0][2]))
                walk(n[1])
            else:
                out.append((n[0][1] or "Oversized Section", n[0][2]))

    walk(tree)
    return out


def random_markdown(rng):
    lines = []
    for _ in range(rng.randint(0, 14)):
        lines.append(rng.choice(["#" * rng.randint(1, 6) + " " + rng.choice("abc") * rng.randint(1, 9), "x" * rng.randint(0, 90), "", "not # a header", "```", "####### seven"]))
    return "\n".join(lines)


def test_sections_and_chunks_match_recursive_walk(spark):
    rng = random.Random(3)
    docs = [(i, random_markdown(rng)) for i in range(150)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {}
    for r in segmentation.sections(df).orderBy("doc_id", "seq").collect():
        got.setdefault(r.doc_id, []).append((r.level, r.title, r.content))
    assert all(got.get(i, []) == model_sections(t) for i, t in docs)
    made = {}
    for r in segmentation.header_chunks(df, 30).orderBy("doc_id", "chunk_index").collect():
        made.setdefault(r.doc_id, []).append((r.title, r.content))
    assert all(made.get(i, []) == model_chunks(t, 30, str(i)) for i, t in docs)


def test_all_chunks_within_budget_and_numbered(spark):
    rng = random.Random(4)
    df = spark.createDataFrame([(i, random_markdown(rng) + "\n" + "word. " * rng.randint(0, 200)) for i in range(40)], "doc_id long, text string")
    rows = segmentation.chunks(df, 60).collect()
    seen = {}
    for r in rows:
        assert r.estimated_tokens <= 60
        seen.setdefault(r.doc_id, []).append((r.chunk_index, r.total_chunks))
    assert all(sorted(i for i, _ in v) == list(range(len(v))) and {n for _, n in v} == {len(v)} for v in seen.values())


# --- graph


def test_label_forest(spark):
    rows = [(1, ["Finance", "Risk", "Credit Risk"]), (2, ["finance", "risk", "Market Risk"]), (3, ["FINANCE", "Risk", "credit risk"]), (4, []), (5, ["X", "Y"]), (6, ["A"])]
    nodes = graph.label_nodes(spark.createDataFrame(rows, "ord long, path array<string>"))
    paths = [r.path for r in graph.leaf_paths(nodes).orderBy("ord").collect()]
    assert paths == [["Finance", "Risk", "Credit Risk"], ["Finance", "Risk", "Market Risk"], ["X", "Y"], ["A"]]


def test_edges(spark):
    s = "ord long, subject string, predicate string, object string, source_chunks array<string>, chunk_id string"
    rows = [(1, "Credit Risk", "is-a", "Risk", ["c1"], "c1"), (2, "credit risk", "is-a", "RISK", ["c2", "c1"], "c2"), (3, "Credit Risk", "odd", "Risk", ["c2"], "c2"), (4, None, "is-a", "x", ["c2"], "c2"), (5, "lost", "is-a", "y", ["c2"], "c2")]
    out = graph.edge_upsert(graph.valid_edges(spark.createDataFrame(rows, s))).orderBy("ord").collect()
    assert [(r.subject, r.predicate, r.object, r.source_chunks) for r in out] == [("Credit Risk", "is-a", "Risk", ["c1", "c2"]), ("Credit Risk", "related-to", "Risk", ["c2"])]


def test_glossary_fold_with_aliases(spark):
    s = "ord long, term string, definition string, labels array<string>, source_chunks array<string>, aliases array<string>, related_terms array<string>"
    rows = [(1, "G-SIB", "short", ["Finance"], ["c1"], ["GSIB"], []), (2, "gsib", "a longer definition", ["Bank", "Finance"], ["c2"], ["G-SIB", "Global Bank"], ["x"]),
            (3, "Other", "d", [], ["c1"], [], []), (4, "global bank", "tiny", [], ["c3"], [], ["y"])]
    out = {r.term: r for r in graph.glossary_fold(spark.createDataFrame(rows, s)).collect()}
    assert set(out) == {"G-SIB", "Other"}
    g = out["G-SIB"]
    assert (g.definition, g.labels, g.source_chunks, g.aliases, g.related_terms) == ("a longer definition", ["Finance", "Bank"], ["c1", "c2", "c3"], ["GSIB", "Global Bank"], ["x", "y"])


# --- similarity and clustering


def test_weights():
    assert similarity.effective_weights(has_labels=False, has_vectors=False) == {"literal": 1.0, "label": 0.0, "vector": 0.0}
    w = similarity.effective_weights(has_vectors=False)
    assert w["vector"] == 0 and abs(w["literal"] + w["label"] - 1) < 1e-9 and abs(w["literal"] - 0.4) < 1e-9


def test_label_assignment_takes_whole_words(spark):
    units = spark.createDataFrame([("a", "asterisk-usage", "how to use it"), ("b", "credit-risk-overview", "about risk"), ("c", None, None)], "sku_id string, name string, description string")
    paths = spark.createDataFrame([(1, ["Finance", "Risk"]), (2, ["Credit", "Risk"])], "ord long, path array<string>")
    got = {r.sku_id: r.label_path for r in similarity.label_scores(units, paths).collect()}
    assert got == {"a": [], "b": ["Credit", "Risk"], "c": []}


def test_average_linkage():
    far = np.array([[0, .1, .9, .8], [.1, 0, .85, .9], [.9, .85, 0, .2], [.8, .9, .2, 0]])
    assert clustering.average_linkage_halves(far).tolist() == [0, 0, 1, 1]
    assert clustering.average_linkage_halves(np.ones((4, 4)) - np.eye(4)).tolist() == [0, 0, 0, 0]  # ties: no two clusters
    assert clustering.bisect(np.array([30, 30, 30, 30]), 1 - far, 60) == [[0, 1], [2, 3]]
    assert clustering.bisect(np.array([30] * 4), np.eye(4), 60) == [[0, 1], [2, 3]]
    assert clustering.bisect(np.array([90, 1]), np.eye(2), 60) == [[0], [1]]


# --- resolution


ACTION = "ord long, bucket_id string, sku_a string, sku_b string, action string, deleted_skus array<string>, rewritten_skus array<string>, new_content string, merged_content string"


def test_actions(spark):
    acts = spark.createDataFrame([(1, "b", "s1", "s2", "delete", ["s2", "zz"], [], None, None), (2, "b", "s2", "s3", "rewrite", [], ["s3"], "new", None), (3, "b", "s3", "s4", "merge", ["s3"], [], None, "both"), (4, "b", "s5", "s6", "keep", [], [], None, None)], ACTION)
    units = spark.createDataFrame([(f"s{i}", f"c{i}") for i in range(1, 7)], "sku_id string, content string")
    live = resolution.live_actions(acts)
    assert sorted(r.ord for r in live.collect()) == [1, 3, 4]  # the second pair's s2 is gone
    assert {r.sku_id: r.content for r in resolution.applied(units, live).collect()} == {"s1": "c1", "s4": "both", "s5": "c5", "s6": "c6"}
    r = resolution.dedup_report(live).first()
    assert (r.total_deleted, r.effective_deleted, r.total_merged, r.total_kept) == (3, 2, 1, 1)


@pytest.mark.parametrize("web,penalty,want", [("0.9", "0.1", 0.8), ("2", "0.7", 0.5), ("bad", None, 0.5), (None, "-1", 0.5), ("0.1", "0.4", 0.0)])
def test_confidence(spark, web, penalty, want):
    c, _ = resolution.confidence(F.col("w"), F.lit(None).cast("string"), F.col("p"))
    assert abs(spark.createDataFrame([(web, penalty)], "w string, p string").select(c).first()[0] - want) < 1e-9


def test_source_lookup(spark):
    chunks = spark.createDataFrame([("a_chunk_002", "two"), ("a_chunk_001", "one"), ("b", "bee")], "chunk_id string, content string")
    want = spark.createDataFrame([("1", "b"), ("2", "chunk_00"), ("3", "zz"), ("4", None)], "sku_id string, source_chunk string")
    got = {r.sku_id: r.source_text for r in resolution.source_lookup(want, chunks).collect()}
    assert got == {"1": "bee", "2": "one", "3": None, "4": None}


def test_global_numbers(spark):
    from tessera.operators.numbering import numbered_globally

    rows = numbered_globally(spark.range(1000).select((F.col("id") * 7919 % 1000).alias("k")).repartition(7), ["k"], "no", 5).collect()
    assert sorted((r.k, r.no) for r in rows) == [(i, i + 5) for i in range(1000)]
    assert numbered_globally(spark.range(0), ["id"], "no").count() == 0


def test_content_probe_and_numbers(spark):
    files = spark.createDataFrame([("s1", "content.json", "j"), ("s1", "content.md", "m"), ("s2", "SKILL.md", "k"), ("s3", "x.md", "n")], "sku_id string, name string, content string")
    units = spark.createDataFrame([("s1",), ("s2",), ("s3",)], "sku_id string")
    assert {r.sku_id: r.content for r in resolution.content_of(units, files).collect()} == {"s1": "m", "s2": "k", "s3": None}
    assert resolution.next_number(spark.createDataFrame([("sku_007",), ("sku_x",), ("sku_1200",)], "sku_id string")).first()[0] == 1201
    assert resolution.next_number(spark.createDataFrame([], "sku_id string")).first()[0] == 1


# --- workspace, chat, skills


def test_chat(spark):
    rows = [(1, 0, "user", "a"), (1, 1, "assistant", "b"), (1, 2, "user", " "), (1, 3, "user", "/CONFIRM"), (1, 4, "user", "late")] + [(2, i, "user", "x") for i in range(8)] + [(3, 0, "system", "s")]
    got = {r.session_id: (r.rounds_used, r.confirmed, r.finalized_by) for r in workspace.chat_rounds(spark.createDataFrame(rows, "session_id long, seq long, role string, content string")).collect()}
    assert got == {1: (1, True, "confirm"), 2: (5, False, "limit"), 3: (0, False, "end")}


def test_transcript_and_pages(spark):
    seg = spark.createDataFrame([("v", 1, " Hello"), ("v", 2, "world."), ("v", 3, ""), ("v", 4, "End")], "video_id string, seq int, text string")
    assert [r.text for r in workspace.transcript_paragraphs(seg).orderBy("paragraph").collect()] == ["Hello world.", "End"]
    ocr = spark.createDataFrame([("p", 0, "one", True), ("p", 1, None, True), ("p", 2, None, None)], "source_path string, page int, text string, done boolean")
    r = workspace.ocr_markdown(ocr).first()
    assert r.markdown == "one\n\n---\n\n<!-- OCR failed: page 2 -->\n\n---\n\n<!-- OCR missing: page 3 -->" and r.failed_pages == 1
    parts = spark.createDataFrame([("p", 2, "b"), ("p", 1, "a")], "source_path string, part int, md string")
    assert workspace.split_markdown(parts).first().markdown == "a\n\n---\n\n# Part 2\n\nb"


def test_manifest_and_readme(spark):
    files = spark.createDataFrame([("factual/sku_1/content.md", "x"), ("factual/sku_1/header.md", "x"), ("procedural/skill_1/SKILL.md", "x"), ("relational/glossary.json", "{}"), ("meta/mapping.md", "see /o/factual/sku_1"), ("junk/x", "x")], "path string, content string")
    out = workspace.assembled(files)
    m = workspace.manifest(out)
    r = m.first()
    assert (r.factual_count, r.procedural_count, r.has_relational, r.has_mapping, r.has_eureka, r.total_files_copied, r.paths_rewritten) == (1, 1, True, True, False, 5, 1)
    assert out.where("target = 'mapping.md'").first().content == "see skus/factual/sku_1"
    assert "- **Factual SKUs**: 1" in workspace.readme(m).first()[0]


# --- routing and sources


def test_routes(spark):
    urls = [("https://www.youtube.com/watch?v=abc", "youtube"), ("https://youtu.be/abc", "youtube"), ("https://b23.tv/x", "bilibili"), ("https://github.com/o/r", "repomix"), ("https://github.com/o/r/issues", "firecrawl"), ("https://github.com/o/pull-x", "firecrawl"), ("https://github.com/o/r.js", "firecrawl"), ("https://x.org", "firecrawl")]
    got = spark.createDataFrame([(u,) for u, _ in urls], "url string").select("url", routing.url_parser(F.col("url")).alias("p")).collect()
    assert [(r.url, r.p) for r in got] == urls


def test_ranges(spark):
    df = spark.createDataFrame([("a", 950, 400)], "path string, pages int, per int")
    assert [(r.first, r.end) for r in routing.page_ranges(df).orderBy("part").collect()] == [(0, 400), (400, 800), (800, 950)]


def test_readers(spark, tmp_path):
    (tmp_path / "in" / ".git").mkdir(parents=True)
    for name, body in {"in/a.md": "# A", "in/_b.txt": "b", "in/.env": "x", "in/.git/c.md": "c", "in/urls.txt": "# no\n\n https://x.org \nhttps://x.org\n", "in/t.csv": "a,b\n1,x\n,y\n"}.items():
        (tmp_path / name).write_text(body)
    root = str(tmp_path / "in")
    names = {r.path.rsplit("/", 1)[1] for r in readers.list_files(spark, root).collect()}
    assert {"a.md", "t.csv"} <= names and not names & {".env", "c.md", "urls.txt"}
    assert readers.list_files(spark, root + "/none").count() == 0
    assert [r.url for r in readers.read_url_list(spark, root + "/urls.txt").collect()] == ["https://x.org"] * 2
    assert [r.text for r in readers.read_texts(spark, root + "/a.md").collect()] == ["# A"]
    assert [r.record for r in readers.read_csv_records(spark, root + "/t.csv").collect()] == ['{"a":1,"b":"x"}', '{"a":null,"b":"y"}']
    files = routing.routed_files(readers.list_files(spark, root, content=True))
    got = {r.source_path.rsplit("/", 1)[1]: (r.status, r.text) for r in providers.parsed_files(files, providers.text_converters()).collect()}
    assert got["a.md"] == ("success", "# A") and got["t.csv"][0] == "success"
    assert json.loads(got["t.csv"][1]) == [{"a": 1, "b": "x"}, {"a": None, "b": "y"}]
    broken = spark.createDataFrame([("x.xlsx", b"no workbook")], "path string, content binary")
    assert readers.read_excel_records(spark, broken).first().error


def test_index_round_trip(spark, tmp_path):
    path = str(tmp_path / "index")
    for n in (1, 2):
        readers.write_index(spark.createDataFrame([(f"sku_{n}",)], "sku_id string"), path)
        assert spark.read.parquet(path).first()[0] == f"sku_{n}"
    assert readers.read_sku_index(spark, str(tmp_path / "none"), create=True).count() == 0
    with pytest.raises(FileNotFoundError):
        readers.read_sku_index(spark, str(tmp_path / "none"))
    (tmp_path / "c.json").write_text('{"chunks": [{"chunk_id": "b"}, {"chunk_id": "a"}]}')
    assert [r.chunk_id for r in readers.read_chunk_index(spark, str(tmp_path / "c.json")).collect()] == ["a", "b"]


def test_subtitles(spark):
    srt = spark.createDataFrame([("v", "1\n00:00:01,500 --> 00:00:02,000\n<i>Hi</i>\nthere\n\n2\nshort")], "video_id string, data string")
    assert [(r.text, r.start) for r in subtitles.srt_segments(srt).collect()] == [("Hi there", 1.5)]
    vtt = spark.createDataFrame([("v", "WEBVTT\n\n00:00:03.250 --> 00:00:04.000\nHello")], "video_id string, data string")
    assert [(r.text, r.start) for r in subtitles.vtt_segments(vtt).collect()] == [("Hello", 3.25)]
    assert subtitles.parse_subtitle('{"events": [{"tStartMs": 1500, "segs": [{"utf8": "a"}, {"utf8": "b"}]}]}', "json3") == [{"text": "ab", "start": 1.5}]
    assert subtitles.parse_subtitle("<x><p t='500'>q</p></x>", "srv3") == [{"text": "q", "start": 0.5}]
    assert subtitles.parse_subtitle("{bad", "json3") is None


def test_providers(spark):
    p = providers.ScriptedProvider({"ask": ["not json", '{"a": 1}'], "none": [None]})
    assert providers.complete_json(p, "ask me") == {"a": 1} and p.calls[1]["temperature"] < p.calls[0]["temperature"]
    assert providers.complete_json(p, "none") is None and p.calls[-1]["json_mode"] is False
    assert providers.complete_json(providers.NullProvider(), "x") is None
    rows = spark.createDataFrame([(1, "ask"), (2, "zzz")], "id long, prompt string")
    got = {r.id: r.answer for r in providers.answers(rows, providers.ScriptedProvider({"ask": ['{"a": 1}']}), "id", "prompt").collect()}
    assert got == {1: '{"a": 1}', 2: None}


# --- incremental runs


def test_incremental_graph_resumes(spark, tmp_path):
    schema = "ord long, subject string, predicate string, object string, source_chunks array<string>, chunk_id string"
    src, out, ck = (str(tmp_path / x) for x in ("src", "out", "ck"))
    spark.createDataFrame([(1, "A", "is-a", "B", ["c1"], "c1")], schema).write.parquet(src)
    assert incremental.accumulate_graph(spark, src, schema, out, ck).count() == 1
    spark.createDataFrame([(2, "a", "is-a", "b", ["c2"], "c2"), (3, "X", "is-a", "Y", ["c2"], "c2")], schema).write.mode("append").parquet(src)
    rows = incremental.accumulate_graph(spark, src, schema, out, ck).orderBy("ord").collect()
    assert [(r.subject, r.source_chunks) for r in rows] == [("A", ["c1", "c2"]), ("X", ["c2"])]
    assert incremental.accumulate_graph(spark, src, schema, out, ck).count() == 2


def test_resume_by_full_path(spark):
    files = spark.createDataFrame([("a/x.pdf",), ("a/x.docx",)], "path string")
    out = spark.createDataFrame([("a/x.pdf", 10), ("a/x.docx", 0)], "path string, length long")
    todo, done = incremental.resumed(files, out)
    assert [r.path for r in todo.collect()] == ["a/x.docx"] and [r.path for r in done.collect()] == ["a/x.pdf"]
