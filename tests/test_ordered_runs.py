"""Chunks folded in order, page ledger, paced addresses, delta log and post-processing steps."""

import json
import time
from dataclasses import dataclass

import pytest
from pyspark.sql import functions as F

from tessera.durable import new_folder, written
from tessera.operators import chat, graph
from tessera.plans import stages
from tessera.sources import providers
from tessera.sources.providers import NullProvider
from tessera.streaming import incremental, knowledge


@dataclass
class Narrator(NullProvider):
    """Answers that depend on everything the prompt shows, so any other order or state would tell. Chunk x3 makes its first request raise; notes shrink too much at x5."""

    def complete(self, prompt, system="", temperature=0.3, max_tokens=4000, json_mode=False):
        mark = sum(map(ord, prompt)) % 9973
        if prompt.startswith("List label_paths"):
            if prompt.endswith("text of x3"):
                raise RuntimeError("down")
            return json.dumps({"label_paths": [[f"L{mark % 5}", "a"], [], "no path"], "glossary": [{"term": f"t{mark % 4}"}, {"term": f"T{mark % 4}"}, {}]})
        if prompt.startswith("Update the map"):
            return None if mark % 4 == 0 else json.dumps({"mapping_content": "" if mark % 7 == 0 else f"# map {mark} {{content}}"})
        if "Chunk x5:" in prompt:
            return json.dumps({"updated": True, "notes_content": "tiny"})
        return json.dumps({"updated": "Chunk x4:" in prompt or mark % 2, "notes_content": f"notes {mark} " + "n" * 200})


def one_after_another(chunks):
    """Plain loop over the chunks of each base, and the log's counts."""
    states, rows = {}, []
    for base, place, chunk_id, content, units in sorted(chunks, key=lambda c: (*c[:3], c[3] or "")):
        state = states.get(base) or knowledge.first_state()
        if state["place"] is not None and place <= state["place"]:
            continue
        entry = knowledge.taken(state, place, chunk_id, content or "", units or [], Narrator())
        states[base] = knowledge.applied(state, entry)
        rows.append((base, place, len(states[base]["labels"]), len(states[base]["terms"]), len(states[base]["units"]), entry["notes_refused"]))
    return states, sorted(rows)


def made_chunks():
    rows = [(f"b{k % 3}", k // 3, f"x{k // 3}", f"text of x{k // 3}", [f"- unit {k}"]) for k in range(24)]
    return rows + [("b0", 8, "x8", None, None), ("b1", 2, "x2", "a repeated place", ["- never"])]


def test_prompts_equal_a_plain_loop_also_after_a_stop(spark):
    """All chunks at once, and in two runs over one folder, give the rows and files of a loop."""
    chunks = made_chunks()
    states, want = one_after_another(chunks)
    folder, source = new_folder(spark, "test"), new_folder(spark, "chunks")
    frame = lambda rows: spark.createDataFrame(rows, knowledge.CHUNKS)
    stream = lambda path: spark.readStream.schema(knowledge.CHUNKS).parquet(path)
    frame([c for c in chunks if c[1] < 4]).repartition(2).write.parquet(source)
    knowledge.fold_chunks(spark, stream(source), Narrator(), folder)
    frame([c for c in chunks if c[1] >= 4]).repartition(2).write.mode("append").parquet(source)
    halves = knowledge.fold_chunks(spark, stream(source), Narrator(), folder)
    whole = knowledge.fold_chunks(spark, stream(written(frame(chunks))._written_at), Narrator(), new_folder(spark, "test"))
    for log in (halves, whole):
        assert sorted((r.base, r.place, r.n_labels, r.n_terms, r.n_units, r.notes_refused) for r in log.collect()) == want
        files = {r.base: r for r in knowledge.files_of(log).collect()}
        assert {b: (f.mapping, f.notes, f.total_characters) for b, f in files.items()} == {b: (s["mapping"], s["notes"], len(s["mapping"]) + len(s["notes"])) for b, s in states.items()}
    assert sum(r[-1] for r in want) == 3  # shrunk notes are refused
    assert any("{content}" in s["mapping"] for s in states.values())


def test_notes_rule():
    assert knowledge.notes_fit("x" * 99, "y") and not knowledge.notes_fit("x" * 100, "y" * 49) and knowledge.notes_fit("x" * 100, "y" * 50)


# --- pages


@dataclass
class FlakyReader(NullProvider):
    """Fails on the first attempt at every page and on all attempts at pages that say so; writes down what it is asked."""

    log: str = ""

    def ocr(self, image):
        text = bytes(image).decode()
        with open(self.log, "a") as f:
            f.write(text + "\n")
        with open(self.log) as f:
            tries = f.read().split().count(text)
        if text.startswith("bad"):
            raise OSError("unreadable")
        return None if tries == 1 else f"read {text}"


def test_pages_are_read_once_with_two_attempts(spark, tmp_path):
    pages = spark.createDataFrame([(f"d{d}", p, f"{'bad' if p == 3 else 'page'}-{d}-{p}".encode()) for d in range(3) for p in range(5)] + [("d0", 0, b"page-0-0")], "doc_id string, page int, image binary")
    folder, log = new_folder(spark, "test"), tmp_path / "log"
    first = providers.page_ledger(pages.where("doc_id <> 'd2'"), FlakyReader(log=str(log)), folder, batch=2, tasks=1)
    assert first.count() == 10
    log.write_text("")
    out = providers.page_ledger(pages, FlakyReader(log=str(log)), folder, batch=2, tasks=1)
    assert all("-2-" in x for x in log.read_text().split())  # nothing of the first run is asked again, failed pages included
    want = {(f"d{d}", p): (None if p == 3 else f"read page-{d}-{p}", 2) for d in range(3) for p in range(5)}
    assert {(r.doc_id, r.page): (r.text, r.attempts) for r in out.collect()} == want and out.count() == 15
    assert providers.page_ledger(pages.limit(0), NullProvider(), new_folder(spark, "test")).count() == 0


# --- addresses


def _slow_then_text(url):
    if url.endswith("7"):
        time.sleep(0.3)
    return f"at {time.time()}"


def test_requests_keep_their_distance(spark):
    """Over four tasks, some of which are held up, no two requests are closer than the pause."""
    urls = spark.createDataFrame([(f"https://example.org/{k}", "firecrawl") for k in range(40)], "url string, parser string")
    rows = providers.parsed_urls(urls, {"firecrawl": _slow_then_text}, pause=0.05, tasks=4).collect()
    due = sorted(r.asked_at for r in rows)
    assert len(rows) == 40 and all(r.status == "success" for r in rows)
    assert min(b - a for a, b in zip(due, due[1:], strict=False)) > 0.049
    assert all(float(r.text.split()[1]) >= r.asked_at - 0.001 for r in rows)


def test_address_list_and_files_in_one_table(spark, tmp_path):
    (tmp_path / "a.md").write_text("# A\n\ntext")
    (tmp_path / "b.png").write_bytes(b"x")
    (tmp_path / "urls.txt").write_text("https://example.org/page\n# no\n\nhttps://www.youtube.com/watch?v=abc\nhttps://github.com/o/r\n")
    calls = []

    def video(url):
        calls.append(url)
        raise OSError("no transcript")

    out = stages.parse_all(spark, str(tmp_path), parsers={"firecrawl": lambda u: f"page {u}", "youtube": video}, pause=0.001).collect()
    got = {r.source_path.rsplit("/", 1)[1]: (r.parser_used, r.status, r.text, r.error_message, r.retry_count) for r in out}
    assert got["a.md"][:3] == ("markitdown", "success", "# A\n\ntext") and got["b.png"][1] == "skipped" and len(out) == 5
    assert got["page"] == ("firecrawl", "success", "page https://example.org/page", None, 0)
    assert got["watch?v=abc"] == ("youtube", "failed", None, "no transcript", 1) and "no parser plug-in for repomix" in got["r"][3]


def test_malformed_addresses_fail_quietly():
    assert providers.HttpProvider(pause=0).fetch("no address") is None


# --- deltas


_EDGES = "ord long, subject string, predicate string, object string, source_chunks array<string>"


def test_parts_hold_their_own_rows_only(spark, tmp_path):
    table = incremental.Deltas(spark, str(tmp_path / "t"), graph.edge_upsert, compact=3)
    assert table.read() is None and table.version() == -1
    every = []
    for k in range(9):
        rows = [(10 * k + i, f"S{(k + i) % 5}" if k % 2 else f"s{(k + i) % 5}", "is-a", f"o{i % 2}", [f"c{k}"]) for i in range(4)]
        every += rows
        table.append(spark.createDataFrame(rows, _EDGES), k)
        table.append(spark.createDataFrame([(0, "again", "is-a", "x", ["c"])], _EDGES), k)  # a batch that is there is skipped
        parts = table._whole("part")
        assert all(spark.read.parquet(table._path("part", p)).count() <= 4 for p in parts) and len(parts) <= 3
        want = graph.edge_upsert(spark.createDataFrame(every, _EDGES))
        assert sorted(map(tuple, table.read().collect())) == sorted(map(tuple, want.collect()))
    assert table.version() == 8 and table._whole("base")


@pytest.mark.parametrize("kind", ["part", "base"])
def test_a_crash_leaves_what_was_there(spark, tmp_path, kind):
    table = incremental.Deltas(spark, str(tmp_path / "t"), graph.edge_upsert)
    table.append(spark.createDataFrame([(1, "a", "is-a", "b", ["c"])], _EDGES), 0)
    spark.createDataFrame([(2, "half", "is-a", "written", ["c"])], _EDGES).write.parquet(table._path(kind, 1))
    (tmp_path / "t" / f"{kind}-{1:012d}" / "_SUCCESS").unlink()
    assert [r.subject for r in table.read().collect()] == ["a"] and table.version() == 0
    table.append(spark.createDataFrame([(3, "c", "is-a", "d", ["c"])], _EDGES), 1)
    assert {r.subject for r in table.read().collect()} == {"a", "c"}


# --- steps


def test_steps_go_on_behind_the_last_whole_one(spark):
    units = spark.createDataFrame([("a", 1), ("b", 2)], "sku_id string, n int")
    ran = []

    def step(name, fail=False):
        def work(rows):
            ran.append(name)
            if fail:
                raise RuntimeError(name)
            return rows.withColumn("n", F.col("n") + 1)
        return name, work

    folder = new_folder(spark, "test")
    with pytest.raises(RuntimeError):
        stages.postprocess(units, [step("one"), step("two", fail=True)], folder)
    out = stages.postprocess(units, [step("one"), step("two")], folder)
    assert ran == ["one", "two", "two"] and sorted(r.n for r in out.collect()) == [3, 4]


# --- chats and endpoints


@dataclass
class Talker(NullProvider):
    fails: str = ""

    def chat(self, messages, temperature=0.4, max_tokens=8000):
        last = messages[-1]["content"]
        return None if self.fails and last.startswith(self.fails) else f"# {'|'.join(m['role'][0] for m in messages)}"


def test_chats_end_by_confirmation_limit_and_silence(spark):
    said = [("a", k, "user", f"m{k}") for k in range(8)] + [("b", 0, "user", " "), ("b", 1, "user", "one"), ("b", 2, "assistant", "x"), ("b", 3, "user", "/CONFIRM "), ("b", 4, "user", "late"), ("c", 0, "user", None)]
    messages = spark.createDataFrame(said, "session_id string, seq int, role string, content string")
    sessions = spark.createDataFrame([(s, f"system {s}") for s in "abcd"], "session_id string, system_prompt string")
    folder = new_folder(spark, "test")
    got = {r.session_id: (r.rounds_used, r.confirmed, r.spec) for r in chat.spec_sessions(sessions, messages, Talker(fails="m2"), folder).collect()}
    assert got["a"] == (5, False, "# s|a|u|a|u|a|u|u|a|u|a|u") and got["b"] == (1, True, "# s|a|u|a|u")  # m2 has no reply
    assert got["c"] == got["d"] == (0, False, "# s|a|u")
    again = chat.spec_sessions(sessions, messages, NullProvider(), folder).collect()
    assert {r.session_id: (r.rounds_used, r.confirmed, r.spec) for r in again} == got
    none = chat.spec_sessions(sessions, messages, NullProvider()).collect()
    assert {(r.rounds_used, r.confirmed, r.spec) for r in none} == {(0, False, "")}


def test_endpoint_provider():
    import threading
    from http.server import BaseHTTPRequestHandler, HTTPServer

    class Handler(BaseHTTPRequestHandler):
        def do_POST(self):  # noqa: N802
            body = json.loads(self.rfile.read(int(self.headers["Content-Length"])))
            if self.path.endswith("/embeddings"):
                out = {"data": [{"index": k, "embedding": [float(len(t))]} for k, t in enumerate(body["input"])][::-1]}
            elif body["messages"][-1]["content"] == "broken":
                out = {"choices": []}
            else:
                out = {"choices": [{"message": {"content": f"{body['model']} {len(body['messages'])} {body.get('response_format', {}).get('type')} {self.headers['Authorization']}"}}]}
            data = json.dumps(out).encode()
            self.send_response(200)
            self.send_header("Content-Length", str(len(data)))
            self.end_headers()
            self.wfile.write(data)

        def log_message(self, *args):
            pass

    server = HTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    try:
        p = providers.EndpointProvider(base=f"http://127.0.0.1:{server.server_port}/v1", model="m", key="k", timeout=5)
        assert p.complete("hi", system="be brief", json_mode=True) == "m 2 json_object Bearer k" and p.chat([{"role": "user", "content": "x"}]) == "m 1 None Bearer k"
        assert p.complete("broken") is None and p.embed(["a", "bbb"]) == [[1.0], [3.0]] and "k'" not in repr(p)
        assert providers.EndpointProvider(base=p.base, model="m").complete("hi") is None
    finally:
        server.shutdown()
    assert p.complete("hi") is None


# --- commands and files


def test_single_file_commands(spark, tmp_path, capsys):
    from tessera import cli

    work = tmp_path / "work"
    assert cli.main(["init", str(work)]) == 0 and (work / "input" / "urls.txt").exists() and (work / "output" / "skus").is_dir()
    (work / "input" / "a.html").write_text("<html><body><h1>Title</h1><p>Body text</p></body></html>")
    assert cli.main(["parse-file", str(work / "input" / "a.html"), str(work / "output" / "a.md")]) == 0 and "# Title" in (work / "output" / "a.md").read_text()
    assert cli.main(["parse-file", str(work / "input" / "a.html").replace("a.html", "urls.txt"), str(work / "output" / "u.md")]) == 0
    assert cli.main(["parse-url", "http://127.0.0.1:9/none", str(work / "output" / "n.md")]) == 1
    (work / "output" / "long.md").write_text("# One\n\n" + "word " * 200 + "\n\n# Two\n\n" + "more " * 200)
    assert cli.main(["chunk-file", str(work / "output" / "long.md"), str(work / "output" / "chunks"), "--max-tokens", "260"]) == 0
    files = sorted(f.name for f in (work / "output" / "chunks").glob("long*.md"))
    assert files == ["long_chunk_001.md", "long_chunk_002.md"] and 'title: "One"' in (work / "output" / "chunks" / files[0]).read_text()
    assert "'chunks': 2" in capsys.readouterr().out


def test_relational_files_and_languages(spark, tmp_path):
    from tessera.operators import workspace

    answers = {"key facts": "{}", "key procedures": "{}", "label_paths": json.dumps({"label_paths": [["A", "B"], ["a", "C"]], "relationships": [{"subject": "x", "predicate": "odd", "object": "y"}], "glossary": [{"term": "t", "definition": "d"}]})}
    chunks = spark.createDataFrame([("c1", "text")], "chunk_id string, content string")
    k = stages.extract(chunks, providers.ScriptedProvider({p: [v] for p, v in answers.items()}))
    total = stages.save_relational(k, str(tmp_path))
    lines = {f: [json.loads(x) for p in sorted((tmp_path / "relational" / f"file={f}").glob("part-*")) for x in p.read_text().splitlines()] for f in ("label_tree", "relationships", "glossary")}
    assert [x["path"] for x in lines["label_tree"]] == [["A", "B"], ["A", "C"]] and lines["relationships"][0]["predicate"] == "related-to" and lines["glossary"][0]["term"] == "t"
    assert total == sum(p.stat().st_size for p in (tmp_path / "relational").glob("file=*/part-*")) and "relational-knowledge" in (tmp_path / "relational" / "header.md").read_text()
    counts = spark.createDataFrame([(2, 1, True, 9)], "factual_count int, procedural_count int, has_relational boolean, total_files_copied int")
    assert "- **文件总数**: 9" in workspace.readme(counts, language="zh").first().readme and "- **Relational knowledge**: yes" in workspace.readme(counts).first().readme
