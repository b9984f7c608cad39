"""Cases that reviews found: odd rows against a query's SQL, many copies, and how much a plan may grow."""

import os
import pathlib
import random
import re

import duckdb
import numpy as np
import pytest

from tessera.durable import new_folder
from tessera.operators import clustering, graph, judgement
from tessera.operators.numbering import in_batches
from tessera.plans import parts, runs  # noqa: F401  (register their queries)
from tessera.plans.catalog import ORACLES, QUERIES
from tessera.sources.providers import NullProvider
from tessera.streaming import incremental, knowledge
from tests.conftest import SMALL
from tests.oracle import TABLES, spark_rows, sql_rows


def tables(folder, **made):
    """The smallest tables, some of them made by SQL over them."""
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SMALL}/{t}.parquet'")
        if t in made:
            con.execute(f"copy ({made[t]}) to '{folder}/{t}.parquet' (format parquet)")
        else:
            os.symlink(f"{SMALL}/{t}.parquet", f"{folder}/{t}.parquet")
    return str(folder)


def same(spark, name, folder):
    assert spark_rows(QUERIES[name](spark, folder)) == sql_rows(ORACLES[name], folder)


ODD = """select * from documents where doc_id >= 20 union all select i, case when i % 3 = 2 then '你好' || chr(10) || '!' when i % 3 = 1 then 'ab' else '' end, 'en', case when i % 4 < 3 then 'src' || i % 4 end, i % 5 from range(20) r(i)"""


def test_bucket_sums_of_tiny_units(spark, tmp_path):
    """Units of fewer than four characters have no tokens; units without a source are a group of their own."""
    same(spark, "bucket_sums", tables(tmp_path, documents=ODD))


def test_confidence_line_below_a_heading_without_name(spark, tmp_path):
    same(spark, "confidence_lines", tables(tmp_path, documents=ODD))


def test_cut_after_a_refused_answer_keeps_white_space(spark, tmp_path):
    """The marker stands at the start too, so the answer is below the least cut and the window ends at its last line."""
    marker = "this line says forty characters in all. "
    text = f"'{marker}' || repeat('word ', 1400) || '{marker}' || repeat('word ', 150) || chr(10) || repeat('more ', 400)"
    same(spark, "window_cut_requests", tables(tmp_path, documents=f"select i as doc_id, repeat('x', i::int) || {text} as text, 'en' as lang, 's' as source, 9000 as n_chars from range(8) r(i)"))


# --- copies


@pytest.mark.parametrize("small,most", [(100, 100_000), (100, 30)])
def test_copies_are_cut_as_single_units(spark, small, most):
    """Kinds with numbers, in one task or by rounds, against the dense matrix of all units."""
    rng = random.Random(5)
    kinds, n = 25, 60
    m = np.eye(kinds)
    for i in range(kinds):
        for j in range(i):
            m[i, j] = m[j, i] = rng.random() if rng.random() < 0.7 else 0
    kind, tokens = [rng.randrange(kinds) if i % 3 else 0 for i in range(n)], [rng.randint(1, 20) for _ in range(n)]
    units = spark.createDataFrame([(f"s{i:02d}", "k", i, tokens[i], f"kind {kind[i]}") for i in range(n)], "sku_id string, classification string, ord int, token_count long, alike string")
    one = {k: f"s{i:02d}" for i, k in enumerate(kind)}
    pairs = [(one[i], one[j], float(m[i, j])) for i in one for j in one if i > j and m[i, j] > 0]
    out = clustering.buckets(units, spark.createDataFrame(pairs, "a string, b string, similarity double"), 120, small=small, alike="alike", most=most).collect()
    want = clustering.bisect(np.array(tokens), m[np.ix_(kind, kind)], 120)
    assert {r.sku_id: r.bucket_id for r in out} == {f"s{i:02d}": f"k_bucket_{k:03d}" for k, at in enumerate(want, 1) for i in at} and len(want) > 4


def test_class_buckets_write_no_pairs_of_copies(spark, tmp_path, monkeypatch):
    """Three copies of every part: as many links as of one."""
    seen = []
    monkeypatch.setattr(clustering, "buckets", lambda units, pairs, *a, **k: seen.append(pairs.count()) or units)
    for folder in (SMALL, tables(tmp_path, part=COPIES)):
        assert runs.class_buckets(spark, folder).count() > 0
    assert seen[0] == seen[1]


COPIES = "select p_partkey + 100000 * k as p_partkey, * exclude (p_partkey, k) from (select *, unnest(range(3)) as k from part)"


@pytest.mark.parametrize("name", ["label_jaccard", "tfidf_cosine", "weighted_similarity"])
def test_pairs_of_classes_and_their_copies(spark, tmp_path, name):
    """With three copies of every part: the pairs of classes stay as they are, and every part is told by its class."""
    folder = tables(tmp_path, part=COPIES)
    same(spark, name, folder)
    rows, before = QUERIES[name](spark, folder).collect(), QUERIES[name](spark, SMALL).collect()
    assert {(r.a, r.b) for r in rows if not r.copy} == {(r.a, r.b) for r in before if not r.copy}
    parts_ = {r.p_partkey for r in spark.read.parquet(f"{folder}/part.parquet").collect()}
    copies = [r.b for r in rows if r.copy]
    assert len(set(copies)) == len(copies) and len(parts_ - set(copies)) == len({(r.p_name, r.p_brand, r.p_type, r.p_size // 10) for r in spark.read.parquet(f"{SMALL}/part.parquet").collect()})


def test_vector_pairs_in_tiles(spark):
    """Blocks of several tiles against every pair by hand; a null vector has pairs without a value."""
    from tessera.operators import similarity

    rng = random.Random(3)
    rows = [(i, f"b{i % 2}", [rng.gauss(0, 1) for _ in range(4)] if i % 20 else None) for i in range(60)] + [(100, "b0", [0.0] * 4), (101, None, [1.0] * 4)]
    got = {(r.a, r.b): r.vector for r in similarity.vector_pairs(spark.createDataFrame(rows, "id long, block string, v array<double>"), "block", tile=7).collect()}
    length = lambda v: sum(x * x for x in v) ** 0.5 or 1.0
    want = {(i, j): v and w and sum(x * y for x, y in zip(v, w, strict=True)) / length(v) / length(w) for i, b, v in rows for j, c, w in rows if i < j and b == c}
    assert got.keys() == want.keys() and all(got[k] is None if x is None else abs(got[k] - x) < 1e-9 for k, x in want.items())


def shuffled(plan):
    """Rows that the plan of a finished query wrote for its shuffles."""
    name = plan.nodeName()
    inner = [plan.executedPlan()] if name == "AdaptiveSparkPlan" else [plan.plan()] if name.endswith("QueryStage") else [plan.children().apply(i) for i in range(plan.children().size())]
    return sum(map(shuffled, inner)) + (plan.metrics().apply("shuffleRecordsWritten").value() if name == "Exchange" else 0)


def test_vectors_are_sent_no_more_often_in_a_larger_block(spark):
    """Twice the vectors in one block: four times the pairs, all of them there and once, and twice the rows shuffled. Where tiles are held to fewer numbers than that leaves, there are more; some may be empty."""
    from tessera.operators import similarity

    sent = []
    for n, more in ((100, {}), (200, {}), (200, {"held": 40}), (20, {"held": 2})):
        rows = spark.createDataFrame([(i * 7 % 211, "b", [float(i % 5), 1.0, float(i % 3) - 1]) for i in range(n)], "id long, block string, v array<float>")
        out = similarity.vector_pairs(rows, "block", tile=2, **more)
        got = out.collect()
        v = {r.id: np.array(r.v) for r in rows.collect()}
        assert len(got) == len({(r.a, r.b) for r in got}) == n * (n - 1) // 2
        assert all(r.a < r.b and abs(r.vector - v[r.a] @ v[r.b] / np.linalg.norm(v[r.a]) / np.linalg.norm(v[r.b])) < 1e-9 for r in got)
        sent.append(shuffled(out._jdf.queryExecution().executedPlan()))
    assert sent[0] > 0 and sent[1] <= 2.1 * sent[0] and sent[2] > sent[1]


def test_vector_cosine_rounds_as_sql(spark, tmp_path):
    """Cosines of 1/128 with either sign are halves at six digits, and small negative ones keep their sign."""
    made = "select * from (values (1, [1, 0, 0, 0, 0], 1), (2, [1, 127, 15, 5, 2], 1), (3, [-1, 127, 15, 5, 2], 1), (4, [-1, 0, 0, 0, 4000000], 1)) t(vec_id, e, label)"
    folder = tables(tmp_path, embeddings=f"select vec_id::bigint as vec_id, e::float[] as embedding, label from ({made})")
    same(spark, "vector_cosine", folder)
    got = {(r.a, r.b): r.vector for r in QUERIES["vector_cosine"](spark, folder).collect()}
    assert (got[1, 2], got[1, 3], str(got[1, 4])) == (0.007813, -0.007813, "-0.0")


def test_tfidf_shuffles_texts_once_by_id(spark):
    """No shuffle by (document, term): counts, lengths and weights follow the documents."""
    plan = QUERIES["tfidf_weights"](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    keys = re.findall(r"hashpartitioning\(([^)]*)\)", plan)
    assert any("id#" in k for k in keys) and not any("id#" in k and "term#" in k for k in keys)


def test_pages_become_markdown_in_slices(spark):
    """More pages than a slice, nulls among them, in one batch; a slice is what is held as Python strings."""
    from tessera.sources import markup

    pages = [None if i % 10 == 0 else f"<h2>{i}</h2><p>a <b>c</b></p>" for i in range(3 * markup._SLICE + 5)]
    rows = spark.createDataFrame(list(enumerate(pages)), "i int, html string").coalesce(1)
    got = {r.i: r.m for r in rows.select("i", markup.html_to_markdown(rows.html).alias("m")).collect()}
    assert got == {i: markup.markdown_of(p) for i, p in enumerate(pages)}


def test_labels_are_scored_once_a_text(spark):
    """Three units of each text cost no more scored rows than one: texts are made distinct before they meet paths."""
    from tessera.operators import similarity

    units = spark.createDataFrame([(i, f"part {i % 4}", "red small") for i in range(12)] + [(12, None, None)], "sku_id long, name string, description string")
    paths = spark.createDataFrame([(0, ["red", "part"]), (1, ["red", "small"]), (2, ["blue"])], "ord long, path array<string>")
    out = similarity.label_scores(units, paths)
    assert {r.sku_id: (r.label_path, r.label_score) for r in out.collect()} == {i: (["red", "part"], 2) for i in range(12)} | {12: ([], 0)}
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert not re.search(r"Aggregate \[sku_id#\d+L?, ord#", plan)


def test_a_batch_reads_its_own_rows_only(spark):
    """No file is read by two batches, so a run of many batches reads its rows once."""
    files, rows = [], spark.range(1000, numPartitions=3).selectExpr("id", "cast(id AS string) AS s")

    def work(part):
        files.append(part.inputFiles())
        return part

    folder = new_folder(spark, "test")
    in_batches(rows, ["id"], work, folder, 100, 2)
    assert len(files) == 5 and all(files) and len({f for fs in files for f in fs}) == sum(map(len, files))
    out = [sorted(r.id for r in spark.read.parquet(str(p)).collect()) for p in sorted(pathlib.Path(folder.removeprefix("file://")).iterdir())]
    assert out == [list(range(200 * k, 200 * k + 200)) for k in range(5)]
    assert "Join" not in judgement._scores(spark.createDataFrame([], "sku_id string, name string, description string, content string, source_text string"), NullProvider(), judgement.DEFAULTS)._jdf.queryExecution().analyzed().toString()


def test_a_chunk_does_not_go_through_all_units():
    """A list of units is read once, whatever the number of chunks; its text in the prompt is that of all units."""
    class Once(list):
        read = 0

        def __iter__(self):
            self.read += 1
            return super().__iter__()

    class Shown(NullProvider):
        prompts = []

        def complete(self, prompt, *a, **k):
            if prompt.startswith("Update the map") and (not self.prompts or self.prompts[-1] != prompt):
                self.prompts.append(prompt)

    state, model = knowledge.first_state(), Shown()
    state["units"] = units = Once()
    for k in range(6):
        entry = knowledge.taken(state, k, f"c{k}", "text", [f"- {k}a", f"- {k}b"] if k % 2 else [], model)
        state = knowledge.applied(state, entry)
    shown = [p.split("Units:\n")[1].split("\n\nMap:")[0] for p in model.prompts]
    want = [[f"- {i}{x}" for i in range(1, k + 1, 2) for x in "ab"] for k in range(6)]
    assert shown == ["\n".join(w) or "*No units yet.*" for w in want] and state["units"] is units and units.read == 0 and len(units) == 6


def test_equal_edges_are_one_before_the_shuffle(spark, tmp_path):
    """Edges said over and over meet in memory first, and a base by itself is not merged again; spellings and chunks stay those of a plain loop."""
    r = random.Random(7)
    rows = [(k, r.choice("aAbB"), r.choice("pq"), r.choice("xX"), [r.choice("123") for _ in range(r.randrange(1, 3))]) for k in range(400)]
    frame = spark.createDataFrame(rows, "ord long, subject string, predicate string, object string, source_chunks array<string>")
    want = {}
    for k, s, p, o, c in rows:
        e = want.setdefault((s.lower(), p, o.lower()), (k, s, p, o, []))
        e[4].extend(x for x in dict.fromkeys(c) if x not in e[4])
    out = graph.edge_upsert(frame)
    assert sorted(map(tuple, out.collect())) == sorted(want.values())
    assert re.search(r"(?<!Object)HashAggregate", out._jdf.queryExecution().executedPlan().toString())
    table = incremental.Deltas(spark, str(tmp_path / "t"), graph.edge_upsert)
    table.append(frame, 0)
    assert sorted(map(tuple, table.read().collect())) == sorted(want.values()) and "Aggregate" not in table.read()._jdf.queryExecution().analyzed().toString()
