"""The four stages and the command line on a small folder, with a scripted provider."""

import json

from pyspark.sql import functions as F

from tessera import cli
from tessera.config import Settings
from tessera.operators import graph
from tessera.plans import stages
from tessera.sources import providers


def folder(tmp_path):
    root = tmp_path / "in"
    (root / "sub" / "deep").mkdir(parents=True)
    (root / "a.md").write_text("# One\n" + "x " * 300 + "\n# Two\ny")
    (root / "sub" / "deep" / "b.txt").write_text("plain text. " * 50)
    (root / "sub" / "p.png").write_bytes(b"x")
    (root / "sub" / "t.zip").write_bytes(b"x")
    return str(root)


def test_stages(spark, tmp_path):
    root = folder(tmp_path)
    results = stages.parse(spark, root)
    got = {r.output_name: (r.status, r.error_message) for r in results.collect()}
    assert got["a"] == ("success", None) and got["sub/deep_b"][0] == "success" and got["sub/p"] == ("skipped", "Skipped non-text file: .png") and got["sub/t"] == ("skipped", "Unsupported file type: .zip")
    done = spark.createDataFrame([(f"{root}/a.md", 5)], "path string, length long")
    assert "a" not in {r.output_name for r in stages.parse(spark, root, done=done).collect()}
    chunks = stages.chunk(results, Settings(max_token_length=60))
    rows = chunks.collect()
    assert all(r.estimated_tokens <= 60 for r in rows) and len({r.chunk_id for r in rows}) == len(rows)
    assert {"a_chunk_001", "sub_deep_b_chunk_001"} <= {r.chunk_id for r in rows}
    answers = {"facts": [json.dumps({"facts": [{"name": "f", "description": "a fact about <things>", "content": "c"}]})], "procedures": [json.dumps({"procedures": [{"name": "Do It", "description": "<d>", "body": "b"}]})],
               "relationships": [json.dumps({"label_paths": [["A", "B"]], "relationships": [{"subject": "S", "predicate": "odd", "object": "O"}], "glossary": [{"term": "T", "definition": "d"}]})]}
    k = stages.extract(chunks.where("chunk_index = 0"), providers.ScriptedProvider({p: v for p, v in (("key facts", answers["facts"]), ("key procedures", answers["procedures"]), ("label_paths", answers["relationships"]))}))
    units = {r.sku_id: r for r in k.units.collect()}
    assert set(units) == {"sku_001", "sku_002", "skill_001", "skill_002"} and units["skill_001"].name == "do-it" and units["skill_001"].description == "d" and units["skill_001"].content.startswith("---\nname: do-it\n")
    assert [(r.predicate, len(r.source_chunks)) for r in k.edges.collect()] == [("related-to", 2)] and k.glossary.count() == 1
    assert [r.path for r in graph.leaf_paths(k.labels).collect()] == [["A", "B"]]
    buckets = stages.bucket(k.units, graph.leaf_paths(k.labels).select(F.lit(0).alias("ord"), "path")).collect()
    assert {r.sku_id for r in buckets} == set(units)
    nothing = stages.extract(chunks, providers.NullProvider())
    assert nothing.units.count() == 0 and nothing.edges.count() == 0


def test_command_line(spark, tmp_path, capsys):
    root = folder(tmp_path)
    assert cli.main(["parse", root, str(tmp_path / "parsed")]) == 0
    assert cli.main(["chunk", str(tmp_path / "parsed"), str(tmp_path / "chunks"), "--max-tokens", "60"]) == 0
    assert cli.main(["estimate-tokens", f"{root}/a.md"]) == 0
    units = spark.createDataFrame([("sku_001", "n", "factual", 10, "some description")], "sku_id string, name string, classification string, character_count int, description string")
    units.write.parquet(str(tmp_path / "units"))
    assert cli.main(["show-index", str(tmp_path / "units")]) == 0
    assert cli.main(["bucket", str(tmp_path / "units"), str(tmp_path / "buckets")]) == 0
    (tmp_path / "skus" / "factual" / "sku_001").mkdir(parents=True)
    (tmp_path / "skus" / "factual" / "sku_001" / "content.md").write_text("x")
    (tmp_path / "skus" / "meta").mkdir()
    (tmp_path / "skus" / "meta" / "mapping.md").write_text("in /x/factual/sku_001")
    assert cli.main(["assemble", str(tmp_path / "skus"), str(tmp_path / "work")]) == 0
    assert (tmp_path / "work" / "mapping.md").read_text() == "in skus/factual/sku_001" and (tmp_path / "work" / "README.md").exists()
    assert "Total SKUs: 1" in capsys.readouterr().out


def test_binary_documents_fail_and_tables_become_records(spark, tmp_path):
    import json

    (tmp_path / "a.pdf").write_bytes(b"%PDF-1.7 \x00\x01")
    (tmp_path / "b.docx").write_bytes(b"PK\x03\x04rest")
    (tmp_path / "c.csv").write_text("name,n\nä,1\n,2\n", encoding="utf-8")
    (tmp_path / "d.md").write_text("# Title", encoding="utf-8")
    got = {r.source_path.rsplit("/", 1)[1]: r for r in stages.parse(spark, str(tmp_path)).collect()}
    assert [got[n].status for n in ("a.pdf", "b.docx", "c.csv", "d.md")] == ["failed", "failed", "success", "success"]
    assert "converter" in got["a.pdf"].error_message and got["a.pdf"].text is None
    assert json.loads(got["c.csv"].text) == [{"name": "ä", "n": 1}, {"name": None, "n": 2}]
