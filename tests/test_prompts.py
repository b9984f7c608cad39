"""Prompts, archives and logs."""

import io
import json
import re
import zipfile

import pytest
from pyspark.sql import functions as F

from tessera import logs
from tessera.operators import prompts
from tessera.sources import archives


def test_templates_have_equal_placeholders():
    for forms in prompts.TEMPLATES.values():
        assert set(re.findall(r"\{(\w+)\}", forms["en"])) == set(re.findall(r"\{(\w+)\}", forms["zh"]))


def test_rendering(spark):
    df = spark.createDataFrame([("x" * 9000, None, "w")], "c string, s string, w string")
    out = df.select(prompts.rendered("confidence", {"content": F.col("c"), "source_chunk": F.col("s"), "web_results": F.col("w")})).first()[0]
    assert out.count("x") == 6000 and "{" not in out
    empty = spark.createDataFrame([(None, "")], "m string, n string").select(prompts.system_prompt(F.col("m"), F.col("n"))).first()[0]
    assert "(no mapping available)" in empty and "(no eureka notes available)" in empty
    long = spark.createDataFrame([("# A\ntext", "n" * 6000)], "m string, n string").select(prompts.system_prompt(F.col("m"), F.col("n"), "zh")).first()[0]
    assert "# A" in long and "text" not in long.split("# A")[1].split("n" * 10)[0] and long.count("n") >= 5000 and "(truncated)" in long


def test_excerpt_and_flags(spark):
    df = spark.range(1).select(F.transform(F.sequence(F.lit(1), F.lit(900)), lambda i: F.struct(i.alias("id"))).alias("e"))
    assert len(json.loads(df.select(prompts.glossary_excerpt(F.col("e"))).first()[0])) == 20
    a = spark.createDataFrame([('{"flagged_pairs": [{"sku_a": "a", "sku_b": "b", "reason": "r"}, {"sku_a": "c"}]}',), ("bad",), (None,)], "a string")
    assert [len(r[0]) for r in a.select(prompts.flagged_pairs(F.col("a"))).collect()] == [1, 0, 0]


def test_archives(spark, tmp_path):
    b = io.BytesIO()
    with zipfile.ZipFile(b, "w") as z:
        z.writestr("a.md", "first")
        z.writestr("x/full.md", "whole")
    assert archives.archive_text(b.getvalue()) == "whole" and archives.archive_text(b"broken") is None and archives.archive_text(None) is None
    assert spark.createDataFrame([(b.getvalue(),)], "c binary").select(archives.archive_texts(F.col("c"))).first()[0] == "whole"
    root = archives.new_skill("do-it", str(tmp_path))
    assert zipfile.ZipFile(archives.packed_skill(str(root))).namelist() == ["do-it/SKILL.md"]
    (root / "SKILL.md").write_text("no front matter")
    with pytest.raises(ValueError):
        archives.packed_skill(str(root))


def test_logs(tmp_path):
    log = logs.stage_logger("chunk", str(tmp_path))
    log.info("done", extra={"fields": {"chunks": 3}})
    assert json.loads(next(tmp_path.glob("chunk_*.json")).read_text())["chunks"] == 3 and "done" in next(tmp_path.glob("chunk_*.log")).read_text()
