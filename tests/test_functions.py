"""Text functions, responses and edit distance on literals and against plain Python."""

import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tessera.functions import edit_distance, responses, text
from tessera.operators.segmentation import window_parts


def one(spark, column, **values):
    names = list(values)
    return spark.createDataFrame([tuple(values[n] for n in names)], ", ".join(f"{n} string" for n in names)).select(column).first()[0]


@pytest.mark.parametrize("path,want", [("in/a.pdf", "a"), ("in/x/a.b.pdf", "x/a.b"), ("in/x/y/z.md", "x/y_z"), ("in/.hidden", ".hidden"), ("other/q/a.txt", "a"), ("in/x/noext", "x/noext")])
def test_flatten(spark, path, want):
    assert one(spark, text.flatten_path(F.col("p"), "in"), p=path) == want


@pytest.mark.parametrize("raw,want", [("Hello  World_x", "hello-world-x"), ("--A__b--", "a-b"), ("Ä ö", ""), ("x" * 80, "x" * 64)])
def test_hyphen_case(spark, raw, want):
    assert one(spark, text.hyphen_case(F.col("p")), p=raw) == want


def test_paragraph_cut_prefers_blank_lines(spark):
    t = "a" * 150 + "\n\n" + "b" * 20 + ". " + "c" * 20 + "\nd" + "e" * 900
    assert one(spark, text.paragraph_cut(F.col("t"), 400), t=t) == 152
    assert one(spark, text.paragraph_cut(F.col("t"), 400), t="x" * 500) == 400
    assert one(spark, text.paragraph_cut(F.col("t"), 400), t="x" * 150 + "! " + "y" * 30 + "? " + "z" * 900) == 152


def test_rewrite_paths(spark):
    p = re.compile(text.PATH_PREFIX)
    for t in ["/a/b/factual/sku_1", "see (out/procedural/x) and 'q/relational'", "factual/x", "non-factual claim", "meta", "x/meta\n", "", "path/to/meta,"]:
        new, n = text.rewrite_paths(F.col("t"))
        assert one(spark, new, t=t) == p.sub("skus/", t) and one(spark, n, t=t) == len(p.findall(t))


@pytest.mark.parametrize("answer,want", [("```markdown\n# A\n```", "# A"), ("x\n```\nshort\n```\n```py\nlonger one\n```", "longer one"), ("  # Plain \n", "# Plain"), ("```markdown\n a \n``` ```markdown\nb\n```", "a")])
def test_extract_spec(spark, answer, want):
    assert one(spark, text.extract_spec(F.col("t")), t=answer) == want


def test_compress_and_clean_mapping(spark):
    t = "# A\ntext\n**Description:** d\n---\n  ## B\nsku_1 x"
    assert one(spark, text.compress_mapping(F.col("t")), t=t) == "# A\n**Description:** d\n---\n  ## B"
    ids = F.array(F.lit("sku_1"))
    assert one(spark, text.clean_mapping(F.col("t"), ids), t="sku_10\nsku_1 a\nb") == "b"
    assert one(spark, text.clean_mapping(F.col("t"), ids, True), t="sku_10\nsku_1 a\nb") == "sku_10\nb"


@pytest.mark.parametrize("label,where,want", [("risk", "credit risk management", True), ("risk", "asterisk in text", False), ("Credit", "credit-risk management", True), ("c++", "uses c++x", True), ("c++", "uses c++ x", False)])
def test_word_match(spark, label, where, want):
    assert one(spark, text.word_match(F.col("l"), F.col("t")), l=label, t=where) is want


@pytest.mark.parametrize("answer,want", [('{"a": 1}', '{"a":1}'), ('```json\n{"a": 1}\n```', '{"a":1}'), ("```\n[1, 2]\n```", "[1,2]"), ("{'a': 'b'}", '{"a":"b"}'), ("", None), ("no json", None), ("  {\"a\": 1}  ", '{"a":1}')])
def test_json(spark, answer, want):
    assert one(spark, F.to_json(responses.repaired_json(F.col("t"))), t=answer) == want


def test_fields_and_blocks(spark):
    assert one(spark, responses.field_value(F.col("t"), "name"), t='{"name": "test-value", broken') == "test-value"
    assert one(spark, responses.field_value(F.col("t"), "other"), t='{"name": "x"}') is None
    assert responses.json_blocks('a {"x": 1} b {"y": {"z": 2}} {} {bad') == ['{"x": 1}', '{"y": {"z": 2}}']
    assert responses.json_blocks(None) == []
    assert responses.json_blocks("{'a': 1} {\"b\": \"}{\"} {broken {\"c\": 2}") == ['{"a": 1}', '{"b": "}{"}', '{"c": 2}']
    assert one(spark, responses.field_value(F.col("t"), "name"), t="{name: 'it is \\'so\\'', \"name\": \"late\"") == "it is 'so'"
    assert one(spark, responses.field_value(F.col("t"), "name"), t='{"surname": "x", "name": "a \\"b\\"\\nc", ') == 'a "b"\nc'
    assert one(spark, responses.field_value(F.col("t"), "name"), t='{"name": "' + "x\\n" * 5000 + '",') == "x\n" * 5000


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def model_match(needle, hay, floor=0.7):
    best = None
    for i in range(len(hay) - len(needle) + 1):
        d = distance(needle, hay[i:i + len(needle)])
        if 1 - d / len(needle) > floor and (best is None or d < best[0]):
            best = (d, i)
    return best[1] if best else None


@settings(max_examples=60, deadline=None)
@given(st.text("abc ", min_size=1, max_size=8), st.text("abc ", max_size=40))
def test_locate(needle, hay):
    assert edit_distance.locate(needle, hay) == model_match(needle, hay)


def test_best_match_column(spark):
    rng = random.Random(1)
    rows = [("".join(rng.choices("ab c", k=rng.randint(1, 6))), "".join(rng.choices("ab c", k=rng.randint(0, 20)))) for _ in range(60)]
    got = spark.createDataFrame(rows, "n string, h string").select("n", "h", edit_distance.best_match(F.col("n"), F.col("h")).alias("at")).collect()
    assert all(r.at == model_match(r.n, r.h) for r in got)


def test_cut_position(spark):
    def cut(before, after, text):
        return one(spark, edit_distance.cut_position_of(F.col("b"), F.col("a"), F.col("t")), b=before, a=after, t=text)

    assert cut("end of a", "Start", "x end of a   Start b") == 13
    assert cut("end of a", "nowhere at all", "x end of a   Start b") == 10
    assert cut("zzzzzz", "a", "x end of a") is None
    assert cut("end of a", "Start", "x end of a" + " " * 60 + "Start b") == 10
    assert cut("", "a", "x") is None


@settings(max_examples=40, deadline=None)
@given(st.text("ab .\n", max_size=900), st.integers(30, 60))
def test_window_parts(t, budget):
    parts = [c for c, _ in window_parts(t, budget * 4)]
    assert "".join("".join(parts).split()) == "".join(t.split())
    assert all(len(c) // 4 <= budget for c in parts)


def test_window_parts_with_finder():
    found = iter([(150, "One"), None])
    parts = list(window_parts("a" * 150 + "  " + "b" * 900, 400, lambda rest: next(found, None)))
    assert parts[0] == ("a" * 150, "One") and parts[1][0] == "b" * 400


def test_header_and_confidence_line(spark):
    from tessera.operators.resolution import header_markdown, with_confidence

    schema = "name string, classification string, source_chunk string, character_count int, confidence double, related_skus array<string>, description string"
    df = spark.createDataFrame([("n", "factual", "c1", 1500, 0.85, ["a", "b"], "d"), ("n", "factual", "c1", 5, None, None, "d")], schema)
    a, b = (r[0] for r in df.select(header_markdown()).collect())
    assert "- **Characters**: 1,500" in a and "- **Confidence**: 0.85" in a and "- **Related SKUs**: a, b" in a
    assert "Confidence" not in b and "Related" not in b
    zh = df.select(header_markdown("zh")).first()[0]
    assert "- **字符数**: 1,500" in zh and "- **置信度**: 0.85" in zh
    assert one(spark, with_confidence(F.col("h"), F.lit(0.5)), h=a).count("Confidence") == 1
    assert one(spark, with_confidence(F.col("h"), F.lit(0.5)), h="x\n\n") == "x\n- **Confidence**: 0.50\n"
