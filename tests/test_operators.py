"""Operators that SQL can't express, against plain Python."""

import hashlib
import json

import pytest
from pyspark.sql import functions as F

from glyphflow.functions.fingerprints import behavior_signature, ordered_probes, semantic_fingerprint, structural_fingerprint
from glyphflow.functions.kernel import run
from glyphflow.functions.strings import Operation, fused
from glyphflow.operators import candidates, domains, mining, selection, templates
from glyphflow.sources.jsonl import TASK, as_json, read_jsonl
from glyphflow.streaming.rewrites import first_of_each, rewritten


def sha(x):
    return hashlib.sha256(json.dumps(x, ensure_ascii=False, sort_keys=True, separators=(",", ":")).encode()).hexdigest()


def probes(spark, rows):
    df = spark.createDataFrame(rows, "value string, output string, terminating boolean, error string")
    return df.groupBy().agg(ordered_probes().alias("p"))


def test_signature_is_canonical_json(spark):
    rows = [("b", 'x"', True, None), ("", None, False, "execution_step_limit"), ("a", "é", True, None)]
    ordered = sorted(rows, key=lambda r: (len(r[0]), r[0]))
    assert probes(spark, rows).select(behavior_signature(F.col("p"))).first()[0] == sha([{"input": i, "output": o, "terminating": t, "error": e} for i, o, t, e in ordered])


def test_semantic_fingerprint_ignores_names(spark):
    one = probes(spark, [("ab", "xa", True, None)]).select(semantic_fingerprint(F.col("p"), ["a", "b"])).first()[0]
    two = probes(spark, [("ba", "yb", True, None)]).select(semantic_fingerprint(F.col("p"), ["a", "b"])).first()[0]
    assert one == two == sha([{"input": ["I0", "I1"], "output": ["M0", "I0"], "terminating": True, "error": None}])


def test_structural_fingerprint(spark):
    df = spark.createDataFrame([("ab=ba\n(once)=(end)X",), ("bc=cb\n(once)=(end)Y",), ("",)], "p string")
    got = [r[0] for r in df.select(structural_fingerprint(F.col("p"), ["a", "b", "c"])).collect()]
    assert got[0] == got[1] == sha([["I0", "I1", "=", "I1", "I0"], ["(once)", "=", "(end)", "M0"]]) and got[2] == sha([])


def test_two_key_dedup_is_greedy(spark):
    df = spark.createDataFrame([(1, "x", "s"), (2, "y", "s"), (3, "y", "t")], "seq long, a string, b string")
    assert sorted(r["seq"] for r in selection.two_key_dedup(df, "seq", "a", "b").collect()) == [1, 3]


def test_capacity_split_gives_each_split_a_group(spark):
    df = spark.createDataFrame([(g,) for g in "aaaabbbcd"], "g string")
    got = {r["g"]: r["split"] for r in selection.capacity_split(df, "g", {"train": 0.8, "validation": 0.1, "test": 0.1}, 1).collect()}
    assert set(got) == set("abcd") and set(got.values()) == {"train", "validation", "test"}


def test_domain_sizes(spark):
    for zero in (True, False):
        assert domains.exhaustive(spark, "01", 0, 4, zero).count() == domains.domain_size(2, 0, 4, zero)
    assert domains.pool(spark, "ab", 1, 6, 30).count() == 30


def test_baselines_solve_what_they_can(spark):
    tests = [[("a", "b"), ("aa", "bb"), ("c", "c")], [("a", "k"), ("b", "k"), ("c", "k")]]
    df = spark.createDataFrame([(str(i), [{"input": a, "output": b} for a, b in t], 2) for i, t in enumerate(tests)], "id string, tests array<struct<input:string,output:string>>, public int")
    got = {r["baseline"]: (r["public_solved"], r["hidden_solved"]) for r in mining.baselines(df).collect()}
    assert got["identity"] == (0, 0) and got["constant"] == (1, 1) and got["single_rule_search"][1] >= 1


def test_fusion():
    ops = fused([Operation("reverse"), Operation("reverse"), Operation("map", {"mapping": {"a": "bc"}}), Operation("delete", {"symbols": "c"})])
    assert len(ops) == 1 and ops[0].parameters["mapping"] == {"a": "b", "c": ""}


def test_json_lines_are_strict(spark, tmp_path):
    good = '{"id":"1","description":"d","public_tests":[{"input":"a","output":"b"}]}'
    (tmp_path / "x.jsonl").write_text("\n".join([good, "", '{"id":"1"}', '{"id":"1","description":"d","public_tests":[],"more":1}', "[]"]) + "\n")
    got = [r["error"] for r in read_jsonl(spark, str(tmp_path), TASK, strict=False).collect()]
    assert got == [None, "blank line", "missing field", "unknown field", "not a JSON object"]
    with pytest.raises(Exception, match="blank line"):
        read_jsonl(spark, str(tmp_path), TASK).collect()
    (tmp_path / "y").mkdir()
    (tmp_path / "y" / "x.jsonl").write_text(good + "\n")
    assert as_json(read_jsonl(spark, str(tmp_path / "y"), TASK)).first()["value"] == good


def test_stream_equals_batch(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text('{"value":"cba","t":"2024-01-01T00:00:00"}\n{"value":"cba","t":"2024-01-01T00:00:01"}\n{"value":"b","t":"2024-01-01T00:00:02"}\n')
    stream = spark.readStream.schema("value string, t timestamp").json(str(tmp_path / "in"))
    out = rewritten(first_of_each(stream, "value", "t", "1 minute"), "ba=ab\nca=ac\ncb=bc")
    q = out.writeStream.format("memory").queryName("rewrites").option("checkpointLocation", str(tmp_path / "c")).start()
    q.processAllAvailable()
    q.stop()
    assert sorted(r["output"] for r in spark.table("rewrites").collect()) == ["abc", "b"]


def test_candidates_in_free_text(spark):
    texts = ["say <program>\na=b\n</program> ok", "```\nx=y\n```\nthen\n```a2\np=q\nr=s\n```", " a=b ", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r[0] for r in df.select(candidates.extracted(F.col("t"))).collect()] == ["a=b", "p=q\nr=s", "a=b", None]
    long = spark.createDataFrame([("\n" * 40,), ("a=" + "b" * 600,), ("a=b",)], "t string")
    assert [r[0] for r in long.select(candidates.gate(F.col("t"))).collect()] == ["too_many_lines", "too_many_characters", None]


def test_templates_make_programs_that_end(spark):
    made = templates.generate(spark, 5, 30).collect()
    again = templates.generate(spark, 5, 30).collect()
    good = [r["program"] for r in made if r["reason"] is None]
    assert made == again and len(good) == len(set(good)) and len(good) >= 20
    assert {r["template"] for r in made} == set(templates.TEMPLATES)
    for p in good:
        assert run(p, "abcabc", 500, 200)[2] and run(p, "", 500, 200)[2]
    assert run(templates.incremented(__import__("random").Random(1), ""), "1011")[0] == "1100"
    with pytest.raises(ValueError):
        templates.generate(spark, 1, 1, weights=dict.fromkeys(templates.TEMPLATES, 0.0))
