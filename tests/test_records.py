"""Artifacts, schemas, labels, the solving loop and auxiliary records against plain Python."""

import json
import sys

import pytest
from pyspark.sql import functions as F

from glyphflow.functions import labels
from glyphflow.functions import programs as P
from glyphflow.functions.kernel import rewrite, run, strict, traced
from glyphflow.functions.native import closed_form
from glyphflow.operators import auxiliary, domains, mining, quality, solver, templates
from glyphflow.plans import record_queries as Q
from glyphflow.plans import relational_queries as R
from glyphflow.sources import artifacts, jsonl, records


def test_json_documents_and_reports(spark, tmp_path):
    path = str(tmp_path / "x" / "d.json")
    artifacts.put_document(spark, path, {"b": [1, "é"], "a": None})
    assert open(path).read() == '{\n  "a": null,\n  "b": [\n    1,\n    "é"\n  ]\n}\n' and artifacts.get_document(spark, path) == {"b": [1, "é"], "a": None}
    with pytest.raises(ValueError):
        artifacts.put_document(spark, path, float("nan"))
    text = artifacts.report("T", {"counts": {"a": 1, "b|c": [2]}, "rows": [{"x": 1}, {"x": 2, "y": "z"}], "plain": 3})
    assert text.startswith("# T\n\n## counts\n\n| Key | Value |\n| --- | --- |\n| a | 1 |\n| b\\|c | [2] |\n") and "| x | y |\n| --- | --- |\n| 1 |  |\n| 2 | z |" in text and text.endswith("## plain\n\n3\n")
    assert artifacts.collected({"one": spark.range(1), "two": spark.range(2)}) == {"one": {"id": 0}, "two": [{"id": 0}, {"id": 1}]}


def test_task_folders(spark, tmp_path):
    for name, program, pre, full in (("t-1", "a=b\n", [("a", "b")], [("a", "b"), ("c", "c"), ("c", "c"), ("aa", "bb")]), ("t-2", "x=", [("", "")], [("x", "")])):
        d = tmp_path / name
        d.mkdir()
        (d / "solution.rules").write_text(program)
        (d / "task.jsonl").write_text(json.dumps({"id": name, "title": f"T {name}", "constraints": {"alphabet": ["a"]}}) + "\n")
        for part, cases in (("pretest", pre), ("full", full)):
            (d / f"testcase_{part}.jsonl").write_text("".join(json.dumps({"input": i, "output": o}) + "\n" for i, o in cases))
    got = {r["task"]: r for r in artifacts.tasks(spark, str(tmp_path)).collect()}
    cases = lambda x: [(t["input"], t["output"]) for t in x]
    assert set(got) == {"t-1", "t-2"} and got["t-1"]["program"] == "a=b" and got["t-1"]["title"] == "T t-1" and json.loads(got["t-1"]["constraints"]) == {"alphabet": ["a"]}
    assert cases(got["t-1"]["public_tests"]) == [("a", "b")] and cases(got["t-1"]["hidden_tests"]) == [("c", "c"), ("aa", "bb")] and cases(got["t-2"]["hidden_tests"]) == [("x", "")]
    assert artifacts.golden_cases(spark, str(tmp_path)).where("task = 't-1' and part = 'full'").count() == 4


def test_data_sets_are_replaced_only_if_they_are_ours(spark, tmp_path):
    rows = spark.createDataFrame([("1", "train", "d", [{"input": "a", "output": "b"}], 1.5), ("2", "test", None, [], 2.0)], "id string, split string, description string, public_tests array<struct<input:string,output:string>>, secret double")
    aux = spark.createDataFrame([("1", "train", "trace"), ("2", "test", "repair")], "root string, split string, type string")
    root = str(tmp_path / "set")
    for _ in range(2):
        artifacts.write_artifacts(rows, aux, root, {"n": {"rows": 2}})
    back = artifacts.read_artifacts(spark, root, "id string, description string, public_tests array<struct<input:string,output:string>>, secret double")
    assert sorted(map(tuple, back.collect())) == sorted([("1", "d", [("a", "b")], 1.5, "train"), ("2", None, [], 2.0, "test")])
    public = spark.read.text(f"{root}/public").collect()
    assert len(public) == 2 and not any("secret" in r["value"] for r in public) and artifacts.get_document(spark, f"{root}/statistics.json") == {"n": {"rows": 2}}
    assert {(r["split"], r["type"]) for r in spark.read.text(f"{root}/auxiliary").collect()} == {("train", "trace"), ("test", "repair")}
    (tmp_path / "other").mkdir()
    with pytest.raises(FileExistsError):
        artifacts.write_artifacts(rows, aux, str(tmp_path / "other"))
    with pytest.raises(Exception, match="JSON doesn't have"):
        jsonl.write_jsonl(spark.createDataFrame([("a", float("inf"))], "k string, x double"), str(tmp_path / "bad"), by="k")


def test_errors_name_file_and_line(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"id":"1","description":"d","public_tests":[]}\n{"id":1}\n')
    with pytest.raises(Exception, match=r"a\.jsonl:2: missing field"):
        jsonl.read_jsonl(spark, str(tmp_path), jsonl.TASK, numbered=True).collect()
    got = jsonl.read_jsonl(spark, str(tmp_path), jsonl.TASK, strict=False, numbered=True).orderBy("line").collect()
    assert [(r["line"], r["error"]) for r in got] == [(1, None), (2, "missing field")]


def test_what_is_no_record(spark):
    df = spark.createDataFrame([(x,) for x in (None, "", "x", "[1]", "1", '{"a":NaN}', "{}")], "raw string")
    got = [r[0] for r in df.select(records.record_errors(F.col("raw"))).collect()]
    assert got[:6] == [["object"]] * 6 and got[6] == [f"missing:{f}" for f in sorted(records.REQUIRED)]
    with pytest.raises(Exception, match="missing:algorithm_family"):
        artifacts.checked(df.where("raw = '{}'"), records.record_errors).collect()
    raw = records.unflattened(spark.createDataFrame([("x", ["a"], None)], "description string, concepts array<string>, id string")).first()["raw"]
    assert json.loads(raw) == {"description": "x", "concepts": ["a"]}


def spread(df):
    """Whether the rows of a plan reach the Arrow function over an exchange, and the parser is named once at most."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return 0 <= plan.find("ArrowEvalPython") < plan.find("Exchange") and plan.count("parseJson") <= 1


def odd(field, new):
    return Q._json(field, new).replace("#", "1")


def test_hardened_records_are_parsed_once_and_whole(spark):
    assert spread(Q.QUERIES["schema_hardened"](spark, "/root/testdata/sf0.001"))
    lines = [odd("public_tests", '["{\\"input\\":\\"a\\",\\"output\\":\\"b\\"}"]'), odd("dead_components", '["0"]'), odd("effective_components", '["0"]'), odd("dead_components", "[99999999999999999999]"), odd("dead_components", "[true]"), odd("id", '"1"') + "x", odd("\\ud800", "1"), odd("limits", '{"a":1,"a":2}'), odd("limits", "null"), odd("id", '"é"')]
    df = spark.createDataFrame(list(enumerate(lines)), "i int, raw string").select("i", records.record_errors(F.col("raw"), "hardened").alias("e"))
    assert [r["e"] for r in df.orderBy("i").collect()] == [["public_tests"], ["dead_components"], ["effective_components"], [], ["dead_components"], ["object"], ["unknown:?"], ["object"], ["limits"], []]


def test_flattened_records_are_checked_in_many_tasks(spark):
    assert spread(Q.QUERIES["record_flatten"](spark, "/root/testdata/sf0.001"))
    lines = [(odd("id", '"é"'),), (odd("concepts", '["a","b"]'),), (odd("hidden_tests", '[{"output":"b","input":"a"}]'),)]
    got = sorted(records.flattened(spark.createDataFrame(lines, "raw string")).collect(), key=lambda r: (r["id"], r["concepts"]))
    assert [(r["id"], r["concepts"], [tuple(t) for t in r["hidden_tests"]], [tuple(t) for t in r["public_tests"]]) for r in got] == [("1", ["a", "b"], [], [("ab", "ba")]), ("1", ["reverse"], [("a", "b")], [("ab", "ba")]), ("é", ["reverse"], [], [("ab", "ba")])]
    assert {(r["depth"], r["score"], r["program"], r["audit_length"], r["level"]) for r in got} == {(2, 0.25, "ab=ba", 6, "functional")}


def test_cognitive_records_are_parsed_once(spark):
    assert spread(Q.QUERIES["schema_cognitive"](spark, "/root/testdata/sf0.001"))
    lines = [odd("memory_model", "null"), odd("parameter_instance", "[]"), odd("composition_component_probe", '{"all_components_effective":"no"}'), odd("composition_component_probe", "[]"), odd("cognitive_family", '"x"') + "{}"]
    df = spark.createDataFrame(list(enumerate(lines)), "i int, raw string").select("i", records.record_errors(F.col("raw"), "cognitive").alias("e"))
    assert [r["e"] for r in df.orderBy("i").collect()] == [["memory_model"], ["parameter_instance"], ["composition_component_probe"], ["composition_component_probe"], ["object"]]


def test_cognitive_records_are_checked_in_few_calls(spark):
    line, calls = odd("id", '"1"'), []
    sys.setprofile(lambda frame, event, arg: calls.append(frame) if event == "call" else None)
    try:
        good = records.line_errors(line, "cognitive")
    finally:
        sys.setprofile(None)
    assert good == [] and len(calls) <= 50
    flaws = {"description": 1, "concepts": [[]], "semantic_fingerprint": "a" * 64 + "\n", "composition_depth": True, "public_tests": [{"input": "a", "output": "b", "x": ""}], "limits": [], "standard_answer": None, "dead_components": [True], "effective_composition_depth": 1.0, "order_sensitive": None, "solution_revealing_score": True, "audit_domain": {"min_length": False, "max_length": 1}, "memory_model": None, "parameter_instance": None, "composition_component_probe": {}}
    found = records.line_errors(json.dumps(json.loads(line) | flaws), "cognitive")
    assert set(found) == {*flaws, "declared_composition_depth"} and found[:4] == ["description", "concepts", "semantic_fingerprint", "composition_depth"] and found[-3:] == ["memory_model", "parameter_instance", "composition_component_probe"]


def test_records_of_keys_are_joined_from_pieces(spark):
    df = Q.flawed(spark, "/root/testdata/sf0.001")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "array_join(" in plan and "replace(" not in plan
    rows = df.collect()
    assert len(rows) == 150 and all(r["raw"] == Q._json(*Q.FLAWS[r["c_custkey"] % len(Q.FLAWS)][:2]).replace("#", str(r["c_custkey"])) for r in rows)


def test_strict_runs_and_traces(spark):
    df = spark.createDataFrame([("ab",), ("é",), ("a\nb",), (None,), ("a" * 1001,)], "v string")
    run_ = lambda v, program=P.DELETE: [r[0] for r in df.where(F.col("v").eqNullSafe(v)).select(strict(rewrite(program, F.col("v")), F.col("v"))).collect()]
    assert run_("ab") == ["x"] and run_(None) == [None]
    for bad, said in (("é", "one line of ASCII"), ("a\nb", "one line of ASCII"), ("a" * 1001, "String Length Limit")):
        with pytest.raises(Exception, match=said):
            run_(bad)
    with pytest.raises(Exception, match="syntax_error"):
        run_("ab", "a")
    t = spark.createDataFrame([("a", "a"), (None, "a"), ("a=b", None), ("a=b", "a")], "p string, v string").select(traced(F.col("p"), F.col("v")).alias("t")).select("t.*").collect()
    assert [r["status"] for r in t] == ["syntax_error", None, None, "halted"] and t[0]["trace"] == [] and len(t[3]["trace"]) == 1
    grown = spark.createDataFrame([("a" * 499,), ("a" * 501,), ("x" * 1001,)], "v string").select(closed_form("a=bb", F.col("v")).alias("o")).collect()
    assert [r["o"] and len(r["o"]) for r in grown] == [998, None, None] and run("a=bb", "a" * 501)[3] == "string_length_limit"


def test_auxiliary_values(spark):
    cases = R.problem_cases(spark, "").where(F.length("input") <= 3)
    for r in auxiliary.traces(cases).collect():
        log = []
        _, steps, done, _ = run(r["program"], r["input"], 2000, 256, log)
        assert r["status"] == "halted" and done and [t.asDict() for t in r["trace"]] == log and len(log) == steps
    for r in auxiliary.completion(cases, 7).collect():
        whole = r["incomplete_program"].replace("<MISSING_RULE>", r["missing_rule"])
        assert whole == P.FIVE[r["problem_id"]] and whole.split("\n")[r["missing_rule_index"]] == r["missing_rule"]
    view = jsonl.public_view(spark.createDataFrame([("1", "d", ["p"], ["h"])], "id string, description string, public_tests array<string>, hidden_tests array<string>"))
    assert view.columns == ["id", "description", "public_tests"] and view.first()["public_tests"] == ["p"]


def test_mined_programs_differ_and_end(spark):
    got = mining.mine(spark, 3, 30, alphabets=("ab",)).collect()
    assert 10 < len(got) <= 30 and len({r["signature"] for r in got}) == len({r["structure"] for r in got}) == len(got)
    values = [r["value"] for r in domains.exhaustive(spark, "ab", 0, 3).collect()]
    for r in got:
        outputs = [run(r["program"], v, 100, 6) for v in values]
        assert all(done for *_, done, _ in outputs) and len({o for o, *_ in outputs}) > 1 and any(o != v for (o, *_), v in zip(outputs, values, strict=True))
        assert set(filter(None, r["cluster"].split("+"))) <= set(mining.PROPERTIES)


def test_properties_of_programs(spark):
    rows = [("drop", v, v.replace("a", ""), v.replace("a", "")) for v in ("", "a", "ab", "ba")] + [("twice", v, v + v, v * 4) for v in ("", "a", "ab")]
    df = spark.createDataFrame([(n, v, o, True, g) for n, v, o, g in rows], "name string, value string, output string, terminating boolean, again string")
    got = {r["name"]: r.asDict() for r in quality.behavior_properties(df, "name", "ab").collect()}
    assert got["drop"]["idempotent"] and got["drop"]["possible_normalizer"] and not got["drop"]["length_preserving"] and got["twice"]["length_increasing"] and not got["twice"]["idempotent"] and got["twice"]["alphabet_preserving"]


def test_templates_in_use(spark):
    assert set(templates.enabled({"once_delete": 0.0}, without={"anchored_trim"})) == set(templates.TEMPLATES) - {"once_delete", "anchored_trim"} and templates.enabled(only={"once_delete"}) == {"once_delete": 1.0}
    with pytest.raises(ValueError, match="no such"):
        templates.enabled(only={"x"})
    df = spark.createDataFrame([("t", "1", "a=b"), ("", "1", "a=b"), ("t", None, "a=b"), ("t", "1", "a=b\n" * 32 + "a=b"), ("t", "1", "a=" + "b" * 600), ("t", "1", "a")], "template string, version string, program string")
    assert [r[0] for r in df.select(templates.generated_gate(df)).collect()] == [None, "provenance", "provenance", "too_many_lines", "too_many_characters", "syntax"]
    row = templates.described(df).first()
    assert (row["features"], row["lines"], row["difficulty"]) == ([], 1, 2)


def test_markers_are_renamed_to_new_ones(spark):
    df = spark.createDataFrame([("(once)=X\nXa=bX\nX=", ["X"]), ("!X=@", ["X", "@"]), ("a=b", [])], "p string, m array<string>")
    assert [r[0] for r in df.select(labels.renamed_markers(F.col("p"), F.col("m"))).collect()] == ["(once)=!\n!a=b!\n!=", "!$=%", "a=b"]


def test_solving_takes_rounds(spark):
    got = {(r["id"], r["round"]): (r["failure"], r["cached"], r["disclosed"]) for r in Q.solving(spark, "").collect()}
    assert got["sort", 0] == got["swap", 0] == (None, False, False) and ("sort", 1) not in got
    assert got["moves", 0] == ("syntax", False, False) and got["moves", 1] == ("syntax", True, False)  # the same question has its answer
    assert got["collapse", 0][0] == "public" and got["collapse", 1] == (None, False, True)


def test_verification_cache_and_counterexamples(spark, tmp_path):
    case = lambda *pairs: [{"input": a, "output": b} for a, b in pairs]
    kinds = "array<struct<input:string,output:string>>"
    problems = spark.createDataFrame([(i, "p" + i, "a=b", case(("a", "b")), case(("aa", "bb"))) for i in ("ok", "line", "char", "syntax", "public", "hidden")], f"id string, prompt string, reference string, public_tests {kinds}, hidden_tests {kinds}")
    tried = {"ok": "a=b", "line": "a=b\n" * 33, "char": "a=" + "b" * 600, "syntax": "a", "public": "a=c", "hidden": "(once)a=b"}
    attempts = spark.createDataFrame(list(tried.items()), "id string, program string")
    got = {r["id"]: (r["failure"], r["case"]) for r in solver.verified(attempts, problems).collect()}
    assert {k: v[0] for k, v in got.items()} == {"ok": None, "line": "line_limit", "char": "character_limit", "syntax": "syntax", "public": "public", "hidden": "hidden"}
    assert tuple(got["public"][1]) == ("a", "b") and got["hidden"][1] is None
    pool = spark.createDataFrame([(1, "a"), (2, "aa"), (3, "b"), (4, "aaa"), (5, "aaaa")], "seq int, value string")
    fresh = solver.counterexamples(attempts.where("id = 'hidden'"), problems, pool).collect()
    assert [(r["id"], tuple(r["case"])) for r in fresh] == [("hidden", ("aaa", "bbb"))]
    cache, calls = solver.Cache(spark, str(tmp_path / "cache")), []

    class Provider:
        name = "counting"

        def complete(self, requests):
            calls.append(requests.count())
            return requests.select("id", F.lit("a=b").alias("answer"))

    asked = problems.select("id", "prompt")
    assert {r["cached"] for r in cache.complete(Provider(), asked).collect()} == {False} and {r["cached"] for r in cache.complete(Provider(), asked).collect()} == {True} and calls == [6, 0]
    levels = solver.solved_by_level(spark.createDataFrame([("a", None), ("a", "x"), ("b", "x")], "id string, failure string"), spark.createDataFrame([("a", "io_only"), ("b", "io_only"), ("c", "io_only")], "id string, level string"))
    assert tuple(levels.first()) == ("io_only", 2, 1, 0.5)


def test_proposals(spark):
    good = {k: "x" for k in solver.PROPOSAL} | {"concepts": ["a", "b"], "input_alphabet": ["a", "b"], "min_input_length": 0, "max_input_length": 5, "program": "a=b"}
    rows = [good, {k: v for k, v in good.items() if k != "program"}, good | {"concepts": ["a", "a"]}, good | {"termination_reason": " "}, good | {"program": "a=b\n" * 40}, good | {"program": "a=" + "b" * 600}, good | {"input_alphabet": ["=", "a"]}, good | {"max_input_length": -1}, good | {"max_input_length": 12}, good | {"max_input_length": 200}, good | {"input_alphabet": "ab"}]
    df = spark.createDataFrame([(json.dumps(r),) for r in rows] + [("[]",), (None,)], "raw string")
    assert [r[0] for r in df.select(solver.proposal_errors(F.col("raw"))).collect()] == [None, "missing: program", "concepts", "termination_reason", "line_limit", "character_limit", "input_domain", "input_domain", "domain_size", "domain_size", None, "object", "object"]


def test_baselines_equal_a_plain_search(spark):
    from glyphflow.functions.patterns import SEARCHES, filled, letters_of

    problems = R.tests_of(spark, "").where("id in ('delete', 'moves', 'collapse')")
    expected = dict.fromkeys(SEARCHES, (0, 0))
    for r in problems.collect():
        tests = [(t["input"], t["output"]) for t in r["tests"]]
        public, hidden = tests[: r["public"]], tests[r["public"] :]
        solves = lambda p, cases: all(run(p, i, 2000, 256)[0] == o for i, o in cases)
        for name, patterns in SEARCHES.items():
            found = next((p for p in filled(patterns, letters_of(x for t in public for x in t), sorted({o for _, o in public})) if solves(p, public)), None)
            if found is not None:
                expected[name] = (expected[name][0] + 1, expected[name][1] + solves(found, hidden))
    got = {r["baseline"]: (r["public_solved"], r["hidden_solved"]) for r in mining.baselines(problems).collect()}
    assert got == expected


def test_statistics_checks_that_pass(spark):
    from glyphflow.operators import statistics

    rows = [(f"f{i % 20}", f"t{i}", "template" if i % 2 else "teacher", f"d{i % 7}", 1 + (i % 5 == 0), i % 5 == 0, True, "functional", f"b{i}", f"a{i}", 1.0, 3, [1, 2], 0.0, 0.0, 1.0, 0, "train" if i < 40 else "validation" if i < 50 else "test") for i in range(60)]
    df = spark.createDataFrame(rows, "family string, archetype string, source string, domain string, depth int, genuine boolean, probe boolean, level string, behavior string, alpha string, verified double, lines int, steps array<int>, identity_fraction double, constant_fraction double, terminating_fraction double, overlap int, split string")
    found = statistics.cognitive_statistics(df)
    assert all(statistics.cognitive_checks(found).first()) and found.first()["split_distribution"] == {"test": 10, "train": 40, "validation": 10}
    assert not statistics.cognitive_checks(statistics.cognitive_statistics(df.where("split <> 'test'"))).first()["passed"]
    empty = statistics.quality_statistics(spark.createDataFrame([], "identity_fraction double, terminating_fraction double, distinct_outputs int, overlap int, lines int, steps array<int>, behavior string")).first()
    assert empty["problem_count"] == empty["behavior_duplicates"] == 0 and empty["identity_fraction"] == 0.0
    good = spark.createDataFrame([(1, "functional", 0.5, 2, "x", True, False, 2, [0, 1], "b", "c", "s", "m", [], 1.0, "train"), (2, "operational", 0.5, 3, "x", True, False, 3, [0, 1, 2], "b2", "c", "s", "m", [], 1.0, "test")], "id int, level string, score double, depth int, interaction string, genuine boolean, superficial boolean, effective_depth int, effective array<int>, behavior string, alpha_behavior string, structure string, meaning string, ontology_errors array<string>, verified double, split string")
    lineage = spark.createDataFrame([(0, 0, 0, 0, 0, 0, True)], "lineage_cross_split int, mutant_family_cross_split int, auxiliary_reference_cross_split int, alpha_equivalent_program_cross_split int, operation_order_unproved int, alpha_pair_unverified int, passed boolean").drop("passed")
    lengths = spark.createDataFrame([("a", 1, True, True)], "category string, n int, all_verified boolean, longer boolean")
    checks = statistics.hardening_checks(statistics.hardening_statistics(good), lineage, lengths).first().asDict()
    assert not checks["count"] and not checks["passed"] and all(v for k, v in checks.items() if k not in ("count", "passed")) and len(checks) == 16
