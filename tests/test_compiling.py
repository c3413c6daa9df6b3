"""Compiled rule programs against the Column builders, on all values of a small domain."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from glyphflow.functions.compiling import compiled
from glyphflow.functions.interpreting import applied, apply, as_json, from_json
from glyphflow.functions.kernel import run
from glyphflow.functions.strings import Operation, composed
from glyphflow.operators import datasets
from glyphflow.operators.domains import exhaustive, unary, unary_fields

OPS = [
    ("abc", Operation("map", {"mapping": {"a": "b", "b": "ca", "c": ""}})), ("abc", Operation("delete", {"symbols": "ac"})), ("abc", Operation("normalize_runs", {"symbols": "ab"})),
    ("abc", Operation("move_symbols", {"order": "cab"})), ("abc", Operation("recognize_pattern", {"pattern": "ab"})), ("abc", Operation("rotate", {"amount": 1})),
    ("u", Operation("unary_operation", {"operation": "increment"})), ("u", Operation("unary_operation", {"operation": "decrement"})), ("u", Operation("unary_operation", {"operation": "double"})),
    ("f", Operation("binary_operation", {"operation": "add", "separator": ","})),
]


@pytest.mark.parametrize("kind,op", OPS, ids=lambda x: x if isinstance(x, str) else x.kind)
def test_rules_equal_columns(spark, kind, op):
    values = {"u": unary, "f": unary_fields}[kind](spark, 6) if kind in "uf" else exhaustive(spark, "abc", 0, 4)
    program = compiled(op, "abc" if kind == "abc" else "a")
    for r in values.select("value", op(F.col("value")).alias("o")).collect():
        assert run(program, r["value"], 1000)[0] == r["o"], (program, r["value"])


def test_what_has_no_rules_says_so():
    with pytest.raises(NotImplementedError):
        compiled(Operation("unary_operation", {"operation": "parity"}), "a")


DFA = {("even", "a"): "odd", ("odd", "a"): "even", **{(s, c): s for s in ("even", "odd") for c in "bc"}}
FST = {("p", "a"): ("q", "x"), ("q", "a"): ("p", ""), ("p", "b"): ("p", "b"), ("q", "b"): ("p", "yy"), ("p", "c"): ("q", "c"), ("q", "c"): ("q", "")}
REVERSE, MAP, DELETE = Operation("reverse"), Operation("map", {"mapping": {"a": "b", "b": "c", "c": "a"}}), Operation("delete", {"symbols": "b"})
ALL_RUNS = Operation("normalize_runs", {"symbols": "abc"})
SWAP, RUNS, LEFT, RIGHT = Operation("replace_substring", {"old": "ab", "new": "ba"}), Operation("normalize_runs", {"symbols": "ac"}), Operation("rotate", {"amount": 2}), Operation("rotate", {"amount": 1, "direction": "right"})
ACCEPT, FIND = Operation("accept", {"start": "even", "delta": DFA, "accepting": ["even"]}), Operation("recognize_pattern", {"pattern": "ab"})
ROWS = [
    [REVERSE], [SWAP], [Operation("replace_substring", {"old": "aa", "new": "a"})], [LEFT], [RIGHT], [ACCEPT], [Operation("transduce", {"start": "p", "delta": FST})], [REVERSE, MAP], [MAP, REVERSE, DELETE], [SWAP, SWAP], [LEFT, RUNS],
    [RUNS, RIGHT, MAP], [REVERSE, FIND], [DELETE, REVERSE, ACCEPT], [MAP, ACCEPT], [Operation("transduce", {"start": "p", "delta": FST}), REVERSE], [Operation("encode", {"mapping": {"a": "cc", "b": ""}}), LEFT], [REVERSE, REVERSE, DELETE],
]


@pytest.mark.parametrize("operations", ROWS, ids=lambda x: "+".join(o.kind for o in x))
def test_rows_of_operations_equal_columns(spark, operations):
    program = compiled(operations, "abc")
    for r in exhaustive(spark, "abc", 0, 4).select("value", composed(operations, F.col("value")).alias("o")).collect():
        assert run(program, r["value"], 100_000)[0] == r["o"], (program, r["value"])


def test_binary_numbers():
    program = compiled(Operation("unary_operation", {"operation": "binary_increment"}), "01")
    assert all(run(program, f"{i:b}")[0] == f"{i + 1:b}" for i in range(200))
    program = compiled(Operation("binary_operation", {"operation": "subtract", "separator": ","}), "a,")
    assert all(run(program, "a" * i + "," + "a" * j)[0] == "a" * max(0, i - j) for i in range(7) for j in range(7))
    with pytest.raises(NotImplementedError):
        compiled([FIND, REVERSE], "abc")


@pytest.mark.parametrize("operations", ROWS, ids=lambda x: "+".join(o.kind for o in x))
def test_operations_as_data_equal_columns(spark, operations):
    assert from_json(as_json(operations)) == tuple(operations)
    df = exhaustive(spark, "abc", 0, 3).select("value", composed(operations, F.col("value")).alias("a"), applied(F.lit(as_json(operations)), F.col("value")).alias("b"))
    assert df.where("not (a <=> b)").count() == 0


def test_arithmetic_as_data():
    for op, v, o in (("binary_increment", "111", "1000"), ("increment", "aa", "aaa"), ("decrement", "", ""), ("double", "aa", "aaaa"), ("parity", "aaa", "odd")):
        assert apply(Operation("unary_operation", {"operation": op}), v) == o
    for op, rep, v, o in (("concat", "unary", "a,b", "ab"), ("add", "unary", "aa,a", "aaa"), ("subtract", "unary", "a,aa", ""), ("add", "binary", "11,1", "100"), ("xor", "binary", "11,1", "10")):
        assert apply(Operation("binary_operation", {"operation": op, "separator": ",", "representation": rep}), v) == o


def test_data_sets_are_built_and_hardened(spark):
    made = datasets.recipes(spark, 1, 45)
    assert made.collect() == datasets.recipes(spark, 1, 45).collect() and {r["family"] for r in made.collect()} >= {"character_map", "random_dfa", "random_fst", "composition_2", "composition_3"}
    rows = datasets.built(made, longest=4, size=120).collect()
    good = [r for r in rows if r["reason"] is None]
    assert len(rows) == 45 and len(good) > 20 and len({r["signature"] for r in good}) == len(good) and "reference_mismatch" not in {r["reason"] for r in rows}
    assert max(Counter(r["structure"] for r in good).values()) <= datasets.CLUSTER
    chosen, rejected = datasets.dataset(spark, 1, 20, 0.2, 2)
    kinds = Counter(r["source"] for r in chosen.collect())
    assert chosen.count() == 20 and kinds["random_mined"] == 4 and len({r["id"] for r in chosen.collect()}) == 20 and rejected.count() >= 1
    hard, why = datasets.hardened(chosen, 12, 1, 6, 150)
    got = hard.collect()
    assert 0 < len(got) <= 12 and all(r["verified"] == 1 for r in got) and len({r["audit_behavior"] for r in got}) == len(got)
    dead = made.where("seq = 0").select("*").limit(1)
    row = dead.first().asDict() | {"operations": as_json([ALL_RUNS, ALL_RUNS, MAP]), "depth": 3, "program": compiled([ALL_RUNS, MAP], "abc"), "alphabet": "abc", "concepts": ["composition"], "family": "x", "domain": "y"}
    bad = spark.createDataFrame([tuple(row[f] for f in made.columns)], made.schema).withColumn("id", F.lit("i"))
    assert datasets.hardened(bad, 1, 1, 4, 60)[1].first()["reason"] == "ineffective_composition"
