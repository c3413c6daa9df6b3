"""The language: reading programs, matching, rewriting, limits; in the kernel and natively."""

import random

import pytest
from pyspark.sql import functions as F

from glyphflow.functions import programs as P
from glyphflow.functions.kernel import rewrite, run, traced
from glyphflow.functions.native import closed_form, folded
from glyphflow.functions.rules import RuleError, parse


def out(program, value, **limits):
    return run(program, value, **limits)[0]


def test_identity_keeps_reserved_characters():
    assert out("", "=#()") == "=#()"


def test_priority_restart_and_leftmost():
    assert out("a=b\nb=c", "aab") == "ccc"
    assert out("ab=x", "abab") == "xx"
    assert out("(once)a=x", "baa") == "bxa"


def test_empty_patterns():
    assert out("(once)=x", "ab") == "xab"
    assert out("(once)=(end)x", "ab") == "abx"


def test_keywords():
    assert out("(start)a=", "aab") == "b"
    assert out("(end)b=(start)X", "abb") == "XXa"
    assert out("b=(return)yes\na=", "aab") == "yes"
    assert run("(once)a=b\n(once)a=c", "aaa")[:2] == ("bca", 2)


def test_comments_and_line_ends():
    assert out("/* x\na=b\n*/\na=c\r", "a") == "c"
    assert [r.line for r in parse("\n/* one line is not closed */\nb=c\n*/\n\na=c")] == [6]


@pytest.mark.parametrize("program,line", [("a", 1), ("a=b=c", 1), ("x=y\n(bad)a=b", 2), ("(start=b", 1), ("a=(once)b", 1), ("(return)a=b", 1), ("é=a", 1), ("a=b#", 1), ("  ", 1)])
def test_bad_programs_name_their_line(program, line):
    with pytest.raises(RuleError) as e:
        parse(program)
    assert e.value.line == line


def test_limits():
    assert run("a=b\nb=a", "a", max_steps=4) == (None, 5, False, "execution_step_limit")
    assert run("a=", "aaaa", max_steps=4) == ("", 4, True, None)
    assert run("a=aa", "a", max_length=4)[3] == "string_length_limit"
    assert run("", "aaaaa", max_length=4) == (None, 0, False, "input_length_limit")
    assert run("=(return)aaaaa", "", max_length=4)[3] == "string_length_limit"


def test_trace_has_the_step_over_the_limit(spark):
    t = spark.range(1).select(traced("a=a", F.lit("a"), 4, 10).alias("t")).first()["t"]
    assert t["status"] == "step_limit" and [x["step"] for x in t["trace"]] == [1, 2, 3, 4, 5]


def test_kernel_handles_nulls_bad_programs_and_no_rows(spark):
    df = spark.createDataFrame([("a=b", "a"), (None, "a"), ("a=b", None), ("bad", "a")], "p string, value string")
    rows = df.select(rewrite(F.col("p"), F.col("value")).alias("o")).collect()
    assert rows[0]["o"]["output"] == "b" and rows[1]["o"]["output"] is None and rows[2]["o"]["steps"] is None
    assert rows[3]["o"]["error"].startswith("syntax_error")
    assert df.limit(0).select(rewrite(F.col("p"), F.col("value")).alias("o")).count() == 0


def test_fold_equals_kernel_on_random_programs(spark):
    rng = random.Random(3)
    values = ["".join(rng.choice("abc") for _ in range(rng.randint(0, 6))) for _ in range(60)]
    df = spark.createDataFrame([(v,) for v in values], "value string").cache()
    side = lambda: "".join(rng.choice("abc") for _ in range(rng.randint(0, 2)))
    for _ in range(6):
        program = "\n".join(rng.choice(["", "(start)", "(end)", "(once)"]) + side() + "=" + rng.choice(["", "(start)", "(end)", "(return)"]) + side() for _ in range(rng.randint(1, 3)))
        both = df.select("value", folded(program, F.col("value"), 25, 12).alias("a"), rewrite(program, F.col("value"), 25, 12).alias("b")).collect()
        for r in both:
            assert r["a"].asDict() == r["b"].asDict(), (program, r["value"])


def test_closed_form_only_where_it_holds(spark):
    assert closed_form("ab=", F.lit("x")) is None
    assert closed_form("a=b\nb=a", F.lit("x")) is None
    assert closed_form(P.SORT, F.lit("x")) is None
    got = spark.range(1).select(closed_form("a=b\nb=cc", F.lit("abab")).alias("o")).first()["o"]
    assert got == run("a=b\nb=cc", "abab")[0]
