"""Auxiliary records from problems: execution, traces, termination, repair, completion, ordering, equivalence, distinction.

problems: problem_id, program, input. One row is a program on a case; mutants are columns beside it, so that every record
comes from a projection and a grouping by problem.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glyphflow.functions.kernel import rewrite, traced

STEPS, LENGTH = 2000, 256


def without_last(program: Column) -> Column:
    """The program without its last rule; empty if it has one."""
    lines = F.split(program, "\n")
    return F.when(F.size(lines) < 2, "").otherwise(F.array_join(F.slice(lines, F.lit(1), F.greatest(F.size(lines) - 1, F.lit(1))), "\n"))


def draw(seed: int, id_: Column, n: Column) -> Column:
    """A number below n by hash."""
    return F.pmod(F.conv(F.substring(F.sha2(F.concat_ws("\0", F.lit(str(seed)), id_), 256), 1, 8), 16, 10).cast("bigint"), n).cast("int")


def execution(problems: DataFrame) -> DataFrame:
    return problems.select("problem_id", "program", "input", rewrite(F.col("program"), F.col("input"), STEPS, LENGTH)["output"].alias("output"))


def traces(problems: DataFrame) -> DataFrame:
    return problems.select("problem_id", "program", "input", traced(F.col("program"), F.col("input"), STEPS, LENGTH).alias("t")).select("problem_id", "program", "input", "t.status", "t.trace")


def termination(problems: DataFrame) -> DataFrame:
    """Labels of all cases, and two made ones so that both limits occur."""
    made = problems.sparkSession.createDataFrame([("synthetic_step_limit", "a=a", "a", 4, 10), ("synthetic_length_limit", "a=aa", "a", 100, 4)], "problem_id string, program string, input string, step_limit int, length_limit int")
    labels = [made.where(F.col("step_limit") == s).withColumn("label", traced(F.col("program"), F.col("input"), s, n)["status"]) for s, n in ((4, 10), (100, 4))]
    cases = problems.select("problem_id", "program", "input", F.lit(STEPS).alias("step_limit"), F.lit(LENGTH).alias("length_limit"))
    cases = cases.withColumn("label", traced(F.col("program"), F.col("input"), STEPS, LENGTH)["status"])
    return cases.unionByName(labels[0]).unionByName(labels[1])


def counterexamples(problems: DataFrame, other: Column) -> DataFrame:
    """problem_id, program_a (the other), program_b, and the first input on which they differ with both outputs.

    Nulls count as outputs: two runs over their limits agree.
    """
    both = problems.withColumn("wrong", other)
    both = both.select("problem_id", "program", "wrong", "input", rewrite(F.col("wrong"), F.col("input"), STEPS, LENGTH)["output"].alias("a"), rewrite(F.col("program"), F.col("input"), STEPS, LENGTH)["output"].alias("b"))
    first = F.min(F.when(~F.col("a").eqNullSafe(F.col("b")), F.struct(F.length("input").alias("n"), F.col("input"), F.col("a"), F.col("b"))))
    return both.groupBy("problem_id", "wrong", "program").agg(first.alias("x")).select("problem_id", F.col("wrong").alias("program_a"), F.col("program").alias("program_b"), "x.input", F.col("x.a").alias("output_a"), F.col("x.b").alias("output_b"))


def distinguishing(problems: DataFrame) -> DataFrame:
    return counterexamples(problems, without_last(F.col("program"))).where("input is not null")


def repair(problems: DataFrame) -> DataFrame:
    return distinguishing(problems).select("problem_id", F.col("program_a").alias("wrong_program"), F.col("program_b").alias("fixed_program"), "input", F.col("output_b").alias("output"))


def equivalence(problems: DataFrame) -> DataFrame:
    """A program against its mutant (label false where an input tells them apart) and against itself (true)."""
    same = problems.select("problem_id", F.col("program").alias("program_a"), F.col("program").alias("program_b")).distinct().withColumn("label", F.lit(True))
    return distinguishing(problems).select("problem_id", "program_a", "program_b", F.lit(False).alias("label")).unionByName(same)


def completion(problems: DataFrame, seed: int) -> DataFrame:
    lines = F.split("program", "\n")
    rows = problems.select("problem_id", "program").distinct().withColumn("lines", lines).where(F.size("lines") > 1)
    rows = rows.withColumn("missing_rule_index", draw(seed, F.col("problem_id"), F.size("lines")))
    blank = F.transform("lines", lambda x, i: F.when(i == F.col("missing_rule_index"), "<MISSING_RULE>").otherwise(x))
    return rows.select("problem_id", F.array_join(blank, "\n").alias("incomplete_program"), F.get("lines", F.col("missing_rule_index")).alias("missing_rule"), "missing_rule_index")


def shuffled(seed: int, id_: Column, program: Column) -> Column:
    """The program's rules in hash order."""
    keyed = F.transform(F.split(program, "\n"), lambda x, i: F.struct(F.sha2(F.concat_ws("\0", F.lit(str(seed)), id_, i.cast("string")), 256).alias("k"), x.alias("x")))
    return F.array_join(F.transform(F.array_sort(keyed), lambda y: y["x"]), "\n")


def ordering(problems: DataFrame, seed: int) -> DataFrame:
    """Shuffled rules whose order matters on one of the cases."""
    found = counterexamples(problems, shuffled(seed, F.col("problem_id"), F.col("program"))).where("input is not null")
    return found.select("problem_id", F.col("program_a").alias("shuffled_program"), F.col("program_b").alias("ordered_program"))
