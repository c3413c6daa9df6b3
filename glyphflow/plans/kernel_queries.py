"""Queries for the rewriting kernel: each runs a program over every distinct word of the documents."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glyphflow.functions import programs as P
from glyphflow.functions.kernel import rewrite, strict, traced, valid_input
from glyphflow.functions.native import closed_form, folded
from glyphflow.functions.rules import parse
from glyphflow.operators.batch import differences, outcomes
from glyphflow.plans.oracle import outcome_sql, quoted, steps_sql
from glyphflow.sources import inputs

LIMIT = 10_000


def words(spark: SparkSession, d: str) -> DataFrame:
    """Words, dealt over all cores: the distinct values are few bytes but many steps."""
    return inputs.words(spark, d).repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "value")


def kernel(program: str, max_steps: int = LIMIT, max_length: int = 1000) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, d: words(spark, d).select("value", rewrite(program, F.col("value"), max_steps, max_length).alias("o")).select("value", "o.*")


def fold(program: str, bound: int, max_length: int = 1000) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, d: words(spark, d).select("value", folded(program, F.col("value"), bound, max_length).alias("o")).select("value", "o.*")


def trace(spark: SparkSession, d: str) -> DataFrame:
    t = words(spark, d).select("value", F.explode(traced(P.ANCHORS, F.col("value"), LIMIT)["trace"]).alias("t"))
    return t.select("value", "t.step", "t.rule_line", "t.rule", "t.before", "t.after")


def trace_sql() -> str:
    rule = "CASE rule " + " ".join(f"WHEN {r.line} THEN {quoted(r.source)}" for r in parse(P.ANCHORS)) + " END"
    return f"{steps_sql(P.ANCHORS, inputs.SQL['abc'], LIMIT)} SELECT value, step, rule AS rule_line, {rule} AS rule, before, v AS after FROM run WHERE step > 0"


def five(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(P.FIVE.items()), "name string, program string")


def strictly(spark: SparkSession, d: str) -> DataFrame:
    return words(spark, d).select("value", strict(rewrite(P.SORT, F.col("value")), F.col("value")).alias("output"))


def lowered(spark: SparkSession, d: str) -> DataFrame:
    return words(spark, d).select("value", closed_form(P.DELETE, F.col("value")).alias("output"))


def syntax(spark: SparkSession, d: str) -> DataFrame:
    """Every line of every document as a program: which can be read, by a kernel run on the empty value."""
    lines = inputs.table(spark, d, "documents").select(F.explode(F.split("text", "\n")).alias("program")).distinct()
    error = rewrite(F.col("program"), F.lit("a"), 5)["error"]
    return lines.select("program", F.coalesce(F.startswith(error, F.lit("syntax_error")), F.lit(False)).alias("bad"))


def product(spark: SparkSession, d: str) -> DataFrame:
    return outcomes(five(spark), words(spark, d), LIMIT).select("name", "value", "output", "steps")


def equivalence(spark: SparkSession, d: str) -> DataFrame:
    """For each pair of programs, on how many words their outputs differ, and the first such word."""
    return differences(outcomes(five(spark), words(spark, d), LIMIT))


_ALL = " UNION ALL ".join(f"SELECT '{n}' AS name, value, output, steps FROM ({outcome_sql(p, inputs.SQL['abc'], LIMIT)})" for n, p in P.FIVE.items())
_LENGTH = "length(value)"
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "rewrite_output": lambda s, d: kernel(P.SORT)(s, d).select("value", "output"),
    "rewrite_steps": lambda s, d: kernel(P.SORT)(s, d).select("value", "steps"),
    "rewrite_status": lambda s, d: kernel(P.GROW, LIMIT, 60)(s, d).groupBy("terminating", "error").agg(F.count(F.lit(1)).alias("n")),
    "rewrite_trace": trace,
    "rewrite_once": kernel(P.ONCE, LIMIT),
    "rewrite_counted": kernel(P.COUNTED, LIMIT),
    "rewrite_return": kernel(P.RETURN, LIMIT),
    "rewrite_anchors": kernel(P.ANCHORS, LIMIT),
    "rewrite_moves": kernel(P.MOVES, LIMIT),
    "rewrite_swap": kernel(P.SWAP, LIMIT),
    "rewrite_reverse": kernel(P.REVERSE, LIMIT),
    "rewrite_collapse": kernel(P.COLLAPSE, LIMIT),
    "rewrite_step_limit": kernel(P.SORT, 12),
    "rewrite_length_limit": kernel(P.GROW, LIMIT, 20),
    "rewrite_loop": kernel(P.LOOP, 20),
    "rewrite_strict": strictly,
    "rewrite_closed_form": lowered,
    "fold_sort": fold(P.SORT, 170),
    "fold_once": fold(P.ONCE, 10),
    "fold_return": fold(P.RETURN, 30),
    "fold_anchors": fold(P.ANCHORS, 60),
    "fold_moves": fold(P.MOVES, 30),
    "fold_length_limit": fold(P.GROW, 60, 20),
    "program_syntax": syntax,
    "program_x_input": product,
    "equivalence_check": equivalence,
    "valid_input": lambda s, d: inputs.table(s, d, "conversations").select("text").distinct().select("text", valid_input(F.col("text")).alias("valid")),
}
ORACLES = {
    "rewrite_output": f"SELECT value, array_to_string(list_sort(string_split(value, '')), '') AS output FROM ({inputs.SQL['abc']})",
    "rewrite_steps": f"SELECT value, steps FROM ({outcome_sql(P.SORT, inputs.SQL['abc'], LIMIT)})",
    "rewrite_status": f"SELECT terminating, error, count(*) AS n FROM ({outcome_sql(P.GROW, inputs.SQL['abc'], LIMIT, 60)}) GROUP BY ALL",
    "rewrite_trace": trace_sql(),
    "rewrite_strict": f"SELECT value, output FROM ({outcome_sql(P.SORT, inputs.SQL['abc'], LIMIT)})",
    "rewrite_closed_form": f"SELECT value, output FROM ({outcome_sql(P.DELETE, inputs.SQL['abc'], LIMIT)})",
    "program_syntax": "SELECT program, NOT (program = '' OR starts_with(trim(program, chr(32) || chr(9) || chr(13) || chr(11) || chr(12)), '/*') OR program = chr(13)) AND (length(program) - length(replace(program, '=', '')) <> 1 OR regexp_matches(program, '[#()]') OR strlen(program) <> length(program)) AS bad FROM (SELECT DISTINCT unnest(string_split(text, chr(10))) AS program FROM documents)",
    "program_x_input": _ALL,
    "equivalence_check": f"""WITH o AS ({_ALL}), p AS (SELECT a.name AS name_a, b.name AS name_b, a.value, a.output IS DISTINCT FROM b.output AS differs FROM o a JOIN o b ON a.value = b.value AND a.name < b.name)
SELECT name_a, name_b, count_if(differs) AS n_different, min(CASE WHEN differs THEN {{'n': length(value), 'v': value}} END).v AS first_difference FROM p GROUP BY name_a, name_b""",
    "valid_input": "SELECT DISTINCT text, NOT regexp_matches(text, '[\\n\\r]') AND strlen(text) = length(text) AND length(text) <= 1000 AS valid FROM conversations",
} | {
    name: outcome_sql(program, inputs.SQL["abc"], steps, length)
    for name, program, steps, length in (
        ("rewrite_once", P.ONCE, LIMIT, 1000), ("rewrite_counted", P.COUNTED, LIMIT, 1000), ("rewrite_return", P.RETURN, LIMIT, 1000), ("rewrite_anchors", P.ANCHORS, LIMIT, 1000), ("rewrite_moves", P.MOVES, LIMIT, 1000),
        ("rewrite_swap", P.SWAP, LIMIT, 1000), ("rewrite_reverse", P.REVERSE, LIMIT, 1000), ("rewrite_collapse", P.COLLAPSE, LIMIT, 1000), ("rewrite_step_limit", P.SORT, 12, 1000), ("rewrite_length_limit", P.GROW, LIMIT, 20), ("rewrite_loop", P.LOOP, 20, 1000),
        ("fold_sort", P.SORT, 170, 1000), ("fold_once", P.ONCE, 10, 1000), ("fold_return", P.RETURN, 30, 1000), ("fold_anchors", P.ANCHORS, 60, 1000), ("fold_moves", P.MOVES, 30, 1000), ("fold_length_limit", P.GROW, 60, 20),
    )
}
