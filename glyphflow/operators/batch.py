"""Programs against inputs: every program on every value, and how outcomes differ."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glyphflow.functions.kernel import rewrite
from glyphflow.functions.rules import LENGTH_LIMIT, STEP_LIMIT

#: Programs come from a catalogue, not from data: more than this many aren't paired with every input.
MOST_PROGRAMS = 10_000


def outcomes(programs: DataFrame, inputs: DataFrame, max_steps: int = STEP_LIMIT, max_length: int = LENGTH_LIMIT) -> DataFrame:
    """programs' columns, value, output, steps, terminating and error of each program on each value.

    The programs go to every task as an array within each row's plan, so that inputs stay where they are.
    """
    rows = programs.limit(MOST_PROGRAMS + 1).collect()
    if len(rows) > MOST_PROGRAMS:
        raise ValueError(f"more than {MOST_PROGRAMS} programs")
    spark = programs.sparkSession
    each = inputs.select("value").crossJoin(F.broadcast(spark.createDataFrame(rows, programs.schema)))
    return each.withColumn("o", rewrite(F.col("program"), F.col("value"), max_steps, max_length)).select(*programs.columns, "value", "o.*")


def differences(found: DataFrame) -> DataFrame:
    """name_a, name_b, n_different and first_difference (shortest, then least) for each pair of programs.

    found: name, value, output. One row for each value holds all programs' outputs, so that pairs need no join.
    """
    lists = found.groupBy("value").agg(F.array_sort(F.collect_list(F.struct("name", "output"))).alias("all"))
    pairs = lists.select("value", "all", F.posexplode("all").alias("i", "a")).select("value", "a", F.explode(F.slice("all", F.col("i") + 2, F.size("all"))).alias("b"))
    differs = ~F.col("a.output").eqNullSafe(F.col("b.output"))
    first = F.min(F.when(differs, F.struct(F.length("value").alias("n"), F.col("value").alias("v"))))
    return pairs.groupBy(F.col("a.name").alias("name_a"), F.col("b.name").alias("name_b")).agg(F.count_if(differs).alias("n_different"), first["v"].alias("first_difference"))
