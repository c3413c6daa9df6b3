"""Audits that run programs again: of stored records, of reruns, of compositions, and of programs against closed forms."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glyphflow.functions.kernel import rewrite
from glyphflow.functions.strings import Operation, composed

#: Limits of programs and of their audit runs.
MAX_LINES, MAX_CHARACTERS, AUDIT_STEPS, AUDIT_LENGTH = 32, 512, 100_000, 256


def failures(records: DataFrame) -> DataFrame:
    """id and reason of records whose program is over a limit, can't be read, or whose tests it fails.

    records: id, program, tests (array of struct<input, output>). Every test of every record is run again, each pair of
    program and input once. A record without a program or with a null test fails; one without tests can't.
    """
    over = (F.size(F.split(F.regexp_replace("program", "\n$", ""), "\n")) > MAX_LINES) | (F.length("program") > MAX_CHARACTERS)
    limits = records.where(F.coalesce(over, F.lit(True))).select("id", F.lit("program_limit").alias("reason"))
    cases = records.select("id", "program", F.explode("tests").alias("t")).select("id", "program", "t.input", "t.output")
    ran = cases.select("program", "input").distinct().select("program", "input", rewrite(F.col("program"), F.col("input"), AUDIT_STEPS, AUDIT_LENGTH).alias("o"))
    p, i = ran["program"], ran["input"]
    checked = cases.join(ran.select(p.alias("p"), i.alias("i"), "o"), F.col("program").eqNullSafe(F.col("p")) & F.col("input").eqNullSafe(F.col("i")))
    right = F.coalesce(F.col("o.terminating") & (F.col("o.output") == F.col("output")), F.lit(False))
    return limits.unionByName(checked.where(~right).select("id", F.lit("reference_mismatch").alias("reason")).distinct())


def artifact_audit(records: DataFrame, auxiliary: DataFrame, expected: int | None = None) -> DataFrame:
    """One row: record_count, failing records, duplicates of behavior and of alpha class, auxiliary rows in another split
    than their root, and passed (nothing of these, and as many records as expected).

    records: id, split, program, tests, behavior, alpha. auxiliary: root, split.
    """
    extra = lambda key, name: records.groupBy(key).agg((F.count(F.lit(1)) - 1).alias("n")).agg(F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias(name))
    roots = records.select(F.col("id").alias("root"), F.col("split").alias("own")).dropDuplicates(["root"])
    parts = [
        records.agg(F.count(F.lit(1)).alias("record_count")), failures(records).agg(F.count(F.lit(1)).alias("validation_failures")), extra("behavior", "behavior_duplicates"), extra("alpha", "alpha_equivalent_duplicates"),
        auxiliary.join(roots, "root").agg(F.count_if(F.col("split") != F.col("own")).alias("auxiliary_reference_cross_split")),
    ]
    row = reduce(lambda a, b: a.crossJoin(F.broadcast(b)), parts)  # one row each
    clean = reduce(lambda a, c: a & (F.col(c) == 0), row.columns[1:], F.lit(True))
    return row.withColumn("passed", clean if expected is None else clean & (F.col("record_count") == expected))


def canonical(df: DataFrame) -> DataFrame:
    """value: each row as JSON with its columns in the order of their names."""
    return df.select(F.to_json(F.struct(*(F.col(c) for c in sorted(df.columns))), {"ignoreNullFields": "false"}).alias("value"))


def reproducible(make: Callable[[], DataFrame]) -> DataFrame:
    """One row: the rows of two runs of make, how many canonical lines only one of them has, and whether they are the same."""
    a, b = (canonical(make()).groupBy("value").agg(F.count(F.lit(1)).alias(n)) for n in ("first", "second"))
    both = a.join(b, "value", "full").select(F.coalesce("first", F.lit(0)).alias("first"), F.coalesce("second", F.lit(0)).alias("second"))
    row = both.agg(F.coalesce(F.sum("first"), F.lit(0)).alias("first_rows"), F.coalesce(F.sum("second"), F.lit(0)).alias("second_rows"), F.coalesce(F.sum(F.abs(F.col("first") - F.col("second"))), F.lit(0)).alias("differing"))
    return row.withColumn("identical", F.col("differing") == 0)


def composition_analysis(inputs: DataFrame, sequences: dict[str, list[Operation]]) -> DataFrame:
    """For each named sequence of operations, over all values: which components matter (leaving one out changes an output),
    which are dead, whether the order matters (an exchange of neighbours changes an output) and on which value first,
    whether one component alone does it all, and whether it is a genuine composition. One pass over the values.
    """
    first = lambda differs: F.min(F.when(differs, F.struct(F.length("value").alias("n"), F.col("value").alias("v"))))["v"]
    rows: list[Column] = []
    for name, ops in sequences.items():
        whole = composed(ops, F.col("value"))
        other = lambda some: ~composed(some, F.col("value")).eqNullSafe(whole) if some else ~F.col("value").eqNullSafe(whole)  # noqa: B023, E731
        effective = [F.coalesce(F.bool_or(other(ops[:i] + ops[i + 1 :])), F.lit(False)) for i in range(len(ops))]
        swapped = [other(ops[:i] + [ops[i + 1], ops[i]] + ops[i + 2 :]) for i in range(len(ops) - 1)]
        alone = [F.coalesce(F.bool_and(~other([op])), F.lit(True)) for op in ops] if len(ops) > 1 else []
        moved = reduce(lambda a, b: a | b, swapped, F.lit(False))
        listed = lambda flags, want: F.array_compact(F.array(*(F.when(f == F.lit(want), F.lit(i)) for i, f in enumerate(flags)))).cast("array<int>")
        reducible = reduce(lambda a, b: a | b, alone, F.lit(False))
        dead = reduce(lambda a, b: a | ~b, effective, F.lit(False))
        rows.append(F.struct(
            F.lit(name).alias("name"), listed(effective, True).alias("effective_components"), listed(effective, False).alias("dead_components"), F.coalesce(F.bool_or(moved), F.lit(False)).alias("order_sensitive"),
            first(moved).alias("order_distinguishing_input"), reducible.alias("reducible_to_single_stage"), (F.lit(len(ops) > 1) & ~reducible & ~dead).alias("genuine_composition"),
        ))
    return inputs.agg(F.array(*rows).alias("rows")).select(F.explode("rows").alias("r")).select("r.*")


def closed_form_check(inputs: DataFrame, pairs: dict[str, tuple[str, Column]], max_steps: int = AUDIT_STEPS, max_length: int = 1000) -> DataFrame:
    """name, attempted, verified and fraction: on how many values a program gives what its closed form says."""
    parts = int(inputs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = inputs.select("value").distinct().repartition(parts, "value")
    each = [spread.select(F.lit(name).alias("name"), rewrite(program, F.col("value"), max_steps, max_length)["output"].eqNullSafe(form).alias("same")) for name, (program, form) in pairs.items()]
    rows = reduce(DataFrame.unionByName, each).groupBy("name").agg(F.count(F.lit(1)).alias("attempted"), F.count_if("same").alias("verified"))
    return rows.withColumn("fraction", F.round(F.col("verified") / F.col("attempted"), 6))
