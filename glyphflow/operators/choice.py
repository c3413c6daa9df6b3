"""Choice of public tests: cases that tell the right program from cheap wrong ones come first, then boundaries and outputs."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glyphflow.functions.kernel import rewrite
from glyphflow.functions.patterns import SEARCHES, filled, letters_of
from glyphflow.operators.selection import stable_key

#: Limits of a hypothesis' run; its texts may be so much longer than any case.
STEPS, SLACK = 1000, 32


def _programs(frames):
    for frame in frames:
        rows = []
        for id_, inputs, outputs in zip(frame["id"], frame["inputs"], frame["outputs"], strict=True):
            patterns = [p for use in SEARCHES.values() for p in use]
            rows += [(id_, p) for p in filled(patterns, letters_of(inputs), sorted(outputs))]
        yield pd.DataFrame(rows, columns=["id", "program"])


def mismatches(outcomes: DataFrame) -> DataFrame:
    """id, program and wrong (the inputs it gets wrong) of the cheap programs that some but not all cases rule out.

    outcomes: id, input, output, a row for each case that ends. The product of a problem's cases and hypotheses is rows,
    reduced by sums; no problem's cases are in one row of another's.
    """
    sides = outcomes.groupBy("id").agg(F.collect_set("input").alias("inputs"), F.collect_set("output").alias("outputs"), F.count(F.lit(1)).alias("n"), (F.greatest(F.max(F.length("input")), F.max(F.length("output")), F.lit(1)) + SLACK).alias("room"))
    hypotheses = sides.select("id", "inputs", "outputs").mapInPandas(_programs, "id string, program string")
    parts = int(outcomes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tried = hypotheses.join(outcomes, "id").repartition(parts, "program", "input").withColumn("o", rewrite(F.col("program"), F.col("input"), STEPS, 1 << 20))
    tried = tried.join(sides.select("id", "n", "room"), "id")
    right = F.col("o.terminating") & (F.col("o.output") == F.col("output")) & (F.length("o.output") <= F.col("room"))
    wrong = tried.groupBy("id", "program").agg(F.collect_list(F.when(~F.coalesce(right, F.lit(False)), F.col("input"))).alias("wrong"), F.first("n").alias("n"))
    return wrong.where((F.size("wrong") > 0) & (F.size("wrong") < F.col("n"))).select("id", "program", F.array_sort("wrong").alias("wrong"))


def picked(cases: list[tuple[str, str]], wrong: list[set[str]], count: int) -> list[int]:
    """Places in cases of those to publish. A pick goes, in this order, to the case that rules out most wrong hypotheses that
    are left; a case of each single character; its longest repetition; the empty and a longest input; a case that
    changes its input and one that doesn't; new outputs; and then the rest in order."""
    left, out = list(range(len(cases))), []

    def take(fits) -> None:
        if len(out) < count and (at := next((k for k in left if fits(*cases[k])), None)) is not None:
            left.remove(at)
            out.append(at)

    while wrong and left and len(out) < count:
        best = max(left, key=lambda k: sum(cases[k][0] in w for w in wrong))
        if not any(cases[best][0] in w for w in wrong):
            break
        left.remove(best)
        out.append(best)
        wrong = [w for w in wrong if cases[best][0] not in w]
    single = sorted({cases[k][0] for k in left if len(cases[k][0]) == 1})
    for c in single:
        take(lambda i, o, c=c: i == c)
    for c in single:
        longest = max((cases[k][0] for k in left if len(cases[k][0]) > 1 and {*cases[k][0]} == {c}), key=len, default=None)
        take(lambda i, o, v=longest: i == v)
    take(lambda i, o: i == "")
    most = max((len(cases[k][0]) for k in left), default=0)
    take(lambda i, o: len(i) == most)
    take(lambda i, o: o != i)
    take(lambda i, o: o == i)
    seen = {cases[k][1] for k in out}
    while left and len(out) < count:
        at = next((k for k in left if cases[k][1] not in seen), left[0])
        left.remove(at)
        out.append(at)
        seen.add(cases[at][1])
    return out


def public_hidden(outcomes: DataFrame, seed: int, public: int, hidden: int) -> DataFrame:
    """id, public_tests and hidden_tests (arrays of struct<input, output>), and reason if there are too few cases.

    Cases are taken by emptiness, length and hash; what isn't public is hidden by hash. A problem's cases (a pool of at
    most a few hundred) are one group.
    """
    wrong = mismatches(outcomes).groupBy("id").agg(F.collect_list("wrong").alias("wrong"))
    order = F.struct((F.col("input") != "").alias("a"), F.length("input").alias("n"), stable_key(seed, "id", "input").alias("k"), "input", "output")
    cases = outcomes.groupBy("id").agg(F.array_sort(F.collect_list(order)).alias("cases")).join(wrong, "id", "left")
    schema = "id string, public_tests array<struct<input:string,output:string>>, hidden_tests array<struct<input:string,output:string>>, reason string"

    def choose(frames):
        for frame in frames:
            rows = []
            for id_, listed, sets in zip(frame["id"], frame["cases"], frame["wrong"], strict=True):
                all_ = [(c["input"], c["output"]) for c in listed]
                if len(all_) < public + hidden:
                    rows.append((id_, None, None, "insufficient_public_tests" if len(all_) < public else "insufficient_hidden_tests"))
                    continue
                chosen = picked(all_, [set(w) for w in sets] if sets is not None else [], public)
                rest = sorted((k for k in range(len(all_)) if k not in set(chosen)), key=lambda k: listed[k]["k"])[:hidden]
                rows.append((id_, *([{"input": all_[k][0], "output": all_[k][1]} for k in ks] for ks in (chosen, rest)), None))
            yield pd.DataFrame(rows, columns=["id", "public_tests", "hidden_tests", "reason"])

    return cases.mapInPandas(choose, schema)
