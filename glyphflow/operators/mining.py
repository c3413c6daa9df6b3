"""Mining short programs: candidates, their behaviour on small domains, dedup by behaviour and structure, round robin."""

from __future__ import annotations

import hashlib
from itertools import permutations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glyphflow.functions.fingerprints import behavior_signature, ordered_probes, structural_fingerprint
from glyphflow.functions.kernel import rewrite
from glyphflow.functions.patterns import SEARCHES, filled, letters_of
from glyphflow.operators.batch import outcomes
from glyphflow.operators.domains import candidate_rules, exhaustive
from glyphflow.operators.quality import behavior_properties
from glyphflow.operators.selection import round_robin, two_key_dedup

#: The alphabets, and how many ordered pairs of rules are tried for each.
ALPHABETS = ("ab", "abc", "de", "ghi")
PAIRS = 600
PROPERTIES = ["idempotent", "length_preserving", "length_increasing", "length_decreasing", "alphabet_preserving", "possible_normalizer", "possible_classifier", "possible_encoder"]


def candidates(spark: SparkSession, alphabet: str, seed: int, pairs: int = PAIRS, lines: int = 2) -> DataFrame:
    """seq and program: all candidate rules, then the first pairs of them in hash order; none of more than so many lines."""
    rules = candidate_rules(alphabet)
    ordered = sorted(permutations(rules, 2), key=lambda p: hashlib.sha256(f"{seed}\0{p[0]}\0{p[1]}".encode()).digest())
    programs = [*rules, *("\n".join(p) for p in ordered[:pairs])]
    return spark.createDataFrame([(i, p) for i, p in enumerate(programs) if p.count("\n") < lines], "seq long, program string")


def mine(spark: SparkSession, seed: int, limit: int, alphabets: tuple[str, ...] = ALPHABETS, most_length: int = 6) -> DataFrame:
    """alphabet, program, signature, structure and cluster (its properties' names) of at most limit mined programs.

    A program stays if it ends on all strings of up to 3 characters within 100 steps, is neither the identity nor constant
    there, and is new both in behaviour and in structure. Rarest clusters first, in turn.
    """
    found = None
    for number, alphabet in enumerate(alphabets):
        values = exhaustive(spark, alphabet, 0, 3).repartition(int(spark.conf.get("spark.sql.shuffle.partitions")))
        ran = outcomes(candidates(spark, alphabet, seed), values, 100, most_length)
        ran = ran.withColumn("again", F.when(F.col("terminating"), rewrite(F.col("program"), F.coalesce("output", F.lit("")), 200, 32)["output"])).cache()  # a bounded search: a few thousand programs on a few dozen strings
        fit = ran.groupBy("seq", "program").agg(
            F.bool_and("terminating").alias("ends"), F.bool_and(F.col("output").eqNullSafe(F.col("value"))).alias("same"), F.count_distinct("output").alias("outputs"), ordered_probes().alias("probes")
        ).where("ends and not same and outputs > 1")
        fit = fit.select("seq", "program", behavior_signature(F.col("probes")).alias("signature"), structural_fingerprint(F.col("program"), list(alphabet)).alias("structure"))
        traits = behavior_properties(ran.join(fit.select("seq"), "seq", "left_semi"), "seq", alphabet)
        cluster = F.array_join(F.array_compact(F.array(*(F.when(F.col(p), p) for p in PROPERTIES))), "+")
        rows = fit.join(traits, "seq").select((F.col("seq") + number * 1_000_000).alias("seq"), F.lit(alphabet).alias("alphabet"), "program", "signature", "structure", cluster.alias("cluster"))
        found = rows if found is None else found.unionByName(rows)
    found = found.cache()
    return round_robin(two_key_dedup(found, "seq", "signature", "structure"), "cluster", ["seq"], limit).drop("seq")


def baselines(problems: DataFrame) -> DataFrame:
    """baseline, attempted, public_solved, hidden_solved and overfit for four searches.

    problems: id, tests (array of struct<input, output>), public (how many of them are public). A search tries its
    candidates in order on the public tests; the first that passes all is judged on the rest.
    """
    spark = problems.sparkSession
    tests = problems.select("id", F.posexplode("tests").alias("at", "t"), "public").select("id", "t.input", "t.output", (F.col("at") < F.col("public")).alias("public"))
    tries = problems.select("id", F.filter("tests", lambda t, i: i < F.col("public")).alias("seen")).mapInPandas(_candidates, "id string, baseline string, at int, program string")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ran = tries.join(tests, "id").repartition(parts, "program").withColumn("o", rewrite(F.col("program"), F.col("input"), 2000, 256))
    ok = F.col("o.terminating") & F.col("o.output").eqNullSafe(F.col("output"))
    judged = ran.groupBy("id", "baseline", "at").agg(F.coalesce(F.bool_and(F.when(F.col("public"), ok)), F.lit(True)).alias("p"), F.coalesce(F.bool_and(F.when(~F.col("public"), ok)), F.lit(True)).alias("h"))
    best = judged.where("p").groupBy("id", "baseline").agg(F.min_by("h", "at").alias("h"))
    each = spark.createDataFrame([(n,) for n in ("identity", "constant", "single_rule_search", "template_search")], "baseline string")
    counted = best.groupBy("baseline").agg(F.count(F.lit(1)).alias("s"), F.count_if("h").alias("h"))
    total = problems.agg(F.count(F.lit(1)).alias("attempted"))
    out = each.crossJoin(F.broadcast(total)).join(counted, "baseline", "left")  # total: one row
    solved, hidden = F.coalesce("s", F.lit(0)), F.coalesce("h", F.lit(0))
    return out.select("baseline", "attempted", solved.alias("public_solved"), hidden.alias("hidden_solved"), (solved - hidden).alias("overfit"))


def _candidates(frames):
    import pandas as pd

    for frame in frames:
        rows = []
        for id_, seen in zip(frame["id"], frame["seen"], strict=True):
            letters = letters_of(t[side] for t in seen for side in ("input", "output"))
            for name, patterns in SEARCHES.items():
                rows += [(id_, name, i, p) for i, p in enumerate(filled(patterns, letters, sorted({t["output"] for t in seen})))]
        yield pd.DataFrame(rows, columns=["id", "baseline", "at", "program"])


def novelty(candidates_: DataFrame, existing: DataFrame) -> DataFrame:
    """id, five components and their mean for each candidate against the existing records.

    Both: id, concepts, operations (arrays), structure, behavior. Whether one value is known is a join; the nearest record
    is found by comparing every candidate with every existing record, reduced to a minimum in each task. Neither side is
    broadcast unless Spark finds it small.
    """
    union = F.size(F.array_union("concepts", "c"))
    jaccard = F.when(union == 0, 0.0).otherwise(1 - F.size(F.array_intersect("concepts", "c")) / union)
    longest = F.greatest(F.size("operations"), F.size("s"))
    equal = F.size(F.filter(F.zip_with("operations", "s", lambda a, b: F.coalesce(a == b, F.lit(False))), lambda x: x))
    sequence = F.when(longest == 0, 0.0).otherwise(1 - equal / longest)
    others = existing.select(F.col("concepts").alias("c"), F.col("operations").alias("s")).distinct()
    nearest = candidates_.crossJoin(others).groupBy("id").agg(F.min(0.6 * jaccard + 0.4 * sequence).alias("nearest")).withColumnRenamed("id", "_id")
    out = candidates_.join(nearest, F.col("id") == F.col("_id"), "left").drop("_id")
    for column in ("operations", "structure", "behavior"):
        known = existing.select(F.col(column).alias("_k")).distinct().withColumn(f"_{column}", F.lit(True))
        out = out.join(known, F.col(column) == F.col("_k"), "left").drop("_k")
    concepts = existing.select(F.explode("concepts").alias("_k")).distinct().withColumn("_known", F.lit(True))
    each = candidates_.select(F.col("id").alias("_id"), F.explode(F.array_distinct("concepts")).alias("c")).join(concepts, F.col("c") == F.col("_k"), "left")
    fresh = each.groupBy("_id").agg(F.avg(F.when(F.col("_known"), 0.0).otherwise(1.0)).alias("_fresh"))
    out = out.join(fresh, F.col("id") == F.col("_id"), "left").drop("_id")
    parts = {
        "concept_novelty": F.coalesce("_fresh", F.lit(0.0)),
        "composition_novelty": F.col("_operations").isNull().cast("double"),
        "structural_novelty": F.col("_structure").isNull().cast("double"),
        "behavior_novelty": F.col("_behavior").isNull().cast("double"),
        "nearest_distance": F.coalesce("nearest", F.lit(1.0)),
    }
    rounded = {k: F.round(v, 6).alias(k) for k, v in parts.items()}
    return out.select("id", *rounded.values(), F.round(sum(parts.values(), F.lit(0.0)) / 5, 6).alias("total"))
