"""Data sets of problems: seeded recipes, their programs, verification on pools of inputs, gates, dedup and caps.

Recipes are a catalogue, made on the driver; all that is run, compared and counted is a DataFrame of problems and inputs.
"""

from __future__ import annotations

import random
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from glyphflow.functions.compiling import compiled
from glyphflow.functions.fingerprints import behavior_signature, ordered_probes, structural_fingerprint
from glyphflow.functions.interpreting import applied, as_json, from_json
from glyphflow.functions.kernel import rewrite
from glyphflow.functions.labels import difficulty, ontology_errors
from glyphflow.functions.strings import Operation
from glyphflow.operators import domains, mining
from glyphflow.operators.quality import gated, quality_metrics
from glyphflow.operators.selection import capped, first_seen, stable_key
from glyphflow.sources.work import stored

#: Alphabets, sizes and fractions of data sets, domains of kinds of operations, and limits of runs.
ALPHABETS, STYLES, ENCODINGS = ("abc", "ab", "de", "xyz", "kl"), ("functional", "io_only", "rules"), ("01", "xyz", "pqr")
MINED, CLUSTER, ATTEMPTS, STEPS, LENGTH, PROBES = 0.3, 3, 40, 10_000, 256, 256
DOMAIN = {"map": "character_mapping", "encode": "encoding", "decode": "encoding", "delete": "filtering", "replace_substring": "substring", "normalize_runs": "normalization", "reverse": "sequence", "rotate": "sequence", "move_symbols": "sorting", "recognize_pattern": "recognition", "accept": "finite_state_machines", "transduce": "finite_state_machines", "unary_operation": "unary_arithmetic"}
CONCEPT = {"accept": "finite_state_machine", "transduce": "finite_state_machine", "unary_operation": "unary_arithmetic"}

Made = tuple[list[Operation], str, str, str]  # operations, alphabet, family, source


def letters(rng: random.Random) -> str:
    return rng.choice(ALPHABETS)


def mapping(rng: random.Random, alphabet: str, to: str | None = None) -> dict[str, str]:
    """Images that aren't all the letters themselves."""
    while True:
        images = {c: rng.choice(to or alphabet) for c in alphabet}
        if any(k != v for k, v in images.items()):
            return images


def machine(rng: random.Random, alphabet: str, said: bool) -> dict:
    """A complete automaton of two or three states."""
    states = [f"q{i}" for i in range(rng.randint(2, 3))]
    to = {(s, c): rng.choice(states) for s in states for c in alphabet}
    if not said:
        return {"start": "q0", "delta": to, "accepting": sorted(rng.sample(states, rng.randint(1, len(states) - 1)))}
    return {"start": "q0", "delta": {k: (t, rng.choice(["", *alphabet])) for k, t in to.items()}}


def single(rng: random.Random, alphabet: str) -> Operation:
    """An operation that can stand in a row with others."""
    kind = rng.choice(("map", "delete", "replace_substring", "normalize_runs", "reverse", "rotate", "move_symbols"))
    return Operation(kind, {
        "map": lambda: {"mapping": mapping(rng, alphabet)}, "delete": lambda: {"symbols": rng.choice(alphabet)}, "replace_substring": lambda: {"old": rng.choice(alphabet) * rng.randint(1, 2), "new": rng.choice(alphabet)},
        "normalize_runs": lambda: {"symbols": alphabet}, "reverse": dict, "rotate": lambda: {"amount": 1, "direction": rng.choice(("left", "right"))}, "move_symbols": lambda: {"order": "".join(rng.sample(alphabet, len(alphabet)))},
    }[kind]())


def one_of(rng: random.Random, kind: str, parameters: Callable[[str], dict], family: str, source: str, alphabet: str | None = None) -> Made:
    a = alphabet or letters(rng)
    return [Operation(kind, parameters(a))], a, family, source


def row_of(rng: random.Random, n: int) -> Made:
    a = letters(rng)
    return [single(rng, a) for _ in range(n)], a, f"composition_{n}", "composed"


#: The fifteen recipes.
RECIPES: tuple[Callable[[random.Random], Made], ...] = (
    lambda r: one_of(r, "map", lambda a: {"mapping": mapping(r, a)}, "character_map", "template"),
    lambda r: one_of(r, "delete", lambda a: {"symbols": "".join(r.sample(a, r.randint(1, len(a) - 1)))}, "symbol_filter", "enumerated"),
    lambda r: one_of(r, "normalize_runs", lambda a: {"symbols": a}, "run_normalizer", "template"),
    lambda r: one_of(r, "replace_substring", lambda a: {"old": r.choice(a) * r.randint(1, 2), "new": r.choice(["", *a])}, "substring_rewriter", "enumerated"),
    lambda r: one_of(r, "reverse", lambda a: {}, "reversal", "handwritten"),
    lambda r: one_of(r, "rotate", lambda a: {"amount": 1, "direction": "left"}, "rotate_left", "handwritten"),
    lambda r: one_of(r, "move_symbols", lambda a: {"order": "".join(r.sample(a, len(a)))}, "symbol_sort", "handwritten"),
    lambda r: one_of(r, "recognize_pattern", lambda a: {"pattern": "".join(r.choice(a) for _ in range(r.randint(1, 3)))}, "substring_classifier", "template"),
    lambda r: (lambda s: one_of(r, "unary_operation", lambda a: {"operation": r.choice(("increment", "decrement", "double")), "symbol": s}, "unary_arithmetic", "enumerated", s))(r.choice("adkp")),
    lambda r: one_of(r, *r.choice((("unary_operation", lambda a: {"operation": "binary_increment"}, "binary_increment"), ("map", lambda a: {"mapping": {"0": "1", "1": "0"}}, "binary_not"), ("reverse", lambda a: {}, "binary_reverse"), ("normalize_runs", lambda a: {"symbols": "01"}, "binary_run_normalizer"))), "handwritten", "01"),
    lambda r: one_of(r, "encode", lambda a: {"mapping": dict(zip(a, r.sample("01xyzpqr", len(a)), strict=True))}, "symbol_encoder", "enumerated"),
    lambda r: row_of(r, 2),
    lambda r: row_of(r, 3),
    lambda r: one_of(r, "accept", lambda a: machine(r, a, False), "random_dfa", "enumerated"),
    lambda r: one_of(r, "transduce", lambda a: machine(r, a, True), "random_fst", "enumerated"),
)
CATALOGUE = "seq long, operations string, alphabet string, family string, domain string, source string, style string, depth int, concepts array<string>, sequence array<string>, program string, reason string"


def recipes(spark: SparkSession, seed: int, count: int) -> DataFrame:
    """count problems of the recipes in turn, each drawn for itself: operations (JSON), alphabet, labels and program, or the
    reason why there is none."""
    rows = []
    for seq in range(count):
        rng = random.Random(f"{seed}/{seq}")
        ops, alphabet, family, source = RECIPES[seq % len(RECIPES)](rng)
        kinds = [o.kind for o in ops]
        concepts = sorted({*kinds, *(CONCEPT[k] for k in kinds if k in CONCEPT), *(["composition"] if len(ops) > 1 else []), *(["binary_representation"] if family.startswith("binary_") else [])} - ({"unary_arithmetic"} if family == "binary_increment" else set()))
        domain = "binary_operations" if alphabet == "01" else "marker_rewrite" if len(ops) > 1 else DOMAIN[kinds[0]]
        try:
            program, reason = compiled(ops, alphabet), None
        except (NotImplementedError, ValueError):
            program, reason = None, "no_rules"
        rows.append((seq, as_json(ops), alphabet, family, domain, source, rng.choice(STYLES), len(ops), concepts, kinds, program, reason))
    return spark.createDataFrame(rows, CATALOGUE)


def with_inputs(problems: DataFrame, longest: int, size: int, seed: int) -> DataFrame:
    """problems with value: each with the pool of its alphabet. Alphabets are a fixed few."""
    spark = problems.sparkSession
    used = sorted(r[0] for r in problems.select("alphabet").distinct().collect())  # at most as many as the recipes have
    pools = [domains.targeted(spark, a, 1 if a == "01" else 0, longest if len(a) > 1 else 16, size, seed).select("value", F.lit(a).alias("_a")) for a in used]
    pool = F.broadcast(reduce(DataFrame.unionByName, pools))  # size values for each alphabet
    return problems.join(pool, F.col("alphabet") == F.col("_a")).drop("_a").where("alphabet <> '01' or value = '0' or not startswith(value, '0')")


def built(problems: DataFrame, longest: int = 5, seed: int = 0, size: int = PROBES) -> DataFrame:
    """problems with signature, structure, metrics and the reason of the first gate that a problem fails: no_rules,
    reference_mismatch (the program isn't what its operations say), the quality gates, duplicate_behavior (of an earlier
    one) and duplicate_structure (more than CLUSTER of one structure)."""
    parts = int(problems.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ran = with_inputs(problems.where("program is not null").select("seq", "program", "operations", "alphabet"), longest, size, seed).repartition(parts, "seq", "value")
    ran = stored(ran.withColumns({"o": rewrite(F.col("program"), F.col("value"), STEPS, LENGTH), "expected": applied(F.col("operations"), F.col("value"))}).select("seq", "value", "expected", "o.*"), "built")
    right = ran.groupBy("seq").agg(F.bool_and(F.col("terminating") & F.col("output").eqNullSafe(F.col("expected"))).alias("right"), ordered_probes().alias("probes"))
    right = right.select("seq", "right", behavior_signature(F.col("probes")).alias("signature"))
    metrics = gated(quality_metrics(ran, "seq"), 1.0, 0.9, 0.9).withColumnRenamed("reason", "gate").withColumnRenamed("n", "probes")
    out = problems.join(right, "seq", "left").join(metrics, "seq", "left")
    out = out.withColumn("structure", structural_fingerprint(F.col("program"), [])).withColumn("reason", F.coalesce("reason", F.when(~F.coalesce("right", F.lit(False)), "reference_mismatch"), "gate"))
    out = stored(out.drop("right", "gate"), "gated")
    good = out.where("reason is null").select("seq", "signature", "structure")
    first = stored(first_seen(good, ["signature"], ["seq"]), "first").select("seq", "structure")
    some = capped(first, ["structure"], ["seq"], CLUSTER).select(F.col("seq").alias("_s"))
    first = first.select(F.col("seq").alias("_f"))
    marked = out.join(first, F.col("seq") == F.col("_f"), "left").join(some, F.col("seq") == F.col("_s"), "left")
    return marked.withColumn("reason", F.coalesce("reason", F.when(F.col("_f").isNull(), "duplicate_behavior").when(F.col("_s").isNull(), "duplicate_structure"))).drop("_f", "_s")


def dataset(spark: SparkSession, seed: int, count: int, mined: float = MINED, attempts: int = 3) -> tuple[DataFrame, DataFrame]:
    """A data set of count problems, and its rejections by reason. A share comes from mining, which tells
    its programs apart itself; recipes fill what mining doesn't give. Attempts are bounded: attempts * count recipes, in turn."""
    made = stored(built(recipes(spark, seed, attempts * count), seed=seed), "dataset")
    accepted = made.where("reason is null")
    found = mining.mine(spark, seed + 1, round(count * mined)).select("alphabet", "program", "signature", "structure", "cluster")
    found = found.withColumn("seq", F.row_number().over(Window.orderBy("alphabet", "program")) + F.lit(1 << 40))  # at most the share
    rest = [F.lit(None).cast(f.dataType).alias(f.name) for f in accepted.schema.fields if f.name not in ("seq", "alphabet", "program", "signature", "structure", "source", "style", "depth", "family", "domain", "concepts", "sequence")]
    empty = F.array().cast("array<string>")
    found = found.select(F.col("seq").cast("long"), "alphabet", "program", "signature", "structure", F.lit("random_mined").alias("source"), F.lit("io_only").alias("style"), F.lit(1).alias("depth"), F.lit("mined").alias("family"), F.lit("mined_rewrite").alias("domain"), F.filter(F.split("cluster", r"\+"), lambda x: x != "").alias("concepts"), empty.alias("sequence"), *rest)
    chosen = accepted.unionByName(stored(found, "mined")).withColumn("_late", F.col("source") != "random_mined").orderBy("_late", "seq").limit(count).drop("_late")
    out = chosen.withColumn("id", F.concat(F.col("family"), F.lit("-"), F.left("signature", F.lit(12)))).withColumn("difficulty", difficulty(F.size(F.split("program", "\n")), F.col("depth")))
    return out.drop("reason"), made.where("reason is not null").groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


def hardened(problems: DataFrame, count: int, seed: int, longest: int = 9, size: int = 768) -> tuple[DataFrame, DataFrame]:
    """count of the problems that pass the second row of gates, in hash order, and the rejections by reason: ontology_error,
    ineffective_composition, long_domain_verifier_failure (on audit inputs of up to longest characters), and
    duplicate_audit_behavior. A component is effective if leaving it out changes an output."""
    spark = problems.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    own = stored(problems, "candidates")
    left_out = [(r["seq"], i, as_json([o for j, o in enumerate(from_json(r["operations"])) if j != i])) for r in own.where("depth > 1 and operations is not null").select("seq", "operations").toLocalIterator() for i in range(len(from_json(r["operations"])))]
    ablations = spark.createDataFrame(left_out, "seq long, component int, without string")
    ran = with_inputs(own.where("program is not null").select("seq", "program", "operations", "alphabet"), longest, size, seed).repartition(parts, "seq", "value")
    ran = stored(ran.withColumns({"o": rewrite(F.col("program"), F.col("value"), STEPS, LENGTH), "expected": F.when(F.col("operations").isNotNull(), applied(F.col("operations"), F.col("value")))}).select("seq", "value", "operations", "expected", "o.*"), "audited")
    verified = ran.groupBy("seq").agg(F.avg((F.col("operations").isNull() | F.col("terminating") & F.col("output").eqNullSafe(F.col("expected"))).cast("double")).alias("verified"), ordered_probes().alias("probes")).select("seq", "verified", behavior_signature(F.col("probes")).alias("audit_behavior"))
    changed = ran.join(ablations, "seq").withColumn("other", applied(F.col("without"), F.col("value"))).groupBy("seq", "component").agg(F.bool_or(~F.col("other").eqNullSafe(F.col("expected"))).alias("effective"))
    effective = changed.groupBy("seq").agg(F.count_if("effective").alias("effective_depth"))
    both = own.join(verified, "seq", "left").join(effective, "seq", "left").withColumn("effective_depth", F.coalesce(F.col("effective_depth").cast("int"), F.col("depth")))
    errors = ontology_errors(F.col("family"), F.col("domain"), F.col("depth"), F.col("concepts"))
    weak = (F.col("depth") > 1) & ((F.col("effective_depth") < 2) | (F.col("depth") == 3) & (F.col("effective_depth") < 3))
    both = both.withColumn("reason", F.when(F.size(errors) > 0, "ontology_error").when(weak, "ineffective_composition").when(F.coalesce("verified", F.lit(0.0)) < 1, "long_domain_verifier_failure"))
    both = stored(both, "hardened")
    firsts = first_seen(both.where("reason is null").select("seq", "audit_behavior"), ["audit_behavior"], ["seq"]).select(F.col("seq").alias("_f"))
    judged = both.join(firsts, F.col("seq") == F.col("_f"), "left").withColumn("reason", F.coalesce("reason", F.when(F.col("_f").isNull(), "duplicate_audit_behavior"))).drop("_f")
    chosen = judged.where("reason is null").orderBy(stable_key(seed, "id"), "id").limit(count).drop("reason")
    return chosen, judged.where("reason is not null").groupBy("reason").agg(F.count(F.lit(1)).alias("n"))
