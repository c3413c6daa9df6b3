"""Statistics of a data set of problems, each table in one pass, and the checks that a data set must pass to be released.

problems has a row for each problem; which columns a function reads, its docstring says. Counts by value are maps, so that
a table of statistics is one row; the values that they go by are few (names of kinds, depths, lines of a program).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: What the release checks ask for.
ARCHETYPES, FAMILIES, EACH, MOST_LINES = 60, 20, 3, 32
GENUINE, SIZES = (0.15, 0.25), {"train": 40, "validation": 10, "test": 10}
DIVERSITY_SIZE, HARDENING_SIZE, DOMAINS, CONCEPTS, SOURCES, NON_TEMPLATE, LARGEST_CLUSTER, RESKINS, MONOPOLY = (200, 500), (240, 500), 6, 20, 4, 0.25, 3, 10, 0.5


def fraction(n: Column, of: Column) -> Column:
    return F.when(of > 0, F.round(n / of, 6)).otherwise(F.lit(0.0))


def counts(df: DataFrame, column: str, key: Column | None = None) -> DataFrame:
    """One row: a map from each value of a column to how often it occurs, by value."""
    each = df.groupBy((F.col(column) if key is None else key).cast("string").alias("k")).agg(F.count(F.lit(1)).alias("n")).where("k is not null")
    return each.agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("k", "n")))).alias(column))


def beside(*rows: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.crossJoin(F.broadcast(b)), rows)  # one row each


def quality_statistics(problems: DataFrame) -> DataFrame:
    """problem_count, mean identity and terminating fractions, constant_fraction, overlap and duplicates of behavior, and
    distributions of lines and of steps. Reads identity_fraction, terminating_fraction, distinct_outputs, overlap, lines,
    steps (array), behavior."""
    n = F.count(F.lit(1))
    row = problems.agg(
        n.alias("problem_count"), fraction(F.sum("identity_fraction"), n).alias("identity_fraction"), fraction(F.count_if(F.col("distinct_outputs") == 1), n).alias("constant_fraction"),
        fraction(F.sum("terminating_fraction"), n).alias("terminating_fraction"), F.coalesce(F.sum("overlap"), F.lit(0)).cast("long").alias("public_hidden_overlap"),
    )
    extra = problems.groupBy("behavior").agg((F.count(F.lit(1)) - 1).alias("n")).agg(F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("behavior_duplicates"))
    return beside(row, extra, counts(problems, "lines"), counts(problems.select(F.explode("steps").alias("steps")), "steps"))


def cognitive_statistics(problems: DataFrame) -> DataFrame:
    """One row of counts, fractions and distributions. Reads family, archetype, source, domain, depth, genuine, probe (all
    components effective), level, behavior, alpha, verified (fraction), lines, steps (array), identity_fraction,
    constant_fraction, terminating_fraction, overlap, split."""
    n, composed = F.count(F.lit(1)), F.col("depth") > 1
    row = problems.agg(
        n.alias("synthesis_problem_count"), F.count_distinct("family").alias("cognitive_family_count"), F.count_distinct("archetype").alias("semantic_archetype_count"), F.count_if("genuine").alias("genuine_composition_count"),
        fraction(F.count_if(composed), n).alias("genuine_composition_fraction"), F.count_if(composed & ~F.coalesce("probe", F.lit(False))).alias("composition_component_probe_failures"),
        F.count_if(F.col("level") == "operational").alias("operational_description_count"), (n - F.count_distinct("behavior")).alias("behavior_duplicates"), fraction(F.count_if(F.col("verified") == 1), n).alias("reference_verification_fraction"),
        F.round(F.avg("identity_fraction"), 6).alias("identity_fraction_mean"), F.round(F.avg("constant_fraction"), 6).alias("constant_fraction_mean"), fraction(F.count_if(F.col("terminating_fraction") == 1), n).alias("terminating_fraction"),
        F.coalesce(F.sum("overlap"), F.lit(0)).cast("long").alias("public_hidden_overlap"), F.max("lines").alias("max_program_lines"),
    )
    steps = problems.select(F.explode("steps").alias("s")).agg(F.min("s").alias("min_steps"), F.max("s").alias("max_steps"), F.round(F.avg("s"), 6).alias("mean_steps"))
    alpha = problems.groupBy("alpha").agg(F.count(F.lit(1)).alias("n")).agg(F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0)).cast("long").alias("alpha_equivalent_problem_count"), F.max("n").alias("max_alpha_cluster_size"))
    each = [counts(problems, c).withColumnRenamed(c, f"{c}_distribution") for c in ("family", "source", "domain", "depth", "lines", "split")]
    return beside(row, steps, alpha, *each)


def hardening_statistics(problems: DataFrame) -> DataFrame:
    """One row. Reads level, score, depth, interaction, genuine, superficial, effective_depth, effective (array), behavior,
    alpha_behavior, structure, meaning (fingerprint of the operations), ontology_errors (array), verified, split."""
    n, composed = F.count(F.lit(1)), F.col("depth") > 1
    parts = F.count_if(composed)
    row = problems.agg(
        n.alias("problem_count"), parts.alias("composition_count"), F.count_if(composed & F.col("genuine")).alias("genuine_count"), F.count_if(composed & F.col("superficial")).alias("superficial_count"),
        fraction(F.count_if(composed & F.col("genuine")), parts).alias("genuine_fraction"), fraction(F.count_if(composed & F.col("superficial")), parts).alias("superficial_fraction"),
        F.coalesce(F.bool_and(F.when(composed, F.col("effective_depth") >= 2)), F.lit(True)).alias("all_effective_depth_at_least_two"), F.coalesce(F.bool_and(F.when(F.col("depth") == 3, F.size("effective") == 3)), F.lit(True)).alias("all_depth_three_components_effective"),
        *(F.count_distinct(c).alias(name) for c, name in (("behavior", "concrete_behavior_unique"), ("alpha_behavior", "alpha_normalized_behavior_unique"), ("structure", "structural_unique"), ("meaning", "semantic_ir_unique"))),
        (n - F.count_distinct("behavior")).alias("behavior_duplicates"), F.coalesce(F.sum(F.size("ontology_errors")), F.lit(0)).cast("long").alias("ontology_error_count"), fraction(F.count_if(F.col("verified") == 1), n).alias("reference_verification_fraction"),
    )
    each = [counts(problems, c).withColumnRenamed(c, f"{c}_counts") for c in ("level", "score", "split")]
    return beside(row, *each, counts(problems.where("depth > 1"), "interaction").withColumnRenamed("interaction", "interaction_counts"))


def passed(row: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """The checks of a row of statistics, and whether all passed."""
    named = {k: F.coalesce(v, F.lit(False)) for k, v in checks.items()}
    return row.select(*(v.alias(k) for k, v in named.items()), reduce(lambda a, b: a & b, named.values(), F.lit(True)).alias("passed"))


def cognitive_checks(statistics: DataFrame) -> DataFrame:
    """The eleven checks of cognitive_statistics()."""
    c = F.col
    sizes = reduce(lambda a, kv: a & (F.try_element_at("split_distribution", F.lit(kv[0])) == kv[1]), SIZES.items(), F.size("split_distribution") == len(SIZES))
    return passed(statistics, {
        "archetypes": (c("synthesis_problem_count") == ARCHETYPES) & (c("semantic_archetype_count") == ARCHETYPES), "families": c("cognitive_family_count") == FAMILIES,
        "archetypes_per_family": F.forall(F.map_values("family_distribution"), lambda n: n == EACH), "verified": c("reference_verification_fraction") == 1, "no_behavior_duplicates": c("behavior_duplicates") == 0,
        "no_alpha_equivalents": c("alpha_equivalent_problem_count") == 0, "no_operational_descriptions": c("operational_description_count") == 0, "genuine_fraction": c("genuine_composition_fraction").between(*GENUINE),
        "components_effective": c("composition_component_probe_failures") == 0, "program_limits": c("max_program_lines") <= MOST_LINES, "split_sizes": sizes,
    })


def diversity_checks(problems: DataFrame, split_passed: Column | bool, reskins: int) -> DataFrame:
    """The sixteen checks of a diverse data set. Reads domain, source, family, template, concepts (array), depth, verified,
    behavior, structure; one pass for each distribution."""
    n = F.count(F.lit(1))
    row = problems.agg(
        n.alias("n"), fraction(F.count_if(F.col("source") != "template"), n).alias("non_template"), F.count_if(F.col("verified") == 1).alias("verified"), F.count_distinct("behavior").alias("behaviors"),
        F.array_sort(F.collect_set("depth")).alias("depths"), F.count_distinct("domain").alias("domains"), F.count_distinct("source").alias("sources"),
    )
    most = lambda df, key: df.groupBy(key).agg(F.count(F.lit(1)).alias("k")).agg(F.coalesce(F.max("k"), F.lit(0)).alias(f"most_{key}"), F.count(F.lit(1)).alias(f"all_{key}"))
    largest = [most(problems, key) for key in ("source", "domain", "family", "template", "structure")] + [most(problems.select(F.explode("concepts").alias("concept")), "concept")]
    c, size = F.col, F.col("n")
    return passed(beside(row, *largest), {
        "count": size.between(*DIVERSITY_SIZE), "domains": c("domains") >= DOMAINS, "concepts": c("all_concept") >= CONCEPTS, "source_types": c("sources") >= SOURCES, "all_depths": F.size(F.array_except(F.array(*map(F.lit, (1, 2, 3))), "depths")) == 0,
        "non_template": c("non_template") >= NON_TEMPLATE, "verified": c("verified") == size, "no_behavior_duplicates": c("behaviors") == size, "no_leakage": F.lit(split_passed) if isinstance(split_passed, bool) else split_passed,
        "cluster_sizes": c("most_structure") <= LARGEST_CLUSTER, "reskin_examples": F.lit(reskins >= RESKINS), **{f"balanced_{k}": c(f"most_{k}") / size < MONOPOLY for k in ("source", "domain", "family", "template", "concept")},
    })


def hardening_checks(statistics: DataFrame, lineage: DataFrame, lengths: DataFrame) -> DataFrame:
    """The fifteen checks of hardening_statistics(), a lineage_audit() and a length audit (category, n, all_verified, longer)."""
    long = lengths.agg(F.coalesce(F.bool_and((F.col("n") > 0) & F.col("all_verified") & F.col("longer")), F.lit(False)).alias("lengths"))
    c = F.col
    zero = ("lineage_cross_split", "mutant_family_cross_split", "auxiliary_reference_cross_split", "alpha_equivalent_program_cross_split", "operation_order_unproved", "alpha_pair_unverified")
    return passed(beside(statistics, lineage, long), {
        "count": c("problem_count").between(*HARDENING_SIZE), "verified": c("reference_verification_fraction") == 1, "no_behavior_duplicates": c("behavior_duplicates") == 0, **{f"no_{z}": c(z) == 0 for z in zero},
        "no_ontology_errors": c("ontology_error_count") == 0, "all_compositions_effective": c("all_effective_depth_at_least_two"), "all_depth_three_components_effective": c("all_depth_three_components_effective"),
        "genuine_composition": c("genuine_count") > 0, "operational_reported": F.array_contains(F.map_keys("level_counts"), "operational"), "long_domains": c("lengths"),
    })
