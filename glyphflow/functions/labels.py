"""Labels of a record that follow from its other columns: ontology errors, how much a description reveals, length category,
difficulty, parameter key, marker renaming and another wording of a description."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Names of errors, levels, categories and families, words that descriptions are searched for, and the
#: characters that markers are renamed to, in order.
BINARY_CONCEPTS = ("binary_arithmetic", "bitwise_operation", "binary_representation")
PRIORITY_WORDS, TRANSITION_WORDS = "规则按优先级", "转移"
GIVEN, THEN, FULL_STOP = "输入：", "\n输出：", "。"
CATEGORIES = ("dfa_fst", "reversal", "sorting", "normalization", "arithmetic", "composition")
NEW_MARKERS = "!@$%^&*|?~QWERTYUIOPASDFGHJKLZXCVBNM"


def has(concepts: Column, *names: str) -> Column:
    return F.arrays_overlap(F.coalesce(concepts, F.array().cast("array<string>")), F.array(*map(F.lit, names)))


def ontology_errors(family: Column, domain: Column, depth: Column, concepts: Column) -> Column:
    """The names of the rules that a record's concepts break, in a fixed order."""
    broken = {
        "binary_increment_mislabeled_unary": (family == "binary_increment") & has(concepts, "unary_arithmetic"),
        "binary_family_missing_binary_concept": F.startswith(family, F.lit("binary_")) & ~has(concepts, *BINARY_CONCEPTS),
        "composition_missing_concept": (depth > 1) & ~has(concepts, "composition"),
        "fsm_domain_missing_concept": (domain == "finite_state_machines") & ~has(concepts, "finite_state_machine"),
    }
    return F.array_compact(F.array(*(F.when(when, name) for name, when in broken.items())))


def specification(style: Column, source: Column, description: Column, program: Column, depth: Column) -> Column:
    """struct<level, score>: examples alone reveal nothing, rules told one by one nearly all, the more the longer."""
    operational = (source == "random_mined") | F.contains(description, F.lit(PRIORITY_WORDS))
    lines = F.size(F.split(F.regexp_replace(program, "\n$", ""), "\n"))
    level = F.when(style == "io_only", "io_only").when(operational, "operational").otherwise("functional")
    functional = F.lit(0.25) + F.when(depth > 1, 0.1).otherwise(0.0) + F.when(F.contains(description, F.lit(TRANSITION_WORDS)), 0.15).otherwise(0.0)
    score = F.when(style == "io_only", 0.0).when(operational, F.lit(0.65) + lines * 0.1).otherwise(functional)
    return F.struct(level.alias("level"), F.round(F.least(score, F.lit(1.0)), 6).alias("score"))


def length_category(family: Column, domain: Column, depth: Column) -> Column:
    """Which of the categories of the length audit a record is in, or null."""
    return (
        F.when(family.isin("random_dfa", "random_fst"), "dfa_fst").when(family.isin("reversal", "binary_reverse"), "reversal").when(family == "symbol_sort", "sorting")
        .when(F.contains(family, F.lit("normalizer")), "normalization").when(domain.isin("unary_arithmetic", "binary_operations"), "arithmetic").when(depth > 1, "composition")
    )


def difficulty(lines: Column, depth: Column, per: int = 8) -> Column:
    """From 1 to 5: deeper and longer programs are harder. lines: how many rules; per: so many rules are one more."""
    return F.least(F.lit(5), 1 + depth + F.floor(lines / per)).cast("int")


def renamed_markers(program: Column, markers: Column) -> Column:
    """program with each marker (array of characters) as the next new marker that the program doesn't have."""
    fresh = F.filter(F.split(F.lit(NEW_MARKERS), ""), lambda c: ~F.contains(program, c))
    old = F.array_distinct(markers)
    to = F.map_from_arrays(old, F.slice(fresh, F.lit(1), F.size(old)))
    return F.array_join(F.transform(F.split(program, ""), lambda c: F.coalesce(F.try_element_at(to, c), c)), "")


def reworded(description: Column) -> Column:
    """The same description in another form: what is given and what follows change places with a sentence's parts."""
    two = F.startswith(description, F.lit(GIVEN)) & F.contains(description, F.lit(THEN))
    at, stop = F.instr(description, THEN), F.instr(description, FULL_STOP)
    given = F.concat(F.lit("给定"), F.substr(description, F.lit(len(GIVEN) + 1), at - len(GIVEN) - 1), F.lit("，"), F.substr(description, at + len(THEN)))
    sentence = F.concat(F.lit(GIVEN), F.left(description, stop - 1), F.lit(FULL_STOP + THEN), F.substr(description, stop + 1))
    return F.when(two, given).when(stop > 0, sentence).otherwise(F.concat(F.lit("输出要求："), description))


def parameter_key(family: Column, kinds: Column, sizes: Column, traits: Column, longest: Column) -> Column:
    """Canonical JSON of what a family of parameters has in common: kinds of operations, sizes of their parameters (by
    kind), enabled traits in order, and the longest input."""
    operations = F.transform(F.arrays_zip(kinds.alias("kind"), sizes.alias("size")), lambda x: F.struct(x["kind"].alias("kind"), x["size"].alias("size")))
    return F.to_json(F.struct(F.array_sort(traits).alias("behavior_cluster"), family.alias("family"), longest.alias("max_input_length"), operations.alias("operations")), {"ignoreNullFields": "false"})


def blacklisted(text: Column, phrases: list[str]) -> Column:
    """Whether a text has one of the phrases; null has none."""
    return F.coalesce(F.exists(F.array(*map(F.lit, phrases)), lambda p: F.contains(text, p)), F.lit(False))
