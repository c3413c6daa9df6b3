"""Splits that hold out one thing each: instances, families, lengths, parameters, names, compositions, orders, concepts, styles.

problems: id, seq (place in the list), family, input_length, style, concepts, sequence (kinds of operations), lines (of the
program), structure, markers (one string, empty for none), parameters (a key), behavior. A phase assigns a split to rows
that have none; each is a grouping, a window or a join with a few chosen keys, and its result is stored.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from glyphflow.functions.labels import renamed_markers, reworded
from glyphflow.operators.audits import failures
from glyphflow.operators.selection import ranked, stable_key
from glyphflow.sources.work import stored

#: The splits, what is held out, and how many of each kind of holdout there are at most.
SPLITS = (
    "train", "validation", "test_instance", "test_family", "test_length", "test_parameter_holdout", "test_alpha_renaming", "test_composition", "test_operation_order",
    "test_concept_holdout", "test_description_style", "test_program_length",
)
FAMILY, STYLE, CONCEPT = "reversal", "rules", "finite_state_machine"
ORDERS, COMPOSITIONS, RENAMINGS, PARAMETERS = 8, 10, 10, 12


def free() -> Column:
    return F.col("split").isNull()


def assigned(df: DataFrame, chosen: DataFrame, key: str, to: str | None, force: bool = False, only: Column | None = None) -> DataFrame:
    """df with the rows whose key is chosen (a few) in split to, or forced into train."""
    marks = F.broadcast(chosen.select(F.col(key).alias("_key")).distinct().withColumn("_hit", F.lit(True)))
    out = df.join(marks, df[key] == F.col("_key"), "left")
    hit = F.coalesce("_hit", F.lit(False)) & (F.lit(True) if only is None else only)
    out = out.withColumn("forced", F.col("forced") | hit) if force else out.withColumn("split", F.when(hit, to).otherwise(F.col("split")))
    return out.drop("_key", "_hit")


def orders(df: DataFrame) -> DataFrame:
    """left and right: the first problem of an operation sequence and the first of the reversed one; one pair for each set
    of kinds, the first sets in the list."""
    rows = df.where(free() & (F.size("sequence") >= 2))
    firsts = rows.groupBy("sequence").agg(F.min(F.struct("seq", "id")).alias("first"))
    a, b = firsts.select(F.col("sequence").alias("s"), F.col("first").alias("a")), firsts.select(F.reverse("sequence").alias("r"), F.col("first").alias("b"))
    pairs = a.join(b, F.col("s") == F.col("r")).where(F.col("s") < F.reverse("s")).groupBy(F.array_sort("s").alias("kinds")).agg(F.min(F.struct("s", "a", "b")).alias("p"))
    place = rows.groupBy(F.array_sort("sequence").alias("k")).agg(F.min("seq").alias("at"))
    return pairs.join(place, F.col("kinds") == F.col("k")).orderBy("at").limit(ORDERS).select(F.col("p.a.id").alias("left"), F.col("p.b.id").alias("right"))


def compositions(df: DataFrame, seed: int) -> DataFrame:
    """The sequences that are held out as a whole: all their kinds stand alone in a free problem, and no forced problem has them."""
    anchors = df.where(free() & (F.size("sequence") == 1)).agg(F.collect_set(F.col("sequence")[0]).alias("anchors"))  # kinds of operations: a fixed few
    rows = df.where(F.size("sequence") >= 2).groupBy("sequence").agg(F.min(F.when(free(), stable_key(seed, "id"))).alias("order"), F.bool_or("forced").alias("taken"))
    fit = rows.where("order is not null and not taken").crossJoin(F.broadcast(anchors)).where(F.size(F.array_except("sequence", "anchors")) == 0)
    return fit.orderBy("order").limit(COMPOSITIONS).select("sequence")


def renamings(df: DataFrame) -> DataFrame:
    """left and right: problems of one structure whose markers differ; the right one's markers are nobody else's."""
    rows = df.where(F.col("markers") != "")
    alone = rows.groupBy("markers").agg(F.count(F.lit(1)).alias("n")).where("n = 1").select(F.col("markers").alias("only"))
    firsts = rows.where(free()).groupBy("structure", "markers").agg(F.min(F.struct("seq", "id")).alias("first"))
    ranked = firsts.withColumn("rank", F.row_number().over(Window.partitionBy("structure").orderBy("first")))
    left = ranked.where("rank = 1").select(F.col("structure").alias("s"), F.col("first").alias("a"))
    right = ranked.where("rank > 1").join(alone, F.col("markers") == F.col("only"), "left_semi").groupBy("structure").agg(F.min("first").alias("b"))
    return left.join(right, F.col("s") == F.col("structure")).orderBy("a").limit(RENAMINGS).select(F.col("a.id").alias("left"), F.col("b.id").alias("right"))


def parameter_holdouts(df: DataFrame, seed: int) -> DataFrame:
    """For the first families with two parameter keys or more: the last key by hash, and the first problem of the first key."""
    rows = df.where(free()).groupBy("family", "parameters").agg(F.min(F.struct("seq", "id")).alias("first"))
    keyed = rows.groupBy("family").agg(F.count(F.lit(1)).alias("n"), F.min_by("first", stable_key(seed, "parameters")).alias("first"), F.max_by("parameters", stable_key(seed, "parameters")).alias("held"))
    return keyed.where("n > 1").orderBy("family").limit(PARAMETERS).select("family", "held", F.col("first.id").alias("left"))


def generalization_split(problems: DataFrame, seed: int) -> DataFrame:
    """problems with their split. The result depends on ids, list places and the seed only, not on partitions."""
    longest = F.broadcast(problems.agg(F.max("input_length").alias("_longest"), F.count(F.lit(1)).alias("_n")))  # one row
    of = F.when(F.array_contains("concepts", CONCEPT), "test_concept_holdout").when(F.col("family") == FAMILY, "test_family").when(F.col("input_length") == F.col("_longest"), "test_length").when(F.col("style") == STYLE, "test_description_style")
    df = stored(problems.crossJoin(longest).withColumns({"split": of, "forced": F.lit(False)}).drop("_longest"), "split-1")
    pairs = stored(orders(df), "split-orders")
    df = assigned(df, pairs.select(F.col("left").alias("id")), "id", None, force=True)
    df = stored(assigned(df, pairs.select(F.col("right").alias("id")), "id", "test_operation_order"), "split-2")
    lengths = df.groupBy("lines").agg(F.count_if(free() & ~F.col("forced")).alias("n"), F.bool_or("forced").alias("taken")).where("n >= 2 and not taken").agg(F.max("lines").alias("lines")).where("lines is not null")
    df = stored(assigned(df, lengths, "lines", "test_program_length", only=free() & ~F.col("forced")), "split-3")
    held = stored(compositions(df, seed), "split-sequences")
    kinds = held.select(F.explode("sequence").alias("kind")).distinct()
    firsts = df.where(free() & (F.size("sequence") == 1)).groupBy(F.col("sequence")[0].alias("kind")).agg(F.min(F.struct("seq", "id")).alias("first")).join(F.broadcast(kinds), "kind", "left_semi").select(F.col("first.id").alias("id"))
    df = assigned(df, held, "sequence", "test_composition", only=~F.col("forced"))
    df = stored(assigned(df, firsts, "id", None, force=True), "split-4")
    pairs = stored(renamings(df), "split-renamings")
    df = assigned(df, pairs.select(F.col("left").alias("id")), "id", None, force=True)
    df = stored(assigned(df, pairs.select(F.col("right").alias("id")), "id", "test_alpha_renaming"), "split-5")
    held = stored(parameter_holdouts(df, seed + 1), "split-parameters")
    marks = F.broadcast(held.select(F.col("family").alias("_f"), F.col("held").alias("_p")))
    df = df.join(marks, (F.col("family") == F.col("_f")) & (F.col("parameters") == F.col("_p")), "left")
    df = df.withColumn("split", F.when(free() & F.col("_f").isNotNull(), "test_parameter_holdout").otherwise(F.col("split"))).drop("_f", "_p")
    df = stored(assigned(df, held.select(F.col("left").alias("id")), "id", None, force=True), "split-6")
    alike = df.where("split = 'test_alpha_renaming'").select("markers")
    df = stored(assigned(df, alike, "markers", "test_alpha_renaming", only=free() & ~F.col("forced")), "split-7")
    # the first instances and validation problems by hash: as many as a share of all, ranked with the limit as a bound
    left = df.where(free() & ~F.col("forced")).select("id", stable_key(seed + 4, "id").alias("order"), F.greatest(F.lit(5), F.floor(F.col("_n") / 25)).alias("tests"), F.greatest(F.lit(5), F.floor(F.col("_n") / 20)).alias("more"))
    firsts = ranked(left, ["order"]).select(F.col("id").alias("_id"), F.when(F.col("rank") <= F.col("tests"), "test_instance").when(F.col("rank") <= F.col("tests") + F.col("more"), "validation").alias("_to"))
    out = df.join(firsts, F.col("id") == F.col("_id"), "left").withColumn("split", F.coalesce("split", "_to", F.lit("train")))
    return out.select(*problems.columns, "split")


def generalization_audit(split: DataFrame, concepts: tuple[str, ...] = (CONCEPT,), style: str = STYLE) -> DataFrame:
    """One row of fourteen counters, all zero for a clean split, and whether it passed: every counter zero and no split empty."""
    train = split.where("split = 'train'")
    of = lambda name: split.where(F.col("split") == name)
    count = lambda df, name: df.agg(F.count(F.lit(1)).alias(name))

    def seen(name: str, part: str, column: str, distinct: bool = True) -> DataFrame:
        rows = of(part).select(column)
        return count((rows.distinct() if distinct else rows).join(train.select(column).distinct(), column, "left_semi"), name)

    kinds = F.broadcast(train.select(F.explode("sequence").alias("kind")).distinct().agg(F.collect_set("kind").alias("kinds")))  # kinds: a fixed few
    sorted_train = train.select(F.array_sort("sequence").alias("k"), F.col("sequence").alias("s")).distinct()
    order = of("test_operation_order").select("id", "sequence", F.array_sort("sequence").alias("kinds_"))
    proved = order.join(sorted_train, F.col("kinds_") == F.col("k")).where(F.col("s") != F.col("sequence")).select("id").distinct()
    marked = lambda df: df.where(F.col("markers") != "")
    behaviors = split.groupBy("behavior").agg(F.count_distinct("split").alias("n"))
    parts = [
        split.groupBy("id").agg((F.count(F.lit(1)) - 1).alias("n")).agg(F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("duplicate_ids")),
        behaviors.agg(F.count_if(F.col("n") > 1).alias("behavior_cross_split")),
        seen("composition_sequence_seen_in_train", "test_composition", "sequence", False),
        of("test_composition").crossJoin(kinds).agg(F.count_if(F.size(F.array_except("sequence", "kinds")) > 0).alias("composition_component_missing_from_train")),
        seen("operation_order_seen_in_train", "test_operation_order", "sequence", False),
        count(order.join(proved, "id", "left_anti"), "operation_order_without_permutation_in_train"),
        count(marked(of("test_alpha_renaming")).join(marked(train).select("markers").distinct(), "markers", "left_semi"), "alpha_marker_allocation_seen_in_train"),
        train.agg(reduce(lambda a, c: a + F.coalesce(F.max(F.array_contains("concepts", c).cast("long")), F.lit(0)), concepts, F.lit(0).cast("long")).alias("held_out_concept_seen_in_train")),
        seen("held_out_family_seen_in_train", "test_family", "family"),
        seen("held_out_input_length_seen_in_train", "test_length", "input_length"),
        seen("held_out_parameter_seen_in_train", "test_parameter_holdout", "parameters", False),
        train.agg(F.coalesce(F.max((F.col("style") == style).cast("long")), F.lit(0)).alias("held_out_description_style_seen_in_train")),
        seen("program_length_holdout_seen_in_train", "test_program_length", "lines"),
        split.agg((F.count_if(F.col("split") == "test_program_length") == 0).cast("long").alias("program_length_split_empty"), F.count_distinct("split").alias("splits")),
    ]
    row = reduce(lambda a, b: a.crossJoin(F.broadcast(b)), parts)  # one row each
    names = [c for c in row.columns if c != "splits"]
    return row.select(*names, (reduce(lambda a, c: a & (F.col(c) == 0), names, F.lit(True)) & (F.col("splits") == len(SPLITS))).alias("passed"))


#: The splits by lineage, and how many pairs each benchmark has at most.
LINEAGE_SPLITS = ("train", "validation", "test_length", "test_parameter_holdout", "test_alpha_renaming", "test_composition", "test_operation_order", "test_description_style")
PAIRS, LONG_PAIRS, PARAMETER_PAIRS = 8, 12, 10
BENCHMARK = "kind string, root string, partners array<string>, detail string"


def given(df: DataFrame, chosen: DataFrame) -> DataFrame:
    """df with the split of the chosen groups (alpha, to); a group that has one keeps it."""
    marks = F.broadcast(chosen.groupBy(F.col("alpha").alias("_alpha")).agg(F.min("to").alias("_to")))
    return df.join(marks, df["alpha"] == F.col("_alpha"), "left").withColumn("split", F.coalesce("split", "_to")).drop("_alpha", "_to")


def first_groups(df: DataFrame, fits: Column, seed: int, most: int) -> DataFrame:
    """The first groups by hash of a free problem that fits: its row."""
    rows = df.where(free() & fits).withColumn("_order", stable_key(seed, "id"))
    first = rows.groupBy("alpha").agg(F.min(F.struct("_order", "id")).alias("x")).orderBy("x").limit(most).select(F.col("x.id").alias("_id"))
    return df.join(F.broadcast(first), df["id"] == F.col("_id")).drop("_id")


def composition_pairs(df: DataFrame, seed: int) -> DataFrame:
    """to, alpha, id and partners: free genuine compositions, each with a free problem of every kind alone that goes to train.

    An anchor serves one composition, and a composition that finds none has used up those that it found before, so one
    task passes over the candidates in hash order. It holds the anchors' groups, a row for each problem of one operation.
    """
    rows = df.select("id", "alpha", "seq", "sequence", "split", stable_key(seed, "id").alias("order"), (free() & F.col("genuine") & (F.size("sequence") > 1)).alias("candidate"))
    rows = rows.where((F.size("sequence") == 1) | F.col("candidate")).withColumn("turn", F.when(F.col("candidate"), F.col("order")).otherwise(F.concat(F.lit(" "), F.lpad(F.col("seq").cast("string"), 12, "0"))))

    def choose(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        anchors, taken, found = defaultdict(list), {}, 0
        for frame in frames:  # anchors come first, by their place in the list
            out = []
            for id_, alpha, sequence, split, candidate in zip(*(frame[c] for c in ("id", "alpha", "sequence", "split", "candidate")), strict=True):
                kinds = list(dict.fromkeys(sequence))
                if not candidate:
                    anchors[kinds[0]].append((id_, alpha))
                    if split is not None:
                        taken[alpha] = split
                elif found < PAIRS and alpha not in taken and all(anchors[k] for k in kinds):
                    chosen = []
                    for k in kinds:
                        at = next((x for x in anchors[k] if x[1] not in taken), None)
                        if at is None:
                            break
                        taken[at[1]] = "train"
                        chosen.append(at)
                    out += [("train", a, i, None) for i, a in chosen]
                    if len(chosen) == len(kinds) and alpha not in taken:
                        taken[alpha] = "test_composition"
                        out.append(("test_composition", alpha, id_, [i for i, _ in chosen]))
                        found += 1
            yield pd.DataFrame(out, columns=["to", "alpha", "id", "partners"])

    narrow = rows.select("id", "alpha", "sequence", "split", "candidate", "turn").repartition(1).sortWithinPartitions("turn")
    return narrow.mapInPandas(choose, "to string, alpha string, id string, partners array<string>")


def parameter_pairs(df: DataFrame, seed: int) -> DataFrame:
    """to, alpha, id and partners: for families with two parameter keys or more, the first problem of the first key by hash
    for train and that of the last for test, unless their groups have gone elsewhere. A pass over a row for each family."""
    firsts = df.where(free()).groupBy("family", "parameters").agg(F.min(F.struct("seq", "id", "alpha")).alias("first"))
    key = stable_key(seed, "parameters")
    pairs = firsts.groupBy("family").agg(F.count(F.lit(1)).alias("n"), F.min_by("first", key).alias("a"), F.max_by("first", key).alias("b")).where("n > 1")

    def choose(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        taken, found = {}, 0
        for frame in frames:
            out = []
            for a, i, b, j in zip(*(frame[c] for c in ("a", "i", "b", "j")), strict=True):
                if found < PARAMETER_PAIRS and taken.setdefault(a, "train") == "train":
                    out.append(("train", a, i, None))
                    if taken.setdefault(b, "test_parameter_holdout") == "test_parameter_holdout":
                        out.append(("test_parameter_holdout", b, j, [i]))
                        found += 1
            yield pd.DataFrame(out, columns=["to", "alpha", "id", "partners"])

    narrow = pairs.select("family", F.col("a.alpha").alias("a"), F.col("a.id").alias("i"), F.col("b.alpha").alias("b"), F.col("b.id").alias("j")).repartition(1).sortWithinPartitions("family")
    return narrow.mapInPandas(choose, "to string, alpha string, id string, partners array<string>")


def lineage_split(problems: DataFrame, seed: int) -> tuple[DataFrame, DataFrame]:
    """problems with their split, and the benchmarks: kind, root, partners and detail (JSON) of each pair that differs in one
    thing only. Programs of one alpha class are in one split.

    problems: id, seq, alpha, program, markers (array), tests (array of struct<input, output>), order_sensitive, depth,
    distinguishing (an input or null), sequence, genuine, construction_length, generalization_length, level, description,
    family, parameters.
    """
    df = stored(problems.withColumn("split", F.lit(None).cast("string")), "lineage-0")
    pairs: list[DataFrame] = []
    told = lambda to, detail, partners=None: (F.lit(to).alias("kind"), F.col("id").alias("root"), (F.array().cast("array<string>") if partners is None else partners).alias("partners"), F.to_json(detail, {"ignoreNullFields": "false"}).alias("detail"))

    def settle(number: int, to: str, chosen: DataFrame, detail: Column) -> None:
        nonlocal df
        chosen = stored(chosen, f"lineage-pairs-{number}")
        pairs.append(chosen.select(*told(to, detail)))
        df = stored(given(df, chosen.select("alpha", F.lit(to).alias("to"))), f"lineage-{number}")

    heads = df.groupBy("alpha").agg(F.min_by("id", "seq").alias("head"), F.min(F.when(F.size("markers") > 0, F.struct("seq", "id"))).alias("marked")).where("marked is not null")
    marked = df.join(heads.select(F.col("marked.id").alias("_id"), "head"), F.col("id") == F.col("_id")).drop("_id").withColumn("variant", renamed_markers(F.col("program"), F.col("markers")))
    marked = marked.where("variant <> program").withColumn("_order", stable_key(seed, "head")).orderBy("_order").limit(PAIRS).drop("_order", "head")
    wrong = failures(marked.select("id", F.col("variant").alias("program"), "tests")).select(F.col("id").alias("_id")).distinct()
    marked = marked.join(wrong, F.col("id") == F.col("_id"), "left").withColumn("verified", F.col("_id").isNull()).drop("_id")
    settle(1, "test_alpha_renaming", marked, F.struct("program", "variant", "verified"))
    settle(2, "test_operation_order", first_groups(df, F.col("order_sensitive") & (F.col("depth") >= 2), seed + 1, PAIRS), F.struct("sequence", "distinguishing", F.col("distinguishing").isNotNull().alias("proved")))
    for number, made, kind in ((3, composition_pairs, "test_composition"), (6, parameter_pairs, "test_parameter_holdout")):
        if number == 6:
            settle(4, "test_length", first_groups(df, F.col("generalization_length") > F.col("construction_length"), seed + 3, LONG_PAIRS), F.struct("program", "construction_length", "generalization_length"))
            settle(5, "test_description_style", first_groups(df, F.col("level") == "functional", seed + 4, LONG_PAIRS), F.struct("description", reworded(F.col("description")).alias("variant")))
        chosen = stored(made(df, seed + (2 if number == 3 else 5)), f"lineage-pairs-{number}")
        pairs.append(chosen.where(F.col("to") == kind).select(*told(kind, F.struct("alpha"), F.col("partners"))))
        df = stored(given(df, chosen.select("alpha", "to")), f"lineage-{number}")
    n = problems.count()
    some = ranked(df.where(free()).select("alpha", "id", stable_key(seed + 6, "id").alias("order")), ["order", "id"]).where(F.col("rank") <= max(12, n // 20))
    df = given(df, some.select("alpha", F.lit("validation").alias("to")))
    return df.withColumn("split", F.coalesce("split", F.lit("train"))), reduce(DataFrame.unionByName, pairs)


def lineage_audit(problems: DataFrame, auxiliary: DataFrame, benchmarks: DataFrame) -> DataFrame:
    """One row of six counters and whether all are zero.

    problems: id, split, lineage, mutant, alpha. auxiliary: root, split, lineage, mutant, alpha. benchmarks: kind
    ('test_operation_order' or 'test_alpha_renaming'), proved (of orders), distinguishing (an input or null), verified.
    """
    both = problems.select("lineage", "mutant", "alpha", "split").unionByName(auxiliary.select("lineage", "mutant", "alpha", "split"))
    crossing = lambda key, name: both.where(F.col(key).isNotNull()).groupBy(key).agg(F.count_distinct("split").alias("n")).agg(F.count_if(F.col("n") > 1).alias(name))
    roots = problems.select(F.col("id").alias("root"), F.col("split").alias("own")).dropDuplicates(["root"])
    order, alpha = F.col("kind") == "test_operation_order", F.col("kind") == "test_alpha_renaming"
    parts = [
        crossing("lineage", "lineage_cross_split"), crossing("mutant", "mutant_family_cross_split"), auxiliary.join(roots, "root").agg(F.count_if(F.col("split") != F.col("own")).alias("auxiliary_reference_cross_split")),
        crossing("alpha", "alpha_equivalent_program_cross_split"), benchmarks.agg(F.count_if(order & (~F.coalesce("proved", F.lit(False)) | F.col("distinguishing").isNull())).alias("operation_order_unproved"), F.count_if(alpha & ~F.coalesce("verified", F.lit(False))).alias("alpha_pair_unverified")),
    ]
    row = reduce(lambda a, b: a.crossJoin(F.broadcast(b)), parts)  # one row each
    return row.withColumn("passed", reduce(lambda a, c: a & (F.col(c) == 0), row.columns, F.lit(True)))
