"""Aggregates over outcomes and records: quality, distributions, duplicates, leakage, clusters, scores and checks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def share(n: Column, of: Column) -> Column:
    return F.when(of > 0, F.round(n / of, 6)).otherwise(F.lit(0.0))


def quality_metrics(outcomes: DataFrame, *keys: str) -> DataFrame:
    """n, identity, constant and terminating fractions, distinct outputs and steps for each key; outputs of runs that ended.

    Two levels: by output first, so that the commonest output needs no list of all.
    """
    by = outcomes.groupBy(*keys, "terminating", "output").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("value") == F.col("output")).alias("same"), F.min("steps").alias("least"), F.max("steps").alias("most"), F.sum("steps").alias("steps"))
    ended = F.col("terminating")
    done, total = F.sum(F.when(ended, F.col("n")).otherwise(0)), F.sum("n")
    return by.groupBy(*keys).agg(
        total.alias("n"), share(F.sum(F.when(ended, F.col("same")).otherwise(0)), done).alias("identity_fraction"), share(F.max(F.when(ended, F.col("n")).otherwise(0)), done).alias("constant_fraction"),
        share(done, total).alias("terminating_fraction"), F.count_if(ended).alias("distinct_outputs"), F.min("least").alias("min_steps"), F.max("most").alias("max_steps"), F.round(F.sum("steps") / total, 6).alias("mean_steps"),
    )


def gated(metrics: DataFrame, least_terminating: float = 1.0, most_identity: float = 0.9, most_constant: float = 0.9) -> DataFrame:
    """The first gate that a metric fails, or null, as 'reason'."""
    reason = F.when(F.col("terminating_fraction") < least_terminating, "non_terminating").when(F.col("identity_fraction") > most_identity, "identity").when(F.col("constant_fraction") > most_constant, "constant")
    return metrics.withColumn("reason", reason)


def duplicates(df: DataFrame, *keys: str) -> DataFrame:
    """Rows beyond the first of each key."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicates"), F.count(F.lit(1)).alias("keys"))


def crossing(df: DataFrame, key: str, split: str) -> DataFrame:
    """Keys that lie in more than one split."""
    return df.select(key, split).distinct().groupBy(key).agg(F.count(F.lit(1)).alias("n_splits")).where("n_splits > 1")


def marginals(df: DataFrame, singles: list[str], joint: list[str]) -> DataFrame:
    """Counts by each single column and by the joint columns, in one pass: dimension, the columns (null if not grouped by), n."""
    sets = [[c] for c in singles] + [joint]
    columns = list(dict.fromkeys([*singles, *joint]))
    out = df.groupingSets([[F.col(c) for c in s] for s in sets], *(F.col(c) for c in columns)).agg(F.count(F.lit(1)).alias("n"), F.grouping_id(*(F.col(c) for c in columns)).alias("g"))
    bits = {sum(1 << (len(columns) - 1 - i) for i, c in enumerate(columns) if c not in s): "+".join(s) for s in sets}
    name = reduce(lambda w, kv: w.when(F.col("g") == kv[0], kv[1]), bits.items(), F)
    return out.select(name.alias("dimension"), *columns, "n")


def histogram(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))


def cluster_sizes(df: DataFrame, key: str) -> DataFrame:
    """How many clusters there are of each size."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("size")).groupBy("size").agg(F.count(F.lit(1)).alias("clusters"))


def largest(df: DataFrame, key: str, k: int) -> DataFrame:
    """The k largest clusters, ties by key: a report's top list."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("size")).orderBy(F.desc("size"), key).limit(k)


def uniqueness(df: DataFrame, id_: str, lists: list[str], columns: list[str]) -> DataFrame:
    """A row's score: the mean inverse frequency of the items of each list column, plus that of each column's value."""
    score = F.lit(0.0)
    out = df
    for c in columns:
        counts = df.groupBy(c).agg((1.0 / F.count(F.lit(1))).alias(f"_{c}")).withColumnRenamed(c, f"__{c}")
        out = out.join(counts, out[c].eqNullSafe(counts[f"__{c}"])).drop(f"__{c}")
        score = score + F.col(f"_{c}")
    for c in lists:
        items = df.select(id_, F.explode(c).alias("item"))
        counts = items.groupBy("item").agg((1.0 / F.count(F.lit(1))).alias("w"))
        means = items.join(counts, "item").groupBy(id_).agg(F.avg("w").alias(f"_{c}"))
        out = out.join(means, id_, "left")
        score = score + F.coalesce(F.col(f"_{c}"), F.lit(0.0))
    return out.select(id_, F.round(score, 6).alias("score"))


def length_audit(df: DataFrame, category: Column, categories: list[str], values: dict[str, Column], holds: Column) -> DataFrame:
    """For every listed category, also those without rows: count, distinct sorted values and whether a predicate always holds."""
    spark = df.sparkSession
    found = df.select(category.alias("category"), *(v.alias(k) for k, v in values.items()), holds.alias("holds")).where("category is not null")
    found = found.groupBy("category").agg(F.count(F.lit(1)).alias("n"), *(F.sort_array(F.collect_set(k)).alias(k) for k in values), F.bool_and("holds").alias("all_hold"))
    every = spark.createDataFrame([(c,) for c in categories], "category string")
    empty = F.array().cast("array<int>")
    return every.join(found, "category", "left").select("category", F.coalesce("n", F.lit(0)).alias("n"), *(F.coalesce(F.col(k), empty).alias(k) for k in values), F.coalesce("all_hold", F.lit(True)).alias("all_hold"))


def confounding(df: DataFrame, split: str, base: str, fields: list[str]) -> DataFrame:
    """For every split but the base: by field, which values only one of the two has."""
    sets = df.groupBy(split).agg(*(F.sort_array(F.collect_set(f)).alias(f) for f in fields))
    ours = sets.where(F.col(split) == base).select(*(F.col(f).alias(f"_{f}") for f in fields))
    both = sets.where(F.col(split) != base).crossJoin(F.broadcast(ours))  # one row
    differ = {f: F.array_sort(F.array_union(F.array_except(f, f"_{f}"), F.array_except(f"_{f}", f))) for f in fields}
    return both.select(split, *(v.alias(f) for f, v in differ.items()), reduce(lambda a, v: a | (F.size(v) > 0), differ.values(), F.lit(False)).alias("confounded"))


def behavior_properties(probes: DataFrame, key: str, alphabet: str) -> DataFrame:
    """Eight properties of each program. probes: key, value, output, terminating and again (the output run once more)."""
    inside = F.translate(F.col("output"), alphabet, "") == ""
    ends = F.bool_and("terminating")
    longer, shorter = F.length("output") > F.length("value"), F.length("output") < F.length("value")
    rows = probes.groupBy(key).agg(
        ends.alias("_ends"), F.coalesce(F.bool_and(F.when(F.col("terminating"), F.col("again").eqNullSafe(F.col("output")))), F.lit(True)).alias("_same"),
        F.coalesce(F.bool_and(F.length("output") == F.length("value")), F.lit(False)).alias("length_preserving"), F.coalesce(F.bool_or(longer), F.lit(False)).alias("length_increasing"),
        F.coalesce(F.bool_or(shorter), F.lit(False)).alias("length_decreasing"), F.coalesce(F.bool_and(inside), F.lit(True)).alias("alphabet_preserving"), F.count_distinct("output").alias("_distinct"),
    )
    idempotent, kept, n = F.col("_ends") & F.col("_same"), F.col("alphabet_preserving"), F.col("_distinct")
    return rows.select(key, idempotent.alias("idempotent"), "length_preserving", "length_increasing", "length_decreasing", "alphabet_preserving", (idempotent & F.col("length_decreasing")).alias("possible_normalizer"), ((n > 1) & (n <= 4) & ~kept).alias("possible_classifier"), (~kept & (n > 4)).alias("possible_encoder"))


def checks(df: DataFrame, named: dict[str, Column]) -> DataFrame:
    """One row of booleans, aggregates over df, and whether all passed."""
    row = df.agg(*(v.alias(k) for k, v in named.items()))
    return row.withColumn("passed", reduce(lambda a, k: a & F.col(k), named, F.lit(True)))


def leakage(records: DataFrame) -> DataFrame:
    """Five counters over records (id, behavior, family, split, public and hidden inputs as arrays). One pass each, no join."""
    counted = lambda key: records.groupBy(key).agg((F.count(F.lit(1)) - 1).alias("extra"), F.count_distinct("split").alias("splits"))
    ids, behaviors, families = counted("id"), counted("behavior"), counted("family")
    parts = [
        ids.agg(F.sum("extra").alias("duplicate_ids")), behaviors.agg(F.sum("extra").alias("duplicate_behaviors"), F.count_if(F.col("splits") > 1).alias("behavior_cross_split")),
        families.agg(F.count_if(F.col("splits") > 1).alias("family_cross_split")), records.agg(F.sum(F.size(F.array_intersect("public", "hidden"))).alias("public_hidden_overlap")),
    ]
    return reduce(lambda a, b: a.crossJoin(F.broadcast(b)), parts)  # one row each


def window_rank(df: DataFrame, partition: list[str], order: list, name: str = "rank") -> DataFrame:
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*partition).orderBy(*order)))
