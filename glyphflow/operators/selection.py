"""Order, choice and splitting: stable hash order, first and top of groups, round robin, greedy passes over group tables."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from glyphflow.sources.work import stored


def stable_key(seed: int, *columns: str) -> Column:
    """A hash to order by: the same whatever the partitioning."""
    return F.sha2(F.concat_ws("\0", F.lit(str(seed)), *columns), 256)


def first_seen(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    """The first row of each key."""
    return df.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("_rank = 1").drop("_rank")


def capped(df: DataFrame, keys: list[str], order: list, n: int) -> DataFrame:
    """At most n rows of each key, in order: the cap of cluster sizes."""
    return df.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("_rank") <= n).drop("_rank")


def ranked(df: DataFrame, order: list[str], name: str = "rank") -> DataFrame:
    """df with the place of each row in the order, from 1: rows are dealt by ranges, counted by range, and ranked in each.

    The order's columns should tell rows apart; rows that are equal in them are one range.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = stored(df.repartitionByRange(parts, *order).withColumn("_part", F.spark_partition_id()), "ranked")
    counts = rows.groupBy("_part").agg(F.count(F.lit(1)).alias("_k"))
    before = F.sum("_k").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, 0)) - F.col("_k")  # a row for each range
    offsets = F.broadcast(counts.select(F.col("_part").alias("_p"), before.alias("_before")))
    inside = rows.withColumn("_in", F.row_number().over(Window.partitionBy("_part").orderBy(*order)))
    return inside.join(offsets, F.col("_part") == F.col("_p")).withColumn(name, F.col("_before") + F.col("_in")).drop("_part", "_p", "_before", "_in")


def round_robin(df: DataFrame, cluster: str, order: list, limit: int) -> DataFrame:
    """limit rows, one of each cluster in turn, smallest cluster first: a row's turn is its rank in its cluster.

    No row after a cluster's first limit can be one of them: ranks stop there, before rows are shuffled.
    """
    turns = df.withColumn("_turn", F.row_number().over(Window.partitionBy(cluster).orderBy(*order))).where(F.col("_turn") <= limit)
    sizes = df.groupBy(F.col(cluster).alias("_cluster")).agg(F.count(F.lit(1)).alias("_size"))
    return turns.join(sizes, F.col(cluster).eqNullSafe(F.col("_cluster"))).orderBy("_turn", "_size", cluster).limit(limit).drop("_turn", "_size", "_cluster")


def family_split(df: DataFrame, id_: str, family: str, seed: int, train: int = 2) -> DataFrame:
    """split: of each family the first by hash go to train, the rest to validation or test by the family's hash."""
    rank = F.row_number().over(Window.partitionBy(family).orderBy(stable_key(seed, id_), id_))
    odd = F.conv(F.substring(stable_key(seed, family), 1, 2), 16, 10).cast("int") % 2 == 1
    return df.withColumn("split", F.when(rank <= train, "train").when(odd, "validation").otherwise("test"))


def rebalanced(df: DataFrame, a: str, b: str, order: str, most: int) -> DataFrame:
    """Rows of split a beyond the first most by order go to b, then the same from b to a."""
    for source, target in ((a, b), (b, a)):
        own = ranked(df.where(F.col("split") == source), [order])
        moved = own.withColumn("split", F.when(F.col("rank") > most, target).otherwise(source)).drop("rank")
        df = moved.unionByName(df.where(~F.col("split").eqNullSafe(source)))
    return df


def representatives(df: DataFrame, keys: list[str], order: list, n: int) -> DataFrame:
    """n rows: the first of each key, then others, all in the order of key and order."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_later", rank > 1).orderBy("_later", *keys, *order).limit(n).drop("_later")


def weighted_choice(df: DataFrame, name: str, weight: str, draws: DataFrame) -> DataFrame:
    """For each draw (point in [0, 1)) the name on whose part of the running sum of weights it falls. df is a catalogue."""
    upto = F.sum(weight).over(Window.orderBy(name).rowsBetween(Window.unboundedPreceding, 0))
    spans = df.select(F.col(name), upto.alias("_end"), (upto - F.col(weight)).alias("_begin"), F.sum(weight).over(Window.partitionBy(F.lit(1))).alias("_all"))
    point = F.col("point") * F.col("_all")
    return draws.join(F.broadcast(spans), (point >= F.col("_begin")) & (point < F.col("_end"))).select(*draws.columns, name)


def capacity_split(df: DataFrame, group: str, fractions: dict[str, float], seed: int) -> DataFrame:
    """group and split: groups in stable hash order, the first to one split each, then each to the split that lacks most.

    The choice depends on all before it: one task passes over the table of group sizes, a row a group, and holds nothing
    but what each split lacks. A null group is one, too.
    """
    names = [n for n, f in fractions.items() if f > 0]
    sizes = stored(df.groupBy(F.col(group).cast("string").alias(group)).agg(F.count(F.lit(1)).alias("n")).withColumn("_key", stable_key(seed, group)), "groups")
    total = sizes.agg(F.sum("n"), F.count(F.lit(1))).first()

    def greedy(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        room, at = {n: total[0] * fractions[n] for n in names}, 0
        for frame in frames:
            out = []
            for n in frame["n"]:
                to = names[at] if at < len(names) <= total[1] else max(names, key=room.__getitem__)
                room[to] -= n
                out.append(to)
                at += 1
            yield pd.DataFrame({group: frame[group], "split": out})

    return sizes.repartition(1).sortWithinPartitions("_key", group).mapInPandas(greedy, f"{group} string, split string")


def two_key_dedup(df: DataFrame, seq: str, first: str, second: str) -> DataFrame:
    """Rows in order of seq whose first and second key are both new; a row dropped for one key reserves neither.

    That is sequential, not two ranks: one task passes over the keys. A pair of keys can be kept only at its first place,
    so that the pass sees each pair once, after a grouping with map-side sums.
    """
    schema = df.select(seq).schema

    def greedy(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        firsts, seconds = set(), set()
        for frame in frames:
            keep = []
            for s, a, b in zip(frame[seq], frame[first], frame[second], strict=True):
                if a not in firsts and b not in seconds:
                    firsts.add(a)
                    seconds.add(b)
                    keep.append(s)
            yield pd.DataFrame({seq: keep})

    pairs = df.groupBy(first, second).agg(F.min(seq).alias(seq))
    kept = pairs.select(seq, first, second).repartition(1).sortWithinPartitions(seq).mapInPandas(greedy, schema)
    return df.join(kept, seq, "left_semi")
