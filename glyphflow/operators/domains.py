"""Input domains as DataFrames."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from glyphflow.functions.patterns import MINED, filled


def exhaustive(spark: SparkSession, alphabet: str, least: int, most: int, leading_zero: bool = True) -> DataFrame:
    """value: all strings over the alphabet of least to most characters. Made by arithmetic on a range: no join, no driver."""
    k = len(alphabet)

    def of(n: int) -> DataFrame:
        digits = [F.substr(F.lit(alphabet), (F.floor(F.col("id") / F.lit(k**j)) % k + 1).cast("int"), F.lit(1)) for j in reversed(range(n))]
        rows = spark.range(0, k**n, 1, 1) if k**n < 100_000 else spark.range(k**n)  # small domains: one task, not all cores
        return rows.select(F.concat(*digits).alias("value") if digits else F.lit("").alias("value"))

    out = reduce(DataFrame.unionByName, (of(n) for n in range(least, most + 1)))
    return out if leading_zero else out.where("not (length(value) > 1 and startswith(value, '0'))")


def domain_size(k: int, least: int, most: int, leading_zero: bool = True) -> int:
    """How many values exhaustive() has, without making them."""
    return sum(k**n if leading_zero or n < 2 else k**n - k ** (n - 1) for n in range(least, most + 1))


def unary_fields(spark: SparkSession, most: int, symbol: str = "a", separator: str = ",") -> DataFrame:
    """value: two runs of 1 to most symbols each, with a separator between."""
    return spark.range(most * most).select(F.concat(F.repeat(F.lit(symbol), (F.floor(F.col("id") / most) + 1).cast("int")), F.lit(separator), F.repeat(F.lit(symbol), (F.col("id") % most + 1).cast("int"))).alias("value"))


def unary(spark: SparkSession, most: int, symbol: str = "a") -> DataFrame:
    return spark.range(most + 1).select(F.repeat(F.lit(symbol), F.col("id").cast("int")).alias("value"))


def seeded(spark: SparkSession, alphabet: str, least: int, most: int, n: int, seed: int = 0) -> DataFrame:
    """value: n strings whose lengths and characters are drawn by hash, so that reruns and any partitioning agree."""
    draw = lambda what: F.pmod(F.xxhash64(F.lit(seed), "id", what), F.lit(1 << 62))
    rows = spark.range(n).withColumn("len", (draw(F.lit(-1)) % (most - least + 1) + least).cast("int"))
    chars = F.transform(F.sequence(F.lit(1), F.lit(max(most, 1))), lambda i: F.substr(F.lit(alphabet), (draw(i) % len(alphabet) + 1).cast("int"), F.lit(1)))
    return rows.select(F.array_join(F.slice(chars, F.lit(1), F.col("len")), "").alias("value"))


def boundaries(spark: SparkSession, alphabet: str, lengths: list[int]) -> DataFrame:
    """value: for each length all-equal strings, the alphabet in turn, and all of the last character but for one."""
    values = [v for n in lengths for v in [*(c * n for c in alphabet), (alphabet * n)[:n], alphabet[-1] * max(0, n - 1) + alphabet[0]]]
    return spark.createDataFrame([(v,) for v in dict.fromkeys(values)], "value string")


def pool(spark: SparkSession, alphabet: str, least: int, most: int, size: int, exhaustive_to: int = 4, seed: int = 0) -> DataFrame:
    """value and seq: an input pool of size values, or all there are: all short ones, then boundaries, then drawn ones, and
    where these are too few, all strings in order; first seen first."""
    short = exhaustive(spark, alphabet, least, min(most, exhaustive_to))
    parts = [short, boundaries(spark, alphabet, [most]), seeded(spark, alphabet, least, most, 4 * size, seed), refill(spark, alphabet, least, most, size)]
    return _first_seen(parts, least, most, size, seed)


def refill(spark: SparkSession, alphabet: str, least: int, most: int, size: int) -> DataFrame:
    """value: the first strings by length and then by alphabet, size of them or all there are."""
    upto, made = least, domain_size(len(alphabet), least, least)
    while made < size and upto < most:
        upto += 1
        made += len(alphabet) ** upto
    return exhaustive(spark, alphabet, least, upto)


def targeted(spark: SparkSession, alphabet: str, least: int, most: int, cap: int = 768, seed: int = 0) -> DataFrame:
    """value and seq: audit inputs: all strings of up to 4 characters, constant and alternating ones of the longest lengths
    and of 5 and 6, then drawn ones, cap in all."""
    lengths = sorted({n for n in (most, most - 1, 5, 6) if least <= n <= most})
    parts = [exhaustive(spark, alphabet, least, min(most, 4)), boundaries(spark, alphabet, lengths), seeded(spark, alphabet, least, most, 4 * cap, seed)]
    return _first_seen(parts, least, most, cap, seed)


def _first_seen(parts: list[DataFrame], least: int, most: int, size: int, seed: int) -> DataFrame:
    rows = reduce(DataFrame.unionByName, (p.withColumn("part", F.lit(i)) for i, p in enumerate(parts))).where(F.length("value").between(least, most))
    first = rows.groupBy("value").agg(F.min("part").alias("part"))
    last = len(parts) - 1
    drawn = F.when(F.col("part").isin(0, last), F.lit(0)).otherwise(F.xxhash64(F.lit(seed), "value"))
    order = Window.orderBy("part", F.length("value"), drawn, "value")  # a few times size rows: a pool is a parameter's size
    return first.withColumn("seq", F.row_number().over(order)).where(F.col("seq") <= size).select("seq", "value")


def candidate_rules(alphabet: str) -> list[str]:
    """Short programs over an alphabet: replacing, marking, deleting, collapsing, at the ends, once, as a test, and exchanges."""
    return filled(MINED, alphabet)
