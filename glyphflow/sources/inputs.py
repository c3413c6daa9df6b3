"""Value columns for rewriting, derived from whole tables: distinct values, so that each is rewritten once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LETTERS = "abcdefghijklmnopqrstuvwxyz"
ABC = ("abc" * 9)[:26]
AB = ("ab" * 13)[:26]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spaced(text):
    for c in "\n\t\r":
        text = F.replace(text, F.lit(c), F.lit(" "))
    return text


def folded(word, to: str):
    """A word's letters as letters of a small alphabet, all else dropped."""
    return F.regexp_replace(F.translate(F.lower(word), LETTERS, to), f"[^{''.join(sorted(set(to)))}]", "")


def words(spark: SparkSession, sf_dir: str, to: str = ABC) -> DataFrame:
    """value: every word of every document in a small alphabet, once."""
    each = table(spark, sf_dir, "documents").select(F.explode(F.split(spaced(F.col("text")), " ")).alias("w")).distinct()
    # a one-element explode: else a later filter is pushed below the distinct with this expression in place of every use
    return each.select(F.explode(F.array(folded(F.col("w"), to))).alias("value")).where("value <> ''").distinct()


def field_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """value: two fields over a and b with a comma between, from each customer's segment and name of nation."""
    c, n = table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation")
    pairs = c.join(F.broadcast(n), c["c_nationkey"] == n["n_nationkey"])  # nations: a fixed 25 rows
    return pairs.select(F.concat(folded(F.col("c_mktsegment"), AB), F.lit(","), folded(F.col("n_name"), AB)).alias("value")).distinct()


def binaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """value: numbers from 1 to 1023 in binary."""
    return table(spark, sf_dir, "orders").select(F.bin(F.col("o_orderkey") % 1023 + 1).alias("value")).distinct()


def number_pairs(spark: SparkSession, sf_dir: str, separator: str, ordered: bool = False) -> DataFrame:
    """value: two numbers from 1 to 31 in binary with a separator between, the greater one first if ordered."""
    a, b = F.col("l_partkey") % 31 + 1, F.col("l_suppkey") % 31 + 1
    if ordered:
        a, b = F.greatest(a, b) + 1, F.least(a, b)
    return table(spark, sf_dir, "lineitem").select(F.concat(F.bin(a), F.lit(separator), F.bin(b)).alias("value")).distinct()


def unaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(F.repeat(F.lit("a"), F.col("l_quantity").cast("int")).alias("value")).distinct()


def domain(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    if kind in ("abc", "ab"):
        return words(spark, sf_dir, ABC if kind == "abc" else AB)
    if kind in ("sum", "difference", "product", "quotient"):
        return number_pairs(spark, sf_dir, {"sum": "+", "difference": "-", "product": "*", "quotient": "/"}[kind], kind == "difference")
    return {"fields": field_pairs, "binary": binaries, "unary": unaries}[kind](spark, sf_dir)


def _words_sql(to: str) -> str:
    each = "SELECT DISTINCT unnest(string_split(replace(replace(replace(text, chr(10), ' '), chr(9), ' '), chr(13), ' '), ' ')) AS w FROM documents"
    return f"SELECT DISTINCT value FROM (SELECT regexp_replace(translate(lower(w), '{LETTERS}', '{to}'), '[^{''.join(sorted(set(to)))}]', '', 'g') AS value FROM ({each})) WHERE value <> ''"


def _pair_sql(sep: str, a: str = "l_partkey % 31 + 1", b: str = "l_suppkey % 31 + 1") -> str:
    return f"SELECT DISTINCT bin({a}) || '{sep}' || bin({b}) AS value FROM lineitem"


def _folded_sql(column: str) -> str:
    return f"regexp_replace(translate(lower({column}), '{LETTERS}', '{AB}'), '[^ab]', '', 'g')"


#: The same columns in DuckDB SQL.
SQL = {
    "abc": _words_sql(ABC), "ab": _words_sql(AB), "binary": "SELECT DISTINCT bin(o_orderkey % 1023 + 1) AS value FROM orders",
    "fields": f"SELECT DISTINCT {_folded_sql('c_mktsegment')} || ',' || {_folded_sql('n_name')} AS value FROM customer JOIN nation ON c_nationkey = n_nationkey",
    "sum": _pair_sql("+"), "product": _pair_sql("*"), "quotient": _pair_sql("/"),
    "difference": _pair_sql("-", "greatest(l_partkey % 31 + 1, l_suppkey % 31 + 1) + 1", "least(l_partkey % 31 + 1, l_suppkey % 31 + 1)"),
    "unary": "SELECT DISTINCT repeat('a', l_quantity::INT) AS value FROM lineitem",
}
