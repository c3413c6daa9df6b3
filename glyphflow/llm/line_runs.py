"""Repeated runs of lines, by distributed prefix doubling over line-ID sequences; built-in functions only.

The corpus is one sequence of lines with a word, documents by id. Step t names the suffix at each place by its first 2**t
lines: the name is that of the pair (name of the place, name of the place 2**t lines on) one step before. Places whose name
occurs once are settled, since they differ from all others from there on, and leave; the others' equal names are the LCP
intervals of the suffix array at depth 2**t.

A run is deleted where it has WORDS words or more and occurs earlier in the sequence. Of every such maximal run each line
lies in a shortest run of WORDS words, one that begins at the line or one that ends there (a run's first lines lie in the
shortest run from its start). So a run of L lines needs no longer prefix than itself: it is named by the names of two
overlapping halves of 2**t lines, t = floor(log2 L), and the earliest place with its name keeps it. Deleted runs that touch
are one maximal run. As lines without words are left out, L is WORDS at most and there are six steps or fewer.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import SPACE, discard, let, written

WORDS = 50
SALTS = 16
#: White space that is not looked at where it is at a line's ends.
EDGE = " \t\r\x0b\f"


def row_id(doc_id: str, text: str) -> Column:
    return F.xxhash64(F.col(doc_id), F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary")))


def marked(*parts: Column | str) -> tuple[Column, Column]:
    """A name of 128 bits as the columns name and mark: lines and runs are told apart by both."""
    return F.xxhash64(*parts).alias("name"), F.xxhash64(F.lit(7), *parts).alias("mark")


def several(rows: DataFrame) -> DataFrame:
    """rows (r, at, name, mark) whose name occurs twice or more. Counts come from map-side sums; hot names are joined by
    salt."""
    names = rows.groupBy("name", "mark").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select(F.col("name").alias("_name"), F.col("mark").alias("_mark"), F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_s"))
    return rows.join(names, (F.col("name") == F.col("_name")) & (F.col("mark") == F.col("_mark")) & (F.pmod("r", F.lit(SALTS)) == F.col("_s"))).drop("_name", "_mark", "_s")


def lines_of(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """id, r (row id), at (number of the line among those with a word), name, mark and n (words) of each line with a word."""
    solid = F.filter(F.transform(F.split(F.coalesce(F.col(text), F.lit("")), "\n"), lambda x: F.btrim(x, F.lit(EDGE))), lambda x: x != "")
    # two steps: what stands beside a generator in one select is computed again for each of its rows
    rows = docs.select(F.col(doc_id).alias("id"), row_id(doc_id, text).alias("r"), solid.alias("lines")).select("id", "r", F.posexplode("lines").alias("at", "x"))
    rows = rows.select("id", "r", F.col("at").cast("long").alias("at"), *marked("x"), F.size(F.split("x", SPACE + "+")).cast("long").alias("n"))
    return rows.repartition("r").groupBy("r", "at").agg(*(F.min(c).alias(c) for c in ("id", "name", "mark", "n")))


def with_shortest(rows: DataFrame, words: int) -> DataFrame:
    """rows with the lengths of the shortest runs of so many words from each line on (ahead) and up to it (behind), or null.

    The running sums grow with each line, so a range of sums is a run of lines. All windows share one partitioning.
    """
    doc = Window.partitionBy("r")
    rows = rows.withColumn("end", F.sum("n").over(doc.orderBy("at").rowsBetween(Window.unboundedPreceding, 0))).withColumn("start", F.col("end") - F.col("n"))
    count = F.count(F.lit(1))
    ahead = F.when(F.max("end").over(doc) - F.col("start") >= words, count.over(doc.orderBy("start").rangeBetween(0, words - 1)))
    behind = F.when(F.col("end") >= words, count.over(doc.orderBy("end").rangeBetween(-(words - 1), 0)))
    return rows.withColumns({"ahead": ahead, "behind": behind}).drop("start", "end", "n")


def touching(spans: DataFrame) -> DataFrame:
    """Spans (r, a, b) as one list for each r, those that touch merged."""
    doc = Window.partitionBy("r").orderBy("a", "b")
    spans = spans.withColumn("new", F.coalesce(F.col("a") > F.max("b").over(doc.rowsBetween(Window.unboundedPreceding, -1)), F.lit(True)))
    spans = spans.withColumn("part", F.sum(F.col("new").cast("int")).over(doc.rowsBetween(Window.unboundedPreceding, 0)))
    merged = spans.groupBy("r", "part").agg(F.min("a").alias("a"), F.max("b").alias("b"))
    return merged.groupBy("r").agg(F.array_sort(F.collect_list(F.struct("a", "b"))).alias("spans"))


def line_runs(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = WORDS) -> DataFrame:
    """doc_id, n_lines (with a word), n_removed, n_runs and kept (the text without the deleted runs) for each row of docs.

    Lines are compared without white space at their ends; lines without a word are in no run, but go if they lie inside a
    deleted one. Of equal runs the one in the smallest id stays, in one text the first. Null and empty texts have no lines
    and are kept as empty texts. Rows of equal id and text are one document: what is said of one is said of all. Null ids
    come first. No rows give no rows. Other columns of docs are not looked at, whatever their names.
    """
    lines = written(with_shortest(lines_of(docs, doc_id, text), words), "runs-lines")  # texts are split once
    first = written(several(lines), "runs-0")
    discard(lines)
    done = [first]
    runs = first.where("ahead is not null").select("id", "r", F.col("at").alias("from"), F.col("ahead").alias("len")).unionByName(first.where("behind is not null").select("id", "r", (F.col("at") - F.col("behind") + 1).alias("from"), F.col("behind").alias("len"))).distinct()
    runs = written(runs, "runs-wanted")
    longest = runs.agg(F.max("len")).first()[0] or 0
    level, names, t = first.select("r", "at", "name", "mark"), [], 0
    while 1 << t <= longest:
        half = runs.where(F.col("len").between(1 << t, (2 << t) - 1))
        a, b = (level.select(F.col("r").alias(f"r{i}"), F.col("at").alias(f"at{i}"), F.col("name").alias(f"name{i}"), F.col("mark").alias(f"mark{i}")) for i in (1, 2))
        half = half.join(a, (F.col("r") == F.col("r1")) & (F.col("from") == F.col("at1"))).join(b, (F.col("r") == F.col("r2")) & (F.col("from") + F.col("len") - (1 << t) == F.col("at2")))
        names.append(half.select("id", "r", "from", "len", *marked("len", "name1", "mark1", "name2", "mark2")))
        if 2 << t <= longest:
            on = Window.partitionBy("r").orderBy("at").rangeBetween(1 << t, 1 << t)
            pairs = level.withColumn("next", F.max(F.struct("name", "mark")).over(on)).where("next is not null")
            level = written(several(pairs.select("r", "at", *marked("name", "mark", "next.name", "next.mark"))), f"runs-{t + 1}")
            done.append(level)
        t += 1
    if names:
        named = written(reduce(DataFrame.unionByName, names), "runs-named")
        discard(*done, runs)
        keeper = named.groupBy("name", "mark").agg(F.min(F.struct("id", "r", "from")).alias("keeper"), F.count(F.lit(1)).alias("n")).where("n > 1")
        keeper = keeper.select(F.col("name").alias("k"), F.col("mark").alias("m"), "keeper", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("s"))
        gone = named.join(keeper, (F.col("name") == F.col("k")) & (F.col("mark") == F.col("m")) & (F.pmod("r", F.lit(SALTS)) == F.col("s"))).where(~F.struct("id", "r", "from").eqNullSafe(F.col("keeper")))
        spans = touching(gone.select("r", F.col("from").cast("int").alias("a"), (F.col("from") + F.col("len")).cast("int").alias("b")))
    else:
        spans = docs.sparkSession.createDataFrame([], "r long, spans array<struct<a:int,b:int>>")
    spans = spans.withColumnRenamed("r", "r0")
    texts = docs.select(F.col(doc_id).alias("id"), row_id(doc_id, text).alias("r"), F.coalesce(F.col(text), F.lit("")).alias("body"))
    joined = texts.join(spans, F.col("r") == F.col("r0"), "left")
    whole = F.split("body", "\n")
    solid = F.filter(F.transform(whole, lambda x, i: F.when(F.btrim(x, F.lit(EDGE)) != "", i)), lambda i: i.isNotNull())
    own = joined.select("id", "body", whole.alias("all"), solid.alias("solid"), F.coalesce("spans", F.array().cast("array<struct<a:int,b:int>>")).alias("cut"))
    places = F.transform("cut", lambda y: F.struct(F.get("solid", y["a"]).alias("a"), (F.get("solid", y["b"] - 1) + 1).alias("b")))

    def between(c: Column) -> Column:
        begins, ends = F.concat(F.array(F.lit(0)), F.transform(c, lambda y: y["b"])), F.concat(F.transform(c, lambda y: y["a"]), F.array(F.size("all")))
        return F.zip_with(begins, ends, lambda a, b: F.slice("all", a + 1, b - a))

    kept = F.when(F.size("cut") == 0, F.col("body")).otherwise(F.array_join(F.flatten(let(places, between)), "\n"))
    removed = F.aggregate("cut", F.lit(0), lambda s, y: s + y["b"] - y["a"])
    return own.select(F.col("id").alias("doc_id"), F.size("solid").cast("long").alias("n_lines"), removed.cast("long").alias("n_removed"), F.size("cut").cast("long").alias("n_runs"), kept.alias("kept"))
