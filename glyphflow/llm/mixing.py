"""Mixing sources to target weights by cube-method balanced sampling.

A source's target is a share of all words, water-filled below three times its size. Its documents get whole repeats
alike, and what is left is an inclusion probability that the cube method turns into 0 or 1: three documents at a time are
moved through the null space of the balancing constraints (documents, words) until one of them is decided. Groups of a
source's documents, split by a hash, are decided in parallel; the two or fewer undecided ones of each group go to the next
level, until one group is left for each source, whose last two are landed nearest to the target.
"""

from __future__ import annotations

import random
from bisect import bisect
from itertools import product

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import ascii_words, forget, written

WEIGHTS = (5, 2, 1)
MOST_TIMES = 3
GROUP = 4096
SEED = 20
EPS = 1e-9
EXCHANGES = 4


def targets(totals: list[tuple[str | None, int]], weights: tuple[float, ...] = WEIGHTS, most: float = MOST_TIMES) -> dict[str | None, float]:
    """Target words by source. Sources by code point, null last, take the weights in turn; what is above most times a
    source's size goes to the others by weight, until none is above. Sources without words get 0."""
    order = sorted((s for s, _ in totals if s is not None), key=lambda s: [ord(c) for c in s]) + [s for s, _ in totals if s is None]
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    size = dict(totals)
    out, free, left = {}, set(order), float(sum(size.values()))
    while free:
        unit = left / sum(weight[s] for s in free)
        full = {s for s in free if unit * weight[s] > most * size[s]}
        if not full:
            return out | {s: unit * weight[s] for s in free}
        for s in full:
            out[s] = float(most * size[s])
        left = float(sum(size.values())) - sum(out.values())
        free -= full
    return out


def flight(sizes: list[float], p: list[float], rng: random.Random) -> list[int]:
    """Moves p in place until each is 0 or 1 but for two at most, whose places are returned. Both the sum of p and that
    of p times size stay as they are; of equal sizes, two are enough for a move."""
    window: list[int] = []
    for i in [*range(len(p)), *[-1] * 3]:
        if i >= 0 and EPS < p[i] < 1 - EPS:
            window.append(i)
        while len(window) >= 2:
            move = None
            if len(window) >= 3:
                a, b, c = window[:3]
                u = (sizes[b] - sizes[c], sizes[c] - sizes[a], sizes[a] - sizes[b])
                move = (window[:3], u) if any(u) else (window[:2], (1.0, -1.0))
            elif sizes[window[0]] == sizes[window[1]]:
                move = (window[:2], (1.0, -1.0))
            if move is None:
                break
            at, u = move
            up = min((1 - p[k]) / x if x > 0 else p[k] / -x for k, x in zip(at, u, strict=True) if x)
            down = min(p[k] / x if x > 0 else (1 - p[k]) / -x for k, x in zip(at, u, strict=True) if x)
            step = up if rng.random() * (up + down) < down else -down
            for k, x in zip(at, u, strict=True):
                p[k] += step * x
                if p[k] < EPS:
                    p[k] = 0.0
                elif p[k] > 1 - EPS:
                    p[k] = 1.0
            window = [k for k in window if 0.0 < p[k] < 1.0]
    return window


def landing(sizes: list[float], p: list[float], left: list[int]) -> None:
    """Decides the last places so that words come nearest to what p stands for, then documents; then exchanges a taken
    document, or none, for one that isn't, or none, while that comes nearer yet, EXCHANGES times at most."""
    words, docs = sum(sizes[k] * p[k] for k in left), sum(p[k] for k in left)
    best = min(product((0.0, 1.0), repeat=len(left)), key=lambda x: (abs(sum(sizes[k] * v for k, v in zip(left, x, strict=True)) - words), abs(sum(x) - docs), x))
    for k, v in zip(left, best, strict=True):
        p[k] = v
    lack = words - sum(sizes[k] * p[k] for k in left)
    for _ in range(EXCHANGES):
        outside = sorted([(0.0, -1), *((sizes[k], k) for k in range(len(p)) if p[k] == 0.0)])
        found = (abs(lack), -1, -1)
        for n, i in [(0.0, -1), *((sizes[k], k) for k in range(len(p)) if p[k] == 1.0)]:
            at = bisect(outside, (n + lack, -1))
            found = min([found, *((abs(lack + n - m), i, j) for m, j in outside[max(0, at - 1) : at + 1])])
        _, i, j = found
        if i == j:  # nothing for nothing
            return
        if i >= 0:
            lack, p[i] = lack + sizes[i], 0.0
        if j >= 0:
            lack, p[j] = lack - sizes[j], 1.0


def decided(frame: pd.DataFrame) -> pd.DataFrame:
    """One group's flight, with the landing if it is its source's only group. Ordered by hash, so that reruns agree."""
    forget()
    frame = frame.sort_values(["_order", "size", "key"], kind="stable", ignore_index=True)
    sizes, p = frame["size"].astype(float).tolist(), frame["p"].tolist()
    first = frame.iloc[0]
    left = flight(sizes, p, random.Random(f"{SEED}/{first['source']}/{first['_group']}/{first['_level']}"))
    if first["_groups"] == 1 and left:
        landing(sizes, p, left)
    return frame.assign(p=p)


def mix(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", group: int = GROUP) -> DataFrame:
    """doc_id, body_hash, size, source, source_size, target, times and taken for each row of docs.

    Null or empty texts have size 0 and are taken 0 words; their times are their source's whole repeats and what the cube
    gives. Null is a source. Equal rows are rows of their own. No rows give no rows. Other columns of docs are not looked
    at, whatever their names. What goes to the driver is a row for each source.
    """
    body = F.xxhash64(docs[text])
    return planned(docs.select(docs[doc_id].alias("doc_id"), body.alias("body_hash"), body.alias("key"), docs[text].alias("text"), docs[source].alias("source")), group).drop("key")


def planned(docs: DataFrame, group: int) -> DataFrame:
    """What mix gives, for doc_id, body_hash, key, text and source; with the key, which orders rows of one id and text."""
    spark: SparkSession = docs.sparkSession
    sized = docs.select("doc_id", "body_hash", "key", F.size(ascii_words(F.col("text"))).cast("long").alias("size"), F.col("source").cast("string").alias("source"))
    sized = written(sized, "mix-sizes")
    totals = [(r["source"], r["size"], r["n"]) for r in sized.groupBy("source").agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("n")).collect()]
    wanted = targets([(s, n) for s, n, _ in totals])
    plan = []
    for s, size, n in totals:
        rate = wanted[s] / size if size else 0.0
        whole = int(rate + EPS)
        plan.append((s, size, wanted[s], whole, max(0.0, rate - whole) if rate - whole > EPS else 0.0, -(-n // group)))
    sources = spark.createDataFrame(plan, "s string, source_size long, target double, whole int, p double, _groups int")
    rows = sized.join(F.broadcast(sources) if len(plan) <= 10_000 else sources, F.col("source").eqNullSafe(F.col("s"))).drop("s")
    order = F.xxhash64(F.lit(SEED), "doc_id", "body_hash")
    rows = rows.withColumns({"_order": order, "_group": F.pmod(order, F.col("_groups")).cast("int"), "_level": F.lit(0)})
    settled, level = rows.where("p = 0"), 0
    rows = rows.where("p > 0")
    while True:
        schema = rows.schema
        rows = written(rows.groupBy("source", "_group").applyInPandas(decided, schema), f"mix-level{level}")
        settled = settled.unionByName(rows.where("p = 0 or p = 1"))
        if max([g for *_, g in plan], default=0) <= 1:
            break
        level += 1
        plan = [(*x, -(-2 * g // group) if g > 1 else 0) for *x, g in plan]
        groups = F.ceil(2 * F.col("_groups") / group).cast("int")
        rows = rows.where("p > 0 and p < 1").withColumn("_groups", groups).withColumns({"_group": F.pmod("_order", F.col("_groups")).cast("int"), "_level": F.lit(level)})
    times = (F.col("whole") + F.col("p")).cast("int")
    return settled.select("doc_id", "body_hash", "key", "size", "source", "source_size", "target", times.alias("times"), (F.col("size") * times).alias("taken"))


def mixed(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", group: int = GROUP) -> DataFrame:
    """docs with each row as many times as the mix takes it; docs' own columns, of any names.

    Rows that are equal in every column share their copies: what the mix takes of each of them is added up. Null or empty
    texts come as often as their source's whole repeats and the cube say. No rows give no rows. Columns must be hashable.
    """
    whole = F.xxhash64(*(docs[c] for c in docs.columns))
    keyed = docs.select(F.struct(*(docs[c] for c in docs.columns)).alias("row"), docs[doc_id].alias("id"), whole.alias("hash"))
    plan = planned(docs.select(docs[doc_id].alias("doc_id"), F.xxhash64(docs[text]).alias("body_hash"), whole.alias("key"), docs[text].alias("text"), docs[source].alias("source")), group)
    plan = plan.groupBy("doc_id", "key").agg(F.sum("times").alias("times")).where("times > 0")
    rows = keyed.groupBy("id", "hash").agg(F.first("row").alias("row"))
    both = rows.join(plan, F.col("id").eqNullSafe(F.col("doc_id")) & (F.col("hash") == F.col("key")))
    return both.select("row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("times")))).select("row.*")
