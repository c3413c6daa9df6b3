"""Benchmark decontamination as a prefix-filtered set join, by built-in functions only.

An item's windows are its runs of WINDOW consecutive words (all of it if it has fewer). A window is contained in a document
if all its shingles are, at the same distance; so one shingle of each window, its rarest in the corpus, is a sufficient
prefix. Shingles are five words (all of the window if it has fewer). Occurrences of benchmark shingles in documents are
found in one pass; they give the counts by which shingles are ordered, and, joined with the prefixes, the candidates.
Position and length bound them; the words themselves, compared as a slice of the document, decide.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import let, same, written

WINDOW = 10
SHINGLE = 5
#: A benchmark table of more rows is joined by shuffle, not broadcast (its rows have under 200 bytes).
BROADCAST_ROWS = 200_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: What stands between words before A-Z are lower-cased.
BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def lowered(text: Column) -> Column:
    """text with A-Z, and only these, in lower case."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def words(text: Column) -> Column:
    return F.filter(F.split(lowered(F.coalesce(text, F.lit(""))), BETWEEN), lambda w: w != "")


def count_words(text: Column) -> Column:
    return let(F.split(F.coalesce(text, F.lit("")), BETWEEN), lambda a: F.size(a) - (a[0] == "").cast("int") - ((F.size(a) > 1) & (F.element_at(a, -1) == "")).cast("int")).cast("long")


def shingles(found: Column, k: int) -> Column:
    """Hashes of the k-word shingles of a word array, by position."""
    def of(h: Column) -> Column:
        return F.transform(F.slice(h, 1, F.size(h) - (k - 1)), lambda x, i: F.xxhash64(x, *(F.get(h, i + j) for j in range(1, k))))

    return let(F.transform(found, lambda w: F.xxhash64(w)), lambda h: F.when(F.size(h) < k, F.array().cast("array<bigint>")).otherwise(of(h)))


def windows(benchmark: DataFrame, item_id: str, text: str, window: int) -> DataFrame:
    """item, w (words of the window) and k (words of its shingles), once for each item."""
    items = benchmark.select(F.col(item_id).cast("string").alias("item"), words(F.col(text)).alias("all")).where(F.size("all") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("all") - (window - 1)))
    each = items.select("item", F.explode(F.transform(starts, lambda i: F.slice("all", i, window))).alias("w"))
    return each.withColumn("k", F.least(F.lit(SHINGLE), F.size("w"))).distinct()


def contamination(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", window: int = WINDOW) -> DataFrame:
    """doc_id, body_hash, n_words, n_hit, n_items, items_sha256 and contaminated for each row of docs.

    n_hit: words inside an occurrence of a window; n_items: items with an occurring window; items_sha256: of their ids as
    strings, sorted and joined by commas. Texts without words (null, empty) have no hits and no windows. An item without an
    id makes hits but isn't counted. Equal rows get equal results. No documents give no rows, no items give no hits.
    """
    every = written(windows(benchmark, item_id, item_text, window), "bench-windows")
    small = every.count() <= BROADCAST_ROWS
    side = (lambda df: F.broadcast(df)) if small else (lambda df: df)
    wanted = every.select("w", "k").distinct()
    keys = docs.select(F.col(doc_id).alias("id"), F.xxhash64(F.col(text)).alias("body"), words(F.col(text)).alias("all"))
    seen = []
    for k in sorted(r["k"] for r in every.select("k").distinct().collect()):  # at most SHINGLE values
        known = wanted.where(F.col("k") == k).select(F.explode(shingles(F.col("w"), k)).alias("known")).distinct()
        # two steps: what stands beside a generator in one select goes through it with each of its rows
        each = keys.select("id", "body", F.size("all").alias("n"), shingles(F.col("all"), k).alias("shingles"))
        places = each.select("id", "body", "n", F.posexplode("shingles").alias("at", "shingle"))
        seen.append(places.join(side(known), F.col("shingle") == F.col("known")).select("id", "body", "n", "at", "shingle", F.lit(k).alias("k")))
    base = docs.select(F.col(doc_id).alias("id"), F.xxhash64(F.col(text)).alias("body"), count_words(F.col(text)).alias("n_words"))
    nothing = F.sha2(F.lit(""), 256)
    if not seen:
        return base.select(F.col("id").alias("doc_id"), F.col("body").alias("body_hash"), "n_words", F.lit(0).cast("long").alias("n_hit"), F.lit(0).cast("long").alias("n_items"), nothing.alias("items_sha256"), F.lit(False).alias("contaminated"))
    seen = written(reduce(DataFrame.unionByName, seen), "bench-shingles")
    # Prefix: the rarest shingle of each window that occurs as a whole set. A window with an unseen shingle occurs nowhere.
    rarity = seen.groupBy("k", "shingle").agg(F.count(F.lit(1)).alias("count"))
    parts = [wanted.where(F.col("k") == k).select("w", "k", F.posexplode(shingles(F.col("w"), k)).alias("offset", "part")) for k in range(1, SHINGLE + 1)]
    parts = reduce(DataFrame.unionByName, parts)
    ranked = parts.join(rarity.withColumnRenamed("k", "rk"), (F.col("part") == F.col("shingle")) & (F.col("k") == F.col("rk")), "left")
    prefix = ranked.groupBy("w", "k").agg(F.min(F.struct(F.coalesce("count", F.lit(0)).alias("count"), F.col("part"), F.col("offset"))).alias("rarest")).where("rarest.count > 0")
    prefix = prefix.select("w", F.col("k").alias("pk"), F.col("rarest.part").alias("part"), F.col("rarest.offset").alias("offset"))
    prefix = written(prefix, "bench-prefixes")
    start = F.col("at") - F.col("offset")
    near = seen.join(side(prefix), (F.col("shingle") == F.col("part")) & (F.col("k") == F.col("pk"))).where((start >= 0) & (start + F.size("w") <= F.col("n")))
    near = near.groupBy("id", "body").agg(F.collect_set(F.struct(start.alias("start"), F.col("w"))).alias("near"))
    texts = docs.select(F.col(doc_id).alias("id2"), F.xxhash64(F.col(text)).alias("body2"), F.col(text).alias("t"))
    checked = texts.join(near, F.col("id2").eqNullSafe(F.col("id")) & (F.col("body2") == F.col("body"))).select("id", "body", "near", words(F.col("t")).alias("all"))
    fits = lambda all_: F.filter("near", lambda c: F.slice(all_, c["start"] + 1, F.size(c["w"])) == c["w"])
    hits = checked.select("id", "body", let(F.col("all"), fits).alias("hits")).where(F.size("hits") > 0)
    hits = written(hits.groupBy("id", "body").agg(F.first("hits").alias("hits")), "bench-hits")
    spans = F.array_sort(F.array_distinct(F.transform("hits", lambda c: F.struct(c["start"].alias("a"), (c["start"] + F.size(c["w"])).alias("b")))))
    zero = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))
    covered = F.aggregate(spans, zero, lambda s, x: F.struct((s["n"] + F.greatest(F.lit(0), x["b"] - F.greatest(x["a"], s["end"]))).alias("n"), F.greatest(s["end"], x["b"]).alias("end")), lambda s: s["n"])
    counted = hits.select("id", "body", covered.cast("long").alias("n_hit"))
    found = hits.select("id", "body", F.explode(F.array_distinct(F.transform("hits", lambda c: c["w"]))).alias("w2"))
    found = found.join(side(every.select("item", "w")), F.col("w2") == F.col("w")).groupBy("id", "body").agg(F.sort_array(F.collect_set("item")).alias("items"))
    found = found.select(F.col("id").alias("fid"), F.col("body").alias("fbody"), "items")
    counted = counted.join(found, F.col("id").eqNullSafe(F.col("fid")) & (F.col("body") == F.col("fbody")), "left").select("id", "body", "n_hit", "items")
    out = base.join(counted, same(base, counted, "id", "body"), "left")
    hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    return out.select(
        base["id"].alias("doc_id"), base["body"].alias("body_hash"), "n_words", hit.alias("n_hit"), F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
        F.coalesce(F.sha2(F.array_join("items", ","), 256), nothing).alias("items_sha256"), (hit > 0).alias("contaminated"),
    )


def uncontaminated(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", **names: str) -> DataFrame:
    """docs without the contaminated documents; docs' own columns."""
    bad = contamination(docs, benchmark, doc_id, text, **names).where("contaminated").select(F.col("doc_id").alias("_k"), F.col("body_hash").alias("_b")).distinct()
    return docs.join(bad, docs[doc_id].eqNullSafe(bad["_k"]) & (F.xxhash64(docs[text]) == bad["_b"]), "left_anti")
