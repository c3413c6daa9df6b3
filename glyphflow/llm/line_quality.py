"""Quality rules: text statistics of each document, and lines that too many documents of one host share.

Built-in functions only. A line is normalised (lower case, one space between words, digits as 0) and hashed; a host's
limit is the larger of MIN_DOCS and SHARE of its documents. Documents of equal text count once, so that copies, which
near-dedup handles, don't make each other's lines frequent; the first document (smallest id) of a host that carries a
frequent line keeps it, all others lose it from their text. A document is depleted, and rejected, when under LEAST_LEFT
percent of its words are left.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import SPACE, SPACES, ascii_words, let, same, written

MIN_DOCS = 20
SHARE = 0.001
LEAST_LEFT = 20
LEAST_WORDS = 50
MOST_REPEATED = 50
SALTS = 16
#: What a line with a word has.
SOLID = r"[^\x20\x09-\x0D]"


def repeated_words(words: Column) -> Column:
    """How many words stand in a three-word window that occurs twice or more.

    Windows are hashed; the hash's low bits and the position are packed in one long, so that the common case is a sort of
    plain longs. Neighbours that agree are compared once more by their whole hash.
    """

    def covered(t: Column) -> Column:
        def clash(s: Column, key) -> Column:
            last = F.size(s) - 1
            at = F.sequence(F.lit(0), last)
            return F.filter(at, lambda k: ((k > 0) & (key(F.get(s, k)) == key(F.get(s, k - 1)))) | ((k < last) & (key(F.get(s, k)) == key(F.get(s, k + 1)))))

        def packed(bits: Column) -> Column:
            whole = F.sort_array(F.transform(t, lambda x, i: F.call_function("shiftleft", x, bits).bitwiseOR(i.cast("long"))))
            high = lambda x: F.call_function("shiftright", x, bits)
            mask = F.call_function("shiftleft", F.lit(1).cast("long"), bits) - 1
            near = let(whole, lambda s: F.transform(clash(s, high), lambda k: F.get(s, k).bitwiseAND(mask).cast("int")))
            exact = let(F.sort_array(F.transform(near, lambda i: F.struct(F.get(t, i).alias("h"), i.alias("i")))), lambda s: F.when(F.size(s) == 0, F.array().cast("array<int>")).otherwise(F.transform(clash(s, lambda x: x["h"]), lambda k: F.get(s, k)["i"])))
            zero = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))
            return F.aggregate(F.sort_array(exact), zero, lambda a, i: F.struct((a["n"] + i + 3 - F.greatest(i, a["end"])).alias("n"), (i + 3).alias("end")), lambda a: a["n"])

        return let(F.length(F.bin(F.size(t).cast("long"))), packed)

    def windows(h: Column) -> Column:
        return F.transform(F.slice(h, 1, F.size(h) - 2), lambda x, i: F.xxhash64(x, F.get(h, i + 1), F.get(h, i + 2)))

    # most texts repeat no window, which the number of distinct hashes shows without a sort
    hashes = let(F.transform(words, lambda w: F.xxhash64(w)), windows)
    return F.when(F.size(words) < 4, F.lit(0)).otherwise(let(hashes, lambda t: F.when(F.size(F.array_distinct(t)) == F.size(t), F.lit(0)).otherwise(covered(t))))


def lines(text: Column) -> Column:
    """The \\n-split lines that have a word."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: x.rlike(SOLID))


def without(text: Column, places: Column) -> Column:
    """text without the \\n-split lines at places (sorted, from 0)."""

    def pieces(whole: Column) -> Column:
        begins, ends = F.concat(F.array(F.lit(0)), F.transform(places, lambda p: p + 1)), F.concat(places, F.array(F.size(whole)))
        return F.zip_with(begins, ends, lambda a, b: F.slice(whole, a + 1, b - a))

    return F.when(F.size(places) == 0, text).otherwise(F.array_join(F.flatten(let(F.split(text, "\n"), pieces)), "\n"))


def normalised(line: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.btrim(F.lower(line), F.lit(SPACES)), SPACE + "+", " "), "[0-9]", "0")


def base(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", host: str = "source") -> DataFrame:
    """One row for each row of docs: _id, _body (hash of the text), _host, _text, _row (the other columns) and the text statistics."""
    t = F.coalesce(F.col(text), F.lit(""))
    others = F.struct(*(docs[c] for c in docs.columns if c != text)).alias("_row")
    with_words = docs.select(F.col(doc_id).alias("_id"), F.xxhash64(F.col(text)).alias("_body"), F.col(host).alias("_host"), F.col(text).alias("_text"), others, t.alias("_t"), ascii_words(F.col(text)).alias("_w"))
    stats = with_words.select(
        "_id", "_body", "_host", "_text", "_row",
        F.size("_w").cast("long").alias("n_words"),
        F.length(F.regexp_replace("_t", SPACE + "+", "")).cast("long").alias("word_chars"),
        (F.length("_t") - F.length(F.regexp_replace("_t", "[#*$%&|<>]+", ""))).cast("long").alias("n_symbols"),
        let(lines(F.col("_t")), lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        repeated_words(F.col("_w")).cast("long").alias("n_repeat_words"),
    )
    return stats.withColumn("base_failed", (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words")))


def line_words(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", host: str = "source") -> DataFrame:
    """A row for each line with a word: its document, place among all lines, hash and number of words."""
    whole = F.split(F.coalesce(F.col(text), F.lit("")), "\n")
    # two steps: what stands beside a generator in one select is computed again for each of its rows
    split = docs.select(F.col(doc_id).alias("_id"), F.xxhash64(F.col(text)).alias("_body"), F.col(host).alias("_host"), whole.alias("_lines"))
    found = split.select("_id", "_body", "_host", F.posexplode("_lines").alias("_at", "_line")).where(F.col("_line").rlike(SOLID))
    n = normalised(F.col("_line"))
    return found.select("_id", "_body", "_host", "_at", F.xxhash64(n).alias("_hash"), F.size(F.split(n, " ")).alias("_n"))


def frequent_lines(each: DataFrame, min_docs: int = MIN_DOCS, share: float = SHARE) -> DataFrame:
    """Host, hash, number of distinct documents and first document of the lines above their host's limit."""
    carriers = each.groupBy("_host", "_hash", "_body").agg(F.min("_id").alias("_id"))
    counted = carriers.groupBy("_host", "_hash").agg(F.count(F.lit(1)).alias("_docs"), F.min("_id").alias("_first")).where(F.col("_docs") > min_docs)
    hosts = each.select("_host", "_body").distinct().groupBy("_host").agg(F.count(F.lit(1)).alias("_all"))
    return counted.join(hosts.withColumnRenamed("_host", "_h"), F.col("_host").eqNullSafe(F.col("_h"))).where(F.col("_docs") > F.col("_all") * share).drop("_h", "_all")


def judged(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", host: str = "source", min_docs: int = MIN_DOCS, share: float = SHARE, least_left: int = LEAST_LEFT) -> DataFrame:
    """What base says of each row of docs, n_line_words_removed, kept_text and kept."""
    each = written(line_words(docs, doc_id, text, host), "quality-lines")  # texts are split once, and read by three
    frequent = frequent_lines(each, min_docs, share).withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    frequent = frequent.select(*(F.col(c).alias(f"f{c}") for c in ("_host", "_hash", "_salt", "_first")))
    hit = each.join(frequent, (F.col("_hash") == F.col("f_hash")) & F.col("_host").eqNullSafe(F.col("f_host")) & (F.pmod("_body", F.lit(SALTS)) == F.col("f_salt")))
    hit = hit.where(~F.col("_id").eqNullSafe(F.col("f_first"))).groupBy("_id", "_body", "_host", "_at").agg(F.max("_n").alias("_n"))
    removed = hit.groupBy("_id", "_body", "_host").agg(F.sum("_n").alias("_removed"), F.array_sort(F.collect_list("_at")).alias("_cut"))
    stats = base(docs, doc_id, text, host)
    out = stats.join(removed, same(stats, removed, "_id", "_body", "_host"), "left").drop(removed["_id"]).drop(removed["_body"]).drop(removed["_host"])
    gone = F.coalesce(F.col("_removed"), F.lit(0)).cast("long")
    kept = ~F.col("base_failed") & (100 * (F.col("n_words") - gone) >= least_left * F.col("n_words"))
    kept_text = without(F.coalesce("_text", F.lit("")), F.coalesce("_cut", F.array().cast("array<int>")))
    return out.withColumns({"n_line_words_removed": gone, "kept_text": kept_text, "kept": kept}).drop("_removed", "_cut")


def line_quality(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", host: str = "source", min_docs: int = MIN_DOCS, share: float = SHARE, least_left: int = LEAST_LEFT) -> DataFrame:
    """doc_id, the statistics (of the whole text), n_line_words_removed, kept_text (the text without the frequent lines that
    others have first) and kept, a row for each row of docs.

    Null or empty text: no words, base_failed, kept as an empty text. Null host: a host of its own. Null ids: kept as rows;
    equal rows get equal verdicts. Columns of docs other than the three named ones are not looked at. No rows give no rows.
    """
    out = judged(docs, doc_id, text, host, min_docs, share, least_left)
    return out.select(F.col("_id").alias("doc_id"), F.col("_body").alias("body_hash"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "n_line_words_removed", "kept_text", "kept")


def keep_good(docs: DataFrame, text: str = "text", **how: str | float) -> DataFrame:
    """docs without the rejected documents and without the lines that go from the others, with docs' own columns."""
    good = judged(docs, text=text, **how).where("kept")
    return good.select(*((F.col("kept_text") if c == text else F.col("_row")[c]).alias(c) for c in docs.columns))
