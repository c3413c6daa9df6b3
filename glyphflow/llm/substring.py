"""Exact repeats of LENGTH bytes, found by a hash-compared suffix sort of the places that may hold one.

A text's suffixes are too many to sort all of them, so three steps narrow them down without losing any.

1. Every window of LENGTH bytes picks an anchor, its GRAM-byte string of least hash (the leftmost of ties): equal windows
   pick alike. The windows of one anchor are a run; by whether SIDE bytes before or after the anchor lie in them they are
   one or two places, keyed by the hash of anchor and side. Equal windows have equal keys.
2. Places of one key come together. Of every context that two places have (equal by a 128-bit hash), and of every context
   whose key has several, two places or its only one are asked for their bytes; further places of a context go as those.
   Places whose bytes are equal repeat each other, and one of them stands for both in the sort.
3. For each key, the suffixes at the windows of these places, apart by distance to the anchor, are sorted by mergesort:
   prefix polynomial hashes and binary search give the common extension of two suffixes in logarithmic time. Neighbours
   that share LENGTH bytes are compared byte by byte, and repeat each other. What the sort doesn't confirm stays.

Equal texts are one text to steps 1 to 3 within a task, and are removed whole. Matches never cross documents, and all is
judged on the input. Keys with many contexts are split by the hash of each window, so that no group is unbounded.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_128_digest

from .hashing import mixed, powers, prefix_hashes, slices, span_hashes
from .shared import discard, forget, written

LENGTH, GRAM, SIDE = 200, 48, 76
WINDOWS = LENGTH - GRAM + 1
#: Low bits of a packed anchor hash that hold its place; texts are cut into parts of at most so many bytes.
BITS = 24
PART = 1 << 23
#: A key with more contexts than MANY is split into one part for each FEW of them.
MANY, FEW = 2048, 128
#: Bytes of contexts that are sorted at once; rows of contexts that go out together.
BLOCK, ROWS = 1 << 20, 4096


def sliding_least(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of x[i:i + width] for each i that has so many."""
    n = len(x)
    full = -(-n // width) * width
    padded = np.full(full, np.iinfo(np.uint64).max, dtype=np.uint64)
    padded[:n] = x
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[: n - width + 1], ahead[width - 1 : n])


def places(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """text (its number), key, context (128 bits, as two columns), first window, windows - 1 and distance of the first window
    to the anchor."""
    none = tuple(np.zeros(0, t) for t in (np.int64, np.uint64, np.uint64, np.uint64, np.int64, np.int64, np.int64))
    if len(data) < LENGTH:
        return none
    p = prefix_hashes(data)
    at = np.arange(len(data) - GRAM + 1)
    grams = mixed(span_hashes(p, at, at + GRAM))
    low = np.uint64((1 << BITS) - 1)
    anchor = (sliding_least((grams & ~low) | at.astype(np.uint64), WINDOWS) & low).astype(np.int64)
    starts = np.arange(len(anchor))
    text = np.searchsorted(offsets, starts, "right") - 1
    valid = starts + LENGTH <= offsets[text + 1]
    starts, anchor, text = starts[valid], anchor[valid], text[valid]
    if not len(starts):
        return none
    edge = np.flatnonzero((np.diff(anchor) != 0) | (np.diff(starts) != 1)) + 1
    lo = np.concatenate([[0], edge])
    hi = np.concatenate([edge - 1, [len(starts) - 1]])
    first, last, anchor, text = starts[lo], starts[hi], anchor[lo], text[lo]
    out = []
    for before in (True, False):
        # windows at a distance of SIDE or more hold SIDE bytes before the anchor, the others hold them after it
        a = first if before else np.maximum(first, anchor - SIDE + 1)
        b = np.minimum(last, anchor - SIDE) if before else last
        use = a <= b
        a, b, c, t = a[use], b[use], anchor[use], text[use]
        key = mixed(span_hashes(p, c - SIDE, c + GRAM) + np.uint64(1)) if before else mixed(span_hashes(p, c, c + GRAM + SIDE) + np.uint64(2))
        raw = memoryview(data)
        context = np.frombuffer(b"".join([xxh3_128_digest(raw[i:j]) for i, j in zip(a.tolist(), (b + LENGTH).tolist(), strict=True)]), dtype="<u8").reshape(-1, 2)
        extent = ((b - a) * 256 + (c - a)).astype(np.uint64)
        out.append((t, key, context[:, 0] + mixed(extent), context[:, 1], a - offsets[t], b - a, c - a))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def packed(first: np.ndarray, more: np.ndarray, distance: np.ndarray) -> np.ndarray:
    return (first << 16) | (more << 8) | distance


def row_id(doc_id: str, text: str) -> Column:
    return F.xxhash64(F.col(doc_id), F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary")))


def found_places(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """key, context, mark (the context's other half), rid and at (packed) of all places; of equal texts in one task, only
    the first has any."""
    schema = pa.schema([(n, pa.int64()) for n in ("key", "context", "mark", "rid", "at")])

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        seen: set[str] = set()
        for batch in batches:
            bodies = batch.column(2).to_pylist()
            fresh = []
            for i, b in enumerate(bodies):
                if b not in seen:
                    seen.add(b)
                    fresh.append(i)
            batch = batch.take(pa.array(fresh, pa.int64()))
            rids = batch.column(1).to_numpy(zero_copy_only=False)
            for a, b, data, offsets in slices(batch.column(0)):
                parts = [(data, offsets, 0)]
                if len(data) > PART:  # a single text: parts that overlap by a window less one byte
                    parts = [(data[s : s + PART + LENGTH - 1], np.array([0, min(PART + LENGTH - 1, len(data) - s)]), s) for s in range(0, len(data), PART)]
                for part, ends, shift in parts:
                    t, *hashes, first, more, distance = places(part, ends)
                    if len(t):
                        yield pa.RecordBatch.from_arrays([*(pa.array(np.ascontiguousarray(x).view(np.int64)) for x in hashes), pa.array(rids[a:b][t]), pa.array(packed(first + shift, more, distance))], schema=schema)

    rows = docs.where(F.octet_length(text) >= LENGTH).select(F.col(text), row_id(doc_id, text), F.md5(F.col(text).cast("binary")))
    return rows.mapInArrow(find, "key long, context long, mark long, rid long, at long")


def sorted_out(rows: DataFrame) -> DataFrame:
    """Places by key and context, in one streaming pass: what = 1, asked for its bytes; 0, repeated if the context is, which
    two asked places of its context show. Asked are the first two places of every context that has two or more, and of
    every context whose key has several. What is held is one place."""
    schema = pa.schema([("what", pa.int32()), ("key", pa.int64()), ("rid", pa.int64()), ("at", pa.int64())])

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple | None = None  # the first place of the last context, and how many the context has had
        before: int | None = None  # the key of the context before that

        def firsts(key, rid, at, size, known) -> tuple:
            """The asked ones of the first places of contexts; of these, known are complete."""
            nonlocal before
            near = np.zeros(len(key), dtype=bool)
            near[1:] = key[1:] == key[:-1]
            if before is not None and len(key):
                near[0] = key[0] == before
            several = near.copy()
            several[:-1] |= near[1:]
            ask = (several | (size >= 2))[:known]
            if known:
                before = int(key[known - 1])
            return tuple(x[:known][ask] for x in (key, rid, at))

        def batch_of(asked: tuple, more: tuple, rank: np.ndarray) -> pa.RecordBatch:
            """more: places that aren't the first of their context, with their rank in it."""
            what = np.concatenate([np.ones(len(asked[0]), np.int32), (rank == 1).astype(np.int32)])
            return pa.RecordBatch.from_arrays([pa.array(what), *(pa.array(np.concatenate(x)) for x in zip(asked, more, strict=True))], schema=schema)

        for batch in batches:
            key, context, mark, rid, at = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(5))
            if not len(key):
                continue
            new = np.ones(len(key), dtype=bool)
            new[1:] = (key[1:] != key[:-1]) | (context[1:] != context[:-1]) | (mark[1:] != mark[:-1])
            if held is not None:
                new[0] = (key[0], context[0], mark[0]) != held[:3]
            begin = np.flatnonzero(new)
            size = np.diff(np.append(begin, len(key)))
            lead = int(begin[0]) if len(begin) else len(key)
            rank = np.arange(len(key)) - np.concatenate([np.full(lead, -(held[5] if held else 0)), np.repeat(begin, size)])
            cols = [x[begin] for x in (key, context, mark, rid, at)]
            if held is not None:
                cols = [np.concatenate([[h], x]).astype(np.int64) for h, x in zip(held[:5], cols, strict=True)]
                size = np.concatenate([[held[5] + lead], size])
            known = len(size) - 1
            yield batch_of(firsts(cols[0], cols[3], cols[4], size, known), (key[~new], rid[~new], at[~new]), rank[~new])
            held = (*(int(x[-1]) for x in cols), int(size[-1]))
        if held is not None:
            none = np.zeros(0, np.int64)
            yield batch_of(firsts(*(np.array([held[i]], np.int64) for i in (0, 3, 4)), np.array([held[5]]), 1), (none, none, none), none)

    return rows.mapInArrow(judge, "what int, key long, rid long, at long")


def common_extension(prefix: np.ndarray, i: np.ndarray, j: np.ndarray, most: int) -> np.ndarray:
    """Length of the common prefix of the suffixes at i and j, up to most: binary search over equal hashes."""
    inverse = powers(len(prefix))[1]
    low, high = np.zeros(len(i), np.int64), np.full(len(i), most, np.int64)
    for _ in range(int(most).bit_length()):
        mid = (low + high + 1) >> 1
        alike = (prefix[i + mid] - prefix[i]) * inverse[i] == (prefix[j + mid] - prefix[j]) * inverse[j]
        low = np.where(alike, mid, low)
        high = np.where(alike, high, mid - 1)
    return low


def suffix_sort(data: np.ndarray, starts: np.ndarray, segment: np.ndarray, most: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """Order of the suffixes at starts, by segment and then by their first most bytes; and what each shares with the next.

    Bottom-up mergesort: in each pass, an element's place is its own in its run and, by binary search, that in the run it is
    merged with. All segments are merged at once. starts + most must not pass the end of data.
    """
    prefix = prefix_hashes(data)
    order = np.argsort(segment, kind="stable")
    seg = segment[order]
    n = len(order)
    begins = np.flatnonzero(np.concatenate([[True], seg[1:] != seg[:-1]])) if n else np.zeros(0, np.int64)
    ends = np.append(begins[1:], n)
    which = np.repeat(np.arange(len(begins)), ends - begins)
    origin, limit = begins[which], ends[which]
    place = np.arange(n)
    longest = int((ends - begins).max()) if n else 0
    width = 1
    while width < longest:
        own = (place - origin) // width
        left = own % 2 == 0
        run = origin + own * width
        other = np.where(left, run + width, run - width)
        begin = np.minimum(other, limit)
        end = np.minimum(other + width, limit)
        live = np.flatnonzero(begin < end)
        low, high = begin.copy(), end.copy()
        todo = live
        while len(todo):
            mid = (low[todo] + high[todo]) >> 1
            i, j = starts[order[todo]], starts[order[mid]]
            k = common_extension(prefix, i, j, most)
            same = k >= most
            a, b = data[np.minimum(i + k, len(data) - 1)], data[np.minimum(j + k, len(data) - 1)]
            after = np.where(same, ~left[todo], b < a)  # the other run's element goes before; of equals the left run's do
            low[todo] = np.where(after, mid + 1, low[todo])
            high[todo] = np.where(after, high[todo], mid)
            todo = todo[low[todo] < high[todo]]
        target = np.where(left, place + (low - begin), place - width + (low - begin))
        merged = np.empty_like(order)
        merged[target] = order
        order = merged
        width *= 2
    shared = np.zeros(n, np.int64)
    if n > 1:
        inside = np.flatnonzero(which[:-1] == which[1:])
        shared[inside] = common_extension(prefix, starts[order[inside]], starts[order[inside + 1]], most)
    return order, shared


def repeated(data: np.ndarray, starts: np.ndarray, segment: np.ndarray, most: int = LENGTH) -> np.ndarray:
    """Whether another suffix of the same segment has the same first most bytes; verified byte by byte."""
    order, shared = suffix_sort(data, starts, segment, most)
    out = np.zeros(len(starts), dtype=bool)
    hits = np.flatnonzero(shared >= most)
    span = np.arange(most)
    for a in range(0, len(hits), 8192):
        h = hits[a : a + 8192]
        i, j = order[h], order[h + 1]
        equal = (data[starts[i][:, None] + span] == data[starts[j][:, None] + span]).all(axis=1)
        out[i[equal]] = True
        out[j[equal]] = True
    return out


def contexts(asked: DataFrame, docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """key, salt, rid, at, data (a place's bytes) and windows (which of its windows, as bytes) of the asked places."""
    many = asked.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > MANY).select(F.col("key").alias("k"), F.ceil(F.col("n") / FEW).alias("parts"))
    each = asked.join(many, F.col("key") == F.col("k"), "left").select("rid", F.struct("key", "at", F.coalesce("parts", F.lit(1)).cast("long").alias("parts")).alias("place"))
    lists = each.groupBy("rid").agg(F.collect_list("place").alias("places")).withColumnRenamed("rid", "r")
    texts = docs.where(F.octet_length(text) >= LENGTH).select(row_id(doc_id, text).alias("rid"), F.col(text).alias("body"))
    joined = texts.join(lists, F.col("rid") == F.col("r")).select("rid", "body", "places")
    schema = pa.schema([("key", pa.int64()), ("salt", pa.int64()), ("rid", pa.int64()), ("at", pa.int64()), ("data", pa.binary()), ("windows", pa.binary())])

    def made(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: set[int] = set()
        for batch in batches:
            rows: list[tuple] = []
            for rid, body, asked_ in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist(), strict=True):
                if rid in done:
                    continue
                done.add(rid)
                body = np.frombuffer(body.as_buffer(), dtype=np.uint8)
                for x in asked_:
                    first, more = x["at"] >> 16, (x["at"] >> 8) & 255
                    data = body[first : first + more + LENGTH]
                    every, own = np.arange(more + 1), data.tobytes()
                    if x["parts"] == 1:
                        rows.append((x["key"], 0, rid, x["at"], own, every.astype(np.uint8).tobytes()))
                    else:
                        salts = mixed(span_hashes(prefix_hashes(data), every, every + LENGTH)) % np.uint64(x["parts"])
                        rows += [(x["key"], s, rid, x["at"], own, every[salts == s].astype(np.uint8).tobytes()) for s in np.unique(salts).tolist()]
                    if len(rows) >= ROWS:
                        yield made(rows)
                        rows = []
            if rows:
                yield made(rows)

    return joined.mapInArrow(cut, "key long, salt long, rid long, at long, data binary, windows binary")


def compared(rows: DataFrame) -> DataFrame:
    """rid, a, b: bytes a to b of the text are in repeated windows. rows: contexts(), a (key, salt) together."""
    schema = pa.schema([("rid", pa.int64()), ("a", pa.int64()), ("b", pa.int64())])

    def block(held: list[list]) -> pa.RecordBatch:
        """held: group (0 for those that another one stands for), rid, at, data, windows, known (whether another place has
        the same bytes)"""
        marks = [np.frombuffer(x[4], dtype=np.uint8).astype(np.int64) for x in held]
        row = np.repeat(np.arange(len(held)), [len(m) for m in marks])
        window = np.concatenate(marks)
        group = np.array([x[0] for x in held], np.int64)
        hit = np.array([x[5] for x in held])[row]
        several = ((group > 0) & (np.bincount(group)[group] > 1))[row]  # one place has nothing to be compared with
        if several.any():
            data = np.frombuffer(b"".join(x[3] for x in held), dtype=np.uint8)
            offset = np.concatenate([[0], np.cumsum([len(x[3]) for x in held])])
            r, w = row[several], window[several]
            distance = np.array([x[2] & 255 for x in held], np.int64)[r] - w
            hit[several] |= repeated(data, offset[r] + w, group[r] * 256 + distance)
        row, window = row[hit], window[hit]
        first = np.array([x[2] >> 16 for x in held], np.int64)[row] + window
        new = np.ones(len(row), dtype=bool)
        new[1:] = (row[1:] != row[:-1]) | (first[1:] > first[:-1] + LENGTH)
        begin = np.flatnonzero(new)
        last = np.append(begin[1:], len(row))[: len(begin)] - 1
        rid = np.array([x[1] for x in held], np.int64)[row]
        return pa.RecordBatch.from_arrays([pa.array(rid[begin]), pa.array(first[begin]), pa.array(first[last] + LENGTH)], schema=schema)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list] = []
        alike: dict[tuple, list] = {}  # by bytes, the first place of the group that has them
        key, group, size = None, 0, 0
        for batch in batches:
            cols = [batch.column(i).to_pylist() for i in range(6)]
            for k, salt, rid, at, data, windows in zip(*cols, strict=True):
                if (k, salt) != key:
                    if size > BLOCK:
                        yield block(held)
                        held, group, size = [], 0, 0
                    key, group, alike = (k, salt), group + 1, {}
                entry = [group, rid, at, data, windows, False]
                same = alike.setdefault((data, at & 255, windows), entry)
                if same is not entry:  # the same bytes: both are repeated, and one is enough for the sort
                    same[5] = entry[5] = True
                    entry[0] = 0
                held.append(entry)
                size += len(data)
        if held:
            yield block(held)

    return rows.mapInArrow(compare, "rid long, a long, b long")


def cut_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", kept_text: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 for each row of docs; with kept (binary) if asked for.

    Null is an empty text. Texts under LENGTH bytes lose nothing. Equal texts of LENGTH or more lose all, the first one too;
    repeated rows are equal texts. No rows give no rows.
    """
    found = found_places(docs, doc_id, text).repartition("key").sortWithinPartitions("key", "context", "mark")
    judged = written(sorted_out(found), "repeat-places", compression="zstd")
    whole = judged.where("what = 0").select("rid", (F.shiftright("at", 16)).alias("a"), (F.shiftright("at", 16) + F.shiftright("at", 8).bitwiseAND(255) + LENGTH).alias("b"))
    rows = contexts(judged.where("what = 1"), docs, doc_id, text).repartition("key", "salt").sortWithinPartitions("key", "salt")
    spans = whole.unionByName(compared(rows)).groupBy("rid").agg(F.array_sort(F.collect_set(F.struct("a", "b"))).alias("spans"))
    spans = written(spans, "repeat-spans", compression="zstd").withColumnRenamed("rid", "r")
    discard(judged)
    body = F.coalesce(F.col(text), F.lit("")).cast("binary")
    base = docs.select(F.col(doc_id).alias("id"), body.alias("body"), row_id(doc_id, text).alias("rid"), F.md5(body).alias("sum"))
    copies = base.where(F.octet_length("body") >= LENGTH).groupBy("sum").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(F.col("sum").alias("copy"), F.explode(F.sequence(F.lit(0), F.lit(15))).alias("s"))
    keys = base.select("id", "sum", "rid").distinct().join(copies, (F.col("sum") == F.col("copy")) & (F.pmod("rid", F.lit(16)) == F.col("s"))).select(F.col("rid").alias("r2")).distinct()
    marks = spans.join(keys, F.col("r") == F.col("r2"), "full").select(F.coalesce("r", "r2").alias("r"), "spans", F.col("r2").isNotNull().alias("all"))
    kind = docs.schema[doc_id].dataType
    joined = base.join(marks, F.col("rid") == F.col("r"), "left").select(F.col("id").cast("string").alias("id"), "body", "spans", F.coalesce("all", F.lit(False)).alias("all"))
    out = [("doc_id", pa.string()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string())] + [("kept", pa.binary())] * kept_text
    schema = pa.schema(out)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for id_, data, cuts, every in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                data = memoryview(data.as_buffer())
                n = len(data)
                merged: list[list[int]] = []
                for x in [{"a": 0, "b": n}] if every else cuts or ():
                    if merged and x["a"] <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], x["b"])
                    else:
                        merged.append([x["a"], x["b"]])
                at, digest, kept = 0, hashlib.sha256(), []
                for a, b in [*merged, [n, n]]:
                    digest.update(data[at:a])
                    if kept_text:
                        kept.append(bytes(data[at:a]))
                    at = b
                row = (id_, n, sum(b - a for a, b in merged), len(merged), digest.hexdigest())
                rows.append((*row, b"".join(kept)) if kept_text else row)
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    ddl = "doc_id string, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * kept_text
    return joined.mapInArrow(apply, ddl).withColumn("doc_id", F.col("doc_id").cast(kind))
