"""Near-duplicate documents: universal hash minima, banding, verification on full sets, connected components.

Documents with equal shingle sets are one class, found by a 128-bit fingerprint; only classes are compared. Classes that
share a band's minima form a bucket, whose smallest id is its hub, and every class of the bucket is compared with the hub.
What a hub's buckets hold in common with it is its group: a linear number of rows, however large a bucket is. Classes that
are not linked to their hub are compared with the rest of its group, in blocks within a task, so that no pair is emitted
that isn't a link: first by size, by the distance of both to the hub (Jaccard distance is a metric, so distances that
differ by more than 1 - threshold exclude a link), then by signature, then by the full sets.

At similarity 0.8 all 40 bands of 5 minima miss a pair with a chance of 1.3e-7; a signature of 200 minima agrees in less
than SURELY of its places with a chance below 1e-11.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .components import components
from .hashing import mixed, shingle_sets, slices
from .shared import discard, forget, written

ROWS, BANDS = 5, 40
PERCENT = 80
SURELY = 0.6
SALTS = 16
#: A hub's group is dealt over tasks in parts of so many members; unlinked members come in blocks of so many.
PART, BLOCK = 8192, 8192
#: A block's sets have so many shingles together, but for a longer one.
BLOCK_ITEMS = 1 << 20
SIGN = -(1 << 63)


@lru_cache(maxsize=1)
def family() -> tuple[np.ndarray, np.ndarray]:
    """Multipliers (odd) and addends of the universal hash functions."""
    rng = np.random.default_rng(8)
    n = ROWS * BANDS
    return rng.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1), rng.integers(0, 1 << 63, n, dtype=np.uint64)


def signatures(x: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Minima of all hash functions over each set, as rows of 32 bits; x holds the sets one after the other, none empty."""
    a, b = family()
    out = np.empty((len(begins), len(a)), dtype=np.uint32)
    for j in range(len(a)):
        out[:, j] = np.minimum.reduceat(x * a[j] + b[j], begins) >> np.uint64(32)
    return out


def band_keys(sig: np.ndarray) -> np.ndarray:
    """A 64-bit key for each band of each signature; a band's number is part of its key."""
    acc = np.broadcast_to(mixed(np.arange(BANDS, dtype=np.uint64)), (len(sig), BANDS)).copy()
    parts = sig.reshape(len(sig), BANDS, ROWS).astype(np.uint64)
    for r in range(ROWS):
        acc = mixed(acc * np.uint64(0xA24BAED4963EE407) + parts[:, :, r])
    return acc.view(np.int64)


def node(docs: DataFrame, doc_id: str, text: str) -> Column:
    """What documents are known by: 16 bytes, id and hash of the text, in the order of the ids."""
    half = lambda x: F.lpad(F.hex(x), 16, "0")
    return F.unhex(F.concat(half(docs[doc_id].cast("long").bitwiseXOR(F.lit(SIGN))), half(F.xxhash64(docs[text]))))


def id_of(key: Column) -> Column:
    return F.conv(F.hex(F.substring(key, 1, 8)), 16, -10).cast("long").bitwiseXOR(F.lit(SIGN))


def sketched(docs: DataFrame, doc_id: str, text: str, k: int) -> DataFrame:
    """id, node, n (set size), f1 and f2 (fingerprint) and bands of every row; f1, f2 and bands are null for empty sets."""
    schema = pa.schema([("id", pa.int64()), ("node", pa.binary()), ("n", pa.int64()), ("f1", pa.int64()), ("f2", pa.int64()), ("bands", pa.list_(pa.int64()))])

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for batch in batches:
            for a, b, data, offsets in slices(batch.column(2)):
                x, y, begins = shingle_sets(data, offsets, k)
                n = np.diff(begins)
                full = np.flatnonzero(n > 0)
                f1, f2, bands = np.zeros(b - a, np.int64), np.zeros(b - a, np.int64), np.zeros((b - a, BANDS), np.int64)
                if len(full):
                    starts = begins[:-1][full]
                    f1[full] = np.add.reduceat(mixed(x), starts).view(np.int64)
                    f2[full] = np.add.reduceat(mixed(y), starts).view(np.int64)
                    bands[full] = band_keys(signatures(x, starts))
                none = n == 0
                lists = pa.ListArray.from_arrays(pa.array(np.arange(b - a + 1, dtype=np.int32) * BANDS), pa.array(bands.ravel()))
                yield pa.RecordBatch.from_arrays([*(batch.column(i).slice(a, b - a).cast(schema.types[i]) for i in range(2)), pa.array(n), pa.array(f1, mask=none), pa.array(f2, mask=none), lists], schema=schema)

    return docs.select(F.col(doc_id).cast("long"), node(docs, doc_id, text), F.col(text)).mapInArrow(sketch, "id long, node binary, n long, f1 long, f2 long, bands array<long>")


def full_sets(docs: DataFrame, k: int) -> DataFrame:
    """key, items (the set as bytes: the first hashes of all shingles, then the second ones) and sig (its signature's low
    bytes) of every row (key, text)."""
    schema = pa.schema([("key", pa.int64()), ("items", pa.binary()), ("sig", pa.binary())])

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for batch in batches:
            for a, b, data, offsets in slices(batch.column(1)):
                x, y, begins = shingle_sets(data, offsets, k)
                sig = signatures(x, begins[:-1]).astype(np.uint8)  # no set is empty here
                items = [x[i:j].tobytes() + y[i:j].tobytes() for i, j in pairwise(begins.tolist())]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(items, pa.binary()), pa.array([s.tobytes() for s in sig], pa.binary())], schema=schema)

    return docs.mapInArrow(build, "key long, items binary, sig binary")


def items_of(data: pa.BinaryScalar) -> np.ndarray:
    """A set as two rows of hashes."""
    return np.frombuffer(data.as_buffer(), dtype=np.uint64).reshape(2, -1)


def shared(ours: np.ndarray, theirs: np.ndarray) -> int:
    """Size of the intersection of two sets, by both hashes of each shingle."""
    at = np.minimum(np.searchsorted(theirs[0], ours[0]), theirs.shape[1] - 1)
    hit = theirs[0][at] == ours[0]
    both = hit & (theirs[1][at] == ours[1])
    if (n := int(np.count_nonzero(both))) == int(np.count_nonzero(hit)):
        return n
    return len(set(zip(*ours.tolist(), strict=True)) & set(zip(*theirs.tolist(), strict=True)))  # a first hash of two shingles


def linked(common, a, b, percent: int):
    return 100 * common >= percent * (a + b - common)


def compared(rows: DataFrame) -> DataFrame:
    """hub, member, common, n_hub, n of each member's row; rows of a (hub, salt) come together, the hub's first."""
    schema = pa.schema([(n, pa.int64()) for n in ("hub", "member", "common", "n_hub", "n")])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hub, items = None, None
        for batch in batches:
            out = []
            for h, m, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                own = items_of(data)
                if m == h:
                    hub, items = h, own.copy()
                elif h == hub:
                    out.append((h, m, shared(own, items), items.shape[1], own.shape[1]))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*out, strict=True)], schema=schema)

    return rows.mapInArrow(compare, "hub long, member long, common long, n_hub long, n long")


def rest_links(rows: DataFrame, percent: int) -> DataFrame:
    """u, v of links that tie the unlinked members of a block to each other and to their group: a spanning set of them.

    rows: hub, block, part, role (0: of the block, 1: of the group's part), node, j (similarity to the hub), link (to the
    hub), items, sig; ordered so that a block's members come first. They are held; the part streams past. What is tied
    already is not compared again, so no component loses a link that it needs.
    """
    schema = pa.schema([("u", pa.int64()), ("v", pa.int64())])
    far = 1 - percent / 100 + 1e-9

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, ready, label, place = None, [], None, None, {}
        for batch in batches:
            out = []
            cols = [batch.column(i) for i in range(9)]
            for *here, role, i, j, link, items, sig in zip(*(c.to_pylist() for c in cols[:7]), cols[7], cols[8], strict=True):
                if here != key:
                    key, held, ready = here, [], None
                own, mark = items_of(items), np.frombuffer(sig.as_buffer(), dtype=np.uint8)
                if role == 0:
                    held.append((i, j, own.copy(), mark.copy()))
                    continue
                if not held:
                    continue
                if ready is None:
                    ready = np.array([x[1] for x in held]), np.array([x[2].shape[1] for x in held]), np.stack([x[3] for x in held])
                    place = {x[0]: at for at, x in enumerate(held)}
                    label = np.arange(len(held))  # components in the block; -1 is the hub's
                js, sizes, marks = ready
                n = own.shape[1]
                me = place.get(i)
                tied = -1 if link else int(label[me]) if me is not None else None
                may = (np.abs(js - j) <= far) & (100 * np.minimum(sizes, n) >= percent * np.maximum(sizes, n))
                if tied is not None:
                    may &= label != tied
                if me is not None:
                    may[me] = False
                for at in np.flatnonzero(may)[(marks[may] == mark).mean(axis=1) >= SURELY].tolist():
                    if label[at] == tied:
                        continue
                    if linked(shared(own, held[at][2]) if n <= sizes[at] else shared(held[at][2], own), n, int(sizes[at]), percent):
                        out.append((i, held[at][0]))
                        other = int(label[at])
                        if tied is None:
                            tied = other
                        else:
                            label[label == max(other, tied)] = min(other, tied)
                            tied = min(other, tied)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*out, strict=True)], schema=schema)

    return rows.mapInArrow(check, "u long, v long")


def classified(docs: DataFrame, doc_id: str, text: str, k: int, percent: int) -> DataFrame:
    """id, node, n, rep (the smallest node with the same set) and component (the smallest node reachable) of each row; rep
    and component are null for rows without an id."""
    sketches = written(sketched(docs, doc_id, text, k), "near-sketches")
    classes = sketches.where("node is not null and n > 0").groupBy("f1", "f2").agg(F.min("node").alias("rep"), F.count(F.lit(1)).alias("size"))
    # a class goes by a number, which the file fixes
    classes = written(classes.withColumn("key", F.monotonically_increasing_id()).select(F.col("f1").alias("g1"), F.col("f2").alias("g2"), "rep", "size", "key"), "near-classes")
    reps = sketches.join(classes.drop("size"), (F.col("f1") == F.col("g1")) & (F.col("f2") == F.col("g2")) & (F.col("node") == F.col("rep")))
    entries = reps.select("key", F.explode("bands").alias("band"))
    hubs = entries.groupBy("band").agg(F.min("key").alias("hub"), F.max("key").alias("last")).where("hub < last").select(F.col("band").alias("b"), "hub")
    groups = written(entries.join(hubs, F.col("band") == F.col("b")).where("key <> hub").select("hub", F.col("key").alias("member")).distinct(), "near-groups")
    sizes = groups.groupBy("hub").agg(F.ceil(F.count(F.lit(1)) / PART).cast("int").alias("parts"))
    members = groups.select(F.col("member").alias("m")).unionByName(groups.select(F.col("hub").alias("m"))).distinct()
    # the members grow with the corpus: never broadcast, at any size
    wanted = classes.select("rep", "key").join(members.hint("merge"), F.col("key") == F.col("m"), "left_semi")
    keyed = docs.select(node(docs, doc_id, text).alias("node"), docs[text].alias("text"))
    texts = keyed.join(wanted.hint("merge"), F.col("node") == F.col("rep")).select("key", "text", "node").dropDuplicates(["node"]).select("key", "text")
    sets = written(full_sets(texts, k), "near-sets")
    dealt = groups.join(sizes, "hub").select("hub", "member", F.pmod(F.xxhash64("member"), F.col("parts")).cast("int").alias("salt"))
    dealt = dealt.unionByName(sizes.select("hub", F.col("hub").alias("member"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("salt")))
    rows = dealt.join(sets, dealt["member"] == sets["key"]).select("hub", "member", "items", "salt")
    rows = rows.repartition("hub", "salt").sortWithinPartitions("hub", "salt", F.col("member") != F.col("hub"), "member").select("hub", "member", "items")
    stars = written(compared(rows), "near-stars")
    star = stars.withColumn("union", F.col("n_hub") + F.col("n") - F.col("common")).withColumn("link", 100 * F.col("common") >= percent * F.col("union"))
    # The rest: members that aren't linked to their hub, in blocks, against the parts of their group.
    j = star.select("hub", F.col("member").alias("m"), "n", (F.col("common") / F.col("union")).alias("j"), "link")
    alone = j.where(~F.col("link"))
    blocks = alone.groupBy("hub").agg(F.ceil(F.greatest(F.sum("n") / BLOCK_ITEMS, F.count(F.lit(1)) / BLOCK)).cast("int").alias("blocks"), F.min("j").alias("low"), F.max("j").alias("high"))
    blocks = blocks.join(sizes, "hub")
    far = 1 - percent / 100 + 1e-9
    near = j.join(blocks, "hub").where(F.col("j").between(F.col("low") - far, F.col("high") + far))
    each = lambda n, name: F.explode(F.sequence(F.lit(0), F.col(n) - 1)).alias(name)
    of = lambda n, name: F.pmod(F.xxhash64("m"), F.col(n)).cast("int").alias(name)
    sides = near.where(~F.col("link")).select("hub", of("blocks", "block"), each("parts", "part"), F.lit(0).alias("role"), "m", "j", "link")
    sides = sides.unionByName(near.select("hub", each("blocks", "block"), of("parts", "part"), F.lit(1).alias("role"), "m", "j", "link"))
    rows = sides.join(sets, sides["m"] == sets["key"]).select("hub", "block", "part", "role", "m", "j", "link", "items", "sig")
    rows = rows.repartition("hub", "block", "part").sortWithinPartitions("hub", "block", "part", "role", "m")
    links = star.where("link").select(F.col("hub").alias("u"), F.col("member").alias("v")).unionByName(rest_links(rows, percent))
    labels = components(links).join(classes.select("key", F.col("rep").alias("own")), F.col("node") == F.col("key"))
    labels = written(labels.select("component", "own"), "near-labels")
    discard(groups, sets, stars)
    least = labels.groupBy("component").agg(F.min("own").alias("least")).select(F.col("component").alias("c"), "least")
    labels = labels.join(least, F.col("component") == F.col("c")).select("own", "least")
    # Classes of several rows are few: their label comes by fingerprint, salted; all others by node.
    many = classes.where("size > 1").join(labels, F.col("rep") == F.col("own"), "left").select("g1", "g2", "rep", F.coalesce("least", "rep").alias("label"), F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("s"))
    out = sketches.select("id", "node", "n", "f1", "f2").join(many, (F.col("f1") == F.col("g1")) & (F.col("f2") == F.col("g2")) & (F.pmod(F.xxhash64("node"), F.lit(SALTS)) == F.col("s")) & F.col("node").isNotNull(), "left")
    out = out.join(labels, F.col("node") == F.col("own"), "left")
    return out.select("id", "node", "n", F.coalesce("rep", "node").alias("rep"), F.coalesce("label", "least", "node").alias("component"))


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", k: int = 5, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, class_id, component_id and kept for each row of docs.

    Sets are of k-word shingles (fewer words: the sequence as one). class_id is the smallest id with the same set,
    component_id the smallest id reachable by links of percent or more. Null, empty and blank texts are linked with nothing:
    components of their own. Rows without an id are linked with nothing, too, and have null class and component. Rows that
    share an id are judged by their texts, each; doc_id must be integral. No rows give no rows. Other columns of docs are
    not looked at, whatever their names.
    """
    out = classified(docs, doc_id, text, k, percent)
    component = id_of(F.col("component"))
    return out.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), id_of(F.col("rep")).alias("class_id"), component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"))


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", k: int = 5, percent: int = PERCENT) -> DataFrame:
    """docs without the documents of a component that aren't its first: that of the smallest id, and of several texts of
    that id the one of least hash. docs' own columns.

    Of rows that share id and text one stays, the first by all columns. Rows without an id all stay. Null, empty and blank
    texts stay, one row for each id and text. No rows give no rows.
    """
    kept = classified(docs, doc_id, text, k, percent).where("node = component").select(F.col("node").alias("k")).distinct()
    keyed = docs.select(F.struct(*(docs[c] for c in docs.columns)).alias("row"), node(docs, doc_id, text).alias("node"))
    first = keyed.where("node is not null").join(kept, F.col("node") == F.col("k"), "left_semi").groupBy("node").agg(F.min("row").alias("row"))
    return first.select("row.*").unionByName(docs.where(docs[doc_id].isNull()))
