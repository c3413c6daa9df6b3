"""A content-addressed store of token ids.

Encoding: each document's ids, its end id appended, are cut into chunks where a rolling hash of the last WINDOW ids has
its low bits at zero, so that equal passages give equal chunks. A chunk's address is the SHA-256 of its bytes.

Files (in the store's folder, all integers little-endian):
- pack-<first place>-<uuid>.bin: unique chunks, ids as unsigned 16 or 32 bits, one after the other in zstd frames of about
  FRAME bytes; documents go to packs in ascending doc_id order, a chunk is stored with the first document that has it.
- index-<uuid>.parquet, of each pack: digest, pack, frame's offset and length in the pack, the chunk's offset in the unpacked
  frame, its bytes.
- recipes-<uuid>.parquet, of each pack: pack, place in the pack, ids of the pack before it, doc_id, body_hash, n_tokens,
  chunk digests and sizes, Merkle root.
- manifest (Parquet): pack, its number of documents and tokens, its first start.

Texts are tokenized once; the ids cross the network once, in the sort by doc_id. Tasks write their files by themselves and
return a row for each; the driver gets those rows. What tokenizers remember is dropped before packs are written and read. Reading goes through each pack in order;
a chunk that another pack holds is fetched by offset. Every chunk, document and pack is verified on the way.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections import OrderedDict
from collections.abc import Iterator
from functools import lru_cache
from itertools import pairwise

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .files import Rows, reader, writer
from .hashing import slices
from .pieces import Ids, load
from .shared import discard, forget, found, new_folder, remembers, small_batches, written

#: The id that ends a document.
END = 0
WINDOW = 16
#: A cut after one id in so many, and chunks of so many ids at least and at most.
MEAN, LEAST, MOST = 1024, 256, 8192
FRAME = 1 << 17
#: A pack ends after so many bytes, or documents of so many chunks, so that what its writer and its reader hold is bounded.
PACK_BYTES, PACK_CHUNKS = 256 << 20, 1 << 18
#: Texts are encoded together up to so many bytes; a longer one alone.
SLICE = 8 << 20
GEAR_SEED = 7
SALTS = 16


class StoreError(ValueError):
    """A chunk, document or pack that is not what its digest says."""


@lru_cache(maxsize=2)
def gear(n: int) -> np.ndarray:
    return np.random.default_rng(GEAR_SEED).integers(0, 1 << 63, n, dtype=np.uint64)


def cut_places(ids: np.ndarray) -> np.ndarray:
    """Where a rolling sum of WINDOW gear values, each shifted by its age, has its low bits at zero, after the last id.

    ids may be those of several documents: sums reach back over WINDOW ids at most, and no chunk is as short as that.
    """
    h = gear(1 << 17)[ids & 0x1FFFF]
    width = 1
    while width < WINDOW:
        h[width:] += h[:-width] << np.uint64(width)  # numpy reads all of the right side before it writes
        width *= 2
    return np.flatnonzero((h & np.uint64((MEAN - 1) << (WINDOW - 1))) == 0) + 1


def cuts(places: np.ndarray, n: int) -> list[int]:
    """Ends of the chunks of n ids, content-defined where places allow it."""
    ends, last = [], 0
    for at in places.tolist():
        while at - last > MOST:
            last += MOST
            ends.append(last)
        if at - last >= LEAST:
            ends.append(at)
            last = at
    while n - last > MOST:
        last += MOST
        ends.append(last)
    return ends + [n] if last < n else ends


def merkle(digests: list[bytes]) -> bytes:
    """Root of a binary tree of SHA-256; an odd last node goes up as it is."""
    level = digests or [hashlib.sha256(b"").digest()]
    while len(level) > 1:
        level = [hashlib.sha256(level[i] + level[i + 1]).digest() if i + 1 < len(level) else level[i] for i in range(0, len(level), 2)]
    return level[0]


@lru_cache(maxsize=1)
def encoder(path: str) -> Ids:
    return Ids(load(path))


remembers(encoder.cache_clear)


def make_room() -> None:
    """Before packs are written or read: what tokenizers remember and what Arrow's pool holds on to goes."""
    forget()
    pa.default_memory_pool().release_unused()


def encoded(docs: DataFrame, tokenizer: str, doc_id: str, text: str) -> DataFrame:
    """doc_id (a string), body_hash, n_tokens, digests, sizes (ids in each chunk) and ids (bytes) of every document, from
    files that discard() deletes."""
    width = "<u2" if load(tokenizer).get_vocab_size() <= 1 << 16 else "<u4"
    fields = [pa.field("doc_id", pa.string()), pa.field("body_hash", pa.int64()), pa.field("n_tokens", pa.int64()), pa.field("digests", pa.list_(pa.binary())), pa.field("sizes", pa.list_(pa.int32())), pa.field("ids", pa.binary())]

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of, k = encoder(tokenizer), int(width[-1])
        for batch in batches:
            for start, _, words, offsets in slices(batch.column(2), SLICE):
                for a, b, ids, begins in ids_of.of(words, offsets, END):
                    packed = ids.astype(width).tobytes()
                    places, rows = cut_places(ids), []
                    for (at, to), (first, last) in zip(pairwise(begins.tolist()), pairwise(np.searchsorted(places, begins, "right").tolist()), strict=True):
                        ends = cuts(places[first:last] - at, to - at)
                        edges = [0, *ends]
                        rows.append((to - at, [hashlib.sha256(packed[(at + x) * k : (at + y) * k]).digest() for x, y in pairwise(edges)], [y - x for x, y in pairwise(edges)], packed[at * k : to * k]))
                    named = [batch.column(i).slice(start + a, b - a) for i in range(2)]
                    yield pa.RecordBatch.from_arrays([*named, *(pa.array(x, f.type) for x, f in zip(zip(*rows, strict=True), fields[2:], strict=True))], schema=pa.schema(fields))

    folder = new_folder(docs.sparkSession, "token-ids")

    def save(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = None
        for batch in encode(batches):
            rows = rows or Rows(f"{folder}/{uuid.uuid4().hex}.parquet", pa.schema(fields))
            rows.add(batch)
        if rows is not None:
            rows.close()
            yield pa.RecordBatch.from_pydict({"name": [rows.name]})

    with small_batches(docs.sparkSession):
        names = docs.select(F.col(doc_id).cast("string"), F.xxhash64(F.col(text)), F.col(text)).mapInArrow(save, "name string").collect()
    return found(docs.sparkSession, folder, [r["name"] for r in names], "doc_id string, body_hash long, n_tokens long, digests array<binary>, sizes array<int>, ids binary")


INDEX = pa.schema([("digest", pa.binary()), ("pack", pa.string()), ("frame", pa.int64()), ("frame_bytes", pa.int64()), ("at", pa.int64()), ("n_bytes", pa.int64())])
RECIPE = pa.schema([("pack", pa.string()), ("place", pa.int64()), ("before", pa.int64()), ("doc_id", pa.string()), ("body_hash", pa.int64()), ("n_tokens", pa.int64()), ("digests", pa.list_(pa.binary())), ("sizes", pa.list_(pa.int32())), ("root", pa.binary())])
#: What is known of a pack when it is closed. first_id and first_hash: of its first document; nth: which of its task's packs.
PACK = pa.schema([("pack", pa.string()), ("recipes", pa.string()), ("index", pa.string()), ("first_id", pa.string()), ("first_hash", pa.int64()), ("nth", pa.int64()), ("n_docs", pa.int64()), ("pack_tokens", pa.int64())])
SQL_INDEX = "digest binary, pack string, frame long, frame_bytes long, at long, n_bytes long"
SQL_RECIPE = "pack string, place long, before long, doc_id string, body_hash long, n_tokens long, digests array<binary>, sizes array<int>, root binary"
SQL_PACK = "pack string, recipes string, index string, first_id string, first_hash long, nth long, n_docs long, pack_tokens long"


def batch_of(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


class Pack:
    """A pack file that is being written, with its recipes and its index."""

    def __init__(self, folder: str, nth: int):
        name = uuid.uuid4().hex
        self.name, self.nth = f"{folder}/pack-{name}.bin", nth
        self.recipes, self.places = (Rows(f"{folder}/{kind}-{name}.parquet", schema) for kind, schema in (("recipes", RECIPE), ("index", INDEX)))
        self.out, self.offset, self.held, self.size = writer(self.name), 0, [], 0
        self.first: tuple = ()
        self.rows: list[tuple] = []
        self.n_docs = self.n_tokens = self.n_chunks = 0
        self.index: list[tuple] = []
        self.waiting: list[tuple] = []
        self.seen: set[bytes] = set()

    def add(self, digest: bytes, data: bytes) -> None:
        if digest in self.seen:
            return
        self.seen.add(digest)
        self.waiting.append((digest, self.size, len(data)))
        self.held.append(data)
        self.size += len(data)
        if self.size >= FRAME:
            self.flush()

    def document(self, key: str | None, body: int, n: int, digests: list[bytes], sizes: list[int]) -> None:
        """A recipe; the chunks that no other document stores are added beside it."""
        if not self.n_docs:
            self.first = key, body
        self.rows.append((self.name, self.n_docs, self.n_tokens, key, body, n, digests, sizes, merkle(digests)))
        self.n_docs, self.n_tokens, self.n_chunks = self.n_docs + 1, self.n_tokens + n, self.n_chunks + len(digests)
        if len(self.rows) >= 5000:
            self.recipes.add(batch_of(self.rows, RECIPE))
            self.rows = []

    def flush(self) -> None:
        frame = zstandard.ZstdCompressor(level=3).compress(b"".join(self.held))
        self.out.write(frame)
        self.index += [(d, self.name, self.offset, len(frame), at, n) for d, at, n in self.waiting]
        self.offset += len(frame)
        self.held, self.waiting, self.size = [], [], 0

    def close(self) -> tuple:
        """The pack's row."""
        if self.held:
            self.flush()
        self.out.close()
        for out, rows, schema in ((self.recipes, self.rows, RECIPE), (self.places, self.index, INDEX)):
            for a in range(0, len(rows), 5000):
                out.add(batch_of(rows[a : a + 5000], schema))
            out.close()
        return self.name, self.recipes.name, self.places.name, *self.first, self.nth, self.n_docs, self.n_tokens


class Frames:
    """Frames of packs, the last few unpacked ones kept."""

    def __init__(self, most: int = 192):
        self.most, self.kept, self.files = most, OrderedDict(), {}

    def get(self, name: str, offset: int, length: int) -> bytes:
        key = (name, offset)
        if key not in self.kept:
            if name not in self.files:
                if len(self.files) >= 16:
                    self.files.pop(next(iter(self.files))).close()
                self.files[name] = reader(name)
            self.kept[key] = zstandard.ZstdDecompressor().decompress(self.files[name].read_at(length, offset))
            if len(self.kept) > self.most:
                self.kept.popitem(last=False)
        self.kept.move_to_end(key)
        return self.kept[key]

    def close(self) -> None:
        for f in self.files.values():
            f.close()


def write_store(docs: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text") -> dict[str, DataFrame]:
    """Writes the store; returns its recipes, index and manifest. Null texts are empty: the end id alone. Null ids come
    first; rows of one id are ordered by their text's hash, and equal rows share all their chunks. No rows make no packs.
    Other columns of docs are not looked at, whatever their names."""
    spark = docs.sparkSession
    folder = new_folder(spark, "token-store")
    kind = docs.schema[doc_id].dataType
    ids_files = encoded(docs, tokenizer, doc_id, text)
    all_ids = ids_files.withColumn("doc_id", F.col("doc_id").cast(kind))
    width = 2 if load(tokenizer).get_vocab_size() <= 1 << 16 else 4
    # Who stores a chunk: the first document by (doc_id, body_hash). Only chunks of two documents or more need an answer.
    each = all_ids.select("doc_id", "body_hash", F.explode(F.array_distinct("digests")).alias("digest"))
    owner = each.groupBy("digest").agg(F.min(F.struct("doc_id", "body_hash")).alias("owner"), F.count(F.lit(1)).alias("n")).where("n > 1")
    owner = owner.select(F.col("digest").alias("d"), "owner", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("s"))
    other = each.join(owner, (F.col("digest") == F.col("d")) & (F.pmod("body_hash", F.lit(SALTS)) == F.col("s"))).where(~F.struct("doc_id", "body_hash").eqNullSafe(F.col("owner")))
    other = other.groupBy("doc_id", "body_hash").agg(F.collect_set("digest").alias("digests"))
    none = [F.lit(None).cast(all_ids.schema[c].dataType).alias(c) for c in ("n_tokens", "sizes", "ids")]
    both = all_ids.withColumn("kind", F.lit(1)).unionByName(other.select("doc_id", "body_hash", "digests", *none, F.lit(0).alias("kind")))
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    ordered = both.repartitionByRange(parts, "doc_id").sortWithinPartitions("doc_id", "body_hash", "kind")
    ordered = ordered.select(F.col("doc_id").cast("string").alias("doc_id"), "body_hash", "kind", "n_tokens", "digests", "sizes", "ids")

    def pack_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make_room()
        pack, foreign, of, nth = None, frozenset(), None, 0
        for batch in batches:
            for key, body, kind_, n, digests, sizes, ids in zip(*(batch.column(i).to_pylist() for i in range(7)), strict=True):
                if kind_ == 0:
                    foreign, of = frozenset(digests), (key, body)
                    continue
                if of != (key, body):
                    foreign, of = frozenset(), (key, body)
                if pack is not None and (pack.offset >= PACK_BYTES or pack.n_chunks >= PACK_CHUNKS):
                    yield batch_of([pack.close()], PACK)
                    pack = None
                if pack is None:
                    pack, nth = Pack(folder, nth), nth + 1
                at = 0
                for d, size in zip(digests, sizes, strict=True):
                    if d not in foreign:
                        pack.add(d, ids[at : at + size * width])
                    at += size * width
                pack.document(key, body, n, digests, sizes)
        if pack is not None:
            yield batch_of([pack.close()], PACK)

    with small_batches(spark):
        made = ordered.mapInArrow(pack_up, SQL_PACK).toArrow()
    discard(ids_files)
    recipes = found(spark, folder, made["recipes"].to_pylist(), SQL_RECIPE).withColumn("doc_id", F.col("doc_id").cast(kind))
    index = found(spark, folder, made["index"].to_pylist(), SQL_INDEX)
    # Starts: sums over packs, in the order of their first document, then those in each pack. One row for each pack is
    # ordered; packs that begin with equal rows are of one task.
    packs = spark.createDataFrame(made).withColumn("first_id", F.col("first_id").cast(kind))
    before = Window.orderBy("first_id", "first_hash", "nth").rowsBetween(Window.unboundedPreceding, 0)
    packs = packs.withColumn("pack_start", F.sum("pack_tokens").over(before) - F.col("pack_tokens"))
    manifest = written(packs.select("pack", "n_docs", "pack_tokens", "pack_start"), "token-manifest")
    recipes = recipes.join(manifest.select("pack", "pack_start"), "pack").withColumn("start", F.col("pack_start") + F.col("before")).drop("pack_start", "before")
    return {"recipes": recipes, "index": index, "manifest": manifest}


def read_store(store: dict[str, DataFrame], width: int) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document, from the files; each chunk and document is verified.

    A task reads a pack: its recipes in order, with the place of every chunk. Packs' chunks that others hold come by offset.
    """
    recipes, index = store["recipes"], store["index"]
    needs = recipes.select("pack", F.explode("digests").alias("digest")).distinct()
    places = needs.join(index.withColumnRenamed("pack", "holder"), "digest")
    none = lambda names: [F.lit(None).cast(recipes.schema[c].dataType).alias(c) for c in names]
    kind = recipes.schema["doc_id"].dataType
    docs_ = recipes.select("pack", "place", F.col("doc_id").cast("string").alias("doc_id"), "start", "n_tokens", "digests", "root", *(F.lit(None).cast(t).alias(c) for c, t in (("digest", "binary"), ("holder", "string"), ("frame", "long"), ("frame_bytes", "long"), ("at", "long"), ("n_bytes", "long"))))
    spots = places.select("pack", F.lit(-1).cast("long").alias("place"), F.lit(None).cast("string").alias("doc_id"), *none(("start", "n_tokens", "digests", "root")), "digest", "holder", "frame", "frame_bytes", "at", "n_bytes")
    n_packs = max(1, store["manifest"].count())
    rows = docs_.unionByName(spots).repartition(n_packs, "pack").sortWithinPartitions("pack", "place")
    schema = pa.schema([("doc_id", pa.string()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])
    kind_of = "<u2" if width == 2 else "<u4"

    def restore(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make_room()
        frames, spots, pack = Frames(), {}, None
        for batch in batches:
            cols = {n: batch.column(i).to_pylist() for i, n in enumerate(batch.schema.names)}
            out = []
            for i, place in enumerate(cols["place"]):
                if cols["pack"][i] != pack:
                    pack, spots = cols["pack"][i], {}
                if place < 0:
                    spots[cols["digest"][i]] = tuple(cols[c][i] for c in ("holder", "frame", "frame_bytes", "at", "n_bytes"))
                    continue
                parts = []
                for d in cols["digests"][i]:
                    holder, frame, n, at, size = spots[d]
                    data = frames.get(holder, frame, n)[at : at + size]
                    if hashlib.sha256(data).digest() != d:
                        raise StoreError(f"{holder}: wrong chunk at {frame}+{at}")
                    parts.append(data)
                ids = np.frombuffer(b"".join(parts), dtype=kind_of)
                if merkle(cols["digests"][i]) != cols["root"][i] or len(ids) != cols["n_tokens"][i]:
                    raise StoreError(f"{pack}: document {cols['doc_id'][i]} is not what its recipe says")
                out.append((cols["doc_id"][i], cols["start"][i], len(ids), zlib.crc32(ids.astype("<u4").tobytes())))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)
        frames.close()

    return rows.mapInArrow(restore, "doc_id string, start long, n_tokens long, ids_crc32 long").withColumn("doc_id", F.col("doc_id").cast(kind))


def store_round_trip(docs: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Writes the store of docs and reads it back; no rows give no rows."""
    width = 2 if load(tokenizer).get_vocab_size() <= 1 << 16 else 4
    return read_store(write_store(docs, tokenizer, doc_id, text), width)
