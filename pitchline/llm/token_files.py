"""Token ids in binary shards, with a minimal perfect hash index from document key to place.

Shard: the raw ids of its documents, ascending by doc_id, as little-endian unsigned integers and nothing else.
Index: keys are dealt over buckets by hash, about BUCKET_KEYS to a bucket, which is a file. A bucket's function is a cascade of bit arrays: a key that is
alone on its bit at a level is placed there, the others go on to the next level; the rank of a key's bit among all bits set is
its slot, so n keys fill exactly n slots. Beside each word of 64 bits stands how many bits are set before it, so a rank is one word and one
number. A slot stores a 32-bit fingerprint of its key and shard, offset and count: a look-up reads one word a level, few levels and one
slot whatever the number of keys, and an unknown key is refused unless its fingerprint collides.

Every file is written under a temporary name and then renamed, so a task that runs twice leaves one whole file.
"""

from __future__ import annotations

import json
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import U, as_long, cut, lean, mix, open_fs, shared_dir, table, tune, unique_documents, write_file
from .tokens import encoder

SHARD_CHARS, BUCKET_KEYS, GAMMA = 32_000_000, 20_000, 1.5
SLOT = np.dtype([("finger", "<u4"), ("shard", "<u4"), ("offset", "<u8"), ("count", "<u8")])


# ---------------------------------------------------------------- the perfect hash
def _at(keys: np.ndarray, level: int, size: int) -> np.ndarray:
    return (mix(keys.view(np.uint64) + U((level + 1) * 0x9E3779B97F4A7C15 % 2**64)) % U(size)).astype(np.int64)


def fingerprint(keys: np.ndarray) -> np.ndarray:
    return (mix(keys.view(np.uint64) ^ U(0xF1A9E4)) >> U(32)).astype(np.uint32)


def build_levels(keys: np.ndarray) -> list[np.ndarray]:
    """Bit arrays (as booleans) of the cascade over distinct int64 keys."""
    levels, left = [], keys
    while len(left):
        size = max(8, int(GAMMA * len(left)))
        pos = _at(left, len(levels), size)
        alone = np.bincount(pos, minlength=size) == 1
        levels.append(alone)
        left = left[~alone[pos]]
    return levels


def directory(levels: list[np.ndarray]) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """(bits, words of 64 bits, bits set before each word in this level and those before) of each level."""
    out, base = [], 0
    for bits in levels:
        padded = np.zeros(-(-len(bits) // 64) * 64, bool)
        padded[: len(bits)] = bits
        words = np.packbits(padded, bitorder="little").view("<u8")
        ranks = np.bitwise_count(words).cumsum(dtype=np.uint32)
        out.append((len(bits), words, np.concatenate([[0], ranks[:-1]]).astype("<u4") + np.uint32(base)))
        base += int(ranks[-1])
    return out


def slots_of(keys: np.ndarray, levels) -> np.ndarray:
    """Slot of each key by the levels' directory, -1 where no level has its bit."""
    slot, open_ = np.full(len(keys), -1, np.int64), np.arange(len(keys))
    for i, (size, words, ranks) in enumerate(levels):
        pos = _at(keys[open_], i, size)
        word, bit = words[pos >> 6], (pos & 63).astype(np.uint64)
        hit = (word >> bit) & U(1) == 1
        below = word & ((U(1) << bit) - U(1))
        slot[open_[hit]] = ranks[pos[hit] >> 6].astype(np.int64) + np.bitwise_count(below[hit])
        open_ = open_[~hit]
    return slot


def pack_index(keys: np.ndarray, entries: np.ndarray) -> bytes:
    levels = directory(build_levels(keys))
    table_ = np.zeros(len(keys), SLOT)
    table_[slots_of(keys, levels)] = entries
    head = np.array([len(keys), len(levels), *[n for n, _, _ in levels]], "<u8").tobytes()
    return head + b"".join(w.tobytes() + r.tobytes() for _, w, r in levels) + table_.tobytes()


def read_index(data: bytes):
    n, k = np.frombuffer(data, "<u8", 2).tolist()
    sizes, at, levels = np.frombuffer(data, "<u8", k, 16).tolist(), 16 + 8 * k, []
    for s in sizes:
        w = -(-s // 64)
        levels.append((s, np.frombuffer(data, "<u8", w, at), np.frombuffer(data, "<u4", w, at + 8 * w)))
        at += 12 * w
    return levels, np.frombuffer(data, SLOT, n, at)


def bucket_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    """pmod(xxhash64(key), buckets), as Spark computes it: XXH64 of eight bytes with seed 42."""
    p1, p2, p3, p4, p5 = U(0x9E3779B185EBCA87), U(0xC2B2AE3D27D4EB4F), U(0x165667B19E3779F9), U(0x85EBCA77C2B2AE63), U(0x27D4EB2F165667C5)
    turn = lambda x, n: (x << U(n)) | (x >> U(64 - n))
    h = np.full(len(keys), p5 + U(50)) ^ (turn(keys.view(np.uint64) * p2, 31) * p1)
    h = turn(h, 27) * p1 + p4
    h = (h ^ (h >> U(33))) * p2
    h = (h ^ (h >> U(29))) * p3
    return ((h ^ (h >> U(32))).view(np.int64) % buckets).astype(np.int32)


def bucket_expr(key, buckets: int):
    return F.pmod(F.xxhash64(F.col(key).cast("long")), F.lit(buckets)).cast("int")


# ---------------------------------------------------------------- writing and reading
def _write_shard(path: str, tokenizer: str | None, end_id: int):
    """One partition, sorted by doc_id, becomes one shard; rows tell each document's place in it."""

    def run(batches):
        enc, ctx = encoder(tokenizer), TaskContext.get()
        shard, end, places = ctx.partitionId(), np.array([end_id], enc.dtype).tobytes(), []

        def payload():
            offset = 0
            for b in batches:
                ids, counts = b.column(0).to_numpy(), []
                for x in enc.column(b.column(1)):
                    counts.append(len(x) + 1)
                    yield x.tobytes() + end
                if counts:
                    c = np.array(counts, np.int64)
                    places.append((ids, offset + np.cumsum(c) - c, c))
                    offset += int(c.sum())

        write_file(f"{path}/shard-{shard:06d}.bin", payload(), f"{ctx.stageId()}-{ctx.taskAttemptId()}")
        for ids, off, c in places:
            yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(np.full(len(ids), shard, np.int32)), pa.array(off), pa.array(c)], names=["doc_id", "shard", "offset", "n"])

    return run


def _write_bucket(path: str):
    def run(t: pa.Table) -> pa.Table:
        t = t.combine_chunks()
        keys = np.ascontiguousarray(t.column("doc_id").to_numpy())
        e = np.zeros(len(keys), SLOT)
        e["finger"], e["shard"], e["offset"], e["count"] = fingerprint(keys), t.column("shard").to_numpy(), t.column("offset").to_numpy(), t.column("n").to_numpy()
        bucket, ctx = t.column("bucket")[0].as_py(), TaskContext.get()
        write_file(f"{path}/index-{bucket:06d}.mph", pack_index(keys, e), f"{ctx.stageId()}-{ctx.taskAttemptId()}")
        return pa.table({"bucket": pa.array([bucket], pa.int32()), "keys": pa.array([len(keys)], pa.int64())})

    return run


def write_token_files(documents: DataFrame, path: str, end_id: int = 2, tokenizer: str | None = None) -> dict:
    """Write shards and index below path (a URI all executors reach); returns what meta.json holds.

    Null and empty texts are the end id alone. Repeated ids: unique_documents. No documents: no shards.
    """
    spark = documents.sparkSession
    docs = unique_documents(documents, "text")
    size = docs.agg(F.count("*").alias("n"), F.sum(F.length("text")).alias("c")).first()
    shards, buckets = max(1, -(-(size.c or 0) // SHARD_CHARS)), max(1, -(-size.n // BUCKET_KEYS))
    ordered = docs.repartitionByRange(max(shards, min(spark.sparkContext.defaultParallelism, size.n or 1)), "doc_id").sortWithinPartitions("doc_id")
    places = cut(ordered.mapInArrow(lean(_write_shard(path, tokenizer, end_id)), "doc_id long, shard int, offset long, n long"), "places")
    places.withColumn("bucket", bucket_expr("doc_id", buckets)).groupBy("bucket").applyInArrow(_write_bucket(path), "bucket int, keys long").agg(F.count("*"), F.sum("keys")).first()
    totals = [(r.shard, r.n) for r in places.groupBy("shard").agg(F.sum("n").alias("n")).orderBy("shard").collect()]  # a row a shard
    starts, at = {}, 0
    for s, n in totals:
        starts[s], at = at, at + n
    meta = {"itemsize": int(encoder(tokenizer).dtype.itemsize), "end_id": end_id, "buckets": buckets, "documents": size.n, "tokens": at, "starts": [[s, starts[s], n] for s, n in totals]}
    write_file(f"{path}/meta.json", json.dumps(meta).encode(), "driver")
    return meta


def read_meta(path: str) -> dict:
    fs, p = open_fs(f"{path}/meta.json")
    with fs.open_input_stream(p) as f:
        return json.loads(f.read())


class TokenReader:
    """Keyed access: reader[doc_id] is that document's ids; KeyError for a key that the index doesn't hold."""

    def __init__(self, path: str):
        self.path, self.meta, self.index = path, read_meta(path), {}
        self.fs, self.root = open_fs(path)

    def look_up(self, keys: np.ndarray) -> np.ndarray:
        """A slot for each key; count 0 where the key is unknown."""
        out = np.zeros(len(keys), SLOT)
        of = bucket_of(keys, self.meta["buckets"])
        for b in np.unique(of):
            here = np.flatnonzero(of == b)
            if b not in self.index:
                if len(self.index) >= 16:
                    self.index.clear()
                file = f"{self.root}/index-{b:06d}.mph"
                if self.fs.get_file_info(file).type == pa.fs.FileType.NotFound:
                    continue
                with self.fs.open_input_stream(file) as f:
                    self.index[b] = read_index(f.read())
            levels, slots = self.index[b]
            at = slots_of(keys[here], levels)
            ok = at >= 0
            ok[ok] = slots["finger"][at[ok]] == fingerprint(keys[here][ok])
            out[here[ok]] = slots[at[ok]]
        return out

    def __getitem__(self, doc_id: int) -> np.ndarray:
        s = self.look_up(np.array([doc_id], np.int64))[0]
        if not s["count"]:
            raise KeyError(doc_id)
        return self.payload(int(s["shard"]), int(s["offset"]), int(s["count"]))

    def payload(self, shard: int, offset: int, count: int) -> np.ndarray:
        w = self.meta["itemsize"]
        with self.fs.open_input_file(f"{self.root}/shard-{shard:06d}.bin") as f:
            return np.frombuffer(f.read_at(count * w, offset * w), f"<u{w}")


def _find(path: str):
    def run(batches):
        reader = TokenReader(path)
        for b in batches:
            keys = np.ascontiguousarray(b.column(0).to_numpy())
            s = reader.look_up(keys)
            if (s["count"] == 0).any():
                raise KeyError(int(keys[s["count"] == 0][0]))
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(s["shard"].astype(np.int32)), pa.array(s["offset"].astype(np.int64)), pa.array(s["count"].astype(np.int64))], names=["doc_id", "shard", "offset", "n"])

    return run


def _digest(path: str, starts):
    """Rows sorted by (shard, offset): each shard is read front to back, one document at a time."""

    def run(batches):
        reader, file, at = TokenReader(path), None, None
        w, first = reader.meta["itemsize"], {s: a for s, a, _ in reader.meta["starts"]}
        for b in batches:
            out = []
            for shard, offset, n in zip(*(b.column(c).to_pylist() for c in ("shard", "offset", "n"))):
                if shard != at:
                    file, at = reader.fs.open_input_file(f"{reader.root}/shard-{shard:06d}.bin"), shard
                ids = np.frombuffer(file.read_at(n * w, offset * w), f"<u{w}")
                out.append((first[shard] + offset, zlib.crc32(ids.astype("<u4").tobytes())))
            start, crc = zip(*out) if out else ((), ())
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(start, pa.int64()), b.column("n"), pa.array(crc, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return run


def read_token_files(keys: DataFrame, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of the keys, each found through the index and read from its shard.

    Keys are dealt by bucket, so that a task reads an index file once; what is found is dealt by shard. Numbers of tasks are given, since
    a row's work is its file's and not its own size.
    """
    meta = read_meta(path)
    by_bucket = keys.select(F.col("doc_id").cast("long").alias("doc_id")).withColumn("bucket", bucket_expr("doc_id", meta["buckets"])).repartition(meta["buckets"], "bucket").sortWithinPartitions("bucket").select("doc_id")
    found = by_bucket.mapInArrow(lean(_find(path)), "doc_id long, shard int, offset long, n long")
    found = found.repartition(max(1, len(meta["starts"])), "shard").sortWithinPartitions("shard", "offset")
    return found.mapInArrow(lean(_digest(path, None)), "doc_id long, start long, n_tokens long, ids_crc32 long")


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    tune(spark)
    docs = table(spark, sf_dir, "documents")
    path = shared_dir(spark, "tokens")
    write_token_files(docs, path)
    return read_token_files(unique_documents(docs).select("doc_id"), path)
