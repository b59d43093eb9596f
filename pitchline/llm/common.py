"""Shared pieces: tables in the cluster's shared folder, unique documents, hashed words and shingles.

Words are the maximal runs of `[^\\x20\\x09-\\x0D]`, found on UTF-8 bytes (no byte of a longer code
point equals one of those six), with A-Z lower-cased. Everything works on whole texts, in slices of
about SLICE bytes, so a Python worker's memory follows the longest single text and not the batch.
"""

from __future__ import annotations

import ctypes
import re
import tempfile
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

SLICE = 1 << 20
U = np.uint64
_rng = np.random.default_rng(20240229)
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * U(2) + U(1)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_VALUE = _BYTE[_LOWER]
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_B = 0x9E3779B97F4A7C15
_POW: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


# ---------------------------------------------------------------- shared folder
def shared_dir(spark: SparkSession, name: str) -> str:
    """A new path below spark.checkpoint.dir; where that is unset and Spark runs on this machine alone (tests), a folder of our own becomes it."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="pitchline-")
        spark.sparkContext.setCheckpointDir(base)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame, name: str = "cut") -> DataFrame:
    """Write df as Parquet in the shared folder and read it again: the lineage ends at replicated files."""
    spark = df.sparkSession
    path = shared_dir(spark, name)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._cut_path = path
    return out


def discard(*tables: DataFrame | None) -> None:
    """Delete tables that cut wrote and that nothing will read again; others are let be."""
    for t in tables:
        path = None if t is None else getattr(t, "_cut_path", None)
        if path:
            p = t.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(t.sparkSession._jsc.hadoopConfiguration()).delete(p, True)


def open_fs(uri: str):
    """(filesystem, path) of any URI that Arrow's file systems know; a bare path is local."""
    return pafs.FileSystem.from_uri(uri if "://" in uri else ("file://" + uri.removeprefix("file:") if uri.startswith(("/", "file:")) else uri))


def write_file(uri: str, data, attempt: str) -> None:
    """Write a whole file so that a lost or repeated task leaves either nothing or the full file."""
    fs, path = open_fs(uri)
    fs.create_dir(path.rsplit("/", 1)[0], recursive=True)
    tmp = f"{path}.{attempt}.tmp"
    with fs.open_output_stream(tmp, compression=None) as out:
        for block in data if not isinstance(data, (bytes, memoryview)) else [data]:
            out.write(block)
    fs.move(tmp, path)


def fits_broadcast(df: DataFrame, mb: int = 32) -> bool:
    """Whether a table of numbers and lists of numbers takes at most so many MB as a hash table: counted, not assumed. Others have no bound."""
    numbers = ("tinyint", "smallint", "int", "bigint", "double", "float", "boolean", "date", "timestamp")
    lists = [c for c, t in df.dtypes if t in [f"array<{x}>" for x in numbers]]
    if any(t not in numbers for c, t in df.dtypes if c not in lists):
        return False
    row = 48 + 8 * len(df.columns)
    if not lists:
        return df.limit((mb << 20) // row + 1).count() <= (mb << 20) // row
    size = df.agg(F.count("*"), *[F.sum(F.size(c)) for c in lists]).first()
    return size[0] * row + 8 * sum(x or 0 for x in size[1:]) <= mb << 20


def maybe_broadcast(df: DataFrame, mb: int = 32) -> DataFrame:
    return F.broadcast(df) if fits_broadcast(df, mb) else df


# ---------------------------------------------------------------- documents
def unique_documents(docs: DataFrame, *columns: str, key: str = "doc_id") -> DataFrame:
    """The named columns of documents, one row for each id.

    Rows without an id are left out (no result could carry them). Where an id repeats, the row with the
    smallest text (then the smallest other columns, as named) stands for it; that costs a shuffle of whole rows, so it
    is done only if a scan of the ids alone finds a repetition.
    """
    out = docs.select(key, *[F.col(f"`{c}`") for c in columns]).where(F.col(key).isNotNull())
    if out.select(key).groupBy(key).count().where("count > 1").limit(1).count():
        kinds = dict(out.dtypes)
        row = F.struct(*[F.col(f"`{c}`") for c in columns])
        order = F.struct(*[F.col(f"`{c}`") for c in columns if not re.search("map<|variant", kinds[c])])  # what can be ordered
        out = out.groupBy(key).agg(F.min_by(row, order).alias("_r")).select(key, *[F.col(f"_r.`{c}`").alias(c) for c in columns])
    return out


def unused(df: DataFrame, name: str) -> str:
    """name, or what comes of it by underscores in front, so that no column of df has it in any case."""
    while name.lower() in {c.lower() for c in df.columns}:
        name = f"_{name}"
    return name


def tune(spark: SparkSession, rows: int = 1000) -> None:
    """Arrow batches of at most so many rows in this session, where its owner has left Spark's default of 10,000.

    Rows here hold whole texts: a batch stands in native memory of the JVM and again in the worker's. Queries and pipeline stages call this; operators
    leave the session as it is.
    """
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(key) == "10000":
        spark.conf.set(key, str(rows))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def rank_in_class(rows: DataFrame, keys: list[str], order: list[str], per_slot: int = 20_000) -> DataFrame:
    """Adds `rank`, from 0, of each row within its keys; the rows of a hot key are ranked in slots of about per_slot.

    A row's slot is a hash of its order columns; slots rank their own rows and the slots' counts, a narrow table,
    tell where each slot begins. rows must be a table that reads the same each time (see cut).
    """
    slots = max(1, -(-rows.count() // per_slot))
    rows = rows.withColumn("_slot", F.pmod(F.xxhash64(*order), F.lit(slots)))
    counted = rows.groupBy(*keys, "_slot").agg(F.count("*").alias("_n"))
    before = F.sum("_n").over(Window.partitionBy(*keys).orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1))
    firsts = cut(counted.select(*keys, "_slot", F.coalesce(before, F.lit(0)).alias("_first")), "ranks")
    within = F.row_number().over(Window.partitionBy(*keys, "_slot").orderBy(*order))
    return rows.withColumn("_within", within).join(firsts, [*keys, "_slot"]).withColumn("rank", (F.col("_first") + F.col("_within") - 1).cast("long")).drop("_slot", "_within", "_first")


def position(rows: DataFrame, *order) -> DataFrame:
    """Adds `position`, from 0, of each row in the order of the whole table, without one task for all rows."""
    laid = cut(rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_id", F.monotonically_increasing_id()), "sorted")
    laid = laid.withColumn("_part", F.shiftright("_id", 33))
    counts = laid.groupBy("_part").agg(F.count("*").alias("_n"))  # a row a range
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rows = laid.join(F.broadcast(counts.select("_part", before.alias("_first"))), "_part")
    return rows.withColumn("position", F.col("_first") + F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))).drop("_id", "_part", "_first")


# ---------------------------------------------------------------- memory of Python workers
def settle() -> None:
    """From now on, arrays of 12 MB and more go back to the system as soon as they are freed; smaller ones are kept at hand, 32 MB of them."""
    c = ctypes.CDLL(None)
    if hasattr(c, "mallopt"):
        c.mallopt(-3, 12 << 20)  # M_MMAP_THRESHOLD
        c.mallopt(-1, 32 << 20)  # M_TRIM_THRESHOLD


def release() -> None:
    """Give back what numpy and Arrow have freed: workers are kept for later tasks, and their memory beside the JVM's with them."""
    pa.default_memory_pool().release_unused()
    c = ctypes.CDLL(None)
    if hasattr(c, "malloc_trim"):
        c.malloc_trim(0)


def lean(run):
    """A function of batches for mapInArrow that releases memory at the end of its task."""

    def tidy(batches):
        settle()
        try:
            yield from run(batches)
        finally:
            release()

    return tidy


# ---------------------------------------------------------------- numpy text kernels
def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POW[0]) < n:
        for i, b in enumerate((_B, pow(_B, -1, 2**64))):
            p = np.full(max(n, SLICE + 1), b, np.uint64)
            p[0] = 1
            _POW[i] = np.multiply.accumulate(p)
    return _POW[0][:n], _POW[1][:n]


def text_buffers(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; nulls count as empty."""
    if col.null_count:
        col = col.fill_null("")
    kind = np.int64 if pa.types.is_large_string(col.type) else np.int32
    off = np.frombuffer(col.buffers()[1], kind)[col.offset : col.offset + len(col) + 1].astype(np.int64)
    data = col.buffers()[2]
    return (np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)), off


def slices(off: np.ndarray, limit: int = SLICE):
    """Row ranges whose texts hold about limit bytes, one row at least."""
    i, n = 0, len(off) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + limit, "right")) - 1)
        yield i, j
        i = j


def word_spans(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words of the texts data[off[i]:off[i+1]], and how many words each text has.

    off must begin at 0; a text's end also ends a word.
    """
    n = len(data)
    if not n:
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(len(off) - 1, np.int64)
    solid = ~_SPACE[data]
    edge = np.zeros(n + 1, bool)
    edge[off] = True
    before = np.empty(n, bool)
    before[0], before[1:] = False, solid[:-1]
    starts = np.flatnonzero(solid & (~before | edge[:-1]))
    after = np.empty(n, bool)
    after[-1], after[:-1] = False, solid[1:]
    ends = np.flatnonzero(solid & (~after | edge[1:])) + 1
    at = np.searchsorted(starts, off)
    return starts, ends, np.diff(at)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, cased: bool = False) -> np.ndarray:
    """A 64-bit hash of each word, lower-cased in A-Z unless cased: a polynomial over random byte values, mixed."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    pw, inv = _powers(len(data) + 1)
    total = np.empty(len(data) + 1, np.uint64)
    total[0] = 0
    np.cumsum((_BYTE if cased else _VALUE)[data] * pw[:-1], out=total[1:])
    return mix((total[ends] - total[starts]) * inv[starts] + (ends - starts).astype(np.uint64) * U(0xD6E8FEB86659FD93))


def shingles(col: pa.Array, k: int):
    """For each text in turn, the sorted distinct 64-bit hashes of its k-word shingles.

    With 1 to k-1 words the whole sequence is the one shingle; without words the set is empty.
    """
    data, off = text_buffers(col)
    empty = np.zeros(0, np.uint64)
    for i, j in slices(off):
        part, o = data[off[i] : off[j]], off[i : j + 1] - off[i]
        s, e, n = word_spans(part, o)
        w = word_hashes(part, s, e)
        first = np.concatenate([[0], np.cumsum(n)])
        if len(w) >= k:
            h = w[: len(w) - k + 1].copy()
            for q in range(1, k):
                h = h * U(0xA24BAED4963EE407) + w[q : len(w) - k + 1 + q]
            h = mix(h + U(k))
        for r in range(j - i):
            a, c = first[r], n[r]
            if c >= k:
                x = np.sort(h[a : a + c - k + 1])
                yield x[np.concatenate([[True], x[1:] != x[:-1]])] if len(x) > 1 else x
            elif c:
                x = w[a : a + 1].copy()
                for q in range(1, c):
                    x = x * U(0xA24BAED4963EE407) + w[a + q]
                yield mix(x + U(c))
            else:
                yield empty


def as_long(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)
