"""Best-fit packing of token sequences, bulk-synchronous.

Pieces (of cut documents) and gaps (what is left of the sequences opened so far) are tables. Pieces are taken by size, from the largest class down. A superstep
1. range-sorts the class's pieces and the gaps that hold the smallest of them, largest first, over many tasks; a gap that holds several of the
   class offers as many slots, so that one superstep fills it;
2. sweeps each range for successors: a piece takes the smallest slot left that holds it;
3. resolves what ranges could not settle among themselves by rank: pieces and slots left over are ranked in their ranges, and a sweep over the ranges' counts
   (two numbers a range) tells which ranks of pieces meet which ranks of slots;
4. updates the gaps, and repeats while some piece left still fits in one.
The class's pieces that no gap holds are dealt over tasks, and each task opens sequences for its share, best fit again; what they leave is gaps for smaller classes.
Equal lengths are dealt over ranges by a hash, so a common length is no single task's; only counts by range, or by class of size, reach the driver.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import cut, discard, lean, table, tune, unique_documents
from .tokens import encoder

_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def _cut_pieces(path: str | None, capacity: int, end_id: int):
    def run(batches):
        enc = encoder(path)
        for b in batches:
            rows = []
            for doc, ids in zip(b.column(0).to_pylist(), enc.column(b.column(1))):
                ids = np.append(ids.astype("<u4"), np.uint32(end_id))
                for i, a in enumerate(range(0, len(ids), capacity)):
                    part = ids[a : a + capacity]
                    rows.append((doc, i, a, len(part), zlib.crc32(part.tobytes())))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()))], names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return run


_OPENED = "part int, rid long, length long, local long, at long"
_SWEPT = "part int, kind int, rank long, rid long, length long, seq long, gap long, slot int"
RANGE_ROWS = 100_000
CLASSES = (1, 4, 8, 32, 256)  # a class's largest pieces are capacity over these


def _sweep(batches):
    """Successor sweep of one range of (size, kind, id, gap, slot), largest first and slots (kind 0) before pieces (1) of equal size.

    Pairs come out as kind 2; slots and pieces that are left, with their ranks. All pieces left are larger than all slots left.
    """
    if not (batches := list(batches)):
        return
    rows = pa.Table.from_batches(batches)
    kind = rows.column("kind").to_numpy()
    free, open_, pair = [], [], []
    for i, k in enumerate(kind.tolist()):
        if k == 0:
            free.append(i)
        elif free:
            pair.append((i, free.pop()))
        else:
            open_.append(i)
    col = {c: rows.column(c).to_numpy() for c in ("size", "id", "gap", "slot")}
    p, g = np.array(pair, np.int64).reshape(-1, 2).T
    part, none = TaskContext.get().partitionId(), np.zeros(0, np.int64)
    for k, pieces, slots in ((2, p, g), (1, np.array(open_, np.int64), none), (0, none, np.array(free, np.int64))):
        if n := max(len(pieces), len(slots)):
            of = lambda c, at: pa.array(col[c][at]) if len(at) else pa.nulls(n, pa.int32() if c == "slot" else pa.int64())  # noqa: B023, E731
            yield pa.RecordBatch.from_arrays([pa.array(np.full(n, part, np.int32)), pa.array(np.full(n, k, np.int32)), pa.array(np.arange(n)), of("id", pieces), of("size", pieces), of("id", slots), of("gap", slots), of("slot", slots)], names=[f.split()[0] for f in _SWEPT.split(", ")])


def _open(capacity: int):
    """New sequences for a task's pieces (rid, length): best fit on runs of equal lengths and of equal gaps, the longest pieces first."""

    def run(batches):
        if not (batches := list(batches)):
            return
        rows = pa.Table.from_batches(batches)
        rid, length = rows.column("rid").to_numpy(), rows.column("length").to_numpy()
        order = np.lexsort((rid, -length))
        local, at = np.empty(len(rid), np.int64), np.empty(len(rid), np.int64)
        sizes, first, counts = np.unique(-length[order], return_index=True, return_counts=True)
        gaps, opened = [], 0  # runs (gap, first sequence, sequences), by gap
        for n, i, left in zip((-sizes).tolist(), first.tolist(), counts.tolist()):
            while left:
                j = bisect_left(gaps, (n,))
                if j < len(gaps):
                    gap, seq, many = gaps.pop(j)
                    k = min(many, left)
                    if k < many:
                        insort(gaps, (gap, seq + k, many - k))
                else:
                    gap, seq, k = capacity, opened, -(-left // (capacity // n))
                    opened += k
                here = order[i : i + k]
                local[here], at[here] = np.arange(seq, seq + k), capacity - gap
                if gap > n:
                    insort(gaps, (gap - n, seq, k))
                i, left = i + k, left - k
        part = np.full(len(rid), TaskContext.get().partitionId(), np.int32)
        yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(rid), pa.array(length), pa.array(local), pa.array(at)], names=[f.split()[0] for f in _OPENED.split(", ")])

    return run


def settle_ranges(counts: list[tuple[int, int, int]]) -> tuple[list[tuple[int, int, int, int, int]], dict[int, int]]:
    """counts: (range, pieces left, slots left), largest sizes first. Rows (range, first rank, end rank, range of slots, slot of the first),
    by which a piece of rank r meets slot `slot of the first - (r - first rank)`, and how many of each range's pieces are settled so."""
    stack, plan, settled = [], [], {}
    for part, pieces, slots in counts:
        done = 0
        while done < pieces and stack:
            host, left = stack.pop()
            k = min(left, pieces - done)
            plan.append((part, done, done + k, host, left - 1))
            done += k
            if left > k:
                stack.append((host, left - k))
        settled[part] = done
        if slots:
            stack.append((part, slots))
    return plan, settled


class Packing:
    """The gaps so far, and the places given: (rid, seq, at)."""

    def __init__(self, spark: SparkSession, capacity: int):
        self.spark, self.capacity, self.steps, self.placed = spark, capacity, 0, []
        self.gaps, self.swept, self.left = spark.createDataFrame([], "seq long, gap long"), None, None

    def place(self, rows: DataFrame) -> None:
        """rows: (rid, length, seq, at), at 0 in a sequence that opens."""
        rows = cut(rows, "placed")
        self.placed.append(rows)
        opened = rows.where("at = 0").select("seq", F.lit(self.capacity).cast("long").alias("gap"))
        change = self.gaps.union(opened).union(rows.select("seq", (-F.col("length")).alias("gap")))
        before, self.gaps = self.gaps, cut(change.groupBy("seq").agg(F.sum("gap").alias("gap")).where("gap > 0"), "gaps")
        discard(before)

    def match(self, pieces: DataFrame, n: int, low: int, high: int) -> tuple[DataFrame, int]:
        """One superstep for n pieces (rid, length) of lengths low to high: (those left, how many they are)."""
        self.steps += 1
        fit = self.gaps.where(F.col("gap") >= low)
        g = fit.agg(F.count("*").alias("n"), F.count(F.when(F.col("gap") >= high, 1)).alias("wide")).first()
        most = 2 * -(-n // g.wide) if g.wide and g.wide < n else 1  # slots that a gap may offer, so that there are some for each piece
        k = F.greatest(F.lit(1), F.least(F.lit(most), F.floor(F.col("gap") / high)))
        slots = fit.withColumn("k", k.cast("int")).select(F.floor(F.col("gap") / F.col("k")).cast("long").alias("size"), F.lit(0).alias("kind"), F.col("seq").alias("id"), "gap", F.explode(F.sequence(F.lit(0), F.col("k") - 1)).alias("slot"))
        rows = slots.union(pieces.select(F.col("length").alias("size"), F.lit(1).alias("kind"), F.col("rid").alias("id"), F.lit(0).cast("long").alias("gap"), F.lit(0).alias("slot")))
        order = [F.desc("size"), F.asc("kind"), F.xxhash64("id", "slot"), F.asc("id"), F.asc("slot")]
        ranges = max(1, min(self.spark.sparkContext.defaultParallelism, (n + g.n) // 1000), (n + g.n) // RANGE_ROWS)
        swept = cut(rows.repartitionByRange(ranges, *order).sortWithinPartitions(*order).mapInArrow(lean(_sweep), _SWEPT), "swept")
        discard(self.swept, self.left)  # the pieces left of them are in the new one
        self.swept, self.left = swept, None
        seen = swept.groupBy("part").agg(F.count(F.when(F.col("kind") == 1, 1)).alias("pieces"), F.count(F.when(F.col("kind") == 0, 1)).alias("slots")).orderBy("part").collect()  # a row a range
        plan, settled = settle_ranges([(r.part, r.pieces, r.slots) for r in seen])
        pairs = swept.where("kind = 2").select("rid", "length", "seq", "gap", "slot")
        left = swept.where("kind = 1").select("part", "rank", "rid", "length")
        if plan:
            meet = F.broadcast(self.spark.createDataFrame(plan, "part int, first long, end long, host int, top long"))  # two rows a range at most
            up = left.join(meet, "part").where("rank >= first and rank < end").select("rid", "length", F.col("host").alias("part"), (F.col("top") - F.col("rank") + F.col("first")).alias("rank"))
            pairs = pairs.union(up.join(swept.where("kind = 0").select("part", "rank", "seq", "gap", "slot"), ["part", "rank"]).select("rid", "length", "seq", "gap", "slot"))
        before = F.sum("length").over(Window.partitionBy("seq").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1))
        rest = sum(r.pieces for r in seen) - sum(settled.values())
        if plan:
            done = F.broadcast(self.spark.createDataFrame(list(settled.items()), "part int, done long"))  # a row a range
            left = left.join(done, "part").where("rank >= done").select("rid", "length")
            if rest:
                left = self.left = cut(left, "left")  # read up to three times
        if rest < n:
            self.place(pairs.select("rid", "length", "seq", (F.lit(self.capacity) - F.col("gap") + F.coalesce(before, F.lit(0))).cast("long").alias("at")))
        return left, rest

    def open(self, pieces: DataFrame, n: int) -> None:
        """Put n pieces (rid, length) into new sequences."""
        rows = pieces.select("rid", "length").repartition(max(1, n // RANGE_ROWS), "rid").mapInArrow(lean(_open(self.capacity)), _OPENED)
        if self.steps >= 1 << 15:
            raise RuntimeError("pack_pieces: too many supersteps")
        seq = F.shiftleft(F.lit(self.steps).cast("long"), 48) + F.shiftleft(F.col("part").cast("long"), 24) + F.col("local")
        self.place(rows.select("rid", "length", seq.alias("seq"), "at"))


def pack_pieces(pieces: DataFrame, capacity: int) -> DataFrame:
    """Adds sequence_id and offset to pieces with a column length, 1 to capacity. Their other columns may have any names but rid, seq and at."""
    spark = pieces.sparkSession
    pieces = cut(pieces.withColumn("rid", F.monotonically_increasing_id()), "pieces")
    bounds = sorted({max(1, capacity // c) for c in CLASSES}, reverse=True)
    class_ = sum((F.col("length") <= b).cast("int") for b in bounds)
    sizes = pieces.groupBy(class_.alias("class")).agg(F.count("*").alias("n"), F.min("length").alias("low"), F.max("length").alias("high")).orderBy("class").collect()  # a row a class
    packing = Packing(spark, capacity)
    for c in sizes:
        n, low, high = c.n, c.low, c.high
        left = pieces.where(F.col("length").between(low, high)).select("rid", F.col("length").cast("long").alias("length"))
        while n:
            left, n = packing.match(left.select("rid", "length"), n, low, high)
            if n:
                low, high = left.agg(F.min("length"), F.max("length")).first()
                if (packing.gaps.agg(F.max("gap")).first()[0] or 0) < low:
                    packing.open(left, n)
                    break
    if not packing.placed:
        return pieces.drop("rid").withColumns({"sequence_id": F.lit(0).cast("long"), "offset": F.lit(0).cast("long")})
    places = packing.placed[0]
    for more in packing.placed[1:]:
        places = places.union(more)
    places = places.select("rid", F.col("seq").alias("sequence_id"), F.col("at").alias("offset"))
    return pieces.join(places, "rid").drop("rid")


def pack_documents(documents: DataFrame, capacity: int = 4096, end_id: int = 1, path: str | None = None, repeats: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    With repeats, rows that repeat an id are copies of the document, all of them packed, told apart by a column copy.

    A null or empty text is the end id alone. Only documents longer than capacity are cut. Repeated ids:
    unique_documents. Equal lengths are told apart by a hash of their row. An empty table gives no rows; extra columns are not read.
    """
    docs = documents.select("doc_id", "text").where("doc_id is not null") if repeats else unique_documents(documents, "text")
    pieces = docs.mapInArrow(lean(_cut_pieces(path, capacity, end_id)), _PIECES)
    if repeats:
        pieces = cut(pieces, "copies")
        pieces = pieces.withColumn("copy", F.row_number().over(Window.partitionBy("doc_id", "piece").orderBy("length", "ids_crc32")) - 1)
    return pack_pieces(pieces, capacity)


def packed_ids(documents: DataFrame, packed: DataFrame, capacity: int = 4096, end_id: int = 1, path: str | None = None) -> DataFrame:
    """The sequences themselves: (sequence_id, ids array<int>), each made of its pieces' ids in order of offset."""

    def run(batches):
        enc = encoder(path)
        for b in batches:
            out = []
            for ids, start, length in zip(enc.column(b.column(1)), b.column("start").to_pylist(), b.column("length").to_pylist()):
                out.append(np.append(ids.astype("<u4"), np.uint32(end_id))[start : start + length].tolist())
            yield pa.RecordBatch.from_arrays([b.column("sequence_id"), b.column("offset"), pa.array(out, pa.list_(pa.int32()))], names=["sequence_id", "offset", "ids"])

    rows = unique_documents(documents, "text").join(packed.select("doc_id", "start", "length", "sequence_id", "offset"), "doc_id")
    rows = rows.mapInArrow(run, "sequence_id long, offset long, ids array<int>")
    whole = F.sort_array(F.collect_list(F.struct("offset", "ids")))  # a sequence has at most `capacity` ids
    return rows.groupBy("sequence_id").agg(whole.alias("parts")).select("sequence_id", F.flatten("parts.ids").alias("ids"))


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    tune(spark)
    return pack_documents(table(spark, sf_dir, "documents"))
