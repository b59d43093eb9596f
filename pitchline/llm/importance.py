"""Quality by importance resampling.

Two generative models over hashed word 1- and 2-grams (case kept), one of the target text and one of all raw
text, are counted over all their documents. A document's log weight is the sum of the log ratio of the two over all its
n-grams: the ratio of its probabilities under the two models. The sample takes the k largest of log weight + Gumbel noise, which is sampling
without replacement in proportion to the weights; the noise is a hash of the id and the seed, so reruns agree.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import U, cut, lean, maybe_broadcast, mix, slices, table, text_buffers, tune, unique_documents, word_hashes, word_spans

BITS, SEED, FRACTION = 16, 11, 0.75
_BINS, CHUNK = 4096, 4096


def _grams(col: pa.Array, bits: int):
    """Bucket numbers of each text's 1- and 2-grams in turn."""
    data, off = text_buffers(col)
    for i, j in slices(off):
        part, o = data[off[i] : off[j]], off[i : j + 1] - off[i]
        s, e, n = word_spans(part, o)
        w = word_hashes(part, s, e, cased=True)
        one = (w >> U(64 - bits)).astype(np.int64)
        two = (mix(w[:-1] * U(0xA24BAED4963EE407) + w[1:]) >> U(64 - bits)).astype(np.int64) if len(w) else one
        a = 0
        for c in n.tolist():
            yield np.concatenate([one[a : a + c], two[a : a + c - 1]]) if c else one[:0]
            a += c


def _count(bits: int):
    """A task's counts, as rows of CHUNK buckets each."""

    def run(batches):
        total = np.zeros(1 << bits, np.int64)
        for b in batches:
            held, size = [], 0
            for x in _grams(b.column(0), bits):
                held.append(x)
                size += len(x)
                if size > 1_000_000:
                    total += np.bincount(np.concatenate(held), minlength=1 << bits)
                    held, size = [], 0
            if held:
                total += np.bincount(np.concatenate(held), minlength=1 << bits)
        parts = total.reshape(-1, min(CHUNK, 1 << bits))
        some = np.flatnonzero(parts.any(1))
        if len(some):
            yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array([parts[i].tobytes() for i in some], pa.binary())], names=["chunk", "counts"])

    return run


def _sum(batches):
    total: dict[int, np.ndarray] = {}
    for b in batches:
        for c, x in zip(b.column(0).to_pylist(), b.column(1)):
            x = np.frombuffer(x.as_buffer(), np.int64)
            total[c] = total[c] + x if c in total else x.copy()
    if total:
        yield pa.RecordBatch.from_arrays([pa.array(total, pa.int32()), pa.array([x.tobytes() for x in total.values()], pa.binary())], names=["chunk", "counts"])


def gram_model(texts: DataFrame, bits: int = BITS) -> np.ndarray:
    """Counts by bucket over all rows of column text. Partial counts are dealt by range of buckets and summed there; 2**bits numbers reach the driver."""
    part = texts.select("text").mapInArrow(lean(_count(bits)), "chunk int, counts binary")
    rows = part.repartition(max(1, (1 << bits) // CHUNK), "chunk").mapInArrow(_sum, "chunk int, counts binary").collect()  # a row a chunk
    out = np.zeros(1 << bits, np.int64)
    for r in rows:
        out[r.chunk * CHUNK :][: len(r.counts) // 8] = np.frombuffer(r.counts, np.int64)
    return out


def _score(ratio, bits: int):
    def run(batches):
        r = np.frombuffer(ratio.value, np.float64)
        for b in batches:
            w = [float(r[x].sum()) for x in _grams(b.column(1), bits)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(w, pa.float64())], names=["doc_id", "log_weight"])

    return run


def largest(rows: DataFrame, value: str, tie: str, k: int) -> tuple[float, int] | None:
    """(value, tie) of the k-th row by value descending, then tie ascending; narrowed by counts in bins, not by a sort."""
    if k <= 0:
        return None
    part, left = rows.select(value, tie), k
    while True:
        r = part.agg(F.count("*").alias("n"), F.min(value).alias("lo"), F.max(value).alias("hi")).first()
        if left > r.n:
            return float("-inf"), 2**63 - 1
        if r.n <= 20_000 or r.lo == r.hi:
            break
        width = (r.hi - r.lo) / _BINS
        bin_ = F.least(F.floor((F.col(value) - r.lo) / width), F.lit(_BINS - 1))
        for b in part.groupBy(bin_.alias("b")).count().orderBy(F.desc("b")).collect():  # _BINS rows at most
            if b["count"] >= left:
                break
            left -= b["count"]
        narrowed = part.where(bin_ == b.b)
        if b["count"] == r.n:
            break
        part = narrowed
    value_at = part.groupBy(value).count().orderBy(F.desc(value)).limit(20_000).collect()
    for row in value_at:
        if row["count"] >= left:
            break
        left -= row["count"]
    ties = part.where(F.col(value) == row[value])
    while row["count"] > 20_000:  # ties: the same by id
        q = ties.agg(F.min(tie), F.max(tie)).first()
        width = (q[1] - q[0]) // _BINS + 1
        for b in ties.groupBy(F.floor((F.col(tie) - q[0]) / width).alias("b")).count().orderBy("b").collect():
            if b["count"] >= left:
                break
            left -= b["count"]
        lo = q[0] + b.b * width
        ties, row = ties.where(F.col(tie).between(lo, lo + width - 1)), {"count": b["count"], value: row[value]}
    return row[value], ties.orderBy(tie).limit(left).agg(F.max(tie)).first()[0]


def resample(documents: DataFrame, target: DataFrame, fraction: float = FRACTION, seed: int = SEED, bits: int = BITS) -> DataFrame:
    """(doc_id, log_weight, gumbel_key, selected 0/1) of every document; round(fraction * documents) are selected.

    target: ids of the documents that stand for the target text. Null, empty and wordless texts weigh log 1. Ties go to
    smaller ids. Repeated ids: unique_documents. Without target documents all weights are log 1. Extra columns
    are not read; an empty table gives no rows.
    """
    spark = documents.sparkSession
    docs = unique_documents(documents, "text")
    wanted = target.select("doc_id").where("doc_id is not null").distinct()
    raw, aim = gram_model(docs, bits), gram_model(docs.join(maybe_broadcast(wanted), "doc_id", "left_semi"), bits)
    p_raw, p_aim = (raw + 1) / (raw.sum() + len(raw)), (aim + 1) / (aim.sum() + len(aim))
    ratio = np.log(p_aim) - np.log(p_raw) if aim.sum() else np.zeros(len(raw))
    shared = spark.sparkContext.broadcast(ratio.tobytes())  # 2**bits numbers, whatever the input
    scored = docs.mapInArrow(lean(_score(shared, bits)), "doc_id long, log_weight double")
    u = (F.shiftrightunsigned(F.xxhash64("doc_id", F.lit(seed)), 11).cast("double") + 0.5) / float(2**53)
    scored = cut(scored.withColumn("gumbel_key", F.col("log_weight") - F.log(-F.log(u))), "weights")
    at = largest(scored, "gumbel_key", "doc_id", round(fraction * scored.count()))
    if at is None:
        return scored.withColumn("selected", F.lit(0))
    chosen = (F.col("gumbel_key") > at[0]) | ((F.col("gumbel_key") == at[0]) & (F.col("doc_id") <= at[1]))
    return scored.withColumn("selected", chosen.cast("int"))


def op4_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    tune(spark)
    return resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels").where("quality = 1"))
