"""Approximate nearest neighbours: an inverted file with product-quantised residuals and exact reranking.

Fit: coarse centroids and the residuals' codebooks come from a sample of at most SAMPLE vectors (those with the smallest
id hashes), on the driver; their sizes are parameters. How many lists a query probes is measured there too: for some of the sample's vectors, each true neighbour's
list has a rank among the lists nearest to the vector; as many lists are probed as hold the share RECALL of those neighbours, and a few more. Index: every vector gets its nearest list and m code
bytes, and the distance between it and what they stand for is kept. Search: a query probes its nearest lists; a list's codes are dealt over blocks of about BLOCK codes and its
queries over blocks of QUERIES, and each pair of blocks is one group: asymmetric distances come from a table of the query's
distances to all codewords. In each group the best `rerank` codes of a query are reranked by exact distance in double precision on
the original vectors, and so is every other code that its distance less its own quantisation error does not put behind the k-th of
them; so nothing is lost within the probed lists, however many near copies share a code. A list, however large, is never in one task.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import cut, lean, table, tune

SAMPLE, BLOCK, QUERIES, RERANK, M = 20_000, 8192, 256, 400, 16
RECALL, ASKED = 0.97, 500


def _kmeans(x: np.ndarray, k: int, rounds: int = 12, seed: int = 5) -> np.ndarray:
    rng = np.random.default_rng(seed)
    c = x[rng.choice(len(x), k, replace=len(x) < k)].copy()
    for _ in range(rounds):
        at = _nearest(x, c)
        n = np.bincount(at, minlength=k)
        total = np.zeros_like(c)
        np.add.at(total, at, x)
        c[n > 0] = total[n > 0] / n[n > 0, None]
        if (n == 0).any():
            c[n == 0] = x[rng.choice(len(x), int((n == 0).sum()))]
    return c


def _nearest(x: np.ndarray, c: np.ndarray, k: int = 1) -> np.ndarray:
    out = []
    for i in range(0, len(x), 4096):
        d = (c * c).sum(1) - 2 * x[i : i + 4096] @ c.T
        out.append(d.argmin(1) if k == 1 else np.argsort(d, 1, kind="stable")[:, :k])
    return np.concatenate(out) if out else np.zeros((0,) if k == 1 else (0, k), np.int64)


class Codec:
    """Coarse centroids (lists, dim) and codebooks (m, 256, dim/m) over residuals; dim is padded with zeros."""

    def __init__(self, sample: np.ndarray, lists: int, m: int = M):
        self.dim = sample.shape[1]
        self.m = min(m, self.dim)
        self.wide = -(-self.dim // self.m) * self.m
        x = self.pad(sample)
        self.coarse = _kmeans(x, lists)
        rest = (x - self.coarse[_nearest(x, self.coarse)]).reshape(len(x), self.m, -1)
        self.books = np.stack([_kmeans(rest[:, i], min(256, len(x))) for i in range(self.m)])

    def pad(self, x: np.ndarray) -> np.ndarray:
        return np.pad(x.astype(np.float32), ((0, 0), (0, self.wide - x.shape[1])))

    def encode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(list, code, distance between the vector and what the two stand for) of each vector."""
        x = self.pad(x)
        at = _nearest(x, self.coarse)
        rest = (x - self.coarse[at]).reshape(len(x), self.m, -1)
        code = np.stack([_nearest(rest[:, i], self.books[i]) for i in range(self.m)], 1)
        miss = sum(((rest[:, i] - self.books[i][code[:, i]]) ** 2).sum(1) for i in range(self.m))
        return at, code.astype(np.uint8), np.sqrt(miss)

    def tables(self, q: np.ndarray, at: int) -> np.ndarray:
        """(queries, m, codewords): squared distances of the queries' residuals in list `at` to all codewords."""
        rest = (self.pad(q) - self.coarse[at]).reshape(len(q), self.m, 1, -1)
        return ((rest - self.books[None]) ** 2).sum(3)


def measured_probes(codec: Codec, sample: np.ndarray, k: int, recall: float = RECALL, asked: int = ASKED) -> int:
    """Lists to probe so that the share `recall` of the k nearest of `asked` vectors of the sample, among all of it, would be met."""
    x = codec.pad(sample)
    q = np.linspace(0, len(x) - 1, min(asked, len(x))).astype(np.int64)
    near = _nearest(x[q], x, min(k + 1, len(x)))
    at = _nearest(x, codec.coarse)
    order = _nearest(x[q], codec.coarse, len(codec.coarse)).reshape(len(q), -1)
    place = np.empty_like(order)
    np.put_along_axis(place, order, np.arange(order.shape[1])[None], 1)
    ranks = np.sort(np.concatenate([place[i, at[n[n != j]]] for i, (j, n) in enumerate(zip(q, near))]))
    if not len(ranks):
        return 1
    return int(min(len(codec.coarse), 1 + ranks[min(len(ranks) - 1, int(np.ceil(recall * len(ranks))))] + 1))


def _matrix(col: pa.Array, dim: int) -> np.ndarray:
    return col.combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, dim) if isinstance(col, pa.ChunkedArray) else col.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def _encode(codec, probes: int):
    """Rows (list, vec_id, code, miss, v): the last three null for a query, once for each list that it probes."""

    def run(batches):
        c = codec.value
        for b in batches:
            x = _matrix(b.column("v"), c.dim)
            ids, ask = b.column("vec_id"), b.column("ask").to_numpy(zero_copy_only=False)
            at, code, miss = c.encode(x)
            names = ["list", "vec_id", "code", "miss", "v"]
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), ids, pa.array([r.tobytes() for r in code], pa.binary()), pa.array(miss, pa.float32()), b.column("v")], names=names)
            who = np.flatnonzero(ask)
            if len(who):
                near = _nearest(c.pad(x[who]), c.coarse, min(probes, len(c.coarse))).reshape(len(who), -1)
                qid = np.repeat(ids.to_numpy()[who], near.shape[1])
                yield pa.RecordBatch.from_arrays([pa.array(near.ravel(), pa.int32()), pa.array(qid), pa.nulls(len(qid), pa.binary()), pa.nulls(len(qid), pa.float32()), pa.nulls(len(qid), b.column("v").type)], names=names)

    return run


def _scan(codec, k: int, rerank: int):
    """(query_id, vec_id, score): the k nearest of the group's vectors to each of its queries, by exact distance."""

    def run(t: pa.Table) -> pa.Table:
        c = codec.value
        isq = t.column("code").is_null().to_numpy()
        none = pa.table({"query_id": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
        q, v = t.filter(pa.array(isq)), t.filter(pa.array(~isq))
        if not len(q) or not len(v):
            return none
        ids = v.column("vec_id").to_numpy()
        code = np.frombuffer(b"".join(v.column("code").to_pylist()), np.uint8).reshape(-1, c.m)
        miss, x = v.column("miss").to_numpy(), _matrix(v.column("v"), c.dim)
        qid, qv = q.column("vec_id").to_numpy(), _matrix(q.column("v"), c.dim)
        first = min(max(rerank, k) + 1, len(ids))  # one more, as the query itself may be among them
        out = []
        for i in range(0, len(qid), 32):
            tab = c.tables(qv[i : i + 32], t.column("list")[0].as_py())
            d = np.sqrt(sum(tab[:, s, code[:, s]] for s in range(c.m)))
            for j, near in enumerate(d):
                y = qv[i + j]
                exact = lambda at: np.sqrt(((x[at] - y) ** 2).sum(1))
                at = np.argpartition(near, first - 1)[:first]
                at = at[ids[at] != qid[i + j]]
                score = exact(at)
                if first < len(ids):
                    last = np.partition(score, k - 1)[k - 1]
                    slack = 1e-5 * (near + miss + np.sqrt((y * y).sum()))  # near and miss are in single precision
                    more = ~(near - miss - slack > last) & (ids != qid[i + j])
                    more[at] = False
                    more = np.flatnonzero(more)
                    at, score = np.concatenate([at, more]), np.concatenate([score, exact(more)])
                best = np.lexsort((ids[at], score))[:k]
                out.append((np.full(len(best), qid[i + j]), ids[at[best]], score[best]))
        a, b, d = (np.concatenate(x) for x in zip(*out))
        return pa.table({"query_id": a, "vec_id": b, "score": d})

    return run


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, v array<double>) of the rows that take part: an id, no null or non-finite component, not zero, and as
    many components as most such rows have. Of a repeated id the smallest vector takes part."""
    v = F.col("embedding").cast("array<double>")
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    rows = vectors.select("vec_id", v.alias("v")).where("vec_id is not null and v is not null").where(F.coalesce(fine, F.lit(False)))
    dim = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    rows = rows.where(F.size("v") == (dim.d if dim else 0))
    if rows.select("vec_id").groupBy("vec_id").count().where("count > 1").limit(1).count():
        rows = rows.groupBy("vec_id").agg(F.min("v").alias("v"))
    return rows


def search(vectors: DataFrame, is_query, k: int = 10, lists: int | None = None, probes: int | None = None, m: int = M, rerank: int = RERANK) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found to each row for which the condition is_query holds.

    lists: half the root of the number of vectors, at most 1,024, unless given; probes: measured_probes, unless given. `rerank` is how many codes of a query and block are compared exactly at once, before the error bound decides on the others.
    A query is never its own neighbour; ties go to smaller ids. Rows that `usable` refuses neither ask nor answer. An empty table gives no
    rows; extra columns are not read.
    """
    spark = vectors.sparkSession
    rows = cut(usable(vectors), "vectors")
    n = rows.count()
    if n < 2:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    lists = lists or int(max(1, min(1024, n**0.5 / 2)))
    sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).select("v").collect()
    sample = np.array([r.v for r in sample], np.float64)
    codec = Codec(sample, lists, m)
    probes = probes or measured_probes(codec, sample, k)
    shared = spark.sparkContext.broadcast(codec)  # at most 1024 centroids and m*256 codewords
    queries = rows.where(is_query).select("vec_id", "v")
    index = cut(rows.withColumn("ask", is_query).mapInArrow(lean(_encode(shared, probes)), "list int, vec_id long, code binary, miss float, v array<double>"), "index")
    size = index.groupBy("list").agg(F.ceil(F.count("code") / BLOCK).cast("int").alias("blocks"), F.ceil(F.sum(F.col("code").isNull().cast("int")) / QUERIES).cast("int").alias("turns"))
    size = F.broadcast(cut(size.where("blocks > 0 and turns > 0"), "lists"))  # a row a list
    codes = index.where("code is not null").join(size, "list").select("list", F.pmod(F.xxhash64("vec_id"), F.col("blocks")).cast("int").alias("block"), F.explode(F.sequence(F.lit(0), F.col("turns") - 1)).alias("turn"), "vec_id", "code", "miss", "v")
    asks = index.where("code is null").drop("v").join(size, "list").join(queries, "vec_id").select("list", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), F.pmod(F.xxhash64("vec_id"), F.col("turns")).cast("int").alias("turn"), "vec_id", F.lit(None).cast("binary").alias("code"), F.lit(None).cast("float").alias("miss"), "v")
    found = codes.union(asks).groupBy("list", "block", "turn").applyInArrow(_scan(shared, k, rerank), "query_id long, vec_id long, score double")
    best = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op5_ivfpq(spark: SparkSession, sf_dir: str) -> DataFrame:
    tune(spark)
    return search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)
