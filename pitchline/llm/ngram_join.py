"""N-gram Jaccard join by a token-group matrix.

Documents are sets of distinct k-word shingles. Two link when den * |A ∩ B| >= num * |A ∪ B|.

1. Equal sets fold into one representative (smallest doc_id) by a 128-bit digest and the set's size.
2. Similar representatives are partitioned into groups: blocks that share a minhash are checked exactly,
   and the verified links' connected components are the groups. A block holds at most about BLOCK_DOCS sets or
   BLOCK_TOKENS tokens; larger ones are split by hash, each part with the block's hub.
3. The matrix: for each token, which groups' unions hold it. Only tokens that can decide a link enter:
   with one order of all tokens for all sets, two linked sets share at least r of their first
   n - ceil(num*n/den) + r tokens. The order puts common tokens last (counts of all tokens of all documents in
   2**bits counters; a shared counter changes only the order and never the result), then goes by hash.
   Tokens of one document alone go before the matrix is joined; a very common token's rows are dealt over
   tasks by document without looking for company (kept needlessly, a token only loosens a bound), and its queries meet its groups in parts.
4. A query meets the groups other than its own. Its tokens in a group's union, those before them that any other
   document shares and what follows them in the common order bound its overlap with any member, which must reach num/(num+den) of both sizes together; the group's
   smallest and largest sets bound the sizes. Only groups that pass are opened, in blocks again, and each pair's
   exact Jaccard is computed. No link between different sets is lost: two linked sets in different groups pass.
5. Components over the links of both steps give each document's class.

The counters are the only broadcast of fixed size (2**bits bytes); membership tables are broadcast only below a
counted number of rows and shuffled beyond it.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import U, as_long, cut, lean, maybe_broadcast, mix, shingles, table, tune, unique_documents
from .graph import components

BLOCK_DOCS, BLOCK_TOKENS, LEAST = 48, 60_000, 2
HOT = 14  # a token's class is the bit length of its counter; from this one on its rows are dealt over tasks
CHUNK, SHARES = 1 << 12, 64
_SETS = "doc_id long, n long, h1 long, h2 long, k1 long, k2 long, chunk int, counts binary"


def _summaries(k: int, bits: int):
    """Rows of sets (digest, size, two minhashes) and, at the end of the partition, of its token counts."""

    def run(batches):
        counts = np.zeros(1 << bits, np.uint32)
        held, n_held = [], 0

        def count():
            np.add.at(counts, np.concatenate(held) >> U(64 - bits), np.uint32(1))
            held.clear()

        for b in batches:
            rows = []
            for doc, x in zip(b.column(0).to_pylist(), shingles(b.column(1), k)):
                if len(x):
                    y = mix(x ^ U(0x51ED270B))
                    rows.append((doc, len(x), int(as_long(x.sum(keepdims=True))[0]), int(as_long(y.sum(keepdims=True))[0]), int(as_long(y.min(keepdims=True))[0]), int(as_long(mix(x ^ U(0xC0FFEE)).min(keepdims=True))[0])))
                else:
                    rows.append((doc, 0, 0, 0, 0, 0))
                held.append(x)
                n_held += len(x)
                if n_held > 500_000:
                    count()
                    n_held = 0
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)] + [pa.nulls(len(rows), pa.int32()), pa.nulls(len(rows), pa.binary())], names=["doc_id", "n", "h1", "h2", "k1", "k2", "chunk", "counts"])
        if held:
            count()
        if counts.any():
            parts = np.minimum(counts, 65535).astype("<u2").reshape(-1, min(CHUNK, 1 << bits))
            for i in range(0, len(parts), 256):
                p = parts[i : i + 256]
                none = pa.nulls(len(p), pa.int64())
                yield pa.RecordBatch.from_arrays([none] * 6 + [pa.array(range(i, i + len(p)), pa.int32()), pa.array([x.tobytes() for x in p], pa.binary())], names=["doc_id", "n", "h1", "h2", "k1", "k2", "chunk", "counts"])

    return run


def _merge_counts(batches):
    """Streams the partial counts of some chunks; memory is one array for each chunk of this partition."""
    total: dict[int, np.ndarray] = {}
    for b in batches:
        for c, x in zip(b.column(0).to_pylist(), b.column(1)):
            x = np.frombuffer(x.as_buffer(), "<u2")
            if c in total:
                total[c] += x
            else:
                total[c] = x.astype(np.int64)
    if total:
        yield pa.RecordBatch.from_arrays([pa.array(total, pa.int32()), pa.array([np.frexp(x.astype(float))[1].astype(np.uint8).tobytes() for x in total.values()], pa.binary())], names=["chunk", "classes"])


def _prefixes(k: int, bits: int, num: int, den: int, classes):
    """The first tokens of each set in the common order, as rows (token, doc_id, n, pos), pos from 1."""

    def run(batches):
        cls = np.frombuffer(classes.value, np.uint8)
        for b in batches:
            toks, ids, ns = [], [], []
            for doc, x in zip(b.column(0).to_pylist(), shingles(b.column(1), k)):
                if n := len(x):
                    need = -(-num * n // den)
                    p = n - need + min(LEAST, need)
                    key = (cls[(x >> U(64 - bits)).astype(np.int64)].astype(np.uint64) << U(57)) | (mix(x) >> U(7))
                    toks.append(np.sort(np.partition(key, p - 1)[:p] if p < n else key))
                    ids.append(doc)
                    ns.append((p, n))
            if toks:
                rep = [p for p, _ in ns]
                yield pa.RecordBatch.from_arrays([pa.array(as_long(np.concatenate(toks))), pa.array(np.repeat(np.array(ids, np.int64), rep)), pa.array(np.repeat(np.array([n for _, n in ns], np.int64), rep)), pa.array(np.concatenate([np.arange(1, p + 1) for p in rep]))], names=["token", "doc_id", "n", "pos"])

    return run


def _shared_only(hot: int):
    """Of rows sorted by token, those whose token has more than one row or a class from `hot` on. State: one row."""

    def run(batches):
        last, held = None, False
        for b in batches:
            t = pa.Table.from_batches([b] if last is None else [last, b]).combine_chunks()
            x = t.column("token").to_numpy()
            if not len(x):
                continue
            same = x[1:] == x[:-1]
            keep = (x >> 57) >= hot
            keep[1:] |= same
            keep[:-1] |= same
            kept = bool(keep[-1]) or (held and len(x) == 1)
            if last is not None:
                keep[0] &= not held
            held, last = kept, t.slice(len(x) - 1, 1).to_batches()[0]
            yield from t.filter(pa.array(keep)).to_batches()

    return run


def _verify(num: int, den: int):
    """Exact Jaccard of all pairs within a block, as edges to each part's smallest member."""

    def run(t: pa.Table) -> pa.Table:
        ids = t.column("doc_id").to_numpy()
        order = np.argsort(ids, kind="stable")
        order = order[np.concatenate([[True], ids[order][1:] != ids[order][:-1]])]
        ids = ids[order]
        col = t.column("toks")
        sets = [np.frombuffer(col[int(i)].as_buffer(), np.uint64) for i in order]
        n = np.array([len(x) for x in sets], np.int64)
        tok, inv = np.unique(np.concatenate(sets), return_inverse=True)
        owner = np.repeat(np.arange(len(sets)), n)
        more = np.bincount(inv) > 1
        col_of = np.cumsum(more) - 1
        pick = more[inv]
        root = np.arange(len(sets))
        inter = np.zeros((len(sets), len(sets)), np.float32)
        r, c = owner[pick], col_of[inv[pick]]
        wide = 1 << 16
        at = np.argsort(c, kind="stable")
        r, c = r[at], c[at]
        for lo in range(0, int(more.sum()), wide):
            i, j = np.searchsorted(c, (lo, lo + wide))
            m = np.zeros((len(sets), min(wide, int(more.sum()) - lo)), np.float32)
            m[r[i:j], c[i:j] - lo] = 1
            inter += m @ m.T
        inter = inter.astype(np.int64)
        link = inter * den >= num * (n[:, None] + n[None, :] - inter)
        us, vs = [], []
        for i in range(len(sets)):
            if root[i] == i:  # a part not seen yet: walk it
                todo, seen = [i], {i}
                while todo:
                    for j in np.flatnonzero(link[todo.pop()]):
                        if j not in seen:
                            seen.add(int(j))
                            todo.append(int(j))
                for j in seen - {i}:
                    root[j] = i
                    us.append(ids[j])
                    vs.append(ids[i])
        return pa.table({"u": pa.array(us, pa.int64()), "v": pa.array(vs, pa.int64())})

    return run


def _tokens(k: int):
    def run(batches):
        for b in batches:
            for doc, blocks, x in zip(b.column(0).to_pylist(), b.column(2).to_pylist(), shingles(b.column(1), k)):
                for i in range(0, len(blocks), 64):
                    part = blocks[i : i + 64]
                    yield pa.RecordBatch.from_arrays([pa.array(part, pa.int64()), pa.array([doc] * len(part), pa.int64()), pa.array([x.tobytes()] * len(part), pa.binary())], names=["block", "doc_id", "toks"])

    return run


def _links(docs: DataFrame, members: DataFrame, k: int, num: int, den: int) -> DataFrame:
    """Verified links (u, v) within each block of members (block, doc_id)."""
    per_doc = cut(members.groupBy("doc_id").agg(F.collect_set("block").alias("blocks")), "members")
    rows = docs.join(maybe_broadcast(per_doc), "doc_id").select("doc_id", "text", "blocks").mapInArrow(lean(_tokens(k)), "block long, doc_id long, toks binary")
    return rows.groupBy("block").applyInArrow(_verify(num, den), "u long, v long")


def jaccard_classes(documents: DataFrame, k: int = 5, num: int = 80, den: int = 100, bits: int = 22) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every document; see the module's text.

    Null or empty texts and texts without words have no shingles, link with nothing and are their own component.
    Repeated ids: unique_documents. Extra columns are not read. An empty table gives no rows.
    """
    spark = documents.sparkSession
    docs = unique_documents(documents, "text")
    found = cut(docs.mapInArrow(lean(_summaries(k, bits)), _SETS), "sets")
    sets = found.where("chunk is null").select("doc_id", "n", "h1", "h2", "k1", "k2")
    merged = found.where("chunk is not null").select("chunk", "counts").repartition(64, "chunk").mapInArrow(lean(_merge_counts), "chunk int, classes binary").collect()
    classes = np.zeros(1 << bits, np.uint8)  # fixed size: one byte a counter
    for r in merged:
        classes[r.chunk * CHUNK :][: len(r.classes)] = np.frombuffer(r.classes, np.uint8)
    shared = spark.sparkContext.broadcast(classes.tobytes())

    reps = cut(sets.where("n > 0").groupBy("n", "h1", "h2").agg(F.min("doc_id").alias("rep"), F.first("k1").alias("k1"), F.first("k2").alias("k2")), "reps")
    posting = docs.mapInArrow(lean(_prefixes(k, bits, num, den, shared)), "token long, doc_id long, n long, pos long")
    # a token far more common than a counter's usual load is shared for certain enough: its rows are dealt over tasks
    hot = max(HOT, int(np.median(classes)) + 3)
    shares = F.expr(f"shiftleft(1L, greatest(0, cast(shiftrightunsigned(token, 57) as int) - {hot - 1}))")
    deal = F.pmod(F.xxhash64("doc_id"), shares)
    posting = cut(posting.repartition("token", deal).sortWithinPartitions("token").mapInArrow(_shared_only(hot), "token long, doc_id long, n long, pos long"), "postings")

    # groups: verified links within blocks that share a minhash
    keys = reps.select("rep", "n", F.explode(F.array(F.xxhash64(F.lit(1), "k1"), F.xxhash64(F.lit(2), "k2"))).alias("key"))
    hubs = cut(keys.groupBy("key").agg(F.count("*").alias("c"), F.sum("n").alias("total"), F.min("rep").alias("hub")).where("c > 1"), "hubs")
    parts = F.least(F.ceil(F.greatest(F.col("c") / BLOCK_DOCS, F.col("total") / BLOCK_TOKENS)), F.col("c") - 1).cast("int")
    members = keys.join(hubs, "key").withColumn("parts", parts)
    members = members.select(F.col("rep").alias("doc_id"), "key", F.explode(F.when(F.col("rep") == F.col("hub"), F.sequence(F.lit(0), F.col("parts") - 1)).otherwise(F.array(F.pmod(F.xxhash64("rep"), F.col("parts")).cast("int")))).alias("part"))
    first = cut(_links(docs, members.select(F.xxhash64("key", "part").alias("block"), "doc_id"), k, num, den), "links")
    group = cut(reps.select(F.col("rep").alias("id"), "n").join(components(first), "id", "left").select("id", "n", F.coalesce("component", "id").alias("g")), "groups")

    # the matrix of tokens and groups, and the groups that a query must open
    sized = cut(group.groupBy("g").agg(F.count("*").alias("size"), F.min("n").alias("low"), F.max("n").alias("high"), F.sum("n").alias("total")), "sized")
    mine = group.join(sized, "g")
    rows = cut(posting.join(mine.withColumnRenamed("id", "doc_id").drop("n"), "doc_id").withColumn("k", F.row_number().over(Window.partitionBy("doc_id").orderBy("token"))), "matrix")
    rest = F.max(F.col("n") - F.col("pos")).alias("rest")  # of any member, the tokens after this one
    upto = F.max("k").alias("k2")  # of any member, its tokens so far that some other document shares
    union = rows.groupBy("token", "g").agg(upto, F.first("size").alias("s2"), F.first("low").alias("low2"), F.first("high").alias("high2"), rest).withColumnRenamed("g", "g2")
    ask = rows.select("token", "doc_id", "n", "pos", "k", "g", "size")
    lowest = F.greatest(F.col("low2"), F.ceil(F.col("n") * num / den))  # the smallest set that can link
    enough = lambda bound: bound * (num + den) >= (F.col("n") + lowest) * num
    able = enough(F.least("k", "k2") + F.least(F.col("n") - F.col("pos"), F.col("rest")))
    smaller = (F.col("size") < F.col("s2")) | ((F.col("size") == F.col("s2")) & (F.col("g") < F.col("g2")))
    fits = (F.col("n") * den >= F.col("low2") * num) & (F.col("high2") * den >= F.col("n") * num)
    least = F.least(F.lit(LEAST), F.ceil(F.col("n") * num / den), F.ceil(F.col("low2") * num / den))
    # a common token's queries meet its groups in SHARES parts at most, each with all of the token's groups
    parts = F.least(shares, F.lit(SHARES).cast("long"))
    ask = ask.withColumn("share", F.pmod(F.xxhash64("doc_id"), parts))
    union = union.withColumn("share", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1)))
    met = ask.join(union, ["token", "share"]).where(smaller & fits & able).groupBy("doc_id", "n", "g2", "s2", "low2")
    met = met.agg(F.count("*").alias("overlap"), F.min("pos").alias("i"), F.max("pos").alias("j"), F.min("rest").alias("after"), F.max("rest").alias("most"))
    # the overlap with a set alone is what is met and what can follow the last; with a member of several, what can follow the first
    bound = F.when(F.col("s2") == 1, F.col("overlap") + F.least(F.col("n") - F.col("j"), F.col("after"))).otherwise(1 + F.least(F.col("n") - F.col("i"), F.col("most")))
    opened = cut(met.where((F.col("overlap") >= least) & enough(bound)).select("doc_id", "g2"), "opened")

    hosts = cut(opened.groupBy("g2").agg(F.count("*").alias("asks")).join(sized.withColumnRenamed("g", "g2"), "g2").select("g2", F.least(F.ceil(F.greatest(F.col("size") / BLOCK_DOCS, F.col("total") / BLOCK_TOKENS)), F.col("size")).cast("int").alias("chunks"), F.ceil(F.col("asks") / BLOCK_DOCS).cast("int").alias("turns")), "hosts")
    queries = opened.join(hosts, "g2").select("g2", "doc_id", F.pmod(F.xxhash64("doc_id"), F.col("turns")).cast("int").alias("turn"), F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"))
    held = group.withColumnRenamed("g", "g2").join(hosts, "g2").select("g2", F.col("id").alias("doc_id"), F.explode(F.sequence(F.lit(0), F.col("turns") - 1)).alias("turn"), F.pmod(F.xxhash64("id"), F.col("chunks")).cast("int").alias("chunk"))
    blocks = queries.select("g2", "turn", "chunk", "doc_id").union(held.select("g2", "turn", "chunk", "doc_id"))
    second = cut(_links(docs, blocks.select(F.xxhash64("g2", "turn", "chunk").alias("block"), "doc_id"), k, num, den), "links")

    comp = cut(components(first.union(second)), "components")
    classes_of = cut(reps.join(comp.withColumnRenamed("id", "rep"), "rep", "left").select("n", "h1", "h2", F.coalesce("component", "rep").alias("component_id")), "classes")
    return sets.join(classes_of, ["n", "h1", "h2"], "left").select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    tune(spark)
    return jaccard_classes(table(spark, sf_dir, "documents"), k=4, num=85, den=100)


OP1_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents WHERE text IS NOT NULL),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 4 THEN list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
e AS (SELECT p.a, p.b FROM p JOIN n x ON x.doc_id = p.a JOIN n y ON y.doc_id = p.b WHERE 100 * k >= 85 * (x.n + y.n - k)),
u AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
r AS (SELECT doc_id, doc_id AS c FROM documents UNION SELECT r.doc_id, u.b FROM r JOIN u ON u.a = r.c)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, (SELECT min(c) FROM r WHERE r.doc_id = d.doc_id) AS component_id
FROM documents d LEFT JOIN n USING (doc_id)
"""
