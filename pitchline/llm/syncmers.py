"""Document fingerprints of closed syncmers with their positions, with DataFrame and SQL functions alone.

Units are a text's words. A k-mer is K consecutive words; it is a closed syncmer if the smallest hash among the runs of S
words within it is that of its first or its last run. Whether a k-mer is chosen depends on the k-mer alone, so equal
stretches of two texts carry the same anchors wherever they stand. An anchor is its k-mer's hash together with its distance, in
words, from the anchor before it: two texts match at an anchor if both k-mer and place after the last anchor agree, so a match says that a
stretch is the same in both, and not only that a k-mer occurs in both. A fingerprint has all of a text's distinct anchors in the order of
the text and grows with it; every text is treated alike, whatever its length (fewer words than K, or no chosen k-mer: the whole sequence is the one
anchor). Likeness is the Jaccard index of two texts' anchors.

Texts are shuffled once. Documents are dealt over groups of neighbouring ids, at most GROUP ids a group, and each group also gets the
document that follows its last one; so the next document's text and fingerprint are in the same group, sorted, one row on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import cut, maybe_broadcast, position, table, unique_documents

K, S, GROUP = 3, 1, 256
_SPACE = "\x20\t\n\x0b\x0c\r"
_GAP = r"[\x20\x09-\x0D]+"


def _window_hashes(x: Column, n: int) -> Column:
    """Hash of each run of n consecutive hashes of the array x, which holds n or more."""
    starts = F.sequence(F.lit(0), F.size(x) - n)
    return F.transform(starts, lambda i: F.xxhash64(*[F.get(x, i + j) for j in range(n)]))


def _places(h: Column, runs: Column, k: int, s: int) -> Column:
    """Where closed syncmers begin (from 0), of word hashes h and the hashes of their runs of s words; a tie counts as smallest."""

    def chosen(i):
        inner = [F.get(runs, i + j) for j in range(k - s + 1)]
        return F.least(inner[0], inner[-1]) <= F.least(*inner)

    return F.filter(F.sequence(F.lit(0), F.size(h) - k), chosen)


def with_anchors(df: DataFrame, text: str, name: str, k: int = K, s: int = S) -> DataFrame:
    """Adds name_at and name_hash, arrays of the same size: each anchor's first word (from 0) and its hash with its distance.

    Null where text is null, empty without words. Each intermediate array is a column of a projection of its own, so none is made twice.
    """
    bare = F.btrim(F.col(text), F.lit(_SPACE))
    df = df.withColumn("_u", F.when(bare == "", F.array().cast("array<bigint>")).otherwise(F.transform(F.split(bare, _GAP), lambda w: F.xxhash64(w))))
    df = df.withColumn("_s", F.when(F.size("_u") >= k, _window_hashes(F.col("_u"), s)))
    df = df.withColumn("_p", F.when(F.size("_u") >= k, _places(F.col("_u"), F.col("_s"), k, s)).otherwise(F.array().cast("array<int>")))
    h, p = F.col("_u"), F.col("_p")
    before = F.concat(F.slice(p, 1, 1), F.slice(p, 1, F.greatest(F.size(p) - 1, F.lit(0))))
    hashes = F.zip_with(p, before, lambda i, j: F.xxhash64(*[F.get(h, i + q) for q in range(k)], i - j))
    some, words = F.size(p) > 0, F.size(h) > 0
    at = F.when(h.isNull(), None).when(some, p).when(words, F.array(F.lit(0))).otherwise(F.array().cast("array<int>"))
    hash_ = F.when(h.isNull(), None).when(some, hashes).when(words, F.array(F.xxhash64(h))).otherwise(F.array().cast("array<bigint>"))
    return df.withColumns({f"{name}_at": at, f"{name}_hash": hash_}).drop("_u", "_s", "_p")


def fingerprint_expr(distinct: Column) -> Column:
    """Distinct anchor hashes as text, 16 hexadecimal digits each."""
    return F.lower(F.array_join(F.transform(distinct, lambda x: F.lpad(F.hex(x), 16, "0")), ""))


def likeness(a: Column, b: Column) -> Column:
    """Jaccard index of two arrays of distinct hashes: 1 for equal texts, among them two without words."""
    inside = F.size(F.array_intersect(a, b))
    both = F.size(a) + F.size(b) - inside
    return F.when(both == 0, 1.0).otherwise(inside / F.greatest(both, F.lit(1)))


def anchors(documents: DataFrame, k: int = K, s: int = S) -> DataFrame:
    """(doc_id, anchors array<struct<at, hash>>): the anchors that fingerprints are made of, repeated ones too."""
    docs = unique_documents(documents, "text").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return with_anchors(docs, "text", "x", k, s).select("doc_id", F.arrays_zip(F.col("x_at").alias("at"), F.col("x_hash").alias("hash")).alias("anchors"))


def _shift(ids: DataFrame, most: int = GROUP) -> int:
    """How many low bits of an id may go so that no group of ids that share the rest has over `most` of them."""
    span = ids.agg(F.count("*").alias("n"), F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).first()
    if not span.n:
        return 0
    fits = lambda s: not ids.groupBy(F.shiftright("doc_id", s)).count().where(F.col("count") > most).limit(1).count()
    low = most.bit_length() - 1  # 2**low ids are not too many
    high = min(62, ((span.hi - span.lo + 1) * most // span.n).bit_length() - 1)  # the choice for evenly spread ids
    if high > low and not fits(high):
        high -= 1
        while low < high:  # ids in clumps: a search of the bits
            s = (low + high + 1) // 2
            low, high = (s, high) if fits(s) else (low, s - 1)
    return high


def neighbours(docs: DataFrame) -> DataFrame:
    """(group, ghost, doc_id, text): each document in its group and, as a ghost, at the end of the group before (cyclic)
    if it is its group's first."""
    ids = docs.select("doc_id")
    group = F.shiftright("doc_id", _shift(ids)).alias("group")
    firsts = ids.groupBy(group).agg(F.min("doc_id").alias("doc_id"))
    at = position(firsts, "group")  # a row a group
    n = at.count()
    before = at.select(F.pmod(F.col("position") + 1, F.lit(max(n, 1))).alias("position"), F.col("group").alias("before"))
    ghosts = cut(at.join(before, "position").select("doc_id", F.col("before").alias("group")), "ghosts")
    own = docs.select(group, F.lit(False).alias("ghost"), "doc_id", "text")
    return own.union(docs.join(maybe_broadcast(ghosts), "doc_id").select("group", F.lit(True).alias("ghost"), "doc_id", "text"))


def fingerprints(documents: DataFrame) -> DataFrame:
    """See op9's contract: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    A null text is empty; a text without words has an empty fingerprint. The only document is its own successor. Repeated
    ids: unique_documents. Equal (also neighbouring) texts have equal fingerprints and likeness 1. An empty table gives no rows; extra columns are not read.
    """
    docs = unique_documents(documents, "text").select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    along = Window.partitionBy("group").orderBy("ghost", "doc_id")
    rows = neighbours(docs).withColumn("after", F.lead("text").over(along))  # null for ghosts alone
    rows = rows.withColumn("n", F.length("text")).withColumn("q", F.floor(F.col("n") / 4).cast("int"))
    rows = rows.withColumn("edited", F.when(~F.col("ghost"), F.concat(F.expr("left(text, n - q)"), F.expr("left(after, q)"))))
    rows = rows.select("group", "ghost", "doc_id", "n", "text", "edited", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"))
    for text, name in (("text", "a"), ("edited", "b")):
        rows = with_anchors(rows, text, name).withColumn(name, F.array_distinct(f"{name}_hash")).drop(text, f"{name}_at", f"{name}_hash")
    a, b = F.col("a"), F.col("b")
    rows = rows.select("group", "ghost", "doc_id", "n", "edited_sha256", "a", fingerprint_expr(a).alias("fingerprint"), fingerprint_expr(b).alias("edited_fingerprint"), likeness(a, b).alias("near_edited"))
    rows = rows.withColumn("next", F.lead("a").over(along)).where(~F.col("ghost"))
    return rows.select("doc_id", F.col("n").cast("long").alias("n_chars"), "edited_sha256", "fingerprint", "edited_fingerprint", F.col("near_edited").cast("double").alias("near_edited"), likeness(a, F.col("next")).cast("double").alias("near_next"))


def op9_syncmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(table(spark, sf_dir, "documents"))
