"""Line dedup by distinct-site spread.

A line's key is a 128-bit digest of its trimmed text. The lines of all texts are written once as narrow rows (document, place, key, site).
One aggregation over those rows by key, combined in each task before the shuffle, builds a HyperLogLog sketch of the key's sites and finds
its first place. Keys whose estimate lies above the sketch's error band around the threshold are decided by it; those
within the band get an exact distinct count of their sites; the others, by far the most, are done with.
Lines on at least `sites` sites are boilerplate: they stay in the document with the smallest id that holds them,
at their first place there, and go everywhere else.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, maybe_broadcast, table, unique_documents

_SPACE = "\x20\t\n\x0b\x0c\r"


def _bare(line: Column) -> Column:
    return F.btrim(line, F.lit(_SPACE))


def _lines(docs: DataFrame, least_words: int) -> DataFrame:
    """(doc_id, source, at, hi, lo): a row for each line of at least least_words words (1 at least)."""
    rows = docs.select("doc_id", "source", F.posexplode(F.split("text", "\n")).alias("at", "line")).withColumn("line", _bare(F.col("line")))
    rows = rows.where("line <> ''")
    if least_words > 1:
        rows = rows.where(F.regexp_count("line", F.lit(r"[\x20\x09-\x0D]+")) + 1 >= least_words)
    return rows.select("doc_id", "source", "at", F.xxhash64("line").alias("hi"), F.xxhash64(F.lit("lo"), "line").alias("lo"))


def band(sites: int, lg: int) -> float:
    """How far an estimate near `sites` may be off: four standard errors of a sketch of 2**lg registers, and one colliding pair."""
    return max(1.0, 4 * 1.04 / 2 ** (lg / 2) * sites)


def spread(lines: DataFrame, sites: int, lg: int = 8) -> DataFrame:
    """(hi, lo, first_doc, first_at) of the lines on at least `sites` distinct sites (null is none).

    lines: a table that reads the same each time (see cut).
    """
    wide = band(sites, lg)
    keys = lines.groupBy("hi", "lo").agg(F.hll_sketch_agg("source", F.lit(lg)).alias("sketch"), F.min(F.struct("doc_id", "at")).alias("first"))
    keys = keys.select("hi", "lo", F.hll_sketch_estimate("sketch").alias("estimate"), F.col("first.doc_id").alias("first_doc"), F.col("first.at").alias("first_at"))
    keys = cut(keys.where(F.col("estimate") >= sites - wide), "estimates")
    near = keys.where(F.col("estimate") <= sites + wide).select("hi", "lo")
    exact = lines.where("source is not null").join(maybe_broadcast(near), ["hi", "lo"])
    exact = exact.groupBy("hi", "lo", "source").agg(F.count("*").alias("n")).groupBy("hi", "lo").agg(F.count("*").alias("k")).where(F.col("k") >= sites)
    chosen = keys.where(F.col("estimate") > sites + wide).select("hi", "lo").union(exact.select("hi", "lo"))
    return cut(keys.drop("estimate").join(chosen, ["hi", "lo"]), "boilerplate")


def dedup_lines(documents: DataFrame, sites: int = 3, carry: tuple[str, ...] = (), least_words: int = 1, lg: int = 8) -> DataFrame:
    """Adds clean_text, n_lines and n_removed to (doc_id, text, source, *carry).

    n_lines counts lines with text. A line of fewer than least_words words is never boilerplate. A null text stays null, without lines; documents
    are never dropped here. Lines repeated within their first document go too. Ties for the first document can't be, ids being unique. Repeated ids:
    unique_documents. Very long texts and lines are worked on in linear time. An empty table gives no rows. Extra columns are not read; carried ones may
    have any name but those of the result.
    """
    docs = unique_documents(documents, "text", "source", *carry)
    docs = docs.select("doc_id", "text", "source", F.struct(F.lit(0).alias("_"), *[F.col(f"`{c}`") for c in carry]).alias("carried"))
    lines = cut(_lines(docs, least_words), "lines")
    gone = spread(lines, sites, lg)
    out = lines.join(maybe_broadcast(gone), ["hi", "lo"]).where(~((F.col("doc_id") == F.col("first_doc")) & (F.col("at") == F.col("first_at"))))
    out = cut(out.groupBy("doc_id").agg(F.collect_list("at").alias("out")), "removed")  # a list is never longer than its text
    joined = docs.join(out.hint("merge"), "doc_id", "left").withColumn("all", F.split("text", "\n"))  # by shuffle at every size: the lists grow with the texts
    kept = F.array_except(F.sequence(F.lit(0), F.size("all") - 1), "out")
    clean = F.when(F.col("out").isNull(), F.col("text")).otherwise(F.array_join(F.transform(kept, lambda i: F.get("all", i)), "\n"))
    size = lambda c: F.greatest(F.coalesce(F.size(c), F.lit(0)), F.lit(0)).cast("long")
    joined = joined.select("doc_id", "text", "source", "carried", clean.alias("clean_text"), size(F.filter("all", lambda x: _bare(x) != "")).alias("n_lines"), size(F.col("out")).alias("n_removed"))
    return joined.select("doc_id", "text", "source", *[F.col(f"carried.`{c}`") for c in carry], "clean_text", "n_lines", "n_removed")


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = dedup_lines(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("clean_text", F.lit("")).cast("binary"), 256).alias("clean_sha256"))


OP10_SQL = r"""
WITH l AS (
  SELECT doc_id, source, unnest(string_split(text, chr(10))) AS raw, generate_subscripts(string_split(text, chr(10)), 1) AS pos
  FROM documents WHERE text IS NOT NULL),
k AS (SELECT *, regexp_replace(regexp_replace(raw, '^[\x20\x09-\x0D]+', ''), '[\x20\x09-\x0D]+$', '') AS line FROM l),
b AS (SELECT line, min({'d': doc_id, 'a': pos}) AS fst FROM k WHERE line <> '' GROUP BY line HAVING count(DISTINCT source) >= 3),
m AS (SELECT k.doc_id, k.pos, k.raw, k.line, b.line IS NOT NULL AND (k.doc_id <> b.fst.d OR k.pos <> b.fst.a) AS gone FROM k LEFT JOIN b USING (line)),
t AS (SELECT doc_id, count(*) FILTER (WHERE line <> '') AS n_lines, count(*) FILTER (WHERE gone) AS n_removed,
             coalesce(string_agg(raw, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '') AS clean FROM m GROUP BY doc_id)
SELECT d.doc_id, coalesce(t.n_lines, 0) AS n_lines, coalesce(t.n_removed, 0) AS n_removed, sha256(coalesce(t.clean, '')) AS clean_sha256
FROM documents d LEFT JOIN t USING (doc_id)
"""
