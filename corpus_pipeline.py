"""The corpus pipeline: toxic documents go, boilerplate lines go, near copies go, sources are mixed, the rest is packed.

STAGES lists (name, function); each takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and
read again as the next stage's docs. All but the last return the columns of documents. Every stage works on all rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitchline.llm.common import cut, maybe_broadcast, table, tune, unique_documents, unused
from pitchline.llm.line_dedup import dedup_lines
from pitchline.llm.mixing import mix_sources
from pitchline.llm.ngram_join import jaccard_classes
from pitchline.llm.packing import pack_documents
from pitchline.llm.toxicity import THRESHOLD, fit, score_documents

#: A line of fewer words is never boilerplate: short ones repeat by chance.
LINE_WORDS = 5


def _unique(docs: DataFrame) -> DataFrame:
    """Whole rows, one for each id; see unique_documents."""
    rest = [c for c in docs.columns if c not in ("doc_id", "text")]
    return unique_documents(docs, "text", *rest).select(*[F.col(f"`{c}`") for c in docs.columns])


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the threshold.

    Each row is judged by its own text, so repeated rows and ids and null ids stay as they are; null, empty and wordless texts score 0 and stay. Very
    long texts are scored whole. An empty table gives no rows. Extra columns are kept, whatever their names.
    """
    tune(spark)
    net, score = fit(docs, table(spark, sf_dir, "labels")), unused(docs, "toxicity")
    return score_documents(docs, net, score).where(F.col(score) < THRESHOLD).drop(score)


def drop_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines of LINE_WORDS words or more that spread over three sites; one that had only such lines goes. n_chars follows.

    A spread line stays at its first place in the document with the smallest id. Null and empty texts stay; a null source is no site. Rows without id go;
    repeated ids: unique_documents. Very long texts take time in proportion. An empty table gives no rows. Extra columns are kept, whatever their names.
    """
    rest = [c for c in docs.columns if c not in ("doc_id", "text", "source")]
    rows = docs.select("doc_id", "text", "source", *([F.struct(*[F.col(f"`{c}`") for c in rest]).alias("rest")] if rest else []))
    out = dedup_lines(rows, carry=("rest",) if rest else (), least_words=LINE_WORDS)
    out = out.where(~((F.col("n_removed") > 0) & (F.col("n_removed") == F.col("n_lines"))))
    new = {"doc_id": F.col("doc_id"), "text": F.col("clean_text"), "source": F.col("source")} | {c: F.col(f"rest.`{c}`") for c in rest}
    if "n_chars" in rest:
        new["n_chars"] = F.length("clean_text").cast(docs.schema["n_chars"].dataType)
    return out.select(*[new[c].alias(c) for c in docs.columns])


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each class of near copies (five words, 0.8).

    Null, empty and wordless texts are copies of nothing and stay. Rows without id go; repeated ids: unique_documents. An empty table
    gives no rows. Extra columns are kept, whatever their names.
    """
    tune(spark)
    gone = cut(jaccard_classes(docs).where("doc_id <> component_id").select("doc_id"), "copies")
    return _unique(docs).join(maybe_broadcast(gone), "doc_id", "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it, as so many equal rows.

    A null source is a source of its own; null and empty texts have size 0 and are taken once, or twice where their source takes all it can (not at all if it
    has no words). Rows without id go; repeated ids: unique_documents. An empty table gives no rows. Extra columns are kept, whatever their names.
    """
    tune(spark)
    n = unused(docs, "copies")
    copies = cut(mix_sources(docs).where("copies > 0").select("doc_id", F.col("copies").alias(n)), "mix")
    rows = _unique(docs).join(maybe_broadcast(copies), "doc_id")
    return rows.withColumn(n, F.explode(F.sequence(F.lit(1).cast("long"), F.col(n)))).select(*[F.col(f"`{c}`") for c in docs.columns])


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece of each copy, with its sequence and place.

    Rows that repeat an id are copies, all of them packed and numbered in column copy. Null and empty texts are an end id alone; rows without id go. Very
    long texts are cut into pieces. An empty table gives no rows; extra columns are not read.
    """
    tune(spark)
    return pack_documents(docs, repeats=True)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_boilerplate),
    ("ngram_jaccard_join", drop_near_copies),
    ("mixing", mix),
    ("best_fit_packing", pack),
]
#: A trained network decides in the first stage, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table; what each does with nulls, repeated rows and the rest is in its own text."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
