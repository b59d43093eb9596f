"""Mixing sources to target weights by entropy balancing.

A document's rate r is how often the mix takes it, at most `cap` times. Of all rates that meet a source's token constraint (the sum of r * size is
its target), the ones closest in relative entropy to taking each document once are exponentially tilted: r = min(cap, exp(b * x)) with x the
document's size over its source's mean size. The dual in b is convex, its gradient the tokens taken less the target; Newton's iterations on
the logarithm of the tokens, kept within a bracket of the root, solve it for all sources at once, each as one aggregation over the table of (source,
size, documents), which is far smaller than the documents and holds all that the dual depends on. A source that is to grow takes its longer
documents more often, one that is to shrink takes them less often; b is 0 only where the target is the source's own size. A source whose target is all that
the cap allows takes every document `cap` times.

Rates then become copies: per source, from the longest size down, each size takes the number of copies that its rate asks for
plus what rounding has left over so far, so what remains at the end is about the shortest documents' size. Documents of
one source and size are alike to the constraint; a hash order deals the copies among them, each at most `cap`.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, discard, position, rank_in_class, table, tune, unique_documents

WORDS = r"[^\x20\x09-\x0D]+"


def targets(sources: DataFrame, weights=(3, 1, 2), share: float = 1.5, cap: float = 2.0) -> DataFrame:
    """Adds target to (key, source, source_size): weights repeat over sources by code point, null last.

    A target is weight * level, at most cap * source_size; the level at which targets sum to share * all sizes
    rises, an aggregation a step, as long as it puts further sources at their cap.
    """
    ranked = cut(position(sources, F.col("source").isNull(), F.col("source")), "sources")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod("position", F.lit(len(weights))) + 1).cast("int"))
    ranked = ranked.withColumn("w", weight)
    most = F.col("source_size") * cap
    level, full = 0.0, None
    while True:
        r = ranked.agg(F.sum("source_size").alias("all"), F.sum(F.when(most <= F.col("w") * level, most).otherwise(0.0)).alias("held"), F.sum(F.when(most <= F.col("w") * level, 0.0).otherwise(F.col("w"))).alias("w"), F.sum(F.when(most <= F.col("w") * level, 1).otherwise(0)).alias("n")).first()
        if not r.w or r.n == full:
            break
        level, full = (r["all"] * share - r.held) / r.w, r.n
    return ranked.withColumn("target", F.least(most, F.col("w") * level)).drop("w", "position")


def tilts(sizes: DataFrame, sources: DataFrame, cap: float, tolerance: float = 1e-9, rounds: int = 40, chained: int = 5) -> DataFrame:
    """(key, mean, b) of each source with a target above 0; b is null where the target is all that the cap allows.

    sizes: (key, size, n). `chained` iterations are one job, and one table that is written; not solved after rounds * chained of them, it raises.
    """
    goal = sources.where("target > 0").join(sizes.groupBy("key").agg(F.sum("n").alias("docs")), "key")
    goal = goal.select("key", (F.col("source_size") / F.col("docs")).alias("mean"), (F.col("target") / F.col("source_size")).alias("rho"), F.col("docs").cast("double").alias("docs"))
    goal = cut(goal, "goal")
    full = F.col("rho") >= cap * (1 - 1e-12)
    rows = cut(sizes.where("size > 0").join(goal.where(~full), "key").select("key", F.col("n").cast("double").alias("n"), (F.col("size") / F.col("mean")).alias("x"), (F.col("rho") * F.col("docs")).alias("t")), "tilt")
    state = goal.where(~full).select("key", F.lit(0.0).alias("b"), F.lit(None).cast("double").alias("lo"), F.lit(None).cast("double").alias("hi"))
    written = None
    raw = F.exp(F.least(F.col("b") * F.col("x"), F.lit(700.0)))
    for _ in range(rounds):
        for _ in range(chained):
            r, free = F.least(raw, F.lit(float(cap))), F.when(raw < cap, raw).otherwise(0.0)
            sums = rows.join(state, "key").groupBy("key", "b", "lo", "hi", "t").agg(F.sum(F.col("n") * F.col("x") * r).alias("g"), F.sum(F.col("n") * F.col("x") * F.col("x") * free).alias("h"))
            over = F.col("g") > F.col("t")
            lo, hi = F.when(over, F.col("lo")).otherwise(F.col("b")), F.when(over, F.col("b")).otherwise(F.col("hi"))
            sums = sums.select("key", "b", "g", "t", "h", lo.alias("lo"), hi.alias("hi"))
            step = F.col("b") - F.col("g") * F.log(F.col("g") / F.col("t")) / F.col("h")
            inside = (F.col("h") > 0) & (F.col("lo").isNull() | (step > F.col("lo"))) & (F.col("hi").isNull() | (step < F.col("hi")))
            halved = F.when(F.col("lo").isNull(), F.col("hi") * 2 - 1).when(F.col("hi").isNull(), F.col("lo") * 2 + 1).otherwise((F.col("lo") + F.col("hi")) / 2)
            met = F.abs(F.col("g") - F.col("t")) <= tolerance * F.col("t")
            state = sums.select("key", F.when(met, F.col("b")).when(inside, step).otherwise(halved).alias("b"), "lo", "hi", met.alias("met"))
            last, state = state, state.drop("met")
        last, before = cut(last, "newton"), written
        discard(before)
        written = last
        if not last.where(~F.col("met")).limit(1).count():
            break
        state = last.drop("met")
    else:
        raise RuntimeError(f"tilts: the token constraints are not met after {rounds * chained} iterations")
    solved = last.select("key", F.round("b", 9).alias("b"))  # sums in another order agree to that
    return goal.select("key", "mean").join(solved, "key", "left")


def _copies(cap: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("size", ascending=False)
        carry, out = 0.0, []
        for size, n, rate in zip(pdf["size"].tolist(), pdf["n"].tolist(), pdf["rate"].tolist()):
            want = rate * n
            m = min(cap * n, max(0, int(np.floor(want + (carry / size if size else 0.0) + 0.5))))
            carry += (want - m) * size
            out.append(m)
        return pd.DataFrame({"key": pdf["key"], "size": pdf["size"], "n": pdf["n"], "m": out})

    return run


def mix_sources(documents: DataFrame, weights=(3, 1, 2), share: float = 1.5, cap: int = 2) -> DataFrame:
    """(doc_id, size, source, source_size, target, copies, taken) of every document.

    A null text has size 0; a null source is a source of its own, last. Repeated ids: unique_documents. A source
    of size 0 has target 0 and none is taken. A document of size 0 counts towards no constraint: its rate is that of its source's tilt, 1 (cap where the
    source takes all it can). Documents of one source and size are dealt copies by a hash of the id. Reruns agree. An empty table gives no rows; extra columns are not read.
    """
    docs = unique_documents(documents, "text", "source")
    key = F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("-"))
    docs = cut(docs.select("doc_id", F.coalesce(F.regexp_count("text", F.lit(WORDS)), F.lit(0)).cast("long").alias("size"), "source", key.alias("key")), "sizes")
    sizes = cut(docs.groupBy("key", "size").agg(F.count("*").alias("n"), F.first("source").alias("source")), "histogram")
    sources = sizes.groupBy("key").agg(F.first("source").alias("source"), F.sum(F.col("size") * F.col("n")).alias("source_size"))
    sources = cut(targets(sources, weights, share, float(cap)), "targets")
    tilt = tilts(sizes.select("key", "size", "n"), sources, float(cap))
    tilted = F.coalesce(F.exp(F.least(F.col("b") * F.col("size") / F.col("mean"), F.lit(700.0))), F.lit(float(cap)))
    rates = sizes.join(tilt, "key").select("key", "size", "n", F.least(F.lit(float(cap)), tilted).alias("rate"))
    plan = cut(rates.groupBy("key").applyInPandas(_copies(cap), "key string, size long, n long, m long"), "copies")
    ranked = rank_in_class(docs, ["key", "size"], ["doc_id"])
    extra = F.when(F.col("rank") < F.col("m") % F.col("n"), 1).otherwise(0)
    out = ranked.join(plan, ["key", "size"], "left").withColumn("copies", F.coalesce(F.floor(F.col("m") / F.col("n")) + extra, F.lit(0)).cast("long"))
    out = out.join(sources.select("key", "source_size", "target"), "key")
    return out.select("doc_id", "size", "source", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    tune(spark)
    return mix_sources(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")
