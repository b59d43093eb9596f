"""Places in an order of all rows without one task for them: rows are dealt by value over slots, and slots' counts say where each begins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, NumericType, TimestampNTZType, TimestampType

SLOTS, SLOT_ROWS = 256, 10_000


def slot(df: DataFrame, name: str, slots: int = SLOTS) -> Column:
    """A row's slot, ascending with the column: how many cut points are not above its value (null: -1, NaN: the last).

    Cut points are approximate quantiles, at most `slots` of them, from one aggregation; equal values share a slot. Columns that are neither numbers
    nor times have one slot.
    """
    kind, value = df.schema[name].dataType, F.col(f"`{name}`")
    if isinstance(kind, (DateType, TimestampType, TimestampNTZType)):
        value = F.unix_micros(value.cast("timestamp"))
    elif not isinstance(kind, NumericType):
        return F.lit(0)
    real = F.when(~F.isnan(value.cast("double")), value)
    r = df.agg(F.count("*"), F.percentile_approx(real, [i / slots for i in range(1, slots)], 1000)).first()
    n = max(1, min(slots, r[0] // SLOT_ROWS))
    cuts = sorted(set((r[1] or [])[:: max(1, slots // n)])) if n > 1 else []
    return F.coalesce(sum(((value >= F.lit(c)).cast("int") for c in cuts), F.lit(0)), F.lit(-1))


def sums_before(rows: DataFrame, keys: list[str], by: str, column: Column, name: str) -> DataFrame:
    """(keys, by, name): the column's sum over the groups of smaller `by` within the keys. A row a slot: at most SLOTS + 2 of each keys."""
    total = rows.groupBy(*keys, by).agg(F.sum(column).alias("_n"))
    w = Window.partitionBy(*(keys or [F.lit(1)])).orderBy(by).rowsBetween(Window.unboundedPreceding, -1)
    return total.select(*keys, by, F.coalesce(F.sum("_n").over(w), F.lit(0)).alias(name))


def ranked(df: DataFrame, order: list[str], name: str) -> DataFrame:
    """Adds name, from 0: each row's place by the columns of order, ascending, nulls first. Ties are placed as they come."""
    rows = df.withColumn("_slot", slot(df, order[0]))
    starts = sums_before(rows, [], "_slot", F.lit(1), "_before")
    within = F.row_number().over(Window.partitionBy("_slot").orderBy(*[F.col(f"`{c}`") for c in order])) - 1
    return rows.withColumn("_within", within).join(F.broadcast(starts), "_slot").withColumn(name, (F.col("_before") + F.col("_within")).cast("long")).drop("_slot", "_within", "_before")


def quantiles(df: DataFrame, values: dict[str, Column], shares: list[float]) -> DataFrame:
    """(feature, share, value): exact quantiles of columns of doubles by name, linear between neighbours; nulls and NaN left out.

    Equal values are counted before anything moves; the counts are ranked slot by slot, so no task holds all values of a column.
    """
    rows = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), x.cast("double").alias("v")) for c, x in values.items()])).alias("r")).select("r.*").where("v is not null and not isnan(v)")
    counted = rows.groupBy("feature", "v").agg(F.count("*").alias("n"))
    known = rows.groupBy("feature").agg(F.percentile_approx("v", [i / SLOTS for i in range(1, SLOTS)], 1000).alias("cuts"), F.count("*").alias("total"))  # a row a column
    counted = counted.join(F.broadcast(known), "feature").withColumn("slot", F.size(F.filter("cuts", lambda c: c <= F.col("v")))).drop("cuts", "total")
    within = F.sum("n").over(Window.partitionBy("feature", "slot").orderBy("v").rowsBetween(Window.unboundedPreceding, -1))
    placed = counted.withColumn("within", F.coalesce(within, F.lit(0))).join(F.broadcast(sums_before(counted, ["feature"], "slot", F.col("n"), "before")), ["feature", "slot"])
    placed = placed.select("feature", "v", (F.col("before") + F.col("within")).alias("at"), "n")
    at = F.explode(F.array(*[F.struct(F.lit(s).alias("share"), ((F.col("total") - 1) * F.lit(s)).alias("place")) for s in shares]))
    asked = known.select("feature", at.alias("a")).select("feature", "a.share", "a.place")
    holds = lambda place: (place >= F.col("at")) & (place < F.col("at") + F.col("n"))
    low, high = F.floor("place"), F.ceil("place")
    found = placed.join(F.broadcast(asked), "feature").where(holds(low) | holds(high))
    both = found.groupBy("feature", "share", "place").agg(F.max(F.when(holds(low), F.col("v"))).alias("a"), F.max(F.when(holds(high), F.col("v"))).alias("b"))
    return both.select("feature", "share", F.when(low == high, F.col("a")).otherwise((high - F.col("place")) * F.col("a") + (F.col("place") - low) * F.col("b")).alias("value"))
