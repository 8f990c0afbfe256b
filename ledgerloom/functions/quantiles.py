"""Exact quantiles and ranks that stay distributed.

Spark's ``percentile`` keeps every distinct value of a group in one aggregation buffer, and a window
without PARTITION BY sorts the whole input in one task. Both break on billions of rows, so:

* ``exact_quantiles`` is a distributed selection: count per sub-interval, keep the interval that holds
  the rank, and repeat there until few distinct values are left. No round sorts, and none brings an
  interval's rows together.
* ``global_row_number`` range-partitions, sorts inside partitions, and adds per-partition offsets.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerloom.session import checkpointed

# A sketch of this accuracy is off by at most rows / accuracy ranks; brackets are five times as wide.
ACCURACY = 10_000
# Sub-intervals of a round, and distinct values that end the rounds: per wanted rank, so what the driver
# sees of a table depends on the call alone.
BINS, FEW = 64, 2000


@dataclass
class Rank:
    """A wanted row of a column: its number, the interval it lies in, and the rows below that."""

    name: str
    slot: int
    rank: int
    low: float = math.nan
    high: float = math.nan
    before: int = 0
    distinct: int = 0
    value: float | None = None


def exact_quantiles(
    df: DataFrame, columns: Sequence[str], probs: Sequence[float], accuracy: int = ACCURACY
) -> DataFrame:
    """One row with one ``array<double>`` per column: linearly interpolated quantiles.

    NULLs are ignored, as in a dataframe ``quantile``; a column without values has an empty array. Two passes over
    ``df``: a sketch that brackets every rank, and exact counts, in which rows outside the brackets collapse before
    the shuffle. The rounds read the distinct values inside the brackets, about a thousandth of the rows. A rank that
    the sketch missed by more than it promises is counted again in a wider bracket.
    """
    values = df.select(
        F.explode(
            F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).cast("double").alias("x")) for c in columns])
        ).alias("kv")
    ).select("kv.name", "kv.x").filter(F.col("x").isNotNull())
    wanted = [float(p) for p in probs]
    slack, totals, ranks, pending = 5.0 / accuracy, {}, {}, None
    while pending is None or pending:
        around = [min(max(p + d, 0.0), 1.0) for p in wanted for d in (-slack, slack)]
        sketch = values.groupBy("name").agg(F.count("*"), F.percentile_approx("x", around, accuracy)).collect()
        brackets = []
        for name, total, edges in sketch:
            totals[name] = total
            for slot, p in enumerate(wanted):
                if pending is None or (name, slot) in pending:
                    brackets.append((name, slot, edges[2 * slot], edges[2 * slot + 1]))
                    position = p * (total - 1)
                    ranks[name, slot] = [Rank(name, slot, f(position)) for f in (math.floor, math.ceil)]
        pending = _select(values, brackets, ranks) if brackets else []
        slack *= 8
    cells = []
    for c in columns:
        found = []
        for slot, p in enumerate(wanted if c in totals else ()):
            low, high = (r.value for r in ranks[c, slot])
            position = p * (totals[c] - 1)
            found.append(low + (high - low) * (position - math.floor(position)))
        cells.append(F.array(*map(F.lit, found)).cast("array<double>").alias(c))
    return df.sparkSession.range(1).select(*cells)


def _select(values: DataFrame, brackets: list[tuple], ranks: dict) -> list[tuple[str, int]]:
    """Finds the values of the ranks of each bracket; returns the brackets that do not hold their ranks."""
    spark = values.sparkSession
    # columns * probs rows: the size of this side is fixed by the call.
    limits = F.broadcast(spark.createDataFrame(brackets, "name string, slot int, lo double, hi double"))
    placed = values.join(limits, "name")
    inside = F.col("x").between(F.col("lo"), F.col("hi"))
    side = F.when(F.col("x") < F.col("lo"), 0).when(inside, 1).otherwise(2).alias("side")
    steps = checkpointed(
        placed.groupBy("name", "slot", side, F.when(inside, F.col("x")).alias("x")).agg(
            F.count("*").alias("n"), F.min("x").alias("least"), F.max("x").alias("most")
        )
    )
    sides = steps.groupBy("name", "slot", "side").agg(
        F.sum("n"), F.count("*"), F.min("least"), F.max("most")
    ).collect()
    known = {(name, slot, side): rest for name, slot, side, *rest in sides}
    missed, active = [], []
    for name, slot, low, high in brackets:
        below, _, _, largest_below = known.get((name, slot, 0), (0, 0, None, None))
        held, distinct, _, _ = known.get((name, slot, 1), (0, 0, None, None))
        least_above = known.get((name, slot, 2), (0, 0, None, None))[2]
        for r in ranks[name, slot]:
            if below <= r.rank < below + held:
                r.low, r.high, r.before, r.distinct = low, high, below, distinct
                active.append(r)
            elif r.rank == below - 1:  # below a bracket only the largest value is known, above it the smallest
                r.value = largest_below
            elif r.rank == below + held:
                r.value = least_above
            elif (name, slot) not in missed:
                missed.append((name, slot))
    inner = steps.filter("side = 1").select("name", "slot", "x", "n")
    while wide := [r for r in active if r.distinct > FEW and r.low < r.high]:
        _narrow(inner, wide)
    _pick(inner, [r for r in active if r.value is None])
    return missed


def _in_intervals(inner: DataFrame, ranks: list[Rank]) -> DataFrame:
    rows = [(i, r.name, r.slot, r.low, r.high) for i, r in enumerate(ranks)]
    limits = inner.sparkSession.createDataFrame(rows, "i int, name string, slot int, lo double, hi double")
    return inner.join(F.broadcast(limits), ["name", "slot"]).filter("x BETWEEN lo AND hi")


def _narrow(inner: DataFrame, ranks: list[Rank]) -> None:
    """One round: BINS sub-intervals of about as many distinct values each; the one with the rank is kept."""
    near = _in_intervals(inner, ranks)
    edges = near.groupBy("i").agg(F.percentile_approx("x", [k / BINS for k in range(1, BINS)], 20 * BINS).alias("edges"))
    bins = F.size(F.filter("edges", lambda e: e < F.col("x"))).alias("bin")
    counts = near.join(F.broadcast(edges), "i").groupBy("i", bins).agg(
        F.sum("n"), F.count("*"), F.min("x"), F.max("x")
    )
    for i, _, n, distinct, low, high in sorted(counts.collect()):
        r = ranks[i]
        if r.value is None and r.before >= 0 and r.rank < r.before + n:
            r.low, r.high, r.distinct = low, high, distinct
            r.before = -1 - r.before  # found: the later bins of this round do not count
        elif r.before >= 0:
            r.before += n
    for r in ranks:
        r.before = -1 - r.before


def _pick(inner: DataFrame, ranks: list[Rank]) -> None:
    """The values of ranks whose intervals have few distinct values."""
    for r in ranks:
        if r.low == r.high:
            r.value = r.low
    ranks = [r for r in ranks if r.value is None]
    if not ranks:
        return
    nan_last = lambda row: (row[0], math.isnan(row[1]), row[1])
    for i, x, n in sorted(_in_intervals(inner, ranks).select("i", "x", "n").collect(), key=nan_last):
        r = ranks[i]
        if r.value is None:
            if r.rank < r.before + n:
                r.value = x
            r.before += n


def quantile_bin(x: Column, edges: Column, bins: int) -> Column:
    """1-based right-closed bin between ascending edges, the lowest value included.

    NULL when two edges coincide or there are none: labels cannot be assigned then.
    """
    value = x.cast("double")
    usable = (F.size(F.array_distinct(edges)) == bins + 1) & value.isNotNull()
    inner = [F.when(value > edges[i], 1).otherwise(0) for i in range(1, bins)]
    return F.when(usable, sum(inner, F.lit(1)))


def global_row_number(df: DataFrame, order: Sequence[str], name: str = "row_number") -> DataFrame:
    """1-based position of every row in the total order ``order``, without a single-task sort.

    The sorted rows are checkpointed so that the partition counts and the positions come from the same
    partitioning even if executors are lost between the two.
    """
    placed = checkpointed(
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_id", F.monotonically_increasing_id())
    )
    # monotonically_increasing_id is documented as partition << 33 | row within partition.
    placed = placed.withColumn("_part", F.shiftright("_id", 33)).withColumn(
        "_pos", F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))
    )
    # One row per partition, so the window and the broadcast are bounded by the partition count.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("_part")
        .count()
        .select("_part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_offset"))
    )
    return (
        placed.join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_offset") + F.col("_pos") + 1)
        .drop("_id", "_part", "_pos", "_offset")
    )
