"""Exact quantiles of any number of groups of any size, by one plan.

Equal values of a group are counted before anything is moved. The counted
values are dealt by ranges of (group, value), so a large group spreads over
many tasks; from the sums per (group, range) follows which range holds a
wanted rank, and only that range is looked through in order. No task holds a
group, and nothing depends on how large one is. Interpolation is linear
between neighbouring order statistics (pandas / NumPy ``linear``). NULL and
NaN are not values.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidepanel.functions.numeric import to_numeric
from tidepanel.session import checkpointed


def values_at_ranks(counted: DataFrame, by: Sequence[str], wanted: DataFrame) -> DataFrame:
    """(by, slot, v): the value at 0-based rank ``k`` for each row of ``wanted`` (by, slot, k).

    ``counted`` has (by, v, n): each value of a group once, with its number.
    """
    by = list(by)
    # written before it is used: its range numbers must stay what they are
    dealt = checkpointed(counted.select(*by, "v", "n").repartitionByRange(*by, "v").withColumn("__part", F.spark_partition_id()))
    sums = dealt.groupBy(*by, "__part").agg(F.sum("n").alias("__m"))
    before = Window.partitionBy(*by).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)  # one row a range
    offsets = sums.withColumn("__off", F.coalesce(F.sum("__m").over(before), F.lit(0)))
    w = wanted.select(*[F.col(c).alias(f"__w_{c}") for c in by], "slot", "k")
    own = reduce(lambda x, y: x & y, [F.col(c).eqNullSafe(F.col(f"__w_{c}")) for c in by])
    at = (offsets.join(w, own & (F.col("__off") <= F.col("k")) & (F.col("k") < F.col("__off") + F.col("__m")))
          .select(*[F.col(c).alias(f"__t_{c}") for c in by], F.col("__part").alias("__t_part"), "slot", (F.col("k") - F.col("__off")).alias("__k")))
    at = checkpointed(at)  # a row per wanted rank
    there = reduce(lambda x, y: x & y, [F.col(c).eqNullSafe(F.col(f"__t_{c}")) for c in by]) & (F.col("__part") == F.col("__t_part"))
    ranges = at.select(*[f"__t_{c}" for c in by], "__t_part").distinct()
    inside = dealt.join(ranges, there, "left_semi")
    upto = Window.partitionBy(*by, "__part").orderBy("v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = inside.withColumn("__hi", F.sum("n").over(upto))
    return placed.join(at, there & (F.col("__k") >= F.col("__hi") - F.col("n")) & (F.col("__k") < F.col("__hi"))).select(*by, "slot", "v")


def _position(p: float, n: Column, up: bool) -> Column:
    pos = F.lit(p) * (n - 1)
    return (F.ceil(pos) if up else F.floor(pos)).cast("long")


def group_quantiles(df: DataFrame, by: Sequence[str], col: str, probs: Sequence[float]) -> DataFrame:
    """(by, n, q0, q1, ...): exact quantiles of ``col`` per group; NULL is a group. Groups without values have none."""
    by = list(by)
    v = df.select(*by, to_numeric(F.col(col)).alias("v"))
    counted = v.where(F.col("v").isNotNull()).groupBy(*by, "v").agg(F.count(F.lit(1)).alias("n"))
    totals = checkpointed(v.groupBy(*by).agg(F.count("v").alias("__n")))
    slots = F.explode(F.array(*[F.struct(F.lit(2 * i + up).alias("slot"), _position(p, F.col("__n"), bool(up)).alias("k")) for i, p in enumerate(probs) for up in (0, 1)]))
    wanted = totals.where(F.col("__n") > 0).select(*by, slots.alias("s")).select(*by, "s.slot", "s.k")
    found = values_at_ranks(counted, by, wanted)
    wide = found.groupBy(*by).agg(*[F.max(F.when(F.col("slot") == s, F.col("v"))).alias(f"__v{s}") for s in range(2 * len(probs))])
    wide = wide.select(*[F.col(c).alias(f"__f_{c}") for c in by], *[f"__v{s}" for s in range(2 * len(probs))])
    out = totals.join(wide, reduce(lambda x, y: x & y, [F.col(c).eqNullSafe(F.col(f"__f_{c}")) for c in by]), "left")

    def quantile(i: int, p: float) -> Column:
        pos = F.lit(p) * (F.col("__n") - 1)
        a, b = F.col(f"__v{2 * i}"), F.col(f"__v{2 * i + 1}")
        return a + (b - a) * (pos - F.floor(pos))

    return out.select(*by, F.col("__n").alias("n"), *[quantile(i, p).alias(f"q{i}") for i, p in enumerate(probs)])


def exact_quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float], accuracy: int = 10_000) -> dict[str, list[float | None]]:
    """{column: quantiles} of several columns of one table, in three scans.

    The first brackets every wanted rank with approximate quantiles, the second
    counts what lies below the brackets, the third takes the few rows inside,
    where the ranks are found by ``values_at_ranks``. A rank that its bracket
    should miss is looked for among all values.
    """
    cols = list(cols)
    v = df.select(*[to_numeric(F.col(c)).alias(f"c{i}") for i, c in enumerate(cols)])
    wide = 2.0 / accuracy
    edges = [x for p in probs for x in (max(0.0, p - wide), min(1.0, p + wide))]
    first = v.agg(*[F.count(f"c{i}").alias(f"n{i}") for i in range(len(cols))], *[F.percentile_approx(f"c{i}", edges, accuracy).alias(f"e{i}") for i in range(len(cols))]).first()
    brackets = [(i, j, first[f"e{i}"][2 * j], first[f"e{i}"][2 * j + 1]) for i in range(len(cols)) for j in range(len(probs)) if first[f"n{i}"]]
    out: dict[str, list[float | None]] = {c: [None] * len(probs) for c in cols}
    if not brackets:
        return out
    counts = v.agg(*[f(F.when(cond, 1)).alias(f"{name}{i}_{j}") for i, j, lo, hi in brackets
                     for f, name, cond in ((F.count, "b", F.col(f"c{i}") < lo), (F.count, "m", F.col(f"c{i}").between(lo, hi)))]).first()
    wanted, lost = [], set()
    for i, j, lo, hi in brackets:
        pos, below = probs[j] * (first[f"n{i}"] - 1), counts[f"b{i}_{j}"]
        for up, k in enumerate((math.floor(pos), math.ceil(pos))):
            if below <= k < below + counts[f"m{i}_{j}"]:
                wanted.append((i, j, up, k - below))
            else:
                lost.add(i)
    spark = df.sparkSession
    hit = [F.col(f"c{i}").between(lo, hi) for i, _, lo, hi in brackets]
    inside = F.explode(F.array(*[F.when(h, F.struct(F.lit(i).alias("i"), F.lit(j).alias("j"), F.col(f"c{i}").alias("v"))) for h, (i, j, _, _) in zip(hit, brackets)]))
    some = v.where(reduce(lambda x, y: x | y, hit))  # most rows are in no bracket and become no rows of their own
    counted = some.select(inside.alias("e")).where("e is not null").select("e.*").groupBy("i", "j", "v").agg(F.count(F.lit(1)).alias("n"))
    found = {}
    if wanted:
        ranks = spark.createDataFrame(wanted, "i int, j int, slot int, k long")
        found = {(r["i"], r["j"], r["slot"]): r["v"] for r in values_at_ranks(counted, ["i", "j"], ranks).collect()}  # two per column and quantile
    for i, c in enumerate(cols):
        if i in lost:
            row = group_quantiles(v.withColumn("__all", F.lit(0)), ["__all"], f"c{i}", probs).first()
            out[c] = [row[f"q{j}"] for j in range(len(probs))]
        elif first[f"n{i}"]:
            for j, p in enumerate(probs):
                pos = p * (first[f"n{i}"] - 1)
                a, b = found[i, j, 0], found[i, j, 1]
                out[c][j] = a + (b - a) * (pos - math.floor(pos))
    return out
