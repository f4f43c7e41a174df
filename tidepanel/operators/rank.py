"""Ranking and shares."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def top_k(df: DataFrame, by: str, k: int, tie_break: Sequence[str] = (), partition: Sequence[str] = (),
          ascending: bool = False) -> DataFrame:
    """k largest (or smallest) rows by ``by``; ties keep the ``tie_break`` order.

    Global: ``orderBy().limit()`` -> TakeOrderedAndProject (per-partition
    top-k, then a k-row merge). Per group: ``row_number() <= k``, which Spark
    turns into a partial WindowGroupLimit before the shuffle, so a hot group
    ships at most k rows per map task.
    """
    order = [F.col(by).asc_nulls_last() if ascending else F.col(by).desc_nulls_last()]
    order += [F.col(c).asc_nulls_last() for c in tie_break]
    if not partition:
        return df.orderBy(*order).limit(k)
    w = Window.partitionBy(*partition).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") <= k).drop("__rn")


def share_of_total(df: DataFrame, value: str, out: str = "share_pct", digits: int | None = None,
                   exact: bool = False) -> DataFrame:
    """value / grand total * 100. The total is a scalar subquery (no global window).

    ``exact`` sums as decimal(38,10), independent of the order of the rows but
    cut after the tenth decimal place; the default is a plain double sum.
    """
    from tidepanel.functions.numeric import exact_sum, np_round

    total = df.select(exact_sum(value) if exact else F.sum(value)).scalar()
    return df.withColumn(out, np_round(F.try_divide(F.col(value), total) * F.lit(100.0), digits))


# Label of the folded remainder row and the default number of kept labels.
OTHERS_LABEL = "Otros"
TOP_K_SHARE = 10


def top_k_with_others(df: DataFrame, label: str, value: str, k: int = TOP_K_SHARE, others_label: str = OTHERS_LABEL,
                      exact_sum: bool = False) -> DataFrame:
    """Sum per label, keep the top k, and fold the rest into one ``others`` row.

    The ``others`` row appears only when there is a rest. The top-k list is a
    k-row broadcast (size bounded by ``k``) used in an anti join, so the rest
    is summed rather than derived by subtraction. Nothing runs until the
    result is used; the one aggregate per label is an exchange that both sides
    reuse. ``exact_sum``: decimal(38,10) sums, see ``share_of_total``.
    """
    def s(c):
        return F.sum(F.col(c).cast("decimal(38,10)")).cast("double") if exact_sum else F.sum(c)

    agg = df.where(F.col(value).isNotNull() & F.col(label).isNotNull()).groupBy(label).agg(s(value).alias(value))
    top = agg.orderBy(F.col(value).desc_nulls_last(), F.col(label).asc()).limit(k)
    rest = (agg.join(F.broadcast(top.select(label)), on=label, how="left_anti")
            .agg(F.lit(others_label).alias(label), s(value).alias(value), F.count(F.lit(1)).alias("__n"))
            .where(F.col("__n") > 0).drop("__n"))
    return top.unionByName(rest)
