"""IQR outlier report (A16) — flags, never removes.

Quartiles are exact at every size (``quantiles``). One more pass writes the
values outside their bounds as rows; counts and samples are taken from these
(the row_number limit is applied per map task before the shuffle). NULL and NaN are not values.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidepanel.functions.numeric import np_round, to_numeric
from tidepanel.operators.quantiles import exact_quantiles, group_quantiles
from tidepanel.session import checkpointed

QUARTILES = [0.25, 0.75]
BOUNDS_SCHEMA = "column string, q1 double, q3 double, multiplier double, outliers_count bigint, __rows bigint"


def quartiles(df: DataFrame, cols: Sequence[str], method: str = "exact", accuracy: int = 10_000) -> dict[str, tuple]:
    """{column: (q1, q3)} with linear interpolation (NULLs skipped).

    method="approx" uses ``percentile_approx`` (one pass, rank error <= n / accuracy)
    for dashboards that can trade exactness for a single pass.
    """
    if method == "approx":
        q = df.agg(*[F.percentile_approx(to_numeric(F.col(c)), QUARTILES, accuracy).alias(f"q{i}") for i, c in enumerate(cols)]).first()
        return {c: tuple(q[f"q{i}"]) if q[f"q{i}"] is not None else (None, None) for i, c in enumerate(cols)}
    return {c: tuple(q) for c, q in exact_quantiles(df, cols, QUARTILES).items()}


def grouped_quartiles(df: DataFrame, by: str, col: str) -> DataFrame:
    """Per group of ``by`` (NULL is one): exact (q1, q3) of ``col`` and the group's row count."""
    q = group_quantiles(df, [by], col, QUARTILES).select(F.col(by).alias("__by"), "q0", "q1")
    sizes = df.groupBy(by).agg(F.count(F.lit(1)).alias("__rows"))
    return sizes.join(q, F.col(by).eqNullSafe(F.col("__by")), "left").select(by, F.col("q0").alias("q1"), F.col("q1").alias("q3"), "__rows")


def iqr_outliers_by(df: DataFrame, by: str, col: str, multiplier: float = 1.5, digits: int | None = None) -> DataFrame:
    """A16 per group: q1, q3, bounds, outlier count and share of the group's rows."""
    q = grouped_quartiles(df, by, col)
    b = (q.withColumn("iqr", F.col("q3") - F.col("q1"))
         .withColumn("lower_bound", F.col("q1") - F.lit(float(multiplier)) * F.col("iqr"))
         .withColumn("upper_bound", F.col("q3") + F.lit(float(multiplier)) * F.col("iqr")))
    limits = b.select(F.col(by).alias("__by"), "lower_bound", "upper_bound")
    flagged = (df.select(by, to_numeric(F.col(col)).alias("__v")).join(limits, F.col(by).eqNullSafe(F.col("__by")))
               .where((F.col("__v") < F.col("lower_bound")) | (F.col("__v") > F.col("upper_bound")))
               .groupBy(F.col(by).alias("__g")).agg(F.count(F.lit(1)).alias("outliers_count")))
    cnt = F.coalesce(F.col("outliers_count"), F.lit(0)).cast("bigint")
    return b.join(flagged, F.col(by).eqNullSafe(F.col("__g")), "left").select(
        by, *[np_round(F.col(c), digits).alias(c) for c in ("q1", "q3", "iqr", "lower_bound", "upper_bound")],
        F.lit(float(multiplier)).alias("multiplier"), cnt.alias("outliers_count"),
        (cnt / F.col("__rows") * F.lit(100.0)).alias("outlier_percentage"))


def iqr_outliers(df: DataFrame, multipliers: Mapping[str, float], order_by: Sequence[str],
                 n_samples: int = 5, digits: int | None = None, method: str = "exact") -> DataFrame:
    """Per column: q1, q3, iqr, bounds ``q -/+ m * iqr``, count of values strictly
    outside, their share of *all* rows (NULLs included) and the first
    ``n_samples`` outlier values in ``order_by`` order. An all-NULL column
    reports 0 outliers.
    """
    cols = [c for c in multipliers if c in df.columns]
    qs = quartiles(df, cols, method)
    spark, ids = df.sparkSession, list(order_by)

    def outside(c: str):
        q1, q3 = qs[c]
        if q1 is None:
            return F.lit(False)
        m = float(multipliers[c])
        v = to_numeric(F.col(c))
        return F.coalesce((v < q1 - m * (q3 - q1)) | (v > q3 + m * (q3 - q1)), F.lit(False))

    found = F.filter(F.array(*[F.when(outside(c), F.struct(F.lit(c).alias("column"), to_numeric(F.col(c)).alias("value"))) for c in cols]), lambda x: x.isNotNull())
    some = df.where(reduce(lambda x, y: x | y, [outside(c) for c in cols], F.lit(False)))  # few rows are outside anywhere
    flagged = checkpointed(some.select(*ids, F.explode(found).alias("__f")).select(*[F.col(c).alias(f"__id{i}") for i, c in enumerate(ids)], "__f.*"))
    counts = {r["column"]: r["n"] for r in flagged.groupBy("column").agg(F.count(F.lit(1)).alias("n")).collect()}  # a row per column
    rows = df.count()  # of a stored table, from its footers
    stats = spark.createDataFrame([(c, *qs[c], float(multipliers[c]), counts.get(c, 0), rows) for c in cols], BOUNDS_SCHEMA)
    stats = (stats.withColumn("iqr", F.col("q3") - F.col("q1"))
             .withColumn("lower_bound", F.col("q1") - F.col("multiplier") * F.col("iqr"))
             .withColumn("upper_bound", F.col("q3") + F.col("multiplier") * F.col("iqr")))
    w = Window.partitionBy("column").orderBy(*[F.col(f"__id{i}").asc_nulls_last() for i in range(len(ids))])
    firsts = flagged.withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") <= n_samples)
    samples = firsts.groupBy("column").agg(*[F.max(F.when(F.col("__rn") == i, F.col("value"))).alias(f"sample_{i}")
                                             for i in range(1, n_samples + 1)])
    return stats.join(samples, "column", "left").select(
        "column", F.lit("iqr").alias("method"),
        *[np_round(F.col(c), digits).alias(c) for c in ("q1", "q3", "iqr", "lower_bound", "upper_bound")],
        "multiplier", "outliers_count",
        F.when(F.col("__rows") > 0, F.col("outliers_count") / F.col("__rows") * F.lit(100.0)).otherwise(F.lit(0.0))
        .alias("outlier_percentage"),
        *[f"sample_{i}" for i in range(1, n_samples + 1)],
    )
