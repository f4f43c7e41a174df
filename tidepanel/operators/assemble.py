"""Pivoting and multi-source assembly."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidepanel.functions.numeric import row_sum_min_count


def _cols(x) -> list[str]:
    return [x] if isinstance(x, str) else list(x)


# ── A1 ──────────────────────────────────────────────────────────────────────
def pivot_modes(df: DataFrame, index: Sequence[str], column: str, value: str, modes: Sequence[str],
                prefix: str = "", pandas_compat: bool = True) -> DataFrame:
    """Long -> wide sum per (index, mode): one groupBy, one shuffle.

    Listing ``modes`` avoids the extra distinct job of an open pivot and
    guarantees every mode column exists (absent combinations -> NULL).
    ``pandas_compat``: a present group whose values are all NULL sums to 0
    (pivot_table behaviour) instead of NULL.
    """
    v = F.coalesce(F.col(value), F.lit(0.0)) if pandas_compat else F.col(value)
    wide = df.groupBy(*index).pivot(column, list(modes)).agg(F.sum(v))
    return wide.select(*index, *[F.col(m).cast("double").alias(f"{prefix}{m}") for m in modes])


# ── A2 ──────────────────────────────────────────────────────────────────────
def total_if_missing(df: DataFrame, total: str, parts: Sequence[str]) -> DataFrame:
    """Fill a NULL total with the sum of the available parts (NULL if none)."""
    parts = [p for p in parts if p in df.columns]
    if total not in df.columns:
        return df.withColumn(total, row_sum_min_count(parts))
    if not parts:
        return df
    return df.withColumn(total, F.coalesce(F.col(total), row_sum_min_count(parts)))


# ── J1 / J2 ─────────────────────────────────────────────────────────────────
def outer_assemble(frames: Sequence[DataFrame], on: Sequence[str], method: str = "union") -> DataFrame:
    """Full outer combination of frames that are each unique on ``on``.

    method="union": ``unionByName`` + one ``groupBy(on)`` — a single shuffle
    for any number of frames, partially aggregated map-side (a hot key never
    concentrates raw rows). Equal to chained full outer joins as long as every
    frame is unique on the key; the aggregate counts each frame's rows and the
    query fails on a key that a frame has twice.
    method="join": chained ``full_outer`` joins (one exchange per join), which
    keep repeated keys.
    Columns keep first-seen order (the first frame's columns, then each
    later frame's new columns) — the column order of chained merges.
    """
    on = _cols(on)
    order = []
    for f in frames:
        order += [c for c in f.columns if c not in order]
    if method == "join":
        out = reduce(lambda a, b: a.join(b, on=on, how="full_outer"), frames)
        return out.select(*order)
    if method != "union":
        raise ValueError("method must be 'union' or 'join'")
    vals = [c for c in order if c not in on]
    frames = [f.withColumn("__frame", F.lit(i)) for i, f in enumerate(frames)]
    u = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)

    seen = [F.count(F.when(F.col("__frame") == i, 1)).alias(f"__seen{i}") for i in range(len(frames))]
    g = u.groupBy(*on).agg(*[F.max(c).alias(c) for c in vals], *seen)  # one row per frame, and one value at a time also where keys repeat
    twice = reduce(lambda a, b: a | b, [F.col(f"__seen{i}") > 1 for i in range(len(frames))])
    fail = F.raise_error(F.concat(F.lit(f"a frame has several rows for one key of {on}: "), F.to_json(F.struct(*on))))
    # as a filter: no later projection can prune it away, and the keys stay what the rows are partitioned by
    return g.where(F.when(twice, fail.cast("boolean")).otherwise(F.lit(True))).select(*order)


def assemble_indicators(frames: Sequence[DataFrame], on: Sequence[str] = ("country", "country_code", "year"),
                        method: str = "union") -> DataFrame:
    """Single-indicator tables -> one wide table (full outer on ``on``)."""
    return outer_assemble(frames, on, method)


def build_fact(co2: DataFrame, tourism: DataFrame, transport: DataFrame, on: Sequence[str] = ("country_code", "year"),
               method: str = "union") -> DataFrame:
    """Slim each silver table to the fact columns and full-outer them."""
    from tidepanel.plans.gold import FACT_CO2_COLS, FACT_TOURISM_COLS, FACT_TRANSPORT_COLS

    def slim(df, cols):
        return df.select(*[c for c in cols if c in df.columns])

    return outer_assemble([slim(co2, FACT_CO2_COLS), slim(tourism, FACT_TOURISM_COLS),
                           slim(transport, FACT_TRANSPORT_COLS)], on, method)


# ── J3 ──────────────────────────────────────────────────────────────────────
def backfill_dim_attr(df: DataFrame, attr: str, key: str, mapping: DataFrame | None = None) -> DataFrame:
    """Fill NULL ``attr`` from a key -> attr map.

    Without ``mapping`` the map is the frame itself (max over the key window:
    rides on the entity partitioning later windows need anyway). With a
    mapping frame, its per-key max is joined left.
    """
    if mapping is None:
        return df.withColumn(attr, F.coalesce(F.col(attr), F.max(attr).over(Window.partitionBy(key))))
    m = mapping.groupBy(key).agg(F.max(attr).alias("__fill"))
    return df.join(m, on=key, how="left").withColumn(attr, F.coalesce(F.col(attr), F.col("__fill"))) \
        .drop("__fill").select(*df.columns)


# ── J4 ──────────────────────────────────────────────────────────────────────
# Fixed values: (fact column, dim column) pairs tried in order to join fact and dim.
JOIN_CANDIDATES = (
    ("country_code", "country_code"),
    ("country_iso", "country_iso"),
    ("iso_code", "iso_code"),
    ("country_code", "iso_code"),
    ("iso_code", "country_code"),
)


def fact_with_dim(fact: DataFrame, dim: DataFrame, candidates: Sequence[tuple[str, str]] = JOIN_CANDIDATES,
                  suffix: str = "_dim") -> DataFrame:
    """LEFT join fact -> dim on the first candidate key pair present in both.

    Overlapping dim columns get ``suffix``. Spark's own size threshold decides
    between a broadcast and a shuffle join.
    """
    pair = next(((fc, dc) for fc, dc in candidates if fc in fact.columns and dc in dim.columns), None)
    if pair is None:
        return fact
    fc, dc = pair
    renamed = {}
    for c in dim.columns:
        if c == dc and fc == dc:
            renamed[c] = "__dimkey"
        elif c in fact.columns:
            renamed[c] = c + suffix
        else:
            renamed[c] = c
    d = dim.select(*[F.col(c).alias(renamed[c]) for c in dim.columns])
    dkey = renamed[dc]
    out = fact.join(d, fact[fc] == d[dkey], "left")
    keep = [fact[c] for c in fact.columns] + [d[renamed[c]] for c in dim.columns if renamed[c] != "__dimkey"]
    return out.select(*keep)
