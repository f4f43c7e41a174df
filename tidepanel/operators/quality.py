"""Data-quality operators whose results are DataFrames (DQ1–DQ13).

Counts and duplicate checks of a suite compile into ONE aggregate over grouping
sets (a single scan and shuffle, with map-side partial aggregation); an in-set
check adds the distinct values outside its set. Lists in reports are bounded: missing members are
limited by the expected set, periods by the calendar range, samples by ``k``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepanel.functions.numeric import np_round

# Reason formats of the checks whose outcome is known without a scan.
REASONS = {
    "cols_exact": "Expected {expected} cols, got {actual}",
    "dup_missing": "Columns not found: {cols}",
    "missing_col": "Column '{col}' not found",
    "unknown": "Unknown check type",
}

RESULT_SCHEMA = "dataset string, layer string, check_no int, `check` string, `column` string, ok boolean, reason string"


# ── DQ2 ─────────────────────────────────────────────────────────────────────
def null_profile(df: DataFrame, cols: Sequence[str] | None = None, digits: int | None = 2) -> DataFrame:
    """% NULL per column, all columns in one pass -> tall (ordinal, column, null_pct)."""
    cols = list(cols or df.columns)
    one = df.agg(*[F.avg(F.col(c).isNull().cast("double")).alias(f"c{i}") for i, c in enumerate(cols)])
    structs = [F.struct(F.lit(i).alias("ordinal"), F.lit(c).alias("column"),
                        np_round(F.coalesce(F.col(f"c{i}"), F.lit(0.0)) * F.lit(100.0), digits).alias("null_pct"))
               for i, c in enumerate(cols)]
    return one.select(F.inline(F.array(*structs)))


# ── DQ13 ────────────────────────────────────────────────────────────────────
def frame_summary(df: DataFrame, entity: str = "country_code", period: str = "year") -> DataFrame:
    """Shape, total NULL cells, distinct entities and periods — one aggregation."""
    nulls = sum((F.col(c).isNull().cast("bigint") for c in df.columns), F.lit(0).cast("bigint"))
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.lit(len(df.columns)).alias("n_cols"),
                  F.sum(nulls).alias("total_nulls"), F.countDistinct(entity).alias("n_entities"),
                  F.countDistinct(period).alias("n_periods"))


# ── DQ1 ─────────────────────────────────────────────────────────────────────
def quality_report(before: DataFrame, after: DataFrame, dataset: str, thresholds: Mapping[str, float],
                   expected_members: Sequence[str] = (), start: int | None = None, end: int | None = None,
                   entity: str = "country_code", period: str = "year", members: str = "all") -> DataFrame:
    """One-row report: rows before/after/dropped, coverage, threshold flags, gaps.

    Flags: a column whose NULL % is strictly above its threshold, members of
    ``expected_members`` with no rows, periods of [start, end] with no rows;
    "OK" when there are none. ``members_covered`` lists the members that have
    rows: ``members="all"`` of them, for panels whose entities fit a cell, or
    those ``"expected"``, which never outgrow the list given; ``covered_members``
    has a row per member of any panel. ``periods_covered`` lists the periods,
    those of [start, end] if given.
    """
    if members not in ("all", "expected"):
        raise ValueError("members must be 'all' or 'expected'")
    listed = F.col(entity) if members == "all" else F.when(F.col(entity).isin(list(expected_members)), F.col(entity))
    cols = after.columns
    a = after.agg(
        F.count(F.lit(1)).alias("rows_after"),
        F.countDistinct(entity).alias("n_entities"),
        F.array_sort(F.collect_set(F.when(F.col(period).between(start, end) if start is not None and end is not None else F.lit(True),
                                          F.col(period).cast("bigint")))).alias("__periods"),
        *[F.avg(F.col(c).isNull().cast("double")).alias(f"__n{i}") for i, c in enumerate(cols)],
        F.collect_set(listed).alias("__present"),
    )
    r = a.withColumn("rows_before", before.select(F.count(F.lit(1))).scalar())
    flags = []
    for i, c in enumerate(cols):
        if c in thresholds:
            pct = np_round(F.coalesce(F.col(f"__n{i}"), F.lit(0.0)) * F.lit(100.0), 2)
            thr = float(thresholds[c])
            flags.append(F.when(pct > F.lit(thr), F.concat(F.lit(f"WARN: '{c}' has "), pct.cast("string"),
                                                           F.lit(f"% nulls (threshold: {thr}%)"))))
    if expected_members:
        missing = F.array_sort(F.array_except(F.array(*[F.lit(m) for m in expected_members]), F.col("__present")))
    else:
        missing = F.array().cast("array<string>")
    if start is not None and end is not None:
        missing_p = F.array_except(F.sequence(F.lit(start).cast("bigint"), F.lit(end).cast("bigint")), F.col("__periods"))
    else:
        missing_p = F.array().cast("array<bigint>")
    r = r.withColumns({"__mm": missing, "__mp": missing_p})
    flags.append(F.when(F.size("__mm") > 0, F.concat(F.lit("members without data: "), F.array_join("__mm", ","))))
    flags.append(F.when(F.size("__mp") > 0, F.concat(F.lit("periods without data: "),
                                                     F.array_join(F.col("__mp").cast("array<string>"), ","))))
    flag_arr = F.filter(F.array(*flags), lambda x: x.isNotNull())
    return r.select(
        F.lit(dataset).alias("dataset"), "rows_before", "rows_after",
        (F.col("rows_before") - F.col("rows_after")).alias("rows_dropped"),
        F.col("n_entities").alias("entities_covered"),
        F.array_join(F.array_sort(F.col("__present")), ",").alias("members_covered"),
        F.array_join(F.col("__periods").cast("array<string>"), ",").alias("periods_covered"),
        F.array_join("__mm", ",").alias("missing_members"),
        F.array_join(F.col("__mp").cast("array<string>"), ",").alias("missing_periods"),
        F.to_json(F.create_map(*[x for i, c in enumerate(cols) for x in (
            F.lit(c), np_round(F.coalesce(F.col(f"__n{i}"), F.lit(0.0)) * F.lit(100.0), 2))]))
        .alias("null_pct_by_column"),
        F.when(F.size(flag_arr) == 0, F.lit("OK - no alerts")).otherwise(F.array_join(flag_arr, " | "))
        .alias("quality_flags"),
    )


def covered_members(df: DataFrame, expected_members: Sequence[str] = (), entity: str = "country_code", period: str = "year") -> DataFrame:
    """DQ1 as rows: ``member``, whether it is ``expected``, its rows and periods. Expected members without rows have 0; NULL is no member."""
    have = (df.where(F.col(entity).isNotNull()).groupBy(F.col(entity).cast("string").alias("member"))
            .agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct(period).alias("n_periods")))
    expected = df.sparkSession.createDataFrame([(m,) for m in dict.fromkeys(expected_members)], "member string").withColumn("expected", F.lit(True))
    return have.join(expected, "member", "full_outer").select(
        "member", F.coalesce("expected", F.lit(False)).alias("expected"), *[F.coalesce(c, F.lit(0)).alias(c) for c in ("n_rows", "n_periods")])


# ── DQ12 ────────────────────────────────────────────────────────────────────
def coverage_report(df: DataFrame, start: int, end: int, expected_members: Sequence[str] = (),
                    entity: str = "country_code", period: str = "year") -> DataFrame:
    """Per entity: rows, periods of [start, end] present, and the missing ones.

    Entities of ``expected_members`` with no rows at all are included with 0.
    Only incomplete entities are returned (complete coverage -> empty frame).
    """
    need = end - start + 1
    full = F.sequence(F.lit(start).cast("bigint"), F.lit(end).cast("bigint"))
    have = (df.where(F.col(period).between(start, end)).groupBy(entity)
            .agg(F.count(F.lit(1)).alias("n_rows"), F.collect_set(F.col(period).cast("bigint")).alias("__p")))
    if expected_members:
        exp = df.sparkSession.createDataFrame([(m,) for m in expected_members], f"{entity} string")
        absent = exp.join(have.select(entity), entity, "left_anti") \
            .select(entity, F.lit(0).cast("bigint").alias("n_rows"), F.array().cast("array<bigint>").alias("__p"))
        have = have.unionByName(absent)
    return (have.where(F.col("n_rows") < need)
            .select(entity, "n_rows", F.array_join(F.array_sort(F.array_except(full, F.col("__p"))).cast("array<string>"),
                                                   ",").alias("missing_periods")))


def row_count_by_entity(df: DataFrame, entity: str = "country_code") -> DataFrame:
    """Rows per entity."""
    return df.groupBy(entity).agg(F.count(F.lit(1)).alias("n_rows"))


# ── DQ11 ────────────────────────────────────────────────────────────────────
def ingest_gate(df: DataFrame, max_null_pct: Mapping[str, float]) -> DataFrame:
    """One row per gated column: NULL %, limit, ok (plus a ``__rows`` row: non-empty).

    One aggregate. A gated column that the frame lacks fails, and so do all
    columns of an empty frame (their NULL % is NULL).
    """
    here = [c for c in max_null_pct if c in df.columns]
    one = df.agg(F.count(F.lit(1)).alias("n"), *[F.avg(F.col(c).isNull().cast("double")).alias(f"n{i}") for i, c in enumerate(here)])

    def row(i: int, name: str, pct: Column, limit: float | None, ok: Column) -> Column:
        return F.struct(F.lit(i).alias("ordinal"), F.lit(name).alias("column"), pct.cast("double").alias("null_pct"),
                        F.lit(limit).cast("double").alias("max_null_pct"), F.coalesce(ok, F.lit(False)).alias("ok"))

    out = [row(-1, "__rows", F.lit(None), None, F.col("n") > 0)]
    for i, (c, limit) in enumerate(max_null_pct.items()):
        pct = F.col(f"n{here.index(c)}") * 100.0 if c in here else F.lit(None)
        out.append(row(i, c, pct, float(limit), pct <= F.lit(float(limit)) if c in here else F.lit(False)))
    return one.select(F.inline(F.array(*out)))


def gate_metrics(cols: Sequence[str]) -> list[Column]:
    """Aggregates that ``gate_violations`` judges: rows, and NULLs per column."""
    return [F.count(F.lit(1)).alias("rows"), *[F.count(F.when(F.col(c).isNull(), 1)).alias(f"nulls_{c}") for c in cols]]


def gate_violations(metrics: Mapping[str, int], max_null_pct: Mapping[str, float]) -> list[str]:
    """Columns above their NULL % limit, or not measured; ``__rows`` if there are no rows."""
    rows = int(metrics["rows"])
    if not rows:
        return ["__rows"]
    return [c for c, limit in max_null_pct.items() if int(metrics.get(f"nulls_{c}", rows)) / rows * 100.0 > limit]


def enforce_gate(gate: DataFrame) -> None:
    """Raise on the driver if any gate row failed (the gate frame has one row per column)."""
    bad = [r["column"] for r in gate.where(~F.coalesce("ok", F.lit(False))).select("column").collect()]
    if bad:
        raise ValueError(f"ingest gate failed for: {bad}")


# ── DQ3–DQ10 ────────────────────────────────────────────────────────────────
def _fmt(v) -> str:
    return str(v)


def _result(dataset, layer, i, check, column, ok: Column, reason: Column) -> Column:
    return F.struct(F.lit(dataset).alias("dataset"), F.lit(layer).alias("layer"), F.lit(i).alias("check_no"),
                    F.lit(check).alias("check"), F.lit(column).cast("string").alias("column"), ok.alias("ok"),
                    F.when(~ok, reason).alias("reason"))


def run_suite(df: DataFrame, checks: Sequence[Mapping], dataset: str, layer: str) -> DataFrame:
    """Run a declarative suite; one result row per check, never raises.

    Check types: table_row_count (expected_value / min_value), column_count,
    column_values_to_not_be_null (threshold_pct), column_values_to_be_between,
    column_values_in_set (NULL counts as invalid), column_values_type (int /
    float), no_duplicates (columns). Unknown types and missing columns fail.
    """
    cols = set(df.columns)
    aggs: dict[str, Column] = {"__rows": F.count(F.lit(1))}
    rows: list[Column] = []
    extra: list[DataFrame] = []
    unique: dict[int, list[str]] = {}

    def const(i, t, c, ok, reason):
        rows.append(_result(dataset, layer, i, t, c, F.lit(ok), F.lit(reason)))

    for i, ch in enumerate(checks):
        t = ch.get("type")
        c = ch.get("column")
        if t == "table_row_count":
            n = F.col("__rows")
            exp, mn = ch.get("expected_value"), ch.get("min_value")
            ok, reason = F.lit(True), F.lit(None).cast("string")
            if exp is not None:
                reason = F.when(n != exp, F.concat(F.lit(f"Expected {exp} rows, got "), n.cast("string")))
                ok = n == exp
            if mn is not None:
                bad_min = n < mn
                reason = F.coalesce(reason, F.when(bad_min, F.concat(F.lit(f"Expected min {mn} rows, got "),
                                                                     n.cast("string"))))
                ok = ok & ~bad_min
            rows.append(_result(dataset, layer, i, t, None, ok, reason))
        elif t == "column_count":
            exp = ch["expected_value"]
            const(i, t, None, len(df.columns) == exp, REASONS["cols_exact"].format(expected=exp, actual=len(df.columns)))
        elif t in ("column_values_to_not_be_null", "column_values_to_be_between", "column_values_type",
                   "column_values_in_set") and c not in cols:
            const(i, t, c, False, REASONS["missing_col"].format(col=c))
        elif t == "column_values_to_not_be_null":
            thr = ch.get("threshold_pct", 0.0)
            aggs[f"__nn{i}"] = F.count(F.when(F.col(c).isNull(), 1))
            n = F.col(f"__nn{i}")
            pct = F.when(F.col("__rows") > 0, n / F.col("__rows") * F.lit(100.0)).otherwise(F.lit(0.0))
            reason = F.concat(n.cast("string"), F.lit(" nulls ("), F.format_string("%.1f", np_round(pct, 1)),
                              F.lit(f"%) exceeds threshold {_fmt(thr)}%"))
            rows.append(_result(dataset, layer, i, t, c, pct <= F.lit(float(thr)), reason))
        elif t == "column_values_to_be_between":
            lo, hi = ch.get("min_value"), ch.get("max_value")
            v = F.col(c)
            aggs[f"__bt{i}"] = F.count(F.when(v.isNotNull() & ((v < lo) | (v > hi)), 1))
            n = F.col(f"__bt{i}")
            rows.append(_result(dataset, layer, i, t, c, n == 0,
                                F.concat(n.cast("string"), F.lit(f" values outside [{lo}, {hi}]"))))
        elif t == "column_values_type":
            et = ch.get("expected_type", "float")
            parsed = F.col(c).cast("string").try_cast("double")
            bad = parsed.isNull() if et == "int" else (F.col(c).isNotNull() & parsed.isNull())
            aggs[f"__ty{i}"] = F.count(F.when(bad, 1))
            n = F.col(f"__ty{i}")
            rows.append(_result(dataset, layer, i, t, c, n == 0,
                                F.concat(n.cast("string"), F.lit(f" values not parseable as {et}"))))
        elif t == "column_values_in_set":
            extra.append(_in_set(df, c, ch["value_set"], dataset, layer, i))
        elif t == "no_duplicates":
            subset = list(ch.get("columns") or ch.get("subset") or [])
            miss = [x for x in subset if x not in cols]
            if miss:
                const(i, t, ",".join(subset), False, REASONS["dup_missing"].format(cols=miss))
            else:
                unique[i] = subset
                n = F.col(f"__dup{i}")
                rows.append(_result(dataset, layer, i, t, ",".join(subset), n == 0, F.concat(n.cast("string"), F.lit(" duplicate rows found"))))
        else:
            const(i, t, c, False, REASONS["unknown"])
    stats = _counts(df, aggs, unique) if rows else None
    out = stats.select(F.inline(F.array(*rows))) if rows else None
    for e in extra:
        out = e if out is None else out.unionByName(e)
    return out.orderBy("check_no") if out is not None else df.sparkSession.createDataFrame([], RESULT_SCHEMA)


def _counts(df: DataFrame, aggs: Mapping[str, Column], unique: Mapping[int, Sequence[str]]) -> DataFrame:
    """One row: the counts ``aggs``, and per entry of ``unique`` all rows in duplicated groups (NULL keys compare equal).

    All key sets, and the whole table as the empty one, are grouping sets of
    one aggregate: one scan, one shuffle by key, one row per task after it.
    """
    if not unique:
        return df.agg(*[v.alias(k) for k, v in aggs.items()])
    keys = list(dict.fromkeys(c for subset in unique.values() for c in subset))
    if not keys:  # a key without columns: all rows are one group
        n = aggs["__rows"]
        return df.agg(*[v.alias(k) for k, v in aggs.items()], *[F.when(n > 1, n).otherwise(F.lit(0)).alias(f"__dup{i}") for i in unique])

    def number(subset: Sequence[str]) -> int:  # grouping_id: a bit for each key column that is not in the set
        return sum(1 << (len(keys) - 1 - j) for j, c in enumerate(keys) if c not in subset)

    sets = {number(s): [c for c in keys if c in s] for s in ([], *unique.values())}
    grouped = df.groupingSets([[F.col(c) for c in s] for s in sets.values()], *[F.col(c) for c in keys]).agg(
        F.grouping_id().alias("__set"), *[v.alias(k) for k, v in aggs.items()])
    of = lambda s, c: F.when(F.col("__set") == number(s), F.col(c))
    # an empty table has no groups, not even the empty set's
    total = [F.coalesce(F.max(of([], k)), F.lit(0)).alias(k) for k in aggs]
    dups = [F.coalesce(F.sum(F.when(F.col("__rows") > 1, of(s, "__rows"))), F.lit(0)).alias(f"__dup{i}") for i, s in unique.items()]
    return grouped.agg(*total, *dups)


def _in_set(df: DataFrame, col: str, values, dataset, layer, i, k: int = 5) -> DataFrame:
    """Distinct values outside the set (NULL is invalid); the first k (sorted) are listed."""
    v = F.col(col)
    invalid = df.where(~F.coalesce(v.isin(list(values)), F.lit(False))).select(v.alias("v")).distinct()
    first_k = invalid.orderBy(F.col("v").asc_nulls_first()).limit(k)
    quoted = F.coalesce(F.concat(F.lit("'"), F.col("v").cast("string"), F.lit("'")), F.lit("None"))
    agg = first_k.agg(F.count(F.lit(1)).alias("n"),
                      F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(F.col("v").isNotNull().alias("nn"),
                                                                                     F.col("v").alias("v"),
                                                                                     quoted.alias("q")))),
                                               lambda s: s["q"]), ", ").alias("vals"))
    return agg.select(F.inline(F.array(_result(dataset, layer, i, "column_values_in_set", col, F.col("n") == 0,
                                               F.concat(F.lit("Invalid values: ["), F.col("vals"), F.lit("]"))))))


def suite_summary(results: DataFrame) -> DataFrame:
    """total / passed / failed and a summary line per (dataset, layer)."""
    g = results.groupBy("dataset", "layer").agg(F.count(F.lit(1)).alias("total_checks"),
                                                F.count(F.when(F.col("ok"), 1)).alias("passed"),
                                                F.count(F.when(~F.col("ok"), 1)).alias("failed"))
    return g.withColumn("summary", F.when(F.col("failed") == 0,
                                          F.format_string("%d/%d checks OK", "passed", "total_checks"))
                        .otherwise(F.format_string("⚠️ %d/%d checks FAILED", "failed", "total_checks")))


def suite_report(df: DataFrame, checks: Sequence[Mapping], dataset: str, layer: str) -> DataFrame:
    """DQ10 report row: total / passed / failed / summary plus table stats (rows, columns)."""
    res = suite_summary(run_suite(df, checks, dataset, layer))
    n_rows = df.select(F.count(F.lit(1))).scalar()
    return res.withColumns({"n_rows": n_rows, "n_cols": F.lit(len(df.columns))})
