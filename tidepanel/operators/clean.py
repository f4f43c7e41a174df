"""Typing, filtering, de-duplication and column housekeeping (PF*, W1, W2)."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepanel.functions.numeric import to_numeric
from tidepanel.functions.text import clean_code, clean_name
from tidepanel.session import scratch_dir
from tidepanel.spec import PanelKey, SchemaSpec

DEFAULT_KEY = PanelKey(("country_code",), "year")


def _cols(x) -> list[str]:
    return [x] if isinstance(x, str) else list(x)


# ── PF7 ─────────────────────────────────────────────────────────────────────
def apply_schema(df: DataFrame, spec: SchemaSpec, key: PanelKey = DEFAULT_KEY, name_col: str = "country",
                 on_null_period: str = "raise") -> DataFrame:
    """Check required columns, coerce numerics, type the key columns.

    numerics -> double (unparsable -> NULL); period -> bigint; entity code
    -> upper(trim); entity name -> trim. A NULL period raises at run time
    (``on_null_period="raise"``), or the row is dropped (``"drop"``) or kept
    (``"keep"``); ``quarantine`` keeps refused rows apart.
    """
    out = df.select(*_typed(df, spec, key, name_col, on_null_period))
    return out.where(F.col(key.period).isNotNull()) if on_null_period == "drop" else out


def _typed(df: DataFrame, spec: SchemaSpec, key: PanelKey, name_col: str, on_null_period: str) -> list[Column]:
    """The typed column for each column of ``df``."""
    missing = [c for c in spec.required if c not in df.columns]
    if missing:
        raise ValueError(f"missing required columns: {missing}")
    exprs = []
    types = dict(df.dtypes)
    for c in df.columns:
        if c in spec.numeric:
            e = to_numeric(c)
        elif c == key.period:
            # "2020", 2020.0 -> 2020; 2020.5, "x" -> NULL
            e = F.col(c).cast("bigint") if types[c] in ("bigint", "int", "smallint", "tinyint") else to_numeric(c, "bigint")
            if on_null_period == "raise":
                e = F.when(e.isNull(), F.raise_error(F.lit(f"NULL or non-integer {c}"))).otherwise(e)
        elif c in key.entity:
            e = clean_code(c)
        elif c == name_col:
            e = clean_name(c)
        else:
            e = F.col(c)
        exprs.append(e.alias(c))
    return exprs


class Quarantined(NamedTuple):
    """A typed frame and what was refused: ``rejects`` has a row per refused row, ``reasons`` one per cell found wrong."""

    accepted: DataFrame
    rejects: DataFrame
    reasons: DataFrame


def quarantine(df: DataFrame, spec: SchemaSpec, key: PanelKey = DEFAULT_KEY, name_col: str = "country", strict: Sequence[str] = ()) -> Quarantined:
    """``apply_schema`` that keeps what it refuses, split off in the same pass.

    A row without a usable period is refused, and one with an unparsable value
    in a column of ``strict``; other unparsable numbers become NULL and are
    reported. ``accepted`` has the typed columns; ``rejects`` (row, source: the
    row as JSON, n_reasons); ``reasons`` (row, column, value, reason,
    rejected). Accepted and refused rows together are the rows of ``df``. The
    source runs once, into the shared scratch folder, when this is called.
    """
    number = set(spec.numeric)

    def problem(c: str, typed_value: Column, fatal: bool, what: str, null_too: bool) -> Column:
        raw = F.col(f"__raw.`{c}`").cast("string")
        missing = raw.isNull() | (F.lower(F.trim(raw)) == "nan")
        cell = lambda reason: F.struct(F.lit(c).alias("column"), raw.alias("value"), F.lit(reason).alias("reason"), F.lit(fatal).alias("rejected"))
        found = F.when(~missing & typed_value.isNull(), cell(what))
        return F.when(missing, cell("is missing")).otherwise(found) if null_too else found

    checks = [problem(key.period, F.col(f"__typed.`{key.period}`"), True, "not an integer", True)]
    checks += [problem(c, F.col(f"__typed.`{c}`"), c in strict, "not a number", False) for c in df.columns if c in number]
    cells = dict(zip(df.columns, _typed(df, spec, key, name_col, "keep")))
    raw = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    rows = df.select(raw.alias("__raw"), F.struct(*[e.alias(c) for c, e in cells.items()]).alias("__typed"))
    rows = rows.withColumn("__reasons", F.array_compact(F.array(*checks))).withColumn("__refused", F.exists("__reasons", lambda r: r["rejected"]))
    rows = rows.select(F.monotonically_increasing_id().alias("__row"), "__typed", "__reasons", "__refused", F.when(F.col("__refused"), F.to_json("__raw", {"ignoreNullFields": "false"})).alias("__source"))
    path = scratch_dir(df.sparkSession, "quarantine")
    rows.write.partitionBy("__refused").parquet(path)
    done = df.sparkSession.read.schema(rows.schema).parquet(path)
    refused = done.where("__refused")
    return Quarantined(done.where("not __refused").select("__typed.*"),
                       refused.select(F.col("__row").alias("row"), F.col("__source").alias("source"), F.size("__reasons").alias("n_reasons")),
                       done.select(F.col("__row").alias("row"), F.explode("__reasons").alias("r")).select("row", "r.*"))


# ── W1 ──────────────────────────────────────────────────────────────────────
# Order of rows as read from files: the hidden file-source metadata columns.
READ_ORDER = ("_metadata.file_path", "_metadata.row_index")


def dedup_first(df: DataFrame, key: Sequence[str], order_by: str | Sequence[str]) -> DataFrame:
    """One row per key: the row with the smallest ``order_by`` value.

    Implemented as a hash aggregate (``min_by`` of a struct), which combines
    map-side before the shuffle — a duplicate group holding a large share of
    the rows never lands in one task. The order must be named, as rows have
    none of their own: a column that numbers them, or ``READ_ORDER`` for
    DataFrames read straight from files (Parquet/CSV/JSON file sources).
    """
    key = _cols(key)
    others = [c for c in df.columns if c not in key]
    if not others:
        return df.select(*key).distinct()
    payload = F.struct(*[F.col(c) for c in others])
    pick = F.min_by(payload, F.struct(*[F.col(c) for c in _cols(order_by)]))
    return df.groupBy(*key).agg(pick.alias("__first")).select(*key, "__first.*").select(*df.columns)


# ── W2 ──────────────────────────────────────────────────────────────────────
def flag_duplicates(df: DataFrame, key: Sequence[str], flag: str = "is_duplicate") -> DataFrame:
    """Mark every member of a duplicated key (keep=False); NULL keys match.

    Counts come from a partially aggregated groupBy; only keys with count > 1
    are joined back (AQE splits a skewed hot key on the large side).
    """
    key = _cols(key)
    dups = df.groupBy(*key).count().where(F.col("count") > 1).select(*key, F.lit(True).alias(flag))
    left, right = df.alias("__l"), dups.alias("__r")
    cond = None
    for k in key:
        c = F.col(f"__l.`{k}`").eqNullSafe(F.col(f"__r.`{k}`"))
        cond = c if cond is None else cond & c
    joined = left.join(right, on=cond, how="left")
    return joined.select(*[F.col(f"__l.`{c}`").alias(c) for c in df.columns],
                         F.coalesce(F.col(f"__r.`{flag}`"), F.lit(False)).alias(flag))


# ── PF8 / PF9 / PF10 ────────────────────────────────────────────────────────
def drop_empty_rows(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """Drop rows where ALL listed (existing) columns are NULL; no-op if none exist."""
    existing = [c for c in cols if c in df.columns]
    if not existing:
        return df
    return df.dropna(how="all", subset=existing)


def drop_any_null(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    return df.dropna(how="any", subset=list(cols))


def positive_filter(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    cond = None
    for c in cols:
        e = F.col(c) > 0
        cond = e if cond is None else cond & e
    return df.where(cond)


# ── PF2 / PF3 ───────────────────────────────────────────────────────────────
def filter_members(df: DataFrame, col: str, members) -> DataFrame:
    """Keep rows whose ``col`` is in ``members`` (a list, or a one-column DataFrame).

    A literal list becomes an ``IN`` predicate (pushed to the scan); a
    DataFrame allow-list becomes a left-semi join that Spark may broadcast.
    """
    if isinstance(members, DataFrame):
        m = members.select(F.col(members.columns[0]).alias(col)).distinct()
        return df.join(m, on=col, how="left_semi")
    return df.where(F.col(col).isin(list(members)))


def filter_period(df: DataFrame, start, end, period: str = "year") -> DataFrame:
    """``start <= period <= end`` — prunes Hive partitions when period is a partition column."""
    return df.where(F.col(period).between(start, end))


# ── PF4 ─────────────────────────────────────────────────────────────────────
def select_available(df: DataFrame, wanted: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """Project the wanted columns that exist; also return the missing ones."""
    present = [c for c in wanted if c in df.columns]
    missing = [c for c in wanted if c not in df.columns]
    return df.select(*present), missing


# ── PF5 ─────────────────────────────────────────────────────────────────────
def map_code(df: DataFrame, col: str, out: str, codes: Mapping[str, str] | DataFrame) -> DataFrame:
    """Look up ``col`` in a name -> code table; unmatched -> NULL.

    A small dict becomes a literal map (no join); a DataFrame table is reduced
    to one code per name and joined left (Spark broadcasts it when its size is
    under the threshold).
    """
    if isinstance(codes, DataFrame):
        k, v = codes.columns[:2]
        # one code per name (a lookup never multiplies rows); deterministic on duplicates
        t = codes.groupBy(F.col(k).alias("__k")).agg(F.max(v).alias(out))
        return df.join(t, df[col] == t["__k"], "left").drop("__k")
    m = F.create_map(*[x for a, b in codes.items() for x in (F.lit(a), F.lit(b))])
    return df.withColumn(out, F.try_element_at(m, F.col(col)))


# ── PF11 / PF12 ─────────────────────────────────────────────────────────────
def reorder_columns(df: DataFrame, keys: Sequence[str], original: Sequence[str], derived: Sequence[str]) -> DataFrame:
    """keys, then original metrics, then derived metrics, then everything else."""
    cols = df.columns
    first = [c for c in keys if c in cols]
    orig = [c for c in cols if c in set(original) and c not in first]
    der = [c for c in cols if c in set(derived) and c not in first]
    rest = [c for c in cols if c not in set(first) | set(orig) | set(der)]
    return df.select(*first, *orig, *der, *rest)


# ── PF14 ────────────────────────────────────────────────────────────────────
def latest_period(df: DataFrame, period: str = "year", valid: Column | None = None) -> DataFrame:
    """Rows of the latest period; with ``valid``, the latest period that has valid rows.

    The max is a scalar subquery evaluated once — no global window.
    """
    base = df if valid is None else df.where(valid)
    latest = base.select(F.max(period)).scalar()
    return base.where(F.col(period) == latest)


# ── PF15 ────────────────────────────────────────────────────────────────────
# Public metric names of the custom slice and their columns
# (per-capita emissions are the derived column of the silver layer).
SLICE_METRICS = {
    "co2": "co2",
    "arrivals": "tourist_arrivals",
    "co2_per_capita": "co2_per_capita_calc",
    "yoy": "arrivals_growth_pct",
}


def custom_slice(df: DataFrame, countries: Sequence[str], metric: str, start: int, end: int,
                 entity: str = "country_code", name: str = "country", period: str = "year",
                 metrics: Mapping[str, str] = SLICE_METRICS, require_rows: bool = False) -> DataFrame:
    """Parametrised slice: members (empty = all) x metric x [start, end].

    ``require_rows`` raises when the slice is empty (checked with a one-row probe).
    """
    if start > end:
        raise ValueError("start must be <= end")
    if metric not in metrics:
        raise ValueError(f"unknown metric {metric!r}; valid: {sorted(metrics)}")
    col = metrics[metric]
    out = df
    if countries:
        out = out.where(F.col(entity).isin(list(countries)))
    out = out.where(F.col(period).between(start, end)).select(name, entity, period, F.col(col).alias("value"))
    if require_rows and not out.limit(1).collect():
        raise ValueError("no rows for the requested slice")
    return out
