"""Segmented scans: what a window over a whole entity gives, span by span.

An entity's periods (numbers) are cut in spans. What a span passes on is a
small state: its number of rows, and per column the first and the last known
value with their places. States combine in order, so what holds before and
after each span comes from a window over one row per span, and each span is
then scanned on its own with what is carried into it. A task holds one span
and one row for each of the entity's others, however long the entity is.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidepanel.spec import PanelKey

SPAN, POS, FROM = "__span", "__pos", "__from"
_UNTIL = (Window.unboundedPreceding, Window.currentRow)
_EARLIER = (Window.unboundedPreceding, -1)


def _cut(df: DataFrame, span: int, key: PanelKey) -> DataFrame:
    """Rows with their span, and their place in it from 1."""
    own = Window.partitionBy(*key.entity, SPAN).orderBy(key.period)
    return df.withColumn(SPAN, F.floor(F.col(key.period) / F.lit(span))).withColumn(POS, F.row_number().over(own))


def _with_states(rows: DataFrame, states: DataFrame, key: PanelKey) -> DataFrame:
    """Each row with the columns of its span's state; NULL entities and periods are values like others."""
    on = [*key.entity, SPAN]
    states = states.withColumnsRenamed({c: f"__s_{c}" for c in on})
    return rows.join(states, reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"__s_{c}")) for c in on])).drop(*[f"__s_{c}" for c in on])


def carried(df: DataFrame, cols: Sequence[str], span: int, key: PanelKey) -> DataFrame:
    """``df`` with its span, ``__pos`` (the row's place in its entity, from 1) and per column c the structs (v, x, r):

    ``__p_c``   value, period and place of the last known value up to the row
    ``__b_c``   the same up to the row before it in the span, or before the span
    ``__n_c``   the same of the first known value from the row on
    """
    ent, x = list(key.entity), F.col(key.period)
    rows = _cut(df, span, key)
    place = {c: F.when(F.col(c).isNotNull(), F.col(POS)) for c in cols}
    here = {c: F.struct(F.col(c).alias("v"), x.alias("x"), F.col(POS).alias("r")) for c in cols}
    states = rows.groupBy(*ent, SPAN).agg(F.count(F.lit(1)).alias("__n"), *[f(here[c], place[c]).alias(f"__{s}_{c}") for c in cols for s, f in (("first", F.min_by), ("last", F.max_by))])
    before = Window.partitionBy(*ent).orderBy(SPAN).rowsBetween(*_EARLIER)
    after = Window.partitionBy(*ent).orderBy(F.col(SPAN).desc()).rowsBetween(*_EARLIER)
    states = states.withColumn(FROM, F.coalesce(F.sum("__n").over(before), F.lit(0)))
    known = lambda s: F.when(F.col(s).isNotNull(), F.struct(F.col(s)["v"].alias("v"), F.col(s)["x"].alias("x"), (F.col(s)["r"] + F.col(FROM)).alias("r")))
    states = states.withColumns({f"__{s}_{c}": known(f"__{s}_{c}") for c in cols for s in ("first", "last")})
    states = states.select(*ent, SPAN, FROM, *[F.last(f"__last_{c}", ignorenulls=True).over(before).alias(f"__before_{c}") for c in cols],
                           *[F.last(f"__first_{c}", ignorenulls=True).over(after).alias(f"__after_{c}") for c in cols])
    rows = _with_states(rows, states, key).withColumn(POS, F.col(POS) + F.col(FROM))
    own = Window.partitionBy(*ent, SPAN)
    up, down = own.orderBy(POS), own.orderBy(F.col(POS).desc())
    value = {c: F.when(F.col(c).isNotNull(), F.struct(F.col(c).alias("v"), x.alias("x"), F.col(POS).alias("r"))) for c in cols}
    rows = rows.withColumns({f"__p_{c}": F.coalesce(F.last(v, ignorenulls=True).over(up.rowsBetween(*_UNTIL)), F.col(f"__before_{c}")) for c, v in value.items()}
                            | {f"__b_{c}": F.coalesce(F.last(v, ignorenulls=True).over(up.rowsBetween(*_EARLIER)), F.col(f"__before_{c}")) for c, v in value.items()})
    return rows.withColumns({f"__n_{c}": F.coalesce(F.last(v, ignorenulls=True).over(down.rowsBetween(*_UNTIL)), F.col(f"__after_{c}")) for c, v in value.items()})


def lagged(df: DataFrame, col: str, out: str, periods: int, span: int, key: PanelKey) -> DataFrame:
    """``df`` with ``out``: ``col`` of the row ``periods`` rows before, in the entity.

    A span's state is its last ``periods`` values; as a span has at least one
    row, those before a row lie in the ``periods`` spans before its own.
    """
    if periods < 1:
        raise ValueError("periods must be 1 or more")
    ent = list(key.entity)
    rows = _cut(df, span, key)
    cell = F.struct(F.col(POS).alias("r"), F.col(col).alias("v"))
    tail = lambda xs: F.slice(xs, F.greatest(F.size(xs) - periods, F.lit(0)) + 1, periods)
    states = rows.groupBy(*ent, SPAN).agg(tail(F.array_sort(F.collect_list(cell))).alias("__tail"))
    near = Window.partitionBy(*ent).orderBy(SPAN).rowsBetween(-periods, -1)
    states = states.select(*ent, SPAN, tail(F.flatten(F.collect_list("__tail").over(near))).alias("__tail"))
    own = Window.partitionBy(*ent, SPAN).orderBy(POS)
    earlier = F.get("__tail", F.size("__tail") - periods + F.col(POS) - 1)["v"]
    value = F.when(F.col(POS) > periods, F.lag(col, periods).over(own)).when(F.size("__tail") - periods + F.col(POS) - 1 >= 0, earlier)
    return _with_states(rows, states, key).withColumn(out, value).select(*df.columns, out)
