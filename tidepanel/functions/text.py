"""Name / code normalisation expressions."""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepanel.functions._col import as_col


def alias_lookup(c, aliases: Mapping[str, str]) -> Column:
    """Map known aliases to a canonical name; anything else passes through."""
    c = as_col(c)
    if not aliases:
        return c
    m = F.create_map(*[x for k, v in aliases.items() for x in (F.lit(k), F.lit(v))])
    return F.coalesce(F.element_at(m, c), c)


# fixed values: the white space of Unicode, which stripping removes at both ends
_WHITE = " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"


def clean_code(c) -> Column:
    return F.upper(clean_name(c))


def clean_name(c) -> Column:
    """Without white space of any kind at both ends."""
    return F.btrim(as_col(c).cast("string"), F.lit(_WHITE))


def snake_name(name: str) -> str:
    return re.sub(r"\s+", "_", name.strip().lower())


def normalize_column_names(df: DataFrame) -> DataFrame:
    """Lower-case column names and replace whitespace runs with ``_``."""
    return df.toDF(*[snake_name(c) for c in df.columns])
