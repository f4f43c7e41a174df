"""Lines that many sites share.

Per line hash a HyperLogLog sketch of the sites it stands on is built where
the lines are read and merged by the aggregation. Sketches decide clear cases;
lines whose estimate is near the threshold get an exact distinct count. Of a
line on ``min_sites`` sites or more the first occurrence stays (smallest
doc_id, then place), so that a text copied to many sites is not lost; all
others are removed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import free, row_key, saved

MIN_SITES = 5
LG_K = 10  # 1,024 registers
ERROR = 1.04 / 2 ** (LG_K / 2)


def shared_lines(lines: DataFrame, min_sites: int = MIN_SITES) -> DataFrame:
    """(hash, first): hashes on ``min_sites`` sites or more, and their first occurrence (doc_id, key, pos).

    ``lines`` has hash, site, doc_id, key, pos. Rows without a site add none.
    """
    sketches = saved(lines.groupBy("hash").agg(F.hll_sketch_agg(F.col("site"), F.lit(LG_K)).alias("sketch"), F.min(F.struct("doc_id", "key", "pos")).alias("first"), F.count("site").alias("n"))
                     .filter(F.col("n") >= min_sites).select("hash", "first", F.hll_sketch_estimate("sketch").alias("sites")), "line-sketches")
    margin = 4 * ERROR * min_sites + 1
    sure = sketches.filter(F.col("sites") > min_sites + margin).select("hash", "first")
    near = sketches.filter(F.col("sites").between(min_sites - margin, min_sites + margin)).select("hash", "first")
    exact = (lines.join(near.select("hash"), "hash", "left_semi").select("hash", "site").distinct()
             .groupBy("hash").agg(F.count("site").alias("sites")).filter(F.col("sites") >= min_sites).select("hash"))
    return saved(sure.unionByName(near.join(exact, "hash", "left_semi")), "line-shared")


def remove_shared_lines(docs: DataFrame, min_sites: int = MIN_SITES, id_col: str = "doc_id", text_col: str = "text", site_col: str = "source") -> DataFrame:
    """All rows and columns of ``docs``, with ``text_col`` cleaned, and n_lines, n_removed.

    A line counts without the blanks around it; blank lines are neither
    counted nor removed. NULL texts stay NULL with no lines. No row is
    dropped, a text may become empty. Rows alike in id and text are cleaned
    alike. Columns n_lines and n_removed of ``docs`` are replaced. An empty table gives an empty result.
    """
    key = row_key(id_col, text_col)
    parts = F.split(F.col(text_col), "\n")
    rows = docs.select(key.alias("key"), F.col(id_col).alias("doc_id"), F.col(site_col).cast("string").alias("site"), F.posexplode_outer(parts).alias("pos", "line"))
    lines = saved(rows.withColumn("line", F.trim("line")).filter("line != ''")
                  .select("key", "doc_id", "site", "pos", F.xxhash64("line").alias("hash")), "lines")
    shared = shared_lines(lines, min_sites)
    hits = (lines.select("hash", "key", "doc_id", "pos").join(shared, "hash")
            .filter(~F.struct("doc_id", "key", "pos").eqNullSafe(F.col("first"))).select("key", "pos").distinct())
    # 64 places to a number, so that finding a line's mark in a long text stays cheap
    words = hits.groupBy("key", (F.floor(F.col("pos") / 64)).cast("int").alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, pos % 64)")).alias("bits"))
    own, marked, gone = free(docs, "_key"), free(docs, "_marks"), free(docs, "_gone")
    marks = saved(words.groupBy(F.col("key").alias(own)).agg(F.map_from_entries(F.collect_list(F.struct("word", "bits"))).alias(marked), F.sum(F.bit_count("bits")).alias(gone)), "line-marks")
    stay = [F.col(f"`{c}`") for c in docs.columns if c not in ("n_lines", "n_removed")]
    # merged at every size: with few marks Spark would send them to the texts, with more shuffle these
    joined = docs.select(*stay, key.alias(own)).join(marks.hint("merge"), own, "left")
    kept = F.filter(parts, lambda line, i: F.bit_get(F.coalesce(F.col(marked)[F.floor(i / 64).cast("int")], F.lit(0).cast("long")), (i % 64).cast("int")) == 0)
    text = F.when(F.col(gone).isNull(), F.col(text_col)).otherwise(F.array_join(kept, "\n")).alias(text_col)
    return joined.select(*[text if c == text_col else F.col(f"`{c}`") for c in docs.columns if c not in ("n_lines", "n_removed")],
                         F.coalesce(F.size(F.filter(parts, lambda x: F.trim(x) != "")), F.lit(0)).alias("n_lines"), F.coalesce(gone, F.lit(0)).cast("int").alias("n_removed"))


def remove_shared_lines_sql(min_sites: int = MIN_SITES) -> str:
    """The digest of the query op7 for the table ``documents``, in DuckDB's SQL."""
    return f"""
WITH parts AS (
  SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM documents WHERE text IS NOT NULL),
shared AS (
  SELECT trim(line, ' ') AS line, min((doc_id, pos)) AS first FROM parts WHERE trim(line, ' ') <> ''
  GROUP BY 1 HAVING count(DISTINCT source) >= {min_sites}),
marked AS (
  SELECT p.doc_id, p.pos, p.line, trim(p.line, ' ') <> '' AS counted, s.line IS NOT NULL AND (p.doc_id, p.pos) <> s.first AS gone
  FROM parts p LEFT JOIN shared s ON trim(p.line, ' ') = s.line),
cleaned AS (
  SELECT doc_id, coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '') AS text, count(*) FILTER (WHERE counted) AS n_lines, count(*) FILTER (WHERE gone) AS n_removed
  FROM marked GROUP BY doc_id)
SELECT d.doc_id, CAST(coalesce(c.n_lines, 0) AS INTEGER) AS n_lines, CAST(coalesce(c.n_removed, 0) AS INTEGER) AS n_removed, md5(c.text) AS text_md5
FROM documents d LEFT JOIN cleaned c ON d.doc_id = c.doc_id"""
