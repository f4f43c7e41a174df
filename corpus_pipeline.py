"""The corpus pipeline: language ID, line dedup, SimHash dedup, decontamination, packing.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir)
and returns a DataFrame, which ``run`` writes to the shared folder and reads
again as the next one's ``docs``. All but the last return the columns of
``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepanel.llm.common import row_key, saved, table, without
from tidepanel.llm.decontamination import contaminated
from tidepanel.llm.language import predict, train
from tidepanel.llm.lines import remove_shared_lines
from tidepanel.llm.packing import pack_documents
from tidepanel.llm.simhash import simhash_components

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a decided language, which replaces ``lang``.

    Rejected: texts that are NULL or have no letter, and ambiguous ones
    (languages equally near are). Learns from the rows that have a language;
    if none has, all are rejected. Repeated rows get the same decision each.
    An empty table gives an empty one.
    """
    own = docs.select(*COLUMNS)
    said = predict(own, train(own, F.lit(True)), COLUMNS)
    return said.filter((F.col("lang_pred") != "und") & ~F.col("ambiguous")).select("doc_id", "text", F.col("lang_pred").alias("lang"), "source", "n_chars")


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines of many sites, but for their first occurrence. No document goes.

    NULL and empty texts stay as they are, repeated rows are documents of
    their own. An empty table gives an empty one.
    """
    cleaned = remove_shared_lines(docs.select(*COLUMNS))
    return cleaned.withColumn("n_chars", F.when(F.col("n_removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(*COLUMNS)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates: one of the smallest doc_id.

    Documents without an id stay. Rows are told apart by id and text. An
    empty table gives an empty one.
    """
    own, key = docs.select(*COLUMNS), row_key("doc_id", "text")
    groups = saved(simhash_components(docs.select("doc_id", "text"), width=3, most=3, keyed=True), "simhash-groups")
    least = groups.filter(F.col("doc_id") == F.col("component_id"))
    repeated = saved(least.groupBy("doc_id").agg(F.min("doc_key").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1").select("doc_id", "first"), "simhash-repeated")
    gone = groups.filter(F.col("doc_id") != F.col("component_id")).select("doc_key")
    if repeated.isEmpty():
        return without(own, gone, key)
    left = without(own, gone.unionByName(least.join(repeated, "doc_id").filter(F.col("doc_key") != F.col("first")).select("doc_key")), key)
    alike = repeated.select(F.col("first").alias("_row"))
    one = left.withColumn("_row", key).join(alike, "_row").groupBy("_row").agg(F.min(F.struct(*COLUMNS)).alias("row"))
    return without(left, alike, key).unionByName(one.select("row.*"))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark passages.

    NULL and empty texts stay; of repeated rows all stay or all go. An empty
    table gives an empty one, an empty benchmark lets all stay.
    """
    found = contaminated(docs.select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    return without(docs.select(*COLUMNS), found.select("doc_key"), row_key("doc_id", "text"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 2048 tokens of all that is left.

    A NULL or empty text is its end id alone; repeated rows are packed as
    often as they occur. An empty table gives no pieces.
    """
    return pack_documents(docs.select("doc_id", "text"))


STAGES = [("language_id", language_id), ("line_dedup", line_dedup), ("simhash_dedup", simhash_dedup), ("decontaminate", decontaminate), ("packing", packing)]

# Trained classifiers, SimHash and a tokeniser are not SQL; tests hold the stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order, on the table ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
