"""The registered queries of this subpackage: name -> (build, SQL or None)."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .alignment import align_tokenizers
from .common import fold, table
from .decontamination import contaminated
from .embeddings import near_duplicate_vectors
from .graph_search import nearest_neighbours
from .hard_negatives import hard_negatives, hard_negatives_sql
from .language import predict, train
from .language_model import score_texts
from .lines import remove_shared_lines, remove_shared_lines_sql
from .packing import pack_documents
from .pii import digest, personal_data
from .quality import quality_scores
from .simhash import simhash_components
from .token_files import token_round_trip

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def _query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql:
            SQL[name] = sql
        return fn

    return deco


@_query("op2_token_files")
def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of all documents written and read back; start, number and crc32 of each."""
    return token_round_trip(table(spark, sf_dir, "documents"))


@_query("op8_best_fit_packing")
def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 2048 tokens."""
    return pack_documents(table(spark, sf_dir, "documents"))


@_query("op10_simhash_golay")
def op10_simhash_golay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash fingerprints of all documents (3-word shingles) and their components at 3 or fewer differing bits."""
    return simhash_components(table(spark, sf_dir, "documents"), width=3, most=3)


@_query("op4_language_codes")
def op4_language_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of all documents, learnt from those whose fold of 4 is not 2."""
    docs = table(spark, sf_dir, "documents").withColumn("held_out", fold("doc_id", 4) == 2)
    return predict(docs, train(docs, ~F.col("held_out")), ["doc_id", "held_out"])


@_query("op9_quality_trees")
def op9_quality_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of all documents, learnt from labels of those whose fold of 5 is not 0."""
    docs = table(spark, sf_dir, "documents").withColumn("held_out", fold("doc_id", 5) == 0)
    return quality_scores(docs, table(spark, sf_dir, "labels"), ~F.col("held_out"), keep=["doc_id", "held_out"])


@_query("op5_vector_neighbours")
def op5_vector_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links of all vectors at a cosine of 0.95 or more, and their components."""
    return near_duplicate_vectors(table(spark, sf_dir, "embeddings"), threshold=0.95)


@_query("op7_line_spread", remove_shared_lines_sql())
def op7_line_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the lines that stand on five or more sources, except where they stand first."""
    docs = remove_shared_lines(table(spark, sf_dir, "documents"))
    return docs.select("doc_id", "n_lines", "n_removed", F.md5(F.col("text").cast("binary")).alias("text_md5"))


@_query("op3_template_matches")
def op3_template_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents that hold benchmark items, also with other numbers, names and units."""
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("doc_key")


@_query("op1_personal_data")
def op1_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in all documents."""
    return digest(personal_data(table(spark, sf_dir, "documents")))


@_query("op6_elias_fano_lm")
def op6_elias_fano_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log probability of all documents, learnt from those whose fold of 7 is not 2."""
    return score_texts(table(spark, sf_dir, "documents"), fold("doc_id", 7) == 2)


@_query("op11_bond_negatives", hard_negatives_sql())
def op11_bond_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth vector; every seventh has the next label."""
    vectors, vec_id = table(spark, sf_dir, "embeddings"), F.col("vec_id")
    moved = F.when(vec_id % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(vectors.withColumn("label", moved), vec_id % 100 == 0)


@_query("op12_token_alignment")
def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How the byte-level BPE and the sentence pieces cut all documents."""
    return align_tokenizers(table(spark, sf_dir, "documents"))


@_query("op13_graph_neighbours")
def op13_graph_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest vectors of every fiftieth one."""
    return nearest_neighbours(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


_query("pipeline", corpus_pipeline.ORACLE_SQL)(corpus_pipeline.run)
