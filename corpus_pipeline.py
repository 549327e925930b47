"""A training corpus from the documents table: filter, dedup, decontaminate and pack.

Each stage takes what its predecessor kept and returns the columns of documents,
but for the last, which returns the packed pieces.  Other columns of documents are
left out.  An empty table gives no rows at any stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from notewright.llm import decontaminate, jaccard, line_dedup, pack, toxicity
from notewright.llm.common import table
from notewright.llm.queries import tokenizer_path

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _documents(docs: DataFrame) -> DataFrame:
    return docs.select(*COLUMNS)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score as toxic go.

    Null and empty texts score as texts without any sign, and stay.  Rows that repeat an id, or have none, are scored each
    by their own text.  Of several labels of an id the largest counts; a null one says nothing.
    """
    return toxicity.remove_toxic(_documents(docs), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that many documents share stay in one, that of the largest doc_id; n_chars follows the text.

    Null texts stay null.  Rows with one doc_id are one document, and all are cleaned; rows without are one, smaller than
    any other.  n_chars stays as it was, null or not, where no line goes.
    """
    cleaned = line_dedup.dedup_lines(_documents(docs))
    size = F.when(F.col("n_dropped") > 0, F.length("text").cast("long")).otherwise(F.col("rest.n_chars"))
    return cleaned.select("doc_id", "text", "rest.lang", "rest.source", size.alias("n_chars"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays, that of the smallest doc_id; of rows with that id and one text, one.

    Texts without words, null or empty, are no duplicates of anything, and stay.
    """
    return jaccard.one_of_each(_documents(docs))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of the benchmark go.

    Texts and items without words, null or empty, hold and are no window.  Rows are judged each by their own text.
    """
    return decontaminate.remove_contaminated(_documents(docs), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left, packed into sequences of at most 2048 tokens.

    A null text counts as empty: one closing token.  Rows that repeat an id, or have none, are packed each.
    """
    return pack.pack_documents(_documents(docs), tokenizer_path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", dedup_lines),
    ("near duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("packing", pack_sequences),
]

#: Trained scores and subword tokens are beyond SQL; the tests hold the rows against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each result is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = table(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
