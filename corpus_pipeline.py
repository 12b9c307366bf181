"""From raw documents to packed training sequences, in stages that each read what the one before has written.

Every stage works on all rows it is given and returns the columns of ``documents``, but for the last, which returns the
place of every piece of every document in the sequences. In every stage rows are taken one by one, so ids may repeat or be
null; texts are read whole, however long; columns beyond those of ``documents``, whatever their names, are kept as they are
by all stages but the last; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tillroll.llm import mixing, ngram_join, packing, secrets, toxicity
from tillroll.llm.shipping import ship
from tillroll.staging import written


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the threshold of rejection; the model learns from labels of the documents given.

    Null and empty texts are scored like any other. Without labels of both kinds all documents have one score: the share
    of toxic labels. Rows with one text have one score.
    """
    ship(spark)
    return toxicity.without_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of similar ones, that with the smallest id, nulls last.

    Null texts are empty, and texts without words are copies of each other. Of rows with one id the digests of text and row decide.
    """
    ship(spark)
    return ngram_join.deduplicated(docs)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents; secrets in the texts are replaced by their kind. A null text stays null."""
    ship(spark)
    return secrets.redact_documents(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: documents as often as their sources' targets take them.

    Null and empty texts have no words and are never taken. A null source is a source of its own. Rows that are equal
    throughout are interchangeable; the choice does not hang on the partitioning.
    """
    ship(spark)
    return mixing.mixed_documents(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece of a document: where it stands in which sequence. A repeated document has its pieces repeated.

    A null or empty text is one piece, the end mark alone. Documents of equal length are placed in any order.
    """
    ship(spark)
    pieces = packing.tokenized(docs).select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    return packing.pack(pieces)


STAGES = [
    ("toxicity", drop_toxic),
    ("near duplicates", drop_near_duplicates),
    ("secrets", redact_secrets),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]
ORACLE_SQL = None  # no stage but the secrets' could be said in SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
