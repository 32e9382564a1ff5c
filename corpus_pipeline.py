"""The corpus pipeline: five stages over ``documents``, each written as Parquet before the next one reads it.

Every stage works on all that its predecessor kept. Toxic documents go; repeated lines go; one
document of each group of near copies stays; the sources are mixed to target weights; the mix is
packed into token sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.llm.common import bound_batches, table
from tidewatch.llm.line_dedup import dedup_lines
from tidewatch.llm.mixing import mixed_documents
from tidewatch.llm.packing import pack_documents
from tidewatch.llm.queries import TOKENIZER
from tidewatch.llm.simhash import without_near_duplicates
from tidewatch.llm.toxicity import THRESHOLD, score_toxicity, train
from tidewatch.shared import scratch_path

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression-distance classifier doesn't call toxic, unchanged."""
    bound_batches(spark)
    docs = docs.select(COLUMNS)
    model = train(docs, table(spark, sf_dir, "labels"))
    return score_toxicity(docs, model).where(F.col("score") < THRESHOLD).select(COLUMNS)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines that five or more of them share (but for the one that keeps them)."""
    bound_batches(spark)
    kept = dedup_lines(docs.select(COLUMNS)).withColumn("n_chars", F.length("text").cast("long"))
    return kept.select(COLUMNS)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of SimHash near-duplicates (three words, two bits): that with the smallest id."""
    bound_batches(spark)
    return without_near_duplicates(docs.select(COLUMNS), words=3, radius=2).select(COLUMNS)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of the sources at 150 % of all words: whole documents, once or twice, and parts at the edges."""
    return mixed_documents(docs.select(COLUMNS)).select(COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of token sequences of at most 4096 tokens."""
    bound_batches(spark)
    return pack_documents(docs, TOKENIZER, end_id=2, size=4096)


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_repeated_lines),
    ("simhash near-dedup", drop_near_copies),
    ("source mixing", mix),
    ("packing", pack),
]

# Compression lengths and fingerprints have no SQL; the tests hold every stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
