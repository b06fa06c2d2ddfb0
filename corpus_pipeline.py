"""From raw documents to encoded training text, in five stages.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir)
and returns the rows that go on, with the columns of ``documents`` (the last
one adds the encoding). ``run`` writes each stage's result as Parquet in the
shared folder and reads it back as the next one's documents, so a lost
executor never costs more than the stage it was lost in.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from clickscope.llm.decontaminate import drop_contaminated
from clickscope.llm.linededup import without_repeated_lines
from clickscope.llm.perplexity import keep_good
from clickscope.llm.pieces import encode
from clickscope.llm.shared import bounded_batches, landed, read_table
from clickscope.llm.simhash import keep_one_of_each


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose perplexity is not above their language's threshold."""
    bounded_batches(spark)
    return keep_good(docs, read_table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with one line of each group of like lines left."""
    bounded_batches(spark)
    return without_repeated_lines(docs)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group."""
    bounded_batches(spark)
    return keep_one_of_each(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no test item."""
    bounded_batches(spark)
    return drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def sentencepiece_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their best and N-best segmentations."""
    bounded_batches(spark)
    return encode(docs)


STAGES = [
    ("quality classifier", quality_classifier),
    ("line dedup", line_dedup),
    ("SimHash near-dedup", simhash_near_dedup),
    ("benchmark decontamination", benchmark_decontamination),
    ("SentencePiece encoding and decoding", sentencepiece_encoding),
]

#: The stages' models and iterations cannot be written in SQL; tests compare
#: ``run`` with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES, 1):
        docs = landed(stage(spark, docs, sf_dir), f"pipeline-{number}")
    return docs
