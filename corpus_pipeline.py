"""From documents to packed training sequences, in stages that each work on all rows of the one before.

Every stage takes ``(spark, docs, sf_dir)`` and returns a table; all but the last return the
columns of ``documents``. ``run`` writes each result as Parquet in the shared folder and reads it
back for the next stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crowdpulse.llm import quality
from crowdpulse.llm.common import read_table, written
from crowdpulse.llm.line_dedup import dedup_lines
from crowdpulse.llm.mixing import mixed_documents
from crowdpulse.llm.packing import pack_documents
from crowdpulse.llm.simhash import simhash_dedup

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier scores 0.5 or more. It learns from the table ``labels``.

    Null and empty texts have a score like any other (0.5 without a model, so they stay then);
    rows with null ids and repeated rows are scored each; an empty table gives an empty table.
    """
    model = quality.fit(docs, read_table(spark, sf_dir, "labels"))
    return quality.score(docs, model, *COLUMNS).filter("score >= 0.5").select(*COLUMNS)


def unique_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that a document with a smaller id holds are taken out; n_chars follows the text.

    Every row stays, a null text as an empty one. Rows with equal ids count as one document, so
    they keep the lines they share; how null ids are taken says ``dedup_lines``. An empty table
    gives an empty table.
    """
    return dedup_lines(docs.select(*COLUMNS)).select(
        "doc_id", "text", "lang", "source", F.length("text").cast("long").alias("n_chars")
    )


def near_unique(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates stays, that with the smallest id.

    Fingerprints of 3-word shingles that differ in 3 bits or fewer link. Null ids come last, of
    repeated rows one stays, null and empty texts are one group; an empty table gives an empty table.
    """
    return simhash_dedup(docs.select(*COLUMNS))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them.

    Null texts have the size 0, a null source is a source of its own, the last; ties, null ids and
    repeated rows are taken as ``mixed_documents`` says. An empty table gives an empty table.
    """
    return mixed_documents(docs.select(*COLUMNS))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces and their places in sequences. A document that the mix took twice is packed twice.

    A null text is empty and has the end token only; null and repeated ids are packed each. An
    empty table gives an empty table.
    """
    return pack_documents(docs)


STAGES = [
    ("quality_classifier", good_documents),
    ("line_dedup", unique_lines),
    ("simhash_near_dedup", near_unique),
    ("pareto_mix", mixed),
    ("best_fit_packing", packed),
]

# The classifier, the XXH64 of shingles and the token ids have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
