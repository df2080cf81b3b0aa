"""Documents to training pieces in five stages. ``STAGES`` lists them; ``run`` applies them to the table documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import lines, mixing, pieces, quality, simhash
from tidemark.llm.common import materialise, table

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _documents(df: DataFrame) -> DataFrame:
    """The columns of documents; ``n_chars`` follows the text."""
    return df.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that keep all quality rules."""
    return quality.keep_good(docs.select(*COLUMNS))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents; a line that ten sources or more share stays in the first document only."""
    return _documents(lines.without_boilerplate(docs.select(*COLUMNS)))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose fingerprints of four-word shingles are linked by four differing bits at most."""
    return simhash.one_of_each(docs.select(*COLUMNS))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each source as often as its target asks for; a document is a row for each time that it is taken."""
    return _documents(mixing.drawn(docs.select(*COLUMNS)))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of every document."""
    return pieces.with_pieces(docs, pieces.load())


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("SimHash near-dedup", near_dedup),
    ("source mixing", source_mixing),
    ("SentencePiece", encoding),
]

#: SQL can't express the fingerprints and the pieces; the tests hold the stages against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order, each written as Parquet and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name.replace(" ", "-").lower())
    return STAGES[-1][1](spark, docs, sf_dir)
