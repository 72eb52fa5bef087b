"""From documents to packed sequences: five stages, each over all that the one before kept.

toxicity -> line dedup -> near dedup -> benchmark decontamination -> packing. Every
stage but the last returns the columns of documents. SQL can't train the toxicity
classifier, so there is no SQL for the result; tests compare each stage with a
plain version on small tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from folia.llm import decontamination, linededup, neardup, packing, toxicity
from folia.llm.common import read, ship
from folia.session import kept


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are predicted toxic go.

    Null and empty texts have no suspect word and are judged as such texts; without labels of
    both kinds nothing goes. Repeated rows and null ids are judged by their text alone.
    No documents give none.
    """
    ship(spark)
    return toxicity.without_toxic(docs, read(spark, sf_dir, "labels"), train_on=read(spark, sf_dir, "documents"))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of ten characters or more stay only in the smallest document that has them.

    All documents stay, be it with an empty text; a null text stays null. Rows that share an id
    are one document, which does not repeat itself. A null id neither holds nor loses lines.
    """
    ship(spark)
    return linededup.without_repeated_lines(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, that of the smallest id.

    Null and empty texts are copies of one another. Of rows that repeat id and text one stays; texts
    that share an id but differ are documents of their own. Rows without an id stay.
    """
    ship(spark)
    return neardup.one_of_each(docs)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go.

    Null and empty texts hold none, and a null or empty item is held by none. Repeated rows and
    null ids are judged by their text alone. Without items nothing goes.
    """
    ship(spark)
    return decontamination.without_leaks(docs, read(spark, sf_dir, "benchmark"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all remaining documents in sequences of at most 4096 tokens.

    A null or empty text is the one end id. Every row is a document of its own, so
    repeated rows are packed each and a null id is kept. No documents give no pieces.
    """
    import public_tokenizers

    ship(spark)
    return packing.packed(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("minhash_near_dedup", drop_near_duplicates),
    ("benchmark_decontamination", drop_benchmark_leaks),
    ("packing", pack_sequences),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each result written and read again; what a stage wrote to
    work it out is removed when its result is written."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = kept(spark, lambda stage=stage, docs=docs: stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
