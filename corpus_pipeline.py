"""Corpus pipeline: language, near-duplicates, repeated passages, packing."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierlake.llm import language_id, packing, simhash, substrings
from tierlake.llm.queries import BYTE_BPE, is_held_out, table
from tierlake.llm.runtime import stored

#: Share of a document's letters that may be in no learned language. Texts in several languages are
#: kept, however evenly; random letters and languages that no label names are not.
UNKNOWN_LETTERS = 0.5


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that have letters, most of them in learned languages.

    The model learns from the labelled documents of the input. Where none has a label there is
    nothing to judge by, and every document with a letter stays.
    """
    model = language_id.train(docs, ~F.coalesce(is_held_out(), F.lit(False)))
    if not model.languages:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    found = language_id.identify(docs, model)
    known = (F.col("lang_pred") != language_id.UNKNOWN) & (F.col("unknown") <= UNKNOWN_LETTERS)
    return found.where(known).select("row.*")


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of smallest id of each component of linked fingerprints."""
    return simhash.one_of_each(docs, distance=4, shingle=4)


def without_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, less the words of passages of 20 words and more that occur earlier.

    A text that loses words is its other words, joined by a space; other texts stay as they are.
    """
    found = substrings.remove_repeats(docs, width=20)
    cut = F.col("n_removed") > 0

    def column(name: str):
        own = F.col("row")[name]
        if name == "text":
            return F.when(cut, F.col("kept")).otherwise(own).alias(name)
        if name == "n_chars":
            size = F.char_length("kept").cast(docs.schema[name].dataType)
            return F.when(cut, size).otherwise(own).alias(name)
        return own.alias(name)

    return found.select(*[column(c) for c in docs.columns])


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the kept texts, placed in sequences of at most 1,024 tokens."""
    return packing.pack(docs, BYTE_BPE, with_ids=False)


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("language", known_language),
    ("near_duplicates", without_near_duplicates),
    ("repeated_passages", without_repeated_passages),
    ("packing", packed_sequences),
]

#: SQL can't say the first two stages nor the last; tests hold each against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written and read again before the next."""
    rows = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        rows = stored(stage(spark, rows, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, rows, sf_dir)
