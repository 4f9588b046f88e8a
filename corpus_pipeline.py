"""From raw documents to packed training sequences, in five stages.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; it is written
as Parquet, and what was written is the next stage's input. All stages but the
last return the columns of ``documents``. Empty tables pass through every stage.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import langid, lines, packing, simhash, substrings
from tidemark.llm.queries import documents, tokenizer_path
from tidemark.llm.runtime import stored


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects texts without a language; fills in ``lang`` where it is null.

    A text that is null or has no letter has none. Short texts between two
    languages stay: they are text. Where no row names a language, nothing can be
    learned: texts with a letter stay as they are. Equal code lengths go to the
    first language by name; rows that repeat an id or a text are judged one by
    one, and very long texts as wholes.
    """
    model = langid.train_languages(docs)
    if not model.languages:
        return docs.where(F.col("text").cast("string").rlike(r"\p{L}"))
    found = langid.identify(docs, model).where(F.col("lang_pred") != langid.UNDECIDED)
    return found.withColumn("lang", F.coalesce("lang", "lang_pred")).select(*docs.columns)


def deduplicate_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts later copies of runs of lines, single lines of enough words included; a document of nothing else goes.

    Positions go by id, then line; rows that repeat an id do not cut each other,
    null ids and null or empty texts stay, very long texts are cut as wholes.
    """
    cut = lines.remove_repeated_lines(docs, least_words=lines.LEAST_WORDS)
    return _shortened(docs, cut.where("n_lines_removed = 0 or n_lines_removed < n_lines"))


def deduplicate_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with an earlier near-copy go: a Jaccard coefficient of 0.8 or more over shingles of five words.

    Groups of SimHash fingerprints of these shingles come first, then an exact search
    of all pairs for what is left; rows with a null id stay, as do copies that
    repeat an id. Null and empty texts are copies of each other.
    """
    return simhash.without_near_copies(docs)


def deduplicate_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts passages that an earlier document holds; a document of nothing else goes.

    Only a smaller id cuts, so rows that repeat an id do not cut each other; null
    texts stay, very long texts are cut as wholes.
    """
    cut = substrings.remove_repeated_passages(docs)
    return _shortened(docs, cut.where("n_words_removed = 0 or n_words_removed < n_words"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in training sequences; a null text is an empty document, a long one is many pieces."""
    return packing.pack_documents(docs, tokenizer_path())


def _shortened(docs: DataFrame, cut: DataFrame) -> DataFrame:
    if "n_chars" in docs.columns:
        cut = cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return cut.select(*docs.columns)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", identify_language),
    ("lines", deduplicate_lines),
    ("near_copies", deduplicate_near_copies),
    ("passages", deduplicate_passages),
    ("packing", pack_sequences),
]

#: SQL can express neither the language model nor the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
