"""The corpus pipeline: documents to token ids, in five stages.

Each stage takes what its predecessor kept, written as Parquet and read again,
and all but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillframe.llm import langid, mixing, simhash, toxicity
from quillframe.llm._common import packed, written
from quillframe.llm.queries import fold, token_rows

#: Below this share of letters with certainty in one language a text has no language of its own.
LANGUAGE_SCORE = 0.25
#: From this probability a text is toxic.
TOXIC_SCORE = 0.7

#: None: classifiers, components and rounding are beyond SQL; the tests hold every stage against its operator's contract.
ORACLE_SQL = None


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the corpus has; those without letters, or in none for sure, go.

    A null or empty text has no letters. Rows that repeat an id or a text are
    judged each; a null ``lang`` or id only keeps a row from being learned from.
    """
    model = langid.train(docs, "text", "lang", usable=fold("doc_id", 4) != 2)
    found = langid.detect(packed(docs, "text"), model, "row", "text")
    return found.where((F.col("lang_pred") != langid.UNKNOWN) & (F.col("score") >= LANGUAGE_SCORE)).select("row.*")


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model, trained on the labelled ones among them, does not reject.

    Null and empty texts score as the bias alone, and stay unless that is
    toxic; rows that repeat an id or a text are judged each. Without usable
    labels nothing goes.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = toxicity.train(docs, labels, "doc_id", "text", "toxic", usable=fold("doc_id", 3) != 1)
    found = toxicity.scores(packed(docs, "text"), model, "row", "text")
    return found.where(F.col("score") < TOXIC_SCORE).select("row.*")


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, that with the smallest id.

    Null, empty and blank texts are one group. Of rows that repeat the smallest
    id one stays; rows with a null id all stay, as nothing names them.
    """
    return simhash.keep_one(docs, "doc_id", "text", words=4, max_bits=4)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as often as the mix of their sources takes them.

    A null source is a source of its own; texts without words are never taken;
    rows that repeat an id are documents each, equal ones taken alike.
    """
    return mixing.mixed_rows(docs, "doc_id", "text", "source")


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids, decoded_sha256): token ids, and the digest of the text that they decode to.

    A row for every row, with no ids for a null or empty text; an empty table
    gives an empty one. In all stages other columns go along, whatever their names.
    """
    return token_rows(spark, docs)


STAGES = [
    ("language", language),
    ("toxicity", clean),
    ("near-duplicates", distinct),
    ("mixing", mixed),
    ("tokens", tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
