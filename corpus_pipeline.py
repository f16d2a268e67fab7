"""A corpus made ready for training: five stages, each written and read again.

STAGES lists (name, function); a function takes (spark, docs, sf_dir) and works on all that
its predecessor kept. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weekloom.llm import bpe, decontam, langid, repeats, simhash
from weekloom.llm.queries import reachable, table, vocabulary_file
from weekloom.session import fresh_path

# Language ID rejects a text without a letter, and the substring stage looks at 20 words.
WORDS = 20


def _columns(docs: DataFrame, found: DataFrame) -> DataFrame:
    """The columns of ``docs``, but for extra ones that gave way to a stage's own."""
    return found.select(*[c for c in docs.columns if c in found.columns])


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told; texts without a letter go.

    If no language could be learned, every text with a letter stays.
    """
    reachable(spark)
    model = langid.learn(docs.where(~langid.held_out(F.col("doc_id")) & F.col("doc_id").isNotNull()))
    if model is None:
        return langid.lettered(docs)
    return _columns(docs, langid.predict(docs, model).where(F.col("lang_pred") != langid.UNKNOWN))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of least id of each group; rows without an id stay.

    Of rows that share that id one stays, the same however they lie. NULL and empty texts are alike
    and so are one group; a table without rows stays empty.
    """
    return simhash.first_of_groups(docs)


def substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document without the words that stand earlier in a window of 20.

    A text that loses nothing stays as it is, NULL too; rows that share an id are texts of their
    own, rows without an id are left whole, equal rows stay equal. No row goes.
    """
    found = repeats.without_repeats(docs, WORDS)
    text = F.when(F.col("n_removed") > 0, F.col("kept_text")).otherwise(F.col("text"))
    n_chars = F.when(F.col("n_removed") > 0, F.length("kept_text").cast("bigint")).otherwise(F.col("n_chars"))
    return _columns(docs, found.withColumns({"text": text, "n_chars": n_chars}))


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no test item.

    NULL and empty texts hold none; rows without an id are judged like others; equal rows stay or go together.
    """
    return decontam.without_items(docs, table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document with its token count and the digests of its ids and decoded text.

    NULL is an empty text of no tokens. No row goes, also not copies or rows without an id.
    """
    return bpe.digests(docs, vocabulary_file("word_bpe_49k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("substrings", substrings),
    ("benchmark", benchmark),
    ("tokens", tokens),
]

# The language model and fingerprints have no SQL; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; each stage is a table in the shared folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = fresh_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
