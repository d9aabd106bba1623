"""The corpus pipeline: documents to token ids, in five stages over the operators of ``tallyline.llm``.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is written as Parquet and
reread as the next one's ``docs``. All but the last return the columns of ``documents``; further
columns of the input are kept. Rows with nulls, empty texts and repeated rows follow the docstring
of each operator.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.llm import bpe, jaccard, langmix, leaks, pii
from tallyline.llm.common import Stored, table

#: Share that a document's largest language must have to be kept.
LEAST_SHARE = 0.4


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents of a known language: those with a letter and a dominant share.

    The languages are learned from the labelled rows of the stage's own input.
    """
    model = langmix.fit(docs, "text", "lang", "doc_id")
    found = docs.withColumn("_found", langmix.predict(model, spark, "text"))
    kept = found.where((F.col("_found.lang_pred") != "und") & (F.col("_found.score") >= LEAST_SHARE))
    return kept.select(*docs.columns)


def row_key() -> Column:
    """What decisions are carried by: the id, nulls last, and a digest of the text.

    It is never null itself, so joins find rows without an id, and rows that repeat an id are told apart.
    """
    return F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("digest"))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group that links of Jaccard 0.8 over five words connect.

    That is the one of the smallest id, nulls last, then of the smallest digest of its text. Other
    groups keep theirs, also under the same id. Rows of the same id and text are one; texts without
    a word have no links and stay.
    """
    keyed = docs.withColumn("_key", row_key())
    found = jaccard.similar(keyed, "_key", n=5, num=80, den=100)
    gone = found.where("node is not null and id <> component_id").select(F.col("id").alias("_key")).distinct()
    return keyed.join(gone, "_key", "left_anti").dropDuplicates(["_key"]).select(*docs.columns)


def leak_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops every document that a test item leaks into, with or without an id, and no other of its id."""
    keyed = docs.withColumn("_key", row_key())
    found = leaks.leaks(keyed, table(spark, sf_dir, "benchmark", "item_id", "text"), "_key")
    gone = found.select(F.col("id").alias("_key")).distinct()
    return keyed.join(gone, "_key", "left_anti").select(*docs.columns)


def surrogate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Puts surrogates in place of personal data; ``n_chars`` follows the new text."""
    done = pii.replace(docs)
    return done.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with their number and whether they decode to its text."""
    import public_tokenizers

    tokenizer = bpe.Tokenizer(spark, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    encoded = docs.select("doc_id", "lang", "source", "text", tokenizer.encode("text").alias("ids"))
    same = tokenizer.decode("ids") == F.coalesce("text", F.lit("")).cast("binary")
    return encoded.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids", same.alias("round_trip"))


STAGES = [
    ("language", language_stage),
    ("near_duplicates", near_duplicate_stage),
    ("leaks", leak_stage),
    ("surrogates", surrogate_stage),
    ("tokens", token_stage),
]

#: SQL cannot express the stages; the tests compare them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written below the shared folder and reread."""
    store = Stored(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = store.put(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
