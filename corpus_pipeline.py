"""A training corpus from raw documents: five stages, each written as a table that the next one reads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wildtally.llm import bpe, decontam, langid, pii, simhash
from wildtally.llm.shared import remove, stored, table


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the labelled ones teach; others go.

    Null, empty and letterless texts go. Repeated rows stay; without labelled texts, or without documents, all stay.
    """
    return langid.keep_identified(docs, langid.learn(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, that with the smallest doc_id.

    Blank and null texts are one group. Of equal rows one stays; rows without an id come last. All columns stay.
    """
    return simhash.one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item.

    Null, empty and short texts stay, as do all documents if the benchmark is empty. Repeated rows stay together.
    """
    return decontam.without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data in their texts masked; n_chars is that of the text now.

    Null and empty texts, repeated rows and all other columns stay as they are.
    """
    masked = pii.mask_personal_data(docs, pii.learn(docs))
    return masked.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else masked


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, token_ids, n_tokens and decoded_sha256 (of the text decoded from the ids) of each document.

    A null or empty text has no ids. Repeated rows stay.
    """
    import public_tokenizers

    coded = bpe.encode_documents(docs, public_tokenizers.path("word_bpe_49k.json"))
    return coded.select("doc_id", "token_ids", F.size("token_ids").cast("long").alias("n_tokens"), F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("token_ids", token_ids),
]

#: SQL can't express a conditional random field or BPE merges; the tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over the documents in `sf_dir`.

    A stage's table is deleted once the next one is written; that of the last but one stays, as the result reads it.
    """
    docs, path = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        docs, written = stored(stage(spark, docs, sf_dir), f"corpus-{name}")
        if path:
            remove(spark, path)
        path = written
    return STAGES[-1][1](spark, docs, sf_dir)
