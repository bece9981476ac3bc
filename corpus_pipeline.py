"""Cleaning pipeline from raw documents to packed training sequences.

Every stage takes ``(spark, docs, sf_dir)``; its result is written and read
back as the next stage's ``docs``.  All but the last return the columns of
``docs``, with ``n_chars``, where there is such a column, following the text.

1. toxicity        documents that the classifier rejects go
2. line_dedup      repeated lines go, the document keeps what is left
3. simhash         of each group of near duplicates the smallest doc_id stays
4. pii             personal data is replaced by its kind, as in <EMAIL>
5. packing         pieces of at most 1024 tokens, packed into sequences

Edge cases: null or empty texts pass every filter and end as one piece of one
token; rows with a null id are never judged a duplicate; repeated rows of an
id are one document, which stays or goes as one; an empty table gives an empty
result; extra columns, whatever their names, pass through to the last stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tabforge.llm import line_dedup, packing, pii, simhash, toxicity
from tabforge.llm.common import like_input, materialize, table
from tabforge.llm.queries import learnable, tokenizer


def _counted(docs: DataFrame) -> DataFrame:
    if "n_chars" not in docs.columns:
        return docs
    return docs.withColumn("n_chars", F.coalesce(F.char_length("text"), F.lit(0)).cast(docs.schema["n_chars"].dataType))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Fit on the labelled documents of the table, reject the toxic ones of ``docs``."""
    labels = table(spark, sf_dir, "labels").where(learnable())
    lang = "lang" if "lang" in docs.columns else None
    fitted, _ = toxicity.train(docs, labels, lang_col=lang)
    return toxicity.reject(docs, fitted, lang_col=lang)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _counted(like_input(line_dedup.dedup_lines(docs), docs))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(docs)
    gone = materialize(found.where("doc_id <> component_id").select(F.col("doc_id").alias("gone_id")).distinct(), "near-duplicates")
    # a merge join at every size, as in line dedup
    return docs.join(gone.hint("merge"), docs.doc_id == gone.gone_id, "left_anti")


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = pii.find_pii(docs)
    text = F.when(F.col("text").isNotNull(), pii.masked(F.col("text"), F.col("spans")))
    return _counted(like_input(found.select("doc_id", text.alias("text"), "rest"), docs))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(packing.tokenize(docs, tokenizer("byte_bpe_50k.json"), with_ids=False))


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_lines),
    ("simhash", drop_near_duplicates),
    ("pii", mask_personal_data),
    ("packing", pack_sequences),
]

#: SQL can express neither the classifier nor the packing.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = materialize(docs, f"stage-{name}")
    return docs
