"""From raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir), where docs has the columns of documents, and returns what it keeps; the next one reads
that from Parquet. Repeated rows of one doc_id stay or go together; null texts count as empty; an empty table stays empty.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factlake.llm import quality_classifier
from factlake.llm.line_dedup import repeats_removed
from factlake.llm.near_copies import near_copies as near_copies_of
from factlake.llm.near_copies import node_of
from factlake.llm.packing import pack
from factlake.llm.shared import written
from factlake.llm.substring_dedup import substring_dedup


def _with_text(out: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of ``docs`` from an operator's doc_id, kept_text and rest."""
    named = {"doc_id": F.col("doc_id"), "text": F.col("kept_text"), "n_chars": F.char_length("kept_text").cast("long")}
    return out.select(*[named.get(c, F.col("rest")[c]).alias(c) for c in docs.columns])


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on weak labels of this corpus, does not hold bad."""
    return quality_classifier.keep_good(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the runs of two lines or more that an earlier place has too: repeated content-defined chunks, extended
    line by line, then what the chunks' cuts leave of such runs."""
    return _with_text(repeats_removed(docs), docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (five-word shingles, similarity of 0.8 or more) the texts of the least doc_id; rows with null
    doc_id stay."""
    gone = near_copies_of(docs).filter("doc_id <> first").select("doc_id", "node")
    return docs.withColumn("node", node_of(docs.text)).join(gone, ["doc_id", "node"], "left_anti").select(*docs.columns)


def substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without passages of 20 words or more that an earlier place has too."""
    return _with_text(substring_dedup(docs, layout=True), docs)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of packed training sequences, with their ids."""
    return pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("quality classifier", quality), ("line dedup", lines), ("SimHash near-dedup", near_copies), ("substring dedup", substrings), ("packing", sequences)]

#: The classifier, fingerprints and the tokenizer are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = written(docs, f"stage-{i}")
    return docs
