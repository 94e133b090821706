"""From documents to packed sequences, in stages that are each written and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from formloom.llm import mixture, packing, pii, quality, simhash
from formloom.llm._shared import Scratch, tables


def _whole(docs: DataFrame) -> DataFrame:
    """Rows in one column each, so that results' names can't clash with theirs."""
    return docs.select(F.struct(*docs.columns).alias("_row"))


def accepted(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier keeps: a null or empty text is judged like any other, equal texts are judged alike, and documents with a
    null id have no label. Of no documents none are kept."""
    judged = quality.classify(_whole(docs), tables(spark, sf_dir, "labels"), "_row.doc_id", "_row.text", carry=["_row"])
    return judged.where("keep").select("_row.*")


def deduplicated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one of smallest id (null ids last; of repeated rows one). Texts without words, null ones
    too, are alike."""
    return simhash.distinct(docs).select(docs.columns)


def anonymous(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with surrogates for personal data; n_chars follows the new text. A null text stays null, and so does its n_chars. Equal
    entities have equal surrogates in all documents."""
    replaced = pii.replace(docs.withColumnRenamed("n_entities", "_own_entities"), pii.key_of(spark)).drop("n_entities")
    replaced = replaced.withColumnRenamed("_own_entities", "n_entities")
    return replaced.withColumn("n_chars", F.char_length("text").cast("long")).select(docs.columns)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: a row a copy. Texts without words stay once; a null source is a source of its own; which of
    equally long documents get a copy more is by hash."""
    taken = mixture.mix(_whole(docs), "_row.doc_id", "_row.text", "_row.source")
    return taken.select("_row", F.explode(F.expr("array_repeat(1, cast(copies as int))")).alias("_copy")).select("_row.*")


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Placed pieces of at most 4096 tokens; a null text counts as empty, and copies of a document are packed each."""
    return packing.packed(docs)


STAGES = [("quality", accepted), ("near_dedup", deduplicated), ("pii", anonymous), ("mixture", mixed), ("packing", packed)]

#: The stages train a classifier and tokenise; SQL can't express them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch, docs = Scratch(spark, "pipeline"), tables(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = scratch.save(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
