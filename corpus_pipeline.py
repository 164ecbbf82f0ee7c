"""From raw documents to a training mix, in five stages over one table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from splicelake.llm import decontamination, linedup, minhash, mixing, toxicity
from splicelake.llm.scratch import Scratch


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Each stage takes the documents that the one before kept, with all their columns, and works on whole
# texts of any length. Null and empty texts pass all stages; repeated rows and tied or null ids are
# stated where a stage treats them in a way of its own. An empty table gives an empty table. Extra columns
# pass unchanged, whatever their names, but for those that the last stage adds.


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier rejects go, all of their repeated rows with them; null and empty texts stay as texts without features do."""
    return toxicity.without_toxic(docs, _table(spark, sf_dir, "labels"), fit_on=_table(spark, sf_dir, "documents"))


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of recurring templates go; every row stays, with the text that is left of it, null if it was null, and ``n_chars`` of that."""
    out = linedup.without_lines(spark, docs)
    return out.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else out


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays, that with the smallest doc_id, and one of repeated rows. Texts without words are copies of nothing; rows without a doc_id stay."""
    return minhash.without_copies(spark, docs, k=5)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text contains a benchmark item go, whatever their ids: rows without a doc_id too, and of rows that share one only those with such a text."""
    return decontamination.without_leaks(spark, docs, _table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the mix takes: each document with ``size, source_size, target, taken, copies`` (how often it is taken); those never taken go. A null source is a source of its own."""
    return mixing.mix(spark, docs).where("copies > 0")


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_lines),
    ("near_dedup", drop_near_copies),
    ("decontamination", drop_leaks),
    ("mixing", mix_sources),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again."""
    scratch = Scratch(spark, "pipeline")
    docs = _table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = scratch.save(stage(spark, docs, sf_dir), name)
        if k:
            scratch.drop(STAGES[k - 1][0])
    return docs


#: A fitted classifier and a latent index can't be put in SQL.
ORACLE_SQL = None
