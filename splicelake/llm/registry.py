"""The queries of this subpackage, and the SQL that some can be held against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontamination, fillmiddle, filteraudit, htmltext, language, linedup, media, metrictree, minhash, mixing, quality, toxicity, warc
from .scratch import Scratch


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Languages of all documents, learned from those that are not held out; odd rows as in ``language.languages``."""
    return language.languages(_read(spark, sf_dir, "documents"))


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages through archives and back; odd rows as in ``warc.round_trip``."""
    return warc.round_trip(spark, _read(spark, sf_dir, "pages"))


def op3_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents by pairs of words; odd rows as in ``minhash.near_duplicates``."""
    return minhash.near_duplicates(spark, _read(spark, sf_dir, "documents"), k=2)


def op4_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of all pages; odd rows as in ``htmltext.extract``."""
    return htmltext.extract(_read(spark, sf_dir, "pages"))


def op5_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as stored media, read back; odd rows as in ``media.media``."""
    return media.media(spark, _read(spark, sf_dir, "documents"))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents and the benchmark items that they hold; odd rows as in ``decontamination.leaks``."""
    return decontamination.leaks(spark, _read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of all documents; odd rows as in ``quality.quality``."""
    return quality.quality(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the mix takes of each document; odd rows as in ``mixing.mix``."""
    return mixing.mix(spark, _read(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of all documents; odd rows as in ``toxicity.toxicity``."""
    return toxicity.toxicity(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


def op10_linededup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without recurring lines; odd rows as in ``linedup.line_dedup``."""
    return linedup.line_dedup(spark, _read(spark, sf_dir, "documents")).select("doc_id", "text", "n_lines", "n_dropped")


def op11_metric_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten largest inner products of each hundredth vector with all others; odd rows as in ``metrictree.top_k``."""
    return metrictree.top_k(spark, _read(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op12_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents cut and rearranged, as digests; odd rows as in ``fillmiddle.transform``."""
    return fillmiddle.fill_middle(_read(spark, sf_dir, "documents"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five filters in all orders over all documents; odd rows as in ``filteraudit.audit``."""
    return filteraudit.audit(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"), Scratch(spark, "audit"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages of ``corpus_pipeline`` over all documents; odd rows as the stages state."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_language, op2_warc, op3_minhash, op4_html, op5_media, op6_decontamination, op7_quality, op8_mixing, op9_toxicity, op10_linededup, op11_metric_tree, op12_fill_middle, op13_filter_audit, pipeline)}


def oracle_sql() -> dict[str, str]:
    return {"op2_warc": warc.ORACLE_SQL, "op4_html": htmltext.ORACLE_SQL, "op8_mixing": mixing.ORACLE_SQL, "op10_linededup": linedup.ORACLE_SQL, "op11_metric_tree": metrictree.ORACLE_SQL, "op12_fill_middle": fillmiddle.ORACLE_SQL, "op13_filter_audit": filteraudit.ORACLE_SQL}
