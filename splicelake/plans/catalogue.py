"""Queries of the annotation engine over the driver's tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.intervals import chain
from ..functions.lineage import cut
from ..operators import finish, grouping, location, redundancy, report, structure, support
from . import adapter, filequeries
from .fileoracle import FILE_SQL
from .oracle import SQL

LOCUS = structure.LOCUS


def _t(f: Callable[[DataFrame], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, d: f(adapter.transcripts(spark, d))


def _held(f: Callable[[DataFrame], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """For what reads its transcripts more than once: they are put together once and written."""
    return lambda spark, d: f(cut(adapter.transcripts(spark, d)))


def _bare(t: DataFrame) -> DataFrame:
    return location.monoexonic_antisense(t, location.unstranded(t))


def _support(spark: SparkSession, d: str, reads: int, samples: int) -> DataFrame:
    return support.junction_support(adapter.junctions(spark, d), reads, samples)


def _boundaries(t: DataFrame) -> DataFrame:
    return grouping.boundaries(structure.with_consensus(t), (*LOCUS, "consensus")).select(*LOCUS, "consensus", "n", "xs", "xe", F.col("is").alias("ints"), F.col("ie").alias("inte"))


def _padded(t: DataFrame) -> DataFrame:
    return finish.padded(t).select("transcript_id", F.explode("padded").alias("x")).select("transcript_id", "x.s", "x.e")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "intron_chains": _t(lambda t: t.where("n_exons > 1").select("transcript_id", chain(F.col("introns")).alias("chain"))),
    "transcript_model": _t(lambda t: t.select("seqname", "strand", "gene_id", "transcript_id", "s", "e", "len", F.col("n_exons").cast("long").alias("n_exons"))),
    "gene_bounds": _t(lambda t: t.groupBy("gene_id").agg(F.min("s").alias("s"), F.max("e").alias("e"))),
    "nonredundant_identical": _held(lambda t: redundancy.identical_chains(t).where("kept").select("seqname", "strand", "transcript_id", "s", "e")),
    "redundant_subset": _held(lambda t: redundancy.contained_chains(redundancy.identical_chains(t).where("kept").drop("kept"))),
    "monoexon_redundant": _held(lambda t: redundancy.monoexons(t).where("not kept").select("transcript_id")),
    "redundancy_labels": _held(redundancy.redundancy),
    "overlap_groups": _held(lambda t: grouping.overlap_groups(t).select(*LOCUS, "transcript_id")),
    "refined_groups": _held(lambda t: grouping.refined_groups(t).select(*LOCUS, "part", "transcript_id")),
    "consensus_groups": _held(lambda t: grouping.consensus_groups(grouping.overlap_groups(t)).select(*LOCUS, "transcript_id", "consensus")),
    "group_boundaries": _held(_boundaries),
    "cross_strand_groups": _held(lambda t: grouping.cross_strand_groups(t, location.monoexonic_antisense(t)).select("seqname", F.col("left").alias("lft"), F.col("right").alias("rgt"), "transcript_id")),
    "lone_monoexons": _held(lambda t: grouping.lone_monoexons(t).select("transcript_id")),
    "unstranded": _t(location.unstranded),
    "unknown_seqname": lambda spark, d: location.unknown_seqname(adapter.transcripts(spark, d), adapter.genome(spark)),
    "monoexon_antisense": _held(_bare),
    "antisense_fragments": _held(lambda t: location.antisense_fragments(t, _bare(t))),
    "location_labels": lambda spark, d: location.location(cut(adapter.transcripts(spark, d)), adapter.genome(spark)),
    "sj_supported": lambda spark, d: _support(spark, d, 2, 1).where("supported").select(*support.SITE, "met"),
    "sj_rejected": lambda spark, d: _support(spark, d, 4, 2).where("non_canonical or low_reads").select(*support.SITE, "met", "non_canonical", "low_reads"),
    "sj_matrix": lambda spark, d: support.junction_matrix(adapter.junctions(spark, d), [f"sample{i}" for i in range(adapter.SAMPLES)]),
    "transcripts_sj_supported": lambda spark, d: support.by_junctions(adapter.transcripts(spark, d), _support(spark, d, 4, 2).where("supported")).where("supported").select("transcript_id"),
    "abundant": lambda spark, d: support.abundance(adapter.quant(spark, d), 1, 3).where("abundant").select("transcript_id", "met"),
    "abundance_labels": lambda spark, d: support.by_abundance(adapter.transcripts(spark, d), adapter.quant(spark, d), 1, 3),
    "intronic": _held(lambda t: grouping.intronic(grouping.overlap_groups(t), LOCUS)),
    "uniform_consensus": _held(structure.uniform_consensus),
    "segmented_groups": _held(structure.segmented),
    "chimeric": _held(lambda t: structure.spanning(structure.with_kinds(t).where("apart and not uniform"))),
    "fragments": _held(structure.fragments),
    "structural_labels": _held(structure.structural),
    "reannotate_ids": _held(lambda t: finish.reannotate(t, "NEW")),
    "padded_exons": _held(_padded),
    "scaffold_counts": _held(report.scaffold_counts),
    "gene_categories": _t(report.gene_categories),
    "isoform_histogram": _t(report.isoform_histogram),
    "length_histogram": _t(lambda t: report.histogram(t, "len", 100)),
    "length_percentiles": _held(lambda t: report.percentiles(report.lengths(t))),
    "length_outliers": _held(report.length_outliers),
    "potentially_chimeric": _held(report.potentially_chimeric),
    "potentially_split": _held(report.potentially_split),
    "potentially_fragmented": _held(report.potentially_fragmented),
    "other_categories": _held(report.other_categories),
    "splice_junctions": _t(report.splice_junctions),
    "sj_percentiles": lambda spark, d: report.junction_percentiles(adapter.junctions(spark, d)),
    "id_mapping": _t(finish.mapping),
} | filequeries.QUERIES

ORACLE_SQL: dict[str, str] = SQL | FILE_SQL
