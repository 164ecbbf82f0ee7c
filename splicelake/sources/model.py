"""The normalized annotation: one row per transcript, with its exons and introns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.attributes import attribute
from ..functions.intervals import exon_array, introns_of, span_length, utr_regions


def transcripts(exons: DataFrame) -> DataFrame:
    """From exon rows (``seqname, strand, gene_id, transcript_id, s, e``): one shuffle on the transcript."""
    t = exons.groupBy("transcript_id").agg(
        F.max_by("seqname", F.struct("s", "e", "seqname")).alias("seqname"),
        F.max_by("strand", F.struct("s", "e", "strand")).alias("strand"),
        F.max_by("gene_id", F.struct("s", "e", "gene_id")).alias("gene_id"),
        exon_array(F.col("s"), F.col("e")).alias("exons"),
    )
    return with_spans(t)


def with_spans(t: DataFrame, *more) -> DataFrame:
    return t.select(
        "seqname",
        "strand",
        "gene_id",
        "transcript_id",
        F.col("exons")[0]["s"].alias("s"),
        F.element_at("exons", -1)["e"].alias("e"),
        span_length(F.col("exons")[0]["s"], F.element_at("exons", -1)["e"]).alias("len"),
        F.size("exons").alias("n_exons"),
        "exons",
        introns_of(F.col("exons")).alias("introns"),
        *more,
    )


def build(rows: DataFrame, keep: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Transcripts of annotation rows, and the ids of those without exons and CDS, which aren't built.

    Of strand, sequence and gene the last row of the file counts. A transcript of CDS
    only takes them for its exons. Annotated UTRs and codons win over derived ones.
    """
    if keep is not None:
        rows = rows.join(keep.select("transcript_id").distinct(), "transcript_id", "left_semi")
    part = lambda *names: F.sort_array(F.collect_set(F.when(F.col("feature").isin(*names), F.struct("s", "e"))))
    codon = lambda name: F.max_by(F.when(F.col("feature") == name, F.struct("s", "e")), F.when(F.col("feature") == name, F.col("line_no")))
    t = rows.groupBy("transcript_id").agg(
        *[F.max_by(c, F.struct("file_tag", "line_no")).alias(c) for c in ("seqname", "strand", "gene_id")],
        F.max(attribute(F.col("attr"), "gene_name")).alias("gene_name"),
        part("exon").alias("_exons"),
        part("CDS").alias("cds"),
        part("five_prime_utr").alias("_five"),
        part("three_prime_utr").alias("_three"),
        codon("start_codon").alias("_start"),
        codon("stop_codon").alias("_stop"),
    )
    t = t.withColumn("exons", F.when(F.size("_exons") > 0, F.col("_exons")).otherwise(F.col("cds")))
    missing = t.where(F.size("exons") == 0).select("transcript_id")
    t = t.where(F.size("exons") > 0)
    derived = utr_regions(F.col("exons"), F.col("cds"), F.col("strand"))
    full = with_spans(
        t,
        "gene_name",
        "cds",
        F.when(F.size("_five") > 0, F.col("_five")).otherwise(derived["five_prime"]).alias("five_prime"),
        F.when(F.size("_three") > 0, F.col("_three")).otherwise(derived["three_prime"]).alias("three_prime"),
        F.coalesce("_start", derived["start_codon"]).alias("start_codon"),
        F.coalesce("_stop", derived["stop_codon"]).alias("stop_codon"),
    )
    return full.select("transcript_id", *[c for c in full.columns if c != "transcript_id"]), missing


def genes(t: DataFrame) -> DataFrame:
    return t.groupBy("gene_id").agg(F.min("s").alias("s"), F.max("e").alias("e"))
