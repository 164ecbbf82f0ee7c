"""Tables that describe an annotation."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.intervals import chain, percent
from ..functions.lineage import cut
from . import location, structure
from .grouping import consensus_groups, intronic, overlap_groups
from .structure import LOCUS

# The points that length tables have.
PERCENTILES = (0, 1, 5, 10, 15, 20, 25, 30, 35, 40, 45, 50, 55, 60, 65, 70, 75, 80, 85, 90, 95, 99, 100)


def scaffold_counts(t: DataFrame) -> DataFrame:
    """Genes and transcripts of each strand key and of each strand, with their shares: two grouping sets in one pass."""
    total = t.agg(F.count_distinct("gene_id").alias("_g"), F.count_distinct("transcript_id").alias("_t"))
    rows = t.groupingSets([["seqname", "strand"], ["strand"]], "seqname", "strand").agg(F.count_distinct("gene_id").alias("genes"), F.count_distinct("transcript_id").alias("transcripts"))
    rows = rows.crossJoin(total)  # one row
    return rows.select(
        F.concat(F.coalesce("seqname", F.lit("")), "strand").alias("scaffold"),
        "genes",
        percent(F.col("genes"), F.col("_g")).alias("genes_pct"),
        "transcripts",
        percent(F.col("transcripts"), F.col("_t")).alias("transcripts_pct"),
    )


def gene_kinds(t: DataFrame) -> DataFrame:
    """``gene_id, isoforms, kind``: multi_isoform, single_multiexonic or single_monoexonic."""
    g = t.groupBy("gene_id").agg(F.count_distinct("transcript_id").alias("isoforms"), F.max("n_exons").alias("x"))
    return g.select("gene_id", "isoforms", F.when(F.col("isoforms") > 1, "multi_isoform").when(F.col("x") > 1, "single_multiexonic").otherwise("single_monoexonic").alias("kind"))


def gene_categories(t: DataFrame) -> DataFrame:
    """Genes and transcripts of each kind, and of all (``kind`` total): a rollup."""
    return gene_kinds(t).rollup("kind").agg(F.count("*").alias("genes"), F.sum("isoforms").alias("transcripts")).select(F.coalesce("kind", F.lit("total")).alias("kind"), "genes", "transcripts")


def isoform_histogram(t: DataFrame) -> DataFrame:
    return gene_kinds(t).groupBy("isoforms").agg(F.count("*").alias("genes"))


def histogram(df: DataFrame, value: str, width: int = 1) -> DataFrame:
    return df.groupBy((F.floor(F.col(value) / width) * width).alias("value")).agg(F.count("*").alias("n"))


def lengths(t: DataFrame) -> DataFrame:
    """``category, value``: lengths of transcripts, CDS (0 without one), genes of one mono-exon, and every transcript's exons and introns."""
    span = lambda c, m: t.select(F.lit(c).alias("category"), F.explode(m).alias("x")).select("category", (F.col("x.e") - F.col("x.s") + 1).alias("value"))
    whole = t.select(F.lit("transcripts").alias("category"), F.col("len").alias("value"))
    mono = monoexonic_genes(t).select(F.lit("monoexonic_genes").alias("category"), F.col("len").alias("value"))
    size = F.when(F.size("cds") > 0, F.element_at("cds", -1)["e"] - F.col("cds")[0]["s"] + 1).otherwise(0) if "cds" in t.columns else F.lit(0)
    cds = t.select(F.lit("cds").alias("category"), size.cast("long").alias("value"))
    return whole.union(cds).union(mono).union(span("exons", "exons")).union(span("introns", "introns"))


def monoexonic_genes(t: DataFrame) -> DataFrame:
    return t.join(gene_kinds(t).where("kind = 'single_monoexonic'").select("gene_id"), "gene_id", "left_semi")


def percentiles(values: DataFrame, key: str = "category", points: tuple[int, ...] = PERCENTILES) -> DataFrame:
    """``key, percentile, value``: of each point p the value at rank floor(p/100 n), from counts of values.

    Ranks come from a running sum over the distinct values; no list of all values is built.
    """
    counts = values.groupBy(key, "value").agg(F.count("*").alias("n"))
    w = Window.partitionBy(key).orderBy("value")
    ranked = counts.withColumns({"_hi": F.sum("n").over(w), "_all": F.sum("n").over(Window.partitionBy(key))}).withColumn("_lo", F.col("_hi") - F.col("n"))
    point = F.explode(F.array(*[F.lit(p) for p in points])).alias("percentile")
    at = F.least(F.floor(F.col("percentile") * F.col("_all") / F.lit(100)), F.col("_all") - 1)
    return ranked.select(key, "value", "_lo", "_hi", "_all", point).where((at >= F.col("_lo")) & (at < F.col("_hi"))).select(key, F.col("percentile").cast("long").alias("percentile"), "value")


def length_outliers(t: DataFrame) -> DataFrame:
    """``category, transcript_id, value`` of transcripts at or beyond the first or last percentile of their category, the smallest first."""
    quantiles = percentiles(lengths(t), points=(1, 99)).groupBy("category").pivot("percentile", [1, 99]).agg(F.first("value"))
    span = lambda m: F.transform(m, lambda x: x["e"] - x["s"] + 1)
    parts = [(t, "transcripts", F.array("len")), (monoexonic_genes(t), "monoexonic_genes", F.array("len")), (t, "exons", span("exons")), (t, "introns", span("introns"))]
    rows = None
    for source, name, m in parts:
        one = source.where(F.size(m) > 0).select(F.lit(name).alias("category"), "transcript_id", F.array_min(m).alias("lo"), F.array_max(m).alias("hi"))
        rows = one if rows is None else rows.union(one)
    value = F.when(F.col("lo") <= F.col("1"), F.col("lo")).when(F.col("hi") >= F.col("99"), F.col("hi"))
    return rows.join(quantiles, "category").select("category", "transcript_id", value.alias("value")).where("value is not null")


def transcript_genes(t: DataFrame, ids: DataFrame) -> DataFrame:
    """``gene_id, n, transcripts``: the ids of each gene, joined by ``;``."""
    return t.join(ids.select("transcript_id").distinct(), "transcript_id", "left_semi").groupBy("gene_id").agg(
        F.count_distinct("transcript_id").alias("n"), F.array_join(F.sort_array(F.collect_set("transcript_id")), ";").alias("transcripts")
    )


def spanned(t: DataFrame) -> DataFrame:
    """``transcript_id, label`` of transcripts in spanning groups, in loci that aren't uniform."""
    return structure.spanning(structure.with_kinds(t).where("not uniform"))


def potentially_chimeric(t: DataFrame, found: DataFrame | None = None) -> DataFrame:
    """Genes with transcripts that span others. ``found`` is what ``spanned`` gives, where it is known."""
    return transcript_genes(t, (spanned(t) if found is None else found).where("label <> 'rejected_segment'"))


def potentially_split(t: DataFrame, found: DataFrame | None = None) -> DataFrame:
    """Genes with transcripts that others span. ``found`` is what ``spanned`` gives, where it is known."""
    return transcript_genes(t, (spanned(t) if found is None else found).where("label = 'rejected_segment'"))


def potentially_fragmented(t: DataFrame, ratio: float = 0.7) -> DataFrame:
    """Genes in overlap groups of more than two multi-exonic transcripts with nearly as many consensus groups, at least ``ratio`` of them."""
    g = cut(overlap_groups(t.where("n_exons > 1")))
    c = consensus_groups(g, LOCUS).groupBy(*LOCUS).agg(F.count("*").alias("n"), F.count_distinct("consensus").alias("k"))
    many = c.where((F.col("n") > 2) & (F.col("k") > 1) & (F.col("k") / F.col("n") >= ratio))
    return transcript_genes(t, g.join(many, list(LOCUS), "left_semi"))


OTHER = ("unstranded", "intronic", "monoexonic_redundant", "monoexonic_antisense")


def other_numbers(t: DataFrame, other: DataFrame) -> DataFrame:
    """Genes and transcripts of each category of ``other_categories`` and their shares of all, also of those that have none."""
    total = t.agg(F.count("*").alias("_t"), F.count_distinct("gene_id").alias("_g"))
    names = t.sparkSession.createDataFrame([(x,) for x in OTHER], "category string")
    counts = other.groupBy("category").agg(F.count_distinct("gene_id").alias("genes"), F.count_distinct("transcript_id").alias("transcripts"))
    rows = names.join(counts, "category", "left").na.fill(0).crossJoin(total)  # one row
    return rows.select("category", "genes", percent(F.col("genes"), F.col("_g")).alias("genes_pct"), "transcripts", percent(F.col("transcripts"), F.col("_t")).alias("transcripts_pct"))


def interpolated(values: DataFrame, key: str = "category", points: tuple[int, ...] = PERCENTILES) -> DataFrame:
    """``key, percentile, value``: percentiles that lie between two values in proportion."""
    at = F.percentile("value", F.array(*[F.lit(p / 100) for p in points]))
    rows = values.groupBy(key).agg(at.alias("v")).select(key, F.posexplode("v").alias("i", "value"))
    return rows.select(key, F.element_at(F.array(*[F.lit(p) for p in points]), F.col("i") + 1).cast("long").alias("percentile"), "value")


def other_categories(t: DataFrame) -> DataFrame:
    """``category, transcript_id, gene_id``: unstranded, intronic, monoexonic_redundant and monoexonic_antisense."""
    ids = t.select("transcript_id", "gene_id")
    bare = location.unstranded(t).join(ids, "transcript_id").select(F.lit("unstranded").alias("category"), "transcript_id", "gene_id")
    g = cut(overlap_groups(t))
    lone = g.join(intronic(g, LOCUS), "transcript_id", "left_semi").select(*LOCUS, "transcript_id", "gene_id", "len")
    # a gene whose transcripts are all intronic in this group is redundant, but for the group's longest
    both = lone.groupBy(*LOCUS, "gene_id").agg(F.count("*").alias("_own")).join(t.groupBy("gene_id").agg(F.count("*").alias("_all")), "gene_id")
    top = F.row_number().over(Window.partitionBy(*LOCUS).orderBy(F.col("len").desc(), F.col("transcript_id")))
    marked = lone.withColumn("_r", top).join(both, [*LOCUS, "gene_id"])
    kind = F.when(F.col("_all") > F.col("_own"), "intronic").when(F.col("_r") > 1, "monoexonic_redundant")
    inside = marked.select(kind.alias("category"), "transcript_id", "gene_id").where("category is not null")
    anti = location.antisense_fragments(t, location.monoexonic_antisense(t), 1.0).where("label = 'antisense_fragment'").select("transcript_id").distinct()
    anti = anti.join(ids, "transcript_id").select(F.lit("monoexonic_antisense").alias("category"), "transcript_id", "gene_id")
    return bare.union(inside).union(anti)


def splice_junctions(t: DataFrame) -> DataFrame:
    """``scaffold, transcript_id, junctions`` of transcripts with introns."""
    return t.where("n_exons > 1").select(F.concat("seqname", "strand").alias("scaffold"), "transcript_id", chain(F.col("introns")).alias("junctions"))


def junction_percentiles(j: DataFrame) -> DataFrame:
    """``sample, percentile, value`` of unique reads of canonical junctions."""
    from .support import usable

    return percentiles(usable(j).where("canonical").select("sample", F.col("n_unique").alias("value")), key="sample")
