"""A whole run: from annotation files to a quality-controlled annotation with reports.

Stages hand on ids, not files: rows stay as they were read, every stage labels
transcripts, and lines are joined again only where they are written.
"""

from __future__ import annotations

import logging
from collections.abc import Callable
from datetime import UTC, datetime
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.lineage import bucketed, cut, exists
from ..operators import finish, location, quantify, redundancy, report, structure, support
from ..sources import fasta, files, model, reads, sinks
from .config import Config


log = logging.getLogger("splicelake")


class Pending(Exception):
    """A run stops here until tables that other tools make are there; what it did so far is kept."""


class Run:
    """All stages of a run. Labels of each stage and the models that were read stay under ``stages``: a run that resumes reads them instead."""

    def __init__(self, spark: SparkSession, config: Config):
        self.spark, self.c = spark, config.checked()
        self.metrics: list[tuple[str, str, int]] = []
        self.lines: list[tuple[int, str]] = []

    def say(self, text: str) -> None:
        log.info(text)
        self.lines.append((len(self.lines), f"{datetime.now(UTC):%Y-%m-%d %H:%M:%S} {text}"))

    def kept(self, name: str, make: Callable[[], DataFrame]) -> DataFrame:
        """The table of a stage: that of the earlier run if this one resumes and it is whole, else written now."""
        at = self.c.folder("stages", name)
        if self.c.resume and exists(self.spark, f"{at}/_SUCCESS"):
            self.say(f"{name}: taken from the earlier run")
        else:
            make().write.mode("overwrite").parquet(at)
            self.say(f"{name}: done")
        return self.spark.read.parquet(at)

    def options(self) -> None:
        """Keep what decides the results beside them; a run resumes only under the same options."""
        at, own = self.c.folder("stages", "options"), self.c.fingerprint()
        if self.c.resume and exists(self.spark, f"{at}/_SUCCESS"):
            if self.spark.read.text(at).first()["value"] != own:
                raise ValueError(f"{self.c.folder()} was made with other options; it can't be resumed")
        else:
            self.spark.createDataFrame([(own,)], "value string").coalesce(1).write.mode("overwrite").text(at)

    def stage(self, name: str, rows: DataFrame, t: DataFrame, labels: Callable[[], DataFrame], good: tuple[str, ...] = ("accepted",), column: str = "label") -> DataFrame:
        """Transcripts with a good label; counts of all labels go to the metrics, with ``keep removed`` the lines of the others to files by label."""
        labels = self.kept(name, lambda: labels_of(labels(), column))
        for row in labels.groupBy("label").count().orderBy("label").collect():
            self.metrics.append(("Accepted" if row["label"] in good else "Removed", f"{name}_{row['label']}", row["count"]))
        bad = labels.where(~F.col("label").isin(*good))
        if "removed" in self.c.keep:
            sinks.write_table(bad, self.c.folder("removed", name, "ids"), ["label", "transcript_id"])
            sinks.write_split(rows, bad, "label", self.c.folder("removed", name, "gtf"))
        kept = cut(t.join(labels.where(F.col("label").isin(*good)).select("transcript_id"), "transcript_id", "left_semi"))
        if "intermediary" in self.c.keep:
            sinks.write_gtf(rows, kept, self.c.folder("intermediary", name))
        return kept

    def read(self, name: str, folder: str) -> tuple[DataFrame, DataFrame]:
        """Rows and transcripts of a folder of annotations; transcripts without exons are listed, not built."""
        rows = files.annotations(self.spark, files.annotation_manifest(self.spark, folder), exact=self.c.semantics == "corrected")
        rows = bucketed(rows, "transcript_id")  # files are read once; models and all writers join rows by that
        t = self.kept(f"{name}_model", lambda: model.build(rows)[0])
        missing = rows.select("transcript_id").distinct().join(t.select("transcript_id"), "transcript_id", "left_anti")
        sinks.write_table(missing, self.c.folder("report", f"missing_exons_{folder.rstrip('/').rpartition('/')[2]}"), ["transcript_id"])
        if t.isEmpty():
            raise ValueError(f"no transcript in {folder}")
        return rows, t

    def assemblies(self) -> tuple[DataFrame, DataFrame]:
        c = self.c
        rows, t = self.read("assemblies", c.assemblies)
        t = self.stage("assemblies_redundancy", rows, t, lambda: redundancy.redundancy(t, c.semantics, "redundant" in c.disable))
        u = self.stage("assemblies_location", rows, t, lambda: location.location(t, files.fasta_names(self.spark, c.genome), c.antisense_len, c.add, c.semantics))
        seen = self.kept("junctions", lambda: support.junction_support(files.junctions(self.spark, c.sj_data), *c.sj_reads))
        sinks.rejected_junctions(seen, c.folder("removed", "junctions"))
        v = self.stage("assemblies_junctions", rows, u, lambda: support.by_junctions(u, seen.where("supported")), ("true",), "supported")
        if not c.quant and not c.quantify:
            self.to_quantify(v)
        counts = self.counted(v) if c.quantify else files.quant(self.spark, c.quant)
        w = self.stage("assemblies_abundance", rows, v, lambda: support.by_abundance(v, counts, *c.tpm), ("abundant",))
        return rows, w

    def counted(self, t: DataFrame) -> DataFrame:
        """Abundances of transcripts from the reads of the run, a sample for each pair of files, written as tables of the usual kind too."""
        c = self.c

        def count() -> DataFrame:
            manifest = files.fastq_manifest(self.spark, c.fastq).withColumn("sample", reads.sample_of(F.col("File_pair_1")))
            return quantify.quantify(cut(sinks.spliced(t, fasta.pieces(self.spark, c.genome))), cut(reads.pairs(self.spark, manifest)))

        found = self.kept("abundances", count)
        sinks.write_quant(found, c.folder("quantify", "abundances"))
        return found

    def to_quantify(self, t: DataFrame) -> None:
        """Write what a quantifier needs, the spliced transcripts and the pairs of read files, and stop."""
        at = self.c.folder("quantify")
        sinks.write_fasta(sinks.spliced(t, fasta.pieces(self.spark, self.c.genome)), f"{at}/transcripts")
        sinks.write_table(files.fastq_manifest(self.spark, self.c.fastq), f"{at}/reads", ["File_pair_1"], ",")
        raise Pending(f"quantify the reads listed in {at}/reads against {at}/transcripts, then run again with --quant (the folder of .sf tables) and --resume")

    def __call__(self) -> DataFrame:
        """Run all stages, write the results, and return the final transcripts with their new ids."""
        c = self.c
        if not c.overwrite and not c.resume and exists(self.spark, c.folder()):
            raise ValueError(f"{c.folder()} exists; resume it, overwrite it or choose another name")
        self.options()
        parts = [self.assemblies()] if c.assemblies else []
        if c.references:
            parts.append(self.read("references", c.references))
        rows, t = parts[0]
        for more_rows, more in parts[1:]:
            rows, t = bucketed(rows.unionByName(more_rows), "transcript_id"), cut(t.unionByName(more))
        u = self.stage("merged_redundancy", rows, t, lambda: redundancy.redundancy(t, c.semantics, "redundant" in c.disable))
        v = self.stage("merged_location", rows, u, lambda: location.location(u, None, c.antisense_len, c.add, c.semantics))
        decision = lru_cache(lambda: structure.decide(v, c.fragment_len, c.add, "chimeric" in c.disable, c.semantics))
        w = self.stage("merged_structure", rows, v, lambda: decision().labels)
        if "exploratory" in c.keep:
            sinks.write_split(rows, self.kept("structure_sets", lambda: decision().sets), "set", c.folder("exploratory"))
        ids = cut(finish.reannotate(w, c.prefix))
        sinks.write_renamed_gtf(rows, ids, c.folder("final"))
        sinks.write_lookups(ids, c.folder("lookup"))
        final = cut(
            w.join(ids.select("transcript_id", "new_transcript_id", "new_gene_id"), "transcript_id")
            .drop("transcript_id", "gene_id")
            .withColumnsRenamed({"new_transcript_id": "transcript_id", "new_gene_id": "gene_id"})
        )
        sinks.write_table(finish.mapping(final), c.folder("mapping"), ["GENEID", "TXNAME"], ",")
        if c.genome:
            sinks.write_fasta(sinks.spliced(final, fasta.pieces(self.spark, c.genome)), c.folder("fasta"))
        renamed = files.gtf(self.spark, c.folder("final"))
        sinks.write_modified_gtf(renamed, finish.padded(final), c.folder("padded"))
        reports(final, c.folder("report"))
        if c.sj_data:
            j = files.junctions(self.spark, c.sj_data)
            sinks.write_matrix(*support.junction_counts(j), c.folder("report", "numbers_splice_junction_reads"))
            sinks.write_table(report.junction_percentiles(j), c.folder("report", "SJ_reads_percentiles"), ["sample", "percentile"])
        metrics = self.spark.createDataFrame(self.metrics, "Category string, File string, `Nº of transcripts` long")
        sinks.write_table(metrics.coalesce(1), c.folder("report", "pipeline_numbers"))
        self.say("all done")
        self.spark.createDataFrame(self.lines, "at int, value string").coalesce(1).sortWithinPartitions("at").select("value").write.mode("overwrite").text(c.folder("log"))
        return final


def labels_of(labels: DataFrame, column: str) -> DataFrame:
    return labels.select("transcript_id", F.col(column).cast("string").alias("label"))


def reports(t: DataFrame, folder: str) -> None:
    """All tables that describe one annotation."""
    other, found = cut(report.other_categories(t)), cut(report.spanned(t))
    kinds = report.gene_kinds(t)
    tables = {
        "numbers_scaffolds": (report.scaffold_counts(t), ["scaffold"]),
        "numbers_gene_categories": (report.gene_categories(t), ["kind"]),
        "numbers_other_categories": (report.other_numbers(t, other), ["category"]),
        **{f"IDs_other_categories_{x}": (other.where(F.col("category") == x).select(F.col("transcript_id").alias("Transcript_ID")), ["Transcript_ID"]) for x in report.OTHER},
        "numbers_isoforms": (report.isoform_histogram(t), ["isoforms"]),
        "IDs_isoforms": (kinds.select("gene_id", "isoforms"), ["isoforms", "gene_id"]),
        "potentially_chimeric_genes": (report.potentially_chimeric(t, found), ["n", "gene_id"]),
        "potentially_split_genes": (report.potentially_split(t, found), ["n", "gene_id"]),
        "potentially_fragmented_genes": (report.potentially_fragmented(t), ["n", "gene_id"]),
        "lengths_percentiles": (report.percentiles(report.lengths(t)), ["category", "percentile"]),
        "lengths_outliers": (report.length_outliers(t), ["category", "value", "transcript_id"]),
        "IDs_splice_junction": (report.splice_junctions(t), ["scaffold", "transcript_id"]),
    }
    for name, (df, order) in tables.items():
        sinks.write_table(df, f"{folder}/{name}", order)
