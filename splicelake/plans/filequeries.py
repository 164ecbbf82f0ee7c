"""Queries that go through files: the driver's tables written in the formats of annotation work and read back, runs included."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.intervals import chain, or_exons
from ..functions.lineage import cut, shared_dir, until_exit
from ..operators import finish, grouping, location, quantify, report, structure, support
from ..sources import fasta, files, model, reads, sinks
from ..streaming import incremental
from . import adapter
from .config import Config
from .pipeline import Run

#: Bases of a line of the test genome, those of a read, of a fragment at most, and of a k-mer.
WIDTH, READ, FRAGMENT, KMER, STRIDE, ROUNDS = 64, 36, 60, 21, 10, 12

#: Files that a task keeps open, and lines of a row of the test genome.
OPEN, BLOCK = 32, 64


def folder(spark: SparkSession) -> str:
    """A new folder that all executors share."""
    return until_exit(f"{shared_dir(spark)}/files-{uuid.uuid4().hex[:12]}")


@contextmanager
def at_once(spark: SparkSession) -> Iterator[None]:
    """Tasks keep a few files open meanwhile, so lines without an order needn't be sorted by file."""
    name = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(name)
    spark.conf.set(name, OPEN)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def put(spark: SparkSession, lines: DataFrame, at: str, *order: str, value: F.Column | str = "value") -> str:
    """Lines (``file, value``) as files of those names under a folder, which formats that go by the name of a file need. Each is written by a task, in ``order``, and then renamed.

    A ``value`` that is made of other columns is made where it is written: these move, not lines.
    """
    parts = f"{at}/_parts"
    dealt = lines.repartition("file")
    if order:
        dealt.sortWithinPartitions("file", *order).select("file", value).write.partitionBy("file").text(parts)
    else:
        with at_once(spark):
            dealt.select("file", value).write.partitionBy("file").text(parts)
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path
    store = path(parts).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for found in store.globStatus(path(f"{parts}/file=*/part-*")):
        name = unquote(found.getPath().getParent().getName().removeprefix("file="))
        to = path(f"{at}/{name}")
        store.mkdirs(to.getParent())
        store.rename(found.getPath(), to)
    store.delete(path(parts), True)
    return at


def _tsv(*columns) -> F.Column:
    return F.concat_ws("\t", *columns).alias("value")


def lines(spark: SparkSession, d: str) -> DataFrame:
    """The adapter's transcripts as lines of an annotation: exons, some with CDS, some with CDS only, some without either, ends swapped in some, and lines to pass over."""
    x = adapter.spread(spark, d).withColumns({"bare": F.expr("k % 43 = 0 and k % 37 <> 0"), "only": F.expr("k % 37 = 0")})
    kind = lambda name: x.withColumn("feature", F.lit(name))
    exons = kind("exon").where("not bare and not only")
    cds = kind("CDS").where("not bare and (only or k % 11 = 0 and n >= 2)").withColumns({"s": F.expr("s + if(i = 1, 5, 0)"), "e": F.expr("e - if(i = n, 5, 0)")})
    rows = exons.union(cds).union(kind("transcript").where("bare and i = 1"))
    swap = F.expr("k % 13 = 0")
    ids = F.format_string('gene_id "%s"; transcript_id "%s";', "gene_id", "transcript_id")
    file = F.concat("seqname", F.lit("/"), F.col("k") % 4, F.lit(".gtf")).alias("file")
    text = rows.select(_tsv("seqname", F.lit("src"), "feature", F.when(swap, F.col("e")).otherwise(F.col("s")), F.when(swap, F.col("s")).otherwise(F.col("e")), F.lit("."), "strand", F.lit("."), ids), file)
    odd = ["# a comment", "", "chr0\tsrc\texon\t1\t2\t.\t+\t.", 'chr0\tsrc\texon\t1\t2\t.\t+\t.\tgene_id "alone";']
    return text.union(spark.createDataFrame([(x, "chr0/0.gtf") for x in odd], "value string, file string"))


def annotation(spark: SparkSession, d: str) -> DataFrame:
    """Rows of the annotation, read from its file."""
    at = f"{folder(spark)}/rows"
    lines(spark, d).select("value").write.text(at)
    return files.gtf(spark, at)


def built(spark: SparkSession, d: str) -> DataFrame:
    return model.build(annotation(spark, d))[0]


def many_files(spark: SparkSession, d: str) -> str:
    """The annotation as files of one sequence and one key modulo four each, and one to pass over."""
    rows = lines(spark, d)
    return put(spark, rows.union(rows.where("file = 'chr0/0.gtf'").withColumn("file", F.lit("c_skipped.gtf"))), folder(spark))


def _tagged(spark: SparkSession, d: str) -> DataFrame:
    manifest = files.annotation_manifest(spark, many_files(spark, d))
    at = f"{folder(spark)}/manifest"
    sinks.write_table(manifest, at, ["File_tag"], ",")
    rows = files.annotations(spark, files.read_manifest(spark, at))
    return rows.groupBy("file_tag", "gene_id", "transcript_id").agg(F.count("*").alias("n"))


def _manifest(spark: SparkSession, d: str) -> DataFrame:
    name = F.regexp_extract("File_path", "([^/]+/[^/]+)$", 1)
    return files.annotation_manifest(spark, many_files(spark, d)).select(name.alias("name"), "File_tag")


def _junctions(spark: SparkSession, d: str) -> DataFrame:
    j = adapter.junctions(spark, d)
    code = F.when(F.col("strand") == "+", 1).when(F.col("strand") == "-", 2).otherwise(0)
    rows = j.select(F.concat("sample", F.lit("_"), "seqname", F.lit("SJ.out.tab")).alias("file"), _tsv("seqname", "s", "e", code, "motif", F.lit(0), "n_unique", F.lit(0), "overhang"))
    early = rows.withColumn("file", F.concat(F.lit("x_STARpass1/"), "file"))
    return files.junctions(spark, put(spark, rows.union(early), folder(spark)))


def _quant(spark: SparkSession, d: str) -> DataFrame:
    q = adapter.quant(spark, d).withColumn("file", F.concat("sample", F.lit("_"), F.pmod(F.hash("transcript_id"), F.lit(8)), F.lit("/quant.sf")))
    rows = q.select("file", F.lit(1).alias("i"), _tsv("transcript_id", F.lit(100), F.lit(90.5), "tpm", F.lit(7.0)))
    head = q.select("file").distinct().select("file", F.lit(0).alias("i"), F.lit("Name\tLength\tEffectiveLength\tTPM\tNumReads").alias("value"))
    found = files.quant(spark, put(spark, head.union(rows), folder(spark), "i"))
    return found.select("transcript_id", F.regexp_extract("sample", "([^/_]+)_[0-9]+/quant.sf$", 1).alias("sample"), "tpm")


def genome(spark: SparkSession, d: str) -> str:
    """A folder of FASTA files, one for each known sequence that has exons: bases from digests of names and places."""
    tops = adapter.exons(spark, d).groupBy("seqname").agg(F.max("e").alias("e")).where(F.col("seqname").isin(*adapter.KNOWN))
    chunk = lambda k: F.translate(F.md5(F.concat("seqname", F.lit(":"), k.cast("string")).cast("binary")), "0123456789abcdef", "ACGT" * 4)
    # many lines a row: a file is one task's, which sorts them
    top = F.floor(F.col("e") / WIDTH)
    rows = tops.select("seqname", top.alias("top"), F.explode(F.sequence(F.lit(-1).cast("long"), F.floor(top / BLOCK))).alias("i"))
    # a row a sequence before, and small after, so by itself one task's
    rows = rows.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "seqname", "i")
    here = F.sequence(F.col("i") * BLOCK, F.least(F.col("i") * BLOCK + BLOCK - 1, "top"))
    bases = F.array_join(F.transform(here, lambda k: F.concat(chunk(k * 2), chunk(k * 2 + 1))), "\n")
    value = F.when(F.col("i") < 0, F.concat(F.lit(">"), "seqname", F.lit(" made"))).otherwise(bases)
    return put(spark, rows.select(F.concat("seqname", F.lit(".fa")).alias("file"), "i", value.alias("value")), folder(spark), "i")


def transcriptome(spark: SparkSession, d: str) -> DataFrame:
    """``transcript_id, sequence`` of the adapter's transcripts on the genome's files."""
    return sinks.spliced(adapter.transcripts(spark, d), fasta.pieces(spark, genome(spark, d)))


def _spliced(spark: SparkSession, d: str) -> str:
    at = f"{folder(spark)}/spliced"
    sinks.write_fasta(transcriptome(spark, d), at)
    return at


def _sequences(spark: SparkSession, d: str) -> DataFrame:
    return files.fasta(spark, _spliced(spark, d)).select(F.col("seqname").alias("transcript_id"), "sequence")


def fragments_of(sequences: DataFrame) -> DataFrame:
    """Pairs of reads cut from transcripts, by their numbers: one to four of each, from either strand, in three samples of four lanes."""
    t = sequences.select("transcript_id", "sequence", F.substring("transcript_id", 2, 9).cast("long").alias("k"), F.length("sequence").alias("n")).where(F.col("n") >= READ)
    t = t.withColumn("j", F.explode(F.sequence(F.lit(0), (F.col("k") % 4).cast("int")))).withColumn("f", F.least("n", F.lit(FRAGMENT)))
    t = t.withColumn("p", ((F.col("k") * 7 + F.col("j") * 13) % (F.col("n") - F.col("f") + 1)).cast("int"))
    left = F.substring("sequence", F.col("p") + 1, F.lit(READ))
    right = quantify.complement(F.substring("sequence", F.col("p") + F.col("f") - READ + 1, F.lit(READ)))
    turned = (F.col("k") + F.col("j")) % 2 == 1
    lane = F.concat(F.lit("sample"), F.col("k") % 3, F.lit("/lane"), F.floor(F.col("k") / 3) % 4)
    return t.select("k", "j", lane.alias("lane"), F.when(turned, right).otherwise(left).alias("first"), F.when(turned, left).otherwise(right).alias("second"))


def read_files(spark: SparkSession, d: str, sequences: DataFrame | None = None) -> str:
    """FASTQ files of pairs of the transcripts' ``sequences``. Quality lines may begin as headers or marks do."""
    pairs = fragments_of(cut(transcriptome(spark, d)) if sequences is None else sequences)
    mates = F.explode(F.array(*[F.struct(F.lit(m).alias("mate"), F.col(c).alias("bases")) for m, c in ((1, "first"), (2, "second"))]))
    rows = pairs.select("k", "j", "lane", mates.alias("x")).select("k", "j", "lane", "x.*")
    quality = F.concat(F.substring(F.lit("@+I#"), F.col("j") + 1, F.lit(1)), F.lit("I" * (READ - 1)))
    value = F.concat(F.format_string("@read_%d_%d/%d of it", "k", "j", "mate"), F.lit("\n"), "bases", F.lit("\n+\n"), quality)
    return put(spark, rows.select(F.format_string("%s_R%d.fastq", "lane", "mate").alias("file"), "k", "j", "mate", "bases"), folder(spark), "k", "j", value=value.alias("value"))


_LANE = "([^/]+/[^/]+)$"


def _fastq(spark: SparkSession, d: str) -> DataFrame:
    return files.fastq_manifest(spark, read_files(spark, d)).select(*[F.regexp_extract(c, _LANE, 1).alias(c) for c in ("File_pair_1", "File_pair_2")])


def _records(spark: SparkSession, d: str) -> DataFrame:
    return reads.records(spark, read_files(spark, d), "*.fastq").select(F.regexp_extract("path", _LANE, 1).alias("file"), "record", "name", "sequence", "quality", "intact")


def _quantified(spark: SparkSession, d: str) -> DataFrame:
    sequences = cut(transcriptome(spark, d))
    manifest = files.fastq_manifest(spark, read_files(spark, d, sequences)).withColumn("sample", F.regexp_extract("File_pair_1", "([^/]+)/[^/]+$", 1))
    found = quantify.quantify(sequences, cut(reads.pairs(spark, manifest)), KMER, STRIDE, FRAGMENT, ROUNDS, 0.0)
    return found.select("sample", "transcript_id", "length", "effective_length", F.round("tpm", 4).alias("tpm"), F.round("num_reads", 6).alias("num_reads"))


def _utr(spark: SparkSession, d: str) -> DataFrame:
    part = lambda name, c: F.transform(F.filter(c, lambda x: x.isNotNull()), lambda x: F.struct(F.lit(name).alias("region"), x["s"].alias("s"), x["e"].alias("e")))
    of = {"five_prime": F.col("five_prime"), "three_prime": F.col("three_prime"), "start_codon": F.array("start_codon"), "stop_codon": F.array("stop_codon")}
    parts = F.flatten(F.array(*[F.coalesce(part(name, c), F.array()) for name, c in of.items()]))
    return built(spark, d).select("transcript_id", F.inline(parts))


def _model(spark: SparkSession, d: str) -> DataFrame:
    long = lambda c: F.col(c).cast("long").alias(c)
    return built(spark, d).select("seqname", "strand", "gene_id", "transcript_id", "s", "e", long("n_exons"), F.size("cds").cast("long").alias("n_cds"))


def _written(spark: SparkSession, d: str) -> DataFrame:
    rows, at = annotation(spark, d), f"{folder(spark)}/kept"
    sinks.write_gtf(rows, rows.where("strand = '+'").select("transcript_id"), at)
    return files.gtf(spark, at).select("feature", "transcript_id", "gene_id", "s", "e")


def _padded(spark: SparkSession, d: str) -> DataFrame:
    rows, at = annotation(spark, d), f"{folder(spark)}/padded"
    sinks.write_modified_gtf(rows, cut(finish.padded(cut(model.build(rows)[0])).select("transcript_id", "padded")), at)
    return files.gtf(spark, at).select("feature", "transcript_id", "s", "e", "score")


def _renamed(spark: SparkSession, d: str) -> DataFrame:
    rows, at = annotation(spark, d), f"{folder(spark)}/renamed"
    sinks.write_renamed_gtf(rows, cut(finish.reannotate(cut(model.build(rows)[0]), "NEW")), at)
    return files.gtf(spark, at).select("feature", "transcript_id", "gene_id", "s", "e")


def _split(spark: SparkSession, d: str) -> DataFrame:
    rows, at = annotation(spark, d), f"{folder(spark)}/split"
    side = F.when(F.col("strand") == "+", "plus").when(F.col("strand") == "-", "minus").otherwise("none")
    sinks.write_split(rows, rows.select("transcript_id", side.alias("side")).distinct(), "side", at)
    return spark.read.text(at).groupBy("side").agg(F.count("*").alias("n"))


def _table(spark: SparkSession, d: str) -> DataFrame:
    at = f"{folder(spark)}/bounds"
    sinks.write_table(model.genes(adapter.transcripts(spark, d)), at, ["gene_id"])
    return spark.read.schema("gene_id string, s long, e long").option("header", True).option("sep", "\t").csv(at)


def _locations(spark: SparkSession, d: str) -> DataFrame:
    at = f"{folder(spark)}/locations"
    sinks.write_locations(adapter.transcripts(spark, d), at)
    return spark.read.option("header", True).csv(at)


def _lookups(spark: SparkSession, d: str) -> DataFrame:
    at = folder(spark)
    sinks.write_lookups(cut(finish.reannotate(cut(adapter.transcripts(spark, d)), "NEW")), at)
    one = lambda kind: spark.read.option("header", True).csv(f"{at}/{kind}_ids").withColumn("kind", F.lit(kind))
    return one("gene").union(one("transcript"))


def _rejected(spark: SparkSession, d: str) -> DataFrame:
    at = folder(spark)
    sinks.rejected_junctions(support.junction_support(adapter.junctions(spark, d), 4, 2), at)
    one = lambda kind: spark.read.option("header", True).csv(f"{at}/{kind}").withColumn("kind", F.lit(kind))
    return one("non_canonical").union(one("low_reads"))


def _interpolated(spark: SparkSession, d: str) -> DataFrame:
    values = adapter.transcripts(spark, d).select("seqname", F.col("len").alias("value"))
    return report.interpolated(values, "seqname").withColumn("value", F.round("value", 6))


def _other_numbers(spark: SparkSession, d: str) -> DataFrame:
    t = cut(adapter.transcripts(spark, d))
    return report.other_numbers(t, cut(report.other_categories(t)))


def _run(spark: SparkSession, d: str) -> DataFrame:
    """The numbers of all stages of a whole run over the annotation as references, as its table of metrics has them."""
    at = folder(spark)
    put(spark, lines(spark, d), f"{at}/in")
    c = Config(f"{at}/out", "run", references=f"{at}/in")
    Run(spark, c)()
    return spark.read.schema("Category string, File string, n long").option("header", True).option("sep", "\t").csv(c.folder("report", "pipeline_numbers"))


def _kept_up(spark: SparkSession, d: str) -> DataFrame:
    """Transcripts that stay the longest of their chain or locus, after files that came one by one."""
    at = folder(spark)
    t = cut(adapter.transcripts(spark, d))
    # four batches of many files, so that no task has a quarter of the rows
    each = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")) // 4)
    t.repartition(4 * each, "transcript_id").write.parquet(f"{at}/in")
    stream = spark.readStream.schema(t.schema).option("maxFilesPerTrigger", each).parquet(f"{at}/in")
    incremental.redundancy_state(stream, f"{at}/state", f"{at}/checkpoint").awaitTermination()
    chains, loci = incremental.current(spark, f"{at}/state")
    return chains.select("transcript_id").union(loci.select("transcript_id"))


def _counts(spark: SparkSession, d: str) -> DataFrame:
    counts, _ = support.junction_counts(adapter.junctions(spark, d))
    return counts.select("sj", F.array_join(F.transform("reads", lambda n: n.cast("string")), ",").alias("reads"))


def _shaped(name: str, f: Callable[[DataFrame], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, d: f(cut(adapter.shaped(spark, d, name)))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "gtf_rows": lambda spark, d: annotation(spark, d).select("feature", "seqname", "strand", "gene_id", "transcript_id", "s", "e"),
    "gtf_model": _model,
    "missing_exons": lambda spark, d: model.build(annotation(spark, d))[1],
    "cds_or_exons": lambda spark, d: built(spark, d).select("transcript_id", chain(or_exons(F.col("cds"), F.col("exons"))).alias("chain")),
    "utr_regions": _utr,
    "annotation_manifest": _manifest,
    "gtf_tagged": _tagged,
    "fastq_manifest": _fastq,
    "sj_files": lambda spark, d: _junctions(spark, d).select("seqname", "strand", "s", "e", "sample", F.col("motif").cast("long").alias("motif"), "n_unique", F.col("overhang").cast("long").alias("overhang")),
    "quant_files": _quant,
    "fasta_names": lambda spark, d: files.fasta_names(spark, _spliced(spark, d)),
    "spliced_fasta": _sequences,
    "fastq_records": _records,
    "quantified": _quantified,
    "written_gtf": _written,
    "padded_gtf": _padded,
    "renamed_gtf": _renamed,
    "split_gtf": _split,
    "table_file": _table,
    "location_file": _locations,
    "lookup_files": _lookups,
    "rejected_files": _rejected,
    "interpolated_percentiles": _interpolated,
    "other_numbers": _other_numbers,
    "run_metrics": _run,
    "kept_up_winners": _kept_up,
    "sj_counts": _counts,
    "deep_fragments": _shaped("deep", structure.fragments),
    "deep_structural": _shaped("deep", structure.structural),
    "deep_chimeric": _shaped("deep", lambda t: structure.chimeric(t)),
    "deep_intronic": _shaped("deep", lambda t: grouping.intronic(grouping.overlap_groups(t), structure.LOCUS)),
    "flat_structural": _shaped("flat", structure.structural),
    "flat_location": _shaped("flat", lambda t: location.location(t)),
}
