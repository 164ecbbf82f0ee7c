"""Readers of the text formats that annotation work uses. All of them are splittable scans with fixed schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.attributes import attribute, tagged
from ..operators.support import strand_of

JUNCTION_SCHEMA = "seqname string, s long, e long, strand_code int, motif int, annotated int, n_unique long, n_multi long, overhang int"
QUANT_SCHEMA = "transcript_id string, length long, effective_length double, tpm double, reads double"
MANIFEST_SCHEMA = "File_path string, File_tag string"
FASTQ_ENDINGS = ("fq.gz", "fq", "fastq.gz", "fastq")


def _numbered(spark: SparkSession, paths: list[str] | str, glob: str) -> DataFrame:
    """Lines with ``path`` and ``line_no``: an order within the file that follows the lines, block by block."""
    lines = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", glob).text(paths)
    at = F.struct(F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row"))
    return lines.select("value", F.col("_metadata.file_path").alias("path"), at.alias("line_no"))


def gtf(spark: SparkSession, paths: list[str] | str, tag: str | None = None, glob: str = "*", exact: bool = False) -> DataFrame:
    """Rows of annotation files: nine fields, both ids, no comment lines; ``start`` and ``end`` in order.

    ``line_no`` orders the rows of a file. Given a ``tag``, ids end with it. ``exact`` reads ids from whole attribute names only.
    """
    rows = _numbered(spark, paths, glob).where(~F.col("value").startswith("#") & (F.trim("value") != ""))
    f = F.split("value", "\t")
    rows = rows.where(F.size(f) == 9)
    names = ("seqname", "source", "feature", "start", "end", "score", "strand", "frame", "attr")
    rows = rows.select("path", "line_no", F.col("value").alias("raw_line"), *[f[i].alias(n) for i, n in enumerate(names)])
    if tag is not None:
        rows = rows.withColumn("attr", tagged(F.col("attr"), F.lit(tag)))
    a, b = F.col("start").cast("long"), F.col("end").cast("long")
    return (
        rows.withColumns({"gene_id": attribute(F.col("attr"), "gene_id", exact), "transcript_id": attribute(F.col("attr"), "transcript_id", exact), "s": F.least(a, b), "e": F.greatest(a, b)})
        .where("gene_id is not null and transcript_id is not null and s is not null and e is not null")
        .select(F.col("path").alias("file_tag"), "line_no", "seqname", "source", "feature", "s", "e", "score", "strand", "frame", "attr", "gene_id", "transcript_id", "raw_line")
    )


def annotations(spark: SparkSession, manifest: DataFrame, exact: bool = False) -> DataFrame:
    """All files of a manifest as one table. Ids get their file's tag where there are several files."""
    files = manifest.collect()  # one row a file
    if len({r["File_tag"] for r in files}) != len(files):
        raise ValueError("file tags must be unique")
    rows = gtf(spark, [r["File_path"] for r in files], exact=exact)
    if len(files) < 2:
        return rows
    names = F.broadcast(manifest.select(F.col("File_path").alias("_path"), F.col("File_tag").alias("_tag")))
    same = F.regexp_replace("file_tag", "^file:/+", "/") == F.regexp_replace("_path", "^file:/+", "/")
    rows = rows.join(names, same)
    attr = tagged(F.col("attr"), F.col("_tag"))
    rows = rows.withColumns({"attr": attr, "file_tag": F.col("_tag")}).drop("_path", "_tag")
    raw = F.concat_ws("\t", F.slice(F.split("raw_line", "\t"), 1, 8)[0], *[F.split("raw_line", "\t")[i] for i in range(1, 8)], "attr")
    return rows.withColumns({"gene_id": attribute(F.col("attr"), "gene_id", exact), "transcript_id": attribute(F.col("attr"), "transcript_id", exact), "raw_line": raw})


def _paths(spark: SparkSession, folder: str, glob: str) -> DataFrame:
    """Paths of the files under a folder, without their content."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(folder).select("path")


def annotation_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """``File_path, File_tag`` of the annotations under a folder, tagged file1, file2, ... in order of path."""
    found = _paths(spark, folder, "*.gtf").where(~F.col("path").endswith("skipped.gtf"))
    return found.select(F.col("path").alias("File_path"), F.concat(F.lit("file"), F.row_number().over(Window.orderBy("path"))).alias("File_tag"))


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """A manifest file; its tags must be unique."""
    m = spark.read.schema(MANIFEST_SCHEMA).option("header", True).csv(path)
    if m.count() != m.select("File_tag").distinct().count():
        raise ValueError(f"file tags in {path} must be unique")
    return m


def fastq_manifest(spark: SparkSession, folder: str, paired: bool = True) -> DataFrame:
    """Read files under a folder, of the first ending that any has; pairs are neighbours in order of path."""
    for ending in FASTQ_ENDINGS:
        found = _paths(spark, folder, f"*.{ending}")
        n = found.count()
        if n:
            break
    else:
        raise ValueError(f"no FASTQ files in {folder}")
    if paired and n % 2:
        raise ValueError(f"{n} FASTQ files in {folder} don't make pairs")
    ranked = found.withColumn("r", F.row_number().over(Window.orderBy("path")) - 1)
    if not paired:
        return ranked.select(F.col("path").alias("File_pair_1"))
    return ranked.groupBy(F.floor(F.col("r") / 2).alias("k")).agg(F.min_by("path", "r").alias("File_pair_1"), F.max_by("path", "r").alias("File_pair_2")).orderBy("k").drop("k")


def junctions(spark: SparkSession, folder: str) -> DataFrame:
    """Splice-junction tables ``*SJ.out.tab`` under a folder; ``sample`` is the file name. First-pass tables are left out."""
    rows = spark.read.schema(JUNCTION_SCHEMA).option("sep", "\t").option("recursiveFileLookup", True).option("pathGlobFilter", "*SJ.out.tab").csv(folder)
    rows = rows.select("*", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_name").alias("sample")).where(~F.col("path").contains("STARpass1"))
    return rows.select("seqname", strand_of(F.col("strand_code")).alias("strand"), "s", "e", "sample", "motif", "n_unique", "overhang")


def quant(spark: SparkSession, folder: str) -> DataFrame:
    """Abundance tables ``*.sf`` under a folder."""
    rows = spark.read.schema(QUANT_SCHEMA).option("sep", "\t").option("header", True).option("recursiveFileLookup", True).option("pathGlobFilter", "*.sf").csv(folder)
    return rows.select("transcript_id", F.col("_metadata.file_path").alias("sample"), "tpm").where("tpm is not null")


def fasta_names(spark: SparkSession, path: str) -> DataFrame:
    """``seqname`` of a FASTA file: what follows ``>`` up to a space, tab or ``#``."""
    return spark.read.text(path).where(F.col("value").startswith(">")).select(F.regexp_extract("value", "^>+([^\\t #]*)", 1).alias("seqname"))


def fasta(spark: SparkSession, path: str) -> DataFrame:
    """``seqname, sequence``. Records are cut at the header mark, so one record is one row."""
    rows = spark.read.option("lineSep", "\n>").text(path).where(F.trim("value") != "")
    head = F.regexp_replace(F.substring_index("value", "\n", 1), "^>+", "")
    body = F.regexp_replace(F.regexp_replace("value", r"^[^\n]*(\n|$)", ""), r"\s", "")
    return rows.select(F.regexp_extract(head, "^([^\\t #]*)", 1).alias("seqname"), body.alias("sequence"))
