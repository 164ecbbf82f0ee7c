"""The driver's order lines as an annotation: loci, transcripts, junctions, abundances."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import model

SAMPLES = 3
KNOWN = ("chr0", "chr1", "chr2", "chr3")


def spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for each exon: its transcript's key ``k``, number of exons ``n`` and the exon's place ``i``, and what annotation rows hold."""
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").groupBy(F.col("l_orderkey").alias("k")).agg(F.count("*").alias("c"))
    # dealt out by transcript before there is a row for each exon, so that none of these moves
    lines = lines.withColumn("transcript_id", F.concat(F.lit("T"), F.lpad(F.col("k").cast("string"), 9, "0"))).repartition("transcript_id")
    floor = lambda n: F.floor(F.col("k") / n)
    t = lines.select(
        "k",
        "transcript_id",
        (F.col("k") % 5).alias("ch"),
        (floor(5) % 2).alias("sd"),
        floor(60).alias("locus"),
        (F.col("k") % 3).alias("off"),
        F.when(F.col("k") % 53 == 0, F.greatest("c", F.lit(14))).otherwise(F.col("c")).cast("int").alias("n"),
    )
    x = t.withColumn("i", F.explode(F.sequence(F.lit(1), F.col("n"))))
    base = F.col("locus") * 1000 + (F.col("off") + F.col("i")) * 100
    return x.select(
        "k",
        "n",
        "i",
        F.concat(F.lit("chr"), "ch").alias("seqname"),
        F.when(F.col("k") % 41 == 0, ".").when(F.col("sd") == 0, "+").otherwise("-").alias("strand"),
        F.concat(F.lit("G"), F.lpad((F.col("locus") * 10 + F.col("ch") * 2 + F.col("sd")).cast("string"), 9, "0")).alias("gene_id"),
        "transcript_id",
        (base + 1 - F.when((F.col("i") == 1) & (F.col("k") % 4 == 0), 10).otherwise(0)).cast("long").alias("s"),
        (base + 40 + F.when((F.col("i") == F.col("n")) & (F.col("k") % 7 == 0), 15).otherwise(0)).cast("long").alias("e"),
    )


def exons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(spark, sf_dir).select("seqname", "strand", "gene_id", "transcript_id", "s", "e")


#: Loci made to measure: variant, first and last key in the locus, strand, and exons. ``deep`` has overextended and
#: uniform transcripts, spanners and fragments, ``flat`` no locus with groups apart and no lone mono-exon.
SHAPES = {
    "deep": [
        (0, 0, 1, "+", [(1, 200), (1000, 1200), (2000, 2200), (9000, 9200)]),
        (1, 0, 0, "+", [(1, 200), (1000, 1200), (2000, 2200), (9000, 9200)]),
        (2, 0, 4, "+", [(1, 200), (1000, 1200), (2000, 2200), (9000, 9200)]),
        *[(v, 5, 12, "+", [(100, 300), (1000, 1200), (2000, 2250)]) for v in range(3)],
        *[(v, 13, 14, "+", [(1000, 1200), (2000, 2200)]) for v in range(3)],
        *[(v, 15, 15, "+", [(4000, 4300)]) for v in range(3)],
        *[(v, 16, 17, "+", [(8900, 9100), (9500, 9900)]) for v in range(3)],
        *[(v, 18, 18, "-", [(4100, 4200)]) for v in range(2)],
        (3, 0, 2, "+", [(1, 100), (500, 600)]),
        (3, 3, 5, "+", [(2000, 2100), (2500, 2600)]),
        (3, 6, 6, "+", [(1, 100), (500, 600), (2000, 2100), (2500, 2600)]),
        (4, 0, 0, "+", [(1, 100), (500, 600)]),
        (4, 3, 3, "+", [(2000, 2100), (2500, 2600)]),
        (4, 6, 8, "+", [(1, 100), (500, 600), (2000, 2100), (2500, 2600)]),
    ],
    "flat": [
        *[(v, 0, 2, "+", [(1, 100), (200, 300)]) for v in range(2)],
        *[(v, 3, 4, "+", [(250, 400), (500, 600)]) for v in range(2)],
        (0, 5, 5, "+", [(1, 100), (200, 300), (500, 600)]),
        (1, 5, 10, "+", [(1, 100), (200, 300), (500, 600)]),
        *[(v, 11, 11, "+", [(220, 280)]) for v in range(2)],
        *[(v, 12, 12, "-", [(1, 90), (300, 420)]) for v in range(2)],
    ],
}
PER_LOCUS, WIDTH = 20, 20_000


def shape_rows(name: str) -> list[tuple[int, int, str, int, int]]:
    """``variant, key in the locus, strand, s, e`` of every exon of a shape. Keys that it says nothing of are alike to those that it does, in turn."""
    out = []
    for variant in sorted({v for v, *_ in SHAPES[name]}):
        models = {j: (strand, exons) for v, a, b, strand, exons in SHAPES[name] if v == variant for j in range(a, b + 1)}
        said = sorted(models)
        for j in range(PER_LOCUS):
            strand, exons = models[j if j in models else said[j % len(said)]]
            out += [(variant, j, strand, s, e) for s, e in exons]
    return out


def shaped(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Transcripts of loci made to measure, one locus for each twenty order keys."""
    rows = shape_rows(name)
    variants = max(r[0] for r in rows) + 1
    shapes = spark.createDataFrame(rows, "variant long, j long, strand string, xs long, xe long")
    k = spark.read.parquet(f"{sf_dir}/orders.parquet").select(F.col("o_orderkey").alias("k")).distinct()
    locus = F.floor(F.col("k") / PER_LOCUS)
    x = k.select("k", locus.alias("locus"), (F.col("k") % PER_LOCUS).alias("j"), (locus % variants).alias("variant")).join(shapes, ["variant", "j"])
    return model.transcripts(
        x.select(
            F.concat(F.lit("chr"), F.col("locus") % 3).alias("seqname"),
            "strand",
            F.format_string("G%09d%s", "locus", "strand").alias("gene_id"),
            F.concat(F.lit("T"), F.lpad(F.col("k").cast("string"), 9, "0")).alias("transcript_id"),
            (F.col("locus") * WIDTH + F.col("xs")).alias("s"),
            (F.col("locus") * WIDTH + F.col("xe")).alias("e"),
        )
    )


def transcripts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return model.transcripts(exons(spark, sf_dir))


def junctions(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = transcripts(spark, sf_dir).select("seqname", "strand", F.explode("introns").alias("i")).select("seqname", "strand", "i.s", "i.e").distinct()
    h = F.floor(F.col("s") / 100)
    j = i.withColumn("f", F.explode(F.sequence(F.lit(0), F.lit(SAMPLES - 1))))
    return j.select(
        "seqname", "strand", "s", "e", F.concat(F.lit("sample"), "f").alias("sample"), ((h + F.col("f")) % 7).alias("motif"), ((h * 3 + F.col("f") * 5) % 6).alias("n_unique"), (5 + (h * 7 + F.col("f") * 11) % 40).alias("overhang")
    )


def quant(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = F.explode(F.sequence(F.lit(0), F.lit(SAMPLES - 1))).alias("f")
    o = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", f)
    return o.select(F.concat(F.lit("T"), F.lpad(F.col("o_orderkey").cast("string"), 9, "0")).alias("transcript_id"), F.concat(F.lit("sample"), "f").alias("sample"), (((F.col("o_orderkey") * 7 + F.col("f") * 13) % 40).cast("double") / 10).alias("tpm"))


def genome(spark: SparkSession) -> DataFrame:
    return spark.range(1).select(F.explode(F.array(*[F.lit(x) for x in KNOWN])).alias("seqname"))
