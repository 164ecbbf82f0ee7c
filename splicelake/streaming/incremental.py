"""Redundancy of equal intron chains over files that keep arriving.

The longest transcript of a chain is an associative choice, so micro-batches can
be merged into a table of winners. So is the longest mono-exon of a locus, once loci are spans: a later
transcript may bridge two of them, which are one from then on. ``redundancy_state`` writes only
what a batch changes, chains and loci, as versions; ``current`` reads the last of each.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions import bins
from ..functions.lineage import exists, listed
from ..operators.grouping import STRAND_KEY, overlap_groups
from ..operators.redundancy import merge_winners

LOCUS = (*STRAND_KEY, "s")
_CHAINS = "introns array<struct<s: bigint, e: bigint>>, len long, transcript_id string, version long"
_LOCI = "seqname string, strand string, s long, e long, len long, transcript_id string, gone boolean, version long"


def winners(transcripts: DataFrame, path: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Keep under ``path`` one version per batch, ``v=<batch>``, of the winners of a stream of multi-exonic transcripts.

    A batch that is run again overwrites its own version and reads the one before, so retries change nothing.
    """

    def merge(batch: DataFrame, number: int) -> None:
        before = f"{path}/v={number - 1}"
        batch = batch.where("n_exons > 1")
        old = batch.sparkSession.read.parquet(before) if number and exists(batch.sparkSession, before) else batch.limit(0)
        merge_winners(old, batch).write.mode("overwrite").parquet(f"{path}/v={number}")

    writer = transcripts.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def _versions(spark: SparkSession, path: str, schema: str, below: int | None) -> DataFrame:
    """All versions of a part of the state, or those before a batch: one that is run again neither reads nor minds what it left."""
    numbers = [int(x.rpartition("=")[2]) for x in listed(spark, f"{path}/version=*")]
    held = [f"{path}/version={n}" for n in sorted(numbers) if below is None or n < below]
    return spark.read.schema(schema).option("basePath", path).parquet(*held) if held else spark.createDataFrame([], schema)


def _last(rows: DataFrame, key: tuple[str, ...]) -> DataFrame:
    rest = [c for c in rows.columns if c not in key]
    return rows.groupBy(*key).agg(F.max_by(F.struct(*rest), "version").alias("x")).select(*key, "x.*")


def current(spark: SparkSession, path: str, below: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Winners by chain (``introns, len, transcript_id``) and by locus of mono-exons (``seqname, strand, s, e, len, transcript_id``) after the batches so far."""
    chains = _last(_versions(spark, f"{path}/chains", _CHAINS, below), ("introns",))
    loci = _last(_versions(spark, f"{path}/loci", _LOCI, below), LOCUS).where("not gone")
    return chains.drop("version"), loci.drop("gone", "version")


def _changed_chains(old: DataFrame, batch: DataFrame) -> DataFrame:
    """Chains that a batch has a longer transcript for, of equal ones a larger id."""
    new = batch.where("n_exons > 1").groupBy("introns").agg(F.max(F.struct("len", "transcript_id")).alias("n"))
    both = new.join(old.select("introns", F.struct("len", "transcript_id").alias("o")), "introns", "left")
    return both.where("o is null or n > o").select("introns", "n.*")


def _changed_loci(old: DataFrame, batch: DataFrame) -> DataFrame:
    """Loci that a batch touches, formed again with it, and those gone into others."""
    single = batch.where("n_exons = 1").select(*STRAND_KEY, "s", "e", "len", "transcript_id")
    asked = single.select(*STRAND_KEY, F.col("s").alias("_s"), F.col("e").alias("_e"), F.explode(bins.met(F.col("s"), F.col("e"))).alias("home")).distinct()
    homed = old.withColumn("home", bins.home(F.col("s"), F.col("e")))
    touched = homed.join(asked, [*STRAND_KEY, "home"]).where("_s <= e and s <= _e").select(*single.columns).distinct()
    formed = overlap_groups(single.unionByName(touched)).groupBy(*STRAND_KEY, "locus").agg(F.max("e").alias("e"), F.max(F.struct("len", "transcript_id")).alias("x"))
    formed = formed.select(*STRAND_KEY, F.col("locus").alias("s"), "e", "x.*", F.lit(False).alias("gone"))
    gone = touched.join(formed, list(LOCUS), "left_anti").withColumn("gone", F.lit(True))
    return formed.unionByName(gone)


def merge_batch(batch: DataFrame, path: str, number: int) -> None:
    """What a batch of transcripts changes in the state under ``path``, as version ``number``."""
    chains, loci = current(batch.sparkSession, path, number)
    _changed_chains(chains, batch).write.mode("overwrite").parquet(f"{path}/chains/version={number}")
    _changed_loci(loci, batch).write.mode("overwrite").parquet(f"{path}/loci/version={number}")


def redundancy_state(transcripts: DataFrame, path: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Keep under ``path`` the winners of a stream of transcripts that ``redundancy`` would keep as the longest of equal chains and of overlapping mono-exons.

    A batch reads what it touches and writes what changes, so a long history costs a batch nothing but
    the look-up. It writes its own version and reads those before, so one that is run again changes nothing,
    and files may come in any order.
    """
    writer = transcripts.writeStream.foreachBatch(lambda batch, number: merge_batch(batch, path, number)).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()
