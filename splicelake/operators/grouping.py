"""Overlap, refined, consensus and cross-strand groups of transcripts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import bins
from ..functions.intervals import overlap_ratio, overlaps
from ..functions.lineage import cut

STRAND_KEY = ("seqname", "strand")
#: Positions of a bin in which starts are scanned, and of one in which exons meet.
BIN = 1 << 16
EXON_BIN = 1 << 12


def overlap_groups(t: DataFrame, keys: tuple[str, ...] = STRAND_KEY, bin_size: int = BIN) -> DataFrame:
    """``t`` with ``locus``: where the chain of overlapping transcripts begins that it belongs to.

    Transcripts that begin together are of one island, so each start counts once, with the
    farthest end from it (a partial maximum, however many begin there). Gaps and islands of starts
    take two levels: they are scanned within bins of coordinates, of at most ``bin_size`` rows
    each by that, and what earlier bins reach is carried over from one row per bin. An island
    that opens in a bin when seen alone opens there unless earlier bins reach it, so the last one of a bin
    follows from its row alone too.
    """
    here = Window.partitionBy(*keys, "_bin").orderBy("s")
    before = Window.partitionBy(*keys).orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
    starts = t.groupBy(*keys, "s").agg(F.max("e").alias("_e")).withColumn("_bin", F.floor(F.col("s") / bin_size))
    starts = starts.withColumn("_in", F.max("_e").over(here.rowsBetween(Window.unboundedPreceding, -1)))
    beyond = lambda at, reach: F.coalesce(F.col(at) > F.col(reach), F.col(at).isNotNull())
    bins = starts.groupBy(*keys, "_bin").agg(F.max("_e").alias("_top"), F.max(F.when(beyond("s", "_in"), F.col("s"))).alias("_lone"))
    bins = bins.withColumn("_reach", F.max("_top").over(before)).withColumn("_last", F.when(beyond("_lone", "_reach"), F.col("_lone")))
    bins = bins.select(*keys, "_bin", "_reach", F.max("_last").over(before).alias("_carried"))
    opened = F.when(beyond("s", "_in") & beyond("s", "_reach"), F.col("s"))
    locus = F.coalesce(F.max(opened).over(here.rowsBetween(Window.unboundedPreceding, 0)), F.col("_carried"))
    loci = starts.join(bins, [*keys, "_bin"]).select(*keys, "s", locus.alias("locus"))
    return t.join(loci, [*keys, "s"]).select(*[F.col(f"`{c}`") for c in t.columns], "locus")


def refined_groups(t: DataFrame, keys: tuple[str, ...] = STRAND_KEY, threshold: float = 0.25) -> DataFrame:
    """Overlap groups split between neighbours that only touch: ``locus`` and ``part`` in it.

    A split stands where the last exon of one and the first exon of the next overlap in part, by less than ``threshold``.
    """
    g = overlap_groups(t, keys)
    order = Window.partitionBy(*keys, "locus").orderBy("s", "e", "transcript_id")
    last, first = F.lag(F.element_at("exons", -1)).over(order), F.col("exons")[0]
    ratio = overlap_ratio(F.col("_p.s"), F.col("_p.e"), first["s"], first["e"])
    g = g.withColumn("_p", last)
    split = (first["s"] <= F.col("_p.e")) & (F.col("_p.e") <= first["e"]) & (F.col("_p.s") < first["s"]) & (ratio > 0) & (ratio < threshold)
    g = g.withColumn("_split", F.coalesce(split, F.lit(False)).cast("int"))
    return g.withColumn("part", F.sum("_split").over(order.rowsBetween(Window.unboundedPreceding, 0)).cast("long")).drop("_p", "_split")


def consensus_groups(g: DataFrame, keys: tuple[str, ...] = (*STRAND_KEY, "locus")) -> DataFrame:
    """``keys, transcript_id, consensus`` of grouped transcripts, by ``in_consensus``."""
    return in_consensus(g, keys).select(*keys, "transcript_id", "consensus")


def in_consensus(g: DataFrame, keys: tuple[str, ...] = (*STRAND_KEY, "locus")) -> DataFrame:
    """Grouped transcripts ``g`` with their ``consensus``.

    Neighbours overlap with their first and with their last exons. A transcript
    belongs to the largest set of a transcript and its neighbours that it is in
    (then to the one whose first id is larger, then to the smaller list);
    ``consensus`` is the smallest id of those that share the choice.

    Transcripts with equal first and equal last exons have the same neighbours, so the graph is
    one of such classes, with a weight each: thousands of alike transcripts are one row. A set is known by
    its weight, its first id and a hash of its classes; lists of classes are made only
    where weight and first id leave a choice open. They are in the order of the lists of ids: of equal
    weight, the smaller list has the smallest id that isn't in both, which is the first of its class.

    Pairs are met once and keep the ends of their class: sets are rated where their pairs are, and the
    rows of ``g`` find their class by its ends.
    """
    keys, place = tuple(keys), ("_fs", "_fe", "_ls", "_le", "_lone")
    f, l = F.col("exons")[0], F.element_at("exons", -1)  # noqa: E741
    ends = g.withColumns({"_fs": f["s"], "_fe": f["e"], "_ls": l["s"], "_le": l["e"]})
    # a single position doesn't overlap an equal one: such a transcript is a class by itself
    ends = ends.withColumn("_lone", F.when((F.col("_fs") == F.col("_fe")) | (F.col("_ls") == F.col("_le")), F.col("transcript_id")).otherwise(F.lit("")))
    classes = ends.groupBy(*keys, *place).agg(F.min("transcript_id").alias("c"), F.count("*").alias("n"))
    pairs = _class_pairs(classes, classes, keys, place)
    of_hub, of_class = Window.partitionBy(*keys, "b"), Window.partitionBy(*keys, "c")
    xor = lambda seed: F.bit_xor(F.xxhash64("c", F.lit(seed))).over(of_hub)
    rated = pairs.select("*", F.sum("n").over(of_hub).alias("size"), F.min("c").over(of_hub).alias("first"), xor(1).alias("h1"), xor(2).alias("h2"))
    most = F.max(F.struct("size", "first")).over(of_class)
    best = rated.withColumn("_most", most).where("size = _most.size and first = _most.first")
    best = best.groupBy(*keys, "c", *place, "h1", "h2").agg(F.min("b").alias("b")).withColumn("open", F.count("*").over(of_class) > 1)
    best = cut(best)
    chosen = best.where("not open").drop("open", "b")
    if not (among := best.where("open").drop("open")).isEmpty():
        hubs = classes.join(among.select(*keys, F.col("b").alias("c")).distinct(), [*keys, "c"], "left_semi")
        lists = _class_pairs(classes, hubs, keys, place).groupBy(*keys, "b").agg(F.sort_array(F.collect_list("c")).alias("m"))
        picked = among.join(lists, [*keys, "b"]).groupBy(*keys, "c", *place).agg(F.min_by(F.struct("h1", "h2"), "m").alias("x"))
        chosen = chosen.union(picked.select(*keys, "c", *place, "x.*"))
    named = chosen.select(*keys, *place, F.min("c").over(Window.partitionBy(*keys, "h1", "h2")).alias("consensus"))
    return ends.join(named, [*keys, *place]).select(*[F.col(f"`{c}`") for c in g.columns], "consensus")


def _class_pairs(classes: DataFrame, hubs: DataFrame, keys: tuple[str, ...], place: tuple[str, ...]) -> DataFrame:
    """``c, n, b`` of classes (with the weight and the ends of the first) that are neighbours, each of itself too.

    First exons that overlap share a bin, the first one of their overlap counts: no pair twice, and a deep locus is dealt out.
    """
    binned = lambda x: x.withColumn("_bin", F.explode(F.sequence(F.floor(F.col("_fs") / EXON_BIN), F.floor(F.col("_fe") / EXON_BIN))))
    a, b = binned(classes).alias("a"), binned(hubs).alias("b")
    same = F.expr(" and ".join(f"a.{k} = b.{k}" for k in (*keys, "_bin")))
    first = F.col("a._bin") == F.floor(F.greatest("a._fs", "b._fs") / EXON_BIN)
    meet = lambda s, e: overlaps(F.col(f"a.{s}"), F.col(f"a.{e}"), F.col(f"b.{s}"), F.col(f"b.{e}"))
    pairs = a.join(b, same & first & ((F.col("a.c") == F.col("b.c")) | meet("_fs", "_fe") & meet("_ls", "_le")))
    return pairs.select(*[F.col(f"a.{k}").alias(k) for k in (*keys, *place)], F.col("a.c").alias("c"), F.col("a.n").alias("n"), F.col("b.c").alias("b"))


def boundaries(g: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Per group its size and the spans of its longest transcript (of equal ones the smallest id): exons ``xs, xe``, introns (exons if it has none) ``is, ie``."""
    f, l, several = F.col("exons")[0], F.element_at("exons", -1), F.size("exons") > 1  # noqa: E741
    left, right = F.when(several, f["e"] + 1).otherwise(f["s"]), F.when(several, l["s"] - 1).otherwise(l["e"])
    rep = F.struct("n_exons", F.col("s").alias("xs"), F.col("e").alias("xe"), left.alias("is"), right.alias("ie"))
    rows = g.groupBy(*keys).agg(F.count("*").alias("n"), F.min_by(rep, F.struct(-F.col("len"), "transcript_id")).alias("x"))
    return rows.select(*keys, "n", "x.*")


def lone_monoexons(t: DataFrame) -> DataFrame:
    """Mono-exonic transcripts that overlap nothing on their strand."""
    n = F.count("*").over(Window.partitionBy(*STRAND_KEY, "locus"))
    return overlap_groups(t).withColumn("_n", n).where("_n = 1 and n_exons = 1").drop("_n")


def cross_strand_groups(t: DataFrame, wanted: DataFrame) -> DataFrame:
    """``seqname, left, right, transcript_id`` of refined groups over both strands that have a wanted transcript and at least two members.

    Groups with the same span are one.
    """
    key = ("seqname", "locus", "part")
    g = refined_groups(t, ("seqname",))
    hit = wanted.select("transcript_id").distinct().withColumn("_hit", F.lit(True))
    w = Window.partitionBy(*key)
    g = g.join(hit, "transcript_id", "left").withColumns({"left": F.min("s").over(w), "right": F.max("e").over(w), "_n": F.count("*").over(w), "_any": F.bool_or("_hit").over(w)})
    return g.where("_any and _n > 1").drop("_n", "_any", "_hit", "locus", "part")


def intronic(g: DataFrame, keys: tuple[str, ...], by: tuple[str, ...] = ()) -> DataFrame:
    """``by`` and ``transcript_id`` of mono-exons, in groups of two or more, that overlap no exon of a multi-exonic member.

    An exon has one bin as its home, and a mono-exon asks the bins that it reaches into: a deep group is dealt out, and long exons are no more rows than short ones.
    """
    ids = [*by, "transcript_id"]
    several = g.groupBy(*keys).agg(F.count("*").alias("_n")).where("_n > 1")
    mono = g.where("n_exons = 1").select(*keys, "transcript_id", F.col("exons")[0]["s"].alias("s"), F.col("exons")[0]["e"].alias("e"))
    exons = g.where("n_exons > 1").select(*keys, F.explode("exons").alias("x")).select(*keys, F.col("x.s").alias("xs"), F.col("x.e").alias("xe")).distinct()
    hits = mono.withColumn("_home", F.explode(bins.met(F.col("s"), F.col("e")))).join(exons.withColumn("_home", bins.home(F.col("xs"), F.col("xe"))), [*keys, "_home"])
    hits = hits.where(overlaps(F.col("s"), F.col("e"), F.col("xs"), F.col("xe")))
    return mono.join(several, list(keys), "left_semi").join(hits.select(*keys, "transcript_id").distinct(), [*keys, "transcript_id"], "left_anti").select(*ids).distinct()
