"""Chimeric transcripts, segments and fragments of a locus."""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.intervals import overlaps
from ..functions.lineage import cut
from .grouping import STRAND_KEY, boundaries, in_consensus, intronic, overlap_groups

LOCUS = (*STRAND_KEY, "locus")
FEW = 3
SPAN_BIN = 1 << 16


def _ids(df: DataFrame) -> DataFrame:
    return df.select("transcript_id").distinct()


def without(t: DataFrame, *ids: DataFrame) -> DataFrame:
    for x in ids:
        t = t.join(_ids(x), "transcript_id", "left_anti")
    return t


def with_consensus(t: DataFrame) -> DataFrame:
    """Transcripts with the overlap and consensus groups that they form among themselves."""
    return cut(in_consensus(cut(overlap_groups(t.select(*STRAND_KEY, "transcript_id", "s", "e", "len", "n_exons", "exons"))), LOCUS))


def locus_kinds(c: DataFrame) -> DataFrame:
    """Per locus of ``with_consensus``: whether it is ``uniform``, of one consensus group, and whether two of its groups are ``apart``.

    Two spans don't overlap if one begins after the other's end, which the largest start and
    the smallest end tell, or if both are the same single position.
    """
    rep = boundaries(c, (*LOCUS, "consensus"))
    apart = (F.max("xs") > F.min("xe")) | (F.count_if(F.col("xs") == F.col("xe")) > 1)
    return rep.groupBy(*LOCUS).agg((F.count("*") == 1).alias("uniform"), apart.alias("apart"))


def with_kinds(t: DataFrame) -> DataFrame:
    """``with_consensus`` with the kind of each transcript's locus. What is left out by kind are whole loci: the other groups stay as they are."""
    c = with_consensus(t)
    return c.join(locus_kinds(c), list(LOCUS))


def uniform_consensus(t: DataFrame) -> DataFrame:
    """``transcript_id`` in overlap groups of one consensus group only."""
    return with_kinds(t).where("uniform").select("transcript_id")


def segmented(t: DataFrame) -> DataFrame:
    """``transcript_id, segmented`` of loci that aren't uniform: whether two consensus groups of its locus have representatives that don't overlap."""
    return with_kinds(t).where("not uniform").select("transcript_id", F.col("apart").alias("segmented"))


def chimeric(t: DataFrame) -> DataFrame:
    """``transcript_id, label`` of transcripts in a decision about spanning groups: accepted_overlap, rejected_overlap or rejected_segment.

    A group that spans two others which don't overlap stands if it has at least as
    many transcripts as both, less one; they are its segments then. Pairs are taken
    in order of their ids. A spanner is rejected at its first pair that has more,
    and a spanner rejected before is forgiven if it is in such a pair of a later one.
    A transcript may have two labels, as a segment of one spanner and itself a spanner.
    """
    return spanning(with_consensus(t))


def _neighbours(b: DataFrame) -> DataFrame:
    """Pairs of groups ``c`` and ``a`` of a locus whose spans overlap, met in the bin where the overlap begins."""
    bins = F.explode(F.sequence(F.floor(F.col("xs") / SPAN_BIN), F.floor(F.col("xe") / SPAN_BIN))).alias("_bin")
    c = b.select(*LOCUS, F.col("consensus").alias("c"), F.col("n").alias("cn"), F.col("xs").alias("cxs"), F.col("xe").alias("cxe"), bins)
    a = b.select(*LOCUS, F.struct("consensus", "n", "xs", "xe", "is", "ie").alias("a"), bins)
    first = F.col("_bin") == F.floor(F.greatest("cxs", "a.xs") / SPAN_BIN)
    near = c.join(a, [*LOCUS, "_bin"]).where(first & (F.col("c") != F.col("a.consensus")) & overlaps(F.col("cxs"), F.col("cxe"), F.col("a.xs"), F.col("a.xe")))
    return near.select(*LOCUS, "c", "cn", "a")


def spanning(c: DataFrame) -> DataFrame:
    """``chimeric`` of transcripts whose consensus groups are known. Only neighbours of a group are paired: a deep locus costs what overlaps in it."""
    col, key = F.col, (*LOCUS, "consensus")
    near = cut(_neighbours(boundaries(c, key).where("not (n = 1 and n_exons = 1)")))
    pairs = near.join(near.select(*LOCUS, "c", col("a").alias("b")), [*LOCUS, "c"])
    higher = (col("a.n") > col("b.n")) | ((col("a.n") == col("b.n")) & (col("a.consensus") > col("b.consensus")))
    meet = lambda x, xs, xe, y, ys, ye: overlaps(col(f"{x}.{xs}"), col(f"{x}.{xe}"), col(f"{y}.{ys}"), col(f"{y}.{ye}"))
    spans = pairs.where(higher & ~meet("a", "xs", "xe", "b", "is", "ie") & ~meet("a", "is", "ie", "b", "xs", "xe"))
    spans = spans.select(*LOCUS, "c", F.struct(col("a.consensus").alias("a"), col("b.consensus").alias("b")).alias("pair"), (col("a.n") + col("b.n") > col("cn") + 1).alias("fails"))
    spans = cut(spans)
    first = spans.groupBy(*LOCUS, "c").agg(F.min(F.when(col("fails"), col("pair"))).alias("first"))
    spans = cut(spans.join(first, [*LOCUS, "c"]))
    segments = spans.where("first is null or pair < first").select(*LOCUS, F.explode(F.array("pair.a", "pair.b")).alias("consensus")).distinct().withColumn("label", F.lit("rejected_segment"))
    accepted = spans.where("first is null").select(*LOCUS, F.col("c").alias("consensus")).distinct().withColumn("label", F.lit("accepted_overlap"))
    failing = spans.where("first is not null").select(*LOCUS, "c", "first").distinct()
    forgiven = failing.select(*LOCUS, F.col("c").alias("later"), F.explode(F.array("first.a", "first.b")).alias("c"))
    rejected = failing.join(forgiven.where("c < later"), [*LOCUS, "c"], "left_anti").select(*LOCUS, F.col("c").alias("consensus"), F.lit("rejected_overlap").alias("label"))
    labels = segments.union(accepted).union(rejected)
    out = c.select(*key, "transcript_id").join(labels, list(key)).select("transcript_id", "label")
    kept = out.join(intronic(c, LOCUS).withColumn("_in", F.lit(True)), "transcript_id", "left").where("_in is null or label <> 'rejected_segment'")
    return kept.select("transcript_id", "label").distinct()


def fragments(t: DataFrame, ratio: float = 0.7, by: tuple[str, ...] = ()) -> DataFrame:
    """``transcript_id, label`` of each transcript: fragment, overextended, uniform, or accepted.

    Short ones are those under ``ratio`` of the longest of their overlap group. Numerous
    short ones that agree on their ends are uniform; few long ones beside them are
    overextended. Where a locus falls apart without its overextended transcripts, the part
    with the longest transcript (of equal ones the last) keeps its short ones.

    Columns ``by`` tell sets of transcripts apart that are decided each on its own, in one pass.
    """
    strand, ids = (*STRAND_KEY, *by), [*by, "transcript_id"]
    locus = (*strand, "locus")
    w = Window.partitionBy(*locus)
    g = overlap_groups(t.select(*strand, "transcript_id", "s", "e", "len", "n_exons", "exons"), strand)
    g = cut(g.withColumn("long", F.col("len") / F.max("len").over(w) >= ratio))
    side = (*locus, "long")
    c = in_consensus(g, side)
    # by locus first: the finer windows find their rows where they are
    c = c.withColumn("_accepted", F.count_if("long").over(w)).withColumn("_c", F.count("*").over(Window.partitionBy(*side, "consensus")))
    c = c.withColumn("uniform", ~F.col("long") & (F.col("_c") > FEW) & (F.col("_c") > F.col("_accepted")))
    c = c.withColumn("_u", F.count_if("uniform").over(w))
    c = c.withColumn("over", F.col("long") & (F.col("_u") > FEW) & (F.col("_c") < FEW) & (F.col("_c") < F.col("_u")))
    c = cut(c.withColumn("_any", F.bool_or("over").over(w)).select(*locus, "transcript_id", "s", "e", "len", "n_exons", "exons", "long", "uniform", "over", "_any"))
    whole = (*strand, "whole")
    rest = overlap_groups(c.where("_any and not over").withColumnRenamed("locus", "whole"), whole)
    parts = rest.groupBy(*whole, "locus").agg(F.max("len").alias("m"))
    best = parts.groupBy(*whole).agg(F.max(F.struct("m", "locus")).alias("x"), F.count("*").alias("_n")).where("_n > 1").select(*whole, F.col("x.locus").alias("locus"))
    spared = rest.join(best, [*whole, "locus"], "left_semi").select(*ids).withColumn("_spared", F.lit(True))
    inside = intronic(c, locus, by).withColumn("_in", F.lit(True))
    out = c.join(inside, ids, "left").join(spared, ids, "left")
    fragment = ~F.col("long") & F.col("_in").isNull() & ~F.col("uniform") & F.col("_spared").isNull()
    return out.select(*ids, F.when(F.col("over"), "overextended").when(F.col("uniform"), "uniform").when(fragment, "fragment").otherwise("accepted").alias("label"))


class Decision(NamedTuple):
    """What the structural stage decided: a label of every transcript, and sets of ids (``transcript_id, set``) that help to look into it."""

    labels: DataFrame
    sets: DataFrame


def structural(t: DataFrame, ratio: float = 0.7, add: frozenset[str] = frozenset(("overextended",)), disable_chimeric: bool = False, semantics: str = "reference") -> DataFrame:
    """``transcript_id, label``: accepted, fragment, rejected_overlap, rejected_segment or overextended.

    With ``reference`` semantics the chimeric decision over an empty subset is taken over all transcripts.
    """
    return decide(t, ratio, add, disable_chimeric, semantics).labels


def decide(t: DataFrame, ratio: float = 0.7, add: frozenset[str] = frozenset(("overextended",)), disable_chimeric: bool = False, semantics: str = "reference") -> Decision:
    """The labels of ``structural``, and the sets overextended, uniform_fragments, overlap_accepted, overlap_rejected and overlap_refined.

    Uniform, segmented and other loci are whole loci, so their consensus groups are formed once, over
    all transcripts; the decisions about fragments of several sets are taken in one pass.
    """
    t = cut(t.select(*STRAND_KEY, "transcript_id", "s", "e", "len", "n_exons", "exons"))
    kinds = ("accepted_overlap", "rejected_overlap", "rejected_segment")
    split = lambda found: [_ids(found.where(F.col("label") == x)) for x in kinds]
    everything = semantics == "reference"

    grouped = cut(with_kinds(t))
    apart = grouped.where("apart and not uniform")
    none = apart.isEmpty()
    spans = cut(spanning(grouped if everything and none else apart))
    pa, po, ps = split(spans)

    # a locus that isn't segmented stays whole beside the rejected ones, so the first set decides it too,
    # unless spanners were looked for everywhere
    said = spans.groupBy("transcript_id").agg(*[F.bool_or(F.col("label") == x).alias(x) for x in kinds])
    sets = ["rejected_overlap is null or not rejected_overlap", *kinds, *(["not apart and not uniform"] if none else [])]
    at = F.explode(F.array_compact(F.array(*[F.when(F.expr(x), F.lit(k)) for k, x in enumerate(sets)])))
    tagged = grouped.join(said, "transcript_id", "left").select(*t.columns, at.alias("_set"))
    first = cut(fragments(tagged, ratio, ("_set",)))
    over, even = (_ids(first.where((F.col("_set") == 0) & (F.col("label") == x))) for x in ("overextended", "uniform"))
    early = cut(_ids(first.where("label = 'fragment'")))

    left = cut(without(apart.select(*t.columns), early))
    selected, ro, rs = split(cut(chimeric(t if everything and left.isEmpty() else left)))
    more = fragments(without(grouped.where("not uniform").select(*t.columns), ro, rs, early), ratio).where("label = 'fragment'")
    bad = cut(early.union(_ids(more)).distinct())
    # of those in two sets neither a rejected segment nor a fragment counts as a rejected overlap, and no fragment as a segment
    spanner = without(ro, rs, bad)
    segment = without(rs, spanner, bad)
    accepted = selected.union(without(pa, ro, rs, bad)).distinct()
    named = {"overextended": over, "uniform_fragments": even, "overlap_accepted": accepted, "overlap_rejected": spanner, "overlap_refined": without(selected, po, bad)}
    sets = reduce(DataFrame.union, [_ids(ids).select("transcript_id", F.lit(name).alias("set")) for name, ids in named.items()])

    gone = bad if "intronic" in add else bad.union(intronic(grouped, LOCUS))
    if "uniform" not in add:
        gone = gone.union(even)
    label = [(gone, "fragment"), (over, "overextended")] if "overextended" not in add else [(gone, "fragment")]
    if not disable_chimeric:
        label += [(spanner, "rejected_overlap"), (segment, "rejected_segment")]
    order = {"rejected_segment": 0, "rejected_overlap": 1, "fragment": 2, "overextended": 3}
    marks = reduce(DataFrame.union, [_ids(ids).select("transcript_id", F.struct(F.lit(order[name]).alias("o"), F.lit(name).alias("l")).alias("m")) for ids, name in label])
    marks = marks.groupBy("transcript_id").agg(F.min("m").alias("m"))
    labels = t.select("transcript_id").join(marks, "transcript_id", "left").select("transcript_id", F.coalesce("m.l", F.lit("accepted")).alias("label"))
    return Decision(labels, sets)
