"""Column expressions over intervals and exon models. Coordinates are 1-based and inclusive."""

from __future__ import annotations

from pyspark.sql import Column, Window
from pyspark.sql import functions as F


def span_length(s: Column, e: Column) -> Column:
    """Genomic length, introns included."""
    return e - s + 1


def overlap_ratio(s1: Column, e1: Column, s2: Column, e2: Column) -> Column:
    """Shared positions over the larger ``end - start``; 0 where both are single positions."""
    shared = F.greatest(F.least(e1, e2) - F.greatest(s1, s2) + 1, F.lit(0))
    return F.coalesce(F.try_divide(shared.cast("double"), F.greatest(e1 - s1, e2 - s2)), F.lit(0.0))


def overlaps(s1: Column, e1: Column, s2: Column, e2: Column) -> Column:
    """Whether the ratio is above 0: they share a position and one of them is longer than a single position."""
    return (s1 <= e2) & (s2 <= e1) & (F.greatest(e1 - s1, e2 - s2) > 0)


def exon_array(s: Column, e: Column) -> Column:
    """Aggregate: the sorted distinct intervals."""
    return F.sort_array(F.collect_set(F.struct(s.alias("s"), e.alias("e"))))


def introns_of(exons: Column) -> Column:
    """Gaps between neighbouring exons, without merging exons first."""
    pairs = F.zip_with(F.slice(exons, 1, F.size(exons) - 1), F.slice(exons, 2, F.size(exons)), lambda a, b: F.struct((a["e"] + 1).alias("s"), (b["s"] - 1).alias("e")))
    return F.when(F.size(exons) > 1, pairs).otherwise(F.filter(exons, lambda x: F.lit(False)))


def or_exons(model: Column, exons: Column) -> Column:
    """An intron or CDS model, or the exons where it is empty."""
    return F.when(F.size(model) > 0, model).otherwise(exons)


def chain(model: Column) -> Column:
    """A model as text: ``s-e,s-e``."""
    return F.array_join(F.transform(model, lambda x: F.concat_ws("-", x["s"], x["e"])), ",")


def location(seqname: Column, s: Column, e: Column) -> Column:
    return F.format_string("%s:%d-%d", seqname, s, e)


def longest_smallest_id(*keys) -> Window:
    """Order by length, the longest first; of equal ones the smallest id."""
    return Window.partitionBy(*keys).orderBy(F.col("len").desc(), F.col("transcript_id").asc())


def utr_regions(exons: Column, cds: Column, strand: Column) -> dict[str, Column]:
    """Five- and three-prime regions and codons that follow from a CDS; null without one or a strand.

    The exon positions left of the CDS form the left region, closed by the position
    before the CDS where that falls into an exon; the right one likewise.
    """
    start, stop = F.element_at(cds, 1)["s"], F.element_at(cds, -1)["e"]
    left = F.transform(F.filter(exons, lambda x: x["s"] < start), lambda x: F.struct(x["s"].alias("s"), F.least(x["e"], start - 1).alias("e")))
    right = F.transform(F.filter(exons, lambda x: x["e"] > stop), lambda x: F.struct(F.greatest(x["s"], stop + 1).alias("s"), x["e"].alias("e")))
    first, last = F.struct(start.alias("s"), (start + 2).alias("e")), F.struct((stop - 2).alias("s"), stop.alias("e"))
    known = (F.size(cds) > 0) & strand.isin("+", "-")
    plus = strand == "+"
    pick = lambda a, b: F.when(known & plus, a).when(known, b)
    return {"five_prime": pick(left, right), "three_prime": pick(right, left), "start_codon": pick(first, last), "stop_codon": pick(last, first)}


def percent(n: Column, total: Column) -> Column:
    """Share in percent to one decimal, 0 of nothing. The exact binary value decides on halves, as Python's ``round`` has it.

    The half above ``j`` tenths is ``c / 20``: scaling by powers of two and a difference of
    two numbers within a factor of two are exact, so the comparison is.
    """
    x = F.coalesce(F.try_divide(n.cast("double"), total.cast("double")) * 100, F.lit(0.0))
    j = F.floor(x * 10)
    c = (j * 2 + 1).cast("double")
    rest = c - x * 16
    up = (x * 4 > rest) | ((x * 4 == rest) & (j % 2 == 1))
    return (j + up.cast("int")) / 10
