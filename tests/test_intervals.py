"""Interval operators against plain Python, on random loci with ties and single positions."""

import random

import plain
import pytest
from pyspark.sql import functions as F

from splicelake.operators import finish, grouping, location, redundancy, structure
from splicelake.sources import model

SCHEMA = "seqname string, strand string, gene_id string, transcript_id string, s long, e long"


def random_loci(seed, n=120, width=1500):
    """ids to (seqname, strand, exons)."""
    rng, out = random.Random(seed), {}
    for k in range(n):
        at, exons = rng.randrange(1, width * 20, rng.choice([1, 50])), []
        for _ in range(rng.choice([1, 1, 2, 3, 4])):
            size = rng.choice([0, 0, 9, 40, 200, 400])
            exons.append((at, at + size))
            at += size + rng.choice([2, 50, 300])
        out[f"t{k:03d}"] = (rng.choice(["c1", "c2"]), rng.choice("+-"), exons)
    return out


def frame(spark, loci):
    rows = [(c, st, f"g{i}", i, s, e) for i, (c, st, x) in loci.items() for s, e in x]
    random.Random(1).shuffle(rows)
    return model.transcripts(spark.createDataFrame(rows, SCHEMA)).repartition(5)


def strands(loci):
    out = {}
    for i, (c, st, x) in loci.items():
        out.setdefault((c, st), {})[i] = x
    return out


@pytest.fixture(scope="module", params=[1, 2])
def case(spark, request):
    loci = random_loci(request.param)
    return loci, frame(spark, loci).cache()


def groups(rows, *keys):
    out = {}
    for r in rows:
        out.setdefault(tuple(r[k] for k in keys), []).append(r["transcript_id"])
    return sorted(sorted(x) for x in out.values())


def test_overlap_groups_do_not_depend_on_bins(case):
    loci, t = case
    want = sorted(sorted(g) for x in strands(loci).values() for g in plain.islands(x))
    for size in (1, 7, 1000, 1 << 20):
        assert groups(grouping.overlap_groups(t, bin_size=size).collect(), *structure.LOCUS) == want


def test_refined_groups(case):
    loci, t = case
    want = sorted(sorted(p) for x in strands(loci).values() for g in plain.islands(x) for p in plain.split(x, g))
    assert groups(grouping.refined_groups(t).collect(), *structure.LOCUS, "part") == want


def test_consensus_groups(case):
    loci, t = case
    want = sorted(sorted(p) for x in strands(loci).values() for g in plain.islands(x) for p in plain.consensus(x, g))
    assert groups(structure.with_consensus(t).collect(), *structure.LOCUS, "consensus") == want


def test_intronic(case):
    loci, t = case
    want = {i for x in strands(loci).values() for g in plain.islands(x) for i in plain.inside(x, g)}
    assert {r[0] for r in grouping.intronic(grouping.overlap_groups(t), structure.LOCUS).collect()} == want


def test_chimeric(case):
    loci, t = case
    want = set()
    for x in strands(loci).values():
        for g in plain.islands(x):
            for name, ids in zip(("accepted_overlap", "rejected_overlap", "rejected_segment"), plain.spanning(x, g)):
                want |= {(i, name) for i in ids}
    assert {tuple(r) for r in structure.chimeric(t).collect()} == want and want


def test_fragments(case):
    loci, t = case
    want = {}
    for x in strands(loci).values():
        for g in plain.islands(x):
            want |= plain.fragments(x, g)
    assert dict(map(tuple, structure.fragments(t).collect())) == want


def test_contained_chains(case):
    loci, t = case
    want = set()
    for x in strands(loci).values():
        for g in plain.islands(x):
            for a in g:
                for b in g:
                    ia, ib = plain.introns(x[a]), plain.introns(x[b])
                    if not ia or ia == ib or not any(ib[k : k + len(ia)] == ia for k in range(len(ib))):
                        continue
                    left = [e for e in x[b] if ia[0][0] - 1 in e]
                    right = [e for e in x[b] if ia[-1][1] + 1 in e]
                    s, e = plain.span(x[a])
                    if left and right and left[-1][0] <= s <= left[-1][1] and right[-1][0] <= e <= right[-1][1]:
                        want.add(a)
    assert {r[0] for r in redundancy.contained_chains(t).collect()} == want


def uniform_case():
    short = [(100, 150), (200, 250)]
    return {f"s{k}": ("c1", "+", short) for k in range(5)} | {"long": ("c1", "+", [(100, 150), (200, 250), (900, 950)])}


def test_uniform_and_overextended(spark):
    t = frame(spark, uniform_case())
    got = dict(map(tuple, structure.fragments(t).collect()))
    assert got == {f"s{k}": "uniform" for k in range(5)} | {"long": "overextended"}
    more = uniform_case() | {f"l{k}": ("c1", "+", [(100, 150), (200, 250), (900, 950 + k)]) for k in range(3)}
    got = dict(map(tuple, structure.fragments(frame(spark, more)).collect()))
    assert got["long"] == "accepted" and got["s0"] == "uniform"


def test_redundancy_rules(spark):
    a = [(100, 200), (300, 400), (500, 600)]
    loci = {
        "a1": ("c1", "+", a),
        "a2": ("c1", "+", [(100, 200), (300, 400), (500, 600)]),  # a tie: the larger id stays
        "b": ("c1", "+", [(150, 200), (300, 350)]),  # inside a2
        "c": ("c1", "+", [(90, 200), (300, 350)]),  # same introns as b and longer
        "m1": ("c1", "-", [(10, 50)]),
        "m2": ("c1", "-", [(40, 90)]),
        "m3": ("c1", "-", [(80, 130)]),  # bridged to m1 by m2
    }
    got = dict(map(tuple, redundancy.redundancy(frame(spark, loci)).collect()))
    assert got == {"a1": "identical", "a2": "accepted", "b": "identical", "c": "accepted", "m1": "monoexon", "m2": "monoexon", "m3": "accepted"}
    twice = {"x": ("c1", "+", a), "y": ("c2", "-", a)}
    t = frame(spark, twice)
    assert dict(map(tuple, redundancy.redundancy(t).collect())) == {"x": "identical", "y": "accepted"}
    assert set(dict(map(tuple, redundancy.redundancy(t, "corrected").collect())).values()) == {"accepted"}
    assert redundancy.redundancy(t, disable=True).where("label = 'accepted'").count() == 2


def test_antisense(spark):
    loci = {
        "gene": ("c1", "+", [(100, 200), (300, 400)]),
        "within": ("c1", "-", [(150, 180)]),
        "across": ("c1", "-", [(390, 450)]),
        "around": ("c1", "-", [(1000, 2000)]),  # contains the next: no end lies in it
        "small": ("c1", "+", [(1200, 1300)]),
    }
    t = frame(spark, loci)
    for size in (1, 64, 1 << 16):
        got = {r[0] for r in location.monoexonic_antisense(t, bin_size=size).collect()}
        assert got == {"within", "across", "small", "around"}  # small is flagged, and the lone gene it lies in
    labels = dict((r["transcript_id"], r["label"]) for r in location.antisense_fragments(t, t).collect())
    assert labels["within"] == "antisense_fragment" and labels["small"] == "antisense_fragment" and labels["around"] is None


def test_location_labels(spark):
    loci = {"u": ("c1", ".", [(1, 10)]), "k": ("c1", "+", [(100, 200), (300, 400)]), "x": ("c9", "+", [(100, 200), (300, 400)])}
    genome = spark.createDataFrame([("c1",)], "seqname string")
    got = dict(map(tuple, location.location(frame(spark, loci), genome).collect()))
    assert got == {"u": "unstranded", "k": "accepted", "x": "unknown_seqname"}


def test_new_ids_and_padding(spark):
    rows = [("c1", "+", "old", "a", 100, 200), ("c1", "+", "old", "b", 5000, 5100), ("c1", "+", "other", "b2", 5010, 5300), ("c1", "-", "anti", "c", 100, 300)]
    t = model.transcripts(spark.createDataFrame(rows, SCHEMA))
    got = {r["transcript_id"]: (r["new_transcript_id"], r["new_gene_id"]) for r in finish.reannotate(t, "P").collect()}
    assert got == {
        "a": ("P_c1G000010.RTD.1", "P_c1G000010"),
        "c": ("P_c1G000020.RTD.1", "P_c1G000020"),
        "b": ("P_c1G000030.RTD.1", "P_c1G000010"),  # its old gene was met before
        "b2": ("P_c1G000030.RTD.2", "P_c1G000030"),
    }
    pad = {r["transcript_id"]: [tuple(x) for x in r["padded"]] for r in finish.padded(t).collect()}
    assert pad["b"] == pad["b2"] == [(5000, 5300)]


def test_structural_without_any_segmented_group(spark):
    t = frame(spark, {"a": ("c1", "+", [(1, 100), (200, 300)]), "b": ("c1", "+", [(150, 180)])})
    got = dict(map(tuple, structure.structural(t).collect()))
    assert got == {"a": "accepted", "b": "fragment"}
    assert structure.structural(t, add=frozenset(("intronic", "overextended"))).where("label = 'accepted'").count() == 2


def test_labels_of_no_transcripts(spark):
    t = frame(spark, {"a": ("c1", "+", [(1, 2)])}).where("false")
    assert redundancy.redundancy(t).count() == structure.fragments(t).count() == structure.chimeric(t).count() == 0
    assert finish.reannotate(t, "P").count() == 0 and structure.structural(t).count() == 0
    assert t.select(F.size("introns")).count() == 0


def test_consensus_where_weights_and_first_ids_tie(spark):
    """Sets of equal size and equal first id are told apart by their lists of ids, whose classes are made of several transcripts."""
    loci = {}
    for k, i in enumerate(["a", "q", "b", "r", "c", "s", "d", "t", "e", "u"]):
        first = [(100, 200), (100, 200), (150, 300), (150, 300), (290, 400), (290, 400), (190, 295), (190, 295), (100, 400), (250, 251)][k]
        loci[i] = ("c1", "+", [first, (1000, 1100)])
    for k in range(12):  # single positions, alike: neighbours of what covers them, not of each other
        loci[f"z{k}"] = ("c1", "+", [(200, 200), (1000 + k % 2, 1000 + k % 2)])
    t = frame(spark, loci)
    want = sorted(sorted(p) for x in strands(loci).values() for g in plain.islands(x) for p in plain.consensus(x, g))
    assert groups(structure.with_consensus(t).collect(), *structure.LOCUS, "consensus") == want


def test_alike_transcripts_are_one_class(spark):
    """Forty thousand transcripts of one locus, in classes of equal ends: rows in proportion, no pairs of transcripts."""
    ids = spark.range(40_000).select(F.lit("c").alias("seqname"), F.lit("+").alias("strand"), F.lit(1).cast("long").alias("locus"), F.format_string("t%05d", "id").alias("transcript_id"), (F.col("id") % 5 * 10).alias("o"))
    exon = lambda s, e: F.struct((F.lit(s) + F.col("o")).alias("s"), (F.lit(e) + F.col("o")).alias("e"))
    g = ids.withColumn("exons", F.array(exon(100, 125), exon(900, 1000)))
    got = {r["o"]: (r["n"], r["c"]) for r in grouping.consensus_groups(g).join(ids, ["seqname", "strand", "locus", "transcript_id"]).groupBy("o").agg(F.count("*").alias("n"), F.collect_set("consensus").alias("c")).collect()}
    # first exons of offsets up to two steps apart overlap: the middle one's set has all
    assert got == {o: (8000, ["t00000"]) for o in (0, 10, 20, 30, 40)}


def test_nested_bins(spark):
    from splicelake.functions import bins

    rng = random.Random(3)
    spans = []
    for k in range(150):
        s = rng.randrange(1, 1 << rng.choice([8, 16, 40]))
        spans.append((k, s, s + rng.choice([0, 3, 500, 1 << 15, 1 << 22])))
    df = spark.createDataFrame(spans, "k long, s long, e long")
    small = df.where("e - s < 1000")
    for width in (1, 7, bins.WIDTH):
        homes = df.select(F.col("k").alias("o"), "s", "e", bins.home(F.col("s"), F.col("e"), width).alias("home"))
        asked = small.select("k", F.col("s").alias("a"), F.col("e").alias("b"), F.explode(bins.met(F.col("s"), F.col("e"), width)).alias("home"))
        got = [(r["k"], r["o"]) for r in asked.join(homes, "home").where("a <= e and s <= b").collect()]
        want = {(k, o) for k, a, b in spans if b - a < 1000 for o, s, e in spans if a <= e and s <= b}
        assert len(got) == len(want) and set(got) == want
