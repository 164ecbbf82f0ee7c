"""What steps write and move has to stay small: rounds, k-mers and lines that stay where they are."""

import random

import pytest
from pyspark.sql import functions as F

from splicelake.functions.lineage import cut
from splicelake.operators import quantify, structure
from splicelake.plans import filequeries
from splicelake.sources import model, reads, sinks


@pytest.fixture(scope="module")
def isoforms(spark):
    rng = random.Random(7)
    bases = lambda n: "".join(rng.choice("ACGT") for _ in range(n))
    exons, repeat = [bases(50) for _ in range(8)], bases(40)
    texts = {f"t{i:02d}": "".join(rng.sample(exons[i % 4 * 2 : i % 4 * 2 + 2], 2)) + bases(30) + repeat * (i in (0, 5)) for i in range(24)}
    rows = [(f"s{k % 2}", f"p{k % 2}", k, x[p : p + 45], x[p + 40 : p + 85]) for k, x in enumerate(rng.choice(list(texts.values())) for _ in range(120)) for p in [rng.randrange(len(x) - 85)]]
    return spark.createDataFrame(list(texts.items()), "transcript_id string, sequence string"), spark.createDataFrame(rows, "sample string, pair string, record long, first string, second string")


def test_rounds_of_small_components_write_nothing(isoforms, monkeypatch):
    kept, n = quantify.cut, []
    monkeypatch.setattr(quantify, "cut", lambda df: (n.append(1), kept(df))[1])
    quantify.quantify(*isoforms, 21, 10, 80, 1, 0.0)
    one = len(n)
    quantify.quantify(*isoforms, 21, 10, 80, 9, 0.0)
    assert len(n) == 2 * one


@pytest.mark.parametrize("change", [0.0, 0.1])
def test_large_components_by_joins_are_as_small_ones(isoforms, change, monkeypatch):
    found = quantify.index(isoforms[0], 21)
    lengths = found.lengths.withColumn("effective_length", F.greatest(F.col("length") - 79, F.lit(1)).cast("double"))
    counts, members = quantify.classes(isoforms[1], found, 21, 10)
    sizes = [r["count"] for r in members.groupBy("component").count().collect()]
    got = []
    for large in (0, min(sizes), 10**6):
        rows = quantify.maximise(counts, members, lengths, 15, change, large).collect()
        got.append({(r["sample"], r["t"]): r["num_reads"] for r in rows})
    assert len(sizes) > 1 and got[0] and got[0] == pytest.approx(got[2], rel=1e-9) and got[1] == pytest.approx(got[2], rel=1e-9)


def test_kmers_of_a_batch_are_those_of_text(spark):
    texts = ["acgnACGTAGGTCA" * 4, "ACGé" * 20, "AC", None]
    for k in (3, 31, 33):
        rows = spark.createDataFrame([(i, x, i + 1, -i) for i, x in enumerate(texts)], "t long, sequence string, h1 long, h2 long")
        got = rows.coalesce(1).mapInArrow(quantify._colours(k), f"h1 long, h2 long, batch long, component long, holders array<long>, kmers array<{quantify._type(k)}>")
        got = {(r["kmer"], t) for r in got.select("holders", F.explode("kmers").alias("kmer")).collect() for t in r["holders"]}
        want = {(r["kmer"], r["t"]) for r in rows.where("sequence is not null").select("t", F.explode(F.array_distinct(quantify.kmers(F.col("sequence"), k))).alias("kmer")).collect()}
        text = lambda x: bytes(x).decode() if k > 31 else "".join("ACGT"[x >> 2 * (k - 1 - i) & 3] for i in range(k))
        assert {(text(x), t) for x, t in got} == want and len(got) == len(want)


def test_kmers_that_transcripts_share_are_one_row_of_a_batch(isoforms):
    found = quantify.index(isoforms[0].coalesce(1), 21)
    each = isoforms[0].select(F.explode(F.array_distinct(quantify.kmers(F.col("sequence"), 21)))).count()
    assert found.local.select(F.sum(F.size("kmers"))).first()[0] < each and found.of.count() <= each


def test_lines_of_a_record_stay_where_they_are(spark, tmp_path):
    (tmp_path / "a.fastq").write_text("".join(f"@r{k}\nACGT\n+\nIIII\n" for k in range(2000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "9000")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        rows = reads.records(spark, str(tmp_path))
        assert rows.where("intact").count() == 2000
        held = moved(spark, lambda: rows.write.format("noop").mode("overwrite").save())
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert sum(held) < 300  # rows: counts of splits, and lines of records at their ends


def moved(spark, run):
    """Rows that each stage of a run wrote for others."""
    jvm, sc = spark.sparkContext._jvm, spark.sparkContext
    stages = lambda: {x.stageId(): x.shuffleWriteRecords() for s in [sc._jsc.sc().statusStore().stageList(None, False, False, sc._gateway.new_array(jvm.double, 0), jvm.java.util.ArrayList())] for x in (s.apply(i) for i in range(s.size()))}
    before = set(stages())
    run()
    return [n for i, n in stages().items() if i not in before]


def test_lines_are_made_where_they_are_written(spark, tmp_path):
    rows = spark.createDataFrame([(f"{k % 2}.txt", k) for k in range(20)], "file string, k long")
    filequeries.put(spark, rows, f"file://{tmp_path}/in", "k", value=F.concat(F.lit("line "), "k").alias("value"))
    for r in (0, 1):
        assert (tmp_path / "in" / f"{r}.txt").read_text().split("\n")[:-1] == [f"line {k}" for k in range(r, 20, 2)]


def test_transcripts_of_one_piece_move_whole(spark):
    rng = random.Random(3)
    text = "".join(rng.choice("ACGT") for _ in range(3 * sinks.PIECE))
    rows = [(f"t{k}", "c", "+-"[k % 2], [(a, a + 30), (a + 50, a + 90)]) for k in range(400) for a in [rng.randrange(1, 2 * sinks.PIECE)]]
    rows += [("far", "c", "+", [(sinks.PIECE - 5, sinks.PIECE + 5), (2 * sinks.PIECE, 2 * sinks.PIECE + 1)]), ("end", "c", "-", [(len(text) - 1, len(text) + 9)]), ("off", "d", "+", [(1, 2)])]
    t = spark.createDataFrame(rows, "transcript_id string, seqname string, strand string, exons array<struct<s: long, e: long>>")
    found = sinks.spliced(t, spark.createDataFrame([("c", text)], "seqname string, sequence string"))
    back = lambda x: x.translate(str.maketrans("ACGT", "TGCA"))[::-1]
    whole = {i: "".join(text[s - 1 : e] for s, e in x) for i, c, _, x in rows if c == "c"}
    assert {r[0]: r[1] for r in found.collect()} == {i: back(whole[i]) if st == "-" else whole[i] for i, _, st, _ in rows if i in whole}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        assert sum(moved(spark, lambda: found.write.format("noop").mode("overwrite").save())) < 600  # 400 transcripts of 800 exons
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_models_are_put_together_once(spark):
    at = [("c", "exon", "t1", "g", 5, 9), ("c", "CDS", "t1", "g", 6, 8), ("c", "transcript", "t2", "g", 1, 9)]
    rows = spark.createDataFrame([(*x, "+", 'gene_id "g";', "f", k) for k, x in enumerate(at)], "seqname string, feature string, transcript_id string, gene_id string, s long, e long, strand string, attr string, file_tag string, line_no long")
    t, missing = model.build(rows)
    plan = t._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and plan.count("Aggregate") == 1
    assert [(r["transcript_id"], len(r["cds"]), r["five_prime"][0]["e"]) for r in t.collect()] == [("t1", 1, 5)] and [r[0] for r in missing.collect()] == ["t2"]


def test_loci_are_told_apart_once(spark, monkeypatch):
    rows = [("c", "+", "g", i, s, e) for i, x in {"a": [(1, 50), (90, 120)], "b": [(10, 60), (95, 130)], "z": [(500, 600)]}.items() for s, e in x]
    t = cut(model.transcripts(spark.createDataFrame(rows, "seqname string, strand string, gene_id string, transcript_id string, s long, e long")))
    seen = []
    kept = structure.fragments
    monkeypatch.setattr(structure, "fragments", lambda rows, *x: (seen.append(rows), kept(rows, *x))[1])
    assert {r["label"] for r in structure.structural(t).collect()} == {"accepted"}
    plan = seen[0]._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join") == 1 and "Union" not in plan
