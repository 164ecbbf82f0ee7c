"""Steps whose work has to grow no faster than their rows: what moves, and how often rows are made."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from splicelake.functions.lineage import cut
from splicelake.operators import grouping, quantify, report
from splicelake.plans import adapter, filequeries
from splicelake.sources import model, reads

TABLES = "/root/testdata/sf0.001"
driver_tables = pytest.mark.skipif(not os.path.isdir(TABLES), reason="no driver tables")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@driver_tables
def test_exons_of_a_transcript_do_not_move(spark):
    t = plan(adapter.transcripts(spark, TABLES))
    assert t.count("Exchange ") == 2 and t.rfind("Exchange ", 0, t.index("Generate")) < t.index("Generate")


def test_consensus_keeps_the_columns_of_its_rows(spark):
    rows = [("c", "+", "g", i, s, e) for i, x in {"a": [(1, 50), (90, 120)], "b": [(10, 60), (95, 130)], "z": [(500, 600)]}.items() for s, e in x]
    t = model.transcripts(spark.createDataFrame(rows, "seqname string, strand string, gene_id string, transcript_id string, s long, e long"))
    got = grouping.in_consensus(cut(grouping.overlap_groups(t)))
    assert got.columns == [*t.columns, "locus", "consensus"]
    assert {r["transcript_id"]: r["consensus"] for r in got.collect()} == {"a": "a", "b": "a", "z": "z"}


def test_lines_meet_their_splits_where_they_are(spark, tmp_path):
    (tmp_path / "a.fastq").write_text("@r\nACGT\n+\nIIII\n")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        assert "SortMergeJoin" not in plan(reads.numbered(reads.lines(spark, str(tmp_path))))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_kmers_of_a_small_file_are_many_tasks(spark):
    one = cut(spark.createDataFrame([(f"t{i}", "ACGTTGCAAC" * 4) for i in range(64)], "transcript_id string, sequence string").coalesce(1))
    assert one.rdd.getNumPartitions() == 1
    seen = []
    kept = quantify.cut
    quantify.cut = lambda df: (seen.append(df), kept(df))[1]
    try:
        quantify.index(one, 21)
    finally:
        quantify.cut = kept
    assert seen[0].select(F.spark_partition_id().alias("p")).distinct().count() > 1


def test_kmers_of_odd_letters(spark):
    text = spark.createDataFrame([("acgnACGTA",), ("ACGé",), ("AC",), ("",)], "x string")
    got = [sorted(r[0]) for r in text.select(quantify.kmers(F.col("x"), 3)).collect()]
    assert got == [["ACG", "ACG", "ACG", "GTA"], ["ACG"], [], []]


def test_files_without_an_order_are_not_sorted(spark, tmp_path):
    lines = spark.createDataFrame([(f"{k % 3}.gtf", str(k)) for k in range(30)], "file string, value string")
    before = spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")
    with filequeries.at_once(spark):
        assert int(spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")) == filequeries.OPEN
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == before
    at = filequeries.put(spark, lines, f"file://{tmp_path}/in")
    found = {os.path.basename(x): sorted(map(int, open(x).read().split())) for x in glob.glob(f"{tmp_path}/in/*.gtf")}
    assert found == {f"{r}.gtf": list(range(r, 30, 3)) for r in range(3)} and at


@driver_tables
def test_reports_take_spanning_groups_that_are_known(spark):
    t = cut(adapter.transcripts(spark, TABLES))
    found = cut(report.spanned(t))
    for f in (report.potentially_chimeric, report.potentially_split):
        assert sorted(map(tuple, f(t, found).collect())) == sorted(map(tuple, f(t).collect()))
