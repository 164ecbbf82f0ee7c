"""Redundancy kept up over arriving files, rows in buckets, and matrices of any width."""

import random

import pytest
from pyspark.sql import functions as F
from test_intervals import frame, random_loci

from splicelake.functions.lineage import bucketed
from splicelake.operators import redundancy, support
from splicelake.sources import sinks
from splicelake.streaming import incremental


@pytest.mark.parametrize("seed", [1, 2])
def test_any_order_of_files_gives_the_batch_result(spark, tmp_path, seed):
    loci = random_loci(seed, 150)
    t = frame(spark, loci).cache()
    ids = list(loci)
    random.Random(seed).shuffle(ids)
    for k in range(5):  # a file is a batch
        t.where(F.col("transcript_id").isin(ids[k::5])).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(t.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    state = str(tmp_path / "state")
    incremental.redundancy_state(stream, state, str(tmp_path / "cp")).awaitTermination()
    chains, spans = incremental.current(spark, state)
    want = {r["transcript_id"] for r in redundancy.identical_chains(t).where("kept").collect()}
    assert {r["transcript_id"] for r in chains.collect()} == want
    want = {r["transcript_id"] for r in redundancy.monoexons(t).where("kept").collect()}
    got = [r["transcript_id"] for r in spans.collect()]
    assert set(got) == want and len(got) == len(want)
    before = [sorted(map(str, df.collect())) for df in incremental.current(spark, state)]
    incremental.merge_batch(t.where(F.col("transcript_id").isin(ids[4::5])), state, 4)  # run again: nothing changes
    assert [sorted(map(str, df.collect())) for df in incremental.current(spark, state)] == before
    last = spark.read.parquet(f"{state}/loci/version=4").count()
    assert 0 < last < len(want)  # what it doesn't touch isn't written again


def test_rows_in_buckets_stay_where_they_are(spark):
    rows = spark.range(300).select(F.concat(F.lit("t"), F.col("id") % 50).alias("transcript_id"), F.col("id").alias("line_no"))
    held = bucketed(rows, "transcript_id", 4)
    ids = spark.createDataFrame([(f"t{k}",) for k in range(20)], "transcript_id string")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = held.join(ids, "transcript_id", "left_semi")
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert joined.count() == 120 and plan.count("Exchange hashpartitioning") == 1
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_matrix_of_many_files(spark, tmp_path):
    rng = random.Random(9)
    names, rows = [f"s{k:05d}" for k in range(12_000)], []
    for k in range(40):
        for name in rng.sample(names, rng.choice([1, 3, 50])):
            rows.append(("c1", "+", k * 10, k * 10 + 5, name, 1, rng.randrange(1, 9), 30))
    rows += [("c1", "-", 1, 5, name, 1, 2, 30) for name in names]
    j = spark.createDataFrame(rows, "seqname string, strand string, s long, e long, sample string, motif int, n_unique long, overhang int")
    counts, numbers = support.junction_counts(j)
    files = {r["file"]: r["number"] for r in numbers.collect()}
    assert files == {n: k for k, n in enumerate(names)}
    got = {r["sj"]: r["reads"] for r in counts.collect()}
    want = {}
    for c, strand, s, e, name, _, n, _ in rows:
        want.setdefault(f"{c}{strand}:{s}-{e}", [0] * len(names))[files[name]] += n
    assert got == want
    sinks.write_matrix(counts, numbers, str(tmp_path / "m"))
    lines = [x for p in sorted((tmp_path / "m").glob("part-*")) for x in p.read_text().splitlines()]
    assert lines[0].split("\t") == ["sj", *names]
    assert {x.split("\t")[0]: list(map(int, x.split("\t")[1:])) for x in lines[1:]} == want and [x.split("\t")[0] for x in lines[1:]] == sorted(want)
