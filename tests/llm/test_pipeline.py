"""The stages over a small table, and what they must keep."""

import os
import random

import corpus_pipeline
import duckdb
import pytest
from pyspark.sql import functions as F
from test_operators import CLASHES, ODD, docs, plain_leaks, prose
from test_tables import HERE, exact_components, tokens

from splicelake.llm import linedup, mixing, toxicity


def test_stages(spark, tmp_path):
    rng = random.Random(12)
    vocabulary = [f"w{rng.randrange(10**5)}" for _ in range(3000)]
    fresh = lambda n: prose(rng, n, vocabulary)
    passage, leak, item = fresh(60), fresh(50), fresh(40)
    rows = [(k, fresh(80), f"s{k % 3}") for k in range(120)]
    rows += [(200 + k, f"{fresh(40)}\n{passage}\n{fresh(30)}", "s0") for k in range(5)]
    rows += [(300 + k, rows[7][1] + " tail" * k, "s1") for k in range(3)]
    rows += [(400, f"{leak} {item} {leak}", "s2"), (500, None, "s2"), (501, "", None)]
    rows += [(600 + k, f"{fresh(20)} grumbat {fresh(20)}", "s1") for k in range(40)]
    path = str(tmp_path)
    table = docs(spark, rows)
    table.write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(k, 1, int(k >= 600)) for k in [*range(100), *range(600, 640)]], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    at, seen = table, {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, at, path)
        out.write.parquet(f"{path}/out/{name}")
        at = spark.read.parquet(f"{path}/out/{name}")
        seen[name] = {r["doc_id"]: r["text"] for r in at.collect()}
        if name != "mixing":
            assert at.columns == table.columns
    first = set(range(120)) | set(range(200, 205))
    assert first <= set(seen["toxicity"]) and not set(range(600, 640)) & set(seen["toxicity"])
    assert not any(passage in (t or "") for t in seen["line_dedup"].values()) and set(seen["line_dedup"]) == set(seen["toxicity"])
    assert set(range(120)) <= set(seen["near_dedup"]) and not {300, 301, 302} & set(seen["near_dedup"])
    assert set(seen["near_dedup"]) - set(seen["decontamination"]) == {400}
    assert len(seen["mixing"]) > 0 and set(seen["mixing"]) <= set(seen["decontamination"])
    whole = {(r["doc_id"], r["copies"]) for r in corpus_pipeline.run(spark, path).collect()}
    assert whole == {(r["doc_id"], r["copies"]) for r in at.collect()}


def sql_over(path, sql):
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{path}/*.parquet'")
    return con.execute(sql).df()


@pytest.mark.skipif(not os.path.isdir(HERE), reason="no driver tables")
def test_stages_by_brute_force(spark, tmp_path):
    """Every stage over a whole table, on what the one before kept, against SQL, all pairs, or the operator one text at a time."""
    at = spark.read.parquet(f"{HERE}/documents.parquet")
    marks = spark.read.parquet(f"{HERE}/labels.parquet")
    items = [(r["item_id"], tokens(r["text"])) for r in spark.read.parquet(f"{HERE}/benchmark.parquet").collect()]
    columns, path = at.columns, f"{tmp_path}/in"
    at.write.parquet(path)
    for name, stage in corpus_pipeline.STAGES:
        before = {r["doc_id"]: r["text"] for r in at.collect()}
        out = f"{tmp_path}/{name}"
        stage(spark, at, HERE).write.parquet(out)
        after = spark.read.parquet(out)
        got = {r["doc_id"]: r["text"] for r in after.collect()}
        if name == "toxicity":
            want = {r["doc_id"] for r in toxicity.toxicity(at, marks).where("predicted = 0").collect()}  # held against one text at a time elsewhere
            assert got == {i: before[i] for i in want} and len(got) < len(before)
        elif name == "line_dedup":
            df = sql_over(path, linedup.ORACLE_SQL)
            assert got == dict(zip(df.doc_id, df.text.astype(object).where(df.text.notna(), None), strict=True)) and got != before
            assert all(r["n_chars"] == (None if r["text"] is None else len(r["text"])) for r in after.collect())
        elif name == "near_dedup":
            roots, _ = exact_components(list(before.items()), 5)
            assert got == {i: t for i, t in before.items() if roots[i] == i} and len(got) < len(before)
        elif name == "decontamination":
            leaks = {d for d, _ in plain_leaks([(i, tokens(t)) for i, t in before.items() if t], [x for x in items if x[1]])}
            assert got == {i: t for i, t in before.items() if i not in leaks}
        else:
            df = sql_over(path, mixing.ORACLE_SQL)
            assert {r["doc_id"]: r["taken"] for r in after.where("taken > 0").collect()} == {i: t for i, t in zip(df.doc_id, df.taken, strict=True) if t > 0}
        assert name == "mixing" or after.columns == columns
        at, path = after, out


def test_run_over_odd_rows_and_empty_tables(spark, tmp_path):
    rng = random.Random(13)
    passage = prose(rng, 60)
    rows = [(k, f"{prose(rng, 30)}\n{passage}\n{prose(rng, 30)}", f"s{k % 2}") for k in range(100, 120)]
    table = docs(spark, [*ODD, *ODD, *rows, *rows[:3]]).withColumns({c: F.lit(f"own {c}") for c in CLASHES})
    marks = spark.createDataFrame([(k, 1, int(k == 101)) for k in range(100, 120)] + [(None, 1, 1), (102, None, None)], "doc_id long, quality int, toxic int")
    bench = spark.createDataFrame([(1, "a passage that stands nowhere in these texts at all"), (2, None), (None, "x")], "item_id long, text string")
    for name, part in (("all", table), ("empty", table.where("false"))):
        path = f"{tmp_path}/{name}"
        part.write.parquet(f"{path}/documents.parquet")
        marks.write.parquet(f"{path}/labels.parquet")
        bench.write.parquet(f"{path}/benchmark.parquet")
        at = spark.read.parquet(f"{path}/documents.parquet")
        for k, (stage_name, stage) in enumerate(corpus_pipeline.STAGES[:4]):
            stage(spark, at, path).write.parquet(f"{path}/out{k}")
            at = spark.read.parquet(f"{path}/out{k}")
            assert at.columns == table.columns, stage_name
            assert all(r[c] == f"own {c}" for r in at.collect() for c in CLASHES), stage_name
        got = corpus_pipeline.run(spark, path).collect()
        if name == "empty":
            assert got == []
        else:
            assert {r["doc_id"] for r in at.collect()} >= {1, 2, 3, 4, 5, 6, None} and got
            assert not any(passage in (r["text"] or "") for r in got)
            assert at.where("doc_id = 4").count() == 1 and at.where("doc_id is null").count() == 2
