"""Text formats, and whole runs over small files."""

import pytest
from pyspark.sql import functions as F

from splicelake.cli import main
from splicelake.functions.attributes import attribute, tagged
from splicelake.functions.intervals import percent
from splicelake.operators import report, support
from splicelake.plans.config import Config
from splicelake.plans.pipeline import Run
from splicelake.sources import files, model, sinks


def line(feature, s, e, t, g="g1", c="c1", strand="+", extra=""):
    return f'{c}\tsrc\t{feature}\t{s}\t{e}\t.\t{strand}\t.\tgene_id "{g}"; transcript_id "{t}";{extra}\n'


@pytest.fixture
def annotation(tmp_path):
    folder = tmp_path / "refs"
    folder.mkdir()
    (folder / "one.gtf").write_text(
        "# a header\n\n"
        + line("exon", 300, 400, "a") + line("exon", 200, 100, "a") + line("exon", 100, 200, "a")
        + line("CDS", 150, 200, "a") + line("CDS", 300, 350, "a")
        + line("CDS", 1000, 1100, "only_cds") + line("gene", 1, 2, "none")
        + "c1\tsrc\texon\t1\t2\t.\t+\t.\n"
        + line("exon", 5000, 5100, "z", "g2", strand="-")
    )
    return folder


def test_rows_and_model(spark, annotation):
    rows = files.gtf(spark, str(annotation))
    assert rows.count() == 8
    t, missing = model.build(rows)
    got = {r["transcript_id"]: r for r in t.collect()}
    assert [tuple(x) for x in got["a"]["exons"]] == [(100, 200), (300, 400)] and [tuple(x) for x in got["a"]["introns"]] == [(201, 299)]
    assert [tuple(x) for x in got["a"]["five_prime"]] == [(100, 149)] and [tuple(x) for x in got["a"]["three_prime"]] == [(351, 400)]
    assert tuple(got["a"]["start_codon"]) == (150, 152) and tuple(got["a"]["stop_codon"]) == (348, 350)
    assert [tuple(x) for x in got["only_cds"]["exons"]] == [(1000, 1100)]
    assert [r[0] for r in missing.collect()] == ["none"]


def test_attributes(spark):
    rows = [('ref_gene_id "r"; gene_id "g"; transcript_id "t";',), ('transcript_id "open',), ('gene_id ""q"";',), ("nothing",)]
    df = spark.createDataFrame(rows, "attr string")
    got = df.select(attribute(F.col("attr"), "transcript_id"), attribute(F.col("attr"), "gene_id"), tagged(F.col("attr"), F.lit("f1"))).collect()
    assert [r[0] for r in got] == ["t", "open", None, None]
    assert got[0][1] == "r"  # the first occurrence, as part of a longer name too
    assert got[0][2] == 'ref_gene_id "r"; gene_id "g_f1"; transcript_id "t_f1";'


def test_manifests(spark, tmp_path, annotation):
    (annotation / "two.gtf").write_text(line("exon", 1, 9, "a"))
    (annotation / "x_skipped.gtf").write_text(line("exon", 1, 9, "a"))
    m = files.annotation_manifest(spark, str(annotation))
    assert [r["File_tag"] for r in m.orderBy("File_path").collect()] == ["file1", "file2"]
    ids = {r[0] for r in files.annotations(spark, m).select("transcript_id").distinct().collect()}
    assert {"a_file1", "a_file2"} <= ids
    sinks.write_table(m, str(tmp_path / "manifest"), ["File_tag"], ",")
    assert files.read_manifest(spark, str(tmp_path / "manifest")).count() == 2
    reads = tmp_path / "reads"
    reads.mkdir()
    for name in ("s1_R1.fastq", "s1_R2.fastq", "s2_R1.fastq", "s2_R2.fastq"):
        (reads / name).write_text("@r\nA\n+\nI\n")
    pairs = files.fastq_manifest(spark, str(reads)).collect()
    assert [(r[0][-11:], r[1][-11:]) for r in pairs] == [("s1_R1.fastq", "s1_R2.fastq"), ("s2_R1.fastq", "s2_R2.fastq")]
    (reads / "odd.fastq").write_text("@")
    with pytest.raises(ValueError):
        files.fastq_manifest(spark, str(reads))


def test_junction_rules(spark, tmp_path):
    row = lambda s, strand, motif, n, over: f"c1\t{s}\t{s + 50}\t{strand}\t{motif}\t0\t{n}\t0\t{over}\n"
    (tmp_path / "aSJ.out.tab").write_text(row(100, 1, 1, 5, 20) + row(300, 1, 0, 9, 20) + row(500, 1, 1, 9, 5) + row(700, 0, 2, 3, 10) + row(900, 2, 1, 1, 20))
    (tmp_path / "bSJ.out.tab").write_text(row(100, 1, 1, 3, 20))
    (tmp_path / "STARpass1").mkdir()
    (tmp_path / "STARpass1" / "cSJ.out.tab").write_text(row(700, 0, 2, 9, 20))
    j = files.junctions(spark, str(tmp_path))
    got = {(r["s"], r["strand"]): r for r in support.junction_support(j, 3.9, 2).collect()}
    assert set(got) == {(100, "+"), (300, "+"), (700, "."), (900, "-")}  # 500 has too little overhang
    assert got[100, "+"]["supported"] and got[300, "+"]["non_canonical"] and got[700, "."]["low_reads"]
    assert not got[900, "-"]["supported"] and not got[900, "-"]["low_reads"]
    m = {r["sj"]: r.asDict() for r in support.junction_matrix(j).collect()}
    assert m["c1+:100-150"]["aSJ.out.tab"] == 5 and m["c1.:700-750"]["bSJ.out.tab"] == 0


def test_abundance_rules(spark):
    q = spark.createDataFrame([("a", "1", 1.0), ("a", "2", 0.9), ("b", "1", 0.99), ("x", "1", 9.0)], "transcript_id string, sample string, tpm double")
    t = spark.createDataFrame([("a",), ("b",), ("c",)], "transcript_id string")
    assert dict(map(tuple, support.by_abundance(t, q).collect())) == {"a": "abundant", "b": "low", "c": "missing"}
    assert support.abundance(q, 1, 2).where("abundant").count() == 0


def test_percentiles_and_percent(spark):
    v = spark.createDataFrame([("k", x) for x in (1, 2, 3, 4)] + [("one", 7)], "category string, value long")
    got = {(r[0], r[1]): r[2] for r in report.percentiles(v, points=(0, 50, 99, 100)).collect()}
    assert [got["k", p] for p in (0, 50, 99, 100)] == [1, 3, 4, 4] and {got["one", p] for p in (0, 50, 100)} == {7}
    cases = [(7, 2000), (247, 2000), (1, 3), (0, 0), (1, 8)]
    df = spark.createDataFrame(cases, "n long, t long").select(percent(F.col("n"), F.col("t")))
    assert [r[0] for r in df.collect()] == [round(n / t * 100, 1) if t else 0.0 for n, t in cases]


def test_fasta(spark, tmp_path):
    (tmp_path / "g.fa").write_text(">c1 first\nACGT\nTTGA\n>c2#x\n\nGG\n")
    assert [r[0] for r in files.fasta_names(spark, str(tmp_path / "g.fa")).collect()] == ["c1", "c2"]
    genome = files.fasta(spark, str(tmp_path / "g.fa"))
    assert {tuple(r) for r in genome.collect()} == {("c1", "ACGTTTGA"), ("c2", "GG")}
    rows = [("c1", "+", "g", "p", 1, 2), ("c1", "+", "g", "p", 5, 6), ("c1", "-", "g", "m", 1, 2), ("c1", "-", "g", "m", 5, 6)]
    t = model.transcripts(spark.createDataFrame(rows, "seqname string, strand string, gene_id string, transcript_id string, s long, e long"))
    assert dict(map(tuple, sinks.spliced(t, genome).collect())) == {"p": "ACTT", "m": "AAGT"}


def test_configuration():
    with pytest.raises(ValueError):
        Config("", "x", references="r").checked()
    with pytest.raises(ValueError):
        Config("o", "x", assemblies="a").checked()
    with pytest.raises(ValueError):
        Config("o", "x", references="r", fragment_len=0).checked()
    c = Config("o", "x", references="r").checked()
    assert c.add == {"overextended"} and c.prefix == "x"
    assert Config("o", "x", references="r", add=frozenset(("uniform",))).checked().add == {"uniform"}


def text(path):
    return "".join(p.read_text() for p in sorted(path.glob("part-*")))


def test_run_over_references(spark, tmp_path, annotation):
    assert main(["--references", str(annotation), "--outpath", str(tmp_path), "--outname", "out"]) == 0
    out = tmp_path / "out_annotation"
    final = text(out / "final")
    assert 'transcript_id "out_c1G000010.RTD.1"; gene_id "out_c1G000010";' in final and "\n\n" not in final
    assert "TXNAME,GENEID" in text(out / "mapping") and "Original_ID,Novel_id" in text(out / "lookup" / "gene_ids")
    assert "multi_isoform\t1\t2" in text(out / "report" / "numbers_gene_categories")
    assert "c1\tsrc\texon\t100\t200\t.\t+" in text(out / "padded")
    assert main(["--references", str(annotation), "--outpath", str(tmp_path), "--outname", "out"]) == 2  # it is there already
    (tmp_path / "none").mkdir()
    (tmp_path / "none" / "x.gtf").write_text("# nothing\n")
    assert main(["--references", str(tmp_path / "none"), "--outpath", str(tmp_path), "--outname", "new"]) == 2


def test_run_over_assemblies(spark, tmp_path, annotation):
    (annotation / "one.gtf").write_text(
        line("exon", 100, 200, "a") + line("exon", 300, 400, "a") + line("exon", 100, 200, "b") + line("exon", 350, 420, "b") + line("exon", 10, 90, "q", "g3", "c7")
    )
    sj, quant = tmp_path / "sj", tmp_path / "quant"
    sj.mkdir()
    quant.mkdir()
    (sj / "xSJ.out.tab").write_text("c1\t201\t299\t1\t1\t0\t9\t0\t30\n")
    (quant / "x.sf").write_text("Name\tLength\tEffectiveLength\tTPM\tNumReads\na\t10\t9\t5.0\t3\n")
    (tmp_path / "g.fa").write_text(">c1\n" + "ACGTACGTAC" * 50 + "\n")
    run = Run(spark, Config(str(tmp_path), "asm", assemblies=str(annotation), sj_data=str(sj), quant=str(quant), genome=str(tmp_path / "g.fa"), keep=frozenset(("removed",))))
    assert [r["transcript_id"] for r in run().collect()] == ["asm_c1G000010.RTD.1"]
    removed = {m[1]: m[2] for m in run.metrics if m[0] == "Removed"}
    assert removed["assemblies_location_unknown_seqname"] == 1 and removed["assemblies_junctions_false"] == 1
    assert ">asm_c1G000010.RTD.1" in text(tmp_path / "asm_annotation" / "fasta")


def stamped(folder):
    return {p.parent.name: p.stat().st_mtime_ns for p in (folder / "stages").glob("*/_SUCCESS")}


def test_a_run_that_resumes_repeats_no_stage(spark, tmp_path, annotation):
    c = dict(outpath=str(tmp_path), outname="r", references=str(annotation), keep=frozenset(("removed", "intermediary", "exploratory")))
    (annotation / "one.gtf").write_text((annotation / "one.gtf").read_text() + "".join(line("exon", s, s + 100, f"d{k}", "g9") for k in range(2) for s in (8000, 8500)))
    first = Run(spark, Config(**c))().select("transcript_id", "s", "e").collect()
    out = tmp_path / "r_annotation"
    before = stamped(out)
    assert {"references_model", "merged_redundancy", "merged_location", "merged_structure", "structure_sets"} <= set(before)
    assert 'transcript_id "d0"' in "".join(p.read_text() for p in (out / "removed" / "merged_redundancy" / "gtf").rglob("part-*"))
    assert 'transcript_id "d1"' in text(out / "intermediary" / "merged_structure") and "all done" in text(out / "log")
    assert "Transcript_ID" in text(out / "report" / "IDs_other_categories_intronic") or (out / "report" / "IDs_other_categories_intronic").exists()
    with pytest.raises(ValueError):
        Run(spark, Config(**c))()
    # a stage that was lost is made again, the others aren't
    import shutil

    shutil.rmtree(out / "stages" / "merged_structure")
    again = Run(spark, Config(**c, resume=True))
    assert sorted(map(tuple, again().select("transcript_id", "s", "e").collect())) == sorted(map(tuple, first))
    after = stamped(out)
    assert {k for k in before if before[k] != after[k]} == {"merged_structure"}
    assert any("merged_redundancy: taken" in x for _, x in again.lines)
    with pytest.raises(ValueError):
        Run(spark, Config(**c, resume=True, fragment_len=0.5))()


def test_a_run_hands_over_to_a_quantifier(spark, tmp_path, annotation, capsys):
    (annotation / "one.gtf").write_text(line("exon", 100, 200, "a") + line("exon", 300, 400, "a"))
    for name in ("sj", "reads", "quant"):
        (tmp_path / name).mkdir()
    (tmp_path / "sj" / "xSJ.out.tab").write_text("c1\t201\t299\t1\t1\t0\t9\t0\t30\n")
    for k in (1, 2):
        (tmp_path / "reads" / f"s_R{k}.fastq").write_text("@r\nA\n+\nI\n")
    (tmp_path / "g.fa").write_text(">c1\n" + "ACGTACGTAC" * 50 + "\n")
    args = f"--assemblies {annotation} --sj-data {tmp_path}/sj --genome {tmp_path}/g.fa --outpath {tmp_path} --outname q".split()
    assert main([*args, "--fastq", str(tmp_path / "reads")]) == 3 and "--resume" in capsys.readouterr().out
    at = tmp_path / "q_annotation" / "quantify"
    assert ">a\n" in text(at / "transcripts") and "s_R1.fastq" in text(at / "reads")
    (tmp_path / "quant" / "x.sf").write_text("Name\tLength\tEffectiveLength\tTPM\tNumReads\na\t10\t9\t5.0\t3\n")
    assert main([*args, "--quant", str(tmp_path / "quant"), "--resume"]) == 0
    assert "q_c1G000010.RTD.1" in text(tmp_path / "q_annotation" / "final")


def test_report_of_one_annotation_needs_a_place(annotation):
    with pytest.raises(SystemExit):
        main(["--report-only", str(annotation / "one.gtf")])


def test_ids_from_whole_names(spark, annotation):
    (annotation / "one.gtf").write_text('c1\tsrc\texon\t1\t9\t.\t+\t.\tref_gene_id "r"; gene_id "g"; transcript_id "t";\n')
    (annotation / "two.gtf").write_text('c1\tsrc\texon\t1\t9\t.\t+\t.\tref_gene_id "r"; gene_id "g"; transcript_id "t";\n')
    m = files.annotation_manifest(spark, str(annotation))
    assert {r["gene_id"] for r in files.annotations(spark, m).collect()} == {"r"}
    assert {r["gene_id"] for r in files.annotations(spark, m, exact=True).collect()} == {"g_file1", "g_file2"}


def test_splicing_across_pieces(spark, monkeypatch):
    monkeypatch.setattr(sinks, "PIECE", 7)
    bases = "ACGTTGCAGCATTACGGATCCATG"
    genome = spark.createDataFrame([("c", bases), ("other", "AC")], "seqname string, sequence string")
    rows = [("c", "+", "g", "p", 3, 16), ("c", "+", "g", "p", 20, 30), ("c", "-", "g", "m", 7, 8), ("c", "-", "g", "m", 14, 15), ("x", "+", "g", "no", 1, 2), ("other", "+", "g", "beyond", 5, 9)]
    t = model.transcripts(spark.createDataFrame(rows, "seqname string, strand string, gene_id string, transcript_id string, s long, e long"))
    back = str.maketrans("ACGT", "TGCA")
    want = {"p": bases[2:16] + bases[19:], "m": (bases[6:8] + bases[13:15]).translate(back)[::-1], "beyond": ""}
    assert dict(map(tuple, sinks.spliced(t, genome).collect())) == want


def test_incremental_winners(spark, tmp_path):
    from splicelake.streaming.incremental import winners

    rows = [("c1", "+", "g", i, s, e) for i, x in {"a": [(1, 10), (20, 30)], "b": [(1, 10), (20, 40)], "c": [(1, 10), (20, 40)]}.items() for s, e in x]
    t = model.transcripts(spark.createDataFrame(rows, "seqname string, strand string, gene_id string, transcript_id string, s long, e long"))
    t.repartition(3, "transcript_id").write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(t.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    winners(stream, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    last = max(int(p.name[2:]) for p in (tmp_path / "out").glob("v=*"))
    assert [r["transcript_id"] for r in spark.read.parquet(str(tmp_path / "out" / f"v={last}")).collect()] == ["c"]
