"""DuckDB SQL for the queries that go through files, and for loci made to measure."""

from . import adapter
from .oracle import BASE, KEYS, LABELS, MODEL, NEW_IDS, PADDED, POINTS, RENAMED, SJ, SQL, STRANDED, STRUCTURAL, _q, _support, antifrag, antisense, chimeric, fragments, intronic, islands

#: The bases of a span of the test genome: digests of names and places, joined and cut.
def _bases(s: str, e: str) -> str:
    chunk = "translate(md5(concat(seqname, ':', cast(c as varchar))), '0123456789abcdef', 'ACGTACGTACGTACGT')"
    return f"substr(array_to_string(list_transform(range(({s}-1)//32, ({e}-1)//32+1), lambda c: {chunk}), ''), cast(({s}-1)%32+1 as bigint), {e}-{s}+1)"


def _back(bases: str) -> str:
    return f"reverse(translate({bases}, 'ACGTacgtNn', 'TGCAtgcaNn'))"


def _smaller(bases: str) -> str:
    return f"least({bases}, {_back(bases)})"


_COLUMNS = "seqname, strand, gene_id, transcript_id, k"
ROWS = (
    KEYS
    + f"""
rw as (select 'exon' feature, {_COLUMNS}, s, e from px where k%37<>0 and k%43<>0
  union all select 'CDS', {_COLUMNS}, s + case when i=1 then 5 else 0 end, e - case when i=n then 5 else 0 end from px where k%37=0 or (k%11=0 and n>=2 and k%43<>0)
  union all select 'transcript', {_COLUMNS}, s, e from px where k%43=0 and k%37<>0 and i=1),
ex as (select seqname, strand, gene_id, transcript_id, s, e from rw where feature='exon' or (feature='CDS' and k%37=0)),"""
    + MODEL
    + """,
cd as (select transcript_id, strand, min(s) cs, max(e) ce, count(*) n, string_agg(concat(s,'-',e), ',' order by s) chain from rw where feature='CDS' group by 1, 2),
al as (select transcript_id, string_agg(concat(s,'-',e), ',' order by s) chain from ex group by 1)"""
)


def shaped(name: str) -> str:
    """The model of loci made to measure, in place of the adapter's."""
    values = ", ".join(f"({v}, {j}, '{strand}', {s}, {e})" for v, j, strand, s, e in adapter.shape_rows(name))
    variants = max(r[0] for r in adapter.shape_rows(name)) + 1
    return (
        f"""
sh as (select * from (values {values}) v(variant, j, strand, xs, xe)),
ky as (select distinct o_orderkey k, cast(floor(o_orderkey/{adapter.PER_LOCUS}) as bigint) lc from orders),
ex as (select concat('chr', lc%3) seqname, strand, concat('G', lpad(cast(lc as varchar), 9, '0'), strand) gene_id, concat('T', lpad(cast(k as varchar), 9, '0')) transcript_id,
  cast(lc*{adapter.WIDTH}+xs as bigint) s, cast(lc*{adapter.WIDTH}+xe as bigint) e from ky join sh on j = k%{adapter.PER_LOCUS} and variant = lc%{variants}),"""
        + MODEL
    )


_PAIR = "case when {0} then cs else ce-2 end s, case when {0} then cs+2 else ce end e"
_LEFT, _RIGHT = "x.s s, least(x.e, cs-1) e from ex x join cd using (transcript_id) where x.s < cs", "greatest(x.s, ce+1) s, x.e e from ex x join cd using (transcript_id) where x.e > ce"
_WANTED = "wn as (select transcript_id from an union all select transcript_id from tr where not exists (select 1 from an))"

LOCATION = (STRANDED, antisense("an", "st"), _WANTED, antifrag("af", "wn", "0.5"))
LOCATION_LABELS = "select transcript_id, case when strand not in ('+','-') then 'unstranded' else coalesce((select min(label) from af where af.transcript_id=tr.transcript_id), 'accepted') end label from tr"


def run_metrics() -> str:
    """Labels of the three stages of a run over references, each over what the one before accepted. Genes end at their files."""
    tagged = "select seqname, strand, concat(gene_id, '_', k%4) gene_id, transcript_id, s, e from rw where feature='exon' or (feature='CDS' and k%37=0)"
    whole = _q("select * from e0", f"e0 as ({tagged})", base=ROWS)
    after = lambda *stages: f"ex as (select * from ({whole}) where true" + "".join(f" and transcript_id in (select transcript_id from {x} where label='accepted')" for x in stages) + ")," + MODEL
    first = SQL["redundancy_labels"].replace(BASE.strip().strip(","), after().strip())
    stages = {"merged_redundancy": first, "merged_location": _q(LOCATION_LABELS, *LOCATION, base=after("r1")), "merged_structure": _q(LABELS, *STRUCTURAL, base=after("r1", "r2"))}
    ctes = ", ".join(f"r{k} as materialized ({sql})" for k, sql in enumerate(stages.values(), 1))
    rows = " union all ".join(f"select '{name}_' || label as \"File\", label, count(*) n from r{k} group by 1, 2" for k, name in enumerate(stages, 1))
    return f"with {ctes} select case when label='accepted' then 'Accepted' else 'Removed' end \"Category\", \"File\", n from ({rows})"


FILES = "fi as (select distinct concat(seqname, '/', k%4, '.gtf') file from rw)"
SEQUENCES = f"""sx as (select transcript_id, strand, s, {_bases("s", "e")} b from ex where seqname <> 'chr4'),
tx as (select *, length(sequence) n, cast(greatest(length(sequence) - 60 + 1, 1) as double) el, cast(substr(transcript_id, 2) as bigint) k
  from (select transcript_id, case when any_value(strand)='-' then {_back("string_agg(b, '' order by s)")} else string_agg(b, '' order by s) end sequence from sx group by 1))"""
READS = (
    SEQUENCES,
    "fg as (select k, j, sequence, least(n, 60) f, (k*7+j*13)%(n-least(n, 60)+1) p from tx cross join (select unnest([0, 1, 2, 3]) j) where j <= k%4 and n >= 36)",
    f"""rd as (select k, j, concat('sample', k%3) sample, concat('sample', k%3, '/lane', (k//3)%4) lane, case when (k+j)%2=1 then b else a end left_read, case when (k+j)%2=1 then a else b end right_read
  from (select *, substr(sequence, cast(p+1 as bigint), 36) a, {_back("substr(sequence, cast(p+f-35 as bigint), 36)")} b from fg))""",
)
#: Members of each read's class by the k-mers themselves, and twelve rounds over classes as lists of members.
EM = (
    f"ix as materialized (select distinct transcript_id, {_smaller('substr(sequence, cast(i+1 as bigint), 21)')} kmer from (select transcript_id, sequence, unnest(range(0, n-20)) i from tx))",
    f"km as (select distinct k, j, {_smaller('substr(x, place+1, 21)')} kmer from (select k, j, unnest([left_read, right_read]) x from rd) cross join (select unnest([0, 10, 15]) place))",
    "nk as (select k, j, count(*) n from km group by 1, 2)",
    "mb as (select k, j, transcript_id from km join ix using (kmer) join nk using (k, j) group by k, j, transcript_id, n having count(*) = n)",
    "cl as materialized (select sample, members, count(*) n from (select sample, list(transcript_id order by transcript_id) members from mb join rd using (k, j) group by sample, k, j) group by 1, 2)",
    "cm as materialized (select sample, c, m.n, m.transcript_id, el from (select sample, n, c, unnest(members) transcript_id from (select *, row_number() over () c from cl)) m join tx t on m.transcript_id = t.transcript_id)",
    """em as (select 0 round, sample, transcript_id, cast(1 as double) x from (select distinct sample, transcript_id from cm)
  union all select round + 1, sample, transcript_id, sum(n * w / whole) from
    (select round, cm.sample, cm.transcript_id, cm.n, x / el w, sum(x / el) over (partition by cm.sample, c) whole from em join cm on em.sample = cm.sample and em.transcript_id = cm.transcript_id where round < 12)
  group by 1, 2, 3)""",
)

FILE_SQL: dict[str, str] = {
    "gtf_rows": _q("select feature, seqname, strand, gene_id, transcript_id, s, e from rw", base=ROWS),
    "gtf_model": _q("select seqname, strand, gene_id, transcript_id, tr.s, tr.e, nx n_exons, coalesce(n, 0) n_cds from tr left join (select transcript_id, n from cd) using (transcript_id)", base=ROWS),
    "missing_exons": _q("select transcript_id from rw where feature='transcript'", base=ROWS),
    "cds_or_exons": _q("select transcript_id, coalesce(cd.chain, al.chain) chain from al left join cd using (transcript_id)", base=ROWS),
    "utr_regions": _q(
        f"""select transcript_id, case when cd.strand='+' then 'five_prime' else 'three_prime' end region, {_LEFT} and cd.strand in ('+','-')
  union all select transcript_id, case when cd.strand='+' then 'three_prime' else 'five_prime' end, {_RIGHT} and cd.strand in ('+','-')
  union all select transcript_id, 'start_codon', {_PAIR.format("strand='+'")} from cd where strand in ('+','-')
  union all select transcript_id, 'stop_codon', {_PAIR.format("strand='-'")} from cd where strand in ('+','-')""",
        base=ROWS,
    ),
    "annotation_manifest": _q("select file name, concat('file', row_number() over (order by file)) \"File_tag\" from fi", FILES, base=ROWS),
    "gtf_tagged": _q("select tag file_tag, gene_id || '_' || tag gene_id, transcript_id || '_' || tag transcript_id, count(*) n from rw join (select file, concat('file', row_number() over (order by file)) tag from fi) on file = concat(seqname, '/', k%4, '.gtf') group by all", FILES, base=ROWS),
    "fastq_manifest": _q("select concat(lane, '_R1.fastq') \"File_pair_1\", concat(lane, '_R2.fastq') \"File_pair_2\" from (select distinct lane from rd)", *READS),
    "fastq_records": _q(
        """select concat(lane, '_R', mate, '.fastq') file, row_number() over (partition by lane, mate order by k, j) - 1 record, concat('read_', k, '_', j) name, case mate when 1 then left_read else right_read end "sequence",
  concat(substr('@+I#', j + 1, 1), repeat('I', 35)) quality, true intact from rd cross join (select unnest([1, 2]) mate)""",
        *READS,
    ),
    "quantified": _q(
        """select sample, transcript_id, cast(n as bigint) length, el effective_length, round(coalesce(x, 0) / el * 1e6 / sum(coalesce(x, 0) / el) over (partition by sample), 4) tpm, round(coalesce(x, 0), 6) num_reads
  from tx cross join (select distinct sample from cl) left join (select * from em where round = 12) using (sample, transcript_id)""",
        *READS, *EM,
    ).replace("with ", "with recursive ", 1),
    "sj_files": _q("select seqname, strand, s, e, sample || '_' || seqname || 'SJ.out.tab' sample, motif, n_unique, overhang from sj", SJ),
    "quant_files": _q("select transcript_id, sample, tpm from q3", "q3 as (select concat('T',lpad(cast(o_orderkey as varchar),9,'0')) transcript_id, concat('sample', f.f) sample, cast(((o_orderkey*7+f.f*13)%40) as double)/10 tpm from orders cross join (values (0),(1),(2)) f(f))"),
    "fasta_names": _q("select transcript_id seqname from tx", SEQUENCES),
    "spliced_fasta": _q('select transcript_id, sequence "sequence" from tx', SEQUENCES),
    "written_gtf": _q("select feature, transcript_id, gene_id, s, e from rw where strand='+'", base=ROWS),
    "padded_gtf": _q("select 'exon' feature, transcript_id, s, e, '.' score from pe where transcript_id in (select transcript_id from rw where feature='exon') union all select feature, transcript_id, s, e, '.' from rw where feature='CDS'", *PADDED, base=ROWS),
    "renamed_gtf": _q("select feature, new_transcript_id transcript_id, new_gene_id gene_id, rw.s, rw.e from rw join ni using (transcript_id)", *RENAMED, f"ni as ({NEW_IDS})", base=ROWS),
    "split_gtf": _q("select case strand when '+' then 'plus' when '-' then 'minus' else 'none' end side, count(*) n from rw group by 1", base=ROWS),
    "table_file": SQL["gene_bounds"],
    "location_file": _q("select concat(seqname, ':', s, '-', e) as \"Location\", transcript_id as \"Transcript\" from tr"),
    "lookup_files": _q("select distinct 'gene' kind, gene_id \"Original_ID\", new_gene_id \"Novel_id\" from ni union all select 'transcript', transcript_id, new_transcript_id from ni", *RENAMED, f"ni as ({NEW_IDS})"),
    "rejected_files": _q("select distinct 'non_canonical' kind, concat(seqname, ':', s, '-', e) \"SJ_id\" from su where non_canonical union all select distinct 'low_reads', concat(seqname, ':', s, '-', e) from su where met>0 and met<2", SJ, _support(4, 2)),
    "interpolated_percentiles": _q(f"select seqname, cast(p.p as bigint) percentile, round(list_extract(q, p.i), 6) as value from (select seqname, quantile_cont(cast(len as double), [{', '.join(str(int(p) / 100) for p in POINTS.split(','))}]) q from tr group by 1) cross join (select unnest([{POINTS}]) p, generate_subscripts([{POINTS}], 1) i) p"),
    "other_numbers": "with oc as ("
    + SQL["other_categories"]
    + "), "
    + _q(
        """select category, count(distinct gene_id) genes, coalesce(round(cast(100.0*count(distinct gene_id) as double)/nullif((select count(distinct gene_id) from tr), 0), 1), 0.0) genes_pct,
  count(distinct transcript_id) transcripts, coalesce(round(cast(100.0*count(distinct transcript_id) as double)/nullif((select count(*) from tr), 0), 1), 0.0) transcripts_pct
  from (select unnest(['unstranded', 'intronic', 'monoexonic_redundant', 'monoexonic_antisense']) category) left join oc using (category) group by 1"""
    ).removeprefix("with "),
    "run_metrics": run_metrics(),
    "kept_up_winners": "select transcript_id from (" + SQL["redundancy_labels"] + ") where label in ('accepted', 'subset')",
    "sj_counts": "select sj, concat_ws(',', sample0, sample1, sample2) reads from (" + SQL["sj_matrix"] + ")",
    "deep_fragments": _q("select transcript_id, label from f", fragments("f", "tr"), base=shaped("deep")),
    "deep_structural": _q(LABELS, *STRUCTURAL, base=shaped("deep")),
    "deep_chimeric": _q("select transcript_id, label from ca", chimeric("ca", "tr"), base=shaped("deep")),
    "deep_intronic": _q("select transcript_id from i", islands("og", "tr"), intronic("i", "og"), base=shaped("deep")),
    "flat_structural": _q(LABELS, *STRUCTURAL, base=shaped("flat")),
    "flat_location": _q(LOCATION_LABELS, *LOCATION, base=shaped("flat")),
}
