"""DuckDB SQL that states the queries over again, on its own terms: plain windows and nested queries over the driver's tables."""

KEYS = """
l as (select l_orderkey k, count(*) c from lineitem group by l_orderkey),
t0 as (select k, k%5 ch, cast(floor(k/5) as bigint)%2 sd, cast(floor(k/60) as bigint) locus, k%3 off,
  case when k%53=0 then greatest(c,14) else c end n from l),
px as (select k, n, v.i, concat('chr',cast(ch as varchar)) seqname, case when k%41=0 then '.' when sd=0 then '+' else '-' end strand,
  concat('G',lpad(cast(locus*10+ch*2+sd as varchar),9,'0')) gene_id, concat('T',lpad(cast(k as varchar),9,'0')) transcript_id,
  cast(locus*1000+(off+v.i)*100+1-(case when v.i=1 and k%4=0 then 10 else 0 end) as bigint) s,
  cast(locus*1000+(off+v.i)*100+40+(case when v.i=n and k%7=0 then 15 else 0 end) as bigint) e
  from t0 join range(1, (select max(n) from t0)+1) v(i) on v.i<=n),"""
MODEL = """
intr as (select * from (select seqname, strand, gene_id, transcript_id, e+1 s, lead(s) over (partition by transcript_id order by s,e)-1 e from ex) where e is not null),
tr as (select seqname, strand, gene_id, transcript_id, min(s) s, max(e) e, max(e)-min(s)+1 len, count(*) nx,
  min_by(e, s) fe, max(s) ls from ex group by all),
ch as (select transcript_id, string_agg(concat(s,'-',e), ',' order by s) chain, min(s) ism, max(e) iem from intr group by 1)
"""
BASE = KEYS + "\nex as (select seqname, strand, gene_id, transcript_id, s, e from px)," + MODEL

# overlap of (s1, e1) and (s2, e2) in the sense of a ratio above 0
def _ov(a: str, b: str, c: str, d: str) -> str:
    return f"({a} <= {d} and {c} <= {b} and greatest({b}-{a}, {d}-{c}) > 0)"


def islands(name: str, source: str, keys: str = "seqname, strand") -> str:
    return f"""
{name}_f as (select *, case when s <= max(e) over (partition by {keys} order by s, transcript_id rows between unbounded preceding and 1 preceding) then 0 else 1 end f from {source}),
{name} as (select * exclude f, max(case when f=1 then s end) over (partition by {keys} order by s, transcript_id rows unbounded preceding) locus from {name}_f)"""


def refined(name: str, source: str, keys: str = "seqname, strand") -> str:
    return f"""{islands(name + "_i", source, keys)},
{name}_p as (select *, lag(ls) over w ps, lag(e) over w pe from {name}_i window w as (partition by {keys}, locus order by s, e, transcript_id)),
{name} as (select * exclude (ps, pe), cast(sum(case when s <= pe and pe <= fe and ps < s and pe - s + 1 > 0 and greatest(pe-ps, fe-s) > 0
  and (pe - s + 1) / greatest(pe-ps, fe-s) < 0.25 then 1 else 0 end) over (partition by {keys}, locus order by s, e, transcript_id rows unbounded preceding) as bigint) part from {name}_p)"""


def consensus(name: str, source: str, keys: str = "seqname, strand, locus") -> str:
    on = " and ".join(f"a.{k}=b.{k}" for k in keys.split(", "))
    cols = ", ".join(f"a.{k}" for k in keys.split(", "))
    return f"""
{name}_e as (select {cols}, a.transcript_id a, list_sort(list(b.transcript_id)) m from {source} a join {source} b on {on}
  and (a.transcript_id = b.transcript_id or ({_ov("a.s", "a.fe", "b.s", "b.fe")} and {_ov("a.ls", "a.e", "b.ls", "b.e")})) group by all),
{name}_t as (select {keys}, unnest(m) t, m from (select distinct {keys}, m from {name}_e)),
{name}_r as (select *, row_number() over (partition by {keys}, t order by len(m) desc, m[1] desc, m asc) r from {name}_t),
{name} as (select {keys}, t transcript_id, min(t) over (partition by {keys}, m) consensus from {name}_r where r=1)"""


def intronic(name: str, source: str, keys: str = "seqname, strand, locus") -> str:
    on = " and ".join(f"a.{k}=b.{k}" for k in keys.split(", "))
    return f"""
{name}_n as (select *, count(*) over (partition by {keys}) gn from {source}),
{name} as (select a.transcript_id from {name}_n a where a.nx=1 and a.gn>1 and not exists (select 1 from {name}_n b join ex x on x.transcript_id=b.transcript_id
  where {on} and b.nx>1 and {_ov("a.s", "a.e", "x.s", "x.e")}))"""


def fragments(name: str, source: str, ratio: str = "0.7") -> str:
    """Labels of all transcripts of ``source``."""
    return f"""{islands(name + "_o", source)},
{name}_l as (select *, len / max(len) over (partition by seqname, strand, locus) >= {ratio} lng from {name}_o),
{consensus(name + "_c", name + "_l", "seqname, strand, locus, lng")},
{name}_j as (select l.*, c.consensus, count(*) over (partition by l.seqname, l.strand, l.locus, l.lng, c.consensus) cn, sum(cast(l.lng as int)) over (partition by l.seqname, l.strand, l.locus) acc
  from {name}_l l join {name}_c c using (seqname, strand, locus, lng, transcript_id)),
{name}_u as (select *, not lng and cn>3 and cn>acc un from {name}_j),
{name}_v as (select *, sum(cast(un as int)) over (partition by seqname, strand, locus) us from {name}_u),
{name}_w as (select *, lng and us>3 and cn<3 and cn<us ov from {name}_v),
{name}_x as (select *, max(cast(ov as int)) over (partition by seqname, strand, locus) anyov from {name}_w),
{name}_q as (select seqname, strand, locus whole, transcript_id, s, e, len from {name}_x where anyov=1 and not ov),
{islands(name + "_q2", name + "_q", "seqname, strand, whole")},
{name}_b as (select seqname, strand, whole, locus, row_number() over (partition by seqname, strand, whole order by max(len) desc, locus desc) r, count(*) over (partition by seqname, strand, whole) n from {name}_q2 group by seqname, strand, whole, locus),
{name}_sp as (select transcript_id from {name}_q2 join {name}_b using (seqname, strand, whole, locus) where r=1 and n>1),
{intronic(name + "_in", name + "_o")},
{name} as (select transcript_id, case when ov then 'overextended' when un then 'uniform' when not lng and transcript_id not in (select transcript_id from {name}_in)
  and transcript_id not in (select transcript_id from {name}_sp) then 'fragment' else 'accepted' end label from {name}_x)"""


def chimeric(name: str, source: str) -> str:
    return f"""{islands(name + "_o", source)},
{consensus(name + "_c", name + "_o")},
{name}_g as (select o.*, c.consensus from {name}_o o join {name}_c c using (seqname, strand, locus, transcript_id)),
{name}_b0 as (select g.seqname, g.strand, g.locus, g.consensus, g.nx, g.s xs, g.e xe, coalesce(h.ism, g.s) ints, coalesce(h.iem, g.e) inte, count(*) over (partition by g.seqname, g.strand, g.locus, g.consensus) n,
  row_number() over (partition by g.seqname, g.strand, g.locus, g.consensus order by g.len desc, g.transcript_id) r from {name}_g g left join ch h using (transcript_id)),
{name}_b as (select * from {name}_b0 where r=1 and not (n=1 and nx=1)),
{name}_s0 as (select c.seqname, c.strand, c.locus, c.consensus c, a.consensus a, b.consensus b, a.n+b.n > c.n+1 fails from {name}_b a join {name}_b b using (seqname, strand, locus) join {name}_b c using (seqname, strand, locus)
  where (a.n > b.n or (a.n = b.n and a.consensus > b.consensus)) and not {_ov("a.xs", "a.xe", "b.ints", "b.inte")} and not {_ov("a.ints", "a.inte", "b.xs", "b.xe")}
  and c.consensus <> a.consensus and c.consensus <> b.consensus and {_ov("c.xs", "c.xe", "a.xs", "a.xe")} and {_ov("c.xs", "c.xe", "b.xs", "b.xe")}),
{name}_s as (select *, min(case when fails then a || ' ' || b end) over (partition by seqname, strand, locus, c) fp from {name}_s0),
{name}_seg as (select distinct seqname, strand, locus, unnest([a, b]) consensus from {name}_s where fp is null or a || ' ' || b < fp),
{name}_acc as (select distinct seqname, strand, locus, c consensus from {name}_s where fp is null),
{name}_fl as (select distinct seqname, strand, locus, c, fp from {name}_s where fp is not null),
{name}_rej as (select seqname, strand, locus, c consensus from {name}_fl f where not exists (select 1 from {name}_fl g where g.seqname=f.seqname and g.strand=f.strand and g.locus=f.locus and g.c > f.c and contains(' ' || g.fp || ' ', ' ' || f.c || ' '))),
{intronic(name + "_in", name + "_o")},
{name} as (select distinct transcript_id, label from {name}_g g join (select *, 'rejected_segment' label from {name}_seg union all select *, 'accepted_overlap' from {name}_acc union all select *, 'rejected_overlap' from {name}_rej) x using (seqname, strand, locus, consensus)
  where label <> 'rejected_segment' or transcript_id not in (select transcript_id from {name}_in))"""


def _q(select: str, *ctes: str, base: str = BASE) -> str:
    return "with " + ",\n".join(c.strip().strip(",") for c in (base, *ctes)) + "\n" + select


KEPT = """
q1 as (select t.*, row_number() over (partition by chain order by len desc, transcript_id desc) = 1 kept from tr t join ch using (transcript_id)),
k1 as (select * exclude kept from q1 where kept)"""
SUBSET = islands("kg", "k1") + """,
sub as (select distinct a.transcript_id from kg a join ch ca using (transcript_id) join kg b on a.seqname=b.seqname and a.strand=b.strand and a.locus=b.locus and a.transcript_id<>b.transcript_id join ch cb on cb.transcript_id=b.transcript_id
  where ca.chain <> cb.chain and contains(',' || cb.chain || ',', ',' || ca.chain || ',')
  and exists (select 1 from ex x where x.transcript_id=b.transcript_id and (x.s = ca.ism-1 or x.e = ca.ism-1) and a.s between x.s and x.e)
  and exists (select 1 from ex x where x.transcript_id=b.transcript_id and (x.s = ca.iem+1 or x.e = ca.iem+1) and a.e between x.s and x.e))"""
MONO = "mono as (select * from tr where nx=1)," + islands("mg", "mono") + ",\nq2 as (select *, row_number() over (partition by seqname, strand, locus order by len desc, transcript_id desc)=1 kept from mg)"
SJ = """
sj as (select distinct seqname, strand, s, e, concat('sample', f.f) sample, (cast(floor(s/100) as bigint)+f.f)%7 motif, (cast(floor(s/100) as bigint)*3+f.f*5)%6 n_unique,
  5+(cast(floor(s/100) as bigint)*7+f.f*11)%40 overhang from intr cross join (values (0),(1),(2)) f(f)),
us as (select *, motif between 1 and 6 canonical from sj where overhang >= 10)"""
QUANT = "qu as (select concat('T',lpad(cast(o_orderkey as varchar),9,'0')) transcript_id, cast(((o_orderkey*7+f.f*13)%40) as double)/10 tpm from orders cross join (values (0),(1),(2)) f(f))"


def _support(reads: int, samples: int) -> str:
    return f"su as (select seqname, strand, s, e, count(*) filter (canonical and n_unique >= {reads}) met, bool_or(not canonical) non_canonical from us group by all),\nsup as (select * from su where met >= {samples})"


LONE = "o as (select * from tr)," + islands("og", "o") + ",\nlm as (select * from (select *, count(*) over (partition by seqname, strand, locus) n from og) where n=1 and nx=1)"


def antisense(name: str, source: str) -> str:
    return f"""
{islands(name + "_i", source)},
{name}_m as (select * from (select *, count(*) over (partition by seqname, strand, locus) n from {name}_i) where n=1 and nx=1),
{name}_gb as (select gene_id, min(s) gs, max(e) ge from tr group by 1),
{name}_pl as (select distinct seqname, strand, gene_id, gs, ge from tr join {name}_gb using (gene_id)),
{name}_h as (select m.transcript_id, p.seqname, p.strand, p.gs, p.ge from {name}_m m join (select distinct seqname, strand, gs, ge from {name}_pl p where exists (select 1 from {source} z where z.seqname=p.seqname and z.strand=p.strand)) p on m.seqname=p.seqname and m.strand<>p.strand
  and (m.s between p.gs and p.ge or m.e between p.gs and p.ge)),
{name}_one as (select p.seqname, p.strand, gs, ge, min(transcript_id) transcript_id from {name}_pl p join tr using (seqname, strand, gene_id) group by 1,2,3,4 having count(distinct transcript_id)=1 and max(nx)=1),
{name} as (select transcript_id from {name}_h union select o.transcript_id from {name}_one o join {name}_h h using (seqname, strand, gs, ge))"""


def antifrag(name: str, wanted: str, ratio: str) -> str:
    return f"""{refined(name + "_g", "tr", "seqname")},
{name}_w as (select *, min(s) over w lft, max(e) over w rgt, count(*) over w n, max(case when transcript_id in (select transcript_id from {wanted}) then 1 else 0 end) over w hit from {name}_g window w as (partition by seqname, locus, part)),
{name}_t as (select *, first(transcript_id) over w tid, first(len) over w tlen, first(strand) over w tst from {name}_w where n>1 and hit=1 window w as (partition by seqname, lft, rgt order by len desc, transcript_id)),
{name} as (select transcript_id, len, tlen longest_len, case when len/tlen <= {ratio} and transcript_id<>tid then case when strand<>tst then 'antisense_fragment' else 'monoexon_fragment' end end label from {name}_t where nx=1)"""


STRANDED = "st as (select * from tr where strand in ('+','-'))"
KIND = "kd as (select gene_id, count(*) isoforms, case when count(*)>1 then 'multi_isoform' when max(nx)>1 then 'single_multiexonic' else 'single_monoexonic' end kind from tr group by 1)"
LENGTHS = """
ln as (select 'transcripts' category, len as value from tr union all select 'cds', 0 from tr union all select 'monoexonic_genes', len from tr join kd using (gene_id) where kind='single_monoexonic'
  union all select 'exons', e-s+1 from ex union all select 'introns', e-s+1 from intr)"""


def _percentiles(source: str, key: str, points: str) -> str:
    return f"""
so as (select {key}, value, row_number() over (partition by {key} order by value)-1 i, count(*) over (partition by {key}) n from {source}),
pc as (select {key}, cast(p.p as bigint) percentile, value from so join (select unnest([{points}]) p) p on i = least(cast(floor(p.p*n/100) as bigint), n-1))"""


POINTS = "0,1,5,10,15,20,25,30,35,40,45,50,55,60,65,70,75,80,85,90,95,99,100"
UNI = islands("ug", "tr") + "," + consensus("uc", "ug") + ",\nuni as (select transcript_id from (select *, min(consensus) over w = max(consensus) over w one from uc window w as (partition by seqname, strand, locus)) where one),\nnuni as (select * from tr where transcript_id not in (select transcript_id from uni))"
SEG = islands("sg", "nuni") + "," + consensus("sc", "sg") + f""",
sr as (select g.seqname, g.strand, g.locus, c.consensus, g.s, g.e, row_number() over (partition by g.seqname, g.strand, g.locus, c.consensus order by g.len desc, g.transcript_id) r from sg g join sc c using (seqname, strand, locus, transcript_id)),
ap as (select distinct a.seqname, a.strand, a.locus from sr a join sr b using (seqname, strand, locus) where a.r=1 and b.r=1 and a.consensus<b.consensus and not {_ov("a.s", "a.e", "b.s", "b.e")}),
seg as (select transcript_id, p.locus is not null segmented from sg left join ap p using (seqname, strand, locus))"""


def _where(name: str, source: str, condition: str) -> str:
    return f"{name} as (select * from {source} where {condition})"


def _in(ids: str, label: str | None = None) -> str:
    return f"transcript_id in (select transcript_id from {ids}" + (f" where label='{label}')" if label else ")")


STRUCTURAL = (
    UNI, SEG,
    "ovl as (select * from tr where transcript_id in (select transcript_id from seg where segmented))",
    "flt as (select * from tr where transcript_id in (select transcript_id from seg where not segmented))",
    "o1s as (select * from ovl union all select * from tr where not exists (select 1 from ovl))",
    chimeric("oa", "o1s"),
    _where("f1s", "tr", "not " + _in("oa", "rejected_overlap")), fragments("f1", "f1s"),
    fragments("f2", "flt"),
    _where("f3s", "tr", _in("oa", "accepted_overlap")), fragments("f3", "f3s"),
    _where("f4s", "tr", _in("oa", "rejected_overlap")), fragments("f4", "f4s"),
    _where("f5s", "tr", _in("oa", "rejected_segment")), fragments("f5", "f5s"),
    "fa as (select transcript_id from (select * from f1 union all select * from f2 union all select * from f3 union all select * from f4 union all select * from f5) where label='fragment')",
    _where("o2l", "ovl", "not " + _in("fa")),
    "o2s as (select * from o2l union all select * from tr where not exists (select 1 from o2l))", chimeric("ob", "o2s"),
    _where("f6s", "tr", "not " + _in("uni") + " and not " + _in("ob", "rejected_overlap") + " and not " + _in("ob", "rejected_segment") + " and not " + _in("fa")), fragments("f6", "f6s"),
    "fb as (select transcript_id from fa union select transcript_id from f6 where label='fragment')",
    f"ro as (select distinct transcript_id from ob where label='rejected_overlap' and not {_in('ob', 'rejected_segment')} and not {_in('fb')})",
    f"rs as (select distinct transcript_id from ob where label='rejected_segment' and not {_in('ro')} and not {_in('fb')})",
    islands("ai", "tr"), intronic("ain", "ai"),
    f"fr as (select transcript_id from fb union select transcript_id from ain union select transcript_id from f1 where label='uniform')",
)
LABELS = f"select transcript_id, case when {_in('rs')} then 'rejected_segment' when {_in('ro')} then 'rejected_overlap' when {_in('fr')} then 'fragment' else 'accepted' end label from tr"
CHIM = (UNI, chimeric("oc", "nuni"))


def _genes(ids: str) -> str:
    return f"select gene_id, count(distinct transcript_id) n, string_agg(distinct transcript_id, ';' order by transcript_id) transcripts from tr where {ids} group by 1"


RENAMED = (
    refined("rg", "tr"),
    "gs as (select *, min(s) over (partition by seqname, strand, locus, part) gst from rg)",
    """nn as (select *, dense_rank() over (partition by seqname order by gst, case strand when '+' then 0 when '-' then 1 else 2 end, part) n,
  'NEW_' || seqname || 'G' || printf('%06d', 10*dense_rank() over (partition by seqname order by gst, case strand when '+' then 0 when '-' then 1 else 2 end, part)) ggid from gs)""",
)
NEW_IDS = """select transcript_id, gene_id, ggid group_gene_id, ggid || '.RTD.' || row_number() over (partition by seqname, strand, locus, part order by s, e, transcript_id) new_transcript_id,
  first(ggid) over (partition by gene_id order by seqname, n) new_gene_id from nn"""
PADDED = (
    refined("rg", "tr"),
    "pg as (select transcript_id, s, e, min(s) over w l, max(e) over w r from rg window w as (partition by seqname, strand, locus, part))",
    "pe as (select x.transcript_id, case when x.s=g.s then l else x.s end s, case when x.e=g.e then r else x.e end e from ex x join pg g using (transcript_id))",
)
_PCT = "coalesce(round(cast(100.0*{} as double)/nullif({},0), 1), 0.0)"

SQL: dict[str, str] = {
    "intron_chains": _q("select transcript_id, chain from ch"),
    "transcript_model": _q("select seqname, strand, gene_id, transcript_id, s, e, len, cast(nx as bigint) n_exons from tr"),
    "gene_bounds": _q("select gene_id, min(s) s, max(e) e from tr group by 1"),
    "nonredundant_identical": _q("select seqname, strand, transcript_id, s, e from q1 where kept", KEPT),
    "redundant_subset": _q("select transcript_id from sub", KEPT, SUBSET),
    "monoexon_redundant": _q("select transcript_id from q2 where not kept", MONO),
    "redundancy_labels": _q("select transcript_id, case when not kept then 'identical' when transcript_id in (select transcript_id from sub) then 'subset' else 'accepted' end label from q1 union all select transcript_id, case when kept then 'accepted' else 'monoexon' end from q2", KEPT, SUBSET, MONO),
    "overlap_groups": _q("select seqname, strand, locus, transcript_id from og", islands("og", "tr")),
    "refined_groups": _q("select seqname, strand, locus, part, transcript_id from rg", refined("rg", "tr")),
    "consensus_groups": _q("select seqname, strand, locus, transcript_id, consensus from cg", islands("og", "tr"), consensus("cg", "og")),
    "group_boundaries": _q("select seqname, strand, locus, consensus, n, xs, xe, ints, inte from cx_b0 where r=1", chimeric("cx", "tr")),
    "cross_strand_groups": _q("select seqname, lft, rgt, transcript_id from af_w where n>1 and hit=1", antisense("an", "tr"), antifrag("af", "an", "0.5")),
    "lone_monoexons": _q("select transcript_id from lm", LONE),
    "unstranded": _q("select transcript_id from tr where strand not in ('+','-')"),
    "unknown_seqname": _q("select transcript_id from tr where seqname not in ('chr0','chr1','chr2','chr3')"),
    "monoexon_antisense": _q("select transcript_id from an", STRANDED, antisense("an", "st")),
    "antisense_fragments": _q("select transcript_id, len, longest_len, label from af", STRANDED, antisense("an", "st"), antifrag("af", "an", "0.5")),
    "location_labels": _q("""select transcript_id, case when strand not in ('+','-') then 'unstranded' when seqname='chr4' then 'unknown_seqname'
  else coalesce((select min(label) from af where af.transcript_id=tr.transcript_id), 'accepted') end label from tr""", STRANDED, antisense("an", "st"), antifrag("af", "an", "0.5")),
    "sj_supported": _q("select seqname, strand, s, e, met from sup", SJ, _support(2, 1)),
    "sj_rejected": _q("select seqname, strand, s, e, met, non_canonical, met>0 and met<2 low_reads from su where non_canonical or (met>0 and met<2)", SJ, _support(4, 2)),
    "sj_matrix": _q("select seqname || strand || ':' || s || '-' || e sj, cast(coalesce(sum(n_unique) filter (sample='sample0'),0) as bigint) sample0, cast(coalesce(sum(n_unique) filter (sample='sample1'),0) as bigint) sample1, cast(coalesce(sum(n_unique) filter (sample='sample2'),0) as bigint) sample2 from us where canonical group by 1", SJ),
    "transcripts_sj_supported": _q("select transcript_id from tr where not exists (select 1 from intr i where i.transcript_id=tr.transcript_id and not exists (select 1 from sup where sup.seqname=i.seqname and sup.strand=i.strand and sup.s=i.s and sup.e=i.e))", SJ, _support(4, 2)),
    "abundant": _q("select transcript_id, count(*) filter (tpm>=1) met from qu group by 1 having count(*) filter (tpm>=1) >= 3", QUANT),
    "abundance_labels": _q("select transcript_id, case when met is null then 'missing' when met>=3 then 'abundant' else 'low' end label from tr left join (select transcript_id, count(*) filter (tpm>=1) met from qu group by 1) using (transcript_id)", QUANT),
    "intronic": _q("select transcript_id from i", islands("og", "tr"), intronic("i", "og")),
    "uniform_consensus": _q("select transcript_id from uni", UNI),
    "segmented_groups": _q("select transcript_id, segmented from seg", UNI, SEG),
    "chimeric": _q("select transcript_id, label from ca", UNI, SEG, "ovl as (select * from tr where transcript_id in (select transcript_id from seg where segmented))", chimeric("ca", "ovl")),
    "fragments": _q("select transcript_id, label from f", fragments("f", "tr")),
    "structural_labels": _q(LABELS, *STRUCTURAL),
    "reannotate_ids": _q(NEW_IDS, *RENAMED),
    "padded_exons": _q("select transcript_id, s, e from pe", *PADDED),
    "scaffold_counts": _q(f"""select coalesce(seqname,'') || strand scaffold, count(distinct gene_id) genes, {_PCT.format("count(distinct gene_id)", "(select count(distinct gene_id) from tr)")} genes_pct, count(*) transcripts, {_PCT.format("count(*)", "(select count(*) from tr)")} transcripts_pct
  from tr group by grouping sets ((seqname, strand), (strand))"""),
    "gene_categories": _q("select coalesce(kind,'total') kind, count(*) genes, cast(sum(isoforms) as bigint) transcripts from kd group by rollup (kind)", KIND),
    "isoform_histogram": _q("select isoforms, count(*) genes from kd group by 1", KIND),
    "length_histogram": _q("select cast(floor(len/100)*100 as bigint) as value, count(*) n from tr group by 1"),
    "length_percentiles": _q("select category, percentile, value from pc", KIND, LENGTHS, _percentiles("ln", "category", POINTS)),
    "length_outliers": _q("""select category, transcript_id, case when lo<=p1 then lo else hi end as value from
  (select 'transcripts' category, transcript_id, len lo, len hi from tr union all select 'monoexonic_genes', transcript_id, len, len from tr join kd using (gene_id) where kind='single_monoexonic'
   union all select 'exons', transcript_id, min(e-s+1), max(e-s+1) from ex group by 2 union all select 'introns', transcript_id, min(e-s+1), max(e-s+1) from intr group by 2) x
  join (select category, max(value) filter (percentile=1) p1, max(value) filter (percentile=99) p99 from pc group by 1) q using (category) where lo<=p1 or hi>=p99""", KIND, LENGTHS, _percentiles("ln", "category", "1,99")),
    "potentially_chimeric": _q(_genes("transcript_id in (select transcript_id from oc where label<>'rejected_segment')"), *CHIM),
    "potentially_split": _q(_genes("transcript_id in (select transcript_id from oc where label='rejected_segment')"), *CHIM),
    "potentially_fragmented": _q(_genes("transcript_id in (select g.transcript_id from pg g join pm using (seqname, strand, locus))"), "pt as (select * from tr where nx>1)", islands("pg", "pt"), consensus("pcn", "pg"),
        "pm as (select seqname, strand, locus from pcn group by 1,2,3 having count(*)>2 and count(distinct consensus)>1 and count(distinct consensus)/count(*) >= 0.7)"),
    "other_categories": _q("""select 'unstranded' category, transcript_id, gene_id from tr where strand not in ('+','-')
  union all select case when alln>own then 'intronic' else 'monoexonic_redundant' end, transcript_id, gene_id from lo where alln>own or r>1
  union all select 'monoexonic_antisense', transcript_id, gene_id from tr where transcript_id in (select transcript_id from af where label='antisense_fragment')""", islands("og", "tr"), intronic("i", "og"),
        "lo as (select transcript_id, gene_id, count(*) over (partition by seqname, strand, locus, gene_id) own, (select count(*) from tr z where z.gene_id=og.gene_id) alln, row_number() over (partition by seqname, strand, locus order by len desc, transcript_id) r from og where transcript_id in (select transcript_id from i))",
        antisense("an", "tr"), antifrag("af", "an", "1.0")),
    "splice_junctions": _q("select seqname || strand scaffold, transcript_id, chain junctions from tr join ch using (transcript_id)"),
    "sj_percentiles": _q("select sample, percentile, value from pc", SJ, "sv as (select sample, n_unique as value from us where canonical)", _percentiles("sv", "sample", POINTS)),
    "id_mapping": _q("select transcript_id TXNAME, gene_id GENEID from tr"),
}
