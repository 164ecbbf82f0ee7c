"""Mixing sources to target weights, in DataFrame operations only.

A source's documents are taken whole as often as its target allows; of the rest
of the target, documents are taken whose hash lies under a threshold. The
threshold is found by histograms of words by source and hash prefix: the bucket
in which the budget ends is refined, the others never again, until single hash
values remain. Nothing is sorted and no document is moved.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .scratch import Scratch, fresh

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
CAP = 3
SHIFTS = (22, 12, 0)  # of the 32-bit hash, from coarse to single values


def size_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def hash_of(doc_id: Column) -> Column:
    """32 bits of the MD5 of the doc_id as text; of the empty text for null."""
    return F.conv(F.substring(F.md5(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), 1, 8), 16, 10).cast("long")


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """``source, source_size`` gets ``target``: shares by weight, none above ``cap`` times its size, the excess reshared.

    One row a source: the rank by code point needs them in one order. Sums of
    the whole table, three numbers, reach the driver each round; a round caps at least one more source.
    """
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (rank % len(weights)).cast("int") + 1).cast("long")
    ranked = sources.withColumn("weight", weight)
    level, capped = None, F.lit(False)
    while True:
        row = ranked.agg(
            F.sum("source_size").alias("all"), F.sum(F.when(capped, F.col("source_size") * cap)).alias("full"), F.sum(F.when(~capped, F.col("weight"))).alias("open")
        ).first()
        budget, open_ = (row["all"] or 0) - (row["full"] or 0), row["open"]
        if not open_ or (budget, open_) == level:
            break
        level = (budget, open_)
        capped = F.col("weight") * (F.lit(float(budget)) / F.lit(float(open_))) > F.col("source_size") * cap
    each = F.lit(0.0) if level is None else F.lit(float(level[0])) / F.lit(float(level[1]))
    return ranked.withColumn("target", F.when(capped, (F.col("source_size") * cap).cast("double")).otherwise(F.col("weight") * each))


def thresholds(spark: SparkSession, docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """A row a source: ``source, source_size, target``, whole ``rounds``, and the hash ``below`` (or at, if ``at``) which documents are taken once more."""
    s = Scratch(spark, "mixing")
    sized = s.save(docs.select("source", size_of(F.col("text")).alias("size"), hash_of(F.col("doc_id")).alias("u")), "sized")
    sources = s.save(sized.groupBy("source").agg(F.sum("size").alias("source_size")), "sources")
    plan = targets(sources, weights, cap)
    rounds = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    state = plan.withColumn("rounds", rounds.cast("long")).withColumn("rest", F.col("target") - F.col("rounds") * F.col("source_size"))
    state = s.save(state.withColumns({"prefix": F.lit(0).cast("long"), "base": F.lit(0).cast("long"), "after": F.lit(0).cast("long")}), "state")
    above = 32
    for shift in SHIFTS:
        here = sized.alias("d").join(state.select("source", "prefix").alias("s"), F.expr("d.source <=> s.source")).where(F.shiftright("u", above) == F.col("prefix"))
        hist = here.groupBy(F.col("d.source").alias("own"), F.shiftright("u", shift).alias("bucket")).agg(F.sum("size").alias("words"))
        up_to = F.sum("words").over(Window.partitionBy("own").orderBy("bucket"))
        hist = hist.withColumn("up_to", up_to)
        both = state.join(hist, F.expr("source <=> own"), "left").where("own is null and bucket is null or base + up_to > rest")
        first = both.groupBy("source").agg(F.min_by(F.struct("bucket", (F.col("base") + F.col("up_to") - F.col("words")).alias("base"), (F.col("base") + F.col("up_to")).alias("after")), "bucket").alias("x"))
        state = s.save(
            state.drop("prefix", "base", "after").alias("s").join(first.withColumnRenamed("source", "own"), F.expr("source <=> own"), "left").select("s.*", F.col("x.bucket").alias("prefix"), F.col("x.base").alias("base"), F.col("x.after").alias("after")),
            f"state{shift}",
        )
        above = shift
    near = (F.col("after") - F.col("rest")) < (F.col("rest") - F.col("base"))
    return s.save(
        state.select("source", "source_size", "target", "rounds", F.coalesce("prefix", F.lit(-1)).cast("long").alias("below"), F.coalesce(near, F.lit(False)).alias("at")), "thresholds"
    )


def mix(spark: SparkSession, docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """All columns of ``docs`` and ``size, source_size, target, taken, copies`` (what the mix takes of a document: words, and how often).

    Needs ``doc_id, text, source``. A null text has size 0 as an empty one has, a text of any
    length is counted whole; a null source is a source of its own, last in order. Documents with
    equal doc_id share a hash and are taken together; null ids likewise. The taken words of a
    source miss its target by half the words of one hash value at most. Repeated rows count each.
    An empty table gives no rows. Columns named like the added ones are replaced, all others stay,
    whatever their names. The table of sources is joined as Spark sees fit: its measured size
    decides on a broadcast.
    """
    added = ("size", "source_size", "target", "taken", "copies")
    docs = docs.drop(*added)
    u, *names = fresh(docs, *added, "hash", "of_source", "rounds", "below", "at")[len(added) :]
    of, rounds, below, at = map(F.col, names)
    limit = thresholds(spark, docs, weights, cap)
    limit = limit.select(limit.source.alias(names[0]), "source_size", "target", *[limit[c].alias(n) for c, n in zip(("rounds", "below", "at"), names[1:], strict=True)])
    own = docs.withColumns({"size": size_of(F.col("text")), u: hash_of(F.col("doc_id"))})
    once = (F.col(u) < below) | (at & (F.col(u) == below))
    joined = own.join(limit, F.col("source").eqNullSafe(of)).withColumn("copies", rounds + once.cast("long"))
    return joined.withColumn("taken", F.col("size") * F.col("copies")).select(*[F.col(f"`{c}`") for c in docs.columns], *added)


#: The same mix by sorting: targets from the order in which sources fill up, thresholds from running sums over all hashes.
ORACLE_SQL = r"""
with d as (select doc_id, source, cast(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) as bigint) size,
  ('0x' || substr(md5(coalesce(cast(doc_id as varchar), '')), 1, 8))::bigint u from documents),
s as (select source, cast(sum(size) as bigint) n from d group by 1),
w as (select *, case (row_number() over (order by source nulls last) - 1) % 3 when 0 then 5 when 1 then 2 else 1 end w from s),
o as (select *, row_number() over (order by 3.0 * n / w, source) k from w),
c as (select *, (select sum(n) from w) - coalesce(sum(3 * n) over (order by k rows between unbounded preceding and 1 preceding), 0) budget, sum(w) over (order by k rows between current row and unbounded following) left_w from o),
x as (select min(k) k from c where w * (cast(budget as double) / left_w) <= 3 * n),
t as (select o.*, case when o.k < x.k then cast(3 * o.n as double) else o.w * (select cast(budget as double) / left_w from c where c.k = x.k) end target from o, x),
r as (select *, case when n > 0 then floor(target / n) else 0 end rounds from t),
h as (select source, u, sum(size) words from d group by 1, 2),
m as (select *, sum(words) over (partition by source order by u) up_to from h),
b as (select m.source, min(u) edge from m join r on m.source is not distinct from r.source where up_to > target - rounds * n group by 1),
e as (select b.source, b.edge, m.up_to - (r.target - r.rounds * r.n) < (r.target - r.rounds * r.n) - (m.up_to - m.words) near from b join m on b.source is not distinct from m.source and b.edge = m.u join r on r.source is not distinct from b.source)
select doc_id, size, r.n source_size, r.target, cast(size * (r.rounds + case when d.u < e.edge or d.u = e.edge and e.near then 1 else 0 end) as bigint) taken
from d join r on d.source is not distinct from r.source left join e on d.source is not distinct from e.source
"""
