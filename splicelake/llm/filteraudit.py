"""Filter interaction audit: what each filter removes, and at whose cost, in every order of filters.

A document fails or passes each filter alone, so the order decides only which filter
gets the blame. ``CUBE`` over the failure flags and the part counts documents for every
subset of flags; the row of a subset whose flags are all false counts what survives it.
A step of an order goes from one subset to the next: two survivors' rows, joined, give all of its figures.
"""

from __future__ import annotations

from itertools import permutations
from math import factorial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import Scratch

WORD = r"[^\x20\x09-\x0D]+"
MIN_WORDS, MIN_DISTINCT, MAX_CAPITALS, SIGNS = 200, 50, 3, "[#$%&*|]"
FILTERS = "ABCDE"
COUNTS = ("docs", "good", "toxic")


def flagged(docs: DataFrame) -> DataFrame:
    """``doc_id, part, twin, A, B, C, D`` of every row; ``twin`` is the digest of the whole text."""
    text = F.coalesce("text", F.lit(""))
    held = docs.select("doc_id", F.coalesce("lang", F.lit("")).alias("part"), text.alias("text"))
    held = held.select("doc_id", "part", "text", F.regexp_extract_all("text", F.lit(WORD), F.lit(0)).alias("words"))
    words, distinct = F.size("words"), F.size(F.array_distinct("words"))
    capitals = F.length("text") - F.length(F.regexp_replace("text", "[A-Z]", ""))
    return held.select(
        "doc_id",
        "part",
        F.sha2("text", 256).alias("twin"),
        (words < MIN_WORDS).alias("A"),
        (100 * distinct < MIN_DISTINCT * words).alias("B"),
        (100 * capitals > MAX_CAPITALS * F.length("text")).alias("C"),
        F.regexp_like("text", F.lit(SIGNS)).alias("D"),
    )


def tallies(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``part, A, B, C, D, E, docs, good, toxic``: one row for each mix of flags in a part.

    Rows are counted where they are read before they meet by text: equal rows, of however many copies,
    travel once. The first of a text is found by a partial minimum and met by text and id, so a text that
    a third of all documents share isn't one task's; null ids meet no label and are dealt by text.
    """
    rows = flagged(docs).groupBy("doc_id", "twin", "part", "A", "B", "C", "D").agg(F.count("*").alias("docs"))
    firsts = rows.groupBy("twin").agg(F.min("doc_id").alias("doc_id")).where("doc_id is not null").withColumn("first", F.lit(True))
    marks = labels.where("doc_id is not null").groupBy("doc_id").agg(F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    marks = marks.withColumn("dealt", F.lit(""))
    met = rows.join(firsts, ["twin", "doc_id"], "left").withColumn("E", F.col("doc_id").isNotNull() & F.col("first").isNull())
    met = met.withColumn("dealt", F.when(F.col("doc_id").isNull(), F.col("twin")).otherwise("")).join(marks, ["doc_id", "dealt"], "left")
    of = lambda mark: F.coalesce(F.sum(F.col("docs") * F.coalesce(mark, F.lit(0))), F.lit(0))
    return met.groupBy("part", *FILTERS).agg(of(F.lit(1)).alias("docs"), of(F.col("good")).alias("good"), of(F.col("toxic")).alias("toxic"))


def bit(name: str) -> int:
    return 1 << FILTERS.index(name)


def steps() -> list[tuple[str, int, int, int, int]]:
    """``filter_order, step``, and as bits of subsets: the filter, those before it, and those up to it."""
    out = []
    for order in permutations(FILTERS):
        done = 0
        for k, name in enumerate(order):
            out.append(("".join(order), k + 1, bit(name), done, done | bit(name)))
            done |= bit(name)
    return out


def survivors(counts: DataFrame) -> DataFrame:
    """``part, subset, docs, good, toxic``: how many documents of a part no filter of the subset rejects. Subsets without survivors have no row."""
    subset = " + ".join(f"(1 - grouping({f})) * {bit(f)}" for f in FILTERS)
    none_fails = " and ".join(f"not coalesce({f}, false)" for f in FILTERS)
    return counts.sparkSession.sql(
        f"""
        select part, subset, {", ".join(COUNTS)}
        from (
            select part, {", ".join(FILTERS)}, grouping(part) as over_parts, cast({subset} as int) as subset, {", ".join(f"sum({c}) as {c}" for c in COUNTS)}
            from {{counts}} group by cube ({", ".join(FILTERS)}, part)
        )
        where over_parts = 0 and {none_fails}
        """,
        counts=counts,
    )


def audit(docs: DataFrame, labels: DataFrame, s: Scratch) -> DataFrame:
    """``part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley``: every step of all 120 orders in each part.

    Needs ``doc_id, text, lang`` and ``doc_id, quality, toxic``. A null lang is the part named by the
    empty string, a null text the empty text, which has no words and so fails A alone. A
    text of any length is judged whole. Of equal texts those with the smallest doc_id pass E, all rows
    of it; rows without an id pass E, and pass for no other's original. Repeated rows count each. A document
    is good or toxic if any of its labels says so; null labels and those of no document say nothing. An empty
    table gives no rows; other columns don't matter, whatever their names.
    """
    spark = docs.sparkSession
    alive = s.save(survivors(s.save(tallies(docs, labels), "tallies")), "survivors")
    everything = (1 << len(FILTERS)) - 1
    plan = spark.createDataFrame(steps(), "filter_order string, step int, filter int, before int, after int")
    weights = [(f, before, before | f, factorial(bin(before).count("1")) * factorial(len(FILTERS) - 1 - bin(before).count("1"))) for f in map(bit, FILTERS) for before in range(everything + 1) if not before & f]
    moves = spark.createDataFrame(weights, "filter int, before int, after int, orders long")

    # each part has the row of the empty subset; a subset without survivors counts none
    parts = alive.where("subset = 0").select("part", F.explode(F.sequence(F.lit(0), F.lit(everything))).alias("subset"))
    n = parts.join(alive, ["part", "subset"], "left").select("part", "subset", *[F.coalesce(c, F.lit(0)).alias(c) for c in COUNTS])
    n = s.save(n, "subsets")
    as_ = lambda name: n.select("part", F.col("subset").alias(name), *[F.col(c).alias(f"{name}_{c}") for c in COUNTS])

    pairs = moves.join(as_("before"), "before").join(as_("after"), ["part", "after"])
    gone = F.col("before_docs") - F.col("after_docs")
    total = pairs.groupBy("part", "filter").agg(
        F.sum(gone * F.col("orders")).alias("shapley"), F.max(F.when(F.col("before") == 0, gone)).alias("fails"), F.max(F.when(F.col("after") == everything, gone)).alias("unique_fails")
    )
    walked = plan.join(as_("before"), "before").join(as_("after"), ["part", "after"]).join(total, ["part", "filter"])
    return walked.select(
        "part",
        "filter_order",
        "step",
        F.col("after_docs").alias("kept"),
        gone.alias("removed"),
        (F.col("fails") - gone).alias("redundant"),
        "unique_fails",
        (F.col("before_good") - F.col("after_good")).alias("good_lost"),
        (F.col("before_toxic") - F.col("after_toxic")).alias("toxic_lost"),
        "shapley",
    )


#: The same document by document: a step removes what fails its filter and none of those before it.
ORACLE_SQL = r"""
with d as (select doc_id, coalesce(lang, '') part, coalesce(text, '') text from documents),
w as (select *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') ws from d),
o as (select text, min(doc_id) first from d group by 1),
l as (select doc_id, bool_or(coalesce(quality = 1, false)) good, bool_or(coalesce(toxic = 1, false)) toxic from labels where doc_id is not null group by 1),
f as (select w.doc_id, part, coalesce(good, false) good, coalesce(toxic, false) toxic,
  case when len(ws) < 200 then 'A' else '' end || case when 100 * len(list_distinct(ws)) < 50 * len(ws) then 'B' else '' end
  || case when 100 * len(regexp_extract_all(w.text, '[A-Z]')) > 3 * length(w.text) then 'C' else '' end
  || case when regexp_matches(w.text, '[#$%&*|]') then 'D' else '' end || case when w.doc_id > o.first then 'E' else '' end failed
  from w join o on w.text = o.text left join l on w.doc_id = l.doc_id),
g as (select part, failed, count(*) n, count(*) filter (good) good, count(*) filter (toxic) toxic from f group by 1, 2),
p as (select distinct part from f),
c as (select unnest(['A', 'B', 'C', 'D', 'E']) x),
orders as (select a.x || b.x || c1.x || d1.x || e.x o from c a, c b, c c1, c d1, c e where len(list_distinct([a.x, b.x, c1.x, d1.x, e.x])) = 5),
s as (select o, step, o[step] x, o[1:step - 1] earlier, o[1:step] upto from orders, range(1, 6) r(step)),
m as (select part, failed, n, good, toxic, o, step, x, contains(failed, x) fails, failed <> '' and translate(failed, earlier, '') <> failed gone, translate(failed, upto, '') = failed kept from g, s),
t as (select p.part, s.o filter_order, s.step, s.x,
  coalesce(sum(n) filter (kept), 0) kept, coalesce(sum(n) filter (fails and not gone), 0) removed, coalesce(sum(n) filter (fails and gone), 0) redundant,
  coalesce(sum(n) filter (failed = s.x), 0) unique_fails, coalesce(sum(good) filter (fails and not gone), 0) good_lost, coalesce(sum(toxic) filter (fails and not gone), 0) toxic_lost
  from p cross join s left join m on m.part = p.part and m.o = s.o and m.step = s.step group by all)
select part, filter_order, cast(step as integer) step, cast(kept as bigint) kept, cast(removed as bigint) removed, cast(redundant as bigint) redundant,
  cast(unique_fails as bigint) unique_fails, cast(good_lost as bigint) good_lost, cast(toxic_lost as bigint) toxic_lost,
  cast(sum(removed) over (partition by part, x) as bigint) shapley
from t
"""
