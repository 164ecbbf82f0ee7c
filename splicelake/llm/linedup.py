"""Line dedup by a fixed-depth template tree, in DataFrame operations only.

A line is parsed down a tree of fixed depth: its number of tokens, then its
leading tokens, then a leaf. Tokens with a digit are variable fields (``<*>``).
A leaf is a template: the line as a whole, or, for longer lines, the line with
one half of what follows its leading tokens left open, so that lines which
differ in one region share a template. A template that stands in several
unrelated texts is boilerplate: its lines go. A text's own lines are those of which no
template stands in another text. Texts that have some are unrelated to others; texts
that have next to none, near copies above all, count as one text together, and so do equal ones.
Copies of a document thus don't make its lines boilerplate.

Texts are parsed once. What is moved after that are hashes of lines, and the texts
once, to where their gone lines are known.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .scratch import Scratch, fresh

LEAD = 3  # leading tokens on the path to a leaf
SHORTEST, SHORT_TEXTS = 5, 10  # a line of fewer tokens must stand in more texts
UNSPACED = 50  # characters from which a line of few tokens isn't short (scripts without spaces)
LONGEST, LONG_TEXTS = 50, 2  # a line of so many tokens recurs from two texts on
OPEN_FROM = 12  # tokens from which half a line may be open
TEXTS = 3  # unrelated texts that a recurring template stands in
OWN = 1 / 9  # share of own lines above which texts can't be near copies (80 % of their union in common)
SPACES = "\t\r\v\f"


def _enough(n: Column, texts: int) -> Column:
    """Whether a template, by the kind in its ``key``, stands in enough texts."""
    kind = F.col("key").bitwiseAND(F.lit(3))
    return n >= F.when(kind == 1, max(texts, SHORT_TEXTS)).when(kind == 2, min(texts, LONG_TEXTS)).otherwise(texts)


def parsed(docs: DataFrame) -> DataFrame:
    """``text_hash, row, pos, keys``: every line that isn't blank, with its leaves; ``row`` tells rows of ``docs`` apart.

    The last two bits of a key tell ordinary (0), short (1) and long lines (2). Each step is a
    projection of its own over the one before, so that nothing is computed twice.
    """
    col, text = F.col, F.col("text")
    spaced = reduce(lambda t, c: F.replace(t, F.lit(c), F.lit(" ")), SPACES, text)
    odd = reduce(lambda a, b: a | b, [text.contains(c) for c in SPACES])
    lines = docs.where(text.isNotNull()).select(F.xxhash64("text").alias("text_hash"), F.monotonically_increasing_id().alias("row"), F.split(F.when(odd, spaced).otherwise(text), "\n").alias("lines"))
    rows = lines.select("text_hash", "row", F.posexplode("lines").alias("pos", "raw"))
    rows = rows.select("text_hash", "row", "pos", F.trim(F.when(col("raw").contains("  "), F.regexp_replace("raw", " {2,}", " ")).otherwise(col("raw"))).alias("line")).where("line <> ''")
    masked = F.when(col("line").rlike("[0-9]"), F.regexp_replace("line", "(?<![^ ])[^ 0-9]*+[0-9][^ ]*+", "<*>")).otherwise(col("line"))
    rows = rows.select("text_hash", "row", "pos", "line", masked.alias("masked"))
    rows = rows.select("*", F.replace("masked", F.lit(" "), F.lit("")).alias("bare"))
    rows = rows.select("text_hash", "row", "pos", "line", "masked", "bare", (F.octet_length("masked") - F.octet_length("bare") + 1).alias("n"))
    kind = F.when((col("n") < SHORTEST) & (F.length("bare") < UNSPACED), 1).when(col("n") >= LONGEST, 2).otherwise(0).cast("bigint")
    # digits are masked where any other token is left: lines of fields only have nothing else to tell them apart
    fields = col("bare").startswith("<*>") & (F.replace("bare", F.lit("<*>"), F.lit("")) == "")
    rows = rows.select("text_hash", "row", "pos", "masked", "n", kind.alias("kind"), fields.alias("fields"), F.when(fields, col("line")).otherwise(col("masked")).alias("whole"))
    half = F.floor((col("n") - LEAD) / 2).cast("int")
    tokens = lambda count: F.call_function("substring_index", col("masked"), F.lit(" "), count)  # noqa: E731
    leaf = lambda *parts: F.xxhash64(*parts).bitwiseAND(F.lit(-4)).bitwiseOR(col("kind"))  # noqa: E731
    whole = leaf("whole", F.lit(0))
    first_open = leaf(tokens(F.lit(LEAD)), "n", F.lit(1), tokens(-(col("n") - LEAD - half)))
    second_open = leaf(tokens(F.lit(LEAD) + half), "n", F.lit(2))
    keys = F.when(col("fields") | (col("n") < OPEN_FROM), F.array(whole)).otherwise(F.array(whole, first_open, second_open))
    return rows.select("text_hash", "row", "pos", keys.alias("keys"))


def shared(rows: DataFrame) -> DataFrame:
    """``text_hash, pos, key`` of the templates that stand in two texts or more, equal ones being one."""
    leaves = rows.select("text_hash", "pos", F.explode("keys").alias("key"))
    # most templates stand in one text; two numbers a key tell these, whatever its rows
    several = leaves.groupBy("key").agg(F.min("text_hash").alias("a"), F.max("text_hash").alias("b")).where("a <> b").select("key")
    # what recurs grows with the documents: a merge join at every size
    return leaves.join(several.hint("merge"), "key").select("text_hash", "pos", "key")


def related(rows: DataFrame, met: DataFrame) -> DataFrame:
    """``text_hash`` of texts that have next to no own lines."""
    lines = rows.groupBy("text_hash", "row").agg(F.count("*").alias("n")).groupBy("text_hash").agg(F.max("n").alias("n"))
    others = met.select("text_hash", "pos").distinct().groupBy("text_hash").agg(F.count("*").alias("met"))
    return others.join(lines.hint("merge"), "text_hash").where(F.col("n") - F.col("met") <= OWN * F.col("n")).select("text_hash")


def recurring(rows: DataFrame, met: DataFrame, texts: int = TEXTS) -> DataFrame:
    """``key, texts`` of templates that stand in enough unrelated texts."""
    kin = related(rows, met).withColumn("kin", F.lit(True))
    seen = met.select("key", "text_hash").distinct().join(kin.hint("merge"), "text_hash", "left")
    counted = seen.groupBy("key").agg((F.count_if(F.col("kin").isNull()) + F.max(F.col("kin").isNotNull()).cast("long")).alias("texts"))
    return counted.where(_enough(F.col("texts"), texts))


def _joined(spark: SparkSession, docs: DataFrame, texts: int) -> tuple[DataFrame, Column, Column]:
    """``docs`` beside what of each text is gone; the number of gone lines, and the text without them."""
    s = Scratch(spark, "linedup")
    rows = s.save(parsed(docs), "lines")
    met = s.save(shared(rows), "met")
    found = s.save(recurring(rows, met, texts), "recurring")
    own, at, gone = fresh(docs, "own_hash", "text_hash", "gone_lines")
    lost = s.save(met.join(found.select("key").hint("merge"), "key").groupBy(F.col("text_hash").alias(at)).agg(F.collect_set("pos").alias(gone)), "gone")
    for name in ("lines", "met", "recurring"):
        s.drop(name)
    # what is gone grows with the documents: a merge join at every size
    joined = docs.withColumn(own, F.xxhash64("text")).join(lost.hint("merge"), (F.col(own) == F.col(at)) & F.col("text").isNotNull(), "left")
    # a let-binding: the lines of a text are cut once
    rest = lambda x: F.array_except(F.sequence(F.lit(0), F.size(x) - 1), F.col(gone))  # noqa: E731
    kept = F.transform(F.array(F.split("text", "\n")), lambda x: F.array_join(F.transform(rest(x), lambda i: F.get(x, i)), "\n"))[0]
    is_whole = F.col(gone).isNull()
    return joined, F.when(is_whole, 0).otherwise(F.size(gone)).cast("long"), F.when(is_whole, F.col("text")).otherwise(kept)


def _columns(docs: DataFrame, text: Column) -> list[Column]:
    return [text.alias(c) if c.lower() == "text" else F.col(f"`{c}`") for c in docs.columns]


def line_dedup(spark: SparkSession, docs: DataFrame, texts: int = TEXTS) -> DataFrame:
    """All columns of ``docs``, ``text`` without boilerplate lines, and ``n_lines``, ``n_dropped`` (long).

    Needs ``text``. Lines are what stands between ``\\n``; those kept stay as they are,
    in their order. Null texts stay null with 0 lines, empty texts stay empty; a text of
    boilerplate only becomes empty, its row stays. A text of any length is parsed whole and
    its lines are taken out in one pass; it must fit in a row. Repeated rows count as one
    text and lose the same lines; ids may tie or be null, they play no part. An empty table
    gives no rows. Columns named ``n_lines`` and ``n_dropped`` are replaced, all others stay,
    whatever their names.
    """
    docs = docs.drop("n_lines", "n_dropped")
    joined, n_dropped, text = _joined(spark, docs, texts)
    n_lines = F.when(F.col("text").isNull(), 0).otherwise(F.size(F.split("text", "\n"))).cast("long")
    return joined.select(*_columns(docs, text), n_lines.alias("n_lines"), n_dropped.alias("n_dropped"))


def without_lines(spark: SparkSession, docs: DataFrame, texts: int = TEXTS) -> DataFrame:
    """``docs`` with ``text`` as ``line_dedup`` leaves it; all other columns stay as they are, whatever their names."""
    joined, _, text = _joined(spark, docs, texts)
    return joined.select(*_columns(docs, text))


#: The same with the lines themselves for their hashes.
ORACLE_SQL = r"""
with t as (select distinct text from documents where text is not null),
l as (select text, unnest(string_split(text, chr(10))) raw, generate_subscripts(string_split(text, chr(10)), 1) - 1 pos from t),
m as (select text, pos, raw, trim(regexp_replace(raw, '[ 	
]+', ' ', 'g'), ' ') line from l),
k as (select *, regexp_replace(line, '[^ ]*[0-9][^ ]*', '<*>', 'g') masked from m where line <> ''),
n as (select *, string_split(masked, ' ') tokens, len(string_split(masked, ' ')) n, replace(masked, ' ', '') bare from k),
f as (select *, cast(floor((n - 3) / 2) as bigint) half, bare like '<*>%' and replace(bare, '<*>', '') = '' fields,
  case when n < 5 and length(bare) < 50 then 10 when n >= 50 then 2 else 3 end need from n),
leaves as (
  select text, pos, need, 'w' || case when fields then line else masked end as leaf from f
  union all select text, pos, need, concat('a', n, ' ', array_to_string(tokens[1:3], ' '), chr(10), array_to_string(tokens[4 + half:], ' ')) from f where n >= 12 and not fields
  union all select text, pos, need, concat('b', n, ' ', array_to_string(tokens[1:3 + half], ' ')) from f where n >= 12 and not fields),
several as (select leaf, need from leaves group by 1, 2 having count(distinct text) > 1),
met as (select distinct text, pos, leaf, need from leaves join several using (leaf, need)),
kin as (select f.text, 9 * count(*) filter (where g.pos is null) <= count(*) kin
  from f left join (select distinct text, pos from met) g on f.text = g.text and f.pos = g.pos group by 1),
found as (select leaf, need from (select distinct leaf, need, text from met) join kin using (text)
  group by 1, 2 having count(*) filter (where not kin) + max(case when kin then 1 else 0 end) >= need),
gone as (select distinct text, pos from met join found using (leaf, need)),
rest as (select l.text, count(*) n_lines, count(g.pos) n_dropped, string_agg(raw, chr(10) order by l.pos) filter (where g.pos is null) kept
  from l left join gone g on l.text = g.text and l.pos = g.pos group by 1)
select doc_id, case when d.text is null then null else coalesce(kept, '') end as text, coalesce(n_lines, 0) n_lines, coalesce(n_dropped, 0) n_dropped
from documents d left join rest r on d.text = r.text
"""
