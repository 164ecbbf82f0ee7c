"""WARC archives: written by Spark's text writer, read back by boundary-chain verification.

The text reader cuts files at every ``WARC/1.``, also inside payloads and
across splits, in files of any name, gzip members too. Each piece gives a candidate record and, from its Content-Length,
the offset of its successor. Only records that the chain from the start of the
file reaches are records; a line inside a payload isn't reached. Runs of
candidates that follow each other are first put together, then pointer jumping
over runs doubles its reach with each round.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .scratch import Scratch
from .textarray import U, bloom_of

#: What versions 1.0 and 1.1 begin with, and what follows it.
MAGIC, VERSION = "WARC/1.", r"^[01]\r\n"
END = "\r\n\r\n"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
FILE_RECORDS = 20_000
#: A fixed date keeps reruns byte for byte alike.
DATE = "2020-01-01T00:00:00Z"


def base32(hex_digest: Column) -> Column:
    """RFC 4648 base-32 of 40 hexadecimal digits: eight groups of five digits, four letters each."""
    out = []
    for g in range(8):
        n = F.conv(F.substring(hex_digest, 5 * g + 1, 5), 16, 10).cast("int")
        out += [F.substring(F.lit(BASE32), F.shiftright(n, s).bitwiseAND(31) + 1, F.lit(1)) for s in (15, 10, 5, 0)]
    return F.concat(*out)


def _header(*lines: Column) -> Column:
    return F.concat_ws("\r\n", *lines)


def _field(name: str, value: Column) -> Column:
    return F.when(value.isNotNull(), F.concat(F.lit(f"{name}: "), value))


def _among(keys: DataFrame):
    """A test of long columns for the ``key`` of a saved table, by a filter that may say yes wrongly."""
    seen = bloom_of(keys, "key")

    @F.pandas_udf("boolean")
    def maybe(column: pd.Series) -> pd.Series:
        return pd.Series(seen.has(column.fillna(0).to_numpy("int64").view(U)))

    return maybe


def plan_records(pages: DataFrame, s: Scratch, least: int) -> DataFrame:
    """``page_id, url, html, sha, refers_to, tied`` of pages: the smallest page_id with the same payload if that is another one, and whether rows may share the page_id.

    Payloads aren't shuffled but for those whose digest a filter takes for repeated.
    """
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html")).withColumn("sha", F.sha1(F.col("html").cast("binary")))
    slim = rows.where(F.octet_length("html") >= least).where("page_id is not null").select("page_id", "sha")
    first = slim.groupBy("sha").agg(F.min("page_id").alias("first"), F.max("page_id").alias("last")).where("first <> last")
    first = s.save(first.select("sha", "first", F.xxhash64("sha").alias("key")), "repeated")
    tied = s.save(pages.where("page_id is not null").groupBy(F.col("page_id").cast("long").alias("key")).agg(F.count("*").alias("n")).where("n > 1").select("key"), "tied")
    marked = rows.withColumn("maybe", _among(first)(F.xxhash64("sha"))).withColumn("tied", F.col("page_id").isNull() | _among(tied)(F.col("page_id").cast("long")))
    names = ("page_id", "url", "html", "sha")
    alone = marked.where("not maybe").select(*names, F.lit(None).cast("long").alias("refers_to"), "tied")
    refers = F.when((F.octet_length("html") >= least) & (F.col("first") != F.col("page_id")), F.col("first"))
    twice = marked.where("maybe").join(first.drop("key"), "sha", "left").select(*names, refers.cast("long").alias("refers_to"), "tied")
    return alone.union(twice)


def write(spark: SparkSession, pages: DataFrame, path: str, s: Scratch, least: int = 0) -> None:
    """One record for each page, in uncompressed archives under ``path``: any reader's WARC 1.1."""
    rows = plan_records(pages, s, least)
    revisit = F.col("refers_to").isNotNull()
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.octet_length("html").cast("string"), F.lit(END)
    )
    block = F.concat(http, F.when(revisit, F.lit("")).otherwise(F.col("html")))
    name = lambda c, more=F.lit(""): F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("")), more, F.lit(">"))
    # a record id names one record, also where rows share a page_id or have none
    own = name(F.col("page_id"), F.when(F.col("tied"), F.concat(F.lit(":"), F.uuid())).otherwise(""))
    head = _header(
        F.concat(F.lit("WARC/1.1\r\nWARC-Type: "), F.when(revisit, "revisit").otherwise("response")),
        _field("WARC-Record-ID", own),
        F.lit(f"WARC-Date: {DATE}"),
        _field("WARC-Target-URI", F.regexp_replace("url", r"[\r\n]", " ")),
        _field("WARC-Payload-Digest", F.concat(F.lit("sha1:"), base32(F.col("sha")))),
        F.when(revisit, F.lit("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
        F.when(revisit, _field("WARC-Refers-To", name(F.col("refers_to")))),
        F.lit("Content-Type: application/http;msgtype=response"),
        _field("Content-Length", F.octet_length(block).cast("string")),
    )
    rows.select(F.concat(head, F.lit(END), block).alias("value")).write.option("lineSep", END).option("maxRecordsPerFile", FILE_RECORDS).mode("overwrite").text(path)


def _get(head: Column, name: str) -> Column:
    return F.nullif(F.regexp_extract(head, rf"(?im)^{name}:[ \t]*(.*?)\s*$", 1), F.lit(""))


def _parsed(value: Column) -> dict[str, Column]:
    head = F.substring_index(value, END, 1)
    return {"head": head, "head_bytes": F.octet_length(head) + 4, "block_bytes": _get(head, "Content-Length").cast("long")}


def _payload(value: Column, head_bytes: Column, block_bytes: Column) -> Column:
    """Bytes after the HTTP header of a record's block; ``value`` begins after the magic, with the version."""
    block = F.substring(value.cast("binary"), head_bytes + 1, block_bytes.cast("int"))
    http = F.octet_length(F.substring_index(block.cast("string"), END, 1)) + 4
    return F.substring(block, http + 1, F.octet_length(block))


def _placed(pieces: DataFrame) -> DataFrame:
    """Pieces of one saved scan (``file, block, at, size``) with ``start``: where in the file the magic line before each begins."""
    step = len(MAGIC)
    before = F.sum(F.col("size") + step).over(Window.partitionBy("file", "block").orderBy("at").rowsBetween(Window.unboundedPreceding, -1))
    blocks = pieces.groupBy("file", "block").agg(F.sum(F.col("size") + step).alias("span"))
    base = F.coalesce(F.sum("span").over(Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = pieces.withColumn("before", F.coalesce(before, F.lit(0))).join(blocks.withColumn("base", base).drop("span"), ["file", "block"])
    return placed.withColumn("start", F.col("base") + F.col("before") - step).drop("base", "before")


def read(spark: SparkSession, path: str, s: Scratch) -> DataFrame:
    """The records of archives: ``file, start, type, record_id, refers_to, url, digest, payload_bytes, sha`` (hexadecimal, of the bytes read).

    Versions 1.0 and 1.1, whoever wrote them, of any file name; ``.gz`` files are read by their uncompressed offsets, a file
    a task. A file that doesn't begin with a record of these versions is an error.
    """
    raw = (
        spark.read.option("lineSep", MAGIC)
        .text(path)
        .select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"))
    )
    p = _parsed(F.col("value"))
    payload = _payload(F.col("value"), F.col("head_bytes"), F.col("block_bytes"))
    pieces = raw.withColumns(p).select(
        "file",
        "block",
        "at",
        F.octet_length("value").cast("long").alias("size"),
        "head_bytes",
        "block_bytes",
        (F.col("value").rlike(VERSION) & F.col("value").contains(END)).alias("headed"),
        _get(F.col("head"), "WARC-Type").alias("type"),
        _get(F.col("head"), "WARC-Record-ID").alias("record_id"),
        _get(F.col("head"), "WARC-Refers-To").alias("refers_to"),
        _get(F.col("head"), "WARC-Target-URI").alias("url"),
        F.regexp_replace(_get(F.col("head"), "WARC-Payload-Digest"), "^sha1:", "").alias("digest"),
        F.octet_length(payload).cast("long").alias("payload_bytes"),
        F.sha1(payload).alias("sha"),
    )
    pieces = s.save(pieces, "pieces")
    by_file = Window.partitionBy("file").orderBy("start")
    opened = _placed(pieces).where("start = 0 and headed and block_bytes is not null").select("file").distinct()
    other = pieces.select("file").distinct().join(opened, "file", "left_anti").first()
    if other is not None:
        raise ValueError(f"{other['file']} doesn't begin with a WARC record of version 1.0 or 1.1")
    candidates = _placed(pieces).where("start >= 0 and headed and block_bytes is not null")
    candidates = candidates.withColumn("next", F.col("start") + len(MAGIC) + F.col("head_bytes") + F.col("block_bytes") + len(END)).drop("headed", "block", "at")
    candidates = s.save(candidates, "candidates")
    # runs: what follows its predecessor and isn't the goal of a jump from elsewhere
    slim = candidates.select("file", "start", "next").withColumns({"came": F.lag("next").over(by_file), "after": F.lead("start").over(by_file)})
    goals = slim.where("after is not null and after <> next").select("file", F.col("next").alias("start")).distinct().withColumn("goal", F.lit(True))
    headed = slim.join(goals, ["file", "start"], "left").withColumn("first", F.coalesce(F.col("came") != F.col("start"), F.lit(True)) | F.col("goal").isNotNull())
    numbered = s.save(headed.withColumn("run", F.sum(F.col("first").cast("int")).over(by_file)).select("file", "start", "next", "run"), "runs")
    runs = numbered.groupBy("file", "run").agg(F.min("start").alias("head"), F.max("next").alias("exit"))
    jump = s.save(runs.select("file", "head", "exit"), "jump0")
    reached = s.save(jump.where("head = 0").select("file", "head"), "reached0")
    n, k = reached.count(), 0
    while True:
        k += 1
        onward = reached.join(jump, ["file", "head"]).select("file", F.col("exit").alias("head")).join(runs.select("file", "head"), ["file", "head"], "left_semi")
        reached = s.save(reached.union(onward).distinct(), f"reached{k}")
        if (m := reached.count()) == n:
            break
        n = m
        jump = s.save(
            jump.join(jump.select("file", F.col("head").alias("exit"), F.col("exit").alias("further")), ["file", "exit"]).select("file", "head", F.col("further").alias("exit")), f"jump{k}"
        )
    good = numbered.join(runs, ["file", "run"]).join(reached, ["file", "head"], "left_semi").select("file", "start")
    records = s.save(candidates.join(good, ["file", "start"]), "records")
    whole = F.col("head_bytes") + F.col("block_bytes") + len(END) <= F.col("size")
    kept = ["file", "start", "type", "record_id", "refers_to", "url", "digest", "payload_bytes", "sha"]
    out = records.where(whole).select(*kept)
    broken = records.where(~whole)
    if broken.isEmpty():
        return out
    # a payload with magic lines in it: its pieces are put together again. They come from one more
    # scan, of the files that have such payloads, which is saved with its own offsets: how files are
    # split may have changed since, so nothing of the first scan but offsets in the file is used
    files = broken.select("file").distinct()
    again = s.save(raw.join(files, "file", "left_semi"), "again")
    spans = broken.select("file", F.col("start").alias("own"), "next")
    inside = _placed(again.select("file", "block", "at", F.octet_length("value").cast("long").alias("size")))
    inside = inside.withColumnRenamed("start", "piece").join(spans, "file").where("piece >= own and piece < next").select("file", "at", "own", "piece")
    text = again.select("file", "at", "value").join(inside, ["file", "at"]).groupBy("file", "own").agg(F.sort_array(F.collect_list(F.struct("piece", "value"))).alias("p"))
    text = text.select("file", F.col("own").alias("start"), F.array_join(F.transform("p", lambda x: x["value"]), MAGIC).alias("value"))
    mended = _payload(F.col("value"), F.col("head_bytes"), F.col("block_bytes"))
    fixed = broken.join(text, ["file", "start"]).withColumns({"payload_bytes": F.octet_length(mended).cast("long"), "sha": F.sha1(mended)})
    return out.union(fixed.select(*kept))


def round_trip(spark: SparkSession, pages: DataFrame, least: int = 0) -> DataFrame:
    """``page_id, payload_bytes, payload_digest, record_type, refers_to, url, intact`` of pages, as their archives have them.

    Null html is an empty payload. Of equal payloads of at least ``least`` bytes that with
    the smallest page_id is the response (each of its rows, if rows repeat); pages without
    page_id are responses. ``intact`` says that the bytes read have the digest that the
    header names. Empty texts are payloads like any other, pages of any length are written and
    read whole (a record must fit in a row). An empty table gives no rows; other columns don't
    matter, whatever their names.
    """
    s = Scratch(spark, "warc")
    write(spark, pages, s.path("archive"), s, least)
    found = read(spark, s.path("archive"), s)
    number = lambda c: F.nullif(F.regexp_extract(c, "<urn:page:(-?[0-9]*)[:>]", 1), F.lit("")).cast("long")
    rows = s.save(found.select(number("record_id").alias("page_id"), number("refers_to").alias("refers_to"), "type", "url", "digest", "payload_bytes", base32(F.col("sha")).alias("own")), "found")
    responses = rows.where("type = 'response'").select(
        "page_id", "payload_bytes", F.col("own").alias("payload_digest"), F.lit("response").alias("record_type"), F.lit(None).cast("long").alias("refers_to"), "url", (F.col("own") == F.col("digest")).alias("intact")
    )
    target = s.save(rows.where("type = 'response' and page_id is not null").select(F.col("page_id").alias("refers_to"), "payload_bytes", "own").dropDuplicates(["refers_to", "own"]), "targets")
    again = rows.where("type = 'revisit'").select("page_id", "refers_to", "url", "digest")
    revisits = again.join(target.withColumnRenamed("own", "digest"), ["refers_to", "digest"], "left").select(
        "page_id", "payload_bytes", F.col("digest").alias("payload_digest"), F.lit("revisit").alias("record_type"), "refers_to", "url", F.col("payload_bytes").isNotNull().alias("intact")
    )
    return responses.union(revisits)


_LETTERS = " || ".join(
    f"substr('{BASE32}', cast(((('0x' || substr(sha, {5 * g + 1}, 5))::int >> {k}) & 31) + 1 as bigint), 1)" for g in range(8) for k in (15, 10, 5, 0)
)
#: What archives of ``pages`` hold, by SHA-1 alone.
ORACLE_SQL = f"""
with p as (select page_id, url, coalesce(html, '') h, sha1(coalesce(html, '')) sha from pages),
f as (select *, min(page_id) over (partition by sha) first from p)
select page_id, cast(strlen(h) as bigint) payload_bytes, {_LETTERS} payload_digest, case when page_id = first then 'response' else 'revisit' end record_type,
  case when page_id <> first then first end refers_to, regexp_replace(url, '[\r\n]', ' ', 'g') url, true intact from f
"""
