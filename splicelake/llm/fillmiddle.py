"""Fill-in-middle transformation: texts cut at two unit bounds and put together again in another order.

An Arrow-batched pandas UDF gets the ends of a text's units from one ``finditer`` and
keeps them in a compact array; two look-ups give the cuts. Seeds and digests are SHA-256.
"""

from __future__ import annotations

import hashlib
from array import array

import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UNIT = r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+"
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SEED, RATE, SPM_SHARE = 42, 50, 80

FORMED = "n long, form string, prefix_chars long, middle_chars long, output string"


def draws(seed: int, doc_id: str) -> tuple[int, int, int, int]:
    """Four 32-bit numbers from the digest of the seed and the id."""
    found = hashlib.sha256(f"{seed}:{doc_id}".encode()).digest()
    return tuple(int.from_bytes(found[at : at + 4], "big") for at in range(0, 16, 4))


def unit_ends(text: str) -> array:
    """Where each unit of a text ends, in code points."""
    return array("q", (m.end() for m in regex.finditer(UNIT, text)))


def arrange(text: str, doc_id: str, seed: int = SEED, rate: int = RATE, spm_share: int = SPM_SHARE) -> tuple[int, str, int | None, int | None, str]:
    """``n, form, prefix_chars, middle_chars, output`` of one text."""
    ends = unit_ends(text)
    n = len(ends)
    h1, h2, h3, h4 = draws(seed, doc_id)
    if not text or any(mark in text for mark in (PREFIX, SUFFIX, MIDDLE)) or h3 % 100 >= rate:
        return n, "plain", None, None, text
    first, last = sorted((h1 % (n + 1), h2 % (n + 1)))
    a, b = (ends[k - 1] if k else 0 for k in (first, last))
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if h4 % 100 < spm_share:
        return n, "spm", a, b - a, f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"
    return n, "psm", a, b - a, f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"


def restore(output: str, form: str) -> str:
    """The text that an output of this form came from. Marks stand in no text that is cut, so the first of each is the one put in."""
    if form == "plain":
        return output
    outer, inner = (SUFFIX, PREFIX) if form == "spm" else (PREFIX, SUFFIX)
    one, rest = output.removeprefix(outer).split(inner, 1)
    two, middle = rest.split(MIDDLE, 1)
    prefix, suffix = (two, one) if form == "spm" else (one, two)
    return prefix + middle + suffix


def transform(docs: DataFrame, seed: int = SEED, rate: int = RATE, spm_share: int = SPM_SHARE) -> DataFrame:
    """``doc_id, n, form, prefix_chars, middle_chars, output`` of every row's whole text.

    ``n`` counts units in every form. ``rate`` percent of texts are cut, ``spm_share`` percent of
    those begin with their suffix; the same seed and id give the same cuts in any run. A null text is the
    empty one; empty texts and those that hold a mark stay ``plain``, with null lengths. White space
    alone is one unit. A text of any length is cut whole, its units' ends take eight bytes each. A
    null doc_id draws as an empty one; rows of equal ids draw alike, and repeated rows give repeated
    rows. An empty table gives no rows; other columns don't matter, whatever their names.
    """

    @F.pandas_udf(FORMED)
    def formed(ids: pd.Series, texts: pd.Series) -> pd.DataFrame:
        found = pd.DataFrame([arrange(t, i, seed, rate, spm_share) for i, t in zip(ids, texts, strict=True)], columns=["n", "form", "prefix_chars", "middle_chars", "output"])
        return found.astype({"prefix_chars": "Int64", "middle_chars": "Int64"})

    made = formed(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.coalesce(F.col("text"), F.lit("")))
    return docs.select("doc_id", made.alias("made")).select("doc_id", "made.*")


def digests(output: Column, form: Column) -> Column:
    """A struct of ``output_sha256`` and ``restored_sha256``: of an output, and of the text rebuilt from it."""

    @F.pandas_udf("output_sha256 string, restored_sha256 string")
    def hashed(outputs: pd.Series, forms: pd.Series) -> pd.DataFrame:
        sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
        return pd.DataFrame([(sha(o), sha(restore(o, f))) for o, f in zip(outputs, forms, strict=True)], columns=["output_sha256", "restored_sha256"])

    return hashed(output, form)


def fill_middle(docs: DataFrame) -> DataFrame:
    """``doc_id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256`` of every document: ``transform`` with what its outputs hash to.

    Null, empty and very long texts, marks, null and equal ids, repeated rows, empty tables and other columns as stated there.
    """
    made = transform(docs)
    return made.withColumn("sha", digests(F.col("output"), F.col("form"))).select("doc_id", "n", "form", "prefix_chars", "middle_chars", "sha.*")


#: The same by lists of units, digests as text, and the given text as what is restored.
ORACLE_SQL = r"""
with d as (select doc_id, coalesce(text, '') text, sha256(concat('42:', coalesce(cast(doc_id as varchar), ''))) h from documents),
u as (select *, regexp_extract_all(text, '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') units from d),
n as (select *, len(units) n, ('0x' || h[1:8])::bigint h1, ('0x' || h[9:16])::bigint h2, ('0x' || h[17:24])::bigint h3, ('0x' || h[25:32])::bigint h4 from u),
f as (select *, case when text = '' or contains(text, '<P>') or contains(text, '<S>') or contains(text, '<M>') or h3 % 100 >= 50 then 'plain'
  when h4 % 100 < 80 then 'spm' else 'psm' end form, least(h1 % (n + 1), h2 % (n + 1)) a, greatest(h1 % (n + 1), h2 % (n + 1)) b from n),
p as (select *, array_to_string(units[1:a], '') pre, array_to_string(units[a + 1:b], '') mid, array_to_string(units[b + 1:n], '') suf from f)
select doc_id, cast(n as bigint) n, form, cast(case when form <> 'plain' then length(pre) end as bigint) prefix_chars,
  cast(case when form <> 'plain' then length(mid) end as bigint) middle_chars,
  sha256(case form when 'plain' then text when 'psm' then concat('<P>', pre, '<S>', suf, '<M>', mid) else concat('<S>', suf, '<P>', pre, '<M>', mid) end) output_sha256,
  sha256(text) restored_sha256
from p
"""
